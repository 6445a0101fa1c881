"""Typed values from messy cells: conditions, ranges, states, booleans, denominators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom import registries as R

from .text import SIMPLE, lookup, non_value, number, number_range, once, simple

# How ratings and their parts are written.
SPAN = r"(?iu)\s+(?:to|-|–|/)\s+|\s*/\s*"
QUALIFIER = r"\s*\([^)]*\)\s*$"
LOCATIVE = r"(?iu)\s+(?:at|in|on|near|along|around|throughout|beneath|behind|adjacent to|for|of)\s+\S.*$"
RATING = r"(?iu)^\s*([1-5])(?:\s*(?:/|of|out of)\s*5)?\s*$"


#: What a part must have to be stripped or spread at all.
DIVISIBLE = r"[\s(/]"


def known(part: Column, allowed: list[str], synonyms: dict[str, str]) -> Column:
    return F.lower(F.trim(part)).isin(*dict.fromkeys([*allowed, *synonyms]))


def _stripped(part: Column, allowed: list[str], synonyms: dict[str, str]) -> Column:
    """Without a trailing bracket, then without a place, if what is left is a known value."""
    a = F.regexp_replace(part, QUALIFIER, "")
    b = F.regexp_replace(a, LOCATIVE, "")
    return F.when(known(part, allowed, synonyms) | ~part.rlike(DIVISIBLE), part).when(known(a, allowed, synonyms), a).when(known(b, allowed, synonyms), b).otherwise(part)


def _spanned(part: Column, allowed: list[str], synonyms: dict[str, str]) -> Column:
    spread = once(F.split(part, SPAN), lambda both: F.when((F.size(both) == 2) & F.forall(both, lambda p: known(p, allowed, synonyms)), both).otherwise(F.array(part)))
    return F.when(known(part, allowed, synonyms) | ~part.rlike(DIVISIBLE), F.array(part)).otherwise(spread)


def category_value(x: Column, allowed: list[str] = R.CONDITIONS, synonyms: dict[str, str] = R.CONDITION_SYNONYMS) -> Column:
    """A value of several parts joined by ;, each trimmed, stripped, spread over a span and spelled as the vocabulary does.

    A value that the vocabulary has as it stands is looked up at once: the lambdas aren't compiled, and cost many times that.
    """
    bare = F.lower(F.trim(x))
    return F.when(x.isNull(), None).when(bare.isin(*synonyms), lookup(synonyms, bare)).when(bare.isin(*allowed), bare).otherwise(_category_parts(x, allowed, synonyms))


def _category_parts(x: Column, allowed: list[str], synonyms: dict[str, str]) -> Column:
    parts = F.filter(F.transform(F.split(x, ";"), lambda p: F.trim(p)), lambda p: p != "")
    parts = F.flatten(F.transform(F.transform(parts, lambda p: _stripped(p, allowed, synonyms)), lambda p: _spanned(p, allowed, synonyms)))
    spelled = F.transform(F.transform(parts, lambda p: F.lower(F.trim(p))), lambda p: F.coalesce(lookup(synonyms, p), p))
    return once(F.array_join(spelled, "; "), lambda v: F.when(v != "", v))


def ordinal(condition: Column) -> Column:
    return lookup(R.CONDITION_ORDINAL, condition)


def numeric_rating(condition: Column) -> Column:
    """1 to 5 where a condition is a bare rating."""
    return F.nullif(F.regexp_extract(condition, RATING, 1), F.lit("")).try_cast("double")


def state_code(x: Column) -> Column:
    up = F.upper(F.trim(x))
    return F.coalesce(lookup(R.STATES, F.lower(F.trim(x))), F.when(up.isin(*sorted(set(R.STATES.values()))), up), x)


def _parsed(x: Column, span: bool) -> Column:
    """Null and plain numbers without a look at words and ranges; all else part by part."""
    none, no = F.lit(None).cast("double"), F.lit(False)
    made = lambda value, lo=none, hi=none, varies=no, lost=no: F.struct(value.alias("value"), lo.alias("lo"), hi.alias("hi"), varies.alias("varies"), lost.alias("lost"))
    varies = F.coalesce(x.rlike(r"(?iu)^\s*var"), no)

    def ends(r: Column | None) -> Column:
        value = F.coalesce(r["hi"], number(x)) if r is not None else number(x)
        lo, hi = (r["lo"], r["hi"]) if r is not None else (none, none)
        return once(value, lambda v: made(v, lo, hi, varies, v.isNull()))

    read = once(number_range(x), ends) if span else ends(None)
    return F.when(x.isNull(), made(none)).when(x.rlike(SIMPLE), made(simple(x))).when(non_value(x), made(none, varies=varies)).otherwise(read)


def ranged(x: Column) -> Column:
    """struct<value, lo, hi, varies, lost>: a number field that may be a range; the value is the upper end."""
    return _parsed(x, True)


def plain(x: Column) -> Column:
    """The same struct for a field without range columns: the first number, or the only number word."""
    return _parsed(x, False)


def as_text(x: Column) -> Column:
    """A number as a text that reads as the same number again: no exponent, no trailing zeros, up to six decimals."""
    return F.regexp_replace(F.regexp_replace(x.cast("decimal(28,6)").cast("string"), r"0+$", ""), r"\.$", "")


def boolean(x: Column) -> Column:
    s = F.lower(F.trim(x))
    return F.when(s.isin("true", "yes", "y", "1"), True).when(s.isin("false", "no", "n", "0"), False)


def unwrap(cell: Column, field: str) -> Column:
    """The value of a cell with provenance."""
    return F.try_element_at(cell, F.lit(field))["value"]


def project(df: DataFrame, fields: list[str], kind: str = "string") -> DataFrame:
    """Fixed columns in order; what isn't there is null."""
    return df.select(*(F.col(f) if f in df.columns else F.lit(None).cast(kind).alias(f) for f in fields))


def dedupe_denominators(df: DataFrame, units: str = "num_units", rooms: str = "num_rooms", basis: str = "unit_basis") -> DataFrame:
    """Where units and rooms are equal, only the one that the basis names stays."""
    same = F.col(units) == F.col(rooms)
    return df.withColumns({units: F.when(~F.coalesce(same & (F.col(basis) == "rooms"), F.lit(False)), F.col(units)), rooms: F.when(~F.coalesce(same & (F.coalesce(F.col(basis), F.lit("units")) != "rooms"), F.lit(False)), F.col(rooms))})


def field_correct(predicted: Column, gold: Column) -> Column:
    """Both null; numbers within the larger of 1 and 1 %; else equal text, trimmed, in any case."""
    p, g = predicted.try_cast("double"), gold.try_cast("double")
    return (
        F.when(predicted.isNull() & gold.isNull(), True)
        .when(predicted.isNull() | gold.isNull(), False)
        .when(p.isNotNull() & g.isNotNull(), F.abs(p - g) <= F.greatest(F.lit(1.0), F.abs(g) * 0.01))
        .otherwise(F.lower(F.trim(predicted)) == F.lower(F.trim(gold)))
    )
