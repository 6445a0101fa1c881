"""Text and number functions as column expressions: parsing, folding, ordered containment, slugs, hashes."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerloom import registries as R

# Numbers and ranges.
NUMBER = r"(?<![\d-])-?\d[\d,]*(?:\.\d+)?"
#: A text that is one number and nothing else, but for a dollar sign before it: most cells are.
SIMPLE = r"^\$?-?\d[\d,]*(?:\.\d+)?\z"
RANGE = r"(?iu)(\d[\d,]*(?:\.\d+)?)\s*(?:-|–|—|to|through|thru|and)\s*(\d[\d,]*(?:\.\d+)?)"
#: Letters with marks and what they fold to; other marks are dropped by squash().
ACCENTED = "àáâãäåèéêëìíîïòóôõöùúûüýÿñçšž"
PLAIN = "aaaaaaeeeeiiiiooooouuuuyyncsz"
DASHES, QUOTES = "‐‑‒–—―−", "‘’‚‛“”„‟"


def literal_map(m: dict) -> Column:
    """A fixed table of strings, integers or floats as a map: one expression, parsed by Spark."""
    said = lambda x: "'" + x.replace("\\", "\\\\").replace("'", "\\'") + "'" if isinstance(x, str) else f"{x}D" if isinstance(x, float) else str(x)
    return F.expr(f"map({', '.join(said(x) for kv in m.items() for x in kv)})")


def lookup(m: dict, key: Column) -> Column:
    """The value of a key in a fixed table, null if it isn't there."""
    return F.try_element_at(literal_map(m), key)


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """use() of a value that is worked out once, however often use() names it (lambdas aren't searched for common parts)."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def bare(token: Column) -> Column:
    return F.regexp_replace(token, ",", "").try_cast("double")


def all_numbers(x: Column) -> Column:
    return F.transform(F.regexp_extract_all(x, F.lit(NUMBER), F.lit(0)), bare)


def word_numbers(x: Column) -> Column:
    words = F.regexp_extract_all(F.lower(x), F.lit("[a-z]+"), F.lit(0))
    return F.filter(F.transform(words, lambda w: lookup(R.NUMBER_WORDS, w)), lambda n: n.isNotNull())


def simple(x: Column) -> Column:
    """The value of a text that matches SIMPLE."""
    return F.translate(x, "$,", "").try_cast("double")


def number(x: Column) -> Column:
    """First number of a text; else the value of its number word, if it has exactly one; else null."""
    worded = once(word_numbers(x), lambda w: F.when(F.size(w) == 1, F.get(w, F.lit(0)).cast("double")))
    return F.when(x.rlike(SIMPLE), simple(x)).otherwise(once(F.regexp_extract(x, NUMBER, 0), lambda token: F.when(token != "", bare(token)).otherwise(worded)))


def number_range(x: Column) -> Column:
    """struct<lo, hi>: a range of digits, else of number words (one word is both ends), else null."""
    pair = lambda lo, hi: F.struct(lo.cast("double").alias("lo"), hi.cast("double").alias("hi"))
    ends = F.struct(bare(F.regexp_extract(x, RANGE, 1)).alias("a"), bare(F.regexp_extract(x, RANGE, 2)).alias("b"))
    worded = once(word_numbers(x), lambda w: F.when(F.size(w) > 0, pair(F.array_min(w), F.array_max(w))))
    return F.when(F.regexp_extract(x, RANGE, 0) != "", once(ends, lambda e: pair(F.least(e["a"], e["b"]), F.greatest(e["a"], e["b"])))).when(~x.rlike(r"\d"), worded)


def non_value(x: Column) -> Column:
    return F.coalesce(x.rlike(R.NON_VALUES), F.lit(False))


def norm(x: Column) -> Column:
    """Dashes, quotes and white space folded, trimmed, lower case."""
    s = F.translate(x, DASHES + QUOTES + " ", "-" * len(DASHES) + "'" * 4 + '"' * 4 + " ")
    return F.lower(F.trim(F.regexp_replace(s, r"\s+", " ")))


def squash(x: Column) -> Column:
    """Lower-case letters a to z and digits only, accents folded."""
    return F.regexp_replace(F.translate(F.lower(x), ACCENTED, PLAIN), "[^a-z0-9]", "")


def fragments(x: Column) -> Column:
    return F.filter(F.transform(F.split(x, r"\.{2,}|…"), lambda p: F.trim(p)), lambda p: p != "")


def contains_ordered(hay: Column, needles: Column) -> Column:
    """Whether the needles occur in order and without overlap."""
    at = F.aggregate(needles, F.lit(1), lambda pos, n: F.when(pos < 1, F.lit(-1)).otherwise(F.when(F.call_function("locate", n, hay, pos) > 0, F.call_function("locate", n, hay, pos) + F.length(n)).otherwise(F.lit(-1))))
    return (F.size(needles) > 0) & (at > 0)


def snippet_present(snippet: Column, hay: Column) -> Column:
    """Ordered fragments on normalised text, else on squashed text; an empty snippet isn't present."""
    parts = fragments(snippet)
    squashed = F.filter(F.transform(parts, squash), lambda p: p != "")
    return F.coalesce(contains_ordered(norm(hay), F.transform(parts, norm)) | contains_ordered(squash(hay), squashed), F.lit(False))


def number_forms(v: Column) -> Column:
    """1,234 / 1234 / 1,234.00 of a value."""
    whole = F.bround(v, 0).cast("long")
    return F.array(F.format_number(whole, 0), whole.cast("string"), F.format_number(v.cast("double"), 2), F.format_string("%.2f", v.cast("double")))


def slug(x: Column, most: int | None = None, empty: str | None = None) -> Column:
    s = F.regexp_replace(F.regexp_replace(x, "[^A-Za-z0-9]+", "_"), "^_+|_+$", "")
    s = F.substring(s, 1, most) if most else s
    return F.coalesce(F.nullif(s, F.lit("")), F.lit(empty)) if empty else s


def flat(x: Column, most: int) -> Column:
    return F.substring(F.trim(F.regexp_replace(x, r"\s+", " ")), 1, most)


def version_stamp(parts: Iterable[Column]) -> Column:
    """First twelve hex digits of a SHA-256."""
    return F.substring(F.sha2(F.concat_ws("|", *parts), 256), 1, 12)


def fingerprint(x: Column) -> Column:
    return F.substring(F.sha1(F.trim(x)), 1, 12)


def unfence(x: Column) -> Column:
    return F.regexp_replace(F.trim(x), r"^```(?:json)?\s*|\s*```$", "")


def lenient_json(x: Column, schema: str) -> Column:
    """The whole text as JSON, else what stands between the first { and the last }."""
    s = unfence(x)
    inner = F.regexp_extract(s, r"(?s)\{.*\}", 0)
    return F.coalesce(F.when(F.get_json_object(s, "$").isNotNull(), F.from_json(s, schema)), F.from_json(inner, schema))


def year_map(m: Column) -> Column:
    """Years of a sparse schedule: keys such as 3, year_3 or Year 12 within the term; other keys go. The last of equal years wins."""
    entries = F.transform(F.map_entries(m), lambda e: F.struct(F.regexp_replace(e["key"], "^[yearYEAR_ ]+|[yearYEAR_ ]+$", "").try_cast("int").alias("key"), e["value"].alias("value")))
    kept = F.filter(entries, lambda e: e["key"].between(1, R.YEARS))
    last = F.filter(kept, lambda e, i: ~F.exists(F.slice(kept, i + 2, F.size(kept)), lambda later: later["key"] == e["key"]))
    return F.map_from_entries(last)


def widen_years(m: Column) -> list[Column]:
    return [F.try_element_at(m, F.lit(i)).alias(f"year_{i}") for i in range(1, R.YEARS + 1)]
