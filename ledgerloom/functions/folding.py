"""Folding of texts for comparison over the whole of Unicode: compatibility forms, dashes, quotes, white space, marks, case.

Catalyst has no Unicode normal forms, so texts beyond ASCII are folded by an Arrow UDF; ASCII texts are folded by column
expressions, and the UDF sees nulls in their place.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.workers import importable

# What dashes, quotes and the space that doesn't break become.
DASHES, SINGLE, DOUBLE, SPACE = "‐‑‒–—―", "’‘‚‛", "“”„‟", " "
FOLDS = str.maketrans(DASHES + SINGLE + DOUBLE + SPACE, "-" * len(DASHES) + "'" * len(SINGLE) + '"' * len(DOUBLE) + " ")
BLANKS, SIGNS = re.compile(r"\s+"), re.compile("[^a-z0-9]")
#: What Python's \s is among ASCII characters, for Java.
BLANK = r"[\t-\r\x1c-\x20]+"


def norm_text(s: str) -> str:
    """Compatibility composition, dashes and quotes as in ASCII, runs of white space as one space, trimmed, lower case."""
    s = s if s.isascii() else unicodedata.normalize("NFKC", s).translate(FOLDS)
    return BLANKS.sub(" ", s).strip().lower()


def squash_text(s: str) -> str:
    """Letters a to z and digits of the compatibility decomposition in lower case; marks go with all the rest."""
    s = s if s.isascii() else unicodedata.normalize("NFKD", s)
    return SIGNS.sub("", s.lower())


def _session() -> None:
    """Workers must find this package; a column expression knows no session but the active one."""
    if (spark := SparkSession.getActiveSession()) is not None:
        importable(spark)


def _udf(f: Callable[[str], str]):
    _session()

    @F.arrow_udf("string")
    def fold(x: pa.Array) -> pa.Array:
        return pa.array([None if (s := v.as_py()) is None else f(s) for v in x], type=pa.string())

    return fold


def _udf_all(f: Callable[[str], str]):
    _session()

    @F.arrow_udf("array<string>")
    def fold(x: pa.Array) -> pa.Array:
        return pa.array([None if a is None else [None if s is None else f(s) for s in a] for a in (v.as_py() for v in x)], type=pa.list_(pa.string()))

    return fold


def _beyond(x: Column) -> Column:
    return x.rlike(r"[^\x00-\x7F]")


def norm(x: Column) -> Column:
    plain = F.lower(F.trim(F.regexp_replace(x, BLANK, " ")))
    return F.coalesce(_udf(norm_text)(F.when(_beyond(x), x)), plain)


def squash(x: Column) -> Column:
    return F.coalesce(_udf(squash_text)(F.when(_beyond(x), x)), F.regexp_replace(F.lower(x), "[^a-z0-9]", ""))


def norm_all(x: Column) -> Column:
    """norm() of each element of an array (a UDF can't stand in a lambda)."""
    plain = F.transform(x, lambda s: F.lower(F.trim(F.regexp_replace(s, BLANK, " "))))
    return F.coalesce(_udf_all(norm_text)(F.when(F.exists(x, _beyond), x)), plain)


def squash_all(x: Column) -> Column:
    plain = F.transform(x, lambda s: F.regexp_replace(F.lower(s), "[^a-z0-9]", ""))
    return F.coalesce(_udf_all(squash_text)(F.when(F.exists(x, _beyond), x)), plain)
