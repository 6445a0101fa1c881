"""What can be read of JSON that was cut off or broken: whole objects of a named list, whole verdicts by name.

A scanner looks at strings and brackets only, so it finds where an object ends whatever else is in it. An object that
doesn't parse is left out and the scan goes on behind it; an object or a string that isn't closed ends it.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import udtf

from ledgerloom.functions.workers import importable

#: A string (closed, or cut off by the end of the text), a brace, or the end of a list.
MARK = re.compile(r'"(?:[^"\\]|\\.)*+(?:"|\\?\Z)|[{}\]]', re.S)


def objects(text: str, at: int) -> Iterator[str]:
    """The brace-matched objects from a place on, until the list ends that the place is in."""
    depth = start = 0
    for m in MARK.finditer(text, at):
        if m[0] == "{":
            start = start if depth else m.start()
            depth += 1
        elif m[0] == "}" and depth:
            depth -= 1
            if not depth:
                yield text[start : m.end()]
        elif m[0] == "]" and not depth:
            return


def _parsed(text: str) -> dict | None:
    try:
        value = json.loads(text)
    except (json.JSONDecodeError, RecursionError):
        return None
    return value if isinstance(value, dict) else None


def salvaged(text: str | None, name: str | None = "components") -> Iterator[str]:
    """The whole objects of the list of a name, in order, as they are written; of the first list where the name isn't found."""
    text = text or ""
    named = text.find(f'"{name}"')
    at = text.find("[", max(named, 0))
    if at >= 0:
        yield from (x for x in objects(text, at + 1) if _parsed(x) is not None)


def verdicts(text: str | None, names: Sequence[str]) -> Iterator[tuple[str, dict]]:
    """For each name the object that follows its first mention, where it is whole and says whether it's ok."""
    text = text or ""
    for name in names:
        said = text.find(f'"{name}"')
        at = text.find("{", said) if said >= 0 else -1
        value = _parsed(next(objects(text, at), "")) if at >= 0 else None
        if value is not None and "ok" in value:
            yield name, value


def _text(x: object) -> str | None:
    return x if x is None or isinstance(x, str) else json.dumps(x)


@udtf(returnType="pos int, object string")
class SalvageRows:
    """Lateral: salvage_rows(text, name) gives the place and the text of each whole object of the list."""

    def eval(self, text: str, name: str = "components") -> Iterator[tuple[int, str]]:
        yield from enumerate(salvaged(text, name))


@udtf(returnType="key string, ok boolean, corrected_value string, reason string")
class SalvageVerdicts:
    """Lateral: salvage_verdicts(text, array of names) gives each whole verdict; ok is null where it is no truth value."""

    def eval(self, text: str, names: list) -> Iterator[tuple[str, bool | None, str | None, str | None]]:
        for name, v in verdicts(text, [n for n in names or [] if n]):
            yield name, v["ok"] if isinstance(v["ok"], bool) else None, _text(v.get("corrected_value")), _text(v.get("reason"))


def component_rows(answers: DataFrame, key: str = "doc_id", scope: str = "scope", raw: str = "raw", name: str = "components") -> DataFrame:
    """The key, row_idx (from 0) and JSON text of the rows of a list that came in several answers (one a scope), in the order of scopes; what
    can be read of an answer that was cut off counts."""
    register(answers.sparkSession)
    rows = answers.sparkSession.sql(f"SELECT `{key}`, `{scope}` AS __scope, o.pos AS __pos, o.object FROM {{answers}}, LATERAL salvage_rows(`{raw}`, '{name}') o", answers=answers)
    at = F.row_number().over(Window.partitionBy(key).orderBy("__scope", "__pos")) - 1
    return rows.select(key, at.alias("row_idx"), "object")


def register(spark: SparkSession) -> None:
    importable(spark)
    spark.udtf.register("salvage_rows", SalvageRows)
    spark.udtf.register("salvage_verdicts", SalvageVerdicts)
