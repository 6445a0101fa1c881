"""Fill-in-middle: cut each whole text in three by hashes of its doc_id and put the parts in another order.

DuckDB runs inside mapInArrow: every Arrow batch is registered as a table, one SQL statement cuts, orders, restores and
hashes all its texts, and its Arrow result goes back to Spark; no row passes through Python. A text is cut into pieces of
up to 64 code points (regexp_extract_all), a part is a slice of pieces (list_slice, array_to_string) less what the piece at
its edge has too much, so a text takes one list entry for 64 code points. One thread a worker, and no folder to
spill to: nothing is written on the machine.

The form is plain (the text as it is), psm (<P>prefix<S>suffix<M>middle) or spm (<S>suffix<P>prefix<M>middle). Texts with a
marker in them stay plain, so each marker of the other forms stands once and restore() gives the exact text.

Null texts are empty ones, and those are plain. A null doc_id is hashed as an empty number. Repeated rows give repeated
rows, an empty table an empty one. Only doc_id, the text and what keep names are read, whatever other columns are called;
a kept column must not have the name of a result (ValueError).
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from .common import prepare, small

PIECE = 64
#: Hundredths of the texts that stay plain, and of the others that are spm.
PLAIN, SPM = 10, 20

#: h1 to h4, the cuts a and b, and the text as pieces.
CUT = f"""
hashed AS (SELECT * REPLACE (coalesce("text", '') AS "text"), sha256('1:' || coalesce(CAST("doc_id" AS VARCHAR), '')) AS h FROM batch),
four AS (SELECT *, length("text") AS n, [{", ".join(f"CAST('0x' || substr(h, {1 + 8 * i}, 8) AS BIGINT)" for i in range(4))}] AS hs FROM hashed),
cut AS (SELECT * EXCLUDE (h), least(hs[1] % (n + 1), hs[2] % (n + 1)) AS a, greatest(hs[1] % (n + 1), hs[2] % (n + 1)) AS b,
  CASE WHEN n = 0 OR contains("text", '<P>') OR contains("text", '<S>') OR contains("text", '<M>') OR hs[3] % 100 >= {100 - PLAIN} THEN 'plain'
    WHEN hs[4] % 100 < {SPM} THEN 'spm' ELSE 'psm' END AS form,
  CASE WHEN form <> 'plain' THEN regexp_extract_all("text", '(?s).{{1,{PIECE}}}') END AS pieces FROM four)"""


def _part(start: str, end: str) -> str:
    """Code points from start (left out) to end (included): a slice of pieces, less what its first and last have beside."""
    return f"substr(array_to_string(list_slice(pieces, {start} // {PIECE} + 1, ({end} + {PIECE - 1}) // {PIECE}), ''), {start} % {PIECE} + 1, {end} - {start})"


#: The parts, then the output that the form asks for.
ORDERED = f"""
parts AS (SELECT * EXCLUDE (pieces), {_part("0", "a")} AS prefix, {_part("a", "b")} AS middle, {_part("b", "n")} AS suffix FROM cut),
ordered AS (SELECT *, CASE form WHEN 'plain' THEN "text" WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
  ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END AS output FROM parts)"""
#: The text again, from nothing but the output and its form.
RESTORED = """
halves AS (SELECT *, string_split(output, '<M>') AS half FROM {0}),
sides AS (SELECT *, CASE form WHEN 'psm' THEN string_split(substr(half[1], 4), '<S>') WHEN 'spm' THEN list_reverse(string_split(substr(half[1], 4), '<P>')) END AS side FROM halves),
restored AS (SELECT *, CASE WHEN form = 'plain' THEN output ELSE side[1] || half[2] || side[2] END AS restored FROM sides)"""
CHARS = "CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars"

TRANSFORM = f"""WITH {CUT}, {ORDERED} SELECT KEEP n, form, {CHARS}, output FROM ordered"""
RESTORE = f"""WITH {RESTORED.format("batch")} SELECT KEEP restored FROM restored"""
DIGEST = f"""WITH {CUT}, {ORDERED}, {RESTORED.format("ordered")}
SELECT "doc_id", n, form, {CHARS}, sha256(output) AS output_sha256, sha256(restored) AS restored_sha256 FROM restored"""


def _run(source: DataFrame, sql: str, text: str, out: list[StructField]) -> DataFrame:
    """The statement on every batch of the source, which it sees as the table batch."""
    prepare(source.sparkSession)

    def each(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import duckdb

        con = duckdb.connect(config={"threads": 1, "temp_directory": ""})
        try:
            for batch in small(it, text, 4_000_000):
                con.register("batch", pa.Table.from_batches([batch]))
                yield from con.sql(sql).to_arrow_table().to_batches()
                con.unregister("batch")
        finally:
            con.close()

    return source.mapInArrow(each, StructType(out))


def _kept(docs: DataFrame, keep: tuple[str, ...], results: list[str]) -> tuple[list, str, list[StructField]]:
    """Columns to carry under names that can't clash, as SQL, and as fields of the result."""
    if clash := {k.lower() for k in keep} & set(results):
        raise ValueError(f"kept columns have names of results: {sorted(clash)}")
    cols = [F.col(f"`{k}`").alias(f"__keep{i}") for i, k in enumerate(keep)]
    return cols, "".join(f"__keep{i}, " for i in range(len(keep))), [StructField(k, docs.schema[k].dataType) for k in keep]


LONG, STRING = LongType(), StringType()
SHAPE = [StructField("n", LONG), StructField("form", STRING), StructField("prefix_chars", LONG), StructField("middle_chars", LONG)]


def transform(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """What keep names, n, form, prefix_chars, middle_chars (null if plain) and the output text."""
    cols, names, fields = _kept(docs, keep, [*(f.name for f in SHAPE), "output"])
    source = docs.select(*cols, F.col(f"`{doc_id}`").cast("string").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    return _run(source, TRANSFORM.replace("KEEP ", names), "text", [*fields, *SHAPE, StructField("output", STRING)])


def restore(made: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """What keep names, and the text that transform() made output of; of the other columns only form and output are read."""
    cols, names, fields = _kept(made, keep, ["restored"])
    return _run(made.select(*cols, "form", "output"), RESTORE.replace("KEEP ", names), "output", [*fields, StructField("restored", STRING)])


def digest(docs: DataFrame) -> DataFrame:
    """doc_id, shape, and the digests of the output and of the text restored from it, in one pass."""
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    return _run(source, DIGEST, "text", [StructField("doc_id", LONG), *SHAPE, StructField("output_sha256", STRING), StructField("restored_sha256", STRING)])


def query(spark, sf_dir: str) -> DataFrame:
    return digest(spark.read.parquet(f"{sf_dir}/documents.parquet"))


ORACLE_SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
u AS (SELECT *, CAST('0x' || h[1:8] AS BIGINT) % (n + 1) AS x, CAST('0x' || h[9:16] AS BIGINT) % (n + 1) AS y, CAST('0x' || h[17:24] AS BIGINT) % 100 AS p, CAST('0x' || h[25:32] AS BIGINT) % 100 AS q FROM d),
f AS (SELECT *, least(x, y) AS a, greatest(x, y) AS b, CASE WHEN n = 0 OR regexp_matches(t, '<[PSM]>') OR p >= 90 THEN 'plain' WHEN q < 20 THEN 'spm' ELSE 'psm' END AS form FROM u)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || t[1:a] || '<S>' || t[b + 1:] || '<M>' || t[a + 1:b] ELSE '<S>' || t[b + 1:] || '<P>' || t[1:a] || '<M>' || t[a + 1:b] END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM f"""
