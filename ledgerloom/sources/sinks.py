"""Writers: tables as CSV and Parquet, rows routed by status, firm and state as partitions, a data dictionary."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.text import slug


def typed(df: DataFrame, fields: list[str]) -> DataFrame:
    """Columns of mixed kinds as strings; null stays null."""
    return df.withColumns({f: F.col(f).cast("string") for f in fields if f in df.columns})


def tables(named: dict[str, DataFrame], folder: str, formats: tuple[str, ...] = ("parquet", "csv")) -> None:
    """A folder for each table and format; the commit protocol leaves no half-written one behind."""
    for name, df in named.items():
        for f in formats:
            w = df.write.mode("overwrite")
            (w.option("header", True).csv if f == "csv" else w.parquet)(f"{folder}/{name}.{f}")


def flags(issues: DataFrame, key: str = "property_id") -> DataFrame:
    """The key and its issues as one JSON list, in order: what a reviewer of the record reads."""
    fields = [c for c in ("layer", "row_idx", "field", "kind", "detail") if c in issues.columns]
    return issues.groupBy(key).agg(F.to_json(F.array_sort(F.collect_list(F.struct(*fields))), {"ignoreNullFields": "false"}).alias("flags"))


def routed(df: DataFrame, clean: str, review: str, status: str = "status", issues: DataFrame | None = None, key: str = "property_id") -> None:
    """Clean records to one folder, all others to another, with their issues beside it (review-flags) if there are any to write.
    All folders are written anew, so that a record that has become clean leaves no flags behind."""
    held = df.where(F.coalesce(F.col(status) != "clean", F.lit(True)))
    df.where(F.col(status) == "clean").write.mode("overwrite").option("header", True).csv(clean)
    held.write.mode("overwrite").option("header", True).csv(review)
    if issues is not None:
        flags(issues.join(held.select(key).distinct(), key, "left_semi"), key).write.mode("overwrite").json(f"{review}-flags")


def with_partitions(df: DataFrame, firm: str, state: str) -> DataFrame:
    return df.withColumns({"firm_key": slug(F.col(firm), empty="unknown"), "state_key": slug(F.col(state), empty="unknown")})


def partitioned(df: DataFrame, folder: str, firm: str, state: str, files: int = 8) -> None:
    """firm_key=/state_key= folders. Rows are spread over a few files a folder, so that a hot firm isn't one task."""
    out = with_partitions(df, firm, state).withColumn("__spread", F.pmod(F.xxhash64(*df.columns), F.lit(files)))
    out.repartition("firm_key", "state_key", "__spread").drop("__spread").write.mode("overwrite").partitionBy("firm_key", "state_key").parquet(folder)


def dictionary(df: DataFrame, exact: bool = False) -> DataFrame:
    """column, n, non_null, distinct_values of each column: one aggregate, then one row a column. Distinct values are
    estimated, or counted exactly, which shuffles every value of every column."""
    distinct = F.count_distinct if exact else F.approx_count_distinct
    a = df.agg(F.count("*").alias("n"), *(F.struct(F.count(c).alias("k"), distinct(c).alias("d")).alias(c) for c in df.columns))
    rows = F.array(*(F.struct(F.lit(c).alias("column"), F.col("n"), F.col(c)["k"].alias("non_null"), F.col(c)["d"].alias("distinct_values")) for c in df.columns))
    return a.select(F.explode(rows).alias("r")).select("r.*")


def markdown(rows: DataFrame, order: str) -> DataFrame:
    """A bounded table, such as a dictionary, as the lines of a Markdown table: line, text."""
    cell = lambda c: F.coalesce(F.regexp_replace(F.col(c).cast("string"), r"\|", r"\\|"), F.lit(""))
    head = [f"| {' | '.join(rows.columns)} |", f"|{'-|' * len(rows.columns)}"]
    top = rows.sparkSession.createDataFrame(list(enumerate(head)), "line long, text string")
    lines = rows.select((F.row_number().over(Window.orderBy(order)) + 1).cast("long").alias("line"), F.concat(F.lit("| "), F.concat_ws(" | ", *map(cell, rows.columns)), F.lit(" |")).alias("text"))
    return top.unionByName(lines)
