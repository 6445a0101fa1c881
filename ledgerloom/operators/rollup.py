"""Filters on states and flags, provenance and states beside rows, roll-ups over the fixed axis, samples and size limits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def usable(records: DataFrame, status: str = "status", include_flagged: bool = False) -> DataFrame:
    """Records for the tables: errors and records without a status never, those that need review only on demand."""
    s = F.col(status)
    return records.where(F.coalesce((s != "error") if include_flagged else (s == "clean"), F.lit(False)))


def true(flag: str) -> Column:
    """Whether a flag is set; null isn't."""
    return F.col(flag).eqNullSafe(True)


def any_flag(flags: str, *names: str) -> Column:
    """Whether a joined list of flags names one of these; null names none."""
    out = F.lit(False)
    for n in names:
        out = out | F.coalesce(F.col(flags).contains(n), F.lit(False))
    return out


def layout_in(layout: str, letters: str = "A-D") -> Column:
    return F.coalesce(F.col(layout).rlike(f"^[{letters}]:"), F.lit(False))


def review_roster(records: DataFrame, status: str = "status", quality: str = "target_quality") -> DataFrame:
    """Records that need review though their targets are sound."""
    return records.where((F.col(status) == "needs_review") & (F.col(quality) == "ok"))


def stamped(rows: DataFrame, **marks: str | None) -> DataFrame:
    """The rows with provenance columns of one value each."""
    return rows.withColumns({k: F.lit(v).cast("string") for k, v in marks.items()})


def with_state(rows: DataFrame, properties: DataFrame, key: str = "property_id", state: str = "state") -> DataFrame:
    """The rows with the state of their property beside them, for writers that partition by it; unknown properties have null."""
    return rows.join(properties.groupBy(key).agg(F.min(state).alias(state)), key, "left")


def roster(manifest: DataFrame, properties: DataFrame, key: str = "property_id") -> DataFrame:
    """Each manifest row with its property's columns; those of a name that the manifest has get _property behind it."""
    taken = {c.lower() for c in manifest.columns}
    named = [F.col(c).alias(f"{c}_property" if c.lower() in taken and c != key else c) for c in properties.columns]
    return manifest.join(properties.select(*named), key, "left")


def per_member(grid: DataFrame, member: str, members: list[str], key: str, assessed: str, amount: str) -> DataFrame:
    """A row a member of the fixed axis: keys that assessed it and the sum of an amount (decimal, null as 0); members without rows have zeros."""
    axis = grid.sparkSession.createDataFrame([(m,) for m in members], f"`{member}` string")
    per = grid.groupBy(member).agg(F.count_distinct(F.when(true(assessed), F.col(key))).alias("n_assessed"), F.sum(F.coalesce(F.col(amount).cast("decimal(18,2)"), F.lit(0))).cast("double").alias("total"))
    return axis.join(per, member, "left").select(member, F.coalesce("n_assessed", F.lit(0)).alias("n_assessed"), F.coalesce("total", F.lit(0.0)).alias("total"))


def located(issues: DataFrame, components: DataFrame, key: str = "property_id", where: str = "where", idx: str = "idx", value: str = "subcategory") -> DataFrame:
    """Issues whose place is written components[i], with that row's value beside them; other places and missing rows have null."""
    i = F.nullif(F.regexp_extract(where, r"^components\[(\d+)\]", 1), F.lit("")).cast("int")
    rows = components.select(key, F.col(idx).cast("int").alias("row_idx"), value)
    return issues.withColumn("row_idx", i).join(rows, [key, "row_idx"], "left")


def without_heaviest(items: DataFrame, group: str, item: str, size: str, limit: int) -> DataFrame:
    """Each group's items after its heaviest went, one by one (ties: the larger item first), until the rest is within the limit."""
    w = Window.partitionBy(group)
    before = F.coalesce(F.sum(size).over(w.orderBy(F.col(size).desc(), F.col(item).desc()).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    left = items.withColumn("left_before", F.sum(size).over(w) - before)
    return left.where(F.col("left_before") <= limit).drop("left_before")


def head(rows: DataFrame, n: int, *order) -> DataFrame:
    """The first rows in a stated order: a top-k, no sort of the whole."""
    return rows.orderBy(*order).limit(n)


def value_counts(rows: DataFrame, column: str, n: int | None = None) -> DataFrame:
    """How often each known value stands in a column, the most frequent first (ties by value) if only n are asked for; null is no value."""
    counts = rows.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    return counts.orderBy(F.col("n").desc(), column).limit(n) if n else counts


def distinct_values(rows: DataFrame, *columns: str) -> DataFrame:
    """One row with the number of distinct known values of each column."""
    return rows.agg(*(F.countDistinct(c).alias(c) for c in columns))


def spread(rows: DataFrame, by: list[str], value: str) -> DataFrame:
    """n, shortest, middle (interpolated), longest and total of a number, for each group."""
    return rows.groupBy(*by).agg(F.count("*").alias("n"), F.min(value).alias("shortest"), F.median(value).alias("middle"), F.max(value).alias("longest"), F.sum(value).alias("total"))


def group_sizes(rows: DataFrame, key: str) -> DataFrame:
    """One row: the median and the largest number of rows of a key."""
    return rows.groupBy(key).agg(F.count("*").alias("n")).agg(F.median("n").alias("middle"), F.max("n").alias("most"))


def numbered(rows: DataFrame, n: int, *order) -> DataFrame:
    """The first rows in a stated order, numbered from 1: a report of bounded length."""
    return rows.orderBy(*order).limit(n).withColumn("number", F.row_number().over(Window.orderBy(*order)).cast("long"))
