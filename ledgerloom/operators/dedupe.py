"""Exact and re-exported duplicates, flags, incremental work lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def name_quality(stem: Column) -> Column:
    """Order of survivors: no placeholder word, more letters, then the name."""
    placeholder = stem.rlike(r"(?iu)\b(dup|duplicate|placeholder|copy)\b")
    return F.struct(placeholder.alias("placeholder"), (-F.length(F.regexp_replace(stem, r"[^\p{L}]", ""))).alias("letters"), stem.alias("stem"))


def keep_best(df: DataFrame, keys: list[str], order: Column, name: str) -> DataFrame:
    """Each row with the survivor of its key: minima by order, partial before the shuffle, joined back. Null keys survive by themselves."""
    known = F.lit(True)
    for k in keys:
        known = known & F.col(k).isNotNull()
    best = df.where(known).groupBy(*keys).agg(F.min_by(name, order).alias("kept"))
    return df.join(best, keys, "left").withColumn("kept", F.when(known, F.col("kept")).otherwise(F.col(name)))


def dedupe(files: DataFrame, name: str = "file", content: str = "bytes_sha", text: str = "first_page_text", pages: str = "n_pages", least: int = 200) -> DataFrame:
    """file, kept, why: equal bytes first; then, among the survivors, equal first pages (if long enough) of equally long files."""
    one = keep_best(files, [content], name_quality(F.col(name)), name)
    left = one.where(F.col("kept") == F.col(name)).drop("kept")
    page = F.trim(F.col(text))
    left = left.withColumn("__page", F.when(F.length(page) >= least, F.sha2(page, 256)))
    two = keep_best(left, ["__page", pages], name_quality(F.col(name)), name)
    first = one.where(F.col("kept") != F.col(name)).select(name, "kept", F.lit("same bytes").alias("why"))
    second = two.select(name, "kept", F.when(F.col("kept") != F.col(name), "same first page").alias("why"))
    return first.unionByName(second)


def duplicate_flag(df: DataFrame, key: str) -> DataFrame:
    """Whether another row has the same non-null key; counts are joined back, so that a hot key isn't one task's window."""
    n = df.where(F.col(key).isNotNull()).groupBy(key).count()
    return df.join(n, key, "left").withColumn("duplicated", F.coalesce(F.col("count") > 1, F.lit(False))).drop("count")


def work_list(inputs: DataFrame, done: DataFrame, key: str, stamp: str, current: Column) -> DataFrame:
    """key, state: todo (never done), stale (done under another stamp) or current."""
    d = done.select(F.col(key).alias("__k"), F.col(stamp).alias("__s"))
    state = F.when(F.col("__k").isNull(), "todo").when(F.col("__s").eqNullSafe(current), "current").otherwise("stale")
    return inputs.join(d, F.col(key) == F.col("__k"), "left").select(*inputs.columns, state.alias("state"))


def orphans(done: DataFrame, inputs: DataFrame, key: str) -> DataFrame:
    return done.join(inputs, key, "left_anti")


def stamp_of(raw: Column, field: str = "_prompt_version") -> Column:
    """The stamp of a stored JSON record: unversioned if it has none, unreadable if it can't be parsed."""
    return F.when(F.get_json_object(raw, "$").isNull(), "unreadable").otherwise(F.coalesce(F.nullif(F.get_json_object(raw, f"$.{field}"), F.lit("")), F.lit("unversioned")))


def stamp_audit(done: DataFrame, stamp: str, current: Column) -> DataFrame:
    """verdict UNIFORM, MIXED or UNKNOWN over the stamps; one row."""
    s = F.coalesce(F.nullif(F.col(stamp), F.lit("")), F.lit("unversioned"))
    a = done.groupBy(s.alias("stamp")).count().agg(F.count("*").alias("n_stamps"), F.sum("count").alias("n"), F.bool_or(F.col("stamp") == "unversioned").alias("unknown"), F.bool_and(F.col("stamp") == current).alias("all_current"))
    return a.select("n_stamps", "n", "all_current", F.when(F.col("unknown"), "UNKNOWN").when(F.col("n_stamps") == 1, "UNIFORM").otherwise("MIXED").alias("verdict"))


def neighbours(df: DataFrame, key: str, at: str, flag: str) -> DataFrame:
    """The flagged rows and those one place before and after."""
    w = Window.partitionBy(key).orderBy(at)
    hit = F.coalesce(F.col(flag), F.lit(False)) | F.coalesce(F.lag(flag).over(w), F.lit(False)) | F.coalesce(F.lead(flag).over(w), F.lit(False))
    return df.withColumn("selected", hit)
