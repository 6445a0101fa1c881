"""The feed: replays, late rows, watermarks, and results by key and version."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from ledgerloom.sources.store import Store
from ledgerloom.streaming import feed

SCHEMA = "id string, version int, value double"


def files(spark, folder, *batches, schema=SCHEMA):
    for b in batches:
        spark.createDataFrame(b, schema).coalesce(1).write.mode("append").parquet(folder)


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_feed_takes_the_newest_row_of_a_key_whatever_order_files_come_in(spark, tmp_path):
    folder, store = str(tmp_path / "in"), Store(spark, f"file:{tmp_path}/out", "id", 4)
    files(spark, folder, [("a", 1, 1.0), ("b", 2, 2.0)], [("a", 3, 3.0), ("a", 2, 9.0)])
    run = lambda checkpoint: feed.upsert_available(feed.watch(spark, folder, SCHEMA, files=1), store, ("version",), str(tmp_path / checkpoint)).awaitTermination()
    run("c")
    assert rows(store.read().select("id", "version", "value")) == [("a", 3, 3.0), ("b", 2, 2.0)]
    files(spark, folder, [("a", 2, 7.0), ("b", 1, 0.0), ("c", 1, 5.0)])  # late for a and b
    run("c")
    want = [("a", 3, 3.0), ("b", 2, 2.0), ("c", 1, 5.0)]
    assert rows(store.read().select("id", "version", "value")) == want
    run("c")  # nothing new
    run("other")  # all files again
    assert rows(store.read().select("id", "version", "value")) == want


def test_equal_versions_are_decided_by_the_rest_of_the_row(spark, tmp_path):
    store = Store(spark, f"file:{tmp_path}/out", "id", 4)
    for part in ([("a", 1, 1.0)], [("a", 1, 3.0)], [("a", 1, 2.0)], []):
        store.upsert(spark.createDataFrame(part, SCHEMA), "version")
    assert rows(store.read().select("id", "version", "value")) == [("a", 1, 3.0)]


def test_store_replaces_all_rows_of_a_key_and_no_others(spark, tmp_path):
    store = Store(spark, f"file:{tmp_path}/out", "id", 3)
    store.replace(spark.createDataFrame([("a", 1, 1.0), ("a", 2, 2.0), ("b", 1, 1.0), (None, 1, 1.0)], SCHEMA))
    store.replace(spark.createDataFrame([("a", 9, 9.0), (None, 2, 2.0)], SCHEMA))
    assert sorted(map(str, rows(store.read().select(F.coalesce("id", F.lit("-")), "version", "value")))) == ["('-', 2, 2.0)", "('a', 9, 9.0)", "('b', 1, 1.0)"]
    store.replace(store.read().where("id = 'b'").withColumn("version", F.lit(5)))  # from the table itself
    assert ("b", 5, 1.0) in rows(store.read().where("id IS NOT NULL").select("id", "version", "value"))
    assert sorted(p.name.split("=")[0] for p in tmp_path.iterdir()) == ["out"]  # nothing staged is left


def test_results_by_key_and_version_are_computed_once(spark, tmp_path):
    store, asked = Store(spark, f"file:{tmp_path}/out", "id", 4), []

    def compute(df):
        asked.append(sorted(r.id for r in df.collect()))
        return df.withColumn("value", F.col("version") * 10.0)

    inputs = spark.createDataFrame([("a", 1, None), ("b", 1, None)], SCHEMA)
    assert rows(feed.results(inputs, store, "version", compute).select("id", "value")) == [("a", 10.0), ("b", 10.0)]
    later = spark.createDataFrame([("a", 1, None), ("b", 2, None), ("c", 1, None)], SCHEMA)
    assert rows(feed.results(later, store, "version", compute).select("id", "value")) == [("a", 10.0), ("b", 20.0), ("c", 10.0)]
    feed.results(later, store, "version", compute)
    assert asked == [["a", "b"], ["b", "c"], []]


T0 = datetime(2024, 1, 1)
EVENTS = "id string, at timestamp, value double"


def collected(spark, stream, tmp_path, name):
    stream.writeStream.format("parquet").outputMode("append").option("path", str(tmp_path / name)).option("checkpointLocation", str(tmp_path / f"{name}-checkpoint")).trigger(availableNow=True).start().awaitTermination()
    return rows(spark.read.parquet(str(tmp_path / name)))


@pytest.mark.parametrize("delay,kept", [("1 hour", 2), ("10 hours", 1)])
def test_once_per_key_forgets_behind_the_watermark(spark, tmp_path, delay, kept):
    folder = str(tmp_path / "in")
    stream = lambda: feed.once_per_key(feed.watch(spark, folder, EVENTS, files=1), "id", "at", delay)
    files(spark, folder, [("a", T0, 1.0), ("a", T0 + timedelta(minutes=1), 2.0), ("b", T0, 3.0)], schema=EVENTS)
    assert len(collected(spark, stream(), tmp_path, "out")) == 2
    files(spark, folder, [("c", T0 + timedelta(hours=5), 4.0)], schema=EVENTS)
    assert len(collected(spark, stream(), tmp_path, "out")) == 3
    files(spark, folder, [("a", T0 + timedelta(hours=5, minutes=1), 5.0)], schema=EVENTS)
    got = collected(spark, stream(), tmp_path, "out")
    assert sum(r[0] == "a" for r in got) == kept


def test_windowed_counts_leave_late_rows_out(spark, tmp_path):
    folder = str(tmp_path / "in")
    stream = lambda: feed.windowed_counts(feed.watch(spark, folder, EVENTS, files=1), "at", ["id"], "1 hour", "2 hours")
    files(spark, folder, [("a", T0, 1.0), ("a", T0 + timedelta(minutes=59), 2.0)], schema=EVENTS)
    assert collected(spark, stream(), tmp_path, "out") == []  # the window may still grow
    files(spark, folder, [("a", T0 + timedelta(minutes=30), 4.0), ("b", T0 + timedelta(hours=4), 1.0)], schema=EVENTS)
    assert collected(spark, stream(), tmp_path, "out") == [(T0, "a", 3, 7.0)]
    files(spark, folder, [("a", T0 + timedelta(minutes=31), 8.0), ("b", T0 + timedelta(hours=9), 1.0)], schema=EVENTS)  # the first is late
    assert collected(spark, stream(), tmp_path, "out") == [(T0, "a", 3, 7.0), (T0 + timedelta(hours=4), "b", 1, 1.0)]
