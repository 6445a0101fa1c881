"""A folder as a feed: files are taken once, rows are keyed by id and stamp, results replace older ones."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerloom.sources.store import Store


def watch(spark: SparkSession, folder: str, schema: str, kind: str = "parquet", files: int = 1000) -> DataFrame:
    """A file stream with a declared schema."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).format(kind).load(folder)


def once_per_key(stream: DataFrame, key: str, at: str, delay: str = "1 hour") -> DataFrame:
    """Each key once within the watermark; state older than that goes."""
    return stream.withWatermark(at, delay).dropDuplicatesWithinWatermark([key])


def windowed_counts(stream: DataFrame, at: str, by: list[str], width: str = "1 hour", delay: str = "2 hours") -> DataFrame:
    """Counts and sums per tumbling window and key; rows later than the watermark are left out."""
    return stream.withWatermark(at, delay).groupBy(F.window(at, width).alias("w"), *by).agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("w.start").alias("window_start"), *by, "n", "total")


def run_available(stream: DataFrame, transform, folder: str, checkpoint: str) -> StreamingQuery:
    """Process what is there and stop: a batch run that remembers what it has taken."""

    def each(batch: DataFrame, number: int) -> None:
        transform(batch).write.mode("overwrite").parquet(f"{folder}/batch={number}")

    return stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def upsert_available(stream: DataFrame, store: Store, order: tuple[str, ...], checkpoint: str, transform: Callable[[DataFrame], DataFrame] | None = None) -> StreamingQuery:
    """Take what is there into a keyed store, one row a key, the newest by order, and stop.

    A batch that is repeated after a failure, files that come again and rows older than what is stored change nothing, so the
    table is the same however the feed was cut into batches.
    """

    def each(batch: DataFrame, number: int) -> None:
        store.upsert(transform(batch) if transform else batch, *order)

    return stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def outstanding(batch: DataFrame, store: Store, version: str) -> DataFrame:
    """Rows whose key isn't stored under the version that they have now: what is still to be done."""
    if not store.exists():
        return batch
    done = store.read().select(F.col(store.key).alias("__key"), F.col(version).alias("__version"))
    return batch.join(done, F.col(store.key).eqNullSafe(F.col("__key")) & F.col(version).eqNullSafe(F.col("__version")), "left_anti")


def results(inputs: DataFrame, store: Store, version: str, compute: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The result of each input (one row a key, with its version), computed only where the store has none of that version.

    compute keeps key and version. New results are stored, those of other versions of the same key give way to them.
    """
    store.replace(compute(outstanding(inputs, store, version)))
    return store.read().join(inputs.select(store.key, version).distinct(), [store.key, version], "left_semi")
