"""What the training-data operators share: workers' import path, words, hashes, checkpoints."""

from __future__ import annotations

import gc
import os
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words are runs of anything but ASCII white space; bytes.split() without arguments splits at just these.
WORD = r"[^\x20\x09-\x0D]+"
ROOT = str(Path(__file__).resolve().parents[2])
MIX1, MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def prepare(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package, and give checkpoint() a folder only where none is set."""
    sc = spark.sparkContext
    have = sc.environment.get("PYTHONPATH", "")
    if ROOT not in have.split(os.pathsep):
        sc.environment["PYTHONPATH"] = os.pathsep.join(x for x in (ROOT, have) if x)
    sc.environment.setdefault("ARROW_DEFAULT_MEMORY_POOL", "system")  # freed memory of workers goes back to the system
    sc.environment.setdefault("MALLOC_ARENA_MAX", "2")
    if spark.conf.get(BATCH) == "67108864b":  # the default: 64 MB of texts, held several times over on both sides
        spark.conf.set(BATCH, str(4 << 20))
    if not sc.getCheckpointDir():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        sc.setCheckpointDir(folder or f"/tmp/checkpoints-{os.getpid()}")
    return spark


def tidy(spark: SparkSession) -> None:
    """Let Spark's cleaner drop the shuffle files and plans of finished steps now, not at its next periodic collection."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def free(df: DataFrame, name: str) -> str:
    """The name, or a longer one that none of the columns has (whatever their case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of a step that is over, by Spark's own file system."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def written(path: str, df: DataFrame) -> DataFrame:
    """The rows as a table, which takes less room than a checkpoint. Its size is known from its files; a checkpoint keeps the
    estimate of the plan that made it, and each join multiplies the estimates of its sides."""
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def n_words(text: Column) -> Column:
    """Number of words of a text, 0 for null; built-in expressions only."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def columns(batch: pa.RecordBatch, *names: str) -> list[list]:
    return [batch.column(batch.schema.get_field_index(n)).to_pylist() for n in names]


def small(it: Iterator[pa.RecordBatch], text: str = "text", most: int = 1_000_000) -> Iterator[pa.RecordBatch]:
    """The batches cut into runs of rows with about so many bytes of text, so that arrays made of them stay small."""
    for batch in it:
        size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(text))), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
        at = 0
        while at < batch.num_rows:
            end = max(at + 1, int(np.searchsorted(size, (size[at - 1] if at else 0) + most, side="right")))
            yield batch.slice(at, end - at)
            at = end


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64's finalizer on uint64."""
    x = (x ^ (x >> np.uint64(30))) * MIX1
    x = (x ^ (x >> np.uint64(27))) * MIX2
    return x ^ (x >> np.uint64(31))


#: ASCII white space, and bytes with A-Z in lower case.
SPACE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
LOWER = np.arange(256, dtype=np.int64) + 32 * np.isin(np.arange(256), range(0x41, 0x5B))
PLACES = 64
_at_place = mix(np.arange(256 * PLACES, dtype=np.uint64) + np.uint64(0x9E3779B97F4A7C15))


def word_hashes(texts: list[str | None], between: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words in lower case (A-Z), text after text, and where each text's begin (with the end).
    between says of each byte whether it stands between words; a line feed must.

    The hash of a word is the sum of one random number for each byte at its place in the word, mixed with its length.
    """
    coded = [t.encode() if t else b"" for t in texts]
    buf = np.frombuffer(b"\n".join(coded) + b"\n", dtype=np.uint8)
    space = between[buf]
    edge = np.flatnonzero(np.diff(space, prepend=True))
    start, end = edge[::2], edge[1::2]
    length = end - start
    code = LOWER[buf[~space]]
    first = np.cumsum(length) - length
    place = np.arange(len(code)) - np.repeat(first, length)
    value = _at_place[(np.minimum(place, PLACES - 1) << 8) | code]
    if len(far := np.flatnonzero(place >= PLACES)):
        value[far] = mix(((place[far] << 8) | code[far]).astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    h = mix(np.add.reduceat(value, first) + length.astype(np.uint64) * MIX1) if len(first) else np.zeros(0, dtype=np.uint64)
    begin = np.cumsum([0, *(len(c) + 1 for c in coded)])
    return h, np.searchsorted(start, begin)


def shingles(h: np.ndarray, n: int = 5) -> np.ndarray:
    """Hashes of each run of n words in order; fewer words give the whole sequence as one, none give none."""
    if not len(h):
        return h
    n = min(n, len(h))
    m = len(h) - n + 1
    x = np.full(m, 0x9E3779B97F4A7C15 + n, dtype=np.uint64)
    for i in range(n):
        x = mix(x * np.uint64(0x9E3779B97F4A7C15) + h[i : i + m])
    return x


def sequences(texts: list[str | None], n: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """The shingles of all texts, text after text, and where each text's begin (with the end). One pass over all bytes."""
    h, first = word_hashes(texts)
    lengths = np.diff(first)
    counts = np.where(lengths >= n, lengths - n + 1, np.minimum(lengths, 1))
    at = np.append(0, np.cumsum(counts))
    out = np.zeros(int(at[-1]), dtype=np.uint64)
    long_ = np.where(lengths >= n, counts, 0)
    if long_.any():
        run = np.arange(int(long_.sum())) - np.repeat(np.append(0, np.cumsum(long_)[:-1]), long_)
        out[np.repeat(at[:-1], long_) + run] = shingles(h, n)[np.repeat(first[:-1], long_) + run]
    for i in np.flatnonzero((lengths > 0) & (lengths < n)).tolist():
        out[at[i]] = shingles(h[first[i] : first[i + 1]], n)[0]
    return out, at


def batches(rows: Iterator[tuple], schema: pa.Schema, size: int = 20_000) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for r in rows:
        held.append(r)
        if len(held) >= size:
            yield record(held, schema)
            held = []
    if held:
        yield record(held, schema)


def record(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)] if rows else [pa.array([], type=f.type) for f in schema], schema=schema)
