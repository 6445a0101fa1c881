"""A keyed table of Parquet files: rows of a key are replaced together, by rewriting only the buckets that the keys fall in.

Rows lie in bucket= folders by a hash of their key. A change is staged as a table of its own first, and the staged buckets
then overwrite the stored ones; a change that fails in between is repeated with the same result. Writers of one table take turns.
The number of buckets is that of the table's first writer: a bucket should hold what a task can sort.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKETS = 64


class Store:
    def __init__(self, spark: SparkSession, folder: str, key: str, buckets: int = BUCKETS):
        self.spark, self.folder, self.key, self.buckets = spark, folder, key, buckets

    def _path(self, folder: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)

    def exists(self) -> bool:
        p = self._path(f"{self.folder}/_SUCCESS")
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(p)

    def remove(self, folder: str) -> None:
        """Delete a folder by Spark's own file system."""
        p = self._path(folder)
        p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)

    def _bucketed(self, df: DataFrame) -> DataFrame:
        return df.withColumn("bucket", F.pmod(F.xxhash64(F.col(self.key).cast("string")), F.lit(self.buckets)).cast("int"))

    def read(self) -> DataFrame:
        return self.spark.read.parquet(self.folder).drop("bucket")

    def overwrite(self, df: DataFrame) -> None:
        """All rows of the table; df mustn't read it."""
        self._write(self._bucketed(df), self.folder, "static")

    def replace(self, rows: DataFrame) -> None:
        """The rows take the place of all stored rows of their keys. rows may read the table."""
        self._merged(rows, None)

    def renew(self, rows: DataFrame) -> None:
        """The rows, staged by the caller and with all keys of the table, take the place of all that is stored; they mustn't read the table.
        Repeating a renewal that fails in between gives the same result."""
        if self.exists():
            kinds = {f.name: f.dataType for f in self.read().schema.fields if f.name not in rows.columns}
            rows = rows.withColumns({c: F.lit(None).cast(kind) for c, kind in kinds.items()})
        self._write(self._bucketed(rows), self.folder, "dynamic")

    def upsert(self, rows: DataFrame, *order: str) -> None:
        """One row a key, the greatest by order (then by all columns) of what is stored and what comes: late or repeated rows change nothing."""
        self._merged(rows, order)

    def _merged(self, rows: DataFrame, order: tuple[str, ...] | None) -> None:
        if not self.exists():
            new = self._bucketed(rows)  # nothing to merge with
            return self._write(self._newest(new, order) if order else new, self.folder, "static")
        incoming, staged = f"{self.folder}-incoming-{uuid.uuid4().hex}", f"{self.folder}-staged-{uuid.uuid4().hex}"
        self._bucketed(rows).write.parquet(incoming)  # read once, whatever it takes to make them
        new = self.spark.read.parquet(incoming)
        if touched := sorted(r[0] for r in new.select("bucket").distinct().collect()):  # as many as there are buckets, at most
            old = self.spark.read.parquet(self.folder).where(F.col("bucket").isin(*touched))
            if order:
                after = self._newest(old.unionByName(new, allowMissingColumns=True), order)
            else:
                after = old.join(new.select(self.key).distinct(), old[self.key].eqNullSafe(new[self.key]), "left_anti").unionByName(new, allowMissingColumns=True)
            after.write.parquet(staged)
            self._write(self.spark.read.parquet(staged), self.folder, "dynamic")
        self.remove(incoming)
        self.remove(staged)

    def _newest(self, df: DataFrame, order: tuple[str, ...]) -> DataFrame:
        others = [c for c in df.columns if c not in (self.key, *order)]
        best = F.max(F.struct(*(F.col(c) for c in (*order, *others)))).alias("__row")
        return df.groupBy(self.key).agg(best).select(self.key, "__row.*")

    def _write(self, df: DataFrame, folder: str, mode: str) -> None:
        df.repartition("bucket").write.mode("overwrite").option("partitionOverwriteMode", mode).partitionBy("bucket").parquet(folder)
