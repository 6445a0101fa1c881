"""Let Python workers import this package, wherever the driver found it, and hand them small batches."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import SparkSession

ROOT = str(Path(__file__).resolve().parents[2])
#: The most bytes of a batch, with Spark's default: 64 MB of texts, held several times over by a worker.
BATCH, DEFAULT = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b"


def importable(spark: SparkSession) -> SparkSession:
    env = spark.sparkContext.environment
    have = env.get("PYTHONPATH", "")
    if ROOT not in have.split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (ROOT, have) if x)
    if spark.conf.get(BATCH) == DEFAULT:
        spark.conf.set(BATCH, str(4 << 20))
    return spark
