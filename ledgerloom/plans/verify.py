"""Offline verification and revalidation of stored records, each as one plan.

verify() fans out from the raw tables into repaired and coerced tables, from these into issue tables (sums, shapes, cells, arithmetic, the
document), and folds all issues back into one row a property. revalidate_store() does so over a keyed store: it repeats
what a validator says of the records as they stand, carries what a review left open, and replaces the stored rows.
"""

from __future__ import annotations

import gc
import uuid
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom import registries as R
from ledgerloom.functions import coerce
from ledgerloom.operators import verification as V
from ledgerloom.plans import revalidate as P
from ledgerloom.sources.store import BUCKETS, Store

FIRMS = [r for r in R.FIRM_RULES if r[0] != R.FIRM_OTHER]


class Verified(NamedTuple):
    properties: DataFrame
    systems: DataFrame
    components: DataFrame
    issues: DataFrame
    verdicts: DataFrame


def _tidy(spark: SparkSession) -> None:
    """Let Spark's cleaner drop the shuffle files of a step that is over now, not at its next periodic collection."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def _once(tables: tuple[DataFrame, ...], folder: str | None) -> tuple[DataFrame, ...]:
    """The tables as they are, or written to a folder and read again, so that what made them runs once for all that reads them."""
    if not folder:
        return tables
    out = []
    for i, df in enumerate(tables):
        df.write.mode("overwrite").parquet(f"{folder}/{i}")
        _tidy(df.sparkSession)
        out.append(df.sparkSession.read.schema(df.schema).parquet(f"{folder}/{i}"))
    return tuple(out)


def verify(properties: DataFrame, systems: DataFrame, components: DataFrame, cells: DataFrame, pages: DataFrame, folder: str | None = None) -> Verified:
    """Firms repaired from the pages, values coerced, every check, and a verdict a property.

    Arithmetic, grounding and amounts that the document lacks are recorded, but hold nothing up. systems and components have
    row_idx; cells are (property_id, field, value, page, snippet, confidence), pages (property_id, page_no, text). With
    a folder (shared by all executors) the repaired firms and the coerced tables are kept there while the checks read them.
    """
    (repaired,) = _once((V.repaired_firms(properties, pages),), folder and f"{folder}/firms")
    p, s, c = _once(P.coerced(V.with_repaired_firms(properties, repaired), systems, components, FIRMS), folder and f"{folder}/coerced")
    (t,) = _once((V.totals(p, s, c),), folder and f"{folder}/totals")
    issues = P.record_issues(p, s, c, t, more=True).unionByName(V.document_issues(p, V.repaired_cells(cells, repaired), pages))
    keys = t.select(F.col("property_id").cast("string").alias("property_id"), "report_firm", F.coalesce("s_rows", F.lit(0)).alias("systems_rows"), F.coalesce("c_rows", F.lit(0)).alias("component_rows"))
    return Verified(p.drop("__lost"), s.drop("__lost"), c.drop("__lost"), issues, V.verdicts(keys, issues))


TABLES = ("properties", "systems", "components")


def _stored_kind(df: DataFrame) -> DataFrame:
    """Numbers as texts that read as the same numbers, so that a table keeps its schema however often it is revalidated; values
    that were lost stay as they were written, so that every run sees them."""
    lost = lambda f: F.when(F.size("__lost") > 0, F.get(F.filter("__lost", lambda x: x["field"] == f), F.lit(0))["detail"]) if "__lost" in df.columns else F.lit(None).cast("string")
    return df.withColumns({f.name: F.coalesce(coerce.as_text(F.col(f.name)), lost(f.name)) for f in df.schema.fields if f.dataType.simpleString() == "double"}).drop("__lost")


def store_records(spark: SparkSession, folder: str, envelopes: DataFrame, properties: DataFrame, systems: DataFrame, components: DataFrame, buckets: int = BUCKETS) -> None:
    """Put records into the store: envelopes (property_id, status, unresolved, ...) and their three tables, replacing rows of the same properties."""
    for name, df in zip(("envelopes", *TABLES), (envelopes, properties, systems, components), strict=True):
        Store(spark, f"{folder}/{name}", "property_id", buckets).replace(_stored_kind(df))


def revalidate_store(spark: SparkSession, folder: str, buckets: int = BUCKETS) -> DataFrame:
    """Check every stored record as it stands, without repairing from pages and without a review: the envelopes as they are now.

    What a review left open (unresolved) stays and still holds the record up. Coerced tables and envelopes replace
    what was stored; flags gets the issues of the records that need review, and loses those of all others. A second run
    changes nothing.
    """
    stored = {name: Store(spark, f"{folder}/{name}", "property_id", buckets) for name in ("envelopes", *TABLES, "flags")}
    e, work = stored["envelopes"].read(), f"{folder}/work-{uuid.uuid4().hex}"
    p, s, c = _once(P.coerced(*(stored[n].read() for n in TABLES), FIRMS), work)
    (found,) = _once((P.record_issues(p, s, c, V.totals(p, s, c)),), f"{work}/issues")  # verdicts and flags read it three times
    keys = e.select("property_id", "unresolved", F.col("status").alias("was"))
    v = V.verdicts(keys, found, "unresolved")
    (renewed,) = _once((v.select("property_id", "unresolved", "status", "det_issues", "recon_issues", "why", F.lit(True).alias("revalidated")),), f"{work}/envelopes")
    flags = found.join(renewed.where("status = 'needs_review'").select("property_id"), "property_id", "left_semi")
    stored["flags"].overwrite(flags)
    # every stored row comes back, from the work folder: there is nothing to merge with
    for name, df in zip((*TABLES, "envelopes"), (*map(_stored_kind, (p, s, c)), renewed), strict=True):
        stored[name].renew(df)
    stored["envelopes"].remove(work)
    return stored["envelopes"].read()
