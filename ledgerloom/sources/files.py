"""Readers: file listings, records as JSON, tables as CSV or Parquet, page texts; salvage of truncated JSON is beside."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.text import slug
from ledgerloom.sources.salvage import register, salvaged

__all__ = ["cells", "csv", "first_paths", "gold_labels", "listing", "page_texts", "records", "register", "salvaged"]

CELL = "struct<value:string, page:int, snippet:string, confidence:double>"
RECORD = f"property map<string, {CELL}>, systems array<map<string, string>>, components array<map<string, string>>, _prompt_version string"


def listing(spark: SparkSession, folder: str, pattern: str = "*", recursive: bool = True) -> DataFrame:
    """path, stem, property_id, length of the files, without archive litter. Contents aren't read."""
    df = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive)).option("pathGlobFilter", pattern).load(folder)
    stem = F.regexp_extract("path", r"([^/]+?)(?:\.[^./]*)?$", 1)
    real = ~F.col("path").rlike(r"__MACOSX") & ~F.regexp_extract("path", r"([^/]+)$", 1).startswith("._")
    return df.where(real).select("path", stem.alias("stem"), slug(stem, 60).alias("property_id"), "length", "modificationTime")


def first_paths(files: DataFrame) -> DataFrame:
    return files.groupBy("property_id").agg(F.min("path").alias("path"))


def records(spark: SparkSession, path: str) -> DataFrame:
    """Whole-file JSON records with a declared schema; what is missing is null, what is malformed has all null."""
    return spark.read.schema(RECORD).option("multiLine", True).option("mode", "PERMISSIVE").json(path).withColumn("source_file", F.col("_metadata.file_path"))


def cells(df: DataFrame, key: str = "source_file") -> DataFrame:
    """Long form of the property cells: key, field, value, page, snippet, confidence."""
    return df.select(key, F.explode("property").alias("field", "cell")).select(key, "field", "cell.*")


def csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)


def page_texts(spark: SparkSession, path: str, mark: str = "\f") -> DataFrame:
    """doc_id, page_no, text of plain-text files whose pages are parted by form feeds."""
    whole = spark.read.text(path, wholetext=True).select(F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+?)(?:\.[^./]*)?$", 1).alias("doc_id"), "value")
    return whole.select("doc_id", F.posexplode(F.split("value", mark)).alias("page_no", "text"))


def gold_labels(spark: SparkSession, path: str) -> DataFrame:
    """id, field, value of gold files: one JSON object each, named by its file, whose values are scalars (others as JSON)."""
    whole = spark.read.text(path, wholetext=True).select(F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+?)(?:\.[^./]*)?$", 1).alias("id"), "value")
    return whole.select("id", F.explode(F.from_json("value", "map<string,string>")).alias("field", "value"))
