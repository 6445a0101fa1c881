"""From documents to token ids: language ID, near-duplicates, personal data, source mix, BPE.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again for the next.
All but the last return the columns of documents. Null texts have no language and go in the first stage.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import bpe, langid, mixing, ngram_join, pii
from ledgerloom.llm.common import free, prepare, remove

#: Texts whose best profile fits worse than this are no text of a learned language. The lowest score of the 10,000 documents at sf0.1 is 0.39 (one in a hundred is below 0.55).
LEAST_SCORE = 0.15
#: The ids, their digests and the digest of what they decode to can't be made in SQL.
ORACLE_SQL = None


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a learned language go: no letters, or prose that fits no profile. Null and empty texts go."""
    pred, score = free(docs, "pred"), free(docs, "score")
    found = langid.predict(docs, langid.learn(docs), pred=pred, score=score)
    return found.where((F.col(f"`{pred}`") != "und") & (F.col(f"`{score}`") >= LEAST_SCORE)).select(*(F.col(f"`{c}`") for c in docs.columns))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the smallest doc_id stays. Empty texts are in no group and stay, as do rows without a doc_id."""
    return ngram_join.keep_one(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows stay; spans in their texts become <KIND>, and n_chars follows. Null and empty texts stay as they are."""
    clean = pii.redact(docs)
    return clean.withColumn("n_chars", F.length("text").cast("long")).select(*(F.col(f"`{c}`") for c in docs.columns)) if "n_chars" in docs.columns else clean


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's rate says. Texts without words weigh nothing and follow their source's rate."""
    return mixing.apply(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, digests and ids of every row that came in, repeats included. Null and empty texts have no tokens."""
    import public_tokenizers

    return bpe.digest(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN, with_ids=True)


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("source_mix", source_mix),
    ("token_ids", token_ids),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    folder = f"{spark.sparkContext.getCheckpointDir()}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}-{name}")
        docs = spark.read.parquet(f"{folder}/{k}-{name}")
        if k:
            remove(spark, f"{folder}/{k - 1}-{STAGES[k - 1][0]}")
    return docs
