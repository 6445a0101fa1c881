"""Language identification by rank-order profiles.

A profile is the list of the PROFILE most frequent n-grams (one to three letters inside words, words padded by one
space at either side, lower case) of a language, by falling count. A text's own list is compared with each profile:
each of its n-grams adds how far it is out of place there, or PROFILE if it is missing. The language with the smallest
sum is predicted; the score is 1 - sum / (largest possible sum). Ties go to the language that sorts first.

Counts cover every training document: workers emit partial counts, which are summed before a rank is taken.
Null texts and texts without a letter are ``und`` with score 0; so are all texts if nothing could be learned.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import columns, free, prepare, table

PROFILE = 400  # n-grams of a profile
FLUSH = 400_000  # distinct n-grams held by a worker before it emits its counts
SALTS = 16  # parts that rank a language's n-grams before the last ranking
_letters: list[np.ndarray] = []


def letters() -> np.ndarray:
    """For each code point whether it is a letter."""
    if not _letters:
        _letters.append(np.array([chr(i).isalpha() for i in range(0x110000)], dtype=bool))
    return _letters[0]


def grams(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the text's n-grams in order, each once, and their counts. 21 bits hold a code point; 0 stands for a word's edge."""
    c = np.frombuffer((text or "").lower().encode("utf-32-le"), dtype=np.uint32)
    x = np.zeros(len(c) + 2, dtype=np.int64)
    x[1:-1] = np.where(letters()[c], c, 0)
    x = x[np.append(True, (x[1:] != 0) | (x[:-1] != 0))]
    if len(x) < 3:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    two = x[:-1] << 21 | x[1:]
    three = two[:-1] << 21 | x[2:]
    all_ = np.concatenate([x[x != 0], two | 1 << 62, three[x[1:-1] != 0] if len(x) > 2 else three[:0]])
    all_.sort()
    first = np.flatnonzero(np.append(True, all_[1:] != all_[:-1]))
    return all_[first], np.diff(np.append(first, len(all_)))


def top(codes: np.ndarray, counts: np.ndarray, n: int) -> np.ndarray:
    """The n most frequent codes by falling count, ties by code."""
    return codes[np.argsort(-counts, kind="stable")[:n]]


def learn(docs: DataFrame, lang: str = "lang", text: str = "text", size: int = PROFILE) -> dict[str, list[int]]:
    """Profiles of the languages in the labelled documents. What comes to the driver is SALTS * size n-grams a language."""
    prepare(docs.sparkSession)
    source = docs.where(F.col(lang).isNotNull()).select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"))

    def count(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = defaultdict(list)
        n = 0

        def flush() -> Iterator[pa.RecordBatch]:
            for lang, parts in held.items():
                codes, counts = merged(parts)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(codes), type=pa.string()), pa.array(codes), pa.array(counts)], names=["lang", "gram", "n"])
            held.clear()

        for batch in it:
            for lang, text in zip(*columns(batch, "lang", "text"), strict=True):
                codes, counts = grams(text)
                if len(codes):
                    held[lang].append((codes, counts))
                    n += len(codes)
                if n > 4 * FLUSH:
                    for k, parts in held.items():
                        held[k] = [merged(parts)]
                    n = sum(len(p[0][0]) for p in held.values())
                    if n > FLUSH:
                        yield from flush()
                        n = 0
        yield from flush()

    counts = source.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    salted = counts.withColumn("salt", F.pmod(F.hash("gram"), F.lit(SALTS)))
    w = Window.partitionBy("lang", "salt").orderBy(F.col("n").desc(), "gram")
    rows = salted.withColumn("r", F.row_number().over(w)).where(F.col("r") <= size).select("lang", "gram", "n").collect()
    by: dict[str, list] = defaultdict(list)
    for r in rows:
        by[r["lang"]].append((-r["n"], r["gram"]))
    return {k: [g for _, g in sorted(v)[:size]] for k, v in sorted(by.items())}


def merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    codes, counts = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
    order = np.argsort(codes, kind="stable")
    codes, counts = codes[order], counts[order]
    first = np.flatnonzero(np.append(True, codes[1:] != codes[:-1]))
    return codes[first], np.add.reduceat(counts, first)


class Model:
    """Profiles laid out for lookups: sorted codes and, for each language, their ranks."""

    def __init__(self, profiles: dict[str, list[int]], size: int = PROFILE):
        self.langs, self.size = sorted(profiles), size
        self.codes = np.unique(np.array([g for p in profiles.values() for g in p], dtype=np.int64))
        self.ranks = np.full((len(self.codes) + 1, len(self.langs)), -1, dtype=np.int64)
        for k, lang in enumerate(self.langs):
            self.ranks[np.searchsorted(self.codes, profiles[lang]), k] = np.arange(len(profiles[lang]))

    def predict(self, text: str | None) -> tuple[str, float]:
        codes, counts = grams(text)
        if not len(codes) or not self.langs:
            return "und", 0.0
        own = top(codes, counts, self.size)
        at = np.searchsorted(self.codes, own)
        at[at == len(self.codes)] = 0
        ranks = self.ranks[np.where(self.codes[at] == own, at, len(self.codes))]
        out = np.where(ranks < 0, self.size, np.abs(ranks - np.arange(len(own))[:, None])).sum(axis=0)
        k = int(out.argmin())
        return self.langs[k], float(1 - out[k] / (self.size * len(own)))


def predict(docs: DataFrame, profiles: dict[str, list[int]], text: str = "text", size: int = PROFILE, pred: str = "lang_pred", score: str = "lang_score") -> DataFrame:
    """The documents with two more columns, pred and score; columns of these names are replaced."""
    prepare(docs.sparkSession)
    model = Model(profiles, size)

    @F.arrow_udf("struct<p string, s double>")
    def identify(texts: pa.Array) -> pa.Array:
        found = [model.predict(t) for t in texts.to_pylist()]
        return pa.StructArray.from_arrays([pa.array([p for p, _ in found], type=pa.string()), pa.array([s for _, s in found], type=pa.float64())], names=["p", "s"])

    rest = [c for c in docs.columns if c not in (pred, score)]
    both = free(docs, "lang_both")
    return docs.withColumn(both, identify(F.col(text))).select(*(F.col(f"`{c}`") for c in rest), F.col(f"{both}.p").alias(pred), F.col(f"{both}.s").alias(score))


def held_out():
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) == 2


def query(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    profiles = learn(docs.where(~held_out()))
    found = predict(docs.select("doc_id", "text"), profiles)
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", F.col("lang_score").alias("score"))
