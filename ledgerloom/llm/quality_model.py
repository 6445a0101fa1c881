"""Quality classifier by positive-unlabelled learning.

Trusted positives are training documents labelled 1; all training documents are the unlabelled web text. The model is
linear in a piecewise-constant basis: each style measure falls into one of the bins between its CUTS. With squared loss
the non-negative unbiased risk

    prior * E_p[l(f, 1)] + max(0, E_u[l(f, -1)] - prior * E_p[l(f, -1)])

depends on the data by first and second moments alone. Workers sum these over all training documents (no sample is
drawn), Spark adds the sums by cell, and the driver, which gets a fixed number of cells, minimises the risk: the unbiased
minimum in closed form, then descent with the correction wherever the negative part is below zero. The class prior is
estimated from the same moments (Elkan and Noto, 2008): a least-squares model of which documents are trusted, its mean over the
trusted ones as the share of positives that are trusted, and the trusted documents' share divided by it. Labels of 0 are never used. f estimates 2 P(1 | text) - 1; the score is (1 + f) / 2.

Null and empty texts have all measures 0 and get the score of that bin. Without a trusted positive the score is 0.5 for
every text. A document labelled more than once is positive only if all its labels are 1.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import columns, prepare, table
from .features import NAMES, Measured

RIDGE = 1e-4
STEPS = 400
THRESHOLD = 0.3
#: Fixed bounds of the bins, by measure.
CUTS = {
    "log_words": (0.1, 1.5, 2.5, 3.5, 4.5, 5.5, 6.5, 8), "word_len": (2, 3.5, 4.2, 4.6, 5.5, 6.2, 7, 8.5), "symbols_per_word": (0.001, 0.02, 0.05, 0.1, 0.3, 1, 2),
    "dup_line_share": (0.001, 0.1, 0.25, 0.5, 0.75), "repeat_word_share": (0.001, 0.05, 0.1, 0.2, 0.4, 0.6, 0.9), "adjacent_share": (0.001, 0.02, 0.05, 0.1, 0.3, 0.6),
    "distinct_share": (0.05, 0.15, 0.3, 0.45, 0.6, 0.7, 0.8, 0.95), "upper_share": (0.005, 0.03, 0.06, 0.15, 0.4, 0.8), "bang_per_word": (0.001, 0.05, 0.2, 0.6, 1.5),
    "pipe_per_word": (0.001, 0.03, 0.1, 0.2, 0.35), "words_per_line": (0.7, 1.5, 2.5, 3.2, 4, 5, 6), "ended_lines": (0.01, 0.25, 0.5, 0.7, 0.9, 0.999),
    "comma_per_word": (0.001, 0.02, 0.05, 0.08, 0.12, 0.2), "digit_share": (0.001, 0.01, 0.05, 0.2, 0.5), "top_word_share": (0.03, 0.05, 0.08, 0.15, 0.25, 0.4, 0.7),
}
_offsets = np.cumsum([0, *(len(CUTS[n]) + 1 for n in NAMES)])
DIM = int(_offsets[-1]) + 1


def bins(text: str | None) -> list[int]:
    """The positions of the basis that are 1 for the text, besides the constant."""
    return [int(o + np.searchsorted(CUTS[n], v, side="right")) for n, o, v in zip(NAMES, _offsets, Measured(text).values(), strict=False)]


def featurize(docs: DataFrame, text: str = "text") -> DataFrame:
    prepare(docs.sparkSession)
    source = docs.select("doc_id", F.col(text).alias("__text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    cuts = [np.array(CUTS[n]) for n in NAMES]

    def each(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            values = np.array([Measured(t).values() for t in columns(batch, "__text")[0]]).reshape(-1, len(NAMES))
            at = [(o + np.searchsorted(c, values[:, i], side="right")) for i, (c, o) in enumerate(zip(cuts, _offsets, strict=False))]
            flat = pa.array(np.stack(at, axis=1).astype(np.int16).ravel())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(pa.array(np.arange(len(values) + 1, dtype=np.int32) * len(NAMES)), flat)], names=["doc_id", "bins"])

    return source.mapInArrow(each, f"doc_id {kind}, bins array<smallint>")


def _dense(lists: list[list[int]]) -> np.ndarray:
    x = np.zeros((len(lists), DIM))
    x[np.repeat(np.arange(len(lists)), len(NAMES)), np.array(lists).ravel()] = 1
    x[:, -1] = 1
    return x


def moments(rows: DataFrame) -> tuple[np.ndarray, np.ndarray, int, int]:
    """bins, positive -> second moments of the unlabelled (sum), first moments of the positives (sum), their numbers."""

    def each(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, p, seen = np.zeros((DIM, DIM)), np.zeros(DIM), 0
        for batch in it:
            lists, positive = columns(batch, "bins", "positive")
            x = _dense(lists)
            a += x.T @ x
            p += x[np.array(positive, dtype=bool)].sum(axis=0)
            seen += len(lists)
        if seen:
            u = np.triu(a)
            at = np.flatnonzero(u)
            hit = np.flatnonzero(p)
            cells = np.concatenate([at, DIM * DIM + hit])
            yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(np.concatenate([u.ravel()[at], p[hit]]))], names=["cell", "v"])

    out = np.zeros(DIM * DIM + DIM)
    for r in rows.mapInArrow(each, "cell long, v double").groupBy("cell").agg(F.sum("v").alias("v")).collect():
        out[r["cell"]] = r["v"]
    upper, p = out[: DIM * DIM].reshape(DIM, DIM), out[DIM * DIM :]
    return upper + np.triu(upper, 1).T, p, int(upper[-1, -1]), int(p[-1])


def inverted(h: np.ndarray) -> np.ndarray:
    """Inverse of a small positive definite matrix by elimination; no threaded library call on a busy driver."""
    n = len(h)
    x = np.hstack([h, np.eye(n)])
    for k in range(n):
        x[k] /= x[k, k]
        rest = x[:, k].copy()
        rest[k] = 0
        x -= rest[:, None] * x[k]
    return x[:, n:]


def minimise(a: np.ndarray, p: np.ndarray, n_u: int, n_p: int, a_p: np.ndarray | None, prior: float) -> np.ndarray:
    """Weights of least non-negative risk. a_p: second moments of the positives (mean), for the corrected part."""
    if not n_p or not n_u:
        return np.zeros(DIM)
    a_u, m_u, m_p = a / n_u, a[:, -1] / n_u, p / n_p
    h = a_u + RIDGE * np.eye(DIM)
    inverse = inverted(h)
    w = inverse @ (2 * prior * m_p - m_u)
    if a_p is None:
        return w
    for _ in range(STEPS):
        negative = (w @ a_u @ w + 2 * w @ m_u + 1) / 4 - prior * (w @ a_p @ w + 2 * w @ m_p + 1) / 4
        g_minus = (a_u @ w + m_u) / 2 - prior * (a_p @ w + m_p) / 2
        g_plus = prior * (a_p @ w - m_p) / 2
        step = g_plus + g_minus + RIDGE * w / 2 if negative >= 0 else -g_minus
        w = w - 0.1 * inverse @ step
    return w


def class_prior(a: np.ndarray, p: np.ndarray, n_u: int, n_p: int) -> float:
    """The share of positives among all documents, if the trusted ones are drawn from the positives alike: 0.01 to 0.99."""
    if not n_p or not n_u:
        return 0.5
    trusted = inverted(a / n_u + RIDGE * np.eye(DIM)) @ (p / n_u)
    return float(min(0.99, max(0.01, (n_p / n_u) / max(1e-6, trusted @ (p / n_p)))))


def train(bins_: DataFrame, labels: DataFrame) -> np.ndarray:
    """Weights learned from the training rows' bins (doc_id, bins) and labels (doc_id, quality)."""
    known = labels.where(F.col("quality").isNotNull()).groupBy("doc_id").agg((F.min("quality") == 1).alias("positive"))
    rows = bins_.join(known, "doc_id", "left")
    a, p, n_u, n_p = moments(rows.select("bins", F.coalesce("positive", F.lit(False)).alias("positive")))
    a_pos, _, n_pos, _ = moments(rows.where("positive").select("bins", F.lit(True).alias("positive")))
    return minimise(a, p, n_u, n_p, a_pos / n_pos if n_pos else None, class_prior(a, p, n_u, n_p))


def score(bins_: DataFrame, weights: np.ndarray) -> DataFrame:
    """doc_id, score. The weights are a literal of DIM numbers."""
    w = F.array(*(F.lit(float(x)) for x in weights[:-1]))
    f = F.aggregate("bins", F.lit(float(weights[-1])), lambda acc, b: acc + F.get(w, b.cast("int")))
    return bins_.withColumn("score", F.greatest(F.lit(0.0), F.least(F.lit(1.0), (1 + f) / 2)))


def held_out():
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) == 0


def query(spark, sf_dir: str) -> DataFrame:
    found = featurize(table(spark, sf_dir, "documents")).checkpoint()  # read three times; a few bytes a document
    weights = train(found.where(~held_out()), table(spark, sf_dir, "labels").where(~held_out()).select("doc_id", "quality"))
    return score(found, weights).select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
