"""Quality by weak supervision: rules vote good or bad or abstain, and expectation-maximisation weighs them.

Each rule looks at one style measure: up to one bound it votes good, beyond another bad, between them it abstains. How
often each combination of votes occurs is counted over all documents; these at most 3^rules counts go to the driver,
where EM estimates the share of good documents and each rule's rates of voting good or bad on good and on bad ones. The
posterior probability of each combination then decides: KEEP and more is kept.

Null, empty and blank texts have no words and fail the base rule; n_dup_lines and the other counts are 0 for them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import columns, prepare, table
from .features import NAMES, Measured

KEEP = 0.5
ROUNDS = 60
#: Rule's measure, bound up to which it votes good, bound from which it votes bad (the larger bound is the bad side if second).
RULES = (
    ("word_len", 7.0, 10.0), ("symbols_per_word", 0.02, 0.1), ("dup_line_share", 0.1, 0.5), ("repeat_word_share", 0.15, 0.4), ("adjacent_share", 0.05, 0.15),
    ("distinct_share", 0.35, 0.15), ("upper_share", 0.15, 0.4), ("bang_per_word", 0.05, 0.3), ("pipe_per_word", 0.02, 0.1), ("top_word_share", 0.2, 0.35),
)
_at = [NAMES.index(r[0]) for r in RULES]


def votes(values: list[float]) -> str:
    """A character a rule: + good, - bad, 0 abstains."""
    out = ""
    for i, (_, good, bad) in zip(_at, RULES, strict=True):
        v, sign = values[i], 1 if bad > good else -1
        out += "+" if v * sign <= good * sign else "-" if v * sign >= bad * sign else "0"
    return out


COLUMNS = (("n_words", pa.int64()), ("word_chars", pa.int64()), ("n_symbols", pa.int64()), ("n_dup_lines", pa.int64()), ("n_repeat_words", pa.int64()), ("votes", pa.string()))


def measure(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """The columns in keep with the base counts and the rules' votes."""
    prepare(docs.sparkSession)
    source = docs.select(*keep, F.col(text).alias("__text"))

    def each(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            rows = []
            for t in columns(batch, "__text")[0]:
                m = Measured(t)
                rows.append((m.n, m.word_chars, m.n_symbols, m.n_dup_lines, m.n_repeat_words, votes(m.values())))
            cols = zip(*rows, strict=True) if rows else [[]] * len(COLUMNS)
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(keep))), *(pa.array(list(c), type=t) for c, (_, t) in zip(cols, COLUMNS, strict=True))], names=[*keep, *(n for n, _ in COLUMNS)])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields[:-1]), *(f"{n} {'string' if t == pa.string() else 'long'}" for n, t in COLUMNS)])
    return source.mapInArrow(each, schema)


def posteriors(counts: dict[str, int], rounds: int = ROUNDS) -> dict[str, float]:
    """Probability of good for each combination of votes, by EM over their counts."""
    if not counts:
        return {}
    patterns = sorted(counts)
    n = np.array([counts[p] for p in patterns], dtype=float)
    v = np.array([[[c == k for k in "+-0"] for c in p] for p in patterns], dtype=float)
    good = np.where(v[:, :, 1].any(axis=1), 0.1, 0.95)
    for _ in range(rounds):
        share = np.clip((n * good).sum() / n.sum(), 0.02, 0.98)
        rates = []
        for w, prior in ((n * good, (8.0, 0.02, 2.0)), (n * (1 - good), (1.0, 1.0, 1.0))):
            c = np.einsum("p,prk->rk", w, v) + np.array(prior)
            rates.append(np.log(c / c.sum(axis=1, keepdims=True)))
        logit = np.log(share / (1 - share)) + np.einsum("prk,rk->p", v, rates[0] - rates[1])
        good = 1 / (1 + np.exp(-np.clip(logit, -40, 40)))
    return dict(zip(patterns, good.tolist(), strict=True))


def judge(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """The columns in keep with base counts, quality_probability, base_failed and kept."""
    spark = docs.sparkSession
    m = measure(docs, keep, text).checkpoint()  # the votes are read twice; they are a small part of the texts
    counts = {r["votes"]: r["count"] for r in m.groupBy("votes").count().collect()}
    known = spark.createDataFrame(sorted(posteriors(counts).items()), "votes string, quality_probability double")
    assert len(counts) <= 3 ** len(RULES)
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    found = m.join(F.broadcast(known), "votes", "left").withColumn("base_failed", failed)
    return found.withColumn("kept", ~F.col("base_failed") & (F.col("quality_probability") >= KEEP)).drop("votes")


def query(spark, sf_dir: str) -> DataFrame:
    found = judge(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "quality_probability")
