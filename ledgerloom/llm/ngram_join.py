"""N-gram Jaccard join: blocks of a sparse document by n-gram product, with bounds that follow from the sizes.

Each document is the set of hashes of its distinct n-grams of words. Documents with equal sets form a class, whose
smallest doc_id stands for it. Two sets of sizes s and t with similarity of 80 % differ in at most (s + t) / 9 elements.
So within a class of sizes the range of hashes is cut into more segments than that bound, and two linked sets must have
an equal segment. N-grams that very many documents hold are left out of the segments, which makes sets differ less, not
more; slack segments see to it that a segment which isn't empty is among the equal ones, and sets with too many empty
segments also give their prefix (rare n-grams first), as such pairs share an element of it. Documents with an equal
segment (or prefix element) form a block; no pair of linked documents is lost, whatever the size of a block.

The same count says how many blocks a document must share with whatever it links with: all segments less the bound and
less its empty ones. A key carries that number in its low bits. Documents that share fewer blocks with all others
together leave them, which frees blocks of one common passage without looking at a pair.

In each block left the smallest doc_id is the hub, and each document is held against the hub that it shares most blocks
with: overlaps are counted as a product of the incidence rows with the hub's row, after the size bound. Components of the
links follow. Then blocks count only where they hold several components, and documents leave them by the same rule. In
each family left the documents outside its commonest component are held against all its documents, block by block where
that takes fewer pairs: parity sketches first (bit i says whether the number of hashes that fall on i is odd, so that two
sets differ in at least as many elements as their sketches in bits), then the overlap itself, skipping connected pairs.

Null, empty and blank texts have no n-grams and link with nothing; texts of fewer than n words are one n-gram.
Repeated doc_ids with one text are one document. Columns beside doc_id and text are not read.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import columns, mix, prepare, remove, sequences, shuffle_partitions, small, table, tidy, written
from .components import components

WORDS = 5
#: Similarity in percent. The bounds below follow from it.
PERCENT = 80
ASK_BYTES, WIDE_BYTES = 2 << 20, 16 << 20  # texts of documents that ask, and of documents asked, in one task
BITS = 8  # of a sketch, for an element
FREQUENT, SHARE = 200_000, 0.0002  # frequent n-grams at most; share of the documents from which one is frequent
MEMBERS = 128  # documents that one task holds against a hub
RATIO = 1.5  # between the size classes
SLACK = 0.12  # share of additional segments


def _bounds(top: int = 1 << 40) -> np.ndarray:
    """First size of each size class."""
    out = [1]
    while out[-1] < top:
        out.append(max(out[-1] + 1, int(out[-1] * RATIO)))
    return np.array(out, dtype=np.int64)


LOW = _bounds()
_high = np.append(LOW[1:] - 1, LOW[-1] * 2)
#: By size class: the most elements in which a linked pair whose smaller set is in the class can differ, and the segments.
DIFFER = (_high + _high * 100 // PERCENT) * (100 - PERCENT) // (100 + PERCENT)
SEGMENTS = np.where(DIFFER == 0, 1, DIFFER + 1 + np.ceil(SLACK * DIFFER).astype(np.int64) + 1)


class Sets:
    """Sorted hash sets of a batch of texts, concatenated."""

    def __init__(self, texts: list[str | None], words: int = WORDS):
        x, at = sequences(texts, words)
        for i, j in pairwise(at.tolist()):
            x[i:j].sort()
        new = np.append(True, x[1:] != x[:-1]) if len(x) else np.zeros(0, dtype=bool)
        new[at[:-1][at[:-1] < at[1:]]] = True
        self.all = x[new]
        self.at = np.append(0, np.cumsum(new))[at]
        self.sizes = np.diff(self.at)

    def sums(self, salt: int) -> np.ndarray:
        """An order-free 64-bit fingerprint of each set."""
        run = np.append(np.uint64(0), np.cumsum(mix(self.all ^ np.uint64(salt)), dtype=np.uint64))
        return (run[self.at[1:]] - run[self.at[:-1]]).view(np.int64)


#: Low bits of a key: the parity of its size class, and above it the blocks that its document must share there, 511 at most.
LOW_BITS, NEED = 10, 511


def _packed(keys: np.ndarray, need: np.ndarray | int, c: np.ndarray | int) -> np.ndarray:
    return (keys & ~np.uint64((1 << LOW_BITS) - 1)) | (np.uint64(2) * np.asarray(need, dtype=np.uint64)) | (np.asarray(c, dtype=np.uint64) & np.uint64(1))


def signatures(s: Sets, frequent: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Block keys of the sets and the position of each key's set. frequent: sorted hashes that segments leave out."""
    keys, owners = [], []
    own = np.searchsorted(LOW, np.maximum(s.sizes, 1), side="right") - 1
    doc = np.repeat(np.arange(len(s.sizes)), s.sizes)
    mixed = mix(s.all ^ np.uint64(0xA5A5))
    rare = ~_in(s.all, frequent)
    for step in (0, 1):
        c = own - step
        # the next smaller class holds partners only if the smallest size that may link with this one lies in it
        use = (s.sizes > 0) & (c >= 0) & ((step == 0) | (s.sizes * PERCENT <= 100 * (LOW[own] - 1)))
        if not use.any():
            continue
        c = np.maximum(c, 0)
        mask = use[doc] & (rare | (DIFFER[c] == 0)[doc])
        d, h, m = doc[mask], s.all[mask], mixed[mask]
        k = SEGMENTS[c].astype(np.uint64)
        seg = ((h >> np.uint64(32)) * k[d]) >> np.uint64(32)
        first = np.flatnonzero(np.append(True, (d[1:] != d[:-1]) | (seg[1:] != seg[:-1]))) if len(d) else np.zeros(0, dtype=np.int64)
        of = d[first]
        empty = SEGMENTS[c] - np.bincount(of, minlength=len(s.sizes))
        need = np.clip(SEGMENTS[c] - DIFFER[c] - empty, 1, NEED)
        if len(of):
            tag = mix(c[of].astype(np.uint64) << np.uint64(40) | seg[first])
            keys.append(_packed(mix(np.add.reduceat(m, first) ^ tag), need[of], c[of]))
            owners.append(of)
        poor = np.flatnonzero(use & (DIFFER[c] > 0) & (empty >= SEGMENTS[c] - DIFFER[c]))
        for i in poor.tolist():
            n, x, r = int(s.sizes[i]), s.all[s.at[i] : s.at[i + 1]], rare[s.at[i] : s.at[i + 1]]
            prefix = np.concatenate([x[r], x[~r]])[: n - -(-PERCENT * n // 100) + 1]
            keys.append(_packed(mix(prefix ^ mix(np.array([int(c[i]) << 40 | 0xFFFFFFFFFF], dtype=np.uint64))), 1, int(c[i])))
            owners.append(np.full(len(prefix), i))
    if not keys:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    return np.concatenate(keys).view(np.int64), np.concatenate(owners)


def _in(x: np.ndarray, table: np.ndarray) -> np.ndarray:
    if not len(table):
        return np.zeros(len(x), dtype=bool)
    at = np.searchsorted(table, x)
    at[at == len(table)] = 0
    return table[at] == x


def _fingerprints(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row a document, and n-grams that occur twice or more in a run of documents with their counts, on the run's first row."""
    for batch in small(it):
        s = Sets(columns(batch, "text")[0])
        x = np.sort(s.all)
        first = np.flatnonzero(np.append(True, x[1:] != x[:-1])) if len(x) else np.zeros(0, dtype=np.int64)
        count = np.diff(np.append(first, len(x)))
        often = [(g, c) for g, c in zip(x[first][count > 1].view(np.int64).tolist(), count[count > 1].tolist(), strict=True)]
        lists = [[{"g": g, "c": c} for g, c in often], *[None] * (batch.num_rows - 1)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(s.sizes), pa.array(s.sums(1)), pa.array(s.sums(2)), pa.array(lists, type=pa.list_(pa.struct([("g", pa.int64()), ("c", pa.int64())])))], names=["doc_id", "n", "f1", "f2", "often"])


def _entries(frequent: np.ndarray):
    def each(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Block keys of each set that this task hasn't met; equal sets are one class anyway."""
        met = set()
        for batch in small(it):
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            s = Sets(columns(batch, "text")[0])
            keep = []
            for f in zip(s.sums(1).tolist(), s.sums(2).tolist(), strict=True):
                keep.append(f not in met)
                if len(met) < 300_000:
                    met.add(f)
            keys, owners = signatures(s, frequent)
            mask = np.array(keep, dtype=bool)[owners] if len(owners) else np.zeros(0, dtype=bool)
            yield pa.RecordBatch.from_arrays([pa.array(keys[mask]), pa.array(ids[owners[mask]].astype(np.int64))], names=["key", "doc_id"])

    return each


def _shared(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by key, those whose key has another row. Holds a batch and one row."""
    last: tuple[int, int, bool] | None = None
    for batch in it:
        key, doc = (batch.column(i).to_numpy() for i in (0, 1))
        if last:
            key, doc = np.append(last[0], key), np.append(last[1], doc)
        if not len(key):
            continue
        same = (key[1:] ^ key[:-1]).view(np.uint64) < np.uint64(1 << LOW_BITS)
        hit = np.append(last[2] if last else False, same) | np.append(same, False)
        last = int(key[-1]), int(doc[-1]), bool(hit[-1])
        yield pa.RecordBatch.from_arrays([pa.array(key[:-1][hit[:-1]]), pa.array(doc[:-1][hit[:-1]])], names=["key", "doc_id"])
    if last and last[2]:
        yield pa.RecordBatch.from_arrays([pa.array([last[0]]), pa.array([last[1]])], names=["key", "doc_id"])


def _several(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by key and document, each once, and only where the key has another document. Holds a batch and one row."""
    last: tuple[int, int, bool] | None = None
    for batch in it:
        key, doc = (batch.column(i).to_numpy() for i in (0, 1))
        if last:
            key, doc = np.append(last[0], key), np.append(last[1], doc)
        if not len(key):
            continue
        again = (key[1:] == key[:-1]) & (doc[1:] == doc[:-1])
        first = np.append(True, ~again)
        key, doc = key[first], doc[first]
        same = (key[1:] ^ key[:-1]).view(np.uint64) < np.uint64(1 << LOW_BITS)
        hit = np.append(last[2] if last else False, same) | np.append(same, False)
        last = int(key[-1]), int(doc[-1]), bool(hit[-1])
        yield pa.RecordBatch.from_arrays([pa.array(key[:-1][hit[:-1]]), pa.array(doc[:-1][hit[:-1]])], names=["key", "rep"])
    if last and last[2]:
        yield pa.RecordBatch.from_arrays([pa.array([last[0]]), pa.array([last[1]])], names=["key", "rep"])


def _enough(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by document and parity, those of which there are as many as a link takes. Holds a batch and the rows of one document."""
    held = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)

    def enough(key: np.ndarray, doc: np.ndarray) -> pa.RecordBatch:
        parity = key & 1
        first = np.flatnonzero(np.append(True, (doc[1:] != doc[:-1]) | (parity[1:] != parity[:-1]))) if len(doc) else np.zeros(0, dtype=np.int64)
        n = np.diff(np.append(first, len(doc)))
        keep = np.repeat(n >= (key[first] & ((1 << LOW_BITS) - 1)) >> 1, n)
        return pa.RecordBatch.from_arrays([pa.array(key[keep]), pa.array(doc[keep])], names=["key", "rep"])

    for batch in it:
        key, doc = (np.append(x, batch.column(i).to_numpy()) for i, x in enumerate(held))
        cut = int(np.searchsorted(doc, doc[-1])) if len(doc) else 0
        held = key[cut:], doc[cut:]
        yield enough(key[:cut], doc[:cut])
    yield enough(*held)


def linked(overlap: np.ndarray, s: np.ndarray, t: np.ndarray | int) -> np.ndarray:
    return 100 * overlap >= PERCENT * (s + t - overlap)


def _against_hub(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by hub and salt, the hub's own first: the pairs that link. A run is multiplied with the hub's row at once."""
    row, current = np.zeros(0, dtype=np.uint64), None
    for batch in small(it):
        ids, hubs, salts = (batch.column(i).to_numpy() for i in range(3))
        s, out = Sets(columns(batch, "text")[0]), np.zeros(batch.num_rows, dtype=bool)
        cuts = np.flatnonzero(np.append(True, (hubs[1:] != hubs[:-1]) | (salts[1:] != salts[:-1]))).tolist() if len(hubs) else []
        for i, j in pairwise([*cuts, len(ids)]):
            if current != (hubs[i], salts[i]):
                current, row = (hubs[i], salts[i]), s.all[s.at[i] : s.at[i + 1]] if ids[i] == hubs[i] else row[:0]
            if not len(row):
                continue
            sizes = s.sizes[i:j]
            fit = (sizes * 100 >= len(row) * PERCENT) & (len(row) * 100 >= sizes * PERCENT) & (ids[i:j] != hubs[i])
            if fit.any():
                x = s.all[s.at[i] : s.at[j]]
                pos = np.searchsorted(row, x)
                pos[pos == len(row)] = 0
                run = np.append(0, np.cumsum(row[pos] == x))
                o = run[s.at[i + 1 : j + 1] - s.at[i]] - run[s.at[i:j] - s.at[i]]
                out[i:j] = fit & linked(o, sizes, len(row))
        yield pa.RecordBatch.from_arrays([pa.array(ids[out]), pa.array(hubs[out])], names=["a", "b"])


def sketch(x: np.ndarray) -> bytes:
    """The parities of the hashes' numbers by their low bits; a power of two of them, at least 64."""
    bits = 64
    while bits < BITS * len(x):
        bits *= 2
    return np.packbits(np.bincount((x & np.uint64(bits - 1)).astype(np.int64), minlength=bits).astype(np.uint8) & 1, bitorder="little").tobytes()


def product(ids: list[int], sets: list[np.ndarray], asks: np.ndarray, asked: np.ndarray, component: np.ndarray) -> list[tuple[int, int]]:
    """Links that join components, between rows that ask and rows that are asked, the nearest by their sketches first.

    Two rows that are both of both kinds meet once. Linked sizes differ by a factor below two, so sketches do by two at most, and the longer one folds.
    """
    sketches, sizes = [sketch(x) for x in sets], np.array([len(x) for x in sets])
    words, out = np.array([len(x) // 8 for x in sketches]), []
    root = np.unique(component, return_inverse=True)[1]
    met = np.zeros(len(ids), dtype=bool)
    for width in np.unique(words).tolist():
        same, twice = np.flatnonzero(words == width), np.flatnonzero(words == 2 * width)
        one = np.frombuffer(b"".join(sketches[i] for i in same), dtype=np.uint64).reshape(len(same), width)
        two = np.frombuffer(b"".join(sketches[i] for i in twice), dtype=np.uint64).reshape(len(twice), 2, width)
        rows, at = np.concatenate([one, two[:, 0] ^ two[:, 1]]), np.append(same, twice)
        met[:] = False
        for k in np.flatnonzero(asks[at]).tolist():
            r = at[k]
            met[r] = asked[r]
            s, t = sizes[r], sizes[at]
            fit = (root[at] != root[r]) & asked[at] & ~met[at] & (100 * t >= PERCENT * s) & (PERCENT * t <= 100 * s)
            if words[r] != width:
                fit &= words[at] == width
            some, near = np.flatnonzero(fit), []
            for lo in range(0, len(some), step := max(1, 500_000 // width)):
                part = some[lo : lo + step]
                differ = np.bitwise_count(rows[part] ^ rows[k]).sum(axis=1, dtype=np.int64)
                fit = differ * (100 + PERCENT) <= (s + t[part]) * (100 - PERCENT)
                near += zip(differ[fit].tolist(), at[part[fit]].tolist(), strict=True)
            for _, q in sorted(near):
                if root[q] != root[r] and linked(np.isin(sets[r], sets[q], assume_unique=True).sum(), s, sizes[q]):
                    out.append((ids[r], ids[q]))
                    root[root == root[q]] = root[r]
    return out


def fingerprints(texts: DataFrame) -> DataFrame:
    prepare(texts.sparkSession)
    return texts.mapInArrow(_fingerprints, "doc_id long, n long, f1 long, f2 long, often array<struct<g:long,c:long>>").checkpoint()


def classes(every: DataFrame) -> DataFrame:
    """doc_id, n (size of the set), rep (smallest doc_id with an equal set; null for an empty set)."""
    some = every.where("n > 0").drop("often")
    reps = some.groupBy("f1", "f2", "n").agg(F.min("doc_id").alias("rep")).checkpoint()
    return some.join(reps, ["f1", "f2", "n"]).select("doc_id", "n", "rep").unionByName(every.where("n = 0").select("doc_id", "n", F.lit(None).cast("long").alias("rep"))).checkpoint()


def frequent_grams(every: DataFrame) -> np.ndarray:
    """N-grams that many documents hold: a hint that says what segments leave out. At most FREQUENT hashes.

    Leaving a fixed set of n-grams out of two sets can only make them differ less, so no link depends on the choice.
    """
    total = every.count()
    counts = every.where("often is not null").select(F.explode("often").alias("o")).groupBy("o.g").agg(F.sum("o.c").alias("c"))
    rows = counts.where(F.col("c") >= max(16, total * SHARE)).orderBy(F.col("c").desc(), "g").limit(FREQUENT).select("g").toArrow()
    return np.sort(rows.column(0).to_numpy().view(np.uint64))


def join(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, rep."""
    spark = prepare(docs.sparkSession)
    parts = shuffle_partitions(spark)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    every = fingerprints(texts)
    members = classes(every)
    entries = texts.mapInArrow(_entries(frequent_grams(every)), "key long, doc_id long").repartition(parts, F.shiftright("key", LOW_BITS)).sortWithinPartitions("key")
    met = entries.mapInArrow(_shared, "key long, doc_id long").checkpoint()
    tidy(spark)
    met = met.join(members.select("doc_id", "rep"), "doc_id").select("key", "rep")
    for _ in range(2):
        met = met.repartition(parts, F.shiftright("key", LOW_BITS)).sortWithinPartitions("key", "rep").mapInArrow(_several, "key long, rep long")
        met = met.repartition(parts, "rep").sortWithinPartitions("rep", F.col("key").bitwiseAND(F.lit(1))).mapInArrow(_enough, "key long, rep long").checkpoint()
        tidy(spark)
    low = F.col("key").bitwiseAND(F.lit((1 << LOW_BITS) - 1))
    blocks = met.select(F.shiftright("key", LOW_BITS).alias("key"), low.bitwiseAND(F.lit(1)).cast("byte").alias("parity"), F.shiftright(low, 1).cast("short").alias("need"), "rep")
    hubs = blocks.groupBy("key").agg(F.min("rep").alias("hub"), F.max("rep").alias("top")).where("hub < top").select("key", "hub").checkpoint()
    tidy(spark)
    pairs = blocks.join(hubs, "key").where("rep <> hub").groupBy("rep", "hub").agg(F.count("*").alias("blocks")).checkpoint()
    # each document is first held against the hub of most of its blocks
    best = pairs.groupBy("rep").agg(F.min(F.struct((-F.col("blocks")).alias("most"), "hub"))["hub"].alias("hub")).checkpoint()
    dealt = _dealt(best)
    # hubs that are no document's best and have no best themselves: the rest needs their texts
    lone = pairs.select(F.col("hub").alias("doc_id")).distinct().join(dealt.select("doc_id"), "doc_id", "left_anti").select("doc_id", F.col("doc_id").alias("hub"), F.lit(0).cast("long").alias("salt"), F.lit(True).alias("once"))
    path = f"{spark.sparkContext.getCheckpointDir()}/table-{uuid.uuid4().hex}"
    few = written(path, texts.join(dealt.unionByName(lone).checkpoint(), "doc_id").select("doc_id", "hub", "salt", "once", "text"))
    links = _links(few, parts)
    tidy(spark)
    found = components(links).checkpoint()
    more = _rest(blocks, best, found, few.where("once").select(F.col("doc_id").alias("rep"), "text"))
    tidy(spark)
    if not more.isEmpty():
        found = components(links.unionByName(more)).checkpoint()
    remove(spark, path)  # what follows reads checkpoints only
    out = members.join(found.withColumnRenamed("node", "rep"), "rep", "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "rep", "doc_id").alias("component_id"), "rep")


def _dealt(pairs: DataFrame) -> DataFrame:
    """doc_id, hub, salt: where the documents' texts go. A hub's documents (pairs: rep, hub) go to one task for each MEMBERS of them, the hub to each; once marks one row a document."""
    sizes = pairs.groupBy("hub").agg(F.ceil(F.count("*") / MEMBERS).cast("long").alias("salts")).checkpoint()
    asked = pairs.join(sizes, "hub").select(F.col("rep").alias("doc_id"), "hub", F.pmod(F.xxhash64("rep"), "salts").alias("salt"), F.lit(True).alias("once"))
    own = sizes.select(F.col("hub").alias("doc_id"), "hub", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1)).alias("salt"))
    own = own.join(pairs.select(F.col("rep").alias("doc_id"), F.lit(True).alias("also")).distinct(), "doc_id", "left").select("doc_id", "hub", "salt", (F.col("also").isNull() & (F.col("salt") == 0)).alias("once"))
    return asked.unionByName(own).checkpoint()


def _links(rows: DataFrame, parts: int) -> DataFrame:
    """The pairs that link, of documents with texts dealt to hubs."""
    rows = rows.select("doc_id", "hub", "salt", "text").repartition(parts, "hub", "salt").sortWithinPartitions("hub", "salt", F.col("doc_id") != F.col("hub"))
    return rows.mapInArrow(_against_hub, "a long, b long").checkpoint()


def _needed(blocks: DataFrame, by: str) -> DataFrame:
    """The blocks with several values of the column, and in them the documents that still have as many blocks as a link takes."""
    shared = blocks.groupBy("key").agg(F.min(by).alias("lo"), F.max(by).alias("hi")).where("lo < hi").select("key")
    some = blocks.join(shared, "key", "left_semi").checkpoint()
    enough = some.groupBy("rep", "parity").agg(F.count("*").alias("n"), F.max("need").alias("most")).where("n >= most").select("rep", "parity")
    return some.join(enough, ["rep", "parity"], "left_semi").checkpoint()


def _rest(blocks: DataFrame, best: DataFrame, found: DataFrame, few: DataFrame) -> DataFrame:
    """Links between components that the hubs left apart.

    Documents that blocks of several components connect, whether they link or not, are a family. It is held together as one,
    or its blocks are, whichever takes fewer pairs. Two documents alone of which one was held against the other are done.
    """
    placed = blocks.join(found.withColumnRenamed("node", "rep"), "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    placed = _needed(_needed(placed, "component"), "component")
    hubs = placed.groupBy("key").agg(F.min("rep").alias("hub"))
    edges = placed.join(hubs, "key").where("rep <> hub").select("rep", "hub").distinct().checkpoint()
    family = components(edges, "rep", "hub").select(F.col("node").alias("rep"), F.col("component").alias("family")).checkpoint()
    nodes = placed.select("rep", "component").distinct().join(family, "rep", "left").select("rep", "component", F.coalesce("family", "rep").alias("family"))
    nodes = nodes.join(few.select("rep", F.octet_length("text").alias("bytes")), "rep").checkpoint()
    held = best.select(F.col("rep").alias("top"), "hub", F.lit(2).cast("long").alias("m"))

    def apart(df: DataFrame, key: str, *also) -> DataFrame:
        """Groups of several components: the commonest, tasks for the documents outside it and for all, and the pairs that this makes."""
        per = df.groupBy(key, "component").agg(F.count("*").alias("c"), F.sum("bytes").alias("bytes"), F.min("rep").alias("lo"), F.max("rep").alias("hi"), F.sum(F.xxhash64("rep").cast("decimal(38,0)")).alias("sig"), F.min("family").alias("of"))
        of = per.groupBy(key).agg(F.max(F.struct("c", "component", "bytes")).alias("big"), F.sum("c").alias("m"), F.sum("bytes").alias("bytes"), F.count("*").alias("k"), F.min("lo").alias("hub"), F.max("hi").alias("top"), F.sum("sig").alias("sig"), F.min("of").alias("of"))
        tasks = lambda size, most: F.ceil(size / most).cast("long")
        of = of.where("k > 1").join(held, ["top", "hub", "m"], "left_anti").withColumn("pairs", ((F.col("m") - F.col("big.c")) * F.col("m")).cast("double"))
        return of.select(F.col(key).alias("key"), "of", "sig", "m", "pairs", F.col("big.component").alias("big"), tasks(F.col("bytes") - F.col("big.bytes"), ASK_BYTES).alias("is"), tasks(F.col("bytes"), WIDE_BYTES).alias("js"))

    whole = apart(nodes, "family").drop("of", "sig").checkpoint()
    large = placed.select("key", "rep").join(nodes.join(whole.where("m > 2").select(F.col("key").alias("family")), "family"), "rep").checkpoint()
    parts = apart(large, "key").groupBy("of", "sig", "m").agg(F.min(F.struct("key", "pairs", "big", "is", "js")).alias("x")).select("of", "x.*").checkpoint()  # blocks of the same documents are one
    cost = parts.groupBy(F.col("of").alias("key")).agg(F.sum("pairs").alias("otherwise"))
    whole = whole.join(cost, "key", "left").withColumn("one", F.coalesce(F.col("pairs") <= F.col("otherwise"), F.col("m") <= 2)).select("key", "big", "is", "js", "one").checkpoint()
    columns_ = ("kind", "key", "rep", "component", "big", "is", "js")
    rows = nodes.join(whole.where("one").withColumnRenamed("key", "family"), "family").withColumn("kind", F.lit(0)).withColumn("key", F.col("family")).select(*columns_)
    split = parts.join(whole.where("not one").select(F.col("key").alias("of")), "of", "left_semi").select("key", "big", "is", "js")
    rows = rows.unionByName(large.join(split, "key").withColumn("kind", F.lit(1)).select(*columns_)).withColumn("h", F.xxhash64("rep"))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), n - 1))
    asks = rows.where("component <> big").select("kind", "key", F.pmod("h", "is").alias("i"), every(F.col("js")).alias("j"), "rep", "component", F.lit(True).alias("asks"), F.lit(False).alias("asked"))
    asked = rows.select("kind", "key", every(F.col("is")).alias("i"), F.pmod("h", "js").alias("j"), "rep", "component", F.lit(False).alias("asks"), F.lit(True).alias("asked"))
    both = asks.unionByName(asked).groupBy("kind", "key", "i", "j", "rep", "component").agg(F.max("asks").alias("asks"), F.max("asked").alias("asked")).checkpoint()
    return few.join(both, "rep").groupBy("kind", "key", "i", "j").applyInArrow(_tile, "a long, b long").checkpoint()


def _tile(t: pa.Table) -> pa.Table:
    ids, asks, asked, component = (t.column(n).to_pylist() for n in ("rep", "asks", "asked", "component"))
    got = []
    if len(set(component)) > 1:
        s = Sets(t.column("text").to_pylist())
        got = product(ids, [s.all[s.at[i] : s.at[i + 1]] for i in range(len(ids))], np.array(asks), np.array(asked), np.array(component))
    return pa.table({"a": pa.array([x for x, _ in got], type=pa.int64()), "b": pa.array([x for _, x in got], type=pa.int64())})


def keep_one(docs: DataFrame) -> DataFrame:
    """The documents without those that have a smaller doc_id in their component; columns stay as they were. Rows without a
    doc_id can be in no component and stay."""
    gone = join(docs).where("doc_id <> component_id").select(F.col("doc_id").alias("__gone"))
    return docs.join(gone, docs["doc_id"].cast("long") == gone["__gone"], "left_anti")


def query(spark, sf_dir: str) -> DataFrame:
    return join(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")
