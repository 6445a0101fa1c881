"""Ranked lexical search over a clustered index, exact to the last tie.

Documents become a forward table (doc_id, number of terms, distinct terms as 64-bit hashes with their frequencies), from
which N, L and document frequencies are counted over all documents. Recursive graph bisection then reorders documents, so
that those with common terms come together: its upper levels are fitted on a bounded sample (SAMPLE documents, FEATURES
terms) and every document is routed down them; a range partitioning by leaf deals documents out evenly, however many
fall to one leaf; the lower levels run on every run of CHUNK documents. Runs of about CLUSTER documents become clusters: postings
by term with their impacts, and each term's greatest impact.

A query's bound in a cluster is the sum of its weights times those greatest impacts. First the SEEDS clusters of the
greatest bounds are visited for each query, all over the index; the k-th score found there is a floor. Then every task
visits, greatest bound first, those of its clusters whose bound reaches the floor or the k-th score held by then, and stops
at the rest: a cluster left out can't hold a document of the result, equal scores included. What tasks return are doc_ids,
so ties are in the order of doc_id whatever the index made of it. Queries are taken in blocks of bounded size.

Two different terms of one hash would be taken for one: of 10^9 terms in the documents and 10^4 in the queries that happens once in
10^6 runs. Null and empty texts have no terms and aren't counted in N. A null doc_id is a document like others and comes last
among equal scores (it shares that place with 2^63 - 1, which is given back as null). Rows that repeat a doc_id are
documents of their own; so are queries that repeat an item_id. Queries without terms that the documents have give no rows;
so do empty tables.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import columns, prepare, remove, shuffle_partitions, small, table, word_hashes
from .warc import new_folder

#: Bytes between terms: all of ASCII but digits and letters.
BETWEEN = np.array([b < 0x80 and not chr(b).isalnum() for b in range(256)])
#: The fitted tree: documents and terms it is fitted on at most (the sample may exceed its number by chance), its depth.
SAMPLE, FEATURES, DEPTH = 4096, 20_000, 6
#: Documents (and postings) of a run that is bisected at once, documents of a cluster, rounds of swaps on each level.
CHUNK, POSTINGS, CLUSTER, ROUNDS = 4096, 2_000_000, 128, 5
#: Terms of queries up to which an index is restricted to them (8 bytes each are broadcast); entries of a block of queries.
MOST_TERMS, BLOCK = 500_000, 200_000
SEEDS = 2
NONE = np.iinfo(np.int64).max

FORWARD = "doc_id long, n long, terms array<long>, tfs array<int>"
CLUSTERS = "id long, doc_ids array<long>, terms array<long>, ends array<int>, most array<int>, at array<int>, impact array<int>"


class Index(NamedTuple):
    """Tables in a folder (forward, df, clusters), the number of documents with a term, and of all their terms."""

    spark: SparkSession
    folder: str
    n_docs: int
    n_terms: int

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}")


def _counted(texts: list[str | None], only: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Terms of each text: their number with repeats, ends of its distinct terms (in order), those terms, their frequencies."""
    h, first = word_hashes(texts, BETWEEN)
    owner = np.repeat(np.arange(len(texts)), np.diff(first))
    h = h.view(np.int64)
    if only is not None:
        at = np.searchsorted(only, h)
        known = only[np.minimum(at, len(only) - 1)] == h if len(only) else np.zeros(len(h), dtype=bool)
        h, owner = h[known], owner[known]
    order = np.lexsort((h, owner))
    h, owner = h[order], owner[order]
    new = np.flatnonzero(np.append(True, (h[1:] != h[:-1]) | (owner[1:] != owner[:-1]))[: len(h)])
    ends = np.cumsum(np.bincount(owner[new], minlength=len(texts)))
    return np.diff(first), ends, h[new], np.diff(np.append(new, len(h)))


def _lists(ends: np.ndarray, values: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.append(0, ends), type=pa.int32()), pa.array(values, type=kind))


def forward(docs: DataFrame, only: np.ndarray | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n, terms, tfs of each row; n counts all terms, terms are those of only (sorted hashes) or all."""
    sc = prepare(docs.sparkSession).sparkContext
    kept = sc.broadcast(only)

    def each(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(it):
            (texts,) = columns(batch, "text")
            n, ends, terms, tfs = _counted(texts, kept.value)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, type=pa.int64()), _lists(ends, terms, pa.int64()), _lists(ends, tfs, pa.int32())], names=["doc_id", "n", "terms", "tfs"])

    return docs.select(F.col(f"`{key}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text")).mapInArrow(each, FORWARD)


# Recursive graph bisection (Dhulipala et al., 2016), all parts of a level at once


def _edges(n: int, level: int) -> np.ndarray:
    return (np.arange((1 << level) + 1) * n) >> level


def _cost(degree: np.ndarray, size: np.ndarray) -> np.ndarray:
    return degree * np.log2(size / (degree + 1.0))


def bisect(ends: np.ndarray, terms: np.ndarray, levels: int, rounds: int = ROUNDS) -> np.ndarray:
    """An order of documents (ends of their terms, and the terms, numbered from 0) in which those next to each other share terms.

    On each level every part is halved, and documents are swapped between the halves, the greatest gains first, as long as the
    two gains of a swap save something of the logarithmic gaps between a term's documents.
    """
    n = len(ends)
    order, owner = np.arange(n), np.repeat(np.arange(n), np.diff(ends, prepend=0))
    width = int(terms.max(initial=0)) + 1
    for level in range(levels):
        edges, mids = _edges(n, level), _edges(n, level + 1)[1::2]
        part_at = np.repeat(np.arange(1 << level), np.diff(edges))
        right_at = np.arange(n) >= mids[part_at]
        pairs = np.minimum(mids - edges[:-1], edges[1:] - mids)
        run = np.arange(pairs.sum()) - np.repeat(np.cumsum(pairs) - pairs, pairs)
        left_place, right_place = np.repeat(edges[:-1], pairs) + run, np.repeat(mids, pairs) + run
        place = np.empty(n, dtype=np.int64)
        place[order] = np.arange(n)
        part = part_at[place]
        slots, slot = np.unique(part[owner] * width + terms, return_inverse=True)
        of = slots // width
        left_size, right_size = np.maximum(mids - edges[:-1], 1)[of], np.maximum(edges[1:] - mids, 1)[of]
        total = np.bincount(slot, minlength=len(slots))
        for _ in range(rounds):
            right = right_at[place]
            r = np.bincount(slot, weights=right[owner], minlength=len(slots))
            left = total - r
            now = _cost(left, left_size) + _cost(r, right_size)
            to_right = now - _cost(np.maximum(left - 1, 0), left_size) - _cost(r + 1, right_size)
            to_left = now - _cost(left + 1, left_size) - _cost(np.maximum(r - 1, 0), right_size)
            gain = np.bincount(owner, weights=np.where(right[owner], to_left[slot], to_right[slot]), minlength=n)
            order = np.lexsort((-gain, right, part))
            swap = gain[order[left_place]] + gain[order[right_place]] > 1e-9
            a, b = left_place[swap], right_place[swap]
            order[a], order[b] = order[b], order[a]
            place[order] = np.arange(n)
            if swap.sum() * 200 < n:
                break
    return order


class Tree(NamedTuple):
    """Terms of the sample, for each inner node (heap order) a weight of each, and the score above which a document goes left."""

    features: np.ndarray
    weights: np.ndarray
    least: np.ndarray


def fit(ends: np.ndarray, terms: np.ndarray, depth: int = DEPTH, most: int = FEATURES) -> Tree:
    """The tree of a bisected sample: a term pulls to the half that holds it more often; halves of the sample are even."""
    found, number, df = np.unique(terms, return_inverse=True, return_counts=True)
    use = np.sort(np.lexsort((found, -df))[:most])
    of = np.full(len(found), -1)
    of[use] = np.arange(len(use))
    kept = of[number] >= 0
    owner = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))[kept]
    number = of[number][kept]
    n = len(ends)
    order = bisect(np.cumsum(np.bincount(owner, minlength=n)), number, depth)
    place = np.empty(n, dtype=np.int64)
    place[order] = np.arange(n)
    weights, least = np.zeros(((1 << depth) - 1, len(use)), dtype=np.float32), np.zeros((1 << depth) - 1)
    for level in range(depth):
        part = np.searchsorted(_edges(n, level), place, side="right") - 1
        right = place >= _edges(n, level + 1)[1::2][part]
        shape = (1 << level, len(use))
        key = part[owner] * len(use) + number
        r = np.bincount(key, weights=right[owner], minlength=shape[0] * shape[1]).reshape(shape)
        both = np.bincount(key, minlength=shape[0] * shape[1]).reshape(shape)
        first = (1 << level) - 1
        weights[first : first + shape[0]] = np.log2((both - r + 1) / (r + 1))
        score = np.bincount(owner, weights=weights[first + part[owner], number], minlength=n)
        for p in range(shape[0]):
            least[first + p] = np.median(score[part == p]) if (part == p).any() else 0.0
    return Tree(found[use], weights, least)


def route(tree: Tree, ends: np.ndarray, terms: np.ndarray) -> np.ndarray:
    """The leaf of each document, leaves numbered from left to right."""
    n, depth = len(ends), len(tree.least).bit_length()
    owner = np.repeat(np.arange(n), np.diff(ends, prepend=0))
    at = np.searchsorted(tree.features, terms)
    known = tree.features[np.minimum(at, len(tree.features) - 1)] == terms
    owner, at = owner[known], at[known]
    node = np.zeros(n, dtype=np.int64)
    for _ in range(depth):
        score = np.bincount(owner, weights=tree.weights[node[owner], at], minlength=n)
        node = 2 * node + 1 + (score <= tree.least[node])
    return node - len(tree.least)


# The index


def _arrays(batch: pa.RecordBatch, name: str) -> tuple[np.ndarray, np.ndarray]:
    """Ends of each row's list, and the values of all."""
    a = batch.column(batch.schema.get_field_index(name))
    ends = a.offsets.to_numpy()
    return (ends - ends[0])[1:], a.flatten().to_numpy(zero_copy_only=False)


def impacts(tf: np.ndarray, n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    m = 25 + (75 * n * n_docs) // n_terms
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


def _clusters(first_id: int, doc_ids: np.ndarray, ends: np.ndarray, terms: np.ndarray, impact: np.ndarray, size: int = CLUSTER) -> pa.RecordBatch:
    """A run of documents, bisected down to clusters: one row each."""
    n = len(doc_ids)
    levels = max(0, math.ceil(math.log2(n / size)))
    owner = np.repeat(np.arange(n), np.diff(ends, prepend=0))
    _, number, df = np.unique(terms, return_inverse=True, return_counts=True)
    telling = (df > 1)[number]
    place = np.empty(n, dtype=np.int64)
    place[bisect(np.cumsum(np.bincount(owner[telling], minlength=n)), number[telling], levels)] = np.arange(n)
    edges = _edges(n, levels)
    cluster = np.searchsorted(edges, place, side="right") - 1
    by_place = np.argsort(place)
    order = np.lexsort((place[owner], terms, cluster[owner]))
    c, t, p, i = cluster[owner][order], terms[order], place[owner][order], impact[order]
    new = np.flatnonzero(np.append(True, (c[1:] != c[:-1]) | (t[1:] != t[:-1])))
    k = len(edges) - 1
    of = c[new]
    per_term, per_posting = np.cumsum(np.bincount(of, minlength=k)), np.cumsum(np.bincount(c, minlength=k))
    before = (per_posting - np.bincount(c, minlength=k))[of]
    int32 = pa.int32()
    return pa.RecordBatch.from_arrays([
        pa.array(first_id + np.arange(k), type=pa.int64()), _lists(edges[1:], doc_ids[by_place], pa.int64()), _lists(per_term, t[new], pa.int64()), _lists(per_term, np.append(new[1:], len(t)) - before, int32),
        _lists(per_term, np.maximum.reduceat(i, new), int32), _lists(per_posting, p - edges[c], int32), _lists(per_posting, i, int32),
    ], names=["id", "doc_ids", "terms", "ends", "most", "at", "impact"])


def build(docs: DataFrame, folder: str, only: np.ndarray | None = None, sample: int = SAMPLE, chunk: int = CHUNK, cluster: int = CLUSTER) -> Index:
    """Write the index of all rows: of all their terms, or of those in only (sorted hashes), which gives the same results for queries of these.
    The other parameters change what a search visits, never what it returns."""
    spark = prepare(docs.sparkSession)
    forward(docs, only).write.parquet(f"{folder}/forward")
    rows = spark.read.schema(FORWARD).parquet(f"{folder}/forward")
    n_docs, n_terms = rows.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    index = Index(spark, folder, n_docs, n_terms)
    rows.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df")).write.parquet(f"{folder}/df")
    rows = rows.where(F.size("terms") > 0)
    h = F.xxhash64("doc_id", "n")
    few = rows.where(F.pmod(h, F.lit(1 << 30)) <= min(1 << 30, (sample << 30) // max(1, n_docs))).select("terms").limit(2 * sample).toArrow()
    ends, terms = _arrays(few.combine_chunks().to_batches()[0], "terms") if few.num_rows else (np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64))
    tree = spark.sparkContext.broadcast(fit(ends, terms) if few.num_rows else None)

    def leaves(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            leaf = route(tree.value, *_arrays(batch, "terms")) if tree.value else np.zeros(batch.num_rows, dtype=np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaf, type=pa.int32())], names=[*batch.schema.names, "leaf"])

    def pack(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        next_id, held, size, postings = TaskContext.get().partitionId() << 32, [], 0, 0

        def run() -> pa.RecordBatch:
            batch = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            ends, terms = _arrays(batch, "terms")
            n, ids = batch.column(1).to_numpy(), batch.column(0).fill_null(NONE).to_numpy()
            tf = _arrays(batch, "tfs")[1].astype(np.int64)
            return _clusters(next_id, ids, ends, terms, impacts(tf, np.repeat(n, np.diff(ends, prepend=0)), n_docs, n_terms), cluster)

        for batch in it:
            while batch.num_rows:
                ends = batch.column(2).offsets.to_numpy()
                room = min(chunk - size, max(1, int(np.searchsorted(ends - ends[0], POSTINGS - postings, side="right")) - 1) if postings < POSTINGS else 0)
                part, batch = batch.slice(0, room), batch.slice(room)
                if part.num_rows:
                    held.append(part)
                    size, postings = size + part.num_rows, postings + int(ends[part.num_rows] - ends[0])
                if size >= chunk or postings >= POSTINGS or (batch.num_rows and held):
                    done = run()
                    yield done
                    next_id, held, size, postings = next_id + done.num_rows, [], 0, 0
        if held:
            yield run()

    dealt = rows.mapInArrow(leaves, f"{FORWARD}, leaf int").repartitionByRange(shuffle_partitions(spark), "leaf", h, "doc_id").sortWithinPartitions("leaf", h, "doc_id")
    dealt.select("doc_id", "n", "terms", "tfs").mapInArrow(pack, CLUSTERS).write.parquet(f"{folder}/clusters")
    return index


# Search


class Block(NamedTuple):
    """Queries by term: sorted terms, where each one's entries end, and of each entry the query and the weight with repeats."""

    terms: np.ndarray
    ends: np.ndarray
    query: np.ndarray
    weight: np.ndarray
    n: int


def _expand(begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers from begin to end (left out) of each row, and the row of each."""
    n = end - begin
    row = np.repeat(np.arange(len(n)), n)
    return np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n) + begin[row], row


class Clusters:
    """The clusters of a batch, seen from a block of queries."""

    def __init__(self, batch: pa.RecordBatch, block: Block):
        self.block, self.batch = block, batch
        self.term_ends, terms = _arrays(batch, "terms")
        at = np.searchsorted(block.terms, terms)
        hit = np.flatnonzero(block.terms[np.minimum(at, len(block.terms) - 1)] == terms)
        begin = np.append(0, block.ends)
        entry, row = _expand(begin[at[hit]], begin[at[hit] + 1])
        self.of_term, self.entry = hit[row], entry
        self.cluster = np.searchsorted(self.term_ends, self.of_term, side="right")
        most = _arrays(batch, "most")[1].astype(np.int64)
        self.bounds = np.zeros((batch.num_rows, block.n), dtype=np.int64)
        np.add.at(self.bounds, (self.cluster, block.query[entry]), block.weight[entry] * most[self.of_term])

    def postings(self) -> None:
        self.doc_ends, self.doc_ids = _arrays(self.batch, "doc_ids")
        self.ends = _arrays(self.batch, "ends")[1].astype(np.int64)
        self.post_ends, self.at = _arrays(self.batch, "at")
        self.impact = _arrays(self.batch, "impact")[1].astype(np.int64)

    def scores(self, c: int, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """doc_ids of a cluster, and their scores for each of the queries."""
        lo, hi = np.searchsorted(self.cluster, [c, c + 1])
        number = np.full(self.block.n, -1)
        number[queries] = np.arange(len(queries))
        use = np.flatnonzero(number[self.block.query[self.entry[lo:hi]]] >= 0) + lo
        entry, term = self.entry[use], self.of_term[use]
        first_term, first_post = (self.term_ends[c - 1], self.post_ends[c - 1]) if c else (0, 0)
        begin = np.where(term > first_term, self.ends[term - 1], 0) + first_post
        post, row = _expand(begin, self.ends[term] + first_post)
        ids = self.doc_ids[self.doc_ends[c - 1] if c else 0 : self.doc_ends[c]]
        out = np.zeros((len(queries), len(ids)), dtype=np.int64)
        np.add.at(out, (number[self.block.query[entry]][row], self.at[post]), self.block.weight[entry][row] * self.impact[post])
        return ids, out


def _visit(it: Iterator[pa.RecordBatch], block: Block, floors: np.ndarray, k: int) -> Iterator[pa.RecordBatch]:
    """The k best documents of a task's clusters for each query (number, doc_id, score), of those that reach the floor."""
    least, held = np.maximum(floors, 1), [(np.zeros(0, dtype=np.int64),) * 2] * block.n
    for batch in it:
        for i in range(0, batch.num_rows, 64):
            found = Clusters(batch.slice(i, 64), block)
            if not (found.bounds >= least).any():
                continue
            found.postings()
            for c in np.argsort(-(found.bounds - least).max(axis=1), kind="stable").tolist():
                queries = np.flatnonzero(found.bounds[c] >= least)
                if not len(queries):
                    continue
                ids, scores = found.scores(c, queries)
                for q, s in zip(queries.tolist(), scores, strict=True):
                    good = s >= least[q]
                    if good.any():
                        s, d = np.append(held[q][0], s[good]), np.append(held[q][1], ids[good])
                        best = np.lexsort((d, -s))[:k]
                        held[q] = s[best], d[best]
                        if len(best) == k:
                            least[q] = max(least[q], s[best[-1]])
    number = np.repeat(np.arange(block.n), [len(s) for s, _ in held])
    s, d = (np.concatenate([h[i] for h in held]) if held else np.zeros(0, dtype=np.int64) for i in (0, 1))
    yield pa.RecordBatch.from_arrays([pa.array(number, type=pa.int64()), pa.array(d, mask=d == NONE, type=pa.int64()), pa.array(s, type=pa.int64())], names=["number", "doc_id", "score"])


def _best(rows: DataFrame, k: int, *order) -> DataFrame:
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy("number").orderBy(*order))).where(F.col("rank") <= k)


def _search_block(index: Index, ids: list[int | None], terms: list[np.ndarray], k: int) -> DataFrame:
    spark = index.spark
    sizes = [len(t) for t in terms]
    distinct, number, tf = np.unique(np.concatenate([np.zeros(0, dtype=np.int64), *terms]), return_inverse=True), None, None
    distinct, number = distinct
    wanted = spark.createDataFrame(pa.table({"term": pa.array(distinct, type=pa.int64())}))
    df = {r.term: r.df for r in index.read("df").join(F.broadcast(wanted), "term").collect()}
    w = np.array([math.floor(1000 * math.log((2 * index.n_docs + 2) / (2 * df[t] + 1))) if t in df else 0 for t in distinct.tolist()], dtype=np.int64)
    key, tf = np.unique(number * len(ids) + np.repeat(np.arange(len(ids)), sizes), return_counts=True)
    block = Block(distinct, np.cumsum(np.bincount(key // len(ids), minlength=len(distinct))), key % len(ids), w[key // len(ids)] * tf, len(ids))
    shared = spark.sparkContext.broadcast(block)
    clusters = index.read("clusters")

    def seeds(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bound, best = np.zeros((0, shared.value.n), dtype=np.int64), np.zeros((0, shared.value.n), dtype=np.int64)
        for batch in it:
            b = np.vstack([bound, Clusters(batch, shared.value).bounds])
            c = np.vstack([best, np.repeat(batch.column(0).to_numpy()[:, None], shared.value.n, axis=1)])
            top = np.argsort(-b, axis=0, kind="stable")[:SEEDS]
            bound, best = np.take_along_axis(b, top, axis=0), np.take_along_axis(c, top, axis=0)
        q = np.tile(np.arange(shared.value.n), len(bound))
        use = bound.ravel() > 0
        yield pa.RecordBatch.from_arrays([pa.array(x[use], type=pa.int64()) for x in (q, best.ravel(), bound.ravel())], names=["number", "id", "bound"])

    def visit(floors: np.ndarray):
        return lambda it: _visit(it, shared.value, floors, k)

    found = "number long, doc_id long, score long"
    first = _best(clusters.select("id", "terms", "most").mapInArrow(seeds, "number long, id long, bound long"), SEEDS, F.desc("bound"), "id")
    near = clusters.where(F.col("id").isin(sorted({r.id for r in first.collect()})))
    floors = np.zeros(len(ids), dtype=np.int64)
    for r in _best(near.mapInArrow(visit(floors), found), k, F.desc("score")).groupBy("number").agg(F.count("*").alias("n"), F.min("score").alias("least")).collect():
        floors[r.number] = r.least if r.n == k else 0
    top = _best(clusters.mapInArrow(visit(floors), found), k, F.desc("score"), F.asc_nulls_last("doc_id"))
    names = spark.createDataFrame(pa.table({"number": pa.array(range(len(ids)), type=pa.int64()), "item_id": pa.array(ids, type=pa.int64())}))
    return top.join(F.broadcast(names), "number").select("item_id", "rank", "doc_id", "score")


def query_terms(items: DataFrame, key: str = "item_id", text: str = "text") -> DataFrame:
    """Each query's terms with their numbers of repeats, as forward() has documents'."""
    return forward(items, None, key, text)


def vocabulary(items: DataFrame) -> np.ndarray | None:
    """The distinct terms of all queries, sorted, or None if they are more than MOST_TERMS."""
    t = query_terms(items).select(F.explode("terms").alias("term")).distinct().limit(MOST_TERMS + 1).toArrow()
    return np.sort(t.column(0).to_numpy()) if t.num_rows <= MOST_TERMS else None


def search(index: Index, items: DataFrame, k: int = 10) -> DataFrame:
    """item_id, rank (from 1), doc_id, score of each query's k best documents with a score above 0; equal scores by doc_id."""
    out, ids, terms, held = None, [], [], 0

    def add(out: DataFrame | None) -> DataFrame:
        found = _search_block(index, ids, terms, k)
        return found if out is None else out.unionByName(found)

    for r in query_terms(items).where(F.size("terms") > 0).toLocalIterator():
        if ids and held + len(r.terms) > BLOCK:
            out, ids, terms, held = add(out), [], [], 0
        ids.append(r.doc_id)
        terms.append(np.repeat(np.array(r.terms, dtype=np.int64), r.tfs))
        held += len(r.terms)
    if ids and index.n_docs:
        out = add(out)
    return out if out is not None else index.spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")


def query(spark, sf_dir: str) -> DataFrame:
    """All documents ranked for each benchmark item; the index goes once the rows are stored."""
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    folder = new_folder(spark, "search")
    index = build(docs, folder, vocabulary(items))
    search(index, items).write.parquet(f"{folder}/found")
    for name in ("forward", "df", "clusters"):
        remove(spark, f"{folder}/{name}")
    return spark.read.schema("item_id long, rank int, doc_id long, score long").parquet(f"{folder}/found")


_TERMS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
ORACLE_SQL = rf"""
WITH dt AS (SELECT doc_id, unnest({_TERMS}) AS term FROM documents),
tf AS (SELECT doc_id, term, count(*) AS tf FROM dt GROUP BY ALL),
len AS (SELECT doc_id, count(*) AS n FROM dt GROUP BY ALL),
total AS (SELECT count(*) AS nn, CAST(sum(n) AS BIGINT) AS ll FROM len),
w AS (SELECT term, CAST(floor(1000 * ln((2 * nn + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, total GROUP BY term, nn),
it AS (SELECT item_id, term, count(*) AS c FROM (SELECT item_id, unnest({_TERMS}) AS term FROM benchmark) GROUP BY ALL),
s AS (SELECT item_id, doc_id, CAST(sum(c * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * nn) // ll)))) AS BIGINT) AS score
  FROM it JOIN tf USING (term) JOIN w USING (term) JOIN len USING (doc_id), total GROUP BY ALL),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 10"""
