"""Exact near-duplicate embeddings: cover trees and a dual traversal that prunes node pairs by covering radii.

Vectors are compared within one label (and one length). Equal vectors are one point with a weight. A label's points are
placed by their distance to PIVOTS of its own vectors, drawn by hash; a cell with more than TILE points is split by hash,
and pairs of tiles that the triangle inequality rules out aren't visited, so a hot label becomes many bounded tasks. A
task builds a cover tree for each of its tiles (nested centres, radii that halve from level to level, each node with the
radius that its points really need) and walks both at once: a pair of nodes further apart than radii and threshold
together is dropped, a pair that lies wholly within it is counted as a whole, others are opened; single points are
decided by their cosine in double precision. Tasks return a count and one edge a point, never the pairs. Components of
the edges follow.

Vectors that are null, empty, zero or hold null or non-finite components, and vectors of a null label, link with
nothing. A label with one vector has no links. Rows that repeat a vec_id with one vector count as copies of it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import prepare, table
from .components import components

COSINE = 0.98
PIVOTS = 8
TILE = 4096
STRIP = 512  # rows of a distance matrix held at once
EPS = 1e-6  # more than the error of a distance made from a cosine near 1


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


class Tree:
    """Nodes as arrays: centre, radius, points (as a range of order), children; a node without children is one point."""

    def __init__(self, x: np.ndarray):
        self.x = x
        self.centre, self.radius, self.children, self.points = [], [], [], []
        self.root = self._grow(0, np.arange(len(x)), 2.0) if len(x) else -1

    def _grow(self, centre: int, points: np.ndarray, r: float) -> int:
        """A node for points within r of the centre; they are dealt to centres with half the radius, the node's own first."""
        stack_id = len(self.centre)
        self.centre.append(centre)
        far = self._far(centre, points)
        self.radius.append(float(far.max()))
        self.points.append(points)
        self.children.append([])
        if len(points) > 1 and self.radius[stack_id] > 1e-7:
            r = min(r, self.radius[stack_id]) / 2
            left, c = points, centre
            kids = []
            while len(left):
                near = self._far(c, left) <= r
                near |= left == c
                kids.append((c, left[near]))
                left = left[~near]
                c = int(left[0]) if len(left) else -1
            self.children[stack_id] = [self._grow(c, p, r) for c, p in kids]
        elif len(points) > 1:  # equal up to rounding: a flat fan of points
            for p in points.tolist():
                self.children[stack_id].append(len(self.centre))
                self.centre.append(p)
                self.radius.append(0.0)
                self.points.append(np.array([p]))
                self.children.append([])
        return stack_id

    def _far(self, c: int, points: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(0, 2 - 2 * (self.x[points] @ self.x[c])))


class Links:
    """Links between the points of two trees (or of one): weighted counts and component labels."""

    def __init__(self, a: Tree, wa: np.ndarray, b: Tree | None, wb: np.ndarray | None, cosine: float = COSINE):
        self.one, self.cosine, self.eps = b is None, cosine, float(np.sqrt(2 - 2 * cosine))
        self.a, self.b = a, a if b is None else b
        self.wa, self.wb = wa, wa if wb is None else wb
        shift = 0 if self.one else len(wa)
        self.shift, total = shift, len(wa) + (0 if self.one else len(self.wb))
        self.n, self.label = np.zeros(total, dtype=np.int64), np.arange(total)
        self.visited = 0
        if a.root >= 0 and self.b.root >= 0:
            self._walk()

    def find(self, i: int) -> int:
        while self.label[i] != i:
            self.label[i] = self.label[self.label[i]]
            i = int(self.label[i])
        return i

    def _join(self, items: np.ndarray) -> None:
        roots = sorted({self.find(i) for i in items.tolist()})
        self.label[roots] = roots[0]

    def _open(self, t: Tree, node: int) -> list[int]:
        return t.children[node] or [node]

    def _walk(self) -> None:
        stack = [(self.a.root, self.b.root)]
        while stack:
            p, q = stack.pop()
            same = self.one and p == q
            kp, kq = self._open(self.a, p), self._open(self.b, q)
            for k in range(0, len(kp), STRIP):
                self._strip(np.array(kp[k : k + STRIP]), np.array(kq), k if same else -1, stack)

    def _strip(self, kp: np.ndarray, kq: np.ndarray, diagonal: int, stack: list) -> None:
        a, b = self.a, self.b
        cp, cq = np.array([a.centre[i] for i in kp]), np.array([b.centre[i] for i in kq])
        rp, rq = np.array([a.radius[i] for i in kp]), np.array([b.radius[i] for i in kq])
        cos = a.x[cp] @ b.x[cq].T
        self.visited += cos.size
        d = np.sqrt(np.maximum(0, 2 - 2 * cos))
        reach = rp[:, None] + rq
        near = d - reach <= self.eps + EPS
        if diagonal >= 0:  # one tree against itself: each pair of children once, and each child with itself
            near &= np.arange(len(kq)) >= np.arange(diagonal, diagonal + len(kp))[:, None]
        leaf_p, leaf_q = np.array([not a.children[i] for i in kp]), np.array([not b.children[i] for i in kq])
        single = near & leaf_p[:, None] & leaf_q
        if diagonal >= 0:
            single &= np.arange(len(kq)) != np.arange(diagonal, diagonal + len(kp))[:, None]
        hit = single & (cos >= self.cosine)
        if hit.any():
            rows, cols = np.flatnonzero(hit.any(axis=1)), np.flatnonzero(hit.any(axis=0))
            h = hit[np.ix_(rows, cols)]
            self.n[cp[rows]] += h @ self.wb[cq[cols]]
            np.add.at(self.n, cq[cols] + self.shift, h.T @ self.wa[cp[rows]])
            self._spread(h, cp[rows], cq[cols] + self.shift)
        for i, j in zip(*np.nonzero(near & ~(leaf_p[:, None] & leaf_q)), strict=True):
            p, q = int(kp[i]), int(kq[j])
            if self.one and p == q or d[i, j] + reach[i, j] > self.eps - EPS:
                stack.append((p, q))
            else:  # every pair links
                x, y = a.points[p], b.points[q]
                self.n[x] += self.wb[y].sum()
                self.n[y + self.shift] += self.wa[x].sum()
                self._join(np.concatenate([x, y + self.shift]))

    def _spread(self, h: np.ndarray, rows: np.ndarray, cols: np.ndarray) -> None:
        """Join what the links connect: smallest labels go back and forth over the matrix until nothing changes."""
        size = len(self.label)
        row = np.array([self.find(i) for i in rows.tolist()])
        col = np.array([self.find(i) for i in cols.tolist()])
        first_row, first_col = row.copy(), col.copy()
        while True:
            c = np.minimum(col, np.where(h, row[:, None], size).min(axis=0))
            r = np.minimum(row, np.where(h, c, size).min(axis=1))
            if (c == col).all() and (r == row).all():
                break
            row, col = r, c
        for x, y in zip([*first_row.tolist(), *first_col.tolist()], [*row.tolist(), *col.tolist()], strict=True):
            x, y = self.find(x), self.find(y)
            self.label[max(x, y)] = min(x, y)


def _array(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _place(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cell (nearest pivot) and distances to the pivots of each point. Points of a batch are taken by label."""
    for batch in it:
        lists, pivots = batch.column(3), batch.column(4)
        n = batch.num_rows
        cell, dist = np.zeros(n, dtype=np.int32), np.zeros((n, PIVOTS))
        by: dict[tuple, list[int]] = {}
        for i, key in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)):
            by.setdefault(key, []).append(i)
        for at in by.values():
            x = unit(np.array([lists[i].as_py() for i in at], dtype=np.float64))
            p = unit(np.array(pivots[at[0]].as_py(), dtype=np.float64))
            d = np.sqrt(np.maximum(0, 2 - 2 * (x @ p.T)))
            cell[at] = d.argmin(axis=1)
            dist[np.array(at)[:, None], np.arange(d.shape[1])] = d
        yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in (0, 1, 2, 3, 5)), pa.array(cell), pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * PIVOTS), pa.array(dist.ravel()))], names=["label", "dim", "rep", "v", "w", "cell", "d"])


def _dual(t: pa.Table) -> pa.Table:
    rep, side, w = (np.array(t.column(c).to_pylist(), dtype=np.int64) for c in ("rep", "side", "w"))
    order = np.lexsort((rep, side))
    x = unit(_array(t.column("v")))[order] if len(rep) else np.zeros((0, 1))
    rep, side, w = rep[order], side[order], w[order]
    cut = int((side == 0).sum())
    a = Tree(x[:cut])
    links = Links(a, w[:cut], Tree(x[cut:]), w[cut:]) if cut < len(rep) else Links(a, w, None, None)
    hit = np.flatnonzero(links.n)
    root = np.array([links.find(int(i)) for i in hit], dtype=np.int64)
    return pa.table({"rep": rep[hit], "n": links.n[hit], "root": rep[root] if len(hit) else rep[hit]})


def join(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """vec_id, n_links, component_id, kept for the rows of vec_id, embedding, label."""
    prepare(vectors.sparkSession)
    assert cosine == COSINE, "the bounds are compiled for one threshold"
    usable = F.forall("embedding", lambda v: v.isNotNull() & (F.abs(v) < float("inf")) & ~F.isnan(v)) & F.exists("embedding", lambda v: v != 0)
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"), F.col("embedding").cast("array<double>").alias("embedding"))
    rows = rows.withColumn("ok", F.coalesce(F.col("label").isNotNull() & usable, F.lit(False)))
    key = ["label", "dim", "v"]
    good = rows.where("ok").select("vec_id", "label", F.size("embedding").alias("dim"), F.col("embedding").alias("v"))
    points = good.groupBy(*key).agg(F.min("vec_id").alias("rep"), F.count("*").alias("w")).checkpoint()
    hashed = points.withColumn("h", F.xxhash64("rep"))
    drawn = hashed.groupBy("label", "dim", F.pmod("h", F.lit(PIVOTS)).alias("k")).agg(F.min(F.struct("h", "v")).alias("p"))
    pivots = drawn.groupBy("label", "dim").agg(F.transform(F.array_sort(F.collect_list("p")), lambda p: p["v"]).alias("pivots")).checkpoint()
    placed = points.join(pivots, ["label", "dim"]).select("label", "dim", "rep", "v", "pivots", "w")
    placed = placed.mapInArrow(_place, "label string, dim int, rep long, v array<double>, w long, cell int, d array<double>").checkpoint()
    sizes = placed.groupBy("label", "dim", "cell").agg(F.count("*").alias("m")).checkpoint()
    totals = sizes.groupBy("label", "dim").agg(F.sum("m").alias("all"))
    # a label that fits one tile is one cell
    plan = sizes.join(totals, ["label", "dim"]).select("label", "dim", "cell", F.when(F.col("all") <= TILE, -1).otherwise(F.col("cell")).alias("c"), F.when(F.col("all") <= TILE, 1).otherwise(F.ceil(F.col("m") / TILE)).cast("long").alias("parts")).checkpoint()
    tiled = placed.join(plan, ["label", "dim", "cell"]).withColumn("tile", F.concat_ws(":", "c", F.pmod(F.xxhash64("rep"), F.col("parts")))).drop("cell", "c", "parts").checkpoint()
    stats = tiled.groupBy("label", "dim", "tile").agg(*(F.min(F.get("d", F.lit(k))).alias(f"lo{k}") for k in range(PIVOTS)), *(F.max(F.get("d", F.lit(k))).alias(f"hi{k}") for k in range(PIVOTS))).checkpoint()
    eps = float(np.sqrt(2 - 2 * cosine)) + EPS
    x, y = stats.alias("x"), stats.alias("y")
    apart = [(F.col(f"x.lo{k}") - F.col(f"y.hi{k}") <= eps) & (F.col(f"y.lo{k}") - F.col(f"x.hi{k}") <= eps) for k in range(PIVOTS)]
    close = apart[0]
    for c in apart[1:]:
        close = close & c
    pairs = x.join(y, (F.col("x.label") == F.col("y.label")) & (F.col("x.dim") == F.col("y.dim")) & (F.col("x.tile") <= F.col("y.tile")) & close)
    pairs = pairs.select(F.col("x.label").alias("label"), F.col("x.dim").alias("dim"), F.col("x.tile").alias("ta"), F.col("y.tile").alias("tb"))
    sides = pairs.withColumn("s", F.explode(F.when(F.col("ta") == F.col("tb"), F.array(F.struct(F.col("ta").alias("tile"), F.lit(0).alias("side")))).otherwise(F.array(F.struct(F.col("ta").alias("tile"), F.lit(0).alias("side")), F.struct(F.col("tb").alias("tile"), F.lit(1).alias("side"))))))
    work = tiled.drop("d").join(sides.select("label", "dim", "ta", "tb", "s.tile", "s.side").checkpoint(), ["label", "dim", "tile"])
    found = work.select("label", "dim", "ta", "tb", "rep", "side", "w", "v").groupBy("label", "dim", "ta", "tb").applyInArrow(_dual, "rep long, n long, root long").checkpoint()
    n = found.groupBy("rep").agg(F.sum("n").alias("n")).checkpoint()
    tree = components(found, "rep", "root").withColumnRenamed("node", "rep").checkpoint()
    known = points.select(*key, "rep", "w").join(n, "rep", "left").join(tree, "rep", "left").select(*key, F.col("rep").alias("vec_rep"), "w", "n", "component").checkpoint()
    out = good.join(known, key).select("vec_id", (F.coalesce("n", F.lit(0)) + F.col("w") - 1).alias("n_links"), F.coalesce("component", "vec_rep").alias("component_id"))
    rest = rows.where("not ok").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return out.unionByName(rest).withColumn("kept", F.col("vec_id") == F.col("component_id"))


def query(spark, sf_dir: str) -> DataFrame:
    return join(table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"))
