"""Connected components of a graph given as a table of edges, by rounds of hooking and pointer jumping.

In each round a node takes its smallest smaller neighbour as parent (partial minima before the shuffle), parents are
followed to their roots, and the edges between different roots go on to the next round. Each step's table is written to
the checkpoint folder and read from there, so a lost executor costs no more than a step, and the size that Spark takes a
table to have is that of its files: with checkpoints the driver holds for each step the product of two earlier estimates,
numbers that double their length at every jump until they fill its heap. Joins on a hub are merges of two plain
exchanges, whose large partitions Spark splits. Nothing is collected.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import columns, prepare, remove, tidy, written


#: Up to so many edges (a few MB, counted first) one task's union-find replaces the rounds, whose cost is then mere latency.
FEW = 200_000


class Forest:
    """Union-find whose roots are the smallest members."""

    def __init__(self) -> None:
        self.parent: dict[int, int] = {}

    def find(self, x: int) -> int:
        p = self.parent
        root = x
        while (up := p.get(root, root)) != root:
            root = up
        while x != root:
            p[x], x = root, p.get(x, root)
        return root

    def union(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        if a == b:
            return False
        self.parent[max(a, b)] = min(a, b)
        self.parent.setdefault(min(a, b), min(a, b))
        return True


def _contract(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stars in place of a partition's edges; at most HELD nodes are held at a time."""
    forest = Forest()

    def stars() -> pa.RecordBatch:
        rows = [(x, r) for x in list(forest.parent) if (r := forest.find(x)) != x]
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], type=pa.int64()) for i in (0, 1)], names=["u", "v"])

    for batch in it:
        for a, b in zip(*columns(batch, "u", "v"), strict=True):
            forest.union(a, b)
        if len(forest.parent) > 500_000:
            yield stars()
            forest = Forest()
    yield stars()


def _whole(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    forest = Forest()
    for batch in it:
        for a, b in zip(*columns(batch, "u", "v"), strict=True):
            forest.union(a, b)
    rows = [(x, r) for x in list(forest.parent) if (r := forest.find(x)) != x]
    yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], type=pa.int64()) for i in (0, 1)], names=["node", "component"])


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, component (the smallest node reachable) for each node that isn't itself the smallest of its component."""
    prepare(edges.sparkSession)
    e = edges.select(F.greatest(a, b).cast("long").alias("u"), F.least(a, b).cast("long").alias("v")).where("u <> v")
    e = e.mapInArrow(_contract, "u long, v long").distinct().checkpoint()
    if e.count() <= FEW:
        return e.coalesce(1).mapInArrow(_whole, "node long, component long")
    spark, folder, made = e.sparkSession, f"{e.sparkSession.sparkContext.getCheckpointDir()}/components-{uuid.uuid4().hex}", []

    def step(df: DataFrame, *over: str) -> tuple[DataFrame, str]:
        """The rows as a table, and its path; tables that no later step reads go."""
        made.append(f"{folder}/{len(made)}")
        out = written(made[-1], df)
        for path in over:
            remove(spark, path)
        return out, made[-1]

    levels: list[tuple[DataFrame, str]] = []
    edges_at: tuple[str, ...] = ()
    while not e.isEmpty():
        parents, at = step(e.groupBy("u").agg(F.min("v").alias("p")))
        while True:
            up = parents.select(F.col("u").alias("w"), F.col("p").alias("q")).hint("merge")
            jumped, at = step(parents.join(up, F.col("p") == F.col("w"), "left").select("u", F.coalesce("q", "p").alias("p"), F.col("q").isNotNull().alias("moved")), at)
            parents = jumped.select("u", "p")
            if jumped.where("moved").isEmpty():
                break
        levels.append((parents, at))
        tidy(spark)
        x = parents.select("u", F.col("p").alias("pu")).hint("merge")
        y = parents.select(F.col("u").alias("w"), F.col("p").alias("pv")).hint("merge")
        rest = e.join(x, "u").join(y, F.col("v") == F.col("w"), "left").select("pu", F.coalesce("pv", "v").alias("pv")).where("pu <> pv")
        e, edge = step(rest.select(F.greatest("pu", "pv").alias("u"), F.least("pu", "pv").alias("v")).distinct(), *edges_at)
        edges_at = (edge,)
    if not levels:
        return e.select(F.col("u").alias("node"), F.col("v").alias("component"))
    out, at = levels.pop()
    while levels:
        later = out.select(F.col("u").alias("w"), F.col("p").alias("q")).hint("merge")
        level, old = levels.pop()
        mapped = level.join(later, F.col("p") == F.col("w"), "left").select("u", F.coalesce("q", "p").alias("p"))
        out, at = step(mapped.unionByName(out), old, at)
    out = out.select(F.col("u").alias("node"), F.col("p").alias("component")).checkpoint()
    remove(spark, folder)
    return out
