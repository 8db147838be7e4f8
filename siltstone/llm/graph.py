"""Connected components over an edge table, by large-star and small-star rounds."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm import common


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's edges as links from every node to the smallest one that these edges reach."""
    parent: dict = {}

    def root(x):
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = x = parent[up]
        return x

    kind = None
    for b in batches:
        kind = b.column("u").type
        for x, y in zip(b.column("u").to_pylist(), b.column("v").to_pylist(), strict=True):
            p, q = root(x), root(y)
            if p != q:
                parent[max(p, q)] = min(p, q)
    found = [(x, root(x)) for x in list(parent)]
    for i in range(0, len(found), 1 << 14):
        some = [p for p in found[i : i + (1 << 14)] if p[0] != p[1]]
        yield pa.RecordBatch.from_arrays([pa.array([p[k] for p in some], type=kind) for k in range(2)], names=["u", "v"])


def connected_components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(a, b) pairs of ids to (node, component): the smallest id reachable, for every node that some edge names.

    Every task first puts its own edges into a forest of stars (what it holds is
    its share of the nodes), which leaves few rounds. Each round first links every larger neighbour of a node to its smallest
    neighbour (large star), then every smaller neighbour likewise (small star),
    until no edge changes; that takes a number of rounds that grows with the
    logarithm of the nodes.  Groups are only reduced by ``min``, so a node with
    very many edges is combined before the shuffle and nothing is collected.
    Self-links are dropped; no edges give no rows.
    """
    pairs = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v")
    now = common.stash(pairs.mapInArrow(_forest, pairs.schema).distinct(), name)
    while True:
        before = _state(now)
        if before[0] == 0:
            break
        nxt = common.stash(_small_star(_large_star(now)), name)
        after = _state(nxt)
        common.drop_stash(now)
        now = nxt
        if before == after:
            break
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


def _state(edges: DataFrame) -> tuple:
    """Number of edges and an order-free digest of them; equal states are taken as equal edges."""
    r = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x"), F.sum(F.xxhash64("v", "u") % 1000003).alias("s")).first()
    return (r["n"], r["x"], r["s"])


def _large_star(edges: DataFrame) -> DataFrame:
    """For each node u with smallest neighbour or self m: link each neighbour larger than u to m."""
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("w")).select("u", F.least("u", "w").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """For each node u, whose neighbours v are smaller: link u and each v to the smallest."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
