"""Centroid clustering by kd-tree filtering, in exact integers.

A vector of ``DIMS`` finite components becomes integers ``floor(256 * x)``.  Every
task builds kd-trees over its vectors, ``TREE`` at a time, and writes them as a
table: the points in the order of the leaves, and for each node its bounding
box, its count and the integer sums of its points.  A round reads the trees and
walks each from the root with the centroids that may still be nearest: of these
the one nearest to the middle of the box is compared with every other at the
corner of the box that favours the other most, and whoever loses even there,
strictly, is pruned.  A node with one centroid left is assigned whole, by its
count and sums; a leaf's points, or a node whose points are all the same, are
compared with the centroids left.  A task sends one row a centroid, Spark adds
these up, and what comes to the driver is the ``k`` sums of each side a round.

Every figure is an integer.  Products go through float64 where all of them stay
under 2**53 and through int64 where not, so ties are ties: the smaller number
wins, and a centroid that only ties with another is never pruned.

Defined cases: vectors that are null, of another length, or with a null or
non-finite component are left out, and give no row; integers beyond
``LIMIT`` on either side count as ``LIMIT``, so that a squared distance fits a
long; repeated rows and rows without an id are vectors like any other, and a null
id hashes as if nothing stood behind the salt; seeds with equal hashes are
ordered by their components; fewer vectors than ``k`` are all seeds; of equal
centroids the first takes all and the others stay where they are; no vectors give
no rows; columns besides vec_id and embedding are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm import common

DIMS, SCALE, LIMIT = 64, 256, 1 << 27
K, ROUNDS, SALT = 40, 5, "2:"
#: Points of one tree, and of a leaf.
TREE, LEAF = 4096, 48
#: Under this, sums of DIMS products of two integers are exact in float64.
SMALL = 1 << 22


def quantised(vectors: DataFrame, dims: int = DIMS) -> DataFrame:
    """vec_id and the integers of every vector that is kept."""
    rows = common.pick(vectors, "vec_id", "embedding")
    whole = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v.cast("double")) < float("inf")))
    scaled = F.transform("embedding", lambda v: F.floor(F.greatest(F.least(v.cast("double") * SCALE, F.lit(float(LIMIT))), F.lit(float(-LIMIT)))).cast("int"))
    return rows.where((F.size("embedding") == dims) & whole).select("vec_id", scaled.alias("q"))


def seeds(kept: DataFrame, k: int = K, salt: str = SALT) -> np.ndarray:
    """The k vectors whose salted ids have the smallest hashes, in that order."""
    keyed = kept.select("q", F.sha2(F.concat(F.lit(salt), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256).alias("h"))
    return np.array([r["q"] for r in keyed.orderBy("h", "q").limit(k).collect()], dtype=np.int64)


def build(points: np.ndarray) -> dict[str, np.ndarray]:
    """A kd-tree: cut at the median of the widest side until a node has LEAF points or its points are all the same."""
    order = np.arange(len(points))
    lo, hi, span, left, sums = [], [], [], [], []
    todo = [(0, len(points), -1)]
    while todo:
        a, b, parent = todo.pop()
        here = points[order[a:b]]
        if parent >= 0 and left[parent] < 0:
            left[parent] = len(lo)  # of the two children the left one comes first and the right one where its subtree ends
        elif parent >= 0:
            span[parent] = (*span[parent][:2], len(lo))
        lo.append(here.min(0))
        hi.append(here.max(0))
        sums.append(here.sum(0))
        span.append((a, b, -1))
        left.append(-1)
        wide = hi[-1] - lo[-1]
        if b - a > LEAF and wide.any():
            side, half = int(wide.argmax()), (b - a) // 2
            order[a:b] = order[a:b][np.argpartition(here[:, side], half)]
            me = len(lo) - 1
            todo += [(a + half, b, me), (a, a + half, me)]
    return {"order": order, "points": points[order], "lo": np.array(lo), "hi": np.array(hi), "sums": np.array(sums), "span": np.array(span), "left": np.array(left)}


def squared_costs(points: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """|z|^2 - 2 x.z for every point and centroid: what differs among the squared distances of a point, exactly."""
    if max(np.abs(points).max(), np.abs(centroids).max()) <= SMALL:
        p, z = points.astype(np.float64), centroids.astype(np.float64)
        return (z * z).sum(1) - 2.0 * (p @ z.T)
    return (centroids * centroids).sum(1) - 2 * (points @ centroids.T)


def remaining(lo: np.ndarray, hi: np.ndarray, candidates: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """The candidates that are not strictly dominated everywhere in the box by the one nearest to its middle."""
    z = centroids[candidates]
    star = z[((2 * z - lo - hi) ** 2).sum(1).argmin()]
    d = z - star
    corner = np.where(d > 0, hi, lo)
    return candidates[(d * (z + star - 2 * corner)).sum(1) <= 0]


def walk(tree: dict[str, np.ndarray], centroids: np.ndarray) -> Iterator[tuple[int, int, int | np.ndarray, int]]:
    """(from, to, cluster, node) for nodes that go to one centroid whole, (from, to, clusters, -1) for points resolved one by one."""
    todo = [(0, np.arange(len(centroids)))]
    while todo:
        node, candidates = todo.pop()
        a, b, right = tree["span"][node]
        if len(candidates) > 1:
            candidates = remaining(tree["lo"][node], tree["hi"][node], candidates, centroids)
        if len(candidates) == 1:
            yield a, b, int(candidates[0]), node
        elif tree["left"][node] < 0:
            yield a, b, candidates[squared_costs(tree["points"][a:b], centroids[candidates]).argmin(1)], -1
        else:
            todo += [(int(right), candidates), (int(tree["left"][node]), candidates)]


_ARRAYS = ("points", "lo", "hi", "sums", "span", "left")
_WIDE = ("sums",)
_FLAT = {"left": 1, "span": 3}


def _pack(ids: list, tree: dict[str, np.ndarray]) -> list:
    return [[ids[i] for i in tree["order"]], *[tree[n].astype(np.int64 if n in _WIDE else np.int32).tobytes() for n in _ARRAYS]]


def _unpack(batch: pa.RecordBatch, row: int, dims: int) -> dict[str, np.ndarray]:
    tree = {n: np.frombuffer(batch.column(n)[row].as_py(), dtype=np.int64 if n in _WIDE else np.int32).astype(np.int64).reshape(-1, _FLAT.get(n, dims)) for n in _ARRAYS}
    tree["left"] = tree["left"][:, 0]
    return tree


def trees(kept: DataFrame, dims: int = DIMS) -> DataFrame:
    """Every partition's vectors as kd-trees, one row a tree."""
    kind = kept.schema["vec_id"].dataType.simpleString()

    def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = None
        ids, points = [], np.empty((0, dims), dtype=np.int64)

        def row(some: list, these: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([v], type=t) for v, t in zip(_pack(some, build(these)), schema.types, strict=True)], schema=schema)

        for batch in batches:
            if schema is None:
                schema = pa.schema([("vec_ids", pa.list_(batch.schema.field("vec_id").type)), *[(n, pa.binary()) for n in _ARRAYS]])
            ids += batch.column("vec_id").to_pylist()
            points = np.concatenate([points, batch.column("q").flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dims)])
            while len(ids) >= TREE:
                yield row(ids[:TREE], points[:TREE])
                ids, points = ids[TREE:], points[TREE:]
        if ids:
            yield row(ids, points)

    return kept.mapInArrow(grow, f"vec_ids array<{kind}>, " + ", ".join(f"{n} binary" for n in _ARRAYS))


def moved(grown: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """One round: each centroid with vectors becomes the floor of their mean, component by component."""
    k, dims = centroids.shape

    def filtered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total = np.zeros(k, dtype=np.int64), np.zeros((k, dims), dtype=np.int64)
        for batch in batches:
            for i in range(batch.num_rows):
                tree = _unpack(batch, i, dims)
                for a, b, cluster, node in walk(tree, centroids):
                    if node >= 0:
                        count[cluster] += b - a
                        total[cluster] += tree["sums"][node]
                    else:
                        count += np.bincount(cluster, minlength=k)
                        for c in np.unique(cluster):
                            total[c] += tree["points"][a:b][cluster == c].sum(0)
        some = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(some, type=pa.int32()), pa.array(count[some]), pa.array(list(total[some]), type=pa.list_(pa.int64()))], names=["cluster", "n", "s"])

    parts = grown.mapInArrow(filtered, "cluster int, n long, s array<long>")
    sides = parts.select("cluster", "n", F.posexplode("s").alias("side", "s"))
    sums = sides.groupBy("cluster", "side").agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(19,0)")).alias("s"))
    out = centroids.copy()
    for r in sums.collect():  # k * dims rows at most
        out[r["cluster"], r["side"]] = int(r["s"]) // r["n"]
    return out


def assigned(grown: DataFrame, centroids: np.ndarray) -> DataFrame:
    """vec_id, cluster and squared distance of every vector."""
    dims = centroids.shape[1]
    kind = grown.schema["vec_ids"].dataType.elementType.simpleString()

    def resolved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                tree = _unpack(batch, i, dims)
                cluster = np.empty(len(tree["points"]), dtype=np.int64)
                for a, b, c, _ in walk(tree, centroids):
                    cluster[a:b] = c
                distance = ((tree["points"] - centroids[cluster]) ** 2).sum(1)
                yield pa.RecordBatch.from_arrays([batch.column("vec_ids")[i].values, pa.array(cluster, type=pa.int32()), pa.array(distance)], names=["vec_id", "cluster", "distance"])

    return grown.mapInArrow(resolved, f"vec_id {kind}, cluster int, distance long")


def digest(centroid: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, centroid.tolist())).encode()).hexdigest()


def cluster(vectors: DataFrame, k: int = K, rounds: int = ROUNDS, dims: int = DIMS, salt: str = SALT) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 and cluster_size, one row a kept vector."""
    spark = vectors.sparkSession
    common.prepare(spark)
    kept = quantised(vectors, dims)
    centroids = seeds(kept, k, salt)
    if not len(centroids):
        centroids = np.zeros((1, dims), dtype=np.int64)
    grown = common.stash(trees(kept, dims), "kd-trees")
    for _ in range(rounds):
        centroids = moved(grown, centroids)
    found = common.stash(assigned(grown, centroids), "kd-assigned")
    common.drop_stash(grown)
    # At most k rows, whatever the input.
    each = found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(20,0)")).alias("d"), F.count("*").alias("cluster_size"))
    inertia = each.agg(F.sum("d").cast("long").alias("d")).first()["d"]
    names = spark.createDataFrame([(i, digest(c)) for i, c in enumerate(centroids)], "cluster int, centroid_sha256 string")
    told = each.join(F.broadcast(names), "cluster").select("cluster", F.col("d").cast("long").alias("cluster_inertia"), F.lit(inertia).cast("long").alias("inertia"), "centroid_sha256", "cluster_size")
    return found.join(F.broadcast(told), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256", "cluster_size")


def oracle_sql(k: int = K, rounds: int = ROUNDS, dims: int = DIMS, salt: str = SALT) -> str:
    """The same over the embeddings table, in DuckDB: every vector against every centroid in each round."""
    steps = [
        f"""kept AS MATERIALIZED (
  SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS q
  FROM embeddings WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {dims}
)""",
        f"""c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('{salt}' || coalesce(vec_id::VARCHAR, '')), q) - 1 AS cluster, q AS z
  FROM kept QUALIFY row_number() OVER (ORDER BY sha256('{salt}' || coalesce(vec_id::VARCHAR, '')), q) <= {k}
)""",
    ]
    for i in range(rounds + 1):
        steps.append(f"""a{i} AS MATERIALIZED (
  SELECT row, min_by(cluster, (d, cluster)) AS cluster, min(d) AS distance FROM (
    SELECT row, cluster, list_sum(list_transform(list_zip(q, z), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT AS d FROM kept, c{i}
  ) GROUP BY row
)""")
        if i < rounds:
            steps.append(f"""c{i + 1} AS MATERIALIZED (
  SELECT c.cluster, coalesce(m.z, c.z) AS z FROM c{i} c LEFT JOIN (
    SELECT cluster, list(f ORDER BY j) AS z FROM (
      SELECT cluster, j, CASE WHEN s < 0 THEN -((n - 1 - s) // n) ELSE s // n END AS f FROM (
        SELECT cluster, j, sum(x)::BIGINT AS s, count(*)::BIGINT AS n FROM (
          SELECT a.cluster, unnest(q) AS x, unnest(range(1, {dims + 1})) AS j FROM a{i} a JOIN kept USING (row)
        ) GROUP BY cluster, j
      )
    ) GROUP BY cluster
  ) m ON m.cluster = c.cluster
)""")
    return f"""
WITH {", ".join(steps)}
SELECT k.vec_id, a.cluster::INTEGER AS cluster, a.distance, sum(a.distance) OVER (PARTITION BY a.cluster)::BIGINT AS cluster_inertia, sum(a.distance) OVER ()::BIGINT AS inertia,
       sha256(array_to_string(c.z, ',')) AS centroid_sha256, count(*) OVER (PARTITION BY a.cluster) AS cluster_size
FROM a{rounds} a JOIN kept k USING (row) JOIN c{rounds} c ON c.cluster = a.cluster
"""
