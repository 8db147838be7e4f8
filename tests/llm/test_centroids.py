"""Kd-tree filtering against plain loops over all vectors and centroids."""

import hashlib
import random

import duckdb
import numpy as np
import pytest

from siltstone.llm import centroids as C


def plain(rows, k, rounds, dims):
    """(vec_id, cluster, distance) by the definition, in Python integers."""
    kept = [(i, [int(np.floor(C.SCALE * float(x))) for x in v]) for i, v in rows if v is not None and len(v) == dims and all(x is not None and np.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"{C.SALT}{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    z = [v for _, v in order[:k]]
    near = lambda v: min(((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(z)))
    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(near(v)[1], []).append(v)
        z = [[sum(x) // len(groups[j]) for x in zip(*groups[j])] if j in groups else c for j, c in enumerate(z)]
    return sorted(((i, near(v)[1], near(v)[0]) for i, v in kept), key=repr)


def table(spark, rows):
    return spark.createDataFrame([(i, v, 1, 0.5) for i, v in rows], "vec_id long, embedding array<float>, cluster int, distance double").repartition(3)


@pytest.mark.parametrize("spread", [0.02, 1.0, 3000.0])
def test_equals_plain_loops(spark, spread):
    """Close, usual and wide vectors (the last go through int64), with ties, copies and vectors that are left out."""
    r = random.Random(4)
    point = lambda: [float(np.float32(r.gauss(0, spread))) for _ in range(4)]
    rows = [(i, point()) for i in range(700)] + [(i, [0.0, 0.0, 0.0, 0.0]) for i in range(700, 900)] + [(i, [float(r.randint(-1, 1)) for _ in range(4)]) for i in range(900, 1100)]
    rows += [rows[0], rows[750], (None, point()), (2000, None), (2001, [1.0]), (2002, [1.0, None, 0.0, 0.0]), (2003, [1.0, float("nan"), 0.0, 0.0]), (2004, [1.0, float("-inf"), 0.0, 0.0]), (2005, [])]
    got = C.cluster(table(spark, rows), k=17, rounds=4, dims=4).collect()
    assert sorted(((g["vec_id"], g["cluster"], g["distance"]) for g in got), key=repr) == plain(rows, 17, 4, 4)
    by = {}
    for g in got:
        by.setdefault(g["cluster"], []).append(g)
    for gs in by.values():
        assert {g["cluster_inertia"] for g in gs} == {sum(g["distance"] for g in gs)} and {g["cluster_size"] for g in gs} == {len(gs)}
    assert {g["inertia"] for g in got} == {sum(g["distance"] for g in got)}


def test_few_equal_huge_and_no_vectors(spark):
    few = [(1, [0.5, 0.5]), (2, [0.5, 0.5]), (3, [1e30, -1e30])]
    got = {r["vec_id"]: (r["cluster"], r["distance"]) for r in C.cluster(table(spark, few), k=40, rounds=2, dims=2).collect()}
    assert got[1] == got[2] and got[3][1] == 0 and got[1][1] == 0
    assert C.quantised(table(spark, few), 2).where("vec_id = 3").first()["q"] == [C.LIMIT, -C.LIMIT]
    assert C.cluster(table(spark, []), dims=2).count() == 0


def test_trees_prune_and_assign_whole_nodes():
    """Well-separated groups: whole nodes go to one centroid, and their sums are those of their points."""
    rng = np.random.default_rng(0)
    points = np.concatenate([rng.integers(0, 50, (500, 3)) + 10_000 * i for i in range(4)])
    tree = C.build(points)
    z = np.array([[25 + 10_000 * i] * 3 for i in range(4)])
    nodes = list(C.walk(tree, z))
    assert sum(b - a for a, b, *_ in nodes) == 2000 and sum(b - a for a, b, _, node in nodes if node >= 0) == 2000 and len(nodes) < 20
    for a, b, c, node in nodes:
        assert (tree["sums"][node] == tree["points"][a:b].sum(0)).all() and (tree["points"][a:b] // 10_000 == c).all()


def test_a_tie_at_every_corner_is_kept():
    """A centroid that only ties is not pruned, and the smaller number wins."""
    assert C.remaining(np.array([0, 0]), np.array([0, 4]), np.array([0, 1]), np.array([[-1, 2], [1, 2]])).tolist() == [0, 1]


@pytest.mark.parametrize("sf", ["sf0.01"])
def test_whole_table_equals_sql(spark, sf):
    got = C.cluster(spark.read.parquet(f"/root/testdata/{sf}/embeddings.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '/root/testdata/{sf}/embeddings.parquet'")
    want = con.execute(C.oracle_sql())
    names = [d[0] for d in want.description]
    assert sorted(tuple(r) for r in got.select(*names).collect()) == sorted(want.fetchall())
