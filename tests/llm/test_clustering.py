"""Clustering against the plain rounds, and the bounds against points in the sphere."""

import hashlib
import math

import numpy as np
import pytest

from marketlake.llm import clustering as C
from marketlake.llm.queries import QUERIES

VECTORS = "vec_id long, embedding array<double>, cluster string, upper int, v string"


def plain(rows, k=8, rounds=10, size=64):
    """[(id, cluster, distance, cluster inertia, inertia, centroid)]"""
    kept = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows
            if v is not None and len(v) == size and all(x is not None and math.isfinite(x) and abs(x) < 2**14 for x in v)]

    def salted(r):
        h = hashlib.sha256(f"3:{r[0]}".encode()).hexdigest()
        return (r[0] is None, h, np.array(r[1], "<i4").tobytes())
    c = [v for _, v in sorted(kept, key=salted)[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, x)), j) for j, x in enumerate(c))
    for _ in range(rounds):
        own = [nearest(v)[1] for _, v in kept]
        c = [[sum(col) // own.count(j) for col in zip(*(v for (_, v), o in zip(kept, own) if o == j))] if j in own else c[j] for j in range(len(c))]
    near = [nearest(v) for _, v in kept]
    total = {j: sum(d for d, o in near if o == j) for j in range(len(c))}
    return sorted(((i, o, d, total[o], sum(total.values()), c[o]) for (i, _), (d, o) in zip(kept, near)), key=repr)


def hard_rows(size=64):
    r = np.random.RandomState(4)
    centre = r.randn(5, size)
    rows = [(i, (centre[i % 5] + 0.3 * r.randn(size)).tolist()) for i in range(150)]
    grid = [(200 + i, [float(i % 3)] * size) for i in range(9)]  # ties
    odd = [(300, None), (301, []), (302, [1.0] * (size - 1)), (303, [None] + [1.0] * (size - 1)), (304, [math.nan] * size),
           (305, [math.inf] + [0.0] * (size - 1)), (306, [1e300] * size), (307, [0.0] * size), (308, [-0.0005] * size), (None, rows[3][1]), rows[4], rows[4]]
    return rows + grid + odd


def rows_of(df):
    return sorted((tuple(x) for x in df.collect()), key=repr)


def table(spark, rows):
    return spark.createDataFrame([(i, v, "x", 1, "y") for i, v in rows], VECTORS)


def test_equals_plain_rounds(spark):
    rows = hard_rows()
    assert rows_of(C.cluster(table(spark, rows))) == plain(rows)


@pytest.mark.parametrize("n", [0, 1, 5])
def test_few_vectors(spark, n):
    rows = hard_rows()[:n]
    df = C.cluster(table(spark, rows))
    assert df.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid"]
    assert rows_of(df) == plain(rows)


def test_later_rounds_scan_few_vectors(spark):
    work = []
    r = np.random.RandomState(1)
    rows = [(i, (8 * np.eye(64)[i % 6] + 0.2 * r.randn(64)).tolist()) for i in range(600)]
    assert rows_of(C.cluster(table(spark, rows), work=work)) == plain(rows)
    assert work[0] == 600 and work[-1] < 200


def test_loosening_bounds_all_points_of_the_sphere():
    r = np.random.RandomState(0)
    tighter = 0
    for _ in range(400):
        d = r.randint(2, 6)
        centre, old = 10 * r.randn(d), 10 * r.randn(d)
        new = old + r.randn(d) * r.choice([0.01, 1, 10])
        radius = float(r.choice([0.0, 0.1, 2, 30]))
        u = r.randn(2000, d)
        x = centre + radius * u / np.linalg.norm(u, axis=1)[:, None] * r.rand(2000, 1) ** (1 / d)
        less = (np.linalg.norm(x - old, axis=1) - np.linalg.norm(x - new, axis=1)).max()
        bound, drift = C.loosening(centre, radius, old, new), np.linalg.norm(new - old)
        assert less <= bound + 1e-9 and bound <= drift
        tighter += bound < 0.9 * drift
    assert tighter > 100
    assert C.loosening(np.zeros(3), 1.0, np.ones(3), np.ones(3)) == 0


def test_query_reads_its_whole_table(spark):
    df = QUERIES["op12_clustering"](spark, "/root/testdata/sf0.001")
    assert df.count() == spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").count()
