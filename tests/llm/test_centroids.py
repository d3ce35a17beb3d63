import hashlib

import numpy as np
from pyspark.sql import functions as F

from footfall.llm import centroids as c
from footfall.llm.shared import table

SCHEMA = "vec_id long, embedding array<double>, cluster string, point string, distance string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "x", "x", "x") for i, v in rows], SCHEMA)


def brute(rows, dimensions, clusters, rounds):
    """Everything in Python integers, one vector and one centroid at a time."""
    kept = []
    for i, v in rows:
        if v is not None and len(v) == dimensions and all(x is not None and np.isfinite(x) for x in v):
            kept.append((i, [int(max(min(np.floor(256 * x), c.LARGEST), -c.LARGEST)) for x in v]))
    draw = sorted((hashlib.sha256(f"2:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)
    centres = [v for _, v in draw[:clusters]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, centre)), k) for k, centre in enumerate(centres))

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(nearest(v)[1], []).append(v)
        centres = [[sum(x) // len(groups[k]) for x in zip(*groups[k])] if k in groups else v for k, v in enumerate(centres)]
    found = [(i, *nearest(v)) for i, v in kept]
    total = {k: sum(d for _, d, j in found if j == k) for k in range(len(centres))}
    names = [hashlib.sha256(",".join(map(str, v)).encode()).hexdigest() for v in centres]
    return [(i, k, d, total[k], sum(total.values()), names[k]) for i, d, k in found]


def same(spark, rows, dimensions, clusters, rounds):
    got, _ = c.clustered(frame(spark, rows), clusters, rounds, dimensions)
    want = brute(rows, dimensions, clusters, rounds)
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want))
    return want


def test_equals_brute_force_with_ties_and_repeats(spark):
    rng = np.random.RandomState(1)
    rows = [(int(i), (rng.randint(-6, 6, 5) / 256).tolist()) for i in range(300)]
    rows += [(7, [0.0] * 5)] * 150 + [(7, [0.01] * 5), (None, [0.02] * 5), (None, [0.5] * 5)]
    same(spark, rows, 5, 12, 4)


def test_clusters_that_lose_all_vectors_stay(spark):
    rows = [(i, [0.0, 0.0]) for i in range(30)] + [(99, [1.0, 1.0])]
    want = same(spark, rows, 2, 6, 3)
    assert len({r[1] for r in want}) < 6


def test_unusable_and_huge_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None), (2, []), (3, [1.0]), (4, [1.0, None]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [1e300, -1e300])]
    rows += [(8, [0.1, 0.2]), (9, [-0.1, -0.0039]), (10, [1.0, 2.0, 3.0])]
    want = same(spark, rows, 2, 2, 2)
    assert sorted(r[0] for r in want) == [7, 8, 9]


def test_fewer_rows_than_centroids_and_none(spark):
    same(spark, [(1, [0.5, 0.5]), (2, [0.25, 0.5])], 2, 40, 5)
    got, centres = c.clustered(frame(spark, [(1, None)]))
    assert got.collect() == [] and len(centres) == 0
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def test_tables_equal_plain_distances():
    rng = np.random.RandomState(3)
    points, centres = rng.randint(-500, 500, (700, 9)), rng.randint(-500, 500, (11, 9))
    assert (c.distances(points, centres) == ((points[:, None] - centres[None]) ** 2).sum(axis=2)).all()


def test_partitions_do_not_matter(spark):
    rows = table(spark, "/root/testdata/sf0.01", "embeddings")
    one, _ = c.clustered(rows.repartition(1))
    many, _ = c.clustered(rows.repartition(13, F.rand(3)))
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, many.collect()))
