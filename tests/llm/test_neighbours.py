import numpy as np

from footfall.llm import neighbours as n
from footfall.llm.shared import table

SCHEMA = "vec_id long, embedding array<float>, label int, score string, entry string"


def brute(ids, vectors, every=20, top=20):
    found = {}
    for i in np.flatnonzero(ids % every == 0):
        scores = vectors @ vectors[i]
        order = [j for j in np.lexsort((ids, -scores)) if ids[j] != ids[i]][:top]
        found[int(ids[i])] = [(int(ids[j]), float(scores[j])) for j in order]
    return found


def result(frame):
    found = {}
    for r in n.nearest(frame).orderBy("query_id", "rank").collect():
        assert r["rank"] == len(found.setdefault(r.query_id, [])) + 1
        found[r.query_id].append((r.vec_id, r.score))
    return found


def frame(spark, ids, vectors):
    rows = [(int(i), None if v is None else [None if x is None else float(x) for x in v], 0, "x", "x") for i, v in zip(ids, vectors)]
    return spark.createDataFrame(rows, SCHEMA)


def test_recall_against_brute_force(spark):
    rows = table(spark, "/root/testdata/sf0.1", "embeddings")
    data = rows.toArrow()
    ids, vectors = data["vec_id"].to_numpy(), np.array(data["embedding"].to_pylist(), dtype=np.float64)
    want, got = brute(ids, vectors), result(rows)
    assert got.keys() == want.keys()
    shared = [len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want]
    assert sum(shared) >= 0.95 * 20 * len(want)
    scores = {q: dict(zip(ids.tolist(), vectors @ vectors[ids == q][0])) for q in list(want)[:10]}
    assert all(abs(scores[q][i] - s) < 1e-12 for q in scores for i, s in got[q])


def test_inner_product_with_lengths_and_ties(spark):
    rng = np.random.RandomState(0)
    ids = np.arange(300)
    vectors = np.round(rng.randn(300, 6) * rng.choice([0.1, 1, 5], 300)[:, None]).astype(np.float32).astype(np.float64)
    vectors[100:220] = vectors[7] + 1
    keep = vectors.any(axis=1)
    got, want = result(frame(spark, ids, vectors)), brute(ids[keep], vectors[keep])
    assert got.keys() == want.keys()
    shared = [len(set(got[q]) & set(want[q])) for q in want]
    assert sum(shared) >= 0.95 * 20 * len(want)
    assert all(v == sorted(v, key=lambda x: (-x[1], x[0])) and len(v) == 20 for v in got.values())


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    vectors = [[1, 0], [1, 0], None, [0, 0], [nan, 1], [inf, 1], [1, None], [], [1, 2, 3], [0, 1], [-1, 0], [1, 0]]
    ids = [0, 20, 40, 60, 80, 100, 120, 140, 160, 3, 5, 20]
    rows = frame(spark, ids, vectors).union(spark.createDataFrame([(None, [1.0, 0.0], 0, "x", "x")], SCHEMA))
    assert result(rows) == {
        0: [(20, 1.0), (3, 0.0), (5, -1.0)],
        20: [(0, 1.0), (3, 0.0), (5, -1.0)],
    }
    assert result(rows.where("false")) == {}
    assert result(frame(spark, [20], [[1, 0]])) == {}


def test_long_files_are_searched_in_blocks(spark, monkeypatch):
    rng = np.random.RandomState(4)
    ids, vectors = np.arange(400), rng.randn(400, 8).astype(np.float32).astype(np.float64)
    monkeypatch.setattr(n, "BLOCK_MEMBERS", 10)
    got, want = result(frame(spark, ids, vectors)), brute(ids, vectors)
    assert sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want) >= 0.95 * 20 * len(want)


def test_blocks_of_queries_change_nothing(spark, monkeypatch):
    rng = np.random.RandomState(6)
    ids, vectors = np.arange(0, 1500, 5), rng.randn(300, 8).astype(np.float32).astype(np.float64)
    rows = frame(spark, ids, vectors)
    want = result(rows)
    monkeypatch.setattr(n, "BLOCK_QUERIES", 3)
    assert result(rows) == want


def test_pivots_follow_the_entries(spark, monkeypatch):
    rng = np.random.RandomState(7)
    index = spark.createDataFrame([(str(i), bytes(rng.randn(4).tobytes())) for i in range(200)], "entry string, vector binary")
    monkeypatch.setattr(n, "PIVOTS", 8)
    assert [len(n._pivots(index, 99.0, count)) for count in (10, 400, 10**8)] == [8, 20, 50]
