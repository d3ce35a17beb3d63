import random
import re

import edge
import numpy as np
from pyspark.sql import functions as F

from footfall.llm import components, shared
from footfall.llm import neardup as n
from footfall.llm.components import connected_components

LOWER = {i: i + 32 for i in range(65, 91)}


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} - {()}


def closure(nodes, links):
    best = {x: x for x in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(best[a], best[b])
            changed |= best[a] != low or best[b] != low
            best[a] = best[b] = low
    return best


def brute(rows):
    sets = [(i, shingles(t)) for i, t in rows if i is not None]
    links = [
        (a, b)
        for k, (a, x) in enumerate(sets)
        for b, y in sets[:k]
        if a == b or x and y and 100 * len(x & y) >= 75 * len(x | y)
    ]
    best = closure({i for i, _ in sets}, links)
    return sorted(repr((i, len(shingles(t)), best.get(i), i is None or best[i] == i)) for i, t in rows)


def result(docs):
    return sorted(repr((r.doc_id, r.n_shingles, r.component_id, r.kept)) for r in n.near_duplicates(docs).collect())


def edited(rng, words, share):
    return " ".join(rng.choice("abcdefgh") + str(rng.randint(0, 99)) if rng.random() < share else w for w in words)


def test_groups_of_near_copies_equal_brute_force(spark):
    rng = random.Random(5)
    texts = []
    for size, share in [(120, 0.02), (60, 0.04), (2, 0.01), (10, 0.0), (30, 0.03)]:
        base = [f"w{rng.randint(0, 500)}" for _ in range(rng.randint(6, 150))]
        texts += [edited(rng, base, share) for _ in range(size)]
    rng.shuffle(texts)
    docs = edge.texts(spark, *texts)
    assert result(docs) == brute(list(enumerate(texts)))


def test_blocks_give_the_same_links(spark, monkeypatch):
    rng = random.Random(6)
    base = [f"w{i}" for i in range(60)]
    texts = [edited(rng, base, 0.03) for _ in range(150)]
    monkeypatch.setattr(n, "BLOCK_MEMBERS", 8)
    assert result(edge.texts(spark, *texts)) == brute(list(enumerate(texts)))


def test_edges(spark):
    docs = edge.documents(spark)
    assert result(docs) == brute([(i, t) for i, t, _ in edge.ROWS])
    assert result(edge.empty(spark)) == []
    kept = n.keep_one(docs)
    assert kept.columns == docs.columns
    # 5 is a copy of 4, 7 a near copy of 6, which is there twice; rows without an id stay.
    ids = sorted((r.doc_id for r in kept.collect()), key=lambda i: i or 0)
    assert ids == [None, None, 1, 2, 3, 4, 6, 8, 9, 10, 11, 12]
    assert n.keep_one(edge.empty(spark)).count() == 0


def test_components(spark):
    rng = random.Random(1)
    path = [(i, i + 1) for i in range(0, 60)]
    rng.shuffle(path)
    edges = path + [(100, 100), (200, 201), (201, 200), (201, 202)] + [(300, i) for i in range(301, 340)]
    got = dict(connected_components(spark.createDataFrame(edges, "a long, b long")).collect())
    want = closure({x for e in edges for x in e}, edges)
    del want[100]
    assert got == want
    assert connected_components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_split_joins_equal_plain_ones(spark, monkeypatch):
    rows = spark.createDataFrame([(i % 7 if i % 3 else 0, i) for i in range(300)] + [(None, -1)], "k long, x long")
    other = spark.createDataFrame([(0, "a"), (0, "b"), (1, "c"), (9, "d"), (None, "e")], "k long, y string")
    for how in ("inner", "left"):
        want = sorted(map(repr, rows.join(other, ["k"], how).collect()))
        for most in (1, 20, 1000):
            monkeypatch.setattr(shared, "SPLIT_ROWS", most)
            assert sorted(map(repr, shared.join_split(rows, other, ["k"], "x", how).collect())) == want
    assert shared.join_split(rows.limit(0), other, ["k"], "x").collect() == []


def test_bloom_grows_with_its_keys_to_a_bound():
    assert shared.bloom_bits(0) == shared.bloom_bits(1000) == shared.BLOOM_BITS
    assert shared.bloom_bits(4_000_000) == 1 << 26
    assert shared.bloom_bits(10**12) == shared.MOST_BLOOM_BITS


def test_a_hot_bucket_of_unlinked_members(spark):
    """20,000 texts share a long passage, so that many meet in a bucket; hidden among them are pairs."""
    passage = " ".join(f"p{i}" for i in range(60))
    size, pairs = 20_000, [(5, 19_000), (700, 701), (8_000, 12_345)]
    twin = {b: a for a, b in pairs}
    text = F.concat(F.lit(passage + " "), F.array_join(F.transform(F.sequence(F.lit(1), F.lit(45)), lambda w: F.concat(F.lit("w"), F.xxhash64("like", w).cast("string"))), " "))
    like = F.col("doc_id")
    for b, a in twin.items():
        like = F.when(F.col("doc_id") == b, a).otherwise(like)
    docs = spark.range(size).withColumnRenamed("id", "doc_id").withColumn("like", like).withColumn("text", text)
    docs = docs.withColumn("text", F.when(F.col("doc_id").isin(list(twin)), F.concat("text", F.lit(" end"))).otherwise(F.col("text")))
    found = {r.doc_id: r.component_id for r in n.near_duplicates(docs).where("NOT kept").collect()}
    assert found == twin


def counted(monkeypatch, *modules):
    """The labels of the tables that ``modules`` write from now on."""
    labels = []
    for module in modules:
        monkeypatch.setattr(module, "written", lambda frame, label: labels.append(label) or shared.written(frame, label))
    return labels


def test_links_of_one_task_need_one_round(spark, monkeypatch):
    """Each round is a shuffle of all links, of as many tasks as the session's shuffles have."""
    path = [(i, i + 1) for i in range(200)]
    random.Random(2).shuffle(path)
    tables = counted(monkeypatch, components)
    got = dict(connected_components(spark.createDataFrame(path, "a long, b long").coalesce(1)).collect())
    assert got == {i: 0 for i in range(201)}
    assert len(tables) == 2


def test_near_copies_in_few_tables(spark, monkeypatch):
    """One group of near copies about the limit, in which many pairs share several buckets and aren't linked."""
    rng = random.Random(8)
    base = [f"w{i}" for i in range(80)]
    texts = [edited(rng, base, rng.choice([0.02, 0.03, 0.05])) for _ in range(220)]
    tables = counted(monkeypatch, n, components)
    assert result(edge.texts(spark, *texts)) == brute(list(enumerate(texts)))
    assert len(tables) <= 24


def test_chunks_of_links_become_stars():
    rng = random.Random(3)
    for links in range(1, 40):
        edges = [(rng.randint(-9, 30), rng.randint(-9, 30)) for _ in range(links)]
        u, v = (np.array([f(e) for e in edges], dtype=np.int64) for f in (max, min))
        want = closure({x for e in edges for x in e}, edges)
        found = [x.tolist() for x in components._least_linked(u, v)]
        assert len(found[0]) == len(set(found[0]))
        assert dict(zip(*found)) == {node: least for node, least in want.items() if node != least}


def test_a_member_with_two_texts_leaves_no_pair_to_an_earlier_bucket():
    sets = [np.arange(i, i + 60, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) for i in (0, 0, 1)]
    keys = n._band_keys(np.array([n._minima(x) for x in sets], dtype=np.uint32)).view(np.int64)
    last = int(np.flatnonzero((keys == keys[0]).all(axis=0))[-1])
    earlier, single = n._earlier_bands(int(keys[0, last]), np.array([4, 7, 7]), sets)
    assert earlier.tolist() == keys[:, :last].tolist()
    assert single.tolist() == [True, False, False]
