import hashlib
import random
import re

import edge
import numpy as np
from pyspark.sql import types as T

from footfall.llm import decontaminate as d

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {i: i + 32 for i in range(65, 91)}
ITEMS = T.StructType([T.StructField("item_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("row", T.StringType())])


def words(text):
    return WORDS.findall((text or "").translate(LOWER))


def brute(text, items):
    own, hit, found = words(text), set(), set()
    for item_id, item in items:
        other = words(item)
        n = min(len(other), 13)
        windows = {tuple(other[i : i + n]) for i in range(len(other) - n + 1)} if n else set()
        for i in range(len(own) - n + 1):
            if n and tuple(own[i : i + n]) in windows:
                hit |= set(range(i, i + n))
                found |= {str(item_id)} if item_id is not None else set()
    digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
    return len(own), len(hit), len(found), digest, bool(hit) and 20 * len(hit) >= len(own)


def check(spark, docs, items):
    bench = spark.createDataFrame([(i, t, "clash") for i, t in items], ITEMS)
    rows = d.contamination(docs, bench).collect()
    assert len(rows) == docs.count()
    want = sorted(repr((r.doc_id, *brute(r.text, items))) for r in docs.collect())
    got = sorted(repr((r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated)) for r in rows)
    assert got == want


def test_random_texts_equal_brute_force(spark):
    rng = random.Random(3)
    vocabulary = ["alpha", "Beta", "γάμμα", "d4", "e", "straße"]

    def text(n):
        return rng.choice([" ", ", ", "\n"]).join(rng.choice(vocabulary[:3] if n % 2 else vocabulary) for _ in range(n))

    items = [(i, text(rng.choice([1, 2, 3, 5, 12, 13, 14, 30]))) for i in range(40)]
    parts = [t for _, t in items]
    texts = [text(5) + " " + rng.choice(parts) + " " + text(rng.randint(0, 60)) for _ in range(60)]
    check(spark, edge.texts(spark, *texts), items)


def test_edges(spark):
    copies = [(i, edge.PROSE) for i in range(30)]
    items = [*copies, (3, edge.PROSE), (None, edge.SHORT), (40, None), (41, ""), (42, "word"), (43, "!!"), (10, "quick brown")]
    check(spark, edge.documents(spark), items)
    check(spark, edge.empty(spark), items)
    check(spark, edge.documents(spark), [])


def test_stage_drops_contaminated_only(spark):
    docs = edge.documents(spark)
    bench = spark.createDataFrame([(1, edge.PROSE, "")], ITEMS)
    kept = d.drop_contaminated(docs, bench)
    assert kept.columns == docs.columns
    assert kept.count() == len(edge.ROWS) - sum((t or "").startswith(edge.PROSE) for _, t, _ in edge.ROWS)


def test_posts_are_thinned_and_still_meet():
    """Neighbouring windows share posts; of any two texts with 13 words in common, a post agrees in place."""
    rng = np.random.RandomState(2)
    texts = [rng.randint(0, 1 << 40, n).astype(np.uint64) for n in (12, 13, 40, 400, 2000)]
    words, first = np.concatenate(texts), np.cumsum([0] + [len(t) for t in texts])
    place, prints = d._posts(words, first)
    own = np.searchsorted(first, place, side="right") - 1
    assert (own == 0).sum() == 0 and (own == 1).sum() == 1
    assert (own == 4).sum() < 0.45 * 2000
    at = {int(p) for p in place}
    for begin in range(first[4], first[5] - 12):
        assert any(begin <= p <= begin + 5 for p in at & set(range(begin, begin + 6)))
    again, marks = d._posts(np.concatenate([texts[0], texts[4][100:140], texts[1]]), np.array([0, 12, 52, 65]))
    shared = {int(p) - 12 + 100 for p in again if 12 <= p < 52}
    assert shared <= {int(p - first[4]) for p in place[own == 4]}


def test_the_join_is_on_fingerprints_alone(spark):
    schema = "row long, print long, start int, size int, gram array<long>, before array<long>, after array<long>, context string"
    gram = list(range(8))
    mine = [(1, 5, 20, 0, gram, [1, 2, 3], [4, 5, 6], ""), (2, 5, 20, 0, gram, [1, 9], [4, 9], ""), (3, 5, 20, 0, [7] * 8, [1, 2, 3], [4, 5], "")]
    theirs = [(0, 5, 0, 0, gram, [1, 2], [4, 5, 6, 7, 8], "c")]
    posts, contexts = spark.createDataFrame(mine, schema), spark.createDataFrame(theirs, schema)
    found = d.hits(posts.drop("context"), contexts.drop("row", "start"))
    assert [tuple(r) for r in found.collect()] == [(1, 18, 13, "c")]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Join Inner" in plan and "(print#" in plan


def test_long_shared_spans_with_repeated_grams(spark):
    """Texts of few words, where grams repeat and ties abound."""
    rng = random.Random(9)
    items = [(i, " ".join(rng.choice("ab") for _ in range(rng.choice([13, 14, 40])))) for i in range(6)]
    items += [(20, "a " * 60), (21, "b a " * 30)]
    texts = [" ".join(rng.choice("ab") for _ in range(80)) for _ in range(12)] + ["a " * 100, "a b " * 20, "b " * 12]
    texts += [" ".join(["x"] * 3 + items[i][1].split() + ["y"]) for i in range(8)]
    check(spark, edge.texts(spark, *texts), items)
