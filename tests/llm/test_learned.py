import edge
import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from footfall.llm import language, quality
from footfall.llm.shared import held_out, of_bounded_bytes, table
from footfall.llm.text import grams, mix

SF = "/root/testdata/sf0.01"


def test_grams_stay_within_texts():
    texts = ["Abc de", None, "x", "..", "né é!", ""]
    own = [" abc de", " ", " x", " ", " né é", " "]
    ((grams, firsts, letters),) = language.gram_buckets(pa.array(texts))
    assert letters.tolist() == [5, 0, 1, 0, 3, 0]
    for i, text in enumerate(own):
        # Runs of other characters are one space, and one more space closes each text.
        counts = [(b[firsts[i] : firsts[i + 1]] < language.BUCKETS).sum() for b in grams]
        closed = len(text) + (texts[i] is not None and texts[i][-1:] in (".", "!") and text != " ")
        assert counts == [closed, closed, closed - 1]
    alike = [list(language.gram_buckets(pa.array([t])))[0][0] for t in ("Größe", "GRÖßE")]
    assert all((a == b).all() for a, b in zip(*alike))


def test_language_held_out_accuracy(spark):
    docs = table(spark, SF, "documents")
    found = language.predictions(docs).join(docs.select("doc_id", "lang"), "doc_id")
    rows = found.where("held_out").collect()
    assert len(rows) > 200
    assert np.mean([r.lang == r.lang_pred for r in rows]) > 0.98
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_never_sees_held_out_labels(spark):
    docs = table(spark, SF, "documents")
    spoiled = docs.withColumn("lang", F.when(held_out(), "xx").otherwise(F.col("lang")))
    assert "xx" not in language.train(spoiled).languages


def test_language_edges(spark):
    docs = edge.documents(spark)
    rows = language.predictions(docs).collect()
    assert len(rows) == len(edge.ROWS)
    by = {r.doc_id: r for r in rows}
    assert [by[i].lang_pred for i in (1, 2, 3, 10, 12)] == ["und"] * 5
    assert by[1].score == 0 and by[4].lang_pred == by[5].lang_pred != "und"
    assert language.predictions(edge.empty(spark)).collect() == []
    assert {r.lang_pred for r in language.predictions(docs.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
    kept = language.keep_known(docs)
    assert kept.columns == docs.columns and kept.where("doc_id IN (1, 2, 3, 10, 12)").isEmpty()
    assert language.keep_known(edge.empty(spark)).collect() == []


def test_temperature_lowers_loss():
    logits = np.array([[4.0, 0.0], [0.0, 4.0], [4.0, 0.0], [4.0, 0.0]])
    labels = np.array([0, 1, 1, 0])
    assert language._best_temperature(logits, labels) > 2


def test_quality_held_out(spark):
    found = quality.score(table(spark, SF, "documents"), table(spark, SF, "labels"))
    rows = found.join(table(spark, SF, "labels"), "doc_id").where("held_out").collect()
    good, bad = ([r.score for r in rows if r.quality == q] for q in (1, 0))
    assert len(bad) > 5
    assert np.mean([[g > b for g in good] for b in bad]) > 0.97
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.95


def test_quality_edges(spark):
    docs = edge.documents(spark)
    labels = spark.createDataFrame([(i, i % 2, None, "x") for i in [*range(1, 13), 3]] + [(None, 1, 0, "x"), (4, None, 0, "x")], "doc_id long, quality int, toxic int, n string")
    rows = quality.score(docs, labels).collect()
    assert len(rows) == len(edge.ROWS)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    assert len({r.score for r in rows if r.doc_id in (1, 2, 3)}) == 1
    assert {r.score for r in quality.score(docs, labels.where("false")).collect()} == {0.5}
    assert quality.score(edge.empty(spark), labels).collect() == []


def test_quality_ignores_held_out_labels(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    spoiled = labels.withColumn("quality", F.when(held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    one, two = (quality.train(docs, x) for x in (labels, spoiled))
    assert np.array_equal(one.table, two.table) and one.bias == two.bias


def test_more_languages_than_are_learned_give_rows(spark, monkeypatch):
    """1,500 languages; the most frequent ones are learned, and every text gets a row."""
    monkeypatch.setattr(language, "MOST_LANGUAGES", 20)
    rows = [(i, f"{chr(97 + i % 20) * 4} {chr(97 + (i + 3) % 20) * 5}", f"l{i % 20:02d}", None, None) for i in range(400)]
    rows += [(1000 + i, f"text number {i}", f"rare{i}", None, None) for i in range(1500)]
    got = language.predictions(spark.createDataFrame(rows, edge.SCHEMA)).collect()
    assert len(got) == 1900 and {r.lang_pred for r in got} <= {f"l{i:02d}" for i in range(20)}
    held = [r for r in got if r.held_out and r.doc_id < 400]
    assert sum(r.lang_pred == f"l{r.doc_id % 20:02d}" for r in held) > 0.9 * len(held)


def test_training_steps_equal_plain_loops():
    """FTRL-proximal, feature by feature and class by class."""
    rng = np.random.RandomState(0)
    rows = [(np.append(np.sort(rng.choice(30, 5, replace=False)), language.BUCKETS), rng.rand(6)) for _ in range(25)]
    labels, order = rng.randint(0, 3, 25), rng.permutation(25)
    z, n = {}, {}

    def weight(i, c):
        a = z.get((i, c), 0.0)
        if abs(a) <= language.L1:
            return 0.0
        return -(a - np.sign(a) * language.L1) / ((language.BETA + np.sqrt(n.get((i, c), 0.0))) / language.ALPHA + language.L2)

    for _ in range(language.EPOCHS):
        for r in order:
            index, value = rows[r]
            scores = [sum(v * weight(i, c) for i, v in zip(index, value)) for c in range(3)]
            total = sum(np.exp(x) for x in scores)
            step = {}
            for c in range(3):
                error = np.exp(scores[c]) / total - (labels[r] == c)
                for i, v in zip(index, value):
                    step[i, c] = (v * error, weight(i, c))
            for key, (g, w) in step.items():
                old = n.get(key, 0.0)
                z[key] = z.get(key, 0.0) + g - (np.sqrt(old + g * g) - np.sqrt(old)) / language.ALPHA * w
                n[key] = old + g * g
    table, bias = language._ftrl(rows, labels, 3, order)
    assert all(abs(table[i, c] - weight(i, c)) < 1e-9 for i in range(30) for c in range(3))
    assert all(abs(bias[c] - weight(language.BUCKETS, c)) < 1e-9 for c in range(3))


def test_descent_equals_plain_loops():
    """Softmax over a mean of feature vectors, text by text, feature by feature."""
    rng = np.random.RandomState(3)
    vectors = [(np.sort(rng.choice(40, 6, replace=False)), rng.randint(1, 4, 6)) for _ in range(20)]
    vectors.append((np.empty(0, np.int64), np.empty(0, np.int64)))
    y = rng.randint(0, 2, len(vectors))
    draw = np.random.RandomState(11)
    start = (draw.random_sample((quality.BUCKETS, quality.DIMENSIONS)) - 0.5) / quality.DIMENSIONS
    emb = {i: list(start[i]) for i in range(40)}
    layer, bias, step = [[0.0, 0.0] for _ in range(quality.DIMENSIONS)], [0.0, 0.0], 0
    for _ in range(quality.EPOCHS):
        for i in draw.permutation(len(vectors)):
            rate = quality.RATE * (1 - step / (quality.EPOCHS * len(vectors)))
            step += 1
            share = {b: c / vectors[i][1].sum() for b, c in zip(*vectors[i])}
            if not share:
                continue
            hidden = [sum(w * emb[b][d] for b, w in share.items()) for d in range(quality.DIMENSIONS)]
            odds = [sum(h * layer[d][c] for d, h in enumerate(hidden)) + bias[c] for c in (0, 1)]
            error = [np.exp(odds[c]) / (np.exp(odds[0]) + np.exp(odds[1])) - (y[i] == c) for c in (0, 1)]
            back = [sum(layer[d][c] * error[c] for c in (0, 1)) for d in range(quality.DIMENSIONS)]
            for c in (0, 1):
                bias[c] -= rate * error[c]
                for d, h in enumerate(hidden):
                    layer[d][c] -= rate * h * error[c]
            square = sum(w * w for w in share.values())
            for b, w in share.items():
                emb[b] = [e - rate * w / square * x for e, x in zip(emb[b], back)]
    embedding, found, bias_found = quality._descend(vectors, y)
    assert np.allclose(embedding[:40], [emb[i] for i in range(40)], atol=1e-9)
    assert np.allclose(found, layer, atol=1e-9) and np.allclose(bias_found, bias, atol=1e-9)


def test_quality_grams_are_of_characters():
    texts = ["Größe né", None, "日本語です x", "", "a\u00a0b 😀😀😀😀"]
    for kinds in quality.features(pa.array(texts)):
        for kind, n in ((2, 3), (3, 4)):
            buckets, firsts = kinds[kind]
            for i, text in enumerate(texts):
                words = [w for w in (text or "").split(" ") if w]
                codes = [[int.from_bytes(c.encode(), "big") for c in w] for w in words]
                runs = [w[k : k + n] for w in codes for k in range(len(w) - n + 1)]
                want = [(mix(grams(np.array(r, dtype=np.uint64), n) + np.uint64(kind)) >> np.uint64(46)).item() for r in runs]
                assert buckets[firsts[i] : firsts[i + 1]].tolist() == want


def test_training_samples_are_bounded_in_bytes(spark):
    rows = spark.createDataFrame([(i, "é" * i) for i in range(10)] + [(99, None)], "doc_id long, text string")
    assert of_bounded_bytes(rows, 90).count() == 11
    assert {r.doc_id for r in of_bounded_bytes(rows, 31).collect()} == {0, 1, 2, 3, 4, 5}
    assert of_bounded_bytes(rows.limit(0), 5).count() == 0
