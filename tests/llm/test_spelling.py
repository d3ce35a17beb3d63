import random
import re
import zlib
from collections import Counter

import edge
import numpy as np
import pyarrow as pa
import pytest

from footfall.llm import spelling as s

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_words(rows, misspell=31):
    n = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if misspell and h % misspell == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    return {w: k for w, k in n.items() if len(w) >= 7 and k >= 2}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(words, ratio=10):
    near = {w: [o for o in words if abs(len(o) - len(w)) <= 1 and one_edit(w, o)] for w in words}
    form = {}
    for w, others in near.items():
        best = min(((-words[o], o) for o in others), default=None)
        form[w] = best[1] if best and -best[0] >= ratio * words[w] else None
    rows = set()
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        rows.add((w, form[w], root, words[w], len(near[w]), words[form[w]] if form[w] else None))
    return rows


def check(spark, texts):
    docs = edge.texts(spark, *texts)
    got = {tuple(r) for r in s.variants(docs).select("word", "form", "root", "n", "n_near", "form_n").collect()}
    assert got == brute(brute_words(list(enumerate(texts))))
    return got


def made_up(seed, n, letters="abcdeé"):
    rng = random.Random(seed)
    words = ["".join(rng.choice(letters) for _ in range(rng.choice([7, 8, 8, 8, 9, 10]))) for _ in range(n)]
    for word in list(words):
        for _ in range(2):
            i, kind = rng.randrange(len(word)), rng.random()
            words.append(word[:i] + (rng.choice(letters) if kind < 0.7 else "") + word[i + (kind > 0.3) :])
    return words


def spread(words, seed):
    rng = random.Random(seed)
    tokens = [w if rng.random() < 0.8 else w.upper() for w in words for _ in range(rng.choice([1, 2, 2, 3, 30, 400]))]
    rng.shuffle(tokens)
    return [" ".join(tokens[i : i + 500]) for i in range(0, len(tokens), 500)]


def test_equals_brute_force(spark):
    rows = check(spark, spread(made_up(1, 150), 2))
    assert sum(r[1] is not None for r in rows) > 20 and any(r[2] != r[1] for r in rows if r[1])


def test_two_storeys_and_blocks_equal_brute_force(spark, monkeypatch):
    texts = spread(made_up(3, 250, "abcd"), 4)
    monkeypatch.setattr(s, "LEAF_WORDS", 40)
    monkeypatch.setattr(s, "LAST", 4)
    monkeypatch.setattr(s, "ASKED", 1)
    trees = s.upper_storeys(s.word_counts(edge.texts(spark, *texts)))
    assert any(isinstance(tree, tuple) for tree in trees.values())
    check(spark, texts)


def test_words_of_equal_counts_are_split_into_blocks(spark, monkeypatch):
    monkeypatch.setattr(s, "LEAF_WORDS", 8)
    monkeypatch.setattr(s, "LAST", 8)
    monkeypatch.setattr(s, "ASKED", 1)
    rng = random.Random(5)
    words = sorted({"".join(rng.sample("abcdefg", 7)) for _ in range(300)})
    words += [w[:3] + "x" + w[4:] for w in words[::3]]
    check(spark, [" ".join(words), " ".join(words)])


@pytest.mark.parametrize("size", [7, 8, 63, 64, 65, 300])
def test_hashes_equal_zlib(size):
    rng = np.random.RandomState(size)
    data = rng.randint(97, 123, 4000).astype(np.uint8)
    starts = np.sort(rng.choice(3000, 50, replace=False))
    ends = starts + rng.randint(1, size + 1, 50)
    before = np.array([zlib.crc32(f"{i}:".encode()) for i in range(50)], dtype=np.uint32)
    want = [zlib.crc32(f"{i}:".encode() + data[a:b].tobytes()) for i, (a, b) in enumerate(zip(starts, ends))]
    assert s._crcs(data, starts, ends, before).tolist() == want


def test_letters_of_words_beyond_ascii():
    words = pa.array(["skip", "àÿ×÷zaé", "x", ""]).slice(1)
    codes, offsets = s.letters_of(words)
    assert [codes[a:b].tobytes().decode("latin-1") for a, b in zip(offsets, offsets[1:])] == words.to_pylist()
    assert s.letter_counts(codes, offsets).sum(axis=1).tolist() == [7, 1, 0]


def test_edges(spark):
    rows = [(r.doc_id, r.text) for r in edge.documents(spark).collect()]
    got = {tuple(r) for r in s.variants(edge.documents(spark)).select("word", "form", "root", "n", "n_near", "form_n").collect()}
    assert got == brute(brute_words(rows))
    assert s.variants(edge.empty(spark)).collect() == []


def test_very_long_words_chains_and_ties(spark):
    long, other = "q" * 30_000, "q" * 30_000 + "z"
    chain = ["vocable"] * 1000 + ["vocables"] * 100 + ["vocabless"] * 10 + ["tiebacka"] * 20 + ["tiebackb"] * 20 + ["tieback"] * 2
    rows = check(spark, [" ".join(chain), f"{long} {other} {long}", f"{other} {other} vocablesss ÀÉÎÕÜÝÞ"] * 2)
    roots = {r[0]: r[2] for r in rows}
    assert roots["vocabless"] == "vocable" and {r[0]: r[1] for r in rows}["tieback"] == "tiebacka"


def test_without_made_up_misspellings(spark):
    texts = spread(made_up(7, 60), 8)
    docs = edge.texts(spark, *texts)
    got = {r.word: r.n for r in s.variants(docs, misspell=None).collect()}
    assert got == brute_words(list(enumerate(texts)), None)
