import hashlib
import random
import zlib

import edge
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from footfall.llm import simple8b
from footfall.llm.bpe import Bpe, encode_and_decode
from footfall.llm.tokenfile import read_documents, read_token_file, write_token_file
from footfall.session import scratch_path

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)
LETTERS = list("abcdeABCstTl'’ 0123ßΣσÉéiİǅ́̈각\n\t\x1c\x85\xa0 中文<|>endoftext!?.")


def test_random_texts_equal_library():
    rng = random.Random(2)
    own = Bpe(open(PATH, encoding="utf-8").read())
    for _ in range(3000):
        text = "".join(rng.choice(LETTERS) for _ in range(rng.randint(0, 40)))
        if rng.random() < 0.2:
            text += "<|endoftext|>" + text[:5] + "<|STARTOFTEXT|><|startoftext|>"
        ids = LIBRARY.encode(text, add_special_tokens=False).ids
        assert own.encode(text) == ids, text
        assert own.decode(ids) == LIBRARY.decode(ids, skip_special_tokens=False)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_edges(spark):
    docs = edge.documents(spark)
    want = []
    for i, text, _ in edge.ROWS:
        ids = LIBRARY.encode(text or "", add_special_tokens=False).ids
        want.append((i, len(ids), sha(" ".join(map(str, ids))), sha(LIBRARY.decode(ids, skip_special_tokens=False))))
    got = [tuple(r) for r in encode_and_decode(docs, PATH, ["doc_id"], digest=True).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert encode_and_decode(edge.empty(spark), PATH, ["doc_id"], digest=True).collect() == []
    real = encode_and_decode(docs, PATH, ["doc_id", "row"]).where("doc_id = 4").first()
    assert (real.row, real.decoded) == ("clash", LIBRARY.decode(real.token_ids, skip_special_tokens=False))


def test_token_file(spark):
    path = scratch_path(spark, "test-tokens")
    write_token_file(edge.documents(spark), PATH, path, end_id=1)
    rows = read_token_file(spark, path).orderBy("start").collect()
    assert len(rows) == len(edge.ROWS)
    assert [r.doc_id for r in rows] == sorted((i for i, *_ in edge.ROWS), key=lambda i: i or 0)
    start = 0
    texts = {i: t for i, t, _ in edge.ROWS if i}
    for r in rows:
        assert r.start == start
        start += r.n_tokens
        if r.doc_id:
            ids = [*LIBRARY.encode(texts[r.doc_id] or "", add_special_tokens=False).ids, 1]
            assert (r.n_tokens, r.ids_crc32) == (len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes()))
    path = scratch_path(spark, "test-tokens")
    write_token_file(edge.empty(spark), PATH, path, end_id=1)
    assert read_token_file(spark, path).collect() == []


def test_packing_round_trips():
    rng = np.random.RandomState(1)
    for n in (0, 1, 119, 120, 1023, 1024, 1025, 5000):
        for top in (1, 2, 300, 50_000, 2**31, 2**60, 2**61, 2**64 - 1):
            values = rng.randint(0, top, n, dtype=np.uint64)
            if n > 10:
                values[n // 3 : n // 2] = 0
            words, offsets = simple8b.pack(values)
            assert (simple8b.unpack(words, offsets, n) == values).all()
            for first in range(len(offsets) - 1):
                for last in (first + 1, len(offsets) - 1):
                    part = values[first * simple8b.BLOCK : last * simple8b.BLOCK]
                    assert (simple8b.unpack(words, offsets, n, first, last) == part).all()


def test_escaped_numbers_side_by_side():
    values = np.array([2**64 - 1, 2**60, 5, 2**60, 2**63, 0] * 700, dtype=np.uint64)
    words, offsets = simple8b.pack(values)
    assert (simple8b.unpack(words, offsets, len(values)) == values).all()


def test_words_that_do_not_fill_their_block_are_refused():
    words, offsets = simple8b.pack(np.arange(3000, dtype=np.uint64))
    with pytest.raises(ValueError):
        simple8b.unpack(words, offsets + np.array([0, 1, 0, 0]), 3000)


def test_single_documents_are_read_by_their_blocks(spark):
    """Documents of many blocks, two of one id, one without text, one that is not there."""
    texts = [(n, f"alpha {n} " * (n * 40)) for n in range(1, 60)] + [(7, "again"), (60, None), (None, "nobody's")]
    path = scratch_path(spark, "test-tokens")
    write_token_file(spark.createDataFrame(texts, "doc_id long, text string").coalesce(1), PATH, path, end_id=1)
    got = sorted((r.doc_id, r.ids) for r in read_documents(spark, path, [7, 59, 60, 1000, 7]).collect())
    want = [(n, [*LIBRARY.encode(t or "", add_special_tokens=False).ids, 1]) for n, t in texts if n in (7, 59, 60)]
    assert got == sorted(want)
    assert read_documents(spark, path, []).collect() == []
