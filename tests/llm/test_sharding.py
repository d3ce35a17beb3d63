import hashlib
from collections import Counter

import edge
import pytest

from footfall.llm import sharding as s


def number(text):
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def brute(names, size):
    owners, turn = [None] * size, 0
    orders = [[(number(x + "#start") + j * (number(x + "#step") % (size - 1) + 1)) % size for j in range(size)] for x in names]
    while None in owners:
        shard = turn % len(names)
        slot = next(c for c in orders[shard] if owners[c] is None)
        owners[slot] = shard
        turn += 1
    return owners


def owners(spark, names, size):
    return [r.shard for r in s.lookup_table(spark, names, size).orderBy("slot").collect()]


def test_table_equals_brute_force(spark):
    for n, size in [(1, 2), (3, 3), (7, 101), (16, 1021)]:
        names = s.shard_names(n)
        got = owners(spark, names, size)
        assert got == brute(names, size)
        assert max(Counter(got).values()) - min(Counter(got).values()) <= 1


def test_few_slots_change_hands(spark):
    names = s.shard_names(16)
    before, after = (owners(spark, x, 1021) for x in (names, names[:-1]))
    moved = sum(a != b for a, b in zip(before, after) if a != 15)
    assert moved < 0.12 * len(before)


def test_bad_parameters(spark):
    for names, size in [([], 7), (s.shard_names(8), 7), (s.shard_names(2), 9)]:
        with pytest.raises(ValueError):
            s.lookup_table(spark, names, size)


def test_edges_and_files(spark):
    from footfall.session import scratch_path

    docs = edge.documents(spark)
    names = s.shard_names(5)
    table = owners(spark, names, 101)
    rows = s.place(docs, names, size=101)
    assert len(rows.collect()) == len(edge.ROWS)
    for r in rows.collect():
        slot = number("" if r.doc_id is None else str(r.doc_id)) % 101
        assert (r.slot, r.shard) == (slot, table[slot])
    assert s.place(edge.empty(spark), names, size=101).collect() == []
    path = scratch_path(spark, "test-shards")
    s.write_shards(rows, path)
    assert spark.read.parquet(path).count() == len(edge.ROWS)
