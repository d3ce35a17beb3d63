"""Spelling variants: words one edit apart, found by k-d trees over letter counts.

Words are maximal runs of the letters a-z, A-Z and U+00C0 to U+00FF, with A-Z in lower case. Two words are
*near* if one inserted, deleted or replaced letter turns one into the other. A word's *form* is its most
frequent near word, if that is at least ``RATIO`` times as frequent; its *root* is where forms lead.

Method
------
A replaced letter moves one unit of a word's letter counts from one letter to another, an inserted one adds
a unit: at most 2 in the L1 distance. So words are points, one k-d tree per length, and each word searches
the tree of its own length and that of the words one letter shorter for boxes that such an edit can reach.
Letter counts are kept as thermometer bits ("at least t times letter d"): L1 distances are counts of
differing bits, and a box is the AND and the OR of its members. Only pairs whose counts differ by exactly
one edit have their letters compared in order.

A tree has two storeys. The upper one is fitted on a bounded sample of the letter counts (``SAMPLE`` words
of all lengths that need one); it only decides where words go, never which pairs are found. Each word is
stored in one leaf and asked for in every leaf whose box it can reach; a leaf's rows meet in one task, which
builds the lower storey over them. A leaf that still has more rows than intended (words of equal letter
counts cannot be parted) is split into blocks of members and blocks of questions that all meet.
Tasks return one row per word that found something, never pairs.

A word's occurrences are counted in the tasks that read the texts before anything is shuffled, so a word
that fills a third of the corpus is one row per task. A form is ten times as frequent as its word, so the
chains to the root have at most some twenty links; they are followed by doubling.

Edges
-----
* A null or empty text has no words; a row without an id counts as one with an empty id.
* Repeated rows are counted as often as they occur. An empty table gives no rows.
* Equal frequencies: the form is the smallest word in code-point order.
* A text or a word of any length is taken whole.
* Other columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.llm.shared import written
from footfall.llm.text import LOWER, chunks, spans

LEAST_LENGTH = 7
LEAST_COUNT = 2
RATIO = 10
#: A run whose hash this divides loses a letter: the contract's own misspellings. None leaves all runs as they are.
MISSPELL = 31
#: Words, and letters of words, in a leaf of the upper storey.
LEAF_WORDS = 16384
LEAF_LETTERS = 1 << 20
#: Words the upper storeys are fitted on, all lengths together, and the fewest of them in a leaf.
SAMPLE = 50_000
LEAST_SAMPLE = 16
#: Questions of a leaf in one task, as a multiple of the members intended for it.
ASKED = 16
#: Words in a leaf of the lower storey.
LAST = 32
#: Bytes of text counted together.
COUNTED = 1 << 22
#: Pairs compared letter by letter together.
PAIRS = 1 << 16

#: Letters as numbers: a-z, then U+00C0 to U+00FF.
LETTERS = 90
_LETTER = np.zeros(256, dtype=np.int64)
_LETTER[97:123] = np.arange(26)
_LETTER[192:] = np.arange(26, LETTERS)
_LEAD = 0xC3  # the first byte of U+00C0 to U+00FF in UTF-8

_ASCII = np.zeros(256, dtype=bool)
_ASCII[65:91] = _ASCII[97:123] = True


def _crc_table() -> np.ndarray:
    """What eight steps of the reversed CRC-32 polynomial make of each byte."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = (table >> np.uint32(1)) ^ np.where(table & np.uint32(1), np.uint32(0xEDB88320), np.uint32(0))
    return table


_CRC = _crc_table()
#: Runs longer than this have their CRC computed one by one.
_LONG = 64


def _crcs(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, before: np.ndarray) -> np.ndarray:
    """CRC-32 of each span, going on from the CRC ``before`` it."""
    sizes = ends - starts
    order = np.argsort(-np.minimum(sizes, _LONG + 1), kind="stable")
    n_long = int((sizes > _LONG).sum())
    found = np.empty(len(starts), dtype=np.uint32)
    for i in order[:n_long]:
        found[i] = zlib.crc32(data[starts[i] : ends[i]].tobytes(), int(before[i]))
    order = order[n_long:]
    state = before[order].astype(np.uint32) ^ np.uint32(0xFFFFFFFF)
    at, left = starts[order], sizes[order]
    for step in range(int(left[0]) if len(left) else 0):
        active = int(np.searchsorted(-left, -step, side="left"))
        low = (state[:active] ^ data[at[:active] + step]) & np.uint32(255)
        state[:active] = _CRC[low] ^ (state[:active] >> np.uint32(8))
    found[order] = state ^ np.uint32(0xFFFFFFFF)
    return found


def _words(data: np.ndarray, offsets: np.ndarray, ids: list, least: int, misspell: int | None) -> pa.StructArray:
    """The words of a chunk of texts and how often each occurs."""
    data = LOWER[data]
    lead = data == _LEAD
    follows = np.zeros(len(data), dtype=bool)
    follows[1:] = lead[:-1]
    inside = (_ASCII[data] | lead | follows).astype(np.uint8)
    starts, ends, texts = spans(inside, offsets, np.array([False, True]))
    second = np.zeros(len(data) + 1, dtype=np.int64)
    np.cumsum(follows, out=second[1:])
    lengths = ends - starts - (second[ends] - second[starts])
    fits = lengths >= least
    starts, ends, texts, lengths = starts[fits], ends[fits], texts[fits], lengths[fits]
    changed = Counter()
    if misspell:
        before = np.array([zlib.crc32(f"{'' if i is None else i}:".encode()) for i in ids], dtype=np.uint32)
        crc = _crcs(data, starts, ends, before[texts])
        hit = crc % np.uint32(misspell) == 0
        for i in np.flatnonzero(hit & (lengths > least)):
            word = data[starts[i] : ends[i]].tobytes().decode()
            place = int(crc[i]) % len(word)
            changed[word[:place] + word[place + 1 :]] += 1
        starts, ends = starts[~hit], ends[~hit]
    # Words and the gaps between them as one Arrow array over the text's own bytes; every second is a word.
    edges = np.empty(2 * len(starts), dtype=np.int64)
    edges[0::2], edges[1::2] = starts, ends
    both = pa.LargeStringArray.from_buffers(max(len(edges) - 1, 0), pa.py_buffer(edges), pa.py_buffer(data))
    counted = pc.value_counts(both.take(pa.array(np.arange(0, len(both), 2))).cast(pa.string()))
    if not changed:
        return counted
    more = pa.StructArray.from_arrays([pa.array(list(changed), pa.string()), pa.array(list(changed.values()), pa.int64())], ["values", "counts"])
    return pa.concat_arrays([counted, more])


def word_counts(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, misspell: int | None = MISSPELL) -> DataFrame:
    """word, n and length (in letters) of every word of all texts that is long and frequent enough."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            for first, data, offsets in chunks(batch.column("text"), COUNTED):
                found = _words(data, offsets, ids[first : first + len(offsets) - 1], least_length, misspell)
                yield pa.RecordBatch.from_arrays([found.field("values"), found.field("counts")], ["word", "n"])

    counted = docs.select("doc_id", "text").mapInArrow(count, "word string, n long")
    words = counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)
    return words.withColumn("length", F.char_length("word"))


def letters_of(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The words as one array of Latin-1 codes, and where each word begins (and the end)."""
    words = words.cast(pa.large_string())
    if not len(words):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    _, ends, data = words.buffers()
    offsets = np.frombuffer(ends, dtype=np.int64)[words.offset : words.offset + len(words) + 1]
    data = np.frombuffer(data, dtype=np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.empty(0, np.uint8)
    lead = data == _LEAD
    leads = np.zeros(len(data) + 1, dtype=np.int64)
    np.cumsum(lead, out=leads[1:])
    codes = np.where(data >= 128, data + np.uint8(64), data)[~lead]
    offsets = offsets - offsets[0]
    return codes, offsets - leads[offsets]


def letter_counts(codes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How often each word has each letter."""
    n = len(offsets) - 1
    row = np.repeat(np.arange(n), np.diff(offsets))
    return np.bincount(row * LETTERS + _LETTER[codes], minlength=n * LETTERS).reshape(n, LETTERS)


# The upper storey. A node is (letter, t, below, above): words with fewer than t of the letter, and the others.
# A leaf is its number.


def _fitted(counts: np.ndarray, leaf: int):
    numbers = iter(range(len(counts) + 1))

    def split(rows: np.ndarray):
        best = None
        if len(rows) >= 2 * leaf:
            held = counts[rows]
            for letter in np.flatnonzero(held.min(axis=0) < held.max(axis=0)):
                t = int(np.sort(held[:, letter])[len(rows) // 2])
                for bound in (t, t + 1):
                    below = int((held[:, letter] < bound).sum())
                    if min(below, len(rows) - below) >= leaf and (best is None or abs(2 * below - len(rows)) < best[0]):
                        best = (abs(2 * below - len(rows)), int(letter), bound)
        if best is None:
            return next(numbers)
        _, letter, bound = best
        below = counts[rows, letter] < bound
        return (letter, bound, split(rows[below]), split(rows[~below]))

    return split(np.arange(len(counts)))


def _reached(tree, counts: np.ndarray, adds: int, takes: int) -> Iterator[tuple[int, np.ndarray]]:
    """(leaf, rows) for the leaves in which a word may stand that has at most ``adds`` letters which the
    row lacks and lacks at most ``takes`` letters which the row has. 0 and 0 is the row's own leaf."""
    n = len(counts)
    none = np.zeros(n, dtype=np.int64)
    # Per row, units that the box demands beyond the row's counts, or forbids of them, in all and per letter.
    stack = [(tree, np.arange(n), none, none, {})]
    while stack:
        node, rows, plus, minus, used = stack.pop()
        if not len(rows):
            continue
        if not isinstance(node, tuple):
            yield node, rows
            continue
        letter, bound, below, above = node
        have = counts[rows, letter]
        old_plus, old_minus = used.get(letter, (np.zeros(len(rows), np.int64),) * 2)
        for child, more, less in (
            (above, np.maximum(bound - have, old_plus), old_minus),
            (below, old_plus, np.maximum(have - bound + 1, old_minus)),
        ):
            new_plus, new_minus = plus - old_plus + more, minus - old_minus + less
            ok = (new_plus <= adds) & (new_minus <= takes)
            kept = {k: (a[ok], b[ok]) for k, (a, b) in (used | {letter: (more, less)}).items()}
            stack.append((child, rows[ok], new_plus[ok], new_minus[ok], kept))


def _capacity() -> F.Column:
    """Words of a length that a leaf is meant to hold."""
    return F.greatest(F.lit(LAST), F.least(F.lit(LEAF_WORDS), F.floor(F.lit(LEAF_LETTERS) / F.col("length"))))


def upper_storeys(words: DataFrame) -> dict[int, object]:
    """A tree for every length with more words than a leaf should hold."""
    sizes = words.groupBy("length").count().withColumn("leaves", F.col("count") / _capacity()).where("leaves > 1").collect()
    if not sizes:
        return {}
    total = sum(r["count"] for r in sizes)
    per_leaf = 64
    drawn = min(1.0, SAMPLE / total, per_leaf * sum(r["leaves"] for r in sizes) / total)
    lengths = [r["length"] for r in sizes]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = letter_counts(*letters_of(batch.column("word"))).astype(np.int32)
            packed = pa.array([row.tobytes() for row in counts], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("length"), packed], ["length", "counts"])

    chosen = F.pmod(F.xxhash64("word"), F.lit(1 << 30)) < int(drawn * (1 << 30))
    sample = words.where(F.col("length").isin(lengths) & chosen).select("word", "length").mapInArrow(count, "length int, counts binary")
    rows: dict[int, list] = {}
    for r in sample.orderBy("length", "counts").collect():
        rows.setdefault(r["length"], []).append(np.frombuffer(r["counts"], dtype=np.int32))
    trees = {}
    for r in sizes:
        held = rows.get(r["length"], [])
        if len(held) >= 2 * LEAST_SAMPLE:
            trees[r["length"]] = _fitted(np.array(held), max(LEAST_SAMPLE, int(len(held) / r["leaves"] / 2)))
    return trees


MEMBER, SAME, LONGER = 0, 1, 2


def routed(words: DataFrame, trees: dict[int, object]) -> DataFrame:
    """tree (a length), leaf, role, word, n: each word where it is stored and where it must ask."""

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = letter_counts(*letters_of(batch.column("word")))
            lengths = batch.column("length").to_numpy(zero_copy_only=False)
            for length in np.unique(lengths):
                rows = np.flatnonzero(lengths == length)
                own = counts[rows]
                for role, tree, adds, takes in ((MEMBER, length, 0, 0), (SAME, length, 1, 1), (LONGER, length - 1, 0, 1)):
                    for leaf, found in _reached(trees.get(int(tree), 0), own, adds, takes):
                        picked = batch.take(pa.array(rows[found]))
                        same = [pa.array(np.full(len(found), x, np.int32)) for x in (tree, leaf, role)]
                        yield pa.RecordBatch.from_arrays([*same, picked.column("word"), picked.column("n")], ["tree", "leaf", "role", "word", "n"])

    return words.mapInArrow(route, "tree int, leaf int, role int, word string, n long")


def in_blocks(rows: DataFrame) -> DataFrame:
    """The routed rows with the numbers of their member and question blocks, 0 and 0 for nearly all leaves."""
    sizes = rows.groupBy("tree", "leaf").agg(
        F.count_if(F.col("role") == MEMBER).alias("members"), F.count_if(F.col("role") != MEMBER).alias("asked")
    )
    room = _capacity()
    sizes = sizes.withColumn("length", F.col("tree")).select(
        "tree", "leaf", F.ceil(F.col("members") / (4 * room)).alias("m"), F.ceil(F.col("asked") / (ASKED * room)).alias("a"), "members"
    )
    # A tree without members has no word that could be found in it.
    needed = written(sizes.where("members > 0").drop("members"), "spelling-leaves")
    key = F.xxhash64("word")
    own = F.when(F.col("role") == MEMBER, F.pmod(key, "m")).otherwise(F.pmod(key, "a"))
    across = F.when(F.col("role") == MEMBER, F.col("a")).otherwise(F.col("m"))
    met = rows.join(needed, ["tree", "leaf"]).withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), across - 1)))
    member = F.col("role") == MEMBER
    return met.select(
        "tree", "leaf", F.when(member, F.col("own")).otherwise(F.col("other")).alias("block"),
        F.when(member, F.col("other")).otherwise(F.col("own")).alias("asking"), "role", "word", "n",
    )


def _bits(counts: np.ndarray) -> np.ndarray:
    """Thermometer bits of letter counts, 64 to a number."""
    most = counts.max(axis=0) if len(counts) else np.zeros(LETTERS, np.int64)
    letter = np.repeat(np.arange(LETTERS), most)
    level = np.arange(len(letter)) - np.repeat(np.cumsum(most) - most, most) + 1
    width = max(1, -(-len(letter) // 64))
    out = np.zeros((len(counts), width * 8), dtype=np.uint8)
    for at in range(0, len(counts), 4096):
        packed = np.packbits(counts[at : at + 4096, letter] >= level, axis=1)
        out[at : at + 4096, : packed.shape[1]] = packed
    return out.view(np.uint64)


def _ones(bits: np.ndarray) -> np.ndarray:
    return np.bitwise_count(bits).sum(axis=-1, dtype=np.int64)


def _candidates(members: np.ndarray, asked: np.ndarray, adds: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(questions, members) whose bits differ by one taken and ``adds`` added, found by the lower storey."""
    stack = [(np.arange(len(members)), np.arange(len(asked)))]
    while stack:
        held, rows = stack.pop()
        if not len(held) or not len(rows):
            continue
        low, high = np.bitwise_and.reduce(members[held], axis=0), np.bitwise_or.reduce(members[held], axis=0)
        own = asked[rows]
        rows = rows[(_ones(low & ~own) <= adds) & (_ones(own & ~high) <= 1)]
        if not len(rows):
            continue
        if len(held) > LAST and (low != high).any():
            ones = np.unpackbits(members[held].view(np.uint8), axis=1)
            dimension = int(np.abs(2 * ones.sum(axis=0, dtype=np.int64) - len(held)).argmin())
            above = ones[:, dimension].astype(bool)
            stack += [(held[above], rows), (held[~above], rows)]
            continue
        # Members of equal counts are one point: whether it is met is found once, whoever shares it.
        points = held[:1] if (low == high).all() else held
        step = max(1, PAIRS * 4 // len(points) // members.shape[1])
        for at in range(0, len(rows), step):
            part = rows[at : at + step]
            a, b = asked[part][:, None], members[points][None]
            one, other = np.nonzero((_ones(b & ~a) == adds) & (_ones(a & ~b) == 1))
            if len(points) == len(held):
                yield part[one], held[other]
            else:
                width = max(1, PAIRS // len(held))
                for i in range(0, len(one), width):
                    some = part[one[i : i + width]]
                    yield np.repeat(some, len(held)), np.tile(held, len(some))


def _one_replaced(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a != b).sum(axis=1) == 1


def _one_dropped(longer: np.ndarray, shorter: np.ndarray) -> np.ndarray:
    """Equal before the first difference, and from there on shifted by one letter."""
    n = shorter.shape[1]
    differs = longer[:, :-1] != shorter
    first = np.where(differs.any(axis=1), differs.argmax(axis=1), n)
    shifted = longer[:, 1:] != shorter
    last = np.where(shifted.any(axis=1), n - 1 - shifted[:, ::-1].argmax(axis=1), -1)
    return last < first


class _Best:
    """Per row: how many near words, and the most frequent of them (the smallest, if equal)."""

    def __init__(self, n: np.ndarray, rank: np.ndarray):
        self.n, self.rank = n, rank
        self.near = np.zeros(len(n), dtype=np.int64)
        self.form = np.full(len(n), -1)

    def add(self, owners: np.ndarray, others: np.ndarray) -> None:
        np.add.at(self.near, owners, 1)
        order = np.lexsort((self.rank[others], -self.n[others], owners))
        owners, first = np.unique(owners[order], return_index=True)
        others = others[order][first]
        old = self.form[owners]
        better = (old < 0) | (self.n[others] > self.n[old]) | ((self.n[others] == self.n[old]) & (self.rank[others] < self.rank[old]))
        self.form[owners[better]] = others[better]


def near_in_leaf(rows: pa.Table) -> pa.Table:
    """word, n_near, form_n, form of the words of one leaf that have near words in it."""
    rows = rows.combine_chunks()
    word = rows["word"].combine_chunks() if rows.num_rows else pa.array([], pa.string())
    role, n = rows["role"].to_numpy(), rows["n"].to_numpy()
    codes, offsets = letters_of(word)
    sizes = np.diff(offsets)
    length = int(sizes.min()) if len(sizes) else 0
    bits = _bits(letter_counts(codes, offsets))
    rank = np.unique(np.array([codes[a:b].tobytes() for a, b in zip(offsets[:-1], offsets[1:])], dtype=bytes), return_inverse=True)[1]
    best = _Best(n, rank)
    members = np.flatnonzero(role == MEMBER)
    if len(members):
        length = int(sizes[members[0]])

    def letters(which: np.ndarray, size: int) -> np.ndarray:
        return codes[offsets[which][:, None] + np.arange(size)]

    for kind, adds in ((SAME, 1), (LONGER, 0)):
        asked = np.flatnonzero(role == kind)
        for a, b in _candidates(bits[members], bits[asked], adds):
            a, b = asked[a], members[b]
            step = max(1, PAIRS * 16 // max(length, 16))
            for at in range(0, len(a), step):
                one, other = a[at : at + step], b[at : at + step]
                if kind == SAME:
                    ok = _one_replaced(letters(one, length), letters(other, length))
                else:
                    ok = _one_dropped(letters(one, length + 1), letters(other, length))
                one, other = one[ok], other[ok]
                best.add(one, other)
                if kind == LONGER:
                    best.add(other, one)
    found = np.flatnonzero(best.near)
    form = best.form[found]
    return pa.table(
        [word.take(pa.array(found)), pa.array(best.near[found]), pa.array(n[form]), word.take(pa.array(form))],
        names=["word", "n_near", "form_n", "form"],
    )


def near_words(words: DataFrame) -> DataFrame:
    """word, n, n_near, form_n, form: of every word its near words counted, and the first of them."""
    rows = in_blocks(written(routed(words, upper_storeys(words)), "spelling-routed"))
    found = rows.groupBy("tree", "leaf", "block", "asking").applyInArrow(
        near_in_leaf, "word string, n_near long, form_n long, form string"
    )
    first = F.struct((-F.col("form_n")).alias("order"), "form")
    parts = found.select("word", F.lit(None).cast("long").alias("n"), "n_near", first.alias("first"))
    none = F.lit(None).cast("struct<order:long,form:string>")
    alone = words.select("word", "n", F.lit(0).cast("long").alias("n_near"), none.alias("first"))
    both = alone.unionByName(parts).groupBy("word").agg(
        F.max("n").alias("n"), F.sum("n_near").alias("n_near"), F.min("first").alias("first")
    )
    return both.select("word", "n", "n_near", (-F.col("first.order")).alias("form_n"), F.col("first.form").alias("form"))


def roots(links: DataFrame) -> DataFrame:
    """word, root: the end of the chain that begins with each (word, form)."""
    hops = written(links.select("word", F.col("form").alias("root")), "spelling-hops")
    while True:
        further = hops.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        moved = hops.join(further, "root", "left")
        hops = written(moved.select("word", F.coalesce("beyond", "root").alias("root"), F.col("beyond").isNotNull().alias("moved")), "spelling-hops")
        if hops.where("moved").isEmpty():
            return hops.select("word", "root")
        hops = hops.select("word", "root")


def variants(
    docs: DataFrame,
    least_length: int = LEAST_LENGTH,
    least_count: int = LEAST_COUNT,
    ratio: int = RATIO,
    misspell: int | None = MISSPELL,
) -> DataFrame:
    """word, form, root, n, n_near, form_n for every word of ``docs`` (doc_id, text)."""
    words = written(word_counts(docs, least_length, least_count, misspell), "spelling-words")
    found = near_words(words)
    common = F.col("form_n") >= ratio * F.col("n")
    forms = written(
        found.select("word", "n", "n_near", F.when(common, F.col("form")).alias("form"), F.when(common, F.col("form_n")).alias("form_n")),
        "spelling-forms",
    )
    ends = roots(forms.where("form IS NOT NULL"))
    return forms.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
