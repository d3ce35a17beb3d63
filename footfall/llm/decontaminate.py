"""Benchmark decontamination by winnowing.

Of every window of 13 words the least hash of its 8-word grams is kept, the last of equal ones; neighbouring
windows mostly keep the same gram, which is posted once, with its place. Equal windows keep equal grams at
equal places, so two texts that share a window have posted the same gram within it: texts and benchmark
items meet on the posted hashes alone, and a Bloom filter of fixed size over those of the benchmark keeps
all others out of the shuffle. A meeting is then extended: the words beside the gram, up to five on each
side, are compared one by one, and where the equal span has 13 words or more its words are hit. So every
shared span of 13 words is found and nothing else. An item of fewer words is one gram by itself.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from footfall.llm.shared import Bloom, bloom, without, written
from footfall.llm.text import WORD, chunks, grams, mix, words_of

#: Words of a window; an item with fewer is one window.
WINDOW = 13
#: Words of the grams whose least hash stands for a window.
GRAM = 8
#: A text is contaminated when SHARE * (words in windows) >= all its words.
SHARE = 20


#: Words beside a posted gram that the windows which keep it can have.
BESIDE = WINDOW - GRAM
#: The size of a post that stands for windows.
GRAM_POST = 0


def _posts(words: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the grams that the full windows of a chunk keep, each once."""
    n = len(words) - WINDOW + 1
    if n <= 0:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    parts = grams(words, GRAM)
    least, place = parts[:n].copy(), np.arange(n)
    for i in range(1, BESIDE + 1):
        later = parts[i : i + n] <= least
        least[later] = parts[i : i + n][later]
        place[later] = np.flatnonzero(later) + i
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    place = np.unique(place[text[:n] == text[WINDOW - 1 :]])
    return place, parts[place]


def _short_grams(words: np.ndarray, first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of all runs of n words."""
    whole = grams(words, n)
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    starts = np.flatnonzero(text[: len(whole)] == text[n - 1 :][: len(whole)]) if len(whole) else np.empty(0, np.int64)
    return starts, whole[starts]


#: A post: the hash and the words of a gram from ``start`` on, and the words beside it, those before it from
#: the last to the first. ``size`` is 0, or that of the short items for which the gram is posted whole.
POSTS = "array<struct<print:long,start:int,size:int,gram:array<long>,before:array<long>,after:array<long>>>"


def _slices(words: np.ndarray, begin: np.ndarray, end: np.ndarray, backwards: bool = False) -> pa.Array:
    """words[begin:end] of each row as a list."""
    sizes = end - begin
    ends = np.concatenate([[0], np.cumsum(sizes)])
    at = np.arange(ends[-1]) - np.repeat(ends[:-1], sizes)
    at = np.repeat(end, sizes) - 1 - at if backwards else np.repeat(begin, sizes) + at
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(words[at].view(np.int64)))


def _listed(words: np.ndarray, first: np.ndarray, place: np.ndarray, prints: np.ndarray, size: np.ndarray) -> pa.Array:
    """The posts of a chunk, one list per text; posts are sorted by place."""
    text = np.searchsorted(first, place, side="right") - 1
    beside = np.where(size == GRAM_POST, BESIDE, 0)
    length = np.where(size == GRAM_POST, GRAM, size)
    low, high = np.maximum(place - beside, first[text]), np.minimum(place + length + beside, first[text + 1])
    fields = {
        "print": pa.array(prints.view(np.int64)), "start": pa.array((place - first[text]).astype(np.int32)),
        "size": pa.array(size.astype(np.int32)), "gram": _slices(words, place, place + length),
        "before": _slices(words, low, place, True), "after": _slices(words, place + length, high),
    }
    ends = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=len(first) - 1))]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays(list(fields.values()), list(fields)))


def _posted(words: np.ndarray, first: np.ndarray, short: list[int], keep=None) -> pa.Array:
    """The posts of a chunk: its windows' grams, and its runs of the ``short`` sizes."""
    places, prints, sizes = [], [], []
    for size in [*short, GRAM_POST]:
        place, marks = _short_grams(words, first, size) if size else _posts(words, first)
        # A short item's run must not meet a window's gram of as many words.
        marks = mix(marks + np.uint64(size))
        if keep is not None:
            held = keep(marks)
            place, marks = place[held], marks[held]
        places.append(place)
        prints.append(marks)
        sizes.append(np.full(len(place), size))
    place, prints, size = (np.concatenate(x) for x in (places, prints, sizes))
    order = np.argsort(place, kind="stable")
    return _listed(words, first, place[order], prints[order], size[order])


def _item_posts(batches):
    for batch in batches:
        sizes, keys, lists = [], [], []
        for _, data, offsets in chunks(batch.column("text")):
            words, first = words_of(data, offsets, WORD)
            for start, end in zip(first[:-1], first[1:]):
                own, n = words[start:end], int(end - start)
                lists.append(_posted(own, np.array([0, n]), [n] if 0 < n < WINDOW else []))
                sizes.append(n)
                keys.append(mix((own + np.uint64(1)) * mix(np.arange(1, n + 1, dtype=np.uint64))).sum(dtype=np.uint64))
        if lists:
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("item_id").cast(pa.int64()), pa.array(np.array(sizes, dtype=np.int64)),
                    pa.array(np.array(keys, dtype=np.uint64).view(np.int64)), pa.concat_arrays(lists),
                ],
                ["item_id", "n_words", "item_key", "posts"],
            )


def item_posts(benchmark: DataFrame) -> DataFrame:
    """(item_id, n_words, item_key, posts) per item; items of equal words have equal keys."""
    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text")
    return rows.mapInArrow(_item_posts, f"item_id long, n_words long, item_key long, posts {POSTS}")


def candidates(docs: DataFrame, prints: Bloom, short: list[int]) -> DataFrame:
    """(doc_id, text_hash, n_words, posts) per document, with the posts whose hash may be an item's.

    ``short`` has the sizes of the items that are shorter than a window, at most WINDOW - 1 numbers.
    """
    shared = docs.sparkSession.sparkContext.broadcast(prints)

    def find(batches):
        for batch in batches:
            n_words, lists = [], []
            for _, data, offsets in chunks(batch.column("text")):
                words, first = words_of(data, offsets, WORD)
                lists.append(_posted(words, first, short, shared.value.holds))
                n_words.append(np.diff(first))
            if lists:
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").cast(pa.int64()), batch.column("text_hash"),
                        pa.array(np.concatenate(n_words).astype(np.int64)), pa.concat_arrays(lists),
                    ],
                    ["doc_id", "text_hash", "n_words", "posts"],
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")
    return rows.mapInArrow(find, f"doc_id long, text_hash long, n_words long, posts {POSTS}")


def _equal_words(one: str, other: str) -> Column:
    """How many words two lists have in common before they first differ or one ends."""
    same = F.zip_with(one, other, lambda a, b: F.coalesce(a == b, F.lit(False)))
    stop = F.array_position(same, False).cast("int")
    return F.when(stop > 0, stop - 1).otherwise(F.size(same))


def hits(posts: DataFrame, contexts: DataFrame) -> DataFrame:
    """(row, start, size, context): the equal spans, found by extending each meeting of posts."""
    theirs = contexts.select("print", *(F.col(c).alias(f"item_{c}") for c in ("size", "gram", "before", "after")), "context")
    met = posts.join(theirs, "print").where((F.col("size") == F.col("item_size")) & (F.col("gram") == F.col("item_gram")))
    met = met.withColumns({"left": _equal_words("before", "item_before"), "right": _equal_words("after", "item_after")})
    span = F.col("left") + F.size("gram") + F.col("right")
    met = met.where((F.col("size") != GRAM_POST) | (span >= WINDOW))
    return met.select("row", (F.col("start") - F.col("left")).alias("start"), span.alias("size"), "context")


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, text_hash.

    A word is hit when it lies in an occurrence of an item's window. Null, empty and wordless
    texts have no words and are never contaminated; items without words have no window. Repeated
    rows are judged alike, each by itself; items repeated under one item_id count once, and an
    item without an id hits words but is in no list. Empty tables are allowed on either side;
    other columns are ignored.
    """
    items = written(item_posts(benchmark), "items")
    parts = ["size", "gram", "before", "after"]
    name = F.concat_ws("|", F.col("size").cast("string"), *(F.concat_ws(",", F.col(c).cast("array<string>")) for c in parts[1:]))
    contexts = items.select("item_key", F.inline("posts")).withColumn("context", F.sha2(name, 256))
    contexts = written(contexts.select("item_key", "context", "print", *parts).distinct(), "contexts")
    short = [r[0] for r in items.where(f"n_words BETWEEN 1 AND {WINDOW - 1}").select("n_words").distinct().collect()]
    rows = candidates(docs, bloom(contexts.select("print").distinct()), sorted(short))
    rows = written(rows.withColumn("row", F.monotonically_increasing_id()), "candidates")
    # Items that share a passage meet the texts once.
    theirs = written(contexts.select("context", "print", *parts).distinct(), "contexts")
    met = written(hits(rows.select("row", F.inline("posts")), theirs), "hits")
    end = F.col("start") + F.col("size")
    before = Window.partitionBy("row").orderBy("start", "size").rowsBetween(Window.unboundedPreceding, -1)
    fresh = F.greatest(F.lit(0), end - F.greatest("start", F.coalesce(F.max(end).over(before), "start")))
    n_hit = met.select("row", "start", "size").distinct().select("row", fresh.alias("fresh"))
    n_hit = n_hit.groupBy("row").agg(F.sum("fresh").alias("n_hit"))
    holders = contexts.select("context", "item_key").distinct()
    found = met.select("row", "context").distinct().join(holders, "context").select("row", "item_key").distinct()
    ids = items.where("item_id IS NOT NULL AND n_words > 0").select("item_key", "item_id").distinct()
    found = found.join(ids, "item_key").select("row", F.col("item_id").cast("string").alias("item")).distinct()
    found = found.groupBy("row").agg(
        F.count("*").alias("n_items"), F.concat_ws(",", F.sort_array(F.collect_list("item"))).alias("items")
    )
    joined = rows.drop("posts").join(n_hit, "row", "left").join(found, "row", "left")
    n_hit, n_items = (F.coalesce(c, F.lit(0).cast("long")) for c in ("n_hit", "n_items"))
    return joined.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), n_items.alias("n_items"),
        F.sha2(F.coalesce("items", F.lit("")), 256).alias("items_sha256"),
        ((n_hit > 0) & (n_hit * SHARE >= F.col("n_words"))).alias("contaminated"), "text_hash",
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without its contaminated rows."""
    return without(docs, contamination(docs, benchmark).where("contaminated"))
