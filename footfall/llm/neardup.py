"""Near-duplicate documents: MinHash with banding, confirmed on the full shingle sets.

Texts with equal sets form a class at once; only one document of a class is compared. A class's
signature is cut into bands, and classes that share a band meet in its bucket. A bucket is never
expanded into pairs: first its members are compared with one centre, links are confirmed, and
members that are already connected need no comparison any more. Buckets that still hold several
components are then looked at in blocks of bounded size, first block by block, then, where that
left several components, pair of blocks by pair of blocks. Tasks see sizes and signatures and name
the members that have a likely partner in another component; only these members' full sets are
sent, and only links that join two components are returned. Of large buckets, a pair is confirmed
in the first that it shares. Frequent buckets and centres are split in every join.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.llm.components import connected_components
from footfall.llm.shared import bloom, bloom_bits, join_split, written
from footfall.llm.text import NOT_SPACE, chunks, grams, mix, words_of

SHINGLE = 5
#: Links need 100 * intersection >= PERCENT * union.
PERCENT = 75
#: A pair of similarity 0.75 shares no band with probability (1 - 0.75 ** 4) ** 32 = 5e-6.
BANDS, BAND_ROWS = 32, 4
MINIMA = BANDS * BAND_ROWS
#: Pairs with fewer equal minima are not confirmed; a pair of similarity 0.75 has fewer with
#: probability 4e-6 (4.5 standard deviations).
LEAST_EQUAL = 74
#: Members and shingles of a block, about.
BLOCK_MEMBERS, BLOCK_SHINGLES = 2048, 1 << 21
#: Groups of more members leave a pair to the earliest bucket that it shares.
FEW_MEMBERS = 64

_rng = np.random.RandomState(MINIMA)
_FACTORS = (_rng.randint(0, 1 << 31, MINIMA).astype(np.uint32) * np.uint32(2) + np.uint32(1))[:, None]
_SHIFTS = _rng.randint(0, 1 << 32, MINIMA, dtype=np.uint64).astype(np.uint32)[:, None]
_BAND_SEEDS = _rng.randint(0, 1 << 62, BANDS).astype(np.uint64)
_ROW_FACTORS = _rng.randint(0, 1 << 62, BAND_ROWS).astype(np.uint64) * np.uint64(2) + np.uint64(1)

SKETCH = "doc_id long, n_shingles long, lo long, hi long, signature binary, bands array<long>"


def _shingle_sets(column: pa.Array):
    """The sorted distinct shingle hashes of each text."""
    for _, data, offsets in chunks(column):
        words, first = words_of(data, offsets, NOT_SPACE)
        shingles = grams(words, SHINGLE)
        for start, end in zip(first[:-1], first[1:]):
            n = end - start
            own = shingles[start : end - SHINGLE + 1] if n >= SHINGLE else grams(words[start:end], n) if n else shingles[:0]
            yield np.unique(own)


def _band_keys(minima: np.ndarray) -> np.ndarray:
    keys = np.zeros((len(minima), BANDS), dtype=np.uint64) + _BAND_SEEDS
    for row in range(BAND_ROWS):
        keys += minima[:, row::BAND_ROWS].astype(np.uint64) * _ROW_FACTORS[row]
    return mix(keys)


def _minima(shingles: np.ndarray) -> np.ndarray:
    values = (shingles >> np.uint64(32)).astype(np.uint32)
    out = np.full(MINIMA, 0xFFFFFFFF, dtype=np.uint32)
    for at in range(0, len(values), 1024):
        np.minimum(out, (values[at : at + 1024] * _FACTORS + _SHIFTS).min(axis=1), out=out)
    return out


def _sketches(batches):
    for batch in batches:
        n, lo, hi, minima = [], [], [], []
        for shingles in _shingle_sets(batch.column("text")):
            n.append(len(shingles))
            lo.append(shingles.sum(dtype=np.uint64))
            hi.append(mix(shingles ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64))
            minima.append(_minima(shingles))
        n = np.array(n, dtype=np.int64)
        minima = np.array(minima, dtype=np.uint32).reshape(-1, MINIMA)
        bands = pa.ListArray.from_arrays(
            np.arange(len(n) + 1, dtype=np.int32) * BANDS, _band_keys(minima).view(np.int64).ravel()
        )
        short = (minima & np.uint32(0xFFFF)).astype(np.uint16)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id").cast(pa.int64()),
                pa.array(n),
                pa.array(np.array(lo, dtype=np.uint64).view(np.int64)),
                pa.array(np.array(hi, dtype=np.uint64).view(np.int64)),
                pa.array([row.tobytes() for row in short], pa.binary()),
                bands,
            ],
            ["doc_id", "n_shingles", "lo", "hi", "signature", "bands"],
        )


def sketches(docs: DataFrame) -> DataFrame:
    """One row per document: size and two 64-bit sums of its shingle set, minima, and band keys."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_sketches, SKETCH)


def _sets_of(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """(doc_id, shingles) of at least the documents in ``ids``; the texts themselves are not shuffled."""
    known = ids.agg(F.approx_count_distinct(ids.columns[0])).first()[0]
    wanted = docs.sparkSession.sparkContext.broadcast(bloom(ids, bloom_bits(known)))

    def sets(batches):
        for batch in batches:
            ids = batch.column("doc_id")
            known = ids.is_valid().to_numpy(zero_copy_only=False)
            keys = ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            keep = np.flatnonzero(known & wanted.value.holds(keys))
            kept = batch.take(pa.array(keep))
            found = list(_shingle_sets(kept.column("text")))
            ends = np.cumsum([0] + [len(x) for x in found], dtype=np.int64)
            values = np.concatenate([*found, np.empty(0, np.uint64)]).view(np.int64)
            lists = pa.LargeListArray.from_arrays(ends, values).cast(pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([kept.column("doc_id"), lists], ["doc_id", "shingles"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(sets, "doc_id long, shingles array<long>")


def _similar(batches):
    for batch in batches:
        if not batch.num_rows:
            continue
        one, two = (
            np.frombuffer(b"".join(batch.column(c).to_pylist()), dtype=np.uint16).reshape(-1, MINIMA)
            for c in ("a_signature", "b_signature")
        )
        keep = pa.array((one == two).sum(axis=1) >= LEAST_EQUAL)
        yield batch.select(["a", "b"]).filter(keep)


def _alike_in_size() -> F.Column:
    small, large = F.least("a_n_shingles", "b_n_shingles"), F.greatest("a_n_shingles", "b_n_shingles")
    return small * 100 >= large * PERCENT


def _with_sides(pairs: DataFrame, compared: DataFrame, *columns: str) -> DataFrame:
    """The pairs (a, b) with ``columns`` of both as a_..., b_...; b may be the centre of many pairs."""
    sides = {
        side: compared.select(F.col("rep").alias(side), *(F.col(c).alias(f"{side}_{c}") for c in columns)) for side in "ab"
    }
    return join_split(pairs, sides["b"], ["b"], "a").join(sides["a"], "a")


def _likely(pairs: DataFrame, compared: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sizes and signatures allow a link."""
    pairs = _with_sides(pairs, compared, "n_shingles", "signature").where(_alike_in_size())
    return pairs.select("a", "b", "a_signature", "b_signature").mapInArrow(_similar, "a long, b long")


def _confirmed(pairs: DataFrame, compared: DataFrame) -> DataFrame:
    """The pairs whose full shingle sets are similar enough."""
    pairs = _with_sides(pairs, compared, "shingles")
    shared = F.size(F.array_intersect("a_shingles", "b_shingles"))
    union = F.size("a_shingles") + F.size("b_shingles") - shared
    return pairs.where(shared * 100 >= union * PERCENT).select("a", "b")


def _with_component(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """``rows`` with the component of ``rep``: itself, where it has no link."""
    labelled = rows.join(labels.withColumnRenamed("node", "rep"), "rep", "left")
    return labelled.withColumn("component", F.coalesce("component", "rep"))


def _bucket_members(classes: DataFrame) -> DataFrame:
    """(key, rep, centre) of the buckets with two classes or more; the centre is the least."""
    members = classes.select("rep", F.explode("bands").alias("key"))
    centres = members.groupBy("key").agg(F.min("rep").alias("centre"), F.max("rep").alias("high"), F.count("*").alias("rows"))
    centres = written(centres.where("centre < high").drop("high"), "centres")
    return join_split(members, centres.drop("rows"), ["key"], "rep", counts=centres.select("key", "rows"))


def _unresolved(members: DataFrame) -> DataFrame:
    """Members (key, rep, n_shingles, component) of the buckets that still hold two components.

    Each with the number ``n`` of blocks of its bucket and its own ``block``.
    """
    blocks = F.ceil(F.greatest(F.count("*") / BLOCK_MEMBERS, F.sum("n_shingles") / BLOCK_SHINGLES))
    spread = members.groupBy("key").agg(
        F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("rows"), blocks.cast("int").alias("n")
    )
    spread = written(spread.where("low < high").select("key", "rows", "n"), "spread")
    found = join_split(members, spread.drop("rows"), ["key"], "rep", counts=spread.select("key", "rows"))
    return found.withColumn("block", F.pmod(F.xxhash64("rep"), F.col("n")).cast("int"))


class _Group:
    """The members of one pair of blocks, by ascending rep."""

    def __init__(self, key: tuple, group: pa.Table):
        low, high = key[1].as_py(), key[2].as_py()
        self.rows = group.take(pa.array(np.argsort(group["rep"].to_numpy(), kind="stable")))
        self.reps, self.sizes, self.block = (self.rows[c].to_numpy() for c in ("rep", "n_shingles", "block"))
        self.component = self.rows["component"].to_numpy().copy()
        self.minima = np.frombuffer(b"".join(self.rows["signature"].to_pylist()), dtype=np.uint16).reshape(-1, MINIMA)
        self.ones, self.others = np.flatnonzero(self.block == low), np.flatnonzero(self.block == high)
        self.alone = low == high

    def likely(self, i: int) -> np.ndarray:
        """Members of other components whose size and signature allow a link with member i, likeliest first.

        Pairs within a block are looked at once, from their lesser member.
        """
        others = self.others[self.others > i] if self.alone else self.others
        others = others[self.component[others] != self.component[i]]
        small, large = np.minimum(self.sizes[others], self.sizes[i]), np.maximum(self.sizes[others], self.sizes[i])
        others = others[small * 100 >= large * PERCENT]
        equal = (self.minima[others] == self.minima[i]).sum(axis=1)
        return others[np.argsort(-equal, kind="stable")][: int((equal >= LEAST_EQUAL).sum())]


MEMBER = "key long, low int, high int, block int, rep long, component long"


def _with_partners(key: tuple, group: pa.Table) -> pa.Table:
    """The members of one pair of blocks that have a likely partner there."""
    members = _Group(key, group)
    found = np.zeros(len(members.reps), dtype=bool)
    for i in members.ones:
        partners = members.likely(i)
        found[partners] = True
        found[i] |= len(partners) > 0
    return members.rows.filter(pa.array(found)).select(["key", "low", "high", "block", "rep", "component"])


def _earlier_bands(key: int, reps: np.ndarray, sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Each member's keys of the bands before the one of the bucket ``key``, and whether it has one text only.

    Two members of one text that share such a key meet in that bucket as well.
    """
    keys = _band_keys(np.array([_minima(shingles) for shingles in sets], dtype=np.uint32)).view(np.int64)
    _, index, rows = np.unique(reps, return_inverse=True, return_counts=True)
    return keys[:, : int((keys == key).sum(axis=0).argmax())], rows[index] == 1


def _joining_links(key: tuple, group: pa.Table) -> pa.Table:
    """Pairs (a, b) of components that a confirmed link of two members of one pair of blocks joins."""
    members = _Group(key, group)
    lists = members.rows["shingles"].combine_chunks()
    values, ends = lists.values.to_numpy().view(np.uint64), lists.offsets.to_numpy()  # sorted as unsigned
    sets = [values[i:j] for i, j in zip(ends[:-1], ends[1:])]
    component, links = members.component, []
    many = len(sets) > FEW_MEMBERS
    earlier, single = _earlier_bands(key[0].as_py(), members.reps, sets) if many else (None, None)
    for i in members.ones:
        partners = members.likely(i)
        if many and single[i]:
            partners = partners[~(single[partners] & (earlier[partners] == earlier[i]).any(axis=1))]
        for j in partners:
            if component[j] == component[i]:
                continue
            at = np.minimum(np.searchsorted(sets[i], sets[j]), len(sets[i]) - 1)
            shared = int((sets[i][at] == sets[j]).sum())
            if shared * 100 >= (len(sets[i]) + len(sets[j]) - shared) * PERCENT:
                links.append((component[i], component[j]))
                component[component == component[j]] = component[i]
    return pa.table({"a": pa.array([x[0] for x in links], pa.int64()), "b": pa.array([x[1] for x in links], pa.int64())})


def _links_of_blocks(members: DataFrame, compared: DataFrame, across: bool) -> DataFrame | None:
    """Links of components, within the blocks of a bucket or across them; None without any likely one."""
    if across:
        members = members.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n") - 1))).where("other <> block")
    else:
        members = members.withColumn("other", F.col("block"))
    pairs = members.select(
        "key", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "rep", "component"
    )
    groups = pairs.join(compared.select("rep", "n_shingles", "signature"), "rep").groupBy("key", "low", "high")
    likely = written(groups.applyInArrow(_with_partners, MEMBER), "likely")
    if likely.isEmpty():
        return None
    return likely.join(compared, "rep").groupBy("key", "low", "high").applyInArrow(_joining_links, "a long, b long")


def class_components(docs: DataFrame, classes: DataFrame) -> DataFrame | None:
    """(node, component) of the classes (rep, n_shingles, signature, bands) that have a link."""
    members = written(_bucket_members(classes), "members")
    if members.isEmpty():
        return None
    centres = F.collect_set(F.when(F.col("rep") != F.col("centre"), F.col("centre")))  # BANDS at most
    reps = members.groupBy("rep").agg(centres.alias("centres"))
    sets = _sets_of(docs, members.select("rep")).withColumnRenamed("doc_id", "rep")
    compared = written(classes.select("rep", "n_shingles", "signature").join(reps, "rep").join(sets, "rep"), "compared")
    pairs = compared.select(F.col("rep").alias("a"), F.explode("centres").alias("b"))
    labels = connected_components(_confirmed(written(_likely(pairs, compared), "likely"), compared))
    sizes = written(_with_component(compared.select("rep", "n_shingles"), labels), "sizes")
    members = written(members.where("rep <> centre").select("rep", "key").join(sizes, "rep"), "members")
    members = written(_unresolved(members), "members")
    if members.isEmpty():
        return labels
    for across in (False, True):
        found = _links_of_blocks(members, compared, across)
        if found is not None:
            labels = connected_components(labels.toDF("a", "b").union(found))
        if not across:
            members = members.where("n > 1")  # a bucket of one block has been looked at in full
            if members.isEmpty():
                break
            if found is not None:
                members = written(_with_component(members.select("key", "rep", "n_shingles"), labels), "members")
                members = written(_unresolved(members), "members")  # in the same blocks as before
    return labels


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs`` (doc_id, text, ...).

    A null or empty text has no shingles and is linked with nothing. Rows of one doc_id count as
    one document: they are in one component. A row without a doc_id is kept, has no component and
    links nothing. No rows give no rows; other columns are ignored.
    """
    rows = written(sketches(docs), "sketches")
    filled = rows.where("n_shingles > 0 AND doc_id IS NOT NULL")
    key = ["lo", "hi", "n_shingles"]
    classes = filled.groupBy(*key).agg(
        F.min("doc_id").alias("rep"), F.first("signature").alias("signature"), F.first("bands").alias("bands"),
        F.count("*").alias("rows"),
    )
    classes = written(classes, "classes")
    labels = class_components(docs, classes)
    named = classes.select(*key, "rep")
    named = _with_component(named, labels) if labels else named.withColumn("component", F.col("rep"))
    named = named.drop("rep")
    joined = join_split(rows.select("doc_id", *key), named, key, "doc_id", "left", classes.select(*key, "rows"))
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return joined.select(
        "doc_id", "n_shingles", component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each component: the one with the least doc_id.

    Of rows that repeat a kept doc_id, one stays. Rows without a doc_id all stay.
    """
    found = written(near_duplicates(docs), "components")
    drop = written(found.where("NOT kept").select("doc_id").distinct(), "copies")
    kept = docs.join(drop, "doc_id", "left_anti")
    repeated = found.where("kept AND doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1")
    repeated = written(repeated.select("doc_id"), "repeated")
    if repeated.isEmpty():
        return kept
    once = kept.join(repeated, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return kept.join(repeated, "doc_id", "left_anti").unionByName(once)
