"""Written intermediate tables, joins that split frequent keys, decisions joined back, bounded Bloom filters."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.llm.text import mix
from footfall.session import scratch_path

#: Bits of a Bloom filter: 2 MB, or with ``bloom_bits`` 32 MB at most. More keys only let more rows through.
BLOOM_BITS, MOST_BLOOM_BITS = 1 << 24, 1 << 28

#: Rows of one key that a task joins alone; keys with more are split while fewer than SPLIT_KEYS of
#: them are possible, beyond that (``SPLIT_KEYS * SPLIT_ROWS`` rows in all) at a share of all rows.
SPLIT_ROWS, SPLIT_KEYS = 256, 100_000


def written(frame: DataFrame, label: str) -> DataFrame:
    """The rows as a table in the shared folder: lineage ends here and lost executors cost nothing."""
    path = scratch_path(frame.sparkSession, label)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


#: Rows of an Arrow batch. Spark's own number suits short rows; whole texts are long, and a worker
#: and the JVM hold some batches at a time.
BATCH_ROWS = 2000


def batch_whole_texts(spark: SparkSession) -> None:
    """Let the session hand texts to Python in smaller batches than it does by default."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(name)) > BATCH_ROWS:
        spark.conf.set(name, BATCH_ROWS)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out() -> F.Column:
    """Rows that no model may learn from; a row without an id is none of them, but isn't learned from either."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))


def learnable() -> F.Column:
    return F.col("doc_id").isNotNull() & ~held_out()


def of_bounded_bytes(sample: DataFrame, most: int) -> DataFrame:
    """The rows of a training sample, without its longest texts where all exceed ``most`` bytes together.

    Texts are never cut. One number per sampled row reaches the driver; sampled rows are bounded.
    """
    sizes = np.sort(sample.select(F.octet_length("text").alias("size")).toArrow()["size"].drop_null().to_numpy())
    fit = int(np.searchsorted(np.cumsum(sizes, dtype=np.int64), most, side="right"))
    return sample if fit == len(sizes) else sample.where(F.octet_length("text") < int(sizes[fit]))


class Bloom:
    """Membership of 64-bit keys: never a false no."""

    def __init__(self, words: np.ndarray):
        self.words = words

    @staticmethod
    def places(keys: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
        keys = mix(keys.astype(np.uint64))
        last = np.uint64(bits - 1)
        return (keys & last).astype(np.int64), ((keys >> np.uint64(32)) & last).astype(np.int64)

    def holds(self, keys: np.ndarray) -> np.ndarray:
        one, two = self.places(keys, len(self.words) * 64)
        found = (self.words[one >> 6] >> (one & 63).astype(np.uint64)) & np.uint64(1)
        found &= (self.words[two >> 6] >> (two & 63).astype(np.uint64)) & np.uint64(1)
        return found.astype(bool)


def bloom(keys: DataFrame, bits: int = BLOOM_BITS) -> Bloom:
    """The filter of the only column of ``keys``; at most ``bits / 64`` numbers reach the driver."""

    def partial(batches):
        words = np.zeros(bits // 64, dtype=np.uint64)
        for batch in batches:
            column = batch.column(0).drop_null()
            for place in Bloom.places(column.to_numpy(zero_copy_only=False), bits):
                np.bitwise_or.at(words, place >> 6, np.uint64(1) << (place & 63).astype(np.uint64))
        index = np.flatnonzero(words)
        for at in range(0, len(index), 1 << 16):
            part = index[at : at + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(words[part].view(np.int64))], ["word", "bits"])

    rows = keys.mapInArrow(partial, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits"))
    found = rows.toArrow()
    words = np.zeros(bits // 64, dtype=np.uint64)
    words[found["word"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
    return Bloom(words)


def bloom_bits(keys: int) -> int:
    """Bits for about 16 a key, between the usual and the greatest size."""
    return min(max(BLOOM_BITS, 1 << (16 * keys).bit_length()), MOST_BLOOM_BITS)


def join_split(
    rows: DataFrame, other: DataFrame, key: list[str], by: str, how: str = "inner", counts: DataFrame | None = None
) -> DataFrame:
    """``rows`` joined with ``other`` on ``key`` (inner or left), however many rows one key has.

    The rows of a frequent key are dealt by ``by`` to several tasks, and the rows of ``other`` with
    that key are copied to each of them. Frequent is a key with more than SPLIT_ROWS rows and more
    than 1 / SPLIT_KEYS of all rows, so fewer than SPLIT_KEYS keys are ever broadcast. ``counts``
    (key, rows) saves counting where the caller has a table of it; keys missing there are not split.
    """
    if counts is None:
        counts = rows.groupBy(*key).agg(F.count("*").alias("rows"))
    total, top = counts.agg(F.sum("rows"), F.max("rows")).first()
    most = max(SPLIT_ROWS, (total or 0) // SPLIT_KEYS)
    if (top or 0) <= most:
        return rows.join(other, key, how)
    parts = F.broadcast(counts.where(F.col("rows") > most).select(*key, F.ceil(F.col("rows") / most).cast("int").alias("parts")))
    count = F.coalesce("parts", F.lit(1))
    dealt = rows.join(parts, key, "left").withColumn("part", F.pmod(F.xxhash64(by), count).cast("int"))
    copied = other.join(parts, key, "left").withColumn("part", F.explode(F.sequence(F.lit(0), count - 1)))
    return dealt.drop("parts").join(copied.drop("parts"), [*key, "part"], how).drop("part")


def without(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    """``docs`` without the rows whose id and text are in ``dropped`` (doc_id, text_hash).

    ``dropped`` is written first, so that its size on disk decides between broadcast and shuffle.
    """
    drop = written(dropped.select("doc_id", "text_hash").distinct(), "dropped")
    same = docs["doc_id"].eqNullSafe(drop["doc_id"]) & (F.xxhash64(docs["text"]) == drop["text_hash"])
    return docs.join(drop, same, "left_anti")
