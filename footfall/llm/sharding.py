"""Shards of documents by a permutation-filled look-up table.

Every shard has a preference order of all slots of a table of prime size: start at a hash of its
name, go on in steps of another. Shards take turns and claim their next free slot until the table
is full, so their shares differ by one slot at most, and when a shard comes or goes few slots
change hands. A document's slot is a hash of its id modulo the size; the table has TABLE_SIZE
rows whatever the input, so it is broadcast, and placement is one look-up.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A prime, at least 64 times the number of shards.
TABLE_SIZE = 4099
SHARDS = 64


def shard_names(n: int) -> list[str]:
    return [f"shard-{i:05d}" for i in range(n)]


def _number(text: str) -> str:
    """SQL for a 60-bit number from a text."""
    return f"cast(conv(substr(md5({text}), 1, 15), 16, 10) as bigint)"


def lookup_table(spark: SparkSession, names: list[str], size: int = TABLE_SIZE) -> DataFrame:
    """(slot, shard): the number of the shard that owns each slot; ``size`` must be prime.

    One expression fills the table: its state is the owner of each slot, -1 for a free one.
    """
    if not 0 < len(names) <= size:
        raise ValueError("the table needs a slot for every shard")
    if size < 2 or any(size % d == 0 for d in range(2, int(size**0.5) + 1)):
        raise ValueError("the table's size must be prime")
    shards = spark.range(1).select(F.array(*map(F.lit, names)).alias("names"))
    shards = shards.selectExpr(
        f"transform(names, x -> cast({_number("concat(x, '#start')")} % {size} as int)) AS starts",
        f"transform(names, x -> cast({_number("concat(x, '#step')")} % ({size} - 1) + 1 as int)) AS steps",
    )
    n = len(names)
    # The slot at place j of a shard's preferences; the first free one is claimed.
    slot = f"cast((starts[turn % {n}] + cast(j as bigint) * steps[turn % {n}]) % {size} as int)"
    free = f"array_min(filter(sequence(0, {size - 1}), j -> owners[{slot}] < 0))"
    claimed = f"transform(array({free}), j -> {slot})[0]"
    fill = (
        f"aggregate(sequence(0, {size - 1}), array_repeat(-1, {size}), (owners, turn) -> "
        f"transform(array({claimed}), c -> transform(owners, (o, k) -> if(k = c, turn % {n}, o)))[0])"
    )
    return shards.selectExpr(f"posexplode({fill}) AS (slot, shard)")


def slot_of(key: Column, size: int = TABLE_SIZE) -> Column:
    """The slot of a key; all null keys have that of an empty text."""
    text = F.coalesce(key.cast("string"), F.lit(""))
    return (F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long") % size).cast("int")


def place(docs: DataFrame, names: list[str], key: str = "doc_id", size: int = TABLE_SIZE) -> DataFrame:
    """``docs`` with slot and shard; columns of these names are replaced.

    Placement follows the key alone: equal keys, and all null keys, share a shard. The documents
    are not shuffled. No rows give no rows.
    """
    owners = F.broadcast(lookup_table(docs.sparkSession, names, size))
    return docs.drop("slot", "shard").withColumn("slot", slot_of(F.col(key), size)).join(owners, "slot")


def write_shards(placed: DataFrame, path: str) -> None:
    """Write a folder per shard. Large shards are written by several tasks, small ones together."""
    placed.hint("rebalance", "shard").write.partitionBy("shard").parquet(path)
