"""Connected components by alternating small-star and large-star rounds, contracted within tasks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.llm.shared import join_split, written

#: Edges that a task contracts at once, about.
CHUNK = 1 << 20


def _least_linked(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, least node linked with it by these edges), without the least nodes themselves."""
    nodes, ends = np.unique(np.concatenate([u, v]), return_inverse=True)
    one, two = ends[: len(u)], ends[len(u) :]
    label = np.arange(len(nodes))
    while True:
        a, b = label[one], label[two]
        apart = a != b
        if not apart.any():
            break
        one, two, a, b = one[apart], two[apart], a[apart], b[apart]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while (label[label] != label).any():
            label = label[label]
    moved = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[moved], nodes[label[moved]]


def _contracted(batches):
    """The edges (u, v) of a task, as stars around the least nodes of each chunk of them."""
    chunk, rows = [], 0

    def stars():
        u, v = _least_linked(*(np.concatenate([b.column(c).to_numpy() for b in chunk]) for c in ("u", "v")))
        return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])

    for batch in batches:
        chunk, rows = [*chunk, batch], rows + batch.num_rows
        if rows >= CHUNK:
            yield stars()
            chunk, rows = [], 0
    if rows:
        yield stars()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link every smaller neighbour of a node, and the node, to the least of them.

    Contracted first, a node has one smaller neighbour in each chunk, however many links it has.
    """
    edges = edges.mapInArrow(_contracted, "u long, v long")
    nodes = edges.groupBy("u").agg(F.collect_set("v").alias("smaller"))
    nodes = nodes.select("u", F.array_min("smaller").alias("m"), F.explode("smaller").alias("v"))
    return nodes.select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))


def _large_star(edges: DataFrame, moves: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node v to the least smaller neighbour m of v, where ``moves`` (v, m) has one."""
    return join_split(edges, moves, ["v"], "u", "left").select("u", F.coalesce("m", "v").alias("v"))


def _nodes(edges: DataFrame) -> DataFrame:
    """Of each node: its least and greatest smaller neighbour, and whether it has larger ones."""
    ends = edges.select(F.col("u").alias("node"), "v", F.lit(False).alias("centre")).union(
        edges.select("v", F.lit(None).cast("long"), F.lit(True))
    )
    return ends.groupBy("node").agg(F.min("v").alias("low"), F.max("v").alias("high"), F.max("centre").alias("centre"))


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component): the least node reachable, for every node in ``edges`` (a, b).

    Each round is a table in the shared folder; rounds end when only stars are left, whose centres
    are then the least nodes. Self-links and repeated links are allowed; no edges give no rows.
    """
    stars = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v")
    while True:
        stars = written(_small_star(stars), "stars")
        nodes = _nodes(stars)
        uneven = written(nodes.where("low < high OR centre AND low IS NOT NULL"), "uneven")
        if uneven.isEmpty():
            break
        stars = _large_star(stars, uneven.where("centre").select(F.col("node").alias("v"), F.col("low").alias("m")).where("m IS NOT NULL"))
    return nodes.select("node", F.coalesce("low", "node").alias("component"))
