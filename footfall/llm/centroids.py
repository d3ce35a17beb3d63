"""Centroid clustering with look-up tables of squared differences.

A vector becomes integers, ``floor(scale * x)`` for each component. In each round every vector goes to
its nearest centroid (squared Euclidean distance, ties to the smaller number) and every centroid that got
vectors becomes their componentwise ``floor(sum / count)``; after the rounds the vectors are assigned once
more. All of it is whole-number arithmetic, so the rows do not depend on how the table is partitioned.

No distance is computed vector by vector. For a block of vectors, and for each dimension, the squared
difference of every *occurring* integer value to every centroid is tabulated; the distances of the block
are then table gathers, one per dimension, added up. A block's tables hold at most as many values as the
block has rows, whatever the range of the components.

The integers are written once and read by every round. A task sends ``clusters x (dimensions + 1)`` sums,
however many rows it read and however many of them share a cluster, so a hot cluster or a vector that
fills a third of the table is no hot key. The driver holds the centroids alone.

Edges
-----
* A vector that is null, of another length, or that holds a null or non-finite component takes no part.
* A component beyond ``2**27`` in size after scaling counts as ``2**27``, so that any distance fits a long.
* Rows with the same id, or the same vector, are rows of their own. Of equal ids, the least vector comes
  first when centroids are chosen. A row without an id starts no centroid; it is assigned like the others.
* Fewer rows than centroids: as many centroids as there are rows with an id. None: no rows come out.
* An inertia that does not fit a long is null.
* Other columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.llm.shared import written

DIMENSIONS = 64
CLUSTERS = 40
ROUNDS = 5
SCALE = 256
#: Put before an id when the first centroids are drawn by hash.
SEED = "2"
#: Largest size of a component: 64 squares of twice this fit a long.
LARGEST = 1 << 27
#: Vectors whose values are tabulated together.
BLOCK = 4096


def whole_numbers(vectors: DataFrame, dimensions: int = DIMENSIONS, scale: int = SCALE) -> DataFrame:
    """vec_id and ``point``, the scaled and floored components of every usable vector."""
    vector = F.col("embedding").cast("array<double>")
    usable = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    scaled = F.transform(
        vector, lambda x: F.floor(F.greatest(F.least(x * scale, F.lit(float(LARGEST))), F.lit(-float(LARGEST)))).cast("int")
    )
    return vectors.where((F.size("embedding") == dimensions) & usable).select("vec_id", scaled.alias("point"))


def first_centroids(points: DataFrame, clusters: int, seed: str = SEED) -> np.ndarray:
    """The points whose ``seed:vec_id`` has the least hashes, in that order."""
    draw = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    rows = points.where("vec_id IS NOT NULL").orderBy(draw, "point").limit(clusters).collect()
    return np.array([r["point"] for r in rows], dtype=np.int64)


def distances(points: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distances, points by centroids, gathered from one table per dimension."""
    total = np.zeros((len(points), len(centroids)), dtype=np.int64)
    gathered = np.empty_like(total)
    for dimension in range(points.shape[1]):
        values, places = np.unique(points[:, dimension], return_inverse=True)
        squares = (values[:, None] - centroids[None, :, dimension]) ** 2
        total += np.take(squares, places, axis=0, out=gathered)
    return total


def _blocks(batch: pa.RecordBatch, dimensions: int) -> Iterator[tuple[int, np.ndarray]]:
    points = batch.column("point").flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dimensions)
    for at in range(0, len(points), BLOCK):
        yield at, points[at : at + BLOCK]


def moved(points: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after one round."""
    clusters, dimensions = centroids.shape

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((clusters, dimensions + 1), dtype=np.int64)  # the last column counts
        for batch in batches:
            for _, block in _blocks(batch, dimensions):
                nearest = distances(block, centroids).argmin(axis=1)
                order = np.argsort(nearest, kind="stable")
                held, starts = np.unique(nearest[order], return_index=True)
                sums[held, :-1] += np.add.reduceat(block[order], starts, axis=0)
                sums[held, -1] += np.diff(np.append(starts, len(block)))
        cluster, place = np.nonzero(sums)
        yield pa.RecordBatch.from_arrays(
            [pa.array(cluster, pa.int32()), pa.array(place, pa.int32()), pa.array(sums[cluster, place])],
            ["cluster", "place", "total"],
        )

    sums = points.select("point").mapInArrow(partial, "cluster int, place int, total long")
    rows = sums.groupBy("cluster", "place").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect()
    totals = {(r["cluster"], r["place"]): int(r["total"]) for r in rows}
    after = centroids.copy()
    for cluster in range(clusters):
        if count := totals.get((cluster, dimensions)):
            after[cluster] = [totals.get((cluster, d), 0) // count for d in range(dimensions)]
    return after


def assigned(points: DataFrame, centroids: np.ndarray) -> DataFrame:
    """vec_id, cluster and squared distance of every point."""
    dimensions = centroids.shape[1]
    key = points.schema["vec_id"].dataType.simpleString()

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, block in _blocks(batch, dimensions):
                found = distances(block, centroids)
                cluster = found.argmin(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("vec_id").slice(at, len(block)),
                        pa.array(cluster, pa.int32()),
                        pa.array(found[np.arange(len(block)), cluster]),
                    ],
                    ["vec_id", "cluster", "distance"],
                )

    return points.mapInArrow(nearest, f"vec_id {key}, cluster int, distance long")


def fingerprint(centroid: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, centroid.tolist())).encode()).hexdigest()


def _long(number: int) -> int | None:
    return number if number < 1 << 63 else None


def clustered(
    vectors: DataFrame,
    clusters: int = CLUSTERS,
    rounds: int = ROUNDS,
    dimensions: int = DIMENSIONS,
    scale: int = SCALE,
    seed: str = SEED,
) -> tuple[DataFrame, np.ndarray]:
    """The rows of all usable vectors (vec_id, cluster, distance, cluster_inertia, inertia,
    centroid_sha256), and the last centroids as an array."""
    spark = vectors.sparkSession
    points = written(whole_numbers(vectors, dimensions, scale), "points")
    centroids = first_centroids(points, clusters, seed).reshape(-1, dimensions)
    per_cluster = "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"
    if not len(centroids):
        nothing = spark.createDataFrame([], per_cluster)
        empty = points.where("false").select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance"))
        return empty.join(nothing, "cluster").select("vec_id", "cluster", "distance", *nothing.columns[1:]), centroids
    for _ in range(rounds):
        centroids = moved(points, centroids)
    rows = written(assigned(points, centroids), "assigned")
    sums = rows.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("inertia")).collect()
    inertias = {r["cluster"]: int(r["inertia"]) for r in sums}
    every = _long(sum(inertias.values()))
    facts = spark.createDataFrame(
        [(c, _long(total), every, fingerprint(centroids[c])) for c, total in inertias.items()], per_cluster
    )
    # One row per cluster, so never more than the parameter says.
    found = rows.join(F.broadcast(facts), "cluster")
    return found.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"), centroids
