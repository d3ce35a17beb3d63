"""Approximate nearest neighbours by a permutation index.

A vector is represented by its nearest pivots in order. It is posted in the inverted files of the
first POSTS of them, with its whole permutation. A query reads the files of its first PROBES
pivots, ranks their members by Spearman's footrule over its own nearest pivots, and reranks the
best by the exact inner product.

Largest inner products become nearest directions when every vector gets one more component that
brings it to the greatest length, and queries a zero; pivots see vectors in that form.

Equal vectors are one entry of the index with their least ids, so a vector that many rows share
costs as much as any other.

A file is searched in blocks of members and blocks of queries, every pair of which is one group, so no
task holds more than a block of each, whatever the table. Queries are looked at one by one: how they
are dealt changes nothing. Of a file in several member blocks, the best share is taken block by block.
"""

from __future__ import annotations

from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from footfall.llm.shared import written

NEAREST = 20
QUERY_EVERY = 20
#: Pivots at least, and the vectors they are chosen from, by a hash. With more entries there are as many
#: as the root of their number, up to a quarter of the sample.
PIVOTS, PIVOT_SAMPLE = 256, 4096
POSTS, PROBES = 8, 48
#: Nearest pivots of a query that the footrule is summed over.
PREFIX = 48
#: Share of a file that is reranked, and how many members at least.
RERANK, LEAST_RERANK = 0.4, 64
#: Members of a block of an inverted file, about; longer files are searched block by block.
BLOCK_MEMBERS = 8192
#: Queries of a file that are searched together, about.
BLOCK_QUERIES = 4096


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype="<f8").reshape(len(column), -1)


def _vectors(batches):
    for batch in batches:
        ids, found, lengths, dims = [], [], [], []
        for vec_id, vector in zip(batch.column("vec_id").to_pylist(), batch.column("embedding").to_pylist()):
            if vec_id is None or not vector or None in vector:
                continue
            vector = np.array(vector, dtype="<f8")
            if np.isfinite(vector).all() and vector.any():
                ids.append(vec_id)
                found.append((vector + 0.0).tobytes())  # -0.0 and 0.0 are one value
                lengths.append(float(vector @ vector))
                dims.append(len(vector))
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(found, pa.binary()), pa.array(lengths, pa.float64()), pa.array(dims, pa.int32())],
            ["vec_id", "vector", "square", "dims"],
        )


def entries(embeddings: DataFrame) -> DataFrame:
    """(vec_id, entry, vector, square) of the rows that take part; equal vectors have equal ``entry``.

    Null, zero and non-finite vectors, rows without an id, and vectors of a length other than the
    most frequent one take no part. Rows that repeat id and vector count once.
    """
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>"))
    rows = rows.mapInArrow(_vectors, "vec_id long, vector binary, square double, dims int")
    rows = written(rows.withColumn("entry", F.sha2("vector", 256)), "vectors")
    usual = rows.groupBy("dims").count().orderBy(F.desc("count"), "dims").limit(1).select("dims")
    return rows.join(F.broadcast(usual), "dims").drop("dims")


def _pivots(index: DataFrame, longest: float, count: int) -> np.ndarray:
    """Unit pivots, one per row, for ``count`` entries; fewer where there are few."""
    sample = index.orderBy(F.xxhash64("entry"), "entry").select("vector").limit(PIVOT_SAMPLE).toArrow()
    vectors = _augmented(_matrix(sample["vector"].combine_chunks()), longest)
    return vectors[: max(1, min(max(PIVOTS, isqrt(count)), len(vectors) // 4))]


def _augmented(vectors: np.ndarray, longest: float) -> np.ndarray:
    rest = np.sqrt(np.maximum(longest - (vectors * vectors).sum(axis=1), 0))
    return np.hstack([vectors, rest[:, None]])


def _permutations(likeness: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pivots from the nearest on, and the place of each pivot."""
    order = np.argsort(-likeness, axis=1, kind="stable")
    place = np.empty(order.shape, dtype=np.int16)
    np.put_along_axis(place, order, np.arange(order.shape[1], dtype=np.int16)[None, :], axis=1)
    return order, place


def _posted(index: DataFrame, pivots, longest: float, take: int, is_query: bool) -> DataFrame:
    """One row per entry and inverted file: (pivot, entry, vector, places of all pivots as bytes)."""

    def post(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                vectors = _matrix(part.column("vector"))
                seen = np.hstack([vectors, np.zeros((len(vectors), 1))]) if is_query else _augmented(vectors, longest)
                order, place = _permutations(seen @ pivots.value.T)
                files = order[:, :take]
                rows = pa.array(np.repeat(np.arange(len(vectors)), files.shape[1]))
                places = pa.array([x.tobytes() for x in place], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(files.ravel().astype(np.int32)), part.column("entry").take(rows),
                        part.column("vector").take(rows), places.take(rows),
                    ],
                    ["pivot", "entry", "vector", "places"],
                )

    return index.select("entry", "vector").mapInArrow(post, "pivot int, entry string, vector binary, places binary")


def _search(key: tuple, queries: pa.Table, members: pa.Table) -> pa.Table:
    """Per query the best of one block of an inverted file: (query, entry, score)."""
    found = {"query": [], "entry": [], "score": []}
    if len(queries) and len(members):
        vectors = _matrix(members["vector"].combine_chunks())
        places = np.frombuffer(b"".join(members["places"].to_pylist()), dtype=np.int16).reshape(len(members), -1)
        places = np.ascontiguousarray(places.T)
        entries = np.array(members["entry"].to_pylist(), dtype=object)
        take = min(len(members), max(LEAST_RERANK, int(np.ceil(RERANK * len(members)))))
        for name, raw, own in zip(*(queries[c].to_pylist() for c in ("entry", "vector", "places"))):
            own = np.frombuffer(own, dtype=np.int16)
            near = np.argsort(own, kind="stable")[:PREFIX]
            footrule = np.abs(places[near] - own[near][:, None]).sum(axis=0, dtype=np.int32)
            best = np.argpartition(footrule, take - 1)[:take] if take < len(members) else np.arange(take)
            scores = (vectors[best] * np.frombuffer(raw, dtype="<f8")).sum(axis=1)
            # Ties at the cut stay: ids decide among them later.
            if len(best) > NEAREST + 1:
                least = np.partition(scores, len(scores) - NEAREST - 1)[len(scores) - NEAREST - 1]
                best, scores = best[scores >= least], scores[scores >= least]
            found["query"] += [name] * len(best)
            found["entry"] += entries[best].tolist()
            found["score"] += scores.tolist()
    return pa.table({"query": pa.array(found["query"], pa.string()), "entry": pa.array(found["entry"], pa.string()), "score": pa.array(found["score"], pa.float64())})


def _candidates(queries: DataFrame, index: DataFrame, pivots, longest: float, probes: int) -> DataFrame:
    """(query, entry, score) found by ``queries`` in the files of their first ``probes`` pivots."""
    posted = _posted(index, pivots, longest, POSTS, False)
    asked = _posted(queries, pivots, longest, probes, True)
    def blocks(rows: DataFrame, size: int, name: str) -> DataFrame:
        sizes = rows.groupBy("pivot").count()  # one row for each pivot
        return F.broadcast(sizes.select("pivot", F.ceil(F.col("count") / size).cast("int").alias(name)))

    def dealt(rows: DataFrame, own: str, other: str, blocks: str, parts: str) -> DataFrame:
        mine = F.pmod(F.xxhash64("entry", F.lit(own)), F.col(blocks)).cast("int")
        return rows.withColumn(own, mine).withColumn(other, F.explode(F.sequence(F.lit(0), F.col(parts) - 1))).drop("blocks", "parts")

    members, questions = blocks(posted, BLOCK_MEMBERS, "blocks"), blocks(asked, BLOCK_QUERIES, "parts")
    posted = dealt(posted.join(members, "pivot").join(questions, "pivot"), "block", "part", "blocks", "parts")
    asked = dealt(asked.join(members, "pivot").join(questions, "pivot"), "part", "block", "parts", "blocks")
    key = ["pivot", "block", "part"]
    groups = asked.groupBy(*key).cogroup(posted.groupBy(*key))
    found = groups.applyInArrow(_search, "query string, entry string, score double")
    return found.distinct()


def nearest(embeddings: DataFrame) -> DataFrame:
    """(query_id, rank, vec_id, score): the nearest rows found for every query, nearest first.

    Queries are the rows whose id is divisible by QUERY_EVERY; candidates are all rows with
    another id. Scores are inner products in double precision; ties go to the smaller id. A query
    that finds fewer rows than there are searches every file. No rows give no rows.
    """
    rows = entries(embeddings)
    by_id = Window.partitionBy("entry").orderBy("vec_id")
    least = rows.select("entry", "vec_id").distinct().withColumn("n", F.row_number().over(by_id)).where(f"n <= {NEAREST + 1}")
    least = least.groupBy("entry").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    vectors = rows.groupBy("entry").agg(F.first("vector").alias("vector"), F.first("square").alias("square"))
    index = written(least.join(vectors, "entry"), "entries")
    asked = written(rows.where(f"vec_id % {QUERY_EVERY} = 0").select(F.col("vec_id").alias("query_id"), "entry").distinct(), "queries")
    queries = index.join(asked.select("entry").distinct(), "entry", "left_semi").select("entry", "vector")
    longest, count, different = index.agg(F.max("square"), F.sum(F.size("ids")), F.count("*")).first()
    if longest is None:
        return asked.selectExpr("query_id", "0 AS rank", "query_id AS vec_id", "0D AS score").where("false")
    pivots = embeddings.sparkSession.sparkContext.broadcast(_pivots(index, longest, different))
    found = written(_candidates(queries, index, pivots, longest, PROBES), "found")
    # Entries have up to NEAREST + 1 ids, of which the query's own is none of its candidates.
    wanted = min(NEAREST + 1, count)
    enough = found.join(index.select("entry", F.size("ids").alias("n")), "entry").groupBy("query").agg(F.sum("n").alias("n"))
    poor = queries.join(enough.where(f"n >= {wanted}").select(F.col("query").alias("entry")), "entry", "left_anti")
    poor = written(poor, "poor")
    if not poor.isEmpty():
        more = written(_candidates(poor, index, pivots, longest, PIVOTS), "found")
        found = found.union(more).distinct()
    ranked = found.join(index.select("entry", "ids"), "entry").select("query", "score", F.explode("ids").alias("vec_id"))
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    ranked = ranked.withColumn("n", F.row_number().over(order)).where(f"n <= {NEAREST + 1}")
    lists = ranked.groupBy("query").agg(F.sort_array(F.collect_list(F.struct("n", "vec_id", "score"))).alias("list"))
    mine = asked.join(lists.withColumnRenamed("query", "entry"), "entry")
    others = F.slice(F.filter("list", lambda x: x["vec_id"] != F.col("query_id")), 1, NEAREST)
    return mine.select("query_id", F.posexplode(others).alias("at", "hit")).select(
        "query_id", (F.col("at") + 1).alias("rank"), "hit.vec_id", "hit.score"
    )
