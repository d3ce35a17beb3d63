"""Quality of a text by supervised subword embeddings.

Features are hashed: words, pairs of neighbouring words, and character 3- and 4-grams within
words. A word that repeats its predecessor is replaced by one common mark, so that repetition is
something that can be learned. Each feature has a learned vector; a text is the mean of its
features' vectors, and a softmax layer maps it to the classes. Both are trained by stochastic
gradient descent in numpy. The layer is linear, so for scoring each bucket's vector is mapped to
its logits once, and a text costs one look-up per feature.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.llm.shared import held_out, learnable, of_bounded_bytes
from footfall.llm.text import NOT_SPACE, characters, chunks, grams, hashes, mix, spans

BUCKETS = 1 << 18
DIMENSIONS = 16
CHARACTERS = (3, 4)
#: About so many labelled texts of each class are learned from, chosen by a hash of the id.
SAMPLE = 3000
#: Bytes of the texts learned from, together; beyond, the longest of the sample are left out.
SAMPLE_BYTES = 96 << 20
EPOCHS = 4
RATE = 0.5
#: Stands for a word that repeats its predecessor.
_REPEATED = np.uint64(0x2545F4914F6CDD1D)


def features(column: pa.Array):
    """(buckets of all features, first feature of each text) per kind of feature, chunk by chunk."""
    for _, data, offsets in chunks(column):
        starts, ends, _ = spans(data, offsets, NOT_SPACE)
        words = hashes(data, starts, ends)
        first = np.searchsorted(starts, offsets)
        text = np.repeat(np.arange(len(first) - 1), np.diff(first))
        again = np.zeros(len(words), dtype=bool)
        if len(words) > 1:
            again[1:] = (words[1:] == words[:-1]) & (text[1:] == text[:-1])
        marked = np.where(again, _REPEATED, words)
        pairs = grams(marked, 2)
        inside = text[1:] == text[:-1]
        pair_first = np.searchsorted(np.flatnonzero(inside), first) if len(pairs) else np.zeros_like(first)
        kinds = [(marked, first), (pairs[inside] if len(pairs) else pairs, pair_first)]
        codes, places, firsts = characters(data, offsets)
        solid_until = np.concatenate([[0], np.cumsum(NOT_SPACE[data[places]])])
        text_of = np.repeat(np.arange(len(firsts) - 1), np.diff(firsts))
        for n in CHARACTERS:
            found = grams(codes, n)
            at = np.arange(len(found))
            whole = (solid_until[n:][: len(found)] - solid_until[: len(found)] == n) & (text_of[at] == text_of[at + n - 1])
            at = np.flatnonzero(whole)
            kinds.append((found[at], np.searchsorted(at, firsts)))
        yield [((mix(h + np.uint64(i)) >> np.uint64(46)).astype(np.int64), f) for i, (h, f) in enumerate(kinds)]


def _sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sum of each text's values."""
    if not len(values):
        return np.zeros(len(first) - 1)
    sums = np.add.reduceat(values, np.minimum(first[:-1], len(values) - 1))
    sums[np.diff(first) == 0] = 0
    return sums


@dataclass
class Model:
    """The log odds of class 1 that each bucket and the bias contribute."""

    table: np.ndarray
    bias: float
    empty: float  # score of a text without features

    def scores(self, column: pa.Array) -> np.ndarray:
        out = [np.empty(0)]
        for kinds in features(column):
            total, count = 0.0, 0
            for bucket, first in kinds:
                total = total + _sums(self.table[bucket], first)
                count = count + np.diff(first)
            odds = total / np.maximum(count, 1) + self.bias
            out.append(np.where(count > 0, 1 / (1 + np.exp(-np.clip(odds, -500, 500))), self.empty))
        return np.concatenate(out)


def _sample(labels: DataFrame, per_class: int) -> DataFrame:
    """(doc_id, quality) of about ``per_class`` labelled ids of each class, each id once."""
    rows = labels.where(learnable() & F.col("quality").isin(0, 1)).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    sizes = rows.groupBy("quality").count().withColumnRenamed("count", "n")
    place = (F.xxhash64("doc_id", F.lit("quality")) / F.lit(2.0**64)) + 0.5
    return rows.join(F.broadcast(sizes), "quality").where(place < F.lit(float(per_class)) / F.col("n"))


def _descend(vectors: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Feature vectors, layer and bias after the epochs, from the (buckets, counts) and class of each text."""
    rng = np.random.RandomState(11)
    embedding = (rng.random_sample((BUCKETS, DIMENSIONS)) - 0.5) / DIMENSIONS
    layer, bias = np.zeros((DIMENSIONS, 2)), np.zeros(2)
    steps, step = EPOCHS * len(vectors), 0
    for _ in range(EPOCHS):
        for i in rng.permutation(len(vectors)):
            rate = RATE * (1 - step / steps)
            step += 1
            bucket, count = vectors[i]
            if not len(bucket):
                continue
            share = count / count.sum()
            hidden = share @ embedding[bucket]
            logits = hidden @ layer + bias
            chance = np.exp(logits - logits.max())
            chance /= chance.sum()
            chance[y[i]] -= 1
            back = layer @ chance
            layer -= rate * np.outer(hidden, chance)
            bias -= rate * chance
            # The mean shares its gradient among its features; as every feature of the text is
            # moved, the text moves by the sum of squared shares, so the step is scaled back.
            embedding[bucket] -= (rate * share / (share @ share))[:, None] * back
    return embedding, layer, bias


def train(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE) -> Model | None:
    """A model from labelled texts that may be learned from; None where there are none.

    The bounded sample is broadcast to the documents and fetched with their whole texts. Classes
    are sampled to about equal sizes; the bias is then moved to the classes' shares among all
    labels, so that scores are probabilities of the labelled population.
    """
    wanted = _sample(labels, per_class).select("doc_id", "quality", "n")
    chosen = docs.select("doc_id", "text").join(F.broadcast(wanted), "doc_id").where("text IS NOT NULL")
    rows = of_bounded_bytes(chosen, SAMPLE_BYTES).toArrow().combine_chunks()
    if not len(rows):
        return None
    texts = rows["text"].to_pylist()
    order = sorted(range(len(rows)), key=lambda i: (rows["doc_id"][i].as_py(), texts[i]))
    rows = rows.take(pa.array(order))
    y, sizes = rows["quality"].to_numpy().astype(int), rows["n"].to_numpy()
    vectors = []
    for kinds in features(rows["text"].combine_chunks()):
        for i in range(len(kinds[0][1]) - 1):
            own = np.concatenate([bucket[first[i] : first[i + 1]] for bucket, first in kinds])
            vectors.append(np.unique(own, return_counts=True))
    embedding, layer, bias = _descend(vectors, y)
    direction = layer[:, 1] - layer[:, 0]
    n = {c: (sizes[y == c][0] if (y == c).any() else 0, (y == c).sum()) for c in (0, 1)}
    prior = 0.0
    if n[0][1] and n[1][1]:
        prior = np.log(n[1][0] / n[0][0]) - np.log(n[1][1] / n[0][1])
    odds = bias[1] - bias[0] + prior
    return Model(embedding @ direction, float(odds), float(1 / (1 + np.exp(-odds))))


def score(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of ``docs`` (doc_id, text, ...).

    A null, empty or blank text has the score of the classes' shares. Without anything to learn
    from, every score is 0.5. Ids labelled more than once count once, with their least label. Rows
    with null ids are scored but not learned from; repeated rows get equal results; no rows give no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(train(docs, labels, per_class))

    def run(batches):
        model = shared.value
        for batch in batches:
            found = model.scores(batch.column("text")) if model else np.full(batch.num_rows, 0.5)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(found), pa.array((found >= 0.5).astype(np.int32))],
                ["doc_id", "held_out", "score", "predicted"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), "text")
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")
