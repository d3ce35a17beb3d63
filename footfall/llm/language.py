"""Language of a text: sparse multinomial logistic regression on TF-IDF of character n-grams.

Features are hashed 1-, 2- and 3-grams of the lower-cased letters, with one space for whatever
stands between words. The term frequency is an n-gram's share of a text's n-grams, so a text's
logits are the mean over its n-grams of idf times weight: one table look-up per n-gram.
Weights are trained with FTRL-proximal and an elastic net; a temperature is fitted afterwards on
texts that training didn't see. Document frequencies are counted over all texts to learn from.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.llm.shared import held_out, learnable, of_bounded_bytes
from footfall.llm.text import chunks

#: Hash buckets of the n-grams; one more takes what crosses texts.
BUCKETS = 1 << 17
ORDERS = (1, 2, 3)
#: About so many texts of each language are learned from, chosen by a hash of the id.
SAMPLE = 1000
#: Bytes of the texts learned from, together; beyond, the longest of the sample are left out.
SAMPLE_BYTES = 96 << 20
#: Share of the sample on which the temperature is fitted.
CALIBRATION = 0.2
#: So many languages are learned, the most frequent ones (of equal ones, those that sort first): the
#: model's table has a column for each, 1 MB. Texts of others are predicted like any text.
MOST_LANGUAGES = 200
EPOCHS = 3
ALPHA, BETA, L1, L2 = 0.5, 1.0, 1e-4, 1e-4
#: N-gram shares are small numbers; training sees them times this.
SCALE = 32.0
UNKNOWN = "und"
#: Predictions below this probability are rejected by ``keep_known``.
LEAST_SCORE = 0.5

_FACTORS = np.array([0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35], dtype=np.uint32)
_SHIFT = np.uint32(32 - BUCKETS.bit_length() + 1)


def _letters() -> np.ndarray:
    """Lower-cased code of each letter, 32 for every other character."""
    table = np.full(0x110000, 32, dtype=np.uint32)
    for code in range(0x110000):
        char = chr(code)
        if char.isalpha():
            lower = char.lower()
            table[code] = ord(lower) if len(lower) == 1 else code
    return table


_tables: dict[str, np.ndarray] = {}


def gram_buckets(column: pa.Array):
    """(buckets of all n-grams as one array per order, first n-gram of each text, letters in each text)."""
    if "letters" not in _tables:
        _tables["letters"] = _letters()
    for _, data, offsets in chunks(column):
        codes = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), dtype=np.uint32)
        leads = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)]) if len(data) else np.zeros(1, np.int64)
        codes = _tables["letters"][codes]
        # A text begins and ends with a space of its own, and runs of spaces are one.
        edges = leads[offsets]
        codes = np.insert(codes, edges, 32)
        starts = edges + np.arange(len(edges))
        space = codes == 32
        keep = np.ones(len(codes), dtype=bool)
        keep[1:] = ~(space[1:] & space[:-1])
        keep[starts] = True
        firsts = np.concatenate([[0], np.cumsum(keep)])[starts]
        letters = np.concatenate([[0], np.cumsum(~space)])
        letters = letters[starts[1:]] - letters[starts[:-1]]
        codes = codes[keep]
        # The last space belongs to no text; it closes the last one.
        n = int(firsts[-1])
        grams, ends = [], firsts[1:] - firsts[:-1]
        text_end = np.repeat(firsts[1:], ends)
        at = np.arange(n)
        for order in ORDERS:
            mixed = np.full(n, order, dtype=np.uint32)
            for i in range(order):
                mixed += np.resize(codes[i:], n) * _FACTORS[i] if i else codes[:n] * _FACTORS[0]
            mixed ^= mixed >> np.uint32(15)
            mixed *= np.uint32(0x2C1B3C6D)
            bucket = (mixed >> _SHIFT).astype(np.int64)
            if order > 1:
                bucket[at + order - 1 > text_end] = BUCKETS
            grams.append(bucket)
        yield grams, firsts, letters


@dataclass
class Model:
    languages: list[str]
    table: np.ndarray  # BUCKETS + 1 by languages: idf times weight, the last row zero
    bias: np.ndarray
    temperature: float

    def logits(self, column: pa.Array):
        """(logits by text and language, letters by text) of the whole column."""
        sums, letters = [np.empty((0, len(self.languages)))], [np.empty(0, np.int64)]
        for grams, firsts, own in gram_buckets(column):
            total = np.zeros((len(own), len(self.languages)))
            count = np.zeros(len(own))
            for bucket in grams:
                total += np.add.reduceat(self.table[bucket], firsts[:-1], axis=0)
                count += np.add.reduceat(bucket < BUCKETS, firsts[:-1], dtype=np.int64)
            sums.append(total / np.maximum(count, 1)[:, None] + self.bias)
            letters.append(own)
        return np.concatenate(sums), np.concatenate(letters)


def softmax(logits: np.ndarray) -> np.ndarray:
    raised = np.exp(logits - logits.max(axis=1, keepdims=True))
    return raised / raised.sum(axis=1, keepdims=True)


def document_frequencies(docs: DataFrame) -> tuple[np.ndarray, int]:
    """In how many texts each bucket occurs, and how many texts there are; at most BUCKETS rows are fetched."""

    def count(batches):
        found, texts = np.zeros(BUCKETS + 1, dtype=np.int64), 0
        for batch in batches:
            for grams, firsts, own in gram_buckets(batch.column("text")):
                texts += len(own)
                for start, end in zip(firsts[:-1], firsts[1:]):
                    seen = np.zeros(BUCKETS + 1, dtype=bool)
                    for bucket in grams:
                        seen[bucket[start:end]] = True
                    found[np.flatnonzero(seen)] += 1
        found[BUCKETS] = texts
        index = np.flatnonzero(found)
        if len(index):
            yield pa.RecordBatch.from_arrays([pa.array(index), pa.array(found[index])], ["bucket", "n"])

    rows = docs.select("text").mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    found = np.zeros(BUCKETS + 1, dtype=np.int64)
    found[rows["bucket"].to_numpy()] = rows["n"].to_numpy()
    return found[:BUCKETS], int(found[BUCKETS])


def sample(docs: DataFrame, per_language: int) -> DataFrame:
    """About ``per_language`` rows of each of the most frequent languages, chosen by a hash of the id."""
    sizes = docs.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(MOST_LANGUAGES).collect()
    # A language that is not learned has no chance, which is null.
    chance = F.create_map(*[F.lit(x) for lang, n in sizes for x in (lang, per_language / n)])[F.col("lang")] if sizes else F.lit(0.0)
    place = (F.xxhash64("doc_id", "lang") / F.lit(2.0**64)) + 0.5
    return docs.where(place < chance).select("doc_id", "lang", "text")


def _ftrl(rows: list, labels: np.ndarray, n_classes: int, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weights (buckets by classes) and bias after EPOCHS passes over (buckets, values) rows."""
    z, n = np.zeros((BUCKETS + 1, n_classes)), np.zeros((BUCKETS + 1, n_classes))

    def weights(z, n):
        shrunk = np.sign(z) * np.maximum(np.abs(z) - L1, 0)
        return -shrunk / ((BETA + np.sqrt(n)) / ALPHA + L2)

    for i in np.tile(order, EPOCHS):
        index, value = rows[i]
        w = weights(z[index], n[index])
        logits = value @ w
        chance = np.exp(logits - logits.max())
        chance /= chance.sum()
        chance[labels[i]] -= 1
        gradient = value[:, None] * chance
        grown = n[index] + gradient * gradient
        z[index] += gradient - (np.sqrt(grown) - np.sqrt(n[index])) / ALPHA * w
        n[index] = grown
    w = weights(z, n)
    return w[:BUCKETS], w[BUCKETS]


def _best_temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature of least log loss, by a search over powers of two in steps of an eighth."""
    if not len(labels):
        return 1.0
    loss = {}
    for t in 2.0 ** np.arange(-6, 6.01, 0.125):
        chance = softmax(logits / t)[np.arange(len(labels)), labels]
        loss[t] = -np.log(np.maximum(chance, 1e-300)).mean()
    return float(min(loss, key=loss.get))


def train(docs: DataFrame, per_language: int = SAMPLE) -> Model | None:
    """A model from the labelled rows that may be learned from; None without any letter to learn from."""
    labelled = docs.where(learnable() & F.col("lang").isNotNull() & F.col("text").isNotNull())
    frequency, texts = document_frequencies(labelled)
    chosen = of_bounded_bytes(sample(labelled.select("doc_id", "lang", "text"), per_language), SAMPLE_BYTES)
    rows = chosen.toArrow().combine_chunks()
    order = np.lexsort((np.array(rows["lang"].to_pylist(), dtype=object), rows["doc_id"].to_numpy())) if len(rows) else []
    rows = rows.take(pa.array(order, pa.int64()))
    if not len(rows) or not frequency.any():
        return None
    languages = sorted(set(rows["lang"].to_pylist()))
    labels = np.searchsorted(languages, rows["lang"].to_pylist())
    idf = np.append(np.log((1 + texts) / (1 + frequency)) + 1, 0.0)
    vectors = []
    for grams, firsts, _ in gram_buckets(rows["text"].combine_chunks()):
        for start, end in zip(firsts[:-1], firsts[1:]):
            index, count = np.unique(np.concatenate([b[start:end] for b in grams]), return_counts=True)
            count = count[index < BUCKETS]
            index = index[index < BUCKETS]
            # The bias is one more feature, of value 1.
            vectors.append((np.append(index, BUCKETS), np.append(idf[index] * count / count.sum() * SCALE, 1.0)))
    shuffled = np.random.RandomState(17).permutation(len(vectors))
    kept = int(len(vectors) * CALIBRATION) if len(vectors) >= 20 else 0
    weight, bias = _ftrl(vectors, labels, len(languages), shuffled[kept:])
    table = np.vstack([weight * idf[:BUCKETS, None] * SCALE, np.zeros((1, len(languages)))])
    model = Model(languages, table, bias, 1.0)
    if kept:
        logits, _ = model.logits(rows["text"].combine_chunks().take(pa.array(shuffled[:kept])))
        model.temperature = _best_temperature(logits, labels[shuffled[:kept]])
    return model


def judge(column: pa.Array, model: Model | None) -> tuple[np.ndarray, np.ndarray]:
    """Language and score of each text; ties go to the language that sorts first.

    A text without a letter, or null, is ``und`` with score 0; so is every text when there was
    nothing to learn from.
    """
    names, scores = np.full(len(column), UNKNOWN, dtype=object), np.zeros(len(column))
    if model and len(column):
        logits, letters = model.logits(column)
        chance = softmax(logits / model.temperature)
        best = chance.argmax(axis=1)
        known = letters > 0
        names[known] = np.array(model.languages, dtype=object)[best[known]]
        scores[known] = chance[np.arange(len(best)), best][known]
    return names, scores


def predictions(docs: DataFrame, per_language: int = SAMPLE) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every row of ``docs`` (doc_id, text, lang, ...).

    Rows with null ids, texts or languages are predicted like any other but not learned from.
    Repeated rows get equal results; other columns are ignored; no rows give no rows.
    """
    model = docs.sparkSession.sparkContext.broadcast(train(docs, per_language))

    def run(batches):
        for batch in batches:
            names, scores = judge(batch.column("text"), model.value)
            columns = [batch.column("doc_id"), batch.column("held_out"), pa.array(names, pa.string()), pa.array(scores)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "held_out", "lang_pred", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), "text")
    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")


def keep_known(docs: DataFrame) -> DataFrame:
    """``docs`` without the texts that have no letter or whose language is uncertain (score under LEAST_SCORE)."""
    model = docs.sparkSession.sparkContext.broadcast(train(docs))
    at = docs.columns.index("text")

    def run(batches):
        for batch in batches:
            names, scores = judge(batch.column(at), model.value)
            yield batch.filter(pa.array((names != UNKNOWN) & (scores >= LEAST_SCORE), pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
