"""Token ids of all documents as one long sequence in files, packed with Simple-8b.

Files are Parquet tables of chunks, so that Spark writes and commits them on any store. A chunk
holds the ids of some consecutive documents:

    part, chunk     place in the sequence: parts in order, chunks in order within a part
    first, n_ids    ids of the part before the chunk, and ids in it
    doc_ids, counts the documents and how many ids each has
    offsets         the first word of every block of 1024 ids, and the end
    words           the packed 64-bit words, little-endian

A chunk has about CHUNK_IDS ids at most and ends with a document, so a document is never cut.
"""

from __future__ import annotations

import json
import os
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from footfall.llm.simple8b import BLOCK, pack, unpack
from footfall.llm.text import LOWER, chunks

CHUNK_IDS = 1 << 18
#: Words whose ids a worker keeps; beyond that the older half goes.
KEPT_WORDS = 800_000
#: Bytes of text that are encoded together, unless a single text is longer.
SLICE_BYTES = 1 << 23

FILE = (
    "part int, chunk int, first long, n_ids long, doc_ids array<long>, counts array<int>, "
    "offsets array<int>, words binary"
)


#: Words of small letters, none with an accent that stands apart, and perhaps a run of marks other
#: than apostrophes: one piece, or two.
_PLAIN = r"^[a-z\x{DF}-\x{F6}\x{F8}-\x{FF}]+[!-&(-/:-@\[-`{-~]*$"
_MARK = r"([!-&(-/:-@\[-`{-~]+)$"
#: Bytes, with a space for each tab and line end.
_SPACED = np.arange(256, dtype=np.uint8)
_SPACED[[9, 10, 13]] = 32


class WordEncoder:
    """Ids of whole texts by the tokenizers library; the ids of a word between white space are kept.

    The vocabulary splits at white space, so a text's ids are those of its words one after another.
    Words are split, numbered and looked up by Arrow, each different word of a slice once. Unknown
    words are encoded in one call. Plain ones are given to the library as pieces, which end with a
    vocabulary string that ends a word; it is spared the patterns that find pieces. Others are
    encoded with a special token between them: special tokens are cut out before anything else.
    """

    def __init__(self, vocabulary: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        spec = json.loads(vocabulary)
        self.tokenizer = Tokenizer.from_str(vocabulary)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.cut_id, self.cut = min((t["id"], t["content"]) for t in spec["added_tokens"] if t["special"])
        suffix, ids = spec["model"]["end_of_word_suffix"], spec["model"]["vocab"]
        self.last = np.zeros(max(ids.values()) + 1, dtype=bool)
        self.last[[number for string, number in ids.items() if string.endswith(suffix)]] = True
        byte_level = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}
        split = {"type": "Sequence", "pretokenizers": [{"type": "WhitespaceSplit"}, byte_level]}
        self.pieces = Tokenizer.from_str(json.dumps(spec | {"normalizer": None, "pre_tokenizer": split}))
        # Known words, their ids one after another, and how many each has.
        self.words = pa.array([""], pa.large_string())
        self.flat, self.sizes = np.empty(0, "<u4"), np.zeros(1, np.int64)

    @staticmethod
    def _ids(tokenizer, text: str) -> np.ndarray:
        (found,) = tokenizer.encode_batch_fast([text], add_special_tokens=False)
        return np.array(found.ids, dtype="<u4")

    def _plain(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of plain words one after another, and how many each has."""
        parted = pc.replace_substring_regex(words, _MARK, r" \1")
        pieces = 1 + (pc.binary_length(parted).to_numpy() > pc.binary_length(words).to_numpy())
        joined = pc.binary_join(pa.ListArray.from_arrays([0, len(parted)], parted), pa.scalar(" ", parted.type))
        ids = self._ids(self.pieces, joined[0].as_py())
        ends = np.flatnonzero(self.last[ids])[np.cumsum(pieces) - 1] + 1
        return ids, np.diff(ends, prepend=0)

    def _other(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The same for any words."""
        words = words.to_pylist()
        special = [self._ids(self.tokenizer, word) if "<|" in word else None for word in words]
        ids = self._ids(self.tokenizer, self.cut.join("" if x is not None else word for word, x in zip(words, special)))
        cuts = np.flatnonzero(ids == self.cut_id)
        found = np.split(ids, cuts)
        found = [x[1:] if i else x for i, x in enumerate(found)]
        found = [x if own is None else own for x, own in zip(found, special, strict=True)]
        return np.concatenate(found), np.array([len(x) for x in found], dtype=np.int64)

    def _forget(self) -> None:
        """Drop the older half of too many words."""
        if len(self.words) > KEPT_WORDS:
            half = len(self.words) // 2
            self.flat = self.flat[self.sizes[:half].sum() :]
            self.words, self.sizes = self.words.slice(half), self.sizes[half:]

    def _learn(self, words: pa.Array) -> np.ndarray:
        """Make words known that are not; their places among the known ones."""
        plain = pc.match_substring_regex(words, _PLAIN)
        parts = [(self.words, self.flat, self.sizes)]
        places = np.empty(len(words), dtype=np.int64)
        at = len(self.words)
        for mask, encode in ((plain, self._plain), (pc.invert(plain), self._other)):
            some = words.filter(mask)
            places[np.flatnonzero(mask.to_numpy(zero_copy_only=False))] = at + np.arange(len(some))
            at += len(some)
            if len(some):
                parts.append((some, *encode(some)))
        names, flat, sizes = zip(*parts)
        self.words, self.flat, self.sizes = pa.concat_arrays(names), np.concatenate(flat), np.concatenate(sizes)
        return places

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts of a chunk one after another, first id of each text and the end)."""
        # Lower-casing, which the vocabulary does itself, makes more words alike. It must not come
        # before accents are composed, or make a special token of a string like "<|...|>". White
        # space other than this stays inside words, where the library finds it.
        odd = data >= 0xCC
        odd[:-1] |= (data[:-1] == 0x3C) & (data[1:] == 0x7C)
        lowered = LOWER[_SPACED][data]
        if odd.any():
            seen = np.concatenate([[0], np.cumsum(odd)])[offsets]
            keep_case = np.repeat(np.diff(seen) > 0, np.diff(offsets))
            lowered = np.where(keep_case, _SPACED[data], lowered)
        buffers = [pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(lowered)]
        lists = pc.split_pattern(pa.LargeStringArray.from_buffers(len(offsets) - 1, *buffers), " ")
        words = lists.flatten().dictionary_encode()
        self._forget()
        known = pc.index_in(words.dictionary, value_set=self.words)
        place = known.fill_null(-1).to_numpy().astype(np.int64)
        if known.null_count:
            place[place < 0] = self._learn(words.dictionary.filter(pc.is_null(known)))
        index = place[words.indices.to_numpy()]
        first, sizes = np.cumsum(self.sizes) - self.sizes, self.sizes[index]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        places = np.arange(ends[-1]) + np.repeat(first[index] - ends[:-1], sizes)
        starts = lists.offsets.to_numpy()
        return self.flat[places], ends[starts - starts[0]]


_encoders: dict[int, WordEncoder] = {}


def _chunk(part: int, chunk: int, first: int, doc_ids: pa.Array, counts: np.ndarray, ids: np.ndarray) -> pa.RecordBatch:
    words, offsets = pack(ids)
    columns = [
        pa.array([part], pa.int32()), pa.array([chunk], pa.int32()), pa.array([first], pa.int64()),
        pa.array([len(ids)], pa.int64()), pa.ListArray.from_arrays([0, len(doc_ids)], doc_ids),
        pa.array([counts.astype(np.int32)], pa.list_(pa.int32())),
        pa.array([offsets.astype(np.int32)], pa.list_(pa.int32())),
        pa.array([words.astype("<u8").tobytes()], pa.binary()),
    ]
    return pa.RecordBatch.from_arrays(columns, [x.split()[0] for x in FILE.split(", ")])


def write_token_file(docs: DataFrame, vocabulary_file: str, path: str, end_id: int) -> None:
    """Write the ids of every text, each followed by ``end_id``, in ascending order of doc_id.

    Null and empty texts have the end id alone. Rows without a doc_id come first; rows of one
    doc_id are in the order of a hash of their texts. The texts are shuffled once, by ranges of
    doc_id. The vocabulary file is read by the driver and broadcast: its size is fixed.
    """
    with open(vocabulary_file, encoding="utf-8") as file:
        vocabulary = docs.sparkSession.sparkContext.broadcast(file.read())

    def run(batches):
        key = hash(vocabulary.value)
        if key not in _encoders:
            _encoders.clear()
            _encoders[key] = WordEncoder(vocabulary.value)
        part, chunk, written = TaskContext.get().partitionId(), 0, 0
        for batch in batches:
            for first, data, offsets in chunks(batch.column("text"), SLICE_BYTES):
                some = batch.slice(first, len(offsets) - 1)
                ids, starts = _encoders[key].encode(data, offsets)
                ids = np.insert(ids, starts[1:], end_id)
                starts = starts + np.arange(len(starts))
                # A chunk ends with the text that fills it; the last one of a slice may be short.
                filled = np.flatnonzero(np.diff(starts // CHUNK_IDS)) + 1
                edges = np.unique(np.concatenate([[0], filled, [len(starts) - 1]]))
                for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
                    own = ids[starts[a] : starts[b]]
                    doc_ids = some.column("doc_id").slice(a, b - a)
                    yield _chunk(part, chunk, written, doc_ids, np.diff(starts[a : b + 1]), own)
                    chunk, written = chunk + 1, written + len(own)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    order = ["doc_id", "tie"]
    rows = rows.withColumn("tie", F.xxhash64("text"))
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    rows.mapInArrow(run, FILE).write.parquet(path)


def _documents(batches):
    names = ["part", "doc_id", "place", "n_tokens", "ids_crc32"]
    for batch in batches:
        columns = [batch.column(c) for c in ("part", "first", "n_ids", "doc_ids", "counts", "offsets", "words")]
        for part, first, n_ids, doc_ids, counts, offsets, words in zip(*columns):
            counts = counts.values.to_numpy()
            packed = np.frombuffer(words.as_py(), dtype="<u8")
            ids = unpack(packed, offsets.values.to_numpy(), n_ids.as_py()).astype("<u4")
            ends = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])
            sums = [crc32(ids[a:b].tobytes()) for a, b in zip(ends[:-1], ends[1:])]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(counts), part.as_py(), dtype=np.int32)), doc_ids.values,
                    pa.array(first.as_py() + ends[:-1]), pa.array(counts.astype(np.int64)), pa.array(sums, pa.int64()),
                ],
                names,
            )


def read_token_file(spark: SparkSession, path: str) -> DataFrame:
    """Per document of the files: doc_id, start, n_tokens (with the end id), ids_crc32."""
    chunks = spark.read.schema(FILE).parquet(path)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = chunks.groupBy("part").agg(F.sum("n_ids").alias("n"))  # one row for each task that wrote
    starts = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0).cast("long")).alias("base"))
    found = chunks.mapInArrow(_documents, "part int, doc_id long, place long, n_tokens long, ids_crc32 long")
    found = found.join(F.broadcast(starts), "part")
    return found.select("doc_id", (F.col("base") + F.col("place")).alias("start"), "n_tokens", "ids_crc32")


def read_documents(spark: SparkSession, path: str, wanted: list[int]) -> DataFrame:
    """The ids (with the end id) of some documents: doc_id, ids.

    Only chunks that hold one of them leave the scan, and of a chunk only the blocks a document lies
    in are decoded. A doc_id that several rows have comes as often; one that no row has does not come.
    The list travels with the plan; for many documents read the whole file and join.
    """
    wanted = sorted(set(wanted))

    def run(batches):
        for batch in batches:
            columns = [batch.column(c) for c in ("n_ids", "doc_ids", "counts", "offsets", "words")]
            for n_ids, doc_ids, counts, offsets, words in zip(*columns):
                mine = np.flatnonzero(pc.is_in(doc_ids.values, pa.array(wanted, pa.int64())).to_numpy(zero_copy_only=False))
                ends = np.concatenate([[0], np.cumsum(counts.values.to_numpy(), dtype=np.int64)])
                packed, offsets = np.frombuffer(words.as_py(), dtype="<u8"), offsets.values.to_numpy()
                found = []
                for a, b in zip(ends[mine].tolist(), ends[mine + 1].tolist()):
                    first = a // BLOCK
                    own = unpack(packed, offsets, n_ids.as_py(), first, -(-b // BLOCK))
                    found.append(own[a - first * BLOCK : b - first * BLOCK].astype(np.int64))
                if found:
                    lists = pa.array(found, pa.list_(pa.int64()))
                    yield pa.RecordBatch.from_arrays([doc_ids.values.take(pa.array(mine)), lists], ["doc_id", "ids"])

    some = F.arrays_overlap("doc_ids", F.array(*[F.lit(n).cast("long") for n in wanted]).cast("array<bigint>"))
    rows = spark.read.schema(FILE).parquet(path).where(some)
    return rows.select("n_ids", "doc_ids", "counts", "offsets", "words").mapInArrow(run, "doc_id long, ids array<long>")
