"""BPE encoding and decoding by a vocabulary file, with our own merge loop.

A word's symbols form a doubly linked list; a heap holds the possible merges by rank and place.
A popped merge whose symbols have changed since is stale and skipped. Decoding concatenates the
vocabulary strings of the ids, joined by one space, which is what a file without a decoder asks for.
Letters and numbers are those of the installed ``regex`` package; characters that Unicode 15.1 does
not know may be split otherwise by other libraries.
"""

from __future__ import annotations

import json
import unicodedata
from heapq import heapify, heappop, heappush

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

#: Words whose ids a worker keeps in each of two generations; a full one becomes the older.
KEPT_WORDS = 200_000


def byte_letters() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary.

    Printable bytes stand for themselves, the others for the code points from 256 on.
    """
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b if b in own else next(others)) for b in range(256)]


class Bpe:
    """A tokenizer of one vocabulary file (text of its JSON)."""

    def __init__(self, vocabulary: str):
        spec = json.loads(vocabulary)
        model = spec["model"]
        self.suffix = model["end_of_word_suffix"] or ""
        self.ids: dict[str, int] = model["vocab"]
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.strings = [""] * (max([*self.ids.values(), *self.specials.values()]) + 1)
        for string, number in [*self.ids.items(), *self.specials.items()]:
            self.strings[number] = string
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            self.merges[self.ids[left], self.ids[right]] = (rank, self.ids[left + right])
        letters = byte_letters()
        self.inner = [self.ids.get(c) for c in letters]
        self.last = [self.ids.get(c + self.suffix) for c in letters]
        split = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.pieces = regex.compile(split).findall
        self.special_split = regex.compile("(" + "|".join(map(regex.escape, self.specials)) + ")").split
        self.young: dict[str, list[int]] = {}
        self.old: dict[str, list[int]] = {}

    def piece(self, piece: str) -> list[int]:
        """Ids of one piece of normalised text."""
        raw = piece.encode()
        symbols = [self.inner[b] for b in raw[:-1]] + [self.last[raw[-1]]]
        n = len(symbols)
        if n == 1:
            return symbols
        merges = self.merges
        heap = []
        for i in range(n - 1):
            merge = merges.get((symbols[i], symbols[i + 1]))
            if merge:
                heap.append((merge[0], i, merge[1], symbols[i], symbols[i + 1]))
        if not heap:
            return symbols
        heapify(heap)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        while heap:
            _, i, new, left, right = heappop(heap)
            j = after[i]
            if symbols[i] != left or j >= n or symbols[j] != right:
                continue  # stale
            symbols[i], symbols[j] = new, -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                merge = merges.get((new, symbols[k]))
                if merge:
                    heappush(heap, (merge[0], i, merge[1], new, symbols[k]))
            h = before[i]
            if h >= 0:
                merge = merges.get((symbols[h], new))
                if merge:
                    heappush(heap, (merge[0], h, merge[1], symbols[h], new))
        return [s for s in symbols if s >= 0]

    def word(self, word: str) -> list[int]:
        """Ids of a normalised word: text without white space."""
        known = self.old.get(word)
        if known is None:
            pieces = self.pieces(word)
            if len(pieces) == 1:
                known = self.piece(pieces[0])
            else:
                known = [x for piece in pieces for x in self.young.get(piece) or self.old.get(piece) or self.piece(piece)]
        if len(word) < 32:
            if len(self.young) >= KEPT_WORDS:
                self.old, self.young = self.young, {}
            self.young[word] = known
        return known

    def normalised(self, text: str) -> str:
        """Composed and lower-cased, each character by itself (no final sigma)."""
        if text.isascii():
            return text.lower()
        return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()

    def encode(self, text: str) -> list[int]:
        """Ids of a whole text; strings of special tokens give their ids."""
        if "<|" in text and len(parts := self.special_split(text)) > 1:
            ids = []
            for part in parts:
                ids += [self.specials[part]] if part in self.specials else self.encode(part)
            return ids
        ids = []
        # Python also splits at the separators 1C to 1F, which the pattern takes as characters.
        plain = not any(c in text for c in "\x1c\x1d\x1e\x1f")
        for word in self.normalised(text).split() if plain else [self.normalised(text)]:
            ids += self.young.get(word) or self.word(word)
        return ids

    def decode(self, ids: list[int]) -> str:
        """The vocabulary strings of the ids, joined by one space."""
        return " ".join(map(self.strings.__getitem__, ids))


_loaded: dict[int, Bpe] = {}


def encode_and_decode(docs: DataFrame, vocabulary_file: str, keep: list[str], digest: bool = False) -> DataFrame:
    """The columns ``keep`` of ``docs`` (without text) with the ids of each whole text and their decoding.

    Adds n_tokens, token_ids and decoded; with ``digest``, instead of the last two, the SHA-256 of
    the decimal ids joined by one space and of the decoded text. A null or empty text has no ids and
    decodes to an empty text. Repeated rows get equal results; no rows give no rows.

    The vocabulary file is read by the driver and broadcast: its size is fixed.
    """
    with open(vocabulary_file, encoding="utf-8") as file:
        vocabulary = docs.sparkSession.sparkContext.broadcast(file.read())
    names = ["ids_sha256", "decoded_sha256"] if digest else ["token_ids", "decoded"]

    def run(batches):
        from hashlib import sha256

        key = hash(vocabulary.value)
        if key not in _loaded:
            _loaded.clear()
            _loaded[key] = Bpe(vocabulary.value)
        bpe = _loaded[key]
        decimals = list(map(str, range(len(bpe.strings))))
        for batch in batches:
            # Slices bound the memory that the results of a batch of long texts take.
            for at in range(0, max(batch.num_rows, 1), 256):
                part = batch.slice(at, 256)
                counts, first, second = [], [], []
                for text in part.column("text"):
                    ids = bpe.encode(text.as_py() or "")
                    decoded = bpe.decode(ids)
                    counts.append(len(ids))
                    if digest:
                        first.append(sha256(" ".join(map(decimals.__getitem__, ids)).encode()).hexdigest())
                        second.append(sha256(decoded.encode()).hexdigest())
                    else:
                        first.append(pa.array(ids, pa.int32()))
                        second.append(decoded)
                if not digest:
                    ends = pa.array([0, *counts], pa.int32()).to_numpy().cumsum(dtype="int32")
                    flat = pa.concat_arrays([pa.array([], pa.int32()), *first])
                    first = pa.ListArray.from_arrays(pa.array(ends), flat)
                else:
                    first = pa.array(first, pa.string())
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in keep), pa.array(counts, pa.int64()), first, pa.array(second, pa.string())],
                    [*keep, "n_tokens", *names],
                )

    rows = docs.select(*keep, "text")
    schema = rows.select(*keep).schema.add("n_tokens", "long")
    schema = schema.add(names[0], T.StringType() if digest else T.ArrayType(T.IntegerType())).add(names[1], "string")
    return rows.mapInArrow(run, schema)
