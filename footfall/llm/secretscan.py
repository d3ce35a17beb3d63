"""Secrets in texts: fixed patterns, and sliding-window entropy over token-like strings.

Entropy method: a candidate is a maximal run of the token characters. A window slides over it;
character counts are kept up to date by the one character that enters and the one that leaves,
and so is the sum of n log n, from which the window's Shannon entropy follows. Windows above the
threshold of their character class are joined to spans. Strings that an allow list knows as
harmless, and spans inside a pattern's match, are suppressed.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from itertools import accumulate
from math import log2

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.llm.text import chunks, spans

KINDS = ["assign", "access", "hex", "entropy_hex", "entropy_token"]

# Fixed patterns and least lengths. Each can begin only where its first word or character stands.
ASSIGN = re.compile(
    r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII
)
LEAST_VALUE = 8
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
LEAST_ACCESS = 16
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{32,}")
ASSIGN_WORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")

#: Characters in a window; a shorter run has no window.
WINDOW = 20
#: Least entropy of a window, in bits per character, unless its class in CLASSES has its own. 20
#: random hex digits have 3.3 on average, 20 random letters and digits 4.0.
LEAST_BITS = {"entropy_hex": 3.0, "entropy_token": 3.65}

_CANDIDATE = np.zeros(256, dtype=bool)
_CANDIDATE[list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-.")] = True
_DIGIT = np.zeros(256, dtype=np.int64)
_DIGIT[48:58] = 1
_HEX_ONLY = re.compile(rb"[0-9a-f]+|[0-9A-F]+")
#: Character classes of a window, from narrow to wide, and the least entropy of each: about 98 % of
#: 20 random symbols of the class have more. Hex needs three letters, else it is a number.
CLASSES = [
    (re.compile(x), bits)
    for x, bits in [
        (rb"[a-z]+|[A-Z]+", 3.35),
        (rb"(?=(?:[0-9]*[a-fA-F]){3})[0-9a-fA-F]+", 3.1),
        (rb"[A-Za-z]+", 3.6),
        (rb"[A-Z2-7]+|[a-z2-7]+", 3.35),
        (rb"[A-Z0-9]+|[a-z0-9]+", 3.45),
        (rb"[A-Za-z0-9]+", 3.65),
    ]
]
#: Harmless strings: uuids, dates and times, versions and numbers; and what SEGMENT, split at
#: SEPARATORS, takes for words, each with a number of up to four digits.
ALLOWED = [
    rb"[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}",
    rb"[0-9]{4}-[0-9]{2}-[0-9]{2}([T_][0-9.+-]*)?",
    rb"[0-9.+=/_-]+",
]
_ALLOWED = re.compile(rb"|".join(b"(?:%s)" % x for x in ALLOWED))
SEPARATORS = re.compile(rb"[/._=-]+")
#: A word of one case, camel case of parts that look like words, or up to four letters. Of the parts, at
#: most one fits at any place, so that matching is linear.
SEGMENT = re.compile(
    rb"(?:[A-Z]?[a-z]*|[A-Z]+|[A-Za-z]{0,4}"
    rb"|[a-z]*(?:[A-Z]{2,5}(?![A-Za-z])|[A-Z]{2,4}(?=[A-Z][a-z]{2})|[A-Z][a-z]{2,}|[A-Z][aeiouy](?![a-z])"
    rb"|[AEIOUY][bcdfghjklmnpqrstvwxz](?![a-z]))+)[0-9]{0,4}"
)
#: What no word has: seven consonants or five vowels in a row, or a q without u.
NO_WORD = re.compile(rb"(?i:[bcdfghjklmnpqrstvwxz]{7}|[aeiouy]{5}|q(?=[a-tv-z]))")
_NLOGN = [0.0] + [n * log2(n) for n in range(1, WINDOW + 1)]


def harmless(run: bytes) -> bool:
    if _ALLOWED.fullmatch(run):
        return True
    parts = SEPARATORS.split(run)
    return all(map(SEGMENT.fullmatch, parts)) and not any(len(x) >= WINDOW and NO_WORD.search(x) for x in parts)


def _least_bits(window: bytes, kind: str) -> float:
    if kind == "entropy_hex":
        return LEAST_BITS[kind]
    return next((bits for x, bits in CLASSES if x.fullmatch(window)), LEAST_BITS[kind])


def high_entropy(run: bytes) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the joined windows of one candidate run that are too random for text."""
    if len(run) < WINDOW or harmless(run):
        return []
    kind = "entropy_hex" if _HEX_ONLY.fullmatch(run) else "entropy_token"
    # entropy = log2(window) - (sum of n log n) / window
    least = LEAST_BITS[kind] if kind == "entropy_hex" else min(LEAST_BITS[kind], *(bits for _, bits in CLASSES))
    most = (log2(WINDOW) - least) * WINDOW + 1e-9
    counts, load, found = [0] * 256, 0.0, []
    for at, entering in enumerate(run):
        start = at - WINDOW + 1
        if start > 0:
            leaving = run[start - 1]
            n = counts[leaving]
            load -= _NLOGN[n] - _NLOGN[n - 1]
            counts[leaving] = n - 1
        n = counts[entering]
        load += _NLOGN[n + 1] - _NLOGN[n]
        counts[entering] = n + 1
        if start >= 0 and load <= most and log2(WINDOW) - load / WINDOW >= _least_bits(run[start : at + 1], kind) - 1e-9:
            if found and start <= found[-1][1]:
                found[-1][1] = at + 1
            else:
                found.append([start, at + 1])
    return [(kind, start, end) for start, end in found if not harmless(run[start:end])]


def pattern_spans(text: str, lower: bytes) -> list[tuple[int, int, int]]:
    """(start, end, kind number) of the fixed patterns; ``lower`` is the text's lower-cased bytes."""
    found = []
    if any(word in lower for word in ASSIGN_WORDS):
        found += [(m.start(), m.end(), 0) for m in ASSIGN.finditer(text) if len(m[1]) >= LEAST_VALUE]
    if b"akia" in lower:
        found += [(m.start(), m.end(), 1) for m in ACCESS.finditer(text) if len(m[0]) >= LEAST_ACCESS]
    return found


def _long_runs(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Candidate runs that hold a window and not only digits."""
    starts, ends, text = spans(data, offsets, _CANDIDATE)
    long = ends - starts >= WINDOW
    starts, ends, text = starts[long], ends[long], text[long]
    digits = np.concatenate([[0], np.cumsum(_DIGIT[data])]) if len(starts) else np.zeros(len(data) + 1, np.int64)
    count = digits[ends] - digits[starts]
    mixed = count < ends - starts
    return starts[mixed], ends[mixed], text[mixed]


def _hex_runs(data: np.ndarray, offsets: np.ndarray) -> set[int]:
    """Texts with a run of 32 hex characters or more, found without looking at each text."""
    inside = np.zeros(256, dtype=bool)
    inside[48:58] = inside[97:103] = True
    starts, ends, text = spans(data, offsets, inside)
    return set(text[ends - starts >= 32].tolist())


def scan(column: pa.Array):
    """The sorted (start, end, kind number) of every text of the column, in code points."""
    for _, data, offsets in chunks(column):
        whole = data.tobytes()
        lowered = whole.lower()
        run_start, run_end, run_text = _long_runs(data, offsets)
        # Code points before each byte, where a chunk has others than ASCII.
        points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)]) if len(run_start) and (data >= 128).any() else None
        runs_at = np.searchsorted(run_text, np.arange(len(offsets)))
        with_hex = _hex_runs(data, offsets)
        for i, (at, end) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
            lower = lowered[at:end]
            mine = range(runs_at[i], runs_at[i + 1])
            if not mine and i not in with_hex and not any(w in lower for w in (*ASSIGN_WORDS, b"akia")):
                yield []
                continue
            raw = whole[at:end]
            text = raw.decode()
            found = pattern_spans(text, lower)
            if i in with_hex:
                found += [(m.start(), m.end(), 2) for m in HEX.finditer(text)]
            base = sorted((s, e) for s, e, _ in found)
            reach = list(accumulate((e for _, e in base), max))
            for run in mine:
                start, stop = int(run_start[run]) - at, int(run_end[run]) - at
                shift = start if points is None else int(points[start + at] - points[at])
                for kind, s, e in high_entropy(raw[start:stop]):
                    s, e = s + shift, e + shift
                    before = bisect_right(base, (s, len(text) + 1))
                    if not before or reach[before - 1] < e:
                        found.append((s, e, KINDS.index(kind)))
            yield sorted(found, key=lambda x: (x[0], x[2], x[1]))


def find_secrets(docs: DataFrame) -> DataFrame:
    """(doc_id, secrets) per row: start, end (code points, end exclusive) and kind of each span, by start.

    Null and empty texts have none. Rows are looked at one by one, so repeated rows get equal
    results. Other columns are ignored; an empty table gives no rows.
    """

    def find(batches):
        for batch in batches:
            found = list(scan(batch.column("text")))
            flat = [x for row in found for x in row]
            ends = np.cumsum([0] + [len(x) for x in found], dtype=np.int32)
            fields = [
                pa.array([x[0] for x in flat], pa.int32()), pa.array([x[1] for x in flat], pa.int32()),
                pa.array([KINDS[x[2]] for x in flat], pa.string()),
            ]
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays(fields, ["start", "end", "kind"]))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), lists], ["doc_id", "secrets"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(find, "doc_id long, secrets array<struct<start:int,end:int,kind:string>>")


def redacted(text: str, found: list[tuple[int, int, int]], marker: str) -> str:
    """``text`` with ``marker`` for every span; spans that overlap or touch are replaced as one."""
    parts, done = [], 0
    for i, (start, end, _) in enumerate(found):
        if not i or start > done:
            parts += [text[done:start], marker]
        done = max(done, end)
    return "".join([*parts, text[done:]])


def redact(docs: DataFrame, marker: str = "[secret]") -> DataFrame:
    """``docs`` with every secret replaced by ``marker``. All rows and all other columns stay.

    ``n_chars``, where there is one, follows the new length.
    """
    at = docs.columns.index("text")

    def replace(batches):
        for batch in batches:
            texts = batch.column(at).to_pylist()
            for i, found in enumerate(scan(batch.column(at))):
                if found:
                    texts[i] = redacted(texts[i], found, marker)
            yield batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))

    clean = docs.mapInArrow(replace, docs.schema)
    if "n_chars" not in docs.columns:
        return clean
    length = F.char_length("text").cast(docs.schema["n_chars"].dataType)
    return clean.withColumn("n_chars", F.when(F.col("n_chars").isNotNull(), F.coalesce(length, "n_chars")))


def digest(found: DataFrame) -> DataFrame:
    """The contract's columns of ``find_secrets``."""

    def joined(kinds):
        mine = F.filter("secrets", lambda x: x["kind"].isin(kinds))
        return F.array_join(F.transform(mine, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")

    def count(kind):
        return F.size(F.filter("secrets", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id", *(count(k) for k in KINDS[:3]), F.sha2(joined(KINDS[:3]), 256).alias("base_sha256"),
        joined(KINDS).alias("spans"),
    )
