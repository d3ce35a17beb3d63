"""Personal data: fixed patterns, and terms that reveal an entity by co-occurrence.

Protected entities are the values that the patterns find. A term (a word) co-occurs with every
entity of the same text, however far from it. Of N texts, n(c) hold entity c, n(t) term t and
n(c, t) both:

    IC(c)     = log2(N / n(c))                        information in the entity
    PMI(c; t) = log2(N * n(c, t) / (n(c) * n(t)))     information about it in the term

and the term's disclosure is PMI / IC: 1 when the term is in no other text. Terms above
GENERALISE are replaced by a general word, terms above REMOVE are removed, wherever they stand in
a text that holds the entity; a term needs LEAST_SUPPORT texts with the entity before it counts as
evidence. Entities in fewer texts are one entity per kind; as such a one is in many texts, its terms
also need n(c, t) * PMI bits, so many that chance would flag a term of it in about one of 2^CHANCE_BITS corpora.
All of it is built-in expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.llm.shared import written

KINDS = ["email", "ip", "card", "phone", "generalise", "remove"]

# Fixed patterns. Possessive quantifiers and the look-behinds change no match: they only keep
# the search linear in long runs of the same characters.
_LOCAL = "[A-Za-z0-9._%+-]"
PATTERNS = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[ -]?[0-9]){11,}+",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
#: What a text must hold to be searched for a kind at all.
HINTS = {
    "email": "@", "phone": r"\+",
    "ip": r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]", "card": r"[0-9](?:[ -]?[0-9]){11}",
}
LEAST_SUPPORT = 3
#: What stands for the value of all rare entities of a kind; no value is like it.
RARE = "*"
CHANCE_BITS = 10
#: Terms in more than one of so many texts are common. There are at most so many times the words of
#: a text on average, whatever the number of texts.
COMMON = 1000
GENERALISE, REMOVE = 0.9, 0.97
#: Words that stand for a generalised term and for values of each kind in sanitised texts.
MARKERS = {kind: f"[{kind}]" for kind in KINDS[:4]} | {"generalise": "[term]", "remove": ""}

_SPAN = "struct<start:int,end:int,value:string>"
#: Elements of a list that are worked through together. What has been found so far is copied once per
#: block, not once per element, so that a text with very many matches takes little longer per match.
_BLOCK = 256
_WORD = r"\p{L}{2,}+"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(value: Column) -> Column:
    digits = _digits(value)
    n = F.length(digits)

    def add(total, i):
        digit = F.substring(digits, n - i + 1, F.lit(1)).cast("int") * (1 + (i - 1) % 2)
        return total + F.when(digit > 9, digit - 9).otherwise(digit)

    total = F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add)
    return F.when(n.between(12, 19), total % 10 == 0).otherwise(False)


_CHECKS = {
    "email": lambda value: F.lit(True),
    "ip": lambda value: value.rlike(r"^0*(25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(\.0*(25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])){3}$"),
    "card": _luhn,
    "phone": lambda value: F.length(_digits(value)).between(9, 15),
}


def _in_blocks(rows: Column, empty: str, step) -> Column:
    """Works through a list from left to right; an array of what each of its blocks gave, with where it began.

    ``step(at, x)`` gives the place after an element, the element made of it, and whether that is kept.
    The result is array<struct<at:int, found:array<...>, end:int>>.
    """
    nothing = F.expr(f"cast(array() as array<{empty}>)")
    blocks = F.expr(f"cast(array() as array<struct<at:int,found:array<{empty}>,end:int>>)")

    def one(done, x):
        at, made, kept = step(done["at"], x)
        found = F.when(kept, F.concat(done["found"], F.array(made))).otherwise(done["found"])
        return F.struct(at.cast("int").alias("at"), found.alias("found"))

    def block(done, part):
        inner = F.aggregate(part, F.struct(done["at"].alias("at"), nothing.alias("found")), one)
        whole = F.transform(F.array(inner), lambda x: F.struct(done["at"].alias("at"), x["found"].alias("found"), x["at"].alias("end")))
        return F.transform(F.array(whole), lambda w: F.struct(w[0]["end"].alias("at"), F.concat(done["blocks"], w).alias("blocks")))[0]

    start = F.struct(F.lit(0).alias("at"), blocks.alias("blocks"))
    # The list is computed once: it is the lambda's own variable inside.
    def through(all_rows):
        starts = F.sequence(F.lit(0), F.greatest(F.lit(0), F.size(all_rows) - 1), F.lit(_BLOCK))
        parts = F.transform(starts, lambda i: F.slice(all_rows, i + 1, _BLOCK))
        return F.aggregate(parts, start, block, lambda done: done["blocks"])

    return F.transform(F.array(rows), through)[0]


def _located(text: Column, pattern: str, wanted=lambda value: F.lit(True)) -> Column:
    """The wanted matches with their places: the lengths of what splitting leaves between the
    matches, and of the matches themselves, give every place."""
    rest, matches = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    places = F.arrays_zip(F.transform(rest, F.length).alias("rest"), matches.alias("match"))

    def step(at, x):
        begin = at + x["rest"]
        end = begin + F.length(x["match"])
        span = F.struct(begin.alias("start"), end.alias("end"), x["match"].alias("value"))
        return F.coalesce(end, begin), span, x["match"].isNotNull() & wanted(x["match"])

    return F.flatten(F.transform(_in_blocks(places, _SPAN, step), lambda block: block["found"]))


def _spans(text: Column, kind: str) -> Column:
    found = F.filter(_located(text, PATTERNS[kind]), lambda x: _CHECKS[kind](x["value"]))
    return F.when(text.rlike(HINTS[kind]), found).otherwise(F.expr(f"cast(array() as array<{_SPAN}>)"))


def _numbered(kind: str) -> Column:
    number = F.lit(KINDS.index(kind)).alias("kind")
    return F.transform(kind, lambda x: F.struct(x["start"].alias("start"), number, x["end"].alias("end")))


def base_spans(docs: DataFrame, *more: str) -> DataFrame:
    """(doc_id, text_hash, email, ip, card, phone, *more): arrays of the spans of each kind, in order."""
    text = F.coalesce("text", F.lit(""))
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"),
        *(_spans(text, kind).alias(kind) for kind in PATTERNS), *more,
    )


def _words(text: Column) -> Column:
    """Each word of a text once."""
    return F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(_WORD), F.lit(0)), lambda x: F.lower(x)))


def entities(rows: DataFrame) -> DataFrame:
    """(row, entity, n_entity): what each text holds, and in how many texts it is.

    Entities that are in the same texts disclose and are disclosed alike, so they are one, named by
    hashes of their texts; rare ones are one per kind.
    """
    def named(kind: str) -> Column:
        return F.transform(kind, lambda x: F.concat_ws(":", F.lit(kind), F.lower(x["value"])))

    held = rows.where("text IS NOT NULL").select("row", F.explode(F.array_distinct(F.concat(*map(named, PATTERNS)))).alias("entity"))
    mark = F.xxhash64("row")
    texts = F.concat_ws(":", F.lit("in"), F.count("*"), F.bit_xor(mark), F.bit_xor(F.xxhash64(mark, F.lit(1))))
    counts = held.groupBy("entity").agg(F.count("*").alias("n_entity"), texts.alias("texts"))
    held = held.join(counts, "entity").select("row", "entity", "n_entity", "texts")
    # The rare entities of a kind are one, and a text holds it once.
    is_rare = F.col("n_entity") < LEAST_SUPPORT
    kind = F.concat_ws(":", F.substring_index("entity", ":", 1), F.lit(RARE))
    rare = written(held.where(is_rare).select("row", kind.alias("entity")).distinct(), "rare")
    counts = F.broadcast(rare.groupBy("entity").agg(F.count("*").alias("n_entity")))  # one row for each kind
    often = held.where(~is_rare).select("row", F.col("texts").alias("entity"), "n_entity").distinct()
    return often.union(rare.join(counts, "entity").select("row", "entity", "n_entity"))


def term_counts(docs: DataFrame) -> DataFrame:
    """(term, n_term) of every word in the corpus: its texts, counted within tasks before the shuffle."""
    return docs.select(F.explode(_words(F.col("text"))).alias("term")).groupBy("term").agg(F.count("*").alias("n_term"))


def disclosing_terms(rows: DataFrame, held: DataFrame, uses: DataFrame, total: int) -> DataFrame:
    """(entity, term, kind) of the pairs whose disclosure exceeds a threshold; ``total`` texts."""
    mine = held.groupBy("row").agg(F.collect_list(F.struct("entity", "n_entity")).alias("held"))
    terms = rows.where("text IS NOT NULL").select("row", _words(F.col("text")).alias("words")).join(mine, "row")
    terms = terms.select("held", F.explode("words").alias("term"))
    # As n(c, t) <= n(c), a term in more texts than this stays below the thresholds for the entity.
    # Common words are most of a text: they are left out before they meet its entities.
    common = written(uses.where(F.col("n_term") * COMMON > total).withColumnRenamed("n_term", "n_common"), "common")

    def possible(x):
        most = x["n_entity"] * F.pow(F.lit(float(total)) / x["n_entity"], F.lit(1 - GENERALISE)) * 1.001
        return F.col("n_common").isNull() | (F.col("n_common") <= most)

    # A written table: its size on disk decides between broadcast and shuffle.
    terms = terms.join(common, "term", "left")
    pairs = terms.select("term", F.inline(F.filter("held", possible)))
    pairs = pairs.groupBy("entity", "n_entity", "term").agg(F.count("*").alias("n_pair"))
    scored = pairs.where(f"n_pair >= {LEAST_SUPPORT}").join(uses, "term")
    information = F.log2(F.lit(float(total)) / F.col("n_entity"))
    shared = F.log2(F.lit(float(total)) * F.col("n_pair") / (F.col("n_entity") * F.col("n_term")))
    disclosure = F.when(information > 0, shared / information).otherwise(F.lit(0.0))
    kind = F.when(disclosure > REMOVE, "remove").when(disclosure > GENERALISE, "generalise")
    chance = F.log2(F.greatest(F.lit(1), F.lit(uses.count()))) + CHANCE_BITS
    sure = ~F.endswith("entity", F.lit(":" + RARE)) | (F.col("n_pair") * shared >= chance)
    return scored.where(sure).select("entity", "term", kind.alias("kind")).where("kind IS NOT NULL")


def find_personal(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, base, spans) per row: spans of (start, kind number, end), sorted.

    ``base`` has the patterns' spans; ``spans`` has these and the terms that reveal an entity of
    the same text, where they overlap no base span. Null and empty texts have none. Repeated rows
    get equal results, and each counts in the corpus. Other columns are ignored; no rows give no rows.
    """
    found = base_spans(docs, "text").withColumn("row", F.monotonically_increasing_id())
    holds = F.greatest(*(F.size(kind) for kind in PATTERNS)) > 0
    rows = written(found.withColumn("text", F.when(holds, F.col("text"))), "personal")
    held = written(entities(rows), "entities")
    flagged = written(disclosing_terms(rows, held, written(term_counts(docs), "uses"), rows.count()), "flagged")
    # From the rows that hold a flagged term to those that also hold its entity.
    places = rows.where("text IS NOT NULL").select("row", F.explode(_words(F.col("text"))).alias("term"))
    revealing = places.join(flagged, "term").join(held.select("row", "entity"), ["row", "entity"])
    number = F.when(F.col("kind") == "generalise", KINDS.index("generalise")).otherwise(KINDS.index("remove"))
    revealing = revealing.groupBy("row", "term").agg(F.max(number).alias("number"))
    revealing = revealing.groupBy("row").agg(F.map_from_entries(F.collect_list(F.struct("term", "number"))).alias("terms"))
    base = F.sort_array(F.concat(*(_numbered(kind) for kind in PATTERNS))).alias("base")
    joined = rows.select("row", "doc_id", "text_hash", "text", base).join(revealing, "row", "left")
    revealed = _located(F.col("text"), _WORD, lambda value: F.map_contains_key("terms", F.lower(value)))
    more = F.transform(
        revealed, lambda x: F.struct(x["start"].alias("start"), F.col("terms")[F.lower(x["value"])].alias("kind"), x["end"].alias("end"))
    )
    joined = joined.withColumn("more", F.when(F.col("terms").isNotNull(), more))
    free = F.filter(
        F.coalesce("more", F.slice("base", 1, 0)),
        lambda x: ~F.exists("base", lambda b: (x["start"] < b["end"]) & (b["start"] < x["end"])),
    )
    return joined.select("doc_id", "text_hash", "base", F.sort_array(F.concat("base", free)).alias("spans"))


def sanitise(docs: DataFrame) -> DataFrame:
    """``docs`` with entities replaced by their kind, and revealing terms generalised or removed.

    All rows and all other columns stay. Of spans that overlap, the first is replaced and the
    others only lose what reaches beyond it.
    """
    found = find_personal(docs).where("size(spans) > 0").select("doc_id", "text_hash", "spans").distinct()
    found = written(found, "spans")
    text = docs["text"]
    same = docs["doc_id"].eqNullSafe(found["doc_id"]) & (F.xxhash64(text) == found["text_hash"])
    joined = docs.join(found, same, "left")
    markers = F.array(*(F.lit(MARKERS[k]) for k in KINDS))

    def step(at, x):
        gap = F.struct(at.alias("start"), F.greatest(x["start"], at).alias("end"), F.when(x["start"] >= at, F.get(markers, x["kind"])).otherwise("").alias("value"))
        return F.greatest(at, x["end"]), gap, F.lit(True)

    def cleaned(block):
        # The block's own piece of the text, so that no gap is looked for from the text's beginning.
        piece = F.substring(text, block["at"] + 1, block["end"] - block["at"])
        gaps = F.transform(
            F.array(piece),
            lambda own: F.array_join(
                F.transform(block["found"], lambda x: F.concat(F.substring(own, x["start"] - block["at"] + 1, x["end"] - x["start"]), x["value"])), ""
            ),
        )
        return gaps[0]

    pieces = F.transform(
        F.array(_in_blocks(found["spans"], _SPAN, step)),
        lambda blocks: F.concat(F.array_join(F.transform(blocks, cleaned), ""), F.substring(text, F.element_at(blocks, -1)["end"] + 1, F.length(text))),
    )
    clean = F.when(found["spans"].isNotNull(), pieces[0])
    return joined.select(*(F.coalesce(clean, text).alias("text") if c == "text" else docs[c] for c in docs.columns))


def digest(found: DataFrame) -> DataFrame:
    """The contract's columns of ``find_personal``."""
    names = F.array(*map(F.lit, KINDS))

    def joined(spans):
        return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.get(names, x["kind"]), x["start"], x["end"])), ",")

    def count(n, kind):
        return F.size(F.filter("base", lambda x: x["kind"] == n)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id", *(count(n, kind) for n, kind in enumerate(PATTERNS)),
        F.sha2(joined("base"), 256).alias("base_sha256"), joined("spans").alias("spans"),
    )
