import random
import re
import time
from collections import Counter
from math import log2

import edge
import pytest

from footfall.llm import personal as p

PLAIN = [
    re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    re.compile(r"[0-9]([\x20-]?[0-9])+"), re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
]


def digits(text):
    return re.sub("[^0-9]", "", text)


def luhn(text):
    total = 0
    for i, c in enumerate(reversed(text)):
        double = int(c) * (1 + i % 2)
        total += double - 9 if double > 9 else double
    return total % 10 == 0


CHECKS = [
    lambda v: True, lambda v: all(int(x) <= 255 for x in v.split(".")),
    lambda v: 12 <= len(digits(v)) <= 19 and luhn(digits(v)), lambda v: 9 <= len(digits(v)) <= 15,
]


def brute(text):
    found = [(m.start(), k, m.end()) for k in range(4) for m in PLAIN[k].finditer(text or "") if CHECKS[k](m[0])]
    return sorted(found)


CASES = [
    "é a@b.c@d.e a@b.c_x@d.e x@y x@y. @z.w a..b@c-d.e-f.g 😀 u%+-@h.i", "1.2.3.4.5.6.7.8 300.1.2.3.4 0255.1.1.1 256.1.1.1 1.2.3",
    "4111 1111 1111 1111 and 4111-1111-1111-1112 then 5500 0000 0000 0004.", "4111  1111 1111 1111 411111111111111111111111",
    "+1 (436) 555-6159 +12+3456789012 +1234567890123456 +49.30.123456) + 1234567890 ++1234567890", "378282246310005",
    "ip 10.0.0.1 mail a.b@c.de +1 (436) 555-6159 4111111111111111 10.0.0.1", "", None,
]


def test_patterns_equal_plain_search(spark):
    rows = p.find_personal(edge.texts(spark, *CASES)).orderBy("doc_id").collect()
    for row, text in zip(rows, CASES, strict=True):
        assert [tuple(x) for x in row.base] == brute(text)
        assert [tuple(x) for x in row.spans if x.kind < 4] == brute(text)


TEXTS = ["Call agent Zorblax at +1 (436) 555-6159 now"] * 4 + ["the agent will call now and at noon"] * 200 + ["Zorblaxian"]


def brute_spans(texts):
    """The spans of every text by the formulas of the module, text by text and pair by pair."""
    words = [{w.lower() for w in re.findall(r"[^\W\d_]{2,}", t)} for t in texts]
    uses = Counter(w for own in words for w in own)
    base = [sorted(brute(t)) for t in texts]
    held = [{f"{p.KINDS[kind]}:{t[start:end].lower()}" for start, kind, end in own} for t, own in zip(texts, base)]
    often = Counter(c for own in held for c in own)
    held = [{c if often[c] >= p.LEAST_SUPPORT else c.split(":")[0] + ":*" for c in own} for own in held]
    often = Counter(c for own in held for c in own)
    pairs = Counter((c, w) for own, some in zip(held, words) for c in own for w in some)
    total, flagged = len(texts), {}
    for (c, w), n in pairs.items():
        information, shared = log2(total / often[c]), log2(total * n / (often[c] * uses[w]))
        ratio = shared / information if information > 0 else 0
        sure = not c.endswith(":*") or n * shared >= log2(max(1, len(uses))) + p.CHANCE_BITS
        if n >= p.LEAST_SUPPORT and sure and ratio > p.GENERALISE:
            flagged[c, w] = 5 if ratio > p.REMOVE else 4
    rows = []
    for t, own, entities in zip(texts, base, held):
        more = []
        for m in re.finditer(r"[^\W\d_]{2,}", t):
            kind = max((flagged.get((c, m[0].lower()), 0) for c in entities), default=0)
            if kind and not any(m.start() < end and start < m.end() for start, _, end in own):
                more.append((m.start(), kind, m.end()))
        rows.append(",".join(f"{p.KINDS[k]}:{a}:{b}" for a, k, b in sorted(own + more)))
    return rows


def spans_of(spark, texts):
    return [r.spans for r in p.digest(p.find_personal(edge.texts(spark, *texts))).orderBy("doc_id").collect()]


def test_revealing_terms(spark):
    docs = edge.texts(spark, *TEXTS)
    want = brute_spans(TEXTS)
    assert want[:4] == ["remove:11:18,phone:22:39"] * 4 and not any(want[4:])
    assert spans_of(spark, TEXTS) == want
    clean = [r.text for r in p.sanitise(docs).orderBy("doc_id").collect()]
    assert clean == ["Call agent  at [phone] now"] * 4 + TEXTS[4:]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_terms_of_random_corpora_equal_brute_force(spark, seed):
    rng = random.Random(seed)
    common = ["agent", "noon", "call", "the", "and", "now"]
    people = [(f"name{'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10]}", rng.choice([f"p{i}@x.org", f"+1 (436) 555-6{100 + i}", f"10.0.0.{i}"])) for i in range(30)]
    texts = []
    for i in range(400):
        own = rng.choices(common, k=rng.randint(0, 8))
        if i % 3 == 0:
            name, value = rng.choice(people[: rng.choice([4, 12, 30])])
            own += [name] * (rng.random() < 0.95) + [value] + ([rng.choice(people)[0]] if rng.random() < 0.1 else [])
            own += [rng.choice(people)[1]] * (rng.random() < 0.2)
        rng.shuffle(own)
        texts.append(" ".join(own))
    want = brute_spans(texts)
    assert sum("remove" in x or "generalise" in x for x in want) > 5
    assert spans_of(spark, texts) == want


def test_a_long_text_of_entities_is_linear(spark):
    """1 MB of addresses, and three texts in which thousands of them meet thousands of words."""
    rng = random.Random(4)
    number = lambda: f"{rng.randrange(256)}.{rng.randrange(256)}.{rng.randrange(256)}.{rng.randrange(256)}"
    text = " ".join(number() for _ in range(70_000))
    docs = edge.texts(spark, text).coalesce(1)
    start = time.time()
    (row,) = p.base_spans(docs).collect()
    assert len(row.ip) == 70_000 and all(text[x.start : x.end] == x.value for x in row.ip[::1000] + row.ip[-1:])
    assert time.time() - start < 60
    word = lambda i: "w" + "".join("abcdefghij"[int(c)] for c in str(i))
    three = [" ".join(f"{word(i)} 10.{i // 200}.{i % 200}.7" for i in range(3000))] * 3 + ["and now"] * 50
    start = time.time()
    clean = [r.text for r in p.sanitise(edge.texts(spark, *three)).orderBy("doc_id").collect()]
    assert clean[0] == " ".join([" [ip]"] * 3000) and clean[3:] == three[3:]
    assert time.time() - start < 120


def test_terms_reveal_entities_far_away(spark):
    far = "the agent will call now and at noon " * 5
    texts = [f"Zorblax! {far}+1 (436) 555-6159 {far}Zorblax"] * 4 + [far, "Zorblaxian at noon"] * 100
    rows = p.digest(p.find_personal(edge.texts(spark, *texts))).orderBy("doc_id").collect()
    last = texts[0].rindex("Zorblax")
    assert [r.spans for r in rows[:4]] == [f"remove:0:7,phone:189:206,remove:{last}:{last + 7}"] * 4
    assert all(r.spans == "" for r in rows[4:])
    clean = [r.text for r in p.sanitise(edge.texts(spark, *texts)).collect()]
    assert not any(re.search(r"Zorblax\b", text) for text in clean)


def test_terms_reveal_rare_entities(spark):
    texts = [f"Call Zorblax at +1 (436) 555-61{i} now" for i in range(50, 56)]
    texts += ["call now and at noon"] * 200 + ["only here +1 (436) 555-7000 at noon"]
    rows = p.digest(p.find_personal(edge.texts(spark, *texts))).orderBy("doc_id").collect()
    assert [r.spans for r in rows[:6]] == ["remove:5:12,phone:16:33"] * 6
    assert rows[-1].spans == "phone:10:27" and all(r.spans == "" for r in rows[6:-1])


def test_edges(spark):
    docs = edge.documents(spark)
    rows = p.digest(p.find_personal(docs)).collect()
    assert len(rows) == len(edge.ROWS)
    assert all(r.n_email + r.n_ip + r.n_card + r.n_phone == 0 for r in rows)
    assert p.digest(p.find_personal(edge.empty(spark))).collect() == []
    clean = p.sanitise(docs)
    assert clean.columns == docs.columns
    assert sorted(map(repr, clean.collect())) == sorted(map(repr, docs.collect()))


def test_long_runs_stay_linear(spark):
    texts = ["a" * 300_000, "1." * 100_000, "+1" + "(" * 200_000, "x@" * 50_000, "7" * 300_000, "a.b-" * 60_000 + "@c.d"]
    rows = p.find_personal(edge.texts(spark, *texts)).orderBy("doc_id").collect()
    assert [len(r.base) for r in rows] == [0, 25_000, 0, 0, 0, 1]


def test_no_python_on_the_main_path(spark):
    plan = p.find_personal(edge.texts(spark, *CASES))._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
