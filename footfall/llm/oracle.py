"""SQL for the operators that SQL can express."""

from __future__ import annotations

from footfall.llm import centroids as c
from footfall.llm import spelling as sp
from footfall.llm.decontaminate import SHARE, WINDOW
from footfall.llm.neardup import PERCENT, SHINGLE
from footfall.llm.sharding import SHARDS, TABLE_SIZE, shard_names

#: ``text`` with A-Z in lower case and nothing else changed.
LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def words(pattern: str) -> str:
    """The words of ``text``, as a list."""
    return f"regexp_extract_all({LOWERED}, '{pattern}')"


def contamination() -> str:
    """Windows of items and texts as strings, joined; hit words are counted one by one."""
    own = words(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    return f"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, {own} AS w FROM documents),
i AS (SELECT item_id, {own} AS w FROM benchmark),
iw AS (SELECT DISTINCT item_id, n, array_to_string(list_slice(w, s, s + n - 1), ' ') AS k FROM (
  SELECT item_id, w, least(len(w), {WINDOW}) AS n, unnest(range(1, len(w) - least(len(w), {WINDOW}) + 2)) AS s
  FROM i WHERE len(w) > 0)),
dw AS (SELECT r, n, s, array_to_string(list_slice(w, s, s + n - 1), ' ') AS k FROM (
  SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d, (SELECT DISTINCT n FROM iw) WHERE len(w) >= n)),
met AS (SELECT r, s, n, item_id FROM dw JOIN iw USING (n, k)),
hit AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(s, s + n)) AS p FROM met) GROUP BY r),
items AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item FROM met WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND {SHARE} * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN items USING (r)"""


def placement() -> str:
    """The look-up table filled one claim at a time, by a recursive query."""
    n, size = SHARDS, TABLE_SIZE
    names = ", ".join(f"'{name}'" for name in shard_names(n))

    def number(text: str) -> str:
        return f"CAST('0x' || substr(md5({text}), 1, 15) AS BIGINT)"

    return f"""WITH RECURSIVE p AS (SELECT
  list_transform([{names}], lambda x: {number("x || '#start'")} % {size}) AS starts,
  list_transform([{names}], lambda x: {number("x || '#step'")} % ({size} - 1) + 1) AS steps),
fill AS (SELECT 0 AS turn, -1 AS slot, list_transform(range({size}), lambda x: -1) AS owners
  UNION ALL SELECT turn + 1, slot, list_transform(owners, lambda o, k: CASE WHEN k = slot + 1 THEN turn % {n} ELSE o END)
  FROM (SELECT turn, owners, list_filter(list_transform(range({size}),
    lambda j: (starts[turn % {n} + 1] + j * steps[turn % {n} + 1]) % {size}),
    lambda c: owners[c + 1] < 0)[1] AS slot FROM fill, p WHERE turn < {size})),
owner AS (SELECT unnest(range({size})) AS slot, unnest(owners) AS shard FROM fill WHERE turn = {size})
SELECT doc_id, CAST(d.slot AS INTEGER) AS slot, CAST(shard AS INTEGER) AS shard
FROM (SELECT doc_id, {number("coalesce(CAST(doc_id AS VARCHAR), '')")} % {size} AS slot FROM documents) d
JOIN owner USING (slot)"""


def near_duplicates() -> str:
    """All pairs of documents that share a shingle, and what can be reached from each."""
    own = words(r"[^\x20\x09-\x0D]+")
    return f"""WITH RECURSIVE d AS (SELECT doc_id, {own} AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {SHINGLE} THEN [array_to_string(w, ' ')]
  ELSE list_distinct(list_transform(range(1, len(w) - {SHINGLE} + 2),
    lambda i: array_to_string(list_slice(w, i, i + {SHINGLE} - 1), ' '))) END AS shingles FROM d),
x AS (SELECT doc_id, len(shingles) AS n, unnest(shingles) AS shingle FROM s),
links AS (SELECT a.doc_id AS one, b.doc_id AS two FROM x a JOIN x b USING (shingle) WHERE a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= {PERCENT} * (a.n + b.n - count(*))),
reached AS (SELECT doc_id, doc_id AS other FROM s
  UNION SELECT r.doc_id, two FROM reached r JOIN links ON r.other = one),
least AS (SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id)
SELECT doc_id, CAST(len(shingles) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept
FROM s JOIN least USING (doc_id)"""


def clustering() -> str:
    """The rounds written out one after another, each distance summed component by component."""
    points = f"""p AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding,
  lambda x: CAST(floor(greatest(least({c.SCALE} * CAST(x AS DOUBLE), {c.LARGEST}), -{c.LARGEST})) AS BIGINT)) AS v
  FROM embeddings WHERE len(embedding) = {c.DIMENSIONS} AND
  len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY draw, v) - 1 AS c, v FROM (
  SELECT sha256('{c.SEED}:' || vec_id) AS draw, v FROM p WHERE vec_id IS NOT NULL ORDER BY draw, v LIMIT {c.CLUSTERS}))"""
    parts = [points]
    for i in range(c.ROUNDS + 1):
        parts.append(f"""a{i} AS MATERIALIZED (SELECT r, min({{'d': d, 'c': c}}) AS m FROM (SELECT r, c, list_sum(
  list_transform(list_zip(p.v, c{i}.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d FROM p, c{i}) GROUP BY r)""")
        if i < c.ROUNDS:
            parts.append(f"""s{i} AS MATERIALIZED (SELECT c, i, sum(x) AS s, count(*) AS n FROM (
  SELECT m.c AS c, unnest(range(1, {c.DIMENSIONS + 1})) AS i, unnest(v) AS x FROM a{i} JOIN p USING (r)) GROUP BY c, i),
c{i + 1} AS MATERIALIZED (SELECT c{i}.c, coalesce(w, v) AS v FROM c{i} LEFT JOIN (
  SELECT c, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS w FROM s{i} GROUP BY c) t ON c{i}.c = t.c)""")
    last = c.ROUNDS
    return f"""WITH {", ".join(parts)}
SELECT vec_id, CAST(m.c AS INTEGER) AS cluster, CAST(m.d AS BIGINT) AS distance,
  CAST(sum(m.d) OVER (PARTITION BY m.c) AS BIGINT) AS cluster_inertia, CAST(sum(m.d) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string(c{last}.v, ',')) AS centroid_sha256
FROM a{last} JOIN p USING (r) JOIN c{last} ON c{last}.c = m.c"""


def spelling() -> str:
    """Hashes byte by byte, near words by joining what is left when one letter goes, roots by recursion."""
    return f"""WITH RECURSIVE crc AS (SELECT list_transform(range(256), lambda b: list_reduce(range(8),
  lambda s, i: xor(s >> 1, CASE WHEN s & 1 = 1 THEN 3988292384 ELSE 0 END), b)) AS t),
runs AS (SELECT p, run, count(*) AS n FROM (SELECT coalesce(CAST(doc_id AS VARCHAR), '') || ':' AS p,
  unnest(regexp_extract_all({LOWERED}, '[a-z\u00C0-\u00FF]+')) AS run FROM documents)
  WHERE len(run) >= {sp.LEAST_LENGTH} GROUP BY p, run),
hashed AS (SELECT run, n, xor(4294967295, list_reduce(list_prepend(4294967295, flatten(list_transform(string_split(p || run, ''),
  lambda x: CASE WHEN unicode(x) < 128 THEN [unicode(x)] ELSE [195, unicode(x) - 64] END))),
  lambda s, b: xor(t[(xor(s, b) & 255) + 1], s >> 8))) AS h FROM runs, crc),
w AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (SELECT n, CASE WHEN h % {sp.MISSPELL} = 0
  THEN substr(run, 1, h % len(run)) || substr(run, h % len(run) + 2) ELSE run END AS word FROM hashed)
  WHERE len(word) >= {sp.LEAST_LENGTH} GROUP BY word HAVING sum(n) >= {sp.LEAST_COUNT}),
gone AS (SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM (
  SELECT word, unnest(range(1, len(word) + 1)) AS i FROM w)),
near AS (SELECT a.word, b.word AS other FROM gone a JOIN gone b USING (i, rest) WHERE a.word <> b.word
  UNION SELECT word, rest FROM gone WHERE rest IN (SELECT word FROM w)
  UNION SELECT rest, word FROM gone WHERE rest IN (SELECT word FROM w)),
first AS (SELECT near.word, count(*) AS n_near, min({{'n': -w.n, 'form': other}}) AS f FROM near JOIN w ON w.word = other GROUP BY near.word),
found AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN -f.n >= {sp.RATIO} * w.n THEN f.form END AS form,
  CASE WHEN -f.n >= {sp.RATIO} * w.n THEN -f.n END AS form_n FROM w LEFT JOIN first USING (word)),
chain AS (SELECT word, word AS root FROM found
  UNION ALL SELECT chain.word, found.form FROM chain JOIN found ON chain.root = found.word WHERE found.form IS NOT NULL)
SELECT found.word, found.form, chain.root, found.n, found.n_near, CAST(found.form_n AS BIGINT) AS form_n
FROM found JOIN chain ON chain.word = found.word JOIN found e ON e.word = chain.root AND e.form IS NULL"""


def oracle_sql() -> dict[str, str]:
    """SQL per query. The others train models, merge tokens, add spans from corpus statistics or
    entropy, or search approximately; tests hold them against brute force, libraries and held-out rows."""
    return {
        "op2_decontaminate": contamination(),
        "op5_sharding": placement(),
        "op9_neardup": near_duplicates(),
        "op11_centroids": clustering(),
        "op13_spelling": spelling(),
    }
