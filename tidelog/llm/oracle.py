"""The same results in DuckDB SQL, where it can express them."""

from __future__ import annotations

from .licenses import DICE, RESERVED, TEMPLATES
from .rules import STOP_WORDS

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _bigrams(words: str) -> str:
    return f"list_distinct(list_transform(range(1, len({words})), lambda i: {words}[i] || ' ' || {words}[i + 1]))"


_NORMAL = "string_split(trim(regexp_replace(lower(unit), '[^a-z0-9]+', ' ', 'g')), ' ')"

_LICENSE = f"""
WITH templates AS (
  SELECT *, {_bigrams('w')} AS t FROM (
    SELECT *, {_NORMAL} AS w FROM (VALUES {', '.join(f"({i}, {_quoted(n)}, {'null' if p is None else str(p).lower()}, {_quoted(t)})" for i, (n, p, t) in enumerate((*TEMPLATES, RESERVED)))}) v(number, name, free, unit))),
units AS (
  SELECT doc_id, text AS unit, 0 AS place FROM documents WHERE contains(text, chr(10))
  UNION ALL
  SELECT doc_id, unnest(string_split(text, chr(10))), generate_subscripts(string_split(text, chr(10)), 1) FROM documents),
bigrams AS (SELECT doc_id, place, {_bigrams('w')} AS b FROM (SELECT *, {_NORMAL} AS w FROM units)),
pairs AS (
  SELECT doc_id, place, number, name, free, 2.0 * len(list_intersect(b, t)) / (len(b) + len(t)) AS dice
  FROM bigrams JOIN templates ON len(b) >= {DICE / (2 - DICE)} * len(t) AND len(b) <= {(2 - DICE) / DICE} * len(t)),
best AS (
  SELECT doc_id, place, arg_max(struct_pack(n := name, d := dice, f := free, k := number), (dice, -number)) AS m
  FROM pairs WHERE dice >= {DICE} GROUP BY ALL),
found AS (
  SELECT doc_id, arg_max(struct_pack(n := m.n, d := m.d, p := place), (m.d, -m.k, -place)) AS x, count(*) AS c, bool_and(m.f) AS free
  FROM best GROUP BY doc_id)
SELECT d.doc_id, x.n AS license, round(x.d::DOUBLE, 9) AS dice, x.p::INTEGER AS license_line, coalesce(c, 0)::INTEGER AS n_licenses, CASE WHEN c > 0 THEN coalesce(free, false) END AS permissive
FROM documents d LEFT JOIN found USING (doc_id)
"""

_MIX = f"""
WITH sized AS (SELECT doc_id, source, len({_WORDS})::BIGINT AS size, md5(coalesce(doc_id::VARCHAR, '')) AS o FROM documents),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size, [5, 2, 1][1 + (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3] AS w
  FROM sized GROUP BY source),
pairs AS (
  -- the level if sources of a lower cap by weight are capped
  SELECT a.source, (SELECT sum(source_size) FROM sources) - coalesce(sum(3 * b.source_size), 0) AS rest,
    (SELECT sum(w) FROM sources) - coalesce(sum(b.w), 0) AS others, any_value(3 * a.source_size / a.w) AS cap
  FROM sources a LEFT JOIN sources b ON (3 * b.source_size / b.w, b.source IS NULL, b.source) < (3 * a.source_size / a.w, a.source IS NULL, a.source) GROUP BY a.source),
level AS (SELECT max(rest::DOUBLE / others::DOUBLE) AS l FROM pairs WHERE cap >= rest / others),
targets AS (SELECT source, source_size, w, least((3 * source_size)::DOUBLE, w * l) AS target FROM sources, level),
run AS (
  SELECT s.*, t.source_size, t.w, t.target, sum(size) OVER (PARTITION BY s.source ORDER BY o, size ROWS UNBOUNDED PRECEDING) - size AS before
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
taken AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS passes FROM run),
mixed AS (
  SELECT *, passes * size + greatest(0, least(round(target)::BIGINT - passes * source_size - before, size)) AS taken, before / target AS x FROM taken)
SELECT doc_id, size, source_size, target, taken::BIGINT AS taken, CASE WHEN taken > 0 THEN round(CASE w
  -- falling from 1.5 to 0.5, even, rising from 0.5 to 1.5
  WHEN 5 THEN 2 * x / (1.5 + sqrt(greatest(2.25 - 2 * x, 0)))
  WHEN 2 THEN x
  ELSE 2 * x / (0.5 + sqrt(0.25 + 2 * x)) END, 6) END AS position
FROM mixed
"""

_RULES = f"""
WITH words AS (
  SELECT doc_id, coalesce(text, '') AS text, {_WORDS} AS w, list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines FROM documents),
windows AS (SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM words)),
again AS (SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
repeats AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM again, range(3) r(k) GROUP BY doc_id),
counted AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda x: len(x))), 0)::BIGINT AS word_chars,
    (len(text) - len(translate(text, '#*$%&|<>', '')))::BIGINT AS n_symbols, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
    coalesce(n, 0)::BIGINT AS n_repeat_words, len(lines) AS n_lines, len(list_filter(w, lambda x: x IN ({', '.join(map(_quoted, STOP_WORDS))}))) AS n_stop
  FROM words LEFT JOIN repeats USING (doc_id)),
based AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counted)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND word_chars BETWEEN 2 * n_words AND 14 * n_words AND n_symbols <= 0.1 * n_words AND n_stop >= 0.02 * n_words
    AND n_dup_lines <= 0.5 * n_lines AND n_words >= 2 * n_lines AS kept
FROM based
"""

_DOT = "list_reduce(list_transform(range(1, len({a}) + 1), lambda i: {a}[i] * {b}[i]), lambda x, y: x + y)"
_NEAREST = f"""
WITH v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
  AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
sized AS (SELECT *, sqrt({_DOT.format(a='e', b='e')}) AS n FROM v),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, {_DOT.format(a='q.e', b='c.e')} / (q.n * c.n) AS score
  FROM sized q JOIN sized c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.e) = len(c.e))
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
FROM scored QUALIFY rank <= 5
"""

_JACCARD = f"""
WITH RECURSIVE w AS (SELECT doc_id, {_WORDS} AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s FROM w WHERE len(w) > 0),
shingles AS (SELECT doc_id, unnest(s) AS g, len(s) AS n FROM sets),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM shingles a JOIN shingles b ON a.g = b.g AND a.doc_id <> b.doc_id
  GROUP BY ALL HAVING 9 * count(*) >= 4 * (any_value(a.n) + any_value(b.n))),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)
SELECT doc_id, least(doc_id, coalesce((SELECT min(b) FROM reach WHERE reach.a = doc_id), doc_id)) AS class_id,
  coalesce((SELECT count(*) FROM links WHERE links.a = doc_id), 0)::BIGINT AS n_links
FROM documents
"""

_BITS = "(unhex(sha1(p)))::BIT::VARCHAR"
_WARC = f"""
WITH payloads AS (SELECT page_id, coalesce(html, '') AS p FROM pages),
digests AS (
  SELECT page_id, strlen(p)::BIGINT AS payload_bytes, {_BITS} AS bits, max(page_id) OVER (PARTITION BY p) AS first FROM payloads)
SELECT page_id, payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + list_sum(list_transform(range(5), lambda k:
    substr(bits, 5 * i + k + 1, 1)::INTEGER * (16 >> k)))::INTEGER, 1)), '') AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to
FROM digests
"""

_CRC32 = """(xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
  lambda crc, b: list_reduce(list_prepend(xor(crc, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
    lambda x, k: xor(x >> 1, CASE WHEN x % 2 = 1 THEN 3988292384 ELSE 0 END::BIGINT))), 4294967295))"""


def _leaf(n_chars: str) -> str:
    fields = ("doc_id::VARCHAR", "source", "lang", f"({n_chars})::VARCHAR", "text")
    return "sha256(" + " || ".join(f"coalesce(strlen({x})::VARCHAR || ':' || {x}, '-')" for x in fields) + ")"


_MERKLE = f"""
WITH RECURSIVE leaves AS (
  SELECT doc_id, coalesce({_CRC32} % 7 = 0, false) AS changed, {_leaf('n_chars')} AS leaf, {_leaf('n_chars + 1')} AS other,
    dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree, lang FROM documents),
placed AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY lang) AS n FROM leaves),
nodes AS (
  SELECT 0 AS level, tree, pos, n, leaf AS node FROM placed
  UNION ALL
  SELECT max(level) + 1, tree, pos // 2, (max(n) + 1) // 2, sha256(string_agg(node, '' ORDER BY pos)) FROM nodes WHERE n > 1 GROUP BY tree, pos // 2),
tops AS (
  SELECT 0 AS level, tree AS pos, (SELECT count(*) FROM nodes WHERE n = 1) AS n, node FROM nodes WHERE n = 1
  UNION ALL
  SELECT max(level) + 1, pos // 2, (max(n) + 1) // 2, sha256(string_agg(node, '' ORDER BY pos)) FROM tops WHERE n > 1 GROUP BY pos // 2),
every AS (SELECT level, tree, pos, n, node FROM nodes UNION ALL SELECT 1000 + level, -1, pos, n, node FROM tops),
steps AS (
  -- a step for each level below its root: the sibling, if there is one, and its side
  SELECT p.doc_id, p.leaf, p.tree AS own, p.pos AS place, row_number() OVER (PARTITION BY p.tree, p.pos ORDER BY e.level) AS step,
    s.node AS sibling, s.pos < e.pos AS is_left
  FROM placed p JOIN every e ON e.n > 1 AND ((e.tree = p.tree AND e.pos = p.pos >> e.level::INTEGER) OR (e.tree = -1 AND e.pos = p.tree >> (e.level - 1000)::INTEGER))
    LEFT JOIN every s ON s.level = e.level AND s.tree = e.tree AND s.pos = xor(e.pos, 1)),
proofs AS (SELECT own, place, sha256(coalesce(string_agg(sibling, '' ORDER BY step), '')) AS proof_sha256, count(*) AS steps FROM steps GROUP BY own, place),
folds AS (
  SELECT tree AS own, pos AS place, 0 AS step, CASE WHEN changed THEN other ELSE leaf END AS node FROM placed
  UNION ALL
  SELECT f.own, f.place, f.step + 1, sha256(CASE WHEN s.sibling IS NULL THEN f.node WHEN s.is_left THEN s.sibling || f.node ELSE f.node || s.sibling END)
  FROM folds f JOIN steps s ON s.own = f.own AND s.place = f.place AND s.step = f.step + 1),
folded AS (SELECT own, place, arg_max(node, step) AS folded_root FROM folds GROUP BY own, place)
SELECT p.doc_id, p.leaf, r.node AS subroot, t.node AS root, coalesce(x.proof_sha256, sha256('')) AS proof_sha256, f.folded_root, f.folded_root = t.node AS verified
FROM placed p JOIN nodes r ON r.tree = p.tree AND r.n = 1 JOIN tops t ON t.n = 1 JOIN folded f ON f.own = p.tree AND f.place = p.pos
  LEFT JOIN proofs x ON x.own = p.tree AND x.place = p.pos
"""

_EXACT = r"""
WITH rows AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS t, length(coalesce(text, '')) AS points FROM documents),
placed AS (SELECT *, row_number() OVER (PARTITION BY t ORDER BY points DESC, doc_id NULLS LAST) AS place, count(*) OVER (PARTITION BY t) AS size FROM rows)
SELECT a.doc_id, b.doc_id AS keep_id, a.size AS group_size, a.place = 1 AS kept, sha256(a.t) AS text_sha256
FROM placed a JOIN placed b ON a.t = b.t AND b.place = 1
"""

ORACLE = {
    "op2_license_scan": _LICENSE,
    "op4_source_mix": _MIX,
    "op5_rule_verdicts": _RULES,
    "op7_neighbours": _NEAREST,
    "op9_jaccard_join": _JACCARD,
    "op10_warc": _WARC,
    "op11_merkle_manifest": _MERKLE,
    "op12_exact_dedup": _EXACT,
}
