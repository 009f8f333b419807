"""DuckDB SQL for the operators that SQL can express, over the same tables.

Each says the contract in its own terms (windows as joined words, links as a
self join of shingles, tapes as one running sum, runs of a notice as paths,
fences as quantiles of all values), not the operator's plan.
"""

from __future__ import annotations

import re

from tidelog.llm import licenses, quality, secrets
from tidelog.llm.common import ASCII_FOLD, ASCII_LOWER, ASCII_UPPER

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
_FOLDED = f"regexp_extract_all(translate(coalesce(text, ''), '{ASCII_UPPER}', '{ASCII_LOWER}'), '[^\\x20\\x09-\\x0D]+')"


def _split(phrase: str) -> list[str]:
    return [w for w in re.split(licenses.SEPARATORS, phrase.translate(ASCII_FOLD)) if w]


def _notices() -> str:
    """(template, label, n_pairs, at, a, b): a row for each pair of words of each notice."""
    each = [(number, label, _split(phrase)) for number, (phrase, label) in enumerate(licenses.NOTICES)]
    return ", ".join(f"({number}, '{label}', {len(ws) - 1}, {i}, '{a}', '{b}')" for number, label, ws in each for i, (a, b) in enumerate(zip(ws, ws[1:])))


def _phrases() -> str:
    """(phrase, label, size) of the base phrases."""
    return ", ".join(f"('{' '.join(_split(phrase))}', '{label}', {len(_split(phrase))})" for phrase, label in licenses.BASE)


#: Base phrases as runs of words; a notice's run as a path over its hits, longer by one hit at every step.
LICENSES = rf"""WITH RECURSIVE t(template, label, n_pairs, tpos, a, b) AS (VALUES {_notices()}), q(phrase, label, size) AS (VALUES {_phrases()}),
w AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), '{ASCII_UPPER}', '{ASCII_LOWER}'), '{licenses.SEPARATORS}'), lambda x: x <> '') AS ws FROM documents),
p AS (SELECT doc_id, i - 1 AS pos, ws[i] AS a, ws[i + 1] AS b, array_to_string(ws[i:i + 3], ' ') || ' ' AS ahead FROM (SELECT doc_id, ws, unnest(range(1, len(ws) + 1)) AS i FROM w)),
base AS (SELECT doc_id, pos, label FROM p JOIN q ON starts_with(ahead, phrase || ' ')),
h AS (SELECT DISTINCT doc_id, template, pos, tpos FROM p JOIN t USING (a, b)),
r AS (SELECT doc_id, template, pos, tpos, 1 AS n FROM h UNION SELECT h.doc_id, h.template, h.pos, h.tpos, r.n + 1 FROM r JOIN h ON r.doc_id = h.doc_id AND r.template = h.template AND h.tpos > r.tpos AND h.pos > r.pos AND abs((h.pos - r.pos) - (h.tpos - r.tpos)) <= {licenses.DRIFT}),
n AS (SELECT doc_id, label, max(n) / n_pairs AS score FROM r JOIN (SELECT DISTINCT template, label, n_pairs FROM t) USING (template) GROUP BY doc_id, template, label, n_pairs HAVING max(n) >= CASE WHEN n_pairs < {licenses.LONG} THEN n_pairs ELSE {licenses.ACCEPT} * n_pairs END),
f AS (SELECT doc_id, label, pos, 1.0 AS score FROM base UNION ALL SELECT doc_id, label, NULL, score FROM n),
g AS (SELECT doc_id, count(pos) AS n_base, min(pos) AS first_word, max(pos) AS last_word, coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (pos IS NOT NULL), '') AS base_labels, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(score) AS score FROM f GROUP BY doc_id)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
  coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, CAST(coalesce(score, 0) AS DOUBLE) AS score FROM w LEFT JOIN g USING (doc_id)"""


def _rate(name: str) -> str:
    above, below = quality.RATES[name]
    return f"least({quality.LONGEST * quality.STEPS[name]}, coalesce({quality.STEPS[name]} * {above} // nullif({below}, 0), 0)) AS {name}"


def _fences(tag: str) -> str:
    q = lambda name, p: f"quantile_disc({name}, {p})"
    return ", ".join(f"{q(n, 0.75)} + greatest({quality.SPREADS} * ({q(n, 0.75)} - {q(n, 0.25)}), {round(least * quality.STEPS[n])}) AS {tag}_{n}" for n, least in quality.LEAST.items())


def _within() -> str:
    own, low = [], quality.MIN_ROWS
    for n, least in quality.LEAST.items():
        above = f"CASE WHEN n_l >= {low} THEN l_{n} ELSE c_{n} END"
        own.append(f"coalesce({n} <= CASE WHEN n_g >= {low} THEN least(g_{n}, {above} + {round(least * quality.STEPS[n])}) ELSE {above} END, true)")
    return " AND ".join(own)


QUALITY = rf"""WITH w AS (SELECT doc_id, lang, source, coalesce(text, '') AS text, {_WORDS} AS ws, list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM documents),
g AS (SELECT doc_id, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS g FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)),
r AS (SELECT doc_id, i FROM g QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
v AS (SELECT doc_id, count(DISTINCT i + j) AS n FROM r, range(3) x(j) GROUP BY 1),
b AS (SELECT doc_id, lang, source, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
  CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, len(lines) AS n_lines, coalesce(n, 0) AS n_repeat_words FROM w LEFT JOIN v USING (doc_id)),
f AS (SELECT *, n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > 50 * n_words AS base_failed, {", ".join(_rate(n) for n in quality.LEAST)} FROM b),
s AS (SELECT * FROM f WHERE NOT base_failed),
x AS (SELECT lang, source, count(*) AS n_g, {_fences("g")} FROM s GROUP BY 1, 2), y AS (SELECT lang, count(*) AS n_l, {_fences("l")} FROM s GROUP BY 1), z AS (SELECT {_fences("c")} FROM s)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND {_within()} AS kept
FROM f LEFT JOIN x ON f.lang IS NOT DISTINCT FROM x.lang AND f.source IS NOT DISTINCT FROM x.source LEFT JOIN y ON f.lang IS NOT DISTINCT FROM y.lang LEFT JOIN z ON true"""

NEAR = rf"""WITH RECURSIVE w AS (SELECT doc_id, {_FOLDED} AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i + 4], ' ') AS g FROM (SELECT doc_id, ws, unnest(range(1, greatest(2, len(ws) - 3))) AS i FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id AS x, doc_id AS y FROM w UNION SELECT r.x, e.b FROM r JOIN e ON r.y = e.a)
SELECT doc_id, coalesce(n, 0) AS n_shingles, m AS component_id, doc_id = m AS kept FROM (SELECT x AS doc_id, min(y) AS m FROM r GROUP BY 1) LEFT JOIN n USING (doc_id)"""

MIX = rf"""WITH d AS (SELECT doc_id, source, CAST(len({_WORDS}) AS BIGINT) AS size, md5('0:' || coalesce(CAST(doc_id AS VARCHAR), 'null') || ':' || coalesce(text, '')) AS k FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY 1),
w AS (SELECT *, 2 * source_size AS cap, [5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight FROM s),
o AS (SELECT *, cap / weight AS ratio, coalesce(sum(cap) OVER b, 0) AS capped, sum(weight) OVER () - coalesce(sum(weight) OVER b, 0) AS lw, 1.5 * sum(source_size) OVER () AS total
  FROM w WINDOW b AS (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (SELECT *, CASE WHEN (total - capped) / lw * weight <= cap THEN CAST(total - capped AS DOUBLE) / lw END AS level FROM o),
t AS (SELECT source, source_size, CAST(CASE WHEN level IS NULL THEN cap ELSE least((SELECT level FROM l WHERE level IS NOT NULL ORDER BY ratio, source NULLS LAST LIMIT 1) * weight, cap) END AS DOUBLE) AS target FROM l),
p AS (SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY k, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS place FROM d)
SELECT doc_id, size, source_size, target, CAST(CASE WHEN source_size > 0 THEN floor(round(target) / source_size) * size + greatest(0, least(size, round(target) - floor(round(target) / source_size) * source_size - place)) ELSE 0 END AS BIGINT) AS taken
FROM p JOIN t ON p.source IS NOT DISTINCT FROM t.source"""

BLOCKS = rf"""WITH w AS (SELECT doc_id, {_WORDS} AS ws FROM documents),
g AS (SELECT doc_id, i, md5(array_to_string(ws[i:i + 34], ' ')) AS h FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 33)) AS i FROM w WHERE len(ws) >= 35)),
r AS (SELECT doc_id, i FROM g QUALIFY count(*) OVER (PARTITION BY h) > 1),
c AS (SELECT DISTINCT doc_id, i + j AS p FROM r, range(35) x(j)),
k AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS p FROM w),
f AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS kept, count(*) AS n FROM k ANTI JOIN c USING (doc_id, p) GROUP BY 1)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM w LEFT JOIN f ON w.doc_id = f.doc_id"""

BYTES = """WITH w AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x, CAST(octet_length(encode(coalesce(text, ''))) AS BIGINT) AS n FROM documents),
g AS (SELECT doc_id, i, md5(substr(x, 2 * i + 1, 400)) AS h FROM (SELECT doc_id, x, unnest(range(0, n - 199)) AS i FROM w WHERE n >= 200)),
r AS (SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS p FROM (SELECT doc_id, i FROM g QUALIFY count(*) OVER (PARTITION BY h) > 1)),
s AS (SELECT doc_id, i, sum(CASE WHEN p IS NULL OR i > p + 200 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) AS span FROM r),
u AS (SELECT doc_id, min(i) AS a, max(i) + 200 AS b FROM s GROUP BY doc_id, span),
v AS (SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before FROM u),
k AS (SELECT doc_id, string_agg(substr(x, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) || substr(any_value(x), 2 * max(b) + 1) AS kept, CAST(sum(b - a) AS BIGINT) AS removed, count(*) AS spans FROM v JOIN w USING (doc_id) GROUP BY doc_id)
SELECT w.doc_id, n AS n_bytes, coalesce(removed, 0) AS n_removed, coalesce(spans, 0) AS n_spans, sha256(unhex(coalesce(kept, x))) AS kept_sha256 FROM w LEFT JOIN k ON w.doc_id = k.doc_id"""


def _crc32(text: str) -> str:
    """Unsigned CRC-32 of ASCII text, bit by bit."""
    codes = f"list_transform(string_split({text}, ''), lambda c: CAST(ascii(c) AS BIGINT))"
    bits = "list_reduce(list_prepend(xor(crc, byte), CAST(range(8) AS BIGINT[])), lambda x, bit: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384 ELSE 0 END))"
    return f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {codes}), lambda crc, byte: {bits}), 4294967295)"


def _leaf(n_chars: str) -> str:
    values = ["CAST(doc_id AS VARCHAR)", "source", "lang", f"CAST({n_chars} AS VARCHAR)", "text"]
    return "sha256(" + " || ".join(f"coalesce(strlen({v}) || ':' || {v}, '-')" for v in values) + ")"


#: All levels of all trees as rows, a step up each time; siblings by the place with its last bit flipped; a leaf is folded step by step.
MERKLE = f"""WITH RECURSIVE d AS (SELECT row_number() OVER () AS id, * FROM documents),
l AS (SELECT id, doc_id, lang, {_leaf('n_chars')} AS leaf, CASE WHEN {_crc32("CAST(doc_id AS VARCHAR)")} % 7 = 0 THEN {_leaf('n_chars + 1')} END AS altered FROM d),
o AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf, id) - 1 AS place, count(*) OVER (PARTITION BY lang) AS n FROM l),
t AS (SELECT lang, 0 AS level, place, leaf AS digest, n FROM o UNION ALL SELECT lang, level + 1, place // 2, sha256(string_agg(digest, '' ORDER BY place)), (n + 1) // 2 FROM t WHERE n > 1 GROUP BY lang, level, place // 2, n),
s AS (SELECT lang, level AS height, digest AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS place, count(*) OVER () AS n FROM t WHERE n = 1),
g AS (SELECT 0 AS level, place, subroot AS digest, n FROM s UNION ALL SELECT level + 1, place // 2, sha256(string_agg(digest, '' ORDER BY place)), (n + 1) // 2 FROM g WHERE n > 1 GROUP BY level, place // 2, n),
w AS (SELECT o.id, t.level AS step, CASE WHEN (o.place >> t.level) & 1 = 1 THEN t.digest ELSE '' END AS low, CASE WHEN (o.place >> t.level) & 1 = 0 THEN t.digest ELSE '' END AS high
  FROM o JOIN t ON o.lang IS NOT DISTINCT FROM t.lang AND t.n > 1 AND t.place = xor(o.place >> t.level, 1)
  UNION ALL SELECT o.id, s.height + g.level, CASE WHEN (s.place >> g.level) & 1 = 1 THEN g.digest ELSE '' END, CASE WHEN (s.place >> g.level) & 1 = 0 THEN g.digest ELSE '' END
  FROM o JOIN s ON o.lang IS NOT DISTINCT FROM s.lang JOIN g ON g.n > 1 AND g.place = xor(s.place >> g.level, 1)),
h AS (SELECT o.id, s.subroot, s.height + (SELECT max(level) FROM g) AS steps FROM o JOIN s ON o.lang IS NOT DISTINCT FROM s.lang),
f AS (SELECT o.id, 0 AS step, coalesce(altered, leaf) AS node FROM o UNION ALL SELECT f.id, f.step + 1, sha256(coalesce(w.low, '') || f.node || coalesce(w.high, '')) FROM f JOIN h ON f.id = h.id AND f.step < h.steps LEFT JOIN w ON f.id = w.id AND f.step = w.step),
e AS (SELECT f.id, f.node FROM f JOIN h ON f.id = h.id AND f.step = h.steps),
q AS (SELECT id, string_agg(low || high, '' ORDER BY step) AS siblings FROM w GROUP BY id)
SELECT o.doc_id, o.leaf, h.subroot, r.root, sha256(coalesce(q.siblings, '')) AS proof_sha256, e.node AS folded_root, e.node = r.root AS verified
FROM o JOIN h USING (id) JOIN e USING (id) LEFT JOIN q USING (id) CROSS JOIN (SELECT digest AS root FROM g WHERE n = 1) r"""


def _hits(kind: int, pattern: str) -> str:
    quoted = pattern.replace("'", "''")
    return f"SELECT id, {kind} AS kind, string_split_regex(text, '{quoted}') AS gaps, regexp_extract_all(text, '{quoted}') AS found FROM d WHERE regexp_matches(text, '{quoted}')"


_ASSIGN = secrets.ASSIGN.replace("'", "''")
_KIND = "CASE kind " + " ".join(f"WHEN {k} THEN '{name}'" for k, name in enumerate(secrets.KINDS)) + " END || ':' || start || ':' || stop"

#: Access keys and hex by the contract's own patterns, short matches dropped afterwards.
SECRETS = f"""WITH d AS (SELECT row_number() OVER () AS id, doc_id, source, coalesce(text, '') AS text FROM documents),
h AS ({" UNION ALL ".join(_hits(k, p) for k, p in enumerate((secrets.ASSIGN, "AKIA[A-Z0-9]+", "[0-9a-f]+", secrets.PATTERNS["owned"])))}),
u AS (SELECT id, kind, gaps, found, unnest(range(1, len(found) + 1)) AS i FROM h),
p AS (SELECT id, kind, found[i] AS match, list_sum(list_transform(gaps[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(found[1:i - 1], lambda x: length(x))), 0) AS start FROM u
  WHERE length(found[i]) >= CASE kind WHEN 0 THEN {secrets.LEAST_ASSIGN} WHEN 1 THEN 18 WHEN 2 THEN 16 ELSE 24 END),
v AS (SELECT id, kind, CAST(start AS BIGINT) AS start, CAST(start + length(match) AS BIGINT) AS stop, CASE WHEN kind = 0 THEN regexp_extract(match, '{_ASSIGN}', 2) ELSE match END AS value FROM p),
b AS (SELECT * FROM v WHERE CASE WHEN kind = 0 THEN length(value) >= {secrets.LEAST_ASSIGN} WHEN kind < 3 THEN true
  ELSE regexp_matches(value, '[A-Z]') AND regexp_matches(value, '[a-z]') AND regexp_matches(value, '[0-9]') AND len(list_distinct(string_split(value, ''))) >= {secrets.MIXED_KINDS} END),
c AS (SELECT * FROM b WHERE kind < 3 OR NOT EXISTS (FROM b AS o WHERE o.id = b.id AND o.kind < 3 AND o.start < b.stop AND b.start < o.stop)),
w AS (SELECT value, count(DISTINCT source) + count(DISTINCT CASE WHEN source IS NULL THEN 1 END) AS n_owners FROM c JOIN d USING (id) GROUP BY value),
j AS (SELECT c.*, n_owners < {secrets.WIDE} AS live FROM c JOIN w USING (value) WHERE kind < 3 OR n_owners < {secrets.WIDE}),
g AS (SELECT id, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access, count(*) FILTER (kind = 2) AS n_hex, string_agg({_KIND}, ',' ORDER BY start, kind) FILTER (kind < 3) AS base,
  string_agg({_KIND}, ',' ORDER BY start, kind) AS spans, count(*) FILTER (kind = 3) AS n_owned, count(*) FILTER (kind < 3 AND live) AS n_live, count(*) FILTER (kind < 3 AND NOT live) AS n_copied FROM j GROUP BY id)
SELECT doc_id, {", ".join(f"coalesce({n}, 0) AS {n}" for n in ("n_assign", "n_access", "n_hex", "n_owned", "n_live", "n_copied"))}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM d LEFT JOIN g USING (id)"""

#: Prefixes as lists of turns, compared as such; subtrees by a join of each node with its prefixes.
TRIE = f"""WITH c AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS i FROM conversations WHERE conv_id IS NOT NULL),
k AS (SELECT DISTINCT conv_id, {_crc32("CAST(conv_id AS VARCHAR)")} % 6 AS h FROM c),
r AS (SELECT k.conv_id, i, role, text FROM k JOIN c ON c.conv_id = k.conv_id AND i > h UNION ALL SELECT k.conv_id, i, role, text FROM k JOIN c ON c.conv_id = k.conv_id - k.conv_id % 100 AND i <= h),
s AS (SELECT k.conv_id, coalesce(list(struct_pack(role := role, text := text) ORDER BY i) FILTER (i IS NOT NULL), []) AS turns FROM k LEFT JOIN r USING (conv_id) GROUP BY k.conv_id),
p AS (SELECT conv_id, turns, unnest(range(0, len(turns) + 1)) AS depth FROM s),
n AS (SELECT turns[1:depth] AS prefix, depth, min(conv_id) AS conv_id, count(*) AS n_convs, sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (len(turns) = depth), '')) AS ends_sha256 FROM p GROUP BY 1, 2),
m AS (SELECT n.*, o.conv_id AS parent_conv_id, (n.n_convs - 1) * coalesce(length(n.prefix[n.depth].text), 0) AS saved FROM n LEFT JOIN n AS o ON n.depth = o.depth + 1 AND n.prefix[1:n.depth - 1] = o.prefix),
a AS (SELECT parent_conv_id AS conv_id, depth - 1 AS depth, count(*) AS n_children FROM m WHERE depth > 0 GROUP BY 1, 2),
q AS (SELECT m.*, coalesce(n_children, 0) AS n_children FROM m LEFT JOIN a USING (conv_id, depth)),
e AS (SELECT prefix[1:up] AS prefix, up AS depth, sum(saved) AS saved_tokens, count(*) FILTER (n_children = 0) AS n_leaves FROM (SELECT *, unnest(range(0, depth + 1)) AS up FROM q) GROUP BY 1, 2)
SELECT conv_id, CAST(depth AS BIGINT) AS depth, parent_conv_id, n_convs, n_children, n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, ends_sha256 FROM q JOIN e USING (prefix, depth)"""

SQL = {"op2_suffix_repeats": BYTES, "op3_license_scan": LICENSES, "op5_quality_rules": QUALITY, "op7_minmax_near_dedup": NEAR, "op8_source_mix": MIX, "op9_fixed_block_repeats": BLOCKS, "op11_merkle_manifest": MERKLE, "op12_secret_scan": SECRETS, "op13_prefix_trie": TRIE}
