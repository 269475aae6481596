"""DuckDB statements that the registered queries must equal.

Written from the contracts, not from the operators: frequent lines by a join
on the lines themselves, repeated word windows by counting, near duplicates and
near vectors by comparing every pair, window entropy by counting every window.
Tokenising, extraction, language ID, Feistel pseudonyms and packing have no
statement; ``tests/llm`` compares them with plain-Python versions.
"""

from __future__ import annotations

from . import quality, secrets

_SPACE = r"[\x20\x09-\x0D]"
_WORD = r"[^\x20\x09-\x0D]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Least id that each node reaches: ``pair(a, b)`` holds both directions.
_REACH = """
reach(id, other) AS (
  SELECT a, b FROM pair
  UNION
  SELECT r.id, p.b FROM reach r JOIN pair p ON p.a = r.other
),
least_id AS (SELECT id, least(id, min(other)) AS component FROM reach GROUP BY id)
"""

OP3 = rf"""
WITH docs AS (
  SELECT row_number() OVER () AS rid, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents
),
lines AS (
  SELECT rid, doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS i FROM docs
),
keyed AS (
  SELECT *, translate(regexp_replace(regexp_replace(line, '^{_SPACE}+', ''), '{_SPACE}+$', ''),
                      '{_UPPER}', '{_LOWER}') AS line_key FROM lines
),
frequent AS (
  SELECT line_key FROM keyed WHERE line_key <> '' GROUP BY line_key HAVING count(DISTINCT rid) >= 10
)
SELECT k.doc_id, count(*) AS n_lines, count(f.line_key) AS n_dropped,
       sha256(coalesce(string_agg(k.line, chr(10) ORDER BY k.i) FILTER (WHERE f.line_key IS NULL), '')) AS kept_sha256
FROM keyed k LEFT JOIN frequent f ON k.line_key = f.line_key
GROUP BY k.rid, k.doc_id
"""

OP5 = rf"""
WITH RECURSIVE docs AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{_WORD}') AS w FROM documents
),
shingle AS (
  SELECT DISTINCT doc_id, s FROM (
    SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN [w[1]]
                          ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS s FROM docs)
),
size AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id),
shared AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n FROM shingle x JOIN shingle y ON x.s = y.s AND x.doc_id < y.doc_id
  GROUP BY x.doc_id, y.doc_id
),
linked AS (
  SELECT a, b FROM shared JOIN size p ON p.doc_id = a JOIN size q ON q.doc_id = b
  WHERE 100 * shared.n >= 80 * (p.n + q.n - shared.n)
),
pair AS (SELECT a, b FROM linked UNION ALL SELECT b, a FROM linked),
{_REACH}
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, coalesce(l.component, d.doc_id) AS component_id,
       d.doc_id = coalesce(l.component, d.doc_id) AS kept
FROM docs d LEFT JOIN size s ON s.doc_id = d.doc_id LEFT JOIN least_id l ON l.id = d.doc_id
"""

_FAILED = "\n       + ".join(f"CASE WHEN {fails} THEN {1 << i} ELSE 0 END" for i, (_, fails) in enumerate(quality.RULES))

OP7 = rf"""
WITH docs AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents
),
word AS (
  SELECT rid, unnest(w) AS x, unnest(range(len(w))) AS i
  FROM (SELECT rid, regexp_extract_all(t, '{_WORD}') AS w FROM docs)
),
win AS (
  SELECT rid, i, x, lead(x, 1) OVER o AS y, lead(x, 2) OVER o AS z FROM word WINDOW o AS (PARTITION BY rid ORDER BY i)
),
seen AS (
  SELECT rid, i, CASE WHEN z IS NOT NULL AND count(*) OVER (PARTITION BY rid, x, y, z) > 1 THEN 1 ELSE 0 END AS again FROM win
),
cover AS (
  SELECT rid, max(again) OVER (PARTITION BY rid ORDER BY i ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS hit FROM seen
),
repeated AS (SELECT rid, count(*) AS n_words, sum(hit) AS n_repeat_words FROM cover GROUP BY rid),
line AS (
  SELECT rid, count(*) AS n_text_lines, count(*) - count(DISTINCT l) AS n_dup_lines
  FROM (SELECT rid, unnest(string_split(t, chr(10))) AS l FROM docs) WHERE regexp_matches(l, '{_WORD}') GROUP BY rid
),
measured AS (
  SELECT d.doc_id, coalesce(r.n_words, 0)::BIGINT AS n_words, coalesce(r.n_repeat_words, 0)::BIGINT AS n_repeat_words,
         length(regexp_replace(t, '{_SPACE}', '', 'g'))::BIGINT AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         length(regexp_replace(t, '[^A-Z]', '', 'g'))::BIGINT AS n_upper,
         coalesce(l.n_text_lines, 0)::BIGINT AS n_text_lines, coalesce(l.n_dup_lines, 0)::BIGINT AS n_dup_lines
  FROM docs d LEFT JOIN repeated r ON r.rid = d.rid LEFT JOIN line l ON l.rid = d.rid
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       failed_bits = 0 AS kept, failed_bits
FROM (SELECT *, ({_FAILED})::BIGINT AS failed_bits FROM measured)
"""

OP8 = f"""
WITH RECURSIVE vec AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
),
usable AS (
  SELECT * FROM vec
  WHERE label IS NOT NULL AND v IS NOT NULL AND len(v) > 0 AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(v, lambda x: x <> 0)) > 0
),
pair AS (
  SELECT x.vec_id AS a, y.vec_id AS b FROM usable x JOIN usable y ON x.label = y.label AND x.vec_id <> y.vec_id
  WHERE len(x.v) = len(y.v) AND list_cosine_similarity(x.v, y.v) >= 0.93
),
degree AS (SELECT a AS id, count(*) AS n FROM pair GROUP BY a),
{_REACH}
SELECT e.vec_id, coalesce(g.n, 0) AS n_links, coalesce(l.component, e.vec_id)::BIGINT AS component_id,
       e.vec_id = coalesce(l.component, e.vec_id) AS kept
FROM vec e LEFT JOIN degree g ON g.id = e.vec_id LEFT JOIN least_id l ON l.id = e.vec_id
"""


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


def _found(kind: str, pattern: str, group: int) -> str:
    """Spans of one kind: every match follows its gap, so its start is the sum
    of the gaps up to it and of the matches before it."""
    p = _quoted(pattern)
    return f"""
  SELECT rid, {secrets.KINDS.index(kind)} AS k, (upto - len(hit))::BIGINT AS s, upto::BIGINT AS e, v FROM (
    SELECT rid, hit, v, sum(len(gap) + len(hit)) OVER (PARTITION BY rid ORDER BY i) AS upto FROM (
      SELECT rid, unnest(range(len(hits))) AS i, unnest(hits) AS hit, unnest(gaps[:len(hits)]) AS gap, unnest(vals) AS v
      FROM (SELECT rid, regexp_extract_all(t, {p}) AS hits, regexp_extract_all(t, {p}, {group}) AS vals,
                   string_split_regex(t, {p}) AS gaps FROM docs)))"""


def _plain_regex(pattern: str) -> str:
    """Without possessive quantifiers, which that engine neither has nor needs."""
    return pattern.replace("++", "+").replace("*+", "*").replace("}+", "}")


_CLASS_BITS = "CASE " + " ".join(f"WHEN regexp_matches(w, {_quoted(shape)}) THEN {bits}" for _, shape, bits in secrets.CLASSES) + " END"
_SIGN_LIST = ", ".join(f"'{c}'" for c in "+/_=-")
_PAIR_LIST = "[" + ", ".join(f"'{p}'" for p in secrets.PAIRS) + "]"
_LETTERS = "regexp_replace(x, '[0-9]+$', '')"
_IS_WORD = (f"(regexp_matches(x, {_quoted(_plain_regex(secrets.WORD))}) AND (len(x) < {secrets.WINDOW} OR 100 * len(list_filter("
            f"range(1, len({_LETTERS})), lambda j: list_contains({_PAIR_LIST}, substr(lower(x), j::BIGINT, 2)))) "
            f">= {secrets.WORD_PAIRS} * (len({_LETTERS}) - 1)))")
#: A candidate with its known shapes as "0"; a sign between two of them bounds both, so
#: each pattern is replaced twice.
_PLAIN = "v"
for _shape in secrets.KNOWN:
    for _ in range(2):
        _PLAIN = f"regexp_replace({_PLAIN}, {_quoted('(^|[^0-9A-Za-z])' + _shape + '([^0-9A-Za-z]|$)')}, '\\1' || '0' || '\\2', 'g')"
_NAMES = "[" + ", ".join(f"'{k}'" for k in secrets.KINDS) + "]"
_RENDER = f"string_agg({_NAMES}[k + 1] || ':' || s || ':' || e, ',' ORDER BY s, k, e)"

OP9 = f"""
WITH docs AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents
),
base AS (
  {_found("assign", secrets.ASSIGN, 1)} WHERE len(v) >= 6
  UNION ALL {_found("access", secrets.ACCESS, 0)}
  UNION ALL {_found("hex", secrets.HEX, 0)}
),
candidate AS (SELECT row_number() OVER () AS cid, * FROM ({_found("entropy", secrets.CANDIDATE, 0)})),
-- what the base spans leave of a candidate
cutting AS (
  SELECT c.cid, b.s, b.e, coalesce(max(b.e) OVER (PARTITION BY c.cid ORDER BY b.s, b.k, b.e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), c.s) AS upto
  FROM candidate c JOIN base b ON b.rid = c.rid AND b.s < c.e AND c.s < b.e
),
remainder AS (
  SELECT cid, greatest(upto, (SELECT s FROM candidate d WHERE d.cid = cutting.cid)) AS s, s AS e FROM cutting
  UNION ALL
  SELECT c.cid, greatest(c.s, coalesce(max(b.e), c.s)), c.e FROM candidate c LEFT JOIN cutting b ON b.cid = c.cid GROUP BY c.cid, c.s, c.e
),
free AS (
  SELECT c.rid, c.k, r.s, r.e, substr(c.v, (r.s - c.s + 1)::BIGINT, (r.e - r.s)::BIGINT) AS v
  FROM remainder r JOIN candidate c ON c.cid = r.cid WHERE r.e - r.s >= {secrets.WINDOW}
),
plain AS (SELECT DISTINCT v, {_PLAIN} AS p FROM free),
part AS (
  SELECT v, p, unnest(xs) AS x, unnest(range(len(xs))) AS i FROM (SELECT v, p, regexp_extract_all(p, {_quoted(secrets.PART)}) AS xs FROM plain)
),
judged AS (SELECT *, x IN ({_SIGN_LIST}) AS sign, {_IS_WORD} AS word FROM part),
shape AS (
  SELECT v, p, 2 * coalesce(sum(len(x)) FILTER (WHERE NOT sign AND NOT word), 0) > coalesce(sum(len(x)) FILTER (WHERE NOT sign), 0) AS whole,
         string_agg(CASE WHEN NOT sign AND len(x) >= {secrets.LONG_WORD} AND word THEN ' ' ELSE x END, '' ORDER BY i) AS rest
  FROM judged GROUP BY v, p
),
piece AS (
  SELECT v, unnest(CASE WHEN whole THEN [p] ELSE list_transform(string_split(rest, ' '), lambda y: trim(y, '+/_=-')) END) AS w FROM shape
),
form AS (
  SELECT DISTINCT w FROM piece WHERE len(w) >= {secrets.WINDOW}
),
odd AS (
  SELECT DISTINCT w FROM (SELECT w, unnest(regexp_extract_all(w, {_quoted(secrets.PART)})) AS x FROM form)
  WHERE x NOT IN ({_SIGN_LIST}) AND NOT {_IS_WORD}
),
place AS (SELECT w, unnest(range(0, len(w) - {secrets.WINDOW - 1})) AS pos FROM odd),
letter AS (SELECT w, pos, substr(w, pos::BIGINT + 1 + j::BIGINT, 1) AS c FROM place, range(0, {secrets.WINDOW}) r(j)),
counted AS (SELECT w, pos, c, count(*) AS n FROM letter GROUP BY w, pos, c),
entropy AS (
  SELECT w, pos, log2({secrets.WINDOW}) - sum(n * log2(n)) / {secrets.WINDOW} AS bits FROM counted GROUP BY w, pos
),
high AS (SELECT w FROM entropy GROUP BY w HAVING round(max(bits), 9) >= {_CLASS_BITS}),
bad AS (SELECT DISTINCT v FROM piece WHERE w IN (SELECT w FROM high)),
spans AS (
  SELECT rid, k, s, e FROM base
  UNION ALL SELECT rid, k, s, e FROM free WHERE v IN (SELECT v FROM bad)
),
per_doc AS (
  SELECT rid, count(*) FILTER (WHERE k = 0) AS n_assign, count(*) FILTER (WHERE k = 1) AS n_access,
         count(*) FILTER (WHERE k = 2) AS n_hex, {_RENDER} FILTER (WHERE k < 3) AS base, {_RENDER} AS spans
  FROM spans GROUP BY rid
)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(p.base, '')) AS base_sha256, coalesce(p.spans, '') AS spans
FROM docs d LEFT JOIN per_doc p ON p.rid = d.rid
"""

OP11 = """
WITH usable AS (
  SELECT row_number() OVER () AS rid, vec_id,
         CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label::BIGINT END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scored AS (
  SELECT a.rid AS anchor, a.vec_id AS anchor_id, c.rid, c.vec_id, a.label = c.label AS same,
         list_inner_product(a.v, c.v)::BIGINT AS score
  FROM usable a JOIN usable c ON a.rid <> c.rid AND len(a.v) = len(c.v) WHERE a.vec_id % 100 = 0
),
positive AS (
  SELECT * FROM scored WHERE same QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id NULLS LAST, rid) <= 5
)
SELECT p.anchor_id, p.vec_id AS positive_id, row_number() OVER best AS rank, n.vec_id AS negative_id,
       p.score AS positive_score, n.score AS negative_score
FROM positive p JOIN scored n ON n.anchor = p.anchor AND NOT n.same
  AND 30 * p.score <= 100 * n.score AND 100 * n.score <= 90 * p.score
WINDOW best AS (PARTITION BY p.anchor, p.rid ORDER BY n.score DESC, n.vec_id NULLS LAST, n.rid)
QUALIFY rank <= 10
"""

_SQL_WEIGHT = "CASE (row_number() OVER (ORDER BY src NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END"

OP13 = rf"""
WITH RECURSIVE docs AS (
  SELECT row_number() OVER () AS rid, doc_id, source AS src, len(regexp_extract_all(coalesce(text, ''), '{_WORD}'))::BIGINT AS size,
         (('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, ''))), 1, 13))::BIGINT + 0.5)
           / 4503599627370496.0::DOUBLE AS u
  FROM documents
),
source AS (
  SELECT src, sum(size)::BIGINT AS source_size, {_SQL_WEIGHT} AS weight FROM docs GROUP BY src
),
-- targets as stated: share, stop pos three times the size, share the excess again
shares AS (
  SELECT 0::BIGINT AS round, src, source_size, weight, false AS "full" FROM source
  UNION ALL
  SELECT round + 1, src, source_size, weight, "full" OR
         ((SELECT sum(source_size) FROM source) - sum(CASE WHEN "full" THEN 3 * source_size ELSE 0 END) OVER ()) * weight
           >= 3 * source_size::HUGEINT * sum(CASE WHEN "full" THEN 0 ELSE weight END) OVER ()
  FROM shares WHERE round < (SELECT count(*) FROM source)
),
target AS (
  SELECT src, source_size, CASE WHEN "full" THEN (3 * source_size)::DOUBLE ELSE
         (((SELECT sum(source_size) FROM source) - sum(CASE WHEN "full" THEN 3 * source_size ELSE 0 END) OVER ()) * weight)::DOUBLE
           / (sum(CASE WHEN "full" THEN 0 ELSE weight END) OVER ())::DOUBLE END AS target
  FROM shares WHERE round = (SELECT count(*) FROM source)
),
stratum AS (
  SELECT src, cls, sum(size) AS words, CASE WHEN cls = 0 THEN 0.0::DOUBLE ELSE sqrt(sqrt(pow(2.0::DOUBLE, cls))) END AS tilt
  FROM (SELECT src, size, CASE WHEN size > 0 THEN length(bin(size)) ELSE 0 END AS cls FROM docs) GROUP BY src, cls
),
factor AS (
  SELECT s.*, t.source_size, t.target,
         (target - 3 * coalesce(sum(words) OVER (PARTITION BY s.src ORDER BY cls DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
           / nullif(sum(tilt * words) OVER (PARTITION BY s.src ORDER BY cls DESC ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), 0) AS f
  FROM stratum s JOIN target t ON s.src IS NOT DISTINCT FROM t.src
),
capped AS (
  SELECT *, target >= 3 * source_size OR f * tilt >= 3 AS "full" FROM factor
),
copies AS (
  SELECT *, CASE WHEN words = 0 THEN 0.0 WHEN "full" THEN 3.0
                 ELSE least(3.0, tilt * arg_max(f, cls) FILTER (WHERE NOT "full" AND tilt > 0) OVER (PARTITION BY src)) END AS n FROM capped
),
plan AS (
  SELECT *, n - floor(n) AS p, target - sum(floor(n) * words) OVER (PARTITION BY src) AS rest FROM copies
),
ranked AS (
  SELECT d.*, c.source_size, c.target, floor(c.n)::BIGINT AS whole, c.rest,
         CASE WHEN c.p > 0 AND d.size > 0 THEN (u / (1 - u)) * ((1 - c.p) / c.p) END AS q
  FROM docs d JOIN plan c ON d.src IS NOT DISTINCT FROM c.src
    AND c.cls = CASE WHEN d.size > 0 THEN length(bin(d.size)) ELSE 0 END
),
placed AS (SELECT *, least(floor(q / (1 + q) * 281474976710656.0::DOUBLE), 281474976710655)::BIGINT AS pos FROM ranked),
summed AS (
  SELECT *, sum(size) OVER (PARTITION BY src ORDER BY pos) AS upto, sum(size) OVER (PARTITION BY src, pos) AS same_at FROM placed WHERE pos IS NOT NULL
),
fitting AS (
  SELECT *, upto < rest AS fits, rest - coalesce(max(CASE WHEN upto < rest THEN upto END) OVER (PARTITION BY src), 0) AS gap FROM summed
),
last AS (
  SELECT src, arg_min(pos, (abs(size - gap), pos)) AS pos FROM fitting WHERE NOT fits AND abs(size - gap) < gap GROUP BY src
),
drawn AS (
  SELECT rid FROM fitting f LEFT JOIN last l ON l.src IS NOT DISTINCT FROM f.src WHERE fits OR f.pos = l.pos
)
SELECT p.doc_id, p.size, p.source_size, p.target,
       p.size * CASE WHEN p.size = 0 THEN 0 ELSE p.whole + (d.rid IS NOT NULL)::BIGINT END AS taken
FROM placed p LEFT JOIN drawn d ON d.rid = p.rid
"""

ORACLES: dict[str, str] = {
    "op3_line_dedup": OP3,
    "op5_near_duplicates": OP5,
    "op7_quality_rules": OP7,
    "op8_embedding_dedup": OP8,
    "op9_secret_scan": OP9,
    "op11_hard_negatives": OP11,
    "op13_source_mix": OP13,
}
