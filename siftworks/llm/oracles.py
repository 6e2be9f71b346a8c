"""DuckDB statements that give the rows of the queries that SQL can express."""

from __future__ import annotations

from siftworks.llm import licenses, quality
from siftworks.llm.license_texts import NOTICES, TEXTS
from siftworks.llm.text import LOWER, UPPER

BLANK = "(chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))"
RUN = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def lowered(x: str) -> str:
    return f"translate({x}, '{UPPER}', '{LOWER}')"


LINE_DEDUP = f"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT r, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos FROM d),
k AS MATERIALIZED (SELECT *, {lowered(f"trim(line, {BLANK})")} AS key FROM l),
f AS (SELECT key FROM k WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT r) >= 10),
kept AS (SELECT r, string_agg(line, chr(10) ORDER BY pos) AS text, count(*) AS n FROM k WHERE key NOT IN (SELECT key FROM f) GROUP BY r)
SELECT doc_id, len(ls)::BIGINT AS n_lines, (len(ls) - coalesce(n, 0))::BIGINT AS n_dropped, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (r)
"""

MIXING = f"""
WITH k AS MATERIALIZED (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}'))::BIGINT AS size,
        md5(concat_ws('-', '42', coalesce(doc_id::VARCHAR, ''), md5(coalesce(text, '')))) AS key
    FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM k GROUP BY source),
w AS (SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS w, 3 * source_size AS cap FROM s),
v AS (SELECT *, sum(source_size) OVER () AS total, sum(w) OVER () AS all_w,
        coalesce(sum(cap) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS caps,
        coalesce(sum(w) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ws FROM w),
x AS (SELECT *, (total - caps)::DOUBLE / (all_w - ws)::DOUBLE AS level FROM v),
y AS (SELECT *, max(level) FILTER (WHERE cap / w > level) OVER () AS last FROM x),
t AS MATERIALIZED (SELECT source, source_size, CASE WHEN last IS NULL THEN cap::DOUBLE ELSE least(cap::DOUBLE, last * w) END AS target FROM y),
b AS (SELECT k.*, source_size, target, round(target)::BIGINT AS budget,
        coalesce(sum(size) OVER (PARTITION BY k.source ORDER BY key, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
    FROM k JOIN t ON k.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
    CASE WHEN source_size = 0 THEN 0::BIGINT ELSE
        (size * (budget // source_size) + greatest(0, least(size, budget % source_size - before)))::BIGINT END AS taken
FROM b
"""

_BITS = " + ".join(f"CASE WHEN {rule} THEN {1 << i} ELSE 0 END" for i, rule in enumerate(quality.RULES.values()))

QUALITY_LEDGER = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
a AS MATERIALIZED (SELECT r, doc_id, regexp_extract_all(t, '{WORD}') AS ws, regexp_replace(t, '{RUN}', '', 'g') AS bare,
    list_filter(string_split(t, chr(10)), lambda x: trim(x, {BLANK}) <> '') AS ls FROM d),
g AS (SELECT r, unnest(list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2])) AS g,
    unnest(range(1, len(ws) - 1)) AS i FROM a WHERE len(ws) >= 3),
c AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM g) WHERE n > 1),
n AS (SELECT r, count(DISTINCT i + o) AS n FROM c, (VALUES (0), (1), (2)) AS z(o) GROUP BY r),
m AS (SELECT doc_id, len(ws)::BIGINT AS n_words, length(bare)::BIGINT AS word_chars,
    length(regexp_replace(bare, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols, len(ls)::BIGINT AS n_text_lines,
    (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(n.n, 0)::BIGINT AS n_repeat_words,
    length(regexp_replace(bare, '\PL+', '', 'g'))::BIGINT AS n_letters FROM a LEFT JOIN n USING (r)),
f AS (SELECT *, ({_BITS})::BIGINT AS failed FROM m)
"""

QUALITY = QUALITY_LEDGER + f"""
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, failed & {quality.BASE.mask} <> 0 AS base_failed,
    failed & {quality.WEB.mask} = 0 AS kept, failed FROM f
"""

_RULE_BITS = ", ".join(f"('{rule}', {1 << quality.bit(rule)})" for rule in quality.WEB.rules)
QUALITY_ABLATIONS = QUALITY_LEDGER + f"""
SELECT rule, count(*) FILTER (WHERE failed & b <> 0) AS n_failed, count(*) FILTER (WHERE failed = b) AS n_alone,
    count(*) FILTER (WHERE failed & ~b = 0) AS kept_without
FROM f, (VALUES {_RULE_BITS}) AS z(rule, b) GROUP BY rule
"""


def _escaped(x: str, role: bool = False) -> str:
    out = f"replace(replace(replace({x}, '\\', '\\\\'), '#', '\\h'), '<', '\\l')"
    return f"replace({out}, ':', '\\c')" if role else out


CHAT = f"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '\\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\\### Assistant: </turn> ok'),
g AS (SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS turns,
    coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '') AS loss,
    sum(length('### ' || {_escaped('role', True)} || ': ' || {_escaped('text')} || '</turn>' || chr(10)))::BIGINT AS formatted_chars
    FROM c GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss)::BIGINT AS loss_chars, sha256(loss) AS loss_sha256, formatted_chars FROM g
"""


def _canonical(x: str) -> str:
    out = lowered(x)
    for found, put in licenses.SPELLINGS.items():
        out = f"replace({out}, '{found}', '{put}')"
    lines = f"string_split({out}, chr(10))"
    kept = f"list_transform({lines}, lambda v: CASE WHEN regexp_full_match(v, '{licenses.COPYRIGHT}') THEN '' ELSE v END)"
    return f"trim(regexp_replace(array_to_string({kept}, chr(10)), '[^a-z0-9\\x{{80}}-\\x{{10ffff}}]+', ' ', 'g'), {BLANK})"


def _values(texts: dict[str, str]) -> str:
    quoted = [f"('{name}', '{body.replace(chr(39), chr(39) * 2)}')" for name, body in texts.items()]
    return f"(SELECT md5({_canonical('body')}) AS digest, min(license) AS license FROM (VALUES {', '.join(quoted)}) AS z(license, body) GROUP BY 1)"


LICENSES = f"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
k AS {_values(TEXTS)}, o AS {_values(NOTICES)},
l AS (SELECT r, unnest(string_split(t, chr(10))) AS line, generate_subscripts(string_split(t, chr(10)), 1) AS pos FROM d),
h AS (SELECT r, license, min(pos) AS pos FROM l JOIN o ON md5({_canonical('line')}) = o.digest GROUP BY r, license),
n AS (SELECT r, string_agg(license, ',' ORDER BY pos) AS notices FROM h GROUP BY r),
w AS (SELECT r, doc_id, md5({_canonical('t')}) AS digest FROM d)
SELECT doc_id, digest, license, coalesce(notices, '') AS notices FROM w LEFT JOIN k USING (digest) LEFT JOIN n USING (r)
"""

TOP_K = """
WITH e AS (SELECT row_number() OVER () AS r, vec_id, embedding FROM embeddings
    WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
v AS MATERIALIZED (SELECT r, vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v FROM e),
p AS (SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score FROM v q JOIN v c ON q.r <> c.r WHERE q.vec_id % 20 = 0),
o AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM p)
SELECT query_id, rank, vec_id, score FROM o WHERE rank <= 20
"""

MERKLE = """
WITH RECURSIVE
d AS MATERIALIZED (
    SELECT doc_id, lang,
        CASE WHEN doc_id IS NULL THEN '-' ELSE strlen(doc_id::VARCHAR) || ':' || doc_id END
            || CASE WHEN source IS NULL THEN '-' ELSE strlen(source) || ':' || source END
            || CASE WHEN lang IS NULL THEN '-' ELSE strlen(lang) || ':' || lang END AS head,
        n_chars, CASE WHEN text IS NULL THEN '-' ELSE strlen(text) || ':' || text END AS tail,
        -- each byte of the decimal id, then seven zeros: one step of the CRC per bit
        flatten(list_transform(string_split(doc_id::VARCHAR, ''), lambda c: [ascii(c)::BIGINT, 0, 0, 0, 0, 0, 0, 0])) AS bits
    FROM documents),
c AS (SELECT *, xor(list_reduce(bits, lambda c, e: xor(xor(c, e) >> 1, 3988292384 * (xor(c, e) & 1)), 4294967295::BIGINT), 4294967295) AS crc FROM d),
l AS MATERIALIZED (
    SELECT doc_id, lang, sha256(head || CASE WHEN n_chars IS NULL THEN '-' ELSE strlen(n_chars::VARCHAR) || ':' || n_chars END || tail) AS leaf,
        CASE WHEN crc % 7 = 0 THEN
            sha256(head || CASE WHEN n_chars IS NULL THEN '-' ELSE strlen((n_chars + 1)::VARCHAR) || ':' || (n_chars + 1) END || tail) END AS changed
    FROM c),
r AS MATERIALIZED (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS rank, count(*) OVER (PARTITION BY lang) AS n FROM l),
t(lang, level, pos, h, n) AS (
    SELECT lang, 0, rank, leaf, n FROM r
    UNION ALL
    SELECT lang, level + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), (n + 1) // 2 FROM t WHERE n > 1 GROUP BY lang, level, pos // 2, n),
s AS MATERIALIZED (SELECT lang, h, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS rank, count(*) OVER () AS n FROM t WHERE n = 1),
u(level, pos, h, n) AS (
    SELECT 0, rank, h, n FROM s
    UNION ALL
    SELECT level + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), (n + 1) // 2 FROM u WHERE n > 1 GROUP BY level, pos // 2, n),
low AS (
    SELECT r.doc_id, r.lang, r.rank, t.level, r.rank >> t.level AS p, coalesce(o.h, '') AS h
    FROM r JOIN (SELECT DISTINCT lang, level FROM t WHERE n > 1) AS t ON r.lang IS NOT DISTINCT FROM t.lang
    LEFT JOIN t AS o ON o.lang IS NOT DISTINCT FROM r.lang AND o.level = t.level AND o.pos = xor(r.rank >> t.level, 1)),
high AS (
    SELECT s.lang, v.level, s.rank >> v.level AS p, coalesce(o.h, '') AS h
    FROM s CROSS JOIN (SELECT DISTINCT level FROM u WHERE n > 1) AS v LEFT JOIN u AS o ON o.level = v.level AND o.pos = xor(s.rank >> v.level, 1)),
lows AS (
    SELECT lang, rank, list(CASE WHEN p % 2 = 1 THEN h || '|' ELSE '|' || h END ORDER BY level) AS steps FROM low GROUP BY lang, rank),
highs AS (SELECT lang, list(CASE WHEN p % 2 = 1 THEN h || '|' ELSE '|' || h END ORDER BY level) AS steps FROM high GROUP BY lang),
p AS (
    SELECT r.*, s.h AS subroot, (SELECT h FROM u WHERE n = 1) AS root,
        list_concat(coalesce(lows.steps, []::VARCHAR[]), coalesce(highs.steps, []::VARCHAR[])) AS steps
    FROM r JOIN s ON r.lang IS NOT DISTINCT FROM s.lang
    LEFT JOIN lows ON r.lang IS NOT DISTINCT FROM lows.lang AND r.rank = lows.rank
    LEFT JOIN highs ON r.lang IS NOT DISTINCT FROM highs.lang),
f AS (
    SELECT doc_id, leaf, subroot, root, sha256(replace(array_to_string(steps, ''), '|', '')) AS proof_sha256,
        list_reduce(steps, lambda h, x: sha256(split_part(x, '|', 1) || h || split_part(x, '|', 2)), coalesce(changed, leaf)) AS folded_root
    FROM p)
SELECT *, folded_root = root AS verified FROM f
"""

ORACLES = {
    "op1_line_dedup": LINE_DEDUP,
    "op3_top_k": TOP_K,
    "op4_mixing": MIXING,
    "op5_quality": QUALITY,
    "quality_ablations": QUALITY_ABLATIONS,
    "op6_chat": CHAT,
    "op7_licenses": LICENSES,
    "op13_merkle": MERKLE,
}
