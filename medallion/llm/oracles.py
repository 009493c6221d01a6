r"""DuckDB SQL of the registered corpus queries (same column names and rows).

Language ID, SimHash, BPE (op3 and the ids of op13), pseudonyms and toxicity need trained models,
vocabularies or hashes that SQL lacks, and periodic runs over whole texts are too slow in it; their
tests hold them against brute force.
"""
from __future__ import annotations

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

OP2 = """
WITH RECURSIVE u AS (
  SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings),
ok AS (
  SELECT vec_id, v FROM u WHERE v IS NOT NULL AND len(v) > 0 AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(v, lambda x: x <> 0)) > 0),
link AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= 0.95),
reach AS (SELECT a, b FROM link UNION SELECT r.a, l.b FROM reach r JOIN link l ON l.a = r.b)
SELECT vec_id, (SELECT count(*) FROM link WHERE a = vec_id) AS n_links,
       least(vec_id, coalesce((SELECT min(b) FROM reach WHERE a = vec_id), vec_id)) AS component_id,
       vec_id = least(vec_id, coalesce((SELECT min(b) FROM reach WHERE a = vec_id), vec_id)) AS kept
FROM u
"""

OP4 = rf"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, lang, source, coalesce(text, '') AS t, {_WORDS} AS w FROM documents),
g AS (
  SELECT rid, i, concat_ws(' ', w[i], w[i + 1], w[i + 2]) AS gram
  FROM (SELECT rid, w, unnest(range(1, len(w) - 1)) AS i FROM d)),
again AS (SELECT rid, gram FROM g GROUP BY rid, gram HAVING count(*) > 1),
covered AS (
  SELECT rid, count(DISTINCT i + k) AS n FROM g JOIN again USING (rid, gram), (SELECT unnest([0, 1, 2]) AS k) GROUP BY rid),
f AS (
  SELECT rid, doc_id, lang, source, len(w)::BIGINT AS n_words,
    length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
    len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols,
    len(lines)::BIGINT AS n_lines, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
    coalesce(n, 0)::BIGINT AS n_repeat_words
  FROM (SELECT *, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d)
  LEFT JOIN covered USING (rid)),
r AS (
  SELECT rid, lang, source, unnest(['symbol_ratio', 'repeat_ratio', 'dup_line_ratio', 'word_length']) AS metric,
    unnest([CASE WHEN word_chars > 0 THEN n_symbols / word_chars ELSE 0 END,
            CASE WHEN n_words > 0 THEN n_repeat_words / n_words ELSE 0 END,
            CASE WHEN n_lines > 0 THEN n_dup_lines / n_lines ELSE 0 END,
            CASE WHEN n_words > 0 THEN word_chars / n_words ELSE 0 END]::DOUBLE[]) AS v FROM f),
b AS (
  SELECT *, CASE WHEN v * 1000 <= 1 THEN 0 ELSE pow(1.05, ceil(ln(v * 1000) / ln(1.05))) / 1000 END AS edge FROM r),
q AS (
  SELECT *, quantile_disc(edge, 0.25) OVER o AS q1, quantile_disc(edge, 0.75) OVER o AS q3, count(*) OVER o AS n,
    quantile_disc(edge, 0.25) OVER l AS l1, quantile_disc(edge, 0.75) OVER l AS l3, count(*) OVER l AS nl,
    quantile_disc(edge, 0.25) OVER a AS a1, quantile_disc(edge, 0.75) OVER a AS a3
  FROM b WINDOW o AS (PARTITION BY metric, lang, source), l AS (PARTITION BY metric, lang), a AS (PARTITION BY metric)),
p AS (
  SELECT rid, metric, v, CASE WHEN n >= 50 THEN q1 WHEN nl >= 50 THEN l1 ELSE a1 END AS p1,
    CASE WHEN n >= 50 THEN q3 WHEN nl >= 50 THEN l3 ELSE a3 END AS p3,
    CASE metric WHEN 'symbol_ratio' THEN 0.01 WHEN 'repeat_ratio' THEN 0.1 WHEN 'dup_line_ratio' THEN 0.2 ELSE 1.0 END AS low
  FROM q),
k AS (SELECT rid, bool_and(v <= p3 + 3 * greatest(p3 - p1, low)) AS within FROM p GROUP BY rid)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND within AS kept
FROM f JOIN k USING (rid)
"""

_CONTROL = r"\\|\[INST\]|\[/INST\]|<s>|</s>|<<SYS>>|<</SYS>>|\[MSG\]|\[ROLE\]|\[/MSG\]"

OP5 = rf"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (
  SELECT *, length(text) + len(regexp_extract_all(text, '{_CONTROL}')) + CASE role WHEN 'user' THEN 15 WHEN 'assistant' THEN 9
    WHEN 'system' THEN 17 ELSE 21 + length(role) + len(regexp_extract_all(role, '{_CONTROL}')) END AS chars FROM c)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(chars)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
"""


def _draw(node: str, weight: str) -> str:
    return f"-ln((('0x' || substr(md5(key || '/' || {node}), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0) / {weight}"


def _descent(name: str, regions: str) -> str:
    """Shard of each row under a tree of two racks of four in a region, and maybe a region of one shard."""
    return f"""
{name}_g AS (SELECT key, arg_min(n, {_draw('n', 'w')}) AS g FROM (SELECT DISTINCT key FROM d), ({regions}) GROUP BY key),
{name}_r AS (SELECT key, any_value(g) AS g, arg_min(r, {_draw('r', '4.0')}) AS r
  FROM (SELECT key, g, unnest(CASE WHEN g LIKE 'new%' THEN [g || 'r0'] ELSE [g || 'r0', g || 'r1'] END) AS r FROM {name}_g) GROUP BY key),
{name} AS (SELECT key, arg_min(s, {_draw("(r || 's' || s)", '1.0')}) AS shard FROM (
  SELECT key, r, unnest(CASE WHEN g LIKE 'new%' THEN [16]
    ELSE range(substr(g, 2)::INT * 8 + right(r, 1)::INT * 4, substr(g, 2)::INT * 8 + right(r, 1)::INT * 4 + 4) END) AS s
  FROM {name}_r) GROUP BY key)"""


OP6 = f"""
WITH RECURSIVE bit AS (
  SELECT i, i AS c, 0 AS k FROM range(256) t(i)
  UNION ALL SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM bit WHERE k < 8),
step AS (SELECT list(c ORDER BY i) AS t FROM bit WHERE k = 8),
d AS (
  SELECT doc_id, coalesce('i' || doc_id::VARCHAR, 't' || text, 'n') AS key, coalesce(text, '') AS text FROM documents),
b AS (SELECT *, list_transform(regexp_extract_all(hex(encode(text)), '..'), lambda x: ('0x' || x)::BIGINT) AS bytes FROM d),
c AS (
  SELECT doc_id, key, len(bytes)::BIGINT + 1 AS size,
    xor(list_reduce(bytes, lambda a, x: xor(a >> 8, t[(xor(a, x) & 255) + 1]), 4294967295::BIGINT), 4294967295) AS text_crc32
  FROM b, step),
{_descent('own', "SELECT 'g0' AS n, 8.0 AS w UNION ALL SELECT 'g1', 8.0")},
{_descent('grown', "SELECT 'g0' AS n, 8.0 AS w UNION ALL SELECT 'g1', 8.0 UNION ALL SELECT 'new16', 1.0")}
SELECT doc_id, size, text_crc32, 'key' AS law, own.shard::INT AS shard,
  row_number() OVER (PARTITION BY own.shard ORDER BY md5(c.key), doc_id, size, text_crc32) - 1 AS slot,
  grown.shard::INT AS grown_shard
FROM c JOIN own USING (key) JOIN grown USING (key)
"""

def _rounds(n: int) -> str:
    """Rows in hash order that fit into the gap; the first that does not is the next bound, what is open the next gap."""
    out = ""
    for k in range(1, n + 1):
        before = "r" if k == 1 else f"r{k - 1}"
        cap = "true" if k == 1 else f"size <= gap{k - 1}"
        out += f""", e{k} AS (
  SELECT rid, sum(size) OVER (PARTITION BY source ORDER BY h RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto{k}
  FROM {before} WHERE h > bound{k - 1} AND {cap}),
r{k} AS (
  SELECT {before}.*, coalesce(upto{k} <= gap{k - 1}, false) AS in{k},
    gap{k - 1} - coalesce(max(upto{k}) FILTER (upto{k} <= gap{k - 1}) OVER (PARTITION BY source), 0) AS gap{k},
    coalesce(min(h) FILTER (upto{k} > gap{k - 1}) OVER (PARTITION BY source), 'g') AS bound{k}
  FROM {before} LEFT JOIN e{k} USING (rid))"""
    return out


OP10 = f"""
WITH d AS (
  SELECT doc_id, source, len({_WORDS})::BIGINT AS size,
    substr(md5('mix' || coalesce('i' || doc_id::VARCHAR, 't' || text, 'n')), 1, 15) AS h FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (
  SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS k, [1, 2, 3][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight,
    3 * source_size AS most FROM s),
c AS (
  SELECT *, coalesce(sum(most) OVER b, 0) AS capped, coalesce(sum(weight) OVER b, 0) AS used, sum(source_size) OVER () AS total,
    sum(weight) OVER () AS weights
  FROM w WINDOW b AS (ORDER BY most / weight, k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
a AS (SELECT *, (total - capped)::DOUBLE / (weights - used)::DOUBLE AS lev FROM c),
l AS (SELECT *, (SELECT arg_min(lev, used) FROM a WHERE lev * weight <= most) AS level FROM a),
p AS (
  SELECT source, source_size, least(most::DOUBLE, coalesce(level, 0) * weight) AS target,
    CASE WHEN source_size > 0 THEN floor(least(most::DOUBLE, coalesce(level, 0) * weight) / source_size) ELSE 0 END::BIGINT AS whole FROM l),
r AS (
  SELECT row_number() OVER () AS rid, d.*, p.source_size, p.target, p.whole, p.target - p.whole * p.source_size AS gap0,
    '' AS bound0 FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source)
{_rounds(3)}
SELECT doc_id, source, size, source_size, target,
  (size * (whole + CASE WHEN in1 OR in2 OR in3 THEN 1 ELSE 0 END))::BIGINT AS taken
FROM r3
"""



def _round(r: int) -> str:
    """Assignment of all vectors to the centroids of round ``r``, and the centroids of the next one."""
    return f"""
d{r} AS (
  SELECT rid, c, list_sum(list_transform(range(1, 65), lambda i: (v[i] - x[i]) * (v[i] - x[i])))::BIGINT AS d
  FROM kept, c{r}),
a{r} AS (SELECT rid, arg_min(c, d * 16 + c) AS c, min(d) AS d FROM d{r} GROUP BY rid),
s{r} AS (
  SELECT c, i, sum(v[i])::BIGINT AS s, count(*) AS n
  FROM a{r} JOIN kept USING (rid), range(1, 65) t(i) GROUP BY c, i),
c{r + 1} AS (
  SELECT c, coalesce(m.x, c{r}.x) AS x FROM c{r} LEFT JOIN (
    SELECT c, list((s - ((s % n) + n) % n) // n ORDER BY i) AS x FROM s{r} GROUP BY c) m USING (c))"""


OP12 = f"""
WITH kept AS (
  SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c0 AS (
  SELECT row_number() OVER (ORDER BY h, v) - 1 AS c, v AS x FROM (
    SELECT v, sha256('1:' || vec_id::VARCHAR) AS h FROM kept ORDER BY h, v LIMIT 16)),
{",".join(_round(r) for r in range(4))}
SELECT vec_id, c::INT AS cluster, d AS distance, sum(d) OVER (PARTITION BY c)::BIGINT AS cluster_inertia,
       sum(d) OVER ()::BIGINT AS inertia, sha256(array_to_string(c3.x, ',')) AS centroid_sha256
FROM a3 JOIN kept USING (rid) JOIN c3 USING (c)
"""

SQL: dict[str, str] = {"op2_embedding_dedup": OP2, "op4_quality": OP4, "op5_chat": OP5, "op6_sharding": OP6,
                       "op10_mixing": OP10, "op12_centroids": OP12}
