"""DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations

from . import quality_rules, secrets

WORDS = r"[^\x20\x09-\x0D]+"

_REACH = """
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT {id} AS node, {id} AS reach FROM {table} UNION SELECT r.node, e.b FROM r JOIN e ON e.a = r.reach)"""

OP1 = rf"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORDS}') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g FROM d, LATERAL (SELECT unnest(generate_series(1, greatest(len(w) - 4, 1))) AS i) WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 80 * (x.n + y.n - k)),
{_REACH.format(id="doc_id", table="documents")}
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, c.component_id FROM documents d LEFT JOIN n USING (doc_id) JOIN (SELECT node, min(reach) AS component_id FROM r GROUP BY node) c ON c.node = d.doc_id
"""

OP8 = f"""
WITH RECURSIVE v AS (SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings),
u AS (SELECT vec_id, label, v, sqrt(list_inner_product(v, v)) AS norm FROM v WHERE label IS NOT NULL AND len(v) > 0 AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(v, lambda x: x <> 0)) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.label = b.label AND a.vec_id < b.vec_id AND len(a.v) = len(b.v) WHERE list_inner_product(a.v, b.v) / (a.norm * b.norm) >= 0.98),
{_REACH.format(id="vec_id", table="embeddings")},
c AS (SELECT node, min(reach) AS component_id FROM r GROUP BY node), k AS (SELECT a, count(*) AS n FROM e GROUP BY a)
SELECT m.vec_id, coalesce(k.n, 0)::BIGINT AS n_links, c.component_id, c.component_id = m.vec_id AS kept FROM embeddings m JOIN c ON c.node = m.vec_id LEFT JOIN k ON k.a = m.vec_id
"""

_RATES = ", ".join(
    f"('{name}', {'1000000 * (' + a + ' + 1) // (' + b + ' + 1)' if name != 'word_length' else '1000 * word_chars // greatest(n_words, 1)'}, {quality_rules.FENCE[name]})"
    for name, a, b in (("symbols", "n_symbols", "word_chars"), ("dup_lines", "n_dup_lines", "n_lines"), ("repeats", "n_repeat_words", "n_words"), ("capitals", "n_capitals", "word_chars"), ("word_length", "word_chars", "n_words"))
)

OP4 = rf"""
WITH d AS (SELECT doc_id, lang, source, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, '{WORDS}') AS words, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
t AS (SELECT doc_id, i, words[i:i + 2] AS g FROM w, LATERAL (SELECT unnest(generate_series(1, len(words) - 2)) AS i)),
a AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM t),
h AS (SELECT doc_id, count(DISTINCT j) AS n FROM a, LATERAL (SELECT unnest([i, i + 1, i + 2]) AS j) WHERE n > 1 GROUP BY doc_id),
c AS (SELECT w.doc_id, lang, source, len(words)::BIGINT AS n_words, length(array_to_string(words, ''))::BIGINT AS word_chars, len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols, len(regexp_extract_all(text, '[A-Z]'))::BIGINT AS n_capitals,
       len(lines)::BIGINT AS n_lines, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(h.n, 0)::BIGINT AS n_repeat_words FROM w LEFT JOIN h USING (doc_id)),
b AS (SELECT *, n_words < 50 OR n_repeat_words * 100 > n_words * 50 AS base_failed FROM c),
v AS (SELECT b.*, x.rate, x.v, x.fence, x.v - x.v % (2 ** greatest(length(bin(x.v)) - 7, 0))::BIGINT AS bucket FROM b, LATERAL (VALUES {_RATES}) x(rate, v, fence)),
k AS (SELECT lang, source, rate, fence, bucket, count(*)::HUGEINT AS n FROM v WHERE NOT base_failed GROUP BY ALL),
kl AS (SELECT lang, rate, bucket, sum(n)::HUGEINT AS n FROM k GROUP BY ALL),
tl AS (SELECT lang, rate, sum(n)::HUGEINT AS n FROM kl GROUP BY ALL),
m AS (SELECT k.lang, k.source, k.rate, k.fence, k.bucket, k.n * tl.n AS w FROM k JOIN tl ON tl.rate = k.rate AND tl.lang IS NOT DISTINCT FROM k.lang
      UNION ALL SELECT g.lang, g.source, g.rate, g.fence, kl.bucket, kl.n * {quality_rules.PRIOR} FROM (SELECT DISTINCT lang, source, rate, fence FROM k) g JOIN kl ON kl.rate = g.rate AND kl.lang IS NOT DISTINCT FROM g.lang),
c2 AS (SELECT lang, source, rate, fence, bucket, sum(w)::HUGEINT AS w FROM m GROUP BY ALL),
r AS (SELECT *, sum(w) OVER (PARTITION BY lang, source, rate ORDER BY bucket) AS upto, sum(w) OVER (PARTITION BY lang, source, rate) AS total FROM c2),
q AS (SELECT lang, source, rate, fence, min(bucket) FILTER (upto * 4 >= total) AS low, min(bucket) FILTER (upto * 4 >= total * 3) AS high FROM r GROUP BY ALL),
t2 AS (SELECT *, high + fence * greatest(high - low, high // {quality_rules.WIDTH}, 1) AS threshold FROM q),
j AS (SELECT v.doc_id, bool_and(coalesce(v.v <= t2.threshold, false)) AS inside FROM v LEFT JOIN t2 ON t2.rate = v.rate AND t2.lang IS NOT DISTINCT FROM v.lang AND t2.source IS NOT DISTINCT FROM v.source GROUP BY v.doc_id)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND inside AS kept FROM b JOIN j USING (doc_id)
"""


def _spans(rank: int, pattern: str, keep: str) -> str:
    p = pattern.replace("'", "''")
    group = 2 if keep == "value" else 0
    good = {"value": "length(v[i]) >= 6", "mixed": "regexp_matches(m[i], '[0-9]') AND regexp_matches(m[i], '[A-Z]') AND regexp_matches(m[i], '[a-z]')", "": "true"}[keep]
    upto = "coalesce(list_sum(list_transform(g[1:i], lambda x: length(x))), 0) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0)"
    return f"""SELECT doc_id, {rank} AS rank, ({upto})::BIGINT AS s, ({upto})::BIGINT + length(m[i]) AS e FROM (
  SELECT doc_id, regexp_extract_all(text, '{p}', 0) AS m, regexp_extract_all(text, '{p}', {group}) AS v, string_split_regex(text, '{p}') AS g FROM d WHERE regexp_matches(text, '{p}')), LATERAL (SELECT unnest(generate_series(1, len(m))) AS i) WHERE {good}"""


_NEAR = f"o.doc_id = x.doc_id AND o.s <= x.e + {secrets.SCOPE} AND o.e >= x.s - {secrets.SCOPE}"
_KIND = "[" + ", ".join(f"'{k}'" for k in secrets.KINDS) + "]"

OP3 = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
b AS ({_spans(0, secrets.ASSIGN, "value")} UNION ALL {_spans(1, secrets.ACCESS, "")} UNION ALL {_spans(2, secrets.HEX, "")}),
x0 AS ({_spans(3, secrets.USER, "")} UNION ALL {_spans(4, secrets.RANDOM, "mixed")} UNION ALL {_spans(5, secrets.ENDPOINT, "")}),
x AS (SELECT * FROM x0 WHERE NOT EXISTS (SELECT 1 FROM b o WHERE o.doc_id = x0.doc_id AND o.s < x0.e AND x0.s < o.e)),
o AS (SELECT *, CASE WHEN rank IN (1, 3) THEN 'identifier' WHEN rank = 5 THEN 'endpoint' ELSE 'secret' END AS role FROM (SELECT * FROM b UNION ALL SELECT * FROM x)),
k AS (SELECT * FROM x WHERE CASE rank WHEN 3 THEN EXISTS (SELECT 1 FROM o WHERE {_NEAR} AND role = 'secret') WHEN 4 THEN EXISTS (SELECT 1 FROM o WHERE {_NEAR} AND role = 'identifier')
  ELSE EXISTS (SELECT 1 FROM o WHERE {_NEAR} AND role = 'secret') AND EXISTS (SELECT 1 FROM o WHERE {_NEAR} AND role = 'identifier') END),
f AS (SELECT *, true AS base FROM b UNION ALL SELECT *, false FROM k),
g AS (SELECT doc_id, count(*) FILTER (rank = 0) AS n_assign, count(*) FILTER (rank = 1) AS n_access, count(*) FILTER (rank = 2) AS n_hex, count(*) FILTER (NOT base) AS n_linked,
        string_agg({_KIND}[rank + 1] || ':' || s || ':' || e, ',' ORDER BY s, rank) FILTER (base) AS base_spans, string_agg({_KIND}[rank + 1] || ':' || s || ':' || e, ',' ORDER BY s, rank) AS spans FROM f GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access, coalesce(n_hex, 0)::BIGINT AS n_hex, sha256(coalesce(base_spans, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_linked, 0)::BIGINT AS n_linked FROM d LEFT JOIN g USING (doc_id)
"""
