"""DuckDB SQL for the queries of this subpackage, where SQL can express them."""

from __future__ import annotations

from millrace.llm.secrets import BASE, MORE


def _secrets() -> str:
    q = lambda s: "'" + s.replace("'", "''") + "'"
    parts = []
    for rank, r in enumerate(BASE + MORE):
        parts.append(
            f"SELECT doc_id, {rank} AS rank, '{r.kind}' AS kind, {str(r.base).lower()} AS base, {r.least} AS least, "
            f"unnest(list_zip(string_split_regex(t, {q(r.pattern)})[:-2], regexp_extract_all(t, {q(r.pattern)}, 0), "
            f"regexp_extract_all(t, {q(r.pattern)}, {r.group}), range(len(regexp_extract_all(t, {q(r.pattern)}, 0))))) AS m FROM d"
        )
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
m AS ({' UNION ALL '.join(parts)}),
s AS (SELECT doc_id, rank, kind, base, length(m[3]) >= least AS ok, length(m[2]) AS len,
  CAST(sum(length(m[1]) + length(m[2])) OVER (PARTITION BY doc_id, rank ORDER BY m[4]) AS BIGINT) AS stop FROM m),
f AS (SELECT doc_id, rank, kind, base, stop - len AS start, stop FROM s WHERE ok),
g AS (SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
  count(*) FILTER (kind = 'hex') AS n_hex,
  string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank) FILTER (base) AS b,
  string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank) AS spans FROM f GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(b, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN g ON d.doc_id = g.doc_id
"""


SQL: dict[str, str] = {
    "op1_secret_scan": _secrets(),
    "op3_exact_topk": """
WITH v AS (SELECT row_number() OVER () AS n, vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.n, q.vec_id AS query_id, c.vec_id AS vec_id,
  CAST(list_inner_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND c.n <> q.n)
SELECT query_id, CAST(row_number() OVER (PARTITION BY n ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY rank <= 20
""",
    "op4_substring_dedup": r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
p AS (SELECT doc_id, i, array_to_string(w[i:i + 34], ' ') AS win FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM d)),
r AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY win) AS n FROM p) WHERE n > 1),
g AS (SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS j FROM r),
k AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS j FROM d),
f AS (SELECT k.doc_id, count(g.j) AS n_removed, string_agg(word, ' ' ORDER BY k.j) FILTER (g.j IS NULL) AS kept
  FROM k LEFT JOIN g ON k.doc_id = g.doc_id AND k.j = g.j GROUP BY k.doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN f ON d.doc_id = f.doc_id
""",
    "op5_source_mixing": r"""
WITH RECURSIVE t AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS tokens,
  CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS digest FROM documents),
s AS (SELECT source, count(*) AS docs, CAST(sum(tokens) AS BIGINT) AS own FROM t GROUP BY source),
total AS (SELECT CAST(sum(own) AS BIGINT) AS n FROM s),
p AS (SELECT source, own / CAST(n AS DOUBLE) AS share FROM s, total WHERE own > 0),
h AS (SELECT sum(-share * ln(share)) AS found, ln(count(*)) AS most FROM p),
b(low, high) AS (SELECT 0, 2097152 UNION ALL
  SELECT CASE WHEN ok THEN mid ELSE low END, CASE WHEN ok THEN high ELSE mid END FROM (
    SELECT low, high, mid, ln(sum(pow(share, mid / 2097152.0::DOUBLE))) - mid / 2097152.0::DOUBLE * sum(pow(share, mid / 2097152.0::DOUBLE) * ln(share))
      / sum(pow(share, mid / 2097152.0::DOUBLE)) >= any_value(found + 0.5 * (most - found)) AS ok
    FROM (SELECT low, high, (low + high) // 2 AS mid, share, found, most FROM b, p, h WHERE high - low > 1) GROUP BY low, high, mid)),
e AS (SELECT max(low) / 2097152.0::DOUBLE AS a FROM b WHERE high - low = 1),
w AS (SELECT source, pow(share, a) / sum(pow(share, a)) OVER () AS weight FROM p, e),
k AS (SELECT s.source, own, coalesce(weight, 0.0) AS weight, CAST(floor(coalesce(weight, 0.0) * n + 1e-6) AS BIGINT) AS wanted,
  CAST(pow(2.0, ceil(log2(greatest(docs / 64.0::DOUBLE, 1.0)))) AS BIGINT) AS blocks FROM total, s LEFT JOIN w ON s.source IS NOT DISTINCT FROM w.source),
q AS (SELECT *, CASE WHEN own > 0 THEN wanted // own ELSE 1 END AS passes, CASE WHEN own > 0 THEN wanted % own ELSE 0 END AS rest FROM k),
d AS (SELECT t.*, q.* EXCLUDE (source), digest & (blocks - 1) AS block FROM t JOIN q ON t.source IS NOT DISTINCT FROM q.source),
z AS (SELECT source, block, passes, rest, sum(tokens) AS size FROM d GROUP BY ALL),
o AS (SELECT source, block, passes, rest, size, row_number() OVER v AS place, sum(size) OVER (v ROWS UNBOUNDED PRECEDING) AS upto FROM z
  WINDOW v AS (PARTITION BY source ORDER BY md5('1:' || passes || ':' || coalesce(source, '') || ':' || block), block))
SELECT doc_id, d.source, tokens AS n_tokens, round(weight, 6) AS weight, d.block, place,
  d.passes + CAST(2 * upto - size <= 2 * d.rest AND d.rest > 0 AS BIGINT) AS n_copies
FROM d JOIN o ON d.source IS NOT DISTINCT FROM o.source AND d.block = o.block
""",
    "op7_exact_dedup": """
WITH d AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept, sha256(t) AS text_sha256
FROM d WINDOW w AS (PARTITION BY t)
""",
    "op9_line_dedup": r"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos FROM d),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
often AS (SELECT key FROM k WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10),
f AS (SELECT k.*, often.key IS NOT NULL AS gone FROM k LEFT JOIN often ON k.key = often.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM f GROUP BY doc_id
""",
    "op12_phrase_mining": r"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
w AS (SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS p FROM d)),
g AS (SELECT lang, size, array_to_string(w[i:i + size - 1], ' ') AS phrase
  FROM (SELECT lang, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM w, (SELECT unnest([1, 2, 3, 4]) AS size))),
f AS (SELECT lang, size, phrase, count(*) AS f FROM g GROUP BY ALL),
n AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE size = 1 GROUP BY lang),
c AS (SELECT lang, size, phrase, f AS a, string_split(phrase, ' ') AS ws FROM f WHERE size > 1 AND f >= 30),
k AS (SELECT lang, phrase, a, k, array_to_string(ws[1:k], ' ') AS x, array_to_string(ws[k + 1:], ' ') AS y FROM (SELECT *, unnest(range(1, size)) AS k FROM c)),
s AS (SELECT k.lang, k.phrase, a, k, x.f AS l, y.f AS r, CAST((CAST(2000000 AS HUGEINT) * a) // (x.f + y.f) AS BIGINT) AS score
  FROM k JOIN f x ON k.lang = x.lang AND k.x = x.phrase JOIN f y ON k.lang = y.lang AND k.y = y.phrase),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
i AS (SELECT lang, inside, max(a) AS longest FROM (
  SELECT lang, a, array_to_string(ws[i:i + m - 1], ' ') AS inside
  FROM (SELECT *, unnest(range(1, size - m + 2)) AS i FROM c JOIN (SELECT unnest([2, 3]) AS m) ON m < size)) GROUP BY ALL)
SELECT b.lang, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM b JOIN n ON b.lang = n.lang LEFT JOIN i ON b.lang = i.lang AND b.phrase = i.inside
WHERE longest IS NULL OR 100 * longest < 80 * a QUALIFY rank <= 2000
""",
    "op13_ranked_search": r"""
WITH t AS (SELECT doc_id, row_number() OVER () AS doc,
  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
q AS (SELECT item_id, item, unnest(list_distinct(w)) AS term FROM (SELECT item_id, row_number() OVER () AS item,
  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM benchmark)),
c AS (SELECT count(*) AS nd, CAST(sum(len(w)) AS BIGINT) AS nt FROM t WHERE len(w) > 0),
p AS (SELECT doc, term, count(*) AS tf FROM (SELECT doc, unnest(w) AS term FROM t) WHERE term IN (SELECT term FROM q) GROUP BY ALL),
v AS (SELECT term, CAST(floor(1000 * ln((2 * any_value(nd) + 2) / (2 * count(*) + 1))) AS BIGINT) AS weight FROM p, c GROUP BY term),
m AS (SELECT doc, doc_id, 50 + (50 * CAST(len(w) AS BIGINT) * nd) // nt AS m FROM t, c WHERE len(w) > 0),
s AS (SELECT item, item_id, doc, doc_id, CAST(sum(weight * ((1000000000 * tf) // (1000 * tf + 20 * m))) AS BIGINT) AS score
  FROM q JOIN v USING (term) JOIN p USING (term) JOIN m USING (doc) GROUP BY ALL)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM s WHERE score > 0 QUALIFY rank <= 50
""",
}
