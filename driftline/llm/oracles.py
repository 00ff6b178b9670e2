"""DuckDB SQL for the corpus queries that SQL can express."""

LINE_DEDUP = r"""
WITH lines AS (
  SELECT doc_id, i - 1 AS line_no, list_distinct(list_filter(regexp_split_to_array(lower(parts[i]), '[ \t\x0B\f\r]+'), lambda x: x <> '')) AS toks
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents), unnest(generate_series(1, len(parts))) AS g(i)
),
tl AS (SELECT doc_id, line_no, list_sort(toks) AS toks FROM lines WHERE len(toks) > 0),
sets AS (SELECT toks, min((doc_id, line_no)) AS first, row_number() OVER () AS sid, len(toks) AS n FROM tl GROUP BY toks),
tok AS (SELECT sid, n, unnest(toks) AS t FROM sets),
df AS (SELECT t, count(*) AS c FROM tok GROUP BY t),
ranked AS (SELECT sid, n, tok.t, row_number() OVER (PARTITION BY sid ORDER BY c, tok.t) AS r FROM tok JOIN df USING (t)),
pre AS (SELECT * FROM ranked WHERE r <= n - CAST(ceil(n * 90 / 100.0) AS INT) + 1),
cand AS (SELECT DISTINCT a.sid AS a, b.sid AS b FROM pre a JOIN pre b ON a.t = b.t AND a.sid < b.sid AND least(a.n, b.n) * 100 >= greatest(a.n, b.n) * 90),
hit AS (
  SELECT CASE WHEN x.first > y.first THEN x.sid ELSE y.sid END AS sid
  FROM cand JOIN sets x ON x.sid = cand.a JOIN sets y ON y.sid = cand.b
  WHERE 100 * len(list_intersect(x.toks, y.toks)) >= 90 * (x.n + y.n - len(list_intersect(x.toks, y.toks)))
),
staying AS (SELECT d AS doc_id, count(*) AS k FROM (SELECT struct_extract(first, 1) AS d FROM sets WHERE sid NOT IN (SELECT sid FROM hit)) GROUP BY 1)
SELECT doc_id, n_lines, n_token_lines, n_token_lines - coalesce(k, 0) AS n_removed
FROM (SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE len(toks) > 0) AS n_token_lines FROM lines GROUP BY doc_id)
LEFT JOIN staying USING (doc_id)
"""

HOST_RULES = r"""
WITH w AS (
  SELECT doc_id, source AS host, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
         string_split(coalesce(text, ''), chr(10)) AS parts
  FROM documents
),
grams AS (
  SELECT doc_id, i, list_slice(words, i, i + 4) AS g FROM w, unnest(generate_series(1, len(words) - 4)) AS s(i) WHERE len(words) >= 5
),
twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM grams) WHERE c > 1),
covered AS (SELECT doc_id, count(DISTINCT i + j) AS n FROM twice, unnest([0, 1, 2, 3, 4]) AS k(j) GROUP BY doc_id),
ln AS (
  SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup
  FROM (SELECT doc_id, unnest(parts) AS line FROM w) WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id
),
base AS (
  SELECT w.doc_id, host, len(words) AS n_words, coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::BIGINT AS word_chars,
         len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols, coalesce(n_dup, 0) AS n_dup_lines, coalesce(covered.n, 0) AS n_repeat_words,
         len(parts) AS n_lines
  FROM w LEFT JOIN covered USING (doc_id) LEFT JOIN ln USING (doc_id)
),
judged AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
         n_symbols > 0.3 * n_words OR n_dup_lines > 0.5 * n_lines
           OR coalesce(NOT (word_chars / nullif(n_words, 0) BETWEEN 2.5 AND 12.0), false) AS soft_failed
  FROM base
),
hosts AS (SELECT host, count(*) AS n_docs, count(*) FILTER (WHERE base_failed OR soft_failed) AS n_failed FROM judged WHERE host IS NOT NULL GROUP BY host),
m AS (
  SELECT avg(n_failed / n_docs) AS m, var_samp(n_failed / n_docs) - avg(n_failed / n_docs * (1 - n_failed / n_docs) / n_docs) AS spread,
         sum(n_failed) / sum(n_docs) AS pooled, sum(n_docs)::DOUBLE AS total_rows FROM hosts
),
t AS (SELECT *, CASE WHEN spread > 1e-12 THEN m * (1 - m) / spread - 1 END AS total FROM m),
p AS (
  SELECT CASE WHEN total > 0 THEN total WHEN total <= 0 THEN 2.0 ELSE total_rows END AS ab, CASE WHEN total > 0 THEN m ELSE pooled END AS centre FROM t
),
v AS (SELECT host, n_docs, n_failed, (n_failed + centre * ab) / (n_docs + ab) AS rate FROM hosts, p)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR soft_failed OR (coalesce(rate >= 0.5, false) AND (n_symbols > 0 OR n_dup_lines > 0 OR n_repeat_words > 0))) AS kept,
       host, n_docs, n_failed, round(rate, 6) AS shrunk_rate, soft_failed
FROM judged LEFT JOIN v USING (host)
"""

NEAR_DUPLICATES = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
  FROM documents
),
sh AS (
  SELECT DISTINCT doc_id, g FROM (
    SELECT doc_id, list_slice(words, i, i + 3) AS g FROM w, unnest(generate_series(1, greatest(1, len(words) - 3))) AS s(i) WHERE len(words) > 0
  )
),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
links AS (
  SELECT a, b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM sh x JOIN sh y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY ALL)
  JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * c >= 80 * (na.n + nb.n - c)
),
reach AS (SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, least(w.doc_id, coalesce(c.lo, w.doc_id)) AS component_id,
       w.doc_id <= coalesce(c.lo, w.doc_id) AS kept
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT a, min(b) AS lo FROM reach GROUP BY a) c ON c.a = w.doc_id
"""

QUOTATIONS = r"""
WITH RECURSIVE m AS (SELECT conv_id, turn, role, coalesce(text, '') AS text, string_split(coalesce(text, ''), chr(10)) AS parts FROM conversations),
l AS (
  SELECT conv_id, turn, i, parts[i] AS line, length(regexp_replace(regexp_extract(parts[i], '^[ \t]*((?:>[ \t]?)+)', 1), '[^>]', '', 'g')) AS depth,
         trim(regexp_replace(lower(regexp_replace(parts[i], '^[ \t]*((?:>[ \t]?)+)', '')), '[^\p{L}\p{N}]+', ' ', 'g')) AS plain
  FROM m, unnest(generate_series(1, len(parts))) AS g(i)
),
own AS (SELECT conv_id, plain, min(turn) AS origin FROM l WHERE depth = 0 AND plain <> '' GROUP BY ALL),
q AS (SELECT conv_id, turn, depth, plain, count(*) AS n FROM l WHERE depth > 0 AND plain <> '' GROUP BY ALL),
linked AS (SELECT q.*, CASE WHEN own.origin < q.turn THEN own.origin END AS origin FROM q LEFT JOIN own USING (conv_id, plain)),
votes AS (SELECT conv_id, turn, origin, sum(n) AS n_lines, coalesce(sum(n) FILTER (WHERE depth = 1), 0) AS outer_lines FROM linked GROUP BY ALL),
reply AS (
  SELECT conv_id, turn, max_by(origin, (outer_lines, origin)) FILTER (WHERE origin IS NOT NULL AND outer_lines > 0) AS parent_turn,
         sum(n_lines)::BIGINT AS n_quoted, coalesce(sum(n_lines) FILTER (WHERE origin IS NOT NULL), 0)::BIGINT AS n_linked
  FROM votes GROUP BY ALL
),
up AS (
  SELECT conv_id, turn, parent_turn AS up_turn, 1 AS steps FROM reply WHERE parent_turn IS NOT NULL
  UNION ALL
  SELECT up.conv_id, up.turn, r.parent_turn, steps + 1 FROM up JOIN reply r ON r.conv_id = up.conv_id AND r.turn = up.up_turn WHERE r.parent_turn IS NOT NULL
),
root AS (SELECT conv_id, turn, arg_max(up_turn, steps) AS root_turn, max(steps) AS depth FROM up GROUP BY conv_id, turn)
SELECT m.conv_id, m.turn, role, parent_turn, coalesce(root_turn, m.turn) AS root_turn, coalesce(root.depth, 0)::BIGINT AS depth,
       coalesce(n_quoted, 0) AS n_quoted, coalesce(n_linked, 0) AS n_linked,
       CASE WHEN regexp_matches(text, '(?m)^[ \t]*((?:>[ \t]?)+)') THEN regexp_replace(array_to_string(list_filter(parts, lambda x, i:
         NOT regexp_matches(x, '^[ \t]*((?:>[ \t]?)+)') AND NOT (regexp_matches(x, ':\s*$') AND coalesce(regexp_matches(parts[i + 1], '^[ \t]*((?:>[ \t]?)+)'), false))), chr(10)), '^[ \t\n]+|[ \t\n]+$', '', 'g')
       ELSE text END AS text
FROM m LEFT JOIN reply USING (conv_id, turn) LEFT JOIN root USING (conv_id, turn)
"""

_BITS = """
SELECT vec_id, label, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v FROM embeddings
WHERE embedding IS NOT NULL AND len(embedding) > 0
  AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x::DOUBLE))) = 0
"""


def _codes_sql(parts: int = 4, entries: int = 256, rounds: int = 4) -> str:
    """k-means by plain distances: every part against every entry, in ``rounds`` rounds and a last assignment."""
    near = """near{i} AS MATERIALIZED (
  SELECT r, j, arg_min((e, d), (d, e)) AS best
  FROM (SELECT p.r, p.j, b.e, list_inner_product(x, x) - 2 * list_inner_product(x, y) + list_inner_product(y, y) AS d
        FROM pieces p JOIN books{i} b USING (j)) GROUP BY r, j
)"""
    new = """books{n} AS MATERIALIZED (
  SELECT b.j, b.e, coalesce(m.y, b.y) AS y
  FROM books{i} b LEFT JOIN (
    SELECT j, e, list(c ORDER BY k) AS y FROM (
      SELECT p.j, n.best[1] AS e, k, floor(sum(x[k]) / count(*)) AS c
      FROM pieces p JOIN near{i} n USING (r, j), unnest(generate_series(1, len(x))) AS g(k) GROUP BY ALL
    ) GROUP BY j, e
  ) m USING (j, e)
)"""
    steps = []
    for i in range(rounds):
        steps += [near.format(i=i), new.format(i=i, n=i + 1)]
    steps.append(near.format(i=rounds))
    return f"""WITH kept AS MATERIALIZED (SELECT *, row_number() OVER (ORDER BY vec_id NULLS LAST, v) AS r FROM ({_BITS})),
pieces AS MATERIALIZED (
  SELECT r, j, list_slice(v, j * len(v) // {parts} + 1, (j + 1) * len(v) // {parts}) AS x FROM kept, unnest(range({parts})) AS s(j)
),
books0 AS MATERIALIZED (SELECT j, r - 1 AS e, x AS y FROM pieces WHERE r <= {entries}),
{", ".join(steps)},
hash AS (SELECT sha256(string_agg(array_to_string(list_transform(y, lambda c: c::BIGINT), ','), ',' ORDER BY j, e)) AS h FROM books{rounds}),
coded AS (
  SELECT r, string_agg(format('{{:02x}}', best[1]), '' ORDER BY j) AS code, sum(best[2])::BIGINT AS error FROM near{rounds} GROUP BY r
)
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, h AS codebooks_sha256
FROM kept JOIN coded USING (r), hash
"""


SOURCE_DIVERGENCE = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS words
  FROM documents
),
t AS MATERIALIZED (SELECT r, lang, source, unnest(words) AS term FROM d),
kept AS (SELECT lang, term FROM t GROUP BY ALL HAVING count(DISTINCT r) >= 30),
v AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
c AS MATERIALIZED (
  SELECT lang, source, term, coalesce(n, 0) AS n
  FROM (SELECT g.lang, g.source, term FROM g JOIN kept USING (lang))
  LEFT JOIN (SELECT lang, source, term, count(*) AS n FROM t GROUP BY ALL) USING (lang, source, term)
),
p AS MATERIALIZED (
  SELECT lang, source, term, n, 1 + (1000000000::HUGEINT * (n + 5)) // (sum(n) OVER (PARTITION BY lang, source) + 5 * v) AS p
  FROM c JOIN v USING (lang)
),
q AS (
  SELECT lang, term, 1 + (1000000000::HUGEINT * (n + 5)) // (sum(n) OVER (PARTITION BY lang) + 5 * v) AS q
  FROM (SELECT lang, term, sum(n) AS n FROM c GROUP BY ALL) JOIN v USING (lang)
),
pair AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(f, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (SELECT x.lang, x.source AS s1, y.source AS s2, sum(abs(x.p - y.p)) AS f FROM p x JOIN p y USING (lang, term) GROUP BY ALL) s
    ON s.lang = a.lang AND s1 = a.source AND s2 = b.source
),
found AS (
  SELECT lang, source, 'pair' AS part, item, value FROM pair
  UNION ALL
  SELECT lang, source, 'term', term, p - q FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q
)
SELECT lang, source, part, item, value::BIGINT AS value, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank
FROM found QUALIFY part = 'pair' OR rank <= 50
"""

ORACLES = {
    "op2_line_dedup": LINE_DEDUP,
    "op3_host_rules": HOST_RULES,
    "op5_circulant_minhash": NEAR_DUPLICATES,
    "op8_quotation_links": QUOTATIONS,
    "op11_hilbert_codes": _codes_sql(),
    "op12_source_divergence": SOURCE_DIVERGENCE,
}
