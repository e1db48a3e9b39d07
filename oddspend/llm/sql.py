"""DuckDB SQL for the queries that it can express over whole tables."""

from oddspend.llm import line_templates as L, quality as Q

_WORD = r"[^\x20\x09-\x0D]+"
_CLASS = r"[^\x20\x09-\x0D]"

OP2 = rf"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, text FROM documents),
lines AS (
  SELECT rid, doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS pos
  FROM docs WHERE text IS NOT NULL),
tokens AS (
  SELECT *, list_transform(regexp_extract_all(line, '{_WORD}'), lambda x: CASE WHEN regexp_matches(x, '[0-9]') THEN '<*>' ELSE x END) AS t
  FROM lines),
opened AS (
  SELECT *, least((len(t) + {2 * L.RUNS - 2}) // {L.RUNS}, len(t) - {L.FIXED}) AS width FROM tokens WHERE len(t) > {L.FIXED}),
bands AS (
  SELECT rid, doc_id, pos, len(t) || '|' || first || '|' || array_to_string(list_filter(t, lambda x, i: i <= first OR i > first + width), ' ') AS template
  FROM (SELECT *, k * (len(t) - width) // {L.RUNS - 1} AS first FROM opened, range({L.RUNS}) AS r(k))
  UNION ALL
  SELECT rid, doc_id, pos, len(t) || '|-1|' || array_to_string(t, ' ') FROM tokens WHERE len(t) BETWEEN 1 AND {L.FIXED}),
recurring AS (
  SELECT template FROM (SELECT DISTINCT rid, doc_id, template FROM bands)
  GROUP BY template HAVING count(*) >= 2 AND min(doc_id) < max(doc_id)),
gone AS (SELECT DISTINCT rid, pos FROM bands SEMI JOIN recurring USING (template)),
kept AS (
  SELECT rid, string_agg(line, chr(10) ORDER BY pos) AS text FROM lines ANTI JOIN gone USING (rid, pos) GROUP BY rid),
dropped AS (SELECT rid, count(*) AS n FROM gone GROUP BY rid)
SELECT doc_id, CASE WHEN docs.text IS NULL THEN NULL ELSE coalesce(kept.text, '') END AS text,
  coalesce(len(string_split(docs.text, chr(10))), 0) AS n_lines, coalesce(dropped.n, 0) AS n_dropped
FROM docs LEFT JOIN kept USING (rid) LEFT JOIN dropped USING (rid)
"""

OP6 = rf"""
WITH docs AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w FROM documents),
lined AS (SELECT *, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{_CLASS}')) AS lines FROM docs),
windows AS (
  SELECT rid, unnest(range(1, len(w) - {Q.WINDOW - 2})) AS i,
    unnest(list_transform(range(1, len(w) - {Q.WINDOW - 2}), lambda k: array_to_string(w[k:k + {Q.WINDOW - 1}], ' '))) AS words
  FROM docs WHERE len(w) > {Q.WINDOW}),
twice AS (SELECT rid, i FROM windows QUALIFY count(*) OVER (PARTITION BY rid, words) > 1),
covered AS (
  SELECT rid, sum(n) AS n FROM (
    SELECT rid, least({Q.WINDOW}, i - coalesce(lag(i) OVER (PARTITION BY rid ORDER BY i), i - {Q.WINDOW})) AS n FROM twice) GROUP BY rid),
measured AS (
  SELECT rid, doc_id, w, lines, len(w) AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS n_symbols, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
    length(regexp_replace(t, '\P{{L}}+', '', 'g')) AS letters, length(regexp_replace(t, '\P{{Lu}}+', '', 'g')) AS capitals,
    len(list_filter(w, lambda x, i: i > 1 AND w[i - 1] = x)) AS stutters
  FROM lined),
judged AS (
  SELECT m.*, CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words,
    n_words < {Q.LEAST_WORDS} OR 100 * coalesce(c.n, 0) > {Q.REPEATED_SHARE} * n_words AS base_failed
  FROM measured m LEFT JOIN covered c USING (rid))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR 10 * n_symbols > n_words OR word_chars < 2 * n_words OR word_chars > 15 * n_words OR 2 * letters < word_chars
    OR (letters >= 20 AND 2 * capitals > letters) OR (len(lines) >= 4 AND 10 * n_dup_lines > 3 * len(lines)) OR 5 * stutters > n_words) AS kept
FROM judged
"""


_SHARE = "1 + (1000000000::HUGEINT * ({c} + 2)) // ({n} + 2 * {v})"

OP11 = rf"""
WITH docs AS (
  SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS t
  FROM documents),
found AS (SELECT rid, lang, source, unnest(t) AS term FROM docs),
kept AS (SELECT lang, term, count(*) AS all_n FROM found GROUP BY lang, term HAVING count(DISTINCT rid) >= 10),
counts AS (SELECT lang, source, term, count(*) AS n FROM found JOIN kept USING (lang, term) GROUP BY lang, source, term),
langs AS (SELECT lang, count(*) AS v, sum(all_n) AS n FROM kept GROUP BY lang),
groups AS (
  SELECT lang, source, coalesce(sum(c.n), 0) AS n, coalesce(any_value(l.v), 0) AS v
  FROM (SELECT DISTINCT lang, source FROM docs) LEFT JOIN counts c USING (lang, source) LEFT JOIN langs l USING (lang) GROUP BY lang, source),
dense AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
    {_SHARE.format(c="coalesce(c.n, 0)", n="g.n", v="g.v")} AS p, {_SHARE.format(c="k.all_n", n="l.n", v="l.v")} AS q
  FROM groups g JOIN kept k USING (lang) JOIN langs l USING (lang) LEFT JOIN counts c USING (lang, source, term)),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
  FROM dense a JOIN dense b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
every AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(p.value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
  UNION ALL SELECT lang, source, 'term', term, ((p - q) * (p - q)) // (p + q) FROM dense WHERE n > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM every)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM ranked WHERE part = 'pair' OR rank <= 10
"""

_CRC_BIT = "(CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END)"
_CRC_BYTE = "xor(x, y)"
for _ in range(8):
    _CRC_BYTE = f"list_transform([{_CRC_BYTE}], lambda x: {_CRC_BIT})[1]"

OP13 = rf"""
WITH turns AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS d,
    coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (SELECT DISTINCT conv_id, conv_id - conv_id % 5 AS base,
    xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)), lambda x, y: {_CRC_BYTE}), 4294967295) % 9 AS h
  FROM turns),
rebuilt AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY own, d) AS d, role, text FROM (
    SELECT c.conv_id, 0 AS own, t.d, role, text FROM convs c JOIN turns t ON t.conv_id = c.base AND t.d <= c.h
    UNION ALL SELECT c.conv_id, 1, t.d, role, text FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.d > c.h)),
steps AS (
  SELECT conv_id, d, strlen(text) AS size, string_agg(sha256(strlen(role) || ':' || role || text), '') OVER (PARTITION BY conv_id ORDER BY d) AS node FROM rebuilt
  UNION ALL SELECT conv_id, 0, 0, '' FROM convs),
members AS (SELECT *, lag(node) OVER (PARTITION BY conv_id ORDER BY d) AS parent, lead(node) OVER (PARTITION BY conv_id ORDER BY d) AS child FROM steps),
nodes AS (
  SELECT node, any_value(parent) AS parent, any_value(d) AS depth, any_value(size) AS size, min(conv_id) AS conv_id, count(*) AS n, count(DISTINCT child) AS n_children,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (child IS NULL), '')) AS ends
  FROM members GROUP BY node),
inside AS (SELECT DISTINCT a.node, b.node AS below FROM members a JOIN members b ON a.conv_id = b.conv_id AND b.d >= a.d),
sums AS (
  SELECT i.node, count(*) FILTER (n.n_children = 0) AS n_leaves, sum((n.n - 1) * n.size) AS saved FROM inside i JOIN nodes n ON n.node = i.below GROUP BY i.node)
SELECT a.conv_id, a.depth, b.conv_id AS parent_conv_id, a.n AS n_convs, a.n_children, s.n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens, a.ends AS ends_sha256
FROM nodes a JOIN sums s USING (node) LEFT JOIN nodes b ON b.node = a.parent
"""


def oracle_sql() -> dict[str, str]:
    return {"op2_line_templates": OP2, "op6_quality_rules": OP6, "op11_source_divergence": OP11, "op13_prefix_trie": OP13}
