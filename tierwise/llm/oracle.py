"""DuckDB SQL of the operators that SQL can express, written from their contracts."""

from __future__ import annotations

_WORDS = """
d AS (SELECT doc_id, source, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, list_filter(regexp_split_to_array({text}, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws FROM d)"""

OP10 = (
    "WITH"
    + _WORDS.format(text="t")
    + """,
grams AS (
  SELECT doc_id, i, array_to_string(list_slice(ws, i, i + 7), ' ') AS g
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 6)) AS i FROM w WHERE len(ws) >= 8)),
twice AS (SELECT doc_id, g FROM grams GROUP BY doc_id, g HAVING count(*) > 1),
covered AS (
  SELECT doc_id, count(DISTINCT p) AS n
  FROM (SELECT doc_id, unnest(range(i, i + 8)) AS p FROM grams JOIN twice USING (doc_id, g)) GROUP BY doc_id),
lines AS (SELECT doc_id, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS ls FROM d),
m AS (
  SELECT w.doc_id, w.source, CAST(len(ws) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(t, '[\\x20\\x09-\\x0D]', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(t) - length(translate(t, '#*$%&|<>', '')) AS BIGINT) AS n_symbols,
         CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words
  FROM w JOIN lines USING (doc_id) LEFT JOIN covered USING (doc_id)),
f AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
         n_words < 20 OR 100 * n_repeat_words > 30 * n_words OR 100 * n_symbols > 50 * n_words
           OR 1000 * n_dup_lines > 50 * n_words AS failed
  FROM m),
hosts AS (SELECT source, count(*) AS n, count(*) FILTER (WHERE failed) AS bad FROM f WHERE source IS NOT NULL GROUP BY source),
prior AS (
  SELECT avg(bad / n) AS mean,
         CASE WHEN var_pop(bad / n) > 0 THEN greatest(1, avg(bad / n) * (1 - avg(bad / n)) / var_pop(bad / n) - 1) ELSE 1 END AS strength
  FROM hosts),
verdict AS (SELECT source, (bad + mean * strength) / (n + strength) > 0.5 AS rejected FROM hosts, prior)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT coalesce(rejected, false) AS kept
FROM f LEFT JOIN verdict USING (source)"""
)

OP5 = (
    "WITH RECURSIVE"
    + _WORDS.format(text="translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")
    + """,
sh AS (
  SELECT DISTINCT doc_id, array_to_string(list_slice(ws, i, i + 4), ' ') AS s
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS i FROM w WHERE len(ws) >= 1)),
size AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
  FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id),
link AS (
  SELECT x, y FROM shared JOIN size p ON p.doc_id = x JOIN size q ON q.doc_id = y
  WHERE 100 * c >= 80 * (p.n + q.n - c)),
reach AS (
  SELECT doc_id AS x, doc_id AS y FROM documents
  UNION
  SELECT reach.x, link.y FROM reach JOIN link ON link.x = reach.y)
SELECT documents.doc_id, CAST(coalesce(size.n, 0) AS BIGINT) AS n_shingles, r.component_id
FROM documents LEFT JOIN size USING (doc_id)
JOIN (SELECT x AS doc_id, min(y) AS component_id FROM reach GROUP BY x) r USING (doc_id)"""
)

OP12 = """WITH
d AS (SELECT row_number() OVER () AS doc, coalesce(lang, 'und') AS lang,
             translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
p AS (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM d),
w AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS ws FROM p),
grams AS (
  SELECT lang, m, array_to_string(list_slice(ws, i, i + m - 1), ' ') AS g
  FROM (SELECT lang, ws, m, unnest(range(1, len(ws) - m + 2)) AS i
        FROM w JOIN (SELECT unnest(range(1, 6)) AS m) ON len(ws) >= m)),
f AS (SELECT lang, m, g, count(*) AS a FROM grams GROUP BY lang, m, g HAVING count(*) >= 100),
totals AS (SELECT lang, sum(len(ws)) AS n FROM w GROUP BY lang),
c AS (SELECT *, string_split(g, ' ') AS ws FROM f WHERE m > 1),
inner_parts AS (
  SELECT lang, array_to_string(list_slice(ws, i, i + s - 1), ' ') AS g, a
  FROM (SELECT lang, ws, a, s, unnest(range(1, m - s + 2)) AS i FROM c JOIN (SELECT unnest(range(2, 5)) AS s) ON s < m)),
around AS (SELECT lang, g, max(a) AS around FROM inner_parts GROUP BY lang, g),
cut AS (
  SELECT c.lang, c.g, c.a, k, array_to_string(list_slice(ws, 1, k), ' ') AS gl, array_to_string(list_slice(ws, k + 1, m), ' ') AS gr
  FROM (SELECT *, unnest(range(1, m)) AS k FROM c) c LEFT JOIN around USING (lang, g)
  WHERE around IS NULL OR 100 * around < 100 * c.a),
scored AS (
  SELECT lang, g AS phrase, cut.a, x.a AS l, y.a AS r, CAST(n AS BIGINT) AS n,
         CAST((1000::HUGEINT * cut.a * n) // (x.a::HUGEINT * y.a) AS BIGINT) AS score,
         row_number() OVER (PARTITION BY lang, g ORDER BY (1000::HUGEINT * cut.a * n) // (x.a::HUGEINT * y.a), k) AS nth
  FROM cut JOIN (SELECT lang, g AS gl, a FROM f) x USING (lang, gl) JOIN (SELECT lang, g AS gr, a FROM f) y USING (lang, gr)
  JOIN totals USING (lang)),
ranked AS (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
  FROM scored WHERE nth = 1)
SELECT * FROM ranked WHERE rank <= 2000"""

OP13 = (
    "WITH"
    + _WORDS.format(text="t")
    + """,
starts AS (
  SELECT doc_id, i, array_to_string(list_slice(ws, i, i + 12), ' ') AS g
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 11)) AS i FROM w WHERE len(ws) >= 13)),
firsts AS (SELECT g, min(doc_id) AS least FROM starts GROUP BY g),
covered AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS p
  FROM starts JOIN firsts USING (g) WHERE least < starts.doc_id),
gone AS (SELECT doc_id, count(*) AS n FROM covered GROUP BY doc_id),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS t
  FROM (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS p FROM w) ANTI JOIN covered USING (doc_id, p)
  GROUP BY doc_id),
lengths AS (SELECT unnest(list_transform(range(0, 20), lambda k: 13 * CAST(pow(2, k) AS BIGINT))) AS size),
windows AS (
  SELECT doc_id, size, hash(array_to_string(list_slice(ws, i, i + size - 1), ' ')) AS g
  FROM (SELECT doc_id, ws, size, unnest(range(1, len(ws) - size + 2)) AS i FROM w JOIN lengths ON len(ws) >= size)),
longest AS (
  SELECT doc_id, max(size) AS size
  FROM windows JOIN (SELECT size, g FROM windows GROUP BY size, g HAVING count(*) > 1) USING (size, g) GROUP BY doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(gone.n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept.t, '')) AS kept_sha256, CAST(coalesce(longest.size, 0) AS BIGINT) AS longest_repeat
FROM w LEFT JOIN gone USING (doc_id) LEFT JOIN kept USING (doc_id) LEFT JOIN longest USING (doc_id)"""
)


def oracle_sql() -> dict[str, str]:
    return {"op5_jaccard_join": OP5, "op10_host_rules": OP10, "op12_collocations": OP12, "op13_substring_dedup": OP13}
