"""DuckDB forms of the operators that SQL can express, written apart from the Spark code."""

from __future__ import annotations

from stationlake.llm.op2_quality import RULES, STOP_WORDS

SPACES = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lowered(expr: str) -> str:
    return f"translate({expr}, '{UPPER}', '{LOWER}')"


def word_list(expr: str) -> str:
    return f"list_filter(string_split_regex({expr}, '[\\x20\\x09-\\x0D]+'), lambda w: w <> '')"


def _rule(rule) -> str:
    tests = [f"{rule.measure} >= {rule.low}"] * (rule.low is not None) + [
        f"{rule.measure} <= {rule.high}"] * (rule.high is not None)
    return f"CASE WHEN NOT ({' AND '.join(tests)}) THEN '{rule.name}' END"


OP2 = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, t, {word_list('t')} AS words,
             list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^\\x20\\x09-\\x0D]')) AS lines FROM d),
win AS (SELECT doc_id, unnest(range(1, len(words) - 3)) AS i, words FROM w WHERE len(words) >= 5),
again AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, words[i:i+4]) AS n FROM win),
cover AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 5)) AS p FROM again WHERE n > 1) x
          GROUP BY doc_id),
m AS (SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words,
        CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
        CAST(length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
        CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
        CAST(coalesce(cover.n, 0) AS BIGINT) AS n_repeat_words, len(lines) AS n_lines,
        len(list_intersect(words, {STOP_WORDS!r})) AS n_stop_words,
        length(regexp_replace(t, '[^!]+', '', 'g')) AS shouts, length(regexp_replace(t, '[^\\p{{Lu}}]+', '', 'g')) AS upper_chars,
        len(list_filter(lines, lambda l: regexp_matches(l, '^[\\x20\\x09]*[-*•]'))) AS bullets,
        len(list_filter(lines, lambda l: regexp_matches(l, '(\\.\\.\\.|…)[\\x20\\x09-\\x0D]*$'))) AS cut
      FROM w LEFT JOIN cover ON w.doc_id = cover.doc_id),
r AS (SELECT *, CAST(n_repeat_words AS DOUBLE) / greatest(n_words, 1) AS repeat_ratio,
        CAST(word_chars AS DOUBLE) / greatest(n_words, 1) AS mean_word_chars,
        CAST(n_symbols AS DOUBLE) / greatest(n_words, 1) AS symbol_ratio,
        CAST(shouts AS DOUBLE) / greatest(n_words, 1) AS shout_ratio,
        CAST(upper_chars AS DOUBLE) / greatest(word_chars, 1) AS upper_ratio,
        CAST(n_dup_lines AS DOUBLE) / greatest(n_lines, 1) AS dup_line_ratio,
        CAST(bullets AS DOUBLE) / greatest(n_lines, 1) AS bullet_ratio,
        CAST(cut AS DOUBLE) / greatest(n_lines, 1) AS ellipsis_ratio FROM m),
f AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
        array_to_string(list_filter([{', '.join(map(_rule, RULES))}], lambda x: x IS NOT NULL), ',') AS failed FROM r)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND failed = '' AS kept, failed FROM f"""

OP6 = f"""
WITH RECURSIVE w AS (SELECT doc_id, {word_list(lowered("coalesce(text, '')"))} AS words FROM documents),
s AS (SELECT DISTINCT doc_id, words[i:i+4] AS shingle
      FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 3, 2))) AS i FROM w WHERE len(words) > 0) x),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS both_
          FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM pairs JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
          WHERE 100 * both_ >= 85 * (x.n + y.n - both_)),
edges AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents
          UNION SELECT reach.a, edges.b FROM reach JOIN edges ON reach.b = edges.a)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, c.id AS component_id, d.doc_id = c.id AS kept
FROM documents d LEFT JOIN n ON d.doc_id = n.doc_id
JOIN (SELECT a, min(b) AS id FROM reach GROUP BY a) c ON c.a = d.doc_id"""

_NIBBLE = "(strpos('0123456789abcdef', substr(h, 5 * CAST(g AS INT) + {j}, 1)) - 1)"
_BITS = " + ".join(f"{_NIBBLE.format(j=j)} * {16 ** (5 - j)}" for j in range(1, 6))
_DIGITS = " || ".join(f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(({_BITS}) // {32 ** (3 - q)} % 32 AS INT) + 1, 1)"
                      for q in range(4))

OP7 = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS t FROM pages),
d AS (SELECT page_id, CAST(strlen(t) AS BIGINT) AS payload_bytes, sha1(t) AS h, min(page_id) OVER (PARTITION BY t) AS first_id
      FROM p)
SELECT page_id, payload_bytes, array_to_string(list_transform(range(0, 8), lambda g: {_DIGITS}), '') AS payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM d"""

OP10 = f"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT doc_id, lines, unnest(range(1, len(lines) + 1)) AS i FROM d),
k AS (SELECT doc_id, i, lines[i] AS line, {lowered(f"trim(lines[i], {SPACES})")} AS key FROM l),
r AS (SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
x AS (SELECT k.doc_id, i, line, r.key IS NOT NULL AND k.doc_id <> keeper AS dropped FROM k LEFT JOIN r ON k.key = r.key)
SELECT doc_id, count(*) AS n_lines, CAST(sum(CASE WHEN dropped THEN 1 ELSE 0 END) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(CASE WHEN NOT dropped THEN line END, chr(10) ORDER BY i), '')) AS kept_sha256
FROM x GROUP BY doc_id"""

def _assigned(number: int) -> str:
    """CTEs a<number>: each kept vector's nearest centroid of c<number>."""
    return f"""
d{number} AS (SELECT v.n, v.vec_id, c.j, sum((v.x - c.x) * (v.x - c.x)) AS d
              FROM parts v JOIN c{number} c ON v.i = c.i GROUP BY v.n, v.vec_id, c.j),
a{number} AS (SELECT n, vec_id, min(j) AS j, min(d) AS d FROM (SELECT *, min(d) OVER (PARTITION BY n) AS least FROM d{number}) x
              WHERE d = least GROUP BY n, vec_id)"""


def _round(number: int) -> str:
    """CTEs of round <number>: c<number>, floors of the means of a<number - 1>; a cluster without vectors stays."""
    return f"""{_assigned(number - 1)},
s{number} AS (SELECT a.j, v.i, sum(v.x) AS s, count(*) AS m FROM parts v JOIN a{number - 1} a ON v.n = a.n GROUP BY a.j, v.i),
c{number} AS (SELECT c.j, c.i, coalesce((s - ((s % m) + m) % m) // m, c.x) AS x
              FROM c{number - 1} c LEFT JOIN s{number} s ON c.j = s.j AND c.i = s.i)"""


OP12 = f"""
WITH kept AS (SELECT vec_id, list_transform(embedding, lambda e: CAST(floor(64 * CAST(e AS DOUBLE)) AS BIGINT)) AS q,
                row_number() OVER () AS n
              FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda e: e IS NOT NULL AND isfinite(e))) = 64),
parts AS (SELECT n, vec_id, unnest(range(1, 65)) AS i, unnest(q) AS x FROM kept),
top AS (SELECT n, row_number() OVER (ORDER BY sha256('1:' || vec_id), q) - 1 AS j FROM kept
        QUALIFY j < 16),
c0 AS (SELECT top.j, parts.i, parts.x FROM parts JOIN top ON parts.n = top.n),
{_round(1)},
{_round(2)},
{_round(3)},
{_assigned(3)},
h AS (SELECT j, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY i)) AS digest FROM c3 GROUP BY j)
SELECT a3.vec_id, CAST(a3.j AS INT) AS cluster, CAST(d AS BIGINT) AS distance,
       CAST(sum(d) OVER (PARTITION BY a3.j) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia,
       digest AS centroid_sha256
FROM a3 JOIN h ON a3.j = h.j"""

SQL = {"op2_quality_rules": OP2, "op6_minhash": OP6, "op7_warc": OP7, "op10_line_dedup": OP10, "op12_centroids": OP12}

#: A nullable BIGINT (op7's refers_to) reaches pandas as float64 from Spark but as Int64 from
#: DuckDB, so equal values print apart; its SQL is compared row by row in tests/llm instead.
ORACLE = {k: v for k, v in SQL.items() if k != "op7_warc"}
