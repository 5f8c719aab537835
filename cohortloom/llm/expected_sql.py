"""SQL counterparts of the registered queries, where SQL can express them."""

from __future__ import annotations

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORD = r"[^\x20\x09-\x0D]+"

WARC = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS n, sha256(coalesce(html, '')) AS h FROM pages
), f AS (
  SELECT *, min(page_id) OVER (PARTITION BY h, n) AS first FROM p
)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, h AS payload_digest,
       CASE WHEN n >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 100 AND page_id <> first THEN first END AS refers_to
FROM f
"""

EXACT_DEDUP = f"""
WITH d AS (SELECT doc_id, {_LOWER} AS t FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(t) AS text_sha256
FROM d WINDOW w AS (PARTITION BY t)
"""

_RULES = {
    "short": "n_words < 10",
    "repetitive": "100 * n_repeat_words > 20 * n_words",
    "symbols": "n_symbols > 0.5 * n_words",
    "dup_lines": "100 * n_dup_lines > 50 * n_lines",
}


def _host_sql() -> str:
    counts = ", ".join(f"count(*) FILTER ({c}) AS f_{r}" for r, c in _RULES.items())
    moments = ", ".join(
        f"(sum(f_{r}) + 0.5) / (sum(n) + 1) AS m_{r}, greatest(sum(f_{r} * f_{r} / CAST(n AS DOUBLE)) / sum(n)"
        f" - pow(sum(f_{r}) / CAST(sum(n) AS DOUBLE), 2), 0) AS v_{r}" for r in _RULES
    )
    strengths = ", ".join(
        f"m_{r}, greatest(m_{r} * (1 - m_{r}) / greatest(v_{r} - m_{r} * (1 - m_{r}) * hosts / n,"
        f" m_{r} * (1 - m_{r}) / 1e6) - 1, 0.1) AS k_{r}" for r in _RULES
    )
    bad = " OR ".join(f"(f_{r} + m_{r} * k_{r}) / (h.n + k_{r}) > 0.75" for r in _RULES)
    return (
        f"h AS (SELECT source, count(*) AS n, {counts} FROM m WHERE source IS NOT NULL GROUP BY source),"
        f" t AS (SELECT sum(n) AS n, count(*) AS hosts, {moments} FROM h),"
        f" k AS (SELECT {strengths} FROM t),"
        f" bad AS (SELECT source FROM h, k WHERE {bad})"
    )


QUALITY_RULES = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '{_WORD}') AS words FROM documents
), l AS (
  SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM (SELECT r, unnest(string_split(text, chr(10))) AS line FROM d)
  WHERE regexp_matches(line, '{_WORD}') GROUP BY r
), w AS (
  SELECT r, unnest(generate_series(1, len(words) - 4)) AS i, words FROM d WHERE len(words) >= 5
), g AS (
  SELECT r, i, count(*) OVER (PARTITION BY r, array_to_string(list_slice(words, i, i + 4), ' ')) AS n FROM w
), c AS (
  SELECT r, count(DISTINCT i + o) AS n_repeat_words
  FROM g, (SELECT unnest(generate_series(0, 4)) AS o) WHERE n > 1 GROUP BY r
), m AS (
  SELECT d.doc_id, d.source, CAST(len(words) AS BIGINT) AS n_words,
         CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
         CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(coalesce(n_lines, 0) AS BIGINT) AS n_lines, CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words
  FROM d LEFT JOIN l USING (r) LEFT JOIN c USING (r)
), {_host_sql()}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       {_RULES['short']} OR {_RULES['repetitive']} AS base_failed,
       bad.source IS NOT NULL AS host_rejected,
       NOT ({_RULES['short']} OR {_RULES['repetitive']}) AND bad.source IS NULL AS kept
FROM m LEFT JOIN bad ON m.source = bad.source
"""

COLLOCATIONS = f"""
WITH RECURSIVE p AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({_LOWER}, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents
), w AS (
  SELECT lang, list_filter(regexp_split_to_array(piece, '[\\x20\\x09]+'), lambda x: x <> '') AS words FROM p
), s AS (
  SELECT lang, words, unnest(range(1, len(words) + 1)) AS b FROM w
), g AS (
  SELECT lang, gram, count(*) AS f FROM (
    SELECT lang, words[b:b + k - 1] AS gram FROM s, range(1, 6) AS t(k) WHERE b + k - 1 <= len(words)
  ) GROUP BY ALL
), n AS (
  SELECT lang, sum(f) AS n FROM g WHERE len(gram) = 1 GROUP BY lang
), c AS (
  SELECT lang, gram, f AS a FROM g WHERE len(gram) > 1 AND f >= 100
), inner_ AS (
  SELECT DISTINCT c.lang, c.gram[b:b + k - 1] AS gram, c.a FROM c, range(1, 5) AS s(b), range(2, 5) AS t(k)
  WHERE k < len(c.gram) AND b + k - 1 <= len(c.gram)
), kept AS (
  SELECT * FROM c WHERE NOT EXISTS (
    FROM inner_ i WHERE i.lang = c.lang AND i.gram = c.gram AND 100 * i.a >= 100 * c.a)
), cut AS (
  SELECT k.lang, k.gram, k.a, j, x.f AS l, y.f AS r, n.n,
         CAST(1000 AS HUGEINT) * k.a * n.n // (CAST(x.f AS HUGEINT) * y.f) AS score
  FROM kept k CROSS JOIN range(1, 5) AS t(j) JOIN n ON n.lang = k.lang
  JOIN g x ON x.lang = k.lang AND x.gram = k.gram[1:j] JOIN g y ON y.lang = k.lang AND y.gram = k.gram[j + 1:]
  WHERE j < len(k.gram)
), best AS (
  SELECT *, row_number() OVER (PARTITION BY lang, gram ORDER BY score, j) AS o, array_to_string(gram, ' ') AS phrase FROM cut
), edge AS (
  SELECT lang, gram, gram[1:4] AS tail, gram[2:5] AS head, a FROM c WHERE len(gram) = 5
), link AS (
  SELECT x.lang, x.gram, y.gram AS after FROM edge x JOIN c v ON v.lang = x.lang AND v.gram = x.head AND v.a = x.a
  JOIN edge y ON y.lang = x.lang AND y.tail = x.head AND y.a = x.a
), walk AS (
  SELECT lang, gram AS first, gram, CAST(0 AS BIGINT) AS place FROM edge
  WHERE NOT EXISTS (FROM link WHERE link.lang = edge.lang AND link.after = edge.gram)
  UNION ALL
  SELECT walk.lang, first, after, place + 1 FROM walk JOIN link ON link.lang = walk.lang AND link.gram = walk.gram
), path AS (
  SELECT lang, gram, 5 + max(place) OVER (PARTITION BY lang, first) AS path_words FROM walk
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM best WHERE o = 1
)
SELECT lang, CAST(rank AS BIGINT) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r,
       CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score, CAST(coalesce(path_words, len(gram)) AS BIGINT) AS path_words
FROM ranked LEFT JOIN path USING (lang, gram) WHERE rank <= 2000
"""

MINHASH = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, list_filter(regexp_split_to_array({_LOWER}, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, CASE WHEN len(w) = 1 THEN w ELSE w[b:b + 1] END AS gram
  FROM d, LATERAL (SELECT unnest(range(1, greatest(len(w), 2))) AS b) WHERE len(w) > 0
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), link AS (
  SELECT x.doc_id AS a, y.doc_id AS b FROM s x JOIN s y ON x.gram = y.gram AND x.doc_id <> y.doc_id
  JOIN n i ON i.doc_id = x.doc_id JOIN n j ON j.doc_id = y.doc_id
  WHERE 100 * least(i.n, j.n) >= 80 * greatest(i.n, j.n)
  GROUP BY x.doc_id, y.doc_id, i.n, j.n HAVING 100 * count(*) >= 80 * (i.n + j.n - count(*))
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT reach.a, link.b FROM reach JOIN link ON link.a = reach.b
)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, r.b AS component_id, r.b = d.doc_id AS kept
FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT a, min(b) AS b FROM reach GROUP BY a) r ON r.a = d.doc_id
"""

SQL = {
    "op5_warc": WARC,
    "op7_exact_dedup": EXACT_DEDUP,
    "op10_quality_rules": QUALITY_RULES,
    "op11_collocations": COLLOCATIONS,
    "op12_minhash": MINHASH,
}
