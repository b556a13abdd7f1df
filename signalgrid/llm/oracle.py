"""Checking SQL for the queries of this package that SQL can express on whole tables."""

from __future__ import annotations

from signalgrid.llm.licenses import BASE, MORE, parse

LINES = """
WITH d AS (
  SELECT doc_id, text, MIN(COALESCE(source, '')) OVER (PARTITION BY text) AS home FROM documents
), l AS (
  SELECT doc_id, home, i, string_split(text, chr(10))[i] AS line,
    trim(string_split(text, chr(10))[i], ' ' || chr(9) || chr(13)) AS bare
  FROM (SELECT doc_id, home, text, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i FROM d)
), wide AS (
  SELECT bare FROM l WHERE bare <> '' GROUP BY bare HAVING COUNT(DISTINCT home) >= 10
), kept AS (
  SELECT doc_id, COALESCE(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '') AS left_over,
    COUNT(*) FILTER (WHERE gone) AS removed
  FROM (SELECT l.*, bare IN (SELECT bare FROM wide) AS gone FROM l) GROUP BY doc_id
)
SELECT documents.doc_id, CAST(length(COALESCE(left_over, '')) AS BIGINT) AS n_chars,
  CAST(COALESCE(removed, 0) AS BIGINT) AS lines_removed, sha256(COALESCE(left_over, '')) AS text_sha256
FROM documents LEFT JOIN kept ON kept.doc_id = documents.doc_id
"""

DECONTAMINATE = r"""
WITH small AS (
  SELECT 'ABCDEFGHIJKLMNOPQRSTUVWXYZ' AS a, 'abcdefghijklmnopqrstuvwxyz' AS b, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+' AS word
), d AS (
  SELECT doc_id, regexp_extract_all(translate(COALESCE(text, ''), a, b), word) AS w FROM documents, small
), b AS (
  SELECT item_id, regexp_extract_all(translate(COALESCE(text, ''), a, b), word) AS w FROM benchmark, small
), item_windows AS (
  SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS win
  FROM (SELECT item_id, w, n, unnest(range(1, len(w) - n + 2)) AS i
        FROM (SELECT *, least(10, len(w)) AS n FROM b WHERE len(w) > 0))
), doc_windows AS (
  SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS win
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i
        FROM d, (SELECT DISTINCT n FROM item_windows) WHERE len(w) >= n)
), hit AS (
  SELECT doc_id, item_id, i, x.n FROM doc_windows x JOIN item_windows y ON x.win = y.win AND x.n = y.n
), words AS (
  SELECT doc_id, COUNT(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM hit) GROUP BY doc_id
), listed AS (
  SELECT doc_id, COUNT(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(COALESCE(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(COALESCE(n_items, 0) AS BIGINT) AS n_items, sha256(COALESCE(items, '')) AS items_sha256,
  COALESCE(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words ON words.doc_id = d.doc_id LEFT JOIN listed ON listed.doc_id = d.doc_id
"""

URLS = r"""
WITH RECURSIVE rules(verdict, host, path) AS (
  VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
    ('allow', 'com', '/fr/'), ('block', 'com', '/de/')
), small AS (
  SELECT 'ABCDEFGHIJKLMNOPQRSTUVWXYZ' AS a, 'abcdefghijklmnopqrstuvwxyz' AS b
), p AS (
  SELECT page_id, url, html, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest,
    CASE WHEN instr(url, '://') > 0 THEN substr(url, 1, instr(url, '://') - 1) END AS scheme
  FROM pages
), q AS (
  SELECT p.*, regexp_extract(rest, '^[^/?#]*') AS raw_host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path,
    translate(scheme, a, b) || '://' || translate(regexp_extract(rest, '^[^/?#]*'), a, b)
      || regexp_extract(rest, '^[^/?#]*([^#]*)', 1) AS node
  FROM p, small
), tags AS (
  SELECT *, unnest(regexp_extract_all(html, '(?is)<(?:link|meta)\b[^>]*>')) AS tag FROM q WHERE scheme IS NOT NULL
), found AS (
  SELECT *, replace(CASE
    WHEN regexp_matches(tag, '(?is)^<link\b.*\brel\s*=\s*["'']?canonical\b')
      THEN regexp_extract(tag, '(?is)\bhref\s*=\s*["'']?([^"''\s>]+)', 1)
    WHEN regexp_matches(tag, '(?is)^<meta\b.*\bhttp-equiv\s*=\s*["'']?refresh\b')
      THEN regexp_extract(tag, '(?is)\burl\s*=\s*([^"''\s>]+)', 1)
    ELSE '' END, '&amp;', '&') AS target
  FROM tags
), resolved AS (
  SELECT node, CASE
    WHEN regexp_matches(target, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN target
    WHEN starts_with(target, '//') THEN scheme || ':' || target
    WHEN starts_with(target, '/') THEN scheme || '://' || raw_host || target
    WHEN starts_with(target, '?') THEN scheme || '://' || raw_host || path || target
    ELSE scheme || '://' || raw_host || CASE WHEN contains(path, '/') THEN regexp_extract(path, '^(.*/)', 1) ELSE '/' END || target
    END AS goal
  FROM found WHERE target <> '' AND NOT starts_with(target, '#')
), links AS (
  SELECT DISTINCT node AS u, translate(substr(goal, 1, instr(goal, '://') - 1), a, b) || '://'
    || translate(regexp_extract(substr(goal, instr(goal, '://') + 3), '^[^/?#]*'), a, b)
    || regexp_extract(substr(goal, instr(goal, '://') + 3), '^[^/?#]*([^#]*)', 1) AS v
  FROM resolved, small
), both_ways AS (
  SELECT u, v FROM links UNION SELECT v, u FROM links
), reach AS (
  SELECT u, v FROM both_ways UNION SELECT r.u, e.v FROM reach r JOIN both_ways e ON r.v = e.u
), aliases AS (
  SELECT u, v, regexp_extract(substr(v, instr(v, '://') + 3), '^[^/?#]*') AS host,
    regexp_extract(substr(v, instr(v, '://') + 3), '^[^/?#]*([^?#]*)', 1) AS path
  FROM (SELECT u, v FROM reach UNION SELECT u, u FROM both_ways)
), decided AS (
  SELECT u, v, arg_max(r.verdict, length(r.host || r.path)) AS verdict
  FROM aliases x JOIN rules r ON (x.host = r.host OR ends_with(x.host, '.' || r.host)) AND starts_with(x.path, r.path)
  GROUP BY u, v
), bad AS (
  SELECT u FROM decided GROUP BY u HAVING bool_or(verdict = 'block') AND NOT bool_or(verdict = 'allow')
), own AS (
  SELECT page_id, translate(raw_host, a, b) AS host, path, node FROM q, small
), ruled AS (
  SELECT o.page_id, arg_max(r.verdict, length(r.host || r.path)) AS verdict, arg_max(r.host || r.path, length(r.host || r.path)) AS rule
  FROM own o JOIN rules r ON (o.host = r.host OR ends_with(o.host, '.' || r.host)) AND starts_with(o.path, r.path)
  GROUP BY o.page_id
)
SELECT o.page_id, COALESCE(o.host, '') AS host, COALESCE(o.path, '') AS path, ruled.rule AS rule,
  COALESCE(ruled.verdict, CASE WHEN bad.u IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict
FROM own o LEFT JOIN ruled ON ruled.page_id = o.page_id LEFT JOIN bad ON bad.u = o.node
"""

VECTORS = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x <> 0)) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), links AS (
  SELECT x.vec_id AS u, y.vec_id AS v FROM v x JOIN v y ON x.label = y.label AND x.vec_id <> y.vec_id AND len(x.e) = len(y.e)
  WHERE list_cosine_similarity(x.e, y.e) >= 0.98
), reach AS (
  SELECT u, v FROM links UNION SELECT r.u, l.v FROM reach r JOIN links l ON r.v = l.u
)
SELECT e.vec_id, COALESCE(n.n_links, 0) AS n_links, LEAST(e.vec_id, COALESCE(m.least_id, e.vec_id)) AS component_id,
  e.vec_id = LEAST(e.vec_id, COALESCE(m.least_id, e.vec_id)) AS kept
FROM embeddings e LEFT JOIN (SELECT u, COUNT(*) AS n_links FROM links GROUP BY u) n ON n.u = e.vec_id
LEFT JOIN (SELECT u, MIN(v) AS least_id FROM reach GROUP BY u) m ON m.u = e.vec_id
"""

SUBSTRINGS = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(COALESCE(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), windows AS (
  SELECT doc_id, i, array_to_string(w[i:i + 34], ' ') AS win
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM d WHERE len(w) >= 35)
), again AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, COUNT(*) OVER (PARTITION BY win) AS c FROM windows) WHERE c > 1
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS i FROM again
), each_word AS (
  SELECT doc_id, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS word FROM d
), kept AS (
  SELECT e.doc_id, string_agg(word, ' ' ORDER BY e.i) FILTER (WHERE g.i IS NULL) AS left_over,
    COUNT(*) AS n_words, COUNT(g.i) AS n_removed
  FROM each_word e LEFT JOIN gone g ON g.doc_id = e.doc_id AND g.i = e.i GROUP BY e.doc_id
)
SELECT d.doc_id, CAST(COALESCE(n_words, 0) AS BIGINT) AS n_words, CAST(COALESCE(n_removed, 0) AS BIGINT) AS n_removed,
  sha256(COALESCE(left_over, '')) AS kept_sha256
FROM d LEFT JOIN kept ON kept.doc_id = d.doc_id
"""

CODES_BEGIN = """
WITH k AS MATERIALIZED (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), p AS MATERIALIZED (
  SELECT vec_id, part, v[part * (len(v) // 4) + 1:(part + 1) * (len(v) // 4)] AS v FROM k, (SELECT unnest(range(4)) AS part)
), b0 AS MATERIALIZED (
  SELECT part, entry, v FROM (SELECT *, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS entry FROM p) WHERE entry < 256
)
"""
CODES_ASSIGN = """, a{now} AS MATERIALIZED (
  SELECT vec_id, part, MIN(ROW(gap, entry)) AS best FROM (
    SELECT p.vec_id, p.part, b.entry,
      list_dot_product(p.v, p.v) - 2 * list_dot_product(p.v, b.v) + list_dot_product(b.v, b.v) AS gap
    FROM p JOIN b{before} b ON b.part = p.part)
  GROUP BY vec_id, part
)"""
CODES_MOVE = """, b{now} AS MATERIALIZED (
  SELECT b.part, b.entry, COALESCE(m.v, b.v) AS v FROM b{before} b LEFT JOIN (
    SELECT part, entry, list(mean ORDER BY place) AS v FROM (
      SELECT part, entry, place, floor(SUM(x) / COUNT(*)) AS mean FROM (
        SELECT p.part, a.best[2] AS entry, unnest(range(len(p.v))) AS place, unnest(p.v) AS x
        FROM p JOIN a{now} a ON a.vec_id = p.vec_id AND a.part = p.part)
      GROUP BY part, entry, place)
    GROUP BY part, entry) m ON m.part = b.part AND m.entry = b.entry
)"""
CODES_END = """, coded AS (
  SELECT vec_id, string_agg(format('{:02x}', CAST(best[2] AS INTEGER)), '' ORDER BY part) AS code,
    CAST(SUM(best[1]) AS BIGINT) AS error FROM a5 GROUP BY vec_id
), books AS (
  SELECT sha256(string_agg(CAST(CAST(x AS BIGINT) AS VARCHAR), ',' ORDER BY part, entry, place)) AS digest
  FROM (SELECT part, entry, unnest(range(len(v))) AS place, unnest(v) AS x FROM b4)
)
SELECT k.vec_id, code, error, CAST(SUM(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, digest AS codebooks_sha256
FROM k JOIN coded ON coded.vec_id = k.vec_id, books
"""
CODES = (
    CODES_BEGIN
    + "".join((CODES_ASSIGN + CODES_MOVE).format(now=i, before=i - 1) for i in range(1, 5))
    + CODES_ASSIGN.format(now=5, before=4)
    + CODES_END
)


def license_pattern(items: list) -> str:
    """A template as a regular expression over words that each end in a blank."""
    parts = []
    for item in items:
        if isinstance(item, str):
            parts.append(f"{item} ")
        elif isinstance(item, tuple):
            parts.append(f"(?:[^ ]+ ){{{item[0]},{item[1]}}}")
        else:
            parts.append(f"(?:{license_pattern(item)})?")
    return "".join(parts)


LICENSE_RULES = ",\n    ".join(
    f"({rank}, '{label}', {'TRUE' if rank < len(BASE) else 'FALSE'}, '{parse(markup)[0]}', '^{license_pattern(parse(markup))}')"
    for rank, (label, markup) in enumerate([*BASE, *MORE])
)
LICENSES = (
    r"""
WITH rules(rank, label, base, first, pattern) AS (
  VALUES """
    + LICENSE_RULES
    + r"""
), d AS (
  SELECT doc_id, regexp_extract_all(translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), starts AS (
  SELECT doc_id, w, i FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM d) WHERE w[i] IN (SELECT first FROM rules)
), matched AS (
  SELECT doc_id, i, label, base, regexp_extract(array_to_string(w[i:i + 499], ' ') || ' ', pattern) AS words
  FROM starts JOIN rules ON w[i] = first
), places AS (
  SELECT doc_id, i - 1 AS i, label, base, length(words) - length(replace(words, ' ', '')) AS n FROM matched WHERE words <> ''
), covered AS (
  SELECT doc_id, COUNT(DISTINCT j) AS n FROM (SELECT doc_id, unnest(range(i, i + n)) AS j FROM places) GROUP BY doc_id
), told AS (
  SELECT doc_id, COUNT(*) FILTER (WHERE base) AS n_base, MIN(i) FILTER (WHERE base) AS first_word, MAX(i) FILTER (WHERE base) AS last_word,
    string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE base) AS base_labels, string_agg(DISTINCT label, ',' ORDER BY label) AS labels
  FROM places GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(COALESCE(n_base, 0) AS BIGINT) AS n_base, first_word, last_word,
  COALESCE(base_labels, '') AS base_labels, COALESCE(labels, '') AS labels, COALESCE(covered.n / len(w), 0) AS score
FROM d LEFT JOIN told ON told.doc_id = d.doc_id LEFT JOIN covered ON covered.doc_id = d.doc_id
"""
)

COLLOCATIONS = r"""
WITH d AS (
  SELECT COALESCE(lang, 'und') AS lang, regexp_split_to_array(translate(COALESCE(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]') AS pieces FROM documents
), pieces AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM (SELECT lang, unnest(pieces) AS piece FROM d)
), f AS MATERIALIZED (
  SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, COUNT(*) AS f
  FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM pieces, (SELECT unnest(range(1, 5)) AS k) WHERE len(w) >= k)
  GROUP BY ALL
), n AS (
  SELECT lang, CAST(SUM(f) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang
), c AS (
  SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND f >= 30
), cuts AS (
  SELECT c.lang, c.phrase, c.k, c.a, j, x.f AS l, y.f AS r, CAST(2000000 AS HUGEINT) * c.a // (x.f + y.f) AS score
  FROM (SELECT *, unnest(range(1, k)) AS j FROM c) c
  JOIN f x ON x.lang = c.lang AND x.k = j AND x.phrase = array_to_string(w[:j], ' ')
  JOIN f y ON y.lang = c.lang AND y.k = c.k - j AND y.phrase = array_to_string(w[j + 1:], ' ')
), lowest AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1
), inner_phrases AS (
  SELECT lang, a AS f, array_to_string(w[i:i + m - 1], ' ') AS phrase
  FROM (SELECT lang, a, w, k, m, unnest(range(1, k - m + 2)) AS i FROM (SELECT *, unnest(range(2, k)) AS m FROM c))
), dropped AS (
  SELECT DISTINCT c.lang, c.phrase FROM c JOIN inner_phrases x ON x.lang = c.lang AND x.phrase = c.phrase
  WHERE CAST(100 AS HUGEINT) * x.f >= CAST(80 AS HUGEINT) * c.a
), ranked AS (
  SELECT lowest.*, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
  FROM lowest ANTI JOIN dropped ON dropped.lang = lowest.lang AND dropped.phrase = lowest.phrase
)
SELECT ranked.lang, rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score FROM ranked JOIN n ON n.lang = ranked.lang WHERE rank <= 2000
"""

STATEMENTS: dict[str, str] = {
    "op1_decontaminate": DECONTAMINATE,
    "op4_urls": URLS,
    "op5_vectors": VECTORS,
    "op6_substrings": SUBSTRINGS,
    "op9_lines": LINES,
    "op11_vector_codes": CODES,
    "op12_licenses": LICENSES,
    "op13_collocations": COLLOCATIONS,
}
