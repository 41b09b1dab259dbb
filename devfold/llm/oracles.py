"""DuckDB SQL with the same rows, for the operators that SQL can express."""

from __future__ import annotations

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _words(text: str) -> str:
    """SQL for the list of a text's words."""
    return rf"[x FOR x IN regexp_split_to_array(coalesce({text}, ''), '[\x20\x09-\x0D]+') IF x <> '']"


def _lower(text: str) -> str:
    return f"translate({text}, '{UPPER}', '{LOWER}')"


def _shingles(key: str, table: str, width: int) -> str:
    """SQL for the distinct shingles of each text of a table, as (key, g)."""
    return f"""
    SELECT DISTINCT {key}, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {width} THEN [array_to_string(w, ' ')]
        ELSE [array_to_string(w[i:i + {width - 1}], ' ') FOR i IN range(1, len(w) - {width - 2})] END) AS g
    FROM (SELECT {key}, {_words(_lower("text"))} AS w FROM {table})"""


REMOVALS = f"""
WITH d AS (SELECT doc_id, {_words("text")} AS w FROM documents),
win AS (SELECT doc_id, unnest(range(1, len(w) - 18)) AS s, w FROM d WHERE len(w) >= 20),
keyed AS (SELECT doc_id, s, array_to_string(w[s:s + 19], ' ') AS k FROM win),
again AS (SELECT doc_id, s, row_number() OVER (PARTITION BY k ORDER BY doc_id, s) > 1 AS goes FROM keyed),
gone AS (SELECT DISTINCT doc_id, s + o AS i FROM again, range(20) t(o) WHERE goes),
word AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS x FROM d),
kept AS (SELECT word.doc_id, string_agg(x, ' ' ORDER BY word.i) AS t, count(*) AS n
    FROM word LEFT JOIN gone ON word.doc_id = gone.doc_id AND word.i = gone.i WHERE gone.i IS NULL GROUP BY word.doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept ON d.doc_id = kept.doc_id
"""

CONTAINED = f"""
WITH i AS ({_shingles("item_id", "benchmark", 5)}),
d AS ({_shingles("doc_id", "documents", 5)}),
size AS (SELECT item_id, count(*) AS n FROM i GROUP BY item_id)
SELECT doc_id, size.item_id, size.n AS n_item, count(*) AS n_shared, count(*) / size.n AS containment
FROM i JOIN d ON i.g = d.g JOIN size ON size.item_id = i.item_id
GROUP BY doc_id, size.item_id, size.n HAVING 100 * count(*) >= 80 * size.n
"""

URLS = f"""
WITH r(h, p, v) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
u AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
c AS (SELECT page_id, rest, regexp_extract(coalesce(rest, ''), '^[^/?#]*') AS raw FROM u),
s AS (SELECT page_id, {_lower("raw")} AS host, regexp_extract(substr(coalesce(rest, ''), length(raw) + 1), '^[^?#]*') AS path FROM c),
m AS (SELECT s.*, h || p AS rule, v, row_number() OVER (PARTITION BY page_id ORDER BY length(h || p) DESC) AS k
    FROM s LEFT JOIN r ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p))
SELECT page_id, host, path, rule, coalesce(v, 'allow') AS verdict FROM m WHERE k = 1
"""

JACCARD = f"""
WITH RECURSIVE d AS MATERIALIZED ({_shingles("doc_id", "documents", 3)}),
size AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM d GROUP BY doc_id),
df AS (SELECT g, count(*) AS f FROM d GROUP BY g),
pair AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS shared FROM d a JOIN d b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
link AS MATERIALIZED (SELECT x, y FROM pair JOIN size p ON p.doc_id = x JOIN size q ON q.doc_id = y WHERE 100 * shared >= 90 * (p.n + q.n - shared)),
edge AS MATERIALIZED (SELECT x, y FROM link UNION ALL SELECT y, x FROM link),
reach(x, y) AS (SELECT x, y FROM edge UNION SELECT reach.x, edge.y FROM reach JOIN edge ON reach.y = edge.x)
SELECT documents.doc_id, coalesce(any_value(size.n), 0) AS n_shingles, least(documents.doc_id, coalesce(min(reach.y), documents.doc_id)) AS component_id
FROM documents LEFT JOIN size ON size.doc_id = documents.doc_id LEFT JOIN reach ON reach.x = documents.doc_id GROUP BY documents.doc_id
"""

#: A term: digits, letters and everything beyond ASCII, with A-Z lower-cased.
_TERMS = rf"regexp_extract_all({_lower("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
RANKED = f"""
WITH d AS MATERIALIZED (SELECT doc_id, unnest({_TERMS}) AS t FROM documents),
q AS (SELECT item_id, t, count(*) AS c FROM (SELECT item_id, unnest({_TERMS}) AS t FROM benchmark) GROUP BY ALL),
size AS (SELECT doc_id, count(*) AS n FROM d GROUP BY doc_id),
total AS (SELECT count(*) AS docs, sum(n) AS l FROM size),
f AS (SELECT doc_id, t, count(*) AS tf FROM d SEMI JOIN q ON d.t = q.t GROUP BY ALL),
w AS (SELECT t, CAST(floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM f, total GROUP BY t),
part AS (SELECT doc_id, t, w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // l))) AS p
    FROM f JOIN size USING (doc_id) JOIN w USING (t), total),
score AS (SELECT item_id, doc_id, CAST(sum(c * p) AS BIGINT) AS score FROM q JOIN part USING (t) GROUP BY ALL HAVING sum(c * p) > 0),
place AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score FROM score)
SELECT item_id, rank, doc_id, score FROM place WHERE rank <= 10
"""
