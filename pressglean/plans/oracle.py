"""SQL that gives the same results as the queries over the test tables, for another engine."""

from __future__ import annotations

from functools import reduce

from pressglean.config import IMAGE_EXTENSIONS, IMAGE_PATHS, PERMANENT_ERRORS, SECTION_HEADERS, TEN_YEARS

PARTS = "'^([a-zA-Z][a-zA-Z0-9+.\\-]*)://([^/?#]*)([^?#]*)'"
FIND = "'https?://(?:[a-zA-Z]|[0-9]|[$-_@.&+]|[!*(),]|(?:%[0-9a-fA-F][0-9a-fA-F]))+'"
SPACE = "'[\\s\\x{00a0}\\x{0085}\\x{000b}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]+'"
EDGE = SPACE[1:-1]


def quoted(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


def flat(x: str) -> str:
    return f"trim(regexp_replace(coalesce({x}, ''), {SPACE}, ' ', 'g'))"


def folded(x: str) -> str:
    return flat(f"strip_accents(regexp_replace(coalesce({x}, ''), '\\p{{Mn}}+', '', 'g'))")


def cleaned(x: str) -> str:
    return flat(f"regexp_replace(coalesce({x}, ''), '[\\x00-\\x1F\\x7F]', ' ', 'g')")


def stripped(x: str) -> str:
    return f"regexp_replace(regexp_replace({x}, '^{EDGE}', ''), '{EDGE}$', '')"


def part(x: str, n: int) -> str:
    return f"regexp_extract(coalesce({x}, ''), {PARTS}, {n})"


def brief(x: str) -> str:
    bare = stripped(f"regexp_replace(coalesce({x}, ''), {FIND}, '', 'g')")
    words = f"string_split_regex({bare}, {SPACE})"
    return f"CASE WHEN {bare} = '' OR len({words}) <= 5 THEN {bare} ELSE array_to_string(({words})[1:5], ' ') || '...' END"


def any_of(tests: list[str]) -> str:
    return "(" + " OR ".join(tests) + ")"


def extension(x: str) -> str:
    kind = f"string_split(coalesce({x}, ''), ';')[1]"
    last = f"string_split({kind}, '/')[-1]"
    return f"CASE WHEN contains({kind}, '/') AND {last} IN ('jpeg','jpg','png','gif','bmp','webp','svg','tiff') THEN '.' || replace({last}, 'jpeg', 'jpg') ELSE '.jpg' END"


VALID = f"(url IS NOT NULL AND {part('url', 1)} <> '' AND {part('url', 2)} <> '')"
HOST = f"lower({part('url', 2)})"
IMAGE_PATH = f"lower({part('url_decode(url)', 3)})"
IMAGE = any_of([f"suffix({IMAGE_PATH}, {quoted(e)})" for e in IMAGE_EXTENSIONS] + [f"contains({IMAGE_PATH}, {quoted(p)})" for p in IMAGE_PATHS])


def social(domains: tuple[str, ...]) -> str:
    return any_of([f"{HOST} = {quoted(x)} OR suffix({HOST}, {quoted('.' + x)})" for x in domains])


PERMANENT = any_of([f"contains(lower(coalesce(error, '')), {quoted(t)})" for t in PERMANENT_ERRORS])
EXPIRY = f"CASE WHEN coalesce(error, '') <> '' AND {PERMANENT} THEN {TEN_YEARS} WHEN coalesce(error, '') <> '' THEN 3600 ELSE 86400 END"
FAILED = "coalesce(error <> '', false)"


def known(x: str) -> str:
    cases = " ".join(f"WHEN upper({folded(x)}) = upper({folded(quoted(h))}) THEN {quoted(h)}" for h in SECTION_HEADERS)
    return f"CASE {cases} END"


BLOCKS = """blocks AS (
  SELECT doc_id, 1 AS page, unnest(ls) AS text, generate_subscripts(ls, 1) - 1 AS block_no
  FROM (SELECT doc_id, list_concat([coalesce(section, '')], string_split(text, chr(10))) AS ls FROM documents WHERE text IS NOT NULL))"""
RAW = stripped("text")
SECTIONED = f"""{BLOCKS}, marked AS (
  SELECT doc_id, page, block_no, text, CASE WHEN {known('raw')} IS NOT NULL OR (regexp_matches(raw, '^[A-ZÁÉÍÓÚÑ\\s\\-–/]{{5,}}$') AND length(raw) BETWEEN 5 AND 50) THEN coalesce({known('raw')}, raw) END AS header
  FROM (SELECT *, {RAW} AS raw FROM blocks) WHERE {flat('text')} <> ''
), sectioned AS (
  SELECT * FROM (SELECT doc_id, page, block_no, text, header, coalesce(last_value(header IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY page, block_no ROWS UNBOUNDED PRECEDING), 'CONTENIDO_INICIAL') AS section FROM marked) WHERE header IS NULL)"""
PARAS = f"""{SECTIONED}, paras AS (
  SELECT doc_id, section, page, block_no, t AS text, {brief('t')} AS description, regexp_extract(t, {FIND}) AS url
  FROM (SELECT *, {cleaned('text')} AS t FROM sectioned) WHERE t <> '' AND NOT regexp_matches(t, '[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\\.[a-zA-Z]{{2,}}'))"""


def decoded(x: str) -> str:
    from pressglean.functions.html import ENTITIES

    return reduce(lambda s, e: f"replace({s}, {quoted(e[0])}, {quoted(e[1])})", ENTITIES, x)


PAGE = """concat('<html><head><title> ', coalesce(title, ''), '</title>', chr(10), '<meta content="', replace(coalesce(description, ''), '"', '&quot;'), '" name="Description"></head><!-- x --><body><nav>menu</nav><script>var a = 1;</script><p>', coalesce(text, ''), '</p><footer>pie &copy;</footer> &middot; fin</body></html>')"""
BARE = f"regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(page, '(?is)<nav\\b[^>]*>.*?</nav\\s*>', ' ', 'g'), '(?is)<script\\b[^>]*>.*?</script\\s*>', ' ', 'g'), '(?is)<footer\\b[^>]*>.*?</footer\\s*>', ' ', 'g'), '(?s)<!--.*?-->', ' ', 'g'), '(?s)<[^>]*>', ' ', 'g')"


def oracle_sql() -> dict[str, str]:
    from pressglean.plans.queries import DOMAINS, KEYWORDS

    score = " + ".join(["CAST(0 AS DOUBLE)", *(f"CASE WHEN contains(t, {quoted(k)}) THEN CAST({w} AS DOUBLE) ELSE CAST(0 AS DOUBLE) END" for k, w in KEYWORDS)])
    category = f"CASE WHEN NOT {VALID} THEN NULL WHEN {IMAGE} THEN 'images' WHEN {social(DOMAINS)} THEN 'social' WHEN lower({part('url', 1)}) IN ('http', 'https') THEN 'html' ELSE 'other' END"
    rect = "greatest(rect[1] - 30, 0) AS a, greatest(rect[2] - 10, 0) AS b, least(rect[3] + 30, 595) AS c, least(rect[4] + 10, 842) AS d"
    out = {
        "url_parts": f"SELECT link_id, CASE WHEN url IS NULL THEN NULL ELSE lower({part('url', 1)}) END AS scheme, CASE WHEN url IS NULL THEN NULL ELSE {part('url', 2)} END AS netloc, CASE WHEN url IS NULL THEN NULL ELSE {part('url', 3)} END AS path, {VALID} AS valid, coalesce(starts_with(lower(url), 'mailto:'), false) AS mail FROM links_extracted",
        "url_classify": f"SELECT link_id, {category} AS category FROM links_extracted",
        "url_category_counts": f"SELECT category, count(*) AS links FROM (SELECT {category} AS category FROM links_extracted) WHERE category IS NOT NULL GROUP BY category",
        "url_fetch_mode": "SELECT link_id, CASE WHEN contains(lower(url), 'videotubo.example') THEN 'rendered' ELSE 'plain' END AS mode FROM links_extracted WHERE contains(lower(url), 'caralibro') OR contains(lower(url), 'videotubo.example')",
        "url_md5_key": "SELECT link_id, md5(url) AS page_key, md5('facebook_' || url) AS social_key, substr(md5(url), 1, 8) AS short FROM links_extracted WHERE url IS NOT NULL",
        "asset_filename": f"SELECT image_id, 'img_' || idx || '_' || substr(md5(url), 1, 8) || '_' || day || {extension('content_type')} AS name, day || '-' || idx || '.pdf' AS capture FROM (SELECT *, row_number() OVER (ORDER BY image_id) AS idx, coalesce(strftime(download_timestamp, '%d%m%Y'), '') AS day FROM image_links WHERE url IS NOT NULL AND content_type IS NOT NULL)",
        "text_normalize": f"SELECT doc_id, md5({flat('text')}) AS plain, md5({folded('text')}) AS folded, md5({cleaned('text')}) AS clean FROM documents",
        "brief_description": f"SELECT link_id, {brief('context')} AS brief, {flat('context')} AS context FROM links_extracted",
        "email_filter": "SELECT doc_id FROM documents WHERE regexp_matches(text, '[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\\.[a-zA-Z]{2,}')",
        "extract_urls": f"SELECT doc_id, CAST(len(regexp_extract_all(text, {FIND})) AS INTEGER) AS n, regexp_extract(text, {FIND}) AS first_url FROM documents WHERE text IS NOT NULL",
        "html_fields": f"SELECT page_id, {flat(decoded(PAGE_TITLE))} AS title, {flat(decoded(PAGE_DESCRIPTION))} AS description FROM scraped_texts",
        "html_text": f"SELECT page_id, md5({flat(decoded(BARE))}) AS text FROM (SELECT page_id, {PAGE} AS page FROM scraped_texts)",
        "html_gate": "SELECT coalesce(contains(lower(content_type), 'text/html'), false) AS is_html, CASE WHEN coalesce(error, '') = '' THEN NULL WHEN starts_with(error, 'Timeout') THEN 'timeout' WHEN starts_with(error, 'HTTP Error') THEN 'http' WHEN starts_with(error, 'Network Error') THEN 'network' ELSE 'unexpected' END AS error_class, count(*) AS n FROM scraped_texts GROUP BY 1, 2",
        "relevance_score": f"SELECT page_id, least({score}, CAST(1 AS DOUBLE)) AS score FROM (SELECT page_id, lower(coalesce(title, '') || ' ' || coalesce(description, '') || ' ' || coalesce(text, '')) AS t FROM scraped_texts)",
        "history_anti": "SELECT link_id FROM links_extracted l WHERE NOT EXISTS (SELECT 1 FROM url_history h WHERE h.url = l.url)",
        "history_semi": "SELECT link_id FROM links_extracted l WHERE EXISTS (SELECT 1 FROM url_history h WHERE h.url = l.url)",
        "history_union": "SELECT url FROM url_history WHERE url IS NOT NULL UNION SELECT url FROM links_extracted WHERE url IS NOT NULL",
        "history_added": "SELECT count(*) AS total, CAST(coalesce(sum(n), 0) AS BIGINT) AS added FROM (SELECT url, min(n) AS n FROM (SELECT url, 0 AS n FROM url_history UNION ALL SELECT url, 1 FROM links_extracted) WHERE url IS NOT NULL GROUP BY url)",
        "dedup_first": "SELECT batch_no, link_id, url, page FROM links_extracted QUALIFY row_number() OVER (PARTITION BY url ORDER BY batch_no, link_id) = 1",
        "social_backlog": f"WITH s AS (SELECT batch_no, link_id, url FROM links_extracted WHERE {VALID} AND {social(DOMAINS)}) SELECT link_id, url FROM s WHERE batch_no < 10 AND url NOT IN (SELECT url FROM s WHERE batch_no = 10) AND url NOT IN (SELECT url FROM url_history WHERE url IS NOT NULL) QUALIFY row_number() OVER (PARTITION BY url ORDER BY batch_no, link_id) = 1",
        "section_fill": f"WITH {SECTIONED} SELECT doc_id, section, CAST(page AS INTEGER) AS page, CAST(block_no AS INTEGER) AS block_no FROM sectioned",
        "section_paragraphs": f"WITH {PARAS} SELECT doc_id, section, CAST(block_no AS INTEGER) AS block_no, md5(text) AS text, description, url FROM paras",
        "section_group": f"WITH {PARAS} SELECT doc_id, section, CAST(count(*) AS INTEGER) AS n, CAST(min(block_no) AS INTEGER) AS first_block, arg_min(description, block_no) AS first_description FROM paras GROUP BY doc_id, section",
        "section_totals": f"WITH {PARAS} SELECT count(DISTINCT (doc_id, section)) AS sections, count(*) AS paragraphs FROM paras",
        "cache_ttl_class": f"SELECT image_id, CAST({EXPIRY} AS BIGINT) AS expiry, {PERMANENT} AS permanent FROM image_api_results",
        "cache_lookup": f"WITH e AS (SELECT md5(coalesce(image_filename, '')) AS key, TIMESTAMP '2024-08-31 00:00:00' + to_minutes(image_id % 2880) AS ts, CASE WHEN coalesce(error, '') <> '' THEN {EXPIRY} END AS x FROM image_api_results), l AS (SELECT key, max(ts) AS ts, arg_max(coalesce(x, 86400), ts) AS x FROM e GROUP BY key) SELECT image_id, coalesce(TIMESTAMP '2024-09-01 00:00:00' < l.ts + to_seconds(l.x), false) AS hit FROM image_links LEFT JOIN l ON l.key = md5(filename) WHERE filename IS NOT NULL",
        "cache_skipped": "SELECT md5(coalesce(image_filename, '')) AS key, coalesce(image_filename, 'Desconocido') AS image_filename, coalesce(error_reason, 'Razón no especificada') AS reason, coalesce(error, 'Error no especificado') AS error FROM image_api_results WHERE permanent_error",
        "batch_assign": "WITH i AS (SELECT image_id, CAST(download_timestamp AT TIME ZONE 'UTC' AS DATE) AS ds, coalesce(size_bytes, 0) / 1048576.0 > 1.5 AS large FROM image_links WHERE filepath IS NOT NULL), r AS (SELECT *, row_number() OVER (PARTITION BY ds, large ORDER BY image_id) - 1 AS rn, count(*) FILTER (NOT large) OVER (PARTITION BY ds) AS n FROM i) SELECT image_id, large, CAST(CASE WHEN large THEN (n + 2) // 3 + rn // 2 ELSE rn // 3 END + 1 AS BIGINT) AS batch FROM r",
        "batch_even": "SELECT link_id, CAST((row_number() OVER (PARTITION BY ds ORDER BY batch_no, link_no, link_id) - 1) // 5 + 1 AS BIGINT) AS batch FROM links_extracted",
        "image_fit": "SELECT image_id, CASE WHEN w * h > 25000000 THEN CAST(floor(w * sqrt(25000000.0::DOUBLE / (w::DOUBLE * h::DOUBLE))) AS INTEGER) ELSE CAST(w AS INTEGER) END AS width, CASE WHEN w * h > 25000000 THEN CAST(floor(h * sqrt(25000000.0::DOUBLE / (w::DOUBLE * h::DOUBLE))) AS INTEGER) ELSE CAST(h AS INTEGER) END AS height, round_even(size_bytes / 1048576.0::DOUBLE, 2) AS mb FROM (SELECT *, size_bytes % 9000 + 100 AS w, size_bytes % 7000 + 100 AS h FROM image_links WHERE size_bytes IS NOT NULL)",
        "valid_downloads": f"SELECT image_id, {extension('content_type')} AS extension FROM image_links WHERE NOT {FAILED} AND filepath IS NOT NULL",
        "date_parse": "SELECT image_id, d AS day, strftime(d, '%d%m%Y') AS back FROM (SELECT image_id, CASE WHEN regexp_matches(processed_date, '^\\d{8}$') THEN CAST(try_strptime(processed_date, '%d%m%Y') AS DATE) END AS d FROM image_api_results)",
        "date_calendar": "WITH g AS (SELECT CAST(try_strptime(processed_date, '%d%m%Y') AS DATE) AS ds, count(*) AS n, count(*) FILTER (coalesce(extracted_text, '') <> '') AS t FROM image_api_results GROUP BY 1) SELECT c.ds, g.n IS NOT NULL AS success, coalesce(g.n, 0) AS n, coalesce(g.t, 0) AS texts, CASE WHEN g.n IS NULL THEN 'JSON not found' END AS error FROM (SELECT CAST(unnest(generate_series(DATE '2024-02-01', DATE '2024-12-31', INTERVAL 1 DAY)) AS DATE) AS ds) c LEFT JOIN g USING (ds)",
        "page_text_concat": f"WITH {BLOCKS} SELECT doc_id, md5(regexp_replace(regexp_replace(string_agg(text, chr(10) || chr(10) ORDER BY block_no), '^\\s+', ''), '\\s+$', '')) AS text FROM blocks GROUP BY doc_id",
        "rect_expand": f"SELECT link_id, CASE WHEN ok THEN round(a, 4) END AS x0, CASE WHEN ok THEN round(b, 4) END AS y0, CASE WHEN ok THEN round(c, 4) END AS x1, CASE WHEN ok THEN round(d, 4) END AS y1 FROM (SELECT *, coalesce(a < c AND b < d, false) AS ok FROM (SELECT link_id, {rect} FROM links_extracted WHERE rect IS NOT NULL UNION ALL SELECT link_id, NULL, NULL, NULL, NULL FROM links_extracted WHERE rect IS NULL))",
        "words_in_rects": f"WITH r AS (SELECT link_id, batch_no, page, (rect[1] + rect[3]) / 2 AS cx, (rect[2] + rect[4]) / 2 AS cy, {rect} FROM links_extracted WHERE rect IS NOT NULL) SELECT b.link_id AS box_id, md5(string_agg(CAST(w.link_id AS VARCHAR), ' ' ORDER BY w.link_id)) AS words FROM r b JOIN r w USING (batch_no, page) WHERE w.cx BETWEEN b.a AND b.c AND w.cy BETWEEN b.b AND b.d AND b.a < b.c AND b.b < b.d GROUP BY b.link_id",
        "run_page_stats": f"SELECT count(*) AS attempted, count(DISTINCT url) AS processed, count(*) FILTER (NOT {FAILED}) AS successful, count(*) FILTER (NOT {FAILED} AND coalesce(relevance, 0) >= 0.3) AS relevant, round(coalesce(avg(coalesce(relevance, 0)) FILTER (NOT {FAILED}), 0), 9) AS average_relevance FROM scraped_texts",
        "stream_new_links": "SELECT batch_no, link_id, url FROM links_extracted WHERE url IS NOT NULL QUALIFY row_number() OVER (PARTITION BY url ORDER BY batch_no, link_id) = 1",
        "run_image_stats": f"SELECT count(*) AS attempted_download, count(*) FILTER (NOT {FAILED} AND filepath IS NOT NULL) AS successful_download, count(*) FILTER (NOT {FAILED} AND filepath IS NOT NULL) AS attempted_text, (SELECT count(*) FILTER (NOT {FAILED}) FROM image_api_results) AS successful_text FROM image_links",
    }
    email = "'[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\\.[a-zA-Z]{2,}'"
    entries = f"e AS (SELECT md5(coalesce(image_filename, '')) AS key, image_filename AS f, TIMESTAMP '2024-08-31 00:00:00' + to_minutes(image_id % 2880) AS ts, CASE WHEN coalesce(error, '') <> '' THEN {EXPIRY} END AS x FROM image_api_results), l AS (SELECT key, max(ts) AS ts, arg_max(coalesce(x, 86400), ts) AS x, any_value(f) AS f FROM e GROUP BY key)"
    range_days = "g AS (SELECT CAST(try_strptime(processed_date, '%d%m%Y') AS DATE) AS ds, count(*) AS n, count(*) FILTER (coalesce(extracted_text, '') <> '') AS t FROM image_api_results GROUP BY 1), c AS (SELECT CAST(unnest(generate_series(DATE '2024-01-15', DATE '2024-12-31', INTERVAL 1 DAY)) AS DATE) AS ds)"
    out |= {
        "email_links": f"SELECT * FROM (SELECT link_id, coalesce(regexp_matches(url, {email}), false) AS in_url, coalesce(regexp_matches(context, {email}), false) AS in_context FROM links_extracted) WHERE in_url OR in_context",
        "html_entities": f"SELECT page_id, {flat("coalesce(title, '') || ' ó…A fin'")} AS text FROM scraped_texts",
        "html_charset": "SELECT page_id, CASE WHEN page_id % 2 = 0 THEN title ELSE regexp_replace(title, '[^\\x00-\\x7f\\x{a0}-\\x{ff}]', '_', 'g') END AS title FROM scraped_texts WHERE title IS NOT NULL",
        "cache_defaults": "SELECT image_id, 'img_' || image_id AS image_filename, coalesce(nullif(processed_date, ''), '01092024') AS processed_date, md5(coalesce(extracted_text, '')) AS text, error FROM image_api_results",
        "cache_expires": f"SELECT md5(coalesce(image_filename, '')) AS key, strftime(TIMESTAMP '2024-08-31 00:00:00' + to_minutes(image_id % 2880) + to_seconds({EXPIRY}), '%Y-%m-%d %H:%M:%S') AS expires_at FROM image_api_results WHERE coalesce(error, '') <> ''",
        "recognise_cached": f"WITH {entries} SELECT image_id, hit, CASE WHEN hit THEN filename ELSE 'read ' || filename END AS image_filename FROM (SELECT image_id, filename, coalesce(TIMESTAMP '2024-09-01 00:00:00' < l.ts + to_seconds(l.x), false) AS hit FROM image_links LEFT JOIN l ON l.key = md5(filename) WHERE filename IS NOT NULL)",
        "cache_after": f"WITH {entries}, asked AS (SELECT DISTINCT md5(filename) AS key FROM image_links WHERE filename IS NOT NULL), m AS (SELECT a.key FROM asked a LEFT JOIN l USING (key) WHERE NOT coalesce(TIMESTAMP '2024-09-01 00:00:00' < l.ts + to_seconds(l.x), false)) SELECT 'ocr' AS ns, (SELECT count(*) FROM (SELECT key FROM l UNION SELECT key FROM m)) AS entries, (SELECT count(*) FROM (SELECT key FROM m UNION SELECT key FROM l WHERE ts = TIMESTAMP '2024-09-01 00:00:00')) AS fresh",
        "run_capture_stats": f"SELECT count(*) AS attempted, count(*) FILTER (rect IS NOT NULL) AS successful, count(*) FILTER (coalesce(context, '') <> '') AS extracted_texts FROM (SELECT * FROM links_extracted WHERE {VALID} AND {social(DOMAINS)} QUALIFY row_number() OVER (PARTITION BY url ORDER BY batch_no, link_id) = 1)",
        "recognise_range": f"WITH {range_days} SELECT c.ds, g.n IS NOT NULL AS success, coalesce(g.n, 0) AS n, coalesce(g.t, 0) AS texts, CAST(coalesce((g.n + 4) // 5, 0) AS BIGINT) AS batches FROM c LEFT JOIN g USING (ds)",
        "range_any_success": f"WITH {range_days} SELECT coalesce(bool_or(g.n IS NOT NULL), false) AS success, count(*) AS days, count(g.n) AS succeeded FROM c LEFT JOIN g USING (ds)",
        "stream_files": out["stream_new_links"],
        "social_backlog_last": f"WITH s AS (SELECT batch_no, link_id, url FROM links_extracted WHERE {VALID} AND {social(DOMAINS)}), m AS (SELECT max(batch_no) AS b FROM links_extracted) SELECT link_id, url FROM s, m WHERE batch_no < b AND url NOT IN (SELECT url FROM s, m WHERE batch_no = b) AND url NOT IN (SELECT url FROM url_history WHERE url IS NOT NULL) QUALIFY row_number() OVER (PARTITION BY url ORDER BY batch_no, link_id) = 1",
    }
    return out


# the title and description that the built page holds, up to its first closing tag
PAGE_TITLE = f"regexp_extract({PAGE}, '(?is)<title[^>]*>(.*?)</title\\s*>', 1)"
PAGE_DESCRIPTION = f"regexp_extract({PAGE}, '(?is)<meta content=\"(.*?)\"', 1)"
