"""Queries over the test tables for the general operators; each has its SQL in `oracle`."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pressglean.config import SOCIAL_DOMAINS
from pressglean.functions import html as H
from pressglean.functions import keys as K
from pressglean.functions import text as T
from pressglean.functions import url as U
from pressglean.operators import cache as C
from pressglean.operators import links as L
from pressglean.operators import sections as S
from pressglean.operators import stats as A
from pressglean.runtime import shared_dir, table
from pressglean.streaming import ingest as I  # noqa: E741

#: Social hosts of the test tables besides the defaults.
DOMAINS = (*SOCIAL_DOMAINS, "caralibro.example", "videotubo.example")
KEYWORDS = (("arsan", 0.5), ("agua", 0.2), ("saneamiento", 0.2), ("alcantarillado", 0.2), ("tarifa", 0.2), ("sequía", 0.2), ("reservorio", 0.2), ("desagüe", 0.2))
NOW = "2024-09-01 00:00:00"


def _links(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "links_extracted")


def _blocks(s: SparkSession, d: str) -> DataFrame:
    """Digest blocks: each document's section title, then its lines."""
    docs = table(s, d, "documents").where("text is not null")
    lines = F.concat(F.array(F.coalesce("section", F.lit(""))), F.split("text", "\n"))
    return docs.select("doc_id", F.lit(1).alias("page"), F.posexplode(lines).alias("block_no", "text"))


def _html(s: SparkSession, d: str) -> DataFrame:
    """Pages as markup, built of the scraped fields."""
    t, desc, body = (F.coalesce(c, F.lit("")) for c in ("title", "description", "text"))
    page = F.concat(F.lit("<html><head><title> "), t, F.lit('</title>\n<meta content="'), F.regexp_replace(desc, '"', "&quot;"), F.lit('" name="Description"></head><!-- x --><body><nav>menu</nav><script>var a = 1;</script><p>'), body, F.lit("</p><footer>pie &copy;</footer> &middot; fin</body></html>"))
    return table(s, d, "scraped_texts").select("page_id", page.alias("page"))


def _cache(s: SparkSession, d: str) -> DataFrame:
    """Recognised texts as cache entries, one minute apart by id."""
    content = F.to_json(F.struct("image_filename", "error", "permanent_error", "error_reason"))
    ts = F.timestamp_seconds(F.lit(1725062400) + F.col("image_id") % 2880 * 60)
    expiry = F.when(F.coalesce("error", F.lit("")) != "", C.expiry_of(F.col("error")))
    return table(s, d, "image_api_results").select(F.lit("ocr").alias("ns"), F.md5(F.coalesce("image_filename", F.lit(""))).alias("key"), ts.alias("ts"), content.alias("content"), expiry.alias("expiry_seconds"))


def url_parts(s, d):
    u = F.col("url")
    return _links(s, d).select("link_id", U.scheme(u).alias("scheme"), U.netloc(u).alias("netloc"), U.path(u).alias("path"), U.is_valid(u).alias("valid"), U.is_mail(u).alias("mail"))


def url_classify(s, d):
    return L.classified(_links(s, d).select("link_id", "url"), domains=DOMAINS).select("link_id", "category")


def url_category_counts(s, d):
    return L.category_counts(_links(s, d), domains=DOMAINS)


def url_fetch_mode(s, d):
    return _links(s, d).where(U.mentions(F.col("url"), ("caralibro",)) | U.fetch_mode(F.col("url"), ("videotubo.example",)).eqNullSafe("rendered")).select("link_id", U.fetch_mode(F.col("url"), ("videotubo.example",)).alias("mode"))


def url_md5_key(s, d):
    u = F.col("url")
    return _links(s, d).where("url is not null").select("link_id", K.cache_key(u).alias("page_key"), K.cache_key(u, "social").alias("social_key"), F.substring(F.md5(u), 1, 8).alias("short"))


def asset_filename(s, d):
    rows = L.numbered(table(s, d, "image_links").where("url is not null and content_type is not null"), [], ["image_id"], "idx")
    day = F.coalesce(K.written_date(F.col("download_timestamp")), F.lit(""))
    return rows.select("image_id", K.asset_name(F.col("idx"), F.col("url"), day, F.col("content_type")).alias("name"), K.capture_name(F.col("idx"), day).alias("capture"))


def text_normalize(s, d):
    t = F.col("text")
    return table(s, d, "documents").select("doc_id", F.md5(T.normalized(t)).alias("plain"), F.md5(T.folded(t)).alias("folded"), F.md5(T.cleaned(t)).alias("clean"))


def brief_description(s, d):
    c = F.col("context")
    return _links(s, d).select("link_id", T.brief_description(c).alias("brief"), T.normalized(c).alias("context"))


def email_filter(s, d):
    return table(s, d, "documents").where(T.has_email(F.col("text"))).select("doc_id")


def extract_urls(s, d):
    return table(s, d, "documents").where("text is not null").select("doc_id", F.size(U.urls_in(F.col("text"))).alias("n"), U.first_url(F.col("text")).alias("first_url"))


def html_fields(s, d):
    p = F.col("page")
    return _html(s, d).select("page_id", H.title(p).alias("title"), H.meta_description(p).alias("description"))


def html_text(s, d):
    return _html(s, d).select("page_id", F.md5(H.visible_text(F.col("page"))).alias("text"))


def html_gate(s, d):
    p = table(s, d, "scraped_texts")
    return p.groupBy(H.is_html(F.col("content_type")).alias("is_html"), T.error_class(F.col("error")).alias("error_class")).agg(F.count(F.lit(1)).alias("n"))


def relevance_score(s, d):
    text = T.relevance_input(F.col("title"), F.col("description"), F.col("text"))
    return table(s, d, "scraped_texts").select("page_id", T.relevance(text, KEYWORDS).alias("score"))


def history_anti(s, d):
    return L.unseen(_links(s, d), table(s, d, "url_history")).select("link_id")


def history_semi(s, d):
    return L.seen(_links(s, d), table(s, d, "url_history")).select("link_id")


def history_union(s, d):
    return L.extended_history(table(s, d, "url_history"), _links(s, d))


def history_added(s, d):
    return L.added_count(table(s, d, "url_history"), _links(s, d))


def dedup_first(s, d):
    return L.first_of_each(_links(s, d).select("batch_no", "link_id", "url", "page"), "url", "batch_no", "link_id")


def social_backlog(s, d):
    links = _links(s, d).select("batch_no", "link_id", "url").where(U.is_social(F.col("url"), DOMAINS))
    return L.older_backlog(links.where("batch_no < 10"), links.where("batch_no = 10"), table(s, d, "url_history"), "batch_no", "link_id").select("link_id", "url")


def social_backlog_last(s, d):
    """The backlog at the table's last batch: all batches before it are older."""
    links = _links(s, d).select("batch_no", "link_id", "url")
    last = links.agg(F.max("batch_no")).first()[0]
    links = links.where(U.is_social(F.col("url"), DOMAINS))
    return L.older_backlog(links.where(F.col("batch_no") < last), links.where(F.col("batch_no") == last), table(s, d, "url_history"), "batch_no", "link_id").select("link_id", "url")


def section_fill(s, d):
    return S.sectioned(_blocks(s, d)).select("doc_id", "section", "page", "block_no")


def section_paragraphs(s, d):
    p = S.paragraphs(S.sectioned(_blocks(s, d)))
    return p.select("doc_id", "section", "block_no", F.md5("text").alias("text"), "description", "url")


def section_group(s, d):
    g = S.grouped(S.paragraphs(S.sectioned(_blocks(s, d))))
    first = F.col("paragraphs")[0]
    return g.select("doc_id", "section", F.size("paragraphs").alias("n"), first["block_no"].alias("first_block"), first["description"].alias("first_description"))


def section_totals(s, d):
    return S.section_counts(S.paragraphs(S.sectioned(_blocks(s, d))))


def cache_ttl_class(s, d):
    e = F.col("error")
    return table(s, d, "image_api_results").select("image_id", C.expiry_of(e).alias("expiry"), T.is_permanent_error(e).alias("permanent"))


def cache_lookup(s, d):
    ask = table(s, d, "image_links").where("filename is not null").select("image_id", F.lit("ocr").alias("ns"), F.md5("filename").alias("key"))
    return C.looked_up(ask, _cache(s, d), F.lit(NOW).cast("timestamp")).select("image_id", "hit")


def cache_skipped(s, d):
    return C.skipped_forever(_cache(s, d)).select("key", "image_filename", "reason", "error")


def batch_assign(s, d):
    i = table(s, d, "image_links").where("filepath is not null")
    day = i.withColumn("ds", F.to_date("download_timestamp"))
    return L.batches(day, ["ds"], ["image_id"], K.size_mb(F.col("size_bytes"))).select("image_id", "large", "batch")


def batch_even(s, d):
    return L.even_batches(_links(s, d), ["ds"], ["batch_no", "link_no", "link_id"], 5).select("link_id", "batch")


def image_fit(s, d):
    i = table(s, d, "image_links").where("size_bytes is not null")
    w, h = F.col("size_bytes") % 9000 + 100, F.col("size_bytes") % 7000 + 100
    fit = K.fitted(w, h)
    return i.select("image_id", fit["width"].alias("width"), fit["height"].alias("height"), K.rounded(K.size_mb(F.col("size_bytes"))).alias("mb"))


def valid_downloads(s, d):
    return table(s, d, "image_links").where(~A.failed(F.col("error")) & F.col("filepath").isNotNull()).select("image_id", U.extension_of(F.col("content_type")).alias("extension"))


def date_parse(s, d):
    day = K.parsed_date(F.col("processed_date"))
    return table(s, d, "image_api_results").select("image_id", day.alias("day"), K.written_date(day).alias("back"))


def date_calendar(s, d):
    days = A.calendar(s, "2024-02-01", "2024-12-31")
    got = table(s, d, "image_api_results").select(K.parsed_date(F.col("processed_date")).alias("ds"), F.col("extracted_text").alias("text"))
    return A.day_status(days, got)


def page_text_concat(s, d):
    pages = _blocks(s, d).select("doc_id", F.col("block_no").alias("page"), "text")
    return S.joined_pages(pages).select("doc_id", F.md5("text").alias("text"))


def rect_expand(s, d):
    box = K.expanded(F.col("rect"), 595.0, 842.0)
    return _links(s, d).select("link_id", *(F.round(box[i], 4).alias(c) for i, c in enumerate(("x0", "y0", "x1", "y1"))))


def words_in_rects(s, d):
    links = _links(s, d).where("rect is not null")
    words = links.select("batch_no", "page", *(F.col("rect")[i].alias(c) for i, c in enumerate(("x0", "y0", "x1", "y1"))), F.col("link_id").cast("string").alias("word"), F.col("link_id").alias("word_no"))
    boxes = links.select("batch_no", "page", F.col("link_id").alias("box_id"), K.expanded(F.col("rect"), 595.0, 842.0).alias("box"))
    out = S.words_in_boxes(words, boxes, ["batch_no", "page"], "box_id")
    return out.select("box_id", F.md5("text").alias("words"))


def run_page_stats(s, d):
    return A.page_stats(table(s, d, "scraped_texts")).withColumn("average_relevance", F.round("average_relevance", 9))


def run_image_stats(s, d):
    return A.image_stats(table(s, d, "image_links"), table(s, d, "image_api_results"))


def run_consolidated(s, d):
    """Each day's document: statistics, pages and recognised texts. The tables hold no captures."""
    pages = table(s, d, "scraped_texts")
    images = table(s, d, "image_links").withColumn("ds", F.to_date("download_timestamp"))
    texts = table(s, d, "image_api_results").select(K.parsed_date(F.col("processed_date")).alias("ds"), "image_id", "image_filename", "extracted_text", "error")
    contents = {"html_pages": pages.select("ds", "page_id", "url", "title", "text", "relevance"), "image_texts": texts}
    return A.consolidated_days(L.classified(_links(s, d).select("ds", "url"), domains=DOMAINS), pages, images, texts, contents)


def stream_new_links(s, d):
    """The links table as a stream of files, each micro-batch against those before it."""
    out = f"{shared_dir(s)}/stream-{uuid.uuid4().hex}"
    I.new_links(I.link_stream(s, f"{d}/links_extracted.parque[t]"), out, f"{out}/checkpoint").awaitTermination()
    return s.read.parquet(f"{out}/links").select("batch_no", "link_id", "url")


def email_links(s, d):
    """Links whose address or context holds an e-mail address."""
    u, c = F.col("url"), F.col("context")
    return _links(s, d).where(T.has_email(u) | T.has_email(c)).select("link_id", T.has_email(u).alias("in_url"), T.has_email(c).alias("in_context"))


def _escaped(c):
    return F.replace(F.replace(F.replace(F.coalesce(c, F.lit("")), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


def html_entities(s, d):
    """Pages with nested dropped tags, named and numeric entities."""
    page = F.concat(F.lit("<body><nav>a<nav>b</nav>c</nav><div><p>"), _escaped(F.col("title")), F.lit("</p>&#243;&hellip;&#x41;</div><aside>x<aside>y</aside>z</aside><!-- n --> fin</body>"))
    return table(s, d, "scraped_texts").select("page_id", H.page_text(page).alias("text"))


def html_charset(s, d):
    """Titles sent as Latin-1 under a declared charset, and as UTF-8 without one, read back."""
    t = table(s, d, "scraped_texts").where("title is not null").select("page_id", "title")
    even = F.col("page_id") % 2 == 0
    latin = F.encode(F.regexp_replace("title", r"[^\x00-\x7f\xa0-\xff]", "_"), "ISO-8859-1")
    body = F.when(even, F.encode("title", "UTF-8")).otherwise(latin)
    kind = F.when(even, F.lit("text/html")).otherwise(F.lit("text/html; charset=ISO-8859-1"))
    return t.select("page_id", H.decoded_body(body, kind).alias("title"))


def cache_defaults(s, d):
    rows = table(s, d, "image_api_results").select("image_id", F.nullif("processed_date", F.lit("")).alias("processed_date"), "extracted_text", "error")
    return C.with_defaults(rows, F.concat(F.lit("img_"), "image_id"), F.lit("2024-09-01").cast("date")).select("image_id", "image_filename", "processed_date", F.md5("extracted_text").alias("text"), "error")


def cache_expires(s, d):
    c = _cache(s, d)
    return c.where("expiry_seconds is not null").select("key", C.expires_at(F.col("ts"), F.col("expiry_seconds")).alias("expires_at"))


def recognise_cached(s, d):
    """Images by fresh cache entries; the rest is asked once per file and kept."""
    ask = table(s, d, "image_links").where("filename is not null").select("image_id", "filename", F.lit("ocr").alias("ns"), F.md5("filename").alias("key"))
    answer = lambda misses: misses.select("ns", "key", F.concat(F.lit("read "), "filename").alias("image_filename"), F.lit(None).cast("string").alias("error"))
    out, _ = C.cached_or_asked(ask, _cache(s, d), answer, "image_filename string, error string", F.lit(NOW).cast("timestamp"))
    return out.select("image_id", "hit", "image_filename")


def cache_after(s, d):
    """Entries by name space after the run of `recognise_cached`."""
    ask = table(s, d, "image_links").where("filename is not null").select("filename", F.lit("ocr").alias("ns"), F.md5("filename").alias("key"))
    answer = lambda misses: misses.select("ns", "key", F.lit("x").alias("image_filename"), F.lit("Timeout").alias("error"))
    _, after = C.cached_or_asked(ask, _cache(s, d), answer, "image_filename string, error string", F.lit(NOW).cast("timestamp"))
    return after.groupBy("ns").agg(F.count(F.lit(1)).alias("entries"), F.count_if(F.col("ts") == F.lit(NOW).cast("timestamp")).alias("fresh"))


def run_capture_stats(s, d):
    """Captures of the social links: one with a box succeeded, and its context is the text read."""
    c = L.first_of_each(_links(s, d).where(U.is_social(F.col("url"), DOMAINS)).select("batch_no", "link_id", "url", "rect", "context"), "url", "batch_no", "link_id")
    c = c.select("url", F.col("rect").isNotNull().alias("success"), F.col("context").alias("extracted_text"))
    return A.capture_stats(c, c)


def recognise_range(s, d):
    """Recognition over a range of days: each day's images in batches of five."""
    i = table(s, d, "image_api_results").select("image_id", K.parsed_date(F.col("processed_date")).alias("ds"), F.col("extracted_text").alias("text"))
    days = A.day_status(A.calendar(s, "2024-01-15", "2024-12-31"), i)
    batches = L.even_batches(i.where("ds is not null"), ["ds"], ["image_id"], 5).groupBy("ds").agg(F.max("batch").alias("batches"))
    return days.join(batches, "ds", "left").select("ds", "success", "n", "texts", F.coalesce("batches", F.lit(0)).alias("batches"))


def range_any_success(s, d):
    i = table(s, d, "image_api_results").select(K.parsed_date(F.col("processed_date")).alias("ds"), F.col("extracted_text").alias("text"))
    return A.any_success(A.day_status(A.calendar(s, "2024-01-15", "2024-12-31"), i))


def stream_files(s, d):
    """The links as four files that arrive one after another, each micro-batch against the history of those before."""
    out = f"{shared_dir(s)}/stream-{uuid.uuid4().hex}"
    links = _links(s, d).select("link_id", "batch_no", "url", "loaded_at")
    cuts = links.select(F.percentile_approx("batch_no", [0.25, 0.5, 0.75])).first()[0]
    part = sum((F.when(F.col("batch_no") > c, 1).otherwise(0) for c in cuts), F.lit(0))
    for k in range(4):
        links.where(part == k).coalesce(1).write.mode("append").parquet(f"{out}/in")
    I.new_links(I.link_stream(s, f"{out}/in"), out, f"{out}/checkpoint").awaitTermination()
    return s.read.parquet(f"{out}/links").select("batch_no", "link_id", "url")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = [
        url_parts, url_classify, url_category_counts, url_fetch_mode, url_md5_key, asset_filename, text_normalize, brief_description, email_filter, extract_urls, html_fields, html_text, html_gate,
        relevance_score, history_anti, history_semi, history_union, history_added, dedup_first, social_backlog, social_backlog_last, section_fill, section_paragraphs, section_group, section_totals, cache_ttl_class,
        cache_lookup, cache_skipped, batch_assign, batch_even, image_fit, valid_downloads, date_parse, date_calendar, page_text_concat, rect_expand, words_in_rects, run_page_stats, run_image_stats, run_consolidated, stream_new_links,
        email_links, html_entities, html_charset, cache_defaults, cache_expires, recognise_cached, cache_after, run_capture_stats, recognise_range, range_any_success, stream_files,
    ]
    return {f.__name__: f for f in own}
