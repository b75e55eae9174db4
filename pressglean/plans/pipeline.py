"""One day's run, from links to statistics, over tables; `python -m pressglean.plans.pipeline --help` for the command."""

from __future__ import annotations

import argparse
import importlib
import sys
from dataclasses import dataclass
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pressglean.config import Settings, paths_for, read_settings
from pressglean.functions import html as H
from pressglean.functions import keys as K
from pressglean.functions import text as T
from pressglean.functions import url as U
from pressglean.operators import cache as C
from pressglean.operators import links as L
from pressglean.operators import stats as A
from pressglean.plans.boundary import Answer, answered
from pressglean.runtime import written
from pressglean.sources import readers, writers

PAGE = "page_html string, content_type string, final_url string, error string, status_code int"
IMAGE = "filepath string, filename string, content_type string, size bigint, error string"
TEXT = "extracted_text string, error string"
CAPTURE = "pdf_path string, success boolean, extracted_text string, error string"


@dataclass
class Run:
    """What a run brought: frames that are written, and the history after it."""

    links: DataFrame
    pages: DataFrame
    images: DataFrame
    image_texts: DataFrame
    captures: DataFrame
    stats: DataFrame
    history: DataFrame
    cache: DataFrame | None = None


def parsed_pages(fetched: DataFrame, settings: Settings) -> DataFrame:
    """Titles, descriptions, texts and relevance of fetched pages; other media types get a message instead."""
    page, good = F.col("page_html"), F.col("error").isNull()
    html = good & H.is_html(F.col("content_type"))
    out = fetched.withColumn("title", F.when(html, H.title(page))).withColumn("description", F.when(html, H.meta_description(page))).withColumn("text", F.when(html, H.page_text(page)))
    out = out.withColumn("message", F.when(good & ~html, F.lit("No HTML content")))
    return out.withColumn("relevance", F.when(html, T.relevance(T.relevance_input(F.col("title"), F.col("description"), F.col("text")), settings.keywords))).drop("page_html")


def run_day(links: DataFrame, history: DataFrame, fetch: Answer, download: Answer, recognise: Answer, capture: Answer, date: str, settings: Settings | None = None, older_social: DataFrame | None = None, retry_errors: bool = False, cache: DataFrame | None = None, now: str | None = None) -> Run:
    """Everything for one day's links (ds, link_no, page, url, context).

    Links seen before are dropped, the rest classified; pages, images and social pages go through the given
    boundaries, the first row of each URL once. With a `cache` (and `now`), images are recognised only if no fresh
    entry under the file's content key exists, and the run brings the cache after it. All that was tried enters the history, failures too, unless
    `retry_errors`.
    """
    settings = settings or Settings()
    rules = {"domains": settings.social_domains, "extensions": settings.image_extensions, "paths": settings.image_paths}
    new = written(L.classified(L.unseen(links, history).where(F.col("url").isNotNull()), **rules), "links")
    once = lambda df: L.first_of_each(df.select("url", "context", "page", "link_no"), "url", "page", "link_no")
    html = written(parsed_pages(answered(once(new.where("category = 'html'")), fetch, PAGE), settings), "pages")
    images = written(answered(once(new.where("category = 'images'")), download, IMAGE), "images")
    ready = images.where(~A.failed(F.col("error")) & F.col("filepath").isNotNull())
    if cache is None:
        texts = written(answered(ready.select("url", "filepath", "filename"), recognise, TEXT), "image-texts")
    else:
        keyed = ready.select("url", "filepath", "filename", F.lit("gemini").alias("ns"), K.cache_key(F.concat_ws("|", "filepath", F.col("size").cast("string"))).alias("key"))
        texts, cache = C.cached_or_asked(keyed, cache, lambda misses: answered(misses, recognise, TEXT), TEXT, F.lit(now).cast("timestamp"))
        texts, cache = written(texts.drop("ns", "key", "hit"), "image-texts"), written(cache, "cache")
    social = new.where(U.mentions(F.col("url")) & (F.col("category") == "social")).select("url", "context", "page", "link_no")
    if older_social is not None:
        social = social.unionByName(L.older_backlog(older_social, social, history, "page", "link_no").where(U.mentions(F.col("url"))).select("url", "context", "page", "link_no"))
    captures = written(answered(once(social), capture, CAPTURE), "captures")
    done = [df.where(~A.failed(F.col("error"))) if retry_errors else df for df in (html, images, captures)]
    after = history
    for df in done:
        after = L.extended_history(after, df)
    after = written(after, "history")
    stats = A.run_stats({"date_processed": date, "total_urls": links.count(), "new_urls": new.count(), "history_total_urls": after.count()}, L.category_counts(new, **rules), A.page_stats(html, settings.relevant_from), A.image_stats(images, texts), A.capture_stats(captures, captures))
    return Run(new, html, images, texts, captures, written(stats, "stats"), after, cache)


def store(run: Run, base: str, date: str) -> None:
    """The run's outputs in the places of `paths_for`."""
    p = paths_for(base, date)
    writers.as_csv(run.links.drop("category"), p["links"] + ".out")
    writers.as_map(run.pages, "url", p["pages"])
    writers.as_map(run.images, "url", p["image_links"])
    writers.as_json(run.image_texts, p["image_texts"])
    writers.as_json(run.stats, p["stats"])
    writers.as_document(A.consolidated(run.stats, {"html_pages": run.pages, "image_texts": run.image_texts, "social": run.captures}), p["consolidated"])


def _newest(spark: SparkSession, folder: str) -> tuple[int, str | None]:
    """Number and place of the newest version of a table in `folder`; (0, None) if there is none."""
    found = [int(f.rstrip("/").rsplit("v=", 1)[1]) for f in readers.found(spark, f"{folder}/v=*")]
    return (max(found), f"{folder}/v={max(found)}") if found else (0, None)


def run_range(spark: SparkSession, base: str, dates: list[str], boundaries, settings: Settings | None = None, retry_errors: bool = False, use_cache: bool = True, now: str | None = None) -> dict[str, str | None]:
    """The days (ddMMyyyy) one after another, each against the history and cache that the one before left; (day, error).

    `boundaries` has the functions fetch, download, recognise and capture. Days without links say so and are passed
    over. A run writes new versions of history and cache under `base`, so a day that breaks off can be run again.
    """
    said: dict[str, str | None] = {}
    for date in dates:
        source = paths_for(base, date)["links"]
        if not readers.found(spark, source):
            said[date] = "CSV not found"
            continue
        version, where = _newest(spark, f"{base}/History")
        history = spark.read.parquet(where) if where else spark.createDataFrame([], "url string")
        n, kept = _newest(spark, f"{base}/Cache")
        cache = (spark.read.parquet(kept) if kept else readers.cache_files(spark, f"{base}/Cache/*.json")) if use_cache else None
        run = run_day(readers.link_csv(spark, source), history, boundaries.fetch, boundaries.download, boundaries.recognise, boundaries.capture, date, settings, retry_errors=retry_errors, cache=cache, now=now or datetime.now(timezone.utc).strftime("%Y-%m-%d %H:%M:%S"))
        store(run, base, date)
        writers.history_version(run.history, f"{base}/History", version + 1)
        if run.cache is not None:
            run.cache.write.mode("overwrite").parquet(f"{base}/Cache/v={n + 1}")
        said[date] = None
    return said


def main(argv: list[str] | None = None) -> int:
    """Runs a day or a range of days; without boundaries it only counts the links by category. 0 if any day succeeded."""
    parser = argparse.ArgumentParser(description=main.__doc__)
    parser.add_argument("base")
    parser.add_argument("date", help="ddMMyyyy")
    parser.add_argument("--until", help="ddMMyyyy, the last day of a range")
    parser.add_argument("--boundaries", help="module with fetch, download, recognise and capture")
    parser.add_argument("--config")
    parser.add_argument("--retry-errors", action="store_true", help="keep failures out of the history")
    parser.add_argument("--no-cache", action="store_true")
    args = parser.parse_args(argv)
    spark = SparkSession.builder.appName("pressglean").getOrCreate()
    settings = read_settings(args.config)
    first = datetime.strptime(args.date, "%d%m%Y")
    last = datetime.strptime(args.until, "%d%m%Y") if args.until else first
    dates = [(first + timedelta(days=k)).strftime("%d%m%Y") for k in range((last - first).days + 1)]
    if args.boundaries:
        said = run_range(spark, args.base, dates, importlib.import_module(args.boundaries), settings, args.retry_errors, not args.no_cache)
        for date, error in said.items():
            print(date, error or "done")
        return 0 if None in said.values() else 1
    for date in dates:
        links = readers.link_csv(spark, paths_for(args.base, date)["links"])
        L.category_counts(links, domains=settings.social_domains).orderBy("category").show()
    return 0


if __name__ == "__main__":
    sys.exit(main())
