"""Results cached with a time limit, as a table (ns, key, ts, content, expiry_seconds). The present is a parameter."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressglean.config import DAY, HOUR, TEN_YEARS
from pressglean.functions import text as T
from pressglean.functions.text import is_permanent_error
from pressglean.runtime import written

# Fixed value: why a result is never asked for again.
TOO_LARGE = "Imagen demasiado pesada o compleja para procesar"


def is_fresh(ts: Column, content: Column, expiry: Column, now: Column, default: int = DAY) -> Column:
    """now < ts + the row's own expiry, else the default; rows without time or content are stale."""
    limit = F.coalesce(expiry.cast("long"), F.lit(default))
    return F.coalesce((F.unix_micros(now) < F.unix_micros(ts) + limit * 1_000_000) & content.isNotNull(), F.lit(False))


def expiry_of(error: Column, default: int = DAY, retry: int = HOUR, permanent: int = TEN_YEARS) -> Column:
    """Seconds that a result is kept: long if another try would fail too, short for other errors."""
    e = F.nullif(error, F.lit(""))
    return F.when(is_permanent_error(e), permanent).when(e.isNotNull(), retry).otherwise(default).cast("long")


def latest(cache: DataFrame) -> DataFrame:
    """The newest entry of each name space and key."""
    return cache.groupBy("ns", "key").agg(F.max_by(F.struct("ts", "content", "expiry_seconds"), F.col("ts")).alias("e")).select("ns", "key", "e.*")


def looked_up(requests: DataFrame, cache: DataFrame, now: Column, default: int = DAY) -> DataFrame:
    """`requests` (with ns and key) with content of a fresh entry and hit; each request comes back once."""
    fresh = latest(cache).where(is_fresh(F.col("ts"), F.col("content"), F.col("expiry_seconds"), now, default))
    return requests.join(fresh.select("ns", "key", "content"), ["ns", "key"], "left").withColumn("hit", F.col("content").isNotNull())


def with_defaults(rows: DataFrame, filename: Column, today: Column) -> DataFrame:
    """Cached results with the fields they may lack: the asked file's name, the present day, an empty text, no error."""
    have = {c: F.col(c) if c in rows.columns else F.lit(None).cast("string") for c in ("image_filename", "processed_date", "extracted_text", "error")}
    given = {"image_filename": filename, "processed_date": F.date_format(today, "ddMMyyyy"), "extracted_text": F.lit("")}
    return rows.withColumns({c: F.coalesce(v, given[c]) if c in given else v for c, v in have.items()})


def expires_at(ts: Column, expiry: Column) -> Column:
    """When an entry expires, as written beside it; NULL without an expiry of its own."""
    return F.date_format(F.timestamp_micros(F.unix_micros(ts) + expiry.cast("long") * 1_000_000), "yyyy-MM-dd HH:mm:ss")


def cached_or_asked(requests: DataFrame, cache: DataFrame, ask, schema: str, now: Column, default: int = DAY) -> tuple[DataFrame, DataFrame]:
    """(answers, cache after): each request (ns, key, ...) by a fresh entry, else by `ask`, which gets the misses once per key.

    `ask` turns a frame of misses into one with the fields of `schema`, error among them. Answers are JSON in
    the cache; errors are kept for an hour, those that another try would meet too for ten years.
    """
    found = written(looked_up(requests, cache, now, default), "cache-lookup")
    misses = found.where(~F.col("hit")).drop("content", "hit").dropDuplicates(["ns", "key"])
    names = [f.split(" ")[0] for f in schema.split(", ")]
    asked = written(ask(misses), "cache-asked")
    error = F.nullif(F.col("error"), F.lit(""))
    marks = F.when(error.isNotNull(), F.lit(True)).alias("cache_error"), F.when(T.is_permanent_error(error), F.lit(True)).alias("permanent_error"), F.when(T.is_permanent_error(error), F.lit(TOO_LARGE)).alias("error_reason")
    entries = asked.select("ns", "key", now.alias("ts"), F.to_json(F.struct(*names, *marks)).alias("content"), F.when(error.isNotNull(), expiry_of(error, default)).alias("expiry_seconds"))
    entries = written(entries, "cache-entries")
    answers = found.drop("content").join(entries.select("ns", "key", F.col("content").alias("asked")), ["ns", "key"], "left")
    answers = answers.join(found.where("hit").select("ns", "key", "content").dropDuplicates(["ns", "key"]), ["ns", "key"], "left")
    whole = F.from_json(F.coalesce("content", "asked"), schema)
    out = answers.withColumn("a", whole).select(*requests.columns, "hit", *(F.col(f"a.{n}").alias(n) for n in names if n not in requests.columns))
    return out, saved(cache, entries)


def saved(cache: DataFrame, results: DataFrame) -> DataFrame:
    """The cache with new entries; where keys collide the newest wins."""
    return latest(cache.unionByName(results))


def skipped_forever(cache: DataFrame) -> DataFrame:
    """(key, image_filename, reason, error, ts) of entries that are marked as never to be tried again.

    The content is JSON with image_filename, error, permanent_error and error_reason.
    """
    c = F.from_json("content", "image_filename string, error string, permanent_error boolean, error_reason string")
    # fixed values: the messages of entries that lack them
    return cache.withColumn("c", c).where("c.permanent_error").select("key", F.coalesce("c.image_filename", F.lit("Desconocido")).alias("image_filename"), F.coalesce("c.error_reason", F.lit("Razón no especificada")).alias("reason"), F.coalesce("c.error", F.lit("Error no especificado")).alias("error"), "ts")


def without_skipped(cache: DataFrame, image_filename: str) -> DataFrame:
    """The cache without the first entry (by key) that skips this image, so that it's tried again."""
    hit = skipped_forever(cache).where(F.col("image_filename") == image_filename).agg(F.min("key").alias("key"))
    return cache.join(F.broadcast(hit), "key", "left_anti")
