"""Statistics of a run, and the consolidated document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def failed(error: Column) -> Column:
    """An error that is there and isn't empty."""
    return F.coalesce(error != "", F.lit(False))


def page_stats(pages: DataFrame, relevant_from: float = 0.3) -> DataFrame:
    """attempted (rows), processed (distinct URLs), successful, relevant, average_relevance (of the successful, 0 if none)."""
    ok = ~failed(F.col("error"))
    score = F.coalesce("relevance", F.lit(0.0))
    return pages.agg(
        F.count(F.lit(1)).alias("attempted"), F.count_distinct("url").alias("processed"), F.count_if(ok).alias("successful"), F.count_if(ok & (score >= relevant_from)).alias("relevant"),
        F.coalesce(F.avg(F.when(ok, score)), F.lit(0.0)).alias("average_relevance"),
    )


def image_stats(images: DataFrame, recognised: DataFrame) -> DataFrame:
    """attempted_download, successful_download, attempted_text, successful_text; each download is sent on."""
    got = ~failed(F.col("error")) & F.col("filepath").isNotNull()
    down = images.agg(F.count(F.lit(1)).alias("attempted_download"), F.count_if(got).alias("successful_download"), F.count_if(got).alias("attempted_text"))
    return down.join(F.broadcast(recognised.agg(F.count_if(~failed(F.col("error"))).alias("successful_text"))))


def capture_stats(captures: DataFrame, texts: DataFrame) -> DataFrame:
    """attempted, successful, extracted_texts of social pages."""
    c = captures.agg(F.count(F.lit(1)).alias("attempted"), F.count_if("success").alias("successful"))
    return c.join(F.broadcast(texts.agg(F.count_if(F.coalesce("extracted_text", F.lit("")) != "").alias("extracted_texts"))))


def capture_texts(captures: DataFrame, texts: DataFrame) -> DataFrame:
    """(url, extracted_text, pdf_path) of successful captures whose text isn't empty."""
    ok = captures.where(F.col("success") & F.col("pdf_path").isNotNull()).select("url", "pdf_path")
    return ok.join(texts.where(F.coalesce("extracted_text", F.lit("")) != "").select("url", "extracted_text"), "url")


def day_status(days: DataFrame, available: DataFrame) -> DataFrame:
    """(ds, success, n, error) for each day of a calendar; days without a file say so."""
    per_day = available.groupBy("ds").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.coalesce("text", F.lit("")) != "").alias("texts"))
    d = days.join(per_day, "ds", "left")
    return d.select("ds", (F.col("n").isNotNull()).alias("success"), F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("texts", F.lit(0)).alias("texts"), F.when(F.col("n").isNull(), "JSON not found").alias("error"))


def any_success(days: DataFrame) -> DataFrame:
    """(success, days, succeeded): whether any day of a range succeeded; false for an empty range."""
    return days.agg(F.coalesce(F.bool_or("success"), F.lit(False)).alias("success"), F.count(F.lit(1)).alias("days"), F.count_if("success").alias("succeeded"))


def calendar(spark, start, end) -> DataFrame:
    """(ds): all days from start to end; none if either is NULL or the end is earlier."""
    row = spark.range(1).select(F.lit(start).cast("date").alias("a"), F.lit(end).cast("date").alias("b"))
    days = F.when(F.col("a") <= F.col("b"), F.sequence("a", F.greatest("a", "b"), F.expr("interval 1 day"))).otherwise(F.array().cast("array<date>"))
    return row.select(F.explode(days).alias("ds"))


def run_stats(run: dict, categories: DataFrame, pages: DataFrame, images: DataFrame, captures: DataFrame) -> DataFrame:
    """One nested row: `run` gives the scalar fields, the frames are results of the functions above."""
    cats = categories.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("category", "links")))).alias("categories"))
    out = cats.select(*(F.lit(v).alias(k) for k, v in run.items()), "categories")
    for name, df in (("html_processing", pages), ("image_processing", images), ("social_processing", captures)):
        out = out.join(F.broadcast(df.select(F.struct(*df.columns).alias(name))))
    return out


def consolidated(metadata: DataFrame, contents: dict[str, DataFrame]) -> DataFrame:
    """One row (document): JSON of the metadata and each content as an array of rows; for the outputs of one day."""
    out = metadata.select(F.struct(*metadata.columns).alias("metadata"))
    for name, df in contents.items():
        out = out.join(F.broadcast(df.agg(F.sort_array(F.collect_list(F.struct(*df.columns))).alias(name))))
    return out.select(F.to_json(F.struct("metadata", F.struct(*contents).alias("extracted_content"))).alias("document"))


def consolidated_days(links: DataFrame, pages: DataFrame, images: DataFrame, recognised: DataFrame, contents: dict[str, DataFrame]) -> DataFrame:
    """(ds, document) of each day that any frame has: the day's statistics and its rows of each content.

    All frames carry `ds`, links also their category; rows without a day make up the document whose ds is NULL.
    """
    got = ~failed(F.col("error")) & F.col("filepath").isNotNull()
    per = links.where("category is not null").groupBy("ds", "category").agg(F.count(F.lit(1)).alias("links"))
    cats = per.groupBy("ds").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("category", "links")))).alias("categories"))
    down = images.groupBy("ds").agg(F.count(F.lit(1)).alias("attempted_download"), F.count_if(got).alias("successful_download"), F.count_if(got).alias("attempted_text"))
    texts = recognised.groupBy("ds").agg(F.count_if(~failed(F.col("error"))).alias("successful_text"))
    parts = [cats, page_stats(pages.groupBy("ds")), down, texts]
    parts += [df.groupBy("ds").agg(F.sort_array(F.collect_list(F.struct(*(c for c in df.columns if c != "ds")))).alias(name)) for name, df in contents.items()]
    out = links.select("ds")
    for df in (pages, images, recognised, *contents.values()):
        out = out.union(df.select("ds"))
    out = out.distinct()
    for df in parts:
        one = df.withColumnRenamed("ds", "_ds")
        out = out.join(one, out["ds"].eqNullSafe(one["_ds"]), "left").drop("_ds")

    def counts(df: DataFrame) -> Column:
        return F.struct(*(F.coalesce(c, F.lit(0)).alias(c) for c in df.columns if c != "ds"))

    image = F.struct(*(F.coalesce(c, F.lit(0)).alias(c) for c in (*down.columns[1:], "successful_text")))
    meta = F.struct(F.date_format("ds", "ddMMyyyy").alias("date_processed"), "categories", counts(parts[1]).alias("html_processing"), image.alias("image_processing"))
    return out.select("ds", F.to_json(F.struct(meta.alias("metadata"), F.struct(*(F.coalesce(n, F.array()).alias(n) for n in contents)).alias("extracted_content"))).alias("document"))
