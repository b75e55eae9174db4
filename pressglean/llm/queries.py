"""Queries over the test tables for the operators of this package."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pressglean.llm import p01_site_lines as p1
from pressglean.llm import p02_residue as p2
from pressglean.llm import p03_near_duplicates as p3
from pressglean.llm import p04_scans as p4
from pressglean.llm import p05_main_content as p5
from pressglean.llm import p06_encoding as p6
from pressglean.llm import p07_history as p7
from pressglean.llm import p08_packing as p8
from pressglean.llm import p09_leaks as p9
from pressglean.llm import p10_truncated as p10
from pressglean.runtime import shared_dir, table, written


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    hits = p1.repeated_lines(table(spark, d, "scraped_texts"), min_records=5)
    return hits.select(F.col("id").alias("page_id"), "line_no")


def p1_clean(spark: SparkSession, d: str) -> DataFrame:
    return p1.without_repeated_lines(table(spark, d, "scraped_texts"))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return p2.residue(table(spark, d, "scraped_texts")).where("exclude").select(F.col("id").alias("page_id"))


def p2_flags(spark: SparkSession, d: str) -> DataFrame:
    return p2.residue(table(spark, d, "scraped_texts"))


TEXTS = ("scraped_texts", "image_api_results")


def _similar(spark: SparkSession, d: str, width: int, threshold: float, min_words: int) -> tuple[DataFrame, DataFrame]:
    tables = [(table(spark, d, TEXTS[0]), "page_id", "text"), (table(spark, d, TEXTS[1]), "image_id", "extracted_text")]
    return p3.near_duplicates(tables, width, threshold, min_words)


def _named(df: DataFrame) -> DataFrame:
    return df.withColumn("record_table", F.when(F.col("tag") == 0, TEXTS[0]).otherwise(TEXTS[1]))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    members, links = _similar(spark, d, 3, 0.5, 60)
    return _named(p3.expanded_pairs(members, links)).select("record_table", "id_a", "id_b")


def p3_groups(spark: SparkSession, d: str) -> DataFrame:
    members, links = _similar(spark, d, 3, 0.5, 60)
    return _named(p3.near_duplicate_classes(members, links)).select("record_table", F.col("id").alias("record_id"), "group_id", "links")


def p3_links(spark: SparkSession, d: str) -> DataFrame:
    """The number of records that each record is similar to."""
    return p3_groups(spark, d).select("record_table", "record_id", "links")


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return p4.read_defects(table(spark, d, TEXTS[1])).select(F.col("id").alias("image_id"), "line_no", "defect")


def p4_repaired(spark: SparkSession, d: str) -> DataFrame:
    return p4.read_repaired(table(spark, d, TEXTS[1])).select(F.col("id").alias("image_id"), "text")


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    found = p5.outside_article(table(spark, d, TEXTS[0]))
    return found.select(F.col("id").alias("page_id"), F.explode("lines").alias("line_no"))


def p5_articles(spark: SparkSession, d: str) -> DataFrame:
    return p5.main_content(table(spark, d, TEXTS[0]))


def _repaired(spark: SparkSession, d: str) -> DataFrame:
    pages = p6.repaired(table(spark, d, "scraped_texts"), "page_id", "text").withColumn("record_table", F.lit("scraped_texts"))
    links = p6.repaired(table(spark, d, "links_extracted"), "link_id", "context").withColumn("record_table", F.lit("links_extracted"))
    return pages.unionByName(links).withColumnRenamed("id", "record_id")


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return _repaired(spark, d).select("record_table", "record_id")


def p6_restored(spark: SparkSession, d: str) -> DataFrame:
    return _repaired(spark, d).select("record_table", "record_id", "text", F.array_join("encodings", ",").alias("encodings"), "lost")


def _checked(spark: SparkSession, d: str) -> DataFrame:
    store = p7.seeded_store(table(spark, d, "url_history"), f"{shared_dir(spark)}/p7-store-{uuid.uuid4().hex}", buckets=32)
    return p7.checked_links(table(spark, d, "links_extracted"), store, runs=4)


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return _checked(spark, d).where(~F.col("is_new")).select(F.col("id").alias("link_id"))


def p7_batches(spark: SparkSession, d: str) -> DataFrame:
    return _checked(spark, d).groupBy(F.col("batch").alias("batch_no")).agg(
        F.count(F.lit(1)).alias("links"), F.count_if("is_new").alias("fresh"), F.count_if(~F.col("is_new")).alias("seen"), F.count_if(F.col("is_new").isNull()).alias("no_address")
    )


def p8_packed(spark: SparkSession, d: str) -> DataFrame:
    limits = p8.read_limits(table(spark, d, "pack_limits"))
    return p8.packed(p8.token_sizes(table(spark, d, "documents"), "doc_id", "text"), limits)


def p8_instructions(spark: SparkSession, d: str) -> DataFrame:
    """Titles as prompts: at most 64 segments and nine tenths of the tokens bearing loss."""
    limits = p8.read_limits(table(spark, d, "pack_limits"))
    sizes = p8.token_sizes(table(spark, d, "documents"), "doc_id", "text", "title")
    return p8.packed(sizes, limits, max_segments=64, loss_share=0.9)


def p8_fill(spark: SparkSession, d: str) -> DataFrame:
    limits = p8.read_limits(table(spark, d, "pack_limits"))
    return p8.packing_report(p8_packed(spark, d), limits)


def p8_broken(spark: SparkSession, d: str) -> DataFrame:
    """How often each limit's assignment breaks a rule: tokens, segments or loss above the limits, texts left out, doubled or split without need."""
    docs = table(spark, d, "documents")
    limits = p8.read_limits(table(spark, d, "pack_limits"))
    sizes = written(p8.token_sizes(docs, "doc_id", "text", "title"), "p8-checked")
    return p8.broken_rules(p8.packed(sizes, limits, max_segments=48, loss_share=0.97), sizes, limits, max_segments=48, loss_share=0.97)


def _leaks(spark: SparkSession, d: str) -> DataFrame:
    return p9.leaks(table(spark, d, "documents"), table(spark, d, "eval_items"))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return _leaks(spark, d).where(F.col("field") == "passage").select("doc_id", "item_id").distinct()


def p9_spans(spark: SparkSession, d: str) -> DataFrame:
    return _leaks(spark, d)


def p9_items(spark: SparkSession, d: str) -> DataFrame:
    return p9.leak_report(_leaks(spark, d))


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return p10.judged(table(spark, d, "documents")).where("truncated").select(F.col("id").alias("doc_id"))


def p10_sources(spark: SparkSession, d: str) -> DataFrame:
    return p10.truncation_by_source(table(spark, d, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = [
        p1_found, p1_clean, p2_found, p2_flags, p3_found, p3_groups, p3_links, p4_found, p4_repaired, p5_found, p5_articles, p6_found, p6_restored,
        p7_found, p7_batches, p8_packed, p8_instructions, p8_fill, p8_broken, p9_found, p9_spans, p9_items, p10_found, p10_sources,
    ]
    return {f.__name__: f for f in own}
