"""Sections and paragraphs of digests, text within boxes, and page texts put together."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pressglean.config import FIRST_SECTION, SECTION_HEADERS
from pressglean.functions import text as T
from pressglean.functions.url import first_url

#: Height of the bands by which words and boxes of a page are brought together.
BAND = 60.0


def sectioned(blocks: DataFrame, doc_col: str = "doc_id", headers: tuple[str, ...] = SECTION_HEADERS, first: str = FIRST_SECTION) -> DataFrame:
    """Blocks (doc, page, block_no, text) without headers, each with the header before it carried forward.

    Blank blocks are dropped. A document is one digest, which bounds the window.
    """
    b = blocks.withColumn("stripped", T.normalized(F.col("text"))).where(F.col("stripped") != "")
    raw = F.regexp_replace(F.regexp_replace("text", r"(?U)^\s+", ""), r"(?U)\s+$", "")
    b = b.withColumn("raw", raw)
    b = b.withColumn("header", F.coalesce(T.known_header(F.col("raw"), headers), F.when(T.capital_header(F.col("raw")), F.col("raw"))))
    w = Window.partitionBy(doc_col).orderBy("page", "block_no").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    b = b.withColumn("section", F.coalesce(F.last("header", ignorenulls=True).over(w), F.lit(first)))
    return b.where("header is null").select(doc_col, "section", "page", "block_no", "text")


def paragraphs(sections: DataFrame) -> DataFrame:
    """Cleaned paragraphs with description and first URL; those with an e-mail address or nothing left are dropped."""
    p = sections.withColumn("text", T.cleaned(F.col("text"))).where(F.col("text") != "").where(~T.has_email(F.col("text")))
    return p.withColumn("description", T.brief_description(F.col("text"))).withColumn("url", first_url(F.col("text")))


def grouped(paras: DataFrame, doc_col: str = "doc_id") -> DataFrame:
    """(doc, section, paragraphs): paragraphs of each section in order; a section that comes again is one."""
    item = F.struct("page", "block_no", "text", "description", "url")
    return paras.groupBy(doc_col, "section").agg(F.array_sort(F.collect_list(item)).alias("paragraphs"))


def section_counts(paras: DataFrame, doc_col: str = "doc_id") -> DataFrame:
    """(sections, paragraphs) over all documents; a section counts once per document."""
    each = paras.groupBy(doc_col, "section").agg(F.count(F.lit(1)).alias("n"))
    return each.agg(F.count(F.lit(1)).alias("sections"), F.coalesce(F.sum("n"), F.lit(0)).alias("paragraphs"))


def joined_pages(pages: DataFrame, doc_col: str = "doc_id") -> DataFrame:
    """(doc, text): page texts of a document in order, each followed by a blank line, trimmed at the end."""
    ordered = F.array_sort(F.collect_list(F.struct("page", F.coalesce("text", F.lit("")).alias("text"))))
    text = F.array_join(F.transform(ordered, lambda x: x["text"]), "\n\n")
    return pages.groupBy(doc_col).agg(F.regexp_replace(F.regexp_replace(text, r"^\s+", ""), r"\s+$", "").alias("text"))


def words_in_boxes(words: DataFrame, boxes: DataFrame, keys: list[str], box_id: str) -> DataFrame:
    """(keys, box_id, text): the words whose centre lies in each box, in reading order, joined by spaces.

    words: keys, x0, y0, x1, y1, word, word_no. boxes: keys, box_id, box ARRAY<DOUBLE>. A word lies in one
    horizontal band by its centre, a box in all bands it touches, so the join is on equal keys and band.
    """
    w = words.withColumn("cx", (F.col("x0") + F.col("x1")) / 2).withColumn("cy", (F.col("y0") + F.col("y1")) / 2).withColumn("band", F.floor(F.col("cy") / BAND))
    b = boxes.where("box is not null").withColumn("band", F.explode(F.sequence(F.floor(F.col("box")[1] / BAND), F.floor(F.col("box")[3] / BAND))))
    hit = w.join(b, [*keys, "band"]).where((F.col("cx") >= F.col("box")[0]) & (F.col("cx") <= F.col("box")[2]) & (F.col("cy") >= F.col("box")[1]) & (F.col("cy") <= F.col("box")[3]))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("word_no", "word"))), lambda x: x["word"]), " ")
    return hit.groupBy(*keys, box_id).agg(text.alias("text"))
