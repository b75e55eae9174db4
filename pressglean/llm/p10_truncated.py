"""Text cut off by field limits.

Per source, histograms of the length in characters and in bytes are tested for spikes, where a limit of the
field cut many texts alike; they settle doubtful ends only. A value is flagged if it ends without terminal punctuation, or in the mark that
a cut leaves behind, unless its last line is a closing line: a signature, source, tag, list or date line.
What counts as closing is counted over all texts: such lines stand at the ends of texts, not within.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pressglean.runtime import small_side, written

# Invitations to read on that follow a cut.
READ_ON = "leer más|leer mas|ver más|seguir leyendo|sigue leyendo|leer completo|continúa|continuar leyendo|read more|continue reading|more|leia mais|continue lendo|saiba mais"
#: What a cut leaves behind at the end: an ellipsis, alone or in brackets, an invitation to read on, a broken
#: character, an unfinished entity or tag.
MARK_RE = r"(?iU)(\s*[\[(]\s*(\.{2,}|…)\s*[\])]|\s*\[\s*\+\s*\d+\s*\w+\s*\]|\s*(\.{3,}|…)?\s*[\[(»>]*\s*\b(" + READ_ON + r")[\])»>.…]*|\s*(\.{3,}|…)|�+|&#?\w{0,8};?|<[^<>\n]*)\s*$"
#: A text that ends like this is complete.
END_RE = r"[.!?。]['\"”’»)\]]*$|[»”)\]]$"


def skeleton(line: Column) -> Column:
    """A line with names as N and digit runs as 0, so that lines of one making agree. A line of one word stays."""
    s = F.regexp_replace(F.trim(F.regexp_replace(line, r"(?U)\s+", " ")), r"\p{Nd}+", "0")
    return F.when(F.instr(s, " ") > 0, F.regexp_replace(s, r"(?<!\p{L})\p{Lu}\p{Ll}{3,}", "N")).otherwise(s)


def opening(skel: Column) -> Column:
    """First two tokens of a skeleton."""
    return F.array_join(F.slice(F.split(skel, " "), 1, 2), " ")


def endings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(id, source, chars, bytes, mark, core, last, own_line) of each text that isn't NULL or blank."""
    d = docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), F.col(text_col).alias("text"))
    body = F.regexp_replace("text", r"(?U)\s+$", "")
    d = d.select("id", "source", F.length("text").alias("chars"), F.octet_length("text").alias("bytes"), body.alias("body")).where(F.col("body") != "")
    last = F.substring_index("body", "\n", -1)
    mark = F.regexp_extract("last", MARK_RE, 0)
    d = d.select("id", "source", "chars", "bytes", last.alias("last"), (F.length(last) < F.length("body")).alias("own_line"))
    d = d.withColumn("mark", mark)
    return d.withColumn("core", F.regexp_replace(F.expr("substring(last, 1, length(last) - length(mark))"), r"(?U)\s+$", ""))


def spikes(ends: DataFrame, least: int = 5, factor: float = 6.0, reach: int = 40, near: int = 3) -> DataFrame:
    """(source, unit, length, n): lengths at which `factor` times as many texts of a source stop as around them.

    Trimmed ends make a cut text up to `near` units shorter, so these lengths count together. A window holds one
    source's distinct lengths, never its texts.
    """
    both = ends.select("source", F.explode(F.array(F.struct(F.lit("chars").alias("unit"), F.col("chars").alias("length")), F.struct(F.lit("bytes").alias("unit"), F.col("bytes").alias("length")))).alias("u"))
    hist = both.groupBy("source", "u.unit", "u.length").agg(F.count(F.lit(1)).alias("n"))
    by_length = Window.partitionBy("source", "unit").orderBy("length")
    wide, own = (F.sum("n").over(by_length.rangeBetween(low, high)) for low, high in ((-reach, reach), (-near, 0)))
    rate = (wide - own) / (2 * reach - near)
    return hist.withColumn("rate", rate).where(F.col("n") >= F.greatest(F.lit(float(least)), factor * F.col("rate"))).select("source", "unit", "length", "n")


def closing_openings(docs: DataFrame, ends: DataFrame, text_col: str = "text", least: int = 3) -> DataFrame:
    """(opening): how lines begin that close texts without punctuation and hardly stand elsewhere, over all texts.

    Scraps of a line that a limit cut off recur too, but at the limit: most texts with a closing line must
    end off it. An opening of one token is held against the first tokens of all lines.
    """
    open_end = ends.where(F.col("own_line") & ~F.col("core").rlike(END_RE)).select(opening(skeleton(F.col("last"))).alias("opening"), "at_limit")
    at_end = open_end.groupBy("opening").agg(F.count(F.lit(1)).alias("n_end"), F.count_if("at_limit").alias("n_limit")).where((F.col("n_end") >= least) & (F.col("n_limit") <= 0.5 * F.col("n_end")))
    at_end = small_side(at_end.drop("n_limit"), "p10-openings")
    lines = docs.select(F.explode(F.split(text_col, "\n")).alias("line")).where(F.trim("line") != "")
    starts = lines.select(opening(skeleton(F.col("line"))).alias("two"))
    starts = starts.select(F.explode(F.array_distinct(F.array("two", F.substring_index("two", " ", 1)))).alias("opening"))
    n_in = starts.join(at_end.select("opening"), "opening").groupBy("opening").agg(F.count(F.lit(1)).alias("n_lines"))
    # n_lines counts the closing lines themselves too
    return at_end.join(n_in, "opening", "left").where(F.coalesce("n_lines", F.lit(0)) - F.col("n_end") <= 0.5 * F.col("n_end")).select("opening")


def judged(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", near: int = 3) -> DataFrame:
    """(id, source, chars, bytes, at_limit, marked, truncated) of each row.

    NULL and blank texts are not truncated and have no length; a NULL source counts as one source of its own.
    Ties and repeated rows are judged one by one; an empty table gives an empty result.
    """
    docs = docs.withColumn(source_col, F.coalesce(source_col, F.lit("")))
    ends = written(endings(docs, id_col, text_col, source_col), "p10-ends")
    spike = spikes(ends, near=near)
    limits = spike.groupBy("source").agg(
        F.collect_set(F.when(F.col("unit") == "chars", F.col("length"))).alias("char_limits"), F.collect_set(F.when(F.col("unit") == "bytes", F.col("length"))).alias("byte_limits")
    )
    ends = ends.join(small_side(limits, "p10-limits", 100_000), "source", "left")

    def reached(limits: str, length: str) -> Column:
        return F.exists(F.coalesce(F.col(limits), F.array().cast("array<int>")), lambda x: (F.col(length) <= x) & (F.col(length) >= x - near))

    ends = ends.withColumn("at_limit", reached("char_limits", "chars") | reached("byte_limits", "bytes")).drop("char_limits", "byte_limits")
    at_limit = F.col("at_limit")
    skel = ends.where("own_line").select(skeleton(F.col("last")).alias("skel")).groupBy("skel").agg(F.count(F.lit(1)).alias("n_skel")).where("n_skel >= 3")
    close = closing_openings(docs, ends, text_col).withColumn("closing", F.lit(True))
    e = ends.withColumn("skel", skeleton(F.col("last"))).withColumn("opening", opening(F.col("skel")))
    e = e.join(small_side(skel, "p10-skeletons"), "skel", "left").join(small_side(close, "p10-closing"), "opening", "left")
    complete = F.col("core").rlike(END_RE)
    # a number cut at its decimal point looks like the end of a sentence
    half_number = F.col("core").rlike(r"(?<![\p{Nd},.])\p{Nd}{1,3}\.$") & at_limit & (F.col("mark") == "")
    closes = F.col("own_line") & F.coalesce("closing", F.lit(False)) & (F.col("n_skel").isNotNull() | ~at_limit)
    cut = F.when(F.col("mark") != "", ~complete & (F.col("core") != "")).otherwise(~complete | half_number) & ~closes
    # a line that is a mark alone says that the rest is elsewhere; the text before it decides nothing here
    return e.select("id", "source", "chars", "bytes", "at_limit", (F.col("mark") != "").alias("marked"), cut.alias("truncated"))


def truncation_by_source(docs: DataFrame, **cols: str) -> DataFrame:
    """(source, texts, truncated, share, at_limit): how often each source cuts its texts."""
    j = judged(docs, **cols)
    return j.groupBy("source").agg(
        F.count(F.lit(1)).alias("texts"), F.count_if("truncated").alias("truncated"), F.round(F.avg(F.col("truncated").cast("double")), 6).alias("share"), F.count_if(F.col("truncated") & F.col("at_limit")).alias("at_limit")
    )
