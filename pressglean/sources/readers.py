"""Readers of the inputs and of what earlier runs wrote. Missing or broken files give empty frames."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LINK_FIELDS = "Page INT, URL STRING, Rect STRING, Context STRING"
LINK = "ds DATE, link_no INT, page INT, url STRING, rect ARRAY<DOUBLE>, context STRING"
SNAPSHOT = "Page INT, URL STRING, Rect ARRAY<DOUBLE>, Context STRING"
IMAGE_META = "context STRING, filepath STRING, filename STRING, content_type STRING, size BIGINT, download_timestamp STRING, error STRING"
BLOCK = "doc_id STRING, page INT, block_no INT, text STRING"
CACHE = "timestamp DOUBLE, content STRING, expiry_seconds BIGINT, expires_at STRING"
DAY_RE = r"(\d{8})(?:_[a-z_]+)?\.[a-z]+$"


def found(spark: SparkSession, pattern: str) -> list[str]:
    """Files that match a pattern of the shared file system, in order."""
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(str(x.getPath().toString()) for x in (fs.globStatus(path) or []))


def _day() -> F.Column:
    return F.try_to_timestamp(F.regexp_extract(F.input_file_name(), DAY_RE, 1), F.lit("ddMMyyyy")).cast("date")


def link_csv(spark: SparkSession, pattern: str) -> DataFrame:
    """Links of dated CSV files: header row, the rectangle as the text of a tuple."""
    files = found(spark, pattern)
    if not files:
        return spark.createDataFrame([], LINK)
    raw = spark.read.schema(LINK_FIELDS).option("mode", "PERMISSIVE").csv(files, header=True, quote='"', escape='"', multiLine=True)
    # files are small and each is read by one task: the row's place in it is its number
    numbered = raw.select("*", _day().alias("ds"), F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("_at"), F.input_file_name().alias("_file"))
    first = numbered.groupBy("_file").agg(F.min("_at").alias("_first"))
    rect = F.from_json(F.translate("Rect", "()", "[]"), "array<double>")
    return numbered.join(F.broadcast(first), "_file").select("ds", (F.col("_at") - F.col("_first") + 1).cast("int").alias("link_no"), F.col("Page").alias("page"), F.col("URL").alias("url"), rect.alias("rect"), F.col("Context").alias("context"))


def link_snapshots(spark: SparkSession, pattern: str, skip_day: str | None = None) -> DataFrame:
    """Links of dated JSON arrays, those of `skip_day` (ddMMyyyy) left out."""
    files = [f for f in found(spark, pattern) if not (skip_day and skip_day in f.rsplit("/", 1)[-1])]
    if not files:
        return spark.createDataFrame([], LINK)
    raw = spark.read.schema("_corrupt_record STRING, " + SNAPSHOT).option("multiLine", True).json(files)
    kept = raw.where("URL is not null").select(_day().alias("ds"), F.lit(None).cast("int").alias("link_no"), F.col("Page").alias("page"), F.col("URL").alias("url"), F.col("Rect").alias("rect"), F.col("Context").alias("context"))
    return kept


def _maps(spark: SparkSession, files: list[str], value: str) -> DataFrame:
    text = spark.read.text(files, wholetext=True).select(F.regexp_replace("value", "^\\uFEFF", "").alias("value"), _day().alias("ds"))
    return text.select("ds", F.explode(F.from_json("value", f"map<string,struct<{_struct(value)}>>")).alias("url", "v"))


def _struct(ddl: str) -> str:
    return ", ".join(re.sub(r"^(\w+) ", r"\1: ", x) for x in ddl.split(", "))


def image_metadata(spark: SparkSession, pattern: str) -> DataFrame:
    """(ds, url, context, filepath, filename, content_type, size, download_timestamp, error) of JSON maps by URL; a leading mark of byte order is ignored."""
    files = found(spark, pattern)
    if not files:
        return spark.createDataFrame([], f"ds DATE, url STRING, {IMAGE_META}")
    return _maps(spark, files, IMAGE_META).where("v is not null").select("ds", "url", "v.*")


def valid_items(meta: DataFrame) -> DataFrame:
    """Rows with a file path: what can be sent on to text recognition."""
    return meta.where(F.coalesce(F.length("filepath"), F.lit(0)) > 0)


def local_images(spark: SparkSession, folder: str) -> DataFrame:
    """(url, filepath, filename, content_type, size) of image files below a folder, as file:// rows."""
    if not found(spark, folder):
        return spark.createDataFrame([], "url STRING, filepath STRING, filename STRING, content_type STRING, size BIGINT")
    f = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder).select("path", "length")
    path = F.regexp_replace("path", "^file:/+", "/")
    ext = F.lower(F.substring_index("path", ".", -1))
    kind = F.when(ext.isin("png", "gif", "bmp", "webp", "tiff"), F.concat(F.lit("image/"), ext)).otherwise("image/jpeg")
    return f.where(ext.isin("jpg", "jpeg", "png", "gif", "bmp", "webp", "tiff")).select(F.concat(F.lit("file://"), path).alias("url"), path.alias("filepath"), F.substring_index("path", "/", -1).alias("filename"), kind.alias("content_type"), F.col("length").alias("size"))


def csv_rows(spark: SparkSession, path: str, schema: str) -> DataFrame:
    files = found(spark, path)
    return spark.read.schema(schema).option("mode", "PERMISSIVE").csv(files, header=True) if files else spark.createDataFrame([], schema)


def json_rows(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows of a JSON file; records that can't be read are left out."""
    files = found(spark, path)
    if not files:
        return spark.createDataFrame([], schema)
    return spark.read.schema(f"{schema}, _corrupt_record STRING").option("multiLine", True).json(files).where("_corrupt_record is null").drop("_corrupt_record")


def history(spark: SparkSession, path: str) -> DataFrame:
    """(url) of a JSON array of URLs; a missing or broken file is an empty history."""
    files = found(spark, path)
    if not files:
        return spark.createDataFrame([], "url STRING")
    return spark.read.text(files, wholetext=True).select(F.explode(F.from_json("value", "array<string>")).alias("url")).where("url is not null").distinct()


def cache_files(spark: SparkSession, pattern: str, prefixes: tuple[str, ...] = ("ocr_", "api_")) -> DataFrame:
    """(ns, key, ts, content, expiry_seconds) of cache files, whose names are prefix and key."""
    files = [f for f in found(spark, pattern) if f.endswith(".json") and (not prefixes or f.rsplit("/", 1)[-1].startswith(prefixes))]
    if not files:
        return spark.createDataFrame([], "ns STRING, key STRING, ts TIMESTAMP, content STRING, expiry_seconds BIGINT")
    name = F.regexp_extract(F.input_file_name(), r"([^/]+)\.json$", 1)
    raw = spark.read.text(files, wholetext=True).select(name.alias("name"), F.get_json_object("value", "$.timestamp").cast("double").alias("t"), F.get_json_object("value", "$.content").alias("content"), F.get_json_object("value", "$.expiry_seconds").cast("long").alias("expiry_seconds"))
    ns = F.regexp_extract("name", r"^([a-z]+)_", 1)
    return raw.select(F.when(ns != "", ns).otherwise("page").alias("ns"), F.regexp_replace("name", r"^[a-z]+_", "").alias("key"), F.timestamp_micros((F.col("t") * 1_000_000).cast("long")).alias("ts"), "content", "expiry_seconds")


def or_earlier(new: DataFrame, earlier: DataFrame) -> DataFrame:
    """`new`, or what an earlier run wrote if this one brought nothing."""
    return earlier if new.isEmpty() else new
