"""Keys, file names, dates, sizes and boxes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pressglean.functions.url import extension_of

#: Prefixes of cache keys by name space; pages and images have none.
NAMESPACES = {"page": "", "image": "", "social": "facebook_"}


def cache_key(value: Column, namespace: str = "page") -> Column:
    """MD5 in hex of a text or bytes; the name space of social pages goes into the hash."""
    return F.md5(F.concat(F.lit(NAMESPACES[namespace]), value.cast("string"))) if NAMESPACES[namespace] else F.md5(value)


def content_key(content: Column, prefix: str = "ocr_") -> Column:
    """Key of recognised text: by the image's bytes, so that copies share it."""
    return F.concat(F.lit(prefix), F.md5(content))


def asset_name(index: Column, url: Column, date: Column, content_type: Column) -> Column:
    return F.concat(F.lit("img_"), index.cast("string"), F.lit("_"), F.substring(F.md5(url), 1, 8), F.lit("_"), date, extension_of(content_type))


def capture_name(index: Column, date: Column) -> Column:
    return F.concat(date, F.lit("-"), index.cast("string"), F.lit(".pdf"))


def parsed_date(text: Column) -> Column:
    """Date from ddMMyyyy, NULL if it is none."""
    return F.when(text.rlike(r"^\d{8}$"), F.try_to_timestamp(text, F.lit("ddMMyyyy")).cast("date"))


def written_date(day: Column) -> Column:
    return F.date_format(day, "ddMMyyyy")


def rounded(seconds: Column) -> Column:
    """To two places, halves to even."""
    return F.bround(seconds, 2)


def size_mb(size: Column, unreadable: Column | None = None) -> Column:
    """Bytes as MB: 0 where the size is missing, 5 where the file can't be read."""
    mb = F.coalesce(size.cast("double"), F.lit(0.0)) / 1048576
    return mb if unreadable is None else F.when(F.coalesce(unreadable, F.lit(False)), F.lit(5.0)).otherwise(mb)


def fitted(width: Column, height: Column, area: int = 25_000_000) -> Column:
    """(width, height) scaled down to at most `area` pixels."""
    ratio = F.sqrt(F.lit(float(area)) / (width.cast("double") * height.cast("double")))
    big = width.cast("long") * height.cast("long") > area
    return F.struct(F.when(big, (width * ratio).cast("int")).otherwise(width.cast("int")).alias("width"), F.when(big, (height * ratio).cast("int")).otherwise(height.cast("int")).alias("height"))


def expanded(rect: Column, page_width: float, page_height: float, dx: float = 30.0, dy: float = 10.0) -> Column:
    """A box (x0, y0, x1, y1) grown by (dx, dy) and clipped to the page; NULL if nothing is left."""
    box = F.array(F.greatest(rect[0] - dx, F.lit(0.0)), F.greatest(rect[1] - dy, F.lit(0.0)), F.least(rect[2] + dx, F.lit(page_width)), F.least(rect[3] + dy, F.lit(page_height)))
    return F.when((F.size(rect) == 4) & (box[0] < box[2]) & (box[1] < box[3]), box)
