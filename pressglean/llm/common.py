"""Expressions that several text operators share."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def site_of(url: Column) -> Column:
    """Host of `url` in lower case without a leading `www.`, user or port; NULL if there is none."""
    host = F.lower(F.regexp_extract(F.trim(url), r"^[a-zA-Z][a-zA-Z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    return F.nullif(F.regexp_replace(host, r"^www\.", ""), F.lit(""))


def lines_of(text: Column) -> Column:
    return F.split(text, "\n")


def same_line(line: Column) -> Column:
    """Form in which two lines are compared: white space collapsed, lower case, digit runs as one 0."""
    return F.lower(F.trim(F.regexp_replace(F.regexp_replace(line, r"(?U)\s+", " "), r"\p{Nd}+", "0")))
