"""HTML expressions. Native ones cover flat markup; `visible_text_nested` parses nested subtrees of one tag."""

from __future__ import annotations

import html
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from pressglean.functions.text import normalized

# Tags whose subtrees aren't content.
DROPPED = ("script", "style", "header", "footer", "nav", "aside", "form")
# Entities that are decoded natively; the ampersand comes last.
ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&copy;", "©"), ("&middot;", "·"), ("&aacute;", "á"), ("&eacute;", "é"), ("&iacute;", "í"), ("&oacute;", "ó"), ("&uacute;", "ú"), ("&ntilde;", "ñ"), ("&amp;", "&"))


CHARSET_RE = r"(?i)charset\s*=\s*[\"']?\s*([a-z0-9._:\-]+)"


def charset_of(body: Column, content_type: Column) -> Column:
    """The charset that the media type names, else the page's own first 1,024 bytes, else utf-8."""
    head = F.decode(F.substring(body, 1, 1024), "ISO-8859-1")
    named = F.coalesce(F.nullif(F.regexp_extract(F.coalesce(content_type, F.lit("")), CHARSET_RE, 1), F.lit("")), F.nullif(F.regexp_extract(head, CHARSET_RE, 1), F.lit("")), F.lit("utf-8"))
    return F.lower(named)


def decoded_body(body: Column, content_type: Column) -> Column:
    """A fetched page's bytes as text: by the charset it names, unknown ones as UTF-8; broken characters become U+FFFD.

    ASCII and UTF-8 pages without broken characters stay in native expressions; only the others reach Python.
    """

    @F.pandas_udf("string")
    def by_name(bodies: pd.Series, names: pd.Series) -> pd.Series:
        def one(b, name):
            if b is None:
                return None
            try:
                return bytes(b).decode(name, "replace")
            except LookupError:
                return bytes(b).decode("utf-8", "replace")

        return pd.Series([one(b, n) for b, n in zip(bodies, names)], dtype=object)

    name = charset_of(body, content_type)
    plain = name.isin("utf-8", "utf8", "us-ascii", "ascii") & F.is_valid_utf8(body.cast("string"))
    return F.when(plain, body.cast("string")).otherwise(by_name(F.when(~plain, body), name))


def needs_parser(page: Column) -> Column:
    """Whether a page has dropped tags within their own kind, or entities that aren't decoded natively."""
    native = "|".join(e[1:-1] for e, _ in ENTITIES)
    nested = r"(?is)<(" + "|".join(DROPPED) + r")\b[^>]*>(?:(?!</\1\b).)*?<\1\b"
    return F.coalesce(page.rlike(rf"&(?!(?:{native});)[#a-zA-Z]") | page.rlike(nested), F.lit(False))


def unescaped(text: Column) -> Column:
    """All entities decoded, numeric ones too."""

    @F.pandas_udf("string")
    def op(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else html.unescape(t))

    return F.coalesce(op(F.when(F.contains(text, F.lit("&")), text)), text)


def page_text(page: Column) -> Column:
    """As `visible_text`, for any markup: only pages that need the parser reach Python."""
    hard = needs_parser(page)
    return F.when(hard, visible_text_nested(F.when(hard, page))).otherwise(visible_text(page))


def decoded(text: Column) -> Column:
    for entity, char in ENTITIES:
        text = F.replace(text, F.lit(entity), F.lit(char))
    return text


def title(page: Column) -> Column:
    """Text of the first title element, '' if there is none."""
    return normalized(unescaped(F.regexp_extract(F.coalesce(page, F.lit("")), r"(?is)<title[^>]*>(.*?)</title\s*>", 1)))


def meta_description(page: Column) -> Column:
    """Content of the first meta element whose name holds 'description', whatever the order of its attributes."""
    tag = F.regexp_extract(F.coalesce(page, F.lit("")), r"""(?is)<meta\b(?=[^>]*\bname\s*=\s*["'][^"'>]*description)[^>]*>""", 0)
    return normalized(unescaped(F.regexp_extract(tag, r"""(?is)\bcontent\s*=\s*(["'])(.*?)\1""", 2)))


def without_boilerplate(page: Column) -> Column:
    return F.regexp_replace(F.coalesce(page, F.lit("")), r"(?is)<(" + "|".join(DROPPED) + r")\b[^>]*>.*?</\1\s*>", " ")


def visible_text(page: Column) -> Column:
    """Text nodes joined by spaces, the title among them; comments and dropped subtrees aren't."""
    bare = F.regexp_replace(without_boilerplate(page), r"(?s)<!--.*?-->", " ")
    return normalized(decoded(F.regexp_replace(bare, r"(?s)<[^>]*>", " ")))


def is_html(content_type: Column) -> Column:
    return F.coalesce(F.contains(F.lower(content_type), F.lit("text/html")), F.lit(False))


class _Text(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.depth, self.parts = 0, []

    def handle_starttag(self, tag, attrs):
        self.depth += tag in DROPPED

    def handle_endtag(self, tag):
        if tag in DROPPED and self.depth:
            self.depth -= 1

    def handle_data(self, data):
        if not self.depth and data.strip():
            self.parts.append(data.strip())


def visible_text_nested(page: Column) -> Column:
    """As `visible_text`, by a parser: same-tag nesting and all entities."""

    def one(markup: str | None) -> str:
        if markup is None:
            return ""
        parser = _Text()
        parser.feed(markup)
        parser.close()
        return " ".join(html.unescape(" ".join(parser.parts)).split())

    @F.pandas_udf("string")
    def parsed(pages: pd.Series) -> pd.Series:
        return pages.map(one)

    return parsed(page)
