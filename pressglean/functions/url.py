"""URL expressions: parts, predicates and the category of a link. All are native, none throws."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pressglean.config import IMAGE_EXTENSIONS, IMAGE_PATHS, SOCIAL_DOMAINS

PARTS_RE = r"^([a-zA-Z][a-zA-Z0-9+.\-]*)://([^/?#]*)([^?#]*)"
# Fixed value: the class is a range from $ to _, so a match stops at # and ~ and keeps a trailing bracket or stop.
FIND_RE = r"https?://(?:[a-zA-Z]|[0-9]|[$-_@.&+]|[!*(),]|(?:%[0-9a-fA-F][0-9a-fA-F]))+"
# Image types that keep their own extension.
MIME_EXTENSIONS = ("jpeg", "jpg", "png", "gif", "bmp", "webp", "svg", "tiff")


def scheme(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, PARTS_RE, 1))


def netloc(url: Column) -> Column:
    """Host with user and port as they stand."""
    return F.regexp_extract(url, PARTS_RE, 2)


def path(url: Column) -> Column:
    return F.regexp_extract(url, PARTS_RE, 3)


def is_valid(url: Column) -> Column:
    """Whether there are a scheme and a host; false for NULL."""
    return F.coalesce((scheme(url) != "") & (netloc(url) != ""), F.lit(False))


def unquoted(url: Column) -> Column:
    """Percent escapes decoded; a plus sign stays, and so does all of a URL with a broken escape."""
    return F.coalesce(F.try_url_decode(F.regexp_replace(url, r"\+", "%2B")), url)


def _any(tests: list[Column]) -> Column:
    out = F.lit(False)
    for t in tests:
        out = out | t
    return out


def is_image(url: Column, extensions: tuple[str, ...] = IMAGE_EXTENSIONS, paths: tuple[str, ...] = IMAGE_PATHS) -> Column:
    p = F.lower(path(unquoted(url)))
    return is_valid(url) & _any([F.endswith(p, F.lit(e)) for e in extensions] + [F.contains(p, F.lit(x)) for x in paths])


def is_social(url: Column, domains: tuple[str, ...] = SOCIAL_DOMAINS) -> Column:
    """Whether the host is one of `domains` or below it; a port makes another host."""
    host = F.lower(netloc(url))
    return is_valid(url) & (host.isin(*domains) | _any([F.endswith(host, F.lit("." + d)) for d in domains]))


def category(url: Column, domains: tuple[str, ...] = SOCIAL_DOMAINS, extensions: tuple[str, ...] = IMAGE_EXTENSIONS, paths: tuple[str, ...] = IMAGE_PATHS) -> Column:
    """images, social, html or other; NULL for what is no URL."""
    return (
        F.when(~is_valid(url), F.lit(None).cast("string"))
        .when(is_image(url, extensions, paths), "images")
        .when(is_social(url, domains), "social")
        .when(scheme(url).isin("http", "https"), "html")
        .otherwise("other")
    )


def mentions(url: Column, needles: tuple[str, ...] = ("facebook.com", "fb.com")) -> Column:
    """Whether the URL holds one of `needles` anywhere, letter case ignored; false for NULL."""
    return F.coalesce(_any([F.contains(F.lower(url), F.lit(n)) for n in needles]), F.lit(False))


def is_mail(url: Column) -> Column:
    return F.coalesce(F.startswith(F.lower(url), F.lit("mailto:")), F.lit(False))


def fetch_mode(url: Column, dynamic: tuple[str, ...]) -> Column:
    """rendered for hosts that build their pages with scripts, else plain."""
    return F.when(mentions(url, dynamic), "rendered").otherwise("plain")


def urls_in(text: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(FIND_RE), F.lit(0))


def first_url(text: Column) -> Column:
    """First URL in a text, '' if there is none."""
    return F.coalesce(F.try_element_at(urls_in(text), F.lit(1)), F.lit(""))


def extension_of(content_type: Column) -> Column:
    """File extension of a media type, parameters dropped; .jpg for types that aren't known."""
    kind = F.substring_index(F.substring_index(F.coalesce(content_type, F.lit("")), ";", 1), "/", -1)
    slashed = F.contains(F.substring_index(F.coalesce(content_type, F.lit("")), ";", 1), F.lit("/"))
    return F.when(slashed & kind.isin(*MIME_EXTENSIONS), F.concat(F.lit("."), F.regexp_replace(kind, "jpeg", "jpg"))).otherwise(".jpg")
