"""Text expressions: normal forms, headers, descriptions, relevance and error classes."""

from __future__ import annotations

import unicodedata
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from pressglean.config import KEYWORDS, PERMANENT_ERRORS, SECTION_HEADERS
from pressglean.functions.url import FIND_RE

SPACE_RE = r"(?U)\s+"
# Fixed value: addresses as the engine knows them.
EMAIL_RE = r"[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}"
# Fixed value: capitals, white space, dashes and slashes alone; no letter is needed.
HEADER_RE = r"^[A-ZÁÉÍÓÚÑ\s\-–/]{5,}$"


def _bases() -> tuple[str, str]:
    """Latin letters that decompose into a letter and combining marks, and those letters."""
    pairs = [(chr(n), unicodedata.normalize("NFD", chr(n))) for n in (*range(0xC0, 0x250), *range(0x1E00, 0x1F00))]
    pairs = [(c, d[0]) for c, d in pairs if len(d) > 1 and d[0].isascii() and all(unicodedata.combining(m) for m in d[1:])]
    return "".join(c for c, _ in pairs), "".join(b for _, b in pairs)


MARKED, BASE = _bases()
#: Prompts that a text recognition client may hold; the key of the default stands in for unknown keys.
PROMPT_KEYS = ("simple", "detallado", "estructurado", "tablas")


def normalized(text: Column) -> Column:
    """White space of any kind collapsed and trimmed; NULL becomes ''."""
    return F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), SPACE_RE, " "))


def folded(text: Column) -> Column:
    """As `normalized`, with accents and combining marks dropped (ñ becomes n)."""
    return F.trim(F.regexp_replace(F.translate(F.regexp_replace(F.coalesce(text, F.lit("")), r"\p{Mn}+", ""), MARKED, BASE), SPACE_RE, " "))


def cleaned(text: Column) -> Column:
    """Control characters as spaces, then white space collapsed and trimmed; NULL becomes ''."""
    return normalized(F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x00-\x1F\x7F]", " "))


def has_email(text: Column) -> Column:
    return F.coalesce(text.rlike(EMAIL_RE), F.lit(False))


def brief_description(text: Column, max_words: int = 5) -> Column:
    """First words without URLs and '...'; a text of at most `max_words` words stays as it is inside."""
    bare = F.regexp_replace(F.coalesce(text, F.lit("")), FIND_RE, "")
    stripped = F.regexp_replace(F.regexp_replace(bare, r"(?U)^\s+", ""), r"(?U)\s+$", "")
    words = F.split(stripped, SPACE_RE)
    return F.when((stripped == "") | (F.size(words) <= max_words), stripped).otherwise(F.concat(F.array_join(F.slice(words, 1, max_words), " "), F.lit("...")))


def _header_key(header: str) -> str:
    plain = "".join(c for c in unicodedata.normalize("NFD", header) if not unicodedata.combining(c))
    return " ".join(plain.split()).upper()


def known_header(text: Column, headers: tuple[str, ...] = SECTION_HEADERS) -> Column:
    """The first of `headers` that equals the text but for accents and letter case, else NULL. The text is folded once."""
    by_key: dict[str, str] = {}
    for h in headers:
        by_key.setdefault(_header_key(h), h)
    names = F.create_map(*(F.lit(x) for pair in by_key.items() for x in pair))
    return F.try_element_at(names, F.upper(folded(text)))


def capital_header(text: Column) -> Column:
    """5 to 50 characters of capitals, white space, dashes and slashes."""
    return F.length(text).between(5, 50) & text.rlike(HEADER_RE)


def is_header(text: Column, headers: tuple[str, ...] = SECTION_HEADERS) -> Column:
    """A known header, or one of capitals."""
    t = F.coalesce(text, F.lit(""))
    return known_header(t, headers).isNotNull() | capital_header(t)


def canonical_header(text: Column, headers: tuple[str, ...] = SECTION_HEADERS) -> Column:
    return F.coalesce(known_header(text, headers), text)


def relevance(text: Column, keywords: tuple[tuple[str, float], ...] = KEYWORDS) -> Column:
    """Sum of the weights of the keywords that occur (as substrings, each once, in their order), 1 at most."""
    low, seen, total = F.lower(F.coalesce(text, F.lit(""))), set(), F.lit(0.0)
    for word, weight in keywords:
        if word.lower() not in seen:
            seen.add(word.lower())
            total = total + F.when(F.contains(low, F.lit(word.lower())), F.lit(float(weight))).otherwise(F.lit(0.0))
    return F.least(total, F.lit(1.0))


def relevance_input(title: Column, description: Column, text: Column) -> Column:
    return F.concat_ws(" ", *(F.coalesce(c, F.lit("")) for c in (title, description, text)))


def is_permanent_error(error: Column, terms: tuple[str, ...] = PERMANENT_ERRORS) -> Column:
    """Whether the error says that another try would fail too; false for NULL."""
    low = F.lower(F.coalesce(error, F.lit("")))
    return reduce(lambda a, b: a | b, [F.contains(low, F.lit(t)) for t in terms])


def error_class(error: Column) -> Column:
    """timeout, http, network or unexpected; NULL for success (NULL or '')."""
    e = F.nullif(error, F.lit(""))
    return (
        F.when(e.isNull(), F.lit(None).cast("string"))
        .when(F.startswith(e, F.lit("Timeout")), "timeout")
        .when(F.startswith(e, F.lit("HTTP Error")), "http")
        .when(F.startswith(e, F.lit("Network Error")), "network")
        .otherwise("unexpected")
    )


def prompt_key(key: Column, default: str = "detallado", known: tuple[str, ...] = PROMPT_KEYS) -> Column:
    return F.when(key.isin(*known), key).otherwise(F.lit(default))
