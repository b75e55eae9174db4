"""Garbled text from a wrong character encoding: found and, where possible, restored.

A stretch of suspicious characters is encoded back under each legacy encoding it may have been read with
and decoded strictly as what it was meant to be; the reading is accepted if the cost of garbling drops, and
the step repeated for nested layers. Only rows with a suspicious character reach Python.
"""

from __future__ import annotations

import re
import unicodedata

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Encodings that UTF-8 is often misread with, and pairs of single-byte encodings mistaken for each other.
READ_AS = ("cp1252", "latin-1", "cp1251", "cp437", "cp850", "mac_roman", "cp1250", "cp866", "koi8-r", "iso8859-15")
SWAPS = (("mac_roman", "cp1252"), ("cp850", "cp1252"), ("cp437", "cp1252"), ("cp1251", "cp1252"), ("koi8-r", "cp1252"), ("cp1252", "cp850"), ("cp1252", "mac_roman"), ("cp437", "cp850"))
#: Characters that clean text of the corpus' languages is made of; a row of these alone is clean.
PLAIN = r"\x00-\x7fáéíóúñÁÉÍÓÚÑüÜ¿¡«»©º—–·›…“”‘’€° "
#: Plain characters are suspicious where garbling_cost charges for them. The branches, each of which starts with a
#: character outside ASCII or a question mark, are only tried where such a character stands.
SUSPECT_RE = rf"(?=[^\x00-\x3e\x40-\x7f])(?:[^{PLAIN}]|[·©›¡¿«“](?<=\p{{L}}.)|[°º…—–”‘’»€](?<=\p{{L}}.)(?=\p{{L}})|[·›º€](?=\p{{L}})|[ÁÉÍÓÚÑÜ](?:(?<=\p{{Ll}}.)|(?=[¡¿«»©º°·›…“”‘’€—–]))|[áéíóúñü](?<=\p{{Lu}}.)(?=\p{{Lu}})|\?\p{{L}}|\?(?<=\p{{L}}.) \p{{Ll}})"
HOME = set("áéíóúñÁÉÍÓÚÑüÜ¿¡«»“”‘’—–…")
SIGNS = set("©®º°ª£€§µ²³¹½¼¾×±·›‹•†™")
AFTER_ANY = set("º²³°…")
LOST = "�"
RUN_RE = re.compile(r"[^\x00-\x7f]+")
TOKEN_RE = re.compile(r"[^ \n\r\t]+")
#: A letter lost to a question mark: within a word, or where a word begins. Tokens that look like addresses don't count.
LOST_RE = re.compile(r"[^\W\d_]\?{1,2}[^\W\d_]|(?:^|[«(\"'])\?[^\W\d_]")

#: A dash within a word, as in regi—n: before it a piece with a vowel, behind it one that can't be a word.
SMALL, VOWELS = frozenset("abcdefghijklmnopqrstuvwxyzáéíóúñü"), frozenset("aeiouáéíóúü")
VOWELLESS_RE = re.compile(r"[b-df-hj-np-tv-xzñ]+(?![^\W\d_])")

#: Halves of garbled sequences whose rest is gone, as at the end of a cut context.
HALF_RE = re.compile(r"[a-záéíóúñ][ÃÂ](?![ÃÂ])|[\u2500-\u259f√]|[A-Za-z][\u0400-\u04ff]|[\u0400-\u04ff][A-Za-z]")


def _byte_of(enc: str) -> dict[str, int]:
    """The byte of each character outside ASCII in `enc`; of cp1252, C1 controls count as the bytes left undefined."""
    out = {}
    for n in range(0x80, 0x100):
        try:
            out[bytes([n]).decode(enc)] = n
        except UnicodeError:
            continue
    if enc == "cp1252":
        out |= {chr(n): n for n in range(0x80, 0xA0) if chr(n) not in out}
    return out


BYTES = {enc: _byte_of(enc) for enc in READ_AS}


def utf8_decoded(run: str, enc: str) -> str | None:
    """`run` with each stretch that is a UTF-8 sequence read as `enc` decoded, in one pass; None if there is none."""
    table, out, i, hit = BYTES[enc], [], 0, False
    while i < len(run):
        lead = table.get(run[i], 0)
        n = 2 if 0xC2 <= lead <= 0xDF else 3 if 0xE0 <= lead <= 0xEF else 4 if 0xF0 <= lead <= 0xF4 else 0
        part = [table.get(c, 0) for c in run[i : i + n]]
        if n and len(part) == n:
            try:
                out.append(bytes(part).decode("utf-8"))
            except UnicodeError:
                n = 0
        else:
            n = 0
        if n:
            hit, i = True, i + n
        else:
            out.append(run[i])
            i += 1
    return "".join(out) if hit else None


def _piece_with_vowel(token: str, end: int) -> bool:
    """Whether the small letters right before `end` hold a vowel."""
    at = end
    while at > 0 and token[at - 1] in SMALL:
        at -= 1
        if token[at] in VOWELS:
            return True
    return False


def garbling_cost(token: str) -> float:
    """How unlikely the characters outside ASCII are where they stand: 0 for clean text."""
    cost = 0.0
    scripts = {("L" if c < "Ͱ" else unicodedata.name(c, "?").split(" ")[0]) for c in token if c.isalpha()}
    for i, c in enumerate(token):
        if c < "\x80":
            continue
        before, after = token[i - 1 : i], token[i + 1 : i + 2]
        if c.isalpha() and c not in "ªºµ":
            cost += 0 if c in HOME else 5 if "\u0180" <= c < "Ͱ" else 4 if c in "ÐðÞþƒ" or (c == "ß" and (not before or before.lower() not in "aeiouäöüáéíóú")) else 1
            if c >= "Ͱ":
                cost += 3 if len(scripts) > 1 else 0
            elif c.isupper() and before.islower():
                cost += 3
            elif c.islower() and ((before.isupper() and after.isupper()) or (c in "øæœ" and after.isupper())):
                cost += 3
        elif c in "—–" and _piece_with_vowel(token, i) and VOWELLESS_RE.match(token, i + 1):
            cost += 3
        elif c in HOME:
            cost += 3 if c in "¿¡" and before.isalpha() and after.islower() else 2 if c in "¿¡" and before.isalpha() else 2 if c in "«“" and before.isalpha() and after.isalpha() else 0
        elif c in SIGNS:
            touches = (before.isalpha() and c not in AFTER_ANY) or (after.isalpha() and c not in "°µ©")
            cost += 4 if touches else 1
        elif "\x80" <= c <= "\x9f" or c == LOST:
            cost += 8
        elif c == "\xa0":
            cost += 0.5
        else:
            cost += 5
    return cost


def _utf8_reading(token: str) -> tuple[str, str] | None:
    """The cheapest reading of the token's runs as UTF-8, with the encoding they were misread in."""
    best = None
    cost = garbling_cost(token)
    for enc in READ_AS:
        hit = False

        def fix(m: re.Match) -> str:
            nonlocal hit
            got = utf8_decoded(m.group(), enc)
            hit |= got is not None
            return m.group() if got is None else got

        read = RUN_RE.sub(fix, token)
        if hit and (c := garbling_cost(read)) < cost:
            best, cost = (read, enc), c
    return best


def _swapped_reading(token: str) -> tuple[str, str] | None:
    """The cheapest reading under another single-byte encoding, if it makes the token wholly clean."""
    cost = garbling_cost(token)
    if cost < 3:
        return None
    for wrong, right in SWAPS:
        try:
            read = RUN_RE.sub(lambda m: m.group().encode(wrong).decode(right), token)
        except UnicodeError:
            continue
        if garbling_cost(read) == 0 and RUN_RE.search(read):
            return read, f"{wrong}>{right}"
    return None


def restored(text: str) -> tuple[str, list[str], int]:
    """(text, chain of encodings undone, number of lost characters). A text without damage comes back as it is.

    Layers are undone as long as the garbling cost drops, however many there are. The time is linear in the text.
    """
    chain: list[str] = []

    def fix(m: re.Match) -> str:
        token = m.group()
        while not token.isascii() and (got := _utf8_reading(token) or _swapped_reading(token)):
            token = got[0]
            chain.append(got[1])
        return token

    out = text if text.isascii() else TOKEN_RE.sub(fix, text)
    controls = sum("\x80" <= c <= "\x9f" for c in out)
    lost = out.count(LOST) + controls + len(HALF_RE.findall(out))
    if "?" in out:
        lost += sum(1 for t in out.split() if "?" in t and not any(c in t for c in "/=&") and LOST_RE.search(t))
        lost += len(re.findall(r"[a-záéíóúñ]\? [a-záéíóúñ]", out)) if "¿" not in out else 0
    return out, sorted(set(chain)), lost


def suspicious(text: Column) -> Column:
    return text.rlike(SUSPECT_RE)


def repaired(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, text, encodings, lost) of each affected row: the text restored as far as it can be had.

    encodings lists what was undone, lost counts the places whose characters are gone. Rows that are clean,
    NULL or empty don't come out; whole texts are searched; repeated rows come out as often as they stand;
    an empty table gives an empty result.
    """
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).where(suspicious(F.col("text")))

    def op(batches):
        for batch in batches:
            out = []
            for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                fixed, chain, lost = restored(t)
                if chain or lost:
                    out.append((i, fixed, chain, lost))
            cols = list(zip(*out)) if out else [[]] * 4
            types = [pa.int64(), pa.string(), pa.list_(pa.string()), pa.int32()]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, types)], ["id", "text", "encodings", "lost"])

    return rows.mapInArrow(op, "id bigint, text string, encodings array<string>, lost int")
