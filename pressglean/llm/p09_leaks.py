"""Evaluation texts that leaked into a corpus.

One Aho-Corasick automaton holds blocks of the normalised test texts; every document is scanned once. Blocks
of half the wanted length are laid end to end, so that any run of `min_words` words of a test text holds a
whole block; each hit is then extended word by word to the run's true length. A question of fewer words is
one block, and a short answer counts where it stands near a run of its own item. Offsets are mapped back to
the document as it stands.
"""

from __future__ import annotations

import re
import unicodedata

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FIELDS = ("passage", "question", "answer")
#: Words between a run of an item and its short answer, at most.
NEAR = 50


class _Fold(dict):
    """Maps each character to one that is lower case without accents, or to a space; combining marks vanish."""

    def __missing__(self, cp: int):
        ch = unicodedata.normalize("NFD", chr(cp).lower())[:1]
        to = None if unicodedata.combining(chr(cp)) else (ch if ch.isalnum() else " ")
        self[cp] = to
        return to


def folded(text: str, table: dict) -> str:
    return text.translate(table)


def words_of(text: str) -> list[str]:
    return folded(text, _Fold()).split()


def _scanner(items: list[tuple[int, str, str]], min_words: int):
    """Function text -> [(item, field, words, start, end)] for test texts (item, field, text)."""
    import ahocorasick

    table, step = _Fold(), max(1, (min_words + 1) // 2)
    texts, answers, auto = [], {}, ahocorasick.Automaton()
    for item, field, text in items:
        words = folded(text, table).split()
        short = len(words) < min_words
        if short and field == "answer" and words:
            answers.setdefault(item, []).append(words)
        if not words or short and field != "question":
            continue
        n, size = len(texts), len(words) if short else step
        texts.append((item, field, words))
        for at in range(0, len(words) - size + 1, size):
            block = " " + " ".join(words[at : at + size]) + " "
            auto.add_word(block, auto.get(block, ()) + ((n, at, size),))
    if not texts:
        return lambda text: []
    auto.make_automaton()

    def scan(text: str) -> list[tuple[int, str, int, int, int]]:
        flat = " " + " ".join(text.translate(table).split()) + " "
        hits = list(auto.iter(flat))
        if not hits:
            return []
        words, best, spans = flat.split(), {}, None
        runs: dict[int, list[tuple[int, int]]] = {}  # item -> (first word, words) of its runs
        seen: set[tuple[int, int, int]] = set()  # (text, diagonal, first word) of runs found
        for end, places in hits:
            last = flat.count(" ", 0, end) - 1  # word that the hit ends with
            for n, at, size in places:
                first, test = last - size + 1, texts[n][2]
                a, b = first, at
                while a > 0 and b > 0 and words[a - 1] == test[b - 1]:
                    a, b = a - 1, b - 1
                if (n, a - b, a) in seen:
                    continue
                seen.add((n, a - b, a))
                length = first - a
                while a + length < len(words) and b + length < len(test) and words[a + length] == test[b + length]:
                    length += 1
                if length < min(min_words, len(test)):
                    continue
                runs.setdefault(texts[n][0], []).append((a, length))
                if length > best.get(n, (0, 0))[0]:
                    best[n] = (length, a)
        out = []
        for n, (length, a) in best.items():
            if spans is None:
                spans = original_spans(text, table)
            out.append((texts[n][0], texts[n][1], length, spans[a][0], spans[a + length - 1][1]))
        for item, places in runs.items():
            for answer in answers.get(item, ()):
                k = len(answer)
                at = next((i for a, length in places for i in range(max(0, a - NEAR - k), min(len(words) - k, a + length + NEAR) + 1) if words[i : i + k] == answer), None)
                if at is not None:
                    out.append((item, "answer", k, spans[at][0], spans[at + k - 1][1]))
        return out

    return scan


def original_spans(text: str, table: dict) -> list[tuple[int, int]]:
    """(start, end) in `text` of each word of its folded form."""
    kept, back = [], []
    for i, ch in enumerate(text):
        to = table[ord(ch)]
        if to is not None:
            kept.append(to)
            back.append(i)
    return [(back[m.start()], back[m.end() - 1] + 1) for m in re.finditer(r"\S+", "".join(kept))]


def leaks(docs: DataFrame, items: DataFrame, min_words: int = 12, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", fields: tuple[str, ...] = FIELDS) -> DataFrame:
    """(doc_id, item_id, field, words, start, end): the longest run of each test text that each document holds.

    A run counts from `min_words` consecutive words on; letter case, accents and all between words are
    ignored. start and end are offsets in the text as it stands (characters from 0, end exclusive). Questions
    shorter than `min_words` count whole, shorter answers within NEAR words of a run of their item's passage
    or question; passages shorter than that are left out. NULL texts and items give no
    rows, empty tables an empty result; repeated rows count one by one. The test items are a bounded set of
    held-out material: they are read on the driver and make one automaton, so the corpus is scanned once.
    """
    fields = tuple(f for f in fields if f in items.columns)
    rows = [(r[0], f, r[1 + i]) for r in items.select(item_col, *fields).toLocalIterator() for i, f in enumerate(fields) if r[1 + i] and r[0] is not None]
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).where(F.col("text").isNotNull())
    schema = "doc_id bigint, item_id bigint, field string, words int, start int, end int"

    def op(batches):
        scan = _scanner(rows, min_words)
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            found = [(i, *hit) for i, t in zip(ids, texts) for hit in scan(t)]
            cols = list(zip(*found)) if found else [[]] * 6
            types = [pa.int64(), pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.int32()]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, types)], ["doc_id", "item_id", "field", "words", "start", "end"])

    return source.mapInArrow(op, schema)


def leak_report(found: DataFrame) -> DataFrame:
    """(item_id, documents, fields, longest): which test items leaked, and into how many documents."""
    return found.groupBy("item_id").agg(
        F.count_distinct("doc_id").alias("documents"), F.array_join(F.array_sort(F.collect_set("field")), ",").alias("fields"), F.max("words").alias("longest")
    )
