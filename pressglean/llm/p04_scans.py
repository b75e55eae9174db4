"""Noise in text from scanned pages: divided words, misread characters, running headers and page numbers.

Furniture is told by page-position features (distance to the page's edge or number, repetition within the scan,
whether it interrupts a sentence) of lines whose wording recurs over all scans. A character editor, an averaged
perceptron, predicts at each character to keep, replace, exchange, delete or insert, and at a line end whether
the line is joined and its hyphen kept. Nothing about misreadings is given: rare tokens are paired with frequent
words that differ in one place, and the editor learns from these pairs, from errors of the same kinds put
into frequent words, and from frequent words as they are. Its readings are weighed by counts over all scans and, for
names, by how common their letter sequences are.

Every distinct token is read once, whatever the number of its occurrences. Tokens, header keys and corrections are
tables; broadcast are the editor, counts of letter sequences (both of proven size) and tables of checked size.
"""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressglean.runtime import small_side, written

#: Bounds of the editor's training: frequent words, and rare tokens that are searched for their misreadings.
TRAIN_WORDS, RARE_TOKENS = 4_000, 40_000
#: A token so many times rarer than a reading of it is a misreading, however often it stands.
RARER = 20
#: Scans that must hold a header's wording.
LEAST_HEADERS = 4
#: Frequent words that needn't be looked up among the corrections; which ones are left out changes no result.
SKIPPED = 30_000

# Dividing marks at line ends, marks around words, page numbers, codes and units, digits in letters' place.
DIVIDERS = "-­¬‐‑"
EDGE = ".,;:«»()¿?¡!\"'“”‘’…*"
NUMBER_RE = r"(?iU)^[^\p{L}\p{Nd}]*(?:p[áa]g(?:ina|s)?\.?|p\.|page|folio|n[º°o]\.?)?\s*[\p{Nd}lIOoSZB|]{1,4}\s*(?:(?:/|de|of|di)\s*[\p{Nd}lIOoSZB]{1,4})?[^\p{L}\p{Nd}]*$"
DATE_RE = r"^(?:[0\s./,-]+|(?:0 de )?[a-zñ]+ (?:de )?0|(?:año|edición|n[º°o]\.?) 0)$"
UNIT_RE = re.compile(r"^(?:\d+(?:er|ro|do|to|mo|vo|no|ra|da|ta|a|o|h|hs|m|km|kg|cm|mm|ha|l|s|º|ª)|\d+[º°ª%]\w*|[a-z]{1,4}[\d²³]|\d+x\d+|https?\S*|www\S*|\S+@\S+\.\S+)$")
CODE_RE = re.compile(r"^(?:\d{1,2}[a-hj-km-npqrt-y]|[a-z]\d[a-z]|[a-z]{2,}[-/]?\d+[a-z]{0,2}|[a-z]{1,4}-\d+[a-z]{0,2})$")
# Letters that digits are read as. Numbers are all rare, so no frequent ones teach this.
DIGITS_READ = {"0": ["o"], "1": ["l", "i", "|"], "2": ["z"], "5": ["s"], "6": ["b"], "8": ["b"], "9": ["g"]}
LOOK_ALIKE = ("01569|!@+", "oisbgliat")
TOKEN_RE = re.compile(r"\S+")
END = re.compile(r"[.!?:…»\"”)]\s*$")
#: Marks a line end within a token given to the editor.
BREAK = "\n"
LETTERS = "abcdefghijklmnopqrstuvwxyzáéíóúñü"


def bare(token: str) -> str:
    """The token without punctuation at its edges; an exclamation mark that closes a word in small letters isn't part of it."""
    return token.strip(EDGE)


# ---------------------------------------------------------------- furniture


def _number_line(line: Column) -> Column:
    return (F.length(line) <= 22) & line.rlike(r"\p{Nd}|[lIOoSZB|]") & line.rlike(NUMBER_RE) & line.rlike(r"\p{Nd}")


def _header_key(part: Column) -> Column:
    """Wording of a part of a line: lower case, numbers as 0, digits within words as the letters they look like."""
    low = F.lower(part)
    plain = F.regexp_replace(low, r"(?<!\S)\p{Nd}+(?!\S)", "\u0001")
    return F.when(low.rlike(r"[\p{Nd}|!@+]"), F.translate(F.regexp_replace(F.translate(plain, *LOOK_ALIKE), r"\p{Nd}+", "0"), "\u0001", "0")).otherwise(low)


def line_table(scans: DataFrame) -> DataFrame:
    """(id, h, line, edge, cuts, key) of each page number (key NULL) and each wording under which a line would recur as a header.

    edge: within two lines of a page number or of the scan's start or end. cuts: the line before it ends within a
    sentence. key: hash of a wording. Texts are read once; the table written holds numbers only.
    """
    d = scans.select("id", F.xxhash64("text").alias("h"), F.split("text", "\n").alias("ls"))
    d = d.select("id", "h", F.filter(F.transform("ls", lambda s, i: F.struct(i.alias("line"), F.trim(s).alias("s"), _number_line(F.trim(s)).alias("number"))), lambda x: x["s"] != "").alias("ls"))
    d = d.withColumn("nums", F.filter(F.transform("ls", lambda x, j: F.when(x["number"], j)), lambda j: j.isNotNull()))
    row = F.transform("ls", lambda x, j: F.struct(
        x.alias("x"),
        ((j < 2) | (j >= F.size("ls") - 2) | F.exists("nums", lambda m: F.abs(m - j) <= 2)).alias("edge"),
        F.when(j > 0, ~F.element_at("ls", F.greatest(j, F.lit(1)))["s"].rlike(r"[.!?:…»\"”)]$")).otherwise(False).alias("cuts"),
    ))
    d = d.select("id", "h", F.explode(row).alias("r")).select("id", "h", "r.x.line", "r.x.number", "r.edge", "r.cuts", "r.x.s")
    d = d.where(F.col("number") | ((F.length("s") <= 75) & ~F.substring("s", -1, 1).isin(".", ";", ",")))
    several = F.array_distinct(F.concat(F.array(F.regexp_replace("s", r"\s{2,}", " ")), F.split("s", r"\s{2,}|\s[|–—·-]\s")))
    parts = F.when(F.col("number"), F.array(F.lit(""))).when(F.col("s").rlike(r"\s[\s|–—·-]"), several).otherwise(F.array("s"))
    d = d.select("id", "h", "line", "number", "edge", "cuts", F.explode(parts).alias("p")).where(F.col("number") | (F.length("p") >= 6))
    d = d.where(F.col("number") | (F.length("p") > 22) | ~F.col("p").rlike(NUMBER_RE)).withColumn("k", _header_key(F.col("p")))
    d = d.where(F.col("number") | (F.length("p") > 30) | ~F.col("k").rlike(DATE_RE))
    words = F.split("k", " ")
    first = F.when((F.size(words) > 3) & ~F.col("k").startswith("0 "), F.xxhash64(F.lit("^"), F.array_join(F.slice(words, 1, 3), " ")))
    keys = F.when(F.col("number"), F.array(F.lit(None).cast("bigint"))).otherwise(F.array_compact(F.array(F.xxhash64(F.lit("="), F.col("k")), first)))
    return written(d.select("id", "h", "line", "edge", "cuts", F.explode(keys).alias("key")), "p4-lines")


def furniture(lines: DataFrame) -> DataFrame:
    """(id, h, line, defect) of page numbers and running headers among the lines of `line_table`.

    A wording is that of a header if at least LEAST_HEADERS scans hold it, four in five of them at an edge and
    one in twelve more than once. A line with such wording is a header if it stands at an edge, recurs in
    its scan or interrupts a sentence.
    """
    each = lines.where("key is not null")
    recurring = each.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= LEAST_HEADERS).select("key")
    each = each.join(small_side(recurring, "p4-recurring"), "key")
    per_scan = each.groupBy("key", "id", "h").agg(F.max(F.col("edge").cast("int")).alias("edge"), F.count(F.lit(1)).alias("times"))
    counted = per_scan.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.sum("edge").alias("edge"), F.count_if(F.col("times") > 1).alias("again"))
    heads = counted.where((F.col("n") >= LEAST_HEADERS) & (F.col("edge") >= 0.8 * F.col("n")) & (F.col("again") >= F.greatest(F.lit(2.0), F.col("n") / 12.0)))
    hits = each.join(small_side(heads.select("key"), "p4-headers"), "key")
    placed = hits.groupBy("id", "h", "line").agg(F.max("edge").alias("edge"), F.max("cuts").alias("cuts"), F.collect_set("key").alias("keys"))
    again = hits.groupBy("id", "h", "key").agg(F.count(F.lit(1)).alias("times")).where("times > 1").groupBy("id", "h").agg(F.collect_set("key").alias("again"))
    placed = placed.join(again, ["id", "h"], "left").where(F.col("edge") | F.col("cuts") | F.coalesce(F.arrays_overlap("keys", "again"), F.lit(False)))
    numbers = lines.where("key is null").select("id", "h", "line", F.lit("page_number").alias("defect"))
    return written(numbers.unionByName(placed.select("id", "h", "line", F.lit("header").alias("defect"))).distinct(), "p4-furniture")


# ---------------------------------------------------------------- the editor


class CharEditor:
    """Averaged perceptron over the characters of a token.

    Labels: K keep, D delete, R+c replace by c, S exchange with the next character, I+c insert c behind; at the
    mark of a line end J joins, N doesn't (the hyphen before it is kept or deleted like any character). The
    weights are one row per feature seen in training; unseen features weigh nothing.
    """

    BITS = 20
    WINDOWS = ((0, 0), (-1, 0), (0, 1), (-1, 1), (-2, 0), (0, 2), (-2, 1), (-1, 2), (-2, 2), (-3, 0), (0, 3))

    def __init__(self, labels: tuple[str, ...] = ("K",), rows: np.ndarray | None = None, weights: np.ndarray | None = None):
        self.labels = labels
        self.rows = rows if rows is not None else np.zeros(1 << self.BITS, dtype=np.int32)
        self.weights = weights if weights is not None else np.zeros((1, len(labels)), dtype=np.float32)

    def plain(self) -> tuple:
        return self.labels, self.rows, self.weights

    @classmethod
    def features(cls, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(hashed features by position, word of each position, place within the word)."""
        lens = np.array([len(w) for w in words], dtype=np.int64)
        flat = np.frombuffer(("\0\0\0" + "\0\0\0".join(words) + "\0\0\0").encode("utf-32-le"), dtype=np.uint32).astype(np.uint64)
        start = 3 + np.concatenate([[0], np.cumsum(lens + 3)[:-1]]).astype(np.int64) if len(words) else np.zeros(0, np.int64)
        owner = np.repeat(np.arange(len(words)), lens)
        place = np.arange(len(owner)) - np.repeat(np.cumsum(lens) - lens, lens)
        at = start[owner] + place
        out = np.empty((len(at), len(cls.WINDOWS)), dtype=np.int32)
        for k, (a, b) in enumerate(cls.WINDOWS):
            h = np.full(len(at), k + 1, dtype=np.uint64)
            for d in range(a, b + 1):
                h = (h * np.uint64(0x9E3779B97F4A7C15)) ^ (flat[at + d] + np.uint64(0x632BE5AB))
            h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            out[:, k] = (h >> np.uint64(64 - cls.BITS)).astype(np.int32)
        return out, owner, place

    def scores(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        feats, owner, place = self.features(words)
        rows = self.rows[feats]
        total = self.weights[rows[:, 0]]
        for k in range(1, rows.shape[1]):
            total = total + self.weights[rows[:, k]]
        return total, owner, place

    def train(self, pairs: list[tuple[str, list[str]]], epochs: int = 3, seed: int = 7, batch: int = 256) -> CharEditor:
        """Learns (token, label of each character) pairs, in small batches; the weights are averaged over all steps."""
        self.labels = tuple(["K", *sorted({x for _, ls in pairs for x in ls} - {"K"})])
        number = {x: i for i, x in enumerate(self.labels)}
        feats, _, _ = self.features([s for s, _ in pairs])
        gold = np.array([number[x] for _, ls in pairs for x in ls], dtype=np.int64)
        seen = np.unique(feats)
        self.rows = np.zeros(1 << self.BITS, dtype=np.int32)
        self.rows[seen] = np.arange(1, len(seen) + 1)
        feats = self.rows[feats]
        live = np.zeros((len(seen) + 1, len(self.labels)), dtype=np.float32)
        total, step, rng = live.copy(), 1.0, np.random.default_rng(seed)
        for _ in range(epochs):
            order = rng.permutation(len(gold))
            for at in range(0, len(order), batch):
                of = order[at : at + batch]
                f, g = feats[of], gold[of]
                guess = live[f].sum(axis=1).argmax(axis=1)
                bad = guess != g
                if bad.any():
                    rows, n = f[bad].ravel(), f.shape[1]
                    for labels, by in ((np.repeat(g[bad], n), 1.0), (np.repeat(guess[bad], n), -1.0)):
                        np.add.at(live, (rows, labels), by)
                        np.add.at(total, (rows, labels), by * step)
                step += 1
        mean = live - total / step
        used = np.abs(mean).sum(axis=1) > 1e-6
        used[0] = False
        back = np.zeros(len(mean), dtype=np.int32)
        back[used] = np.arange(1, used.sum() + 1)
        self.rows = back[self.rows]
        self.weights = np.concatenate([np.zeros((1, len(self.labels)), np.float32), mean[used]]).astype(np.float32)
        return self

    def edits(self, words: list[str], margin: float = 6.0, most: int = 10) -> list[list[tuple[str, float]]]:
        """The likely readings of each word other than the word itself, best first, with their gain over keeping all."""
        out: list[list[tuple[str, float]]] = [[] for _ in words]
        if len(self.labels) == 1 or not words:
            return out
        scores, owner, place = self.scores(words)
        gain = scores - scores[:, :1]
        gain[:, [i for i, x in enumerate(self.labels) if x in ("K", "J", "N")]] = -np.inf
        spots = defaultdict(list)
        for _ in range(min(3, gain.shape[1])):  # the three likeliest labels of each place
            label = gain.argmax(axis=1)
            best_gain = gain[np.arange(len(gain)), label]
            at = np.flatnonzero(best_gain > -margin)
            for w, g, p, x in zip(owner[at].tolist(), best_gain[at].tolist(), place[at].tolist(), label[at].tolist()):
                spots[w].append((g, p, self.labels[x]))
            gain[np.arange(len(gain)), label] = -np.inf
        for w, found in spots.items():
            found = sorted(found, reverse=True)[:most]
            ways = [(g, [(p, x)]) for g, p, x in found]
            ways += [(g + h, sorted([(p, x), (q, y)])) for i, (g, p, x) in enumerate(found) for h, q, y in found[:i] if p != q and not x == y == "D" and g + h > -margin]
            best: dict[str, float] = {}
            for g, ops in ways:
                r = applied(words[w], ops)
                if r and r != words[w] and g > best.get(r, -np.inf):
                    best[r] = g
            out[w] = sorted(best.items(), key=lambda x: (-x[1], x[0]))[:most]
        return out

    def line_end(self, left: str, right: str) -> tuple[bool, bool]:
        """Whether a line that ends in `left`, a dividing mark last, is joined to the word `right`; whether the mark stays."""
        if "J" not in self.labels:
            return False, False
        word = f"{left[-4:-1]}-{BREAK}{right[:4]}".lower()
        scores, _, place = self.scores([word])
        spot = len(left[-4:-1])
        end, mark = scores[spot + 1], scores[spot]
        j, n, d = (self.labels.index(x) if x in self.labels else None for x in "JND")
        joined = end[j] > (end[n] if n is not None else end[0])
        return bool(joined), bool(d is None or mark[0] >= mark[d])


def applied(word: str, ops: list[tuple[int, str]]) -> str:
    """`word` with each (place, label) carried out."""
    cs, i, out = dict(ops), 0, []
    while i < len(word):
        x = cs.get(i, "K")
        if x == "S" and i + 1 < len(word):
            out.append(word[i + 1] + word[i])
            i += 2
            continue
        out.append(word[i] if x in "KSJN" else "" if x == "D" else x[1:] if x[0] == "R" else word[i] + x[1:])
        i += 1
    return "".join(out)


def labelled(read: str, right: str, at: int) -> list[str] | None:
    """Labels of `read`, whose piece at `at` should be that of `right`; None if no label says so."""
    tail = 0
    while tail < min(len(read), len(right)) - at and read[-1 - tail] == right[-1 - tail]:
        tail += 1
    a, b = read[at : len(read) - tail], right[at : len(right) - tail]
    labels = ["K"] * len(read)
    if len(a) == 2 and b == a[::-1]:
        labels[at] = "S"
    elif len(a) >= 1 and len(b) == 1:
        labels[at : at + len(a)] = ["R" + b, *["D"] * (len(a) - 1)]
    elif len(a) == 1 and not b:
        labels[at] = "D"
    elif not a and len(b) == 1 and at > 0:
        labels[at - 1] = "I" + b
    else:
        return None
    return labels


def misreadings(frequent: dict[str, int], rare: dict[str, int]) -> list[tuple[str, str]]:
    """(token, word): rare tokens beside the frequent word that they differ from in one place, RARER times as common.

    A place is up to two characters of either. A kind of error counts if it is seen in several different words (in
    one pair of 500, two at least): other endings and compounds differ in one place too, but each in its own way.
    """
    open_at: dict[tuple[str, str], list[str]] = defaultdict(list)
    for w in frequent:
        for i in range(len(w) + 1):
            for n in (0, 1, 2):
                if i + n <= len(w):
                    open_at[w[:i], w[i + n :]].append(w)
    pairs, kinds = [], defaultdict(set)
    for t, n in rare.items():
        best = None
        for i in range(len(t) + 1):
            for k in (1, 2, 0):
                if i + k > len(t):
                    continue
                for w in open_at.get((t[:i], t[i + k :]), ()):
                    # a number is compared with tokens of its length that hold a letter: numbers differ from each other anyway
                    if w != t and frequent[w] >= RARER * n and (not w.isdigit() or len(w) == len(t) and all(c == x or not c.isdigit() for c, x in zip(t, w))) and (best is None or frequent[w] > frequent[best]):
                        best = w
        if best:
            at = next((i for i, (x, y) in enumerate(zip(t, best)) if x != y), min(len(t), len(best)))
            labels = labelled(t, best, at)
            if labels is not None:
                edit = tuple(x for x in labels if x != "K")
                kind = (edit, "" if edit == ("S",) else t[at : at + len(edit)])
                kinds[kind].add(best)
                pairs.append((t, best, kind))
    return [(t, w) for t, w, kind in pairs if len(kinds[kind]) >= max(2, len(pairs) / 500)]


def noised(word: str, errors: dict[str, list[str]], rng: random.Random) -> tuple[str, list[str]]:
    """`word` with one error of a known kind (what a piece is read as, by piece) or two letters exchanged, and the labels that undo it."""
    spots = [(i, len(piece), read) for i in range(len(word)) for piece in (word[i], word[i : i + 2]) for read in errors.get(piece, ()) if len(piece) == 1]
    swaps = "" in errors and len(word) > 3
    if swaps and (not spots or rng.random() < 0.35):
        i = rng.randrange(len(word) - 1)
        if word[i] != word[i + 1] and word[i : i + 2].isalpha():
            labels = ["K"] * len(word)
            labels[i] = "S"
            return word[:i] + word[i + 1] + word[i] + word[i + 2 :], labels
    if not spots:
        return word, ["K"] * len(word)
    i, n, read = rng.choice(spots)
    return word[:i] + read + word[i + n :], ["K"] * i + ["R" + word[i : i + n], *["D"] * (len(read) - 1)] + ["K"] * (len(word) - i - n)


def divided(word: str, rng: random.Random) -> tuple[str, list[str]]:
    """`word` divided at a line end, as the editor is given it, and labels; dashes that divide nothing now and then."""
    hyphens = [i for i in range(1, len(word) - 1) if word[i] == "-"]
    if hyphens:
        i = rng.choice(hyphens)
        left, right, mark = word[:i], word[i + 1 :], "K"
    else:
        i = rng.randrange(2, len(word) - 1)
        left, right, mark = word[:i], word[i:], "D"
    if rng.random() < 0.15:
        left, mark = rng.choice((" ", ".", ",", "")), "K"
        return f"{left}-{BREAK}{right[:4]}", ["K"] * len(left) + [mark, "N"] + ["K"] * len(right[:4])
    left, right = left[-3:], right[:4] if rng.random() < 0.9 else ""
    return f"{left}-{BREAK}{right}", ["K"] * len(left) + [mark, "J"] + ["K"] * len(right)


def trained_editor(frequent: dict[str, int], rare: dict[str, int], least: int = 6, samples: int = 24_000, seed: int = 11) -> CharEditor:
    """An editor trained on frequent words and the rare tokens that are those words misread, both bounded samples.

    Each word is given errors `least` times, and more often if there are few: `samples` in all.
    """
    rng = random.Random(seed)
    found = misreadings(frequent, {**rare, **frequent})  # errors recur: some of the frequent words are misread ones
    pairs, errors = [], defaultdict(list)
    for t, w in found:
        at = next((i for i, (x, y) in enumerate(zip(t, w)) if x != y), min(len(t), len(w)))
        labels = labelled(t, w, at)
        pairs += [(t, labels)] * 4
        edit = [x for x in labels if x != "K"]
        if edit == ["S"]:
            errors[""].append("S")
        elif edit[0][0] == "R":
            errors[edit[0][1:]].append(t[at : at + len(edit)])
    known = {t for t, _ in found}
    words = [w for w in frequent if w not in known]
    # each kind of error in proportion to the square root of its frequency
    errors = {k: [r for r, n in Counter(v).items() for _ in range(max(1, round(n**0.5)))] for k, v in errors.items()}
    variants = max(least, samples // max(400, len(words)))
    for w in words:
        pairs += [noised(w, errors, rng) for _ in range(variants)] + [(w, ["K"] * len(w))] * 2
    for _ in range(max(300, len(words) // 2)) if errors else ():
        number = str(rng.randint(10, 99_999))
        pairs += [noised(number if rng.random() < 0.7 else f"{number}.{rng.randint(0, 9)}", DIGITS_READ, rng), (number, ["K"] * len(number))]
    whole = [w for w in words if len(w) >= 5 and (w.isalpha() or "-" in w[1:-1])]
    pairs += [divided(w, rng) for w in whole for _ in range(variants // 2 if w.isalpha() else 2 * variants)]
    return CharEditor().train(pairs) if pairs else CharEditor()


# ---------------------------------------------------------------- words over all scans


def word_table(scans: DataFrame) -> DataFrame:
    """(low, n, n_small): tokens of all scans in lower case, how often they stand, and how often in small letters."""
    joined = F.regexp_replace("text", rf"(?<=[\p{{L}}])[{DIVIDERS}][ \t\r]*\n\s*(?=\p{{L}})", "")
    raw = scans.select(F.explode(F.split(joined, r"\s+")).alias("raw")).groupBy("raw").agg(F.count(F.lit(1)).alias("n"))
    tokens = raw.select(F.btrim("raw", F.lit(EDGE)).alias("token"), "n").where(F.length("token").between(2, 60))
    small = F.when(F.lower("token") == F.col("token"), F.col("n")).otherwise(0)
    return written(tokens.groupBy(F.lower("token").alias("low")).agg(F.sum("n").alias("n"), F.sum(small).alias("n_small")), "p4-words")


def _code(gram: np.ndarray) -> np.ndarray:
    """Numbers of sequences of four letters, each one of 35 signs, given as (n, 4) letter numbers."""
    return ((gram[:, 0] * 35 + gram[:, 1]) * 35 + gram[:, 2]) * 35 + gram[:, 3]


#: Letter numbers by code point: 0 other, 1 the edge of a word.
_NUMBERS = np.zeros(0x250, dtype=np.int64)
for _i, _c in enumerate(LETTERS):
    _NUMBERS[ord(_c)] = _i + 2


def letter_sequences(words: DataFrame) -> np.ndarray:
    """How often each sequence of four letters (of 35 signs: 35^4 counts at most, whatever the scans) stands in words of letters alone."""
    framed = F.concat(F.lit("^"), "low", F.lit("$"))
    grams = words.where(F.col("low").rlike(r"^\p{L}{2,}$")).select("n", F.explode(F.transform(F.sequence(F.lit(1), F.length("low") - 1), lambda i: F.substring(framed, i, F.lit(4)))).alias("gram"))
    mapped = F.regexp_replace("gram", rf"[^{LETTERS}^$]", "?")
    rows = grams.groupBy(mapped.alias("gram")).agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(35**4, dtype=np.float32)
    if len(rows):
        np.add.at(out, _code(np.array([[_letter(c) for c in g] for g in rows["gram"]], dtype=np.int64)), rows["n"].to_numpy(dtype=np.float32))
    return out


def _letter(c: str) -> int:
    return 1 if c in "^$" else int(_NUMBERS[ord(c)]) if ord(c) < len(_NUMBERS) else 0


def rarest_sequence(words: list[str], counts: np.ndarray) -> np.ndarray:
    """Least count among the letter sequences of each word of two letters or more."""
    lens = np.array([len(w) for w in words], dtype=np.int64)
    flat = np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.uint32)
    nums = np.where(flat < len(_NUMBERS), _NUMBERS[np.minimum(flat, len(_NUMBERS) - 1)], 0)
    framed = np.ones(len(flat) + 2 * len(words), dtype=np.int64)
    begin = np.cumsum(lens + 2) - (lens + 2)
    spots = np.repeat(begin + 1 - (np.cumsum(lens) - lens), lens) + np.arange(len(flat))
    framed[spots] = nums
    each = np.maximum(1, lens - 1)
    at = np.repeat(begin, each) + np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
    grams = np.stack([framed[np.minimum(at + k, len(framed) - 1)] for k in range(4)], axis=1)
    return np.minimum.reduceat(counts[_code(grams)], np.cumsum(each) - each) if len(words) else np.zeros(0, np.float32)


def fitted_editor(words: DataFrame) -> CharEditor:
    """An editor trained on the TRAIN_WORDS most frequent words and on RARE_TOKENS tokens, taken by their hash."""
    often = words.where(F.col("n") >= RARER)
    plain = F.col("low").rlike(r"^\p{L}[\p{L}\-]+\p{L}$")
    top = often.where(plain).orderBy(F.desc("n"), "low").limit(TRAIN_WORDS).toPandas()
    numbers = often.where(F.col("low").rlike(r"^[0-9]{2,}$")).orderBy(F.desc("n"), "low").limit(TRAIN_WORDS // 8).toPandas()
    # names differ from one another in one place: only what stands in small letters, or holds other signs, is paired
    odd = (F.col("n_small") > 0) & ~F.col("low").rlike(r"^[\p{Nd}.,/]+$")
    rare = words.where(odd).orderBy(F.xxhash64("low"), "low").limit(RARE_TOKENS).toPandas()
    frequent = {**dict(zip(top["low"], top["n"].astype(int))), **dict(zip(numbers["low"], numbers["n"].astype(int)))}
    return trained_editor(frequent, dict(zip(rare["low"], rare["n"].astype(int))))


def may_be_misread(low: str, small: bool) -> bool:
    """Whether a token is looked at: no number, unit, address or code; codes are those that never stand in small letters."""
    if not any(c.isalpha() for c in low) or any(c in "/=&_[]" for c in low) and not any(c in "@|!+\\" for c in low):
        return False
    if not any(c.isdigit() for c in low) or re.match(r"^[zsol]\d{2,4}$", low):
        return True
    return not UNIT_RE.match(low) and (small or not CODE_RE.match(low))


def corrections(words: DataFrame, editor: CharEditor) -> DataFrame:
    """(low, fixed, same, tail): the misread tokens with what they should be; they agree in the first `same` and last `tail` characters.

    A token of letters is misread if a reading of the editor's is RARER times as frequent, or if it never stands
    in small letters and the reading's letter sequences are that much more common. With digits or signs among its
    letters it needn't be rarer than the reading; of what may be a number the likeliest reading of digits counts.
    """
    spark = words.sparkSession
    shared = spark.sparkContext.broadcast((editor.plain(), letter_sequences(words)))

    def op(batches):
        plain, seqs = shared.value
        own = CharEditor(*plain)
        for b in batches:
            for at in range(0, b.num_rows, 5_000):
                low, n, small = (b.column(k).slice(at, 5_000).to_pylist() for k in range(3))
                fit = [i for i, w in enumerate(low) if may_be_misread(w, small[i])]
                low, n = [low[i] for i in fit], [n[i] for i in fit]
                rows = [(w, k, r, g) for w, k, rs in zip(low, n, own.edits(low)) for r, g in rs if len(r) > 1]
                if not rows:
                    continue
                w, k, r, g = (list(x) for x in zip(*rows))
                before = np.maximum(0, rarest_sequence(w, seqs) - np.array(k, dtype=np.float32))
                after = rarest_sequence(r, seqs)
                same = [next((i for i, (x, y) in enumerate(zip(a, c)) if x != y), min(len(a), len(c))) for a, c in zip(w, r)]
                tail = [next((i for i, (x, y) in enumerate(zip(reversed(a), reversed(c))) if x != y or i >= min(len(a), len(c)) - s), min(len(a), len(c)) - s) for a, c, s in zip(w, r, same)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(w), pa.array(k, pa.int64()), pa.array(r), pa.array(g, pa.float64()), pa.array(before.astype(float)), pa.array(after.astype(float)), pa.array(same, pa.int32()), pa.array(tail, pa.int32())],
                    ["low", "n", "fixed", "gain", "before", "after", "same", "tail"],
                )

    tasks = max(12, -(-words.count() // 20_000))
    read = words.select("low", "n", F.col("n_small") > 0).repartition(tasks).mapInArrow(op, "low string, n bigint, fixed string, gain double, before double, after double, same int, tail int")
    small = words.select("low", (F.col("n_small") > 0).alias("small"))
    known = words.select(F.col("low").alias("fixed"), F.col("n").alias("n_fixed"))
    read = read.join(known, "fixed", "left").join(small, "low").withColumn("n_fixed", F.coalesce("n_fixed", F.lit(0)))
    letters = F.col("low").rlike(r"^[\p{L}\-]+$")
    word = F.col("fixed").rlike(r"^[\p{L}\-]+$")
    number = F.col("low").rlike(r"\p{Nd}") & F.col("fixed").rlike(r"^[\p{Nd}.,]+$") & (F.length("fixed") == F.length("low"))
    known_word = word & (F.col("n_fixed") >= F.when(letters, RARER).otherwise(1) * F.col("n"))
    likelier = (F.col("after") >= RARER) & (F.col("after") >= RARER * F.greatest(F.lit(1.0), F.col("before")))
    name = word & (F.length("fixed") > 4) & F.when(letters, ~F.col("small") & likelier & (F.col("gain") > 0)).otherwise((F.col("after") >= 1) & (F.col("gain") > 0))
    rank = F.struct(F.when(known_word, 2).when(number | name, 1).otherwise(0).alias("rule"), F.when(known_word, F.col("n_fixed")).otherwise(0).alias("n_fixed"), "gain", "fixed", "same", "tail")
    best = read.groupBy("low").agg(F.max(rank).alias("b")).where("b.rule > 0")
    return best.select("low", "b.fixed", "b.same", "b.tail")


# ---------------------------------------------------------------- scans


def scans_of(df: DataFrame, id_col: str = "image_id", text_col: str = "extracted_text") -> DataFrame:
    return df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).where(F.trim(F.coalesce(text_col, F.lit(""))) != "")


class LineReader:
    """Lines of running text, with words divided at line ends put together as the editor says."""

    def __init__(self, editor: CharEditor):
        self.editor, self.ends = editor, {}

    def end(self, left: str, right: str) -> tuple[bool, bool]:
        key = (left[-4:], right[:4])
        if key not in self.ends:
            if len(self.ends) > 100_000:
                self.ends.clear()
            self.ends[key] = self.editor.line_end(left, right)
        return self.ends[key]

    def words(self, lines: list[str], furniture: set[int]) -> tuple[list[int], list[tuple[str, int, int, int]]]:
        """(lines that end in a divided word, (word in lower case, line, characters on that line or -1, next line))."""
        kept = [(i, ws) for i, s in enumerate(lines) if i not in furniture and (ws := s.split())]
        hyphens, out, first = [], [], 0
        for n, (i, ws) in enumerate(kept):
            last = ws[-1]
            divided = ()
            if last[-1] in DIVIDERS and len(last) > 1:
                j, right = (kept[n + 1][0], bare(kept[n + 1][1][0])) if n + 1 < len(kept) else (-1, "")
                joined, keeps = self.end(last, right)
                if joined:
                    hyphens.append(i)
                    left = last[:-1].lstrip(EDGE)
                    divided = (((left + ("-" if keeps else "") + right).lower(), i, len(left) + keeps, j),) if right[:1].isalpha() and len(ws) > first else ((),)
            out += [(bare(w).lower(), i, -1, -1) for w in (ws[first:-1] if divided else ws[first:])]
            out += [d for d in divided if d]
            first = 1 if divided and divided[0] else 0
        return hyphens, out


class _Fitted:
    """What is learned from all scans: furniture (id, h, line, defect), corrections, the editor and words that need no look."""

    def __init__(self, scans: DataFrame):
        self.scans = scans.withColumn("h", F.xxhash64("text"))
        self.furniture = furniture(line_table(scans))
        words = word_table(scans)
        self.editor = fitted_editor(words)
        self.corrections = small_side(corrections(words, self.editor), "p4-corrections")
        skipped = words.orderBy(F.desc("n"), "low").limit(SKIPPED).join(self.corrections, "low", "left_anti").select("low").toPandas()
        self.shared = scans.sparkSession.sparkContext.broadcast((self.editor.plain(), set(skipped["low"])))
        marked = self.furniture.groupBy("id", "h").agg(F.collect_set("line").alias("furniture"))
        self.pages = self.scans.join(marked, ["id", "h"], "left")

    def places(self) -> DataFrame:
        """(id, h, line, word, cut, next): lines that end in a divided word (word NULL), and the words that may be misread."""
        shared = self.shared

        def op(batches):
            plain, skip = shared.value
            reader = LineReader(CharEditor(*plain))
            for b in batches:
                out = []
                for i, h, text, marked in zip(*(b.column(k).to_pylist() for k in range(4))):
                    hyphens, words = reader.words(text.split("\n"), set(marked or ()))
                    out += [(i, h, n, None, -1, -1) for n in hyphens]
                    out += {(i, h, n, w, cut, m) for w, n, cut, m in words if len(w) > 1 and w not in skip}
                cols = list(zip(*out)) if out else [[]] * 6
                types = [pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.int32(), pa.int32()]
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, types)], ["id", "h", "line", "word", "cut", "next"])

        return self.pages.select("id", "h", "text", "furniture").mapInArrow(op, "id bigint, h bigint, line int, word string, cut int, next int")


def read_defects(df: DataFrame, id_col: str = "image_id", text_col: str = "extracted_text") -> DataFrame:
    """(id, line_no, defect): hyphen, misread, header and page_number lines of each scan, once each.

    NULL and blank texts give no rows; rows that repeat an id and its text read alike; an empty table gives
    an empty result; extra columns are ignored. Collections without frequent words give no misread lines.
    """
    fitted = _Fitted(scans_of(df, id_col, text_col))
    places = written(fitted.places(), "p4-places")
    hits = places.where("word is not null").join(fitted.corrections, F.col("word") == F.col("low"))
    on_first, on_next = (F.col("cut") < 0) | (F.col("same") < F.col("cut")), (F.col("cut") >= 0) & (F.length("word") - F.col("tail") > F.col("cut"))
    at = F.array_compact(F.array(F.when(on_first, F.col("line")), F.when(on_next, F.col("next"))))
    misread = hits.select("id", F.explode(at).alias("line"), F.lit("misread").alias("defect"))
    hyphens = places.where("word is null").select("id", "line", F.lit("hyphen").alias("defect"))
    marked = fitted.furniture.select("id", "line", "defect")
    return marked.unionByName(hyphens).unionByName(misread).select("id", (F.col("line") + 1).cast("int").alias("line_no"), "defect").distinct()


def _cased(token: str, low: str) -> str:
    letters = [c for c in token if c.isalpha()]
    if len(letters) > 1 and all(c.isupper() for c in letters):
        return low.upper()
    return low[:1].upper() + low[1:] if token[:1].isupper() else low


def repaired_text(text: str, marked: set[int], fixes: dict[str, str], reader: LineReader) -> str:
    """The scan as continuous paragraphs, without furniture, with words joined and misread ones corrected."""
    kept = [s.strip() for i, s in enumerate(text.split("\n")) if i not in marked]
    widths = sorted(len(s) for s in kept if s)
    width = widths[int(0.8 * len(widths))] if widths else 0
    paragraphs, current = [], ""
    for s in kept:
        if not s:
            if current and current[-1] not in DIVIDERS and END.search(current):
                paragraphs.append(current)
                current = ""
            continue
        if current and len(current) > 1 and current[-1] in DIVIDERS:
            joined, keeps = reader.end(current.split()[-1], bare(s.split()[0]))
            current = current[:-1] + ("-" if keeps else "") + s if joined else f"{current} {s}"
        else:
            current = f"{current} {s}" if current else s
        if END.search(s) and len(s) < 0.7 * width:
            paragraphs.append(current)
            current = ""
    if current:
        paragraphs.append(current)

    def fix(m: re.Match) -> str:
        word = bare(m.group())
        fixed = fixes.get(word.lower()) if word else None
        return m.group().replace(word, _cased(word, fixed), 1) if fixed is not None else m.group()

    return "\n".join(TOKEN_RE.sub(fix, p) if fixes else p for p in paragraphs)


def read_repaired(df: DataFrame, id_col: str = "image_id", text_col: str = "extracted_text") -> DataFrame:
    """(id, text): each scan that has a text as continuous readable paragraphs, one to a line; repeated rows come out as often as they stand."""
    fitted = _Fitted(scans_of(df, id_col, text_col))
    words = fitted.places().where("word is not null").select("id", "h", "word").distinct().join(fitted.corrections, F.col("word") == F.col("low"))
    fixes = words.groupBy("id", "h").agg(F.map_from_entries(F.collect_set(F.struct("word", "fixed"))).alias("fixes"))
    shared = fitted.shared

    def op(batches):
        reader = LineReader(CharEditor(*shared.value[0]))
        for b in batches:
            ids, texts, marked, fixed = (b.column(k).to_pylist() for k in range(4))
            out = [repaired_text(t, set(m or ()), dict(f or ()), reader) for t, m, f in zip(texts, marked, fixed)]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(out, pa.string())], ["id", "text"])

    return fitted.pages.join(fixes, ["id", "h"], "left").select("id", "text", "furniture", "fixes").mapInArrow(op, "id bigint, text string")
