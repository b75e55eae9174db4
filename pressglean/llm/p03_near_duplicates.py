"""Near-duplicate records by an exact similarity join on word shingles.

Rare-first prefix filtering: the shingles of a record are ordered by how often they occur (the most frequent
ones are counted over all records; the order of the rest is by hash, which any global order allows). Two
records can only be similar if they share a shingle within their prefixes; such shingles are brought together
by hash, and a pair passes the length filter, the positional filter and a suffix filter on bitmaps (a shingle
that falls on a bit which the other record lacks can't be shared) before it is a candidate. Each candidate
pair is verified once, by the exact overlap.

Records with the same words are one class throughout: pairs are sought between classes, never within one.
Shingles travel as packed arrays, one row per batch and bucket, each with its position and 32 bits of the class.
What is wanted of a class in many buckets (its size and bitmap) doesn't travel: it is written once, and each bucket
reads it for the classes that share a shingle there. The sets of candidates are written once too, in parts; pairs
are verified by pairs of parts. A shingle that very many records hold in their prefixes is spread over a grid of
cells in which any two of its records meet exactly once.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressglean.runtime import forgotten, small_side, stored, written

#: So many of the most frequent shingles are put in order by frequency: the bound of what is broadcast (12 bytes each).
HEAVY = 1 << 18
#: Texts that are split into words at a time.
CHUNK = 500
#: Bits of the suffix filter's bitmap.
BITS = 1024
#: A shingle in more prefixes than this is spread over a grid of cells.
HOT = 20_000
#: Prefix shingles that one bucket holds on average.
BUCKET = 2_500_000
#: Classes whose sets are read at a time in verification, of each side of a pair.
PART = 20_000
MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9))


def _mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def shingles(texts: list[str], seeds: list[int], width: int, min_words: int) -> list[np.ndarray | None]:
    """Sorted distinct 64-bit shingles of each text of space-separated words; None below `min_words` words.

    A text of fewer words than a shingle is one shingle. Records of different seeds share no shingle.
    """
    # words are many small objects: few texts are split at a time
    if len(texts) > CHUNK:
        return [g for at in range(0, len(texts), CHUNK) for g in shingles(texts[at : at + CHUNK], seeds[at : at + CHUNK], width, min_words)]
    split = [t.split(" ") if t else [] for t in texts]
    flat = [w for ws in split for w in ws]
    if not flat:
        return [None] * len(texts)
    codes, vocab = pd.factorize(np.array(flat, dtype=object))
    words = pd.util.hash_array(np.asarray(vocab, dtype=object), categorize=False)[codes]
    gram = words * MIX[0]
    for k in range(1, width):
        shifted = np.concatenate([words[k:], np.zeros(min(k, len(words)), dtype=np.uint64)])
        gram = (gram ^ (gram >> np.uint64(29))) * MIX[k % 3] + shifted * MIX[(k + 1) % 3]
    gram = _mixed(gram)
    out, at = [], 0
    for ws, seed in zip(split, seeds):
        n = len(ws)
        if n < max(1, min_words):
            out.append(None)
        else:
            g = gram[at : at + max(1, n - width + 1)] if n >= width else words[at : at + n].sum(keepdims=True)
            out.append(np.unique(g ^ np.uint64(seed * 0x2545F4914F6CDD1D & 0xFFFFFFFFFFFFFFFF)))
        at += n
    return out


def sliced(batches, rows: int = 3_000):
    """The batches in slices, so that a task holds the shingles of few records at a time."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


def prepared(df: DataFrame, id_col: str, text_col: str, tag: int) -> DataFrame:
    """(tag, id, norm, class): words in lower case parted by spaces, and a hash that copies have in common."""
    norm = F.trim(F.lower(F.regexp_replace(F.col(text_col), r"[^\p{L}\p{N}]+", " ")))
    d = df.where(F.col(text_col).isNotNull()).select(F.lit(tag).alias("tag"), F.col(id_col).cast("long").alias("id"), norm.alias("norm"))
    return d.withColumn("class", F.xxhash64("tag", "norm"))


def _surveyed(docs: DataFrame, width: int, min_words: int) -> DataFrame:
    """(kind, tag, key, n, payload): kind 0 frequent shingles of a batch, 1 the number of shingles, 2 the class n of record key, 3 the classes of a batch."""

    def op(batches):
        for b in sliced(batches):
            tags, ids, norms, classes = b.column(0).to_pylist(), b.column(1).to_numpy(), b.column(2).to_pylist(), b.column(3).to_numpy()
            sets = shingles(norms, tags, width, min_words)
            keep = np.array([s is not None for s in sets], dtype=bool)
            if not keep.any():
                continue
            values, counts = np.unique(np.concatenate([s for s in sets if s is not None]), return_counts=True)
            often = counts > 1
            _, first = np.unique(classes, return_index=True)
            once = [i for i in first if keep[i]]
            packed = _packed_classes(classes[once], [sets[i] for i in once])
            parts = [(0, np.zeros(often.sum()), values[often].view(np.int64), counts[often]), (1, [0], [0], [counts.sum()]), (2, np.array(tags)[keep], ids[keep], classes[keep]), (3, [0], [0], [len(once)])]
            for kind, t, key, n in parts:
                payload = pa.array([packed] if kind == 3 else [None] * len(key), pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(key), kind, dtype=np.int8)), pa.array(np.asarray(t, dtype=np.int8)), pa.array(np.asarray(key, dtype=np.int64)), pa.array(np.asarray(n, dtype=np.int64)), payload], ["kind", "tag", "key", "n", "payload"]
                )

    return docs.mapInArrow(op, "kind tinyint, tag tinyint, key bigint, n bigint, payload binary")


def _packed_classes(classes: np.ndarray, sets: list[np.ndarray]) -> bytes:
    """Classes with the size and the bitmap of each."""
    bits = np.zeros((len(sets), BITS // 8), dtype=np.uint8)
    for i, g in enumerate(sets):
        held = np.zeros(BITS, dtype=bool)
        held[(_mixed(g) >> np.uint64(40)) % np.uint64(BITS)] = True
        bits[i] = np.packbits(held)
    return b"".join(x.tobytes() for x in (classes.astype(np.int64), np.array([len(g) for g in sets], dtype=np.uint32), bits))


def _unpacked_classes(payload: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n = len(payload) // (12 + BITS // 8)
    bits = np.frombuffer(payload, dtype=np.uint8, offset=12 * n).reshape(n, -1).view(np.uint64)
    return np.frombuffer(payload, dtype=np.int64, count=n), np.frombuffer(payload, dtype=np.uint32, count=n, offset=8 * n), bits


def _short(classes: np.ndarray) -> np.ndarray:
    """The 32 bits that stand for a class beside a shingle; classes that have them in common all count."""
    return (classes & 0xFFFFFFFF).astype(np.uint32)


def _among(x: np.ndarray, names: np.ndarray) -> np.ndarray:
    """Whether each of `x` is one of the sorted `names`."""
    return names[np.minimum(np.searchsorted(names, x), len(names) - 1)] == x if len(names) else np.zeros(len(x), dtype=bool)


def classes_of(shorts: np.ndarray, packed: Callable[[], Iterable[bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(class, size, bitmap) of every class that one of the sorted `shorts` stands for, sorted; `packed` reads all, twice."""
    own = []
    for payload in packed():
        classes, sizes, _ = _unpacked_classes(payload)
        k = _among(_short(classes), shorts)
        own.append((classes[k], sizes[k]))
    cl, first = np.unique(np.concatenate([c for c, _ in own] or [np.zeros(0, np.int64)]), return_index=True)
    size = np.concatenate([z for _, z in own] or [np.zeros(0, np.uint32)])[first].astype(np.int64)
    # filled in place: the bitmaps are most of what a bucket holds
    maps = np.empty((len(cl), BITS // 64), dtype=np.uint64)
    for payload in packed():
        classes, _, bits = _unpacked_classes(payload)
        k = _among(_short(classes), shorts)
        maps[np.searchsorted(cl, classes[k])] = bits[k]
    return cl, size, maps


def _packed(docs: DataFrame, heavy: tuple[np.ndarray, np.ndarray], width: int, min_words: int, threshold: float, buckets: int) -> DataFrame:
    """(bucket, payload): the prefixes of all records, as packed arrays by bucket."""
    shared = docs.sparkSession.sparkContext.broadcast(heavy)

    def op(batches):
        names, totals = shared.value
        for b in sliced(batches):
            tags, norms, classes = b.column(0).to_pylist(), b.column(2).to_pylist(), b.column(3).to_numpy()
            _, first = np.unique(classes, return_index=True)
            tags, norms, classes = [tags[i] for i in first], [norms[i] for i in first], classes[first]
            hashes, owner, pos, count = [], [], [], []
            for i, g in enumerate(shingles(norms, tags, width, min_words)):
                if g is None:
                    continue
                n = len(g)
                at = np.minimum(np.searchsorted(names, g), len(names) - 1) if len(names) else np.zeros(n, dtype=np.int64)
                c = np.where(names[at] == g, totals[at], 0) if len(names) else np.zeros(n, dtype=np.int64)
                take = np.argsort(c, kind="stable")[: n - math.ceil(threshold * n - 1e-9) + 1]
                hashes.append(g[take])
                count.append(c[take])
                owner.append(np.full(len(take), i, dtype=np.uint32))
                pos.append(np.arange(len(take), dtype=np.uint32))
            if not hashes:
                continue
            h, o, p, c = map(np.concatenate, (hashes, owner, pos, count))
            hot = np.flatnonzero(c > HOT)
            if len(hot):
                h, o, p = _in_cells(h, o, p, c, hot, classes)
            to = ((_mixed(h) >> np.uint64(33)) % np.uint64(buckets)).astype(np.int64)
            order = np.lexsort((o, to))
            h, o, p, to = h[order], o[order], p[order], to[order]
            cuts = np.flatnonzero(np.diff(to)) + 1
            starts, ends = np.concatenate([[0], cuts]), np.concatenate([cuts, [len(to)]])
            rows = [_packed_prefixes(_short(classes), h[s:e], o[s:e], p[s:e]) for s, e in zip(starts, ends)]
            yield pa.RecordBatch.from_arrays([pa.array(to[starts].astype(np.int32)), pa.array(rows, pa.binary())], ["bucket", "payload"])

    return docs.mapInArrow(op, "bucket int, payload binary")


def _packed_prefixes(shorts: np.ndarray, h: np.ndarray, o: np.ndarray, p: np.ndarray) -> bytes:
    """Shingles with their positions, and how many in a row belong to each record; `o` must be sorted."""
    used, times = np.unique(o, return_counts=True)
    few, small = np.uint8 if times.max() < 256 else np.uint32, np.uint16 if p.max() < 65536 else np.uint32
    head = np.array([len(used), len(h), np.dtype(few).itemsize, np.dtype(small).itemsize], dtype=np.uint32)
    return b"".join(x.tobytes() for x in (head, shorts[used], h.astype(np.uint32), p.astype(small), times.astype(few)))


def _unpacked_prefixes(payload: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    used, n, few, small = np.frombuffer(payload, dtype=np.uint32, count=4).tolist()
    at, out = 16, []
    for dtype, count in ((np.uint32, used), (np.uint32, n), (np.uint16 if small == 2 else np.uint32, n), (np.uint8 if few == 1 else np.uint32, used)):
        out.append(np.frombuffer(payload, dtype=dtype, count=count, offset=at))
        at += np.dtype(dtype).itemsize * count
    return out[1], np.repeat(out[0], out[3]), out[2].astype(np.uint32)


def _in_cells(h, o, p, c, hot, classes):
    """Entries with those of hot shingles spread over a triangle of cells; any two records share one cell."""
    rest = np.ones(len(h), dtype=bool)
    rest[hot] = False
    side = np.ceil(c[hot] / HOT).astype(np.int64)
    again = np.repeat(np.arange(len(hot)), side)
    other = np.arange(len(again)) - np.repeat(np.cumsum(side) - side, side)
    row = (classes[o[hot]].astype(np.int64) % side)[again]
    cell = np.minimum(row, other) * side[again] + np.maximum(row, other)
    spread = _mixed(h[hot][again] + (cell.astype(np.uint64) + np.uint64(1)) * MIX[1])
    return np.concatenate([h[rest], spread]), np.concatenate([o[rest], o[hot][again]]), np.concatenate([p[rest], p[hot][again]])


def bucket_pairs(payloads: list[bytes], packed: Callable[[], Iterable[bytes]], threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Distinct candidate pairs (class, class) among the prefixes of one bucket: length, positional and suffix filters."""
    h, short, p = map(np.concatenate, zip(*map(_unpacked_prefixes, payloads)))
    # shingles that stand once bring nothing together
    order = np.argsort(h, kind="stable")
    h, short, p = h[order], short[order], p[order]
    same = h[1:] == h[:-1]
    twice = np.concatenate([same, [False]]) | np.concatenate([[False], same])
    h, short, p = h[twice], short[twice], p[twice]
    cl, size, maps = classes_of(np.unique(short), packed)
    by_short = np.argsort(_short(cl), kind="stable")
    names = _short(cl)[by_short]
    low = np.searchsorted(names, short)
    several = np.searchsorted(names, short, "right") - low
    again = np.repeat(np.arange(len(h)), several)
    o = by_short[low[again] + np.arange(len(again)) - np.repeat(np.cumsum(several) - several, several)]
    h, p = h[again], p[again].astype(np.int64)
    order = np.lexsort((o, size[o], h))
    h, o, p = h[order], o[order], p[order]
    new = np.ones(len(h), dtype=bool)
    new[1:] = (h[1:] != h[:-1]) | (o[1:] != o[:-1])
    h, o, p = h[new], o[new], p[new]
    s = size[o]
    # the smaller of two records shares a shingle within its index prefix, shorter than the prefix that is probed
    index = p < s - np.ceil(2 * threshold / (1 + threshold) * s - 1e-9) + 1
    # sizes beyond which a partner of each entry can't reach the overlap any more: length and position
    most = np.minimum(s / threshold, (s - p) * (1 + threshold) / threshold - s) + 1e-9
    i, k, a, b = np.flatnonzero(index), 1, [], []
    while len(i):
        i = i[i + k < len(h)]
        j = i + k
        ok = (h[i] == h[j]) & (s[j] <= most[i])
        i, j = i[ok], j[ok]
        need = np.ceil(threshold / (1 + threshold) * (s[i] + s[j]) - 1e-9)
        hit = np.minimum(s[i] - p[i], s[j] - p[j]) >= need
        x, y, least = o[i[hit]], o[j[hit]], need[hit]
        # shingles on bits that the other record lacks aren't shared
        only_x, only_y = np.bitwise_count(maps[x] & ~maps[y]).sum(axis=1), np.bitwise_count(maps[y] & ~maps[x]).sum(axis=1)
        fit = (size[x] - only_x >= least) & (size[y] - only_y >= least)
        x, y = x[fit], y[fit]
        a.append(x), b.append(y)
        if sum(map(len, a)) > 4_000_000:
            pair = np.unique(np.concatenate(a) * len(cl) + np.concatenate(b))
            a, b = [pair // len(cl)], [pair % len(cl)]
        k += 1
    if not a:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    pair = np.unique(np.concatenate(a) * len(cl) + np.concatenate(b))
    return cl[pair // len(cl)], cl[pair % len(cl)]


def overlap_reaches(x: np.ndarray, y: np.ndarray, need: int) -> int:
    """Size of the overlap of two sorted arrays if it reaches `need`, else -1; halves are bounded first."""
    mid = y[len(y) // 2]
    left = np.searchsorted(x, mid)
    if min(left, len(y) // 2) + min(len(x) - left, len(y) - len(y) // 2) < need:
        return -1
    at = np.searchsorted(x, y)
    n = int((x[np.minimum(at, len(x) - 1)] == y).sum())
    return n if n >= need else -1


def similar_classes(docs: DataFrame, width: int, min_words: int, threshold: float) -> tuple[DataFrame, DataFrame]:
    """(members(tag, id, class), links(class_a, class_b, similarity)) of records from `prepared`, both written."""
    survey = written(_surveyed(docs, width, min_words), "p3-survey")
    members = survey.where("kind = 2").select("tag", F.col("key").alias("id"), F.col("n").alias("class"))
    top = survey.where("kind = 0").groupBy("key").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "key").limit(HEAVY).toPandas()
    names = top["key"].to_numpy(dtype=np.int64).view(np.uint64)
    order = np.argsort(names)
    total = survey.where("kind = 1").agg(F.sum("n")).first()[0] or 0
    buckets = max(12, math.ceil(total * (1 - threshold) / BUCKET))
    packed = _packed(docs, (names[order], top["n"].to_numpy(dtype=np.int64)[order]), width, min_words, threshold, buckets)
    classes = written(survey.where("kind = 3").select("payload"), "p3-classes")
    classes_at = classes._written_to

    def join(batches):
        held: dict[int, list[bytes]] = {}
        for b in batches:
            for bucket, payload in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                held.setdefault(bucket, []).append(payload)
        for bucket in list(held):
            a, c = bucket_pairs(held.pop(bucket), lambda: (p for b in stored(classes_at) for p in b.column(0).to_pylist()), threshold)
            for at in range(0, len(a), 500_000):
                yield pa.RecordBatch.from_arrays([pa.array(a[at : at + 500_000]), pa.array(c[at : at + 500_000])], ["class_a", "class_b"])

    candidates = packed.repartitionById(buckets, F.col("bucket")).mapInArrow(join, "class_a bigint, class_b bigint")
    candidates = written(candidates.distinct(), "p3-candidates")
    return members, written(_verified(docs, candidates, width, min_words, threshold), "p3-links")


def _verified(docs: DataFrame, candidates: DataFrame, width: int, min_words: int, threshold: float) -> DataFrame:
    """(class_a, class_b, similarity) of the candidates that are similar by their whole sets."""
    wanted = small_side(candidates.select(F.col("class_a").alias("class")).union(candidates.select("class_b")).distinct(), "p3-wanted")
    parts = max(4, math.ceil(wanted.count() / PART))
    part_of = lambda c: F.pmod(F.xxhash64(c), F.lit(parts)).cast("int")

    def once(batches):
        seen: set[int] = set()
        for b in batches:
            classes = b.column(2).to_pylist()
            new = []
            for c in classes:
                new.append(c not in seen)
                seen.add(c)
            yield b.filter(pa.array(new, pa.bool_()))

    def sets(batches):
        for b in sliced(once(batches)):
            grams = [g.tobytes() for g in shingles(b.column(3).to_pylist(), b.column(1).to_pylist(), width, min_words)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(grams, pa.binary())], ["part", "class", "grams"])

    own = docs.join(wanted, "class", "left_semi").select(part_of("class").alias("part"), "tag", "class", "norm")
    own = own.mapInArrow(once, "part int, tag int, class bigint, norm string").repartitionById(parts, F.col("part"))
    grams_at = written(own.mapInArrow(sets, "part int, class bigint, grams binary"), "p3-grams", "part")._written_to

    def verify(batches):
        held: dict[int, dict[int, np.ndarray]] = {}
        for b in sliced(batches):
            out: tuple[list, list, list] = ([], [], [])
            for at, to, ca, cb in zip(*(b.column(i).to_pylist() for i in range(4))):
                for k in held.keys() - {at, to}:
                    del held[k]
                for k in {at, to} - held.keys():
                    held[k] = {c: np.frombuffer(g, dtype=np.uint64) for r in stored(f"{grams_at}/part={k}", ["class", "grams"]) for c, g in zip(*(r.column(i).to_pylist() for i in (0, 1)))}
                x, y = held[at][ca], held[to][cb]
                n = overlap_reaches(x, y, math.ceil(threshold / (1 + threshold) * (len(x) + len(y)) - 1e-9))
                if n >= 0 and n >= threshold * (len(x) + len(y) - n) - 1e-9:
                    for o, v in zip(out, (ca, cb, n / (len(x) + len(y) - n))):
                        o.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.float64())], ["class_a", "class_b", "similarity"])

    pairs = candidates.select(part_of("class_a").alias("part_a"), part_of("class_b").alias("part_b"), "class_a", "class_b")
    # the order of the two classes of a pair is open: turned, half as many pairs of parts have to be read
    turned = F.col("part_a") > F.col("part_b")
    pairs = pairs.select(*(F.when(turned, F.col(y)).otherwise(F.col(x)).alias(x) for x, y in (("part_a", "part_b"), ("part_b", "part_a"), ("class_a", "class_b"), ("class_b", "class_a"))))
    pairs = pairs.repartition("part_a", "part_b").sortWithinPartitions("part_a", "part_b")
    return pairs.mapInArrow(verify, "class_a bigint, class_b bigint, similarity double")


def expanded_pairs(members: DataFrame, links: DataFrame) -> DataFrame:
    """(tag, id_a, id_b), smaller id first: every pair of similar records, copies included."""
    a = members.select("tag", F.col("class").alias("class_a"), F.col("id").alias("x"))
    b = members.select(F.col("class").alias("class_b"), F.col("id").alias("y"))
    near = links.join(a, "class_a").join(b, "class_b").select("tag", F.least("x", "y").alias("id_a"), F.greatest("x", "y").alias("id_b"))
    many = members.groupBy("class").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col("class").alias("class_a"))
    same = a.join(many, "class_a", "left_semi").join(b, F.col("class_a") == F.col("class_b")).where("x < y").select("tag", F.col("x").alias("id_a"), F.col("y").alias("id_b"))
    return near.unionByName(same)


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of `edges`(a, b): the least node of its component, by large and small stars.

    Rounds go on until nothing changes; their number grows with the logarithm of the longest chain.
    """
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    before = None
    while True:
        turned = both.union(both.select(F.col("v").alias("u"), F.col("u").alias("v"))).where("u <> v").distinct()
        least = turned.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = turned.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.where("v < u").groupBy("u").agg(F.min("v").alias("m"))
        small = large.where("v < u").join(least, "u")
        earlier, both = both, written(small.select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct(), "p3-stars")
        forgotten(edges.sparkSession, earlier)
        state = both.agg(F.count(F.lit(1)), F.sum(F.hash("u", "v").cast("long"))).first()
        if state == before:
            break
        before = state
    roots = both.select("v").distinct()
    return both.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots.select(F.col("v").alias("node"), F.col("v").alias("root")))


def near_duplicate_classes(members: DataFrame, links: DataFrame) -> DataFrame:
    """(tag, id, group_id, links): one row per record that has words enough.

    group_id is the least class of the record's connected group, links the number of other records it is
    similar to, copies included; both come from class sizes, without expanding copies into pairs.
    """
    size = members.groupBy("class").agg(F.count(F.lit(1)).alias("n"))
    both = links.select(F.col("class_a").alias("class"), F.col("class_b").alias("other")).union(links.select(F.col("class_b"), F.col("class_a")))
    near = both.join(size.select(F.col("class").alias("other"), "n"), "other").groupBy("class").agg(F.sum("n").alias("near"))
    groups = components(links.select(F.col("class_a").alias("a"), F.col("class_b").alias("b"))).select(F.col("node").alias("class"), "root")
    slim = size.join(near, "class", "left").join(groups, "class", "left").select("class", (F.col("n") - 1 + F.coalesce("near", F.lit(0))).alias("links"), F.coalesce("root", "class").alias("group_id"))
    return members.join(slim, "class").select("tag", "id", "group_id", "links")


def near_duplicates(tables: list[tuple[DataFrame, str, str]], width: int = 5, threshold: float = 0.8, min_words: int = 1) -> tuple[DataFrame, DataFrame]:
    """Members and links of the records of several tables (df, id column, text column); pairs stay within a table.

    A record is similar to another if the distinct shingles of `width` words in both are at least `threshold`
    of those in either. NULL texts and texts of fewer than `min_words` words take no part; repeated rows
    with one id are repeated members; extra columns are ignored; empty tables give empty results.
    """
    docs = None
    for tag, (df, id_col, text_col) in enumerate(tables):
        own = prepared(df, id_col, text_col, tag)
        docs = own if docs is None else docs.unionByName(own)
    return similar_classes(docs, width, min_words, threshold)
