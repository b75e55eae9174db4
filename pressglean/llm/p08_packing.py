"""Filling containers of fixed capacity: vector bin packing over shards of equal make.

Items have three sizes: tokens, one segment, and tokens that bear loss. A container is filled greedily: the
largest item left opens it, then the item whose sizes have the greatest dot product with the room left, all
in shares of the limits, is added as long as one fits. Items are dealt to shards by a hash of their id, so
shards are alike whatever the sources; each is packed by itself and leaves one poorly filled container.
Texts are read once, to be counted in tokens; only sizes are shuffled.
"""

from __future__ import annotations

import base64

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressglean.runtime import written

#: Vocabulary file that the tokens are counted with, as ranks.
VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
# Fixed value: the pattern that splits text before the merges of the vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Characters handed to the tokenizer at once: longer texts are cut at white space after a letter or digit,
#: where the pattern starts a new piece anyway, so that counts stay exact.
STRETCH = 200_000
SHARD = 20_000


def token_counter(ranks: bytes):
    """Function text -> number of tokens."""
    import tiktoken

    merges = {base64.b64decode(a): int(b) for a, b in (line.split() for line in ranks.splitlines() if line)}
    encoding = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=merges, special_tokens={})

    def count(text: str | None) -> int:
        if not text:
            return 0
        n = at = 0
        while len(text) - at > STRETCH:
            cut = at + STRETCH
            while cut < len(text) and not (text[cut] == " " and text[cut - 1].isalnum() and text[cut + 1 : cut + 2].isalnum()):
                cut += 1
            n += len(encoding.encode_to_numpy(text[at:cut], disallowed_special=()))
            at = cut
        return n + len(encoding.encode_to_numpy(text[at:], disallowed_special=()))

    return count


def token_sizes(docs: DataFrame, id_col: str, text_col: str, prompt_col: str | None = None, vocabulary: str = VOCABULARY) -> DataFrame:
    """(id, tokens, loss) of each text that holds a token; a prompt counts as tokens that bear no loss."""
    with open(vocabulary, "rb") as f:
        ranks = docs.sparkSession.sparkContext.broadcast(f.read())
    d = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), (F.col(prompt_col) if prompt_col else F.lit(None).cast("string")).alias("prompt"))

    def op(batches):
        count = token_counter(ranks.value)
        for b in batches:
            loss = [count(t) for t in b.column(1).to_pylist()]
            total = [n + count(p) for n, p in zip(loss, b.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(total, pa.int32()), pa.array(loss, pa.int32())], ["id", "tokens", "loss"])

    return d.where(F.coalesce(F.length("text"), F.lit(0)) > 0).mapInArrow(op, "id bigint, tokens int, loss int").where("tokens > 0")


def pack(tokens: np.ndarray, loss: np.ndarray, capacity: int, max_segments: int, max_loss: int) -> np.ndarray:
    """Container number of each item, none larger than the limits; items of equal sizes are interchangeable."""
    kinds, of = np.unique(np.stack([tokens, loss], axis=1), axis=0, return_inverse=True)
    of = of.reshape(-1)
    left = np.bincount(of, minlength=len(kinds))
    order = np.argsort(of, kind="stable")
    at = np.concatenate([[0], np.cumsum(left)[:-1]])
    tok, los = kinds[:, 0].astype(np.float64), kinds[:, 1].astype(np.float64)
    share = np.maximum(tok / capacity, los / max(1, max_loss))
    by_share = list(np.argsort(-share, kind="stable"))
    out = np.full(len(tokens), -1, dtype=np.int64)
    # kinds are in order of their tokens: those that fit by tokens are a prefix
    simple = bool((los * capacity <= tok * max_loss).all())
    present = left > 0
    container, first = -1, 0
    while first < len(by_share):
        k = by_share[first]
        if not left[k]:
            first += 1
            continue
        container += 1
        room_t, room_l, room_s = capacity, max_loss, max_segments
        while True:
            out[order[at[k]]] = container
            at[k] += 1
            left[k] -= 1
            present[k] = left[k] > 0
            room_t, room_l, room_s = room_t - int(tok[k]), room_l - int(los[k]), room_s - 1
            if room_s <= 0 or room_t <= 0:
                break
            end = int(np.searchsorted(tok, room_t, side="right"))
            fits = present[:end] if simple and room_l >= room_t else present[:end] & (los[:end] <= room_l)
            if not fits.any():
                break
            if simple and room_l >= room_t:
                k = end - 1 - int(np.argmax(fits[::-1]))
            else:
                score = np.where(fits, tok[:end] * (room_t / capacity**2) + los[:end] * (room_l / max(1, max_loss) ** 2) + room_s / max_segments**2, -1.0)
                k = int(np.argmax(score))
    return out


def packed(sizes: DataFrame, limits: list[tuple[int, int]], max_segments: int = 1024, loss_share: float = 1.0, shard: int = SHARD) -> DataFrame:
    """(limit_id, container_id, doc_id, piece_no, first_token, tokens, loss) for every item under every limit.

    `limits` are (limit_id, capacity in tokens); a container also holds at most `max_segments` items and
    `loss_share` of its capacity in tokens that bear loss. Only a text longer than the capacity, or with
    more such tokens than allowed, is split: into pieces as large as allowed, each a container of its own,
    and a rest that is packed like any item. Texts without tokens take no place; rows with one id are
    packed one by one; no item is dropped.
    """
    sizes = written(sizes, "p8-sizes")
    shards = max(1, -(-sizes.count() // shard))
    caps = F.array(*(F.struct(F.lit(i).alias("limit_id"), F.lit(c).alias("capacity")) for i, c in limits if c and c > 0))
    items = sizes.select("id", "tokens", "loss", F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int").alias("shard"), F.explode(caps).alias("l")).select("id", "tokens", "loss", "shard", "l.*")

    def op(pdf: pd.DataFrame) -> pd.DataFrame:
        limit, capacity, part = int(pdf["limit_id"].iloc[0]), int(pdf["capacity"].iloc[0]), int(pdf["shard"].iloc[0])
        max_loss = max(1, int(capacity * loss_share))
        pdf = pdf.sort_values(["tokens", "loss", "id"], kind="stable")
        ids, tokens, loss = pdf["id"].to_numpy(dtype=np.int64), pdf["tokens"].to_numpy(dtype=np.int64), pdf["loss"].to_numpy(dtype=np.int64)
        prompt = tokens - loss
        # whole pieces: the prompt's tokens come first, then as many as both limits allow
        pieces = np.maximum(-(-tokens // capacity), -(-loss // max_loss))
        step = np.where(pieces > 1, np.minimum(capacity, max_loss), tokens)
        pieces = np.where(pieces > 1, -(-tokens // np.maximum(1, step)), 1)
        row = np.repeat(np.arange(len(ids)), pieces)
        no = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        start = no * step[row]
        size = np.minimum(step[row], tokens[row] - start)
        bears = np.clip(start + size - np.maximum(start, prompt[row]), 0, None)
        rest = (pieces[row] == 1) | (no == pieces[row] - 1)
        where = np.empty(len(row), dtype=np.int64)
        where[rest] = pack(size[rest], bears[rest], capacity, max_segments, max_loss)
        base = where[rest].max(initial=-1) + 1
        where[~rest] = base + np.arange((~rest).sum())
        return pd.DataFrame({"limit_id": np.full(len(row), limit, dtype=np.int32), "container_id": (np.int64(part) << 32) + where, "doc_id": ids[row], "piece_no": (no + 1).astype(np.int32), "first_token": start.astype(np.int32), "tokens": size.astype(np.int32), "loss": bears.astype(np.int32)})

    return items.groupBy("limit_id", "shard").applyInPandas(op, "limit_id int, container_id bigint, doc_id bigint, piece_no int, first_token int, tokens int, loss int")


def broken_rules(assignment: DataFrame, sizes: DataFrame, limits: list[tuple[int, int]], max_segments: int = 1024, loss_share: float = 1.0) -> DataFrame:
    """(limit_id, over_tokens, over_segments, over_loss, wrong_totals, needless_splits) by limit: 0 everywhere if all rules hold.

    wrong_totals counts texts whose pieces don't add up to their tokens and loss, those left out included.
    """
    caps = F.broadcast(sizes.sparkSession.createDataFrame([(i, c, max(1, int(c * loss_share))) for i, c in limits], "limit_id int, capacity int, max_loss int"))
    held = assignment.groupBy("limit_id", "container_id").agg(F.sum("tokens").alias("t"), F.count(F.lit(1)).alias("s"), F.sum("loss").alias("l")).join(caps, "limit_id")
    over = held.groupBy("limit_id").agg(F.count_if(F.col("t") > F.col("capacity")).alias("over_tokens"), F.count_if(F.col("s") > max_segments).alias("over_segments"), F.count_if(F.col("l") > F.col("max_loss")).alias("over_loss"))
    pieces = assignment.groupBy("limit_id", F.col("doc_id").alias("id")).agg(F.sum("tokens").alias("t"), F.sum("loss").alias("l"), F.count(F.lit(1)).alias("pieces"))
    wanted = sizes.groupBy("id").agg(F.sum("tokens").alias("tokens"), F.sum("loss").alias("loss"), F.count(F.lit(1)).alias("rows"), F.max("tokens").alias("most"), F.max("loss").alias("most_loss"))
    each = F.array(*(F.struct(F.lit(i).alias("limit_id"), F.lit(c).alias("capacity"), F.lit(max(1, int(c * loss_share))).alias("max_loss")) for i, c in limits))
    wanted = wanted.withColumn("limit", F.explode(each)).select("*", "limit.*").drop("limit")
    both = wanted.join(pieces, ["limit_id", "id"], "left")
    wrong = both.groupBy("limit_id").agg(
        F.count_if(~(F.col("t").eqNullSafe(F.col("tokens")) & F.col("l").eqNullSafe(F.col("loss")))).alias("wrong_totals"),
        F.count_if((F.col("pieces") > F.col("rows")) & (F.col("most") <= F.col("capacity")) & (F.col("most_loss") <= F.col("max_loss"))).alias("needless_splits"),
    )
    return over.join(wrong, "limit_id")


def packing_report(assignment: DataFrame, limits: list[tuple[int, int]]) -> DataFrame:
    """(limit_id, capacity, containers, tokens, fill, fullest, most_segments): how well each limit's containers are filled."""
    caps = F.create_map(*(F.lit(x) for pair in limits for x in pair))
    each = assignment.groupBy("limit_id", "container_id").agg(F.sum("tokens").alias("t"), F.count(F.lit(1)).alias("s"))
    out = each.groupBy("limit_id").agg(F.count(F.lit(1)).alias("containers"), F.sum("t").alias("tokens"), F.max("t").alias("fullest"), F.max("s").alias("most_segments"))
    out = out.withColumn("capacity", caps[F.col("limit_id")])
    return out.select("limit_id", "capacity", "containers", "tokens", F.round(F.col("tokens") / (F.col("containers") * F.col("capacity")), 6).alias("fill"), "fullest", "most_segments")


def read_limits(pack_limits: DataFrame) -> list[tuple[int, int]]:
    """(limit_id, capacity) of a table of limits; a bounded set of parameters, read on the driver."""
    return [(int(r[0]), int(r[1])) for r in pack_limits.select("limit_id", "capacity").where("limit_id is not null and capacity > 0").distinct().orderBy("limit_id").toLocalIterator()]
