"""Best-fit packing of token sequences, certified by lower bounds.

Items are dealt over partitions of bounded size and packed there by best-fit
decreasing. Dual-feasible functions give a lower bound for each partition's bin count;
a partition that meets its bound is done, but for its emptiest bin. In the others all bins
that are not full give up their items; these are dealt anew over fewer partitions, so that partitions
exchange documents, and packed again, until all bounds are met or nothing is gained
in partitions of the largest size. A packing that gains nothing is not taken.

Defined cases: a null text is an empty one and still has its closing id; a repeated
document is packed each time it occurs; a null doc_id is kept; an empty table gives an
empty table; other columns are ignored. Only a document longer than a sequence is cut;
its first piece is the short one.
"""

from __future__ import annotations

import math
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from umbra.llm.bpe import DEFAULT_VOCABULARY, codec
from umbra.llm.common import in_small_batches, stage, text_rows

CAPACITY = 2048
#: Items that one task packs; the number of partitions follows the input.
ITEMS_PER_PART = 40_000
#: A partition that exchanges grows fourfold a round, up to this many times.
MOST_GROWTH = 16
MAX_ROUNDS = 12
_PIECES = "item bigint, doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


def lower_bound(sizes: np.ndarray, capacity: int) -> int:
    """Bins that any packing needs: the best of two families of dual-feasible functions.

    The first rounds sizes over capacity - t up to a whole bin and drops those under t, for
    every t. The second rounds multiples of 1 / (k + 1) of a bin, for k up to 30.
    """
    count = np.bincount(sizes, minlength=capacity + 1).astype(np.int64)
    total = np.cumsum(count * np.arange(capacity + 1))  # of sizes up to the index
    number = np.cumsum(count)
    t = np.arange(capacity // 2 + 1)
    below = np.where(t > 0, total[np.maximum(t - 1, 0)], 0)
    best = int(np.max(-(-(capacity * (number[-1] - number[capacity - t]) + total[capacity - t] - below) // capacity)))
    x = np.arange(capacity + 1, dtype=np.int64)
    for k in range(1, 31):
        whole = (k + 1) * x % capacity == 0
        value = np.where(whole, k * x, (k + 1) * x // capacity * capacity)  # times k * capacity
        best = max(best, -(-int((count * value).sum()) // (k * capacity)))
    return best


def best_fit_decreasing(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of each item, and how full each bin is; largest first, into the fullest bin that takes it."""
    bins = np.zeros(len(sizes), np.int64)
    offsets = np.zeros(len(sizes), np.int64)
    filled: list[int] = []
    rooms: list[int] = []  # the distinct free spaces, ascending
    at: dict[int, list[int]] = {}  # bins by free space
    for i in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[i])
        k = bisect_left(rooms, size)
        if k < len(rooms):
            room = rooms[k]
            b = at[room].pop()
            if not at[room]:
                del at[room], rooms[k]
        else:
            b, room = len(filled), capacity
            filled.append(0)
        bins[i], offsets[i] = b, filled[b]
        filled[b] += size
        left = room - size
        if left:
            if left not in at:
                at[left] = []
                insort(rooms, left)
            at[left].append(b)
    return bins, offsets, np.array(filled, np.int64)


def token_pieces(docs: DataFrame, vocabulary: str = DEFAULT_VOCABULARY, capacity: int = CAPACITY, closing_id: int = 0) -> DataFrame:
    """One row per piece of each document's ids and the closing id: doc_id, piece, start, length, ids_crc32.

    `item` is a number of its own for each piece.
    """
    source = docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), docs["text"].alias("_text"))
    closing = np.array([closing_id], "<u4").tobytes()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = codec(vocabulary).encode_many
        item = TaskContext.get().partitionId() << 36
        for batch in batches:
            ids_of = batch["doc_id"].astype("Int64").tolist()
            for i, j in text_rows(batch["_text"]):
                rows = []
                for doc, ids in zip(ids_of[i:j], encode(batch["_text"].iloc[i:j].tolist()), strict=True):
                    ids += closing
                    n, view = len(ids) // 4, memoryview(ids)
                    first = n % capacity or capacity
                    for piece, end in enumerate(range(first, n + 1, capacity)):
                        start = end - capacity if piece else 0
                        rows.append((item, doc, piece, start, end - start, zlib.crc32(view[4 * start : 4 * end])))
                        item += 1
                out = pd.DataFrame(rows, columns=["item", "doc_id", "piece", "start", "length", "ids_crc32"])
                yield out.astype({"doc_id": "Int64", "piece": "int32"})

    return in_small_batches(source).mapInPandas(run, _PIECES)


def pack(items: DataFrame, capacity: int = CAPACITY, item: str = "item", length: str = "length", items_per_part: int = ITEMS_PER_PART) -> DataFrame:
    """`items` with sequence_id and offset. `item` is unique; lengths are 0 to `capacity`.

    `items` is read once per round, so it should be a written table.
    """
    size = F.coalesce(F.col(length), F.lit(0))
    full = items.where(size >= capacity)
    done = [full.withColumns({
        "sequence_id": -1 - F.col(item).cast("bigint"),
        "offset": F.when(size == capacity, 0).otherwise(F.raise_error(F.lit("an item is longer than a sequence"))).cast("bigint"),
    })]
    left = items.where(size < capacity)
    n, base, best = left.count(), 0, None
    schema = items.schema.simpleString()[7:-1] + ", _bin bigint, _offset bigint, _open boolean, _first boolean"

    for turn in range(MAX_ROUNDS):
        if not n:
            break
        grown = min(4**turn, MOST_GROWTH)
        deal = max(1, math.ceil(n / (items_per_part * grown)))
        part = F.pmod(F.xxhash64(F.col(item), F.lit(turn)), F.lit(deal))
        rows = left.withColumn("_part", part).groupBy("_part")
        packed = stage(rows.applyInPandas(_packer(capacity, length, deal, base), schema), "packed")
        base += deal
        bins = F.sum(F.col("_first").cast("int"))
        total = packed.agg(bins).first()[0]
        gained = best is None or total < best[0]
        if gained:  # else the packing of an earlier round stays, and its items are dealt again
            done.append(_placed(packed.where("NOT _open"), items))
            open_now = packed.where("_open")
            n, open_bins = open_now.agg(F.count("*"), bins).first()
            left, best = open_now.select(*items.columns), (open_bins, open_now)
        if deal == 1 or (grown == MOST_GROWTH and not gained):
            break
    if n:
        done.append(_placed(best[1], items))
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out


def _placed(packed: DataFrame, items: DataFrame) -> DataFrame:
    return packed.select(*items.columns, F.col("_bin").alias("sequence_id"), F.col("_offset").alias("offset"))


def _packer(capacity: int, length: str, deal: int, base: int):
    """Packs one partition; the items of its bins that are not full are open unless the bound is met."""

    def run(batch: pd.DataFrame) -> pd.DataFrame:
        part = int(batch.pop("_part").iloc[0])
        sizes = batch[length].fillna(0).to_numpy(np.int64)
        bins, offsets, filled = best_fit_decreasing(sizes, capacity)
        met = len(filled) <= lower_bound(sizes, capacity)
        # A partition that meets its bound still has a last bin to share, unless it is the only one.
        loose = deal > 1 and bins == int(filled.argmin())
        first = np.zeros(len(bins), bool)
        first[np.unique(bins, return_index=True)[1]] = True
        return batch.assign(
            _bin=(base + part) * (1 << 24) + bins, _offset=offsets, _open=(filled[bins] < capacity) & (loose | (not met)),
            _first=first,
        )

    return run


def pack_documents(docs: DataFrame, vocabulary: str = DEFAULT_VOCABULARY, capacity: int = CAPACITY, items_per_part: int = ITEMS_PER_PART) -> DataFrame:
    """Pieces of all documents with their sequence and their place in it."""
    pieces = stage(token_pieces(docs, vocabulary, capacity), "pieces")
    packed = pack(pieces, capacity, items_per_part=items_per_part)
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
