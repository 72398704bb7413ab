"""Exact top-k by inner product with MaxScore over vector shards.

A vector's dimensions are its terms: a posting of dimension d holds the vectors by their
value there. For one query and one shard each term has a score bound, the product of the
query's value with the shard's largest or smallest value. Terms are taken from the
largest range of scores down. Those whose ranges, summed from the small end, cannot lift
a vector over the k-th best score so far are non-essential: the others are traversed
first, and the non-essential ones are probed only for vectors still competitive, in
order, dropping a vector once its score and what is left of the bounds fall short. The
shards' lists are merged to the overall k best.

Queries meet the shards in blocks: every block of queries is paired with every shard, as
an exact search of a query set against all rows must. No row of single pairs is made but
the k best of a block and shard.

Defined cases: vectors that are null, empty or hold null or non-finite components take no
part; a candidate of another length than the query's shard is in a shard of its own and
meets only queries of its length; ties go to the smaller id; rows that repeat an id are
candidates each, and a query row never meets a row with its own id; a null id takes no
part; an empty table gives an empty one; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from umbra.llm.common import stage

K = 20
SCALE = 64
SHARD_ROWS, BLOCK_ROWS = 8192, 512
#: Query blocks that meet a shard in one task.
BLOCKS_TOGETHER = 8
#: Integers up to this size are exact as doubles.
EXACT = 1 << 53


def quantised(vectors: DataFrame, vector: str = "embedding", key: str = "vec_id", scale: int = SCALE) -> DataFrame:
    """vec_id and q, the components floor(scale * x) of every usable vector."""
    x = F.transform(vector, lambda c: c.cast("double"))
    usable = F.col(key).isNotNull() & (F.size(vector) > 0) & ~F.exists(
        vector, lambda c: c.isNull() | F.isnan(c) | (F.abs(c.cast("double")) == float("inf"))
    )
    return vectors.where(F.coalesce(usable, F.lit(False))).select(
        F.col(key).cast("bigint").alias("vec_id"), F.transform(x, lambda c: F.floor(c * F.lit(float(scale))).cast("bigint")).alias("q")
    )


def max_score(query: np.ndarray, shard: np.ndarray, high: np.ndarray, low: np.ndarray, k: int, floor: float) -> tuple[np.ndarray, np.ndarray]:
    """Rows of `shard` (one column per row) that may be among the k best, and their exact scores.

    `floor` is a score that k vectors are known to reach.
    """
    top = np.maximum(query * high, query * low)
    span = top - np.minimum(query * high, query * low)
    order = np.argsort(-span, kind="stable")
    left = np.append(np.cumsum(span[order][::-1])[::-1], 0)
    # Non-essential: a vector at the low end of every essential term cannot reach the floor by them.
    least = (top - span).sum()
    essential = max(1, min(int(np.searchsorted(-left, least - floor, side="right")), len(order)))
    first = order[:essential]
    score = query[first] @ shard[first]
    rest = np.append(np.cumsum(top[order][::-1])[::-1], 0)  # the most that the terms from here on add
    rows = np.flatnonzero(score + rest[essential] >= floor)
    score = score[rows]
    at = essential
    while at < len(order) and len(rows):
        step = order[at : at + 8]
        score = score + query[step] @ shard[np.ix_(step, rows)]
        at += len(step)
        good = score + rest[at] >= floor
        rows, score = rows[good], score[good]
    return rows, score


def _blocks(rows: DataFrame, size: int) -> DataFrame:
    """Blocks of vectors of one length: part, width, ids and vals (column after column)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        number = TaskContext.get().partitionId() << 32
        held: dict[int, list] = {}

        def block(width: int) -> pd.DataFrame:
            nonlocal number
            got = held.pop(width)
            number += 1
            vals = np.stack([v for _, v in got])
            ids = np.array([i for i, _ in got], np.int64)
            return pd.DataFrame({"block": [number], "width": [width], "ids": [ids.tobytes()], "vals": [np.ascontiguousarray(vals.T).tobytes()]})

        for batch in batches:
            for i, v in zip(batch["vec_id"].tolist(), batch["q"], strict=True):
                held.setdefault(len(v), []).append((i, np.asarray(v, np.int64)))
                if len(held[len(v)]) >= size:
                    yield block(len(v))
        for width in list(held):
            yield block(width)

    return rows.mapInPandas(run, "block bigint, width int, ids binary, vals binary")


def top_k(vectors: DataFrame, is_query: Column, k: int = K, vector: str = "embedding", key: str = "vec_id", scale: int = SCALE, shard_rows: int = SHARD_ROWS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """query_id, rank, vec_id and score. `is_query` is a condition on vec_id."""
    rows = quantised(vectors, vector, key, scale)
    shards = stage(_blocks(rows, shard_rows), "shards")
    queries = stage(_blocks(rows.where(is_query), block_rows), "queries")
    # Each shard meets all query blocks of its width, BLOCKS_TOGETHER of them in a task.
    together = max(1, -(-queries.count() // BLOCKS_TOGETHER))
    group = F.pmod(F.xxhash64("block"), F.lit(together)).cast("int")
    wide = shards.withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(together - 1))))
    asked = queries.select("width", group.alias("group"), F.col("ids").alias("qids"), F.col("vals").alias("qvals"))
    asked = asked.join(wide.select("width", "group", F.col("block").alias("shard")), ["width", "group"])

    def meet(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        found = [_best_of(s.width, q.qids, q.qvals, s.ids, s.vals, k) for s in right.itertuples() for q in left.itertuples()]
        return pd.concat(found) if found else pd.DataFrame({"query_id": [], "vec_id": [], "score": []}, dtype=np.int64)

    sides = asked.groupBy("shard", "group").cogroup(wide.withColumnRenamed("block", "shard").groupBy("shard", "group"))
    best = sides.applyInPandas(meet, "query_id bigint, vec_id bigint, score bigint")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _best_of(width: int, qids: bytes, qvals: bytes, ids: bytes, vals: bytes, k: int) -> pd.DataFrame:
    """The k best rows of one shard for each query of one block."""
    qids, ids = np.frombuffer(qids, np.int64), np.frombuffer(ids, np.int64)
    queries = np.frombuffer(qvals, np.int64).reshape(width, -1).T
    shard = np.frombuffer(vals, np.int64).reshape(width, -1)
    reach = float(np.abs(queries).max(initial=0)) * float(np.abs(shard).max(initial=0)) * width
    if reach < EXACT:
        queries, shard = queries.astype(float), shard.astype(float)
    high, low = shard.max(1), shard.min(1)
    some = shard[:, : 4 * k + 1]
    out = []
    for q, query in zip(qids.tolist(), queries, strict=True):
        seen = (query @ some)[ids[: some.shape[1]] != q]
        floor = float(np.partition(seen, -k)[-k]) if len(seen) >= k else -np.inf
        if reach < EXACT and np.isfinite(floor):
            rows, score = max_score(query, shard, high, low, k, floor)
        else:
            rows, score = np.arange(len(ids)), query @ shard
        own = ids[rows] != q
        rows, score = rows[own], score[own]
        if len(rows) > k:
            worst = np.partition(score, -k)[-k]
            rows, score = rows[score >= worst], score[score >= worst]
        best = np.lexsort((ids[rows], -score))[:k]
        out.append((np.full(len(best), q), ids[rows][best], score[best].astype(np.int64)))
    query_id, vec_id, score = (np.concatenate(c) for c in zip(*out, strict=True))
    return pd.DataFrame({"query_id": query_id, "vec_id": vec_id, "score": score})
