"""Rendezvous hashing of stable record keys over weighted shards, in DataFrame functions only.

For every shard a record draws a number u of (0, 1) that follows from its key and the shard
alone; it goes to the shard with the smallest -ln(u) / weight. So a shard receives records
in proportion to its weight, and a shard that is added, or gains weight, takes records only
into itself: nothing moves between the others. Placing is a projection, without a shuffle.

`numbered` gives the records of a shard the slots 0, 1, 2, ... in a pseudo-random order that
depends on the records alone. Records that are equal in all columns are first summed to one
row with their number. Buckets of the order's leading bits hold a bounded number of rows;
each is numbered in itself and moved up by what the shard's earlier buckets hold. A large
group of equal records is spread over tasks again in chunks when it is unfolded.

Defined cases: a null key is a key of its own; a null text is empty, of size 1; records that
repeat a key share its shard; equal records get different slots; an empty table gives an
empty one; extra columns pass through `sharded` unless they have the name of a result.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from umbra.llm.common import fresh, parts, stage

SHARDS = 16
#: Rows that are numbered in one window, on average, and equal records unfolded in one task.
BUCKET_ROWS = 100_000
CHUNK = 100_000
#: A draw is a whole number of this many bits, taken from the start of an MD5 digest.
DRAW_BITS = 52


def draw(key: Column, salt: str) -> Column:
    """A whole number below 2**DRAW_BITS that follows from key and salt."""
    digest = F.md5(F.concat(key, F.lit(f":{salt}")).cast("binary"))
    return F.conv(F.substring(digest, 1, DRAW_BITS // 4), 16, 10).cast("bigint")


def distance(key: Column, shard: int, weight: float) -> Column:
    """How far a record is from a shard: exponentially distributed with the shard's weight as its rate."""
    u = (draw(key, str(shard)).cast("double") + 0.5) / float(1 << DRAW_BITS)
    return -F.ln(u) / F.lit(float(weight))


def nearest(key: Column, weights: Sequence[float], first: int = 0) -> Column:
    """(distance, shard) of the nearest shard; a shard of weight 0 takes nothing, ties go to the smaller number."""
    if any(w < 0 or not math.isfinite(w) for w in weights) or not any(weights):
        raise ValueError("weights are finite, not negative, and not all 0")
    near = [F.struct(distance(key, first + i, w).alias("distance"), F.lit(first + i).alias("shard")) for i, w in enumerate(weights) if w]
    return F.array_min(F.array(*near))


def sharded(docs: DataFrame, weights: Sequence[float] = (1.0,) * SHARDS, added: Sequence[float] = (1.0,), key: str = "doc_id", text: str = "text") -> DataFrame:
    """`docs` with size, text_crc32, shard, and grown_shard, where the record goes once shards of the weights `added` exist too."""
    results = ("size", "text_crc32", "shard", "grown_shard")
    old, new, held = fresh(docs, "_old"), fresh(docs, "_new"), [c for c in docs.columns if c not in results]
    k = F.coalesce(docs[key].cast("string"), F.lit(""))
    t = F.coalesce(docs[text], F.lit(""))
    near = docs.select(
        *[docs[c] for c in held], (F.octet_length(t).cast("bigint") + 1).alias("size"), F.crc32(t.cast("binary")).alias("text_crc32"),
        nearest(k, weights).alias(old), (nearest(k, added, len(weights)) if any(added) else F.lit(None)).alias(new),
    )
    grown = F.when(F.col(new)["distance"] < F.col(old)["distance"], F.col(new)["shard"]).otherwise(F.col(old)["shard"]) if any(added) else F.col(old)["shard"]
    return near.select(*held, "size", "text_crc32", F.col(old)["shard"].alias("shard"), grown.alias("grown_shard"))


def numbered(rows: DataFrame, group: str = "shard", slot: str = "slot", bucket_rows: int = BUCKET_ROWS, chunk: int = CHUNK) -> DataFrame:
    """`rows` (narrow, of columns that can be ordered) with a gapless number from 0 within each group."""
    columns = [F.col(f"`{c}`") for c in rows.columns]
    written = F.concat_ws(":", *[F.coalesce(c.cast("string"), F.lit("-")) for c in columns])
    held = rows.groupBy(*columns).agg(F.count("*").alias("_n"))
    held = stage(held.withColumn("_order", draw(written, "slot")), "to_number")
    largest = held.groupBy(F.col(group)).agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
    buckets = max(1, math.ceil(largest / bucket_rows))
    bucketed = held.withColumn("_bucket", F.floor(F.col("_order") / F.lit((1 << DRAW_BITS) / buckets)).cast("bigint"))
    in_order = Window.partitionBy(group, "_bucket").orderBy("_order", *columns)
    inside = bucketed.withColumn("_upto", F.sum("_n").over(in_order))
    sizes = bucketed.groupBy(group, "_bucket").agg(F.sum("_n").alias("_size"))
    earlier = F.sum("_size").over(Window.partitionBy(group).orderBy("_bucket")) - F.col("_size")
    sizes = sizes.select(F.col(group).alias("_g"), F.col("_bucket").alias("_b"), earlier.alias("_before"))
    placed = inside.join(sizes, F.col(group).eqNullSafe(F.col("_g")) & (F.col("_bucket") == F.col("_b")))
    placed = placed.select(*columns, "_n", (F.col("_before") + F.col("_upto") - F.col("_n")).alias("_slot"))
    placed = stage(placed, "numbered")
    unfold = lambda first, last: F.explode(F.sequence(first, last))
    few = placed.where(F.col("_n") <= chunk).select(*columns, unfold(F.col("_slot"), F.col("_slot") + F.col("_n") - 1).alias(slot))
    many = placed.where(F.col("_n") > chunk).withColumn("_chunk", unfold(F.lit(0), F.floor((F.col("_n") - 1) / chunk).cast("int")))
    many = many.repartition(parts(rows), "_slot", "_chunk").withColumn("_from", F.col("_slot") + F.col("_chunk").cast("bigint") * chunk)
    end = F.least(F.col("_from") + chunk, F.col("_slot") + F.col("_n")) - 1
    return few.unionByName(many.select(*columns, unfold(F.col("_from"), end).alias(slot)))


def shard_documents(docs: DataFrame, weights: Sequence[float] = (1.0,) * SHARDS, added: Sequence[float] = (1.0,), key: str = "doc_id", text: str = "text", bucket_rows: int = BUCKET_ROWS, chunk: int = CHUNK) -> DataFrame:
    """The plan of all records, without their texts: key, size, text_crc32, law, shard, slot, grown_shard."""
    plan = sharded(docs.select(docs[key].alias(key), docs[text].alias(text)), weights, added, key, text)
    plan = numbered(plan.select(key, "size", "text_crc32", "shard", "grown_shard"), bucket_rows=bucket_rows, chunk=chunk)
    return plan.select(key, "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def write_shards(docs: DataFrame, path: str, weights: Sequence[float] = (1.0,) * SHARDS, key: str = "doc_id", text: str = "text") -> None:
    """The documents as Parquet, one folder for each shard; a folder is written by as many tasks as its bytes need."""
    placed = sharded(docs, weights, (), key, text).drop("grown_shard")
    placed.hint("rebalance", "shard").write.partitionBy("shard").parquet(path)
