"""What the operators share: settings, stages on shared storage, and Arrow helpers."""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from umbra.plans.lineage import cut_lineage

#: Folder of the public tokenizer files, unless the caller passes a path.
TOKENIZERS = os.environ.get("TOKENIZER_DIR", "/opt/tokenizers")


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write `df` to the shared folder and go on from the written table."""
    return cut_lineage(df, name)


def parts(df: DataFrame) -> int:
    """Shuffle partitions of the session."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


#: Rows that are sent to Python at once. Texts are wide, and several batches are held at a time.
BATCH_ROWS = 1000


def in_small_batches(df: DataFrame) -> DataFrame:
    """`df`, after the session's Arrow batches were set to BATCH_ROWS where they were larger."""
    conf, name = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(conf.get(name)) <= BATCH_ROWS:
        conf.set(name, str(BATCH_ROWS))
    return df


def fresh(df: DataFrame, name: str) -> str:
    """`name`, made longer until no column of `df` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


#: Values of the filter that keeps rows without a partner out of shuffles.
FILTER_VALUES = 1 << 20


def split_by(rows: DataFrame, keys: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """`rows` that may have a `key` of `keys`, and those that cannot.

    Keys are hashed to FILTER_VALUES values, which bounds what is broadcast whatever their
    number. A join of the first part on the key itself has to follow.
    """
    name = fresh(rows, "_v")
    value = F.pmod(F.xxhash64(F.col(key)), F.lit(FILTER_VALUES)).alias(name)
    seen = F.broadcast(keys.select(value).distinct())
    valued = rows.select("*", value)
    return valued.join(seen, name, "left_semi").drop(name), valued.join(seen, name, "left_anti").drop(name)


def held_out():
    """True for the quarter of documents that no model may learn from."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2


def text_batches(values, limit: int = 1_000_000) -> Iterator[tuple[int, list[bytes]]]:
    """(first row, texts as UTF-8) in runs of at most `limit` bytes, or of one longer text."""
    start, held, size = 0, [], 0
    for i, v in enumerate(values):
        b = v.encode("utf-8", "surrogatepass") if isinstance(v, str) else b""
        if held and size + len(b) > limit:
            yield start, held
            start, held, size = i, [], 0
        held.append(b)
        size += len(b)
    if held:
        yield start, held


def text_rows(values, limit: int = 1_000_000) -> Iterator[tuple[int, int]]:
    """Row ranges of at most `limit` characters, or of one longer text."""
    start, size = 0, 0
    for i, v in enumerate(values):
        n = len(v) if isinstance(v, str) else 0
        if i > start and size + n > limit:
            yield start, i
            start, size = i, 0
        size += n
    if len(values) > start:
        yield start, len(values)


def joined_bytes(texts: list[bytes], gap: int = 1, fill: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All texts in one array with `gap` bytes of `fill` after each; starts and lengths."""
    pad = bytes([fill]) * gap
    data = np.frombuffer(pad.join(texts) + pad, np.uint8)
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    return data, np.cumsum(size + gap) - size - gap, size


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every input bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse, modulo 2**64."""
    base = 0x9E3779B97F4A7C15
    up, down = np.full(n, base, np.uint64), np.full(n, pow(base, -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


#: A random-looking 64-bit value for each byte.
BYTE_VALUES = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """At least `n` powers; the sizes are rounded up, so that one table serves many batches."""
    return _powers(1 << max(16, (n - 1).bit_length()))


def prefix_sums(values: np.ndarray) -> np.ndarray:
    """Sums of values[i] * base**i, with a zero in front: the hash of any span is one difference."""
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(len(values) + 1)[0][: len(values)], out=out[1:])
    return out


def span_hashes(data: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each data[begin:end]."""
    sums = prefix_sums(BYTE_VALUES[data])
    return mix64((sums[ends] - sums[begins]) * powers(len(data) + 1)[1][begins])
