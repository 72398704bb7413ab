"""Near-duplicate groups by a signature-coordinate inverted join.

Every document gets K minimum hashes. It is posted under each (coordinate, value) pair,
and two documents are candidates when they meet under at least T of the K pairs. For a
similarity of 0.75 the matches are binomial(64, 0.75): fewer than 30 have a chance under
1e-6. Pairs are ordered by how many documents they hold; by the prefix principle two
documents with T matches meet under one of their K - T + 1 rarest pairs, so the common
ones, such as those of a passage that many documents share, are skipped. Links are
confirmed on whole shingle sets.

A group of copies is never expanded. Equal sets are one node. Under each pair the nodes
are first compared with its leader alone, the node whose pairs hold most documents, and
what that links is contracted. Only where different components are left around a leader
are its nodes compared with each other, in blocks of bounded size, and from a block come
no pairs but the links that join components. The nodes of the commonest component round a
leader meet only those of other components. Many texts that are like their leader and
yet unlinked cost the square of their number in comparisons, though not in rows.

Defined cases: words are split at ASCII white space and lower-cased in A-Z only; a null
or empty text has no shingle, is linked with nothing and stays; a text of under five
words is one shingle; a null doc_id takes part in links, is no component's id, and stays
only where no id in its component is known; rows that repeat a doc_id are nodes of their
own; an empty table gives an empty one; columns other than doc_id and text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from umbra.llm.common import BYTE_VALUES, in_small_batches, joined_bytes, mix64, powers, prefix_sums, split_by, stage, text_batches

SHINGLE = 5
COORDINATES = 64
MATCHES = 30
#: Similarity as a whole percentage: 100 * intersection >= PERCENT * union.
PERCENT = 75
#: Nodes around one leader that are compared in one block.
BLOCK_NODES = 256

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_CHAIN = np.array([pow(0xD1342543DE82EF95, k, 1 << 64) for k in range(256)], np.uint64)
_XOR = mix64(np.arange(1000, 1256, dtype=np.uint64))
_MULTIPLY = mix64(np.arange(2000, 2256, dtype=np.uint64)) | np.uint64(1)


def shingle_sets(texts: list[bytes], width: int = SHINGLE) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    data, starts, sizes = joined_bytes(texts, gap=1, fill=32)
    data = _LOWER[data]
    word = ~_SPACE[data]
    edge = np.flatnonzero(np.diff(word.astype(np.int8), prepend=0))  # the last byte is a space
    begins, ends = edge[0::2], edge[1::2]
    sums = prefix_sums(BYTE_VALUES[data])
    words = mix64((sums[ends] - sums[begins]) * powers(len(data) + 1)[1][begins])
    first = np.searchsorted(begins, starts)
    last = np.append(first[1:], len(begins))
    windows = np.zeros(max(0, len(words) - width + 1), np.uint64)
    for k in range(width):
        windows += words[k : k + len(windows)] * _CHAIN[k]
    windows = mix64(windows + np.uint64(width))
    out = []
    for i, j in zip(first.tolist(), last.tolist(), strict=True):
        if j - i >= width:
            out.append(np.unique(windows[i : j - width + 1]))
        elif j > i:
            out.append(mix64((words[i:j] * _CHAIN[: j - i]).sum(dtype=np.uint64, keepdims=True) + np.uint64(j - i)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def signatures(sets: list[np.ndarray], coordinates: int = COORDINATES) -> np.ndarray:
    """The minimum of each coordinate over each set, one row per set; none may be empty."""
    out = np.zeros((len(sets), coordinates), np.uint32)
    if sets:
        values = np.concatenate(sets)
        starts = np.cumsum([0, *map(len, sets)])[:-1]
        for k in range(coordinates):
            hashed = ((values ^ _XOR[k]) * _MULTIPLY[k]) >> np.uint64(32)
            out[:, k] = np.minimum.reduceat(hashed, starts)
    return out


def set_id(s: np.ndarray) -> bytes:
    """128 bits that stand for a set."""
    a = mix64(s * np.uint64(0x9E3779B97F4A7C15)).sum(dtype=np.uint64)
    b = mix64(s ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)
    return a.tobytes() + b.tobytes()


def _text_id(text: Column) -> Column:
    return F.unhex(F.md5(F.encode(F.coalesce(text, F.lit("")), "UTF-8")))


def signed(docs: DataFrame, width: int = SHINGLE, coordinates: int = COORDINATES, key: str | None = None) -> DataFrame:
    """doc_id, n_shingles, set (its id, null without shingles), sig, the keys of the signature, tid (md5 of the text), and key if one is named."""
    keyed = docs[key] if key else F.lit(None)
    source = docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), docs["text"].alias("_text"), _text_id(docs["text"]).alias("tid"), keyed.cast("string").alias("key"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            ids = batch["doc_id"].astype("Int64")
            for at, texts in text_batches(batch["_text"].tolist()):
                sets = shingle_sets(texts, width)
                keys = iter(signatures([s for s in sets if len(s)], coordinates).astype(np.int64) + (np.arange(coordinates) << 32))
                yield pd.DataFrame({
                    "doc_id": ids.iloc[at : at + len(texts)].reset_index(drop=True),
                    "n_shingles": np.fromiter(map(len, sets), np.int64, len(sets)),
                    "set": [set_id(s) if len(s) else None for s in sets],
                    "sig": [next(keys) if len(s) else None for s in sets],
                    "tid": batch["tid"].iloc[at : at + len(texts)].reset_index(drop=True),
                    "key": batch["key"].iloc[at : at + len(texts)].reset_index(drop=True),
                })

    return in_small_batches(source).mapInPandas(run, "doc_id bigint, n_shingles bigint, set binary, sig array<bigint>, tid binary, key string")


def prefix_keys(nodes: DataFrame, coordinates: int = COORDINATES, matches: int = MATCHES) -> DataFrame:
    """node, popularity and keys, those of its rarest that other nodes hold too."""
    posted = nodes.select("node", F.explode("sig").alias("key"))
    shared = posted.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    found = posted.join(shared, "key").groupBy("node").agg(
        F.sum("n").alias("popularity"), F.sort_array(F.collect_list(F.struct("n", "key"))).alias("keys")
    )
    # Keys that only this node has are the rarest of all, so they fill the prefix first.
    left = F.lit(coordinates - matches + 1) - (F.lit(coordinates) - F.size("keys"))
    return found.where((F.size("keys") >= matches) & (left > 0)).select("node", "popularity", F.slice("keys", F.lit(1), left)["key"].alias("keys"))


def matched(a: str, b: str) -> str:
    """SQL for the number of equal coordinates of two signatures."""
    return f"size(filter(zip_with({a}, {b}, (x, y) -> x = y), x -> x))"


def components(edges: DataFrame) -> DataFrame:
    """node and the smallest node reachable from it, for the nodes of `edges` (a, b).

    Each round takes the smallest label next to a node, then that label's own label, so
    chains shorten by half or better.
    """
    both = stage(edges.select("a", "b").union(edges.select("b", "a")).where("a != b").distinct(), "edges")
    labels = stage(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low")).select("node", F.least("node", "low").alias("label")), "labels")
    while True:
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("low"))
        moved = labels.join(near, "node").select("node", "label", F.least("label", "low").alias("low"))
        up = labels.select(F.col("node").alias("low"), F.col("label").alias("up"))
        new = stage(moved.join(up, "low").select("node", "label", F.least("low", "up").alias("new")), "labels")
        changed = new.where("label != new").limit(1).count()
        labels = new.select("node", F.col("new").alias("label"))
        if not changed:
            return labels


def confirmed(pairs: DataFrame, texts: DataFrame, width: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """The pairs (a, b) whose whole sets are similar. `texts`: node, text."""
    left = texts.select(F.col("node").alias("a"), F.col("text").alias("ta"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("tb"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for i in range(0, len(batch), 512):
                part = batch.iloc[i : i + 512]
                sets: list[np.ndarray] = []
                for _, texts_of in text_batches([*part["ta"], *part["tb"]]):
                    sets += shingle_sets(texts_of, width)
                n = len(part)
                same = [len(np.intersect1d(x, y, assume_unique=True)) for x, y in zip(sets[:n], sets[n:], strict=True)]
                total = [len(x) + len(y) for x, y in zip(sets[:n], sets[n:], strict=True)]
                ok = [100 * s >= percent * (t - s) for s, t in zip(same, total, strict=True)]
                yield part.loc[ok, ["a", "b"]]

    return pairs.join(left, "a").join(right, "b").select("a", "b", "ta", "tb").mapInPandas(run, "a bigint, b bigint")


def _texts_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """node and the text of its `tid`, for the nodes of `wanted`; copies of a text, and texts under one id, meet nothing but their own node."""
    texts = docs.select(_text_id(docs["text"]).alias("tid"), docs["text"].alias("text"))
    few, _ = split_by(texts, wanted, "tid")
    return few.dropDuplicates(["tid"]).join(wanted, "tid").select("node", "text")


def links_between(rows: pd.DataFrame, width: int, percent: int, matches: int) -> list[tuple[int, int]]:
    """Links that join different labels among the nodes of a block; `half` 0 and 1 meet, -1 meets all."""
    node, half = rows["node"].to_numpy(), rows["half"].to_numpy()
    sig = np.stack([np.asarray(s, np.int64) for s in rows["sig"]])
    label = np.unique(rows["label"].to_numpy(), return_inverse=True)[1]
    same = np.zeros((len(node), len(node)), np.uint8)
    for k in range(sig.shape[1]):
        same += sig[:, k, None] == sig[None, :, k]
    near = np.triu((same >= matches) & (label[:, None] != label[None]) & ((half[:, None] != half[None]) | (half[:, None] < 0)), 1)
    used = np.flatnonzero(near.any(0) | near.any(1))
    texts, sets = rows["text"].tolist(), {}
    for at, part in text_batches([texts[i] for i in used]):
        sets |= {int(used[at + k]): s for k, s in enumerate(shingle_sets(part, width))}
    root = list(range(int(label.max(initial=0)) + 1))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    out = []
    for i in np.flatnonzero(near.any(1)).tolist():
        own = sets[i]
        others = [j for j in np.flatnonzero(near[i]).tolist() if find(label[j]) != find(label[i])]
        others = [j for j in others if 100 * min(len(own), len(sets[j])) >= percent * max(len(own), len(sets[j]))]
        if not others:
            continue
        flat, size = np.concatenate([sets[j] for j in others]), np.array([len(sets[j]) for j in others])
        hit = own[np.minimum(np.searchsorted(own, flat), len(own) - 1)] == flat
        common = np.add.reduceat(hit, np.cumsum(size) - size, dtype=np.int64)
        for j in np.array(others)[100 * common >= percent * (len(own) + size - common)].tolist():
            x, y = find(label[i]), find(label[j])
            if x != y:
                root[x] = y
                out.append((int(node[i]), int(node[j])))
    return out


def in_blocks(around: DataFrame, block_nodes: int) -> DataFrame:
    """The nodes around each leader dealt to pairs of blocks: leader, node, label, low, high, half.

    The nodes of the leader's most common label meet those of other labels, never each
    other, so one stray among N nodes makes N rows and one for each of their blocks. The
    others also meet among themselves.
    """
    sizes = around.groupBy("leader", "label").agg(F.count("*").alias("n"))
    mixed = sizes.groupBy("leader").agg(F.max(F.struct("n", "label")).alias("most"), F.sum("n").alias("n")).where("most.n < n")
    blocks = lambda n: F.ceil(n / block_nodes).cast("int")
    mixed = mixed.select("leader", F.col("most.label").alias("main"), blocks(F.col("most.n")).alias("mains"), blocks(F.col("n") - F.col("most.n")).alias("others"))
    rows = around.join(mixed, "leader").withColumn("is_main", F.col("label") == F.col("main"))
    rows = rows.withColumn("own", F.pmod(F.xxhash64("node"), F.when(F.col("is_main"), F.col("mains")).otherwise(F.col("others"))).cast("int"))
    own = F.col("own")
    place = lambda low, high, half: F.struct(low.alias("low"), high.alias("high"), half.cast("int").alias("half"))
    upto = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    with_others = F.transform(upto("others"), lambda o: place(own, o, F.lit(0)))
    with_mains = F.transform(upto("mains"), lambda m: place(m, own, F.lit(1)))
    # Blocks of others among themselves have numbers below zero.
    among = F.transform(upto("others"), lambda o: place(-1 - F.least(own, o), -1 - F.greatest(own, o), F.when(own == o, -1).otherwise((own > o).cast("int"))))
    met = F.when(F.col("is_main"), with_others).otherwise(F.concat(with_mains, among))
    return rows.select("leader", "node", "label", F.explode(met).alias("x")).select("leader", "node", "label", "x.*")


def cross_links(around: DataFrame, sig: DataFrame, texts: DataFrame, width: int, percent: int, matches: int, block_nodes: int) -> DataFrame:
    """Links (a, b) between different labels around one leader. `around`: leader, node, label."""
    rows = in_blocks(around, block_nodes)
    rows = rows.join(sig, "node").join(texts, "node")

    def run(group: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(links_between(group.sort_values("node", kind="stable"), width, percent, matches), columns=["a", "b"], dtype=np.int64)

    return rows.groupBy("leader", "low", "high").applyInPandas(run, "a bigint, b bigint")


def near_duplicates(
    docs: DataFrame, width: int = SHINGLE, coordinates: int = COORDINATES, matches: int = MATCHES,
    percent: int = PERCENT, block_nodes: int = BLOCK_NODES, key: str | None = None,
) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row.

    With a column `key`, that is returned too, and `chosen`: true for the rows of one key
    of each component, that of the smallest known doc_id, and for rows without a shingle.
    """
    rows = stage(signed(docs, width, coordinates, key), "signed")
    first = F.struct(F.col("doc_id").isNull().alias("unknown"), F.col("doc_id"), F.col("key"))
    nodes = rows.where("set IS NOT NULL").groupBy("set").agg(F.min("doc_id").alias("doc_id"), F.first("sig").alias("sig"), F.min(first).alias("first"), F.min("tid").alias("tid"))
    nodes = stage(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")
    sig = nodes.select("node", "sig")

    # Every node against the leader of each of its rare keys.
    posted = stage(prefix_keys(nodes, coordinates, matches), "keyed").select("node", "popularity", F.explode("keys").alias("key"))
    lead = posted.groupBy("key").agg(F.count("*").alias("n"), F.max(F.struct("popularity", "node"))["node"].alias("leader")).where("n > 1")
    around = stage(posted.join(lead, "key").where("node != leader").select("leader", "node").distinct(), "around")
    stars = around.select(F.col("node").alias("a"), F.col("leader").alias("b"))
    stars = stars.join(sig.select(F.col("node").alias("a"), F.col("sig").alias("sa")), "a").join(sig.select(F.col("node").alias("b"), F.col("sig").alias("sb")), "b")
    stars = stage(stars.where(F.expr(matched("sa", "sb")) >= matches).select("a", "b"), "stars")
    asked = around.select("node").union(around.select(F.col("leader").alias("node"))).distinct()
    texts = stage(_texts_of(docs, nodes.select("node", "tid").join(asked, "node")), "texts")
    edges = stage(confirmed(stars, texts, width, percent), "links")
    labels = components(edges)

    # The nodes around one leader that are still of different components.
    labelled = around.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    more = stage(cross_links(labelled, sig, texts, width, percent, matches, block_nodes), "links")
    if more.limit(1).count():
        labels = components(edges.union(more))

    grouped = nodes.select("set", "doc_id", "node", "first").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    ids = grouped.groupBy("label").agg(F.min("doc_id").alias("component_id"), F.min("first")["key"].alias("first_key"))
    named = grouped.select("set", "label").join(ids, "label").select("set", "component_id", "first_key")
    out = rows.select("doc_id", "n_shingles", "set", "key").join(named, "set", "left")
    component = F.when(F.col("set").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    chosen = [F.col("key"), (F.col("set").isNull() | F.col("key").eqNullSafe(F.col("first_key"))).alias("chosen")] if key else []
    return out.select("doc_id", "n_shingles", component.alias("component_id"), *chosen).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull())
    )
