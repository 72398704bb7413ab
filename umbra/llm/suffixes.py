"""Repeated passages, by difference-cover blockwise suffix sorting.

Two equal passages of `width` bytes at any two places share an offset below the period
of a difference cover at which both are cover positions. So the suffixes at cover
positions (a twelfth of all) are ranked first, to the depth that is sure to lie inside
the passage: one bucket of suffixes at a time is sorted, and equal ones get equal ranks.
A suffix none of whose next cover positions has a tied rank is resolved by that: it
starts no repeated passage. Only the others, whose ties are long, are sorted to the full
width, again one bucket at a time. Memory is bounded by a bucket and by a block of texts.

A suffix is placed in the order of a hash of the bytes that count, not of the bytes: which
of two suffixes comes first does not matter here, only which ones are tied, and a bucket
need not hold the suffixes' bytes. The ranks, which only select, have 40 bits within a
bucket. Ties that remove bytes are of 128 bits, two hashes of independent tables, so that
at 10**13 suffixes a wrong tie has a chance under 1e-12.

Two widths are found in one pass: what is tied to the longer one is tied to the shorter
one at every place inside. So the suffixes are those of the shorter width; a tie of it is
of 96 bits, and a tie of the longer one of those and of 95 bits of the bytes that follow.
Equal texts are sorted once. Within a block each distinct suffix is sent once, so that
a passage in very many documents reaches its bucket once per block.

Defined cases: a null text is an empty one; a passage never crosses texts; overlapping
repeats count, inside one text too; rows with equal texts get equal results, so repeated
rows and ids need no care; an empty table gives an empty one; other columns pass through
unless they have the name of a result.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from umbra.llm.common import BYTE_VALUES, in_small_batches, joined_bytes, mix64, parts, powers, prefix_sums, split_by, stage, text_batches

WIDTH = 400
#: About 50 words: the shortest passage that counts as repeated where no contract fixes a width.
PASSAGE_BYTES = 250
#: Bytes of text in a block, and suffixes in a bucket.
BLOCK_BYTES = 1_000_000
BUCKET_SUFFIXES = 1_000_000

#: Values of the bytes for the second hash.
SECOND_VALUES = mix64(np.arange(5001, 5257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))

_SPANS = "array<struct<start:bigint,end:bigint>>"
_SENT = "bucket int, block bigint, kind int, a binary, b binary, c binary"
_NOWHERE = 0xFFFFFFFF

#: Perfect difference sets by period: they cover it with the fewest positions there can be.
PERFECT = {
    183: (0, 1, 3, 16, 23, 28, 42, 76, 82, 86, 119, 137, 154, 175),
    91: (0, 1, 3, 9, 27, 49, 56, 61, 77, 81),
}


def difference_cover(width: int = WIDTH) -> tuple[int, np.ndarray]:
    """Period and positions of a cover that leaves half of `width` or more as depth.

    A perfect difference set where one fits, or else the Colbourn-Ling construction: the gaps
    are 1 (r times), r + 1, 2r + 1 (r times), 4r + 3 (2r + 1 times), 2r + 2 (r + 1 times) and
    1 (r times); the period is 24 r^2 + 36 r + 13. Short widths take the whole line as cover.
    """
    for r in range(4, -1, -1):
        period = 24 * r * r + 36 * r + 13
        for perfect in PERFECT:
            if period < perfect <= width // 2:
                return perfect, np.array(PERFECT[perfect])
        if 2 * period <= width:
            gaps = [1] * r + [r + 1] + [2 * r + 1] * r + [4 * r + 3] * (2 * r + 1) + [2 * r + 2] * (r + 1) + [1] * r
            return period, np.cumsum([0, *gaps])
    return 1, np.zeros(1, np.int64)


def runs_of(positions: np.ndarray) -> np.ndarray:
    """Sorted distinct positions as pairs of first and number."""
    if not len(positions):
        return np.zeros((0, 2), np.int64)
    first = np.flatnonzero(np.diff(positions, prepend=positions[0] - 2) != 1)
    return np.stack([positions[first], np.diff(np.append(first, len(positions)))], 1)


def positions_of(runs: np.ndarray) -> np.ndarray:
    """The opposite of runs_of."""
    if not len(runs):
        return np.zeros(0, np.int64)
    number = runs[:, 1]
    return np.repeat(runs[:, 0] - np.cumsum(number) + number, number) + np.arange(number.sum())


def _pack(a: np.ndarray) -> bytes:
    return a.astype("<u4").tobytes()


def _unpack(b: bytes) -> np.ndarray:
    return np.frombuffer(b, "<u4").astype(np.int64)


def _starts(keys: list[np.ndarray]) -> np.ndarray:
    """True where a row of sorted keys differs from the one before."""
    new = np.ones(len(keys[0]), bool)
    new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    return new


def _order(keys: list[np.ndarray]) -> np.ndarray:
    """An order by the first key, then by the others; these are looked at only where the first ones are equal."""
    order = np.argsort(keys[0])
    if len(keys) > 1:
        new = _starts([keys[0][order]])
        alone = new & np.append(new[1:], True)
        at = np.flatnonzero(~alone)
        some = order[at]
        order[at] = some[np.lexsort([k[some] for k in keys[::-1]])]
    return order


def _short(keys: list[np.ndarray]) -> list[np.ndarray]:
    """What of three keys is of the shorter width."""
    return [keys[0], keys[1] >> np.uint64(32)] if len(keys) == 3 else keys


def tied(
    texts: DataFrame, choose: Callable[[int, bytes], np.ndarray], depth: int, buckets: int, hash_bytes: int, deeper: int = 0
) -> DataFrame:
    """tid and the places of each text (runs) whose next `depth` bytes also stand elsewhere.

    `texts` has tid, text and note; choose(length of a text, its note) gives the places that
    take part, ascending. With `deeper`, `deep` are those whose next `deeper` bytes also stand
    elsewhere; the hashes then are 12 bytes of the first `depth` and 12 of the others.
    """
    rest = deeper - depth
    columns = 3 if deeper else -(-hash_bytes // 8)

    def hashed(part: list[bytes], notes: list[bytes]) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
        """Hashes of the places that take part in some texts, the places, and where texts start."""
        data, starts, sizes = joined_bytes(part, 1)
        chosen = [s + choose(n, note) for s, n, note in zip(starts.tolist(), sizes.tolist(), notes, strict=True)]
        where = np.concatenate(chosen).astype(np.int64)
        down = powers(len(data) + 1)[1]
        sums = prefix_sums(BYTE_VALUES[data])
        keys = [mix64((sums[where + depth] - sums[where]) * down[where])]
        if deeper:
            # A longer tie has ties at every place of its first `rest` bytes, and texts lie apart.
            long = np.flatnonzero(where[rest:] == where[:-rest] + rest)
            then = where[long] + depth
            keys += [np.zeros(len(where), np.uint64), np.zeros(len(where), np.uint64)]
            keys[2][long] = mix64((sums[then + rest] - sums[then]) * down[then]) | np.uint64(1)
        if columns > 1:
            sums = prefix_sums(SECOND_VALUES[data])
            more = mix64((sums[where + depth] - sums[where]) * down[where])
            if deeper:
                keys[1] |= more & np.uint64(0xFFFFFFFF00000000)
                keys[1][long] |= mix64((sums[then + rest] - sums[then]) * down[then]) >> np.uint64(32)
            else:
                keys.append(more)
        return keys, where, starts

    def of_block(block: int, part: list[bytes], tids: list[bytes], notes: list[bytes]) -> list[tuple]:
        """What a block sends; nothing else of it is held on."""
        keys, where, starts = hashed(part, notes)
        order = _order(keys)
        keys, where = [k[order] for k in keys], where[order]
        first = np.flatnonzero(_starts(keys))
        number = np.diff(np.append(first, len(where)))
        group = np.cumsum(_starts(_short(keys))) - 1
        again = (np.bincount(group) > 1)[group]  # tied to the shorter width
        here, deep = np.sort(where[again]), np.zeros(0, np.int64)
        known = again[first]
        if deeper:
            deep = np.sort(where[np.repeat(number > 1, number) & (keys[2] > 0)])
            known &= (number > 1) | (keys[2][first] == 0)
        place = np.where(known, _NOWHERE, where[first])
        keys = [k[first] for k in keys]
        bucket = ((keys[0] >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
        further = np.zeros(len(first) + 1, np.int64)
        if deeper:  # in a bucket, those with a hash of the further bytes lead
            order = np.lexsort((keys[2] == 0, bucket))
            keys, place = [k[order] for k in keys], place[order]
            further[1:] = np.cumsum(keys[2] > 0)
        edge = np.searchsorted(bucket, np.arange(buckets + 1, dtype=np.uint64))
        octets = [k.astype("<u8", copy=False).view(np.uint8).reshape(-1, 8) for k in keys]
        if deeper:
            low, high = np.concatenate([octets[0], octets[1][:, 4:]], 1), np.concatenate([octets[1][:, :4], octets[2]], 1)
        else:
            low = np.concatenate(octets, 1)[:, :hash_bytes]
            high = low[:, :0]
        rows = [
            (b, block, 0, low[i:j].tobytes(), _pack(place[i:j]), high[i : i + further[j] - further[i]].tobytes())
            for b, (i, j) in enumerate(zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True)) if i < j
        ]
        own = block % buckets  # what the block itself knows goes along
        rows.append((own, block, 1, _pack(runs_of(here)), _pack(runs_of(deep)), b""))
        rows.append((own, block, 2, b"".join(map(bytes, tids)), _pack(starts), b""))
        return rows

    def send(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            tids, notes = batch["tid"].tolist(), batch["note"].tolist()
            for at, part in text_batches(batch["text"].tolist(), BLOCK_BYTES):
                rows = of_block(block, part, tids[at : at + len(part)], notes[at : at + len(part)])
                block += 1
                yield pd.DataFrame(rows, columns=["bucket", "block", "kind", "a", "b", "c"])

    def sort_bucket(group: pd.DataFrame) -> pd.DataFrame:
        sent = group["kind"].to_numpy() == 0
        rows = group[sent]
        number = np.fromiter((len(b) // 4 for b in rows["b"]), np.int64, len(rows))
        ends = np.cumsum(number)
        wide = np.zeros((int(number.sum()), 8 * columns), np.uint8)
        low = np.frombuffer(b"".join(rows["a"]), np.uint8).reshape(-1, 12 if deeper else hash_bytes)
        if deeper:
            wide[:, :8], wide[:, 12:16] = low[:, :8], low[:, 8:]
            high = np.frombuffer(b"".join(rows["c"]), np.uint8).reshape(-1, 12)
            at = positions_of(np.stack([ends - number, np.fromiter((len(c) // 12 for c in rows["c"]), np.int64, len(rows))], 1))
            wide[at, 8:12], wide[at, 16:] = high[:, :4], high[:, 4:]
        else:
            wide[:, :hash_bytes] = low
        keys = list(wide.view("<u8").T)
        order = _order(keys)
        keys = [k[order] for k in keys]

        def with_like(new: np.ndarray) -> np.ndarray:
            """True for the rows that are not alone between two starts."""
            hit = np.zeros(len(new), bool)
            hit[order[1:]] = ~new[1:]
            hit[order[:-1]] |= ~new[1:]
            return hit

        places = np.frombuffer(b"".join(rows["b"]), "<u4")
        hit = with_like(_starts(_short(keys))) & (places != _NOWHERE)
        deep = np.zeros(len(hit), bool)
        if deeper:
            deep = with_like(_starts(keys)) & (wide[:, 16:].any(1)) & hit
        found = []
        for block, n, j in zip(rows["block"].tolist(), number.tolist(), ends.tolist(), strict=True):
            p, h, d = places[j - n : j], hit[j - n : j], deep[j - n : j]
            found.append((block, 0, p[h & ~d].tobytes(), p[d].tobytes()))
        out = pd.DataFrame([f for f in found if f[2] or f[3]], columns=["block", "kind", "a", "b"])
        return pd.concat([out, group.loc[~sent, ["block", "kind", "a", "b"]]])

    def gather(group: pd.DataFrame) -> pd.DataFrame:
        kinds = group["kind"].to_numpy()
        own, others, meta = group[kinds == 1], group[kinds == 0], group[kinds == 2].iloc[0]
        starts = _unpack(meta["b"])

        def by_text(known: str, names: list[str]) -> list[bytes]:
            places = [positions_of(_unpack(b"".join(own[known])).reshape(-1, 2)), *(_unpack(b"".join(others[c])) for c in names)]
            at = np.unique(np.concatenate(places))
            edge = np.searchsorted(at, np.append(starts, np.iinfo(np.int64).max))
            return [_pack(runs_of(at[i:j] - starts[k])) for k, (i, j) in enumerate(zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True))]

        rows = [
            (meta["a"][16 * k : 16 * k + 16], runs, deep)
            for k, (runs, deep) in enumerate(zip(by_text("a", ["a", "b"]), by_text("b", ["b"]), strict=True)) if runs
        ]
        return pd.DataFrame(rows, columns=["tid", "runs", "deep"])

    sent = in_small_batches(texts).select("tid", "text", "note").mapInPandas(send, _SENT)
    ranked = sent.groupBy("bucket").applyInPandas(sort_bucket, "block bigint, kind int, a binary, b binary")
    return ranked.groupBy("block").applyInPandas(gather, "tid binary, runs binary, deep binary")


def _keyed(docs: DataFrame, text: str = "text") -> DataFrame:
    t = F.coalesce(docs[text], F.lit(""))
    return docs.select(F.unhex(F.md5(F.encode(t, "UTF-8"))).alias("tid"), t.alias("text"))


def repeated_spans(
    docs: DataFrame, width: int = WIDTH, text: str = "text", bucket_suffixes: int = BUCKET_SUFFIXES, passage: int | None = None
) -> DataFrame:
    """tid (md5 of the text) and spans (array of start, end in bytes, end exclusive) of texts with repeats.

    With a shorter width `passage`, also passages, the like spans of that width, from the same pass.
    """
    longer = 0
    if passage is not None:
        if not 0 < passage < width:
            raise ValueError(f"passage must be shorter than width, {width}, and not {passage}")
        width, longer = passage, width
    period, cover = difference_cover(width)
    depth = width - period + 1
    rows = _keyed(docs, text)
    long_enough = rows.where(F.octet_length("text") >= width)
    classes = long_enough.select("tid", F.octet_length("text").alias("n")).groupBy("tid").agg(F.count("*").alias("copies"), F.first("n").alias("n"))
    classes = stage(classes, "classes")
    total = classes.agg(F.sum("n")).first()[0] or 0
    copied = classes.where("copies > 1")
    often, once = split_by(long_enough, copied, "tid")
    once = once.withColumn("note", F.lit(b""))
    often = often.dropDuplicates(["tid"]).sortWithinPartitions("tid").withColumn("note", F.lit(b""))
    distinct = once.unionByName(often)

    def at_cover(n: int, note: bytes) -> np.ndarray:
        last = n - depth
        if last < 0:
            return np.zeros(0, np.int64)
        at = (np.arange(0, last + 1, period)[:, None] + cover).ravel()
        return at[at <= last]

    least = parts(docs)
    buckets = lambda n: max(least, math.ceil(n / bucket_suffixes))
    ranks = tied(distinct, at_cover, depth, buckets(total * len(cover) / period), 5)
    ranks = stage(ranks.select("tid", F.col("runs").alias("note")), "ranks")

    # The texts with tied ranks, near ones side by side, so that a block knows most of their ties.
    few, _ = split_by(long_enough, ranks, "tid")
    # Copies are dropped before the join, so that they meet already reduced on the map side.
    few = few.dropDuplicates(["tid"]).join(ranks, "tid").select("tid", "text", "note")

    def anchored(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            anchors = []
            for t, note in zip(batch["text"], batch["note"], strict=True):
                data = np.frombuffer(t.encode(), np.uint8)
                sums = prefix_sums(BYTE_VALUES[data])
                at = positions_of(_unpack(note).reshape(-1, 2))
                h = mix64((sums[at + depth] - sums[at]) * powers(len(data) + 1)[1][at])
                anchors.append(int(h.min() >> np.uint64(1)))
            yield batch.assign(anchor=np.array(anchors, np.int64))

    near = stage(in_small_batches(few).mapInPandas(anchored, "tid binary, text string, note binary, anchor bigint"), "near")
    left = near.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    pieces = max(1, math.ceil(left / (4 * BLOCK_BYTES)))
    near = near.repartitionByRange(pieces, "anchor", "tid").sortWithinPartitions("anchor", "tid")

    def unresolved(n: int, note: bytes) -> np.ndarray:
        """The places with a tied cover position among the next ones."""
        at = positions_of(_unpack(note).reshape(-1, 2))
        mark = np.zeros(n + 2, np.int64)
        np.add.at(mark, np.maximum(at - period + 1, 0), 1)
        np.add.at(mark, at + 1, -1)
        return np.flatnonzero(np.cumsum(mark)[: max(0, n - width + 1)] > 0)

    long_ties = tied(near, unresolved, width, buckets(2 * left), 12, longer) if longer else tied(near, unresolved, width, buckets(left), 16)
    widths = {"spans": ("deep", longer), "passages": ("runs", width)} if longer else {"spans": ("runs", width)}

    def as_spans(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = {"tid": batch["tid"]}
            for name, (source, width) in widths.items():
                found[name] = []
                for r in batch[source]:
                    runs = _unpack(r).reshape(-1, 2)
                    begin, end = runs[:, 0], runs[:, 0] + runs[:, 1] - 1 + width
                    cut = np.flatnonzero(begin[1:] > end[:-1])  # runs have one width, so ends ascend
                    begin, end = np.append(begin[:1], begin[cut + 1]), np.append(end[cut], end[-1:])
                    found[name].append([{"start": int(b), "end": int(e)} for b, e in zip(begin, end, strict=True)])
            yield pd.DataFrame(found)

    spans = long_ties.mapInPandas(as_spans, f"tid binary, {', '.join(f'{name} {_SPANS}' for name in widths)}")
    # A text that stands twice goes as a whole, where it has the width.
    whole = F.array(F.struct(F.lit(0).cast("bigint").alias("start"), F.col("n").cast("bigint").alias("end")))
    whole = copied.select("tid", *[F.when(F.col("n") >= w, whole).otherwise(F.array().cast(_SPANS)).alias(name) for name, (_, w) in widths.items()])
    return stage(spans.join(copied, "tid", "left_anti").unionByName(whole), "spans")


#: The results for each column of spans.
_RESULTS = {"spans": ("n_removed", "n_spans", "kept"), "passages": ("n_passage_bytes", "n_passages", "kept_of_passages")}


def _cut_out(size: Column, s: Column) -> list[Column]:
    """Of the bytes t without the spans s: bytes and spans that go, and what is left."""
    # The kept stretches lie between the ends of one span and the start of the next.
    starts = F.concat(F.array(F.lit(0).cast("bigint")), s["end"])
    ends = F.concat(s["start"], F.array(size))
    stretch = F.zip_with(starts, ends, lambda b, e: F.hex(F.substring("t", (b + 1).cast("int"), (e - b).cast("int"))))
    removed = F.aggregate(s, F.lit(0).cast("bigint"), lambda a, x: a + x["end"] - x["start"])
    return [removed, F.size(s).cast("bigint"), F.unhex(F.concat_ws("", stretch))]


def without_spans(docs: DataFrame, spans: DataFrame, text: str = "text") -> DataFrame:
    """`docs` with n_bytes, n_removed, n_spans and `kept`, the bytes that are left.

    Where `spans` has passages, also n_passage_bytes, n_passages and kept_of_passages, what is left without these.
    """
    results = {c: _RESULTS[c] for c in spans.columns if c in _RESULTS}
    names = ["n_bytes", *(n for r in results.values() for n in r)]
    held = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns if c not in names]).alias("d"), docs[text].alias("_t"))
    t = F.coalesce("_t", F.lit(""))
    rows = held.select("d", t.alias("t"), F.unhex(F.md5(F.encode(t, "UTF-8"))).alias("tid"))
    some, none = split_by(rows, spans, "tid")
    size, nothing = F.octet_length("t").cast("bigint"), F.lit(0).cast("bigint")
    as_is = [c.alias(n) for r in results.values() for c, n in zip((nothing, nothing, F.encode("t", "UTF-8")), r, strict=True)]
    none = none.select("d", size.alias("n_bytes"), *as_is)
    some = some.join(spans, "tid", "left").select("d", F.encode("t", "UTF-8").alias("t"), *[F.coalesce(c, F.array().cast(_SPANS)).alias(c) for c in results])
    cut = [x.alias(n) for c, r in results.items() for x, n in zip(_cut_out(size, F.col(c)), r, strict=True)]
    return none.unionByName(some.select("d", size.alias("n_bytes"), *cut)).select("d.*", *names)


def repeats_removed(docs: DataFrame, width: int = WIDTH, text: str = "text", passage: int | None = None) -> DataFrame:
    """`docs` with n_bytes, n_removed, n_spans and `kept`.

    With a shorter width `passage`, also n_passage_bytes, n_passages and kept_of_passages, the like of that width.
    """
    return without_spans(docs, repeated_spans(docs, width, text, passage=passage), text)


def whole_characters(kept: Column) -> Column:
    """The bytes that are left as text; half a character left at a cut goes with it."""
    t = kept.cast("string")
    return F.when(F.is_valid_utf8(t), t).otherwise(F.replace(F.make_valid_utf8(t), F.lit("\ufffd"), F.lit("")))
