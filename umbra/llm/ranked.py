"""Ranked lexical search with range-maximum sparse tables, best interval first.

The index is made of blocks of documents. A block holds one posting list for each term that
some query asks for: the documents in order and how often each holds the term. Over the
impacts of a list lies a sparse table, which tells the largest impact of any range of
documents, and where it is, from two cells.

A query starts in a block with one interval, all documents. The sum of its terms'
range maxima bounds the score of every document inside. The intervals with the best bounds
are taken first, a growing number of them at once; each is split at its document of largest
impact into what lies before, that document, whose bound is its exact score, and what lies
behind. Intervals whose bound is under the k-th best score so far are given up. The blocks'
lists of k are merged. Documents of a block are ordered by their smallest term hash, so
that copies lie side by side and share intervals.

Scores are integers: the weight of a term is floor(1000 * ln((2N + 2) / (2 df + 1))), the
impact of tf occurrences in a document of n terms weight * ((10**9 * tf) div (1000 tf +
12 m)) with m = 75 + (25 n N) div L. N counts documents with a term and L all terms.

Query texts meet the blocks in chunks of bounded size, every chunk every block, which
queries against all rows must.

Defined cases: terms are runs of ASCII letters and digits and of all other characters
beyond ASCII, with A-Z lower-cased; a null or termless text is found by nothing and counts
in neither N nor L; a null or termless query finds nothing; equal scores go by ascending
doc_id, a null id first; rows that repeat an id are documents of their own; equal query rows
are answered once, different texts under one id each by itself; an empty table gives an
empty one; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from umbra.llm.common import FILTER_VALUES, in_small_batches, stage

K = 20
#: Bounds of a block of the index, and of the items of a chunk of queries.
BLOCK_DOCUMENTS, BLOCK_TOKENS, CHUNK_ITEMS = 8192, 4_000_000, 256
#: Longer texts are cut between words while they are counted.
TEXT_BYTES = 1_000_000
#: Intervals that are split at once: at first and at most.
FEW_INTERVALS, MANY_INTERVALS = 16, 1024
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: By byte: its lower case if it belongs to terms, else a blank.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 or 48 <= b <= 57 else 32 for b in range(256))
_NO_ID = np.iinfo(np.int64).min
_INDEX = "block bigint, term binary, n bigint, total bigint, docs binary, counts binary"


def term_counts(text: bytes) -> tuple[list[bytes], list[int]]:
    """Terms of a text and numbers of occurrences; only terms of long texts are summed."""
    folded = text.translate(_FOLD)
    if len(folded) <= TEXT_BYTES:
        found = folded.split()
        return found, [1] * len(found)
    summed: Counter[bytes] = Counter()
    at = 0
    while at < len(folded):
        end = folded.find(b" ", at + TEXT_BYTES)
        end = len(folded) if end < 0 else end
        summed.update(folded[at:end].split())
        at = end
    return list(summed), list(summed.values())


def _block(block: int, ids: list[int], found: list[bytes], times: list[int], ends: list[int], wanted: np.ndarray) -> pd.DataFrame:
    """The rows of one block: its documents (no term), and the posting list of each wanted term."""
    codes, distinct = pd.factorize(np.array(found, dtype=object)) if found else (np.zeros(0, np.int64), np.zeros(0, object))
    size = np.diff([0, *ends])
    doc, times = np.repeat(np.arange(len(ids)), size), np.array(times, np.int64)
    hashed = np.fromiter((zlib.crc32(t) for t in distinct), np.int64, len(distinct))
    lengths = np.bincount(doc, times, len(ids)).astype(np.int64)
    smallest = np.full(len(ids), np.iinfo(np.int64).max)
    if len(codes):
        held = size > 0
        smallest[held] = np.minimum.reduceat(hashed[codes], (np.array(ends) - size)[held])
    order = np.lexsort((lengths, smallest))
    place = np.empty(len(ids), np.int64)
    place[order] = np.arange(len(ids))
    asked = wanted[hashed % FILTER_VALUES][codes] if len(codes) else np.zeros(0, bool)
    key, inverse = np.unique(codes[asked].astype(np.int64) * len(ids) + place[doc[asked]], return_inverse=True)
    count = np.bincount(inverse, times[asked], len(key)).astype("<u4")
    term, at = np.divmod(key, len(ids))
    edge = np.flatnonzero(np.diff(term, prepend=-1, append=-1)) if len(key) else np.zeros(1, np.int64)
    rows = [(block, None, int((lengths > 0).sum()), int(lengths.sum()), np.array(ids, "<i8")[order].tobytes(), lengths[order].astype("<i8").tobytes())]
    at = at.astype("<u4")
    for i, j in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True):
        rows.append((block, distinct[term[i]], j - i, 0, at[i:j].tobytes(), count[i:j].tobytes()))
    return pd.DataFrame(rows, columns=["block", "term", "n", "total", "docs", "counts"])


def index(docs: DataFrame, wanted: np.ndarray, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows of blocks; `wanted` tells by hashed value whether a term may be asked for."""
    source = docs.select(docs[key].cast("bigint").alias("id"), F.coalesce(docs[text], F.lit("")).cast("binary").alias("t"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        block = TaskContext.get().partitionId() << 32
        ids, found, times, ends = [], [], [], []
        for batch in batches:
            for i, t in zip(batch["id"].astype("Int64").fillna(_NO_ID).tolist(), batch["t"], strict=True):
                terms, n = term_counts(bytes(t))
                if ids and (len(ids) >= BLOCK_DOCUMENTS or len(found) + len(terms) > BLOCK_TOKENS):
                    yield _block(block, ids, found, times, ends, wanted)
                    block += 1
                    ids, found, times, ends = [], [], [], []
                ids.append(i)
                found += terms
                times += n
                ends.append(len(found))
        if ids:
            yield _block(block, ids, found, times, ends, wanted)

    return in_small_batches(source).mapInPandas(run, _INDEX)


class Postings:
    """The lists of a block, one behind the other, with a sparse table of the places of range maxima for each."""

    def __init__(self, lists: list[tuple[np.ndarray, np.ndarray]]):
        """`lists` has documents (ascending) and impacts of each term."""
        none = np.zeros(0, np.int64)
        self.docs, self.impacts = (np.concatenate([none, *x]) for x in (zip(*lists, strict=True) if lists else ((), ())))
        self.starts = np.cumsum([0, *(len(d) for d, _ in lists)])
        deepest = max((len(d).bit_length() for d, _ in lists), default=1)
        self.levels = np.zeros((len(lists), deepest), np.int64)  # where the cells of a list's level begin, less its start
        cells, at = [], 0
        for t, (docs, impacts) in enumerate(lists):
            start, level, width = int(self.starts[t]), np.arange(len(docs), dtype=np.int32), 1
            for k in range(len(docs).bit_length()):
                if k:
                    left, right = level[: len(level) - width], level[width:]
                    level = np.where(impacts[left] >= impacts[right], left, right)
                    width *= 2
                cells.append(level + np.int32(start))
                self.levels[t, k] = at
                at += len(level)
        self.table = np.concatenate([np.zeros(0, np.int32), *cells])
        self.depth = np.frexp(np.arange(max((len(d) for d, _ in lists), default=0) + 1, dtype=float))[1] - 1  # by length of a range


def best_first(postings: Postings, terms: np.ndarray, times: np.ndarray, n: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Documents of a block (places) that may be among its k best, and their exact scores."""
    rank = np.zeros((len(terms), n + 1), np.int32)  # how many postings lie before a document
    for i, t in enumerate(terms.tolist()):
        rank[i, postings.docs[postings.starts[t] : postings.starts[t + 1]] + 1] = 1
    np.cumsum(rank, axis=1, out=rank)

    def bounded(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bound of each interval, and its document of largest impact."""
        first, end = rank[:, low], rank[:, high]
        term, interval = np.nonzero(end > first)
        i, j = first[term, interval].astype(np.int64), end[term, interval].astype(np.int64)
        level = postings.depth[j - i]
        cells = postings.levels[terms[term], level]
        left, right = postings.table[cells + i], postings.table[cells + j - (1 << level)]
        place = np.where(postings.impacts[left] >= postings.impacts[right], left, right)
        value = np.zeros(first.shape, np.int64)
        value[term, interval] = postings.impacts[place] * times[term]
        at = np.full(first.shape, -1, np.int64)
        at[term, interval] = postings.docs[place]
        top = value.argmax(0)
        return value.sum(0), at[top, np.arange(len(low))]

    low, high = np.zeros(1, np.int64), np.full(1, n, np.int64)
    bound, at = bounded(low, high)
    docs, scores, floor, together = np.zeros(0, np.int64), np.zeros(0, np.int64), 1, FEW_INTERVALS
    while True:
        open_ = bound >= floor
        low, high, bound, at = low[open_], high[open_], bound[open_], at[open_]
        if not len(low):
            return docs, scores
        first = np.arange(len(low)) if len(low) <= together else np.argpartition(-bound, together)[:together]
        rest = np.ones(len(low), bool)
        rest[first] = False
        # Each is split into what lies before its document of largest impact, that document, and what lies behind.
        split = at[first]
        begin, end = np.concatenate([split, low[first], split + 1]), np.concatenate([split + 1, split, high[first]])
        some = begin < end
        begin, end = begin[some], end[some]
        new_bound, new_at = bounded(begin, end)
        docs, scores = np.append(docs, split), np.append(scores, new_bound[: len(split)])
        if len(scores) > k:
            floor = max(floor, int(np.partition(scores, len(scores) - k)[len(scores) - k]))
            good = scores >= floor
            docs, scores = docs[good], scores[good]
        s = len(split)
        low, high, bound, at = (np.concatenate([x[rest], y[s:]]) for x, y in ((low, begin), (high, end), (bound, new_bound), (at, new_at)))
        together = min(2 * together, MANY_INTERVALS)


def ranked(docs: DataFrame, queries: DataFrame, k: int = K, key: str = "doc_id", text: str = "text", item: str = "item_id", asked: str = "text", chunk_items: int = CHUNK_ITEMS) -> DataFrame:
    """item_id, rank, doc_id and score of each query's k best documents with a score above 0."""
    terms = F.regexp_extract_all(F.translate(F.coalesce(queries[asked], F.lit("")), UPPER, LOWER), F.lit(TERM), F.lit(0))
    items = queries.select(queries[item].cast("bigint").alias("item_id"), terms.alias("terms")).where(F.size("terms") > 0).distinct()
    # Numbers are written, so that a task that runs again cannot change them.
    items = stage(items.withColumn("q", F.monotonically_increasing_id()), "items")
    chunks = max(1, -(-items.count() // chunk_items))
    of = items.select("q", F.pmod(F.xxhash64("q"), F.lit(chunks)).cast("int").alias("chunk"), F.explode("terms").alias("term"))
    of = of.groupBy("chunk", "q", F.col("term").cast("binary").alias("term")).agg(F.count("*").alias("times"))
    of = stage(of, "query_terms")
    hashed = of.select((F.crc32("term") % FILTER_VALUES).cast("int").alias("v")).distinct().collect()  # FILTER_VALUES at most
    wanted = np.zeros(FILTER_VALUES, bool)
    wanted[[r["v"] for r in hashed]] = True

    blocks = stage(index(docs, wanted, key, text), "index")
    n, total = blocks.where("term IS NULL").agg(F.sum("n"), F.sum("total")).first()
    n, total = n or 0, max(1, total or 0)
    lists = blocks.where("term IS NOT NULL")
    frequency = lists.groupBy("term").agg(F.sum("n").alias("df"))
    weight = F.floor(1000 * F.ln(F.lit(float(2 * n + 2)) / (2 * F.col("df") + 1))).cast("bigint")
    weighted = stage(of.select("chunk", "term").distinct().join(frequency, "term").select("chunk", "term", weight.alias("weight")), "weights")
    left = lists.join(weighted, "term").select("block", "chunk", "term", "weight", "docs", "counts")
    right = blocks.where("term IS NULL").select(
        F.col("block").alias("of"), F.col("docs").alias("ids"), F.col("counts").alias("lengths"), F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))).alias("part")
    )
    packed = of.groupBy(F.col("chunk").alias("part")).agg(F.collect_list(F.struct("q", "term", "times")).alias("asked"))
    right = right.join(packed, "part")

    def search(found: pd.DataFrame, about: pd.DataFrame) -> pd.DataFrame:
        nothing = pd.DataFrame({"q": [], "doc_id": [], "score": []}, dtype=np.int64)
        if not len(found) or not len(about):
            return nothing
        ids, lengths = np.frombuffer(about["ids"].iloc[0], "<i8"), np.frombuffer(about["lengths"].iloc[0], "<i8")
        m = np.array([75 + 25 * x * n // total for x in lengths.tolist()], np.int64)
        number, lists = {}, []
        for t, w, d, c in zip(found["term"], found["weight"].tolist(), found["docs"], found["counts"], strict=True):
            at, tf = np.frombuffer(d, "<u4").astype(np.int64), np.frombuffer(c, "<u4").astype(np.int64)
            number[bytes(t)] = len(lists)
            lists.append((at, w * (1_000_000_000 * tf // (1000 * tf + 12 * m[at]))))
        postings = Postings(lists)
        of_query: dict[int, list] = {}
        for r in about["asked"].iloc[0]:
            if (t := number.get(bytes(r["term"]))) is not None:
                of_query.setdefault(r["q"], []).append((t, r["times"]))
        out = []
        for q, pairs in of_query.items():
            terms, times = np.array(pairs, np.int64).T
            at, score = best_first(postings, terms, times, len(ids), k)
            best = np.lexsort((ids[at], -score))[:k]
            out.append(pd.DataFrame({"q": q, "doc_id": ids[at][best], "score": score[best]}))
        return pd.concat(out) if out else nothing

    best = left.groupBy("block", "chunk").cogroup(right.groupBy("of", "part")).applyInPandas(search, "q bigint, doc_id bigint, score bigint")
    best = best.withColumn("doc_id", F.when(F.col("doc_id") != _NO_ID, F.col("doc_id")))
    order = Window.partitionBy("q").orderBy(F.desc("score"), F.asc_nulls_first("doc_id"))
    top = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return top.join(items.select("q", "item_id"), "q").select("item_id", "rank", "doc_id", "score")
