"""Phrases of words that occur together, mined best first with score bounds.

A phrase of 2 to 5 words is scored at its worst cut into a first part and a rest:
1000 * f(phrase) * n / (f(first part) * f(rest)). As the rest occurs no less often than the
phrase, no phrase that begins with p scores above 1000 * n / f(p); of all prefixes the first
word gives the weakest of these bounds, which holds for everything that grows from it. So
the frontier is made of words, the rarest first. A step takes words off the frontier and
grows them, one word at a time, over the corpus: only phrases whose prefix occurred often
enough are counted. With what is known by then, every phrase grown has a bound of its own
(rests not yet counted are taken as often as the phrase). Rests are counted for those alone
whose bound reaches the language's `most`-th surviving score. A language is settled when that
score is above the bound of its frontier, or the frontier is empty; ties are expanded.

A phrase is dropped when some longer one with as many occurrences holds it. Then a phrase
longer by one word does, so it is enough to see whether one word stands before, or behind,
all its occurrences. That is asked in the pass that counts rests, of the phrases grown in
the step whose bound reaches the list. While a language has no full list, its 2 * `most`
best bounds are asked first, and the others only where their bound reaches what these gave.

Between steps the corpus is a table of runs of frequent words, in blobs of bounded size
per language, coded by the words of their blob; a step reads it once for each length. Counts are summed in a blob, then per
task, then over tasks, so a common phrase or language is no hot key. What is broadcast are
filters of FILTER_VALUES hashed values; the counts that follow are of the phrases
themselves.

Defined cases: a null text has no word; a null language is `und`; only A-Z is lower-cased;
phrases do not cross the marks of `DELIMITERS`; repeated rows count each time; an empty
table gives an empty one; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from umbra.llm.common import FILTER_VALUES, in_small_batches, stage

LEAST, LONGEST, MOST = 100, 5, 2000
DELIMITERS = b".,;:!?\n\x0b\x0c\r"
#: Shares of a language's frequent words, by occurrences, that have left the frontier after each step.
SHARES = (0.3, 1.0)
#: Bytes of text in a blob. Only a longer stretch without a delimiter makes a larger one.
BLOB_BYTES = 2_000_000

#: By byte: lower case, a full stop for a delimiter, a blank for a tab.
_FOLD = bytes(46 if b in DELIMITERS else 32 if b == 9 else b + 32 if 65 <= b <= 90 else b for b in range(256))
_FOUND = "lang string, phrase binary, n bigint"


def blobs(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[str, bytes]]:
    """The folded texts by language, in stretches of about BLOB_BYTES cut at full stops."""
    held: dict[str, list[bytes]] = {}
    size: dict[str, int] = {}

    def stretches(lang: str) -> Iterator[tuple[str, bytes]]:
        text = b".".join(held.pop(lang)).translate(_FOLD)
        del size[lang]
        at = 0
        while at < len(text):
            end = text.find(b".", at + BLOB_BYTES)
            end = len(text) if end < 0 else end
            yield lang, text[at:end]
            at = end

    for batch in batches:
        for lang, texts in batch.groupby("lang", sort=True)["t"]:
            held.setdefault(lang, []).extend(bytes(t) for t in texts)
            size[lang] = size.get(lang, 0) + sum(map(len, texts))
            if size[lang] >= BLOB_BYTES:
                yield from stretches(lang)
        if sum(size.values()) > 8 * BLOB_BYTES:  # many languages, each with a little
            for lang in list(held):
                yield from stretches(lang)
    for lang in list(held):
        yield from stretches(lang)


def words_of(folded: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the words in order, -1 for a full stop, and the distinct words."""
    tokens = np.array(folded.replace(b".", b" . ").split(), dtype=object)
    codes, distinct = pd.factorize(tokens) if len(tokens) else (np.zeros(0, np.int64), tokens)
    stop = np.flatnonzero(distinct == b".")
    return np.where(codes == (stop[0] if len(stop) else -1), -1, codes).astype(np.int64), distinct


def word_numbers(words: Sequence[bytes]) -> np.ndarray:
    """A number above 0 for each word, and 0 for none: 63 bits of a digest."""
    numbers = [1 + (int.from_bytes(hashlib.blake2b(w, digest_size=8).digest()) >> 1) for w in words]
    return np.minimum(np.array([*numbers, 0], np.uint64), np.uint64((1 << 63) - 1)).astype(np.int64)


def hashed(lang: str, phrases: Sequence[bytes]) -> np.ndarray:
    """The filter value of each phrase of a language."""
    start = zlib.crc32(lang.encode() + b"\t")
    return np.fromiter((zlib.crc32(p, start) for p in phrases), np.int64, len(phrases)) % FILTER_VALUES


def filter_of(phrases: DataFrame) -> np.ndarray:
    """Flags of the hashed values of (lang, phrase); FILTER_VALUES numbers at most are collected."""
    return filters_of(phrases.withColumn("length", F.lit(1)), 1)[0]


def filters_of(phrases: DataFrame, longest: int) -> list[np.ndarray]:
    """The flags of the phrases of each `length` from 1 to `longest`, gathered in one job."""
    value = F.crc32(F.concat(F.encode("lang", "UTF-8"), F.lit(b"\t"), "phrase")) % FILTER_VALUES
    flags = np.zeros((longest, FILTER_VALUES), bool)
    for r in phrases.select("length", value.cast("int").alias("v")).distinct().collect():
        flags[r["length"] - 1, r["v"]] = True
    return list(flags)


def word_counts(docs: DataFrame) -> DataFrame:
    """lang, phrase (one word) and n; the null phrase has the number of all words. `docs`: lang, t."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for lang, text in blobs(batches):
            codes, distinct = words_of(text)
            count = np.bincount(codes[codes >= 0], minlength=len(distinct))
            some = np.flatnonzero(count)
            yield pd.DataFrame({"lang": lang, "phrase": [None, *distinct[some]], "n": np.append(count.sum(), count[some])})

    return docs.mapInPandas(run, "lang string, phrase binary, n bigint").groupBy("lang", "phrase").agg(F.sum("n").alias("n"))


def frequent_runs(docs: DataFrame, frequent: np.ndarray) -> DataFrame:
    """lang, words and codes: stretches of two or more words that may be frequent, as places in `words` with -1 between stretches."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for lang, text in blobs(batches):
            codes, distinct = words_of(text)
            often = np.append(frequent[hashed(lang, distinct)], False)[codes]  # the last one is for -1
            beside = np.zeros(len(often), bool)
            beside[1:] |= often[:-1]
            beside[:-1] |= often[1:]
            often &= beside
            keep = often | np.append(often[1:], False)  # of all that is left out, one mark before a stretch
            left, used = pd.factorize(np.where(often, codes, -1)[keep], use_na_sentinel=False)
            number = np.where(used < 0, -1, np.cumsum(used >= 0) - 1)
            left = number[left] if len(left) else left
            yield pd.DataFrame({"lang": [lang], "words": [b" ".join(distinct[used[used >= 0]])], "codes": [left.astype("<i4").tobytes()]})

    return docs.mapInPandas(run, "lang string, words binary, codes binary")


def occurrences(corpus: DataFrame, filters: Sequence[np.ndarray], lengths: Sequence[int], beside: bool = False) -> DataFrame:
    """lang, phrase, n, and with `beside` the number of the one word before and behind all occurrences (0 if there is no such word).

    Counted are phrases of `lengths`. A phrase grows by a word only if it passes the filter of
    its length; it is returned only if it passes that, where there is one.
    """
    lengths = set(lengths)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for lang, words, codes in zip(batch["lang"], batch["words"], batch["codes"], strict=True):
                distinct, codes = bytes(words).split(), np.frombuffer(codes, "<i4").astype(np.int64)
                padded = np.concatenate([[-1], codes, np.full(LONGEST + 1, -1)])  # codes[i] is padded[i + 1]
                at = np.flatnonzero(codes >= 0)
                ids, phrases, numbers = codes[at], distinct, word_numbers(distinct) if beside else None
                for length in range(1, max(lengths) + 1):
                    if length > 1:
                        following = padded[at + length]
                        whole = following >= 0
                        at, ids, following = at[whole], ids[whole], following[whole]
                        ids, key = pd.factorize(ids * len(distinct) + following)
                        phrases = [phrases[i] + b" " + distinct[j] for i, j in zip(*(x.tolist() for x in np.divmod(key, len(distinct))), strict=True)]
                    if length <= len(filters):
                        passes = filters[length - 1][hashed(lang, phrases)]
                        keep = passes[ids] if len(ids) else np.zeros(0, bool)
                        at, ids = at[keep], ids[keep]
                    if not len(at):
                        break
                    if length in lengths:
                        count = np.bincount(ids, minlength=len(phrases))
                        some = np.flatnonzero(count)
                        row = {"lang": lang, "phrase": [phrases[i] for i in some.tolist()], "n": count[some]}
                        for name, near in (("before", padded[at]), ("after", padded[at + 1 + length])) if beside else ():
                            one = np.full(len(phrases), -1)
                            one[ids] = near
                            mixed = np.bincount(ids, near != one[ids], len(phrases)) > 0
                            row[name] = numbers[np.where(mixed, -1, one)[some]]
                        yield pd.DataFrame(row)

    return corpus.mapInPandas(run, _FOUND + ", before bigint, after bigint" * beside)


def settled(found: DataFrame) -> DataFrame:
    """lang, phrase, n, and whether one word is beside all occurrences (`inside`)."""
    of = found.groupBy("lang", "phrase").agg(F.sum("n").alias("n"), *[f(c).alias(f"{c}_{k}") for c in ("before", "after") for k, f in (("low", F.min), ("high", F.max))])
    inside = lambda c: (F.col(f"{c}_low") == F.col(f"{c}_high")) & (F.col(f"{c}_low") > 0)
    return of.select("lang", "phrase", "n", (inside("before") | inside("after")).alias("inside"))


def cuts(phrases: DataFrame) -> DataFrame:
    """A row for each cut of each phrase: lang, phrase, a, k, first and rest."""
    words = F.split(F.col("phrase").cast("string"), " ")
    part = lambda start, n: F.concat_ws(" ", F.slice("w", start, n)).cast("binary")
    rows = phrases.select("lang", "phrase", F.col("n").alias("a"), words.alias("w"))
    rows = rows.select("*", F.explode(F.sequence(F.lit(1), F.size("w") - 1)).alias("k"))
    return rows.select("lang", "phrase", "a", "k", part(F.lit(1), F.col("k")).alias("first"), part(F.col("k") + 1, F.size("w") - F.col("k")).alias("rest"))


def scored(cut: DataFrame, counts: DataFrame, totals: DataFrame) -> DataFrame:
    """The lowest cut of each phrase: lang, phrase, a, l, r, n, score, `missing` (rests not counted).

    A rest that is not in `counts` is taken as often as the phrase, which makes score a bound.
    """
    side = lambda name, n: counts.select("lang", F.col("phrase").alias(name), F.col("n").alias(n))
    rows = cut.join(side("first", "l"), ["lang", "first"]).join(side("rest", "r"), ["lang", "rest"], "left").join(totals, "lang")
    whole = "CAST({} AS DECIMAL(19, 0))".format
    score = F.expr(f"({whole(1000)} * {whole('a')} * {whole('n')}) div ({whole('l')} * {whole('coalesce(r, a)')})")
    lowest = F.min(F.struct(score.alias("score"), "k", "l", "r"))
    missing = F.collect_list(F.when(F.col("r").isNull(), F.col("rest")))  # no more than a phrase has words
    out = rows.groupBy("lang", "phrase", "a", "n").agg(lowest.alias("x"), missing.alias("missing"))
    return out.select("lang", "phrase", "a", "x.l", "x.r", "n", "x.score", "missing")


def best(rows: DataFrame, most: int) -> DataFrame:
    """The first `most` rows of each language, with their rank."""
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)


def collocations(docs: DataFrame, most: int = MOST, least: int = LEAST, longest: int = LONGEST, shares: Sequence[float] = SHARES, lang: str = "lang", text: str = "text") -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score of each language's first `most` phrases."""
    read = in_small_batches(docs.select(F.coalesce(docs[lang], F.lit("und")).alias("lang"), docs[text].cast("binary").alias("t")).where("t IS NOT NULL"))
    counted = stage(word_counts(read).where(F.col("phrase").isNull() | (F.col("n") >= least)), "words")
    totals = counted.where("phrase IS NULL").select("lang", "n")
    known = counted.where("phrase IS NOT NULL").select("lang", "phrase", "n")
    words = known.withColumn("level", F.floor(4 * F.log2("n")).cast("int"))
    corpus = stage(frequent_runs(read, filter_of(known)), "runs")

    # The frontier by language: (level, occurrences, least count) of its words; a few hundred levels at most.
    frontier: dict[str, list[tuple[int, int, int]]] = {}
    for r in words.groupBy("lang", "level").agg(F.sum("n").alias("n"), F.min("n").alias("low")).orderBy("lang", "level").collect():
        frontier.setdefault(r["lang"], []).append((r["level"], r["n"], r["low"]))
    size = {r["lang"]: r["n"] for r in totals.collect()}
    mass = {x: sum(n for _, n, _ in levels) for x, levels in frontier.items()}
    floors: dict[str, int] = {}  # the last score of a full list
    top = None
    for share in shares:
        taken = []
        for x, levels in list(frontier.items()):
            left = sum(n for _, n, _ in levels)
            grow = []
            while levels and left > (1 - share) * mass[x]:
                level, n, _ = levels.pop(0)
                left -= n
                grow.append(level)
            taken += [(x, level) for level in grow]
        if taken:
            chosen = docs.sparkSession.createDataFrame(taken, "lang string, level int")
            filters = [filter_of(words.join(F.broadcast(chosen), ["lang", "level"]))]
            grown = None
            for length in range(2, longest + 1):
                counts = occurrences(corpus, filters, [length]).groupBy("lang", "phrase").agg(F.sum("n").alias("n"))
                found = stage(counts.where(F.col("n") >= least), "phrases")
                filters.append(filter_of(found))
                if not filters[-1].any():
                    break
                grown = found if grown is None else grown.unionByName(found)
            if grown is not None:
                known = known.unionByName(grown.select("lang", "phrase", "n"))
                low = _by_language(floors)
                bounded = stage(scored(cuts(grown), known, totals).where(F.col("score") >= low), "bounded")
                rounds = [bounded]
                if any(x not in floors for x, _ in taken):  # the best bounds first, which give a floor to the others
                    head = stage(best(bounded, 2 * most).drop("rank"), "head")
                    rounds = [head, bounded.join(head.select("lang", "phrase"), ["lang", "phrase"], "left_anti")]
                for i, some in enumerate(rounds):
                    if i:
                        some = stage(some.where(F.col("score") >= _by_language(floors)), "tail")
                        if some.isEmpty():
                            break
                    exact, counted_rests = _survivors(corpus, some, known, totals, longest)
                    if counted_rests is not None:
                        known = known.unionByName(counted_rests)
                    # A word off the frontier grows as well where it meets a value of the filter, and so again in its own step.
                    both = exact if top is None else exact.unionByName(top.drop("rank")).dropDuplicates(["lang", "phrase"])
                    top = stage(best(both, most), "best")
                    for r in top.where(F.col("rank") == most).collect():
                        floors[r["lang"]] = r["score"]
        # A language is settled when nothing on its frontier can reach its list.
        for x, levels in list(frontier.items()):
            if not levels or (x in floors and 1000 * size[x] // levels[0][2] < floors[x]):
                del frontier[x]
        if not frontier:
            break
    if top is None:
        top = best(scored(cuts(known.where("false")), known, totals).drop("missing"), most)
    return top.select("lang", "rank", F.col("phrase").cast("string").alias("phrase"), "a", "l", "r", "n", "score")


def _by_language(floors: dict[str, int]) -> Column:
    """The floor of a row's language, or 0."""
    low = F.lit(0).cast("bigint")
    for x, score in floors.items():
        low = F.when(F.col("lang") == x, score).otherwise(low)
    return low


def _survivors(corpus: DataFrame, bounded: DataFrame, known: DataFrame, totals: DataFrame, longest: int) -> tuple[DataFrame, DataFrame | None]:
    """Exact scores of the phrases that no longer one holds, and the counts of rests (None if all were known)."""
    rests = bounded.select("lang", F.explode("missing").alias("phrase")).distinct()
    whole = bounded.where(F.size(F.split(F.col("phrase").cast("string"), " ")) < longest).select("lang", "phrase")
    asked = stage(rests.withColumn("rest", F.lit(True)).unionByName(whole.withColumn("rest", F.lit(False))), "asked")
    filters = _beginnings(asked, longest)
    if not filters[0].any():
        return bounded.drop("missing"), None
    seen = stage(settled(occurrences(corpus, filters, range(2, longest), beside=True)).join(asked, ["lang", "phrase"]), "seen")
    counted = seen.where("rest").select("lang", "phrase", "n")
    gone = seen.where("NOT rest AND inside").select("lang", "phrase")
    left = bounded.join(gone, ["lang", "phrase"], "left_anti")
    return scored(cuts(left.select("lang", "phrase", F.col("a").alias("n"))), known.unionByName(counted), totals).drop("missing"), counted


def _beginnings(phrases: DataFrame, longest: int) -> list[np.ndarray]:
    """Filters of the first 1, 2, ... words of the phrases, so that one pass over the corpus finds them."""
    words = F.split(F.col("phrase").cast("string"), " ")
    rows = phrases.select("lang", words.alias("w")).select("lang", "w", F.explode(F.sequence(F.lit(1), F.size("w"))).alias("length"))
    return filters_of(rows.select("lang", "length", F.concat_ws(" ", F.slice("w", F.lit(1), F.col("length"))).cast("binary").alias("phrase")), longest - 1)
