"""Language identification: sparse multinomial logistic regression on TF-IDF of character n-grams.

Document frequencies are counted over every learnable document. The weights are learned
by follow-the-regularised-leader with elastic-net penalties on a sample of at most
`per_language` documents of each language (in expectation: kept by a hash of id and text),
and one temperature is fitted on a part of the sample kept apart for that.

Defined cases: a null text, or one without a letter, is `und` with score 0; rows whose
language is null teach nothing; without any learnable row every text is `und`; repeated
rows get equal results; an empty table gives an empty one; other columns are ignored.
The prediction sees the text alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from umbra.llm.common import in_small_batches, mix64, text_rows

LENGTHS = (1, 2, 3)
DIMENSIONS = 1 << 15
#: Documents of one language that the weights are learned from, and languages at most.
PER_LANGUAGE = 1200
MAX_LANGUAGES = 1000
EPOCHS = 3
#: Step size and its offset, and the weights of the absolute and the squared penalty.
ALPHA, BETA, L1, L2 = 2.0, 1.0, 0.002, 0.01


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """By code point: the letter itself, or a blank for what is no letter."""
    points = np.arange(0x110000, dtype=np.uint32)
    points[[not chr(i).isalpha() for i in range(0x110000)]] = 32
    return points


def ngram_counts(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Buckets of the n-grams of each text, ascending, and how often each occurs; empty without a letter."""
    lowered = [t.lower() if t else "" for t in texts]
    text = " ".join(lowered) + "   "
    points = _letters()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)].astype(np.uint64)
    # Blanks count once: an n-gram with two of them in a row says nothing.
    hashes = []
    for n in LENGTHS:
        h = np.full(len(points) - n + 1, n, np.uint64)
        for k in range(n):
            h = h * np.uint64(0x100000001B3) + points[k : k + len(h)]
        h = (mix64(h) >> np.uint64(64 - 15)).astype(np.int64)
        blank = points == 32
        useless = blank[: len(h)].copy()
        for k in range(1, n):
            useless[: len(h)] &= blank[k : k + len(h)]
        h[useless] = -1
        hashes.append(h)
    at = 0
    for t in lowered:
        end = at + len(t)
        found = np.concatenate([h[at : max(at, end + 1 - n)] for n, h in zip(LENGTHS, hashes, strict=True)])
        counts = np.bincount(found[found >= 0], minlength=DIMENSIONS) if len(found) else np.zeros(DIMENSIONS, np.int64)
        ids = np.flatnonzero(counts)
        yield ids, counts[ids]
        at = end + 1


def weighted(ids: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """TF-IDF values of unit length."""
    x = np.log1p(counts) * idf[ids]
    return x / max(float(np.sqrt(x @ x)), 1e-12)


def document_frequencies(docs: DataFrame, text: str = "text") -> tuple[int, np.ndarray]:
    """Number of documents, and of those with each bucket, summed in two steps of bounded width."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, n = np.zeros(DIMENSIONS, np.int64), 0
        for batch in batches:
            for i, j in text_rows(batch["t"]):
                for ids, _ in ngram_counts(batch["t"].iloc[i:j].tolist()):
                    total[ids] += 1
                    n += 1
        yield pd.DataFrame({"part": [TaskContext.get().partitionId()], "n": [n], "df": [total.tobytes()]})

    def add(group: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(b, np.int64) for b in group["df"])
        return pd.DataFrame({"part": [int(group["part"].iloc[0])], "n": [int(group["n"].sum())], "df": [total.tobytes()]})

    schema = "part bigint, n bigint, df binary"
    sums = in_small_batches(docs).select(docs[text].alias("t")).mapInPandas(count, schema)
    sums = sums.withColumn("part", F.col("part") % 64).groupBy("part").applyInPandas(add, schema)
    rows = sums.collect()  # at most 64 vectors of fixed length
    total = np.zeros(DIMENSIONS, np.int64)
    for r in rows:
        total += np.frombuffer(bytes(r["df"]), np.int64)
    return sum(r["n"] for r in rows), total


def ftrl(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, n_labels: int, epochs: int = EPOCHS) -> np.ndarray:
    """Weights by bucket and label; the last bucket is the intercept."""
    z = np.zeros((DIMENSIONS + 1, n_labels))
    n = np.zeros_like(z)
    order = np.random.default_rng(7)
    rows = [(np.append(i, DIMENSIONS), np.append(x, 1.0)) for i, x in rows]

    def weights(zi: np.ndarray, ni: np.ndarray) -> np.ndarray:
        shrunk = np.sign(zi) * np.maximum(np.abs(zi) - L1, 0)
        return -shrunk / ((BETA + np.sqrt(ni)) / ALPHA + L2)

    for _ in range(epochs):
        for k in order.permutation(len(rows)).tolist():
            ids, x = rows[k]
            zi, ni = z[ids], n[ids]
            w = weights(zi, ni)
            s = x @ w
            p = np.exp(s - s.max())
            p /= p.sum()
            p[labels[k]] -= 1
            g = x[:, None] * p
            sigma = (np.sqrt(ni + g * g) - np.sqrt(ni)) / ALPHA
            z[ids] = zi + g - sigma * w
            n[ids] = ni + g * g
    return weights(z, n)


def temperature(scores: np.ndarray, labels: np.ndarray) -> float:
    """The divisor of the scores with the least log loss, between a twentieth and twenty.

    Targets are smoothed by one miss in n + 2, so that a part without a miss still has an optimum.
    """
    grid = np.exp(np.linspace(np.log(0.05), np.log(20), 241))
    if not len(labels):
        return 1.0

    miss = 1 / (len(labels) + 2)

    def loss(t: float) -> float:
        s = scores / t
        s = s - s.max(1, keepdims=True)
        s -= np.log(np.exp(s).sum(1, keepdims=True))
        right = s[np.arange(len(labels)), labels]
        wrong = (s.sum(1) - right) / max(1, s.shape[1] - 1)
        return float(-np.mean((1 - miss) * right + miss * wrong))

    return float(grid[int(np.argmin([loss(t) for t in grid]))])


def learn(docs: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", per_language: int = PER_LANGUAGE) -> dict | None:
    """The model: languages, idf, weights and temperature; None without a learnable row."""
    known = docs.where(docs[lang].isNotNull())
    counted = known.groupBy(F.col(lang).alias("lang")).count().limit(MAX_LANGUAGES + 1).collect()
    if not counted:
        return None
    if len(counted) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages; pass the ones to learn")
    names = sorted(r["lang"] for r in counted)
    n, df = document_frequencies(known, text)
    idf = np.log((1 + n) / (1 + df)) + 1
    scale = 1 << 20
    share = F.create_map(*[F.lit(v) for r in counted for v in (r["lang"], min(scale, int(scale * per_language / r["count"]) + 1))])
    # Rows are told apart by id and text: one id on many rows is neither taken nor left as a whole, and rows that repeat both count once.
    spot = F.xxhash64(F.col(key).cast("string"), F.col(text), F.lit("sample"))
    chosen = known.where(F.pmod(spot, F.lit(scale)) < share[F.col(lang)])
    chosen = chosen.select(F.col(lang).alias("lang"), F.col(text).alias("t"), (F.pmod(F.shiftright(spot, 20), F.lit(5)) == 0).alias("apart"), spot.alias("spot"))
    chosen = chosen.dropDuplicates(["lang", "spot"])

    def vectors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for i, j in text_rows(batch["t"]):
                part = batch.iloc[i:j]
                pairs = [(a.astype("<u2").tobytes(), c.astype("<u4").tobytes()) for a, c in ngram_counts(part["t"].tolist())]
                yield part[["lang", "apart", "spot"]].assign(ids=[p[0] for p in pairs], counts=[p[1] for p in pairs])

    def fit(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("spot", kind="stable")  # the same order whatever the shuffle did
        of = {name: i for i, name in enumerate(names)}
        rows, labels, apart = [], [], group["apart"].tolist()
        for name, i, c in zip(group["lang"], group["ids"], group["counts"], strict=True):
            ids = np.frombuffer(i, "<u2").astype(np.int64)
            rows.append((ids, weighted(ids, np.frombuffer(c, "<u4"), idf) if len(ids) else np.zeros(0)))
            labels.append(of[name])
        labels = np.array(labels)
        train = [k for k, a in enumerate(apart) if not a and len(rows[k][0])]
        test = [k for k, a in enumerate(apart) if a and len(rows[k][0])]
        w = ftrl([rows[k] for k in train], labels[train], len(names)) if train else np.zeros((DIMENSIONS + 1, len(names)))
        scores = np.array([rows[k][1] @ w[rows[k][0]] + w[-1] for k in test]).reshape(-1, len(names))
        return pd.DataFrame({"w": [w.astype("<f4").tobytes()], "temperature": [temperature(scores, labels[test])]})

    rows = chosen.mapInPandas(vectors, "lang string, apart boolean, spot bigint, ids binary, counts binary")
    model = rows.withColumn("one", F.lit(0)).groupBy("one").applyInPandas(fit, "w binary, temperature double").first()
    if model is None:
        return None
    w = np.frombuffer(bytes(model["w"]), "<f4").reshape(DIMENSIONS + 1, len(names))
    return {"names": names, "idf": idf.astype(np.float32), "w": w, "temperature": model["temperature"]}


def identify(docs: DataFrame, model: dict | None, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns of `keep`, lang_pred and score."""
    if model is None:
        return docs.select(*[f"`{c}`" for c in keep], F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    source = docs.select(*[f"`{c}`" for c in keep], docs[text].alias("_text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields[:-1])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names, idf, w, heat = model["names"], model["idf"], model["w"], model["temperature"]
        for batch in batches:
            for i, j in text_rows(batch["_text"]):
                part = batch.iloc[i:j]
                best, score = [], []
                for ids, counts in ngram_counts(part["_text"].tolist()):
                    if not len(ids):
                        best.append("und")
                        score.append(0.0)
                        continue
                    s = (weighted(ids, counts, idf) @ w[ids] + w[-1]) / heat
                    k = int(s.argmax())
                    best.append(names[k])
                    score.append(float(1 / np.exp(s - s[k]).sum()))
                yield part[list(keep)].assign(lang_pred=best, score=score)

    return in_small_batches(source).mapInPandas(run, f"{schema}, lang_pred string, score double")


def languages(docs: DataFrame, learnable: Column, per_language: int = PER_LANGUAGE, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Learn from the rows of `docs` that are `learnable`, and predict all of them."""
    return identify(docs, learn(docs.where(learnable), per_language=per_language), keep=keep)
