"""Toxicity by weak supervision: voters, a generative label model, a linear classifier.

Voters are lexicons, patterns and the annotator. Each says "toxic" or abstains. The
lexicons are a short public seed list, and terms mined from learnable labelled documents:
words and word beginnings that fall on toxic documents more often than chance allows, in
lexicons by kind and strength. Patterns are shouting, repeated marks, drawn-out letters,
masked letters and address in the second person. The annotator's label is a voter like
the others, so that a text no lexicon speaks about can still be known to be toxic. The label
model is a mixture of two classes fitted by expectation maximisation: it estimates how
often each voter speaks in either class, and the correlation of voters within a class, by
which the weight of voters that repeat each other is reduced. Its posterior labels train a
logistic regression on the terms and patterns, which scores every text.

Learning uses at most `per_class` toxic documents and CLEAN_RATIO times as many clean
ones, in expectation: rows are kept by a hash of id and text, and rows that repeat both
count once. Everything else covers all rows.

Defined cases: a null, empty or wordless text gets the score of no evidence; labels that
are null or of documents outside the learnable ones teach nothing; repeated labels of one
document count once, as their maximum; without labels of both classes the seed list
decides; repeated rows get equal scores; an empty table gives an empty one; other columns
are ignored. A score sees the text alone.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from umbra.llm.common import BYTE_VALUES, in_small_batches, joined_bytes, mix64, powers, prefix_sums, stage, text_batches

#: Common insults of English, German, French and Spanish.
SEEDS = (
    "idiot moron stupid loser pathetic worthless scum trash disgusting clown dumb jerk imbecile "
    "dumm dummkopf trottel arschloch abschaum widerlich "
    "imbécile crétin connard salaud stupide minable "
    "estúpido imbécil idiota basura asqueroso payaso"
).split()
PREFIXES = (4, 5)  # bytes of a word that count as its beginning
#: Toxic documents to learn from, and clean ones for each of them.
PER_CLASS, CLEAN_RATIO = 2500, 4
LEAST_DOCUMENTS = 3
VOTERS_PER_KIND = 6
ITERATIONS = 50
#: Patterns over the bytes of a text with A-Z lower-cased; each is a voter and a feature.
PATTERNS = {
    "repeated_marks": rb"[!?]{3}",
    "drawn_out": rb"([a-z])\1\1\1",
    "masked": rb"(?<![a-z])[a-z]+[*@$#]+[a-z*@$#]*",
    "second_person": rb"(?<![a-z\x80-\xff])(?:you|your|you're|ur|du|dich|dein|tu|toi|t'es|eres)(?![a-z\x80-\xff])",
}
_PATTERNS = [re.compile(p) for p in PATTERNS.values()]
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
#: Stand for a pattern, or for shouting, among the terms.
PATTERN_TERMS = np.arange(1, len(PATTERNS) + 2, dtype=np.uint64)

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_LETTER = np.zeros(256, bool)
_LETTER[128:] = _LETTER[97:123] = True


def terms(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Term hashes and their kinds (0 word, then beginnings, last patterns) of each text."""
    data, starts, sizes = joined_bytes(texts, gap=1, fill=32)
    capitals = np.cumsum(np.append(0, (data >= 65) & (data <= 90)))
    data = _FOLD[data]
    letter = _LETTER[data]
    letters = np.cumsum(np.append(0, letter))
    edge = np.flatnonzero(np.diff(letter.astype(np.int8), prepend=0))
    begins, ends = edge[0::2], edge[1::2]
    sums, down = prefix_sums(BYTE_VALUES[data]), powers(len(data) + 1)[1]
    hashes, kinds, owner = [], [], []
    for kind, length in enumerate((0, *PREFIXES)):
        b = begins if not length else begins[ends - begins > length]
        e = ends if not length else b + length
        hashes.append(mix64((sums[e] - sums[b]) * down[b] + np.uint64(kind)))
        kinds.append(np.full(len(b), kind, np.int8))
        owner.append(np.searchsorted(starts, b, side="right") - 1)
    hashes, kinds, owner = np.concatenate(hashes), np.concatenate(kinds), np.concatenate(owner)
    order = np.argsort(owner, kind="stable")
    hashes, kinds = hashes[order], kinds[order]
    edges = np.searchsorted(owner[order], np.arange(len(texts) + 1))
    for k, (i, j) in enumerate(zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)):
        a, z = starts[k], starts[k] + sizes[k]
        n = letters[z] - letters[a]
        folded = texts[k].translate(_LOWER)
        found = [bool(p.search(folded)) for p in _PATTERNS] + [bool(n > 20 and 2 * (capitals[z] - capitals[a]) > n)]
        said = PATTERN_TERMS[found]
        yield np.append(hashes[i:j], said), np.append(kinds[i:j], np.full(len(said), 1 + len(PREFIXES), np.int8))


def seed_hashes() -> np.ndarray:
    """The term hashes of the seed words."""
    return np.sort(np.concatenate([h[k == 0] for h, k in terms([w.encode() for w in SEEDS])]))


def member(values: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Which of `values` are in the sorted `table`."""
    if not len(table):
        return np.zeros(len(values), bool)
    return table[np.minimum(np.searchsorted(table, values), len(table) - 1)] == values


def label_model(votes: np.ndarray, mass: np.ndarray, iterations: int = ITERATIONS, annotator: int | None = None) -> tuple[np.ndarray, dict]:
    """Posterior probability of the second class for each row of 0/1 votes with its mass, and the estimates.

    The classes differ in how often each voter speaks. The start takes a row for toxic when
    any voter speaks. Correlations within the classes divide a voter's weight by one plus
    what it shares with the others. A voter that is the `annotator` says which class is
    which: the start follows it, and its estimates begin from rates of 0.9 and 0.01, as if
    seen on as many rows as there are, so that few rows cannot turn the classes round.
    """
    n, m = votes.shape
    post = np.where(votes.any(1), 0.9, 0.01)
    speaks = np.zeros((2, m))
    seen, said = np.ones((2, m)), np.full((2, m), 0.5)
    if annotator is not None:
        y = votes[:, annotator]
        post = np.where(y > 0, 0.9, 0.01)
        for c, rate, rows in ((0, 0.01, mass @ (1 - y)), (1, 0.9, mass @ y)):
            seen[c, annotator], said[c, annotator] = rows, rate * rows

    def correlation(p: np.ndarray, mean: np.ndarray) -> np.ndarray:
        d = votes - mean
        cov = (d * p[:, None]).T @ d / max(p.sum(), 1e-9)
        sd = np.sqrt(np.maximum(np.diag(cov), 1e-12))
        return cov / np.outer(sd, sd) * (1 - np.eye(m))

    def discount(shared: np.ndarray, least: float) -> np.ndarray:
        """Weights of voters that repeat each other; the annotator labels on its own."""
        shared = np.where(shared > least, shared, 0)
        if annotator is not None:
            shared[annotator] = shared[:, annotator] = 0
        return 1 / (1 + shared.sum(1))

    # Voters that say the same whatever the class would pass for a class of their own.
    weight = discount(correlation(mass, np.average(votes, axis=0, weights=mass)), 0.9)
    shared = np.zeros((m, m))
    # First as if voters were independent; then, with the classes told apart, less what they share.
    for discounted in (False, True):
        for _ in range(iterations):
            old = post
            toxic = float(np.clip(np.average(post, weights=mass), 1e-4, 1 - 1e-4))
            for c, p in ((0, (1 - post) * mass), (1, post * mass)):
                speaks[c] = (p @ votes + said[c]) / (p.sum() + seen[c])
            yes = np.log(speaks[1]) - np.log(speaks[0])
            no = np.log1p(-speaks[1]) - np.log1p(-speaks[0])
            score = np.log(toxic) - np.log(1 - toxic) + votes @ (weight * yes) + (1 - votes) @ (weight * no)
            post = 1 / (1 + np.exp(-np.clip(score, -30, 30)))
            if np.abs(post - old).max() < 1e-6:
                break
        if not discounted:
            for c, p in ((0, (1 - post) * mass), (1, post * mass)):
                shared = np.maximum(shared, correlation(p, speaks[c]))
            weight = discount(shared, 0.1)
    return post, {"speaks": speaks, "correlation": shared, "weight": weight}


def logistic(rows: list[np.ndarray], target: np.ndarray, mass: np.ndarray, size: int, ridge: float = 1.0, steps: int = 300) -> tuple[np.ndarray, float]:
    """Weights of binary features and the intercept, by accelerated gradient steps on all rows."""
    of = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    at = np.concatenate(rows) if len(of) else np.zeros(0, np.int64)
    count = np.maximum(np.bincount(at, mass[of], minlength=size), 1e-9)
    mean = float(np.average(target, weights=mass))
    w, b = np.zeros(size), float(np.log(mean / (1 - mean)))
    w2, b2, rate = np.zeros(size), 0.0, 0.5
    for _ in range(steps):
        s = b + np.bincount(of, w[at], minlength=len(rows))
        e = (1 / (1 + np.exp(-np.clip(s, -30, 30))) - target) * mass
        g = np.bincount(at, e[of], minlength=size) + ridge * w
        w2 += (g / count) ** 2
        gb = float(e.sum() / mass.sum())
        b2 += gb**2
        w = w - rate * (g / count) / np.sqrt(w2 + 1e-8)
        b = b - rate * gb / np.sqrt(b2 + 1e-8)
    return w, b


def significant(c1: np.ndarray, c0: np.ndarray, n1: int, n0: int) -> np.ndarray:
    """Terms on so many toxic and clean documents that chance, over all terms tried, hardly does it (Chernoff's bound)."""
    rate, expected = c1 / (c1 + c0), n1 / (n0 + n1)
    with np.errstate(divide="ignore", invalid="ignore"):
        rest = np.where(rate < 1, (1 - rate) * np.log((1 - rate) / (1 - expected)), 0)
        surprise = (c1 + c0) * (np.where(rate > 0, rate * np.log(rate / expected), 0) + rest)
    return (rate > expected) & (c1 >= LEAST_DOCUMENTS) & (surprise > np.log(len(c1)))


def votes_of(rows: list[np.ndarray], kind: np.ndarray, strength: np.ndarray, seeded: np.ndarray, y: np.ndarray) -> np.ndarray:
    """What each voter says of each row: lexicons by kind and strength, patterns, seeds once and twice, the annotator."""
    lexicons = 1 + len(PREFIXES)
    voter = np.zeros(len(kind), np.int64)
    for k in range(lexicons):
        of = np.flatnonzero(kind == k)
        voter[of[np.lexsort((of, -strength[of]))]] = k * VOTERS_PER_KIND + np.arange(len(of)) * VOTERS_PER_KIND // max(1, len(of))
    patterns = np.flatnonzero(kind == lexicons)
    voter[patterns] = lexicons * VOTERS_PER_KIND + np.arange(len(patterns))
    votes = np.zeros((len(rows), lexicons * VOTERS_PER_KIND + len(PATTERN_TERMS) + 3))
    for i, r in enumerate(rows):
        votes[i, voter[r]] = 1
        votes[i, -3] = seeded[r].any()
        votes[i, -2] = seeded[r].sum() > 1
    votes[:, -1] = y
    return votes[:, votes.any(0)]


def fit_terms(sets: list[np.ndarray], kinds_of: list[np.ndarray], y: np.ndarray, clean_mass: float, seeds: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Mine the terms, vote, fit the label model and the classifier: terms, weights, intercept.

    `sets` and `kinds_of` are the distinct terms of each text, y is 1 for toxic; a clean text
    stands for `clean_mass` of them.
    """
    n1, n0 = int(y.sum()), int((1 - y).sum())
    flat, kind = np.concatenate(sets), np.concatenate(kinds_of)
    mark = np.repeat(y, [len(s) for s in sets])
    values, first, of = np.unique(flat, return_index=True, return_inverse=True)
    kind = kind[first]
    c1 = np.bincount(of, mark, len(values))
    c0 = np.bincount(of, 1 - mark, len(values))
    best = np.flatnonzero(significant(c1, c0, n1, n0) | member(values, seeds))
    table, kind = values[best], kind[best]
    strength = (c1[best] + 0.5) / (c0[best] + 0.5)
    rows = [np.searchsorted(table, s[member(s, table)]) for s in sets]
    seeded = member(table, seeds)
    # Clean rows stand for as many as the sample left out.
    mass = np.where(y == 1, 1.0, max(1.0, clean_mass))
    votes = votes_of(rows, kind, strength, seeded, y)
    post, _ = label_model(votes, mass, annotator=votes.shape[1] - 1)
    w, b = logistic(rows, np.clip(post, 0.001, 0.999), mass, len(table))
    w = np.where(seeded, np.maximum(w, 1.0), np.maximum(w, 0.0))
    return table, w, b


def learn(docs: DataFrame, labels: DataFrame, label: str = "toxic", key: str = "doc_id", text: str = "text", per_class: int = PER_CLASS) -> dict:
    """Term hashes, their weights and the intercept, from the `docs` that may be learned from."""
    seeds = seed_hashes()
    fallback = {"terms": seeds, "weights": np.full(len(seeds), 4.0), "intercept": -3.0}
    known = labels.where(labels[label].isNotNull() & labels[key].isNotNull()).groupBy(F.col(key).cast("string").alias("_k")).agg(F.max(label).alias("y"))
    known = known.withColumn("y", (F.col("y") > 0).cast("int"))
    # Classes are counted over the documents themselves: a label without a learnable document counts for nothing.
    ids = docs.select(docs[key].cast("string").alias("_k")).where("_k IS NOT NULL").distinct()
    known = stage(known.join(ids, "_k"), "known")
    counted = {r["y"]: r["count"] for r in known.groupBy("y").count().collect()}
    if len(counted) < 2:
        return fallback
    scale = 1 << 20
    wanted = {1: per_class, 0: CLEAN_RATIO * per_class}
    share = {y: min(scale, int(scale * wanted[y] / n) + 1) for y, n in counted.items()}

    def kept(rows: DataFrame, shares: dict[int, int], *of: str) -> DataFrame:
        spot = F.pmod(F.xxhash64(*of, F.lit("sample")), F.lit(scale))
        return rows.where(spot < F.when(F.col("y") == 1, shares[1]).otherwise(shares[0]))

    # About 5 * per_class ids in expectation, so they are sent to every task.
    chosen = docs.select(docs[key].cast("string").alias("_k"), docs[text].alias("t")).join(F.broadcast(kept(known, share, "_k")), "_k")
    chosen = chosen.select("_k", "t", "y", F.md5(F.encode(F.coalesce("t", F.lit("")), "UTF-8")).alias("_m"))
    # An id may stand on many rows: those of one text count once, and the bound holds for rows too.
    held = {r["y"]: r["count"] for r in chosen.select("_k", "_m", "y").distinct().groupBy("y").count().collect()}
    again = {y: min(scale, int(scale * wanted[y] / max(1, held.get(y, 0))) + 1) for y in (0, 1)}
    chosen = kept(chosen, again, "_k", "_m").dropDuplicates(["_k", "_m"]).select("_k", "t", "y")
    clean_mass = (counted[0] / max(1, held.get(0, 0))) / (counted[1] / max(1, held.get(1, 0))) * (again[1] / again[0])

    def distinct(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at, part in text_batches(batch["t"].tolist()):
                rows = []
                for k, (h, kind) in enumerate(terms(part)):
                    h, first = np.unique(h, return_index=True)
                    rows.append((batch["_k"].iloc[at + k], int(batch["y"].iloc[at + k]), h.tobytes(), kind[first].tobytes()))
                yield pd.DataFrame(rows, columns=["k", "y", "h", "kind"])

    def fit(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["k", "h"], kind="stable").drop_duplicates(["h", "y"])  # copies teach once
        y = group["y"].to_numpy()
        if y.all() or not y.any():
            return pd.DataFrame({"terms": [b""], "weights": [b""], "intercept": [0.0]})
        sets = [np.frombuffer(h, np.uint64) for h in group["h"]]
        kinds = [np.frombuffer(k, np.int8) for k in group["kind"]]
        table, w, b = fit_terms(sets, kinds, y, clean_mass, seeds)
        return pd.DataFrame({"terms": [table.tobytes()], "weights": [w.tobytes()], "intercept": [b]})

    sets = in_small_batches(chosen).mapInPandas(distinct, "k string, y int, h binary, kind binary").withColumn("one", F.lit(0))
    model = sets.groupBy("one").applyInPandas(fit, "terms binary, weights binary, intercept double").first()
    if model is None or not model["terms"]:
        return fallback
    return {"terms": np.frombuffer(bytes(model["terms"]), np.uint64), "weights": np.frombuffer(bytes(model["weights"])), "intercept": model["intercept"]}


def score(docs: DataFrame, model: dict, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns of `keep` and score, 0 to 1."""
    source = docs.select(*[f"`{c}`" for c in keep], docs[text].alias("_text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields[:-1])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table, weights, intercept = model["terms"], model["weights"], model["intercept"]
        maybe = np.zeros(1 << 20, bool)  # most terms of a text are ruled out by their first 20 bits
        maybe[(table >> np.uint64(44)).astype(np.int64)] = True
        for batch in batches:
            for at, texts in text_batches(batch["_text"].tolist()):
                found = []
                for h, _ in terms(texts):
                    h = np.unique(h[maybe[(h >> np.uint64(44)).astype(np.int64)]])
                    h = h[member(h, table)]
                    s = intercept + float(weights[np.searchsorted(table, h)].sum())
                    found.append(1 / (1 + np.exp(-np.clip(s, -30, 30))))
                yield batch.iloc[at : at + len(texts)][list(keep)].assign(score=np.array(found))

    return in_small_batches(source).mapInPandas(run, f"{schema}, score double")


def toxicity(docs: DataFrame, labels: DataFrame, learnable: Column, keep: tuple[str, ...] = ("doc_id",), threshold: float = 0.3) -> DataFrame:
    """Learn from the labelled rows of `docs` that are `learnable`, and score all of them."""
    model = learn(docs.where(learnable), labels)
    return score(docs, model, keep=keep).withColumn("predicted", (F.col("score") >= threshold).cast("int"))
