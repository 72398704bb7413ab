"""Near duplicates, repeated passages, exact search, models and the pipeline."""

import os
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from umbra.llm import common, langid, neardup, packing, queries, suffixes, topk, toxicity

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sentences(seed, n):
    rng = random.Random(seed)
    return [f"w{rng.randint(0, 5000)}" for _ in range(n)]


# ------------------------------------------------------------- near duplicates
def components_of(texts):
    """doc -> (set size, smallest linked doc), by comparing all pairs."""
    sets = []
    for t in texts:
        w = WORD.findall((t or "").translate(LOWER))
        sets.append(frozenset(zip(*[w[k:] for k in range(5)])) if len(w) >= 5 else frozenset([tuple(w)] if w else []))
    root = list(range(len(texts)))
    moved = True
    while moved:
        moved = False
        for i, a in enumerate(sets):
            for j, b in enumerate(sets[:i]):
                if a and b and 100 * len(a & b) >= 75 * len(a | b) and root[i] != root[j]:
                    root[i] = root[j] = min(root[i], root[j])
                    moved = True
    return {i: (len(s), root[i]) for i, s in enumerate(sets)}


def near_texts():
    rng = random.Random(7)
    base = sentences(1, 120)
    texts = [None, "", " ", "one two", "ONE two", "a b c d e", " ".join(base), " ".join(base).upper(), " ".join(sentences(2, 80)), "é É"]
    for k in range(40):  # copies with more and more changes, so that chains and strays arise
        t = list(base)
        for _ in range(k // 4):
            t[rng.randrange(len(t))] = f"x{rng.randint(0, 99)}"
        texts.append(" ".join(t[: 120 - k % 7]))
    texts += [" ".join([*base[:100], *sentences(50 + k, 40)]) for k in range(10)]
    return texts


@pytest.mark.parametrize("block_nodes", [256, 4])
def test_near_duplicates_equal_all_pairs(docs_of, block_nodes):
    texts = near_texts()
    got = {r["doc_id"]: r for r in neardup.near_duplicates(docs_of(texts), block_nodes=block_nodes).collect()}
    for i, (n, root) in components_of(texts).items():
        assert (got[i]["n_shingles"], got[i]["component_id"], got[i]["kept"]) == (n, root, root == i), i


def test_near_duplicates_with_repeated_and_null_ids(docs_of):
    same = " ".join(sentences(3, 30))
    docs = docs_of([same, same, "other text of one kind only", same], ids=[5, None, 5, 5])
    rows = sorted((r["doc_id"] is None, r["component_id"], r["kept"]) for r in neardup.near_duplicates(docs).collect())
    assert rows == [(False, 5, True), (False, 5, True), (False, 5, True), (True, 5, False)]
    assert neardup.near_duplicates(docs.limit(0)).count() == 0


def test_op9_on_a_table_equals_all_pairs(spark, sf):
    texts = [r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").collect()]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in queries.QUERIES["op9_minhash_near_dedup"](spark, sf).collect()}
    assert got == components_of(texts)


def test_one_stray_round_a_leader_costs_few_rows(spark):
    around = spark.range(2000).selectExpr("1L AS leader", "id AS node", "CASE WHEN id = 7 THEN 7L ELSE 0L END AS label")
    rows = neardup.in_blocks(around, 256).collect()
    assert len(rows) == 1999 + 8 + 1
    blocks = {}
    for r in rows:
        blocks.setdefault((r["low"], r["high"]), []).append(r)
    met = {x["node"] for b in blocks.values() if any(r["node"] == 7 for r in b) for x in b if x["half"] == 0}
    assert met == set(range(2000)) - {7}


def test_many_texts_under_one_id_each_meet_their_own_node(docs_of):
    base = sentences(3, 60)
    texts = [" ".join([*base[:57], *sentences(k, 3)]) for k in range(30)] + [" ".join(sentences(100 + k, 40)) for k in range(30)]
    docs = docs_of(texts, ids=[5] * 20 + [None] * 10 + list(range(100, 130)))
    wanted = docs.select(neardup._text_id(F.col("text")).alias("tid")).withColumn("node", F.monotonically_increasing_id())
    assert neardup._texts_of(docs.union(docs), wanted).count() == 60
    got = neardup.near_duplicates(docs).collect()
    assert len(got) == 60 and {r["component_id"] for r in got if r["doc_id"] in (5, None)} == {5}


# ------------------------------------------------------------- repeated passages
def kept_bytes(texts, width):
    raw = [(t or "").encode() for t in texts]
    seen = {}
    for b in raw:
        for i in range(len(b) - width + 1):
            seen[b[i : i + width]] = seen.get(b[i : i + width], 0) + 1
    out = []
    for b in raw:
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - width + 1):
            if seen[b[i : i + width]] > 1:
                gone[i : i + width] = True
        spans = int((np.diff(np.append(0, gone.astype(int))) == 1).sum())
        out.append((len(b), int(gone.sum()), spans, np.frombuffer(b, np.uint8)[~gone].tobytes()))
    return out


@pytest.mark.parametrize("width,block", [(400, 1_000_000), (100, 600), (20, 300)])
def test_repeats_equal_brute_force(docs_of, monkeypatch, width, block):
    monkeypatch.setattr(suffixes, "BLOCK_BYTES", block)
    rng = random.Random(width)
    alphabet = "abcdé 日"
    passages = ["".join(rng.choices(alphabet, k=width + 50)) for _ in range(4)]
    texts = [None, "", "short", passages[0], passages[0], "z" * (width + 7), "q" * width, "ab" * width]
    for _ in range(25):
        p = rng.choice(passages)
        i = rng.randint(0, 60)
        texts.append("".join(rng.choices(alphabet, k=rng.randint(0, 90))) + p[i:] + rng.choice(passages)[: rng.randint(0, width + 50)])
    got = {r["doc_id"]: r for r in suffixes.repeats_removed(docs_of(texts), width).collect()}
    for i, want in enumerate(kept_bytes(texts, width)):
        assert (got[i]["n_bytes"], got[i]["n_removed"], got[i]["n_spans"], bytes(got[i]["kept"])) == want, i
    assert suffixes.repeats_removed(docs_of(texts).limit(0), width).count() == 0


@pytest.mark.parametrize("width,passage,block", [(400, 250, 1_000_000), (100, 60, 600), (40, 7, 300)])
def test_both_widths_of_one_pass_equal_brute_force(docs_of, monkeypatch, width, passage, block):
    monkeypatch.setattr(suffixes, "BLOCK_BYTES", block)
    rng = random.Random(width)
    alphabet = "abcdé 日"
    passages = ["".join(rng.choices(alphabet, k=width + 50)) for _ in range(4)]
    texts = [None, "", "short", passages[0], passages[0], "z" * (width + 7), "q" * passage, "ab" * width, "copied" * (passage // 5), "copied" * (passage // 5)]
    for _ in range(40):  # parts of all lengths about both widths, also next to each other
        i, j = rng.randint(0, 60), rng.randint(passage // 2, width)
        texts.append("".join(rng.choices(alphabet, k=rng.randint(0, 90))) + rng.choice(passages)[i : i + j] + rng.choice(passages)[: rng.randint(0, width)])
    got = {r["doc_id"]: r for r in suffixes.repeats_removed(docs_of(texts), width, passage=passage).collect()}
    for i, (long, short) in enumerate(zip(kept_bytes(texts, width), kept_bytes(texts, passage), strict=True)):
        assert (got[i]["n_bytes"], got[i]["n_removed"], got[i]["n_spans"], bytes(got[i]["kept"])) == long, i
        assert (got[i]["n_bytes"], got[i]["n_passage_bytes"], got[i]["n_passages"], bytes(got[i]["kept_of_passages"])) == short, i
    assert suffixes.repeats_removed(docs_of(texts).limit(0), width, passage=passage).count() == 0
    with pytest.raises(ValueError):
        suffixes.repeated_spans(docs_of(texts), width, passage=width)


def test_op3_tells_passages_of_over_50_words_from_its_400_bytes(spark, docs_of, tmp_path):
    own = [" ".join(sentences(200 + k, 80)) for k in range(6)]
    passage = " ".join(sentences(300, 55))  # of 285 bytes or more, and under 400
    assert 285 <= len(passage) < 400
    texts = [own[0] + " " + passage + " " + own[1], own[2] + " " + passage + " " + own[3], own[4], own[5]]
    docs_of(texts).write.parquet(str(tmp_path / "documents.parquet"))
    got = {r["doc_id"]: r for r in queries.QUERIES["op3_suffix_array_dedup"](spark, str(tmp_path)).collect()}
    assert [got[k]["n_removed"] for k in range(4)] == [0] * 4
    assert [got[k]["n_passages"] for k in range(4)] == [1, 1, 0, 0]
    for k, text in enumerate(texts):
        assert got[k]["text"] == text
        assert (passage in got[k]["text_without_passages"]) is False
        assert got[k]["n_passage_bytes"] == len(text) - len(got[k]["text_without_passages"])
    assert got[0]["n_passage_bytes"] >= len(passage) and got[2]["text_without_passages"] == own[4]


def test_difference_cover_meets_every_offset():
    for width in (400, 200, 146, 60, 26, 9):
        period, cover = suffixes.difference_cover(width)
        assert {(a - b) % period for a in cover.tolist() for b in cover.tolist()} == set(range(period))
        assert width - period + 1 >= width / 2


def test_op3_on_a_table_equals_brute_force(spark, sf):
    import hashlib

    rows = spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").collect()
    want = {r["doc_id"]: (w[1], w[2], hashlib.sha256(w[3]).hexdigest()) for r, w in zip(rows, kept_bytes([r["text"] for r in rows], 400), strict=True)}
    got = {r["doc_id"]: (r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in queries.QUERIES["op3_suffix_array_dedup"](spark, sf).collect()}
    assert got == want


# ------------------------------------------------------------- exact search
@pytest.mark.parametrize("shard,block", [(8192, 512), (40, 7)])
def test_top_k_equals_brute_force_with_ties_and_odd_vectors(spark, shard, block):
    rng = random.Random(4)
    vectors = [[rng.choice([-0.5, 0.01, 0.25, 0.7]) for _ in range(6)] for _ in range(300)]
    rows = [(i, v) for i, v in enumerate(vectors)] + [(500, None), (520, []), (540, [float("nan")] * 6), (560, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (None, [1.0] * 6), (580, [2.0, 3.0]), (581, [1e6, -1e6])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").withColumn("rank", F.lit(1))
    got = {}
    for r in topk.top_k(df, F.col("vec_id") % 20 == 0, shard_rows=shard, block_rows=block).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    x = np.floor(64 * np.array(vectors, np.float32).astype(float)).astype(int)
    for q in range(0, 300, 20):
        s = x @ x[q]
        assert got.pop(q) == [(i, int(s[i])) for i in sorted((i for i in range(300) if i != q), key=lambda i: (-s[i], i))[:20]]
    assert got == {580: [(581, 128 * 64_000_000 - 192 * 64_000_000)]}
    assert topk.top_k(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0


# ------------------------------------------------------------- models
def test_language_and_toxicity_on_held_out_documents(spark, sf):
    table = sf.replace("sf0.001", "sf0.01")
    docs = spark.read.parquet(f"{table}/documents.parquet").select("doc_id", "lang")
    found = queries.QUERIES["op1_language_id"](spark, table).join(docs, "doc_id").collect()
    apart = [r for r in found if r["held_out"]]
    assert len(found) == docs.count() and all(0 <= r["score"] <= 1 for r in found)
    assert sum(r["lang"] == r["lang_pred"] for r in apart) / len(apart) > 0.95
    labels = spark.read.parquet(f"{table}/labels.parquet")
    scored = queries.QUERIES["op10_toxicity"](spark, table).join(labels, "doc_id").where("held_out").collect()
    clean = [r for r in scored if r["toxic"] == 0]
    toxic = [r for r in scored if r["toxic"] == 1]
    assert sum(r["predicted"] for r in clean) / len(clean) < 0.03
    assert np.mean([r["score"] for r in toxic]) > np.mean([r["score"] for r in clean]) + 0.2


def test_models_on_odd_and_missing_input(docs_of, spark):
    docs = docs_of([None, "", "123 !!", "Hello there my friend", "Hello there my friend", "x" * 200_000])
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in langid.languages(docs, F.lit(True), keep=("doc_id", "kept")).collect()}
    assert got[0] == got[1] == got[2] == ("und", 0.0) and got[3][0] == "en" and got[3] == got[4]
    assert {r["lang_pred"] for r in langid.languages(docs, F.lit(False)).collect()} == {"und"}
    none = spark.createDataFrame([], "doc_id bigint, toxic int")
    scored = toxicity.toxicity(docs_of([None, "you idiot, you moron", "a fine day", "IDIOT"]), none, F.lit(True)).orderBy("doc_id").collect()
    assert [r["predicted"] for r in scored] == [0, 1, 0, 1]
    assert toxicity.toxicity(docs.limit(0), none, F.lit(True)).count() == 0 and langid.languages(docs.limit(0), F.lit(True)).count() == 0


def test_label_model_finds_good_voters_and_discounts_copies():
    rng = np.random.default_rng(3)
    y = rng.random(4000) < 0.1
    votes = np.stack([rng.random(4000) < np.where(y, 0.8, 0.02) for _ in range(4)] + [rng.random(4000) < 0.1], 1).astype(float)
    votes = np.concatenate([votes, votes[:, :1]], 1)
    post, found = toxicity.label_model(votes, np.ones(4000))
    assert ((post > 0.5) == y).mean() > 0.98
    assert found["speaks"][1][:4].min() > 0.6 > 0.3 > found["speaks"][1][4]
    assert found["weight"][0] < found["weight"][1]


def plain_ftrl(rows, labels, n_labels, epochs):
    """The same learner, a weight at a time."""
    z, n = {}, {}

    def weight(key):
        a, b = z.get(key, 0.0), n.get(key, 0.0)
        return 0.0 if abs(a) <= langid.L1 else -(a - np.sign(a) * langid.L1) / ((langid.BETA + b**0.5) / langid.ALPHA + langid.L2)

    order = np.random.default_rng(7)
    for _ in range(epochs):
        for k in order.permutation(len(rows)).tolist():
            x = {**dict(zip(*[c.tolist() for c in rows[k]], strict=True)), langid.DIMENSIONS: 1.0}
            w = {(i, c): weight((i, c)) for i in x for c in range(n_labels)}
            s = [sum(v * w[i, c] for i, v in x.items()) for c in range(n_labels)]
            p = [np.exp(a - max(s)) for a in s]
            p = [a / sum(p) for a in p]
            for i, v in x.items():
                for c in range(n_labels):
                    g = v * (p[c] - (c == labels[k]))
                    was = n.get((i, c), 0.0)
                    z[i, c] = z.get((i, c), 0.0) + g - ((was + g * g) ** 0.5 - was**0.5) / langid.ALPHA * w[i, c]
                    n[i, c] = was + g * g
    return {key: weight(key) for key in z}


def test_language_scores_equal_a_plain_learner(docs_of):
    rng = random.Random(4)
    words = {"en": "the and of to with this that".split(), "de": "der die und nicht mit das ein".split(), "fr": "le la et de que pour avec".split()}
    langs = [rng.choice(["en", "de", "fr"]) for _ in range(60)]
    texts = [" ".join(rng.choices(words[x], k=12)) for x in langs]
    docs = docs_of(texts).drop("lang").join(docs_of(texts).sparkSession.createDataFrame(list(enumerate(langs)), "doc_id bigint, lang string"), "doc_id")
    model = langid.learn(docs, per_language=10_000)
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in langid.identify(docs, model).collect()}
    # Document frequencies, TF-IDF, the learner and the temperature again, from the n-gram counts alone.
    counts = [dict(zip(i.tolist(), c.tolist(), strict=True)) for i, c in langid.ngram_counts(texts)]
    df = {}
    for c in counts:
        for i in c:
            df[i] = df.get(i, 0) + 1
    vectors = []
    for c in counts:
        x = {i: np.log1p(k) * (np.log((1 + len(texts)) / (1 + df[i])) + 1) for i, k in c.items()}
        size = sum(v * v for v in x.values()) ** 0.5
        vectors.append((np.array(list(x)), np.array([v / size for v in x.values()])))
    spots = {r["doc_id"]: r["s"] for r in docs.select("doc_id", F.xxhash64(F.col("doc_id").cast("string"), "text", F.lit("sample")).alias("s")).collect()}
    order = sorted(dict.fromkeys(range(60)), key=lambda k: spots[k])
    names = sorted(set(langs))
    apart = {k: (spots[k] >> 20) % 5 == 0 for k in order}
    train, test = [k for k in order if not apart[k]], [k for k in order if apart[k]]
    w = plain_ftrl([vectors[k] for k in train], [names.index(langs[k]) for k in train], len(names), langid.EPOCHS)
    score = lambda k: np.array([sum(v * w.get((i, c), 0.0) for i, v in zip(*[a.tolist() for a in vectors[k]], strict=True)) + w.get((langid.DIMENSIONS, c), 0.0) for c in range(len(names))])
    heat = langid.temperature(np.array([score(k) for k in test]), np.array([names.index(langs[k]) for k in test]))
    assert heat == pytest.approx(model["temperature"])
    for k in range(60):
        p = np.exp(score(k) / heat - (score(k) / heat).max())
        p /= p.sum()
        assert got[k] == (names[int(p.argmax())], pytest.approx(p.max(), abs=1e-4))


def test_toxicity_scores_equal_a_plain_learner(docs_of, spark):
    rng = random.Random(6)
    bad, fine = ["grobian", "lumpenhund", "wicht", "idiot"], [a + b + c for a in "bdfg" for b in "aeiou" for c in "lm"]
    toxic = [int(rng.random() < 0.3) for _ in range(120)]
    texts = [" ".join(rng.choices(fine, k=15) + (rng.sample(bad, 2) if t else [])) + (" !!!" if t and rng.random() < 0.5 else "") for t in toxic]
    docs, labels = docs_of(texts), spark.createDataFrame(list(enumerate(toxic)), "doc_id bigint, toxic int")
    got = {r["doc_id"]: r["score"] for r in toxicity.toxicity(docs, labels, F.lit(True)).collect()}
    # Terms as words, beginnings and patterns; significance, votes, label model and regression in plain loops.
    sets = []
    for t in texts:
        w = re.findall("[a-z\x80-\xff]+", t.lower())
        sets.append({("w", x) for x in w} | {("4", x[:4]) for x in w if len(x) > 4} | {("5", x[:5]) for x in w if len(x) > 5} | ({("p", 0)} if "!!!" in t else set()))
    alike = [(frozenset(s), t) for s, t in zip(sets, toxic)]
    n1, n = sum(t for _, t in set(alike)), len(set(alike))
    every, seeds = sorted(set().union(*sets), key=str), {("w", s) for s in toxicity.SEEDS}
    chosen = []
    for term in every:
        c1, c = sum(t for s, t in set(alike) if term in s), sum(term in s for s, _ in set(alike))
        rate, e = c1 / c, n1 / n
        kl = (rate * np.log(rate / e) if rate else 0) + ((1 - rate) * np.log((1 - rate) / (1 - e)) if rate < 1 else 0)
        if term in seeds or (rate > e and c1 >= toxicity.LEAST_DOCUMENTS and c * kl > np.log(len(every))):
            chosen.append((term, (c1 + 0.5) / (c - c1 + 0.5)))
    rows = [[k for k, (term, _) in enumerate(chosen) if term in s] for s in sets]
    codes = {term: h for (term, _), h in zip(chosen, [_term_hash(term) for term, _ in chosen])}
    order = sorted(range(len(chosen)), key=lambda k: codes[chosen[k][0]])
    place = {k: i for i, k in enumerate(order)}
    kind = np.array(["w45p".index(chosen[k][0][0]) for k in order])
    votes = toxicity.votes_of([np.array(sorted(place[k] for k in r), np.int64) for r in rows], kind, np.array([chosen[k][1] for k in order]), np.array([chosen[k][0] in seeds for k in order]), np.array(toxic))
    keep = [alike.index(x) == i for i, x in enumerate(alike)]  # texts of the same terms teach once
    post, _ = toxicity.label_model(votes[keep], np.ones(sum(keep)), annotator=votes.shape[1] - 1)
    w, b, w2, b2 = np.zeros(len(order)), 0.0, np.zeros(len(order)), 0.0
    x = np.zeros((len(texts), len(order)))
    for i, r in enumerate(rows):
        x[i, [place[k] for k in r]] = 1
    x0, target = x[keep], np.clip(post, 0.001, 0.999)
    b = np.log(target.mean() / (1 - target.mean()))
    for _ in range(300):
        e = 1 / (1 + np.exp(-(b + x0 @ w))) - target
        g = (x0.T @ e + w) / np.maximum(x0.sum(0), 1e-9)
        w2, b2 = w2 + g**2, b2 + e.mean() ** 2
        w, b = w - 0.5 * g / np.sqrt(w2 + 1e-8), b - 0.5 * e.mean() / np.sqrt(b2 + 1e-8)
    w = np.array([max(v, 1.0) if chosen[k][0] in seeds else max(v, 0.0) for v, k in zip(w, order, strict=True)])
    assert {i: pytest.approx(1 / (1 + np.exp(-(b + x[i] @ w))), abs=1e-6) for i in range(len(texts))} == got
    assert all((got[i] >= 0.3) == bool(t) for i, t in enumerate(toxic))


def _term_hash(term):
    kind, text = term
    if kind == "p":
        return int(toxicity.PATTERN_TERMS[text])
    h, k = next(toxicity.terms([text.encode() if kind == "w" else text.encode() + b"x"]))
    return int(h[k == "w45".index(kind)][0])


def test_held_out_toxic_documents_are_found(spark):
    sf = "/root/testdata/sf0.1"
    if not os.path.isdir(sf):
        pytest.skip("driver tables are absent")
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = [r for r in queries.QUERIES["op10_toxicity"](spark, sf).where("held_out").collect() if labels.get(r["doc_id"]) is not None]
    hits = sum(r["predicted"] for r in rows if labels[r["doc_id"]])
    false = sum(r["predicted"] for r in rows if not labels[r["doc_id"]])
    assert hits >= 90 and false <= 5, (hits, false, len(rows))


def test_one_id_on_many_rows_does_not_swell_the_samples(docs_of, spark):
    texts = [f"the text number {k} of many and more" for k in range(900)]
    docs = docs_of(texts, ids=[5] * 900)
    labels = spark.createDataFrame([(5, 1), (6, 0)], "doc_id bigint, toxic int")
    docs = docs.unionByName(docs_of(["a fine day"], ids=[6]))
    model = toxicity.learn(docs, labels, per_class=20)
    assert model["terms"] is not None
    assert len({r["lang_pred"] for r in langid.languages(docs, F.lit(True), per_language=20).collect()}) == 1


# ------------------------------------------------------------- pipeline
def test_stages_hand_on_the_columns_of_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "minhash_near_dedup", "suffix_array_dedup", "secret_scan", "best_fit_packing"]
    for name, step in corpus_pipeline.STAGES[:-1]:
        before = {r["doc_id"]: r["text"] for r in docs.collect()}
        docs = common.stage(step(spark, docs, sf), name)
        after = {r["doc_id"]: r["text"] for r in docs.collect()}
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"] and set(after) <= set(before)
        if name == "minhash_near_dedup":
            ids = sorted(before)
            roots = components_of([before[i] for i in ids])
            assert set(after) == {ids[i] for i, (_, root) in roots.items() if root == i}
        if name == "suffix_array_dedup":
            ids = sorted(before)
            for i, (_, _, _, kept) in zip(ids, kept_bytes([before[i] for i in ids], corpus_pipeline.PASSAGE_BYTES), strict=True):
                assert after[i] == kept.decode("utf-8", "ignore")
        if name == "secret_scan":
            assert not any(re.search(r'token = "[0-9a-f]{40}"', t) for t in after.values())
            assert all(after[i] == t for i, t in before.items() if not re.search("[0-9a-f]{24}|AKIA|token|secret|passw|api_?key", t, re.I))
    whole = corpus_pipeline.run(spark, sf).collect()
    assert {r["doc_id"] for r in whole} == set(after)
    assert sum(r["length"] for r in whole) == sum(len(packing.codec(packing.DEFAULT_VOCABULARY).encode(t)) // 4 + 1 for t in after.values())


def test_stages_take_clashing_columns_nulls_repeats_and_empty_tables(docs_of, spark, sf):
    text = " ".join(f"the w{i} of" for i in range(60))
    docs = docs_of([text, text, None, "", text + " and more of it", 'the token = "0123456789abcdef01234567" ' + " ".join(f"of v{i}" for i in range(60))], ids=[3, 3, 4, None, 9, 10])
    for name, step in corpus_pipeline.STAGES:
        docs_in = docs if name != "minhash_near_dedup" else docs.where("text IS NOT NULL")
        out = step(spark, docs_in, sf)
        if name != "best_fit_packing":
            assert out.columns == docs.columns
        assert out.count() >= 1
        assert step(spark, docs.limit(0), sf).count() == 0
    left = corpus_pipeline.near_dedup(spark, docs, sf).collect()
    assert sorted((r["doc_id"] or -1) for r in left) == [-1, 3, 4, 10]


def test_near_dedup_drops_rows_and_not_ids(docs_of, spark, sf):
    a, b, c = (" ".join(sentences(k, 30)) for k in (11, 12, 13))
    rows = [(5, a), (5, b), (3, b + " end"), (None, c), (7, c + " end"), (8, "x y"), (8, "x y"), (None, ""), (None, "")]
    docs = docs_of([t for _, t in rows], ids=[i for i, _ in rows])
    left = sorted(((r["doc_id"] or -1), r["text"]) for r in corpus_pipeline.near_dedup(spark, docs, sf).collect())
    assert left == sorted([(5, a), (3, b + " end"), (7, c + " end"), (8, "x y"), (-1, ""), (-1, "")])
    nulls = docs_of([c, c + " end", a], ids=[None, None, None])
    assert corpus_pipeline.near_dedup(spark, nulls, sf).count() == 2
