"""Sharding, ranked search and collocations: brute force, invariants and odd inputs."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from umbra.llm import collocations, queries, ranked, sharding

LOWER = str.maketrans(ranked.UPPER, ranked.LOWER)
TERM = re.compile(ranked.TERM)


# ------------------------------------------------------------- sharding
def draw(key, salt):
    return int(hashlib.md5(f"{key}:{salt}".encode()).hexdigest()[:13], 16)


def nearest(key, weights):
    far = [-math.log((draw(key, i) + 0.5) / 2**52) / w if w else math.inf for i, w in enumerate(weights)]
    return far.index(min(far))


ODD_DOCS = ([1, 2, None, 3, 3, 3, 7, None, 9], ["a", "", None, "same", "same", "other", "é🙂" * 5000, None, None])


@pytest.mark.parametrize("bucket_rows, chunk", [(100_000, 100_000), (2, 1)])
def test_shards_and_slots_equal_brute_force(docs_of, bucket_rows, chunk):
    ids, texts = ODD_DOCS
    ids, texts = ids + list(range(100, 260)), texts + [f"t{i}" for i in range(160)]
    rows = sharding.shard_documents(docs_of(texts, ids=ids), bucket_rows=bucket_rows, chunk=chunk).collect()
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == Counter(
        (i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in zip(ids, texts))
    slots = {}
    for r in rows:
        key = "" if r["doc_id"] is None else str(r["doc_id"])
        assert r["law"] == "key" and r["shard"] == nearest(key, [1] * 16) and r["grown_shard"] == nearest(key, [1] * 17)
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_slots_of_a_hot_record_are_gapless(spark):
    rows = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id")).alias("doc_id"), F.lit("t").alias("text"))
    got = sharding.shard_documents(rows, bucket_rows=50, chunk=7).collect()
    slots = {}
    for r in got:
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert len(got) == 3000 and all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_a_new_shard_takes_records_only_into_itself_and_weights_hold(docs_of):
    docs = docs_of(["x"] * 4000)
    rows = sharding.sharded(docs.drop("kept").withColumn("shard", F.lit("clash")), (1.0, 3.0, 0.0), (2.0,)).collect()
    assert all(r["grown_shard"] in (r["shard"], 3) for r in rows)
    shards, grown = Counter(r["shard"] for r in rows), Counter(r["grown_shard"] for r in rows)
    assert set(shards) == {0, 1} and abs(shards[1] / 4000 - 0.75) < 0.03 and abs(grown[3] / 4000 - 2 / 6) < 0.03
    for bad in ((0.0,), (1.0, -1.0), (math.inf,)):
        with pytest.raises(ValueError, match="weights"):
            sharding.sharded(docs, bad)


def test_shards_are_written_as_folders(docs_of, spark, tmp_path):
    docs = docs_of([f"text {i}" for i in range(50)])
    sharding.write_shards(docs, str(tmp_path / "out"), (1.0,) * 4)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert sorted((r["doc_id"], r["text"], r["shard"]) for r in back.collect()) == [(i, f"text {i}", nearest(str(i), [1] * 4)) for i in range(50)]


def test_sharding_of_an_empty_table(docs_of):
    assert sharding.shard_documents(docs_of(["x"]).limit(0)).count() == 0


# ------------------------------------------------------------- ranked search
def terms_of(t):
    return TERM.findall((t or "").translate(LOWER))


def ranked_by_hand(docs, items, k):
    bags = [(i, Counter(terms_of(t))) for i, t in docs]
    n, total = sum(bool(b) for _, b in bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    weight = {t: math.floor(1000 * math.log((2 * n + 2) / (2 * f + 1))) for t, f in df.items()}
    out = []
    for item, text in sorted(set(items), key=str):
        scores = []
        for i, b in bags:
            m = 75 + 25 * sum(b.values()) * n // max(1, total)
            s = sum(weight[t] * (1_000_000_000 * b[t] // (1000 * b[t] + 12 * m)) for t in terms_of(text) if t in b)
            scores.append((-s, i is not None, i, s))
        scores.sort(key=lambda x: (x[0], x[1], x[2] or 0))
        out += [(item, r, i, s) for r, (_, _, i, s) in enumerate(scores[:k], 1) if s > 0]
    return sorted(out, key=str)


@pytest.mark.parametrize("block, chunk", [(8192, 256), (7, 2)])
def test_ranked_search_equals_scoring_every_document(docs_of, spark, monkeypatch, block, chunk):
    monkeypatch.setattr(ranked, "BLOCK_DOCUMENTS", block)
    rng = random.Random(5)
    words = [f"w{i}" for i in range(60)] + ["Über", "日本", "X"]
    texts = [" ".join(rng.choices(words, k=rng.choice([3, 9, 40]), weights=[1 / (1 + i) for i in range(63)])) for _ in range(150)]
    texts += [None, "", "---", texts[0], texts[0], texts[0], "w1 " * 2000, "w1,w2;w1\x00w3 " + "é" * 3000]
    ids = [*range(150), 150, 151, 152, 9, 9, None, None, 500]
    items = [(1, "w1 w2 w2 w50"), (1, "w1 w2 w2 w50"), (2, "über W7, 日本-x"), (3, None), (4, "...!"), (5, "absent"), (6, texts[3]), (6, "w9"), (7, " ".join(words))]
    queries_ = spark.createDataFrame(items, "item_id bigint, text string").withColumn("score", F.lit("clash"))
    got = ranked.ranked(docs_of(texts, ids=ids), queries_, k=5, chunk_items=chunk).collect()
    assert sorted((tuple(r) for r in got), key=str) == ranked_by_hand(list(zip(ids, texts)), items, 5)


def test_range_maxima_and_best_first_equal_brute_force():
    rng = np.random.default_rng(2)
    n, lists = 300, []
    for size in (1, 2, 3, 17, 120, 300):
        lists.append((np.sort(rng.choice(n, size, replace=False)), rng.integers(0, 50, size)))
    postings = ranked.Postings(lists)
    dense = np.zeros((len(lists), n), np.int64)
    for t, (d, v) in enumerate(lists):
        dense[t, d] = v
        for i in range(len(d)):
            for j in range(i + 1, len(d) + 1):
                level = postings.depth[j - i]
                cells = postings.levels[t, level] + np.array([i, j - (1 << level)])
                assert postings.impacts[postings.table[cells]].max() == v[i:j].max()
    times = np.array([1, 3, 1, 2, 1, 1])
    docs, scores = ranked.best_first(postings, np.arange(len(lists)), times, n, 10)
    whole = times @ dense
    floor = np.sort(whole)[-10]
    assert sorted(docs.tolist()) == np.flatnonzero(whole >= max(1, floor)).tolist() and (whole[docs] == scores).all()


def test_long_texts_are_counted_in_stretches(monkeypatch):
    text = ("ab Cd é " * 500 + "x" * 300).encode()
    whole = Counter(ranked.term_counts(text)[0])
    monkeypatch.setattr(ranked, "TEXT_BYTES", 64)
    terms, times = ranked.term_counts(text)
    assert dict(zip(terms, times, strict=True)) == whole


def test_ranked_search_of_empty_tables(docs_of, spark):
    items = spark.createDataFrame([(1, "x")], "item_id bigint, text string")
    assert ranked.ranked(docs_of(["x"]).limit(0), items).count() == 0
    assert ranked.ranked(docs_of(["x"]), items.limit(0)).count() == 0


# ------------------------------------------------------------- collocations
def phrases_by_hand(rows, least, most, longest=5):
    counts, total = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(LOWER)):
            w = re.findall("[^ \t]+", piece)
            total[lang] += len(w)
            for k in range(1, longest + 1):
                for i in range(len(w) - k + 1):
                    counts.setdefault(lang, Counter())[tuple(w[i : i + k])] += 1
    out = []
    for lang, f in counts.items():
        often = {p: n for p, n in f.items() if n >= least}
        gone = {q for p, n in often.items() for q in (p[1:], p[:-1]) if len(q) > 1 and often[q] == n}
        found = []
        for p, a in often.items():
            if len(p) > 1 and p not in gone:
                s, k = min((1000 * a * total[lang] // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
                found.append((-s, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (s, a, p, left, right) in enumerate(sorted(found)[:most], 1):
            out.append((lang, rank, p.decode(), -a, left, right, total[lang], -s))
    return sorted(out)


def phrase_rows(seed=3, n=120):
    rng = random.Random(seed)
    words = ["the", "of", "Der", "é", "new", "york", "city", "hall", "a", "b"] + [f"r{i}" for i in range(30)]
    weights = [30, 25, 20, 8, 5, 5, 4, 4, 6, 6] + [2] * 30
    rows = []
    for i in range(n):
        w = rng.choices(words, k=rng.choice([0, 4, 30, 80]), weights=weights)
        if i % 3 == 0:
            w += ["big", "new\tYork", "city", "hall"] * 3
        rows.append((rng.choice(["en", "en", "en", "de", None]), rng.choice([" ", "  "]).join(w).replace("r7", ".").replace("r8", ",!\n")))
    return rows + [("en", None), ("en", ""), ("xx", "."), ("de", "a b " * 400), ("en", "q q q q q q q q q q"), ("und", "new york " * 8)]


@pytest.mark.parametrize("most, least, blob", [(2000, 5, 2_000_000), (7, 5, 50)])
def test_collocations_equal_brute_force(spark, monkeypatch, most, least, blob):
    monkeypatch.setattr(collocations, "BLOB_BYTES", blob)
    rows = phrase_rows()
    docs = spark.createDataFrame([(lang, t, 1, "x") for lang, t in rows], "lang string, text string, n int, phrase string")
    got = collocations.collocations(docs, most=most, least=least, shares=(0.2, 1.0)).collect()
    assert sorted(tuple(r) for r in got) == phrases_by_hand(rows, least, most)


def test_a_settled_language_leaves_its_frontier(spark, monkeypatch):
    rows = [("en", " . ".join(["x y"] * 6 + ["of the"] * 900 + ["the of it"] * 900))]
    docs = spark.createDataFrame(rows, "lang string, text string")
    passes = []
    monkeypatch.setattr(collocations, "occurrences", lambda corpus, filters, lengths, beside=False, f=collocations.occurrences: passes.append(list(lengths)) or f(corpus, filters, lengths, beside))
    got = collocations.collocations(docs, most=1, least=5, shares=(0.001, 1.0)).collect()
    assert [tuple(r) for r in got] == phrases_by_hand(rows, 5, 1) and got[0]["phrase"] == "x y"
    assert passes == [[2], [3], [2, 3, 4]]  # nothing of the frequent words is grown


def test_words_of_one_filter_value_are_listed_once(spark):
    start, seen, rng = zlib.crc32(b"en\t"), {}, random.Random(5)
    while True:  # two words of one hashed value, the first of which is rarer
        word = "".join(rng.choices("abcdefghij", k=9))
        other = seen.setdefault(zlib.crc32(word.encode(), start) % collocations.FILTER_VALUES, word)
        if other != word:
            break
    rows = [("en", " . ".join([f"{other} x"] * 6 + [f"{word} y z", f"{word} y"] * 300))]
    docs = spark.createDataFrame(rows, "lang string, text string")
    got = collocations.collocations(docs, most=50, least=5, shares=(0.001, 1.0)).collect()
    assert sorted(tuple(r) for r in got) == phrases_by_hand(rows, 5, 50)


@pytest.mark.parametrize("most", [1, 3, 9, 30])
def test_best_bounds_first_lose_no_phrase(spark, most):
    rows = phrase_rows(seed=11)
    docs = spark.createDataFrame(rows, "lang string, text string")
    got = collocations.collocations(docs, most=most, least=4, shares=(0.2, 0.6, 1.0)).collect()
    assert sorted(tuple(r) for r in got) == phrases_by_hand(rows, 4, most)


def test_collocations_of_an_empty_table_and_of_rare_words(spark):
    docs = spark.createDataFrame([("en", "a b c")], "lang string, text string")
    assert collocations.collocations(docs.limit(0)).count() == 0 and collocations.collocations(docs).count() == 0


def test_contract_columns(spark, sf):
    want = {
        "op11_rendezvous_sharding": "doc_id bigint, size bigint, text_crc32 bigint, law string, shard int, slot bigint, grown_shard int",
        "op12_ranked_search": "item_id bigint, rank int, doc_id bigint, score bigint",
        "op13_collocation_mining": "lang string, rank int, phrase string, a bigint, l bigint, r bigint, n bigint, score bigint",
    }
    for name, columns in want.items():
        assert ", ".join(" ".join(x) for x in queries.QUERIES[name](spark, sf).dtypes) == columns
