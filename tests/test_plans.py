"""Plan helpers against brute force, with limits small enough to take every path."""

import random
import statistics

import pytest

from umbra.operators import features as Ft
from umbra.operators.context import neighbours_by_distance, neighbours_by_gene
from umbra.operators.design import with_design
from umbra.operators.models import bh_adjust
from umbra.plans import joins as J
from umbra.plans import order as O
from pyspark.sql import functions as F


@pytest.fixture(scope="module")
def groups(spark):
    rng = random.Random(3)
    rows = [(k, rng.choice([rng.random(), 0.25, rng.lognormvariate(0, 4)]), i)
            for k, n in (("hot", 1500), ("warm", 60), ("cold", 7)) for i in range(n)]
    return rows, spark.createDataFrame(rows, "k string, v double, i int").repartition(3)


@pytest.mark.parametrize("limit,splits", [(10_000, 10), (100, 7), (20, 50)])
def test_exact_median(groups, limit, splits):
    rows, df = groups
    got = {r["k"]: r["m"] for r in O.exact_median(df, ["k"], "v", "m", limit, splits).collect()}
    assert got == {k: pytest.approx(statistics.median(r[1] for r in rows if r[0] == k)) for k in got}
    assert len(got) == 3


def test_exact_median_writes_no_rows_of_a_large_group(groups, monkeypatch):
    rows, df = groups
    written = []
    monkeypatch.setattr(O, "cut_lineage", lambda d, name="stage", f=O.cut_lineage: written.append(out := f(d, name)) or out)
    O.exact_median(df, ["k"], "v", "m", 20, 50).collect()
    assert sum(w.count() for w in written) <= 6  # keys, marks and medians of two groups


@pytest.mark.parametrize("low,high", [(-2.0, -1.0), (1e9, 2e9), (0.25, 0.25)])
def test_exact_median_outside_of_its_sketch(groups, monkeypatch, low, high):
    rows, df = groups
    monkeypatch.setattr(O.F, "percentile_approx", lambda *a: F.min(F.array(F.lit(low), F.lit(high))))
    got = {r["k"]: r["m"] for r in O.exact_median(df, ["k"], "v", "m", 20, 50).collect()}
    assert got == {k: pytest.approx(statistics.median(r[1] for r in rows if r[0] == k)) for k in ("hot", "warm", "cold")}


@pytest.mark.parametrize("limit", [10_000, 50])
def test_row_numbers_and_suffix_minimum(groups, limit):
    rows, df = groups
    got = O.row_numbers(df, ["k"], ["v", "i"], "rn", limit, 20).where("k = 'hot'").orderBy("rn").collect()
    want = sorted((r for r in rows if r[0] == "hot"), key=lambda r: (r[1], r[2]))
    assert [(r["v"], r["i"], r["rn"]) for r in got] == [(r[1], r[2], n) for n, r in enumerate(want, 1)]
    low = {r["i"]: r["m"] for r in O.suffix_minimum(df, ["k"], "v", "i", "m", limit, 20).where("k = 'hot'").collect()}
    best, expected = 10**9, {}
    by_value = {}
    for r in want:
        by_value.setdefault(r[1], []).append(r[2])
    for v in sorted(by_value, reverse=True):
        best = min(best, *by_value[v])
        expected.update({i: best for i in by_value[v]})
    assert low == expected


@pytest.mark.parametrize("limit", [10_000, 50])
def test_bh_adjust(spark, limit):
    rng = random.Random(5)
    ps = [round(rng.random() ** 3, 3) for _ in range(400)]
    df = spark.createDataFrame([(i, "c", p) for i, p in enumerate(ps)], "protein_id int, contrast string, p_value double")
    order = sorted(range(400), key=lambda i: ps[i])
    want, low = {}, 1.0
    for rank in range(400, 0, -1):
        low = min(low, ps[order[rank - 1]] * 400 / rank)
        want[order[rank - 1]] = low
    got = {r["protein_id"]: r["q_value"] for r in bh_adjust(df, limit=limit, splits=20).collect()}
    assert got == {i: pytest.approx(q) for i, q in want.items()}


def test_bh_with_ninety_percent_ties(spark):
    ps = [0.001 * i for i in range(1, 41)] + [1.0] * 360
    df = spark.createDataFrame([(i, "c", p) for i, p in enumerate(ps)] + [(400, "c", None)], "protein_id int, contrast string, p_value double")
    for limit in (10_000, 15):
        got = {r["protein_id"]: r["q_value"] for r in bh_adjust(df, limit=limit, splits=10).collect()}
        assert got == {**{i: pytest.approx(0.4) for i in range(40)}, **{i: 1.0 for i in range(40, 400)}, 400: None}


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_lookup_join_with_hot_keys_equals_a_plain_join(spark, how):
    big = spark.createDataFrame([("hot", i) for i in range(500)] + [("a", 1), ("b", 2), (None, 3)], "k string, i int")
    small = spark.createDataFrame([("hot", 10), ("a", 11), ("z", 12)], "k string, x int")
    want = sorted(map(str, big.join(small, ["k"], how).collect()))
    assert sorted(map(str, J.lookup_join(big, small, ["k"], how).collect())) == want


def test_rows_without_a_key_are_spread_and_a_chain_reads_each_source_once(spark, tmp_path):
    spark.range(20_000).selectExpr("id", "CAST(NULL AS STRING) AS k").write.parquet(str(tmp_path / "big"))
    big = spark.read.parquet(str(tmp_path / "big"))
    small = spark.createDataFrame([("a", 1)], "k string, x int")
    old = {c: spark.conf.get(c) for c in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        for c, v in (("spark.sql.autoBroadcastJoinThreshold", "-1"), ("spark.sql.adaptive.enabled", "false")):
            spark.conf.set(c, v)
        sizes = J.lookup_join(big, small, ["k"]).groupBy(F.spark_partition_id()).count().collect()
        assert len(sizes) == 4 and max(r["count"] for r in sizes) < 8_000
        out = big
        for i in range(3):
            out = J.lookup_join(out, small.withColumnRenamed("x", f"x{i}"), ["k"])
        plan = out._sc._jvm.PythonSQLUtils.explainString(out._jdf.queryExecution(), "simple")
        assert plan.count("FileScan parquet") == 1
    finally:
        for c, v in old.items():
            spark.conf.set(c, v)


def test_duplicate_right_keys_are_refused(spark):
    df = spark.createDataFrame([("a",), ("a",)], "k string")
    with pytest.raises(ValueError, match="duplicate key"):
        J.assert_unique(df, ["k"], "side")


@pytest.mark.parametrize("limit", [10_000, 40])
def test_neighbourhood_blocks_equal_one_window(spark, limit):
    rng = random.Random(8)
    genes = [("c1", rng.randint(0, 5000), f"g{i}", rng.random() < 0.3) for i in range(300)]
    df = spark.createDataFrame(genes, "contig string, start long, protein_id string, flag boolean")
    ordered = sorted(genes, key=lambda g: (g[1], g[2]))
    want = {g[2]: sum(x[3] for x in ordered[max(0, i - 3): i + 4]) for i, g in enumerate(ordered)}
    got = neighbours_by_gene(df, 3, {"n": F.count_if("flag")}, limit=limit, block=25).collect()
    assert {r["protein_id"]: r["n"] for r in got} == want
    near = neighbours_by_distance(df, 40, {"n": F.count_if("flag")}, limit=limit, block=200).collect()
    assert {r["protein_id"]: r["n"] for r in near} == {
        g[2]: sum(x[3] for x in genes if abs(x[1] - g[1]) <= 40) for g in genes}


def test_large_protein_polish_equals_the_small_one(spark):
    rng = random.Random(4)
    rows = [("P", f"f{f}", f"s{s}", 2.0 ** (rng.random() * 3 + s)) for f in range(6) for s in range(4)
            if rng.random() < 0.9]
    df = spark.createDataFrame(rows, "protein_id string, feature_id string, sample string, value double")
    small = {r["sample"]: r["value"] for r in Ft.rollup_median_polish(df, iterations=3).collect()}
    large = {r["sample"]: r["value"] for r in Ft.rollup_median_polish(df, iterations=3, cell_limit=5).collect()}
    assert small == {s: pytest.approx(v) for s, v in large.items()}
    assert sum(small.values()) == pytest.approx(sum(r[3] for r in rows))


def test_the_shipped_archive_holds_the_packages():
    import io
    import os
    import zipfile

    from umbra.plans.shipping import archive

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    names = zipfile.ZipFile(io.BytesIO(archive(root, ("umbra", "bindings", "absent")))).namelist()
    assert {"umbra/__init__.py", "umbra/plans/joins.py", "bindings/registry.py"} <= set(names)
    assert all(n.endswith(".py") for n in names)


def test_values_are_not_dealt_by_sample(spark):
    values = spark.createDataFrame([(i, f"s{i % 2}", 1.0) for i in range(20)], "protein_id int, sample string, value double")
    design = values.select("sample", F.col("sample").alias("group")).distinct()  # of no size known beforehand
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = with_design(values, design, ["group"])
        assert "SortMergeJoin" not in out._jdf.queryExecution().executedPlan().toString() and out.count() == 20
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)
