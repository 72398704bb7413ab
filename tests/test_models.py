"""Model terms and their coding, guards, tails in the JVM, and contrasts by weights."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from umbra.errors import DesignError, OptionError
from umbra.functions import tails as T
from umbra.operators import coding as C
from umbra.operators import models as M


# ---------------------------------------------------------------- tails
def tail_by_integration(t, nu):
    """The density of Student's t from t on, over u = t / sqrt(nu) = tan(angle)."""
    a = np.linspace(math.atan(t / math.sqrt(nu)), math.pi / 2, 2_000_001)
    if nu > 100:  # nearly all of it is near the start
        a = np.linspace(a[0], min(math.pi / 2, a[0] + 60 / math.sqrt(nu)), 2_000_001)
    f = np.cos(a) ** (nu - 1)
    log_c = math.lgamma(nu / 2 + 0.5) - math.lgamma(nu / 2) - 0.5 * math.log(math.pi) if nu < 1e5 else 0.5 * math.log(nu / 2 / math.pi) - 1 / (4 * nu)
    return 2 * math.exp(log_c) * float(np.trapezoid(f, a))


def test_log_gamma_and_student_tails_equal_known_values(spark):
    xs = [0.5, 1.0, 2.5, 7.0, 40.0, 1e4]
    got = spark.createDataFrame([(x,) for x in xs], "x double").select("x", T.log_gamma(F.col("x")).alias("g"), T.log_gamma_half_step(F.col("x")).alias("h"))
    for r in got.collect():
        assert r["g"] == pytest.approx(math.lgamma(r["x"]), rel=1e-12, abs=1e-12)
        assert r["h"] == pytest.approx(math.lgamma(r["x"] + 0.5) - math.lgamma(r["x"]), rel=1e-9, abs=1e-12)
    rows = [(t, nu) for t in (0.0, 1e-4, 0.3, 1.0, -1.7, 2.0, 5.0, 40.0) for nu in (1.0, 2.0, 2.7, 5.0, 30.0, 400.5, 1e6)]
    odd = [(None, 3.0), (1.0, None), (1.0, 0.0), (1.0, -2.0), (float("nan"), 3.0), (1.0, float("inf")), (float("inf"), 3.0)]
    got = spark.createDataFrame(rows + odd, "t double, nu double").select("t", "nu", T.t_two_sided(F.col("t"), F.col("nu")).alias("p")).collect()
    for r in got[: len(rows)]:
        assert r["p"] == pytest.approx(tail_by_integration(abs(r["t"]), r["nu"]), rel=1e-6), r
    assert next(r["p"] for r in got if r["t"] == 2.0 and r["nu"] == 1e6) == pytest.approx(math.erfc(2 / math.sqrt(2)), rel=1e-4)
    for t in (0.3, 1.0, 5.0):  # closed forms for one and two degrees of freedom
        p = {r["nu"]: r["p"] for r in got if r["t"] == t}
        assert p[1.0] == pytest.approx(1 - 2 * math.atan(t) / math.pi, rel=1e-12)
        assert p[2.0] == pytest.approx(1 - t / math.sqrt(2 + t * t), rel=1e-12)
    assert [r["p"] for r in got[len(rows):]] == [None] * 6 + [0.0]


def test_hypergeometric_tail_equals_counting(spark):
    rng = random.Random(3)
    rows = []
    for _ in range(120):
        total = rng.randint(1, 60)
        drawn, marked = rng.randint(0, total), rng.randint(0, total)
        rows.append((rng.randint(0, total), drawn, marked, total))
    rows += [(30, 400, 500, 9000), (0, 0, 0, 5), (3, 2, 5, 9), (5, 5, 5, 5)]
    df = spark.createDataFrame(rows, "k int, n int, m int, big bigint")
    for r in df.withColumn("p", T.hypergeometric_tail(*(F.col(c) for c in ("k", "n", "m", "big")))).collect():
        want = sum(math.comb(r["m"], x) * math.comb(r["big"] - r["m"], r["n"] - x) for x in range(r["k"], min(r["n"], r["m"]) + 1)) / math.comb(r["big"], r["n"])
        assert r["p"] == pytest.approx(want, rel=1e-9, abs=1e-15), r


# ---------------------------------------------------------------- coding
@pytest.mark.parametrize("spec, terms, intercept", [
    (("group", "plex"), (("group",), ("plex",)), False),
    ("~ 0 + group", (("group",),), False),
    ("~ group + plex", (("group",), ("plex",)), True),
    ("~ 0 + group * plex", (("group",), ("plex",), ("group", "plex")), False),
    ("~0+a:b+a", (("a",), ("a", "b")), False),
    (("group", "group:age", "group"), (("group",), ("group", "age")), False),
    ("~ a*b*c", (("a",), ("b",), ("c",), ("a", "b"), ("a", "c"), ("b", "c"), ("a", "b", "c")), True),
])
def test_a_model_is_read_as_written(spec, terms, intercept):
    assert C.model_of(spec) == C.Model(terms, intercept)


def test_empty_models_are_refused():
    for bad in ((), "~ 0", "~ group + ", ("a:",)):
        with pytest.raises(OptionError):
            C.model_of(bad)


DESIGN = [(f"s{i}", "ab"[i % 2], "xyz"[i // 2 % 3], i * 0.5) for i in range(12)]
COLUMNS = "sample string, group string, plex string, age double"


@pytest.mark.parametrize("spec, names", [
    ("~ 0 + group + plex", ["groupa", "groupb", "plexy", "plexz"]),
    ("~ group + plex", [C.INTERCEPT, "groupb", "plexy", "plexz"]),
    ("~ 0 + group * plex", ["groupa", "groupb", "plexy", "plexz", "groupb:plexy", "groupb:plexz"]),
    ("~ 0 + group:plex", [f"group{g}:plex{p}" for g in "ab" for p in "xyz"]),
    ("~ 0 + group + group:plex", ["groupa", "groupb"] + [f"group{g}:plex{p}" for g in "ab" for p in "yz"]),
    ("~ 0 + group + age + group:age", ["groupa", "groupb", "age", "groupb:age"]),
    ("~ 0 + group + group:age", ["groupa", "groupb", "groupa:age", "groupb:age"]),
    ("~ age", [C.INTERCEPT, "age"]),
])
def test_codings_follow_from_the_terms_that_are_in_the_model(spark, spec, names):
    rows = C.coded_design(spark.createDataFrame(DESIGN, COLUMNS), spec).collect()
    assert all(r["names"] == names for r in rows) and len(rows) == 12
    want = {s: dict(group=g, plex=p, age=a) for s, g, p, a in DESIGN}
    for r in rows:
        for name, x in zip(names, r["x"], strict=True):
            value = 1.0
            for part in name.split(":") if name != C.INTERCEPT else []:
                value *= want[r["sample"]]["age"] if part == "age" else float(part in ("group" + want[r["sample"]]["group"], "plex" + want[r["sample"]]["plex"]))
            assert x == value


def test_interactions_equal_least_squares(spark):
    rng = random.Random(8)
    rows = [(f"P{p}", s, rng.gauss(0, 1)) for p in range(12) for s, *_ in DESIGN if rng.random() < 0.85]
    v, d = spark.createDataFrame(rows, "protein_id string, sample string, value double"), spark.createDataFrame(DESIGN, COLUMNS)
    for spec in ("~ 0 + group * plex", "~ group + plex", "~ 0 + group + age + group:age", "~ 0 + group:plex"):
        coded = {r["sample"]: r for r in C.coded_design(d, spec).collect()}
        for r in M.fit_proteins(v, d, spec).collect():
            mine = [(s, y) for p, s, y in rows if p == r["protein_id"]]
            x, y = np.array([coded[s]["x"] for s, _ in mine]), np.array([t for _, t in mine])
            beta, _, rank, _ = np.linalg.lstsq(x, y, rcond=None)
            assert r["df_residual"] == len(y) - rank
            if r["df_residual"]:
                assert r["sigma2"] == pytest.approx(((y - x @ beta) ** 2).sum() / r["df_residual"])
            if rank == x.shape[1]:
                inv = np.linalg.inv(x.T @ x)
                assert [c["estimate"] for c in r["coefficients"]] == pytest.approx(beta.tolist())
                assert [c["stdev_unscaled"] for c in r["coefficients"]] == pytest.approx(np.sqrt(np.diag(inv)).tolist())
                names = coded["s0"]["names"]
                if "groupb" in names:
                    at = names.index("groupb")
                    lfc = beta[at] - (beta[names.index("groupa")] if "groupa" in names else 0)
                    assert [(c["contrast"], c["lfc"]) for c in r["contrasts"]] == [("b_vs_a", pytest.approx(lfc))]
            else:
                assert any(c["estimate"] is None for c in r["coefficients"])


def test_contrasts_by_weights_and_their_names(spark):
    rows = [("P", s, float(i)) for i, (s, *_) in enumerate(DESIGN)]
    v, d = spark.createDataFrame(rows, "protein_id string, sample string, value double"), spark.createDataFrame(DESIGN, COLUMNS)
    weights = {"mean": {"groupa": 0.5, "groupb": 0.5}, "absent": {"groupq": 1.0}}
    out = M.differential_abundance(v, d, ("group",), weights).collect()
    assert [(r["contrast"], r["lfc"]) for r in out] == [("mean", pytest.approx(5.5))]


# ---------------------------------------------------------------- guards
def test_bad_designs_are_refused_by_name(spark):
    frame = lambda rows: spark.createDataFrame(rows, "sample string, group string, plex string")
    good = frame([(f"s{i}", "ab"[i % 2], "xy"[i // 2 % 2]) for i in range(8)])
    r = C.guard_design(good, "~ 0 + group + plex").first()
    assert (r["n_samples"], r["n_coefficients"], r["rank"], r["df_residual"], r["aliased"]) == (8, 3, 3, 5, [])
    with pytest.raises(DesignError, match="only one level: group"):
        C.guard_design(good.where("group = 'a'"), ("group",))
    with pytest.raises(DesignError, match="0 residual degrees"):
        C.guard_design(good.where("plex = 'x'").limit(2), ("group",))
    confounded = frame([(f"s{i}", "ab"[i % 2], "xy"[i % 2]) for i in range(8)])
    with pytest.raises(DesignError, match="not estimable: plexy; a plex is a batch"):
        C.guard_design(confounded, "~ 0 + group + plex")
    assert C.design_ranks(confounded, "~ group * plex").first()["aliased"] == ["plexy", "groupb:plexy"]
    single = good.where("plex = 'x'")
    with pytest.raises(DesignError, match="only one level: plex"):
        C.guard_design(single, ("group", "plex"))
    assert C.guard_design(single, ("group", "plex"), optional=("plex",)).first()["rank"] == 2


def test_ranks_of_each_data_set_are_its_own(spark):
    rows = [(ds, f"s{i}", "ab"[i % 2], "xy"[i % 2 if ds == "bad" else i // 2 % 2]) for ds in ("good", "bad") for i in range(8)]
    d = spark.createDataFrame(rows, "dataset string, sample string, group string, plex string")
    got = {r["dataset"]: (r["rank"], r["aliased"]) for r in C.design_ranks(d, "~ 0 + group + plex", ["dataset"]).collect()}
    assert got == {"good": (3, []), "bad": (2, ["plexy"])}
    with pytest.raises(DesignError, match="dataset=bad"):
        C.guard_design(d, "~ 0 + group + plex", ["dataset"])


def test_data_sets_of_different_levels_are_coded_each_by_their_own(spark):
    rng = random.Random(2)
    d = spark.createDataFrame([("A", f"s{i}", "ab"[i % 2], "x") for i in range(6)] + [("B", f"s{i}", "cde"[i % 3], "yz"[i // 3 % 2]) for i in range(12)],
                              "dataset string, sample string, group string, plex string")
    rows = [(ds, f"P{p}", f"s{i}", rng.gauss(0, 1)) for ds, n in (("A", 6), ("B", 12)) for p in range(5) for i in range(n)]
    v = spark.createDataFrame(rows, "dataset string, protein_id string, sample string, value double")
    both = M.differential_abundance(v, d, ("group", "plex"), by=["dataset"]).collect()
    for ds, names in (("A", ["b_vs_a"]), ("B", ["d_vs_c", "e_vs_c", "e_vs_d"])):
        one = M.differential_abundance(v.where(f"dataset = '{ds}'").drop("dataset"), d.where(f"dataset = '{ds}'").drop("dataset"), ("group", "plex"))
        want = {(r["protein_id"], r["contrast"]): (pytest.approx(r["lfc"]), pytest.approx(r["p_value"]), pytest.approx(r["q_value"])) for r in one.collect()}
        assert {(r["protein_id"], r["contrast"]): (r["lfc"], r["p_value"], r["q_value"]) for r in both if r["dataset"] == ds} == want
        assert {k[1] for k in want} == set(names)
