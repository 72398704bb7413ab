"""Taxonomy, organism factors and models: planted effects and brute force."""

import math
import random

import numpy as np
import pytest
from makers import put
from pyspark.sql import functions as F

from umbra.errors import InputError, OptionError
from umbra.functions import stats as S
from umbra.operators import models as M
from umbra.operators import organisms as O
from umbra.operators import taxonomy as Tx
from umbra.operators.bins import BINS, invisibility_rates, ko_less_coverage, retention_by_bin
from umbra.operators.filters import sample_median_shift
from umbra.operators.isobaric import plex_exposure
from umbra.operators.tables import candidate_shortlist, group_conflicts, shortlist_population
from umbra.sources import taxonomy as N

# taxid -> (parent, rank): two phyla; the first has a genus right under a class, and three species
TREE = {
    "1": ("1", "no rank"), "30": ("1", "superkingdom"),
    "310": ("30", "phylum"), "311": ("310", "class"), "312": ("311", "genus"),
    "3121": ("312", "species"), "3122": ("312", "species"), "3123": ("312", "species"),
    "320": ("30", "phylum"), "321": ("320", "no rank"), "325": ("321", "order"), "327": ("325", "genus"),
    "3271": ("327", "species"),
}
# 41 became 42, and that 3121; 49 is gone
MERGED, DELETED = {"42": "3121", "41": "42"}, ["49"]


@pytest.fixture(scope="module")
def dump(spark, tmp_path_factory):
    d = tmp_path_factory.mktemp("dump")
    put(d / "nodes.dmp", "".join(f"{t}\t|\t{p}\t|\t{r}\t|\n" for t, (p, r) in TREE.items()))
    put(d / "names.dmp", "".join(f"{t}\t|\ttaxon{t}\t|\t\t|\tscientific name\t|\n{t}\t|\told\t|\t\t|\tsynonym\t|\n" for t in TREE))
    put(d / "merged.dmp", "".join(f"{a}\t|\t{b}\t|\n" for a, b in MERGED.items()))
    put(d / "delnodes.dmp", "".join(f"{t}\t|\n" for t in DELETED))
    return N.read_taxdump(spark, str(d))


def test_taxdump_lineages_merged_and_deleted(spark, dump):
    assert dump["names"].count() == len(TREE)
    ids = spark.createDataFrame([(t,) for t in ("42", "41", "49", "3271", "404")], "taxid string")
    got = {r["taxid"]: r for r in Tx.lineage_of(ids, dump).collect()}
    assert got["42"]["current"] == got["41"]["current"] == "3121" and got["42"]["genus"] == "312"
    assert got["49"]["current"] is None and got["49"]["genus"] is None
    assert got["404"]["current"] is None
    assert (got["3271"]["domain"], got["3271"]["order"], got["3271"]["species"]) == ("30", "325", "3271")


def test_rank_collapse(spark, dump):
    taxa = spark.createDataFrame([("P1", "3121"), ("P2", "3122"), ("P3", "3271")], "protein_id string, taxid string")
    lin = Tx.lineages(dump["nodes"])
    got = {r["protein_id"]: r["taxid"] for r in Tx.collapse_taxon_rank(taxa, "genus", lin).collect()}
    assert got == {"P1": "312", "P2": "312", "P3": "327"}
    assert Tx.collapse_taxon_rank(taxa, "", None) is taxa
    with pytest.raises(OptionError, match="taxonomy dump"):
        Tx.collapse_taxon_rank(taxa, "genus", None)


def test_a_cycle_in_the_tree_is_reported(spark):
    nodes = spark.createDataFrame([("a", "b", "genus"), ("b", "a", "genus")], "taxid string, parent string, rank string")
    with pytest.raises(InputError, match="cycle"):
        Tx.lineages(nodes, max_depth=8)


def test_a_chain_of_300_merges_and_a_cycle(spark, dump):
    chain = [(f"m{i}", f"m{i + 1}") for i in range(299)] + [("m299", "3121")]
    merged = spark.createDataFrame(chain, "taxid string, successor string")
    ids = spark.createDataFrame([("m0",), ("m150",)], "taxid string")
    assert {r["current"] for r in Tx.current_taxids(ids, dump["nodes"], merged).collect()} == {"3121"}
    ring = spark.createDataFrame([("u", "v"), ("v", "w"), ("w", "u")], "taxid string, successor string")
    with pytest.raises(InputError, match="cycle"):
        Tx.current_taxids(ids, dump["nodes"], ring)


@pytest.mark.parametrize("peptides,want", [
    ([{"genus": "312", "species": "3121"}] * 2 + [{"genus": "312", "species": "3122"}] * 2, ("312", "genus", 1.0, 4)),
    ([{"domain": "30"}] + [{"domain": "30", "genus": "312", "species": "3121"}] * 2, ("3121", "species", 1.0, 3)),
    # a gap in the lineage does not end it
    ([{"domain": "30", "species": "3121"}] * 2, ("3121", "species", 1.0, 2)),
    ([{"genus": "312"}], (None, None, None, 1)),
])
def test_consensus(spark, peptides, want):
    schema = "protein_id string, " + ", ".join(f"{r}_id string" for r in N.RANKS)
    rows = [("P", *[p.get(r) for r in N.RANKS]) for p in peptides]
    for n in (1, 4):
        r = Tx.consensus_taxon(spark.createDataFrame(rows, schema).repartition(n)).first()
        assert (r["consensus_taxid"], r["consensus_rank"], r["fraction"], r["n_peptides"]) == want


@pytest.mark.parametrize("sep,top", [(",", "domain_id"), ("\t", "superkingdom_id")])
def test_peptide_lca_files(spark, tmp_path, sep, top):
    text = sep.join(["peptide", "taxon_id", "taxon_name", "taxon_rank", top, "genus_id", "species_id"]) + "\n"
    text += sep.join(["pepK", "3121", "x", "species", "30", "312", "3121"]) + "\n"
    r = N.read_peptide_lca(spark, put(tmp_path / "l", text)).first()
    assert (r["peptide"], r["domain_id"], r["genus_id"], r["phylum_id"]) == ("PEPK", "30", "312", None)


@pytest.mark.parametrize("header,match", [
    ("peptide,taxon_name,genus", "not a pept2lca"), ("peptide,taxon_id,genus,species", "no rank taxid columns"),
    ("peptide,taxon_id,taxon_name,taxon_rank", "--all")])
def test_peptide_lca_without_ids_is_refused(spark, tmp_path, header, match):
    with pytest.raises(InputError, match=match):
        N.read_peptide_lca(spark, put(tmp_path / "l", header + "\n"))


def test_verdicts_and_effective_taxid(spark, dump):
    pairs = [("same", "3121", "3121"), ("genus", "3121", "312"), ("sister", "3121", "3122"), ("other", "3121", "3271"),
             ("above", "3121", "30"), ("noegg", None, "3121"), ("nouni", "3121", None), ("gone", "49", "3121"),
             ("merged", "42", "3121")]
    con = spark.createDataFrame([(p, u) for p, _, u in pairs], "protein_id string, consensus_taxid string")
    egg = spark.createDataFrame([(p, e) for p, e, _ in pairs] + [("alone", "3121")], "protein_id string, eggnog_taxid string")
    ids = con.select(F.col("consensus_taxid").alias("taxid")).union(egg.select("eggnog_taxid")).where("taxid IS NOT NULL")
    cmp = Tx.compare_taxonomy(con, egg, Tx.lineage_of(ids, dump))
    assert {r["protein_id"]: r["verdict"] for r in cmp.collect()} == {
        "same": "identical", "genus": "concordant", "sister": "concordant", "other": "conflict",
        "above": "concordant_above_genus", "noegg": "eggnog_missing", "nouni": "unipept_missing",
        "gone": "eggnog_unresolved", "merged": "identical"}
    bare = {r["protein_id"]: r["verdict"] for r in Tx.compare_taxonomy(con, egg, None).collect()}
    assert bare["genus"] == "differ_no_lineage" and bare["same"] == "identical"
    eff = {r["protein_id"]: r["effective_taxid"] for r in Tx.effective_taxid(egg, cmp, "concordant").collect()}
    assert eff["same"] == "3121" and eff["genus"] == "3121" and eff["other"] is None and eff["alone"] is None
    with pytest.raises(OptionError):
        Tx.effective_taxid(egg, cmp, "both")
    none = spark.createDataFrame([("ZZZ",)], "peptide string")
    feats = spark.createDataFrame([("P1", "AK")], "razor string, peptide string")
    with pytest.raises(InputError, match="no peptide"):
        Tx.peptides_without_lca(feats, none)


# ---------------------------------------------------------------- organisms
def planted(n_members=12, regulated=3, shift=1.0, effect=2.0, taxa=4, seed=7):
    """Taxon T1 doubles in the cases and three of its members change on top."""
    rng = random.Random(seed)
    rows = []
    for t in range(1, taxa + 1):
        for i in range(n_members):
            base = rng.uniform(12, 20)
            for s in range(12):
                case = s >= 6
                v = base + rng.gauss(0, 0.03)
                if t == 1 and case:
                    v += shift + (effect if i < regulated else 0.0)
                rows.append((f"T{t}", f"T{t}_{i}", f"s{s}", 2.0 ** v))
    return rows


SCHEMA = "taxid string, protein_id string, sample string, value double"


def samples(spark, n=12):
    return spark.createDataFrame([(f"s{i}", "case" if i >= n // 2 else "ctrl") for i in range(n)], "sample string, group string")


def test_size_factor_recovers_the_organism_shift_and_the_ratio_model_uses_it(spark):
    df = spark.createDataFrame(planted(), SCHEMA)
    sf = O.taxon_size_factors(df, samples(spark), 4)
    fc = {r["taxid"]: r for r in M.factor_fold_change(sf, samples(spark), "ctrl", "case").collect()}
    assert fc["T1"]["method"] == "median_of_ratios" and abs(fc["T1"]["factor_log2fc"] - 1.0) < 0.05
    assert abs(fc["T2"]["factor_log2fc"]) < 0.05
    logged = df.select("protein_id", "sample", F.log2("value").alias("value"))
    taxa = df.select("protein_id", "taxid").distinct()
    out = {r["protein_id"]: r for r in M.ratio_model(logged, taxa, sf, samples(spark)).collect()}
    for i in range(12):
        r = out[f"T1_{i}"]
        sign = -1 if r["contrast"] == "ctrl_vs_case" else 1
        assert abs(sign * r["lfc_adj"] - (2.0 if i < 3 else 0.0)) < 0.15
        assert abs(sign * r["lfc_naive"] - (3.0 if i < 3 else 1.0)) < 0.1
    summed = df.where("taxid = 'T1'").groupBy("sample").agg(F.sum("value").alias("v")).collect()
    v = {r["sample"]: math.log2(r["v"]) for r in summed}
    bias = 1.0 - (sum(v[f"s{i}"] for i in range(6, 12)) - sum(v[f"s{i}"] for i in range(6))) / 6
    assert bias < -0.15, "a plain sum is pulled by its regulated members"


def test_size_factor_fallbacks(spark):
    few = spark.createDataFrame(planted(2, 0, taxa=1), SCHEMA)
    assert {r["method"] for r in O.taxon_size_factors(few, samples(spark), 4).collect()} == {"sum_fallback"}
    rows = [r for r in planted(6, 0, taxa=1) if int(r[1][3:]) != int(r[2][1:]) % 6]
    rows = [r for r in rows if r[2] != "s0" or r[1] == "T1_1"]
    got = O.taxon_size_factors(spark.createDataFrame(rows, SCHEMA), samples(spark), 4).collect()
    assert {r["method"] for r in got} == {"median_of_ratios_poscounts"}
    assert {r["sample"] for r in got if r["factor"] is None} == {"s0"}


def test_plex_exposure(spark):
    rows = []
    for t in ("T0", "T1", "T2"):
        for i in range(10):
            for p in ("a", "b", "c"):
                if not (t == "T2" and i >= 3 and p != "c"):
                    rows.append((t, f"{t}_{i}", p, 1.0))
    df = spark.createDataFrame(rows, "taxid string, protein_id string, plex string, value double")
    assert tuple(plex_exposure(df, 4).first()) == (1, 3)
    assert tuple(plex_exposure(df.withColumn("plex", F.lit("a")), 4).first()) == (0, 0)


def test_normalisation_risk(spark):
    rows = [("risky", 1.0, i < 8, -1.2, "median_of_ratios") for i in range(10)]
    rows += [("clean", 1.0, i < 2, 1.4, "median_of_ratios") for i in range(10)]
    rows += [("still", 0.05, False, 0.02, "median_of_ratios")] * 10
    rows += [("one", 1.0, i == 0, -1.2 if i == 0 else 1.0, "median_of_ratios") for i in range(10)]
    rows += [("small", 1.0, True, -1.2, "sum_fallback")]
    df = spark.createDataFrame(rows, "taxid string, factor_log2fc double, deviates boolean, lfc double, method string")
    assert {r["taxid"]: r["assumption"] for r in O.normalisation_risk(df).collect()} == {
        "risky": "AT RISK", "clean": "ok", "still": "ok", "one": "ok", "small": "fragile (too few proteins)"}


# ---------------------------------------------------------------- models
def test_special_functions():
    assert np.allclose(S.digamma(np.array([1.0])), -0.5772156649015329)
    assert np.allclose(S.trigamma(np.array([1.0])), math.pi**2 / 6)
    assert S.trigamma_inverse(float(S.trigamma(np.array([3.3]))[0])) == pytest.approx(3.3)


def test_fits_match_least_squares_with_missing_samples_and_a_batch(spark):
    rng = random.Random(2)
    design = [(f"s{i}", "abc"[i % 3], "xy"[i // 3 % 2]) for i in range(12)]
    rows = [(f"P{p}", s, rng.gauss(0, 1)) for p in range(15) for s, _, _ in design if rng.random() < 0.8]
    v = spark.createDataFrame(rows, "protein_id string, sample string, value double")
    d = spark.createDataFrame(design, "sample string, group string, plex string")
    for terms in (("group",), ("group", "plex")):
        for r in M.fit_proteins(v, d, terms).collect():
            mine = {s: y for p, s, y in rows if p == r["protein_id"]}
            use = [x for x in design if x[0] in mine]
            cols = [[float(x[1] == g) for x in use] for g in sorted({x[1] for x in use})]
            if len(terms) > 1:
                cols += [[float(x[2] == b) for x in use] for b in sorted({x[2] for x in use})[1:]]
            X, y = np.array(cols).T, np.array([mine[x[0]] for x in use])
            beta, _, rank, _ = np.linalg.lstsq(X, y, rcond=None)
            rss = ((y - X @ beta) ** 2).sum()
            assert r["df_residual"] == len(y) - rank
            if r["df_residual"]:
                assert r["sigma2"] == pytest.approx(rss / r["df_residual"])
            levels = sorted({x[1] for x in use})
            if rank == X.shape[1]:
                inv = np.linalg.inv(X.T @ X)
                want = {}
                for i in range(len(levels)):
                    for j in range(i + 1, len(levels)):
                        c = np.zeros(X.shape[1])
                        c[j], c[i] = 1, -1
                        want[f"{levels[j]}_vs_{levels[i]}"] = (c @ beta, math.sqrt(c @ inv @ c))
                got = {c["contrast"]: (c["lfc"], c["stdev_unscaled"]) for c in r["contrasts"]}
                assert got == {k: (pytest.approx(a), pytest.approx(b)) for k, (a, b) in want.items()}


def test_a_third_factor_and_a_covariate_enter_the_model(spark):
    rng = random.Random(9)
    design = [(f"s{i}", "ab"[i % 2], "xy"[i // 2 % 2], "pqr"[i // 4 % 3], i * 0.5 - 3) for i in range(16)]
    rows = [(f"P{p}", x[0], rng.gauss(0, 1)) for p in range(4) for x in design]
    v = spark.createDataFrame(rows, "protein_id string, sample string, value double")
    d = spark.createDataFrame(design, "sample string, group string, plex string, donor string, age double")
    for r in M.fit_proteins(v, d, ("group", "plex", "donor", "age")).collect():
        y = np.array([t for p, _, t in rows if p == r["protein_id"]])
        X = np.array([[x[1] == "a", x[1] == "b", x[2] == "y", x[3] == "q", x[3] == "r", x[4]] for x in design], float)
        beta, rss, rank, _ = np.linalg.lstsq(X, y, rcond=None)
        assert r["df_residual"] == 16 - rank and r["sigma2"] == pytest.approx(rss[0] / (16 - rank))
        assert r["contrasts"][0]["lfc"] == pytest.approx(beta[1] - beta[0])
    with pytest.raises(OptionError, match="sex"):
        M.fit_proteins(v, d, ("group", "sex"))


def test_a_protein_without_residual_df_is_tested_by_the_prior(spark):
    rng = random.Random(4)
    rows = [(f"P{p}", f"s{i}", rng.gauss(0, 1)) for p in range(40) for i in range(6)] + [("two", "s0", 1.0), ("two", "s1", 3.0), ("one", "s0", 1.0)]
    v = spark.createDataFrame(rows, "protein_id string, sample string, value double")
    d = spark.createDataFrame([(f"s{i}", "ab"[i % 2]) for i in range(6)], "sample string, group string")
    fits = M.fit_proteins(v, d)
    prior = M.variance_prior(fits).first()
    got = {r["protein_id"]: r for r in M.differential_abundance(v, d).collect()}
    assert len(got) == 42
    assert got["two"]["s2_post"] == pytest.approx(prior["s2_prior"]) and got["two"]["p_value"] is not None and got["two"]["q_value"] is not None
    assert got["one"]["contrast"] is None and got["one"]["q_value"] is None


def test_planted_effects_are_found_and_moderation_shrinks(spark):
    rng = random.Random(11)
    rows = [(f"P{p}", f"s{i}", 15 + rng.gauss(0, 0.2) + (1.0 if p < 6 and i >= 6 else 0.0) + (1.6 if i % 2 else 0.0))
            for p in range(60) for i in range(12)]
    v = spark.createDataFrame(rows, "protein_id string, sample string, value double")
    d = spark.createDataFrame([(f"s{i}", "b" if i >= 6 else "a", "T1" if i % 2 else "T2") for i in range(12)],
                              "sample string, group string, plex string")
    out = M.differential_abundance(v, d, ("group", "plex")).collect()
    hits = {r["protein_id"] for r in out if r["q_value"] < 0.05}
    assert {f"P{i}" for i in range(6)} <= hits and len(hits) <= 9
    assert all(abs(r["lfc"] - 1.0) < 0.4 for r in out if int(r["protein_id"][1:]) < 6)
    prior = M.variance_prior(M.fit_proteins(v, d, ("group", "plex"))).first()
    assert prior["df_prior"] > 5 and prior["s2_prior"] == pytest.approx(0.04, rel=0.4)
    post = [r["s2_post"] for r in out]
    assert np.std(post) < np.std([r["sigma2"] for r in out])
    assert M.select_contrasts(M.differential_abundance(v, d), ["c_vs_d"]).count() == 0


def test_many_data_sets_run_as_one_job(spark):
    rng = random.Random(1)
    rows = [(ds, f"P{p}", f"s{i}", rng.gauss(0, 1)) for ds in "AB" for p in range(10) for i in range(6)]
    v = spark.createDataFrame(rows, "dataset string, protein_id string, sample string, value double")
    d = spark.createDataFrame([(ds, f"s{i}", "ab"[i % 2]) for ds in "AB" for i in range(6)],
                              "dataset string, sample string, group string")
    both = {(r["dataset"], r["protein_id"]): r["p_value"] for r in M.differential_abundance(v, d, by=["dataset"]).collect()}
    for ds in "AB":
        one = M.differential_abundance(v.where(f"dataset = '{ds}'").drop("dataset"), d.where(f"dataset = '{ds}'").drop("dataset"))
        assert {r["protein_id"]: pytest.approx(r["p_value"]) for r in one.collect()} == {
            p: x for (s, p), x in both.items() if s == ds}


def test_sample_shift_and_enrichment(spark):
    v = spark.createDataFrame([("P", "s", 1.0), ("Q", "s", 3.0), ("R", "s", 8.0)], "protein_id string, sample string, value double")
    assert sorted(r["value"] for r in sample_median_shift(v).collect()) == [-2.0, 0.0, 5.0]
    assert sample_median_shift(v, enabled=False) is v
    res = spark.createDataFrame([(f"P{i}", "b_vs_a", 0.01 if i < 5 else 0.9) for i in range(20)],
                                "protein_id string, contrast string, q_value double")
    paths = spark.createDataFrame([(f"P{i}", "m1" if i < 6 else "m2") for i in range(18)], "protein_id string, pathway string")
    got = {r["pathway"]: r for r in M.kegg_enrichment(res, paths).collect()}
    want = math.comb(6, 5) / math.comb(18, 5)
    assert got["m1"]["p_value"] == pytest.approx(want) and got["m2"]["p_value"] == pytest.approx(1.0)
    assert got["m1"]["n_background"] == 18
    assert got["m1"]["q_value"] == pytest.approx(2 * want) and got["m2"]["q_value"] == pytest.approx(1.0)


# ---------------------------------------------------------------- reports
def test_retention_gates_and_rates(spark):
    rows = [("4_dark", False, False)] * 12 + [("3p_profile_only", False, False)] * 2 + [("1_ko_pathway", True, True)] * 5
    df = spark.createDataFrame(rows, "bin string, kept boolean, tested boolean")
    assert {r["bin"]: r["verdict"] for r in retention_by_bin(df).collect()} == {
        "4_dark": "GATE", "3p_profile_only": "NOTE", "1_ko_pathway": "ok"}
    assert ko_less_coverage(df).first()["gate"]
    ann = spark.createDataFrame([(b,) for b in BINS], "bin string")
    q = spark.createDataFrame([("1_ko_pathway",), ("4_dark",), (None,)], "bin string")
    r = invisibility_rates(ann, q).first()
    assert r["pct_quantified"] == 50.0 and r["n_unbinned"] == 1 and r["ratio"] == pytest.approx(50 / (600 / 7))


def test_groups_and_shortlist(spark):
    g = spark.createDataFrame([("A;B",), ("A;C",), ("X;Y",), ("A;X",)], "group_id string")
    ann = spark.createDataFrame([("A", "1_ko_pathway", ["K1"]), ("B", "4_dark", []), ("C", "1_ko_pathway", ["K2"])],
                                "protein_id string, bin string, ko array<string>")
    got = {r["group_id"]: (r["bin_conflict"], r["ko_conflict"], r["unannotated_group"]) for r in group_conflicts(g, ann).collect()}
    assert got == {"A;B": (True, False, False), "A;C": (False, True, False), "X;Y": (False, False, True), "A;X": (False, False, False)}
    res = spark.createDataFrame([("P1", 0.01, False, True, 3), ("P2", 0.01, False, True, 9), ("P3", 0.01, True, True, 9), ("P4", 0.9, False, True, 9)],
                                "protein_id string, q_value double, has_ko boolean, surface_or_secreted boolean, export_score int")
    assert [r["protein_id"] for r in candidate_shortlist(res).collect()] == ["P2", "P1"]
    p = shortlist_population(res).first()
    assert (p["n_tested"], p["n_significant"], p["n_without_ko"], p["n_listed"]) == (4, 3, 3, 2)
