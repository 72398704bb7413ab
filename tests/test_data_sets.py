"""Every operator that takes `by` gives a data set the same rows alone and beside another."""

import random

import pytest
from pyspark.sql import functions as F

from umbra.operators import bins as B
from umbra.operators import coding as C
from umbra.operators import context as X
from umbra.operators import design as Dg
from umbra.operators import evidence as E
from umbra.operators import features as Ft
from umbra.operators import filters as Fl
from umbra.operators import isobaric as I
from umbra.operators import models as M
from umbra.operators import organisms as O
from umbra.operators import tables as Tb
from umbra.operators import taxonomy as Tx
from umbra.operators import tiers as Ti
from umbra.operators.agreement import source_agreement

KEY = ["ds"]


@pytest.fixture(scope="module")
def tables(spark):
    """Two data sets that share ids but differ in size, levels and values."""
    rng = random.Random(17)
    out = {k: [] for k in ("design", "values", "features", "feature_values", "annotation", "results", "pathways", "genes", "groups", "taxa", "hits", "pairs", "comparison")}
    for ds, n_samples, n_proteins, plexes in (("A", 8, 14, "xy"), ("B", 12, 9, "yz")):
        proteins = [f"{rng.choice(['P_', 'Q|', 'R:'])}{k:03d}" for k in range(n_proteins)]
        samples = [(f"s{i}", "ab"[i % 2], plexes[i // 2 % 2]) for i in range(n_samples)]
        out["design"] += [(ds, s, g, p, f"c{i}", i in (0, 2)) for i, (s, g, p) in enumerate(samples)]
        for k, pid in enumerate(proteins):
            taxid = "t1" if k % 3 else "t2"
            out["taxa"].append((ds, pid, taxid, f"fam{k % 4}"))
            out["annotation"].append((ds, pid, rng.choice(B.BINS), k % 2 == 0, k % 3 == 0, rng.randint(0, 9), [f"K{k % 3}"], [f"K{k % 2}"] if k % 4 else [], rng.randint(30, 300), k % 2 == 1, k % 4 == 1))
            out["results"] += [(ds, pid, c, rng.gauss(0, 1), rng.random() / 3, rng.random() / 3) for c in ("b_vs_a", "c_vs_a")]
            out["pathways"] += [(ds, pid, f"m{j}") for j in range(3) if rng.random() < 0.6]
            out["genes"].append((ds, "c1", 10 * k + rng.randint(0, 5), pid, rng.random() < 0.4, rng.random() < 0.3, rng.random() < 0.2, rng.random() < 0.3))
            out["values"] += [(ds, pid, s, taxid, p, 2 ** rng.gauss(10, 1)) for s, _, p in samples if rng.random() < 0.8]
            out["pairs"].append((ds, proteins[k // 3], pid))
            out["comparison"].append((ds, pid, rng.choice(["identical", "conflict"]), rng.choice(B.BINS)))
            out["hits"].append((ds, pid, f"title ({'VFC0001' if k % 2 else 'none'})", "vfdb", float(k)))
        out["groups"] += [(ds, ";".join(rng.sample(proteins, 2))) for _ in range(6)]
        for f in range(16):
            own = rng.sample(proteins, rng.randint(1, 3))
            out["features"].append((ds, f"f{f}", f"PEP{f}", own[0], own))
            out["feature_values"] += [(ds, f"f{f}", p, s, 2 ** rng.gauss(8, 1)) for s, _, p in samples if rng.random() < 0.7]
    columns = {
        "design": "ds string, sample string, group string, plex string, channel string, is_reference boolean",
        "values": "ds string, protein_id string, sample string, taxid string, plex string, value double",
        "features": "ds string, feature_id string, peptide string, razor string, candidates array<string>",
        "feature_values": "ds string, feature_id string, plex string, sample string, value double",
        "annotation": "ds string, protein_id string, bin string, has_ko boolean, surface_or_secreted boolean, export_score int, ko array<string>, kofam_ko array<string>, length int, kept boolean, tested boolean",
        "results": "ds string, protein_id string, contrast string, lfc double, p_value double, q_value double",
        "pathways": "ds string, protein_id string, pathway string",
        "genes": "ds string, contig string, start int, protein_id string, is_cazyme boolean, is_importer boolean, is_prophage boolean, is_immunity boolean",
        "groups": "ds string, group_id string",
        "taxa": "ds string, protein_id string, taxid string, family_id string",
        "hits": "ds string, protein_id string, description string, db string, score double",
        "pairs": "ds string, representative string, member string",
        "comparison": "ds string, protein_id string, verdict string, bin string",
    }
    return {k: spark.createDataFrame(v, columns[k]).repartition(3).cache() for k, v in out.items()}


def logged(t):
    return t["values"].selectExpr(*[c for c in t["values"].columns if c != "value"], "log2(value) AS value")


def assigned(t, by):
    return Ft.assign_features(t["features"], t["taxa"].drop("family_id"), by=by)


def one_design(t):
    return t["design"].drop("is_reference", "channel")


OPERATORS = {
    "source_agreement": lambda t, by: source_agreement(t["annotation"], by=by),
    "bin_summary": lambda t, by: B.bin_summary(t["annotation"], by),
    "invisibility_rates": lambda t, by: B.invisibility_rates(t["annotation"], t["annotation"].where("kept"), by),
    "retention_by_bin": lambda t, by: B.retention_by_bin(t["annotation"], by),
    "ko_less_coverage": lambda t, by: B.ko_less_coverage(t["annotation"], by),
    "small_protein_count": lambda t, by: B.small_protein_count(t["annotation"], by),
    "coded_design": lambda t, by: C.coded_design(t["design"], "~ 0 + group * plex", by),
    "design_ranks": lambda t, by: C.design_ranks(t["design"], "~ 0 + group + plex", by),
    "neighbour_flags": lambda t, by: X.neighbour_flags(t["genes"], window=2, max_gap=12, by=by),
    "condition_from_name": lambda t, by: Dg.condition_from_name(t["design"].selectExpr("*", "concat(`group`, '_', sample) AS s2").drop("sample", "group").withColumnRenamed("s2", "sample"), by=by),
    "stable_sample_order": lambda t, by: Dg.stable_sample_order(t["design"], by),
    "ko_rescue_summary": lambda t, by: E.ko_rescue_summary(t["annotation"].selectExpr("*", "CASE WHEN size(kofam_ko) > 0 THEN 'both' ELSE 'eggnog' END AS ko_source", "false AS ko_conflict"), by),
    "vfdb_category_rate": lambda t, by: E.vfdb_category_rate(t["hits"], by),
    "fold_group_sizes": lambda t, by: E.fold_group_sizes(t["pairs"].withColumnRenamed("representative", "family_id"), by),
    "assign_features": lambda t, by: assigned(t, by).drop("candidates"),
    "peptide_evidence": lambda t, by: Ft.peptide_evidence(assigned(t, by), by=by),
    "dominance_rate": lambda t, by: Ft.dominance_rate(Ft.peptide_evidence(assigned(t, by), by=by), by),
    "rollup_sum": lambda t, by: Ft.rollup_sum(Ft.assigned_values(t["feature_values"], assigned(t, by), by), by),
    "rollup_median_polish": lambda t, by: Ft.rollup_median_polish(Ft.assigned_values(t["feature_values"], Ft.assign_features(t["features"], t["taxa"], "razor", by=by), by), by),
    "sample_median_shift": lambda t, by: Fl.sample_median_shift(logged(t), by),
    "protein_filters": lambda t, by: Fl.protein_filters(t["values"].drop("plex"), one_design(t), 3, 2, by),
    "zero_variance": lambda t, by: Fl.zero_variance(t["values"].drop("plex").withColumn("value", F.when(F.col("protein_id").endswith("000"), 1.0).otherwise(F.col("value"))), one_design(t), by),
    "feature_min_plexes": lambda t, by: I.feature_min_plexes(t["feature_values"], 2, by),
    "channel_median_normalise": lambda t, by: I.channel_median_normalise(t["feature_values"], by=by),
    "under_corrected_channels": lambda t, by: I.under_corrected_channels(t["feature_values"], by=by),
    "reference_ratios": lambda t, by: I.reference_ratios(t["feature_values"], t["design"], by),
    "plex_exposure": lambda t, by: I.plex_exposure(t["values"], 3, by),
    "confounding_check": lambda t, by: I.confounding_check(t["design"], by),
    "fit_proteins": lambda t, by: M.fit_proteins(logged(t).drop("plex"), t["design"], "~ 0 + group * plex", by),
    "differential_abundance": lambda t, by: M.differential_abundance(logged(t).drop("plex"), t["design"], ("group", "plex"), by=by),
    "factor_changes": lambda t, by: M.factor_changes(O.taxon_size_factors(t["values"], t["design"], 3, by), t["design"], by),
    "kegg_enrichment": lambda t, by: M.kegg_enrichment(t["results"], t["pathways"], by, 0.1),
    "taxon_intensity": lambda t, by: O.taxon_intensity(t["values"], by),
    "taxon_size_factors": lambda t, by: O.taxon_size_factors(t["values"], t["design"], 3, by),
    "annotate_quant": lambda t, by: Tb.annotate_quant(t["values"].drop("taxid"), [t["taxa"]], by),
    "group_conflicts": lambda t, by: Tb.group_conflicts(t["groups"].distinct(), t["annotation"], by),
    "quant_funnel": lambda t, by: Tb.quant_funnel([Tb.Step("a", "protein", "", t["taxa"]), Tb.Step("b", "protein", "", t["annotation"])], by),
    "shortlist_population": lambda t, by: Tb.shortlist_population(t["results"].join(t["annotation"], [*by, "protein_id"]), by, 0.2),
    "verdict_counts": lambda t, by: Tx.verdict_counts(t["comparison"], by),
    "tier_coverage": lambda t, by: Ti.tier_coverage(t["annotation"].drop("kept", "tested"), {"ko": F.col("has_ko")}, by),
    "reuse_annotation": lambda t, by: Ti.reuse_annotation(t["taxa"].select(*by, "protein_id"), t["annotation"].where("kept").select(*by, "protein_id", "bin"), ["P_"], by),
}


def rows(df):
    def plain(v):
        if isinstance(v, float):
            return float(f"{v:.9g}")
        if isinstance(v, (list, tuple)):
            return tuple(plain(x) for x in v)
        if hasattr(v, "asDict"):
            return plain(list(v.asDict().values()))
        return v

    names = sorted(c for c in df.columns if c not in KEY)
    return sorted(((r["ds"] if "ds" in df.columns else None), repr([plain(r[c]) for c in names])) for r in df.collect())


@pytest.mark.parametrize("name", OPERATORS)
def test_a_data_set_is_the_same_alone_and_beside_another(tables, name):
    run = OPERATORS[name]
    together = rows(run(tables, KEY))
    assert together
    for ds in "AB":
        alone = {k: t.where(f"ds = '{ds}'").drop("ds") for k, t in tables.items()}
        assert [r for d, r in together if d == ds] == [r for _, r in rows(run(alone, []))], ds
