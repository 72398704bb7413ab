"""Quant readers, the shared-peptide rule, plexes and the design."""

import random

import pytest
from makers import put
from pyspark.sql import functions as F

from umbra.errors import DesignError, InputError, OptionError
from umbra.operators import design as Dg
from umbra.operators import features as Ft
from umbra.operators import filters as Fl
from umbra.operators import isobaric as I
from umbra.operators import tables as Tb
from umbra.sources import plexes as X
from umbra.sources import quant as Q
from umbra.sources import sinks as K
from umbra.sources.lines import read_lines
from umbra.sources.publish import published


def table(path, header, rows, sep="\t"):
    return put(path, "\n".join(sep.join(map(str, r)) for r in [header, *rows]) + "\n")


HEAD = ["Peptide Sequence", "Protein", "Protein ID", "Mapped Proteins"]


def peptides(path, rows, samples=("S1", "S2")):
    return table(path, HEAD + [f"{s} Intensity" for s in samples], rows)


def cells(df, key="feature_id"):
    return {(r[key], r["sample"]): r["value"] for r in df.collect()}


def test_zeros_are_missing_unless_switched_off(spark, tmp_path):
    path = peptides(tmp_path / "q.tsv", [("AK", "P1", "P1 x", "", 0, 5), ("BK", "P1", "P1 x", "", 3, 0)])
    assert cells(Q.read_fragpipe_features(spark, path).values) == {("AK", "S2"): 5.0, ("BK", "S1"): 3.0}
    kept = Q.read_fragpipe_features(spark, path, zero_missing=False)
    assert cells(kept.values)[("AK", "S1")] == 0.0
    df, names = Q.read_delimited(spark, path)
    assert Q.zero_cells(df, ["S1 Intensity", "S2 Intensity"]).first()["n_zero"] == 2


def test_razor_decoys_and_candidates(spark, tmp_path):
    path = peptides(tmp_path / "q.tsv", [
        ("AK", "P1", "P1 hypothetical", "P2;rev_P9", 1, 1), ("BK", "rev_P1", "rev_P1 x", "", 1, 1),
        ("CK", "CON__T", "CON__T", "", 1, 1)])
    f = Q.read_fragpipe_features(spark, path).features.collect()
    assert [(r["razor"], sorted(r["candidates"])) for r in f] == [("P1", ["P1", "P2"])]
    bare = table(tmp_path / "b.tsv", ["Peptide Sequence", "Protein ID", "S1 Intensity"], [("AK", "P1 long text", 1)])
    assert Q.read_fragpipe_features(spark, bare).features.first()["razor"] == "P1"


@pytest.mark.parametrize("header,fmt,match", [
    (["Index", "ReferenceIntensity", "A1"], "fragpipe", "tmt-report"),
    (["Spectrum.Name", "Purity", "Channel 126"], "msstats_csv", "msstats.csv"),
    (["Peptide Sequence", "Protein", "Intensity", "Intensity 126"], "fragpipe_peptide", "isobaric")])
def test_isobaric_files_are_refused(header, fmt, match):
    with pytest.raises(InputError, match=match):
        Q.guard_header(header, fmt, "x.tsv")
    Q.guard_header(["Peptide Sequence", "Intensity", "S1 Intensity"], "fragpipe_peptide", "x.tsv")


def test_protein_matrices_and_column_detection(spark, tmp_path):
    path = table(tmp_path / "p.tsv", ["Protein", "Is Decoy", "Protein Length", "S1 Intensity", "S2 Intensity"],
                 [("P1 d", "false", 9, 5, 0), ("P2", "true", 9, 1, 2)])
    with pytest.warns(UserWarning, match="guessed"):
        q = Q.read_protein_matrix(spark, path)
    assert cells(q.values, "group_id") == {("P1", "S1"): 5.0, ("P2", "S1"): 1.0, ("P2", "S2"): 2.0}
    assert len(cells(Q.read_protein_matrix(spark, path, columns=["S1 Intensity"]).values, "group_id")) == 2
    with pytest.raises(InputError):
        Q.read_protein_matrix(spark, path, regex="nothing")


def test_long_tables(spark, tmp_path):
    head = "ProteinName PeptideSequence PrecursorCharge FragmentIon ProductCharge Condition BioReplicate Run Intensity".split()
    path = table(tmp_path / "m.csv", head, [("P1", "AK", 2, "NA", "NA", "g1", 1, "r1", 10),
                                           ("P1", "AK", 2, "NA", "NA", "g2", 1, "r2", 20)], ",")
    q = Q.read_msstats_csv(spark, path)
    assert cells(q.values) == {("AK_2__", "r1"): 10.0, ("AK_2__", "r2"): 20.0}
    assert {r["sample"]: r["group"] for r in q.design.collect()} == {"r1": "g1", "r2": "g2"}
    head = "PROTEIN PEPTIDE FEATURE RUN GROUP_ORIGINAL SUBJECT_ORIGINAL ABUNDANCE".split()
    path = table(tmp_path / "f.tsv", head, [("P1", "AK", "AK_2", "r1", "g", "s", 3)])
    with pytest.warns(UserWarning, match="ABUNDANCE"):
        assert cells(Q.read_msstats_feature(spark, path).values) == {("AK_2", "r1"): 8.0}
    path = table(tmp_path / "l.tsv", ["Protein", "originalRUN", "GROUP_ORIGINAL", "SUBJECT_ORIGINAL", "LogIntensities"],
                 [("P1", "r1", "g", "s", 4)])
    assert cells(Q.read_msstats_protein(spark, path).values, "group_id") == {("P1", "r1"): 16.0}


def test_manifest_fractions_and_fallback_keys(spark, tmp_path):
    rows = "\n".join(f"D:\\raw\\{s}_f{f}.mzML\t{s}\t1\tDDA" for s in "AB" for f in range(4))
    m = Q.read_manifest(spark, put(tmp_path / "m", rows))
    assert sorted((r["sample"], r["n_fractions"]) for r in m.collect()) == [("A_1", 4), ("B_1", 4)]
    cols = spark.createDataFrame([("A-1",), ("B_1",), ("other",)], "column string")
    got = {r["sample"]: r["column"] for r in Q.map_samples_to_columns(m, cols).collect()}
    assert got == {"A_1": "A-1", "B_1": "B_1"}
    with pytest.raises(InputError, match="match no column"):
        Q.map_samples_to_columns(m, spark.createDataFrame([("z",)], "column string"))
    twice = spark.createDataFrame([("A_1", "A", "1", "x", "x"), ("A", "A", "", "A_1", "y")],
                                  "sample string, experiment string, bioreplicate string, basename string, file string")
    with pytest.raises(InputError, match="same quant column"):
        Q.map_samples_to_columns(twice, spark.createDataFrame([("A_1",)], "column string"))
    with pytest.raises(Exception, match="only one field"):
        Q.read_manifest(spark, put(tmp_path / "s", "/raw/my file.mzML\n")).collect()
    with pytest.raises(Exception, match="different data_type"):
        Q.read_manifest(spark, put(tmp_path / "d", "/r/a\tA\t1\tDDA\n/r/b\tA\t1\tDIA\n")).collect()


# ---------------------------------------------------------------- the rule
@pytest.fixture
def shared(spark, tmp_path):
    """Two unique features and one of each other class, all led by protein Q7."""
    path = peptides(tmp_path / "q.tsv", [
        ("AVNDLR", "Q7", "", "", 2, 3), ("WFTGHK", "Q7", "", "", 1, 1), ("EELIYPR", "Q7", "", "Q2", 4, 2),
        ("MSDCVK", "Q7", "", "Q5", 6, 8), ("GHNPTR", "Q7", "", "Q9", 10, 5)])
    q = Q.read_fragpipe_features(spark, path)
    taxa = spark.createDataFrame([("Q7", "562"), ("Q2", "562"), ("Q5", "287"), ("Q9", "")],
                                 "protein_id string, taxid string")
    fam = spark.createDataFrame([("Q7", "kinase"), ("Q2", "kinase"), ("Q5", "porin"), ("Q9", "kinase")],
                                "protein_id string, family_id string")
    return q, taxa, fam


def test_modes_classes_and_evidence(shared):
    q, taxa, fam = shared
    kept, klass = {}, {}
    for mode in Ft.MODES:
        a = Ft.assign_features(q.features, taxa, mode, fam).collect()
        kept[mode] = sum(r["assigned"] is not None for r in a)
        klass[mode] = {r["feature_id"]: r["assignment_class"] for r in a}
    assert kept == {"protein_unique": 2, "taxon_unique": 3, "taxon_or_family_unique": 4, "razor": 5}
    assert klass["taxon_unique"] == {"AVNDLR": "unique", "WFTGHK": "unique", "EELIYPR": "taxon_unique",
                                     "MSDCVK": "shared", "GHNPTR": "shared_unknown_taxon"}
    assert klass["taxon_or_family_unique"]["GHNPTR"] == "family_unique"
    assert klass["taxon_or_family_unique"]["MSDCVK"] == "shared"
    e = Ft.peptide_evidence(Ft.assign_features(q.features, taxa)).first()
    assert (e["n_unique"], e["n_taxon_unique"], e["n_features_dropped"], e["taxon_unique_dominated"]) == (2, 1, 2, False)
    e = Ft.peptide_evidence(Ft.assign_features(q.features, taxa, "razor"), "razor").first()
    assert not e["shared_dominated"]
    with pytest.raises(OptionError, match="must be one of"):
        Ft.assign_features(q.features, taxa, "razr")
    with pytest.raises(InputError):
        Ft.assign_features(q.features, taxa, "taxon_or_family_unique", None)
    with pytest.raises(InputError, match="one member"):
        Ft.assign_features(q.features, taxa, "taxon_or_family_unique", fam.where("protein_id IN ('Q7', 'Q5')"))


def test_rollups(shared):
    q, taxa, _ = shared
    rows = Ft.assigned_values(q.values, Ft.assign_features(q.features, taxa, "razor"))
    total = {r["sample"]: r["value"] for r in Ft.rollup(rows).collect()}
    assert total == {"S1": 23.0, "S2": 19.0}
    polished = {r["sample"]: r["value"] for r in Ft.rollup(rows, "median_polish").collect()}
    assert sum(polished.values()) == pytest.approx(42.0) and polished != total
    with pytest.raises(OptionError):
        Ft.rollup(rows, "medianpolish")


def test_evidence_row_survives_when_everything_is_dropped(spark, tmp_path):
    q = Q.read_fragpipe_features(spark, peptides(tmp_path / "q.tsv", [("XK", "P1", "", "P2", 1, 1)]))
    taxa = spark.createDataFrame([("P1", "562"), ("P2", "287")], "protein_id string, taxid string")
    a = Ft.assign_features(q.features, taxa)
    e = Ft.peptide_evidence(a)
    r = e.first()
    assert (r["protein_id"], r["n_features_used"], r["n_features_dropped"]) == ("P1", 0, 1)
    assert Ft.rollup(Ft.assigned_values(q.values, a)).count() == 0
    assert Ft.dominance_rate(e).count() == 0


@pytest.mark.parametrize("n_parts", [1, 4, 17])
def test_partitioning_changes_nothing(shared, n_parts):
    q, taxa, _ = shared
    a = Ft.assign_features(q.features.repartition(n_parts), taxa.repartition(n_parts), "taxon_unique")
    got = sorted(map(tuple, Ft.rollup(Ft.assigned_values(q.values.repartition(n_parts), a)).collect()))
    assert got == [("Q7", "S1", 7.0), ("Q7", "S2", 6.0)]


def test_dominance_flags_are_strict(spark):
    rows = [("own", 3, 0, 0, 1, 0), ("tie", 2, 0, 0, 2, 0), ("cross", 1, 0, 0, 3, 0), ("taxon", 1, 2, 0, 0, 0)]
    df = spark.createDataFrame(rows, "protein_id string, n_unique int, n_taxon_unique int, n_family_unique int, "
                               "n_shared int, n_shared_unknown_taxon int")
    got = {r["protein_id"]: (r["taxon_unique_dominated"], r["shared_dominated"]) for r in Ft.dominance_flags(df).collect()}
    assert got == {"own": (False, False), "tie": (False, False), "cross": (False, True), "taxon": (True, False)}


def test_funnel_chains_within_a_unit(spark):
    n = lambda k: spark.range(k)
    steps = [Tb.Step("a", "protein", "", n(10)), Tb.Step("b", "feature", "", n(50)), Tb.Step("c", "feature", "x", n(30)),
             Tb.Step("d", "protein", "", n(12)), Tb.Step("e", "protein", "", n(12))]
    got = [(r["step"], r["before"], r["after"], r["dropped"]) for r in Tb.quant_funnel(steps).orderBy("step_order").collect()]
    assert got == [("a", None, 10, None), ("b", None, 50, None), ("c", 50, 30, 20), ("d", 10, 12, -2), ("e", 12, 12, 0)]


# ---------------------------------------------------------------- plexes
def plex(root, name, channels, rows, level="ion", psm=None, annotation=True, by="sample"):
    heads = [s if by == "sample" else c for c, s in channels]
    if annotation:
        put(root / name / f"{name}_annotation.txt", "".join(f"{c} {s}\n" for c, s in channels))
    table(root / name / f"{level}.tsv",
          ["Peptide Sequence", "Modified Sequence", "Charge", "Protein", "Mapped Proteins", "Intensity"]
          + [f"Intensity {h}" for h in heads],
          [(p, f"n{p}", 2, razor, mapped, 9, *vals) for p, razor, mapped, vals in rows])
    if psm:
        table(root / name / "psm.tsv", ["Peptide", "Modified Peptide", "Charge", "Purity"],
              [(p, f"n{p}", 2, v) for p, vs in psm.items() for v in vs])


@pytest.fixture
def two_plexes(tmp_path):
    root = tmp_path / "run"
    plex(root, "TMT1", [("126", "A1"), ("127N", "A2"), ("131C", "Pool01")],
         [("SK", "P1", "", (100, 200, 50)), ("OK", "D1", "", (0, 400, 50))])
    plex(root, "TMT10", [("126", "C1"), ("127N", "TMT10_127N")], [("SK", "P1", "", (7, 7))])
    plex(root, "TMT2", [("126", "B1"), ("127N", "B2"), ("131N", "Pool02")], [("SK", "P1", "D1", (300, 600, 100))])
    return str(root)


def test_plexes_are_joined_and_ordered(spark, two_plexes):
    run = X.read_plexes(spark, two_plexes)
    v = cells(run.values)
    assert v[("OK_nOK_2", "A2")] == 400.0 and ("OK_nOK_2", "A1") not in v and ("OK_nOK_2", "B1") not in v
    assert ("SK_nSK_2", "TMT10_127N") not in v
    order = [r["plex"] for r in run.design.orderBy("plex_order").collect()]
    assert order == ["TMT1"] * 3 + ["TMT2"] * 3 + ["TMT10"]
    pairs = {(r["feature_id"], r["protein_id"]) for r in run.candidates.collect()}
    assert pairs == {("SK_nSK_2", "P1"), ("SK_nSK_2", "D1"), ("OK_nOK_2", "D1")}
    kept = I.feature_min_plexes(run.values, 2).select("feature_id").distinct().collect()
    assert [r["feature_id"] for r in kept] == ["SK_nSK_2"]
    assert X.read_plexes(spark, two_plexes, drop_empty=False).design.count() == 8


def test_reference_resolution_and_ratios(spark, two_plexes):
    run = X.read_plexes(spark, two_plexes, plex_glob="TMT[12]")
    ref = X.resolve_reference(run.design, name="Pool*")
    ratios = I.reference_ratios(run.values, ref)
    got = {(r["feature_id"], r["sample"]): r["ratio"] for r in ratios.collect()}
    assert got[("SK_nSK_2", "A1")] == 2.0 and got[("SK_nSK_2", "B2")] == 6.0
    assert not any(s.startswith("Pool") for _, s in got)
    with pytest.raises(DesignError, match="TMT2.*matches 0"):
        X.resolve_reference(run.design, channel="131C")
    with pytest.raises(OptionError):
        X.resolve_reference(run.design, name="Pool*", channel="131C")
    with pytest.raises(OptionError):
        I.reference_ratios(run.values, X.resolve_reference(run.design))


def test_zero_reference_loses_the_plex(spark):
    v = spark.createDataFrame([("T", "f", "A1", 100.0), ("T", "f", "R", 50.0), ("T", "g", "A1", 300.0), ("T", "g", "R", 0.0)],
                              "plex string, feature_id string, sample string, value double")
    d = spark.createDataFrame([("A1", "T", False), ("R", "T", True)], "sample string, plex string, is_reference boolean")
    r = I.reference_losses(I.reference_ratios(v, d)).first()
    assert (r["n_values"], r["n_lost"], r["pct_lost"]) == (2, 1, 50.0)


def test_plex_failures_are_named(spark, tmp_path):
    root = tmp_path / "run"
    for p in ("TMT1", "TMT2"):
        plex(root, p, [("126", "A1")], [("SK", "P1", "", (1,))])
    with pytest.raises(InputError, match="both claim the sample name 'A1'"):
        X.read_plexes(spark, str(root))
    put(root / "TMT2" / "TMT2_annotation.txt", "126 OTHER\n")
    with pytest.raises(InputError, match="cannot be mapped"):
        X.read_plexes(spark, str(root))
    (root / "TMT2" / "TMT2_annotation.txt").unlink()
    with pytest.raises(InputError, match="has no annotation file"):
        X.read_plexes(spark, str(root))
    (root / "TMT2" / "ion.tsv").unlink()
    with pytest.raises(InputError, match="has no ion.tsv"):
        X.read_plexes(spark, str(root))
    with pytest.raises(InputError, match="matches no plex"):
        X.read_plexes(spark, str(root), plex_glob="X*")
    with pytest.raises(InputError, match="one file"):
        X.read_plexes(spark, str(root / "TMT1" / "ion.tsv"))
    plex(tmp_path / "ch", "TMT1", [("126", "A1")], [("SK", "P1", "", (5,))], by="channel")
    assert cells(X.read_plexes(spark, str(tmp_path / "ch")).values) == {("SK_nSK_2", "A1"): 5.0}


def test_purity_is_judged_by_the_median(spark, tmp_path):
    root = tmp_path / "run"
    plex(root, "TMT1", [("126", "A1")], [("CK", "P", "", (1,)), ("DK", "P", "", (1,)), ("UK", "P", "", (1,))],
         psm={"CK": [0.9, 0.8, 0.1], "DK": [0.9, 0.2, 0.3]})
    run = X.read_plexes(spark, str(root), with_purity=True)
    got = I.purity_filter(run.values.select("plex", "feature_id").distinct(), run.psms, 0.5).collect()
    assert {r["feature_id"][:2]: r["purity_state"] for r in got} == {"CK": "kept", "DK": "dropped", "UK": "unmatched"}


def test_channel_centring_and_under_correction(spark):
    rows = [("T", f"f{i}", s, v) for i in range(20) for s, v in
            (("A1", 10000.0 + i), ("A2", 10000.0 + i), ("A3", 1000.0 + i)) if not (s == "A3" and i % 2 == 0)]
    df = spark.createDataFrame(rows, "plex string, feature_id string, sample string, value double")
    meds = {r["sample"]: r["m"] for r in I.channel_median_normalise(df).groupBy("sample").agg(
        {"value": "median"}).withColumnRenamed("median(value)", "m").collect()}
    assert meds["A1"] == pytest.approx(meds["A3"], rel=1e-9)
    assert [r["sample"] for r in I.under_corrected_channels(df).where("under_corrected").collect()] == ["A3"]
    full = df.unionByName(spark.createDataFrame(
        [("T", f"f{i}", "A3", 1000.0 + i) for i in range(0, 20, 2)], df.schema))
    assert I.under_corrected_channels(full).where("under_corrected").count() == 0
    with pytest.raises(OptionError, match="quantile"):
        I.channel_median_normalise(df, "quantile")


# ---------------------------------------------------------------- design
def names(spark, samples, plexes=None):
    plexes = plexes or ["T1"] * len(samples)
    return spark.createDataFrame(list(zip(samples, plexes)), "sample string, plex string")


@pytest.mark.parametrize("samples,groups", [
    (["resp_1", "nonresp_1", "resp_2", "nonresp_2"], ["resp", "nonresp", "resp", "nonresp"]),
    (["MF0030", "MF0071", "MF0084", "MF0202"], [None] * 4),
    (["a-x_1", "a-x_2", "a-y_1", "a-y_2", "b-z_1", "b-z_2"], [None] * 6)])
def test_conditions_from_names(spark, samples, groups):
    got = {r["sample"]: r["group"] for r in Dg.condition_from_name(names(spark, samples)).collect()}
    assert got == dict(zip(samples, groups))


def test_condition_regex_and_off(spark):
    d = names(spark, ["R01T", "N02T"])
    assert sorted(r["group"] for r in Dg.condition_from_name(d, r"^([RN])\d+").collect()) == ["N", "R"]
    assert {r["group"] for r in Dg.condition_from_name(d, "").collect()} == {None}
    with pytest.raises(OptionError, match="exactly one"):
        Dg.condition_from_name(d, r"^(X)(\d+)")


def test_confounding_and_level_guards(spark):
    d = Dg.condition_from_name(names(spark, ["r_1", "r_2", "n_1", "n_2"], ["T1", "T1", "T2", "T2"]))
    with pytest.raises(DesignError, match="confounded"):
        I.require_unconfounded(d)
    ok = Dg.condition_from_name(names(spark, ["r_1", "n_1", "r_2", "n_2"], ["T1", "T1", "T2", "T2"]))
    assert I.require_unconfounded(ok) is ok
    assert Dg.default_terms(ok) == ("group", "plex")
    Dg.guard_levels(ok, ("group", "plex"))
    with pytest.raises(DesignError, match="only one level"):
        Dg.guard_levels(ok.where("group = 'r'"), ("group",))
    with pytest.raises(DesignError, match="0 residual"):
        Dg.guard_levels(ok.where("plex = 'T1'"), ("group",))
    with pytest.raises(DesignError, match="does not name"):
        Q.apply_metadata(ok, spark.createDataFrame([("r_1", "x")], "sample string, group string"), ["group"])
    with pytest.raises(DesignError, match="no column"):
        Q.apply_metadata(ok, spark.createDataFrame([("r_1", "x")], "sample string, grp string"), ["group"])


def test_both_filters_count_from_the_same_start(spark):
    values = [("P1", i, 1.0) for i in range(8)] + [("P2", i, 1.0) for i in range(4)]
    values += [("P3", i, 1.0) for i in (0, 1, 4, 5)] + [("P4", i, 1.0) for i in range(8)]
    v = spark.createDataFrame([(p, f"s{i}", x) for p, i, x in values], "protein_id string, sample string, value double")
    d = spark.createDataFrame([(f"s{i}", "TMT1" if i < 4 else "TMT2", "aabbaabb"[i]) for i in range(8)],
                              "sample string, plex string, group string")
    r = Fl.filter_report(Fl.protein_filters(v, d, 2, 1)).first()
    assert (r["removed_by_valid"], r["removed_by_plex"], r["n_kept"], r["valid_in_one_plex"]) == (1, 0, 3, 1)
    r = Fl.filter_report(Fl.protein_filters(v, d, 2, 2)).first()
    assert (r["removed_by_plex"], r["removed_by_plex_only"], r["n_kept"]) == (1, 1, 2)
    with pytest.raises(DesignError, match="not isobaric"):
        Fl.protein_filters(v, d.drop("plex"), 2, 2)
    assert sorted(x["protein_id"] for x in Fl.zero_variance(v, d).collect()) == ["P1", "P2", "P3", "P4"]


# ---------------------------------------------------------------- sinks
def test_sinks_write_what_they_say(spark, tmp_path):
    df = spark.createDataFrame([("b", 1, ["x", "y"]), ("a", 2, [])], "protein_id string, n int, ids array<string>")
    back = K.write_result_table(df, str(tmp_path / "t"), ["protein_id"], tsv_path=str(tmp_path / "tsv"))
    assert back.count() == 2
    text = [r["value"] for r in read_lines(spark, str(tmp_path / "tsv")).collect()]
    assert text == ["protein_id\tn\tids", 'a\t2\t""', "b\t1\tx;y"]
    with pytest.raises(ValueError, match="duplicate key"):
        K.write_result_table(df.union(df), str(tmp_path / "u"), ["protein_id"])
    assert not [x for x in tmp_path.iterdir() if x.name.startswith("u")]  # nothing is left of it
    v = spark.createDataFrame([("P", "s10", 1.0), ("P", "s9", 2.0)], "protein_id string, sample string, value double")
    d = spark.createDataFrame([("s10",), ("s9",), ("s11",)], "sample string")
    assert K.write_wide_quant(v, d, str(tmp_path / "w")) == ["s9", "s10", "s11"]
    assert published(spark, str(tmp_path / "w"))["quant"].columns == ["protein_id", "s9", "s10", "s11"]
    K.write_fasta(spark.createDataFrame([("P1", "MK")], "protein_id string, seq string"), str(tmp_path / "f"))
    assert [r["value"] for r in read_lines(spark, str(tmp_path / "f")).collect()] == [">P1", "MK"]
    K.write_peptide_list(spark.createDataFrame([("aK[16]",), ("AK",)], "peptide string"), str(tmp_path / "p"))
    assert [r["value"] for r in read_lines(spark, str(tmp_path / "p")).collect()] == ["AK"]


def test_linked_assays_carry_the_assignment(shared):
    q, taxa, _ = shared
    spark = taxa.sparkSession
    a = Ft.assign_features(q.features, taxa)
    de = spark.createDataFrame([("Q7", "b_vs_a", 1.0, 0.1, 0.2)],
                               "protein_id string, contrast string, lfc double, p_value double, q_value double")
    design = spark.createDataFrame([("S1",), ("S2",)], "sample string")
    t = K.linked_assays(Ft.rollup(Ft.assigned_values(q.values, a)), taxa, design, q.features, q.values, a, de)
    assert sorted(r["feature_id"] for r in t["link"].collect()) == ["AVNDLR", "EELIYPR", "WFTGHK"]
    assert "DE.b_vs_a.lfc" in t["proteins"].columns and t["peptides"].count() == 5
    assert set(K.linked_assays(q.values, taxa, design)) == {"proteins", "protein_values", "samples"}


def test_an_export_is_published_as_a_whole_or_not_at_all(spark, tmp_path):
    from umbra.sources.publish import Table, manifest, publish, published

    root = str(tmp_path / "export")
    one = spark.createDataFrame([("b", 1), ("a", 2)], "protein_id string, n int")
    back = publish({"x": Table(one, ["protein_id"]), "y": Table(one)}, root)
    assert {n: sorted(map(tuple, t.collect())) for n, t in back.items()} == {n: [("a", 2), ("b", 1)] for n in "xy"}
    first = manifest(spark, root)
    with pytest.raises(ValueError, match="duplicate key"):
        publish({"x": Table(one.limit(1), ["protein_id"]), "z": Table(one.union(one), ["protein_id"])}, root)
    assert manifest(spark, root) == first and set(published(spark, root)) == {"x", "y"}
    assert len(list((tmp_path / "export" / "versions").iterdir())) == 1
    for k in range(3):
        publish({"x": Table(one.withColumn("n", F.lit(k)), ["protein_id"])}, root)
    assert {r["n"] for r in published(spark, root)["x"].collect()} == {2} and set(published(spark, root)) == {"x"}
    assert len(list((tmp_path / "export" / "versions").iterdir())) == 2  # the one before stays for its readers
    with pytest.raises(FileNotFoundError):
        published(spark, str(tmp_path / "nothing"))


def test_polish_of_sparse_proteins_equals_the_dense_one_and_says_when_it_settled(spark):
    rng = random.Random(5)
    rows = [(f"P{p}", f"f{f}", f"s{s}", 2 ** rng.gauss(10, 2)) for p in range(6) for f in range(9) for s in range(7) if rng.random() < 0.6]
    v = spark.createDataFrame(rows + [("one", "f0", "s0", 8.0), ("zero", "f0", "s0", 0.0)], "protein_id string, feature_id string, sample string, value double")
    key = lambda df: {(r["protein_id"], r["sample"]): (pytest.approx(r["value"]), r["converged"]) for r in df.collect()}
    dense = key(Ft.rollup_median_polish(v, iterations=3))
    sparse = {}
    for batch in Ft._polish_packed(3, ["protein_id"], dense_cells=0)([_packed(rows + [("one", "f0", "s0", 8.0)])]):
        sparse |= {(r.protein_id, r.sample): (r.value, r.converged) for r in batch.itertuples()}
    assert sparse == dense and dense[("one", "s0")] == (8.0, True) and not all(c for _, c in dense.values())
    assert key(Ft.rollup_median_polish(v, iterations=3, cell_limit=4)) == dense
    assert all(c for _, c in key(Ft.rollup_median_polish(v, iterations=200)).values())


def _packed(rows):
    import pandas as pd

    df = pd.DataFrame(rows, columns=["protein_id", "fs", "ss", "vs"])
    return df.groupby("protein_id").agg(list).reset_index()


def test_razor_of_a_united_feature_is_that_of_the_first_plex_in_natural_order(spark):
    df = spark.createDataFrame([("f", "p", "late", "TMT10"), ("f", "p", "early", "TMT9")], "feature_id string, peptide string, razor string, plex string")
    assert X.unite_features(df).first()["razor"] == "early"


def test_a_repeated_key_in_the_annotation_table_is_refused(spark):
    from umbra.operators import tiers

    proteins = spark.createDataFrame([("a",)], "protein_id string")
    table = spark.createDataFrame([("a", 1), ("a", 2)], "protein_id string, n int")
    with pytest.raises(ValueError, match="duplicate key"):
        tiers.reuse_annotation(proteins, table)
