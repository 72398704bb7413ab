"""Bins, rescue rules, scores, work-lists and summaries."""

import itertools

import pytest
from makers import (PROTEIN_SCHEMA, PROTEINS, diamond_line, domtblout_line, eggnog_text,
                    foldseek_line, interpro_line, kofam_line, protein_rows, tblout_line)
from pyspark.sql import functions as F

from bindings import evidence_queries, job_queries  # noqa: F401
from bindings.registry import ORACLES, QUERIES
from umbra.operators import bins as B
from umbra.operators import evidence as E
from umbra.operators import tiers as Ti
from umbra.operators.agreement import source_agreement
from umbra.sources import hits as H
from umbra.sources import proteins as P


def lines(spark, rows):
    return spark.createDataFrame([(x,) for x in rows], "value string")


def eggnog(spark, cells):
    text = eggnog_text(cells).split("\n")
    src = lines(spark, text)
    return P.typed_eggnog(P.parse_eggnog(src, P.eggnog_header(src)))


def annotate(spark, ids=None, cells=None, seqs=None, library=None, options=E.EvidenceOptions(),
             signalp=None, context=None, **tools):
    cells = cells if cells is not None else {p: c for p, (c, _) in PROTEINS.items() if c}
    rows = protein_rows(ids) if seqs is None else [(p, "", s, len(s)) for p, s in seqs.items()]
    proteins = spark.createDataFrame(rows, PROTEIN_SCHEMA)
    parsers = {
        "pfam": lambda x: H.parse_tblout(x, "pfam"),
        "ncbifam": lambda x: H.parse_tblout(x, "ncbifam"),
        "jackhmmer": lambda x: H.by_query(H.parse_tblout(x, "jackhmmer")),
        "dbcan": H.parse_domtblout,
        "kofam": H.parse_kofam,
        "interpro": H.parse_interproscan,
        "foldseek": H.parse_foldseek,
        "vfdb": lambda x: H.parse_diamond(x, "vfdb", ident=0),
    }
    tables = [parsers[t](lines(spark, ls)) for t, ls in tools.items()]
    hits = E.union_evidence(tables) if tables else H.parse_kofam(lines(spark, [""]))
    if library is not None:
        library = spark.createDataFrame(library, "name string, accession string, description string")
    df = E.build_annotation(proteins, eggnog(spark, cells), hits, library, signalp=signalp,
                            context=context, options=options)
    return {r["protein_id"]: r for r in df.collect()}


def test_annotation_table_alone_gives_the_expected_bins(spark):
    got = annotate(spark)
    assert {p: r["bin"] for p, r in got.items()} == {p: b for p, (_, b) in PROTEINS.items()}
    assert got["amylase"]["kegg_enrichment_visible"] and not got["overview_map"]["kegg_enrichment_visible"]


def test_every_combination_of_the_six_predicates_has_one_bin(spark):
    combos = {"C_" + "".join(map(str, b)): b for b in itertools.product([0, 1], repeat=6)}
    cells = {p: {"KEGG_ko": "ko:K07405" if b[0] else "-", "KEGG_Pathway": "map00010" if b[1] else "-"}
             for p, b in combos.items()}
    got = annotate(
        spark, list(combos), cells,
        dbcan=[domtblout_line(p, "GH13.hmm", 100, 1, 90) for p, b in combos.items() if b[2]],
        pfam=[tblout_line(p, "DUF1234", "PF01234.1") for p, b in combos.items() if b[3]],
        foldseek=[foldseek_line(p, "sp|X", "aerolysin toxin", "swissprot") for p, b in combos.items() if b[4]],
        jackhmmer=[tblout_line(f"UniRef_{p}", p) for p, b in combos.items() if b[5]],
    )

    def want(ko, path, seq, duf, struct, prof):
        if ko:
            return B.BINS[0] if path else B.BINS[1]
        for flag, name in zip((seq, duf, struct, prof), B.BINS[2:6]):
            if flag:
                return name
        return B.BINS[6]

    assert {p: r["bin"] for p, r in got.items()} == {p: want(*b) for p, b in combos.items()}


def test_domain_rules(spark):
    got = annotate(
        spark,
        library=[("T1", "NF1", "hypothetical protein"), ("T2", "NF2", "ribosomal protein S12")],
        pfam=[tblout_line("unlisted_b", "UPF0102", "PF01894.1")],
        ncbifam=[tblout_line("seed_only", "T1", "NF1.1"), tblout_line("unlisted_a", "T2", "NF2.1")],
    )
    assert [got[p]["bin"] for p in ("seed_only", "unlisted_a", "unlisted_b")] == [
        "3d_duf_only", "3_annotated_no_ko", "3d_duf_only"]
    assert got["unlisted_a"]["ncbifam_accs"] == ["NF2"]
    off = annotate(spark, library=[("T1", "NF1", "hypothetical protein")],
                   options=E.EvidenceOptions(ncbifam_uninformative_test=False),
                   ncbifam=[tblout_line("seed_only", "T1", "NF1")])
    assert off["seed_only"]["bin"] == "3_annotated_no_ko"


def test_interpro_structural_and_undescribed_rows_do_not_promote(spark):
    got = annotate(spark, interpro=[
        interpro_line("seed_only", "SignalP_GRAM_POSITIVE", "SignalP-noTM", "SignalP-noTM"),
        interpro_line("unlisted_a", "SUPERFAMILY", "SSF1", "-"),
        interpro_line("unlisted_b", "PANTHER", "PTHR1", "FAMILY NOT NAMED"),
        interpro_line("duf", "Gene3D", "G3", "Rossmann fold"),
    ])
    assert [got[p]["bin"] for p in ("seed_only", "unlisted_a", "unlisted_b", "duf")] == [
        "4_dark", "4_dark", "4_dark", "3_annotated_no_ko"]


def test_rescues_demotions_and_duf_precedence(spark):
    got = annotate(spark, foldseek=[
        foldseek_line("seed_only", "AF-1", "Uncharacterized protein", "afdb50"),
        foldseek_line("unlisted_a", "sp|X", "aerolysin toxin", "swissprot"),
        foldseek_line("duf", "sp|X", "aerolysin toxin", "swissprot")],
        jackhmmer=[tblout_line("UniRef50_A", "unlisted_b"), tblout_line("seed_only", "seed_only")])
    assert got["seed_only"]["bin"] == "4_dark" and got["seed_only"]["rescue_demoted"]
    assert got["seed_only"]["jackhmmer_hit"] is None
    assert got["unlisted_a"]["bin"] == "3s_structure_only"
    assert got["unlisted_b"]["bin"] == "3p_profile_only"
    assert got["duf"]["bin"] == "3d_duf_only" and got["duf"]["rescued_by"] == "structure"


def test_kofam_rescue_promotion_and_conflict(spark):
    got = annotate(spark, kofam=[kofam_line("seed_only", "K07405", "x"), kofam_line("amylase", "K99999", "x"),
                                 kofam_line("lone_ko", "K21471", "x")])
    assert (got["seed_only"]["bin"], got["seed_only"]["ko_source"]) == ("1_ko_pathway", "kofam")
    assert got["amylase"]["ko_conflict"] and not got["lone_ko"]["ko_conflict"]
    assert got["lone_ko"]["ko_source"] == "both"


def score_of(spark, hits, weights=None, cats=None):
    base = E.ScoreOptions()
    opts = E.EvidenceOptions(score=E.ScoreOptions(
        diamond=weights if weights is not None else base.diamond,
        vfdb_category=cats if cats is not None else base.vfdb_category))
    got = annotate(spark, options=opts, vfdb=[diamond_line(p, "VFG", i, t) for p, i, t in hits])
    base = got["unlisted_b"]["export_score"]
    return {p: r["export_score"] - base for p, r in got.items()}


def test_database_points(spark):
    s = score_of(spark, [("seed_only", 95.0, "hemolysin"), ("unlisted_a", 31.0, "hemolysin")])
    assert s["seed_only"] - s["unlisted_a"] == 4 - 4 // 2
    s = score_of(spark, [("seed_only", 95.0, "SopB (VFC0086) [T3SS]"), ("unlisted_a", 95.0, "GroEL (VFC0272)")])
    assert (s["seed_only"], s["unlisted_a"]) == (4, 1)
    s = score_of(spark, [("seed_only", 95.0, "x (VFC9999)"), ("unlisted_a", 95.0, "none")])
    assert (s["seed_only"], s["unlisted_a"]) == (4, 4)
    for w in ({"vfdb": 0}, {}):
        assert score_of(spark, [("seed_only", 95.0, "SopB (VFC0086)")], w)["seed_only"] == 0
    assert score_of(spark, [("seed_only", 95.0, "GroEL (VFC0272)")], cats={})["seed_only"] == 4


def test_surface_terms_survive_missing_sources(spark):
    tail = "AVILMFWCGPAVILMFWCGP" + "KRK"
    got = annotate(
        spark, cells={},
        seqs={"real": "M" + "A" * 100 + "LPKTG" + tail, "fake": "M" + "A" * 100 + "LPKTG" + "DE" * 10 + "DED",
              "anchor": "M" + "D" * 150},
        pfam=[tblout_line("anchor", "Gram_pos_anchor", "PF00746.24")],
        signalp=None)
    assert {p: r["surface_or_secreted"] for p, r in got.items()} == {
        "real": True, "fake": False, "anchor": True}
    sp = spark.createDataFrame([("seed_only", "PILIN"), ("unlisted_a", "OTHER")], "protein_id string, sp_class string")
    got = annotate(spark, signalp=sp)
    assert got["seed_only"]["surface_or_secreted"] and not got["unlisted_a"]["surface_or_secreted"]
    assert got["seed_only"]["export_score"] > got["unlisted_a"]["export_score"]


@pytest.mark.parametrize("desc,hit", [
    ("MRTXase family protein", False), ("RTX toxin", True), ("a mosquitocidal holotoxin", True),
    ("CdiA-CT toxin domain", True), ("Ntox47 domain-containing protein", True),
    ("zeta toxin family protein", True), ("HNH nuclease toxin", True), ("Cytidine deaminase", False),
    ("Hemolysin III family protein", False), ("contact-dependent growth inhibition", True)])
def test_toxin_patterns_match_whole_words(spark, desc, hit):
    from umbra.functions.text import toxin_fold
    assert spark.range(1).select(toxin_fold(F.lit(desc))).first()[0] is hit


def test_bin_summary_has_every_bin_and_a_total(spark):
    df = spark.createDataFrame([("4_dark", 3), ("4_dark", 5), ("2_ko_orphan", 1)], "bin string, export_score int")
    got = B.bin_summary(df).collect()
    assert [r["bin"] for r in got] == [*B.BINS, "TOTAL"]
    assert [r["n"] for r in got] == [0, 1, 0, 0, 0, 0, 2, 3]
    assert got[-2]["median_export_score"] == 4.0 and got[-2]["percent"] == 66.7
    bad = df.withColumn("bin", F.lit("5_invented"))
    with pytest.raises(Exception, match="not in the bin list"):
        B.bin_summary(bad).collect()
    many = df.withColumn("dataset", F.lit("a")).unionByName(df.withColumn("dataset", F.lit("b")))
    assert B.bin_summary(many, ["dataset"]).count() == 16


def test_worklists_and_shortfall(spark):
    df = spark.createDataFrame(
        [("a", "4_dark", 5, 100), ("b", "4_dark", 7, 100), ("c", "4_dark", 9, 9000),
         ("rev_d", "4_dark", 99, 50), ("e", "2_ko_orphan", 99, 50)],
        "protein_id string, bin string, export_score int, length int")
    assert [r["protein_id"] for r in E.dark_worklist(df, 1, 1000).collect()] == ["b"]
    assert sorted(r["protein_id"] for r in E.dark_set(df).collect()) == ["a", "b", "c"]
    req = spark.createDataFrame([("have", 40), ("long", 900), ("failed", 40), ("never", 40)],
                                "protein_id string, length int")
    have = spark.createDataFrame([("have",), ("gone",)], "protein_id string")
    fail = spark.createDataFrame([("failed",)], "protein_id string")

    def causes(failures, finished):
        out = E.structure_shortfall(req, have, failures, 500, finished).collect()
        return {r["protein_id"]: r["cause"] for r in out}

    assert causes(fail, True) == {"have": "present", "long": "over_cap", "failed": "failed",
                                  "never": "never_attempted"}
    assert causes(None, True)["never"] == "lost" and causes(fail, False)["never"] == "pending"


def tiered(spark):
    rows = [(f"uhgpL_MGYG{i:05d}", "1_ko_pathway", 1, True) for i in range(6)]
    rows += [(f"OIDECCNN_{i:05d}", "4_dark", 3, False) for i in range(4)]
    rows += [(f"rev_X{i}", "4_dark", 9, False) for i in range(9)]
    return spark.createDataFrame(rows, "protein_id string, bin string, export_score int, egg boolean")


def test_tier_coverage(spark):
    t = Ti.tier_coverage(tiered(spark), {"eggnog": F.col("egg")}).collect()
    assert [(r["tier"], r["n"], r["pct_of_proteome"], r["pct_eggnog"], r["pct_dark"], r["key_shape"],
             r["key_shape_pct"]) for r in t] == [
        ("uhgpL_", 6, 60.0, 100.0, 0.0, "MGYG#", 100.0), ("OIDECCNN_", 4, 40.0, 0.0, 100.0, "#", 100.0)]
    one = tiered(spark).where("protein_id LIKE 'uhgp%'")
    assert Ti.tier_coverage(one, {}).count() == 0
    many = spark.createDataFrame([(f"MAG{i:04d}_1", "4_dark", 1) for i in range(20)],
                                 "protein_id string, bin string, export_score int")
    assert Ti.tier_coverage(many, {}).count() == 0


def test_reuse_by_prefix_and_gate(spark):
    ps = spark.createDataFrame([("uhgpSM_M1",), ("uhgpL_M1",), ("M2",), ("ampS_Q",)], "protein_id string")
    table = spark.createDataFrame([("M1", "K1"), ("M2", "K2")], "protein_id string, ko string")
    out = Ti.reuse_annotation(ps, table, ["uhgpSM_", "uhgpL_"])
    got = {r["protein_id"]: (r["ko"], r["matched_by"]) for r in out.collect()}
    assert got == {"uhgpSM_M1": ("K1", "prefix"), "uhgpL_M1": ("K1", "prefix"), "M2": ("K2", "exact"),
                   "ampS_Q": (None, None)}
    assert Ti.coverage_gate(out).first()["level"] == "warn"
    none = Ti.reuse_annotation(ps, table)
    with pytest.raises(Exception, match="id mismatch"):
        Ti.coverage_gate(none)
    diag = Ti.id_mismatch_diagnosis(none.where("matched_by IS NULL"), table).collect()
    assert {(r["transform"], r["prefix"], r["n_matched"]) for r in diag} == {
        ("strip_tier", "uhgpSM_", 1), ("strip_tier", "uhgpL_", 1)}
    tiers = {r["tier"]: r for r in Ti.annotation_coverage_by_tier(
        Ti.reuse_annotation(ps.where("protein_id <> 'M2'"), table, ["uhgpL_"]), ["uhgpL_"]).collect()}
    assert tiers["ampS_"]["matched_none"] and not tiers["ampS_"]["unlisted_twin"]
    assert tiers["uhgpSM_"]["unlisted_twin"] and not tiers["uhgpL_"]["unlisted_twin"]


def test_source_agreement_counts(spark):
    def run(rows, schema):
        return {r["comparison"]: r for r in source_agreement(spark.createDataFrame(rows, schema)).collect()}
    s = "pfam_accs array<string>, interpro_sigs array<string>"
    r = run([(["PF5.29", "PF6"], ["Gene3D:G:1", "Pfam:PF5", "Pfam:PF6"]), (["PF5", "PF7"], ["Pfam:PF5"]),
             (["PF5", "PF1"], ["Pfam:PF5", "Pfam:PF2"]), (["PF5"], ["Pfam:PF9"]), (["PF5"], [])], s)
    assert len(r) == 1
    p = r["pfam: hmmsearch vs interproscan"]
    assert (p["both"], p["identical"], p["overlapping"], p["disjoint"], p["a_superset"], p["b_superset"],
            p["mutually_exclusive"], p["a_only"]) == (4, 1, 2, 1, 1, 0, 1, 1)
    k = "ko array<string>, kofam_ko array<string>"
    r = run([(["ko:K1"], ["K1"])] * 95 + [(["ko:K1"], ["K9"])] * 5, k)["ko: eggnog vs kofamscan"]
    assert (r["pct_agree"], r["namespace_warning"]) == (95.0, False)
    r = run([([f"NAME{i}"], [f"K{i}"]) for i in range(60)], k)["ko: eggnog vs kofamscan"]
    assert r["namespace_warning"]
    assert run([([], [])], k) == {}


def test_ko_maps_stay_in_their_data_set(spark):
    from umbra.operators import evidence as E

    hits = spark.createDataFrame([("A", "p", "kofam", "K1"), ("B", "p", "kofam", "K1")], "ds string, protein_id string, source string, name string")
    for c, t in (("db", "string"), ("description", "string"), ("accession", "string"), ("score", "double"), ("evalue", "double"), ("ident", "double")):
        if c not in hits.columns:
            hits = hits.withColumn(c, F.lit(None).cast(t))
    maps = spark.createDataFrame([("A", "K1", True)], "ds string, ko string, ko_specific boolean")
    both = {r["ds"]: r.asDict() for r in E.reduce_hits(hits, None, maps, by=["ds"]).collect()}
    alone = E.reduce_hits(hits.where("ds = 'B'"), None, maps.where("ds = 'B'"), by=["ds"]).first().asDict()
    assert both["B"] == alone and both["A"] != {**alone, "ds": "A"}


def test_the_family_rule_is_asked_of_every_data_set(spark):
    from umbra.errors import InputError
    from umbra.operators.features import check_families

    fam = spark.createDataFrame([("A", "p1", "f"), ("B", "p1", "f")], "ds string, protein_id string, family_id string")
    with pytest.raises(InputError, match="one member"):
        check_families(fam, ["ds"])


def test_every_line_is_a_hit(spark):
    sf = "/root/testdata/sf0.001"
    n = spark.read.parquet(f"{sf}/lineitem.parquet").count()
    hits = QUERIES["evidence_union"](spark, sf).collect()
    assert len(hits) == 4 and sum(r["n"] for r in hits) == n
    assert "l_quantity" not in ORACLES["annotate_job"] and "l_quantity" not in ORACLES["annotation_table"]
