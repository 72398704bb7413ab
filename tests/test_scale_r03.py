"""Steps whose time or memory grew too fast in the findings of round 3."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from umbra.functions import tails as T
from umbra.operators import models as M


# ---------------------------------------------------------------- F5, F8, F10, F17
def test_written_fits_serve_the_naive_model_too(spark, monkeypatch):
    rng = np.random.default_rng(5)
    rows = [(f"P{p}", f"{g}{i}", float(rng.normal() + p)) for p in range(9) for g in "FO" for i in range(3) if (p, g, i) != (4, "F", 0)]
    values = spark.createDataFrame(rows, "protein_id string, sample string, value double")
    design = spark.createDataFrame([(f"{g}{i}", g) for g in "FO" for i in range(3)], "sample string, `group` string")
    taxa = spark.createDataFrame([(f"P{p}", "T") for p in range(7)], "protein_id string, taxid string")
    factors = spark.createDataFrame([("T", f"{g}{i}", 1.0 + i) for g in "FO" for i in range(3)], "taxid string, sample string, factor double")
    shown = lambda df: sorted((r["protein_id"], *(round(r[c], 9) for c in ("lfc_naive", "q_naive", "lfc_adj", "q_adj"))) for r in df.collect())
    want = shown(M.ratio_model(values, taxa, factors, design))
    fits = M.fit_proteins(values, design).localCheckpoint()
    calls, fit = [], M.fit_proteins
    monkeypatch.setattr(M, "fit_proteins", lambda *a, **k: calls.append(1) or fit(*a, **k))
    got = shown(M.ratio_model(values, taxa, factors, design, fits=fits))
    assert got == want and len(got) == 7 and len(calls) == 1  # the adjusted values alone are fitted


def test_tails_of_a_batch_settle_a_row_at_a_time():
    a, b, x = np.array([0.5, 200.0, 0.5]), np.array([1.0, 0.5, 3.0]), np.array([0.25, 0.99, 0.0])
    got = T.beta_fraction(a, b, x)
    alone = [T.beta_fraction(a[[i]], b[[i]], x[[i]])[0] for i in range(3)]
    assert got == pytest.approx(alone, rel=1e-15) and got[2] == pytest.approx(1.0)


# ---------------------------------------------------------------- F7, F9
def test_reading_a_header_does_not_sort_the_lines(spark, tmp_path):
    from umbra.sources.lines import first_lines, headers

    (tmp_path / "a.tsv").write_text("\n  \nid\tx\n1\t2\n" + "3\t4\n" * 50)
    (tmp_path / "b.tsv").write_text("id\ty\r\n5\t6\n")
    (tmp_path / "c.tsv").write_text("\n\n")
    assert {h: [f[-5:] for f in files] for h, files in headers(spark, str(tmp_path)).items()} == {"id\tx": ["a.tsv"], "id\ty": ["b.tsv"]}
    plan = first_lines(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert "ObjectHashAggregate" in plan and "Sort" not in plan


# ---------------------------------------------------------------- F13, F14, F15
def test_pairs_are_dealt_into_tasks_of_bounded_rows(spark):
    from umbra.plans.lineage import dealt

    pairs = spark.range(1000).select(F.col("id").alias("a"), (F.col("id") % 7).alias("b"))
    parts = dealt(pairs, ["a", "b"], 50)
    assert parts.rdd.getNumPartitions() == 20 and parts.distinct().count() == 1000
    assert dealt(pairs, ["a"], 10**6).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism


def test_candidates_meet_before_they_are_made_distinct(spark):
    from bindings.registry import candidates

    plan = candidates(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Aggregate") < plan.index("RepartitionByExpression")


# ---------------------------------------------------------------- F6, F16
def test_the_consensus_reads_its_peptides_once_and_shuffles_twice(spark):
    from umbra.operators import taxonomy as Tx

    rows = [("P1", "D", "A"), ("P1", "D", "A"), ("P1", "D", "B"), ("P2", "D", "A"), ("P2", "D", "B"), ("P3", "D", None), ("P4", None, None), ("P5", "D", "A"), ("P5", "D", "A")]
    df = spark.createDataFrame(rows, "protein_id string, domain_id string, genus_id string")
    out = Tx.consensus_taxon(df, ranks=("domain", "genus"))
    got = {r["protein_id"]: (r["consensus_taxid"], r["consensus_rank"], r["n_peptides"]) for r in out.collect()}
    assert got == {"P1": ("A", "genus", 3), "P2": ("D", "domain", 2), "P3": (None, None, 1), "P5": ("A", "genus", 2)}
    plan = out._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("RDD") == 1 and "Join" not in plan


# ---------------------------------------------------------------- F12
def test_the_polish_reads_its_values_once(spark):
    from umbra.operators import features as Ft

    calls = spark.sparkContext.accumulator(0)

    def seen(batches):
        for b in batches:
            calls.add(len(b))
            yield b

    rows = [(f"P{p}", f"f{f}", s, 1.0 + p + f) for p in range(5) for f in range(4) for s in ("a", "b")]
    df = spark.createDataFrame(rows, "protein_id string, feature_id string, sample string, value double")
    assert Ft.rollup_median_polish(df.mapInPandas(seen, df.schema)).count() == 10 and calls.value == len(rows)


def test_proteins_of_a_batch_are_polished_as_if_alone():
    import pandas as pd

    from umbra.operators import features as Ft

    rng = np.random.default_rng(12)
    rows = [(p, f, s, 2.0 ** rng.normal(10, 2)) for p in range(40) for f in range(1 + p % 9) for s in "abcde" if rng.random() < 0.6]
    rows += [(p, f, s, 1.0) for p, f, s, _ in rows if p % 3 == 0]  # a cell in two rows is their sum
    packed = pd.DataFrame(rows, columns=["protein_id", "fs", "ss", "vs"]).groupby("protein_id").agg(list).reset_index()
    key = lambda out: {(r.protein_id, r.sample): (pytest.approx(r.value, rel=1e-12), r.converged) for b in out for r in b.itertuples()}
    together = key(Ft._polish_packed(6, ["protein_id"])([packed, packed[:0]]))
    alone = key(b for i in range(len(packed)) for b in Ft._polish_packed(6, ["protein_id"])([packed[i : i + 1]]))
    small = key(Ft._polish_packed(6, ["protein_id"], chunk_cells=60, dense_cells=20)([packed]))
    assert together == alone == small and len(together) == len({(p, s) for p, _, s, _ in rows})


# ---------------------------------------------------------------- F19
def test_hits_are_not_shuffled_to_meet_the_maps_of_kos(spark):
    from umbra.operators import evidence as E
    from umbra.sources import hits as H

    source = F.element_at(F.array(*[F.lit(x) for x in ("kofam", "pfam", "foldseek")]), (F.col("id") % 3 + 1).cast("int"))
    name = F.when(source == "kofam", F.concat(F.lit("K"), (F.col("id") % 2).cast("string"))).otherwise("PF1")
    rows = spark.range(60).select(F.concat(F.lit("P"), (F.col("id") % 5).cast("string")).alias("_p"), name.alias("_n"), source.alias("_s"))
    hits = H.hit(rows, "any", protein_id=F.col("_p"), name=F.col("_n"), accession=F.concat("_n", F.lit(".3")), score=F.lit(1.0)).withColumn("source", F.col("_s"))
    eggnog = spark.createDataFrame([("P0", ["K0"], ["map00010", "map01100"])], "protein_id string, ko array<string>, pathway array<string>")
    out = E.reduce_hits(hits.select(*H.HIT_COLUMNS), ko_maps=E.ko_with_specific_map(eggnog))
    plan = out._jdf.queryExecution().sparkPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    got = {r["protein_id"]: r for r in out.collect()}
    assert len(got) == 5 and all(r["kofam_ko"] == ["K0", "K1"] and r["kofam_specific"] and r["foldseek_hit"] == "PF1" for r in got.values())
    assert got["P0"]["pfam_hits"] == ["PF1"] and got["P0"]["pfam_accs"] == ["PF1"] and got["P0"]["pfam_informative"] and got["P0"]["foldseek_informative"]


def test_hits_of_lines_are_read_in_one_scan(spark):
    from bindings.evidence_queries import evidence_hits

    plan = evidence_hits(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation") == 1


# ---------------------------------------------------------------- F20
def test_members_of_named_groups_meet_the_annotation_once(spark):
    from bindings import QUERIES
    from umbra.operators import tables as Tb

    g = spark.createDataFrame([(1, "A;B"), (2, "A;B"), (3, "C;D")], "n int, group_id string")
    ann = spark.createDataFrame([("A", "1_ko_pathway", ["K1"]), ("B", "2_ko_orphan", ["K1"])], "protein_id string, bin string, ko array<string>")
    got = {r["n"]: tuple(r)[1:] for r in Tb.group_conflicts(g, ann, name=["n"]).collect()}
    assert got == {1: (2, True, False, False), 2: (2, True, False, False), 3: (2, False, False, True)}
    # Lines are read for the hits and for the groups, once each.
    plan = QUERIES["group_conflicts"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert sum("Relation" in x and "l_" in x for x in plan.splitlines()) == 2
