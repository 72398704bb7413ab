"""The end-to-end jobs over the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from bindings import registry as R
from bindings.evidence_queries import EVIDENCE_SQL, eggnog_lines, evidence_hits, s
from bindings.quant_queries import EVID_SQL, MODE_SQL, factor_sql
from bindings.registry import load, query
from bindings.statistics_queries import CENTRED_SQL, plex_fit_sql, moderated_sql, tested, tested_sql
from umbra.operators.evidence import EvidenceOptions, ScoreOptions
from umbra.plans import jobs as J
from umbra.plans.joins import lookup_join
from umbra.plans.lineage import cut_lineage
from umbra.sources import proteins as P


def annotated(spark, sf) -> J.Annotated:
    part = load(spark, sf, "part")
    proteins = part.select(
        F.concat(F.lit("P"), s("p_partkey")).alias("protein_id"), F.col("p_name").alias("description"),
        F.concat(F.lit("M"), F.upper(F.regexp_replace("p_name", " ", ""))).alias("seq"), F.col("p_size").alias("length"))
    lines, header = eggnog_lines(spark, sf)
    egg = P.typed_eggnog(P.parse_eggnog(lines, header))
    options = EvidenceOptions(score=ScoreOptions(small_length=10))
    return J.annotate(proteins, egg, evidence_hits(spark, sf), 100, 40, options=options)


@query("annotate_job", f"""WITH {EVIDENCE_SQL}
SELECT bin, count(*) AS n, CAST(sum(export_score) AS BIGINT) AS total_score FROM ann GROUP BY bin""")
def annotate_job(spark, sf):
    out = annotated(spark, sf)
    return out.annotation.groupBy("bin").agg(F.count("*").alias("n"), F.sum("export_score").alias("total_score"))


def quantified(spark, sf) -> J.Quantified:
    part = load(spark, sf, "part")
    annotation = part.select(
        F.col("p_partkey").alias("protein_id"), F.col("p_type").alias("bin"), F.col("p_size").alias("export_score"),
        (F.col("p_size") > 20).alias("has_ko"), (F.col("p_size") < 40).alias("surface_or_secreted"),
        F.when(F.col("p_size") > 5, F.col("p_brand")).alias("eggnog_taxid"))
    return J.quantify(
        R.features(spark, sf), R.feature_values(spark, sf), annotation,
        candidates=R.candidates(spark, sf))


@query("quantify_job", f"""WITH {EVID_SQL}, {R.FEATVAL_SQL}
SELECT razor AS protein_id, sample, round(sum(value), 2) AS value, any_value(p_type) AS bin, any_value(n_unique) AS n_unique,
  any_value(CASE WHEN p_size > 5 THEN p_brand END) AS effective_taxid
FROM fv JOIN cls USING (feature_id) JOIN ev ON ev.protein_id = razor JOIN part ON p_partkey = razor
WHERE {MODE_SQL['taxon_unique']} GROUP BY ALL""")
def quantify_job(spark, sf):
    out = quantified(spark, sf)
    return out.quant.select("protein_id", "sample", F.round("value", 2).alias("value"), "bin", "n_unique", "effective_taxid")


@query("quantify_job_factors", factor_sql(4).replace(
    R.PROTVAL_SQL, f"""{R.CLASS_SQL}, {R.FEATVAL_SQL},
pv AS (SELECT razor AS protein_id, sample, sum(value) AS value FROM fv JOIN cls USING (feature_id)
  WHERE {MODE_SQL['taxon_unique']} GROUP BY ALL)""").replace(f", {R.TAXA_SQL}", "").replace(
    "count(DISTINCT sample) FROM pv", "count(DISTINCT sample) FROM fv"))
def quantify_job_factors(spark, sf):
    out = J.size_factors(quantified(spark, sf).quant, R.design(spark, sf))
    return out.withColumn("factor", F.round("factor", 6))


# Proteins with three values or more in both groups.
ANALYSE_SQL = CENTRED_SQL.replace("FROM pv)", """FROM pv WHERE protein_id IN (
  SELECT protein_id FROM (SELECT protein_id, "group" FROM pv GROUP BY ALL HAVING count(*) >= 3) GROUP BY 1 HAVING count(*) = 2))""")


def analysed(spark, sf) -> J.Tested:
    part = load(spark, sf, "part")
    annotation = part.select(
        F.col("p_partkey").alias("protein_id"), F.col("p_type").alias("bin"), F.col("p_size").alias("export_score"),
        (F.col("p_size") > 20).alias("has_ko"), (F.col("p_size") < 40).alias("surface_or_secreted"))
    quant, design = _quant_of_parts(spark, sf), R.design(spark, sf)
    return J.analyse(quant, annotation, design, J.size_factors(quant, design), min_valid=3)


@query("analyse_job", f"WITH RECURSIVE {ANALYSE_SQL}, {plex_fit_sql('ce')}, {moderated_sql('x', 'fit')} {tested_sql('xq')}")
def analyse_job(spark, sf):
    return tested(analysed(spark, sf).abundance)


@query("analyse_job_retention", f"""WITH RECURSIVE {ANALYSE_SQL}, {plex_fit_sql('ce')}, {moderated_sql('x', 'fit')}
SELECT p_type AS bin, count(*) AS n, count(xq.protein_id) AS kept, count(p_value) AS tested, round(100.0 * count(p_value) / count(*), 1) AS percent,
  CASE WHEN count(p_value) > 0 THEN 'ok' WHEN count(*) >= 10 THEN 'GATE' ELSE 'NOTE' END AS verdict
FROM (SELECT DISTINCT l_partkey FROM lineitem) JOIN part ON p_partkey = l_partkey LEFT JOIN xq ON xq.protein_id = l_partkey GROUP BY p_type""")
def analyse_job_retention(spark, sf):
    return analysed(spark, sf).retention


# The adjusted model of the job: values less the organism's factor, with plexes; a protein deviates where that is significant and large.
_FACTORS, _FACTOR = factor_sql(4).replace(
    "round(CASE WHEN method = 'sum_fallback' THEN plain ELSE fac END, 6)", "CASE WHEN method = 'sum_fallback' THEN plain ELSE fac END",
).rsplit("\nSELECT taxid, sample,", 1)
RISK_SQL = f"""{_FACTORS.replace("WITH ", "WITH RECURSIVE ", 1)},
sf AS (SELECT taxid, sample,{_FACTOR}),
lg AS ({ANALYSE_SQL.split("lg AS (", 1)[1]},
ra AS (SELECT protein_id, ce.plex, ce."group", v - log2(factor) AS v FROM ce JOIN taxa USING (protein_id) JOIN sf ON sf.taxid = taxa.taxid AND sf.sample = ce.sample WHERE factor > 0),
{plex_fit_sql("ra", "a_")}, {moderated_sql("a_", "a_fit")},
fc AS (SELECT taxid, avg(log2(factor)) FILTER ("group" = 'O') - avg(log2(factor)) FILTER ("group" = 'F') AS f, min(method) AS method
  FROM sf JOIN (SELECT DISTINCT sample, "group" FROM pv) USING (sample) WHERE factor > 0 GROUP BY taxid),
mv AS (SELECT taxid, f, method, lfc, coalesce(q_value < 0.05 AND abs(lfc) >= 0.585, false) AS deviates FROM a_q JOIN taxa USING (protein_id) JOIN fc USING (taxid) WHERE contrast IS NOT NULL),
rk AS (SELECT taxid, f, min(method) AS method, count(*) AS n_tested, count(*) FILTER (deviates) AS n_dev, count(*) FILTER (deviates AND sign(lfc) <> sign(f)) AS n_opposing FROM mv GROUP BY ALL)
SELECT taxid, round(f, 6) AS factor_log2fc, n_tested, n_dev, n_opposing, CASE WHEN method = 'sum_fallback' THEN 'fragile (too few proteins)'
  WHEN abs(f) > 0.585 AND n_dev >= 3 AND n_opposing / n_dev > 0.6 AND n_opposing / n_tested >= 0.3 THEN 'AT RISK'
  WHEN n_dev / n_tested > 0.5 THEN 'check (median in a sparse region)' ELSE 'ok' END AS assumption FROM rk"""


@query("analyse_job_risk", RISK_SQL)
def analyse_job_risk(spark, sf):
    out = analysed(spark, sf).risk
    return out.select("taxid", F.round("factor_log2fc", 6).alias("factor_log2fc"), "n_tested", "n_dev", "n_opposing", "assumption")


def _quant_of_parts(spark, sf):
    """Every line counts for its part, as protein-level input does."""
    quant = lookup_join(R.protein_values(spark, sf).drop("plex", "group"), R.taxa(spark, sf), ["protein_id"])
    return cut_lineage(quant.withColumn("effective_taxid", F.col("taxid")), "quant")
