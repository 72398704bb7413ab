"""The shared-peptide rule, roll-up, protein evidence, tables and organism factors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bindings import registry as R
from bindings.registry import joined, load, query
from umbra.operators import features as Ft
from umbra.operators import organisms as O
from umbra.operators import tables as Tb
from umbra.plans.joins import lookup_join
from umbra.plans.lineage import cut_lineage
from umbra.sources import quant as Q
from umbra.sources import sinks as K
from umbra.sources.publish import published

MODE_SQL = {
    "protein_unique": "assignment_class = 'unique'",
    "taxon_unique": "assignment_class IN ('unique', 'taxon_unique')",
    "taxon_or_family_unique": "family_class IN ('unique', 'taxon_unique', 'family_unique')",
    "razor": "true",
}


def assigned(spark, sf, mode="taxon_unique") -> DataFrame:
    taxa = R.taxa(spark, sf)
    families = taxa.select("protein_id", "family_id") if mode == "taxon_or_family_unique" else None
    return Ft.assign_features(
        R.features(spark, sf), taxa, mode, families, candidates=R.candidates(spark, sf))


# ---------------------------------------------------------------- classes
@query("assignment_class_summary", f"""WITH {R.CLASS_SQL},
x AS (SELECT family_class AS c FROM cls UNION ALL SELECT 'TOTAL' FROM cls)
SELECT k.c AS assignment_class, count(x.c) AS n_features
FROM (VALUES ('unique'), ('taxon_unique'), ('family_unique'), ('shared'), ('shared_unknown_taxon'), ('TOTAL')) AS k(c)
LEFT JOIN x USING (c) GROUP BY k.c""")
def assignment_class_summary(spark, sf):
    """Features per class with every class present and a total."""
    pairs = Ft.attach_taxon(R.candidates(spark, sf), R.taxa(spark, sf))
    pairs = Ft.attach_family(pairs, R.taxa(spark, sf))
    classes = Ft.classify_features(pairs, use_family=True)
    counts = classes.agg(
        *[F.count_if(F.col("assignment_class") == c).alias(c) for c in Ft.CLASSES], F.count("*").alias("TOTAL"))
    return counts.unpivot([], [*Ft.CLASSES, "TOTAL"], "assignment_class", "n_features")


@query("feature_classes", f"""WITH {R.CLASS_SQL}
SELECT feature_id, n_candidates, assignment_class FROM cls""")
def feature_classes(spark, sf):
    pairs = Ft.attach_taxon(R.candidates(spark, sf), R.taxa(spark, sf))
    return Ft.classify_features(pairs)


@query("feature_classes_with_families", f"""WITH {R.CLASS_SQL}
SELECT feature_id, n_candidates, family_class AS assignment_class FROM cls""")
def feature_classes_with_families(spark, sf):
    pairs = Ft.attach_family(Ft.attach_taxon(R.candidates(spark, sf), R.taxa(spark, sf)), R.taxa(spark, sf))
    return Ft.classify_features(pairs, use_family=True)


def _assignment(mode: str):
    klass = "family_class" if mode == "taxon_or_family_unique" else "assignment_class"

    @query(f"assigned_features_{mode}", f"""WITH {R.CLASS_SQL}
SELECT feature_id, {klass} AS assignment_class, CASE WHEN {MODE_SQL[mode]} THEN razor END AS assigned FROM cls""")
    def run(spark, sf):
        return assigned(spark, sf, mode).select("feature_id", "assignment_class", "assigned")

    return run


for _mode in MODE_SQL:
    _assignment(_mode)


@query("candidate_arrays_without_decoys", """
SELECT l_orderkey AS feature_id, array_to_string(list_sort(list(DISTINCT CASE WHEN l_suppkey < 10 THEN NULL ELSE 'P' || l_partkey END)
    FILTER (l_suppkey >= 10)), ',') AS candidates
FROM lineitem GROUP BY l_orderkey HAVING min(CASE WHEN l_suppkey < 10 THEN 'rev_' ELSE 'P' END || l_partkey) NOT LIKE 'rev_%'""")
def candidate_arrays_without_decoys(spark, sf):
    li = load(spark, sf, "lineitem")
    pid = F.concat(F.when(F.col("l_suppkey") < 10, "rev_").otherwise("P"), F.col("l_partkey").cast("string"))
    rows = li.groupBy(F.col("l_orderkey").alias("feature_id")).agg(
        F.min(pid).alias("razor"), F.collect_set(pid).alias("candidates"))
    clean = Q.prune_decoy_candidates(Q.drop_decoys(rows))
    return clean.select("feature_id", joined(F.array_sort("candidates")).alias("candidates"))


@query("candidate_taxa", f"""WITH {R.TAXA_SQL}, {R.CAND_SQL}
SELECT feature_id, protein_id, taxid, family_id FROM cand JOIN taxa USING (protein_id)""")
def candidate_taxa(spark, sf):
    pairs = Ft.attach_taxon(R.candidates(spark, sf), R.taxa(spark, sf))
    return Ft.attach_family(pairs, R.taxa(spark, sf))


# ---------------------------------------------------------------- roll-up
@query("protein_rollup_sum", f"""WITH {R.CLASS_SQL}, {R.FEATVAL_SQL}
SELECT razor AS protein_id, sample, round(sum(value), 2) AS value FROM fv JOIN cls USING (feature_id)
WHERE {MODE_SQL['taxon_unique']} GROUP BY ALL""")
def protein_rollup_sum(spark, sf):
    rows = Ft.assigned_values(R.feature_values(spark, sf), assigned(spark, sf))
    return Ft.rollup_sum(rows).select("protein_id", "sample", F.round("value", 2).alias("value"))


@query("razor_conserves_totals", f"""WITH {R.FEATVAL_SQL}
SELECT sample, round(sum(value), 2) AS total FROM fv GROUP BY sample""")
def razor_conserves_totals(spark, sf):
    rows = Ft.assigned_values(R.feature_values(spark, sf), assigned(spark, sf, "razor"))
    return Ft.rollup_sum(rows).groupBy("sample").agg(F.round(F.sum("value"), 2).alias("total"))


@query("median_polish_totals", f"""WITH {R.CLASS_SQL}, {R.FEATVAL_SQL}
SELECT razor AS protein_id, round(sum(value), 2) AS total, count(DISTINCT sample) AS n_samples
FROM fv JOIN cls USING (feature_id) GROUP BY ALL""")
def median_polish_totals(spark, sf):
    rows = Ft.assigned_values(R.feature_values(spark, sf), assigned(spark, sf, "razor"))
    out = Ft.rollup_median_polish(rows)
    return out.groupBy("protein_id").agg(F.round(F.sum("value"), 2).alias("total"), F.count("*").alias("n_samples"))


def polish_sql(sweeps: int) -> str:
    """The sweeps one after another: medians of features, then of samples, each with the effects' own median moved to the whole."""
    out = f"""WITH {R.CLASS_SQL}, {R.FEATVAL_SQL},
c0 AS (SELECT razor AS protein_id, feature_id, sample, value, log2(value) AS r, CAST(0 AS DOUBLE) AS fe, CAST(0 AS DOUBLE) AS se, CAST(0 AS DOUBLE) AS whole
  FROM fv JOIN cls USING (feature_id) WHERE value > 0)"""
    for i in range(2 * sweeps):
        side, effect, other = (("feature_id", "fe", "se"), ("sample", "se", "fe"))[i % 2]
        out += f""",
s{i} AS (SELECT protein_id, {side}, median(r) AS step, any_value({effect}) + median(r) AS e FROM c{i} GROUP BY ALL),
h{i} AS (SELECT protein_id, median(e) AS shift FROM s{i} GROUP BY protein_id),
c{i + 1} AS (SELECT protein_id, feature_id, sample, value, r - step AS r, e - shift AS {effect}, {other}, whole + shift AS whole
  FROM c{i} JOIN s{i} USING (protein_id, {side}) JOIN h{i} USING (protein_id))"""
    last = 2 * sweeps
    return out + f""",
moved AS (SELECT protein_id, max(abs(step)) <= 1e-12 AS converged FROM (SELECT protein_id, step FROM s{last - 2} UNION ALL SELECT protein_id, step FROM s{last - 1}) GROUP BY 1),
l AS (SELECT protein_id, sample, pow(2, any_value(whole + se)) AS level, sum(value) AS part FROM c{last} GROUP BY ALL)
SELECT protein_id, sample, round(log2(level * sum(part) OVER p / sum(level) OVER p), 6) AS log2_value, converged FROM l JOIN moved USING (protein_id) WINDOW p AS (PARTITION BY protein_id)"""


@query("median_polish_rollup", polish_sql(2))
def median_polish_rollup(spark, sf):
    """Two sweeps, so that SQL can state them; the production default is ten."""
    rows = Ft.assigned_values(R.feature_values(spark, sf), assigned(spark, sf, "razor"))
    out = Ft.rollup_median_polish(rows, iterations=2)
    return out.select("protein_id", "sample", F.round(F.log2("value"), 6).alias("log2_value"), "converged")


EVID_SQL = f"""{R.CLASS_SQL},
u AS (SELECT razor AS protein_id, assignment_class AS c, {MODE_SQL['taxon_unique']} AS used FROM cls),
ev AS (SELECT protein_id, count(*) FILTER (used) AS n_features_used, count(*) FILTER (used AND c = 'unique') AS n_unique,
  count(*) FILTER (used AND c = 'taxon_unique') AS n_taxon_unique, count(*) FILTER (NOT used) AS n_features_dropped
  FROM u GROUP BY protein_id)"""


@query("peptide_evidence", f"""WITH {EVID_SQL}
SELECT protein_id, n_features_used, n_unique, n_taxon_unique, CAST(0 AS BIGINT) AS n_family_unique,
  CAST(0 AS BIGINT) AS n_shared, CAST(0 AS BIGINT) AS n_shared_unknown_taxon, n_features_dropped,
  n_taxon_unique > n_unique AS taxon_unique_dominated, false AS shared_dominated,
  'sum' AS rollup_method, 'taxon_unique' AS peptide_assignment FROM ev""")
def peptide_evidence(spark, sf):
    return Ft.peptide_evidence(assigned(spark, sf))


@query("peptide_evidence_under_razor", f"""WITH {R.CLASS_SQL},
ev AS (SELECT razor AS protein_id, count(*) FILTER (assignment_class = 'unique') AS u,
  count(*) FILTER (assignment_class = 'taxon_unique') AS t, count(*) FILTER (assignment_class LIKE 'shared%') AS s
  FROM cls GROUP BY razor)
SELECT protein_id, t > u AS taxon_unique_dominated, s > u + t AS shared_dominated FROM ev""")
def peptide_evidence_under_razor(spark, sf):
    ev = Ft.peptide_evidence(assigned(spark, sf, "razor"), "razor")
    return ev.select("protein_id", "taxon_unique_dominated", "shared_dominated")


@query("dominance_rate", f"""WITH {EVID_SQL},
d AS (SELECT count(*) FILTER (n_features_used > 0) AS n_proteins,
  count(*) FILTER (n_features_used > 0 AND n_taxon_unique > n_unique) AS n_dominated,
  CAST(0 AS BIGINT) AS n_shared_dominated, count(*) FILTER (n_features_used = 0) AS n_left_out, false AS is_floor FROM ev)
SELECT n_proteins, n_dominated, n_shared_dominated, n_left_out, is_floor FROM d WHERE n_dominated > 0""")
def dominance_rate(spark, sf):
    return Ft.dominance_rate(Ft.peptide_evidence(assigned(spark, sf))).drop("percent")


@query("proteins_with_enough_features", f"""WITH {EVID_SQL}, {R.FEATVAL_SQL}
SELECT razor AS protein_id, sample, round(sum(value), 2) AS value FROM fv JOIN cls USING (feature_id)
WHERE {MODE_SQL['taxon_unique']} AND razor IN (SELECT protein_id FROM ev WHERE n_features_used >= 2) GROUP BY ALL""")
def proteins_with_enough_features(spark, sf):
    a = assigned(spark, sf)
    rolled = Ft.rollup_sum(Ft.assigned_values(R.feature_values(spark, sf), a))
    kept = Ft.min_features_per_protein(rolled, Ft.peptide_evidence(a), 2)
    return kept.select("protein_id", "sample", F.round("value", 2).alias("value"))


@query("feature_support_by_bin", f"""WITH {EVID_SQL}
SELECT p_type AS bin, CAST(median(n_features_used) AS DOUBLE) AS median_features
FROM ev JOIN part ON p_partkey = protein_id GROUP BY p_type""")
def feature_support_by_bin(spark, sf):
    from umbra.operators.bins import feature_support_by_bin as support

    part = load(spark, sf, "part").select(F.col("p_partkey").alias("protein_id"), F.col("p_type").alias("bin"))
    return support(Ft.peptide_evidence(assigned(spark, sf)).join(part, "protein_id"))


@query("proteins_named_by_quant", """
SELECT p_partkey AS protein_id FROM part WHERE p_partkey IN (SELECT l_partkey FROM lineitem)""")
def proteins_named_by_quant(spark, sf):
    return _subset(spark, sf)[0]


@query("quant_ids_without_sequence", """
SELECT DISTINCT l_partkey AS protein_id FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size > 10)""")
def quant_ids_without_sequence(spark, sf):
    return _subset(spark, sf, 10)[1]


def _subset(spark, sf, min_size=0):
    proteins = load(spark, sf, "part").where(F.col("p_size") > min_size).select(F.col("p_partkey").alias("protein_id"))
    feats = load(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("feature_id")).agg(
        F.collect_set("l_partkey").alias("candidates"))
    return Ft.subset_to_quant(proteins, feats)


@query("protein_subsample", "SELECT CAST(p_partkey AS VARCHAR) AS protein_id FROM part ORDER BY md5(CAST(p_partkey AS VARCHAR)), 1 LIMIT 500")
def protein_subsample(spark, sf):
    """A reproducible trial set."""
    proteins = load(spark, sf, "part").select(F.col("p_partkey").cast("string").alias("protein_id"))
    return Ft.subsample_proteins(proteins, 500)


# ---------------------------------------------------------------- samples and columns
@query("samples_mapped_to_columns", """
SELECT CASE WHEN l_linestatus = 'O' THEN l_returnflag || '_O' ELSE l_returnflag END AS sample,
  CASE WHEN l_linestatus = 'O' THEN l_returnflag || '_O' ELSE 'run' || l_returnflag END AS "column"
FROM lineitem GROUP BY ALL""")
def samples_mapped_to_columns(spark, sf):
    li = load(spark, sf, "lineitem").select("l_returnflag", "l_linestatus").distinct()
    status = F.when(F.col("l_linestatus") == "O", F.col("l_linestatus")).otherwise("")
    man = li.select(
        F.col("l_returnflag").alias("experiment"), status.alias("bioreplicate"),
        F.concat(F.lit("run"), "l_returnflag").alias("basename"), F.lit("/raw/x").alias("file"),
        F.when(status == "O", F.concat("l_returnflag", F.lit("_O"))).otherwise(F.col("l_returnflag")).alias("sample"))
    cols = li.select(F.when(status == "O", F.concat("l_returnflag", F.lit("_O"))).otherwise(
        F.concat(F.lit("run"), "l_returnflag")).alias("column"))
    return Q.map_samples_to_columns(man, cols)


WIDE_SAMPLES = [f"{f}{st}{h}" for f in "ANR" for st in "FO" for h in "12"]


@query("wide_quant", f"""WITH {R.PROTVAL_SQL}
SELECT protein_id, {", ".join(f"round(sum(value) FILTER (sample = '{x}'), 2) AS {x}" for x in WIDE_SAMPLES)}
FROM pv GROUP BY protein_id""")
def wide_quant(spark, sf):
    wide = K.wide_quant(R.protein_values(spark, sf), WIDE_SAMPLES)
    return wide.select("protein_id", *[F.round(x, 2).alias(x) for x in WIDE_SAMPLES])


@query("peptide_list", """
SELECT DISTINCT upper(regexp_replace(c_name || chr(65 + c_nationkey) || c_mktsegment, '[^A-Za-z]', '', 'g')) AS peptide FROM customer""")
def peptide_list(spark, sf):
    c = load(spark, sf, "customer")
    pep = F.concat("c_name", F.char(F.lit(65) + F.col("c_nationkey")), "c_mktsegment")
    return K.peptide_list(c.select(pep.alias("peptide")))


@query("wide_quant_written", f"""WITH {R.PROTVAL_SQL}
SELECT protein_id, {", ".join(f"round(sum(value) FILTER (sample = '{x}'), 2) AS {x}" for x in WIDE_SAMPLES)}
FROM pv GROUP BY protein_id""")
def wide_quant_written(spark, sf):
    """The wide table as read back from the published export, its columns in design order."""
    from bindings.reader_queries import scratch

    path = scratch(spark, "wide")
    samples = K.write_wide_quant(R.protein_values(spark, sf), R.design(spark, sf), path)
    wide = published(spark, path)["quant"]
    return wide.select("protein_id", *[F.round(x, 2).alias(x) for x in samples])


# A customer is a protein and an order status a contrast.
@query("linked_assays_written", f"""WITH r AS (SELECT o_custkey AS protein_id, o_orderstatus AS c, ln(avg(o_totalprice)) AS lfc,
    1 / ln(min(o_totalprice)) AS p_value, 1 / ln(max(o_totalprice)) AS q_value FROM orders GROUP BY ALL)
SELECT c_custkey AS protein_id, c_mktsegment AS bin, {", ".join(f"round(max({x}) FILTER (c = '{c}'), 6) AS de_{c.lower()}_{x}" for c in "FOP" for x in ("lfc", "p_value", "q_value"))}
FROM customer LEFT JOIN r ON protein_id = c_custkey GROUP BY ALL""")
def linked_assays_written(spark, sf):
    """Results folded in as columns, read back from the published tables."""
    from bindings.reader_queries import scratch

    orders, price = load(spark, sf, "orders"), F.col("o_totalprice")
    results = orders.groupBy(F.col("o_custkey").alias("protein_id"), F.col("o_orderstatus").alias("contrast")).agg(
        F.ln(F.avg(price)).alias("lfc"), (1 / F.ln(F.min(price))).alias("p_value"), (1 / F.ln(F.max(price))).alias("q_value"))
    annotation = load(spark, sf, "customer").select(F.col("c_custkey").alias("protein_id"), F.col("c_mktsegment").alias("bin"))
    tables = K.linked_assays(R.protein_values(spark, sf), annotation, R.design(spark, sf), results=results)
    proteins = K.write_linked_assays(tables, scratch(spark, "linked"))["proteins"]
    named = [F.round(f"`{c}`", 6).alias(c.lower().replace(".", "_")) for c in proteins.columns if c.startswith("DE.")]
    return proteins.select("protein_id", "bin", *named)


# ---------------------------------------------------------------- annotated quant
ANN_SIDE_SQL = """side AS (SELECT p_partkey AS protein_id, p_type AS bin, p_size AS export_score FROM part)"""


@query("annotated_quant", f"""WITH {R.PROTVAL_SQL}, {ANN_SIDE_SQL}
SELECT protein_id, sample, round(value, 2) AS value, bin, export_score FROM pv LEFT JOIN side USING (protein_id)""")
def annotated_quant(spark, sf):
    side = load(spark, sf, "part").select(
        F.col("p_partkey").alias("protein_id"), F.col("p_type").alias("bin"), F.col("p_size").alias("export_score"))
    out = Tb.annotate_quant(R.protein_values(spark, sf), [side])
    return out.select("protein_id", "sample", F.round("value", 2).alias("value"), "bin", "export_score")


@query("quant_funnel", f"""WITH {EVID_SQL},
steps AS (
  SELECT 0 AS step_order, 'annotated' AS step, 'protein' AS unit, (SELECT count(*) FROM part) AS "after"
  UNION ALL SELECT 1, 'named', 'protein', (SELECT count(*) FROM ev)
  UNION ALL SELECT 2, 'read', 'feature', (SELECT count(*) FROM cls)
  UNION ALL SELECT 3, 'assigned', 'feature', (SELECT count(*) FROM u WHERE used)
  UNION ALL SELECT 4, 'carrying', 'protein', (SELECT count(*) FROM ev WHERE n_features_used > 0)
  UNION ALL SELECT 5, 'two features', 'protein', (SELECT count(*) FROM ev WHERE n_features_used > 1))
SELECT CAST(step_order AS INTEGER) AS step_order, step, unit, lag("after") OVER w AS before, "after",
  lag("after") OVER w - "after" AS dropped, '' AS why FROM steps WINDOW w AS (PARTITION BY unit ORDER BY step_order)""")
def quant_funnel(spark, sf):
    ev = Ft.peptide_evidence(assigned(spark, sf))
    used = F.col("n_features_used")
    steps = [
        ("annotated", "protein", load(spark, sf, "part"), None), ("named", "protein", ev, None),
        ("read", "feature", ev, F.sum(used + F.col("n_features_dropped"))), ("assigned", "feature", ev, F.sum(used)),
        ("carrying", "protein", ev, F.count_if(used > 0)), ("two features", "protein", ev, F.count_if(used > 1)),
    ]
    return Tb.quant_funnel([Tb.Step(n, u, "", d, c) for n, u, d, c in steps])


@query("linked_assays", f"""WITH {R.CLASS_SQL}
SELECT razor AS protein_id, count(*) AS n_linked, count(*) FILTER (assignment_class = 'unique') AS n_unique
FROM cls WHERE {MODE_SQL['taxon_unique']} GROUP BY razor""")
def linked_assays(spark, sf):
    a = assigned(spark, sf)
    feats = R.features(spark, sf).withColumn("peptide", F.col("feature_id").cast("string"))
    tables = K.linked_assays(R.protein_values(spark, sf), R.taxa(spark, sf), R.design(spark, sf), feats,
                             R.feature_values(spark, sf), a)
    linked = lookup_join(tables["link"], tables["peptides"], ["feature_id"], "inner")
    return linked.groupBy("protein_id").agg(
        F.count("*").alias("n_linked"), F.count_if(F.col("assignment_class") == "unique").alias("n_unique"))


# ---------------------------------------------------------------- organisms
def owned_values(spark, sf) -> DataFrame:
    return lookup_join(R.protein_values(spark, sf), R.taxa(spark, sf).drop("family_id"), ["protein_id"])


@query("taxon_intensity", f"""WITH {R.PROTVAL_SQL}, {R.TAXA_SQL}
SELECT taxid, sample, round(sum(value), 2) AS value FROM pv JOIN taxa USING (protein_id) WHERE taxid IS NOT NULL GROUP BY ALL""")
def taxon_intensity(spark, sf):
    return O.taxon_intensity(owned_values(spark, sf)).withColumn("value", F.round("value", 2))


def factor_sql(minimum: int, where: str = "true") -> str:
    """The three methods in SQL: complete case, own samples, plain sum."""
    return f"""WITH {R.PROTVAL_SQL}, {R.TAXA_SQL},
x AS (SELECT taxid, protein_id, sample, value FROM pv JOIN taxa USING (protein_id)
  WHERE taxid IS NOT NULL AND value > 0 AND {where}),
p AS (SELECT taxid, protein_id, count(*) = (SELECT count(DISTINCT sample) FROM pv) AS complete, exp(avg(ln(value))) AS ref
  FROM x GROUP BY ALL),
t AS (SELECT taxid, count(*) AS n_members, count(*) FILTER (complete) AS n_complete,
  CASE WHEN count(*) < {minimum} THEN 'sum_fallback' WHEN count(*) FILTER (complete) >= {minimum} THEN 'median_of_ratios'
       ELSE 'median_of_ratios_poscounts' END AS planned FROM p GROUP BY taxid),
r AS (SELECT taxid, sample, planned, n_members, n_complete, sum(value) AS s,
  median(value / ref) FILTER (planned = 'median_of_ratios_poscounts' OR (planned = 'median_of_ratios' AND complete)) AS m,
  count(*) FILTER (planned = 'median_of_ratios_poscounts' OR (planned = 'median_of_ratios' AND complete)) AS n_ratios
  FROM x JOIN p USING (taxid, protein_id) JOIN t USING (taxid) GROUP BY ALL),
f AS (SELECT *, CASE WHEN planned = 'median_of_ratios_poscounts' AND n_ratios < {minimum} THEN NULL ELSE m END AS fac FROM r),
g AS (SELECT *, CASE WHEN count(fac) OVER (PARTITION BY taxid) = 0 THEN 'sum_fallback' ELSE planned END AS method,
  s / avg(s) OVER (PARTITION BY taxid) AS plain FROM f)
SELECT taxid, sample, round(CASE WHEN method = 'sum_fallback' THEN plain ELSE fac END, 6) AS factor, method,
  n_members, n_complete, n_ratios FROM g"""


@query("taxon_size_factors", factor_sql(4))
def taxon_size_factors(spark, sf):
    out = O.taxon_size_factors(owned_values(spark, sf), R.design(spark, sf), 4)
    return out.withColumn("factor", F.round("factor", 6))


@query("taxon_size_factors_fallbacks", factor_sql(75))
def taxon_size_factors_fallbacks(spark, sf):
    """A high minimum brings the taxa to the two other methods."""
    out = O.taxon_size_factors(owned_values(spark, sf), R.design(spark, sf), 75)
    return out.withColumn("factor", F.round("factor", 6))


@query("normalisation_risk", f"""WITH {R.TAXA_SQL},
d AS (SELECT taxid, l_returnflag AS method, l_discount - 0.05 AS lfc, abs(l_discount - 0.05) > 0.03 AS deviates,
  round(length(taxid) - 7.5, 1) AS f FROM lineitem JOIN taxa ON protein_id = l_partkey WHERE taxid IS NOT NULL),
t AS (SELECT taxid, f AS factor_log2fc, count(*) AS n_tested, count(*) FILTER (deviates) AS n_dev,
  count(*) FILTER (deviates AND sign(lfc) <> sign(f)) AS n_opposing, min(method) AS method FROM d GROUP BY ALL)
SELECT taxid, n_tested, n_dev, n_opposing, CASE WHEN method = 'sum_fallback' THEN 'fragile (too few proteins)'
  WHEN abs(factor_log2fc) > 0.4 AND n_dev >= 3 AND n_opposing / n_dev > 0.5 AND n_opposing / n_tested >= 0.3 THEN 'AT RISK'
  WHEN n_dev / n_tested > 0.5 THEN 'check (median in a sparse region)' ELSE 'ok' END AS assumption FROM t""")
def normalisation_risk(spark, sf):
    li = load(spark, sf, "lineitem")
    owned = lookup_join(li.withColumn("protein_id", F.col("l_partkey")), R.taxa(spark, sf), ["protein_id"]).where(
        "taxid IS NOT NULL")
    lfc = F.col("l_discount") - 0.05
    rows = owned.select(
        "taxid", F.col("l_returnflag").alias("method"), lfc.alias("lfc"), (F.abs(lfc) > 0.03).alias("deviates"),
        F.round(F.length("taxid") - 7.5, 1).alias("factor_log2fc"))
    out = O.normalisation_risk(rows, min_lfc=0.4, opposing=0.5)
    return out.select("taxid", "n_tested", "n_dev", "n_opposing", "assumption")


@query("result_table_written", """
SELECT p_partkey AS protein_id, p_brand AS taxid FROM part""")
def result_table_written(spark, sf):
    """The table as read back from storage, after its keys were checked."""
    from bindings.reader_queries import scratch

    rows = load(spark, sf, "part").select(F.col("p_partkey").alias("protein_id"), F.col("p_brand").alias("taxid"))
    return K.write_result_table(rows, scratch(spark, "result"), ["protein_id"])


@query("design_from_long_table", """
SELECT l_returnflag || l_shipyear AS sample, min(l_linestatus) AS "group" FROM (
  SELECT *, CAST(year(l_shipdate) AS VARCHAR) AS l_shipyear FROM lineitem) GROUP BY 1""")
def design_from_long_table(spark, sf):
    li = load(spark, sf, "lineitem")
    run = F.concat("l_returnflag", F.year("l_shipdate").cast("string"))
    rows = li.select(run.alias("run"), "l_linestatus", F.col("l_partkey").cast("string").alias("p"),
                     F.col("l_orderkey").cast("string").alias("f"), "l_extendedprice")
    q = Q.long_features(rows, F.col("p"), F.col("f"), F.col("f"), F.col("run"), F.col("l_extendedprice"),
                        F.col("l_linestatus"), F.col("run"))
    return q.design.select("sample", "group")
