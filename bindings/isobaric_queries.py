"""Isobaric operators: the return flag is the plex and the line status the condition."""

from __future__ import annotations

from pyspark.sql import functions as F

from bindings import registry as R
from bindings.registry import load, query
from umbra.operators import design as Dg
from umbra.operators import isobaric as I
from umbra.sources import plexes as X


@query("feature_plex_histogram", """
SELECT n_plexes, count(*) AS n FROM (SELECT l_orderkey, count(DISTINCT l_returnflag) AS n_plexes FROM lineitem GROUP BY 1) GROUP BY 1""")
def feature_plex_histogram(spark, sf):
    return I.plex_histogram(I.feature_plexes(R.feature_values(spark, sf)))


@query("features_in_enough_plexes", f"""WITH {R.FEATVAL_SQL},
k AS (SELECT feature_id FROM fv GROUP BY 1 HAVING count(DISTINCT plex) >= 3)
SELECT feature_id, sample, round(value, 2) AS value FROM fv WHERE feature_id IN (FROM k)""")
def features_in_enough_plexes(spark, sf):
    out = I.feature_min_plexes(R.feature_values(spark, sf), 3)
    return out.select("feature_id", "sample", F.round("value", 2).alias("value"))


@query("purity_filter", """
WITH f AS (SELECT DISTINCT l_returnflag AS plex, l_orderkey AS feature_id FROM lineitem),
m AS (SELECT l_returnflag AS plex, l_orderkey AS feature_id, median(1 - l_tax) AS median_purity
  FROM lineitem WHERE l_linestatus = 'F' GROUP BY ALL)
SELECT plex, feature_id, round(median_purity, 6) AS median_purity, CASE WHEN median_purity IS NULL THEN 'unmatched'
  WHEN median_purity >= 0.955 THEN 'kept' ELSE 'dropped' END AS purity_state FROM f LEFT JOIN m USING (plex, feature_id)""")
def purity_filter(spark, sf):
    li = load(spark, sf, "lineitem").select(
        F.col("l_returnflag").alias("plex"), F.col("l_orderkey").alias("feature_id"), "l_linestatus",
        (1 - F.col("l_tax")).alias("purity"))
    out = I.purity_filter(li.select("plex", "feature_id").distinct(), li.where("l_linestatus = 'F'"), 0.955)
    return out.withColumn("median_purity", F.round("median_purity", 6))


FACTOR_SQL = f"""{R.FEATVAL_SQL},
c AS (SELECT plex, sample, median(value) AS channel_median FROM fv GROUP BY ALL),
k AS (SELECT *, median(channel_median) OVER (PARTITION BY plex) AS plex_median FROM c)"""


@query("channel_factors", f"""WITH {FACTOR_SQL}
SELECT plex, sample, round(channel_median, 4) AS channel_median, round(plex_median, 4) AS plex_median,
  round(plex_median / channel_median, 6) AS factor FROM k""")
def channel_factors(spark, sf):
    out = I.channel_factors(R.feature_values(spark, sf))
    return out.select("plex", "sample", F.round("channel_median", 4).alias("channel_median"),
                      F.round("plex_median", 4).alias("plex_median"), F.round("factor", 6).alias("factor"))


@query("channel_median_normalise", f"""WITH {FACTOR_SQL}
SELECT plex, sample, feature_id, round(value * plex_median / channel_median, 4) AS value FROM fv JOIN k USING (plex, sample)""")
def channel_median_normalise(spark, sf):
    out = I.channel_median_normalise(R.feature_values(spark, sf))
    return out.select("plex", "sample", "feature_id", F.round("value", 4).alias("value"))


@query("under_corrected_channels", f"""WITH {FACTOR_SQL},
n AS (SELECT plex, sample, count(value) AS seen FROM fv GROUP BY ALL),
f AS (SELECT plex, count(DISTINCT feature_id) AS feats FROM fv GROUP BY 1),
m AS (SELECT plex, sample, plex_median / channel_median AS factor, 1 - seen / feats AS missing FROM k JOIN n USING (plex, sample) JOIN f USING (plex)),
p AS (SELECT *, median(missing) OVER (PARTITION BY plex) AS peer, greatest(factor, 1 / factor) AS fold FROM m)
SELECT plex, sample, round(missing, 6) AS missing, round(fold, 6) AS fold, fold >= 1.001 AND missing >= peer + 0.1 AS under_corrected FROM p""")
def under_corrected_channels(spark, sf):
    out = I.under_corrected_channels(R.feature_values(spark, sf), 1.001, 0.1)
    return out.select("plex", "sample", F.round("missing", 6).alias("missing"), F.round("fold", 6).alias("fold"),
                      "under_corrected")


REF_SQL = f"""{R.FEATVAL_SQL},
rf AS (SELECT plex, feature_id, value AS r FROM fv WHERE sample LIKE '%F1'),
ra AS (SELECT plex, feature_id, sample, value, value / nullif(r, 0) AS ratio FROM fv LEFT JOIN rf USING (plex, feature_id)
  WHERE sample NOT LIKE '%F1')"""


def reference_ratios(spark, sf):
    refs = X.resolve_reference(R.design(spark, sf), name="*F1")
    return I.reference_ratios(R.feature_values(spark, sf), refs)


@query("reference_ratios", f"""WITH {REF_SQL}
SELECT plex, feature_id, sample, round(ratio, 6) AS ratio FROM ra""")
def reference_ratio_values(spark, sf):
    return reference_ratios(spark, sf).select("plex", "feature_id", "sample", F.round("ratio", 6).alias("ratio"))


@query("reference_losses", f"""WITH {REF_SQL}
SELECT plex, count(value) AS n_values, count(*) FILTER (ratio IS NULL) AS n_lost,
  round(100.0 * count(*) FILTER (ratio IS NULL) / count(value), 6) AS pct_lost FROM ra GROUP BY plex""")
def reference_losses(spark, sf):
    return I.reference_losses(reference_ratios(spark, sf)).withColumn("pct_lost", F.round("pct_lost", 6))


@query("references_resolved", f"""WITH {R.DESIGN_SQL}
SELECT sample, plex, "group", sample LIKE '%F1' AS is_reference FROM design""")
def references_resolved(spark, sf):
    return X.resolve_reference(R.design(spark, sf), name="*F1")


@query("samples_without_reference", f"""WITH {R.FEATVAL_SQL}
SELECT sample, count(*) AS n FROM fv WHERE sample NOT LIKE '%F1' GROUP BY sample""")
def samples_without_reference(spark, sf):
    refs = X.resolve_reference(R.design(spark, sf), name="*F1")
    return I.drop_references(R.feature_values(spark, sf), refs).groupBy("sample").agg(F.count("*").alias("n"))


@query("channels_in_use", """
SELECT s_name AS sample, 'Supplier#' || lpad('', 1, '0') AS plex, CAST(s_suppkey AS VARCHAR) AS channel FROM supplier WHERE s_nationkey >= 5""")
def channels_in_use(spark, sf):
    sup = load(spark, sf, "supplier")
    plex, ch = F.lit("Supplier#0"), F.col("s_suppkey").cast("string")
    sample = F.when(F.col("s_nationkey") < 5, F.concat_ws("_", plex, ch)).otherwise(F.col("s_name"))
    return I.drop_empty_channels(sup.select(sample.alias("sample"), plex.alias("plex"), ch.alias("channel")))


@query("plex_exposure", f"""WITH {R.TAXA_SQL},
s AS (SELECT DISTINCT taxid, protein_id, l_returnflag AS plex FROM lineitem JOIN taxa ON protein_id = l_partkey
  WHERE taxid IS NOT NULL),
p AS (SELECT taxid, protein_id, count(*) = 3 AS complete FROM s GROUP BY ALL),
t AS (SELECT taxid, count(*) FILTER (complete) AS c FROM p GROUP BY taxid)
SELECT count(*) FILTER (c < 40) AS n_exposed, count(*) AS n_taxa FROM t""")
def plex_exposure(spark, sf):
    from umbra.plans.joins import lookup_join

    li = load(spark, sf, "lineitem").select(
        F.col("l_partkey").alias("protein_id"), F.col("l_returnflag").alias("plex"), F.col("l_extendedprice").alias("value"))
    return I.plex_exposure(lookup_join(li, R.taxa(spark, sf), ["protein_id"]), 40)


@query("condition_by_plex", f"""WITH {R.DESIGN_SQL}
SELECT plex, "group", count(*) AS n_samples FROM design GROUP BY ALL""")
def condition_by_plex(spark, sf):
    return I.condition_by_plex(R.design(spark, sf))


@query("confounding_check", """
WITH d AS (SELECT c_custkey, n_regionkey AS plex, c_mktsegment AS g, c_nationkey AS ds FROM customer JOIN nation ON n_nationkey = c_nationkey),
c AS (SELECT ds, plex, g, count(*) AS n FROM d GROUP BY ALL)
SELECT ds, count(DISTINCT plex) AS n_plexes, count(DISTINCT g) AS n_groups,
  count(DISTINCT plex) * count(DISTINCT g) - count(*) AS n_empty_cells, count(*) FILTER (n = 1) AS n_single_sample_cells, false AS confounded
FROM c GROUP BY ds""")
def confounding_check(spark, sf):
    c = load(spark, sf, "customer").join(F.broadcast(load(spark, sf, "nation")), F.col("n_nationkey") == F.col("c_nationkey"))
    d = c.select(F.col("c_nationkey").alias("ds"), F.col("n_regionkey").alias("plex"), F.col("c_mktsegment").alias("group"))
    return I.confounding_check(d, ["ds"]).drop("n_single_sample_plexes")


@query("condition_from_names", """
SELECT c_custkey, c_mktsegment AS "group" FROM customer""")
def condition_from_names(spark, sf):
    c = load(spark, sf, "customer")
    d = c.select("c_custkey", F.concat_ws("_", "c_mktsegment", F.col("c_custkey").cast("string")).alias("sample"))
    return Dg.condition_from_name(d).select("c_custkey", "group")


@query("condition_from_regex", """
SELECT c_custkey, substr(c_name, 1, 4) AS "group" FROM customer""")
def condition_from_regex(spark, sf):
    c = load(spark, sf, "customer").select("c_custkey", F.col("c_name").alias("sample"))
    return Dg.condition_from_name(c, r"^(\w{4})\w*#").select("c_custkey", "group")


@query("stable_sample_order", """
SELECT s_suppkey, CAST(row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) AS INTEGER) AS sample_order FROM supplier""")
def stable_sample_order(spark, sf):
    sup = load(spark, sf, "supplier")
    d = sup.select("s_suppkey", "s_nationkey", F.concat(F.lit("TMT"), F.col("s_suppkey").cast("string")).alias("plex"),
                   F.col("s_name").alias("sample"))
    return Dg.stable_sample_order(d, ["s_nationkey"]).select("s_suppkey", "sample_order")
