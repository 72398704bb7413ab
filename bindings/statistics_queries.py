"""Filters, models, multiple testing, enrichment and the shortlist."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bindings import registry as R
from bindings.registry import load, query
from umbra.operators import coding as C
from umbra.operators import filters as Fl
from umbra.operators import models as M
from umbra.operators import organisms as O
from umbra.operators import tables as Tb
from umbra.plans.joins import lookup_join


def values(spark, sf) -> DataFrame:
    """Part x sample sums; a part without a line in a sample has no row."""
    return R.protein_values(spark, sf).select("protein_id", "sample", "value")


def log_values(spark, sf) -> DataFrame:
    return values(spark, sf).withColumn("value", F.log2("value"))


# ---------------------------------------------------------------- filters
FLAG_SQL = f"""{R.PROTVAL_SQL},
lv AS (SELECT protein_id, "group", count(value) AS n FROM pv GROUP BY ALL),
fl AS (SELECT protein_id, count(*) FILTER (n >= 6) AS n_levels_valid, 2::BIGINT AS n_levels,
  count(*) FILTER (n >= 6) = 2 AS keep_valid FROM lv GROUP BY 1),
px AS (SELECT protein_id, count(DISTINCT plex) AS n_plexes FROM pv GROUP BY 1),
fx AS (SELECT *, n_plexes >= 3 AS keep_plex FROM fl JOIN px USING (protein_id))"""


@query("protein_filters", f"WITH {FLAG_SQL} FROM fx")
def protein_filters(spark, sf):
    return Fl.protein_filters(values(spark, sf), R.design(spark, sf), 6, 3)


@query("filter_report", f"""WITH {FLAG_SQL}
SELECT count(*) AS n_proteins, count(*) FILTER (NOT keep_valid) AS removed_by_valid, count(*) FILTER (NOT keep_plex) AS removed_by_plex,
  count(*) FILTER (keep_valid AND NOT keep_plex) AS removed_by_plex_only, count(*) FILTER (keep_valid AND n_plexes = 1) AS valid_in_one_plex,
  count(*) FILTER (keep_valid AND keep_plex) AS n_kept FROM fx""")
def filter_report(spark, sf):
    return Fl.filter_report(Fl.protein_filters(values(spark, sf), R.design(spark, sf), 6, 3))


@query("zero_variance_proteins", """
WITH v AS (SELECT l_orderkey AS protein_id, l_returnflag AS g, max(l_linenumber) - min(l_linenumber) AS r FROM lineitem GROUP BY ALL)
SELECT protein_id FROM v GROUP BY 1 HAVING max(r) = 0""")
def zero_variance_proteins(spark, sf):
    li = load(spark, sf, "lineitem")
    v = li.select(F.col("l_orderkey").alias("protein_id"), F.col("l_returnflag").alias("sample"), F.col("l_linenumber").alias("value"))
    d = v.select("sample", F.col("sample").alias("group")).distinct()
    return Fl.zero_variance(v, d)


@query("sample_median_shift", f"""WITH {R.PROTVAL_SQL},
l AS (SELECT protein_id, sample, log2(value) AS v FROM pv), m AS (SELECT sample, median(v) AS md FROM l GROUP BY 1)
SELECT protein_id, sample, round(v - md, 6) AS value FROM l JOIN m USING (sample)""")
def sample_median_shift(spark, sf):
    return Fl.sample_median_shift(log_values(spark, sf)).select("protein_id", "sample", F.round("value", 6).alias("value"))


# ---------------------------------------------------------------- models
FIT_SQL = f"""{R.PROTVAL_SQL},
g AS (SELECT protein_id, "group", avg(log2(value)) AS m, count(*) AS n, var_pop(log2(value)) * count(*) AS ss FROM pv GROUP BY ALL),
fit AS (SELECT protein_id, sum(n) AS n_observed, sum(ss) / nullif(sum(n) - count(*), 0) AS sigma2, sum(n) - count(*) AS df_residual,
  max(m) FILTER ("group" = 'O') - max(m) FILTER ("group" = 'F') AS lfc, sqrt(sum(1.0 / n)) AS su, count(*) AS k FROM g GROUP BY 1)"""


@query("protein_models", f"""WITH {FIT_SQL}
SELECT protein_id, CAST(n_observed AS BIGINT) AS n_observed, CAST(df_residual AS BIGINT) AS df_residual, round(sigma2, 6) AS sigma2,
  CASE WHEN k = 2 THEN round(lfc, 6) END AS lfc, CASE WHEN k = 2 THEN round(su, 6) END AS stdev_unscaled FROM fit""")
def protein_models(spark, sf):
    fits = M.fit_proteins(log_values(spark, sf), R.design(spark, sf))
    c = F.get("contrasts", 0)
    return fits.select("protein_id", "n_observed", "df_residual", F.round("sigma2", 6).alias("sigma2"),
                       F.round(c["lfc"], 6).alias("lfc"), F.round(c["stdev_unscaled"], 6).alias("stdev_unscaled"))


@query("protein_contrasts_unmoderated", f"""WITH {FIT_SQL}
SELECT protein_id, 'O_vs_F' AS contrast, round(lfc, 6) AS lfc, round(lfc / (su * sqrt(sigma2)), 4) AS t FROM fit
WHERE k = 2 AND df_residual > 0""")
def protein_contrasts_unmoderated(spark, sf):
    fits = M.fit_proteins(log_values(spark, sf), R.design(spark, sf))
    out = M.moderated_contrasts(fits, moderate=False)
    return out.select("protein_id", "contrast", F.round("lfc", 6).alias("lfc"), F.round("t", 4).alias("t"))


# Closed forms of the digamma and trigamma functions at half a whole number d.
_HALF = "list_sum(list_transform(range(1, {n}), lambda k: {term}))"
DIGAMMA_HALF = f"""-0.5772156649015329 + CASE WHEN d % 2 = 0 THEN coalesce({_HALF.format(n="d // 2", term="1.0 / k")}, 0)
    ELSE coalesce({_HALF.format(n="(d + 1) // 2", term="2.0 / (2 * k - 1)")}, 0) - 2 * ln(2.0) END"""
TRIGAMMA_HALF = f"""CASE WHEN d % 2 = 0 THEN pi() ** 2 / 6 - coalesce({_HALF.format(n="d // 2", term="1.0 / (k * k)")}, 0)
    ELSE pi() ** 2 / 2 - coalesce({_HALF.format(n="(d + 1) // 2", term="4.0 / ((2 * k - 1) * (2 * k - 1))")}, 0) END"""


def _digamma(x: str) -> str:
    """At any x: 40 steps up, then the asymptotic series."""
    y = f"({x} + 40)"
    return f"(ln{y} - 1 / (2 * {y}) - 1 / (12 * {y} ** 2) + 1 / (120 * {y} ** 4) - list_sum(list_transform(range(40), lambda k: 1 / ({x} + k))))"


def _trigamma(x: str) -> str:
    y = f"({x} + 40)"
    return f"(1 / {y} + 1 / (2 * {y} ** 2) + 1 / (6 * {y} ** 3) - 1 / (30 * {y} ** 5) + list_sum(list_transform(range(40), lambda k: 1 / ({x} + k) ** 2)))"


def moderated_sql(x: str, fit: str) -> str:
    """CTEs that end in {x}q: the moderated, adjusted contrasts of {fit}, a row for each protein.

    The prior's degrees of freedom come from a bisection of the trigamma function, and the
    tail of t from the power series of the incomplete beta function.
    """
    mid = "sqrt(lo * hi)"
    return f"""{x}m AS (SELECT median(sigma2) AS mid FROM {fit} WHERE df_residual > 0),
{x}e AS (SELECT d, ln(greatest(sigma2, 1e-5 * mid, 1e-300)) + ln(d / 2.0) - ({DIGAMMA_HALF}) AS e, {TRIGAMMA_HALF} AS tri
  FROM (SELECT df_residual AS d, sigma2 FROM {fit} WHERE df_residual > 0), {x}m),
{x}v AS (SELECT avg(e) AS mean, var_samp(e) - avg(tri) AS v, sum(d) AS pooled FROM {x}e),
{x}b AS (SELECT v, CAST(1e-8 AS DOUBLE) AS lo, CAST(1e8 AS DOUBLE) AS hi, 0 AS i FROM {x}v WHERE v > 0
  UNION ALL SELECT v, CASE WHEN {_trigamma(mid)} > v THEN {mid} ELSE lo END, CASE WHEN {_trigamma(mid)} > v THEN hi ELSE {mid} END, i + 1
  FROM {x}b WHERE i < 120),
{x}p AS (SELECT pooled, 2 * h AS d0, exp(mean + CASE WHEN h IS NULL THEN 0 ELSE {_digamma("h")} - ln(h) END) AS s0
  FROM {x}v LEFT JOIN (SELECT {mid} AS h FROM {x}b WHERE i = 120) ON true),
{x}s AS (SELECT f.*, CASE WHEN df_residual = 0 OR d0 IS NULL THEN s0 ELSE (df_residual * sigma2 + d0 * s0) / (df_residual + d0) END AS s2_post,
  CAST(CASE WHEN d0 IS NULL THEN pooled ELSE least(df_residual + d0, pooled) END AS DOUBLE) AS df_total FROM {fit} f, {x}p),
{x}t AS (SELECT *, lfc / (su * sqrt(s2_post)) AS t FROM {x}s),
{x}z AS (SELECT *, df_total / (df_total + t * t) < 0.5 AS direct, df_total / (df_total + t * t) AS xx FROM {x}t),
{x}y AS (SELECT *, CASE WHEN direct THEN df_total / 2 ELSE 0.5 END AS a, CASE WHEN direct THEN 0.5 ELSE df_total / 2 END AS b,
  CASE WHEN direct THEN xx ELSE t * t / (df_total + t * t) END AS w FROM {x}z),
{x}r AS (SELECT *, CASE WHEN t = 0 THEN 1.0 WHEN direct THEN tail ELSE 1 - tail END AS p_value FROM (
  SELECT *, exp(lgamma(a + b) - lgamma(a) - lgamma(b) + a * ln(w) + b * ln(1 - w)) / a
    * list_reduce(list_prepend(CAST(1 AS DOUBLE), list_transform(range(500), lambda k: CAST(500 - k AS DOUBLE))), lambda so, k: 1 + (a + b + k - 1) / (a + k) * w * so) AS tail
  FROM {x}y WHERE t IS NOT NULL)),
{x}w AS (SELECT protein_id, contrast, p_value, p_value * count(*) OVER (PARTITION BY contrast) / count(*) OVER (PARTITION BY contrast ORDER BY p_value) AS raw FROM {x}r),
{x}q AS (SELECT s.*, t, p_value, q_value FROM {x}t s LEFT JOIN (
  SELECT protein_id, p_value, least(1.0, min(raw) OVER (PARTITION BY contrast ORDER BY p_value DESC)) AS q_value FROM {x}w) USING (protein_id))"""


# With two conditions the model with plexes is a regression within plexes: sums of squares and products about each plex's mean.
def plex_fit_sql(source: str, x: str = "") -> str:
    """CTEs {x}bl, {x}sq and {x}fit from protein_id, plex, "group" and v of {source}."""
    return f"""{x}bl AS (SELECT protein_id, plex, count(*) AS n, var_pop(v) * count(*) AS syy,
    count(*) FILTER ("group" = 'O') * count(*) FILTER ("group" = 'F') / count(*) AS sxx,
    coalesce(avg(v) FILTER ("group" = 'O') - avg(v) FILTER ("group" = 'F'), 0) * count(*) FILTER ("group" = 'O') * count(*) FILTER ("group" = 'F') / count(*) AS sxy
  FROM {source} GROUP BY ALL),
{x}sq AS (SELECT protein_id, sum(n) AS n, count(*) AS k, sum(syy) AS syy, nullif(sum(sxx), 0) AS sxx, sum(sxy) AS sxy FROM {x}bl GROUP BY protein_id),
{x}fit AS (SELECT protein_id, CAST(n AS BIGINT) AS n_observed, CAST(n - k - (sxx IS NOT NULL)::INT AS BIGINT) AS df_residual,
  (syy - coalesce(sxy * sxy / sxx, 0)) / nullif(n - k - (sxx IS NOT NULL)::INT, 0) AS sigma2,
  CASE WHEN sxx IS NOT NULL THEN 'O_vs_F' END AS contrast, sxy / sxx AS lfc, 1 / sqrt(sxx) AS su FROM {x}sq)"""


CENTRED_SQL = f"""{R.PROTVAL_SQL},
lg AS (SELECT protein_id, sample, plex, "group", log2(value) AS v FROM pv),
md AS (SELECT sample, median(v) AS md FROM lg GROUP BY sample),
ce AS (SELECT protein_id, sample, plex, "group", v - md AS v FROM lg JOIN md USING (sample))"""
TESTED_COLUMNS = ("lfc", "sigma2", "s2_post", "df_total", "stdev_unscaled", "t", "p_value", "q_value")


def tested_sql(q: str) -> str:
    cells = ", ".join(f"round({c.replace('stdev_unscaled', 'su')}, 6) AS {c}" for c in TESTED_COLUMNS)
    return f"SELECT protein_id, contrast, n_observed, df_residual, {cells} FROM {q}"


def tested(out: DataFrame) -> DataFrame:
    return out.select("protein_id", "contrast", "n_observed", "df_residual", *[F.round(c, 6).alias(c) for c in TESTED_COLUMNS])


@query("protein_models_with_plex", f"""WITH {R.PROTVAL_SQL}, lg AS (SELECT protein_id, plex, "group", log2(value) AS v FROM pv), {plex_fit_sql("lg")}
SELECT protein_id, n_observed, df_residual, round(sigma2, 6) AS sigma2, contrast, round(lfc, 6) AS lfc, round(su, 6) AS stdev_unscaled FROM fit WHERE contrast IS NOT NULL""")
def protein_models_with_plex(spark, sf):
    fits = M.fit_proteins(log_values(spark, sf), R.design(spark, sf), "~ 0 + group + plex")
    rows = fits.select("protein_id", "n_observed", "sigma2", "df_residual", F.explode("contrasts").alias("c"))
    return rows.select("protein_id", "n_observed", "df_residual", F.round("sigma2", 6).alias("sigma2"), "c.contrast",
                       F.round("c.lfc", 6).alias("lfc"), F.round("c.stdev_unscaled", 6).alias("stdev_unscaled"))


@query("differential_abundance", f"WITH RECURSIVE {CENTRED_SQL}, {plex_fit_sql('ce')}, {moderated_sql('x', 'fit')} {tested_sql('xq')}")
def differential_abundance(spark, sf):
    centred = Fl.sample_median_shift(log_values(spark, sf))
    return tested(M.differential_abundance(centred, R.design(spark, sf), ("group", "plex")))


# A supplier is a protein, and status, half of the order and ship month are a sample.
CELLS_SQL = """sv AS (SELECT l_suppkey AS protein_id, l_linestatus AS "group", CASE WHEN bool_and(l_linenumber <= 3) THEN '1' ELSE '2' END AS plex, log2(sum(l_extendedprice)) AS v
  FROM lineitem GROUP BY l_suppkey, l_linestatus, l_linenumber <= 3, month(l_shipdate)),
sc AS (SELECT protein_id, "group" || plex AS c, avg(v) AS m FROM sv GROUP BY ALL),
sw AS (SELECT protein_id, max(m) FILTER (c = 'F1') AS f1, max(m) FILTER (c = 'F2') AS f2, max(m) FILTER (c = 'O1') AS o1, max(m) FILTER (c = 'O2') AS o2 FROM sc GROUP BY 1)"""


def _month_values(spark, sf):
    """values and design of suppliers by status, half and month."""
    li = load(spark, sf, "lineitem")
    half, month = F.when(F.col("l_linenumber") <= 3, "1").otherwise("2"), F.month("l_shipdate").cast("string")
    rows = li.select(F.col("l_suppkey").alias("protein_id"), F.concat_ws("|", "l_linestatus", half, month).alias("sample"),
                     F.col("l_linestatus").alias("group"), half.alias("plex"), "l_extendedprice")
    values = rows.groupBy("protein_id", "sample").agg(F.log2(F.sum("l_extendedprice")).alias("value"))
    return values, rows.select("sample", "group", "plex").distinct()


@query("interaction_model", f"""WITH {CELLS_SQL}
SELECT protein_id, round(f1, 6) AS "groupF", round(o1, 6) AS "groupO", round(f2 - f1, 6) AS "plex2", round(o2 - o1 - f2 + f1, 6) AS interaction
FROM sw WHERE f1 + f2 + o1 + o2 IS NOT NULL""")
def interaction_model(spark, sf):
    """Coefficients of `~ 0 + group * plex`; the last one is the difference between plexes of the difference between groups."""
    values, design = _month_values(spark, sf)
    fits = M.fit_proteins(values, design, "~ 0 + group * plex").where("forall(coefficients, c -> c.estimate IS NOT NULL)")
    of = lambda name: F.get(F.filter("coefficients", lambda c: c["coefficient"] == name), F.lit(0))["estimate"]
    return fits.select("protein_id", *[F.round(of(n), 6).alias(m) for n, m in (("groupF", "groupF"), ("groupO", "groupO"), ("plex2", "plex2"), ("groupO:plex2", "interaction"))])


@query("interaction_contrast", f"""WITH {CELLS_SQL}
SELECT protein_id, 'change_of_change' AS contrast, round(o2 - o1 - f2 + f1, 6) AS lfc FROM sw WHERE f1 + f2 + o1 + o2 IS NOT NULL""")
def interaction_contrast(spark, sf):
    """A contrast given by weights of cell means."""
    values, design = _month_values(spark, sf)
    weights = {"change_of_change": {"groupO:plex2": 1.0, "groupO:plex1": -1.0, "groupF:plex2": -1.0, "groupF:plex1": 1.0}}
    fits = M.fit_proteins(values, design, ("group:plex",), contrasts=weights)
    return fits.select("protein_id", F.explode("contrasts").alias("c")).select("protein_id", "c.contrast", F.round("c.lfc", 6).alias("lfc"))


@query("covariate_model", """WITH sv AS (SELECT l_suppkey AS protein_id, l_linestatus AS g, (year(l_shipdate) - 1992) * 12.0 + month(l_shipdate) AS age,
  log2(sum(l_extendedprice)) AS v FROM lineitem GROUP BY ALL),
r AS (SELECT protein_id, g, regr_intercept(v, age) AS i, regr_slope(v, age) AS s FROM sv GROUP BY ALL HAVING count(*) > 1),
w AS (SELECT protein_id, max(i) FILTER (g = 'F') AS fi, max(s) FILTER (g = 'F') AS fs, max(i) FILTER (g = 'O') AS oi, max(s) FILTER (g = 'O') AS os FROM r GROUP BY 1)
SELECT protein_id, round(fi, 6) AS "groupF", round(oi, 6) AS "groupO", round(fs, 6) AS age, round(os - fs, 6) AS interaction FROM w WHERE fs + os IS NOT NULL""")
def covariate_model(spark, sf):
    """Coefficients of `~ 0 + group + age + group:age`: a slope, and how another group's slope differs."""
    li = load(spark, sf, "lineitem")
    age = (F.year("l_shipdate") - 1992) * 12.0 + F.month("l_shipdate")
    rows = li.select(F.col("l_suppkey").alias("protein_id"), F.concat_ws("|", "l_linestatus", age.cast("string")).alias("sample"),
                     F.col("l_linestatus").alias("group"), age.cast("double").alias("age"), "l_extendedprice")
    values = rows.groupBy("protein_id", "sample").agg(F.log2(F.sum("l_extendedprice")).alias("value"))
    fits = M.fit_proteins(values, rows.select("sample", "group", "age").distinct(), "~ 0 + group + age + group:age")
    of = lambda name: F.get(F.filter("coefficients", lambda c: c["coefficient"] == name), F.lit(0))["estimate"]
    fits = fits.where("forall(coefficients, c -> c.estimate IS NOT NULL)")
    return fits.select("protein_id", *[F.round(of(n), 6).alias(m) for n, m in (("groupF", "groupF"), ("groupO", "groupO"), ("age", "age"), ("groupO:age", "interaction"))])


# Orders are samples and nations data sets; in every third nation the plex repeats the condition.
@query("design_ranks", """WITH d AS (SELECT c_nationkey AS nation, o_orderstatus AS g, CASE WHEN c_nationkey % 3 = 0 THEN o_orderstatus ELSE o_orderpriority END AS x
  FROM orders JOIN customer ON c_custkey = o_custkey),
n AS (SELECT nation, count(*) AS n, count(DISTINCT g) AS g, count(DISTINCT x) AS x, list_sort(list_distinct(list(x))) AS l FROM d GROUP BY 1)
SELECT nation, n AS n_samples, g + x - 1 AS n_coefficients, CASE WHEN nation % 3 = 0 THEN g ELSE g + x - 1 END AS rank,
  n - CASE WHEN nation % 3 = 0 THEN g ELSE g + x - 1 END AS df_residual,
  CASE WHEN nation % 3 = 0 THEN array_to_string(list_transform(l[2:], lambda y: 'plex' || y), ',') ELSE '' END AS aliased,
  concat_ws(',', CASE WHEN g < 2 THEN 'group' END, CASE WHEN x < 2 THEN 'plex' END) AS one_level FROM n""")
def design_ranks(spark, sf):
    orders, customers = load(spark, sf, "orders"), load(spark, sf, "customer")
    plex = F.when(F.col("c_nationkey") % 3 == 0, F.col("o_orderstatus")).otherwise(F.col("o_orderpriority"))
    design = lookup_join(orders.withColumnRenamed("o_custkey", "c_custkey"), customers, ["c_custkey"], "inner").select(
        F.col("c_nationkey").alias("nation"), F.col("o_orderkey").alias("sample"), F.col("o_orderstatus").alias("group"), plex.alias("plex"))
    out = C.design_ranks(design, "~ 0 + group + plex", ["nation"])
    return out.withColumns({c: F.array_join(c, ",") for c in ("aliased", "one_level")})


def _ratio_models_sql() -> str:
    """Both models of the proteins with a usable organism: on log2 values, and on those minus the organism's log2 factor."""
    body = _ratio_sql().split("\nSELECT protein_id, round(avg(v)")[0]
    fit = lambda x, v, where: f"""{x}c AS (SELECT protein_id, "group", avg({v}) AS m, count(*) AS n, var_pop({v}) * count(*) AS ss FROM ratios WHERE {where} GROUP BY ALL),
{x}f AS (SELECT protein_id, CAST(sum(n) AS BIGINT) AS n_observed, CAST(sum(n) - count(*) AS BIGINT) AS df_residual, sum(ss) / nullif(sum(n) - count(*), 0) AS sigma2,
  CASE WHEN count(*) = 2 THEN 'O_vs_F' END AS contrast, max(m) FILTER ("group" = 'O') - max(m) FILTER ("group" = 'F') AS lfc,
  CASE WHEN count(*) = 2 THEN sqrt(sum(1.0 / n)) END AS su FROM {x}c GROUP BY protein_id)"""  # noqa: E731
    usable = "protein_id IN (SELECT protein_id FROM ratios WHERE a IS NOT NULL)"
    return f"""{body.replace("WITH ", "WITH RECURSIVE ", 1)},
{fit("n", "v", usable)}, {moderated_sql("n_", "nf")},
{fit("a", "a", "a IS NOT NULL")}, {moderated_sql("a_", "af")}
SELECT protein_id, contrast, taxid, round(n_q.lfc, 6) AS lfc_naive, round(n_q.q_value, 6) AS q_naive, round(a_q.lfc, 6) AS lfc_adj, round(a_q.q_value, 6) AS q_adj
FROM n_q JOIN a_q USING (protein_id, contrast) JOIN taxa USING (protein_id)"""


def ratio_models(spark, sf):
    taxa = R.taxa(spark, sf).where("taxid IS NOT NULL").select("protein_id", "taxid")
    owned = lookup_join(R.protein_values(spark, sf), taxa, ["protein_id"])
    factors = O.taxon_size_factors(owned, R.design(spark, sf), 4)
    return M.ratio_model(log_values(spark, sf), taxa, factors, R.design(spark, sf))


@query("ratio_values", f"""WITH {R.PROTVAL_SQL}, {R.TAXA_SQL},
f AS (SELECT taxid, sample, sum(value) / 1e6 AS factor FROM pv JOIN taxa USING (protein_id) WHERE taxid IS NOT NULL GROUP BY ALL)
SELECT protein_id, sample, round(log2(value) - log2(factor), 6) AS value FROM pv JOIN taxa USING (protein_id) JOIN f USING (taxid, sample)""")
def ratio_values(spark, sf):
    taxa = R.taxa(spark, sf).where("taxid IS NOT NULL")
    owned = lookup_join(R.protein_values(spark, sf), taxa, ["protein_id"], "inner")
    factors = O.taxon_intensity(owned).withColumn("factor", F.col("value") / 1e6)
    out = M.ratio_values(log_values(spark, sf), taxa, factors)
    return out.select("protein_id", "sample", F.round("value", 6).alias("value"))


@query("organism_fold_changes", f"""WITH {R.PROTVAL_SQL}, {R.TAXA_SQL},
f AS (SELECT taxid, sample, "group", sum(value) AS factor FROM pv JOIN taxa USING (protein_id) WHERE taxid IS NOT NULL GROUP BY ALL)
SELECT taxid, round(avg(log2(factor)) FILTER ("group" = 'O') - avg(log2(factor)) FILTER ("group" = 'F'), 6) AS factor_log2fc FROM f GROUP BY taxid""")
def organism_fold_changes(spark, sf):
    taxa = R.taxa(spark, sf).where("taxid IS NOT NULL")
    owned = lookup_join(R.protein_values(spark, sf), taxa, ["protein_id"], "inner")
    factors = O.taxon_intensity(owned).select("taxid", "sample", F.col("value").alias("factor"), F.lit("sum").alias("method"))
    out = M.factor_fold_change(factors, R.design(spark, sf), "F", "O")
    return out.select("taxid", F.round("factor_log2fc", 6).alias("factor_log2fc"))


# ---------------------------------------------------------------- multiple testing
# A price share stands in for a p value; every order priority is a contrast.
TEST_SQL = """tst AS (SELECT o_orderkey AS protein_id, o_orderpriority AS contrast, o_totalprice / 600000 AS p_value, o_custkey, o_orderstatus FROM orders),
rk AS (SELECT *, p_value * count(*) OVER (PARTITION BY contrast) / row_number() OVER (PARTITION BY contrast ORDER BY p_value, protein_id) AS raw FROM tst),
bh AS (SELECT *, least(1.0, min(raw) OVER (PARTITION BY contrast ORDER BY p_value DESC)) AS q_value FROM rk)"""


def tests(spark, sf) -> DataFrame:
    o = load(spark, sf, "orders")
    return o.select(
        F.col("o_orderkey").alias("protein_id"), F.col("o_orderpriority").alias("contrast"),
        (F.col("o_totalprice") / 600000).alias("p_value"), "o_custkey", "o_orderstatus")


@query("bh_adjust", f"WITH {TEST_SQL} SELECT protein_id, contrast, round(q_value, 8) AS q_value FROM bh")
def bh_adjust(spark, sf):
    out = M.bh_adjust(tests(spark, sf))
    return out.select("protein_id", "contrast", F.round("q_value", 8).alias("q_value"))


ENRICH_SQL = f"""WITH {TEST_SQL},
t AS (SELECT protein_id, contrast, p_value < 0.2 AS sig FROM tst WHERE protein_id IN (SELECT l_orderkey FROM lineitem)),
tot AS (SELECT contrast, count(*) AS n_background, count(*) FILTER (sig) AS n_significant FROM t GROUP BY 1),
c AS (SELECT contrast, l_suppkey AS pathway, count(*) AS n_in_pathway, count(*) FILTER (sig) AS n_overlap
  FROM t JOIN (SELECT DISTINCT l_orderkey, l_suppkey FROM lineitem) ON l_orderkey = protein_id GROUP BY ALL),
j AS (SELECT * FROM c JOIN tot USING (contrast)),
h AS (SELECT contrast, pathway, sum(exp(
    lgamma(n_in_pathway + 1.0) - lgamma(x + 1.0) - lgamma(n_in_pathway - x + 1.0)
    + lgamma(n_background - n_in_pathway + 1.0) - lgamma(n_significant - x + 1.0) - lgamma(n_background - n_in_pathway - n_significant + x + 1.0)
    - lgamma(n_background + 1.0) + lgamma(n_significant + 1.0) + lgamma(n_background - n_significant + 1.0))) AS p
  FROM (SELECT *, unnest(range(n_overlap, least(n_in_pathway, n_significant) + 1)) AS x FROM j)
  WHERE n_significant - x <= n_background - n_in_pathway GROUP BY ALL),
k AS (SELECT contrast, pathway, n_in_pathway, n_overlap, n_background, n_significant, CASE WHEN n_overlap = 0 THEN 1.0 ELSE least(1.0, p) END AS p
  FROM j LEFT JOIN h USING (contrast, pathway)),
b AS (SELECT *, p * count(*) OVER (PARTITION BY contrast) / count(*) OVER (PARTITION BY contrast ORDER BY p) AS raw FROM k)
SELECT contrast, pathway, n_in_pathway, n_overlap, n_background, n_significant, round(p, 6) AS p_value,
  round(least(1.0, min(raw) OVER (PARTITION BY contrast ORDER BY p DESC)), 6) AS q_value FROM b"""


@query("kegg_enrichment", ENRICH_SQL)
def kegg_enrichment(spark, sf):
    results = tests(spark, sf).withColumn("q_value", F.col("p_value"))
    paths = load(spark, sf, "lineitem").select(F.col("l_orderkey").alias("protein_id"), F.col("l_suppkey").alias("pathway"))
    out = M.kegg_enrichment(results, paths, alpha=0.2)
    return out.withColumns({c: F.round(c, 6) for c in ("p_value", "q_value")})


def _judged(spark, sf) -> DataFrame:
    return tests(spark, sf).select(
        "protein_id", "contrast", F.col("p_value").alias("q_value"), (F.col("o_orderstatus") == "F").alias("has_ko"),
        (F.col("o_custkey") > 700).alias("surface_or_secreted"), F.floor(F.col("p_value") * 10).cast("int").alias("export_score"))


@query("candidate_shortlist", f"""WITH {TEST_SQL}
SELECT protein_id, contrast FROM tst WHERE p_value < 0.2 AND o_orderstatus <> 'F' AND o_custkey > 700""")
def candidate_shortlist(spark, sf):
    return Tb.candidate_shortlist(_judged(spark, sf), ["contrast"], 0.2).select("protein_id", "contrast")


@query("shortlist_population", f"""WITH {TEST_SQL}
SELECT contrast, count(*) AS n_tested, count(*) FILTER (p_value < 0.2) AS n_significant, count(*) FILTER (o_orderstatus <> 'F') AS n_without_ko,
  count(*) FILTER (o_custkey > 700) AS n_surface, count(*) FILTER (p_value < 0.2 AND o_orderstatus <> 'F' AND o_custkey > 700) AS n_listed
FROM tst GROUP BY contrast""")
def shortlist_population(spark, sf):
    return Tb.shortlist_population(_judged(spark, sf), ["contrast"], 0.2)


def _ratio_sql() -> str:
    """Group means of log2 values, and of those minus the organism's log2 factor.

    The naive mean is over every sample of the protein, as in the abundance
    model; the adjusted one over samples whose organism has a factor.
    """
    from bindings.quant_queries import factor_sql

    factors = factor_sql(4).replace("round(CASE WHEN method = 'sum_fallback' THEN plain ELSE fac END, 6)",
                                    "CASE WHEN method = 'sum_fallback' THEN plain ELSE fac END")
    body, final = factors.rsplit("\nSELECT taxid, sample,", 1)
    return f"""{body},
sf AS (SELECT taxid, sample,{final}),
ratios AS (SELECT protein_id, pv.sample, "group", log2(pv.value) AS v, log2(pv.value) - log2(factor) AS a
  FROM pv JOIN taxa USING (protein_id)
  LEFT JOIN (SELECT * FROM sf WHERE factor > 0) f ON f.taxid = taxa.taxid AND f.sample = pv.sample
  WHERE taxa.taxid IS NOT NULL)
SELECT protein_id, round(avg(v) FILTER ("group" = 'O') - avg(v) FILTER ("group" = 'F'), 6) AS lfc_naive,
  round(avg(a) FILTER ("group" = 'O') - avg(a) FILTER ("group" = 'F'), 6) AS lfc_adj
FROM ratios GROUP BY protein_id HAVING count(DISTINCT "group") FILTER (a IS NOT NULL) = 2 AND count(a) > 2"""


@query("ratio_model", _ratio_models_sql())
def ratio_model(spark, sf):
    out = ratio_models(spark, sf)
    return out.select("protein_id", "contrast", "taxid", *[F.round(c, 6).alias(c) for c in ("lfc_naive", "q_naive", "lfc_adj", "q_adj")])


@query("ratio_model_fold_changes", _ratio_sql())
def ratio_model_fold_changes(spark, sf):
    out = ratio_models(spark, sf)
    return out.select("protein_id", F.round("lfc_naive", 6).alias("lfc_naive"), F.round("lfc_adj", 6).alias("lfc_adj"))
