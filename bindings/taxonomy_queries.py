"""Lineages, consensus and verdicts: region, nation and customer are three ranks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bindings.registry import load, query
from umbra.operators import taxonomy as Tx
from umbra.sources.taxonomy import RANKS

USED = ("domain", "genus", "species")


def key(prefix: str, c: str):
    return F.concat(F.lit(prefix), F.col(c).cast("string"))


def tree(spark, sf) -> DataFrame:
    """root <- region (domain) <- nation (genus) <- customer (species)."""
    r, n, c = (load(spark, sf, t) for t in ("region", "nation", "customer"))
    root = spark.createDataFrame([("root", "root", "no rank")], "taxid string, parent string, rank string")
    return (
        root.unionByName(r.select(key("R", "r_regionkey").alias("taxid"), F.lit("root").alias("parent"), F.lit("domain").alias("rank")))
        .unionByName(n.select(key("N", "n_nationkey").alias("taxid"), key("R", "n_regionkey").alias("parent"), F.lit("genus").alias("rank")))
        .unionByName(c.select(key("C", "c_custkey").alias("taxid"), key("N", "c_nationkey").alias("parent"), F.lit("species").alias("rank")))
    )


LIN_SQL = """lin AS (
  SELECT 'C' || c_custkey AS taxid, 'R' || n_regionkey AS domain, 'N' || n_nationkey AS genus, 'C' || c_custkey AS species
  FROM customer JOIN nation ON c_nationkey = n_nationkey
  UNION ALL SELECT 'N' || n_nationkey, 'R' || n_regionkey, 'N' || n_nationkey, NULL FROM nation
  UNION ALL SELECT 'R' || r_regionkey, 'R' || r_regionkey, NULL, NULL FROM region
  UNION ALL SELECT 'root', NULL, NULL, NULL)"""


@query("lineages", f"WITH {LIN_SQL} SELECT taxid, domain, genus, species FROM lin")
def lineages(spark, sf):
    return Tx.lineages(tree(spark, sf), USED)


MERGED_SQL = """mg AS (SELECT 'OLD' || s_suppkey AS taxid,
    CASE WHEN s_suppkey > 50 THEN 'C' || s_suppkey ELSE 'OLD' || (s_suppkey + 50) END AS successor FROM supplier),
dl AS (SELECT 'C' || s_suppkey AS taxid FROM supplier WHERE s_acctbal < 1000),
hop AS (SELECT a.taxid, coalesce(d.successor, c.successor, b.successor, a.successor) AS target FROM mg a
  LEFT JOIN mg b ON b.taxid = a.successor LEFT JOIN mg c ON c.taxid = b.successor LEFT JOIN mg d ON d.taxid = c.successor)"""


@query("current_taxids", f"""WITH {LIN_SQL}, {MERGED_SQL},
ids AS (SELECT taxid FROM mg UNION SELECT 'C' || c_custkey FROM customer),
t AS (SELECT ids.taxid, coalesce(hop.target, ids.taxid) AS target FROM ids LEFT JOIN hop USING (taxid))
SELECT taxid, CASE WHEN target IN (SELECT taxid FROM lin) AND target NOT IN (SELECT taxid FROM dl) THEN target END AS current FROM t""")
def current_taxids(spark, sf):
    nodes, merged, deleted, ids = dump_parts(spark, sf)
    return Tx.current_taxids(ids, nodes, merged, deleted)


def dump_parts(spark, sf):
    sup = load(spark, sf, "supplier")
    onward = F.when(F.col("s_suppkey") > 50, key("C", "s_suppkey")).otherwise(
        F.concat(F.lit("OLD"), (F.col("s_suppkey") + 50).cast("string")))
    merged = sup.select(key("OLD", "s_suppkey").alias("taxid"), onward.alias("successor"))
    deleted = sup.where("s_acctbal < 1000").select(key("C", "s_suppkey").alias("taxid"))
    ids = merged.select("taxid").union(load(spark, sf, "customer").select(key("C", "c_custkey").alias("taxid")))
    return tree(spark, sf), merged, deleted, ids


@query("taxids_at_rank", f"""WITH {LIN_SQL}
SELECT o_orderkey, genus AS taxid FROM orders LEFT JOIN lin ON taxid = 'C' || o_custkey""")
def taxids_at_rank(spark, sf):
    o = load(spark, sf, "orders").select("o_orderkey", key("C", "o_custkey").alias("taxid"))
    out = Tx.collapse_taxon_rank(o, "genus", Tx.lineages(tree(spark, sf), USED))
    return out.select("o_orderkey", "taxid")


@query("lineage_at_rank", f"""WITH {LIN_SQL} SELECT taxid, genus FROM lin""")
def lineage_at_rank(spark, sf):
    from umbra.functions.text import lineage_at_rank as at

    lin = Tx.lineages(tree(spark, sf), USED).withColumn("m", Tx.lineage_map(USED))
    return lin.select("taxid", at("m", "genus").alias("genus"))


# ---------------------------------------------------------------- consensus
# An order is a protein, its lines are peptides, and suppliers give the lineage.
# A line of flag A stops at the nation.
PEP_SQL = """pep AS (SELECT l_orderkey AS protein_id, 'R' || n_regionkey AS domain, 'N' || n_nationkey AS genus,
    CASE WHEN l_returnflag <> 'A' THEN 'S' || l_suppkey END AS species
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey),
sz AS (SELECT protein_id, count(*) AS n_peptides FROM pep GROUP BY 1),
v AS (SELECT protein_id, 0 AS d, 'domain' AS rank, domain AS t, count(*) AS n FROM pep GROUP BY ALL
  UNION ALL SELECT protein_id, 5, 'genus', genus, count(*) FROM pep GROUP BY ALL
  UNION ALL SELECT protein_id, 6, 'species', species, count(*) FROM pep WHERE species IS NOT NULL GROUP BY ALL),
w AS (SELECT *, sum(n) OVER (PARTITION BY protein_id, d) AS tot,
  lead(n) OVER (PARTITION BY protein_id, d ORDER BY n DESC, t) AS nxt,
  row_number() OVER (PARTITION BY protein_id, d ORDER BY n DESC, t) AS rn FROM v),
b AS (SELECT protein_id, max(d) AS d FROM w WHERE rn = 1 AND n > coalesce(nxt, 0) AND n / tot >= 0.5 GROUP BY 1),
con AS (SELECT sz.protein_id, CASE WHEN n_peptides >= 2 THEN w.t END AS consensus_taxid,
  CASE WHEN n_peptides >= 2 THEN w.rank END AS consensus_rank,
  CASE WHEN n_peptides >= 2 THEN round(w.n / w.tot, 6) END AS fraction, n_peptides
  FROM sz LEFT JOIN b USING (protein_id) LEFT JOIN w ON w.protein_id = b.protein_id AND w.d = b.d AND w.rn = 1)"""


def peptide_lineages(spark, sf) -> DataFrame:
    li = load(spark, sf, "lineitem")
    sup = load(spark, sf, "supplier").join(F.broadcast(load(spark, sf, "nation")), F.col("s_nationkey") == F.col("n_nationkey"))
    rows = li.join(F.broadcast(sup), F.col("l_suppkey") == F.col("s_suppkey"))
    ids = {"domain": key("R", "n_regionkey"), "genus": key("N", "n_nationkey"),
           "species": F.when(F.col("l_returnflag") != "A", key("S", "l_suppkey"))}
    return rows.select(
        F.col("l_orderkey").alias("protein_id"),
        *[ids.get(r, F.lit(None).cast("string")).alias(f"{r}_id") for r in RANKS])


def consensus(spark, sf) -> DataFrame:
    return Tx.consensus_taxon(peptide_lineages(spark, sf))


@query("consensus_taxon", f"""WITH {PEP_SQL} FROM con""")
def consensus_taxon(spark, sf):
    return consensus(spark, sf).withColumn("fraction", F.round("fraction", 6))


@query("consensus_rank_counts", f"""WITH {PEP_SQL}
SELECT coalesce(consensus_rank, 'none') AS consensus_rank, count(*) AS n FROM con GROUP BY 1""")
def consensus_rank_counts(spark, sf):
    return consensus(spark, sf).groupBy(F.coalesce("consensus_rank", F.lit("none")).alias("consensus_rank")).agg(
        F.count("*").alias("n"))


@query("protein_peptide_lca", """
SELECT DISTINCT o_custkey AS protein_id, upper(regexp_replace(o_clerk, '[^A-Za-z]', '', 'g')) AS peptide
FROM (SELECT o_custkey, o_orderpriority || chr(65 + CAST(o_totalprice AS INTEGER) // 20000) AS o_clerk FROM orders)
WHERE upper(regexp_replace(o_clerk, '[^A-Za-z]', '', 'g')) IN (
  SELECT upper(regexp_replace(o_orderpriority || 'B', '[^A-Za-z]', '', 'g')) FROM orders)""")
def protein_peptide_lca(spark, sf):
    o = load(spark, sf, "orders")
    letter = F.char(F.lit(65) + F.floor(F.round("o_totalprice").cast("int") / 20000).cast("int"))
    feats = o.select(F.col("o_custkey").alias("razor"), F.concat("o_orderpriority", letter).alias("peptide"))
    from umbra.functions.text import peptide_normalise

    lca = o.select(peptide_normalise(F.concat("o_orderpriority", F.lit("B"))).alias("peptide")).distinct()
    return Tx.protein_peptide_lca(feats, lca).select("protein_id", "peptide")


# ---------------------------------------------------------------- two estimates
# The second estimate of an order is the supplier side's consensus; the first is
# its customer, whose nation may or may not be the same.
CMP_SQL = f"""{PEP_SQL}, {LIN_SQL},
slin AS (SELECT 'S' || s_suppkey AS taxid, 'R' || n_regionkey AS domain, 'N' || n_nationkey AS genus, 'S' || s_suppkey AS species
  FROM supplier JOIN nation ON s_nationkey = n_nationkey
  UNION ALL SELECT taxid, domain, genus, species FROM lin WHERE taxid NOT LIKE 'C%' AND taxid <> 'root'),
egg AS (SELECT o_orderkey AS protein_id, CASE WHEN o_totalprice < 50000 THEN NULL WHEN o_orderstatus = 'P' THEN 'X' || o_custkey
    ELSE 'S' || o_custkey END AS eggnog_taxid FROM orders),
cm AS (SELECT con.protein_id, eggnog_taxid, consensus_taxid AS unipept_taxid,
  CASE WHEN eggnog_taxid IS NULL THEN 'eggnog_missing' WHEN consensus_taxid IS NULL THEN 'unipept_missing'
    WHEN eggnog_taxid = consensus_taxid THEN 'identical' WHEN a.domain IS NULL THEN 'eggnog_unresolved'
    WHEN a.species IS NOT NULL AND b.species IS NOT NULL THEN
      CASE WHEN a.species = b.species THEN 'concordant' WHEN a.genus = b.genus THEN 'concordant' ELSE 'conflict' END
    WHEN a.genus IS NOT NULL AND b.genus IS NOT NULL THEN CASE WHEN a.genus = b.genus THEN 'concordant' ELSE 'conflict' END
    WHEN a.domain IS NOT NULL AND b.domain IS NOT NULL THEN CASE WHEN a.domain = b.domain THEN 'concordant_above_genus' ELSE 'conflict' END
    ELSE 'no_common_rank' END AS verdict
  FROM con LEFT JOIN egg USING (protein_id) LEFT JOIN slin a ON a.taxid = eggnog_taxid LEFT JOIN slin b ON b.taxid = consensus_taxid)"""


def eggnog_side(spark, sf) -> DataFrame:
    o = load(spark, sf, "orders")
    taxid = F.when(F.col("o_totalprice") >= 50000, F.when(F.col("o_orderstatus") == "P", key("X", "o_custkey")).otherwise(
        key("S", "o_custkey")))
    return o.select(F.col("o_orderkey").alias("protein_id"), taxid.alias("eggnog_taxid"))


def supplier_lineage(spark, sf) -> DataFrame:
    r, n, sup = (load(spark, sf, t) for t in ("region", "nation", "supplier"))
    nodes = (
        r.select(key("R", "r_regionkey").alias("taxid"), F.lit("root").alias("parent"), F.lit("domain").alias("rank"))
        .unionByName(n.select(key("N", "n_nationkey").alias("taxid"), key("R", "n_regionkey").alias("parent"), F.lit("genus").alias("rank")))
        .unionByName(sup.select(key("S", "s_suppkey").alias("taxid"), key("N", "s_nationkey").alias("parent"), F.lit("species").alias("rank")))
    )
    lin = Tx.lineages(nodes).withColumn("current", F.col("taxid"))
    return lin


def comparison(spark, sf) -> DataFrame:
    return Tx.compare_taxonomy(consensus(spark, sf), eggnog_side(spark, sf), supplier_lineage(spark, sf))


@query("taxonomy_verdicts", f"""WITH {CMP_SQL} FROM cm""")
def taxonomy_verdicts(spark, sf):
    return comparison(spark, sf).select("protein_id", "eggnog_taxid", "unipept_taxid", "verdict")


@query("taxonomy_verdicts_without_lineage", f"""WITH {CMP_SQL}
SELECT protein_id, CASE WHEN verdict IN ('eggnog_missing', 'unipept_missing', 'identical') THEN verdict ELSE 'differ_no_lineage' END AS verdict FROM cm""")
def taxonomy_verdicts_without_lineage(spark, sf):
    out = Tx.compare_taxonomy(consensus(spark, sf), eggnog_side(spark, sf), None)
    return out.select("protein_id", "verdict")


@query("verdict_counts", f"""WITH {CMP_SQL}
SELECT o_orderstatus AS bin, verdict, count(*) AS n FROM cm JOIN orders ON o_orderkey = protein_id GROUP BY ALL""")
def verdict_counts(spark, sf):
    o = load(spark, sf, "orders").select(F.col("o_orderkey").alias("protein_id"), F.col("o_orderstatus").alias("bin"))
    return Tx.verdict_counts(comparison(spark, sf).join(o, "protein_id"), ["bin"])


def _effective(source: str, expression: str):
    @query(f"effective_taxid_{source}", f"""WITH {CMP_SQL}
SELECT e.protein_id, {expression} AS effective_taxid, '{source}' AS taxonomy_source FROM egg e LEFT JOIN cm USING (protein_id)""")
    def run(spark, sf):
        cmp = None if source == "eggnog" else comparison(spark, sf)
        out = Tx.effective_taxid(eggnog_side(spark, sf), cmp, source)
        return out.select("protein_id", "effective_taxid", "taxonomy_source")

    return run


_effective("eggnog", "e.eggnog_taxid")
_effective("unipept", "cm.unipept_taxid")
_effective("concordant", "CASE WHEN cm.verdict IN ('identical', 'concordant') THEN e.eggnog_taxid END")


@query("excluded_by_concordance", f"""WITH {CMP_SQL}
SELECT count(*) AS n_proteins, count(*) FILTER (verdict IN ('identical', 'concordant')) AS n_with_taxon,
  count(*) FILTER (verdict IS NULL OR verdict NOT IN ('identical', 'concordant')) AS n_excluded FROM egg LEFT JOIN cm USING (protein_id)""")
def excluded_by_concordance(spark, sf):
    eff = Tx.effective_taxid(eggnog_side(spark, sf), comparison(spark, sf), "concordant")
    return Tx.excluded_by_concordance(eff)
