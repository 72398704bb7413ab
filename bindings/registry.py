"""Registration of queries, and the tables they share.

A part is a protein, an order is a feature whose candidates are its parts, and
a line's return flag and status name the plex and the condition of a sample.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from umbra.plans.lineage import cut_lineage, dealt

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def load(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def joined(c: Column | str) -> Column:
    """An array as text, so both engines show it the same way."""
    return F.array_join(c, ",")


# ---------------------------------------------------------------- shared tables
# Parts of size up to 5 have no organism.
TAXA_SQL = """taxa AS (
  SELECT p_partkey AS protein_id, CASE WHEN p_size > 5 THEN p_brand END AS taxid,
         p_type AS family_id FROM part)"""
CAND_SQL = "cand AS (SELECT DISTINCT l_orderkey AS feature_id, l_partkey AS protein_id FROM lineitem)"
CLASS_SQL = f"""{TAXA_SQL}, {CAND_SQL},
cls AS (
  SELECT feature_id, count(*) AS n_candidates, min(protein_id) AS razor,
    CASE WHEN count(*) = 1 THEN 'unique'
         WHEN count(*) FILTER (taxid IS NULL) = 0 AND count(DISTINCT taxid) = 1 THEN 'taxon_unique'
         WHEN count(*) FILTER (taxid IS NULL) > 0 THEN 'shared_unknown_taxon'
         ELSE 'shared' END AS assignment_class,
    CASE WHEN count(*) = 1 THEN 'unique'
         WHEN count(*) FILTER (taxid IS NULL) = 0 AND count(DISTINCT taxid) = 1 THEN 'taxon_unique'
         WHEN count(*) FILTER (taxid IS NULL) > 0 AND count(DISTINCT family_id) = 1 THEN 'family_unique'
         WHEN count(*) FILTER (taxid IS NULL) > 0 THEN 'shared_unknown_taxon'
         ELSE 'shared' END AS family_class
  FROM cand JOIN taxa USING (protein_id) GROUP BY feature_id)"""
SAMPLE_SQL = """l_returnflag || l_linestatus || CASE WHEN l_linenumber <= 3 THEN '1' ELSE '2' END"""
# One value per part and sample.
PROTVAL_SQL = f"""pv AS (
  SELECT l_partkey AS protein_id, {SAMPLE_SQL} AS sample, l_returnflag AS plex,
         l_linestatus AS "group", sum(l_extendedprice) AS value
  FROM lineitem GROUP BY ALL)"""
DESIGN_SQL = f"""design AS (
  SELECT DISTINCT {SAMPLE_SQL} AS sample, l_returnflag AS plex, l_linestatus AS "group" FROM lineitem)"""


def sample_column() -> Column:
    half = F.when(F.col("l_linenumber") <= 3, "1").otherwise("2")
    return F.concat("l_returnflag", "l_linestatus", half)


def taxa(spark: SparkSession, sf: str) -> DataFrame:
    part = load(spark, sf, "part")
    return part.select(
        F.col("p_partkey").alias("protein_id"),
        F.when(F.col("p_size") > 5, F.col("p_brand")).alias("taxid"),
        F.col("p_type").alias("family_id"),
    )


def candidates(spark: SparkSession, sf: str) -> DataFrame:
    """Distinct pairs; nearly all lines are, so they are dealt before they are made distinct."""
    pairs = load(spark, sf, "lineitem").select(F.col("l_orderkey").alias("feature_id"), F.col("l_partkey").alias("protein_id"))
    return dealt(pairs, ["feature_id", "protein_id"]).distinct()


def features(spark: SparkSession, sf: str) -> DataFrame:
    """feature_id and razor; candidates stay a table of their own."""
    li = load(spark, sf, "lineitem")
    return li.groupBy(F.col("l_orderkey").alias("feature_id")).agg(F.min("l_partkey").alias("razor"))


def feature_values(spark: SparkSession, sf: str) -> DataFrame:
    li = load(spark, sf, "lineitem")
    return li.groupBy(
        F.col("l_orderkey").alias("feature_id"), sample_column().alias("sample"),
        F.col("l_returnflag").alias("plex"),
    ).agg(F.sum("l_extendedprice").alias("value"))


FEATVAL_SQL = f"""fv AS (
  SELECT l_orderkey AS feature_id, {SAMPLE_SQL} AS sample, l_returnflag AS plex,
         sum(l_extendedprice) AS value
  FROM lineitem GROUP BY ALL)"""


def protein_values(spark: SparkSession, sf: str) -> DataFrame:
    li = load(spark, sf, "lineitem")
    return li.groupBy(
        F.col("l_partkey").alias("protein_id"), sample_column().alias("sample"),
        F.col("l_returnflag").alias("plex"), F.col("l_linestatus").alias("group"),
    ).agg(F.sum("l_extendedprice").alias("value"))


def design(spark: SparkSession, sf: str) -> DataFrame:
    """The samples, written once: every operator reads them."""
    li = load(spark, sf, "lineitem")
    rows = li.select(
        sample_column().alias("sample"), F.col("l_returnflag").alias("plex"),
        F.col("l_linestatus").alias("group"),
    ).distinct()
    return cut_lineage(rows, "design")
