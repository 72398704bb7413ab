"""Peptide LCA tables and the taxonomy tree."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from umbra.errors import InputError
from umbra.functions import text as T
from umbra.sources.lines import kept, read_delimited, read_lines

# The ranks of a lineage, from the top down.
RANKS = ("domain", "phylum", "class", "order", "family", "genus", "species")


def lca_columns(df: DataFrame, names: list[str], path: str = "") -> DataFrame:
    """Peptide, taxid, rank and one taxid column per rank; a rank name is never an id."""
    if "peptide" not in names or "taxon_id" not in names:
        raise InputError(f"{path}: not a pept2lca result (needs peptide and taxon_id)")
    rank_id = {r: f"{r}_id" for r in RANKS}
    if "domain_id" not in names and "superkingdom_id" in names:
        rank_id["domain"] = "superkingdom_id"
    if not any(c in names for c in rank_id.values()):
        raise InputError(f"{path}: no rank taxid columns; run pept2lca with --all")
    extra = [c for c in ("dataset",) if c in names]
    lower = T.blank_to_null("taxon_rank") if "taxon_rank" in names else F.lit(None).cast("string")

    def taxid(c: str):
        t = T.blank_to_null(f"`{c}`")
        return F.when(t.rlike(r"^\d+$"), t)

    return df.select(
        *extra,
        T.peptide_normalise("peptide").alias("peptide"),
        taxid("taxon_id").alias("taxon_id"),
        F.when(lower == "superkingdom", F.lit("domain")).otherwise(lower).alias("taxon_rank"),
        *[
            (taxid(c) if c in names else F.lit(None).cast("string")).alias(f"{r}_id")
            for r, c in rank_id.items()
        ],
    )


def read_peptide_lca(spark: SparkSession, path: str) -> DataFrame:
    df, names = read_delimited(spark, path)
    return lca_columns(df, names, path)


def _cells(lines: DataFrame):
    return F.split(F.regexp_replace("value", r"\t\|$", ""), "\t\\|\t?")


def parse_nodes(lines: DataFrame) -> DataFrame:
    c = _cells(lines)
    rank = F.trim(F.get(c, 2))
    return lines.where(F.size(c) >= 3).select(
        *kept(lines),
        F.trim(F.get(c, 0)).alias("taxid"),
        F.trim(F.get(c, 1)).alias("parent"),
        F.when(rank == "superkingdom", F.lit("domain")).otherwise(rank).alias("rank"),
    )


def parse_names(lines: DataFrame) -> DataFrame:
    c = _cells(lines)
    return lines.where(F.trim(F.get(c, 3)) == "scientific name").select(
        *kept(lines), F.trim(F.get(c, 0)).alias("taxid"), F.trim(F.get(c, 1)).alias("name")
    )


def parse_merged(lines: DataFrame) -> DataFrame:
    c = _cells(lines)
    return lines.where(F.size(c) >= 2).select(
        *kept(lines), F.trim(F.get(c, 0)).alias("taxid"), F.trim(F.get(c, 1)).alias("successor")
    )


def parse_deleted(lines: DataFrame) -> DataFrame:
    return lines.where(F.trim("value") != "").select(
        *kept(lines), F.trim(F.get(_cells(lines), 0)).alias("taxid")
    )


def read_taxdump(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """nodes, names, merged and deleted of a taxonomy dump."""
    def at(name: str, optional: bool = False) -> DataFrame:
        return read_lines(spark, f"{folder}/{name}.dmp", optional)

    return {
        "nodes": parse_nodes(at("nodes")),
        "names": parse_names(at("names")),
        "merged": parse_merged(at("merged", True)),
        "deleted": parse_deleted(at("delnodes", True)),
    }
