"""Organism sums and size factors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from umbra.plans.joins import lookup_join
from umbra.plans.lineage import cut_lineage
from umbra.plans.order import GROUP_LIMIT, exact_median

METHODS = ("median_of_ratios", "median_of_ratios_poscounts", "sum_fallback")


def taxon_intensity(proteins: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Sum over the members of a taxon per sample; proteins without a taxon are left out."""
    rows = proteins.where("taxid IS NOT NULL AND taxid <> ''")
    return rows.groupBy(*by, "taxid", "sample").agg(F.sum("value").alias("value"))


def taxon_size_factors(
    proteins: DataFrame, samples: DataFrame, min_proteins: int = 4, by: Sequence[str] = ()
) -> DataFrame:
    """(taxid, sample) -> factor and the method behind it.

    `proteins` has taxid, protein_id, sample and value with one row per protein
    and sample; `samples` lists the samples. The reference of a protein is its
    geometric mean: over all samples for complete proteins, over its own where
    too few are complete (then a sample with fewer than `min_proteins` ratios
    has no factor). Small taxa use their plain sum.
    """
    taxon = [*by, "taxid"]
    x = proteins.where("value > 0 AND taxid IS NOT NULL AND taxid <> ''")
    # One row per protein, written once: its cells (one a sample at most), their number and geometric mean.
    packed = x.groupBy(*taxon, "protein_id").agg(
        F.collect_list(F.struct("sample", "value")).alias("_cells"), F.count("*").alias("_seen"), F.exp(F.avg(F.ln("value"))).alias("_ref")
    )
    n_samples = samples.select(*by, "sample").distinct().groupBy(*by).agg(F.count("*").alias("_ns"))
    if by:
        packed = lookup_join(packed, n_samples, by, "inner")
    else:
        packed = packed.withColumn("_ns", F.lit(n_samples.first()[0]))
    packed = cut_lineage(packed.withColumn("_complete", F.col("_seen") == F.col("_ns")), "packed")
    members = packed.groupBy(*taxon).agg(
        F.count("*").alias("n_members"), F.count_if("_complete").alias("n_complete")
    ).withColumn(
        "_planned",
        F.when(F.col("n_members") < min_proteins, METHODS[2])
        .when(F.col("n_complete") >= min_proteins, METHODS[0])
        .otherwise(METHODS[1]),
    )
    # Few rows, a taxon each, that three places read.
    members = cut_lineage(members, "members")
    most = members.agg(F.max("n_members")).first()[0] or 0
    rows = lookup_join(packed, members, taxon)
    usable = (F.col("_planned") == METHODS[1]) | ((F.col("_planned") == METHODS[0]) & F.col("_complete"))
    ratio = F.when(usable, F.col("_c.value") / F.col("_ref"))
    cells = rows.select(*taxon, "_planned", "n_members", "n_complete", usable.alias("_usable"), "_ref", F.explode("_cells").alias("_c"), "_complete")
    cells = cells.select(*taxon, "_c.sample", "_planned", "n_members", "n_complete", F.col("_c.value").alias("value"), ratio.alias("_ratio"))
    group = [*taxon, "sample", "_planned", "n_members", "n_complete"]
    sums = [F.sum("value").alias("_sum"), F.count("_ratio").alias("n_ratios")]
    if most <= GROUP_LIMIT:
        table = cells.groupBy(*group).agg(*sums, F.median("_ratio").alias("_factor"))
    else:  # a taxon too large for one task
        medians = exact_median(cells, [*taxon, "sample"], "_ratio", "_factor")
        table = cells.groupBy(*group).agg(*sums).join(medians, [*taxon, "sample"], "left")
    table = table.withColumn(
        "_factor",
        F.when((F.col("_planned") == METHODS[1]) & (F.col("n_ratios") < min_proteins), F.lit(None)).otherwise(
            F.col("_factor")
        ),
    )
    # One row per sample of a taxon from here on.
    w = Window.partitionBy(*taxon)
    none_usable = F.count("_factor").over(w) == 0
    method = F.when(none_usable, METHODS[2]).otherwise(F.col("_planned"))
    return (
        table.withColumn("method", method)
        .withColumn("_mean", F.sum("_sum").over(w) / F.count("*").over(w))
        .select(
            *taxon,
            "sample",
            F.when(F.col("method") == METHODS[2], F.col("_sum") / F.col("_mean"))
            .otherwise(F.col("_factor"))
            .alias("factor"),
            "method",
            "n_members",
            "n_complete",
            "n_ratios",
        )
    )


def normalisation_risk(
    rows: DataFrame,
    by: Sequence[str] = (),
    min_lfc: float = 0.585,
    frac_deviating: float = 0.5,
    opposing: float = 0.6,
    min_deviating: int = 3,
    opposing_frac: float = 0.3,
) -> DataFrame:
    """Per taxon a verdict on whether its factor absorbed a real shift.

    `rows`: taxid, factor_log2fc, method, lfc and deviates, one per tested protein.
    """
    against = F.col("deviates") & (F.sign("lfc") != F.sign("factor_log2fc"))
    t = rows.groupBy(*by, "taxid", "factor_log2fc").agg(
        F.count("*").alias("n_tested"),
        F.count_if("deviates").alias("n_dev"),
        F.count_if(against).alias("n_opposing"),
        F.min("method").alias("method"),
    )
    t = (
        t.withColumn("frac_deviating", F.col("n_dev") / F.col("n_tested"))
        .withColumn("opposing", F.coalesce(F.col("n_opposing") / F.nullif(F.col("n_dev"), F.lit(0)), F.lit(0.0)))
        .withColumn("opposing_frac", F.col("n_opposing") / F.col("n_tested"))
    )
    verdict = (
        F.when(F.col("method") == METHODS[2], "fragile (too few proteins)")
        .when(
            (F.abs("factor_log2fc") > min_lfc)
            & (F.col("n_dev") >= min_deviating)
            & (F.col("opposing") > opposing)
            & (F.col("opposing_frac") >= opposing_frac),
            "AT RISK",
        )
        .when(F.col("frac_deviating") > frac_deviating, "check (median in a sparse region)")
        .otherwise("ok")
    )
    return t.withColumn("assumption", verdict)
