"""Protein filters applied before a model is fitted."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from umbra.errors import DesignError
from umbra.operators.design import with_design
from umbra.plans.joins import lookup_join


def sample_median_shift(values: DataFrame, by: Sequence[str] = (), enabled: bool = True) -> DataFrame:
    """Centre log2 values of every sample on the sample's median."""
    from umbra.plans.order import exact_median

    if not enabled:
        return values
    med = exact_median(values, [*by, "sample"], "value", "_median")
    return lookup_join(values, med, [*by, "sample"]).withColumn(
        "value", F.col("value") - F.col("_median")
    ).drop("_median")


def min_valid_per_group(
    values: DataFrame, design: DataFrame, minimum: int, by: Sequence[str] = (), group: str = "group"
) -> DataFrame:
    """Per protein whether every level of the group has `minimum` values.

    A level in which a protein has no value at all is a level with zero values.
    """
    rows = with_design(values.where("value IS NOT NULL"), design, [group], by)
    per_level = rows.groupBy(*by, "protein_id", group).agg(F.count("*").alias("_n"))
    levels = design.groupBy(*by).agg(F.count_distinct(group).alias("n_levels"))
    per_protein = per_level.groupBy(*by, "protein_id").agg(
        F.count_if(F.col("_n") >= minimum).alias("n_levels_valid")
    )
    if by:
        out = lookup_join(per_protein, levels, by, "inner")
    else:
        out = per_protein.withColumn("n_levels", F.lit(levels.first()[0]))
    return out.withColumn("keep_valid", F.col("n_levels_valid") == F.col("n_levels"))


def protein_plexes(values: DataFrame, design: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Number of plexes each protein has a value in."""
    rows = with_design(values.where("value IS NOT NULL"), design, ["plex"], by)
    return rows.groupBy(*by, "protein_id", "plex").count().groupBy(*by, "protein_id").agg(
        F.count("*").alias("n_plexes")
    )


def protein_filters(
    values: DataFrame,
    design: DataFrame,
    min_valid: int,
    min_plexes: int = 1,
    by: Sequence[str] = (),
) -> DataFrame:
    """Both filters as flags, each against the same starting set."""
    out = min_valid_per_group(values, design, min_valid, by)
    if "plex" not in design.columns:
        if min_plexes > 1:
            raise DesignError(f"min_plexes is {min_plexes} but the run is not isobaric")
        return out.withColumn("n_plexes", F.lit(None).cast("long")).withColumn("keep_plex", F.lit(True))
    plexes = protein_plexes(values, design, by)
    return out.join(plexes, [*by, "protein_id"]).withColumn(
        "keep_plex", F.col("n_plexes") >= min_plexes
    )


def filter_report(flags: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """What each filter removes, alone and beyond the other, and what is kept."""
    v, p = F.col("keep_valid"), F.col("keep_plex")
    return flags.groupBy(*by).agg(
        F.count("*").alias("n_proteins"),
        F.count_if(~v).alias("removed_by_valid"),
        F.count_if(~p).alias("removed_by_plex"),
        F.count_if(v & ~p).alias("removed_by_plex_only"),
        F.count_if(v & (F.col("n_plexes") == 1)).alias("valid_in_one_plex"),
        F.count_if(v & p).alias("n_kept"),
    )


def zero_variance(
    values: DataFrame, design: DataFrame, by: Sequence[str] = (), group: str = "group"
) -> DataFrame:
    """Proteins that are constant within every group."""
    rows = with_design(values.where("value IS NOT NULL"), design, [group], by)
    spread = rows.groupBy(*by, "protein_id", group).agg(
        (F.max("value") - F.min("value")).alias("_range")
    )
    return spread.groupBy(*by, "protein_id").agg(F.max("_range").alias("_range")).where(
        "_range = 0"
    ).select(*by, "protein_id")
