"""Isobaric batches: plex counts, purity, channel scale, references and exposure."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from umbra.errors import DesignError, OptionError
from umbra.plans.joins import lookup_join
from umbra.plans.lineage import cut_lineage
from umbra.plans.order import exact_median


def drop_empty_channels(design: DataFrame) -> DataFrame:
    """An unassigned channel is annotated `<plex>_<channel>`; its signal is carry-over."""
    return design.where(F.col("sample") != F.concat_ws("_", "plex", "channel"))


def feature_plexes(values: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Number of plexes each feature has a row in."""
    return values.select(*by, "feature_id", "plex").distinct().groupBy(*by, "feature_id").agg(
        F.count("*").alias("n_plexes")
    )


def plex_histogram(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Features (or proteins) seen in 1, 2, ... n plexes."""
    return counts.groupBy(*by, "n_plexes").agg(F.count("*").alias("n"))


def feature_min_plexes(values: DataFrame, minimum: int, by: Sequence[str] = ()) -> DataFrame:
    """Keep features identified in at least `minimum` plexes."""
    if minimum <= 1:
        return values
    keep = feature_plexes(values, by).where(F.col("n_plexes") >= minimum).select(*by, "feature_id")
    return lookup_join(values, keep, [*by, "feature_id"], "left_semi")


def purity_filter(
    features: DataFrame, psms: DataFrame, minimum: float, keys: Sequence[str] = ("plex", "feature_id")
) -> DataFrame:
    """Features with their median spectrum purity and `purity_state`.

    A feature without a matching spectrum is kept as `unmatched`: an unmatched
    key is a join failure and not an impure feature.
    """
    med = exact_median(psms, keys, "purity", "median_purity")
    state = (
        F.when(F.col("median_purity").isNull(), "unmatched")
        .when(F.col("median_purity") >= minimum, "kept")
        .otherwise("dropped")
    )
    return lookup_join(features, med, list(keys)).withColumn("purity_state", state)


# ---------------------------------------------------------------- channel scale
def channel_factors(values: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Per channel its median, the plex's median channel and the scale between them."""
    return _factors(cut_lineage(values.select(*by, "plex", "sample", "value"), "values"), by)


def _factors(values: DataFrame, by: Sequence[str]) -> DataFrame:
    """The same of written values, which several passes read."""
    channel = exact_median(values, [*by, "plex", "sample"], "value", "channel_median")
    # At most one row per channel, so a plex is a handful of rows.
    plex = channel.groupBy(*by, "plex").agg(F.median("channel_median").alias("plex_median"))
    return channel.join(plex, [*by, "plex"]).withColumn(
        "factor", F.col("plex_median") / F.nullif(F.col("channel_median"), F.lit(0.0))
    )


def channel_median_normalise(
    values: DataFrame, method: str = "median", by: Sequence[str] = ()
) -> DataFrame:
    """Centre the channels of a plex on its median channel; plexes keep their difference."""
    if method == "none":
        return values
    if method != "median":
        raise OptionError(f"within_plex_normalise must be median or none, not {method!r}")
    values = cut_lineage(values, "values")
    factors = _factors(values, by).select(*by, "plex", "sample", "factor")
    scaled = lookup_join(values, factors, [*by, "plex", "sample"])
    return scaled.withColumn("value", F.col("value") * F.col("factor")).drop("factor")


def under_corrected_channels(
    values: DataFrame, min_fold: float = 4.0, min_excess_missing: float = 0.2, by: Sequence[str] = ()
) -> DataFrame:
    """Channels far off the plex scale and much emptier than their peers.

    Missing shares are over the features the plex has at all.
    """
    values = cut_lineage(values.select(*by, "plex", "sample", "feature_id", "value"), "values")
    factors = _factors(values, by)
    seen = values.groupBy(*by, "plex", "sample").agg(F.count("value").alias("n_seen"))
    feats = values.select(*by, "plex", "feature_id").distinct().groupBy(*by, "plex").agg(
        F.count("*").alias("n_features")
    )
    rows = (
        factors.join(seen, [*by, "plex", "sample"])
        .join(feats, [*by, "plex"])
        .withColumn("missing", 1.0 - F.col("n_seen") / F.col("n_features"))
    )
    peers = rows.groupBy(*by, "plex").agg(F.median("missing").alias("peer_missing"))
    fold = F.greatest(F.col("factor"), 1.0 / F.col("factor"))
    return (
        rows.join(peers, [*by, "plex"])
        .withColumn("fold", fold)
        .withColumn(
            "under_corrected",
            (F.col("fold") >= min_fold)
            & (F.col("missing") >= F.col("peer_missing") + min_excess_missing),
        )
        .drop("n_seen", "n_features")
    )


# ---------------------------------------------------------------- references
def drop_references(values: DataFrame, design: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The covariate treatment: the reference leaves the samples, nothing is divided."""
    refs = design.where("is_reference").select(*by, "sample")
    return lookup_join(values, refs, [*by, "sample"], "left_anti")


def reference_ratios(values: DataFrame, design: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Each value over its plex's reference value; without one the value is missing."""
    refs = design.where("is_reference").select(*by, "sample")
    if not refs.limit(1).count():
        raise OptionError("reference ratios need a reference sample or channel")
    marked = lookup_join(values, refs.withColumn("_ref", F.lit(True)), [*by, "sample"])
    reference = marked.where("_ref AND value <> 0").select(
        *by, "plex", "feature_id", F.col("value").alias("_reference")
    )
    rest = marked.where("_ref IS NULL").drop("_ref")
    joined = lookup_join(rest, reference, [*by, "plex", "feature_id"])
    return joined.withColumn("ratio", F.col("value") / F.col("_reference")).drop("_reference")


def reference_losses(ratios: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Values lost to a missing reference, per plex."""
    had = F.col("value").isNotNull()
    return ratios.groupBy(*by, "plex").agg(
        F.count_if(had).alias("n_values"),
        F.count_if(had & F.col("ratio").isNull()).alias("n_lost"),
    ).withColumn("pct_lost", 100.0 * F.col("n_lost") / F.nullif(F.col("n_values"), F.lit(0)))


# ---------------------------------------------------------------- exposure
def plex_exposure(
    proteins: DataFrame, min_members: int = 4, by: Sequence[str] = ()
) -> DataFrame:
    """Taxa with fewer than `min_members` proteins observed in every plex.

    `proteins` has taxid, protein_id, plex and value. One plex is no batch, so
    nothing is exposed.
    """
    seen = proteins.where("value IS NOT NULL AND taxid IS NOT NULL").select(
        *by, "taxid", "protein_id", "plex"
    ).distinct()
    n_plex = proteins.select(*by, "plex").distinct().groupBy(*by).agg(F.count("*").alias("_plexes"))
    per_protein = seen.groupBy(*by, "taxid", "protein_id").agg(F.count("*").alias("_seen"))
    if by:
        joined = lookup_join(per_protein, n_plex, by, "inner")
    else:
        joined = per_protein.withColumn("_plexes", F.lit(n_plex.first()[0]))
    taxa = joined.groupBy(*by, "taxid", "_plexes").agg(
        F.count_if(F.col("_seen") == F.col("_plexes")).alias("_complete")
    )
    batch = F.col("_plexes") > 1
    return taxa.groupBy(*by).agg(
        F.count_if(batch & (F.col("_complete") < min_members)).alias("n_exposed"),
        F.count_if(batch).alias("n_taxa"),
    )


# ---------------------------------------------------------------- design checks
def condition_by_plex(design: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Cross-tabulation of condition and plex; an empty cell has no row."""
    return design.groupBy(*by, "plex", "group").agg(F.count("*").alias("n_samples"))


def confounding_check(design: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Per data set: plexes, conditions, empty cells, one-sample cells and confounding."""
    cells = condition_by_plex(design, by)
    per_plex = cells.groupBy(*by, "plex").agg(
        F.count("*").alias("_groups"), F.sum("n_samples").alias("_n")
    )
    summary = per_plex.groupBy(*by).agg(
        F.count("*").alias("n_plexes"),
        F.max("_groups").alias("_most"),
        F.count_if(F.col("_n") == 1).alias("n_single_sample_plexes"),
    )
    levels = cells.groupBy(*by).agg(
        F.count_distinct("group").alias("n_groups"),
        F.count("*").alias("n_cells"),
        F.count_if(F.col("n_samples") == 1).alias("n_single_sample_cells"),
    )
    if by:
        out = summary.join(levels, list(by))
    else:
        out = summary.withColumn("_k", F.lit(1)).join(
            levels.withColumn("_k", F.lit(1)), "_k"
        ).drop("_k")
    return out.withColumn(
        "n_empty_cells", F.col("n_plexes") * F.col("n_groups") - F.col("n_cells")
    ).withColumn(
        "confounded",
        (F.col("n_plexes") > 1) & (F.col("n_groups") > 1) & (F.col("_most") == 1),
    ).drop("_most", "n_cells")


def require_unconfounded(design: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Stop when every plex holds exactly one condition."""
    bad = confounding_check(design, by).where("confounded").limit(1).collect()
    if bad:
        raise DesignError(
            "the condition is perfectly confounded with the plex: each of the "
            f"{bad[0]['n_plexes']} plexes contains exactly one condition"
        )
    return design
