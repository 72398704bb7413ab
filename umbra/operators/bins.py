"""The evidence bins, their summaries and what they make invisible."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from umbra.functions import text as T
from umbra.functions.numbers import percent
from umbra.plans.order import weighted_median

# The bins in the order of the tests.
BINS = (
    "1_ko_pathway",
    "2_ko_orphan",
    "3_annotated_no_ko",
    "3d_duf_only",
    "3s_structure_only",
    "3p_profile_only",
    "4_dark",
)
KO_LESS = BINS[2:]


def assign_bin(ko, pathway, seq, duf, structure, profile) -> Column:
    """First match wins; a pathway without a KO is no evidence."""
    yes = [F.coalesce(T.col(c), F.lit(False)) for c in (ko, pathway, seq, duf, structure, profile)]
    ko, pathway, seq, duf, structure, profile = yes
    return (
        F.when(ko & pathway, BINS[0])
        .when(ko, BINS[1])
        .when(seq, BINS[2])
        .when(duf, BINS[3])
        .when(structure, BINS[4])
        .when(profile, BINS[5])
        .otherwise(BINS[6])
    )


def bin_dimension(df: DataFrame, bins: Sequence[str] = BINS) -> DataFrame:
    return df.sparkSession.createDataFrame(
        [(b, i) for i, b in enumerate(bins)], "bin string, bin_order int"
    )


def bin_summary(
    annotation: DataFrame,
    by: Sequence[str] = (),
    bins: Sequence[str] = BINS,
    digits: int = 1,
) -> DataFrame:
    """Count, percent and median score per bin, with empty bins and a TOTAL row.

    Scores are integers, so counts per (bin, score) are the only rows that move.
    """
    known = F.col("bin").isin(*bins)
    fail = F.raise_error(F.concat(F.lit("bin is not in the bin list: "), F.coalesce("bin", F.lit("NULL"))))
    checked = F.when(known, F.col("bin")).otherwise(fail.cast("string"))
    counts = annotation.groupBy(*by, checked.alias("bin"), "export_score").agg(F.count("*").alias("_w"))
    both = F.explode(F.array(F.col("bin"), F.lit("TOTAL")))
    rows = counts.withColumn("bin", both)
    # One zero row per bin keeps the empty ones; it carries no score and no weight.
    slots = F.array(*[F.lit(b) for b in (*bins, "TOTAL")])
    zero = counts.select(*by).distinct().select(
        *by,
        F.explode(slots).alias("bin"),
        F.lit(None).cast("int").alias("export_score"),
        F.lit(0).cast("long").alias("_w"),
    ) if by else annotation.sparkSession.createDataFrame(
        [(b, None, 0) for b in (*bins, "TOTAL")], "bin string, export_score int, _w bigint"
    )
    filled = rows.unionByName(zero)
    out = filled.groupBy(*by, "bin").agg(
        F.sum("_w").alias("n"),
        F.expr("percentile(export_score, 0.5, _w)").alias("median_export_score"),
    )
    order = F.array_position(slots, F.col("bin"))
    total = out.where("bin = 'TOTAL'").select(*by, F.col("n").alias("_total"))
    if by:
        out = out.join(total, list(by))
    else:
        out = out.withColumn("_total", F.max("n").over(_all_rows()))
    return out.select(
        *by, "bin", "n", percent("n", "_total", digits).alias("percent"),
        F.col("median_export_score"), order.cast("int").alias("bin_order"),
    ).orderBy(*by, "bin_order")


def _all_rows():
    """A window over the eight summary rows."""
    from pyspark.sql import Window

    return Window.partitionBy(F.lit(1))


def cross_dataset_bins(annotation: DataFrame, dataset: str = "dataset", digits: int = 1) -> DataFrame:
    """Data set x bin percentages, one column per bin."""
    counts = annotation.groupBy(dataset).agg(
        F.count("*").alias("_n"),
        *[F.count_if(F.col("bin") == b).alias(b) for b in BINS],
    )
    return counts.select(dataset, *[percent(F.col(f"`{b}`"), "_n", digits).alias(b) for b in BINS])


def invisibility_rates(
    annotation: DataFrame, quantified: DataFrame, by: Sequence[str] = ()
) -> DataFrame:
    """Share outside bin 1 in the database and in the quantified set, and their ratio.

    `quantified` has `bin` by a left join; a group without an annotation row is
    unknown, not invisible, and is counted apart.
    """
    unseen = F.count_if(F.col("bin") != BINS[0])
    known = F.count("bin")
    db = annotation.groupBy(*by).agg(
        known.alias("n_database"), (100.0 * unseen / F.nullif(known, F.lit(0))).alias("pct_database")
    )
    qn = quantified.groupBy(*by).agg(
        known.alias("n_quantified"),
        F.count_if(F.col("bin").isNull()).alias("n_unbinned"),
        (100.0 * unseen / F.nullif(known, F.lit(0))).alias("pct_quantified"),
    )
    if by:
        both = db.join(qn, list(by), "left")
    else:
        both = db.withColumn("_k", F.lit(1)).join(qn.withColumn("_k", F.lit(1)), "_k").drop("_k")
    return both.withColumn(
        "ratio", F.col("pct_quantified") / F.nullif(F.col("pct_database"), F.lit(0.0))
    )


def retention_by_bin(
    proteins: DataFrame, by: Sequence[str] = (), minimum: int = 10, digits: int = 1
) -> DataFrame:
    """Quantified and tested counts per bin with a verdict.

    `proteins` has one row per quantified protein: bin and the flags kept and
    tested. A populated bin that reaches the model empty is a GATE.
    """
    n, tested = F.col("n"), F.col("tested")
    return (
        proteins.groupBy(*by, F.coalesce("bin", F.lit("unbinned")).alias("bin"))
        .agg(
            F.count("*").alias("n"),
            F.count_if("kept").alias("kept"),
            F.count_if("tested").alias("tested"),
        )
        .withColumn("percent", percent("tested", "n", digits))
        .withColumn(
            "verdict",
            F.when((tested == 0) & (n >= minimum), "GATE").when(tested == 0, "NOTE").otherwise("ok"),
        )
    )


def ko_less_coverage(
    proteins: DataFrame, by: Sequence[str] = (), minimum: int = 10, floor_percent: float = 1.0
) -> DataFrame:
    """Share of the quantified proteins without a KO that the model reaches."""
    rows = proteins.where(F.col("bin").isin(*KO_LESS))
    out = rows.groupBy(*by).agg(F.count("*").alias("n"), F.count_if("tested").alias("tested"))
    pct = 100.0 * F.col("tested") / F.nullif(F.col("n"), F.lit(0))
    return out.withColumn("percent", pct).withColumn(
        "gate", (F.col("n") >= minimum) & (pct < floor_percent)
    )


def feature_support_by_bin(evidence: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Median number of features per protein in each bin."""
    return weighted_median(evidence, [*by, "bin"], "n_features_used", "median_features")


def small_protein_count(
    quantified: DataFrame, by: Sequence[str] = (), max_length: int = 100
) -> DataFrame:
    return quantified.groupBy(*by).agg(
        F.count("*").alias("n"), F.count_if(F.col("length") <= max_length).alias("n_small")
    )
