"""Medians, row numbers and sorted scans that never need a whole group in one task.

Groups up to `limit` rows use Spark's own median and window functions. Larger
groups are cut into ranges of their own quantile sketch first. The ranges only
steer the split, so results are exact whatever the sketch says.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from umbra.plans.joins import lookup_join
from umbra.plans.lineage import cut_lineage

GROUP_LIMIT = 2_000_000
SPLITS = 200
#: Rows of a group that a median may hold at once, each a boxed value of a hash map.
MEDIAN_LIMIT = 200_000
#: Relative accuracy of the sketch that finds the middle of a larger group.
ACCURACY = 10_000


def largest_group(df: DataFrame, keys: Sequence[str]) -> int:
    """Row count of the largest group of `df`."""
    biggest = df.groupBy(*keys).count().agg(F.max("count")).first()[0]
    return int(biggest or 0)


def by_size(df, keys, limit, direct, ranged):
    """Apply `direct` to groups up to `limit` rows and `ranged` to larger ones."""
    if largest_group(df, keys) <= limit:
        return direct(df)
    counts = df.groupBy(*keys).count()
    hot = cut_lineage(counts.where(F.col("count") > limit).select(*keys), "hot")
    small = direct(lookup_join(df, hot, keys, "left_anti"))
    return small.unionByName(ranged(lookup_join(df, hot, keys, "left_semi")))


def _sketch_bounds(df: DataFrame, keys: Sequence[str], value: str, splits: int) -> DataFrame:
    """keys -> ascending distinct range bounds of `value`, written once.

    Written, because a sketch may differ between two evaluations and every
    branch that uses it has to see the same bounds.
    """
    points = F.array(*[F.lit(i / splits) for i in range(1, splits)])
    bounds = df.groupBy(*keys).agg(
        F.array_sort(F.array_distinct(F.percentile_approx(value, points, 10_000))).alias("_bounds")
    )
    return cut_lineage(bounds, "bounds")


def _with_range(df: DataFrame, bounds: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    v = F.col(value)
    rng = F.size(F.filter("_bounds", lambda b: b < v))
    return lookup_join(df, bounds, keys, "inner").withColumn("_range", rng).drop("_bounds")


def ranges(df: DataFrame, keys: Sequence[str], value: str, splits: int = SPLITS) -> DataFrame:
    """`df` with `_range`, the place of `value` among bounds that cut each group evenly."""
    return _with_range(df, _sketch_bounds(df, keys, value, splits), keys, value)


def row_numbers(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    out: str = "rn",
    limit: int = GROUP_LIMIT,
    splits: int = SPLITS,
) -> DataFrame:
    """Number the rows of every group by `order`, whose first column is numeric and not null."""
    keys, order = list(keys), list(order)

    def direct(rows):
        w = Window.partitionBy(*keys).orderBy(*order)
        return rows.withColumn(out, F.row_number().over(w).cast("long"))

    def ranged(rows):
        cut = _with_range(rows, _sketch_bounds(rows, keys, order[0], splits), keys, order[0])
        before = Window.partitionBy(*keys).orderBy("_range").rowsBetween(
            Window.unboundedPreceding, -1
        )
        offsets = (
            cut.groupBy(*keys, "_range")
            .count()
            .withColumn("_offset", F.coalesce(F.sum("count").over(before), F.lit(0)))
            .drop("count")
        )
        inside = Window.partitionBy(*keys, "_range").orderBy(*order)
        numbered = cut.withColumn("_local", F.row_number().over(inside))
        joined = lookup_join(numbered, offsets, [*keys, "_range"], "inner")
        return joined.select(
            *rows.columns, (F.col("_local") + F.col("_offset")).cast("long").alias(out)
        )

    return by_size(df, keys, limit, direct, ranged)


def exact_median(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    out: str,
    limit: int = MEDIAN_LIMIT,
    accuracy: int = ACCURACY,
) -> DataFrame:
    """keys -> exact median of `value` over its non-null rows.

    A larger group is sketched in one pass. In another its values below and above the middle
    of the sketch are only counted, and so is each value in between. A group whose median is
    not in between after all is counted value by value.
    """
    keys = list(keys)
    values = df.where(F.col(value).isNotNull()).select(
        *keys, F.col(value).cast("double").alias("_v")
    )

    def direct(rows):
        return rows.groupBy(*keys).agg(F.median("_v").alias(out))

    def middle(rows, marks):
        side = F.when(F.col("_v") < F.col("_from"), -1).when(F.col("_v") > F.col("_to"), 1).otherwise(0)
        sided = lookup_join(rows, marks.select(*keys, "_from", "_to"), keys, "inner").withColumn("_side", side)
        tied = sided.groupBy(*keys, "_side", F.when(F.col("_side") == 0, F.col("_v")).alias("_v")).agg(F.count("*").alias("_w"))
        cum = F.sum("_w").over(Window.partitionBy(*keys).orderBy("_side", "_v"))
        ranked = lookup_join(tied.withColumn("_cum", cum), marks.select(*keys, "_n"), keys, "inner")
        # The ranks of the one or two middle rows, from 1.
        at = lambda rank: F.min(F.when(F.col("_cum") >= F.floor(rank), F.struct("_side", "_v")))
        found = ranked.groupBy(*keys).agg(at((F.col("_n") + 1) / 2).alias("_l"), at((F.col("_n") + 2) / 2).alias("_h"))
        return found.select(*keys, ((F.col("_l._v") + F.col("_h._v")) / 2).alias(out))

    def ranged(rows):
        # The sketch is off by one rank in `accuracy` at most; these points are two away from the middle.
        points = F.array(F.lit(max(0.0, 0.5 - 2 / accuracy)), F.lit(min(1.0, 0.5 + 2 / accuracy)))
        sketch = rows.groupBy(*keys).agg(F.count("*").alias("_n"), F.percentile_approx("_v", points, accuracy).alias("_b"))
        marks = cut_lineage(sketch.select(*keys, "_n", F.col("_b")[0].alias("_from"), F.col("_b")[1].alias("_to")), "marks")
        found = cut_lineage(middle(rows, marks), "medians")
        missed = marks.join(found.where(F.col(out).isNull()).select(*keys), keys, "left_semi")
        if missed.isEmpty():
            return found
        nothing = F.lit(None).cast("double")
        again = middle(rows, missed.withColumn("_from", nothing).withColumn("_to", nothing))
        return found.where(F.col(out).isNotNull()).unionByName(again)

    return by_size(values, keys, limit, direct, ranged)


def weighted_median(df: DataFrame, keys: Sequence[str], value: str, out: str) -> DataFrame:
    """Median of a column with few distinct values: counts first, then one small group."""
    tied = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("_w"))
    return tied.groupBy(*keys).agg(F.expr(f"percentile(`{value}`, 0.5, _w)").alias(out))


def suffix_minimum(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    value: str,
    out: str,
    limit: int = GROUP_LIMIT,
    splits: int = SPLITS,
) -> DataFrame:
    """For every row the minimum of `value` over rows at or after it by `order`."""
    keys = list(keys)

    def direct(rows):
        w = Window.partitionBy(*keys).orderBy(F.col(order).desc())
        return rows.withColumn(out, F.min(value).over(w))

    def ranged(rows):
        cut = _with_range(rows, _sketch_bounds(rows, keys, order, splits), keys, order)
        after = Window.partitionBy(*keys).orderBy(F.col("_range").desc()).rowsBetween(
            Window.unboundedPreceding, -1
        )
        later = (
            cut.groupBy(*keys, "_range")
            .agg(F.min(value).alias("_m"))
            .withColumn("_later", F.min("_m").over(after))
            .drop("_m")
        )
        inside = Window.partitionBy(*keys, "_range").orderBy(F.col(order).desc())
        local = cut.withColumn("_local", F.min(value).over(inside))
        joined = lookup_join(local, later, [*keys, "_range"], "inner")
        # least() skips nulls, so the last range needs no special case.
        return joined.select(*rows.columns, F.least("_local", "_later").alias(out))

    return by_size(df, keys, limit, direct, ranged)
