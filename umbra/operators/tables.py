"""Result tables: annotated quant, protein groups, the funnel and the shortlist."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from umbra.plans.joins import assert_unique, lookup_join


def annotate_quant(
    quant: DataFrame,
    sides: Sequence[DataFrame],
    by: Sequence[str] = (),
    check_keys: bool = True,
) -> DataFrame:
    """Quant rows with annotation, evidence and taxonomy columns.

    A repeated key on a right side would add rows, so it is refused.
    """
    keys = [*by, "protein_id"]
    out = quant
    for i, side in enumerate(sides):
        if check_keys:
            assert_unique(side, keys, f"table {i + 1} joined to the quant table")
        fresh = [c for c in side.columns if c in keys or c not in out.columns]
        out = lookup_join(out, side.select(*fresh), keys)
    return out


def group_members(groups: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """`A;B;C` protein groups as one row per member."""
    parts = F.array_distinct(F.filter(F.transform(F.split("group_id", ";"), lambda x: F.trim(x)), lambda x: x != ""))
    return groups.select(*by, "group_id", F.explode(parts).alias("protein_id"))


def group_conflicts(groups: DataFrame, annotation: DataFrame, by: Sequence[str] = (), name: Sequence[str] = ("group_id",)) -> DataFrame:
    """Per protein group: members with different bins or KOs, or no annotation at all.

    Members without an annotation row count only when no member has one. `name` are the columns
    of `groups` that name a group within a data set; with short names the lists of members
    are not carried along.
    """
    keys = [*by, "protein_id"]
    side = annotation.select(
        *keys, "bin", F.nullif(F.array_join(F.array_sort("ko"), ","), F.lit("")).alias("ko_set")
    )
    members = group_members(groups, [*by, *(c for c in name if c != "group_id")]).select(*by, *name, "protein_id")
    rows = lookup_join(members, side, keys)
    return rows.groupBy(*by, *name).agg(
        F.count("*").alias("n_members"),
        F.coalesce(F.min("bin") != F.max("bin"), F.lit(False)).alias("bin_conflict"),
        F.coalesce(F.min("ko_set") != F.max("ko_set"), F.lit(False)).alias("ko_conflict"),
        (F.count("bin") == 0).alias("unannotated_group"),
    )


class Step(NamedTuple):
    """One funnel step: what was done, what is counted, and in which rows.

    `count` is an aggregate of the rows; without one all rows count.
    """

    step: str
    unit: str
    why: str
    rows: DataFrame
    count: Column | None = None


def quant_funnel(steps: Sequence[Step], by: Sequence[str] = ()) -> DataFrame:
    """Ordered steps with before, after and dropped, chained within each unit.

    Steps over the same table are counted in one pass over it. A filter that removes nothing
    is a row too. `dropped` is negative where a step's rows are not a subset of the step
    before. A data set without a row in some table has no step there.
    """
    tables: dict[int, list[tuple[int, Step]]] = {}
    for i, s in enumerate(steps):
        tables.setdefault(id(s.rows), []).append((i, s))
    out = None
    for same in tables.values():
        counts = [(F.count("*") if s.count is None else s.count).cast("bigint").alias(f"_n{i}") for i, s in same]
        each = [
            F.struct(F.lit(i).alias("step_order"), F.lit(s.step).alias("step"), F.lit(s.unit).alias("unit"), F.col(f"_n{i}").alias("after"), F.lit(s.why).alias("why"))
            for i, s in same
        ]
        counted = same[0][1].rows.groupBy(*by).agg(*counts).select(*by, F.inline(F.array(*each)))
        out = counted if out is None else out.unionByName(counted)
    w = Window.partitionBy(*by, "unit").orderBy("step_order")
    before = F.lag("after").over(w)
    return out.withColumn("before", before).withColumn("dropped", before - F.col("after")).select(
        *by, "step_order", "step", "unit", "before", "after", "dropped", "why"
    )


def candidate_shortlist(results: DataFrame, by: Sequence[str] = (), alpha: float = 0.05) -> DataFrame:
    """Significant, no KO and predicted to reach the host, best export score first."""
    gate = (F.col("q_value") < alpha) & ~F.col("has_ko") & F.col("surface_or_secreted")
    return results.where(gate).orderBy(*by, F.col("export_score").desc(), "protein_id")


def shortlist_population(results: DataFrame, by: Sequence[str] = (), alpha: float = 0.05) -> DataFrame:
    """How many proteins each condition of the shortlist leaves; says why one is empty."""
    significant = F.col("q_value") < alpha
    return results.groupBy(*by).agg(
        F.count("*").alias("n_tested"),
        F.count_if(significant).alias("n_significant"),
        F.count_if(~F.col("has_ko")).alias("n_without_ko"),
        F.count_if(F.col("surface_or_secreted")).alias("n_surface"),
        F.count_if(significant & ~F.col("has_ko") & F.col("surface_or_secreted")).alias("n_listed"),
    )
