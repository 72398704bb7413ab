"""The shared-peptide rule: classes, assignment, roll-up and the evidence per protein."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as Ty

from umbra.errors import InputError, OptionError
from umbra.plans.joins import lookup_join
from umbra.plans.lineage import cut_lineage, spread
from umbra.plans.order import by_size, exact_median

CLASSES = ("unique", "taxon_unique", "family_unique", "shared", "shared_unknown_taxon")
# The classes each mode keeps.
MODES = {
    "protein_unique": ("unique",),
    "taxon_unique": ("unique", "taxon_unique"),
    "taxon_or_family_unique": ("unique", "taxon_unique", "family_unique"),
    "razor": CLASSES,
}


def explode_candidates(features: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One row per (feature, candidate protein)."""
    return features.select(
        *by, "feature_id", F.explode(F.array_distinct("candidates")).alias("protein_id")
    )


def attach_taxon(candidates: DataFrame, taxa: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """`taxid` per candidate; an empty taxid is missing."""
    right = taxa.select(*by, "protein_id", F.nullif("taxid", F.lit("")).alias("taxid"))
    return lookup_join(candidates, right, [*by, "protein_id"])


def attach_family(candidates: DataFrame, families: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return lookup_join(candidates, families.select(*by, "protein_id", "family_id"), [*by, "protein_id"])


def classify_features(
    candidates: DataFrame, by: Sequence[str] = (), use_family: bool = False
) -> DataFrame:
    """Class per feature from its distinct candidates in one aggregation.

    Whether all values are equal is min = max, so no distinct set is built and
    a feature with very many candidates is reduced before the shuffle.
    """
    one_taxon = F.min("taxid") == F.max("taxid")
    unknown = F.count_if(F.col("taxid").isNull())
    if use_family:
        family = (F.min("family_id") == F.max("family_id")) & (F.count("family_id") == F.count("*"))
    else:
        family = F.lit(False)
    klass = (
        F.when(F.count("*") == 1, "unique")
        .when((unknown == 0) & one_taxon, "taxon_unique")
        .when((unknown > 0) & F.coalesce(family, F.lit(False)), "family_unique")
        .when(unknown > 0, "shared_unknown_taxon")
        .otherwise("shared")
    )
    return candidates.groupBy(*by, "feature_id").agg(
        F.count("*").alias("n_candidates"), klass.alias("assignment_class")
    )


def check_mode(mode: str) -> tuple[str, ...]:
    if mode not in MODES:
        raise OptionError(f"peptide_assignment must be one of {sorted(MODES)}, not {mode!r}")
    return MODES[mode]


def check_families(families: DataFrame | None, by: Sequence[str] = ()) -> DataFrame:
    """The family rule needs families, and in every data set one with more than one member."""
    if families is None:
        raise InputError("taxon_or_family_unique needs family_id of every protein")
    sizes = families.groupBy(*by, "family_id").count()
    largest = sizes.groupBy(*by).agg(F.max("count").alias("n"))
    if largest.where("n > 1").limit(1).count() == 0 or largest.where("n <= 1").limit(1).count():
        raise InputError("taxon_or_family_unique: every family has one member")
    return families


def assign_features(
    features: DataFrame,
    taxa: DataFrame,
    mode: str = "taxon_unique",
    families: DataFrame | None = None,
    candidates: DataFrame | None = None,
    by: Sequence[str] = (),
) -> DataFrame:
    """(feature_id, razor, assignment_class, assigned): the protein is the razor or missing."""
    allowed = check_mode(mode)
    use_family = mode == "taxon_or_family_unique"
    pairs = candidates if candidates is not None else explode_candidates(features, by)
    pairs = attach_taxon(pairs, taxa, by)
    if use_family:
        pairs = attach_family(pairs, check_families(families, by), by)
    classes = classify_features(pairs, by, use_family)
    keep = F.col("assignment_class").isin(*allowed)
    return (
        features.select(*by, "feature_id", "razor")
        .join(classes, [*by, "feature_id"])
        .withColumn("assigned", F.when(keep, F.col("razor")))
    )


# ---------------------------------------------------------------- roll-up
def assigned_values(
    values: DataFrame, assigned: DataFrame, by: Sequence[str] = ()
) -> DataFrame:
    """Feature values with the protein they count for."""
    owner = assigned.where("assigned IS NOT NULL").select(
        *by, "feature_id", F.col("assigned").alias("protein_id")
    )
    return lookup_join(values, owner, [*by, "feature_id"], "inner")


def rollup_sum(rows: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Protein x sample sums. A sample in which every feature is missing has no row or NULL."""
    return rows.groupBy(*by, "protein_id", "sample").agg(F.sum("value").alias("value"))


def _middle(cells: np.ndarray, axis: int) -> np.ndarray:
    """Median along an axis over the cells that are present, NaN where none is."""
    filled = np.sort(cells, axis=axis)  # gaps come last
    n = (filled == filled).sum(axis=axis, keepdims=True)
    low = np.take_along_axis(filled, np.maximum(n - 1, 0) // 2, axis=axis)
    high = np.take_along_axis(filled, np.minimum(n // 2, cells.shape[axis] - 1), axis=axis)
    return ((low + high) / 2).squeeze(axis)


def _polish(cells: np.ndarray, iterations: int) -> tuple[np.ndarray, np.ndarray]:
    """Level per (protein, sample) of log cells (protein, feature, sample) with gaps, and whether the last sweep moved nothing."""
    rows = np.where(np.isnan(cells).all(axis=2), np.nan, 0.0)
    cols = np.where(np.isnan(cells).all(axis=1), np.nan, 0.0)
    overall = np.zeros(len(cells))
    moved = np.ones(len(cells), bool)
    # Proteins that still move; the others are left as they are.
    on, resid = np.arange(len(cells)), cells.copy()
    for _ in range(iterations):
        moving = np.zeros(len(on), bool)
        for axis, effects in ((2, rows), (1, cols)):
            step = _middle(resid, axis)
            moving |= (np.abs(np.nan_to_num(step)) > STILL).any(axis=1)
            resid -= np.expand_dims(step, axis)
            effect = effects[on] + step
            shift = _middle(effect, 1)
            effects[on] = effect - shift[:, None]
            overall[on] += shift
        moved[on] = moving
        on, resid = on[moving], resid[moving]
        if not len(on):
            break
    return overall[:, None] + cols, ~moved


def _group_median(values: np.ndarray, of: np.ndarray, n: int) -> np.ndarray:
    """Median of the values of each of `n` groups; every group has one."""
    order = np.lexsort((values, of))
    sorted_, count = values[order], np.bincount(of, minlength=n)
    first = np.cumsum(count) - count
    return (sorted_[first + (count - 1) // 2] + sorted_[first + count // 2]) / 2


def _polish_sparse(r: np.ndarray, c: np.ndarray, log: np.ndarray, n_rows: int, n_cols: int, iterations: int) -> tuple[np.ndarray, bool]:
    """The same for one protein by its observed cells alone."""
    resid, overall = log.copy(), 0.0
    rows, cols, moved = np.zeros(n_rows), np.zeros(n_cols), True
    for _ in range(iterations):
        moved = False
        for of, effect in ((r, rows), (c, cols)):
            step = _group_median(resid, of, len(effect))
            moved = moved or bool((np.abs(step) > STILL).any())
            resid -= step[of]
            effect += step
            shift = float(np.median(effect))
            effect -= shift
            overall += shift
        if not moved:
            break
    return overall + cols, not moved


#: A sweep whose medians are all this small has moved nothing.
STILL = 1e-12
#: Cells of a dense matrix of features and samples; a sparser protein is polished by its observed cells.
DENSE_CELLS = 200_000


def _numbers(lists) -> tuple[np.ndarray, np.ndarray]:
    """All values of the lists as numbers, and the values numbered."""
    flat = np.concatenate([x if isinstance(x, np.ndarray) else np.array(x, object) for x in lists])
    return pd.factorize(flat, use_na_sentinel=False)


def _numbered(of: np.ndarray, code: np.ndarray, kinds: int, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Number of each (protein, code), first number of each protein, and the code behind each number."""
    found, at = np.unique(of * kinds + code, return_inverse=True)
    return at, np.searchsorted(found, np.arange(n + 1) * kinds), found % kinds


def _spans(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The numbers of several ranges, one range after another."""
    return np.arange(count.sum()) + np.repeat(first - (np.cumsum(count) - count), count)


def _polish_packed(iterations: int, keys: list[str], chunk_cells: int = 1_000_000, dense_cells: int = DENSE_CELLS):
    """Rows of one protein each, its cells packed in arrays; proteins of similar size share a dense chunk.

    The cells of all proteins of a batch are numbered at once.
    """

    def run(batches):
        for pdf in batches:
            if not len(pdf):
                continue
            of = np.repeat(np.arange(len(pdf)), [len(x) for x in pdf["fs"]])
            (f, fs), (s, ss) = _numbers(pdf["fs"]), _numbers(pdf["ss"])
            row, row0, _ = _numbered(of, f, len(fs), len(pdf))
            col, col0, sample = _numbered(of, s, len(ss), len(pdf))
            n, m = np.diff(row0), np.diff(col0)
            cell, at = np.unique(row * m.max() + (col - col0[of]), return_inverse=True)
            value = np.bincount(at, np.concatenate([np.asarray(x, float) for x in pdf["vs"]]), len(cell))
            row, c = cell // m.max(), cell % m.max()
            cell0 = np.searchsorted(row, row0)
            n_cells = np.diff(cell0)
            of = np.repeat(np.arange(len(pdf)), n_cells)
            total = np.bincount(of, value, len(pdf))
            r, log = row - row0[of], np.log2(value)
            order = np.lexsort((m, n, n * m > dense_cells))
            start = 0
            while start < len(order):
                first = order[start]
                end, most = start + 1, m[first]
                if n[first] * m[first] > dense_cells:
                    part = order[start:end]
                    own = slice(cell0[first], cell0[first + 1])
                    level, still = _polish_sparse(r[own], c[own], log[own], n[first], m[first], iterations)
                    still = np.array([still])
                else:
                    while end < len(order):
                        wider = max(most, m[order[end]])
                        size = n[order[end]] * wider
                        if size > dense_cells or (end + 1 - start) * size > chunk_cells:
                            break
                        end, most = end + 1, wider
                    part = order[start:end]
                    wide = np.full((len(part), n[part].max(), most), np.nan)
                    own = _spans(cell0[part], n_cells[part])
                    wide[np.repeat(np.arange(len(part)), n_cells[part]), r[own], c[own]] = log[own]
                    level, still = _polish(wide, iterations)
                    level = level[np.arange(most) < m[part][:, None]]
                x = 2.0**level
                k = np.repeat(np.arange(len(part)), m[part])
                out = pdf[keys].iloc[part[k]].reset_index(drop=True)
                out["sample"] = ss[sample[_spans(col0[part], m[part])]]
                out["value"] = x * (total[part] / np.bincount(k, x))[k]
                out["converged"] = still[k]
                yield out
                start = end

    return run


def _polish_large(rows: DataFrame, by: Sequence[str], iterations: int, limit: int) -> DataFrame:
    """The same polish as joins of medians, for proteins too large for one task."""
    prot = [*by, "protein_id"]
    cells = rows.groupBy(*prot, "feature_id", "sample").agg(F.sum("value").alias("value"))
    resid = cut_lineage(
        cells.withColumn("r", F.log2("value")), "polish"
    )
    feats = resid.select(*prot, "feature_id").distinct().withColumn("row", F.lit(0.0))
    cols = resid.select(*prot, "sample").distinct().withColumn("col", F.lit(0.0))
    overall = resid.select(*prot).distinct().withColumn("all", F.lit(0.0))
    totals = resid.groupBy(*prot).agg(F.sum("value").alias("total"))
    moved_by = None
    for _ in range(iterations):
        steps = []
        for side, name, table in (("feature_id", "row", feats), ("sample", "col", cols)):
            step = cut_lineage(exact_median(resid, [*prot, side], "r", "step", limit), "step")
            steps.append(step.select(*prot, F.abs("step").alias("step")))
            resid = cut_lineage(
                lookup_join(resid, step, [*prot, side])
                .withColumn("r", F.col("r") - F.col("step"))
                .drop("step"),
                "polish",
            )
            moved = lookup_join(table, step, [*prot, side]).withColumn(
                name, F.col(name) + F.col("step")
            ).drop("step")
            shift = exact_median(moved, prot, name, "shift", limit)
            moved = lookup_join(moved, shift, prot).withColumn(
                name, F.col(name) - F.col("shift")
            ).drop("shift")
            overall = cut_lineage(
                lookup_join(overall, shift, prot).withColumn("all", F.col("all") + F.col("shift")).drop("shift"),
                "overall",
            )
            moved = cut_lineage(moved, name)
            feats, cols = (moved, cols) if name == "row" else (feats, moved)
        moved_by = cut_lineage(steps[0].unionByName(steps[1]).groupBy(*prot).agg((F.max("step") <= STILL).alias("converged")), "moved")
        if not moved_by.where("NOT converged").limit(1).count():
            break
    level = lookup_join(cols, overall, prot).withColumn(
        "level", F.pow(F.lit(2.0), F.col("all") + F.col("col"))
    )
    sums = level.groupBy(*prot).agg(F.sum("level").alias("level_total"))
    scaled = lookup_join(lookup_join(lookup_join(level, sums, prot), totals, prot), moved_by, prot)
    return scaled.select(
        *prot, "sample", (F.col("level") * F.col("total") / F.col("level_total")).alias("value"), "converged"
    )


def rollup_median_polish(
    rows: DataFrame, by: Sequence[str] = (), iterations: int = 10, cell_limit: int = 2_000_000
) -> DataFrame:
    """Log-space median polish per protein, rescaled to the protein's summed total.

    A protein within `cell_limit` observed cells is polished in one task, which holds its
    observed cells, and a dense matrix only where that is small. A larger one is polished
    by distributed medians, so no task holds it. `converged` tells whether the last of at
    most `iterations` sweeps moved nothing. The values are written once, since they are
    counted before they are polished.
    """
    prot = [*by, "protein_id"]
    rows = cut_lineage(rows.where("value > 0").select(*prot, "feature_id", "sample", "value"), "values")
    order = [*prot, "sample", "value", "converged"]

    def small(part: DataFrame) -> DataFrame:
        cells = F.array_agg(F.struct("feature_id", "sample", "value"))
        packed = spread(part, prot).groupBy(*prot).agg(cells.alias("_c")).select(
            *prot,
            F.col("_c.feature_id").alias("fs"),
            F.col("_c.sample").alias("ss"),
            F.col("_c.value").alias("vs"),
        )
        fields = [f for f in packed.schema.fields if f.name in prot]
        schema = Ty.StructType(
            fields + [Ty.StructField("sample", Ty.StringType()), Ty.StructField("value", Ty.DoubleType()), Ty.StructField("converged", Ty.BooleanType())]
        )
        return packed.mapInPandas(_polish_packed(iterations, prot), schema)

    def large(part: DataFrame) -> DataFrame:
        return _polish_large(part, by, iterations, cell_limit).select(*order)

    return by_size(rows, prot, cell_limit, small, large)


def rollup(
    rows: DataFrame, method: str = "sum", by: Sequence[str] = ()
) -> DataFrame:
    if method == "sum":
        return rollup_sum(rows, by)
    if method == "median_polish":
        return rollup_median_polish(rows, by)
    raise OptionError(f"rollup_method must be one of ['median_polish', 'sum'], not {method!r}")


# ---------------------------------------------------------------- evidence
def peptide_evidence(
    assigned: DataFrame, mode: str = "taxon_unique", method: str = "sum", by: Sequence[str] = ()
) -> DataFrame:
    """Feature counts per razor protein, also where every feature was dropped.

    Class counts are of assigned features: a dropped feature is nothing an
    intensity rests on.
    """
    check_mode(mode)
    used = F.col("assigned").isNotNull()

    def n(klass: str):
        return F.count_if(used & (F.col("assignment_class") == klass))

    out = assigned.groupBy(*by, F.col("razor").alias("protein_id")).agg(
        F.count_if(used).alias("n_features_used"),
        n("unique").alias("n_unique"),
        n("taxon_unique").alias("n_taxon_unique"),
        n("family_unique").alias("n_family_unique"),
        n("shared").alias("n_shared"),
        n("shared_unknown_taxon").alias("n_shared_unknown_taxon"),
        F.count_if(~used).alias("n_features_dropped"),
    )
    return dominance_flags(out).withColumn("rollup_method", F.lit(method)).withColumn(
        "peptide_assignment", F.lit(mode)
    )


def dominance_flags(evidence: DataFrame) -> DataFrame:
    """Resting more on shared features than on placing ones; a tie is no."""
    taxon = F.col("n_taxon_unique") + F.col("n_family_unique")
    cross = F.col("n_shared") + F.col("n_shared_unknown_taxon")
    return evidence.withColumn("taxon_unique_dominated", taxon > F.col("n_unique")).withColumn(
        "shared_dominated", cross > F.col("n_unique") + taxon
    )


def dominance_rate(evidence: DataFrame, by: Sequence[str] = (), minimum: int = 10) -> DataFrame:
    """Dominated proteins among those with an assigned feature.

    No percentage below `minimum` proteins; under razor the rate is a floor;
    nothing is reported where no protein is flagged.
    """
    used = F.col("n_features_used") > 0
    out = evidence.groupBy(*by).agg(
        F.count_if(used).alias("n_proteins"),
        F.count_if(used & F.col("taxon_unique_dominated")).alias("n_dominated"),
        F.count_if(used & F.col("shared_dominated")).alias("n_shared_dominated"),
        F.count_if(~used).alias("n_left_out"),
        F.bool_or(F.col("peptide_assignment") == "razor").alias("is_floor"),
    )
    pct = 100.0 * F.col("n_dominated") / F.nullif(F.col("n_proteins"), F.lit(0))
    return out.withColumn("percent", F.when(F.col("n_proteins") >= minimum, F.round(pct, 1))).where(
        "n_dominated > 0 OR n_shared_dominated > 0"
    )


def min_features_per_protein(
    values: DataFrame, evidence: DataFrame, minimum: int = 1, by: Sequence[str] = ()
) -> DataFrame:
    """Proteins with at least `minimum` assigned features."""
    keep = evidence.where(F.col("n_features_used") >= F.lit(minimum)).select(*by, "protein_id")
    return lookup_join(values, keep, [*by, "protein_id"], "left_semi")


def subset_to_quant(
    proteins: DataFrame, features: DataFrame, by: Sequence[str] = ()
) -> tuple[DataFrame, DataFrame]:
    """Proteins a quant table names, and the ids it names that have no sequence."""
    named = explode_candidates(features, by).select(*by, "protein_id").distinct()
    keys = [*by, "protein_id"]
    return proteins.join(named, keys, "left_semi"), named.join(proteins, keys, "left_anti")


def subsample_proteins(proteins: DataFrame, n: int) -> DataFrame:
    """A reproducible sample of `n` proteins by the hash of their id."""
    return proteins.orderBy(F.md5(F.col("protein_id").cast("string").cast("binary")), "protein_id").limit(n)
