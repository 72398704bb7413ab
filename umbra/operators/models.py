"""Per-protein linear models with moderated statistics, and what follows from them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as Ty

from umbra.functions.stats import digamma, trigamma, trigamma_inverse
from umbra.functions.tails import hypergeometric_tail, t_two_sided
from umbra.operators.coding import Model, coded_design, codings, model_of
from umbra.operators.design import with_design
from umbra.plans.joins import lookup_join
from umbra.plans.lineage import cut_lineage, spread
from umbra.plans.order import by_size, exact_median, ranges, suffix_minimum

CONTRASTS = Ty.ArrayType(
    Ty.StructType(
        [
            Ty.StructField("contrast", Ty.StringType()),
            Ty.StructField("lfc", Ty.DoubleType()),
            Ty.StructField("stdev_unscaled", Ty.DoubleType()),
        ]
    )
)
COEFFICIENTS = Ty.ArrayType(
    Ty.StructType(
        [
            Ty.StructField("coefficient", Ty.StringType()),
            Ty.StructField("estimate", Ty.DoubleType()),
            Ty.StructField("stdev_unscaled", Ty.DoubleType()),
        ]
    )
)


class Pattern(NamedTuple):
    """The decomposition that all proteins observed in the same samples share."""

    x: np.ndarray
    u: np.ndarray
    half: np.ndarray  # c @ half has the length stdev_unscaled of a combination c of coefficients
    null: np.ndarray  # projects on what the samples do not determine
    df: int

    def estimable(self, c: np.ndarray) -> bool:
        return bool(np.abs(self.null @ c).max(initial=0.0) <= 1e-8)

    def deviation(self, c: np.ndarray) -> float:
        """The unscaled deviation of a combination of coefficients."""
        return float(np.sqrt(((c @ self.half) ** 2).sum()))

    def fit(self, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least-squares coefficients and residual variance of each column of `y`."""
        beta = self.half @ (self.u.T @ y)
        if self.df <= 0:
            return beta, np.full(y.shape[1], np.nan)
        return beta, ((y - self.x @ beta) ** 2).sum(axis=0) / self.df


def pattern_of(x: np.ndarray) -> Pattern:
    """The decomposition of the rows of the design in `x`."""
    n, p = x.shape
    u, s, vt = np.linalg.svd(x, full_matrices=False)
    keep = s > s.max() * max(n, p) * np.finfo(float).eps
    return Pattern(x, u[:, keep], vt[keep].T / s[keep], np.eye(p) - vt[keep].T @ vt[keep], n - int(keep.sum()))


def _weights(names: Sequence[str], levels: Sequence[str], first: int, full: bool, wanted: Mapping[str, Mapping[str, float]] | None) -> dict[str, np.ndarray]:
    """Contrasts as weights of the coefficients: those asked for, or later minus earlier level of the first factor."""
    out = {}
    if wanted is not None:
        at = {n: k for k, n in enumerate(names)}
        for contrast, of in wanted.items():
            if all(n in at for n in of):  # a data set without such a level has no such contrast
                out[contrast] = np.zeros(len(names))
                for n, w in of.items():
                    out[contrast][at[n]] = w
        return out
    place = [first + i if full else first + i - 1 for i in range(len(levels))]
    for i, early in enumerate(levels):
        for j in range(i + 1, len(levels)):
            c = np.zeros(len(names))
            c[place[j]] += 1.0
            if full or i:
                c[place[i]] -= 1.0
            out[f"{levels[j]}_vs_{early}"] = c
    return out


#: Decompositions a task remembers; without missing values there is one.
PATTERNS = 4096


class _Cells:
    """Lists of (name, value, deviation), each row's of the same length as its pattern has names."""

    def __init__(self, name: str, value: str):
        self.fields = (name, value, "stdev_unscaled")
        self.names: dict[str, int] = {}
        self.codes, self.values, self.deviations, self.sizes = [], [], [], []

    def add(self, names: Sequence[str], values: np.ndarray, deviations: np.ndarray) -> None:
        """`values` has a row for each protein; NaN is a value that the samples do not determine."""
        n = len(values)
        self.codes.append(np.tile(np.array([self.names.setdefault(x, len(self.names)) for x in names], np.int32), n))
        self.values.append(values.ravel())
        self.deviations.append(np.tile(deviations, n))
        self.sizes.append(np.full(n, len(names), np.int32))

    def array(self) -> pa.Array:
        number = lambda parts: (lambda v: pa.array(v, pa.float64(), mask=np.isnan(v)))(np.concatenate(parts))
        names = pa.array(list(self.names), pa.string()).take(pa.array(np.concatenate(self.codes)))
        offsets = np.concatenate([[0], np.cumsum(np.concatenate(self.sizes))]).astype(np.int32)
        cells = pa.StructArray.from_arrays([names, number(self.values), number(self.deviations)], names=list(self.fields))
        return pa.ListArray.from_arrays(pa.array(offsets), cells)


def _fit_batches(keys: list[str], first: int, full: bool, wanted: Mapping[str, Mapping[str, float]] | None):
    """Rows (keys, design rows one after another, values, names, levels) of an Arrow batch are fitted a pattern at a time."""

    def run(batches):
        known: dict[tuple, tuple] = {}

        def solved(x: bytes, names: tuple, levels: tuple):
            if (x, names, levels) not in known:
                if len(known) >= PATTERNS:
                    known.clear()
                pattern = pattern_of(np.frombuffer(x).reshape(-1, len(names)))
                asked = {k: c for k, c in _weights(names, levels, first, full, wanted).items() if pattern.estimable(c)}
                own = np.array([pattern.estimable(c) for c in np.eye(len(names))])
                known[x, names, levels] = (
                    pattern, list(asked), np.array(list(asked.values())).reshape(-1, len(names)),
                    np.array([pattern.deviation(c) for c in asked.values()]), own,
                    np.array([pattern.deviation(c) if e else np.nan for c, e in zip(np.eye(len(names)), own)]),
                )
            return known[x, names, levels]

        for batch in batches:
            if not batch.num_rows:
                continue
            column = lambda c: batch.column(batch.schema.get_field_index(c))
            flat = [np.ascontiguousarray(column(c).flatten().to_numpy(zero_copy_only=False), dtype=float) for c in ("xs", "ys")]
            at = [np.concatenate([[0], np.cumsum(pc.list_value_length(column(c)).to_numpy(zero_copy_only=False))]) for c in ("xs", "ys")]
            shapes = list(zip(map(tuple, column("names").to_pylist()), map(tuple, column("levels").to_pylist())))
            xs, cut = flat[0].tobytes(), (8 * at[0]).tolist()
            patterns: dict[tuple, list[int]] = {}
            for i, (names, levels) in enumerate(shapes):
                patterns.setdefault((xs[cut[i] : cut[i + 1]], names, levels), []).append(i)
            contrasts, coefficients = _Cells("contrast", "lfc"), _Cells("coefficient", "estimate")
            order, sigma2, df, seen = [], [], [], []
            for key, idx in patterns.items():
                pattern, asked, weights, deviations, own, own_deviations = solved(*key)
                n = len(pattern.x)
                beta, s2 = pattern.fit(flat[1][at[1][idx][:, None] + np.arange(n)].T)
                contrasts.add(asked, (weights @ beta).T, deviations)
                coefficients.add(key[1], np.where(own[:, None], beta, np.nan).T, own_deviations)
                order += idx
                sigma2.append(s2)
                df.append(np.full(len(idx), pattern.df, np.int64))
                seen.append(np.full(len(idx), n, np.int64))
            rows, s2 = pa.array(order, pa.int64()), np.concatenate(sigma2)
            yield pa.RecordBatch.from_arrays(
                [*[column(k).take(rows) for k in keys], pa.array(np.concatenate(seen)), pa.array(s2, mask=np.isnan(s2)),
                 pa.array(np.concatenate(df)), contrasts.array(), coefficients.array()],
                names=[*keys, "n_observed", "sigma2", "df_residual", "contrasts", "coefficients"],
            )

    return run


def fit_proteins(
    values: DataFrame,
    design: DataFrame,
    terms: Model | str | Sequence[str] = ("group",),
    by: Sequence[str] = (),
    contrasts: Mapping[str, Mapping[str, float]] | None = None,
) -> DataFrame:
    """Linear model per protein on its observed samples: one row per protein.

    `values` is log2 and has one row per (protein, sample), so a protein brings
    at most one number per sample of its experiment. Proteins with the same
    observed samples share one decomposition. `terms` is a model (see `coding`):
    products such as `group:plex` or `group:age` are allowed, numeric columns are
    covariates and others factors. Contrasts are all pairs of levels of the first
    factor, unless `contrasts` gives weights of coefficients by name; those that
    a protein's samples do not determine are left out, and such coefficients are
    NULL. A sample without a value of some column takes no part.
    """
    keys = [*by, "protein_id"]
    model = model_of(terms)
    coded = cut_lineage(coded_design(design, model, by), "coded")
    numeric = [c for c in model.columns if isinstance(design.schema[c].dataType, Ty.NumericType)]
    full = codings(model, numeric)[0][0][1]
    rows = with_design(values.where("value IS NOT NULL"), coded, ["x"], by)
    cells = F.array_sort(F.collect_list(F.struct("sample", "x", F.col("value").alias("y"))))
    packed = spread(rows, keys).groupBy(*keys).agg(cells.alias("_c")).select(
        *keys, F.flatten(F.transform("_c", lambda c: c["x"])).alias("xs"), F.transform("_c", lambda c: c["y"]).alias("ys")
    )
    shapes = coded.select(*by, "names", "levels").distinct()  # one row for each data set
    if by:
        packed = lookup_join(packed, shapes, by, "inner")
    else:
        shape = shapes.first()
        for c in ("names", "levels"):
            of = F.array(*[F.lit(x) for x in (shape[c] if shape else [])]).cast("array<string>")
            packed = packed.withColumn(c, of)
    schema = Ty.StructType(
        [f for f in packed.schema.fields if f.name in keys]
        + [
            Ty.StructField("n_observed", Ty.LongType()),
            Ty.StructField("sigma2", Ty.DoubleType()),
            Ty.StructField("df_residual", Ty.LongType()),
            Ty.StructField("contrasts", CONTRASTS),
            Ty.StructField("coefficients", COEFFICIENTS),
        ]
    )
    return packed.mapInArrow(_fit_batches(keys, int(model.intercept), full, contrasts), schema)


def _prior(pdf: pd.DataFrame) -> tuple[float, float, float]:
    """Moment estimate of the prior from (df, n, sum of log s2, sum of squares)."""
    d, n = pdf["df_residual"].to_numpy(float), pdf["n"].to_numpy(float)
    bias = np.log(d / 2) - digamma(d / 2)
    total = n.sum()
    sum_e = (pdf["sum_z"].to_numpy(float) + n * bias).sum()
    sum_e2 = (pdf["sum_z2"].to_numpy(float) + 2 * bias * pdf["sum_z"].to_numpy(float) + n * bias**2).sum()
    mean = sum_e / total
    if total < 2:
        return 0.0, float(np.exp(mean)), float((d * n).sum())
    var = (sum_e2 - total * mean**2) / (total - 1) - (n * trigamma(d / 2)).sum() / total
    pooled = float((d * n).sum())
    if var > 0:
        d0 = 2 * trigamma_inverse(var)
        half = np.array([d0 / 2])
        return d0, float(np.exp(mean + digamma(half)[0] - np.log(d0 / 2))), pooled
    return float("inf"), float(np.exp(mean)), pooled


def variance_prior(fits: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Prior degrees of freedom and variance per data set.

    Variances are reduced to sums per residual df first, so the estimate sees
    at most one row per sample count.
    """
    s2 = fits.where("df_residual > 0 AND sigma2 IS NOT NULL")
    key = list(by) if by else ["_all"]
    s2 = s2 if by else s2.withColumn("_all", F.lit(1))
    mid = exact_median(s2, key, "sigma2", "_mid")
    if by:
        s2 = lookup_join(s2, mid, key, "inner")
    else:
        one = mid.first()
        s2 = s2.withColumn("_mid", F.lit(one["_mid"] if one else None).cast("double"))
    floored = s2.withColumn(
        "_z", F.ln(F.greatest("sigma2", 1e-5 * F.col("_mid"), F.lit(1e-300)))
    )
    sums = floored.groupBy(*key, "df_residual").agg(
        F.count("*").alias("n"),
        F.sum("_z").alias("sum_z"),
        F.sum(F.col("_z") * F.col("_z")).alias("sum_z2"),
    )
    fields = [f for f in sums.schema.fields if f.name in key]
    schema = Ty.StructType(
        fields + [Ty.StructField(c, Ty.DoubleType()) for c in ("df_prior", "s2_prior", "df_pooled")]
    )

    def estimate(pdf: pd.DataFrame) -> pd.DataFrame:
        d0, s20, pooled = _prior(pdf)
        row = {c: [pdf[c].iloc[0]] for c in key}
        return pd.DataFrame({**row, "df_prior": [d0], "s2_prior": [s20], "df_pooled": [pooled]})

    return sums.groupBy(*key).applyInPandas(estimate, schema)


def moderated_contrasts(
    fits: DataFrame, by: Sequence[str] = (), moderate: bool = True
) -> DataFrame:
    """One row per (protein, contrast) with t, p and the variance behind it.

    A protein without residual degrees of freedom takes the prior's variance, and is tested
    where the prior is informative. A protein or contrast that cannot be tested keeps a row
    with NULLs when moderated; without moderation it is left out.
    """
    rows = fits if moderate else fits.where("df_residual > 0 AND sigma2 IS NOT NULL")
    if moderate:
        prior = variance_prior(fits, by)
        if by:
            rows = lookup_join(rows, prior, by)
        else:
            one = prior.first()
            for c in ("df_prior", "s2_prior", "df_pooled"):
                rows = rows.withColumn(c, F.lit(one[c] if one else None).cast("double"))
        d0, d = F.col("df_prior"), F.col("df_residual")
        mixed = (d * F.col("sigma2") + d0 * F.col("s2_prior")) / (d + d0)
        alone = (d == 0) | F.col("sigma2").isNull()
        s2 = F.when(alone & (d0 == 0), None).when(alone | (d0 == float("inf")), F.col("s2_prior")).otherwise(mixed)
        rows = rows.withColumn("s2_post", s2)
        rows = rows.withColumn("df_total", F.when(F.col("s2_post").isNotNull(), F.least(d + d0, F.col("df_pooled"))))
    else:
        rows = rows.withColumn("s2_post", F.col("sigma2")).withColumn(
            "df_total", F.col("df_residual").cast("double")
        )
    out = rows.select(
        *by, "protein_id", "n_observed", "sigma2", "df_residual", "s2_post", "df_total",
        (F.explode_outer if moderate else F.explode)("contrasts").alias("_c"),
    ).select(*by, "protein_id", "_c.contrast", "_c.lfc", "n_observed", "sigma2", "df_residual",
             "s2_post", "df_total", "_c.stdev_unscaled")
    se = F.col("stdev_unscaled") * F.sqrt("s2_post")
    t = F.col("lfc") / F.nullif(se, F.lit(0.0))
    return out.withColumn("t", t).withColumn("p_value", t_two_sided(F.col("t"), F.col("df_total")))


def select_contrasts(results: DataFrame, wanted: Sequence[str] = ()) -> DataFrame:
    """All pairwise contrasts, or those named in the options."""
    return results.where(F.col("contrast").isin(*wanted) | F.col("contrast").isNull()) if wanted else results


def bh_adjust(
    results: DataFrame,
    keys: Sequence[str] = ("contrast",),
    p: str = "p_value",
    out: str = "q_value",
    limit: int = 2_000_000,
    splits: int = 200,
) -> DataFrame:
    """Benjamini-Hochberg within every key: p * n / rank, then minima from the largest p down.

    Ranks are of distinct p values, each by the rank of its last tie, so that ties are one
    row. A row without a p value keeps none.
    """
    keys = list(keys)
    counted = cut_lineage(results.where(F.col(p).isNotNull()).groupBy(*keys, p).agg(F.count("*").alias("_k")), "p_values")

    def direct(part):
        ascending = Window.partitionBy(*keys).orderBy(p)
        total = F.sum("_k").over(Window.partitionBy(*keys))
        raw = F.col(p) * total / F.sum("_k").over(ascending)
        lowest = F.min("_raw").over(Window.partitionBy(*keys).orderBy(F.col(p).desc()))
        return part.withColumn("_raw", raw).select(*keys, p, F.least(lowest, F.lit(1.0)).alias(out))

    def ranged(part):
        cut = ranges(part, keys, p, splits)
        sizes = cut.groupBy(*keys, "_range").agg(F.sum("_k").alias("_in"))
        upto = F.sum("_in").over(Window.partitionBy(*keys).orderBy("_range")) - F.col("_in")
        offsets = sizes.select(*keys, "_range", upto.alias("_before"), F.sum("_in").over(Window.partitionBy(*keys)).alias("_n"))
        inside = F.sum("_k").over(Window.partitionBy(*keys, "_range").orderBy(p))
        raw = lookup_join(cut.withColumn("_inside", inside), offsets, [*keys, "_range"], "inner")
        raw = raw.select(*keys, p, (F.col(p) * F.col("_n") / (F.col("_before") + F.col("_inside"))).alias("_raw"))
        lowest = suffix_minimum(raw, keys, p, "_raw", "_q", limit, splits)
        return lowest.select(*keys, p, F.least("_q", F.lit(1.0)).alias(out))

    return lookup_join(results, by_size(counted, keys, limit, direct, ranged), [*keys, p]).select(*results.columns, out)


def differential_abundance(
    values: DataFrame,
    design: DataFrame,
    terms: Model | str | Sequence[str] = ("group",),
    contrasts: Sequence[str] | Mapping[str, Mapping[str, float]] = (),
    by: Sequence[str] = (),
) -> DataFrame:
    """Fit, moderate and adjust. `contrasts` selects by name, or gives weights of coefficients. The fits are written once: several passes read them."""
    weights = contrasts if isinstance(contrasts, Mapping) else None
    fits = cut_lineage(fit_proteins(values, design, terms, by, weights), "fits")
    return adjusted_contrasts(fits, () if weights else contrasts, by)


def adjusted_contrasts(fits: DataFrame, contrasts: Sequence[str] = (), by: Sequence[str] = ()) -> DataFrame:
    """Moderated and adjusted contrasts of written fits."""
    tested = cut_lineage(select_contrasts(moderated_contrasts(fits, by), contrasts), "tests")
    return bh_adjust(tested, [*by, "contrast"])


# ---------------------------------------------------------------- organism reference
def ratio_values(
    values: DataFrame, taxa: DataFrame, factors: DataFrame, by: Sequence[str] = ()
) -> DataFrame:
    """log2 value minus log2 size factor of the protein's organism; no factor, no row."""
    owned = lookup_join(values, taxa.select(*by, "protein_id", "taxid"), [*by, "protein_id"], "inner")
    side = factors.where("factor > 0").select(*by, "taxid", "sample", "factor")
    joined = lookup_join(owned, side, [*by, "taxid", "sample"], "inner")
    return joined.withColumn("value", F.col("value") - F.log2("factor")).drop("factor")


def ratio_model(
    values: DataFrame,
    taxa: DataFrame,
    factors: DataFrame,
    design: DataFrame,
    terms: Model | str | Sequence[str] = ("group",),
    by: Sequence[str] = (),
    fits: DataFrame | None = None,
) -> DataFrame:
    """Naive and organism-adjusted result of the first contrast for proteins with a usable taxon.

    `fits` are those of `values` by the same design and terms where they are written already:
    a protein's fit does not depend on the other proteins.
    """
    adjusted_values = cut_lineage(ratio_values(values, taxa, factors, by), "ratios")
    usable = adjusted_values.select(*by, "protein_id").distinct()
    if fits is None:
        naive = differential_abundance(lookup_join(values, usable, [*by, "protein_id"], "left_semi"), design, terms, by=by)
    else:
        naive = adjusted_contrasts(cut_lineage(lookup_join(fits, usable, [*by, "protein_id"], "left_semi"), "fits"), by=by)
    adjusted = differential_abundance(adjusted_values.drop("taxid"), design, terms, by=by)
    keys = [*by, "protein_id", "contrast"]
    first = naive.groupBy(*by).agg(F.min("contrast").alias("contrast")) if by else None
    if first is not None:
        naive = lookup_join(naive, first, [*by, "contrast"], "left_semi")
    else:
        naive = naive.where(F.col("contrast") == F.lit(naive.agg(F.min("contrast")).first()[0]))
    a = naive.select(*keys, F.col("lfc").alias("lfc_naive"), F.col("q_value").alias("q_naive"))
    b = adjusted.select(*keys, F.col("lfc").alias("lfc_adj"), F.col("q_value").alias("q_adj"))
    return a.join(b, keys).join(taxa.select(*by, "protein_id", "taxid"), [*by, "protein_id"])


def factor_fold_change(
    factors: DataFrame, design: DataFrame, early: str, late: str, by: Sequence[str] = ()
) -> DataFrame:
    """log2 fold change of each organism's factor between two levels."""
    rows = with_design(factors.where("factor > 0"), design, ["group"], by)
    log = F.log2("factor")
    return rows.groupBy(*by, "taxid").agg(
        (F.avg(F.when(F.col("group") == late, log)) - F.avg(F.when(F.col("group") == early, log))).alias(
            "factor_log2fc"
        ),
        F.min("method").alias("method"),
    )


def factor_changes(factors: DataFrame, design: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The same for every pair of levels of each data set, under the name of the contrast of the pair."""
    rows = with_design(factors.where("factor > 0"), design, ["group"], by)
    key = [*by, "taxid"]
    means = rows.groupBy(*key, "group").agg(F.avg(F.log2("factor")).alias("m"), F.min("method").alias("method"))
    # One row per organism and level, so the pairs of an organism are few.
    late = means.select(*key, F.col("group").alias("_late"), F.col("m").alias("_m"))
    pairs = means.join(late, key).where("_late > `group`")
    return pairs.select(
        *key, F.concat_ws("_vs_", "_late", "group").alias("contrast"), (F.col("_m") - F.col("m")).alias("factor_log2fc"), "method"
    )


# ---------------------------------------------------------------- enrichment
def kegg_enrichment(
    results: DataFrame,
    pathways: DataFrame,
    by: Sequence[str] = (),
    alpha: float = 0.05,
) -> DataFrame:
    """Over-representation of pathways among significant proteins, with q values per contrast.

    The background is the tested proteins that have a pathway. `pathways` has
    one row per (protein_id, pathway). The q values are over the pathways of a contrast.
    """
    keys = [*by, "contrast"]
    annotated = pathways.select(*by, "protein_id").distinct()
    tested = lookup_join(results, annotated, [*by, "protein_id"], "left_semi").select(
        *keys, "protein_id", (F.col("q_value") < alpha).alias("_sig")
    )
    totals = tested.groupBy(*keys).agg(F.count("*").alias("n_background"), F.count_if("_sig").alias("n_significant"))
    # One count per (contrast, protein, pathway): pathways are the smaller list per protein.
    hits = tested.join(pathways.select(*by, "protein_id", "pathway").distinct(), [*by, "protein_id"])
    counts = hits.groupBy(*keys, "pathway").agg(
        F.count("*").alias("n_in_pathway"), F.count_if("_sig").alias("n_overlap")
    )
    rows = lookup_join(counts, totals, keys)
    tail = hypergeometric_tail(F.col("n_overlap"), F.col("n_significant"), F.col("n_in_pathway"), F.col("n_background"))
    return bh_adjust(cut_lineage(rows.withColumn("p_value", tail), "pathways"), keys)
