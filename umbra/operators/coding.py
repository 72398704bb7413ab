"""Model terms and their coding: columns of the design matrix, built once per data set.

A model is a list of terms, each a product of design columns, with or without an
intercept. Text columns are factors and numeric ones covariates. A factor is coded by one
column for each level, or, where the model holds the rest of its term already, by one for
each level but the first; so `~ 0 + group + plex` has a mean per group and differences
between plexes, and `group:plex` alone has a mean per cell. Levels are those of the data
set's design, never those a single protein happens to be observed in.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from itertools import combinations
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as Ty

from umbra.errors import DesignError, OptionError

INTERCEPT = "(Intercept)"


class Model(NamedTuple):
    terms: tuple[tuple[str, ...], ...]
    intercept: bool = False

    @property
    def columns(self) -> list[str]:
        """The design columns it names, each once."""
        return list(dict.fromkeys(c for t in self.terms for c in t))


def model_of(spec: Model | str | Sequence[str]) -> Model:
    """A model from terms (`group`, `group:plex`), or from a formula such as `~ 0 + group * plex`.

    What was written is kept: no term is added. Terms of fewer columns come first, else in
    the order written; `a * b` is `a`, `b` and `a:b`.
    """
    if isinstance(spec, Model):
        return spec
    intercept = isinstance(spec, str)  # a formula has one unless it says 0; a list of terms has none unless it says 1
    parts = spec.replace("~", " ").split("+") if intercept else list(spec)
    terms: list[tuple[str, ...]] = []
    for part in (p.strip() for p in parts):
        if part in ("0", "1"):
            intercept = part == "1"
            continue
        factors = [tuple(dict.fromkeys(x.strip() for x in p.split(":"))) for p in part.split("*")]
        for n in range(1, len(factors) + 1):
            terms += [tuple(dict.fromkeys(c for f in some for c in f)) for some in combinations(factors, n)]
    seen: dict[frozenset, tuple[str, ...]] = {}
    for t in terms:
        if not all(t):
            raise OptionError(f"an empty term in the model {spec!r}")
        seen.setdefault(frozenset(t), t)
    if not seen:
        raise OptionError("the model names no term")
    return Model(tuple(sorted(seen.values(), key=len)), intercept)


def codings(model: Model, numeric: Iterable[str]) -> list[list[tuple[str, bool]]]:
    """Of each term its columns, with True where a factor is coded by every level."""
    numeric, held = set(numeric), {frozenset()} if model.intercept else set()
    out = []
    for term in model.terms:
        coded = [(c, c not in numeric and frozenset(term) - {c} not in held) for c in term]
        out.append(coded)
        held.add(frozenset(term))
        if all(c not in numeric for c in term):
            held.add(frozenset())  # the columns of a factor's levels add up to an intercept
    return out


def _numeric(design: DataFrame, model: Model) -> list[str]:
    missing = [c for c in model.columns if c not in design.columns]
    if missing:
        raise OptionError(f"the model names {missing}; the design has {design.columns}")
    return [c for c in model.columns if isinstance(design.schema[c].dataType, Ty.NumericType)]


def coded_design(design: DataFrame, spec: Model | str | Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """by, sample, x (the sample's row of the design matrix), names (of its columns) and levels (of the first term's factor).

    A sample without a value of some column takes no part. The design of one data set is
    small, so its levels are collected beside each other.
    """
    model = model_of(spec)
    numeric = _numeric(design, model)
    factors = [c for c in model.columns if c not in numeric]
    rows = design
    for c in model.columns:
        rows = rows.where(F.col(f"`{c}`").isNotNull())
    rows = rows.select(*by, "sample", *[(F.col(f"`{c}`").cast("double" if c in numeric else "string")).alias(f"_v{i}") for i, c in enumerate(model.columns)])
    at = {c: i for i, c in enumerate(model.columns)}
    levels = rows.groupBy(*by).agg(F.lit(1).alias("_one"), *[F.array_sort(F.collect_set(f"_v{at[c]}")).alias(f"_l{at[c]}") for c in factors])
    rows = rows.join(F.broadcast(levels), list(by)) if by else rows.crossJoin(F.broadcast(levels))  # one row of levels for each data set

    def coded(c: str, full: bool) -> tuple[Column, Column]:
        """Values and names of the columns of one factor or covariate."""
        v = F.col(f"_v{at[c]}")
        if c in numeric:
            return F.array(v), F.array(F.lit(c))
        l = F.col(f"_l{at[c]}")
        l = l if full else F.slice(l, F.lit(2), F.greatest(F.size(l) - 1, F.lit(0)))
        return F.transform(l, lambda y: (y == v).cast("double")), F.transform(l, lambda y: F.concat(F.lit(c), y))

    def each(left: Column, right: Column, pair: Callable[[Column, Column], Column]) -> Column:
        return F.flatten(F.transform(left, lambda a: F.transform(right, lambda b: pair(a, b))))

    def product(term: list[tuple[str, bool]]) -> tuple[Column, Column]:
        x, names = coded(*term[0])
        for c, full in term[1:]:
            own, called = coded(c, full)
            x, names = each(x, own, lambda a, b: a * b), each(names, called, lambda a, b: F.concat_ws(":", a, b))
        return x, names

    parts = [product(t) for t in codings(model, numeric)]
    if model.intercept:
        parts.insert(0, (F.array(F.lit(1.0)), F.array(F.lit(INTERCEPT))))
    first = model.terms[0][0]
    none = F.array().cast("array<string>")
    return rows.select(
        *by, "sample", F.concat(*[x for x, _ in parts]).alias("x"), F.concat(*[n for _, n in parts]).alias("names"),
        (F.col(f"_l{at[first]}") if first in factors and len(model.terms[0]) == 1 else none).alias("levels"),
    )


def independent_columns(x: np.ndarray, tolerance: float = 1e-7) -> np.ndarray:
    """Which columns add to the space of those before them, by QR with the dependent ones moved back."""
    basis: list[np.ndarray] = []
    keep = np.zeros(x.shape[1], bool)
    for k in range(x.shape[1]):
        v = x[:, k].astype(float)
        size = np.linalg.norm(v)
        for _ in range(2):  # twice, so that rounding leaves nothing of the basis
            for q in basis:
                v = v - (q @ v) * q
        left = np.linalg.norm(v)
        if size > 0 and left > tolerance * size:
            keep[k] = True
            basis.append(v / left)
    return keep


def design_ranks(design: DataFrame, spec: Model | str | Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Per data set: samples, coefficients, rank, residual degrees of freedom, the aliased coefficients and factors of one level.

    Equal rows of the matrix are counted first: what is gathered for a data set are its
    different rows.
    """
    model = model_of(spec)
    numeric = _numeric(design, model)
    coded = coded_design(design, model, by)
    distinct = coded.groupBy(*by, "x", "names").agg(F.count("*").alias("n"))
    fields = [coded.schema[c] for c in by]
    schema = Ty.StructType([*fields, *[Ty.StructField(c, Ty.LongType()) for c in ("n_samples", "n_coefficients", "rank", "df_residual")], Ty.StructField("aliased", Ty.ArrayType(Ty.StringType()))])

    def ranks(group: pd.DataFrame) -> pd.DataFrame:
        x = np.stack([np.asarray(r, float) for r in group["x"]])
        names, n = list(group["names"].iloc[0]), int(group["n"].sum())
        keep = independent_columns(x * np.sqrt(group["n"].to_numpy(float))[:, None])
        row = {c: [group[c].iloc[0]] for c in by}
        return pd.DataFrame({**row, "n_samples": [n], "n_coefficients": [len(names)], "rank": [int(keep.sum())], "df_residual": [n - int(keep.sum())],
                             "aliased": [[m for m, k in zip(names, keep, strict=True) if not k]]})

    out = distinct.groupBy(*by).applyInPandas(ranks, schema)
    factors = [c for c in model.columns if c not in numeric]
    single = F.filter(F.array(*[F.when(F.col(f"_d{i}") < 2, F.lit(c)) for i, c in enumerate(factors)]), lambda c: c.isNotNull()) if factors else F.array().cast("array<string>")
    counted = design.groupBy(*by).agg(F.lit(1).alias("_one"), *[F.count_distinct(f"`{c}`").alias(f"_d{i}") for i, c in enumerate(factors)])
    counted = counted.select(*by, "_one", single.alias("one_level"))
    return (out.join(counted, list(by)) if by else out.crossJoin(counted)).drop("_one")  # one row for each data set


def guard_design(design: DataFrame, spec: Model | str | Sequence[str], by: Sequence[str] = (), optional: Sequence[str] = ()) -> DataFrame:
    """Stop, with names, at a factor of one level, aliased coefficients or no residual degree of freedom; return the ranks.

    A factor of `optional` may have one level: it then brings no coefficient.
    """
    checked = design_ranks(design, spec, by)
    if optional:
        checked = checked.withColumn("one_level", F.array_except("one_level", F.array(*[F.lit(c) for c in optional])))
    for r in checked.where("size(one_level) > 0 OR size(aliased) > 0 OR df_residual < 1").limit(5).collect():
        where = "".join(f"{c}={r[c]}: " for c in by)
        if r["one_level"]:
            raise DesignError(f"{where}factor with only one level: {', '.join(r['one_level'])}")
        if r["aliased"]:
            hint = "; a plex is a batch that a condition has to cross" if "plex" in model_of(spec).columns else ""
            raise DesignError(f"{where}rank deficient, not estimable: {', '.join(r['aliased'])}{hint}")
        raise DesignError(f"{where}{r['df_residual']} residual degrees of freedom: {r['n_samples']} samples for {r['n_coefficients']} coefficients")
    return checked
