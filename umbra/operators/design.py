"""The sample design: conditions from names, and guards before a model is fitted."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from umbra.errors import DesignError, OptionError
from umbra.functions import text as T
from umbra.plans.joins import lookup_join

SEPARATORS = ("_", "-", ".")


def condition_from_name(design: DataFrame, rule: str = "auto", by: Sequence[str] = ()) -> DataFrame:
    """The design with a `group` column, NULL where the names carry no condition.

    auto takes the part before a separator only when every name of the data set
    has it, every level has at least two samples, and no other such separator
    groups the samples differently. Anything else is a regex with one group.
    """
    if rule == "":
        return design.withColumn("group", F.lit(None).cast("string"))
    if rule != "auto":
        if re.compile(rule).groups != 1:
            raise OptionError("condition_from_name needs exactly one capture group")
        found = F.regexp_extract("sample", rule, 1)
        return design.withColumn("group", F.when(found != "", found))
    n = len(SEPARATORS)
    parts = [
        F.when(F.instr("sample", s) > 1, F.substring_index("sample", s, 1)).alias(f"_g{i}")
        for i, s in enumerate(SEPARATORS)
    ]
    rows = design.select(*design.columns, *parts)
    for i in range(n):
        # A design holds the samples of one experiment, so this window is small.
        w = Window.partitionBy(*by, f"_g{i}")
        rows = rows.withColumn(f"_n{i}", F.count("*").over(w))
    checks = []
    for i in range(n):
        ok = (
            (F.count(f"_g{i}") == F.count("*"))
            & (F.min(f"_n{i}") >= 2)
            & (F.count_distinct(f"_g{i}") >= 2)
        )
        checks.append(ok.alias(f"_ok{i}"))
        checks.append(F.count_distinct(f"_g{i}").alias(f"_d{i}"))
    for i in range(n):
        for j in range(i + 1, n):
            checks.append(
                F.count_distinct(F.coalesce(f"_g{i}", F.lit("")), F.coalesce(f"_g{j}", F.lit(""))).alias(f"_d{i}{j}")
            )
    verdict = rows.groupBy(*by).agg(*checks)
    differ = F.lit(False)
    for i in range(n):
        for j in range(i + 1, n):
            same = (F.col(f"_d{i}") == F.col(f"_d{j}")) & (F.col(f"_d{i}") == F.col(f"_d{i}{j}"))
            differ = differ | (F.col(f"_ok{i}") & F.col(f"_ok{j}") & ~same)
    pick = F.coalesce(*[F.when(F.col(f"_ok{i}"), F.lit(i)) for i in range(n)])
    verdict = verdict.select(*by, F.when(~differ, pick).alias("_pick"))
    if by:
        rows = rows.join(verdict, list(by))
    else:
        chosen = verdict.first()["_pick"]
        rows = rows.withColumn("_pick", F.lit(chosen).cast("int"))
    group = F.coalesce(*[F.when(F.col("_pick") == i, F.col(f"_g{i}")) for i in range(n)])
    return rows.select(*[c for c in design.columns if c != "group"], group.alias("group"))


def design_from_manifest(manifest: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """sample, group (the experiment; NULL where the manifest leaves it blank) and bioreplicate, one row per sample."""
    blank = lambda c: F.nullif(F.trim(c), F.lit("")).alias(c if c != "experiment" else "group")
    return manifest.select(*by, "sample", blank("experiment"), blank("bioreplicate")).distinct()


def design_from_plexes(channels: DataFrame, rule: str = "auto", by: Sequence[str] = ()) -> DataFrame:
    """sample, plex, plex_order and group of the channels that are samples.

    References (`is_reference`) leave the design. The group is never the plex: it comes from
    the sample names by `rule`, or is NULL, and the metadata then has to give it.
    """
    rows = channels.where(~F.coalesce(F.col("is_reference"), F.lit(False))) if "is_reference" in channels.columns else channels
    kept = [c for c in (*by, "sample", "plex", "plex_order") if c in rows.columns]
    return condition_from_name(rows.select(*kept), rule, by)


def default_terms(design: DataFrame) -> tuple[str, ...]:
    """`~ 0 + group`, with the plex as a batch term from two plexes on."""
    if "plex" in design.columns and design.select("plex").distinct().limit(2).count() > 1:
        return ("group", "plex")
    return ("group",)


def stable_sample_order(design: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Samples in plex order (`TMT10` after `TMT9`) with their position."""
    order = [*T.natural_key("plex"), *T.natural_key("sample")] if "plex" in design.columns else T.natural_key("sample")
    w = Window.partitionBy(*by).orderBy(*order) if by else Window.partitionBy(F.lit(1)).orderBy(*order)
    return design.withColumn("sample_order", F.row_number().over(w))


def guard_levels(design: DataFrame, terms: Sequence[str]) -> DataFrame:
    """Fail on a factor with one level, a missing level or no replication."""
    row = design.agg(
        F.count("*").alias("n"),
        *[F.count_distinct(t).alias(t) for t in terms],
        *[F.count_if(F.col(t).isNull()).alias(f"null_{t}") for t in terms],
    ).first()
    for t in terms:
        if row[f"null_{t}"]:
            raise DesignError(f"{row[f'null_{t}']} sample(s) have no {t}")
        if row[t] < 2:
            raise DesignError(f"factor with only one level: {t}")
    columns = row[terms[0]] + sum(row[t] - 1 for t in terms[1:])
    if row["n"] - columns < 1:
        raise DesignError(
            f"0 residual degrees of freedom: {row['n']} samples for {columns} coefficients"
        )
    return design


def level_names(design: DataFrame) -> DataFrame:
    """Level names made safe for contrasts; two levels must not collapse into one."""
    named = design.withColumn("group_name", T.name_normalise("group"))
    clash = named.groupBy("group_name").agg(F.count_distinct("group").alias("n")).where("n > 1").limit(1).collect()
    if clash:
        raise DesignError(f"several levels become {clash[0]['group_name']!r}")
    return named


def with_design(values: DataFrame, design: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """`values` with columns of their sample. The samples are sent to all tasks: dealt by sample, all values would meet in as many tasks as there are samples."""
    return lookup_join(values, F.broadcast(design.select(*by, "sample", *columns)), [*by, "sample"], "inner")
