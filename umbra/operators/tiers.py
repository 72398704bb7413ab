"""Coverage of a merged database by identifier tier, and reuse of annotation by id."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from umbra.errors import InputError
from umbra.functions import text as T
from umbra.functions.numbers import percent
from umbra.plans.joins import assert_unique, lookup_join

# More prefixes than this name genomes, not sources.
MAX_TIERS = 12


def tier_counts(proteins: DataFrame, by: Sequence[str] = (), delimiters: str = "_|:.") -> DataFrame:
    """Proteins per tier; ids without a delimiter have no tier."""
    return (
        proteins.select(*by, T.id_tier("protein_id", delimiters).alias("tier"))
        .where("tier IS NOT NULL")
        .groupBy(*by, "tier")
        .agg(F.count("*").alias("n"))
    )


def tiered_sets(counts: DataFrame, by: Sequence[str], max_tiers: int = MAX_TIERS) -> DataFrame:
    """Tiers of the data sets that are split by a source prefix: 2 to `max_tiers` tiers."""
    sizes = counts.groupBy(*by).agg(F.count("*").alias("_tiers"))
    good = sizes.where(F.col("_tiers").between(2, max_tiers)).drop("_tiers")
    if by:
        return lookup_join(counts, good, by, "left_semi")
    # Reads no further than one tier too many.
    n = counts.limit(max_tiers + 1).count()
    return counts if 2 <= n <= max_tiers else counts.where(F.lit(False))


def tier_coverage(
    annotation: DataFrame,
    evidence: Mapping[str, Column],
    by: Sequence[str] = (),
    control_prefixes: Sequence[str] = T.CONTROL_PREFIXES,
    delimiters: str = "_|:.",
    max_tiers: int = MAX_TIERS,
    digits: int = 1,
) -> DataFrame:
    """Per tier: size, share, percent per evidence, percent dark, median score and key shape.

    `evidence` maps a column suffix to a flag; a source that did not run is not
    listed, so it gets no column. Empty when the ids are not tiered.
    """
    rows = annotation.where(~T.starts_with_any("protein_id", control_prefixes)).select(
        *by,
        T.id_tier("protein_id", delimiters).alias("tier"),
        T.id_key_shape("protein_id", delimiters).alias("shape"),
        F.col("bin"),
        F.col("export_score"),
        *[flag.alias(f"_e_{name}") for name, flag in evidence.items()],
    )
    tiers = tiered_sets(tier_counts(annotation.where(~T.starts_with_any("protein_id", control_prefixes)),
                                    by, delimiters), by, max_tiers)
    rows = lookup_join(rows, tiers.select(*by, "tier"), [*by, "tier"], "left_semi")
    # Counts per (tier, shape, score) move; the rest is sums over them.
    cells = rows.groupBy(*by, "tier", "shape", "export_score").agg(
        F.count("*").alias("_n"),
        F.count_if(F.col("bin") == "4_dark").alias("_dark"),
        *[F.count_if(f"_e_{name}").alias(f"_e_{name}") for name in evidence],
    )
    shapes = cells.groupBy(*by, "tier", "shape").agg(
        F.sum("_n").alias("_n"),
    ).groupBy(*by, "tier").agg(
        F.min(F.struct((-F.col("_n")).alias("m"), F.col("shape").alias("shape"))).alias("_s")
    )
    stats = cells.groupBy(*by, "tier").agg(
        F.sum("_n").alias("n"),
        F.sum("_dark").alias("_dark"),
        F.expr("percentile(export_score, 0.5, _n)").alias("median_export_score"),
        *[F.sum(f"_e_{name}").alias(f"_e_{name}") for name in evidence],
    )
    total = F.sum("n").over(Window.partitionBy(*by) if by else Window.partitionBy(F.lit(1)))
    return (
        stats.join(shapes, [*by, "tier"])
        .withColumn("_total", total)
        .select(
            *by,
            "tier",
            "n",
            percent("n", "_total", digits).alias("pct_of_proteome"),
            *[percent(f"_e_{name}", "n", digits).alias(f"pct_{name}") for name in evidence],
            percent("_dark", "n", digits).alias("pct_dark"),
            "median_export_score",
            F.col("_s.shape").alias("key_shape"),
            percent(-F.col("_s.m"), "n", digits).alias("key_shape_pct"),
        )
        .orderBy(*by, F.col("n").desc(), "tier")
    )


def shared_keys(coverage: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Key shapes that more than one tier carries: one namespace under several labels."""
    out = coverage.groupBy(*by, "key_shape").agg(
        F.array_sort(F.collect_list("tier")).alias("tiers")
    )
    return out.where(F.size("tiers") > 1)


# ---------------------------------------------------------------- reuse by id
def candidate_keys(pid: Column, strip_prefixes: Sequence[str]) -> Column:
    """The id itself, then the id without each listed prefix it carries."""
    options = [pid] + [
        F.when(F.startswith(pid, F.lit(p)), F.expr(f"substring(protein_id, {len(p) + 1})"))
        for p in strip_prefixes
    ]
    return F.filter(F.array(*options), lambda x: x.isNotNull())


def reuse_annotation(
    proteins: DataFrame,
    table: DataFrame,
    strip_prefixes: Sequence[str] = (),
    by: Sequence[str] = (),
) -> DataFrame:
    """Annotation rows keyed by the proteins' own ids.

    One row of `table` serves every protein it matches. `matched_by` is exact,
    prefix or missing. A repeated key in `table` is refused: it would be a row at random.
    """
    keys = [*by, "protein_id"]
    assert_unique(table, keys, "annotation table")
    tried = proteins.select(
        *keys, F.posexplode(candidate_keys(F.col("protein_id"), strip_prefixes)).alias("_rank", "_key")
    )
    payload = [c for c in table.columns if c not in keys]
    right = table.select(
        *by, F.col("protein_id").alias("_key"), F.struct(*payload).alias("_row")
    )
    found = (
        lookup_join(tried, right, [*by, "_key"], "inner")
        .groupBy(*keys)
        .agg(F.min("_rank").alias("_rank"), F.min_by("_row", "_rank").alias("_row"))
    )
    out = proteins.join(found, keys, "left")
    how = F.when(F.col("_rank") == 0, "exact").when(F.col("_rank") > 0, "prefix")
    return out.select(
        *proteins.columns,
        *[F.col(f"_row.{c}").alias(c) for c in payload if c not in proteins.columns],
        how.alias("matched_by"),
    )


def prefix_usage(proteins: DataFrame, strip_prefixes: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """How many ids each listed prefix was stripped from; zero is reported."""
    return proteins.groupBy(*by).agg(
        *[F.count_if(F.startswith("protein_id", F.lit(p))).alias(p) for p in strip_prefixes]
    )


def id_transforms(pid: Column) -> dict[str, Column]:
    """Id changes that commonly separate a sequence database from an annotation table."""
    return {
        "strip_tier": F.regexp_replace(pid, r"^[^_|:.]*[_|:.]", ""),
        "middle_of_pipes": F.regexp_extract(pid, r"^[^|]*\|([^|]+)\|", 1),
        "strip_version": T.strip_version(pid),
        "before_pipe": F.substring_index(pid, "|", 1),
    }


def id_mismatch_diagnosis(
    unmatched: DataFrame, table: DataFrame, by: Sequence[str] = ()
) -> DataFrame:
    """Transforms and prefixes that would have matched, with how many ids each brings."""
    pid = F.col("protein_id")
    tries = F.array(
        *[
            F.struct(
                F.lit(name).alias("transform"),
                (T.id_tier(pid) if name == "strip_tier" else F.lit(None).cast("string")).alias("prefix"),
                key.alias("_key"),
            )
            for name, key in id_transforms(pid).items()
        ]
    )
    rows = unmatched.select(*by, "protein_id", F.explode(tries).alias("_t")).select(
        *by, "protein_id", "_t.*"
    ).where((F.col("_key") != "") & (F.col("_key") != F.col("protein_id")))
    ids = table.select(*by, F.col("protein_id").alias("_key")).distinct()
    hit = lookup_join(rows, ids, [*by, "_key"], "left_semi")
    return hit.groupBy(*by, "transform", "prefix").agg(F.count("*").alias("n_matched"))


def coverage(reused: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return reused.groupBy(*by).agg(
        F.count("*").alias("n_proteins"),
        F.count("matched_by").alias("n_annotated"),
        F.count_if(F.col("matched_by") == "prefix").alias("n_bridged_by_prefix"),
        (F.count("matched_by") / F.nullif(F.count("*"), F.lit(0))).alias("coverage"),
    )


def coverage_gate(
    reused: DataFrame, minimum: float = 0.5, warn: float = 0.9, by: Sequence[str] = ()
) -> DataFrame:
    """Coverage with a level; raises before anything is written when it is too low."""
    level = F.when(F.col("coverage") < minimum, "fail").when(F.col("coverage") < warn, "warn").otherwise("ok")
    out = coverage(reused, by).withColumn("level", level)
    low = out.where("level = 'fail'").limit(5).collect()
    if low:
        raise InputError(
            f"annotation covers {low[0]['coverage']:.1%} of the proteins, below the minimum "
            f"{minimum:.0%}; fix the id mismatch rather than lowering the minimum"
        )
    return out


def annotation_coverage_by_tier(
    reused: DataFrame,
    strip_prefixes: Sequence[str] = (),
    by: Sequence[str] = (),
    delimiters: str = "_|:.",
    max_tiers: int = MAX_TIERS,
) -> DataFrame:
    """Per tier the annotated count; names a tier at zero and an unlisted tier that
    shares its key shape with a listed one."""
    tiers = tiered_sets(tier_counts(reused, by, delimiters), by, max_tiers)
    rows = reused.select(
        *by,
        T.id_tier("protein_id", delimiters).alias("tier"),
        T.id_key_shape("protein_id", delimiters).alias("shape"),
        F.col("matched_by").isNotNull().alias("_a"),
    )
    rows = lookup_join(rows, tiers.select(*by, "tier"), [*by, "tier"], "left_semi")
    cells = rows.groupBy(*by, "tier", "shape").agg(
        F.count("*").alias("_n"), F.count_if("_a").alias("_a")
    )
    out = cells.groupBy(*by, "tier").agg(
        F.sum("_n").alias("n_proteins"),
        F.sum("_a").alias("n_annotated"),
        F.min(F.struct((-F.col("_n")).alias("m"), F.col("shape").alias("s"))).getField("s").alias("key_shape"),
    )
    listed = F.col("tier").isin(*strip_prefixes) if strip_prefixes else F.lit(False)
    same_shape = Window.partitionBy(*by, "key_shape")
    return out.withColumn("matched_none", F.col("n_annotated") == 0).withColumn(
        "unlisted_twin", ~listed & F.max(listed.cast("int")).over(same_shape).cast("boolean")
    )
