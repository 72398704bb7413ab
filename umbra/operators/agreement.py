"""Agreement of two annotation sources that share a namespace."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from umbra.functions import text as T


class Comparison(NamedTuple):
    name: str
    needs: tuple[str, ...]
    a: Column
    b: Column


def normalised(c: Column | str) -> Column:
    """Accessions without version and `ko:` prefix, as a sorted set."""
    plain = F.transform(T.col(c), lambda x: T.strip_ko_prefix(T.strip_version(x)))
    return F.array_sort(F.array_distinct(F.coalesce(plain, F.array().cast("array<string>"))))


def default_comparisons() -> list[Comparison]:
    """The four source pairs of the annotation table."""
    sigs = "interpro_sigs"
    return [
        Comparison("pfam: hmmsearch vs interproscan", ("pfam_accs", sigs),
                   F.col("pfam_accs"), T.member_accessions(sigs, "Pfam")),
        Comparison("ncbifam: hmmsearch vs interproscan", ("ncbifam_accs", sigs),
                   F.col("ncbifam_accs"), T.member_accessions(sigs, "NCBIfam")),
        Comparison("ko: eggnog vs kofamscan", ("ko", "kofam_ko"), F.col("ko"), F.col("kofam_ko")),
        Comparison("pfam names: hmmsearch vs eggnog", ("pfam_hits", "pfams_emapper"),
                   F.col("pfam_hits"), F.col("pfams_emapper")),
    ]


def source_agreement(
    annotation: DataFrame,
    comparisons: Sequence[Comparison] | None = None,
    by: Sequence[str] = (),
    namespace_floor: int = 50,
) -> DataFrame:
    """Counts per source pair in one aggregation; a pair with a missing column is skipped.

    Only proteins called by both sources are compared. `namespace_warning` marks
    a pair that is almost wholly disjoint, which names against accessions give.
    """
    pairs = [c for c in (comparisons or default_comparisons())
             if all(n in annotation.columns for n in c.needs)]
    sides = F.array(
        *[
            F.struct(F.lit(c.name).alias("comparison"), normalised(c.a).alias("a"), normalised(c.b).alias("b"))
            for c in pairs
        ]
    )
    rows = annotation.select(*by, F.explode(sides).alias("_p")).select(*by, "_p.*")
    na, nb = F.size("a"), F.size("b")
    shared = F.size(F.array_intersect("a", "b"))
    both = (na > 0) & (nb > 0)
    identical = both & (shared == na) & (shared == nb)
    overlap = both & (shared > 0) & ~identical
    out = rows.groupBy(*by, "comparison").agg(
        F.count_if((na > 0) & (nb == 0)).alias("a_only"),
        F.count_if((na == 0) & (nb > 0)).alias("b_only"),
        F.count_if(both).alias("both"),
        F.count_if(identical).alias("identical"),
        F.count_if(overlap).alias("overlapping"),
        F.count_if(both & (shared == 0)).alias("disjoint"),
        F.count_if(overlap & (shared == nb)).alias("a_superset"),
        F.count_if(overlap & (shared == na)).alias("b_superset"),
        F.count_if(overlap & (shared < na) & (shared < nb)).alias("mutually_exclusive"),
    )
    agree = 100.0 * (F.col("identical") + F.col("overlapping")) / F.nullif(F.col("both"), F.lit(0))
    apart = 100.0 * F.col("disjoint") / F.nullif(F.col("both"), F.lit(0))
    return (
        out.where("a_only + b_only + both > 0")
        .withColumn("pct_agree", F.round(agree, 1))
        .withColumn("pct_disjoint", F.round(apart, 1))
        .withColumn("namespace_warning", (F.col("both") >= namespace_floor) & (apart >= 95.0))
    )
