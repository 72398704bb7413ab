"""Gene neighbourhoods on a contig, counted in genes or in base pairs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from umbra.plans.order import GROUP_LIMIT, by_size, row_numbers


def _blocks(position: Column, size: int, halo: int) -> Column:
    """The home block of a position and the neighbours it is within `halo` of."""
    home = F.floor(position / size)
    return F.array_distinct(
        F.array(home, F.floor((position - halo) / size), F.floor((position + halo) / size))
    )


def neighbours_by_gene(
    genes: DataFrame,
    window: int,
    aggregates: dict[str, Column],
    by: Sequence[str] = (),
    order: Sequence[str] = ("start", "protein_id"),
    limit: int = GROUP_LIMIT,
    block: int = 100_000,
) -> DataFrame:
    """Aggregates over the `window` genes on either side of each gene, itself included.

    A very long contig is cut into blocks of consecutive genes; each block also
    gets the `window` genes next to it, so its own rows see whole neighbourhoods.
    """
    keys = [*by, "contig"]
    frame = lambda w: w.rowsBetween(-window, window)

    def direct(rows):
        w = frame(Window.partitionBy(*keys).orderBy(*order))
        return rows.select(*rows.columns, *[a.over(w).alias(n) for n, a in aggregates.items()])

    def blocked(rows):
        numbered = row_numbers(rows, keys, order, "_rn", limit)
        pos = F.col("_rn") - 1
        spread = numbered.withColumn("_home", F.floor(pos / block)).withColumn(
            "_block", F.explode(_blocks(pos, block, window))
        )
        w = frame(Window.partitionBy(*keys, "_block").orderBy("_rn"))
        out = spread.select("*", *[a.over(w).alias(n) for n, a in aggregates.items()])
        return out.where("_block = _home").select(*rows.columns, *aggregates)

    return by_size(genes, keys, limit, direct, blocked)


def neighbours_by_distance(
    genes: DataFrame,
    gap: int,
    aggregates: dict[str, Column],
    by: Sequence[str] = (),
    limit: int = GROUP_LIMIT,
    block: int = 1_000_000,
) -> DataFrame:
    """Aggregates over genes that start within `gap` base pairs, itself included."""
    keys = [*by, "contig"]

    def direct(rows):
        w = Window.partitionBy(*keys).orderBy("start").rangeBetween(-gap, gap)
        return rows.select(*rows.columns, *[a.over(w).alias(n) for n, a in aggregates.items()])

    def blocked(rows):
        size = max(block, gap)
        spread = rows.withColumn("_home", F.floor(F.col("start") / size)).withColumn(
            "_block", F.explode(_blocks(F.col("start"), size, gap))
        )
        w = Window.partitionBy(*keys, "_block").orderBy("start").rangeBetween(-gap, gap)
        out = spread.select("*", *[a.over(w).alias(n) for n, a in aggregates.items()])
        return out.where("_block = _home").select(*rows.columns, *aggregates)

    return by_size(genes, keys, limit, direct, blocked)


def neighbour_flags(
    genes: DataFrame,
    window: int = 5,
    max_gap: int = 5000,
    min_cazymes: int = 2,
    min_importers: int = 1,
    by: Sequence[str] = (),
) -> DataFrame:
    """Prophage, polysaccharide locus, CAZyme count and immunity near each gene.

    `genes` has contig, start, protein_id and the flags is_prophage, is_cazyme,
    is_importer and is_immunity. A gene is no neighbour of itself for immunity.
    """
    near = neighbours_by_gene(
        genes,
        window,
        {
            "n_cazymes_in_window": F.count_if("is_cazyme"),
            "_importers": F.count_if("is_importer"),
            "prophage": F.bool_or("is_prophage"),
        },
        by,
    )
    near = neighbours_by_distance(near, max_gap, {"_immunity": F.count_if("is_immunity")}, by)
    own = F.col("is_immunity").cast("int")
    out = near.withColumn(
        "pul",
        (F.col("n_cazymes_in_window") >= min_cazymes) & (F.col("_importers") >= min_importers),
    ).withColumn("immunity", F.col("_immunity") - own > 0)
    flags = ["prophage", "pul", "immunity"]
    raised = F.filter(F.array(*[F.when(F.col(f), F.lit(f)) for f in flags]), lambda x: x.isNotNull())
    return out.select(
        *by, "protein_id", "n_cazymes_in_window", *flags, raised.alias("context_flags")
    )
