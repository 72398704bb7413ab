"""Lineages, the peptide consensus, and the comparison of two taxon estimates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from umbra.errors import InputError, OptionError
from umbra.plans.joins import lookup_join
from umbra.plans.lineage import cut_lineage
from umbra.sources.taxonomy import RANKS

SOURCES = ("eggnog", "unipept", "concordant")
VERDICTS = (
    "identical", "concordant", "concordant_above_genus", "conflict", "eggnog_missing",
    "unipept_missing", "eggnog_unresolved", "no_common_rank", "differ_no_lineage",
)


# ---------------------------------------------------------------- the tree
def lineages(nodes: DataFrame, ranks: Sequence[str] = RANKS, max_depth: int = 128) -> DataFrame:
    """taxid -> one taxid column per rank, for every node, by doubling the path.

    After round k a row knows the ranks of its 2^k nearest ancestors, so a tree
    of depth 40 needs six joins. The nearest node of a rank wins.
    """
    state = nodes.select(
        "taxid",
        F.when(F.col("parent") != F.col("taxid"), F.col("parent")).alias("_up"),
        *[F.when(F.col("rank") == r, F.col("taxid")).alias(r) for r in ranks],
    )
    reached = 1
    while True:
        above = state.select(
            F.col("taxid").alias("_up"),
            F.col("_up").alias("_next"),
            *[F.col(r).alias(f"_{r}") for r in ranks],
        )
        state = lookup_join(state, above, ["_up"]).select(
            "taxid", F.col("_next").alias("_up"), *[F.coalesce(r, f"_{r}").alias(r) for r in ranks]
        )
        state = cut_lineage(state, "lineage")
        reached *= 2
        if not state.where("_up IS NOT NULL").limit(1).count():
            return state.drop("_up")
        if reached >= max_depth:
            raise InputError(f"the taxonomy tree is deeper than {max_depth} or has a cycle")


def current_taxids(
    taxids: DataFrame, nodes: DataFrame, merged: DataFrame, deleted: DataFrame | None = None
) -> DataFrame:
    """(taxid, current): merged ids followed to their node; an unresolved id has no current.

    Merges of merges are followed by doubling as well. After as many rounds as the number of
    merges has binary digits every chain is at its end, so what still moves is a cycle.
    """
    hops = merged.select("taxid", "successor")
    rounds = merged.count().bit_length() + 1
    while True:
        onward = hops.select(F.col("taxid").alias("successor"), F.col("successor").alias("_next"))
        step = lookup_join(hops, onward, ["successor"]).withColumn("_moved", F.col("_next").isNotNull())
        step = cut_lineage(step, "merged")
        hops = step.select("taxid", F.coalesce("_next", "successor").alias("successor"))
        if not step.where("_moved").limit(1).count():
            break
        rounds -= 1
        if rounds < 0:
            raise InputError("the merged taxids have a cycle")
    known = nodes.select(F.col("taxid").alias("_target")).distinct()
    if deleted is not None:
        known = known.join(deleted.select(F.col("taxid").alias("_target")), "_target", "left_anti")
    out = lookup_join(taxids.select("taxid").distinct(), hops, ["taxid"]).select(
        "taxid", F.coalesce("successor", "taxid").alias("_target")
    )
    hit = lookup_join(out, known.withColumn("_ok", F.lit(True)), ["_target"])
    return hit.select("taxid", F.when(F.col("_ok"), F.col("_target")).alias("current"))


def lineage_of(taxids: DataFrame, dump: dict[str, DataFrame], ranks: Sequence[str] = RANKS) -> DataFrame:
    """taxid -> current id and rank columns, for the distinct taxids given."""
    now = current_taxids(taxids, dump["nodes"], dump["merged"], dump["deleted"])
    tree = lineages(dump["nodes"], ranks).withColumnRenamed("taxid", "current")
    return lookup_join(now, tree, ["current"])


def lineage_map(ranks: Sequence[str] = RANKS) -> Column:
    """Rank columns as a map without the missing ranks."""
    entries = F.array(*[F.struct(F.lit(r).alias("rank"), F.col(r).alias("taxid")) for r in ranks])
    return F.map_from_entries(F.filter(entries, lambda e: e["taxid"].isNotNull()))


def collapse_taxon_rank(
    taxa: DataFrame, rank: str, lineage: DataFrame | None, by: Sequence[str] = ()
) -> DataFrame:
    """Strain taxids to the taxid at `rank`; an empty rank leaves them as they are."""
    if not rank:
        return taxa
    if lineage is None:
        raise OptionError("taxon_rank needs a taxonomy dump")
    side = lineage.select("taxid", F.col(rank).alias("_at"))
    return lookup_join(taxa, side, ["taxid"]).withColumn("taxid", F.col("_at")).drop("_at")


# ---------------------------------------------------------------- consensus
def protein_peptide_lca(
    features: DataFrame, lca: DataFrame, by: Sequence[str] = ()
) -> DataFrame:
    """Peptides of a protein (its razor features) with their lineage."""
    from umbra.functions.text import peptide_normalise

    peptides = features.select(
        *by, F.col("razor").alias("protein_id"), peptide_normalise("peptide").alias("peptide")
    ).distinct()
    keys = [k for k in by if k in lca.columns]
    return lookup_join(peptides, lca, [*keys, "peptide"], "inner")


def peptides_without_lca(features: DataFrame, lca: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Raise with an explanation when no peptide is in the LCA table."""
    joined = protein_peptide_lca(features, lca, by)
    if not joined.limit(1).count():
        raise InputError(
            "no peptide of the quant table is in the LCA table; it must be keyed on the "
            "bare upper-case sequence"
        )
    return joined


def consensus_taxon(
    peptides: DataFrame,
    keys: Sequence[str] = ("protein_id",),
    min_fraction: float = 0.5,
    min_peptides: int = 2,
    ranks: Sequence[str] = RANKS,
    suffix: str = "_id",
) -> DataFrame:
    """Deepest rank with one majority taxid among the peptides resolved at that rank.

    The leader must reach `min_fraction` and be strictly ahead; a tie goes up
    one rank. Only aggregates: the smallest and the largest taxid of the top
    count are the same exactly when there is one leader. Votes are counted
    before the shuffle, the number of peptides as one of them; from then on all
    rows of a protein, one for each taxid, are together.
    """
    per_rank = F.array(
        F.struct(F.lit(-1).alias("depth"), F.lit("").alias("taxid")),
        *[F.struct(F.lit(i).alias("depth"), F.col(f"{r}{suffix}").alias("taxid")) for i, r in enumerate(ranks)],
    )
    has_lineage = F.coalesce(*[F.col(f"{r}{suffix}") for r in ranks]).isNotNull()
    votes = (
        peptides.where(has_lineage)
        .select(*keys, F.explode(per_rank).alias("_r"))
        .select(*keys, "_r.depth", "_r.taxid")
        .where("taxid IS NOT NULL")
        .groupBy(*keys, "depth", "taxid")
        .agg(F.count("*").alias("_n"))
    )
    ranked = votes.repartition(*keys).groupBy(*keys, "depth").agg(
        F.sum("_n").alias("_total"),
        F.min(F.struct((-F.col("_n")).alias("n"), F.col("taxid").alias("t"))).alias("_low"),
        F.max(F.struct(F.col("_n").alias("n"), F.col("taxid").alias("t"))).alias("_high"),
    )
    fraction = F.col("_high.n") / F.col("_total")
    good = (F.col("depth") >= 0) & (F.col("_low.t") == F.col("_high.t")) & (fraction >= min_fraction)
    best = ranked.groupBy(*keys).agg(
        F.max(F.when(F.col("depth") < 0, F.col("_total"))).alias("n_peptides"),
        F.max(F.when(good, F.struct("depth", F.col("_high.t").alias("taxid"), fraction.alias("fraction")))).alias("_b"),
    )
    enough = F.col("n_peptides") >= min_peptides
    rank = F.get(F.array(*[F.lit(r) for r in ranks]), F.col("_b.depth"))
    return best.select(
        *keys,
        F.when(enough, F.col("_b.taxid")).alias("consensus_taxid"),
        F.when(enough, rank).alias("consensus_rank"),
        F.when(enough, F.col("_b.fraction")).alias("fraction"),
        "n_peptides",
    )


# ---------------------------------------------------------------- two estimates
def taxonomy_verdict(
    a: Column, b: Column, a_lineage: dict[str, Column] | None, b_lineage: dict[str, Column] | None
) -> Column:
    """Verdict on an eggNOG taxid (a) and a peptide consensus taxid (b)."""
    out = (
        F.when(a.isNull(), "eggnog_missing")
        .when(b.isNull(), "unipept_missing")
        .when(a == b, "identical")
    )
    if a_lineage is None or b_lineage is None:
        return out.otherwise("differ_no_lineage")
    known = F.coalesce(*a_lineage.values()).isNotNull()
    out = out.when(~known, "eggnog_unresolved")
    genus_agrees = a_lineage["genus"] == b_lineage["genus"]
    deepest = None
    for rank in reversed(list(a_lineage)):
        x, y = a_lineage[rank], b_lineage[rank]
        same = "concordant" if rank in ("genus", "species") else "concordant_above_genus"
        verdict = F.when(x == y, same)
        if rank == "species":
            verdict = verdict.when(genus_agrees, "concordant")
        verdict = verdict.otherwise("conflict")
        common = F.when(x.isNotNull() & y.isNotNull(), verdict)
        deepest = common if deepest is None else F.coalesce(deepest, common)
    return out.otherwise(F.coalesce(deepest, F.lit("no_common_rank")))


def compare_taxonomy(
    consensus: DataFrame,
    eggnog: DataFrame,
    lineage: DataFrame | None,
    by: Sequence[str] = (),
    ranks: Sequence[str] = RANKS,
) -> DataFrame:
    """One row per protein with a peptide consensus row: both taxids and the verdict."""
    keys = [*by, "protein_id"]
    both = lookup_join(consensus, eggnog.select(*keys, "eggnog_taxid"), keys)
    both = both.withColumnRenamed("consensus_taxid", "unipept_taxid")
    a = b = None
    if lineage is not None:
        # A taxid that was merged is compared as its current node.
        for side in ("eggnog", "unipept"):
            renamed = lineage.select(
                F.col("taxid").alias(f"{side}_taxid"),
                F.col("current").alias(f"_{side}_now"),
                *[F.col(r).alias(f"_{side}_{r}") for r in ranks],
            )
            both = lookup_join(both, renamed, [f"{side}_taxid"])
        a = {r: F.col(f"_eggnog_{r}") for r in ranks}
        b = {r: F.col(f"_unipept_{r}") for r in ranks}
        left = F.coalesce("_eggnog_now", "eggnog_taxid")
        right = F.coalesce("_unipept_now", "unipept_taxid")
    else:
        left, right = F.col("eggnog_taxid"), F.col("unipept_taxid")
    out = both.withColumn("verdict", taxonomy_verdict(left, right, a, b))
    return out.select(*[c for c in both.columns if not c.startswith("_")], "verdict")


def effective_taxid(
    proteins: DataFrame, comparison: DataFrame | None, source: str = "eggnog", by: Sequence[str] = ()
) -> DataFrame:
    """The taxid the roll-up and the organism reference use, with its source.

    `concordant` keeps identical and concordant rows only; a protein without a
    comparison row is blanked too.
    """
    if source not in SOURCES:
        raise OptionError(f"taxonomy_source must be one of {SOURCES}, not {source!r}")
    if source == "eggnog":
        out = proteins.withColumn("effective_taxid", F.col("eggnog_taxid"))
    else:
        if comparison is None:
            raise InputError(f"taxonomy_source={source} needs the taxonomy comparison")
        keys = [*by, "protein_id"]
        out = lookup_join(proteins, comparison.select(*keys, "unipept_taxid", "verdict"), keys)
        agreed = F.col("verdict").isin("identical", "concordant")
        chosen = F.col("unipept_taxid") if source == "unipept" else F.when(agreed, F.col("eggnog_taxid"))
        out = out.withColumn("effective_taxid", chosen).drop("unipept_taxid", "verdict")
    return out.withColumn("taxonomy_source", F.lit(source))


def verdict_counts(comparison: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return comparison.groupBy(*by, "verdict").agg(F.count("*").alias("n"))


def excluded_by_concordance(effective: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Proteins the taxon-based steps leave out."""
    return effective.groupBy(*by).agg(
        F.count("*").alias("n_proteins"),
        F.count("effective_taxid").alias("n_with_taxon"),
        F.count_if(F.col("effective_taxid").isNull()).alias("n_excluded"),
    )
