"""End-to-end jobs: evidence to bins, peptides to annotated quant, quant to statistics."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from umbra.operators import bins, coding, evidence, features, filters, isobaric, models, organisms, tables
from umbra.operators.design import default_terms, with_design
from umbra.operators.taxonomy import effective_taxid
from umbra.plans.joins import lookup_join
from umbra.plans.lineage import cut_lineage


class Annotated(NamedTuple):
    annotation: DataFrame
    summary: DataFrame
    worklist: DataFrame
    profile_queries: DataFrame


def annotate(
    proteins: DataFrame,
    eggnog: DataFrame,
    hits: DataFrame,
    max_structures: int = 2000,
    max_length: int = 1000,
    by: Sequence[str] = (),
    **sources,
) -> Annotated:
    """Evidence to bins. The annotation is written once; its summaries read it."""
    table = cut_lineage(
        evidence.build_annotation(proteins, eggnog, hits, by=by, **sources), "annotation"
    )
    return Annotated(
        table,
        bins.bin_summary(table, by),
        evidence.dark_worklist(table, max_structures, max_length),
        evidence.dark_set(table),
    )


class Quantified(NamedTuple):
    quant: DataFrame
    evidence: DataFrame
    assigned: DataFrame
    taxon_intensity: DataFrame
    funnel: DataFrame


def quantify(
    feature_table: DataFrame,
    values: DataFrame,
    annotation: DataFrame,
    mode: str = "taxon_unique",
    method: str = "sum",
    min_features: int = 1,
    taxonomy_source: str = "eggnog",
    comparison: DataFrame | None = None,
    families: DataFrame | None = None,
    candidates: DataFrame | None = None,
    by: Sequence[str] = (),
) -> Quantified:
    """Peptides to annotated protein quant, its evidence, organism sums and the funnel."""
    keys = [*by, "protein_id"]
    taxa = effective_taxid(annotation, comparison, taxonomy_source, by)
    owned = taxa.select(*keys, F.col("effective_taxid").alias("taxid"))
    assigned = cut_lineage(
        features.assign_features(feature_table, owned, mode, families, candidates, by), "assigned"
    )
    counts = features.peptide_evidence(assigned, mode, method, by)
    rolled = features.rollup(features.assigned_values(values, assigned, by), method, by)
    kept = features.min_features_per_protein(rolled, counts, min_features, by) if min_features > 1 else rolled
    quant = cut_lineage(
        tables.annotate_quant(
            kept,
            [taxa.select(*keys, "bin", "export_score", "has_ko", "surface_or_secreted",
                         "effective_taxid", "taxonomy_source"),
             counts.drop("rollup_method", "peptide_assignment")],
            by,
            check_keys=False,
        ),
        "quant",
    )
    carrying, enough = F.col("n_features_used") > 0, F.col("n_features_used") >= max(min_features, 1)
    steps = [
        tables.Step("proteins in the annotation table", "protein", "", annotation),
        tables.Step("proteins named by a quantified feature", "protein", "no feature names the rest", counts),
        tables.Step("features read from the quant table", "feature", "", counts,
                    F.sum(F.col("n_features_used") + F.col("n_features_dropped"))),
        tables.Step(f"peptide_assignment={mode}", "feature", "class not kept by the mode", counts, F.sum("n_features_used")),
        tables.Step("proteins carrying an assigned feature", "protein", "every feature was dropped", counts, F.count_if(carrying)),
        tables.Step(f"min_features_per_protein={min_features}", "protein",
                    "removes nothing" if min_features <= 1 else "too few assigned features", counts, F.count_if(enough)),
        tables.Step("proteins written to the annotated quant table", "protein", "", quant.select(*keys).distinct()),
    ]
    return Quantified(
        quant,
        counts,
        assigned,
        organisms.taxon_intensity(quant.withColumn("taxid", F.col("effective_taxid")), by),
        tables.quant_funnel(steps, by),
    )


def size_factors(
    quant: DataFrame, samples: DataFrame, min_proteins: int = 4, by: Sequence[str] = ()
) -> DataFrame:
    """Organism size factors of annotated protein quant, written once."""
    owned = quant.withColumn("taxid", F.col("effective_taxid"))
    return cut_lineage(organisms.taxon_size_factors(owned, samples, min_proteins, by), "factors")


class Tested(NamedTuple):
    filters: DataFrame
    abundance: DataFrame
    ratio: DataFrame
    shortlist: DataFrame
    retention: DataFrame
    coverage: DataFrame
    population: DataFrame
    risk: DataFrame
    exposure: DataFrame | None
    warnings: DataFrame


def analyse(
    quant: DataFrame,
    annotation: DataFrame,
    design: DataFrame,
    factors: DataFrame,
    terms: coding.Model | str | Sequence[str] | None = None,
    min_valid: int = 2,
    min_plexes: int = 1,
    normalise: bool = True,
    by: Sequence[str] = (),
    alpha: float = 0.05,
    min_lfc: float = 0.585,
) -> Tested:
    """Protein quant to moderated statistics, with and without the organism reference.

    Without `terms` the model is `~ 0 + group`, with the plex as a further term where there are
    plexes; a model that is given is left as it is. A design whose statistics cannot be
    honest stops the job before anything is fitted.

    `warnings` gathers what a reader has to be told: bins that reach no model, a model
    that hardly reaches proteins without a KO, an empty shortlist, organisms whose factor may
    have absorbed a shift (a protein deviates when its adjusted change is significant and
    at least `min_lfc`), and organisms whose factor rests on single plexes.
    """
    keys = [*by, "protein_id"]
    model = coding.model_of(default_terms(design) if terms is None else terms)
    coding.guard_design(design, model, by, () if terms is not None else ("plex",))
    if "plex" in design.columns:
        isobaric.require_unconfounded(design, by)
    linear = quant.select(*keys, "sample", "value")
    flags = cut_lineage(filters.protein_filters(linear, design, min_valid, min_plexes, by), "flags")
    kept = flags.where("keep_valid AND keep_plex").select(*keys)
    logged = linear.join(kept, keys, "left_semi").where("value > 0").withColumn("value", F.log2("value"))
    if normalise:  # several passes find the medians
        logged = cut_lineage(logged, "logged")
    centred = cut_lineage(filters.sample_median_shift(logged, by, normalise), "log2")
    fits = cut_lineage(models.fit_proteins(centred, design, model, by), "fits")
    abundance = cut_lineage(models.adjusted_contrasts(fits, by=by), "abundance")
    taxa = quant.where("effective_taxid IS NOT NULL").select(
        *keys, F.col("effective_taxid").alias("taxid")
    ).distinct()
    ratio = models.ratio_model(centred, taxa, factors, design, model, by, fits)
    ratio = cut_lineage(ratio, "ratio")
    results = tables.annotate_quant(
        abundance, [annotation.select(*keys, "bin", "has_ko", "surface_or_secreted", "export_score")], by,
        check_keys=False,
    )
    reached = abundance.where("p_value IS NOT NULL").select(*keys).distinct().withColumn("_tested", F.lit(True))
    quantified = lookup_join(lookup_join(flags, annotation.select(*keys, "bin"), keys), reached, keys).select(
        *by, "bin", (F.col("keep_valid") & F.col("keep_plex")).alias("kept"), F.coalesce("_tested", F.lit(False)).alias("tested")
    )
    quantified = cut_lineage(quantified, "quantified")
    retention, coverage = bins.retention_by_bin(quantified, by), bins.ko_less_coverage(quantified, by)
    population = tables.shortlist_population(results.where("contrast IS NOT NULL"), [*by, "contrast"], alpha)
    changes = models.factor_changes(factors, design, by)
    deviates = (F.col("q_adj") < alpha) & (F.abs("lfc_adj") >= min_lfc)
    moved = lookup_join(ratio, changes, [*by, "taxid", "contrast"], "inner").select(
        *by, "taxid", "factor_log2fc", "method", F.col("lfc_adj").alias("lfc"), F.coalesce(deviates, F.lit(False)).alias("deviates")
    )
    risk = organisms.normalisation_risk(moved, by, min_lfc)
    exposure = None
    if "plex" in design.columns:
        members = with_design(quant.withColumn("taxid", F.col("effective_taxid")).drop("plex"), design, ["plex"], by)
        exposure = isobaric.plex_exposure(members, by=by)
    said = [
        retention.where("verdict <> 'ok'").select(*by, F.lit("retention").alias("what"), F.col("bin").alias("subject"), "verdict"),
        coverage.where("gate").select(*by, F.lit("ko_less_coverage"), F.lit(""), F.lit("GATE")),
        population.where("n_listed = 0").select(*by, F.lit("shortlist"), "contrast", F.lit("EMPTY")),
        risk.where("assumption <> 'ok'").select(*by, F.lit("normalisation"), F.col("taxid").cast("string"), "assumption"),
    ]
    if exposure is not None:
        said.append(exposure.where("n_exposed > 0").select(
            *by, F.lit("plex_exposure"), F.lit(""), F.concat_ws(" of ", F.col("n_exposed").cast("string"), F.col("n_taxa").cast("string"))))
    warnings = said[0]
    for rows in said[1:]:
        warnings = warnings.union(rows)
    return Tested(
        flags, abundance, ratio, tables.candidate_shortlist(results, by, alpha), retention, coverage, population, risk, exposure, warnings
    )
