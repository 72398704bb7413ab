"""Evidence per protein: one pass over the long hits table, then bins and scores."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from umbra.functions import text as T
from umbra.operators.bins import assign_bin
from umbra.plans.joins import assert_unique, lookup_join
from umbra.plans.lineage import cut_lineage


@dataclass(frozen=True)
class ScoreOptions:
    """Weights of the export score. Totals are a choice; the rules are not."""

    diamond: Mapping[str, int] = field(
        default_factory=lambda: {"vfdb": 4, "bagel": 3, "tadb": 3, "card": 2, "merops": 1}
    )
    vfdb_category: Mapping[str, int] = field(
        default_factory=lambda: {"VFC0086": 4, "VFC0235": 4, "VFC0258": 1, "VFC0272": 1}
    )
    strong_ident: float = 50.0
    signal_peptide: int = 2
    barrel: int = 2
    anchor: int = 2
    cazy: int = 1
    small: int = 1
    small_length: int = 150
    toxin_fold: int = 3
    neighbourhood: int = 2
    no_ko: int = 1


@dataclass(frozen=True)
class EvidenceOptions:
    ncbifam_uninformative_test: bool = True
    foldseek_priority: Sequence[str] = ("pdb", "swissprot", "afdb50")
    toxin_patterns: Sequence[str] = T.TOXIN_FOLD_PATTERNS
    anchor_pfams: Sequence[str] = T.ANCHOR_PFAMS
    score: ScoreOptions = field(default_factory=ScoreOptions)


def union_evidence(frames: Sequence[DataFrame]) -> DataFrame:
    """All hit tables as one long table; the tables may differ in optional columns."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


# ---------------------------------------------------------------- orthology
def ko_pathway_pairs(eggnog: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Distinct (ko, pathway) pairs this run's own annotation table contains."""
    return (
        eggnog.select(*by, F.explode("ko").alias("ko"), "pathway")
        .select(*by, "ko", F.explode("pathway").alias("pathway"))
        .distinct()
    )


def ko_with_specific_map(eggnog: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(ko, ko_specific): whether a KO has any map that is not a global one."""
    pairs = ko_pathway_pairs(eggnog, by)
    return pairs.groupBy(*by, "ko").agg(
        F.bool_or(~T.is_global_pathway("pathway")).alias("ko_specific")
    )


def ko_source(eggnog_ko: Column | str, kofam_ko: Column | str) -> Column:
    e, k = F.size(T.col(eggnog_ko)) > 0, F.size(T.col(kofam_ko)) > 0
    return F.when(e & k, "both").when(e, "eggnog").when(k, "kofam")


def ko_conflict(eggnog_ko: Column | str, kofam_ko: Column | str) -> Column:
    """Both sources called something and the calls share nothing."""
    e, k = T.col(eggnog_ko), T.col(kofam_ko)
    return (F.size(e) > 0) & (F.size(k) > 0) & ~F.arrays_overlap(e, k)


def ko_rescue_summary(annotation: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Proteins only KOfam gives a KO, and proteins the two sources disagree on."""
    return annotation.groupBy(*by).agg(
        F.count("*").alias("n_proteins"),
        F.count_if(F.size("kofam_ko") > 0).alias("n_kofam"),
        F.count_if(F.col("ko_source") == "kofam").alias("n_rescued"),
        F.count_if(F.col("ko_source") == "both").alias("n_both"),
        F.count_if("ko_conflict").alias("n_conflict"),
    )


# ---------------------------------------------------------------- scores
def diamond_points(options: ScoreOptions, db: Column, ident: Column, title: Column) -> Column:
    """Points of the best hit against one database.

    A weight of zero, or none, silences the database and its category map. A
    weak hit gets half the weight, rounded down.
    """
    weights = {k: int(v) for k, v in options.diamond.items()}
    weight = F.lit(0)
    if weights:
        table = F.create_map(*[F.lit(x) for kv in weights.items() for x in kv])
        weight = F.coalesce(F.element_at(table, db), F.lit(0))
    if options.vfdb_category and weights.get("vfdb", 0):
        cats = F.create_map(*[F.lit(x) for kv in options.vfdb_category.items() for x in kv])
        by_category = F.coalesce(F.element_at(cats, T.vfdb_category(title)), weight)
        weight = F.when(db == "vfdb", by_category).otherwise(weight)
    half = F.floor(weight / 2).cast("int")
    return F.when(ident < options.strong_ident, half).otherwise(weight)


def unweighted_databases(hits: DataFrame, options: ScoreOptions) -> DataFrame:
    """Database tags that count as annotation but score nothing, with their hit counts."""
    known = [k for k, v in options.diamond.items() if v]
    return hits.where((F.col("source") == "diamond") & ~F.col("db").isin(known)).groupBy("db").count()


def vfdb_category_rate(hits: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Hits whose title carries a category code, of all hits of that database."""
    rows = hits.where(F.col("db") == "vfdb")
    return rows.groupBy(*by).agg(
        F.count("*").alias("n_hits"),
        F.count_if(T.vfdb_category("description").isNotNull()).alias("n_with_category"),
    )


# ---------------------------------------------------------------- reduction
def reduce_hits(
    hits: DataFrame,
    library: DataFrame | None = None,
    ko_maps: DataFrame | None = None,
    options: EvidenceOptions = EvidenceOptions(),
    by: Sequence[str] = (),
) -> DataFrame:
    """One row per protein from every source, in two aggregations and no wide join.

    Set columns hold distinct family names, so their size is bounded by the
    profile libraries and not by the number of hits. The maps of the KOs are written
    first: their size is known then, and the hits are not shuffled to meet them. A source's
    hits are reduced to what is read of it: names, accessions or the best hit.
    """
    keys = [*by, "protein_id"]
    if library is not None:
        described = (
            library.select(
                F.lit("ncbifam").alias("source"),
                F.explode(F.array_distinct(F.array("name", F.coalesce("accession", "name")))).alias("name"),
                F.coalesce("description", F.lit("")).alias("lib_desc"),
            ).groupBy("source", "name").agg(F.min("lib_desc").alias("lib_desc"))
        )
    # The profile library is shared; the maps of a KO are those of its own data set.
    if library is not None:
        hits = lookup_join(hits, described, ["source", "name"])
    else:
        hits = hits.withColumn("lib_desc", F.lit(None).cast("string"))
    if ko_maps is not None:
        maps = ko_maps.groupBy(*by, "ko").agg(F.bool_or("ko_specific").alias("ko_specific")).select(
            *by, F.lit("kofam").alias("source"), F.col("ko").alias("name"), "ko_specific"
        )
        hits = lookup_join(hits, cut_lineage(maps, "ko_maps"), [*by, "source", "name"])
    else:
        hits = hits.withColumn("ko_specific", F.lit(None).cast("boolean"))
    src = F.col("source")
    any_says = (
        F.when(src == "pfam", T.is_informative("name", empty=True))
        .when(src == "ncbifam",
              T.is_informative("lib_desc", empty=True) if options.ncbifam_uninformative_test else F.lit(True))
        .when(src == "interpro", T.interpro_informative("db", "description"))
    )
    says = F.when(src.isin("foldseek", "hhblits"), T.is_informative("description", empty=True))
    rank = F.lit(0)
    if options.foldseek_priority:
        pos = F.array_position(F.array(*[F.lit(p) for p in options.foldseek_priority]), F.col("db"))
        rank = F.when(src == "foldseek", F.when(pos > 0, pos).otherwise(99)).otherwise(0)
    # InterProScan and Foldseek compare across their member databases.
    group = F.when(src.isin("interpro", "foldseek"), F.lit("")).otherwise(F.col("db"))
    best = F.struct(
        rank.cast("int").alias("p"),
        (-F.coalesce("score", F.lit(float("-inf")))).alias("s"),
        F.coalesce("evalue", F.lit(float("inf"))).alias("e"),
        F.col("name").alias("name"),
        F.col("description").alias("description"),
        F.col("ident").alias("ident"),
        says.alias("says"),
    )
    label = F.when(src == "interpro", F.concat_ws(":", "db", "name")).otherwise(F.col("name"))
    per_db = hits.groupBy(*keys, "source", group.alias("db")).agg(
        F.min(F.when(src.isin("diamond", "foldseek", "hhblits", "jackhmmer"), best)).alias("best"),
        F.collect_set(F.when(src.isin("pfam", "ncbifam", "interpro", "dbcan", "kofam"), label)).alias("names"),
        F.collect_set(F.when(src.isin("pfam", "ncbifam"), T.strip_version("accession"))).alias("accs"),
        F.bool_or(any_says).alias("any_says"),
        F.bool_or("ko_specific").alias("ko_specific"),
    )

    def of(source: str, c: str) -> Column:
        return F.max(F.when(src == source, F.col(c)))

    def names(source: str, c: str = "names") -> Column:
        return F.array_sort(F.coalesce(of(source, c), F.array().cast("array<string>")))

    def flag(source: str, c: str) -> Column:
        return F.coalesce(F.bool_or(F.when(src == source, F.col(c))), F.lit(False))

    points = diamond_points(options.score, F.col("db"), F.col("best.ident"), F.col("best.description"))
    anchors = F.array(*[F.lit(a) for a in options.anchor_pfams]).cast("array<string>")
    return per_db.groupBy(*keys).agg(
        names("pfam").alias("pfam_hits"),
        names("pfam", "accs").alias("pfam_accs"),
        flag("pfam", "any_says").alias("pfam_informative"),
        names("ncbifam").alias("ncbifam_hits"),
        names("ncbifam", "accs").alias("ncbifam_accs"),
        flag("ncbifam", "any_says").alias("ncbifam_informative"),
        names("interpro").alias("interpro_sigs"),
        flag("interpro", "any_says").alias("interpro_informative"),
        names("dbcan").alias("dbcan_hits"),
        names("kofam").alias("kofam_ko"),
        flag("kofam", "ko_specific").alias("kofam_specific"),
        F.array_sort(F.collect_set(F.when(src == "diamond", F.col("db")))).alias("diamond_dbs"),
        F.coalesce(F.sum(F.when(src == "diamond", points)), F.lit(0)).cast("int").alias("diamond_points"),
        of("foldseek", "best.name").alias("foldseek_hit"),
        of("foldseek", "best.description").alias("foldseek_desc"),
        flag("foldseek", "best.says").alias("foldseek_informative"),
        of("hhblits", "best.name").alias("hh_hit"),
        of("hhblits", "best.description").alias("hh_desc"),
        flag("hhblits", "best.says").alias("hh_informative"),
        of("jackhmmer", "best.name").alias("jackhmmer_hit"),
    ).withColumn("has_anchor", F.arrays_overlap("pfam_accs", anchors))


def join_evidence(
    proteins: DataFrame, sides: Sequence[DataFrame], by: Sequence[str] = ()
) -> DataFrame:
    """Protein rows with every side table; a side must be unique per protein."""
    keys = [*by, "protein_id"]
    out = proteins
    for side in sides:
        out = out.join(side, keys, "left")
    return out


def _empty_array() -> Column:
    return F.array().cast("array<string>")


def build_annotation(
    proteins: DataFrame,
    eggnog: DataFrame,
    hits: DataFrame,
    library: DataFrame | None = None,
    signalp: DataFrame | None = None,
    tmbed: DataFrame | None = None,
    context: DataFrame | None = None,
    clusters: DataFrame | None = None,
    options: EvidenceOptions = EvidenceOptions(),
    by: Sequence[str] = (),
    check_keys: bool = True,
) -> DataFrame:
    """The annotation table: one row per protein with its evidence, bin and export score.

    `eggnog` is the output of `typed_eggnog`. A source that did not run is None.
    """
    keys = [*by, "protein_id"]
    sides = {
        "eggnog": eggnog,
        "signalp": signalp,
        "tmbed": tmbed,
        "context": context.select(*keys, "context_flags") if context is not None else None,
        "clusters": clusters,
    }
    given = {k: v for k, v in sides.items() if v is not None}
    if check_keys:
        for name, side in given.items():
            assert_unique(side, keys, name)
    reduced = reduce_hits(hits, library, ko_with_specific_map(eggnog, by), options, by)
    df = join_evidence(proteins, [reduced, *given.values()], by)
    sets = ("pfam_hits", "pfam_accs", "ncbifam_hits", "ncbifam_accs", "interpro_sigs", "dbcan_hits",
            "kofam_ko", "diamond_dbs", "ko", "pathway", "cazy", "pfams_emapper")
    flags = ("pfam_informative", "ncbifam_informative", "interpro_informative", "kofam_specific",
             "foldseek_informative", "hh_informative", "has_anchor")
    filled = {c: F.coalesce(c, _empty_array()) for c in sets}
    filled.update({c: F.coalesce(c, F.lit(False)) for c in flags})
    # A source that did not run leaves its columns missing, not false.
    if signalp is None:
        filled["sp_class"] = F.lit(None).cast("string")
    if tmbed is None:
        filled["n_tmh"] = filled["n_tmb"] = F.lit(None).cast("int")
    filled["context_flags"] = _empty_array() if context is None else F.coalesce("context_flags", _empty_array())
    if clusters is None:
        filled["family_id"] = F.lit(None).cast("string")
    return annotate_columns(df.withColumns(filled), options)


def annotate_columns(df: DataFrame, options: EvidenceOptions = EvidenceOptions()) -> DataFrame:
    """Derived columns of the annotation table, all row-wise, in three layers."""
    emapper_named = F.size("pfams_emapper") > 0
    emapper_vague = F.exists("pfams_emapper", lambda p: ~T.is_informative(p, empty=True))
    ncbifam_vague = (F.size("ncbifam_hits") > 0) & ~F.col("ncbifam_informative")
    pfam_vague = (F.size("pfam_hits") > 0) & ~F.col("pfam_informative")
    specific = F.size(T.specific_pathways("pathway")) > 0
    has_fold, has_hh = F.col("foldseek_hit").isNotNull(), F.col("hh_hit").isNotNull()
    vague_rescue = (has_fold & ~F.col("foldseek_informative")) | (has_hh & ~F.col("hh_informative"))
    df = df.withColumns(
        {
            "has_ko": (F.size("ko") > 0) | (F.size("kofam_ko") > 0),
            "has_pathway": ((F.size("ko") > 0) & specific) | ((F.size("kofam_ko") > 0) & F.col("kofam_specific")),
            "ko_source": ko_source("ko", "kofam_ko"),
            "ko_conflict": ko_conflict("ko", "kofam_ko"),
            "ncbifam_uninformative": ncbifam_vague,
            "has_seq_annotation": F.col("pfam_informative")
            | F.col("ncbifam_informative")
            | F.col("interpro_informative")
            | (emapper_named & ~emapper_vague)
            | (F.size("cazy") > 0)
            | (F.size("dbcan_hits") > 0)
            | (F.size("diamond_dbs") > 0),
            "duf_only": pfam_vague | (emapper_named & emapper_vague) | ncbifam_vague,
            "has_structure": has_fold & F.col("foldseek_informative"),
            "has_profile": F.col("jackhmmer_hit").isNotNull() | (has_hh & F.col("hh_informative")),
            "rescue_demoted": vague_rescue,
            "lpxtg": T.sortase_motif("seq"),
            "toxin_fold": T.toxin_fold("foldseek_desc", options.toxin_patterns)
            | T.toxin_fold("hh_desc", options.toxin_patterns),
        }
    )
    rescued = F.concat_ws(
        ";",
        F.when(F.col("has_structure"), F.lit("structure")),
        F.when(F.col("has_profile"), F.lit("profile")),
    )
    df = df.withColumns(
        {
            "rescued_by": F.when(rescued != "", rescued),
            "bin": assign_bin(
                "has_ko", "has_pathway", "has_seq_annotation", "duf_only", "has_structure", "has_profile"
            ),
            "surface_or_secreted": surface_or_secreted(),
            "export_score": export_score(options.score),
        }
    )
    return df.withColumn("kegg_enrichment_visible", F.col("bin") == "1_ko_pathway")


def surface_or_secreted() -> Column:
    """Signal peptide, beta barrel, sortase motif or anchor domain; a missing source is no."""
    signal = F.coalesce(F.col("sp_class").isin("SP", "LIPO", "TAT", "TATLIPO", "PILIN"), F.lit(False))
    barrel = F.coalesce(F.col("n_tmb") > 0, F.lit(False))
    return (
        signal
        | barrel
        | F.coalesce(F.col("lpxtg"), F.lit(False))
        | F.coalesce(F.col("has_anchor"), F.lit(False))
    )


def export_score(o: ScoreOptions) -> Column:
    """Weighted sum of flags plus the points of the database hits."""

    def points(flag: Column, w: int) -> Column:
        return F.when(flag, F.lit(w)).otherwise(F.lit(0))

    signal = F.col("sp_class").isin("SP", "LIPO", "TAT", "TATLIPO", "PILIN")
    near = F.arrays_overlap("context_flags", F.array(F.lit("prophage"), F.lit("immunity")))
    return (
        points(signal, o.signal_peptide)
        + points(F.col("n_tmb") > 0, o.barrel)
        + points(F.col("lpxtg") | F.col("has_anchor"), o.anchor)
        + points((F.size("cazy") > 0) | (F.size("dbcan_hits") > 0), o.cazy)
        + points(F.col("length") <= o.small_length, o.small)
        + points(F.col("toxin_fold"), o.toxin_fold)
        + points(near, o.neighbourhood)
        + points(~F.col("has_ko"), o.no_ko)
        + F.coalesce(F.col("diamond_points"), F.lit(0))
    ).cast("int")


# ---------------------------------------------------------------- work-lists
def dark_set(
    annotation: DataFrame, control_prefixes: Sequence[str] = T.CONTROL_PREFIXES
) -> DataFrame:
    """Proteins without evidence, without control sequences: the profile query set."""
    return annotation.where((F.col("bin") == "4_dark") & ~T.starts_with_any("protein_id", control_prefixes))


def dark_worklist(
    annotation: DataFrame,
    top_k: int,
    max_length: int,
    control_prefixes: Sequence[str] = T.CONTROL_PREFIXES,
) -> DataFrame:
    """The best-scored dark proteins a structure search is asked for."""
    ranked = dark_set(annotation, control_prefixes).where(F.col("length") <= max_length)
    return ranked.orderBy(F.col("export_score").desc(), "protein_id").limit(top_k)


def excluded_by_prefix(
    proteins: DataFrame, prefixes: Sequence[str] = T.CONTROL_PREFIXES, by: Sequence[str] = ()
) -> DataFrame:
    """How many proteins each excluded namespace holds."""
    tag = F.coalesce(
        *[F.when(F.startswith("protein_id", F.lit(p)), F.lit(p)) for p in prefixes]
    )
    return proteins.withColumn("prefix", tag).where("prefix IS NOT NULL").groupBy(*by, "prefix").count()


def plddt_gate(structures: DataFrame, scores: DataFrame | None, minimum: float = 70.0) -> DataFrame:
    """Structures confident enough to search; without scores every structure passes."""
    if scores is None:
        return structures.withColumn("gated", F.lit(False))
    return lookup_join(structures, scores.select("protein_id", "plddt"), ["protein_id"]).where(
        F.coalesce("plddt", F.lit(minimum)) >= minimum
    ).withColumn("gated", F.lit(True))


def structure_shortfall(
    requested: DataFrame,
    present: DataFrame,
    failures: DataFrame | None,
    max_length: int,
    finished: bool,
    by: Sequence[str] = (),
) -> DataFrame:
    """Cause per requested structure: present, over_cap, pending, failed, never_attempted or lost.

    Without a failure record a missing model of a finished run is `lost`: the
    two causes cannot be told apart.
    """
    keys = [*by, "protein_id"]
    out = lookup_join(requested, present.select(*keys).distinct().withColumn("_p", F.lit(True)), keys)
    if failures is not None:
        marked = failures.select(*keys).distinct().withColumn("_f", F.lit(True))
        out = lookup_join(out, marked, keys)
        missing = F.when(F.col("_f"), "failed").otherwise("never_attempted")
    else:
        missing = F.lit("lost")
    cause = (
        F.when(F.col("_p"), "present")
        .when(F.col("length") > max_length, "over_cap")
        .when(F.lit(not finished), "pending")
        .otherwise(missing)
    )
    return out.withColumn("cause", cause).drop("_p", "_f")


def missing_partners(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct keys of `left` with no row in `right`."""
    return left.select(*keys).distinct().join(right.select(*keys).distinct(), list(keys), "left_anti")


def fold_group_sizes(pairs: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Members per group of structures clustered against each other, largest first."""
    return pairs.groupBy(*by, "family_id").agg(F.count("*").alias("n_members")).orderBy(
        *by, F.col("n_members").desc(), "family_id"
    )
