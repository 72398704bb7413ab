"""Quantification inputs as long tables: features, feature values and the sample design."""

from __future__ import annotations

import re
import warnings
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from umbra.errors import DesignError, InputError, OptionError
from umbra.functions import text as T
from umbra.functions.numbers import delog2, to_number, zero_as_missing
from umbra.sources.lines import read_delimited, read_lines, require

# Numeric-looking columns of protein tables that are not samples.
PROTEIN_METADATA = (
    "Protein", "Protein ID", "Entry Name", "Gene", "Protein Length", "Length", "Organism",
    "Description", "Protein Description", "Protein Existence", "Coverage",
    "Protein Probability", "Top Peptide Probability", "Protein Qvalue",
    "Combined Total Peptides", "Combined Spectral Count", "Combined Unique Spectral Count",
    "Combined Total Spectral Count", "Indistinguishable Proteins", "Is Decoy",
    "Is Contaminant", "Protein.Group", "Protein.Ids", "Protein.Names", "Genes",
    "First.Protein.Description", "N.Sequences", "N.Proteotypic.Sequences",
)
LABEL_FREE = ("diann", "fragpipe", "fragpipe_peptide", "fragpipe_ion", "msstats_csv",
              "msstats_feature", "msstats_protein")


class Quant(NamedTuple):
    """`features` is None for protein-level input; `design` may be None."""

    features: DataFrame | None
    values: DataFrame
    design: DataFrame | None


def guard_header(names: Sequence[str], fmt: str, path: str) -> None:
    """Refuse isobaric files that a label-free reader would read as something else."""
    if "ReferenceIntensity" in names:
        raise InputError(
            f"{path}: a tmt-report matrix (ReferenceIntensity); it is already log2 and rolled "
            "up. Read the per-plex tables with fragpipe_tmt instead"
        )
    channels = [n for n in names if re.match(r"Channel \S", n)]
    if channels:
        raise InputError(f"{path}: the isobaric flavour of msstats.csv ({channels[0]} ...)")
    reporters = [n for n in names if n.startswith("Intensity ") and not n.endswith(" Intensity")]
    if fmt in LABEL_FREE and reporters:
        raise InputError(
            f"{path}: isobaric (TMT/iTRAQ) output with reporter columns {reporters[:6]}; "
            f"{fmt} does not read reporter-ion columns, fragpipe_tmt does"
        )


def unpivot_samples(
    df: DataFrame, ids: Sequence[str], columns: dict[str, str], zero_missing: bool = True
) -> DataFrame:
    """Wide sample columns -> (ids, sample, value), missing cells left out."""
    # The tag keeps a sample name from meeting an id column. Cells become
    # numbers before the rows multiply.
    tag = "s:"
    wide = df.select(
        *ids,
        *[
            zero_as_missing(to_number(F.col(f"`{c}`")), zero_missing).alias(tag + name)
            for c, name in columns.items()
        ],
    )
    names = [F.col(f"`{tag}{name}`") for name in columns.values()]
    long = wide.unpivot(list(ids), names, "_i", "value").where("value IS NOT NULL")
    return long.select(*ids, F.substring("_i", F.lit(len(tag) + 1), F.char_length("_i")).alias("sample"), "value")


def zero_cells(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count and share of cells that are a literal zero."""
    n = sum((F.count_if(to_number(F.col(f"`{c}`")) == 0) for c in columns), F.lit(0))
    total = F.count("*") * len(columns)
    return df.agg(n.alias("n_zero"), total.alias("n_cells")).withColumn(
        "share", F.col("n_zero") / F.nullif(F.col("n_cells"), F.lit(0))
    )


# ---------------------------------------------------------------- sample columns
def numeric_columns(df: DataFrame, candidates: Sequence[str]) -> list[str]:
    """Columns whose every non-empty cell is a number and that have at least one."""
    if not candidates:
        return []
    tests = []
    for i, c in enumerate(candidates):
        cell = T.blank_to_null(F.col(f"`{c}`"), ("", "NA"))
        bad = F.count_if(cell.isNotNull() & cell.try_cast("double").isNull())
        tests.append(((bad == 0) & (F.count(cell) > 0)).alias(str(i)))
    row = df.agg(*tests).first()
    return [c for i, c in enumerate(candidates) if row[i]]


def protein_sample_columns(
    df: DataFrame, names: Sequence[str], columns: Sequence[str] = (), regex: str = ""
) -> list[str]:
    """An explicit list, else a regex, else every numeric column that is not metadata."""
    if columns:
        missing = [c for c in columns if c not in names]
        if missing:
            raise InputError(f"intensity columns {missing} are not in the table")
        return list(columns)
    if regex:
        found = [n for n in names if re.search(regex, n)]
        if not found:
            raise InputError(f"intensity regex {regex!r} matches no column")
        return found
    guess = numeric_columns(df, [n for n in names if n not in PROTEIN_METADATA])
    warnings.warn(f"sample columns were guessed: {guess}", stacklevel=2)
    return guess


# ---------------------------------------------------------------- manifest
def parse_manifest(lines: DataFrame) -> DataFrame:
    """One row per raw file; the separator is a tab, never one space."""
    c = F.split("value", "\t")
    exp, rep = F.trim(F.coalesce(F.get(c, 1), F.lit(""))), F.trim(F.coalesce(F.get(c, 2), F.lit("")))
    base = T.basename(F.get(c, 0))
    single = F.raise_error(F.concat(F.lit("manifest line has only one field: "), F.col("value")))
    sample = F.when(F.size(c) < 2, single.cast("string")).when(exp == "", base).when(
        rep == "", exp
    ).otherwise(F.concat_ws("_", exp, rep))
    keep = [k for k in lines.columns if k != "value"]
    return lines.where(F.trim("value") != "").select(
        *keep,
        F.get(c, 0).alias("file"),
        exp.alias("experiment"),
        rep.alias("bioreplicate"),
        base.alias("basename"),
        T.blank_to_null(F.get(c, 3)).alias("data_type"),
        sample.alias("sample"),
    )


def collapse_fractions(files: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One row per sample with its number of fraction files; they must agree on data_type."""
    types = F.min("data_type") != F.max("data_type")
    fail = F.raise_error(F.concat(F.lit("different data_type within sample "), F.col("sample")))
    return files.groupBy(*by, "sample").agg(
        F.min("experiment").alias("experiment"),
        F.min("bioreplicate").alias("bioreplicate"),
        F.min("basename").alias("basename"),
        F.min("file").alias("file"),
        F.count("*").alias("n_fractions"),
        F.min("data_type").alias("_dt"),
        F.coalesce(types, F.lit(False)).alias("_bad"),
    ).withColumn(
        "data_type", F.when(F.col("_bad"), fail.cast("string")).otherwise(F.col("_dt"))
    ).drop("_dt", "_bad")


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    return collapse_fractions(parse_manifest(read_lines(spark, path)))


def map_samples_to_columns(
    manifest: DataFrame, columns: DataFrame, by: Sequence[str] = ()
) -> DataFrame:
    """Match samples to the `column` names of a table by ordered fallback keys.

    experiment_replicate, experiment-replicate, experiment, file name, path. The
    result has one row per sample; two samples on one column, or no match at
    all, fail. Columns that no sample claims are left out.
    """
    both = (F.col("experiment") != "") & (F.col("bioreplicate") != "")
    keys = F.array(
        F.when(both, F.concat_ws("_", "experiment", "bioreplicate")),
        F.when(both, F.concat_ws("-", "experiment", "bioreplicate")),
        F.when(F.col("experiment") != "", F.col("experiment")),
        F.col("basename"),
        F.col("file"),
    )
    tried = manifest.select(*by, "sample", F.posexplode(keys).alias("priority", "column"))
    matched = (
        tried.join(columns, [*by, "column"])
        .groupBy(*by, "sample")
        .agg(F.min_by("column", "priority").alias("column"))
    )
    twice = matched.groupBy(*by, "column").count().where("count > 1").limit(1).collect()
    if twice:
        raise InputError(f"several samples map to the same quant column {twice[0]['column']!r}")
    if not matched.limit(1).count():
        present = [r["column"] for r in columns.limit(20).collect()]
        raise InputError(f"the samples match no column; columns present: {present}")
    return matched


# ---------------------------------------------------------------- feature tables
def razor_column(names: Sequence[str], path: str) -> str:
    """`Protein` is the sequence header; `Protein ID` carries a description."""
    for c in ("Protein", "Protein ID"):
        if c in names:
            return c
    raise InputError(f"{path}: neither 'Protein' nor 'Protein ID' is present")


def candidate_set(razor: Column, mapped: Column) -> Column:
    """Razor and mapped proteins as one set of first tokens."""
    parts = F.transform(F.split(F.coalesce(mapped, F.lit("")), r"[;,]"), T.first_token)
    return F.array_distinct(
        F.concat(F.array(razor), F.filter(parts, lambda p: p != ""))
    )


def feature_columns(
    df: DataFrame, key: Column, peptide: Column, razor: Column, mapped: Column
) -> DataFrame:
    """Rows with their feature id, razor and candidates, decoys handled.

    A decoy or contaminant razor drops the row; a decoy candidate is only
    removed, because it can carry no taxonomy and would veto the feature.
    """
    first = T.first_token(razor)
    out = df.select(
        key.alias("feature_id"),
        peptide.alias("peptide"),
        first.alias("razor"),
        candidate_set(first, mapped).alias("candidates"),
        *df.columns,
    )
    return prune_decoy_candidates(drop_decoys(out))


def drop_decoys(df: DataFrame, prefixes: Sequence[str] = T.DECOY_PREFIXES) -> DataFrame:
    return df.where(~T.starts_with_any("razor", prefixes))


def prune_decoy_candidates(df: DataFrame, prefixes: Sequence[str] = T.DECOY_PREFIXES) -> DataFrame:
    keep = F.filter("candidates", lambda c: ~T.starts_with_any(c, prefixes))
    return df.withColumn("candidates", keep)


def _feature_quant(df, ids, columns, zero_missing) -> Quant:
    features = df.select("feature_id", "peptide", "razor", "candidates")
    return Quant(features, unpivot_samples(df, ids, columns, zero_missing), None)


def read_fragpipe_features(
    spark: SparkSession,
    path: str,
    level: str = "peptide",
    suffix: str = " Intensity",
    zero_missing: bool = True,
) -> Quant:
    """combined_peptide.tsv or combined_ion.tsv."""
    if level not in ("peptide", "ion"):
        raise OptionError(f"level must be peptide or ion, not {level!r}")
    df, names = read_delimited(spark, path, "\t")
    guard_header(names, f"fragpipe_{level}", path)
    samples = {n: n[: -len(suffix)] for n in names
               if n.endswith(suffix) and not n.endswith("MaxLFQ" + suffix)}
    if not samples:
        raise InputError(f"{path}: no column ends in {suffix!r}; columns present: {names[:30]}")
    pep = "Peptide Sequence" if "Peptide Sequence" in names else "Peptide"
    require(names, [pep] + (["Modified Sequence", "Charge"] if level == "ion" else []), path)
    key = T.feature_key("Modified Sequence", "Charge") if level == "ion" else F.col(pep)
    mapped = F.col("Mapped Proteins") if "Mapped Proteins" in names else F.lit("")
    df = feature_columns(df, key, F.col(pep), F.col(f"`{razor_column(names, path)}`"), mapped)
    return _feature_quant(df, ["feature_id"], samples, zero_missing)


def read_peptides_only(spark: SparkSession, path: str) -> DataFrame:
    """Peptides and candidates when no intensity is needed."""
    df, names = read_delimited(spark, path, "\t")
    if "ReferenceIntensity" in names:
        guard_header(names, "peptides", path)
    pep = "Peptide Sequence" if "Peptide Sequence" in names else "Peptide"
    require(names, [pep], path)
    mapped = F.col("Mapped Proteins") if "Mapped Proteins" in names else F.lit("")
    out = feature_columns(
        df, F.col(f"`{pep}`"), F.col(f"`{pep}`"), F.col(f"`{razor_column(names, path)}`"), mapped
    )
    return out.select("feature_id", "peptide", "razor", "candidates")


def peptide_features(spark: SparkSession, path: str, mode: str = "auto", **options) -> DataFrame:
    """auto tries the full reader and falls back; always and never force one of them."""
    if mode not in ("auto", "always", "never"):
        raise OptionError(f"mode must be auto, always or never, not {mode!r}")
    if mode == "always":
        return read_peptides_only(spark, path)
    try:
        return read_fragpipe_features(spark, path, **options).features
    except InputError:
        if mode == "never":
            raise
        return read_peptides_only(spark, path)


# ---------------------------------------------------------------- protein tables
def read_protein_matrix(
    spark: SparkSession,
    path: str,
    fmt: str = "fragpipe",
    columns: Sequence[str] = (),
    regex: str = "",
    zero_missing: bool = True,
) -> Quant:
    """A wide protein table: report.pg_matrix.tsv (diann) or combined_protein.tsv (fragpipe)."""
    df, names = read_delimited(spark, path, "\t")
    guard_header(names, fmt, path)
    group = "Protein.Group" if fmt == "diann" else razor_column(names, path)
    require(names, [group], path)
    picked = protein_sample_columns(df, names, columns, regex)
    strip = lambda n: re.sub(r" Intensity$", "", n) if fmt == "fragpipe" else n
    gid = F.col(f"`{group}`") if fmt == "diann" else T.first_token(F.col(f"`{group}`"))
    out = df.withColumn("group_id", gid)
    return Quant(
        None,
        unpivot_samples(out, ["group_id"], {c: strip(c) for c in picked}, zero_missing),
        None,
    )


# ---------------------------------------------------------------- long tables
def long_features(
    df: DataFrame,
    protein: Column,
    peptide: Column,
    key: Column,
    sample: Column,
    value: Column,
    group: Column,
    replicate: Column,
) -> Quant:
    """A long feature table; only the razor protein is known, so there is no sharing rule."""
    rows = df.select(
        key.alias("feature_id"),
        peptide.alias("peptide"),
        T.first_token(protein).alias("razor"),
        sample.alias("sample"),
        value.alias("value"),
        group.alias("group"),
        replicate.alias("bioreplicate"),
    )
    rows = drop_decoys(rows)
    features = rows.groupBy("feature_id").agg(
        F.min("peptide").alias("peptide"), F.min("razor").alias("razor")
    ).withColumn("candidates", F.array("razor"))
    values = rows.where("value IS NOT NULL").groupBy("feature_id", "sample").agg(
        F.sum("value").alias("value")
    )
    design = rows.groupBy("sample").agg(
        F.min("group").alias("group"), F.min("bioreplicate").alias("bioreplicate")
    )
    return Quant(features, values, design)


def na(c: str) -> Column:
    return T.blank_to_null(F.col(f"`{c}`"), ("", "NA"))


def read_msstats_csv(spark: SparkSession, path: str, zero_missing: bool = True) -> Quant:
    df, names = read_delimited(spark, path, ",")
    guard_header(names, "msstats_csv", path)
    require(names, ["ProteinName", "PeptideSequence", "Run", "Intensity"], path)
    slots = [c for c in ("PeptideSequence", "PrecursorCharge", "FragmentIon", "ProductCharge")
             if c in names]
    return long_features(
        df, na("ProteinName"), na("PeptideSequence"), T.feature_key(*[na(c) for c in slots]),
        na("Run"), zero_as_missing(to_number("Intensity"), zero_missing),
        na("Condition") if "Condition" in names else F.lit(None).cast("string"),
        na("BioReplicate") if "BioReplicate" in names else F.lit(None).cast("string"),
    )


def read_msstats_feature(spark: SparkSession, path: str) -> Quant:
    """`INTENSITY` is linear; only without it is log2 `ABUNDANCE` turned back."""
    df, names = read_delimited(spark, path, "\t")
    guard_header(names, "msstats_feature", path)
    require(names, ["PROTEIN", "PEPTIDE", "FEATURE", "RUN"], path)
    if "INTENSITY" in names:
        value = zero_as_missing(to_number("INTENSITY"))
    else:
        require(names, ["ABUNDANCE"], path)
        warnings.warn(f"{path}: no INTENSITY column, ABUNDANCE is turned back from log2")
        value = delog2(to_number("ABUNDANCE"))
    return long_features(
        df, na("PROTEIN"), na("PEPTIDE"), na("FEATURE"), na("RUN"), value,
        na("GROUP_ORIGINAL"), na("SUBJECT_ORIGINAL"),
    )


def read_msstats_protein(spark: SparkSession, path: str) -> Quant:
    df, names = read_delimited(spark, path, "\t")
    guard_header(names, "msstats_protein", path)
    logged = "LogIntensities" if "LogIntensities" in names else "ABUNDANCE"
    require(names, ["Protein", logged], path)
    run = "originalRUN" if "originalRUN" in names else "RUN"
    rows = df.select(
        T.first_token("Protein").alias("group_id"),
        na(run).alias("sample"),
        delog2(to_number(logged)).alias("value"),
        na("GROUP_ORIGINAL").alias("group"),
        na("SUBJECT_ORIGINAL").alias("bioreplicate"),
    )
    design = rows.groupBy("sample").agg(
        F.min("group").alias("group"), F.min("bioreplicate").alias("bioreplicate")
    )
    return Quant(None, rows.where("value IS NOT NULL").drop("group", "bioreplicate"), design)


# ---------------------------------------------------------------- metadata
def read_metadata(spark: SparkSession, path: str, sample_col: str = "sample") -> DataFrame:
    df, names = read_delimited(spark, path)
    require(names, [sample_col], path)
    return df.withColumnRenamed(sample_col, "sample")


def missing_metadata(design: DataFrame, metadata: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Samples of the design that the metadata does not name."""
    return design.select(*by, "sample").join(
        metadata.select(*by, "sample").distinct(), [*by, "sample"], "left_anti"
    )


def apply_metadata(
    design: DataFrame, metadata: DataFrame, columns: Sequence[str], by: Sequence[str] = ()
) -> DataFrame:
    """The design with covariates; a missing column or sample fails by name."""
    absent = [c for c in columns if c not in metadata.columns]
    if absent:
        raise DesignError(f"metadata has no column {absent}")
    left_out = [r["sample"] for r in missing_metadata(design, metadata, by).limit(20).collect()]
    if left_out:
        raise DesignError(f"metadata does not name the samples {left_out}")
    keep = [c for c in design.columns if c not in columns]
    return design.select(*keep).join(
        metadata.select(*by, "sample", *columns), [*by, "sample"]
    )
