"""Protein sequences, annotation tables, gene coordinates and other protein-keyed tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from umbra.errors import InputError
from umbra.functions import text as T
from umbra.sources.lines import cells, data_lines, field, headers, kept, read_lines, warn_if_unparsed

# The annotation table's columns, in file order.
EGGNOG_COLUMNS = (
    "query", "seed_ortholog", "evalue", "score", "eggNOG_OGs", "max_annot_lvl",
    "COG_category", "Description", "Preferred_name", "GOs", "EC", "KEGG_ko",
    "KEGG_Pathway", "KEGG_Module", "KEGG_Reaction", "KEGG_rclass", "BRITE",
    "KEGG_TC", "CAZy", "BiGG_Reaction", "PFAMs",
)
# Names used by version 2.0 headers.
EGGNOG_ALIASES = {
    "query_name": "query",
    "seed_eggNOG_ortholog": "seed_ortholog",
    "seed_ortholog_evalue": "evalue",
    "seed_ortholog_score": "score",
    "COG Functional cat.": "COG_category",
    "eggNOG free text desc.": "Description",
}


# ---------------------------------------------------------------- sequences
def parse_fasta(records: DataFrame) -> DataFrame:
    """`value` holds one record (header line, then sequence lines) -> protein columns."""
    body = F.regexp_replace("value", r"^>", "")
    header = F.regexp_replace(F.substring_index(body, "\n", 1), r"\r$", "")
    pid = T.first_token(header)
    checked = F.when(pid != "", pid).otherwise(
        F.raise_error(F.lit("FASTA record with an empty identifier"))
    )
    seq = F.regexp_replace(F.regexp_replace(body, r"^[^\n]*\n?", ""), r"\s+", "")
    return records.where(F.trim("value") != "").select(
        *kept(records),
        checked.alias("protein_id"),
        F.trim(F.regexp_replace(header, r"^\s*\S+\s*", "")).alias("description"),
        seq.alias("seq"),
        F.length(seq).alias("length"),
    )


def first_record(records: DataFrame, order: list[str], keys: list[str]) -> DataFrame:
    """Keep the first record of a repeated id and count the rest in `n_duplicates`."""
    rest = [c for c in records.columns if c not in {*keys, *order}]
    packed = F.min(F.struct(*order, *rest)).alias("_r")
    return records.groupBy(*keys).agg(packed, (F.count("*") - 1).alias("n_duplicates")).select(
        *keys, *[F.col(f"_r.{c}").alias(c) for c in rest], "n_duplicates"
    )


def read_fasta(spark: SparkSession, path: str | list[str]) -> DataFrame:
    raw = (
        spark.read.option("lineSep", "\n>")
        .text(path)
        .select(
            "value",
            F.col("_metadata.file_path").alias("_file"),
            F.col("_metadata.file_block_start").alias("_block"),
            F.monotonically_increasing_id().alias("_row"),
        )
    )
    return first_record(parse_fasta(raw), ["_file", "_block", "_row"], ["protein_id"])


# ---------------------------------------------------------------- annotation
def parse_eggnog(lines: DataFrame, header: str | None) -> DataFrame:
    """Annotation rows by the names in `header` (None: the file has no data rows)."""
    extra = kept(lines)
    if header is None:
        schema = ", ".join(["protein_id string"] + [f"{c} string" for c in EGGNOG_COLUMNS[1:]])
        return lines.sparkSession.createDataFrame([], schema)
    names = [EGGNOG_ALIASES.get(n.strip(), n.strip()) for n in header.lstrip("#").split("\t")]
    out = [T.blank_to_null(field(names.index("query"))).alias("protein_id")]
    for c in EGGNOG_COLUMNS[1:]:
        cell = T.blank_to_null(field(names.index(c))) if c in names else F.lit(None)
        out.append(cell.cast("string").alias(c))
    return cells(data_lines(lines)).select(*extra, *out).where("protein_id IS NOT NULL")


def eggnog_header(lines: DataFrame) -> str | None:
    """The `#query` line; fails when there is data but no such line."""
    found = lines.where(F.col("value").rlike(r"^#query")).limit(1).collect()
    if found:
        return found[0]["value"]
    if data_lines(lines).limit(1).count():
        raise InputError("the annotation table has no #query header line")
    return None


def read_eggnog(spark: SparkSession, path: str | list[str]) -> DataFrame:
    found = headers(spark, path, r"^#query")
    if len(found) < 2:
        lines = read_lines(spark, path)
        return parse_eggnog(lines, eggnog_header(lines))
    out = None  # files of different versions: each by its own header
    for header, files in found.items():
        part = parse_eggnog(read_lines(spark, files), header)
        out = part if out is None else out.unionByName(part)
    return out


def typed_eggnog(eggnog: DataFrame) -> DataFrame:
    """Multi-valued cells as sets, with the taxid of the seed ortholog."""
    extra = [c for c in eggnog.columns if c not in {*EGGNOG_COLUMNS, "protein_id"}]
    return eggnog.select(
        *extra,
        "protein_id",
        T.seed_taxid("seed_ortholog").alias("eggnog_taxid"),
        F.col("Description").alias("eggnog_desc"),
        T.ko_list("KEGG_ko").alias("ko"),
        T.split_list("KEGG_Pathway").alias("pathway"),
        T.split_list("CAZy").alias("cazy"),
        T.split_list("PFAMs").alias("pfams_emapper"),
    )


# ---------------------------------------------------------------- profile library
def parse_hmm_library(records: DataFrame) -> DataFrame:
    """One profile record per row -> (name, accession, description)."""

    def tagged(tag: str) -> Column:
        v = F.regexp_extract("value", rf"(?m)^{tag}[ \t]+(.*?)\r?$", 1)
        return T.blank_to_null(v)

    return records.select(
        *kept(records),
        tagged("NAME").alias("name"),
        tagged("ACC").alias("accession"),
        tagged("DESC").alias("description"),
    ).where("name IS NOT NULL")


def read_hmm_library(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return parse_hmm_library(spark.read.option("lineSep", "//\n").text(path))


# ---------------------------------------------------------------- pairs and coordinates
def parse_clusters(lines: DataFrame) -> DataFrame:
    """representative <tab> member -> (protein_id, family_id)."""
    return cells(data_lines(lines)).select(
        *kept(lines),
        T.blank_to_null(field(1)).alias("protein_id"),
        T.blank_to_null(field(0)).alias("family_id"),
    ).where("protein_id IS NOT NULL AND family_id IS NOT NULL")


def read_clusters(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return parse_clusters(read_lines(spark, path, optional=True))


def parse_gff(lines: DataFrame, feature: str = "CDS") -> DataFrame:
    """Gene coordinates keyed to the protein id in the attribute column."""
    attrs = field(8)

    def attr(name: str) -> Column:
        return T.blank_to_null(F.regexp_extract(attrs, rf"(?:^|;)\s*{name}=([^;]*)", 1))

    return cells(data_lines(lines)).where(field(2) == feature).select(
        *kept(lines),
        T.blank_to_null(field(0)).alias("contig"),
        field(3).try_cast("long").alias("start"),
        field(4).try_cast("long").alias("end"),
        field(6).alias("strand"),
        F.coalesce(attr("protein_id"), attr("ID")).alias("protein_id"),
    ).where("contig IS NOT NULL AND start IS NOT NULL AND end IS NOT NULL AND protein_id IS NOT NULL")


def read_gff(spark: SparkSession, path: str | list[str]) -> DataFrame:
    lines = read_lines(spark, path)
    return warn_if_unparsed(lines, parse_gff(lines), "gene rows")


def parse_context(lines: DataFrame, header: list[str]) -> DataFrame:
    """Neighbourhood table: integer columns stay counts, only text `true` is a flag."""
    out = [T.first_token(field(header.index("protein_id"))).alias("protein_id")]
    flags = []
    for i, name in enumerate(header):
        cell = F.lower(F.trim(field(i)))
        if name == "protein_id":
            continue
        if name.startswith("n_"):
            out.append(cell.try_cast("long").alias(name))
        else:
            out.append(F.coalesce(cell == "true", F.lit(False)).alias(name))
            flags.append(name)
    raised = F.filter(
        F.array(*[F.when(F.col(f), F.lit(f)) for f in flags]) if flags else F.array().cast("array<string>"),
        lambda x: x.isNotNull(),
    )
    return (
        cells(lines.where((F.col("value") != "\t".join(header)) & (F.trim("value") != "")))
        .select(*kept(lines), *out)
        .withColumn("context_flags", raised)
    )


def read_context(spark: SparkSession, path: str) -> DataFrame:
    lines = read_lines(spark, path, optional=True)
    if not lines.limit(1).count():
        return spark.createDataFrame([], "protein_id string, context_flags array<string>")
    out = None
    for header, files in headers(spark, path).items():
        part = parse_context(read_lines(spark, files), header.split("\t"))
        out = part if out is None else out.unionByName(part)
    return out


def parse_failures(lines: DataFrame) -> DataFrame:
    """protein_id, length, error of structures that were tried and failed."""
    return cells(lines.where(~F.startswith("value", F.lit("protein_id\t")))).select(
        *kept(lines),
        T.blank_to_null(field(0)).alias("protein_id"),
        field(1).try_cast("int").alias("length"),
        field(2).alias("error"),
    ).where("protein_id IS NOT NULL")


def read_failures(spark: SparkSession, path: str) -> DataFrame | None:
    """None when there is no record at all; an empty table when nothing failed."""
    lines = read_lines(spark, path, optional=True)
    return parse_failures(lines) if lines.limit(1).count() else None


def parse_signalp(lines: DataFrame) -> DataFrame:
    return cells(data_lines(lines), trim=True).select(
        *kept(lines),
        T.first_token(field(0)).alias("protein_id"),
        T.blank_to_null(field(1)).alias("sp_class"),
    ).where("protein_id <> '' AND sp_class IS NOT NULL")


def read_signalp(spark: SparkSession, path: str | list[str]) -> DataFrame:
    lines = read_lines(spark, path, optional=True)
    return warn_if_unparsed(lines, parse_signalp(lines), "signal peptide calls")


def parse_tmbed(records: DataFrame) -> DataFrame:
    """Three-line records; a change of letter case starts a new segment."""
    lines = F.split(F.regexp_replace(F.regexp_replace("value", r"^>", ""), "\r", ""), "\n")
    labels = F.coalesce(F.trim(F.get(lines, 2)), F.lit(""))
    return records.select(
        *kept(records),
        T.first_token(F.get(lines, 0)).alias("protein_id"),
        F.regexp_count(labels, F.lit("H+|h+")).alias("n_tmh"),
        F.regexp_count(labels, F.lit("B+|b+")).alias("n_tmb"),
    ).where("protein_id <> ''").where(labels != "")


def read_tmbed(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return parse_tmbed(spark.read.option("lineSep", "\n>").text(path))
