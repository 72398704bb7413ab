"""Writers: Parquet tables, small TSV copies, FASTA and peptide lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from umbra.functions import text as T
from umbra.plans.joins import lookup_join
from umbra.sources.publish import Table, publish, publish_table


def flat(df: DataFrame) -> DataFrame:
    """Sets as `;`-joined text, for delimited files."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        out.append(F.array_join(c.cast("array<string>"), ";").alias(f.name)
                   if f.dataType.typeName() == "array" else c)
    return df.select(*out)


def write_result_table(
    df: DataFrame,
    path: str,
    keys: Sequence[str],
    partition_by: Sequence[str] = (),
    tsv_path: str | None = None,
    tsv_files: int | None = 1,
) -> DataFrame:
    """Sorted Parquet with unique keys, and a sorted TSV copy where asked for.

    The copy is one file unless the caller gives another number, or None for as many as
    the sort makes. The table is evaluated once; with a repeated key nothing is written.
    """
    back = publish_table(Table(df, keys, partition_by), path)
    if tsv_path:
        ordered = flat(back).orderBy(*keys)
        (ordered.coalesce(tsv_files) if tsv_files else ordered).write.mode("overwrite").option("sep", "\t").option(
            "header", True
        ).option("encoding", "UTF-8").csv(tsv_path)
    return back


def wide_quant(
    values: DataFrame, samples: Sequence[str], keys: Sequence[str] = ("protein_id",)
) -> DataFrame:
    """One column per sample in the order given; a listed sample without values is NULL."""
    return values.groupBy(*keys).pivot("sample", list(samples)).agg(F.sum("value"))


def write_wide_quant(
    values: DataFrame, design: DataFrame, path: str, keys: Sequence[str] = ("protein_id",)
) -> list[str]:
    """Pivot in design order and record the sample columns beside the table, which `published(spark, path)` gives back."""
    order = [*T.natural_key("plex")] if "plex" in design.columns else []
    rows = design.orderBy(*order, *T.natural_key("sample")).select("sample").collect()
    samples = [r["sample"] for r in rows]
    columns = values.sparkSession.createDataFrame([(i, s) for i, s in enumerate(samples)], "position int, sample string")
    publish({"quant": Table(wide_quant(values, samples, keys), keys), "samples": Table(columns, ["position"])}, path)
    return samples


def linked_assays(
    quant: DataFrame,
    annotation: DataFrame,
    design: DataFrame,
    features: DataFrame | None = None,
    feature_values: DataFrame | None = None,
    assigned: DataFrame | None = None,
    results: DataFrame | None = None,
    by: Sequence[str] = (),
    export_features: bool = True,
) -> dict[str, DataFrame]:
    """Peptide and protein tables linked by the assignment actually made.

    Protein-level input, or `export_features` off, gives the protein tables
    only. Results are folded in as `DE.<contrast>.<column>`.
    """
    keys = [*by, "protein_id"]
    proteins = annotation
    if results is not None:
        names = sorted(r["contrast"] for r in results.select("contrast").distinct().collect())
        columns = ["lfc", "p_value", "q_value"]
        wide = results.groupBy(*keys).agg(
            *[
                F.max(F.when(F.col("contrast") == n, F.col(c))).alias(f"DE.{n}.{c}")
                for n in names
                for c in columns
            ]
        )
        proteins = lookup_join(annotation, wide, keys)
    out = {"proteins": proteins, "protein_values": quant, "samples": design}
    if features is not None and export_features:
        out["peptides"] = lookup_join(
            features.select(*by, "feature_id", "peptide", "razor"),
            assigned.select(*by, "feature_id", "assignment_class"),
            [*by, "feature_id"],
        )
        out["peptide_values"] = feature_values
        out["link"] = assigned.where("assigned IS NOT NULL").select(
            *by, "feature_id", F.col("assigned").alias("protein_id")
        )
    return out


def write_linked_assays(tables: dict[str, DataFrame], path: str, by: Sequence[str] = ()) -> dict[str, DataFrame]:
    """All tables as one published version, with unique keys where a table has one; read back."""
    keys = {
        "proteins": ["protein_id"], "samples": ["sample"], "peptides": ["feature_id"], "link": ["feature_id"],
        "protein_values": ["protein_id", "sample"], "peptide_values": ["feature_id", "sample"],
    }
    return publish({name: Table(df, [*by, *keys[name]]) for name, df in tables.items()}, path)


def fasta_text(pid: Column | str = "protein_id", seq: Column | str = "seq") -> Column:
    return F.concat(F.lit(">"), T.col(pid), F.lit("\n"), T.col(seq))


def write_fasta(proteins: DataFrame, path: str) -> None:
    proteins.select(fasta_text().alias("value")).write.mode("overwrite").text(path)


def peptide_list(features: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Distinct bare peptides for a taxonomy query."""
    bare = T.peptide_normalise("peptide")
    return features.select(*by, bare.alias("peptide")).where("peptide <> ''").distinct()


def write_peptide_list(features: DataFrame, path: str) -> None:
    peptide_list(features).select("peptide").write.mode("overwrite").text(path)


__all__ = [
    "fasta_text", "flat", "linked_assays", "peptide_list", "wide_quant",
    "write_fasta", "write_linked_assays", "write_peptide_list", "write_result_table",
    "write_wide_quant",
]
