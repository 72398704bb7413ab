"""Search tool outputs as one long hits table.

Every parser gives the same columns, so evidence is a plain union:
protein_id, source, db, name, accession, description, evalue, score, ident, qcov.
"""

from __future__ import annotations

import warnings
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from umbra.functions import text as T
from umbra.functions.numbers import to_number
from umbra.sources.lines import cells, data_lines, field, headers, kept, read_lines, warn_if_unparsed

HIT_COLUMNS = {
    "protein_id": "string",
    "source": "string",
    "db": "string",
    "name": "string",
    "accession": "string",
    "description": "string",
    "evalue": "double",
    "score": "double",
    "ident": "double",
    "qcov": "double",
}


def hit(lines: DataFrame, source: str, **columns: Column) -> DataFrame:
    """Rows in the common layout; rows without a protein id are dropped."""
    given = {"source": F.lit(source), "db": F.lit(source), **columns}
    out = [
        given.get(c, F.lit(None)).cast(t).alias(c) for c, t in HIT_COLUMNS.items()
    ]
    return lines.select(*kept(lines), *out).where("protein_id IS NOT NULL AND protein_id <> ''")


# ---------------------------------------------------------------- profile searches
def parse_tblout(lines: DataFrame, source: str = "pfam") -> DataFrame:
    """18 fixed columns and a free-text description; keyed on the target sequence."""
    whole = F.size("_c") >= 19
    rows = cells(data_lines(lines), r"\s+", 19, trim=True)
    out = hit(
        rows,
        source,
        protein_id=field(0),
        name=field(2),
        accession=T.blank_to_null(field(3)),
        description=F.when(whole, T.blank_to_null(field(18))),
        evalue=to_number(field(4)),
        score=to_number(field(5)),
    )
    return out.where("evalue IS NOT NULL AND score IS NOT NULL")


def by_query(tblout: DataFrame, source: str = "jackhmmer") -> DataFrame:
    """The same table keyed on the query, without self hits and descriptions."""
    extra = [c for c in tblout.columns if c not in HIT_COLUMNS]
    return tblout.where("protein_id <> name").select(
        *extra,
        F.col("name").alias("protein_id"),
        F.lit(source).alias("source"),
        F.lit(source).alias("db"),
        F.col("protein_id").alias("name"),
        F.lit(None).cast("string").alias("accession"),
        F.lit(None).cast("string").alias("description"),
        "evalue", "score", "ident", "qcov",
    )


def parse_domtblout(
    lines: DataFrame, min_cov: float = 0.35, max_evalue: float = 1e-15, source: str = "dbcan"
) -> DataFrame:
    """Domains that cover enough of their model at a low enough independent e-value."""
    cov = (to_number(field(16)) - to_number(field(15)) + 1) / F.nullif(
        to_number(field(5)), F.lit(0.0)
    )
    return hit(
        cells(data_lines(lines), r"\s+", 23, trim=True),
        source,
        protein_id=field(0),
        name=F.regexp_replace(field(3), r"\.hmm$", ""),
        accession=T.blank_to_null(field(4)),
        evalue=to_number(field(12)),
        score=to_number(field(13)),
        qcov=cov,
    ).where((F.col("qcov") >= min_cov) & (F.col("evalue") <= max_evalue))


def parse_hhr(files: DataFrame, min_prob: float = 90.0, source: str = "hhblits") -> DataFrame:
    """One file per row: fixed-width hit lines below the `Query` line."""
    query = T.first_token(F.regexp_extract("value", r"(?m)^Query[ \t]+(.*)$", 1))
    rows = files.select(
        *kept(files), query.alias("_query"), F.explode(F.split("value", r"\r?\n")).alias("value")
    ).where(F.col("value").rlike(r"^ *\d+ .{30} +[\d.]+ "))
    label = F.regexp_extract("value", r"^ *\d+ (.{30})", 1)
    rest = F.split(F.trim(F.regexp_replace("value", r"^ *\d+ .{30}", "")), r"\s+")
    out = hit(
        rows,
        source,
        protein_id=F.col("_query"),
        name=T.first_token(label),
        description=T.blank_to_null(F.regexp_replace(F.trim(label), r"^\S+\s*", "")),
        score=to_number(F.get(rest, 0)),
        evalue=to_number(F.get(rest, 1)),
    ).where(F.col("score") >= min_prob)
    return out.drop("_query")


# ---------------------------------------------------------------- alignments
def parse_diamond(
    lines: DataFrame,
    db: Column | str = "diamond",
    evalue: float = 1e-10,
    qcov: float = 50.0,
    ident: float = 30.0,
    max_evalues: Mapping[str, float] | None = None,
    min_idents: Mapping[str, float] | None = None,
) -> DataFrame:
    """The nine-column layout; a row in another layout gives no hit.

    Limits apply per database tag where the tag is listed, otherwise the defaults.
    """
    tag = F.lit(db) if isinstance(db, str) else db
    rows = cells(data_lines(lines)).where(F.size("_c") == 9)
    hits = hit(
        rows,
        "diamond",
        db=tag,
        protein_id=T.first_token(field(0)),
        name=field(1),
        description=T.blank_to_null(field(8)),
        ident=to_number(field(2)),
        evalue=to_number(field(4)),
        score=to_number(field(5)),
        qcov=to_number(field(6)),
    )
    return per_database_thresholds(hits, evalue, qcov, ident, max_evalues, min_idents)


def _limit(values: Mapping[str, float] | None, default: float) -> Column:
    """A per-tag number as an expression over `db`; the mapping comes from options."""
    for tag, v in (values or {}).items():
        if isinstance(v, bool) or not isinstance(v, (int, float)):
            raise ValueError(f"limit for {tag!r} must be a number, not {v!r}")
    if not values:
        return F.lit(float(default))
    table = F.create_map(*[F.lit(x) for kv in values.items() for x in (kv[0], float(kv[1]))])
    return F.coalesce(F.element_at(table, F.col("db")), F.lit(float(default)))


def per_database_thresholds(
    hits: DataFrame,
    evalue: float = 1e-10,
    qcov: float = 50.0,
    ident: float = 30.0,
    max_evalues: Mapping[str, float] | None = None,
    min_idents: Mapping[str, float] | None = None,
) -> DataFrame:
    return hits.where(
        (F.col("evalue") <= _limit(max_evalues, evalue))
        & (F.col("qcov") >= qcov)
        & (F.col("ident") >= _limit(min_idents, ident))
    )


def read_diamond(spark: SparkSession, path: str | list[str], **limits) -> DataFrame:
    """Every table of a folder; the file name is the database tag."""
    lines = spark.read.text(path).select(
        F.regexp_replace("value", r"\r$", "").alias("value"),
        T.basename(F.col("_metadata.file_path")).alias("_tag"),
    )
    hits = parse_diamond(lines, db=F.col("_tag"), **limits).drop("_tag")
    return warn_if_unparsed(lines, hits, "alignments in the column format read here")


def foldseek_columns(header: str | None) -> list[str]:
    # The layout written without a header.
    legacy = ["query", "target", "fident", "alnlen", "evalue", "bits", "prob", "alntmscore",
              "lddt", "theader", "target_db"]
    return header.lstrip("#").split("\t") if header else legacy


def parse_foldseek(
    lines: DataFrame,
    header: str | None = None,
    evalue: float = 1e-3,
    prob: float = 0.9,
    tm: float = 0.5,
) -> DataFrame:
    """Structure hits; the query-normalised score is used where the file has it."""
    names = foldseek_columns(header)

    def cell(name: str) -> Column:
        return field(names.index(name)) if name in names else F.lit(None).cast("string")

    tm_score = cell("qtmscore") if "qtmscore" in names else cell("alntmscore")
    rows = cells(data_lines(lines))
    return hit(
        rows.where((to_number(tm_score) >= tm) & (to_number(cell("prob")) >= prob)),
        "foldseek",
        db=F.coalesce(T.blank_to_null(cell("target_db")), F.lit("foldseek")),
        protein_id=F.regexp_replace(T.first_token(cell("query")), r"\.pdb(_[A-Za-z0-9]+)?$", ""),
        name=cell("target"),
        description=T.blank_to_null(cell("theader")),
        evalue=to_number(cell("evalue")),
        score=to_number(cell("bits")),
        ident=to_number(cell("fident")),
    ).where(F.col("evalue") <= evalue)


def is_legacy_foldseek(header: str | None) -> bool:
    """The alignment-normalised score makes the gate weaker, which a caller should say."""
    return "qtmscore" not in foldseek_columns(header)


def read_foldseek(spark: SparkSession, path: str | list[str], **limits) -> DataFrame:
    """Structure hits of a folder whose files have each their own columns, or no header at all.

    Files without the query-normalised score pass a weaker gate, which is said.
    """
    files = spark.read.text(path).select("_metadata.file_path").distinct()
    found = headers(spark, path, r"^#?query\t")
    headed = {f for names in found.values() for f in names}
    plain = sorted(r["file_path"] for r in files.collect() if r["file_path"] not in headed)
    layouts = [*found.items(), *([(None, plain)] if plain else [])]
    legacy = sum(len(names) for header, names in layouts if is_legacy_foldseek(header))
    if legacy:
        warnings.warn(f"{legacy} structure file(s) without qtmscore: the gate on alntmscore is weaker", stacklevel=2)
    out, lines = None, read_lines(spark, path)
    for header, names in layouts:
        rows = read_lines(spark, names)
        rows = rows.where(~F.col("value").rlike(r"^#?query\t")) if header else rows
        hits = parse_foldseek(rows, header, **limits)
        out = hits if out is None else out.unionByName(hits)
    if out is None:  # no file with a line
        return parse_foldseek(lines, None, **limits)
    return warn_if_unparsed(lines, out, "structure hits")


# ---------------------------------------------------------------- orthology and signatures
def parse_kofam(lines: DataFrame) -> DataFrame:
    """Rows flagged `*`; the quotes around the definition are removed."""
    return hit(
        cells(lines).where((field(0) == "*") & (F.size("_c") >= 6)),
        "kofam",
        protein_id=T.first_token(field(1)),
        name=field(2),
        accession=field(2),
        score=to_number(field(4)),
        evalue=to_number(field(5)),
        description=F.regexp_replace(field(6), '^"|"$', ""),
    ).where("score IS NOT NULL")


def parse_interproscan(lines: DataFrame) -> DataFrame:
    """11 to 14 columns; `db` is the member analysis and `ipr` may be missing."""
    rows = cells(data_lines(lines, None)).where(F.size("_c") >= 11).withColumns(
        {
            "ipr": T.blank_to_null(field(11)),
            "ipr_desc": T.blank_to_null(field(12)),
            "go": T.blank_to_null(field(13)),
        }
    )
    return hit(
        rows,
        "interpro",
        db=field(3),
        protein_id=T.first_token(field(0)),
        name=field(4),
        accession=field(4),
        description=F.coalesce(T.blank_to_null(field(5)), F.col("ipr_desc")),
        evalue=to_number(field(8)),
    )


def read_hits(spark: SparkSession, path: str | list[str], parser, what: str, **options) -> DataFrame:
    """Lines of a tool output through `parser`, warning when nothing parses."""
    lines = read_lines(spark, path, optional=True)
    return warn_if_unparsed(lines, parser(lines, **options), what)


def read_hhr(spark: SparkSession, path: str | list[str], min_prob: float = 90.0) -> DataFrame:
    return parse_hhr(spark.read.text(path, wholetext=True), min_prob)


# ---------------------------------------------------------------- best hits
def best_hit(
    hits: DataFrame,
    keys: Sequence[str] = ("protein_id", "db"),
    priority: Sequence[str] | None = None,
) -> DataFrame:
    """One hit per key: target database priority, then bit score, e-value and name.

    An aggregate instead of a sorted window, so a key with very many hits is
    reduced before the shuffle.
    """
    rest = [c for c in hits.columns if c not in keys]
    rank = F.lit(0)
    if priority:
        where = F.array_position(F.array(*[F.lit(p) for p in priority]), F.col("db"))
        rank = F.when(where > 0, where).otherwise(F.lit(len(priority) + 1))
    order = F.struct(
        rank.alias("p"),
        (-F.coalesce(F.col("score"), F.lit(float("-inf")))).alias("s"),
        F.coalesce(F.col("evalue"), F.lit(float("inf"))).alias("e"),
        F.col("name").alias("n"),
        F.struct(*rest).alias("r"),
    )
    return hits.groupBy(*keys).agg(F.min(order).alias("_b")).select(
        *keys, *[F.col(f"_b.r.{c}").alias(c) for c in rest]
    )
