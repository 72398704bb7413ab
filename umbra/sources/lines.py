"""Text files as a DataFrame of lines."""

from __future__ import annotations

import warnings
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from umbra.errors import InputError


def read_lines(spark: SparkSession, path: str | list[str], optional: bool = False) -> DataFrame:
    """Lines of plain or gzipped files; a bad byte becomes one replacement character."""
    try:
        lines = spark.read.text(path)
    except AnalysisException as err:
        if optional and "PATH_NOT_FOUND" in str(err):
            return spark.createDataFrame([], "value string")
        raise
    return lines.select(F.regexp_replace("value", r"\r$", "").alias("value"))


def kept(lines: DataFrame) -> list[str]:
    """Columns a parser passes through, such as the data set key."""
    return [c for c in lines.columns if c not in ("value", "_c")]


def cells(lines: DataFrame, pattern: str = "\t", limit: int = -1, trim: bool = False) -> DataFrame:
    """Lines with their fields as the array `_c`.

    The array goes through a generator, so a line is split once however many
    fields are read; a plain projection would be copied into every use.
    """
    text = F.trim("value") if trim else F.col("value")
    return lines.withColumn("_c", F.explode(F.array(F.split(text, pattern, limit))))


def field(i: int) -> Column:
    return F.get("_c", F.lit(i))


def data_lines(lines: DataFrame, comment: str | None = "#") -> DataFrame:
    out = lines.where(F.trim("value") != "")
    return out.where(~F.startswith("value", F.lit(comment))) if comment else out


def warn_if_unparsed(lines: DataFrame, parsed: DataFrame, what: str, comment: str = "#") -> DataFrame:
    """A file with data that yields no record is a format failure; an empty file is not."""
    if not parsed.limit(1).count() and data_lines(lines, comment).limit(1).count():
        warnings.warn(f"parsed 0 {what} from a non-empty file", stacklevel=2)
    return parsed


def header_of(lines: DataFrame, path: str = "") -> list[str]:
    """The first non-empty line, which names the columns."""
    row = lines.where(F.trim("value") != "").limit(1).collect()
    if not row:
        raise InputError(f"{path}: the file is empty")
    return [row[0]["value"]]


def first_lines(spark: SparkSession, path: str | list[str], pattern: str | None = None) -> DataFrame:
    """file_path and header: the first line with text of each file, or the first that matches.

    A file's first block is read by one task, in order. The set of block starts, which are all
    0, makes Spark keep one row for each file: `first` of a text alone would sort all lines of the block.
    """
    lines = spark.read.text(path).select(F.regexp_replace("value", r"\r$", "").alias("value"), "_metadata.file_path", "_metadata.file_block_start")
    lines = lines.where((F.col("file_block_start") == 0) & (F.col("value").rlike(pattern) if pattern else F.trim("value") != ""))
    return lines.groupBy("file_path").agg(F.first("value").alias("header"), F.collect_set("file_block_start").alias("starts"))


def headers(spark: SparkSession, path: str | list[str], pattern: str | None = None) -> dict[str, list[str]]:
    """Header line -> the files that have it."""
    found: dict[str, list[str]] = {}
    for r in first_lines(spark, path, pattern).orderBy("file_path").collect():
        found.setdefault(r["header"], []).append(r["file_path"])
    return found


def read_delimited(
    spark: SparkSession, path: str | list[str], sep: str | None = None
) -> tuple[DataFrame, list[str]]:
    """Delimited files with a header as all-string columns by name, and the columns.

    Each file is read with its own header; a column that a file lacks is missing there.
    """
    found = headers(spark, path)
    if not found:
        raise InputError(f"{path}: the file is empty")
    out, names = None, []
    for header, files in found.items():
        df, own = _with_header(spark, files, header.lstrip("\ufeff"), sep)
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
        names += [n for n in own if n not in names]
    return out, names


def _with_header(spark: SparkSession, path: list[str], header: str, sep: str | None) -> tuple[DataFrame, list[str]]:
    sep = sep or ("\t" if "\t" in header else ",")
    names = [h.strip().strip('"') for h in header.split(sep)]
    unique, seen = [], {}
    for n in names:
        seen[n] = seen.get(n, 0) + 1
        unique.append(n if seen[n] == 1 else f"{n}.{seen[n] - 1}")
    schema = ", ".join(f"`{n.replace('`', '``')}` string" for n in unique)
    df = (
        spark.read.schema(schema)
        .option("sep", sep)
        .option("header", True)
        .option("enforceSchema", True)
        .option("quote", '"' if sep == "," else "")
        .option("mode", "PERMISSIVE")
        .csv(path)
    )
    return df, unique


def require(names: Sequence[str], wanted: Sequence[str], path: str) -> None:
    missing = [w for w in wanted if w not in names]
    if missing:
        raise InputError(f"{path}: missing column(s) {missing}; columns present: {list(names)[:30]}")
