"""Isobaric runs: one directory per plex, each with its own header and annotation."""

from __future__ import annotations

import fnmatch
import re
from collections.abc import Mapping
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from umbra.errors import DesignError, InputError, OptionError
from umbra.functions import text as T
from umbra.functions.numbers import to_number
from umbra.sources.lines import read_delimited, read_lines, require
from umbra.sources.quant import feature_columns, guard_header, razor_column, unpivot_samples


class PlexRun(NamedTuple):
    """features(feature_id, peptide, razor) united over plexes,
    candidates(feature_id, protein_id), values(plex, feature_id, sample, value),
    design(sample, plex, channel, plex_order), psms(plex, feature_id, purity) or None."""

    features: DataFrame
    candidates: DataFrame
    values: DataFrame
    design: DataFrame
    psms: DataFrame | None


def list_names(spark: SparkSession, path: str, folders_only: bool) -> list[str]:
    """Names in a folder on any file system Spark reads; a large table may be a folder itself."""
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(p):
        raise InputError(f"{path} does not exist")
    if not fs.getFileStatus(p).isDirectory():
        raise InputError(f"{path} is one file; fragpipe_tmt reads the run directory")
    return sorted(
        s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory() or not folders_only
    )


def natural_order(name: str) -> tuple:
    digits = re.search(r"(\d*)$", name).group(1)
    return (name[: len(name) - len(digits)], int(digits or 0), name)


def parse_channels(lines: DataFrame) -> DataFrame:
    """`channel sample` per line."""
    c = F.split(F.trim("value"), r"\s+", 2)
    keep = [k for k in lines.columns if k != "value"]
    return lines.where(F.size(c) == 2).select(
        *keep, F.get(c, 0).alias("channel"), F.trim(F.get(c, 1)).alias("sample")
    )


def annotation_path(root: str, plex: str, rule: str | Mapping[str, str]) -> str:
    """The annotation of a plex, always resolved inside the plex directory."""
    if isinstance(rule, str):
        name = rule.format(plex=plex)
    elif plex in rule:
        name = rule[plex]
    else:
        raise InputError(f"plex {plex} is not in the annotation map")
    return name if "://" in name or name.startswith("/") else f"{root}/{plex}/{name}"


def reporter_columns(names: list[str], channels: list[tuple[str, str]], prefix: str, where: str):
    """column -> (channel, sample); columns are named after samples or after channels."""
    found = [n for n in names if n.startswith(prefix) and n != prefix.strip()]
    by_sample = {prefix + s: (ch, s) for ch, s in channels}
    by_channel = {prefix + ch: (ch, s) for ch, s in channels}
    table = by_sample if any(f in by_sample for f in found) else by_channel
    unmapped = [f for f in found if f not in table]
    if unmapped or not found:
        raise InputError(f"{where}: reporter columns cannot be mapped to samples: {unmapped}")
    return {f: table[f] for f in found}


def read_plexes(
    spark: SparkSession,
    root: str,
    level: str = "ion",
    plex_glob: str = "TMT*",
    annotation: str | Mapping[str, str] = "{plex}_annotation.txt",
    prefix: str = "Intensity ",
    drop_empty: bool = True,
    zero_missing: bool = True,
    with_purity: bool = False,
) -> PlexRun:
    """Headers and annotations are read on the driver, table bodies by the executors."""
    if level not in ("ion", "peptide"):
        raise OptionError(f"level must be ion or peptide, not {level!r}")
    folders = list_names(spark, root, folders_only=True)
    plexes = sorted((f for f in folders if fnmatch.fnmatchcase(f, plex_glob)), key=natural_order)
    if not plexes:
        raise InputError(f"{root}: {plex_glob!r} matches no plex; found {folders}")
    features, values, psms, design, owner = [], [], [], [], {}
    for order, plex in enumerate(plexes):
        files = list_names(spark, f"{root}/{plex}", folders_only=False)
        if f"{level}.tsv" not in files:
            raise InputError(f"plex {plex} has no {level}.tsv; found {files}")
        ann = annotation_path(root, plex, annotation)
        try:
            channels = [
                (r["channel"], r["sample"])
                for r in parse_channels(read_lines(spark, ann)).collect()
            ]
        except Exception as err:
            raise InputError(
                f"plex {plex} has no annotation file {ann} (resolved against the plex "
                f"directory); found {files}"
            ) from err
        path = f"{root}/{plex}/{level}.tsv"
        df, names = read_delimited(spark, path, "\t")
        guard_header(names, "fragpipe_tmt", path)
        columns = reporter_columns(names, channels, prefix, path)
        if drop_empty:
            columns = {c: cs for c, cs in columns.items() if cs[1] != f"{plex}_{cs[0]}"}
        for ch, sample in columns.values():
            if sample in owner:
                raise InputError(
                    f"plexes {owner[sample]} and {plex} both claim the sample name {sample!r}"
                )
            owner[sample] = plex
            design.append((sample, plex, ch, order))
        pep = "Peptide Sequence" if "Peptide Sequence" in names else "Peptide"
        require(names, [pep], path)
        key = T.feature_key(pep, "Modified Sequence", "Charge") if level == "ion" else F.col(pep)
        mapped = F.col("Mapped Proteins") if "Mapped Proteins" in names else F.lit("")
        rows = feature_columns(
            df, key, F.col(f"`{pep}`"), F.col(f"`{razor_column(names, path)}`"), mapped
        ).withColumn("plex", F.lit(plex))
        features.append(rows.select("plex", "feature_id", "peptide", "razor", "candidates"))
        values.append(
            unpivot_samples(
                rows, ["plex", "feature_id"], {c: cs[1] for c, cs in columns.items()}, zero_missing
            )
        )
        if with_purity:
            psms.append(read_purity(spark, f"{root}/{plex}/psm.tsv", level).withColumn(
                "plex", F.lit(plex)))
    return PlexRun(
        unite_features(_union(features)),
        unite_candidates(_union(features)),
        _union(values),
        spark.createDataFrame(design, "sample string, plex string, channel string, plex_order int"),
        _union(psms) if psms else None,
    )


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def read_purity(spark: SparkSession, path: str, level: str = "ion") -> DataFrame:
    """(feature_id, purity) per spectrum, keyed like the feature table."""
    df, names = read_delimited(spark, path, "\t")
    wanted = ["Peptide", "Purity"] + (["Modified Peptide", "Charge"] if level == "ion" else [])
    require(names, wanted, path)
    key = T.feature_key("Peptide", "Modified Peptide", "Charge") if level == "ion" else F.col("Peptide")
    return df.select(key.alias("feature_id"), to_number("Purity").alias("purity"))


def unite_features(features: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """One row per feature over all plexes; the razor is that of the first plex in natural order, `TMT9` before `TMT10`."""
    return features.groupBy(*by, "feature_id").agg(
        F.min("peptide").alias("peptide"),
        F.min_by("razor", F.struct(*[c.alias(f"k{i}") for i, c in enumerate(T.natural_key("plex"))])).alias("razor"),
    )


def unite_candidates(features: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Distinct (feature, protein) pairs over all plexes, never gathered into one list."""
    pairs = features.select(*by, "feature_id", F.explode("candidates").alias("protein_id"))
    return pairs.distinct()


def resolve_reference(
    design: DataFrame, name: str = "", channel: str = "", by: tuple[str, ...] = ()
) -> DataFrame:
    """The design with `is_reference`; exactly one reference per plex."""
    if name and channel:
        raise OptionError("set reference_name or reference_channel, not both")
    if not (name or channel):
        return design.withColumn("is_reference", F.lit(False))
    column, pattern = ("sample", name) if name else ("channel", channel)
    regex = fnmatch.translate(pattern).replace("(?s:", "(?s)(?:").replace(r"\z", r"\z").replace(
        r"\Z", r"\z")
    marked = design.withColumn("is_reference", F.col(column).rlike("^" + regex))
    per_plex = marked.groupBy(*by, "plex").agg(F.count_if("is_reference").alias("n"))
    bad = per_plex.where("n <> 1").orderBy("plex").limit(20).collect()
    if bad:
        said = "; ".join(f"plex {r['plex']}: {pattern!r} matches {r['n']} of its channels" for r in bad)
        hint = "" if name else "; reference_name follows a pool that moves between channels"
        raise DesignError(said + hint)
    return marked
