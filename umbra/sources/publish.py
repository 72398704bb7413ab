"""Publish tables together: written aside, checked where they were written, then made visible at once.

Every table of an export is evaluated once, into a folder of the export's new version. Its
keys are checked on the written table. Only when all tables are sound does the manifest,
one small file, name the new version; a reader follows the manifest, so it sees all tables
of one version or none. A failed check deletes what was written and leaves the published
version as it was.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

from umbra.plans.joins import assert_unique

MANIFEST = "manifest.json"


class Table(NamedTuple):
    """Rows, the keys they are sorted by and unique in (none: neither), and the columns of their folders."""

    rows: DataFrame
    keys: Sequence[str] = ()
    partition_by: Sequence[str] = ()


class _Folder:
    """The file system of a path."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.of = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self.fs = self.of(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def exists(self, path: str) -> bool:
        return self.fs.exists(self.of(path))

    def delete(self, path: str) -> None:
        self.fs.delete(self.of(path), True)

    def move(self, source: str, target: str) -> None:
        """Put `source` in the place of `target`."""
        self.delete(target)
        if not self.fs.rename(self.of(source), self.of(target)):
            raise OSError(f"cannot move {source} to {target}")

    def names(self, path: str) -> list[str]:
        return [x.getPath().getName() for x in self.fs.listStatus(self.of(path))] if self.exists(path) else []

    def write(self, path: str, text: str) -> None:
        stream = self.fs.create(self.of(path), True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()

    def read(self, path: str) -> str:
        return "\n".join(r["value"] for r in self.spark.read.text(path).collect())


def _settle(table: Table, raw: str, target: str) -> None:
    """Write the rows to `raw` once, check their keys there, and write them sorted to `target`."""
    table.rows.write.parquet(raw)
    held = table.rows.sparkSession.read.schema(table.rows.schema).parquet(raw)
    if table.keys:
        assert_unique(held, table.keys, target)
        held = held.repartitionByRange(*table.keys).sortWithinPartitions(*table.keys)
    held.write.partitionBy(*table.partition_by).parquet(target)


def publish_table(table: Table, path: str) -> DataFrame:
    """One table under `path` itself, in the place of what is there; read back."""
    spark, mark = table.rows.sparkSession, uuid.uuid4().hex
    folder = _Folder(spark, path)
    path = path.rstrip("/")
    raw, new = f"{path}-raw-{mark}", f"{path}-new-{mark}"
    try:
        _settle(table, raw, new)
        folder.move(new, path)
    finally:
        folder.delete(raw)
        folder.delete(new)
    return spark.read.parquet(path)


def publish(tables: Mapping[str, Table], path: str) -> dict[str, DataFrame]:
    """All tables as one version of the export under `path`; read back through the manifest."""
    if not tables:
        raise ValueError("an export has at least one table")
    spark, path, version = next(iter(tables.values())).rows.sparkSession, path.rstrip("/"), uuid.uuid4().hex
    folder = _Folder(spark, path)
    root = f"{path}/versions/{version}"
    try:
        for name, table in tables.items():
            _settle(table, f"{root}/raw-{name}", f"{root}/{name}")
            folder.delete(f"{root}/raw-{name}")
    except Exception:
        folder.delete(root)
        raise
    old = manifest(spark, path)
    keys = {name: list(t.keys) for name, t in tables.items()}
    folder.write(f"{path}/{MANIFEST}.{version}", json.dumps({"version": version, "tables": keys}))
    folder.move(f"{path}/{MANIFEST}.{version}", f"{path}/{MANIFEST}")
    # The version before stays for readers that have begun; older ones go.
    for name in folder.names(f"{path}/versions"):
        if name not in (version, (old or {}).get("version")):
            folder.delete(f"{path}/versions/{name}")
    return published(spark, path)


def manifest(spark: SparkSession, path: str) -> dict | None:
    """The manifest of an export, None where nothing is published."""
    folder, at = _Folder(spark, path), f"{path.rstrip('/')}/{MANIFEST}"
    return json.loads(folder.read(at)) if folder.exists(at) else None


def published(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """The tables of the published version."""
    found = manifest(spark, path)
    if found is None:
        raise FileNotFoundError(f"nothing is published under {path}")
    return {name: spark.read.parquet(f"{path.rstrip('/')}/versions/{found['version']}/{name}") for name in found["tables"]}
