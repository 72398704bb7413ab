"""Cut a long plan by writing a table to storage every executor can reach.

A written table survives the loss of executors, which cached blocks do not.
"""

from __future__ import annotations

import atexit
import uuid

from pyspark.sql import DataFrame, SparkSession

_ROOTS: dict[str, str] = {}


def checkpoint_root(spark: SparkSession) -> str:
    """A folder of this session in `spark.checkpoint.dir`, or in the warehouse where that is unset.

    The folder is deleted when the driver ends. On a cluster a warehouse on a local disk will
    not do, since executors would not see each other's files.
    """
    app = spark.sparkContext.applicationId
    if app not in _ROOTS:
        base = spark.conf.get("spark.checkpoint.dir", None)
        if not base:
            base = spark.conf.get("spark.sql.warehouse.dir")
            if base.startswith(("file:", "/")) and not spark.sparkContext.master.startswith("local"):
                raise ValueError(f"set spark.checkpoint.dir to a folder that all executors share; the warehouse {base} is local")
        _ROOTS[app] = f"{base.rstrip('/')}/stages-{app}"
        atexit.register(drop, spark, _ROOTS[app])
    return _ROOTS[app]


def drop(spark: SparkSession, path: str) -> None:
    """Delete a folder of written stages; nothing may read it any more."""
    context = spark.sparkContext
    if context._jsc is None or context._jsc.sc().isStopped():
        return
    folder = context._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(context._jsc.hadoopConfiguration()).delete(folder, True)


def cut_lineage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write `df` once and continue from the written table."""
    spark = df.sparkSession
    path = f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, keys: list[str]) -> DataFrame:
    """Hash `df` by `keys` over all shuffle partitions before Python work per group.

    Adaptive execution would merge small shuffle blocks into one task; the rows
    are few but each one costs a model fit.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(n, *keys)


#: Rows of a task that groups or joins large tables.
TASK_ROWS = 500_000


def dealt(df: DataFrame, keys: list[str], rows: int = TASK_ROWS) -> DataFrame:
    """Hash `df` by `keys` into tasks of about `rows` rows each, so that a task's memory does not grow with the table.

    The rows are counted first, which is cheap where they come from a columnar file.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(max(cores, -(-df.count() // rows)), *keys)
