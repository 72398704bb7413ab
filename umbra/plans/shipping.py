"""Give the workers the packages that Python functions in plans refer to."""

from __future__ import annotations

import io
import os
import zipfile

from pyspark.sql import SparkSession

from umbra.plans.lineage import checkpoint_root

_SHIPPED: set[str] = set()


def archive(root: str, names: tuple[str, ...]) -> bytes:
    """A zip of the Python files of these packages and modules under `root`."""
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for name in names:
            if os.path.isfile(f"{root}/{name}.py"):
                z.write(f"{root}/{name}.py", f"{name}.py")
            for folder, _, files in os.walk(f"{root}/{name}"):
                for f in sorted(files):
                    if f.endswith(".py"):
                        z.write(f"{folder}/{f}", os.path.relpath(f"{folder}/{f}", root))
    return out.getvalue()


def ship(spark: SparkSession, root: str, names: tuple[str, ...]) -> None:
    """Once per application: write the zip to the shared folder and add it to the workers' path."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    target = f"{checkpoint_root(spark)}/packages.zip"
    path = context._jvm.org.apache.hadoop.fs.Path(target)
    stream = path.getFileSystem(context._jsc.hadoopConfiguration()).create(path, True)
    try:
        stream.write(bytearray(archive(root, names)))
    finally:
        stream.close()
    context.addPyFile(target)
    _SHIPPED.add(context.applicationId)
