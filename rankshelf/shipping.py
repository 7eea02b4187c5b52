"""Make the package importable in Python workers (same as ``--py-files``).

Operators that run Python on executors (``applyInPandas``, ``mapInPandas``)
call :func:`ship` first. When the package is already installed on the cluster
this is a no-op apart from one small zip per session.
"""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    sc = spark.sparkContext
    key = sc.applicationId
    if key in _SHIPPED:
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg_dir)
    fd, path = tempfile.mkstemp(prefix="rankshelf-", suffix=".zip")
    os.close(fd)
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as zf:
        for folder, _, files in os.walk(pkg_dir):
            if "__pycache__" in folder:
                continue
            for name in files:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    zf.write(full, os.path.relpath(full, root))
    sc.addPyFile(_to_shared(spark, path))
    _SHIPPED.add(key)


def _to_shared(spark: SparkSession, local_zip: str) -> str:
    """Copy the zip next to the session's checkpoint folder when that is on shared storage."""
    base = spark.sparkContext.getCheckpointDir() or ""
    if "://" not in base or base.startswith("file:"):
        return local_zip
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    dst = jvm.org.apache.hadoop.fs.Path(f"{base.rstrip('/')}/{os.path.basename(local_zip)}")
    dst.getFileSystem(conf).copyFromLocalFile(False, True, jvm.org.apache.hadoop.fs.Path("file://" + local_zip), dst)
    return dst.toString()
