"""Session settings the engine relies on, and its shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"

_own_folder: str | None = None


def configure(spark: SparkSession) -> SparkSession:
    """Pin what results depend on: dates are read and shown in UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def ship_package(spark: SparkSession) -> SparkSession:
    """Make this package importable in the executors' Python, once per context.

    Spark hands the archive out itself, so it may lie in a local folder.
    """
    context = spark.sparkContext
    if getattr(context, "_foliosearch_shipped", None) is None:
        home = os.path.dirname(os.path.abspath(__file__))
        archive = os.path.join(tempfile.mkdtemp(prefix="foliosearch-"), "foliosearch.zip")
        with zipfile.ZipFile(archive, "w") as out:
            for folder, _, files in sorted(os.walk(home)):
                for name in sorted(files):
                    if name.endswith(".py"):
                        path = os.path.join(folder, name)
                        out.write(path, os.path.relpath(path, os.path.dirname(home)))
        context.addPyFile(archive)
        context._foliosearch_shipped = archive
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by the cluster.

    Only in local mode (a laptop, the tests) may it be unset; then a temporary
    folder is made, once per process.
    """
    global _own_folder
    folder = spark.conf.get(CHECKPOINT_DIR, None)
    if not folder:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError(f"set {CHECKPOINT_DIR} to a folder that all executors reach")
        _own_folder = _own_folder or tempfile.mkdtemp(prefix="foliosearch-")
        folder = _own_folder
    return folder.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that nobody has used before."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, paths: list[str]) -> None:
    """Delete files or folders, wherever they are stored."""
    jvm = spark.sparkContext._jvm
    for path in paths:
        named = jvm.java.net.URI(path) if ":/" in path else path
        target = jvm.org.apache.hadoop.fs.Path(named)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def discard(spark: SparkSession, path: str) -> None:
    """Remove a scratch path that is done with; anything else stays."""
    if path.startswith(shared_folder(spark) + "/"):
        remove(spark, [path])
