"""Session settings and the shared work folder."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession


def tune(spark: SparkSession) -> SparkSession:
    """Set the run-time options the operators count on.

    HotSpot never compiles a method above 8000 bytes of bytecode, so generated
    code above that size would run interpreted; Spark then falls back to
    expression-wise code, which it splits into small methods. Scoring 52 inputs
    against 7 classes runs about twice as fast that way.
    """
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def work_dir(spark: SparkSession, name: str) -> str:
    """A new folder for checkpoints and intermediate tables.

    It lies under ``spark.checkpoint.dir``, the folder every executor can reach.
    Only where that is unset, as in local tests, a temporary folder is made, and
    a session with more than one machine is refused.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
        base = tempfile.mkdtemp(prefix="flowspark-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _hadoop(spark: SparkSession, path: str):
    """The file system of a path, any that Spark can read, and the path there."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def list_folders(spark: SparkSession, pattern: str) -> list[str]:
    """Folders that match a glob pattern, sorted."""
    fs, at = _hadoop(spark, pattern)
    return sorted(x.getPath().toString() for x in fs.globStatus(at) or [] if x.isDirectory())


def remove_folder(spark: SparkSession, path: str) -> None:
    fs, at = _hadoop(spark, path)
    fs.delete(at, True)


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the Python workers of the session, once per application."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="flowspark-"), "flowspark_package")
    root, name = os.path.split(package)
    spark.sparkContext.addPyFile(shutil.make_archive(target, "zip", root, name))
    _shipped.add(app)
