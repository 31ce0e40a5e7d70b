"""Session defaults and the shared folder in which operators cut lineage."""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_OWN_DIRS: dict[str, str] = {}
_NAMED: dict[str, str | None] = {}


def build_session(app: str = "stepweave", **conf: str) -> SparkSession:
    """A session with the settings every plan here assumes: UTC, AQE, Arrow."""
    builder = SparkSession.builder.appName(app)
    base = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    for key, value in (base | conf).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir`` if the cluster names one.

    Only where it is unset and the master is local, as in tests on one machine,
    a temporary folder is made once per application and removed at its end; on
    a cluster each executor would write to a disk of its own, so there the
    missing setting is an error.
    """
    app = spark.sparkContext.applicationId
    if app not in _NAMED:
        _NAMED[app] = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if named := _NAMED[app]:
        return named.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    if app not in _OWN_DIRS:
        _OWN_DIRS[app] = tempfile.mkdtemp(prefix="stepweave-")
        atexit.register(shutil.rmtree, _OWN_DIRS[app], ignore_errors=True)
    return f"file://{_OWN_DIRS[app]}"


_KEPT: set[str] = set()


def new_folder(spark: SparkSession, name: str) -> str:
    """The path of a folder of its own in the shared folder, which goes with the application."""
    app = f"{shared_dir(spark)}/stepweave/{spark.sparkContext.applicationId}"
    if app not in _KEPT:
        _KEPT.add(app)
        path = spark._jvm.org.apache.hadoop.fs.Path(app)
        files = path.getFileSystem(spark._jsc.hadoopConfiguration())
        files.mkdirs(path)
        files.deleteOnExit(path)
    return f"{app}/{uuid.uuid4().hex}/{name}"


def stored(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder, a folder for each value of ``partition_by``, and read it back.

    This cuts lineage and survives the loss of executors; later branches read
    the written columns instead of computing them again.
    """
    spark = df.sparkSession
    path = new_folder(spark, name)
    writer = df.write.option("compression", "zstd")
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, so that UDFs find it anywhere."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    _SHIPPED.add(app)
    here = os.path.dirname(os.path.abspath(__file__))
    folder = tempfile.mkdtemp(prefix="stepweave-code-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    # Each version of the code gets its own name: Spark keeps files by name.
    archive = shutil.make_archive(os.path.join(folder, f"stepweave-{uuid.uuid4().hex[:8]}"), "zip", os.path.dirname(here), os.path.basename(here))
    spark.sparkContext.addPyFile(archive)
