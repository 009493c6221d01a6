"""Spark session helpers.

The engine never owns cluster settings: on a cluster the session is built by the
user (or spark-submit) and only the knobs below that are still unset get a
default.  Tests and the local bench call :func:`get_session`.
"""
from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "medallion", extra: dict | None = None) -> SparkSession:
    """Return the active session or build a local one with sane defaults."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(_DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_compiled(spark)
    ensure_checkpoint_dir(spark)
    return spark


def ensure_compiled(spark: SparkSession) -> None:
    """Keep generated code within what the JVM compiles; a session that has set the limit keeps its own.

    The JVM never compiles a method beyond 8,000 bytes but interprets it row by row.  With this
    limit Spark generates a wide projection (parsing, rendering) as many small methods instead of
    fusing it into one such method; the results are the same.
    """
    key = "spark.sql.codegen.hugeMethodLimit"
    if spark.conf.get(key) == "65535":  # Spark's own default
        spark.conf.set(key, "8000")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    ``spark.checkpoint.dir`` is read from the session.  Only a local-mode
    session (tests, single-machine runs) without it gets a scratch folder; on a
    cluster a machine-local folder would not be shared, so an unset setting is
    an error there.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        path = spark.sparkContext._jsc.sc().getCheckpointDir()
        path = path.get() if path.isDefined() else None
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        path = tempfile.mkdtemp(prefix="medallion-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A folder for intermediate tables under the shared checkpoint dir; :func:`clear_scratch` deletes it."""
    path = os.path.join(ensure_checkpoint_dir(spark), name)
    note_scratch(spark, path)
    return path


def note_scratch(spark: SparkSession, path: str) -> None:
    """Remember a scratch folder of this application."""
    sc = spark.sparkContext
    sc._medallion_scratch = [*getattr(sc, "_medallion_scratch", []), path]


def clear_scratch(spark: SparkSession) -> int:
    """Delete the scratch tables that this application has written; gives their number.

    Results are lazy and may read them: call this when the results have been written or collected.
    """
    sc = spark.sparkContext
    paths, sc._medallion_scratch = getattr(sc, "_medallion_scratch", []), []
    for path in paths:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
    return len(paths)


def materialized(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet under the shared checkpoint dir and read back.

    For results that are expensive and read several times: a lost executor rereads them.
    """
    path = scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ship_package(spark: SparkSession) -> None:
    """Send this package's source to the executors (once per application).

    Python functions that run in tasks are found there by import; a cluster
    needs no installed copy.
    """
    sc = spark.sparkContext
    if getattr(sc, "_medallion_shipped", False):
        return
    here = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="medallion-src-"), "medallion-src.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, files in sorted(os.walk(here)):
            for f in sorted(files):
                if f.endswith(".py"):
                    full = os.path.join(folder, f)
                    z.write(full, os.path.join("medallion", os.path.relpath(full, here)))
    sc.addPyFile(path)
    sc._medallion_shipped = True
