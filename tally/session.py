"""Session helpers.

The library never creates its own cluster settings for production use: a
cluster session comes in fully configured.  ``local_session`` is for tests
and the bench; ``ensure_checkpoint_dir`` only fills in a checkpoint folder
when the session has none (never on a configured cluster).
"""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

# JVM option for the driver and executors: whole-stage code generation fuses
# a scan, a pushed-down filter and the cleaning projections into one method;
# when that method is larger than the JIT's default size limit it runs in the
# bytecode interpreter (several times slower).  This lets the JIT compile it.
# On a cluster set the same value in spark.executor.extraJavaOptions.
JIT_OPTIONS = "-XX:-DontCompileHugeMethods"

# The dialect rules rely on these in every query: UTC so that timestamp_ntz <->
# timestamp conversions are identity, ANSI so that bad casts fail loudly unless
# a try_* form is used on purpose.
ANALYTIC_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}

# How plans run is the cluster's choice; the local session asks for runtime
# coalescing and skew-join splitting.
ADAPTIVE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def local_session(cores: int = 8, shuffle_partitions: int | None = None,
                  app: str = "tally") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cores))
        .config("spark.driver.memory", os.environ.get("TALLY_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.extraJavaOptions", JIT_OPTIONS)
        .config("spark.executor.extraJavaOptions", JIT_OPTIONS)
    )
    for k, v in (ANALYTIC_CONF | ADAPTIVE_CONF).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_analytic_conf(spark)
    return spark


def apply_analytic_conf(spark: SparkSession) -> None:
    """Pin the session settings the dialect rules rely on: time zone and ANSI casts."""
    for k, v in ANALYTIC_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, setting one only if unset.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used
    as is; this library writes below one folder of its own in it, which goes when
    the application ends (``release_work`` empties it before).  Only when nothing is configured and the master is local (tests) a
    fresh folder is created under the system temp dir; on a cluster a missing
    shared folder is an error, as executors would write to their own disks.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir():
        return _work_dir(spark)
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
    elif not re.match(r"local(\[[^-]*\])?$", sc.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    else:
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="tally-ckpt-"))
    return _work_dir(spark)


_work: dict[str, str] = {}


def hadoop_path(spark: SparkSession, path: str):
    """(Hadoop file system, Hadoop path) of ``path``: any store that Spark can write to."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), found


def _work_dir(spark: SparkSession) -> str:
    """The library's folder below the checkpoint folder.  The file system removes
    it when the driver's JVM ends."""
    sc = spark.sparkContext
    path = f"{sc.getCheckpointDir().rstrip('/')}/tally-work"
    if _work.get(sc.applicationId) != path:
        fs, found = hadoop_path(spark, path)
        fs.mkdirs(found)
        fs.deleteOnExit(found)
        _work[sc.applicationId] = path
    return path


def release_work(spark: SparkSession) -> int:
    """Delete every intermediate table this application has written so far, for
    long sessions; returns how many.  Frames that still read them cannot run
    again, so call it when their results have been written or collected."""
    fs, found = hadoop_path(spark, ensure_checkpoint_dir(spark))
    tables = fs.listStatus(found)
    for t in tables:
        fs.delete(t.getPath(), True)
    return len(tables)
