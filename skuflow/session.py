"""Spark session defaults and the shared scratch location.

Everything in the library is a function from DataFrames to a DataFrame; the
only session-level concerns are the adaptive-execution settings the plans rely
on (runtime broadcast conversion, skew-join splitting, partition coalescing)
and the folder used to cut lineage.  That folder is always the one the cluster
names in ``spark.checkpoint.dir``; a temporary one serves only a session that
runs in one local JVM (tests, single-machine runs).
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

ADAPTIVE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def get_session(master: str | None = None, app_name: str = "skuflow",
                shuffle_partitions: int | None = None,
                extra_conf: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the adaptive settings the plans expect."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(ADAPTIVE_CONF)
    conf["spark.ui.enabled"] = "false"
    conf["spark.cleaner.referenceTracking.cleanCheckpoints"] = "true"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and written intermediate tables.

    Read from the session: ``spark.checkpoint.dir``, or the directory given to
    ``SparkContext.setCheckpointDir``.  A session that runs in one local JVM
    and names neither (tests, a laptop) gets a temporary folder; on a cluster
    that would put each executor's files on its own disk, so there a missing
    folder is an error.  No session setting is changed.
    """
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if conf_dir:
        if not context.getCheckpointDir():
            context.setCheckpointDir(conf_dir)
        return conf_dir
    if not context.getCheckpointDir():
        if not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
            raise RuntimeError(
                "spark.checkpoint.dir is not set: name a folder that the driver and all "
                "executors share, e.g. --conf spark.checkpoint.dir=hdfs:///tmp/skuflow")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="skuflow-checkpoint-"))
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder for a written table."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/skuflow-tables/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df: DataFrame, name: str, fmt: str = "parquet") -> DataFrame:
    """Write ``df`` to the shared folder and read it back, cutting lineage.

    Used between heavy stages that are read more than once, so that a lost
    executor costs one stage re-run and not the whole upstream plan.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").format(fmt).save(path)
    return spark.read.format(fmt).schema(df.schema).load(path)  # known: no job reads a footer
