"""Session settings the jobs are written for, and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# AQE coalesces small shuffle partitions, splits skewed join sides and turns a
# shuffled join into a broadcast one when the measured side is small enough; no
# operator here forces a broadcast.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.ansi.enabled": "true",
}


def build_session(app_name: str = "gapweave", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for name, value in {**RECOMMENDED_CONF, **conf}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``, or the context's checkpoint folder.

    Where neither is set, a local session is given a temporary folder of its own, once; any
    other is refused, as its executors could not see that folder.
    """
    context = spark.sparkContext
    known = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if known:
        return known.rstrip("/")
    if not re.fullmatch(r"local(\[[^]]*\])?", context.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="gapweave-"))
    return context.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the folder that driver and executors share."""
    return f"{shared_folder(spark)}/gapweave-{name}-{uuid.uuid4().hex}"


def kept(df: DataFrame, name: str) -> DataFrame:
    """``df`` computed once and kept as Parquet in the shared folder, so that Spark knows its size when it plans a join."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def require_ntz(df: DataFrame, *names: str) -> None:
    """Refuse zoned timestamps: their wall time would depend on the session zone."""
    for name in names:
        kind = df.schema[name].dataType
        if not isinstance(kind, T.TimestampNTZType):
            raise TypeError(f"column {name!r} must be timestamp_ntz, not {kind.simpleString()}")
