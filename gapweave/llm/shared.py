"""Tables and raw files in the folder that driver and executors share."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from gapweave.session import scratch_path

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def on_workers(spark: SparkSession) -> None:
    """Let Python workers of a local session import this package; a cluster is given it with --py-files."""
    environment = spark.sparkContext.environment
    known = environment.get("PYTHONPATH", "")
    if ROOT not in known.split(os.pathsep):
        environment["PYTHONPATH"] = os.pathsep.join(x for x in (ROOT, known) if x)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` computed once, as a Parquet table in the shared folder; this cuts the lineage."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def folder(uri: str):
    """The file system of a folder named as Spark names it, and the path in it."""
    from pyarrow import fs

    system, path = fs.FileSystem.from_uri(uri)
    return system, path


@contextmanager
def whole_file(uri: str, name: str):
    """A file that appears under its name only when it is complete: a task may be run again."""
    system, path = folder(uri)
    system.create_dir(path, recursive=True)
    draft = f"{path}/.{name}.{uuid.uuid4().hex}"
    with system.open_output_stream(draft) as out:
        yield out
    system.move(draft, f"{path}/{name}")


def read_file(uri: str, name: str) -> bytes:
    system, path = folder(uri)
    with system.open_input_stream(f"{path}/{name}") as f:
        return f.read()


@contextmanager
def open_file(uri: str, name: str) -> Iterator:
    system, path = folder(uri)
    with system.open_input_file(f"{path}/{name}") as f:
        yield f
