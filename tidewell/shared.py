"""The folder that the driver and all executors share."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir. Where that is unset, a folder of this machine in local mode (tests), else an error."""
    own = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not own:
        if not re.fullmatch(r"local(\[[^,\]]*(,[^\]]*)?\])?", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir is unset: name a folder that the driver and all executors share")
        own = "file://" + tempfile.mkdtemp(prefix="tidewell-")
        spark.conf.set("spark.checkpoint.dir", own)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(own)
    return own


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def pinned(df: DataFrame) -> DataFrame:
    """The rows written to the shared checkpoint folder, so that a lost executor costs no recomputation."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def table(df: DataFrame) -> DataFrame:
    """The rows written as a Parquet table in the shared folder, so that a lost executor costs no recomputation.

    For loops: a checkpoint keeps its plan's size estimate, which multiplies in each join and after some rounds of joins is
    a number of millions of digits; a table has the size of its files.
    """
    path = scratch(df.sparkSession, "table")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
