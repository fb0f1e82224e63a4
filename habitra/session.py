"""Session settings that the operators expect."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def session(app: str = "habitra", master: str | None = None, **conf: str) -> SparkSession:
    """A session in UTC with adaptive execution; ``conf`` overrides, with ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.sql.parquet.filterPushdown": "true",
    }
    for k, v in (settings | {k.replace("__", "."): v for k, v in conf.items()}).items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


def shared(spark: SparkSession) -> str:
    """The folder of intermediate tables, which all executors share (``spark.checkpoint.dir``)."""
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", "")
    if not named and sc.master.split("[")[0] != "local":
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return named or "/tmp/checkpoints"


def cut(df: DataFrame) -> DataFrame:
    """``df`` from files in the shared folder (``spark.checkpoint.dir``), for small results that a plan reads several times."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared(df.sparkSession))
    return df.checkpoint()


#: Up to this many rows of a table, counted, go to all executors.
SMALL_ROWS = 10_000


def small(df: DataFrame) -> DataFrame:
    """``df`` reckoned now, to be read several times and broadcast in joins; one that turns out to have more than ``SMALL_ROWS`` rows is ``cut`` instead."""
    rows = df.limit(SMALL_ROWS + 1).toArrow()
    return F.broadcast(df.sparkSession.createDataFrame(rows, df.schema)) if rows.num_rows <= SMALL_ROWS else cut(df)


def stored(df: DataFrame) -> DataFrame:
    """``df`` from Parquet files in the shared folder, for large results that a plan reads several times: reckoned once, so that all readers see the same floats, and read by column."""
    path = f"{shared(df.sparkSession).rstrip('/')}/stored-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
