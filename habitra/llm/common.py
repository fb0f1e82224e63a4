"""What the operators share: tables in the shared folder, Arrow map functions, text columns."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Used only where the session names no shared folder and all runs in one process, as in local tests.
LOCAL_SHARED = "/tmp/checkpoints"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``; a cluster must name one."""
    named = spark.conf.get("spark.checkpoint.dir", "")
    if not named and not spark.sparkContext.master.split("[")[0] == "local":
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return (named or LOCAL_SHARED).rstrip("/")


#: Lists of the tables that the open ``scratch`` blocks of this thread have written, innermost last.
_scratch: ContextVar[tuple[list[str], ...]] = ContextVar("scratch", default=())


def materialise(df: DataFrame, name: str, compression: str = "zstd", stays: bool = False) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: later stages start from files that outlive executors.

    Within ``scratch`` the table goes when that ends, unless it ``stays``.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/habitra/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", compression).parquet(path)
    if _scratch.get() and not stays:
        _scratch.get()[-1].append(path)
    return spark.read.schema(df.schema).parquet(path)


def input_bytes(df: DataFrame) -> int:
    """The planner's estimate of a table's size, from its files; for plans that give the same result at any size."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables written within are removed at the end; what is kept must be written itself, to stay."""
    paths: list[str] = []
    token = _scratch.set((*_scratch.get(), paths))
    try:
        yield
    finally:
        _scratch.reset(token)
        hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
        for path in paths:
            p = hadoop.Path(path)
            p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


@contextmanager
def setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """A setting of the session for the plans made within."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(df: DataFrame, id_col: str, text_col: str, *more: Column) -> DataFrame:
    """Only the id (long) and the text, a null text as the empty one; other columns of ``df`` can't clash."""
    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"), *more)


def release() -> None:
    """Give freed memory back: idle workers stay beside the next stage's."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # not glibc
        pass


#: Rows that JVM and Python hand each other at a time.
BATCH_ROWS = 1000


def small_batches(spark: SparkSession) -> None:
    """Bound the session's Arrow batches from here on: each is held whole on both sides, and documents are long rows."""
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def map_batches(df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], dict[str, list] | None]], schema: str | T.StructType, rows: int = 1000) -> DataFrame:
    """``df`` through a function of Arrow batches of at most ``rows`` rows; ``make`` runs once in each task and returns the function."""
    kind = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(kind, prefers_large_types=False)
    small_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = make()
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                cols = f(batch.slice(at, rows))
                if cols is not None:
                    yield pa.RecordBatch.from_arrays([pa.array(cols[x.name], type=x.type) if not isinstance(cols[x.name], pa.Array) else cols[x.name].cast(x.type) for x in arrow], schema=arrow)
            batch = None
        del f
        release()

    return df.mapInArrow(run, kind)


def strings(batch: pa.RecordBatch, name: str) -> list[str]:
    return [x or "" for x in batch.column(name).to_pylist()]
