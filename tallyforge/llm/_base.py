"""Shared helpers of the training-data operators: expression building blocks, intermediate tables, file access."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: White space of the word definition: space and U+0009 to U+000D.
SPACE = r"[\x20\x09-\x0D]"
TRIMMED = " \t\n\x0b\x0c\r"
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with value computed once: an attribute used inside a lambda could be inlined into each of its calls."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def texts(docs: DataFrame, *more: str) -> DataFrame:
    """doc_id, text (null: empty) and the named columns; any other columns, whatever their names, are left out."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), *more)


def words(text: Column) -> Column:
    """Array of the words ``[^\\x20\\x09-\\x0D]+`` of a text that isn't null."""
    return let(F.btrim(text, F.lit(TRIMMED)), lambda t: F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(t, SPACE + "+", -1)))


def window_hashes(items: Column, size: int) -> Column:
    """Hashes of the windows of ``size`` consecutive items; ``items`` has to be a variable of ``let``. Shorter arrays have none."""
    hashed = lambda i: F.xxhash64(*[F.get(items, i + F.lit(k)) for k in range(size)])
    return F.when(F.size(items) >= size, F.transform(F.sequence(F.lit(0), F.size(items) - F.lit(size)), hashed)).otherwise(F.array().cast("array<bigint>"))


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share; sessions on one machine without one get their own."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tallyforge-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/tallyforge/{uuid.uuid4().hex}/{name}"


@contextlib.contextmanager
def shuffles_freed(spark: SparkSession):
    """Shuffle files of the queries run inside go as soon as each query ends; its written result replaces them."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a table in the shared folder: cuts lineage, survives lost executors, and has a known size for the planner."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    with shuffles_freed(spark):
        df.write.parquet(path)
    made.append(path)
    return spark.read.schema(df.schema).parquet(path)


#: Paths of the tables that ``written`` made and nothing has dropped yet, in order.
made: list[str] = []


@contextlib.contextmanager
def tidied(spark: SparkSession):
    """Yields a function that keeps a table; the other tables made inside are deleted at the end, so nothing may read them after."""
    before, kept = len(made), set()

    def keep(df: DataFrame) -> DataFrame:
        kept.update(made[before:][-1:])
        return df

    try:
        yield keep
    finally:
        own = made[before:]
        made[before:] = [path for path in own if path in kept]
        for path in set(own) - kept:
            _delete(spark, path)


def _delete(spark: SparkSession, path: str) -> None:
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    found.getFileSystem(spark._jsc.hadoopConfiguration()).delete(found, True)


def drop(df: DataFrame) -> None:
    """Deletes the files of a table made by ``written`` that nothing reads any more."""
    spark = df.sparkSession
    for parent in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        _delete(spark, parent)


def has(df: DataFrame) -> bool:
    return bool(df.take(1))


def empty(spark: SparkSession, schema: str | T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)

