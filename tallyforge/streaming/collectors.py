"""Streaming counterparts of the polling collectors: extensions, the reference has no streams."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

STATE = "key string, attempts int, status string, answered_on timestamp, gtin string"


def last_scan_stream(scans: DataFrame) -> DataFrame:
    """Running last scan of each item; write it in update or complete mode."""
    last = scans.where("item_code is not null").groupBy("item_code").agg(F.max_by(F.struct("gtin", "nature", "scanned_at"), "scanned_at").alias("s"))
    return last.select("item_code", "s.*")


def recent(acks: DataFrame, months: int = 18, late: str = "1 day") -> DataFrame:
    """Acknowledgements younger than some months, each file once within the watermark."""
    young = acks.where(F.col("received_at") >= F.add_months(F.current_date(), -months))
    return young.withWatermark("received_at", late).dropDuplicatesWithinWatermark(["file"])


def merged_state(state: DataFrame, batch: DataFrame) -> DataFrame:
    """State after a batch of answers (key, status, answered_on, gtin): attempts add up, a found code stays, else the last answer counts (IO29 to IO32)."""
    w = Window.partitionBy("key").orderBy(F.col("answered_on").desc_nulls_last(), F.col("status"), F.col("gtin").desc_nulls_last())
    news = batch.groupBy("key").agg(F.count(F.lit(1)).cast("int").alias("_n"))
    last = batch.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").select("key", F.col("status").alias("_status"), F.col("answered_on").alias("_on"), F.col("gtin").alias("_gtin")).join(news, "key")
    both = state.join(last, "key", "full_outer")
    keep = F.coalesce(F.col("status") == "found", F.lit(False)) | F.col("_n").isNull()
    return both.select(
        "key",
        (F.coalesce("attempts", F.lit(0)) + F.coalesce("_n", F.lit(0))).cast("int").alias("attempts"),
        F.when(keep, F.col("status")).otherwise(F.col("_status")).alias("status"),
        F.when(keep, F.col("answered_on")).otherwise(F.col("_on")).alias("answered_on"),
        F.when(keep, F.col("gtin")).otherwise(F.col("_gtin")).alias("gtin"),
    )


def collector(spark: SparkSession, path: str) -> Callable[[DataFrame, int], None]:
    """foreachBatch sink that keeps the state in numbered tables under path; a repeated batch writes the same table again."""

    def upsert(batch: DataFrame, epoch: int) -> None:
        before = spark.read.schema(STATE).parquet(f"{path}/{epoch - 1}") if epoch > 0 else spark.createDataFrame([], STATE)
        merged_state(before, batch).write.mode("overwrite").parquet(f"{path}/{epoch}")

    return upsert


def progress(state: DataFrame) -> DataFrame:
    """Keys by status (progress drivers)."""
    return state.groupBy("status").agg(F.count(F.lit(1)).alias("n_keys"), F.sum("attempts").alias("n_attempts"))


def open_keys(wanted: DataFrame, state: DataFrame, most: int = 1) -> DataFrame:
    """Keys still to be asked: no code found and fewer attempts than allowed."""
    done = state.where((F.col("status") == "found") | (F.col("attempts") >= most))
    return wanted.select("key").distinct().join(done.select("key"), "key", "left_anti")
