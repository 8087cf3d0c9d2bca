"""Relational shapes that the flows share."""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def asc(*columns: str) -> list[Column]:
    return [F.col(c).asc_nulls_last() for c in columns]


def stored(df: DataFrame, name: str) -> DataFrame:
    """df as a Parquet table in the folder of ``spark.checkpoint.dir``, so that costly columns that several branches read are made once."""
    spark = df.sparkSession
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tallyforge-"))
        folder = spark.sparkContext.getCheckpointDir()
    path = f"{folder.rstrip('/')}/tallyforge/{uuid.uuid4().hex}/{name}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def first_by(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row for each key that isn't null: the first by a total order. Never an arbitrary one."""
    filled = functools.reduce(lambda d, k: d.where(F.col(k).isNotNull()), keys, df)
    return filled.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_rn = 1").drop("_rn")


def top_by(df: DataFrame, keys: list[str], order: list[Column], k: int) -> DataFrame:
    """The first k rows of each key, with their rank."""
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= k)


def null_safe_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "full_outer") -> DataFrame:
    """Join in which null keys are equal; keys come once, with in_left and in_right."""
    a = left.select(*[F.col(k).alias(f"_l_{k}") for k in keys], *[c for c in left.columns if c not in keys], F.lit(True).alias("in_left"))
    b = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys], *[c for c in right.columns if c not in keys], F.lit(True).alias("in_right"))
    on = functools.reduce(lambda x, y: x & y, [F.col(f"_l_{k}").eqNullSafe(F.col(f"_r_{k}")) for k in keys])
    both = a.join(b, on, how)
    value = lambda k: F.when(F.col("in_left"), F.col(f"_l_{k}")).otherwise(F.col(f"_r_{k}")).alias(k)
    rest = [c for c in [*left.columns, *right.columns] if c not in keys]
    return both.select(*[value(k) for k in keys], *rest, F.coalesce("in_left", F.lit(False)).alias("in_left"), F.coalesce("in_right", F.lit(False)).alias("in_right"))


def semi(df: DataFrame, members: DataFrame, key: str) -> DataFrame:
    return df.join(members.select(key).distinct(), key, "left_semi")


def anti(df: DataFrame, members: DataFrame, key: str) -> DataFrame:
    return df.join(members.select(key).distinct(), key, "left_anti")


def first_met(items: DataFrame, item_id: str, met: DataFrame, price: str, offer_columns: list[str]) -> DataFrame:
    """Items with the offer of the first pass that brings a price, and the name of its key.

    met: item_id, pass, key_used, ordinal and the offer's columns, where a key of a pass has kept its first offer. Candidates
    without a price are dropped then, so that they block no later pass. The best one is aggregated before the shuffle by item.
    """
    row = F.struct("pass", F.coalesce("ordinal", F.lit(2**63 - 1)).alias("_at"), *offer_columns, "key_used")
    best = met.where(F.col(price).isNotNull()).groupBy(item_id).agg(F.min(row).alias("_b")).select(item_id, *[F.col(f"_b.{c}").alias(c) for c in ("key_used", *offer_columns)])
    return items.join(best, item_id, "left")


def forward_fill(df: DataFrame, keys: list[str], order: list[str], columns: list[str]) -> DataFrame:
    """Nulls take the last value before them within the key."""
    w = Window.partitionBy(*keys).orderBy(*asc(*order)).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumns({c: F.last(c, ignorenulls=True).over(w) for c in columns})


def islands(df: DataFrame, keys: list[str], order: list[str], value: str, gap: float, name: str = "island") -> DataFrame:
    """Rows numbered by runs in which value rises by no more than gap from row to row."""
    w = Window.partitionBy(*keys).orderBy(*asc(*order))
    jump = F.coalesce((F.col(value) - F.lag(value).over(w) > gap).cast("long"), F.lit(0))
    return df.withColumn("_jump", jump).withColumn(name, F.sum("_jump").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_jump")


def nearest(left: DataFrame, right: DataFrame, keys: list[str], a: str, b: str, within: float, tie: list[Column], apart: Column | None = None) -> DataFrame:
    """Each row of left with the row of right nearest in value, at most ``within`` away; only pairs for which ``apart`` holds.

    Values are cut into cells of width ``within``; a row meets its own and the two cells beside it, so no key emits all pairs.
    """
    cell = lambda c: F.floor(F.col(c) / within)
    near = left.withColumn("_id", F.monotonically_increasing_id()).withColumn("_cell", F.explode(F.array(cell(a) - 1, cell(a), cell(a) + 1)))
    met = near.join(right.withColumn("_cell", cell(b)), [*keys, "_cell"]).where(F.abs(F.col(a) - F.col(b)) <= within)
    met = met if apart is None else met.where(apart)
    return met.withColumn("_rn", F.row_number().over(Window.partitionBy("_id").orderBy(F.abs(F.col(a) - F.col(b)), *tie))).where("_rn = 1").drop("_rn", "_id", "_cell")


def bucketed(df: DataFrame, name: str, rules: list[tuple[str, Column]], default: str) -> DataFrame:
    """Each row in exactly one bucket: the first rule that holds (PK17, CL2)."""
    chosen = F
    for i, (bucket, rule) in enumerate(rules):
        chosen = (F if i == 0 else chosen).when(F.coalesce(rule, F.lit(False)), bucket)
    return df.withColumn(name, chosen.otherwise(default))


def conserved(before: DataFrame, parts: DataFrame, bucket: str) -> DataFrame:
    """Rows of each bucket and whether the buckets together have all rows."""
    counts = parts.groupBy(bucket).agg(F.count(F.lit(1)).alias("n"))
    totals = before.agg(F.count(F.lit(1)).alias("n_before")).crossJoin(parts.agg(F.count(F.lit(1)).alias("n_after")))
    return counts.crossJoin(F.broadcast(totals)).select(bucket, "n", (F.col("n_before") == F.col("n_after")).alias("conserved"))


def group_size(df: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Size of each row's group; rows with a null key have a null size. Groups are counted apart and joined back, so a hot key is pre-aggregated."""
    sizes = functools.reduce(lambda d, k: d.where(F.col(k).isNotNull()), keys, df).groupBy(*keys).agg(F.count(F.lit(1)).alias(name))
    return df.join(sizes, keys, "left")
