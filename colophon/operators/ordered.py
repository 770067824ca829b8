"""Neighbours in the order of a whole table, without one task for all rows: ranges of the key, found by one pass of approximate percentiles, are windows of their own,
and the first row of each range (a row for each of at most ``RANGES``) is handed to the range before."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

RANGES = 64


def written(df: DataFrame, tag: str) -> DataFrame:
    """df as a Parquet table in the shared folder named in spark.checkpoint.dir, read back: what a document's scan gives is found once, however often the plan after it goes over these rows.
    A local master without such a folder gets a temporary one."""
    spark = df.sparkSession
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        option = spark.sparkContext._jsc.sc().getCheckpointDir()
        root = option.get() if option.isDefined() else None
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="colophon-")
        spark.sparkContext.setCheckpointDir(root)
    path = f"{root.rstrip('/')}/{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def in_ranges(df: DataFrame, key: str, ranges: int = RANGES) -> DataFrame:
    """df with the column range_n, which grows with the key."""
    points = [k / ranges for k in range(1, ranges)]
    bounds = df.agg(F.percentile_approx(key, points, 1000)).first()[0] or []
    return df.withColumn("range_n", F.size(F.filter(F.array(*(F.lit(b) for b in sorted(set(bounds)))), lambda b: b < F.col(key))) if bounds else F.lit(0))


def with_next(df: DataFrame, key: str, tie: str, fields: list[str]) -> DataFrame:
    """df with the column following: the fields of the row after, in the order of key and tie; null for the last."""
    d = in_ranges(df, key)
    row = F.struct(*fields)
    firsts = d.groupBy("range_n").agg(F.min_by(row, F.struct(key, tie)).alias("f"))
    after = firsts.select("range_n", F.lead("f").over(Window.orderBy("range_n")).alias("f"))  # at most RANGES rows
    order = Window.partitionBy("range_n").orderBy(key, tie)
    return d.withColumn("following", F.lead(row).over(order)).join(F.broadcast(after), "range_n").withColumn("following", F.coalesce("following", "f")).drop("f", "range_n")


def numbered(df: DataFrame, key: str, ties: list[str], which: str, to: str) -> DataFrame:
    """df with the column ``to``: of rows for which the condition holds, their number in the order of key and ties."""
    d = in_ranges(df, key).withColumn("w", F.expr(which).cast("int"))
    before = d.groupBy("range_n").agg(F.sum("w").alias("w")).withColumn("before", F.sum("w").over(Window.orderBy("range_n").rowsBetween(Window.unboundedPreceding, -1)))  # at most RANGES rows
    order = Window.partitionBy("range_n").orderBy(key, *ties).rowsBetween(Window.unboundedPreceding, 0)
    d = d.join(F.broadcast(before.select("range_n", F.coalesce("before", F.lit(0)).alias("before"))), "range_n")
    return d.withColumn(to, F.when(F.col("w") == 1, F.sum("w").over(order) + F.col("before"))).drop("w", "before", "range_n")
