"""Partition contents report: rows, skew, and the keys behind it."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage, layout_partitions
from .joins import join_small


def partition_report(df: DataFrame, key: str | None = None, partitions: int | None = None) -> DataFrame:
    """Rows and distinct keys per partition after hash-partitioning on
    ``key`` (or as the frame is), with each partition's share of all rows."""
    if key is not None:
        df = df.repartition(layout_partitions(df.sparkSession, partitions), key)
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    if key is not None:
        aggs.append(F.countDistinct(key).alias("n_keys"))
    per = df.groupBy(F.spark_partition_id().alias("partition")).agg(*aggs)
    # one row per partition: the total over this small table is bounded
    total = F.sum("n_rows").over(Window.partitionBy())
    return per.withColumn("share", F.col("n_rows") / total)


def heavy_keys(df: DataFrame, key: str, least_share: float = 0.001) -> DataFrame:
    """Every value of ``key`` that has at least ``least_share`` of all rows:
    ``(key, n_rows, share)``, exactly.

    A heavy-hitter sketch (``approx_top_k``) is aggregated map-side and merged,
    in place of a row per distinct key.  It keeps all values above its error of
    total / items tracked; only they are counted exactly, in a second scan.
    """
    if not 0 < least_share <= 1:
        raise ValueError("least_share must be above 0 and at most 1")
    top = math.ceil(1 / least_share)
    tracked = min(1 << math.ceil(math.log2(top * 16)), 1_000_000)
    name = F.col(key).cast("string")
    sketched = df.select(name.alias("k")).agg(
        F.count(F.lit(1)).alias("total"), F.expr(f"approx_top_k(k, {2 * top}, {tracked})").alias("items")
    )
    found = cut_lineage(sketched.select("total", F.explode("items").alias("i")).select("total", F.col("i.item").alias("k")))
    counted = join_small(df.select(name.alias("k")), found, ["k"]).groupBy("k", "total").agg(F.count(F.lit(1)).alias("n_rows"))
    share = F.col("n_rows") / F.col("total")
    return counted.filter(F.col("n_rows") >= F.ceil(F.col("total") * F.lit(least_share))).select(F.col("k").alias(key), "n_rows", share.alias("share"))
