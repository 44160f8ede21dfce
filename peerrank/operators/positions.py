"""Dense 1..n positions in a total order without a single-task window.

``row_number()`` over a window with no (or a low-cardinality) partition key
puts every row of a group into one task.  Here the rows are range-partitioned
on the order instead; each task numbers its own sorted slice, and a slice's
offset is the number of rows of the same group in earlier slices.  The
offset table has one row per (slice, group) pair.  It is broadcast if its
measured size allows it (many small groups make it as long as the groups are
many); otherwise it is joined by a shuffle, in which a slice's rows of one group
stay together and are no more than a slice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .joins import join_small

_LOCAL_BITS = 33   # monotonically_increasing_id = partition id << 33 | index


def positions(df: DataFrame, order: list[Column], group: str | None = None, partitions: int | None = None,
              name: str = "position") -> DataFrame:
    """Adds ``name`` = 1-based position of each row within ``group`` (or the
    whole frame) under ``order``, which must be a total order (add a unique
    tie-breaker).  The range-partitioned rows are written once."""
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = ([F.col(group).asc()] if group else []) + order
    # Materialised once: range boundaries come from sampling, and two
    # evaluations of the exchange may sample differently.
    sliced = cut_lineage(
        df.repartitionByRange(n, *keys)
        .sortWithinPartitions(*keys)
        .withColumn("_slice", F.spark_partition_id())
        .withColumn(
            "_local",
            F.monotonically_increasing_id() - F.shiftleft(F.col("_slice").cast("long"), _LOCAL_BITS),
        )
    )
    gcols = ["_slice"] + ([group] if group else [])
    # a slice may end one group and start the next: rebase the in-slice
    # index at the group's first row in the slice
    counts = sliced.groupBy(*gcols).agg(F.count(F.lit(1)).alias("_n"), F.min("_local").alias("_first"))
    w = (Window.partitionBy(group) if group else Window.partitionBy(F.lit(0))).orderBy("_slice")
    offsets = counts.withColumn(
        "_off", F.coalesce(F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ).drop("_n")
    out = join_small(sliced, offsets, gcols)
    pos = F.col("_off") + F.col("_local") - F.col("_first") + 1
    return out.withColumn(name, pos.cast("long")).drop("_slice", "_local", "_off", "_first")
