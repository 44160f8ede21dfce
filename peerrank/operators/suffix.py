"""Sums over higher values inside a key, without single-task groups.

A window ``PARTITION BY keys ORDER BY order`` gives, for every row, sums over
the rows of its key with a higher ``order``, but processes a whole key in one
task; when one key holds a large share of all rows that task is the job.

Here a key is cut into value ranges ("buckets") at approximate quantiles of
``order`` (``percentile_approx``, a mergeable sketch aggregated map-side).  A
row's sum is the total of the higher buckets (a small table, one row per key
and bucket) plus a window inside its own bucket.  Rows are dealt out by
(key, bucket), so a hot key is spread over many tasks.

The bounds are a ``RangeLayout``: built once and used for as many calls as
wanted, also after values have moved (a row's bucket follows its new value;
the bounds only decide how even the buckets are, never the result).

Equal values always share a bucket.  Aggregate rows of one value first if a
value may be very frequent.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage, discard, layout_partitions
from .joins import BROADCAST_MAX_BYTES, memory_bytes

# Rows a bucket is meant to hold.
TARGET_BUCKET_ROWS = 200_000


def _bucket_of(bounds: Column, value: Column, most: int) -> Column:
    """Number of bounds strictly below ``value`` by binary search over the
    sorted bound array (log2 steps, constant memory); 0 without bounds."""
    steps = [1 << i for i in range(max(1, most.bit_length()) - 1, -1, -1)]
    found = F.aggregate(
        F.array(*[F.lit(s) for s in steps]),
        F.lit(0),
        lambda acc, step: F.when(
            (acc + step <= F.size(bounds)) & (F.element_at(bounds, acc + step) < value), acc + step
        ).otherwise(acc),
    )
    return F.when(bounds.isNull(), F.lit(0)).otherwise(found)


@dataclass
class RangeLayout:
    keys: list[str]
    bounds: DataFrame | None   # keys, _bounds: only keys of more than one bucket
    buckets: int               # of the largest key
    total: int                 # buckets over all keys that have bounds, at most
    plain: int                 # keys without bounds
    partitions: int
    target_rows: int
    small_bounds: bool = False

    def place(self, rows: DataFrame, order: str) -> DataFrame:
        """``rows`` dealt out by key and bucket (``_b``): one shuffle."""
        if self.bounds is None:
            with_b = rows.withColumn("_b", F.lit(0))
        else:
            bounds = F.broadcast(self.bounds) if self.small_bounds else self.bounds
            with_b = rows.join(bounds, self.keys, "left").withColumn(
                "_b", _bucket_of(F.col("_bounds"), F.col(order), self.buckets)
            ).drop("_bounds")
        return with_b.repartition(self.partitions, *self.keys, "_b")

    def above(self, placed: DataFrame, order: str, cols: list[str]) -> DataFrame:
        """Adds for every ``c`` of ``cols``: ``above_<c>`` (sum over strictly
        higher ``order`` in the key), ``upto_<c>`` (over equal or higher) and
        ``total_<c>`` (over the key).  ``placed`` comes from ``place``, with any
        columns added since; it is not shuffled again."""
        w = Window.partitionBy(*self.keys, "_b").orderBy(F.col(order).desc())
        strict = w.rangeBetween(Window.unboundedPreceding, -1)
        upto = w.rangeBetween(Window.unboundedPreceding, Window.currentRow)
        whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        own = placed.columns
        lo = [F.coalesce(F.sum(c).over(strict), F.lit(0)) for c in cols]
        to = [F.sum(c).over(upto) for c in cols]
        if self.bounds is None:   # every key is one bucket
            names = [f"{p}_{c}" for p in ("above", "upto", "total") for c in cols]
            sums = lo + to + [F.sum(c).over(whole) for c in cols]
            return placed.select(*own, *[x.alias(n) for x, n in zip(sums, names)])
        per_bucket = placed.groupBy(*self.keys, "_b").agg(*[F.sum(c).alias(f"_bs_{c}") for c in cols])
        down = Window.partitionBy(*self.keys).orderBy(F.col("_b").desc()).rowsBetween(Window.unboundedPreceding, -1)
        higher = per_bucket.select(
            *self.keys, "_b",
            *[F.coalesce(F.sum(f"_bs_{c}").over(down), F.lit(0)).alias(f"_hi_{c}") for c in cols],
            *[F.sum(f"_bs_{c}").over(Window.partitionBy(*self.keys)).alias(f"_all_{c}") for c in cols],
        )
        local = placed.select(*own, *[x.alias(f"_lo_{c}") for x, c in zip(lo, cols)], *[x.alias(f"_to_{c}") for x, c in zip(to, cols)])
        # the number of buckets is known since the layout was built; keys without bounds have one each
        small = (self.total + self.plain) * (64 + 32 * len(cols)) <= BROADCAST_MAX_BYTES
        out = local.join(F.broadcast(higher) if small else higher, [*self.keys, "_b"])
        return out.select(
            *own,
            *[(F.col(f"_hi_{c}") + F.col(f"_lo_{c}")).alias(f"above_{c}") for c in cols],
            *[(F.col(f"_hi_{c}") + F.col(f"_to_{c}")).alias(f"upto_{c}") for c in cols],
            *[F.col(f"_all_{c}").alias(f"total_{c}") for c in cols],
        )

    def outgrown(self, rows: DataFrame, order: str, factor: int = 4) -> bool:
        """Whether values have drifted so that a bucket holds more than
        ``factor`` times what it is meant to."""
        counts = self.place(rows, order).groupBy(*self.keys, "_b").count()
        return (counts.agg(F.max("count")).first()[0] or 0) > factor * self.target_rows

    def discard(self) -> None:
        discard(self.bounds)


def range_layout(rows: DataFrame, keys: list[str], order: str, partitions: int | None = None,
                 target_rows: int | None = None) -> RangeLayout:
    """Bounds for ``rows`` (read twice: cut its lineage before).  Only keys
    with more than ``target_rows`` rows get bounds, each as many as it needs."""
    n = layout_partitions(rows.sparkSession, partitions)
    target_rows = target_rows or TARGET_BUCKET_ROWS
    sizes = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    need = F.ceil(F.col("_n") / F.lit(target_rows))
    large = F.col("_n") > target_rows
    most, total, plain = sizes.agg(
        F.max(F.when(large, need)), F.sum(F.when(large, need)), F.count_if(~large)
    ).first()
    if not most:
        return RangeLayout(keys, None, 1, 0, plain or 0, n, target_rows)
    big = sizes.filter(F.col("_n") > target_rows).select(*keys, need.cast("int").alias("_need"))
    # one grid for all keys; a key takes every (most / its need)-th bound
    grid = 1 << math.ceil(math.log2(most))
    sketch = rows.join(big, keys, "left_semi").groupBy(*keys).agg(
        F.percentile_approx(order, [i / grid for i in range(1, grid)], max(10_000, 20 * grid)).alias("_q")
    )
    step = F.greatest(F.floor(F.lit(grid) / F.col("_need")), F.lit(1))
    own = F.filter("_q", lambda q, i: (i + 1) % step == 0)
    bounds = cut_lineage(sketch.join(big, keys).select(*keys, F.array_sort(F.array_distinct(own)).alias("_bounds")))
    # floor(grid / need) may leave up to twice the buckets needed
    return RangeLayout(keys, bounds, grid, 2 * int(total), int(plain), n, target_rows, memory_bytes(bounds) <= BROADCAST_MAX_BYTES)


def strict_above(levels: DataFrame, keys: list[str], order: str, cols: list[str], partitions: int | None = None,
                 target_rows: int | None = None) -> DataFrame:
    """``above_<c>`` and ``total_<c>`` of every row, with a layout of its own."""
    layout = range_layout(levels, keys, order, partitions, target_rows)
    out = layout.above(layout.place(levels, order), order, cols)
    return out.drop("_b", *[f"upto_{c}" for c in cols])
