"""Per-review and per-user helpfulness (distinct reviews, user means)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import dequantize


def exact_sum(value: Column) -> Column:
    """Sum of a long column as decimal(38,0), whatever the order of the rows.

    The upper and lower halves are summed as longs apart: exact, without
    overflow for up to 2**31 rows of any value, and about as fast as one sum.
    """
    return joined_sum(F.sum(F.shiftright(value, 32)), F.sum(value.bitwiseAND(F.lit(0xFFFFFFFF))))


def joined_sum(upper: Column, lower: Column) -> Column:
    """The sum whose upper and lower halves were summed apart."""
    return upper.cast("decimal(28,0)") * F.lit(1 << 32).cast("decimal(10,0)") + lower.cast("decimal(20,0)")


def rounded_quotient(total: Column, n: Column) -> Column:
    """total / n to the nearest integer (halves away from zero), divided once
    and exactly.  Null when n is 0."""
    twice = F.abs(total) * 2 + n.cast("decimal(20,0)")
    size = F.call_function("div", twice, n.cast("decimal(20,0)") * 2).cast("long")
    return F.when(n > 0, F.when(total < 0, -size).otherwise(size))


def exact_mean(value: Column) -> Column:
    """Mean of a long column (nulls left out), rounded once from the exact sum."""
    return rounded_quotient(exact_sum(value), F.count(value))


def review_helpfulness(reviews: DataFrame) -> DataFrame:
    """One row per review with its helpfulness as a double."""
    return reviews.select(
        "review_id", "product_id", "user_id", "rating", "top", "votes",
        dequantize(F.col("hq")).alias("h"),
    )


def distinct_reviews(reviews: DataFrame) -> DataFrame:
    """General mode's review set: duplicates of (user, product, rating, h)
    collapse; row id and time are not part of the key."""
    return reviews.select("user_id", "product_id", "rating", "hq").dropDuplicates()


def user_means(distinct: DataFrame, *more: Column) -> DataFrame:
    """Initial helpfulness of each user: mean of the user's distinct reviews.

    Computed exactly on the integer 1e-9 values and rounded back to that grid,
    so the strict comparisons that build links see no floating-point noise and
    no order of rows.  Partial aggregation runs map-side; a hot user costs one
    row per task.  ``more``: further aggregates of a user's rows.
    """
    return distinct.groupBy("user_id").agg(
        exact_mean(F.col("hq")).alias("hq"),
        F.count(F.lit(1)).alias("n_reviews"),
        *more,
    )


def product_summary(reviews: DataFrame) -> DataFrame:
    """Per product: reviews, distinct users, mean review helpfulness."""
    return reviews.groupBy("product_id").agg(
        F.count(F.lit(1)).alias("n_reviews"),
        F.countDistinct("user_id").alias("n_users"),
        exact_mean(F.col("hq")).alias("mean_hq"),
    )
