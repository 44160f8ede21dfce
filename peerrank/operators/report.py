"""Reports over rank tables: leaderboard, top users, trajectories, colour
bands, user lookup and the graph export (nodes and links with ranks)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import band_colour, capitalised_key, leaderboard_label, node_size, rank_band
from ..session import cut_lineage
from .joins import broadcast_if_small
from .positions import positions

# Rows one task may hold for a top-k.
TOP_IN_ONE_TASK = 100_000


def leaderboard(trace: DataFrame, partitions: int | None = None) -> DataFrame:
    """Per iteration, users by rank descending (ties by user id):
    ``(iter, position, user_id, rank_q, rank, label)``."""
    ranked = positions(
        trace.select("iter", "user_id", "rank_q", "rank"),
        [F.col("rank_q").desc(), F.col("user_id").asc()],
        group="iter",
        partitions=partitions,
    )
    return ranked.select(
        "iter", "position", "user_id", "rank_q", "rank",
        leaderboard_label(F.col("position"), F.col("user_id"), F.col("rank")).alias("label"),
    )


def top_users(ranks: DataFrame, k: int = 10) -> DataFrame:
    """The k best users with their position.  Up to ``TOP_IN_ONE_TASK`` users
    are picked by a top-k sort (each task keeps k rows, one merges them); more
    by the positions of all, and then no task gathers the k rows."""
    order = [F.col("rank_q").desc(), F.col("user_id").asc()]
    if k > TOP_IN_ONE_TASK:
        return positions(ranks, order).filter(F.col("position") <= k)
    best = ranks.orderBy(*order).limit(k)
    return best.withColumn("position", F.row_number().over(Window.orderBy(*order)).cast("long"))


def rank_trajectory(board: DataFrame, iters: int) -> DataFrame:
    """One row per user with the position at each iteration
    (``pos_0`` .. ``pos_{iters}``); a user missing at an iteration gets null.
    Iterations above ``iters`` fail the job instead of being left out."""
    known = F.when(F.col("iter") <= iters, F.col("iter")).otherwise(
        F.raise_error(F.format_string("iteration %d is above the %d asked for", F.col("iter"), F.lit(iters))).cast("int")
    )
    return (
        board.withColumn("iter", known).groupBy("user_id")
        .pivot("iter", list(range(iters + 1)))
        .agg(F.first("position"))
        .select("user_id", *[F.col(str(i)).cast("long").alias(f"pos_{i}") for i in range(iters + 1)])
    )


def rank_bands(ranks: DataFrame) -> DataFrame:
    band = rank_band(F.col("rank"))
    return ranks.select("user_id", "rank_q", "rank", band.alias("band"), band_colour(band).alias("colour"))


def band_histogram(ranks: DataFrame) -> DataFrame:
    return rank_bands(ranks).groupBy("band", "colour").agg(F.count(F.lit(1)).alias("n_users"))


def user_lookup(ranks: DataFrame, keys: DataFrame, key_col: str = "key") -> DataFrame:
    """Users found by search keys, normalised as the demo does."""
    k = keys.select(F.col(key_col).alias("key"), capitalised_key(F.col(key_col)).alias("user_id"))
    return k.join(ranks, "user_id").select("key", "user_id", "rank_q", "rank")


def graph_nodes(ranks: DataFrame) -> DataFrame:
    band = rank_band(F.col("rank"))
    return ranks.select(
        F.col("user_id").alias("id"), "rank_q", "rank",
        band.alias("band"), band_colour(band).alias("colour"),
        node_size(F.col("rank")).alias("node_size"),
    )


def graph_links(links: DataFrame, ranks: DataFrame) -> DataFrame:
    """Links with the rank of both ends (two joins on user id).  Ranks are
    broadcast if measured small; else a partition's ranks are a hash table, and
    its links need no sort (nor a shuffle for the first, if laid out by source)."""
    held = cut_lineage(ranks.select("user_id", "rank"))
    small = broadcast_if_small(held) is not held

    def named(end: str, rank: str) -> DataFrame:
        return held.select(F.col("user_id").alias(end), F.col("rank").alias(rank)).hint("broadcast" if small else "shuffle_hash")

    return (
        links.join(named("src", "source_rank"), "src").join(named("dst", "target_rank"), "dst")
        .select(F.col("src").alias("source"), F.col("dst").alias("target"), "source_rank", "target_rank")
    )
