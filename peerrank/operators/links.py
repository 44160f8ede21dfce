"""Endorsement links: who donates helpfulness to whom.

General: u -> v when both gave some product the same rating and v's mean
helpfulness is strictly lower than u's (distinct over products).
Product: row a -> row b inside one (product, rating) when b.h < a.h.

Pairs are built inside (product, rating) groups by an equi-join on the group
with the inequality as residual.  The pairs of one group are then the work of one
task, so a group of more than ``BLOCK_MEMBERS`` members is cut: its members are
placed in order of their value and dealt into blocks of that many; a cell joins
one block of donors with one block of receivers.  Receivers stand below their
donors, so only cells (i, j) with j <= i exist, and blocks of one single value
have no cell with blocks of that value.  Each cell has a bounded number of
pairs and is dealt out by itself, however large its group.

The link lists are exports: their size is the number of pairs, which is
what the caller asked for.  The rank computations do not need them in hot
groups (see operators.general / operators.product).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage, cut_lineage_keyed, discard, layout_partitions
from . import suffix
from .joins import broadcast_if_small, join_small
from .positions import positions

# Members of a group that are joined in one piece; a cell has at most the square of it as pairs.
BLOCK_MEMBERS = 4_000

GROUP = ["product_id", "rating"]

# Column of ``memberships`` (if ``means`` has it): a bit set for each of some groups of
# the user.  Pairs then say in ``maybe`` whether both ends have a bit in common.
BITS = "bits"


def memberships(distinct: DataFrame, means: DataFrame, partitions: int | None = None, by_group: bool = False) -> DataFrame:
    """(product_id, rating, user_id, H) once per user in a (product, rating),
    written in a hash layout by group: sizes and pairs of groups need no further
    exchange.  ``means`` may carry a ``uid`` column, which then is the user_id, and
    ``bits``.  ``by_group``: ``distinct`` lies in that layout already, and ``means``
    is a lineage cut; if it is small the rows stay where they are."""
    n = layout_partitions(distinct.sparkSession, partitions)
    user = F.col("uid") if "uid" in means.columns else F.col("user_id")
    values = means.withColumnRenamed("hq", "H")
    stays = False
    if by_group:
        small = broadcast_if_small(means)
        stays = small is not means
        values = small.withColumnRenamed("hq", "H")
    joined = distinct.drop("hq").join(F.broadcast(values) if stays else values, "user_id").select(
        *GROUP, user.alias("user_id"), "H", *_bits(means))
    return cut_lineage_keyed((joined if stays else joined.repartition(n, *GROUP)).dropDuplicates(), GROUP, n, prepartitioned=True)


def _bits(members: DataFrame) -> list[str]:
    return [BITS] if BITS in members.columns else []


def _below(a: DataFrame, b: DataFrame, on: list[str]) -> DataFrame:
    bits = _bits(a)
    a = a.select(*on, F.col("user_id").alias("src"), F.col("H").alias("_hs"), *[F.col(c).alias("_bs") for c in bits])
    b = b.select(*on, F.col("user_id").alias("dst"), F.col("H").alias("_hd"), *[F.col(c).alias("_bd") for c in bits])
    maybe = [(F.col("_bs").bitwiseAND(F.col("_bd")) != 0).alias("maybe") for _ in bits]
    return a.join(b, on).filter(F.col("_hd") < F.col("_hs")).select("src", "dst", *maybe)


def group_sizes(members: DataFrame) -> DataFrame:
    return members.groupBy(*GROUP).agg(F.count(F.lit(1)).alias("_n"))


def block_cells(members: DataFrame, block_members: int, partitions: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(members with their block ``_b``, cells (group, _i, _j)) of large groups."""
    n = layout_partitions(members.sparkSession, partitions)
    order = [F.col("H").asc(), F.col("user_id").asc()]
    # groups that fit a task are numbered where they lie (``memberships``), larger ones over many tasks
    huge = cut_lineage(group_sizes(members).filter(F.col("_n") > suffix.TARGET_BUCKET_ROWS).select(*GROUP))
    whole = huge.isEmpty()
    numbered = members if whole else join_small(members, huge, GROUP, "left_anti")
    placed = numbered.withColumn("_at", F.row_number().over(Window.partitionBy(*GROUP).orderBy(*order)))
    if not whole:
        spread = join_small(members, huge, GROUP, "left_semi").withColumn("_g", F.struct(*GROUP))
        placed = placed.unionByName(positions(spread, order, group="_g", partitions=n, name="_at").drop("_g"))
    block = F.floor((F.col("_at") - 1) / F.lit(block_members)).cast("long")
    placed = cut_lineage_keyed(placed.select(*GROUP, "user_id", "H", *_bits(members), block.alias("_b")), [*GROUP, "_b"], n)
    ends = placed.groupBy(*GROUP, "_b").agg(F.min("H").alias("_lo"), F.max("H").alias("_hi"))
    # a block of one value reaches the blocks before the first that starts with that value
    first = F.min("_b").over(Window.partitionBy(*GROUP, "_lo"))
    reach = F.when(F.col("_lo") < F.col("_hi"), F.col("_b")).otherwise(first - 1)
    cells = ends.withColumn("_reach", reach).filter("_reach >= 0").select(
        *GROUP, F.col("_b").alias("_i"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("_reach"))).alias("_j")
    )
    return placed, cells


def block_pairs(members: DataFrame, block_members: int = BLOCK_MEMBERS, partitions: int | None = None) -> DataFrame:
    """(src, dst) of every pair in the groups of ``members``, cell by cell."""
    n = layout_partitions(members.sparkSession, partitions)
    placed, cells = block_cells(members, block_members, n)
    on = [*GROUP, "_i", "_j"]
    donors = placed.withColumnRenamed("_b", "_i").join(cells, [*GROUP, "_i"]).repartition(n, *on)
    receivers = placed.withColumnRenamed("_b", "_j").join(cells, [*GROUP, "_j"]).repartition(n, *on)
    return _below(donors, receivers, on)


def pairs_within(members: DataFrame, partitions: int | None = None, block_members: int = BLOCK_MEMBERS) -> DataFrame:
    """(src, dst) of every pair of a group with the receiver's H strictly
    lower, repeated for each group the pair shares.  ``members`` (from
    ``memberships``, or any lineage cut) is read several times."""
    large = cut_lineage(group_sizes(members).filter(F.col("_n") > block_members).select(*GROUP))
    if large.isEmpty():
        return _below(members, members, GROUP)
    small = join_small(members, large, GROUP, "left_anti")
    pairs = block_pairs(join_small(members, large, GROUP, "left_semi"), block_members, partitions)
    return _below(small, small, GROUP).unionByName(pairs)


def distinct_pairs(pairs: DataFrame, partitions: int | None = None, by: str = "src") -> DataFrame:
    """Duplicates across groups removed once.  With ``partitions`` the pairs are
    hash-partitioned by ``by`` first, which the removal needs no more: the
    result comes out laid out by it in one shuffle."""
    return (pairs.repartition(partitions, by) if partitions else pairs).dropDuplicates()


def general_link_pairs(distinct: DataFrame, means: DataFrame, block_members: int = BLOCK_MEMBERS, once: bool = True) -> DataFrame:
    """All General links: distinct (src, dst) with src's mean strictly above
    dst's.  This is the link export; its size is the number of links.  The
    rank computation does not list pairs of heavy groups (general_hot).
    ``once=False`` repeats a link for each group the pair shares, for a
    receiver that removes repeats in a shuffle of its own.
    """
    pairs = pairs_within(memberships(distinct, means), block_members=block_members)
    return distinct_pairs(pairs, layout_partitions(distinct.sparkSession)) if once else pairs


def product_link_pairs(rows: DataFrame, block_members: int = BLOCK_MEMBERS, once: bool = True) -> DataFrame:
    """Distinct (src, dst) users over row pairs of one (product, rating)
    with strictly lower h on the receiving row.  Two rows of one user in a
    product are different rows, so such a user can link to itself.
    ``once`` as for ``general_link_pairs``."""
    n = layout_partitions(rows.sparkSession)
    members = rows.select(*GROUP, "user_id", F.col("hq").alias("H")).repartition(n, *GROUP)
    pairs = pairs_within(cut_lineage_keyed(members, GROUP, n, prepartitioned=True), n, block_members)
    return distinct_pairs(pairs, n) if once else pairs


def product_links_after(reviews: DataFrame, lam: float, iters: int, partitions: int | None = None) -> DataFrame:
    """Product links in the state after ``iters`` iterations (links are
    re-derived from h every iteration; 0 = the loaded rows)."""
    from .product import product_iterations   # product imports this module

    return product_link_pairs(product_iterations(reviews, lam, iters, partitions))


def general_links(reviews: DataFrame, block_members: int = BLOCK_MEMBERS, once: bool = True) -> DataFrame:
    """All General links (src, dst) of a review table (``once`` as for ``general_link_pairs``)."""
    from .helpfulness import distinct_reviews, user_means

    d = cut_lineage(distinct_reviews(reviews))   # read by the means and the memberships
    try:
        return general_link_pairs(d, user_means(d).select("user_id", "hq"), block_members, once)
    finally:
        discard(d)   # the memberships are written
