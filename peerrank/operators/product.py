"""Product mode: propagation inside each product, then a mean per user.

Per iteration, inside one (product, rating) group of rows:

    E(a) = rows with strictly lower h             (a's receivers)
    c(a) = h(a) / (E(a) * lam), or 0 when E(a) = 0   (signed)
    N(b) = sum of negative c(a) over rows a with h(a) > h(b)
    P(b) = sum of positive c(a) over rows a with h(a) > h(b)
    h'(b) = min(1, max(-1, h(b) + N(b)) + P(b))

The last line is the closed form of adding the contributions one at a
time in ascending donor order with a clamp to [-1, 1] after each addition:
negative donors come first, and within one sign repeated clamping equals
one final clamp.  Every row also receives a zero from itself, with donor h
equal to its own h; the lowest row's zero therefore comes first and clamps
the start value, which matters only for a value above 1 (top > all) - so
h is clamped before N is added.  Links are re-derived from the new h every
iteration.

Rows of one user in one product donate separately in the first iteration;
the update then merges them into one row holding the first row's rating
and h plus everything the rows received.

Plan: rows are hash-partitioned by product once and sorted inside the
partitions.  All iterations of the products of a batch then run in one pass
(``product_kernel``, Arrow batches that end with a product), without any exchange
or intermediate table; the only shuffle after loading is the final mean per user.
``product_contributions``, ``product_collapse`` and ``product_step`` are the same
iteration as window functions over (product, rating) ordered by the integer h;
``checkpoint_every`` runs on them, with a lineage cut every so many iterations.

Hot products (more than ``hot_rows`` reviews) would make one task of that
plan hold a whole product.  Their rows are dealt out by (product, rating) for the
first iteration, by (product, user) for the merge and by (product, rating) again
for all others, which a task runs on whole groups in one pass.  Groups of more than
``suffix.TARGET_BUCKET_ROWS`` rows go by levels: rows of one (product, rating, h)
receive the same, so after the first iteration they share their h for good.  Their
state is one row per level with its number of rows, E, N and P are sums over
levels, cut into value ranges by ``suffix.RangeLayout`` (built once, kept over the
iterations), and the rows learn their level's h by one join at the end.

A trace costs no shuffle of its own: rows (or levels) carry the h of every
iteration so far, and one shuffle by user averages all iterations.
"""

from __future__ import annotations

from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import dequantize, from_lanes, quantize, share_lanes
from ..session import cut_lineage, cut_lineage_keyed, discard, layout_partitions
from .helpfulness import exact_mean, exact_sum, joined_sum, rounded_quotient
from . import product_kernel, suffix
from .joins import join_small
from .suffix import RangeLayout, range_layout

# Tasks get the kernel itself: executors need not have this package.
cloudpickle.register_pickle_by_value(product_kernel)

# Products with more reviews than this are ranked on the skew-safe path.
HOT_PRODUCT_ROWS = 100_000
GROUP = ["product_id", "rating"]
ROWS = ["product_id", "user_id", "rating", "hq", "unix_time", "review_id"]


def _partitions(df: DataFrame, partitions: int | None) -> int:
    return layout_partitions(df.sparkSession, partitions)


def product_rows(reviews: DataFrame, partitions: int | None = None) -> DataFrame:
    """Rows of Product mode, hash-partitioned by product."""
    n = _partitions(reviews, partitions)
    return reviews.select("product_id", "user_id", "rating", "hq", "unix_time", "review_id").repartition(n, "product_id")


def product_contributions(rows: DataFrame, lam: float) -> DataFrame:
    """Adds ``e`` (receivers), ``c`` (share per receiver), ``n`` and ``p``
    (negative and positive sums received from rows with higher h) with their lanes."""
    # One sort per iteration: every frame below uses the same partitioning
    # and the same descending order, so they share a single Window pass.
    # Frames only grow from the top (UNBOUNDED PRECEDING), which Spark
    # evaluates incrementally, linear in the group size.
    w = Window.partitionBy("product_id", "rating").orderBy(F.col("hq").desc())
    at_or_above = F.count(F.lit(1)).over(w.rangeBetween(Window.unboundedPreceding, Window.currentRow))
    group_rows = F.count(F.lit(1)).over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    above = w.rangeBetween(Window.unboundedPreceding, -1)   # strictly higher h
    e = (group_rows - at_or_above).cast("long")
    with_c = rows.withColumn("e", e).withColumn("c", _share(lam))
    sums = {name: F.coalesce(F.sum(lane).over(above), F.lit(0)) for name, lane in _lanes().items()}
    summed = with_c.select("*", *[x.alias(name) for name, x in sums.items()])
    return _with_sums(summed)


def _share(lam: float) -> F.Column:
    return F.when(F.col("e") > 0, dequantize(F.col("hq")) / (F.col("e") * F.lit(float(lam)))).otherwise(F.lit(0.0))


def _lanes() -> dict[str, F.Column]:
    """Lanes of the negative and positive part of a row's share."""
    negative, positive = share_lanes(F.least(F.col("c"), F.lit(0.0))), share_lanes(F.greatest(F.col("c"), F.lit(0.0)))
    return {"n_hi": negative[0], "n_lo": negative[1], "p_hi": positive[0], "p_lo": positive[1]}


LANES = ["n_hi", "n_lo", "p_hi", "p_lo"]


def _with_sums(rows: DataFrame) -> DataFrame:
    return rows.withColumn("n", from_lanes(F.col("n_hi"), F.col("n_lo"))).withColumn("p", from_lanes(F.col("p_hi"), F.col("p_lo")))


def _clamp(x: F.Column) -> F.Column:
    return F.least(F.lit(1.0), F.greatest(F.lit(-1.0), x))


def _update(h: F.Column, n: F.Column, p: F.Column) -> F.Column:
    return F.least(F.lit(1.0), F.greatest(F.lit(-1.0), _clamp(h) + n) + p)


def _moved(n: F.Column, p: F.Column, h: F.Column) -> F.Column:
    return quantize(_update(dequantize(h), n, p))


def product_collapse(contrib: DataFrame, history: bool = False) -> DataFrame:
    """First iteration's update: one row per (product, user).

    The surviving rating and h are those of the first row by (unix_time,
    review_id, rating, h); contributions received by all rows are summed.
    Grouping keys include the product, so the hash layout by product
    already satisfies it: no exchange.  With ``history`` also the sum and
    number of the merged rows' h (``s0``, ``n0``) and the array ``hist``.
    """
    order = F.struct("unix_time", "review_id", "rating", "hq")
    first = F.min_by(F.struct("rating", "hq"), order)
    before = [exact_sum(F.col("hq")).alias("s0"), F.count(F.lit(1)).alias("n0")] if history else []
    agg = _with_sums(contrib.groupBy("product_id", "user_id").agg(
        first.alias("first"),
        *[F.sum(lane).alias(lane) for lane in LANES],
        *before,
    ))
    out = agg.select(
        "product_id",
        "user_id",
        F.col("first.rating").alias("rating"),
        _moved(F.col("n"), F.col("p"), F.col("first.hq")).alias("hq"),
        *(["s0", "n0"] if history else []),
    )
    return out.withColumn("hist", F.array("hq")) if history else out


def product_step(rows: DataFrame, lam: float) -> DataFrame:
    """Iterations after the first: one row per (product, user) already.  A
    ``hist`` column gets the new h appended."""
    c = product_contributions(rows, lam)
    kept = [x for x in ("s0", "n0", "hist") if x in rows.columns]
    out = c.select("product_id", "user_id", "rating", _moved(F.col("n"), F.col("p"), F.col("hq")).alias("hq"), *kept)
    return out.withColumn("hist", F.concat("hist", F.array("hq"))) if "hist" in kept else out


def split_hot_products(reviews: DataFrame, hot_rows: int | None) -> tuple[DataFrame, DataFrame | None]:
    """(reviews of ordinary products, reviews of hot products or None).

    Product sizes come from a map-side combined count; the hot list has at
    most (reviews / hot_rows) entries and is broadcast only after a count.
    """
    if not hot_rows:
        return reviews, None
    sizes = reviews.groupBy("product_id").agg(F.count(F.lit(1)).alias("_n"))
    hot = cut_lineage(sizes.filter(F.col("_n") > hot_rows).select("product_id"))
    if hot.isEmpty():            # one aggregate over the scan in the common case
        return reviews, None
    # joined and written once, read by both paths; rows without a product are ordinary
    marked = cut_lineage(join_small(reviews.select(*ROWS), hot.withColumn("_hot", F.lit(True)), ["product_id"], "left"))
    return marked.filter(F.col("_hot").isNull()).drop("_hot"), marked.filter("_hot").drop("_hot")


def level_contributions(levels: DataFrame, layout: RangeLayout, lam: float) -> DataFrame:
    """Adds ``e``, ``c``, ``n`` and ``p`` to levels (product_id, rating, hq, k
    rows): E counts rows on lower levels; N and P sum the shares of the rows on
    higher ones.  Levels of equal h count as one.  One shuffle by range."""
    counted = layout.above(layout.place(levels, "hq"), "hq", ["k"])
    e = (F.col("total_k") - F.col("upto_k")).cast("long")
    shared = counted.select(*levels.columns, "_b", e.alias("e")).withColumn("c", _share(lam))
    lanes = shared.select("*", *[(F.col("k") * lane).alias(name) for name, lane in _lanes().items()])
    summed = layout.above(lanes, "hq", LANES)
    return _with_sums(summed.select(*levels.columns, "e", "c", *[F.col(f"above_{x}").alias(x) for x in LANES]))


def _levels(rows: DataFrame, *columns) -> DataFrame:
    return rows.groupBy(*GROUP, *columns).agg(F.count(F.lit(1)).alias("k"))


def hot_contributions(rows: DataFrame, lam: float, partitions: int | None = None, layout: RangeLayout | None = None) -> DataFrame:
    """``product_contributions`` for rows of hot products, by levels."""
    levels = cut_lineage(_levels(rows, "hq"))
    layout = layout or range_layout(levels, GROUP, "hq", partitions)
    found = level_contributions(levels, layout, lam).select(*GROUP, "hq", "e", "c", "n", "p", *LANES)
    return rows.join(found, [*GROUP, "hq"])


WHOLE = ["n_hi", "n_lo", "p_hi", "p_lo", "s0_hi", "s0_lo", "n0"]


def _typed(df: DataFrame, *more: str) -> str:
    return ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields] + list(more))


def _first_received(rows: DataFrame, large: DataFrame | None, lam: float, n: int) -> DataFrame:
    """Rows of hot products with what they receive in the first iteration
    (``LANES``) and the sum and number of their h.  Groups that fit a task are
    dealt out whole, and a user's rows there become one; the ``large`` ones go by levels."""
    order = [*GROUP, "unix_time", "review_id", "hq"]
    whole = rows if large is None else join_small(rows, large, GROUP, "left_anti")
    dealt = whole.repartition(n, *GROUP).sortWithinPartitions(*order)
    out = dealt.mapInArrow(product_kernel.first_shares(lam), _typed(whole, *[f"{x} long" for x in WHOLE]))
    if large is None:
        return out
    spread = cut_lineage(join_small(rows, large, GROUP, "left_semi"))
    levels = cut_lineage(_levels(spread, "hq"))
    layout = range_layout(levels, GROUP, "hq", n)
    found = level_contributions(levels, layout, lam).select(*GROUP, "hq", *LANES)
    # rows of a very frequent level are one key of this join: AQE splits them
    start = [F.shiftright("hq", 32).alias("s0_hi"), F.col("hq").bitwiseAND(F.lit(0xFFFFFFFF)).alias("s0_lo"), F.lit(1).cast("long").alias("n0")]
    return out.unionByName(spread.join(found, [*GROUP, "hq"]).select(*rows.columns, *LANES, *start))


def _merged(received: DataFrame) -> DataFrame:
    """``product_collapse`` of rows that carry the sums of the rows they stand for."""
    order = F.struct("unix_time", "review_id", "rating", "hq")
    agg = _with_sums(received.groupBy("product_id", "user_id").agg(
        F.min_by(F.struct("rating", "hq"), order).alias("first"), *[F.sum(x).alias(x) for x in WHOLE],
    ))
    moved = _moved(F.col("n"), F.col("p"), F.col("first.hq")).alias("hq")
    return agg.select("product_id", "user_id", F.col("first.rating").alias("rating"), moved, "s0_hi", "s0_lo", "n0")


def _by_levels(rows: DataFrame, lam: float, iters: int, partitions: int, history: bool) -> DataFrame:
    """Later iterations of groups too large for a task; ``rows`` is a lineage cut."""
    state = _levels(rows, F.col("hq").alias("h1")).withColumn("hq", F.col("h1"))
    if history:
        state = state.withColumn("hist", F.array("hq"))
    state = cut_lineage(state)
    layout = range_layout(state, GROUP, "hq", partitions)
    for i in range(2, iters + 1):
        if layout.outgrown(state, "hq") if i % 4 == 0 else False:
            layout.discard()
            layout = range_layout(state, GROUP, "hq", partitions)
        before = state
        moved = level_contributions(state, layout, lam)
        kept = ["hist"] if history else []
        state = moved.select(*GROUP, "h1", "k", _moved(F.col("n"), F.col("p"), F.col("hq")).alias("hq"), *kept)
        if history:
            state = state.withColumn("hist", F.concat("hist", F.array("hq")))
        state = cut_lineage(state)
        discard(before)
    layout.discard()
    final = state.select(*GROUP, F.col("h1").alias("_h1"), F.col("hq").alias("_hq"), *([F.col("hist").alias("_hist")] if history else []))
    on = [rows[g] == final[g] for g in GROUP] + [rows["hq"] == final["_h1"]]
    return rows.join(final, on).select(
        rows["product_id"], "user_id", rows["rating"], F.col("_hq").alias("hq"), "s0_hi", "s0_lo", "n0",
        *([F.col("_hist").alias("hist")] if history else []),
    )


def hot_iterations(reviews: DataFrame, lam: float, iters: int, partitions: int | None = None, history: bool = False) -> DataFrame:
    """Rows of hot products after ``iters`` >= 1 iterations; ``reviews`` is a
    lineage cut.  Hot products are dealt out by (product, rating): groups of at
    most ``suffix.TARGET_BUCKET_ROWS`` rows are held whole by a task, which runs
    all iterations but the first in one pass; larger ones go by levels."""
    n = _partitions(reviews, partitions)
    rows = reviews.filter(F.col("rating").isNotNull())
    large = cut_lineage(rows.groupBy(*GROUP).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > suffix.TARGET_BUCKET_ROWS).select(*GROUP))
    if large.isEmpty():
        large = None
    # a user's rows in a product are as many as its ratings now (more only in large
    # groups, where the merge combines before the shuffle): dealt out without combining
    received = _first_received(rows, large, lam, n)
    merged = _merged(received.repartition(n, "product_id", "user_id") if large is None else received)
    if large is not None:
        merged = cut_lineage(merged)   # read by both ways
    whole = merged if large is None else join_small(merged, large, GROUP, "left_anti")
    if not history:
        whole = whole.drop("s0_hi", "s0_lo", "n0")
    dealt = whole.repartition(n, *GROUP).sortWithinPartitions(*GROUP)
    done = dealt.mapInArrow(product_kernel.later_iterations(lam, iters, history), _typed(whole, *(["hist array<long>"] if history else [])))
    if large is not None:
        spread = cut_lineage(join_small(merged, large, GROUP, "left_semi"))
        done = done.unionByName(_by_levels(spread, lam, iters, n, history).select(*done.columns))
    if not history:
        return done
    return done.select("product_id", "user_id", "rating", "hq", joined_sum(F.col("s0_hi"), F.col("s0_lo")).alias("s0"), "n0", "hist")


def user_mean_ranks(rows: DataFrame) -> DataFrame:
    return rows.groupBy("user_id").agg(exact_mean(F.col("hq")).alias("rank_q"))


def user_mean_traces(rows: DataFrame, iters: int) -> DataFrame:
    """(iter, user_id, rank_q) for all iterations, from rows with their history:
    one aggregation by user.  After an iteration h is at most 1e9 units in size,
    so one long holds the exact sum of up to nine milliards of rows."""
    sums = [F.sum(F.get("hist", F.lit(i))).cast("decimal(38,0)").alias(f"s{i + 1}") for i in range(iters)]
    per_user = rows.groupBy("user_id").agg(
        F.sum("s0").cast("decimal(38,0)").alias("s0"), F.sum("n0").alias("n0"), F.count(F.lit(1)).alias("n"), *sums,
    )
    means = [rounded_quotient(F.col("s0"), F.col("n0"))] + [rounded_quotient(F.col(f"s{i + 1}"), F.col("n")) for i in range(iters)]
    return per_user.select("user_id", F.posexplode(F.array(*means)).alias("iter", "rank_q")).select("iter", "user_id", "rank_q")


def _initial(reviews: DataFrame, history: bool) -> DataFrame:
    """Rows before any iteration, in the form of those after one."""
    rows = reviews.select("product_id", "user_id", "rating", "hq")
    if not history:
        return rows
    none = F.array().cast("array<bigint>")
    return rows.select("*", F.col("hq").cast("decimal(38,0)").alias("s0"), F.lit(1).cast("long").alias("n0"), none.alias("hist"))


def _in_one_pass(rows: DataFrame, lam: float, iters: int, history: bool) -> DataFrame:
    """Rows (hash-partitioned by product) after ``iters`` >= 1 iterations."""
    first = ["product_id", "unix_time", "review_id", "rating", "hq"]
    state = rows.select("product_id", "user_id", "rating", "hq")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in state.schema.fields)
    if history:
        schema += ", s0_hi long, s0_lo long, n0 long, hist array<long>"
    done = rows.sortWithinPartitions(*first).select(*state.columns).mapInArrow(product_kernel.iterations(lam, iters, history), schema)
    if not history:
        return done
    return done.select(*state.columns, joined_sum(F.col("s0_hi"), F.col("s0_lo")).alias("s0"), "n0", "hist")


def product_iterations(reviews: DataFrame, lam: float = 20, iters: int = 10, partitions: int | None = None,
                       checkpoint_every: int | None = None, hot_rows: int | None = HOT_PRODUCT_ROWS,
                       history: bool = False) -> DataFrame:
    """Runs the iterations and returns the final rows
    (product_id, user_id, rating, hq).

    All iterations run in one pass over the rows of a partition.  With
    ``checkpoint_every`` they are windows instead, lazy between lineage cuts:
    every so many iterations the rows are written to the shared checkpoint folder
    (bucketed by product).  With ``history`` the rows also have ``hist`` (h after
    every iteration), ``s0`` and ``n0`` (sum and number of the initial h of the
    rows they were merged from).
    """
    if lam <= 0:
        raise ValueError("lambda must be positive")
    if iters < 0:
        raise ValueError("iterations must be >= 0")
    if iters == 0:
        return _initial(reviews, history)
    n = _partitions(reviews, partitions)
    cold_reviews, hot_reviews = split_hot_products(reviews, hot_rows)
    rows, cut = product_rows(cold_reviews, n), None
    if checkpoint_every is None:
        rows = _in_one_pass(rows, lam, iters, history)
    for i in range(1, iters + 1) if checkpoint_every is not None else ():
        if i == 1:
            rows = product_collapse(product_contributions(rows, lam), history)
        else:
            rows = product_step(rows, lam)
        if i % max(1, checkpoint_every) == 0 and i < iters:
            rows = cut_lineage_keyed(rows, ["product_id"], n, prepartitioned=True)
            discard(cut)
            cut = rows
    if hot_reviews is None:
        return rows
    base = hot_reviews.select("product_id", "user_id", "rating", "hq", "unix_time", "review_id")
    return rows.unionByName(hot_iterations(base, lam, iters, partitions, history))


def product_rank(reviews: DataFrame, lam: float = 20, iters: int = 10, partitions: int | None = None,
                 checkpoint_every: int | None = None, trace: bool = False,
                 hot_rows: int | None = HOT_PRODUCT_ROWS) -> DataFrame:
    """Final ranks ``(user_id, rank_q, rank)``: each user's mean h over the
    products they reviewed.  ``trace=True`` gives the mean after every
    iteration ``(iter, user_id, rank_q, rank)``."""
    rows = product_iterations(reviews, lam, iters, partitions, checkpoint_every, hot_rows, history=trace)
    ranks = user_mean_traces(rows, iters) if trace else user_mean_ranks(rows)
    ranks = cut_lineage(ranks)    # one row per user (and iteration)
    return ranks.select(*ranks.columns, dequantize(F.col("rank_q")).alias("rank"))
