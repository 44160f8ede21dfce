"""Invariants of both modes on the sf0.001 tables."""

import random

import pytest
from pyspark.sql import functions as F

from peerrank.operators.general import general_rank
from peerrank.operators.product import product_rank
from peerrank.sources.reviews import reviews_from_tables
from samples import SF_SMALL


@pytest.fixture(scope="module")
def small(spark):
    return reviews_from_tables(spark, SF_SMALL).cache()


def test_general_ranks_never_fall_and_stay_at_most_one(small):
    t = general_rank(small, 20, 4, trace=True)
    rows = {(r.iter, r.user_id): r.rank_q for r in t.collect()}
    users = {u for _, u in rows}
    for u in users:
        seq = [rows[(i, u)] for i in range(5)]
        assert all(b >= a or b == 1_000_000_000 for a, b in zip(seq, seq[1:])), (u, seq)
        assert all(v <= 1_000_000_000 for v in seq[1:])


def test_product_ranks_within_bounds(small):
    r = product_rank(small, 20, 4)
    assert r.filter((F.col("rank") > 1) | (F.col("rank") < -1)).count() == 0


@pytest.mark.parametrize("mode", [general_rank, product_rank])
def test_every_user_once(small, mode):
    users = small.select("user_id").distinct().count()
    r = mode(small, 20, 2)
    assert r.count() == users == r.select("user_id").distinct().count()


@pytest.mark.parametrize("mode", [general_rank, product_rank])
def test_partition_count_does_not_change_results(small, mode):
    a = {x.user_id: x.rank_q for x in mode(small, 20, 3, partitions=3).collect()}
    b = {x.user_id: x.rank_q for x in mode(small, 20, 3, partitions=11).collect()}
    assert a == b


def test_row_order_does_not_change_results(small):
    shuffled = small.orderBy(F.rand(7))
    for mode in (general_rank, product_rank):
        a = {x.user_id: x.rank_q for x in mode(small, 20, 2).collect()}
        b = {x.user_id: x.rank_q for x in mode(shuffled, 20, 2).collect()}
        assert a == b


def test_product_iterations_in_one_pass_equal_the_windows(spark):
    """Whole products cut out of Arrow batches: nulls, repeated rows, h above 1."""
    from peerrank.operators.product import product_iterations

    rnd = random.Random(7)
    pick = lambda values: rnd.choice(values)
    rows = [
        (pick(["p1", "p2", "p3", None]), pick([*"abcdefgh", None]), pick([1, 2, None]),
         pick([-10**9, -3 * 10**8, 0, 7 * 10**8, 10**9, 3 * 10**9, None, rnd.randint(-10**9, 10**9)]), pick([1, 2, None]), i // 2)
        for i in range(400)
    ]
    reviews = spark.createDataFrame(rows, "product_id string, user_id string, rating int, hq long, unix_time long, review_id long")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        for iters, history in ((1, True), (4, False), (4, True)):
            got, want = (
                sorted(map(str, product_iterations(reviews, 3, iters, checkpoint_every=every, history=history).collect()))
                for every in (None, 1)
            )
            assert got == want
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
