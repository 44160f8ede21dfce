"""The skew-safe paths (hot products, heavy groups, bucketed sums, global
positions) agree with the plain plans and with brute force."""

import random
import time

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

import bruteforce as BF
from peerrank.operators.general import general_contributions, general_graph, general_rank, general_step, link_grid
from peerrank.operators import links, report, suffix
from peerrank.operators import general, general_hot
from peerrank.operators.general_hot import cost_model, split_groups
from peerrank.operators.joins import join_small, memory_bytes
from peerrank.operators.links import block_cells, block_pairs, general_links, product_link_pairs
from peerrank.operators.positions import positions
from peerrank.operators.product import product_rank, product_rows
from peerrank.operators.suffix import range_layout, strict_above
from peerrank.session import cut_lineage, cut_lineage_keyed, layout_of_some_keys, setting
from peerrank.sources.reviews import load_reviews, reviews_from_tables
from samples import SF_SMALL
from test_edges import random_reviews, write_csv


def qmap(df, col="rank_q"):
    key = "name" if "name" in df.columns else "user_id"   # graph nodes carry the original id as name
    return {r[key]: r[col] for r in df.collect()}


@pytest.fixture(scope="module")
def small(spark):
    return reviews_from_tables(spark, SF_SMALL).cache()


def test_strict_above_matches_window(spark):
    rnd = random.Random(5)
    rows = [(k, v, rnd.randint(-5, 5)) for k in range(3) for v in rnd.sample(range(10_000), 300 if k == 0 else 20)]
    df = spark.createDataFrame(rows, "k int, o long, x long")
    got = strict_above(df, ["k"], "o", ["x"], partitions=4, target_rows=30)
    w = Window.partitionBy("k").orderBy(F.col("o").desc()).rowsBetween(Window.unboundedPreceding, -1)
    want = df.select("k", "o", F.coalesce(F.sum("x").over(w), F.lit(0)).alias("want"),
                     F.sum("x").over(Window.partitionBy("k")).alias("tot"))
    bad = got.join(want, ["k", "o"]).filter((F.col("above_x") != F.col("want")) | (F.col("total_x") != F.col("tot")))
    assert got.count() == df.count() and bad.count() == 0


@pytest.mark.parametrize("hot_rows", [3, 12])
def test_product_hot_path_equals_plain(small, hot_rows):
    assert qmap(product_rank(small, 20, 3, hot_rows=None)) == qmap(product_rank(small, 20, 3, hot_rows=hot_rows))


@pytest.mark.parametrize("heavy", [3])
def test_general_heavy_path_equals_plain(small, heavy):
    plain = general_graph(small, heavy_users=None)
    hot = general_graph(small, heavy_users=heavy, heavy_plan="signatures")
    assert hot.heavy is not None
    assert qmap(plain.nodes, "deg") == qmap(hot.nodes, "deg")
    assert qmap(general_rank(small, 20, 3, graph=plain)) == qmap(general_rank(small, 20, 3, graph=hot))


def test_hot_paths_against_bruteforce(spark, tmp_out):
    rows = random_reviews(21, n=80, products=3, users=15)
    r = load_reviews(spark, write_csv(tmp_out("hot.csv"), rows))
    want_g = BF.general(rows, 20, 3)[0]
    got_g = {u: v / 1e9 for u, v in qmap(general_rank(r, 20, 3, heavy_users=3, heavy_plan="signatures")).items()}
    assert max(abs(got_g[u] - want_g[u]) for u in want_g) < 1e-6
    want_p = BF.product(rows, 20, 3)
    got_p = {u: v / 1e9 for u, v in qmap(product_rank(r, 20, 3, hot_rows=5)).items()}
    assert max(abs(got_p[u] - want_p[u]) for u in want_p) < 1e-6


def test_positions_match_row_number(spark):
    df = spark.range(0, 3000).select(
        (F.col("id") % 4).cast("int").alias("g"),
        F.col("id").cast("string").alias("u"),
        ((F.col("id") * 7919) % 97).alias("v"),   # many ties, broken by u
    )
    got = positions(df, [F.col("v").desc(), F.col("u").asc()], group="g", partitions=7)
    ref = df.withColumn("p2", F.row_number().over(Window.partitionBy("g").orderBy(F.col("v").desc(), "u")))
    assert got.join(ref, ["g", "u"]).filter("position != p2").count() == 0


@pytest.mark.parametrize("k", [1, 10, 10**6])
def test_top_users_both_ways(small, monkeypatch, k):
    ranks = product_rank(small, 20, 1)
    want = sorted((-x.rank_q, x.user_id) for x in ranks.collect())[:k]
    for most in (0, 100_000):
        monkeypatch.setattr(report, "TOP_IN_ONE_TASK", most)
        got = sorted((x.position, -x.rank_q, x.user_id) for x in report.top_users(ranks, k).collect())
        assert got == [(i + 1, *w) for i, w in enumerate(want)]


def test_hot_sources_spread(small):
    plain = general_graph(small, heavy_users=None, hot_source_links=None)
    spread = general_graph(small, heavy_users=None, hot_source_links=40)
    assert spread.hot_links is not None and spread.hot_links.count() > 0
    assert qmap(plain.nodes, "deg") == qmap(spread.nodes, "deg")
    assert qmap(general_rank(small, 20, 3, graph=plain)) == qmap(general_rank(small, 20, 3, graph=spread))


def trace_map(df):
    return {(r.iter, r.user_id): r.rank_q for r in df.collect()}


def test_traces_on_skew_paths(small):
    assert trace_map(product_rank(small, 20, 3, trace=True, hot_rows=None)) == \
        trace_map(product_rank(small, 20, 3, trace=True, hot_rows=4))
    assert trace_map(general_rank(small, 20, 3, trace=True, heavy_users=None)) == \
        trace_map(general_rank(small, 20, 3, trace=True, heavy_users=3, heavy_plan="signatures"))


# --- block pairs ----------------------------------------------------------------


def group_members(spark, n, values):
    return spark.range(n).select(
        F.lit("p").alias("product_id"), F.lit(5).alias("rating"), F.col("id").alias("user_id"), (F.col("id") * 7919 % values).alias("H"))


@pytest.mark.parametrize("block", [2, 1000])
def test_block_pairs_equal_the_plain_join(small, block):
    plain = {tuple(x) for x in general_links(small).collect()}
    rows = general_links(small, block_members=block).collect()
    assert {tuple(x) for x in rows} == plain and len(rows) == len(plain)
    product = {tuple(x) for x in product_link_pairs(product_rows(small)).collect()}
    assert {tuple(x) for x in product_link_pairs(product_rows(small), block_members=block).collect()} == product


def test_a_group_of_50000_members_spreads_over_tasks(spark):
    members = group_members(spark, 50_000, 50_000)
    placed, cells = block_cells(members, 1_000, 8)
    # members per block are bounded, and the cells (the work) are triangular
    assert placed.groupBy("_b").count().agg(F.max("count")).first()[0] == 1_000
    assert cells.count() == 50 * 51 // 2
    dealt = cells.repartition(16, "product_id", "rating", "_i", "_j").groupBy(F.spark_partition_id()).count().collect()
    assert len(dealt) == 16 and max(x["count"] for x in dealt) < 2 * 1275 / 16
    pairs = block_pairs(group_members(spark, 2_000, 1_999), 100, 8)
    assert pairs.count() == 2_000 * 1_999 // 2 - 1   # two members share a value


@pytest.mark.parametrize("target", [4, 200_000])
def test_groups_that_fit_a_task_are_numbered_where_they_lie(spark, monkeypatch, target):
    numbered = []
    monkeypatch.setattr(suffix, "TARGET_BUCKET_ROWS", target)
    monkeypatch.setattr(links, "positions", lambda df, *a, **k: numbered.append(df) or positions(df, *a, **k))
    members = cut_lineage(group_members(spark, 9, 7).unionByName(group_members(spark, 3, 3).withColumn("rating", F.lit(1))))
    pairs = sorted(map(tuple, block_pairs(members, 2, 3).collect()))
    rows = members.collect()
    want = [(a.user_id, b.user_id) for a in rows for b in rows if a.rating == b.rating and b.H < a.H]
    assert pairs == sorted(want)
    assert len(numbered) == (target == 4)


def test_equal_values_make_no_cells(spark):
    _, cells = block_cells(group_members(spark, 3_000, 1), 100, 8)
    assert cells.count() == 0
    assert block_pairs(group_members(spark, 3_000, 2), 100, 8).count() == 1_500 * 1_500


# --- signatures or pairs --------------------------------------------------------


def test_cost_model_chooses_by_group(spark):
    # group a: 400 users with two sets of groups and ten values; group b: everyone differs
    a = [("a", 1, u, u % 10) for u in range(400)]
    b = [("b", 1, u, u) for u in range(1000, 1040)] + [(f"c{u}", 1, u, u) for u in range(1000, 1040)] + [(f"c{u}", 1, u + 1, u + 1) for u in range(1000, 1039)]
    members = cut_lineage(spark.createDataFrame(a + b, "product_id string, rating int, user_id long, H long"))
    heavy = members.groupBy("product_id", "rating").count().filter("count > 1").drop("count")
    by = {x.product_id: x for x in cost_model(members, heavy).collect()}
    assert by["a"].by_signature and (by["a"].members, by["a"].levels, by["a"].sigs) == (400, 10, 1)
    assert not by["b"].by_signature and by["b"].sigs >= 39
    listed, signed = split_groups(members, 1)
    assert {x.product_id for x in signed.select("product_id").distinct().collect()} == {"a"}
    assert listed.count() + signed.count() == members.count()


@pytest.mark.parametrize("plan", ["cost", "pairs"])
def test_every_heavy_plan_gives_the_same_ranks(small, plan):
    plain = qmap(general_rank(small, 20, 2, heavy_users=None))
    assert qmap(general_rank(small, 20, 2, heavy_users=3, heavy_plan=plan)) == plain


@pytest.mark.parametrize("small_set", [0, 2])
def test_large_sets_of_groups(small, monkeypatch, small_set):
    # sets above SMALL_SET are compared through a join
    monkeypatch.setattr(general_hot, "SMALL_SET", small_set)
    hot = general_graph(small, heavy_users=3, heavy_plan="signatures")
    plain = general_graph(small, heavy_users=None)
    assert hot.heavy.large and qmap(hot.nodes, "deg") == qmap(plain.nodes, "deg")
    assert qmap(general_rank(small, 20, 2, graph=hot)) == qmap(general_rank(small, 20, 2, graph=plain))


def test_heavy_users_with_equal_means_and_sets(spark):
    # 40 users with the same groups and three values: their points have several users
    rows = [(p, str(u), 5, u % 3 * 10**8) for p in ("a", "b") for u in range(40)]
    rows += [("c", str(u), 5, u % 3 * 10**8) for u in range(30, 36)]
    r = cut_lineage(spark.createDataFrame(rows, "product_id string, user_id string, rating int, hq long"))
    hot, plain = general_graph(r, heavy_users=7, heavy_plan="signatures"), general_graph(r, heavy_users=None)
    assert hot.heavy.many is not None and hot.links.count() == 0   # pairs of c are linked through a and b
    assert qmap(hot.nodes, "deg") == qmap(plain.nodes, "deg")
    assert qmap(general_rank(r, 20, 3, graph=hot)) == qmap(general_rank(r, 20, 3, graph=plain))


def test_shuffles_of_the_heavy_path(small):
    hot = general_graph(small, heavy_users=3, heavy_plan="signatures")
    state = hot.nodes.select("user_id", F.col("hq").alias("rq"), "deg")
    plan = general_contributions(hot, state, 20)._jdf.queryExecution().executedPlan().toString()
    # the users' values by level, the sums of the levels, and the rows of links and lookups in one
    assert plan.count("Exchange hashpartitioning") <= 5, plan


# --- range layout ---------------------------------------------------------------


def test_layout_is_kept_while_values_move(spark):
    rows = cut_lineage(spark.range(3_000).select((F.col("id") % 2).alias("k"), (F.col("id") * 31 % 3_000).alias("o"), F.lit(1).alias("x")))
    layout = range_layout(rows, ["k"], "o", 4, target_rows=100)
    assert layout.bounds is not None
    moved = cut_lineage(rows.withColumn("o", F.col("o") * F.col("o") % 1_000))   # other values, with ties
    w = Window.partitionBy("k").orderBy(F.col("o").desc())
    want = moved.select("k", "o", F.coalesce(F.sum("x").over(w.rangeBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("a"),
                        F.sum("x").over(w.rangeBetween(Window.unboundedPreceding, 0)).alias("u"))
    got = layout.above(layout.place(moved, "o"), "o", ["x"]).select("k", "o", "above_x", "upto_x")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert not layout.outgrown(rows, "o")
    assert layout.outgrown(rows.withColumn("o", F.lit(5)), "o")


@pytest.mark.parametrize("target", [5])
def test_hot_products_in_many_buckets(small, monkeypatch, target):
    monkeypatch.setattr(suffix, "TARGET_BUCKET_ROWS", target)
    want = trace_map(product_rank(small, 20, 5, trace=True, hot_rows=None))
    assert trace_map(product_rank(small, 20, 5, trace=True, hot_rows=4)) == want
    heavy = qmap(general_rank(small, 20, 2, heavy_users=3, heavy_plan="signatures"))
    assert heavy == qmap(general_rank(small, 20, 2, heavy_users=None))


def test_jobs_of_the_hot_path(spark):
    r = reviews_from_tables(spark, "/root/testdata/sf0.01")
    spark.sparkContext.setJobGroup("hot", "hot products")
    try:
        product_rank(r, 20, 3, hot_rows=20).write.format("noop").mode("overwrite").save()
        jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("hot"))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs <= 40, jobs


def jobs_of(spark, group, run):
    spark.sparkContext.setJobGroup(group, group)
    try:
        run().write.format("noop").mode("overwrite").save()
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_more_iterations_of_hot_products_cost_no_more_jobs(spark, small):
    few, many = (jobs_of(spark, f"hot-{i}", lambda: product_rank(small, 20, i, hot_rows=4)) for i in (2, 6))
    assert many <= few + 2, (few, many)


@pytest.mark.parametrize("target", [3, 200_000])
def test_repeated_users_of_hot_products(spark, tmp_out, monkeypatch, target):
    monkeypatch.setattr(suffix, "TARGET_BUCKET_ROWS", target)
    rnd = random.Random(3)
    rows = [(i, f"P{i % 2}", f"u{rnd.randrange(9)}", rnd.randint(1, 3), rnd.randint(0, 9), rnd.randint(0, 9), rnd.randrange(20)) for i in range(120)]
    r = load_reviews(spark, write_csv(tmp_out("repeated.csv"), rows))
    want = trace_map(product_rank(r, 20, 4, trace=True, hot_rows=None))
    assert trace_map(product_rank(r, 20, 4, trace=True, hot_rows=10)) == want


# --- broadcasts by size ---------------------------------------------------------


def test_broadcast_follows_the_measured_bytes(spark):
    arrays = spark.range(100).select("id", F.array_repeat(F.col("id"), 1_000).alias("a"))
    assert 100 * 8_000 <= memory_bytes(arrays) <= 100 * 8_200
    texts = spark.range(10).select("id", F.repeat(F.lit("x"), 500).alias("t"))
    assert 5_000 <= memory_bytes(texts) <= 6_000
    big = spark.range(1_000)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        small = join_small(big, arrays, ["id"])._jdf.queryExecution().executedPlan().toString()
        large = join_small(big, arrays, ["id"], max_bytes=100_000)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" in small and "BroadcastHashJoin" not in large


def test_sums_of_shares_do_not_depend_on_path_or_order(spark, tmp_out):
    # many donors with shares that have no exact binary form, at every threshold and partition count
    rows = [(i, "P", f"u{i}", 1 + i % 2, (i * 7) % 11, 11, i) for i in range(400)] + [(1000 + i, "Q", f"u{i % 90}", 1, i % 3, 7, i) for i in range(300)]
    r = load_reviews(spark, write_csv(tmp_out("order.csv"), rows)).cache()
    want = qmap(product_rank(r, 3, 4, hot_rows=None, partitions=1))
    assert qmap(product_rank(r.orderBy(F.rand(5)), 3, 4, hot_rows=100, partitions=5)) == want
    general = qmap(general_rank(r, 3, 4, heavy_users=None, partitions=1))
    assert qmap(general_rank(r.orderBy(F.rand(6)), 3, 4, heavy_users=50, heavy_plan="signatures", partitions=5)) == general


def test_shares_beyond_the_clamp(spark, tmp_out):
    # top > all: a first h of 199 gives a share far above 2, which saturates its receivers as 2 does
    rows = [(1, "P", "A", 1, 1000, 10, 1), (2, "P", "B", 1, 0, 2, 2), (3, "P", "C", 1, 1, 4, 3), (4, "P", "D", 1, -900, 3, 4), (5, "P", "E", 1, -901, 3, 5)]
    r = load_reviews(spark, write_csv(tmp_out("beyond.csv"), rows))
    for iters in (1, 2):
        want = BF.product(rows, 1, iters)
        for hot in (None, 2):
            got = {u: v / 1e9 for u, v in qmap(product_rank(r, 1, iters, hot_rows=hot)).items()}
            assert max(abs(got[u] - want[u]) for u in want) < 1e-6


@pytest.mark.parametrize("more", [{}, {"heavy_users": 3, "heavy_plan": "signatures"}, {"hot_source_links": 40}])
def test_links_in_a_grid_give_the_same_ranks(small, monkeypatch, more):
    more = {"heavy_users": None} | more
    monkeypatch.setattr(general, "link_grid", lambda *_: (6, 5))
    plain = general_graph(small, heavy_users=None)
    grid = general_graph(small, 32, cells=True, **more)
    assert plain.grid is None and grid.grid is not None and "cell" in grid.links.columns
    assert qmap(plain.nodes, "deg") == qmap(grid.nodes, "deg")
    assert qmap(general_rank(small, 20, 3, graph=plain)) == qmap(general_rank(small, 20, 3, partitions=32, graph=grid))


def test_links_in_a_grid_stay_where_they_lie(spark, small):
    g = general_graph(small, 32, heavy_users=None, cells=True)
    state = g.nodes.select("user_id", F.col("hq").alias("rq"), "deg")
    with layout_of_some_keys(spark), setting(spark, "spark.sql.shuffle.partitions", "32"):
        plan = general_step(g, state, 20)._jdf.queryExecution().executedPlan().toString()
    # shares by cell and sums by receiver are shuffled, links are not
    assert plan.count("Exchange hashpartitioning(") == 2 and "Exchange hashpartitioning(cell" in plan
    rows, columns = link_grid(10**9, 10**7, 200)
    assert rows * columns <= 200 and rows > 1 and columns > 1
    assert link_grid(10**7, 10**7, 200) is None and link_grid(0, 0, 200) is None   # a link a user: by source


def test_a_cut_leaves_no_shuffle_files(spark):
    def files():
        blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks().mkString(" ").split()
        return {b for b in blocks if b.startswith("shuffle_")}

    rows, before = spark.range(1000).selectExpr("id % 7 AS k", "id"), files()
    cut_lineage(rows.groupBy("k").count())
    cut_lineage_keyed(rows, ["k"], 4)
    for _ in range(50):   # deleted in the background
        if not files() - before:
            break
        time.sleep(0.2)
    assert not files() - before
