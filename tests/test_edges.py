"""Edge cases of the source data and of both modes, and brute-force checks."""

import json
import os
import random

import pytest
from pyspark.sql import functions as F

import bruteforce as BF
from peerrank.operators.general import general_graph, general_rank, named
from peerrank.operators.helpfulness import exact_mean
from peerrank.operators.partitions import heavy_keys
from peerrank.operators.product import product_rank
from peerrank.plans.job import rank_job, rank_reviews
from peerrank.session import MAX_BUCKETS, cut_lineage_keyed, ensure_checkpoint_dir, layout_partitions, scratch_run
from peerrank.sources.reviews import load_reviews, load_reviews_quarantine
from peerrank.sources.sinks import array_index, array_lines, read_json_array, read_result, read_result_quarantine, write_json_array, write_result

HEADER = ",asin,helpful,overall,reviewerID,unixReviewTime\n"


def write_csv(path, rows, header=True):
    with open(path, "w") as f:
        if header:
            f.write(HEADER)
        for rid, p, u, r, t, a, tm in rows:
            f.write(f'{rid},{p},"[{t}, {a}]",{r},{u},{tm}\n')
    return path


def as_map(df):
    return {r.user_id: r.rank for r in df.collect()}


def close(a, b, tol=1e-6):
    assert set(a) == set(b)
    bad = {k: (a[k], b[k]) for k in a if abs(a[k] - b[k]) > tol}
    assert not bad, bad


def random_reviews(seed, n=60, products=4, users=12):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        a = rnd.choice([0, 1, 2, 3, 5, 8])
        t = rnd.randint(0, a)
        out.append((i, f"P{rnd.randrange(products)}", f"U{rnd.randrange(users)}", rnd.randint(1, 3), t, a, rnd.randint(0, 10)))
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_bruteforce_both_modes(spark, tmp_out, seed):
    rows = random_reviews(seed)
    r = load_reviews(spark, write_csv(tmp_out(f"r{seed}.csv"), rows))
    want_g, want_links = BF.general(rows, 20, 4)
    close(as_map(general_rank(r, 20, 4)), want_g)
    g = general_graph(r)
    got_links = {(x.src, x.dst) for x in named(g, named(g, g.links, "src"), "dst").collect()}
    assert got_links == want_links
    close(as_map(product_rank(r, 20, 4)), BF.product(rows, 20, 4))


def test_small_lambda_saturates(spark, tmp_out):
    rows = random_reviews(7)
    r = load_reviews(spark, write_csv(tmp_out("s.csv"), rows))
    close(as_map(product_rank(r, 1, 3)), BF.product(rows, 1, 3))
    close(as_map(general_rank(r, 1, 3)), BF.general(rows, 1, 3)[0])


def test_identical_review_dedup_general_only(spark, tmp_out):
    rows = [(1, "P", "A", 4, 3, 4, 1), (1, "P", "A", 4, 3, 4, 1), (2, "P", "B", 4, 0, 4, 2)]
    r = load_reviews(spark, write_csv(tmp_out("d.csv"), rows))
    g = general_graph(r)
    assert {x.name: x.hq for x in g.nodes.collect()}["A"] == 500_000_000
    close(as_map(general_rank(r, 20, 2)), BF.general(rows, 20, 2)[0])
    close(as_map(product_rank(r, 20, 2)), BF.product(rows, 20, 2))


def test_same_user_twice_in_product(spark, tmp_out):
    rows = [(1, "P", "A", 4, 3, 4, 5), (2, "P", "A", 2, 0, 4, 1), (3, "P", "B", 4, 4, 4, 2),
            (4, "P", "C", 2, 2, 2, 3), (5, "Q", "A", 2, 1, 3, 4)]
    r = load_reviews(spark, write_csv(tmp_out("t.csv"), rows))
    close(as_map(product_rank(r, 20, 3)), BF.product(rows, 20, 3))


def test_top_above_all_not_clamped_initially(spark, tmp_out):
    rows = [(1, "P", "A", 4, 6, 4, 1), (2, "P", "B", 4, 1, 4, 2)]
    r = load_reviews(spark, write_csv(tmp_out("u.csv"), rows))
    assert as_map(general_rank(r, 20, 0))["A"] == pytest.approx(2.0)
    assert as_map(general_rank(r, 20, 1))["A"] == 1.0
    assert as_map(product_rank(r, 20, 1))["A"] == 1.0


def test_receiver_at_minus_one_both_signs(spark, tmp_out):
    # receiver at -1; donors at -0.5 (negative) and +1 (positive) in one group
    rows = [(1, "P", "R", 3, 0, 4, 1), (2, "P", "N", 3, 1, 4, 2), (3, "P", "Q", 3, 4, 4, 3), (4, "P", "Z", 3, 1, 2, 4)]
    r = load_reviews(spark, write_csv(tmp_out("v.csv"), rows))
    close(as_map(product_rank(r, 1, 2)), BF.product(rows, 1, 2))


def test_isolated_user_still_ranked(spark, tmp_out):
    rows = [(1, "P", "A", 4, 3, 4, 1), (2, "P", "B", 4, 1, 4, 2), (3, "Q", "C", 5, 1, 3, 3)]
    r = load_reviews(spark, write_csv(tmp_out("w.csv"), rows))
    g, p = as_map(general_rank(r, 20, 3)), as_map(product_rank(r, 20, 3))
    assert g["C"] == pytest.approx(-1 / 3, abs=1e-9) and p["C"] == pytest.approx(-1 / 3, abs=1e-9)


def test_iterations_zero_gives_initial_means(spark, tmp_out):
    rows = random_reviews(11)
    r = load_reviews(spark, write_csv(tmp_out("x.csv"), rows))
    close(as_map(general_rank(r, 20, 0)), BF.general(rows, 20, 0)[0])
    close(as_map(product_rank(r, 20, 0)), BF.product(rows, 20, 0))


def test_header_in_every_file(spark, tmp_out):
    a = write_csv(tmp_out("a.csv"), [(1, "P", "A", 4, 3, 4, 1)])
    b = write_csv(tmp_out("b.csv"), [(2, "P", "B", 4, 1, 4, 2)])
    assert load_reviews(spark, [a, b]).count() == 2


def test_strict_load_fails_on_bad_rating(spark, tmp_out):
    p = tmp_out("bad.csv")
    with open(p, "w") as f:
        f.write(HEADER + '1,P,"[1, 2]",x,A,1\n2,P,"[1, 2]",3,B,1\n')
    with pytest.raises(Exception, match="malformed review row"):
        load_reviews(spark, p).collect()
    good, bad = load_reviews_quarantine(spark, p)
    assert good.count() == 1
    assert [x.reason for x in bad.collect()] == ["bad rating"]


def test_quarantine_bad_votes(spark, tmp_out):
    p = tmp_out("bad2.csv")
    with open(p, "w") as f:
        f.write(HEADER + '1,P,"[1]",3,A,1\n2,P,"[1, 2]",3,B,1\n')
    good, bad = load_reviews_quarantine(spark, p)
    assert good.count() == 1 and [x.reason for x in bad.collect()] == ["bad votes"]


def test_bad_parameters(spark, tmp_out):
    r = load_reviews(spark, write_csv(tmp_out("y.csv"), [(1, "P", "A", 4, 3, 4, 1)]))
    with pytest.raises(ValueError):
        general_rank(r, 0, 1)
    with pytest.raises(ValueError):
        product_rank(r, 0, 1)
    with pytest.raises(ValueError):
        rank_reviews(r, "Other")


def test_rank_job_writes_result(spark, tmp_out, data_path):
    out = tmp_out("result")
    rank_job(spark, "Product", data_path("demo_reviews.csv"), out, 20, 10, 4, demo=True)
    back = {r.user_id: r.rank for r in read_result(spark, out).collect()}
    assert len(back) == 21 and back["Zeno"] == pytest.approx(0.6666667, abs=1e-6)
    trace = spark.read.parquet(out + "_trace")
    assert trace.select("iter").distinct().count() == 11
    with pytest.raises(Exception):
        rank_job(spark, "Product", data_path("demo_reviews.csv"), out, 20, 1, 4)   # output exists


def random_reviews_over_voted(seed, n=70, products=3, users=10):
    """Like random_reviews, with some top > all votes (h above 1)."""
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        a = rnd.choice([1, 2, 3, 4])
        t = rnd.randint(0, a + 2)
        out.append((i, f"P{rnd.randrange(products)}", f"U{rnd.randrange(users)}", rnd.randint(1, 2), t, a, rnd.randint(0, 10)))
    return out


@pytest.mark.parametrize("seed", [31, 32, 33])
def test_start_above_one_with_duplicates(spark, tmp_out, seed):
    rows = random_reviews_over_voted(seed)
    r = load_reviews(spark, write_csv(tmp_out(f"o{seed}.csv"), rows))
    close(as_map(product_rank(r, 2, 3)), BF.product(rows, 2, 3))
    close(as_map(product_rank(r, 2, 3, hot_rows=4)), BF.product(rows, 2, 3))


@pytest.mark.parametrize("hot_rows", [None, 2])
def test_merged_row_start_above_one_meets_clamp_first(spark, tmp_out, hot_rows):
    # A's first row has h = 2 (top > all); A's second row (h = -1, rating 2)
    # receives -0.5 from B and -1/6 from C.  One at a time in ascending donor
    # order, the second row's own zero (donor h = -1) comes first and clamps
    # 2 to 1; then 1 - 0.5 - 1/6 = 1/3.  Without that clamp the result is 1.
    rows = [(1, "P", "A", 1, 3, 2, 1), (2, "P", "A", 2, 0, 2, 5), (3, "P", "B", 2, 1, 4, 2), (4, "P", "C", 2, 1, 3, 3)]
    r = load_reviews(spark, write_csv(tmp_out(f"m{hot_rows}.csv"), rows))
    got = as_map(product_rank(r, 1, 1, hot_rows=hot_rows))
    assert got["A"] == pytest.approx(1 / 3, abs=1e-9)
    close(got, BF.product(rows, 1, 1))


def folder_entries(path):
    return sorted(os.listdir(path)) if os.path.isdir(path) else []


def test_job_leaves_no_scratch_data_and_other_runs_alone(spark, tmp_out, data_path):
    base = ensure_checkpoint_dir(spark).removeprefix("file:")
    with scratch_run(spark) as other:
        kept = cut_lineage_keyed(spark.range(10), ["id"], 2)
        before = folder_entries(base)
        out = tmp_out("result_drop")
        res = rank_job(spark, "General", data_path("demo_reviews.csv"), out, 20, 3, 4, demo=True, drop_scratch=True)
        assert folder_entries(base) == before
        assert kept.count() == 10 and spark.catalog.databaseExists(f"peerrank_run_{other}")
        assert res.ranks.count() == 21 and read_result(spark, out).count() == 21
        assert spark.read.parquet(f"{out}_trace").count() == 4 * 21 and spark.read.text(f"{out}_runlog").count() > 0
    assert f"peerrank-run-{other}" not in folder_entries(base)
    assert not spark.catalog.databaseExists(f"peerrank_run_{other}")


def test_scratch_goes_after_an_error_too(spark, tmp_out):
    base = ensure_checkpoint_dir(spark).removeprefix("file:")
    before = folder_entries(base)
    with pytest.raises(Exception):
        rank_job(spark, "Product", tmp_out("missing.csv"), tmp_out("no_result"), 20, 3, 4, drop_scratch=True)
    assert folder_entries(base) == before


def test_superseded_cuts_are_deleted(spark, data_path):
    r = load_reviews(spark, data_path("demo_reviews.csv"))
    with scratch_run(spark) as run:
        general_rank(r, 20, 10, checkpoint_every=2)
        left = spark.catalog.listTables(f"peerrank_run_{run}")
        assert len(left) == 2, left   # the last state and the nodes' names


def test_layouts_never_exceed_the_buckets_of_a_table(spark):
    assert layout_partitions(spark, 1_000_000) == MAX_BUCKETS
    with pytest.raises(ValueError, match="buckets|bucketed"):
        cut_lineage_keyed(spark.range(1), ["id"], MAX_BUCKETS + 1)


# --- exact means ----------------------------------------------------------------


def test_means_are_exact_past_2_53_and_free_of_order(spark):
    big = 2**53
    values = {"a": [big + 1, 1, -big, big, 3], "b": [2**62, 2**62, 2**62 - 2], "c": [-(2**62)] * 3 + [1], "d": [1, 2], "e": [-1, -2], "f": [None]}
    rows = [(k, v) for k, vs in values.items() for v in vs]

    def want(vs):
        vs = [v for v in vs if v is not None]
        if not vs:
            return None
        q, r = divmod(2 * abs(sum(vs)) + len(vs), 2 * len(vs))
        return q if sum(vs) >= 0 else -q

    for seed in range(4):
        random.Random(seed).shuffle(rows)
        df = spark.createDataFrame(rows, "k string, v long").repartition(seed + 1)
        got = {x.k: x.m for x in df.groupBy("k").agg(exact_mean(F.col("v")).alias("m")).collect()}
        assert got == {k: want(vs) for k, vs in values.items()}
    assert got["d"] == 2 and got["e"] == -2   # halves away from zero


# --- results and arrays ---------------------------------------------------------


def test_malformed_result_lines_fail_or_come_apart(spark, tmp_out):
    path = tmp_out("lines")
    good, bad = ["(A,0.5)", "(B, with comma,-1.0E-4)", "(,0.1)"], ["(C,0.2", "C,0.2)", "(D,x)", "", "(E,)"]
    spark.createDataFrame([(x,) for x in good + bad], "value string").write.text(path)
    rows, rest = read_result_quarantine(spark, path)
    assert {(x.user_id, x["rank"]) for x in rows.collect()} == {("A", 0.5), ("B, with comma", -1e-4), ("", 0.1)}
    assert sorted(x.value for x in rest.collect()) == sorted(bad)
    with pytest.raises(Exception, match="malformed result line"):
        read_result(spark, path).collect()


def test_single_file_result(spark, tmp_out, data_path):
    ranks = product_rank(load_reviews(spark, data_path("demo_reviews.csv")), 20, 2).repartition(5)
    one, many = tmp_out("one"), tmp_out("many")
    write_result(ranks, one, single_file=True)
    write_result(ranks, many)
    parts = lambda p: len([x for x in os.listdir(p) if x.startswith("part-")])
    assert parts(one) == 1 and parts(many) > 1
    assert {tuple(x) for x in read_result(spark, one).collect()} == {tuple(x) for x in read_result(spark, many).collect()}


def test_json_array_is_one_array_over_its_parts(spark, tmp_out):
    df = spark.range(500).select((F.col("id") % 3).alias("iter"), F.concat(F.lit('q"'), "id").alias("id"), (F.col("id") / 7).alias("rank"))
    path = tmp_out("array")
    write_json_array(df, path, ["id"], "iter", partitions=6)
    joined = {}
    for x in array_index(spark, path).orderBy("folder", "start").collect():
        folder = x.folder.removeprefix("file:")
        with open(os.path.join(folder, x.part), "rb") as f:
            data = f.read()
        assert len(data) == x.bytes and x.start == len(joined.get(folder, b""))
        joined[folder] = joined.get(folder, b"") + data
    arrays = {int(f[-1]): json.loads(data) for f, data in joined.items()}
    want = {i: sorted(({"id": r.id, "rank": r["rank"]} for r in df.filter(F.col("iter") == i).collect()), key=lambda r: r["id"]) for i in range(3)}
    assert arrays == want
    assert len({x.folder for x in array_index(spark, path).collect()}) == 3 < array_index(spark, path).count()
    back = read_json_array(spark, path, "id string, rank double")
    assert {(r["iter"], r.id, r["rank"]) for r in back.collect()} == {tuple(r) for r in df.collect()}
    with pytest.raises(Exception):
        write_json_array(df, path, ["id"], "iter")


def test_json_array_needs_one_range_shuffle_and_closes_once(spark, tmp_out):
    rows = [(i % 2, f"u{i // 3}" if i else None) for i in range(40)]   # the order is not total, one id is null
    df = spark.createDataFrame(rows, "iter int, id string")
    assert array_lines(df, ["id"], "iter", 5)._jdf.queryExecution().executedPlan().toString().count("rangepartitioning") == 1
    for group in ("iter", None):
        path = tmp_out(f"tied-{group}")
        write_json_array(df, path, ["iter", "id"] if group is None else ["id"], group, partitions=5)
        joined = {}
        for x in array_index(spark, path).orderBy("folder", "start").collect():
            with open(os.path.join(x.folder.removeprefix("file:"), x.part), encoding="utf-8") as f:
                joined[x.folder] = joined.get(x.folder, "") + f.read()
        found = [r.get("id") for text in joined.values() for r in json.loads(text)]
        assert sorted(map(str, found)) == sorted(str(x[1]) for x in rows)


def test_heavy_keys_are_exact_and_complete(spark):
    rows = spark.range(20_000).select(F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 50 == 1, F.lit(None)).otherwise(F.col("id").cast("string")).alias("k"))
    got = {x.k: x.n_rows for x in heavy_keys(rows, "k", 0.01).collect()}
    assert got == {"hot": 6667}
    edge = spark.range(1_000).select((F.col("id") % 100).cast("string").alias("k"))
    assert heavy_keys(edge, "k", 0.01).count() == 100 and heavy_keys(edge, "k", 0.0101).count() == 0
