"""Registered queries over the driver tables, each with its DuckDB oracle.

Every query reads ``lineitem`` and ``orders`` (through the reviews view)
in full.  Iterative ranks use ``ITERS`` iterations so the oracle can unroll
them.  Helpfulness and ranks are reported with six decimals (rounded from
the engine's 1e-9 grid) so both engines print identical doubles.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalar import dequantize, quantize, rounded6
from ..operators.general import general_contributions, general_graph, general_rank, named
from ..operators.helpfulness import distinct_reviews, product_summary, review_helpfulness, user_means
from ..operators.links import general_links, product_link_pairs, product_links_after
from ..operators.partitions import heavy_keys, partition_report
from ..operators.product import product_collapse, product_contributions, product_rank, product_rows
from ..operators.report import (
    band_histogram, graph_links, graph_nodes, leaderboard, rank_bands, rank_trajectory, top_users, user_lookup,
)
from ..session import cut_lineage, ensure_checkpoint_dir
from ..sources.reviews import load_reviews, load_reviews_quarantine, reviews_from_tables
from ..sources.runlog import dead_letters, parse_runlog, runlog_lines, write_runlog
from ..sources.sinks import (
    link_records, node_records, read_json_array, read_result, read_result_quarantine, result_lines, write_json_array, write_result,
)
from ..streaming.feeds import graph_streams, runlog_stream
from . import oracle as O

LAMBDA = 20
ITERS = 10
BATCH_ITERS = 3      # the original's batch runs
STRONG_LAMBDA = 0.5  # small enough for ranks to reach the clamp at 1
TOP_K = 10
# Far below the defaults, so that the skew paths run on the driver's tables.
LOW_HEAVY_USERS = 10
LOW_HOT_ROWS = 20
LOW_BLOCK_MEMBERS = 4
LEAST_SHARE = 0.0008


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint directory."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/scratch/{name}-{uuid.uuid4().hex}"


def _r6(col: str, name: str | None = None):
    return rounded6(F.col(col)).alias(name or col)


def _reviews(spark: SparkSession, sf: str) -> DataFrame:
    return reviews_from_tables(spark, sf)


# --- sources -----------------------------------------------------------------

def write_review_csv(reviews: DataFrame, path: str) -> None:
    """Reviews in the original CSV layout (unnamed index column, vote text
    ``"[top, all]"``); used to feed the CSV source from the driver tables."""
    reviews.select(
        F.col("review_id").alias(""),
        F.col("product_id").alias("asin"),
        F.format_string("[%d, %d]", F.col("top").cast("long"), F.col("votes").cast("long")).alias("helpful"),
        F.col("rating").cast("string").alias("overall"),
        F.col("user_id").alias("reviewerID"),
        F.col("unix_time").alias("unixReviewTime"),
    ).write.option("header", True).csv(path)


def q_reviews_load(spark, sf):
    path = scratch_path(spark, "reviews-csv")
    write_review_csv(_reviews(spark, sf), path)
    r = load_reviews(spark, path)
    return r.select("review_id", "product_id", "user_id", "rating", "top", "votes", "unix_time",
                    dequantize(F.col("hq")).alias("h"))


# Corrupted rows for the quarantine query, chosen by data values
def _bad_rating():
    return (F.col("votes") == 0) & (F.col("rating") == 3)


def _bad_votes():
    return (F.col("votes") == 12) & (F.col("rating") == 1)


def q_reviews_quarantine(spark, sf):
    rv = _reviews(spark, sf)
    path = scratch_path(spark, "reviews-bad-csv")
    rv.select(
        F.col("review_id").alias(""),
        F.col("product_id").alias("asin"),
        F.when(_bad_votes(), F.lit("[]")).otherwise(
            F.format_string("[%d, %d]", F.col("top").cast("long"), F.col("votes").cast("long"))).alias("helpful"),
        F.when(_bad_rating(), F.lit("x")).otherwise(F.col("rating").cast("string")).alias("overall"),
        F.col("user_id").alias("reviewerID"),
        F.col("unix_time").alias("unixReviewTime"),
    ).write.option("header", True).csv(path)
    _, bad = load_reviews_quarantine(spark, path)
    return bad.select("review_id", "product_id", "user_id", "reason")


def q_reviews_distinct(spark, sf):
    return distinct_reviews(_reviews(spark, sf)).select("user_id", "product_id", "rating", dequantize(F.col("hq")).alias("h"))


def q_review_helpfulness(spark, sf):
    return review_helpfulness(_reviews(spark, sf))


def q_user_helpfulness(spark, sf):
    m = user_means(distinct_reviews(_reviews(spark, sf)))
    return m.select("user_id", dequantize(F.col("hq")).alias("h"), "n_reviews")


def q_product_summary(spark, sf):
    s = product_summary(_reviews(spark, sf))
    return s.select("product_id", "n_reviews", "n_users", dequantize(F.col("mean_hq")).alias("mean_h"))


# --- General -------------------------------------------------------------------

def _all_links(rv, once: bool = True):
    return general_links(rv, once=once)


def q_general_links(spark, sf):
    return _all_links(_reviews(spark, sf))


def q_general_out_degree(spark, sf):
    g = general_graph(_reviews(spark, sf))
    return g.nodes.filter(F.col("deg") > 0).select(F.col("name").alias("src"), "deg")


def q_general_contributions(spark, sf):
    g = general_graph(_reviews(spark, sf))
    state = g.nodes.select("user_id", F.col("hq").alias("rq"), "deg")
    add = named(g, general_contributions(g, state, LAMBDA), "dst")
    return add.select("dst", rounded6(quantize(F.col("add"))).alias("add"))


def q_general_rank(spark, sf):
    return general_rank(_reviews(spark, sf), LAMBDA, ITERS).select("user_id", _r6("rank_q", "rank"))


def _general_trace(spark, sf):
    return general_rank(_reviews(spark, sf), LAMBDA, ITERS, trace=True)


def q_general_trace(spark, sf):
    return _general_trace(spark, sf).select("iter", "user_id", _r6("rank_q", "rank"))


def q_general_rank_it3(spark, sf):
    return general_rank(_reviews(spark, sf), LAMBDA, BATCH_ITERS).select("user_id", _r6("rank_q", "rank"))


def q_general_rank_clamped(spark, sf):
    return general_rank(_reviews(spark, sf), STRONG_LAMBDA, ITERS).select("user_id", _r6("rank_q", "rank"))


def q_general_rank_heavy(spark, sf):
    """Groups of more than ``LOW_HEAVY_USERS`` members ranked by signatures, without pairs."""
    r = general_rank(_reviews(spark, sf), LAMBDA, ITERS, heavy_users=LOW_HEAVY_USERS, heavy_plan="signatures")
    return r.select("user_id", _r6("rank_q", "rank"))


def q_general_out_degree_heavy(spark, sf):
    g = general_graph(_reviews(spark, sf), heavy_users=LOW_HEAVY_USERS, heavy_plan="signatures")
    return g.nodes.filter(F.col("deg") > 0).select(F.col("name").alias("src"), "deg")


def q_general_links_blocks(spark, sf):
    """Links with every group of more than ``LOW_BLOCK_MEMBERS`` members cut into block pairs."""
    return general_links(_reviews(spark, sf), block_members=LOW_BLOCK_MEMBERS)


# --- Product -------------------------------------------------------------------

def q_product_links(spark, sf):
    return product_link_pairs(product_rows(_reviews(spark, sf)))


def q_product_links_final(spark, sf):
    return product_links_after(_reviews(spark, sf), LAMBDA, ITERS)


def q_product_contributions(spark, sf):
    c = product_contributions(product_rows(_reviews(spark, sf)), LAMBDA)
    return c.select(
        "product_id", "user_id", "rating", dequantize(F.col("hq")).alias("h"), "e",
        rounded6(quantize(F.col("c"))).alias("c"),
        rounded6(quantize(F.col("n"))).alias("n"),
        rounded6(quantize(F.col("p"))).alias("p"),
    )


def q_product_collapse(spark, sf):
    rows = product_collapse(product_contributions(product_rows(_reviews(spark, sf)), LAMBDA))
    return rows.select("product_id", "user_id", "rating", dequantize(F.col("hq")).alias("h"))


def _product_final(spark, sf):
    return product_rank(_reviews(spark, sf), LAMBDA, ITERS)


def q_product_rank(spark, sf):
    return _product_final(spark, sf).select("user_id", _r6("rank_q", "rank"))


def _product_trace(spark, sf):
    return product_rank(_reviews(spark, sf), LAMBDA, ITERS, trace=True)


def q_product_trace(spark, sf):
    return _product_trace(spark, sf).select("iter", "user_id", _r6("rank_q", "rank"))


def q_product_rank_hot(spark, sf):
    """Products of more than ``LOW_HOT_ROWS`` reviews ranked by levels."""
    return product_rank(_reviews(spark, sf), LAMBDA, ITERS, hot_rows=LOW_HOT_ROWS).select("user_id", _r6("rank_q", "rank"))


def q_product_trace_hot(spark, sf):
    t = product_rank(_reviews(spark, sf), LAMBDA, ITERS, trace=True, hot_rows=LOW_HOT_ROWS)
    return t.select("iter", "user_id", _r6("rank_q", "rank"))


def q_product_links_blocks(spark, sf):
    return product_link_pairs(product_rows(_reviews(spark, sf)), block_members=LOW_BLOCK_MEMBERS)


# --- reports -------------------------------------------------------------------

def q_leaderboard(spark, sf):
    b = leaderboard(_product_trace(spark, sf))
    return b.select("iter", "position", "user_id", _r6("rank_q", "rank"), "label")


def q_general_leaderboard(spark, sf):
    b = leaderboard(_general_trace(spark, sf))
    return b.select("iter", "position", "user_id", _r6("rank_q", "rank"), "label")


def q_top_users(spark, sf):
    return top_users(_product_final(spark, sf), TOP_K).select("position", "user_id", _r6("rank_q", "rank"))


def q_rank_trajectory(spark, sf):
    return rank_trajectory(leaderboard(_product_trace(spark, sf)), ITERS)


def q_rank_bands(spark, sf):
    return rank_bands(_product_final(spark, sf)).select("user_id", _r6("rank_q", "rank"), "band", "colour")


def q_band_histogram(spark, sf):
    return band_histogram(_product_final(spark, sf))


def q_user_lookup_letters(spark, sf):
    """Lookup of ids with letters, by keys in the wrong case."""
    named_reviews = _reviews(spark, sf).withColumn("user_id", F.concat(F.lit("User"), "user_id"))
    custkey = F.col("c_custkey").cast("string")
    keys = spark.read.parquet(f"{sf}/customer.parquet").select(F.concat(F.lit("uSER"), custkey).alias("key"))
    return user_lookup(product_rank(named_reviews, LAMBDA, BATCH_ITERS), keys).select("key", "user_id", _r6("rank_q", "rank"))


def q_user_lookup(spark, sf):
    keys = spark.read.parquet(f"{sf}/customer.parquet").select(F.col("c_custkey").cast("string").alias("key"))
    ranks = general_rank(_reviews(spark, sf), LAMBDA, ITERS)
    return user_lookup(ranks, keys).select("key", "user_id", _r6("rank_q", "rank"))


def _general_initial(spark, sf):
    g = general_graph(_reviews(spark, sf))
    ranks = g.nodes.select(F.col("name").alias("user_id"), F.col("hq").alias("rank_q"),
                           dequantize(F.col("hq")).alias("rank"))
    return g, ranks


def q_graph_nodes(spark, sf):
    _, ranks = _general_initial(spark, sf)
    return graph_nodes(ranks).select("id", _r6("rank_q", "rank"), "band", "colour",
                                     rounded6(quantize(F.col("node_size"))).alias("node_size"))


def q_graph_links(spark, sf):
    _, ranks = _general_initial(spark, sf)
    links = _all_links(_reviews(spark, sf))
    return graph_links(links, ranks.select("user_id", rounded6(F.col("rank_q")).alias("rank")))


def q_product_graph_links_final(spark, sf):
    """Product graph after all iterations: its links with the ranks of both ends."""
    rv = _reviews(spark, sf)
    ranks = product_rank(rv, LAMBDA, ITERS).select("user_id", rounded6(F.col("rank_q")).alias("rank"))
    return graph_links(product_links_after(rv, LAMBDA, ITERS), ranks)


# --- sinks, logs, streams ---------------------------------------------------------

def q_result_lines(spark, sf):
    r = _product_final(spark, sf).select("user_id", rounded6(F.col("rank_q")).alias("rank"))
    return result_lines(r)


def q_result_roundtrip(spark, sf):
    r = _product_final(spark, sf).select("user_id", "rank_q", rounded6(F.col("rank_q")).alias("rank"))
    path = scratch_path(spark, "result")
    write_result(r, path)
    return read_result(spark, path)


def q_result_quarantine(spark, sf):
    """Result lines with some cut off (negative ranks lose their bracket): the lines that come back apart."""
    r = _product_final(spark, sf).select("user_id", rounded6(F.col("rank_q")).alias("rank"))
    lines = result_lines(r)
    path = scratch_path(spark, "result-cut")
    lines.select(F.when(F.col("value").contains(",-"), F.expr("left(value, length(value) - 1)")).otherwise(F.col("value")).alias("value")).write.text(path)
    return read_result_quarantine(spark, path)[1]


def _json_rank(trace: DataFrame) -> DataFrame:
    """Ranks as decimals with six places, which print the same everywhere."""
    return node_records(trace.select("iter", "user_id", rounded6(F.col("rank_q")).cast("decimal(12,6)").alias("rank")))


def _array_round_trip(spark, records, order, group, schema) -> DataFrame:
    path = scratch_path(spark, "json-array")
    write_json_array(records, path, order, group)
    return read_json_array(spark, path, schema)


def q_nodes_json(spark, sf):
    """One array of nodes per iteration, written as part files and read back."""
    back = _array_round_trip(spark, _json_rank(_product_trace(spark, sf)), ["id"], "iter", "id string, rank decimal(12,6)")
    return back.select("iter", "json")


def q_nodes_json_quoted(spark, sf):
    """As ``nodes_json``, with quotes in the ids, which the records lose."""
    quoted = _reviews(spark, sf).withColumn("user_id", F.concat(F.lit('"u'), "user_id", F.lit('"')))
    trace = product_rank(quoted, LAMBDA, BATCH_ITERS, trace=True)
    back = _array_round_trip(spark, _json_rank(trace), ["id"], "iter", "id string, rank decimal(12,6)")
    return back.select("iter", "json")


def q_links_json(spark, sf):
    recs = link_records(product_link_pairs(product_rows(_reviews(spark, sf)), once=False))   # each once as a record
    return _array_round_trip(spark, recs, ["source", "target"], None, "source string, target string").select("json")


def q_general_links_json(spark, sf):
    recs = link_records(_all_links(_reviews(spark, sf), once=False))   # each once as a record
    return _array_round_trip(spark, recs, ["source", "target"], None, "source string, target string").select("json")


def _write_runlog(spark, sf) -> str:
    rv = _reviews(spark, sf)
    t = product_rank(rv, LAMBDA, ITERS, trace=True).select("iter", "user_id", rounded6(F.col("rank_q")).alias("rank"))
    links = product_link_pairs(product_rows(rv), once=False)   # the log's lines hold each once
    path = scratch_path(spark, "runlog")
    write_runlog(runlog_lines(cut_lineage(t), links), path)
    return path


def q_runlog_events(spark, sf):
    return parse_runlog(spark.read.text(_write_runlog(spark, sf)))


def q_runlog_stream(spark, sf):
    """The run log followed by a file-source stream (available-now trigger)
    into a parquet sink; the sink's content is the result."""
    src = _write_runlog(spark, sf)
    out = scratch_path(spark, "runlog-stream-out")
    q = (
        runlog_stream(spark, src).drop("arrived").writeStream.format("parquet")
        .option("checkpointLocation", out + "-ckpt")
        .trigger(availableNow=True)
        .start(out)
    )
    q.awaitTermination()
    return spark.read.parquet(out)


def q_general_runlog_events(spark, sf):
    """General mode's run log, each of its part files written twice: repeated lines count once."""
    rv = _reviews(spark, sf)
    t = _general_trace(spark, sf).select("iter", "user_id", rounded6(F.col("rank_q")).alias("rank"))
    path = scratch_path(spark, "general-runlog")
    write_runlog(runlog_lines(cut_lineage(t), _all_links(rv, once=False)), path)
    spark.read.text(path).write.mode("append").text(path, compression="gzip")
    return parse_runlog(spark.read.text(path))


def q_runlog_dead_letters(spark, sf):
    """A run log with a line per user behind a log prefix; by the user's number
    some are cut off and some lack a field.  Those come back apart."""
    users = _reviews(spark, sf).select("user_id").distinct()
    n = F.col("user_id").cast("long")
    record = F.when(n % 3 == 0, F.format_string('[{"id":"%s","rank":0.', "user_id")).when(
        n % 3 == 1, F.format_string('[{"id":"%s"}]', "user_id")
    ).otherwise(F.format_string('[{"id":"%s","rank":0.5}]', "user_id"))
    path = scratch_path(spark, "runlog-cut")
    users.select(F.concat(F.lit("INFO driver: #nodesIter1#"), record).alias("value")).write.text(path)
    return dead_letters(spark.read.text(path))


def q_graph_stream(spark, sf):
    """General mode's initial nodes and links, paired as their log lines arrive."""
    _, ranks = _general_initial(spark, sf)
    nodes = ranks.select(F.lit(0).alias("iter"), "user_id", rounded6(F.col("rank_q")).alias("rank"))
    log, out = scratch_path(spark, "graph-log"), scratch_path(spark, "graph-stream")
    write_runlog(runlog_lines(cut_lineage(nodes), _all_links(_reviews(spark, sf), once=False)), log)
    return graph_streams(spark, log, out, f"{out}-ckpt", available_now=True)


def q_partition_report(spark, sf):
    """Totals over all partitions by product, and the users with at least
    ``LEAST_SHARE`` of all rows (which partition a key falls into is Spark's own)."""
    rv = cut_lineage(_reviews(spark, sf).select("product_id", "user_id"))
    totals = partition_report(rv, key="product_id").agg(
        F.sum("n_rows").alias("n_rows"), F.sum("n_keys").alias("n_keys"),
        (F.round(F.sum("share") * 1e6) / 1e6).alias("share"),
    )
    heavy = heavy_keys(rv, "user_id", LEAST_SHARE)
    return totals.select(F.lit(None).cast("string").alias("user_id"), "n_rows", "n_keys", "share").unionByName(
        heavy.select("user_id", "n_rows", F.lit(None).cast("long").alias("n_keys"), (F.round(F.col("share") * 1e6) / 1e6).alias("share"))
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "reviews_load": q_reviews_load,
    "reviews_distinct": q_reviews_distinct,
    "reviews_quarantine": q_reviews_quarantine,
    "review_helpfulness": q_review_helpfulness,
    "user_helpfulness": q_user_helpfulness,
    "product_summary": q_product_summary,
    "general_links": q_general_links,
    "general_out_degree": q_general_out_degree,
    "general_contributions": q_general_contributions,
    "general_rank": q_general_rank,
    "general_trace": q_general_trace,
    "general_rank_it3": q_general_rank_it3,
    "general_rank_clamped": q_general_rank_clamped,
    "general_rank_heavy": q_general_rank_heavy,
    "general_out_degree_heavy": q_general_out_degree_heavy,
    "general_links_blocks": q_general_links_blocks,
    "product_links": q_product_links,
    "product_links_final": q_product_links_final,
    "product_contributions": q_product_contributions,
    "product_collapse": q_product_collapse,
    "product_rank": q_product_rank,
    "product_trace": q_product_trace,
    "product_rank_hot": q_product_rank_hot,
    "product_trace_hot": q_product_trace_hot,
    "product_links_blocks": q_product_links_blocks,
    "leaderboard": q_leaderboard,
    "general_leaderboard": q_general_leaderboard,
    "top_users": q_top_users,
    "rank_trajectory": q_rank_trajectory,
    "rank_bands": q_rank_bands,
    "band_histogram": q_band_histogram,
    "user_lookup": q_user_lookup,
    "user_lookup_letters": q_user_lookup_letters,
    "graph_nodes": q_graph_nodes,
    "graph_links": q_graph_links,
    "product_graph_links_final": q_product_graph_links_final,
    "result_lines": q_result_lines,
    "result_roundtrip": q_result_roundtrip,
    "result_quarantine": q_result_quarantine,
    "nodes_json": q_nodes_json,
    "nodes_json_quoted": q_nodes_json_quoted,
    "links_json": q_links_json,
    "general_links_json": q_general_links_json,
    "runlog_events": q_runlog_events,
    "runlog_stream": q_runlog_stream,
    "general_runlog_events": q_general_runlog_events,
    "runlog_dead_letters": q_runlog_dead_letters,
    "graph_stream": q_graph_stream,
    "partition_report": q_partition_report,
}


# --- oracle SQL ------------------------------------------------------------------

def _sql() -> dict[str, str]:
    W = O.with_ctes
    RV = O.review_ctes()
    G = O.general_ctes(LAMBDA, ITERS)
    G0 = O.general_ctes(LAMBDA, 0)
    G1 = O.general_ctes(LAMBDA, 1)
    P = O.product_ctes(LAMBDA, ITERS)
    P1 = O.product_ctes(LAMBDA, 1)
    h = O.h9("hq")
    ptrace = f"SELECT iter, user_id, rank_q FROM ({O.product_trace_union(ITERS)})"
    board = (f"SELECT iter, row_number() OVER (PARTITION BY iter ORDER BY rank_q DESC, user_id) AS position, "
             f"user_id, rank_q FROM ({ptrace})")
    pfinal = O.product_means(ITERS)
    plinks = ("SELECT DISTINCT a.user_id AS src, b.user_id AS dst FROM rv a JOIN rv b "
              "ON a.product_id = b.product_id AND a.rating = b.rating AND b.hq < a.hq")
    bad_rating = "(votes = 0 AND rating = 3)"
    bad_votes = "(votes = 12 AND rating = 1)"
    node_size = f"({O.h9('hq')} + 1.0) * 1.0 + 1.0"   # (rank+1)*R_MAX/2 + R_MIN
    traj_cols = ", ".join(f"max(CASE WHEN iter = {i} THEN position END) AS pos_{i}" for i in range(ITERS + 1))
    return {
        "reviews_load": W(RV, f"SELECT review_id, product_id, user_id, rating, top, votes, unix_time, {h} AS h FROM rv"),
        "reviews_distinct": W(RV, f"SELECT DISTINCT user_id, product_id, rating, {h} AS h FROM rv"),
        "reviews_quarantine": W(RV, f"SELECT review_id, product_id, user_id, CASE WHEN {bad_rating} THEN 'bad rating' "
                                    f"ELSE 'bad votes' END AS reason FROM rv WHERE {bad_rating} OR {bad_votes}"),
        "review_helpfulness": W(RV, f"SELECT review_id, product_id, user_id, rating, top, votes, {h} AS h FROM rv"),
        "user_helpfulness": W(G0, f"SELECT user_id, {O.h9('hq')} AS h, n_reviews FROM m"),
        "product_summary": W(RV, f"SELECT product_id, count(*) AS n_reviews, count(DISTINCT user_id) AS n_users, "
                                 f"{O.h9('CAST(round(avg(hq)) AS bigint)')} AS mean_h FROM rv GROUP BY product_id"),
        "general_links": W(G0, "SELECT src, dst FROM links"),
        "general_out_degree": W(G0, "SELECT src, deg FROM deg"),
        "general_contributions": W(G1, f"SELECT dst, {O.r6(O.q9('add'))} AS add FROM a1"),
        "general_rank": W(G, f"SELECT user_id, {O.r6('rq')} AS rank FROM g{ITERS}"),
        "general_trace": W(G, f"SELECT iter, user_id, {O.r6('rank_q')} AS rank FROM ({O.general_trace_union(ITERS)})"),
        "product_links": W(RV, plinks),
        "product_links_final": W(P, f"SELECT DISTINCT a.user_id AS src, b.user_id AS dst FROM s{ITERS} a JOIN s{ITERS} b "
                                    f"ON a.product_id = b.product_id AND a.rating = b.rating AND b.hq < a.hq"),
        "product_contributions": W(P1, f"SELECT product_id, user_id, rating, {h} AS h, e, {O.r6(O.q9('c'))} AS c, "
                                       f"{O.r6(O.q9('n'))} AS n, {O.r6(O.q9('p'))} AS p FROM x1"),
        "product_collapse": W(P1, f"SELECT product_id, user_id, rating, {h} AS h FROM s1"),
        "product_rank": W(P, f"SELECT user_id, {O.r6('rank_q')} AS rank FROM ({pfinal})"),
        "product_trace": W(P, f"SELECT iter, user_id, {O.r6('rank_q')} AS rank FROM ({ptrace})"),
        "leaderboard": W(P, f"SELECT iter, position, user_id, {O.r6('rank_q')} AS rank, "
                            f"{O.label('position', 'user_id', O.h9('rank_q'))} AS label FROM ({board})"),
        "general_leaderboard": W(G, f"SELECT iter, position, user_id, {O.r6('rank_q')} AS rank, "
                                    f"{O.label('position', 'user_id', O.h9('rank_q'))} AS label FROM ("
                                    f"SELECT iter, row_number() OVER (PARTITION BY iter ORDER BY rank_q DESC, user_id) "
                                    f"AS position, user_id, rank_q FROM ({O.general_trace_union(ITERS)}))"),
        "top_users": W(P, f"SELECT position, user_id, {O.r6('rank_q')} AS rank FROM (SELECT row_number() OVER "
                          f"(ORDER BY rank_q DESC, user_id) AS position, user_id, rank_q FROM ({pfinal})) "
                          f"WHERE position <= {TOP_K}"),
        "rank_trajectory": W(P, f"SELECT user_id, {traj_cols} FROM ({board}) GROUP BY user_id"),
        "rank_bands": W(P, f"SELECT user_id, {O.r6('rank_q')} AS rank, {O.band(O.h9('rank_q'))} AS band, "
                           f"{O.colour(O.band(O.h9('rank_q')))} AS colour FROM ({pfinal})"),
        "user_lookup": W(G, f"SELECT CAST(c.c_custkey AS varchar) AS key, g.user_id, {O.r6('g.rq')} AS rank "
                            f"FROM customer c JOIN g{ITERS} g ON CAST(c.c_custkey AS varchar) = g.user_id"),
        "graph_nodes": W(G0, f"SELECT user_id AS id, {O.r6('hq')} AS rank, {O.band(O.h9('hq'))} AS band, "
                             f"{O.colour(O.band(O.h9('hq')))} AS colour, "
                             f"{O.r6(O.q9(node_size))} AS node_size FROM m"),
        "graph_links": W(G0, f"SELECT l.src AS source, l.dst AS target, {O.r6('a.hq')} AS source_rank, "
                             f"{O.r6('b.hq')} AS target_rank FROM links l JOIN m a ON l.src = a.user_id "
                             f"JOIN m b ON l.dst = b.user_id"),
        "result_lines": W(P, f"SELECT printf('(%s,%.6f)', user_id, {O.r6('rank_q')}) AS value FROM ({pfinal})"),
        "result_roundtrip": W(P, f"SELECT user_id, {O.r6('rank_q')} AS rank FROM ({pfinal})"),
        "runlog_events": W(P + [("pl", plinks)],
                           f"SELECT 'node' AS kind, iter, user_id AS id, {O.r6('rank_q')} AS rank, "
                           f"CAST(NULL AS varchar) AS source, CAST(NULL AS varchar) AS target FROM ({ptrace}) "
                           f"UNION ALL SELECT 'link', 0, NULL, NULL, src, dst FROM pl"),
    }


def _more_sql(sql: dict[str, str]) -> dict[str, str]:
    W = O.with_ctes
    G, G0 = O.general_ctes(LAMBDA, ITERS), O.general_ctes(LAMBDA, 0)
    G3, strong = O.general_ctes(LAMBDA, BATCH_ITERS), O.general_ctes(STRONG_LAMBDA, ITERS)
    P, P3, RV = O.product_ctes(LAMBDA, ITERS), O.product_ctes(LAMBDA, BATCH_ITERS), O.review_ctes()

    def nodes(iters: int, id_: str) -> str:
        return (f"SELECT iter, printf('{{\"id\":\"%s\",\"rank\":%.6f}}', {id_}, {O.r6('rank_q')}) AS json "
                f"FROM ({O.product_trace_union(iters)})")

    def events(trace: str, links: str) -> str:
        return (f"SELECT 'node' AS kind, iter, user_id AS id, {O.r6('rank_q')} AS rank, CAST(NULL AS varchar) AS source, "
                f"CAST(NULL AS varchar) AS target FROM ({trace}) UNION ALL SELECT 'link', 0, NULL, NULL, src, dst FROM {links}")

    links = "printf('{\"source\":\"%s\",\"target\":\"%s\"}', src, dst) AS json"
    cut = ("CASE CAST(user_id AS bigint) % 3 WHEN 0 THEN '[{\"id\":\"' || user_id || '\",\"rank\":0.' "
           "ELSE '[{\"id\":\"' || user_id || '\"}]' END")
    band = O.band(O.h9("rank_q"))
    return {
        "runlog_stream": sql["runlog_events"],
        "general_rank_it3": W(G3, f"SELECT user_id, {O.r6('rq')} AS rank FROM g{BATCH_ITERS}"),
        "general_rank_clamped": W(strong, f"SELECT user_id, {O.r6('rq')} AS rank FROM g{ITERS}"),
        "general_rank_heavy": sql["general_rank"],
        "general_out_degree_heavy": sql["general_out_degree"],
        "general_links_blocks": sql["general_links"],
        "product_rank_hot": sql["product_rank"],
        "product_trace_hot": sql["product_trace"],
        "product_links_blocks": sql["product_links"],
        "band_histogram": W(P, f"SELECT {band} AS band, {O.colour(band)} AS colour, count(*) AS n_users "
                               f"FROM ({O.product_means(ITERS)}) GROUP BY ALL"),
        "user_lookup_letters": W(P3, f"SELECT 'uSER' || CAST(c_custkey AS varchar) AS key, 'User' || user_id AS user_id, "
                                     f"{O.r6('rank_q')} AS rank FROM customer JOIN ({O.product_means(BATCH_ITERS)}) "
                                     f"ON user_id = CAST(c_custkey AS varchar)"),
        "product_graph_links_final": W(
            P + [("pm", O.product_means(ITERS)),
                 ("pl", f"SELECT DISTINCT a.user_id AS src, b.user_id AS dst FROM s{ITERS} a JOIN s{ITERS} b "
                        f"ON a.product_id = b.product_id AND a.rating = b.rating AND b.hq < a.hq")],
            f"SELECT src AS source, dst AS target, {O.r6('a.rank_q')} AS source_rank, {O.r6('b.rank_q')} AS target_rank "
            f"FROM pl JOIN pm a ON a.user_id = src JOIN pm b ON b.user_id = dst"),
        "result_quarantine": W(P, f"SELECT printf('(%s,%.6f', user_id, {O.r6('rank_q')}) AS value FROM "
                                  f"({O.product_means(ITERS)}) WHERE printf('%.6f', {O.r6('rank_q')}) LIKE '-%'"),
        "nodes_json": W(P, nodes(ITERS, "user_id")),
        "nodes_json_quoted": W(P3, nodes(BATCH_ITERS, "'u' || user_id")),
        "links_json": W(RV, f"SELECT {links} FROM ({sql['product_links'].split(chr(10))[-1]})"),
        "general_links_json": W(G0, f"SELECT {links} FROM links"),
        "general_runlog_events": W(G, events(O.general_trace_union(ITERS), "links")),
        "runlog_dead_letters": W(RV, f"SELECT 'nodesIter1' AS tag, 'INFO driver: #nodesIter1#' || {cut} AS value, "
                                     "CASE CAST(user_id AS bigint) % 3 WHEN 0 THEN 'payload is not a whole array' "
                                     "ELSE 'record without its fields' END AS reason "
                                     "FROM (SELECT DISTINCT user_id FROM rv) WHERE CAST(user_id AS bigint) % 3 < 2"),
        "graph_stream": sql["graph_links"],
        "partition_report": W(RV, "SELECT CAST(NULL AS varchar) AS user_id, count(*) AS n_rows, "
                                  "count(DISTINCT product_id) AS n_keys, 1.0::double AS share FROM rv UNION ALL "
                                  "SELECT user_id, count(*), NULL, round(count(*) / (SELECT count(*) FROM rv) * 1e6) / 1e6 "
                                  f"FROM rv GROUP BY user_id HAVING count(*) >= ceil((SELECT count(*) FROM rv) * {LEAST_SHARE}::double)"),
    }


def oracle_sql() -> dict[str, str]:
    sql = _sql()
    return sql | _more_sql(sql)
