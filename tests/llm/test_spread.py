"""Hot keys, long texts and other things that must not meet in one task."""

import gzip
import random
import time
import zipfile

import pytest
from pyspark.sql import functions as F

from peerrank.llm import common, pii, vptree, warczip


@pytest.mark.parametrize("hot_keys", [2, 10, 10_000])
def test_join_spread_equals_a_left_join(spark, hot_keys, monkeypatch):
    monkeypatch.setattr(common, "HOT_KEYS", hot_keys)
    rng = random.Random(3)
    keys = [b"a"] * 60 + [b"b"] * 25 + [rng.choice([b"c", b"d", b"e", None]) for _ in range(40)]
    left = spark.createDataFrame(
        [(k, i if i % 9 else None, "x") for i, k in enumerate(keys)], "key binary, id long, _hot_values string"
    )
    right = left.filter("key is not null and key != X'65'").groupBy("key").agg(
        F.min("id").alias("least"), F.when(F.first("key") != F.unhex(F.lit("61")), F.lit(1)).alias("maybe"), F.count("*").alias("n")
    )
    got = common.join_spread(left, right, "key", "n", ["id"])
    assert got.columns == ["key", "id", "_hot_values", "least", "maybe"]

    def rows(df):
        return sorted(map(repr, df.select(*got.columns).collect()))

    assert rows(got) == rows(left.join(right, "key", "left"))
    assert common.join_spread(left, right.limit(0), "key", "n", ["id"]).count() == len(keys)
    assert common.join_spread(left.limit(0), right, "key", "n", ["id"]).count() == 0


def test_rows_of_a_hot_key_stay_in_many_tasks(spark):
    left = spark.range(40_000).select(F.when(F.col("id") % 3 > 0, F.lit(7)).otherwise(F.col("id")).alias("key"), "id")
    left = left.repartition(8, "id")
    right = left.groupBy("key").agg(F.min("id").alias("least"), F.count("*").alias("n"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        tasks = common.join_spread(left, right, "key", "n", ["id"]).groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert max(r["count"] for r in tasks) < 2 * 40_000 / len(tasks) and len(tasks) > 1


def spans_of(spark, text):
    row = pii.pii_report(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()[0]
    return row, [tuple(x.split(":")) for x in row.spans.split(",") if x]


@pytest.mark.parametrize("n", [1, 63, 64, 65, 128, 1_000])
def test_spans_over_run_borders(spark, n):
    pieces, want, at = [], [], 0
    for i in range(n):
        mail, gap = f"user{i}@mail{i % 7}.com", " \U0001f600é " * (i % 3 + 1)
        want.append(("email", str(at), str(at + len(mail))))
        pieces += [mail, gap]
        at += len(mail) + len(gap)
    assert spans_of(spark, "".join(pieces))[1] == want


def test_an_iban_hides_starts_inside_it_over_run_borders(spark):
    one = "DE89 3704 0044 0532 0130 00"
    # the text behind "GB82 WEST ..." holds what looks like the start of another
    text = ", ".join([one, "GB82 WEST 1234 5698 7654 32"] * 50)
    want, at = [], 0
    for value in text.split(", "):
        want.append(("iban", str(at), str(at + len(value))))
        at += len(value) + 2
    assert [s for s in spans_of(spark, text)[1] if s[0] == "iban"] == want


def test_context_at_piece_borders(spark):
    for before in (pii.PIECE - 60, pii.PIECE - 20, pii.PIECE - 5, pii.PIECE, 3 * pii.PIECE - 12):
        for word, score in (("mail", 1.0), ("example", 0.6), ("other", 0.9)):
            text = "é" * (before - len(word) - 2) + f" {word} a@b.com" + " " * 100
            assert spans_of(spark, text)[0].max_score == score
            text = "é" * (before - 8) + f" a@b.com {word} " + "é" * 100
            assert spans_of(spark, text)[0].max_score == score


def test_many_spans_in_one_text_take_time_in_proportion(spark):
    def seconds(n):
        began = time.time()
        row, _ = spans_of(spark, " ".join(f"a{i}@b{i}.com" for i in range(n)))
        assert row.n_email == n
        return time.time() - began

    seconds(500)
    assert seconds(24_000) < 30


def test_each_shard_has_a_partition(spark):
    shards = 23
    rows = spark.range(2_000).select((F.col("id") % shards).alias("shard")).repartitionById(shards, F.col("shard").cast("int"))
    placed = rows.groupBy(F.spark_partition_id().alias("p")).agg(F.count_distinct("shard").alias("n")).collect()
    assert sorted(r.p for r in placed) == list(range(shards)) and all(r.n == 1 for r in placed)


def test_search_over_many_shards_with_odd_vectors(spark):
    rng = random.Random(5)
    rows = [(i, [rng.gauss(0, 1) for _ in range(8)]) for i in range(600)]
    rows += [(600, None), (601, [0.0] * 8), (602, [1.0] * 7 + [None]), (603, [float("inf")] * 8), (604, [float("nan")] * 8)]
    rows += [(605, rows[3][1]), (606, rows[3][1])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {}
    for r in vptree.nearest(table, table.filter("vec_id % 100 = 3"), k=5, factor=1.0, shard_rows=50).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id))
    fine = [(i, v) for i, v in rows if i < 600 or i > 604]
    for q, found in got.items():
        own = dict(rows)[q]
        near = sorted((sum((a - b) ** 2 for a, b in zip(v, own, strict=True)), i) for i, v in fine if i != q)
        assert [i for _, i in sorted(found)] == [i for _, i in near[:5]]
    assert sorted(got) == [3, 103, 203, 303, 403, 503]
    few = vptree.nearest(table.filter("vec_id < 3"), table.filter("vec_id = 0"), k=10, factor=1.0)
    assert sorted(r.vec_id for r in few.collect()) == [1, 2]


def test_records_carry_their_date_and_hot_payloads_are_revisits(spark, tmp_path):
    hot = "<p>" + "x" * 200_000 + "</p>"
    pages = [(i, f"http://u/{i}", hot if i % 3 else f"<p>{i}</p>") for i in range(90)] + [(4, "http://u/4", hot), (None, None, hot)]
    table = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("digest", F.lit("clash"))
    manifest = warczip.write_packages(table, str(tmp_path / "w"), date="2024-02-29T01:02:03Z")
    for entry in manifest:
        with zipfile.ZipFile(entry["path"].removeprefix("file:")) as z:
            data = gzip.decompress(z.read(warczip.WARC_MEMBER))
        heads = [x for x in data.split(b"WARC/1.1\r\n") if x]
        assert heads and all(b"WARC-Date: 2024-02-29T01:02:03Z\r\n" in x.partition(b"\r\n\r\n")[0] for x in heads)
    got = warczip.read_packages(spark, [m["path"] for m in manifest]).collect()
    assert len(got) == len(pages)
    for r in got:
        revisits = r.page_id is None or (r.page_id % 3 and r.page_id != 1)
        assert (r.record_type, r.refers_to) == (("revisit", 1) if revisits else ("response", None))
        assert r.payload_bytes == (len(hot) if revisits or r.page_id == 1 else len(f"<p>{r.page_id}</p>"))
    with pytest.raises(ValueError):
        warczip.write_packages(table, str(tmp_path / "v"), date="yesterday")
