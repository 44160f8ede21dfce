"""Review sources: the headered review CSV and a view over the driver tables.

Both produce the same flat schema (``REVIEW_COLUMNS``):

    review_id long, product_id string, user_id string, rating int,
    top double, votes double, unix_time long, hq long

``hq`` is the review's helpfulness in 1e-9 units (see functions.scalar).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalar import helpfulness, parse_votes, quantize

REVIEW_COLUMNS = ["review_id", "product_id", "user_id", "rating", "top", "votes", "unix_time", "hq"]

# Positional schema of the review CSV; the header's first column is unnamed.
# Rating is read as text so that a bad value can be reported (strict mode)
# or quarantined instead of silently becoming null.
CSV_SCHEMA = (
    "review_id long, asin string, helpful string, overall string, "
    "reviewerID string, unixReviewTime long, _corrupt_record string"
)


def _finish(df: DataFrame) -> DataFrame:
    return df.withColumn("hq", quantize(helpfulness(F.col("top"), F.col("votes")))).select(*REVIEW_COLUMNS)


def _csv_rows(spark: SparkSession, path: str | list[str]) -> DataFrame:
    raw = (
        spark.read.schema(CSV_SCHEMA)
        .option("header", True)          # per file: a header in every part is dropped
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "_corrupt_record")
        .csv(path)
    )
    votes = parse_votes(F.col("helpful"))
    return raw.select(
        F.col("review_id"),
        F.col("asin").alias("product_id"),
        F.col("reviewerID").alias("user_id"),
        F.expr("try_cast(trim(overall) AS int)").alias("rating"),
        F.col("overall").alias("_rating_text"),
        F.when(F.size(votes) == 2, votes[0]).alias("top"),
        F.when(F.size(votes) == 2, votes[1]).alias("votes"),
        F.col("unixReviewTime").alias("unix_time"),
        F.col("_corrupt_record"),
    )


def _bad_row(df: DataFrame):
    return (
        F.col("_corrupt_record").isNotNull()
        | F.col("rating").isNull()
        | F.col("top").isNull()
        | F.col("votes").isNull()
        | F.col("product_id").isNull()
        | F.col("user_id").isNull()
    )


def load_reviews(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Strict load: any malformed row fails the job, naming the row.

    The failure is raised inside the scan's tasks (``raise_error``), so it
    costs nothing extra on clean data and needs no driver-side check.
    """
    rows = _csv_rows(spark, path)
    checked = rows.withColumn(
        "_ok",
        F.when(
            _bad_row(rows),
            F.raise_error(
                F.concat(
                    F.lit("malformed review row: "),
                    F.coalesce(F.col("_corrupt_record"), F.to_json(F.struct("review_id", "product_id", "_rating_text", "user_id"))),
                )
            ),
        ).otherwise(F.lit(True)),
    ).filter(F.col("_ok"))
    return _finish(checked)


def load_reviews_quarantine(spark: SparkSession, path: str | list[str]) -> tuple[DataFrame, DataFrame]:
    """Lenient load: returns (good reviews, bad rows with a reason)."""
    rows = _csv_rows(spark, path)
    good = _finish(rows.filter(~_bad_row(rows)))
    bad = rows.filter(_bad_row(rows)).select(
        "review_id",
        "product_id",
        "user_id",
        "_rating_text",
        "top",
        "votes",
        quarantine_reason().alias("reason"),
        "_corrupt_record",
    )
    return good, bad


def quarantine_reason():
    return (
        F.when(F.col("_corrupt_record").isNotNull(), F.lit("malformed line"))
        .when(F.col("product_id").isNull(), F.lit("missing product"))
        .when(F.col("user_id").isNull(), F.lit("missing user"))
        .when(F.col("rating").isNull(), F.lit("bad rating"))
        .otherwise(F.lit("bad votes"))
    )


# The driver tables hold no reviews; this integer-only view derives them
# from lineitem x orders (one review per line item).  Same text in Spark SQL
# and DuckDB apart from the type name and the epoch function.
REVIEWS_FROM_TABLES_SQL = """
SELECT l_orderkey*10 + l_linenumber                                     AS review_id,
       CAST(l_partkey AS {string})                                      AS product_id,
       CAST(o_custkey AS {string})                                      AS user_id,
       CAST(1 + (l_orderkey*7 + l_linenumber*3 + l_suppkey) % 5 AS int) AS rating,
       CAST((l_orderkey*31 + l_partkey*17) % ((CAST(l_quantity AS int) % 13) + 1) AS double) AS top,
       CAST(CAST(l_quantity AS int) % 13 AS double)                     AS votes,
       {epoch}                                                          AS unix_time
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
"""


def reviews_from_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reviews derived from ``lineitem`` and ``orders`` under ``sf_dir``.

    Only the six referenced columns are read (column pruning reaches the
    parquet scan); the join is a shuffle join on the order key, which AQE
    may turn into a broadcast when orders is small.
    """
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity"
    )
    od = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", "o_custkey", "o_orderdate")
    q = F.col("l_quantity").cast("int")
    votes = q % 13
    top = (F.col("l_orderkey") * 31 + F.col("l_partkey") * 17) % (votes + 1)
    df = li.join(od, li.l_orderkey == od.o_orderkey).select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("review_id"),
        F.col("l_partkey").cast("string").alias("product_id"),
        F.col("o_custkey").cast("string").alias("user_id"),
        (F.lit(1) + (F.col("l_orderkey") * 7 + F.col("l_linenumber") * 3 + F.col("l_suppkey")) % 5).cast("int").alias("rating"),
        top.cast("double").alias("top"),
        votes.cast("double").alias("votes"),
        F.unix_timestamp(F.col("o_orderdate")).alias("unix_time"),
    )
    return _finish(df)


def reviews_sql(spark_dialect: bool = False) -> str:
    """The view as SQL text (DuckDB by default), with ``hq`` added."""
    if spark_dialect:
        base = REVIEWS_FROM_TABLES_SQL.format(string="string", epoch="unix_timestamp(o_orderdate)")
    else:
        base = REVIEWS_FROM_TABLES_SQL.format(string="varchar", epoch="CAST(epoch(o_orderdate) AS bigint)")
    return (
        "SELECT *, CAST(round((CASE WHEN votes = 0 THEN CAST(0 AS double) "
        "ELSE (2*top - votes)/votes END) * 1000000000.0) AS bigint) AS hq FROM (" + base + ")"
    )
