"""Result sinks and read-back.

* result lines ``(user,rank)``: text, written by all tasks in parallel;
  ``single_file=True`` funnels into one task like the original output.
* node / link JSON: one array per iteration, as the original printed, written by
  all tasks: the part files of an array hold its pieces in order, and joined byte
  by byte they are the array.  No task or row holds more than its piece.
* trace: parquet partitioned by iteration; a streaming reader can tail it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.scalar import strip_quotes
from ..operators.joins import join_small
from ..session import cut_lineage

RESULT_LINE = r"^\((.*),([^,]*)\)$"


def result_lines(ranks: DataFrame, float_text: bool = False) -> DataFrame:
    """``(user,rank)`` text lines.  ``float_text`` prints the rank as a
    32-bit float the way the JVM does; otherwise six fixed decimals."""
    if float_text:
        value = F.col("rank").cast("float").cast("string")
    else:
        value = F.format_string("%.6f", F.col("rank"))
    return ranks.select(F.format_string("(%s,%s)", F.col("user_id"), value).alias("value"))


def write_result(ranks: DataFrame, path: str, mode: str = "errorifexists", single_file: bool = False,
                 float_text: bool = False) -> None:
    out = result_lines(ranks, float_text)
    if single_file:
        out = out.coalesce(1)
    out.write.mode(mode).text(path)


def _result_rows(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select(
        "value",
        F.col("value").rlike(RESULT_LINE).alias("_shaped"),
        F.regexp_extract("value", RESULT_LINE, 1).alias("user_id"),
        F.expr(f"try_cast(regexp_extract(value, r'{RESULT_LINE}', 2) AS double)").alias("rank"),
    )


def read_result(spark: SparkSession, path: str) -> DataFrame:
    """Reads result lines back (all part files) as ``(user_id, rank)``.  A line
    that is none fails the job, naming it."""
    rows = _result_rows(spark, path)
    good = F.col("_shaped") & F.col("rank").isNotNull()
    checked = F.when(good, F.lit(True)).otherwise(F.raise_error(F.concat(F.lit("malformed result line: "), F.col("value"))).cast("boolean"))
    return rows.filter(checked).select("user_id", "rank")


def read_result_quarantine(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(good ``(user_id, rank)``, lines that are none)."""
    rows = _result_rows(spark, path)
    good = F.col("_shaped") & F.col("rank").isNotNull()
    return rows.filter(good).select("user_id", "rank"), rows.filter(~good).select("value")


def node_records(trace: DataFrame) -> DataFrame:
    """JSON-lines form of the node payload: one record per (iter, user)."""
    return trace.select("iter", strip_quotes(F.col("user_id")).alias("id"), "rank")


def link_records(links: DataFrame) -> DataFrame:
    return links.select(
        strip_quotes(F.col("src")).alias("source"), strip_quotes(F.col("dst")).alias("target")
    ).dropDuplicates()


# --- arrays over many part files ------------------------------------------------


def array_lines(records: DataFrame, order: list[str], group: str | None = None, partitions: int | None = None) -> DataFrame:
    """One line per record, ``(value, group)``, dealt out and sorted so that the
    lines of a group in order make up one JSON array of the other columns.
    ``order`` must be a total order of the records of a group.  One shuffle: a
    line needs to know only whether its record is the first or last of its group."""
    n = partitions or int(records.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by, keys = group or "_array", [group] if group else []
    # written: read for the ends, for the borders of the ranges and for the lines
    grouped = cut_lineage(records if group else records.withColumn(by, F.lit(0)))
    place = F.struct(*order)
    ends = cut_lineage(grouped.groupBy(by).agg(F.min(place).alias("_least"), F.max(place).alias("_most")))
    marked = join_small(grouped, ends, [by]).select(
        *records.columns, place.eqNullSafe(F.col("_least")).alias("_first"), place.eqNullSafe(F.col("_most")).alias("_last"))
    # records of one place (an order that is not total) lie in one range: one of them opens or closes
    w = Window.partitionBy(*keys, *order).orderBy(order[0])
    opens, closes = F.col("_first") & (F.row_number().over(w) == 1), F.col("_last") & F.lead(F.lit(1)).over(w).isNull()
    placed = marked.repartitionByRange(n, *keys, *order).withColumn("_opens", opens).withColumn("_closes", closes)
    value = F.concat(
        F.when(F.col("_opens"), F.lit("[")).otherwise(F.lit(",")), F.to_json(F.struct(*[c for c in records.columns if c != group])),
        F.when(F.col("_closes"), F.lit("]")).otherwise(F.lit("")),
    )
    return placed.sortWithinPartitions(*keys, *order).select(value.alias("value"), *keys)


def write_json_array(records: DataFrame, path: str, order: list[str], group: str | None = None,
                     mode: str = "errorifexists", partitions: int | None = None) -> None:
    """Writes one JSON array per group (folder ``group=value``), each as part
    files that in order of their names join to the array.  A group without
    records has no folder."""
    writer = array_lines(records, order, group, partitions).write.mode(mode)
    (writer.partitionBy(group) if group else writer).text(path)


def array_index(spark: SparkSession, path: str) -> DataFrame:
    """Where each part stands in its array: ``(folder, part, start, bytes)``, so
    that parts can be copied into one object, or a range be read, without
    reading those before it.  A row per part file."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "part-*").load(path)
    parts = files.select(
        F.regexp_extract("path", r"^(.*)/[^/]+$", 1).alias("folder"), F.regexp_extract("path", r"([^/]+)$", 1).alias("part"),
        F.col("length").alias("bytes"),
    )
    before = Window.partitionBy("folder").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return parts.select("folder", "part", F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("start"), "bytes")


def read_json_array(spark: SparkSession, path: str, record: str) -> DataFrame:
    """Records of arrays written by ``write_json_array`` (columns of the DDL
    ``record``, the text ``json``, and the group's column)."""
    lines = spark.read.text(path)
    # a line is [ or , before its record, and ] after the last
    body = F.regexp_extract("value", r"^[\[,](\{.*\})\]?$", 1).alias("json")
    keys = [c for c in lines.columns if c != "value"]
    return lines.select(*keys, body).select("*", F.from_json("json", record, {"mode": "FAILFAST"}).alias("_r")).select(*keys, "json", "_r.*")
