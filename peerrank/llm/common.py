"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

HOT_KEYS = 10_000  # join_spread: keys with more than one in so many rows are spread


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_folder(spark: SparkSession, kind: str) -> str:
    """URI of a new folder below the cluster's shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{kind}-{uuid.uuid4().hex}"


def written(df: DataFrame, kind: str) -> DataFrame:
    """``df`` written to the shared folder and read back: computed once, and
    no later stage depends on the executors that computed it."""
    spark = df.sparkSession
    path = shared_folder(spark, kind)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """``names``, with a suffix that no column of ``df`` has."""
    taken, suffix = {c.lower() for c in df.columns}, ""
    while any(f"{n}{suffix}".lower() in taken for n in names):
        suffix += "_"
    return [f"{n}{suffix}" for n in names]


def join_spread(left: DataFrame, right: DataFrame, key: str, rows: str, spread: list[str]) -> DataFrame:
    """``left`` left-joined with ``right``, which has one row per ``key`` and in
    ``rows`` how many rows of ``left`` have it; the result has no ``rows``.

    A key with more than one in ``HOT_KEYS`` of all rows does not meet in one
    task: there are fewer than ``HOT_KEYS`` such keys, so they are broadcast and
    their rows go on with the others, dealt by ``spread``, as rows without key do.
    ``right`` is read three times."""
    values = [c for c in right.columns if c not in (key, rows)]
    total = right.agg(F.sum(rows)).first()[0] or 0
    hot_values, rest_values, rest_key, deal = fresh(left, "_hot_values", "_rest_values", "_rest_key", "_deal")
    is_hot = F.col(rows) * F.lit(HOT_KEYS) > F.lit(total)
    hot = right.filter(is_hot).select(key, F.struct(*values).alias(hot_values))
    rest = right.filter(~is_hot).select(
        F.col(key).alias(rest_key), F.lit(0).cast("long").alias(deal), F.struct(*values).alias(rest_values)
    )
    open_ = F.col(key).isNotNull() & F.col(hot_values).isNull()
    dealt = left.join(F.broadcast(hot), key, "left").select(
        *left.columns, hot_values, F.when(open_, F.col(key)).alias(rest_key),
        F.when(open_, F.lit(0).cast("long")).otherwise(F.xxhash64(*spread)).alias(deal),
    )
    joined = dealt.join(rest, [rest_key, deal], "left")
    return joined.select(
        *left.columns, *[F.coalesce(F.col(hot_values)[c], F.col(rest_values)[c]).alias(c) for c in values]
    )


def ascii_lower(text: Column) -> Column:
    """``text`` with A-Z (and no other letter) lower-cased; null becomes ''."""
    return F.translate(
        F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    )


def small_batches(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``rows``: a task holds few texts at
    a time as Python objects.  At the end the worker, which lives on for other
    tasks, gives back what it no longer uses."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
    release_memory()


def release_memory() -> None:
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def bound_batches(spark: SparkSession, rows: int = 1_000) -> None:
    """Texts may be long: no more than ``rows`` of them go to Python at once
    (in both processes a batch is held whole)."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= rows:
        spark.conf.set(name, str(rows))


def text_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text; null is empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]
