"""Sharding by jump consistent hashing.

A row's key and the number of shards decide its shard; there is no ring or
table to keep.  The key seeds a 64-bit linear congruential generator.  Starting
at shard 0, each draw says at which number of shards the key next moves, and to
which (then newest) shard; the last move below the number of shards counts.  So
one more shard takes each key with probability 1 / shards into itself and moves
no other key.

All of it is column expressions.  The generator works on 64 bits with
wrap-around; the product is put together from 32- and 16-bit parts, since
Spark's multiplication raises an error on overflow.

Keys: one integer column is used as it is (two's complement, 64 bits); anything
else is hashed with xxhash64 over its columns.  A null integer key counts as
the hash of null.  Equal keys share a shard, whatever else differs.

``placed_in_shards`` numbers the rows of a shard from 0 without gaps, in order
of key and content: rows are dealt out by range over (shard, key, content,
row), so a shard or key with most of all rows is numbered by many tasks, and
each slice adds the rows of the slices before it.  Rows alike in all those
columns may change places among themselves.

Defined cases: a null text has no bytes, size 8 and CRC 0; repeated rows are
each placed; an empty table gives none; other columns are not looked at.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.positions import positions
from .common import fresh, written

# Multiplier of the generator (fixed value of the published algorithm).
MULTIPLIER = 2862933555777941757
M32, M16 = 0xFFFFFFFF, 0xFFFF
ROWS_A_FILE = 1_000_000


def _drawn(hi: Column, lo: Column) -> tuple[Column, Column]:
    """The generator's next state (state * MULTIPLIER + 1 modulo 2**64), as 32-bit halves."""
    m_hi, m_lo = MULTIPLIER >> 32, MULTIPLIER & M32
    mid = F.shiftrightunsigned(lo, 16) * F.lit(m_lo)
    low = lo.bitwiseAND(M16) * F.lit(m_lo) + F.lit(1) + F.shiftleft(mid.bitwiseAND(M16), 16)
    cross = F.shiftleft((F.shiftrightunsigned(hi, 16) * F.lit(m_lo)).bitwiseAND(M16), 16)
    high = (
        F.shiftrightunsigned(low, 32) + F.shiftrightunsigned(mid, 16)
        + (lo * F.lit(m_hi)).bitwiseAND(M32) + hi.bitwiseAND(M16) * F.lit(m_lo) + cross
    )
    return high.bitwiseAND(M32), low.bitwiseAND(M32)


def jump_hash(key: Column, shards: int) -> Column:
    """Shard (0 to ``shards`` - 1) of a 64-bit integer key.

    The moves below n shards are about ln n.  A loop of that length with ample
    room serves nearly every key; a second, of as many turns as there are
    shards, is entered only by keys that need more, so any key is exact.
    """
    if shards < 1:
        raise ValueError("at least one shard is needed")

    def turn(s: Column, _: Column) -> Column:
        hi, lo = _drawn(s["hi"], s["lo"])
        # floor((at + 1) * 2**31 / (31 leading bits + 1))
        after = F.floor((s["next"] + 1).cast("double") * (F.lit(float(1 << 31)) / (F.shiftrightunsigned(hi, 1) + 1).cast("double")))
        open_ = s["next"] < shards
        return F.struct(
            F.when(open_, hi).otherwise(s["hi"]).alias("hi"),
            F.when(open_, lo).otherwise(s["lo"]).alias("lo"),
            F.when(open_, s["next"]).otherwise(s["at"]).alias("at"),
            F.when(open_, after).otherwise(s["next"]).alias("next"),
        )

    start = F.struct(
        F.shiftrightunsigned(key, 32).alias("hi"), key.bitwiseAND(F.lit(M32)).alias("lo"),
        F.lit(-1).cast("long").alias("at"), F.lit(0).cast("long").alias("next"),
    )
    turns = min(shards, 16 + 4 * math.ceil(math.log(shards + 1)))
    state = F.aggregate(F.sequence(F.lit(1), F.lit(turns)), start, turn)
    if turns == shards:
        return state["at"].cast("int")

    def to_the_end(s: Column) -> Column:
        rest = F.aggregate(F.sequence(F.lit(1), F.lit(shards)), s, turn)
        return F.when(s["next"] < shards, rest["at"]).otherwise(s["at"])

    return F.transform(F.array(state), to_the_end)[0].cast("int")


def stable_key(df: DataFrame, *columns: str) -> Column:
    """64-bit key of a row (see above)."""
    own = [F.col(c) for c in columns]
    if len(own) == 1 and df.schema[columns[0]].dataType.typeName() in ("byte", "short", "integer", "long"):
        return F.coalesce(own[0].cast("long"), F.xxhash64(own[0]))
    return F.xxhash64(*own)


def with_shard(df: DataFrame, key: str | list[str], shards: int, name: str = "shard") -> DataFrame:
    """``df`` with its rows' shard in column ``name``.  No shuffle."""
    columns = [key] if isinstance(key, str) else list(key)
    return df.withColumn(name, jump_hash(stable_key(df, *columns), shards))


def write_shards(df: DataFrame, key: str | list[str], shards: int, path: str, files_a_shard: int = 1,
                 name: str = "shard", rows_a_file: int = ROWS_A_FILE) -> None:
    """Writes one folder a shard (``name=0`` and so on), each by ``files_a_shard``
    tasks in files of at most ``rows_a_file`` rows: a shard that one key fills is
    still written by several tasks."""
    part, = fresh(df, "_part")
    dealt = with_shard(df, key, shards, name).withColumn(part, F.pmod(F.monotonically_increasing_id(), F.lit(files_a_shard)))
    dealt = dealt.repartition(shards * files_a_shard, name, part).drop(part)
    dealt.write.partitionBy(name).option("maxRecordsPerFile", rows_a_file).parquet(path)


def placed_in_shards(df: DataFrame, key: str = "doc_id", text: str = "text", shards: int = 24) -> DataFrame:
    """(key, size, text_crc32, law, shard, slot, grown_shard) of every row;
    ``grown_shard`` is its shard when one more is appended."""
    content = F.coalesce(F.encode(F.col(text), "UTF-8"), F.lit(b""))
    seed = stable_key(df, key)
    narrow = written(df.select(
        F.col(key),
        (F.length(content) + 8).cast("long").alias("size"),
        F.crc32(content).alias("text_crc32"),
        F.lit("key").alias("law"),
        jump_hash(seed, shards).alias("shard"),
        jump_hash(seed, shards + 1).alias("grown_shard"),
        F.monotonically_increasing_id().alias("_row"),
    ), "sharding")
    order = [F.col(key).asc_nulls_first(), F.col("text_crc32").asc(), F.col("size").asc(), F.col("_row").asc()]
    numbered = positions(narrow, order, group="shard", name="slot")
    return numbered.select(key, "size", "text_crc32", "law", "shard", (F.col("slot") - 1).alias("slot"), "grown_shard")
