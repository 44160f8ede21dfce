"""Joins against derived tables whose size is only known at run time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage, is_cut, shuffles_deleted

# Largest table that is broadcast to every executor, by its size in memory.
BROADCAST_MAX_BYTES = 64 << 20
ROW_BYTES = 16   # a row's own overhead


def _value_bytes(value: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.StringType):
        return F.coalesce(F.octet_length(value), F.lit(0)) + 8
    if isinstance(kind, T.BinaryType):
        return F.coalesce(F.length(value), F.lit(0)) + 8
    if isinstance(kind, T.ArrayType):
        fixed = not isinstance(kind.elementType, (T.StringType, T.BinaryType, T.ArrayType, T.StructType, T.MapType))
        if fixed:
            return F.coalesce(F.size(value), F.lit(0)) * 8 + 16
        inner = F.aggregate(value, F.lit(0).cast("long"), lambda acc, x: acc + _value_bytes(x, kind.elementType))
        return F.coalesce(inner, F.lit(0)) + 16
    if isinstance(kind, T.StructType):
        parts = [_value_bytes(value.getField(f.name), f.dataType) for f in kind.fields]
        return sum(parts[1:], parts[0]) + 8 if parts else F.lit(8)
    return F.lit(8)


def memory_bytes(df: DataFrame) -> int:
    """Bytes of ``df`` in memory, from the lengths of its values (one aggregate)."""
    parts = [_value_bytes(F.col(f"`{f.name}`"), f.dataType) for f in df.schema.fields]
    row = sum(parts, F.lit(ROW_BYTES))
    with shuffles_deleted(df.sparkSession):
        return int(df.agg(F.sum(row.cast("long"))).first()[0] or 0)


def broadcast_if_small(small: DataFrame, max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """``small``, which must be a lineage cut, with a broadcast hint if its
    measured size allows it; without, joins shuffle it and AQE's skew handling
    splits hot keys on the other side.  A cut is measured once."""
    known = getattr(small, "_memory_bytes", None)
    if known is None:
        known = small._memory_bytes = memory_bytes(small)
    return F.broadcast(small) if known <= max_bytes else small


def join_small(big: DataFrame, small: DataFrame, on: list[str], how: str = "inner",
               max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Joins ``big`` with a derived ``small`` table, broadcasting it only if
    its bytes in memory are within ``max_bytes``; otherwise a shuffle join (AQE's
    skew handling splits hot keys on the big side).

    Unless ``small`` is a lineage cut already, it is materialised once, so that
    measuring it does not compute it twice.
    """
    if not is_cut(small):
        small = cut_lineage(small)
    return big.join(broadcast_if_small(small, max_bytes), on, how)
