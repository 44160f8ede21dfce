"""All Product iterations of whole products, in one pass over sorted rows.

Spark deals out the rows by product and sorts them inside each partition; a
task gets them as Arrow batches, cuts these where a product ends and runs every
iteration of the products it has, with the arithmetic of ``operators.product``
(same doubles, same integer lanes of shares) on numpy arrays.  A product is held
whole, which ``product.HOT_PRODUCT_ROWS`` bounds; all else is a batch at a time.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from ..functions.scalar import LANE_BITS, SCALE, SHARE_MOST, SHARE_SCALE

LOWEST = np.iinfo(np.int64).min   # a missing h stands below all others


def _changes(column: pa.Array) -> np.ndarray:
    """Places (from 1) whose value differs from the one before; nulls are equal."""
    here, before = column.slice(1), column.slice(0, len(column) - 1)
    differ = pc.fill_null(pc.not_equal(here, before), False)
    return np.flatnonzero(pc.or_(differ, pc.not_equal(here.is_null(), before.is_null()))) + 1


def whole_products(batches: Iterator[pa.RecordBatch], keys: tuple[str, ...] = ("product_id",)) -> Iterator[pa.RecordBatch]:
    """The same rows in batches that end where a product (a value of ``keys``) ends."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        last = max((int(x[-1]) for x in (_changes(batch.column(k)) for k in keys) if len(x)), default=0)
        if last:
            held.append(batch.slice(0, last))
        if held and (last or any(held[-1].column(k)[-1].as_py() != batch.column(k)[0].as_py() for k in keys)):
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held = []
        held.append(batch.slice(last))
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def _codes(column: pa.Array) -> tuple[np.ndarray, int]:
    coded = column.dictionary_encode(null_encoding="encode")
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), max(1, len(coded.dictionary))


def _lanes(share: np.ndarray) -> list[np.ndarray]:
    units = np.floor(np.minimum(SHARE_MOST, np.maximum(-SHARE_MOST, share)) * SHARE_SCALE + 0.5).astype(np.int64)
    return [units >> LANE_BITS, units & ((1 << LANE_BITS) - 1)]


def received(group: np.ndarray, h: np.ndarray, lam: float) -> list[np.ndarray]:
    """Lanes of the negative and of the positive shares each row receives."""
    n = len(h)
    order = np.lexsort((h, group))
    g, v = group[order], h[order]
    new_group = np.concatenate(([True], g[1:] != g[:-1]))
    new_level = new_group | np.concatenate(([True], v[1:] != v[:-1]))
    starts, levels = np.flatnonzero(new_group), np.flatnonzero(new_level)
    of_group, of_level = np.cumsum(new_group) - 1, np.cumsum(new_level) - 1
    e = levels[of_level] - starts[of_group]   # rows with strictly lower h
    share = np.where(e > 0, v / float(SCALE) / (np.maximum(e, 1) * float(lam)), 0.0)
    group_end, level_end = np.append(starts[1:], n)[of_group], np.append(levels[1:], n)[of_level]
    out = []
    for lane in _lanes(np.minimum(share, 0.0)) + _lanes(np.maximum(share, 0.0)):
        upto = np.concatenate(([0], np.cumsum(lane)))
        above = np.empty(n, np.int64)
        above[order] = upto[group_end] - upto[level_end]
        out.append(above)
    return out


def moved(h: np.ndarray, lanes: list[np.ndarray]) -> np.ndarray:
    """h after receiving: ``product._moved``."""
    n, p = ((lanes[i].astype(float) * float(1 << LANE_BITS) + lanes[i + 1].astype(float)) / SHARE_SCALE for i in (0, 2))
    start = np.minimum(1.0, np.maximum(-1.0, h / float(SCALE)))
    scaled = np.minimum(1.0, np.maximum(-1.0, start + n) + p) * float(SCALE)
    whole = np.floor(np.abs(scaled))
    return (np.sign(scaled) * (whole + (np.abs(scaled) - whole >= 0.5))).astype(np.int64)


def _iterated(batch: pa.RecordBatch, lam: float, iters: int, history: bool) -> pa.RecordBatch:
    product = np.zeros(batch.num_rows, np.int64)
    product[_changes(batch.column("product_id"))] = 1
    product = np.cumsum(product)
    rating, ratings = _codes(batch.column("rating"))
    user, users = _codes(batch.column("user_id"))
    known = batch.column("hq").is_valid().to_numpy(zero_copy_only=False)
    h = np.where(known, batch.column("hq").fill_null(0).to_numpy(zero_copy_only=False), LOWEST)
    group = product * ratings + rating
    lanes = received(group, h, lam)
    # rows of one user in one product become one: the first has its rating and h
    one = product * users + user
    order = np.argsort(one, kind="stable")
    starts = np.flatnonzero(np.concatenate(([True], one[order][1:] != one[order][:-1])))
    first = order[starts]

    def summed(values: np.ndarray) -> np.ndarray:
        return np.add.reduceat(values[order], starts)

    group, start = group[first], h
    h = moved(h[first], [summed(x) for x in lanes])
    states = [h]
    for _ in range(1, iters):
        h = moved(h, received(group, h, lam))
        states.append(h)
    kept = pa.array(first)
    columns = {name: batch.column(name).take(kept) for name in ("product_id", "user_id", "rating")} | {"hq": pa.array(h)}
    if history:
        start = np.where(known, start, 0)
        none = summed(known.astype(np.int64)) == 0
        columns |= {
            "s0_hi": pa.array(summed(start >> 32), mask=none), "s0_lo": pa.array(summed(start & 0xFFFFFFFF), mask=none),
            "n0": pa.array(summed(np.ones(len(start), np.int64))),
            "hist": pa.ListArray.from_arrays(
                pa.array(np.arange(len(h) + 1, dtype=np.int32) * iters), pa.array(np.column_stack(states).ravel())),
        }
    return pa.RecordBatch.from_pydict(columns)


GROUP = ("product_id", "rating")


def _groups(batch: pa.RecordBatch) -> np.ndarray:
    """Numbers of the (product, rating) groups of rows sorted by them."""
    new = np.zeros(batch.num_rows, np.int64)
    for key in GROUP:
        new[_changes(batch.column(key))] = 1
    return np.cumsum(new)


def _first_shares(batch: pa.RecordBatch, lam: float) -> pa.RecordBatch:
    group = _groups(batch)
    user, users = _codes(batch.column("user_id"))
    known = batch.column("hq").is_valid().to_numpy(zero_copy_only=False)
    h = np.where(known, batch.column("hq").fill_null(0).to_numpy(zero_copy_only=False), LOWEST)
    lanes = received(group, h, lam)
    # a row without h counts as a receiver, and goes no further
    rows = np.flatnonzero(known)
    one = (group * users + user)[rows]
    order = np.argsort(one, kind="stable")
    starts = np.flatnonzero(np.concatenate(([True], one[order][1:] != one[order][:-1]))) if len(rows) else rows

    def summed(values: np.ndarray) -> pa.Array:
        return pa.array(np.add.reduceat(values[rows][order], starts) if len(rows) else values[rows])

    first = pa.array(rows[order][starts])
    columns = {name: batch.column(name).take(first) for name in batch.schema.names}
    columns |= {name: summed(x) for name, x in zip(("n_hi", "n_lo", "p_hi", "p_lo"), lanes)}
    columns |= {"s0_hi": summed(h >> 32), "s0_lo": summed(h & 0xFFFFFFFF), "n0": summed(np.ones(len(h), np.int64))}
    return pa.RecordBatch.from_pydict(columns)


def first_shares(lam: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For ``mapInArrow`` over rows sorted by (product, rating) and, inside them,
    by what decides on a user's first row: a user's first row in a group with the
    lanes all its rows there receive in the first iteration, and the sum (in
    halves) and number of their h."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in whole_products(batches, GROUP):
            yield _first_shares(batch, lam)

    return run


def later_iterations(lam: float, iters: int, history: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For ``mapInArrow`` over rows after the first iteration, sorted by
    (product, rating): the same rows after ``iters`` iterations."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in whole_products(batches, GROUP):
            group, h = _groups(batch), batch.column("hq").to_numpy(zero_copy_only=False)
            states = [h]
            for _ in range(1, iters):
                h = moved(h, received(group, h, lam))
                states.append(h)
            columns = {name: batch.column(name) for name in batch.schema.names} | {"hq": pa.array(h)}
            if history:
                columns["hist"] = pa.ListArray.from_arrays(
                    pa.array(np.arange(len(h) + 1, dtype=np.int32) * iters), pa.array(np.column_stack(states).ravel()))
            yield pa.RecordBatch.from_pydict(columns)

    return run


def iterations(lam: float, iters: int, history: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For ``mapInArrow`` over rows (product_id, user_id, rating, hq) sorted by
    product and, inside it, by what decides on a user's first row: the rows
    after ``iters`` >= 1 iterations."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in whole_products(batches):
            yield _iterated(batch, lam, iters, history)

    return run
