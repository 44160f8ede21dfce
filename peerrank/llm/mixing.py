"""Mixing sources to target weights by balanced (cube method) sampling.

Every source gets a target: a share of ``budget`` times all words, by weight,
never above ``cap`` times the source's own size (the excess goes to the other
sources by weight until none is above).  A document is taken
``floor(target / source size)`` times for certain, and once more with
probability equal to the fraction.

Which documents get the extra copy is decided by the cube method.  A vector of
inclusion probabilities moves through the null space of the balancing
constraints (documents and words of the source) until it reaches 0 or 1 in all
but two places.  This runs in blocks of one source each, in parallel; what a
block leaves open (two documents at most) goes into blocks of the next level,
and so on until one block per source is left.  Only its last two documents are
the landing problem, solved by trying every rounding.

Documents with one id, source and size are one unit and share its fate (their
sizes count together).  All order and randomness comes from hashes of the
ids, so reruns agree.

Defined cases: a null text has size 0; a null source is a source of its own,
last in order; a source without words has target 0 and takes 0 words; an empty
table gives an empty result; other columns are ignored by ``mix`` and kept by
``apply_mix``.
"""

from __future__ import annotations

import random
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import fresh, written

EPS = 1e-9
UNIT = "doc_id string, source string, no_source boolean, size long, rows long, whole long, prob double, draw long"


def words_in(text: Column) -> Column:
    """Number of runs of characters other than ASCII white space; null: 0."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[int], budget: float, cap: float) -> DataFrame:
    """``source_size`` and ``target`` for each row of (source, size sums).

    ``sizes``: one row per source (source, no_source, source_size).  Sources
    ordered by ratio of cap to weight stop at their caps first; with the
    capped ones removed, the rest share what is left by weight.  The windows
    run over one narrow row per source.
    """
    order = Window.orderBy(F.col("no_source"), F.col("source"))
    at = F.pmod(F.row_number().over(order) - 1, F.lit(len(weights)))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (at + 1).cast("int"))
    ranked = sizes.withColumn("weight", weight).withColumn("top", F.col("source_size") * F.lit(float(cap)))
    by_ratio = Window.orderBy(F.col("top") / F.col("weight"), F.col("no_source"), F.col("source"))
    everything = Window.partitionBy()
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    level = (
        (F.sum("source_size").over(everything) * F.lit(float(budget)) - F.coalesce(F.sum("top").over(before), F.lit(0.0)))
        / F.sum("weight").over(onward)
    )
    # the first source (by ratio) whose cap the level does not reach sets the level of all after it
    with_level = ranked.withColumn("level", level).withColumn(
        "free", F.when(F.col("level") * F.col("weight") < F.col("top"), F.col("level"))
    )
    shared = F.first("free", ignorenulls=True).over(by_ratio.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return with_level.withColumn("shared", shared).select(
        "source", "no_source", "source_size",
        F.when(F.col("shared").isNull(), F.col("top"))
        .otherwise(F.least(F.col("top"), F.col("shared") * F.col("weight"))).alias("target"),
    )


def flight(sizes: list[float], probs: list[float], rng: random.Random) -> list[float]:
    """Moves ``probs`` until at most two lie strictly between 0 and 1, keeping
    the expected number and the expected size constant.

    Three open places at a time: the vector orthogonal to both constraints is
    their cross product; a random step along it, with zero mean, takes at
    least one place to 0 or 1.
    """
    probs = list(probs)
    live: list[int] = []
    todo = iter([i for i, p in enumerate(probs) if EPS < p < 1 - EPS])
    for nxt in todo:
        live.append(nxt)
        if len(live) < 3:
            continue
        while len(live) >= 3:
            a, b, c = live[:3]
            u = [sizes[b] - sizes[c], sizes[c] - sizes[a], sizes[a] - sizes[b]]
            if not any(u):  # equal sizes: any direction that keeps the number
                u = [1.0, -1.0, 0.0]
            up = down = float("inf")
            for k, i in enumerate((a, b, c)):
                if u[k] > 0:
                    up, down = min(up, (1 - probs[i]) / u[k]), min(down, probs[i] / u[k])
                elif u[k] < 0:
                    up, down = min(up, -probs[i] / u[k]), min(down, (probs[i] - 1) / u[k])
            step = up if rng.random() * (up + down) < down else -down
            for k, i in enumerate((a, b, c)):
                p = probs[i] + step * u[k]
                probs[i] = 0.0 if p < EPS else 1.0 if p > 1 - EPS else p
            live = [i for i in live if 0.0 < probs[i] < 1.0]
    return [0.0 if p <= EPS else 1.0 if p >= 1 - EPS else p for p in probs]


def landing(sizes: list[float], probs: list[float]) -> list[float]:
    """The rounding of the open places (two at most) nearest in size, then in
    number, to what they stand for."""
    places = [i for i, p in enumerate(probs) if 0.0 < p < 1.0]
    want_size = sum(sizes[i] * probs[i] for i in places)
    want = sum(probs[i] for i in places)
    best = min(
        range(2 ** len(places)),
        key=lambda m: (
            abs(sum(sizes[i] for k, i in enumerate(places) if m >> k & 1) - want_size),
            abs(bin(m).count("1") - want),
            m,
        ),
    )
    out = list(probs)
    for k, i in enumerate(places):
        out[i] = float(best >> k & 1)
    return out


def _fly_block(last: bool, seed: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["draw", "doc_id", "size", "rows"], kind="stable", na_position="last")
        sizes = [float(s * r) for s, r in zip(rows["size"], rows["rows"], strict=True)]
        first = rows.iloc[0]
        rng = random.Random(f"{seed}|{first['draw']}|{len(rows)}")
        probs = flight(sizes, list(rows["prob"]), rng)
        if last:
            probs = landing(sizes, probs)
        return rows.assign(prob=probs)[[c.split()[0] for c in UNIT.split(", ")]]

    return run


def mix_units(docs: DataFrame, weights: Sequence[int] = (5, 2, 1), budget: float = 1.5, cap: float = 2.0,
              block_rows: int = 4096, seed: int = 42) -> DataFrame:
    """Units (doc_id, source, no_source, size, rows) with ``copies``,
    ``source_size`` and ``target``."""
    counted = docs.select(
        F.col("doc_id").cast("string").alias("doc_id"),  # text: stays exact beside nulls in pandas
        F.coalesce(F.col("source"), F.lit("")).alias("source"),
        F.col("source").isNull().alias("no_source"),
        words_in(F.col("text")).alias("size"),
    )
    units = written(
        counted.groupBy("doc_id", "source", "no_source", "size").agg(F.count("*").alias("rows"))
        .withColumn("draw", F.xxhash64(F.lit(seed), "doc_id", "size")),
        "mix-units",
    )
    sizes = units.groupBy("source", "no_source").agg(
        F.sum(F.col("size") * F.col("rows")).alias("source_size"), F.count("*").alias("units")
    )
    sizes = written(sizes, "mix-sources")
    targets = source_targets(sizes, weights, budget, cap).join(sizes.select("source", "no_source", "units"), ["source", "no_source"])
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    near = F.round(ratio)
    ratio = F.when(F.abs(ratio - near) < EPS, near).otherwise(ratio)
    targets = written(
        targets.withColumn("whole", F.floor(ratio).cast("long")).withColumn("prob", ratio - F.floor(ratio)),
        "mix-targets",
    )
    placed = units.join(targets, ["source", "no_source"])
    blocks = F.greatest(F.lit(1), F.ceil(F.col("units") / F.lit(block_rows)))
    names = [c.split()[0] for c in UNIT.split(", ")]
    out = None
    largest = sizes.agg(F.max("units")).first()[0] or 0
    open_units = placed.withColumn("block", F.pmod(F.xxhash64("draw", F.lit(1)), blocks))
    while True:
        last = largest <= block_rows
        moved = written(
            open_units.groupBy("source", "no_source", "block").applyInPandas(_fly_block(last, seed), UNIT), "mix-level"
        )
        done = moved if last else moved.filter((F.col("prob") <= 0) | (F.col("prob") >= 1))
        out = done if out is None else out.unionByName(done)
        if last:
            break
        left = moved.filter((F.col("prob") > 0) & (F.col("prob") < 1))
        counts = written(left.groupBy("source", "no_source").agg(F.count("*").alias("units")), "mix-counts")
        largest = counts.agg(F.max("units")).first()[0] or 0
        if largest == 0:
            break
        open_units = left.select(*names).join(counts, ["source", "no_source"]).withColumn(
            "block", F.pmod(F.xxhash64("draw", F.lit(1 + largest)), F.greatest(F.lit(1), F.ceil(F.col("units") / block_rows)))
        )
    return out.withColumn("copies", F.col("whole") + F.col("prob").cast("long")).join(
        targets.select("source", "no_source", "source_size", "target"), ["source", "no_source"]
    )


def mix(docs: DataFrame, **options) -> DataFrame:
    """One row per document: size, its source's size and target, and the words
    the mix takes of it (``copies`` times its size)."""
    units = mix_units(docs, **options)
    return (
        units.withColumn("nth", F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows"))))
        .select(
            F.col("doc_id").cast("long").alias("doc_id"), "size", "source_size", "target",
            (F.col("copies") * F.col("size")).alias("taken"), "copies",
        )
    )


def apply_mix(docs: DataFrame, **options) -> DataFrame:
    """``docs`` (all columns) with each row repeated as often as it is taken."""
    own_id, own_source, none, size, copies, nth = fresh(docs, "_mix_id", "_mix_source", "_mix_none", "_mix_size", "_mix_copies", "_mix_nth")
    units = mix_units(docs, **options).select(
        F.col("doc_id").alias(own_id), F.col("source").alias(own_source), F.col("no_source").alias(none),
        F.col("size").alias(size), F.col("copies").alias(copies),
    ).filter(F.col(copies) > 0)
    matched = docs.join(
        units,
        F.col("doc_id").cast("string").eqNullSafe(F.col(own_id))
        & (F.coalesce(F.col("source"), F.lit("")) == F.col(own_source))
        & (F.col("source").isNull() == F.col(none))
        & (words_in(F.col("text")) == F.col(size)),
    )
    return matched.withColumn(nth, F.explode(F.sequence(F.lit(1).cast("long"), F.col(copies)))).select(
        *[F.col(c) for c in docs.columns]
    )
