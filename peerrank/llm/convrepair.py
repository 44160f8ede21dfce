"""Repair of conversation structure by divide and conquer in linear space.

A repaired conversation's role initials read ``(s?(ua)+)?``.  Four states follow
them: nothing yet, after the system turn, after a user's, after an assistant's.
Each row is kept (0), given the role user or assistant (1) or deleted (2);
turns with empty text may be inserted anywhere (5); a truncated row that stays
costs 5 more, a blank or repeated one must go.  Of the cheapest edits those are
taken whose initials D, I, K, R in order ("audit") are least in ASCII.

A row (with the insertions before it) is a 4 x 4 matrix of costs from state to
state; where a state leads to several, their edit strings are ranked.  No edit
string that ends with a row is the beginning of another of the same rows, so
ranks carry on: strings from different states stay in the order of the states'
ranks.  Hirschberg's scheme needs no more than that: a forward vector (costs
and ranks) and a backward vector (costs) of four states meet in the middle, the
cheapest crossing of least rank is on the audit-least path, and both halves are
solved alone.  Four numbers a state are kept while going along, never a table.

The same scheme runs across tasks.  Rows of a conversation are placed by range
partitioning and cut into blocks of ``BLOCK`` rows; a block's matrix is the
product of its rows', ``FAN`` blocks make one of the next tier, and so on.  Going
back, each tier finds the crossings between its parts, and blocks are solved
each for itself between two known states.  So a conversation that holds most of
all rows is spread like any other.  Repeated rows are found by the least place
of each (conversation, role, text) digest, a combined aggregate, and marked by
row number, which no hot text gathers.

The digest of a repaired conversation is one SHA-256 over all its text, which
can only be computed from front to back: ``repaired_digests`` streams a
conversation's sorted rows through one task, a batch at a time, and keeps
nothing.  The audit is one character a row in one string.

Defined cases: null conv_ids are one conversation; nulls in other columns count
as one space (a turn stays null and is ordered first); rows of one turn go by
role, then by a digest of role and text; repeated rows are duplicates; a
conversation without rows has no edits and the digest of the empty string; an
empty table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.positions import positions
from .common import small_batches, written

# Costs and symbols of the rules above.
DELETE, REROLE, INSERT, CUT_OFF = 2, 1, 5, 5
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
NEXT = (USER, USER, ASSISTANT, USER)         # state after an inserted or re-roled turn
AFTER = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
INITIAL = " sua"
ROLES = {"u": "user", "a": "assistant"}
ENDING = (0, 2, 1, 0)                        # insertions that end a conversation, by state
UNREACHED = 1 << 60

BLOCK = 1024    # rows solved at a time
FAN = 1024      # blocks of one block of the next tier
SHORT = 32      # rows below which a segment keeps its way back instead of being halved

SPACE = r"\x20\x09-\x0D"

# A matrix is (costs, ranks): 16 numbers each, from state p to state q at 4 * p + q.
Matrix = tuple[Sequence[int], Sequence[int]]


# --- one conversation -----------------------------------------------------------


@lru_cache(maxsize=None)
def row_edits(symbol: str) -> dict[tuple[int, int], tuple[int, str]]:
    """(p, q) -> (cost, edits) of one row.  Symbols: ``x`` must go; else the
    role's initial (``o``: none of s, u, a), in upper case if truncated."""
    best: dict[tuple[int, int], tuple[int, str]] = {}
    for p in STATES:
        at = p
        for inserted in range(4):
            ways = [("D", at, DELETE)]
            if symbol != "x":
                extra = CUT_OFF if symbol.isupper() else 0
                to = AFTER.get(symbol.lower())
                if to == NEXT[at] or (to == SYSTEM and at == START):
                    ways.append(("K", to, extra))
                ways.append(("R", NEXT[at], REROLE + extra))
            for edit, q, cost in ways:
                way = (INSERT * inserted + cost, "I" * inserted + edit)
                best[p, q] = min(best.get((p, q), way), way)
            at = NEXT[at]
    return best


@lru_cache(maxsize=None)
def row_matrix(symbol: str) -> Matrix:
    edits = row_edits(symbol)
    costs = [edits.get((p, q), (UNREACHED, ""))[0] for p in STATES for q in STATES]
    ranks = [0] * 16
    for p in STATES:
        for rank, (_, q) in enumerate(sorted((edits[p, q][1], q) for q in STATES if (p, q) in edits)):
            ranks[4 * p + q] = rank
    return costs, ranks


def _forward(matrices: Sequence[Matrix], p: int, ways: list | None = None) -> tuple[list[int], list[int]]:
    """Least costs from ``p`` to each state over all ``matrices``, and the ranks
    of the least edit strings; ``ways`` collects where each state came from."""
    costs, ranks = [UNREACHED] * 4, [0] * 4
    costs[p] = 0
    for steps, orders in matrices:
        reached, places, came = [UNREACHED] * 4, [], [0] * 4
        for q in STATES:
            least = None
            for s in STATES:
                if costs[s] < UNREACHED and steps[4 * s + q] < UNREACHED:
                    way = (costs[s] + steps[4 * s + q], ranks[s], orders[4 * s + q], s)
                    if least is None or way < least:
                        least = way
            if least is not None:
                reached[q], came[q] = least[0], least[3]
                places.append((least[1], least[2], q))
        costs, ranks = reached, [0] * 4
        for rank, (_, _, q) in enumerate(sorted(places)):
            ranks[q] = rank
        if ways is not None:
            ways.append(came)
    return costs, ranks


def _backward(matrices: Sequence[Matrix], q: int) -> list[int]:
    costs = [UNREACHED] * 4
    costs[q] = 0
    for steps, _ in reversed(matrices):
        costs = [min(min(steps[4 * p + s] + costs[s] for s in STATES), UNREACHED) for p in STATES]
    return costs


def product(matrices: Sequence[Matrix]) -> Matrix:
    rows = [_forward(matrices, p) for p in STATES]
    return [c for costs, _ in rows for c in costs], [r for _, ranks in rows for r in ranks]


def crossings(matrices: Sequence[Matrix], p: int, q: int) -> list[int]:
    """States before each matrix and after the last on the best way from ``p`` to ``q``."""
    states = [p] * len(matrices) + [q]
    open_ = [(0, len(matrices))]
    while open_:
        low, high = open_.pop()
        start, end = states[low], states[high]
        if high - low <= SHORT:
            ways: list[list[int]] = []
            _forward(matrices[low:high], start, ways)
            for i in range(high - 1, low, -1):
                end = states[i] = ways[i - low][end]
            continue
        middle = (low + high) // 2
        costs, ranks = _forward(matrices[low:middle], start)
        rest = _backward(matrices[middle:high], end)
        states[middle] = min((costs[s] + rest[s], ranks[s], s) for s in STATES if costs[s] < UNREACHED)[2]
        open_ += [(low, middle), (middle, high)]
    return states


@lru_cache(maxsize=20_000)
def _short_product(symbols: str) -> Matrix:
    return product([row_matrix(s) for s in symbols])


@lru_cache(maxsize=20_000)
def _short_edits(symbols: str, p: int, q: int) -> list[str]:
    """For each row: initials of the turns inserted before it, ``:``, its edit
    and, unless deleted, its initial afterwards."""
    states = crossings([row_matrix(s) for s in symbols], p, q)
    found = []
    for i, symbol in enumerate(symbols):
        edits, at, added = row_edits(symbol)[states[i], states[i + 1]][1], states[i], ""
        for _ in edits[:-1]:
            at = NEXT[at]
            added += INITIAL[at]
        found.append(f"{added}:{edits[-1]}{'' if edits[-1] == 'D' else INITIAL[states[i + 1]]}")
    return found


def _remembered(kept, symbols: str, *more):
    return (kept if len(symbols) <= 64 else kept.__wrapped__)(symbols, *more)


# --- in tasks -------------------------------------------------------------------


@F.pandas_udf(T.ArrayType(T.LongType()))
def _block_product(symbols: pd.Series) -> pd.Series:
    return pd.Series([[*m[0], *m[1]] for m in (_remembered(_short_product, s) for s in symbols)])


def _matrices(flat: Sequence[Sequence[int]]) -> list[Matrix]:
    return [([int(x) for x in m[:16]], [int(x) for x in m[16:]]) for m in flat]


@F.pandas_udf(T.ArrayType(T.LongType()))
def _tier_product(parts: pd.Series) -> pd.Series:
    return pd.Series([[*m[0], *m[1]] for m in (product(_matrices(x)) for x in parts)])


@F.pandas_udf(T.ArrayType(T.IntegerType()))
def _tier_crossings(parts: pd.Series, p: pd.Series, q: pd.Series) -> pd.Series:
    return pd.Series([crossings(_matrices(x), int(a), int(b)) for x, a, b in zip(parts, p, q)])


@F.pandas_udf(T.ArrayType(T.StringType()))
def _block_edits(symbols: pd.Series, p: pd.Series, q: pd.Series) -> pd.Series:
    return pd.Series([_remembered(_short_edits, s, int(a), int(b)) for s, a, b in zip(symbols, p, q)])


@dataclass
class Repair:
    """``summary``: a row a conversation (key ``k``, conv_id, gaps, blank,
    duplicate, truncated, illegal, cost, audit).  ``repaired``: its rows after
    repair (k, conv_id, place, part, role, text, edit), in order of place and part."""

    summary: DataFrame
    repaired: DataFrame


def conversation_key(conv_id: Column) -> Column:
    return F.coalesce(F.concat(F.lit("="), conv_id.cast("string")), F.lit("-"))


def _facts(conversations: DataFrame) -> DataFrame:
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    return written(conversations.select(
        conversation_key(F.col("conv_id")).alias("k"), "conv_id", "turn", role.alias("role"), text.alias("text"),
        (~text.rlike(f"[^{SPACE}]")).alias("blank"),
        text.rlike(rf"[.!?][{SPACE}]*\z").alias("ended"),
        F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256).alias("said"),
        F.monotonically_increasing_id().alias("uid"),
    ), "repair-rows")


def _placed(rows: DataFrame, partitions: int | None) -> DataFrame:
    """Narrow rows with their fault, role initial and place from 0 in the conversation."""
    narrow = rows.select("k", "conv_id", "turn", "role", "blank", "ended", "said", "uid")
    first = narrow.filter(~F.col("blank")).groupBy("k", "said").agg(F.min(F.struct("turn", "uid")).alias("f"))
    marked = narrow.join(first.select(F.col("f.uid").alias("uid"), F.lit(True).alias("first")), "uid", "left")
    fault = (
        F.when(F.col("blank"), F.lit("blank")).when(F.col("first").isNull(), F.lit("duplicate"))
        .when(~F.col("ended"), F.lit("truncated")).otherwise(F.lit(""))
    )
    initial = F.substring("role", 1, 1)
    known = F.when(initial.isin("s", "u", "a"), initial).otherwise(F.lit("o"))
    symbol = (
        F.when(F.col("fault").isin("blank", "duplicate"), F.lit("x"))
        .when(F.col("fault") == "truncated", F.upper("initial")).otherwise(F.col("initial"))
    )
    ready = marked.withColumn("fault", fault).withColumn("initial", known).withColumn("symbol", symbol)
    order = [F.col("turn").asc_nulls_first(), F.col("role").asc(), F.col("said").asc(), F.col("uid").asc()]
    placed = positions(ready.select("k", "conv_id", "turn", "role", "said", "uid", "fault", "initial", "symbol"),
                       order, group="k", partitions=partitions, name="place")
    return placed.withColumn("place", F.col("place") - 1)


def _solved(blocks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """((k, cost, out), (k, block, p, q)): each conversation's cost and last
    state, and the states at both ends of each block."""
    parts = written(blocks.select("k", F.col("block").alias("i"), _block_product("symbols").alias("m")), "repair-tier")
    tiers = []
    while (parts.agg(F.max("i")).first()[0] or 0) > 0:
        grouped = parts.groupBy("k", F.floor(F.col("i") / F.lit(FAN)).cast("long").alias("i")).agg(
            F.sort_array(F.collect_list(F.struct(F.col("i").alias("at"), "m"))).alias("parts")
        )
        tier = written(grouped.withColumn("m", _tier_product(F.transform("parts", lambda x: x["m"]))), "repair-tier")
        tiers.append(tier)
        parts = tier.select("k", "i", "m")
    ends = F.transform(F.array(*[F.lit(s) for s in STATES]), lambda s: F.struct(
        (F.get("m", s) + F.get(F.array(*[F.lit(n * INSERT) for n in ENDING]), s)).alias("cost"), F.get("m", s + 16).alias("rank"), s.alias("out"),
    ))
    last = written(parts.select("k", F.array_min(ends).alias("e")).select("k", "e.cost", "e.out"), "repair-ends")
    known = last.select("k", F.lit(0).cast("long").alias("i"), F.lit(START).alias("p"), F.col("out").alias("q"))
    for tier in reversed(tiers):
        found = tier.join(known, ["k", "i"]).withColumn("states", _tier_crossings(F.transform("parts", lambda x: x["m"]), "p", "q"))
        pairs = F.transform("parts", lambda x, n: F.struct(
            x["at"].alias("i"), F.get("states", n).alias("p"), F.get("states", n + 1).alias("q"),
        ))
        known = found.select("k", F.inline(pairs))
    return last, known.withColumnRenamed("i", "block")


def repair(conversations: DataFrame, partitions: int | None = None) -> Repair:
    """Faults, cheapest edits and repaired rows of every conversation of
    ``conversations`` (conv_id, turn, role, text)."""
    rows = _facts(conversations)
    placed = written(_placed(rows, partitions), "repair-places")
    cut = placed.withColumn("block", F.floor(F.col("place") / F.lit(BLOCK)).cast("long"))
    listed = cut.groupBy("k", "block").agg(F.sort_array(F.collect_list(F.struct("place", "symbol", "initial", "uid"))).alias("r"))
    joined = lambda name: F.array_join(F.transform("r", lambda x: x[name]), "")
    blocks = written(listed.select(
        "k", "block", joined("symbol").alias("symbols"), joined("initial").alias("initials"), F.transform("r", lambda x: x["uid"]).alias("uids"),
    ), "repair-blocks")
    last, known = _solved(blocks)
    solved = written(
        blocks.join(known, ["k", "block"]).withColumn("edits", _block_edits("symbols", "p", "q")).select("k", "block", "initials", "uids", "edits"),
        "repair-edits",
    )
    return Repair(summary=_summary(placed, solved, last), repaired=_repaired(rows, solved, last))


def _summary(placed: DataFrame, solved: DataFrame, last: DataFrame) -> DataFrame:
    counted = placed.groupBy("k").agg(
        F.first("conv_id").alias("conv_id"),
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.countDistinct("turn"), F.lit(0)).cast("long").alias("gaps"),
        *[F.count_if(F.col("fault") == name).alias(name) for name in ("blank", "duplicate", "truncated")],
    )
    before = F.lag(F.substring("initials", -1, 1)).over(Window.partitionBy("k").orderBy("block"))
    linked = F.concat(F.coalesce(before, F.lit("")), F.col("initials"))
    pairs = F.sequence(F.lit(1), F.length(linked) - 1)
    wrong = F.when(F.length(linked) > 1, F.size(F.filter(pairs, lambda i: ~F.substr(linked, i, F.lit(2)).isin("su", "ua", "au")))).otherwise(0)
    audit = F.array_join(F.transform("edits", lambda e: F.concat(
        F.repeat(F.lit("I"), F.instr(e, ":") - 1), F.substr(e, F.instr(e, ":") + 1, F.lit(1)),
    )), "")
    audits = solved.select("k", "block", wrong.alias("wrong"), audit.alias("audit")).groupBy("k").agg(
        F.sum("wrong").cast("long").alias("illegal"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("block", "audit"))), lambda x: x["audit"]), "").alias("audit"),
    )
    tail = F.repeat(F.lit("I"), F.get(F.array(*[F.lit(n) for n in ENDING]), F.col("out")))
    return counted.join(audits, "k").join(last, "k").select(
        "k", "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", F.concat("audit", tail).alias("audit"),
    )


def _repaired(rows: DataFrame, solved: DataFrame, last: DataFrame) -> DataFrame:
    zipped = F.transform("uids", lambda u, i: F.struct(
        u.alias("uid"), (F.col("block") * BLOCK + i).alias("place"), F.split(F.get("edits", i), ":").alias("e"),
    ))
    edits = solved.select("k", F.inline(zipped)).select(
        "k", "uid", "place", F.get("e", F.lit(0)).alias("added"), F.substring(F.get("e", F.lit(1)), 1, 1).alias("edit"),
        F.substring(F.get("e", F.lit(1)), 2, 1).alias("to"),
    )
    name = lambda c: F.when(c == "u", F.lit(ROLES["u"])).when(c == "a", F.lit(ROLES["a"]))
    stay = edits.filter("edit != 'D'").drop("k", "added").join(rows.select("uid", "k", "conv_id", "role", "text"), "uid").select(
        "k", "place", F.lit(1 << 20).alias("part"),
        F.when(F.col("edit") == "R", name(F.col("to"))).otherwise(F.col("role")).alias("role"), "text", "edit",
    )
    tails = F.get(F.array(F.lit(""), F.lit("ua"), F.lit("a"), F.lit("")), F.col("out"))
    end = last.select("k", F.lit((1 << 63) - 1).alias("place"), tails.alias("added"))
    added = edits.select("k", "place", "added").unionByName(end).filter("added != ''")
    new = added.select("k", "place", F.posexplode(F.split("added", ""))).filter("col != ''").select(
        "k", "place", F.col("pos").alias("part"), name(F.col("col")).alias("role"), F.lit("").alias("text"), F.lit("I").alias("edit"),
    )
    return stay.unionByName(new)


def repaired_digests(repaired: DataFrame) -> DataFrame:
    """(k, repaired_sha256) over each conversation's ``role:text`` lines."""
    lines = repaired.select("k", "place", "part", F.concat("role", F.lit(":"), "text").alias("line"))
    ordered = lines.repartition("k").sortWithinPartitions("k", "place", "part").select("k", "line")

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None
        for batch in small_batches(batches):
            done = []
            for k, line in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if k != now:
                    if state is not None:
                        done.append((now, state.hexdigest()))
                    now, state = k, hashlib.sha256()
                else:
                    state.update(b"\n")
                state.update(line.encode())
            yield _pairs(done)
        if state is not None:
            yield _pairs([(now, state.hexdigest())])

    return ordered.mapInArrow(hashed, "k string, repaired_sha256 string")


def _pairs(rows: list[tuple[str, str]]) -> pa.RecordBatch:
    return pa.record_batch([pa.array([k for k, _ in rows], pa.string()), pa.array([h for _, h in rows], pa.string())], ["k", "repaired_sha256"])


# --- the report -----------------------------------------------------------------


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows damaged by the CRC-32 of ``conv_id:turn`` modulo 20: 0 drops the row,
    1 empties its text, 2 takes out its ``.!?``, 3 repeats it, 4 makes its role user."""
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    how = F.crc32(F.encode(F.concat(part("conv_id"), F.lit(":"), part("turn")), "UTF-8")) % 20
    hurt = conversations.select("conv_id", "turn", part("role").alias("role"), part("text").alias("text"), how.alias("how")).filter("how != 0")
    text = F.when(F.col("how") == 1, F.lit("")).when(F.col("how") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("how") == 4, F.lit("user")).otherwise(F.col("role"))
    times = F.sequence(F.lit(1), F.when(F.col("how") == 3, F.lit(2)).otherwise(F.lit(1)))
    return hurt.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(times).alias("_copy")).drop("_copy")


def repair_report(conversations: DataFrame) -> DataFrame:
    """Every original conversation's faults, cheapest repair and its digest after damage."""
    done = repair(damaged(conversations))
    ids = conversations.select("conv_id").distinct().withColumn("k", conversation_key(F.col("conv_id")))
    found = ids.join(done.summary.drop("conv_id"), "k", "left").join(repaired_digests(done.repaired), "k", "left")
    zero = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return found.select(
        "conv_id", *zero, F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"),
    )
