"""Column expressions shared by the operators (all JVM-side, codegen'd)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Helpfulness values are kept as integers in units of 1e-9.  A link exists
# only under a strict comparison of two computed means, so last-bit noise
# must not decide it; equal-valued peers are also cheap to find with a
# RANGE frame over an integer key.
SCALE = 1_000_000_000


def quantize(x: Column) -> Column:
    """Double -> integer helpfulness in 1e-9 units (half away from zero)."""
    return F.round(x * F.lit(float(SCALE))).cast("long")


def dequantize(q: Column) -> Column:
    return q / F.lit(float(SCALE))


# Shares are summed as integers in units of 1e-15: sums then depend neither on the
# order of the rows nor on how many partial sums they are made of, so layouts,
# partition counts and the skew paths cannot change which links exist.  A share
# beyond 2 in size takes any receiver to a clamp just as 2 does.
SHARE_SCALE = 1e15
SHARE_MOST = 2.0
LANE_BITS = 24


def share_lanes(share: Column) -> tuple[Column, Column]:
    """A share as two integers, upper and lower, whose sums do not overflow."""
    bounded = F.least(F.lit(SHARE_MOST), F.greatest(F.lit(-SHARE_MOST), share))
    units = F.floor(bounded * F.lit(SHARE_SCALE) + F.lit(0.5)).cast("long")
    return F.shiftright(units, LANE_BITS), units.bitwiseAND(F.lit((1 << LANE_BITS) - 1))


def from_lanes(upper: Column, lower: Column) -> Column:
    """The sum of shares whose lanes sum to ``upper`` and ``lower``."""
    return (upper.cast("double") * F.lit(float(1 << LANE_BITS)) + lower.cast("double")) / F.lit(SHARE_SCALE)


def rounded6(q: Column) -> Column:
    """1e-9 integer -> double with six decimals, rounded half up in the
    integer domain so every engine prints the same double."""
    return F.floor((q + F.lit(500)) / F.lit(1000.0)) / F.lit(1_000_000.0)


def helpfulness(top: Column, votes: Column) -> Column:
    """(2*top - all) / all, and 0 for a review nobody voted on.

    Not clamped: top > all gives a value above 1, as in the source data.
    """
    return F.when(votes == 0, F.lit(0.0)).otherwise(
        (F.lit(2.0) * top - votes) / votes
    )


def parse_votes(text: Column) -> Column:
    """Text ``"[top, all]"`` -> array<double> (null when malformed)."""
    return F.from_json(F.trim(text), "array<double>")


def strip_quotes(c: Column) -> Column:
    return F.regexp_replace(c, '"', "")


# Fixed values of the demo's colour scale: ten bands of width 0.2 over
# rank + 1, band 9 is rank + 1 >= 1.8, band 0 is below 0.2.
BAND_WIDTH = 0.2
BAND_COUNT = 10
BAND_COLOURS = [
    "#E50000", "#EA2B00", "#EF5F01", "#F49602", "#F9CE03",
    "#F6FF05", "#B6F803", "#7AF202", "#21C903", "#038105",
]


def rank_band(rank: Column) -> Column:
    """Band number 0..9 of a rank in [-1, 1] (values above clamp to 9)."""
    shifted = rank + F.lit(1.0)
    expr = F.lit(0)
    # thresholds 0.2, 0.4, ... 1.8; compared on the shifted double exactly
    # as the demo does, so 0.2 + 1.0 style rounding behaves the same
    for b in range(1, BAND_COUNT):
        expr = F.when(shifted >= F.lit(round(b * BAND_WIDTH, 1)), F.lit(b)).otherwise(expr)
    return expr


def band_colour(band: Column) -> Column:
    return F.element_at(F.array(*[F.lit(c) for c in BAND_COLOURS]), band + 1)


def round_half_up2(x: Column) -> Column:
    """Two decimals with halves rounded up, like the demo's label."""
    return F.floor(x * F.lit(100.0) + F.lit(0.5)) / F.lit(100.0)


def js_number_text(x: Column) -> Column:
    """Number as JavaScript's String() prints it: no ".0" on integers."""
    return F.when(x == F.floor(x), F.floor(x).cast("long").cast("string")).otherwise(x.cast("string"))


def leaderboard_label(position: Column, user: Column, rank: Column) -> Column:
    return F.format_string("#%d %s (%s)", position, user, js_number_text(round_half_up2(rank)))


def capitalised_key(k: Column) -> Column:
    """Search key as the demo normalises it: lower-case, first letter upper."""
    low = F.lower(k)
    return F.concat(F.upper(F.substring(low, 1, 1)), F.substring(low, 2, 1 << 30))


# Fixed values of the demo's node size: radius ((rank+1)*R_MAX/2)+R_MIN.
NODE_R_MAX = 2.0
NODE_R_MIN = 1.0


def node_size(rank: Column) -> Column:
    return (rank + F.lit(1.0)) * F.lit(NODE_R_MAX / 2.0) + F.lit(NODE_R_MIN)
