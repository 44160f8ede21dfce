"""Personal data in texts: patterns propose, checksums confirm, context scores.

Only DataFrame functions.  A text goes through each pattern twice (once for
the matches, once for the pieces between them) and only if a cheap necessary
condition of the pattern holds.  Positions are running sums of the lengths of
pieces and matches, in code points.  Matches are walked in short runs and
context is cut from short pieces, so that time grows with the text and its
spans, not with their product.

Kinds: ``email``, ``ip`` (every part at most 255), ``card`` (12 to 19 digits,
Luhn), ``phone`` (9 to 15 digits) and ``iban`` (15 to 34 characters, mod 97).
A match that its validator rejects is dropped; the text inside it is not
searched again.  An IBAN ends at a word's end: of the ends that pass mod 97 the
one that gives its country's length, else the last.  A rejected start of an
IBAN leaves the text after its first four characters to be searched.

Each span has a score in [0, 1]: a base for its kind, raised if a word that
usually introduces such data ("card", "call", ...) stands within ``window``
code points before or after it, and lowered if a word that usually marks
another kind of number ("version", "order") does.

Defined cases: a null or empty text has no spans; null ids stay null; repeated
rows give repeated results; other columns are ignored by ``pii_report`` and
kept by ``with_spans`` (which adds one column, ``spans_column``).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RUN = 64  # consecutive matches that are walked together
PIECE = 1024  # code points of the pieces from which context is cut

# The patterns' character classes.  ``++`` never gives back what
# it took, which changes no match here (what follows each class is not in it)
# and keeps the matcher iterative on very long runs.  An email can start only
# where no local-part character precedes it or right after the last match.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
# Takes the first four characters and looks at all that the number could hold,
# following words included (and, if it goes on, one character more).
IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?=((?:\x20?[A-Z0-9]){11,30}+[A-Za-z0-9]?))"
# Lengths of the IBAN registry.
IBAN_LENGTHS = dict(
    AD=24, AE=23, AL=28, AT=20, AZ=28, BA=20, BE=16, BG=22, BH=22, BI=27, BR=29, BY=28, CH=21, CR=22, CY=28, CZ=24, DE=22,
    DJ=27, DK=18, DO=28, EE=20, EG=29, ES=24, FI=18, FK=18, FO=18, FR=27, GB=22, GE=22, GI=23, GL=18, GR=27, GT=28, HN=28,
    HR=21, HU=28, IE=22, IL=23, IQ=23, IS=26, IT=27, JO=30, KW=30, KZ=20, LB=28, LC=32, LI=21, LT=20, LU=20, LV=21, LY=25,
    MC=27, MD=24, ME=22, MK=19, MN=20, MR=27, MT=31, MU=30, NI=28, NL=18, NO=15, OM=23, PK=24, PL=28, PS=29, PT=25, QA=29,
    RO=24, RS=22, RU=33, SA=24, SC=31, SD=18, SE=24, SI=19, SK=24, SM=27, SO=23, ST=25, SV=28, TL=23, TN=24, TR=26, UA=29,
    VA=22, VG=24, XK=20, YE=30,
)

LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """True if a string of digits passes the Luhn check."""
    n = F.length(digits)
    total = F.aggregate(
        F.sequence(F.lit(1), n),
        F.lit(0),
        lambda acc, i: acc + _luhn_digit(F.substring(digits, i, F.lit(1)).cast("int"), (n - i) % 2 == 1),
    )
    return (n > 0) & (total % 10 == 0)


def _luhn_digit(digit: Column, doubled: Column) -> Column:
    twice = digit * 2
    return F.when(~doubled, digit).when(twice > 9, twice - 9).otherwise(twice)


def mod97(value: Column) -> Column:
    """Remainder of an account number (first four characters last, letters as
    10 to 35) by 97."""
    moved = F.concat(F.substring(value, F.lit(5), F.length(value)), F.substring(value, 1, 4))
    return F.aggregate(
        F.split(moved, ""),
        F.lit(0),
        lambda acc, ch: F.when(
            F.instr(F.lit(LETTERS), ch) > 0, (acc * 100 + F.instr(F.lit(LETTERS), ch) + 9) % 97
        ).otherwise((acc * 10 + ch.cast("int")) % 97),
    )


def iban_size(value: Column) -> Column:
    """Characters of the IBAN that ``value`` starts with; null if none."""
    words = F.split(value, " ")
    starts = F.transform(F.sequence(F.lit(1), F.size(words)), lambda i: F.array_join(F.slice(words, 1, i), " "))
    valid = F.filter(starts, lambda x: _iban(F.regexp_replace(x, " ", "")))
    lengths = F.create_map(*[F.lit(x) for pair in IBAN_LENGTHS.items() for x in pair])
    usual = F.try_element_at(lengths, F.substring(value, 1, 2))
    of_country = F.filter(valid, lambda x: F.length(F.regexp_replace(x, " ", "")) == usual)
    return F.length(F.coalesce(F.get(of_country, F.lit(0)), F.get(valid, F.size(valid) - 1)))


def _iban(value: Column) -> Column:
    return F.when(value.rlike("^[A-Z0-9]{15,34}$"), mod97(value) == 1).otherwise(False)


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    possible: str      # cheap necessary condition: a literal, or a pattern
    literal: bool
    base_score: float
    context: str       # words that raise the score
    against: str       # words that lower it

    def valid(self, match: Column) -> Column:
        if self.name == "ip":
            return match.rlike(r"^0*+(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]{0,2})(?:\.0*+(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]{0,2})){3}$")
        if self.name == "card":
            d = _digits(match)
            return F.length(d).between(12, 19) & F.when(F.length(d).between(12, 19), luhn(d)).otherwise(False)
        if self.name == "phone":
            return F.length(_digits(match)).between(9, 15)
        return F.lit(True)

    def size(self, match: Column, ahead: Column) -> Column:
        """Length of the span of a match; null if it is not valid."""
        if self.name == "iban":
            return iban_size(F.concat(match, ahead))
        return F.when(self.valid(match), F.length(match))


# Kinds in the order in which equal starts are listed.
KINDS = (
    Kind("email", EMAIL, "@", True, 0.9, "mail|contact|write|address", "example"),
    Kind("ip", IP, r"[0-9]\.[0-9]+\.[0-9]+\.[0-9]", False, 0.6, "ip|host|server|addr|login", "version|release"),
    Kind("card", CARD, r"[0-9](?:[\x20-]?[0-9]){11}", False, 0.8, "card|visa|credit|pay", "order|serial|isbn"),
    Kind("phone", PHONE, "+", True, 0.7, "call|phone|tel|mobile|fax", "id|score"),
    Kind("iban", IBAN, r"[A-Z]{2}[0-9]{2}", False, 0.9, "iban|account|bank|transfer", "serial"),
)
BASE_KINDS = ("email", "ip", "card", "phone")


def kind_spans(text: Column, kind: Kind, rank: int, window: int) -> Column:
    """array<struct<start, rank, kind, end, score>> of a kind's valid spans."""
    pattern = F.lit(kind.pattern)
    matches = F.regexp_extract_all(text, pattern, F.lit(0))
    ahead = F.regexp_extract_all(text, pattern, F.lit(1)) if kind.name == "iban" else matches
    pieces = F.split(text, kind.pattern, -1)
    lengths = F.transform(
        F.arrays_zip(matches.alias("m"), pieces.alias("p"), ahead.alias("a")),
        lambda z: F.struct(
            F.coalesce(F.length(z["p"]), F.lit(0)).alias("gap"), z["m"].alias("value"),
            F.when(z["m"].isNotNull(), kind.size(z["m"], z["a"])).alias("size"),
        ),
    )
    none = F.array().cast("array<struct<start:int,end:int,ok:boolean>>")
    states = F.array().cast("array<struct<at:int,free:int>>")

    def after(acc: Column, z: Column) -> tuple[Column, Column]:
        start = acc["at"] + z["gap"]
        return (
            (start + F.length(z["value"])).alias("at"),
            F.when(_stands(acc, z), start + z["size"]).otherwise(acc["free"]).alias("free"),
        )

    def over_run(acc: Column, run: Column) -> Column:
        before = F.struct(acc["at"].alias("at"), acc["free"].alias("free"))
        passed = F.aggregate(run, before, lambda x, z: F.struct(*after(x, z)))
        return _with_value(passed, lambda x: F.struct(
            x["at"].alias("at"), x["free"].alias("free"), F.concat(acc["befores"], F.array(before)).alias("befores")
        ))

    def spans_of(run: Column, before: Column) -> Column:
        first = F.struct(before["at"].alias("at"), before["free"].alias("free"), none.alias("out"))
        return F.aggregate(run, first, lambda x, z: F.struct(*after(x, z), F.concat(x["out"], F.array(F.struct(
            (x["at"] + z["gap"]).alias("start"), (x["at"] + z["gap"] + F.coalesce(z["size"], F.lit(0))).alias("end"),
            _stands(x, z).alias("ok"),
        ))).alias("out")))["out"]

    # an accumulator is copied whole at each step, so none may grow with the spans:
    # first the state before each run of matches, then each run's spans by itself
    nil = F.struct(F.lit(0).alias("at"), F.lit(0).alias("free"), states.alias("befores"))
    found = F.filter(lengths, lambda z: z["value"].isNotNull())
    walked = _with_value(_runs(found), lambda runs: F.flatten(
        F.zip_with(runs, F.aggregate(runs, nil, over_run)["befores"], spans_of)
    ))
    scored = _with_value(_pieces(text, window), lambda cut: F.transform(
        F.filter(walked, lambda s: s["ok"]),
        lambda s: F.struct(
            s["start"].alias("start"), F.lit(rank).alias("rank"), F.lit(kind.name).alias("kind"), s["end"].alias("end"),
            _context_score(cut, s, kind, window).alias("score"),
        ),
    ))
    possible = F.contains(text, F.lit(kind.possible)) if kind.literal else text.rlike(kind.possible)
    nothing = F.array().cast("array<struct<start:int,rank:int,kind:string,end:int,score:double>>")
    return F.when(possible, scored).otherwise(nothing)


def _with_value(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, with ``value`` computed once (a lambda's body computes
    what it names from outside anew for each element)."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _runs(found: Column) -> Column:
    """``found`` in consecutive runs of ``RUN`` elements."""
    return _with_value(found, lambda a: F.transform(
        F.sequence(F.lit(0), F.floor(F.size(a) / RUN).cast("int")), lambda i: F.slice(a, i * RUN + 1, RUN)
    ))


def _pieces(text: Column, window: int) -> Column:
    """``text`` in consecutive pieces of ``_piece_size(window)`` code points."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{_piece_size(window)}}}"), F.lit(0))


def _piece_size(window: int) -> int:
    return max(PIECE, window)


def _cut(pieces: Column, at: Column, length: Column, window: int) -> Column:
    """``length`` (at most ``window``) code points of the text from ``at``."""
    size = _piece_size(window)
    nth = F.floor(at / size).cast("int")
    two = F.concat(*[F.coalesce(F.get(pieces, nth + i), F.lit("")) for i in (0, 1)])
    return F.substring(two, at - nth * size + 1, length)


def _stands(acc: Column, z: Column) -> Column:
    """A valid match that does not start inside the last span."""
    return z["size"].isNotNull() & (acc["at"] + z["gap"] >= acc["free"])


def _context_score(pieces: Column, span: Column, kind: Kind, window: int) -> Column:
    first = F.greatest(span["start"] - window, F.lit(0))
    before = _cut(pieces, first, span["start"] - first, window)
    after = _cut(pieces, span["end"], F.lit(window), window)
    near = F.lower(F.concat_ws(" ", before, after))
    up = F.when(near.rlike(rf"\b(?:{kind.context})"), 0.1).otherwise(0.0)
    down = F.when(near.rlike(rf"\b(?:{kind.against})\b"), 0.3).otherwise(0.0)
    return F.round(F.lit(kind.base_score) + up - down, 2)


def with_spans(docs: DataFrame, text: str = "text", spans_column: str = "pii_spans", window: int = 40) -> DataFrame:
    """Adds ``spans_column``: every span found in the whole text, sorted by
    start, then kind as listed in ``KINDS``."""
    source = F.coalesce(F.col(text), F.lit(""))
    found = [kind_spans(source, k, i, window) for i, k in enumerate(KINDS)]
    return docs.withColumn(spans_column, F.array_sort(F.concat(*found)))


def pii_report(docs: DataFrame, window: int = 40) -> DataFrame:
    """One row per document: counts per base kind, digest of the base spans
    ("kind:start:end", comma-joined), all spans likewise, and the highest
    score (0 without spans)."""
    work = with_spans(docs.select("doc_id", "text"), "text", "found", window)

    def joined(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    base = F.filter("found", lambda s: s["kind"].isin(*BASE_KINDS))

    def count(kind: str) -> Column:
        return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return work.select("doc_id", "found").select(
        "doc_id",
        *[count(k) for k in BASE_KINDS],
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("found")).alias("spans"),
        F.coalesce(F.array_max(F.transform("found", lambda s: s["score"])), F.lit(0.0)).alias("max_score"),
    )
