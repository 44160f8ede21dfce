"""DuckDB SQL for the correctness oracle.

An independent statement of each registered query over the driver's
tables (views ``lineitem``, ``orders``, ``customer``, ...).  Iterations are
unrolled as CTEs.  Helpfulness values live on the same 1e-9 integer grid
as in the engine, so strict comparisons agree across engines.
"""

from __future__ import annotations

from ..sources.reviews import reviews_sql


def _lam(lam: float) -> str:
    return f"CAST({float(lam)!r} AS double)"


def r6(q: str) -> str:
    """1e-9 integer -> six decimals, rounded half up in the integer domain."""
    return f"(floor((CAST({q} AS double) + 500.0) / 1000.0) / 1e6)"


def q9(x: str) -> str:
    return f"CAST(round(({x}) * 1e9) AS bigint)"


def h9(q: str) -> str:
    return f"(CAST({q} AS double) / 1e9)"


def share_sum(x: str) -> str:
    """Sum of shares in integer units of 1e-15, as in the engine."""
    return f"sum(CAST(floor(({x}) * 1e15 + 0.5) AS hugeint))"


def with_ctes(ctes: list[tuple[str, str]], body: str) -> str:
    return "WITH " + ",\n".join(f"{n} AS ({s})" for n, s in ctes) + "\n" + body


def review_ctes() -> list[tuple[str, str]]:
    return [("rv", reviews_sql())]


def general_ctes(lam: float, iters: int) -> list[tuple[str, str]]:
    ctes = review_ctes() + [
        ("d", "SELECT DISTINCT user_id, product_id, rating, hq FROM rv"),
        ("m", "SELECT user_id, CAST(round(avg(hq)) AS bigint) AS hq, count(*) AS n_reviews FROM d GROUP BY user_id"),
        ("mem", "SELECT DISTINCT d.product_id, d.rating, d.user_id, m.hq AS H FROM d JOIN m ON d.user_id = m.user_id"),
        ("links", "SELECT DISTINCT a.user_id AS src, b.user_id AS dst FROM mem a JOIN mem b "
                  "ON a.product_id = b.product_id AND a.rating = b.rating AND b.H < a.H"),
        ("deg", "SELECT src, count(*) AS deg FROM links GROUP BY src"),
        ("g0", "SELECT m.user_id, m.hq AS rq, coalesce(deg.deg, 0) AS deg FROM m LEFT JOIN deg ON m.user_id = deg.src"),
    ]
    for i in range(1, iters + 1):
        ctes.append((f"a{i}", f"SELECT l.dst, CAST({share_sum(f"abs({h9('g.rq')}) / (g.deg * {_lam(lam)})")} AS double) / 1e15 AS add "
                              f"FROM links l JOIN g{i-1} g ON l.src = g.user_id WHERE g.deg > 0 GROUP BY l.dst"))
        upd = q9(f"least(1.0, {h9('g.rq')} + coalesce(a.add, 0.0))")
        ctes.append((f"g{i}", f"SELECT g.user_id, {upd} AS rq, g.deg "
                              f"FROM g{i-1} g LEFT JOIN a{i} a ON g.user_id = a.dst"))
    return ctes


def product_ctes(lam: float, iters: int) -> list[tuple[str, str]]:
    ctes = review_ctes() + [("s0", "SELECT product_id, user_id, rating, hq, unix_time, review_id FROM rv")]
    for i in range(1, iters + 1):
        prev = f"s{i-1}"
        ctes.append((f"w{i}", f"SELECT *, count(*) OVER (PARTITION BY product_id, rating) - count(*) OVER "
                              f"(PARTITION BY product_id, rating ORDER BY hq DESC RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS e "
                              f"FROM {prev}"))
        ctes.append((f"c{i}", f"SELECT *, CASE WHEN e > 0 THEN {h9('hq')} / (e * {_lam(lam)}) ELSE 0.0 END AS c FROM w{i}"))
        ctes.append((f"x{i}", f"SELECT *, CAST(coalesce({share_sum('least(c, 0.0)')} OVER wd, 0) AS double) / 1e15 AS n, "
                              f"CAST(coalesce({share_sum('greatest(c, 0.0)')} OVER wd, 0) AS double) / 1e15 AS p FROM c{i} "
                              f"WINDOW wd AS (PARTITION BY product_id, rating ORDER BY hq DESC "
                              f"RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"))
        if i == 1:
            upd = q9(f"least(1.0, greatest(-1.0, least(1.0, greatest(-1.0, {h9('f.hq')})) + n) + p)")
            ctes.append(("s1", f"SELECT product_id, user_id, f.rating AS rating, {upd} AS hq FROM ("
                               f"SELECT product_id, user_id, "
                               f"arg_min({{'rating': rating, 'hq': hq}}, {{'t': unix_time, 'r': review_id, 'g': rating, 'h': hq}}) AS f, "
                               f"sum(n) AS n, sum(p) AS p FROM x1 GROUP BY product_id, user_id)"))
        else:
            upd = q9(f"least(1.0, greatest(-1.0, least(1.0, greatest(-1.0, {h9('hq')})) + n) + p)")
            ctes.append((f"s{i}", f"SELECT product_id, user_id, rating, {upd} AS hq FROM x{i}"))
    return ctes


def product_means(i: int) -> str:
    return f"SELECT user_id, CAST(round(avg(hq)) AS bigint) AS rank_q FROM s{i} GROUP BY user_id"


def product_trace_union(iters: int) -> str:
    return " UNION ALL ".join(
        f"SELECT {i} AS iter, user_id, CAST(round(avg(hq)) AS bigint) AS rank_q FROM s{i} GROUP BY user_id"
        for i in range(iters + 1)
    )


def general_trace_union(iters: int) -> str:
    return " UNION ALL ".join(f"SELECT {i} AS iter, user_id, rq AS rank_q FROM g{i}" for i in range(iters + 1))


def js_text(x: str) -> str:
    return (f"(CASE WHEN {x} = floor({x}) THEN CAST(CAST(floor({x}) AS bigint) AS varchar) "
            f"ELSE CAST({x} AS varchar) END)")


def label(pos: str, user: str, rank: str) -> str:
    v = f"(floor({rank} * 100.0 + 0.5) / 100.0)"
    return f"('#' || CAST({pos} AS varchar) || ' ' || {user} || ' (' || {js_text(v)} || ')')"


def band(rank: str) -> str:
    s = f"({rank} + 1.0)"
    parts = " ".join(f"WHEN {s} >= {round(b * 0.2, 1)} THEN {b}" for b in range(9, 0, -1))
    return f"(CASE {parts} ELSE 0 END)"


def colour(b: str) -> str:
    from ..functions.scalar import BAND_COLOURS
    arr = ", ".join(f"'{c}'" for c in BAND_COLOURS)
    return f"([{arr}][{b} + 1])"
