"""Literal, pair-by-pair statements of both modes in plain Python.

Used to check the DataFrame formulations on small inputs: General builds the
link set explicitly; Product adds every contribution one at a time in
ascending donor order with a clamp after each addition.
"""

from collections import defaultdict

S = 1_000_000_000


def q(x):
    # half away from zero, like the engine's quantisation
    v = abs(x) * S
    r = int(v + 0.5)
    return r if x >= 0 else -r


def h_of(top, votes):
    return 0.0 if votes == 0 else (2.0 * top - votes) / votes


def general(reviews, lam, iters):
    """reviews: (review_id, product, user, rating, top, votes, time)."""
    d = {(u, p, r, q(h_of(t, a))) for (_, p, u, r, t, a, _) in reviews}
    acc = defaultdict(list)
    for u, p, r, hq in d:
        acc[u].append(hq)
    H = {u: q(sum(v) / len(v) / S) for u, v in acc.items()}
    links = {(a[0], b[0]) for a in d for b in d if a[1] == b[1] and a[2] == b[2] and H[b[0]] < H[a[0]]}
    deg = defaultdict(int)
    for s, _ in links:
        deg[s] += 1
    rank = dict(H)
    for _ in range(iters):
        add = defaultdict(float)
        for s, t in links:
            add[t] += abs(rank[s] / S) / (deg[s] * lam)
        rank = {u: q(min(1.0, rank[u] / S + add[u])) for u in rank}
    return {u: v / S for u, v in rank.items()}, links


def product(reviews, lam, iters):
    rows = [dict(p=p, u=u, r=r, h=q(h_of(t, a)), key=(tm, rid, r, q(h_of(t, a))))
            for (rid, p, u, r, t, a, tm) in reviews]
    by_p = defaultdict(list)
    for row in rows:
        by_p[row["p"]].append(row)
    for _ in range(iters):
        new_rows = defaultdict(list)
        for p, rs in by_p.items():
            received = defaultdict(list)      # user -> [(donor h, c)]
            for a in rs:
                recv = [b for b in rs if b["r"] == a["r"] and (b["h"] < a["h"] or b is a)]
                e = len(recv) - 1
                c = (a["h"] / S) / (e * lam) if e else 0.0
                for b in recv:
                    received[b["u"]].append((a["h"], 0.0 if b is a else c))
            for u in received:
                mine = [b for b in rs if b["u"] == u]
                first = min(mine, key=lambda b: b["key"])
                acc = first["h"] / S
                for _, c in sorted(received[u], key=lambda x: x[0]):   # ascending donor h
                    acc = max(-1.0, min(1.0, acc + c))
                new_rows[p].append(dict(p=p, u=u, r=first["r"], h=q(acc), key=(0, 0, first["r"], q(acc))))
        by_p = new_rows
    per_user = defaultdict(list)
    for rs in by_p.values():
        for b in rs:
            per_user[b["u"]].append(b["h"])
    return {u: q(sum(v) / len(v) / S) / S for u, v in per_user.items()}
