"""Conversation repair, sharding and the Merkle manifest against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from peerrank.llm import convrepair, merkle, sharding

CONVERSATIONS = "conv_id long, turn long, role string, text string"
DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long, g string, pos long, slot int, digest string"
SPACES = " \t\n\x0b\x0c\r"


# --- 11 conversations -----------------------------------------------------------


def following(state):
    return "a" if state == "u" else "u"


def with_insertions(states):
    found = dict(states)
    for _ in range(4):
        for q, (cost, audit, lines) in list(found.items()):
            to = following(q)
            way = (cost + 5, audit + "I", [*lines, {"u": "user:", "a": "assistant:"}[to]])
            if to not in found or way[:2] < found[to][:2]:
                found[to] = way
    return found


def repaired_by_hand(rows):
    """All states' cheapest (cost, audit, lines) carried from row to row."""
    seen, faults, states = set(), [], {"": (0, "", [])}
    for _, role, text in rows:
        body = text.strip(SPACES)
        fault = "blank" if not body else "duplicate" if (role, text) in seen else "" if body[-1] in ".!?" else "truncated"
        seen.add((role, text))
        faults.append(fault)
        after = {}
        for q, (cost, audit, lines) in with_insertions(states).items():
            ways = [("D", q, 2, [])]
            if fault not in ("blank", "duplicate"):
                more, initial = 5 * (fault == "truncated"), role[:1]
                if (initial == "s" and q == "") or (initial in ("u", "a") and initial == following(q)):
                    ways.append(("K", initial, more, [f"{role}:{text}"]))
                ways.append(("R", following(q), 1 + more, [{"u": "user:", "a": "assistant:"}[following(q)] + text]))
            for edit, to, price, line in ways:
                way = (cost + price, audit + edit, lines + line)
                if to not in after or way[:2] < after[to][:2]:
                    after[to] = way
        states = after
    cost, audit, lines = min((w for q, w in with_insertions(states).items() if q in ("", "a")), key=lambda w: w[:2])
    turns, n = [t for t, _, _ in rows if t is not None], Counter(faults)
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    return gaps, n["blank"], n["duplicate"], n["truncated"], illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()


def report_by_hand(rows):
    left, ids, show = defaultdict(list), set(), lambda v: " " if v is None else str(v)
    for conv, turn, role, text in rows:
        ids.add(conv)
        how, role, text = zlib.crc32(f"{show(conv)}:{show(turn)}".encode()) % 20, show(role), show(text)
        if how:
            text = "" if how == 1 else re.sub("[.!?]", "", text) if how == 2 else text
            left[conv] += [(turn, "user" if how == 4 else role, text)] * (2 if how == 3 else 1)
    said = lambda role, text: hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()
    ordered = {c: sorted(left[c], key=lambda v: (v[0] is not None, v[0] or 0, v[1], said(*v[1:]))) for c in ids}
    return sorted([(c, *repaired_by_hand(ordered[c])) for c in ids], key=str)


def talks(seed, conversations, lengths, plain=0.0):
    r, rows = random.Random(seed), []
    for c in range(conversations):
        for i in range(r.choice(lengths)):
            turn = r.choice([None, i, i, i, r.randrange(i + 3)])
            role = ("user", "assistant")[i % 2] if r.random() < plain else r.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None])
            text = r.choice(["a.", "b!", "c", "", " \t\n", None, "d? ", f"x{i}.", f"y{i}.", f"z{i}.\n", f"w{i}", "é\U0001F600."])
            rows.append((c or None, turn, role, text))
    return rows


def reported(spark, rows):
    return sorted([tuple(x) for x in convrepair.repair_report(spark.createDataFrame(rows, CONVERSATIONS)).collect()], key=str)


def test_repair_equals_brute_force(spark):
    rows = talks(1, 60, [1, 1, 2, 5, 9, 20])
    assert reported(spark, rows) == report_by_hand(rows)


def test_repair_in_many_blocks_and_tiers_equals_brute_force(spark, monkeypatch):
    for name, value in (("BLOCK", 4), ("FAN", 3), ("SHORT", 1)):
        monkeypatch.setattr(convrepair, name, value)
    rows = talks(2, 8, [3, 40, 150], plain=0.5)
    assert reported(spark, rows) == report_by_hand(rows)


def test_repair_of_a_hot_conversation_and_repeated_rows(spark):
    rows = [(7, i, ("user", "assistant")[i % 2], f"t{i}.") for i in range(3000)] + [(7, 3, "assistant", "same.")] * 300
    rows += [(8, 1, "user", "x" * 200_000 + "."), (8, 2, "assistant", "ok."), (9, None, None, None)]
    assert reported(spark, rows) == report_by_hand(rows)


def test_repair_of_nothing(spark):
    assert reported(spark, []) == []
    dropped = next(t for t in range(1000) if zlib.crc32(f"5:{t}".encode()) % 20 == 0)
    empty = hashlib.sha256().hexdigest()
    assert reported(spark, [(5, dropped, "user", "hello.")]) == [(5, 0, 0, 0, 0, 0, 0, "", empty)]


def test_repaired_rows_follow_the_grammar(spark):
    done = convrepair.repair(spark.createDataFrame(talks(3, 40, [2, 6, 12]), CONVERSATIONS))
    kept = defaultdict(list)
    for x in done.repaired.collect():
        kept[x.k].append((x.place, x.part, x.role, x.edit, x.text))
    for x in done.summary.collect():
        rows = sorted(kept[x.k])
        assert re.fullmatch("(s?(ua)+)?", "".join(r[2][:1] for r in rows))
        assert "".join(r[3] for r in rows) == x.audit.replace("D", "")
        assert all(r[4] == "" for r in rows if r[3] == "I")


@pytest.mark.parametrize("short", [1, 7])
def test_crossings_find_the_least_audit_among_equal_costs(monkeypatch, short):
    monkeypatch.setattr(convrepair, "SHORT", short)
    r = random.Random(short)
    for _ in range(200):
        symbols = "".join(r.choice("xsuaoSUAO") for _ in range(r.randint(1, 40)))
        best = {0: (0, "")}
        for s in symbols:
            after = {}
            for (p, q), (cost, edits) in convrepair.row_edits(s).items():
                if p in best:
                    way = (best[p][0] + cost, best[p][1] + edits)
                    after[q] = min(after.get(q, way), way)
            best = after
        for q, (cost, audit) in best.items():
            matrices = [convrepair.row_matrix(s) for s in symbols]
            states = convrepair.crossings(matrices, 0, q)
            ways = [convrepair.row_edits(s)[states[i], states[i + 1]] for i, s in enumerate(symbols)]
            assert (sum(w[0] for w in ways), "".join(w[1] for w in ways)) == (cost, audit)


# --- 12 shards ------------------------------------------------------------------


def jump(key, shards):
    """The published algorithm."""
    key, at, after = key & (2**64 - 1), -1, 0
    while after < shards:
        at = after
        key = (key * 2862933555777941757 + 1) % 2**64
        after = int((at + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return at


@pytest.mark.parametrize("shards", [1, 2, 24, 25, 1000, 100_000])
def test_jump_hash_is_the_published_one(spark, shards):
    r = random.Random(shards)
    keys = [r.getrandbits(64) - 2**63 for _ in range(400)] + [*range(-20, 200), -(2**63), 2**63 - 1]
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    assert all(x.shard == jump(x.k, shards) for x in sharding.with_shard(df, "k", shards).collect())


def test_jump_hash_is_even_and_moves_only_into_the_new_shard(spark):
    df = spark.range(20_000).selectExpr("concat('doc-', id) AS name")
    a, b = sharding.with_shard(df, "name", 24, "a"), sharding.with_shard(df, "name", 25, "b")
    rows = a.join(b, "name").collect()
    assert all(x.a == x.b or x.b == 24 for x in rows)
    moved, sizes = sum(x.a != x.b for x in rows), Counter(x.a for x in rows)
    assert 0.8 * 20_000 / 25 < moved < 1.2 * 20_000 / 25
    assert len(sizes) == 24 and all(0.8 * 20_000 / 24 < n < 1.2 * 20_000 / 24 for n in sizes.values())


def odd(lorem):
    """Nulls, empty and long texts, a key with a third of the rows, repeated rows."""
    rows = [(None, None, None, None, None), (None, "x", "en", "s", 1), (1, "", "", "s", 0), (2, "é\U0001F600", "fr", None, 2)]
    rows += [(3, lorem(20_000, 3), "en", "s", 99), (2**63 - 1, "big", "en", "s", 2**63 - 1), (-4, "neg", None, "s", None)]
    rows += [(5, "same", "en", "s", 4)] * 60 + [(5, f"other {i}", "en", "s", 4) for i in range(10)]
    rows += [(i, lorem(i % 9, i), ("en", "de", "en")[i % 3], "t", i) for i in range(10, 120)]
    return [(*r, "g", 5, 6, "d") for r in rows]


def test_shards_of_odd_rows(spark, lorem):
    rows = odd(lorem)
    found = sharding.placed_in_shards(spark.createDataFrame(rows, DOCUMENTS)).collect()
    want = Counter((r[0], 8 + len((r[1] or "").encode()), zlib.crc32((r[1] or "").encode()),
                    jump(42 if r[0] is None else r[0], 24), jump(42 if r[0] is None else r[0], 25)) for r in rows)
    assert Counter((x.doc_id, x.size, x.text_crc32, x.shard, x.grown_shard) for x in found) == want
    assert {x.law for x in found} == {"key"}
    for shard in range(24):
        own = sorted((x for x in found if x.shard == shard), key=lambda x: x.slot)
        assert [x.slot for x in own] == list(range(len(own)))
        order = [(x.doc_id is not None, x.doc_id or 0, x.text_crc32, x.size) for x in own]
        assert order == sorted(order)
    assert sharding.placed_in_shards(spark.createDataFrame([], DOCUMENTS)).collect() == []


def test_written_shards_hold_all_rows_and_split_a_hot_one(spark, lorem, tmp_path):
    rows = odd(lorem)
    df = spark.createDataFrame(rows, DOCUMENTS)
    path = str(tmp_path / "shards")
    sharding.write_shards(df, "doc_id", 4, path, files_a_shard=3)
    back = spark.read.parquet(path)
    assert Counter(tuple(x) for x in back.select(df.columns).collect()) == Counter(rows)
    assert all(x.shard == jump(42 if x.doc_id is None else x.doc_id, 4) for x in back.select("doc_id", "shard").collect())
    hot = jump(5, 4)
    assert len(list((tmp_path / "shards" / f"shard={hot}").glob("*.parquet"))) == 3


# --- 13 manifest ----------------------------------------------------------------


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def row_leaf(r, longer=0):
    values = (r[0], r[3], r[2], None if r[4] is None else r[4] + longer, r[1])
    return digest(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def tree(nodes, fan):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([digest(*levels[-1][i : i + fan]) for i in range(0, len(levels[-1]), fan)])
    proofs = []
    for i in range(len(nodes)):
        proof = []
        for level in levels[:-1]:
            first = i - i % fan
            proof.append(("".join(level[first:i]), "".join(level[i + 1 : first + fan])))
            i //= fan
        proofs.append(proof)
    return levels[-1][0], proofs


def manifest_by_hand(rows, fan=2):
    groups = defaultdict(list)
    for r in rows:
        groups[r[2]].append((r[0] is not None, r[0] or 0, row_leaf(r), r))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in order:
        groups[g].sort(key=lambda x: x[:3])
        trees[g] = tree([x[2] for x in groups[g]], fan)
    root, upper = tree([trees[g][0] for g in order], fan)
    found = []
    for g, above in zip(order, upper):
        for (_, _, leaf, r), below in zip(groups[g], trees[g][1]):
            hit = r[0] is not None and r[4] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0
            node, proof = row_leaf(r, int(hit)), below + above
            for left, right in proof:
                node = digest(left, node, right)
            found.append((r[0], leaf, trees[g][0], root, digest(*[a + b for a, b in proof]), node, node == root))
    return sorted(found, key=str)


def manifested(df):
    return sorted([tuple(x) for x in merkle.manifest_report(df).collect()], key=str)


def test_manifest_of_odd_rows_equals_brute_force(spark, lorem):
    rows = odd(lorem)
    found = manifested(spark.createDataFrame(rows, DOCUMENTS))
    assert found == manifest_by_hand(rows)
    assert any(not x[-1] for x in found) and any(x[-1] for x in found)
    assert manifested(spark.createDataFrame([], DOCUMENTS)) == []
    assert manifested(spark.createDataFrame(rows[3:4], DOCUMENTS)) == manifest_by_hand(rows[3:4])


@pytest.mark.parametrize("fan, depth", [(2, 1), (2, 3), (3, 2), (5, 1)])
def test_manifest_over_many_tiers_and_other_fans(spark, lorem, fan, depth):
    from pyspark.sql import functions as F

    rows = odd(lorem)
    df = spark.createDataFrame(rows, DOCUMENTS)
    found = merkle.manifest(df, F.col("lang"), F.col("doc_id"), F.struct("doc_id"), merkle.leaf([F.col(c) for c in merkle.FIELDS]), fan, depth)
    found = found.select("item.doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("proof")), merkle.folded(F.col("leaf"), F.col("proof")))
    want = [(*x[:5], x[3]) for x in manifest_by_hand(rows, fan)]
    assert sorted([tuple(x) for x in found.collect()], key=str) == want
