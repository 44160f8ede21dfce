"""Each operator against a brute-force form, and on odd rows and empty tables."""

import gzip
import hashlib
import io
import itertools
import math
import random
import re
import zipfile
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from peerrank.llm import decontam, fuzzylines, licences, mixing, neardup, pii, tokenfile, toxicity, vptree, warczip
from peerrank.llm.components import connected_components

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
LABELS = "doc_id long, quality int, toxic int"


# --- 1 licences ---------------------------------------------------------------


def test_licence_places_match_brute_force(docs_of, lorem, odd_docs):
    rng = random.Random(1)
    phrases = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
    texts = []
    for i in range(40):
        parts = [lorem(rng.randint(0, 30), i * 7 + j) for j in range(4)]
        texts.append(" , ".join(x for p in parts for x in (p, rng.choice([*phrases, "MIT  License", "license mit", "public license"]))))
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    rows = licences.licence_report(docs_of([(i, t, "s") for i, t in enumerate(texts)])).collect()
    assert len(rows) == 40
    for r in rows:
        words = word.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in texts[r.doc_id]))
        found = [(i, label) for p, label in phrases.items() for i in range(len(words)) if words[i : i + len(p.split())] == p.split()]
        places = [i for i, _ in found]
        assert (r.n_words, r.n_base, r.first_word, r.last_word) == (len(words), len(places), min(places, default=None), max(places, default=None))
        assert r.base_labels == ",".join(sorted({x for _, x in found}))
        assert 0 <= r.score <= 1
    assert licences.licence_report(odd_docs).count() == 12


def test_licence_template_with_changed_words_is_found(docs_of, lorem):
    notice = licences.TEMPLATES[3].text.replace("obtaining a copy", "getting one copy")
    row = licences.licence_report(docs_of([(1, f"{lorem(50, 1)} {notice} {lorem(50, 2)}", "s")])).first()
    assert row.labels == "mit" and row.base_labels == "" and 0.8 < row.score < 1


def test_licence_words_far_off_do_not_hide_a_changed_notice(docs_of, lorem):
    notice = licences.TEMPLATES[3].text
    changed = notice.replace("obtaining a copy", "getting one copy").replace("any person", "every man")
    texts = [f"{lorem(50, 1)} {changed} {lorem(1000, 2)} {far}" for far in ("", "obtaining", "a", "any person obtaining a copy")]
    texts += [f"{far} {lorem(1000, 2)} {changed}" for far in ("a", "any person obtaining a copy of this")]
    texts += [f"{notice.replace('deal', 'work')} {lorem(1000, 2)} deal in the software without restriction"]
    rows = licences.licence_report(docs_of([(i, t, "s") for i, t in enumerate(texts)])).orderBy("doc_id").collect()
    assert [r.labels for r in rows] == ["mit"] * 6 + [""]


def changed_notices(lorem):
    """Files with licence texts, whole or in part, with words changed, left out and put in."""
    rng = random.Random(31)
    texts = []
    for i in range(120):
        words = []
        for j in range(rng.randint(1, 3)):
            notice = rng.choice(licences.TEMPLATES).text.split()
            rate = rng.choice([0.0, 0.05, 0.1, 0.2, 0.3, 0.4])
            for w in notice:
                x = rng.random()
                words += [] if x < rate / 2 else ["zq"] if x < rate else [w, "zz"] if x > 1 - rate / 4 else [w]
            words += lorem(rng.randint(1, 20), i * 5 + j).split()
        texts.append(" ".join(words))
    return texts


def every_cell(words, index, t):
    """The best (score, -cell) of a long template over all its alignments, by the plain recurrence."""
    template, slack, best = index.words[t], index.slack[t], None
    for cell in range(-len(template) // slack - 2, len(words) // slack + 3):
        lo, hi = (cell - 1) * slack, (cell + 1) * slack
        near = all(
            any(lo <= p - i < hi and words[p : p + len(k)] == k for p in range(len(words)) for i in places)
            for k, places in zip(index.keys[t], index.key_places[t], strict=True)
        )
        if near:
            row = [0] * (len(words) + 1)
            for i, x in enumerate(template):
                last, row = row, [0]
                for p, y in enumerate(words):
                    row.append(last[p] + 1 if x == y and lo <= p - i < hi else max(row[p], last[p + 1]))
            if row[-1] >= index.asked[t] and (best is None or row[-1] / len(template) > best):
                best = row[-1] / len(template)
    return best


def test_licence_index_finds_what_scoring_every_alignment_finds(lorem):
    index = licences.Index()
    texts = [licences.licence_words(t.encode()) for t in changed_notices(lorem)]
    counts = [sum(w in t for t in map(set, texts)) for w in index.vocabulary]
    idf = {w: math.log((1 + len(texts)) / (1 + n)) + 1 for w, n in zip(index.vocabulary, counts, strict=True)}
    postings, found, scored, cells = index.postings(idf), 0, 0, 0
    for words in texts:
        got = {t: s for t, _, s in licences.scan(words, index, idf, postings) if not index.notice[t]}
        want = {t: every_cell(words, index, t) for t in range(len(index.words)) if not index.notice[t]}
        assert got == {t: s for t, s in want.items() if s is not None}
        found += len(got)
        where = {w: [i for i, x in enumerate(words) if x == w] for w in set(words) & idf.keys()}
        scored += sum(len(c) for c in licences.candidates(where, index, postings).values())
        cells += sum(len(words) // s for s in index.slack)
        # without postings there are no candidates: labels come from the index only
        assert all(index.notice[t] for t, _, _ in licences.scan(words, index, idf, {}))
    assert found > 60 and scored < 0.2 * cells


def test_licence_index_does_not_depend_on_the_frequencies(lorem):
    index, rng = licences.Index(), random.Random(8)
    for text in changed_notices(lorem)[:40]:
        words, found = licences.licence_words(text.encode()), []
        for _ in range(3):
            idf = {w: rng.random() for w in index.vocabulary}
            found.append(sorted(licences.scan(words, index, idf, index.postings(idf))))
        assert found[0] == found[1] == found[2]


# --- 2 nearest neighbours -----------------------------------------------------


def test_exact_factor_equals_brute_force_and_relaxed_recall(spark):
    rng = np.random.default_rng(3)
    v = rng.standard_normal((1500, 16)).round(3)
    v[100:140] = v[7]  # copies
    rows = [(i, v[i].tolist(), 1) for i in range(1500)]
    rows += [(2000, None, 1), (2100, [0.0] * 16, 1), (2200, [float("nan")] + [1.0] * 15, 1), (None, v[0].tolist(), 1), (2300, [1.0, 2.0], 1)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    queries = table.filter("vec_id % 100 = 0")

    def truth(q):
        d = np.sqrt(((v - v[q]) ** 2).sum(axis=1))
        return [int(i) for i in np.lexsort((np.arange(1500), d)) if i != q][:10]

    for factor, least in ((1.0, 1.0), (1.5, 0.9)):
        found = {}
        for r in vptree.nearest(table, queries, factor=factor, shard_rows=400, leaf=32).orderBy("query_id", "rank").collect():
            found.setdefault(r.query_id, []).append(r.vec_id)
        assert sorted(found) == list(range(0, 1500, 100))  # the short vector meets no other of its length
        hits = [len(set(truth(q)) & set(f)) / 10 for q, f in found.items()]
        assert np.mean(hits) >= least
        if factor == 1.0:
            assert all(truth(q) == f for q, f in found.items())
    assert vptree.nearest(table.limit(0), queries).count() == 0


# --- 3 toxicity ---------------------------------------------------------------


def test_block_max_search_is_exact():
    rng = random.Random(2)
    vectors = [toxicity.weights({t: rng.randint(1, 3) for t in rng.sample(range(40), 5)}, np.linspace(1, 4, 40)) for _ in range(300)]
    index = toxicity.BlockMaxIndex(vectors, [0] * 300, list(range(300)), [bytes([i % 250]) for i in range(300)], block=16)
    for q in vectors[:40]:
        brute = sorted(((sum(w * v.get(t, 0.0) for t, w in q.items()), -e) for e, v in enumerate(vectors)), reverse=True)[:10]
        assert np.allclose([s for s, _ in index.nearest(q, 10)], [s for s, _ in brute if s > 0])


def test_block_max_search_by_block_and_by_term_is_exact():
    rng = random.Random(5)
    weight = np.linspace(1, 4, 300)
    vectors = [toxicity.weights({t: rng.randint(1, 3) for t in rng.sample(range(300), rng.randint(1, 30))}, weight) for _ in range(2000)]
    keys = [bytes(f"{i % 1500}", "ascii") for i in range(2000)]
    index = toxicity.BlockMaxIndex(vectors, [0] * 2000, list(range(2000)), keys, block=32)
    for n, q in enumerate(vectors[:60]):
        some = q if n % 2 else dict(list(q.items())[:1])  # few terms: few blocks can win
        for leave_out in (None, keys[n]):
            brute = sorted(
                ((sum(w * v.get(t, 0.0) for t, w in some.items()), -e) for e, v in enumerate(vectors) if keys[e] != leave_out), reverse=True
            )[:15]
            got = index.nearest(some, 15, leave_out)
            assert np.allclose([x for x, _ in got], [x for x, _ in brute if x > 0])
            assert all(abs(sum(w * vectors[e].get(t, 0.0) for t, w in some.items()) - x) < 1e-9 for x, e in got)
    assert index.nearest({999: 1.0}, 5) == [] and toxicity.BlockMaxIndex([], [], [], []).nearest({0: 1.0}, 5) == []


def test_toxicity_neighbours_equal_brute_force_cosine(spark, docs_of, lorem):
    rng = random.Random(6)
    rows = [(i, " ".join([lorem(40, i), *rng.sample(["vile", "awful", "nasty", "grim"], 2 if i % 3 == 0 else 0)]), "s") for i in range(300)]
    docs = docs_of(rows)
    labels = spark.createDataFrame([(i, 1, int(i % 3 == 0)) for i in range(300)], LABELS)
    model = toxicity.fit(docs, labels)
    counter = toxicity.TermCounter(model.vocabulary)
    trained = [i for i in range(300) if zlib.crc32(str(i).encode()) % 5]
    vectors = {i: toxicity.weights(counter(rows[i][1]), model.idf) for i in range(300)}
    for r in toxicity.score_documents(docs, model).collect():
        cosine = {i: sum(w * vectors[i].get(t, 0.0) for t, w in vectors[r.doc_id].items()) for i in trained if i != r.doc_id}
        best = sorted((x for x in cosine.values() if x > 1e-12), reverse=True)[: model.k]
        assert np.allclose([cosine[e] for e in r.evidence], best) and abs(r.similarity - (best[0] if best else 0)) < 1e-9


def test_toxicity_held_out_accuracy_and_filter(spark, docs_of, lorem, odd_docs):
    rows, marks = [], []
    for i in range(600):
        bad = i % 3 == 0
        rows.append((i, lorem(60, i) + (" vilezz awfulqq" if bad else ""), "s"))
        marks.append((i, 1, int(bad)))
    docs, labels = docs_of(rows), spark.createDataFrame([*marks, (None, 1, 1), (5, 1, None)], LABELS)
    scored = toxicity.toxicity_report(docs, labels).collect()
    assert all(r.predicted == int(r.doc_id % 3 == 0) and 0 <= r.score <= 1 for r in scored)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in scored)
    kept = toxicity.drop_toxic(docs, labels)
    assert kept.count() == 400 and kept.columns == docs.columns
    assert toxicity.toxicity_report(odd_docs, labels).count() == 12
    assert {r.score for r in toxicity.toxicity_report(odd_docs, labels.limit(0)).collect()} == {0.0}


# --- 4 token files ------------------------------------------------------------


def test_token_files_round_trip(spark, docs_of, odd_docs, lorem, tmp_path):
    texts = ["It's 'sabc. I'll go, they've.", "á ́b <|endoftext|>x, İstanbul. ΟΔΟΣ.", "tab\tand nbsp em\x1cfs", "한글 ﬁ ½ 1,234.56!?", "..., .a. b,", "가 x"]
    docs = docs_of([(i * 3, t + " " + lorem(200, i), "s") for i, t in enumerate(texts * 3)]).unionByName(odd_docs)
    tokenizer = Tokenizer.from_file(TOKENIZER)
    manifest = tokenfile.write_token_files(docs, str(tmp_path / "t"), TOKENIZER, frame_bytes=512)
    got = tokenfile.read_report(spark, manifest).collect()
    rows = sorted(((r.doc_id is not None, r.doc_id or 0, r.text is not None, r.text or ""), r) for r in docs.select("doc_id", "text").collect())
    assert len(got) == len(rows)
    at = 0
    for (_, want), have in zip(rows, sorted(got, key=lambda r: r.start), strict=True):
        ids = [*tokenizer.encode(want.text or "", add_special_tokens=False).ids, 1]
        assert (have.doc_id, have.start, have.n_tokens, have.ids_crc32) == (want.doc_id, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
    assert tokenfile.token_file_report(docs.limit(0), TOKENIZER).count() == 0


def test_reader_takes_only_the_frames_it_needs_and_checks_them():
    sink = pa.BufferOutputStream()
    writer = tokenfile.TokenFileWriter(sink, 2, frame_bytes=64)
    for i in range(20):
        writer.add(i, np.arange(i, i + 30, dtype="<u2").tobytes())
    writer.close()
    data = bytearray(sink.getvalue().to_pybytes())
    reader = tokenfile.TokenFileReader(pa.BufferReader(bytes(data)))
    assert [(d, ids.tolist()) for d, ids in reader.find({7})] == [(7, list(range(7, 37)))]
    data[int(reader.offsets[0]) + 12] ^= 255
    broken = tokenfile.TokenFileReader(pa.BufferReader(bytes(data)))
    assert [d for d, _ in broken.find({19})] == [19]  # another frame: unharmed
    with pytest.raises(Exception):
        list(broken.find({0}))


# --- 5 mixing -----------------------------------------------------------------


def test_mix_meets_targets(docs_of, lorem, odd_docs):
    rng = random.Random(4)
    rows = [(i, lorem(rng.randint(0, 80), i), rng.choice(["a", "a", "a", "b", "c", "d", None])) for i in range(900)]
    docs = docs_of(rows)
    out = mixing.mix(docs, block_rows=64).collect()
    assert len(out) == 900
    source = {i: s for i, _, s in rows}
    size = {i: len(t.split()) for i, t, _ in rows}
    names = sorted({s for s in source.values() if s is not None}) + [None]
    sizes = {s: sum(size[i] for i in size if source[i] == s) for s in names}
    weights = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    left, free, target = 1.5 * sum(sizes.values()), set(names), {}
    while free:
        share = {s: left * weights[s] / sum(weights[x] for x in free) for s in free}
        over = {s for s in free if share[s] >= 2 * sizes[s]}
        if not over:
            target |= share
            break
        for s in over:
            target[s] = 2.0 * sizes[s]
            left -= target[s]
        free -= over
    taken = dict.fromkeys(names, 0)
    for r in out:
        s = source[r.doc_id]
        assert r.size == size[r.doc_id] and r.source_size == sizes[s] and r.target == pytest.approx(target[s])
        assert 0 <= r.taken <= 2 * r.size
        taken[s] += r.taken
    assert all(abs(taken[s] - target[s]) <= 80 for s in names)
    assert sorted(out) == sorted(mixing.mix(docs.repartition(5), block_rows=64).collect())
    mixed = mixing.apply_mix(docs, block_rows=64)
    assert mixed.columns == docs.columns and mixed.count() == sum(r.copies for r in out)
    assert mixing.mix(odd_docs).count() == 12 and mixing.mix(docs.limit(0)).count() == 0


def test_flight_keeps_both_balances():
    rng = random.Random(1)
    sizes = [float(rng.randint(1, 50)) for _ in range(500)]
    probs = [rng.random() for _ in sizes]
    out = mixing.flight(sizes, probs, rng)
    assert sum(0 < p < 1 for p in out) <= 2
    assert sum(out) == pytest.approx(sum(probs)) and np.dot(sizes, out) == pytest.approx(np.dot(sizes, probs))


# --- 6 near duplicates --------------------------------------------------------


def near_dups_brute(rows, k, percent):
    sets = []
    for _, text in rows:
        w = (text or "").encode().lower().split()
        sets.append({tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set())
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, j in itertools.combinations(range(len(rows)), 2):
        both = len(sets[i] & sets[j])
        if sets[i] and 100 * both >= percent * len(sets[i] | sets[j]):
            parent[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[root(i)] = min(least.get(root(i), d), d)
    return {(d, len(sets[i]), least[root(i)]) for i, (d, _) in enumerate(rows)}


def test_near_dups_match_brute_force(docs_of, lorem, odd_docs, spark):
    rng = random.Random(6)
    rows = []
    for g in range(30):
        base = lorem(rng.randint(1, 120), g).split()
        for _ in range(rng.randint(1, 9)):
            w = list(base)
            for _ in range(rng.randint(0, max(1, len(w) // 12))):
                w[rng.randrange(len(w))] = rng.choice(["Alpha", "beta", "GAMMA"])
            rows.append((len(rows), " ".join(w)))
    rows += [(1000, None), (1001, ""), (1002, " \n"), (1003, "one"), (1004, "ONE"), (1005, "one two")]
    docs = docs_of([(d, t, "s") for d, t in rows])
    for k in (2, 5):
        got = neardup.near_dup_report(docs, shingle=k).collect()
        assert {(r.doc_id, r.n_shingles, r.component_id) for r in got} == near_dups_brute(rows, k, 80)
        assert all(r.kept == (r.doc_id == r.component_id) for r in got)
    want = {c for _, _, c in near_dups_brute(rows, 5, 80)}
    kept = neardup.drop_near_dups(docs)
    assert {r.doc_id for r in kept.collect()} == want and kept.columns == docs.columns
    odd = neardup.drop_near_dups(odd_docs)
    assert odd.filter("text is not null and size(split(text, ' ')) = 40").count() == 1
    assert neardup.near_dup_report(odd_docs).count() == 12 and neardup.near_dup_report(docs.limit(0)).count() == 0


def test_sketch_never_rules_out_too_much():
    rng = np.random.default_rng(1)
    for _ in range(50):
        a, b = (np.unique(rng.integers(0, 1 << 62, 300, dtype=np.uint64)) for _ in range(2))
        b = np.unique(np.concatenate([a[:250], b[:40]]))
        differ = int(np.bitwise_count(neardup.parity_sketch(a).view(np.uint64) ^ neardup.parity_sketch(b).view(np.uint64)).sum())
        assert differ <= len(np.setxor1d(a, b))


def test_components(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(120)] + [(300 + i, 301 + i) for i in range(40)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    label = {x: x for e in edges for x in e}
    for _ in range(400):
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    assert all(got[x] == label[x] for x in got) and set(got) == {x for a, b in edges if a != b for x in (a, b)}


# --- 7 decontamination --------------------------------------------------------


def test_decontamination_finds_items_and_paraphrases(spark, docs_of, lorem, odd_docs):
    items = [(i, lorem(30, 500 + i).capitalize() + ". " + lorem(6, 800 + i) + ".") for i in range(12)] + [(50, None), (51, "")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    rows = [(i, lorem(300, i), "s") for i in range(60)]
    for i in range(12):
        words = items[i][1].split()
        if i % 2:
            words[3], words[11], words[19] = "qqq", "rrr", "sss"
        rows.append((100 + i, lorem(150, 90 + i) + " " + " ".join(words) + " " + lorem(150, 70 + i), "s"))
    docs = docs_of(rows)
    found = decontam.contaminated(docs, benchmark).collect()
    assert {(r.doc_id, r.item_id) for r in found} == {(100 + i, i) for i in range(12)}
    kept = decontam.drop_contaminated(docs, benchmark)
    assert kept.count() == 60 and kept.columns == docs.columns
    assert decontam.contaminated(odd_docs, benchmark).count() == 0
    assert decontam.contaminated(docs, benchmark.limit(0)).count() == 0 and decontam.contaminated(docs.limit(0), benchmark).count() == 0


def test_short_and_repeated_items_are_found_wherever_they_stand(spark, docs_of, lorem):
    rng = random.Random(17)
    texts = [lorem(rng.randint(1, 120), 3000 + i) for i in range(150)]
    words = [t.lower().split() for t in texts]
    items = []
    for i in range(60):  # one to six words cut out of the documents, so some of them stand in many
        w = rng.choice(words)
        at = rng.randrange(len(w))
        items.append((i, " ".join(w[at : at + rng.randint(1, 6)])))
    items += [(60, items[0][1]), (0, items[0][1]), (61, words[3][0])]  # repeated rows, one word
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    docs = docs_of([(i, t, "s") for i, t in enumerate(texts)])
    plain = [decontam.words_of(t) for t in texts]
    want = {
        (d, i) for i, text in items for d, w in enumerate(plain) for x in [decontam.words_of(text)]
        if any(w[p : p + len(x)] == x for p in range(len(w)))
    }
    for settings in (decontam.Settings(), decontam.Settings(block_chars=300)):  # one block, several
        found = decontam.contaminated(docs, benchmark, settings).collect()
        assert want <= {(r.doc_id, r.item_id) for r in found}
        times = sum(r.item_id == 0 for r in found)
        assert times == 2 * sum(r.item_id == 60 for r in found) > 0  # the item's row is there twice
        # what else is found holds most of the item, in order
        for r in found:
            x = next(decontam.words_of(t) for i, t in items if i == r.item_id)
            share = decontam.lcs_length(np.array([hash(w) for w in x]), np.array([hash(w) for w in plain[r.doc_id]])) / len(x)
            assert share >= 0.6 and (len(x) > 2 or share == 1)


def test_paraphrases_due_by_the_rule_are_found(spark, docs_of, lorem):
    rng = random.Random(23)
    items = [(i, lorem(rng.randint(15, 50), 4000 + i).capitalize() + ". " + lorem(5, 4500 + i) + ".") for i in range(60)]
    rows, due = [], set()
    for n, (i, text) in enumerate(items * 4):
        words = [f"qz{rng.randrange(999)}" if rng.random() < (0, 0.1, 0.2, 0.3)[n // len(items)] else w for w in decontam_words(text)]
        rows.append((n, f"{lorem(90, n)} {' '.join(words)} {lorem(70, n + 7)}", "s"))
        item, answer = decontam_words(text), decontam_words(text)[-5:]
        share = sum(a == b for a, b in zip(item, words, strict=True)) / len(item)
        ends = sum(a == b for a, b in zip(answer, words[-5:], strict=True)) / 5
        if share >= 0.8 or share >= 0.6 and ends >= 0.6:
            due.add((n, i))
    found = decontam.contaminated(docs_of(rows), spark.createDataFrame(items, "item_id long, text string")).collect()
    got = {(r.doc_id, r.item_id) for r in found}
    assert len(due) > 180 and len(due - got) <= 0.02 * len(due)
    assert all(i == d % len(items) for d, i in got)


def decontam_words(text):
    return [w.decode() for w in decontam.words_of(text)]


def test_lcs_matches_dynamic_programme():
    rng = random.Random(2)
    for _ in range(200):
        a, b = ([rng.randrange(5) for _ in range(rng.randint(1, 20))] for _ in range(2))
        t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, j in itertools.product(range(len(a)), range(len(b))):
            t[i + 1][j + 1] = t[i][j] + 1 if a[i] == b[j] else max(t[i][j + 1], t[i + 1][j])
        assert decontam.lcs_length(np.array(a), np.array(b)) == t[-1][-1]


# --- 8 WARC packages ----------------------------------------------------------


def test_packages_round_trip_and_are_valid_zip(spark, tmp_path):
    pages = [(i, f"http://h/{i}", f"<p>é{i % 7}</p>" * 5, 1) for i in range(40)] + [(90, None, None, 1), (91, "u v", "", 1), (None, "x", "<p>é1</p>" * 5, 1)]
    table = spark.createDataFrame(pages, "page_id long, url string, html string, digest int")
    for zip64 in (False, True):
        manifest = warczip.write_packages(table, str(tmp_path / f"w{zip64}"), zip64=zip64)
        got = {r.page_id: r for r in warczip.read_packages(spark, [m["path"] for m in manifest]).collect()}
        assert len(got) == len(pages)
        for page, _, html, _ in pages:
            payload = (html or "").encode()
            first = min(p for p, _, h, _ in pages if (h or "") == (html or "") and p is not None)
            r = got[page]
            assert (r.payload_bytes, r.payload_digest) == (len(payload), warczip.payload_digest(payload))
            assert (r.record_type, r.refers_to) == (("response", None) if page == first else ("revisit", first))
        with zipfile.ZipFile(manifest[0]["path"].removeprefix("file://")) as z:
            assert z.testzip() is None
            gzip.decompress(z.read(warczip.WARC_MEMBER))
    assert warczip.archive_report(table.limit(0)).count() == 0


def test_reader_takes_packages_of_other_writers():
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as z:
        z.writestr("a.txt", b"hello")
        with z.open("b.txt", "w", force_zip64=True) as f:
            f.write(b"world")
        z.comment = b"PK\x05\x06 in a comment"
    reader = warczip.ZipReader(pa.BufferReader(out.getvalue()))
    for name, content in (("a.txt", b"hello"), ("b.txt", b"world")):
        start, size = reader.place(name)
        assert out.getvalue()[start : start + size] == content


# --- 9 fuzzy lines ------------------------------------------------------------


def test_fuzzy_lines(docs_of, lorem, odd_docs):
    line = lorem(120, 1)
    near = line.replace(line.split()[60], "zzzz", 1)
    docs = docs_of([
        (1, f"{line}\n{lorem(9, 2)}\n123", "s"), (2, f"{lorem(9, 3)}\n{line.upper()} !\n123", "s"), (3, f"{near}\n{lorem(20, 4)}", "s"),
        (4, " ".join([line] * 300), "s"),
    ])
    got = {r.doc_id: r for r in fuzzylines.line_report(docs).collect()}
    assert (got[1].dropped_lines, got[2].dropped_lines) == ("", "1") and got[2].n_equal == 1
    clean = {r.doc_id: r.text for r in fuzzylines.drop_fuzzy_lines(docs).collect()}
    assert clean[1] == f"{line}\n{lorem(9, 2)}\n123" and clean[2] == f"{lorem(9, 3)}\n123"
    assert fuzzylines.line_report(odd_docs).count() == 12 and fuzzylines.line_report(docs.limit(0)).count() == 0


def edit_distance(a, b):
    row = np.arange(len(b) + 1)
    b = np.array([ord(c) for c in b])
    for i, c in enumerate(a, 1):
        step = np.minimum(row[1:] + 1, row[:-1] + (b != ord(c)))
        row = np.minimum.accumulate(np.concatenate(([i], step)) - np.arange(len(b) + 1)) + np.arange(len(b) + 1)
    return int(row[-1])


def test_near_lines_of_all_lengths_are_found(docs_of):
    rng = random.Random(12)
    rows, near = [], {}
    for n in (5, 7, 10, 15, 20, 30, 40, 60, 80, 100):
        for edits in ("one", "word", "half", "all"):
            for _ in range(4):
                line = " ".join("".join(rng.choice("abcdefghijklmnopqrst") for _ in range(rng.randint(2, 9))) for _ in range(n))
                most = len(line) // 10
                letters = list(line)
                if edits == "word":
                    at = rng.choice([i for i, w in enumerate(line.split()) if len(w) <= most] or [0])
                    letters = list(" ".join("zz" if i == at else w for i, w in enumerate(line.split())))
                else:
                    for at in rng.sample([i for i, c in enumerate(line) if c != " "], {"one": 1, "half": max(1, most // 2), "all": most}[edits]):
                        letters[at] = rng.choice("uvwxyz")
                other = "".join(letters)
                rows += [(len(rows), line, "s"), (len(rows) + 1, other, "s")]
                if 10 * edit_distance(line, other) <= max(len(line), len(other)):
                    near[len(rows) - 1] = len(line), edits
    got = {r.doc_id: r.n_near for r in fuzzylines.line_report(docs_of(rows)).collect()}
    assert not [d for d in got if got[d] and d not in near]
    lost = [near[d] for d in near if not got[d]]
    assert not [x for x in lost if x[0] < 86 or x[1] != "all"] and len(lost) <= 0.02 * len(near), lost


def test_lines_that_no_line_of_their_key_is_near_to_are_dropped_early(docs_of, spark):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefghijklmnopqrst") for _ in range(rng.randint(2, 9)))
    line = lambda n: " ".join(word() for _ in range(n))
    phrase = "the very same phrase in all of these lines"
    # the phrase stands at places, or in lines of lengths, that no near pair allows
    far = [line(a) + " " + phrase + " " + line(b) for a, b in ((0, 60), (60, 0), (2, 200), (150, 150), (1, 2), (6, 4))]
    alike = line(50)
    texts = [*far, alike, alike.replace(" ", " z", 1), "x" * 80, "x" * 78]
    norms = spark.createDataFrame([(i, len(t), t) for i, t in enumerate(texts)], "node long, size int, norm string")
    kept = fuzzylines._crowded(norms, 0.9).collect()
    assert {r.node for r in kept} == {6, 7, 8, 9}
    # a line that has an n-gram often has one row of it, without a place
    assert all(r.at is None for r in kept if r.node > 7) and len({(r.key, r.node) for r in kept}) == len(kept)
    keys = {i: c for i, c in fuzzylines.gram_keys(norms, 0.9).groupBy("node").count().collect()}
    assert all(20 <= keys[i] <= 70 for i in (0, 1, 2, 3, 6, 7))
    got = {r.doc_id: r.n_near for r in fuzzylines.line_report(docs_of([(i, t, "s") for i, t in enumerate(texts)])).collect()}
    assert {i for i in got if got[i]} == {7, 9}


def test_lines_that_differ_in_a_number_only(docs_of):
    table = "\n".join(["Total: 100", "a = 1", "7", "7", "12, 13"])
    other = "\n".join(["Total: 2,750", "a = 2", "7", "TOTAL 100!", "12, 13"])
    got = {r.doc_id: r for r in fuzzylines.line_report(docs_of([(1, table, "s"), (2, other, "s")])).collect()}
    assert got[1].dropped_lines == "" and (got[2].dropped_lines, got[2].n_equal, got[2].n_near) == ("3", 1, 0)


# --- 10 PII -------------------------------------------------------------------


def luhn_ok(d):
    return sum(x if i % 2 == 0 else x * 2 - 9 * (x > 4) for i, x in enumerate(map(int, reversed(d)))) % 10 == 0


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def base_spans(text):
    out = []
    for rank, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text):
            d = re.sub("[^0-9]", "", m[0])
            if {"email": True, "ip": all(int(x) <= 255 for x in m[0].split(".")) if kind == "ip" else 0, "card": 12 <= len(d) <= 19 and luhn_ok(d), "phone": 9 <= len(d) <= 15}[kind]:
                out.append((m.start(), rank, f"{kind}:{m.start()}:{m.end()}"))
    return [s for _, _, s in sorted(out)]


def test_pii_matches_brute_force(docs_of, odd_docs):
    rng = random.Random(9)
    pieces = ["a.b@c.d_e@f.g", "x@y.z", "@@a@b.c", "1.2.3.4.5.6.7.8", "256.1.1.1", "00010.0255.1.1", "4111 1111 1111 1111", "4111-1111-1111-1112",
              "+1 (234) 567-8901", "++49 30 123456 7", "é\U0001F600", "5500005555555559", " ", "+", "\n", "q%@r-s.t-", "12345678901234567890", "1.1.1.1@h.co"]
    texts = ["".join(rng.choice(pieces) + rng.choice(["", " ", "x"]) for _ in range(12)) for _ in range(300)] + ["1" * 30_000, "a" * 30_000, "+1" + "(" * 5_000]
    rows = pii.pii_report(docs_of([(i, t, "s") for i, t in enumerate(texts)])).collect()
    for r in rows:
        want = base_spans(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest(), texts[r.doc_id]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s.startswith(k) for s in want) for k in PATTERNS]
    assert pii.pii_report(odd_docs).count() == 12


def test_iban_and_context(docs_of):
    a, b = pii.pii_report(docs_of([(1, "my bank account DE89 3704 0044 0532 0130 00 ok", "s"), (2, "DE88370400440532013000", "s")])).orderBy("doc_id").collect()
    assert "iban:16:43" in a.spans and a.max_score == 1.0 and "iban" not in b.spans


def test_iban_before_other_words(docs_of):
    iban, spaced = "DE89370400440532013000", "DE89 3704 0044 0532 0130 00"
    cases = [(f"{i}{after}", [(0, len(i))]) for i in (iban, spaced) for after in
             (" BIC COBADEFFXXX", " Please", " Bank", " OK", " 12", " 1234 5678", ", Bank", "", " GB", ".", "\nAB12")]
    cases += [(f"{iban} {spaced}", [(0, 22), (23, 50)]), (f"AB12 {spaced} AB", [(5, 32)]), (f"{iban}X", []), (f"{iban}x", []),
              (f"x{iban}", []), (f"\U0001F600 {iban} NO9386011117947 A", [(2, 24), (25, 40)]), ("DE88370400440532013000 BIC", [])]
    for r in pii.pii_report(docs_of([(i, t, "s") for i, (t, _) in enumerate(cases)])).collect():
        text, want = cases[r.doc_id]
        assert [s for s in r.spans.split(",") if s.startswith("iban")] == [f"iban:{a}:{b}" for a, b in want], text
