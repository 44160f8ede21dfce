"""Benchmark decontamination by latent semantic retrieval.

1. One pass writes each document as the ids of its words in the benchmark's
   vocabulary (0: any other word); all later passes read those.
2. Document frequencies of the vocabulary over all passages of ``fit_words``
   words.  Words in more than ``max_df`` of the passages are stop words, except
   the ``keep_rarest`` rarest words of each item.
3. Distributed randomised SVD of the passages' TF-IDF matrix A: each task adds
   up its part of ``A^T (A G)`` for a random test matrix G (vocabulary x
   ``rank + oversample``, seeded); the sums are reduced by blocks of words.
   The Nystroem form of A^T A then gives the leading right singular vectors on
   the driver (vocabulary x rank numbers, whatever the corpus size).
4. Candidate search over every window of every document: windows of
   ``sizes`` words (stride half a window), each item belonging to one size;
   cosine in the latent space of at least ``least_cosine``.  Beside it, an item's
   rarest word is looked up in all documents, and its places where the whole item
   stands word for word are candidates too (of cosine 1): no verbatim copy is
   lost, however short or common its words.
5. Each candidate is checked word by word: longest common subsequence of the
   item and the window's surroundings, as a share of the item; and how much of
   the item's answer (its last sentence) the region holds.  Regions with too
   few of the item's words in any order cannot pass and are not aligned.  An item counts as
   contained with ``lcs >= certain``, or with ``lcs >= likely`` and an answer
   share of at least ``answer``.

Equal items are searched as one.  The benchmark is taken in blocks of about
``block_items`` different items or ``block_chars`` characters, whichever are
fewer, each searched in all documents, so what is broadcast does not grow with it.

Defined cases: null and empty texts hold nothing; items without words are
never found; an item of one or two words counts only if it stands in full;
repeated documents and items are reported each; an empty benchmark or corpus
gives no findings; other columns are ignored (report) or kept (filter).
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bound_batches, fresh, small_batches, written

FOUND = "doc_id long, text_key binary, item_key string, cosine double, lcs double, answer double, first_word int"
_WORD_BYTES = bytes(
    c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else c + 32 if 65 <= c <= 90 else 32 for c in range(256)
)
_SENTENCE = re.compile(r"[.!?]+(?:\s+|$)")


def words_of(text: str) -> list[bytes]:
    return text.lower().encode().translate(_WORD_BYTES).split()


@dataclass(frozen=True)
class Settings:
    rank: int = 128
    oversample: int = 16
    fit_words: int = 32
    max_df: float = 0.002
    keep_rarest: int = 4
    sizes: tuple[int, ...] = (8, 16, 32, 64, 128, 256)
    least_cosine: float = 0.35
    certain: float = 0.8
    likely: float = 0.6
    answer: float = 0.6
    seed: int = 7
    block_items: int = 2_000
    block_chars: int = 4_000_000


@dataclass(frozen=True)
class Items:
    keys: list[str]
    words: list[np.ndarray]
    answers: list[np.ndarray]
    vocabulary: dict[bytes, int]  # from 1


def prepare(rows: list[tuple[str, str]]) -> Items:
    vocabulary: dict[bytes, int] = {}
    keys, words, answers = [], [], []
    for key, text in rows:
        tokens = words_of(text)
        if not tokens:
            continue
        coded = np.array([vocabulary.setdefault(w, len(vocabulary) + 1) for w in tokens], dtype=np.int32)
        sentences = [s for s in (words_of(x) for x in _SENTENCE.split(text)) if s]
        size = max(len(sentences[-1]), min(3, len(tokens))) if sentences else len(tokens)
        keys.append(key)
        words.append(coded)
        answers.append(coded[-size:])
    return Items(keys, words, answers, vocabulary)


def lcs_length(a: np.ndarray, b: np.ndarray) -> int:
    """Longest common subsequence, bit-parallel over ``a``."""
    masks: dict[int, int] = {}
    for i, x in enumerate(a.tolist()):
        masks[x] = masks.get(x, 0) | 1 << i
    full = (1 << len(a)) - 1
    v = full
    for y in b.tolist():
        u = v & masks.get(y, 0)
        v = (v + u | v - u) & full
    return len(a) - bin(v).count("1")


# --- passages as sparse rows -------------------------------------------------


def window_cells(docs: list[np.ndarray], size: int, stride: int, informative: np.ndarray):
    """The informative words of all windows of several documents, as cells of
    a sparse matrix: row (running number), word, count per cell, and per row
    its document and window.  Windows start at multiples of ``stride``, the
    last one included; windows without informative words have no row.  None if
    there is no cell."""
    lengths = np.array([len(d) for d in docs], dtype=np.int64)
    ids = np.concatenate(docs) if docs else np.empty(0, dtype=np.int64)
    at = np.flatnonzero(informative[ids])
    if not len(at):
        return None
    begin = np.concatenate([[0], np.cumsum(lengths)])
    doc = np.searchsorted(begin, at, side="right") - 1
    place = at - begin[doc]
    last = np.maximum(0, -(-(lengths - size) // stride))  # number of each document's last window
    base = np.concatenate([[0], np.cumsum(last + 1)])
    first = np.maximum(0, (place - size) // stride + 1)
    copies = np.minimum(place // stride, last[doc]) - first + 1
    nth = np.arange(copies.sum()) - np.repeat(np.cumsum(copies) - copies, copies)
    window = np.repeat(base[doc] + first, copies) + nth
    words = len(informative)
    cell, count = np.unique(window * words + np.repeat(ids[at], copies), return_counts=True)
    window, word = cell // words, cell % words
    names, row = np.unique(window, return_inverse=True)
    owner = np.searchsorted(base, names, side="right") - 1
    return row, word, count, owner, names - base[owner]


def tfidf_rows(row: np.ndarray, word: np.ndarray, count: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Values of unit-length TF-IDF rows (``row`` ascending from 0)."""
    value = (1 + np.log(count)) * idf[word]
    norm = np.sqrt(np.bincount(row, weights=value * value))
    return value / norm[row]


def projected(row: np.ndarray, word: np.ndarray, value: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """Rows times ``basis``; every row number up to the last has a cell."""
    starts = np.flatnonzero(np.diff(row, prepend=-1))
    return np.add.reduceat(basis[word] * value[:, None].astype(basis.dtype), starts, axis=0)


# --- passes ------------------------------------------------------------------


def encode(docs: DataFrame, items: Items) -> DataFrame:
    """(doc_id, text_key, ids) with the vocabulary ids of all words, as bytes."""
    shared = docs.sparkSession.sparkContext.broadcast(items.vocabulary)  # one block of items
    dtype = _code_type(items)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = shared.value.get
        for batch in small_batches(batches):
            coded = [
                np.array([get(w, 0) for w in words_of(text or "")], dtype=dtype).tobytes()
                for text in batch.column(2).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(coded, pa.binary())], ["doc_id", "text_key", "ids"]
            )

    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key().alias("text_key"), "text")
    return written(keyed.mapInArrow(run, "doc_id long, text_key binary, ids binary"), "decontam-encoded")


def text_key():
    return F.unhex(F.md5(F.coalesce("text", F.lit(""))))


def _code_type(items: Items):
    return np.dtype("<u2") if len(items.vocabulary) < 1 << 16 else np.dtype("<u4")


def _decoded(batch: pa.RecordBatch, dtype) -> list[np.ndarray]:
    return [np.frombuffer(x, dtype=dtype).astype(np.int64) for x in batch.column(batch.schema.get_field_index("ids")).to_pylist()]


def frequencies(encoded: DataFrame, items: Items, s: Settings) -> tuple[np.ndarray, int]:
    """Passages per word, and passages, over all documents."""
    n, dtype = len(items.vocabulary) + 1, _code_type(items)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n, dtype=np.int64)
        for batch in small_batches(batches):
            for ids in _decoded(batch, dtype):
                passage = np.arange(len(ids)) // s.fit_words
                cells = np.unique(passage * n + ids)
                total += np.bincount(cells % n, minlength=n)
                total[0] += -(-len(ids) // s.fit_words) - np.count_nonzero(cells % n == 0)  # 0 counts passages
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"word": pa.array(some, pa.int64()), "passages": pa.array(total[some], pa.int64())})

    sums = encoded.select("ids").mapInArrow(run, "word long, passages long").groupBy("word").agg(F.sum("passages").alias("n")).collect()
    out = np.zeros(n, dtype=np.int64)
    for r in sums:  # one row per vocabulary word
        out[r["word"]] = r["n"]
    passages, out[0] = int(out[0]), 0
    return out, passages


def informative_words(items: Items, df: np.ndarray, passages: int, s: Settings) -> np.ndarray:
    """Which vocabulary ids count: rare enough, or among their item's rarest."""
    keep = df <= max(1.0, s.max_df * passages)
    keep[0] = False
    for words in items.words:
        distinct = np.unique(words)
        keep[distinct[np.lexsort((distinct, df[distinct]))][: s.keep_rarest]] = True
    return keep


def rarest_places(items: Items, df: np.ndarray) -> dict[int, list[tuple[int, int]]]:
    """(item, place of its rarest word) by that word."""
    out: dict[int, list[tuple[int, int]]] = {}
    for i, words in enumerate(items.words):
        at = int(np.argmin(df[words]))
        out.setdefault(int(words[at]), []).append((i, at))
    return out


def verbatim(docs: list[np.ndarray], items: Items, rarest: dict[int, list[tuple[int, int]]]) -> list[tuple[np.ndarray, ...]]:
    """(items, documents, starts, ones): the first place in a document where an
    item stands word for word, for every item and document."""
    begin = np.concatenate([[0], np.cumsum([len(d) for d in docs])])
    flat = np.concatenate(docs) if docs else np.empty(0, dtype=np.int64)
    wanted = np.zeros(len(items.vocabulary) + 1, dtype=bool)
    wanted[list(rarest)] = True
    at = np.flatnonzero(wanted[flat])
    at = at[np.argsort(flat[at], kind="stable")]
    names, lows = np.unique(flat[at], return_index=True)
    out = []
    for word, places in zip(names.tolist(), np.split(at, lows[1:]), strict=False):
        doc = np.searchsorted(begin, places, side="right") - 1
        for i, offset in rarest[word]:
            words, start = items.words[i], places - offset
            inside = (start >= begin[doc]) & (start + len(words) <= begin[doc + 1])
            start, owner = start[inside], doc[inside]
            for j, x in enumerate(words):
                same = flat[start + j] == x
                start, owner = start[same], owner[same]
                if not len(start):
                    break
            owner, first = np.unique(owner, return_index=True)
            out.append((np.full(len(owner), i), owner, start[first] - begin[owner], np.ones(len(owner))))
    return out


def fit_basis(encoded: DataFrame, items: Items, informative: np.ndarray, idf: np.ndarray, s: Settings) -> np.ndarray:
    """Vocabulary x rank: the leading right singular vectors of the passages."""
    spark = encoded.sparkSession
    n, dtype = len(items.vocabulary) + 1, _code_type(items)
    wide = min(s.rank + s.oversample, int(informative.sum()))
    shared = spark.sparkContext.broadcast((informative, idf))
    block = 256

    def test_matrix() -> np.ndarray:
        return np.random.default_rng(s.seed).standard_normal((n, wide)).astype(np.float32)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep, weight = shared.value
        omega, total = test_matrix(), np.zeros((n, wide))
        for batch in small_batches(batches):
            cells = window_cells(_decoded(batch, dtype), s.fit_words, s.fit_words, keep)
            if cells is None:
                continue
            row, word, count, _, _ = cells
            value = tfidf_rows(row, word, count, weight)
            y = projected(row, word, value, omega)
            order = np.argsort(word, kind="stable")
            starts = np.flatnonzero(np.diff(word[order], prepend=-1))
            total[word[order][starts]] += np.add.reduceat(y[row[order]] * value[order, None].astype(np.float32), starts, axis=0)
        part = TaskContext.get().partitionId()
        for b in range(0, n, block):
            some = total[b : b + block]
            if some.any():
                yield pa.RecordBatch.from_pydict({
                    "block": pa.array([b], pa.int32()), "part": pa.array([part], pa.int32()), "sums": pa.array([some.tobytes()], pa.binary())
                })

    def reduce(t: pa.Table) -> pa.Table:
        t = t.sort_by("part")  # a set order of additions
        parts = [np.frombuffer(x, dtype=np.float64) for x in t.column("sums").to_pylist()]
        return pa.table({"block": pa.array([t.column("block")[0].as_py()], pa.int32()), "sums": pa.array([sum(parts).tobytes()], pa.binary())})

    sums = encoded.select("ids").mapInArrow(partial, "block int, part int, sums binary").groupBy("block").applyInArrow(reduce, "block int, sums binary")
    z = np.zeros((n, wide))
    for r in sums.collect():  # vocabulary x (rank + oversample) numbers in all
        some = np.frombuffer(r["sums"], dtype=np.float64).reshape(-1, wide)
        z[r["block"] : r["block"] + len(some)] = some
    omega = test_matrix().astype(np.float64)
    omega[~informative] = 0
    # Nystroem: A^T A is near z core^+ z^T with core = omega^T z
    core = omega.T @ z
    core = (core + core.T) / 2
    q, r = np.linalg.qr(z)
    middle = r @ np.linalg.pinv(core, rcond=1e-10, hermitian=True) @ r.T
    values, vectors = np.linalg.eigh((middle + middle.T) / 2)
    top = np.argsort(-values, kind="stable")[: s.rank]
    return (q @ vectors[:, top[values[top] > 0]]).astype(np.float32)


def _unit(x: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(x, axis=1, keepdims=True)
    return np.divide(x, norm, out=np.zeros_like(x), where=norm > 1e-6)


def search(
    encoded: DataFrame, items: Items, informative: np.ndarray, idf: np.ndarray, basis: np.ndarray,
    rarest: dict[int, list[tuple[int, int]]], s: Settings,
) -> DataFrame:
    """One row per document and item contained in it."""
    dtype = _code_type(items)
    shared = encoded.sparkSession.sparkContext.broadcast((items, informative, idf, basis, rarest))  # one block of items

    def size_of(n: int) -> int:
        return next((x for x in s.sizes if n <= x * 1.5), s.sizes[-1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        its, keep, weight, base, rare = shared.value
        classes: dict[int, list[int]] = {}
        for i, words in enumerate(its.words):
            classes.setdefault(size_of(len(words)), []).append(i)
        latent = {}
        for size, members in classes.items():
            cells = window_cells([its.words[i].astype(np.int64) for i in members], 1 << 30, 1 << 30, keep)
            row, word, count, owner, _ = cells
            vectors = np.zeros((len(members), base.shape[1]), dtype=np.float32)
            vectors[owner] = projected(row, word, tfidf_rows(row, word, count, weight), base)
            latent[size] = _unit(vectors)
        for batch in small_batches(batches):
            docs = _decoded(batch, dtype)
            hits = verbatim(docs, its, rare)  # item, document, start, cosine
            for size, members in classes.items():
                cells = window_cells(docs, size, size // 2, keep)
                if cells is None:
                    continue
                row, word, count, owner, window = cells
                value = tfidf_rows(row, word, count, weight)
                starts = np.flatnonzero(np.diff(row, prepend=-1))
                names = np.array(members)
                for lo in range(0, len(starts), 2048):  # bounds the rows x items matrix
                    a, b = starts[lo], starts[lo + 2048] if lo + 2048 < len(starts) else len(row)
                    x = _unit(projected(row[a:b], word[a:b], value[a:b], base))
                    for j in range(0, len(members), 1024):
                        cosine = x @ latent[size][j : j + 1024].T
                        w, i = np.nonzero(cosine >= s.least_cosine)
                        hits.append((names[j + i], owner[lo + w], window[lo + w] * (size // 2), cosine[w, i]))
            out = _contained(docs, its, hits, size_of, s)
            if out:
                keys = batch.column(1).take(pa.array([x[0] for x in out]))
                ids = batch.column(0).take(pa.array([x[0] for x in out]))
                yield pa.RecordBatch.from_arrays(
                    [ids, keys, pa.array([its.keys[x[1]] for x in out], pa.string()), *[pa.array([x[c] for x in out], pa.float64()) for c in (2, 3, 4)],
                     pa.array([x[5] for x in out], pa.int32())],
                    [c.split()[0] for c in FOUND.split(", ")],
                )

    return encoded.mapInArrow(run, FOUND)


def _contained(docs, items: Items, hits, size_of, s: Settings) -> list[tuple]:
    """(document, item, cosine, lcs, answer share, first word) of the
    candidates that pass, one row per document and item."""
    if not hits:
        return []
    item, doc, start, cosine = (np.concatenate(x) for x in zip(*hits, strict=True))
    order = np.lexsort((cosine, start, doc, item))
    item, doc, start, cosine = (x[order] for x in (item, doc, start, cosine))
    out, place = [], np.zeros(len(items.vocabulary) + 1, dtype=np.int64)
    ends = np.flatnonzero((np.diff(item, append=-1) != 0) | (np.diff(doc, append=-1) != 0)) + 1
    last, a = None, 0
    for b in ends.tolist():
        i, d = int(item[a]), int(doc[a])
        if i != last:
            place[:] = 0
            distinct, counts = np.unique(items.words[i], return_counts=True)
            place[distinct] = np.arange(1, len(distinct) + 1)
            last = i
        hit = _verified(docs[d], items.words[i], items.answers[i], start[a:b].tolist(), cosine[a:b].tolist(), size_of(len(items.words[i])), place, counts, s)
        if hit:
            out.append((d, i, *hit))
        a = b
    return sorted(out)


def _verified(doc, words, answer, starts, cosines, size, place, counts, s: Settings):
    """(cosine, lcs, answer share, first word) of the best region, if it passes.

    Overlapping regions of neighbouring windows are joined first.  Words in
    common, whatever their order (``place`` numbers the item's distinct words
    from 1, ``counts`` says how often each stands in it), bound the longest
    common subsequence from above, so regions with too few are not aligned.
    """
    margin, regions = len(words), []
    for start, cosine in zip(starts, cosines, strict=True):
        lo, hi = max(0, start - margin), min(len(doc), start + size + margin)
        if regions and lo <= regions[-1][0] + margin:  # much the same region
            regions[-1] = (regions[-1][0], max(regions[-1][1], hi), max(regions[-1][2], cosine))
        else:
            regions.append((lo, hi, cosine))
    best, least = None, min(s.certain, s.likely)
    for lo, hi, cosine in regions:
        part = doc[lo:hi]
        common = np.minimum(np.bincount(place[part], minlength=len(counts) + 1)[1:], counts).sum()
        if common / len(words) < least:
            continue
        share = lcs_length(words, part) / len(words)
        ends = lcs_length(answer, part) / len(answer)
        if share >= s.certain or (len(words) > 2 and share >= s.likely and ends >= s.answer):
            if len(words) <= 2 and share < 1:
                continue
            if best is None or share > best[1]:
                best = (cosine, share, ends, lo)
    return best


def contaminated(docs: DataFrame, benchmark: DataFrame, settings: Settings | None = None) -> DataFrame:
    """doc_id, text_key, item_id, cosine, lcs, answer, first_word for every
    document and benchmark item that it contains."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), _item_key().alias("item_key"))
    found = _found(docs, benchmark, settings or Settings())
    return found.join(items, "item_key").select("doc_id", "text_key", "item_id", "cosine", "lcs", "answer", "first_word")


def _item_key():
    return F.sha2(F.coalesce("text", F.lit("")), 256)


def _found(docs: DataFrame, benchmark: DataFrame, s: Settings) -> DataFrame:
    """FOUND: one row per document and different item that it contains."""
    spark = docs.sparkSession
    bound_batches(spark)
    texts = benchmark.select(_item_key().alias("item_key"), F.coalesce("text", F.lit("")).alias("text")).distinct()
    texts = written(texts, "decontam-items")
    size = texts.agg(F.count("*").alias("items"), F.sum(F.length("text")).alias("chars")).first()
    blocks = max(1, math.ceil(size["items"] / s.block_items), math.ceil((size["chars"] or 0) / s.block_chars))
    out = None
    for b in range(blocks):
        some = texts.filter(F.pmod(F.xxhash64("text"), F.lit(blocks)) == b).collect()
        items = prepare(sorted((r["item_key"], r["text"]) for r in some))
        if not items.keys:
            continue
        encoded = encode(docs, items)
        df, passages = frequencies(encoded, items, s)
        informative = informative_words(items, df, passages, s)
        idf = np.where(informative, np.log((1 + passages) / (1 + df)) + 1, 0.0)
        basis = fit_basis(encoded, items, informative, idf, s)
        found = search(encoded, items, informative, idf, basis, rarest_places(items, df), s)
        out = found if out is None else out.unionByName(found)
    return spark.createDataFrame([], FOUND) if out is None else out


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, settings: Settings | None = None) -> DataFrame:
    """``docs`` without the documents that contain an item."""
    hit_id, hit_key = fresh(docs, "_hit_id", "_hit_key")
    found = _found(docs, benchmark, settings or Settings()).select(F.col("doc_id").alias(hit_id), F.col("text_key").alias(hit_key))
    found = written(found.distinct(), "decontam-found")
    return docs.join(
        found, F.col("doc_id").cast("long").eqNullSafe(F.col(hit_id)) & (text_key() == F.col(hit_key)), "left_anti"
    )
