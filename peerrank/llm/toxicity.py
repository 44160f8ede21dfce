"""Toxicity by nearest labelled examples: exact TF-IDF cosine over a block-max
inverted index, distance-weighted votes, calibrated score, evidence.

Terms are words and the first 4 and 5 letters of longer words (stems of
compounds).  The vector space holds the terms that the labelled training rows
associate with a label (G-test of ``least_g``, odds ratio of ``least_odds``): over
all terms the topic of a text outweighs its tone, and fewer toxic texts are found
(README has figures).  A text without any of them has no neighbours and gets the
score of such texts.  Weights are (1 + log tf) times idf; document frequencies come
from all documents.

The ``k`` nearest examples are exact.  Examples are indexed by term in blocks;
a block's bound is the sum over the query's terms of query weight times the
term's largest weight in the block.  The blocks with the highest bounds are scored
first; then those that can still beat the k-th best, by block if they are few and
by term if they are many.  Examples with the very text that is
scored are left out, so no text is scored by its own label.

The vote is the similarity-weighted share of toxic neighbours, shrunk to the
base rate by ``shrink``.  Isotonic regression of the examples' labels on their
own votes (each one left out) makes it a probability.

The model is fit on at most ``max_examples`` labelled training rows (smallest
hashes of the ids): the one documented bound.  ``labels``, ``lang``, ``source``
and ``doc_id`` are no inputs of a score.

Defined cases: null and empty texts are texts without terms; rows that repeat
a doc_id are scored each; a label table with repeated ids counts a document as
toxic if any row does; null labels count as unlabelled; without training rows
every score is 0; other columns are ignored (report) or kept (filter).
"""

from __future__ import annotations

import hashlib
import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bound_batches, small_batches, written

SCORED = "doc_id long, held_out boolean, score double, predicted int, evidence array<long>, similarity double"
_EDGES = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum())


def _terms_of_word(word: str) -> tuple[str, ...]:
    core = word.strip(_EDGES)
    if not core:
        return ()
    return ("w:" + core, *(f"p{n}:{core[:n]}" for n in (4, 5) if len(core) > n))


class TermCounter:
    """Counts the terms of texts, those of ``vocabulary`` only if given;
    remembers what words map to (a bounded dictionary)."""

    def __init__(self, vocabulary: dict[str, int] | None = None, remember: int = 100_000) -> None:
        self.vocabulary, self.remember = vocabulary, remember
        self.known: dict[str, tuple] = {}

    def __call__(self, text: str) -> Counter:
        words = Counter(text.lower().split())
        if len(self.known) > self.remember:
            self.known.clear()
        total: Counter = Counter()
        for w, n in words.items():
            terms = self.known.get(w)
            if terms is None:
                terms = _terms_of_word(w)
                if self.vocabulary is not None:
                    terms = tuple(self.vocabulary[t] for t in terms if t in self.vocabulary)
                self.known[w] = terms
            for t in terms:
                total[t] += n
        return total


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 5 == 0


# --- model -------------------------------------------------------------------


@dataclass
class Model:
    vocabulary: dict[str, int]
    idf: np.ndarray
    index: BlockMaxIndex
    base: float
    steps: tuple[np.ndarray, np.ndarray]
    none_score: float
    k: int
    shrink: float

    def neighbours(self, terms: Counter, text_key: bytes | None):
        q = weights(terms, self.idf)
        return self.index.nearest(q, self.k, text_key) if q else []

    def vote(self, found) -> float:
        total = sum(s for s, _ in found)
        toxic = sum(s for s, e in found if self.index.toxic[e])
        return (toxic + self.shrink * self.base) / (total + self.shrink)

    def score(self, found) -> float:
        if not found:
            return self.none_score
        x, y = self.steps
        return float(np.interp(self.vote(found), x, y)) if len(x) else self.base


def weights(terms: Counter, idf: np.ndarray) -> dict[int, float]:
    """Unit-length TF-IDF vector."""
    raw = {t: (1 + math.log(n)) * idf[t] for t, n in terms.items()}
    norm = math.sqrt(sum(v * v for _, v in sorted(raw.items())))
    return {t: v / norm for t, v in sorted(raw.items())} if norm else {}


class BlockMaxIndex:
    """Examples by term and by block of ``block`` examples, with each term's
    largest weight in each block."""

    def __init__(self, vectors: list[dict[int, float]], toxic: list[int], ids: list[int], keys: list[bytes], block: int = 64) -> None:
        self.toxic, self.ids, self.block = toxic, ids, block
        self.blocks = -(-len(vectors) // block)
        self.same: dict[bytes, list[int]] = {}
        for e, key in enumerate(keys):
            self.same.setdefault(key, []).append(e)
        example = np.repeat(np.arange(len(vectors), dtype=np.int32), [len(v) for v in vectors])
        term = np.array([t for v in vectors for t in v], dtype=np.int32)
        value = np.array([x for v in vectors for x in v.values()], dtype=np.float64)
        self.terms = int(term.max()) + 1 if len(term) else 0
        self.block_at = np.searchsorted(example, np.arange(self.blocks + 1) * block)
        self.example, self.term, self.value = example, term, value
        order = np.argsort(term, kind="stable")
        self.term_at = np.searchsorted(term[order], np.arange(self.terms + 1))
        self.term_example, self.term_value = example[order], value[order]
        self.most = np.zeros((self.terms, self.blocks), dtype=np.float32)
        np.maximum.at(self.most, (term, example // block), value.astype(np.float32))
        self.most *= np.float32(1 + 1e-6)  # not below the weights after rounding

    def nearest(self, query: dict[int, float], k: int, leave_out: bytes | None = None) -> list[tuple[float, int]]:
        """[(cosine, example)] of the ``k`` most similar with cosine above 0,
        most similar first, ties to the earlier example."""
        terms = np.array([t for t in query if t < self.terms], dtype=np.int64)
        if not len(terms):
            return []
        weight = np.array([query[t] for t in terms.tolist()])
        bound = weight @ self.most[terms]
        order = np.argsort(-bound, kind="stable")
        order = order[: np.count_nonzero(bound > 0)]
        left = self.same.get(leave_out, ()) if leave_out is not None else ()
        dense = np.zeros(self.terms)
        dense[terms] = weight
        best = self._best([self._by_block(b, dense) for b in order[:8]], left, k)
        rest = order[8:]
        if len(best) == k:
            rest = rest[bound[rest] * (1 + 1e-9) >= best[-1][0]]
        if len(rest) > 16:
            scores = self._by_term(terms, weight)
            found = np.flatnonzero(scores)
            more = [(found, scores[found])]
        else:
            more = [self._by_block(b, dense) for b in order[:8]] + [self._by_block(b, dense) for b in rest]
        return self._best(more, left, k) if len(rest) else best

    def _by_block(self, b: int, dense: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        lo, hi = self.block_at[b], self.block_at[b + 1]
        scores = np.bincount(self.example[lo:hi] - b * self.block, weights=dense[self.term[lo:hi]] * self.value[lo:hi])
        found = np.flatnonzero(scores)
        return found + b * self.block, scores[found]

    def _by_term(self, terms: np.ndarray, weight: np.ndarray) -> np.ndarray:
        parts = [slice(self.term_at[t], self.term_at[t + 1]) for t in terms.tolist()]
        return np.bincount(
            np.concatenate([self.term_example[p] for p in parts]),
            weights=np.concatenate([self.term_value[p] * w for p, w in zip(parts, weight.tolist(), strict=True)]),
        )

    def _best(self, found: list[tuple[np.ndarray, np.ndarray]], left: list[int], k: int) -> list[tuple[float, int]]:
        if not found:
            return []
        example, score = (np.concatenate(x) for x in zip(*found, strict=True))
        if len(left):
            keep = ~np.isin(example, left)
            example, score = example[keep], score[keep]
        if len(score) > 4 * k:
            high = score >= np.partition(score, len(score) - k)[len(score) - k]
            example, score = example[high], score[high]
        top = np.lexsort((example, -score))[:k]
        return list(zip(score[top].tolist(), example[top].tolist(), strict=True))


def isotonic(votes: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Points (vote, probability) of the non-decreasing fit (pool adjacent
    violators); each pool is shrunk by one pseudo-count towards its mean's side."""
    order = np.argsort(votes, kind="stable")
    pools: list[list[float]] = []  # sum of labels, count, sum of votes
    for v, y in zip(votes[order], labels[order], strict=True):
        pools.append([float(y), 1.0, float(v)])
        while len(pools) > 1 and pools[-2][0] / pools[-2][1] >= pools[-1][0] / pools[-1][1]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last, strict=True)]
    x = np.array([p[2] / p[1] for p in pools])
    y = np.array([(p[0] + 0.5) / (p[1] + 1.0) for p in pools])
    return x, np.maximum.accumulate(y)


def fit(docs: DataFrame, labels: DataFrame, max_examples: int = 16_384, least_g: float = 25.0, least_odds: float = 4.0,
        k: int = 15, shrink: float = 0.5) -> Model | None:
    """The model, or None without training rows of both labels."""
    bound_batches(docs.sparkSession)
    train = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
        .filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_examples)
    )
    train = written(train, "toxicity-train")
    examples = written(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
        .join(F.broadcast(train), "doc_id")  # max_examples rows of two numbers
        .groupBy(F.md5("text").alias("text_key"))  # one example per text
        .agg(F.min("doc_id").alias("doc_id"), F.max("toxic").alias("toxic"), F.first("text").alias("text")),
        "toxicity-examples",
    )
    totals = examples.agg(F.count("*").alias("n"), F.sum("toxic").alias("t")).first()
    n, t = totals["n"], totals["t"] or 0
    if not 0 < t < n:
        return None
    chosen = _associated_terms(examples, n, t, least_g, least_odds)
    vocabulary = {term: i for i, term in enumerate(sorted(chosen))}
    idf = _inverse_frequencies(docs, vocabulary)
    rows = examples.select("text_key", "doc_id", "toxic", "text").mapInArrow(_example_vectors(vocabulary), "text_key string, doc_id long, toxic int, terms array<int>, counts array<int>").collect()
    rows = sorted(rows, key=lambda r: r["text_key"])  # at most max_examples, terms of the vocabulary only
    some = [r for r in rows if r["terms"]]
    vectors = [weights(Counter(dict(zip(r["terms"], r["counts"], strict=True))), idf) for r in some]
    keys = [bytes.fromhex(r["text_key"]) for r in some]
    index = BlockMaxIndex(vectors, [r["toxic"] for r in some], [r["doc_id"] for r in some], keys)
    none = [r["toxic"] for r in rows if not r["terms"]]
    model = Model(vocabulary, idf, index, t / n, (np.array([]), np.array([])), (sum(none) + 0.5) / (len(none) + 1), k, shrink)
    left_out = [index.nearest(v, k, key) for v, key in zip(vectors, keys, strict=True)]
    pairs = [(model.vote(f), r["toxic"]) for f, r in zip(left_out, some, strict=True) if f]
    if pairs:
        model.steps = isotonic(np.array([p[0] for p in pairs]), np.array([p[1] for p in pairs]))
    return model


def _associated_terms(examples: DataFrame, n: int, t: int, least_g: float, least_odds: float) -> list[str]:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms_of, clean, toxic = TermCounter(), Counter(), Counter()

        def flush():
            names = list(clean.keys() | toxic.keys())
            return pa.RecordBatch.from_pydict({
                "term": pa.array(names, pa.string()), "clean": pa.array([clean[x] for x in names], pa.int64()),
                "toxic": pa.array([toxic[x] for x in names], pa.int64()),
            })

        for batch in small_batches(batches, 64):
            for y, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                (toxic if y else clean).update(terms_of(text).keys())
            if len(clean) + len(toxic) > 200_000:
                yield flush()
                clean.clear()
                toxic.clear()
        yield flush()

    sums = examples.select("toxic", "text").mapInArrow(count, "term string, clean long, toxic long").groupBy("term").agg(
        F.sum("toxic").cast("double").alias("a"), F.sum("clean").cast("double").alias("b")
    )
    c, d = F.lit(float(t)) - F.col("a"), F.lit(float(n - t)) - F.col("b")
    cells = ((F.col("a"), F.lit(t / n)), (F.col("b"), F.lit(1 - t / n)))
    with_term = F.col("a") + F.col("b")

    def part(seen: Column, expected: Column) -> Column:
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)

    g = 2 * (
        sum((part(x, with_term * p) for x, p in cells), F.lit(0.0))
        + part(c, (n - with_term) * F.lit(t / n)) + part(d, (n - with_term) * F.lit(1 - t / n))
    )
    odds = F.log((F.col("a") + 0.5) * (d + 0.5) / ((F.col("b") + 0.5) * (c + 0.5)))
    tied = sums.filter((g >= least_g) & (F.abs(odds) >= math.log(least_odds))).select("term").collect()
    return [r["term"] for r in tied]  # terms of at most max_examples texts


def _inverse_frequencies(docs: DataFrame, vocabulary: dict[str, int]) -> np.ndarray:
    """idf of each term over all documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms_of, total, n = TermCounter(vocabulary), Counter(), 0
        for batch in small_batches(batches):
            for text in batch.column(0).to_pylist():
                n += 1
                total.update(terms_of(text or "").keys())
        yield pa.RecordBatch.from_pydict(
            {"term": pa.array([-1, *total], pa.int32()), "docs": pa.array([n, *total.values()], pa.int64())}
        )

    sums = docs.select("text").mapInArrow(count, "term int, docs long").groupBy("term").agg(F.sum("docs").alias("docs")).collect()
    counts = {r["term"]: r["docs"] for r in sums}  # one row per vocabulary term
    n = counts.get(-1, 0)
    return np.array([math.log((1 + n) / (1 + counts.get(i, 0))) + 1 for i in range(len(vocabulary))])


def _example_vectors(vocabulary: dict[str, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms_of = TermCounter(vocabulary)
        for batch in small_batches(batches, 64):
            counted = [terms_of(x) for x in batch.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2), pa.array([list(c) for c in counted], pa.list_(pa.int32())),
                 pa.array([list(c.values()) for c in counted], pa.list_(pa.int32()))],
                ["text_key", "doc_id", "toxic", "terms", "counts"],
            )

    return run


# --- scoring -----------------------------------------------------------------


def score_documents(docs: DataFrame, model: Model | None, threshold: float = 0.5) -> DataFrame:
    """One row per document; ``evidence`` lists the examples that voted,
    nearest first, ``similarity`` is the nearest one's cosine."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)  # bounded by max_examples

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        terms_of = TermCounter(m.vocabulary) if m else None
        for batch in small_batches(batches):
            out: dict[str, list] = {"score": [], "evidence": [], "similarity": []}
            for text in batch.column(2).to_pylist():
                found, score = [], 0.0
                if m:
                    terms = terms_of(text)
                    if terms:
                        found = m.neighbours(terms, hashlib.md5(text.encode()).digest())
                    score = m.score(found)
                out["score"].append(min(1.0, max(0.0, score)))
                out["evidence"].append([m.index.ids[e] for _, e in found] if m else [])
                out["similarity"].append(found[0][0] if found else 0.0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(out["score"], pa.float64()),
                 pa.array([int(s >= threshold) for s in out["score"]], pa.int32()),
                 pa.array(out["evidence"], pa.list_(pa.int64())), pa.array(out["similarity"], pa.float64())],
                [c.split()[0] for c in SCORED.split(", ")],
            )

    ids = F.col("doc_id").cast("long")
    work = docs.select(ids.alias("doc_id"), held_out(ids).alias("held_out"), F.coalesce("text", F.lit("")).alias("text"))
    return work.mapInArrow(run, SCORED)


def toxicity_report(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    return score_documents(docs, fit(docs, labels, **options))


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, **options) -> DataFrame:
    """``docs`` without the documents that the model predicts to be toxic."""
    model = fit(docs, labels, **options)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("boolean")
    def clean(texts):
        m = shared.value
        if m is None:
            return texts.isna() | True
        terms_of = TermCounter(m.vocabulary)

        def one(text: str) -> bool:
            terms = terms_of(text)
            found = m.neighbours(terms, hashlib.md5(text.encode()).digest()) if terms else []
            return m.score(found) < threshold

        return texts.map(one)

    return docs.filter(clean(F.coalesce("text", F.lit(""))))
