"""MinHash near-duplicate groups: circulant signatures, banding, exact check.

Circulant MinHash needs two permutations, not one per coordinate.  The first,
``sigma``, is a mixing bijection of the shingle's 64-bit hash; the second,
``pi``, is a bijection of 32-bit numbers that is shifted circularly for each
coordinate: ``h_k = min over shingles of pi(sigma(x) + k)``.

1. One pass over the texts writes per document its number of distinct shingles,
   a 128-bit fingerprint of the shingle set and the band keys.
2. Documents with equal sets are one class; only classes go on.
3. Per band, a bucket's members are compared with its smallest member (a star,
   not all pairs), on full shingle sets.  Links found make components.
4. Members of one bucket that still lie in different components are compared
   with each other, so no candidate link between components is lost; pairs
   inside one component need no check since they cannot change it.  Pairs whose
   sizes or parity sketches (a lower bound of the number of shingles in which
   two sets differ) rule a link out never leave the join.

With 32 bands of 4 rows, two sets at the similarity threshold 0.8 share no
band with a probability of 5e-8.  Shingles are compared as 64-bit hashes in
the exact check (two different shingles of one pair of documents of 20,000
words agree by chance about once in 1e10 pairs).

Defined cases: null and empty texts (and texts of white space only) have the
empty set and are linked with nothing; texts with fewer words than a shingle
have their whole word sequence as one shingle; rows that repeat a doc_id with
equal sets share a component; a null doc_id takes part, its component_id is
the smallest non-null id of its group, or null; other columns are ignored by
``near_dup_report`` and kept by ``drop_near_dups``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bound_batches, fresh, join_spread, small_batches, text_bytes, written
from .components import connected_components

# Star rounds before the pairs that are left: each bucket is compared with so
# many centres first, which settles all but a few members of large groups.
STAR_ROUNDS = 2
# Bits of a set's parity sketch, and words of 64 bits of its folded form that is
# compared first.
SKETCH_BITS = 2048
FOLDED = 8
# Members of a bucket in one slice; a block compares two slices.
BUCKET_SLICE = 1024
SIGNED = "doc_id long, n_shingles long, node binary, text_key binary, bands array<long>, sketch array<long>"


def words_of(text: bytes) -> list[bytes]:
    """A-Z lower-cased, cut at the six ASCII white space characters."""
    return text.lower().split()


def word_hashes(words: list[bytes], known: dict[bytes, int], limit: int = 100_000) -> np.ndarray:
    """64-bit hashes of words; ``known`` remembers those of frequent words."""
    out = []
    add, get = out.append, known.get
    for w in words:
        h = get(w)
        if h is None:
            h = xxhash.xxh64_intdigest(w)
            if len(known) >= limit:
                known.clear()
            known[w] = h
        add(h)
    return np.array(out, dtype=np.uint64)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers (multiply, xor-shift)."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(32))


def shingle_hashes(text: bytes, k: int, known: dict[bytes, int]) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's ``k``-word shingles."""
    words = words_of(text)
    if not words:
        return np.empty(0, dtype=np.uint64)
    h = word_hashes(words, known)
    n = max(1, len(h) - k + 1)
    acc = np.zeros(n, dtype=np.uint64)
    for j in range(min(k, len(h))):
        acc = mix64(acc * np.uint64(0x9E3779B97F4A7C15) + h[j : j + n])
    return np.unique(mix64(acc + np.uint64(min(k, len(h)))))


def signature(shingles: np.ndarray, coordinates: int) -> np.ndarray:
    """Circulant MinHash: ``coordinates`` minima of the shifted permutation."""
    base = mix64(shingles).astype(np.uint32)
    shift = np.arange(coordinates, dtype=np.uint32)[:, None]
    best = np.full(coordinates, np.iinfo(np.uint32).max, dtype=np.uint32)
    for at in range(0, len(base), 1024):  # a block stays in the processor's cache
        z = base[None, at : at + 1024] + shift
        z ^= z >> np.uint32(16)
        z *= np.uint32(0x7FEB352D)
        z ^= z >> np.uint32(15)
        z *= np.uint32(0x846CA68B)
        z ^= z >> np.uint32(16)
        np.minimum(best, z.min(axis=1), out=best)
    return best


def parity_sketch(shingles: np.ndarray) -> np.ndarray:
    """Which of ``SKETCH_BITS`` cells hold an odd number of the set's hashes.

    Two sets differ in at least as many shingles as their sketches differ in
    bits, so a sketch can rule a link out but never wrongly.
    """
    cells = np.bincount((shingles >> np.uint64(20)).astype(np.int64) % SKETCH_BITS, minlength=SKETCH_BITS) & 1
    return np.packbits(cells.astype(np.uint8)).view(np.int64)


def _sign(k: int, bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, int] = {}
        salt = np.arange(1, bands + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        for batch in small_batches(batches):
            counts, nodes, texts, keys, sketches = [], [], [], [], []
            for text in text_bytes(batch.column(1)):
                texts.append(hashlib.md5(text).digest())
                s = shingle_hashes(text, k, known)
                counts.append(len(s))
                if not len(s):
                    nodes.append(None)
                    keys.append(None)
                    sketches.append(None)
                    continue
                nodes.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
                acc = salt.copy()
                for column in signature(s, bands * rows).astype(np.uint64).reshape(bands, rows).T:
                    acc = mix64(acc + column)
                keys.append(acc.view(np.int64))
                sketches.append(parity_sketch(s))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(nodes, pa.binary()),
                 pa.array(texts, pa.binary()), pa.array(keys, pa.list_(pa.int64())),
                 pa.array(sketches, pa.list_(pa.int64()))],
                ["doc_id", "n_shingles", "node", "text_key", "bands", "sketch"],
            )

    return run


def _linked(k: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, int] = {}
        last_text, last_set = None, None
        for batch in small_batches(batches, 128):
            keep = []
            for left, right in zip(text_bytes(batch.column(2)), text_bytes(batch.column(3)), strict=True):
                if left != last_text:  # neighbouring pairs often share their first text
                    last_text, last_set = left, shingle_hashes(left, k, known)
                other = shingle_hashes(right, k, known)
                both = len(np.intersect1d(last_set, other, assume_unique=True))
                keep.append(100 * both >= percent * (len(last_set) + len(other) - both))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(keep, pa.bool_())], ["a", "b", "linked"]
            )

    return run


def verified(pairs: DataFrame, docs: DataFrame, classes: DataFrame, k: int, percent: int) -> DataFrame:
    """``pairs`` (a, b) with ``linked``: the exact Jaccard check on full sets.

    Each class is read through one of its documents; only texts that stand in
    a pair go into the joins with the pairs.
    """
    wanted = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    keys = classes.join(wanted, "node", "left_semi").select(
        "node", F.col("pick.doc_id").alias("pick_id"), F.col("pick.text_key").alias("pick_key")
    )
    texts = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
        .join(keys, F.col("doc_id").eqNullSafe(F.col("pick_id")) & (F.unhex(F.md5("text")) == F.col("pick_key")))
        .select("node", "text").dropDuplicates(["node"])
    )
    texts = written(texts, "neardup-texts")
    both = (
        pairs.join(texts.select(F.col("node").alias("b"), F.col("text").alias("right")), "b")
        .join(texts.select(F.col("node").alias("a"), F.col("text").alias("left")), "a")
        .select("a", "b", "left", "right")
    )
    return written(both.mapInArrow(_linked(k, percent), "a binary, b binary, linked boolean"), "neardup-checked")


def near_dup_groups(docs: DataFrame, shingle: int = 2, percent: int = 80, bands: int = 32, rows: int = 4) -> DataFrame:
    """(doc_id, n_shingles, node, text_key, component) per document;
    ``component`` is the smallest node (shingle set fingerprint) of its group."""
    bound_batches(docs.sparkSession)
    signed = written(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_sign(shingle, bands, rows), SIGNED), "neardup-signed")
    classes = written(
        signed.filter(F.col("node").isNotNull()).groupBy("node").agg(
            F.min(F.struct("doc_id", "text_key")).alias("pick"),
            F.max("n_shingles").alias("n"),
            F.count("*").alias("docs"),
            F.first("bands").alias("bands"),  # equal sets have equal bands and sketches
            F.first("sketch").alias("sketch"),
        ),
        "neardup-classes",
    )
    members = classes.select("node", "n", F.posexplode("bands").alias("band", "key"))
    crowded = members.groupBy("band", "key").agg(F.count("*").alias("size")).filter("size > 1").select("band", "key")
    shared = written(members.join(crowded, ["band", "key"]), "neardup-buckets")
    links, checked, parts = None, None, None
    for turn in range(STAR_ROUNDS):
        # another centre of each bucket in each round; only members outside the centre's component
        named = _named(shared, parts)
        order = F.struct(F.xxhash64("node", F.lit(turn)).alias("o"), F.col("node"), F.col("n"), F.col("component"))
        centres = named.groupBy("band", "key").agg(F.min(order).alias("c"))
        stars = (
            named.join(centres, ["band", "key"])
            .select("node", "n", "component", F.col("c.node").alias("other"), F.col("c.n").alias("other_n"), F.col("c.component").alias("other_part"))
            .filter((F.col("component") != F.col("other_part")) & (F.least("n", "other_n") * 100 >= F.greatest("n", "other_n") * percent))
            .select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b")).distinct()
        )
        checked, links, parts = _round(stars, checked, links, parts, docs, classes, shingle, percent)
    named = _named(shared, parts)
    rest = _open_pairs(named, classes, percent)
    checked, links, parts = _round(rest, checked, links, parts, docs, classes, shingle, percent)
    named = written(_named(classes.select("node", "docs"), parts), "neardup-named")
    return join_spread(
        signed.select("doc_id", "n_shingles", "node", "text_key"), named, "node", "docs", ["doc_id", "text_key"]
    )


def _open_pairs(named: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs that share a bucket but not a component, and that neither sizes
    nor sketches rule out.

    A bucket's members are dealt to slices, and each pair of slices is a block
    of its own, so a block is bounded however large the bucket is.  Blocks are
    compared in numpy; pairs that are ruled out never become rows.
    """
    split = (
        named.groupBy("band", "key").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count("*").alias("size"))
        .filter("lo != hi").select("band", "key", F.ceil(F.col("size") / BUCKET_SLICE).alias("slices"))
    )
    opened = named.join(split, ["band", "key"]).join(classes.select("node", "sketch"), "node").withColumn(
        "h", F.xxhash64("node")
    ).withColumn("slice", F.pmod("h", F.col("slices")))
    blocks = (
        opened.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("slices") - 1)))
        .select(
            F.xxhash64("band", "key", F.least("slice", "other"), F.greatest("slice", "other")).alias("block"),
            (F.col("slice") <= F.col("other")).alias("left"), (F.col("slice") >= F.col("other")).alias("right"),
            "h", F.xxhash64("component").alias("part"), "n", "node", "sketch",
        )
    )
    # few bytes but much comparing: a set number of partitions, which AQE does not merge by size
    count = int(named.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    laid_out = blocks.repartition(count, "block").sortWithinPartitions("block")
    return laid_out.mapInArrow(_compare_blocks(percent), "a binary, b binary").distinct()


def _compare_blocks(percent: int):
    def possible(differ: np.ndarray, n: np.ndarray) -> np.ndarray:
        # Jaccard >= p means: shingles in one set only <= (sum of sizes) * (1 - p) / (1 + p)
        return differ.astype(np.int64) * (100 + percent) <= n * (100 - percent)

    def block_pairs(t: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        left = t.column("left").to_numpy(zero_copy_only=False)
        right = t.column("right").to_numpy(zero_copy_only=False)
        h, part, n = (t.column(c).to_numpy() for c in ("h", "part", "n"))
        sketch = t.column("sketch").combine_chunks().flatten().to_numpy().view(np.uint64).reshape(len(h), -1)
        coarse = np.bitwise_xor.reduce(sketch.reshape(len(h), FOLDED, -1), axis=2)
        rights = np.flatnonzero(right)
        for at in range(0, len(h), 64):
            some = at + np.flatnonzero(left[at : at + 64])
            i, j = np.meshgrid(some, rights, indexing="ij")
            ok = (h[i] < h[j]) if (left[rights].all() and right[some].all()) else (h[i] != h[j])
            ok &= part[i] != part[j]
            ok &= np.minimum(n[i], n[j]) * 100 >= np.maximum(n[i], n[j]) * percent
            i, j = i[ok], j[ok]
            for sk in (coarse, sketch):
                keep = possible(np.bitwise_count(sk[i] ^ sk[j]).sum(axis=1, dtype=np.int64), n[i] + n[j])
                i, j = i[keep], j[keep]
            if len(i):
                yield i, j

    def compared(t: pa.Table) -> Iterator[pa.RecordBatch]:
        block = t.column("block").to_numpy()
        edges = [0, *(np.flatnonzero(np.diff(block)) + 1), len(block)]
        for start, end in zip(edges, edges[1:], strict=False):
            part = t.slice(start, end - start)
            if end - start < 2:
                continue
            nodes = part.column("node").combine_chunks()
            for i, j in block_pairs(part):
                x, y = nodes.take(pa.array(i)).to_pylist(), nodes.take(pa.array(j)).to_pylist()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([min(p) for p in zip(x, y, strict=True)], pa.binary()),
                     pa.array([max(p) for p in zip(x, y, strict=True)], pa.binary())], ["a", "b"]
                )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:  # rows come sorted by block; the last block of a batch may go on
            t = pa.Table.from_batches([*held, batch])
            block = t.column("block").to_numpy()
            last = int(np.searchsorted(block, block[-1])) if len(block) else 0
            yield from compared(t.slice(0, last))
            held = t.slice(last).combine_chunks().to_batches()
        if held:
            yield from compared(pa.Table.from_batches(held))

    return run


def _named(nodes: DataFrame, parts: DataFrame | None) -> DataFrame:
    """``nodes`` with the component of each, itself while it has no link."""
    if parts is None:
        return nodes.withColumn("component", F.col("node"))
    return nodes.join(parts, "node", "left").withColumn("component", F.coalesce("component", "node"))


def _round(pairs, checked, links, parts, docs, classes, shingle, percent):
    """Checks the pairs not yet checked and brings the components up to date."""
    if checked is not None:
        pairs = pairs.join(checked.select("a", "b"), ["a", "b"], "left_anti")
    pairs = written(pairs, "neardup-pairs")
    if pairs.isEmpty():
        return checked, links, parts
    found = verified(pairs, docs, classes, shingle, percent)
    checked = found if checked is None else checked.unionByName(found)
    new = found.filter("linked").select("a", "b")
    links = new if links is None else links.unionByName(new)
    return checked, links, connected_components(links)


def near_dup_report(docs: DataFrame, **options) -> DataFrame:
    """One row per document: n_shingles, component_id (smallest doc_id of the
    group, itself included) and kept (it is that document)."""
    groups = written(near_dup_groups(docs, **options).select("doc_id", "n_shingles", "component"), "neardup-groups")
    least = groups.filter(F.col("component").isNotNull()).groupBy("component").agg(
        F.min("doc_id").alias("least"), F.count("*").alias("docs")
    )
    return join_spread(groups, written(least, "neardup-least"), "component", "docs", ["doc_id"]).select(
        "doc_id", "n_shingles",
        F.when(F.col("component").isNull(), F.col("doc_id")).otherwise(F.col("least")).alias("component_id"),
    ).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def drop_near_dups(docs: DataFrame, shingle: int = 5, **options) -> DataFrame:
    """``docs`` (all columns) with one document of each group: the smallest
    doc_id (then text key; null ids last).  Rows that repeat it go too."""
    lost_id, lost_key, again_id, again_key, own_key = fresh(docs, "_lost_id", "_lost_key", "_again_id", "_again_key", "_own_key")
    groups = written(
        near_dup_groups(docs, shingle=shingle, **options).filter(F.col("component").isNotNull())
        .select("component", "doc_id", "text_key"),
        "neardup-groups",
    )
    place = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id"), F.col("text_key"))
    chosen = groups.groupBy("component").agg(F.min(place).alias("pick"), F.count("*").alias("docs"))
    losers = (
        join_spread(groups, written(chosen, "neardup-chosen"), "component", "docs", ["doc_id", "text_key"])
        .filter(~(F.col("doc_id").eqNullSafe(F.col("pick.doc_id")) & (F.col("text_key") == F.col("pick.text_key"))))
        .select(F.col("doc_id").alias(lost_id), F.col("text_key").alias(lost_key)).distinct()
    )
    key = F.unhex(F.md5(F.coalesce(F.col("text"), F.lit(""))))
    rest = docs.join(
        losers, F.col("doc_id").cast("long").eqNullSafe(F.col(lost_id)) & (key == F.col(lost_key)), "left_anti"
    )
    repeated = groups.groupBy("doc_id", "text_key").agg(F.count("*").alias("n")).filter("n > 1")
    if repeated.isEmpty():
        return rest
    again = written(repeated.select(F.col("doc_id").alias(again_id), F.col("text_key").alias(again_key)), "neardup-repeated")
    same = F.col("doc_id").cast("long").eqNullSafe(F.col(again_id)) & (key == F.col(again_key))
    return rest.join(again, same, "left_anti").unionByName(
        rest.join(again, same, "left_semi").withColumn(own_key, key).dropDuplicates(["doc_id", own_key]).drop(own_key)
    )
