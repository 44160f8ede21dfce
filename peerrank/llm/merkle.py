"""Merkle manifest of a dataset, on concatenated-level strings.

Every row is a leaf: SHA-256 over its fields, each ``-`` if null or else its
UTF-8 byte count, ``:`` and value.  The leaves of a group ascend by key; each
run of ``fan`` consecutive nodes (the last may be shorter, even one node)
becomes the digest of their digests, until one is left, the group's subroot.
Subroots, in order of the group (null first, then bytewise), give the root in
the same way.

Nodes are numbered and cut into aligned blocks of ``fan ** depth`` places.  One
row holds a block, each of its levels as one string of hexadecimal digests:

* substrings of ``64 * fan`` characters hash to the parents, the next level;
* a node's siblings are the substrings at both sides of it within its run, so
  its proof in the block is one pair (left, right) a level;
* the blocks' last digests are the nodes of the next tier, and so on until each
  group has one block.  On the way back each tier appends the proof of the
  block to the proofs of its nodes.

A block is a bounded row whatever the size of a group, so a group with most of
all rows is as spread as any other; places come from a range partitioning over
(group, key, leaf, row), which repeated keys and rows do not gather.  Tiers are
written to the shared folder; the driver learns one number a tier.

Defined cases: a null group is a group, ordered first; null keys come first;
rows with one key ascend by leaf (rows alike have like leaves); a null text is
``-``, an empty one ``0:``; a group of one row has that leaf as subroot; one
group's subroot is the root; an empty table gives no rows; other columns are
not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.joins import join_small
from ..operators.positions import positions
from .common import written

HEX = 64  # characters of a digest
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(values: list[Column]) -> Column:
    return digest(*[field(v) for v in values])


def _parents(level: Column, fan: int) -> Column:
    width = HEX * fan
    runs = F.ceil(F.length(level) / F.lit(width)).cast("int")
    return F.array_join(
        F.transform(F.sequence(F.lit(0), runs - 1), lambda i: F.sha2(F.substr(level, i * width + 1, F.lit(width)), 256)), ""
    )


def _levels(bottom: Column, whole: Column, fan: int, depth: int) -> Column:
    """Levels of a block, bottom first.  A block that is ``whole`` or not its
    group's first goes up ``depth`` levels; the first one, unless whole, is the
    group's only one and ends at one node."""

    def up(levels: Column, _: Column) -> Column:
        last = F.element_at(levels, -1)
        return F.when(whole | (F.length(last) > HEX), F.concat(levels, F.array(_parents(last, fan)))).otherwise(levels)

    return F.aggregate(F.sequence(F.lit(1), F.lit(depth)), F.array(bottom), up)


def _flanks(levels: Column, place: Column, fan: int) -> Column:
    """(left, right) siblings of the node at ``place`` of a block, a level each."""

    def at(level: Column, up: Column) -> Column:
        own = F.floor(place / F.pow(F.lit(float(fan)), up)).cast("int")
        first = own - own % fan
        return F.struct(
            F.substr(level, first * HEX + 1, (own - first) * HEX).alias("left"),
            F.substr(level, (own + 1) * HEX + 1, (first + fan - 1 - own) * HEX).alias("right"),
        )

    return F.transform(F.slice(levels, F.lit(1), F.size(levels) - 1), at)


def _tiers(nodes: DataFrame, fan: int, depth: int) -> tuple[list[DataFrame], DataFrame]:
    """Blocks of every tier over ``nodes`` (g, pos, digest, item), and the
    groups' last digests (g, digest)."""
    block_size, tiers = fan**depth, []
    while True:
        cut = nodes.withColumn("block", F.floor(F.col("pos") / F.lit(block_size)).cast("long"))
        rows = cut.groupBy("g", "block").agg(F.sort_array(F.collect_list(F.struct("pos", "digest", "item"))).alias("nodes"))
        bottom = F.array_join(F.transform("nodes", lambda n: n["digest"]), "")
        whole = (F.col("block") > 0) | (F.size("nodes") == block_size)
        blocks = written(rows.select("g", "block", "nodes", _levels(bottom, whole, fan, depth).alias("levels")), "merkle-tier")
        tiers.append(blocks)
        tops = blocks.select("g", F.col("block").alias("pos"), F.element_at("levels", -1).alias("digest"))
        if not (tops.agg(F.max("pos")).first()[0] or 0):
            return tiers, tops.select("g", "digest")
        nodes = tops.withColumn("item", F.lit(None).cast("int"))


def _proofs(tiers: list[DataFrame], above: DataFrame, fan: int) -> DataFrame:
    """(g, pos, item, digest, proof) of the lowest tier's nodes; ``above`` has
    the proof of each group's last digest (g, proof)."""
    found = above.select("g", F.lit(0).cast("long").alias("block"), F.col("proof").alias("above"))
    for blocks in reversed(tiers):
        joined = blocks.join(found, ["g", "block"])
        nodes = F.transform("nodes", lambda n, i: F.struct(
            n["pos"].alias("pos"), n["item"].alias("item"), n["digest"].alias("digest"),
            F.concat(_flanks(F.col("levels"), i, fan), F.col("above")).alias("proof"),
        ))
        rows = joined.select("g", F.inline(nodes))
        found = rows.select("g", F.col("pos").alias("block"), F.col("proof").alias("above"))
    return rows


def folded(node: Column, proof: Column) -> Column:
    """The root that ``node`` and its proof lead to."""
    return F.aggregate(proof, node, lambda acc, s: digest(s["left"], acc, s["right"]))


def proof_digest(proof: Column) -> Column:
    """Digest of all siblings, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(proof, lambda s: F.concat(s["left"], s["right"])), ""), 256)


def manifest(rows: DataFrame, group: Column, key: Column, item: Column, digest_: Column, fan: int = 2, depth: int = 8) -> DataFrame:
    """(item, leaf, subroot, root, proof) of every row.  ``digest_`` is the
    row's leaf, ``item`` a narrow struct of what to carry along; ``proof`` is an
    array of (left, right) from the leaf to the root."""
    if fan < 2 or depth < 1:
        raise ValueError("fan must be at least 2 and depth at least 1")
    g = F.coalesce(F.concat(F.lit("="), group.cast("string")), F.lit("-"))  # "-" sorts before "="
    leaves = written(
        rows.select(g.alias("g"), key.alias("key"), item.alias("item"), digest_.alias("digest"), F.monotonically_increasing_id().alias("row")),
        "merkle-leaves",
    )
    order = [F.col("key").asc_nulls_first(), F.col("digest").asc(), F.col("row").asc()]
    nodes = positions(leaves, order, group="g", name="pos").select("g", (F.col("pos") - 1).alias("pos"), "digest", "item")
    tiers, subroots = _tiers(nodes, fan, depth)
    ranked = positions(subroots, [F.col("g").asc()], name="pos")
    upper, root = _tiers(ranked.select(F.lit("").alias("g"), (F.col("pos") - 1).alias("pos"), "digest", F.col("g").alias("item")), fan, depth)
    none = F.array().cast("array<struct<left:string,right:string>>")
    above = _proofs(upper, root.select("g", none.alias("proof")), fan).select(F.col("item").alias("g"), F.col("digest").alias("subroot"), "proof")
    above = written(above.withColumn("root", folded(F.col("subroot"), F.col("proof"))), "merkle-subroots")
    found = _proofs(tiers, above, fan).select("g", "item", F.col("digest").alias("leaf"), "proof")
    return join_small(found, above.select("g", "subroot", "root"), ["g"]).select("item", "leaf", "subroot", "root", "proof")


def manifest_report(docs: DataFrame) -> DataFrame:
    """Proofs of all documents, and which of them find a changed ``n_chars``.

    Where 7 divides the CRC-32 of the decimal doc_id, the tampered row has one
    character more; its leaf is folded with the original siblings.
    """
    values = {c: F.col(c) for c in FIELDS}
    longer = values | {"n_chars": (F.col("n_chars").cast("decimal(20,0)") + 1)}
    hit = F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % 7 == 0
    item = F.struct("doc_id", F.when(hit, leaf(list(longer.values()))).alias("tampered"))
    rows = manifest(docs, F.col("lang"), F.col("doc_id"), item, leaf(list(values.values())))
    back = folded(F.coalesce("item.tampered", "leaf"), F.col("proof"))
    found = rows.select(
        "item.doc_id", "leaf", "subroot", "root", proof_digest(F.col("proof")).alias("proof_sha256"), back.alias("folded_root"),
    )
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))
