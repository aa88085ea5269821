"""A Merkle manifest of a dataset: nested-struct rollup of rank digits, proofs by explode.

Every row is a leaf, the SHA-256 of its fields. Leaves of a group ascend by key; runs of two nodes become
their hash, level by level, until one node remains, the group's subroot; subroots in the order of their
groups become the root in the same way.

1. Leaves are range partitioned by (group, key, leaf) and numbered; a table of one row per partition and
   group turns these numbers into ranks within the group.
2. A leaf's rank is read as binary digits. The lowest ``DIGITS`` of them span a block of 1,024 leaves,
   which one task holds: grouping by all digits but the lowest, then all but the two lowest, and so on,
   nests the children of each node as structs in their parent. All these groupings share one exchange.
   The block's top node is a leaf of the next round, whose rank is the block's number; a table of
   10**12 rows takes four rounds.
3. On the way back the rollup is repeated with the nested children kept. What a block needs from above
   (its proof from the block upwards, subroot and root) is one more row of its last grouping. Each
   nesting is then exploded, its children's siblings going to their proofs: no join.

Defined cases: a null field is ``-``; a null group is a group of its own and comes first; a null key comes
first in its group; equal keys go by the leaf's hash (equal leaves are alike in all that is returned, and
share out their places). Repeated rows are a leaf each, and a group of copies is spread by a number of
its own. An empty table gives an empty result. Columns that are not named are not read.

Scale: texts are hashed in the scan, once, and not shuffled. A task holds one block: 1,024 leaves with
their proofs, a few MB at any size of the table. Nothing is collected but the largest group's size, and
nothing is broadcast by a hint.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from creditmart.sources.stage import stage

DIGITS = 10
#: A node's siblings, lowest level first: null where a run has one node only.
PROOF = "array<struct<hash:string,left:boolean>>"
ABOVE = f"struct<proof:{PROOF},subroot:string,root:string>"


def digest(*parts: Column) -> Column:
    """Lower-case hex SHA-256 of the parts, concatenated."""
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def ranked(rows: DataFrame, group: str, order: Sequence[str]) -> DataFrame:
    """The rows with ``rank``, from 0 in the order given within the group, and ``total``, the group's rows.

    The order's last column should tell equal rows apart, so that copies fill several partitions.
    """
    placed = stage(
        rows.repartitionByRange(group, *order).sortWithinPartitions(group, *order).withColumn("at", F.monotonically_increasing_id()), "merkle-placed"
    )
    part, place = F.shiftright("at", 33), F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    spans = placed.groupBy(part.alias("part"), F.col(group).alias("of")).agg(F.min(place).alias("first"), F.count("*").alias("n"))
    all_ = Window.partitionBy("of")
    before = F.sum("n").over(all_.orderBy("part")) - F.col("n")
    starts = stage(spans.select("part", "of", (before - F.col("first")).alias("shift"), F.sum("n").over(all_).alias("total")), "merkle-starts")
    joined = placed.join(starts, (part == F.col("part")) & F.col(group).eqNullSafe(F.col("of")))
    return joined.select(*rows.columns, (place + F.col("shift")).alias("rank"), "total")


def _levels(total: Column) -> Column:
    """Levels above the leaves: the binary digits of the last rank."""
    return F.when(total > 1, F.length(F.bin(total - 1))).otherwise(0)


def _rollup(nodes: DataFrame, keep: bool, above: DataFrame | None = None) -> DataFrame:
    """Blocks of ``grp, rank, levels, hash[, payload]``: ``grp, block, levels, hash``, and ``kids, above`` if kept.

    ``levels`` is how many levels are left above the nodes; where they end, single nodes pass unhashed.
    """
    digits = [f"d{k}" for k in range(DIGITS)]
    base = [F.col("hash"), F.col("rank"), F.col("payload")] if keep else [F.col("hash")]
    rows = nodes.select(
        "grp",
        F.shiftright("rank", DIGITS).alias("block"),
        "levels",
        *(F.shiftright("rank", k).bitwiseAND(F.lit(1)).cast("int").alias(d) for k, d in enumerate(digits)),
        F.struct(F.shiftright("rank", 0).bitwiseAND(F.lit(1)).cast("int").alias("d"), *base).alias("node"),
        F.lit(None).cast(ABOVE).alias("above"),
    )
    if above is not None:
        rows = rows.unionByName(above.select("grp", F.col("rank").alias("block"), "above"), allowMissingColumns=True)
    rows = rows.repartition("grp", "block")
    for k in range(DIGITS):
        left = digits[k + 1 :]
        last = not left
        keys = ["grp", "block"] if last else ["grp", "block", "levels", *left]
        levels = [F.max("levels").alias("levels")] if last else []
        rows = rows.groupBy(*keys).agg(*levels, F.sort_array(F.collect_list("node")).alias("kids"), F.max("above").alias("above"))
        hashes = F.array_join("kids.hash", "")
        rows = rows.withColumn("hash", F.when(F.col("levels") > k, F.sha2(hashes, 256)).otherwise(hashes))
        if not last:
            inner = [F.col("kids")] if keep else []
            node = F.struct(F.col(left[0]).alias("d"), F.col("hash"), *inner)
            rows = rows.select("grp", "block", "levels", *left, F.when(F.size("kids") > 0, node).alias("node"), "above")
    return rows.select("grp", "block", "levels", "hash", *["kids", "above"] * keep)


def _proved(nodes: DataFrame, above: DataFrame) -> DataFrame:
    """The nodes with what is above them: ``grp, rank, hash, payload, proof, subroot, root``."""
    rows = _rollup(nodes, True, above).select("grp", "levels", "above.subroot", "above.root", "above.proof", "kids")
    for k in reversed(range(DIGITS)):
        rows = rows.select("grp", "levels", "subroot", "root", "proof", F.col("kids.hash").alias("run"), F.posexplode("kids").alias("place", "kid"))
        other = F.struct(F.get("run", 1 - F.col("place")).alias("hash"), (F.col("place") == 1).alias("left"))
        own = F.when(F.col("levels") > k, F.array(other)).otherwise(F.array().cast(PROOF))
        rows = rows.select("grp", "levels", "subroot", "root", F.concat(own, "proof").alias("proof"), *(["kid.kids"] if k else ["kid.rank", "kid.hash", "kid.payload"]))
    return rows.drop("levels")


def _rounds(nodes: DataFrame, largest: int) -> list[DataFrame]:
    """The nodes of each round up to the one that has a single node for each group. ``largest``: nodes of the largest group."""
    rounds = [nodes]
    while largest > 1 or len(rounds) == 1:
        blocks = _rollup(rounds[-1], False)
        up = blocks.select("grp", F.col("block").alias("rank"), F.greatest(F.col("levels") - DIGITS, F.lit(0)).alias("levels"), "hash")
        rounds.append(stage(up.withColumn("payload", F.lit(None).cast("string")), "merkle-round"))
        largest = -(-largest >> DIGITS) if largest > 1 << DIGITS else 1
    return rounds


def _down(rounds: list[DataFrame], tops: DataFrame) -> DataFrame:
    """Proofs of the lowest round's nodes. ``tops``: ``grp, rank, above`` of each group's single node."""
    for nodes in reversed(rounds[1:-1]):
        found = _proved(nodes, tops)
        tops = stage(found.select("grp", "rank", F.struct("proof", "subroot", "root").cast(ABOVE).alias("above")), "merkle-above")
    return _proved(rounds[0], tops)


def manifest(leaves: DataFrame, key: str, group: str, leaf: str, carry: Sequence[str] = ()) -> DataFrame:
    """One row per row: the columns carried, ``leaf, rank, proof, subroot, root``.

    ``leaf`` is the column with the leaves' hashes. ``proof`` lists the siblings (``hash, left``) from the leaf
    to the root, with a null hash where a run has no other node.
    """
    names = [f"c{i}" for i in range(len(carry))]
    columns = [F.col(f"`{group}`").alias("grp"), F.col(f"`{key}`").alias("key"), F.col(f"`{leaf}`").alias("hash")]
    carried = F.struct(F.lit(0).alias("_"), *(F.col(f"`{c}`").alias(n) for c, n in zip(carry, names, strict=True)))
    source = stage(leaves.select(*columns, carried.alias("payload"), F.xxhash64(F.monotonically_increasing_id()).alias("tie")), "merkle-leaves")
    placed = ranked(source, "grp", ["key", "hash", "tie"])
    nodes = stage(placed.select("grp", "rank", _levels(F.col("total")).alias("levels"), "hash", "payload", "total"), "merkle-nodes")
    rounds = _rounds(nodes, nodes.agg(F.max("total")).first()[0] or 0)

    subroots = rounds[-1].select(F.lit(0).alias("all"), F.col("grp").alias("payload"), "hash")
    upper = ranked(subroots, "all", ["payload"])
    top = stage(upper.select(F.col("all").alias("grp"), "rank", _levels(F.col("total")).alias("levels"), "hash", "payload", "total"), "merkle-subroots")
    top_rounds = _rounds(top, top.agg(F.max("total")).first()[0] or 0)
    none = F.array().cast(PROOF)
    root = top_rounds[-1].select("grp", "rank", F.struct(none.alias("proof"), F.lit(None).cast("string").alias("subroot"), F.col("hash").alias("root")).cast(ABOVE).alias("above"))
    found = _down(top_rounds, root)
    tops = stage(
        found.select(F.col("payload").alias("grp"), F.lit(0).cast("long").alias("rank"), F.struct("proof", F.col("hash").alias("subroot"), "root").cast(ABOVE).alias("above")),
        "merkle-above",
    )
    proved = _down(rounds, tops)
    return proved.select(*(F.col("payload").getField(n).alias(c) for n, c in zip(names, carry, strict=True)), F.col("hash").alias("leaf"), "rank", "proof", "subroot", "root")


def folded(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and its siblings give."""

    def up(node: Column, sibling: Column) -> Column:
        other, left = F.coalesce(sibling["hash"], F.lit("")), sibling["left"]
        return F.sha2(F.when(left, F.concat(other, node)).otherwise(F.concat(node, other)), 256)

    return F.aggregate(proof, leaf, up)


def tamper_evidence(docs: DataFrame, key: str = "doc_id", group: str = "lang", number: str = "n_chars", text: str = "text", source: str = "source", every: int = 7) -> DataFrame:
    """The manifest of a document table, held against a copy where one row in ``every`` (by the key's CRC-32) has its number raised by 1.

    Returns ``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified``; a null key or number is never changed.
    """

    def leaf(n: Column) -> Column:
        return digest(*(field(c) for c in (F.col(f"`{key}`"), F.col(f"`{source}`"), F.col(f"`{group}`"), n, F.col(f"`{text}`"))))

    hit = F.coalesce(F.crc32(F.col(f"`{key}`").cast("string")) % every == 0, F.lit(False))
    raised = F.col(f"`{number}`").cast("decimal(20,0)") + 1
    rows = docs.select(
        F.col(f"`{key}`").alias("doc_id"),
        F.col(f"`{group}`").alias("grp"),
        leaf(F.col(f"`{number}`")).alias("leaf"),
        F.when(hit, leaf(raised)).alias("tampered"),
    )
    found = manifest(rows, "doc_id", "grp", "leaf", ["doc_id", "tampered"])
    siblings = F.array_join("proof.hash", "")
    return found.select(
        "doc_id", "leaf", "subroot", "root", F.sha2(siblings, 256).alias("proof_sha256"), folded(F.coalesce("tampered", "leaf"), F.col("proof")).alias("folded_root")
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
