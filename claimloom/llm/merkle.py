"""Merkle dataset manifest: aligned builders append their nodes to a postorder log.

The leaves of a tree are numbered from 0 in key order and cut into aligned
blocks of 2^HEIGHT. One builder per block reads its leaves in order and appends
every node at the moment it is complete, so the block's nodes lie in postorder.
The roots of the blocks are the leaves of the next tier, and so on; a tree of
10^10 leaves has four tiers, and no builder ever holds more than one block.

Where a node lies in the log needs no index. The node of level h whose last
leaf is e stands at ``2e - popcount(e) + h``: the subtrees complete before it
hold that many nodes. Proofs take their siblings from the log by this position,
top tier first; the path above a block is joined to it once, not per leaf.

Trees are binary; the last node of a level may be alone, and then its parent is
the digest of it alone. A tree of one leaf is that leaf. Digests are sha256,
and enter the next digest as lowercase hex text.

Defined cases: null fields count as ``-``; a null group is a group of its own,
before all others; rows with equal keys stand in the order of their digests
(null keys first), so repeated rows keep a place each; an empty table gives no
rows and no root. Other columns of the table are never looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator, Mapping, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from claimloom.llm.batches import pieces
from claimloom.operators.numbering import number_by_key
from claimloom.staging import stage

# A builder takes 2^HEIGHT leaves: some 100 kB.
HEIGHT = 10
_SIBLINGS = "array<struct<digest: binary, left: boolean>>"


def field(value: Column) -> Column:
    """UTF-8 byte count, ``:``, value; ``-`` for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(fields: Sequence[Column]) -> Column:
    """Hex digest of a row's fields."""
    return F.sha2(F.concat(*[field(c) for c in fields]), 256)


def parent(*children: bytes) -> bytes:
    return hashlib.sha256("".join(c.hex() for c in children).encode()).digest()


def levels_of(n: int, block: int, height: int = HEIGHT) -> int:
    """Levels above the leaves of a block of ``n``. Only a tree's last block can be short:
    if it is the first as well, the tree ends there, else it is raised like the others."""
    return (n - 1).bit_length() if block == 0 else height


def postorder(leaves: Iterable[bytes], top: int) -> bytes:
    """All nodes up to level ``top``, in the order in which they are complete."""
    log, edge = bytearray(), []
    for digest in leaves:
        level = 0
        log += digest
        while edge and edge[-1][0] == level:
            digest = parent(edge.pop()[1], digest)
            level += 1
            log += digest
        edge.append((level, digest))
    level, digest = edge.pop()
    while level < top:
        digest = parent(edge.pop()[1], digest) if edge and edge[-1][0] == level else parent(digest)
        level += 1
        log += digest
    return bytes(log)


def position(level, last):
    """Place in the log of the node of ``level`` whose last leaf is ``last`` (numbers or numpy arrays)."""
    return 2 * last - np.bitwise_count(last).astype(np.int64) + level


def tree_key(group: Column) -> Column:
    """A group's value as a text that is never null and sorts like it, null first."""
    return F.coalesce(F.concat(F.lit("="), group.cast("string")), F.lit(""))


def build_log(leaves: DataFrame, payload: Sequence[str] = (), height: int = HEIGHT) -> list[DataFrame]:
    """The tiers of the log from ``leaves(tree, rank, digest)`` and payload columns, each staged.

    A tier holds one row per block: (tree, block, n, nodes, members), ``nodes``
    being the block's part of the log and ``members`` its leaves in order, as
    (rank, digest, last, payload). ``last`` is the last leaf below a member.
    """

    @F.arrow_udf("binary")
    def built(digests: pa.Array, blocks: pa.Array) -> pa.Array:
        logs = []
        for own, block in zip(digests, blocks.to_pylist()):
            listed = own.values.to_pylist()
            logs.append(postorder(listed, levels_of(len(listed), block, height)))
        return pa.array(logs, pa.binary())

    top = leaves.agg(F.max("rank")).first()[0] or 0
    members = leaves.withColumn("last", F.col("rank"))
    tiers: list[DataFrame] = []
    while True:
        listed = F.struct("rank", "digest", "last", F.struct(*(payload if not tiers else ()), F.lit(0).alias("_")).alias("payload"))
        blocks = (
            members.groupBy("tree", F.shiftright("rank", height).alias("block"))
            .agg(F.array_sort(F.collect_list(listed)).alias("members"))
            .withColumn("nodes", built(F.col("members.digest"), F.col("block")))
        )
        tiers.append(
            stage(blocks.select("tree", "block", F.size("members").alias("n"), "nodes", "members"), f"merkle-{len(tiers)}")
        )
        top >>= height
        if top == 0:
            return tiers
        members = tiers[-1].select(
            "tree", F.col("block").alias("rank"), F.substring("nodes", -32, 32).alias("digest"),
            F.element_at("members", -1)["last"].alias("last"),
        )


def tree_roots(tiers: Sequence[DataFrame]) -> DataFrame:
    """(tree, n_leaves, root): the last tier has one block per tree."""
    return tiers[-1].select(
        "tree", (F.element_at("members", -1)["last"] + 1).alias("n_leaves"), F.substring("nodes", -32, 32).alias("root")
    )


def log_nodes(tiers: Sequence[DataFrame], height: int = HEIGHT) -> DataFrame:
    """(tree, position, level, digest): the log node by node. Its order is ``position``."""
    schema = "tree string, position long, level int, digest binary"

    def told(tier: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for piece in pieces(batches, 1):
                tree, block, n, nodes = (piece.column(i)[0].as_py() for i in range(4))
                last = np.array(piece.column(4)[0].as_py(), dtype=np.int64)
                table = np.frombuffer(nodes, np.uint8).reshape(-1, 32)
                # the lowest level of a higher tier is the highest of the tier below
                for level in range(0 if tier == 0 else 1, levels_of(n, block, height) + 1):
                    ends = np.minimum(np.arange(1, (n - 1 >> level) + 2, dtype=np.int64) << level, n) - 1
                    absolute = tier * height + level
                    digests = [row.tobytes() for row in table[position(level, ends)]]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([tree] * len(ends), pa.string()),
                            pa.array(position(absolute, last[ends])),
                            pa.array(np.full(len(ends), absolute, np.int32)),
                            pa.array(digests, pa.binary()),
                        ],
                        names=["tree", "position", "level", "digest"],
                    )

        return run

    parts = [
        tier.select("tree", "block", "n", "nodes", F.col("members.last")).mapInArrow(told(i), schema)
        for i, tier in enumerate(tiers)
    ]
    return reduce(DataFrame.union, parts)


def _paths(nodes: bytes, n: int, block: int, height: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per member and level: the sibling's digest, whether there is one, and whether it stands left."""
    table = np.frombuffer(nodes, np.uint8).reshape(-1, 32)
    top = levels_of(n, block, height)
    places = np.arange(n, dtype=np.int64)
    digests = np.zeros((n, top, 32), np.uint8)
    there, left = np.zeros((n, top), bool), np.zeros((n, top), bool)
    for level in range(top):
        sibling = (places >> level) ^ 1
        there[:, level] = sibling << level < n
        left[:, level] = sibling < places >> level
        last = np.minimum((sibling + 1) << level, n) - 1
        known = there[:, level]
        digests[known, level] = table[position(level, last[known])]
    return digests, there, left


def prove(tiers: Sequence[DataFrame], above: DataFrame, payload: Sequence[str] = (), height: int = HEIGHT) -> DataFrame:
    """(tree, rank, digest, payload, root, siblings): every leaf's proof, from the leaf upwards.

    ``above(tree, root, siblings)`` continues the path beyond each tree's root. A
    sibling is (digest, left); its digest is null where a node has none.
    """

    def opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.struct([("digest", pa.binary()), ("left", pa.bool_())])
        for piece in pieces(batches, 1):
            tree, block, n, nodes, root = (piece.column(i)[0].as_py() for i in range(5))
            upper = piece.column(5)[0].as_py()
            members = piece.column(6).flatten()
            digests, there, left = _paths(nodes, n, block, height)
            if upper:
                bytes_of = [s["digest"] or bytes(32) for s in upper]
                more = np.frombuffer(b"".join(bytes_of), np.uint8).reshape(1, -1, 32)
                digests = np.concatenate([digests, np.broadcast_to(more, (n, *more.shape[1:]))], axis=1)
                told = np.array([[s["digest"] is not None, s["left"]] for s in upper]).T[:, None, :]
                there = np.concatenate([there, np.broadcast_to(told[0], (n, len(upper)))], axis=1)
                left = np.concatenate([left, np.broadcast_to(told[1], (n, len(upper)))], axis=1)
            size = there.size
            flat = pa.Array.from_buffers(
                pa.binary(), size,
                [
                    pa.py_buffer(np.packbits(there.ravel(), bitorder="little").tobytes()),
                    pa.py_buffer((np.arange(size + 1, dtype=np.int32) * 32).tobytes()),
                    pa.py_buffer(np.ascontiguousarray(digests).tobytes()),
                ],
            )
            steps = pa.StructArray.from_arrays([flat, pa.array(left.ravel())], fields=list(kind))
            offsets = pa.array(np.arange(n + 1, dtype=np.int32) * there.shape[1])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([tree] * n, pa.string()),
                    members.field("rank"), members.field("digest"), members.field("payload"),
                    pa.array([root] * n, pa.binary()),
                    pa.ListArray.from_arrays(offsets, steps),
                ],
                names=["tree", "rank", "digest", "payload", "root", "siblings"],
            )

    path = above.select("tree", F.lit(0).cast("long").alias("block"), "root", "siblings")
    for tier in reversed(tiers):
        carried = tier.schema["members"].dataType.elementType["payload"].dataType.simpleString()
        proved = (
            tier.join(path, ["tree", "block"])
            .select("tree", "block", "n", "nodes", "root", "siblings", "members")
            .mapInArrow(
                opened,
                f"tree string, rank long, digest binary, payload {carried}, root binary, siblings {_SIBLINGS}",
            )
        )
        path = proved.select("tree", F.col("rank").alias("block"), "root", "siblings")
    return proved.select("tree", "rank", "digest", *[F.col("payload")[c].alias(c) for c in payload], "root", "siblings")


def hexed(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def proof_digest(siblings: Column) -> Column:
    """Hex digest of all siblings from the leaf upwards, those that exist."""
    return F.sha2(F.array_join(F.transform(siblings, lambda s: hexed(s["digest"])), ""), 256)


def fold(leaf: Column, siblings: Column) -> Column:
    """The root (hex) that ``leaf`` (hex) and its proof lead to."""

    def step(digest: Column, sibling: Column) -> Column:
        other = hexed(sibling["digest"])
        both = F.when(sibling["left"], F.concat(other, digest)).otherwise(F.concat(digest, other))
        return F.sha2(F.coalesce(both, digest), 256)

    return F.aggregate(siblings, leaf, step)


def manifest(
    rows: DataFrame, fields: Sequence[str], group: str, key: str, keep: Mapping[str, Column], height: int = HEIGHT
) -> DataFrame:
    """(columns of ``keep``, leaf, subroot, root, siblings): one row per row, digests as hex, its proof.

    Every value of ``group`` is a tree whose leaves ascend by ``key``; the trees'
    roots, ascending by value, are the leaves of one more tree.
    """
    names = [f"k{i}" for i in range(len(keep))]
    leaves = rows.select(
        tree_key(F.col(group)).alias("tree"),
        F.col(key).alias("key"),
        F.unhex(leaf_digest([F.col(c) for c in fields])).alias("digest"),
        *[c.alias(name) for name, c in zip(names, keep.values())],
    )
    # staged, so that the texts are read once though the range sort samples its input
    ranked = number_by_key(stage(leaves, "merkle-leaves"), ["key", "digest"], "rank", start=0, within=["tree"])
    tiers = build_log(ranked.drop("key"), names, height)
    roots = tree_roots(tiers)
    trees = number_by_key(roots, ["tree"], "rank", start=0)
    upper = build_log(trees.select(F.lit("").alias("tree"), "rank", F.col("root").alias("digest"), F.col("tree").alias("name"), F.col("root").alias("subroot")), ["name", "subroot"], height)
    none = F.array().cast(_SIBLINGS)
    joined = prove(upper, tree_roots(upper).select("tree", "root", none.alias("siblings")), ["name", "subroot"], height)
    # the root of all stands in the path's first place on the way down, the tree's own in its payload
    above = joined.select(F.col("name").alias("tree"), F.concat("subroot", "root").alias("root"), "siblings")
    proved = prove(tiers, above, names, height)
    return proved.select(
        *[F.col(name).alias(c) for name, c in zip(names, keep)],
        hexed(F.col("digest")).alias("leaf"),
        hexed(F.substring("root", 1, 32)).alias("subroot"),
        hexed(F.substring("root", 33, 32)).alias("root"),
        "siblings",
    )
