"""Merkle manifest of a dataset: a tree per group of rows, a tree over the groups, proofs, and their verification.

Rows are leaves.  Within a group they stand in the order of a key; every ``arity`` consecutive nodes (the last run may
have fewer, even one) become one, until one remains, the subroot.  Subroots, in the order of their groups, are the
leaves of the tree that gives the root.  A node is the SHA-256 of its children's lower-case hex digests, one after the
other.  The proof of a row is what a verifier lacks: the other members of every run from the leaf to the root.

A tree may hold a third of all rows, so it is never in one place.  ``arity ** levels`` consecutive nodes are a
superblock, which starts at a multiple of its size and so holds whole runs only:

1. Leaves get their positions: range partitions in order of group and key, counts per partition and group, and
   their running sums.  Equal leaves of one key may stand in any order among themselves.
2. Climbing: each superblock is reduced to its node; the nodes of superblocks are numbered by them and are cut into
   superblocks in turn, until every tree is one node.  The subroots climb in the same way.
3. Descending, the exchange: the nodes of a level are cogrouped by superblock with the outer nodes that their
   superblock's own node needs (its proof).  The group is reduced once more, which gives each member its siblings
   inside; with the outer ones they are its proof.  At the leaves the same call folds the claimed leaf up to a root.

Superblocks are dealt to slots of about ``slot_rows`` rows, so groups of a single row do not cost a call each and no
call sees more than a few superblocks.  Each level is a table in the shared folder; a lost executor repeats tasks.

Defined cases: nulls are written as ``-``, so they differ from empty texts; rows of a null group are a group of their
own, before all others; null keys come first; repeated rows are leaves of their own; an empty table has no rows and no
root; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import itertools
import math
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logweft.llm.landing import Scratch, landed, small


@dataclass(frozen=True)
class MerkleConfig:
    """``levels`` of one superblock; rows of a slot and of a task that numbers leaves, about; rows of a broadcast at most."""

    arity: int = 3
    levels: int = 7
    slot_rows: int = 20_000
    task_rows: int = 500_000
    broadcast_rows: int = 200_000

    @property
    def span(self) -> int:
        return self.arity ** self.levels


# --- hashes ------------------------------------------------------------------------------------------------


def field(value: Column) -> Column:
    """A value with its length in bytes before it; ``-`` for null."""
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(
        F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_hash(*values: Column) -> Column:
    """SHA-256 of the fields, lower-case hex."""
    return F.sha2(F.concat(*[field(v) for v in values]).cast("binary"), 256)


def combine(run: list[bytes]) -> bytes:
    """The node above a run of digests."""
    return hashlib.sha256(b"".join(run).hex().encode()).digest()


def layers(nodes: list[bytes], arity: int, most: int | None) -> list[list[bytes]]:
    """``nodes`` and the layers above: ``most`` of them, or those up to a single node."""
    out = [nodes]
    while len(out[-1]) > 1 if most is None else len(out) <= most:
        below = out[-1]
        out.append([combine(below[k: k + arity]) for k in range(0, len(below), arity)])
    return out


def path_of(built: list[list[bytes]], index: int, arity: int) -> bytes:
    """The siblings of a leaf of ``layers``: per layer its place in the run, the run's length, and the others."""
    out = []
    for layer in built[:-1]:
        place = index % arity
        run = layer[index - place: index - place + arity]
        out.append(bytes((place, len(run))) + b"".join(run[:place] + run[place + 1:]))
        index //= arity
    return b"".join(out)


def steps(path: bytes) -> Iterator[tuple[int, list[bytes]]]:
    """Place and siblings of every step of a path."""
    at = 0
    while at < len(path):
        place, length = path[at], path[at + 1]
        end = at + 2 + 32 * (length - 1)
        yield place, [path[k: k + 32] for k in range(at + 2, end, 32)]
        at = end


def fold(leaf: bytes, path: bytes) -> bytes:
    """The root that a leaf and its path give."""
    for place, others in steps(path):
        leaf = combine([*others[:place], leaf, *others[place:]])
    return leaf


def proof_digest(path: bytes) -> bytes:
    """The digest of all siblings of a path, as if they were one run."""
    return combine([node for _, others in steps(path) for node in others])


# --- climbing ----------------------------------------------------------------------------------------------


def _numbered(rows: DataFrame, order: list[str], config: MerkleConfig, scratch: Scratch, name: str) -> DataFrame:
    """``rows`` with ``pos``, their position within ``tree`` in the given order, and ``total``, the rows of the tree."""
    keys = ["tree", *order, "_row"]
    tasks = max(1, math.ceil(rows.count() / config.task_rows))
    ordered = rows.withColumn("_row", F.monotonically_increasing_id()).repartitionByRange(
        tasks, *keys).sortWithinPartitions(*keys).drop("_row")

    def number(batches):
        part, last, n = TaskContext.get().partitionId(), (), 0
        for batch in batches:
            nth = []
            for tree, run in itertools.groupby(batch.column("tree").to_pylist()):
                n, last, more = (n if (tree,) == last else 0), (tree,), sum(1 for _ in run)
                nth.append(range(n, n + more))
                n += more
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([part] * batch.num_rows, pa.int32()),
                 pa.array(list(itertools.chain.from_iterable(nth)), pa.int64())], [*batch.schema.names, "part", "nth"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ordered.schema)
    placed = scratch.land(ordered.mapInArrow(number, f"{schema}, part int, nth long"), f"{name}-placed")
    whole = Window.partitionBy("tree")
    before = scratch.land(
        placed.groupBy("tree", "part").agg(F.count("*").alias("n")).select(
            F.col("tree").alias("_tree"), F.col("part").alias("_part"), F.sum("n").over(whole).alias("total"),
            (F.sum("n").over(whole.orderBy("part")) - F.col("n")).alias("before")), f"{name}-before")
    joined = placed.join(small(before, config.broadcast_rows), F.col("tree").eqNullSafe(F.col("_tree")) & (F.col("part") == F.col("_part")))
    return joined.select(*rows.columns, (F.col("before") + F.col("nth")).alias("pos"), "total")


def _slotted(nodes: DataFrame, config: MerkleConfig, block: Column, slots: int) -> DataFrame:
    return nodes.withColumn("block", block).withColumn("slot", F.pmod(F.xxhash64("tree", "block"), F.lit(slots)))


def _superblocks(table: pa.Table, config: MerkleConfig, node: str):
    """Per superblock its tree, its number, the rows' indices in order and the layers over them."""
    trees, blocks, positions, totals, nodes = (table.column(c).to_pylist() for c in ("tree", "block", "pos", "total", node))
    key = lambda i: (trees[i] is not None, trees[i] or "", blocks[i])
    rows = sorted(range(table.num_rows), key=lambda i: (*key(i), positions[i]))
    for _, run in itertools.groupby(rows, key=key):
        members = list(run)
        first = members[0]
        yield trees[first], blocks[first], members, layers(
            [nodes[i] for i in members], config.arity, None if totals[first] <= config.span else config.levels)


def _block_of(config: MerkleConfig) -> Column:
    return F.floor(F.col("pos") / F.lit(config.span)).cast("long")


def _climb(leaves: DataFrame, config: MerkleConfig, scratch: Scratch, name: str) -> list[DataFrame]:
    """Tables ``tree, pos, total, node`` of the superblocks' nodes, level by level; the last has one node per tree."""
    kind = leaves.schema["tree"].dataType.simpleString()

    def reduce(table: pa.Table) -> pa.Table:
        out = [(tree, block, -(-table.column("total")[members[0]].as_py() // config.span), built[-1][0])
               for tree, block, members, built in _superblocks(table, config, "node")]
        tree, pos, total, node = zip(*out, strict=True)
        return pa.table({"tree": pa.array(tree, table.schema.field("tree").type), "pos": pa.array(pos, pa.int64()),
                         "total": pa.array(total, pa.int64()), "node": pa.array(node, pa.binary())})

    levels, nodes = [], leaves
    while True:
        slots = max(1, math.ceil(nodes.count() / config.slot_rows))
        grouped = _slotted(nodes.select("tree", "pos", "total", "node"), config, _block_of(config), slots).groupBy("slot")
        nodes = scratch.land(grouped.applyInArrow(reduce, f"tree {kind}, pos long, total long, node binary"), f"{name}-{len(levels)}")
        levels.append(nodes)
        if (nodes.agg(F.max("total")).first()[0] or 1) <= 1:
            return levels


# --- descending --------------------------------------------------------------------------------------------


def _exchanged(nodes: DataFrame, outer: DataFrame, config: MerkleConfig, finish, schema: str) -> DataFrame:
    """Cogroup nodes with the outer paths of their superblocks; ``finish`` turns rows and their whole paths into a table."""
    slots = max(1, math.ceil(nodes.count() / config.slot_rows))

    def exchange(rows: pa.Table, paths: pa.Table) -> pa.Table:
        known = {(t, b): (p, s) for t, b, p, s in zip(*(paths.column(c).to_pylist() for c in ("tree", "block", "path", "subroot")), strict=True)}
        path, subroot = [b""] * rows.num_rows, [b""] * rows.num_rows
        for tree, block, members, built in _superblocks(rows, config, "node"):
            above, top = known[tree, block]
            for index, i in enumerate(members):
                path[i], subroot[i] = path_of(built, index, config.arity) + above, top
        return finish(rows, path, subroot)

    left = _slotted(nodes, config, _block_of(config), slots)
    right = _slotted(outer, config, F.col("pos"), slots)
    return left.groupBy("slot").cogroup(right.groupBy("slot")).applyInArrow(exchange, schema)


def _descend(levels: list[DataFrame], outer: DataFrame, config: MerkleConfig, scratch: Scratch, name: str) -> DataFrame:
    """``tree, pos, path, subroot`` of the lowest level of superblocks' nodes, given those of the trees' last nodes."""
    kind = levels[0].schema["tree"].dataType.simpleString()

    def finish(rows, path, subroot):
        return pa.table([rows.column("tree"), rows.column("pos"), pa.array(path, pa.binary()), pa.array(subroot, pa.binary())],
                        names=["tree", "pos", "path", "subroot"])

    for number, nodes in reversed(list(enumerate(levels[:-1]))):
        outer = scratch.land(
            _exchanged(nodes, outer, config, finish, f"tree {kind}, pos long, path binary, subroot binary"), f"{name}-paths-{number}")
    return outer


def manifest(leaves: DataFrame, config: MerkleConfig = MerkleConfig(), with_proof: bool = False) -> DataFrame:
    """Manifest and verification of rows ``tree`` (string), ``key``, ``leaf`` and ``claimed`` (hex digests; a null claim
    is the leaf): ``tree, key, leaf, subroot, root, proof_sha256, folded_root, verified``, and with ``with_proof``
    ``proof``, the siblings' hex digests in order.

    ``leaf`` is what the manifest is made of, ``claimed`` what is folded up along the leaf's own siblings.
    """
    scratch = Scratch(leaves.sparkSession, "merkle")
    rows = scratch.land(leaves.select(
        "tree", "key", F.unhex("leaf").alias("node"),
        F.when(F.col("claimed") != F.col("leaf"), F.unhex("claimed")).alias("claimed")), "leaves")
    placed = scratch.land(_numbered(rows, ["key", "node"], config, scratch, "leaves"), "positions")
    levels = _climb(placed, config, scratch, "nodes")

    # The subroots are leaves of one more tree, in the order of their names.
    tops = levels[-1].select(F.lit("").alias("tree"), F.col("tree").alias("name"), "node")
    tops = scratch.land(_numbered(tops, ["name"], config, scratch, "tops"), "top-positions")
    top_levels = _climb(tops, config, scratch, "top-nodes")
    found = top_levels[-1].first()
    root = bytes(found.node) if found else b""
    outer = _descend(top_levels, top_levels[-1].select("tree", "pos", F.lit(b"").alias("path"), F.lit(b"").alias("subroot")),
                     config, scratch, "top")
    kind = leaves.schema["tree"].dataType.simpleString()

    def name_paths(table, path, _):
        return pa.table([table.column("name"), pa.array([0] * table.num_rows, pa.int64()), pa.array(path, pa.binary()),
                         table.column("node").cast(pa.binary())], names=["tree", "pos", "path", "subroot"])

    outer = scratch.land(_exchanged(tops, outer, config, name_paths, f"tree {kind}, pos long, path binary, subroot binary"), "tree-paths")
    outer = _descend(levels, outer, config, scratch, "nodes")

    def verify(table, path, subroot):
        nodes, claims = table.column("node").to_pylist(), table.column("claimed").to_pylist()
        folded = [fold(c if c is not None else n, p) for n, c, p in zip(nodes, claims, path, strict=True)]
        columns = [table.column("tree"), table.column("key"), table.column("node"), pa.array(subroot, pa.binary()),
                   pa.array([proof_digest(p) for p in path], pa.binary()), pa.array(folded, pa.binary())]
        names = ["tree", "key", "leaf", "subroot", "proof_sha256", "folded_root"]
        if with_proof:
            columns.append(pa.array([[n.hex() for _, others in steps(p) for n in others] for p in path], pa.list_(pa.string())))
            names.append("proof")
        return pa.table(columns, names=names)

    key = leaves.schema["key"].dataType.simpleString()
    digests = _exchanged(
        placed, outer, config, verify, f"tree {kind}, key {key}, leaf binary, subroot binary, proof_sha256 binary, folded_root binary"
        + (", proof array<string>" if with_proof else ""))
    as_hex = lambda c: F.lower(F.hex(c)).alias(c)
    result = landed(digests.select(
        "tree", "key", as_hex("leaf"), as_hex("subroot"), F.lit(root.hex()).alias("root"), as_hex("proof_sha256"),
        as_hex("folded_root"), (F.col("folded_root") == F.lit(root)).alias("verified"), *(["proof"] if with_proof else [])), "merkle-manifest")
    scratch.drop()
    return result
