"""Merkle manifest of a dataset, with incremental witnesses.

Leaves of one tree (a source) stand in order; every 16 consecutive nodes have one
parent, level by level. Appends are aligned: a block is 4096 leaves that share the
same three levels. One task streams a block's leaves into a frontier of open runs;
each leaf has a partial witness from the moment it is appended, and every run that
completes extends the witnesses of all leaves below it. Block roots are the appends
of the next round, and the roots of all trees those of a last tree. What a later
round finds is the witness of a block root; it extends those of the block's leaves.

A later batch that goes behind the leaves so far (:func:`append`) opens only the last
block of each tree again; roots of closed blocks stay as they are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.places import places
from tidemark.session import work_dir

FAN = 16                 # children of a node
LEVELS = 3               # levels of a block, which has 16^3 = 4096 leaves
SIZE = 32                # bytes of a digest
LEAF_ORDER = ("key", "digest")


# --- hashing -------------------------------------------------------------------

def leaf_digest(columns: Sequence[str | Column]) -> Column:
    """SHA-256 over the columns: ``-`` for a null, else UTF-8 byte count, ``:``, value."""
    parts = []
    for c in columns:
        text = (F.col(f"`{c}`") if isinstance(c, str) else c).cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text),
                                F.lit("-")))
    return F.unhex(F.sha2(F.concat(*parts), 256))


def _parent(children: bytes) -> bytes:
    """Digest of the children's digests as hexadecimal text."""
    return hashlib.sha256(children.hex().encode()).digest()


def levels_of(n: int) -> int:
    """Levels above n leaves until one node remains."""
    levels = 0
    while n > 1:
        n, levels = -(-n // FAN), levels + 1
    return levels


class Frontier:
    """Open runs of one block. ``witnesses[i]`` are the parts of leaf i's witness so far:
    for each level one byte for its place, one for the number of siblings, the siblings."""

    def __init__(self, levels: int):
        self.levels = levels
        self.open: list[list[tuple[bytes, int, int]]] = [[] for _ in range(levels + 1)]
        self.witnesses: list[list[bytes]] = []

    def append(self, digest: bytes) -> None:
        at = len(self.witnesses)
        self.witnesses.append([])
        self.open[0].append((digest, at, at + 1))
        level = 0
        while level < self.levels and len(self.open[level]) == FAN:
            self._complete(level)
            level += 1

    def _complete(self, level: int) -> None:
        run, self.open[level] = self.open[level], []
        digests = b"".join(d for d, _, _ in run)
        for place, (_, lo, hi) in enumerate(run):
            part = (bytes((place, len(run) - 1)) + digests[:place * SIZE]
                    + digests[(place + 1) * SIZE:])
            for i in range(lo, hi):
                self.witnesses[i].append(part)
        self.open[level + 1].append((_parent(digests), run[0][1], run[-1][2]))

    def finish(self) -> bytes:
        """Completes the runs that are still open; the root of the block."""
        for level in range(self.levels):
            if self.open[level]:
                self._complete(level)
        (root, _, _), = self.open[self.levels]
        return root


def _grow(digests: list[bytes], n: int, levels: int) -> Frontier:
    """The block's frontier; its tree has n nodes of this round."""
    frontier = Frontier(min(levels, levels_of(n)))
    for d in digests:
        frontier.append(d)
    return frontier


@F.arrow_udf(T.StructType([T.StructField("root", T.StringType()),
                           T.StructField("proof_sha256", T.StringType())]))
def fold(leaf: pa.Array, witness: pa.Array) -> pa.Array:
    """The root that a leaf and its witness lead to, and the digest of all siblings."""
    roots, proofs = [], []
    for node, path in zip(leaf.to_pylist(), witness.to_pylist()):
        if node is None or path is None:
            roots.append(None)
            proofs.append(None)
            continue
        at, proof = 0, hashlib.sha256()
        while at < len(path):
            place, n = path[at], path[at + 1]
            others = path[at + 2:at + 2 + n * SIZE]
            at += 2 + n * SIZE
            node = _parent(others[:place * SIZE] + node + others[place * SIZE:])
            proof.update(others.hex().encode())
        roots.append(node.hex())
        proofs.append(proof.hexdigest())
    return pa.StructArray.from_arrays([pa.array(roots, pa.string()), pa.array(proofs, pa.string())],
                                      ["root", "proof_sha256"])


# --- rounds ----------------------------------------------------------------------

def _block(levels: int, at: str | Column = "at") -> Column:
    return F.shiftright(at, levels * (FAN.bit_length() - 1))


def _raise(nodes: DataFrame, levels: int) -> DataFrame:
    """Block roots of nodes (tree, at, n, digest): the nodes of the next round."""
    schema, size = "tree string, at long, n long, digest binary", FAN ** levels

    def up(block: pa.Table) -> pa.Table:
        block = block.sort_by("at")
        n = block["n"][0].as_py()
        root = _grow(block["digest"].to_pylist(), n, levels).finish()
        return pa.table({"tree": [block["tree"][0].as_py()], "at": [block["at"][0].as_py() // size],
                         "n": [-(-n // size)], "digest": [root]},
                        pa.schema([("tree", pa.string()), ("at", pa.int64()), ("n", pa.int64()),
                                   ("digest", pa.binary())]))

    return (nodes.select("tree", "at", "n", "digest").groupBy("tree", _block(levels).alias("block"))
            .applyInArrow(up, schema))


def _extend(nodes: DataFrame, above: DataFrame, levels: int) -> DataFrame:
    """``nodes`` with their witnesses up to the tree's root and on: the block's own, streamed
    again, then its root's (``above``: tree, at, witness, subroot, root)."""
    out = T.StructType([*nodes.schema.fields, T.StructField("witness", T.BinaryType()),
                        T.StructField("subroot", T.BinaryType()),
                        T.StructField("root", T.BinaryType())])

    names = nodes.columns

    def down(block: pa.Table, root: pa.Table) -> pa.Table:
        block = block.sort_by("at")
        frontier = _grow(block["digest"].to_pylist(), block["n"][0].as_py(), levels)
        frontier.finish()
        rest = root["witness"][0].as_py()
        full = [b"".join(parts) + rest for parts in frontier.witnesses]
        columns = [block[c] for c in names] + [pa.array(full, pa.binary())]
        for name in ("subroot", "root"):
            columns.append(pa.array([root[name][0].as_py()] * len(full), pa.binary()))
        return pa.table(columns, names=[*names, "witness", "subroot", "root"])

    blocks = nodes.withColumn("block", _block(levels))
    roots = above.withColumnRenamed("at", "block")
    return (blocks.groupBy("tree", "block").cogroup(roots.groupBy("tree", "block"))
            .applyInArrow(down, out))


# --- the manifest ----------------------------------------------------------------

@dataclass(frozen=True)
class Manifest:
    """``rounds[0]``: the leaves (tree, key, digest, row, at, n); ``rounds[r]``: block roots
    (tree, at, n, digest), the last of which are the subroots. ``top``: the rounds of
    the last tree, whose leaves are the subroots in order. ``levels``: those of a block."""

    rounds: list[DataFrame]
    top: list[DataFrame]
    levels: int = LEVELS


def _tree(source: str) -> Column:
    """Trees in byte order of their source, null first."""
    return F.coalesce(F.concat(F.lit("="), F.col(f"`{source}`").cast("string")), F.lit(""))


def as_leaves(docs: DataFrame, columns: Sequence[str], id_col: str = "doc_id",
              source_col: str = "source", extra: dict[str, Column] | None = None) -> DataFrame:
    """(tree, key, digest, row) of each row; struct ``row`` has the id, the source and ``extra``."""
    row = F.struct(F.col(f"`{id_col}`").alias("id"), F.col(f"`{source_col}`").alias("source"),
                   *[c.alias(name) for name, c in (extra or {}).items()])
    return docs.select(_tree(source_col).alias("tree"), F.col(f"`{id_col}`").alias("key"),
                       leaf_digest(columns).alias("digest"), row.alias("row"))


def _rounds(first: DataFrame, levels: int) -> list[DataFrame]:
    """Rounds above placed nodes, until each tree is one node. A round has a 4096th of
    the nodes below, so there are few: three for 68 billion leaves of one tree."""
    rounds = [first]
    while (rounds[-1].agg(F.max("n")).first()[0] or 0) > 1:
        rounds.append(_raise(rounds[-1], levels).checkpoint())
    return rounds


def _topped(rounds: list[DataFrame], levels: int) -> Manifest:
    """A round in which all trees are one node has the subroots."""
    subroots = rounds[-1].select(F.lit("").alias("tree"), F.col("tree").alias("key"), "digest")
    return Manifest(rounds, _rounds(places(subroots, "tree", LEAF_ORDER), levels), levels)


def build(leaves: DataFrame, levels: int = LEVELS) -> Manifest:
    """Manifest of leaves (:func:`as_leaves`). In each tree leaves ascend by key, null
    first; leaves with one key by digest, so repeated rows are leaves of their own."""
    work_dir(leaves.sparkSession)
    return _topped(_rounds(places(leaves.checkpoint(), "tree", LEAF_ORDER), levels), levels)


def append(manifest: Manifest, leaves: DataFrame) -> Manifest:
    """The manifest after ``leaves`` went behind those of their trees. Only blocks that
    were open, or are new, are streamed; the roots of closed blocks are taken over.

    Raises ValueError if a new key does not follow the tree's last one.
    """
    work_dir(leaves.sparkSession)
    old = manifest.rounds[0]
    ends = old.groupBy("tree").agg(F.max("n").alias("old_n"), F.max("key").alias("last"))
    more = places(leaves.checkpoint(), "tree", LEAF_ORDER).join(ends, "tree", "left")
    if not more.where("last IS NOT NULL AND (key IS NULL OR key <= last)").isEmpty():
        raise ValueError("appended keys must follow the last key of their tree")
    more = more.withColumn("at", F.col("at") + F.coalesce("old_n", F.lit(0))).drop("last", "old_n")
    grown = (more.groupBy("tree").agg(F.max("n").alias("more_n")).join(ends, "tree", "full_outer")
             .select("tree", F.coalesce("old_n", F.lit(0)).alias("old_n"),
                     (F.coalesce("old_n", F.lit(0)) + F.coalesce("more_n", F.lit(0))).alias("n"))
             .checkpoint())
    placed = (old.unionByName(more).drop("n").join(grown.select("tree", "n"), "tree")
              .select(*old.columns).checkpoint())
    levels = manifest.levels
    closed = _block(levels, "old_n")
    fresh = placed.join(grown.select("tree", "old_n"), "tree").where(_block(levels) >= closed)
    roots = _raise(fresh, levels)
    if len(manifest.rounds) > 1:
        kept = manifest.rounds[1].drop("n").join(grown, "tree").where(F.col("at") < closed)
        blocks = _block(levels, F.col("n") + FAN ** levels - 1)
        kept = kept.select("tree", "at", blocks.alias("n"), "digest")
        roots = roots.unionByName(kept)
    return _topped([placed, *_rounds(roots.checkpoint(), levels)], levels)


def _descend(rounds: list[DataFrame], seeds: DataFrame, levels: int) -> DataFrame:
    """The nodes of the first round with witness, subroot and root, from those of each
    tree's root (``seeds``: tree, witness, subroot, root)."""
    found = rounds[-1].join(seeds, "tree")
    for nodes in reversed(rounds[:-1]):
        found = _extend(nodes, found.select("tree", "at", "witness", "subroot", "root"), levels)
    return found


def witnesses(manifest: Manifest) -> DataFrame:
    """Every leaf (tree, key, digest, row, at, n) with its ``witness`` up to the manifest's
    root, the root of its tree and the root; :func:`fold` follows a witness. No leaves: no rows."""
    last = manifest.top[-1].select("tree", F.lit(b"").alias("witness"),
                                   F.col("digest").alias("subroot"), F.col("digest").alias("root"))
    trees = _descend(manifest.top, last, manifest.levels).select(
        F.col("key").alias("tree"), "witness", F.col("digest").alias("subroot"), "root")
    return _descend(manifest.rounds, trees, manifest.levels)
