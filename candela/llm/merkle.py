"""Merkle dataset manifest over a persistent path-copying tree.

Every row is a leaf (a hash of its fields). The leaves of a group, ordered by id, form a tree of runs of ``fan``
nodes; the groups' subroots, ordered by group (null first, then bytewise), form the top of the tree in the same way.

Tasks own aligned blocks of ``fan ** LEVELS`` leaves of one group, so a group of any size is spread over many tasks.
A block's subtree is built once (``Tree``). A tampered leaf makes a version of it: the version holds copies of the
leaf's ancestors only and shares every other node with the tree it came from (``Tree.version``). Block roots are
leaves of the next round of blocks, and so on (``climb``); a block then gets, in one row, the runs that lie above it, and
its versions go on copying ancestors along these up to a root of their own. No task holds more than a block, and what
travels above the leaves is one row per block.

Defined cases. A null field is ``-`` in the leaf's input, a null group is a group of its own. A null id is ordered first
and never tampered with. Repeated ids are ordered by their leaf hash; equal rows are leaves next to one another (and have
different siblings, hence may have different proofs). A group of one leaf is its own subroot, one group's subroot is the
root. No rows: no leaves, no root. Texts are hashed whole in the JVM and do not travel. Further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candela.llm.common import pick, read_table, release, stored, table_bytes
from candela.llm.ranked import ranked

FAN = 8
LEVELS = 4
RUN = "array<struct<at:int,run:array<binary>>>"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def digest(parts: list[bytes]) -> bytes:
    return hashlib.sha256(b"".join(parts)).hexdigest().encode()


class Tree:
    """Levels of a hash tree over a run of nodes (hex digests), ``height`` levels high or, if None, up to one node."""

    def __init__(self, nodes: list[bytes], fan: int = FAN, height: int | None = None):
        self.fan, self.levels = fan, [nodes]
        while len(self.levels) <= height if height is not None else len(self.levels[-1]) > 1:
            low = self.levels[-1]
            self.levels.append([digest(low[i : i + fan]) for i in range(0, len(low), fan)])

    @property
    def top(self) -> bytes:
        return self.levels[-1][0]

    def path(self, i: int) -> list[tuple[int, list[bytes]]]:
        """Per level the node's place in its run and the run's other nodes."""
        out = []
        for level in self.levels[:-1]:
            start = i - i % self.fan
            run = level[start : start + self.fan]
            out.append((i - start, run[: i - start] + run[i - start + 1 :]))
            i //= self.fan
        return out

    def version(self, i: int, leaf: bytes) -> list[bytes]:
        """Copies of the nodes from leaf ``i`` up to the top that a version with another leaf has of its own; all
        other nodes are those of this tree."""
        return climbed(leaf, self.path(i))


def climbed(node: bytes, path: list[tuple[int, list[bytes]]]) -> list[bytes]:
    """``node`` and its ancestors along ``path``."""
    out = [node]
    for at, run in path:
        out.append(digest([*run[:at], out[-1], *run[at:]]))
    return out


def leaf_hash(*fields: Column) -> Column:
    """Hash of the fields, each ``-`` if null, else its UTF-8 byte count, ``:`` and its value; 32 bytes."""
    def part(c: Column) -> Column:
        text = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))
    return F.unhex(F.sha2(F.concat(*[part(c) for c in fields]), 256))


def _tree(table: pa.Table, fan: int, levels: int) -> Tree:
    """The tree of one block; ``n`` nodes in the whole group decide whether it ends at the group's root."""
    n = table.column("n")[0].as_py()
    return Tree([h.hex().encode() for h in table.column("hash").to_pylist()], fan, levels if n > fan**levels else None)


def _blocks(nodes: DataFrame, fan: int, levels: int, keep: list[str], name: str) -> DataFrame:
    """nodes (g, pos, n, hash, ...) -> one stored row per block: g, pos, n (blocks of the group), hash (the block's top) and
    the block's nodes, packed."""
    size = fan**levels

    def fold(key, table):
        table = table.sort_by("pos")
        top = _tree(table, fan, levels).top
        n = table.column("n")[0].as_py()
        out = pa.table({"g": pa.array([key[0].as_py()], pa.string()), "pos": pa.array([key[1].as_py()], pa.int64()), "n": pa.array([-(-n // size)], pa.int64()),
                        "hash": pa.array([bytes.fromhex(top.decode())], pa.binary()),
                        "packed": pa.array([table_bytes(table.select([*keep, "pos", "n", "hash"]))], pa.binary())})
        release()
        return out

    keyed = nodes.withColumn("block", F.floor(F.col("pos") / size).cast("long"))
    return stored(keyed.groupBy("g", "block").applyInArrow(fold, "g string, pos long, n long, hash binary, packed binary"), name)


def climb(nodes: DataFrame, fan: int, levels: int) -> DataFrame:
    """nodes (g, pos, n, hash) -> g, pos, top (the root of the group's tree) and path (the runs from the node up to it)."""
    if (nodes.agg(F.max("n")).first()[0] or 0) <= 1:
        return nodes.select("g", "pos", F.col("hash").alias("top"), F.array().cast(RUN).alias("path"))
    blocks = _blocks(nodes, fan, levels, [], "merkle")
    above = climb(blocks.select("g", "pos", "n", "hash"), fan, levels).select("g", "pos", "top", "path")
    joined = blocks.select("g", "pos", "packed").join(above, ["g", "pos"])

    def unfold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                table = read_table(row["packed"])
                tree = _tree(table, fan, levels)
                paths = [[{"at": a, "run": [bytes.fromhex(h.decode()) for h in r]} for a, r in tree.path(i)] + row["path"] for i in range(table.num_rows)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["g"]] * table.num_rows, pa.string()), table.column("pos").combine_chunks(), pa.array([row["top"]] * table.num_rows, pa.binary()),
                     pa.array(paths, pa.list_(pa.struct([("at", pa.int32()), ("run", pa.list_(pa.binary()))])))], names=["g", "pos", "top", "path"])

    return stored(joined.mapInArrow(unfold, f"g string, pos long, top binary, path {RUN}"), "merkle_paths")


def manifest(rows: DataFrame, id_col: str = "doc_id", group_col: str = "lang", leaf_col: str = "leaf", changed_col: str = "changed",
             fan: int = FAN, levels: int = LEVELS) -> DataFrame:
    """``rows``: id (long), group (string), leaf hash and changed leaf hash (32 bytes; null if not tampered with).

    Per row: id, leaf, subroot, root, proof (the siblings, level by level up to the root), copied (the nodes a tampered
    leaf's version has of its own, its root last; null if not tampered with) and folded_root (recomputed from the changed,
    else the original leaf and the original siblings). Hashes are lower-case hex."""
    if fan < 2 or levels < 1:
        raise ValueError("fan must be at least 2, levels at least 1")
    leaves = pick(rows, **{id_col: "long", group_col: "string", leaf_col: "binary", changed_col: "binary"})
    leaves = leaves.select(F.coalesce(F.concat(F.lit("+"), group_col), F.lit("")).alias("g"), F.col(id_col).alias("id"),
                           F.col(leaf_col).alias("hash"), F.col(changed_col).alias("changed"))
    placed = ranked(stored(leaves, "leaves"), "g", ["id", "hash"], "leaves_ranked")
    blocks = _blocks(placed, fan, levels, ["id", "changed"], "merkle_leaves")
    inner = climb(blocks.select("g", "pos", "n", "hash"), fan, levels)
    groups = stored(inner.where("pos = 0").select(F.lit("").alias("all"), F.col("g").alias("name"), F.col("top").alias("hash")), "subroots")
    tops = ranked(groups, "all", ["name"], "subroots_ranked").withColumnRenamed("all", "g")
    outer = climb(tops.select("g", "pos", "n", "hash"), fan, levels).select("pos", F.col("top").alias("root"), F.col("path").alias("outer"))
    outer = tops.select("pos", F.col("name").alias("g"), F.col("hash").alias("subroot")).join(outer, "pos").drop("pos")
    above = inner.select("g", "pos", "path").join(outer, "g").select("g", "pos", "subroot", "root", F.concat("path", "outer").alias("path"))
    joined = blocks.select("g", "pos", "packed").join(above, ["g", "pos"])

    def unfold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                table = read_table(row["packed"])
                tree = _tree(table, fan, levels)
                upper = [(x["at"], [h.hex().encode() for h in x["run"]]) for x in row["path"]]
                upper_proof = [h.decode() for _, run in upper for h in run]
                proofs, copies, folded = [], [], []
                for i, changed in enumerate(table.column("changed").to_pylist()):
                    proofs.append([h.decode() for _, run in tree.path(i) for h in run] + upper_proof)
                    own = tree.version(i, tree.levels[0][i] if changed is None else changed.hex().encode())
                    own += climbed(own[-1], upper)[1:]
                    folded.append(own[-1].decode())
                    copies.append(None if changed is None else [h.decode() for h in own])
                n = table.num_rows
                yield pa.RecordBatch.from_arrays(
                    [table.column("id").combine_chunks(), pa.array([h.decode() for h in tree.levels[0]], pa.string()), pa.array([row["subroot"].hex()] * n, pa.string()),
                     pa.array([row["root"].hex()] * n, pa.string()), pa.array(proofs, pa.list_(pa.string())), pa.array(copies, pa.list_(pa.string())),
                     pa.array(folded, pa.string())], names=[id_col, "leaf", "subroot", "root", "proof", "copied", "folded_root"])
                del table, tree, proofs, copies
                release()

    return joined.mapInArrow(unfold, f"{id_col} long, leaf string, subroot string, root string, proof array<string>, copied array<string>, folded_root string")


def document_leaves(docs: DataFrame) -> DataFrame:
    """Rows for ``manifest``: the leaf of every document, and its leaf with A-Z of the text lower-cased where 3 divides the
    crc32 of its id."""
    d = pick(docs, doc_id="long", source="string", lang="string", n_chars="long", text="string")
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    return d.select("doc_id", "lang", leaf_hash(*fields, F.col("text")).alias("leaf"),
                    F.when(hit, leaf_hash(*fields, F.translate("text", UPPER, LOWER))).alias("changed"))
