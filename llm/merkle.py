"""Merkle manifest of a dataset: one tree a group, one tree over the groups, and a proof for every row.

Leaves of a group stand in order of their key; every `fan` consecutive nodes (the last run: fewer, even one)
become their hash, until one is left, the group's subroot. Subroots in order of their groups are the leaves of
the tree on top.

Checkpoint and recompute: of all levels only every `every`-th is written. The nodes of a stored level fall into
blocks of fan ** every, aligned subtrees below one node of the next stored level. Writing goes up: each block
is hashed to its top node. Proofs go down: a block is regenerated from its stored nodes, every one of these
gets its siblings in the block and the proof of the block's top node behind them, and the nodes in between are
discarded. A task holds one block and the proof of its top at a time, so a hot group is just many blocks.

Defined cases. Null groups come first and are a group of their own; null keys come first in a group. Rows with
the same group and key stand in order of their digests, equal ones in any order, which gives the same tree. An
empty table gives no rows and has no root. Other columns are kept if they are named as `keep`, whatever they are
called, and not read otherwise.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from llm.common import Scratch

#: Nodes of a run, levels from one checkpoint to the next.
FAN, EVERY = 3, 6
_STEP = pa.struct([("left", pa.string()), ("right", pa.string())])
_PROOF = "array<struct<left:string,right:string>>"


def field(column: Column, kind: str) -> Column:
    """A value as it goes into a leaf: `-` for null, else its length in UTF-8 bytes, a colon and itself."""
    text = column if kind == "string" else column.cast("string")
    return F.when(column.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(df: DataFrame, columns: Sequence[str], replaced: dict[str, Column] | None = None) -> Column:
    """The hash of a row's columns, some of them replaced."""
    kinds = dict(df.dtypes)
    values = {c: df[c] for c in columns} | (replaced or {})
    return F.sha2(F.concat(*[field(values[c], kinds[c]) for c in columns]), 256)


def folded(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and its proof lead to."""
    step = lambda digest, s: F.sha2(F.concat(s["left"], digest, s["right"]), 256)
    return F.aggregate(proof, leaf, step)


def siblings(proof: Column) -> Column:
    """All digests of a proof, level by level, left to right, as one text."""
    return F.array_join(F.transform(proof, lambda s: F.concat(s["left"], s["right"])), "")


def _hashed(nodes: list[str], fan: int) -> list[str]:
    return [
        hashlib.sha256("".join(nodes[i : i + fan]).encode("ascii")).hexdigest() for i in range(0, len(nodes), fan)
    ]


def _subtree(nodes: list[str], total: int, fan: int, every: int) -> list[list[str]]:
    """The levels of a block from its nodes up to its top; total: nodes of the whole group on the block's level."""
    levels = [nodes]
    whole = total <= fan**every  # the only block of its group ends with the group's subroot
    while len(levels[-1]) > 1 if whole else len(levels) <= every:
        levels.append(_hashed(levels[-1], fan))
    return levels


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of each (group, block), which come next to each other."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        # Group is never null here.
        groups, blocks = batch.column("group").to_pylist(), batch.column("block").to_numpy(zero_copy_only=False)
        codes = batch.column("group").dictionary_encode().indices.to_numpy()
        cut = 1 + np.flatnonzero((blocks[1:] != blocks[:-1]) | (codes[1:] != codes[:-1]))
        edges = [0, *cut.tolist(), batch.num_rows]
        for a, b in zip(edges, edges[1:], strict=False):
            key = (groups[a], int(blocks[a]))
            if held and key != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
            last = key
    if held:
        yield pa.Table.from_batches(held)


@dataclass(frozen=True)
class Tree:
    """The stored levels of the trees of all groups: (group, pos, n, digest), n nodes a group on that level."""

    scratch: Scratch
    levels: list[DataFrame]
    fan: int
    every: int

    @property
    def block(self) -> int:
        return self.fan**self.every

    def tops(self) -> DataFrame:
        """(group, digest) of every group."""
        return _all([level.filter("n = 1").select("group", "digest") for level in self.levels])

    def _ordered(self, rows: DataFrame) -> DataFrame:
        return rows.repartition("group", "block").sortWithinPartitions("group", "block", "pos")

    def proofs(self, above: DataFrame) -> DataFrame:
        """The lowest level's rows with their proofs; above: (group, subroot, root, proof) of the groups."""
        found = None
        for i in reversed(range(len(self.levels))):
            level = self.levels[i]
            done = level.filter("n = 1").join(above, "group").select(*level.columns, "subroot", "root", "proof")
            if found is None:
                found = done
                continue
            below = self._descend(level.filter("n > 1"), found)
            found = done.unionByName(below)
            if i:
                found = self.scratch.table(found)
        return found

    def _descend(self, nodes: DataFrame, parents: DataFrame) -> DataFrame:
        """Every node with the siblings up to its block's top and the proof from there on."""
        fan, every, size = self.fan, self.every, self.block
        heads = parents.select("group", F.col("pos").alias("block"), "subroot", "root", "proof")
        own = nodes.withColumn("block", F.expr(f"pos div {size}"))
        rows = own.unionByName(heads, allowMissingColumns=True)  # a head has a null pos, so it comes first
        columns = nodes.columns
        out = T.StructType(list(rows.schema)[: len(columns)]).add("subroot", "string").add("root", "string")
        out = out.add("proof", rows.schema["proof"].dataType)

        def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for held in _blocks(batches):
                head, rest = held.slice(0, 1), held.slice(1)
                above = head.column("proof")[0].as_py()
                tail = [[s["left"] for s in above], [s["right"] for s in above]]
                levels = _subtree(rest.column("digest").to_pylist(), rest.column("n")[0].as_py(), fan, every)
                sides: list[list[str]] = [[], []]
                for i in range(rest.num_rows):
                    for nodes_ in levels[:-1]:
                        first = i - i % fan
                        sides[0].append("".join(nodes_[first:i]))
                        sides[1].append("".join(nodes_[i + 1 : first + fan]))
                        i //= fan
                    sides[0] += tail[0]
                    sides[1] += tail[1]
                length = len(levels) - 1 + len(above)
                steps = pa.StructArray.from_arrays([pa.array(s, pa.string()) for s in sides], fields=list(_STEP))
                offsets = pa.array(np.arange(rest.num_rows + 1, dtype=np.int32) * length)
                arrays = [rest.column(c).combine_chunks() for c in columns]
                arrays += [pa.repeat(head.column(c)[0], rest.num_rows) for c in ("subroot", "root")]
                arrays.append(pa.ListArray.from_arrays(offsets, steps))
                yield pa.RecordBatch.from_arrays(arrays, [*columns, "subroot", "root", "proof"])

        return self._ordered(rows).mapInArrow(emit, out)


def _all(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for df in frames[1:]:
        out = out.unionByName(df)
    return out


def _placed(rows: DataFrame, scratch: Scratch, tasks: int) -> DataFrame:
    """rows (group, key, digest, ...) with pos, the place in the group, and n, the group's size.

    Rows are dealt by ranges and numbered within a task; the counts of the tasks before give the rest.
    """
    order = ("group", F.col("key").asc_nulls_first(), "digest")
    dealt = rows.repartitionByRange(tasks, *order).sortWithinPartitions(*order)
    kind = T.StructType(list(dealt.schema)).add("part", "integer").add("local", "long")

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, seen = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            groups = batch.column("group")
            codes = groups.dictionary_encode().indices.to_numpy()
            starts = np.concatenate([[0], 1 + np.flatnonzero(codes[1:] != codes[:-1])])
            local = np.arange(len(codes)) - np.repeat(starts, np.diff([*starts, len(codes)]))
            if groups[0].as_py() == last:
                first = int(starts[1]) if len(starts) > 1 else len(codes)
                local[:first] += seen
            last, seen = groups[len(codes) - 1].as_py(), int(local[-1]) + 1
            extra = [pa.array(np.full(len(codes), part, np.int32)), pa.array(local)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *extra], [*batch.schema.names, "part", "local"])

    rows = scratch.table(dealt.mapInArrow(number, kind))
    # One row for each group and range that holds rows of it: as many as groups and ranges together, at most.
    held = rows.groupBy("group", "part").agg(F.count("*").alias("held"))
    group = Window.partitionBy("group")
    before = F.sum("held").over(group.orderBy("part")) - F.col("held")
    held = held.select("group", "part", before.alias("before"), F.sum("held").over(group).alias("n"))
    return rows.join(held, ["group", "part"]).withColumn("pos", F.col("before") + F.col("local")).drop(
        "part", "local", "before", "key"
    )


def build(rows: DataFrame, scratch: Scratch, fan: int = FAN, every: int = EVERY, per_task: int = 100_000) -> Tree:
    """The trees of all groups of rows (group, key, digest, ...), stored level by level.

    group must not be null; per_task: leaves in a task. Further columns stay with the lowest level.
    """
    rows = scratch.table(rows)
    tasks = max(1, -(-rows.count() // per_task))
    levels = [scratch.table(_placed(rows, scratch, tasks))]
    size = fan**every
    most = levels[0].agg(F.max("n")).first()[0] or 0

    def rise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in _blocks(batches):
            total = held.column("n")[0].as_py()
            top = _subtree(held.column("digest").to_pylist(), total, fan, every)[-1][0]
            row = [[held.column("group")[0].as_py()], [held.column("block")[0].as_py()], [-(-total // size)], [top]]
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, k) for v, k in zip(row, kinds, strict=True)], ["group", "pos", "n", "digest"]
            )

    tree = Tree(scratch, levels, fan, every)
    while most > 1:
        nodes = levels[-1].filter("n > 1").select("group", F.expr(f"pos div {size}").alias("block"), "pos", "n", "digest")
        levels.append(scratch.table(tree._ordered(nodes).mapInArrow(rise, "group string, pos long, n long, digest string")))
        most = -(-most // size)
    return tree


@dataclass(frozen=True)
class Manifest:
    """The trees of all groups and the tree over them."""

    groups: Tree
    top: Tree

    def root(self) -> DataFrame:
        """One row, none for an empty dataset."""
        return self.top.tops().select(F.col("digest").alias("root"))

    def subroots(self) -> DataFrame:
        return self.top.levels[0].select(F.expr("substring(name, 2)").alias("group"), F.col("digest").alias("subroot"))

    def proofs(self) -> DataFrame:
        """Every row's kept columns with leaf, subroot, root and proof, an array of (left, right) from the leaf up.

        left and right are the digests beside the node in its run, joined; without any they are empty.
        """
        no_steps = F.expr(f"cast(array() AS {_PROOF})")
        root = self.top.tops().select("group", F.col("digest").alias("subroot"), F.col("digest").alias("root"), no_steps.alias("proof"))
        above = self.top.proofs(root).select(
            F.col("name").alias("group"), F.col("digest").alias("subroot"), "root", "proof"
        )
        above = self.groups.scratch.table(above)
        return self.groups.proofs(above).select(
            "kept.*", F.col("digest").alias("leaf"), "subroot", "root", "proof"
        )


def manifest(
    rows: DataFrame,
    scratch: Scratch,
    group: str,
    key: str,
    leaf: Column,
    keep: dict[str, Column],
    fan: int = FAN,
    every: int = EVERY,
    per_task: int = 100_000,
) -> Manifest:
    """The manifest of rows whose leaves are the column `leaf`; `keep`: what proofs carry of a row, by name."""
    name = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit(""))  # a null sorts first
    kept = F.struct(*[c.alias(n) for n, c in keep.items()])
    leaves = rows.select(name.alias("group"), F.col(key).alias("key"), leaf.alias("digest"), kept.alias("kept"))
    groups = build(leaves, scratch, fan, every, per_task)
    tops = groups.tops().select(
        F.lit("").alias("group"), F.col("group").alias("key"), "digest", F.col("group").alias("name")
    )
    return Manifest(groups, build(tops, scratch, fan, every, per_task))
