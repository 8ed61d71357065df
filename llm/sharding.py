"""Sharding by a consistent-hash ring with virtual nodes and bounded loads.

The ring has `cells` equal cells. Every shard owns `virtual_nodes` of them as virtual nodes. A row's id
hashes to a cell and belongs to the first virtual node at or after it, clockwise. A shard takes rows up to
its capacity, floor or ceiling of rows / shards; what overflows continues clockwise to the next virtual
nodes whose shards have room. The capacities add up to the number of rows, so row counts differ by one at
most, and only overflowing rows leave their own shard.

The walk needs row counts by cell, at most `cells` numbers whatever the input. Rows then find their shard by
their rank within the cell.

Defined cases. A null text has size 1 and checksum 0, an empty one too. A null doc_id hashes like any
value. Repeated rows are different rows, each with its own slot. An empty table gives no rows.
Other columns are not read.
"""

from __future__ import annotations

import json
import zlib

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CELLS, VIRTUAL_NODES = 1 << 14, 128


def ring(shards: int, virtual_nodes: int = VIRTUAL_NODES, cells: int = CELLS) -> list[int | None]:
    """The shard whose virtual node lies in each cell, else None. A taken cell passes a node on clockwise.

    Nodes are placed one round after another, so another shard leaves the places of almost all others.
    """
    if shards * virtual_nodes > cells:
        raise ValueError("more virtual nodes than cells")
    at: list[int | None] = [None] * cells
    for node in range(virtual_nodes):
        for shard in range(shards):
            cell = zlib.crc32(f"{shard}/{node}".encode()) % cells
            while at[cell] is not None:
                cell = (cell + 1) % cells
            at[cell] = shard
    return at


def place_cells(counts: dict[int, int], shards: int, virtual_nodes: int = VIRTUAL_NODES, cells: int = CELLS) -> dict[int, list[tuple[int, int]]]:
    """For each cell, which shards take how many of its rows, in order.

    First every shard takes its own rows, clockwise, as far as its capacity goes; then what is left over
    walks on, clockwise too.
    """
    at = ring(shards, virtual_nodes, cells)
    total = sum(counts.values())
    room = [total // shards + (s < total % shards) for s in range(shards)]
    nodes = [c for c in range(cells) if at[c] is not None]
    after, k = {}, 0  # the index in nodes of the first node at or after a cell
    for cell in range(cells):
        while k < len(nodes) and nodes[k] < cell:
            k += 1
        after[cell] = k % len(nodes)
    placed: dict[int, list[tuple[int, int]]] = {}
    left = []
    for cell in sorted(counts):
        shard = at[nodes[after[cell]]]
        own = min(counts[cell], room[shard])
        room[shard] -= own
        placed[cell] = [(shard, own)] if own else []
        if counts[cell] > own:
            left.append((cell, counts[cell] - own))
    for cell, rows in left:
        step = after[cell]
        while rows:
            step = (step + 1) % len(nodes)
            shard = at[nodes[step]]
            taken = min(rows, room[shard])
            if taken:
                room[shard] -= taken
                rows -= taken
                placed[cell].append((shard, taken))
    return placed


def cell_of(doc_id: Column, cells: int = CELLS) -> Column:
    return F.pmod(F.xxhash64(doc_id), F.lit(cells)).cast("int")


def assign_shards(docs: DataFrame, shards: int = 16, virtual_nodes: int = VIRTUAL_NODES, cells: int = CELLS) -> DataFrame:
    """doc_id, size, text_crc32, home shard, shard and slot of every row."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        cell_of(F.col("doc_id"), cells).alias("cell"),
    )
    counts = {r["cell"]: r["n"] for r in docs.select(cell_of(F.col("doc_id"), cells).alias("cell")).groupBy("cell").agg(F.count("*").alias("n")).collect()}
    at = ring(shards, virtual_nodes, cells)
    homes, home = {}, next((s for s in at if s is not None), 0)
    for cell in range(cells - 1, -1, -1):
        home = at[cell] if at[cell] is not None else home
        homes[cell] = home
    filled = [0] * shards
    plan = []
    for cell, parts in sorted(place_cells(counts, shards, virtual_nodes, cells).items()):
        begin, shares = 0, []
        for shard, n in parts:
            shares.append({"upto": begin + n, "shard": shard, "shift": filled[shard] - begin})
            filled[shard] += n
            begin += n
        plan.append({"cell": cell, "home": homes[cell], "shares": shares})
    schema = "array<struct<cell:int,home:int,shares:array<struct<upto:long,shard:int,shift:long>>>>"
    table = docs.sparkSession.range(1).select(F.inline(F.from_json(F.lit(json.dumps(plan)), schema)))
    rank = F.row_number().over(Window.partitionBy("cell").orderBy("doc_id", "text_crc32", "size")).cast("long") - 1
    # At most `cells` rows, so this side can be sent to every task.
    found = rows.withColumn("rank", rank).join(F.broadcast(table), "cell")
    share = F.filter("shares", lambda s: F.col("rank") < s["upto"])[0]
    return found.withColumn("share", share).select(
        "doc_id",
        "size",
        "text_crc32",
        "home",
        F.col("share.shard").alias("shard"),
        (F.col("rank") + F.col("share.shift")).alias("slot"),
    )
