"""N-gram Jaccard self-join by signature trees: which texts share at least `threshold` of their word n-grams.

1. Every text becomes the set of its distinct word n-grams, as 64-bit hashes. Equal sets are one class.
2. Two sets can only reach the threshold if the first floor((1 - t) * n) + 1 grams of both, in a common
   order, share one. The order puts frequent grams last, so passages that many texts share don't gather them.
   Classes with a gram in common form a block; blocks with the same members are one.
3. In each block a signature tree is built: leaves are bitmaps of the sets, inner nodes hold the OR of their
   children, the range of set sizes and the largest number of grams that fell on a taken bit. The tree is
   joined with itself from the root down. A pair of nodes goes when its sizes can't match or its largest
   possible overlap is too small, or when all below it is connected already. What remains are links that
   may hold: their components, the families, contain every true link.
4. In each family the true links are found on the whole sets.

Blocks and families larger than a task's limit are cut into parts. All parts see the same pivots, so what
is similar becomes connected across parts; the few members outside a group's largest component then meet
every part, so a block of members that are mostly unlike each other is compared pair by pair, in many tasks. Work on
members that are alike is in proportion to their number, and no link between components is lost.

Only bounded data reach the driver: the most frequent grams, `most_hot` at most, which only affect the order,
and a bitmap of fixed size that tells which texts are read a third time.

Defined cases. A null text, or one without words, has the empty set and is linked with nothing: its
component is its own doc_id. A text with fewer words than n has one gram, all its words. Repeated rows
are in one class and each gives a row. An empty table gives no rows. Other columns are not read.
Two different grams have equal hashes with a chance of 2^-64.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from llm.common import Scratch, most_frequent, steps
from llm.components import components
from llm.text import gram_hashes, short_hash, words

#: Grams gathered in a task before repeated ones are counted.
WINDOW = 4_000_000
FAN_OUT = 8
_FILTER_BITS = 23


def gram_sets(texts: pa.Array, width: int) -> list[np.ndarray]:
    """The sorted distinct gram hashes of every text."""
    found = words(texts)
    hashes = found.hashes()
    grams = gram_hashes(hashes, width) if len(hashes) else hashes
    out = []
    for a, b in zip(found.first.tolist(), found.first[1:].tolist(), strict=False):
        if b - a >= width:
            out.append(np.unique(grams[a : b - width + 1]))
        else:
            out.append(np.array([short_hash(hashes[a:b])] if b > a else [], np.uint64))
    return out


def class_of(grams: np.ndarray) -> int:
    return int(np.uint64(xxhash.xxh3_64_intdigest(grams.tobytes())).astype(np.int64))


def signature_bits(n: int) -> int:
    """Bits of a set's bitmap: the power of two from 2n on, 64 at least."""
    return max(64, 1 << (2 * n - 1).bit_length())


def signature(grams: np.ndarray) -> np.ndarray:
    bits = signature_bits(len(grams))
    at = (grams & np.uint64(bits - 1)).astype(np.int64)
    flags = np.zeros(bits, np.uint8)
    flags[at] = 1
    return np.packbits(flags, bitorder="little").view(np.uint64)


# --- which grams are frequent ------------------------------------------------------------------------


def hot_grams(docs: DataFrame, scratch: Scratch, width: int, least: int, most_hot: int) -> tuple[np.ndarray, np.ndarray]:
    """Grams that repeat within tasks and `least` times in all, sorted, with their counts."""

    def repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0

        def counted() -> pa.RecordBatch:
            grams, counts = np.unique(np.concatenate(held), return_counts=True)
            many = counts > 1
            return pa.RecordBatch.from_arrays(
                [pa.array(grams[many].view(np.int64)), pa.array(counts[many])], ["gram", "n"]
            )

        for batch in steps(batches):
            for s in gram_sets(batch.column("text"), width):
                held.append(s)
                n += len(s)
            if n > WINDOW:
                yield counted()
                held, n = [], 0
        if held:
            yield counted()

    counts = docs.select("text").mapInArrow(repeated, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    rows = most_frequent(scratch.table(counts.filter(F.col("n") >= least)), most_hot)
    grams = rows.column("gram").to_numpy().astype(np.int64).view(np.uint64)
    order = np.argsort(grams)
    return grams[order], rows.column("n").to_numpy().astype(np.int64)[order]


def prefix(grams: np.ndarray, hot: np.ndarray, counts: np.ndarray, threshold: Fraction) -> np.ndarray:
    """The grams of which two sets of the threshold's similarity share one: rare first, then by hash."""
    length = int((1 - threshold) * len(grams)) + 1
    if len(hot):
        at = np.minimum(np.searchsorted(hot, grams), len(hot) - 1)
        frequent = np.where(hot[at] == grams, counts[at], 0)
        if frequent.any():
            return grams[np.lexsort((grams, frequent))[:length]]
    return grams[:length]


def features(docs: DataFrame, width: int, threshold: Fraction, hot: np.ndarray, counts: np.ndarray) -> DataFrame:
    """doc_id, n_shingles, class; prefix and signature where the class is met first in a task."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in steps(batches):
            sets = gram_sets(batch.column("text"), width)
            classes = [class_of(s) for s in sets]
            prefixes, signatures = [], []
            for s, c in zip(sets, classes, strict=True):
                first = len(s) > 0 and c not in seen
                seen.add(c)
                prefixes.append(prefix(s, hot, counts, threshold).view(np.int64) if first else None)
                signatures.append(signature(s).tobytes() if first else None)
            if len(seen) > 1_000_000:
                seen.clear()
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(classes, pa.int64()),
                    pa.array(prefixes, pa.list_(pa.int64())),
                    pa.array(signatures, pa.binary()),
                ],
                ["doc_id", "n_shingles", "class", "prefix", "signature"],
            )

    schema = "doc_id long, n_shingles long, class long, prefix array<long>, signature binary"
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(make, schema)


# --- joining the members of a group ------------------------------------------------------------------


def groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The rows of each key, from batches sorted by the keys."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        change = np.zeros(batch.num_rows, bool)
        for c in columns:
            change[1:] |= c[1:] != c[:-1]
        first = tuple(c[0] for c in columns)
        change[0] = last is not None and first != last
        last = tuple(c[-1] for c in columns)
        begin = 0
        for at in np.flatnonzero(change).tolist():
            if at > begin:
                held.append(batch.slice(begin, at - begin))
            if held:
                yield pa.Table.from_batches(held)
            held, begin = [], at
        held.append(batch.slice(begin))
    if held:
        yield pa.Table.from_batches(held)


def needed(a: np.ndarray, b: np.ndarray, threshold: Fraction) -> np.ndarray:
    """The smallest overlap with which sizes a and b reach the threshold."""
    p, q = threshold.numerator, threshold.denominator
    return -((-p * (a + b)) // (p + q))


class SignatureTree:
    """Bitmaps of one width, leaves in order of set size."""

    def __init__(self, bitmaps: np.ndarray, sizes: np.ndarray):
        taken = sizes - np.bitwise_count(bitmaps).sum(axis=1).astype(np.int64)
        self.levels = [(bitmaps, sizes, sizes, taken)]
        while len(self.levels[-1][0]) > 1:
            bits, low, high, slack = self.levels[-1]
            at = np.arange(0, len(bits), FAN_OUT)
            self.levels.append(
                (
                    np.bitwise_or.reduceat(bits, at),
                    np.minimum.reduceat(low, at),
                    np.maximum.reduceat(high, at),
                    np.maximum.reduceat(slack, at),
                )
            )

    def may_link(self, level: int, a: np.ndarray, b: np.ndarray, threshold: Fraction) -> np.ndarray:
        """Whether sets below the nodes a and b can reach the threshold."""
        bits, low, high, slack = self.levels[level]
        p, q = threshold.numerator, threshold.denominator
        ok = (high[b] * q >= low[a] * p) & (high[a] * q >= low[b] * p)
        at = np.flatnonzero(ok)
        step = max(1, (8 << 20) // bits[0].nbytes)
        for i in range(0, len(at), step):
            k = at[i : i + step]
            x, y = a[k], b[k]
            most = np.bitwise_count(bits[x] & bits[y]).sum(axis=1) + np.minimum(slack[x], slack[y])
            ok[k] = most >= needed(low[x], low[y], threshold)
        return ok


def candidate_forest(sizes: np.ndarray, signatures: list[np.ndarray], threshold: Fraction) -> list[tuple[int, int]]:
    """Pairs that connect whatever the bitmaps can't keep apart, no more than members less one."""
    label = np.arange(len(sizes))
    edges: list[tuple[int, int]] = []

    def unite(i: int, others: np.ndarray) -> None:
        """Link i with one member of each component among the others, and give all of these its label at once."""
        met, at = np.unique(label[others], return_index=True)
        new = met != label[i]
        if new.any():
            edges.extend((i, j) for j in others[at[new]].tolist())
            label[np.isin(label, met[new])] = label[i]

    width = np.array([len(s) for s in signatures])
    for w in np.unique(width).tolist():
        own = np.flatnonzero((width == w) | (width == 2 * w))
        own = own[np.argsort(sizes[own], kind="stable")]
        if len(own) < 2:
            continue
        # A wider bitmap is folded: its halves hold the same low bits of the hashes.
        bitmaps = np.stack([s if len(s) == w else s[:w] | s[w:] for s in (signatures[i] for i in own)])
        wide = width[own] > w
        tree = SignatureTree(bitmaps, sizes[own])
        for i in range(min(2, len(own))):  # pivots: in a block of near copies they connect almost all
            rest = np.flatnonzero(label[own] != label[own[i]])
            rest = rest[~(wide[rest] & wide[i])]
            ok = tree.may_link(0, np.full(len(rest), i), rest, threshold)
            unite(int(own[i]), own[rest[ok]])
        _join_tree(tree, own, wide, label, threshold, unite)
    return edges


def _join_tree(tree: SignatureTree, own: np.ndarray, wide: np.ndarray, label: np.ndarray, threshold: Fraction, unite: Callable) -> None:
    """The dual traversal, depth first over portions of the pairs of nodes."""
    top = len(tree.levels) - 1
    same = [label[own]]  # for each node, the label of all below it, or -1
    for level in range(top):
        at = np.arange(0, len(same[level]), FAN_OUT)
        low, high = np.minimum.reduceat(same[level], at), np.maximum.reduceat(same[level], at)
        same.append(np.where(low == high, low, -1))
    stack = [(top, np.zeros(1, np.int64), np.zeros(1, np.int64))]
    while stack:
        level, a, b = stack.pop()
        if level == 0:
            keep = (a < b) & ~(wide[a] & wide[b]) & (label[own[a]] != label[own[b]])
            a, b = a[keep], b[keep]
            if len(a) > 4096:
                half = len(a) // 2
                stack += [(0, a[half:], b[half:]), (0, a[:half], b[:half])]
                continue
            ok = tree.may_link(0, a, b, threshold)
            order = np.argsort(a[ok], kind="stable")
            a, b = a[ok][order], b[ok][order]
            edge = np.flatnonzero(np.diff(a, prepend=-1, append=-1))
            for i, j in zip(edge, edge[1:], strict=False):
                unite(int(own[a[i]]), own[b[i:j]])
            continue
        keep = ~((same[level][a] >= 0) & (same[level][a] == same[level][b]))
        a, b = a[keep], b[keep]
        ok = tree.may_link(level, a, b, threshold)
        a, b = a[ok], b[ok]
        below = len(tree.levels[level - 1][0])
        for i in range(0, len(a), 1024):
            x = (a[i : i + 1024, None, None] * FAN_OUT + np.arange(FAN_OUT)[None, :, None]) + np.zeros((1, 1, FAN_OUT), np.int64)
            y = (b[i : i + 1024, None, None] * FAN_OUT + np.arange(FAN_OUT)[None, None, :]) + np.zeros((1, FAN_OUT, 1), np.int64)
            x, y = x.ravel().astype(np.int64), y.ravel().astype(np.int64)
            inside = (x < below) & (y < below) & (x <= y)
            stack.append((level - 1, x[inside], y[inside]))


def true_forest(sets: list[np.ndarray], threshold: Fraction) -> list[tuple[int, int]]:
    """Pairs that reach the threshold and connect what true links connect.

    From each member reached, its overlaps with all that are not yet reached are counted at once: over the members
    that share a gram with it if these are few, else over all.
    """
    sizes = np.array([len(s) for s in sets], np.int64)
    owner = np.repeat(np.arange(len(sets)), sizes)
    grams, gram = np.unique(np.concatenate(sets), return_inverse=True)
    start = np.cumsum(sizes) - sizes
    order = np.argsort(gram, kind="stable")
    posted = owner[order]
    first = np.searchsorted(gram[order], np.arange(len(grams) + 1))
    reached = np.zeros(len(sets), bool)
    left = at_last = len(sets)
    edges = []
    for seed in range(len(sets)):
        if reached[seed]:
            continue
        queue, reached[seed] = [seed], True
        left -= 1
        while queue and left:
            x = queue.pop()
            if 2 * left < at_last:  # drop those reached from the lists
                live = ~reached[posted]
                kept = np.concatenate([[0], np.cumsum(live)])
                posted, first, at_last = posted[live], kept[first], left
            own = gram[start[x] : start[x] + sizes[x]]
            n = first[own + 1] - first[own]
            at = np.repeat(first[own] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            met = posted[at]
            met = met[~reached[met]]
            if 16 * len(met) < len(sets):
                other, shared = np.unique(met, return_counts=True)
            else:
                shared = np.bincount(met, minlength=len(sets))
                other = np.flatnonzero(shared)
                shared = shared[other]
            new = other[shared >= needed(sizes[x], sizes[other], threshold)]
            reached[new] = True
            left -= len(new)
            edges += [(x, int(y)) for y in new]
            queue += new.tolist()
    return edges


def link_groups(members: DataFrame, loads: DataFrame, kernel: Callable, scratch: Scratch, limit: int, pivots: int = 32) -> DataFrame:
    """Edges a, b between classes, from members (group, class) and loads (class, n, load), joined by the kernel.

    kernel(sizes, loads) gives pairs of positions. limit: bytes of load in one task.
    """
    weighed = members.join(loads.select("class", F.octet_length("load").alias("bytes")), "class")
    sizes = weighed.groupBy("group").agg(F.sum("bytes").alias("total"), F.count("*").alias("members"))
    sizes = scratch.table(
        sizes.filter("members > 1").select("group", F.ceil(F.col("total") / limit).cast("int").alias("parts"))
    )
    part = F.pmod(F.xxhash64("class"), F.col("parts")).cast("int")
    parted = weighed.join(sizes, "group").withColumn("part", part)

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = [], []
        for table in groups(batches, ["group", "part", "with"]):
            classes = table.column("class").to_numpy()
            _, one = np.unique(classes, return_index=True)
            if len(one) < 2:
                continue
            loads = table.column("load").to_pylist()
            pairs = kernel(table.column("n").to_numpy()[one], [np.frombuffer(loads[i], np.uint64) for i in one])
            a += [classes[one[i]] for i, _ in pairs]
            b += [classes[one[j]] for _, j in pairs]
            if len(a) > 50_000:
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])
                a, b = [], []
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    def joined(tasks: DataFrame) -> DataFrame:
        keys = ["group", "part", "with"]
        tasks = tasks.select(*keys, "class").join(loads, "class")
        edges = tasks.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(join, "a long, b long")
        return scratch.table(edges.distinct())

    whole = parted.withColumn("with", F.lit(-1))
    large = sizes.filter("parts > 1")
    if large.isEmpty():
        return joined(whole)
    order = Window.partitionBy("group").orderBy(F.xxhash64("class", F.lit(1)), "class")
    large_members = parted.filter("parts > 1")
    pivot = large_members.withColumn("k", F.row_number().over(order)).filter(F.col("k") <= pivots)
    pivot = pivot.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).withColumn("with", F.lit(-1))
    columns = ["group", "part", "with", "class"]
    edges = joined(whole.select(*columns).unionByName(pivot.select(*columns)))
    # Members outside the largest component of their group meet every part.
    roots = components(edges, scratch)
    placed = large_members.join(roots.select(F.col("node").alias("class"), "root"), "class", "left")
    placed = scratch.table(
        placed.select("group", "class", "bytes", "parts", F.coalesce("root", "class").alias("root"))
    )
    main = placed.groupBy("group", "root").agg(F.count("*").alias("size"))
    main = main.groupBy("group").agg(F.max(F.struct("size", "root")).alias("x")).select("group", F.col("x.root").alias("main"))
    outside = placed.join(main, "group").filter("root <> main")
    turns = outside.groupBy("group").agg(F.ceil(F.sum("bytes") / limit).cast("int").alias("turns"))
    turn = F.pmod(F.xxhash64("class", F.lit(2)), F.col("turns")).cast("int")
    outside = scratch.table(
        outside.join(turns, "group").select("group", "class", "turns", "parts", turn.alias("with"))
    )
    every = large_members.join(outside.select("group", "turns").distinct(), "group")
    every = every.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("turns") - 1)))
    meet = outside.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    return edges.unionByName(joined(every.select(*columns).unionByName(meet.select(*columns))))


# --- the join ----------------------------------------------------------------------------------------


def _wanted(ids: DataFrame) -> np.ndarray:
    """A bitmap of fixed size in which every wanted doc_id has its bit set; a few others have it too."""
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << _FILTER_BITS)).cast("int")
    bits = ids.select(place.alias("place")).select(
        F.shiftright("place", 5).alias("word"), F.expr("shiftleft(1L, place & 31)").alias("bit")
    )
    bitmap = np.zeros(1 << (_FILTER_BITS - 5), np.int64)
    found = bits.groupBy("word").agg(F.bit_or("bit").alias("bit")).toArrow()
    bitmap[found.column("word").to_numpy()] = found.column("bit").to_numpy()
    return bitmap


def sets_of(docs: DataFrame, classes: DataFrame, width: int) -> DataFrame:
    """class, n and load, the whole set, for classes (class, doc_id of one text that has it)."""
    bitmap = _wanted(classes)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = batch.column("place").to_numpy()
            keep = (bitmap[place >> 5] >> (place & 31)) & 1
            for step in steps([batch.filter(pa.array(keep.astype(bool)))]):
                sets = [s for s in gram_sets(step.column("text"), width) if len(s)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([class_of(s) for s in sets], pa.int64()),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([s.tobytes() for s in sets], pa.binary()),
                    ],
                    ["class", "n", "load"],
                )

    place = F.pmod(F.xxhash64(F.col("doc_id").cast("long")), F.lit(1 << _FILTER_BITS)).cast("int")
    sets = docs.select("text", place.alias("place")).mapInArrow(make, "class long, n long, load binary")
    return sets.join(classes.select("class"), "class", "left_semi").dropDuplicates(["class"])


def jaccard_components(
    docs: DataFrame,
    scratch: Scratch,
    width: int = 5,
    threshold: Fraction = Fraction(3, 4),
    least_hot: int = 20,
    most_hot: int = 1 << 20,
    block_bytes: int = 4 << 20,
    family_bytes: int = 32 << 20,
) -> DataFrame:
    """doc_id, n_shingles, component_id, class_id: the smallest doc_id linked, and with the same set."""
    hot, counts = hot_grams(docs, scratch, width, least_hot, most_hot)
    found = scratch.table(features(docs, width, threshold, hot, counts))

    entries = found.filter(F.col("prefix").isNotNull()).select("class", F.explode("prefix").alias("gram"))
    # Counted in tasks before the shuffle: a gram of a third of all texts is no window over all of them.
    several = entries.groupBy("gram").agg(F.min("class").alias("low"), F.max("class").alias("high")).filter("low <> high")
    shared = scratch.table(entries.join(several.select("gram"), "gram", "left_semi").distinct())
    alike = shared.groupBy("gram").agg(
        F.count("*").alias("members"),
        F.bit_xor(F.xxhash64("class")).alias("x"),
        F.bit_xor(F.xxhash64("class", F.lit(7))).alias("y"),
    )
    blocks = alike.groupBy("members", "x", "y").agg(F.min("gram").alias("gram")).select("gram")
    members = shared.join(blocks, "gram").select(F.col("gram").alias("group"), "class")
    signatures = found.filter(F.col("signature").isNotNull()).dropDuplicates(["class"])
    signatures = signatures.select("class", F.col("n_shingles").alias("n"), F.col("signature").alias("load"))
    candidates = link_groups(
        scratch.table(members), scratch.table(signatures), lambda n, s: candidate_forest(n, s, threshold), scratch, block_bytes
    )

    families = scratch.table(components(candidates, scratch).select(F.col("node").alias("class"), F.col("root").alias("group")))
    one = found.filter(F.col("prefix").isNotNull()).join(families, "class").groupBy("class").agg(F.min("doc_id").alias("doc_id"))
    sets = scratch.table(sets_of(docs, scratch.table(one), width))
    links = link_groups(families, sets, lambda n, s: true_forest(s, threshold), scratch, family_bytes)

    roots = components(links, scratch).select(F.col("node").alias("class"), "root")
    classes = found.filter("n_shingles > 0").groupBy("class").agg(F.min("doc_id").alias("class_id"))
    classes = scratch.table(classes.join(roots, "class", "left").withColumn("root", F.coalesce("root", "class")))
    least = classes.groupBy("root").agg(F.min("class_id").alias("component_id"))
    placed = classes.join(least, "root").select("class", "class_id", "component_id")
    alone = F.col("n_shingles") == 0
    return found.join(placed, "class", "left").select(
        "doc_id",
        "n_shingles",
        F.when(alone, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        F.when(alone, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
    )
