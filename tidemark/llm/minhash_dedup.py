"""Near-duplicate documents by a MinHash LSH forest.

A document is the set of its distinct word shingles. Every tree of the forest sorts the
documents by its own sequence of minimum hashes; documents with a long common prefix are
candidates. The depth adapts to the region: a prefix of ``depths[0]`` values is enough
where up to ``grid`` documents share it, and only a larger region is cut by longer prefixes, the
last of any size. So that no document of a region that was cut is left with a longer prefix that
few others have, all of them also meet their neighbours in the region's sorted order, in
overlapping stretches. A region of more than ``region`` documents is walked in sorted order, each
document against its neighbours, and whatever that leaves unlinked is compared with the
whole region in the second round.

Documents with equal sets are folded first. Round one takes from each region the edges of
a spanning forest of greatest estimated similarity. Round two brings the full sets of a
region that still holds several components into one task and tries every remaining pair
there, each in the first tree whose row the two share, so no pair of rows is ever emitted
but for links that join components. Regions too large for one task come in a grid of
blocks: a share of all rows meets a share of those outside the main component. A pair is
left out on the estimate of all minimum hashes only when that is more than ``errors`` standard
errors below the threshold, and every link is confirmed on the full sets of both texts.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import connected_components, per_key, saved, whole_groups
from .shingles import mixed, shingle_sets

#: Depths at which a region may be cut.
DEPTHS = (3, 5)
#: Hashes of a tree.
WIDTH = 8
TREES = 20


def _family(n: int) -> np.ndarray:
    rng = np.random.RandomState(11)
    return (rng.randint(0, 2**31, n, dtype=np.int64).astype(np.uint32) << np.uint32(1)) | np.uint32(1)


def signature(shingles: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """The lower 16 bits of the minimum of each of ``len(factors)`` hashes over the set."""
    low = np.full(len(factors), np.uint32(2**32 - 1))
    h = (shingles >> np.uint64(32)).astype(np.uint32)
    for k in range(0, len(h), 4096):
        x = h[k : k + 4096] * factors[:, None]
        x ^= x >> np.uint32(15)
        x *= np.uint32(0x2C1B3C6D)
        low = np.minimum(low, x.min(axis=1))
    return low.astype(np.uint16)


def _prefix(sig: np.ndarray, depth: int) -> np.ndarray:
    """For rows of (trees, hashes) one value for each tree and row that names the first ``depth`` hashes."""
    out = np.full(sig.shape[:2], np.uint64(depth))
    for d in range(depth):
        out = mixed(out * np.uint64(0x9E3779B97F4A7C15) + sig[:, :, d].astype(np.uint64))
    return out.view(np.int64)


def least_equal(n: int, percent: int, errors: float) -> int:
    """Of ``n`` hashes so many are equal at least, unless the estimate is over ``errors`` standard errors below the threshold."""
    p = percent / 100
    return max(0, math.floor(n * p - errors * math.sqrt(n * p * (1 - p))))


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, percent: int = 80, trees: int = TREES, depths: tuple[int, ...] = DEPTHS, width: int = WIDTH, region: int = 64, grid: int = 4096, errors: float = 5.0) -> DataFrame:
    """One row per document: id, n_shingles, component_id, kept.

    Ids are whole numbers (or cast to them; others fail the job).
    Documents link when ``100 * |A & B| >= percent * |A | B|`` of their shingle sets; a component is
    all that is reachable. A null text, or one without words, has an empty set and links
    with nothing. Repeated ids are separate rows. A row with a null id takes part; a
    component of only such rows has a null component_id and is not kept. Other columns are
    ignored. An empty table gives an empty result.
    """
    factors = _family(trees * width)
    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(0, b.num_rows, 1000):
                part = b.slice(k, 1000)
                sets = shingle_sets(part.column("text"), shingle)
                names = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
                sigs = [signature(s, factors).tobytes() if len(s) else None for s in sets]
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array([len(s) for s in sets], pa.int64()), pa.array(names, pa.binary()), pa.array(sigs, pa.binary())], ["id", "n", "node", "sig"])

    rows = saved(source.mapInArrow(sketch, "id bigint, n bigint, node binary, sig binary"))
    # One signature for each distinct set: equal sets have equal signatures.
    distinct = saved(rows.where("node is not null").groupBy("node").agg(F.min("id").alias("id"), F.first("sig").alias("sig")))

    names = [f"k{d}" for d in depths]

    def plant(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(0, b.num_rows, 2000):
                part = b.slice(k, 2000)
                sig = np.frombuffer(b"".join(part.column("sig").to_pylist()), np.uint16).reshape(part.num_rows, trees, width)
                keys = [_prefix(sig, d).ravel() for d in depths]
                node = part.column("node").take(pa.array(np.repeat(np.arange(part.num_rows), trees)))
                tree = np.tile(np.arange(trees, dtype=np.int32), part.num_rows)
                yield pa.RecordBatch.from_arrays([node, pa.array(tree), *map(pa.array, keys)], ["node", "tree", *names])

    open_rows = distinct.select("node", "sig").mapInArrow(plant, "node binary, tree int, " + ", ".join(f"{k} bigint" for k in names))

    def stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each row of sorted regions in two stretches of up to 128 rows, which overlap by half and are regions of their own."""
        at = TaskContext.get().partitionId() << 40
        for b in batches:
            pos = at + np.arange(b.num_rows)
            at += b.num_rows
            for k in (0, 1):
                # The key tells the region too, so a stretch ends with it; its depth is none of a tree's.
                key = mixed(b.column("key").to_numpy().view(np.uint64) + mixed((pos // 64 + k).astype(np.uint64) * np.uint64(2) + np.uint64(1)))
                yield pa.RecordBatch.from_arrays([b.column("node"), b.column("tree"), pa.array(np.full(b.num_rows, -1, np.int32)), pa.array(key.view(np.int64))], ["node", "tree", "depth", "key"])

    def neighbours(members: DataFrame) -> DataFrame:
        """The stretches of regions too large to be compared whole: rows with long common prefixes lie side by side."""
        part = members.join(distinct.select("node", "sig"), "node")
        part = part.withColumn("row", F.substring(F.col("sig"), F.col("tree") * (2 * width) + 1, F.lit(2 * width))).drop("sig")
        order = ["tree", "depth", "key", "row", "node"]
        part = part.repartitionByRange(*order).sortWithinPartitions(*order)
        return saved(part.select("node", "tree", "key").mapInArrow(stretches, "node binary, tree int, depth int, key bigint"))

    found, crowded = [], []
    for depth, name in zip(depths, names, strict=True):
        counts = per_key(open_rows, ["tree", name], F.count("*").alias("c")).where("c > 1")
        shared = saved(open_rows.join(counts, ["tree", name]).select("node", "tree", *names, "c"))
        members = shared.select("node", "tree", F.lit(depth).alias("depth"), F.col(name).alias("key"), "c")
        found.append(members.where(F.col("c") <= region).drop("c"))
        cut = (F.col("c") > max(region, grid)) & F.lit(depth != depths[-1])
        crowded.append(members.where((F.col("c") > region) & ~cut).drop("c"))
        if depth != depths[-1]:
            found.append(neighbours(members.where(cut).drop("c")))
            open_rows = shared.where(cut).drop("c")
    large = saved(reduce(DataFrame.union, crowded))
    small = reduce(DataFrame.union, found)
    least = least_equal(trees * width, percent, errors)

    def grouped(members: DataFrame, big: bool) -> DataFrame:
        """Members with signatures, regions together; a large one in stretches of its sorted order, dealt by ranges."""
        part = members.join(distinct.select("node", "sig"), "node")
        keys = ["tree", "depth", "key"]
        if big:
            order = [*keys, F.substring(F.col("sig"), F.col("tree") * (2 * width) + 1, F.lit(2 * width))]
            # The ranges are found from samples that reach the driver, so whole signatures only order the rows inside one.
            return part.repartitionByRange(*order, "node").sortWithinPartitions(*order, "sig", "node")
        return part.repartition(*keys).sortWithinPartitions(*keys, "sig", "node")

    def roots(n: int):
        """A union-find over 0..n-1: the function that joins two and says whether they were apart."""
        root = list(range(n))

        def top(x: int) -> int:
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        def join(x: int, y: int) -> bool:
            x, y = top(x), top(y)
            root[max(x, y)] = min(x, y)
            return x != y

        return top, join

    def alike(sig: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The pairs of rows that may reach the threshold, best estimate first."""
        like = np.concatenate([np.count_nonzero(sig[i] == sig[i + 1 :], axis=1) for i in range(len(sig) - 1)])
        a, b = np.triu_indices(len(sig), 1)
        order = np.argsort(-like, kind="stable")
        order = order[like[order] >= least]
        return a[order], b[order], like[order]

    def forests(walk: int):
        """Round one: a spanning forest of each region or, with ``walk``, of stretches of its sorted order."""

        def f(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            if walk:
                chunks = ((pa.Table.from_batches([x]), _stretches(x)) for b in batches for k in range(0, b.num_rows, walk) for x in [b.slice(k, walk)])
            else:
                chunks = whole_groups(batches, ["tree", "depth", "key"])
            for tab, bounds in chunks:
                node = tab.column("node").to_pylist()
                sig = np.frombuffer(b"".join(tab.column("sig").to_pylist()), np.uint16).reshape(len(node), -1)
                out: set[tuple[bytes, bytes]] = set()
                for lo, hi in zip(bounds[:-1], bounds[1:], strict=True):
                    if hi - lo < 2:
                        continue
                    _, join = roots(hi - lo)
                    a, b, _ = alike(sig[lo:hi])
                    for x, y in zip(a.tolist(), b.tolist(), strict=True):
                        if join(x, y):
                            x, y = node[lo + x], node[lo + y]
                            out.add((x, y) if x < y else (y, x))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in out], pa.binary()), pa.array([y for _, y in out], pa.binary())], ["a", "b"])

        return f

    pair_type = "a binary, b binary"
    first = grouped(small, False).mapInArrow(forests(0), pair_type)
    walked = grouped(large, True).mapInArrow(forests(128), pair_type)
    tried = saved(first.union(walked).distinct())

    # The full set of every document with a candidate: the text of any row that has it.
    wanted = saved(tried.select("a").union(tried.select("b")).union(large.select("node")).distinct().withColumnRenamed("a", "node"))
    owner = wanted.join(distinct.select("node", "id"), "node")

    def full(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(0, b.num_rows, 500):
                part = b.slice(k, 500)
                sets = shingle_sets(part.column("text"), shingle)
                good = [i for i, (s, n) in enumerate(zip(sets, part.column("node").to_pylist(), strict=True)) if len(s) and xxhash.xxh3_128_digest(s.tobytes()) == n]
                yield pa.RecordBatch.from_arrays([part.column("node").take(pa.array(good, pa.int64())), pa.array([sets[i].tobytes() for i in good], pa.binary())], ["node", "s"])

    none = F.lit(-(2**63))
    sets = source.join(owner, F.coalesce(source.id, none) == F.coalesce(owner.id, none)).select("node", "text").mapInArrow(full, "node binary, s binary")
    sets = saved(sets.dropDuplicates(["node"]))

    def linked(x: np.ndarray, y: np.ndarray) -> bool:
        both = len(np.intersect1d(x, y, assume_unique=True))
        return 100 * both >= percent * (len(x) + len(y) - both)

    def holds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            good = [i for i, (x, y) in enumerate(zip(b.column("sa").to_pylist(), b.column("sb").to_pylist(), strict=True)) if linked(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64))]
            yield pa.RecordBatch.from_arrays([b.column(c).take(pa.array(good, pa.int64())) for c in ("a", "b")], ["a", "b"])

    left = tried.join(sets.select(F.col("node").alias("a"), F.col("s").alias("sa")), "a")
    links = saved(left.join(sets.select(F.col("node").alias("b"), F.col("s").alias("sb")), "b").select("a", "b", "sa", "sb").mapInArrow(holds, pair_type))
    parts = saved(connected_components(links))

    # Round two: regions that still hold several components. A pair is of one row outside the main component (``minor``)
    # and one of another component. Blocks hold a share of the rows as ``own`` and a share of the minor ones as ``far``.
    keys = ["tree", "depth", "key"]

    def parted(members: DataFrame) -> DataFrame:
        return saved(members.join(parts, "node", "left").select("node", *keys, F.coalesce("component", "node").alias("part")))

    in_small, in_large = parted(small), parted(large)
    split = in_small.groupBy(*keys).agg(F.min("part").alias("p"), F.max("part").alias("q")).where("p <> q").select(*keys)
    yes = F.lit(True)
    open_small = in_small.join(split, keys).select(*keys, F.lit(0).alias("block"), "node", "part", yes.alias("own"), yes.alias("far"), yes.alias("minor"))
    sizes = in_large.groupBy(*keys, "part").agg(F.count("*").alias("c"))
    main = per_key(sizes, keys, F.max(F.struct("c", "part")).alias("m"), F.sum("c").alias("c"), F.count("*").alias("parts")).where("parts > 1")
    main = main.select(*keys, F.col("m.part").alias("most"), F.ceil(F.col("c") / (4 * region)).cast("int").alias("across"), F.ceil((F.col("c") - F.col("m.c")) / (8 * region)).cast("int").alias("down"))
    dealt = in_large.join(main, keys).withColumn("minor", F.col("part") != F.col("most"))
    dealt = dealt.withColumn("x", F.pmod(F.xxhash64("node"), F.col("across")).cast("int")).withColumn("y", F.pmod(F.xxhash64("node", F.lit(1)), F.col("down")).cast("int"))
    as_own = F.transform(F.sequence(F.lit(0), F.col("down") - 1), lambda i: i * F.col("across") + F.col("x"))
    as_far = F.when(F.col("minor"), F.transform(F.sequence(F.lit(0), F.col("across") - 1), lambda i: F.col("y") * F.col("across") + i)).otherwise(F.array().cast("array<int>"))
    dealt = dealt.withColumn("block", F.explode(F.array_union(as_own, as_far)))
    is_far = F.col("minor") & (F.floor(F.col("block") / F.col("across")) == F.col("y"))
    open_large = dealt.select(*keys, "block", "node", "part", (F.col("block") % F.col("across") == F.col("x")).alias("own"), is_far.alias("far"), "minor")
    group = [*keys, "block"]

    def tries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The rows of each block that a pair to be tried needs, numbered; a far one with its partners, best estimate first."""
        for tab, bounds in whole_groups(batches, group):
            sig = np.frombuffer(b"".join(tab.column("sig").to_pylist()), np.uint16).reshape(tab.num_rows, trees, -1)
            own, far, minor = (np.array(tab.column(c).to_pylist(), bool) for c in ("own", "far", "minor"))
            names = np.array(tab.column("node").to_pylist(), object)
            part = np.unique(np.array(tab.column("part").to_pylist(), object), return_inverse=True)[1]
            tree = tab.column("tree").to_numpy()
            number, used = np.zeros(tab.num_rows, np.int32), np.zeros(tab.num_rows, bool)
            partners: list[list[int]] = [[] for _ in range(tab.num_rows)]
            likes: list[list[int]] = [[] for _ in range(tab.num_rows)]
            for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                number[lo:hi] = np.arange(hi - lo)
                home = lo + np.flatnonzero(own[lo:hi])
                for x in (lo + np.flatnonzero(far[lo:hi])).tolist():
                    # Of two minor rows only one seeks the other.
                    y = home[part[home] != part[x]]
                    y = y[~minor[y] | (names[y] < names[x]).astype(bool)]
                    if not len(y):
                        continue
                    same = sig[y] == sig[x]
                    like = np.count_nonzero(same.reshape(len(y), -1), axis=1)
                    good = np.flatnonzero(like >= least)
                    # A pair that shares the deepest prefix of an earlier tree met there.
                    good = good[~same[good, : tree[lo], : depths[-1]].all(axis=2).any(axis=1)]
                    good = good[np.argsort(-like[good], kind="stable")]
                    if len(good):
                        used[x] = True
                        used[y[good]] = True
                        partners[x], likes[x] = (y[good] - lo).tolist(), like[good].tolist()
            if used.any():
                at = np.flatnonzero(used)
                columns = [tab.column(c).combine_chunks().take(pa.array(at)) for c in (*group, "node", "part")]
                lists = [pa.array([v[i] for i in at.tolist()], pa.list_(pa.int32())) for v in (partners, likes)]
                yield pa.RecordBatch.from_arrays([*(c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in columns), pa.array(number[at]), *lists], [*group, "node", "part", "number", "partners", "likes"])

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The links of a block that join components, as pairs of components."""
        for tab, bounds in whole_groups(batches, group):
            part, number, partners, likes, full_sets = (tab.column(c).to_pylist() for c in ("part", "number", "partners", "likes", "s"))
            out = []
            for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                top, join = roots(hi - lo)
                home: dict[bytes, int] = {}
                for i in range(hi - lo):
                    join(home.setdefault(part[lo + i], i), i)
                where = {number[i]: i - lo for i in range(lo, hi)}
                shingles = [np.frombuffer(x, np.uint64) for x in full_sets[lo:hi]]
                pairs = [(-k, i - lo, where[y]) for i in range(lo, hi) for k, y in zip(likes[i], partners[i], strict=True)]
                for _, x, y in sorted(pairs):
                    if top(x) != top(y) and linked(shingles[x], shingles[y]):
                        join(x, y)
                        out.append((part[lo + x], part[lo + y]))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in out], pa.binary()), pa.array([y for _, y in out], pa.binary())], ["a", "b"])

    row = "tree int, depth int, key bigint, block int, node binary, part binary, number int, partners array<int>, likes array<int>"
    signed = open_small.union(open_large).join(distinct.select("node", "sig"), "node").select(*group, "node", "part", "own", "far", "minor", "sig")
    rest = saved(signed.repartition(*group).sortWithinPartitions(*group).mapInArrow(tries, row))
    brought = rest.join(sets, "node").select(*group, "node", "part", "number", "partners", "likes", "s").repartition(*group).sortWithinPartitions(*group)
    more = saved(brought.mapInArrow(settle, pair_type))
    known = rows.join(parts, "node", "left").select("id", "n", F.coalesce("component", "node").alias("component"))
    if not more.isEmpty():
        moved = connected_components(more).select(F.col("node").alias("component"), F.col("component").alias("to"))
        known = known.join(moved, "component", "left").select("id", "n", F.coalesce("to", "component").alias("component"))
    known = saved(known)
    firsts = per_key(known.where("component is not null"), ["component"], F.min("id").alias("component_id"))
    joined = known.join(firsts, "component", "left")
    component = F.when(F.col("component").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return joined.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"))


def _stretches(b: pa.RecordBatch) -> np.ndarray:
    change = np.zeros(max(0, b.num_rows - 1), bool)
    for k in ("tree", "depth", "key"):
        x = b.column(k).to_numpy()
        change |= x[1:] != x[:-1]
    return np.concatenate([[0], np.flatnonzero(change) + 1, [b.num_rows]])
