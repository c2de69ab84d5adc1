"""Near-duplicates of embeddings by random-hyperplane sign hashing.

Vectors that agree in every bit of a table's signature meet in a bucket of that table; inside a
bucket all cosines are computed in double precision, so no link is below the threshold.
The signature length follows the number of vectors and the number of tables follows
from the recall asked for at the threshold itself (higher for closer pairs).

Equal vectors are folded first and count by their multiplicity. A pair is counted in the
first table where it meets. Large buckets are dealt out as pairs of blocks, so no task
holds more than two blocks and no pair of rows leaves a task: only link counts per vector and
one edge per vector and block to its block-local root.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import connected_components, fixed_matrix, least_labels, per_key, saved, whole_groups


def tables_needed(bits: int, threshold: float, recall: float) -> int:
    """Tables for which a pair at the threshold meets at least once with probability ``recall``."""
    same = (1 - math.acos(threshold) / math.pi) ** bits
    return max(1, math.ceil(math.log(1 - recall) / math.log1p(-same)))


def _planes(dim: int, n: int, seed: int) -> np.ndarray:
    return np.random.RandomState((seed + dim) % 2**32).standard_normal((dim, n))


def embedding_near_dedup(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = 0.9, recall: float = 0.999, bits: int | None = None, block: int = 1024, seed: int = 7) -> DataFrame:
    """One row per vector: id, n_links, component_id, kept.

    Vectors that are null, empty, all zero, or hold a null or non-finite component link with
    nothing; finite ones of any size count, up to the greatest doubles. Vectors of different lengths are not compared. Rows with a null id take part;
    a component of only such rows has a null component_id and is not kept. Repeated ids are
    separate rows. Other columns are ignored. An empty table gives an empty result.

    What is shuffled grows a little faster than the input: each vector travels once for each table, and their
    number grows with the bits, which keep buckets at about 128 vectors (25 tables at 50,000 vectors, 150 at 10**8).
    """
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    usable = F.coalesce((F.size("v") > 0) & ~bad & F.exists("v", lambda x: x != 0), F.lit(False))
    # The digest only names a group: groups are formed by the whole vector.
    rows = rows.withColumn("v", F.when(usable, F.transform("v", lambda x: x + F.lit(0.0))))
    groups = rows.where("v is not null").groupBy("v").agg(F.count("*").alias("mult"))
    groups = saved(groups.select(F.unhex(F.md5(F.to_json(F.struct("v")))).alias("node"), "v", "mult"))
    n = groups.count()
    if bits is None:
        bits = min(30, max(4, round(math.log2(max(n, 1) / 128)) if n > 128 else 4))
    tables = tables_needed(bits, threshold, recall)

    single = isinstance(vectors.schema[vector_col].dataType, T.ArrayType) and isinstance(vectors.schema[vector_col].dataType.elementType, T.FloatType)
    # Single precision travels as such; cosines are of its exact value in double precision.
    real, word = "<f4" if single else "<f8", "<u2" if bits <= 16 else "<u4"

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight = 1 << np.arange(bits)
        for b in batches:
            v = b.column("v")
            lens = np.diff(v.offsets.to_numpy())
            flat = v.flatten().to_numpy(zero_copy_only=False)
            starts = np.concatenate([[0], np.cumsum(lens)])
            sigs: list = [None] * len(lens)
            data: list = [None] * len(lens)
            for dim in np.unique(lens):
                at = np.flatnonzero(lens == dim)
                x = flat[starts[at][:, None] + np.arange(dim)]
                # Scaled by its greatest component, so that no product of a huge vector overflows; signs stay as they are.
                h = ((x / np.abs(x).max(axis=1, keepdims=True) @ _planes(int(dim), bits * tables, seed) >= 0).reshape(len(at), tables, bits) @ weight).astype(word)
                for i, row, vec in zip(at, h, x, strict=True):
                    sigs[i], data[i] = row.tobytes(), vec.astype(real).tobytes()
            yield pa.RecordBatch.from_arrays([b.column("node"), pa.array(lens.astype(np.int32)), pa.array(data, pa.binary()), pa.array(sigs, pa.binary()), b.column("mult")], ["node", "dim", "vec", "sigs", "mult"])

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The key of every vector in every table."""
        for b in batches:
            sig = fixed_matrix(b.column("sigs"), word) if b.num_rows else np.zeros((0, tables), word)
            row = np.repeat(np.arange(b.num_rows), tables)
            table = np.tile(np.arange(tables, dtype=np.int32), b.num_rows)
            yield pa.RecordBatch.from_arrays([pa.array(table), pa.array(sig.ravel().astype(np.int32)), b.column("dim").take(pa.array(row)), b.column("node").take(pa.array(row))], ["t", "key", "dim", "node"])

    signed = saved(groups.mapInArrow(sign, "node binary, dim int, vec binary, sigs binary, mult bigint"))
    keys = signed.select("node", "dim", "sigs").mapInArrow(deal, "t int, key int, dim int, node binary")
    sizes = per_key(keys, ["t", "key", "dim"], F.count("*").alias("c")).where("c > 1")
    blocks = F.ceil(F.col("c") / block).cast("int")
    placed = keys.join(sizes, ["t", "key", "dim"]).withColumn("n", blocks).withColumn("own", F.pmod(F.xxhash64("node"), F.col("n")).cast("int"))
    placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n") - 1))).select("t", "key", "dim", "node", "own", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
    met = placed.join(signed.drop("dim"), "node").repartition("t", "key", "dim", "i", "j").sortWithinPartitions("t", "key", "dim", "i", "j")
    at = ["t", "key", "dim", "i", "j"]

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tab, bounds in whole_groups(batches, at):
            node, mult = tab.column("node").to_pylist(), tab.column("mult").to_numpy()
            own, t, dim = (tab.column(c).to_numpy() for c in ("own", "t", "dim"))
            i, j = tab.column("i").to_numpy(), tab.column("j").to_numpy()
            vec, sig = tab.column("vec").to_pylist(), fixed_matrix(tab.column("sigs"), word)
            names: list[bytes] = []
            roots: list[bytes | None] = []
            links: list[int] = []
            for lo, hi in zip(bounds[:-1], bounds[1:], strict=True):
                if hi - lo < 2:
                    continue
                x = np.frombuffer(b"".join(vec[lo:hi]), real).reshape(hi - lo, dim[lo]).astype(float)
                x = x / np.abs(x).max(axis=1, keepdims=True)
                x = x / np.linalg.norm(x, axis=1, keepdims=True)
                if i[lo] == j[lo]:
                    a, b = np.nonzero(np.triu(x @ x.T >= threshold, 1))
                else:
                    left, right = np.flatnonzero(own[lo:hi] == i[lo]), np.flatnonzero(own[lo:hi] == j[lo])
                    a, b = np.nonzero(x[left] @ x[right].T >= threshold)
                    a, b = left[a], right[b]
                s, parts = sig[lo:hi, : t[lo]], []
                for k in range(0, len(a), 100_000):
                    parts.append((s[a[k : k + 100_000]] == s[b[k : k + 100_000]]).any(axis=1))
                new = ~np.concatenate(parts) if parts else np.zeros(0, bool)
                a, b = a[new], b[new]
                if not len(a):
                    continue
                m = mult[lo:hi]
                count = np.bincount(a, m[b], hi - lo) + np.bincount(b, m[a], hi - lo)
                label = least_labels(hi - lo, a, b)
                for k in np.flatnonzero(count):
                    names.append(node[lo + k])
                    roots.append(node[lo + label[k]])
                    links.append(int(count[k]))
            if names:
                yield pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), pa.array(roots, pa.binary()), pa.array(links, pa.int64())], ["a", "b", "links"])

    found = saved(met.mapInArrow(link, "a binary, b binary, links bigint"))
    counts = found.groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    parts = connected_components(found.select("a", "b"))
    known = groups.join(counts, "node", "left").join(parts, "node", "left").select("v", (F.coalesce("links", F.lit(0)) + F.col("mult") - 1).alias("n_links"), F.coalesce("component", "node").alias("component"))
    named = saved(rows.join(known, "v", "left").select("id", "n_links", "component"))
    least = per_key(named.where("component is not null"), ["component"], F.min("id").alias("component_id"))
    linked = named.join(least, "component", "left")
    component = F.when(F.col("component").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return linked.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"))
