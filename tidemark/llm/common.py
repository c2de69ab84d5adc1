"""Helpers shared by the operators: tables, checkpoints, sorted groups, components."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; where that is unset a new local one, on a local master (tests) only."""
    context = spark.sparkContext
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at and not context.getCheckpointDir():
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="spark-"))
    elif at and not context.getCheckpointDir():
        context.setCheckpointDir(at)
    return at or context.getCheckpointDir()


def saved(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the shared folder, so that a lost executor costs no recomputation.

    Its columns are new ones, so that it can be joined with the frame it was made of.
    """
    shared_dir(df.sparkSession)
    kept = df.checkpoint(eager=True)
    return kept.select(*[F.col(f"`{c}`").alias(c) for c in kept.columns])


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of intermediate results, wherever Spark can write."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def per_key(rows: DataFrame, keys: list[str], *aggregates: Column) -> DataFrame:
    """Aggregates by key, to be joined back to ``rows`` on the same key.

    Grouped by the key as one struct, so the join's shuffle isn't that of the grouping: each side of the join
    has its own, and the adaptive planner can split a hot key on the side of the rows.
    """
    out = rows.groupBy(F.struct(*keys).alias("_key")).agg(*aggregates)
    return out.select("_key.*", *[c for c in out.columns if c != "_key"])


def crc_mod(doc_id: str | Column, mod: int) -> Column:
    """crc32 of the id as text, modulo ``mod``; a null id counts as empty text."""
    col = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(col.cast("string"), F.lit("")).cast("binary")) % F.lit(mod)


def labelled(docs: DataFrame, labels: DataFrame, train: Column, id_col: str, text_col: str, label_col: str, sample: int) -> DataFrame:
    """(id, text, label) of at most ``sample`` labelled documents, one row for each id, chosen by a hash of the id.

    ``train`` says which rows of ``labels`` may be used; labels other than 0 and 1 and null ids are not. An id whose
    labels disagree is not learned from. Of documents that repeat an id the one whose text has the smallest
    hash is taken. Ids of any type that compares.
    """
    known = labels.where(train & F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label"))
    agreed = known.groupBy("id").agg(F.min("label").alias("label"), F.max("label").alias("other")).where("label = other")
    # Bounded: ``sample`` rows of an id and a label.
    chosen = agreed.select("id", "label").orderBy(F.xxhash64("id"), "id").limit(sample)
    rows = docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text")).join(F.broadcast(chosen), F.col("doc") == F.col("id"))
    one = rows.groupBy("id").agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text", "label")).alias("r"))
    return one.select("id", "r.text", "r.label")


def whole_groups(batches: Iterator[pa.RecordBatch], key: list[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole groups from rows sorted by ``key``, with the first row of each group and the end.

    Only the last, perhaps unfinished, group of a batch is held back, so memory is
    bounded by a batch and the largest group.
    """
    held: list[pa.RecordBatch] = []
    last: tuple | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [batch.column(k) for k in key]
        changed = np.zeros(batch.num_rows - 1, bool)
        for c in cols:
            changed |= np.array(pa.compute.not_equal(c[1:], c[:-1]).to_pylist(), bool) if not pa.types.is_integer(c.type) else c.to_numpy()[1:] != c.to_numpy()[:-1]
        starts = np.flatnonzero(changed) + 1
        first = tuple(c[0].as_py() for c in cols)
        if held and first != last:
            yield _bounds(held, key)
            held = []
        if len(starts):
            yield _bounds([*held, batch.slice(0, int(starts[-1]))], key)
            held = [batch.slice(int(starts[-1]))]
        else:
            held.append(batch)
        last = tuple(c[-1].as_py() for c in cols)
    if held:
        yield _bounds(held, key)


def _bounds(batches: list[pa.RecordBatch], key: list[str]) -> tuple[pa.Table, np.ndarray]:
    table = pa.Table.from_batches(batches).combine_chunks()
    changed = np.zeros(table.num_rows - 1, bool)
    for k in key:
        c = table.column(k).combine_chunks()
        c = c.chunk(0) if isinstance(c, pa.ChunkedArray) else c
        changed |= c.to_numpy()[1:] != c.to_numpy()[:-1] if pa.types.is_integer(c.type) else np.array(pa.compute.not_equal(c[1:], c[:-1]).to_pylist(), bool)
    return table, np.concatenate([[0], np.flatnonzero(changed) + 1, [table.num_rows]])


def fixed_matrix(column: pa.ChunkedArray | pa.Array, dtype: str) -> np.ndarray:
    """The rows of a binary column of equal lengths as a matrix."""
    values = column.to_pylist()
    return np.frombuffer(b"".join(values), dtype).reshape(len(values), -1)


def least_labels(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For the nodes 0..n-1 the smallest node reachable over the links a-b."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        label = label[label]
        if np.array_equal(before, label):
            break
    return label


def connected_components(edges: DataFrame, most: int = 60) -> DataFrame:
    """(node, component) of all nodes in ``edges`` (a, b): component is the smallest node reachable.

    Alternating large and small stars: every round hangs each node under the smallest
    neighbour known to it. A round is two map-side combined aggregations and joins of the links with
    them on the node, which the adaptive planner splits where a node has many links; each
    round is checkpointed. It ends when a round changes nothing. Nulls link with nothing.
    """

    def stars(e: DataFrame, large: bool) -> DataFrame:
        out = e.select(F.col("u").alias("n"), F.col("v").alias("o"))
        if large:
            out = out.union(e.select("v", "u"))
        low = per_key(out, ["n"], F.min("o").alias("m"))
        out = out.join(low, "n")
        if large:
            pairs = out.where("o > n").select(F.col("o").alias("u"), F.least("m", "n").alias("v"))
        else:
            pairs = out.where("o <> m").select(F.col("o").alias("u"), F.col("m").alias("v")).union(low.select("n", "m"))
        pairs = pairs.where("u <> v")
        return pairs if large else pairs.distinct()  # at most two rows for each link in between

    e = saved(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    mark = None
    for _ in range(most):
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(now) == mark or not now[0]:
            break
        mark = tuple(now)
        e = saved(stars(stars(e, True), False))
    else:
        raise RuntimeError(f"components did not settle in {most} rounds")
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).union(e.select("v", "v").distinct())
