"""Ranked lexical search by NRA: no random accesses, sorted lists and score intervals alone.

Documents are read once. What they hold of the items' terms is kept as Parquet in the shared folder: for each document its terms
and how often they occur. A batch of these is a part of the index: each term's list is sorted in it by impact. For each item the
lists of its terms are read from the front, all to the same depth, and every document has a lower bound (what was read of it) and
an upper bound (that, and the next values of the lists in which it was not met). Reading goes on until no document whose upper bound
reaches the best ``k`` is open: then membership, ties and scores are settled. The ``k`` best of the batches before set the bar for the
next one. The best of all tasks meet by item.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from .common import remove, saved, shared_dir
from .shingles import word_hashes

#: Bytes outside of terms: ASCII but for letters and digits.
_OUTSIDE = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
#: Cells (lists times documents) that bounds are held for at a time.
_CELLS = 1 << 22


def _counted(h: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, term, occurrences) of hashes that lie together by text."""
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    order = np.lexsort((h, text))
    h, text = h[order], text[order]
    first = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (text[1:] != text[:-1])])) if len(h) else np.zeros(0, np.int64)
    return text[first], h[first], np.diff(np.append(first, len(h)))


def _item_terms(items: DataFrame, item_col: str, text_col: str) -> DataFrame:
    """(item, term, reps): the terms of every item with their repeats; rows that share an id are one item."""

    def terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text, term, n = _counted(*word_hashes(batch.column(1), _OUTSIDE))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(text)), pa.array(term.view(np.int64)), pa.array(n.astype(np.int64))], names=["item", "term", "reps"])

    shape = T.StructType([T.StructField("item", items.schema[item_col].dataType), T.StructField("term", T.LongType()), T.StructField("reps", T.LongType())])
    found = items.select(F.col(f"`{item_col}`").alias("item"), F.col(f"`{text_col}`").cast("string").alias("text")).mapInArrow(terms, shape)
    return found.groupBy("item", "term").agg(F.sum("reps").alias("reps"))


def _postings(docs: DataFrame, id_col: str, text_col: str, wanted: np.ndarray) -> DataFrame:
    """(doc, n, terms, tfs) of the documents that have terms: how many, and which of the ``wanted`` (sorted) ones how often."""
    shared = docs.sparkSession.sparkContext.broadcast(wanted)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = shared.value
        for batch in batches:
            h, offsets = word_hashes(batch.column(1), _OUTSIDE)
            place = np.minimum(np.searchsorted(wanted, h), len(wanted) - 1)
            hit = wanted[place] == h
            text, term, n = _counted(place[hit], np.concatenate([[0], np.cumsum(hit)])[offsets])
            at = pa.array(np.searchsorted(text, np.arange(len(offsets))).astype(np.int32))
            size = np.diff(offsets)
            out = pa.RecordBatch.from_arrays([batch.column(0), pa.array(size), pa.ListArray.from_arrays(at, pa.array(term.astype(np.int32))), pa.ListArray.from_arrays(at, pa.array(n.astype(np.int64)))], names=["doc", "n", "terms", "tfs"])
            yield out.filter(pa.array(size > 0))

    shape = T.StructType([T.StructField("doc", docs.schema[id_col].dataType), T.StructField("n", T.LongType()), T.StructField("terms", T.ArrayType(T.IntegerType())), T.StructField("tfs", T.ArrayType(T.LongType()))])
    return docs.select(F.col(f"`{id_col}`").alias("doc"), F.col(f"`{text_col}`").cast("string").alias("text")).mapInArrow(scan, shape)


def nra(lists: list[tuple[np.ndarray, np.ndarray]], n: int, k: int, bar: int = 1, first: int = 16) -> tuple[np.ndarray, np.ndarray]:
    """(documents, scores) of those among 0..n-1 that can be of the ``k`` best and score ``bar`` or more, ties of the last one included.

    ``lists``: (documents, values) sorted by value, greatest first, each document once in a list; values are positive.
    """
    # Sums of whole numbers below 2**53 are exact as floats.
    kind = np.float64 if sum(int(v[0]) for _, v in lists if len(v)) < 2**53 else np.int64
    lower, unmet = np.zeros(n, np.int64), np.ones((len(lists), n), kind)
    at, step = 0, first
    while True:
        heads = np.zeros(len(lists), kind)
        for i, (docs, values) in enumerate(lists):
            now = docs[at : at + step]
            lower[now] += values[at : at + step]
            unmet[i, now] = 0
            heads[i] = values[at + step - 1] if at + step < len(docs) else 0
        at, step = at + step, 2 * step
        least = max(bar, int(np.partition(lower, n - k)[n - k]) if n > k else int(lower.min()))
        missing = (heads @ unmet).astype(np.int64)
        if not np.any((missing > 0) & (lower + missing >= least)):
            done = np.flatnonzero(lower >= least)
            return done, lower[done]


def _impacts(tf: np.ndarray, n: np.ndarray, docs: int, length: int) -> np.ndarray:
    """What one occurrence weight of a term is multiplied with, in whole numbers."""
    exact = object if 75 * int(n.max(initial=0)) * docs >= 2**63 else np.int64
    m = (25 + (75 * n.astype(exact) * docs) // length).astype(np.int64)
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


def _best(rows: list[tuple[int, Any]], k: int) -> list[tuple[int, Any]]:
    """The ``k`` best (score, document), equal scores by document, null last."""
    return sorted(rows, key=lambda r: (-r[0], r[1] is None, 0 if r[1] is None else r[1]))[:k]


def _best_of_tasks(index: DataFrame, mine: list[list[tuple[int, int]]], weight: np.ndarray, count: int, length: int, k: int) -> DataFrame:
    """(item, doc, score) of the best ``k`` documents that each task finds for each item; ``mine`` are the items' terms with their repeats."""
    task = index.sparkSession.sparkContext.broadcast((weight, [(np.array([t for t, _ in x]), np.array([n for _, n in x])) for x in mine]))
    shape = T.StructType([T.StructField("item", T.IntegerType()), index.schema["doc"], T.StructField("score", T.LongType())])
    kind = to_arrow_type(shape["doc"].dataType)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight, mine = task.value
        best: list[list[tuple[int, Any]]] = [[] for _ in mine]
        for batch in batches:
            doc, n = batch.column(0), batch.column(1).to_numpy()
            term, tf = batch.column(2).flatten().to_numpy(), batch.column(3).flatten().to_numpy()
            row = np.repeat(np.arange(len(n)), np.diff(batch.column(2).offsets.to_numpy()))
            value = weight[term] * _impacts(tf, n[row], count, length)
            order = np.lexsort((-value, term))
            row, value = row[order], value[order]
            starts = np.searchsorted(term[order], np.arange(len(weight) + 1))
            for i, (own, reps) in enumerate(mine):
                lists = [(row[starts[t] : starts[t + 1]], value[starts[t] : starts[t + 1]] * r) for t, r in zip(own.tolist(), reps.tolist(), strict=True) if weight[t] and starts[t] < starts[t + 1]]
                size = max(256, _CELLS // max(1, len(lists)))
                for low in range(0, len(n) if lists else 0, size):
                    part = lists
                    if len(n) > size:
                        inside = [(d >= low) & (d < low + size) for d, _ in lists]
                        part = [(d[x] - low, v[x]) for (d, v), x in zip(lists, inside, strict=True)]
                    bar = best[i][-1][0] if len(best[i]) >= k else 1
                    rows, scores = nra(part, min(size, len(n) - low), k, bar)
                    if len(rows):
                        best[i] = _best([*best[i], *zip(scores.tolist(), doc.take(pa.array(rows + low)).to_pylist(), strict=True)], k)
        flat = [(i, d, s) for i, rows in enumerate(best) for s, d in rows]
        yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in flat], pa.int32()), pa.array([x[1] for x in flat], kind), pa.array([x[2] for x in flat], pa.int64())], names=shape.names)

    return index.mapInArrow(search, shape)


def lexical_search(docs: DataFrame, items: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", block: int = 500_000) -> DataFrame:
    """Each item's ``k`` best documents with a score above 0: (item_id, rank, doc_id, score), columns by the names of the ids.

    A term is a maximal run of letters, digits and all beyond ASCII, A-Z in lower case. With N documents that have a term, L terms in
    all and df of the documents holding the term, its weight w is floor(1000 ln((2N + 2) / (2 df + 1))), and a document of n terms that
    holds it tf times gets w * (10**9 tf div (1000 tf + 8 m)), m = 25 + 75 n N div L, for each time that the item has it. Scores are whole
    64-bit numbers; equal ones are ranked by ascending id, null last.

    Null texts have no terms; documents without terms count nowhere. Documents that repeat an id are ranked each by itself; items that
    share one are one item, a null id included. An empty table, or items without terms, give an empty result. Other columns are ignored.
    Items are taken in blocks of about ``block`` distinct terms, and the documents are read once for each block; so the driver and a task
    hold the terms of a block (or of one item that has more). Terms are told apart by 64-bit hashes.
    """
    spark = docs.sparkSession
    terms = saved(_item_terms(items, item_col, item_text_col))
    blocks = max(1, -(-terms.count() // block))
    item = T.StructField(item_col, items.schema[item_col].dataType)
    out = spark.createDataFrame([], T.StructType([item, T.StructField("rank", T.IntegerType()), T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("score", T.LongType())]))
    for b in range(blocks):
        asked = terms.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == b).collect()  # bounded by ``block``
        if not asked:
            continue
        hashes = np.array([r.term for r in asked], np.int64).view(np.uint64)
        wanted = np.unique(hashes)
        known = list(dict.fromkeys(r.item for r in asked))
        number = {x: i for i, x in enumerate(known)}
        mine: list[list[tuple[int, int]]] = [[] for _ in known]
        for r, place in zip(asked, np.searchsorted(wanted, hashes).tolist(), strict=True):
            mine[number[r.item]].append((place, r.reps))
        folder = f"{shared_dir(spark)}/lexical-{uuid.uuid4().hex}"
        _postings(docs, id_col, text_col, wanted).write.parquet(folder)
        index = spark.read.parquet(folder)
        count, length = index.agg(F.count("*"), F.sum("n")).first()
        if count:
            df = np.zeros(len(wanted), np.int64)
            for term, n in index.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count("*")).collect():  # one row for a wanted term
                df[term] = n
            weight = np.array([math.floor(1000 * math.log((2 * count + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)
            place = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc")))
            top = _best_of_tasks(index, mine, weight, count, length, k).withColumn("rank", place).where(F.col("rank") <= k)
            names = spark.createDataFrame(list(enumerate(known)), T.StructType([T.StructField("item", T.IntegerType()), T.StructField("name", item.dataType)]))
            found = saved(top.join(F.broadcast(names), "item").select(F.col("name").alias(item_col), F.col("rank").cast("int").alias("rank"), F.col("doc").alias(id_col), "score"))
            out = found if blocks == 1 else out.unionByName(found)
        remove(spark, folder)
    return out
