"""Language identification by multilingual mixture inference.

Every language has a distribution of hashed byte trigrams, counted over all labelled texts. A text is a
mixture of languages: expectation-maximisation estimates its proportions from the likelihoods
of its trigrams. The set of languages starts with the likeliest one and grows by the language
with the steepest ascent as long as the likelihood gains more than the penalty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 1 << 16
#: Letters stay (bytes from 128 on belong to letters or marks beyond ASCII), all else is a gap.
_LETTER = np.full(256, 32, np.uint8)
_LETTER[97:123] = np.arange(97, 123)
_LETTER[128:] = np.arange(128, 256)


def trigrams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, bucket, count) of the distinct trigrams of every text; runs of gaps are one."""
    low = pc.utf8_lower(pc.fill_null(texts.cast(pa.large_string()), ""))
    size = pc.binary_length(low).to_numpy() if len(low) else np.zeros(0, np.int64)
    raw = np.frombuffer((" " + "  ".join(low.to_pylist()) + " ").encode(), np.uint8)  # every text between two gaps
    x = _LETTER[raw]
    doc = np.repeat(np.arange(len(size)), size + 2)
    if not len(doc):
        return (np.zeros(0, np.int64),) * 3
    keep = ~((x == 32) & np.concatenate([[False], (x[:-1] == 32) & (doc[1:] == doc[:-1])]))
    x, doc = x[keep].astype(np.uint32), doc[keep]
    if len(x) < 3:
        return (np.zeros(0, np.int64),) * 3
    h = (x[:-2] * np.uint32(0x9E3779B1) ^ x[1:-1] * np.uint32(0x85EBCA6B) ^ x[2:] * np.uint32(0xC2B2AE35)) >> np.uint32(16)
    whole = doc[:-2] == doc[2:]
    key, n = np.unique(doc[:-2][whole].astype(np.int64) * BUCKETS + h[whole], return_counts=True)
    return key // BUCKETS, key % BUCKETS, n


def infer(doc: np.ndarray, gram: np.ndarray, n: np.ndarray, p: np.ndarray, docs: int, penalty: float = 4.0, steps: int = 12) -> np.ndarray:
    """Proportions of the languages (columns of ``p``) in each of ``docs`` texts; zeros where a text has no trigram.

    A further language must gain ``penalty`` times the logarithm of the number of trigrams.
    """
    langs = p.shape[1]
    share = np.zeros((docs, langs))
    total = np.bincount(doc, n, docs)
    has = np.flatnonzero(total)
    if not len(has) or not langs:
        return share
    q = p[gram]
    single = np.column_stack([np.bincount(doc, n * np.log(q[:, k]), docs) for k in range(langs)])
    best = single.argmax(axis=1)
    share[has, best[has]] = 1
    score = single.max(axis=1)
    live = np.zeros(docs, bool)
    live[has] = langs > 1
    for _ in range(langs - 1):
        rows = np.flatnonzero(live[doc])
        if not len(rows):
            break
        d, x, c = doc[rows], q[rows], n[rows]
        mass = (x * share[d]).sum(axis=1)
        # The slope of the likelihood towards each language not yet in the set; above 1 it can gain.
        slope = np.column_stack([np.bincount(d, c * x[:, k] / mass, docs) for k in range(langs)]) / np.maximum(total, 1)[:, None]
        slope[share > 0] = 0
        add = slope.argmax(axis=1)
        live &= slope.max(axis=1) > 1
        some = np.flatnonzero(live)
        if not len(some):
            break
        trial = share.copy()
        trial[some] *= 0.7
        trial[some, add[some]] = 0.3
        rows = rows[live[d]]
        d, x, c = doc[rows], q[rows], n[rows]
        for _step in range(steps):
            r = x * trial[d]
            r *= (c / r.sum(axis=1))[:, None]
            trial[some] = np.column_stack([np.bincount(d, r[:, k], docs) for k in range(langs)])[some] / total[some][:, None]
        new = np.bincount(d, c * np.log((x * trial[d]).sum(axis=1)), docs)
        live &= new - score > penalty * np.log(np.maximum(total, 2))
        share[live], score[live] = trial[live], new[live]
    return share


def language(docs: DataFrame, train: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", smooth: float = 0.5) -> DataFrame:
    """One row per document: id, lang_pred, score (the proportion of that language). Ids may be of any type.

    The driver gathers, and each task holds, ``BUCKETS`` numbers for every language: 0.5 MB each.

    Learns from the texts and non-null languages of the rows that ``train`` names. ``und`` with score 0 if the text is null
    or has no letter, or if nothing could be learned. Repeated ids are separate rows; other
    columns are ignored. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    known = docs.where(train & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for whole in batches:
            for k in range(0, whole.num_rows, 500):
                b = whole.slice(k, 500)
                doc, gram, n = trigrams(b.column("text"))
                code = b.column("lang").dictionary_encode()
                own = code.indices.to_numpy()[doc]
                for i, name in enumerate(code.dictionary.to_pylist()):
                    at = own == i
                    total[name] = total.get(name, 0) + np.bincount(gram[at], n[at], BUCKETS).astype(np.int64)
        for name, t in total.items():
            used = np.flatnonzero(t)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(used), pa.string()), pa.array(used.astype(np.int32)), pa.array(t[used])], ["lang", "gram", "n"])

    # At most one row for each language and bucket.
    sums = known.mapInArrow(count, "lang string, gram int, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n")).toArrow()
    names = sorted(set(sums.column("lang").to_pylist()))
    p = np.full((BUCKETS, len(names)), smooth)
    if names:
        where = {x: i for i, x in enumerate(names)}
        np.add.at(p, (sums.column("gram").to_numpy(), np.array([where[x] for x in sums.column("lang").to_pylist()])), sums.column("n").to_numpy())
        p /= p.sum(axis=0)
    model = spark.sparkContext.broadcast((names, p))

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, p = model.value
        for whole in batches:
            for k in range(0, whole.num_rows, 200):
                b = whole.slice(k, 200)
                doc, gram, n = trigrams(b.column("text"))
                share = infer(doc, gram, n, p, b.num_rows)
                letters = pc.fill_null(pc.match_substring_regex(b.column("text"), r"\p{L}"), False).to_pylist()
                best = share.argmax(axis=1).tolist() if names else []
                ok = [bool(names) and x and share[i].any() for i, x in enumerate(letters)]
                yield pa.RecordBatch.from_arrays([b.column("id"), pa.array([names[best[i]] if x else "und" for i, x in enumerate(ok)], pa.string()), pa.array([float(min(1.0, share[i, best[i]])) if x else 0.0 for i, x in enumerate(ok)])], ["id", "lang_pred", "score"])

    kind = docs.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(predict, f"id {kind}, lang_pred string, score double").withColumnRenamed("id", id_col)
