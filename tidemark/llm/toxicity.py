"""Toxicity by a counterfactually regularised classifier.

A logistic model over the distinct words of a text and the beginnings of these words (which
carry inflected forms). In labelled sentences identity terms are swapped for others of their kind;
the squared difference of the two scores is penalised, so that a score does not hang on
which group a sentence mentions. Where a labelled text mentions none, a pair of terms is set in.

The model is fitted on a bounded sample of the labelled rows (``sample``), chosen by a hash
of the id; every text is scored whole. Words that tell the classes apart are counted and picked by
Spark, and only these reach the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import labelled, saved

BUCKETS = 1 << 20
#: Standard errors by which a bucket's rates in both classes differ at least.
KEPT_Z = 4.0

#: Identity terms by kind; each may stand for another of its line.
IDENTITY = (
    ("women", "men", "girls", "boys", "frauen", "männer", "femmes", "hommes", "mujeres", "hombres"),
    ("woman", "man", "girl", "boy", "frau", "mann", "femme", "homme", "mujer", "hombre"),
    ("christians", "muslims", "jews", "hindus", "buddhists", "atheists"),
    ("christian", "muslim", "jewish", "hindu", "buddhist", "atheist", "catholic", "protestant"),
    ("black", "white", "asian", "african", "european", "latino", "arab", "indigenous"),
    ("gay", "lesbian", "straight", "bisexual", "transgender", "queer"),
    ("immigrants", "refugees", "natives", "foreigners", "ausländer", "immigrés", "inmigrantes"),
    ("mexican", "chinese", "american", "german", "french", "spanish", "russian", "indian", "turkish"),
    ("disabled", "blind", "deaf", "healthy"),
    ("old", "young", "elderly"),
)
_KIND = {w: k for k, line in enumerate(IDENTITY) for w in line}
_EDGE = "".join(map(chr, range(33, 48))) + ":;<=>?@[\\]^_`{|}~«»“”„‘’…–—¡¿"


def word_features(word: str) -> list[int]:
    """Buckets of a word and of its first four and five letters."""
    word = word.strip(_EDGE)
    if not word:
        return []
    parts = {f"w{word}"} | {f"{n}{word[:n]}" for n in (4, 5) if len(word) > n}
    return [xxhash.xxh3_64_intdigest(p) % BUCKETS for p in parts]


def _words(texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The batch's distinct words in lower case, the word at each place, and where each text begins."""
    split = pc.utf8_split_whitespace(pc.utf8_lower(pc.fill_null(texts.cast(pa.large_string()), "")))
    code = split.flatten().dictionary_encode()
    offsets = split.offsets.to_numpy().astype(np.int64)
    return code.dictionary.to_pylist(), code.indices.to_numpy(), offsets - offsets[0]


def set_in(number: int) -> tuple[str, str]:
    """Two terms of a kind; the kind and both terms come from separate bits of a hash of the number."""
    h = xxhash.xxh3_64_intdigest(str(number))
    line = IDENTITY[(h >> 32) % len(IDENTITY)]
    first, step = (h & 0xFFFF) % len(line), 1 + (h >> 16 & 0xFFFF) % (len(line) - 1)
    return line[first], line[(first + step) % len(line)]


def _swaps(text: str, number: int) -> list[tuple[list[int], list[int]]]:
    """Features of all sentences with identity terms, as they stand and with the terms swapped; ``number`` (a hash of the text) picks the terms."""
    out = []
    for n, s in enumerate(x for x in text.lower().replace("\n", ".").split(".") if x):
        words = [w.strip(_EDGE) for w in s.split()]
        at = [i for i, w in enumerate(words) if w in _KIND]
        if at:
            other = list(words)
            for i in at:
                line = IDENTITY[_KIND[words[i]]]
                other[i] = line[(line.index(words[i]) + 1 + (number + n) % (len(line) - 1)) % len(line)]
            out.append(tuple([f for w in set(x) for f in word_features(w)] for x in (words, other)))
    if not out:
        a, b = set_in(number)
        out.append((word_features(a), word_features(b)))
    return out


class _Sample(NamedTuple):
    """Labels; row and bucket of each occurrence; pair, sign and bucket of each occurrence in a swap; their number and penalty."""

    y: np.ndarray
    row: np.ndarray
    col: np.ndarray
    pk: np.ndarray
    ps: np.ndarray
    pf: np.ndarray
    swaps: int
    even: float


def penalised(d: _Sample, w: np.ndarray, b: float) -> tuple[float, np.ndarray, float]:
    """The mean logistic loss plus ``even`` times the mean squared score change of swaps, and its slopes in w and b."""
    n = len(d.y)
    z = np.clip(b + np.bincount(d.row, w[d.col], n), -30, 30)
    r = 1 / (1 + np.exp(-z)) - d.y
    g = np.bincount(d.col, r[d.row], len(w)) / n
    loss = float(np.mean(np.logaddexp(0, z) - d.y * z))
    if len(d.pk):
        change = np.bincount(d.pk, d.ps * w[d.pf], d.swaps)
        g += 2 * d.even * np.bincount(d.pf, d.ps * change[d.pk], len(w)) / d.swaps
        loss += d.even * float(change @ change) / d.swaps
    return loss, g, float(r.mean())


def fit(rows: list[dict], kept_z: float = KEPT_Z, sparse: float = 0.5, even: float = 1.0, steps: int = 1500) -> tuple[np.ndarray, np.ndarray, float]:
    """Buckets, their weights and the intercept, from rows of label, features and swaps.

    Buckets whose rates in both classes differ by ``kept_z`` standard errors are kept; the weights are fitted
    by accelerated proximal steps, scaled by bucket, with an absolute penalty of ``sparse`` standard
    errors of the slope and the penalty ``even`` on swaps.
    Without rows of both classes all weights are 0 and the intercept gives the smoothed rate.
    """
    y = np.array([r["label"] for r in rows], float)
    n, good, bad = len(y), int((y == 0).sum()), int((y == 1).sum())
    base = float(np.log((bad + 0.5) / (good + 0.5)))
    none = (np.zeros(0, np.int64), np.zeros(0), base)
    if not good or not bad:
        return none
    sizes = np.array([len(r["features"]) for r in rows])
    flat = np.concatenate([np.asarray(r["features"], np.int64) for r in rows]) if sizes.sum() else np.zeros(0, np.int64)
    row = np.repeat(np.arange(n), sizes)
    pos = np.bincount(flat[y[row] == 1], minlength=BUCKETS)
    neg = np.bincount(flat[y[row] == 0], minlength=BUCKETS)
    p = (pos + neg) / n
    z = (pos / bad - neg / good) / np.sqrt(np.maximum(p * (1 - p), 1e-12) * (1 / bad + 1 / good))
    kept = np.flatnonzero((np.abs(z) >= kept_z) & (pos + neg >= 2))
    if not len(kept):
        return none
    place = np.full(BUCKETS, -1)
    place[kept] = np.arange(len(kept))
    use = place[flat] >= 0
    col, row = place[flat[use]], row[use]
    pairs = [(k, sign, place[f]) for k, (a, b) in enumerate(p for r in rows for p in r["swaps"]) for sign, fs in ((1, a), (-1, b)) for f in fs if place[f] >= 0]
    pk, ps, pf = (np.array(x) for x in zip(*pairs, strict=True)) if pairs else (np.zeros(0, int), np.zeros(0), np.zeros(0, int))
    count = max(1, sum(len(r["swaps"]) for r in rows))

    d = _Sample(y, row, col, pk, ps, pf, count, even)
    # A bound on the curvature: a row adds its number of buckets to each of them.
    wide = np.bincount(row, minlength=n)
    bend = 0.25 * np.bincount(col, wide[row] + 1.0, len(kept)) / n
    if len(pk):
        bend += 2 * even * np.bincount(pf, np.bincount(pk, minlength=count)[pk], len(kept)) / count
    step, rate = 1 / bend, bad / n
    toll = sparse * np.sqrt(p[kept] * rate * (1 - rate) / n)
    w, b, v, c, t = np.zeros(len(kept)), base, np.zeros(len(kept)), base, 1.0
    for _ in range(steps):
        _, g, gb = penalised(d, v, c)
        new = v - step * g
        new = np.sign(new) * np.maximum(np.abs(new) - step * toll, 0)
        nb, nt = c - gb, (1 + np.sqrt(1 + 4 * t * t)) / 2
        v, c = new + (t - 1) / nt * (new - w), nb + (t - 1) / nt * (nb - b)
        w, b, t = new, nb, nt
    on = np.flatnonzero(w)
    return kept[on], w[on], b


def toxicity(docs: DataFrame, labels: DataFrame, train: Column, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", sample: int = 10_000, even: float = 1.0) -> DataFrame:
    """One row per document: id, score in [0, 1].

    ``train`` says which rows' labels may be learned. Rows without a label are not learned from, nor ids whose
    labels disagree; of rows that repeat an id one is learned from, of at most ``sample`` ids. ``even``: the weight of
    the penalty on score changes of swapped sentences. A
    null or empty text has the intercept's score. Repeated ids are separate rows; ids may be of any type; other
    columns are ignored. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for k in range(0, whole.num_rows, 500):
                b = whole.slice(k, 500)
                vocab, code, offsets = _words(b.column("text"))
                own = [word_features(w) for w in vocab]
                feats, pairs = [], []
                for text, lo, hi in zip(b.column("text").to_pylist(), offsets[:-1], offsets[1:], strict=True):
                    feats.append(sorted({f for c in set(code[lo:hi].tolist()) for f in own[c]}))
                    pairs.append([list(p) for p in _swaps(text or "", xxhash.xxh3_64_intdigest(text or ""))])
                yield pa.RecordBatch.from_arrays([b.column("id"), b.column("label"), pa.array(feats, pa.list_(pa.int32())), pa.array(pairs, pa.list_(pa.list_(pa.list_(pa.int32()))))], ["id", "label", "features", "swaps"])

    chosen = labelled(docs, labels, train, id_col, text_col, label_col, sample)
    kind = chosen.schema["id"].dataType.simpleString()
    shape = f"id {kind}, label int, features array<int>, swaps array<array<array<int>>>"
    seen = saved(chosen.mapInArrow(featurise, shape))
    total = seen.agg(F.count("*").alias("n"), F.coalesce(F.sum("label"), F.lit(0)).alias("bad")).first()
    n, bad = total["n"], total["bad"]
    known: list[dict] = [{"label": int(k < bad), "features": [], "swaps": []} for k in range(n)]
    if 0 < bad < n:
        counts = seen.select("label", F.explode("features").alias("f")).groupBy("f").agg(F.count("*").alias("c"), F.sum("label").alias("pos"))
        p = F.col("c") / n
        z = (F.col("pos") / bad - (F.col("c") - F.col("pos")) / (n - bad)) / F.sqrt(F.greatest(p * (1 - p), F.lit(1e-12)) * (1 / bad + 1 / (n - bad)))
        # At most BUCKETS numbers.
        telling = spark.sparkContext.broadcast(np.sort(np.array([r.f for r in counts.where(F.abs(z) >= KEPT_Z - 1e-6).select("f").collect()], np.int32)))

        def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            among = set(telling.value.tolist())
            for b in batches:
                feats = [[f for f in fs if f in among] for fs in b.column("features").to_pylist()]
                pairs = [[[[f for f in side if f in among] for side in pair] for pair in ps] for ps in b.column("swaps").to_pylist()]
                yield pa.RecordBatch.from_arrays([b.column("id"), b.column("label"), pa.array(feats, pa.list_(pa.int32())), pa.array(pairs, pa.list_(pa.list_(pa.list_(pa.int32()))))], ["id", "label", "features", "swaps"])

        known = seen.mapInArrow(pick, shape).toArrow().sort_by("id").to_pylist()
    buckets, weights, intercept = fit(known, even=even)
    model = spark.sparkContext.broadcast((dict(zip(buckets.tolist(), weights.tolist(), strict=True)), intercept))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight, base = model.value
        seen: dict[str, tuple] = {}
        for whole in batches:
            for k in range(0, whole.num_rows, 1000):
                b = whole.slice(k, 1000)
                vocab, code, offsets = _words(b.column("text"))
                if len(seen) > 500_000:
                    seen.clear()
                own = []
                for w in vocab:
                    f = seen.get(w)
                    if f is None:
                        f = seen[w] = tuple(x for x in word_features(w) if x in weight)
                    own.append(f)
                tells = np.flatnonzero(np.array([bool(f) for f in own], bool)[code]) if len(code) else np.zeros(0, int)
                found: list[set] = [set() for _ in range(b.num_rows)]
                for d, c in zip((np.searchsorted(offsets, tells, "right") - 1).tolist(), code[tells].tolist(), strict=True):
                    found[d].update(own[c])
                logit = np.array([base + sum(weight[f] for f in sorted(s)) for s in found], float)
                yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(1 / (1 + np.exp(-np.clip(logit, -30, 30))))], ["id", "score"])

    kind = docs.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(score, f"id {kind}, score double").withColumnRenamed("id", id_col)
