"""Document quality from a linear-chain conditional random field over lines.

Every line is good or bad; its features are shares of letters, marks, digits, symbols and repeated words
of the line and of the lines beside it, and labels of adjoining lines are tied. Only documents are
labelled, so the lines of a bad document start as bad and are labelled anew by the model
between rounds of fitting (at least its worst line stays bad). A document's quality
is the length-weighted mean of its lines' forward-backward marginals, on a scale
fitted to the labels.

The field is fitted on a bounded sample of labelled rows, chosen by a hash of the id: at most ``sample`` texts that have at most
``lines`` lines together, each of them whole. Every text is scored whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import labelled, saved

#: Classes of bytes whose shares describe a line.
_CLASSES = [b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b"0123456789", b"!?", b"|/\\_<>{}[]=~^", b"#$%&*@+", b".,;:'\"()-", bytes(range(128, 256))]
_OF = np.full(256, len(_CLASSES), np.uint8)
for _i, _c in enumerate(_CLASSES):
    _OF[list(_c)] = _i
_STEPS = np.array([0.005, 0.02, 0.05, 0.1, 0.2, 0.35, 0.6], np.float32)
_MIX = np.random.RandomState(5).randint(1, 2**40, 256, dtype=np.int64)


def line_features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of every line (exact in 16 bits), its length in bytes, and where each text's lines begin (empty texts have one line)."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    joined = "\n".join(texts.to_pylist()).encode() + b"\n"
    raw = np.frombuffer(joined, np.uint8)
    ends = np.flatnonzero(raw == 10)
    starts = np.concatenate([[0], ends[:-1] + 1])
    size = ends - starts
    doc_size = pc.binary_length(texts).to_numpy()
    doc_at = np.concatenate([[0], np.cumsum(doc_size + 1)])
    first = np.searchsorted(starts, doc_at)
    line = np.repeat(np.arange(len(ends)), size + 1)
    kinds = len(_CLASSES) + 1
    counts = np.bincount(line * kinds + _OF[raw], minlength=len(ends) * kinds).reshape(-1, kinds).astype(np.float32)
    # Words by a sum over their bytes: enough to see a word repeated.
    blank = (raw == 32) | ((raw >= 9) & (raw <= 13))
    lead = ~blank & np.concatenate([[True], blank[:-1]])
    at = np.flatnonzero(lead)
    if len(at):
        names = np.add.reduceat(np.where(blank, 0, _MIX[raw]), at)
        own = line[at]
        near = np.concatenate([[False], (names[1:] == names[:-1]) & (own[1:] == own[:-1])])
        n_words = np.bincount(own, minlength=len(ends)).astype(np.float32)
        same = np.bincount(own, near, minlength=len(ends)).astype(np.float32)
        order = np.lexsort((names, own))
        a, b = own[order], names[order]
        again = np.concatenate([[False], (a[1:] == a[:-1]) & (b[1:] == b[:-1])])
        twice = np.bincount(a, again, minlength=len(ends)).astype(np.float32)
    else:
        n_words = same = twice = np.zeros(len(ends), np.float32)
    seen = np.maximum(size, 1).astype(np.float32)
    words = np.maximum(n_words, 1)
    shares = np.column_stack([counts[:, : len(_CLASSES)] / seen[:, None], same / words, twice / words, np.clip(size / words / 20, 0, 1), np.clip(n_words / 60, 0, 1)])
    bins = (shares[:, :, None] > _STEPS).reshape(len(ends), -1).astype(np.float32)
    before, after = np.zeros_like(shares), np.zeros_like(shares)
    before[1:], after[:-1] = shares[:-1], shares[1:]
    edge_first, edge_last = np.zeros(len(ends), np.float32), np.zeros(len(ends), np.float32)
    edge_first[first[:-1]], edge_last[first[1:] - 1] = 1, 1
    before[first[:-1]], after[first[1:] - 1] = 0, 0
    x = np.column_stack([np.ones(len(ends), np.float32), edge_first, edge_last, shares, bins, before, after])
    return x.astype(np.float16).astype(np.float32), size, first


def _products(t: list[np.ndarray], longest: int) -> list[np.ndarray]:
    """For every place the product of the 2x2 matrices up to it, over ``longest`` places at least, scaled.

    ``t``: the entries 00, 01, 10, 11 of all matrices. Stretches double in each step, so a chain of n lines
    takes log2(n) steps over whole arrays.
    """
    d = 1
    while d < longest:
        (a, b, c, e), (p, q, r, s) = [x[:-d] for x in t], [x[d:] for x in t]
        new = [a * p + b * r, a * q + b * s, c * p + e * r, c * q + e * s]
        scale = 1 / (new[0] + new[1] + new[2] + new[3])
        t = [np.concatenate([x[:d], y * scale]) for x, y in zip(t, new, strict=True)]
        d *= 2
    return t


def marginals(emit: np.ndarray, tie: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """P(good) of every line, and the expected number of each pair of adjoining labels (bad 0, good 1).

    Forward and backward sums are running products of a matrix for each line. A chain's first matrix has two equal
    rows, so whatever stands before it in the arrays cancels out.
    """
    n = len(emit)
    if not n:
        return np.zeros(0), np.zeros((2, 2))
    longest = int(np.diff(first).max())
    e0, e1 = np.exp(-np.maximum(emit, 0)), np.exp(np.minimum(emit, 0))  # bad, good, scaled
    m = np.exp(tie - tie.max())
    t = [m[0, 0] * e0, m[0, 1] * e1, m[1, 0] * e0, m[1, 1] * e1]
    head = first[:-1]
    for k, e in enumerate((e0, e1, e0, e1)):
        t[k][head] = e[head]
    fore = _products(t, longest)
    # From the end: the transposed matrices in reverse.
    back = [x[::-1] for x in _products([t[k][::-1] for k in (0, 2, 1, 3)], longest)]
    a0, a1 = fore[0], fore[1]
    b0, b1 = np.ones(n), np.ones(n)
    b0[:-1], b1[:-1] = (back[0] + back[2])[1:], (back[1] + back[3])[1:]
    good = a1 * b1 / (a0 * b0 + a1 * b1)
    inner = np.ones(n, bool)
    inner[head] = False
    y = np.flatnonzero(inner)
    x = y - 1
    both = [a[x] * m[i, j] * e[y] * b[y] for i, a in enumerate((a0, a1)) for j, (e, b) in enumerate(((e0, b0), (e1, b1)))]
    scale = 1 / sum(both) if len(y) else 0
    return good, np.array([(v * scale).sum() for v in both]).reshape(2, 2)


def fit(x: np.ndarray, size: np.ndarray, first: np.ndarray, label: np.ndarray, rounds: int = 3, steps: int = 120, ridge: float = 1e-3) -> tuple[np.ndarray, np.ndarray, float, float]:
    """Line weights, ties of adjoining labels, and the scale (slope, shift) of a document's score."""
    bad, good = int((label == 0).sum()), int((label == 1).sum())
    flat = (np.zeros(x.shape[1]), np.zeros((2, 2)), 0.0, float(np.log((good + 0.5) / (bad + 0.5))))
    if not bad or not good:
        return flat
    doc = np.repeat(np.arange(len(label)), np.diff(first))
    y = label[doc].astype(float)
    # Each class counts the same, so that rare bad documents are learned as well.
    weight = np.where(label == 1, 0.5 / good, 0.5 / bad)[doc] / np.diff(first)[doc]
    chain = (doc[1:] == doc[:-1]).nonzero()[0]
    w, tie = np.zeros(x.shape[1]), np.zeros((2, 2))
    product = lambda w: x @ w.astype(x.dtype)
    for turn in range(rounds):
        mw, vw, mt, vt = np.zeros_like(w), np.zeros_like(w), np.zeros_like(tie), np.zeros_like(tie)
        seen = np.zeros((2, 2))
        np.add.at(seen, (y[chain].astype(int), y[chain + 1].astype(int)), 1)
        for k in range(1, steps + 1):
            p, pairs = marginals(product(w), tie, first)
            gw = ((y - p) * weight).astype(x.dtype) @ x - ridge * w
            gt = (seen - pairs) / max(1, len(chain)) - ridge * tie
            mw, vw = 0.9 * mw + 0.1 * gw, 0.99 * vw + 0.01 * gw * gw
            mt, vt = 0.9 * mt + 0.1 * gt, 0.99 * vt + 0.01 * gt * gt
            rate = 0.1 * (1 - k / (steps + 1))
            w = w + rate * (mw / (1 - 0.9**k)) / (np.sqrt(vw / (1 - 0.99**k)) + 1e-8)
            tie = tie + rate * (mt / (1 - 0.9**k)) / (np.sqrt(vt / (1 - 0.99**k)) + 1e-8)
        if turn + 1 < rounds:
            p, _ = marginals(product(w), tie, first)
            worst = np.minimum.reduceat(p, first[:-1])[doc]
            y = np.where(label[doc] == 1, 1.0, ((p > 0.5) & (p > worst)).astype(float))
    p, _ = marginals(product(w), tie, first)
    q = document_share(p, size, first)
    slope, shift = 1.0, 0.0
    for _ in range(50):  # Newton steps of a logistic scale
        z = 1 / (1 + np.exp(-np.clip(slope * q + shift, -30, 30)))
        d = np.array([((label - z) * q).sum() - 0.01 * slope, (label - z).sum() - 0.01 * shift])
        v = z * (1 - z)
        h = np.array([[(v * q * q).sum() + 0.01, (v * q).sum()], [(v * q).sum(), v.sum() + 0.01]])
        move = np.linalg.solve(h, d)
        slope, shift = slope + np.clip(move[0], -2, 2), shift + np.clip(move[1], -2, 2)
    return w, tie, slope, shift


def document_share(p: np.ndarray, size: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The length-weighted mean of the lines' marginals."""
    w = size + 1e-3
    return np.add.reduceat(p * w, first[:-1]) / np.add.reduceat(w, first[:-1]) if len(first) > 1 else np.zeros(0)


def quality(docs: DataFrame, labels: DataFrame, train: Column, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", sample: int = 6_000, lines: int = 300_000, carry: list[str] | None = None, score_col: str = "score") -> DataFrame:
    """``docs`` with a column ``score_col`` in [0, 1], higher for good documents (it replaces one of that name).

    ``train`` says which rows' labels may be learned. Rows without a label are not learned from, nor ids whose
    labels disagree; of rows that repeat an id one is learned from. At most ``sample`` texts are learned from, whole, and at most ``lines`` lines
    in all: by a hash of the id, texts are taken while they fit, and one of more than a twentieth of the lines isn't. A null text
    counts as one empty line. Repeated ids are separate rows; other columns pass through (``carry``: only these). An
    empty table gives an empty result; without labels of both kinds all texts get the
    smoothed rate.
    """
    spark = docs.sparkSession
    docs = docs.drop(score_col)
    known = saved(labelled(docs, labels, train, id_col, text_col, label_col, sample).withColumn("n", F.regexp_count(F.coalesce("text", F.lit("")), F.lit("\n")) + 1))
    # One row of an id and a number for each of at most ``sample`` texts.
    before = F.sum("n").over(Window.orderBy(F.xxhash64("id"), "id"))
    fits = known.where(F.col("n") <= lines // 20).select("id", "n").withColumn("upto", before).where(F.col("upto") <= lines)
    known = known.join(F.broadcast(fits.select("id")), "id").select("id", "text", "label")

    def featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for k in range(0, whole.num_rows, 500):
                b = whole.slice(k, 500)
                x, size, first = line_features(b.column("text"))
                spans = list(zip(first[:-1].tolist(), first[1:].tolist(), strict=True))
                yield pa.RecordBatch.from_arrays([b.column("id"), b.column("label"), pa.array([x[lo:hi].astype("<f2").tobytes() for lo, hi in spans], pa.binary()), pa.array([size[lo:hi] for lo, hi in spans], pa.list_(pa.int64()))], ["id", "label", "x", "size"])

    kind = known.schema["id"].dataType.simpleString()
    got = known.mapInArrow(featurise, f"id {kind}, label int, x binary, size array<bigint>").toArrow().sort_by("id").to_pylist()
    width = line_features(pa.array(["a"]))[0].shape[1]
    n = [len(r["size"]) for r in got]
    x = np.frombuffer(b"".join(r["x"] for r in got), "<f2").reshape(-1, width).astype(np.float32)
    size = np.array([s for r in got for s in r["size"]])
    model = spark.sparkContext.broadcast(fit(x, size, np.concatenate([[0], np.cumsum(n)]).astype(np.int64), np.array([r["label"] for r in got], int)))
    at = docs.columns.index(text_col)
    carried = [docs.columns.index(c) for c in (docs.columns if carry is None else carry)]
    schema = docs.select(*[F.col(f"`{docs.columns[i]}`") for i in carried]).schema.add(score_col, "double")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, tie, slope, shift = model.value
        for whole in batches:
            for k in range(0, whole.num_rows, 500):
                b = whole.slice(k, 500)
                x, size, first = line_features(b.column(at))
                p, _ = marginals(x @ w.astype(x.dtype), tie, first)
                z = slope * document_share(p, size, first) + shift
                yield pa.RecordBatch.from_arrays([*[b.column(i) for i in carried], pa.array(1 / (1 + np.exp(-np.clip(z, -30, 30))))], schema.names)

    # By place, since a name may hold a dot.
    return docs.toDF(*[f"c{i}" for i in range(len(docs.columns))]).mapInArrow(score, schema)
