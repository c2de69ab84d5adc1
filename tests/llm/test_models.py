"""The models against plain versions: gradients, features, marginals, mixtures; and what they are fitted on."""

from __future__ import annotations

import math
import random

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from tidemark.llm import language as lang
from tidemark.llm import quality as q
from tidemark.llm import toxicity as tox

# --- toxicity ----------------------------------------------------------------------------------


def test_slope_of_the_penalised_loss_equals_differences():
    rng = np.random.RandomState(1)
    n, m = 40, 6
    row, col = np.repeat(np.arange(n), 3), rng.randint(0, m, 3 * n)
    pk, pf = np.repeat(np.arange(10), 4), rng.randint(0, m, 40)
    d = tox._Sample(rng.randint(0, 2, n).astype(float), row, col, pk, np.tile([1, 1, -1, -1], 10), pf, 10, 0.7)
    w, b, h = rng.standard_normal(m), 0.3, 1e-6
    _, g, gb = tox.penalised(d, w, b)
    near = [(tox.penalised(d, w + h * e, b)[0] - tox.penalised(d, w - h * e, b)[0]) / (2 * h) for e in np.eye(m)]
    assert np.allclose(g, near, atol=1e-7)
    assert abs(gb - (tox.penalised(d, w, b + h)[0] - tox.penalised(d, w, b - h)[0]) / (2 * h)) < 1e-7


@pytest.mark.parametrize("even", [0.0, 1.0])
def test_toxicity_fit_reaches_its_optimum(monkeypatch, even):
    """At the weights found no slope is left beyond the absolute penalty."""
    rng = np.random.RandomState(5)
    n, buckets = 400, np.array([3, 8, 21, 34, 55, 89])
    y = rng.randint(0, 2, n)
    share = np.array([[0.1, 0.8, 0.3, 0.6, 0.5, 0.2], [0.6, 0.3, 0.5, 0.4, 0.1, 0.5]])[y]
    has = rng.random_sample((n, 6)) < share
    swaps = [[([3, 21], [8])] if i % 3 == 0 else [] for i in range(n)]
    rows = [{"label": int(y[i]), "features": buckets[has[i]].tolist(), "swaps": swaps[i]} for i in range(n)]
    seen, plain = [], tox.penalised
    monkeypatch.setattr(tox, "penalised", lambda d, w, b: (seen.append(d), plain(d, w, b))[1])
    kept, w, b = tox.fit(rows, kept_z=0.0, even=even)
    full = np.zeros(6)
    full[np.searchsorted(buckets, kept)] = w
    loss, g, gb = plain(seen[0], full, b)
    rate = y.mean()
    toll = 0.5 * np.sqrt(has.mean(0) * rate * (1 - rate) / n)
    left = np.where(full != 0, np.abs(g + toll * np.sign(full)), np.maximum(np.abs(g) - toll, 0))
    assert np.count_nonzero(full) >= 4 and left.max() < 1e-6 and abs(gb) < 1e-6
    for _ in range(50):
        near = full + rng.standard_normal(6) * 0.05
        assert plain(seen[0], near, b)[0] + toll @ np.abs(near) > loss + toll @ np.abs(full)


def _mentions(spark, n=900):
    """Toxic texts mention one group far more often than neutral ones do; the other group the other way round."""
    pick = random.Random(3)
    fill = [f"word{i}" for i in range(60)]
    rows, labels = [], []
    for i in range(n):
        bad = i % 3 == 0
        group = pick.choices(["muslims", "christians"], [9, 1] if bad else [1, 9])[0]
        words = [*pick.choices(fill, k=12), group, *(["vermin"] if bad and pick.random() < 0.5 else [])]
        pick.shuffle(words)
        rows.append((i, " ".join(words) + "."))
        labels.append((i, int(bad)))
    neutral = [(n + i, " ".join([*pick.choices(fill, k=12), "muslims"]) + ".") for i in range(200)]
    return spark.createDataFrame(rows + neutral, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int"), n


def test_neutral_mentions_of_a_group_get_fewer_false_alarms(spark):
    docs, labels, n = _mentions(spark)
    score = {even: {r.doc_id: r.score for r in tox.toxicity(docs, labels, F.lit(True), even=even).collect()} for even in (0.0, 1.0)}
    alarms = {even: sum(s[i] >= 0.5 for i in range(n, n + 200)) for even, s in score.items()}
    assert alarms[0.0] >= 150 and alarms[1.0] <= 20


def test_toxicity_of_text_ids_and_clashing_labels(spark):
    docs, labels, n = _mentions(spark, 300)
    want = {r.doc_id: r.score for r in tox.toxicity(docs, labels, F.lit(True)).collect()}
    named = lambda df: df.withColumn("doc_id", F.format_string("%05d", "doc_id"))
    got = {int(r.doc_id): r.score for r in tox.toxicity(named(docs).repartition(5), named(labels), F.lit(True)).collect()}
    assert all(abs(got[i] - want[i]) < 1e-9 for i in want)  # the id has no part in the fit, nor has the order of the rows
    # A label that is contradicted is not learned from, nor are repeats of an id learned from twice.
    both = labels.union(labels.where("doc_id < 30").withColumn("toxic", 1 - F.col("toxic")))
    a = {r.doc_id: r.score for r in tox.toxicity(docs, both, F.lit(True)).collect()}
    b = {r.doc_id: r.score for r in tox.toxicity(docs, labels.where("doc_id >= 30"), F.lit(True)).collect()}
    assert a == b
    twice = tox.toxicity(docs.union(docs.where("doc_id < 50")), labels, F.lit(True)).collect()
    assert {r.doc_id: r.score for r in twice} == want and len(twice) == docs.count() + 50


def test_scores_equal_plain_python(spark):
    """The whole operator: features word by word, the same fit, a logit of the distinct features."""
    docs, labels, n = _mentions(spark, 300)
    docs = docs.union(spark.createDataFrame([(9000, None), (9001, ""), (9002, "Vermin, VERMIN word1! muslims")], docs.schema))
    label = {r.doc_id: r.toxic for r in labels.collect()}
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    features = {i: {f for w in set(t.lower().split()) for f in tox.word_features(w)} for i, t in texts.items()}
    rows = [{"label": label[i], "features": sorted(features[i]), "swaps": tox._swaps(texts[i], xxhash.xxh3_64_intdigest(texts[i]))} for i in sorted(label)]
    buckets, weights, base = tox.fit(rows)
    weight = dict(zip(buckets.tolist(), weights.tolist()))
    want = {i: 1 / (1 + math.exp(-(base + sum(weight.get(f, 0) for f in fs)))) for i, fs in features.items()}
    got = {r.doc_id: r.score for r in tox.toxicity(docs.repartition(3), labels, F.lit(True)).collect()}
    assert got.keys() == want.keys() and all(abs(got[i] - want[i]) < 1e-9 for i in want) and len(weight) >= 2


# --- quality -----------------------------------------------------------------------------------


def plain_lines(text: str) -> tuple[list[list[float]], list[int]]:
    """The features and lengths of a text's lines, line by line."""
    shares, sizes = [], []
    for line in (text or "").split("\n"):
        raw = line.encode()
        names = [sum(int(q._MIX[b]) for b in w) for w in raw.split()]
        n = len(names)
        near = sum(a == b for a, b in zip(names, names[1:]))
        row = [sum(b in c for b in raw) / max(len(raw), 1) for c in q._CLASSES]
        row += [near / max(n, 1), (n - len(set(names))) / max(n, 1), min(1.0, len(raw) / max(n, 1) / 20), min(1.0, n / 60)]
        shares.append([float(np.float32(x)) for x in row])
        sizes.append(len(raw))
    none, out = [0.0] * len(shares[0]), []
    for i, s in enumerate(shares):
        bins = [float(np.float32(x) > t) for x in s for t in q._STEPS]
        row = [1.0, float(i == 0), float(i == len(shares) - 1), *s, *bins, *(shares[i - 1] if i else none), *(shares[i + 1] if i + 1 < len(shares) else none)]
        out.append([float(np.float16(np.float32(x))) for x in row])
    return out, sizes


def plain_share(x: list[list[float]], sizes: list[int], w: np.ndarray, tie: np.ndarray) -> float:
    """The length-weighted mean of P(good), by forward and backward sums line by line."""
    e = [(1.0, math.exp(sum(a * b for a, b in zip(row, w.tolist())))) for row in x]
    m = np.exp(tie)
    fore, back = [np.array(e[0])], [np.ones(2)]
    for v in e[1:]:
        fore.append((fore[-1] @ m) * np.array(v))
        fore[-1] /= fore[-1].sum()
    for v in e[:0:-1]:
        back.append(m @ (np.array(v) * back[-1]))
        back[-1] /= back[-1].sum()
    p = [float(a[1] * b[1] / (a @ b)) for a, b in zip(fore, back[::-1])]
    weight = [s + 1e-3 for s in sizes]
    return sum(a * b for a, b in zip(p, weight)) / sum(weight)


def _texts(seed, n):
    pick = random.Random(seed)
    good = lambda: " ".join(pick.choice(["the", "river", "quiet", "walks", "along", "green", "stone", "Evening"]) for _ in range(pick.randrange(3, 14))) + "."
    bad = lambda: pick.choice(["CLICK HERE!!! >>> $$$", "buy buy buy buy buy", "|||| ==== 1234 5678 ####", "a a a a a a a"])
    return [("\n".join(bad() if i % 2 and pick.random() < 0.8 else good() for _ in range(pick.randrange(1, 9))), int(i % 2 == 0)) for i in range(n)]


def test_features_marginals_and_scores_equal_plain_python():
    texts = [t for t, _ in _texts(1, 40)] + ["", None, "\n\n", "a a a b a\n  x\t\x0b x", "é€🙂 " * 30, "one line\r"]
    x, size, first = q.line_features(pa.array(texts))
    plain = [plain_lines(t) for t in texts]
    assert np.diff(first).tolist() == [len(s) for _, s in plain] and size.tolist() == [v for _, s in plain for v in s]
    assert np.allclose(x, [r for rows, _ in plain for r in rows], atol=1e-3)
    rng = np.random.RandomState(2)
    w, tie = rng.standard_normal(x.shape[1]), rng.standard_normal((2, 2))
    p, pairs = q.marginals(x.astype(float) @ w, tie, first)
    assert np.allclose(q.document_share(p, size, first), [plain_share(rows, s, w, tie) for rows, s in plain], atol=1e-3)
    assert abs(pairs.sum() - (len(x) - len(texts))) < 1e-6


def test_a_long_chain_of_lines():
    """No step for each line: 100,000 lines, with emissions far from 0."""
    rng = np.random.RandomState(3)
    emit, tie = rng.standard_normal(100_000) * 20, np.array([[2.0, -3], [-1, 1]])
    p, pairs = q.marginals(emit, tie, np.array([0, 100_000]))
    assert np.isfinite(p).all() and abs(pairs.sum() - 99_999) < 1e-3
    near, _ = q.marginals(emit[50_000:50_400], tie, np.array([0, 400]))
    assert np.allclose(p[50_100:50_300], near[100:300])


def test_quality_fit_reaches_its_optimum():
    """Of the field's weights next to no slope is left, of the scale of scores none."""
    texts = _texts(6, 80)
    x, size, first = q.line_features(pa.array([t for t, _ in texts]))
    label = np.array([y for _, y in texts])
    w, tie, slope, shift = q.fit(x, size, first, label, rounds=1)
    doc = np.repeat(np.arange(len(label)), np.diff(first))
    weight = np.where(label == 1, 0.5 / label.sum(), 0.5 / (1 - label).sum())[doc] / np.diff(first)[doc]

    def left(w, tie):
        p, _ = q.marginals(x.astype(float) @ w, tie, first)
        return p, ((label[doc] - p) * weight) @ x - 1e-3 * w

    p, g = left(w, tie)
    assert np.abs(g).max() < 0.02 * np.abs(left(0 * w, 0 * tie)[1]).max()
    share = q.document_share(p, size, first)
    z = 1 / (1 + np.exp(-(slope * share + shift)))
    assert abs(((label - z) * share).sum() - 0.01 * slope) < 1e-3 and abs((label - z).sum() - 0.01 * shift) < 1e-3


def test_quality_learns_from_a_bounded_number_of_lines(spark):
    rows = [(i, t) for i, (t, _) in enumerate(_texts(4, 60))] + [(100, "\n".join(["fine line of text"] * 5000)), (101, "\n".join(["BUY!!! $$$ ###"] * 5000))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, (_, y) in enumerate(_texts(4, 60))] + [(100, 1), (101, 0)], "doc_id long, quality int")
    for lines in (200_000, 2000):  # the two long texts are learned from, whole, or not at all
        score = {r.doc_id: r.score for r in q.quality(docs, labels, F.lit(True), lines=lines).collect()}
        assert sum((score[i] >= 0.7) == bool(y) for i, (_, y) in enumerate(_texts(4, 60))) >= 55 and score[101] < 0.7
        assert lines == 2000 or score[100] > 0.7


def test_quality_learns_from_all_lines_of_its_texts(spark):
    """Junk only at the beginning, in the middle or at the end of long texts, of which held-out ones are found."""
    import random

    pick = random.Random(4)
    good = lambda n: [" ".join(pick.choice(["the", "river", "ran", "under", "old", "stone", "bridges", "and", "then"]) for _ in range(9)) + "." for _ in range(n)]
    junk = lambda n: ["$$$ BUY!!! 777 || >>> CLICK ### " * 2 for _ in range(n)]
    texts, at = [], {}
    for i in range(240):
        place = i % 4
        lines = good(600) if place == 0 else {1: junk(60) + good(540), 2: good(270) + junk(60) + good(270), 3: good(540) + junk(60)}[place]
        at[i] = place
        texts.append((i, "\n".join(lines), int(place == 0)))
    docs = spark.createDataFrame([(i, t) for i, t, _ in texts], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in texts], "doc_id long, quality int")
    scored = q.quality(docs, labels, F.col("doc_id") < 160, carry=["doc_id"]).collect()
    for place in range(4):
        own = [r.score >= 0.7 for r in scored if r.doc_id >= 160 and at[r.doc_id] == place]
        assert sum(own) >= 16 if place == 0 else sum(own) <= 1, place  # of 20


# --- language ----------------------------------------------------------------------------------


def plain_mixture(grams: list[tuple[int, int]], p: np.ndarray, penalty: float = 4.0, steps: int = 12) -> np.ndarray:
    """The language set by penalised likelihood, proportions by expectation-maximisation, one gram at a time."""
    total = sum(n for _, n in grams)
    like = lambda share: sum(n * math.log(sum(share[k] * p[g, k] for k in range(len(share)))) for g, n in grams)
    k = max(range(p.shape[1]), key=lambda k: sum(n * math.log(p[g, k]) for g, n in grams))
    share = np.eye(p.shape[1])[k]
    while True:
        slope = [0 if share[k] else sum(n * p[g, k] / sum(share * p[g]) for g, n in grams) / total for k in range(len(share))]
        add = int(np.argmax(slope))
        if slope[add] <= 1:
            return share
        trial = share * 0.7
        trial[add] = 0.3
        for _ in range(steps):
            got = np.zeros(len(share))
            for g, n in grams:
                r = trial * p[g]
                got += n * r / r.sum()
            trial = got / total
        if like(trial) - like(share) <= penalty * math.log(max(total, 2)):
            return share
        share = trial


def test_mixtures_equal_plain_expectation_maximisation():
    rng = np.random.RandomState(5)
    p = rng.dirichlet([0.05] * 400, 3).T + 1e-6
    p /= p.sum(axis=0)
    texts, truth = [], []
    for i in range(30):
        share = [[1, 0, 0], [0.5, 0.5, 0], [0.2, 0, 0.8], [0.34, 0.33, 0.33]][i % 4]
        counts = sum(rng.multinomial(int(300 * s), p[:, k]) for k, s in enumerate(share))
        texts.append([(int(g), int(counts[g])) for g in np.flatnonzero(counts)])
        truth.append(share)
    doc = np.repeat(np.arange(30), [len(t) for t in texts])
    gram, n = (np.array([v[k] for t in texts for v in t]) for k in (0, 1))
    got = lang.infer(doc, gram, n, p, 31)
    assert np.allclose(got[:30], [plain_mixture(t, p) for t in texts]) and not got[30].any()
    assert np.abs(got[:30] - truth).max() < 0.15


def plain_grams(text: str) -> dict[int, int]:
    """Counts of a text's trigrams of bytes, all that is no letter being one gap."""
    out, said = {}, bytearray(b" ")
    for b in (text or "").lower().encode() + b" ":
        b = b if 97 <= b <= 122 or b >= 128 else 32
        if b != 32 or said[-1] != 32:
            said.append(b)
    for a, b, c in zip(said, said[1:], said[2:]):
        h = ((a * 0x9E3779B1) ^ (b * 0x85EBCA6B) ^ (c * 0xC2B2AE35)) % 2**32 >> 16
        out[h] = out.get(h, 0) + 1
    return out


def test_languages_equal_plain_python(spark):
    pick = random.Random(6)
    words = {"en": "the quick fox jumps over and runs home with it".split(), "fr": "le renard brun saute et court chez lui été".split(), "de": "der schnelle fuchs springt über und rennt heim".split()}
    say = lambda *langs: " ".join(pick.choice(words[x]) for x in langs for _ in range(pick.randrange(5, 30)))
    rows = [(i, say(x), x) for i, x in enumerate(["en", "fr", "de"] * 15)] + [(100 + i, say(*x), None) for i, x in enumerate([("en", "fr"), ("de",), ("de", "en", "fr"), ("fr", "de")] * 4)] + [(200, None, None), (201, "", None), (202, "12 !", None), (203, "x", "de")]
    names = sorted(words)
    p = np.full((lang.BUCKETS, 3), 0.5)
    for _, t, x in rows:
        if x:
            for g, n in plain_grams(t).items():
                p[g, names.index(x)] += n
    p /= p.sum(axis=0)
    want = {}
    for i, t, _ in rows:
        share = plain_mixture(sorted(plain_grams(t).items()), p) if any(c.isalpha() for c in t or "") else None
        want[i] = ("und", 0.0) if share is None else (names[int(np.argmax(share))], float(share.max()))
    got = {r.doc_id: (r.lang_pred, r.score) for r in lang.language(spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3), F.lit(True)).collect()}
    assert {i: v[0] for i, v in got.items()} == {i: v[0] for i, v in want.items()}
    assert all(abs(got[i][1] - want[i][1]) < 1e-6 for i in want) and sum(0.2 < v[1] < 0.9 for v in want.values()) >= 8


@pytest.mark.parametrize("parts", [1, 4])
def test_a_text_of_two_languages(spark, parts):
    a, b = "the quick brown fox jumps over the lazy dog and runs home ", "der schnelle braune fuchs springt über den faulen hund und rennt "
    rows = [(i, (a if i % 2 else b) * 3, "en" if i % 2 else "de") for i in range(40)] + [(100, a * 6 + b * 2, None), (101, b * 6 + a, None), (102, "1234 !!", None)]
    got = {r.doc_id: r for r in lang.language(spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(parts), F.lit(True)).collect()}
    assert got[100].lang_pred == "en" and 0.6 < got[100].score < 0.9 and got[101].lang_pred == "de" and got[102].lang_pred == "und"
