"""The stages of the pipeline against plain Python, each on its own input; rows that repeat, ids that are null, names that clash."""

from __future__ import annotations

import hashlib
import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F
from test_models import _texts, plain_lines, plain_share

import corpus_pipeline
from tidemark.llm.quality import fit, line_features

STAGES = dict(corpus_pipeline.STAGES)
SHAPE = "doc_id long, text string, lang string, source string, n_chars long"


def _docs(spark, texts, ids=None, source=lambda i: f"s{i % 3}" if i % 4 else None):
    ids = ids or list(range(1, len(texts) + 1))
    return spark.createDataFrame([(i, t, "en", source(k), len(t or "")) for k, (i, t) in enumerate(zip(ids, texts))], SHAPE)


def _plain(df):
    return Counter(tuple(r) for r in df.collect())


def test_quality_stage(spark, tmp_path):
    """The field's weights come from the labels that are not held out; scores are then computed line by line."""
    import zlib

    made = _texts(7, 160)
    texts = [t for t, _ in made] + ["", None]
    docs = _docs(spark, texts)
    labels = [(i, y, 0) for i, (_, y) in enumerate(made, 1) if i % 3]
    pq.write_table(pa.table({k: [r[j] for r in labels] for j, k in enumerate(("doc_id", "quality", "toxic"))}), tmp_path / "labels.parquet")
    learned = [(i, y) for i, y, _ in labels if zlib.crc32(str(i).encode()) % 4 != 2]
    x, size, first = line_features(pa.array([texts[i - 1] for i, _ in learned]))
    w, tie, slope, shift = fit(x, size, first, np.array([y for _, y in learned]))
    score = {}
    for i, t in enumerate(texts, 1):
        rows, sizes = plain_lines(t)
        score[i] = 1 / (1 + math.exp(-(slope * plain_share(rows, sizes, w, tie) + shift)))
    assert min(abs(s - 0.7) for s in score.values()) > 1e-3
    got = STAGES["quality"](spark, docs, str(tmp_path))
    assert _plain(got) == Counter(tuple(r) for r in docs.collect() if score[r.doc_id] >= 0.7)
    kept = {r.doc_id for r in got.collect()}
    assert all(i in kept for i, (_, y) in enumerate(made, 1) if y) and sum(i in kept for i, (_, y) in enumerate(made, 1) if not y) < 20


def _mixed_plain(rows, weights=(1, 2, 3), most=3):
    """Copies of each row by systematic sampling over plain lists."""
    size = lambda t: len((t or "").replace("\t", " ").replace("\n", " ").replace("\x0b", " ").replace("\x0c", " ").replace("\r", " ").split(" ")) - ((t or "").replace("\t", " ").replace("\n", " ").split(" ").count(""))
    sizes = {}
    for r in rows:
        sizes[r[3]] = sizes.get(r[3], 0) + size(r[1])
    order = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    target, left, open_ = {}, float(sum(sizes.values())), list(order)
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = [s for s in open_ if level * weight[s] > most * sizes[s]]
        if not full:
            target |= {s: level * weight[s] for s in open_}
            break
        for s in full:
            target[s] = float(most * sizes[s])
            left -= target[s]
            open_.remove(s)
    out = Counter()
    for s in order:
        rate = target[s] / sizes[s] if sizes[s] else 0.0
        offset = int(hashlib.md5(("mix" + (f":{s}" if s is not None else "")).encode()).hexdigest()[:8], 16) / 2**32
        own = sorted((r for r in rows if r[3] == s), key=lambda r: (size(r[1]), r[0]))
        for i, r in enumerate(own):
            out[r] += min(most, math.floor(rate * (i + 1) + offset) - math.floor(rate * i + offset))
    return +out


def test_mixing_stage(spark):
    pick = random.Random(2)
    texts = [" ".join(["w"] * pick.randrange(0, 40)) or None for _ in range(300)]
    docs = _docs(spark, texts, source=lambda i: None if i % 7 == 0 else "big" if i % 3 else f"s{i % 5}")
    got = _plain(STAGES["mixing"](spark, docs, ""))
    assert got == _mixed_plain([tuple(r) for r in docs.collect()]) and max(got.values()) >= 2


def test_rows_that_repeat_are_judged_one_by_one(spark):
    """Of equal rows one stays; an id with several texts is several documents; a null id is an id like another, but the last to stay."""
    near = [f"w{i}" for i in range(60)]
    far = [*near[:30], "other", *near[31:]]
    texts = ["copy of a text"] * 3 + ["copy  of a text", "another", "another", "third", " ".join(near), " ".join(far), " ".join(near)]
    ids = [7, 7, 7, 9, None, None, None, 7, None, 7]
    docs = _docs(spark, texts, ids, source=lambda i: "s")
    for parts in (1, 4):
        exact = STAGES["exact_dedup"](spark, docs.repartition(parts), "")
        assert sorted(exact.select("doc_id", "text").collect(), key=str) == sorted([(9, "copy  of a text"), (None, "another"), (None, "third"), (7, " ".join(near)), (None, " ".join(far))], key=str)
        left = STAGES["near_dedup"](spark, exact, "")
        assert sorted(left.select("doc_id", "text").collect(), key=str) == sorted([(9, "copy  of a text"), (None, "another"), (None, "third"), (7, " ".join(near))], key=str)
    twins = _docs(spark, ["a b c"] * 6, [1, 1, 1, None, None, None], source=lambda i: "s")
    assert STAGES["near_dedup"](spark, twins, "").count() == 1 and STAGES["exact_dedup"](spark, twins, "").count() == 1
    assert sum(_plain(STAGES["mixing"](spark, twins, "")).values()) == 6
    assert STAGES["bpe"](spark, twins, "").count() == 6


def test_text_ids_are_told_by_their_text(spark):
    """Ids that look like numbers, or like one number, are different ids."""
    rows = [("1", "first text here"), ("01", "a second text"), ("0", "a second text"), ("a", "a  second text"), (" 1", "third")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], SHAPE.replace("doc_id long", "doc_id string"))
    kept = STAGES["exact_dedup"](spark, docs, "")
    assert sorted(kept.select("doc_id").collect()) == [(" 1",), ("1",), ("a",)] and kept.schema == docs.schema
    assert sorted(r.doc_id for r in STAGES["near_dedup"](spark, kept, "").collect()) == [" 1", "1", "a"]
    assert sum(_plain(STAGES["mixing"](spark, kept, "")).values()) == 3 and STAGES["bpe"](spark, kept, "").count() == 3


def test_columns_of_any_name_pass_unchanged(spark, tables):
    """Names that the stages use themselves, in any case, and one with a dot."""
    docs = spark.read.parquet(f"{tables}/documents.parquet").limit(40)
    names = ["score", "Score_", "copies", "copy", "mixed_id", "row", "ROW_", "kept", "keep_id", "ids", "size", "a.b"]
    docs = docs.withColumns({n: F.concat(F.lit(f"{n} of "), F.col("doc_id").cast("string")) for n in names})
    docs = docs.union(docs.limit(3)).cache()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, docs, tables)
        assert got.columns == docs.columns
        back = got.collect()
        assert back and all(r[n] == f"{n} of {r.doc_id}" for r in back for n in names), name
    assert STAGES["bpe"](spark, docs, tables).columns == ["doc_id", "source", "n_tokens", "ids"]


def test_run_leaves_the_last_folder_only(spark, tables, tmp_path):
    import os

    from tidemark.llm.common import shared_dir

    at = shared_dir(spark).removeprefix("file:")
    before = {x for x in os.listdir(at) if x.startswith("pipeline-")}
    n = corpus_pipeline.run(spark, tables).count()
    (new,) = {x for x in os.listdir(at) if x.startswith("pipeline-")} - before
    assert n > 0 and os.listdir(f"{at}/{new}") == ["bpe"]
