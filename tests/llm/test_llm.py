"""The training-data operators: SQL, libraries, brute force and held-out rows; then edge cases."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from conftest import rows
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tidemark.llm import bpe, chat, common, queries, token_files
from tidemark.llm.embedding_dedup import embedding_near_dedup
from tidemark.llm.exact_dedup import exact_dedup
from tidemark.llm.language import language
from tidemark.llm.minhash_dedup import TREES, WIDTH, _family, least_equal, near_dedup, signature
from tidemark.llm.mixing import mix
from tidemark.llm.quality import marginals, quality
from tidemark.llm.shingles import shingle_sets, word_hashes, words
from tidemark.llm.toxicity import IDENTITY, _swaps, fit, set_in, toxicity, word_features

WORD, BYTE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
DOC = "doc_id long, text string, lang string, source string, n_chars long, digest string, id string, content string, n int"
HARD = [None, "", " \n\t", "one", "A a", "don't we'LL", "naïve ΣΑΣ ǅ İ", "x<|endoftext|>y <|startoftext|>", "日本語 テキスト ½ ² ٣", "a b c\x85d\x1ce", "é café", "🙂🙂 #!", "  lead   trail  ", "q" * 5000, "w " * 30000]


def _docs(spark, texts, start=1):
    rows = [(i, t, "en", f"s{i % 3}" if i % 4 else None, 1, "x", "y", "z", 1) for i, t in enumerate(texts, start)]
    return spark.createDataFrame(rows, DOC)


def _tokenizer(path):
    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return t


def _sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_sql(spark, tables, duck, name):
    got, want = queries.queries()[name](spark, tables).toPandas(), duck.execute(queries.oracle_sql()[name]).df()
    assert rows(got) == rows(want)


# --- 1 -----------------------------------------------------------------------------------------


def _vector_brute(vectors, threshold=0.9):
    ok = [v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v) for _, v in vectors]
    unit = [np.array(v, np.float32).astype(float) / np.linalg.norm(np.array(v, np.float32).astype(float)) if o else None for o, (_, v) in zip(ok, vectors)]
    n = len(vectors)
    link = [[j for j in range(n) if j != i and ok[i] and ok[j] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= threshold - 1e-12] for i in range(n)]
    return link


def _components(ids, link):
    out = {}
    for i in range(len(ids)):
        seen, todo = {i}, [i]
        while todo:
            for j in link[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        out[i] = min(ids[j] for j in seen)
    return out


def test_embeddings_equal_brute_force_and_edges(spark):
    rng = np.random.RandomState(1)
    base = rng.standard_normal((12, 16))
    vectors = [(i, [float(x) for x in base[i % 12] + rng.standard_normal(16) * 0.25]) for i in range(90)]
    vectors += [(200, None), (201, []), (202, [0.0] * 16), (203, [float("nan")] * 16), (204, [None] * 16), (205, [float("inf")] + [1.0] * 15), (206, vectors[0][1]), (207, vectors[0][1]), (208, [1.0, 2.0])]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<float>").withColumn("node", F.lit(1)).withColumn("v", F.lit("x"))
    link = _vector_brute(vectors)
    part = _components([i for i, _ in vectors], link)
    for block in (1024, 8):
        got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embedding_near_dedup(df, block=block, recall=0.999999).collect()}
        assert got == {v[0]: (len(link[k]), part[k], v[0] == part[k]) for k, v in enumerate(vectors)}
    assert embedding_near_dedup(df.where("false")).count() == 0


def test_vectors_near_overflow_link(spark):
    rng = np.random.RandomState(5)
    base = rng.standard_normal((20, 64))
    base /= np.abs(base).max(axis=1, keepdims=True)
    rows = [(i, [float(x) for x in (base[i % 20] + rng.standard_normal(64) * 0.01) * (8e307 if i < 40 else 5e-300)]) for i in range(80)]
    got = {r.vec_id: (r.n_links, r.component_id) for r in embedding_near_dedup(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), recall=0.999999).collect()}
    assert got == {i: (3, i % 20) for i in range(80)}


# --- 2 -----------------------------------------------------------------------------------------


def test_chat_round_trip(spark):
    turns = [(1, 0, "user", "\\### Assistant: </turn> ok"), (1, 1, "assistant", "#### a \\\\ </turn>\\"), (1, 2, None, None), (2, 0, "a: b### ", "<|endoftext|> é🙂"), (None, 0, "assistant", ""), (2, None, "assistant", "x " * 5000), (2, None, "assistant", "x " * 5000)]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").withColumn("ids", F.lit(1))
    for part in (65_536, 3):
        got = {r.conv_id: r for r in chat.read_back(chat.format_conversations(df, BYTE, part_tokens=part), BYTE).collect()}
        for conv in (1, 2, None):
            own = sorted(((t if t is not None else -1, r or "", x or "") for c, t, r, x in turns if c == conv))
            said = "".join(x for _, r, x in own if r == "assistant")
            r = got[conv]
            assert (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) == (len(own), _sha("".join(f"{a}\n{b}\n" for _, a, b in own)), len(said), _sha(said))
            formatted = "".join(f"### {chat.escape(a, True)}: {chat.escape(b)}</turn>" for _, a, b in own)
            assert r.formatted_chars == len(formatted) and chat.parse(formatted) == [(a, b) for _, a, b in own]
    assert chat.format_conversations(df.where("false"), BYTE).count() == 0


# --- 3 -----------------------------------------------------------------------------------------


def _exact_brute(docs):
    groups = {}
    for i, t in docs:
        groups.setdefault("".join(c for c in t or "" if c not in " \t\n\x0b\x0c\r"), []).append((-len(t or ""), i))
    return {i: (min(g)[1], len(g), min(g)[1] == i, _sha(k)) for k, g in groups.items() for _, i in g}


@pytest.mark.parametrize("clash", [False, True])
def test_exact_equals_brute_force_with_hot_groups(spark, clash):
    texts = [*HARD, *["hot text"] * 1500, *["hot  text "] * 700, "a b", "ab", "a  b", "ä b", "x y", "xy"]
    docs = _docs(spark, texts)
    digest = (lambda c: F.unhex(F.lpad(F.hex(F.length(c) % 4), 2, "0"))) if clash else None
    got = {r.doc_id: (r.keep_id, r.group_size, r.kept, r.text_sha256) for r in exact_dedup(docs, share=2, digest=digest).collect()}
    want = _exact_brute(list(enumerate(texts, 1)))
    if clash:  # a row of an unshared weak digest carries that digest, not the text's
        assert {k: v[:3] for k, v in got.items()} == {k: v[:3] for k, v in want.items()}
    else:
        assert got == want


def test_exact_edges(spark):
    assert exact_dedup(_docs(spark, ["a"]).where("false")).count() == 0
    twice = _docs(spark, ["a"]).union(_docs(spark, ["a"])).union(_docs(spark, ["a "]).withColumn("doc_id", F.lit(None).cast("long")))
    got = sorted((r.doc_id is None, r.keep_id, r.group_size, r.kept) for r in exact_dedup(twice).collect())
    assert got == [(False, None, 3, False), (False, None, 3, False), (True, None, 3, True)]


# --- 4, 5 --------------------------------------------------------------------------------------


def test_bpe_equals_library(spark, tables):
    texts = [*HARD, *[r.text for r in spark.read.parquet(f"{tables}/documents.parquet").select("text").collect()]]
    docs = _docs(spark, texts).withColumn("ids", F.lit("clash"))
    t = _tokenizer(WORD)
    got = {r.doc_id: (r.ids, r.decoded) for r in bpe.bpe_decode(bpe.bpe_encode(docs, WORD), WORD).collect()}
    for i, x in enumerate(texts, 1):
        ids = t.encode(x or "", add_special_tokens=False).ids
        assert got[i] == (ids, t.decode(ids, skip_special_tokens=False)), repr(x)[:80]
    assert bpe.digests(bpe.bpe_decode(bpe.bpe_encode(docs.where("false"), WORD), WORD)).count() == 0


def test_automaton_equals_library_on_random_words():
    t, a, pick = _tokenizer(WORD), bpe.Automaton(open(WORD).read()), random.Random(3)
    words = ["".join(pick.choice("aaetionshrlnbéß") for _ in range(pick.randrange(1, 24))) for _ in range(3000)]
    want = [t.encode(w, add_special_tokens=False).ids for w in words]
    assert [a.word(w.encode()) for w in words] == want
    assert [x.tolist() for x in a.words([w.encode() for w in words])] == want
    assert a.words([]) == []
    # The table's square keeps what was asked for, and tells the same as the arcs resolved anew.
    known = np.argwhere(a.square < 2)
    assert len(known) > 1000 and a.square[tuple(known.T)].astype(bool).tolist() == a._resolve_all(*known.T).tolist()


def test_every_code_point_equals_library():
    """Python, its regular expressions and the library know different versions of Unicode."""
    with open(WORD, encoding="utf-8") as f:
        encoder = bpe._encoder(f.read())
    t, pick = _tokenizer(WORD), random.Random(1)
    texts = [f"a{chr(c)}b" for c in range(1, 0x20000) if not 0xD800 <= c < 0xE000]
    kinds = [lambda: pick.randrange(1, 128), lambda: pick.randrange(97, 123), lambda: pick.randrange(1, 0x3000), lambda: pick.randrange(0xE000, 0x20000), lambda: pick.choice((32, 10, 0x301, 0x308))]
    texts += ["".join(chr(pick.choice(kinds)()) for _ in range(pick.randrange(30))) for _ in range(6000)] + ["", "x<|endoftext|>y <|startoftext|>", "q" * 70 + " q"]
    encoder.most, before = 5000, encoder.most  # forgotten many times
    for k in range(0, len(texts), 4000):
        got = encoder.encode([x.encode() for x in texts[k : k + 4000]])
        assert [np.frombuffer(g, np.int32).tolist() for g in got] == [e.ids for e in t.encode_batch(texts[k : k + 4000], add_special_tokens=False)]
    encoder.most = before


def test_token_files_equal_library(spark, tables, tmp_path):
    texts = [*HARD, *[r.text for r in spark.read.parquet(f"{tables}/documents.parquet").select("text").collect()]]
    docs = _docs(spark, texts).orderBy(F.rand(1))
    path = str(tmp_path / "files")
    token_files.write_token_files(docs, BYTE, path, block_ids=5000)
    t = _tokenizer(BYTE)
    want = [t.encode(x or "", add_special_tokens=False).ids + [0] for x in texts]
    start = np.cumsum([0, *map(len, want)])
    got = {r.doc_id: r for r in token_files.read_token_files(spark, path).collect()}
    for i, ids in enumerate(want, 1):
        r = got[i]
        assert (r.ids, r.start, r.n_tokens) == (ids, start[i - 1], len(ids)) and r.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
    empty = str(tmp_path / "empty")
    token_files.write_token_files(docs.where("false"), BYTE, empty)
    assert token_files.read_token_files(spark, empty).count() == 0


def test_pieces_encode_as_the_library():
    """White space of every kind, contractions, signs and special tokens, cut anywhere; a small memory that is cleared."""
    pick = random.Random(3)
    parts = ["a", "Bc", " ", "  ", "\n", "\t", "\r\n", "'", "'s", "'LL", "1", "23", ".", "-", "_", "é", "\x0b", " don't", "\u00a0", "中", "<|endoftext|>"]
    with open(BYTE, encoding="utf-8") as f:
        spec = f.read()
    library = Tokenizer.from_str(spec)
    for most in (10**6, 50):
        words_of = token_files.Words(spec, most)
        for _ in range(3):
            texts = ["".join(pick.choice(parts[:-3] if pick.random() < 0.8 else parts) for _ in range(pick.randrange(14))) for _ in range(1000)] + [""]
            assert [x.tolist() for x in words_of.encode(texts)] == [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert words_of.encode([]) == []


def test_codes_of_every_length():
    x = np.array([0, 255, 256, 65535, 65536, 2**24 - 1, 2**24, 2**32 - 1, 7], np.uint32)
    for n in range(len(x) + 1):
        control, data = token_files.pack(x[:n])
        assert len(control) == -(-n // 4) and (token_files.unpack(control, data, n) == x[:n]).all()


# --- 6 -----------------------------------------------------------------------------------------


def _near_brute(texts, size, percent=80):
    sets = []
    for t in texts:
        w = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "").replace("\t", " ").replace("\n", " ").replace("\x0b", " ").replace("\x0c", " ").replace("\r", " ").split(" ")
        w = [x for x in w if x]
        sets.append({tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else ({tuple(w)} if w else set()))
    n = len(texts)
    link = [[] for _ in texts]
    for i in range(n):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * len(sets[i] | sets[j]):
                link[i].append(j)
                link[j].append(i)
    return [len(s) for s in sets], _components(list(range(1, n + 1)), link)


def test_near_equals_brute_force_on_a_star(spark):
    """Copies of one text with many edits each: alike to it, but hardly to one another."""
    pick = random.Random(5)
    base = [f"w{i}" for i in range(160)]
    texts = [*HARD, " ".join(base)]
    for _ in range(240):
        copy = list(base)
        for i in pick.sample(range(160), pick.choice([1, 2, 3, 4, 5, 9, 14])):
            copy[i] = f"v{pick.randrange(10**6)}"
        texts.append(" ".join(copy))
    texts += [" ".join(f"u{pick.randrange(50)}" for _ in range(60)) for _ in range(40)] + ["same words here too"] * 5
    sizes, part = _near_brute(texts, 4)
    for region in (64, 12):
        got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_dedup(_docs(spark, texts), shingle=4, region=region).collect()}
        want = {i + 1: (sizes[i], part[i], part[i] == i + 1) for i in range(len(texts))}
        missed = [i for i in want if got[i] != want[i]]
        # The forest is probabilistic: regions cut deeper than in production may miss a text that barely reaches one other.
        assert all(got[i] == (sizes[i - 1], i, True) for i in missed) and len(missed) <= (0 if region == 64 else 0.02 * len(texts)), missed


def test_near_finds_all_at_the_threshold_of_a_crowd(spark):
    """Texts that barely reach one other, in regions crowded by close copies of it."""
    pick = random.Random(7)
    base = [f"w{i}" for i in range(163)]
    texts = [" ".join(base)]
    # An edit away from others changes four shingles: 160 - 4 k of 160 + 4 k stay, 0.905 at two and 0.818 at four edits.
    for k in [1] * 300 + [4] * 1200:
        copy = list(base)
        for i in range(k):
            copy[4 + i * 39 + pick.randrange(32)] = f"v{pick.randrange(10**9)}"
        texts.append(" ".join(copy))
    _, part = _near_brute([texts[0], *texts[-50:]], 4)
    assert set(part.values()) == {1}
    got = near_dedup(_docs(spark, texts), shingle=4).select("component_id").collect()
    assert [r.component_id for r in got] == [1] * len(texts)
    # Regions of more than 256 cut at the last depth: 0.9994 of such pairs meet there, or in the sorted order.
    got = near_dedup(_docs(spark, texts), shingle=4, grid=256).select("component_id").collect()
    assert sum(r.component_id != 1 for r in got) <= 3


def test_near_tries_pairs_five_standard_errors_below(spark):
    """A pair above the threshold whose hashes agree far less often than its sets do."""
    n = TREES * WIDTH
    least = least_equal(n, 80, 5.0)
    assert least == 102 and sum(math.comb(n, k) * 0.8**k * 0.2 ** (n - k) for k in range(least)) < 1e-6
    factors = _family(n)
    pick = random.Random(1)
    for _ in range(20_000):
        copy = [f"w{pick.randrange(10**9)}" for _ in range(163)]
        texts = [" ".join(copy)]
        for i in range(4):
            copy[10 + 40 * i] = "v"
        texts.append(" ".join(copy))
        a, b = shingle_sets(pa.array(texts), 4)
        if np.count_nonzero(signature(a, factors) == signature(b, factors)) <= 112:
            break
    assert 100 * len(np.intersect1d(a, b)) >= 80 * len(np.union1d(a, b))
    assert [r.component_id for r in near_dedup(_docs(spark, texts), shingle=4).collect()] == [1, 1]


def test_near_edges(spark):
    assert near_dedup(_docs(spark, ["a"]).where("false")).count() == 0
    none = _docs(spark, ["a b c d e f", "a b c d e f"]).withColumn("doc_id", F.lit(None).cast("long"))
    assert [(r.component_id, r.kept) for r in near_dedup(none).collect()] == [(None, False)] * 2


def test_words_of_slices():
    texts = pa.array([f"Ä{i} B\x0bc É" for i in range(50)] + [None, ""])
    text, starts, ends, offsets = words(texts.slice(20))
    assert [text[a:b].tobytes().decode() for a, b in zip(starts[:3], ends, strict=False)] == ["Ä20", "b", "c"] and offsets[-1] == len(starts) == 4 * 30
    assert [len(s) for s in shingle_sets(texts.slice(49), 4)] == [1, 0, 0]
    assert [len(s) for s in shingle_sets(texts.slice(49), 9)] == [1, 0, 0]  # fewer words in the batch than in a shingle


def test_words_and_shingles_equal_regular_expression():
    """Words of every length, with bytes that are not white space, cut at the ends of texts and slices."""
    pick = random.Random(1)
    texts = ["".join(pick.choice("aB \t\nÉ€x\x0b\x00") for _ in range(pick.randrange(40))) for _ in range(500)] + [None, "", " ", "x" * 300, "X" * 300 + " y"]
    for array in (pa.array(texts), pa.array(texts).slice(7), pa.array(texts, pa.large_string()).slice(11, 200), pa.array([None], pa.string()), pa.array([], pa.string())):
        found = [["".join(c.lower() if "A" <= c <= "Z" else c for c in w) for w in re.findall(r"[^\x20\x09-\x0D]+", t or "")] for t in array.to_pylist()]
        h, offsets = word_hashes(array)
        flat = [w for ws in found for w in ws]
        assert np.diff(offsets).tolist() == [len(ws) for ws in found]
        assert len(set(zip(flat, h.tolist(), strict=True))) == len(set(flat)) == len(set(h.tolist()))
        for n in (1, 2, 4):
            want = [len({tuple(ws[i : i + n]) for i in range(len(ws) - n + 1)}) if len(ws) >= n else int(bool(ws)) for ws in found]
            assert [len(s) for s in shingle_sets(array, n)] == want


# --- 7, 8, 10 ----------------------------------------------------------------------------------


def _scored(spark, name, label, at):
    labels = spark.read.parquet(f"{at}/labels.parquet").select("doc_id", label)
    return queries.queries()[name](spark, at).join(labels, "doc_id").where("held_out").toPandas()


def test_toxicity_held_out(spark):
    m = _scored(spark, "op7_toxicity", "toxic", "/root/testdata/sf0.1")
    assert ((m.predicted == 1) & (m.toxic == 0)).sum() <= 0.005 * len(m)
    assert ((m.predicted == 1) & (m.toxic == 1)).sum() >= 0.75 * (m.toxic == 1).sum()


def test_swaps_even_out_identity_terms():
    women, men, bad = 11, 12, 13
    data = [{"label": 1, "features": [women, bad], "swaps": [[[women], [men]]]} for _ in range(40)] + [{"label": 0, "features": [men], "swaps": [[[men], [women]]]} for _ in range(40)]
    weight = lambda even: dict(zip(*(x.tolist() for x in fit(data, even=even)[:2])))
    free, tied = weight(0.0), weight(50.0)
    assert abs(tied.get(women, 0) - tied.get(men, 0)) < 0.2 * abs(free.get(women, 0) - free.get(men, 0))
    assert tied[bad] > 1


def test_every_pair_of_identity_terms_is_set_in():
    assert {set_in(doc) for doc in range(20_000)} == {(a, b) for line in IDENTITY for a in line for b in line if a != b}
    pairs = {tuple(map(tuple, p)) for doc in range(20_000) for p in _swaps("no term", doc)}
    assert {(tuple(word_features(a)), tuple(word_features(b))) for a, b in (("christians", "muslims"), ("queer", "straight"), ("old", "young"))} <= pairs


def test_every_identity_sentence_is_swapped():
    got = _swaps("Women ran. " * 3 + "Nobody else. " + "A muslim sang.\n" * 4, 5)
    assert len(got) == 7 and all(a != b for a, b in got)


def test_quality_held_out(spark):
    m = _scored(spark, "op8_quality", "quality", "/root/testdata/sf0.1")
    assert (m.predicted == m.quality).mean() >= 0.98


def test_marginals_equal_enumeration():
    emit, tie = np.array([0.3, -1.2, 0.7, 2.0, -0.4]), np.array([[0.5, -0.3], [0.1, 0.9]])
    got, _ = marginals(emit, tie, np.array([0, 3, 5]))
    for lo, hi in ((0, 3), (3, 5)):
        total = np.zeros(hi - lo)
        mass = 0.0
        for code in range(2 ** (hi - lo)):
            y = [code >> k & 1 for k in range(hi - lo)]
            p = np.exp(sum(emit[lo + k] * v for k, v in enumerate(y)) + sum(tie[a, b] for a, b in zip(y, y[1:])))
            mass += p
            total += p * np.array(y)
        assert np.allclose(got[lo:hi], total / mass)


def test_language_held_out(spark):
    at = "/root/testdata/sf0.1"
    m = queries.queries()["op10_language"](spark, at).join(spark.read.parquet(f"{at}/documents.parquet").select("doc_id", "lang"), "doc_id").where("held_out").toPandas()
    assert (m.lang_pred == m.lang).mean() >= 0.99


def test_models_on_edge_cases(spark):
    docs = _docs(spark, HARD).union(_docs(spark, ["dup", "dup"]))
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(1, 12)] + [(None, 1, 1), (3, None, None)], "doc_id long, quality int, toxic int")
    every = F.lit(True)
    for out in (quality(docs, labels, every), toxicity(docs, labels, every), quality(docs, labels.where("false"), every), toxicity(docs, labels.where("false"), every)):
        got = out.collect()
        assert len(got) == docs.count() and all(0 <= r.score <= 1 for r in got)
    lang = language(docs.withColumn("lang", F.when(F.col("doc_id") % 2 == 0, "aa").when(F.col("doc_id") % 3 == 0, "bb")), every).collect()
    assert len(lang) == docs.count() and all(0 <= r.score <= 1 for r in lang)
    assert {r.lang_pred for r in lang if r.doc_id in (3,)} == {"und"} and "und" not in {r.lang_pred for r in lang if r.doc_id == 4}
    empty = docs.where("false")
    assert quality(empty, labels, every).count() == toxicity(empty, labels, every).count() == language(empty, every).count() == 0


# --- 9 and the pipeline ------------------------------------------------------------------------


def test_mix_targets_and_edges(spark):
    pick = random.Random(2)
    texts = [" ".join(["w"] * pick.randrange(0, 60)) or None for _ in range(900)]
    out = mix(_docs(spark, texts)).toPandas()
    assert len(out) == 900 and (out.taken <= 3 * out["size"]).all()
    by = out.groupby(out.source.fillna("-")).agg(size=("size", "sum"), source_size=("source_size", "first"), target=("target", "first"), taken=("taken", "sum"))
    assert (by["size"] == by.source_size).all() and abs(by.target.sum() - by["size"].sum()) < 1e-6
    assert (by.target <= 3 * by.source_size + 1e-9).all() and ((by.taken - by.target).abs() <= 60).all()
    again = mix(_docs(spark, texts).orderBy(F.rand(4)), partitions=3).toPandas()
    assert rows(out) == rows(again)
    assert mix(_docs(spark, texts).where("false")).count() == 0
    assert [r.taken for r in mix(_docs(spark, [None, ""])).collect()] == [0, 0]


def test_components_of_a_long_chain(spark):
    n = 300
    order = list(range(n))
    random.Random(1).shuffle(order)
    edges = spark.createDataFrame([(order[i], order[i + 1]) for i in range(n - 1)] + [(1000, 1001), (5, 5), (None, 3)], "a int, b int")
    got = {r.node: r.component for r in common.connected_components(edges).collect()}
    assert got == {**{i: 0 for i in range(n)}, 1000: 1000, 1001: 1000}


def test_pipeline(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, common.saved(stage(spark, docs, tables))
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        assert 0 < docs.count() <= 3 * before.count()
    assert corpus_pipeline.run(spark, tables).count() == docs.count()
    extra = docs.limit(5).withColumn("ids", F.lit(1)).withColumn("kept", F.lit(1)).withColumn("score", F.lit(1))
    for _, stage in corpus_pipeline.STAGES:
        stage(spark, extra.where("false"), tables).collect()
        stage(spark, extra, tables).collect()


def test_pipeline_stages_equal_plain_python(spark):
    """The rows of the duplicate and token stages, each from the stage's own input."""
    stages, pick = dict(corpus_pipeline.STAGES), random.Random(4)
    texts = [None, "", " ", "one", "hot text", "hot  text", "hottext", "hot text"]
    for _ in range(12):
        base = [f"w{pick.randrange(500)}" for _ in range(120)]
        copy, other = list(base), list(base)
        copy[60] = "edited"
        other[10::12] = ["x"] * len(other[10::12])
        texts += [" ".join(x) for x in (base, copy, other)] + ["  ".join(base)]
    pick.shuffle(texts)
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    plain = lambda df: sorted(tuple(r) for r in df.select("doc_id", "text").collect())
    docs = _docs(spark, texts).select(*columns)

    exact = stages["exact_dedup"](spark, docs, "")
    before = plain(docs)
    assert plain(exact) == [r for r in before if _exact_brute(before)[r[0]][2]]

    before = plain(exact)
    _, part = _near_brute([t for _, t in before], 5)
    near = stages["near_dedup"](spark, exact, "")
    assert plain(near) == [r for k, r in enumerate(before, 1) if part[k - 1] == k]
    assert 12 < near.count() < len(before) < len(texts)

    t = _tokenizer(WORD)
    want = {i: t.encode(x or "", add_special_tokens=False).ids for i, x in before}
    assert {r.doc_id: (r.n_tokens, r.ids) for r in stages["bpe"](spark, exact, "").collect()} == {i: (len(ids), ids) for i, ids in want.items()}
