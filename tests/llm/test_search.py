"""Lexical search, spelling variants and page text against plain versions."""

from __future__ import annotations

import collections
import html
import math
import random
import re
import zlib

import numpy as np
import pytest
from conftest import rows

from tidemark.llm import queries as q
from tidemark.llm.html_text import extract_main_text, main_text
from tidemark.llm.lexical import lexical_search, nra
from tidemark.llm.spelling import frequent_grams, merged_keys, spelling_variants, word_counts

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.mark.parametrize("name", ["op11_lexical_search", "op13_html_text"])
def test_query_equals_sql(spark, tables, duck, name):
    got, want = q.queries()[name](spark, tables).toPandas(), duck.execute(q.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns) and rows(got) == rows(want)


# --- lexical search ----------------------------------------------------------------------------


def _terms(text):
    return re.findall("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", (text or "").translate(LOWER))


def _ranked(docs, items, k):
    """Every document scored in full."""
    held = [(d, collections.Counter(t)) for d, x in docs if (t := _terms(x))]
    n, length = len(held), sum(sum(c.values()) for _, c in held)
    asked = collections.defaultdict(list)
    for i, x in items:
        asked[i] += _terms(x)
    df = collections.Counter(t for _, c in held for t in c)
    out = []
    for i, terms in asked.items():
        scores = []
        for d, c in held:
            m = 25 + 75 * sum(c.values()) * n // length
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m)) for t in terms if c[t])
            if s > 0:
                scores.append((-s, d is None, d))
        out += [(i, r, d, -s) for r, (s, _, d) in enumerate(sorted(scores, key=lambda x: (x[0], x[1], x[2] or 0))[:k], 1)]
    return sorted(out, key=str)


def test_search_equals_full_scores(spark):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(60)] + ["É", "ab", "Ab", "\U0001f600x", "0"]
    docs = [(i, " ".join(rng.choice(words[: rng.choice([5, 20, 65])]) for _ in range(rng.choice([1, 3, 30, 200])))) for i in range(300)]
    docs += [(i, "ab-ab;É") for i in range(400, 430)] + [(7, docs[7][1]), (None, "ab É"), (None, None), (900, None), (901, " ;- "), (902, "w1 " * 50_000), (-5, "ab-ab;É")]
    items = [(1, "w1 w2 W2 w40"), (2, "AB É"), (3, None), (4, "nothing here"), (5, " ".join(words)), (None, "w3"), (6, "w50"), (6, "w51 w50"), (7, "w1")]
    frame = spark.createDataFrame([(d, x, "extra") for d, x in docs], "doc_id long, text string, score string").repartition(5)
    asked = spark.createDataFrame(items, "item_id int, text string")
    for k in (10, 1, 400):
        got = lexical_search(frame, asked, k=k)
        assert got.columns == ["item_id", "rank", "doc_id", "score"]
        assert sorted([tuple(r) for r in got.collect()], key=str) == _ranked(docs, items, k)
    blocked = lexical_search(frame, asked, k=5, block=3)
    assert sorted([tuple(r) for r in blocked.collect()], key=str) == _ranked(docs, items, 5)


def test_search_without_rows(spark):
    docs, items = spark.createDataFrame([(1, "a")], "doc_id long, text string"), spark.createDataFrame([(1, "a")], "item_id int, text string")
    for d, i in ((docs.where("false"), items), (docs, items.where("false")), (docs, items.where("false").union(spark.createDataFrame([(2, "-")], "item_id int, text string")))):
        assert lexical_search(d, i).collect() == []


@pytest.mark.parametrize("seed", range(12))
def test_intervals_settle_on_the_best(seed):
    rng = np.random.default_rng(seed)
    n, k = int(rng.integers(1, 400)), int(rng.integers(1, 20))
    full, lists = np.zeros(n, np.int64), []
    for _ in range(int(rng.integers(1, 70))):
        docs = rng.permutation(n)[: int(rng.integers(0, n + 1))]
        values = np.sort(rng.integers(1, 4 if seed % 2 else 10**9, len(docs)))[::-1]
        full[docs] += values
        lists.append((docs, values))
    got = dict(zip(*(x.tolist() for x in nra(lists, n, k, first=2)), strict=True))
    least = max(1, sorted(full.tolist())[-k:][0])
    assert got == {i: s for i, s in enumerate(full.tolist()) if s >= least}


# --- spelling ----------------------------------------------------------------------------------


def _variants(docs, slips=0):
    counts = collections.Counter()
    for d, x in docs:
        for w in re.findall("[A-Za-zÀ-ÿ]+", (x or "").translate(LOWER)):
            h = zlib.crc32(f"{'' if d is None else d}:{w}".encode())
            if slips and h % slips == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            counts[w] += len(w) >= 7
    counts = {w: n for w, n in counts.items() if n >= 2}

    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b, strict=True)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))

    links = {w: [o for o in counts if abs(len(o) - len(w)) < 2 and near(w, o)] for w in counts}
    best = {w: min(((-counts[o], o) for o in x), default=None) for w, x in links.items()}
    form = {w: b[1] if b and -b[0] >= 10 * counts[w] else None for w, b in best.items()}
    out = []
    for w, n in counts.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n, len(links[w]), counts[form[w]] if form[w] else None))
    return sorted(out, key=str)


def test_variants_of_a_chain(spark):
    rng = random.Random(5)
    docs = [(i, x) for i, (w, n) in enumerate([("aaaaaaaa", 2000), ("aaaaaaab", 200), ("aaaaaab", 20), ("aaaaaabc", 2), ("Straßenbahn", 30), ("strassenbahn", 3), ("strasenbahn", 2), ("ééééééé", 20), ("éééééééé", 2), ("single", 9), ("onceonly", 1), ("longword" * 40, 20), ("longword" * 39 + "longwrd", 2)]) for x in [" ".join([w] * n), ""]]
    docs += [(100 + i, " ".join("".join(rng.choice("cd") for _ in range(rng.choice([7, 8, 9, 10]))) for _ in range(200))) for i in range(10)] + [(None, "nullnull nullnull"), (5, None)]
    frame = spark.createDataFrame([(d, x, "e") for d, x in docs], "doc_id long, text string, word string")
    for slips, limit in ((0, 1000), (3, 5)):
        got = sorted([tuple(r) for r in spelling_variants(frame, slips=slips, limit=limit).collect()], key=str)
        assert got == _variants(docs, slips)
    assert any(r[2] == "aaaaaaaa" and r[1] != r[2] and r[1] for r in _variants(docs))  # a root two steps away
    assert spelling_variants(frame.where("false")).collect() == []
    with pytest.raises(ValueError, match="6"):
        spelling_variants(frame, least_chars=5)


def test_spelling_query(spark, tables):
    docs = [tuple(r) for r in spark.read.parquet(f"{tables}/documents.parquet").select("doc_id", "text").collect()]
    got = q.queries()["op12_spelling"](spark, tables)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert sorted([tuple(r) for r in got.collect()], key=str) == _variants(docs, 31)


def test_near_words_meet_in_the_window_of_their_first_difference(spark, tables):
    words = word_counts(spark.read.parquet(f"{tables}/documents.parquet"), "doc_id", "text", 7, 2, 0)
    frequent = frequent_grams(words, 2, 6, 20, 100_000)
    assert {len(g) for g in frequent} == {2, 3, 4, 5}
    rng = random.Random(1)
    for r in words.limit(2000).collect():
        long, i = r.word, rng.randrange(len(r.word))
        for near in (long[:i] + "x" + long[i + 1 :], long[:i] + long[i + 1 :]):
            first = next((j for j in range(len(near)) if near[j] != long[j]), len(near))
            if near != long and len(near) >= 7:
                mine = {x[:3] for x in merged_keys(long, (0,), 4, 2, 6, frequent) if x[1] <= first < x[2]}
                assert len(mine) == 1 and mine <= {x[:3] for x in merged_keys(near, (0, 1), 4, 2, 6, frequent)}


# --- text of pages -----------------------------------------------------------------------------

PAGES = {
    None: "", "": "", "<p>Hi": "Hi", "no markup &lt;b&gt; &amp;amp;": "no markup <b> &amp;", "<article></article>": "", "<p>a<script>x<y '</p>'</script>b": "ab",
    '<body class="has-sidebar"><nav>a b</nav><div class="post">One two <b>th</b>ree<br>four</div><div class="cookie-notice">We use cookies</div>': "One two three four",
    "<main><article><header><h1>T</h1><p>by X</p></header><p>A</p><section class='comments'><article class=comment><p>bad</p></article></section><p>B</p></article></main><footer>x</footer>": "T A B",
    "<div id=content><p>" + "word " * 30 + "<p>short</div><div class=sidebar><p>" + "noise " * 50 + "</div>": "word " * 30 + "short",
    "<article>\n a\t\n<i>b</i>&nbsp;c <!-- no <p>x --> d<p> e </article><p>out": "a b c d e",
    "<article><p>one<form><p>mail?<input></form><aside>see</aside><p>two<div class='ad'>buy</div></article>": "one two",
    "<body class='comments-open no-sidebar'><div id=siteHeader>x</div><div class='main-nav'>y</div><div class='post content_with_sidebar'><h1>T</h1><p>A</div><div class='left-sidebar'>z</div><div id='post-comments'>no": "T A",
    "<div class='page-header'><article class='post'><div class='entry-header'><h2>T</h2>by me</div><p>A<table><tr><td>1<td>2</table><pre> x\n y</pre></article></div>": "T A 1 2 x y",
    '<div title="a > b">in</div>': "in", "<p>broken <a href='x>y": "broken y", "<article><a href=x>all link</a></article>": "all link",
}


@pytest.mark.parametrize("page", list(PAGES), ids=range(len(PAGES)))
def test_main_text(page):
    assert main_text(page) == PAGES[page]


def test_stretches_without_marks():
    body, far = "<p>" + "long words of the story " * 8, "<div><a>x</a></div>" * 5
    assert main_text("<div>Menu here" + "<div role=note></div>" + far + body + far + "<div>small print") == html.unescape("long words of the story " * 8).strip()
    assert main_text("<p>tiny" + far + "<p>bit").split() in (["tiny"], ["tiny", "bit"])


def test_extract_main_text(spark):
    wild = "<div><p>" + "x &amp; " * 300_000 + "<" * 5000
    frame = spark.createDataFrame([(1, "<p>a", "u"), (1, "<p>a", "u"), (2, None, None), (3, wild, "w")], "page_id long, html string, text string")
    got = {r.page_id: (r.text, r.n_chars) for r in extract_main_text(frame).collect()}
    assert got[1] == ("a", 1) and got[2] == ("", 0) and got[3][0].startswith("x & x & x") and got[3][1] > 10**6
    assert extract_main_text(frame).count() == 4 and extract_main_text(frame.where("false")).columns == ["page_id", "text", "n_chars"]
    with pytest.raises(ValueError, match="carried"):
        extract_main_text(frame, carry=["text"])
