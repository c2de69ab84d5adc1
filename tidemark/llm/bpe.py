"""Byte-pair encoding by a deterministic automaton.

The automaton reads tokens; its language is exactly the correct tokenisations. It starts with one state
that loops on every base symbol and grows by one gadget for each merge (u, v) -> uv in order of rank:

* the state that u leads to is forked and loses its arc v (u and v may no longer stand side by side);
* wherever u could be read and v after it, an arc uv is laid beside them, leading where v led.

So the state after uv starts as the state after v at that time, and the arcs uv run
beside the arcs u of that time. Written out, a vocabulary of 50,000 tokens would have
10**9 arcs; the gadgets share what they inherit, and the table keeps for each fork and arc
its origin and time and for each gadget the arc it cuts. An arc is resolved from these when it is first asked for. The transition
table keeps what was resolved: a square for the ``TABLE`` tokens merged first, which most text is spelled with and the walk
over many words looks up, and a map of any arcs for long words, which are walked one by one. The rarer arcs of short words
are resolved each time.

A word is encoded by walking the table over the token labels that spell it. Every prefix of
a word has one correct tokenisation, so one arc arrives at each position, and the
walk is deterministic. Decoding emits the labels of the arcs.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .presplit import WordSplit, byte_letters

_FREE = 1 << 60
#: Tokens whose arcs have a place of their own in the transition table.
TABLE = 2048


def _labels(file: dict) -> list[str]:
    """The label of every id of a vocabulary file; empty where there is none."""
    named = {**file["model"]["vocab"], **{a["content"]: a["id"] for a in file.get("added_tokens", [])}}
    labels = [""] * (max(named.values()) + 1)
    for label, i in named.items():
        labels[i] = label
    return labels


class Automaton:
    """The compiled merges of a vocabulary file."""

    def __init__(self, spec: str) -> None:
        file = json.loads(spec)
        model = file["model"]
        vocab: dict[str, int] = model["vocab"]
        self.suffix: str = model.get("end_of_word_suffix") or ""
        added = {a["content"]: a["id"] for a in file.get("added_tokens", [])}
        size = max([*vocab.values(), *added.values()]) + 1
        self.labels = _labels(file)
        self.added = {k.encode(): np.int32(i).tobytes() for k, i in added.items()}
        self.added_pattern = re.compile(b"(" + b"|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + b")") if added else None
        self.size = size
        #: Time of each token's gadget (0: a base symbol), and what its arc and its state were copied from.
        self.time, self.arc_of, self.fork_of = [0] * size, [0] * size, [0] * size
        #: Time at which a gadget cuts the arc of a token from the state after another.
        self.cut: dict[int, int] = {}
        for k, merge in enumerate(model["merges"], 1):
            u, v = (vocab[x] for x in (merge.split(" ") if isinstance(merge, str) else merge))
            self._gadget(u, v, vocab[self.labels[u] + self.labels[v]], k)
        letters = {c: b for b, c in enumerate(byte_letters())}
        spelled = lambda label: bytes([letters[c] for c in label])
        n = len(self.suffix)
        self.inner = {spelled(label): i for label, i in vocab.items() if not (n and label.endswith(self.suffix))}
        self.final = {spelled(label[: len(label) - n]): i for label, i in vocab.items() if label.endswith(self.suffix) and len(label) > n} if n else self.inner
        #: Beginnings of tokens: where none goes on, a word need not be searched further.
        self.begins = {x[:k] for x in (*self.inner, *self.final) for k in range(1, len(x))}
        self.table: dict[int, bool] = {}
        self._arrays()

    def _arrays(self) -> None:
        """The same tables for many words at once: times and origins, cuts by key, and the tokens as a tree of bytes."""
        self.times, self.arcs, self.forks = (np.array(x, np.int64) for x in (self.time, self.arc_of, self.fork_of))
        self.square = np.full((min(TABLE, self.size),) * 2, 2, np.uint8)  # 1: an arc, 0: none, 2: not asked for yet
        self.cut_keys = np.array(sorted(self.cut), np.int64)
        self.cut_times = np.array([self.cut[k] for k in self.cut_keys.tolist()], np.int64)
        nodes = {x: i for i, x in enumerate(sorted({b"", *self.begins, *self.inner, *self.final}))}  # the root is 0
        self.tree_keys, self.tree_nodes = (np.array(x, np.int64) for x in zip(*sorted((nodes[x[:-1]] * 256 + x[-1], i) for x, i in nodes.items() if x), strict=True))
        self.token_inside, self.token_final = np.full(len(nodes), -1), np.full(len(nodes), -1)
        for at, tokens in ((self.token_inside, self.inner), (self.token_final, self.final)):
            at[[nodes[x] for x in tokens]] = list(tokens.values())

    def _gadget(self, u: int, v: int, uv: int, time: int) -> None:
        self.cut[u * self.size + v] = time
        self.time[uv], self.arc_of[uv], self.fork_of[uv] = time, u, v

    def step(self, state: int, token: int) -> bool:
        """Whether the state after ``state`` has an arc ``token`` (it leads to the state after ``token``)."""
        key = state * self.size + token
        known = self.table.get(key)
        if known is None:
            if len(self.table) > 2_000_000:
                self.table.clear()
            known = self.table[key] = self._resolve(state, token)
        return known

    def _resolve(self, state: int, token: int) -> bool:
        before = _FREE
        while True:
            if self.cut.get(state * self.size + token, _FREE) < before:
                return False
            s, t = self.time[state], self.time[token]
            if s > t:  # the state was forked later: it had what its origin had then
                before, state = s, self.fork_of[state]
            elif t:  # the arc was laid later: beside its origin, if that was still there
                before, token = t + 1, self.arc_of[token]
            else:
                return True

    def steps(self, state: np.ndarray, token: np.ndarray) -> np.ndarray:
        """``step`` for arrays."""
        out, small = np.zeros(len(state), bool), np.flatnonzero((state < len(self.square)) & (token < len(self.square)))
        known = self.square[state[small], token[small]]
        out[small[known == 1]] = True
        new = small[known == 2]
        rest = np.ones(len(state), bool)
        rest[small[known < 2]] = False
        out[rest] = self._resolve_all(state[rest], token[rest])
        self.square[state[new], token[new]] = out[new]
        return out

    def _resolve_all(self, state: np.ndarray, token: np.ndarray) -> np.ndarray:
        out = np.zeros(len(state), bool)
        live, before = np.arange(len(state)), np.full(len(state), _FREE)
        while len(live):
            key = state * self.size + token
            place = np.searchsorted(self.cut_keys, key)
            place[place == len(self.cut_keys)] = 0
            go = ~((self.cut_keys[place] == key) & (self.cut_times[place] < before))
            s, t = self.times[state], self.times[token]
            forked, laid = s > t, (s <= t) & (t > 0)
            out[live[go & ~forked & ~laid]] = True
            before = np.where(forked, s, t + 1)
            state, token = np.where(forked, self.forks[state], state), np.where(laid, self.arcs[token], token)
            go &= forked | laid
            live, state, token, before = live[go], state[go], token[go], before[go]
        return out

    def word(self, text: bytes) -> list[int]:
        """The tokens of one word."""
        n = len(text)
        came: list[tuple[int, int] | None] = [None] * (n + 1)
        inner, final, begins, step = self.inner, self.final, self.begins, self.step
        for i in range(n):
            here = came[i]
            if i and here is None:
                continue
            state = here[1] if here else -1
            for j in range(i + 1, n + 1):
                part = text[i:j]
                token = inner.get(part) if j < n else final.get(part)
                if token is not None and came[j] is None and (state < 0 or step(state, token)):
                    came[j] = (i, token)
                if part not in begins:
                    break
        out, at = [], n
        while at:
            if came[at] is None:
                raise ValueError(f"no tokens spell {text!r}")
            at, token = came[at]
            out.append(token)
        return out[::-1]

    def words(self, texts: list[bytes]) -> list[np.ndarray]:
        """The tokens of each word: all walk the tables together, letter by letter."""
        size = np.array([len(x) for x in texts], np.int64)
        ends = np.cumsum(size + 1)
        start = ends - size - 1  # a word of n bytes has the places 0 to n
        text = np.frombuffer(b"\0".join(texts) + b"\0", np.uint8).astype(np.int64)
        token, origin = np.full(len(text), -1), np.full(len(text), -1)
        for i in range(int(size.max(initial=0))):
            at = start[size > i] + i
            end = ends[size > i] - 1
            if i:
                some = token[at] >= 0
                at, end = at[some], end[some]
            node, to, from_ = np.zeros(len(at), np.int64), at.copy(), at
            while len(to):
                key = node * 256 + text[to]
                place = np.searchsorted(self.tree_keys, key)
                place[place == len(self.tree_keys)] = 0
                go = self.tree_keys[place] == key
                node, to, from_, end = self.tree_nodes[place[go]], to[go] + 1, from_[go], end[go]
                new = np.where(to == end, self.token_final[node], self.token_inside[node])
                fit = np.flatnonzero((new >= 0) & (token[to] < 0))
                if i:
                    fit = fit[self.steps(token[from_[fit]], new[fit])]
                token[to[fit]], origin[to[fit]] = new[fit], from_[fit]
                more = to < end
                node, to, from_, end = node[more], to[more], from_[more], end[more]
        # Back from the end of each word; all tokens of a word in reverse.
        used = np.zeros(len(text), bool)
        at = ends[size > 0] - 1
        if (token[at] < 0).any():
            raise ValueError("no tokens spell a word")
        while len(at):
            used[at] = True
            at = origin[at]
            at = at[token[at] >= 0]
        counts = np.add.reduceat(used, start) if len(start) else np.zeros(0, np.int64)
        return np.split(token[used].astype(np.int32), np.cumsum(counts)[:-1]) if len(texts) else []


class Encoder(dict):
    """Runs of characters between ASCII white space, as bytes -> ids as bytes.

    A word never crosses white space, so such a run is encoded by itself; it is cut into words as the vocabulary
    file says. Runs and words are remembered, ``most`` of each beside those of the texts at hand; those of more than
    ``short`` bytes are not, and are walked one by one.
    """

    def __init__(self, automaton: Automaton, split: Callable[[list[bytes]], list[list[bytes]]], most: int = 300_000, short: int = 64) -> None:
        super().__init__()
        self.automaton, self.split, self.most, self.short = automaton, split, most, short
        self.words: dict[bytes, bytes] = {}

    def __missing__(self, run: bytes) -> bytes:
        """A run that is too long to be remembered."""
        return b"".join([self.words.get(w) or np.array(self.automaton.word(w), np.int32).tobytes() for w in self.split([run])[0]])

    def learn(self, runs: set[bytes]) -> None:
        new = [r for r in runs if len(r) <= self.short and r not in self]
        if len(self) + len(new) > self.most:
            self.clear()
            new = [r for r in runs if len(r) <= self.short]
        if len(self.words) > self.most:
            self.words.clear()
        cut = self.split(new)
        unseen = list({w for ws in cut for w in ws if w not in self.words})
        short = [w for w in unseen if len(w) <= self.short]
        self.words.update(zip(short, [x.tobytes() for x in self.automaton.words(short)], strict=True))
        ids = self.words
        for run, ws in zip(new, cut, strict=True):
            self[run] = b"".join([ids.get(w) or np.array(self.automaton.word(w), np.int32).tobytes() for w in ws])

    def encode(self, texts: list[bytes]) -> list[bytes]:
        added, special = self.automaton.added_pattern, self.automaton.added
        parts = [[x for x in added.split(t) if x] if added is not None and added.search(t) else [t] for t in texts]
        runs = [[[x] if x in special else x.split() for x in ps] for ps in parts]
        self.learn({r for rs in runs for r_ in rs for r in r_})
        get = self.__getitem__
        return [b"".join([special[r[0]] if r and r[0] in special else b"".join(map(get, r)) for r in rs]) for rs in runs]


@lru_cache(1)
def _encoder(spec: str) -> Encoder:
    return Encoder(Automaton(spec), WordSplit(spec))


@lru_cache(1)
def _arcs(spec: str) -> np.ndarray:
    """The labels to be emitted, by id; decoding needs nothing else of the automaton."""
    return np.array(_labels(json.loads(spec)), object)


def _spec(spark, path: str):
    """The vocabulary file, read by the driver and sent to the executors: its size does not depend on the data."""
    with open(path, encoding="utf-8") as f:
        return spark.sparkContext.broadcast(f.read())


def bpe_encode(docs: DataFrame, tokenizer: str, text_col: str = "text", ids_col: str = "ids", with_text: bool = True) -> DataFrame:
    """``docs`` with the token ids of each text (array<int>) in ``ids_col``, which replaces a column of that name.

    ``with_text`` False leaves the text out, so it doesn't travel back from the workers. A null or empty text, or one of white space, has no ids. ``tokenizer`` is the path of a word-level vocabulary file
    (lower case, word ends).
    """
    spec = _spec(docs.sparkSession, tokenizer)
    docs = docs.drop(ids_col)
    at = docs.columns.index(text_col)
    kept = [i for i in range(len(docs.columns)) if with_text or i != at]
    schema = T.StructType([*[docs.schema.fields[i] for i in kept], T.StructField(ids_col, T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(spec.value)
        for whole in batches:
            for k in range(0, whole.num_rows, 500):
                b = whole.slice(k, 500)
                got = encoder.encode([x or b"" for x in b.column(at).cast(pa.binary()).to_pylist()])
                offsets = np.concatenate([[0], np.cumsum([len(x) // 4 for x in got])]).astype(np.int32)
                ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(got), np.int32)))
                yield pa.RecordBatch.from_arrays([*[b.column(i) for i in kept], ids], schema.names)

    return docs.mapInArrow(run, schema)


def bpe_decode(tokens: DataFrame, tokenizer: str, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """``tokens`` with the labels of its ids, joined by a space, in ``text_col``; null ids count as none."""
    spec = _spec(tokens.sparkSession, tokenizer)
    tokens = tokens.drop(text_col)
    schema = T.StructType([*tokens.schema.fields, T.StructField(text_col, T.StringType())])
    at = tokens.columns.index(ids_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labels = _arcs(spec.value)
        for whole in batches:
            for k in range(0, whole.num_rows, 500):
                b = whole.slice(k, 500)
                ids = b.column(at)
                flat = labels[ids.flatten().to_numpy()]
                ends = np.concatenate([[0], np.cumsum(pa.compute.fill_null(pa.compute.list_value_length(ids), 0).to_numpy())])
                said = [" ".join(flat[lo:hi].tolist()) for lo, hi in zip(ends[:-1], ends[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(said, pa.string())], [*b.schema.names, text_col])

    return tokens.mapInArrow(run, schema)


def digests(decoded: DataFrame, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """``decoded`` with n_tokens, ids_sha256 and decoded_sha256 in place of ids and text."""
    ids = F.array_join(F.col(ids_col).cast("array<string>"), " ")
    return decoded.withColumns({"n_tokens": F.size(ids_col).cast("long"), "ids_sha256": F.sha2(ids.cast("binary"), 256), "decoded_sha256": F.sha2(F.col(text_col).cast("binary"), 256)}).drop(ids_col, text_col)
