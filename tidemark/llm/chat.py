"""Chat formatting by token-level assembly.

A turn reads ``### role: text</turn>``. Its parts are encoded separately; the marks are reserved
ids, spliced in between, which no text can produce: in texts the special strings of the tokenizer
are ordinary text, and control strings of the template are escaped by a backslash
(as is the backslash), so that the decoded output also reads back as text. Of every ``###`` the third
sign is escaped, so no three signs that follow each other are left bare, however long their run.

Rows are sorted by conversation and turn inside each partition and streamed: a conversation
of any length leaves as parts of a bounded number of tokens. The loss mask is the prefix
sum of +1 where an assistant's text begins and -1 where it ends.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The template's marks, as they read in the output, with reserved ids counted from the vocabulary's end.
OPEN, NAMED, CLOSE = "### ", ": ", "</turn>"
_CONTROL = re.compile(r"\\|###|</turn>")
_NAME_CONTROL = re.compile(r"\\|###|</turn>|:")


def escape(text: str, name: bool = False) -> str:
    return (_NAME_CONTROL if name else _CONTROL).sub(lambda m: "##\\#" if m[0] == "###" else "\\" + m[0], text)


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S)


def parse(formatted: str) -> list[tuple[str, str]]:
    """The (role, text) pairs of a formatted conversation."""
    token = re.compile(r"\\.|### |: |</turn>|.", re.S)
    out, role, text, state = [], "", "", 0
    for m in token.finditer(formatted):
        s = m[0]
        if state == 0 and s == OPEN:
            role, text, state = "", "", 1
        elif state == 1 and s == NAMED:
            state = 2
        elif state == 2 and s == CLOSE:
            out.append((unescape(role), unescape(text)))
            state = 0
        elif state == 1:
            role += s
        elif state == 2:
            text += s
    return out


@lru_cache(2)
def _tokenizer(spec: str):
    from tokenizers import Tokenizer

    t = Tokenizer.from_str(spec)
    t.no_truncation()
    t.no_padding()
    t.encode_special_tokens = True
    return t


def tokenizer_spec(path: str) -> str:
    """The tokenizer's file, read on the driver; the vocabulary bounds its size."""
    with open(path, encoding="utf-8") as f:
        return f.read()


def format_conversations(turns: DataFrame, tokenizer: str, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", part_tokens: int = 65_536) -> DataFrame:
    """Rows (conversation, part, n_turns, input_ids, loss_mask) in order; parts end between turns and hold ``part_tokens`` ids or one turn.

    ``tokenizer``: the path of a byte-level tokenizer file. Turns are ordered by turn, role and text, null first;
    a null role or text is empty; the rows with a null conversation are one conversation.
    Repeated rows are repeated turns. An empty table gives an empty result; other
    columns are ignored.
    """
    spec = turns.sparkSession.sparkContext.broadcast(tokenizer_spec(tokenizer))
    rows = turns.select(F.col(conv_col).cast("long").alias("conv"), F.col(turn_col).cast("long").alias("turn"), F.coalesce(F.col(role_col), F.lit("")).alias("role"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = _tokenizer(spec.value)
        top = t.get_vocab_size(with_added_tokens=True)
        cut = [top, top + 1, top + 2]
        for whole in batches:
            for k in range(0, whole.num_rows, 256):
                b = whole.slice(k, 256)
                roles = [escape(x, True) for x in b.column("role").to_pylist()]
                texts = [escape(x) for x in b.column("text").to_pylist()]
                names = {x: t.encode(x, add_special_tokens=False).ids for x in set(roles)}
                bodies = t.encode_batch_fast(texts, add_special_tokens=False)
                ids, begin = [], []
                for r, e in zip(roles, bodies, strict=True):
                    head = [cut[0], *names[r], cut[1]]
                    begin.append(len(head))
                    ids.append(np.array(head + e.ids + [cut[2]], np.int32))
                yield pa.RecordBatch.from_arrays([b.column("conv"), b.column("turn"), b.column("role"), b.column("text"), pa.array(ids, pa.list_(pa.int32())), pa.array(begin, pa.int32())], ["conv", "turn", "role", "text", "ids", "begin"])

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv: object = batches  # no conversation yet
        part, held, spans, size = 0, [], [], 0

        def out() -> pa.RecordBatch:
            ids = np.concatenate(held)
            edge = np.zeros(len(ids) + 1, np.int8)
            for lo, hi in spans:
                edge[lo] += 1
                edge[hi] -= 1
            mask = np.cumsum(edge[:-1], dtype=np.int8)
            return pa.RecordBatch.from_arrays([pa.array([conv], pa.int64()), pa.array([part], pa.int32()), pa.array([len(held)], pa.int64()), pa.array([ids], pa.list_(pa.int32())), pa.array([mask], pa.list_(pa.int8()))], ["conv", "part", "n_turns", "input_ids", "loss_mask"])

        for b in batches:
            ids, begins = b.column("ids"), b.column("begin").to_pylist()
            flat, ends = ids.flatten().to_numpy(), ids.offsets.to_numpy() - ids.offsets[0].as_py()
            for i, (c, role) in enumerate(zip(b.column("conv").to_pylist(), b.column("role").to_pylist(), strict=True)):
                own = flat[ends[i] : ends[i + 1]]
                if c != conv or size + len(own) > part_tokens:
                    if held:
                        yield out()
                    part, held, spans, size = (part + 1 if c == conv else 0), [], [], 0
                    conv = c
                if role == "assistant":
                    spans.append((size + begins[i], size + len(own) - 1))
                held.append(own.copy())
                size += len(own)
        if held:
            yield out()

    coded = rows.mapInArrow(encode, "conv bigint, turn bigint, role string, text string, ids array<int>, begin int")
    ordered = coded.repartition("conv").sortWithinPartitions("conv", "turn", "role", "text").select("conv", "role", "ids", "begin")
    made = ordered.mapInArrow(assemble, "conv bigint, part int, n_turns bigint, input_ids array<int>, loss_mask array<tinyint>")
    return made.select(F.col("conv").alias(conv_col), "part", "n_turns", "input_ids", "loss_mask")


def read_back(formatted: DataFrame, tokenizer: str, conv_col: str = "conv_id") -> DataFrame:
    """One row per conversation from the output alone: n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars.

    Parts of a conversation must follow each other in a partition, as they are made. Turns are decoded one by
    one into running digests.
    """
    spec = formatted.sparkSession.sparkContext.broadcast(tokenizer_spec(tokenizer))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = _tokenizer(spec.value)
        top = t.get_vocab_size(with_added_tokens=True)
        conv: object = batches
        state: list = []

        def out() -> pa.RecordBatch:
            n, turns, chars, loss, total = state
            return pa.RecordBatch.from_arrays([pa.array([conv], pa.int64()), pa.array([n], pa.int64()), pa.array([turns.hexdigest()]), pa.array([chars], pa.int64()), pa.array([loss.hexdigest()]), pa.array([total], pa.int64())], ["conv", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

        for b in batches:
            for c, ids, mask in zip(b.column("conv").to_pylist(), b.column("input_ids"), b.column("loss_mask"), strict=True):
                if c != conv:
                    if state:
                        yield out()
                    conv, state = c, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                ids, mask = ids.values.to_numpy(), mask.values.to_numpy()
                opens, names, closes = (np.flatnonzero(ids == top + k) for k in range(3))
                pieces = [ids[lo + 1 : hi] for lo, hi in zip(opens, names, strict=True)] + [ids[lo + 1 : hi] for lo, hi in zip(names, closes, strict=True)]
                # The text under the mask, each run of ones by itself.
                edge = np.diff(np.concatenate([[0], mask, [0]]))
                pieces += [ids[lo:hi] for lo, hi in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1), strict=True)]
                said = t.decode_batch([p.tolist() for p in pieces], skip_special_tokens=False) if pieces else []
                n = len(opens)
                for role, text in zip(said[:n], said[n : 2 * n], strict=True):
                    state[1].update(f"{unescape(role)}\n{unescape(text)}\n".encode())
                    state[4] += len(OPEN) + len(role) + len(NAMED) + len(text) + len(CLOSE)
                state[0] += n
                for x in said[2 * n :]:
                    x = unescape(x)
                    state[2] += len(x)
                    state[3].update(x.encode())
        if state:
            yield out()

    rows = formatted.select(F.col(conv_col).alias("conv"), "input_ids", "loss_mask")
    got = rows.mapInArrow(read, "conv bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint")
    return got.withColumnRenamed("conv", conv_col)


def escaped_chars(text: Column) -> Column:
    """Code points of a text once escaped."""
    return F.char_length(F.regexp_replace(text, r"(\\|###|</turn>)", r"\\$1"))
