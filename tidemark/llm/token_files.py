"""Token ids in files: frequency-ranked, byte-aligned codes of variable length.

Ids are replaced by their rank of frequency over the whole corpus, so the common ones take one byte. Four
ranks share a control byte (two bits each: length less one); control and data bytes are kept
apart, so a block is decoded by table lookups without a branch.

The file format is a folder of Parquet files, one row per block: ``file`` and ``block`` give
the order, ``doc_ids`` and ``lens`` the documents, ``offset`` the ids of the file before the block,
``control`` and ``data`` the codes; the folder ``codebook`` beside it maps ranks to ids. Spark's writers
commit them, so a lost executor leaves no half-written file.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import remove
from .presplit import byte_level_pieces, is_plain

#: For every control byte the lengths of its four codes.
LENGTHS = (np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3).astype(np.uint8) + 1


def pack(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """Control and data bytes of unsigned 32-bit ranks."""
    r = np.ascontiguousarray(ranks, "<u4")
    size = ((r >= 1 << 8).astype(np.uint8) + (r >= 1 << 16) + (r >= 1 << 24)).astype(np.uint8)
    data = r.view(np.uint8).reshape(-1, 4)[np.arange(4, dtype=np.uint8) <= size[:, None]]
    quads = np.zeros(-(-len(r) // 4) * 4, np.uint8)
    quads[: len(r)] = size
    control = (quads.reshape(-1, 4) << np.array([0, 2, 4, 6], np.uint8)).sum(axis=1).astype(np.uint8)
    return control.tobytes(), data.tobytes()


def unpack(control: bytes, data: bytes, n: int) -> np.ndarray:
    size = LENGTHS[np.frombuffer(control, np.uint8)].ravel()[:n]
    ends = np.cumsum(size, dtype=np.int64)
    at = ends - size
    d = np.frombuffer(data + b"\0\0\0", np.uint8)
    out = d[at].astype(np.uint32)
    for k in (1, 2, 3):
        some = np.flatnonzero(size > k)
        if len(some):
            out[some] |= d[at[some] + k].astype(np.uint32) << np.uint32(8 * k)
    return out


class Words(dict):
    """Pieces of texts -> their place in the ids that the library gives them; it forgets all when it holds ``most``."""

    def __init__(self, spec: str, most: int = 1_000_000) -> None:
        from tokenizers import Tokenizer

        super().__init__()
        self.most, self.tokenizer = most, Tokenizer.from_str(spec)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.clear()

    def clear(self) -> None:
        super().clear()
        self.ids, self.counts = np.zeros(0, np.uint32), np.zeros(0, np.int64)

    def learn(self, words: list[bytes]) -> None:
        """Words that begin with one space keep apart when they are joined, so they are encoded as one text."""
        joined, single = [], []
        for w in words:
            (joined if len(w) > 1 and w[0] == 32 and not w[1:2].isspace() and b"'" not in w else single).append(w)
        ids, counts = [self.ids], [self.counts]
        for k in range(0, len(joined), 100):
            part = joined[k : k + 100]
            e = self.tokenizer.encode(b"".join(part).decode(), add_special_tokens=False)
            ids.append(np.array(e.ids, np.uint32))
            counts.append(np.bincount(np.array(e.word_ids, np.int64), minlength=len(part)))
            if len(counts[-1]) != len(part):
                raise ValueError("the tokenizer does not split the joined words as it splits the text")
        for e in self.tokenizer.encode_batch_fast([w.decode() for w in single], add_special_tokens=False):
            ids.append(np.array(e.ids, np.uint32))
            counts.append(np.array([len(e.ids)], np.int64))
        self.update(zip(joined + single, range(len(self), len(self) + len(words)), strict=True))
        self.ids, self.counts = np.concatenate(ids), np.concatenate(counts)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        plain = [i for i, x in enumerate(texts) if is_plain(x) and not any(s in x for s in self.special)]
        pieces, bounds = byte_level_pieces([texts[i] for i in plain])
        code = pieces.dictionary_encode()
        _, at, data = code.dictionary.buffers()
        at = np.frombuffer(at, np.int64)[: len(code.dictionary) + 1].tolist()
        data = data.to_pybytes() if data else b""
        names = [data[lo:hi] for lo, hi in zip(at[:-1], at[1:], strict=True)]
        new = [w for w in names if w not in self]
        if len(self) + len(new) > self.most:
            self.clear()
            new = names
        self.learn(new)
        place = np.fromiter(map(self.__getitem__, names), np.int64, len(names))[code.indices.to_numpy()]
        n = self.counts[place]
        ends = np.concatenate([[0], np.cumsum(n)])
        starts = np.cumsum(self.counts) - self.counts
        found = self.ids[np.repeat(starts[place] - ends[:-1], n) + np.arange(ends[-1])]
        out: list = [None] * len(texts)
        for i, lo, hi in zip(plain, ends[bounds[:-1]].tolist(), ends[bounds[1:]].tolist(), strict=True):
            out[i] = found[lo:hi]
        return [np.array(self.tokenizer.encode(x, add_special_tokens=False).ids, np.uint32) if ids is None else ids for x, ids in zip(texts, out, strict=True)]


@lru_cache(1)
def _words(spec: str) -> Words:
    return Words(spec)


def write_token_files(docs: DataFrame, tokenizer: str, path: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 0, block_ids: int = 1 << 18, files: int | None = None) -> None:
    """Encode every text, append ``end_id`` and write the ids in ascending order of the document id, a whole number.

    A null text is empty and leaves the end id alone. Null ids come first; rows that repeat an id are
    ordered by a hash of their tokens, so that an id with many rows is spread over tasks; equal rows are
    interchangeable. An empty table leaves an empty folder with a schema.
    """
    spark = docs.sparkSession
    with open(tokenizer, encoding="utf-8") as f:
        spec = spark.sparkContext.broadcast(f.read())
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _words(spec.value)
        wide = words.size > 1 << 16 or end_id >= 1 << 16
        end = np.array([end_id], np.uint32)
        for whole in batches:
            for k in range(0, whole.num_rows, 1000):
                b = whole.slice(k, 1000)
                got = [np.concatenate([x, end]) for x in words.encode([x or "" for x in b.column("text").to_pylist()])]
                yield pa.RecordBatch.from_arrays([b.column("id"), pa.array([x.astype("<u4" if wide else "<u2").tobytes() for x in got], pa.binary()), pa.array([wide] * len(got), pa.bool_())], ["id", "ids", "wide"])

    staged = f"{path}/staged"
    # The number only keeps equal rows apart where they are dealt out by ranges.
    coded = rows.mapInArrow(encode, "id bigint, ids binary, wide boolean").withColumn("row", F.monotonically_increasing_id())
    coded.write.option("compression", "zstd").parquet(staged)
    tokens = spark.read.schema("id bigint, ids binary, wide boolean, row bigint").parquet(staged)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for b in batches:
            rows = list(zip(b.column("ids").to_pylist(), b.column("wide").to_pylist(), strict=True))
            for wide, kind in ((False, "<u2"), (True, "<u4")):
                c = np.bincount(np.frombuffer(b"".join([x for x, w in rows if w == wide]), kind), minlength=len(total))
                c[: len(total)] += total
                total = c
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used], pa.int64())], ["id", "n"])

    counts = tokens.select("ids", "wide").mapInArrow(count, "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n"))
    # At most one row for each id of the vocabulary.
    ranked = sorted(((-r.n, r.id) for r in counts.collect()))
    order = np.array([i for _, i in ranked], np.int64)
    ranks = np.zeros(int(order.max()) + 1 if len(order) else 1, np.uint32)
    ranks[order] = np.arange(len(order), dtype=np.uint32)
    table = spark.sparkContext.broadcast(ranks)
    spark.createDataFrame([(i, int(x)) for i, x in enumerate(order)], "rank int, id bigint").coalesce(1).write.parquet(f"{path}/codebook")

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file = TaskContext.get().partitionId()
        block = offset = size = 0
        docs: list = []
        held: list[np.ndarray] = []

        def out() -> pa.RecordBatch:
            control, data = pack(table.value[np.concatenate(held)])
            return pa.RecordBatch.from_arrays([pa.array([file], pa.int32()), pa.array([block], pa.int32()), pa.array([offset], pa.int64()), pa.array([docs], pa.list_(pa.int64())), pa.array([[len(x) for x in held]], pa.list_(pa.int64())), pa.array([control], pa.binary()), pa.array([data], pa.binary())], ["file", "block", "offset", "doc_ids", "lens", "control", "data"])

        for b in batches:
            for i, ids, wide in zip(b.column("id").to_pylist(), b.column("ids").to_pylist(), b.column("wide").to_pylist(), strict=True):
                x = np.frombuffer(ids, "<u4" if wide else "<u2")
                if held and size + len(x) > block_ids:
                    yield out()
                    block, offset, size, docs, held = block + 1, offset + size, 0, [], []
                docs.append(i)
                held.append(x)
                size += len(x)
        if held:
            yield out()

    n = files or int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = ["id", F.xxhash64("ids"), "row"]
    placed = tokens.repartitionByRange(n, *order).sortWithinPartitions(*order).drop("row")
    placed.mapInArrow(blocks, "file int, block int, offset bigint, doc_ids array<bigint>, lens array<bigint>, control binary, data binary").write.parquet(f"{path}/blocks")
    remove(spark, staged)


def read_token_files(spark: SparkSession, path: str, id_col: str = "doc_id", with_ids: bool = True) -> DataFrame:
    """One row per document of the files: id, start, n_tokens, ids_crc32 and, if asked for, ids (array<bigint>)."""
    # The codebook has at most one row for each id of the vocabulary.
    book = spark.sparkContext.broadcast(np.array([r.id for r in spark.read.parquet(f"{path}/codebook").orderBy("rank").collect()], np.uint32))
    stored = spark.read.parquet(f"{path}/blocks")
    sums = stored.select("file", F.aggregate("lens", F.lit(0).cast("long"), lambda a, x: a + x).alias("n")).groupBy("file").agg(F.sum("n").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = sums.select("file", before.alias("file_start"))  # one row per file

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for k in range(whole.num_rows):
                b = whole.slice(k, 1)
                lens = b.column("lens")[0].values.to_numpy()
                ids = book.value[unpack(b.column("control")[0].as_py(), b.column("data")[0].as_py(), int(lens.sum()))]
                ends = np.cumsum(lens)
                base = b.column("file_start")[0].as_py() + b.column("offset")[0].as_py()
                crc = [zlib.crc32(ids[e - n : e].astype("<u4").tobytes()) for e, n in zip(ends, lens, strict=True)]
                out = [b.column("doc_ids")[0].values, pa.array(base + ends - lens), pa.array(lens), pa.array(crc, pa.int64())]
                if with_ids:
                    out.append(pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(ids.astype(np.int64))))
                yield pa.RecordBatch.from_arrays(out, names)

    names = ["id", "start", "n_tokens", "ids_crc32", *["ids"] * with_ids]
    rows = stored.join(starts, "file").select("file_start", "offset", "doc_ids", "lens", "control", "data")
    return rows.mapInArrow(decode, "id bigint, start bigint, n_tokens bigint, ids_crc32 bigint" + ", ids array<bigint>" * with_ids).withColumnRenamed("id", id_col)
