"""A corpus pipeline: quality, exact duplicates, near duplicates, mixing, tokens.

Each stage takes (spark, docs, sf_dir), works on all rows the one before it kept, and its result is
written as Parquet and read again. All but the last return the columns of documents, whatever further ones
there are and however they are named.

Stages that decide on rows tell them by number. Where ids are whole numbers, unique and not null, the id is the number, which one
light aggregate tells; elsewhere (text ids among them, whatever they look like) the rows are numbered in order of id, null last,
and kept in the shared folder, so rows that repeat an id are judged one by one and of equal rows one stays.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.bpe import bpe_encode
from tidemark.llm.common import crc_mod, remove, saved, shared_dir, table
from tidemark.llm.exact_dedup import exact_dedup
from tidemark.llm.minhash_dedup import near_dedup
from tidemark.llm.mixing import mix
from tidemark.llm.quality import quality


def _free(docs: DataFrame, name: str) -> str:
    """A column name that ``docs`` doesn't have."""
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name += "_"
    return name


def _columns(docs: DataFrame) -> list:
    return [F.col(f"`{c}`") for c in docs.columns]


def _numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with a unique long in a further column, and that column's name."""
    row = _free(docs, "row")
    whole = isinstance(docs.schema["doc_id"].dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType))
    if whole and docs.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1 OR doc_id IS NULL").isEmpty():
        return docs.withColumn(row, F.col("doc_id").cast("long")), row
    # The text's hash and the place of a row spread an id with many rows over the ranges.
    order = [F.col("doc_id").asc_nulls_last(), F.xxhash64("text"), F.col(row)]
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = docs.withColumn(row, F.monotonically_increasing_id()).repartitionByRange(n, *order).sortWithinPartitions(*order)
    return saved(placed.withColumn(row, F.monotonically_increasing_id())), row


def _only(rows: DataFrame, row: str, kept: DataFrame) -> DataFrame:
    """The rows whose number is kept, without it."""
    return rows.join(kept.select(row), row, "left_semi").drop(row)


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line field scores 0.7 or more; it learns from the labels that are not held out."""
    score = _free(docs, "score")
    scored = quality(docs, table(spark, sf_dir, "labels"), crc_mod("doc_id", 4) != 2, score_col=score)
    return scored.where(F.col(score) >= 0.7).select(*_columns(docs))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the longest, then smallest id; of rows that agree in both, one."""
    rows, row = _numbered(docs)
    return _only(rows, row, exact_dedup(rows, row).where("kept")).select(*_columns(docs))


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every component of texts alike in 80 % of their five-word shingles the smallest id; texts without words link with nothing and stay."""
    rows, row = _numbered(docs)
    return _only(rows, row, near_dedup(rows, row).where("kept")).select(*_columns(docs))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row as often as the mix takes it."""
    rows, row = _numbered(docs)
    copies, copy = _free(rows, "copies"), _free(rows, "copy")
    taken = mix(rows, row).where("copies > 0").select(row, F.col("copies").alias(copies))
    out = rows.join(taken, row).withColumn(copy, F.explode(F.sequence(F.lit(1).cast("long"), F.col(copies))))
    return out.select(*_columns(docs))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row's id, source, number of tokens and token ids."""
    import public_tokenizers

    ids = bpe_encode(docs.select("doc_id", "source", "text"), public_tokenizers.path("word_bpe_49k.json"), with_text=False)
    return ids.select("doc_id", "source", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", good_quality),
    ("exact_dedup", without_copies),
    ("near_dedup", without_near_copies),
    ("mixing", mixed),
    ("bpe", tokens),
]

#: SQL can't express the field or the merges; the tests hold every stage against a plain Python version on its own input.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage; its folder stays, those of the others are deleted once the next one is written."""
    docs = table(spark, sf_dir, "documents")
    folder, last = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}", None
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        if last:
            remove(spark, f"{folder}/{last}")
        last = name
    return docs
