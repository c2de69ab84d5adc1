"""Hot keys, many links, default parameters: results whole, and no task that holds a hot key alone."""

from __future__ import annotations

import random
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidemark.llm import chat, common, queries, token_files
from tidemark.llm.embedding_dedup import embedding_near_dedup
from tidemark.llm.exact_dedup import exact_dedup
from tidemark.llm.minhash_dedup import near_dedup
from tidemark.llm.mixing import mix
from tidemark.llm.shingles import shingle_sets


def test_frames_made_of_ranges(spark):
    docs = spark.range(0, 3000).select(F.col("id").alias("doc_id"), F.concat(F.lit("a b c d "), (F.col("id") % 7).cast("string")).alias("text"), F.lit("s").alias("source"))
    assert exact_dedup(docs).where("kept").count() == 7
    assert near_dedup(docs).where("kept").count() == 7
    assert mix(docs).agg(F.sum("taken")).first()[0] == 15_000
    vectors = spark.range(0, 600).select(F.col("id").alias("vec_id"), F.array(F.cos(F.col("id") % 6), F.sin(F.col("id") % 6)).alias("embedding"))
    got = embedding_near_dedup(vectors).collect()
    assert {r.component_id for r in got} == set(range(6)) and {r.n_links for r in got} == {99}


# --- hot keys ----------------------------------------------------------------------------------


@pytest.fixture
def skewed(spark):
    """Limits at which the planner splits small tables as it splits large ones."""
    new = {"autoBroadcastJoinThreshold": "-1", "adaptive.advisoryPartitionSizeInBytes": "64k", "adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k", "adaptive.skewJoin.skewedPartitionFactor": "2", "adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(f"spark.sql.{k}", None) for k in new}
    for k, v in new.items():
        spark.conf.set(f"spark.sql.{k}", v)
    yield
    for k, v in old.items():
        spark.conf.set(f"spark.sql.{k}", v) if v is not None else spark.conf.unset(f"spark.sql.{k}")


def test_a_hot_key_is_split_where_its_aggregate_is_joined_back(spark, skewed):
    data = common.saved(spark.range(0, 400_000, 1, 16).select(F.when(F.col("id") % 20 > 0, 7).otherwise(F.col("id")).alias("n"), F.md5(F.col("id").cast("string")).alias("o")))
    joined = data.join(common.per_key(data, ["n"], F.min("o").alias("m")), "n")
    per_task = joined.select(F.spark_partition_id().alias("p"), "m", "o").groupBy("p").agg(F.count("m").alias("c"), F.max("o")).collect()
    assert sum(r.c for r in per_task) == 400_000 and max(r.c for r in per_task) <= 100_000


def test_one_component_of_a_million_nodes(spark, skewed):
    n = 1_000_000
    edges = spark.range(1, n, 1, 16).select(F.col("id").alias("a"), F.when(F.col("id") % 3 > 0, F.lit(0)).otherwise(F.col("id") - 1).alias("b"))
    got = common.connected_components(edges)
    assert got.agg(F.count("*"), F.min("component"), F.max("component"), F.count_distinct("node")).first() == (n, 0, 0, n)


def test_an_id_with_many_rows_is_spread_over_files(spark, tmp_path):
    texts = [f"text {i} of many" for i in range(3000)] + ["same"] * 3000
    docs = spark.createDataFrame([(None if i % 2 else 5, t) for i, t in enumerate(texts)], "doc_id long, text string")
    at = str(tmp_path / "f")
    token_files.write_token_files(docs, queries._tokenizer("byte_bpe_50k.json"), at, files=8)
    got = token_files.read_token_files(spark, at).collect()
    want = Counter((r.doc_id, r.n_tokens) for r in got)
    assert len(got) == 6000 and sum(v for (i, _), v in want.items() if i is None) == 3000
    ends = sorted((r.start, r.start + r.n_tokens) for r in got)
    assert ends[0][0] == 0 and all(a[1] == b[0] for a, b in zip(ends, ends[1:]))
    assert [r.doc_id for r in sorted(got, key=lambda r: r.start)] == [None] * 3000 + [5] * 3000
    assert spark.read.parquet(f"{at}/blocks").select("file").distinct().count() >= 6 and not (tmp_path / "f" / "staged").exists()


# --- default parameters ------------------------------------------------------------------------


def _clusters(n, dim, seed):
    rng = np.random.RandomState(seed)
    centres = rng.standard_normal((n // 12, dim))
    x = centres[np.arange(n) % len(centres)] + rng.standard_normal((n, dim)) * 0.34
    return x.astype(np.float32)


def test_embedding_links_at_the_default_recall(spark):
    x = _clusters(15_000, 64, 3)
    df = spark.createDataFrame(pa.table({"vec_id": np.arange(len(x)), "embedding": pa.array(list(x), pa.list_(pa.float32()))}))
    got = np.zeros(len(x), int)
    for r in embedding_near_dedup(df).collect():
        got[r.vec_id] = r.n_links
    unit = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    want = np.concatenate([(unit[k : k + 1000] @ unit.T >= 0.9).sum(axis=1) - 1 for k in range(0, len(x), 1000)])
    assert want.sum() > 30_000 and (got <= want).all() and got.sum() >= 0.999 * want.sum()


def test_planted_vectors_against_the_sql(spark, tmp_path):
    """The given tables hold no links, so the query meets its SQL on planted ones as well."""
    rng = np.random.RandomState(1)
    base = rng.standard_normal((40, 32))
    x = np.repeat(base, 5, axis=0) + rng.standard_normal((200, 32)) * np.repeat([0, 0.05, 0.1, 0.2, 0.3], 40)[:, None]
    vectors = [*x.astype(np.float32).tolist(), None, [0.0] * 32, [float("nan")] * 32, [1.0, 2.0]]
    pq.write_table(pa.table({"vec_id": np.arange(len(vectors)), "embedding": pa.array(vectors, pa.list_(pa.float32()))}), tmp_path / "embeddings.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/embeddings.parquet'")
    want = con.execute(queries.oracle_sql()["op1_embedding_dedup"]).df()
    assert want.n_links.sum() > 100
    assert rows(queries.op1_embedding_dedup(spark, str(tmp_path)).toPandas()) == rows(want)


def test_near_duplicates_of_ten_thousand_documents(spark):
    """At default parameters, against an exact join: every link shares one of a set's rarest shingles."""
    at = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{at}/documents.parquet").select("doc_id", "text").toPandas()
    sets = shingle_sets(pa.array(docs.text), 4)
    often = Counter(v for s in sets for v in s.tolist())
    rare, where = [], {}
    for i, s in enumerate(sets):
        first = sorted(s.tolist(), key=lambda v: (often[v], v))[: len(s) - -(-len(s) * 4 // 5) + 1]
        rare.append(first)
        for v in first:
            where.setdefault(v, []).append(i)
    label = list(range(len(sets)))

    def top(i):
        while label[i] != i:
            label[i] = label[label[i]]
            i = label[i]
        return i

    order = docs.doc_id.to_numpy()
    for i, first in enumerate(rare):
        for j in {j for v in first for j in where[v] if j < i}:
            a, b = top(i), top(j)
            if a != b:
                both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                if 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                    label[a if order[a] > order[b] else b] = b if order[a] > order[b] else a
    want = {int(order[i]): (len(s), int(order[top(i)])) for i, s in enumerate(sets)}
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in queries.op6_minhash_dedup(spark, at).collect()}
    assert sum(c != i for i, (_, c) in want.items()) > 700
    assert got == want


# --- chat --------------------------------------------------------------------------------------


def test_no_control_string_is_left_bare():
    pick = random.Random(2)
    for _ in range(3000):
        text = "".join(pick.choice(["#", "##", "### ", "\\", "</turn>", "</", "turn>", ": ", "a"]) for _ in range(pick.randrange(9)))
        for name in (False, True):
            said = chat.escape(text, name)
            assert chat.unescape(said) == text
            bare, i = [], 0
            while i < len(said):  # what a reader sees that skips escaped characters
                bare.append("\0" if said[i] == "\\" else said[i])
                i += 2 if said[i] == "\\" else 1
            assert "###" not in "".join(bare) and "</turn>" not in "".join(bare) and not (name and ":" in bare)
