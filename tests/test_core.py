"""Operators on small frames: nulls, ties, empty increments, replays, files, JDBC."""

from __future__ import annotations

import datetime
import random

import pytest
from pyspark.sql import functions as F

from tidemark import functions as fn
from tidemark import sources
from tidemark.operators import changes as log
from tidemark.operators import increment, merge, schema, specs, state
from tidemark.plans import run as runs
from tidemark.plans.store import Target
from tidemark.sources import catalog
from tidemark.streaming import csv_stream

DAY = datetime.datetime(2024, 1, 1)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_increment_edges(spark):
    df = spark.createDataFrame([(1, -5), (2, 0), (3, None), (4, 7), (5, 7)], "id int, k int")
    assert got(increment.read(df, {"k": -9})[0].select("id")) == [(1,), (2,), (4,), (5,)]
    assert increment.read(df, {"k": 7}) [0].count() == 0
    assert got(increment.read(df, {"k": 0}, include_nulls=True)[0].select("id")) == [(3,), (4,), (5,)]
    part, upper = increment.read(df, {"k": 0}, limit=1)
    assert got(part.select("id")) == [(4,), (5,)] and upper == {"k": 7}
    empty, upper = increment.read(df.where("k is null"), {"k": 3})
    assert empty.count() == 0 and upper == {"k": 3}
    assert increment.read(df.where("false"), {"k": 3}, limit=5)[1] == {"k": 3}


def test_two_keys_one_all_null(spark):
    df = spark.createDataFrame([(1, None, 5)], "id int, a int, b int")
    rows, upper = increment.read(df, {"a": 0, "b": 1})
    assert rows.count() == 1 and upper == {"a": 0, "b": 5}


def test_values(spark):
    df = spark.createDataFrame([("Ab9-é", True, bytearray(b"\x01"), 1.5), (None, None, None, None)], "t string, b boolean, x binary, d double")
    assert got(log.normalize_values(log.mask(df, ["T"]))) == sorted([("Xx9-é".replace("x", "X"), "1", b"\x01", "1.5"), (None,) * 4], key=str)
    times = spark.createDataFrame([("2024-01-01T00:00:00Z",), ("12.9",), ("x",), (None,)], "t string")
    assert [r[0] for r in times.select(fn.epoch_millis(F.col("t"))).collect()] == [1704067200000, 12, None, None]
    docs = spark.createDataFrame([('{"a":"x1","b":null,"c":5}',), (None,)], "d string")
    assert [r[0] for r in log.mask_document(docs, "d", ["a", "b"]).collect()] == ['{"a":"X9","b":null,"c":"5"}', None]


def test_changes_are_checked(spark):
    bad = spark.createDataFrame([("X", DAY, 1, 1)], "_op string, _ts timestamp, _seq long, k int")
    with pytest.raises(Exception, match="unknown operation"):
        log.checked(bad, ["k"]).collect()
    nulls = spark.createDataFrame([("I", DAY, 1, None)], "_op string, _ts timestamp, _seq long, k int")
    with pytest.raises(Exception, match="null key"):
        log.checked(nulls, ["k"]).collect()


def test_delete_missing_spares_the_target_of_an_empty_source(spark):
    target = spark.createDataFrame([(1,), (2,)], "k int")
    alive, gone = merge.delete_missing(target, target.where("false"), ["k"])
    assert alive.count() == 2 and gone.count() == 0


def test_soft_delete_keeps_unknown(spark):
    df = spark.createDataFrame([(1, "F"), (2, None), (3, "O")], "k int, s string")
    assert got(merge.soft_delete(df, "s = 'F'").select("k")) == [(2,), (3,)]


def test_schema(spark):
    df = spark.createDataFrame([(1, "x", 2)], "ID int, gone string, n int")
    new = schema.evolve(df, "n string, id long, extra double")
    assert new.columns == ["n", "id", "extra"] and got(new) == [("2", 1, None)]
    assert schema.evolve(new, "n string, id long, extra double").schema == new.schema
    old = spark.createDataFrame([("id", "int null")], "col string, def string")
    assert got(schema.schema_diff(old, spark.createDataFrame([("ID", "INT  NULL"), ("a b", "TEXT NULL")], "col string, def string"))) == [("ADD", "a b", "TEXT NULL")]


def test_specs(spark):
    df = spark.createDataFrame([('["id BIGINT NOT NULL", "\\"full name\\" VARCHAR(20) NULL"]',)], "allowed_columns string")
    assert got(specs.explode_columns(df).select("ord", "col", "col_type", "nullable")) == [(1, "ID", "bigint", False), (2, "FULL NAME", "varchar(20)", True)]


def test_state(spark):
    cp = spark.createDataFrame([("a", "ts", "1"), ("b", "id", "2")], "object string, col string, value string")
    seen = spark.createDataFrame([("a", "ts", "9"), ("b", "id", None)], "object string, col string, value string")
    assert got(state.advance(cp, seen)) == [("a", "ts", "9"), ("b", "id", "2")]
    assert got(state.reset(cp, ["a"])) == [("b", "id", "2")]


def _changes(spark, n, seed):
    pick = random.Random(seed)
    rows = [(pick.choice("IUDR"), DAY + datetime.timedelta(seconds=pick.randrange(20)), i, pick.randrange(12), pick.random()) for i in range(n)]
    return spark.createDataFrame(rows, "_op string, _ts timestamp, _seq long, k int, v double")


@pytest.mark.parametrize("seed", [1, 2])
def test_any_split_and_replay_gives_one_target(spark, tmp_path, seed):
    changes = _changes(spark, 80, seed)
    want = got(log.latest(changes, ["k"], ["_ts", "_seq"]).where("_op <> 'D'").select("k", "v"))
    target = Target(spark, str(tmp_path / "t"), ["k"], buckets=4)
    for i, part in enumerate(changes.randomSplit([1.0, 2.0, 1.0], seed)):
        assert target.apply(part, f"b{i}")
        assert not target.apply(part, f"b{i}")
    target.apply(changes.where("_seq < 40"), "again")
    assert got(target.read().select("k", "v")) == want
    target.compact()
    assert target.vacuum() >= 1
    assert got(target.read().select("k", "v")) == want


def test_two_writers_of_one_version(spark, tmp_path):
    target = Target(spark, str(tmp_path / "t"), ["k"])
    state = target.manifest()
    target._commit(dict(state))
    with pytest.raises(Exception, match="exist"):
        target._commit(dict(state))


def test_target_takes_new_columns(spark, tmp_path):
    target = Target(spark, str(tmp_path / "t"), ["k"])
    a = log.emit(spark.createDataFrame([(1, "x"), (2, "y")], "k int, v string"), "I", "1", F.lit(DAY), F.lit(1))
    b = log.emit(spark.createDataFrame([(2, "z", 5)], "k int, v string, w int"), "U", "2", F.lit(DAY), F.lit(2))
    target.apply(a, "1")
    target.apply(b, "2")
    assert got(target.read()) == [(1, "x", None), (2, "z", 5)]


def test_run_reads_increments_and_syncs_deletes(spark, tmp_path):
    source = {"o": spark.createDataFrame([(1, 10, "a1"), (2, 20, "b2")], "k int, u int, v string")}
    target = Target(spark, str(tmp_path / "t"), ["k"], buckets=4)
    spec = runs.ObjectSpec("o", ["k"], incremental={"u": 0}, masked=["V"])
    bad = runs.ObjectSpec("missing", ["k"], group="g", position=1)
    later = runs.ObjectSpec("o", ["k"], incremental={"u": 0}, group="g", position=2)

    def go(specs, work=runs.read_object):
        return {r.object: (r.records, r.status) for r in runs.run(spark, specs, lambda n: source[n], lambda s: target, str(tmp_path / "log"), work).collect()}

    assert go([spec]) == {"o": (2, "SUCCESS")}
    assert go([spec]) == {"o": (0, "SUCCESS")}
    source["o"] = spark.createDataFrame([(2, 30, "c3"), (3, 40, "d4")], "k int, u int, v string")
    assert go([spec]) == {"o": (2, "SUCCESS")}
    assert got(target.read()) == [(1, 10, "X9"), (2, 30, "X9"), (3, 40, "X9")]
    assert go([spec], runs.delete_sync_object)["o"][1] == "SUCCESS"
    assert got(target.read().select("k")) == [(2,), (3,)]
    assert go([bad, later]) == {"missing": (0, "ERROR")}


def test_snapshot_runs_once(spark, tmp_path):
    df = spark.createDataFrame([(1,)], "k int")
    target = Target(spark, str(tmp_path / "t"), ["k"])
    spec = runs.ObjectSpec("o", ["k"])
    assert runs.read_object(spec, df, target, "r1")["records"] == 1
    assert runs.read_object(spec, df, target, "r2")["records"] == 0


def test_csv(spark, tmp_path):
    (tmp_path / "in" / "sub").mkdir(parents=True)
    (tmp_path / "in" / "a.csv").write_text('id,name,x\n1,"a, ""b""", p \n\n2,null,""\n3,short\n')
    (tmp_path / "in" / "sub" / "b.csv").write_text("id,name,x\n4,d,e,extra\n")
    at = str(tmp_path / "in")
    names = sources.csv_schema(spark, at)
    assert names.names == ["id", "name", "x"]
    rows = {r.id: (r.name, r.x) for r in sources.csv(spark, at, names).collect()}
    assert rows["1"] == ('a, "b"', "p") and rows["2"][0] is None and rows["3"] == ("short", None) and rows["4"] == ("d", "e")
    assert sources.csv(spark, at, names, after=datetime.datetime.now() + datetime.timedelta(days=1)).count() == 0
    assert got(catalog.list_folders(spark, at)) == [("sub",)]
    out = str(tmp_path / "out")
    csv_stream(spark, at, "id string, name string, x string").writeStream.format("parquet").option("path", out).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination()
    assert spark.read.parquet(out).count() == 4


def test_json_documents(spark, tmp_path):
    (tmp_path / "d.json").write_text('{"_id":"a","n":1,"t":"2024-01-01"}\n{"_id":"b","n":null}\n{"_id":"c"}\n')
    docs = sources.json_documents(spark, str(tmp_path))
    assert got(docs.select("_id", sources.document_field("document", "n", "int"))) == [("a", 1), ("b", None), ("c", None)]


def test_jdbc(spark, tables):
    url = "jdbc:derby:memory:test;create=true"
    orders = spark.read.parquet(f"{tables}/orders.parquet").select("o_orderkey", "o_orderstatus")
    orders.write.jdbc(url, "ORDERS", mode="overwrite", properties={"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"})
    whole = sources.jdbc(spark, url, "ORDERS", driver="org.apache.derby.iapi.jdbc.AutoloadedDriver")
    rows, upper = increment.read(whole.withColumnRenamed("o_orderkey", "k"), {"k": 100})
    assert rows.count() == orders.where("o_orderkey > 100").count()
    parts = sources.jdbc(spark, url, "ORDERS", ['"o_orderkey" < 100', '"o_orderkey" >= 100'], driver="org.apache.derby.iapi.jdbc.AutoloadedDriver")
    assert parts.rdd.getNumPartitions() == 2 and parts.count() == orders.count()
