"""Stored targets, runs over changing sources, streams, discovery: nothing is lost, whatever comes again or goes wrong."""

from __future__ import annotations

import datetime
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import functions as fn
from tidemark import sources
from tidemark.operators import changes as log
from tidemark.operators import increment, merge, reports, specs, state
from tidemark.plans import run as runs
from tidemark.plans.store import Target
from tidemark.sources import catalog
from tidemark.streaming import LogSource, apply_stream, change_stream, finished

DAY = datetime.datetime(2024, 1, 1)
DERBY = "org.apache.derby.iapi.jdbc.AutoloadedDriver"


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def records(spark, rows, op="I", seq=1, schema="k int, v string"):
    return log.emit(spark.createDataFrame(rows, schema), op, "b", F.lit(DAY), F.lit(seq))


# --- the stored target -------------------------------------------------------------------------


def test_a_reopened_target_keeps_its_rows_and_key(spark, tmp_path):
    at = str(tmp_path / "t")
    Target(spark, at, ["k"], buckets=4).apply(records(spark, [(i, "a") for i in range(100)]), "1")
    for n in (3, 8, None):
        target = Target(spark, at, ["k"], buckets=n)
        target.apply(records(spark, [(1, f"b{n}"), (200, "c")], seq=n or 9), f"n{n}")
        assert target.read().count() == 101 and target.read().select("k").distinct().count() == 101
    assert got(target.read().where("k = 1")) == [(1, "bNone")]
    with pytest.raises(ValueError, match="key"):
        Target(spark, at, ["v"]).read()


def test_the_log_is_folded_into_a_base_that_says_the_same(spark, tmp_path):
    at = tmp_path / "t"
    target = Target(spark, str(at), ["k"], buckets=7)
    target.apply(records(spark, [(1, "a")]).where("false"), "0")
    assert target.read().count() == 0 and target.read().columns == ["k", "v"]
    target.apply(records(spark, [(i, "a") for i in range(500)]), "1", {"u": 5})
    target.apply(records(spark, [(1, "new"), (2, "old")], seq=3), "2")
    target.apply(records(spark, [(3, None)], "D", seq=3), 4, stream="s")
    want = got(target.read())
    assert len(want) == 499
    target.compact()
    assert got(target.read()) == want and target.manifest()["checkpoint"] == {"u": 5} and len(list(at.glob("data/*"))) == 4
    assert target.vacuum() == 3 and got(target.read()) == want and len(list(at.glob("commits/*"))) == 1
    # Known batches stay known; older changes lose against the base, newer ones and deletes win.
    assert not target.apply(records(spark, [(1, "z")], seq=9), "2") and not target.apply(records(spark, [(1, "z")], seq=9), 3, stream="s")
    target.apply(records(spark, [(1, "older"), (3, "older"), (4, "newer"), (900, "added")], seq=2), "5")
    target.apply(records(spark, [(5, None)], "D", seq=2), "6")
    assert got(target.read().where("k in (1, 3, 4, 5, 900)")) == [(1, "new"), (4, "newer"), (900, "added")]
    small = Target(spark, str(at), ["k"], least=0)
    small.apply(records(spark, [(i, "b") for i in range(400)], seq=8), "7")  # more than half of the base
    assert small.manifest()["log"][-1].kind == "base" and len(small.manifest()["files"]) == 1 and small.read().where("v = 'b'").count() == 400
    small.compact()
    assert len(list(at.glob("commits/*"))) == 2 and small.read().where("v = 'b'").count() == 400


def test_reading_a_small_log_does_not_shuffle_the_base(spark, tmp_path):
    target = Target(spark, str(tmp_path / "t"), ["k"])
    target.apply(records(spark, [(i, "a" * 50) for i in range(5000)]), "1")
    target.compact()
    target.apply(records(spark, [(1, "b")], seq=2), "2")
    df = target.read()
    assert df.count() == 5000
    plan = df._jdf.queryExecution().executedPlan().toString()
    base = target.manifest()["base"].folder.rsplit("/", 1)[-1]
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and base in df.inputFiles()[0] + "".join(df.inputFiles())


def test_a_crash_between_writing_and_committing_leaves_the_old_version(spark, tmp_path, monkeypatch):
    at = tmp_path / "t"
    target = Target(spark, str(at), ["k"], buckets=2)
    target.apply(records(spark, [(1, "a")]), "1")
    (at / "commits" / "000000000002" / "_temporary").mkdir(parents=True)  # a commit that was begun
    monkeypatch.setattr(target, "_commit", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("crash")))
    for work in (lambda: target.apply(records(spark, [(1, "b")], seq=2), "2"), target.compact):
        with pytest.raises(RuntimeError):
            work()
    fresh = Target(spark, str(at), ["k"])
    assert got(fresh.read()) == [(1, "a")] and fresh.manifest()["version"] == 1
    assert fresh.apply(records(spark, [(1, "b")], seq=2), "2") and got(fresh.read()) == [(1, "b")]
    assert fresh.manifest()["batches"] == ["1", "2"] and fresh.vacuum() == 2


def test_a_null_key_is_named(spark, tmp_path):
    target = Target(spark, str(tmp_path / "t"), ["k"])
    with pytest.raises(Exception, match="null key; null are: k"):
        target.apply(records(spark, [(None, "a")]), "1")
    assert not target.columns()
    done, _ = _go(spark, tmp_path, [runs.ObjectSpec("o", ["k"])], spark.createDataFrame([(None, "a")], "k int, v string"))
    assert done["o"].status == "ERROR" and "null are: k" in done["o"].status_description


def test_columns_come_change_and_go(spark, tmp_path):
    target = Target(spark, str(tmp_path / "t"), ["k"], buckets=2)
    target.apply(records(spark, [(1, "7", 1)], schema="k int, v string, w int"), "1")
    field = {f.name: f for f in target.columns()}
    target.alter([field["k"], T.StructField("new", T.StringType()), field["v"]])  # w goes, new comes
    assert target.read().columns == ["k", "new", "v"] and got(target.read()) == [(1, None, "7")]
    target.alter([field["k"], field["w"], field["v"]])  # a column of the dropped name doesn't bring its values back
    assert got(target.read()) == [(1, None, "7")]
    target.alter([T.StructField("v", T.IntegerType()), field["k"]])
    assert got(target.read()) == [(7, 1)] and dict(target.read().dtypes)["v"] == "int"
    target.alter([field["k"]])
    target.apply(records(spark, [(2, 5)], schema="k int, v int", seq=2), "2")
    assert got(target.read()) == [(1, None), (2, 5)]
    with pytest.raises(ValueError, match="key"):
        target.alter([field["v"]])
    target.drop()
    assert not target.columns() and target.manifest()["version"] == 0


def test_streams_have_numbers_of_their_own(spark, tmp_path):
    target = Target(spark, str(tmp_path / "t"), ["k"], buckets=2)
    shape = "_op string, _ts timestamp, _seq bigint, k int, v string"
    for i in range(2):
        records(spark, [(j + 10 * i, "a") for j in range(10)]).drop("_batch").withColumn("_seq", F.lit(1).cast("long")).write.parquet(str(tmp_path / f"in{i}"))
        for _ in range(2):  # and once more after a restart
            apply_stream(change_stream(spark, str(tmp_path / f"in{i}"), shape), target, str(tmp_path / f"cp{i}")).awaitTermination()
    assert target.read().count() == 20
    assert target.apply(records(spark, [(1, "z")], seq=5), 0, stream="s") and not target.apply(records(spark, [(1, "y")], seq=6), 0, stream="s")
    assert got(target.read().where("k = 1")) == [(1, "z")]
    late = change_stream(spark, str(tmp_path / "in0"), shape, since=DAY + datetime.timedelta(days=1))
    apply_stream(late, other := Target(spark, str(tmp_path / "o"), ["k"]), str(tmp_path / "cp2")).awaitTermination()
    assert not other.manifest()["files"]


# --- runs --------------------------------------------------------------------------------------


def _go(spark, tmp_path, specs_, source, **options):
    made = {}
    targets = lambda s: made.setdefault(s.name, Target(spark, str(tmp_path / s.name), s.unique_key, buckets=2))
    out = runs.run(spark, specs_, source if callable(source) else lambda _: source, targets, str(tmp_path / "log"), **options)
    return {r.object: r for r in out.collect()}, made


def test_the_checkpoint_moves_with_the_rows_read(spark, tmp_path):
    spec = runs.ObjectSpec("o", ["k"], incremental={"u": 0}, compute_max=False)
    df = spark.createDataFrame([(1, 5), (2, 7), (3, None)], "k int, u int")
    for n, want in ((2, {"u": "7"}), (0, {"u": "7"})):
        done, made = _go(spark, tmp_path, [spec], df)
        assert done["o"].records == n
    assert Target(spark, str(tmp_path / "o"), ["k"]).manifest()["checkpoint"] == {"u": 7}
    assert not list((tmp_path / "o" / "log").glob("*"))


def test_runs_of_one_name_read_on(spark, tmp_path):
    spec = runs.ObjectSpec("o", ["k"], incremental={"u": 0})
    counts = [_go(spark, tmp_path, [spec], spark.createDataFrame(rows, "k int, u int"), run_id="nightly")[0]["o"].records for rows in ([(1, 1)], [(1, 1), (2, 2)], [(2, 2)])]
    assert counts == [1, 1, 0]


def test_another_set_of_keys_starts_again(spark, tmp_path):
    df = spark.createDataFrame([(1, 5, 1), (2, 7, 2)], "k int, u int, w int")
    read = lambda **keys: _go(spark, tmp_path, [runs.ObjectSpec("o", ["k"], **keys)], df)[0]["o"].records
    assert [read(incremental={"u": 0}), read(incremental={"u": 0}), read(incremental={"w": 0}), read(incremental={"w": 0}), read(incremental={"w": 0, "u": 0}), read(), read()] == [2, 0, 2, 0, 2, 2, 0]


def test_rows_with_null_keys_come_once_by_themselves(spark, tmp_path):
    spec = runs.ObjectSpec("o", ["k"], incremental={"u": 0}, include_nulls=True)
    nulls = spark.createDataFrame([(1, None)], "k int, u int")
    assert [_go(spark, tmp_path, [spec], df)[0]["o"].records for df in (nulls, nulls, nulls.union(spark.createDataFrame([(2, 3)], "k int, u int")))] == [1, 0, 2]


def test_a_run_follows_columns_and_objects_and_tells_it(spark, tmp_path):
    spec = runs.ObjectSpec("o", ["k"], incremental={"u": 0}, masked=["v"])
    a = spark.createDataFrame([(1, 1, "ab")], "k int, u int, v string")
    b = spark.createDataFrame([(2, 2, 9.5)], "k int, u bigint, w double")
    _go(spark, tmp_path, [spec], a)
    done, made = _go(spark, tmp_path, [spec], b)
    assert sorted(done["o"].ddls) == ["ADD COLUMN w double", "ALTER COLUMN u bigint", "DROP COLUMN v"] and done["o"].commit_id == 3
    assert got(made["o"].read()) == [(1, 1, None), (2, 2, 9.5)]
    still = runs.ObjectSpec("o", ["k"], incremental={"u": 0}, follow=False)
    done, made = _go(spark, tmp_path, [still], spark.createDataFrame([(3, 3)], "k int, u bigint"))
    assert made["o"].read().columns == ["k", "u", "w"] and not done["o"].ddls
    flags = spark.createDataFrame([("o", 1, 0, 0, 0)], "object string, schema_next int, schema_each int, object_next int, object_each int")
    done, made = _go(spark, tmp_path, [still], spark.createDataFrame([(4, 4)], "k int, u bigint"), flags=flags)
    assert made["o"].read().columns == ["k", "u"] and (done["o"].schema_reload, done["o"].object_reload) == (1, 0)
    assert got(state.next_flags(flags)) == [("o", 0, 0, 0, 0)]
    gone, new = spark.createDataFrame([("n",)], "object_name string"), runs.ObjectSpec("n", ["k"], group="n")
    done, made = _go(spark, tmp_path, [still], a, listing=gone, adopt=lambda name: new)
    assert (done["o"].action, done["n"].records) == ("DROP", 1) and Target(spark, str(tmp_path / "o"), ["k"]).columns()
    done, _ = _go(spark, tmp_path, [still], a, listing=gone, drop=True)
    assert done["o"].status_description == "DROP TABLE IF EXISTS o" and not Target(spark, str(tmp_path / "o"), ["k"]).columns()


def test_failed_objects_are_read_again_alone(spark, tmp_path):
    df = spark.createDataFrame([(1,)], "k int")
    a, b = runs.ObjectSpec("a", ["k"], group="a"), runs.ObjectSpec("b", ["k"], group="b")
    done, _ = _go(spark, tmp_path, [a, b], lambda name: df if name == "a" else df.select("nope"))
    assert (done["a"].status, done["b"].status) == ("SUCCESS", "ERROR")
    assert runs.failed(spark, str(tmp_path / "log")) == ["b"]
    done, made = _go(spark, tmp_path, [a, b], df, only=runs.failed(spark, str(tmp_path / "log")))
    assert set(done) == {"b"} and done["b"].records == 1 and runs.failed(spark, str(tmp_path / "log")) == []
    whole = spark.read.parquet(str(tmp_path / "log"))
    assert {r.object: (r.last_read_records, r.total_records) for r in reports.statistics(whole).collect()} == {"a": (1, 1), "b": (1, 1)}
    assert (reports.totals(whole).first().failed_objects, reports.totals(whole.where("false")).first().total_objects) == (0, 0)
    runs.reset_job(spark, list(made.values()), str(tmp_path / "log"))
    assert not (tmp_path / "b").exists() and not (tmp_path / "log").exists()


def test_csv_files_are_read_once_and_the_later_one_counts(spark, tmp_path):
    import os

    (tmp_path / "in").mkdir()
    spec = runs.ObjectSpec("o", ["id"], kind="csv", incremental={"_file_time": datetime.datetime(1970, 1, 1)})
    counts = []
    for i, (name, text) in enumerate({"b": "id,v\n1,x\n2,x\n", "a": "id,v\n2,later\n", "": ""}.items()):
        if name:
            (tmp_path / "in" / f"{name}.csv").write_text(text)
            os.utime(tmp_path / "in" / f"{name}.csv", (1_700_000_000 + i, 1_700_000_000 + i))
        if i:
            df = sources.csv(spark, str(tmp_path / "in"), sources.csv_schema(spark, str(tmp_path / "in")))
            done, made = _go(spark, tmp_path, [spec], df)
            counts.append(done["o"].records)
    assert counts == [3, 0] and got(made["o"].read()) == [("1", "x"), ("2", "later")]


# --- increments, merges, specs -----------------------------------------------------------------


def test_a_limit_over_several_keys_passes_no_row_over(spark):
    rows = [(i, i % 7 if i % 3 else None, (i * 5) % 11 if i % 4 else None) for i in range(60)]
    df, lower, seen = spark.createDataFrame(rows, "id int, a int, b int"), {"a": 1, "b": 4}, set()
    for _ in range(30):
        part, upper = increment.read(df, lower, limit=9)
        now = {r.id for r in part.collect()}
        seen |= now
        if not now:
            break
        lower = upper
    assert not now and seen == {i for i, a, b in rows if (a or 0) > 1 or (b or 0) > 4}


def test_a_hot_key_is_cut_before_the_shuffle(spark):
    df = spark.range(10_000, numPartitions=4).select(F.lit(1).alias("k"), F.lit("U").alias("_op"), F.when(F.col("id") % 2 == 0, F.lit(DAY)).alias("_ts"), F.col("id").alias("_seq"))
    last = log.latest(df.union(df.where("_seq = 7").withColumn("k", F.lit(None))), ["k"], ["_ts", "_seq"])
    assert got(last) == [(1, "U", DAY, 9998), (None, "U", None, 7)]
    plan = last._jdf.queryExecution().executedPlan().toString()
    assert plan.index("WindowGroupLimit") < plan.index("hashpartitioning") < plan.rindex("WindowGroupLimit")


def test_null_keys_are_keys(spark):
    df = spark.createDataFrame([(None, "a"), (1, "b")], "k int, v string")
    alive, gone = merge.delete_missing(df, df, ["k"])
    assert alive.count() == 2 and gone.count() == 0
    new = spark.createDataFrame([(None, "z"), (2, "y")], "k int, v string")
    assert got(merge.upsert(df, new, ["k"])) == sorted([(None, "z"), (1, "b"), (2, "y")], key=str)
    assert got(merge.merge_insert_only(df, new, ["k"])) == sorted([(None, "a"), (1, "b"), (2, "y")], key=str)
    assert got(merge.merge_update_subset(df, new, ["k"], ["v"])) == sorted([(None, "z"), (1, "b"), (2, "y")], key=str)
    assert got(merge.replace(df, new.union(new), ["k"])) == sorted([(None, "z"), (None, "z"), (1, "b"), (2, "y"), (2, "y")], key=str)


def test_a_small_upsert_does_not_shuffle_the_target(spark, tables):
    orders = spark.read.parquet(f"{tables}/orders.parquet")
    plan = merge.upsert(orders, orders.where("o_orderkey < 10"), ["o_orderkey"])._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


def test_spec_rules_and_defaults(spark):
    df = spark.createDataFrame([("a", "id, nm", "ID", "", "", "upd"), ("b", "id,upd", "ID", "", "", "UPD"), ("c", None, None, None, None, None)], "n string, cols string, uk string, mask string, del string, ik string")
    assert got(specs.validate(df, "n", "cols", "uk", "mask", "del", "ik")) == [("a", "incremental_key")]
    assert [r[0] for r in df.where("cols is not null").select(specs.effective(F.col("mask"), "NM,UPD", F.col("cols"), part=True)).collect()] == ["NM", "UPD"]
    assert [r[0] for r in df.where("cols is not null").select(specs.effective_condition(F.col("del"), "upd = 1", F.col("cols"))).collect()] == ["", "upd = 1"]
    keys, objects = spark.createDataFrame([("a", "ts", "TIMESTAMP")], "object string, col string, cls string"), spark.createDataFrame([("a",), ("b",)], "object string")
    assert got(state.initial(keys, objects, iso=True)) == [("a", "ts", "0001-01-01T00:00:00Z"), ("b", "", "0")]
    kinds = spark.createDataFrame([("timestamptz",), ("timetz",), ("bytea",)], "t string").select(fn.key_class(F.col("t")))
    assert [r[0] for r in kinds.collect()] == ["TIMESTAMP", "TIMESTAMP", "INVALID"]
    arrays = spark.createDataFrame([("_float8",), ("_bpchar",), ("_x",)], "u string").select(fn.declared_type(F.lit("ARRAY"), F.col("u"), F.lit(0), F.lit(0), F.lit(0)))
    assert [r[0] for r in arrays.collect()] == ["FLOAT[]", "CHARACTER[]", "TEXT[]"]


def test_masks_of_ones_own(spark):
    df = spark.createDataFrame([("abc", '{"a":"x1","b":2}'), (None, None)], "v string, d string")
    hide = lambda c: F.concat(F.left(c, F.lit(1)), F.lit("#"))
    assert got(log.mask_document(log.mask(df, ["V"], masker=hide), "d", ["a"], masker=hide)) == sorted([("a#", '{"a":"x#","b":"2"}'), (None, None)], key=str)


# --- discovery ---------------------------------------------------------------------------------


@pytest.mark.parametrize(("text", "header", "names"), [("1,,3\n4,5,6\n", False, ["col1", "col2", "col3"]), ("a,,c\n1,2,3\n", True, ["a", "col2", "c"]), ('a,"b,c",\n', True, ["a", "b,c", "col3"]), ("\n\n", True, []), ("only\n", True, ["only"])])
def test_csv_columns(spark, tmp_path, text, header, names):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "1.csv").write_text(text)
    (tmp_path / "in" / "2.csv").write_text("x,y\n")
    if not names:
        (tmp_path / "in" / "2.csv").unlink()
    assert sources.csv_schema(spark, str(tmp_path / "in"), sources.CsvDialect(header=header)).names == names


def test_document_keys(spark):
    docs = spark.createDataFrame([('{"a":5}',), ('{"a":"1970-01-01T00:00:02Z"}',), ('{"a":"x"}',), ('{"a":null}',), ("{}",), (None,)], "document string")
    assert [r[0] for r in docs.select(sources.document_key("document", "a")).collect()] == [5.0, 2000.0, None, None, None, None]


def test_jdbc_discovery_and_maxima_in_the_source(spark, tables):
    url = "jdbc:derby:memory:discovery;create=true"
    spark.read.parquet(f"{tables}/orders.parquet").select("o_orderkey", "o_orderstatus").write.jdbc(url, "ORDERS", mode="overwrite", properties={"driver": DERBY})
    name = catalog.jdbc_catalog(spark, "derby_src", url, driver=DERBY)
    assert got(catalog.jdbc_objects(spark, name, "APP", "ORD%")) == [("ORDERS", "TABLE")] and catalog.jdbc_objects(spark, name, "APP", "X%").count() == 0
    table = spark.table(f"{name}.APP.ORDERS")
    assert [(r.ord, r.col) for r in catalog.described(spark, {"ORDERS": table}).collect()] == [(1, "o_orderkey"), (2, "o_orderstatus")]
    top = increment.max_keys(table, ["o_orderkey"])
    assert "PushedAggregates: [MAX" in top._jdf.queryExecution().executedPlan().toString()
    assert top.first()[0] == spark.read.parquet(f"{tables}/orders.parquet").agg(F.max("o_orderkey")).first()[0]
    rows, _ = increment.read(table.withColumnRenamed("o_orderkey", "k"), {"k": 100})
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "100" in plan.split("PushedFilters: [")[1].split("]")[0]
    # The session's initialisation statement runs on each connection.
    with pytest.raises(Exception, match="NOSUCH"):
        sources.jdbc(spark, url, "ORDERS", init="SET SCHEMA NOSUCH", driver=DERBY).count()
    assert sources.jdbc(spark, url, "ORDERS", init="SET SCHEMA APP", driver=DERBY).count() == table.count()


def test_information_schema(spark):
    url = "jdbc:derby:memory:standard;create=true"
    connection = spark._jvm.java.sql.DriverManager.getConnection(url)
    run = connection.createStatement().execute
    for line in (
        "CREATE SCHEMA information_schema",
        "CREATE TABLE information_schema.tables (table_schema VARCHAR(9), table_name VARCHAR(9), table_type VARCHAR(12))",
        "INSERT INTO information_schema.tables VALUES ('s', 'a', 'BASE TABLE'), ('s', 'v', 'VIEW'), ('other', 'b', 'BASE TABLE')",
        "CREATE TABLE information_schema.columns (table_schema VARCHAR(9), table_name VARCHAR(9), column_name VARCHAR(9), ordinal_position INT, data_type VARCHAR(20), character_maximum_length INT, numeric_precision INT, numeric_scale INT, is_nullable VARCHAR(3))",
        "INSERT INTO information_schema.columns VALUES ('s', 'a', 'id', 1, 'numeric', 0, 10, 2, 'NO'), ('s', 'a', 'my name', 2, 'varchar', 20, 0, 0, 'YES'), ('other', 'b', 'x', 1, 'text', 0, 0, 0, 'NO')",
        "CREATE TABLE information_schema.table_constraints (table_schema VARCHAR(9), table_name VARCHAR(9), constraint_name VARCHAR(9), constraint_type VARCHAR(12))",
        "INSERT INTO information_schema.table_constraints VALUES ('s', 'a', 'u1', 'UNIQUE'), ('s', 'a', 'pk', 'PRIMARY KEY')",
        "CREATE TABLE information_schema.key_column_usage (table_schema VARCHAR(9), table_name VARCHAR(9), constraint_name VARCHAR(9), column_name VARCHAR(9), ordinal_position INT)",
        "INSERT INTO information_schema.key_column_usage VALUES ('s', 'a', 'pk', 'y', 2), ('s', 'a', 'pk', 'x', 1), ('s', 'a', 'u1', 'z', 1)",
    ):
        run(line)
    connection.close()
    view = lambda name: catalog.information_schema(spark, url, name, "s", driver=DERBY)
    assert got(catalog.list_objects(view("tables"))) == [("a", "TABLE"), ("v", "VIEW")]
    assert got(catalog.column_definitions(view("columns")).select("tbl", "definition")) == [("a", '"my name" VARCHAR(20) NULL'), ("a", "id NUMERIC(10,2) NOT NULL")]
    assert got(catalog.unique_keys(view("constraints"), view("usage"))) == [("a", "x,y")]


def test_a_stream_that_looks_every_second(spark, tmp_path):
    shape = "_op string, _ts timestamp, _seq bigint, k int, v string"
    target = Target(spark, str(tmp_path / "t"), ["k"], buckets=1)
    put = lambda k: records(spark, [(k, "a")]).drop("_batch").withColumn("_seq", F.lit(1).cast("long")).write.mode("append").parquet(str(tmp_path / "in"))
    put(1)
    query = apply_stream(change_stream(spark, str(tmp_path / "in"), shape), target, str(tmp_path / "cp"), interval="1 second")
    try:
        for k in (1, 2):
            put(k)
            query.processAllAvailable()
        assert got(target.read().select("k")) == [(1,), (2,)]
    finally:
        query.stop()


# --- one order for deletes, streams and files --------------------------------------------------

STREAMED = "_op string, _ts timestamp, _seq bigint, k int, v string"


def _events(spark, tmp_path, rows):
    """Append events (op, day, seq, k, v) to the log that streams read."""
    typed = [(op, DAY + datetime.timedelta(days=day), seq, k, v) for op, day, seq, k, v in rows]
    spark.createDataFrame(typed, STREAMED).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))


def test_deletes_win_against_what_was_there_and_lose_against_what_comes(spark, tmp_path):
    target, spec = Target(spark, str(tmp_path / "t"), ["k"]), runs.ObjectSpec("o", ["k"])

    def stream(rows):
        _events(spark, tmp_path, rows)
        apply_stream(change_stream(spark, str(tmp_path / "in"), STREAMED), target, str(tmp_path / "cp")).awaitTermination()

    def sync(keys):
        df = spark.createDataFrame([(k,) for k in keys], "k int")
        return runs.run(spark, [spec], lambda _: df, lambda _: target, str(tmp_path / "log"), runs.delete_sync_object).first()

    stream([("I", 1, i, i, "a") for i in range(10)])
    assert sync(range(5)).records == 5 and target.read().count() == 5
    assert sync([]).records == 0 and target.read().count() == 5
    assert sync(range(5)).records == 0
    stream([("U", 0, 50, 7, "late"), ("I", 2, 1, 8, "back"), ("U", 1, 3, 9, "late")])
    assert got(target.read().where("k > 4")) == [(8, "back")]
    target.compact()
    assert sync([8]).records == 5 and got(target.read()) == [(8, "back")]
    # A read of a table after a delete brings a key back as well.
    table = Target(spark, str(tmp_path / "table"), ["k"])
    inc = runs.ObjectSpec("o", ["k"], incremental={"u": 0})
    for rows, keys in (([(1, 1), (2, 2)], [(2, 2)]), ([(2, 2), (1, 3)], [(2, 2), (1, 3)])):
        for work, data in ((runs.read_object, rows), (runs.delete_sync_object, keys)):
            df = spark.createDataFrame(data, "k int, u int")
            runs.run(spark, [inc], lambda _, df=df: df, lambda _: table, str(tmp_path / "log2"), work)
    assert got(table.read()) == [(1, 3), (2, 2)]


def _csv(folder, name, text, at):
    import os

    folder.mkdir(exist_ok=True)
    (folder / name).write_text(text)
    os.utime(folder / name, (at, at))


def test_a_deleted_key_of_a_file_comes_back_with_a_later_one(spark, tmp_path):
    spec = runs.ObjectSpec("o", ["id"], kind="csv", incremental={"_file_time": datetime.datetime(1970, 1, 1)})
    read = lambda: sources.csv(spark, str(tmp_path / "in"), "id string, v string")
    _csv(tmp_path / "in", "a.csv", "id,v\n1,x\n2,x\n", 1_700_000_000)
    _go(spark, tmp_path, [spec], read())
    done, made = _go(spark, tmp_path, [spec], read().where("id = 2"), work=runs.delete_sync_object)
    assert done["o"].records == 1 and got(made["o"].read()) == [("2", "x")]
    for i, at in enumerate((1_700_000_000, 1_700_000_009)):  # of the same time, but read later; and a later one
        _csv(tmp_path / "in", f"b{i}.csv", f"id,v\n1,back{i}\n", at)
        done, made = _go(spark, tmp_path, [spec], read())
        assert done["o"].records == 1 and got(made["o"].read()) == [("1", f"back{i}"), ("2", "x")]


@pytest.mark.parametrize("reader", [sources.csv, sources.csv_files])
def test_files_of_one_time_are_each_read_once(spark, tmp_path, reader):
    spec = runs.ObjectSpec("o", ["id"], kind="csv", incremental={"_file_time": datetime.datetime(1970, 1, 1)}, files=2)
    counts = []
    for names, at in ((["a 1", "b"], 1_700_000_000), (["c", "a0"], 1_700_000_000), ([], 0), (["d", "e", "f"], 1_700_000_005), (["old"], 1_600_000_000)):
        for n in names:
            _csv(tmp_path / "in", f"{n}.csv", f"id,v\n{n},x\n", at)
        done, made = _go(spark, tmp_path, [spec], reader(spark, str(tmp_path / "in"), "id string, v string"))
        counts.append(done["o"].records)
    assert counts == [2, 2, 0, 3, 0] and made["o"].read().count() == 7
    groups = [r.rows for r in made["o"].manifest()["log"] if r.kind == "data"]
    assert groups == [2, 2, 2, 1]  # a commit for each group of two files
    assert got(runs.checkpoints(spark, made).select("object", "col")) == [("o", "_file_time")]


def test_new_files_are_told_by_the_listing(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(runs, "_AHEAD", 1)  # so the driver is told of two files at a time
    spec = runs.ObjectSpec("o", ["id"], kind="csv", incremental={"_file_time": datetime.datetime(1970, 1, 1)}, files=2)
    for i in range(6):
        _csv(tmp_path / "in", f"{i}.csv", f"id,v\n{i},x\n" if i != 4 else "id,v\n", 1_700_000_000 + i // 4)
    found = sources.csv_files(spark, str(tmp_path / "in"), "id string, v string")
    done, made = _go(spark, tmp_path, [spec], sources.Files(found.rows, found.listing.where("path NOT LIKE '%3.csv'")))
    assert done["o"].records == 4 and [r.rows for r in made["o"].manifest()["log"]] == [2, 1, 1]
    assert _go(spark, tmp_path, [spec], found)[0]["o"].records == 0  # of a time before the frontier
    left = sources.Files(found.rows.where("id <> '0'"), found.listing)
    assert _go(spark, tmp_path, [spec], left, work=runs.delete_sync_object)[0]["o"].records == 1
    assert got(made["o"].read()) == [("1", "x"), ("2", "x"), ("5", "x")]


@pytest.mark.parametrize("text", ['id,v\n1,"a\nb"\n2,c\n', 'id,v\r\n1,"say ""x"", y"\r\n2,"\r\n"\r\n', 'id,v\n1,"x,\n\ny"\n\n2,z\n', 'id,v\n1,"open\n'])
def test_quoted_line_breaks(spark, tmp_path, text):
    import csv as plain
    import io

    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "1.csv").write_bytes(text.encode())
    dialect = sources.CsvDialect(trim=False)
    assert sources.csv_schema(spark, str(tmp_path / "in"), dialect).names == ["id", "v"]
    want = [tuple(r) for r in plain.reader(io.StringIO(text, newline="")) if r][1:]
    norm = lambda rows: sorted((a, b.replace("\r\n", "\n").rstrip("\n") if b else b) for a, b in rows)
    assert norm(got(sources.csv(spark, str(tmp_path / "in"), "id string, v string", dialect).select("id", "v"))) == norm(want)


def test_a_header_is_looked_for_in_one_file(spark, tmp_path):
    for i in range(5):
        _csv(tmp_path / "in", f"{i} x.csv", "" if i == 0 else f"id{i},v\n1,2\n", 1_700_000_000 + i)
    assert got(sources.files(spark, str(tmp_path / "in")).select("size")) == [(10,)] * 4
    assert sources.csv_schema(spark, str(tmp_path / "in")).names == ["id1", "v"]


def test_partitions_have_checkpoints_of_their_own(spark, tmp_path):
    spec = runs.ObjectSpec("o", ["id"], incremental={"k": 0}, conditions=["p = 'a'", "p = 'b'", "k = 7"])
    rows = [(1, "a", 100), (2, "b", 10), (3, "c", 5)]
    shape = "id int, p string, k int"
    for more, compute, n in (([], True, 2), ([(4, "b", 20)], True, 1), ([(5, "a", 99), (6, "b", 20), (7, "a", 101)], True, 1), ([(8, "c", 7)], True, 1), ([(9, "b", 21), (10, "a", 50)], False, 1)):
        rows += more
        now = runs.dataclasses.replace(spec, compute_max=compute)
        done, made = _go(spark, tmp_path, [now], spark.createDataFrame(rows, shape))
        assert done["o"].records == n
    assert sorted(made["o"].read().toPandas()["id"]) == [1, 2, 4, 7, 8, 9]
    assert {(r.part, r.value) for r in runs.checkpoints(spark, made).collect()} == {("k = 7", "7"), ("p = 'a'", "101"), ("p = 'b'", "21")}
    done, made = _go(spark, tmp_path, [runs.dataclasses.replace(spec, conditions=["p = 'a'", "p = 'c'"], limit=1)], spark.createDataFrame(rows, shape))
    assert done["o"].records == 1  # a new partition starts at its own beginning
    nulls = spark.createDataFrame([(1, "a", None), (2, "b", 3), (3, "x", None)], shape)
    parts, upper = increment.read_parts(nulls, {"p = 'a'": {"k": 0}, "p = 'b'": {"k": 0}}, include_nulls=True)
    assert got(parts.select("id")) == [(1,), (2,)] and upper == {"p = 'a'": {"k": 0}, "p = 'b'": {"k": 3}}


def test_documents_are_ordered_by_their_own_values(spark, tmp_path):
    big = 2**53
    docs = [("a", f'{{"n": {big}, "t": "2024-01-01T00:00:00Z"}}'), ("b", f'{{"n": {big + 1}, "t": "2024-01-01T02:00:00+01:00"}}'), ("c", '{"n": 1.5, "t": 5}'), ("d", '{"n": "7", "t": "x"}'), ("e", "no json"), ("f", '{"n": true}')]
    df = spark.createDataFrame(docs, "_id string, document string")
    value = lambda f, like: [r[0] for r in df.withColumn("x", sources.parsed("document")).select(sources.document_value("x", f, like)).collect()]
    assert [None if v is None else float(v) for v in value("n", 1)][2:] == [1.5, None, None, None] and [int(v) for v in value("n", 1)[:2]] == [big, big + 1]
    assert value("n", 1.0)[2] == 1.5
    assert value("t", DAY) == [DAY, DAY + datetime.timedelta(hours=1), None, None, None, None]
    for first, key in ((0, "n"), (datetime.datetime(1970, 1, 1), "t")):
        spec = runs.ObjectSpec("o" + key, ["_id"], kind="documents", incremental={key: first})
        assert [_go(spark, tmp_path, [spec], df.where(w))[0]["o" + key].records for w in ("_id in ('a')", "_id in ('a', 'b')", "true")] == [1, 1, 0]
    made = _go(spark, tmp_path, [spec], df)[1]
    assert got(runs.checkpoints(spark, made).select("col", "value")) == [("t", "2024-01-01T01:00:00")]
    keyed = runs._keyed(runs.ObjectSpec("o", ["_id"], kind="documents", incremental={"n": 0, "t": DAY}), df)[0]
    plan = keyed.where("document_key_0 > 1 OR document_key_1 > '2024-01-01'").select("_id", "document")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parseJson(") == 1


def test_log_based_objects_after_a_crash_and_with_positions(spark, tmp_path, monkeypatch):
    spec = runs.ObjectSpec("o", ["k"], kind="log", masked=["v"])
    _events(spark, tmp_path, [("I", 1, 1, 1, "a1"), ("I", 1, 2, 2, "b1")])
    rows = spark.createDataFrame([(1, "a1"), (2, "b1")], "k int, v string")
    source = LogSource(rows, lambda: sources.log_position(spark.read.parquet(str(tmp_path / "in")), "_ts").first()[0], lambda since: change_stream(spark, str(tmp_path / "in"), STREAMED, since=since))
    with monkeypatch.context() as m:
        m.setattr(runs, "apply_stream", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("crash")))
        done, made = _go(spark, tmp_path, [spec], lambda _: source)
    assert (done["o"].status, done["o"].status_description) == ("ERROR", "crash") and made["o"].read().count() == 2
    _events(spark, tmp_path, [("D", 2, 3, 1, None), ("U", 2, 4, 2, "c2"), ("I", 0, 0, 5, "before the position")])
    done, made = _go(spark, tmp_path, [spec], lambda _: source)
    assert done["o"].status == "SUCCESS" and done["o"].read_type == "SNAPSHOT + LOG_BASED" and done["o"].records == 4
    assert got(made["o"].read()) == [(2, "X9")]
    assert got(runs.log_positions(spark, made)) == [("o", 0, DAY + datetime.timedelta(days=2))]
    _events(spark, tmp_path, [("I", 3, 5, 9, "z")])
    done, made = _go(spark, tmp_path, [spec], lambda _: source)
    assert done["o"].records == 1 and runs.log_positions(spark, made).first().token == 1
    assert _go(spark, tmp_path, [spec], lambda _: source)[0]["o"].records == 0
    done, made = _go(spark, tmp_path, [spec], lambda _: LogSource(rows.where("k = 2"), source.position, source.changes), work=runs.delete_sync_object)
    assert done["o"].records == 1 and got(made["o"].read()) == [(2, "X9")]


def test_streams_tell_the_run_log(spark, tmp_path):
    for day in (1, 2):
        _events(spark, tmp_path, [("I", day, day, k, "a") for k in range(day)])
    target, path = Target(spark, str(tmp_path / "t"), ["k"]), str(tmp_path / "log")
    go = lambda: apply_stream(change_stream(spark, str(tmp_path / "in"), STREAMED, files=1), target, str(tmp_path / "cp"), name="o", log_path=path)
    assert finished(go())
    rows = spark.read.schema(runs.LOG_SCHEMA).parquet(path)
    assert sorted(r.records for r in rows.collect()) == [1, 2]
    one = reports.statistics(rows).first()
    assert (one.total_records, one.read_type, one.last_read_status) == (3, "SNAPSHOT + LOG_BASED", "SUCCESS") and "_ts(" in one.last_read_keys
    _events(spark, tmp_path, [("?", 3, 1, 1, "a")])
    with pytest.raises(Exception, match="unknown operation"):
        finished(go())
    assert runs.failed(spark, path) == ["o"] and reports.totals(spark.read.schema(runs.LOG_SCHEMA).parquet(path)).first().total_records == 3


def test_groups_run_side_by_side(spark, tmp_path):
    import threading

    both, order = threading.Barrier(2, timeout=60), []

    def source(name):
        if name in ("a1", "b1"):
            both.wait()  # passes only while both groups run
        order.append(name)
        df = spark.createDataFrame([(1,)], "k int")
        return df.select("nope") if name == "b2" else df

    specs_ = [runs.ObjectSpec(f"{g}{i}", ["k"], group=g, position=i) for g in "ab" for i in (3, 2, 1)]
    done, _ = _go(spark, tmp_path, specs_, source)
    assert [n for n in order if n[0] == "a"] == ["a1", "a2", "a3"] and [n for n in order if n[0] == "b"] == ["b1", "b2"]
    assert list(done) == ["a1", "a2", "a3", "b1", "b2"] and {n for n, r in done.items() if r.status == "ERROR"} == {"b2"}
    assert not spark.getTags()


def test_a_failed_read_leaves_columns_and_a_failed_drop_is_told(spark, tmp_path):
    spec = runs.ObjectSpec("o", ["k"], incremental={"u": 0})
    _, made = _go(spark, tmp_path, [spec], spark.createDataFrame([(1, 1, "a")], "k int, u int, v string"))
    bad = spark.createDataFrame([(2, 2)], "k int, u int").withColumn("w", F.raise_error(F.lit("torn")).cast("string"))
    done, made = _go(spark, tmp_path, [spec], bad)
    assert done["o"].status == "ERROR" and made["o"].read().columns == ["k", "u", "v"]
    listing = spark.createDataFrame([("x",)], "object_name string")
    broken = lambda s: (_ for _ in ()).throw(RuntimeError("no such disk"))
    out = runs.run(spark, [spec], lambda _: bad, broken, str(tmp_path / "log"), listing=listing, drop=True).collect()
    assert [(r.action, r.status, r.status_description) for r in out] == [("DROP", "ERROR", "no such disk")]


@pytest.mark.parametrize("values", [list(range(1000)), [5] * 700 + [1, 2, 9] * 100, [None, None], [3], [0.5 * i for i in range(999)], list(range(500)) + [499] * 500])
def test_the_nth_value(spark, values):
    df = spark.createDataFrame([(None if v is None else float(v),) for v in values], "k double").repartition(4)
    there = sorted(v for v in values if v is not None)
    for n in (1, 2, len(there) // 2, 499, 500, 501, len(there), 5000):
        if n:
            want = (there[min(n, len(there)) - 1] if there else None)
            assert increment.nth(df, "k", n, few=20, accuracy=50) == (want, sum(v <= want for v in there) if there else 0)


def test_a_limit_of_half_a_table_sorts_nothing(spark):
    df = spark.range(400_000).withColumn("k", F.col("id") % 50_000)
    rows, upper = increment.read(df, {"k": -1}, limit=200_000)
    assert upper == {"k": 24_999} and rows.count() == 200_000
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "Sort" not in plan and "TakeOrdered" not in plan


def test_jdbc_metadata_of_any_driver(spark):
    url = "jdbc:derby:memory:meta;create=true"
    connection = spark._jvm.java.sql.DriverManager.getConnection(url)
    for line in ("CREATE TABLE a (x INT NOT NULL, y INT NOT NULL, z INT, PRIMARY KEY (y, x))", "CREATE TABLE b (p INT NOT NULL, q VARCHAR(9) NOT NULL)", "CREATE UNIQUE INDEX b_u ON b (q, p)", "CREATE TABLE c (x INT)", "CREATE INDEX c_i ON c (x)", "CREATE VIEW v AS SELECT x FROM a"):
        connection.createStatement().execute(line)
    connection.close()
    found = catalog.jdbc_metadata(spark, url, "APP", driver=DERBY)
    assert got(catalog.list_objects(found["tables"])) == [("A", "TABLE"), ("B", "TABLE"), ("C", "TABLE"), ("V", "VIEW")]
    assert got(catalog.unique_keys(found["constraints"], found["usage"])) == [("A", "Y,X"), ("B", "Q,P")]
    assert got(catalog.list_objects(catalog.jdbc_metadata(spark, url, "APP", "V%", driver=DERBY)["tables"], kind="VIEW")) == [("V", "VIEW")]
