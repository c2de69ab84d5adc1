"""Every query of the core against its SQL."""

from collections import Counter

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidemark import queries as q


@pytest.mark.parametrize("name", sorted(q.queries()))
def test_query_equals_sql(spark, tables, duck, name):
    got, want = q.queries()[name](spark, tables).toPandas(), duck.execute(q.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).limit(1).count() == 1
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_bounds_reach_the_scan(spark, tables):
    plan = q.queries()["incremental_range_ts"](spark, tables)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(o_orderdate" in plan and "LessThanOrEqual(o_orderdate" in plan


@pytest.mark.parametrize("many", [False, True], ids=["few", "many"])
def test_folders_are_written_whole_without_a_sort(spark, tmp_path, duck, monkeypatch, many):
    """Tasks of few folders sort no rows; of more folders than a task has writers, each has one file all the same. Any text but null is a folder."""
    names = ["click", "view", "error", "signup", "purchase"]
    if many:
        one = spark.range(4000).select(F.concat(F.lit("t"), F.col("id").cast("string")).alias("n")).where("pmod(hash(concat('x', hex(n))), 200) = 7")  # of one task
        names = [None, "", "a b", "a/b", "\u00e9%2F+", "__HIVE_DEFAULT_PARTITION__", *[r.n for r in one.collect()]]
    kind = F.element_at(F.array(*map(F.lit, names)), (F.col("id") % len(names) + 1).cast("int"))
    spark.range(0, 10_000, 1, 4).select("id", kind.alias("event_type")).write.parquet(f"{tmp_path}/events.parquet")
    monkeypatch.setattr(q, "_work", lambda _: f"{tmp_path}/out")
    writers = spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")
    got = q.queries()["file_listing"](spark, str(tmp_path)).toPandas()
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == writers
    with duck.cursor() as con:
        con.execute(f"CREATE TEMP VIEW events AS SELECT * FROM '{tmp_path}/events.parquet/*.parquet'")
        assert rows(got) == rows(con.execute(q.oracle_sql()["file_listing"]).df())
    stored = spark.read.parquet(f"{tmp_path}/out")
    assert stored.count() == 10_000 and stored.select("id").distinct().count() == 10_000
    tasks = Counter(f.name.split("-")[1] for f in (tmp_path / "out").rglob("*.parquet"))
    assert len(tasks) > 1 and (not many or max(tasks.values()) > 8)
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    done = spark._jsparkSession.sharedState().statusStore().executionsList()
    plans = [done.apply(i).physicalPlanDescription() for i in range(done.size())]
    plan = [p for p in plans if f"{tmp_path}/out" in p and "InsertIntoHadoopFsRelationCommand" in p][-1]
    assert "Exchange" in plan and "Sort" not in plan
