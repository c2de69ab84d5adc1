"""Every operator as a query over the given tables, with the same result as SQL.

Operators on metadata take their rows from the tables as well: a customer stands for an object, a
part for a column, an order line for a constraint.
"""

from __future__ import annotations

import datetime
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import functions as fn
from . import sources
from .operators import changes as log
from .operators import increment, merge, reports, schema, specs, state
from .plans import run as runs
from .plans.store import Target
from .sources import catalog
from .streaming import LogSource, apply_stream, change_stream, finished

_Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, _Query] = {}
_SQL: dict[str, str] = {}
T1998 = datetime.datetime(1998, 1, 1)


def _query(sql: str | None = None) -> Callable[[_Query], _Query]:
    def add(f: _Query) -> _Query:
        _QUERIES[f.__name__] = f
        if sql:
            _SQL[f.__name__] = sql
        return f

    return add


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _work(spark: SparkSession) -> str:
    """A new folder below the cluster's shared one; where that is unset a local one, on a local master only."""
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not at:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        at = tempfile.mkdtemp(prefix="spark-")
    return f"{at}/tidemark-{uuid.uuid4().hex}"


# --- scans and increments ---------------------------------------------------------------------


@_query("SELECT o_orderkey, o_custkey, o_orderstatus, o_orderdate FROM orders")
def snapshot_scan(spark, sf):
    return sources.snapshot(_t(spark, sf, "orders"), ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate"])


@_query("SELECT 1 AS part, o_orderkey FROM orders WHERE o_orderstatus='O' UNION ALL SELECT 2, o_orderkey FROM orders WHERE o_orderstatus='F'")
def partitioned_snapshot(spark, sf):
    return sources.snapshot(_t(spark, sf, "orders"), ["o_orderkey"], ["o_orderstatus = 'O'", "o_orderstatus = 'F'"])


@_query("SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate > TIMESTAMP '1998-01-01' AND o_orderdate <= (SELECT max(o_orderdate) FROM orders)")
def incremental_range_ts(spark, sf):
    return increment.read(_t(spark, sf, "orders"), {"o_orderdate": T1998})[0].select("o_orderkey", "o_orderdate")


@_query("SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_orderkey > 5000 AND l_orderkey <= (SELECT max(l_orderkey) FROM lineitem)")
def incremental_range_numeric(spark, sf):
    return increment.read(_t(spark, sf, "lineitem"), {"l_orderkey": 5000})[0].select("l_orderkey", "l_linenumber", "l_partkey")


@_query("SELECT event_id, ts FROM events WHERE ts > TIMESTAMP '2024-01-20'")
def incremental_lower_bound(spark, sf):
    return increment.read(_t(spark, sf, "events"), {"ts": datetime.datetime(2024, 1, 20)}, compute_max=False)[0].select("event_id", "ts")


@_query("SELECT event_id, ts FROM events WHERE (ts > TIMESTAMP '2024-01-25' AND ts <= (SELECT max(ts) FROM events)) OR (user_id > 140 AND user_id <= (SELECT max(user_id) FROM events))")
def incremental_multi_key(spark, sf):
    return increment.read(_t(spark, sf, "events"), {"ts": datetime.datetime(2024, 1, 25), "user_id": 140})[0].select("event_id", "ts")


@_query("WITH s AS (SELECT event_id, nullif(user_id % 7, 0) AS k FROM events) SELECT event_id, k FROM s WHERE (k > 3 AND k <= (SELECT max(k) FROM s)) OR k IS NULL")
def incremental_null_keys(spark, sf):
    rows = _t(spark, sf, "events").select("event_id", F.nullif(F.col("user_id") % 7, F.lit(0)).alias("k"))
    return increment.read(rows, {"k": 3}, include_nulls=True)[0]


@_query("SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate > TIMESTAMP '1998-01-01' AND o_orderdate <= (SELECT max(o_orderdate) FROM orders WHERE o_orderstatus='O') AND (o_orderstatus='O')")
def incremental_with_condition(spark, sf):
    return increment.read(_t(spark, sf, "orders"), {"o_orderdate": T1998}, ["o_orderstatus = 'O'"])[0].select("o_orderkey", "o_orderdate")


@_query("SELECT count(*) AS n FROM (SELECT event_id, CAST(NULL AS BIGINT) AS k FROM events) WHERE k > 0")
def incremental_all_null(spark, sf):
    rows = _t(spark, sf, "events").select("event_id", F.lit(None).cast("long").alias("k"))
    return increment.read(rows, {"k": 0})[0].agg(F.count("*").alias("n"))


@_query("SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderkey > 5000 ORDER BY o_orderkey LIMIT 100")
def limited_increment(spark, sf):
    return increment.read(_t(spark, sf, "orders"), {"o_orderkey": 5000}, limit=100)[0].select("o_orderkey", "o_orderdate")


@_query("SELECT max(event_id) AS max_event_id, max(ts) AS max_ts FROM events")
def max_keys(spark, sf):
    return increment.max_keys(_t(spark, sf, "events"), ["event_id", "ts"])


@_query("SELECT o_orderstatus AS part, max(o_orderkey) AS max_key, max(o_orderdate) AS max_ts FROM orders GROUP BY 1")
def max_keys_by_partition(spark, sf):
    found = increment.max_keys(_t(spark, sf, "orders"), ["o_orderkey", "o_orderdate"], "o_orderstatus")
    return found.toDF("part", "max_key", "max_ts")


@_query("SELECT count(*) AS records, max(o_orderdate) AS max_ts FROM orders WHERE o_orderdate > TIMESTAMP '1998-01-01'")
def observed_max(spark, sf):
    rows = _t(spark, sf, "orders").where(F.col("o_orderdate") > F.lit(T1998)).select("o_orderkey", "o_orderdate")
    rows, seen = increment.observed(rows, ["o_orderdate"], f"seen-{uuid.uuid4().hex}")
    rows.write.parquet(_work(spark))
    got = seen.get
    return spark.createDataFrame([(got["records"], got["max_o_orderdate"])], "records bigint, max_ts timestamp_ntz")


@_query("SELECT event_id // 1000 AS batch_no, count(*) AS records, max(ts) AS max_ts FROM events GROUP BY 1")
def batch_counts(spark, sf):
    rows = _t(spark, sf, "events").withColumn("batch_no", F.expr("event_id div 1000"))
    return log.counts(rows, "batch_no", "ts")


# --- values ----------------------------------------------------------------------------------


@_query("SELECT c_custkey, regexp_replace(regexp_replace(c_name,'[a-zA-Z]','X','g'),'[0-9]','9','g') AS c_name, regexp_replace(regexp_replace(c_mktsegment,'[a-zA-Z]','X','g'),'[0-9]','9','g') AS c_mktsegment FROM customer")
def mask_columns(spark, sf):
    return log.mask(_t(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment"), ["C_NAME", "c_mktsegment"])


@_query("""SELECT event_id, '{"k":"' || regexp_replace(json_extract_string(props,'$.k'),'[0-9]','9','g') || '"}' AS document FROM events""")
def mask_document(spark, sf):
    return log.mask_document(_t(spark, sf, "events").select("event_id", F.col("props").alias("document")), "document", ["k"])


@_query("SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CASE WHEN o_orderstatus='F' THEN '1' ELSE '0' END AS is_final, CAST(o_orderdate AS VARCHAR) AS o_orderdate FROM orders")
def normalize_values(spark, sf):
    return log.normalize_values(_t(spark, sf, "orders").select("o_orderkey", (F.col("o_orderstatus") == "F").alias("is_final"), "o_orderdate"))


@_query("SELECT event_id, epoch_us(ts) // 1000 AS ms FROM events")
def epoch_millis(spark, sf):
    return _t(spark, sf, "events").select("event_id", fn.epoch_millis(F.col("ts"), "timestamp_ntz").alias("ms"))


@_query("SELECT event_id, CASE WHEN event_id % 3 = 0 THEN epoch_us(ts) // 1000 WHEN event_id % 3 = 1 THEN user_id END AS ms FROM events")
def epoch_millis_text(spark, sf):
    """Of text: a time, a number, and what is neither."""
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    text = F.when(F.col("event_id") % 3 == 0, iso).when(F.col("event_id") % 3 == 1, F.concat(F.col("user_id").cast("string"), F.lit(".75"))).otherwise(F.col("event_type"))
    return _t(spark, sf, "events").select("event_id", fn.epoch_millis(text).alias("ms"))


# --- documents -------------------------------------------------------------------------------


@_query("""SELECT CAST(event_id AS VARCHAR) AS _id, '{"event_id":' || event_id || ',"user_id":' || user_id || ',"event_type":"' || event_type || '"}' AS document FROM events""")
def document_snapshot(spark, sf):
    return sources.documents(_t(spark, sf, "events"), "event_id", ["event_id", "user_id", "event_type"])


@_query("WITH s AS (SELECT event_id, CAST(json_extract_string(props,'$.k') AS BIGINT) AS k FROM events) SELECT event_id, k FROM s WHERE k > 50 AND k <= (SELECT max(k) FROM s) AND (event_id % 2 = 0)")
def document_incremental(spark, sf):
    rows = _t(spark, sf, "events").select("event_id", sources.document_field("props", "k", "long").alias("k"))
    return increment.read(rows, {"k": 50})[0].where("event_id % 2 = 0")


@_query("SELECT max(ts) AS log_ts FROM events")
def initial_log_position(spark, sf):
    return sources.log_position(_t(spark, sf, "events"), "ts")


# --- merges and deletes ----------------------------------------------------------------------


@_query("WITH dst AS (SELECT o_orderkey, 'X' AS o_orderstatus FROM orders WHERE o_orderkey < 8000), inc AS (SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderkey >= 5000) SELECT coalesce(i.o_orderkey, d.o_orderkey) AS o_orderkey, coalesce(i.o_orderstatus, d.o_orderstatus) AS o_orderstatus FROM dst d FULL OUTER JOIN inc i ON d.o_orderkey = i.o_orderkey")
def upsert_merge(spark, sf):
    orders = _t(spark, sf, "orders")
    dst = orders.where("o_orderkey < 8000").select("o_orderkey", F.lit("X").alias("o_orderstatus"))
    return merge.upsert(dst, orders.where("o_orderkey >= 5000").select("o_orderkey", "o_orderstatus"), ["o_orderkey"])


_DELETE = "WITH dst AS (SELECT o_orderkey FROM orders UNION ALL SELECT o_orderkey + 1000000 FROM orders WHERE o_orderkey % 50 = 0), src AS (SELECT o_orderkey FROM orders WHERE o_orderkey % 10 <> 0) SELECT o_orderkey FROM dst WHERE o_orderkey {} (SELECT o_orderkey FROM src)"


def _delete_sync(spark, sf):
    keys = _t(spark, sf, "orders").select("o_orderkey")
    dst = keys.union(keys.where("o_orderkey % 50 = 0").select(F.col("o_orderkey") + 1000000))
    return merge.delete_missing(dst, keys.where("o_orderkey % 10 <> 0"), ["o_orderkey"])


@_query(_DELETE.format("IN"))
def delete_sync_apply(spark, sf):
    return _delete_sync(spark, sf)[0]


@_query(_DELETE.format("NOT IN"))
def delete_sync_deleted(spark, sf):
    return _delete_sync(spark, sf)[1]


@_query("SELECT d.o_orderkey FROM orders d WHERE EXISTS (SELECT 1 FROM orders s WHERE s.o_orderkey = d.o_orderkey AND ((s.o_orderstatus='O') OR (s.o_orderdate < TIMESTAMP '1996-01-01')))")
def delete_sync_conditions(spark, sf):
    orders = _t(spark, sf, "orders")
    source = orders.where(fn.any_of([F.expr("o_orderstatus = 'O'"), F.expr("o_orderdate < timestamp_ntz'1996-01-01'")]))
    return merge.delete_missing(orders.select("o_orderkey"), source, ["o_orderkey"])[0]


@_query("SELECT o_orderkey, o_orderstatus FROM orders WHERE NOT coalesce(o_orderstatus = 'F', false)")
def soft_delete_apply(spark, sf):
    return merge.soft_delete(_t(spark, sf, "orders").select("o_orderkey", "o_orderstatus"), "o_orderstatus = 'F'")


def _events(spark, sf) -> DataFrame:
    op = F.when(F.col("event_type") == "signup", "I").when(F.col("event_type") == "error", "D").otherwise("U")
    return _t(spark, sf, "events").select(op.alias("_op"), F.col("ts").cast("timestamp").alias("_ts"), F.col("event_id").alias("_seq"), F.col("user_id").alias("k"), F.col("event_id").alias("seq"))


_LATEST = "WITH c AS (SELECT user_id AS k, CASE event_type WHEN 'signup' THEN 'I' WHEN 'error' THEN 'D' ELSE 'U' END AS op, ts, event_id AS seq FROM events), l AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY ts DESC, seq DESC) AS rn FROM c) WHERE rn = 1)"
_APPLIED = _LATEST + ", dst AS (SELECT c_custkey AS k, CAST(-1 AS BIGINT) AS seq FROM customer) SELECT k, seq FROM l WHERE op <> 'D' UNION ALL SELECT k, seq FROM dst WHERE k NOT IN (SELECT k FROM l)"


@_query(_LATEST + " SELECT k, op, seq FROM l")
def changelog_latest(spark, sf):
    return log.latest(_events(spark, sf), ["k"], ["_ts", "_seq"]).select("k", F.col("_op").alias("op"), "seq")


@_query(_APPLIED)
def changelog_apply(spark, sf):
    dst = _t(spark, sf, "customer").select(F.col("c_custkey").alias("k"), F.lit(-1).cast("long").alias("seq"))
    return merge.apply_changes(dst, _events(spark, sf), ["k"])


def _customers(spark, sf) -> DataFrame:
    first = datetime.datetime(1970, 1, 1)
    rows = _t(spark, sf, "customer").select(F.col("c_custkey").alias("k"), F.lit(-1).cast("long").alias("seq"))
    return log.emit(rows, "I", "first", F.lit(first), F.lit(-1)).drop("_batch")


@_query(_APPLIED)
def target_apply(spark, sf):
    """The stored target: a snapshot, then the changes in two batches of which the second is delivered twice."""
    target = Target(spark, _work(spark), ["k"], buckets=8)
    target.apply(_customers(spark, sf), "first")
    changes = _events(spark, sf)
    for name, part in (("late", "_seq % 2 = 1"), ("early", "_seq % 2 = 0"), ("early", "_seq % 2 = 0")):
        target.apply(changes.where(part), name)
    return target.read().select("k", "seq")


@_query(_APPLIED)
def stream_apply(spark, sf):
    """The same by a stream of change files."""
    at = _work(spark)
    target = Target(spark, f"{at}/target", ["k"], buckets=8)
    target.apply(_customers(spark, sf), "first")
    changes = _events(spark, sf)
    changes.repartition(4, "_seq").write.parquet(f"{at}/log")
    stream = spark.readStream.schema(changes.schema).option("maxFilesPerTrigger", 2).parquet(f"{at}/log")
    apply_stream(stream, target, f"{at}/checkpoint").awaitTermination()
    return target.read().select("k", "seq")


@_query("WITH snap AS (SELECT user_id AS k, max(event_id) AS seq FROM events WHERE event_id < 6000 GROUP BY 1), log AS (SELECT user_id AS k, max(event_id) AS seq FROM events WHERE event_id >= 5500 GROUP BY 1) SELECT k, max(seq) AS seq FROM (SELECT * FROM snap UNION ALL SELECT * FROM log) GROUP BY 1")
def snapshot_then_log(spark, sf):
    events = _t(spark, sf, "events").select(F.col("user_id").alias("k"), F.col("event_id").alias("seq"))
    snap = log.latest(events.where("seq < 6000"), ["k"], ["seq"])
    changes = log.emit(events.where("seq >= 5500"), "U", "log", F.lit(datetime.datetime(1970, 1, 1)), F.col("seq"))
    return merge.apply_changes(snap, changes, ["k"])


@_query("SELECT c_custkey, c_name FROM customer WHERE c_custkey < 1000 UNION ALL SELECT c_custkey, 'NEW' AS c_name FROM customer WHERE c_custkey >= 500 AND c_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_custkey < 1000)")
def merge_insert_only(spark, sf):
    c = _t(spark, sf, "customer").select("c_custkey", "c_name")
    return merge.merge_insert_only(c.where("c_custkey < 1000"), c.where("c_custkey >= 500").withColumn("c_name", F.lit("NEW")), ["c_custkey"])


@_query("WITH dst AS (SELECT c_custkey, 'OLD' AS seg, c_name AS keep FROM customer WHERE c_custkey < 1000), src AS (SELECT c_custkey, c_mktsegment AS seg FROM customer WHERE c_custkey >= 500) SELECT coalesce(d.c_custkey, f.c_custkey) AS c_custkey, coalesce(f.seg, d.seg) AS seg, coalesce(d.keep, '') AS keep FROM dst d FULL OUTER JOIN src f ON d.c_custkey = f.c_custkey")
def merge_update_subset(spark, sf):
    c = _t(spark, sf, "customer")
    dst = c.where("c_custkey < 1000").select("c_custkey", F.lit("OLD").alias("seg"), F.col("c_name").alias("keep"))
    src = c.where("c_custkey >= 500").select("c_custkey", F.col("c_mktsegment").alias("seg"))
    return merge.merge_update_subset(dst, src, ["c_custkey"], ["seg"], {"keep": ""})


@_query("WITH dst AS (SELECT c_custkey, c_name FROM customer WHERE c_custkey < 1000), src AS (SELECT c_custkey, c_mktsegment AS c_name FROM customer WHERE c_custkey BETWEEN 500 AND 1200) SELECT c_custkey, c_name FROM dst WHERE c_custkey NOT IN (SELECT c_custkey FROM src) UNION ALL SELECT c_custkey, c_name FROM src")
def merge_replace(spark, sf):
    c = _t(spark, sf, "customer")
    src = c.where("c_custkey BETWEEN 500 AND 1200").select("c_custkey", F.col("c_mktsegment").alias("c_name"))
    return merge.replace(c.where("c_custkey < 1000").select("c_custkey", "c_name"), src, ["c_custkey"])


@_query("WITH dst AS (SELECT c_custkey, c_name FROM customer WHERE c_custkey % 3 <> 0), src AS (SELECT c_custkey, c_mktsegment AS c_name FROM customer WHERE c_custkey % 2 = 0) SELECT c_custkey, c_name FROM dst WHERE c_custkey NOT IN (SELECT c_custkey FROM src) UNION ALL SELECT c_custkey, c_name FROM src")
def merge_replace_shares(spark, sf):
    """As ``merge_replace``, over shares of the whole table."""
    c = _t(spark, sf, "customer")
    src = c.where("c_custkey % 2 = 0").select("c_custkey", F.col("c_mktsegment").alias("c_name"))
    return merge.replace(c.where("c_custkey % 3 <> 0").select("c_custkey", "c_name"), src, ["c_custkey"])


# --- schemas and catalogues ------------------------------------------------------------------


@_query("SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey, c_acctbal, CAST(NULL AS VARCHAR) AS c_phone FROM customer")
def schema_apply(spark, sf):
    return schema.evolve(_t(spark, sf, "customer"), "c_custkey bigint, C_NAME string, c_nationkey bigint, c_acctbal double, c_phone string").withColumnRenamed("C_NAME", "c_name")


@_query("""WITH old AS (SELECT p_brand AS tbl, 'c' || p_partkey AS col, 'DECIMAL(' || p_size || ', 2)  null' AS def FROM part WHERE p_partkey % 7 <> 0),
new AS (SELECT p_brand AS tbl, 'C' || p_partkey AS col, CASE WHEN p_partkey % 5 = 0 THEN 'TEXT NULL' ELSE 'decimal(' || p_size || ',2) NULL' END AS def FROM part WHERE p_partkey % 11 <> 0)
SELECT coalesce(o.tbl, n.tbl) AS tbl, CASE WHEN o.col IS NULL THEN 'ADD' WHEN n.col IS NULL THEN 'DROP' ELSE 'ALTER' END AS action, coalesce(n.col, o.col) AS col, n.def AS def
FROM old o FULL OUTER JOIN new n ON o.tbl = n.tbl AND upper(o.col) = upper(n.col)
WHERE o.col IS NULL OR n.col IS NULL OR upper(regexp_replace(o.def,'\\s+','','g')) <> upper(regexp_replace(n.def,'\\s+','','g'))""")
def schema_diff(spark, sf):
    part = _t(spark, sf, "part").withColumn("size", F.col("p_size").cast("string"))
    key = F.col("p_partkey").cast("string")
    old = part.where("p_partkey % 7 <> 0").select(F.col("p_brand").alias("tbl"), F.concat(F.lit("c"), key).alias("col"), F.concat(F.lit("DECIMAL("), "size", F.lit(", 2)  null")).alias("def"))
    new_def = F.when(F.col("p_partkey") % 5 == 0, "TEXT NULL").otherwise(F.concat(F.lit("decimal("), "size", F.lit(",2) NULL")))
    new = part.where("p_partkey % 11 <> 0").select(F.col("p_brand").alias("tbl"), F.concat(F.lit("C"), key).alias("col"), new_def.alias("def"))
    return schema.schema_diff(old, new, ["tbl"])


_OBJECTS = "SELECT lower(c_name) AS object_name, CASE WHEN c_nationkey % 3 = 0 THEN 'VIEW' ELSE 'BASE TABLE' END AS table_type FROM customer"


def _objects(spark, sf):
    kind = F.when(F.col("c_nationkey") % 3 == 0, "VIEW").otherwise("BASE TABLE")
    return _t(spark, sf, "customer").select(F.lower("c_name").alias("object_name"), kind.alias("table_type"))


@_query(f"WITH src AS ({_OBJECTS}) SELECT object_name, 'TABLE' AS object_type FROM src WHERE table_type='BASE TABLE' AND object_name LIKE 'cust%7_' UNION SELECT object_name, 'VIEW' FROM src WHERE table_type='VIEW' AND object_name LIKE 'cust%7_'")
def list_objects(spark, sf):
    return catalog.list_objects(_objects(spark, sf), "cust%7_")


_SRC = "src AS (SELECT DISTINCT 'object_' || o_custkey AS object_name FROM orders WHERE o_orderstatus = 'P'), known AS (SELECT 'object_' || c_custkey AS object_name FROM customer WHERE c_custkey % 3 <> 0)"


def _src_known(spark, sf):
    name = lambda c: F.concat(F.lit("object_"), F.col(c).cast("string")).alias("object_name")
    return _t(spark, sf, "orders").where("o_orderstatus = 'P'").select(name("o_custkey")), _t(spark, sf, "customer").where("c_custkey % 3 <> 0").select(name("c_custkey"))


@_query(f"WITH {_SRC} SELECT object_name FROM src WHERE object_name NOT IN (SELECT object_name FROM known)")
def new_objects(spark, sf):
    return catalog.new_objects(*_src_known(spark, sf))


@_query(f"WITH {_SRC} SELECT object_name, 'DROP TABLE IF EXISTS ' || object_name AS ddl FROM known WHERE object_name NOT IN (SELECT object_name FROM src)")
def dropped_objects(spark, sf):
    return catalog.dropped_objects(*_src_known(spark, sf))


@_query("""WITH c AS (SELECT p_brand AS tbl, p_partkey AS ord, p_name || ' ' || p_size % 5 AS col, ['bigint','character varying','numeric','ARRAY','text'][p_partkey % 5 + 1] AS dt,
  CASE WHEN p_partkey % 5 = 1 THEN p_size ELSE 0 END AS len, CASE WHEN p_partkey % 5 = 2 THEN 10 ELSE 0 END AS prec, CASE WHEN p_partkey % 5 = 2 THEN p_size % 3 ELSE 0 END AS scale,
  CASE WHEN p_size % 2 = 0 THEN 'NO' ELSE 'YES' END AS nullable, ['_int4','_int8','other'][p_size % 3 + 1] AS udt FROM part),
d AS (SELECT *, CASE WHEN upper(dt) <> 'ARRAY' THEN upper(dt) WHEN udt='_int4' THEN 'INTEGER[]' WHEN udt='_int8' THEN 'BIGINT[]' ELSE 'TEXT[]' END AS ty, row_number() OVER (PARTITION BY tbl, col ORDER BY ord) AS rn FROM c)
SELECT tbl, ord, '"' || col || '" ' || ty || CASE WHEN ty IN ('NUMERIC','DECIMAL') AND prec > 0 THEN '(' || prec || CASE WHEN scale > 0 THEN ',' || scale ELSE '' END || ')' WHEN ty <> 'TEXT' AND len > 0 THEN '(' || len || ')' ELSE '' END || CASE WHEN nullable='NO' THEN ' NOT NULL' ELSE ' NULL' END AS definition FROM d WHERE rn = 1""")
def column_definitions(spark, sf):
    def pick(names, by):
        return F.element_at(F.array(*map(F.lit, names)), (by + 1).cast("int"))

    key, size = F.col("p_partkey") % 5, F.col("p_size")
    cols = _t(spark, sf, "part").select(
        F.col("p_brand").alias("tbl"), F.col("p_partkey").alias("ord"), F.concat("p_name", F.lit(" "), (size % 5).cast("string")).alias("col"), pick(["bigint", "character varying", "numeric", "ARRAY", "text"], key).alias("dt"),
        F.when(key == 1, size).otherwise(0).alias("len"), F.when(key == 2, 10).otherwise(0).alias("prec"), F.when(key == 2, size % 3).otherwise(0).alias("scale"),
        F.when(size % 2 == 0, "NO").otherwise("YES").alias("nullable"), pick(["_int4", "_int8", "other"], size % 3).alias("udt"))
    return catalog.column_definitions(cols)


_DEFS = """SELECT p_partkey AS i, CASE WHEN p_partkey % 2 = 0 THEN '"' || p_name || '"' ELSE 'c' || p_partkey END || ' ' || CASE WHEN p_size % 3 = 0 THEN 'NUMERIC(' || p_size || ',2)' ELSE 'Varchar(' || p_size || ')' END || CASE WHEN p_size % 2 = 0 THEN ' NOT NULL' ELSE ' NULL' END AS t FROM part"""


def _definitions(spark, sf):
    size, key = F.col("p_size").cast("string"), F.col("p_partkey")
    name = F.when(key % 2 == 0, F.concat(F.lit('"'), "p_name", F.lit('"'))).otherwise(F.concat(F.lit("c"), key.cast("string")))
    kind = F.when(F.col("p_size") % 3 == 0, F.concat(F.lit("NUMERIC("), size, F.lit(",2)"))).otherwise(F.concat(F.lit("Varchar("), size, F.lit(")")))
    return _t(spark, sf, "part").select(key.alias("i"), F.concat(name, F.lit(" "), kind, F.when(F.col("p_size") % 2 == 0, " NOT NULL").otherwise(" NULL")).alias("definition"))


@_query(f"""WITH c AS ({_DEFS}) SELECT i, upper(CASE WHEN t LIKE '"%' THEN regexp_extract(t,'^"([^"]*)"',1) ELSE regexp_extract(t,'^(\\S+)',1) END) AS col,
trim(regexp_replace(lower(CASE WHEN t LIKE '"%' THEN regexp_replace(t,'^"[^"]*"','') ELSE regexp_replace(t,'^\\S+','') END),'(not null|null).*$','')) AS col_type, NOT (lower(t) LIKE '%not null%') AS nullable FROM c""")
def parse_columns(spark, sf):
    return specs.parse_columns(_definitions(spark, sf)).select("i", "col", "col_type", "nullable")


@_query("""WITH c AS (SELECT p_partkey, ['timestamp','date','bigint','decimal(' || p_size || ',2)','varchar(' || p_size || ')','money'][p_partkey % 6 + 1] AS t FROM part), w AS (SELECT *, regexp_extract(t,'^[^\\s(]+') AS f FROM c)
SELECT p_partkey, t, CASE WHEN f IN ('timestamp','date') THEN 'TIMESTAMP' WHEN f IN ('bigint','decimal','money') THEN 'NUMERIC' ELSE 'INVALID' END AS key_class FROM w""")
def classify_key_type(spark, sf):
    size = F.col("p_size").cast("string")
    kinds = F.array(F.lit("timestamp"), F.lit("date"), F.lit("bigint"), F.concat(F.lit("decimal("), size, F.lit(",2)")), F.concat(F.lit("varchar("), size, F.lit(")")), F.lit("money"))
    t = F.element_at(kinds, (F.col("p_partkey") % 6 + 1).cast("int"))
    return _t(spark, sf, "part").select("p_partkey", t.alias("t"), fn.key_class(t).alias("key_class"))


@_query("""WITH l AS (SELECT DISTINCT l_orderkey AS tbl, 'c' || l_suppkey AS cname, l_suppkey FROM lineitem), tc AS (SELECT tbl, cname, ['FOREIGN KEY','UNIQUE','UNIQUE','PRIMARY KEY'][(l_suppkey + tbl) % 4 + 1] AS ctype FROM l),
kcu AS (SELECT DISTINCT l_orderkey AS tbl, 'c' || l_suppkey AS cname, 'k' || l_linenumber AS col, l_linenumber AS ord FROM lineitem),
pick AS (SELECT tbl, cname FROM (SELECT *, row_number() OVER (PARTITION BY tbl ORDER BY CASE ctype WHEN 'PRIMARY KEY' THEN 0 ELSE 1 END, cname) AS rn FROM tc WHERE ctype IN ('PRIMARY KEY','UNIQUE')) WHERE rn = 1)
SELECT k.tbl, string_agg(k.col, ',' ORDER BY k.ord) AS key_columns FROM pick p JOIN kcu k ON p.tbl = k.tbl AND p.cname = k.cname GROUP BY 1""")
def pick_unique_key(spark, sf):
    line = _t(spark, sf, "lineitem").select(F.col("l_orderkey").alias("tbl"), F.concat(F.lit("c"), F.col("l_suppkey").cast("string")).alias("cname"), "l_suppkey", F.col("l_linenumber").alias("ord"))
    kinds = F.array(*map(F.lit, ["FOREIGN KEY", "UNIQUE", "UNIQUE", "PRIMARY KEY"]))
    tc = line.select("tbl", "cname", F.element_at(kinds, ((F.col("l_suppkey") + F.col("tbl")) % 4 + 1).cast("int")).alias("ctype"))
    kcu = line.select("tbl", "cname", F.concat(F.lit("k"), F.col("ord").cast("string")).alias("col"), "ord")
    return catalog.unique_keys(tc, kcu)


# --- specs, state, reports -------------------------------------------------------------------

_SPEC = """SELECT c_name AS n, CASE WHEN c_custkey % 3 = 0 THEN 'ID,NM,FLG' WHEN c_custkey % 3 = 1 THEN 'ID,UPD' ELSE 'ID,NM' END AS cols, CASE WHEN c_nationkey % 4 = 0 THEN 'KX' ELSE 'ID' END AS uk,
CASE WHEN c_nationkey % 5 = 0 THEN 'ID' WHEN c_nationkey % 5 = 1 THEN 'NM' ELSE '' END AS mask, CASE c_custkey % 4 WHEN 0 THEN 'flg = 1' WHEN 1 THEN 'bad' WHEN 2 THEN 'nope = 1' ELSE '' END AS del,
CASE WHEN c_nationkey % 2 = 0 THEN 'TS' ELSE '' END AS ik, CAST(c_custkey % 5 <> 0 AS INTEGER) AS enable, CASE WHEN c_nationkey % 3 = 0 THEN 'LOG_BASED' ELSE 'INCREMENTAL' END AS method FROM customer"""


def _specs(spark, sf):
    _t(spark, sf, "customer").createOrReplaceTempView("_tidemark_customer")
    return spark.sql(_SPEC.replace("FROM customer", "FROM _tidemark_customer"))


@_query(f"""WITH spec AS ({_SPEC}) SELECT n, 'unique_key' AS problem FROM spec WHERE NOT list_contains(string_split(cols,','), uk) UNION ALL SELECT n, 'mask_is_key' FROM spec WHERE mask = uk
UNION ALL SELECT n, 'mask' FROM spec WHERE mask <> '' AND NOT list_contains(string_split(cols,','), mask)
UNION ALL SELECT n, 'delete_condition' FROM spec WHERE del <> '' AND (len(string_split(del,'=')) <> 2 OR NOT list_contains(string_split(cols,','), upper(trim(string_split(del,'=')[1]))))""")
def validate_specs(spark, sf):
    return specs.validate(_specs(spark, sf), "n", "cols", "uk", "mask", "del")


@_query(f"WITH spec AS ({_SPEC}) SELECT n, CASE WHEN ik <> '' THEN ik WHEN list_contains(string_split(cols,','), 'UPD') THEN 'UPD' ELSE '' END AS keys FROM spec")
def effective_keys(spark, sf):
    return _specs(spark, sf).select("n", specs.effective(F.col("ik"), "UPD", F.col("cols")).alias("keys"))


@_query(f"WITH spec AS ({_SPEC}) SELECT n, CASE WHEN method='LOG_BASED' THEN 'SNAPSHOT + LOG_BASED' WHEN ik <> '' THEN 'INCREMENTAL' ELSE 'SNAPSHOT' END AS read_type FROM spec WHERE enable = 1")
def classify_read_type(spark, sf):
    return specs.classify(_specs(spark, sf), "ik", "enable", "method").select("n", "read_type")


@_query("""WITH fl AS (SELECT c_name AS n, c_custkey % 2 AS sn, c_custkey % 3 % 2 AS se, c_custkey % 5 % 2 AS rn, c_custkey % 7 % 2 AS re FROM customer WHERE c_nationkey % 2 = 0)
SELECT s.c_name AS object, coalesce(f.sn=1 OR f.se=1, false) AS reload_schema, coalesce(f.rn=1 OR f.re=1, false) AS reload_object, coalesce(f.se,0) AS next_schema_each, coalesce(f.re,0) AS next_object_each FROM customer s LEFT JOIN fl f ON s.c_name = f.n""")
def reload_plan(spark, sf):
    c = _t(spark, sf, "customer")
    k = F.col("c_custkey")
    flags = c.where("c_nationkey % 2 = 0").select(F.col("c_name").alias("object"), (k % 2).alias("schema_next"), (k % 3 % 2).alias("schema_each"), (k % 5 % 2).alias("object_next"), (k % 7 % 2).alias("object_each"))
    return state.reload_plan(c.select(F.col("c_name").alias("object")), flags)


_KEYS = "SELECT DISTINCT 'o' || o_custkey AS object, CASE WHEN o_orderstatus = 'O' THEN 'ts' ELSE 'id' END AS col, CASE WHEN o_orderstatus = 'O' THEN 'TIMESTAMP' ELSE 'NUMERIC' END AS cls FROM orders"


def _keys(spark, sf):
    by_time = F.col("o_orderstatus") == "O"
    return _t(spark, sf, "orders").select(F.concat(F.lit("o"), F.col("o_custkey").cast("string")).alias("object"), F.when(by_time, "ts").otherwise("id").alias("col"), F.when(by_time, "TIMESTAMP").otherwise("NUMERIC").alias("cls")).distinct()


@_query(f"WITH k AS ({_KEYS}) SELECT object, col, CASE cls WHEN 'TIMESTAMP' THEN '0001-01-01 00:00:00' ELSE '0' END AS value FROM k")
def initial_checkpoints(spark, sf):
    return state.initial(_keys(spark, sf))


@_query(f"""WITH conf AS ({_KEYS}), cp AS (SELECT DISTINCT 'o' || c_custkey AS object, 'id' AS col, '7' AS value FROM customer WHERE c_custkey % 3 <> 1 UNION SELECT 'o' || c_custkey, 'ts', '2024-01-01' FROM customer WHERE c_custkey % 2 = 0),
ch AS (SELECT coalesce(x.object, y.object) AS object FROM conf x FULL OUTER JOIN cp y ON x.object = y.object AND x.col = y.col WHERE x.object IS NULL OR y.object IS NULL)
SELECT c.object, c.col, CASE WHEN c.object IN (SELECT object FROM ch) THEN CASE c.cls WHEN 'TIMESTAMP' THEN '0001-01-01 00:00:00' ELSE '0' END ELSE p.value END AS value FROM conf c LEFT JOIN cp p ON c.object = p.object AND c.col = p.col""")
def checkpoint_reset(spark, sf):
    c = _t(spark, sf, "customer").select(F.concat(F.lit("o"), F.col("c_custkey").cast("string")).alias("object"), "c_custkey")
    saved = c.where("c_custkey % 3 <> 1").select("object", F.lit("id").alias("col"), F.lit("7").alias("value")).union(c.where("c_custkey % 2 = 0").select("object", F.lit("ts"), F.lit("2024-01-01")))
    return state.reset_changed(_keys(spark, sf), saved)


@_query("""WITH o AS (SELECT c_name AS n, CASE WHEN c_custkey % 2 = 0 THEN '["x > ' || c_nationkey || '","x <= ' || c_nationkey || '"]' ELSE '["y = ' || c_nationkey || '"]' END AS c FROM customer)
SELECT n, CAST(u.i AS INTEGER) AS part, json_extract_string(c, '$[' || (u.i - 1) || ']') AS condition FROM o, LATERAL (SELECT unnest(range(1, CAST(json_array_length(c) AS BIGINT) + 1)) AS i) u""")
def parse_conditions(spark, sf):
    k = F.col("c_nationkey").cast("string")
    two = F.concat(F.lit('["x > '), k, F.lit('","x <= '), k, F.lit('"]'))
    rows = _t(spark, sf, "customer").select(F.col("c_name").alias("n"), F.when(F.col("c_custkey") % 2 == 0, two).otherwise(F.concat(F.lit('["y = '), k, F.lit('"]'))).alias("c"))
    return specs.parse_conditions(rows, "c").select("n", "part", "condition")


@_query("""WITH o AS (SELECT c_nationkey AS g, c_custkey AS pos, c_name AS n, c_acctbal > 0 AS ok FROM customer) SELECT g, pos, n FROM o WHERE pos <= coalesce((SELECT min(f.pos) FROM o f WHERE f.g = o.g AND NOT f.ok), 1000000000)""")
def group_order(spark, sf):
    o = _t(spark, sf, "customer").select(F.col("c_nationkey").alias("g"), F.col("c_custkey").alias("pos"), F.col("c_name").alias("n"), (F.col("c_acctbal") > 0).alias("ok"))
    return state.group_order(o, "g", "pos", "ok").select("g", "pos", "n")


def _run_log(spark, sf):
    runs = _t(spark, sf, "events").groupBy(F.col("event_type").alias("object"), F.col("ts").cast("date").cast("string").alias("run")).agg(F.count("*").alias("records"), F.max("event_id").alias("k"))
    bad = F.col("records") % 2 == 0
    return runs.select("object", "run", "records", F.when(bad, "ERROR").otherwise("SUCCESS").alias("status"), F.when(bad, "even").otherwise("").alias("status_description"), F.create_map(F.lit("event_id"), F.col("k").cast("string")).alias("keys"))


_RUNS = "WITH r AS (SELECT event_type AS object, CAST(CAST(ts AS DATE) AS VARCHAR) AS run_date, count(*) AS records, max(event_id) AS k FROM events GROUP BY 1, 2), l AS (SELECT *, row_number() OVER (PARTITION BY object ORDER BY run_date DESC) AS rn, sum(records) OVER (PARTITION BY object) AS total FROM r)"


@_query(_RUNS + " SELECT object, run_date, records FROM l WHERE rn = 1 AND records % 2 = 0")
def failed_objects(spark, sf):
    return reports.failed_objects(_run_log(spark, sf)).select("object", F.col("run").alias("run_date"), "records")


@_query(_RUNS + " SELECT object, run_date AS last_run, records AS last_records, CAST(total AS BIGINT) AS total_records, 'event_id(' || k || ')' AS key_values, CASE WHEN records % 2 = 0 THEN 'ERROR (even)' ELSE 'SUCCESS' END AS status FROM l WHERE rn = 1")
def object_statistics(spark, sf):
    return reports.object_statistics(_run_log(spark, sf))


@_query(_RUNS + " SELECT count(*) FILTER (WHERE rn = 1) AS total_objects, count(*) FILTER (WHERE rn = 1 AND records % 2 = 0) AS failed_objects, CAST(sum(records) AS BIGINT) AS total_records FROM l")
def dashboard(spark, sf):
    return reports.dashboard(_run_log(spark, sf))


@_query("SELECT event_type, count(*) AS files_rows FROM events GROUP BY 1")
def csv_folder(spark, sf):
    """Events written as CSV files and read back with the text schema found in them."""
    at = _work(spark)
    _t(spark, sf, "events").select("event_id", "event_type").write.option("header", True).csv(at)
    found = sources.csv(spark, at, sources.csv_schema(spark, at))
    return found.groupBy("event_type").agg(F.count("*").alias("files_rows"))


# --- whole runs: the rows of the target after several of them ----------------------------------


def _target(spark, at: str, keys: list[str]):
    made: dict[str, Target] = {}
    return lambda spec: made.setdefault(spec.name, Target(spark, f"{at}/{spec.name}", keys))


@_query("SELECT o_orderkey, o_orderstatus, regexp_replace(regexp_replace(o_orderpriority,'[a-zA-Z]','X','g'),'[0-9]','9','g') AS o_orderpriority FROM orders WHERE o_orderstatus <> 'F' OR o_orderkey % 3 <> 0")
def run_incremental(spark, sf):
    """Two increments by key without a maximum of the source, then deletes; the later rows of the source lack some."""
    at, orders = _work(spark), _t(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    spec, targets = runs.ObjectSpec("orders", ["o_orderkey"], incremental={"o_orderkey": -1}, masked=["o_orderpriority"], compute_max=False), _target(spark, at, ["o_orderkey"])
    for source in (orders.where("o_orderkey < 4000"), orders, orders):
        runs.run(spark, [spec], lambda _, df=source: df, targets, f"{at}/log")
    left = orders.where("o_orderstatus <> 'F' OR o_orderkey % 3 <> 0")
    runs.run(spark, [spec], lambda _: left, targets, f"{at}/log", runs.delete_sync_object)
    return targets(spec).read()


@_query("SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN NULL ELSE c_acctbal END AS c_acctbal, CAST(c_nationkey AS VARCHAR) AS c_nationkey FROM customer")
def run_schema_drift(spark, sf):
    """A column is added, one dropped and one altered between two increments: the target follows and keeps its rows."""
    at, c = _work(spark), _t(spark, sf, "customer")
    old = c.where("c_custkey % 2 = 0").select("c_custkey", "c_name", "c_nationkey", F.lit(1).alias("part"))
    new = c.where("c_custkey % 2 = 1").select("c_custkey", "c_acctbal", F.col("c_nationkey").cast("string").alias("c_nationkey"), F.lit(2).alias("part"))
    spec, targets = runs.ObjectSpec("customer", ["c_custkey"], incremental={"part": 0}), _target(spark, at, ["c_custkey"])
    for source in (old, new):
        runs.run(spark, [spec], lambda _, df=source: df, targets, f"{at}/log")
    return targets(spec).read().select("c_custkey", "c_acctbal", "c_nationkey")


@_query("SELECT p_partkey, p_size + CASE WHEN p_partkey % 2 = 0 THEN 100 ELSE 0 END AS p_size FROM part")
def run_reload(spark, sf):
    """A snapshot is taken once, and once more after its object is flagged to be reloaded; the next start has the flag cleared."""
    at, part = _work(spark), _t(spark, sf, "part").select("p_partkey", "p_size")
    spec, targets = runs.ObjectSpec("part", ["p_partkey"]), _target(spark, at, ["p_partkey"])
    flags = spark.createDataFrame([("part", 0, 0, 1, 0)], "object string, schema_next int, schema_each int, object_next int, object_each int")
    changed = part.withColumn("p_size", F.col("p_size") + F.when(F.col("p_partkey") % 2 == 0, 100).otherwise(0))
    runs.run(spark, [spec], lambda _: part, targets, f"{at}/log")
    runs.run(spark, [spec], lambda _: part.withColumn("p_size", F.lit(-1)), targets, f"{at}/log")
    runs.run(spark, [spec], lambda _: changed, targets, f"{at}/log", flags=flags)
    runs.run(spark, [spec], lambda _: part, targets, f"{at}/log", flags=state.next_flags(flags))
    return targets(spec).read()


@_query("SELECT 'supplier' AS object, count(*) AS n FROM supplier UNION ALL SELECT 'nation', count(*) FROM nation UNION ALL SELECT 'customer', NULL")
def run_objects(spark, sf):
    """An object is no longer in the source and its target goes; a new one is adopted and read whole."""
    at, keys = _work(spark), {"customer": "c_custkey", "supplier": "s_suppkey", "nation": "n_nationkey"}
    targets = lambda spec: Target(spark, f"{at}/{spec.name}", [keys[spec.name]])
    spec = lambda name: runs.ObjectSpec(name, [keys[name]], group=name)
    for present in (["customer", "nation"], ["supplier", "nation"]):
        listing = spark.createDataFrame([(x,) for x in present], "object_name string")
        runs.run(spark, [spec("customer"), spec("nation")], lambda name: _t(spark, sf, name), targets, f"{at}/log", listing=listing, adopt=spec, drop=True)
    counts = [Target(spark, f"{at}/{x}", [keys[x]]).read().agg(F.lit(x).alias("object"), F.count("*").alias("n")) for x in ("supplier", "nation")]
    gone = spark.createDataFrame([("customer", None)], "object string, n bigint") if not targets(spec("customer")).columns() else counts[0]
    return counts[0].union(counts[1]).union(gone)


@_query("SELECT CAST(s_suppkey AS VARCHAR) AS s_suppkey, CASE WHEN s_suppkey % 4 = 0 THEN 'later' ELSE s_name END AS s_name FROM supplier")
def run_csv(spark, sf):
    """A folder of CSV files, and files that come later and repeat keys."""
    at, s = _work(spark), _t(spark, sf, "supplier").select("s_suppkey", "s_name")
    spec, targets = runs.ObjectSpec("supplier", ["s_suppkey"], kind="csv", incremental={"_file_time": datetime.datetime(1970, 1, 1)}), _target(spark, at, ["s_suppkey"])
    for rows in (s, s.where("s_suppkey % 4 = 0").withColumn("s_name", F.lit("later"))):
        rows.write.mode("append").option("header", True).csv(f"{at}/in")
        found = sources.csv_files(spark, f"{at}/in", sources.csv_schema(spark, f"{at}/in"))
        runs.run(spark, [spec], lambda _, df=found: df, targets, f"{at}/log")
    return targets(spec).read()


@_query("""SELECT CAST(event_id AS VARCHAR) AS _id, CASE WHEN user_id % 2 = 0 OR event_id % 3 = 0 THEN regexp_replace(regexp_replace(event_type,'[a-zA-Z]','X','g'),'[0-9]','9','g') END AS event_type FROM events""")
def run_documents(spark, sf):
    """Documents by an increment over a time and a number, one field masked."""
    at, e = _work(spark), _t(spark, sf, "events")
    when = F.date_format(F.timestamp_seconds("event_id") + F.expr("INTERVAL 1 SECOND"), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    e = e.select("event_id", "event_type", F.when(F.col("user_id") % 2 == 0, when).otherwise(None).alias("at"), F.when(F.col("event_id") % 3 == 0, F.col("event_id") + 1).alias("n"))
    docs = sources.documents(e, "event_id", ["event_type", "at", "n"])
    spec, targets = runs.ObjectSpec("events", ["_id"], kind="documents", incremental={"at": datetime.datetime(1970, 1, 1), "n": 0}, masked=["event_type"]), _target(spark, at, ["_id"])
    for rows in (docs.where("CAST(_id AS BIGINT) < 4000"), docs):
        runs.run(spark, [spec], lambda _, df=rows: df, targets, f"{at}/log")
    out = targets(spec).read().select("_id", F.get_json_object("document", "$.event_type").alias("event_type"))
    return e.select(F.col("event_id").cast("string").alias("_id")).join(out, "_id", "left")


@_query("SELECT event_id, user_id FROM events WHERE user_id > 10 OR event_id > 5000")
def run_limited(spark, sf):
    """A limit over two keys, read by read, until nothing is left: no row is passed over."""
    at, e = _work(spark), _t(spark, sf, "events").select("event_id", "user_id")
    size = -(-e.count() // 3)
    spec, targets = runs.ObjectSpec("events", ["event_id"], incremental={"user_id": 10, "event_id": 5000}, limit=size), _target(spark, at, ["event_id"])
    for _ in range(12):
        if not runs.run(spark, [spec], lambda _: e, targets, f"{at}/log").first().records:
            return targets(spec).read()
    raise RuntimeError("the limited reads do not end")


@_query(_APPLIED.replace("FROM events", "FROM events WHERE ts >= TIMESTAMP '2024-01-10'"))
def stream_since(spark, sf):
    """Two streams into one target, from a log position on."""
    at = _work(spark)
    target = Target(spark, f"{at}/target", ["k"])
    target.apply(_customers(spark, sf), "first")
    for i, part in enumerate(("_seq % 2 = 1", "_seq % 2 = 0")):
        _events(spark, sf).where(part).write.parquet(f"{at}/in{i}")
        stream = change_stream(spark, f"{at}/in{i}", "_op string, _ts timestamp, _seq bigint, k bigint, seq bigint", since=datetime.datetime(2024, 1, 10))
        apply_stream(stream, target, f"{at}/checkpoint{i}").awaitTermination()
    return target.read().select("k", "seq")


# --- deletes, logs, partitions and files in one run or several -----------------------------------

_SHAPE = "_op string, _ts timestamp, _seq bigint, k bigint, seq bigint"


@_query(_LATEST + " SELECT k, seq FROM l WHERE op <> 'D' AND (ts >= TIMESTAMP '2024-01-15' OR k % 3 <> 0)")
def run_delete_after_stream(spark, sf):
    """A target fed by a stream loses the keys that its source lost; those that later events bring are back."""
    at, spec = _work(spark), runs.ObjectSpec("users", ["k"])
    target = Target(spark, f"{at}/target", ["k"])
    split = F.col("_ts") < F.lit(datetime.datetime(2024, 1, 15)).cast("timestamp_ntz").cast("timestamp")
    for part in (split, ~split):
        _events(spark, sf).where(part).write.mode("append").parquet(f"{at}/in")
        apply_stream(change_stream(spark, f"{at}/in", _SHAPE), target, f"{at}/checkpoint").awaitTermination()
        for source in (target.read().where("k % 3 <> 0"), target.read().where("false")):
            if part is split:
                runs.run(spark, [spec], lambda _, df=source: df, lambda _: target, f"{at}/log", runs.delete_sync_object)
    return target.read().select("k", "seq")


@_query(_LATEST + " SELECT k, seq FROM l WHERE op <> 'D'")
def run_log_based(spark, sf):
    """Objects read by their log: a snapshot with the log's position before it, then the log, in two runs of which the second has new events."""
    at, events = _work(spark), _events(spark, sf)
    split = F.col("_ts") < F.lit(datetime.datetime(2024, 1, 15)).cast("timestamp_ntz").cast("timestamp")
    spec, targets = runs.ObjectSpec("users", ["k"], kind="log"), _target(spark, at, ["k"])
    rows = log.latest(events.where(split), ["k"], ["_ts", "_seq"]).where("_op <> 'D'").select("k", "seq")
    for part in (split, ~split):
        events.where(part).write.mode("append").parquet(f"{at}/in")
        position = lambda: sources.log_position(spark.read.schema(_SHAPE).parquet(f"{at}/in"), "_ts").first().log_ts
        source = LogSource(rows, position, lambda since: change_stream(spark, f"{at}/in", _SHAPE, since=since))
        runs.run(spark, [spec], lambda _, s=source: s, targets, f"{at}/log")
    return targets(spec).read().select("k", "seq")


@_query("SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus IN ('O', 'F')")
def run_partitions(spark, sf):
    """Two partitions with checkpoints of their own: the rows of the one that lags are read although the other is far ahead."""
    at, orders = _work(spark), _t(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    spec, targets = runs.ObjectSpec("orders", ["o_orderkey"], incremental={"o_orderkey": -1}, conditions=["o_orderstatus = 'O'", "o_orderstatus = 'F'"]), _target(spark, at, ["o_orderkey"])
    for source in (orders.where("o_orderstatus = 'O' OR o_orderkey < 2000"), orders, orders):
        runs.run(spark, [spec], lambda _, df=source: df, targets, f"{at}/log")
    return targets(spec).read()


@_query("""SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_name || chr(10) || '"' || p_brand || '", ' || p_size AS p_name FROM part""")
def run_csv_same_time(spark, sf):
    """Files whose values hold line breaks, quotes and separators; all files have one time, and half of them come later."""
    at, part = _work(spark), _t(spark, sf, "part")
    text = F.concat("p_name", F.lit('\n"'), "p_brand", F.lit('", '), F.col("p_size").cast("string"))
    spec, targets = runs.ObjectSpec("part", ["p_partkey"], kind="csv", incremental={"_file_time": datetime.datetime(1970, 1, 1)}, files=2), _target(spark, at, ["p_partkey"])
    for half in range(2):
        part.where(F.col("p_partkey") % 2 == half).select("p_partkey", text.alias("p_name")).repartition(2, "p_partkey").write.mode("append").options(header=True, escape='"').csv(f"{at}/in")
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{at}/in")
        fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
        for s in fs.listStatus(folder):
            fs.setTimes(s.getPath(), 1_700_000_000_000, -1)
        found = sources.csv_files(spark, f"{at}/in", sources.csv_schema(spark, f"{at}/in"))
        runs.run(spark, [spec], lambda _, df=found: df, targets, f"{at}/log")
    return targets(spec).read()


@_query("SELECT CAST(event_id AS VARCHAR) AS _id, event_type FROM events")
def run_documents_exact(spark, sf):
    """Documents with a whole-number key above 2**53, one apart from each other; the second read has those above the first's greatest."""
    at, e = _work(spark), _t(spark, sf, "events").select("event_id", "event_type", (F.col("event_id") + (1 << 53)).alias("n"))
    docs = sources.documents(e, "event_id", ["event_type", "n"])
    spec, targets = runs.ObjectSpec("events", ["_id"], kind="documents", incremental={"n": 0}), _target(spark, at, ["_id"])
    for rows in (docs.where("CAST(_id AS BIGINT) <= 5000"), docs.where("CAST(_id AS BIGINT) <= 5001"), docs):
        runs.run(spark, [spec], lambda _, df=rows: df, targets, f"{at}/log")
    return targets(spec).read().select("_id", F.get_json_object("document", "$.event_type").alias("event_type"))


@_query("SELECT 'events' AS object, 'SNAPSHOT + LOG_BASED' AS read_type, 'SUCCESS' AS last_read_status, count(*) AS total_records FROM events")
def stream_statistics(spark, sf):
    """A stream that writes a row of the run log for each micro-batch, and the report over it."""
    at = _work(spark)
    _events(spark, sf).repartition(4, "_seq").write.parquet(f"{at}/in")
    stream = change_stream(spark, f"{at}/in", _SHAPE, files=2)
    finished(apply_stream(stream, Target(spark, f"{at}/target", ["k"]), f"{at}/checkpoint", name="events", log_path=f"{at}/log"))
    return reports.statistics(spark.read.schema(runs.LOG_SCHEMA).parquet(f"{at}/log")).select("object", "read_type", "last_read_status", "total_records")


@_query("SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_orderkey <= (SELECT l_orderkey FROM lineitem ORDER BY l_orderkey LIMIT 1 OFFSET (SELECT count(*) // 2 - 1 FROM lineitem))")
def limited_half(spark, sf):
    """A limit of half the table, ties of the last row included; no task sorts it."""
    rows = _t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return increment.read(rows, {"l_orderkey": -1}, limit=rows.count() // 2)[0]


@_query("SELECT 'orders' AS object, 'o_orderstatus = ''' || o_orderstatus || '''' AS part, 'o_orderkey' AS col, CAST(max(o_orderkey) AS VARCHAR) AS value FROM orders WHERE o_orderstatus IN ('O', 'F') GROUP BY o_orderstatus")
def partition_checkpoints(spark, sf):
    """The checkpoints of an object's partitions after a read."""
    at, orders = _work(spark), _t(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    spec, targets = runs.ObjectSpec("orders", ["o_orderkey"], incremental={"o_orderkey": -1}, conditions=["o_orderstatus = 'O'", "o_orderstatus = 'F'"]), _target(spark, at, ["o_orderkey"])
    runs.run(spark, [spec], lambda _: orders, targets, f"{at}/log")
    return runs.checkpoints(spark, {"orders": targets(spec)})


@_query("SELECT 'users' AS object, epoch_us(max(ts)) AS micros FROM events")
def log_positions(spark, sf):
    """The time that a target has reached in its log."""
    at, events = _work(spark), _events(spark, sf)
    events.repartition(4, "_seq").write.parquet(f"{at}/in")
    target = Target(spark, f"{at}/target", ["k"])
    apply_stream(change_stream(spark, f"{at}/in", _SHAPE, files=2), target, f"{at}/checkpoint").awaitTermination()
    return runs.log_positions(spark, {"users": target}).select("object", F.unix_micros("ts").alias("micros"))


@_query("SELECT event_type AS folder, 1 AS files FROM events WHERE event_type IS NOT NULL GROUP BY 1")
def file_listing(spark, sf):
    """Files by folder, told from the listing alone. One task writes a folder's one file, row by row as they come: what it holds doesn't grow with them."""
    at, events = _work(spark), _t(spark, sf, "events")
    named = events.withColumn("folder", F.concat(F.lit("x"), F.hex("event_type")))  # any text is a folder's name so, an empty one too
    writers, before = "spark.sql.maxConcurrentOutputFileWriters", spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")
    spark.conf.set(writers, 8)  # without, a task's rows are sorted by folder; beyond these, the rest of them
    try:
        # A shuffle to at most 200 tasks (spark.shuffle.sort.bypassMergeThreshold) keeps no rows in memory either.
        named.repartition(200, "folder").write.partitionBy("folder").parquet(at)
    finally:
        spark.conf.set(writers, before)
    found = sources.files(spark, at).where(F.col("path").contains("/folder=x"))
    name = F.unhex(F.regexp_extract("path", "/folder=x([0-9A-F]*)/", 1)).cast("string")
    return found.groupBy(name.alias("folder")).agg(F.count("*").cast("int").alias("files"))


@_query("""SELECT p_brand AS tbl, p_partkey AS ord, 'c' || p_partkey || ' ' || ['INTEGER[]','BIGINT[]','BOOLEAN[]','FLOAT[]','NUMERIC[]','TIMESTAMP[]','DATE[]','TIME[]','CHARACTER[]','TEXT[]','TEXT[]'][p_partkey % 11 + 1] || ' NULL' AS definition FROM part""")
def array_definitions(spark, sf):
    """Columns of every kind of array, an unknown one among them."""
    udts = F.array(*map(F.lit, ["_int4", "_int8", "_boolean", "_float8", "_numeric", "_timestamp", "_date", "_time", "_bpchar", "_text", "_other"]))
    key, none = F.col("p_partkey"), F.lit(0)
    cols = _t(spark, sf, "part").select(F.col("p_brand").alias("tbl"), key.alias("ord"), F.concat(F.lit("c"), key.cast("string")).alias("col"), F.lit("ARRAY").alias("dt"), none.alias("len"), none.alias("prec"), none.alias("scale"), F.lit("YES").alias("nullable"), F.element_at(udts, (key % 11 + 1).cast("int")).alias("udt"))
    return catalog.column_definitions(cols)


# --- reports over a log of every kind of action ------------------------------------------------


def _full_log(spark, sf):
    day = F.dayofmonth("ts")
    runs_ = _t(spark, sf, "events").groupBy(F.col("event_type").alias("object"), day.alias("day")).agg(F.count("*").alias("records"), F.min("ts").cast("timestamp").alias("start_ts"), F.max("ts").cast("timestamp").alias("end_ts"), F.max("event_id").alias("k"))
    kind = F.when(F.col("object").isin("click", "view"), "SNAPSHOT").otherwise("INCREMENTAL")
    ddls = F.array_repeat(F.lit("ADD COLUMN x int"), (F.col("day") % 3).cast("int"))
    return runs_.select("object", kind.alias("read_type"), F.when(F.col("day") % 4 == 0, "DELETE_SYNC").otherwise("READ").alias("action"), "start_ts", "end_ts", "records", F.when(F.col("records") % 2 == 0, "ERROR").otherwise("SUCCESS").alias("status"),
        F.lit("").alias("status_description"), F.create_map(F.lit("event_id"), F.col("k").cast("string")).alias("keys"), ddls.alias("ddls"), (F.col("day") % 5 == 0).cast("int").alias("object_reload"), (F.col("day") % 7 == 0).cast("int").alias("schema_reload"), F.col("day").cast("long").alias("commit_id"))


_FULL = """WITH r AS (SELECT event_type AS object, day(ts) AS d, count(*) AS records, min(ts) AS s, max(ts) AS e, max(event_id) AS k FROM events GROUP BY 1, 2),
a AS (SELECT *, d % 4 = 0 AS sync, CASE WHEN object IN ('click','view') THEN 'SNAPSHOT' ELSE 'INCREMENTAL' END AS kind, CASE WHEN records % 2 = 0 THEN 'ERROR' ELSE 'SUCCESS' END AS status FROM r),
st AS (SELECT object, max(kind) AS read_type, max(s) FILTER (NOT sync) AS rs, arg_max(e, s) FILTER (NOT sync) AS re, arg_max(records, s) FILTER (NOT sync) AS rr, arg_max(k, s) FILTER (NOT sync) AS rk, arg_max(status, s) FILTER (NOT sync) AS rstat,
  max(s) FILTER (sync) AS ds, arg_max(e, s) FILTER (sync) AS de, arg_max(records, s) FILTER (sync) AS dr, CAST(coalesce(sum(records) FILTER (NOT sync), 0) AS BIGINT) AS total, CAST(sum(d % 3) AS BIGINT) AS ddls,
  CAST(sum(CASE WHEN d % 5 = 0 THEN 1 ELSE 0 END) AS BIGINT) AS o, CAST(sum(CASE WHEN d % 7 = 0 THEN 1 ELSE 0 END) AS BIGINT) AS sr, max(d) AS c, arg_max(status, s) AS last_status, arg_max(e, s) AS last_e FROM a GROUP BY object)"""


@_query(_FULL + """ SELECT object, read_type, epoch(rs) AS last_read_start, epoch(re) AS last_read_end, rr AS last_read_records, 'event_id(' || rk || ')' AS last_read_keys, rstat AS last_read_status, epoch(ds) AS last_delete_sync_start,
 epoch(de) AS last_delete_sync_end, dr AS last_delete_sync_keys, total AS total_records, ddls AS total_ddls, o AS total_object_reloads, sr AS total_schema_reloads, CAST(c AS BIGINT) AS last_commit_id FROM st""")
def object_report(spark, sf):
    out = reports.statistics(_full_log(spark, sf)).drop("last_read_status_description")
    return out.withColumns({c: F.unix_micros(c) / 1e6 for c in ("last_read_start", "last_read_end", "last_delete_sync_start", "last_delete_sync_end")})


@_query(_FULL + """ SELECT count(*) AS total_objects, count(*) FILTER (last_status = 'ERROR') AS failed_objects, count(*) FILTER (read_type = 'SNAPSHOT') AS snapshot_objects, count(*) FILTER (read_type = 'INCREMENTAL') AS incremental_objects,
 epoch(max(rs)) AS last_read_start, epoch(max(re)) AS last_read_end, epoch(max(ds)) AS last_delete_sync_start, epoch(max(de)) AS last_delete_sync_end, CAST(sum(total) AS BIGINT) AS total_records, epoch(max(last_e)) AS last_heartbeat, epoch(greatest(max(rs), max(ds))) AS last_job_start FROM st""")
def job_report(spark, sf):
    out = reports.totals(_full_log(spark, sf)).drop("log_based_objects")
    return out.withColumns({c: F.unix_micros(c) / 1e6 for c in ("last_read_start", "last_read_end", "last_delete_sync_start", "last_delete_sync_end", "last_heartbeat", "last_job_start")})


@_query("""WITH e AS (SELECT user_id AS k, ts < TIMESTAMP '2024-01-15' AS before FROM events)
SELECT CAST(3 AS BIGINT) AS total_objects, CAST(0 AS BIGINT) AS failed_objects, CAST(1 AS BIGINT) AS snapshot_objects, CAST(1 AS BIGINT) AS incremental_objects, CAST(1 AS BIGINT) AS log_based_objects,
 (SELECT count(*) FROM nation) + (SELECT count(*) FROM orders) + (SELECT count(DISTINCT k) FROM e WHERE before) + (SELECT count(*) FROM e WHERE NOT before) AS total_records""")
def job_of_all_kinds(spark, sf):
    """The report on one job that reads a table once, a table by its key, and an object by its log."""
    at, events, keys = _work(spark), _events(spark, sf), {"nation": "n_nationkey", "orders": "o_orderkey", "users": "k"}
    split = F.expr("CAST(TIMESTAMP_NTZ '2024-01-15' AS TIMESTAMP)")
    events.write.parquet(f"{at}/in")
    rows = events.where(F.col("_ts") < split).groupBy("k").agg(F.max_by("seq", F.struct("_ts", "_seq")).alias("seq"))
    users = LogSource(rows, lambda: spark.range(1).select(split).first()[0], lambda since: change_stream(spark, f"{at}/in", _SHAPE, since=since))
    specs = [runs.ObjectSpec("nation", ["n_nationkey"], group="a"), runs.ObjectSpec("orders", ["o_orderkey"], incremental={"o_orderkey": -1}, group="b"), runs.ObjectSpec("users", ["k"], kind="log", group="c")]
    runs.run(spark, specs, lambda name: users if name == "users" else _t(spark, sf, name), lambda s: Target(spark, f"{at}/{s.name}", [keys[s.name]]), f"{at}/log", threads=3)
    return reports.totals(spark.read.schema(runs.LOG_SCHEMA).parquet(f"{at}/log")).select("total_objects", "failed_objects", "snapshot_objects", "incremental_objects", "log_based_objects", "total_records")


@_query("SELECT (SELECT count(DISTINCT (o_custkey, o_orderstatus = 'O')) FROM orders) AS checkpoints, (SELECT count(*) FILTER (c_custkey % 5 <> 0) FROM customer) AS enabled_objects")
def state_counts(spark, sf):
    return state.counts(state.initial(_keys(spark, sf)), _specs(spark, sf), "enable")


@_query("SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate > TIMESTAMP '1998-01-01' AND o_orderdate <= (SELECT max(o_orderdate) FROM orders)")
def incremental_converted(spark, sf):
    """Bounds that an expression makes of their text."""
    return increment.read(_t(spark, sf, "orders"), {"o_orderdate": T1998}, convert="to_timestamp_ntz($, 'yyyy-MM-dd HH:mm:ss')")[0].select("o_orderkey", "o_orderdate")


@_query("SELECT c_custkey, left(c_name, 2) || '***' AS c_name FROM customer")
def mask_callable(spark, sf):
    return log.mask(_t(spark, sf, "customer").select("c_custkey", "c_name"), ["c_name"], masker=lambda v: F.concat(F.left(v, F.lit(2)), F.lit("***")))


def queries() -> dict[str, _Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


def entry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship: an increment of orders by date, masked, merged into the older rows by key."""
    orders = _t(spark, sf_dir, "orders")
    old = orders.where(F.col("o_orderdate") <= F.lit(T1998))
    new, _ = increment.read(orders, {"o_orderdate": T1998})
    return merge.upsert(log.mask(old, ["o_orderpriority"]), log.mask(new, ["o_orderpriority"]), ["o_orderkey"])
