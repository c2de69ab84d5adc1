"""Discovery over catalogue tables: objects, columns, keys, what is new and what is gone."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import declared_type, nullability
from ..operators.schema import definitions


def list_objects(tables: DataFrame, pattern: str = "%", kind: str = "ALL") -> DataFrame:
    """(object_name, object_type) of tables and/or views by name, each once, from (object_name, table_type); null names are left out."""
    named = tables.where(F.col("object_name").like(pattern))
    parts = {"TABLE": "BASE TABLE", "VIEW": "VIEW"}
    picked = [named.where(F.col("table_type") == t).select("object_name", F.lit(k).alias("object_type")) for k, t in parts.items() if kind in (k, "ALL")]
    out = picked[0]
    for p in picked[1:]:
        out = out.union(p)
    return out.distinct()


def jdbc_catalog(spark: SparkSession, name: str, url: str, **options: str) -> str:
    """Register a database as the catalogue ``name``: its tables are ``name.schema.table``, and bounds, columns and maxima reach it."""
    for key, value in {"": "org.apache.spark.sql.execution.datasources.v2.jdbc.JDBCTableCatalog", ".url": url, ".pushDownAggregate": "true", **{f".{k}": v for k, v in options.items()}}.items():
        spark.conf.set(f"spark.sql.catalog.{name}{key}", value)
    return name


def jdbc_objects(spark: SparkSession, catalog: str, schema: str, pattern: str = "%") -> DataFrame:
    """(object_name, object_type) of the tables in a schema of a registered catalogue, by name; one row per table."""
    tables = spark.sql(f"SHOW TABLES IN `{catalog}`.`{schema}`")
    return tables.where(F.col("tableName").like(pattern)).select(F.col("tableName").alias("object_name"), F.lit("TABLE").alias("object_type")).distinct()


def jdbc_metadata(spark: SparkSession, url: str, schema: str | None = None, pattern: str = "%", **options: str) -> dict[str, DataFrame]:
    """What a driver itself says of the tables and views of a schema: ``tables`` (object_name, table_type), ``constraints`` (tbl, cname, ctype) and ``usage``
    (tbl, cname, col, ord), as ``list_objects`` and ``unique_keys`` take them.

    For any database with a driver, whether or not it has the standard's views. Primary keys come from the driver's list of them, unique
    constraints from its unique indexes; an index of statistics or of an expression has no columns and is left out. Only metadata
    is read, on the driver: a row for each table, and for each column of a key.
    """
    jvm = spark._jvm
    if options.get("driver"):
        jvm.java.lang.Thread.currentThread().getContextClassLoader().loadClass(options["driver"])
    given = jvm.java.util.Properties()
    for key, value in options.items():
        given.setProperty(key, value)
    connection = jvm.java.sql.DriverManager.getConnection(url, given)

    def rows(result: Any, *columns: str) -> list[tuple]:
        try:
            out = []
            while result.next():
                out.append(tuple(result.getString(c) for c in columns))
            return out
        finally:
            result.close()

    try:
        meta = connection.getMetaData()
        kinds = spark.sparkContext._gateway.new_array(jvm.java.lang.String, 2)
        kinds[0], kinds[1] = "TABLE", "VIEW"
        found = rows(meta.getTables(None, schema, pattern, kinds), "TABLE_SCHEM", "TABLE_NAME", "TABLE_TYPE")
        names, usage = {}, []
        for there, table, kind in found:
            if kind != "TABLE":
                continue
            primary = rows(meta.getPrimaryKeys(None, there, table), "PK_NAME", "COLUMN_NAME", "KEY_SEQ")
            unique = rows(meta.getIndexInfo(None, there, table, True, False), "INDEX_NAME", "COLUMN_NAME", "ORDINAL_POSITION")
            for kind_, listed in (("PRIMARY KEY", primary), ("UNIQUE", unique)):
                for name, column, place in listed:
                    if column is not None:
                        names[table, name or kind_] = names.get((table, name or kind_), kind_)
                        usage.append((table, name or kind_, column, int(place)))
    finally:
        connection.close()
    tables = [(t, "BASE TABLE" if k == "TABLE" else k) for _, t, k in found]
    constraints = [(t, n, k) for (t, n), k in names.items()]
    return {
        "tables": spark.createDataFrame(tables, "object_name string, table_type string"),
        "constraints": spark.createDataFrame(constraints, "tbl string, cname string, ctype string"),
        "usage": spark.createDataFrame(usage, "tbl string, cname string, col string, ord int"),
    }


def described(spark: SparkSession, tables: dict[str, DataFrame]) -> DataFrame:
    """(tbl, ord, col, def) of the columns of named frames; a name in another case than an earlier one of its table is left out.

    Only schemas are read, on the driver: one row for each column.
    """
    rows = []
    for tbl, df in tables.items():
        seen: set[str] = set()
        for ord_, (col, kind) in enumerate(definitions(df), 1):
            if col.lower() not in seen:
                seen.add(col.lower())
                rows.append((tbl, ord_, col, kind))
    return spark.createDataFrame(rows, "tbl string, ord int, col string, def string")


# Fixed names: the standard's catalogue views and the columns of them that discovery needs.
_VIEWS = {
    "tables": "SELECT table_schema, table_name AS object_name, table_type FROM information_schema.tables",
    "columns": "SELECT table_schema, table_name AS tbl, column_name AS col, ordinal_position AS ord, data_type AS dt, character_maximum_length AS len, numeric_precision AS prec, numeric_scale AS scale, is_nullable AS nullable{udt} FROM information_schema.columns",
    "constraints": "SELECT table_schema, table_name AS tbl, constraint_name AS cname, constraint_type AS ctype FROM information_schema.table_constraints",
    "usage": "SELECT table_schema, table_name AS tbl, constraint_name AS cname, column_name AS col, ordinal_position AS ord FROM information_schema.key_column_usage",
}


def information_schema(spark: SparkSession, url: str, view: str, schema: str, udt: bool = False, **options: str) -> DataFrame:
    """One of the views ``tables``, ``columns``, ``constraints``, ``usage`` of a database's schema, as the functions below take it.

    The schema is a filter that reaches the source. ``udt``: the database has ``udt_name`` (else it is null).
    """
    query = _VIEWS[view].format(udt=", udt_name AS udt" if udt else "")
    rows = spark.read.options(**options).format("jdbc").option("url", url).option("dbtable", f"({query}) v").load()
    rows = rows.toDF(*[c.lower() for c in rows.columns]).where(F.col("table_schema") == schema).drop("table_schema")
    return rows.withColumn("udt", F.lit(None).cast("string")) if view == "columns" and not udt else rows


def list_folders(spark: SparkSession, path: str) -> DataFrame:
    """The names of the folders directly below ``path`` that hold files."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path")
    parts = F.split(F.split("path", "\\Q" + path.rstrip("/").split(":")[-1] + "/\\E").getItem(1), "/")
    return files.where(F.size(parts) > 1).select(parts[0].alias("object_name")).distinct()


def column_definitions(columns: DataFrame) -> DataFrame:
    """(tbl, ord, definition) from (tbl, ord, col, dt, len, prec, scale, nullable, udt); of repeated names the first counts."""
    rest = [c for c in columns.columns if c not in ("tbl", "col")]
    first = columns.groupBy("tbl", "col").agg(F.min_by(F.struct(*rest), "ord").alias("r")).select("tbl", "col", "r.*")
    name = F.when(F.col("col").contains(" "), F.concat(F.lit('"'), "col", F.lit('"'))).otherwise(F.col("col"))
    kind = declared_type(F.col("dt"), F.col("udt"), F.col("len"), F.col("prec"), F.col("scale"))
    return first.select("tbl", "ord", F.concat(name, F.lit(" "), kind, nullability(F.col("nullable"))).alias("definition"))


def unique_keys(constraints: DataFrame, usage: DataFrame) -> DataFrame:
    """(tbl, key_columns): the primary key of each table, else its first unique constraint by name; columns in order.

    Rows that repeat count once; a table whose constraint has no columns is left out. One shuffle by table, in which
    the column lists of all its constraints meet.
    """
    rank = F.when(F.col("ctype") == "PRIMARY KEY", 0).otherwise(1)
    place, column = F.struct(rank.alias("rank"), "cname"), F.struct("cname", "ord", "col")
    fit = constraints.where(F.col("ctype").isin("PRIMARY KEY", "UNIQUE")).select("tbl", place.alias("place")).withColumn("column", F.lit(None))
    both = fit.unionByName(usage.select("tbl", F.lit(None).alias("place"), column.alias("column")))
    found = both.groupBy("tbl").agg(F.min("place")["cname"].alias("cname"), F.collect_set("column").alias("columns"))
    own = F.array_sort(F.transform(F.filter("columns", lambda x: x["cname"] == F.col("cname")), lambda x: F.struct(x["ord"].alias("ord"), x["col"].alias("col"))))
    return found.select("tbl", "cname", own.alias("c")).where("cname IS NOT NULL AND size(c) > 0").select("tbl", F.array_join(F.transform("c", lambda x: x["col"]), ",").alias("key_columns"))


def new_objects(source: DataFrame, known: DataFrame, name: str = "object_name") -> DataFrame:
    """The names of the source that are not known, each once; a null name equals nothing, so it counts as new."""
    return source.select(name).distinct().join(known.select(name), name, "left_anti")


def dropped_objects(source: DataFrame, known: DataFrame, name: str = "object_name") -> DataFrame:
    """Known objects that the source no longer has, with the statement that drops them."""
    gone = known.select(name).distinct().join(source.select(name), name, "left_anti")
    return gone.select(name, F.concat(F.lit("DROP TABLE IF EXISTS "), name).alias("ddl"))
