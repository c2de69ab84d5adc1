"""Readers of tables, files, documents and change events as DataFrames."""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal
from typing import Any
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def snapshot(df: DataFrame, columns: list[str] | None = None, conditions: list[str] | None = None) -> DataFrame:
    """The allowed columns of all rows; with ``conditions`` those of each condition with its number in ``part``."""
    from ..operators.increment import partitioned

    if conditions:
        df, columns = partitioned(df, conditions), (["part", *columns] if columns else None)
    return df.select(*[F.col(f"`{c}`") for c in columns]) if columns else df


def jdbc(spark: SparkSession, url: str, table: str, conditions: list[str] | None = None, init: str | None = None, **options: str) -> DataFrame:
    """A table by JDBC: one partition per condition, ``init`` runs on each new connection.

    Ranges and the choice of columns reach the source. Maxima do so for a table of ``catalog.jdbc_catalog``, not here.
    """
    if init:
        options["sessionInitStatement"] = init
    if conditions:
        return spark.read.jdbc(url, table, predicates=conditions, properties=options)
    return spark.read.options(**options).format("jdbc").option("url", url).option("dbtable", table).load()


@dataclass(frozen=True)
class CsvDialect:
    """How files are written. ``multiline``: values in quotes may hold line breaks, so a file is read from its beginning by one task;
    without it large files are split at line ends (``line_sep``). Empty lines are no records."""

    header: bool = True
    sep: str = ","
    quote: str = '"'
    escape: str = '"'
    null: str = "null"
    trim: bool = True
    line_sep: str | None = None
    multiline: bool = True

    def options(self) -> dict[str, Any]:
        out = {"header": self.header, "sep": self.sep, "quote": self.quote, "escape": self.escape, "nullValue": self.null, "ignoreLeadingWhiteSpace": self.trim, "ignoreTrailingWhiteSpace": self.trim, "mode": "PERMISSIVE", "enforceSchema": True, "recursiveFileLookup": True, "multiLine": self.multiline}
        return out | ({"lineSep": self.line_sep} if self.line_sep else {})


def files(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(path, size, modified) of all files below ``path`` that aren't empty, from the listing alone: nothing is opened."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return found.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("size"), F.col("_metadata.file_modification_time").alias("modified"))


def csv_schema(spark: SparkSession, path: str, dialect: CsvDialect = CsvDialect()) -> T.StructType:
    """Text columns named by the first record of the first file by path, or ``col1..colN`` without a header.

    A blank name becomes ``col`` and its place, so the names after it stay with their columns. A file without a record is passed over; without any
    the schema is empty. Files are told by the listing, and only the first one with a record is opened; Spark takes signs of a pattern (``[``, ``{``, ``*``, ``?``)
    in its name for one, so a folder whose first file has such a name needs a schema that the caller states.
    """
    options = dialect.options() | {"header": False, "nullValue": "\ue000", "ignoreLeadingWhiteSpace": True, "ignoreTrailingWhiteSpace": True}
    there, last = files(spark, path), ""
    while (first := there.where(F.col("path") > last).agg(F.min("path")).first()[0]) is not None:
        found = spark.read.options(**options).csv(unquote(first)).limit(1).collect()
        if found and not (len(found[0]) == 1 and not (found[0][0] or "").strip()):
            return T.StructType([T.StructField(x.strip() if dialect.header and x and x.strip() else f"col{i}", T.StringType()) for i, x in enumerate(found[0], 1)])
        last = first
    return T.StructType()


def csv(spark: SparkSession, path: str, schema: T.StructType | str, dialect: CsvDialect = CsvDialect(), after: Any = None) -> DataFrame:
    """All files below ``path`` with ``_file_time`` and ``_file``; ``after``: only files modified later.

    A short row's missing fields are null, a long row's extra fields are dropped; an unquoted empty field is null as well.
    """
    df = spark.read.options(**dialect.options()).schema(schema).csv(path)
    df = df.select("*", F.col("_metadata.file_modification_time").alias("_file_time"), F.col("_metadata.file_path").alias("_file"))
    return df if after is None else df.where(F.col("_file_time") > F.lit(after))


@dataclass(frozen=True)
class Files:
    """Rows of files with ``_file_time`` and ``_file``, and the files' listing (as of ``files``), by which a run tells new files without opening any."""

    rows: DataFrame
    listing: DataFrame


def csv_files(spark: SparkSession, path: str, schema: T.StructType | str, dialect: CsvDialect = CsvDialect()) -> Files:
    """A folder as of ``csv`` with its listing. The listing is made first, so every file in it is one of those that the rows are read from."""
    listing = files(spark, path)
    return Files(csv(spark, path, schema, dialect), listing)


def documents(df: DataFrame, id_col: str, columns: list[str] | None = None) -> DataFrame:
    """Rows as (``_id``, ``document``): the id as text and the other columns (or ``columns``) as a JSON object."""
    kept = columns or [c for c in df.columns if c != id_col]
    return df.select(F.col(id_col).cast("string").alias("_id"), F.to_json(F.struct(*kept)).alias("document"))


def json_documents(spark: SparkSession, path: str, id_field: str = "_id") -> DataFrame:
    """Files of JSON lines as (``_id``, ``document``)."""
    lines = spark.read.option("recursiveFileLookup", True).text(path)
    return lines.select(F.get_json_object("value", f"$.{id_field}").alias("_id"), F.col("value").alias("document"))


def document_field(column: str, field: str, kind: str) -> Any:
    """A field of a JSON document in a type; null where it is missing, null or of another type."""
    return F.get_json_object(column, f"$.{field}").try_cast(kind)


def document_key(column: str, field: str) -> Any:
    """A field of a JSON document as a number that orders it: itself, or the milliseconds of a time; null if neither."""
    value = F.get_json_object(column, f"$.{field}")
    return F.coalesce(value.try_cast("double"), F.unix_millis(F.try_to_timestamp(value)).cast("double"))


def parsed(column: str) -> Column:
    """A JSON document as a variant, so that all fields of it cost one parse; null where the text isn't JSON."""
    return F.try_parse_json(F.col(column))


def document_value(variant: str, field: str, like: Any) -> Column:
    """A field of a parsed document as a key that is ordered as ``like`` is, null where it is of another kind.

    Whole numbers and decimals are exact (29 digits before the point and 9 behind it), floats are so where ``like`` is one; a time is one that is
    written as text, in UTC.
    """
    value, path = F.col(variant), f"$.{field}"
    kind = F.schema_of_variant(F.try_variant_get(value, path, "variant"))
    if isinstance(like, (int, float, Decimal)):
        return F.when(~kind.isin("STRING", "BOOLEAN"), F.try_variant_get(value, path, "double" if isinstance(like, float) else "decimal(38,9)"))
    at = F.when(kind == "STRING", F.try_variant_get(value, path, "timestamp"))
    return F.to_utc_timestamp(at, F.current_timezone()).cast("timestamp_ntz")


def log_position(events: DataFrame, ts: str) -> DataFrame:
    """The newest time of the operation log, to be kept before a snapshot is taken."""
    return events.agg(F.max(ts).alias("log_ts"))
