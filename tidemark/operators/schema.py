"""Schema drift: differences of declared columns and moving a table to a new schema."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import same_definition


def schema_diff(old: DataFrame, new: DataFrame, by: list[str] | None = None) -> DataFrame:
    """(by..., action, col, def) from (by..., col, def): ADD, ALTER or DROP; names without case, definitions without blanks and case."""
    by = by or []
    a = old.select(*by, F.upper("col").alias("_k"), F.col("col").alias("_old"), F.col("def").alias("_was"))
    b = new.select(*by, F.upper("col").alias("_k"), "col", "def")
    both = a.join(b, [*by, "_k"], "full_outer")
    action = F.when(F.col("_old").isNull(), "ADD").when(F.col("col").isNull(), "DROP").when(~same_definition(F.col("_was"), F.col("def")), "ALTER")
    return both.withColumn("action", action).where("action is not null").select(*by, "action", F.coalesce("col", "_old").alias("col"), "def")


def evolve(df: DataFrame, schema: T.StructType | str) -> DataFrame:
    """``df`` in the order and types of ``schema``: new columns null, missing ones dropped; names without case. Applying it again changes nothing."""
    schema = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    have = {c.lower(): c for c in df.columns}
    return df.select(*[(F.col(f"`{have[f.name.lower()]}`") if f.name.lower() in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields])


def definitions(df: DataFrame) -> list[tuple[str, str]]:
    """(col, def) of a DataFrame's columns."""
    return [(f.name, f"{f.dataType.simpleString().upper()}{'' if f.nullable else ' NOT'} NULL") for f in df.schema.fields]
