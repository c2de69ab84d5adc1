"""Rows that describe objects: columns, keys, masks, conditions; checks and defaults."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import definition_name, definition_nullable, definition_type, read_type


def parse_columns(specs: DataFrame, column: str = "definition") -> DataFrame:
    """``specs`` with col (upper case), col_type and nullable of each definition."""
    d = F.col(column)
    return specs.withColumns({"col": F.upper(definition_name(d)), "col_type": definition_type(d), "nullable": definition_nullable(d)})


def explode_columns(specs: DataFrame, column: str = "allowed_columns") -> DataFrame:
    """One row per column of the JSON array in ``column``, with its place from 1."""
    out = specs.select("*", F.posexplode(F.from_json(column, "array<string>")).alias("ord", "definition"))
    return parse_columns(out.withColumn("ord", F.col("ord") + 1))


def parse_conditions(specs: DataFrame, column: str) -> DataFrame:
    """One row per condition of the JSON array in ``column``: ``part`` from 1 and ``condition``."""
    out = specs.select("*", F.posexplode(F.from_json(column, "array<string>")).alias("part", "condition"))
    return out.withColumn("part", F.col("part") + 1)


def listed(column: str | Column) -> Column:
    """The trimmed upper-case names of a comma-separated list; empty text has none."""
    col = F.col(column) if isinstance(column, str) else column
    return F.filter(F.transform(F.split(col, ","), lambda x: F.upper(F.trim(x))), lambda x: x != "")


def validate(specs: DataFrame, name: str, columns: str, unique_key: str, masked: str, condition: str, incremental: str | None = None) -> DataFrame:
    """(name, problem) of every broken rule: a key or condition names no column, a masked key, a condition that is no ``col = value``.

    Names are compared without case and blanks. A null list has no rule to break; lists of the job's defaults are not
    checked here, since ``effective`` drops those that don't fit.
    """
    have, keys, hidden, sides = listed(columns), listed(unique_key), listed(masked), F.split(condition, "=")
    rules = {
        "unique_key": F.size(F.array_except(keys, have)) > 0,
        "mask_is_key": F.arrays_overlap(hidden, keys),
        "mask": F.size(F.array_except(hidden, have)) > 0,
        "delete_condition": (F.col(condition) != "") & ((F.size(sides) != 2) | ~F.array_contains(have, F.upper(F.trim(sides[0])))),
    }
    if incremental:
        rules["incremental_key"] = F.size(F.array_except(listed(incremental), have)) > 0
    found = F.array_compact(F.array(*[F.when(rule, F.lit(k)) for k, rule in rules.items()]))
    return specs.select(name, F.explode(found).alias("problem"))


def effective(own: Column, default: str, columns: Column, part: bool = False) -> Column:
    """The object's own list, else the job's default where all of it is among the columns, else empty.

    ``part``: else what of it is among the columns (a default list of masks hides what there is).
    """
    wanted, have = listed(F.lit(default)), listed(columns)
    if part:
        return F.when(own != "", own).otherwise(F.array_join(F.array_intersect(wanted, have), ","))
    return F.when(own != "", own).when(F.size(F.array_except(wanted, have)) == 0, default).otherwise("")


def effective_condition(own: Column, default: str, columns: Column) -> Column:
    """The object's delete condition, else the job's where its column is among the columns, else empty."""
    fits = F.array_contains(listed(columns), F.upper(F.trim(F.split(F.lit(default), "=")[0])))
    return F.when(own != "", own).when(fits, default).otherwise("")


def classify(specs: DataFrame, keys: str, enabled: str, method: str) -> DataFrame:
    """Enabled objects with their ``read_type``."""
    return specs.where(F.col(enabled) == 1).withColumn("read_type", read_type(F.col(keys), F.col(method)))
