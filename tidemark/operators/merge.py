"""Keyed merges of a target with rows or changes, and deletes.

Join strategies are left to the planner: a small change is broadcast and the target isn't shuffled, a large one
is joined by a shuffle on the key. Keys are compared null-safe: rows whose key is null, in the same
places, are one key.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .changes import latest


def _same(keys: list[str]) -> tuple[list[Column], Column]:
    """The key columns of the right side under names of their own, and the null-safe condition of equal keys."""
    return [F.col(f"`{k}`").alias(f"_right_{i}") for i, k in enumerate(keys)], reduce(lambda a, b: a & b, [F.col(f"`{k}`").eqNullSafe(F.col(f"_right_{i}")) for i, k in enumerate(keys)])


def _without(df: DataFrame, other: DataFrame, keys: list[str]) -> DataFrame:
    right, same = _same(keys)
    return df.join(other.select(*right), same, "left_anti")


def upsert(target: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """``target`` with ``rows`` in place of its rows of the same key, and new ones added.

    A key must be unique in ``rows`` (fold changes with ``latest`` first): rows that repeat one all stay.
    """
    return _without(target, rows, keys).unionByName(rows.select(*target.columns))


def apply_changes(target: DataFrame, changes: DataFrame, keys: list[str], order: list[str] | None = None) -> DataFrame:
    """``target`` after the latest change of each key; ``changes`` carry ``_op`` and the order columns.

    Of changes equal in order any one counts. A delete of a key that isn't there changes nothing.
    """
    last = latest(changes, keys, order or ["_ts", "_seq"])
    return _without(target, last, keys).unionByName(last.where("_op <> 'D'").select(*target.columns))


def merge_insert_only(target: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """``target`` and those ``rows`` whose key it doesn't have; rows that repeat a new key all stay."""
    return target.unionByName(_without(rows.select(*target.columns), target, keys))


def replace(target: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """``target`` without the keys of ``rows``, and all ``rows``, repeated keys included."""
    return _without(target, rows, keys).select(*target.columns).unionByName(rows.select(*target.columns))


def merge_update_subset(target: DataFrame, rows: DataFrame, keys: list[str], columns: list[str], defaults: dict | None = None) -> DataFrame:
    """Columns from ``rows`` where they have the key, the others kept; new keys get ``defaults`` (else null).

    A key must be unique in ``rows``. A null value of ``rows`` replaces the target's.
    """
    right, same = _same(keys)
    new = rows.select(*right, *[F.col(f"`{c}`").alias(f"_new_{i}") for i, c in enumerate(columns)], F.lit(True).alias("_there"))
    joined = target.withColumn("_here", F.lit(True)).join(new, same, "full_outer")
    out = []
    for c in target.columns:
        if c in keys:
            out.append(F.when(F.col("_here"), F.col(f"`{c}`")).otherwise(F.col(f"_right_{keys.index(c)}")).alias(c))
        elif c in columns:
            out.append(F.when(F.col("_there"), F.col(f"_new_{columns.index(c)}")).otherwise(F.col(f"`{c}`")).alias(c))
        else:
            out.append(F.when(F.col("_here"), F.col(f"`{c}`")).otherwise(F.lit((defaults or {}).get(c))).alias(c))
    return joined.select(*out)


def delete_missing(target: DataFrame, source_keys: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """(survivors, deleted) by the keys still in the source. An empty source deletes nothing; repeated source keys count once."""
    if source_keys.isEmpty():
        return target, target.where(F.lit(False))
    right, same = _same(keys)
    wanted = source_keys.select(*right)
    return target.join(wanted, same, "left_semi"), target.join(wanted, same, "left_anti")


def soft_delete(target: DataFrame, condition: str) -> DataFrame:
    """``target`` without the rows for which ``condition`` is true; unknown keeps the row."""
    return target.where(~F.coalesce(F.expr(condition), F.lit(False)))
