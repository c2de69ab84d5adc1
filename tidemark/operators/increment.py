"""Reading what changed since a checkpoint.

Bounds are literals, so they reach the scan. The maximum is one small aggregate over the key columns; a table of a
JDBC catalogue answers it itself, Parquet does where ``spark.sql.parquet.aggregatePushdown`` is set and the
V2 reader is used, and all else is scanned.
"""

from __future__ import annotations

import datetime
from typing import Any

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions import any_of


def literal(value: Any, convert: str | None = None) -> Column:
    """A bound as a literal; a time without a zone stays one, so that comparing it needs no cast of the column.

    ``convert``: an SQL expression in which ``$`` stands for a time's text, quoted; it is applied to times alone.
    """
    if convert and isinstance(value, datetime.datetime):
        return F.expr(convert.replace("$", "'" + value.isoformat(sep=" ").replace("'", "''") + "'"))
    if isinstance(value, datetime.datetime) and value.tzinfo is None:
        return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")
    return F.lit(value)


def max_keys(df: DataFrame, keys: list[str], by: str | None = None) -> DataFrame:
    """One row with the greatest value of each key as ``max_<key>``, or one for each value of ``by``."""
    return (df.groupBy(by) if by else df).agg(*[F.max(k).alias(f"max_{k}") for k in keys])


def in_range(lower: dict[str, Any], upper: dict[str, Any] | None = None, include_nulls: bool = False, convert: str | None = None) -> Column:
    """``lower < key <= upper`` for any key; ``upper`` None has no upper end, a null upper gives an empty range."""
    parts = []
    for key, low in lower.items():
        part = F.col(key) > literal(low, convert)
        if upper is not None:
            part = (part & (F.col(key) <= literal(upper[key], convert))) if upper.get(key) is not None else F.lit(False)
        parts.append(part | F.col(key).isNull() if include_nulls else part)
    return any_of(parts)


def read(df: DataFrame, lower: dict[str, Any], conditions: list[str] | None = None, include_nulls: bool = False, compute_max: bool = True, limit: int | None = None, convert: str | None = None) -> tuple[DataFrame, dict[str, Any]]:
    """The rows after the checkpoint ``lower`` and the checkpoint after them.

    ``conditions`` are ORed. With no value above the checkpoint the result is empty and the
    checkpoint stays; a key whose values are all null keeps its own. Rows with a null key are left out unless
    ``include_nulls``; then every read has them again, as nothing tells which were read. Without
    ``compute_max`` there is no upper bound and the checkpoint is to be taken from what was read (``observed``).
    ``limit`` reads about so many rows, key by key: the first rows above a key's checkpoint in its
    order, all ties of the last one included, then those above the next key's while rows are left.
    A key's checkpoint is that of its rows read (``nth`` finds it). ``convert``: see ``literal``.
    """
    if conditions:
        df = df.where(any_of([F.expr(c) for c in conditions]))
    if limit is not None:
        found, upper = _limited(df, {"": lower}, limit, include_nulls, convert)
        return found, upper[""]
    if not compute_max:
        return df.where(in_range(lower, None, include_nulls, convert)), dict(lower)
    found = max_keys(df, list(lower)).first()
    seen = {k: found[f"max_{k}"] for k in lower}
    if all(v is None for v in seen.values()) and not include_nulls:
        return df.where(F.lit(False)), dict(lower)
    return df.where(in_range(lower, seen, include_nulls, convert)), {k: low if seen[k] is None else max(seen[k], low) for k, low in lower.items()}


def nth(df: DataFrame, key: str, n: int, few: int = 100_000, accuracy: int = 10_000) -> tuple[Any, int]:
    """The ``n``-th smallest non-null value of ``key`` (the greatest, if there are fewer) and how many rows have it or a smaller one; (None, 0) without any.

    The range that holds it is narrowed by approximate percentiles whose ranks are then counted, until ``few`` rows are left in it, so no task
    sorts more than that. Each round is two aggregates over the key alone and leaves about 4 / ``accuracy`` of the range;
    a value with very many rows ends it, as its own rank tells.
    """
    rows, before = df.select(F.col(key).alias("k")).where("k IS NOT NULL"), 0
    while True:
        count, low, high = rows.agg(F.count("*"), F.min("k"), F.max("k")).first()
        if not count:
            return None, before
        rank = n - before
        if rank >= count or low == high:
            return high, before + count
        if count <= few:
            value = rows.orderBy("k").limit(rank).agg(F.max("k")).first()[0]
            return value, before + rows.where(F.col("k") <= literal(value)).count()
        shares = [min(1.0, max(0.0, (rank + step * 2 * count / accuracy) / count)) for step in (-1, 1)]
        marks = rows.agg(F.percentile_approx("k", shares, accuracy)).first()[0]
        ranks = rows.agg(*[F.count_if(F.col("k") < literal(m) if strict else F.col("k") <= literal(m)) for m in marks for strict in (True, False)]).first()
        for mark, under, upto in zip(marks, ranks[::2], ranks[1::2], strict=True):
            if under < rank <= upto:
                return mark, before + upto
        # The value lies below, between or above the two marks.
        above = [(m, upto) for m, upto in zip(marks, ranks[1::2], strict=True) if upto < rank]
        below = [m for m, under in zip(marks, ranks[::2], strict=True) if under >= rank]
        if below:
            rows = rows.where(F.col("k") < literal(below[0]))
        if above:
            rows, before = rows.where(F.col("k") > literal(above[-1][0])), before + above[-1][1]


def _limited(df: DataFrame, lower: dict[str, dict[str, Any]], limit: int, include_nulls: bool, convert: str | None) -> tuple[DataFrame, dict[str, dict[str, Any]]]:
    """About ``limit`` rows above the checkpoints of each condition (empty: all rows), condition by condition and key by key."""
    upper, parts, left = {c: dict(low) for c, low in lower.items()}, [], limit
    for condition, keys in lower.items():
        own = F.expr(condition) if condition else F.lit(True)
        for key, low in keys.items():
            if left > 0:
                last, n = nth(df.where(own & (F.col(key) > literal(low, convert))), key, left)
                if n:
                    upper[condition][key] = last
                    parts.append(own & in_range({key: low}, {key: last}, convert=convert))
                    left -= n
            if include_nulls:
                parts.append(own & F.col(key).isNull())
    return df.where(any_of(parts) if parts else F.lit(False)), upper


def read_parts(df: DataFrame, lower: dict[str, dict[str, Any]], include_nulls: bool = False, compute_max: bool = True, limit: int | None = None, convert: str | None = None) -> tuple[DataFrame, dict[str, dict[str, Any]]]:
    """As ``read``, with a checkpoint for each condition: ``lower`` and the result map a condition to its keys and values.

    The maxima of all conditions are one aggregate, the rows one pass: those that any condition has beyond its own checkpoint, each once. So
    a partition that lags behind loses nothing to one that is far ahead.
    """
    if limit is not None:
        return _limited(df, lower, limit, include_nulls, convert)
    upper: dict[str, dict[str, Any]] = {c: dict(low) for c, low in lower.items()}
    if not compute_max:
        return df.where(any_of([F.expr(c) & in_range(low, None, include_nulls, convert) for c, low in lower.items()])), upper
    found = iter(df.agg(*[F.max(F.when(F.expr(c), F.col(k))) for c, low in lower.items() for k in low]).first())
    parts = []
    for c, low in lower.items():
        seen = {k: next(found) for k in low}
        if include_nulls or any(v is not None for v in seen.values()):
            parts.append(F.expr(c) & in_range(low, seen, include_nulls, convert))
        upper[c] = {k: v if seen[k] is None else max(seen[k], v) for k, v in low.items()}
    return df.where(any_of(parts) if parts else F.lit(False)), upper


def observed(df: DataFrame, keys: list[str], name: str = "increment", more: dict[str, Column] | None = None) -> tuple[DataFrame, Observation]:
    """``df`` and an observation of ``records``, ``max_<key>`` and the greatest values of ``more`` that fills while it is written: one pass."""
    seen = Observation(name)
    values = [F.max(k).alias(f"max_{k}") for k in keys] + [F.max(v).alias(k) for k, v in (more or {}).items()]
    return df.observe(seen, F.count(F.lit(1)).alias("records"), *values), seen


def partitioned(df: DataFrame, conditions: list[str]) -> DataFrame:
    """The rows of each condition with its number from 1 in ``part``; a row may be in several."""
    parts = [F.when(F.expr(c), F.lit(i)) for i, c in enumerate(conditions, 1)]
    return df.withColumn("part", F.explode(F.array_compact(F.array(*parts))))


def max_by_condition(df: DataFrame, keys: list[str], conditions: list[str]) -> DataFrame:
    """The greatest keys of every condition, in one pass."""
    return max_keys(partitioned(df, conditions), keys, "part")
