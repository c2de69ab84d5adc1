"""Checkpoints, reload flags and the selection of objects for a run."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import FIRST_NUMBER, initial_value


def initial(keys: DataFrame, objects: DataFrame | None = None, iso: bool = False) -> DataFrame:
    """(object, col, value) from (object, col, cls): the checkpoint before the first read, one row per row.

    ``objects`` (object): those without a key get a row with an empty name, which marks whether their snapshot was taken.
    ``iso``: times as files and documents write them.
    """
    out = keys.select("object", "col", initial_value(F.col("cls"), iso).alias("value"))
    if objects is None:
        return out
    bare = objects.select("object").distinct().join(keys.select("object"), "object", "left_anti")
    return out.union(bare.select("object", F.lit(""), F.lit(FIRST_NUMBER)))


def counts(checkpoints: DataFrame, specs: DataFrame, enabled: str = "enabled") -> DataFrame:
    """One row: the number of checkpoints and of enabled objects (a null flag is not enabled)."""
    rows = checkpoints.select(F.lit(True).alias("saved"), F.lit(False).alias("on")).union(specs.select(F.lit(False), F.col(enabled) == 1))
    return rows.agg(F.count_if("saved").alias("checkpoints"), F.count_if("on").alias("enabled_objects"))


def advance(checkpoints: DataFrame, seen: DataFrame) -> DataFrame:
    """``checkpoints`` with the values of ``seen`` (same columns) in place of those of the same object and column.

    Null values and objects without a checkpoint change nothing; ``seen`` has one row for an object and column.
    """
    new = seen.where("value is not null").select("object", "col", F.col("value").alias("_v"))
    return checkpoints.join(new, ["object", "col"], "left").select("object", "col", F.coalesce("_v", "value").alias("value"))


def reset_changed(wanted: DataFrame, checkpoints: DataFrame) -> DataFrame:
    """The checkpoints of the keys now ``wanted`` (object, col, cls): kept where an object's set of keys is unchanged, else initial."""
    a, b = wanted.select("object", "col", "cls"), checkpoints.select("object", "col", "value")
    both = a.join(b, ["object", "col"], "full_outer")
    changed = both.groupBy("object").agg(F.max(F.col("cls").isNull() | F.col("value").isNull()).alias("changed"))
    value = F.when(F.col("changed"), initial_value(F.col("cls"))).otherwise(F.col("value"))
    return both.where("cls is not null").join(changed, "object").select("object", "col", value.alias("value"))


def reload_plan(objects: DataFrame, flags: DataFrame, name: str = "object") -> DataFrame:
    """What to reload at this start and the flags for the next one: "next" flags clear themselves, "each" flags stay.

    ``flags``: name, schema_next, schema_each, object_next, object_each (0 or 1).
    """
    joined = objects.select(name).join(flags, name, "left")
    on = lambda a, b: F.coalesce((F.col(a) == 1) | (F.col(b) == 1), F.lit(False))
    return joined.select(name, on("schema_next", "schema_each").alias("reload_schema"), on("object_next", "object_each").alias("reload_object"), F.coalesce("schema_each", F.lit(0)).alias("next_schema_each"), F.coalesce("object_each", F.lit(0)).alias("next_object_each"))


def next_flags(flags: DataFrame, name: str = "object") -> DataFrame:
    """The flags for the start after this one: "next" flags are cleared."""
    return flags.select(name, F.lit(0).alias("schema_next"), "schema_each", F.lit(0).alias("object_next"), "object_each")


def group_order(objects: DataFrame, group: str, position: str, ok: str) -> DataFrame:
    """The objects of each group that are attempted in order of position: up to and with the first failure."""
    stop = objects.where(~F.col(ok)).groupBy(group).agg(F.min(position).alias("_stop"))
    return objects.join(stop, group, "left").where(F.col("_stop").isNull() | (F.col(position) <= F.col("_stop"))).drop("_stop")


def reset(checkpoints: DataFrame, objects: list[str]) -> DataFrame:
    """``checkpoints`` without those of ``objects``, which are read whole next time."""
    return checkpoints.where(~F.col("object").isin(*objects)) if objects else checkpoints
