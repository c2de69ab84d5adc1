"""Mixing sources to target weights by systematic sampling.

Inside its source every document has the same expected number of copies, target / source size.
The prefix sum of these, plus one offset per source, is cut at whole numbers: a document is
emitted once for each boundary its step crosses. Documents are laid out by size, so that
neighbours weigh about the same and the words taken come near the target.

The prefix sum is distributed: rows are dealt by ranges of (source, size, id), numbered inside
each partition, and shifted by the counts of the partitions before.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import saved


def word_count(text: Column) -> Column:
    """The number of runs of characters outside ``[\\x20\\x09-\\x0D]``; null: 0."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[float, ...] = (1, 2, 3), most: int = 3) -> DataFrame:
    """(source, source_size, target) from (source, source_size): one row per source, all in one task.

    So sources are to be such that a task can sort one small row for each: some ten million, say web domains, but not URLs.

    Sources take the weights in turn by code point, null last. A target stops at ``most`` times its
    source's size; the excess goes to the others by weight. The level is found in
    one pass: sources by capacity per weight, those below the level are full.
    """
    ranked = sizes.withColumn("place", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.col("place") - 1) % len(weights) + 1).cast("int"))
    ranked = ranked.withColumn("weight", weight).withColumn("cap", F.col("source_size") * most)
    order = Window.orderBy(F.col("cap") / F.col("weight"), "place")
    every = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    after = F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    level = ranked.withColumn("level", (F.sum("source_size").over(every) - before) / after).withColumn("open", F.col("level") <= F.col("cap") / F.col("weight"))
    level = level.withColumn("at", F.min(F.when(F.col("open"), F.struct(F.col("cap") / F.col("weight"), F.col("place"), F.col("level")))).over(every)["level"])
    return level.select("source", "source_size", F.least(F.col("cap").cast("double"), F.coalesce("at", F.lit(0.0)) * F.col("weight")).alias("target"))


def offset(source: Column, seed: str) -> Column:
    """A number in [0, 1) that depends on the source and the seed alone."""
    text = F.concat(F.lit(seed), F.coalesce(F.concat(F.lit(":"), source.cast("string")), F.lit("")))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("double") / F.lit(float(2**32))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[float, ...] = (1, 2, 3), most: int = 3, seed: str = "mix", partitions: int | None = None) -> DataFrame:
    """One row per document: id, size, source, source_size, target, copies, taken.

    ``size`` is the number of words (0 for a null text); a null source is a source of its own, null ids come
    first. A source without words has target 0 and is not taken. Rows that repeat id and
    size are interchangeable. Other columns are ignored. An empty table gives an empty
    result. Reruns over the same rows agree.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"))
    rows = saved(rows)
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("source").asc_nulls_last(), F.col("size"), F.col("id")]
    placed = rows.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id())
    placed = saved(placed.select("id", "source", "size", F.shiftright("at", 33).alias("part"), "at"))
    counts = placed.groupBy("source", "part").agg(F.count("*").alias("n"), F.min("at").alias("first"), F.sum("size").alias("words"))
    shift = F.coalesce(F.sum("n").over(Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counts = saved(counts.withColumn("shift", F.col("first") - shift))
    goals = targets(counts.groupBy("source").agg(F.sum("words").alias("source_size")), weights, most)
    same = lambda a, b: a.eqNullSafe(b)
    goals = goals.withColumn("rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))).withColumn("offset", offset(F.col("source"), seed))
    steps = counts.select(F.col("source").alias("s"), F.col("part").alias("p"), "shift").alias("c").join(goals.withColumnRenamed("source", "t"), same(F.col("s"), F.col("t")))
    # At most one row for each source and one more for each partition.
    out = placed.join(steps, same(F.col("source"), F.col("s")) & (F.col("part") == F.col("p")))
    i = (F.col("at") - F.col("shift")).cast("double")
    copies = (F.floor(F.col("rate") * (i + 1) + F.col("offset")) - F.floor(F.col("rate") * i + F.col("offset"))).cast("long")
    out = out.withColumn("copies", F.least(copies, F.lit(most).cast("long")))
    return out.select(F.col("id").alias(id_col), "size", F.col("source").alias(source_col), "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))
