"""Exact duplicates by skew-safe combining.

Copies are folded inside each map task first, then in groups of (digest, content, salt), then the
winners of the salts are folded by (digest, content). Content takes part in the grouping at every
stage; the digest only spreads the rows. Only digests that hold at least one in ``share`` of all
rows are salted, so at most ``share`` of them exist and their list may be broadcast.

The group table holds no text. A row finds its group by digest; should one digest ever
stand for two contents, the rows of that digest find theirs by full content.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import saved

#: The characters that do not count when texts are compared: space and U+0009 to U+000D.
BLANKS = (" ", "\t", "\n", "\x0b", "\x0c", "\r")
_RANGE = 2**65


def normalised(text: Column) -> Column:
    return reduce(lambda c, x: F.replace(c, F.lit(x), F.lit("")), BLANKS, F.coalesce(text.cast("string"), F.lit("")))


def _whole(number: int) -> Column:
    return F.lit(str(number)).cast(f"decimal({len(str(number))},0)")


def _rank(length: Column, doc_id: Column) -> Column:
    """A number that is smallest for the longest text, then the smallest id; null ids come last."""
    place = F.coalesce((doc_id.cast("decimal(20,0)") + _whole(2**63)).cast("decimal(21,0)"), _whole(2**64).cast("decimal(21,0)"))
    ahead = (_whole(2**31).cast("decimal(11,0)") - length.cast("decimal(11,0)")).cast("decimal(11,0)")
    return (ahead * _whole(_RANGE) + place).cast("decimal(38,0)")


def _ranked_id(rank: Column) -> Column:
    place = (rank % _whole(_RANGE)).cast("decimal(21,0)")
    return F.when(place < _whole(2**64), (place - _whole(2**63)).cast("long"))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", share: int = 10_000, salts: int = 32, digest=None) -> DataFrame:
    """One row per document, dropped ones too: id, keep_id, group_size, kept, text_sha256.

    Ids are whole numbers (or cast to them; others fail the job).
    Texts are equal when identical without the characters of ``BLANKS``; null counts as empty. Of a
    group the row with the most code points in its original text stays, then the smallest id;
    null ids come last, and a kept row with a null id has a null keep_id. Rows that repeat an
    id in one group with the same text are all kept. Other columns are ignored. An empty
    table gives an empty result. ``digest``: another digest of a column (tests only).
    """
    digest = digest or (lambda c: F.unhex(F.sha2(c.cast("binary"), 256)))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    rows = rows.select("id", F.char_length("text").alias("len"), normalised(F.col("text")).alias("content")).withColumn("digest", digest(F.col("content")))
    light = saved(rows.select("id", "len", "digest"))
    total = light.count()
    frequent = light.groupBy("digest").agg(F.count("*").alias("c")).where(F.col("c") >= max(1000, -(-total // share))).select("digest", F.lit(salts).alias("salts"))
    salted = rows.join(F.broadcast(frequent), "digest", "left").withColumn("salt", F.coalesce(F.pmod(F.xxhash64("id"), F.col("salts")), F.lit(0))).withColumn("hot", F.col("salts").isNotNull())
    merged = salted.groupBy("digest", "content", "hot", "salt").agg(F.min(_rank(F.col("len"), F.col("id"))).alias("rank"), F.count("*").alias("n"))
    # Content travels on where salts are still to be combined; elsewhere each row is a whole group.
    groups = merged.groupBy("digest", F.when(F.col("hot"), F.col("content")).alias("content")).agg(F.min("rank").alias("rank"), F.sum("n").alias("n"), F.count(F.when(~F.col("hot"), 1)).alias("contents"))
    groups = saved(groups.groupBy("digest").agg(F.min("rank").alias("rank"), F.sum("n").alias("n"), (F.sum("contents") + F.count("content")).alias("contents")))
    known = groups.where("contents = 1").select("digest", F.col("rank").alias("rank"), "n")
    found = light.join(known, "digest").select("id", "len", "digest", "rank", "n")
    clash = groups.where("contents > 1").select("digest")
    if not clash.isEmpty():
        apart = rows.join(clash, "digest")
        sizes = apart.groupBy("digest", "content").agg(F.min(_rank(F.col("len"), F.col("id"))).alias("rank"), F.count("*").alias("n"))
        found = found.union(apart.join(sizes, ["digest", "content"]).select("id", "len", F.unhex(F.sha2(F.col("content").cast("binary"), 256)), "rank", "n"))
    keep = F.col("rank") == _rank(F.col("len"), F.col("id"))
    return found.select(F.col("id").alias(id_col), _ranked_id(F.col("rank")).alias("keep_id"), F.col("n").cast("long").alias("group_size"), keep.alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"))
