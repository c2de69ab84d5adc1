"""Groups of spelling variants by a variable-length gram index.

A gram dictionary is built from the distinct words: a gram of ``shortest`` code points stands by itself where it is rare and is made
longer where it is frequent, so that no list is long for want of a letter. At each place of a word one gram begins: the shortest one that
isn't frequent, or that ends with the word or with the length limit. A gram hangs on its own letters alone, so an edit affects
just those grams that touch it.

Instead of the greatest number of grams that an edit anywhere can affect, the bound is kept for each of a few windows of a word:
all its grams that do not touch the window are unaffected by an edit inside it, so a near word is in the lists of every one of
them, at the same distance from the start (grams before the window) or from the end (grams behind it). All these lists are merged at once, by
one key made of the unaffected grams. Words that meet there are verified by their edit distance inside the join; only near ones leave it,
each pair from the window of its first differing letter.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def word_counts(docs: DataFrame, id_col: str, text_col: str, least_chars: int, least_count: int, slips: int) -> DataFrame:
    """(word, n) of the distinct words of all texts that are long and frequent enough."""
    # Runs that are too short make no word, and a longer run is never cut by the lower limit.
    runs = F.regexp_extract_all(F.translate(F.col(f"`{text_col}`").cast("string"), _UPPER, _LOWER), F.lit(f"([a-z\\u00C0-\\u00FF]{{{least_chars},}})"), F.lit(1))
    run = docs.select(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).alias("id"), F.explode(runs).alias("run"))
    if slips:
        h, size = F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")), F.char_length("run")
        place = F.pmod(h, size).cast("int")
        short = F.concat(F.substring("run", F.lit(1), place), F.substring("run", place + 2, size))
        run = run.select(F.when(h % slips == 0, short).otherwise(F.col("run")).alias("run")).where(F.char_length("run") >= least_chars)
    return run.groupBy(F.col("run").alias("word")).agg(F.count("*").alias("n")).where(F.col("n") >= least_count)


def frequent_grams(words: DataFrame, shortest: int, longest: int, limit: int, most: int) -> set[str]:
    """The grams of ``shortest`` to ``longest`` - 1 code points that more than ``limit`` places of the words hold.

    The limit rises with the words so that there can be no more than ``most`` of them.
    """
    places = words.agg(F.sum(F.char_length("word"))).first()[0] or 0
    limit = max(limit, -(-places * (longest - shortest) // most))
    sizes = F.sequence(F.lit(shortest), F.lit(longest - 1))
    grams = words.select("word", F.explode(sizes).alias("q")).where("char_length(word) >= q").select(F.explode(F.expr("transform(sequence(1, char_length(word) - q + 1), i -> substring(word, i, q))")).alias("g"))
    return {r.g for r in grams.groupBy("g").agg(F.count("*").alias("n")).where(F.col("n") > limit).collect()}


def gram_ends(word: str, shortest: int, longest: int, frequent: set[str]) -> list[int]:
    """Where the gram ends that begins at each place of a word that has room for one."""
    n, out = len(word), []
    for p in range(n - shortest + 1):
        end, most = p + shortest, min(p + longest, n)
        while end < most and word[p:end] in frequent:
            end += 1
        out.append(end)
    return out


def merged_keys(word: str, extra: tuple[int, ...], windows: int, shortest: int, longest: int, frequent: set[str]) -> list[tuple[int, int, int, int]]:
    """(key, first, last, more) of every window of the words that have ``more`` (of ``extra``) code points more than ``word`` and are near to it.

    The key stands for the unaffected grams: those that end before the window, and those that begin behind it, told by the distance from the end.
    """
    out, ends, used = [], [], 0
    for more in extra:
        size = len(word) + more
        most = max(shortest, min(longest, size // 2))
        if most != used:
            ends, used = gram_ends(word, shortest, most, frequent), most
        for i in range(windows):
            first, last = size * i // windows, size * (i + 1) // windows
            before = max((e for e in ends[:first] if e <= first), default=0)
            after = last - more if last - more < len(ends) else len(word)
            out.append((xxhash.xxh3_64_intdigest(f"{size}:{i}:{word[:before]}:{word[after:]}".encode()) - (1 << 63), first, last, more))
    return out


def near_pairs(words: DataFrame, frequent: set[str], windows: int, shortest: int, longest: int) -> DataFrame:
    """(a, na, b, nb) of all pairs of words that one edit parts, each once; the longer one, or of equal lengths the smaller one, is ``a``."""
    shared = words.sparkSession.sparkContext.broadcast(frequent)

    def keyed(extra: tuple[int, ...]) -> DataFrame:
        def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            frequent = shared.value
            for batch in batches:
                found = [merged_keys(word, extra, windows, shortest, longest, frequent) for word in batch.column(0).to_pylist()]
                flat = [x for rows in found for x in rows]
                at = pa.array([i for i, rows in enumerate(found) for _ in rows], pa.int32())
                numbers = [pa.array([x[j] for x in flat], pa.int32()) for j in (1, 2, 3)]
                yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in flat], pa.int64()), batch.column(0).take(at), batch.column(1).take(at), *numbers], names=["key", "word", "n", "first", "last", "more"])

        return words.select("word", "n").mapInArrow(keys, "key long, word string, n long, first int, last int, more int")

    a = keyed((0,)).select("key", F.col("word").alias("a"), F.col("n").alias("na"), "first", "last")
    b = keyed((0, 1)).select("key", F.col("word").alias("b"), F.col("n").alias("nb"), "more")
    same = (a["key"] == b["key"]) & ((F.col("more") == 1) | (F.col("a") < F.col("b")))
    here = F.expr("left(a, first) = left(b, first) AND left(a, last) <> left(b, last)")
    return a.join(b, same & here & (F.levenshtein("a", "b", 1) == 1)).select("a", "na", "b", "nb")


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_chars: int = 7, least_count: int = 2, times: int = 10, slips: int = 0, windows: int = 4, shortest: int = 2, longest: int = 6, limit: int = 1000, most: int = 100_000) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of all words of at least ``least_chars`` code points and ``least_count`` occurrences.

    Words are maximal runs of ``[A-Za-z\\u00C0-\\u00FF]`` of whole texts, A-Z in lower case. Two words are near if they differ by one inserted,
    deleted or replaced code point. A word's form is its most frequent near word (of equally frequent ones the smallest by code points), if that
    occurs ``times`` times as often or more; its root is the last word that forms lead to. ``slips``: a run whose crc32 of ``<id>:<run>``
    it divides loses a letter (a test of the operator on texts without misspellings; 0: none does).

    Null texts have no words, a null id counts as empty text, rows that repeat count each; without words the result is empty. Other
    columns are ignored. ``least_chars`` is 6 at least, so that grams are left beside every window. The driver and each task hold at most ``most``
    grams; frequent ones are rarer to come by the more words there are. A group of words under one key differs inside a window alone.
    """
    if least_chars < 6:
        raise ValueError("words must have 6 code points at least")
    words = saved(word_counts(docs, id_col, text_col, least_chars, least_count, slips))
    pairs = near_pairs(words, frequent_grams(words, shortest, longest, limit, most), windows, shortest, longest)
    both = pairs.select(F.col("a").alias("word"), F.explode(F.array(F.struct(F.col("a").alias("word"), F.col("b").alias("other"), F.col("nb").alias("m")), F.struct(F.col("b").alias("word"), F.col("a").alias("other"), F.col("na").alias("m")))).alias("p")).select("p.*")
    best = both.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("m")).alias("rank"), "other")).alias("best"))
    found = words.join(best, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.col("best.other").alias("other"), (-F.col("best.rank")).alias("m"))
    far = F.col("m") >= times * F.col("n")
    found = saved(found.select("word", F.when(far, F.col("other")).alias("form"), "n", "n_near", F.when(far, F.col("m")).alias("form_n")))
    # A form is ``times`` times as frequent as its word, so chains are short; each round doubles the steps.
    steps = saved(found.where("form IS NOT NULL").select("word", F.col("form").alias("root")))
    while True:
        on = steps.select(F.col("word").alias("root"), F.col("root").alias("further"))
        longer = saved(steps.join(on, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")))
        steps = longer.select("word", "root")
        if longer.where("moved").isEmpty():
            break
    return found.join(steps, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
