"""Substring joins without a nested loop."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import checkpointed, dealt

#: Characters of an index gram.  Patterns that are shorter are their own key.
GRAM = 4
#: Grams or patterns that are broadcast at once.
BLOCK = 200_000


def _places(texts: DataFrame, text_col: str, size: int) -> DataFrame:
    """Every place of every text with the hash of the ``size`` characters there:
    the texts' columns, __code (the text in four bytes a character, where any
    character is found at once), __at (from 0) and __gram."""
    coded = texts.withColumn("__code", F.encode(F.col(text_col), "UTF-32"))
    last = (F.octet_length("__code") / 4).cast("int") - size
    at = coded.select("*", F.explode_outer(F.when(last >= 0, F.sequence(F.lit(0), last))).alias("__at"))
    return at.withColumn("__gram", F.when(F.col("__at").isNotNull(), F.xxhash64(_code("__at", F.lit(size)))))


def _code(at, length):
    """``length`` characters of __code from place ``at``."""
    return F.substring("__code", F.lit(1) + F.lit(4) * F.col(at), F.lit(4) * length)


def pattern_hits(texts: DataFrame, patterns: DataFrame, text_col: str, pattern_col: str, gram: int = GRAM,
                 block: int = BLOCK) -> DataFrame:
    """The rows of ``texts`` with each distinct pattern that the text contains,
    one row per (text row, pattern), the pattern under its own name.

    Every pattern is looked for by the one of its grams of ``gram`` characters
    that is rarest *in the texts*, counted in a first pass; a pattern with a
    gram that no text holds is out.  In the second pass a place of that gram
    gives the place where the pattern would start, and is a hit if the text's
    first occurrence of the pattern is there.  Both passes filter grams where
    the text is read, by a broadcast table of the patterns' grams, so only
    counts and hits are ever shuffled: a pattern all of whose grams are
    frequent costs a comparison for each place of the rarest, not a shuffled
    candidate.

    The texts are dealt over all tasks and written to the checkpoint folder once.
    The first pass is one however many patterns there are: if their distinct
    grams are more than ``block``, the counts of all grams of the texts, added up
    where they are read, are joined to them instead.  The second pass takes the
    patterns that are left, dealt by hash into blocks of ``block`` or so.

    Null and empty patterns match nothing, null texts neither.
    """
    pats = patterns.select(F.col(pattern_col).alias("__p")).filter(F.length("__p") > 0).distinct()
    pats = checkpointed(pats.withColumn("__size", F.least(F.length("__p"), F.lit(gram))))
    sizes = [r["__size"] for r in pats.select("__size").distinct().collect()]  # ``gram`` rows at most
    texts = checkpointed(dealt(texts)) if sizes else texts
    found = None
    for size in sorted(sizes):
        keys = _places(pats.filter(F.col("__size") == size).drop("__size"), "__p", size).withColumnsRenamed({"__at": "__from", "__code": "__want"})
        grams = checkpointed(keys.select("__gram").distinct())
        places = _places(texts.select(text_col), text_col, size).select("__gram")
        few = grams.count() <= block
        counts = (places.join(F.broadcast(grams), "__gram") if few else places).groupBy("__gram").agg(F.count(F.lit(1)).alias("__n"))
        rare = keys.join(counts, "__gram", "left").groupBy("__p").agg(
            F.min(F.struct(F.coalesce("__n", F.lit(0)).alias("n"), "__gram", "__from", "__want")).alias("__k"))
        index = checkpointed(rare.filter(F.col("__k.n") > 0).select("__p", "__k.*").drop("n"))
        blocks = -(-index.count() // block)
        for i in range(blocks):
            own = index.filter(F.pmod(F.xxhash64("__p"), F.lit(blocks)) == i)
            here = _places(texts, text_col, size).join(F.broadcast(own), "__gram")
            here = here.withColumn("__start", F.col("__at") - F.col("__from")).filter(F.col("__start") >= 0)
            same = _code("__start", F.length("__p")) == F.col("__want")
            first = F.instr(F.col(text_col), F.col("__p")) == F.col("__start") + 1
            hits = here.filter(F.when(same, first).otherwise(False))
            hits = hits.select(*texts.columns, F.col("__p").alias(pattern_col))
            found = hits if found is None else found.unionByName(hits)
    if found is None:
        found = texts.select("*", F.lit(None).cast("string").alias(pattern_col)).filter(F.lit(False))
    return found


def contains_pairs(texts: DataFrame, patterns: DataFrame, text_col: str, pattern_col: str) -> DataFrame:
    """Distinct (text, pattern) with the text containing the pattern, under the
    two given names (see :func:`pattern_hits`)."""
    return pattern_hits(texts.select(text_col), patterns, text_col, pattern_col).distinct()
