"""Benchmark decontamination (operator 11) [native]: a prefix-filtered set join
of benchmark windows against documents, in DataFrame functions only.

A word is a run of characters other than the ASCII ones that are no digit or
letter, A-Z lower-cased.  A window is ``window`` consecutive words of an item;
an item of fewer words is one window.  Seen as a set of shingles (``shingle``
consecutive words, or all words of a shorter window), a window occurs only
where all its shingles do.  So at full containment one prefix token suffices:

1. every shingle of the items is counted in all documents;
2. a window with a shingle that no document holds is out; the others are
   looked for by their rarest shingle only (ties: the smaller hash);
3. a place of that shingle gives the window's start; starts before the text
   or windows beyond its end are out (positional and length bounds);
4. the words at the place must be the window's, compared by SHA-256.

Steps 1 and 4 run where the document's words are: nothing but counts and
verified hits is shuffled.  What is broadcast are windows (fixed 120 bytes
each: hash, offset, length, digest), ``BLOCK`` at most by a count; more
windows are dealt into blocks by hash, each against all documents.

Null text, or text without a word: no words, no hit.  Items without a word
have no window.  Null document id: kept.  Rows that repeat id and text give as
many equal rows.  Items that repeat an id count once; items without an id count
as one item with an empty name.  Empty documents: empty result; empty
benchmark: no document is hit.  A very long text is handled whole in its row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

WINDOW, SHINGLE = 10, 3
#: Windows (or shingles to count) that are broadcast at once.
BLOCK = 100_000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: The hash that stands for a document itself, so that each gives one row.
_SELF = 0


def words(text: Column) -> Column:
    """Words of a text; an empty array for null.  Texts without multi-byte
    characters take the faster lower-casing, which is the same for them."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    low = F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))
    return F.array_remove(F.split(low, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), "")


def _shingle(w: Column, at: Column, size: int) -> Column:
    return F.xxhash64(*[F.get(w, at + k) for k in range(size)])


def item_windows(items: DataFrame, id_col: str, text_col: str, window: int, shingle: int) -> DataFrame:
    """(item, digest, n, keys): every window of every item, its shingles in order."""
    w = items.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item"), words(F.col(text_col)).alias("w"))
    w = w.where(F.size("w") > 0).withColumn("n", F.least(F.size("w"), F.lit(window)))
    w = w.select("item", "n", F.explode(F.transform(F.sequence(F.lit(1), F.size("w") - F.col("n") + 1),
                                                    lambda k: F.slice("w", k, F.col("n")))).alias("part"))

    def of(q: int) -> Column:
        every = F.transform(F.sequence(F.lit(0), F.col("n") - q), lambda k: _shingle(F.col("part"), k, q))
        return F.when(F.least(F.col("n"), F.lit(shingle)) == q, every)

    sizes = [of(q) for q in range(1, shingle + 1)]
    return w.select("item", "n", F.sha2(F.array_join("part", " "), 256).alias("digest"), F.coalesce(*sizes).alias("keys"))


def places(docs: DataFrame, sizes: list[int], own: bool) -> DataFrame:
    """Every place of every document with the hash of the shingle there; with
    ``own``, also one place after the last word for the document itself.  The
    words come along by reference: a row is built only for places that match."""
    last = F.size("w") - (0 if own else 1)
    at = docs.select("*", F.explode_outer(F.when(last >= 0, F.sequence(F.lit(0), last))).alias("at"))
    keys = [F.when(F.col("at") + q <= F.size("w"), _shingle(F.col("w"), F.col("at"), q)) for q in sizes]
    if own:
        keys[0] = F.when(F.col("at") == F.size("w"), F.lit(_SELF).cast("long")).otherwise(keys[0])
    if len(keys) == 1:
        return at.withColumn("key", keys[0])
    return at.select("*", F.explode_outer(F.array(*keys)).alias("key"))


def _blocks(table: DataFrame, by: str, block: int) -> list[DataFrame]:
    n = max(1, -(-table.count() // block))
    return [table.where(F.pmod(F.xxhash64(by), F.lit(n)) == k) for k in range(n)]


def find_windows(docs: DataFrame, windows: DataFrame, window: int, shingle: int, block: int) -> DataFrame:
    """(doc, text_key, n_words, start, n, digest) for every place of a window,
    and one row with null start for every document."""
    short = [r.q for r in windows.select(F.least("n", F.lit(shingle)).alias("q")).distinct().collect()]  # at most ``shingle`` rows
    sizes = sorted(short, reverse=True) or [shingle]
    distinct = stored(windows.select("digest", "n", "keys").distinct(), "windows")
    keys = stored(distinct.select(F.explode("keys").alias("key")).distinct(), "shingles")
    counts = None
    for part in _blocks(keys, "key", block):
        seen = places(docs, sizes, False).join(F.broadcast(part), "key").groupBy("key").agg(F.count(F.lit(1)).alias("places"))
        counts = seen if counts is None else counts.unionByName(seen)
    counts = stored(counts, "shingle-counts")
    each = distinct.select("digest", "n", F.posexplode("keys").alias("offset", "key")).join(counts, "key", "left")
    rarest = each.groupBy("digest", "n").agg(
        F.min(F.struct(F.coalesce("places", F.lit(0)).alias("places"), "key", "offset")).alias("first"))
    prefix = stored(rarest.where("first.places > 0").select(F.col("first.key").alias("key"), F.col("first.offset").alias("offset"),
                                                            "n", "digest"), "prefixes")
    own = prefix.sparkSession.createDataFrame([(_SELF,)], "key long").selectExpr(
        "key", "cast(null as int) as offset", "cast(null as int) as n", "cast(null as string) as digest")
    found = None
    for k, part in enumerate(_blocks(prefix, "digest", block)):
        at = places(docs, sizes, k == 0).join(F.broadcast(part.unionByName(own) if k == 0 else part), "key")
        start = F.col("at") - F.col("offset")
        fits = (start >= 0) & (start + F.col("n") <= F.size("w"))
        same = F.sha2(F.array_join(F.slice("w", start + 1, F.col("n")), " "), 256) == F.col("digest")
        itself = F.col("n").isNull() & (F.col("at") == F.size("w"))
        at = at.where(F.when(F.col("n").isNull(), itself).when(fits, same).otherwise(False))
        at = at.select("doc", "text_key", F.size("w").cast("long").alias("n_words"), start.alias("start"), "n", "digest")
        found = at if found is None else found.unionByName(at)
    return found


def decontaminate(df: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id",
                  item_text: str = "text", window: int = WINDOW, shingle: int = SHINGLE, block: int = BLOCK) -> DataFrame:
    """One row per document: the id column, n_words, n_hit, hits (merged
    [start, end) intervals of words), items (sorted ids of the items that occur),
    n_items, contaminated."""
    if not 0 < shingle <= window:
        raise ValueError("shingle must be from 1 to window")
    docs = df.select(F.col(id_col).alias("doc"), F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit(""))).alias("text_key"),
                     words(F.col(text_col)).alias("w"))
    windows = stored(item_windows(items, item_id, item_text, window, shingle), "item-windows")
    found = find_windows(docs, windows, window, shingle, block)
    each = found.groupBy("doc", "text_key", "n_words").agg(
        F.count_if(F.col("n").isNull()).cast("int").alias("copies"),
        F.collect_set(F.when(F.col("n").isNotNull(), F.struct("start", (F.col("start") + F.col("n")).alias("end")))).alias("spots"),
        F.array_sort(F.collect_set("digest")).alias("digests"))
    # documents with the same windows have the same items: each such set is looked up once
    each = stored(each.withColumn("set", F.when(F.size("digests") > 0, F.sha2(F.array_join("digests", ""), 256))), "hit-documents")
    named = (each.where("set is not null").groupBy("set").agg(F.first("digests").alias("digests"))
             .select("set", F.explode("digests").alias("digest")).join(windows.select("digest", "item").distinct(), "digest")
             .groupBy("set").agg(F.array_sort(F.collect_set("item")).alias("items")))
    # a clean document meets nothing: a key of its own keeps the nulls apart
    key = F.coalesce("set", F.concat(F.lit("-"), F.xxhash64("doc", "text_key").cast("string")))
    each = each.withColumn("set", key).join(named, "set", "left")
    merged = F.aggregate(F.array_sort("spots"), F.array().cast("array<struct<start:int,end:int>>"), _merge)
    out = each.select(F.col("doc").alias(id_col), "n_words", "copies", merged.alias("hits"), F.coalesce("items", F.array()).alias("items"))
    out = out.withColumn("n_hit", F.aggregate("hits", F.lit(0).cast("long"), lambda s, x: s + (x["end"] - x["start"])))
    return (out.withColumn("copy", F.explode(F.sequence(F.lit(1), "copies")))
            .select(id_col, "n_words", "n_hit", "hits", "items", F.size("items").cast("long").alias("n_items"),
                    (F.col("n_hit") > 0).alias("contaminated")))


def _merge(done: Column, spot: Column) -> Column:
    """Add an interval to sorted, disjoint ones."""
    last = F.element_at(done, -1)
    joined = F.struct(last["start"].alias("start"), F.greatest(last["end"], spot["end"]).alias("end"))
    touches = (F.size(done) > 0) & (F.when(F.size(done) > 0, last["end"]) >= spot["start"])
    return F.when(touches, F.concat(F.slice(done, 1, F.size(done) - 1), F.array(joined))).otherwise(F.concat(done, F.array(spot)))


def digest(df: DataFrame, items: DataFrame) -> DataFrame:
    """The contract's columns of query op11."""
    return decontaminate(df, items).select(
        "doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


#: Windows as text, met with every run of as many words of a document.
SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
i AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, n, array_to_string(w[k:k + n - 1], ' ') AS t
  FROM (SELECT item_id, w, n, unnest(range(1, len(w) - n + 2)) AS k
        FROM (SELECT item_id, w, least(len(w), 10) AS n FROM i WHERE len(w) > 0))),
spots AS (
  SELECT doc_id, k, n, array_to_string(w[k:k + n - 1], ' ') AS t
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS k
        FROM d, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n)),
hits AS (SELECT doc_id, k, n, item_id FROM spots JOIN windows USING (n, t)),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(k, k + n)) AS p FROM hits) GROUP BY 1),
named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, coalesce(item_id::VARCHAR, '') AS item FROM hits) GROUP BY 1)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)
"""
