"""MinHash near-deduplication with odd sketches (operator 8).

A document's set: the distinct shingles of ``words`` consecutive words
(A-Z lower-cased, words split at ``[\\x20\\x09-\\x0D]``); with fewer words the
whole sequence as one; none without words.  Documents are linked when
100 * |intersection| >= 100 * similarity * |union|; groups are the connected
components of all links.

1. ``signatures``: 128 MinHash values of each set, kept as 32 band keys of four
   values, and an odd sketch: the values folded into a 512-bit map in which
   each toggles one bit, so that the XOR of two sketches counts the values
   that differ (Mitzenmacher, Pagh, Pham, 2014).  A pair of similarity 0.8
   shares no band with a probability of 5e-8.
2. ``classes``: documents with equal sets are one class; copies cost one row a
   scan task from here on.
3. Bands with at least two classes are buckets.  Each bucket's classes are
   compared with one pivot, not with each other; ``PIVOTS`` orders are used.
4. A pair is dropped if its sizes or its sketches (at 6 standard deviations)
   rule out the similarity; the rest is confirmed on the full sets.
5. Buckets whose classes are not all connected by now are settled exactly.
   Each class outside a bucket's largest component is compared on the full
   sets with all members of that component and with all other classes that
   ask for it, block against block, so that no pairs are made.  So buckets
   have no cap, and no link between components is lost.

Null, empty or blank text: an empty set, linked with nothing.  Equal non-empty
sets are linked.  Null id: after every other id (its group's id is null only if
all its ids are).  Rows that repeat id and text are in one group.  Empty table:
empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import hashing as H
from .common import map_slices, one_of_each, passing, raw, real_id, slot_filter, stored, text_key, whole_id, whole_text
from .components import components

WORDS, SIMILARITY = 5, 0.8
BANDS, ROWS = 32, 4
SKETCH_BITS = 512
#: Orders by which buckets choose their pivots, so that a class which misses
#: one pivot of its group meets others.
PIVOTS = 8
#: Standard deviations by which a sketch must miss the similarity.
SIGMAS = 6
U = np.uint64
_A = H.mix(np.arange(1, BANDS * ROWS + 1, dtype=U) * U(0x9FB21C651E98DF25)) | U(1)
_B = H.mix(np.arange(1, BANDS * ROWS + 1, dtype=U) * U(0xD6E8FEB86659FD93))


def shingle_sets(part: pa.RecordBatch, words: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, bounds): each text's distinct shingles, ascending."""
    data, off = raw(part.column("body"))
    starts, ends, bounds = H.spans(data, off, H.WHITE)
    h = H.range_hashes(data, starts, ends, H.LOWER)
    w = H.window_hashes(h, words)
    sets = []
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        if b - a >= words:
            sets.append(np.unique(w[a:b - words + 1]))
        elif b > a:
            sets.append(H.mix(H.window_hashes(h[a:b], int(b - a)) + U(b - a)))
        else:
            sets.append(h[:0])
    sizes = np.array([0] + [s.size for s in sets])
    return (np.concatenate(sets) if sets else h[:0]), np.cumsum(sizes)


def min_hashes(h: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """(sets, 128) smallest values; sets must not be empty."""
    out = np.empty((bounds.size - 1, BANDS * ROWS), U)
    step = np.empty_like(h)
    for j in range(BANDS * ROWS):
        np.multiply(h, _A[j], out=step)
        np.add(step, _B[j], out=step)
        out[:, j] = np.minimum.reduceat(step, bounds[:-1])
    return out


def odd_sketches(low: np.ndarray) -> np.ndarray:
    """(sets, words of 64 bits): parity of the values that fall on each bit."""
    n = low.shape[0]
    bit = (H.mix(low ^ _A) & U(SKETCH_BITS - 1)).astype(np.int64)
    count = np.bincount((bit + np.arange(n)[:, None] * SKETCH_BITS).ravel(), minlength=n * SKETCH_BITS)
    return np.packbits((count & 1).astype(np.uint8)).view(np.int64).reshape(n, SKETCH_BITS // 64)


def band_keys(low: np.ndarray) -> np.ndarray:
    keys = np.broadcast_to(np.arange(1, BANDS + 1, dtype=U), (low.shape[0], BANDS)).copy()
    for r in range(ROWS):
        keys = H.mix(keys * H.BASE ^ low[:, r::ROWS])
    return keys.view(np.int64)


def sketch_limit(similarity: float) -> int:
    """Bits in which the sketches of a pair of at least this similarity differ
    at most, but for ``SIGMAS`` deviations: those of the sampled values and of
    where they fall."""
    k, n = BANDS * ROWS, SKETCH_BITS
    m = 2 * k * (1 - similarity)  # toggles that differ
    mean = n * (1 - (1 - 2 / n) ** m) / 2
    slope = 2 * (1 - 2 / n) ** m  # bits for each value that differs
    fall = n / 4 * (1 - (1 - 4 / n) ** m) + n * n / 4 * ((1 - 4 / n) ** m - (1 - 2 / n) ** (2 * m))
    return math.ceil(mean + SIGMAS * math.sqrt(slope**2 * k * similarity * (1 - similarity) + fall))


def estimate(differ: int) -> float:
    """Similarity that the number of differing sketch bits suggests."""
    if 2 * differ >= SKETCH_BITS:
        return 0.0
    return max(0.0, 1 + SKETCH_BITS / (4 * BANDS * ROWS) * math.log(1 - 2 * differ / SKETCH_BITS))


def signatures(docs: DataFrame, words: int) -> DataFrame:
    """(id, text_key, n, set_a, set_b, bands, sketch); set_a and set_b name
    the set, whatever the order of its words.  No bands for empty sets."""
    def rows(part):
        h, bounds = shingle_sets(part, words)
        n = np.diff(bounds)
        some = np.flatnonzero(n)
        sums = [np.zeros(n.size, U), np.zeros(n.size, U)]
        bands, sketch = [None] * n.size, [None] * n.size
        if some.size:
            edge = bounds[:-1][some]
            sums[0][some] = np.add.reduceat(h, edge)
            sums[1][some] = np.add.reduceat(H.mix(h ^ H.BASE), edge)
            low = min_hashes(h, np.append(edge, h.size))
            for i, b, s in zip(some, band_keys(low), odd_sketches(low), strict=True):
                bands[i], sketch[i] = b, s
        return {"id": part.column("id"), "text_key": part.column("text_key"), "n": n,
                "set_a": sums[0].view(np.int64), "set_b": sums[1].view(np.int64), "bands": bands, "sketch": sketch}

    return map_slices(docs, rows, "id long, text_key long, n long, set_a long, set_b long, bands array<long>, sketch array<long>")


def full_sets(docs: DataFrame, slots, words: int) -> DataFrame:
    def rows(part):
        h, bounds = shingle_sets(part, words)
        return {"id": part.column("id"), "text_key": part.column("text_key"),
                "shingles": [h[a:b].view(np.int64) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]}

    return map_slices(docs, rows, "id long, text_key long, shingles array<long>", slots=slots)


def _possible(similarity: float):
    """Neither sizes nor sketches rule out the pair (x, y)."""
    bits = " + ".join(f"bit_count(x.sketch[{i}] ^ y.sketch[{i}])" for i in range(SKETCH_BITS // 64))
    percent = round(100 * similarity)
    return f"100 * least(x.n, y.n) >= {percent} * greatest(x.n, y.n) and {bits} <= {sketch_limit(similarity)}"


def confirm(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    both = (pairs.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("s")), "a")
            .join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("t")), "b")
            .select("a", "b", F.size(F.array_intersect("s", "t")).cast("long").alias("both"),
                    (F.size("s") + F.size("t")).cast("long").alias("sizes")))
    return both.where(f"100 * both >= {round(100 * similarity)} * (sizes - both)").select("a", "b")


#: Shingles of a block.
BLOCK = 1 << 18


def block_links(askers: DataFrame, others: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Links (a, b) between the roots of askers (node, n, root, hub) and of the
    others of their hub (same columns).

    Both sides of a hub are dealt into blocks of about ``BLOCK`` shingles; each
    task compares one block of askers with one block of others on their full
    sets and returns links that connect what isn't connected yet in the task,
    so neither pairs nor unbounded groups are made."""
    def blocks(rows, as_):
        return rows.groupBy("hub").agg(F.ceil(F.sum("n") / BLOCK).cast("int").alias(as_))

    counts = stored(blocks(askers, "asking").join(blocks(others, "asked"), "hub"), "near-blocks")
    lists = sets.select("node", "shingles")

    def dealt(rows, own, across, asks):
        i, j = ("i", "j") if asks else ("j", "i")
        return (rows.join(counts, "hub").withColumn(i, F.pmod(F.xxhash64("node"), F.col(own)).cast("int"))
                .withColumn(j, F.explode(F.sequence(F.lit(0), F.col(across) - 1))).join(lists, "node")
                .select("hub", "i", "j", F.lit(asks).alias("asks"), "root", "shingles"))

    percent = round(100 * similarity)

    def run(table: pa.Table) -> pa.Table:
        asks, root = table.column("asks").to_numpy(), table.column("root").to_numpy()
        lists = table.column("shingles").combine_chunks()
        start, size = lists.offsets.to_numpy(), lists.value_lengths().to_numpy().astype(np.int64)
        start, values = start - start[0], lists.flatten().to_numpy()
        other, found, above = np.flatnonzero(~asks), [], {}

        def top(x):
            while above.get(x, x) != x:
                x = above[x]
            return x

        if other.size and asks.any():
            pile = np.concatenate([values[start[k]:start[k + 1]] for k in other])
            edge = np.cumsum(size[other]) - size[other]
            for k in np.flatnonzero(asks):
                own = np.sort(values[start[k]:start[k + 1]])
                at = np.minimum(np.searchsorted(own, pile), own.size - 1)
                both = np.add.reduceat((own[at] == pile).astype(np.int64), edge)
                hit = 100 * both >= percent * (size[k] + size[other] - both)
                for r in np.unique(root[other[hit]]).tolist():
                    if (x := top(int(root[k]))) != (y := top(r)):
                        above[max(x, y)] = min(x, y)
                        found.append((x, y))
        return pa.table({"a": pa.array([f[0] for f in found], pa.int64()), "b": pa.array([f[1] for f in found], pa.int64())})

    both = dealt(askers, "asking", "asked", True).unionByName(dealt(others, "asked", "asking", False))
    return both.groupBy("hub", "i", "j").applyInArrow(run, "a long, b long")


def near_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS,
                similarity: float = SIMILARITY) -> DataFrame:
    """One row per input row: id, text_key, n_shingles, component (the
    smallest id that links reach, itself included), stays (it has the group's
    smallest id and, of texts with that id, the smallest text_key) and
    group_size (rows)."""
    docs = df.select(whole_id(id_col), whole_text(text_col), text_key(text_col))
    signed = stored(signatures(docs, words), "near-signatures")
    classes = (signed.where("n > 0").groupBy("n", "set_a", "set_b")
               .agg(F.count(F.lit(1)).alias("rows"), F.min(F.struct("id", "text_key")).alias("low"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch")))
    classes = stored(classes.withColumn("node", F.monotonically_increasing_id()), "near-classes")

    spread = classes.select("node", "n", "sketch", F.explode("bands").alias("band"))
    repeated = spread.groupBy("band").count().where("count > 1").select("band")
    spread = stored(passing(spread, slot_filter(repeated, "band"), True, "band"), "near-buckets")
    pivot = spread.groupBy("band").agg(F.min(F.struct(F.xxhash64("node", F.pmod("band", F.lit(PIVOTS))).alias("h"), "node", "n", "sketch")).alias("p"))
    pivot = stored(pivot.select("band", "p.node", "p.n", "p.sketch"), "near-pivots")
    tried = (spread.alias("x").join(pivot.alias("y"), "band").where("x.node != y.node and " + _possible(similarity))
             .select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")).distinct())
    tried = stored(tried, "near-tried")

    wanted = spread.join(repeated, "band", "left_semi").select("node").distinct()
    wanted = stored(classes.join(wanted, "node", "left_semi").select("node", "low.id", "low.text_key"), "near-wanted")
    sets = full_sets(docs, slot_filter(wanted, "text_key"), words).join(wanted, ["id", "text_key"])
    sets = stored(sets.groupBy("node").agg(F.first("shingles").alias("shingles")), "near-sets")
    links = stored(confirm(tried, sets, similarity), "near-links")

    roots = components(links, "near-roots")
    label = F.coalesce("root", "node").alias("root")
    placed = stored(spread.join(roots, "node", "left").select("band", "node", "n", "sketch", label), "near-placed")
    open_ = placed.groupBy("band").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo < hi").select("band")
    open_ = stored(placed.join(open_, "band", "left_semi"), "near-open")
    # the bucket's largest component is its hub; the others ask its members
    sizes = open_.groupBy("band", "root").count()
    hub = sizes.groupBy("band").agg(F.max(F.struct("count", "root")).getField("root").alias("hub"))
    asking = open_.join(hub, "band").where("root != hub").select("node", "n", "root", "hub").distinct()
    asking = stored(asking, "near-asking")
    members = placed.select("node", "n", "root", F.col("root").alias("hub")).distinct()
    members = members.join(asking.select("hub").distinct(), "hub", "left_semi").select("node", "n", "root", "hub")
    more = block_links(asking, members.unionByName(asking), sets, similarity)
    final = components(more, "near-final").select(F.col("node").alias("root"), F.col("root").alias("head"))
    heads = (classes.select("node", "n", "set_a", "set_b", "low", "rows").join(roots, "node", "left").withColumn("root", label)
             .join(final, "root", "left").withColumn("head", F.coalesce("head", "root")))
    lowest = heads.groupBy("head").agg(F.min("low").alias("stays"), F.sum("rows").alias("size"))
    named = stored(heads.drop("rows").join(lowest, "head").select(
        "n", "set_a", "set_b", F.col("stays.id").alias("component"), F.col("stays.text_key").alias("stays"), "size"), "near-named")
    return (signed.select("id", "text_key", "n", "set_a", "set_b").join(named, ["n", "set_a", "set_b"], "left")
            .select("id", "text_key", F.col("n").alias("n_shingles"), F.coalesce("component", "id").alias("component"),
                    F.coalesce((F.col("id") == F.col("component")) & (F.col("text_key") == F.col("stays")), F.lit(True)).alias("stays"),
                    F.coalesce("size", F.lit(1)).alias("group_size")))


def near_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS,
               similarity: float = SIMILARITY) -> DataFrame:
    """The rows of ``df`` that stay: of each group one of smallest id."""
    groups = near_groups(df, id_col, text_col, words, similarity).where("group_size > 1")
    named = groups.groupBy("id", "text_key").agg(F.max("stays").alias("kept"), F.count(F.lit(1)).alias("n"))
    return one_of_each(df, stored(named.where("not kept or n > 1"), "near-dropped"), id_col, text_col)


def digest(df: DataFrame) -> DataFrame:
    """The contract's columns of query op8: shingles of two words."""
    return near_groups(df, words=2).select(
        real_id("id").alias("doc_id"), "n_shingles", real_id("component").alias("component_id"), (F.col("id") == F.col("component")).alias("kept"))


#: Exact links of all pairs that share a shingle; reachability by recursion.
SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, sh FROM (
    SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN w
           ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS sh FROM d)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
links AS (
  SELECT a, b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s AS x JOIN s AS y USING (sh) WHERE x.doc_id <> y.doc_id GROUP BY 1, 2) AS p
  JOIN n AS na ON na.doc_id = a JOIN n AS nb ON nb.doc_id = b WHERE 100 * c >= 80 * (na.n + nb.n - c)),
reach(doc_id, r) AS (
  SELECT doc_id, doc_id FROM d
  UNION
  SELECT links.b, reach.r FROM reach JOIN links ON links.a = reach.doc_id)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, min(r) AS component_id, min(r) = d.doc_id AS kept
FROM d JOIN reach USING (doc_id) LEFT JOIN n USING (doc_id) GROUP BY d.doc_id, n.n
"""
