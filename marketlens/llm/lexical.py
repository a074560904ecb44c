"""Ranked lexical search (operator 12): exact top-k by inner product in the
manner of LEMP (Teflioudi, Gemulla, Mykytiuk, "LEMP: Fast Retrieval of Large
Entries in a Matrix Product", 2015), over BM25-like integer impacts.

A document's impact vector has a coordinate for each term of the queries; its
length is sqrt(sum(w * impact**2)), w being the term's weight.  The vectors are
written in the order of their lengths, longest first, task by task, so nothing
is shuffled.  Then, with a score that the k-th best must reach:

1. vectors shorter than any query could use are skipped by the row groups'
   statistics; a bucket (``BUCKET`` vectors of similar length) is skipped where
   |query| * longest vector (Cauchy-Schwarz) or the sum of the query's weights
   times the bucket's largest coordinates is below that score;
2. inside a bucket, the terms are taken from the largest bound down until what
   is left can't reach the score; a document without any of these terms is out,
   and so is one whose partial score plus the smaller of the two bounds of the
   rest (coordinates, Cauchy-Schwarz of the remaining lengths) is too low;
3. the survivors' scores are summed exactly in 64-bit integers.

The score starts from the k-th best of about ``SEED`` documents drawn by hash
and rises as a task finds better ones.  It only saves work: whatever could
still reach it is scored, ties included.

All documents are read for the counts (N, L, df) and for the vectors.  Queries
are dealt into blocks of about ``BLOCK`` (query, term) pairs by hash, each
against all documents; a block's terms are all that is broadcast.  Terms are
told apart by 64-bit hashes.  A task returns k rows a query at most.

Null or blank text: no term; the document is not counted in N and never ranked.
A query without a term that a document holds: no row.  Null document id: after
all others of the same score.  Rows that repeat an id: each is ranked.  Query
rows of equal id and text are one query; rows of one id and different texts are
ranked apart.  Empty tables: empty result.  Very long texts are read whole.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import hashing as H
from .common import map_slices, raw, record, stored, whole_text

TOP = 10
BLOCK, BUCKET, SEED = 50_000, 2048, 8192
#: Coordinates that a bucket holds at most (a longer vector stands alone).
VALUES = 1 << 20
BREAKS = np.ones(256, bool)
BREAKS[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False
_INDEX = "id long, n long, terms array<int>, counts array<int>"
_IMPACTS = "id long, terms array<int>, impacts array<int>, length double"
_FOUND = "item_id long, text_key long, doc_id long, score long"


def term_keys(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all terms of a slice, and each text's range of them."""
    data, off = raw(part.column("body"))
    starts, ends, bounds = H.spans(data, off, BREAKS)
    return H.range_hashes(data, starts, ends, H.LOWER).view(np.int64), bounds


def lists(values: np.ndarray, sizes: np.ndarray) -> pa.Array:
    off = np.zeros(sizes.size + 1, np.int32)
    np.cumsum(sizes, out=off[1:])
    return pa.ListArray.from_arrays(pa.array(off), pa.array(values))


def query_terms(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(item_id, text_key, key, reps): the terms of each query and how often."""
    def count(part):
        keys, bounds = term_keys(part)
        row = np.repeat(np.arange(part.num_rows), np.diff(bounds))
        order = np.lexsort((keys, row))
        row, keys = row[order], keys[order]
        first = np.flatnonzero(np.r_[True, (row[1:] != row[:-1]) | (keys[1:] != keys[:-1])]) if keys.size else np.zeros(0, int)
        at = pa.array(row[first])
        return {"item_id": part.column("item_id").take(at), "text_key": part.column("text_key").take(at),
                "key": keys[first], "reps": np.diff(np.r_[first, keys.size])}

    rows = items.select(F.col(id_col).cast("long").alias("item_id"), whole_text(text_col)).distinct()
    return map_slices(rows.withColumn("text_key", F.xxhash64("body")), count, "item_id long, text_key long, key long, reps long")


def index_terms(docs: DataFrame, vocabulary: np.ndarray) -> DataFrame:
    """(id, n, terms, counts): a document's number of terms, and those of the
    sorted vocabulary (by position in it) with their counts."""
    known = docs.sparkSession.sparkContext.broadcast(vocabulary)
    slot = np.zeros(1 << 20, bool)
    slot[vocabulary & (slot.size - 1)] = True
    slot = docs.sparkSession.sparkContext.broadcast(slot)

    def count(part):
        keys, bounds = term_keys(part)
        n = np.diff(bounds)
        near = np.flatnonzero(slot.value[keys & (slot.value.size - 1)])
        keys = keys[near]
        at = np.minimum(np.searchsorted(known.value, keys), known.value.size - 1)
        hit = known.value[at] == keys
        row = np.searchsorted(bounds, near[hit], side="right") - 1
        both, counts = np.unique((row.astype(np.int64) << 32) | at[hit], return_counts=True)
        return {"id": part.column("id"), "n": n.astype(np.int64),
                "terms": lists((both & 0xFFFFFFFF).astype(np.int32), np.bincount(both >> 32, minlength=part.num_rows)),
                "counts": lists(counts.astype(np.int32), np.bincount(both >> 32, minlength=part.num_rows))}

    return map_slices(docs, count, _INDEX)


def document_counts(index: DataFrame, size: int) -> np.ndarray:
    """Documents that hold each term of the vocabulary; a task sums its own."""
    def count(batches):
        total = np.zeros(size, np.int64)
        for batch in batches:
            total += np.bincount(batch.column("terms").flatten().to_numpy(), minlength=size)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], ["term", "df"])

    table = index.select("terms").mapInArrow(count, "term int, df long").groupBy("term").agg(F.sum("df").alias("df")).toArrow()
    out = np.zeros(size, np.int64)
    out[table.column("term").to_numpy()] = table.column("df").to_numpy()
    return out


def impact(tf: np.ndarray, n: np.ndarray, docs: int, terms: int) -> np.ndarray:
    """(10**9 * tf) div (1000 * tf + 8 * m), m = 25 + (75 * n * N) div L."""
    wide = object if n.size and 75 * int(n.max()) * docs >= 1 << 63 else np.int64
    m = 25 + ((75 * n.astype(wide) * docs) // terms).astype(np.int64)
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


def impact_vectors(index: DataFrame, weights: np.ndarray, docs: int, terms: int) -> DataFrame:
    """Impact vectors with their lengths, longest first in each task."""
    held = index.sparkSession.sparkContext.broadcast(weights)

    def run(batches):
        for batch in batches:
            sizes = np.diff(batch.column("terms").offsets.to_numpy())
            at, tf = (batch.column(c).flatten().to_numpy() for c in ("terms", "counts"))
            x = impact(tf.astype(np.int64), np.repeat(batch.column("n").to_numpy(), sizes), docs, terms)
            row = np.repeat(np.arange(sizes.size), sizes)
            square = np.bincount(row, held.value[at] * x.astype(float) ** 2, minlength=sizes.size)
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("terms"), lists(x.astype(np.int32), sizes),
                                              pa.array(np.sqrt(square))], ["id", "terms", "impacts", "length"])

    return index.where(F.size("terms") > 0).mapInArrow(run, _IMPACTS).sortWithinPartitions(F.desc("length"))


class Queries:
    """A block of queries: for each, its terms (positions in the vocabulary)
    and integer weights reps * w; queries and terms sorted."""

    def __init__(self, query: np.ndarray, term: np.ndarray, reps: np.ndarray, weights: np.ndarray, size: int):
        q = reps * weights[term]
        keep = q > 0
        self.query, self.term, self.q = query[keep], term[keep], q[keep]
        self.root = self.q / np.sqrt(weights[self.term])  # the other root of the weight is in the document's length
        self.size, self.range = size, np.searchsorted(self.query, np.arange(size + 1))
        self.length = np.sqrt(np.bincount(self.query, self.root ** 2, minlength=size))
        self.weights = weights


class Best:
    """The best documents of each query so far, and the score to reach."""

    def __init__(self, start: np.ndarray, top: int):
        self.floor, self.top = np.maximum(start, 1), top
        self.rows: dict[int, tuple[np.ndarray, ...]] = {}

    def add(self, query: int, score: np.ndarray, none: np.ndarray, ids: np.ndarray) -> None:
        old = self.rows.get(query)
        if old is not None:
            score, none, ids = (np.concatenate(x) for x in zip(old, (score, none, ids)))
        order = np.lexsort((ids, none, -score))[:self.top]
        self.rows[query] = score[order], none[order], ids[order]
        if order.size == self.top:
            self.floor[query] = max(self.floor[query], score[order[-1]])


def search_bucket(q: Queries, best: Best, terms, impacts, off, length, none, ids) -> None:
    """Meet one bucket of vectors (CSR: off, terms, impacts) with all queries."""
    n = length.size
    row = np.repeat(np.arange(n), np.diff(off))
    order = np.argsort(terms, kind="stable")
    col, first = np.unique(terms[order], return_index=True)
    last = np.r_[first[1:], order.size]
    rows, x = row[order], impacts[order]
    high = np.maximum.reduceat(x, first) if col.size else x
    at = np.searchsorted(col, q.term)
    at = np.where(at < col.size, at, 0)
    there = col[at] == q.term if col.size else np.zeros(q.term.size, bool)
    bound = np.where(there, q.q * high[at], 0) if col.size else np.zeros(q.term.size, np.int64)
    reach = np.minimum(np.bincount(q.query, bound, minlength=q.size), q.length * (length.max() if n else 0) * (1 + 1e-9))
    for k in np.flatnonzero(reach * (1 + 1e-9) >= best.floor):
        a, b = q.range[k], q.range[k + 1]
        use = a + np.argsort(-bound[a:b], kind="stable")
        use = use[bound[use] > 0]
        left = np.r_[np.cumsum(bound[use][::-1])[::-1], 0]  # largest score of the terms from here on
        need = int(np.searchsorted(-left, -best.floor[k], side="right"))  # terms of which a document must hold one
        part, square = np.zeros(n, np.int64), np.zeros(n)
        for t in use[:need]:
            c = at[t]
            docs, value = rows[first[c]:last[c]], x[first[c]:last[c]]
            part[docs] += q.q[t] * value
            if need < use.size:
                square[docs] += q.weights[q.term[t]] * value.astype(float) ** 2
        if need < use.size:
            rest = np.sqrt((q.root[use[need:]] ** 2).sum()) * np.sqrt(np.maximum(length ** 2 * (1 + 1e-9) - square, 0))
            some = np.flatnonzero((part > 0) & ((part + np.minimum(left[need], rest)) * (1 + 1e-9) >= best.floor[k]))
        else:
            some = np.flatnonzero(part >= best.floor[k])
        if need < use.size and some.size:  # the survivors' other terms, exactly
            score = part[some]
            for t in use[need:]:
                c = at[t]
                docs = rows[first[c]:last[c]]
                spot = np.minimum(np.searchsorted(docs, some), docs.size - 1)
                score += np.where(docs[spot] == some, q.q[t] * x[first[c] + spot], 0)
            some, score = some[score >= best.floor[k]], score[score >= best.floor[k]]
        else:
            score = part[some]
        if some.size:
            best.add(int(k), score, none[some], ids[some])


def search(vectors: DataFrame, held, names, start: np.ndarray, top: int, bucket: int) -> DataFrame:
    """Each task's best ``top`` documents of every query."""
    from pyspark.sql.types import StructType
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = to_arrow_schema(StructType.fromDDL(_FOUND))
    item, key = names

    def buckets(batches):
        table, n, values = [], 0, 0
        for batch in batches:
            table.append(batch)
            n, values = n + batch.num_rows, values + len(batch.column("terms").flatten())
            if n >= bucket or values >= VALUES:
                yield pa.Table.from_batches(table).combine_chunks()
                table, n, values = [], 0, 0
        if n:
            yield pa.Table.from_batches(table).combine_chunks()

    def run(batches):
        best = Best(start.copy(), top)
        for t in buckets(batches):
            terms, x = (t.column(c).combine_chunks() for c in ("terms", "impacts"))
            ids = t.column("id").combine_chunks()
            off = terms.offsets.to_numpy()
            search_bucket(held.value, best, terms.flatten().to_numpy(), x.flatten().to_numpy().astype(np.int64), off - off[0],
                          t.column("length").to_numpy(), ids.is_null().to_numpy(zero_copy_only=False), ids.fill_null(0).to_numpy())
        for k, (score, none, ids) in best.rows.items():
            yield record({"item_id": pa.array([item[k]] * score.size, pa.int64()), "text_key": np.full(score.size, key[k]),
                          "doc_id": pa.array(ids, mask=none), "score": score}, schema)

    return vectors.select("id", "terms", "impacts", "length").mapInArrow(run, _FOUND)


def ranked(found: DataFrame, top: int) -> DataFrame:
    order = Window.partitionBy("item_id", "text_key").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def search_block(docs: DataFrame, block: DataFrame, top: int, bucket: int, seed: int) -> DataFrame:
    """The ranking for one block of queries, against all documents."""
    spark = docs.sparkSession
    table = block.toArrow()  # about BLOCK rows
    if not table.num_rows:
        return spark.createDataFrame([], _FOUND)
    key = table.column("key").to_numpy()
    names = table.group_by(["item_id", "text_key"], use_threads=False).aggregate([])
    item, text = names.column("item_id").to_pylist(), names.column("text_key").to_pylist()
    number = {x: k for k, x in enumerate(zip(item, text))}
    query = np.array([number[x] for x in zip(table.column("item_id").to_pylist(), table.column("text_key").to_pylist())], np.int64)
    vocabulary, term = np.unique(key, return_inverse=True)
    order = np.lexsort((term, query))
    index = stored(index_terms(docs, vocabulary), "term-index")
    total = index.where("n > 0").agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("terms")).first()
    if not total.docs:
        return spark.createDataFrame([], _FOUND)
    df = document_counts(index, vocabulary.size)
    weights = np.array([math.floor(1000 * math.log((2 * total.docs + 2) / (2 * int(x) + 1))) if x else 0 for x in df], np.int64)
    vectors = stored(impact_vectors(index, weights, total.docs, total.terms), "impact-vectors")
    queries = Queries(query[order], term[order], table.column("reps").to_numpy()[order], weights, len(item))
    held = spark.sparkContext.broadcast(queries)
    start = np.ones(len(item), np.int64)
    share = max(1, total.docs // seed)
    drawn = ranked(search(vectors.where(F.pmod(F.xxhash64("id"), F.lit(share)) == 0), held, (item, text), start, top, bucket), top)
    for r in drawn.where(F.col("rank") == top).select("item_id", "text_key", "score").collect():  # a row a query of the block
        start[number[r.item_id, r.text_key]] = r.score
    reach = float(np.min(start / np.maximum(queries.length, 1e-9))) * (1 - 1e-6)
    return search(vectors.where(F.col("length") >= reach), held, (item, text), start, top, bucket)


def rank_documents(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id",
                   item_text: str = "text", top: int = TOP, block: int = BLOCK, bucket: int = BUCKET, seed: int = SEED) -> DataFrame:
    """(item_id, text_key, rank, doc_id, score): each query's ``top`` documents."""
    terms = stored(query_terms(items, item_id, item_text), "query-terms")
    rows = docs.select(F.col(id_col).cast("long").alias("id"), whole_text(text_col))
    blocks = max(1, -(-terms.count() // block))
    found = docs.sparkSession.createDataFrame([], _FOUND)
    for k in range(blocks):
        part = terms.where(F.pmod(F.xxhash64("item_id", "text_key"), F.lit(blocks)) == k)
        found = found.unionByName(stored(search_block(rows, part, top, bucket, seed), "found"))
    return ranked(found, top).select("item_id", "text_key", "rank", "doc_id", "score")


def digest(df: DataFrame, items: DataFrame) -> DataFrame:
    """The contract's columns of query op12."""
    return rank_documents(df, items).select("item_id", "rank", "doc_id", "score")


#: The formula over all postings.
SQL = r"""
WITH words AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
asked AS (
  SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
lengths AS (SELECT doc_id, count(*) AS n FROM words GROUP BY 1),
total AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS terms FROM lengths),
postings AS (SELECT doc_id, term, count(*)::BIGINT AS tf FROM words WHERE term IN (SELECT term FROM asked) GROUP BY 1, 2),
weights AS (
  SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w
  FROM (SELECT term, count(*) AS df FROM postings GROUP BY 1), total),
impacts AS (
  SELECT doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // terms))) AS impact
  FROM postings JOIN weights USING (term) JOIN lengths USING (doc_id), total),
scores AS (
  SELECT item_id, doc_id, sum(impact)::BIGINT AS score FROM asked JOIN impacts USING (term) GROUP BY 1, 2 HAVING sum(impact) > 0)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
FROM scores QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) <= 10
"""
