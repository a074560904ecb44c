"""Exact deduplication (operator 7): an extendible-hash index on shared files.

Texts are equal when identical after deleting every character of
``[\\x20\\x09-\\x0D]``.  A normalised text's key is 64 bits of its SHA-256.

1. ``repeated_keys``: 64-bit keys are counted; a key that occurs once is its
   own group, and its text never moves.
2. ``directory``: keys that occur more than once are counted by prefix in
   Spark (a table of at most 2**MAX_DEPTH counts); starting from one bucket,
   an overfull bucket splits on its next bit and the directory doubles when
   the bucket already uses all of its bits.  Copies don't count towards a
   bucket's fill, since no split can part them.
3. ``pages``: tasks that read the texts put equal ones together (comparing
   bytes), so that copies cost one entry per task, and write the entries
   (bucket, key, bytes, members) to shared files.  Texts whose key is not in
   the fixed-size slot filter of repeated keys are passed over.
4. ``owners``: each bucket, a contiguous range of keys, belongs to one task,
   which reads its entries in key order and keeps a chain of different byte
   strings per key; entries are compared with the chain byte by byte, so
   colliding keys never merge different texts.
5. Groups are summed up over entries and joined back to the members.

Of equal texts the row with the most code points in the original text, then
the smallest id, stays.  Null text: empty.  All-blank texts are equal to empty
ones.  Null id: after every other id.  Rows that repeat id and text are members of the
same group, and one of them stays.  Empty table: empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pyspark.sql.pandas.types import to_arrow_schema

from .common import (_struct, in_slots, map_slices, one_of_each, raw, real_id, record, slices, slot_filter, stored,
                     text_key, whole_id, whole_text)

WHITE = b"\x20\x09\x0a\x0b\x0c\x0d"
#: Different repeated keys that a bucket holds before it splits.
CAPACITY = 4096
#: Bits of the directory at most: 65,536 entries.  Beyond that buckets grow.
MAX_DEPTH = 16
#: Bytes of different texts that a scan task holds before it writes entries.
HELD_BYTES = 32 << 20


def _normal(part: pa.RecordBatch):
    data, off = raw(part.column("body"))
    for i in range(part.num_rows):
        body = data[off[i]:off[i + 1]].tobytes()
        yield body, body.translate(None, WHITE)


def _chars(body: bytes) -> int:
    return len(body) if body.isascii() else len(body.decode("utf-8", "replace"))


def _digests(part: pa.RecordBatch) -> tuple[list, np.ndarray, list[str]]:
    """(texts with their normal forms, keys, hex digests) of a slice."""
    bare = list(_normal(part))
    found = [hashlib.sha256(normal) for _, normal in bare]
    key = np.frombuffer(b"".join(d.digest()[:8] for d in found), ">i8").astype(np.int64)
    return bare, key, [d.hexdigest() for d in found]


def repeated_keys(docs: DataFrame) -> DataFrame:
    """Keys of at least two rows; counting combines in the scan tasks."""
    key = map_slices(docs.select("body"), lambda part: {"key": _digests(part)[1]}, "key long")
    return key.groupBy("key").count().where("count > 1").select("key")


def split_directory(counts: np.ndarray, capacity: int) -> tuple[np.ndarray, int]:
    """Extendible hashing over the counts of the longest prefixes: (bucket of
    each directory slot, global depth).  Bucket numbers follow key order."""
    longest = int(np.log2(counts.size))
    total = np.concatenate([[0], np.cumsum(counts)])
    depth, open_, done = 0, [(0, 0)], []  # (local depth, prefix)
    while open_:
        local, prefix = open_.pop()
        width = longest - local
        fill = total[(prefix + 1) << width] - total[prefix << width]
        if fill > capacity and local < longest:
            depth = max(depth, local + 1)  # the directory doubles
            open_ += [(local + 1, 2 * prefix), (local + 1, 2 * prefix + 1)]
        else:
            done.append((local, prefix))
    slots = np.zeros(1 << depth, np.int32)
    for bucket, (local, prefix) in enumerate(sorted(done, key=lambda x: x[1] << (longest - x[0]))):
        slots[prefix << (depth - local):(prefix + 1) << (depth - local)] = bucket
    return slots, depth


def prefix(key: np.ndarray, bits: int) -> np.ndarray:
    """The leading bits of a key, read as unsigned."""
    return (key.view(np.uint64) >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(key.size, np.int64)


def directory(repeated: DataFrame, capacity: int = CAPACITY, max_depth: int = MAX_DEPTH) -> tuple[np.ndarray, int]:
    counts = repeated.groupBy(F.shiftrightunsigned("key", 64 - max_depth).alias("prefix")).count().toArrow()
    full = np.zeros(1 << max_depth, np.int64)
    full[counts.column("prefix").to_numpy().astype(np.int64)] = counts.column("count").to_numpy()
    return split_directory(full, capacity)


MEMBER = "id:long,text_key:long,n_chars:long"
PAGE = f"bucket int, key long, entry string, body binary, digest string, members array<struct<{MEMBER}>>, best int"


def pages(docs: DataFrame, slots, buckets: np.ndarray, depth: int, held_bytes: int = HELD_BYTES) -> DataFrame:
    """Index entries of texts whose key may be repeated: one for each
    different text of a task (or of ``held_bytes`` of such texts), with its
    members and the place of the best of them."""
    target = to_arrow_schema(_struct(PAGE))

    def run(batches):
        held, size, serial = {}, 0, 0
        task = TaskContext.get().partitionId()

        def flush():
            nonlocal serial
            entries = list(held.items())
            for lo in range(0, len(entries), 256):
                some = entries[lo:lo + 256]
                key = np.array([k for (k, _), _ in some], np.int64)
                yield record({
                    "bucket": buckets[prefix(key, depth)], "key": key,
                    "entry": [f"{task}-{serial + i}" for i in range(len(some))], "body": [b for (_, b), _ in some],
                    "digest": [d for _, (d, _) in some], "members": [m for _, (_, m) in some],
                    "best": [min(range(len(m)), key=lambda i: (-m[i]["n_chars"], m[i]["id"])) for _, (_, m) in some]}, target)
                serial += len(some)

        for batch in batches:
            for part in slices(batch):
                bare, key, digests = _digests(part)
                ids, texts = part.column("id").to_pylist(), part.column("text_key").to_pylist()
                for i in np.flatnonzero(in_slots(slots.value, key)):
                    place = (int(key[i]), bare[i][1])  # looking it up compares whole byte strings
                    if place not in held:
                        held[place] = (digests[i], [])
                        size += len(bare[i][1])
                    held[place][1].append({"id": ids[i], "text_key": texts[i], "n_chars": _chars(bare[i][0])})
                    size += 256
                if size > held_bytes:
                    yield from flush()
                    held, size = {}, 0
        yield from flush()

    return docs.mapInArrow(run, PAGE)


def alone(docs: DataFrame, slots) -> DataFrame:
    """Rows whose key no other row has, decided in their scan task."""
    def rows(part):
        bare, key, digests = _digests(part)
        out = np.flatnonzero(~in_slots(slots.value, key))
        ids = part.column("id").to_numpy()[out]
        return {"id": ids, "text_key": part.column("text_key").to_numpy()[out],
                "n_chars": [_chars(bare[i][0]) for i in out], "keep": ids, "group_size": np.ones(out.size, np.int64),
                "kept": np.ones(out.size, bool), "text_sha256": [digests[i] for i in out]}

    return map_slices(docs, rows, RESULT)


RESULT = "id long, text_key long, n_chars long, keep long, group_size long, kept boolean, text_sha256 string"
OWNED = "entry string, class string"


def owners(entries: DataFrame, n_buckets: int) -> DataFrame:
    """(entry, class): owner tasks read their key ranges in order and chain
    entries of one key by comparing bytes.  Only different byte strings of
    one key are held at a time."""
    target = to_arrow_schema(_struct(OWNED))

    def run(batches):
        at, chain = None, []
        for batch in batches:
            names, classes = batch.column("entry"), []
            data, off = raw(batch.column("body"))
            for i, key in enumerate(batch.column("key").to_numpy()):
                if key != at:
                    at, chain = key, []
                body = data[off[i]:off[i + 1]].tobytes()
                place = next((k for k, other in enumerate(chain) if other == body), len(chain))
                if place == len(chain):
                    chain.append(body)
                classes.append(f"{key}-{place}")
            yield record({"entry": names, "class": classes}, target)

    dealt = entries.select("bucket", "key", "entry", "body").repartition(max(1, n_buckets), "bucket")
    return dealt.sortWithinPartitions("bucket", "key").select("key", "entry", "body").mapInArrow(run, OWNED)


def exact_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
                 max_depth: int = MAX_DEPTH) -> DataFrame:
    """One row per input row: id, text_key, n_chars (code points), keep (the
    id that stays), group_size, kept and text_sha256 (of the normalised text).
    Exactly one row of a group is kept, also where rows repeat id and text."""
    docs = df.select(whole_id(id_col), whole_text(text_col), text_key(text_col))
    repeated = stored(repeated_keys(docs), "exact-repeated")
    slots = slot_filter(repeated, "key")
    table, depth = directory(repeated, capacity, max_depth)
    index = stored(pages(docs, slots, table, depth), "exact-index")
    best = F.expr("members[best]")
    entries = stored(index.select("entry", best.alias("best")).join(owners(index, int(table.max()) + 1), "entry")
                     .select("entry", "class", "best"), "exact-entries")
    sizes = index.select("entry", F.size("members").cast("long").alias("n"))
    rank = F.struct(F.col("best.n_chars"), (-F.col("best.id")).alias("minus"), F.col("entry").alias("top"), F.col("best.id").alias("keep"))
    group = (entries.join(sizes, "entry").groupBy("class")
             .agg(F.sum("n").alias("group_size"), F.max(rank).alias("stays")))
    decided = entries.select("entry", "class").join(group, "class").select(
        "entry", "group_size", F.col("stays.keep").alias("keep"), F.col("stays.top").alias("top"))
    members = (index.select("entry", "digest", "best", F.posexplode("members").alias("at", "m")).join(decided, "entry")
               .select("m.id", "m.text_key", "m.n_chars", "keep", "group_size",
                       ((F.col("entry") == F.col("top")) & (F.col("at") == F.col("best"))).alias("kept"),
                       F.col("digest").alias("text_sha256")))
    return alone(docs, slots).unionByName(members)


def exact_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """The rows of ``df`` that stay, one of each group, all columns."""
    groups = exact_groups(df, id_col, text_col, **settings)
    # rows that repeat id and text share their name: one of them stays
    named = groups.groupBy("id", "text_key").agg(F.max("kept").alias("kept"), F.count(F.lit(1)).alias("n"))
    named = stored(named.where("not kept or n > 1"), "exact-named")
    return one_of_each(df, named, id_col, text_col)


def digest(df: DataFrame) -> DataFrame:
    """The contract's columns of query op7."""
    return exact_groups(df).select(real_id("id").alias("doc_id"), real_id("keep").alias("keep_id"), "group_size", "kept", "text_sha256")


SQL = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS bare FROM documents),
g AS (SELECT bare, count(*) AS group_size, arg_min(doc_id, (-n, doc_id)) AS keep_id FROM d GROUP BY bare)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(bare) AS text_sha256 FROM d JOIN g USING (bare)
"""
