"""Document fingerprints by I-Match with randomised lexicons (operator 3).

1. ``document_frequencies``: in how many documents each term occurs, over all
   documents, combined in the scan tasks before the shuffle.  A term is a run
   of letters and digits (bytes of 0x80 and above count as letters), A-Z
   lower-cased, known by a 64-bit hash.
2. ``lexicon``: terms whose document frequency lies in a band, that is, whose
   idf lies between log(1 / HIGH) and log(1 / LOW), and that occur in two
   documents at least.  Every such term occurs in LOW of all documents, so the
   lexicon has at most (mean distinct terms of a document) / LOW terms, however
   many documents there are; it is sent to every task.
3. A text's distinct lexicon terms are sorted and hashed, whole and for each of
   the randomised lexicon subsets (a fixed part of all terms, by a salted
   hash).  A text with fewer than ``FEW`` lexicon terms uses all its terms, so
   that it doesn't fall together with other short texts.
4. Likeness of two fingerprints: of the subsets in which either has a term,
   the part whose hashes are equal; 1 if neither has any.  Small subsets make
   it follow the share of common terms, large ones tell near copies.

Null or empty text: no terms, a fixed fingerprint.  Equal texts have equal
fingerprints.  Null id: before all others in descending order.  Ties of ids are
put in order by a hash of the text.  A single row is its own next document.
Empty table: empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from . import hashing as H
from .common import SLICE_BYTES, _struct, map_slices, raw, real_id, record, slices, text_key, whole_id, whole_text

#: Band of document frequency, as a share of all documents.
LOW, HIGH = 0.001, 0.05
#: Parts of the lexicon that the subsets hold, each drawn ``DRAWS`` times.
RATES, DRAWS = (0.5, 0.1, 0.03, 0.01, 0.003, 0.001), 10
FEW = 3
#: Rows of an ordered run of documents that one task reads as a stream, and
#: the most runs (their first ids pass through the driver).
RUN_ROWS, MOST_RUNS = 4000, 20_000
#: Terms that a scan task counts before it sends them on.
HELD_TERMS = 1 << 20
U = np.uint64
_OTHER = np.ones(256, bool)
_OTHER[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False
_SALTS = H.mix(np.arange(1, len(RATES) * DRAWS + 1, dtype=U) * U(0xA0761D6478BD642F))
_PARTS = np.repeat(np.array([int(r * 2**32) for r in RATES], U), DRAWS)
EMPTY = "0" * 8


def term_sets(data: np.ndarray, off: np.ndarray) -> list[np.ndarray]:
    """Each text's distinct term hashes, sorted."""
    starts, ends, bounds = H.spans(data, off, _OTHER)
    h = H.range_hashes(data, starts, ends, H.LOWER)
    return [np.unique(h[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]


def document_frequencies(docs: DataFrame) -> DataFrame:
    """(term, n): documents that hold each term."""
    target = to_arrow_schema(_struct("term long, n long"))

    def total(held):
        term, at = np.unique(np.concatenate([t for t, _ in held]), return_inverse=True)
        return term, np.bincount(at, weights=np.concatenate([n for _, n in held])).astype(np.int64)

    def run(batches):
        held, size = [], 0
        for batch in batches:
            for part in slices(batch):
                sets = term_sets(*raw(part.column("body")))
                term, n = np.unique(np.concatenate(sets), return_counts=True)
                held.append((term, n))
                size += term.size
                if size > HELD_TERMS:
                    held = [total(held)]
                    size = held[0][0].size
                    if size > HELD_TERMS // 2:
                        yield record({"term": held[0][0].view(np.int64), "n": held[0][1]}, target)
                        held, size = [], 0
        if held:
            term, n = total(held)
            yield record({"term": term.view(np.int64), "n": n}, target)

    counted = docs.select("body").mapInArrow(run, "term long, n long")
    return counted.groupBy("term").agg(F.sum("n").alias("n"))


def lexicon(docs: DataFrame, low: float = LOW, high: float = HIGH) -> np.ndarray:
    """Hashes of the terms in the band, sorted."""
    n = docs.count()
    band = document_frequencies(docs).where((F.col("n") >= max(2.0, low * n)) & (F.col("n") <= high * n))
    return np.sort(band.select("term").toArrow().column("term").to_numpy().view(U))


def fingerprint(terms: np.ndarray, lex: np.ndarray) -> str:
    """Hash of the lexicon terms, then of each randomised subset of them."""
    kept = terms
    if lex.size:
        at = np.minimum(np.searchsorted(lex, terms), lex.size - 1)
        kept = terms[lex[at] == terms]
    if kept.size < FEW:
        kept = terms
    chosen = (H.mix(kept[:, None] ^ _SALTS) >> U(32)) < _PARTS
    parts = [hashlib.blake2b(kept.tobytes(), digest_size=16).hexdigest()]
    for k in range(_SALTS.size):
        some = kept[chosen[:, k]]
        parts.append(hashlib.blake2b(some.tobytes(), digest_size=4).hexdigest() if some.size else EMPTY)
    return "".join(parts)


def likeness(a: str, b: str) -> float:
    """Share of equal hashes over the subsets that aren't empty in both."""
    if a == b:
        return 1.0
    same = some = 0
    for k in range(32, len(a), 8):
        x, y = a[k:k + 8], b[k:k + 8]
        if x != EMPTY or y != EMPTY:
            some += 1
            same += x == y
    return same / some if some else 0.0


def fingerprints(df: DataFrame, lex: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text_key, fingerprint) of every whole text."""
    shared = df.sparkSession.sparkContext.broadcast(lex)

    def rows(part):
        sets = term_sets(*raw(part.column("body")))
        return {"id": part.column("id"), "text_key": part.column("text_key"), "fingerprint": [fingerprint(t, shared.value) for t in sets]}

    return map_slices(df.select(whole_id(id_col), text_key(text_col), whole_text(text_col)), rows,
                      "id long, text_key long, fingerprint string")


def ordered_runs(docs: DataFrame, run_rows: int = RUN_ROWS) -> DataFrame:
    """(run, guest, id, text_key, body): documents in descending order of
    (id, text_key), cut into runs; the first document of the next run (after
    the last: of the first) stands at the end of each as a guest.  Only the
    firsts of the runs, two numbers each, pass through the driver."""
    narrow = docs.select("id", "text_key")
    n = max(1, min(MOST_RUNS, -(-narrow.count() // run_rows)))
    firsts = (narrow.repartitionByRange(n, F.desc("id"), F.desc("text_key")).groupBy(F.spark_partition_id())
              .agg(F.max(F.struct("id", "text_key")).alias("f")).select("f.*").collect())
    heads = np.array(sorted(((r["id"], r["text_key"]) for r in firsts), reverse=True), np.int64).reshape(-1, 2)
    shared = docs.sparkSession.sparkContext.broadcast(heads)
    schema = "run int, guest boolean, id long, text_key long, body binary"
    target = to_arrow_schema(_struct(schema))

    def place(batches):
        head = shared.value
        up = np.array([(a, b) for a, b in head[::-1]], dtype=[("id", "<i8"), ("text_key", "<i8")])
        for batch in batches:
            if not batch.num_rows:
                continue
            own = np.empty(batch.num_rows, up.dtype)
            own["id"], own["text_key"] = batch.column("id").to_numpy(), batch.column("text_key").to_numpy()
            # the run of the smallest first that isn't below the row
            run = head.shape[0] - 1 - np.searchsorted(up, own, side="left")
            run = np.maximum(run, 0)
            first = np.flatnonzero((head[run, 0] == own["id"]) & (head[run, 1] == own["text_key"]))
            cols = {n: batch.column(n) for n in ("id", "text_key", "body")}
            yield record(cols | {"run": run.astype(np.int32), "guest": np.zeros(run.size, bool)}, target)
            if first.size:
                some = {n: c.take(pa.array(first)) for n, c in cols.items()}
                yield record(some | {"run": ((run[first] - 1) % head.shape[0]).astype(np.int32), "guest": np.ones(first.size, bool)}, target)

    dealt = docs.select("id", "text_key", "body").mapInArrow(place, schema).repartition(max(1, heads.shape[0]), "run")
    return dealt.sortWithinPartitions("run", "guest", F.desc("id"), F.desc("text_key"))


EDITED = ("id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double")


def edited_fingerprints(df: DataFrame, low: float = LOW, high: float = HIGH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text, of its edited text (the last half replaced
    by the start of the next document) and their likenesses.  Documents are
    shuffled once, into their order; the tasks read them as a stream."""
    docs = df.select(whole_id(id_col), text_key(text_col), whole_text(text_col))
    shared = df.sparkSession.sparkContext.broadcast(lexicon(docs, low, high))
    target = to_arrow_schema(_struct(EDITED))

    def prints(bodies: list[bytes]) -> list[str]:
        data = np.frombuffer(b"".join(bodies), np.uint8)
        off = np.cumsum([0, *map(len, bodies)])
        return [fingerprint(t, shared.value) for t in term_sets(data, off)]

    def finish(rows):
        """Rows of (id, text, its fingerprint, next text, next fingerprint)."""
        texts, sizes = [], []
        for _, body, _, after, _ in rows:
            own, other = body.decode("utf-8", "replace"), after.decode("utf-8", "replace")
            half = len(own) // 2
            sizes.append(len(own))
            texts.append((own[:len(own) - half] + other[:half]).encode())
        edited = prints(texts)
        return record({
            "id": [r[0] for r in rows], "n_chars": sizes, "edited_sha256": [hashlib.sha256(t).hexdigest() for t in texts],
            "fingerprint": [r[2] for r in rows], "edited_fingerprint": edited,
            "near_edited": [likeness(r[2], e) for r, e in zip(rows, edited, strict=True)],
            "near_next": [likeness(r[2], r[4]) for r in rows]}, target)

    def run(batches):
        last = None  # (run, id, body, fingerprint) that waits for its next
        for batch in batches:
            for part in slices(batch, SLICE_BYTES):
                bodies, pairs = part.column("body").to_pylist(), []
                for at, guest, ident, body, mark in zip(part.column("run").to_pylist(), part.column("guest").to_pylist(),
                                                        part.column("id").to_pylist(), bodies, prints(bodies), strict=True):
                    if last is not None and last[0] == at:
                        pairs.append((*last[1:], body, mark))
                    last = None if guest else (at, ident, body, mark)
                if pairs:
                    yield finish(pairs)

    return ordered_runs(docs).mapInArrow(run, EDITED)


def digest(df: DataFrame) -> DataFrame:
    """The contract's columns of query op3."""
    out = edited_fingerprints(df)
    return out.select(real_id("id").alias("doc_id"), *[c for c in out.columns if c != "id"])
