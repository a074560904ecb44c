"""Line deduplication (operator 4): winnowing over line hashes, by characters.

A line is a non-empty piece between line feeds, compared byte for byte.

1. Windows: from every line, the shortest run of lines with ``chars`` characters
   in all.  Winnowing keeps the minimal ones, that is those that hold no other
   window: a line of ``chars`` characters stands alone, shorter ones form runs.
   The hash of a window's lines is a guaranteed fingerprint: whatever run of
   lines with ``chars`` characters occurs twice holds one in common.
2. The positions of each repeated fingerprint are joined with its first place
   (smallest id, then the text, then the earliest line).
3. A match is extended both ways, line by line, over the lines beside the window
   that lie in no window (they have less than ``chars`` characters in all), as
   far as they agree with those beside the first place.  Lines in other windows
   are judged by those.
4. Matched lines go; the first place keeps its own.

So every line of ``chars`` characters, and every run of shorter lines that
comes to as many, that an earlier place holds goes; a short line goes with them
where it stood beside them at their first place.  Short lines alone stay.

Null or empty text: no lines, nothing removed.  A text that loses nothing
keeps its own bytes, blank lines included; else its kept lines are joined by
one line feed.  A text of fewer characters loses nothing.  Null id:
after every other id.  Rows that repeat id and text count as one document and
don't remove each other's lines.  Empty table: empty result.  A very long text
is read whole, in its slice.  Fingerprints are told apart by 128 bits.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import hashing as H
from .common import in_slots, map_slices, passing, raw, slot_filter, stored, text_key, whole_id, whole_text
from .repeats import merged

#: Characters of the shortest run of lines that is deleted.
CHARS = 20
_PLACE = "id long, text_key long, pos int"


def run_hashes(h: np.ndarray, first: np.ndarray, last: np.ndarray, base: np.uint64) -> np.ndarray:
    """Rabin-Karp hash of each run h[first:last + 1], by prefix sums."""
    up, down = H.powers(base, h.size + 1)
    total = np.zeros(h.size + 1, H.U)
    np.cumsum(h * up[:h.size], out=total[1:])
    return H.mix((total[last + 1] - total[first]) * down[first] + (last - first + 1).astype(H.U))


class Lines:
    """The lines of a slice of texts and their minimal windows."""

    def __init__(self, part: pa.RecordBatch, chars: int):
        data, off = raw(part.column("body"))
        starts, ends, self.bounds = H.spans(data, off, H.NEWLINE)
        self.h = H.range_hashes(data, starts, ends)
        n, base = starts.size, off[0]
        self.text = np.repeat(np.arange(off.size - 1), np.diff(self.bounds))
        # characters of each line: bytes that begin one
        begun = np.zeros(off[-1] - base + 1, np.int64)
        np.cumsum((data[base:off[-1]] & 0xC0) != 0x80, out=begun[1:])
        total = np.zeros(n + 1, np.int64)
        np.cumsum(begun[ends - base] - begun[starts - base], out=total[1:])
        # the line that completes the window of every line, if one of its text does
        last = np.searchsorted(total, total[:n] + chars, side="left") - 1
        whole = (last < n) & (self.text[np.minimum(last, max(n - 1, 0))] == self.text if n else np.zeros(0, bool))
        last = np.where(whole, last, n)
        after = np.r_[last[1:], n] if n else last
        same = np.r_[self.text[1:] == self.text[:-1], False] if n else whole
        self.first = np.flatnonzero(whole & ((after > last) | ~same))  # holds no other window
        self.last = last[self.first]
        self.row = self.text[self.first] if n else np.zeros(0, int)

    def fingerprints(self) -> tuple[np.ndarray, np.ndarray]:
        return tuple(run_hashes(self.h, self.first, self.last, b).view(np.int64) for b in (H.WINDOW_BASE, H.WINDOW_BASE_2))

    def beside(self, some: np.ndarray) -> tuple[pa.Array, pa.Array]:
        """Hashes of the lines before and after each of some windows that lie in
        no window: before, the nearest first."""
        before = np.r_[-1, self.last[:-1]] if self.last.size else self.last
        before = np.maximum(before, self.bounds[self.row] - 1)
        after = np.r_[self.first[1:], self.h.size] if self.first.size else self.first
        after = np.minimum(after, self.bounds[self.row + 1])
        values = self.h.view(np.int64)
        left = [values[b + 1:f][::-1] for b, f in zip(before[some], self.first[some], strict=True)]
        right = [values[e + 1:a] for e, a in zip(self.last[some], after[some], strict=True)]
        return tuple(pa.array(x, pa.list_(pa.int64())) for x in (left, right))


def places(docs: DataFrame, chars: int) -> DataFrame:
    """(key, id, text_key, pos) of every fingerprint."""
    def rows(part):
        lines = Lines(part, chars)
        if not lines.first.size:
            return None
        return {"key": lines.fingerprints()[0], "pos": (lines.first - lines.bounds[lines.row]).astype(np.int32)} | {
            c: part.column(c).to_numpy()[lines.row] for c in ("id", "text_key")}

    return map_slices(docs, rows, "key long, " + _PLACE)


def positions(docs: DataFrame, chars: int, slots) -> DataFrame:
    """(key, check, id, text_key, pos, size, before, after) of the fingerprints
    that the filter lets through, with the loose lines beside them."""
    def rows(part):
        lines = Lines(part, chars)
        key, check = lines.fingerprints()
        some = np.flatnonzero(in_slots(slots.value, key))
        if not some.size:
            return None
        before, after = lines.beside(some)
        row, first = lines.row[some], lines.first[some]
        return {"key": key[some], "check": check[some], "pos": (first - lines.bounds[row]).astype(np.int32),
                "size": (lines.last[some] - first + 1).astype(np.int32), "before": before, "after": after} | {
            c: part.column(c).to_numpy()[row] for c in ("id", "text_key")}

    return map_slices(docs, rows, f"key long, check long, {_PLACE}, size int, before array<bigint>, after array<bigint>")


def _agreeing(a: str, b: str):
    """How many lines at the beginning of two lists agree."""
    both = F.arrays_zip(F.col(a).alias("a"), F.col(b).alias("b"))
    # positions of the first line that differs; beyond the shorter list nothing agrees
    differs = F.transform(both, lambda x: ~F.coalesce(x["a"] == x["b"], F.lit(False)))
    at = F.array_position(differs, True)
    return F.when(at > 0, at - 1).otherwise(F.size(both)).cast("int")


def matches(docs: DataFrame, chars: int = CHARS) -> DataFrame:
    """(id, text_key, runs): for each text its lines that repeat an earlier
    place, as distinct [start, end) intervals of lines, one per fingerprint."""
    place = F.struct("id", "text_key", "pos")
    repeated = places(docs, chars).groupBy("key").agg(F.min(place).alias("a"), F.max(place).alias("b")).where("a < b")
    slots = slot_filter(repeated, "key")
    rows = positions(docs, chars, slots)
    first = rows.groupBy("key", "check").agg(F.min(F.struct(place.alias("place"), "before", "after")).alias("first"),
                                             F.max(place).alias("last")).where("first.place < last")
    # written out, so that the join below shuffles both sides itself and
    # adaptive execution can split a line that very many documents hold
    first = stored(first.select("key", "check", F.col("first.place").alias("first"), F.col("first.before").alias("first_before"),
                                F.col("first.after").alias("first_after")), "first-places")
    later = rows.join(first, ["key", "check"]).where(place > F.col("first"))
    run = F.struct((F.col("pos") - _agreeing("before", "first_before")).alias("start"),
                   (F.col("pos") + F.col("size") + _agreeing("after", "first_after")).alias("end"))
    return later.select("id", "text_key", run.alias("run")).groupBy("id", "text_key").agg(F.collect_set("run").alias("runs"))


def remove_repeated_lines(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", chars: int = CHARS,
                          carry: list[str] | None = None) -> DataFrame:
    """One row per input row: ``carry`` (default: the id column), n_lines,
    n_removed, removed (array of [start, end) line intervals), kept.  Texts
    without a repeated fingerprint never leave their scan task."""
    if chars < 1:
        raise ValueError("chars must be 1 or more")
    carry = carry or [id_col]
    full = df.select(F.struct(*[F.col(c) for c in carry]).alias("row"), whole_id(id_col), whole_text(text_col), text_key(text_col))
    lists = stored(matches(full.drop("row"), chars), "matched-lines")
    slots = slot_filter(lists, "text_key")
    row = full.schema["row"].dataType.simpleString()

    def texts(part, runs):
        data, off = raw(part.column("body"))
        starts, ends, bounds = H.spans(data, off, H.NEWLINE)
        n, gone, removed, kept = np.diff(bounds), [], [], []
        for i in range(part.num_rows):
            if runs is None or runs[i] is None:
                gone.append(0)
                removed.append([])
                kept.append(data[off[i]:off[i + 1]].tobytes())
                continue
            mask = np.zeros(n[i], bool)
            for r in runs[i]:
                mask[r["start"]:r["end"]] = True
            gone.append(int(mask.sum()))
            removed.append(merged(mask))
            s, e = (x[bounds[i]:bounds[i + 1]][~mask] for x in (starts, ends))
            kept.append(b"\n".join(data[a:b].tobytes() for a, b in zip(s, e, strict=True)))
        return {"row": part.column("row"), "n_lines": n, "n_removed": gone, "removed": removed, "kept": kept}

    out = f"row {row}, n_lines long, n_removed long, removed array<struct<start:long,end:long>>, kept binary"
    clean = map_slices(full, lambda p: texts(p, None), out, slots=slots, hit=False)
    hits = passing(full, slots, True).join(lists, ["id", "text_key"], "left")
    cut = map_slices(hits.select("row", "body", "runs"), lambda p: texts(p, p.column("runs").to_pylist()), out)
    return clean.unionByName(cut).select(*[F.col("row").getField(c).alias(c) for c in carry], "n_lines", "n_removed", "removed",
                                         F.col("kept").cast("string").alias("kept"))


def digest(df: DataFrame) -> DataFrame:
    return remove_repeated_lines(df).select(
        "doc_id", "n_lines", "n_removed", F.size("removed").cast("long").alias("n_runs"), F.sha2("kept", 256).alias("kept_sha256"))


SQL = rf"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: x <> '') AS w FROM documents),
lines AS (
  SELECT doc_id, i, line, length(line) AS n, sum(length(line)) OVER (PARTITION BY doc_id ORDER BY i) AS total
  FROM (SELECT doc_id, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS line FROM d)),
windows AS (
  SELECT a.doc_id, a.i, b.i AS j FROM lines AS a ASOF JOIN lines AS b ON a.doc_id = b.doc_id AND a.total - a.n + {CHARS} <= b.total),
minimal AS (
  SELECT * FROM (SELECT *, lead(j) OVER (PARTITION BY doc_id ORDER BY i) AS next_j FROM windows) WHERE next_j IS NULL OR next_j > j),
placed AS (
  SELECT *, coalesce(lag(j) OVER (PARTITION BY doc_id ORDER BY i), 0) AS before_i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS after_i FROM minimal),
prints AS (
  SELECT doc_id, i, j, md5(array_to_string(w[i:j], chr(10))) AS h,
         CASE WHEN before_i + 1 < i THEN list_reverse(w[before_i + 1:i - 1]) ELSE [] END AS before,
         CASE WHEN j + 1 < coalesce(after_i, len(w) + 1) THEN w[j + 1:coalesce(after_i, len(w) + 1) - 1] ELSE [] END AS after
  FROM placed JOIN d USING (doc_id)),
firsts AS (
  SELECT h, min((doc_id, i)) AS first, arg_min(before, (doc_id, i)) AS before_first, arg_min(after, (doc_id, i)) AS after_first
  FROM prints GROUP BY h HAVING count(*) > 1),
later AS (
  SELECT doc_id, i - len(list_filter(range(1, least(len(before), len(before_first)) + 1), lambda k: before[1:k] = before_first[1:k])) AS a,
         j + len(list_filter(range(1, least(len(after), len(after_first)) + 1), lambda k: after[1:k] = after_first[1:k])) AS b
  FROM prints JOIN firsts USING (h) WHERE (doc_id, i) > first),
gone AS (SELECT DISTINCT doc_id, unnest(range(a, b + 1)) AS p FROM later),
runs AS (
  SELECT doc_id, count(*) AS n_runs
  FROM gone AS a ANTI JOIN (SELECT doc_id, p + 1 AS p FROM gone) AS b USING (doc_id, p) GROUP BY 1),
kept AS (
  SELECT doc_id, string_agg(line, chr(10) ORDER BY i) AS k, count(*) AS n
  FROM lines ANTI JOIN (SELECT doc_id, p AS i FROM gone) AS g USING (doc_id, i) GROUP BY 1)
SELECT d.doc_id, len(w)::BIGINT AS n_lines, (len(w) - coalesce(n, 0))::BIGINT AS n_removed,
       coalesce(n_runs, 0)::BIGINT AS n_runs,
       sha256(CASE WHEN n_runs IS NULL THEN d.t ELSE coalesce(k, '') END) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id) LEFT JOIN runs USING (doc_id)
"""
