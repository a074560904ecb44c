"""Repeated windows of words or lines: the shared engine of line
deduplication (winnowing) and substring deduplication (Rabin-Karp windows).

1. ``window_minima``: every window of ``window`` units picks the smallest hash
   of the ``gram``-unit runs inside it.  Equal windows pick equal minima, so a
   window can only repeat elsewhere if its minimum does.  Windows that pick the
   same run give one row, about 2 / (window - gram + 2) rows a unit.
2. Minima found at two places or more are counted in Spark (map-side combined,
   so a minimum that a third of all documents hold is one row a task) and
   become a fixed-size slot filter.
3. ``candidates``: full window hashes, only where the filter lets them through.
   They are counted in Spark with their first place; a window that starts at a
   later place is covered.  Every window is compared with the first place that
   holds its whole sequence, never with all other places, so no pairs of a
   group are emitted and no match is lost.  Adjacent covered windows merge: a
   match extends both ways as far as its units agree.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import hashing as H
from .common import in_slots, map_slices, passing, raw, slot_filter, stored, text_key, whole_id, whole_text


def _windows(part: pa.RecordBatch, breaks: np.ndarray, window: int, gram: int):
    """(unit hashes, text index and start of every window, its minimum)."""
    data, off = raw(part.column("body"))
    starts, ends, bounds = H.spans(data, off, breaks)
    if starts.size < window:
        return None
    h = H.range_hashes(data, starts, ends)
    lowest = H.sliding_min(H.window_hashes(h, gram), window - gram + 1)
    text = np.repeat(np.arange(off.size - 1), np.diff(bounds))[:lowest.size]
    at = np.flatnonzero(np.arange(lowest.size) + window <= bounds[text + 1])
    return h, bounds, text[at], at, lowest[at]


def window_minima(docs: DataFrame, breaks: np.ndarray, window: int, gram: int, places: bool) -> DataFrame:
    """(low, id, pos), with ``places`` also text_key: each text's window minima,
    with the place of the run that was picked if ``places``, else once for
    adjacent windows (pos 0)."""
    def rows(part):
        found = _windows(part, breaks, window, gram)
        if found is None:
            return None
        h, bounds, text, at, low = found
        pos = np.zeros(low.size, np.int64)
        if places:  # the first of the equal runs in the window
            grams = H.window_hashes(h, gram)
            for k in range(window - gram, -1, -1):
                pos = np.where(grams[at + k] == low, at + k - bounds[text], pos)
        new = np.ones(low.size, bool)
        new[1:] = (low[1:] != low[:-1]) | (text[1:] != text[:-1]) | (pos[1:] != pos[:-1])
        named = {c: part.column(c).to_numpy()[text[new]] for c in name}
        return {"low": low[new].view(np.int64), "pos": pos[new].astype(np.int32)} | named

    name = ["id", "text_key"] if places else ["id"]
    return map_slices(docs.select(*name, "body"), rows, ", ".join(["low long", *[f"{c} long" for c in name], "pos int"]))


def candidates(docs: DataFrame, breaks: np.ndarray, window: int, gram: int, slots) -> DataFrame:
    """(h, check, id, text_key, pos) of every window whose minimum is in the
    slot filter; h and check are independent hashes of the whole window."""
    def rows(part):
        found = _windows(part, breaks, window, gram)
        if found is None:
            return None
        h, bounds, text, at, low = found
        hit = in_slots(slots.value, low.view(np.int64))
        if not hit.any():
            return None
        text, at = text[hit], at[hit]
        return {"h": H.window_hashes(h, window)[at].view(np.int64),
                "check": H.window_hashes(h, window, H.WINDOW_BASE_2)[at].view(np.int64),
                "id": part.column("id").to_numpy()[text], "text_key": part.column("text_key").to_numpy()[text],
                "pos": (at - bounds[text]).astype(np.int32)}

    return map_slices(docs, rows, "h long, check long, id long, text_key long, pos int")


def covered(docs: DataFrame, breaks: np.ndarray, window: int, gram: int, across: bool) -> DataFrame:
    """(id, text_key, starts): the windows of each text that repeat an earlier
    place.  ``across``: earlier is a smaller id only; else also an earlier
    start in the same text.  A list holds each start once, combined in the
    tasks, so it is bounded by its text's length however many rows repeat it."""
    minima = window_minima(docs, breaks, window, gram, not across)
    if across:
        repeated = minima.groupBy("low").agg(F.min("id").alias("a"), F.max("id").alias("b")).where("a < b")
    else:
        place = F.struct("id", "text_key", "pos")
        repeated = minima.groupBy("low").agg(F.min(place).alias("a"), F.max(place).alias("b")).where("a < b")
    slots = slot_filter(repeated, "low")
    rows = candidates(docs, breaks, window, gram, slots)
    if across:
        first = rows.groupBy("h", "check").agg(F.min("id").alias("first"), F.max("id").alias("last")).where("first < last")
        later = F.col("id") > F.col("first")
    else:
        first = rows.groupBy("h", "check").agg(F.min(place).alias("first"), F.max(place).alias("last")).where("first < last")
        later = place > F.col("first")
    # written out, so that the join below shuffles both sides itself and
    # adaptive execution can split a window that very many documents hold
    first = stored(first.select("h", "check", "first"), "first-windows")
    return (rows.join(first, ["h", "check"]).where(later).groupBy("id", "text_key")
            .agg(F.sort_array(F.collect_set("pos")).alias("starts")))


def cover(n: int, starts: np.ndarray, window: int) -> np.ndarray:
    """Which of n units lie in a window of the starts."""
    edge = np.zeros(n + 1, np.int32)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + window, -1)
    return np.cumsum(edge[:n]) > 0


def merged(mask: np.ndarray) -> list[dict]:
    """Maximal runs of a mask, ends excluded."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], mask.view(np.int8), [0]])))
    return [{"start": int(a), "end": int(b)} for a, b in zip(edge[::2], edge[1::2], strict=True)]


def without_repeats(df: DataFrame, id_col: str, text_col: str, breaks: np.ndarray, window: int, gram: int,
                    across: bool, joiner: bytes, whole: bool, carry: list[str]) -> DataFrame:
    """One row per input row: the columns of ``carry``, n_units, n_removed,
    removed (maximal intervals of units) and kept, the text of the units left.

    ``whole``: a text of which nothing is removed keeps its own bytes; else
    its units are joined like any other's.  Texts without a covered window
    never leave their scan task: the slot filter over text keys picks those
    that may have one, and only they are shuffled to meet their windows.
    """
    full = df.select(F.struct(*[F.col(c) for c in carry]).alias("row"), whole_id(id_col), whole_text(text_col), text_key(text_col))
    lists = stored(covered(full.drop("row"), breaks, window, gram, across), "covered-windows")
    slots = slot_filter(lists, "text_key")
    row = full.schema["row"].dataType.simpleString()

    def units(data, a, b):
        s, e, _ = H.spans(data, np.array([a, b]), breaks)
        return s, e

    def texts(part, starts):
        data, off = raw(part.column("body"))
        _, _, bounds = H.spans(data, off, breaks)
        n, gone, runs, kept = np.diff(bounds), [], [], []
        for i in range(part.num_rows):
            body = data[off[i]:off[i + 1]].tobytes()
            if starts is None or starts[i] is None or n[i] < window:
                gone.append(0)
                runs.append([])
                kept.append(body if whole else joiner.join(body.split()))
                continue
            s, e = units(data, off[i], off[i + 1])
            mask = cover(int(n[i]), np.asarray(starts[i], np.int64), window)
            gone.append(int(mask.sum()))
            runs.append(merged(mask))
            kept.append(joiner.join(data[a:b].tobytes() for a, b in zip(s[~mask], e[~mask], strict=True)))
        return {"row": part.column("row"), "n_units": n, "n_removed": gone, "removed": runs, "kept": kept}

    out = f"row {row}, n_units long, n_removed long, removed array<struct<start:long,end:long>>, kept binary"

    kept = map_slices(full, lambda p: texts(p, None), out, slots=slots, hit=False)
    hits = passing(full, slots, True).join(lists, ["id", "text_key"], "left")
    cut = map_slices(hits.select("row", "body", "starts"), lambda p: texts(p, p.column("starts").to_pylist()), out)
    both = kept.unionByName(cut)
    return both.select(*[F.col("row").getField(c).alias(c) for c in carry], "n_units", "n_removed", "removed",
                       F.col("kept").cast("string").alias("kept"))
