"""Substring deduplication (operator 10): Rabin-Karp hashes of every
fixed-length window of words, counted in Spark; repeated windows merge into
maximal removal intervals.

A word is a run of bytes other than space and 0x09-0x0D.  A word goes if a
window of ``window`` consecutive words that covers it also starts in a
document with a smaller id.  Windows are judged on the input texts.

Null or blank text: no words, nothing removed, kept is empty.  Texts shorter
than the window: nothing removed.  Null id: after every other id.  Rows that
repeat an id: the id is not smaller than itself, so they don't remove each
other.  Empty table: empty result.  Very long texts are hashed whole, in
steps of a megabyte.

A window is identified by two independent 64-bit hashes, 128 bits in all.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import hashing as H
from .repeats import without_repeats

WINDOW = 50
#: Words of the runs whose minimum a window picks (see repeats.py).
GRAM = 16


def remove_repeated_windows(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                            gram: int = GRAM, carry: list[str] | None = None, untouched: bool = False) -> DataFrame:
    """One row per input row: ``carry`` (default: the id column), n_words,
    n_removed, removed (array of [start, end) word intervals) and kept (the
    words left, joined by one space; with ``untouched``, a text that loses
    nothing as it is)."""
    if not 0 < gram <= window:
        raise ValueError("gram must be from 1 to window")
    return without_repeats(df, id_col, text_col, H.WHITE, window, gram, True, b" ", untouched,
                           carry or [id_col]).withColumnRenamed("n_units", "n_words")


def digest(df: DataFrame) -> DataFrame:
    """The contract's columns of query op10."""
    return remove_repeated_windows(df).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


#: Windows of 50 words as text; the first document of each; covered words.
SQL = r"""
WITH d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
windows AS (
  SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS h
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d WHERE len(w) >= 50)),
firsts AS (SELECT h, min(doc_id) AS first FROM windows GROUP BY h HAVING min(doc_id) < max(doc_id)),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS p
  FROM windows JOIN firsts USING (h) WHERE doc_id > first),
words AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS p, unnest(w) AS word FROM d WHERE len(w) > 0),
kept AS (
  SELECT words.doc_id, string_agg(word, ' ' ORDER BY p) AS t, count(*) AS n
  FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY 1)
SELECT d.doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""
