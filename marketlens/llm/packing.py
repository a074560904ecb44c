"""Best-fit packing with certified bin counts (operator 6).

1. ``pieces``: every text is tokenised whole (plus the end id); only documents
   longer than a sequence are cut, into pieces of the full length.  The narrow
   piece table is written to the shared folder once.  A full piece is a
   sequence of its own.
2. The other pieces are dealt at random into groups of about ``GROUP`` pieces;
   each group runs best-fit decreasing.  Dual feasible functions bound the
   bins that any packing of the group needs; a group that meets its bound is
   certified and is done.  ``certificates`` returns both numbers per group.
3. Groups with a gap exchange documents: their pieces are dealt anew into
   groups and best-fit decreasing runs again.
4. A certified group may still have bins that are not full (emptier than
   ``EXCHANGE`` of a sequence).  Their pieces join the exchange.  Rounds end
   when an exchange needs no fewer bins, and that exchange is not used.

Every group is bounded, so no task sees all pieces.  Null text: empty, one
piece that holds the end id alone.  Null id: kept as null.  Rows that repeat an
id are packed each.  Empty table: empty result.

The tokenizer splits texts at white space, and letters from punctuation, and
never merges across a split, so each worker remembers the ids of words (about
``REMEMBERED``) and tokenises only new ones.  A new word of lower-case Latin
letters, which the tokenizer's normaliser and splitter leave as it is, goes to
its merges at once; any other goes through the whole tokenizer.  The strings of
special tokens in a text get their ids, as in the library's plain call.
"""

from __future__ import annotations

import os
import re
import unicodedata
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from .common import MEMORIES, _struct, map_slices, raw, real_id, record, stored, whole_id, whole_text

LENGTH, END = 4096, 1
GROUP = 20_000
#: Fill below which a group's bins are dealt out again at the end.
EXCHANGE = 0.97
ROUNDS = 3
REMEMBERED = 500_000
_TOKENIZERS: dict[str, tuple] = MEMORIES.setdefault("words", {})


#: Between a letter and ASCII punctuation other than an apostrophe the
#: tokenizer's own pattern always splits.
_SPLIT = re.compile(rb"(?<=[a-z])(?=[!-&(-/:-@\[-`{-~])")
#: How byte-level BPE writes a byte: printable Latin-1 as itself, the others
#: from U+0100 on, in order.
_SHOWN = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTE = {b: chr(b) for b in _SHOWN} | {b: chr(256 + k) for k, b in enumerate(b for b in range(256) if b not in _SHOWN)}


def words(text: bytes) -> list[bytes]:
    """Words that the tokenizer treats alone, ASCII letters in lower case."""
    return _SPLIT.sub(b" ", text.lower()).split()


def text_bytes(path: str):
    """A function from texts to their ids as little-endian 32-bit bytes."""
    if path not in _TOKENIZERS:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        # the library finds special tokens in the raw text, before it normalises what lies between them
        special = {t.content.encode(): np.array([i], "<u4").tobytes() for i, t in tokenizer.get_added_tokens_decoder().items()}
        tokenizer.encode_special_tokens = True  # a word that only looks like one once in lower case is ordinary text
        _TOKENIZERS[path] = tokenizer, tokenizer.model, special, {}
    tokenizer, model, special, known = _TOKENIZERS[path]
    cut = re.compile(b"(" + b"|".join(map(re.escape, sorted(special, key=len, reverse=True))) + b")")

    def new_word(word: bytes) -> list[int]:
        if word.isalpha():  # ASCII letters in lower case: one piece, for the merges alone
            return [t.id for t in model.tokenize(word.decode())]
        text = word.decode("utf-8", "replace")
        low = text.lower()
        if max(low) < "\u0250" and len(low) == len(text) and low.isalpha() and unicodedata.is_normalized("NFC", text):
            return [t.id for t in model.tokenize("".join(map(_BYTE.__getitem__, low.encode())))]
        return tokenizer.encode(text, add_special_tokens=False).ids

    def ids(some: list[bytes]) -> bytes:
        try:
            return b"".join(map(known.__getitem__, some))
        except KeyError:
            pass
        if len(known) > REMEMBERED:
            known.clear()
        for w in set(some):
            if w not in known:
                known[w] = np.array(new_word(w), "<u4").tobytes()
        return b"".join(map(known.__getitem__, some))

    def coded(text: bytes) -> bytes:
        if not special or not cut.search(text):
            return ids(words(text))
        return b"".join(special.get(part) or ids(words(part)) for part in cut.split(text))

    return coded


def pieces(docs: DataFrame, path: str, length: int = LENGTH, end: int = END) -> DataFrame:
    """(id, piece, start, length, ids_crc32) of every piece."""
    tail = np.array([end], "<u4").tobytes()

    def rows(part):
        ids = text_bytes(path)
        out = {"id": [], "piece": [], "start": [], "length": [], "ids_crc32": []}
        data, off = raw(part.column("body"))
        for doc, a, b in zip(part.column("id").to_pylist(), off[:-1], off[1:], strict=True):
            coded = ids(data[a:b].tobytes()) + tail
            for k in range(0, len(coded), 4 * length):
                some = coded[k:k + 4 * length]
                out["id"].append(doc)
                out["piece"].append(k // (4 * length))
                out["start"].append(k // 4)
                out["length"].append(len(some) // 4)
                out["ids_crc32"].append(zlib.crc32(some))
        return out

    return map_slices(docs, rows, "id long, piece int, start long, length long, ids_crc32 long", memory="words")


def best_fit_decreasing(lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, int]:
    """(bin, offset, number of bins): each item, longest first, goes to the
    fullest bin that it fits; bins are kept by the room that they have."""
    order = np.argsort(-lengths, kind="stable")
    room = [[] for _ in range(size + 1)]
    some = bytearray(size + 2)  # which rooms have a bin
    place, offset, n = np.empty(lengths.size, np.int64), np.empty(lengths.size, np.int64), 0
    for i, x in zip(order.tolist(), lengths[order].tolist(), strict=True):
        r = some.find(1, x)
        if r < 0:
            r, k = size, n
            n += 1
        else:
            k = room[r].pop()
            if not room[r]:
                some[r] = 0
        place[i], offset[i] = k, size - r
        room[r - x].append(k)
        some[r - x] = 1
    return place, offset, n


def lower_bound(lengths: np.ndarray, size: int) -> int:
    """Bins that any packing needs, by dual feasible functions: functions u
    with sum u(x) <= 1 over what fits one bin bound the bins by sum u(x).
    Tried: the identity, the cuts of Martello and Toth, and the rounding
    functions of Fekete and Schepers."""
    if not lengths.size:
        return 0
    count = np.bincount(lengths, minlength=size + 1).astype(np.int64)
    x = np.arange(size + 1, dtype=np.int64)
    best = -(-int(count @ x) // size)
    above = np.cumsum(count[::-1])[::-1]  # items of at least x
    below = np.cumsum(count * x)
    for cut in range(1, size // 2 + 1):  # 1 above size - cut, 0 below cut, else x
        many = int(above[size - cut + 1])
        best = max(best, many - (-int(below[size - cut] - below[cut - 1]) // size))
    for k in range(1, 33):  # (k + 1) x / size rounded down, over k; whole multiples stay x
        whole = (k + 1) * x % size == 0
        value = np.where(whole, (k + 1) * x * k, (k + 1) * x // size * (size * (k + 1)))  # over k (k + 1) size
        total = int(count @ value)
        best = max(best, -(-total // (k * (k + 1) * size)))
    return best


PACKED = "row long, length long, pack long, bin long, offset long, bins long, bound long, fill long"


def pack_groups(rows: DataFrame, size: int, number: int, pack: int) -> DataFrame:
    """Deal (row, length) into groups at random and pack each group."""
    target = to_arrow_schema(_struct(PACKED))
    dealt = rows.select("row", "length", F.pmod(F.xxhash64("row", F.lit(pack)), F.lit(number)).alias("group"))

    def run(table: pa.Table) -> pa.Table:
        # by row, so that the packing doesn't hang on the order of arrival
        table = table.sort_by("row")
        lengths = table.column("length").to_numpy()
        place, offset, n = best_fit_decreasing(lengths, size)
        fill = np.bincount(place, weights=lengths, minlength=n).astype(np.int64)
        group = table.column("group")[0].as_py()
        full = np.full(lengths.size, 1, np.int64)
        return pa.Table.from_batches([record({
            "row": table.column("row").combine_chunks(), "length": lengths, "pack": full * (((pack + 1) << 38) + group), "bin": place,
            "offset": offset, "bins": full * n, "bound": full * lower_bound(lengths, size), "fill": fill[place]}, target)])

    return dealt.groupBy("group").applyInArrow(run, PACKED)


def pack(lengths: DataFrame, size: int = LENGTH, group: int = GROUP, rounds: int = ROUNDS) -> DataFrame:
    """Pack (row, length) with length < size: PACKED rows, where pack and bin
    name a bin, and bins and bound are its group's count and lower bound."""
    number = max(1, round(lengths.count() / group))
    now = stored(pack_groups(lengths, size, number, 0), "packed")
    closed = []
    # a group over its bound exchanges all its documents, a certified one
    # those of its bins that are not full
    again = (F.col("bins") > F.col("bound")) | (F.col("fill") < F.lit(EXCHANGE * size))
    for k in range(1, rounds + 1):
        if number == 1:
            break
        open_ = now.where(again)
        bins, left = open_.groupBy("pack", "bin").count().agg(F.count(F.lit(1)), F.coalesce(F.sum("count"), F.lit(0))).first()
        number = max(1, round(left / group))
        if bins < 2:
            break
        dealt = stored(pack_groups(open_, size, number, k), "packed")
        if dealt.select("pack", "bin").distinct().count() >= bins:
            break
        closed.append(now.where(~again))
        now = dealt
    for part in closed:
        now = now.unionByName(part)
    return now


def certificates(packed: DataFrame) -> DataFrame:
    """Per group as it was packed last: bins used and the lower bound."""
    return packed.select("pack", "bins", "bound").distinct()


def packed_pieces(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
                  end: int = END, group: int = GROUP, rounds: int = ROUNDS) -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32, sequence_id and
    offset.  ``path`` is the tokenizer's file, the same on every machine."""
    cut = pieces(df.select(whole_id(id_col), whole_text(text_col)), path, length, end)
    # numbered as they are written: how the files are split when read back must not matter
    cut = stored(cut.withColumn("row", F.monotonically_increasing_id()), "pieces")
    bins = pack(cut.where(F.col("length") < length).select("row", "length"), length, group, rounds)
    # numbers of bins lie above all row numbers, which name the full pieces
    bins = bins.select("row", (F.shiftleft("pack", 20) + F.col("bin")).alias("sequence_id"), "offset")
    return (cut.where(F.col("length") < length).join(bins, "row")
            .unionByName(cut.where(F.col("length") >= length).withColumns({"sequence_id": F.col("row"), "offset": F.lit(0).cast("long")}))
            .drop("row"))


def digest(df: DataFrame) -> DataFrame:
    """The contract's columns of query op6."""
    import public_tokenizers

    rows = packed_pieces(df, public_tokenizers.path("word_bpe_49k.json"))
    return rows.select(real_id("id").alias("doc_id"), "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
