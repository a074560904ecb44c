"""Byte-level BPE encoding and decoding with tiktoken and a local rank file
(operator 5).

Texts are encoded whole.  A long text is first cut at safe boundaries: the
split pattern never lets a match run from a character that isn't white space
into a space, nor from a letter into a digit or back, and never looks behind,
so a cut there changes no match; the pieces' ids are joined.  The pieces keep
the regex and merge loops of the library on short strings.  (A single match
without such a boundary stays whole, as its merges depend on all of it.)

Decoding joins the raw bytes of the ids, without any UTF-8 repair.

Null or empty text: no ids, zero bytes.  Special tokens' strings are ordinary
text.  Null id: kept as null.  Rows that repeat are encoded each.  Empty table:
empty result.
"""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import MEMORIES, map_slices, raw, real_id, whole_id, whole_text

#: Characters above which a text is cut, and of a cut piece.
LONG = 16_384
_CODERS: dict[str, tuple] = MEMORIES.setdefault("ranks", {})


def coder(path: str, pattern: str):
    """(encoding, decimal string of each id), once a worker."""
    if path not in _CODERS:
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}
        encoding = tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        _CODERS[path] = encoding, [str(i) for i in range(max(ranks.values()) + 1)]
    return _CODERS[path]


def safe_pieces(text: str, size: int = LONG) -> list[str]:
    """The text in pieces of about ``size`` characters, cut only where no match
    can cross: before a space after other than white space, or between a
    letter and a decimal digit."""
    import regex

    if len(text) <= size:
        return [text]
    boundary = regex.compile(r"(?<=\S) |(?<=\p{L})(?=\p{Nd})|(?<=\p{Nd})(?=\p{L})")
    out, lo = [], 0
    while len(text) - lo > size:
        m = boundary.search(text, lo + size)
        if m is None or m.start() >= len(text):
            break
        out.append(text[lo:m.start()])
        lo = m.start()
    return [*out, text[lo:]]


def encode(encoding, text: str, size: int = LONG) -> list[int]:
    if len(text) <= size:
        return encoding.encode_ordinary(text)
    ids: list[int] = []
    for piece in safe_pieces(text, size):
        ids += encoding.encode_ordinary(piece)
    return ids


def encoded(df: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids): the token ids of every whole text."""
    def rows(part):
        encoding, _ = coder(path, pattern)
        return {"id": part.column("id"), "ids": [np.array(encode(encoding, t), np.int32) for t in _texts(part)]}

    return map_slices(df.select(whole_id(id_col), whole_text(text_col)), rows, "id long, ids array<int>", memory="ranks")


def decoded(df: DataFrame, path: str, pattern: str, ids_col: str = "ids", out_col: str = "body") -> DataFrame:
    """(id, raw bytes) of a table with id and ids; null ids: no bytes."""
    def run(batches):
        encoding, _ = coder(path, pattern)
        for batch in batches:
            ids = batch.column(ids_col).to_pylist()
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array([encoding.decode_bytes(x or []) for x in ids], pa.binary())],
                                             ["id", out_col])

    return df.select("id", ids_col).mapInArrow(run, f"id long, {out_col} binary")


def _texts(part: pa.RecordBatch):
    data, off = raw(part.column("body"))
    for a, b in zip(off[:-1], off[1:], strict=True):
        yield data[a:b].tobytes().decode("utf-8", "replace")


def digest(df: DataFrame) -> DataFrame:
    """The contract's columns of query op5: each text's ids are decoded again
    in the task that made them, so ids and texts never leave it."""
    import public_tokenizers

    path, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN

    def rows(part):
        encoding, decimal = coder(path, pattern)
        out = {"id": part.column("id"), "n_tokens": [], "ids_sha256": [], "decoded_sha256": []}
        for text in _texts(part):
            ids = encode(encoding, text)
            out["n_tokens"].append(len(ids))
            out["ids_sha256"].append(hashlib.sha256(",".join(map(decimal.__getitem__, ids)).encode()).hexdigest())
            out["decoded_sha256"].append(hashlib.sha256(encoding.decode_bytes(ids)).hexdigest())
        return out

    coded = map_slices(df.select(whole_id("doc_id"), whole_text("text")), rows,
                       "id long, n_tokens long, ids_sha256 string, decoded_sha256 string", memory="ranks")
    return coded.select(real_id("id").alias("doc_id"), "n_tokens", "ids_sha256", "decoded_sha256")
