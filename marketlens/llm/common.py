"""Column selection, Arrow slices, shared intermediate tables and the
fixed-size slot filter used by several operators."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

#: Stands for a null id inside an operator, so that null ids sort last.
NO_ID = (1 << 63) - 1
#: Bytes of text that one numpy step handles.
SLICE_BYTES = 1 << 20
#: log2 of the bits of a slot filter: 8 MiB, whatever the input size.
SLOT_BITS = 26


def bodies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, body): the id with nulls as NO_ID, the whole text as UTF-8 bytes."""
    return df.select(whole_id(id_col), whole_text(text_col))


def whole_id(id_col: str):
    return F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("id")


def whole_text(text_col: str):
    return F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("body")


def text_key(text_col: str):
    """64-bit hash of the whole text: with the id it names a document even
    where an id repeats with different texts."""
    return F.xxhash64(whole_text(text_col)).alias("text_key")


def real_id(name: str):
    """Undo the NO_ID replacement."""
    return F.when(F.col(name) != NO_ID, F.col(name))


def raw(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a binary Arrow column without nulls."""
    _, off, data = column.buffers()
    kind = np.int64 if pa.types.is_large_binary(column.type) else np.int32
    off = np.frombuffer(off, kind)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    return (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)), off


def slices(batch: pa.RecordBatch, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Row ranges of a batch whose ``body`` holds at most ``limit`` bytes (a
    longer text stands alone)."""
    if not batch.num_rows:
        return
    _, off = raw(batch.column("body"))
    lo, n = 0, batch.num_rows
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + limit, side="right")) - 1)
        yield batch.slice(lo, min(hi, n) - lo)
        lo = min(hi, n)


def map_slices(df: DataFrame, fn, schema: str, limit: int = SLICE_BYTES, slots=None, hit: bool = True,
               memory: str | None = None) -> DataFrame:
    """mapInArrow over slices; ``fn(slice) -> dict of columns`` (or None).
    With a slot filter, only rows whose text_key is (or is not) in it, in the
    same Python worker.  ``memory`` names the worker memory that ``fn`` uses;
    the others are emptied."""
    from pyspark.sql.pandas.types import to_arrow_schema

    target = to_arrow_schema(_struct(schema))

    def run(batches):
        for name, kept in MEMORIES.items():
            if name != memory:
                kept.clear()
        for batch in batches:
            if slots is not None:
                batch = batch.filter(pa.array(in_slots(slots.value, batch.column("text_key").to_numpy()) == hit))
            for part in slices(batch, limit):
                out = fn(part)
                if out is not None:
                    yield record(out, target)
        give_back()

    return df.mapInArrow(run, schema)


def sum_slices(df: DataFrame, start, schema: str, limit: int = SLICE_BYTES) -> DataFrame:
    """mapInArrow over slices for sums of a task: ``start() -> (rows, rest)`` is
    called once a task; ``rows(slice)`` yields dicts of columns where it must,
    ``rest()`` returns what is left after the last slice (or None)."""
    from pyspark.sql.pandas.types import to_arrow_schema

    target = to_arrow_schema(_struct(schema))

    def run(batches):
        for kept in MEMORIES.values():
            kept.clear()
        rows, rest = start()
        for batch in batches:
            for part in slices(batch, limit):
                for out in rows(part):
                    yield record(out, target)
        if (out := rest()) is not None:
            yield record(out, target)
        give_back()

    return df.mapInArrow(run, schema)


#: What operators remember in a Python worker between tasks, by name.
MEMORIES: dict[str, dict] = {}


def give_back() -> None:
    """Return freed memory to the system: Python workers outlive their tasks."""
    import ctypes

    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim:
        trim(0)


def record(columns: dict, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c := columns[f.name], pa.Array) else pa.array(c, f.type) for f in schema], schema=schema)


def _struct(schema: str):
    from pyspark.sql.types import StructType

    return StructType.fromDDL(schema)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared checkpoint folder and read it back: cuts
    the lineage, survives lost executors, and is compressed and columnar."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def slot_filter(keys: DataFrame, key: str, bits: int = SLOT_BITS):
    """Broadcast bitmap of ``key mod 2**bits``.  Its size is fixed by ``bits``
    (8 MiB by default) however many keys there are; a slot shared with
    another key only lets extra rows through, which the exact join after it
    removes, so nothing is ever lost."""
    slot = F.pmod(F.col(key), F.lit(1 << bits))
    words = keys.where(F.col(key).isNotNull()).select(slot.alias("slot")).selectExpr(
        "shiftright(slot, 6) as word", "shiftleft(1L, cast(slot & 63 as int)) as bit")
    table = words.groupBy("word").agg(F.bit_or("bit").alias("bit")).toArrow()  # at most 2**(bits - 6) rows
    bitmap = np.zeros(1 << (bits - 6), np.int64)
    bitmap[table.column("word").to_numpy()] = table.column("bit").to_numpy()
    return keys.sparkSession.sparkContext.broadcast(bitmap.view(np.uint64))


def in_slots(bitmap: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which 64-bit keys have their slot set."""
    slot = keys.view(np.uint64) & np.uint64(bitmap.size * 64 - 1)
    return (bitmap[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63))) & np.uint64(1) != 0


def passing(df: DataFrame, slots, hit: bool, key: str = "text_key") -> DataFrame:
    """Rows whose key is (or is not) in the slot filter; nothing is shuffled."""
    def run(batches):
        for batch in batches:
            mask = in_slots(slots.value, batch.column(key).to_numpy())
            if (kept := batch.filter(pa.array(mask == hit))).num_rows:
                yield kept

    return df.mapInArrow(run, df.schema)


def rows_without(df: DataFrame, dropped: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The rows of ``df`` that no (id, text_key) of ``dropped`` names.  Rows
    that can't be named there never leave their scan task."""
    dropped = stored(dropped.select("id", "text_key").distinct(), "dropped")
    slots = slot_filter(dropped, "text_key")
    keyed = df.select(F.struct(*[F.col(c) for c in df.columns]).alias("row"), whole_id(id_col), text_key(text_col))
    left = passing(keyed, slots, True).join(dropped, ["id", "text_key"], "left_anti")
    return passing(keyed, slots, False).unionByName(left.select("row", "id", "text_key")).select("row.*")


def one_of_each(df: DataFrame, named: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The rows of ``df`` that no (id, text_key) of ``named`` names, and one
    row of each that it names as ``kept``."""
    twins = named.where("kept")
    slots = slot_filter(twins, "text_key")
    keyed = df.select(F.struct(*[F.col(c) for c in df.columns]).alias("row"), whole_id(id_col), text_key(text_col))
    one = (passing(keyed, slots, True).join(twins.select("id", "text_key"), ["id", "text_key"], "left_semi")
           .groupBy("id", "text_key").agg(F.first("row").alias("row")).select("row.*"))
    return rows_without(df, named, id_col, text_col).unionByName(one)


def ship(spark) -> None:
    """Send this package to the executors, once a session, for sessions that
    were started without it on the executors' Python path."""
    import os
    import tempfile
    import zipfile

    import marketlens

    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    top = os.path.dirname(os.path.abspath(marketlens.__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="marketlens-py-"), "marketlens_package.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, files in os.walk(top):
            for f in sorted(files):
                if f.endswith(".py"):
                    full = os.path.join(folder, f)
                    z.write(full, os.path.join("marketlens", os.path.relpath(full, top)))
    sc.addPyFile(path)  # the driver serves it to every executor
    _SHIPPED.add(sc.applicationId)


_SHIPPED: set[str] = set()


#: Rows and bytes of an Arrow batch; the slices cut it further.
BATCH_ROWS, BATCH_BYTES = 2000, 4 << 20


def prepare(spark) -> None:
    """Send the package and bound the Arrow batches of this session."""
    ship(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
