"""Centroid clustering (operator 13): exact k-means over integer vectors with
zone maps on a space-filling curve.

1. A vector is kept if it has exactly ``dims`` components, none null or
   non-finite; each becomes the integer floor(scale * x).
2. The kept vectors are put in the order of a Hilbert curve (Skilling,
   "Programming the Hilbert curve", 2004) over the ``CURVE_DIMS`` components of
   largest variance, ``CURVE_BITS`` bits each, and cut into blocks of ``BLOCK``
   with their smallest and largest components (the zone map) and their sum.
   The curve only decides which vectors share a block, never a result.
3. In a round, the squared distances from each centroid to the block's box give
   a lower and an upper bound; a centroid whose lower bound is above the least
   upper bound can be nearest to no vector of the block.  If one candidate is
   left, it gets the block's stored sum; otherwise the vectors are compared
   with the candidates only, exactly (ties: the smaller number).  Tasks return
   a row a centroid; the driver sees ``k`` x ``dims`` sums.

The order costs one shuffle, by ranges of (curve position, hash of id and scan
task), so that many equal vectors still spread over the tasks; the blocks are
written once and read by every round.

Centroids start as the ``k`` kept vectors with the smallest SHA-256 of
"<salt>:<id>" (equal ids: the smaller components; null ids last); fewer vectors
give fewer centroids.  Empty centroids stay where they are.  Null id: kept.
Repeated rows: each counts.  Empty table, or no kept vector: empty result.
Vectors with a component beyond +-2**27 after scaling are left out like
non-finite ones: their squared distances don't fit a long.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

K, DIMS, ROUNDS, SCALE, SALT = 40, 64, 5, 256.0, "2"
BLOCK = 512
CURVE_DIMS, CURVE_BITS = 16, 4
#: Largest component for which 64 squared differences fit a long.
LIMIT = 1 << 27
_BLOCKS = "n int, ids array<bigint>, vectors binary, low binary, high binary, total binary"


def kept_vectors(df: DataFrame, id_col: str, vector_col: str, dims: int, scale: float) -> DataFrame:
    """(id, v): the integer vectors as little-endian 32-bit integers."""
    e = F.col("e")
    sound = F.forall("e", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x * scale) <= float(LIMIT)))
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("e"))
    rows = rows.where((F.size(e) == dims) & F.coalesce(sound, F.lit(False)))

    def run(batches):
        for batch in batches:
            v = np.floor(scale * batch.column("e").flatten().to_numpy()).astype("<i4")
            yield pa.RecordBatch.from_arrays([batch.column("id"), binaries(v.reshape(-1, dims))], ["id", "v"])

    return rows.mapInArrow(run, "id long, v binary")


def binaries(rows: np.ndarray) -> pa.Array:
    """A binary value for each row of a matrix."""
    width = rows.shape[1] * rows.itemsize
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(np.arange(0, (len(rows) + 1) * width, width, np.int32)),
                                                          pa.py_buffer(np.ascontiguousarray(rows))])


def matrix(column: pa.Array, dims: int, kind: str = "<i4") -> np.ndarray:
    """Rows of a binary column as a matrix; each value may hold several rows."""
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, dims).astype(np.int64)


def hilbert(x: np.ndarray, bits: int) -> np.ndarray:
    """Position on the Hilbert curve of points with coordinates below 2**bits;
    at most 64 bits in all, as unsigned numbers."""
    x = x.astype(np.uint64).T.copy()
    one = np.uint64(1)
    for b in range(bits - 1, 0, -1):
        low = np.uint64((1 << b) - 1)
        for i in range(len(x)):
            high = (x[i] >> np.uint64(b)) & one != 0
            swap = np.where(high, np.uint64(0), (x[0] ^ x[i]) & low)
            x[0] ^= np.where(high, low, swap)
            x[i] ^= swap
    for i in range(1, len(x)):
        x[i] ^= x[i - 1]
    flip = np.zeros(x.shape[1], np.uint64)
    for b in range(bits - 1, 0, -1):
        flip ^= np.where((x[-1] >> np.uint64(b)) & one != 0, np.uint64((1 << b) - 1), np.uint64(0))
    key = np.zeros(x.shape[1], np.uint64)
    for b in range(bits - 1, -1, -1):
        for i in range(len(x)):
            key = (key << one) | (((x[i] ^ flip) >> np.uint64(b)) & one)
    return key


def spread(vectors: DataFrame, dims: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Smallest, largest component and variance of every dimension."""
    def run(batches):
        n, low, high, total, square = 0, np.full(dims, LIMIT), np.full(dims, -LIMIT), np.zeros(dims), np.zeros(dims)
        for batch in batches:
            v = matrix(batch.column("v"), dims)
            if len(v):
                n, low, high = n + len(v), np.minimum(low, v.min(0)), np.maximum(high, v.max(0))
                total, square = total + v.sum(0), square + (v.astype(float) ** 2).sum(0)
        if n:
            yield pa.RecordBatch.from_pydict({"dim": np.arange(dims, dtype=np.int32), "n": np.full(dims, n), "low": low, "high": high,
                                              "total": total, "square": square})

    rows = (vectors.select("v").mapInArrow(run, "dim int, n long, low long, high long, total double, square double").groupBy("dim")
            .agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"),
                 (F.sum("square") / F.sum("n") - F.pow(F.sum("total") / F.sum("n"), 2)).alias("variance")).orderBy("dim").collect())
    return (np.array([r[c] for r in rows]) for c in ("low", "high", "variance"))


def zone_map(vectors: DataFrame, dims: int, block: int) -> DataFrame:
    """Blocks of neighbours on the curve, with boxes and sums."""
    low, high, variance = spread(vectors, dims)
    if not len(low):
        return vectors.sparkSession.createDataFrame([], _BLOCKS)
    use = np.sort(np.argsort(-variance, kind="stable")[:CURVE_DIMS])
    base, width = low[use], np.maximum(high[use] - low[use] + 1, 1)

    def position(batches):
        for batch in batches:
            cell = (matrix(batch.column("v"), dims)[:, use] - base) * (1 << CURVE_BITS) // width
            key = (hilbert(cell, CURVE_BITS) ^ np.uint64(1 << 63)).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("v"), pa.array(key)], ["id", "v", "key"])

    def cut(batches):
        ids, parts, n = [], [], 0
        for batch in batches:
            lo = 0
            while lo < batch.num_rows:
                piece = batch.slice(lo, block - n)
                lo, n = lo + piece.num_rows, n + piece.num_rows
                ids.append(piece.column("id"))
                parts.append(matrix(piece.column("v"), dims))
                if n == block:
                    yield row(ids, parts)
                    ids, parts, n = [], [], 0
        if n:
            yield row(ids, parts)

    def row(ids, parts):
        v = np.concatenate(parts)
        one = [x.tobytes() for x in (v.astype("<i4"), v.min(0).astype("<i4"), v.max(0).astype("<i4"), v.sum(0).astype("<i8"))]
        return pa.RecordBatch.from_arrays(
            [pa.array([len(v)], pa.int32()), pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), pa.concat_arrays(ids)),
             *[pa.array([x], pa.binary()) for x in one]], ["n", "ids", "vectors", "low", "high", "total"])

    placed = vectors.mapInArrow(position, "id long, v binary, key long").withColumn("task", F.spark_partition_id())
    ordered = placed.repartitionByRange("key", F.xxhash64("id", "task")).sortWithinPartitions("key")
    return ordered.select("id", "v").mapInArrow(cut, _BLOCKS)


def candidates(low: np.ndarray, high: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Centroids that can be nearest to a vector of the box."""
    near = np.maximum(np.maximum(low - centroids, centroids - high), 0)
    far = np.maximum(np.abs(centroids - low), np.abs(centroids - high))
    return np.flatnonzero((near ** 2).sum(1) <= (far ** 2).sum(1).min())


def nearest(v: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest centroid and the squared distance, exactly."""
    most = 2 * max(np.abs(v).max(), np.abs(centroids).max())
    if v.shape[1] * int(most) ** 2 < 1 << 52:  # all sums are exact in doubles, whatever their order
        f, c = v.astype(float), centroids.astype(float)
        d = ((f * f).sum(1)[:, None] + (c * c).sum(1) - 2 * (f @ c.T)).astype(np.int64)
    else:
        d = np.stack([((v - c) ** 2).sum(1) for c in centroids], axis=1)
    best = d.argmin(1)
    return best, d[np.arange(len(v)), best]


def blocks_of(batch: pa.RecordBatch, dims: int, centroids: np.ndarray):
    """(row, candidates) for each block of a batch."""
    low, high = matrix(batch.column("low"), dims), matrix(batch.column("high"), dims)
    for k in range(batch.num_rows):
        yield k, candidates(low[k], high[k], centroids)


def moved(blocks: DataFrame, centroids: np.ndarray, dims: int) -> np.ndarray:
    """The centroids after one round; empty ones stay."""
    def run(batches):
        n, total = np.zeros(len(centroids), np.int64), np.zeros(centroids.shape, np.int64)
        for batch in batches:
            for k, some in blocks_of(batch, dims, centroids):
                if some.size == 1:
                    n[some[0]] += batch.column("n")[k].as_py()
                    total[some[0]] += matrix(batch.column("total").slice(k, 1), dims, "<i8")[0]
                    continue
                v = matrix(batch.column("vectors").slice(k, 1), dims)
                best = some[nearest(v, centroids[some])[0]]
                n += np.bincount(best, minlength=len(centroids))
                one = np.zeros((len(centroids), len(v)))
                one[best, np.arange(len(v))] = 1
                total += (one @ v.astype(float)).astype(np.int64)  # BLOCK x LIMIT is exact in doubles
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(n[at]), pa.array(list(total[at]), pa.list_(pa.int64()))],
                                         ["cluster", "n", "sums"])

    each = blocks.mapInArrow(run, "cluster int, n long, sums array<bigint>").select("cluster", "n", F.posexplode("sums").alias("dim", "x"))
    sums = each.groupBy("cluster", "dim").agg(F.sum("n").alias("n"), F.sum(F.col("x").cast("decimal(38,0)")).alias("x")).collect()
    out = centroids.copy()
    for r in sums:  # k x dims rows at most
        out[r.cluster, r.dim] = int(r.x) // r.n
    return out


def cluster_vectors(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = K, dims: int = DIMS,
                    rounds: int = ROUNDS, scale: float = SCALE, salt: str = SALT, block: int = BLOCK) -> DataFrame:
    """One row per kept vector: the id column, cluster, distance (squared),
    cluster_inertia, inertia and centroid (its final components)."""
    spark = df.sparkSession
    vectors = stored(kept_vectors(df, id_col, vector_col, dims, scale), "vectors")
    name = F.sha2(F.concat(F.lit(f"{salt}:"), F.col("id").cast("string")), 256)
    first = vectors.select(name.alias("name"), "v").orderBy(F.asc_nulls_last("name"), "v").limit(k).collect()
    schema = f"`{id_col}` long, cluster int, distance long, cluster_inertia long, inertia long, centroid array<bigint>"
    if not first:
        return spark.createDataFrame([], schema)
    centroids = matrix(pa.array([bytes(r.v) for r in first]), dims)
    blocks = stored(zone_map(vectors, dims, block), "zone-map")
    for _ in range(rounds):
        centroids = moved(blocks.select("n", "vectors", "low", "high", "total"), centroids, dims)

    def assign(batches):
        for batch in batches:
            for j, some in blocks_of(batch, dims, centroids):
                best, distance = nearest(matrix(batch.column("vectors").slice(j, 1), dims), centroids[some])
                yield pa.RecordBatch.from_arrays([batch.column("ids").slice(j, 1).flatten(), pa.array(some[best].astype(np.int32)),
                                                  pa.array(distance)], ["id", "cluster", "distance"])

    assigned = stored(blocks.select("ids", "vectors", "low", "high").mapInArrow(assign, "id long, cluster int, distance long"), "assigned")
    sums = assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()  # k rows at most
    total = sum(int(r.s) for r in sums)
    facts = spark.createDataFrame([(r.cluster, int(r.s), total, [int(x) for x in centroids[r.cluster]]) for r in sums],
                                  "cluster int, cluster_inertia long, inertia long, centroid array<bigint>")
    return assigned.join(F.broadcast(facts), "cluster").select(
        F.col("id").alias(id_col), "cluster", "distance", "cluster_inertia", "inertia", "centroid")


def digest(df: DataFrame) -> DataFrame:
    """The contract's columns of query op13."""
    name = F.sha2(F.array_join(F.col("centroid").cast("array<string>"), ","), 256).alias("centroid_sha256")
    return cluster_vectors(df).select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", name)


def _sql() -> str:
    """The rounds written out, every vector against every centroid."""
    near = """a{r} AS MATERIALIZED (
  SELECT vec_id, v, c, d FROM (
    SELECT vec_id, kept.v, c, list_sum(list_transform(range(1, 65), lambda i: (kept.v[i] - c{r}.v[i]) * (kept.v[i] - c{r}.v[i])))::BIGINT AS d
    FROM kept, c{r}) QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY d, c) = 1)"""
    move = """s{r} AS (SELECT c, i, sum(v[i]) AS x, count(*) AS n FROM a{r}, range(1, 65) AS t(i) GROUP BY 1, 2),
c{n} AS MATERIALIZED (
  SELECT c, coalesce(m.v, c{r}.v) AS v
  FROM c{r} LEFT JOIN (SELECT c, list(((x - ((x % n) + n) % n) // n)::BIGINT ORDER BY i) AS v FROM s{r} GROUP BY 1) AS m USING (c))"""
    steps = [text.format(r=r, n=r + 1) for r in range(ROUNDS) for text in (near, move)] + [near.format(r=ROUNDS)]
    return f"""
WITH kept AS MATERIALIZED (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id)) - 1 AS c, v FROM kept
  QUALIFY row_number() OVER (ORDER BY sha256('2:' || vec_id)) <= 40),
{", ".join(steps)}
SELECT vec_id, a.c::INTEGER AS cluster, d AS distance, sum(d) OVER (PARTITION BY a.c)::BIGINT AS cluster_inertia,
       sum(d) OVER ()::BIGINT AS inertia, sha256(array_to_string(f.v, ',')) AS centroid_sha256
FROM a{ROUNDS} AS a JOIN c{ROUNDS} AS f ON f.c = a.c
"""


SQL = _sql()
