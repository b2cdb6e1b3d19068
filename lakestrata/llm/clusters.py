"""Centroid clustering of vectors by dictionaries of their subvectors.

Vectors become integers, floor(scale * x), and are cut into blocks of two dimensions.  Every
block is dictionary-encoded without loss: a vector is then one code per block.  A round computes
the exact squared distance of each dictionary entry to that block of every centroid once; the
distance of a vector is the sum of its codes' entries.  All arithmetic is in integers.

Entries held often, at least one in SHARED of all, are counted over the whole table and make up
one shared dictionary (so it has at most SHARED entries, or all if there are no more); it is
broadcast, and its distances are computed once a round by each Python worker.  All other entries
go to a dictionary of their own chunk of rows, so no entry is ever left out and no dictionary
grows with the table.  The encoded chunks are written once; a round reads them once and brings
one row of sums per centroid to the driver.  Nothing is shuffled by vector or by centroid.

Rounds: each vector goes to the nearest centroid (ties: smaller number); then every centroid
with vectors becomes floor(sum / count) of them, component by component; empty ones stay.
At first the centroids are the vectors with the smallest sha256 of ``<seed>:<id>``.

Defined cases: vectors null, of another length, or with null or non-finite components take no
part; rows of one id each count, and are ordered by their vectors as first centroids; rows without
id count, and come last there; with fewer vectors than centroids there are as many centroids
as vectors; an empty table gives no rows; other columns are not carried.  A component of 2**26 or
more after scaling is an error, since squared distances would not fit a long.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestrata.session import materialize

SHARED = 1 << 18
CHUNK = 8192
WIDTH = 2
HALF = 1 << 26  # components lie in [-HALF, HALF)

ENTRIES = "block int, entry bigint, n bigint"
CHUNKS = "ids array<bigint>, codes binary, own binary, own_sizes array<int>"
SUMS = "cluster int, n bigint, sums array<bigint>"
NEAREST = "vec_id bigint, cluster int, distance bigint"


def integers(rows: DataFrame, id: str, vector: str, dims: int, scale: int) -> DataFrame:
    """(vec_id, v): the vectors that take part, as integers."""
    finite = "forall(v, x -> x is not null and not isnan(x) and abs(x) < double('infinity'))"
    return (
        rows.select(
            F.col(id).cast("bigint").alias("vec_id"),
            F.col(vector).cast("array<double>").alias("v"),
        )
        .where(f"size(v) = {dims} and {finite}")
        .select("vec_id", F.expr(f"transform(v, x -> floor(x * {scale}D))").alias("v"))
    )


def matrix(batch: pa.RecordBatch, dims: int) -> np.ndarray:
    """A row per vector; one more column of zeros if the last block would be short."""
    flat = batch.column("v").flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((batch.num_rows, -(-dims // WIDTH) * WIDTH), np.int64)
    out[:, :dims] = flat.reshape(-1, dims)
    if out.size and (out.min() < -HALF or out.max() >= HALF):
        raise ValueError("a scaled component is beyond 26 bits")
    return out


def packed(pairs: np.ndarray) -> np.ndarray:
    """Two components as one number, in their order."""
    return ((pairs[:, 0] + HALF) << 27) | (pairs[:, 1] + HALF)


def unpacked(entries: np.ndarray) -> np.ndarray:
    return np.stack([(entries >> 27) - HALF, (entries & ((1 << 27) - 1)) - HALF], axis=1)


def dictionary(vectors: DataFrame, dims: int, shared: int) -> list[np.ndarray]:
    """Per block, the sorted entries held often enough to be shared; at most ``shared``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch, dims)
            for b in range(x.shape[1] // WIDTH):
                entry, n = np.unique(packed(x[:, WIDTH * b : WIDTH * (b + 1)]), return_counts=True)
                yield pa.record_batch(
                    {"block": pa.array(np.full(len(entry), b, np.int32)), "entry": entry, "n": n}
                )

    counted = materialize(
        vectors.select("v").mapInArrow(run, ENTRIES).groupBy("block", "entry").agg(F.sum("n").alias("n"))
    )
    different, total = counted.agg(F.count("n"), F.sum("n")).first()
    # No more than ``shared`` entries can each hold one in ``shared`` of the total.
    least = 1 if different <= shared else -(-total // shared)
    rows = counted.where(F.col("n") >= least).select("block", "entry").toArrow()
    block, entry = rows["block"].to_numpy(), rows["entry"].to_numpy()
    return [np.sort(entry[block == b]) for b in range(-(-dims // WIDTH))]


def _encode(dims: int, shared):
    """Chunks of rows as codes: below a block's number of shared entries, those; then the
    chunk's own entries, which are kept with it."""

    def chunk(x: np.ndarray, ids: pa.Array) -> pa.RecordBatch:
        codes = np.empty((x.shape[1] // WIDTH, len(x)), np.int32)
        own = []
        for b, known in enumerate(shared.value):
            entry = packed(x[:, WIDTH * b : WIDTH * (b + 1)])
            at = np.searchsorted(known, entry)
            new = np.ones(len(entry), bool)
            inside = at < len(known)
            new[inside] = known[at[inside]] != entry[inside]
            rest, place = np.unique(entry[new], return_inverse=True)
            at[new] = len(known) + place
            codes[b] = at
            own.append(rest)
        return pa.record_batch(
            {
                "ids": pa.array([ids.to_pylist()], pa.list_(pa.int64())),
                "codes": pa.array([codes.tobytes()], pa.binary()),
                "own": pa.array([np.concatenate(own).tobytes()], pa.binary()),
                "own_sizes": pa.array([[len(x) for x in own]], pa.list_(pa.int32())),
            }
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, CHUNK):
                part = batch.slice(a, CHUNK)
                yield chunk(matrix(part, dims), part.column("vec_id"))

    return run


def entry_distances(entries: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """A row per entry, a column per centroid; ``centroids`` cut to the entries' block."""
    far = unpacked(entries)[:, None, :] - centroids[None, :, :]
    return (far * far).sum(axis=2)


class Round:
    """The centroids of one round with the distances of all shared entries to them."""

    def __init__(self, shared: list[np.ndarray], centroids: np.ndarray) -> None:
        k, dims = centroids.shape
        self.centroids = np.zeros((k, len(shared) * WIDTH), np.int64)
        self.centroids[:, :dims] = centroids
        self.shared = shared
        self.tables = [entry_distances(e, self._block(b)) for b, e in enumerate(shared)]

    def _block(self, b: int) -> np.ndarray:
        return self.centroids[:, WIDTH * b : WIDTH * (b + 1)]

    def nearest(self, row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(vectors, number of the nearest centroid, squared distance) of a chunk."""
        codes = np.frombuffer(row["codes"], np.int32).reshape(len(self.shared), -1)
        own = np.split(np.frombuffer(row["own"], np.int64), np.cumsum(row["own_sizes"])[:-1])
        vectors = np.empty((codes.shape[1], self.centroids.shape[1]), np.int64)
        far = np.zeros((codes.shape[1], len(self.centroids)), np.int64)
        for b, code in enumerate(codes):
            known = len(self.shared[b])
            pair = vectors[:, WIDTH * b : WIDTH * (b + 1)]
            if not len(own[b]):
                far += self.tables[b][code]
                pair[:] = unpacked(self.shared[b][code])
                continue
            new = code >= known
            far[~new] += self.tables[b][code[~new]]
            far[new] += entry_distances(own[b], self._block(b))[code[new] - known]
            pair[:] = unpacked(np.concatenate([self.shared[b], own[b]])[code])
        cluster = far.argmin(axis=1)
        return vectors, cluster, far[np.arange(len(far)), cluster]


@lru_cache(maxsize=1)
def _round(name: str, shared, centroids: bytes, k: int) -> Round:
    """Once a round in each Python worker, which runs many tasks."""
    return Round(shared.value, np.frombuffer(centroids, np.int64).reshape(k, -1))


def _sums(name: str, shared, centroids: np.ndarray):
    raw, (k, dims) = centroids.tobytes(), centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = _round(name, shared, raw, k)
        n, sums = np.zeros(k, np.int64), np.zeros((k, dims), np.int64)
        for batch in batches:
            for row in batch.to_pylist():
                vectors, cluster, _ = now.nearest(row)
                order = np.argsort(cluster, kind="stable")
                held, first = np.unique(cluster[order], return_index=True)
                sums[held] += np.add.reduceat(vectors[order, :dims], first, axis=0)
                n += np.bincount(cluster, minlength=k)
        held = np.flatnonzero(n)
        yield pa.record_batch(
            {
                "cluster": pa.array(held.astype(np.int32)),
                "n": pa.array(n[held]),
                "sums": pa.array(sums[held].tolist(), pa.list_(pa.int64())),
            }
        )

    return run


def _nearest(name: str, shared, centroids: np.ndarray):
    raw, k = centroids.tobytes(), len(centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = _round(name, shared, raw, k)
        for batch in batches:
            for row in batch.to_pylist():
                _, cluster, distance = now.nearest(row)
                yield pa.record_batch(
                    {
                        "vec_id": pa.array(row["ids"], pa.int64()),
                        "cluster": pa.array(cluster.astype(np.int32)),
                        "distance": pa.array(distance),
                    }
                )

    return run


def cluster(
    rows: DataFrame,
    k: int,
    rounds: int,
    dims: int,
    scale: int = 256,
    seed: str = "2",
    id: str = "vec_id",
    vector: str = "embedding",
    shared: int = SHARED,
) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, cluster, distance) of every vector that takes part, and the final centroids."""
    spark = rows.sparkSession
    vectors = integers(rows, id, vector, dims, scale)
    by_hash = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = vectors.orderBy(by_hash.asc_nulls_last(), "v").limit(k).collect()  # k rows
    if not first:
        return spark.createDataFrame([], NEAREST), np.zeros((0, dims), np.int64)
    centroids = np.array([r["v"] for r in first], np.int64)
    known = spark.sparkContext.broadcast(dictionary(vectors, dims, shared))
    chunks = materialize(vectors.mapInArrow(_encode(dims, known), CHUNKS))
    name = uuid.uuid4().hex
    for step in range(rounds):
        sums = [F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(dims)]
        found = (
            chunks.mapInArrow(_sums(f"{name}-{step}", known, centroids), SUMS)
            .groupBy("cluster")
            .agg(F.sum("n").alias("n"), *sums)
            .collect()  # k rows
        )
        centroids = centroids.copy()
        for r in found:
            centroids[r["cluster"]] = [r[f"s{i}"] // r["n"] for i in range(dims)]
    last = _nearest(f"{name}-last", known, centroids)
    return materialize(chunks.mapInArrow(last, NEAREST)), centroids


def summary(nearest: DataFrame, centroids: np.ndarray) -> DataFrame:
    """Every vector with its cluster's and the whole inertia and its centroid's sha256."""
    spark = nearest.sparkSession
    inertia = dict(
        nearest.groupBy("cluster").agg(F.sum("distance").alias("d")).collect()  # k rows
    )
    rows = [
        (
            c,
            d,
            sum(inertia.values()),
            hashlib.sha256(",".join(map(str, centroids[c].tolist())).encode()).hexdigest(),
        )
        for c, d in sorted(inertia.items())
    ]
    clusters = spark.createDataFrame(
        rows, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string"
    )
    return nearest.join(F.broadcast(clusters), "cluster").select(  # k rows
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
