"""Nearest neighbours by cosine, with multi-index hashing.

Vectors become binary codes: centred, turned by learned rotations (iterative quantisation:
alternately the signs and the rotation nearest to them, from several seeded starts, each
giving as many bits as the vectors have dimensions) and cut to signs.  Codes are split
into bytes and every byte position is indexed by its value.  A code within ``radius`` bits has
at least one byte within radius // bytes bits of the query's (pigeonhole), so probing the
byte values that near finds all codes within the radius; their whole distance is then
counted, and what is within the radius is ranked by exact cosine in double precision.  A block with
fewer than k codes within the radius is probed again with twice the radius, so no query goes short.

The rotations and the radius, the one that holds ``recall`` of the exact neighbours, are fitted
on at most ``sample`` vectors; every row is indexed.  (Neighbours in a sample are farther than
in the whole, so the radius errs on the safe side.)

Queries meet the rows in blocks: at most ``query_block`` queries are sent to all tasks at once, and
each task indexes and searches ``row_block`` rows at a time.  Only each block's k best
leave a task.

Defined cases: vectors null, empty, zero, of another length than most, or with null or
non-finite components take no part; a null vec_id takes no part; ties go to the smaller
vec_id; rows of one vec_id count as one, by the best of them, and never find their own id;
an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakestrata.session import materialize


POPCOUNT = np.bitwise_count(np.arange(256, dtype=np.uint8)[:, None] ^ np.arange(256, dtype=np.uint8))
FOUND = "query_id bigint, vec_id bigint, score double"


@dataclass(frozen=True)
class Coder:
    mean: np.ndarray
    rotations: np.ndarray  # dimensions x bits
    radius: int

    def codes(self, vectors: np.ndarray) -> np.ndarray:
        """A row of bytes per vector."""
        return np.packbits((unit(vectors) - self.mean) @ self.rotations > 0, axis=1)


def unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def fit(vectors: np.ndarray, bits: int, recall: float, k: int, rounds: int = 20) -> Coder:
    x = unit(vectors)
    mean = x.mean(axis=0)
    centred = x - mean
    dims = x.shape[1]
    rng = np.random.default_rng(11)
    parts = []
    for _ in range(-(-bits // dims)):
        turn = np.linalg.qr(rng.normal(size=(dims, dims)))[0]
        for _ in range(rounds):
            u, _, v = np.linalg.svd(np.where(centred @ turn > 0, 1.0, -1.0).T @ centred)
            turn = (u @ v).T
        parts.append(turn)
    rotations = np.hstack(parts)
    rotations = rotations[:, : max(8, rotations.shape[1] // 8 * 8)]
    if rotations.shape[1] % 8:  # fewer than 8 dimensions: repeat to fill a byte
        rotations = np.tile(rotations, (1, 8))[:, :8]
    coder = Coder(mean, rotations, 0)
    codes = coder.codes(vectors)
    asked = np.arange(0, len(x), max(1, len(x) // 400))
    like = x[asked] @ x.T
    like[np.arange(len(asked)), asked] = -np.inf
    near = np.argsort(-like, axis=1)[:, : min(k, len(x) - 1)]
    far = np.bitwise_count(codes[asked][:, None, :] ^ codes[near]).sum(axis=2, dtype=np.int64)
    radius = int(np.quantile(far, recall, method="higher")) if far.size else 0
    return Coder(mean, rotations, radius)


def best_of(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k highest scores of different ids, ties to the smaller id."""
    order = np.lexsort((ids, -scores))
    ids, scores = ids[order], scores[order]
    first = np.sort(np.unique(ids, return_index=True)[1])[:k]
    return ids[first], scores[first]


class Block:
    """The multi-index of some rows: per byte position, rows in order of their value."""

    def __init__(self, coder: Coder, ids: np.ndarray, vectors: np.ndarray) -> None:
        self.ids, self.vectors = ids, vectors
        self.lengths = np.linalg.norm(vectors, axis=1)
        self.codes = coder.codes(vectors)
        self.order = np.argsort(self.codes, axis=0, kind="stable")
        values = np.arange(257)
        self.starts = np.array(
            [
                np.searchsorted(self.codes[self.order[:, s], s], values)
                for s in range(self.codes.shape[1])
            ]
        )

    def within(self, code: np.ndarray, radius: int) -> np.ndarray:
        """Rows whose codes differ from ``code`` in at most ``radius`` bits."""
        n_bytes = self.codes.shape[1]
        low, last = divmod(radius, n_bytes)
        hit = np.zeros(len(self.ids), bool)
        for s in range(n_bytes):
            # Byte positions after the first last + 1 may be probed one bit less.
            reach = low if s <= last else low - 1
            if reach < 0:
                break
            probed = np.flatnonzero(POPCOUNT[code[s]] <= reach)
            a, b = self.starts[s][probed], self.starts[s][probed + 1]
            sizes = b - a
            ends = np.cumsum(sizes)
            if not len(ends) or not ends[-1]:
                continue
            at = np.arange(ends[-1]) + np.repeat(a - (ends - sizes), sizes)
            hit[self.order[at, s]] = True
        found = np.flatnonzero(hit)
        far = np.bitwise_count(self.codes[found] ^ code).sum(axis=1, dtype=np.int64)
        return found[far <= radius]

    def nearest(self, query: int, vector: np.ndarray, code: np.ndarray, radius: int, k: int):
        """The k best (ids, scores) among the rows within the radius, other than the query's."""
        n_bits = 8 * self.codes.shape[1]
        while True:
            rows = self.within(code, min(radius, n_bits))
            rows = rows[self.ids[rows] != query]
            if len(rows) >= k or radius >= n_bits:
                if radius >= n_bits or len(np.unique(self.ids[rows[: 100 * k]])) >= k:
                    break
            radius = 2 * radius + 1
        scores = (self.vectors[rows] * vector).sum(axis=1)
        scores /= self.lengths[rows] * np.sqrt((vector * vector).sum())
        return best_of(self.ids[rows], scores, k)


def usable(vectors: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """(vec_id, v): vectors as doubles that take part, but for the common length."""
    v = F.col(vector_column).cast("array<double>")
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (
        vectors.select(F.col(id_column).cast("bigint").alias("vec_id"), v.alias("v"))
        .where("vec_id is not null and v is not null and size(v) > 0")
        .where(fine & F.exists("v", lambda x: x != 0))
    )


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    lists = batch.column("v")
    return np.asarray(lists.flatten(), np.float64).reshape(len(lists), -1)


def search(
    vectors: DataFrame,
    is_query: str,
    k: int = 5,
    bits: int = 128,
    recall: float = 0.98,
    sample: int = 20_000,
    query_block: int = 20_000,
    row_block: int = 8_192,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
) -> DataFrame:
    """query_id, rank, vec_id, score: for every row with ``is_query`` (SQL over vec_id), its k
    nearest other rows."""
    rows = usable(vectors, id_column, vector_column)
    spark = vectors.sparkSession
    sizes = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    if sizes is None:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    rows = rows.where(F.size("v") == sizes["d"])
    share = min(1.0, sample / sizes["count"])
    hashed = F.pmod(F.xxhash64("vec_id", "v"), F.lit(1 << 30))
    picked = rows.where(hashed < int(share * (1 << 30))).orderBy(hashed, "vec_id").limit(2 * sample)
    fitted_on = picked.select("v").toArrow().combine_chunks().to_batches()
    if not fitted_on:  # a table so small that the hash picks none
        fitted_on = rows.limit(sample).select("v").toArrow().combine_chunks().to_batches()
    coder = fit(_matrix(fitted_on[0]), bits, recall, k)
    queries = materialize(rows.where(is_query).distinct())  # equal rows ask once
    parts = max(1, -(-queries.count() // query_block))
    block_of = F.pmod(F.xxhash64("vec_id", "v"), F.lit(parts))

    found: DataFrame | None = None
    for part in range(parts):
        # A part is query_block different queries on average: a bound on what is sent at once.
        held = queries.where(block_of == part).orderBy("vec_id").toArrow()
        if not held.num_rows:
            continue
        one = held.combine_chunks().to_batches()[0]
        ids, asked = one.column("vec_id").to_numpy(), _matrix(one)
        sent = spark.sparkContext.broadcast((coder, ids, asked, coder.codes(asked)))
        best = _search_all(rows, sent, k, row_block)
        found = best if found is None else found.unionByName(best)
    if found is None:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    first = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    # Per query k rows of each block of rows come together here.
    return (
        found.groupBy("query_id", "vec_id")
        .agg(F.max("score").alias("score"))
        .withColumn("rank", F.row_number().over(first))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def _search_all(rows: DataFrame, sent, k: int, row_block: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, ids, asked, codes = sent.value
        best_ids = [np.zeros(0, np.int64)] * len(ids)
        best = [np.zeros(0)] * len(ids)
        for batch in batches:
            for start in range(0, batch.num_rows, row_block):
                cut = batch.slice(start, row_block)
                block = Block(coder, cut.column("vec_id").to_numpy(), _matrix(cut))
                for i, query in enumerate(ids):
                    got, scores = block.nearest(query, asked[i], codes[i], coder.radius, k)
                    best_ids[i], best[i] = best_of(
                        np.concatenate([best_ids[i], got]), np.concatenate([best[i], scores]), k
                    )
        yield pa.record_batch(
            {
                "query_id": np.repeat(ids, [len(b) for b in best_ids]),
                "vec_id": np.concatenate([np.zeros(0, np.int64), *best_ids]),
                "score": np.concatenate([np.zeros(0), *best]),
            }
        )

    return rows.mapInArrow(run, FOUND)
