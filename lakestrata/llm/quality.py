"""Quality of whole texts by a factorisation machine.

Inputs are the text alone: hashed words (share of the text's words, square root), structure
(kinds of characters, word lengths, repetition, lines), and metadata of its length.  All pairs of
inputs interact through rank-8 factors; a text is scored in time linear in its
inputs, since sum over pairs <v_i, v_j> x_i x_j = (|sum v_i x_i|^2 - sum |v_i x_i|^2) / 2.

The machine is fitted by Adagrad on at most ``sample`` labelled rows, picked by the hash of their
doc_id; scoring reads whole texts of all rows.

Defined cases: a null or empty text has structure inputs of 0 and is scored like any other;
without labels of both kinds every score is the share of label 1, or 0.5; a null doc_id is not
learned from and not held out; equal rows have equal scores; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakestrata.llm.common import chunks, texts_of

BUCKETS = 1 << 13
RANK = 8
MEMO_ENTRIES = 500_000
STATS = 16
KINDS = np.zeros(256, np.int64)  # of a byte: 0 other, then as below
for _kind, _bytes in enumerate(
    (
        b"abcdefghijklmnopqrstuvwxyz",
        b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
        b"0123456789",
        b" \t\r\n\x0b\x0c",
        b".,;:?'\"()-",
        b"!#$%&*@^~=+_<>/\\{}[]|`",
        bytes(range(128, 256)),
    ),
    1,
):
    KINDS[list(_bytes)] = _kind


class WordPlaces(dict):
    """word -> its hashed input."""

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word) % BUCKETS
        if len(word) <= 64:
            if len(self) >= MEMO_ENTRIES:
                self.clear()
            self[word] = value
        return value


def inputs(text: bytes, places: WordPlaces) -> tuple[np.ndarray, np.ndarray]:
    """Indexes and values of a text's inputs; the last STATS indexes are the structure."""
    words = text.split()
    stats = np.zeros(STATS)
    if not words:
        return np.arange(BUCKETS, BUCKETS + STATS), stats
    found = np.fromiter(map(places.__getitem__, words), np.int64, len(words))
    at, counts = np.unique(found, return_counts=True)
    raw = np.frombuffer(text, np.uint8)
    kinds = np.bincount(KINDS[raw], minlength=8) / len(raw)
    solid = max(1e-9, 1 - kinds[4])
    lines = text.count(b"\n") + 1
    stats[:7] = kinds[[1, 2, 3, 5, 6, 7, 0]] / solid
    stats[7] = (len(raw) / len(words)) / 20
    stats[8] = len(at) / len(words) ** 0.9
    stats[9] = (found[1:] == found[:-1]).mean() if len(words) > 1 else 0
    stats[10] = counts.max() / len(words)
    stats[11] = np.log1p(len(words)) / 10
    stats[12] = np.log1p(len(raw) / lines) / 10
    stats[13] = np.log1p(lines) / 10
    stats[14] = kinds[2] > 2 * kinds[1]
    stats[15] = text.count(b"|") / len(words)
    values = np.concatenate([0.3 * np.sqrt(counts / len(words)), np.minimum(stats, 3.0)])
    return np.concatenate([at, np.arange(BUCKETS, BUCKETS + STATS)]), values


@dataclass
class Machine:
    bias: float
    linear: np.ndarray
    factors: np.ndarray

    def raw(self, at: np.ndarray, x: np.ndarray) -> float:
        vx = self.factors[at] * x[:, None]
        pairs = 0.5 * float((vx.sum(axis=0) ** 2).sum() - (vx**2).sum())
        return self.bias + float(self.linear[at] @ x) + pairs

    def score(self, at: np.ndarray, x: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.raw(at, x), -30, 30))))


def fit(
    rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, epochs: int = 12, batch: int = 64
) -> Machine:
    """Adagrad on the logistic loss with weight decay; the order is seeded."""
    n = BUCKETS + STATS
    rng = np.random.default_rng(7)
    share = float(labels.mean()) if len(labels) else 0.5
    share = min(max(share, 1e-3), 1 - 1e-3)
    made = Machine(float(np.log(share / (1 - share))), np.zeros(n), rng.normal(0, 0.03, (n, RANK)))
    if len(set(labels.tolist())) < 2:
        made.factors[:] = 0
        return made
    g0, gl, gf = 1e-8, np.full(n, 1e-8), np.full((n, RANK), 1e-8)
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for start in range(0, len(order), batch):
            picked = order[start : start + batch]
            at = np.concatenate([rows[i][0] for i in picked])
            x = np.concatenate([rows[i][1] for i in picked])
            sizes = np.array([len(rows[i][0]) for i in picked])
            heads = np.cumsum(sizes) - sizes
            owner = np.repeat(np.arange(len(picked)), sizes)
            vx = made.factors[at] * x[:, None]
            total = np.add.reduceat(vx, heads, axis=0)
            squares = np.add.reduceat((vx**2).sum(axis=1), heads)
            raw = made.bias + np.add.reduceat(made.linear[at] * x, heads)
            raw += 0.5 * ((total**2).sum(axis=1) - squares)
            wrong = (1 / (1 + np.exp(-np.clip(raw, -30, 30))) - labels[picked]) / len(picked)
            uniq, back = np.unique(at, return_inverse=True)
            dl = np.bincount(back, weights=wrong[owner] * x) + 1e-6 * made.linear[uniq]
            each = (wrong[owner] * x)[:, None] * (total[owner] - vx)
            df = np.zeros((len(uniq), RANK))
            for k in range(RANK):
                df[:, k] = np.bincount(back, weights=each[:, k])
            df += 1e-5 * made.factors[uniq]
            d0 = wrong.sum()
            g0 += d0**2
            gl[uniq] += dl**2
            gf[uniq] += df**2
            made.bias -= 0.1 * d0 / np.sqrt(g0)
            made.linear[uniq] -= 0.1 * dl / np.sqrt(gl[uniq])
            made.factors[uniq] -= 0.05 * df / np.sqrt(gf[uniq])
    return made


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))


def learn(docs: DataFrame, labels: DataFrame, sample: int = 6000) -> Machine:
    """Fit on at most ``sample`` labelled rows that aren't held out."""
    picked = (
        labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), "quality")
        .where("doc_id is not null and quality in (0, 1)")
        .where(~held_out())
        .dropDuplicates(["doc_id", "quality"])
        .orderBy(F.xxhash64("doc_id"), "doc_id", "quality")
        .limit(sample)
    )
    texts = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")
    )
    # At most ``sample`` short rows; copies of a labelled document count as one.
    joined = (
        texts.join(F.broadcast(picked), "doc_id")
        .withColumn("digest", F.xxhash64("text"))
        .dropDuplicates(["doc_id", "quality", "digest"])
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places = WordPlaces()
        for batch in batches:
            got = [inputs(t, places) for t in texts_of(batch)]
            yield pa.record_batch(
                {
                    "doc_id": batch.column("doc_id"),
                    "quality": batch.column("quality").cast(pa.int32()),
                    "at": pa.array([a.astype(np.int32) for a, _ in got], pa.list_(pa.int32())),
                    "x": pa.array([x.astype(np.float32) for _, x in got], pa.list_(pa.float32())),
                }
            )

    rows = (
        joined.select("doc_id", "quality", "text")
        .mapInArrow(run, "doc_id bigint, quality int, at array<int>, x array<float>")
        .orderBy(F.xxhash64("doc_id"), "doc_id", "quality", "x")
        .limit(sample)
        .toArrow()
    )
    at, x = rows.column("at").to_pylist(), rows.column("x").to_pylist()
    y = np.array(rows.column("quality").to_pylist(), np.float64)
    return fit([(np.array(a), np.array(b)) for a, b in zip(at, x, strict=True)], y)


def score(docs: DataFrame, machine: Machine) -> DataFrame:
    """doc_id, held_out and score of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(machine)  # BUCKETS rows, whatever the data

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places = WordPlaces()
        for batch in batches:
            texts = texts_of(batch)
            for a, b in chunks(texts):
                scores = [shared.value.score(*inputs(t, places)) for t in texts[a:b]]
                yield pa.record_batch(
                    {
                        "doc_id": batch.column("doc_id").slice(a, b - a),
                        "held_out": batch.column("held_out").slice(a, b - a),
                        "score": pa.array(scores, pa.float64()),
                    }
                )

    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        held_out().alias("held_out"),
        F.col("text").cast("string").alias("text"),
    ).mapInArrow(run, "doc_id bigint, held_out boolean, score double")


def rate(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """Scores of all rows by a machine learned from the labelled ones that aren't held out."""
    scored = score(docs, learn(docs, labels))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
