"""Helpers the operators share: words of a text, Arrow batches and their memory, tables."""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Callable, Iterator, Sequence
from functools import wraps

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CHUNK_BYTES = 1 << 21
BATCH_BYTES = 4 << 20
BATCH_LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"
MEMO_ENTRIES = 200_000
MEMO_WORD = 64  # longer "words" are not remembered


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def lower_ascii(text: Column) -> Column:
    """A-Z only; every other character stays as it is."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def texts_of(batch: pa.RecordBatch, name: str = "text") -> list[bytes]:
    """The UTF-8 bytes of every text; null is empty."""
    column = batch.column(name).cast(pa.binary()).fill_null(b"")
    return column.to_pylist()


def chunks(texts: Sequence[bytes], limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``limit`` bytes, so that a batch's words need not be
    held at once.  A longer text is a range of its own."""
    start, held = 0, 0
    for i, text in enumerate(texts):
        if held and held + len(text) > limit:
            yield start, i
            start, held = i, 0
        held += len(text)
    if start < len(texts):
        yield start, len(texts)


def give_back() -> None:
    """Return to the system what this worker has freed; allocators keep it otherwise, for as long
    as the worker waits for tasks."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None) if sys.platform == "linux" else None:
        trim(0)


Run = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def lean(run: Run) -> Run:
    """``run``, giving freed memory back after each batch it makes and at its end."""

    @wraps(run)
    def held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            for batch in run(batches):
                yield batch
                del batch
                give_back()
        finally:
            give_back()

    return held


def map_in_arrow(rows: DataFrame, run: Run, schema: T.StructType | str) -> DataFrame:
    """``rows.mapInArrow(run, schema)`` by batches of about BATCH_BYTES, or one larger row, which an
    executor holds several times over on both sides; a limit that the session has been given stays."""
    spark = rows.sparkSession
    if spark.conf.get(BATCH_LIMIT, None) is None:
        spark.conf.set(BATCH_LIMIT, str(BATCH_BYTES))
    return rows.mapInArrow(lean(run), schema)


class WordHashes(dict):
    """word (bytes) -> 64-bit hash, remembering up to MEMO_ENTRIES of them."""

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(word) <= MEMO_WORD:
            if len(self) >= MEMO_ENTRIES:
                self.clear()
            self[word] = value
        return value

    def of(self, words: Sequence[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers (SplitMix64's finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` word hashes; of the whole sequence if shorter."""
    if not len(words):
        return words
    n = max(1, len(words) - size + 1)
    out = np.zeros(n, np.uint64)
    for k in range(min(size, len(words))):
        out = out * np.uint64(0x9E3779B97F4A7C15) + words[k : k + n]
    return mix64(out + np.uint64(min(size, len(words))))


def signed(x: np.ndarray) -> np.ndarray:
    """64 unsigned bits as Spark's long."""
    return x.view(np.int64)
