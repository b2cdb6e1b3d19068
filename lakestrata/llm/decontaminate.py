"""Benchmark items found in whole documents.

Words are lowered A-Z runs between ASCII characters that are neither letters nor digits.
Every window of a document that is as long as some benchmark item, in steps of ``step`` words
of length, gets a 64-bit SimHash of its shingles; a multi-index of the items' own fingerprints, four blocks of 16 bits,
returns every window within ``radius`` bits of an item of its length (a block of such a
pair differs in at most radius // 4 bits).  Each such pair is then compared exactly, at the
item's own length: shingles weigh as often as they occur, and a leak is a window whose
weighted similarity, the sum of the lesser weights to the sum of the greater ones, is
``percent`` or more.  (Fingerprints of an item of 15 words are of its first 12, at step 4.)

Window sums are differences of running sums, kept in 8 bits where a window's sum fits, so
a pass over the words per item length costs little more than its sign bits.

At similarity 0.8 of equal lengths, fingerprints differ in 9.7 bits on average with a deviation of
2.9, so a radius of 15 misses 3 in 100 such borderline pairs, and none of similarity 0.95.

The index is built once for each ``part_words`` words of the benchmark, so its size is bounded, and
broadcast; a larger benchmark is worked off part by part, in as many passes over the documents.
Documents stay where they are; there is no shuffle of texts.

Defined cases: null and empty texts, and items without words, match nothing; a text shorter
than an item is one window; an item of fewer words than a shingle is one shingle; repeated
rows give repeated results; items of equal text are all reported; a null doc_id is carried; an empty
table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakestrata.llm.common import WordHashes, chunks, map_in_arrow, shingle_hashes, texts_of
from lakestrata.session import materialize

BLOCKS = 4
WINDOW_ROWS = 4096  # windows whose sums are held at once
KEEP = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
    for c in range(256)
)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(KEEP).split()


def signs(hashes: np.ndarray, kind: type) -> np.ndarray:
    """A row of 64 numbers, 1 or -1, for every hash."""
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1)
    return (bits.astype(kind) << 1) - 1


def packed(sums: np.ndarray) -> np.ndarray:
    return np.packbits((sums > 0).ravel()).view(np.uint64)


def width_for(shingles: int) -> type:
    return np.int8 if shingles < 128 else np.int16 if shingles < 32768 else np.int32


def weighted_similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Sum of lesser weights to sum of greater weights of two lists of shingles."""
    both, place = np.unique(np.concatenate([a, b]), return_inverse=True)
    wa = np.bincount(place[: len(a)], minlength=len(both))
    wb = np.bincount(place[len(a) :], minlength=len(both))
    return float(np.minimum(wa, wb).sum() / max(1, np.maximum(wa, wb).sum()))


class Index:
    """The items of one window length and their fingerprints' multi-index: per block, postings
    from every 16-bit value to the items whose block is within radius // BLOCKS bits of it.

    A posting is a set of bits, for up to 64 items at a time, so those of the four blocks are
    united by one operation each and every pair is tested once.
    """

    def __init__(self, items: list[tuple[int, np.ndarray, np.ndarray]], shingles: int, radius: int) -> None:
        self.items = items
        self.shingles = shingles
        kind = width_for(self.shingles)
        self.prints = np.array(
            [
                packed(signs(s[:shingles], kind).sum(axis=0, dtype=np.int64)[None, :])[0]
                for _, s, _ in items
            ],
            np.uint64,
        )
        self.radius = radius
        self.tested = 0
        values = np.arange(1 << 16, dtype=np.uint16)
        masks = values[np.bitwise_count(values) <= radius // BLOCKS]
        self.postings = []
        for first in range(0, len(items), 64):
            own = self.prints[first : first + 64]
            width = next(w for w in (8, 16, 32, 64) if len(own) <= w)
            bits = np.zeros((BLOCKS, 1 << 16), f"u{width // 8}")
            for j, parts in enumerate(own.view(np.uint16).reshape(-1, BLOCKS)):
                for block, value in enumerate(parts):
                    bits[block, value ^ masks] |= bits.dtype.type(1 << j)
            self.postings.append((first, own, bits))

    def candidates(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(window, item) indexes of all fingerprints within the radius.  Only pairs that meet
        in a posting are tested."""
        blocks = prints.view(np.uint16).reshape(-1, BLOCKS).T.astype(np.intp)
        windows, items = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for first, own, bits in self.postings:
            met = bits[0][blocks[0]]
            for block in range(1, BLOCKS):
                met |= bits[block][blocks[block]]
            window = np.flatnonzero(met)
            met, held = met[window], prints[window]
            while len(window):
                self.tested += len(window)
                rest = met & (met - met.dtype.type(1))
                item = np.bitwise_count((met ^ rest) - met.dtype.type(1))
                near = np.bitwise_count(held ^ own[item]) <= self.radius
                if near.any():
                    windows.append(window[near])
                    items.append(first + item[near].astype(np.int64))
                more = rest != 0
                window, met, held = window[more], rest[more], held[more]
        return np.concatenate(windows), np.concatenate(items)


class Scanner:
    def __init__(
        self, items: list[tuple[int, bytes]], size: int, percent: int, radius: int, step: int = 4
    ) -> None:
        self.hashes = WordHashes()
        self.percent = percent
        by_length: dict[tuple[int, int], list[tuple[int, np.ndarray, np.ndarray]]] = {}
        for item, text in items:
            words = self.hashes.of(words_of(text))
            if len(words):
                own = shingle_hashes(words, size)
                n = len(words) - len(words) % step if len(words) >= 2 * size else len(words)
                key = min(size, len(words)), max(1, n - size + 1)
                by_length.setdefault(key, []).append((item, own, np.sort(own)))
        # By words of a shingle: an item of fewer words than a shingle has shorter ones.
        self.indexes: dict[int, list[Index]] = {}
        for (of, n), listed in sorted(by_length.items()):
            self.indexes.setdefault(of, []).append(Index(listed, n, radius))

    def leaks(self, texts: list[bytes]) -> list[tuple[int, int, int, int, float]]:
        """(text, item, first word, words, similarity) of the best window of each text and item."""
        words = [self.hashes.of(words_of(text)) for text in texts]
        found: dict[tuple[int, int], tuple[float, int, int]] = {}
        for size, indexes in self.indexes.items():
            self._scan(words, size, indexes, found)
        return [
            (text, item, -at, n, alike) for (text, item), (alike, at, n) in sorted(found.items())
        ]

    def rows(self, texts: list[bytes]) -> list[tuple[int, int, int, int, float]]:
        """The same for a batch of any size."""
        return [
            (a + text, *rest)
            for a, b in chunks(texts, 1 << 19)
            for text, *rest in self.leaks(texts[a:b])
        ]

    def _scan(
        self,
        words: list[np.ndarray],
        size: int,
        indexes: list[Index],
        found: dict[tuple[int, int], tuple[float, int, int]],
    ) -> None:
        shingles = [shingle_hashes(w, size) for w in words]
        n_shingles = np.array([len(s) for s in shingles], np.int64)
        ends = np.cumsum(n_shingles)
        heads = ends - n_shingles
        flat = np.concatenate(shingles) if len(shingles) else np.zeros(0, np.uint64)
        owner = np.repeat(np.arange(len(words)), n_shingles)

        def compare(text: int, at: int, item: tuple[int, np.ndarray, np.ndarray]) -> None:
            name, own, sorted_own = item
            window = shingles[text][at : at + len(own)]
            place = np.searchsorted(sorted_own[:-1], window)
            if (sorted_own[place] == window).sum() * 100 < self.percent * len(own):
                return  # what they share cannot be enough
            alike = weighted_similarity(window, own)
            if alike * 100 >= self.percent - 1e-9:
                n = min(len(window) + size - 1, len(words[text]) - at)
                best = (alike, -at, n)
                if best > found.get((text, name), (0.0, 0, 0)):
                    found[text, name] = best

        widest = max(i.shingles for i in indexes)
        prints = [np.zeros(max(0, len(flat) - i.shingles + 1), np.uint64) for i in indexes]
        for start in range(0, len(flat), WINDOW_ROWS):
            stop = min(len(flat), start + WINDOW_ROWS)
            rows = signs(flat[start : min(len(flat), stop + widest)], width_for(widest))
            sums = np.zeros((len(rows) + 1, 64), rows.dtype)
            np.add.accumulate(rows, axis=0, out=sums[1:])
            for index, own in zip(indexes, prints, strict=True):
                count = min(stop, len(own)) - start
                if count > 0:
                    window = sums[index.shingles : index.shingles + count] - sums[:count]
                    own[start : start + count] = packed(window)
        for index, own in zip(indexes, prints, strict=True):
            at, item = index.candidates(own)
            for i, j in zip(at.tolist(), item.tolist(), strict=True):
                text = int(owner[i])
                if i + index.shingles <= ends[text]:  # else it spans two texts
                    compare(text, i - int(heads[text]), index.items[j])
        least = min(i.shingles for i in indexes)
        for text in np.flatnonzero((n_shingles > 0) & (n_shingles < widest)).tolist():
            own = n_shingles[text]
            if own * 100 < self.percent * least:
                continue
            whole = packed(signs(shingles[text], np.int32).sum(axis=0)[None, :])
            for index in indexes:
                if own < index.shingles and own * 100 >= self.percent * index.shingles:
                    for j in index.candidates(whole)[1].tolist():
                        compare(text, 0, index.items[j])


def _parts(benchmark: DataFrame, part_words: int) -> Iterator[list[tuple[int, bytes]]]:
    """The benchmark's items, some ``part_words`` words at a time, or one longer item."""
    held = benchmark.where("text is not null and item_id is not null").select(
        F.col("item_id").cast("bigint").alias("item_id"), F.col("text").cast("string").alias("text")
    )
    part, words = [], 0
    for row in held.orderBy("item_id", "text").toLocalIterator():
        text = row["text"].encode()
        n = len(words_of(text))
        if part and words + n > part_words:
            yield part
            part, words = [], 0
        part.append((row["item_id"], text))
        words += n
    yield part


def leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    *carried: str,
    size: int = 5,
    percent: int = 80,
    radius: int = 15,
    step: int = 4,
    part_words: int = 100_000,
    all_rows: bool = False,
) -> DataFrame:
    """A row per document and item it leaks: the columns ``carried``, item_id, first_word,
    n_words and similarity of the best window.  With ``all_rows``, a row per document instead:
    the columns carried and ``leaked``."""
    names = list(carried)
    kept = docs.select(*names, *([] if "text" in names else ["text"]))
    kept = kept.withColumn("text", F.col("text").cast("string"))
    found: DataFrame | None = None
    for items in _parts(benchmark, part_words):
        scanner = docs.sparkSession.sparkContext.broadcast(Scanner(items, size, percent, radius, step))
        if not all_rows:
            rows = _found_rows(kept, names, scanner)
            found = rows if found is None else found.unionByName(rows)
        elif found is None:
            found = _marked_rows(kept, scanner)
        else:  # what is marked already is written and not searched again
            seen = materialize(found)
            more = _marked_rows(seen.where(~F.col(LEAKED)).drop(LEAKED), scanner)
            found = seen.where(F.col(LEAKED)).unionByName(more)
    if all_rows:
        return found.select(*names, F.col(LEAKED).alias("leaked"))
    return found


LEAKED = "_leaked"


def _found_rows(kept: DataFrame, names: list[str], shared) -> DataFrame:
    added = [T.StructField(c, T.LongType()) for c in ("item_id", "first_word", "n_words")]
    added.append(T.StructField("similarity", T.DoubleType()))
    schema = T.StructType([*[kept.schema[c] for c in names], *added])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = shared.value.rows(texts_of(batch))
            rows = pa.array([g[0] for g in got], pa.int64())
            columns = [c.take(rows) for c in batch.columns[: len(names)]]
            columns += [pa.array([g[k] for g in got], pa.int64()) for k in (1, 2, 3)]
            columns.append(pa.array([g[4] for g in got], pa.float64()))
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return map_in_arrow(kept, run, schema)


def _marked_rows(kept: DataFrame, shared) -> DataFrame:
    schema = T.StructType([*kept.schema.fields, T.StructField(LEAKED, T.BooleanType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaked = np.zeros(batch.num_rows, bool)
            leaked[[g[0] for g in shared.value.rows(texts_of(batch))]] = True
            columns = [*batch.columns, pa.array(leaked)]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return map_in_arrow(kept, run, schema)
