"""Periodic runs of words, found by convolving blocks with the windows behind them.

A run is a stretch of consecutive words with smallest period q (words q apart are equal), at least
max(LEAST, 3 q) words long, that no neighbouring word extends keeping period q.

Words become integers.  At scale L = 8, 16, 32, ... the sequence is cut into blocks of L words at
multiples of L.  A run of period q holds a whole block together with the copy of it q words on,
for the scale L <= q < 2 L (L = 8 serves all q < 16), so the block occurs in the window behind it at
distance q.  The sums of squared differences of a block to all places of the window are
block squares + window squares - 2 * correlation; the correlation is a number-theoretic
transform modulo two primes, exact in integers.  A place where both remainders are zero is an
occurrence (the sum is below the product of the primes; were it not, words are compared next anyway).  Each
occurrence is a seed: its stretch of equal words at that distance is extended to both sides
by comparing words, and kept if it is long enough.

Nothing is searched that cannot be a run, and nothing else is left out: a block takes no part if
one of its words does not recur within the window, or if it lies, with its windows, inside a run
already found at a shorter period q <= L (all its occurrences are then at multiples of q, by
Fine and Wilf); a seed takes no part if a run of a divisor of its distance holds it and its copy.
So smaller periods come first and every stretch that is kept has its smallest period.

Texts are searched many at a time, joined by numbers that occur once.  Memory goes with the
longest text.  Scales beyond MAX_BLOCK keep blocks of MAX_BLOCK words and take several windows.

Defined cases: a null or empty text has no words, no runs and an empty collapsed text; every
row counts, also repeated ones and those without doc_id; an empty table gives no rows; other
columns are not carried.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakestrata.llm.common import chunks, texts_of

LEAST = 24
BASE = 8
MAX_BLOCK = 1 << 16
BATCH = 1 << 17  # numbers transformed at once
# NTT primes c * 2**k + 1 and a primitive root of each; fixed values.
PRIMES = ((2013265921, 31), (2113929217, 5))

RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"
FOUND = f"doc_id bigint, n_words bigint, runs {RUNS}, collapsed string"


# -- number-theoretic transform -----------------------------------------------------------


@lru_cache(maxsize=64)
def _roots(prime: int, root: int, size: int) -> np.ndarray:
    """The first size / 2 powers of a primitive size-th root of unity."""
    step = pow(root, (prime - 1) // size, prime)
    out = np.ones(max(1, size // 2), np.uint64)
    done = 1
    while done < len(out):
        out[done : 2 * done] = out[:done] * np.uint64(pow(step, done, prime)) % np.uint64(prime)
        done *= 2
    return out


def ntt(x: np.ndarray, prime: int, root: int) -> np.ndarray:
    """The transform of every row modulo ``prime``; in order, by repeated halving (Stockham)."""
    rows, size = x.shape
    p = np.uint64(prime)
    x, half, stride = x.reshape(rows, size, 1), size // 2, 1
    while half:
        turn = _roots(prime, root, 2 * half)[:, None]
        a, b = x[:, :half, :], x[:, half:, :]
        out = np.empty((rows, half, 2, stride), np.uint64)
        total = a + b
        out[:, :, 0, :] = np.minimum(total, total - p)  # unsigned: the one below p
        out[:, :, 1, :] = (a + (p - b)) * turn % p
        half, stride = half // 2, stride * 2
        x = out.reshape(rows, 2 * half or 1, stride)
    return x.reshape(rows, size)


def correlations(blocks: np.ndarray, windows: np.ndarray, prime: int, root: int) -> np.ndarray:
    """out[r, d] = sum over i of blocks[r, i] * windows[r, i + d] modulo ``prime``, for all d
    at which the block ends inside the window."""
    rows, size = windows.shape
    n = 1 << max(1, (size - 1).bit_length())
    p = np.uint64(prime)
    padded = np.zeros((2, rows, n), np.uint64)
    padded[0, :, : blocks.shape[1]] = blocks[:, ::-1] % p
    padded[1, :, :size] = windows % p
    a, b = (ntt(x, prime, root) for x in padded)
    product = ntt(a * b % p, prime, pow(root, prime - 2, prime))
    product = product * np.uint64(pow(n, prime - 2, prime)) % p
    last = blocks.shape[1] - 1
    return product[:, last:size]


def zero_mismatches(blocks: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """Whether each block's words stand at each place of its window: the sum of
    squared differences is zero."""
    n = blocks.shape[1]
    out = None
    for prime, root in PRIMES:
        p = np.uint64(prime)
        squares = np.cumsum(windows * windows % p, axis=1)
        squares = np.concatenate([np.zeros((len(squares), 1), np.uint64), squares], axis=1)
        own = (blocks * blocks % p).sum(axis=1, dtype=np.uint64)[:, None]
        both = (own + squares[:, n:] - squares[:, :-n]) % p
        zero = both == 2 * correlations(blocks, windows, prime, root) % p
        out = zero if out is None else out & zero
    return out


# -- runs of a sequence ---------------------------------------------------------------------


def gaps(x: np.ndarray) -> np.ndarray:
    """How far on each number occurs again; the length of ``x`` if it does not."""
    order = np.argsort(x, kind="stable")
    out = np.full(len(x), len(x), np.int64)
    same = x[order[1:]] == x[order[:-1]]
    out[order[:-1][same]] = np.diff(order)[same]
    return out


def equal_on(x: np.ndarray, at: int, d: int, step: int) -> int:
    """How many words on from ``at`` (back, if step is -1) equal those d further on."""
    n, size = 0, 64
    while True:
        if step > 0:
            a, b = at + n, min(at + n + size, len(x) - d)
        else:
            a, b = max(0, at + 1 - n - size), at + 1 - n
        if a >= b:
            return n
        same = x[a:b] == x[a + d : b + d]
        if step < 0:
            same = same[::-1]
        if not same.all():
            return n + int(same.argmin())
        n, size = n + b - a, size * 2


class Found:
    """The runs of a sequence so far, as (start, end, period)."""

    def __init__(self, x: np.ndarray, least: int) -> None:
        self.x, self.least = x, least
        self.runs: list[tuple[int, int, int]] = []

    def cover(self, starts: np.ndarray, length: int) -> np.ndarray:
        """(end, period) per block start, of the run of a period up to ``length`` that holds
        2 * length words from there; there is at most one.  (0, 1): none."""
        need = 2 * length
        out = np.zeros((2, len(starts)), np.int64)
        out[1] = 1
        for start, end, period in self.runs:
            if period <= length and end - start >= need:
                a = np.searchsorted(starts, start)
                b = np.searchsorted(starts, end - need, side="right")
                out[0, a:b], out[1, a:b] = end, period
        return out

    def extend(self, seeds: np.ndarray, length: int, d: int) -> None:
        """Stretches of distance d around the blocks of ``length`` at these places."""
        done = -1
        for s in seeds.tolist():
            if s < done:
                continue
            first = s - equal_on(self.x, s - 1, d, -1)
            done = s + length + equal_on(self.x, s + length, d, 1)
            if done + d - first >= max(self.least, 3 * d):
                self.runs.append((first, done + d, d))


def runs_of(x: np.ndarray, longest: int, least: int = LEAST) -> list[tuple[int, int, int]]:
    """All runs (start, end, period) of ``x``, by start and period; no run is longer than
    ``longest`` (numbers that occur once part the sequences in ``x``)."""
    x = np.ascontiguousarray(x, dtype=np.uint64)
    n = len(x)
    found = Found(x, least)
    gap = gaps(x.view(np.int64))
    # Beyond the end stands a number of its own, which ends every match.
    room = 4 * MAX_BLOCK if n > 4 * MAX_BLOCK else 4 * max(BASE, 1 << n.bit_length())
    padded = np.concatenate([x, np.full(room, x.max(initial=0) + np.uint64(1), np.uint64)])
    near = 1
    while near < 2 or 3 * near <= longest:
        low, high = (1, 2 * BASE) if near < BASE else (near, 2 * near)
        length = min(max(near, BASE), MAX_BLOCK)
        starts = np.arange(0, n - length + 1, length)
        if len(starts):
            widest = np.maximum.reduceat(gap, starts)
            if len(starts) * length < n:  # the last piece ran on to the end
                widest[-1] = gap[starts[-1] : starts[-1] + length].max()
            starts = starts[widest < high]
        if low > 1 and len(starts):
            end, _ = found.cover(starts, length)
            starts = starts[end < starts + length + high - 1]
        width = length if low > 1 else high
        for first in range(low, high, width):
            _search(found, padded, starts, length, first, min(high, first + width))
        near = 2 * (BASE if near < BASE else near)
    smallest: dict[tuple[int, int], int] = {}
    for first, end, period in found.runs:
        smallest[first, end] = min(period, smallest.get((first, end), period))
    return sorted(((a, b, q) for (a, b), q in smallest.items()), key=lambda r: (r[0], r[2]))


def _search(
    found: Found, padded: np.ndarray, starts: np.ndarray, length: int, low: int, high: int
) -> None:
    """Seeds of the blocks at distances low ... high - 1, extended by ascending distance."""
    size = length + high - 1 - low
    seeds, distances = [], []
    # The copy may not begin beyond the end.
    starts = starts[starts + low < len(found.x)]
    step = max(1, BATCH // (2 * size))
    for a in range(0, len(starts), step):
        part = starts[a : a + step]
        windows = np.lib.stride_tricks.sliding_window_view(padded, size)[part + low]
        blocks = np.lib.stride_tricks.sliding_window_view(padded, length)[part]
        block, d = np.nonzero(zero_mismatches(blocks, windows))
        seeds.append(part[block])
        distances.append(d + low)
    if not seeds:
        return
    seed, distance = np.concatenate(seeds), np.concatenate(distances)
    order = np.lexsort((seed, distance))
    seed, distance = seed[order], distance[order]
    if low > 1:
        end, period = found.cover(starts, length)
        at = np.searchsorted(starts, seed)
        inside = (seed + length + distance <= end[at]) & (distance % period[at] == 0)
        seed, distance = seed[~inside], distance[~inside]
    for part in np.split(np.arange(len(seed)), np.flatnonzero(np.diff(distance)) + 1):
        if not len(part):
            continue
        d, own = int(distance[part[0]]), seed[part]
        if low == 1 and d > 1:
            # Small distances: runs of a divisor may have come up just now.
            for q in range(1, d):
                if d % q == 0:
                    own = own[~_inside(found, starts, own, length + d, q)]
        found.extend(own, length, d)


def _inside(found: Found, starts: np.ndarray, seeds: np.ndarray, need: int, q: int) -> np.ndarray:
    out = np.zeros(len(seeds), bool)
    for start, end, period in found.runs:
        if period == q and end - start >= need:
            out |= (seeds >= start) & (seeds + need <= end)
    return out


# -- documents --------------------------------------------------------------------------------


class Numbers(dict):
    """word -> its number, in order of appearance."""

    def __missing__(self, word: bytes) -> int:
        at = self[word] = len(self)
        return at


def search(texts: list[bytes]) -> list[tuple[list[bytes], list[tuple[int, int, int]]]]:
    """Words and runs of each text."""
    words = [t.split() for t in texts]
    numbers = Numbers()
    n_words = [len(w) for w in words]
    flat = np.fromiter(map(numbers.__getitem__, chain.from_iterable(words)), np.int64, sum(n_words))
    ends = np.cumsum(n_words)
    # A number that occurs once stands behind every text.
    x = np.insert(flat, ends, len(numbers) + np.arange(len(texts)))
    starts = ends - n_words + np.arange(len(texts))
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for first, end, period in runs_of(x, max(n_words, default=0)):
        doc = int(np.searchsorted(starts, first, side="right")) - 1
        at = int(starts[doc])
        out[doc].append((first - at, end - first, period))
    return list(zip(words, out, strict=True))


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words but for those of a run after its first period."""
    if not runs:
        return b" ".join(words)
    change = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    keep = np.flatnonzero(np.cumsum(change[:-1]) == 0)
    return b" ".join([words[i] for i in keep.tolist()])


def find_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, runs, collapsed) of every row; runs by start, then period."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = texts_of(batch)
            for a, b in chunks(texts):
                found = search(texts[a:b])
                lists = [
                    [{"start": s, "length": n, "period": q} for s, n, q in runs] for _, runs in found
                ]
                yield pa.record_batch(
                    {
                        "doc_id": batch.column("doc_id").slice(a, b - a),
                        "n_words": pa.array([len(w) for w, _ in found], pa.int64()),
                        "runs": pa.array(lists, RUN_LIST),
                        "collapsed": pa.array([collapse(*f) for f in found], pa.binary()).cast(
                            pa.string()
                        ),
                    }
                )

    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")
    ).mapInArrow(run, FOUND)


RUN_LIST = pa.list_(
    pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
)


def with_periodic_tails(docs: DataFrame) -> DataFrame:
    """(doc_id, text): with h = crc32 of the decimal doc_id, g = h // 10 and n words, a text with
    h % 10 = 0 repeats, from word a = g % n on, the p = 1 + (n - a) // (3 + g % 8) words from there.
    Rows without doc_id stay as they are."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.regexp_extract_all(F.col("text"), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    hit = docs.select("doc_id", "text", F.when(h % 10 == 0, words).alias("w")).select(
        "doc_id", "text", "w", F.floor(h / 10).alias("g"), F.size("w").alias("n")
    )
    tail = (
        hit.withColumn("a", F.expr("if(n > 0, g % n, 0)"))
        .withColumn("p", F.expr("1 + floor((n - a) / (3 + g % 8))"))
        .withColumn(
            "turned",
            F.expr(
                "array_join(transform(sequence(0, n - 1), "
                "i -> if(i < a, w[i], w[int(a + (i - a) % p)])), ' ')"
            ),
        )
    )
    return tail.select("doc_id", F.expr("if(n > 0, turned, text)").alias("text"))


def _lines(runs: Column) -> Column:
    line = lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    return F.concat_ws("", F.transform(runs, lambda r: F.concat(line(r), F.lit("\n"))))


def digest(found: DataFrame) -> DataFrame:
    """Per document the number of runs, the run of the greatest length / period, and sha256 of
    the list of runs and of the collapsed text."""
    # a / b against c / d as a * d against c * b, exactly.
    best = F.expr(
        "reduce(runs, cast(null as struct<start:bigint,length:bigint,period:bigint>), (b, r) -> "
        "if(b is null or r.length * b.period > b.length * r.period, r, b))"
    )
    return found.select("*", best.alias("best")).select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        F.col("best.start").alias("start"),
        F.col("best.length").alias("length"),
        F.col("best.period").alias("period"),
        F.expr("(1000 * best.length) div best.period").alias("exponent_milli"),
        F.sha2(_lines(F.col("runs")), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed"), 256).alias("collapsed_sha256"),
    )
