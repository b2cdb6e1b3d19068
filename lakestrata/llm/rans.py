"""Static range asymmetric numeral system over token ids, in numpy.

A block codes its ids over ``lanes`` interleaved states: id i belongs to lane
i mod lanes, and one step codes one id of every lane.  States are 64 bits wide, renormalised
32 bits at a time, with probabilities of 2**-20.  The stream is read forwards; every
``interval`` steps a checkpoint notes the place in the stream and the states, so parts of a
block can be decoded side by side.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np

BITS = 20
LOW = np.uint64(1 << 31)
U32, U64 = np.uint64(32), np.uint64(BITS)
MASK32, MASK = np.uint64(0xFFFFFFFF), np.uint64((1 << BITS) - 1)


@dataclass
class Table:
    """Frequencies that add up to 2**20, and what coding and decoding look up."""

    freq: np.ndarray

    def __post_init__(self) -> None:
        self.start = np.concatenate([[0], np.cumsum(self.freq)[:-1]]).astype(np.uint64)
        self.freq = self.freq.astype(np.uint64)
        self._slots: np.ndarray | None = None

    @property
    def slots(self) -> np.ndarray:
        if self._slots is None:
            self._slots = np.repeat(
                np.arange(len(self.freq), dtype=np.uint32), self.freq.astype(np.int64)
            )
        return self._slots

    @staticmethod
    def of_counts(counts: np.ndarray) -> Table:
        """Counts scaled to 2**20; an id that occurs keeps at least 1."""
        size, total = 1 << BITS, int(counts.sum())
        if not total:
            return Table(np.zeros(len(counts), np.int64))
        freq = np.where(
            counts > 0, np.maximum(1, np.floor(counts * (size / total))), 0
        ).astype(np.int64)
        order = np.argsort(-freq, kind="stable")
        excess = int(freq.sum()) - size
        if excess <= 0:
            freq[order[0]] -= excess
            return Table(freq)
        for i in order:  # the largest give what the raised ones took
            give = min(excess, int(freq[i]) // 2)
            freq[i] -= give
            excess -= give
            if not excess:
                break
        return Table(freq)


def encode(ids: np.ndarray, table: Table, lanes: int = 512, interval: int = 128) -> dict:
    """One block: states to start from, words of the stream, checkpoints, checksum."""
    steps = -(-len(ids) // lanes)
    state = np.full(lanes, LOW, np.uint64)
    parts: list[np.ndarray] = []
    marks: list[tuple[int, np.ndarray]] = []
    written = 0
    freq, start = table.freq[ids], table.start[ids]
    for step in range(steps - 1, -1, -1):
        a, b = step * lanes, min((step + 1) * lanes, len(ids))
        f, c, x = freq[a:b], start[a:b], state[: b - a]
        over = x >= (f << np.uint64(31 - BITS + 32))
        if over.any():
            out = (x[over] & MASK32).astype(np.uint32)
            parts.append(out)
            written += len(out)
            x = np.where(over, x >> U32, x)
        div = x // f
        state[: b - a] = (div << U64) + (x - div * f) + c
        if step and step % interval == 0:
            marks.append((written, state.copy()))
    stream = np.concatenate(parts[::-1]) if parts else np.zeros(0, np.uint32)
    payload = stream.astype("<u4").tobytes()
    return {
        "n_ids": len(ids),
        "lanes": lanes,
        "interval": interval,
        "states": state.astype("<u8").tobytes(),
        "mark_places": [written - at for at, _ in marks[::-1]],
        "mark_states": [s.astype("<u8").tobytes() for _, s in marks[::-1]],
        "payload": payload,
        "checksum": zlib.crc32(payload, zlib.crc32(state.astype("<u8").tobytes())),
    }


def decode(block: dict, table: Table, part: int | None = None) -> np.ndarray:
    """The ids of a block, or of the part that begins at checkpoint ``part`` (0: the start)."""
    states, payload = block["states"], block["payload"]
    if zlib.crc32(payload, zlib.crc32(states)) != block["checksum"]:
        raise ValueError("damaged block: its checksum differs")
    n, lanes, interval = block["n_ids"], block["lanes"], block["interval"]
    steps, at, first = -(-n // lanes), 0, 0
    last = steps
    if part is not None:
        first, last = part * interval, min(steps, (part + 1) * interval)
        if part:
            states = block["mark_states"][part - 1]
            at = block["mark_places"][part - 1]
    state = np.frombuffer(states, "<u8").astype(np.uint64)
    stream = np.frombuffer(payload, "<u4").astype(np.uint64)
    ids = np.empty(max(0, min(n, last * lanes) - first * lanes), np.uint32)
    for step in range(first, last):
        a, b = step * lanes, min((step + 1) * lanes, n)
        x = state[: b - a]
        slot = x & MASK
        found = table.slots[slot]
        ids[a - first * lanes : b - first * lanes] = found
        x = table.freq[found] * (x >> U64) + slot - table.start[found]
        low = np.flatnonzero(x < LOW)
        if len(low):
            x[low] = (x[low] << U32) | stream[at : at + len(low)]
            at += len(low)
        state[: b - a] = x
    return ids
