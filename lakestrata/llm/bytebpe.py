"""Byte-level BPE by one shuffle of distinct words, and back.

Encoding: texts are cut by the tokenizer's pattern into words (pre-tokens).  Blocks of documents
send out their distinct words, a row each, and keep the positions as a list of word numbers.  A
shuffle brings equal words together, each distinct word is encoded once, its ids go back to
the blocks that hold it, and a block's ids are put at their positions.  Decoding joins ids with the
table of the tokens' bytes, which is as large as the vocabulary and is broadcast.

No word is hot: a block sends a word once, however often it occurs, so the rows of one word are
at most as many as the blocks, and of all rows at most one in the distinct words of a block.
Equal words meet sorted and are read as a stream.  Three things are shuffled, each once: the
blocks' distinct words, their ids, and the lists of word numbers.

A block is some BLOCK_BYTES of text, or one longer text, and is put together in one task.  The
documents are read twice and must come in the same partitions and order, as a written table
does; others are written first (``written=False``), and a difference would be an error.

Defined cases: a null or empty text has no ids; every row counts, also repeated ones and those
without doc_id; an empty table gives no rows; other columns are not carried.
"""

from __future__ import annotations

import base64
import re
from array import array
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestrata.llm.common import CHUNK_BYTES, chunks, texts_of
from lakestrata.session import materialize

BLOCK_BYTES = 16 << 20
SEND = 1 << 20  # ids that wait in a task to be sent together
# A word's place: task (20 bits), block in the task (15 bits), number in the block.
NUMBER_BITS, BLOCK_BITS = 28, 15

WORDS = "word string, at bigint"
PARTS = "block bigint, docs binary, numbers binary, sizes binary, ids binary"
ENCODED = "doc_id bigint, ids array<int>"

# A space between two others that are not white space always begins a new word.
CUT = re.compile(r" (?<=\S )(?=\S)")


@dataclass(frozen=True)
class Ranks:
    """A vocabulary: the pattern that cuts texts into words, and the tokens' bytes by id."""

    pattern: str
    tokens: dict[int, bytes]

    @staticmethod
    def of_file(path: str, pattern: str) -> Ranks:
        """A file of lines ``base64 rank``."""
        with open(path, "rb") as lines:
            pairs = (line.split() for line in lines if line.strip())
            return Ranks(pattern, {int(rank): base64.b64decode(token) for token, rank in pairs})


# -- words and their positions ---------------------------------------------------------------


class Numbers:
    """The distinct words of a block, numbered as they come up.

    Texts are cut at spaces, which nearly always begin a word; what lies between two is cut
    by the pattern once in a block.  Where a space may belong to other white space, only those
    are cut at that certainly begin a word.
    """

    def __init__(self, pattern: regex.Pattern) -> None:
        self.pattern = pattern
        self.words: dict[str, int] = {}
        self.heads: dict[str, int] = {}  # first piece of a text -> its number
        self.rests: dict[str, int] = {}  # any other piece, behind its space
        self.flat = array("i")
        self.ends = array("i", [0])

    def _cut(self, texts: list[str]) -> tuple[list[str], list[list[str]], list[str]]:
        """(first pieces, other pieces of each text, those not known yet)"""
        cut = [t.split(" ") for t in texts]
        heads = [p.pop(0) for p in cut]
        known = self.rests
        new = [w for w in dict.fromkeys(chain.from_iterable(cut)) if w not in known]
        unsure = {w for w in new if not w or w[0].isspace() or w[-1].isspace()}
        odd = [
            i
            for i, (head, rest) in enumerate(zip(heads, cut, strict=True))
            if rest and (not head or head[-1].isspace() or not unsure.isdisjoint(rest))
        ]
        if odd:
            for i in odd:
                heads[i], *cut[i] = CUT.split(texts[i])
            new = [w for w in dict.fromkeys(chain.from_iterable(cut)) if w not in known]
        return heads, cut, new

    def _learn(self, known: dict[str, int], pieces: Iterable[str], start: str) -> None:
        words, flat, ends = self.words, self.flat, self.ends
        for piece in pieces:
            if piece.isalpha():
                found = (start + piece,)
            elif piece[-1:] in (".", ",") and piece[:-1].isalpha():
                found = (start + piece[:-1], piece[-1])
            else:
                found = self.pattern.findall(start + piece)
            for word in found:
                flat.append(words.setdefault(word, len(words)))
            known[piece] = len(ends) - 1
            ends.append(len(flat))

    def add(self, texts: list[str]) -> tuple[list[str], list[list[str]]]:
        """The pieces of the texts, all of them known from now on."""
        heads, cut, new = self._cut(texts)
        self._learn(self.heads, (w for w in dict.fromkeys(heads) if w not in self.heads), "")
        self._learn(self.rests, new, " ")
        return heads, cut

    def pieces(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(numbers of the texts' pieces, how many each text has)"""
        heads, cut = self.add(texts)
        n = np.array([1 + len(p) for p in cut])
        first = np.zeros(int(n.sum()), bool)
        first[np.cumsum(n) - n] = True
        out = np.empty(len(first), np.int32)
        out[first] = [self.heads[w] for w in heads]
        out[~first] = np.fromiter(
            map(self.rests.__getitem__, chain.from_iterable(cut)), np.int32, len(out) - len(n)
        )
        return out, n

    def sequence(self, pieces: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(numbers of the texts' words, how many each text has)"""
        bounds, flat = np.frombuffer(self.ends, np.int32), np.frombuffer(self.flat, np.int32)
        lengths = np.diff(bounds)[pieces]
        ends = np.cumsum(lengths, dtype=np.int64)
        place = np.repeat((bounds[pieces] - (ends - lengths)), lengths)
        place += np.arange(len(place))
        return flat[place], np.add.reduceat(lengths, np.cumsum(n) - n)


def pack(numbers: np.ndarray) -> bytes:
    """Numbers below 2**32, byte by byte: all lowest bytes, then all second ones, compressed."""
    raw = np.ascontiguousarray(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()
    return len(raw).to_bytes(8, "little") + pa.compress(raw, "zstd", asbytes=True)


def unpack(data: bytes) -> np.ndarray:
    size = int.from_bytes(data[:8], "little")
    raw = np.frombuffer(pa.decompress(data[8:], size, "zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(raw.reshape(4, -1).T).view("<u4").ravel().astype(np.int64)


def in_blocks(
    batches: Iterator[pa.RecordBatch], block_bytes: int
) -> Iterator[tuple[int, list, list[bytes]]]:
    """(block, doc_ids, texts): the same for the same rows, so blocks can be made twice."""
    block = TaskContext.get().partitionId() << BLOCK_BITS
    ids: list[int | None] = []
    texts: list[bytes] = []
    size = 0
    for batch in batches:
        whole, own = texts_of(batch), batch.column("doc_id").to_pylist()
        for a, b in chunks(whole, min(block_bytes, CHUNK_BYTES)):
            more = sum(map(len, whole[a:b]))
            if texts and size + more > block_bytes:
                yield block, ids, texts
                block, ids, texts, size = block + 1, [], [], 0
            ids += own[a:b]
            texts += whole[a:b]
            size += more
    if texts:
        yield block, ids, texts


def _decoded(texts: list[bytes]) -> Iterator[list[str]]:
    for a, b in chunks(texts, 1 << 20):
        yield [t.decode() for t in texts[a:b]]


def _send_words(pattern: str, block_bytes: int):
    """A row per distinct word of a block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut = regex.compile(pattern)
        for block, _, texts in in_blocks(batches, block_bytes):
            numbers = Numbers(cut)
            for part in _decoded(texts):
                numbers.add(part)
            words = list(numbers.words)
            del numbers
            at = (block << NUMBER_BITS) + np.arange(len(words))
            for a, b in _parts([len(w) for w in words]):
                yield pa.record_batch({"word": pa.array(words[a:b]), "at": pa.array(at[a:b])})

    return run


def _keep_places(pattern: str, block_bytes: int):
    """A block's documents and, as word numbers, their words; a row per block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut = regex.compile(pattern)
        for block, doc_ids, texts in in_blocks(batches, block_bytes):
            numbers = Numbers(cut)
            pieces = [numbers.pieces(part) for part in _decoded(texts)]
            found = [numbers.sequence(*p) for p in pieces]
            del numbers, pieces
            ids = pa.record_batch({"doc_id": pa.array(doc_ids, pa.int64())})
            with pa.BufferOutputStream() as out:
                with pa.ipc.new_stream(out, ids.schema) as stream:
                    stream.write_batch(ids)
                docs = out.getvalue().to_pybytes()
            yield _part(
                block,
                docs,
                pack(np.concatenate([s for s, _ in found])),
                pack(np.concatenate([n for _, n in found])),
                None,
            )

    return run


def _part(block: int, docs, numbers, sizes, ids) -> pa.RecordBatch:
    own = {"docs": docs, "numbers": numbers, "sizes": sizes, "ids": ids}
    columns = {name: pa.array([value], pa.binary()) for name, value in own.items()}
    return pa.record_batch({"block": pa.array([block], pa.int64()), **columns})


# -- ids of words ---------------------------------------------------------------------------


@lru_cache(maxsize=1)
def _library(ranks):
    import tiktoken

    known = {token: rank for rank, token in ranks.value.tokens.items()}
    return tiktoken.Encoding(
        "own", pat_str=ranks.value.pattern, mergeable_ranks=known, special_tokens={}
    )


def _encode_words(ranks):
    """Sorted words in, each encoded when it comes up; out go the ids, by block."""

    def send(at: list[np.ndarray], ids: list[list[int]], reps: list[int]):
        place, reps = np.concatenate(at), np.array(reps)
        sizes = np.array([len(x) for x in ids])
        flat = np.fromiter(chain.from_iterable(ids), np.int64, int(sizes.sum()))
        starts = np.cumsum(sizes) - sizes
        word = np.repeat(np.arange(len(ids)), reps)
        order = np.argsort(place)
        place, word = place[order], word[order]
        block = place >> NUMBER_BITS
        cuts = np.flatnonzero(np.diff(block, prepend=-1))
        for a, b in zip(cuts, [*cuts[1:], len(place)], strict=True):
            own = word[a:b]
            n = sizes[own]
            ends = np.cumsum(n)
            took = flat[np.arange(int(ends[-1])) + np.repeat(starts[own] - (ends - n), n)]
            numbers = place[a:b] & ((1 << NUMBER_BITS) - 1)
            steps = np.diff(numbers, prepend=0)
            yield _part(int(block[a]), None, pack(steps), pack(n), pack(took))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _library(ranks).encode_ordinary
        last, at, ids, reps, held = None, [], [], [], 0
        for batch in batches:
            at.append(batch.column("at").to_numpy())
            held += batch.num_rows
            for word in batch.column("word").to_pylist():
                if word == last:
                    reps[-1] += 1
                else:
                    last = word
                    ids.append(encode(word))
                    reps.append(1)
                    held += len(ids[-1])
            if held >= SEND:
                yield from send(at, ids, reps)
                # The last word may go on.
                at, ids, reps, held = [], [ids[-1]], [0], len(ids[-1])
        if at:
            yield from send(at, ids, reps)

    return run


def _at_places(table: pa.Table) -> pa.Table:
    """A block's words put at their positions: the ids of each of its documents."""
    is_docs = table["docs"].is_valid()
    kept = table.filter(is_docs).to_pylist()
    sent = table.filter(pa.compute.invert(is_docs)).to_pylist()
    if len(kept) != 1:
        raise ValueError("a block was made twice: the documents must be a written table")
    with pa.ipc.open_stream(kept[0]["docs"]) as stream:
        doc_ids = stream.read_all()["doc_id"].combine_chunks()
    row, doc_words = unpack(kept[0]["numbers"]).astype(np.int32), unpack(kept[0]["sizes"])
    numbers = np.concatenate([np.cumsum(unpack(s["numbers"])) for s in sent] or [row[:0]])
    sizes = np.concatenate([unpack(s["sizes"]) for s in sent] or [row[:0]])
    flat = np.concatenate([unpack(s["ids"]).astype(np.int32) for s in sent] or [row[:0]])
    n_words = int(row.max()) + 1 if len(row) else 0
    if len(numbers) != n_words or not np.array_equal(np.sort(numbers), np.arange(n_words)):
        raise ValueError("a block's words differ: the documents must be a written table")
    starts, lengths = np.empty(n_words, np.int64), np.empty(n_words, np.int64)
    starts[numbers], lengths[numbers] = np.cumsum(sizes) - sizes, sizes
    bounds = np.concatenate([[0], np.cumsum(doc_words)])
    parts, ends = [], [0]
    # Some million ids at a time, by document.
    for a, b in _parts(doc_words, 1 << 20):
        own = row[bounds[a] : bounds[b]]
        n = lengths[own]
        stop = np.cumsum(n)
        total = int(stop[-1]) if len(stop) else 0
        parts.append(flat[np.arange(total) + np.repeat(starts[own] - (stop - n), n)])
        upto = np.concatenate([[0], stop])[bounds[a + 1 : b + 1] - bounds[a]]
        ends += (ends[-1] + upto).tolist()
    out = np.concatenate(parts) if parts else flat[:0]
    lists = pa.ListArray.from_arrays(
        pa.array(ends, pa.int32()), pa.array(out.astype(np.int32, copy=False))
    )
    return pa.table({"doc_id": doc_ids, "ids": lists})


def encode(
    docs: DataFrame, ranks: Ranks, written: bool = True, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """(doc_id, ids) of every row; ``written``: ``docs`` is read from a table as it is."""
    sent = docs.sparkSession.sparkContext.broadcast(ranks)
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")
    )
    if not written:
        rows = materialize(rows)
    words = rows.mapInArrow(_send_words(ranks.pattern, block_bytes), WORDS)
    ids = words.repartition("word").sortWithinPartitions("word").mapInArrow(
        _encode_words(sent), PARTS
    )
    places = rows.mapInArrow(_keep_places(ranks.pattern, block_bytes), PARTS)
    return places.unionByName(ids).groupBy("block").applyInArrow(_at_places, ENCODED)


# -- bytes of ids ----------------------------------------------------------------------------


class ByteTable:
    """Bytes by id, end to end."""

    def __init__(self, tokens: dict[int, bytes]) -> None:
        size = 1 + max(tokens, default=-1)
        held = [tokens.get(i, b"") for i in range(size)]
        self.data = np.frombuffer(b"".join(held), np.uint8)
        self.lengths = np.array([len(t) for t in held], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths

    def of(self, ids: np.ndarray) -> bytes:
        lengths = self.lengths[ids]
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        return self.data[
            np.arange(total) + np.repeat(self.starts[ids] - (ends - lengths), lengths)
        ].tobytes()


@lru_cache(maxsize=1)
def _bytes(ranks) -> ByteTable:
    return ByteTable(ranks.value.tokens)


def decode(encoded: DataFrame, ranks: Ranks) -> DataFrame:
    """(doc_id, ids, decoded): the bytes of the ids, by a map-side join with the tokens' bytes."""
    sent = encoded.sparkSession.sparkContext.broadcast(ranks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _bytes(sent)
        for batch in batches:
            ids = batch.column("ids")
            flat, lengths = ids.flatten().to_numpy(), pa.compute.list_value_length(ids).to_numpy()
            ends = np.cumsum(lengths)
            for a, b in _parts(lengths):
                own = slice(a, b)
                out = [table.of(flat[e - n : e]) for n, e in zip(lengths[own], ends[own], strict=True)]
                part = batch.slice(a, b - a)
                yield pa.record_batch(
                    {
                        "doc_id": part.column("doc_id"),
                        "ids": part.column("ids"),
                        "decoded": pa.array(out, pa.binary()),
                    }
                )

    return encoded.select("doc_id", "ids").mapInArrow(run, f"{ENCODED}, decoded binary")


def _parts(lengths: Iterable[int], limit: int = 1 << 19) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about ``limit`` in all."""
    start, held = 0, 0
    lengths = [int(n) for n in lengths]
    for i, n in enumerate(lengths):
        if held and held + n > limit:
            yield start, i
            start, held = i, 0
        held += n
    if start < len(lengths):
        yield start, len(lengths)


def digest(decoded: DataFrame) -> DataFrame:
    """Per document the number of its ids and sha256 of the ids and of the decoded bytes."""
    return decoded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
