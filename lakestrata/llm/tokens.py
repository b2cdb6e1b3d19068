"""Token ids of documents, written to compressed, independently readable blocks.

``write`` encodes whole texts with a tokenizer of the ``tokenizers`` library, orders
documents by ``doc_id`` and stores blocks coded by a static range asymmetric numeral system
(see ``rans``) under one frequency table counted over all ids.  ``read`` gives the ids back.

Format: a folder with ``blocks`` (Parquet; a row per block: the documents it holds, the coded
ids, checkpoints and checksum), ``table`` (token, freq) and ``parts`` (the number of ids
before each part).  Blocks hold whole documents and are decoded on their own.

Defined cases: a null or empty text has only the end id; documents without id come
first; rows of equal id are ordered by their text's hash; an empty table gives an
empty folder of blocks.  Other columns are not carried.
"""

from __future__ import annotations

import gc
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain
from operator import attrgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lakestrata.llm import rans
from lakestrata.llm.common import chunks, map_in_arrow, texts_of
from lakestrata.session import materialize, shared_dir

BLOCK_IDS = 262_144
LANES = 1024
PARTITION_IDS = 16_000_000
MEMO_BYTES = 48 << 20
ENTRY_BYTES = 64  # of a remembered word besides its letters and ids, most of it while looked up
ROWS, TEXT_BYTES = 4000, 4 << 20  # looked up at once
# Small letters that neither combine nor change when lowered.
LETTERS = "abcdefghijklmnopqrstuvwxyzßàáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿ"


def as_numpy(array: pa.Array) -> np.ndarray:
    return array.to_numpy(zero_copy_only=False)


def gather(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """These stretches of ``flat``, one after the other."""
    ends = np.cumsum(lengths, dtype=np.int64)
    total = int(ends[-1]) if len(ends) else 0
    kind = np.int32 if max(total, len(flat)) < 1 << 31 else np.int64
    at = np.arange(total, dtype=kind)
    at += np.repeat((starts - (ends - lengths)).astype(kind), lengths)
    return flat[at]


class WordIds:
    """Ids of whole texts, looked up by word.

    A tokenizer that drops white space joins nothing across it, so a text's ids are those of
    its words in order.  Arrow cuts many texts at once and finds their distinct words; those not
    seen yet are encoded by the library, many in one call; some MEMO_BYTES of them are
    remembered, then all but the first half are forgotten.  Texts of other tokenizers are
    encoded whole.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        own = lambda t: self.library.encode(t, add_special_tokens=False).ids
        self.by_word = own("as. b\n c") == own("as") + own(".") + own("b") + own("c")
        self.lowers = own("AZ") == own("az")
        self.model = self.library.model
        self.spelling = self._spelling()
        self.base: tuple[int, int, int] | None = None
        self._forget()

    def _forget(self) -> None:
        """All words, but those that came up first, which are mostly the frequent ones."""
        if self.base:
            count, self.used, self.letters = self.base
            self.known = pa.concat_arrays([self.known[:count]])
            return
        self.known = pa.array([], pa.string())
        self.flat, self.used = np.zeros(1 << 16, np.uint32), 0
        self.starts = np.zeros(1 << 16, np.int32)
        self.lengths = np.zeros(1 << 16, np.int32)
        self.letters = 0

    def _held(self) -> int:
        """About how many bytes the memory takes."""
        return self.letters + ENTRY_BYTES * len(self.known) + 4 * self.used

    def _remember(self, places: np.ndarray, ids: np.ndarray, lengths: np.ndarray) -> None:
        """The ids of the words of these numbers, one after the other."""
        used = self.used + len(ids)
        if used > len(self.flat):
            self.flat = np.resize(self.flat, 2 * used)
        self.flat[self.used : used] = ids
        self.lengths[places] = lengths
        self.starts[places] = self.used + np.cumsum(lengths) - lengths
        self.used = used

    def _spelling(self) -> dict[int, str] | None:
        """How the library's model sees LETTERS, where words of them reach it whole, letter by
        letter; None where they do not, tested on all their pairs."""
        normalizer, cutter = self.library.normalizer, self.library.pre_tokenizer

        def pieces(text: str) -> list[str]:
            same = normalizer.normalize_str(text) if normalizer else text
            return [p for p, _ in cutter.pre_tokenize_str(same)] if cutter else [same]

        pairs = "".join(a + b for a in LETTERS for b in LETTERS)
        if normalizer and normalizer.normalize_str(pairs) != pairs:
            return None
        spelt = {ord(c): "".join(pieces(c)) for c in LETTERS}
        said = self.library.encode(pairs, add_special_tokens=False).ids
        whole = pieces(pairs) == [pairs.translate(spelt)]
        if not whole or said != [t.id for t in self.model.tokenize(pairs.translate(spelt))]:
            return None
        return {c: text for c, text in spelt.items() if text != chr(c)}

    def _encode_spelt(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of words of LETTERS and how many each has: the library's model alone, since
        its other steps leave them as they are."""
        if self.spelling:
            texts = [t if t.isascii() else t.translate(self.spelling) for t in texts]
        said = list(map(self.model.tokenize, texts))
        lengths = np.fromiter(map(len, said), np.int64, len(said))
        ids = map(attrgetter("id"), chain.from_iterable(said))
        return np.fromiter(ids, np.uint32, int(lengths.sum())), lengths

    def _encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The words' ids and how many each has, by one call for many words, told apart by
        offsets."""
        said = self.library.encode(" ".join(texts), add_special_tokens=False)
        ids = np.array(said.ids, np.uint32)
        at = np.fromiter((a for a, _ in said.offsets), np.int64, len(ids))
        ends = np.cumsum([len(t) + 1 for t in texts])
        return ids, np.diff(np.concatenate([[0], np.searchsorted(at, ends[:-1]), [len(ids)]]))

    def _learn(self, new: pa.StringArray) -> None:
        """Find and remember the ids of new words; their numbers follow those of the others."""
        before, count = len(self.known), len(self.known) + len(new)
        if count > len(self.starts):
            self.starts, self.lengths = (
                np.resize(x, 2 * count) for x in (self.starts, self.lengths)
            )
        plain = np.zeros(len(new), bool)
        if self.spelling is not None:
            plain = as_numpy(pc.match_substring_regex(new, f"^[{LETTERS}]+$"))
        for which, encode in ((plain, self._encode_spelt), (~plain, self._encode)):
            places, texts = before + np.flatnonzero(which), new.filter(pa.array(which)).to_pylist()
            for a, b in chunks(texts, 1 << 16):
                self._remember(places[a:b], *encode(texts[a:b]))
        self.letters += pc.sum(pc.binary_length(new)).as_py() or 0
        self.known = pa.concat_arrays([self.known, new])

    def _places(self, words: pa.StringArray) -> np.ndarray:
        """The numbers of different words."""
        found = pc.index_in(words, value_set=self.known)
        places = as_numpy(found.fill_null(-1))
        if found.null_count:
            fresh = places < 0
            places = places.copy()
            places[fresh] = len(self.known) + np.arange(found.null_count)
            self._learn(words.filter(pa.array(fresh)))
        return places

    def _word_ids(self, words: pa.StringArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The ids of different words, and where each one's start and how many they are.  A letter
        or digit followed by one stop or comma at the end splits there; the halves are remembered."""
        split = pc.match_substring_regex(words, "[0-9A-Za-z][.,]$")
        ended = words.filter(split)
        halves = [pc.utf8_slice_codeunits(ended, 0, -1), pc.utf8_slice_codeunits(ended, -1)]
        units = pa.concat_arrays([words.filter(pc.invert(split)), *halves]).dictionary_encode()
        places = self._places(units.dictionary)[as_numpy(units.indices)]
        split = as_numpy(split)
        # Two places a word: its own or its stem's, and its stop's if any.
        both = np.full((len(words), 2), -1, places.dtype)
        first, stem, stop = np.split(places, [len(words) - len(ended), len(words)])
        both[~split, 0], both[split, 0], both[split, 1] = first, stem, stop
        lengths = self.lengths[both[:, 0]]
        lengths[split] += self.lengths[stop]
        held = both.ravel()
        held = held[held >= 0]
        ids = gather(self.flat, self.starts[held], self.lengths[held])
        return ids, np.cumsum(lengths) - lengths, lengths

    def _lowered(self, text: bytes) -> bytes:
        """A-Z are lowered first, as the library would, where no combining mark (bytes CC,
        CD) could join a letter and no special token is spelt out."""
        marked = b"\xcc" in text or b"\xcd" in text or b"<|" in text
        return text.lower() if self.lowers and not marked else text

    def of(self, texts: list[bytes], end: int | None) -> list[np.ndarray]:
        """The ids of each text, with the end id behind them.  No cycles are made here, so no
        collector need look through the many words."""
        collecting = gc.isenabled()
        gc.disable()
        try:
            return self._of(texts, end)
        finally:
            if collecting:
                gc.enable()

    def _of(self, texts: list[bytes], end: int | None) -> list[np.ndarray]:
        if not self.by_word:
            said = self.library.encode_batch([t.decode() for t in texts], add_special_tokens=False)
            last = [] if end is None else [end]
            return [np.array([*e.ids, *last], np.uint32) for e in said]
        if self._held() > MEMO_BYTES:
            self._forget()
        lowered = pa.array([self._lowered(t) for t in texts], pa.binary()).cast(pa.string())
        split = pc.ascii_split_whitespace(lowered)
        full = pc.greater(pc.binary_length(split.values), 0)  # white space at an end leaves ""
        n_words = np.concatenate([[0], np.cumsum(as_numpy(full))])[as_numpy(split.offsets)]
        words = split.values.filter(full).dictionary_encode()
        ids, starts, lengths = self._word_ids(words.dictionary)
        which = as_numpy(words.indices)
        flat, ends = gather(ids, starts[which], lengths[which]), np.cumsum(lengths[which])
        if not self.base and self._held() > MEMO_BYTES // 2:
            self.base = len(self.known), self.used, self.letters
        bounds = np.concatenate([[0], ends])[n_words]
        tail = np.zeros(0, np.uint32) if end is None else np.array([end], np.uint32)
        return [
            np.concatenate([flat[a:b], tail])
            for a, b in zip(bounds[:-1], bounds[1:], strict=True)
        ]


@lru_cache(maxsize=1)
def word_ids(path: str) -> WordIds:
    """One per Python worker, which runs many tasks."""
    return WordIds(path)


@dataclass(frozen=True)
class Coding:
    """tokenizer: path of the tokenizer's file, which every executor has; vocab: ids are below."""

    tokenizer: str
    vocab: int
    end_id: int = 2


IDS = "doc_id bigint, tie bigint, n_tokens bigint, ids binary, counts binary"
IDS_SCHEMA = pa.schema(
    {
        "doc_id": pa.int64(),
        "tie": pa.int64(),
        "n_tokens": pa.int64(),
        "ids": pa.binary(),
        "counts": pa.binary(),
    }
)
BLOCKS = (
    "part int, part_start bigint, doc_ids array<bigint>, doc_tokens array<bigint>, "
    "n_ids bigint, lanes int, interval int, states binary, mark_places array<bigint>, "
    "mark_states array<binary>, payload binary, checksum bigint"
)


def token_ids(docs: DataFrame, coding: Coding) -> DataFrame:
    """(doc_id, tie, n_tokens, ids): ids as 16- or 32-bit integers (see ``pack``).  A row
    more per task has nothing but ``counts``: how often each id occurs in its documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = word_ids(coding.tokenizer)
        counts = np.zeros(coding.vocab, np.int64)
        parts = (batch.slice(a, ROWS) for batch in batches for a in range(0, batch.num_rows, ROWS))
        for batch in parts:
            texts = texts_of(batch)
            for a, b in chunks(texts, TEXT_BYTES):
                ids = words.of(texts[a:b], coding.end_id)
                packed = [pack(x) for x in ids]
                counts += np.bincount(np.concatenate(ids), minlength=coding.vocab)
                yield pa.record_batch(
                    {
                        "doc_id": batch.column("doc_id").slice(a, b - a),
                        "tie": batch.column("tie").slice(a, b - a),
                        "n_tokens": pa.array([len(x) for x in ids], pa.int64()),
                        "ids": pa.array(packed, pa.binary()),
                        "counts": pa.nulls(b - a, pa.binary()),
                    }
                )
        yield pa.RecordBatch.from_pylist([{"counts": counts.tobytes()}], schema=IDS_SCHEMA)

    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.xxhash64("text").alias("tie"),
        F.col("text").cast("string").alias("text"),
    )
    return map_in_arrow(rows, run, IDS)


def pack(ids: np.ndarray) -> bytes:
    """Ids behind their width.  Not compressed one by one: files and shuffles of many
    documents are, and come out no larger."""
    width = 2 if not len(ids) or ids.max() < 1 << 16 else 4
    return bytes([width]) + ids.astype(f"<u{width}").tobytes()


def unpack(data: bytes) -> np.ndarray:
    return np.frombuffer(data, f"<u{data[0]}", offset=1).astype(np.uint32)


def _counts(ids: DataFrame, vocab: int) -> np.ndarray:
    """How often each id occurs in all documents; at most ``vocab`` rows reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(vocab, np.int64)
        for batch in batches:
            for counts in batch.column("counts").to_pylist():
                held += np.frombuffer(counts, np.int64)
        found = np.flatnonzero(held)
        yield pa.record_batch({"token": pa.array(found), "n": pa.array(held[found])})

    listed = ids.where("counts is not null").select("counts")
    counted = map_in_arrow(listed, run, "token bigint, n bigint")
    out = np.zeros(vocab, np.int64)
    for token, n in counted.groupBy("token").agg(F.sum("n").alias("n")).collect():
        out[token] = n
    return out


def _encode_blocks(table: rans.Table):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, before = TaskContext.get().partitionId(), 0
        docs: list[int | None] = []
        held: list[np.ndarray] = []
        size = 0

        def block() -> pa.RecordBatch:
            made = rans.encode(np.concatenate(held), table, LANES)
            row = {
                "part": part,
                "part_start": before,
                "doc_ids": list(docs),
                "doc_tokens": [len(x) for x in held],
                **made,
            }
            return pa.RecordBatch.from_pylist([row], schema=SCHEMA)

        for batch in batches:
            for doc, data in zip(
                batch.column("doc_id").to_pylist(), batch.column("ids").to_pylist(), strict=True
            ):
                ids = unpack(data)
                docs.append(doc)
                held.append(ids)
                size += len(ids)
                if size >= BLOCK_IDS:
                    yield block()
                    before += size
                    docs, held, size = [], [], 0
        if docs:
            yield block()

    return run


SCHEMA = pa.schema(
    {
        "part": pa.int32(),
        "part_start": pa.int64(),
        "doc_ids": pa.list_(pa.int64()),
        "doc_tokens": pa.list_(pa.int64()),
        "n_ids": pa.int64(),
        "lanes": pa.int32(),
        "interval": pa.int32(),
        "states": pa.binary(),
        "mark_places": pa.list_(pa.int64()),
        "mark_states": pa.list_(pa.binary()),
        "payload": pa.binary(),
        "checksum": pa.int64(),
    }
)


def write(docs: DataFrame, path: str, coding: Coding) -> None:
    """Write the token ids of ``docs`` in ascending order of doc_id to ``path``."""
    spark = docs.sparkSession
    # A number per row, written with it, parts many equal rows over several ranges.
    numbered = token_ids(docs, coding).withColumn("nth", F.monotonically_increasing_id())
    written = materialize(numbered)
    table = rans.Table.of_counts(_counts(written, coding.vocab))
    ids = written.where("counts is null").drop("counts")
    total = ids.agg(F.sum("n_tokens")).first()[0] or 0
    parts = max(1, -(-total // PARTITION_IDS), spark.sparkContext.defaultParallelism)
    ordered = ids.repartitionByRange(parts, "doc_id", "tie", "nth").sortWithinPartitions(
        "doc_id", "tie", "nth"
    )
    (
        map_in_arrow(ordered, _encode_blocks(table), BLOCKS)
        .write.option("compression", "none")
        .parquet(f"{path}/blocks")
    )
    rows = [(int(i), int(table.freq[i])) for i in np.flatnonzero(table.freq)]
    spark.createDataFrame(rows, "token int, freq int").coalesce(1).write.parquet(f"{path}/table")
    (
        spark.read.schema(BLOCKS)
        .parquet(f"{path}/blocks")
        .groupBy("part")
        .agg(F.sum("n_ids").alias("n"))
        .select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("start"))
        .coalesce(1)
        .write.parquet(f"{path}/parts")  # a row per part, so one task
    )


def read_blocks(spark: SparkSession, path: str) -> tuple[DataFrame, rans.Table]:
    rows = spark.read.parquet(f"{path}/table").collect()  # at most the vocabulary
    freq = np.zeros(1 + max((r.token for r in rows), default=0), np.int64)
    for r in rows:
        freq[r.token] = r.freq
    return spark.read.schema(BLOCKS).parquet(f"{path}/blocks"), rans.Table(freq)


def read(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32[, ids]) of every document, from the files."""
    blocks, table = read_blocks(spark, path)
    kept = "part int, doc_id bigint, part_at bigint, n_tokens bigint, ids_crc32 bigint"
    kept += ", ids array<bigint>" if with_ids else ""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = rans.decode(row, table)
                raw = ids.astype("<u4")
                ends = np.cumsum(row["doc_tokens"])
                bounds = list(zip(np.concatenate([[0], ends[:-1]]), ends, strict=True))
                out = {
                    "part": pa.array([row["part"]] * len(bounds), pa.int32()),
                    "doc_id": pa.array(row["doc_ids"], pa.int64()),
                    "part_at": pa.array([row["part_start"] + a for a, _ in bounds], pa.int64()),
                    "n_tokens": pa.array(row["doc_tokens"], pa.int64()),
                    "ids_crc32": pa.array(
                        [zlib.crc32(raw[a:b].tobytes()) for a, b in bounds], pa.int64()
                    ),
                }
                if with_ids:
                    out["ids"] = pa.array([ids[a:b].tolist() for a, b in bounds])
                yield pa.record_batch(out)

    parts = spark.read.schema("part int, start bigint").parquet(f"{path}/parts")
    columns = ["doc_id", (F.col("start") + F.col("part_at")).alias("start"), "n_tokens"]
    columns += ["ids_crc32", *(["ids"] if with_ids else [])]
    return map_in_arrow(blocks, run, kept).join(parts, "part").select(*columns)


def write_and_read(docs: DataFrame, coding: Coding) -> DataFrame:
    """The digest of every document as the files give it back."""
    spark = docs.sparkSession
    path = f"{shared_dir(spark)}/tokens/{uuid.uuid4().hex}"
    write(docs, path, coding)
    return read(spark, path, with_ids=False)
