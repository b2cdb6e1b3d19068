"""Near-duplicate documents: SuperMinHash signatures, banding, exact checks, components.

A document's set holds its distinct shingles of ``size`` words (a shorter text is one
shingle).  Equal sets are one class from the start, named by its smallest doc_id.  Each
class gets a SuperMinHash signature; classes that agree in all values of a band are candidates.
Candidates are linked when their whole sets, compared exactly, have
intersection * 100 >= percent * union, and links are joined to components.

Buckets are never expanded to all pairs.  First each class is compared with the smallest
class of its buckets, then with the smallest of each bucket that is in another component.
What then still shares a bucket but not a component is compared completely, except that the
members of the component that holds most of a bucket need no comparison with each other, and
pairs ruled out by their bitmaps are not even listed: a set's 1024 bits mark the hashes it
has, and each bit that one set has alone stands for a shingle the other lacks, so the bits
bound the intersection from above.  The outcome is that of comparing all candidates.

Missing a pair of similarity 0.8 takes no common band among 32 of 5 values:
(1 - 0.8**5)**32, 3 in a million.

Defined cases: a text without words has an empty set and is linked with nothing; equal rows
are one class; rows with one doc_id count as one document; a row without doc_id is linked
with nothing, has a null component and is kept; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestrata.llm.common import (
    WordHashes,
    chunks,
    map_in_arrow,
    mix64,
    shingle_hashes,
    signed,
    texts_of,
)
from lakestrata.llm.graph import components
from lakestrata.session import materialize

BANDS, ROWS = 32, 5
BITS = 1024


def word_set(words: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct shingles of word hashes."""
    return np.unique(shingle_hashes(words, size))


def superminhash(sets: list[np.ndarray], m: int) -> np.ndarray:
    """SuperMinHash signatures (rows) of non-empty sets of 64-bit hashes.

    Every element walks through a random permutation of the m places and offers its j-th
    place the value j + r, r in [0, 1); each place keeps its least offer.  All elements go
    step by step together: an offer of step j is below j + 1, so a set whose places are all
    filled after step j is done, and most sets are after a few steps.
    """
    out = np.full((len(sets), m), np.inf)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    state = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    places: np.ndarray | None = None  # of each element: its permutation so far
    for j in range(m):
        state = mix64(state + np.uint64(0x9E3779B97F4A7C15))
        value = j + (state >> np.uint64(40)).astype(np.float64) / (1 << 24)
        pick = j + ((state & np.uint64(0xFFFFFF)) % np.uint64(m - j)).astype(np.int64)
        if j == 0:
            place = pick
        else:
            rows = np.arange(len(state))
            place = places[rows, pick].astype(np.int64)
            places[rows, pick] = places[:, j]
            places[:, j] = place
        np.minimum.at(out.reshape(-1), owner * m + place, value)
        open_sets = np.isinf(out).any(axis=1)
        going = open_sets[owner]
        if not going.any():
            break
        if j == 0:
            places = np.tile(np.arange(m, dtype=np.uint8), (int(going.sum()), 1))
            rows, first = np.arange(len(places)), pick[going]
            places[rows, first] = 0
            places[rows, 0] = first
            owner, state = owner[going], state[going]
        elif not going.all():
            owner, state, places = owner[going], state[going], places[going]
    return out


def band_keys(signatures: np.ndarray, bands: int, rows: int) -> np.ndarray:
    bits = signatures.astype(np.float64).view(np.uint64).reshape(len(signatures), bands, rows)
    keys = np.tile(np.arange(1, bands + 1, dtype=np.uint64), (len(signatures), 1))
    for k in range(rows):
        keys = mix64(keys + bits[:, :, k])
    return signed(keys)


def bitmaps(sets: list[np.ndarray]) -> np.ndarray:
    """A row of BITS / 64 longs per set: which remainders its hashes have."""
    marks = np.zeros((len(sets), BITS), bool)
    for row, s in zip(marks, sets, strict=True):
        row[(s % np.uint64(BITS)).astype(np.int64)] = True
    return np.packbits(marks, axis=1).view(np.int64)


SIGNED = (
    "doc_id bigint, a bigint, b bigint, n_shingles bigint, bands array<bigint>, bits array<bigint>"
)


def sign(docs: DataFrame, size: int, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """A row per document: digest (a, b) of its set, the set's size, keys of its bands."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            texts = texts_of(batch)
            for a, b in chunks(texts):
                sets = [word_set(hashes.of(t.lower().split()), size) for t in texts[a:b]]
                filled = [i for i, s in enumerate(sets) if len(s)]
                keys = band_keys(
                    superminhash([sets[i] for i in filled], bands * rows), bands, rows
                )
                listed: list = [None] * len(sets)
                for i, k in zip(filled, keys, strict=True):
                    listed[i] = k
                digest = [xxhash.xxh3_128_digest(s.tobytes()) for s in sets]
                halves = np.frombuffer(b"".join(digest), np.int64).reshape(-1, 2)
                yield pa.record_batch(
                    {
                        "doc_id": batch.column("doc_id").slice(a, b - a),
                        "a": pa.array(halves[:, 0]),
                        "b": pa.array(halves[:, 1]),
                        "n_shingles": pa.array([len(s) for s in sets], pa.int64()),
                        "bands": pa.array(listed, pa.list_(pa.int64())),
                        "bits": pa.array(list(bitmaps(sets)), pa.list_(pa.int64())),
                    }
                )

    kept = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")
    )
    return map_in_arrow(kept, run, SIGNED)


def _sets(texts: DataFrame, size: int) -> DataFrame:
    """(node, shingles) of (node, text): whole sets as arrays of 64-bit hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            texts = texts_of(batch)
            for a, b in chunks(texts):
                sets = [
                    signed(word_set(hashes.of(t.lower().split()), size)) for t in texts[a:b]
                ]
                ends = np.cumsum([0, *map(len, sets)]).astype(np.int32)
                yield pa.record_batch(
                    {
                        "node": batch.column("node").slice(a, b - a),
                        "shingles": pa.ListArray.from_arrays(ends, np.concatenate(sets)),
                    }
                )

    return map_in_arrow(texts, run, "node bigint, shingles array<bigint>")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The links (u, v) among candidate pairs, by their whole sets."""
    both = pairs.join(
        sets.select(F.col("node").alias("u"), F.col("shingles").alias("su")), "u"
    ).join(sets.select(F.col("node").alias("v"), F.col("shingles").alias("sv")), "v")
    common = F.size(F.array_intersect("su", "sv"))
    union = F.size("su") + F.size("sv") - common
    return both.where(common * 100 >= union * percent).select("u", "v")


def _sized(pairs: DataFrame, percent: int) -> DataFrame:
    """Only pairs whose sizes allow the similarity."""
    return pairs.where(
        F.least("nu", "nv") * 100 >= F.greatest("nu", "nv") * percent
    ).select("u", "v")


def _possible(percent: int) -> str:
    """SQL: whether pairs of set sizes nu, nv and bitmaps u0.., v0.. may be similar enough.
    (Bitmaps are columns, not arrays, to keep the generated code small enough to compile.)"""
    alone = [
        " + ".join(f"bit_count({a}{k} & ~{b}{k})" for k in range(BITS // 64))
        for a, b in (("u", "v"), ("v", "u"))
    ]
    most = f"least(nu - ({alone[0]}), nv - ({alone[1]}))"
    return (
        f"least(nu, nv) * 100 >= greatest(nu, nv) * {percent}"
        f" and {most} * {100 + percent} >= (nu + nv) * {percent}"
    )


def _with_roots(members: DataFrame, links: DataFrame) -> DataFrame:
    """Members (key, node, n) with the root of their component so far."""
    return members.join(components(links), "node", "left").select(
        "key", "node", "n", F.coalesce("root", "node").alias("root")
    )


def link_classes(docs: DataFrame, classes: DataFrame, size: int, percent: int) -> DataFrame:
    """(u, v): links that join exactly the classes (node, n_shingles, bands) that all
    confirmed candidates would join."""
    held = classes.select(
        "node", F.col("n_shingles").alias("n"), F.explode("bands").alias("key")
    )
    shared = held.groupBy("key").agg(F.count("*").alias("c")).where("c > 1").select("key")
    members = materialize(held.join(shared, "key").select("key", "node", "n"))
    wanted = members.select("node").distinct()
    texts = docs.select(
        F.col("doc_id").cast("bigint").alias("node"), F.col("text").cast("string").alias("text")
    )
    sets = materialize(_sets(texts.join(wanted, "node", "left_semi"), size))
    first = members.groupBy("key").agg(F.min(F.struct("node", "n")).alias("pivot"))
    nearest = (
        members.join(first, "key")
        .groupBy("node", "n")
        .agg(F.min("pivot").alias("pivot"))
        .where("node <> pivot.node")
        .selectExpr("node as u", "n as nu", "pivot.node as v", "pivot.n as nv")
    )
    tested = materialize(_sized(nearest, percent))
    links = materialize(_confirmed(tested, sets, percent))
    # Second: the smallest class of every bucket, where it is in another component.
    rooted = materialize(_with_roots(members, links))
    pivots = rooted.groupBy("key").agg(F.min(F.struct("node", "n", "root")).alias("p"))
    second = (
        rooted.join(pivots, "key")
        .where("root <> p.root")
        .selectExpr("node as u", "n as nu", "p.node as v", "p.n as nv")
        .distinct()
    )
    more = materialize(_sized(second, percent).join(tested, ["u", "v"], "left_anti"))
    tested = tested.unionByName(more)
    links = materialize(links.unionByName(_confirmed(more, sets, percent)))
    # Last: all that share a bucket and not a component.
    rooted = materialize(_with_roots(members, links))
    per_root = rooted.groupBy("key", "root").agg(F.count("*").alias("c"))
    largest = (
        per_root.groupBy("key")
        .agg(F.max_by("root", F.struct("c", "root")).alias("main"), F.count("*").alias("roots"))
        .where("roots > 1")
        .select("key", "main")
    )
    maps = classes.select("node", *[F.col("bits")[k].alias(f"b{k}") for k in range(BITS // 64)])
    mixed = materialize(rooted.join(largest, "key").join(maps, "node"))
    named = {s: [f"b{k} as {s}{k}" for k in range(BITS // 64)] for s in "uv"}
    left = mixed.selectExpr("key", "node as u", "n as nu", "root as ru", "main", *named["u"])
    right = mixed.where("root <> main").selectExpr(
        "key", "node as v", "n as nv", "root as rv", *named["v"]
    )
    # A pair outside the largest component is met from both sides; one is enough.
    crossing = (
        left.join(right, "key")
        .where("ru <> rv and (ru = main or u > v)")
        .where(_possible(percent))
        .selectExpr("greatest(u, v) as u", "least(u, v) as v")
        .distinct()
    )
    last = materialize(crossing.join(tested, ["u", "v"], "left_anti"))
    return links.unionByName(_confirmed(last, sets, percent))


def near_duplicates(
    docs: DataFrame,
    size: int = 5,
    percent: int = 80,
    bands: int = BANDS,
    rows: int = ROWS,
) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for every row of ``docs``."""
    signed_docs = materialize(sign(docs, size, bands, rows))
    filled = signed_docs.where("doc_id is not null and n_shingles > 0")
    named = filled.groupBy("a", "b").agg(F.min("doc_id").alias("node"))
    classes = materialize(
        named.join(
            filled.select(F.col("doc_id").alias("node"), "a", "b", "n_shingles", "bands", "bits"),
            ["a", "b", "node"],
        ).dropDuplicates(["a", "b", "node"])
    )
    links = materialize(link_classes(docs, classes, size, percent))
    roots = components(links)
    rooted = materialize(
        classes.join(roots, "node", "left").select(
            "a", "b", F.coalesce("root", "node").alias("root")
        )
    )
    known = F.col("doc_id").isNotNull()
    alone = F.when(F.col("n_shingles") == 0, F.col("doc_id"))
    found = signed_docs.drop("bands", "bits").join(rooted, ["a", "b"], "left")
    component = F.when(known, F.coalesce(alone, "root"))
    return found.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )
