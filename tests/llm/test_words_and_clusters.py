"""Byte-level BPE, periodic runs and clusters against the library and brute force."""

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import public_tokenizers
import pytest
import regex
import tiktoken

from lakestrata.llm import bytebpe, clusters, periods
from lakestrata.llm.common import tokenizer_path

SF = "/root/testdata/sf0.01"


def sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


# -- byte-level BPE -------------------------------------------------------------------------


@pytest.fixture(scope="module")
def ranks():
    return bytebpe.Ranks.of_file(
        tokenizer_path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    )


@pytest.fixture(scope="module")
def library(ranks):
    known = {token: rank for rank, token in ranks.tokens.items()}
    return tiktoken.Encoding(
        "t", pat_str=ranks.pattern, mergeable_ranks=known, special_tokens={}
    )


ODD = [
    None,
    "",
    " ",
    "   \n\n  x",
    "a  b   c \t d\n e",
    "\x1c a \x1d b c   d \u0085 e",
    "it's we'll 'twas ''s !'s DON'T x's. end.",
    "<|endoftext|> 12a 3.14 é𝄞 日本語 ½² _a_b",
    "no.space,after.marks, and. So",
    "x" * 20_000,
    " " * 5_000 + "x" + "\n" * 5_000,
    "word " * 30_000,
]


def test_ids_are_the_librarys_in_blocks_of_any_size(spark, ranks, library):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").limit(150)
    rows = [(None if i == 1 else -i, t) for i, t in enumerate(ODD)] + [(-7, ODD[7])] * 3
    docs = docs.unionByName(spark.createDataFrame(rows, "doc_id bigint, text string"))
    docs = docs.selectExpr("*", "1 as word", "2 as ids", "'x' as block")
    want = sorted(
        (str(r["doc_id"]), len(ids), sha(",".join(map(str, ids))), sha(r["text"] or ""))
        for r in docs.collect()
        for ids in [library.encode_ordinary(r["text"] or "")]
    )
    for options in ({"written": False}, {"written": False, "block_bytes": 20_000}):
        got = bytebpe.digest(bytebpe.decode(bytebpe.encode(docs, ranks, **options), ranks))
        assert sorted((str(r[0]), *r[1:]) for r in got.collect()) == want
    assert bytebpe.encode(docs.limit(0), ranks, written=False).count() == 0


def test_words_are_cut_as_the_pattern_says(library):
    pattern = regex.compile(public_tokenizers.PATTERN)
    for code in [*range(0x3000), *range(0xA640, 0xA700), *range(0x1D400, 0x1D800), 0x1F600]:
        text = f"a{chr(code)}b 1{chr(code)}{chr(code)} . {chr(code)} z"
        numbers = bytebpe.Numbers(pattern)
        sequence, n = numbers.sequence(*numbers.pieces([text]))
        words = list(numbers.words)
        assert [words[i] for i in sequence] == pattern.findall(text), hex(code)
        assert n.tolist() == [len(sequence)]


def test_each_distinct_word_is_sent_once_a_block(spark, ranks):
    docs = spark.createDataFrame([(i, "one two two. " * 50) for i in range(40)], "doc_id bigint, text string")
    words = docs.coalesce(1).mapInArrow(bytebpe._send_words(ranks.pattern, 1 << 20), bytebpe.WORDS)
    assert sorted(r["word"] for r in words.collect()) == [" ", " one", " two", ".", "one"]


@pytest.mark.parametrize("numbers", [[], [0], [1, 255, 256, 65535, 65536, (1 << 32) - 1]])
def test_packed_numbers(numbers):
    assert bytebpe.unpack(bytebpe.pack(np.array(numbers, np.int64))).tolist() == numbers


# -- periodic runs ----------------------------------------------------------------------------


def brute_runs(x, least=24):
    found = {}
    for q in range(1, len(x) // 3 + 1):
        i = 0
        while i < len(x) - q:
            start = i
            while i < len(x) - q and x[i] == x[i + q]:
                i += 1
            if i > start and i + q - start >= max(least, 3 * q):
                found.setdefault((start, i + q), q)
            i += 1
    return sorted(((a, e, q) for (a, e), q in found.items()), key=lambda r: (r[0], r[2]))


def planted(rng, n, letters):
    x = [rng.randrange(letters) for _ in range(n)]
    for _ in range(rng.randrange(4)):
        if n > 10:
            a = rng.randrange(n)
            p, m = rng.randrange(1, max(2, (n - a) // 3 + 1)), rng.randrange(1, n - a + 1)
            for i in range(a, min(n, a + m)):
                x[i] = x[a + (i - a) % p]
    return x


@pytest.mark.parametrize("most", [1 << 16, 16])
def test_runs_match_brute_force(monkeypatch, most):
    monkeypatch.setattr(periods, "MAX_BLOCK", most)
    rng = random.Random(most)
    count = 0
    for _ in range(400):
        n = rng.choice([0, 1, 23, 24, 25, 60, 200, 500])
        x = planted(rng, n, rng.choice([1, 2, 3, 50]))
        got = periods.runs_of(np.array(x, np.int64), n)
        assert got == brute_runs(x)
        count += len(got)
    assert count > 50


def test_long_sequences_of_few_and_of_equal_words():
    rng = random.Random(2)
    assert periods.runs_of(np.zeros(50_000, np.int64), 50_000) == [(0, 50_000, 1)]
    unit = [rng.randrange(5000) for _ in range(7001)]
    assert periods.runs_of(np.array(unit * 4), 28_004) == [(0, 28_004, 7001)]
    periods.runs_of(np.array([rng.randrange(2) for _ in range(20_000)]), 20_000)


def test_transforms_are_exact():
    gen = np.random.default_rng(1)
    for prime, root in periods.PRIMES:
        x = gen.integers(0, prime, (3, 64), dtype=np.uint64)
        back = periods.ntt(periods.ntt(x, prime, root), prime, pow(root, prime - 2, prime))
        assert (back * np.uint64(pow(64, prime - 2, prime)) % np.uint64(prime) == x).all()
    blocks = gen.integers(0, 3, (40, 8), dtype=np.uint64)
    windows = gen.integers(0, 3, (40, 23), dtype=np.uint64)
    windows[5, 9:17] = blocks[5]
    got = periods.zero_mismatches(blocks, windows)
    want = [[(w[d : d + 8] == b).all() for d in range(16)] for b, w in zip(blocks, windows)]
    assert got.tolist() == want and got[5, 9]


def brute_digest(doc_id, text):
    words = (text or "").encode().split()
    if doc_id is not None:
        h = zlib.crc32(str(doc_id).encode())
        if h % 10 == 0 and words:
            n, g = len(words), h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
    runs = brute_runs(words)
    drop = {i for a, e, q in runs for i in range(a + q, e)}
    best = max(runs, key=lambda r: (Fraction(r[1] - r[0], r[2]), -r[0], -r[2]), default=None)
    first = (best[0], best[1] - best[0], best[2], 1000 * (best[1] - best[0]) // best[2]) if best else (None,) * 4
    lines = "".join(f"{a},{e - a},{q}\n" for a, e, q in runs)
    kept = b" ".join(w for i, w in enumerate(words) if i not in drop)
    return (doc_id, len(runs), *first, sha(lines), sha(kept))


def test_documents_runs_match_brute_force(spark):
    rng = random.Random(8)
    texts = [" ".join(f"w{k}é" for k in planted(rng, rng.choice([30, 90, 300]), 3)) for _ in range(120)]
    # Two runs of one exponent; a run up to the end; other white space; nothing.
    texts += ["a b " * 12 + "x y z " + "c d " * 12, "q " + "k l m " * 9, "\t".join(["t"] * 30), "", " \n", "a"]
    rows = [*enumerate(texts), (None, texts[0]), (None, None), (4, texts[4]), (4, texts[4])]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr(
        "*", "1 as runs", "2 as start", "'x' as w", "3 as n"
    )
    got = periods.digest(periods.find_runs(periods.with_periodic_tails(docs)))
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(str(brute_digest(*r)) for r in rows)
    assert periods.find_runs(docs.limit(0)).count() == 0


# -- clusters ---------------------------------------------------------------------------------


def brute_clusters(rows, k, rounds, dims):
    kept = [
        (i, tuple(int(np.floor(256 * np.float64(np.float32(x)))) for x in v))
        for i, v in rows
        if v is not None and len(v) == dims and all(x is not None and np.isfinite(x) for x in v)
    ]
    order = sorted(
        kept, key=lambda r: (r[0] is None, sha(f"2:{r[0]}") if r[0] is not None else "", r[1])
    )
    centroids = [v for _, v in order[:k]]

    def assign():
        out = []
        for i, v in kept:
            far = [sum((a - b) ** 2 for a, b in zip(v, c)) for c in centroids]
            out.append((i, v, far.index(min(far)), min(far)))
        return out

    for _ in range(rounds):
        now = assign()
        for c in range(len(centroids)):
            own = [v for _, v, at, _ in now if at == c]
            if own:
                centroids[c] = tuple(sum(x) // len(own) for x in zip(*own))
    now = assign()
    inertia = [sum(d for _, _, at, d in now if at == c) for c in range(len(centroids))]
    return [
        (i, c, d, inertia[c], sum(inertia), sha(",".join(map(str, centroids[c]))))
        for i, _, c, d in now
    ]


@pytest.mark.parametrize("dims, shared", [(6, 1 << 18), (6, 40), (5, 1), (1, 7)])
def test_clusters_match_brute_force(spark, dims, shared):
    gen = np.random.default_rng(dims)
    x = np.round(gen.normal(size=(120, dims)) * 8) / 64
    x[20:60] = x[0]  # a crowd of equal vectors
    rows = [(i, v.tolist()) for i, v in enumerate(x.astype(np.float32))]
    odd = [None, [], [1.0] * (dims + 1), [None] * dims, [float("nan")] * dims, [float("-inf")] * dims]
    rows += [(1000 + i, v) for i, v in enumerate(odd)]
    rows += [(None, rows[3][1]), (7, rows[9][1]), (7, rows[7][1]), (8, [-0.001] * dims)]
    df = spark.createDataFrame(
        [(i, v, 1, "c") for i, v in rows],
        "vec_id bigint, embedding array<float>, cluster int, v string",
    ).repartition(3)
    got = clusters.summary(*clusters.cluster(df, k=7, rounds=3, dims=dims, shared=shared))
    want = brute_clusters(rows, 7, 3, dims)
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))


def test_fewer_vectors_than_centroids_and_none(spark):
    df = spark.createDataFrame([(1, [0.5, 1.0]), (2, [0.5, 1.0])], "vec_id bigint, embedding array<float>")
    got = clusters.summary(*clusters.cluster(df, k=5, rounds=2, dims=2)).collect()
    # Equal vectors: both are in the first cluster, the second centroid keeps its place.
    assert sorted((r["vec_id"], r["cluster"], r["distance"]) for r in got) == [(1, 0, 0), (2, 0, 0)]
    none = clusters.summary(*clusters.cluster(df.limit(0), k=5, rounds=2, dims=2))
    assert none.count() == 0 and none.columns == [
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    ]
    big = spark.createDataFrame([(1, [1e30, 0.0])], "vec_id bigint, embedding array<float>")
    with pytest.raises(Exception, match="26 bits"):
        clusters.cluster(big, k=5, rounds=1, dims=2)[0].count()


def test_a_rounds_table_holds_each_entry_once(spark):
    gen = np.random.default_rng(5)
    x = (gen.integers(-3, 3, (500, 4)) / 256).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id bigint, embedding array<float>")
    vectors = clusters.integers(df, "vec_id", "embedding", 4, 256)
    known = clusters.dictionary(vectors, 4, 1 << 18)
    assert [len(k) for k in known] == [36, 36]
    few = clusters.dictionary(vectors, 4, 20)
    assert sum(map(len, few)) <= 20
