"""Neighbours, near duplicates, decontamination and components against brute force."""

import random

import numpy as np
import pytest

from lakestrata.llm import decontaminate, graph, neardup, neighbours
from lakestrata.llm.common import WordHashes

rng = random.Random(5)
WORDS = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 5))) for _ in range(400)]


def prose(n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


def changed(text, share):
    return " ".join(rng.choice(WORDS) if rng.random() < share else w for w in text.split())


# -- neighbours -------------------------------------------------------------------------


def vectors_frame(spark, rows):
    return spark.createDataFrame(
        rows, "vec_id bigint, embedding array<float>, score string, query_id string"
    )


def test_neighbours_match_brute_force(spark):
    gen = np.random.default_rng(3)
    x = gen.normal(size=(600, 24)).astype(np.float32)
    x[10:40] = x[0] + 0.01 * gen.normal(size=(30, 24))  # a crowd
    x[41] = x[40]  # a tie
    rows = [(i, v.tolist(), "s", "q") for i, v in enumerate(x)]
    odd = [
        (1000, None, None, None),
        (1050, [], None, None),
        (1100, [0.0] * 24, None, None),
        (1150, [float("nan")] * 24, None, None),
        (1200, [None] * 24, None, None),
        (1250, [1.0, 2.0], None, None),
        (None, [1.0] * 24, None, None),
    ]
    found = neighbours.search(
        vectors_frame(spark, rows + odd + rows[50:52]), "vec_id % 50 = 0", query_block=4
    ).collect()
    wide = x.astype(np.float64)
    like = wide @ wide.T / np.outer(*[np.linalg.norm(wide, axis=1)] * 2)
    hits = 0
    for query in range(0, 600, 50):
        own = sorted((r for r in found if r["query_id"] == query), key=lambda r: r["rank"])
        assert [r["rank"] for r in own] == [1, 2, 3, 4, 5]
        assert [(-r["score"], r["vec_id"]) for r in own] == sorted(
            (-r["score"], r["vec_id"]) for r in own
        )
        for r in own:
            assert r["score"] == pytest.approx(like[query, r["vec_id"]], abs=1e-12)
        like[query, query] = -9
        hits += len({r["vec_id"] for r in own} & set(np.argsort(-like[query])[:5].tolist()))
    assert len(found) == 60 and hits >= 0.9 * 60


def test_copies_of_a_query_ask_once(spark, monkeypatch):
    gen = np.random.default_rng(5)
    x = gen.normal(size=(300, 16))
    rows = [(i, v.tolist(), "s", "q") for i, v in enumerate(x)]
    plain = neighbours.search(vectors_frame(spark, rows), "vec_id % 50 = 0").collect()
    sent, whole = [], neighbours._search_all
    monkeypatch.setattr(
        neighbours, "_search_all", lambda r, s, *a: (sent.append(len(s.value[1])), whole(r, s, *a))[1]
    )
    copied = vectors_frame(spark, rows + [rows[50]] * 150)
    again = neighbours.search(copied, "vec_id % 50 = 0", query_block=50).collect()
    assert sum(sent) == 6
    assert {r["query_id"] for r in again} == {r["query_id"] for r in plain}
    assert len(again) == len(plain) == len({(r["query_id"], r["vec_id"]) for r in again})


def test_neighbours_of_few_rows(spark):
    rows = [(0, [1.0, 0.0], "", ""), (1, [0.0, 1.0], "", ""), (50, [1.0, 1.0], "", "")]
    found = neighbours.search(vectors_frame(spark, rows), "vec_id % 50 = 0").collect()
    assert sorted((r["query_id"], r["rank"], r["vec_id"]) for r in found) == [
        (0, 1, 50),
        (0, 2, 1),
        (50, 1, 0),
        (50, 2, 1),
    ]
    assert neighbours.search(vectors_frame(spark, []), "vec_id % 50 = 0").count() == 0


def test_probing_finds_every_code_within_the_radius():
    gen = np.random.default_rng(1)
    x = gen.normal(size=(500, 32))
    coder = neighbours.fit(x, 64, 0.98, 5)
    block = neighbours.Block(coder, np.arange(500), x)
    for radius in (0, 5, 13, 20, 64):
        far = np.bitwise_count(block.codes ^ block.codes[7]).sum(axis=1)
        assert block.within(block.codes[7], radius).tolist() == np.flatnonzero(far <= radius).tolist()


# -- near duplicates --------------------------------------------------------------------


def brute_components(rows, size, percent):
    def shingles(text):
        words = (text or "").lower().split()
        return {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()

    sets = {i: shingles(t) for i, t in rows}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                common = len(sets[a] & sets[b])
                if common * 100 >= percent * len(sets[a] | sets[b]) and find(a) != find(b):
                    root[max(find(a), find(b))] = min(find(a), find(b))
    return {i: (len(sets[i]), find(i)) for i in ids}


@pytest.mark.parametrize("size", [2, 5])
def test_near_duplicates_match_brute_force(spark, size):
    base = [prose(rng.randint(20, 200)) for _ in range(25)]
    texts = base + [changed(rng.choice(base), rng.choice([0, 0.01, 0.03, 0.06])) for _ in range(90)]
    crowd = prose(120)
    texts += [changed(crowd, rng.choice([0.01, 0.04, 0.08])) for _ in range(60)] + [crowd] * 20
    texts += ["", None, "one", "ONE", " \n ", "two words", "Two Words", "a " * 3000]
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows + rows[:3], "doc_id bigint, text string").selectExpr(
        "*", "'x' as node", "1 as n", "'y' as key", "'z' as root"
    )
    got = neardup.near_duplicates(docs, size=size).collect()
    want = brute_components(rows, size, 80)
    assert len(got) == len(rows) + 3
    for r in got:
        assert (r["n_shingles"], r["component_id"]) == want[r["doc_id"]]
        assert r["kept"] == (r["doc_id"] == r["component_id"])


def test_near_duplicates_without_id_and_of_nothing(spark):
    docs = spark.createDataFrame([(None, "a b c"), (1, "a b c")], "doc_id bigint, text string")
    got = {r["doc_id"]: (r["component_id"], r["kept"]) for r in neardup.near_duplicates(docs).collect()}
    assert got == {None: (None, True), 1: (1, True)}
    assert neardup.near_duplicates(docs.limit(0)).count() == 0


def test_signatures_estimate_similarity():
    gen = np.random.default_rng(2)
    pool = gen.integers(0, 2**63, 3000).astype(np.uint64)
    a, b = pool[:2000], pool[1000:]
    both = neardup.superminhash([np.unique(a), np.unique(b), np.unique(a)], 160)
    assert (both[0] == both[2]).all()
    assert abs((both[0] == both[1]).mean() - 1 / 3) < 0.12
    short = neardup.superminhash([pool[:1], pool[:2]], 160)
    assert np.isfinite(short).all()


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(60)]
    star = [(100, i) for i in range(101, 140)]
    links = spark.createDataFrame(chain + star + [(7, 7)], "u bigint, v bigint")
    roots = {r["node"]: r["root"] for r in graph.components(links).collect()}
    assert set(roots[i] for i in range(61)) == {0}
    assert set(roots[i] for i in range(100, 140)) == {100}
    assert graph.components(links.limit(0)).count() == 0


# -- decontamination --------------------------------------------------------------------


def brute_leaks(text, items, size, percent):
    """Best similarity of any window of an item's length, by item."""
    words = decontaminate.words_of(text)
    out = {}
    for item, own in items:
        own = decontaminate.words_of(own)
        if not own or not words:
            continue
        n = len(own)
        best = 0.0
        for i in range(max(1, len(words) - n + 1)):
            a, b = (
                [tuple(w[k : k + size]) for k in range(max(1, len(w) - size + 1))]
                for w in (words[i : i + n], own)
            )
            low = sum(min(a.count(s), b.count(s)) for s in set(a) | set(b))
            best = max(best, low / (len(a) + len(b) - low))
        if best * 100 >= percent:
            out[item] = best
    return out


def test_leaks_match_brute_force(spark):
    items = [(i, prose(n)) for i, n in enumerate([3, 8, 15, 16, 22, 37, 37, 59, 150])]
    items += [(50, items[4][1]), (60, ""), (61, "...")]
    texts = [prose(n) for n in (0, 1, 30, 400)]
    for _, own in items[:9]:
        cut = own.split()
        texts.append(f"{prose(40)} {own.upper()}, {prose(30)}")
        texts.append(own)
        texts.append(f"{prose(20)} {' '.join(cut[: max(1, len(cut) - 1)])} {prose(20)}")
        texts.append(prose(300) + " " + " ".join(own.split()).replace(" ", "  -- "))
    rows = [(i, t) for i, t in enumerate(texts)] + [(999, None), (None, items[5][1])]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    bench = spark.createDataFrame([*items, (70, None)], "item_id bigint, text string")
    found = decontaminate.leaks(docs, bench, "doc_id").collect()
    got = {(r["doc_id"], r["item_id"]): r["similarity"] for r in found}
    want = {
        (i, item): s
        for i, t in rows
        for item, s in brute_leaks((t or "").encode(), [(k, v.encode()) for k, v in items], 5, 80).items()
    }
    # Fingerprints may miss pairs near the threshold; whole items are always found.
    assert set(got) <= set(want)
    assert {k for k, s in want.items() if s >= 0.95} <= set(got)
    assert len(got) >= 0.9 * len(want)
    for k, s in got.items():
        assert s == pytest.approx(want[k])
    flags = decontaminate.leaks(docs, bench, "doc_id", all_rows=True).collect()
    assert len(flags) == len(rows)
    assert {r["doc_id"] for r in flags if r["leaked"]} == {k for k, _ in got}
    assert decontaminate.leaks(docs.limit(0), bench, "doc_id").count() == 0
    assert decontaminate.leaks(docs, bench.limit(0), "doc_id").count() == 0


def test_a_large_benchmark_is_worked_off_in_parts(spark):
    items = [(i, prose(12 + i)) for i in range(9)]
    texts = [f"{prose(20)} {items[i][1]} {items[(i * 5 + 2) % 9][1]}" for i in range(9)]
    rows = [(i, t, 1, "x") for i, t in enumerate(texts)] + [(50, prose(80), 2, "y")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, item_id int, leaked string")
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    whole = decontaminate.leaks(docs, bench, "doc_id")
    parts = decontaminate.leaks(docs, bench, "doc_id", part_words=40)
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, parts.collect()))
    flags = decontaminate.leaks(docs, bench, "doc_id", "text", all_rows=True, part_words=40)
    assert sorted(tuple(r) for r in flags.collect()) == sorted((r[0], r[1], r[0] < 50) for r in rows)


def test_only_pairs_of_a_posting_are_tested():
    """2,000 items of one length: the postings leave less than 5 % of all pairs."""
    gen = np.random.default_rng(9)
    items = []
    for i in range(2000):
        own = gen.integers(0, 1 << 63, 20, dtype=np.uint64)
        items.append((i, own, np.sort(own)))
    index = decontaminate.Index(items, 20, 15)
    prints = gen.integers(0, 1 << 63, 3000, dtype=np.uint64) * np.uint64(2)
    prints[:50] = index.prints[:50] ^ np.uint64(0x8001_0003_1000_0011)
    window, item = index.candidates(prints)
    assert index.tested < 0.05 * len(prints) * len(items)
    far = np.bitwise_count(prints[:, None] ^ index.prints[None, :])
    assert set(zip(window.tolist(), item.tolist())) == set(zip(*map(np.ndarray.tolist, np.nonzero(far <= 15))))


def test_index_returns_all_within_the_radius():
    gen = np.random.default_rng(4)
    hashes = WordHashes()
    own = hashes.of([b"w%d" % i for i in range(20)])
    index = decontaminate.Index([(1, own, np.sort(own))], 20, 15)
    flips = [sum(1 << int(b) for b in gen.choice(64, k, replace=False)) for k in range(0, 40)]
    prints = np.array([int(index.prints[0]) ^ f for f in flips], np.uint64)
    window, _ = index.candidates(prints)
    assert window.tolist() == list(range(16))
