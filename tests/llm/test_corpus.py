"""Mixing, token output and the whole pipeline."""

import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lakestrata.llm import decontaminate, langid, mixing, neardup, rans, tokens
from lakestrata.llm.common import BATCH_BYTES, BATCH_LIMIT, lean, tokenizer_path

SF = "/root/testdata/sf0.01"

# -- mixing -------------------------------------------------------------------------------


def brute_targets(sizes, weights=(3, 1, 2), share=1.5, cap=2.0):
    """Deals the excess again by weight until no source is above its cap."""
    names = sorted((n for n in sizes if n is not None), key=lambda n: n.encode())
    names += [None] if None in sizes else []
    weight = {n: weights[i % 3] for i, n in enumerate(names)}
    rest, free, out = share * sum(sizes.values()), set(names), {}
    while True:
        level = rest / max(1e-300, sum(weight[n] for n in free))
        full = {n for n in free if level * weight[n] > cap * sizes[n]}
        if not full:
            return out | {n: level * weight[n] for n in free}
        out |= {n: cap * sizes[n] for n in full}
        rest -= sum(cap * sizes[n] for n in full)
        free -= full


def test_mix_meets_targets(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = spark.createDataFrame(
        [
            (None, None, None, None, None),
            (5001, "a b", "en", None, 1),
            (5001, "a b", "en", None, 1),
            (5002, "", "x", "empty", 0),
            (5003, "w " * 30000, "x", "one", 0),
        ],
        docs.schema,
    )
    docs = docs.unionByName(odd).selectExpr("*", "1 as target", "'t' as tilt")
    mixed = mixing.mix(docs)
    got = mixed.toPandas()
    assert len(got) == 1005
    by_source = (
        docs.select("source", mixing.size_of(F.col("text")).alias("size"))
        .groupBy("source")
        .agg(F.sum("size").alias("s"))
        .toPandas()
    )
    sizes = {None if r.source != r.source else r.source: int(r.s) for r in by_source.itertuples()}
    wanted = sorted(brute_targets(sizes).values())
    assert sorted(set(np.round(got.target, 3))) == pytest.approx(sorted(set(np.round(wanted, 3))))
    assert (got.taken <= 2 * got["size"]).all() and (got.taken >= 0).all()
    assert got.taken.sum() == pytest.approx(got["size"].sum() * 1.5, abs=25)
    sums = got.groupby("source_size").agg(taken=("taken", "sum"), target=("target", "max"))
    unique = sums[sums.index.isin([s for s in sizes.values() if list(sizes.values()).count(s) == 1])]
    assert (abs(unique.taken - unique.target) <= 1).all()
    order = ["doc_id", "size", "taken"]
    again = mixing.mix(docs).toPandas()
    assert again.sort_values(order)[order].reset_index(drop=True).equals(
        got.sort_values(order)[order].reset_index(drop=True)
    )
    copies = mixing.take(mixing.mix(docs, whole_rows=True))
    assert copies.columns == docs.columns
    assert copies.groupBy(*docs.columns).count().agg(F.max("count")).first()[0] <= 4  # 2 equal rows


def test_a_third_of_the_rows_is_one_row(spark):
    """Each source comes within one document of its target, on both paths."""
    rows = [(7, "a b c d e f g h i j k", "hot")] * 3000
    rows += [(100 + i, "w " * (1 + i % 50), "hot" if i % 3 else None) for i in range(6000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    got = mixing.mix(docs).toPandas()
    sums = got.groupby("source_size").agg(taken=("taken", "sum"), target=("target", "max"))
    assert len(sums) == 2 and (abs(sums.taken - sums.target) <= 1).all()
    assert (got.taken <= 2 * got["size"]).all()
    copies = mixing.take(mixing.mix(docs, whole_rows=True)).groupBy("source").agg(
        F.sum(mixing.size_of(F.col("text"))).alias("taken")
    )
    taken = sorted(r["taken"] for r in copies.collect())
    assert all(abs(a - b) <= 50 for a, b in zip(taken, sorted(sums.target), strict=True))


def test_mix_of_nothing_and_of_no_words(spark):
    docs = spark.createDataFrame([(1, "", "a"), (2, None, None)], "doc_id bigint, text string, source string")
    assert [(r["size"], r["taken"], r["target"]) for r in mixing.mix(docs).collect()] == [(0, 0, 0.0)] * 2
    assert mixing.mix(docs.limit(0)).count() == 0


# -- token output -------------------------------------------------------------------------


@pytest.mark.parametrize("n", [0, 1, 5, 1024, 5000, 40_000])
def test_coding_round_trip(n):
    gen = np.random.default_rng(n)
    ids = np.minimum(gen.zipf(1.3, n), 49_000).astype(np.uint32)
    counts = np.bincount(ids, minlength=49_408)
    table = rans.Table.of_counts(counts)
    assert not n or int(table.freq.sum()) == 1 << rans.BITS
    block = rans.encode(ids, table, lanes=64, interval=16)
    assert (rans.decode(block, table) == ids).all()
    parts = [rans.decode(block, table, p) for p in range(len(block["mark_places"]) + 1)]
    assert not n or (np.concatenate(parts) == ids).all()
    if n >= 1024:
        entropy = -(counts[counts > 0] / n * np.log2(counts[counts > 0] / n)).sum() * n / 8
        assert len(block["payload"]) < 1.06 * entropy + 64 * 8
        damaged = {**block, "payload": block["payload"][:-1] + b"\x00"}
        if damaged["payload"] != block["payload"]:
            with pytest.raises(ValueError, match="damaged"):
                rans.decode(damaged, table)


TEXTS = [
    None,
    "",
    "Ab H̱ x <|endoftext|> STRASSE  a ... ,., Don't I'LL 12a. É. İ ΣΑΣ. \x1c b",
    "a" * 3000,
    "tabs\tand blanks here\n\nend.",
    "x. x, x.. x., .x ,",
    "日本語 text é é K",
]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_files_give_back_the_tokenizers_ids(spark, folder, name):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer_path(name))
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").limit(150)
    rows = [(None if i == 0 else -i, t) for i, t in enumerate(TEXTS)] + [(-2, TEXTS[5]), (-2, TEXTS[5])]
    docs = docs.unionByName(spark.createDataFrame(rows, "doc_id bigint, text string"))
    coding = tokens.Coding(tokenizer_path(name), vocab=50_300, end_id=2)
    tokens.write(docs.selectExpr("*", "1 as ids", "2 as tie"), f"{folder}/t", coding)
    got = tokens.read(spark, f"{folder}/t").collect()
    want: dict = {}
    for r in docs.collect():
        ids = [*library.encode(r["text"] or "", add_special_tokens=False).ids, 2]
        want.setdefault(r["doc_id"], []).append(ids)
    assert len(got) == docs.count()
    at = 0
    for r in sorted(got, key=lambda r: r["start"]):
        assert r["start"] == at and r["n_tokens"] == len(r["ids"])
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
        want[r["doc_id"]].remove(r["ids"])
        at += r["n_tokens"]
    ordered = [r["doc_id"] for r in sorted(got, key=lambda r: r["start"])]
    assert ordered == sorted(ordered, key=lambda i: (i is not None, i or 0))


def test_equal_rows_are_spread_over_ranges(spark, folder):
    docs = spark.createDataFrame([(5, "one row, many times")] * 4000 + [(9, "x")], "doc_id bigint, text string")
    coding = tokens.Coding(tokenizer_path("word_bpe_49k.json"), vocab=49_408, end_id=2)
    tokens.write(docs, f"{folder}/t", coding)
    got = tokens.read(spark, f"{folder}/t").toPandas().sort_values("start")
    n = int(got.n_tokens.iloc[0])
    assert got.start.tolist() == [n * i for i in range(4001)]
    assert got.doc_id.tolist() == [5] * 4000 + [9]
    parts = spark.read.parquet(f"{folder}/t/blocks").selectExpr("part", "size(doc_ids) n").collect()
    assert len({r["part"] for r in parts}) > 4


def test_remembered_words_are_bounded(monkeypatch):
    """Forgetting changes no id, and what is held stays below the bound and one batch."""
    from tokenizers import Tokenizer

    path = tokenizer_path("word_bpe_49k.json")
    monkeypatch.setattr(tokens, "MEMO_BYTES", 200_000)
    words, library = tokens.WordIds(path), Tokenizer.from_file(path)
    for k in range(12):
        texts = [" ".join(f"w{(k * 700 + i) ** 2}, the" for i in range(700)).encode()] * 2
        for ids, text in zip(words.of(texts, 2), texts, strict=True):
            assert ids.tolist() == [*library.encode(text.decode(), add_special_tokens=False).ids, 2]
        assert words._held() < 200_000 + 700 * 400


def test_distinct_words_are_found_at_once():
    """Blanks of any kind and place, no words at all; each word is learned once, in one call."""
    from tokenizers import Tokenizer

    path = tokenizer_path("word_bpe_49k.json")
    words, library = tokens.WordIds(path), Tokenizer.from_file(path)
    texts = ["", " \t\n", " a\x0bb\x0c c\r\n", "a. A, a.. ,a é. é, 9. b.", "one", "H\u0331. <|x a.", "日本 語。 a"]
    calls, learn = [], words._learn
    words._learn = lambda new: calls.append(new.to_pylist()) or learn(new)
    for _ in range(2):
        got = words.of([t.encode() for t in texts * 300], 2)
        want = [[*library.encode(t, add_special_tokens=False).ids, 2] for t in texts] * 300
        assert [list(g) for g in got] == want
    assert len(calls) == 1 and len(calls[0]) == len(set(calls[0])) == len(words.known)
    assert {"a", ".", ","} <= set(calls[0]) and not {"a.", "A,", "9.", "b."} & set(calls[0])
    assert [list(g) for g in words.of([], 2)] == []


def test_words_of_plain_letters_go_to_the_model_alone(tmp_path):
    """Where the library changes or cuts such words before its model, they do not."""
    from tokenizers import Tokenizer, normalizers

    path = tokenizer_path("word_bpe_49k.json")
    texts = ["Über älter ælfþ señor niño, naïve. don't", "café É é Straße ÿ × ÷ ab1 x.y z,"]
    for strips in (False, True):
        library = Tokenizer.from_file(path)
        if strips:
            library.normalizer = normalizers.Sequence(
                [library.normalizer, normalizers.NFD(), normalizers.StripAccents()]
            )
        own = str(tmp_path / f"{strips}.json")
        library.save(own)
        words, sent = tokens.WordIds(own), []
        whole = words._encode
        words._encode = lambda some: sent.extend(some) or whole(some)
        got = words.of([t.encode() for t in texts], 2)
        assert [list(g) for g in got] == [
            [*library.encode(t, add_special_tokens=False).ids, 2] for t in texts
        ]
        assert (words.spelling is None) == strips
        assert any(set(t) <= set(tokens.LETTERS) for t in sent) == strips


def test_ids_are_counted_as_they_are_made(spark):
    """A row per task holds its counts; they come to those of the ids of all documents."""
    docs = spark.createDataFrame([(i, "a b c, a" * (i % 3)) for i in range(9)], "doc_id int, text string")
    coding = tokens.Coding(tokenizer_path("word_bpe_49k.json"), vocab=49_408)
    rows = tokens.token_ids(docs.repartition(3), coding)
    ids = [tokens.unpack(r.ids) for r in rows.where("counts is null").collect()]
    want = np.bincount(np.concatenate(ids), minlength=coding.vocab)
    assert len(ids) == 9 and (tokens._counts(rows, coding.vocab) == want).all()


def test_no_documents_give_no_ids(spark, folder):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    coding = tokens.Coding(tokenizer_path("word_bpe_49k.json"), vocab=49_408)
    tokens.write(docs, f"{folder}/t", coding)
    assert tokens.read(spark, f"{folder}/t").count() == 0


# -- pipeline -----------------------------------------------------------------------------


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    item = spark.read.parquet(f"{SF}/benchmark.parquet").orderBy(F.desc(F.length("text"))).first()
    text = docs.where("lang = 'en' and n_chars > 1500").orderBy("doc_id").first()["text"]
    clean = " ".join(docs.where("lang = 'de'").orderBy("doc_id").limit(4).toPandas().text)
    planted = spark.createDataFrame(
        [
            (9001, "12 34 ###", "en", "src1", 9),
            (9002, None, None, None, None),
            (9003, text, "en", "src1", 1),
            (9004, text.replace(" the ", " that ", 1), "en", None, 1),
            (9005, f"{clean} {item['text']} {clean}", "de", "src2", 1),
            (None, clean[:700], "de", "src2", 1),
        ],
        docs.schema,
    )
    rows = docs.unionByName(planted).selectExpr("*", "1 as score", "2 as leaked", "3 as nth")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, rows, SF).write.parquet(f"{folder}/{name}")
        rows = spark.read.parquet(f"{folder}/{name}")
        seen[name] = rows
        if name != "tokens":
            assert rows.columns == list(corpus_pipeline.COLUMNS)
    ids = {n: [r[0] for r in df.select("doc_id").collect()] for n, df in seen.items()}
    assert {9001, 9002}.isdisjoint(ids["language"]) and len(ids["language"]) == 1004
    assert {9003, 9004}.isdisjoint(ids["near_duplicates"])
    assert len(ids["near_duplicates"]) == len(set(ids["near_duplicates"]))
    assert None in ids["near_duplicates"]
    groups = neardup.near_duplicates(seen["language"], size=5, percent=80)
    assert set(ids["near_duplicates"]) - {None} == {
        r["component_id"] for r in groups.where("doc_id is not null").collect()
    }
    assert 9005 in ids["near_duplicates"] and 9005 not in ids["decontamination"]
    assert max(ids["mixing"].count(i) for i in set(ids["mixing"]) - {None}) == 2
    assert sorted(ids["tokens"], key=str) == sorted(ids["mixing"], key=str)
    assert langid.UNKNOWN == "und"


def test_stages_of_nothing(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).count() == 0


def test_different_texts_of_one_doc_id(spark):
    words = [f"w{k}" for k in range(400)]
    near = " ".join(words[:100])
    rows = [(1, near)] + [(7, " ".join(words[k : k + 60])) for k in range(100, 400, 60)]
    rows += [(7, near + " more"), (7, rows[1][1]), (8, rows[2][1] + " more"), (9, "only one"), (None, near)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr(
        "*", "'en' as lang", "'s' as source", "cast(length(text) as bigint) as n_chars"
    )
    got = [(r["doc_id"], r["text"]) for r in corpus_pipeline.near_duplicates(spark, docs, "").collect()]
    # Of the two near copies (7 and 8) one stays.
    pair = [(7, rows[2][1]), (8, rows[2][1] + " more")]
    assert len(set(pair) & set(got)) == 1
    want = [(1, near), (9, "only one"), (None, near)] + [rows[k] for k in (1, 3, 4, 5)]
    assert sorted(map(str, set(got) - set(pair))) == sorted(map(str, want))
    assert len(got) == len(want) + 1


def test_stages_take_batches_of_bounded_bytes(spark):
    rows = spark.range(9000).repartition(1).selectExpr("id as doc_id", "repeat('abcd ', 400) as text")
    docs = rows.selectExpr("*", "'en' as lang", "'s' as source", "2000L as n_chars")

    def bytes_of(batches):
        for batch in batches:
            yield pa.record_batch({"n": pa.array([batch.num_rows]), "b": pa.array([batch.nbytes])})

    def batches():
        return docs.mapInArrow(bytes_of, "n bigint, b bigint").collect()

    spark.conf.unset(BATCH_LIMIT)
    try:
        for made in (
            lambda: tokens.token_ids(docs, tokens.Coding("", vocab=1)),
            lambda: neardup.sign(docs, 5),
            lambda: langid.predict(docs, langid.fit([], []), "doc_id"),
            lambda: decontaminate.leaks(docs, docs.limit(1).selectExpr("doc_id as item_id", "text")),
        ):
            spark.conf.unset(BATCH_LIMIT)
            made()
            got = batches()
            assert sum(r.n for r in got) == 9000 and max(r.b for r in got) < 1.2 * BATCH_BYTES
        spark.conf.set(BATCH_LIMIT, "1m")  # as somebody chose
        neardup.sign(docs, 5)
        assert spark.conf.get(BATCH_LIMIT) == "1m"
    finally:
        spark.conf.unset(BATCH_LIMIT)


def own_mb():
    """Memory of this process, without files."""
    with open("/proc/self/smaps_rollup") as f:
        return next(int(line.split()[1]) for line in f if line.startswith("Anonymous:")) / 1024


def test_freed_memory_is_given_back():
    def run(batches):
        for n in batches:
            # Small ones, which allocators keep; half of them, freed last, lie between the others.
            held = [pa.array(range(2000)) for _ in range(n)] + [bytes(20_000) for _ in range(n)]
            yield len(held)
            peaks.append(own_mb())

    peaks, before = [], own_mb()
    assert list(lean(run)([3000, 3000])) == [6000, 6000]
    assert max(peaks) > before + 80
    assert own_mb() < before + 30
