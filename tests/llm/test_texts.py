"""Text operators: extraction, personal data, licences, quality, language."""

import hashlib
import re
import time
from itertools import permutations

import pytest

from lakestrata.llm import html, langid, licenses, pii, quality

SF = "/root/testdata/sf0.01"

# -- HTML ---------------------------------------------------------------------------------

LONG = "The cat and the dog were in the house of the king, and it was not for the queen to say so."


@pytest.mark.parametrize(
    "page, text",
    [
        ("", ""),
        ("only   text", "only text"),
        ("<p>a&amp;b &lt;c&gt;&nbsp;d<br>e</p><p>f", "a&b <c> d e\n\nf"),
        ("<script>if(a<b){'</p>'}</script><style>p{}</style><p>x</p><!-- <p>y</p> -->", "x"),
        ("<head><title>t</title></head><body><nav><a href='/'>Home</a></nav><p>x</p></body>", "x"),
        (f"<article><h1>T</h1><p>{LONG}</p><p>Short.</p></article><footer>f</footer>", f"T\n\n{LONG}\n\nShort."),
        (f"<main><p>{LONG}</p><form><p>Name</p></form><div class='user-comments'><p>{LONG}</p></div></main>", LONG),
        (f"<div class='ad'>{LONG}</div><p>Short.</p>", "Short."),
        (f"<p>{LONG}</p><ul><li><a href='x'>one</a></li><li><a>two</a></li></ul><p>end</p>", LONG),
        (f"<div id=cookieNotice>{LONG}</div><article><header><h1>T</h1></header><p>x</p></article>", "T\n\nx"),
        ("<svg><text>no</text></svg><p style='display:none'>no</p><p>x</p>", "x"),
        ("<b \"<p>x", "x"),
    ],
)
def test_main_text(page, text):
    assert html.main_text(page) == text


ITALIAN = (
    "Ogni mattina i pescatori tornavano verso riva quando sorgeva sole, portando reti piene "
    "che vendevano subito presso mercati vicini."
)
CARD = "<article><p>Read more news</p></article>"


@pytest.mark.parametrize(
    "page, text",
    [
        (f"<form id=aspnetForm><nav>n</nav><article><p>{LONG}</p></article></form>", LONG),
        (f"<form><div><p>{LONG}</p><p>{LONG}</p></div></form><footer>f</footer>", f"{LONG}\n\n{LONG}"),
        (f"<main class='site-main has-sidebar'><p>{LONG}</p></main>", LONG),
        (f"<main class='search'><p>{LONG}</p></main>", LONG),
        (f"<div class='no-sidebar'><p>{LONG}</p></div>", LONG),
        (f"<div class='layout-sidebar-left'><p>{LONG}</p></div>", LONG),
        (f"<article class='post category-social'><p>{LONG}</p></article>", LONG),
        (f"<article class='social'><p>{LONG}</p></article>", LONG),
        (f"<article><p>{LONG}</p><div class='related-work comments-open ad-free'><p>{LONG}</p></div></article>", f"{LONG}\n\n{LONG}"),
        (f"<div><p>{LONG}</p></div>{CARD}", f"{LONG}\n\nRead more news"),
        (f"<p><a href='/'>One</a></p><p>{ITALIAN}</p><p>{ITALIAN}</p><p><a href='/'>Two</a></p>", f"{ITALIAN}\n\n{ITALIAN}"),
        # What is no article still goes.
        (f"<article><p>{LONG}</p></article><div class='comments'><article class='comment'><p>{LONG}</p></article></div>", LONG),
        (f"<div><p>{LONG}</p></div><div class='comments-area'><article class='comment-body'>{LONG}</article></div>", LONG),
        (f"<article><p>{LONG}</p></article><div class='share-buttons'>{LONG}</div><form>{LONG}</form>", LONG),
        (f"<article><p>{LONG}</p></article><p>{LONG}</p>", LONG),
        (f"<p>{LONG}</p><p>{'Shoes Bags Hats ' * 6}</p><p>{LONG}</p>", f"{LONG}\n\n{LONG}"),
    ],
)
def test_whole_articles_stay(page, text):
    assert html.main_text(page) == text


@pytest.mark.parametrize("tag", "button map object canvas noscript audio svg select video".split())
def test_an_element_never_closed_hides_no_other_block(tag):
    page = f"<article><p>{LONG}</p><div><{tag} a=b></div><p>{LONG}</p></article>"
    assert html.main_text(page) == f"{LONG}\n\n{LONG}"
    closed = page.replace("</div>", f"no</{tag}></div>")
    assert html.main_text(closed) == f"{LONG}\n\n{LONG}"


@pytest.mark.parametrize("piece", ["<a ", '<a "', "<button>", "<div>", "<button><script ", "<div></p>", "<!-- x"])
def test_a_page_of_a_megabyte_is_read_in_linear_time(piece):
    start = time.monotonic()
    html.main_text(piece * (1_000_000 // len(piece)))
    assert time.monotonic() - start < 10


def test_extract_rows(spark):
    pages = spark.createDataFrame(
        [(1, "u", "<p>é𝄞 x</p>", "t"), (2, None, None, "t"), (None, "v", "<p>y", "t")],
        "page_id bigint, url string, html string, text string",
    )
    got = [tuple(r) for r in html.extract(pages).collect()]
    assert got == [(1, "u", "é𝄞 x", 4), (2, None, "", 0), (None, "v", "y", 1)]
    assert html.extract(pages.limit(0)).count() == 0


# -- personal data ------------------------------------------------------------------------


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (2 if i % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def brute_pii(text):
    text = text or ""
    kinds = (
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
        ("card", r"[0-9]([\x20-]?[0-9])+"),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
    )
    spans, counts = [], {}
    for order, (kind, pattern) in enumerate(kinds):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == "card" and not (14 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 10 <= len(digits) <= 15:
                continue
            spans.append((m.start(), order, f"{kind}:{m.start()}:{m.end()}"))
            counts[kind] = counts.get(kind, 0) + 1
    joined = ",".join(s for _, _, s in sorted(spans))
    return [counts.get(k, 0) for k, _ in kinds], hashlib.sha256(joined.encode()).hexdigest()


PERSONAL = [
    None,
    "",
    "a@b.c.@d.e 1.2.3.4.5.6.7.8 999.1.1.1 00001.2.3.4 x@y x@y.z.",
    "4111 1111 1111 1111, 4111111111111112, 4111-1111-1111-1111",
    "1" * 5000,
    "+1 (2) 3 4 567-890-1 +123 é𝄞 +4930123456789 x@y.z +1 +(2)",
    "a." * 2000 + "@x.y",
    "1-" * 3000,
    "+1" + "(" * 3000,
    "mail: me.too+x@sub-1.example.com, host 10.0.0.1 card 5500 0000 0000 0004",
]


def test_base_spans_match_brute_force(spark):
    rows = list(enumerate(PERSONAL)) + [(3, PERSONAL[3])]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "1 as base", "2 as more")
    whole = docs.select("doc_id", "text").unionByName(
        spark.read.parquet(f"{SF}/documents.parquet").limit(200).selectExpr("doc_id + 1000 as doc_id", "text")
    )
    text_of = {r["doc_id"]: r["text"] for r in whole.collect()}
    got = pii.digest(pii.find(docs)).collect() + pii.digest(pii.find(whole)).collect()
    assert len(got) == len(rows) * 2 + 200
    for r in got:
        counts, digest = brute_pii(text_of[r["doc_id"]])
        assert [r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]] == counts
        assert r["base_sha256"] == digest


def test_spans_the_method_adds(spark):
    texts = [
        "IBAN GB82 WEST 1234 5698 7654 32 ok",
        "IBAN GB82 WEST 1234 5698 7654 33 no",
        "call (617) 555-2870 now",
        "number (617) 555-2870 now",
        "SSN: 123-45-6789 and 000-12-3456",
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r["doc_id"]: r["spans"] for r in pii.digest(pii.find(docs)).collect()}
    assert got == {0: "iban:5:32", 1: "", 2: "national_phone:5:19", 3: "", 4: "ssn:5:16"}
    assert pii.digest(pii.find(docs.limit(0))).count() == 0


# -- licences -----------------------------------------------------------------------------


def brute_places(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
    at = [
        (i, label)
        for label, phrase in licenses.PHRASES.items()
        for i in range(len(words))
        if words[i : i + len(phrase.split())] == phrase.split()
    ]
    places = [i for i, _ in at]
    return (
        len(words),
        len(at),
        min(places, default=None),
        max(places, default=None),
        ",".join(sorted({x for _, x in at})),
    )


def test_licences(spark):
    texts = [
        None,
        "",
        "MIT License mit license. (GNU General\nPublic-License) apachelicense Apache   LICENSE",
        "émit license mit lİcense general public",
        "x " * 3000 + licenses.NOTICES[0].text + " y" * 3000,
        licenses.NOTICES[4].text.upper(),
        "mit license " * 500,
        "software license gnu foundation mozilla",
        "This work is licensed under the GNU General Public License, version 3.",
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").selectExpr("*", "1 as hits")
    got = {r["doc_id"]: r for r in licenses.scan(docs.unionByName(docs.where("doc_id = 2"))).collect()}
    for i, text in enumerate(texts):
        r = got[i]
        found = (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"])
        assert found == brute_places(text)
        assert 0 <= r["score"] <= 1
    assert [got[i]["labels"] for i in (4, 5, 7, 8)] == ["mit", "bsd", "", "gpl"]
    assert got[4]["score"] > 0.9 and got[0]["score"] == 0
    assert licenses.scan(docs.limit(0)).count() == 0


def test_licences_that_stand_in_one_text(spark):
    one_of_each = [n for i, n in enumerate(licenses.NOTICES) if i != 3]
    groups = [*permutations(one_of_each, 2), *permutations(one_of_each, 3), one_of_each, one_of_each[::-1]]
    texts = [" ".join(n.text for n in group) for group in groups]
    # Half a notice after copies of its rarest words, and two copies of which one is cut.
    mit = licenses.NOTICES[0].text.split()
    texts.append("sublicense merge publish deal " * 50 + " ".join(mit[: 3 * len(mit) // 4]))
    texts.append(" ".join(mit[-20:]) + " x " + " ".join(mit))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r["doc_id"]: r for r in licenses.scan(docs).collect()}
    for i, group in enumerate(groups):
        assert set(got[i]["labels"].split(",")) >= {n.label for n in group}
        assert got[i]["score"] == 1
    assert [got[i]["labels"] for i in (len(texts) - 2, len(texts) - 1)] == ["mit", "mit"]


# -- quality and language -----------------------------------------------------------------


def test_copies_of_one_labelled_document_do_not_crowd_out_others(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    one = labels.where("quality = 1").where(~quality.held_out()).join(docs, "doc_id").first()
    copies = spark.createDataFrame([(one["doc_id"], one["text"])] * 8000, docs.schema)
    got = quality.rate(docs.unionByName(copies), labels).dropDuplicates(["doc_id"])
    plain = quality.rate(docs, labels)
    both = got.toPandas().merge(plain.toPandas(), on="doc_id")
    assert len(both) == docs.count()
    assert (both.predicted_x == both.predicted_y).all()
    assert (abs(both.score_x - both.score_y) < 1e-6).all()


def test_quality_on_held_out_rows(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    odd = spark.createDataFrame([(None, None), (10**6, ""), (10**6, "")], "doc_id bigint, text string")
    got = quality.rate(docs.select("doc_id", "text").unionByName(odd), labels)
    assert got.count() == 1003
    both = got.where("held_out").join(labels, "doc_id").toPandas()
    assert (both.predicted == both.quality).mean() >= 0.95
    assert got.where("score < 0 or score > 1 or score is null").count() == 0
    none = quality.rate(docs.limit(5), labels.limit(0)).collect()
    assert {r["score"] for r in none} == {0.5} and {r["predicted"] for r in none} == {1}


def test_pairwise_terms_of_the_machine():
    import numpy as np

    gen = np.random.default_rng(0)
    n = quality.BUCKETS + quality.STATS
    made = quality.Machine(0.1, gen.normal(size=n), gen.normal(size=(n, quality.RANK)))
    at, x = np.array([3, 50, 700]), np.array([0.5, -1.0, 2.0])
    plain = 0.1 + sum(made.linear[i] * v for i, v in zip(at, x, strict=True))
    for i in range(3):
        for j in range(i):
            plain += float(made.factors[at[i]] @ made.factors[at[j]]) * x[i] * x[j]
    assert made.raw(at, x) == pytest.approx(plain)


def test_language_on_held_out_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    odd = spark.createDataFrame(
        [(None, None, None), (1, "", "en"), (2, "12 ### 3", "en"), (3, "É", "fr")],
        "doc_id bigint, text string, lang string",
    )
    got = langid.identify(docs.unionByName(odd))
    both = got.where("held_out").join(docs.select("doc_id", "lang"), "doc_id").where("lang_pred <> 'und'")
    held = both.toPandas()
    assert (held.lang_pred == held.lang).mean() >= 0.97
    assert got.where("lang_pred = 'und'").count() == 3
    nothing = langid.identify(docs.limit(3).selectExpr("doc_id", "text", "cast(null as string) lang"))
    assert {(r["lang_pred"], r["score"]) for r in nothing.collect()} == {("und", 0.0)}


def test_families_group_what_is_alike():
    import numpy as np

    means = np.array([[1, 0.9, 0, 0], [0, 0, 1, 0.8], [0.9, 1, 0, 0], [0, 0, 0.9, 1.0]])
    assert sorted(langid.families_of(means)) == [[0, 2], [1, 3]]


def test_languages_of_copies_and_many_languages(spark):
    # Each language has few texts, most rows of it copies of one; one group of copies is huge.
    words = {"en": "the cat and dog", "de": "der Hund und Katze", "fr": "le chien et chat", "es": "el perro y gato"}
    rows = [
        (f"{said} {lang} {k}" * 3, lang)
        for lang, said in words.items()
        for k in (["copy"] * 2000 if lang != "en" else ["a", "b", "c"])
    ]
    rows += [("the cat and dog " + "x" * (k % 7) + str(k), "en") for k in range(3000)]
    rows += [("one text of very many copies", "en")] * 6000
    docs = spark.createDataFrame(
        [(i, *row) for i, row in enumerate(rows)], "doc_id bigint, text string, lang string"
    )
    assert langid.learn(docs).languages == ["de", "en", "es", "fr"]
    many = [(3 * i + j, f"{chr(0x100 + i) * 3} w{chr(0x100 + i)}", f"l{i:03}") for i in range(230) for j in range(3)]
    many = spark.createDataFrame(many, "doc_id bigint, text string, lang string")
    held = langid.held_out()
    least = many.where(~held).select("lang").distinct().count()
    assert len(langid.learn(many, sample=400, least=1).languages) == least > 200


def test_margins_without_memory_of_words(monkeypatch):
    import numpy as np

    texts = [b"the cat and the dog", b"der hund und die katze", b"le chien et le chat", b"12"]
    model = langid.fit(texts[:3], ["en", "de", "fr"])
    kept = langid.WordMargins(model).margins(texts)
    monkeypatch.setattr(langid, "MEMO_MARGINS", 0)
    direct = langid.WordMargins(model).margins(texts)
    assert np.allclose(kept[:3], direct[:3], atol=1e-4)
