"""Licences named or quoted in whole texts, by expressions that run in the JVM.

Two sources of labels.  Base: places where a licence's name stands word by word.  Method: a
positional index of rare words.  The words of the licence notices below, without the commonest
English ones, are looked up in every text; the corpus's own document frequencies weigh them.
Every place of such a word in a text and each of its places in a notice vote for a relative
position with the word's weight.  A notice is found where one relative position gathers enough of
the notice's weight and one of its mandatory phrases stands in the text; all positions count,
so notices next to each other do not hide one another.

Words are runs of non-ASCII characters, letters and digits, A-Z lowered.

Defined cases: a null or empty text has no words and no labels; equal rows give equal
results; other columns are not carried; an empty table gives no rows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakestrata.llm.common import lower_ascii
from lakestrata.session import materialize

# The names that count wherever they stand.
PHRASES = {
    "mit": "mit license",
    "apache": "apache license",
    "gpl": "general public license",
}


@dataclass(frozen=True)
class Notice:
    label: str
    text: str
    phrases: tuple[str, ...]  # at least one must stand in the text


# Opening lines of common licence notices, and phrases without which a text
# is not under them.
NOTICES = (
    Notice(
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this "
        "software and associated documentation files to deal in the software without "
        "restriction including without limitation the rights to use copy modify merge publish "
        "distribute sublicense and or sell copies of the software",
        ("permission is hereby granted free of charge", "released under the mit license"),
    ),
    Notice(
        "apache",
        "licensed under the apache license version 2 0 you may not use this file except in "
        "compliance with the license you may obtain a copy of the license at",
        ("apache license",),
    ),
    Notice(
        "gpl",
        "this program is free software you can redistribute it and or modify it under the terms "
        "of the gnu general public license as published by the free software foundation",
        ("general public license", "free software foundation"),
    ),
    Notice(
        "gpl",
        "this work is licensed under the gnu general public license version 3",
        ("general public license", "gnu gpl"),
    ),
    Notice(
        "bsd",
        "redistribution and use in source and binary forms with or without modification are "
        "permitted provided that the following conditions are met redistributions of source "
        "code must retain the above copyright notice",
        ("redistribution and use in source and binary forms",),
    ),
    Notice(
        "mpl",
        "this source code form is subject to the terms of the mozilla public license v 2 0",
        ("mozilla public license",),
    ),
    Notice(
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or "
        "without fee is hereby granted",
        ("for any purpose with or without fee is hereby granted",),
    ),
    Notice(
        "cc",
        "this work is licensed under a creative commons attribution international license",
        ("creative commons",),
    ),
    Notice(
        "unlicense",
        "this is free and unencumbered software released into the public domain",
        ("unencumbered software released into the public domain",),
    ),
)
# Words too common to look for.
COMMON = frozenset(
    "a above and any are as at be by can for form from in is it may met must not of or "
    "out sell that the this to use with without work you 0 2 3 v".split()
)
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _postings() -> list[tuple[int, str, int]]:
    return [
        (i, word, place)
        for i, notice in enumerate(NOTICES)
        for place, word in enumerate(notice.text.split())
        if word not in COMMON
    ]


def vocabulary() -> list[str]:
    named = {w for phrase in PHRASES.values() for w in phrase.split()}
    return sorted(named | {w for _, w, _ in _postings()})


def _sql_strings(words: list[str]) -> str:
    return "array(" + ", ".join(f"'{w}'" for w in words) + ")"


def look_up(docs: DataFrame) -> DataFrame:
    """(doc_id, key, n_words, hits, phrases): the places of the index's words in each text,
    and which mandatory phrases it has.  The one pass over the texts."""
    vocab = vocabulary()
    phrases = sorted({p for n in NOTICES for p in n.phrases})
    words = docs.select(
        "doc_id",
        F.xxhash64("doc_id", "text").alias("key"),
        F.split(lower_ascii(F.coalesce(F.col("text").cast("string"), F.lit(""))), SEPARATORS).alias(
            "split"
        ),
    ).withColumn("words", F.expr("filter(split, w -> w <> '')"))
    joined = F.expr("concat(' ', array_join(words, ' '), ' ')")
    some = F.arrays_overlap("words", F.expr(_sql_strings(vocab)))
    hit = f"""filter(transform(words, (w, i) -> (i as p, w as w)),
                     x -> array_contains({_sql_strings(vocab)}, x.w))"""
    return words.select(
        "doc_id",
        "key",
        F.size("words").cast("bigint").alias("n_words"),
        F.when(some, F.expr(hit)).otherwise(
            F.expr("cast(array() as array<struct<p:int,w:string>>)")
        ).alias("hits"),
        F.when(
            some,
            F.filter(F.expr(_sql_strings(phrases)), lambda p: joined.contains(F.concat(F.lit(" "), p, F.lit(" ")))),
        )
        .otherwise(F.expr("cast(array() as array<string>)"))
        .alias("phrases"),
    )


def _weights(found: DataFrame) -> dict[str, float]:
    """Inverse document frequency over the whole table, in steps of 2**-32 so that sums of
    some dozens are exact in any order; a row per word of the index."""
    total = found.count()
    rows = (
        found.select(F.explode(F.expr("array_distinct(transform(hits, x -> x.w))")).alias("w"))
        .groupBy("w")
        .count()
        .collect()
    )
    counted = {r["w"]: r["count"] for r in rows}
    idf = {w: math.log((1 + total) / (1 + counted.get(w, 0))) + 1 for w in vocabulary()}
    return {w: round(x * 2**32) / 2**32 for w, x in idf.items()}


def _aligned(found: DataFrame, least: float) -> DataFrame:
    """(key, labels, coverage): the notices whose words stand at one relative position."""
    weights = _weights(found)
    spark = found.sparkSession
    mass = [0.0] * len(NOTICES)
    for notice, word, _ in _postings():
        mass[notice] += weights[word]
    postings = spark.createDataFrame(
        [
            (i, word, place, NOTICES[i].label, weights[word], mass[i])
            for i, word, place in _postings()
        ],
        "notice int, w string, place int, label string, weight double, mass double",
    )
    # Notices without a phrase in the text are out before their words are looked up.
    may = "filter(array({}), x -> x is not null)".format(
        ", ".join(
            f"case when arrays_overlap(phrases, {_sql_strings(list(n.phrases))}) then {i} end"
            for i, n in enumerate(NOTICES)
        )
    )
    texts = found.where("size(hits) > 1 and size(phrases) > 0").dropDuplicates(["key"])
    checked = (
        texts.selectExpr("key", "hits", f"{may} as may")
        .selectExpr("key", "may", "inline(hits)")
        .join(F.broadcast(postings), "w")  # the index: a few hundred rows, fixed above
        .where("array_contains(may, notice)")
        .groupBy("key", "notice", (F.col("p") - F.col("place")).alias("shift"))
        .agg(
            F.first("label").alias("label"),
            (F.sum("weight") / F.first("mass")).alias("coverage"),
        )
    )
    return (
        checked.where(F.col("coverage") >= least)
        .groupBy("key")
        .agg(F.collect_set("label").alias("more"), F.max("coverage").alias("coverage"))
    )


def _places(phrase: str) -> Column:
    """Array of the places where the phrase's words stand one after the other."""
    words = phrase.split()
    same = " and ".join(
        f"get(hits, i + {k}).w = '{w}' and get(hits, i + {k}).p = x.p + {k}"
        for k, w in enumerate(words)
    )
    return F.expr(
        f"transform(filter(transform(hits, (x, i) -> (x.p as p, coalesce({same}, false) as ok)),"
        " y -> y.ok), y -> y.p)"
    )


def scan(docs: DataFrame, least: float = 0.5) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score per row.

    score: the weight share of the best notice found, or 1 - 1/2**n_base if more.
    """
    found = materialize(look_up(docs))
    aligned = _aligned(found, least)
    placed = found.select(
        "doc_id",
        "key",
        "n_words",
        *[_places(p).alias(f"at_{label}") for label, p in PHRASES.items()],
    )
    ends = F.concat(*[f"at_{label}" for label in PHRASES])
    labels = F.filter(
        F.array(*[F.when(F.size(f"at_{x}") > 0, F.lit(x)) for x in sorted(PHRASES)]),
        lambda x: x.isNotNull(),
    )
    base = placed.select(
        "doc_id",
        "key",
        "n_words",
        F.size(ends).cast("bigint").alias("n_base"),
        F.array_min(ends).cast("bigint").alias("first_word"),
        F.array_max(ends).cast("bigint").alias("last_word"),
        labels.alias("base"),
    )
    both = F.array_sort(F.array_union("base", F.coalesce("more", F.expr("cast(array() as array<string>)"))))
    return base.join(aligned, "key", "left").select(
        "doc_id",
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.array_join("base", ",").alias("base_labels"),
        F.array_join(both, ",").alias("labels"),
        F.greatest(
            F.least(F.coalesce("coverage", F.lit(0.0)), F.lit(1.0)),
            F.lit(1.0) - F.pow(F.lit(0.5), F.col("n_base").cast("double")),
        ).alias("score"),
    )
