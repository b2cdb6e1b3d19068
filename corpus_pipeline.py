"""A training corpus from raw documents: five stages, each by one operator of lakestrata.llm.

Every stage takes (spark, docs, sf_dir) and works on all rows it is given; its result is
written and read again as the next one's input.  All but the last return the columns of
documents.

* language: documents without a recognised language go.
* near_duplicates: one document of each group of near copies stays (5-word shingles, 0.8).
* decontamination: documents that hold a benchmark item go.
* mixing: documents are repeated or left out so that sources meet their target sizes.
* tokens: token ids are written to compressed blocks; a row of digests per document.

Defined cases: a null or empty text has no language and goes at the first stage; rows of one
doc_id and equal text count as one document, those of different texts as several, of which only
near copies go; a row without doc_id is no copy of any;
repeated rows of the mix are encoded as often as they occur; an empty table stays empty.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakestrata.llm import decontaminate, langid, mixing, neardup, tokens
from lakestrata.llm.common import table, tokenizer_path
from lakestrata.session import shared_dir

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
LEAST_SCORE = 0.3


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = docs.select(*COLUMNS)
    said = langid.predict(rows, langid.learn(rows), *COLUMNS)
    return said.where((F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= LEAST_SCORE)).select(
        *COLUMNS
    )


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = docs.select(*COLUMNS).withColumn("digest", F.xxhash64("text"))
    # One text of a doc_id goes by the doc_id, nearly always the only one; each further
    # text by a hash from 2**62 on, so that smaller names stay the first choice.
    several = (
        rows.where("doc_id is not null")
        .groupBy("doc_id")
        .agg(F.min("digest").alias("own"), F.max("digest").alias("other"))
        .where("own <> other")
        .drop("other")
    )
    further = F.expr("(xxhash64(doc_id, digest) & 4611686018427387903L) | 4611686018427387904L")
    named = rows.join(several, "doc_id", "left").withColumn(
        "name", F.when(F.col("digest") != F.col("own"), further).otherwise(F.col("doc_id"))
    )
    stay = (
        neardup.near_duplicates(
            named.select(F.col("name").alias("doc_id"), "text"), size=5, percent=80
        )
        .where("kept and doc_id is not null")
        .select(F.col("doc_id").alias("name"))
        .distinct()
    )
    # Rows of one name: nearly always one.
    one = Window.partitionBy("name").orderBy(F.xxhash64("text", "source", "lang"), "text")
    first = (
        named.join(stay, "name", "left_semi")
        .withColumn("nth", F.row_number().over(one))
        .where("nth = 1")
        .select(*COLUMNS)
    )
    return first.unionByName(rows.where("doc_id is null").select(*COLUMNS))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = docs.select(*COLUMNS)
    items = table(spark, sf_dir, "benchmark")
    return (
        decontaminate.leaks(rows, items, *COLUMNS, all_rows=True)
        .where(~F.col("leaked"))
        .select(*COLUMNS)
    )


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.take(mixing.mix(docs.select(*COLUMNS), whole_rows=True))


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    coding = tokens.Coding(tokenizer_path("word_bpe_49k.json"), vocab=49_408, end_id=2)
    return tokens.write_and_read(docs, coding)


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mix),
    ("tokens", token_output),
]

# Learned models, signatures and token ids are beyond SQL; tests hold a run against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = f"{shared_dir(spark)}/pipeline/{uuid.uuid4().hex}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
