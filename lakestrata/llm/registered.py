"""The queries of the operators, with production parameters, and the SQL that checks them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from lakestrata.llm import (
    bytebpe,
    clusters,
    decontaminate,
    html,
    langid,
    licenses,
    mixing,
    neardup,
    neighbours,
    periods,
    pii,
    quality,
    tokens,
)
from lakestrata.llm.common import table, tokenizer_path


def op1_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.search(table(spark, sf_dir, "embeddings"), "vec_id % 50 = 0", k=5)


def op2_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(table(spark, sf_dir, "pages"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), "doc_id"
    )


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.find(table(spark, sf_dir, "documents")))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op6_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    coding = tokens.Coding(tokenizer_path("word_bpe_49k.json"), vocab=49_408, end_id=2)
    return tokens.write_and_read(table(spark, sf_dir, "documents"), coding)


def op7_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), size=2, percent=80)


def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.rate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    ranks = bytebpe.Ranks.of_file(
        tokenizer_path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    )
    encoded = bytebpe.encode(table(spark, sf_dir, "documents"), ranks)
    return bytebpe.digest(bytebpe.decode(encoded, ranks))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = periods.with_periodic_tails(table(spark, sf_dir, "documents"))
    return periods.digest(periods.find_runs(docs))


def op13_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return clusters.summary(*clusters.cluster(rows, k=40, rounds=5, dims=64))


QUERIES = {
    "op1_neighbours": op1_neighbours,
    "op2_html": op2_html,
    "op3_decontamination": op3_decontamination,
    "op4_pii": op4_pii,
    "op5_mixing": op5_mixing,
    "op6_token_output": op6_token_output,
    "op7_near_duplicates": op7_near_duplicates,
    "op8_licenses": op8_licenses,
    "op9_quality": op9_quality,
    "op10_language_id": op10_language_id,
    "op11_byte_bpe": op11_byte_bpe,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_clusters": op13_clusters,
    "pipeline": corpus_pipeline.run,
}



def clusters_sql(k: int, rounds: int) -> str:
    """The rounds of op13 as one statement, a few common tables for each."""

    def assign(i: int) -> str:
        return f"""a{i} as materialized (
    select vec_id, nth, min({{'d': d, 'k': k}}) m from (
      select vec_id, nth, k, list_sum(
        [(vecs.v[j] - c{i}.v[j]) * (vecs.v[j] - c{i}.v[j]) for j in range(1, 65)])::bigint d from vecs, c{i}) group by all)"""

    def move(i: int) -> str:
        return f"""s{i + 1} as materialized (
    select m.k k, j, sum(v[j])::bigint s, count(*)::bigint n
    from vecs join a{i} using (nth), (select unnest(range(1, 65)) j) group by all),
  m{i + 1} as (
    select k, list((s - ((s % n) + n) % n) // n order by j) v from s{i + 1} group by k),
  c{i + 1} as materialized (
    select c{i}.k k, coalesce(m{i + 1}.v, c{i}.v) v from c{i} left join m{i + 1} using (k))"""

    steps = [assign(0)]
    for i in range(rounds):
        steps += [move(i), assign(i + 1)]
    return f"""
  with vecs as materialized (
    select vec_id, row_number() over () nth,
           [floor(256 * x::double)::bigint for x in embedding] v
    from embeddings
    where len(embedding) = 64 and len([x for x in embedding if isfinite(x)]) = 64),
  c0 as materialized (
    select row_number() over (order by sha256('2:' || vec_id), v) - 1 k, v
    from vecs qualify k < {k}),
  {", ".join(steps)}
  select vec_id, m.k::int as cluster, m.d distance,
         sum(m.d) over (partition by m.k)::bigint cluster_inertia,
         sum(m.d) over ()::bigint inertia,
         sha256(array_to_string(c{rounds}.v, ',')) centroid_sha256
  from a{rounds} join c{rounds} on c{rounds}.k = m.k"""


# The other results rest on learned models, on hashes of this library or on iterations; tests
# hold those against brute force, round trips or held-out rows.
ORACLE: dict[str, str] = {
    "op12_periodic_runs": r"""
  with recursive named as (
    select row_number() over () nth, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') w
    from documents),
  -- crc32 of the decimal doc_id, byte by byte, bit by bit
  crc(doc_id, pos, c) as (
    select distinct doc_id, 0, 4294967295::bigint from documents where doc_id is not null
    union all
    select doc_id, pos + 1,
      list_reduce([xor(c, ascii(substr(doc_id::varchar, pos + 1, 1)))] || range(8)::bigint[],
                  lambda a, b: xor(a >> 1, (a & 1) * 3988292384))
    from crc where pos < length(doc_id::varchar)),
  hashed as (
    select doc_id, xor(c, 4294967295) h from crc where pos = length(doc_id::varchar)),
  cut as (
    select nth, named.doc_id, w, len(w) n, h, h // 10 g from named left join hashed using (doc_id)),
  laid as (
    select *, if(h % 10 = 0 and n > 0, g % n, n) a from cut),
  turned as (
    select *, 1 + (n - a) // (3 + coalesce(g, 0) % 8) p from laid),
  words as materialized (
    select nth, i, w[1 + if(i < a, i, a + (i - a) % p)] x
    from (select *, unnest(range(n)) i from turned)),
  equal as (
    select u.nth, v.i - u.i q, u.i
    from words u join words v on u.nth = v.nth and u.x = v.x and v.i > u.i
    join turned t on t.nth = u.nth where 3 * (v.i - u.i) <= n),
  isles as (
    select nth, q, i - row_number() over (partition by nth, q order by i) isle, i from equal),
  long as (
    select nth, min(i) start, count(*) + q length, q from isles group by nth, q, isle
    having count(*) + q >= greatest(24, 3 * q)),
  runs as materialized (
    select nth, start, length, min(q) period from long group by nth, start, length),
  dropped as (
    select distinct nth, unnest(range(start + period, start + length)) i from runs),
  kept as (
    select nth, string_agg(x, ' ' order by i) t from words anti join dropped using (nth, i) group by nth),
  listed as (
    select nth, count(*) n_runs,
      string_agg(start || ',' || length || ',' || period || chr(10), '' order by start, period) t
    from runs group by nth),
  best as (
    select * from runs
    qualify row_number() over (
      partition by nth order by length::double / period desc, start, period) = 1)
  select d.doc_id, coalesce(n_runs, 0) n_runs, b.start, b.length, b.period,
    1000 * b.length // b.period exponent_milli,
    sha256(coalesce(listed.t, '')) runs_sha256, sha256(coalesce(kept.t, '')) collapsed_sha256
  from named d left join listed using (nth) left join best b using (nth) left join kept using (nth)""",
    "op13_clusters": clusters_sql(k=40, rounds=5),
    "op7_near_duplicates": r"""
  with recursive words as (
    select doc_id, regexp_extract_all(
             translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x20\x09-\x0D]+') w
    from documents),
  shingles as (
    select distinct doc_id, unnest(case when len(w) = 1 then w
      else [w[i] || ' ' || w[i + 1] for i in range(1, len(w))] end) s
    from words where len(w) > 0),
  sizes as (select doc_id, count(*) n from shingles group by doc_id),
  common as (
    select a.doc_id u, b.doc_id v, count(*) c
    from shingles a join shingles b on a.s = b.s and a.doc_id < b.doc_id group by all),
  links as (
    select u, v from common join sizes x on x.doc_id = u join sizes y on y.doc_id = v
    where 100 * c >= 80 * (x.n + y.n - c)),
  ways as (select u, v from links union all select v, u from links),
  reach(a, b) as (
    select doc_id, doc_id from documents
    union
    select a, v from reach join ways on b = u)
  select d.doc_id, coalesce(max(n), 0)::bigint n_shingles, min(b) component_id,
         d.doc_id = min(b) kept
  from documents d join reach on a = d.doc_id left join sizes s on s.doc_id = d.doc_id
  group by d.doc_id""",
}
