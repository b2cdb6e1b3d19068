"""Personal data in whole texts, by expressions that run in the JVM.

Regular expressions propose spans; checksums and ranges confirm them (Luhn for cards, mod 97
for IBANs, parts of an address up to 255, numbers of digits); words in the 40 characters
before a span raise its score.  A span counts when its score reaches ``threshold``.  The base
kinds (email, ip, card, phone) that pass their check always count; IBANs need their
checksum; telephone and social security numbers in national forms need a context word.

Offsets are code points, the end exclusive.  Per kind, spans are leftmost and do not overlap.
The patterns are possessive where the language described is the same, so a long run of
digits costs no deep recursion, and no more than linear time.

Defined cases: a null or empty text has no spans; repeated rows give repeated results;
other columns are not carried; an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LOCAL = r"[A-Za-z0-9._%+-]"


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    check: str  # SQL over m, the matched text, and digits, its digits
    score: float  # of a confirmed span without context
    context: str  # words that raise the score by 0.4


LUHN = """aggregate(sequence(1, greatest(1, length(digits))), 0, (acc, i) ->
  acc + int(case when (length(digits) - i) % 2 = 0 then substr(digits, i, 1)
            else translate(substr(digits, i, 1), '0123456789', '0246813579') end)) % 10 = 0"""
MOD97 = """aggregate(sequence(1, length(m)), 0, (acc, i) ->
  case when substr(rotated, i, 1) = '' then acc
       when substr(rotated, i, 1) rlike '[0-9]'
            then (acc * 10 + ascii(substr(rotated, i, 1)) - 48) % 97
       else (acc * 100 + ascii(substr(rotated, i, 1)) - 55) % 97 end) = 1"""
PART = "0*(?:[0-9]{1,2}|1[0-9][0-9]|2[0-4][0-9]|25[0-5])"

BASE = (
    Kind(
        "email",
        rf"(?:\G|(?<!{LOCAL})){LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        "true",
        0.9,
        "mail|contact|write",
    ),
    Kind(
        "ip",
        r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
        rf"m rlike '^{PART}(?:[.]{PART}){{3}}$'",
        0.7,
        "ip|host|server|address",
    ),
    Kind(
        "card",
        r"[0-9](?:[ -]?+[0-9]){13,}+",
        f"length(digits) <= 19 and {LUHN}",
        0.8,
        "card|visa|credit|payment",
    ),
    Kind(
        "phone",
        r"\+[0-9][ ().0-9-]+[0-9]",
        "length(digits) between 10 and 15",
        0.7,
        "phone|call|tel|fax|mobile",
    ),
)
MORE = (
    Kind(
        "iban",
        r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}(?![A-Za-z0-9])",
        f"length(regexp_replace(m, ' ', '')) between 15 and 34 and {MOD97}",
        0.9,
        "iban|account|konto|compte|cuenta",
    ),
    Kind(
        "national_phone",
        r"(?<![0-9+])(?<!\+[0-9] )\(?[0-9]{3}\)?[ .-][0-9]{3}[.-][0-9]{4}(?![0-9])",
        "true",
        0.3,
        "phone|call|tel|fax|mobile",
    ),
    Kind(
        "ssn",
        r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
        "m not rlike '^(000|666|9)' and m not rlike '-00-' and m not rlike '0000$'",
        0.3,
        "ssn|social security",
    ),
)


RUN = 256
CONTEXT = 40
PIECES = "array<struct<g:string,m:string>>"
MATCH = "struct<start:int,end:int,m:string,before:string>"


def _quoted(text: str) -> str:
    return "r'" + text.replace("'", "\\'") + "'"


def _found(kind: Kind, order: int) -> str:
    """SQL: array of (start, rank, end, kind, m, digits, context) of the checked matches.

    The gaps between matches and the matches alternate, so their lengths add up to places:
    first over runs of them, then within each run, as every step copies what it adds to.
    """
    p = _quoted(kind.pattern)
    # The last characters before a match go along; to cut them out of the text by place would
    # take as long as the text up to there.
    tail = "right(concat({}, {}), %d)" % CONTEXT
    pieces = f"zip_with(split(text, {p}, -1), regexp_extract_all(text, {p}, 0), (g, m) -> (g, m))"
    placed = f"""transform(array({pieces}), p -> flatten(transform(
        aggregate(
            transform(sequence(0, (size(p) - 1) div {RUN}), c -> slice(p, c * {RUN} + 1, {RUN})),
            (cast(array() as array<struct<at:int,tail:string,own:{PIECES}>>) as done,
             0 as at, '' as tail),
            (acc, own) -> (
                concat(acc.done, array((acc.at as at, acc.tail as tail, own as own))) as done,
                acc.at + aggregate(own, 0, (n, x) -> n + length(x.g) + ifnull(length(x.m), 0))
                    as at,
                aggregate(own, acc.tail, (t, x) -> {tail.format("t", "concat(x.g, ifnull(x.m, ''))")})
                    as tail),
            acc -> acc.done),
        part -> aggregate(part.own,
            (cast(array() as array<{MATCH}>) as spans, part.at as at, part.tail as tail),
            (acc, x) -> if(x.m is null, acc, (
                concat(acc.spans, array((
                    acc.at + length(x.g) as start,
                    acc.at + length(x.g) + length(x.m) as end, x.m as m,
                    {tail.format("acc.tail", "x.g")} as before))) as spans,
                acc.at + length(x.g) + length(x.m) as at,
                {tail.format("acc.tail", "concat(x.g, x.m)")} as tail)),
            acc -> acc.spans))))[0]"""
    full = f"""transform({placed}, s -> (
        s.start, {order} as rank, s.end, '{kind.name}' as kind, s.m as m,
        regexp_replace(s.m, '[^0-9]', '') as digits,
        concat(substr(regexp_replace(s.m, ' ', ''), 5), substr(s.m, 1, 4)) as rotated,
        lower(s.before) as before))"""
    check = kind.check
    for name in ("digits", "rotated", "m"):
        check = _bound(check, name)
    scored = f"""transform(filter({full}, s -> {check}), s -> (
        s.start, s.rank, s.end, s.kind, s.m as value,
        {kind.score}D + if(s.before rlike {_quoted(f"(?<![a-z])(?:{kind.context})")},
                           least(0.4D, 1 - {kind.score}D), 0D) as score))"""
    return f"if(text rlike {p}, {scored}, {EMPTY})"


def _bound(sql: str, name: str) -> str:
    import re

    return re.sub(rf"(?<![\w.']){name}(?![\w'(])", f"s.{name}", sql)


SPAN = "struct<start:int,rank:int,end:int,kind:string,value:string,score:double>"
EMPTY = f"cast(array() as array<{SPAN}>)"


def find(docs: DataFrame, threshold: float = 0.6) -> DataFrame:
    """(doc_id, base, more): spans of the base kinds and those the method adds, each an
    array of (start, rank, end, kind, value, score) in order of start and kind."""
    text = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    base = [_found(k, i) for i, k in enumerate(BASE)]
    more = [_found(k, len(BASE) + i) for i, k in enumerate(MORE)]
    found = text.selectExpr(
        "doc_id",
        f"array_sort(concat({', '.join(base)})) as base",
        f"filter(array_sort(concat({', '.join(more)})), s -> s.score >= {threshold}D) as added",
    )
    free = "not exists(base, b -> b.start < s.end and s.start < b.end)"
    return found.selectExpr("doc_id", "base", f"filter(added, s -> {free}) as more")


def _joined(spans: str) -> Column:
    return F.expr(
        f"array_join(transform({spans}, s -> concat_ws(':', s.kind, s.start, s.end)), ',')"
    )


def digest(found: DataFrame) -> DataFrame:
    """Counts by base kind, the hash of the base spans, and all spans as text."""
    counts = [
        F.expr(f"cast(size(filter(base, s -> s.kind = '{k.name}')) as bigint)").alias(
            f"n_{k.name}"
        )
        for k in BASE
    ]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(_joined("base").cast("binary"), 256).alias("base_sha256"),
        _joined("array_sort(concat(base, more))").alias("spans"),
    )
