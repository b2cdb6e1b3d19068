"""Language of whole texts: first the family, then the language within it.

Features are the byte n-grams (1 to 4) of words between blanks, A-Z lowered, everything else
of ASCII but letters taken as blank, hashed to 2**13 places.  Families are learned: languages
are merged by the likeness of their mean features until there are about as many families as
their square root.  Linear support vector machines (squared hinge) tell each family
from the rest and, within a family, each language from each other one; the most
wins count, then the margins.

All of it is linear in the n-grams' shares, so what a word adds to every margin is computed
once per word and remembered; a text costs a look-up per word.

The model is fitted on a bounded sample of different texts, those of the lowest hashes of every
language, as many of each; prediction reads whole texts of all rows.  All languages are
learned, a few texts of each if there are many; the model then grows with their number to
the power of 1.5 (40 MB at 200).

Defined cases: a null text or one without a letter is "und" with score 0; without
anything to learn from every text is "und"; null doc_id counts as held out by no rule and is
not learned from; rows repeat with equal results; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakestrata.llm.common import MEMO_ENTRIES, chunks, map_in_arrow, mix64, texts_of
from lakestrata.session import materialize

UNKNOWN = "und"
BUCKETS = 1 << 13
GRAMS = (1, 2, 3, 4)
MEMO_MARGINS = 2_000  # with more of them, words are not remembered
CLEAN = bytes(
    c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)
ASCII_LETTER = re.compile(rb"[A-Za-z]")


def has_letter(text: bytes) -> bool:
    return bool(ASCII_LETTER.search(text)) or any(map(str.isalpha, text.decode("utf-8")))


def gram_places(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Feature places of the words' n-grams, word by word, and how many each word has."""
    joined = np.frombuffer(b" " + b" ".join(words) + b" ", np.uint8)
    blank = joined == 32
    index = np.cumsum(blank) - 1  # of the word a byte is in, or the blank before it
    places, owners = [], []
    for n in GRAMS:
        count = len(joined) - n + 1
        if count <= 0:
            continue
        code = np.zeros(count, np.uint64)
        inside = np.zeros(count, np.int64)
        for k in range(n):
            code = code * np.uint64(257) + joined[k : k + count] + np.uint64(1)
            if 0 < k < n - 1:
                inside += blank[k : k + count]
        ok = inside == 0
        ok &= ~(blank[:count] & blank[n - 1 : n - 1 + count])
        places.append((mix64(code[ok] + np.uint64(n)) % np.uint64(BUCKETS)).astype(np.int64))
        owners.append(index[:count][ok])
    owner = np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    return np.concatenate(places)[order], np.bincount(owner, minlength=len(words))[: len(words)]


def features(text: bytes) -> np.ndarray:
    """Shares of the text's n-grams."""
    words = text.translate(CLEAN).split()
    if not words:
        return np.zeros(BUCKETS, np.float32)
    places, _ = gram_places(words)
    return (np.bincount(places, minlength=BUCKETS) / len(places)).astype(np.float32)


def svm(x: np.ndarray, y: np.ndarray, penalty: float = 1e-4, steps: int = 150) -> np.ndarray:
    """Weights, bias last, of a linear machine with squared hinge loss; y is 1 or -1.  Both
    sides weigh alike.  Accelerated gradient steps from a Lipschitz bound."""
    y = y.astype(np.float32)
    share = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum()))
    share = share.astype(np.float32)
    margins = lambda w: x @ w[:-1] + w[-1]
    back = lambda r: np.append(r @ x, r.sum())
    probe = np.ones(x.shape[1] + 1, np.float32)
    for _ in range(20):
        probe = back(share * margins(probe))
        top = np.linalg.norm(probe)
        probe /= max(top, 1e-12)
    rate = 1 / (2.2 * top + penalty)
    w = last = np.zeros(x.shape[1] + 1, np.float32)
    for t in range(steps):
        ahead = (w + t / (t + 3) * (w - last)).astype(np.float32)
        loss = np.maximum(0, 1 - y * margins(ahead))
        grad = penalty * ahead - 2 * back(share * loss * y)
        last, w = w, (ahead - rate * grad).astype(np.float32)
    return w


@dataclass(frozen=True)
class Model:
    languages: list[str]
    families: list[list[int]]  # indexes of languages
    pairs: list[tuple[int, int]]  # within families
    weights: np.ndarray  # BUCKETS x (families + pairs)
    bias: np.ndarray


def families_of(means: np.ndarray) -> list[list[int]]:
    """Average linkage on the cosine of mean features, to the square root of their number."""
    unit = means / np.maximum(np.linalg.norm(means, axis=1, keepdims=True), 1e-12)
    groups = [[i] for i in range(len(means))]
    total = (unit @ unit.T).astype(np.float64)  # of the likenesses between two groups' members
    while len(groups) > max(1, round(len(means) ** 0.5)):
        sizes = np.array([len(g) for g in groups], np.float64)
        mean = total / sizes / sizes[:, None]
        mean[np.tril_indices(len(groups))] = -np.inf
        i, j = divmod(int(mean.argmax()), len(groups))
        groups[i] = sorted(groups[i] + groups.pop(j))
        total[i] += total[j]
        total[:, i] += total[:, j]
        total = np.delete(np.delete(total, j, 0), j, 1)
    return groups


def fit(texts: list[bytes], langs: list[str]) -> Model:
    languages = sorted(set(langs))
    index = {lang: i for i, lang in enumerate(languages)}
    y = np.array([index[x] for x in langs], np.int64)
    x = np.zeros((len(texts), BUCKETS), np.float32)
    for row, text in zip(x, texts, strict=True):
        row[:] = features(text)
    scale = 1 / np.sqrt(x.mean(axis=0) + 1e-5) if len(x) else np.ones(BUCKETS, np.float32)
    x *= scale
    means = np.array([x[y == i].mean(axis=0) for i in range(len(languages))])
    families = families_of(means) if languages else []
    columns, pairs = [], []
    for group in families:
        side = np.where(np.isin(y, group), 1.0, -1.0)
        columns.append(svm(x, side) if len(families) > 1 else np.zeros(BUCKETS + 1))
    for group in families:
        for i, a in enumerate(group):
            for b in group[i + 1 :]:
                one = (y == a) | (y == b)
                columns.append(svm(x[one], np.where(y[one] == a, 1.0, -1.0)))
                pairs.append((a, b))
    w = np.array(columns).reshape(-1, BUCKETS + 1)
    return Model(languages, families, pairs, (w[:, :-1] * scale).T.astype(np.float32), w[:, -1])


def decide(model: Model, margins: np.ndarray) -> tuple[str, float]:
    """Language and score from the margins of families and pairs: the logistic share of the
    family times the mean logistic of the winner's pairs."""
    own = np.exp(4 * (margins[: len(model.families)] - margins[: len(model.families)].max()))
    best = int(own.argmax())
    group = model.families[best]
    wins = {a: [0, 0.0, 0.0] for a in group}
    for (a, b), m in zip(model.pairs, margins[len(model.families) :], strict=True):
        if a in wins:
            p = 1 / (1 + np.exp(-4 * m))
            for lang, won, chance in ((a, m > 0, p), (b, m <= 0, 1 - p)):
                wins[lang][0] += int(won)
                wins[lang][1] += abs(m) if won else -abs(m)
                wins[lang][2] += chance
    first = max(group, key=lambda a: (wins[a][0], wins[a][1], -a))
    inner = wins[first][2] / (len(group) - 1) if len(group) > 1 else 1.0
    return model.languages[first], float(own[best] / own.sum() * inner)


class WordMargins:
    """What each word adds to every margin, and its number of n-grams."""

    def __init__(self, model: Model) -> None:
        self.model = model
        self._forget()

    def _forget(self) -> None:
        self.place: dict[bytes, int] = {}
        margins = self.model.weights.shape[1]
        first = 1 << 14 if margins <= MEMO_MARGINS else 0
        self.rows = np.zeros((first, margins + 1), np.float32)

    def _learn(self, words: list[bytes]) -> None:
        places, counts = gram_places(words)
        n = len(self.place)
        if n + len(words) > len(self.rows):
            more = np.zeros((2 * (n + len(words)), self.rows.shape[1]), np.float32)
            more[:n] = self.rows[:n]
            self.rows = more
        starts = np.cumsum(counts) - counts
        self.rows[n : n + len(words), :-1] = np.add.reduceat(
            self.model.weights[places], starts, axis=0
        )
        self.rows[n : n + len(words), -1] = counts
        self.place.update(zip(words, range(n, n + len(words)), strict=True))

    def margins(self, texts: list[bytes]) -> np.ndarray:
        if self.model.weights.shape[1] > MEMO_MARGINS:
            return np.array([features(t) @ self.model.weights + self.model.bias for t in texts])
        split = [t.translate(CLEAN).split() for t in texts]
        new = {w for words in split for w in words if w not in self.place}
        if new and len(self.place) + len(new) > MEMO_ENTRIES:
            self._forget()
            new = {w for words in split for w in words}
        if new:
            self._learn(list(new))
        out = np.zeros((len(texts), self.model.weights.shape[1]))
        for i, words in enumerate(split):
            if words:
                at = np.fromiter((self.place[w] for w in words), np.int64, len(words))
                total = self.rows[at].sum(axis=0, dtype=np.float64)
                out[i] = total[:-1] / total[-1] + self.model.bias
        return out


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))


def learn(docs: DataFrame, sample: int = 2400, least: int = 4) -> Model:
    """Fit on about ``sample`` different texts of the documents that have a language and aren't
    held out: as many of each language, ``least`` or more, or all it has."""
    known = (
        docs.where(
            "doc_id is not null and lang is not null and text rlike '[A-Za-z\\\\x{80}-\\\\x{10ffff}]'"
        )
        .where(~held_out())
        .select("lang", F.col("text").cast("string").alias("text"), F.xxhash64("text").alias("h"))
    )
    texts = materialize(known.select("lang", "h").distinct())
    counts = texts.groupBy("lang").count().collect()  # a row per language
    if not counts:
        return fit([], [])
    quota = max(least, sample // len(counts))
    # The lowest hashes of each language: some more than the quota surely lie below a bound.
    some = quota + 6 * quota**0.5 + 20
    low = {r["lang"]: int(min(1.0, some / r["count"]) * (1 << 64)) - (1 << 63) for r in counts}
    lowest: dict[str, list[int]] = {}
    for r in _below(texts, low).collect():
        lowest.setdefault(r["lang"], []).append(r["h"])
    last = {lang: sorted(hashes)[:quota][-1] for lang, hashes in lowest.items()}
    rows = _below(known, last).groupBy("lang", "h").agg(F.min("text").alias("text")).collect()
    rows.sort(key=lambda r: (r["h"], r["lang"]))
    return fit([r["text"].encode() for r in rows], [r["lang"] for r in rows])


def _below(rows: DataFrame, bounds: dict[str, int]) -> DataFrame:
    """The rows whose hash is at most their language's bound."""
    given = [(lang, min(bound, (1 << 63) - 1)) for lang, bound in sorted(bounds.items())]
    bound = rows.sparkSession.createDataFrame(given, "lang string, bound bigint")
    return rows.join(F.broadcast(bound), "lang").where("h <= bound").drop("bound")


def predict(docs: DataFrame, model: Model, *carried: str) -> DataFrame:
    """The columns ``carried``, then lang_pred and score, for every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS rows, whatever the data
    names = list(carried)
    kept = docs.select(*names, *([] if "text" in names else ["text"]))
    kept = kept.withColumn("text", F.col("text").cast("string"))
    schema = T.StructType(
        [
            *[kept.schema[c] for c in names],
            T.StructField("lang_pred", T.StringType()),
            T.StructField("score", T.DoubleType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordMargins(shared.value)
        for batch in batches:
            texts = texts_of(batch)
            for a, b in chunks(texts):
                said: list[tuple[str, float]] = []
                margins = words.margins(texts[a:b])
                for text, row in zip(texts[a:b], margins, strict=True):
                    known = words.model.languages and has_letter(text)
                    said.append(decide(words.model, row) if known else (UNKNOWN, 0.0))
                columns = [batch.column(i).slice(a, b - a) for i in range(len(names))]
                yield pa.RecordBatch.from_arrays(
                    [
                        *columns,
                        pa.array([x for x, _ in said], pa.string()),
                        pa.array([x for _, x in said], pa.float64()),
                    ],
                    names=[*names, "lang_pred", "score"],
                )

    return map_in_arrow(kept, run, schema)


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", "lang")
    rows = rows.withColumn("held_out", held_out())
    return predict(rows, learn(rows), "doc_id", "held_out")
