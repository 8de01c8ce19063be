"""Language identification, words first, then shorter and shorter n-grams.

A word known from training scores the log of its frequency in each language. An
unseen word is scored by its 4-grams; those that are unseen too by their
3-grams, and so on down to single letters. The language with the largest sum
wins.

The model is learned from a bounded sample of labelled texts: at most `TEXTS`
different texts of each label, chosen by a hash of the text. Of those the most
frequent words and n-grams of every label are kept, with their counts in all
labels. So the model grows with the labels, of which none is left out, and not
with the corpus. Every row is predicted.
"""

from __future__ import annotations

import math
import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from guestlens.llm.tables import ship, stored
from guestlens.operators.rows import lookup

LETTERS = regex.compile(r"\p{L}+")
LONGEST = 4

#: Bounds of the training sample and of the model, per label.
TEXTS, WORDS, GRAMS = 400, 4_000, 4_000
#: A label's texts are first cut down in so many parts, so that they never meet.
PARTS = 64
#: Added to every count; what an n-gram loses per letter it is shorter.
SMOOTH, BACKOFF = 0.5, math.log(0.4)
#: Words whose scores a worker remembers, and numbers in all these scores.
REMEMBERED, SCORES = 300_000, 1 << 24
#: Numbers of a table of grams and languages that is held in full.
FULL = 1 << 20


class Table:
    """Log frequencies of grams per language. Only counts above zero are stored;
    a language that does not have a gram has the same value for all of those."""

    def __init__(self, grams: list[str], languages: np.ndarray, counts: np.ndarray, n_languages: int):
        names, place = np.unique(np.array(grams, object), return_inverse=True) if grams else ([], np.zeros(0, np.int64))
        self.number = {gram: k for k, gram in enumerate(names)}
        order = np.lexsort((languages, place))
        self.starts = np.searchsorted(place[order], np.arange(len(names) + 1))
        self.languages = languages[order]
        total = np.bincount(languages, counts, n_languages) + SMOOTH * (len(names) + 1)
        self.logs = np.log((counts[order] + SMOOTH) / total[self.languages])
        self.absent = np.log(SMOOTH / total)
        # All rows at once where that is small, so that none is built per use.
        self.rows = None
        if len(names) * n_languages <= FULL:
            self.rows = np.tile(self.absent, (len(names), 1))
            self.rows[place, languages] = np.log((counts + SMOOTH) / total[languages])

    def get(self, gram: str) -> np.ndarray | None:
        k = self.number.get(gram)
        if k is None:
            return None
        if self.rows is not None:
            return self.rows[k]
        own = slice(self.starts[k], self.starts[k + 1])
        row = self.absent.copy()
        row[self.languages[own]] = self.logs[own]
        return row


@dataclass
class Model:
    """Log frequencies per language, in the order of `languages`."""

    languages: list[str]
    words: Table
    grams: list[Table]  # by length, from 1
    name: str = field(default_factory=lambda: uuid.uuid4().hex)

    @staticmethod
    def of(counts: list[tuple[str, int, str, int]]) -> Model:
        """From (language, kind, gram, count), each gram once; kind 0 is words, n is n-grams."""
        languages = sorted({c[0] for c in counts})
        place = {name: i for i, name in enumerate(languages)}
        tables = []
        for kind in range(LONGEST + 1):
            own = [c for c in counts if c[1] == kind]
            numbers = np.array([place[c[0]] for c in own], np.int64), np.array([c[3] for c in own], np.float64)
            tables.append(Table([c[2] for c in own], *numbers, len(languages)))
        return Model(languages, tables[0], tables[1:])

    def score(self, word: str) -> np.ndarray:
        known = self.words.get(word)
        if known is not None:
            return known
        marked = f" {word} "
        total, n = np.zeros(len(self.languages)), 0
        for i in range(len(marked) - 1):
            for size in range(min(LONGEST, len(marked) - i), 0, -1):
                row = self.grams[size - 1].get(marked[i : i + size])
                if row is not None:
                    total += row + BACKOFF * (LONGEST - size)
                    n += 1
                    break
        return total / n if n else total


def grams_of(word: str) -> Iterator[tuple[int, str]]:
    marked = f" {word} "
    for size in range(1, LONGEST + 1):
        for i in range(len(marked) - size + 1):
            yield size, marked[i : i + size]


def train(docs: DataFrame) -> Model:
    """Learn from text and lang; rows where either is null teach nothing."""
    ship(docs.sparkSession)
    rows = docs.select("lang", "text").where("lang is not null and text is not null and text != ''")
    rows = rows.withColumn("place", F.xxhash64("text"))
    # The TEXTS-th smallest hash of each label; equal texts count once.
    smallest = rows.select("lang", "place", F.pmod("place", F.lit(PARTS)).alias("part")).distinct()
    for parts in (["lang", "part"], ["lang"]):
        order = Window.partitionBy(*parts).orderBy("place")
        smallest = smallest.withColumn("n", F.row_number().over(order)).where(F.col("n") <= TEXTS)
    # Stored, so that its size is known: a row per label is broadcast if it is small.
    cuts = stored(smallest.groupBy("lang").agg(F.max("place").alias("cut")), "language-cuts")
    sample = lookup(rows, cuts, "lang", row_id="place").where("place <= cut")
    sample = sample.dropDuplicates(["lang", "place"]).select("lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tally: Counter = Counter()
            for name, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                for word, n in Counter(LETTERS.findall(text.lower())).items():
                    tally[name, 0, word] += n
                    for size, gram in grams_of(word):
                        tally[name, size, gram] += n
            yield pa.RecordBatch.from_pylist([{"lang": a, "kind": b, "gram": c, "n": n} for (a, b, c), n in tally.items()] or [], schema=kinds)

    kinds = pa.schema([("lang", pa.string()), ("kind", pa.int32()), ("gram", pa.string()), ("n", pa.int64())])
    counts = sample.mapInArrow(count, "lang string, kind int, gram string, n long").groupBy("lang", "kind", "gram").agg(F.sum("n").alias("n"))
    counts = stored(counts, "language-counts")
    best = Window.partitionBy("lang", "kind").orderBy(F.desc("n"), "gram")
    chosen = counts.withColumn("place", F.row_number().over(best))
    chosen = chosen.where(F.col("place") <= F.when(F.col("kind") == 0, WORDS).otherwise(GRAMS))
    kept = counts.join(chosen.select("kind", "gram").distinct(), ["kind", "gram"], "left_semi")
    found = kept.select("lang", "kind", "gram", "n").toArrow()
    return Model.of(list(zip(*(found[c].to_pylist() for c in ("lang", "kind", "gram", "n")))))


class _Scorer:
    """Scores of words, remembered by number so that numpy can add them up."""

    def __init__(self, model: Model):
        self.model = model
        self.clear()

    def clear(self) -> None:
        self.number: dict[str, int] = {}
        self.rows = np.zeros((1024, len(self.model.languages)))

    def _row(self, word: str) -> int:
        k = self.number.get(word)
        if k is None:
            k = self.number[word] = len(self.number)
            if k >= len(self.rows):
                self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])
            self.rows[k] = self.model.score(word)
        return k

    def predict(self, text: str | None) -> tuple[str, float]:
        words = LETTERS.findall((text or "").lower())
        if not words or not self.model.languages:
            return "und", 0.0
        if len(self.number) > min(REMEMBERED, SCORES // len(self.model.languages)):
            self.clear()
        total = self.rows_of(words).sum(axis=0)
        best = int(total.argmax())
        return self.model.languages[best], float(1 / np.exp(total - total[best]).sum())

    def rows_of(self, words: list[str]) -> np.ndarray:
        places = [self._row(w) for w in words]
        return self.rows[places]


_scorers: dict[str, _Scorer] = {}


def scorer_of(model: Model) -> _Scorer:
    """The worker's scorer for this model; only the latest is kept."""
    if model.name not in _scorers:
        _scorers.clear()
        _scorers[model.name] = _Scorer(model)
    return _scorers[model.name]


def predicted(docs: DataFrame, model: Model, columns: list[str]) -> DataFrame:
    """The named columns with lang_pred and score, from text alone.

    score is the share of the winner in the likelihoods of the learned
    languages, from 0 to 1. Defined cases: `und` with score 0 if the text is null
    or has no letter, or if nothing was learned; of languages that tie, the first
    by code point; repeated rows are predicted alike; no rows give no rows.
    """
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(model)  # bounded by WORDS and GRAMS per label
    rows = docs.select(*columns, F.col("text").alias("text_to_predict"))
    schema = rows.schema[: len(columns)]

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = scorer_of(shared.value)
        for batch in batches:
            found = [scorer.predict(t.as_py()) for t in batch.column("text_to_predict")]
            kept = [batch.column(i) for i in range(len(columns))]
            names, scores = [f[0] for f in found], [f[1] for f in found]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=[*columns, "lang_pred", "score"]
            )

    return rows.mapInArrow(predict, schema.add("lang_pred", "string").add("score", "double"))
