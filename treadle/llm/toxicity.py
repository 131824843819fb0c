"""Toxicity from a weighted lexicon, matched by Aho-Corasick in folded texts.

Folding lower-cases, replaces look-alike letters and the digits used for letters, drops invisible
characters and turns the rest of ASCII into blanks.  The lexicon holds whole words and word starts;
their weights are log odds between toxic and other documents of a labelled sample.  A place counts
its heaviest term only, and nothing where an exception phrase covers it.  The score is a logistic
function of the evidence and of the evidence per word.

The sample is bounded by ``TOXIC_ROWS`` and ``OTHER_ROWS``; its texts are stored once.  A quarter of
it fits the logistic function, so terms are not judged on the rows they came from.

Defined results: a null text counts as empty; an empty text has no evidence; each input row gives
one row, also for repeated and null ids; without labelled rows of both kinds all scores are 0.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from treadle.llm.batches import id_and_text, map_texts
from treadle.session import run_folder

#: Bounds of the labelled sample the classifier is fitted on (expected rows).
TOXIC_ROWS, OTHER_ROWS = 6000, 12000
#: Most terms a lexicon may have, fewest toxic sample rows of a term, and its least weight.
MOST_TERMS, SUPPORT, LEAST_WEIGHT = 30_000, 3, 2.5
#: Lengths of word starts.
STARTS = (4, 5, 6, 7)

# Letters of other scripts that look like Latin ones, and digits written for letters.
LOOK_ALIKES = dict(zip("авеёзіјкмнорсѕтухԁһӏαβεικνορτυχοѵɡıⅼ", "abeeзijkmhopcstyxdhlabeikvoptuxovgil"))
DIGITS = dict(zip("013457@$", "oieastas"))
INVISIBLE = "​‌‍⁠﻿­"

FOLD = {**{c: " " for c in range(128) if not chr(c).isalnum()}, **{ord(c): " " for c in "2689"},
        **{ord(a): b for a, b in (LOOK_ALIKES | DIGITS).items()}, **{ord(c): None for c in INVISIBLE},
        **{0xFF41 + k: chr(97 + k) for k in range(26)}}


def fold(text: str) -> str:
    """The folded text between blanks."""
    return " " + text.lower().translate(FOLD) + " "


def terms_of(folded: str) -> set[str]:
    """Words (with both blanks) and word starts (with the blank in front)."""
    words = set(folded.split())
    out = {f" {w} " for w in words if 3 <= len(w) <= 24}
    for k in STARTS:
        out.update([f" {w[:k]}" for w in words if len(w) > k])
    return out


@dataclass
class Lexicon:
    """Terms with weights, phrases that are no offence, and the logistic function's coefficients."""
    weights: dict[str, float]
    exceptions: tuple[str, ...] = ()
    coefficients: tuple[float, ...] = (-20.0, 0.0, 0.0)
    _automaton: object = field(default=None, repr=False, compare=False)

    def __getstate__(self):
        return {**self.__dict__, "_automaton": None}

    def _ready(self):
        if self._automaton is None:
            found = ahocorasick.Automaton()
            for t, w in self.weights.items():
                found.add_word(t, (len(t), w))
            for e in self.exceptions:
                phrase = fold(e)
                found.add_word(phrase, (len(phrase), None))
            if len(found):
                found.make_automaton()
            self._automaton = found
        return self._automaton

    def evidence(self, text: str | None) -> tuple[float, int]:
        """Weight of all places, and the number of words."""
        folded = fold(text or "")
        places: dict[int, float] = {}
        spared: list[tuple[int, int]] = []
        automaton = self._ready()
        if len(automaton):
            for end, (length, weight) in automaton.iter(folded):
                start = end - length + 1
                if weight is None:
                    spared.append((start, end))
                elif weight > places.get(start, 0.0):
                    places[start] = weight
        for a, b in spared:
            for start in [s for s in places if a <= s < b]:
                del places[start]
        return sum(places.values()), folded.count(" ") - 1

    def score(self, text: str | None) -> float:
        return float(logistic(features(*self.evidence(text)) @ np.array(self.coefficients)))


def features(weight: float, words: int) -> np.ndarray:
    return np.array([1.0, math.log1p(weight), math.log1p(100 * weight / max(words, 1))])


def logistic(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.1) -> np.ndarray:
    """Newton's method with a ridge, from zero."""
    b = np.zeros(x.shape[1])
    for _ in range(40):
        p = logistic(x @ b)
        step = np.linalg.solve((x.T * (p * (1 - p))) @ x + ridge * np.eye(len(b)), x.T @ (y - p) - ridge * b)
        b += step
        if np.abs(step).max() < 1e-6:
            break
    return b


def _sample(labels: DataFrame, toxic_rows: int, other_rows: int) -> DataFrame:
    """Labelled rows by hash: all of a kind, or its bound in expectation; ``part`` 0 fits the function."""
    counts = {r["toxic"]: r["n"] for r in labels.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    share = {k: min(1.0, most / counts[k]) for k, most in ((1, toxic_rows), (0, other_rows)) if counts.get(k)}
    draw = F.pmod(F.xxhash64("id"), F.lit(1 << 20)) / float(1 << 20)
    return labels.where(draw < F.when(F.col("toxic") == 1, share.get(1, 0.0)).otherwise(share.get(0, 0.0))).select(
        "id", "toxic", F.pmod(F.xxhash64("id", F.lit("part")), F.lit(4)).alias("part"))


def learn(spark: SparkSession, docs: DataFrame, labels: DataFrame, exceptions: tuple[str, ...] = (),
          toxic_rows: int = TOXIC_ROWS, other_rows: int = OTHER_ROWS, id_column: str = "doc_id",
          text_column: str = "text", label_column: str = "toxic") -> Lexicon:
    """Learn from a bounded sample of the ids of ``labels`` (0 or 1) that have a document.

    An id that is labelled both ways is toxic.
    """
    known = labels.select(F.col(id_column).alias("id"), F.col(label_column).alias("toxic")).where(
        "id is not null and toxic in (0, 1)").groupBy("id").agg(F.max("toxic").alias("toxic"))
    sample = _sample(known, toxic_rows, other_rows)
    folder = run_folder(spark, "toxicity")
    # the sample's ids are bounded by the two parameters, so they may go to every task
    id_and_text(docs, id_column, text_column).join(F.broadcast(sample), "id").write.parquet(folder)
    stored = spark.read.parquet(folder)
    sizes = {(r["toxic"], r["part"] == 0): r["n"] for r in
             stored.groupBy("toxic", "part").agg(F.count("*").alias("n")).collect()}
    totals = {k: sum(r["n"] for r in stored.where("part <> 0").groupBy("toxic").agg(F.count("*").alias("n")).collect()
                     if r["toxic"] == k) for k in (0, 1)}
    if not all(totals.values()) or len(sizes) < 4:
        return Lexicon({}, exceptions)

    def counted(rows: DataFrame) -> DataFrame:
        def make():
            def run(records):
                seen: Counter = Counter()
                for (text,) in records:
                    seen.update(terms_of(fold(text or "")))
                return seen.items()
            return run
        return map_texts(rows.select("text"), make, "term string, n long").groupBy("term").agg(F.sum("n").alias("n"))

    toxic = counted(stored.where("part <> 0 and toxic = 1")).where(F.col("n") >= SUPPORT)
    other = counted(stored.where("part <> 0 and toxic = 0")).withColumnRenamed("n", "others")
    weight = F.log((F.col("n") + 0.5) / (totals[1] + 1)) - F.log((F.coalesce("others", F.lit(0)) + 0.5) / (totals[0] + 1))
    weighed = toxic.join(other, "term", "left").select("term", "n", weight.alias("weight")).where(F.col("weight") >= LEAST_WEIGHT)
    heaviest = weighed.orderBy(F.desc("weight"), F.desc("n"), "term").limit(MOST_TERMS)
    weights = {r["term"]: r["weight"] for r in heaviest.collect()}
    lexicon = Lexicon(weights, exceptions)
    rows = weigh(stored.where("part = 0").select("toxic", "text"), lexicon, "toxic", "text").collect()
    x = np.array([features(r["weight"], r["words"]) for r in rows])
    y = np.array([r["id"] for r in rows], dtype=float)
    lexicon.coefficients = tuple(fit_logistic(x, y))
    return lexicon


def weigh(docs: DataFrame, lexicon: Lexicon, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``id``, ``weight``, ``words`` and ``score`` of each row."""
    def make():
        def run(records):
            for i, text in records:
                weight, words = lexicon.evidence(text)
                yield i, weight, words, float(logistic(features(weight, words) @ np.array(lexicon.coefficients)))
        return run
    rows = id_and_text(docs, id_column, text_column)
    return map_texts(rows, make, f"id {rows.schema['id'].dataType.simpleString()}, weight double, words long, score double")


def scored(text: Column, lexicon: Lexicon) -> Column:
    """The score of a text column."""
    @F.pandas_udf("double")
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(lexicon.score).astype("float64")
    return run(F.coalesce(text, F.lit("")))
