"""Text classification by supervised subword embeddings.

A text's features are its words, the character n-grams of each word and the breaks beside it, and its pairs of
neighbouring words (pairs a text has already had count as one of their own), all hashed into one table of
learned vectors.  The average of a text's vectors goes
through a softmax over the two labels; vectors and softmax are trained together by stochastic gradient
descent in numpy, a text at a time, with a falling rate.

The softmax is linear in the average, so for scoring each vector is reduced to its part of the margin
between the labels, a number per bucket.  Features are hashed by numpy over all characters of a text at
once, so no table of words is kept; texts are scored whole, where they lie, without a shuffle.

The classifier is fitted on a bounded sample of labelled texts: ``LOW_ROWS`` and ``HIGH_ROWS`` (expected)
of the two labels, and of these as many, by hash, as have ``SAMPLE_BYTES`` of features.  The margin is
corrected for the shares that the labels have among all labelled rows.

Defined results: a null text counts as empty; an empty text has the margin of the labels' shares; each row
gives one row, also for repeated and null ids; an id labelled both ways counts as label 0; of several texts
with one id the least teaches; without labelled texts of both kinds all scores are the share of label 1 (one half without
labels); an empty table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from treadle.llm.batches import id_and_text, map_texts
from treadle.session import run_folder

#: Bounds of the labelled sample: expected rows of the labels 0 and 1, and bytes of their features.
LOW_ROWS, HIGH_ROWS, SAMPLE_BYTES = 2000, 3000, 96 << 20
#: Rows of the vector table, their length, and the lengths of character n-grams.
BUCKETS, WIDTH, GRAMS = 1 << 17, 16, (3, 4, 5)
#: The bucket of all pairs of words that a text has already had.
REPEATED = 1
BREAK = re.compile(r"[\x20\x09-\x0D]")
EPOCHS, RATE = 5, 0.5
#: Characters whose features are found together; texts are cut between words.
SEGMENT = 1 << 20
_own = np.random.default_rng(11)
#: Odd multipliers: of the characters of an n-gram, and of a word by their place in it.
GRAM_FACTORS = {n: _own.integers(1 << 31, size=n, dtype=np.uint32) * np.uint32(2) + np.uint32(1) for n in GRAMS}
WORD_FACTORS = _own.integers(1 << 63, size=64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mixed(h: np.ndarray) -> np.ndarray:
    """Buckets of 32-bit hashes."""
    h = (h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
    return (h ^ (h >> np.uint32(12))) & np.uint32(BUCKETS - 1)


def _segments(text: str) -> Iterator[str]:
    start = 0
    while len(text) - start > SEGMENT:
        found = BREAK.search(text, start + SEGMENT)
        if found is None:
            break
        yield text[start:found.start()]
        start = found.start()
    yield text[start:]


def _of_segment(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all n-grams, and hashes of the words in order."""
    points = np.frombuffer(f" {text} ".encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    space = (points == 32) | ((points >= 9) & (points <= 13))
    points = np.where(space, np.uint32(32), points)
    buckets = []
    for n in GRAMS:
        size = len(points) - n + 1
        if size <= 0:
            continue
        inside = ~space[1:size + 1]  # an n-gram may begin and end with a break, and has none within
        for k in range(2, n - 1):
            inside &= ~space[k:k + size]
        at = np.flatnonzero(inside)
        h = np.full(len(at), n, dtype=np.uint32)
        for k, factor in enumerate(GRAM_FACTORS[n]):
            h += points[at + k] * factor
        buckets.append(mixed(h))
    at = np.flatnonzero(~space)
    if not len(at):
        return np.concatenate(buckets) if buckets else np.zeros(0, np.uint32), np.zeros(0, np.uint64)
    first = np.flatnonzero(space[at - 1])  # of each word, among the characters
    place = np.arange(len(at)) - np.repeat(first, np.diff(np.append(first, len(at))))
    words = np.add.reduceat(points[at].astype(np.uint64) * WORD_FACTORS[place & 63], first)
    return np.concatenate(buckets), words ^ (words >> np.uint64(29))


def features(text: str | None) -> Iterator[np.ndarray]:
    """Buckets of all features of a text, with repeats: n-grams by segment, then words and pairs."""
    words = []
    for segment in _segments(text or ""):
        grams, own = _of_segment(segment)
        words.append(own)
        yield grams
    words = np.concatenate(words)
    yield mixed((words >> np.uint64(32)).astype(np.uint32))
    pairs = (words[:-1] * np.uint64(0x9E3779B97F4A7C15) ^ words[1:]) * np.uint64(0xC2B2AE3D27D4EB4F)
    out = np.full(len(pairs), REPEATED, dtype=np.uint32)
    first = np.unique(pairs, return_index=True)[1]
    out[first] = mixed((pairs[first] >> np.uint64(32)).astype(np.uint32))
    yield out


def text_features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of a text and their shares of its features."""
    counts = np.zeros(BUCKETS)
    for part in features(text):
        counts += np.bincount(part, minlength=BUCKETS)
    buckets = np.flatnonzero(counts)
    return buckets.astype(np.int32), (counts[buckets] / max(counts.sum(), 1)).astype(np.float32)


def margin(text: str | None, margins: np.ndarray) -> float:
    """The average part of the margin over all features of a text."""
    total, n = 0.0, 0
    for part in features(text):
        total += float(margins[part].sum(dtype=np.float64))
        n += len(part)
    return total / n if n else 0.0


def train(samples: list[tuple[np.ndarray, np.ndarray, int]], epochs: int = EPOCHS, rate: float = RATE,
          seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """Vectors and output weights from (buckets, shares, label) of each text."""
    own = np.random.default_rng(seed)
    vectors = own.uniform(-1 / WIDTH, 1 / WIDTH, (BUCKETS, WIDTH)).astype(np.float32)
    out = np.zeros((WIDTH, 2), dtype=np.float32)
    steps, done = epochs * len(samples), 0
    for _ in range(epochs):
        for k in own.permutation(len(samples)):
            buckets, shares, label = samples[k]
            now = rate * (1 - done / steps)
            done += 1
            if not len(buckets):
                continue
            hidden = shares @ vectors[buckets]
            z = hidden @ out
            error = np.exp(z - z.max())
            error /= error.sum()
            error[label] -= 1
            back = out @ error
            out -= now * np.outer(hidden, error)
            # steps are scaled by the text's length, else those of long texts would vanish in the average
            vectors[buckets] -= (now * np.minimum(1.0, shares * len(buckets)))[:, None] * back
    return vectors, out


@dataclass(frozen=True)
class Classifier:
    """Parts of the margin by bucket, and the log odds of label 1 that the margin starts from."""
    margins: np.ndarray
    start: float

    def score(self, text: str | None) -> float:
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, self.start + margin(text, self.margins)))))


def _odds(low: int, high: int) -> float:
    return math.log((high + 0.5) / (low + 0.5))


def learn(spark: SparkSession, docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text",
          label_column: str = "quality", low_rows: int = LOW_ROWS, high_rows: int = HIGH_ROWS,
          sample_bytes: int = SAMPLE_BYTES) -> Classifier:
    """Fit on a bounded sample of the ids of ``labels`` (0 or 1) that have a text."""
    known = labels.select(F.col(id_column).alias("id"), F.col(label_column).alias("label")).where(
        "id is not null and label in (0, 1)").groupBy("id").agg(F.min("label").cast("int").alias("label"))
    counts = {r.label: r.n for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    low, high = counts.get(0, 0), counts.get(1, 0)
    if not (low and high):
        return Classifier(np.zeros(BUCKETS, dtype=np.float32), _odds(low, high))
    draw = (F.pmod(F.xxhash64("id"), F.lit(1 << 20)) / float(1 << 20)).alias("draw")
    share = F.when(F.col("label") == 0, min(1.0, low_rows / low)).otherwise(min(1.0, high_rows / high))
    sample = known.select("id", "label", draw).where(F.col("draw") < share).select("id", "label", (F.col("draw") / share).alias("draw"))
    # the sample's ids are bounded by the two parameters, so they may go to every task
    texts = id_and_text(docs, id_column, text_column).join(F.broadcast(sample), "id").groupBy("id", "label", "draw").agg(
        F.min(F.coalesce("text", F.lit(""))).alias("text"))

    def make():
        def run(records):
            for label, place, text in records:
                buckets, shares = text_features(text)
                yield label, place, buckets.tobytes(), shares.tobytes()
        return run

    folder = run_folder(spark, "subwords")
    map_texts(texts.select("label", "draw", "text"), make, "label int, draw double, buckets binary, shares binary").write.parquet(folder)
    stored = spark.read.parquet(folder).withColumn("size", F.length("buckets") + F.length("shares"))
    size = stored.agg(F.sum("size")).first()[0] or 0
    taken = stored.where(F.col("draw") <= min(1.0, sample_bytes / max(size, 1))).orderBy("label", "draw").collect()
    samples = [(np.frombuffer(r.buckets, dtype=np.int32), np.frombuffer(r.shares, dtype=np.float32), r.label) for r in taken]
    own = [sum(s[2] == k for s in samples) for k in (0, 1)]
    if not all(own):
        return Classifier(np.zeros(BUCKETS, dtype=np.float32), _odds(low, high))
    vectors, out = train(samples)
    return Classifier(vectors @ (out[:, 1] - out[:, 0]), _odds(low, high) - _odds(*own))


def score(docs: DataFrame, classifier: Classifier, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``id`` and ``score`` (of label 1) of each row."""
    def make():
        return lambda records: ((i, classifier.score(text)) for i, text in records)
    rows = id_and_text(docs, id_column, text_column)
    return map_texts(rows, make, f"id {rows.schema['id'].dataType.simpleString()}, score double")


def scored(text: Column, classifier: Classifier) -> Column:
    """The score of a text column."""
    @F.pandas_udf("double")
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(classifier.score).astype("float64")
    return run(F.coalesce(text, F.lit("")))
