"""Quality classifier: ordinal cumulative-link regression.

Ratings are grades 0 < 1 < ... A document has one score, a sum of weights of
hashed text features (its distinct words, their shapes, and buckets of its
repetitions); P(grade >= g) = sigmoid(score - threshold_g), with thresholds in
order and weights shared by all grades. Result: the expected grade, and the
tail probability of reaching the best grade, by which documents are selected.

Fitted, in one task, on a sample of about ``SAMPLE_DOCS`` rated documents (at
most twice as many), chosen by a hash of doc_id. All documents are scored.

Null and empty texts have no words; buckets for that are features as well.
Ratings with a null, or of unknown documents, are ignored; of several ratings
of one document the lowest counts. Without any rating every grade is as likely.
Repeated rows are scored each for itself; an empty table gives an empty one."""

from __future__ import annotations

import re
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import map_exact

GRADES = 3
WIDTH = 1 << 16
SAMPLE_DOCS = 8000
STEPS = 150
#: Words that a task remembers.
REMEMBERED = 200_000
#: A feature has a weight only if some cut between grades splits the documents
#: that have it unlike the others, by so many standard errors.
LEAST_DOCS = 5
STANDS_OUT = 4.5

LETTERS = re.compile(r"[^\W\d_]+")


def bucket(name: str) -> int:
    return zlib.crc32(name.encode("utf-8", "replace")) % WIDTH


def word_features(word: str) -> tuple[int, int]:
    """Of the letters in lower case, and of what is left when letters are
    reduced to their case."""
    letters = "".join(LETTERS.findall(word))
    if letters == word:
        form = "A" if word.isupper() and len(word) > 1 else "a"
    else:
        form = LETTERS.sub(lambda m: "A" if m[0].isupper() and len(m[0]) > 1 else "a", word)
    return bucket("w" + letters.lower()), bucket("s" + form)


class Features:
    def __init__(self):
        self.known: dict[str, tuple[int, int]] = {}

    def split(self, text: str | None) -> tuple[list[str], list[int]]:
        """Distinct words, and numbers of the features of the whole text."""
        words = (text or "").split()
        distinct = set(words)
        n = max(1, len(words))
        again = sum(map(str.__eq__, words, words[1:]))
        whole = [f"r{min(10, 20 * again // n)}", f"u{10 * len(distinct) // n}", f"n{len(words).bit_length()}"]
        lines = [x for x in (text or "").split("\n") if x]
        whole.append(f"l{10 * len(set(lines)) // max(1, len(lines))}")
        return list(distinct), [bucket(x) for x in whole]

    def of(self, text: str | None) -> list[int]:
        words, whole = self.split(text)
        known, out = self.known, set(whole)
        if len(known) > REMEMBERED:
            known.clear()
        for w in words:
            got = known.get(w)
            if got is None:
                got = known[w] = word_features(w)
            out.update(got)
        return sorted(out)


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def stands_out(doc: np.ndarray, feature: np.ndarray, grades: np.ndarray, levels: int) -> np.ndarray:
    """Whether each feature is worth a weight; rare words that a fit would only
    learn by heart are not."""
    have = np.bincount(feature, minlength=WIDTH)
    out = np.zeros(WIDTH, bool)
    for g in range(1, levels):
        up = grades >= g
        mean = up.mean()
        got = np.bincount(feature, up[doc], WIDTH)
        error = np.sqrt(np.maximum(have * mean * (1 - mean) * (1 - have / (len(grades) + 1)), 1e-12))
        out |= (np.abs(got - have * mean) > STANDS_OUT * error) & (have >= LEAST_DOCS)
    return out


def fit(rows: list[list[int]], grades: np.ndarray, levels: int = GRADES, steps: int = STEPS, rate: float = 0.2) -> np.ndarray:
    """Weights, then thresholds, by adaptive gradient steps on the likelihood."""
    weights, thresholds = np.zeros(WIDTH), np.linspace(-1, 1, levels - 1) * 0.1
    if not rows:
        return np.concatenate([weights, np.log(np.arange(1, levels) / np.arange(levels - 1, 0, -1.0))])
    doc = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    feature = np.concatenate([np.array(r, "i8") for r in rows])
    telling = stands_out(doc, feature, np.asarray(grades), levels)
    doc, feature = doc[telling[feature]], feature[telling[feature]]
    square, steep = np.full(WIDTH, 1e-6), np.full(levels - 1, 1e-6)
    grades = np.asarray(grades)
    hit = np.arange(len(rows))
    for _ in range(steps):
        score = np.bincount(doc, weights[feature], len(rows))
        tails = np.ones((len(rows), levels + 1))
        tails[:, levels] = 0
        tails[:, 1:levels] = sigmoid(score[:, None] - thresholds)
        slope = tails * (1 - tails)  # of each tail by the score
        p = np.maximum(tails[hit, grades] - tails[hit, grades + 1], 1e-9)
        up, down = slope[hit, grades] / p, slope[hit, grades + 1] / p
        by_score = (up - down) / len(rows)
        gradient = np.bincount(feature, by_score[doc], WIDTH) - 1e-4 * weights
        by_threshold = np.array([(down[grades + 1 == g].sum() - up[grades == g].sum()) / len(rows) for g in range(1, levels)])
        square += gradient**2
        steep += by_threshold**2
        weights += rate * gradient / np.sqrt(square)
        thresholds = np.maximum.accumulate(thresholds + rate * by_threshold / np.sqrt(steep))
    return np.concatenate([weights, thresholds])


def fit_on(docs: DataFrame, ratings: DataFrame, levels: int = GRADES, sample_docs: int = SAMPLE_DOCS) -> np.ndarray:
    """``ratings``: doc_id, grade."""
    ratings = ratings.where("doc_id is not null and grade is not null").groupBy("doc_id").agg(F.min("grade").alias("grade"))
    n = ratings.count()
    if n > sample_docs:
        share = int(sample_docs / n * 2**62)
        ratings = ratings.where(F.shiftrightunsigned(F.xxhash64("doc_id", F.lit("rated")), 2) < share)
    ratings = ratings.limit(2 * sample_docs)  # so the broadcast is bounded
    rated = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(ratings), "doc_id")
    # one row for each document number: repeated rows do not make the fit larger
    rated = rated.groupBy("doc_id").agg(F.min("text").alias("text"), F.min("grade").alias("grade"))

    def train(batches):
        features, rows, grades = Features(), [], []
        for batch in batches:
            rows += [features.of(t) for t in batch["text"]]
            grades += batch["grade"].tolist()
        yield pd.DataFrame({"weights": [fit(rows, np.array(grades, "i8"), levels)]})

    got = rated.repartition(1).mapInPandas(train, "weights array<double>").collect()  # one row of fixed size
    return np.array(got[0][0]) if got else fit([], np.zeros(0, "i8"), levels)


def grade_documents(docs: DataFrame, weights: np.ndarray, levels: int = GRADES, keep_at: float = 0.5) -> DataFrame:
    """doc_id, expected_grade, tail_probability, kept."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)  # WIDTH numbers

    def run(batches):
        w, thresholds = shared.value[:WIDTH], shared.value[WIDTH:]
        features = Features()
        known: dict[str, tuple[float, int]] = {}
        for batch in batches:
            score = []
            for text in batch["text"]:
                words, whole = features.split(text)
                if len(known) > REMEMBERED:
                    known.clear()
                own, forms = set(), set(whole)
                for x in words:
                    got = known.get(x)
                    if got is None:
                        got = known[x] = word_features(x)
                    own.add(got[0])
                    forms.add(got[1])
                score.append(w[list(own | forms)].sum())
            tails = sigmoid(np.array(score)[:, None] - thresholds)
            yield pd.DataFrame(
                {
                    "doc_id": batch["doc_id"].astype("Int64"),
                    "expected_grade": tails.sum(axis=1),
                    "tail_probability": tails[:, -1],
                    "kept": tails[:, -1] >= keep_at,
                }
            )

    schema = "doc_id long, expected_grade double, tail_probability double, kept boolean"
    return map_exact(docs.select("doc_id", "text"), run, schema)
