"""Toxicity grades by cumulative-link ordinal regression.

A text has a grade from 0 (clean) to 3. With one weight per sparse feature, shared by
all thresholds, P(grade <= j) is the logistic function of threshold j less the weighted
features; thresholds are kept in order by construction. The expected grade is the sum
of the probabilities to exceed each threshold.

Features are the words of a text and their beginnings of three to five letters; the
value is n / (1 + n) for n occurrences. The most telling ones, by
a chi-square over the training rows, are kept. Labels say clean or toxic only: a toxic
training row gets its grade from how many of its words are telling, in thirds.

The model is fitted on the driver from at most ``SAMPLE_DOCS`` labelled documents,
chosen by a hash of their id; feature counts over these are summed in Spark. Every
whole text is scored.

Defined results: null and empty texts have no features; without labels of both kinds
each score is 0; equal texts get equal scores; rows with repeated or null ids are
answered each for itself.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wavecount.llm.common import held_out, slices, texts
from wavecount.llm.line_crf import training_ids
from wavecount.session import materialise

SAMPLE_DOCS = 6_000
FEATURES = 1_024
LEAST_DOCS = 4
GRADES = 3
#: Words a task remembers the features of; beyond that it starts anew, results are the same.
CACHED_WORDS = 400_000

_WORD = re.compile(r"[^\W\d_]+")


def word_features(word: str) -> list[str]:
    return [f"w={word}", *(f"p={word[:k]}" for k in (3, 4, 5) if len(word) > k)]


def counts(text: str) -> Counter:
    return Counter(_WORD.findall(text.lower()))


@dataclass
class Model:
    index: dict[str, int]
    weights: np.ndarray
    thresholds: np.ndarray  # one for each grade above 0, in order
    fitted: int = 0  # documents

    def __post_init__(self):
        self.words: dict[str, tuple[int, ...]] = {}

    def _places(self, word: str) -> tuple[int, ...]:
        return tuple(k for f in word_features(word) if (k := self.index.get(f)) is not None)

    def exceeds(self, text: str) -> np.ndarray:
        """P(grade >= 1), P(grade >= 2), ..."""
        if not self.index:
            return np.zeros(len(self.thresholds))
        sums: Counter = Counter()
        if len(self.words) > CACHED_WORDS:
            self.words.clear()
        for word, n in counts(text).items():
            places = self.words.get(word)
            if places is None:
                places = self.words[word] = self._places(word)
            for k in places:
                sums[k] += n
        total = sum(self.weights[k] * n / (1 + n) for k, n in sums.items())
        return 1 / (1 + np.exp(-np.clip(total - self.thresholds, -35, 35)))


def fit(x: np.ndarray, grades: np.ndarray, index: dict[str, int], steps: int = 400, decay: float = 2e-4) -> Model:
    """Maximum likelihood with an L2 penalty, by Adam over all rows at once."""
    n, wide = x.shape
    weights, top = np.zeros(wide), int(grades.max(initial=0))
    if not n or not top or not (grades == 0).any():
        return Model({}, np.zeros(0), np.zeros(GRADES))
    # thresholds are first + cumulated exp(gap)
    share = [(grades >= j).mean() for j in range(1, top + 1)]
    params = np.concatenate([[np.log((1 - share[0]) / share[0])], np.zeros(top - 1)])
    m, v = np.zeros(wide + top), np.zeros(wide + top)
    rows = np.arange(n)
    for step in range(1, steps + 1):
        gaps = np.exp(params[1:])
        cuts = params[0] + np.concatenate([[0.0], np.cumsum(gaps)])
        above = 1 / (1 + np.exp(-np.clip((x @ weights)[:, None] - cuts, -35, 35)))
        p = np.hstack([np.ones((n, 1)), above, np.zeros((n, 1))])
        slope = p * (1 - p)
        here = np.maximum(p[rows, grades] - p[rows, grades + 1], 1e-12)
        d_score = (slope[rows, grades] - slope[rows, grades + 1]) / here  # of the log likelihood, by w.x
        d_cut = np.zeros((n, top + 2))
        d_cut[rows, grades] -= slope[rows, grades] / here
        d_cut[rows, grades + 1] += slope[rows, grades + 1] / here
        by_cut = d_cut[:, 1 : top + 1].sum(0) / n
        later = np.cumsum(by_cut[::-1])[::-1]
        grad = np.concatenate([x.T @ d_score / n - decay * weights, [later[0]], later[1:] * gaps])
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        move = 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        weights, params = weights + move[:wide], params + move[wide:]
    cuts = params[0] + np.concatenate([[0.0], np.cumsum(np.exp(params[1:]))])
    return Model(index, weights, np.concatenate([cuts, np.full(GRADES - top, np.inf)]))


def train(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS) -> Model:
    chosen = training_ids(labels, "toxic", sample_docs)
    rows = texts(docs).join(F.broadcast(chosen), "doc_id")  # at most ``sample_docs`` rows

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 64):
            out = []
            for doc_id, text, label in zip(*(part[c].to_pylist() for c in ("doc_id", "text", "label")), strict=True):
                words, sums = counts(text), Counter()
                for word, n in words.items():
                    for f in word_features(word):
                        sums[f] += n
                out.append({"doc_id": doc_id, "label": label, "n_words": sum(words.values()), "features": list(sums), "n": list(sums.values())})
            yield pa.RecordBatch.from_pylist(out, schema=pa.schema([
                ("doc_id", pa.int64()), ("label", pa.int32()), ("n_words", pa.int64()),
                ("features", pa.list_(pa.string())), ("n", pa.list_(pa.int32()))]))

    table = materialise(rows.mapInArrow(features, "doc_id long, label int, n_words long, features array<string>, n array<int>"), "toxicity")
    sizes = {r["label"]: r["n"] for r in table.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(sizes) < 2:
        return Model({}, np.zeros(0), np.zeros(GRADES))
    bad, good = sizes[1], sizes[0]
    seen = table.select("label", F.explode("features").alias("f")).groupBy("f").agg(
        F.sum("label").alias("bad"), F.sum(1 - F.col("label")).alias("good")).where(F.col("bad") + F.col("good") >= LEAST_DOCS)
    off = F.col("bad") * good - F.col("good") * bad  # chi-square of the two-by-two table, up to a constant factor
    both = F.col("bad") + F.col("good")
    chi = off * off / (both * (F.lit(bad + good) - both + 1e-9))
    top = seen.withColumn("chi", chi).orderBy(F.desc("chi"), "f").limit(FEATURES).collect()
    index = {r["f"]: k for k, r in enumerate(top)}
    telling = [k for k, r in enumerate(top) if r["f"].startswith("w=") and (r["bad"] + 0.5) / bad > 20 * (r["good"] + 0.5) / good]
    told = F.filter(F.arrays_zip("features", "n"), lambda f: f["features"].isin(list(index)))  # also of documents with none of them
    rows = table.select("doc_id", "label", "n_words", told.alias("x")).orderBy("doc_id", "label", "n_words")
    rows = rows.limit(2 * sample_docs).collect()  # repeated documents stay within the bound
    x = np.zeros((len(rows), len(index)))
    for k, r in enumerate(rows):
        for f, n in r["x"]:
            x[k, index[f]] = n
    labels_, size = np.array([r["label"] for r in rows]), np.array([max(1, r["n_words"]) for r in rows])
    rate = x[:, telling].sum(1) / size
    borders = np.quantile(rate[labels_ == 1], [1 / 3, 2 / 3]) if (labels_ == 1).any() else [0, 0]
    grades = np.where(labels_ == 1, 1 + (rate > borders[0]).astype(int) + (rate > borders[1]).astype(int), 0)
    model = fit(x / (1 + x), grades, index)
    model.fitted = len(rows)
    return model


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Per document: score (probability of any toxicity), predicted, expected severity and likeliest grade."""
    model = train(docs, labels)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            above = np.array([model.exceeds(t) for t in part["text"].to_pylist()]).reshape(part.num_rows, -1)
            exact = np.hstack([1 - above[:, :1], above[:, :-1] - above[:, 1:], above[:, -1:]])
            yield pa.RecordBatch.from_arrays([
                part["doc_id"], pa.array(above[:, 0]), pa.array((above[:, 0] >= threshold).astype(np.int32)),
                pa.array(above.sum(1)), pa.array(exact.argmax(1).astype(np.int32)),
            ], names=["doc_id", "score", "predicted", "severity", "grade"])

    rows = texts(docs).mapInArrow(scored, "doc_id long, score double, predicted int, severity double, grade int")
    return rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted", "severity", "grade")
