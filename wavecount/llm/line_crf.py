"""Document quality from a linear-chain conditional random field over lines.

Every line is labelled good or bad. A line is seen through its own features and those
of the lines before and after it; labels of neighbouring lines are tied by transition
weights. Forward-backward gives each line's probability to be good; their mean,
weighted by line length, is calibrated into the probability that the document is good.

Labels exist for documents only. Training starts with the document's label on each
line; then, twice, lines of bad documents which the field takes for good are labelled
good, except a document's worst line, and the field is trained again.

The model is fitted on the driver from at most ``SAMPLE_DOCS`` labelled documents,
chosen by a hash of their id, and at most ``SAMPLE_LINES`` neighbouring lines of each:
the bound of what is gathered. Scoring covers every line of every document.

Defined results: a null or empty text is one empty line; without any labelled
document each score is 0.5; equal texts get equal scores; repeated and null ids are
answered row by row.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wavecount.llm.common import held_out, slices, texts

SAMPLE_DOCS = 4_000
SAMPLE_LINES = 96
THRESHOLD = 0.3

_UPPER = bytes(range(65, 91))
_LOWER = bytes(range(97, 123))
_DIGITS = b"0123456789"
_STOPS = b".,;:'\"()-?"
_SIGNS = bytes(set(range(33, 127)) - set(_UPPER + _LOWER + _DIGITS + _STOPS))
OWN = 16


def line_features(line: str) -> list[float]:
    """What one line looks like; every value between 0 and about 1."""
    octets = line.encode("utf-8", "surrogatepass")
    size = len(octets)
    if not size:
        return [1.0] + [0.0] * 14 + [1.0]

    def share(of: bytes) -> float:
        return (size - len(octets.translate(None, of))) / size

    words = line.split()
    n = len(words) or 1
    upper, signs = share(_UPPER), share(_SIGNS)
    fresh = len(set(words)) / n
    length = min(1.0, (size - n) / n / 16)
    pipes = octets.count(b"|") / n
    return [1.0, min(1.0, math.log1p(size) / 10), upper, min(1.0, 4 * upper), share(_DIGITS), signs, min(1.0, 8 * signs),
            share(_STOPS), 1 - fresh, float(fresh < 0.4 and n > 8), length, length * length, min(1.0, pipes),
            float(line[0].isupper()), float(line.rstrip()[-1:] == "."), 0.0]


def document_features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Features of the lines with those of their neighbours, and the weights of the lines."""
    lines = text.split("\n")
    own = np.array([line_features(x) for x in lines], np.float32)
    before = np.vstack([np.zeros((1, OWN), np.float32), own[:-1]])
    after = np.vstack([own[1:], np.zeros((1, OWN), np.float32)])
    return np.hstack([own, before, after]), np.array([len(x) + 1 for x in lines], np.float64)


@dataclass
class Model:
    weights: np.ndarray  # of a line's features for "good"; "bad" has 0
    moves: np.ndarray  # moves[a, b]: from label a to label b
    scale: float  # calibration of the document's log-odds
    shift: float

    def good_lines(self, odds: list[float]) -> list[float]:
        """Marginal probability of "good" for each line of one document, by forward-backward."""
        e = np.exp(self.moves - self.moves.max())
        bb, bg, gb, gg = float(e[0, 0]), float(e[0, 1]), float(e[1, 0]), float(e[1, 1])
        good = [1 / (1 + math.exp(-min(60.0, max(-60.0, x)))) for x in odds]
        forward, f = [], None
        for p in good:
            b, g = (1 - p, p) if f is None else ((1 - p) * ((1 - f) * bb + f * gb), p * ((1 - f) * bg + f * gg))
            f = g / (b + g)
            forward.append(f)
        out, back = [0.0] * len(good), 0.5
        for k in range(len(good) - 1, -1, -1):
            b, g = (1 - forward[k]) * (1 - back), forward[k] * back
            out[k] = g / (b + g) if b + g else forward[k]
            p = good[k]
            b, g = (1 - p) * (1 - back) * bb + p * back * bg, (1 - p) * (1 - back) * gb + p * back * gg
            back = g / (b + g) if b + g else 0.5
        return out

    def raw(self, text: str) -> float:
        """The length-weighted mean of the marginals."""
        features, sizes = document_features(text)
        return float(np.dot(self.good_lines((features @ self.weights).tolist()), sizes) / sizes.sum())

    def score(self, text: str) -> float:
        return float(calibrated(self.raw(text), self.scale, self.shift))


def calibrated(mean, scale: float, shift: float):
    mean = np.clip(mean, 1e-6, 1 - 1e-6)
    return 1 / (1 + np.exp(-np.clip(scale * np.log(mean / (1 - mean)) + shift, -35, 35)))


def _marginals(odds, moves, real):
    """Batched forward-backward over padded documents: marginals, pair marginals, log partition."""
    n, length = odds.shape
    unary = np.stack([np.zeros_like(odds), odds], -1) * real[..., None]
    forward = np.zeros((n, length, 2))
    forward[:, 0] = unary[:, 0]
    for t in range(1, length):
        step = np.logaddexp(forward[:, t - 1, :1] + moves[0], forward[:, t - 1, 1:] + moves[1]) + unary[:, t]
        forward[:, t] = np.where(real[:, t, None], step, forward[:, t - 1])
    back = np.zeros((n, length, 2))
    for t in range(length - 2, -1, -1):
        x = unary[:, t + 1] + back[:, t + 1]
        step = np.logaddexp(x[:, :1] + moves[:, 0], x[:, 1:] + moves[:, 1])
        back[:, t] = np.where(real[:, t + 1, None], step, 0)
    total = np.logaddexp(forward[:, -1, 0], forward[:, -1, 1])
    single = np.exp(forward + back - total[:, None, None])
    pairs = forward[:, :-1, :, None] + moves + (unary + back)[:, 1:, None, :] - total[:, None, None, None]
    pairs = np.exp(np.minimum(pairs, 0)) * real[:, 1:, None, None]
    return single[..., 1], pairs.sum((0, 1))


def fit(samples: list[tuple[np.ndarray, np.ndarray, int]], rounds: int = 3, steps: int = 120, decay: float = 1e-3) -> Model:
    """Conditional maximum likelihood by Adam over all sampled documents at once."""
    wide = OWN * 3
    if len({y for *_, y in samples}) < 2:
        return Model(np.zeros(wide), np.zeros((2, 2)), 1.0, 0.0)
    order = sorted(range(len(samples)), key=lambda k: len(samples[k][0]))
    samples = [samples[k] for k in order]
    sizes = np.array([len(x) for x, *_ in samples])
    groups = np.array_split(np.arange(len(samples)), min(8, len(samples)))
    flat = np.concatenate([x for x, *_ in samples]).astype(np.float64)
    starts = np.concatenate([[0], np.cumsum(sizes)])
    doc = np.repeat([y for *_, y in samples], sizes).astype(np.float64)
    labels, weights, moves = doc.copy(), np.zeros(wide), np.zeros((2, 2))
    share = np.array([y for *_, y in samples]).mean()
    balance = np.repeat([0.5 / (share if y else 1 - share) for *_, y in samples], sizes)

    def probabilities(odds):
        out, pairs = np.zeros(len(odds)), np.zeros((2, 2))
        for g in groups:
            a, b, longest = starts[g[0]], starts[g[-1] + 1], sizes[g].max()
            real = np.arange(longest) < sizes[g][:, None]
            padded = np.zeros(real.shape)
            padded[real] = odds[a:b]
            single, found = _marginals(padded, moves, real)
            out[a:b] = single[real]
            pairs += found
        return out, pairs

    inner = np.ones(len(flat), bool)
    inner[starts[1:-1]] = False
    inner[0] = False
    for _ in range(rounds):
        now, then = labels[inner].astype(int), labels[np.flatnonzero(inner) - 1].astype(int)
        seen = np.zeros((2, 2))
        np.add.at(seen, (then, now), 1)
        m = [np.zeros(wide), np.zeros((2, 2))]
        v = [np.zeros(wide), np.zeros((2, 2))]
        for step in range(1, steps + 1):
            p, pairs = probabilities(flat @ weights)
            slopes = [flat.T @ (balance * (labels - p)) / len(flat) - decay * weights, (seen - pairs) / len(flat) - decay * moves]
            for k, (x, g) in enumerate(zip((weights, moves), slopes, strict=True)):
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.999 * v[k] + 0.001 * g * g
                x += 0.1 * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
        p, _ = probabilities(flat @ weights)
        labels = doc.copy()
        for k, (*_, y) in enumerate(samples):
            if not y:
                part = p[starts[k] : starts[k + 1]]
                labels[starts[k] : starts[k + 1]] = (part > 0.5) & (part > part.min())
    model = Model(weights, moves, 1.0, 0.0)
    means = np.array([np.dot(model.good_lines((x @ weights).tolist()), s) / s.sum() for x, s, _ in samples])
    model.scale, model.shift = _calibrate(means, np.array([y for *_, y in samples], np.float64))
    return model


def _calibrate(means: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Logistic regression on one number, by Newton steps with a small ridge."""
    x = np.stack([np.log(np.clip(means, 1e-6, 1 - 1e-6) / (1 - np.clip(means, 1e-6, 1 - 1e-6))), np.ones(len(means))], 1)
    w, ridge = np.array([0.5, 0.0]), np.diag([1e-2, 1e-2])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -35, 35)))
        w = w + np.clip(np.linalg.solve((x.T * (p * (1 - p))) @ x + ridge, x.T @ (labels - p) - ridge @ w), -1, 1)
    return max(0.05, float(w[0])), float(w[1])


def training_ids(labels: DataFrame, column: str, docs: int) -> DataFrame:
    """A bounded choice of labelled rows that may be learnt from, by a hash of the id."""
    rows = labels.where(F.col(column).isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    rows = rows.select("doc_id", F.col(column).cast("int").alias("label"))
    return rows.orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(docs)


def train(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS, sample_lines: int = SAMPLE_LINES) -> Model:
    chosen = training_ids(labels, "quality", sample_docs)
    rows = texts(docs).join(F.broadcast(chosen), "doc_id")  # at most ``sample_docs`` rows

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            out = []
            for doc_id, text, label in zip(*(part[c].to_pylist() for c in ("doc_id", "text", "label")), strict=True):
                x, sizes = document_features(text)
                at = doc_id * 2654435761 % max(1, len(x) - sample_lines + 1)
                cut = slice(at, at + sample_lines)
                out.append({"doc_id": doc_id, "label": label, "x": x[cut].tobytes(), "sizes": sizes[cut].tolist()})
            yield pa.RecordBatch.from_pylist(out, schema=pa.schema(
                [("doc_id", pa.int64()), ("label", pa.int32()), ("x", pa.binary()), ("sizes", pa.list_(pa.float64()))]))

    table = rows.mapInArrow(features, "doc_id long, label int, x binary, sizes array<double>")
    table = table.orderBy("doc_id", "label", "x").limit(2 * sample_docs)  # repeated documents stay within the bound
    return fit([(np.frombuffer(r["x"], np.float32).reshape(-1, 3 * OWN), np.array(r["sizes"]), r["label"]) for r in table.collect()])


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and score of every document, where it lies: no shuffle."""
    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            values = [model.score(t) for t in part["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays([part["doc_id"], pa.array(values, pa.float64())], names=["doc_id", "score"])

    return texts(docs).mapInArrow(scored, "doc_id long, score double")


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    rows = score(docs, train(docs, labels))
    return rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                       (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents whose score reaches the threshold, with all their columns."""
    model = train(docs, labels)

    def good(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            yield part.filter(pa.array([model.score(t or "") >= THRESHOLD for t in part["text"].to_pylist()], pa.bool_()))

    return docs.mapInArrow(good, docs.schema)
