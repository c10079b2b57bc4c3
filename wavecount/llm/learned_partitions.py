"""Nearest neighbours by learned partitions.

A sample of vectors is linked to its nearest neighbours; the graph is cut into parts
of equal size with few links between them. A softmax classifier then learns to say, for
any vector, in which parts its neighbours lie. Every vector is indexed in its likeliest
part, and a query is compared with all vectors of its likeliest parts, exactly.

How many parts a query visits is set by measurement: for ``TRIAL_QUERIES`` vectors the
true neighbours among all rows are found, and the visits grow until the wanted share of
them is reached.

A query that has found fewer than it wants, though there are more, visits all parts.

Bounds: the graph and classifier use ``SAMPLE`` vectors, or ``SAMPLE_PER_PART`` for each
part up to ``LARGEST_SAMPLE``, and the trial at most ``TRIAL_QUERIES`` (all chosen by a
hash of the id), which is what reaches the driver. Parts of any size are dealt into slots
of ``SLOT`` candidates and their queries into blocks of ``QUERIES``; a slot and a block
meet in one group, so a part that holds a third of all rows is many tasks.

Defined results: vectors that are null, empty, zero or hold null or non-finite numbers
take no part, nor do those whose length is not the most frequent one (of equally
frequent ones the smaller); equal vectors tie and the smaller id comes first; rows with
a null id take no part; rows that repeat an id are candidates each; fewer than k
candidates are returned all; an empty table gives none.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wavecount.llm.common import slices
from wavecount.session import materialise

SAMPLE = 4_096
TRIAL_QUERIES = 256
SLOT = 16_384
QUERY_BLOCK = 512
K = 5
#: Vectors of a part, roughly. There are at least ``PARTS`` parts, or one for each 32 vectors of a small table.
PER_PART = 65_536
PARTS = 16
#: The sample grows with the parts, as far as this; beyond so many parts they grow.
SAMPLE_PER_PART = 64
LARGEST_SAMPLE = 65_536
#: Queries of one group.
QUERIES = 4_096
RECALL = 0.97

_PARTS = "vec_id long, vector array<double>, part int"


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and vector (double) of the rows that take part."""
    rows = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = rows.where(F.col("vec_id").isNotNull() & F.coalesce(finite & F.exists("vector", lambda x: x != 0), F.lit(False)))
    lengths = rows.groupBy(F.size("vector").alias("size")).count().orderBy(F.desc("count"), "size").limit(1).collect()
    return rows.where(F.size("vector") == (lengths[0]["size"] if lengths else 0))


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)  # neither overflow nor underflow of squares
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def neighbour_graph(x: np.ndarray, k: int = 10, block: int = 512) -> np.ndarray:
    """Indices of the k nearest other rows of every row of a bounded sample."""
    k = min(k, len(x) - 1)
    out = np.empty((len(x), k), np.int64)
    for at in range(0, len(x), block):
        near = x[at : at + block] @ x.T
        near[np.arange(len(near)), np.arange(at, at + len(near))] = -np.inf
        out[at : at + block] = np.argpartition(-near, k - 1, axis=1)[:, :k]
    return out


def balanced_parts(graph: np.ndarray, x: np.ndarray, parts: int, sweeps: int = 12, seed: int = 7) -> np.ndarray:
    """Parts of equal size (within 5 %) with few links between them.

    Starts from median cuts along random directions smoothed over the graph, then moves
    nodes to the part of most of their neighbours while the balance allows it.
    """
    n, rng = len(x), np.random.default_rng(seed)
    ties = [[] for _ in range(n)]
    for a, row in enumerate(graph):
        for b in row:
            ties[a].append(b)
            ties[b].append(a)
    part = np.zeros(n, np.int64)

    def cut(members: np.ndarray, first: int, count: int) -> None:
        if count == 1 or not len(members):
            part[members] = first
            return
        value = x @ rng.standard_normal(x.shape[1])
        for _ in range(10):  # smoothing pulls linked nodes to one side
            value = 0.5 * value + 0.5 * value[graph].mean(1)
            value -= value[members].mean()
        order = members[np.lexsort((members, value[members]))]
        half = count // 2
        border = len(members) * half // count
        cut(order[:border], first, half)
        cut(order[border:], first + half, count - half)

    cut(np.arange(n), 0, parts)
    sizes = np.bincount(part, minlength=parts)
    most, least = int(n / parts * 1.05) + 1, int(n / parts * 0.95)
    for _ in range(sweeps):
        moved = 0
        for a in rng.permutation(n):
            votes = np.bincount(part[ties[a]], minlength=parts)
            here = part[a]
            best = int(np.argmax(np.where(sizes < most, votes, -1)))
            if votes[best] > votes[here] and sizes[here] > least:
                sizes[here] -= 1
                sizes[best] += 1
                part[a] = best
                moved += 1
        if not moved:
            break
    return part


@dataclass
class Router:
    """A softmax classifier with one hidden layer."""

    first: np.ndarray
    second: np.ndarray

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        hidden = np.maximum(np.hstack([x, np.ones((len(x), 1))]) @ self.first, 0)
        return np.hstack([hidden, x, np.ones((len(x), 1))]) @ self.second

    @staticmethod
    def fit(x: np.ndarray, target: np.ndarray, hidden: int = 128, steps: int = 300, seed: int = 11) -> Router:
        rng, n = np.random.default_rng(seed), len(x)
        wide = x.shape[1]
        one = np.ones((n, 1))
        params = [rng.standard_normal((wide + 1, hidden)) / np.sqrt(wide), np.zeros((hidden + wide + 1, target.shape[1]))]
        m, v = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
        inputs = np.hstack([x, one])
        for step in range(1, steps + 1):
            raw = inputs @ params[0]
            last = np.hstack([np.maximum(raw, 0), x, one])
            odds = last @ params[1]
            p = np.exp(odds - odds.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            error = (p - target) / n
            slopes = [inputs.T @ ((error @ params[1][:hidden].T) * (raw > 0)) + 1e-5 * params[0], last.T @ error + 1e-5 * params[1]]
            for k, g in enumerate(slopes):
                m[k], v[k] = 0.9 * m[k] + 0.1 * g, 0.999 * v[k] + 0.001 * g * g
                params[k] = params[k] - 0.02 * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
        return Router(*params)


def learn(sample: np.ndarray, parts: int) -> Router:
    x = unit(sample)
    if len(x) <= parts or parts == 1:
        return Router(np.zeros((x.shape[1] + 1, 1)), np.zeros((x.shape[1] + 2, 1)))
    graph = neighbour_graph(x)
    part = balanced_parts(graph, x, parts)
    target = np.zeros((len(x), parts))
    for column in graph.T:
        np.add.at(target, (np.arange(len(x)), part[column]), 1.0)
    np.add.at(target, (np.arange(len(x)), part), 1.0)
    return Router.fit(x, target / target.sum(1, keepdims=True))


def _matrix(column: pa.Array) -> np.ndarray:
    return np.array(column.to_pylist(), np.float64).reshape(len(column), -1)


def index(rows: DataFrame, router: Router) -> DataFrame:
    """Every row with its likeliest part."""
    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 4096):
            part = router.log_odds(unit(_matrix(batch["vector"]))).argmax(1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(part.astype(np.int32))], names=["vec_id", "vector", "part"])

    return rows.mapInArrow(placed, _PARTS)


def exact_scores(query: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Cosines in double precision; equal vectors get equal ones, whatever block they are in."""
    return np.minimum(1.0, np.maximum(-1.0, np.array([float(np.sum(query * c)) for c in unit(candidates)])))


def best_of_block(q_ids: np.ndarray, q: np.ndarray, c_ids: np.ndarray, c: np.ndarray, k: int) -> Iterator[tuple[int, int, float]]:
    """The k nearest of a block of candidates for each query, without itself."""
    q, c_unit = unit(q), unit(c)
    near = q @ c_unit.T
    near[q_ids[:, None] == c_ids[None, :]] = -np.inf
    take = min(k, len(c_ids))
    bound = np.partition(near, len(c_ids) - take, axis=1)[:, len(c_ids) - take]
    for a, row in enumerate(near):
        found = np.flatnonzero((row >= bound[a] - 1e-12) & np.isfinite(row))
        if len(found):
            scores = exact_scores(q[a], c[found])
            order = np.lexsort((c_ids[found], -scores))[:k]
            for b in order:
                yield int(q_ids[a]), int(c_ids[found[b]]), float(scores[b])


def _ranked(pairs: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return pairs.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _against_all(rows: DataFrame, queries: list, k: int) -> DataFrame:
    """A bounded set of queries against every row, block by block."""
    ids, q = np.array([r["vec_id"] for r in queries]), np.array([r["vector"] for r in queries], np.float64)

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64()), ("part", pa.int32())])
        for batch in slices(batches, 4096):
            part_of = dict(zip(batch["vec_id"].to_pylist(), batch["part"].to_pylist(), strict=True))
            found = best_of_block(ids, q, np.array(batch["vec_id"]), _matrix(batch["vector"]), k)
            yield pa.RecordBatch.from_pylist([{"query_id": a, "vec_id": b, "score": s, "part": part_of[b]} for a, b, s in found], schema=kind)

    return rows.mapInArrow(compared, "query_id long, vec_id long, score double, part int")


def visits(indexed: DataFrame, router: Router, parts: int, k: int, recall: float, trial: int = TRIAL_QUERIES) -> int:
    """The least number of parts to visit that finds the wanted share of true neighbours of the trial queries."""
    queries = indexed.orderBy(F.xxhash64(F.col("vec_id"), F.lit(1)), "vec_id").limit(trial).select("vec_id", "vector").collect()
    truth = _ranked(_against_all(indexed, queries, k), k).select("query_id", "part").collect()  # at most trial * k rows
    if not truth:
        return parts
    odds = router.log_odds(unit(np.array([r["vector"] for r in queries], np.float64)))
    places = {r["vec_id"]: row for r, row in zip(queries, np.argsort(np.argsort(-odds, axis=1, kind="stable"), axis=1), strict=True)}
    needed = np.sort([places[r["query_id"]][r["part"]] for r in truth])
    return int(needed[min(len(needed) - 1, int(np.ceil(recall * len(needed))) - 1)]) + 1


def search(vectors: DataFrame, query_step: int = 50, k: int = K, recall: float = RECALL, sample: int = SAMPLE) -> DataFrame:
    """The k nearest found for every row whose id is divisible by ``query_step``."""
    rows = usable(vectors)
    total = rows.count()
    parts = max(2, min(max(PARTS, -(-total // PER_PART)), LARGEST_SAMPLE // SAMPLE_PER_PART, total // 32))
    sample = max(sample, parts * SAMPLE_PER_PART)
    chosen = [r["vector"] for r in rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).select("vector").collect()]
    schema = "query_id long, vec_id long, score double"
    if not chosen:
        return _ranked(vectors.sparkSession.createDataFrame([], schema), k).select("query_id", "rank", "vec_id", "score")
    router = learn(np.array(chosen, np.float64), parts)
    parts = router.second.shape[1]
    indexed = materialise(index(rows, router), "vectors")
    visited = visits(indexed, router, parts, k, recall)

    # a part is dealt into slots of about SLOT candidates; the table has one row per part
    slots = indexed.groupBy("part").agg(F.ceil(F.count("*") / F.lit(SLOT)).cast("int").alias("slots"))
    slots = materialise(slots, "slots")

    def routed(table: DataFrame, reach: int) -> DataFrame:
        def ranked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches, 1024):
                odds = router.log_odds(unit(_matrix(batch["vector"])))
                order = np.argsort(-odds, axis=1, kind="stable")[:, :reach]
                yield pa.RecordBatch.from_arrays([batch["query_id"], batch["vector"], pa.array(list(order.astype(np.int32)), pa.list_(pa.int32()))],
                                                 names=["query_id", "vector", "parts"])

        table = table.mapInArrow(ranked, "query_id long, vector array<double>, parts array<int>")
        return table.select("query_id", "vector", F.explode("parts").alias("part"))

    def compared(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(left) and len(right):
            c_ids, c = right["vec_id"].to_numpy(), np.stack(right["vector"].to_numpy())
            for at in range(0, len(left), QUERY_BLOCK):
                block = left.iloc[at : at + QUERY_BLOCK]
                found += best_of_block(block["query_id"].to_numpy(), np.stack(block["vector"].to_numpy()), c_ids, c, k)
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"]).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})

    def met(table: DataFrame, reach: int) -> DataFrame:
        """The best of every slot that a query of ``table`` visits."""
        asked = materialise(routed(table, reach), "routed")
        blocks = asked.groupBy("part").agg(F.ceil(F.count("*") / F.lit(QUERIES)).cast("int").alias("blocks"))
        cells = materialise(slots.join(blocks, "part"), "cells")  # one row per part
        left = asked.join(F.broadcast(cells), "part").withColumn("block", F.pmod(F.xxhash64("query_id"), F.col("blocks")).cast("int"))
        left = left.withColumn("slot", F.explode(F.sequence(F.lit(0), F.col("slots") - 1))).select("part", "slot", "block", "query_id", "vector")
        right = indexed.join(F.broadcast(cells), "part").withColumn("slot", F.pmod(F.xxhash64("vec_id"), F.col("slots")).cast("int"))
        right = right.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select("part", "slot", "block", "vec_id", "vector")
        cell = ["part", "slot", "block"]
        return left.groupBy(*cell).cogroup(right.groupBy(*cell)).applyInPandas(compared, schema)

    queries = materialise(indexed.where(F.col("vec_id") % query_step == 0).select(
        F.col("vec_id").alias("query_id"), "vector").dropDuplicates(), "queries")
    pairs = materialise(met(queries, visited), "pairs")
    own = queries.join(indexed.groupBy(F.col("vec_id").alias("query_id")).agg(F.count("*").alias("own")), "query_id")
    enough = pairs.groupBy("query_id").agg(F.countDistinct("vec_id").alias("n"))
    few = own.join(enough, "query_id", "left").where(F.coalesce("n", F.lit(0)) < F.least(F.lit(k), F.lit(total) - F.col("own")))
    few = materialise(few.select("query_id", "vector"), "few")
    if visited < parts and few.limit(1).collect():
        pairs = pairs.unionByName(met(few, parts))
    # rows that repeat a query's id may hold other vectors: the better of equal pairs counts
    pairs = pairs.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    return _ranked(pairs, k).select("query_id", "rank", "vec_id", "score")
