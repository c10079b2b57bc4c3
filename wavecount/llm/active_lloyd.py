"""Compression of vectors to codes, by Lloyd's rounds that compare only what moved.

Vectors become whole numbers, floor(scale * x), and are cut into equal parts; each part
position has a codebook of ``entries`` entries. A round assigns every part to its
nearest entry and moves each entry to the floor of its parts' mean.

A written table carries, beside each vector, the entry of every part and the exact
distance to it. In the next round a part whose entry did not move compares the entries
that moved with that distance: among the others its own is still the first of the
nearest. A part whose entry moved compares all. Ties go to the lower index either way,
so every round gives what a full comparison would.

Each round is one map over the table and one sum over (part, entry, position), combined
in every task; what reaches the driver are the codebooks, whose size is set by
parameters and not by the rows. The starting entries are rows of a top-``entries``.

Defined results: vectors that are null, empty or hold null or non-finite components take
no part, nor do those whose length is not the most frequent one (of equally frequent
ones the smaller); rows that repeat an id are rows of their own; a null id comes after
all others and equal ids are ordered by their vectors when starting entries are chosen;
fewer rows than entries give as many entries as rows; entries without parts stay; null
labels are one label; an empty table gives no rows. A length that cannot be cut into
equal parts and components from 2^26 on (after scaling) raise an error.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wavecount.llm.common import look_up, slices
from wavecount.session import materialise

ENTRIES = 64
PARTS = 16
SCALE = 256
ROUNDS = 2
ROWS = 4_096

#: Whole numbers below this have exact squared distances in 64 bits.
LARGEST = 1 << 26
#: Below this, and up to 128 components a part, they are exact in floating point, too.
_FLOATS = 1 << 22


def usable(vectors: DataFrame, label: str = "label") -> DataFrame:
    """vec_id, label and vector (double) of the rows that take part."""
    rows = vectors.select("vec_id", F.col(label).alias("label"), F.col("embedding").cast("array<double>").alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = rows.where(F.coalesce(finite & (F.size("vector") > 0), F.lit(False)))
    lengths = rows.groupBy(F.size("vector").alias("size")).count().orderBy(F.desc("count"), "size").limit(1).collect()
    return rows.where(F.size("vector") == (lengths[0]["size"] if lengths else 0))


def distances(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distances of the rows of ``x`` to all entries, exact."""
    largest = max(int(np.abs(x).max(initial=0)), int(np.abs(entries).max(initial=0)))
    if largest < _FLOATS and x.shape[1] <= 128:
        a, b = x.astype(np.float64), entries.astype(np.float64)
        return ((a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)).astype(np.int64)
    return np.stack([((x - e) ** 2).sum(1) for e in entries], axis=1)


def assign(x: np.ndarray, books: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Entry of every part (rows, parts, components), its distance, and the number of entries compared."""
    codes = np.empty(x.shape[:2], np.uint8)
    errors = np.empty(x.shape[:2], np.int64)
    for p, entries in enumerate(books):
        d = distances(x[:, p], entries)
        codes[:, p] = d.argmin(1)
        errors[:, p] = np.take_along_axis(d, codes[:, p, None].astype(np.int64), 1)[:, 0]
    return codes, errors, x.shape[0] * books.shape[0] * books.shape[1]


def reassign(x: np.ndarray, books: np.ndarray, moved: np.ndarray, codes: np.ndarray,
             errors: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """The same as ``assign``, from the entries and distances before the entries in ``moved`` moved."""
    codes, errors, compared = codes.copy(), errors.copy(), 0
    for p, entries in enumerate(books):
        movers = np.flatnonzero(moved[p])
        if not len(movers):
            continue
        stale = moved[p][codes[:, p]]
        lost, kept = np.flatnonzero(stale), np.flatnonzero(~stale)
        if len(lost):
            d = distances(x[lost, p], entries)
            codes[lost, p] = best = d.argmin(1)
            errors[lost, p] = d[np.arange(len(lost)), best]
            compared += d.size
        if len(kept):
            d = distances(x[kept, p], entries[movers])
            best = d.argmin(1)
            least, entry = d[np.arange(len(kept)), best], movers[best]
            better = (least < errors[kept, p]) | ((least == errors[kept, p]) & (entry < codes[kept, p]))
            codes[kept[better], p] = entry[better]
            errors[kept[better], p] = least[better]
            compared += d.size
    return codes, errors, compared


def _whole(vector: np.ndarray, scale: int) -> np.ndarray:
    x = np.floor(vector * scale)
    if np.abs(x).max(initial=0) >= LARGEST:
        raise ValueError(f"a component is beyond {LARGEST} after scaling by {scale}")
    return x.astype(np.int64)


def _binary(rows: np.ndarray) -> pa.Array:
    return pa.array([r.tobytes() for r in rows], pa.binary())


def _state(label: str) -> str:
    return f"vec_id long, label {label}, x binary, code binary, errors binary, compared long"


def _first(rows: DataFrame, books: np.ndarray, scale: int) -> DataFrame:
    parts, _, length = books.shape

    def assigned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, ROWS):
            x = _whole(part["vector"].flatten().to_numpy().reshape(part.num_rows, -1), scale)
            codes, errors, n = assign(x.reshape(-1, parts, length), books)
            compared = np.full(part.num_rows, n // part.num_rows)
            yield pa.RecordBatch.from_arrays(
                [part["vec_id"], part["label"], _binary(x.astype("<i4")), _binary(codes), _binary(errors.astype("<i8")),
                 pa.array(compared)], names=["vec_id", "label", "x", "code", "errors", "compared"])

    rows = rows.withColumn("vec_id", F.col("vec_id").cast("long"))
    return rows.mapInArrow(assigned, _state(rows.schema["label"].dataType.simpleString()))


def _read(part: pa.RecordBatch, column: str, kind: str, *shape: int) -> np.ndarray:
    return np.frombuffer(b"".join(part[column].to_pylist()), kind).reshape(part.num_rows, *shape)


def _next(state: DataFrame, books: np.ndarray, moved: np.ndarray) -> DataFrame:
    parts, _, length = books.shape

    def assigned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, ROWS):
            x = _read(part, "x", "<i4", parts, length).astype(np.int64)
            codes, errors, n = reassign(x, books, moved, _read(part, "code", "u1", parts), _read(part, "errors", "<i8", parts))
            before = part["compared"].to_numpy()
            share = np.full(part.num_rows, n // part.num_rows)
            share[: n % part.num_rows] += 1
            yield pa.RecordBatch.from_arrays(
                [part["vec_id"], part["label"], part["x"], _binary(codes), _binary(errors.astype("<i8")),
                 pa.array(before + share)], names=["vec_id", "label", "x", "code", "errors", "compared"])

    return state.mapInArrow(assigned, state.schema)


def _moved_to(state: DataFrame, books: np.ndarray) -> np.ndarray:
    """The floor of the mean of each entry's parts; entries without parts as they are."""
    parts, entries, length = books.shape

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, any_rows = np.zeros((parts, entries, length + 1), np.int64), False
        for part in slices(batches, ROWS):
            x, codes, any_rows = _read(part, "x", "<i4", parts, length), _read(part, "code", "u1", parts), True
            for p in range(parts):
                np.add.at(sums[p, :, :length], codes[:, p], x[:, p])
                sums[p, :, length] += np.bincount(codes[:, p], minlength=entries)
        if any_rows:
            p, e, at = np.nonzero(sums)
            yield pa.RecordBatch.from_arrays([pa.array(v) for v in (p.astype("i4"), e.astype("i4"), at.astype("i4"), sums[p, e, at])],
                                             names=["part", "entry", "at", "total"])

    totals = np.zeros((parts, entries, length + 1), np.int64)
    tasks = state.select("x", "code").mapInArrow(summed, "part int, entry int, at int, total long")
    for r in tasks.groupBy("part", "entry", "at").agg(F.sum("total").alias("total")).toLocalIterator():
        totals[r["part"], r["entry"], r["at"]] = r["total"]
    counts = totals[:, :, length:]
    return np.where(counts > 0, totals[:, :, :length] // np.maximum(counts, 1), books)


def encode(vectors: DataFrame, entries: int = ENTRIES, parts: int = PARTS, scale: int = SCALE, rounds: int = ROUNDS,
           label: str = "label") -> tuple[DataFrame, np.ndarray]:
    """vec_id, label, x, code, errors and compared of every usable vector, and the codebooks (part, entry, component).

    ``code`` has one octet and ``errors`` one 64-bit distance for each part; ``compared``
    counts the entries that all rounds compared with the row's parts.
    """
    if not 0 < entries <= 256:
        raise ValueError("a code has one octet for each part")
    rows = usable(vectors, label)
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "vector").limit(entries).collect()
    length = len(first[0]["vector"]) if first else parts
    if length % parts:
        raise ValueError(f"{length} components cannot be cut into {parts} equal parts")
    starts = _whole(np.array([r["vector"] for r in first], np.float64).reshape(len(first), length), scale)
    books = starts.reshape(len(first), parts, length // parts).transpose(1, 0, 2)
    if not first:
        return _first(rows, np.zeros((parts, 1, 1), np.int64), scale), books
    state = materialise(_first(rows, books, scale), "assigned")
    for k in range(rounds):
        new = _moved_to(state, books)
        moved = (new != books).any(2)
        books = new
        state = materialise(_next(state, books, moved), "assigned")
    return state, books


def codes(vectors: DataFrame, **settings: int) -> DataFrame:
    """vec_id, code (hex), error, label_error and codebooks_sha256 of every usable vector."""
    state, books = encode(vectors, **settings)
    digest = hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()
    parts = books.shape[0]

    def with_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, ROWS):
            error = _read(part, "errors", "<i8", parts).sum(1)
            yield pa.RecordBatch.from_arrays([part["vec_id"], part["label"], part["code"], pa.array(error)],
                                             names=["vec_id", "label", "code", "error"])

    label = state.schema["label"].dataType.simpleString()
    rows = state.select("vec_id", "label", "code", "errors").mapInArrow(with_sums, f"vec_id long, label {label}, code binary, error long")
    rows = materialise(rows, "coded")
    sums = rows.groupBy("label").agg(F.sum("error").alias("label_error"), F.count("*").alias("n"))
    rows = look_up(rows, materialise(sums, "label-errors"), "label", "n")
    return rows.select("vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error", F.lit(digest).alias("codebooks_sha256"))
