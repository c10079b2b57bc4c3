"""Periodic runs of words, found by a dictionary of basic factors.

A run is a stretch of words with smallest period q, as long as it can be with that
period, and at least ``max(6, 4 * q)`` long.

For each power of two, all stretches of that many words get a name, made of the names of
their halves; a stretch that its document holds once can be in no period and is left
out, so what is looked at shrinks from level to level. Where the next occurrence of a
name follows within twice its length, and the one after that by the same distance, the
arithmetic progression proposes that distance as a period. A proposal is extended word
by word in both directions; what is long enough is a run, and of equal stretches the
smallest period counts.

Every run is proposed: with the first power of two L >= q a stretch of L words within
the run can only recur q words on (a smaller distance d would make the run's root equal
to its own rotation by d, so no root), L is less than 2 * q, and so the 4 * q words hold
the stretch three times in a row. A proposed multiple of the smallest period extends to
the same stretch, by Fine and Wilf's theorem.

Documents are named together, some ``WORDS`` words at a time and a longer one alone, with
names of their own, so that the arrays are large and the work per text small. It is a
map: nothing moves between tasks.

Defined results: null, empty and blank texts have no words and no runs; words are
compared octet by octet; repeated rows are answered each for itself; a null id is kept;
an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wavecount.llm.common import slices, texts

WORDS = 1 << 18
# The least length of a run, in words and in periods.
LEAST_WORDS = 6
LEAST_PERIODS = 4

Run = tuple[int, int, int]


def numbered(documents: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """A number for every word, equal for equal words of one document and different between documents; the documents' starts."""
    out, starts, base = [], np.zeros(len(documents) + 1, np.int64), 0
    for k, words in enumerate(documents):
        index = {w: base + i for i, w in enumerate(dict.fromkeys(words))}
        out.append(np.fromiter(map(index.__getitem__, words), np.int64, len(words)))
        base += len(index)
        starts[k + 1] = starts[k] + len(words)
    return (np.concatenate(out) if out else np.zeros(0, np.int64)), starts


def _named(keys: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places whose key occurs again, by key and then place, their names, and where in that order a name begins anew."""
    if not len(keys):
        return places, places, np.zeros(0, bool)
    order = np.argsort(keys, kind="stable")  # places rise, so they do within a key
    keys = keys[order]
    new = np.concatenate([[True], keys[1:] != keys[:-1]])
    again = ~new | ~np.concatenate([new[1:], [True]])
    names = np.cumsum(new)[again]
    return places[order[again]], names, new[again]


def proposals(numbers: np.ndarray, starts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places and distances of progressions, from the shortest stretches up; the first places of neighbouring ones alone."""
    n, length = len(numbers), 1
    ends = np.repeat(starts[1:], np.diff(starts))
    name_at = np.zeros(n, np.int64)  # 0: not looked at any more
    places, names, new = _named(numbers, np.arange(n))
    while len(places):
        name_at[:] = 0
        name_at[places] = names
        gap = np.zeros(n, np.int64)  # to the next occurrence
        follows = ~new[1:]
        gap[places[:-1][follows]] = (places[1:] - places[:-1])[follows]
        at = np.sort(places)
        d = gap[at]
        near = (d > 0) & (d <= 2 * length)
        at, d = at[near], d[near]
        steady = gap[at + d] == d
        at, d = at[steady], d[steady]
        if len(at):
            heads = np.concatenate([[True], (at[1:] != at[:-1] + 1) | (d[1:] != d[:-1])])
            yield at[heads], d[heads]
        held = np.flatnonzero(name_at[: n - length])
        held = held[(name_at[held + length] > 0) & (held + 2 * length <= ends[held])]
        both = name_at[held] * (n + 1) + name_at[held + length]
        length *= 2
        places, names, new = _named(both, held)


def _reach(left: np.ndarray, right: np.ndarray, most: int) -> int:
    """How many values from the front on are equal; looks at pieces of growing size."""
    done, size = 0, 32
    while done < most:
        end = min(most, done + size)
        differ = np.flatnonzero(left[done:end] != right[done:end])
        if len(differ):
            return done + int(differ[0])
        done, size = end, size * 4
    return most


def find_runs(numbers: np.ndarray, starts: np.ndarray) -> list[list[Run]]:
    """(start, length, period) of every run of each document, by start, then period."""
    found: dict[tuple[int, int, int], int] = {}
    known: dict[int, tuple[int, int]] = {}  # the last stretch of each distance
    for at, distance in proposals(numbers, starts):
        known.clear()
        docs = np.searchsorted(starts, at, "right") - 1
        for i, d, doc in zip(at.tolist(), distance.tolist(), docs.tolist(), strict=True):
            low, high = known.get(d, (0, 0))
            if low <= i < high:
                continue
            first, last = int(starts[doc]), int(starts[doc + 1])
            ahead = _reach(numbers[i : last - d], numbers[i + d : last], last - d - i)
            back = _reach(numbers[first:i][::-1], numbers[first + d : i + d][::-1], i - first)
            start, length = i - back, back + ahead + d
            known[d] = start, start + length - d
            if length >= max(LEAST_WORDS, LEAST_PERIODS * d):
                key = doc, start - first, length
                found[key] = min(d, found.get(key, d))
    out: list[list[Run]] = [[] for _ in range(len(starts) - 1)]
    for (doc, start, length), d in found.items():
        out[doc].append((start, length, d))
    for runs in out:
        runs.sort(key=lambda r: (r[0], r[2]))
    return out


def steadiest(runs: list[Run]) -> Run | None:
    """The run of most periods; ties to the smallest start, then period."""
    best = None
    for run in runs:  # by start, then period
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def collapsed(words: list[bytes], runs: list[Run]) -> list[bytes]:
    """The words without those that a run repeats after its first period."""
    if not runs:
        return words
    kept = np.ones(len(words), bool)
    for start, length, period in runs:
        kept[start + period : start + length] = False
    return [words[i] for i in np.flatnonzero(kept)]


def words_of(key: int | None, text: bytes) -> list[bytes]:
    return text.split()  # at the six characters [\x20\x09-\x0D]


def repeated_tail(key: int | None, text: bytes) -> list[bytes]:
    """Words of the text; one document in ten, by its id, goes on by repeating a part of it to its end."""
    words = text.split()
    h = 1 if key is None else zlib.crc32(str(key).encode())
    if h % 10 or not words:
        return words
    n, g = len(words), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return (words[: a + p] + words[a : a + p] * ((n - a) // p))[:n]


def runs(docs: DataFrame, words: Callable[[int | None, bytes], list[bytes]] = words_of, batch: int = WORDS) -> DataFrame:
    """doc_id, the runs (start, length, period) and the collapsed text, by single spaces, of every document."""
    rows = texts(docs)
    key_type = rows.schema["doc_id"].dataType.simpleString()
    run = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def answered(keys: list[pa.Array], documents: list[list[bytes]]) -> Iterator[pa.RecordBatch]:
        found = find_runs(*numbered(documents))
        values = [[dict(zip(("start", "length", "period"), r, strict=True)) for r in rs] for rs in found]
        short = [b" ".join(collapsed(w, rs)) for w, rs in zip(documents, found, strict=True)]
        yield pa.RecordBatch.from_arrays([pa.concat_arrays(keys), pa.array(values, run), pa.array(short, pa.binary()).cast(pa.string())],
                                         names=["doc_id", "runs", "text"])

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, documents, held = [], [], 0
        for part in slices(batches):
            own = part["doc_id"].to_pylist()
            at = 0
            for k, (key, text) in enumerate(zip(own, part["text"].cast(pa.binary()).to_pylist(), strict=True)):
                documents.append(words(key, text))
                held += len(documents[-1])
                if held >= batch:
                    yield from answered([*keys, part["doc_id"].slice(at, k + 1 - at)], documents)
                    keys, documents, held, at = [], [], 0, k + 1
            keys.append(part["doc_id"].slice(at))
        if documents:
            yield from answered(keys, documents)

    return rows.mapInArrow(mapped, f"doc_id {key_type}, runs array<struct<start:long,length:long,period:long>>, text string")


def digest(found: DataFrame) -> DataFrame:
    """Number of runs, the steadiest one, and digests of all runs and of the collapsed text."""
    key_type = found.schema["doc_id"].dataType.simpleString()
    schema = (f"doc_id {key_type}, n_runs long, start long, length long, period long, exponent_milli long, "
              "runs_sha256 string, collapsed_sha256 string")

    def digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            rows = [[(r["start"], r["length"], r["period"]) for r in rs] for rs in part["runs"].to_pylist()]
            best = [steadiest(rs) for rs in rows]
            columns = [[len(rs) for rs in rows], *([b and b[k] for b in best] for k in range(3)), [b and 1000 * b[1] // b[2] for b in best]]
            lines = ["".join(f"{s},{n},{q}\n" for s, n, q in rs) for rs in rows]
            shas = [[hashlib.sha256(t.encode()).hexdigest() for t in lines],
                    [hashlib.sha256(t).hexdigest() for t in part["text"].cast(pa.binary()).to_pylist()]]
            yield pa.RecordBatch.from_arrays(
                [part["doc_id"], *(pa.array(c, pa.int64()) for c in columns), *(pa.array(s, pa.string()) for s in shas)],
                names=["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"])

    return found.mapInArrow(digested, schema)
