"""Benchmark passages in documents, found by one Aho-Corasick automaton.

Words are maximal runs of ASCII letters (in lower case), digits and everything beyond
ASCII. A window is ten consecutive words of an item, or all words of a shorter one.
All windows of all items make one automaton over their normalised text; a document is
scanned once, and matches are mapped back to its words and to code points of the
original text.

The automaton is built in each Python worker from the distinct windows. Where these
exceed ``AUTOMATON_CHARS`` they make several, used one after another: the driver collects
and sends the windows of one, the documents are scanned and written with what was found
so far, and the next follows. Driver and workers hold one automaton at a time, whatever
the size of the benchmark, and no window is dropped.

Defined results: null and empty texts have no words and no hits; items without words
match nothing; equal items are all named; an item with a null id hits and contaminates,
but is neither named nor counted; an empty benchmark hits nothing; repeated documents
are answered each for itself.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wavecount.llm.common import slices, texts
from wavecount.session import materialise, remove

WINDOW = 10
#: Characters of windows in one automaton, and so the size of a broadcast.
AUTOMATON_CHARS = 8_000_000

#: Octets of the normalised text: lower case, and a space for every other ASCII sign.
_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 97 <= c <= 122 or 48 <= c <= 57 else 32 for c in range(256))


def normalised(text: str) -> bytes:
    """UTF-8 of the text, octet for octet, with every separator as a space."""
    return text.encode("utf-8", "surrogatepass").translate(_TABLE)


def item_windows(items: DataFrame, key: str = "item_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """Distinct (key, window) of every item; the window is its words joined by spaces, in latin-1 for octets."""
    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            found = set()
            for item, value in zip(part[key].to_pylist(), part[text].to_pylist(), strict=True):
                words = normalised(value).split()
                for at in range(max(1, len(words) - window + 1) if words else 0):
                    found.add((item, b" ".join(words[at : at + window])))
            yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in found], pa.string()),
                                              pa.array([w for _, w in found], pa.binary())], names=["item", "window"])

    named = items.select(F.col(key).cast("string").alias(key), F.coalesce(F.col(text), F.lit("")).alias(text))
    return named.mapInArrow(windows, "item string, window binary").distinct()


class _Scanner:
    def __init__(self, windows: list[tuple[bytes, list[str]]]):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for window, items in windows:
            words = f" {window.decode('latin-1')} "
            self.automaton.add_word(words, (len(words) - 2, items))
        self.automaton.make_automaton()

    def scan(self, text: str) -> tuple[int, list[tuple[int, int]], set[str]]:
        """Number of words, ranges of hit words, and the items hit."""
        words = normalised(text).split()
        if not words:
            return 0, [], set()
        ranges, items = [], set()
        joined = b" ".join(words)
        if len(self.automaton):
            starts = None
            for end, (size, names) in self.automaton.iter(f" {joined.decode('latin-1')} "):
                if starts is None:
                    spaces = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
                    starts = np.concatenate([[0], spaces + 1])
                # positions of the scanned text are one beyond those of the joined words
                first = int(np.searchsorted(starts, end - 1 - size, side="left"))
                last = int(np.searchsorted(starts, end - 2, side="right"))
                ranges.append((first, last))
                items.update(names)
        return len(words), ranges, items


def _merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for first, last in sorted(ranges):
        if out and first <= out[-1][1]:
            out[-1][1] = max(out[-1][1], last)
        else:
            out.append([first, last])
    return [(a, b) for a, b in out]


def original_spans(text: str, ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Code point spans in the original text of ranges of words."""
    octets = np.frombuffer(normalised(text), np.uint8)
    inside = np.concatenate([[False], octets != 32, [False]])
    starts = np.flatnonzero(inside[1:] & ~inside[:-1])
    ends = np.flatnonzero(~inside[1:] & inside[:-1])
    points = np.concatenate([[0], np.cumsum((octets & 0xC0) != 0x80)])
    return [(int(points[starts[a]]), int(points[ends[b - 1]])) for a, b in ranges]


_RANGES = "array<struct<first:int,last:int>>"
_SCANNED = f"doc_id long, text string, n_words long, ranges {_RANGES}, items array<string>"
_SCAN = f"doc_id long, n_words long, ranges {_RANGES}, spans array<struct<start:int,end:int>>, items array<string>"
_scanners: dict[str, _Scanner] = {}


class _Windows:
    """Distinct windows with their items, in parts of about ``limit`` characters each, of which one is sent at a time."""

    def __init__(self, docs: DataFrame, items: DataFrame, limit: int):
        self.context = docs.sparkSession.sparkContext
        windows = item_windows(items).groupBy("window").agg(F.sort_array(F.collect_set("item")).alias("items"))
        self.table = windows.withColumn("size", F.length("window") + 2)
        total = self.table.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
        self.parts = -(-total // limit) or 1
        if self.parts > 1:
            self.parts *= 2  # parts by hash are uneven
            self.table = materialise(self.table, "windows")

    def send(self, part: int) -> tuple:
        mine = self.table.where(F.pmod(F.xxhash64("window"), F.lit(self.parts)) == part)
        rows = [(bytes(r["window"]), r["items"]) for r in mine.select("window", "items").toLocalIterator()]
        return uuid.uuid4().hex, self.context.broadcast(rows)


def _ready(sent: tuple) -> _Scanner:
    """The automaton, built once in each Python worker, in place of the one before."""
    name, windows = sent
    if name not in _scanners:
        _scanners.clear()
        _scanners[name] = _Scanner(windows.value)
    return _scanners[name]


def _in_passes(docs: DataFrame, windows: _Windows, one: Callable[[DataFrame, tuple], DataFrame]) -> DataFrame:
    """``docs`` after a pass with each automaton; all but the last are written."""
    for part in range(windows.parts):
        sent = windows.send(part)
        before, docs = docs, one(docs, sent)
        if part + 1 < windows.parts:
            docs = materialise(docs, "scanned")
            sent[1].unpersist()
            if part:
                for folder in {f.rsplit("/", 1)[0] for f in before.inputFiles()[:1]}:
                    remove(docs.sparkSession, folder)
    return docs


def _ranges(rows: list[list[tuple[int, int]]]) -> list[list[dict]]:
    return [[{"first": a, "last": b} for a, b in row] for row in rows]


def scan(docs: DataFrame, items: DataFrame, automaton_chars: int = AUTOMATON_CHARS) -> DataFrame:
    """Per document: words, merged ranges of hit words, their spans in the original, and the items found."""
    kind = pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("n_words", pa.int64()),
                      ("ranges", pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))), ("items", pa.list_(pa.string()))])

    def one(table: DataFrame, sent: tuple) -> DataFrame:
        def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            scanner = _ready(sent)
            for part in slices(batches):
                rows = []
                for doc_id, text, _, ranges, found in zip(*(part[c].to_pylist() for c in kind.names), strict=True):
                    n, more, names = scanner.scan(text)
                    merged = _merged([(r["first"], r["last"]) for r in ranges] + more)
                    rows.append((doc_id, text, n, _ranges([merged])[0], sorted({*found, *names})))
                yield pa.RecordBatch.from_arrays([pa.array(c, kind.field(k).type) for k, c in enumerate(zip(*rows, strict=True))], schema=kind)

        return table.mapInArrow(scanned, _SCANNED)

    def with_spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        for part in slices(batches):
            spans = [[{"start": a, "end": b} for a, b in original_spans(t, [(x["first"], x["last"]) for x in r])] if r else []
                     for t, r in zip(part["text"].to_pylist(), part["ranges"].to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([part["doc_id"], part["n_words"], part["ranges"], pa.array(spans, span), part["items"]],
                                             names=["doc_id", "n_words", "ranges", "spans", "items"])

    rows = texts(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.lit(0).cast("long").alias("n_words"),
                              F.array().cast(_RANGES).alias("ranges"), F.array().cast("array<string>").alias("items"))
    return _in_passes(rows, _Windows(docs, items, automaton_chars), one).mapInArrow(with_spans, _SCAN)


def digest(scanned: DataFrame) -> DataFrame:
    """Counts and the digest of the items, as one row per document."""
    hit = F.aggregate("ranges", F.lit(0).cast("long"), lambda n, r: n + r["last"] - r["first"])
    rows = scanned.withColumn("n_hit", hit)
    return rows.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"), "spans")


def keep_clean(docs: DataFrame, items: DataFrame, automaton_chars: int = AUTOMATON_CHARS) -> DataFrame:
    """Documents in which no window of any item occurs, with all their columns, and without a shuffle of texts."""
    def one(table: DataFrame, sent: tuple) -> DataFrame:
        def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            scanner = _ready(sent)
            for part in slices(batches):
                yield part.filter(pa.array([not scanner.scan(v or "")[1] for v in part["text"].to_pylist()], pa.bool_()))

        return table.mapInArrow(clean, docs.schema)

    return _in_passes(docs, _Windows(docs, items, automaton_chars), one)
