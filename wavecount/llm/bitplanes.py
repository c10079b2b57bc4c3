"""Token ids as bit planes.

Ids are cut into blocks of a fixed number, each block is transposed into bit planes
(the bits of weight 1 of all ids, then those of weight 2, and so on up to the highest
bit in use), and every plane is compressed with zstandard. The high planes of usual
ids are nearly constant, so they all but vanish.

A written data set is a folder of Parquet files, which Spark commits whole or not at
all; one row is one block: its place (``shard``, ``chunk``), the offset of its first
id in the shard, its planes and the documents whose ids it holds. The columns without
the planes are the chunk index; a reader finds the blocks of an id range in it and
reads these alone. Shards follow each other in ascending document id.

Defined results: a null text is an empty one; rows with the same id stay apart, in
any order among themselves; a null id sorts first; an empty table gives no blocks.
"""

from __future__ import annotations

import gc
import json
import os
import unicodedata
import zlib
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wavecount.llm.common import slices, texts
from wavecount.session import new_workdir

#: Ids of one block.
BLOCK = 65_536
#: Words a worker remembers the ids of, with at most eight ids to a word in the mean;
#: beyond that it forgets the older half, results are the same.
CACHED_WORDS = 800_000
#: Octets of text that are encoded at once; a longer text is encoded alone.
ENCODED_OCTETS = 4 << 20
#: New words that the library gets as one text, and those that are then remembered together.
JOINED_WORDS, LEARNED_WORDS = 64, 16_384

_BLOCKS = ("shard int, chunk int, first_id long, n_ids int, first_doc long, continued boolean, open boolean, "
           "doc_ids array<long>, lengths array<int>, planes array<binary>")
_SEGMENTS = "shard int, doc long, doc_id long, first_id long, n long, crc long"


def to_planes(ids: np.ndarray, compress) -> list[bytes]:
    """Compressed planes of unsigned ids, lowest bit first."""
    bits = max(1, int(ids.max()).bit_length()) if len(ids) else 0
    return [compress(np.packbits((ids & ids.dtype.type(1 << k)).astype(bool)).tobytes()) for k in range(bits)]


def from_planes(planes: list[bytes], n_ids: int, decompress) -> np.ndarray:
    ids = np.zeros(n_ids, dtype="<u4")
    for k, plane in enumerate(planes):
        ids |= np.unpackbits(np.frombuffer(decompress(plane), np.uint8), count=n_ids).astype("<u4") << np.uint32(k)
    return ids


#: What the byte-level pre-tokenizer tells apart, and characters it may know and Python's tables do not.
_WHITE, _LETTER, _NUMBER, _OTHER, _UNSURE = range(5)
#: Fixed value: the short endings that it cuts off after an apostrophe.
_ENDINGS = ("s", "d", "m", "t"), ("ll", "ve", "re")


def _kinds() -> np.ndarray:
    """The kind of every code point."""
    kinds = np.full(0x110000, _UNSURE, np.uint8)
    of = {"L": _LETTER, "N": _NUMBER, "Z": _WHITE}
    names = map(unicodedata.category, map(chr, range(0x30000)))
    kinds[:0x30000] = [_UNSURE if name == "Cn" else of.get(name[0], _OTHER) for name in names]
    kinds[[*range(9, 14), 0x85]] = _WHITE
    return kinds


def _byte_signs() -> np.ndarray:
    """Fixed value: the code point that stands for each octet in a byte-level vocabulary."""
    signs = np.arange(256, dtype="<u2")
    hidden = [*range(33), *range(127, 161), 173]
    signs[hidden] = 256 + np.arange(len(hidden))
    return signs


def _among(found: np.ndarray, wanted: tuple[str, ...]) -> np.ndarray:
    """Which rows of code points are one of these strings."""
    return (found[:, None] == [[ord(c) for c in w] for w in wanted]).all(2).any(1)


def _cut(values: pa.Array, kinds: np.ndarray, added: list[str]) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The parts of all texts, one after another, as the pre-tokenizer cuts them; which are whole words that it must
    cut itself; and for each text the number of parts before it, with the number of all parts at the end.

    All borders are found at once from the kinds of neighbouring characters. A word is
    what lies between two single spaces that touch no white space, where the
    pre-tokenizer always cuts; one with an unsure character or an added token stays whole.
    """
    values = values.cast(pa.large_string())
    _, ends, octets = values.buffers()
    ends = np.frombuffer(ends, np.int64)[values.offset : values.offset + len(values) + 1]
    octets = np.frombuffer(octets or b"", np.uint8)[ends[0] : ends[-1]]
    ends = ends - ends[0]
    text = octets.tobytes().decode()
    if text.isascii():
        points, at = octets, None  # a character and the octet it begins at are the same
    else:
        points, at = np.frombuffer(text.encode("utf-32-le"), "<u4"), np.flatnonzero((octets & 0xC0) != 0x80)
        ends = np.searchsorted(at, ends)
    n, kind = len(points), kinds[points]
    first = np.zeros(n + 1, bool)  # of a text; also the place after the last
    first[ends], first[n] = True, True
    inner = ~first[1:n]  # places from the second, with a neighbour before them
    space, white = points == 32, kind == _WHITE
    begin = first.copy()
    after = inner & white[:-1] & ~white[1:]  # the last white space of some goes with what follows, if it is a space
    begin[1:n] |= (kind[1:] != kind[:-1]) & ~(after & space[:-1])
    begin[: max(n - 1, 0)] |= after
    for wanted in _ENDINGS:
        size = len(wanted[0])
        mark = np.flatnonzero((points == 39) & begin[:n])
        mark = mark[mark + size < n]
        following = mark[:, None] + np.arange(1, size + 1)
        mark = mark[_among(points[following], wanted) & ~first[following].any(1)]
        begin[mark + 1], begin[mark + size + 1] = False, True
    unsure = np.flatnonzero(kind == _UNSURE).tolist()
    for token in added:
        place = text.find(token)
        while place >= 0:
            if not first[place + 1 : place + len(token)].any():
                unsure.append(place)
            place = text.find(token, place + 1)
    whole = np.zeros(n, bool)
    if unsure:
        border = first[:n].copy()
        border[1 : n - 1] |= space[1:-1] & ~(white[:-2] | white[2:]) & inner[:-1] & inner[1:]
        word = np.cumsum(border) - 1
        whole = np.isin(word, np.unique(word[unsure]), kind="table")
        begin[:n] &= ~whole | border
    starts = np.flatnonzero(begin[:n])
    places = np.append(starts if at is None else at[starts], len(octets))
    parts = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(places), pa.py_buffer(octets))
    return parts, whole[starts], np.searchsorted(starts, ends)


class _Ragged:
    """Sequences of ids, numbered as they are added, in one array."""

    def __init__(self, kind: np.dtype):
        self.ids, self.ends, self.n, self.held = np.zeros(1 << 16, kind), np.zeros(1 << 14, np.int64), 0, 0

    def add(self, ids: np.ndarray, lengths: np.ndarray) -> range:
        """Numbers of the new sequences, which lie one after another in ``ids``."""
        held, n = self.held + len(ids), self.n + len(lengths)
        if held > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros(held, self.ids.dtype)])
        if n >= len(self.ends):
            self.ends = np.concatenate([self.ends, np.zeros(n + 1, np.int64)])
        self.ids[self.held : held] = ids
        self.ends[self.n + 1 : n + 1] = self.held + np.cumsum(lengths)
        new, self.n, self.held = range(self.n, n), n, held
        return new

    def lengths(self, numbers: np.ndarray) -> np.ndarray:
        return self.ends[numbers + 1] - self.ends[numbers]

    def take(self, numbers: np.ndarray) -> np.ndarray:
        """The ids of the sequences one after another."""
        lengths = self.lengths(numbers)
        before = np.cumsum(lengths) - lengths
        return self.ids[np.repeat(self.ends[numbers] - before, lengths) + np.arange(lengths.sum())]

    def drop(self, n: int) -> None:
        """The first ``n`` sequences go; the numbers of the others fall by ``n``."""
        kept = _Ragged(self.ids.dtype)
        kept.add(self.ids[self.ends[n] : self.held], np.diff(self.ends[n : self.n + 1]))
        self.__dict__ = kept.__dict__


class _Words:
    """Ids of whole texts, encoded by the library part by part and remembered.

    The texts of a slice are cut at once as the byte-level pre-tokenizer cuts them, and
    the different parts are looked up once. New ones are given to the library, many as
    one text: their octets stand as the signs of the vocabulary, with the sign of an
    octet between them that UTF-8 does not use and no merge touches, so that it merges
    each part as if alone and needs not cut again. Vocabularies without such a sign get
    the parts one by one. Words with an added token or with characters that Python's
    tables do not know, as the tables of readers of Unicode differ there, and other
    kinds of tokenizers are left to the library as they are.
    """

    def __init__(self, tokenizer_json: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self.kind = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.known: dict[str, int] = {}
        self.held = _Ragged(self.kind)
        made = json.loads(tokenizer_json)
        cutter = made["pre_tokenizer"] or {}
        self.added = [t["content"] for t in made["added_tokens"]]
        self.by_word = (
            cutter.get("type") == "ByteLevel" and cutter["use_regex"] and not cutter["add_prefix_space"] and not made["normalizer"]
            and not any(t["lstrip"] or t["rstrip"] or " " in t["content"] for t in made["added_tokens"]))
        if self.by_word:
            self.kinds, self.signs = _kinds(), _byte_signs()
            self.between = self._unused_octet(made["model"])
            alone = cutter | {"use_regex": False} if self.between is None else None
            self.merger = Tokenizer.from_str(json.dumps(made | {"pre_tokenizer": alone, "added_tokens": [], "post_processor": None}))

    def _unused_octet(self, model: dict) -> bytes | None:
        """An octet of no UTF-8 text whose sign is in the vocabulary and in no merge."""
        if model["type"] != "BPE" or any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges")):
            return None
        signs = [chr(c) for c in self.signs]
        if not all(c in model["vocab"] for c in signs):
            return None
        merged = set("".join(map("".join, model["merges"])))
        return next((bytes([k]) for k in (0xFF, 0xFE, *range(0xF5, 0xFE), 0xC0, 0xC1) if signs[k] not in merged), None)

    def _remember(self, words: list[str], ids: np.ndarray, lengths: np.ndarray) -> None:
        self.known.update(zip(words, self.held.add(ids, lengths), strict=True))

    def _signs(self, octets: bytes) -> str:
        return self.signs[np.frombuffer(octets, np.uint8)].tobytes().decode("utf-16-le")

    def _merge(self, words: list[str]) -> None:
        """New parts, which the pre-tokenizer does not cut."""
        if self.between is None:
            return self._whole(words, self.merger)
        end = self.merger.token_to_id(self._signs(self.between))
        for at in range(0, len(words), LEARNED_WORDS):
            some, found = words[at : at + LEARNED_WORDS], []
            for k in range(0, len(some), JOINED_WORDS):
                joined = self._signs(self.between.join(map(str.encode, some[k : k + JOINED_WORDS])))
                found += self.merger.encode_batch_fast([joined], add_special_tokens=False)[0].ids
                found.append(end)
            ids = np.array(found, self.kind)
            is_end = ids == end
            self._remember(some, ids[~is_end], np.diff(np.flatnonzero(is_end), prepend=-1) - 1)

    def _whole(self, words: list[str], tokenizer) -> None:
        """New words that the library gets one by one."""
        found = [e.ids for e in tokenizer.encode_batch_fast(words, add_special_tokens=False)]
        self._remember(words, np.array([i for ids in found for i in ids], self.kind), np.array([len(ids) for ids in found], np.int64))

    def _forget(self) -> None:
        while len(self.known) > CACHED_WORDS or self.held.held > 8 * CACHED_WORDS:
            old = (len(self.known) + 1) // 2
            self.known = {w: number - old for w, number in self.known.items() if number >= old}
            self.held.drop(old)

    def encode(self, values: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another and their numbers."""
        if not self.by_word:
            encoded = [e.ids for e in self.tokenizer.encode_batch_fast(values.to_pylist(), add_special_tokens=False)]
            return np.array([i for ids in encoded for i in ids], self.kind), np.array([len(ids) for ids in encoded], np.int64)
        if not (pc.binary_length(values).to_numpy(zero_copy_only=False) > ENCODED_OCTETS).any():
            return self._encode(values)
        found = [[self._encode(pa.array([piece], pa.string()))[0] for piece in self._pieces(v)] for v in values.to_pylist()]
        return np.concatenate([ids for pieces in found for ids in pieces]), np.array([sum(map(len, pieces)) for pieces in found], np.int64)

    def _pieces(self, text: str) -> Iterator[str]:
        """A long text bit by bit, cut before single spaces that touch no white space; without such it is one."""
        at, least = 0, max(1, ENCODED_OCTETS // 4)
        while len(text) - at > least:
            to = text.find(" ", at + least)
            while 0 < to and (to + 1 == len(text) or _WHITE in (self.kinds[ord(text[to - 1])], self.kinds[ord(text[to + 1])])):
                to = text.find(" ", to + 1)
            if to <= 0:
                break
            yield text[at:to]
            at = to
        yield text[at:]

    def _encode(self, values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        self._forget()
        parts, whole, before = _cut(values, self.kinds, self.added)
        coded = parts.dictionary_encode()
        words, codes = coded.dictionary.to_numpy(zero_copy_only=False).tolist(), np.asarray(coded.indices)
        alone = np.zeros(len(words), bool)
        alone[codes[whole]] = True
        found = list(map(self.known.get, words))
        fresh = [k for k, number in enumerate(found) if number is None]
        self._merge([words[k] for k in fresh if not alone[k]])
        self._whole([words[k] for k in fresh if alone[k]], self.tokenizer)
        for k in fresh:
            found[k] = self.known[words[k]]
        numbers = np.array(found, np.int64)[codes]
        ends = np.concatenate([[0], np.cumsum(self.held.lengths(numbers))])
        return self.held.take(numbers), np.diff(ends[before])


_encoders: dict[int, _Words] = {}


def _encoder(tokenizer_json: str) -> _Words:
    """The encoder of this Python worker; as a function of the module it is found there and not sent with each task."""
    key = zlib.crc32(tokenizer_json.encode())
    return _encoders.get(key) or _encoders.setdefault(key, _Words(tokenizer_json))


class _Blocks:
    """Cuts a shard's documents into blocks; holds one block and one document."""

    def __init__(self, shard: int, block: int):
        self.shard, self.block, self.chunk, self.first_id, self.doc = shard, block, 0, 0, 0
        self.compress = zstandard.ZstdCompressor(level=1).compress
        self._start(False)

    def _start(self, continued: bool) -> None:
        self.ids, self.held, self.doc_ids, self.lengths = [], 0, [], []
        self.continued, self.first_doc = continued, self.doc

    def _cut(self, is_open: bool) -> dict:
        ids = np.concatenate(self.ids)
        row = {"shard": self.shard, "chunk": self.chunk, "first_id": self.first_id, "n_ids": len(ids),
               "first_doc": self.first_doc, "continued": self.continued, "open": is_open,
               "doc_ids": self.doc_ids, "lengths": self.lengths, "planes": to_planes(ids, self.compress)}
        self.chunk, self.first_id = self.chunk + 1, self.first_id + len(ids)
        return row

    def add(self, doc_id: int | None, ids: np.ndarray) -> Iterator[dict]:
        at = 0
        while True:
            take = min(len(ids) - at, self.block - self.held)
            self.ids.append(ids[at : at + take])
            self.doc_ids.append(doc_id)
            self.lengths.append(take)
            self.held, at = self.held + take, at + take
            more = at < len(ids)
            if self.held == self.block:
                row = self._cut(more)
                if not more:
                    self.doc += 1
                self._start(more)
                yield row
            elif not more:
                self.doc += 1
            if not more:
                return

    def end(self) -> Iterator[dict]:
        if self.held:
            yield self._cut(False)


def _by_octets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Slices of at most ``ENCODED_OCTETS`` of text, or of one row."""
    for batch in batches:
        ends, at = np.cumsum(pc.binary_length(batch["text"]).to_numpy(zero_copy_only=False), dtype=np.int64), 0
        while at < len(ends):
            limit = ENCODED_OCTETS + (ends[at - 1] if at else 0)
            to = max(at + 1, int(np.searchsorted(ends, limit, "right")))
            yield batch.slice(at, to - at)
            at = to


def write_planes(docs: DataFrame, path: str, tokenizer_json: str, end_id: int = 0, block: int = BLOCK) -> DataFrame:
    """Encode whole texts, append ``end_id`` to each, write them to ``path`` in ascending id; returns the data set."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(tokenizer_json)
    schema = spark.createDataFrame([], _BLOCKS).schema

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        kind = to_arrow_schema(schema)
        words = _encoder(shared.value)
        out = _Blocks(TaskContext.get().partitionId(), block)
        end = np.array([end_id], words.kind)
        gc.disable()  # nothing here is cyclic, and the remembered words are many
        try:
            for part in _by_octets(batches):
                ids, lengths = words.encode(part["text"])
                ends = np.cumsum(lengths)
                for doc_id, to, n in zip(part["doc_id"].to_pylist(), ends.tolist(), lengths.tolist(), strict=True):
                    for row in out.add(doc_id, np.concatenate([ids[to - n : to], end])):
                        yield pa.RecordBatch.from_pylist([row], schema=kind)
            for row in out.end():
                yield pa.RecordBatch.from_pylist([row], schema=kind)
        finally:
            gc.enable()

    ordered = texts(docs).repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    ordered.mapInArrow(blocks, schema).write.option("compression", "none").parquet(path)
    return spark.read.schema(schema).parquet(path)


def shard_starts(chunks: DataFrame) -> DataFrame:
    """From the chunk index: the ids before each shard. One row per shard, as many as write tasks."""
    totals = chunks.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    before = F.sum("n").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    return totals.select("shard", F.coalesce(before, F.lit(0)).alias("shard_start"))


_POLY = 0xEDB88320  # fixed value: the reversed polynomial of crc32


def _times(a: int, b: int) -> int:
    """Product of two polynomials modulo the crc's, bits reversed."""
    out = 0
    for k in range(31, -1, -1):
        if a >> k & 1:
            out ^= b
        b = b >> 1 ^ (_POLY if b & 1 else 0)
    return out


def joined_crc(parts: list[tuple[int, int]]) -> int:
    """Crc32 of a whole from (octets, crc32) of its parts in order."""
    crc = 0
    for octets, part in parts:
        power, base, n = 1 << 31, 1 << 30, octets * 8  # x to the 0, x to the 1
        while n:
            if n & 1:
                power = _times(power, base)
            base, n = _times(base, base), n >> 1
        crc = _times(crc, power) ^ part
    return crc


def read_documents(chunks: DataFrame) -> DataFrame:
    """Decode every block; per document its place, number and crc32 of ids.

    A document cut by block borders is put together from the crcs of its parts, so no
    task ever needs a whole document or shard.
    """
    spark = chunks.sparkSession

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decompress = zstandard.ZstdDecompressor().decompress
        for part in slices(batches, 1):
            row = part.to_pylist()[0]
            ids = from_planes(row["planes"], row["n_ids"], decompress)
            ends = list(accumulate(row["lengths"]))
            n = len(ends)
            crcs = [zlib.crc32(ids[e - k : e].tobytes()) for e, k in zip(ends, row["lengths"], strict=True)]
            yield pa.RecordBatch.from_arrays([
                pa.array([row["shard"]] * n, pa.int32()), pa.array(range(row["first_doc"], row["first_doc"] + n), pa.int64()),
                pa.array(row["doc_ids"], pa.int64()),
                pa.array([row["first_id"] + e - k for e, k in zip(ends, row["lengths"], strict=True)], pa.int64()),
                pa.array(row["lengths"], pa.int64()), pa.array(crcs, pa.int64()),
            ], names=["shard", "doc", "doc_id", "first_id", "n", "crc"])

    @F.pandas_udf("long")
    def whole_crc(sizes: pd.Series, crcs: pd.Series) -> pd.Series:
        return pd.Series([int(c[0]) if len(c) == 1 else joined_crc([(4 * int(a), int(b)) for a, b in zip(s, c, strict=True)])
                          for s, c in zip(sizes, crcs, strict=True)], dtype="int64")

    planes = chunks.select("shard", "first_id", "n_ids", "first_doc", "doc_ids", "lengths", "planes")
    parts = planes.mapInArrow(segments, spark.createDataFrame([], _SEGMENTS).schema)
    docs = parts.groupBy("shard", "doc").agg(
        F.first("doc_id").alias("doc_id"), F.min("first_id").alias("first_id"), F.sum("n").alias("n_tokens"),
        F.sort_array(F.collect_list(F.struct("first_id", "n", "crc"))).alias("parts"))
    return docs.join(shard_starts(chunks), "shard").select(
        "doc_id", (F.col("shard_start") + F.col("first_id")).alias("start"), "n_tokens",
        whole_crc(F.col("parts.n"), F.col("parts.crc")).alias("ids_crc32"))


def round_trip(spark: SparkSession, docs: DataFrame, tokenizer_path: str, end_id: int = 0) -> DataFrame:
    """Write the documents to a new folder of the shared one and read them back."""
    with open(tokenizer_path, encoding="utf-8") as f:
        tokenizer_json = f.read()
    chunks = write_planes(docs, new_workdir(spark, "bit-planes"), tokenizer_json, end_id)
    return read_documents(chunks)
