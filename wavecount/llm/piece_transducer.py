"""SentencePiece encoding as a weighted finite-state transducer.

A model is compiled into three machines. The normaliser rewrites the longest matches of
the model's character map, folds spaces where the model asks for it, writes marks for
spaces and adds the leading one. The piece transducer reads characters and writes a
piece, with an arc from every position to every position that a piece reaches, weighted
by the negated score; a character without a piece is written as its bytes. For merge
models (BPE) a third machine accepts only pieces that may follow each other: a pair may
stand side by side if merging its joined characters ends in just this pair. A sequence
all of whose neighbours may is the one that merging yields. Encoding composes an input
with these machines lazily and takes the shortest path in the tropical semiring (costs
add along a path, the least one wins).

With the pair machine every position has one state that can be reached, and one path is
accepted: it is searched with the longest arcs first, and a position that led nowhere is
not entered again. (That holds where pieces rank after the pieces they are merged from,
as in trained models; of others the first such path is taken, or what merging the whole
gives if there is none.) Without it (unigram models) all arcs are relaxed in order; costs add
in double precision, and of equal ones the path with the longer last piece wins.

The composed machine falls apart wherever no piece spans two neighbouring characters:
before marks, and between characters of kinds that no piece joins. The parts are solved
once per task and remembered.

Defined results: null and empty texts have no pieces; decoding gives back the text the
normaliser read, octet for octet; each row is answered for itself.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import cached_property
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wavecount.llm.common import slices, texts

MARK = "▁"
#: Words, their parts, and pairs of pieces, that a task remembers; beyond that it forgets the older half of them.
CACHED = 200_000


class CharacterMap:
    """Rewrites of a model's character map, longest match first.

    The map is a table of transitions over octets (a double array), followed by the
    replacements, each ended by a zero.
    """

    def __init__(self, blob: bytes):
        size = int.from_bytes(blob[:4], "little")
        self.units = np.frombuffer(blob[4 : 4 + size], "<u4").tolist()
        self.replacements = blob[4 + size :]

    @staticmethod
    def _offset(unit: int) -> int:
        return unit >> 10 << ((unit >> 9 & 1) << 3)

    def longest(self, octets: bytes, at: int) -> tuple[int, bytes] | None:
        """How many octets match from ``at`` on, and what replaces them."""
        units, best, place = self.units, None, 0
        unit = units[0]
        for k in range(at, len(octets)):
            place ^= self._offset(unit) ^ octets[k]
            if place >= len(units) or units[place] & 0x800000FF != octets[k]:
                break
            unit = units[place]
            if unit >> 8 & 1:
                best = k + 1 - at, units[place ^ self._offset(unit)] & 0x7FFFFFFF
        if best is None:
            return None
        start = best[1]
        return best[0], self.replacements[start : self.replacements.index(b"\0", start)]

    def rewrite(self, text: str) -> str:
        octets, out, at = text.encode("utf-8", "surrogatepass"), [], 0
        while at < len(octets):
            if found := self.longest(octets, at):
                at, piece = at + found[0], found[1]
            else:
                first = octets[at]
                size = 1 if first < 0xC0 else 2 if first < 0xE0 else 3 if first < 0xF0 else 4
                piece, at = octets[at : at + size], at + size
            out.append(piece)
        return b"".join(out).decode("utf-8", "replace")


class Transducer:
    """The compiled machines of one model file."""

    def __init__(self, model: bytes):
        from sentencepiece import sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(model)
        self.map = CharacterMap(proto.normalizer_spec.precompiled_charsmap) if proto.normalizer_spec.precompiled_charsmap else None
        self.fold = proto.normalizer_spec.remove_extra_whitespaces
        kinds = sentencepiece_model_pb2.ModelProto.SentencePiece
        self.merges = proto.trainer_spec.model_type == sentencepiece_model_pb2.TrainerSpec.BPE
        self.prefix = proto.normalizer_spec.add_dummy_prefix
        self.cost, self.ids, self.octets, self.unknown = {}, {}, [b"?"] * len(proto.pieces), 0
        byte_ids = {}
        for k, piece in enumerate(proto.pieces):
            if piece.type in (kinds.NORMAL, kinds.USER_DEFINED):
                self.cost[piece.piece], self.ids[piece.piece] = -piece.score, k
                self.octets[k] = piece.piece.replace(MARK, " ").encode()
            elif piece.type == kinds.BYTE:
                byte_ids[int(piece.piece[3:5], 16)] = k
                self.octets[k] = bytes([int(piece.piece[3:5], 16)])
            elif piece.type == kinds.UNKNOWN:
                self.unknown = k
            else:
                self.octets[k] = b""
        self.bytes = byte_ids if len(byte_ids) == 256 else {}
        self.longest = max(map(len, self.cost), default=1)
        self.split = not any(MARK in p.lstrip(MARK) for p in self.cost)
        self.kind = np.dtype("<u2" if len(proto.pieces) <= 1 << 16 else "<u4")
        self.reach: dict[str, int] = {}  # the longest piece that begins with two characters
        for piece in self.cost:
            self.reach[piece[:2]] = max(len(piece), self.reach.get(piece[:2], 1))
        self.parts = re.compile(self._kinds(), re.DOTALL)
        self.words: dict[str, bytes] = {}
        self.solved: dict[str, bytes] = {}
        self.pairs: dict[tuple[str, str], bool] = {}
        self.shorter: dict[str, str | None] = {}

    def _kinds(self) -> str:
        """A pattern of the parts of a word: characters of one kind, with the marks before them.

        Characters that stand side by side in a piece are of one kind.
        """
        kind: dict[str, str] = {}

        def find(c: str) -> str:
            while kind.setdefault(c, c) != c:
                kind[c] = c = kind[kind[c]]
            return c

        for piece in self.cost:
            plain = piece.replace(MARK, "")
            for a, b in zip(plain, plain[1:], strict=False):
                kind[find(a)] = find(b)
        members: dict[str, list[str]] = {}
        for c in list(kind):
            members.setdefault(find(c), []).append(re.escape(c))
        runs = [f"[{''.join(m)}]+" for m in sorted(members.values(), key=len, reverse=True)]
        return f"{MARK}*(?:{'|'.join([*runs, '.'])})"

    @cached_property
    def unknown_cost(self) -> float:
        return max(self.cost.values(), default=0.0) + 10.0

    def read(self, text: str) -> str:
        """The text that is encoded: rewritten and folded."""
        if self.map:
            text = self.map.rewrite(text)
        return re.sub(" +", " ", text).strip(" ") if self.fold else text

    def normalise(self, text: str) -> str:
        return (MARK if self.prefix and text else "") + text.replace(" ", MARK)

    def _merge(self, text: str, border: int | None = None) -> list[str]:
        """What merging the characters ends in; nothing, if it merges across the border."""
        never, get, parts = float("inf"), self.cost.get, list(text)
        costs = [get(a + b, never) for a, b in zip(parts, parts[1:], strict=False)]
        left = border or 0  # parts before the border
        while costs and (least := min(costs)) < never:
            at = costs.index(least)
            if at + 1 == left:
                return []
            left -= at + 1 < left
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del costs[at]
            if at:
                costs[at - 1] = get(parts[at - 1] + parts[at], never)
            if at < len(costs):
                costs[at] = get(parts[at] + parts[at + 1], never)
        return parts

    def _may_follow(self, left: str, right: str) -> bool:
        """Whether merging the characters of both ends in just these two; of one, at the beginning, in just this."""
        key = (left, right)
        if (known := self.pairs.get(key)) is None:
            self.pairs[key] = known = self._merge(left + right, len(left) or None) == ([left, right] if left else [right])
        return known

    def _longest(self, word: str, at: int) -> str:
        """The longest arc from a position."""
        for size in range(min(self.reach.get(word[at : at + 2], 1), len(word) - at), 1, -1):
            if (piece := word[at : at + size]) in self.cost:
                return piece
        return word[at]

    def _shorter(self, piece: str) -> str | None:
        """The next shorter arc from the same position."""
        if piece not in self.shorter:
            sizes = range(len(piece) - 1, 0, -1)
            self.shorter[piece] = next((piece[:k] for k in sizes if k == 1 or piece[:k] in self.cost), None)
        return self.shorter[piece]

    def _merged(self, word: str) -> list[str]:
        """The one path that the pair machine accepts."""
        path: list[str] = []
        at, size, dead, piece = 0, len(word), set(), self._longest(word, 0)
        while True:
            while piece is not None and (at + len(piece) in dead or not self._may_follow(path[-1] if path else "", piece)):
                piece = self._shorter(piece)
            if piece is None and not path:
                return self._merge(word)
            if piece is None:
                dead.add(at)
                piece = path.pop()
                at -= len(piece)
                piece = self._shorter(piece)
                continue
            path.append(piece)
            at += len(piece)
            if at == size:
                return path
            piece = self._longest(word, at)

    def shortest_path(self, word: str) -> list[str]:
        """Pieces of the best path through the composed machine."""
        if self.merges:
            return self._merged(word)
        cost, size = self.cost, len(word)
        total, last = [0.0] + [float("inf")] * size, [""] * (size + 1)
        for end in range(1, size + 1):
            for start in range(max(0, end - self.longest), end):
                piece = word[start:end]
                weight = cost.get(piece)
                if weight is None:
                    if end - start > 1:
                        continue
                    weight = self.unknown_cost
                if total[start] + weight < total[end]:
                    total[end], last[end] = total[start] + weight, piece
        path, at = [], size
        while at:
            path.append(last[at])
            at -= len(last[at])
        return path[::-1]

    def _solve(self, word: str) -> bytes:
        out: list[int] = []
        for piece in self.shortest_path(word):
            if (k := self.ids.get(piece)) is not None:
                out.append(k)
            elif self.bytes:
                out += [self.bytes[b] for b in piece.encode("utf-8", "surrogatepass")]
            else:
                out.append(self.unknown)
        return np.array(out, self.kind).tobytes()

    def _word(self, word: str) -> bytes:
        solved, parts = self.solved, self.parts.findall(word)
        for part in parts:
            if part not in solved:
                solved[part] = self._solve(part)
        return b"".join([solved[p] for p in parts])

    def _forget(self) -> None:
        for known in (self.words, self.solved, self.pairs):
            if len(known) > CACHED:
                for key in list(islice(known, len(known) // 2)):
                    del known[key]

    def encode(self, text: str) -> np.ndarray:
        text = self.read(text) if self.map or self.fold else text
        if not text:
            return np.zeros(0, self.kind)
        if not self.split:
            return self._joined(self._solve(self.normalise(text)))
        if self.prefix and "  " not in text and MARK not in text and text[0] != " " and text[-1] != " ":
            words = text.split(" ")  # each of these has one mark before it
        else:
            words = re.findall(f"{MARK}*[^{MARK}]+|{MARK}+", self.normalise(text))
            words = [w[1:] if w[0] == MARK and len(w) > 1 and w[1] != MARK else MARK + w for w in words]
        self._forget()
        known = self.words
        for word in {w for w in words if w not in known}:
            # a second mark says that the word is not one behind a single mark
            known[word] = self._word(word[1:] if word[0] == MARK else MARK + word)
        return self._joined(b"".join(map(known.__getitem__, words)))

    def _joined(self, ids: bytes) -> np.ndarray:
        """Ids of a text; of neighbouring unknown characters one is left."""
        out = np.frombuffer(ids, self.kind)
        if self.bytes or not len(out):
            return out
        unknown = out == self.unknown
        return out[~np.concatenate([[False], unknown[1:] & unknown[:-1]])]

    def decode(self, ids: np.ndarray) -> str:
        text = b"".join(map(self.octets.__getitem__, ids.tolist())).decode("utf-8", "replace")
        return text[1:] if self.prefix and text[:1] == " " else text


_compiled: dict[int, Transducer] = {}


def _transducer(model: bytes) -> Transducer:
    key = zlib.crc32(model)
    return _compiled.get(key) or _compiled.setdefault(key, Transducer(model))


def model_bytes(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def encode(docs: DataFrame, model: bytes) -> DataFrame:
    """doc_id and the piece ids of every whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = _transducer(shared.value)
        for part in slices(batches):
            ids = [machine.encode(t).astype(np.int32) for t in part["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays([part["doc_id"], pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "ids"])

    return texts(docs).mapInArrow(encoded, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, model: bytes) -> DataFrame:
    """doc_id and the text of a table of piece ids; null ids give an empty text."""
    shared = encoded.sparkSession.sparkContext.broadcast(model)

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = _transducer(shared.value)
        for part in slices(batches):
            values = [machine.decode(np.array(ids or [], np.int64)) for ids in part["ids"].to_pylist()]
            yield pa.RecordBatch.from_arrays([part["doc_id"], pa.array(values, pa.string())], names=["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(decoded, "doc_id long, text string")


def digest(docs: DataFrame, model: bytes) -> DataFrame:
    """Number and crc32 of the piece ids (as 32-bit little-endian), and whether decoding gives back the text.

    Encodes and decodes in one pass, so the ids of all texts are not moved.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def both(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = _transducer(shared.value)
        for part in slices(batches):
            rows = []
            for text in part["text"].to_pylist():
                ids = machine.encode(text)
                rows.append((len(ids), zlib.crc32(ids.astype("<u4").tobytes()),
                             machine.decode(ids) == machine.read(text).replace(MARK, " ")))
            n, crc, same = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays([part["doc_id"], pa.array(n, pa.int64()), pa.array(crc, pa.int64()),
                                              pa.array(same, pa.bool_())], names=["doc_id", "n_pieces", "ids_crc32", "round_trip"])

    return texts(docs).mapInArrow(both, "doc_id long, n_pieces long, ids_crc32 long, round_trip boolean")


def with_ids(docs: DataFrame, model: bytes) -> DataFrame:
    """The columns of ``docs`` with ``text`` as decoded again, and ``piece_ids`` beside them."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    plain = docs.drop("piece_ids")
    schema = plain.withColumn("piece_ids", F.array().cast("array<int>")).schema
    names = plain.columns

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = _transducer(shared.value)
        for part in slices(batches, 64):
            values = [machine.encode(t or "") for t in part["text"].to_pylist()]
            again = [None if t is None else machine.decode(ids) for ids, t in zip(values, part["text"].to_pylist(), strict=True)]
            part = part.set_column(names.index("text"), "text", pa.array(again, part["text"].type))
            ids = pa.array([v.astype(np.int32) for v in values], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([*part.columns, ids], names=[*names, "piece_ids"])

    return plain.mapInArrow(encoded, schema)
