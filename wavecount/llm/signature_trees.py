"""Exact Jaccard join of documents by their word shingles, with signature trees.

1. Equal sets become one class. Shingles are 64-bit hashes; a class is named by a hash
   of its set.
2. Which classes can be close at all: the range of hashes is cut into more segments
   than two close sets can have differing shingles, so close sets agree in whole
   segments. Of these a set leaves out as many as it agrees in with any close one, but
   one, those of the fewest shingles: in them sets agree that share a passage or nothing.
   Segments depend on the level of size alone, and a pair meets at the level of
   the larger set; a class has a node for each level it may meet others at. Tasks send
   sorted keys of segments, Golomb-coded, to the owners of their ranges, with the nodes;
   owners answer with links between nodes that share a key. Keys and nodes are cut to
   as many bits as the number of documents asks for; what that adds are candidates.
3. The bitmaps and sizes of the nodes that links connect form signature trees: each tree
   node holds the OR of its sets' bitmaps and the range of their sizes. A dual traversal,
   from the leaves up, drops node pairs whose largest possible overlap is too small and
   those connected already. What is left are clusters of sets that may well be close,
   without those that share mere passages.
4. The sets of a cluster, sent as compressed texts, form a second tree, in which what the
   bounds leave is compared exactly. Where components alone are asked for, pairs that are
   connected already are dropped too. A cluster beyond its unit is dealt into blocks
   that meet pairwise, so no task holds more than a unit. A pair that meets in several
   units counts in one of them.
5. Links make components; all documents of their classes belong to them. The links of a
   class are counted in its unit, weighted by the documents of the classes, so a group
   of close texts sends one row for each text and not one for each pair.

No pair is lost: step 2 finds every pair that reaches the threshold, step 3 keeps it in
one cluster, and step 4 skips only pairs it has proved too far apart or, for components
alone, knows to be connected. Threshold tests are in whole numbers.

Copies cost one row per task; shared segments are combined per task before the shuffle.

Defined results: null and empty texts and texts without words have no shingles and link
with nothing; fewer words than a shingle make one; repeated documents share a class and
are linked with each other; rows with a null id get the least id of their component; an empty table gives none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wavecount.llm.common import in_files, look_up, slices, texts, with_places, without_rows
from wavecount.llm.components import components, forest, in_tasks
from wavecount.llm.golomb_dedup import golomb, ungolomb
from wavecount.session import materialise, scratch

WORDS = 5
THRESHOLD = (80, 100)
#: Shingles in one unit of comparison, as 8 octets each.
UNIT = 3_000_000
#: Bits of all bitmaps of a unit, roughly.
BITMAPS = 1 << 27
#: Octets of bitmaps in one unit of the first trees.
OUTLINES = 20 << 20
#: Keys that a task combines before it sends them on.
BUFFER = 500_000
#: Keys of one owner, roughly.
OWNED = 1_000_000
#: Bits of the filter that tells candidate classes; its size is fixed.
FILTER_BITS = 1 << 26
FANOUT = 8

_U = np.uint64
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_STEP, _BACK = _U(0x9E3779B97F4A7C15), _U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_OCTETS = np.random.default_rng(20).integers(0, 1 << 64, 256, dtype=_U)
_PLACES = np.random.default_rng(21).integers(0, 1 << 64, 65, dtype=_U) | _U(1)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads 64-bit values."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class _Powers:
    up = np.ones(1, _U)
    down = np.ones(1, _U)

    @classmethod
    def of(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            size = max(n, 1 << 16)
            cls.up = np.cumprod(np.concatenate([[_U(1)], np.full(size - 1, _STEP)]), dtype=_U)
            cls.down = np.cumprod(np.concatenate([[_U(1)], np.full(size - 1, _BACK)]), dtype=_U)
        return cls.up[:n], cls.down[:n]


def word_hashes(text: str) -> np.ndarray:
    """A hash for each word; the text is read in pieces that end at white space."""
    octets = np.frombuffer(text.encode("utf-8", "surrogatepass").translate(_LOWER), np.uint8)
    out, at, size = [], 0, len(octets)
    while at < size:
        end = min(size, at + (1 << 20))
        while end < size and not _SPACE[octets[end]]:
            end += 1
        piece = octets[at:end]
        word = np.concatenate([[False], ~_SPACE[piece], [False]])
        border = np.flatnonzero(word[1:] != word[:-1])
        starts, ends = border[::2], border[1::2]
        up, down = _Powers.of(len(piece) + 1)
        sums = np.concatenate([np.zeros(1, _U), np.cumsum(_OCTETS[piece] * up[: len(piece)], dtype=_U)])
        out.append(mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(_U)))
        at = end
    return np.concatenate(out) if out else np.zeros(0, _U)


def shingle_set(text: str, words: int) -> np.ndarray:
    """Sorted distinct hashes of the shingles."""
    h = word_hashes(text)
    if not len(h):
        return h
    if len(h) < words:
        places = np.resize(_PLACES[:64], len(h))
        return mix((h * places).sum(dtype=_U, keepdims=True) + np.full(1, len(h), _U) * _PLACES[64])
    n = len(h) - words + 1
    total = np.full(n, words, _U) * _PLACES[64]
    for k in range(words):
        total += h[k : k + n] * _PLACES[k]
    return np.unique(mix(total))


def class_id(s: np.ndarray) -> int:
    return int(mix(mix(s ^ _PLACES[0]).sum(dtype=_U, keepdims=True) + np.full(1, len(s), _U)).view(np.int64)[0])


class Segments:
    """Numbers of segments by level of set size, for a threshold num/den."""

    def __init__(self, num: int, den: int):
        self.num, self.den = num, den
        self.tops = [8]
        while self.tops[-1] < 1 << 40:
            self.tops.append(int(self.tops[-1] * 1.6))
        self.tops = np.array(self.tops)

    def differing(self, a: int, b: int) -> int:
        """Most shingles that sets of these sizes may not share, at the threshold."""
        return (self.den - self.num) * (a + b) // (self.den + self.num)

    def levels(self, a: int) -> tuple[int, int]:
        """The own level of a set of this size, and that of the largest set it may be close to."""
        first, last = np.searchsorted(self.tops, [a, a * self.den // self.num])
        return int(first), int(last)

    def signatures(self, s: np.ndarray) -> list[np.ndarray]:
        """For the own level and each one above, keys of which two sets that are close and meet there share at least one.

        A set close to this one differs from it in ``own`` segments at most and agrees in
        the other ``count - own``, empty ones among them. So each set may leave out all
        but ``own + 1`` keys by an order in which both have the segments they agree in:
        the last of these is left out by neither. Segments of few shingles go first, as
        sets that share a passage or nothing agree in those.
        """
        size, (first, last) = len(s), self.levels(len(s))
        sums = np.concatenate([np.zeros(1, _U), np.cumsum(mix(s ^ _PLACES[1]), dtype=_U)])
        by_level, out = np.arange(last + 1, dtype=_U) * _PLACES[3], []
        for level in range(first, last + 1):
            top = int(self.tops[level])
            most = self.differing(top, top)
            own = self.differing(size, min(top, size * self.den // self.num))
            count = most + 2 + most // 4
            place = ((s >> _U(32)) * _U(count)) >> _U(32)  # rises with the hash, so segments lie together
            widths = np.bincount(place.astype(np.int64), minlength=count)
            kept = np.argsort(np.minimum(widths, 255).astype(np.uint8), kind="stable")[count - own - 1 :]
            ends = np.cumsum(widths)[kept]
            out.append(mix(sums[ends] - sums[ends - widths[kept]] + kept.astype(_U) * _PLACES[2] + by_level[level]))
        return out


def close(a: np.ndarray, b: np.ndarray, num: int, den: int) -> bool:
    both = int(np.count_nonzero(b[np.minimum(np.searchsorted(b, a), len(b) - 1)] == a))
    return den * both >= num * (len(a) + len(b) - both)


def outline(s: np.ndarray, width: int) -> np.ndarray:
    """A bitmap of a set, of a power of two of bits."""
    bits = np.zeros(width, np.uint8)
    bits[(s & _U(width - 1)).astype(np.int64)] = 1
    return np.packbits(bits, bitorder="little").view("<u8")


class _Tree:
    """Signature tree: per level the bitmaps, least and largest sizes, and shingles beyond the bits of any set."""

    fanout = FANOUT

    def __init__(self, bits: np.ndarray, sizes: np.ndarray, num: int, den: int):
        self.num, self.den = num, den
        self.levels = self._above(bits, sizes, sizes, sizes - np.bitwise_count(bits).sum(1, dtype=np.int64))
        self.parent = np.arange(len(sizes))  # of sets that links connect, towards the least
        self.links: list[tuple[int, int]] = []
        self.all_pairs = False

    def _above(self, bits: np.ndarray, low: np.ndarray, high: np.ndarray, slack: np.ndarray) -> list[tuple]:
        """These nodes and the levels above them."""
        levels = [(bits, low, high, slack)]
        while len(bits) > 1:
            at = np.arange(0, len(bits), self.fanout)
            bits, low, high, slack = (f.reduceat(x, at, axis=0) for f, x in (
                (np.bitwise_or, bits), (np.minimum, low), (np.maximum, high), (np.maximum, slack)))
            levels.append((bits, low, high, slack))
        return levels

    def _find(self, a: int) -> int:
        parent = self.parent
        while parent[a] != a:
            parent[a] = a = parent[parent[a]]
        return int(a)

    def _roots(self) -> np.ndarray:
        """The root of every set; all paths are as short as can be afterwards."""
        while True:
            up = self.parent[self.parent]
            if (up == self.parent).all():
                return self.parent
            self.parent = up

    def _possible(self, level: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Which node pairs may hold a close pair; without ``all_pairs``, one that is not connected yet."""
        bits, low, high, slack = self.levels[level]
        keep = (high[i] * self.den >= self.num * low[j]) & (high[j] * self.den >= self.num * low[i])
        roots = None if self.all_pairs else self._roots()
        if self.all_pairs:
            pass
        elif level == 0:
            keep &= roots[i] != roots[j]
        else:
            at = np.arange(0, len(roots), self.fanout**level)
            least, most = np.minimum.reduceat(roots, at), np.maximum.reduceat(roots, at)
            keep &= ~((least[i] == most[i]) & (least[j] == most[j]) & (least[i] == least[j]))
        left, step = np.flatnonzero(keep), max(1, (1 << 20) // bits.shape[1])
        for k in range(0, len(left), step):
            part = left[k : k + step]
            a, b = i[part], j[part]
            common = np.bitwise_count(bits[a] & bits[b]).sum(1, dtype=np.int64)
            most = np.minimum(np.minimum(common + np.minimum(slack[a], slack[b]), high[a]), high[b])
            keep[part] = (self.num + self.den) * most >= self.num * (low[a] + low[b])
        return keep

    def _descend(self, level: int, i: np.ndarray, j: np.ndarray) -> None:
        keep = self._possible(level, i, j)
        i, j = i[keep], j[keep]
        if not len(i):
            return
        if level == 0:
            self._meet(i, j)
            return
        below, step = len(self.levels[level - 1][0]), 1 << 12
        for k in range(0, len(i), step):
            below_it = np.arange(self.fanout)
            a, b = np.broadcast_arrays(i[k : k + step, None, None] * self.fanout + below_it[:, None],
                                       j[k : k + step, None, None] * self.fanout + below_it)
            real = (a < below) & (b < below)
            self._descend(level - 1, a[real], b[real])

    def _meet(self, i: np.ndarray, j: np.ndarray) -> None:
        """What to do with pairs of sets that no bound keeps apart."""
        raise NotImplementedError

    def find_links(self) -> list[tuple[int, int]]:
        """Links that connect all sets which chains of close pairs connect."""
        for level, (nodes, *_) in enumerate(self.levels[:-1]):
            if nodes is None:
                continue
            for gap in range(1, self.fanout):  # siblings, nearest first
                i = np.arange(len(nodes) - gap)
                i = i[i // self.fanout == (i + gap) // self.fanout]
                self._descend(level, i, i + gap)
        return self.links


class Outlines(_Tree):
    """A tree of bitmaps alone; its links connect all sets that chains of possible pairs connect.

    The lowest nodes hold many sets, and the sets of two such nodes are compared as whole
    blocks: clusters that chain through shared passages have few nodes to drop.
    """

    fanout = 64

    def __init__(self, bits: np.ndarray, sizes: np.ndarray, least: np.ndarray, num: int, den: int):
        self.num, self.den = num, den
        self.order = np.lexsort((sizes, least))  # alike sets side by side
        self.turned = np.empty(bits.shape[::-1], _U)  # by words and not by sets; the only copy that stays
        for k in range(bits.shape[1]):
            self.turned[k] = bits[self.order, k]
        sizes = sizes[self.order]
        slack = sizes.copy()
        for word in self.turned:
            slack -= np.bitwise_count(word)
        at = np.arange(0, len(sizes), self.fanout)
        nodes = np.ascontiguousarray(np.bitwise_or.reduceat(self.turned, at, axis=1).T)
        low, high, most = (f.reduceat(x, at) for f, x in ((np.minimum, sizes), (np.maximum, sizes), (np.maximum, slack)))
        self.levels = [(None, sizes, sizes, slack), *self._above(nodes, low, high, most)]
        self.parent = np.arange(len(sizes))
        self.links, self.all_pairs = [], False

    def find_links(self) -> list[tuple[int, int]]:
        for a in range(0, len(self.parent), self.fanout):
            self._block(slice(a, a + self.fanout), slice(a, a + self.fanout))
        return super().find_links()

    def _descend(self, level: int, i: np.ndarray, j: np.ndarray) -> None:
        if level != 1:
            super()._descend(level, i, j)
            return
        keep = self._possible(1, i, j)
        for a, b in zip((i[keep] * self.fanout).tolist(), (j[keep] * self.fanout).tolist(), strict=True):
            self._block(slice(a, a + self.fanout), slice(b, b + self.fanout))

    def _block(self, left: slice, right: slice) -> None:
        """All pairs of two runs of sets."""
        _, sizes, _, slack = self.levels[0]
        left, right = (slice(x.start, min(x.stop, len(sizes))) for x in (left, right))
        common = np.bitwise_count(self.turned[:, left, None] & self.turned[:, None, right]).sum(0, dtype=np.uint16).astype(np.int64)
        a, b = sizes[left, None], sizes[None, right]
        most = np.minimum(np.minimum(common + np.minimum(slack[left, None], slack[None, right]), a), b)
        near = (self.num + self.den) * most >= self.num * (a + b)  # which says, too, that the sizes are near
        if near.any():
            i, j = np.nonzero(near)
            self._meet(i + left.start, j + right.start)

    def _meet(self, i: np.ndarray, j: np.ndarray) -> None:
        roots = self._roots()
        u, v = forest(roots[i], roots[j])
        self.parent[u] = v

    def clusters(self) -> tuple[np.ndarray, np.ndarray]:
        """Places of sets that are connected to an earlier one, and of that one."""
        self.find_links()
        roots = self._roots()
        leaves = np.flatnonzero(roots != np.arange(len(roots)))
        return self.order[leaves], self.order[roots[leaves]]


class Tree(_Tree):
    """Signature tree of one unit's sets, and the links a dual traversal finds."""

    def __init__(self, sets: list[np.ndarray], num: int, den: int):
        self.order = sorted(range(len(sets)), key=lambda k: (int(sets[k][0]), len(sets[k]), k))  # alike sets side by side
        self.sets = [sets[k] for k in self.order]
        sizes = np.array([len(s) for s in self.sets], np.int64)
        width = min(1 << int(2 * sizes.max() - 1).bit_length(), 1 << (BITMAPS // len(sets)).bit_length())
        width = max(256, width)  # fewer bits than shingles only weaken the bound
        super().__init__(np.stack([outline(s, width) for s in self.sets]), sizes, num, den)

    def _meet(self, i: np.ndarray, j: np.ndarray) -> None:
        self._count(i, j) if self.all_pairs else self._compare(i, j)

    def _compare(self, i: np.ndarray, j: np.ndarray) -> None:
        while len(i):
            now = min(len(i), 64)
            for a, b in zip(i[:now].tolist(), j[:now].tolist(), strict=True):
                low, high = sorted((self._find(a), self._find(b)))
                if low != high and close(self.sets[a], self.sets[b], self.num, self.den):
                    self.links.append((self.order[a], self.order[b]))
                    self.parent[high] = low
            i, j = i[now:], j[now:]
            if len(i):
                roots = self._roots()
                apart = roots[i] != roots[j]
                i, j = i[apart], j[apart]

    def _count(self, i: np.ndarray, j: np.ndarray) -> None:
        """Compares all pairs exactly, one set with all its partners at a time."""
        order = np.argsort(i, kind="stable")
        i, j = i[order], j[order]
        borders = np.flatnonzero(np.concatenate([[True], i[1:] != i[:-1], [True]]))
        for first, last in zip(borders[:-1].tolist(), borders[1:].tolist(), strict=True):
            a = int(i[first])
            self.marked[self.places[self.starts[a] : self.starts[a + 1]]] = True
            for at in range(first, last, 4096):
                self._count_with(a, j[at : min(at + 4096, last)])
            self.marked[self.places[self.starts[a] : self.starts[a + 1]]] = False

    def _count_with(self, a: int, others: np.ndarray) -> None:
        sizes = self.starts[others + 1] - self.starts[others]
        ends = np.cumsum(sizes)
        read = np.arange(ends[-1]) + np.repeat(self.starts[others] - (ends - sizes), sizes)
        both = np.add.reduceat(self.marked[self.places[read]], ends - sizes, dtype=np.int64)
        own = self.starts[a + 1] - self.starts[a]
        near = others[self.den * both >= self.num * (own + sizes - both)]
        if not len(near):
            return
        counted = near if self.counted is None else near[self.counted(self.order[a], self.where[near])]
        self.n_links[a] += self.weights[counted].sum()
        self.n_links[counted] += self.weights[a]
        for b in near[np.unique(self.parent[near], return_index=True)[1]].tolist():
            low, high = sorted((self._find(a), self._find(b)))
            if low != high:
                self.links.append((self.order[a], self.order[b]))
                self.parent[high] = low
        self.parent[near] = self._find(a)

    def count_links(self, weights: list[int], counted=None) -> np.ndarray:
        """Per set the weights of all sets close to it; ``links`` then connects what chains of close pairs connect.

        ``counted(a, others)`` tells which pairs of sets (by their places in the list given)
        count here; the others only connect.
        """
        self.where, self.counted = np.array(self.order), counted
        self.weights = np.array(weights, np.int64)[self.where]
        self.n_links = np.zeros(len(self.sets), np.int64)
        self.starts = np.concatenate([[0], np.cumsum([len(s) for s in self.sets])])
        shingles, self.places = np.unique(np.concatenate(self.sets), return_inverse=True)
        self.marked = np.zeros(len(shingles), bool)
        self.all_pairs = True
        self.find_links()
        out = np.zeros(len(self.sets), np.int64)
        out[self.where] = self.n_links
        return out


class Cut:
    """How many bits of hashes tell keys and classes apart among so many documents, and who owns which keys."""

    def __init__(self, rows: int, span: int):
        size = max(1, rows).bit_length()
        self.key_bits = min(62, size + 8 + 14)  # some 256 keys a document, one in many documents tied for nothing
        self.name_bits = min(54, size + 12)
        self.place_bits = max(1, span.bit_length())
        self.owners = -(-max(1, rows) * 256 // OWNED)

    def name(self, cid: int) -> int:
        """The first bits of a class, as a number without a sign."""
        return (cid & (1 << 64) - 1) >> (64 - self.name_bits)

    def node(self, cid: int, place: int) -> int:
        """A class at the level so many places above its own."""
        return self.name(cid) << self.place_bits | place

    def start(self, owner: int) -> int:
        return -(-(owner << self.key_bits) // self.owners)

    def width(self, owner: int) -> int:
        return self.start(owner + 1) - self.start(owner)


def _packed(values: np.ndarray, bits: int) -> bytes:
    return np.packbits(((values[:, None] >> np.arange(bits)) & 1).astype(np.uint8)).tobytes()


def _unpacked(code: bytes, n: int, bits: int) -> np.ndarray:
    return (np.unpackbits(np.frombuffer(code, np.uint8), count=n * bits).reshape(n, bits).astype(np.int64) << np.arange(bits)).sum(1)


def _keys_tied(keys: np.ndarray, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys with one node each, and links that tie further nodes with the same key to it."""
    order = np.lexsort((nodes, keys))
    keys, nodes = keys[order], nodes[order]
    first = np.concatenate([[True], keys[1:] != keys[:-1]])
    heads = nodes[first][np.cumsum(first) - 1]
    tied = (nodes != heads) & ~first
    return keys[first], nodes[first], *forest(nodes[tied], heads[tied])


def _parcels(docs: DataFrame, words: int, num: int, den: int, cut: Cut) -> DataFrame:
    """owner, and what a task sends it: keys with their nodes, and links it has found itself."""
    def sent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segments, keys, nodes, held, seen = Segments(num, den), [], [], 0, set()
        starts = np.array([cut.start(o) for o in range(cut.owners)], np.int64)

        def parcels() -> pa.RecordBatch:
            k, n, u, v = _keys_tied(np.concatenate(keys), np.concatenate(nodes))
            owners = np.searchsorted(starts, k, "right") - 1
            own, first, number = np.unique(owners, return_index=True, return_counts=True)
            of_links = np.searchsorted(own, u % cut.owners) % len(own)
            rows = []
            for j, (o, a, m) in enumerate(zip(own.tolist(), first.tolist(), number.tolist(), strict=True)):
                links = np.stack([u[of_links == j], v[of_links == j]]).astype("<i8").tobytes()
                rows.append((o, m, golomb(k[a : a + m] - cut.start(o), cut.width(o)),
                             _packed(n[a : a + m], cut.name_bits + cut.place_bits), links))
            return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(
                zip(*rows, strict=True), (pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()), strict=True)],
                names=["owner", "n", "keys", "nodes", "links"])

        for part in slices(batches):
            for text in part["text"].to_pylist():
                s = shingle_set(text, words)
                if not len(s) or (cid := class_id(s)) in seen:
                    continue
                seen.add(cid)
                for place, own in enumerate(segments.signatures(s)):
                    keys.append((own >> _U(64 - cut.key_bits)).astype(np.int64))
                    nodes.append(np.full(len(own), cut.node(cid, place), np.int64))
                    held += len(own)
                if held >= BUFFER:
                    yield parcels()
                    keys, nodes, held = [], [], 0
        if held:
            yield parcels()

    return texts(docs).select("text").mapInArrow(sent, "owner int, n int, keys binary, nodes binary, links binary")


def _tied(parcels: DataFrame, cut: Cut) -> DataFrame:
    """Links (u, v) between nodes that share a key."""
    bits = cut.name_bits + cut.place_bits

    def owned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, keys, nodes, links = None, [], [], []

        def answer() -> pa.RecordBatch:
            *_, u, v = _keys_tied(np.concatenate(keys), np.concatenate(nodes))
            u, v = (np.concatenate([x, *(pair[k] for pair in links)]) for k, x in enumerate((u, v)))
            return pa.RecordBatch.from_arrays([pa.array(x) for x in forest(u, v)], names=["u", "v"])

        for part in slices(batches, 16):
            for owner, n, key, node, pairs in zip(*(part[c].to_pylist() for c in ("owner", "n", "keys", "nodes", "links")), strict=True):
                if owner != current and current is not None:
                    yield answer()
                    keys, nodes, links = [], [], []
                current = owner
                keys.append(ungolomb(key, n, cut.width(owner)))
                nodes.append(_unpacked(node, n, bits))
                links.append(np.frombuffer(pairs, "<i8").reshape(2, -1))
        if current is not None:
            yield answer()

    return parcels.repartition(cut.owners, "owner").sortWithinPartitions("owner").mapInArrow(owned, "u long, v long")


def _filter(clusters: DataFrame, place_bits: int) -> np.ndarray:
    """A bitmap of fixed size over the classes with linked nodes; at most FILTER_BITS / 64 rows are gathered."""
    place = F.pmod(F.shiftright("node", place_bits), F.lit(FILTER_BITS))
    words = clusters.select(place.alias("place")).selectExpr("cast(place div 64 as int) as word", "shiftleft(1L, cast(place % 64 as int)) as bit")
    bits = np.zeros(FILTER_BITS // 64, np.int64)
    rows = words.groupBy("word").agg(F.bit_or("bit").alias("bits")).toPandas()
    bits[rows["word"].to_numpy()] = rows["bits"].to_numpy()
    return bits


def _width(top: int) -> int:
    """Bits of the bitmap of sets of a level."""
    return min(8_192, max(256, 1 << int(2 * top - 1).bit_length()))


def _members(docs: DataFrame, words: int, num: int, den: int, wanted: np.ndarray, cut: Cut) -> DataFrame:
    """doc_id, the place of the row, number of shingles and class of every document.

    Once per task, where the class may be in a cluster, also its nodes with a bitmap for
    each, its least shingle and its text under zstandard.
    """
    shared = docs.sparkSession.sparkContext.broadcast(wanted.tobytes())
    kind = pa.list_(pa.struct([("node", pa.int64()), ("place", pa.int32()), ("level", pa.int32()), ("bits", pa.binary())]))
    schema = ("doc_id long, _file long, _line long, n_shingles long, cid long, least long, packed binary, "
              "nodes array<struct<node:long,place:int,level:int,bits:binary>>")

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, seen, segments = np.frombuffer(shared.value, np.int64), set(), Segments(num, den)
        compress = zstandard.ZstdCompressor().compress
        for part in slices(batches):
            rows = []
            for text in part["text"].to_pylist():
                s = shingle_set(text, words)
                cid = class_id(s) if len(s) else None
                place = cut.name(cid) % FILTER_BITS if len(s) else 0
                if len(s) and cid not in seen and int(bits[place >> 6]) >> (place & 63) & 1:
                    seen.add(cid)
                    first, last = segments.levels(len(s))
                    nodes = [{"node": cut.node(cid, k), "place": k, "level": first + k,
                              "bits": outline(s, _width(int(segments.tops[first + k]))).tobytes()} for k in range(last - first + 1)]
                    rows.append((len(s), cid, int(s[:1].view(np.int64)[0]), compress(text.encode("utf-8", "surrogatepass")), nodes))
                else:
                    rows.append((len(s), cid, None, None, None))
            sizes, ids, least, packed, nodes = map(list, zip(*rows, strict=True))
            yield pa.RecordBatch.from_arrays(
                [part["doc_id"], part["_file"], part["_line"], pa.array(sizes, pa.int64()), pa.array(ids, pa.int64()), pa.array(least, pa.int64()),
                 pa.array(packed, pa.binary()), pa.array(nodes, kind)], names=["doc_id", "_file", "_line", "n_shingles", "cid", "least", "packed", "nodes"])

    placed = with_places(docs).select("doc_id", F.coalesce("text", F.lit("")).alias("text"), "_file", "_line")
    return placed.mapInArrow(listed, schema)


def _dealt(rows: DataFrame, weight: str, unit: int) -> DataFrame:
    """``rows`` with ``block``, ``low`` and ``high``: the blocks that meet in a unit, and the row's own.

    A root whose rows weigh more than a unit is dealt into blocks, of which every two
    meet, so its rows are there once for each block.
    """
    totals = rows.groupBy("root").agg(F.sum(weight).alias("weighs"), F.count("*").alias("n")).where(F.col("weighs") > unit)
    blocks = totals.select("root", "n", F.ceil(F.col("weighs") * 2 / F.lit(unit)).cast("int").alias("blocks"))
    placed = look_up(rows, materialise(blocks, "blocks"), "root", "n").drop("n").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    placed = placed.withColumn("block", F.pmod(F.xxhash64("cid"), F.col("blocks")).cast("int"))
    placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return placed.withColumn("low", F.least("block", "other")).withColumn("high", F.greatest("block", "other")).drop("blocks", "other")


_UNIT = ("root", "low", "high")


def _by_unit(batches: Iterator[pa.RecordBatch], columns: tuple[str, ...]) -> Iterator[tuple[tuple, list[tuple]]]:
    """Unit and its rows, from rows that are sorted by unit."""
    current, rows = None, []
    for part in slices(batches):
        units = zip(*(part[c].to_pylist() for c in _UNIT), strict=True)
        for unit, row in zip(units, zip(*(part[c].to_pylist() for c in columns), strict=True), strict=True):
            if unit != current:
                if len(rows) > 1:
                    yield current, rows
                current, rows = unit, []
            rows.append(row)
    if len(rows) > 1:
        yield current, rows


def _refined(nodes: DataFrame, num: int, den: int) -> DataFrame:
    """Links (u, v) of nodes whose bitmaps and sizes leave them possibly close, as far as they connect.

    Only nodes of one level are compared; others are in a cluster by chance.
    """
    unit = (*_UNIT, "level")

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held = None, []

        def finish() -> Iterator[pa.RecordBatch]:
            if sum(len(h[0]) for h in held) > 1:
                names, sizes, least, words = (np.concatenate([h[k] for h in held]) for k in range(4))
                held.clear()
                a, b = Outlines(words, sizes, least, num, den).clusters()
                yield pa.RecordBatch.from_arrays([pa.array(names[a]), pa.array(names[b])], names=["u", "v"])

        for part in slices(batches, 1_024):
            keys = np.stack([part[c].to_numpy() for c in unit], axis=1)
            columns = [part[c].to_numpy() for c in ("node", "n_shingles", "least")]
            borders = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1).tolist(), len(keys)]
            for first, last in zip(borders, borders[1:], strict=False):
                if (key := tuple(keys[first].tolist())) != current:
                    yield from finish()
                    held.clear()
                    current = key
                words = np.frombuffer(b"".join(part["bits"].slice(first, last - first).to_pylist()), "<u8")
                held.append((*(c[first:last].copy() for c in columns), words.reshape(last - first, -1)))
        yield from finish()

    ordered = nodes.repartition(*_UNIT).sortWithinPartitions(*unit, "cid")
    return ordered.mapInArrow(linked, "u long, v long")


def _links(units: DataFrame, words: int, num: int, den: int, count: bool) -> DataFrame:
    """Links (u, v) that connect, and with ``count`` rows (u, n) of the documents close to class u, in one or more units."""
    def rows(u: list, v: list, n: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (u, v, n)], names=["u", "v", "n"])

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        expand = zstandard.ZstdDecompressor().decompress
        for (_, low, high), members in _by_unit(batches, ("cid", "place", "level", "block", "copies", "packed")):
            ids, place, level, block, copies, packed = zip(*members, strict=True)
            place, level, block = np.array(place), np.array(level), np.array(block)
            tree = Tree([shingle_set(expand(t).decode("utf-8", "surrogatepass"), words) for t in packed], num, den)
            if count:
                def counted(a: int, others: np.ndarray) -> np.ndarray:
                    """At the level of the larger set, and where the blocks of both are those that meet."""
                    return ((level[a] == level[others]) & ((place[a] == 0) | (place[others] == 0))
                            & (np.minimum(block[a], block[others]) == low) & (np.maximum(block[a], block[others]) == high))

                n = tree.count_links(list(copies), counted)
                some = np.flatnonzero(n)
                yield rows(np.array(ids)[some], [None] * len(some), n[some])
            else:
                tree.find_links()
            yield rows([ids[a] for a, _ in tree.links], [ids[b] for _, b in tree.links], [None] * len(tree.links))

    ordered = units.repartition(*_UNIT).sortWithinPartitions(*_UNIT, "cid")
    return ordered.mapInArrow(linked, "u long, v long, n long")


def _found(docs: DataFrame, words: int, threshold: tuple[int, int], unit: int, count: bool) -> DataFrame:
    """What ``similar`` returns, with the place of the row and the root of the component, which is null without words.

    ``docs`` is one of ``in_files``.
    """
    num, den = threshold
    spark = docs.sparkSession
    segments = Segments(num, den)
    n_docs = docs.count()
    cut = Cut(n_docs, max(b - a for a, b in map(segments.levels, range(1, 4_096))))
    with scratch(spark):
        clusters = components(_tied(_parcels(docs, words, num, den, cut), cut))
        members = materialise(_members(docs, words, num, den, _filter(clusters, cut.place_bits), cut), "members", keep=True)
        copies = members.where(F.col("cid").isNotNull()).groupBy("cid").agg(F.count("*").alias("copies"))
        copies = materialise(in_tasks(copies.where("copies > 1"), n_docs), "copies", keep=True)
        held = members.where(F.col("packed").isNotNull())
        outlines = held.select("cid", "n_shingles", "least", F.inline("nodes")).repartition("node")  # once for both steps
        outlines = outlines.dropDuplicates(["node", "cid"]).join(clusters, "node").withColumn("octets", F.length("bits"))
        refined = components(_refined(_dealt(materialise(outlines, "outlines"), "octets", OUTLINES), num, den))
        places = held.select("cid", "n_shingles", F.inline("nodes")).drop("bits").distinct().join(refined, "node").join(copies, "cid", "left")
        places = _dealt(materialise(places.withColumn("copies", F.coalesce("copies", F.lit(1))), "places"), "n_shingles", unit)
        sets = held.select("cid", "packed").dropDuplicates(["cid"]).join(places, "cid")
        links = materialise(_links(sets, words, num, den, count), "found", keep=True)
    found = links.where(F.col("v").isNotNull()).select("u", "v")
    known = components(found).withColumnRenamed("node", "cid")
    rows = members.select("doc_id", "_file", "_line", "n_shingles", "cid")
    if count:
        counts = links.where(F.col("n").isNotNull()).groupBy(F.col("u").alias("cid")).agg(F.sum("n").alias("n_near"))
        known = known.join(counts, "cid", "left")
    known = known.join(copies, "cid", "full").withColumn("n", F.coalesce("copies", F.lit(1)))
    known = materialise(in_tasks(known.where(F.col("cid").isNotNull()), n_docs), "known", keep=True)
    rows = in_tasks(look_up(rows, known, "cid", "n"), n_docs)
    n_links = [(F.coalesce("n_near", F.lit(0)) + F.coalesce("n", F.lit(1)) - 1).alias("n_links")] if count else []
    rows = rows.select("doc_id", "_file", "_line", "n_shingles", F.coalesce("root", "cid").alias("root"), *n_links)
    least = rows.where(F.col("root").isNotNull()).groupBy("root").agg(F.min("doc_id").alias("component_id"), F.count("*").alias("in_root"))
    rows = in_tasks(look_up(rows, materialise(in_tasks(least, n_docs), "roots", keep=True), "root", "in_root"), n_docs)
    component = F.when(F.col("root").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id")
    return rows.select("doc_id", "_file", "_line", "n_shingles", "root", component, *(["n_links"] if count else []))


def similar(docs: DataFrame, words: int = WORDS, threshold: tuple[int, int] = THRESHOLD, unit: int = UNIT, count: bool = True) -> DataFrame:
    """doc_id, n_shingles and component_id of every document, and with ``count`` also n_links.

    ``n_links`` is the number of other rows that are close to it, copies among them.
    """
    return _found(in_files(docs.select("doc_id", "text")), words, threshold, unit, count).drop("_file", "_line", "root")


def keep_one(docs: DataFrame, words: int = WORDS, threshold: tuple[int, int] = THRESHOLD) -> DataFrame:
    """Exactly one document of each group of similar ones, all columns kept: the one of the smallest id, null ids last.

    Of rows that repeat that id one stays. Rows without words are similar to nothing and
    all stay. Texts are not moved: rows that go are left out where they are read.
    """
    docs = in_files(docs)
    row = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "_file", "_line")
    found = _found(docs, words, threshold, UNIT, False).where(F.col("root").isNotNull())
    rows = materialise(found.select("root", row.alias("row")), "similar")
    first = rows.groupBy("root").agg(F.min("row").alias("stays"), F.count("*").alias("n"))
    told = look_up(rows, materialise(first, "first"), "root", "n")
    return without_rows(docs, told.where(F.col("row") != F.col("stays")).select("row._file", "row._line"))
