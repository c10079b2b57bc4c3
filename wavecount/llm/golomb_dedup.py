"""Exact duplicates by an exchange of Golomb-coded fingerprints.

1. Letters. A task cuts its documents into letters of at most ``LETTER`` rows. Each text
   gets a short fingerprint; the distinct ones of a letter, sorted, go to the owners of
   their ranges as Golomb-coded differences, some 20 to 30 bits each. What the letter
   knows of its rows (id, size, sha-256, fingerprint's place) stays behind in a table.
2. Owners. An owner decodes what all letters sent for its range and answers each with a
   bitmap: which of its fingerprints came in another letter, too.
3. Suspects are rows whose bit is set or whose fingerprint occurs twice in their letter.
   Only their texts are read again, in place: a bitmap of suspect rows for each 32,768
   rows of a file is broadcast, in waves of files whose bitmaps are at most ``WAVE``
   together, and each file is read in one wave.
4. Suspects' texts are shuffled and compared octet by octet, by a grouped aggregate that
   Spark combines in every task, so a text that is a third of all rows costs one row for
   each task. Texts that only share a fingerprint end up alone.
5. Rows look up their group by sha-256; groups with a large share of all rows are few
   and broadcast, so no task gathers one.

Fingerprints have ten bits more than are needed to number the rows, so about one text in
a thousand is a suspect for nothing; none is missed, as equal texts have equal
fingerprints. The number of owners grows with the rows, each holds some ``OWNED``
fingerprints; a letter sends a fingerprint once, so copies add nothing.

A table that is not read from Parquet files, whose rows have no place to return to, is
written to the shared folder first.

Defined results: white space is ``[\\x20\\x09-\\x0D]`` and is left out of the comparison;
null, empty and blank texts are equal; of equal texts the row with the most code points
stays, of these the one with the smallest id, null ids last, and of rows that repeat an
id too exactly one; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wavecount.llm.common import look_up, slices
from wavecount.session import materialise, new_workdir

LETTER = 65_536
OWNED = 1 << 22
#: Octets of bitmaps broadcast at a time.
WAVE = 32 << 20
_BITMAP = 4_096
_SPARE_BITS = 10

# Fixed value: the white space that comparison leaves out.
BLANKS = " \t\n\x0b\x0c\r"
_BLANKS = BLANKS.encode()

_LETTER_ROWS = ("letter string, owner int, place int, twin boolean, doc_id long, n_chars long, sha binary, file long, "
                "line long, n int, code binary")


# ---- Golomb codes


def rice_bits(width: int, n: int) -> int:
    """Bits of the remainder for ``n`` sorted values of a range of ``width``."""
    return max(0, int(math.log2(max(1.0, width / n * math.log(2)))))


def golomb(values: np.ndarray, width: int) -> bytes:
    """Sorted distinct values below ``width``: quotients of the differences in unary, then the remainders."""
    gaps = np.diff(values.astype(np.int64), prepend=-1) - 1
    k = rice_bits(width, len(values))
    ends = np.cumsum((gaps >> k) + 1) - 1
    unary = np.zeros(int(ends[-1]) + 1, np.uint8)
    unary[ends] = 1
    rest = (gaps[:, None] >> np.arange(k)) & 1
    return np.packbits(np.concatenate([unary, rest.astype(np.uint8).reshape(-1)])).tobytes()


def ungolomb(code: bytes, n: int, width: int) -> np.ndarray:
    """The values of ``golomb``."""
    k = rice_bits(width, n)
    bits = np.unpackbits(np.frombuffer(code, np.uint8))
    ends = np.flatnonzero(bits)[:n]  # the unary part comes first, so its ones do
    quotients = np.diff(ends, prepend=-1) - 1
    start = int(ends[-1]) + 1
    rest = bits[start : start + n * k].reshape(n, k).astype(np.int64)
    gaps = (quotients << k) + (rest << np.arange(k)).sum(1)
    return np.cumsum(gaps + 1) - 1


class Ranges:
    """Fingerprints of a collection of ``rows`` rows, and who owns which of them."""

    def __init__(self, rows: int, owned: int = OWNED):
        self.bits = min(48, max(1, rows - 1).bit_length() + _SPARE_BITS)
        self.owners = -(-max(1, rows) // owned)

    def fingerprints(self, digests: list[bytes]) -> np.ndarray:
        whole = np.frombuffer(b"".join(d[:8] for d in digests), ">u8")
        return (whole >> np.uint64(64 - self.bits)).astype(np.int64)

    def start(self, owner: int) -> int:
        return -(-(owner << self.bits) // self.owners)

    def width(self, owner: int) -> int:
        return self.start(owner + 1) - self.start(owner)

    def owner(self, prints: np.ndarray) -> np.ndarray:
        starts = np.array([self.start(k) for k in range(self.owners)], np.int64)
        return np.searchsorted(starts, prints, "right") - 1


# ---- 1: letters


def _placed(docs: DataFrame, text: str) -> DataFrame:
    """doc_id, text, and the place of each row: a file and its line there."""
    def of(rows: DataFrame, key: str, value: str) -> DataFrame:
        place = rows.metadataColumn("_metadata")
        return rows.select(rows[key].cast("long").alias("doc_id"), F.coalesce(rows[value], F.lit("")).alias("text"),
                           place["file_path"].alias("path"), F.xxhash64(place["file_path"]).alias("file"),
                           place["row_index"].alias("line"))

    try:
        return of(docs, "doc_id", text)
    except AnalysisException:  # no scan of Parquet files
        return of(materialise(docs.select("doc_id", text), "documents"), "doc_id", text)


def _letters(placed: DataFrame, ranges: Ranges, size: int) -> DataFrame:
    def sealed(held: list[tuple]) -> Iterator[pa.RecordBatch]:
        ids, sizes, shas, files, lines = (sum((h[k] for h in held), []) for k in range(5))
        name = f"{files[0] & (1 << 64) - 1:x}:{lines[0]:x}"
        prints = ranges.fingerprints(shas)
        distinct, place, times = np.unique(prints, return_inverse=True, return_counts=True)
        owners = ranges.owner(distinct)
        owned, first, number = np.unique(owners, return_index=True, return_counts=True)
        own = np.searchsorted(owned, owners[place])
        schema = ["letter", "owner", "place", "twin", "doc_id", "n_chars", "sha", "file", "line", "n", "code"]

        def batch(n: int, *columns: pa.Array) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([name] * n, pa.string()), *columns], names=schema)

        n = len(ids)
        for at in range(0, n, 8_192):
            cut = slice(at, at + 8_192)
            k = len(ids[cut])
            yield batch(k, pa.array(owned[own[cut]].astype("i4")), pa.array((place[cut] - first[own[cut]]).astype("i4")),
                        pa.array(times[place[cut]] > 1), pa.array(ids[cut], pa.int64()), pa.array(sizes[cut], pa.int64()),
                        pa.array(shas[cut], pa.binary()), pa.array(files[cut], pa.int64()), pa.array(lines[cut], pa.int64()),
                        pa.nulls(k, pa.int32()), pa.nulls(k, pa.binary()))
        codes = [golomb(distinct[a : a + m] - ranges.start(o), ranges.width(o))
                 for o, a, m in zip(owned.tolist(), first.tolist(), number.tolist(), strict=True)]
        k = len(codes)
        yield batch(k, pa.array(owned.astype("i4")), pa.nulls(k, pa.int32()), pa.nulls(k, pa.bool_()), *[pa.nulls(k, pa.int64())] * 2,
                    pa.nulls(k, pa.binary()), *[pa.nulls(k, pa.int64())] * 2, pa.array(number.astype("i4")), pa.array(codes, pa.binary()))

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for part in slices(batches):
            shas = [hashlib.sha256(t.translate(None, _BLANKS)).digest() for t in part["text"].cast(pa.binary()).to_pylist()]
            held.append((part["doc_id"].to_pylist(), pc.utf8_length(part["text"]).to_pylist(), shas,
                         part["file"].to_pylist(), part["line"].to_pylist()))
            n += part.num_rows
            if n + part.num_rows > size:
                yield from sealed(held)
                held, n = [], 0
        if n:
            yield from sealed(held)

    return placed.select("doc_id", "text", "file", "line").mapInArrow(written, _LETTER_ROWS)


# ---- 2: owners


def answers(prints: list[np.ndarray]) -> list[np.ndarray]:
    """For each letter's sorted fingerprints, which of them other letters sent, too."""
    together = np.concatenate(prints)
    order = np.argsort(together, kind="stable")
    ordered = together[order]
    same = ordered[1:] == ordered[:-1]
    again = np.zeros(len(together), bool)
    again[order] = np.concatenate([[False], same]) | np.concatenate([same, [False]])
    return np.split(again, np.cumsum([len(p) for p in prints])[:-1])


def _answered(letters: DataFrame, ranges: Ranges) -> DataFrame:
    """letter, owner and the bitmap for it, where a bit is set."""
    def owned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, names, prints = None, [], []

        def answer() -> Iterator[pa.RecordBatch]:
            if len(names) > 1:
                rows = [(name, np.packbits(bits, bitorder="little")) for name, bits in zip(names, answers(prints), strict=True) if bits.any()]
                words = [np.pad(b, (0, -len(b) % 8)).view("<i8").tolist() for _, b in rows]
                yield pa.RecordBatch.from_arrays([pa.array([n for n, _ in rows], pa.string()), pa.array([current] * len(rows), pa.int32()),
                                                  pa.array(words, pa.list_(pa.int64()))], names=["letter", "owner", "bits"])

        for part in slices(batches):
            for owner, letter, n, code in zip(*(part[c].to_pylist() for c in ("owner", "letter", "n", "code")), strict=True):
                if owner != current:
                    yield from answer()
                    current, names, prints = owner, [], []
                names.append(letter)
                prints.append(ungolomb(code, n, ranges.width(owner)))
        yield from answer()

    sent = letters.where(F.col("code").isNotNull()).select("owner", "letter", "n", "code")
    sent = sent.repartition(ranges.owners, "owner").sortWithinPartitions("owner", "letter")
    return sent.mapInArrow(owned, "letter string, owner int, bits array<long>")


# ---- 3: the suspects' texts


def _bit_of(bitmap: Column, position: Column) -> Column:
    """Whether a bit of a binary bitmap is set."""
    octet = F.conv(F.hex(F.substring(bitmap, (F.shiftright(position, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.getbit(octet, F.pmod(position, F.lit(8)).cast("int")) == 1


def _suspect_texts(placed: DataFrame, suspects: DataFrame, wave: int) -> DataFrame:
    """norm, and the row, of every suspect; ``suspects`` has file and line."""
    spark = placed.sparkSession
    number = F.expr("bitmap_bucket_number(line + 1)")
    maps = suspects.groupBy("file", number.alias("bucket")).agg(F.expr("bitmap_construct_agg(bitmap_bit_position(line + 1))").alias("bitmap"))
    maps = materialise(maps.withColumnsRenamed({"file": "_file", "bucket": "_bucket"}), "bitmaps")
    waves = 1
    while True:  # until the bitmaps of a wave of files are small, or those of a single file
        load = maps.groupBy(F.pmod("_file", F.lit(waves)).alias("wave")).agg(
            (F.count("*") * _BITMAP).alias("octets"), F.countDistinct("_file").alias("files"))
        if not load.where((F.col("octets") > wave) & (F.col("files") > 1)).limit(1).collect():
            break
        waves *= 2
    out = new_workdir(spark, "suspects")
    for k in range(waves):
        mine = placed.where(F.pmod(F.xxhash64("path"), F.lit(waves)) == k)  # Spark lists these files alone
        bitmaps = maps.where(F.pmod("_file", F.lit(waves)) == k)
        hit = mine.join(F.broadcast(bitmaps), (F.col("file") == F.col("_file")) & (number == F.col("_bucket")))
        hit = hit.where(_bit_of(F.col("bitmap"), F.expr("bitmap_bit_position(line + 1)")))
        texts = hit.select(F.translate("text", BLANKS, "").alias("norm"), F.char_length("text").cast("long").alias("n_chars"), "doc_id", "file", "line")
        texts.write.mode("append").option("compression", "zstd").parquet(out)
    return spark.read.schema("norm string, n_chars long, doc_id long, file long, line long").parquet(out)


# ---- 4 and 5: groups


def groups(docs: DataFrame, text: str = "text", letter: int = LETTER, owned: int = OWNED, wave: int = WAVE) -> DataFrame:
    """doc_id, keep_id, group_size, kept and text_sha256 of every row."""
    placed = _placed(docs, text)
    ranges = Ranges(placed.count(), owned)
    letters = materialise(_letters(placed, ranges, letter), "letters")
    answered = materialise(_answered(letters, ranges), "answers")
    bit = F.getbit(F.get("bits", F.shiftright("place", 6)), F.pmod("place", F.lit(64)))
    marked = letters.where(F.col("code").isNull()).join(answered, ["letter", "owner"], "left").select(
        "doc_id", "n_chars", "sha", "file", "line", (F.col("twin") | F.coalesce(bit == 1, F.lit(False))).alias("suspect"))
    marked = materialise(marked, "marked")
    alone = marked.where(~F.col("suspect"))
    suspects = marked.where("suspect")

    texts = _suspect_texts(placed, suspects.select("file", "line"), wave)
    # The largest of: most code points, an id, the smallest id, and one row among what is left.
    row = F.struct("n_chars", F.col("doc_id").isNotNull().alias("named"), F.bitwise_not("doc_id").alias("back"), "file", "line")
    equal = texts.groupBy("norm").agg(F.count("*").alias("group_size"), F.max(row).alias("best")).where("group_size > 1")
    equal = materialise(equal.select(F.unhex(F.sha2("norm", 256)).alias("sha"), "group_size", "best"), "groups")
    found = look_up(suspects, equal, "sha", "group_size")

    best = F.col("best")
    stays = (best["file"] == F.col("file")) & (best["line"] == F.col("line"))
    sha = F.lower(F.hex("sha")).alias("text_sha256")
    single = [F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), sha]
    in_group = found.where(best.isNotNull()).select("doc_id", F.bitwise_not(best["back"]).alias("keep_id"), "group_size", stays.alias("kept"), sha)
    return alone.select("doc_id", *single).unionByName(found.where(best.isNull()).select("doc_id", *single)).unionByName(in_group)


def keep_one(docs: DataFrame, text: str = "text") -> DataFrame:
    """Rows of ``docs``, all columns kept, without those that are equal to one that stays.

    Rows that repeat an id are told apart by their text's digest; of rows equal in both
    exactly one stays.
    """
    kept = materialise(groups(docs, text).where("kept").select("doc_id", "text_sha256"), "kept").withColumnsRenamed(
        {"doc_id": "_id", "text_sha256": "_sha"})
    digest = F.sha2(F.translate(F.coalesce(text, F.lit("")), BLANKS, ""), 256)
    tagged = docs.withColumn("_digest", digest)
    joined = tagged.join(kept, (tagged["_digest"] == kept["_sha"]) & tagged["doc_id"].cast("long").eqNullSafe(kept["_id"]), "left_semi")
    return joined.select(*docs.columns)
