"""Vector codes, exact copies and periodic runs against plain models of them."""

from __future__ import annotations

import hashlib
import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from wavecount.llm import active_lloyd, golomb_dedup, word_runs
from wavecount.llm.common import look_up, visible_to_workers
from wavecount.session import materialise

CLASHING = "doc_id long, text string, letter string, owner string, sha string, file string, line string, bits string, norm string"


def documents(spark, rows):
    visible_to_workers(spark)
    return spark.createDataFrame([(*r, *["x"] * 7) for r in rows], CLASHING).repartition(3)


# ---- 11: vector codes


def _plain_codes(rows, entries=64, parts=16, rounds=2):
    """Full comparisons in whole numbers of any size."""
    kept = [(k, v, lab) for k, v, lab in rows if v and all(x is not None and math.isfinite(x) for x in v)]
    if not kept:
        return []
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    cut = [[[math.floor(256 * x) for x in v][p * len(v) // parts:(p + 1) * len(v) // parts] for p in range(parts)] for _, v, _ in kept]
    books = [[x[p] for x in cut[:entries]] for p in range(parts)]

    def nearest():
        return [[min((sum((a - b) ** 2 for a, b in zip(x[p], e, strict=True)), k) for k, e in enumerate(books[p])) for p in range(parts)] for x in cut]

    for _ in range(rounds):
        found = nearest()
        for p in range(parts):
            for k in range(len(books[p])):
                own = [x[p] for x, f in zip(cut, found, strict=True) if f[p][1] == k]
                if own:
                    books[p][k] = [sum(c) // len(own) for c in zip(*own, strict=True)]
    found = nearest()
    digest = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    errors = [sum(d for d, _ in f) for f in found]
    label_error = Counter()
    for (_, _, lab), e in zip(kept, errors, strict=True):
        label_error[lab] += e
    return [(k, "".join(f"{e:02x}" for _, e in f), err, label_error[lab], digest)
            for (k, _, lab), f, err in zip(kept, found, errors, strict=True)]


VECTORS = "vec_id long, embedding array<float>, label int, x string, code string, errors string, n string"


def _vectors(spark, rows):
    visible_to_workers(spark)
    return spark.createDataFrame([(k, v, lab, "x", "x", "x", "x") for k, v, lab in rows], VECTORS).repartition(3)


def _check_codes(spark, rows, **settings):
    got = active_lloyd.codes(_vectors(spark, rows), **settings).collect()
    want = _plain_codes([(k, v and [None if x is None else float(np.float32(x)) for x in v], lab) for k, v, lab in rows], **settings)
    assert Counter(map(tuple, got)) == Counter(want)


def test_codes_match_full_comparisons(spark):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(9, 32)) * 0.2
    rows = [(int(k), [float(x) for x in centres[k % 9] + rng.normal(size=32) * 0.05], None if k % 7 == 0 else int(k % 4)) for k in range(400)]
    rows += [(3, rows[3][1], 1), (None, rows[5][1], None), (None, rows[6][1], 2)]  # repeated rows and ids, no id
    rows += [(900, None, 1), (901, [], 1), (902, [float("nan")] * 32, 1), (903, [1.0, None] * 16, 1), (904, [float("inf")] * 32, 1), (905, [0.5] * 8, 1)]
    got = active_lloyd.codes(_vectors(spark, rows)).collect()
    usable = [(k, v and [None if x is None else float(np.float32(x)) for x in v], lab) for k, v, lab in rows if k != 905]
    assert Counter(map(tuple, got)) == Counter(_plain_codes(usable))


def test_codes_of_ties_few_rows_and_none(spark):
    _check_codes(spark, [])
    _check_codes(spark, [(1, None, 1)])
    _check_codes(spark, [(k, [float(k % 3) / 256] * 16, None) for k in range(40)])  # equal entries: the lower index
    _check_codes(spark, [(k, [k / 256.0] * 4, k) for k in range(-5, 5)], entries=3, parts=2, rounds=5)
    with pytest.raises(ValueError):
        active_lloyd.codes(_vectors(spark, [(1, [1.0] * 7, 1)])).collect()


def test_moved_entries_alone_are_compared(spark):
    """A later round compares less than all and gives what a full comparison gives."""
    rng = np.random.default_rng(5)
    x = rng.integers(-40, 40, (300, 4, 2))
    books = rng.integers(-40, 40, (4, 16, 2))
    codes, errors, full = active_lloyd.assign(x, books)
    for _ in range(5):
        moved = rng.random((4, 16)) < 0.2
        new = np.where(moved[:, :, None], rng.integers(-40, 40, books.shape), books)
        codes, errors, compared = active_lloyd.reassign(x, new, moved, codes, errors)
        books = new
        want = active_lloyd.assign(x, books)
        assert (codes == want[0]).all() and (errors == want[1]).all() and compared < 0.7 * full
    rows = [(k, [float(v) for v in rng.choice([0.0, 0.5, 1.0], 16)], 1) for k in range(200)]
    state, _ = active_lloyd.encode(_vectors(spark, rows), entries=32, parts=16, rounds=4)
    assert state.agg({"compared": "sum"}).first()[0] < 5 * 200 * 16 * 32


def test_distances_are_exact_in_both_forms():
    rng = np.random.default_rng(6)
    for top in (1_000, 1 << 21, 1 << 25):
        x, e = rng.integers(-top, top, (50, 8)), rng.integers(-top, top, (9, 8))
        want = [[sum((int(a) - int(b)) ** 2 for a, b in zip(r, c, strict=True)) for c in e] for r in x]
        assert active_lloyd.distances(x, e).tolist() == want


# ---- 12: exact copies


def test_golomb_round_trip():
    rng = np.random.default_rng(7)
    for n, width in ((1, 1), (1, 10), (10, 10), (1_000, 1 << 40), (5_000, 6_000), (3, 1 << 47)):
        values = np.sort(rng.choice(width, n, replace=False)) if width < 1 << 20 else np.unique(rng.integers(0, width, n))
        code = golomb_dedup.golomb(values, width)
        assert (golomb_dedup.ungolomb(code, len(values), width) == values).all()
    values = np.unique(rng.integers(0, 1 << 36, 1 << 16))
    assert len(golomb_dedup.golomb(values, 1 << 36)) * 8 < 24 * len(values)  # 64 bits each without


def test_ranges_cover_all_fingerprints():
    ranges = golomb_dedup.Ranges(100, owned=7)
    prints = np.arange(1 << ranges.bits)
    owners = ranges.owner(prints)
    for owner in range(ranges.owners):
        own = prints[owners == owner]
        assert own[0] == ranges.start(owner) and len(own) == ranges.width(owner)


def test_answers_name_what_other_letters_sent():
    got = golomb_dedup.answers([np.array([1, 5, 9]), np.array([5]), np.array([2, 9]), np.zeros(0, np.int64)])
    assert [a.tolist() for a in got] == [[False, True, True], [True], [False, True], []]


def _plain_groups(rows):
    groups = {}
    for k, (key, text) in enumerate(rows):
        norm = (text or "").translate({ord(c): None for c in " \t\n\x0b\x0c\r"})
        groups.setdefault(norm, []).append((-len(text or ""), key is None, key or 0, k))
    out = Counter()
    for norm, members in groups.items():
        first = min(members)
        sha = hashlib.sha256(norm.encode()).hexdigest()
        for m in members:
            out[None if m[1] else m[2], None if first[1] else first[2], len(members), sha] += 1
    return out, len(groups)


def _copies():
    rng = np.random.default_rng(8)
    rows = [(k, " ".join(rng.choice(["a", "bb", "ccc", "ä", "\U0001f642"], int(rng.integers(0, 6))))) for k in range(300)]
    rows += [(1_000 + k, "the same text" + " \t\n"[k % 3] * (k % 5)) for k in range(200)]  # a large group
    rows += [(k, f"only {k}") for k in range(2_000, 2_200)]
    rows += [(None, "the same text"), (None, "without id"), (None, "without id"), (2_000, "only 2000"), (2_000, "only 2000"), (3_000, None),
             (3_001, ""), (3_002, " \r\x0b\x0c"), (3_003, "long " * 40_000), (3_004, "long" * 40_000), (3_005, "\xa0x"), (3_006, "x")]
    return rows


@pytest.mark.parametrize("letter, owned, wave", [(65_536, 1 << 22, 1 << 25), (7, 50, 4_096), (1, 3, 1)])
def test_groups_match_a_plain_model(spark, letter, owned, wave):
    rows = _copies()
    got = golomb_dedup.groups(documents(spark, rows), letter=letter, owned=owned, wave=wave).collect()
    want, n_groups = _plain_groups(rows)
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == want
    assert sum(r.kept for r in got) == n_groups
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


def test_groups_of_a_table_of_files(spark, tmp_path):
    """Rows keep their places in the files they are read from; nothing is copied for that."""
    rows = _copies()
    documents(spark, rows).repartition(5).write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    got = golomb_dedup.groups(docs, wave=1).collect()  # a wave for each file
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == _plain_groups(rows)[0]


def test_texts_that_share_a_fingerprint_stay_apart(spark, monkeypatch):
    monkeypatch.setattr(golomb_dedup, "_SPARE_BITS", 0)
    rows = [(k, f"text {k}") for k in range(500)] + [(k + 1_000, f"text {k}") for k in range(0, 500, 50)]
    ranges = golomb_dedup.Ranges(len(rows))
    prints = ranges.fingerprints([hashlib.sha256(t.replace(" ", "").encode()).digest() for _, t in rows[:500]])
    assert len(np.unique(prints)) < 500
    got = golomb_dedup.groups(documents(spark, rows)).collect()
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == _plain_groups(rows)[0]


def test_one_of_equal_rows_stays(spark):
    rows = _copies()
    docs = documents(spark, rows)
    got = golomb_dedup.keep_one(docs)
    assert got.columns == docs.columns
    norms = Counter((r.text or "").translate({ord(c): None for c in " \t\n\x0b\x0c\r"}) for r in got.collect())
    assert len(norms) == _plain_groups(rows)[1]
    twice = {n for n, k in norms.items() if k > 1}  # rows equal in id and text
    assert twice <= {"only2000", "withoutid"}


def test_no_documents(spark):
    assert golomb_dedup.groups(documents(spark, [])).collect() == []
    assert word_runs.digest(word_runs.runs(documents(spark, []))).collect() == []


def test_look_up_keeps_all_rows(spark):
    rows = spark.createDataFrame([(k, None if k % 3 == 0 else k % 11) for k in range(3_000)], "id long, k long")
    found = rows.where("k is null or k < 9").groupBy("k").count()
    got = look_up(rows, materialise(found), "k", "count").collect()
    want = {r.k: r["count"] for r in found.collect()}
    assert Counter((r.id, r.k, r["count"]) for r in got) == Counter((r.id, r.k, want.get(r.k)) for r in rows.collect())


# ---- 13: periodic runs


def _plain_runs(words):
    found = {}
    for q in range(1, len(words) // 4 + 1):
        j = 0
        while j + q < len(words):
            start = j
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j - start + q >= max(6, 4 * q):
                found.setdefault((start, j - start + q), q)
            j += j == start
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def _plain_answer(key, text):
    words = (text or "").encode().split()
    n = len(words)
    h = None if key is None else zlib.crc32(str(key).encode())
    if h is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = _plain_runs(words)
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=None)
    dropped = {i for s, m, q in runs for i in range(s + q, s + m)}
    short = b" ".join(w for i, w in enumerate(words) if i not in dropped)
    lines = "".join(f"{s},{m},{q}\n" for s, m, q in runs)
    return (key, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
            hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(short).hexdigest())


def _rhythms(rng, n):
    words = []
    while len(words) < n:
        root = [f"w{x}" for x in rng.integers(0, int(rng.integers(1, 5)), int(rng.integers(1, 12)))]
        words += (root * int(rng.integers(1, 9)))[: int(rng.integers(1, 80))]
    return " ".join(words[:n])


def test_runs_match_a_plain_search(spark):
    rng = np.random.default_rng(9)
    rows = [(k, _rhythms(rng, int(rng.integers(0, 200)))) for k in range(400)]
    rows += [(1, "a " * 5), (2, "a " * 6), (2, "a " * 6), (None, "a b " * 9), (3, None), (4, ""), (5, " \t\x0b\x0c\r\n"), (6, "a\xa0a a\xa0a a a a a a a a"),
             (7, "x\ty\nx\x0by\x0cx\ry x y"), (8, "中文 " * 8), (9, ("a b c d " * 4 + "a b c ") * 5)]
    rows += [(k, " ".join(f"v{i}" for i in range(60))) for k in range(500, 560)]  # by their ids some repeat a part
    got = word_runs.digest(word_runs.runs(documents(spark, rows), word_runs.repeated_tail)).collect()
    assert Counter(map(tuple, got)) == Counter(_plain_answer(k, t) for k, t in rows)


@pytest.mark.parametrize("batch", [1, 40, 1 << 18])
def test_runs_do_not_cross_documents(spark, batch):
    rows = [(k, "a " * (k % 8)) for k in range(40)] + [(100 + k, "x y " * 3) for k in range(20)]
    found = {r.doc_id: [tuple(x) for x in r.runs] for r in word_runs.runs(documents(spark, rows), batch=batch).collect()}
    assert found == {k: _plain_runs(t.split()) for k, t in rows}


def test_runs_of_long_texts():
    """Time in proportion to the words, whatever repeats: one word, long periods, periods within periods, none."""
    rng = np.random.default_rng(10)
    n = 120_000
    fibonacci = [b"a", b"ab"]
    while len(fibonacci[-1]) < n:
        fibonacci.append(fibonacci[-1] + fibonacci[-2])
    nested = b"a"
    for k in range(9):
        nested = (nested * 4 + bytes([98 + k]))
    texts = [b"a" * n, bytes(rng.integers(0, 2, n, np.uint8)), fibonacci[-1][:n], nested[:n],
             (bytes(rng.integers(0, 256, n // 5, np.uint8)) * 6)[:n]]
    got = word_runs.find_runs(*word_runs.numbered([[bytes([c]) for c in t] for t in texts]))
    assert got[0] == [(0, n, 1)] and got[2] == [] and (0, n, n // 5) in got[4]
    for text, runs in zip(texts, got, strict=True):
        for start, length, q in runs:
            part = text[start : start + length]
            assert part[q:] == part[:-q] and length >= max(6, 4 * q)
    for text, runs in zip(texts[1:4], got[1:4], strict=True):
        small = [bytes([c]) for c in text[:3_000]]
        assert word_runs.find_runs(*word_runs.numbered([small]))[0] == _plain_runs(small)


@pytest.mark.parametrize("wave", [1 << 25, 1])
def test_rows_are_left_out_where_they_are(spark, tmp_path, wave):
    from wavecount.llm.common import in_files, with_places, without_rows

    spark.range(0, 100_000, 1, 3).withColumn("_file", F.lit("a clashing name")).drop("_file").write.parquet(str(tmp_path / "rows"))
    docs = spark.read.parquet(str(tmp_path / "rows"))
    assert in_files(docs) is docs
    gone = with_places(docs).where("id % 7 = 0 or id > 90000")
    assert sorted(r.id for r in without_rows(docs, gone, wave).collect()) == [k for k in range(90_001) if k % 7]
    made = in_files(spark.range(10))
    assert without_rows(made, with_places(made).where("id = 3")).count() == 9
