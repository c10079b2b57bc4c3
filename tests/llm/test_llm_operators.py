"""Each operator against a plain model of it, over rows of every odd kind."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pandas as pd
import public_tokenizers
import pytest

from wavecount.llm import (
    bitplanes, blob_ledger, decontamination, host_paths, learned_partitions, line_crf, ordinal_toxicity, piece_transducer,
    signature_trees, surrogates)
from wavecount.llm.common import visible_to_workers
from wavecount.llm.components import components

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()
ODD = [(1, None), (2, ""), (3, " "), (4, "one  two\n\n three "), (5, "ÀÉ ünï 漢字 🙂 x y"), (5, "ÀÉ ünï 漢字 🙂 x y"),
       (None, "a row without id"), (6, "long " * 30_000), (7, "tab\tand\x0bfeed\r\n"), (8, "A" * 5_000)]
DOCS = "doc_id long, text string, ids string, score string, host string, part string, n_words string"


def documents(spark, rows, schema=DOCS):
    """A table with columns whose names the operators use themselves."""
    visible_to_workers(spark)
    return spark.createDataFrame([(*r, "x", "x", "x", "x", "x") for r in rows], schema).repartition(3)


def prose(rng, n):
    return " ".join(rng.choice(WORDS, n))


# ---- 1: bit planes


def test_planes_round_trip():
    import zstandard

    rng = np.random.default_rng(1)
    compress, expand = zstandard.ZstdCompressor().compress, zstandard.ZstdDecompressor().decompress
    for ids in (np.zeros(5, "<u2"), rng.integers(0, 50_257, 1_000).astype("<u2"), rng.integers(0, 1 << 32, 77, dtype=np.uint64).astype("<u4"), np.zeros(0, "<u4")):
        planes = bitplanes.to_planes(ids, compress)
        assert (bitplanes.from_planes(planes, len(ids), expand) == ids).all()


def test_joined_crc():
    data = bytes(range(256)) * 40
    for cuts in ((0, 10_240), (0, 4, 4_000, 10_240), (0, 0, 5, 10_240)):
        parts = [(b - a, zlib.crc32(data[a:b])) for a, b in zip(cuts, cuts[1:])]
        assert bitplanes.joined_crc(parts) == zlib.crc32(data)


@pytest.mark.parametrize("block", [7, 65_536])
def test_bit_planes_match_the_library(spark, tmp_path, block):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    rows = [(k, t if k != 6 else "long " * 3_000) for k, t in ODD]
    chunks = bitplanes.write_planes(documents(spark, rows), str(tmp_path / "planes"), open(path, encoding="utf-8").read(), block=block)
    got = bitplanes.read_documents(chunks).collect()
    tokenizer = Tokenizer.from_file(path)
    want = Counter()
    for key, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        want[key, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())] += 1
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == want
    at = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
    order = [-1 if r.doc_id is None else r.doc_id for r in sorted(got, key=lambda r: r.start)]
    assert order == sorted(order)


def test_bit_planes_of_nothing(spark, tmp_path):
    chunks = bitplanes.write_planes(documents(spark, []), str(tmp_path / "none"), open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8").read())
    assert bitplanes.read_documents(chunks).collect() == []


def test_words_match_the_library_in_mixed_white_space():
    """No space within a run of white space is a border: some tokens span spaces and U+00A0."""
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    library, words = Tokenizer.from_file(path), bitplanes._Words(open(path, encoding="utf-8").read())
    rng, signs = np.random.default_rng(12), [" ", " ", "\xa0", "\t", "\n", "\r\n", "\x1c", "\x85", "\u2003", "\u3000", "\u180e", "a", "b1", "."]
    values = ["a \xa0 \xa0 b", " \xa0 \xa0", "\xa0 \xa0 \xa0 x", "x \xa0 y", "a \t \t b", " ", "", "  a", "a  "]
    values += ["".join(rng.choice(signs, int(rng.integers(1, 16)))) for _ in range(5_000)]
    values += [f"a {chr(c)} {chr(c)} b{chr(c)} " for c in range(0x3100) if chr(c).isspace() or not chr(c).isprintable()]
    _equal_to_library(library, words, values)


def _equal_to_library(library, words, values):
    ids, lengths = words.encode(pa.array(values, pa.string()))
    assert len(ids) == lengths.sum()
    for value, found in zip(values, np.split(ids, np.cumsum(lengths)[:-1]), strict=True):
        assert found.tolist() == library.encode(value, add_special_tokens=False).ids, repr(value)


def test_words_match_the_library_at_every_code_point():
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    library, words = Tokenizer.from_file(path), bitplanes._Words(open(path, encoding="utf-8").read())
    points = [c for c in range(0x20000) if not 0xD800 <= c < 0xE000]
    for at in range(0, len(points), 20_000):
        _equal_to_library(library, words, [f"a {chr(c)}b{chr(c)} {chr(c)} 1{chr(c)}'s" for c in points[at : at + 20_000]])


def test_words_match_the_library_above_the_first_planes():
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    library, words = Tokenizer.from_file(path), bitplanes._Words(open(path, encoding="utf-8").read())
    points = [*range(0x2A600, 0x2A800), *range(0x2EBE0, 0x2EE80), *range(0x31340, 0x32400), *range(0xE0000, 0xE0200), 0xF0000, 0x10FFFD]
    _equal_to_library(library, words, [f"a {chr(c)}b{chr(c)} {chr(c)} 1{chr(c)}'s" for c in points])


def test_signs_beside_words_make_no_new_words():
    """A word is given to the library once, whatever stands beside it."""
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    library, words = Tokenizer.from_file(path), bitplanes._Words(open(path, encoding="utf-8").read())
    given, merger = [], words.merger

    class Counted:
        token_to_id = merger.token_to_id

        def encode_batch_fast(self, texts, **kind):
            given.extend(texts)
            return merger.encode_batch_fast(texts, **kind)

    words.merger = Counted()
    rng = np.random.default_rng(3)
    pool = list(dict.fromkeys("".join(rng.choice(list("abcdefgh"), 7)) for _ in range(200)))
    values = [f"so {w}{sign} it" for w in pool for sign in (".", ",", ";", ":", "!", "?", "),", "...", "'s", "'ll", ".\nSo", "42", "\xa0%", "-", '"')]
    _equal_to_library(library, words, values)
    assert len(words.known) < 2 * len(pool)
    assert sum(map(len, given)) < 12 * 2 * len(pool)


@pytest.mark.parametrize("with_octet", [True, False])
def test_words_match_the_library_in_any_order_of_signs(monkeypatch, with_octet):
    """Endings after apostrophes, added tokens and white space side by side, in several texts of a slice and in long ones."""
    from tokenizers import Tokenizer

    if not with_octet:  # as a vocabulary that has merges of every octet
        monkeypatch.setattr(bitplanes._Words, "_unused_octet", lambda self, model: None)
    path = public_tokenizers.path("byte_bpe_50k.json")
    library, words = Tokenizer.from_file(path), bitplanes._Words(open(path, encoding="utf-8").read())
    assert (words.between is not None) == with_octet
    rng = np.random.default_rng(8)
    signs = [" "] * 6 + list("'''\".,-19sdmtlvreabZ\n\t\x1c\x7f\xa0\u2003\u200bñ́漢か😀\u0378\U00031350") + ["'s", "'ll", "'S", "ve", "re", "<|endoftext|>", "<|endof", "text|>"]
    for octets in (1, 8, 60, 4 << 20):
        monkeypatch.setattr(bitplanes, "ENCODED_OCTETS", octets)
        _equal_to_library(library, words, ["".join(rng.choice(signs, int(rng.integers(0, 30)))) for _ in range(1_500)])
    for values in ([""], ["", ""], ["'"], ["'", "s", "<|endof", "text|>", "", " ", "'ll"]):
        _equal_to_library(library, words, values)


def test_words_match_the_library_while_they_are_forgotten(monkeypatch):
    """Words are learned, forgotten and learned again, line ends and added tokens among them."""
    from tokenizers import Tokenizer

    monkeypatch.setattr(bitplanes, "CACHED_WORDS", 60)
    path = public_tokenizers.path("byte_bpe_50k.json")
    library, words = Tokenizer.from_file(path), bitplanes._Words(open(path, encoding="utf-8").read())
    rng = np.random.default_rng(5)
    pool = ["the", "Strasse", "it's", "x\ny", "\n", "\n\n", "<|endoftext|>", "end<|endoftext|>", "don't,", "42", "😀", "", "a" * 300]
    pool += ["".join(rng.choice(list("abcdeñ, .\n"), int(rng.integers(1, 9)))) for _ in range(300)]
    for _ in range(60):
        _equal_to_library(library, words, [" ".join(rng.choice(pool, int(rng.integers(0, 12)))) for _ in range(int(rng.integers(1, 9)))])
    sliced = pa.array(["left out", "kept one", "", " kept  two "]).slice(1)
    ids, lengths = words.encode(sliced)
    assert [len(library.encode(v).ids) for v in sliced.to_pylist()] == lengths.tolist()
    assert [len(a) for a in words.encode(pa.array([], pa.string()))] == [0, 0]


# ---- 2: line classifier


def _labelled(n=240):
    rng, rows, labels = np.random.default_rng(2), [], []
    for k in range(n):
        good = k % 3 > 0
        lines = [prose(rng, 12).capitalize() + "." for _ in range(6)]
        if not good:
            lines[2:] = [w.upper() + "!! " + "$$$ " * 6 for w in rng.choice(WORDS, 4)]
        rows.append((k, "\n".join(lines)))
        labels.append((k, int(good), int(k % 4 == 0)))
    return rows, labels


def test_line_field_learns_and_handles_odd_rows(spark):
    rows, labels = _labelled()
    docs = documents(spark, rows + [(1_000 + (k or 0), t) for k, t in ODD])
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = line_crf.quality(docs, table).collect()
    assert len(got) == len(rows) + len(ODD) and all(0 <= r.score <= 1 for r in got)
    truth = {k: q for k, q, _ in labels}
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert {r.doc_id for r in held} == {k for k in truth if zlib.crc32(str(k).encode()) % 5 == 0}
    assert sum(r.predicted == truth[r.doc_id] for r in held) >= 0.95 * len(held)
    kept = line_crf.keep_good(docs, table)
    assert kept.columns == docs.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter(r.doc_id for r in got if r.predicted)


def test_line_field_without_labels(spark):
    table = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {(r.score, r.predicted) for r in line_crf.quality(documents(spark, ODD), table).collect()} == {(0.5, 1)}
    assert line_crf.quality(documents(spark, []), table).collect() == []


def test_marginals_equal_enumeration():
    rng = np.random.default_rng(3)
    odds, moves = rng.normal(size=5), rng.normal(size=(2, 2))
    sums = np.zeros(5)
    total = 0.0
    for state in range(32):
        y = [state >> k & 1 for k in range(5)]
        weight = np.exp(sum(o for o, v in zip(odds, y) if v) + sum(moves[a, b] for a, b in zip(y, y[1:])))
        total += weight
        sums += weight * np.array(y)
    model = line_crf.Model(np.zeros(1), moves, 1.0, 0.0)
    assert np.allclose(model.good_lines(odds.tolist()), sums / total)
    single, _ = line_crf._marginals(odds[None], moves, np.ones((1, 5), bool))
    assert np.allclose(single[0], sums / total)


# ---- 3: neighbours


def _vectors(spark, rows):
    visible_to_workers(spark)
    return spark.createDataFrame([(*r, "x", "x") for r in rows], "vec_id long, embedding array<float>, part string, vector string").repartition(3)


def test_neighbours_reach_the_recall_and_exact_scores(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(2_000, 16)).astype(np.float32)
    x[7] = x[950]
    rows = [(k, v.tolist()) for k, v in enumerate(x)]
    rows += [(9_000, None), (9_050, [0.0] * 16), (9_100, [float("nan")] * 16), (9_150, [1.0]), (None, x[0].tolist()), (9_200, [])]
    got = learned_partitions.search(_vectors(spark, rows)).collect()
    unit = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    found = defaultdict(list)
    for r in sorted(got, key=lambda r: (r.query_id, r["rank"])):
        assert abs(r.score - unit[r.query_id] @ unit[r.vec_id]) < 1e-12
        found[r.query_id].append(r.vec_id)
    assert set(found) == set(range(0, 2_000, 50)) and all(len(v) == 5 and k not in v for k, v in found.items())
    hits = 0
    for k, v in found.items():
        near = unit @ unit[k]
        near[k] = -2
        hits += len(set(v) & set(np.lexsort((np.arange(len(x)), -near))[:5].tolist()))
    assert hits >= 0.9 * 5 * len(found)
    assert found[950][0] == 7


def _recall(x, got, k=5):
    unit = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    found = defaultdict(list)
    for r in sorted(got, key=lambda r: (r.query_id, r["rank"])):
        found[r.query_id].append(r.vec_id)
    hits = 0
    for q, v in found.items():
        near = unit @ unit[q]
        near[q] = -2
        hits += len(set(v) & set(np.argpartition(-near, k)[:k].tolist()))
    return found, hits / (k * len(found))


def test_recall_of_a_large_table(spark, tmp_path):
    """Fifty thousand rows in loose groups; slots and blocks of queries are small here, so that parts are dealt out."""
    rng = np.random.default_rng(41)
    x = (rng.normal(size=(50, 24))[rng.integers(0, 50, 50_000)] + 0.7 * rng.normal(size=(50_000, 24))).astype(np.float32)
    visible_to_workers(spark)
    pd.DataFrame({"vec_id": np.arange(len(x)), "embedding": list(x)}).to_parquet(tmp_path / "vectors.parquet")
    table = spark.read.parquet(str(tmp_path / "vectors.parquet"))
    before = learned_partitions.SLOT, learned_partitions.QUERIES
    learned_partitions.SLOT, learned_partitions.QUERIES = 2_000, 50
    try:
        found, recall = _recall(x, learned_partitions.search(table.repartition(4)).collect())
    finally:
        learned_partitions.SLOT, learned_partitions.QUERIES = before
    assert set(found) == set(range(0, 50_000, 50)) and all(len(v) == 5 for v in found.values())
    assert recall >= 0.9


def test_a_small_table_is_cut_into_parts_and_short_answers_go_on(spark):
    """Three hundred rows are several parts; a query alone in its part finds five all the same."""
    rng = np.random.default_rng(42)
    x = rng.normal(size=(300, 8)).astype(np.float32)
    x[100:] = x[100] + 0.01 * rng.normal(size=(200, 8)).astype(np.float32)
    x[0] = -x[100] * 3
    assert learned_partitions.learn(x.astype(float), 9).second.shape[1] == 9
    found, recall = _recall(x, learned_partitions.search(_vectors(spark, [(k, v.tolist()) for k, v in enumerate(x)]), recall=0.01).collect())
    assert set(found) == {0, 50, 100, 150, 200, 250} and all(len(v) == 5 for v in found.values())


def test_neighbours_of_few_and_none(spark):
    got = learned_partitions.search(_vectors(spark, [(0, [1.0, 0.0]), (3, [1.0, 1.0]), (2, [2.0, 2.0])])).collect()
    assert [(r.query_id, r["rank"], r.vec_id) for r in sorted(got, key=lambda r: r["rank"])] == [(0, 1, 2), (0, 2, 3)]
    assert learned_partitions.search(_vectors(spark, [])).collect() == []


def test_parts_are_balanced():
    rng = np.random.default_rng(5)
    x = learned_partitions.unit(rng.normal(size=(640, 8)))
    part = learned_partitions.balanced_parts(learned_partitions.neighbour_graph(x), x, 16)
    assert np.bincount(part, minlength=16).min() >= 36 and np.bincount(part).max() <= 43


# ---- 4: toxicity


def test_grades_rise_with_insults(spark):
    rng, rows, labels = np.random.default_rng(6), [], []
    for k in range(400):
        toxic = k % 5 == 0
        words = prose(rng, 60).split()
        for at in rng.choice(60, (k // 5) % 9 + 1, replace=False) if toxic else []:
            words[at] = rng.choice(["idiot", "moron", "trash", "vequique"])
        rows.append((k, " ".join(words)))
        labels.append((k, 1, int(toxic)))
    probe = [(1_000, prose(rng, 50)), (1_001, prose(rng, 50) + " idiot"), (1_002, prose(rng, 20) + " idiot moron trash" * 6)]
    docs = documents(spark, rows + probe + [(2_000 + (k or 0), t) for k, t in ODD])
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    plain = documents(spark, [(k, t if k > 39 else f"{k} {k}{k}") for k, t in rows])  # some hold none of the chosen features
    assert ordinal_toxicity.train(plain, table).fitted == sum(zlib.crc32(str(k).encode()) % 5 != 0 for k, _ in rows)
    got = ordinal_toxicity.toxicity(docs, table).collect()
    assert len(got) == len(rows) + 3 + len(ODD)
    truth = {k: t for k, _, t in labels}
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert held and all(r.predicted == truth[r.doc_id] for r in held)
    by = {r.doc_id: r for r in got}
    assert by[1_000].severity < by[1_001].severity < by[1_002].severity and by[1_000].predicted == 0 < by[1_002].grade
    assert by[2_001].predicted == 0 and by[2_002].predicted == 0


def test_ordinal_regression_recovers_order():
    rng = np.random.default_rng(7)
    x = rng.normal(size=(3_000, 3))
    latent = x @ np.array([2.0, -1.0, 0.0]) + rng.logistic(size=3_000)
    model = ordinal_toxicity.fit(x, np.digitize(latent, [-1.0, 0.5, 2.0]), {"a": 0, "b": 1, "c": 2})
    assert np.allclose(model.weights, [2, -1, 0], atol=0.25) and np.allclose(model.thresholds, [-1, 0.5, 2], atol=0.25)


def test_toxicity_without_labels(spark):
    table = spark.createDataFrame([(1, 1, 1)], "doc_id long, quality int, toxic int")
    assert {r.score for r in ordinal_toxicity.toxicity(documents(spark, ODD), table).collect()} == {0.0}


# ---- 5: pieces


def test_pieces_match_the_library_and_come_back(spark):
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    model, library = piece_transducer.model_bytes(path), sentencepiece.SentencePieceProcessor(model_file=path)
    more = [(20, " lead"), (21, "trail "), (22, "   "), (23, "a   b    c"), (24, "x▁y ▁z"), (25, "\x00\x07 ctrl"), (26, "ﬁ ½ Å İ"), (27, "🙂🙃")]
    rows = ODD + more
    docs = documents(spark, rows)
    got = Counter((r.doc_id, tuple(r.ids)) for r in piece_transducer.encode(docs, model).collect())
    assert got == Counter((k, tuple(library.encode(t or ""))) for k, t in rows)
    back = piece_transducer.decode(piece_transducer.encode(docs, model), model).collect()
    assert Counter(back) == Counter((k, (t or "").replace("▁", " ")) for k, t in rows)
    assert all(r.round_trip for r in piece_transducer.digest(docs, model).collect())
    with_ids = piece_transducer.with_ids(docs, model)
    assert with_ids.columns == [*docs.columns, "piece_ids"] and with_ids.count() == len(rows)
    assert piece_transducer.digest(documents(spark, []), model).collect() == []


def _model(kind, pieces, normaliser=None, **settings):
    from sentencepiece import sentencepiece_model_pb2

    proto = sentencepiece_model_pb2.ModelProto()
    kinds = sentencepiece_model_pb2.ModelProto.SentencePiece
    for name, k in (("<unk>", kinds.UNKNOWN), ("<s>", kinds.CONTROL), ("</s>", kinds.CONTROL)):
        proto.pieces.add(piece=name, score=0, type=k)
    if settings.pop("octets", False):
        for b in range(256):
            proto.pieces.add(piece=f"<0x{b:02X}>", score=0, type=kinds.BYTE)
        proto.trainer_spec.byte_fallback = True
    for piece, score in pieces:
        proto.pieces.add(piece=piece, score=score, type=kinds.NORMAL)
    proto.trainer_spec.model_type = kind
    if normaliser:
        import sentencepiece

        rules = sentencepiece_model_pb2.ModelProto()
        rules.ParseFromString(sentencepiece.SentencePieceNormalizer(rule_name=normaliser).serialized_model_proto())
        proto.normalizer_spec.precompiled_charsmap = rules.normalizer_spec.precompiled_charsmap
    for name, value in settings.items():
        setattr(proto.normalizer_spec, name, value)
    return proto.SerializeToString()


@pytest.mark.parametrize("octets", [True, False])
@pytest.mark.parametrize("normaliser", [None, "nmt_nfkc", "nmt_nfkc_cf"])
@pytest.mark.parametrize("kind", [1, 2])  # unigram, where the weights decide, and merges
def test_hand_made_models_match_the_library(kind, normaliser, octets):
    """Scores decide the path of unigram models; the character map and folding are the model's."""
    import sentencepiece

    rng = np.random.default_rng(21)
    pieces = sorted({"".join(rng.choice(list("abcd▁"), 1)) + "".join(rng.choice(list("abcd"), int(rng.integers(0, 4)))) for _ in range(120)} | set("abcd▁fi.½"))
    scores = -rng.permutation(len(pieces)).astype(float)  # whole numbers: the library adds in single precision, where others tie by rounding
    if kind == 2:  # as in training, pieces come after what they are made of
        pieces.sort(key=len)
        scores = [-float(k) for k in range(len(pieces))]
    model = _model(kind, zip(pieces, scores, strict=True), normaliser, remove_extra_whitespaces=normaliser is not None, octets=octets)
    library, machine = sentencepiece.SentencePieceProcessor(model_proto=model), piece_transducer.Transducer(model)
    signs = [*"abcd" * 4, " ", " ", "ﬁ", "½", "Ａ", "\u3000", "\t", "é", "e\u0301", "漢", "🙂", "A", ".", "\x07", "\ufeff"]
    texts = ["", " ", "  ab  ", "ﬁ ½ ＡB\u3000c"] + ["".join(rng.choice(signs, int(rng.integers(1, 40)))) for _ in range(800)]
    for text in texts:
        assert machine.encode(text).tolist() == library.encode(text), repr(text)


# ---- 6: benchmark passages


def _words(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def _contamination(text, items):
    words, hit, found = _words(text), set(), set()
    for item, value in items:
        own = _words(value)
        for at in range(max(1, len(own) - 9) if own else 0):
            window = own[at : at + 10]
            for k in range(len(words) - len(window) + 1):
                if words[k : k + len(window)] == window:
                    hit.update(range(k, k + len(window)))
                    found.add(str(item))
    names = ",".join(sorted(found))
    return len(words), len(hit), len(found), hashlib.sha256(names.encode()).hexdigest(), bool(hit)


@pytest.mark.parametrize("limit", [8_000_000, 300])
def test_contamination_equals_search(spark, limit):
    rng = np.random.default_rng(8)
    items = [(1, prose(rng, 25)), (2, "Short item!"), (3, None), (4, ""), (5, prose(rng, 10)), (10, "short, ITEM"), (6, "é ü")]
    rows = ODD[:7] + [(30, "Begin " + items[0][1].upper().replace(" ", "--") + " end"), (31, "x " + " ".join(items[0][1].split()[3:14]) + " y"),
                      (32, "a short  item; here É ü é ü"), (33, " ".join(items[0][1].split()[:9])), (34, items[4][1] + " " + items[4][1]), (35, prose(rng, 400))]
    bench = spark.createDataFrame([(*i, "x") for i in items], "item_id long, text string, window string")
    scanned = decontamination.scan(documents(spark, rows), bench, limit)
    got = decontamination.digest(scanned).collect()
    want = Counter((k, *_contamination(t, items)) for k, t in rows)
    assert Counter((r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in got) == want
    spans = {r.doc_id: [rows[[k for k, _ in rows].index(30)][1][s.start : s.end] for s in r.spans] for r in got if r.doc_id == 30}
    assert spans[30] == [items[0][1].upper().replace(" ", "--")]
    clean = decontamination.keep_clean(documents(spark, rows), bench, limit)
    assert Counter(r.doc_id for r in clean.collect()) == Counter(k for k, t in rows if not _contamination(t, items)[-1])


def test_items_without_an_id_contaminate_unnamed(spark):
    bench = spark.createDataFrame([(None, "hidden item here"), (None, "both know this"), (7, "both know this")], "item_id long, text string")
    docs = documents(spark, [(1, "a hidden item, here"), (2, "Both know this!"), (3, "hidden here")])
    for limit in (8_000_000, 20):
        got = {r.doc_id: r for r in decontamination.digest(decontamination.scan(docs, bench, limit)).collect()}
        assert {k: (r.n_hit, r.n_items, r.contaminated) for k, r in got.items()} == {1: (3, 0, True), 2: (3, 1, True), 3: (0, 0, False)}
        assert got[2].items_sha256 == hashlib.sha256(b"7").hexdigest() and got[1].items_sha256 == hashlib.sha256(b"").hexdigest()
        assert [r.doc_id for r in decontamination.keep_clean(docs, bench, limit).collect()] == [3]


def test_no_benchmark(spark):
    bench = spark.createDataFrame([], "item_id long, text string")
    assert not any(r.contaminated for r in decontamination.digest(decontamination.scan(documents(spark, ODD), bench)).collect())


# ---- 7: pages


PAGE = ('<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body><nav><a href="/">Menu</a></nav>'
        '<div class="cookie-notice">We use cookies</div><!-- <p>no</p> --><div class="ad">Buy</div><article class="post-%d"><h1>Head &amp; line</h1>'
        "<p><b>First  block<br><p>Second\n&nbsp;&lt;x&gt; %s</p><form><p>Mail</p></form><ul><li>One</li><li>Two</li></ul></article>"
        '<section id="comments"><p>A reader writes a long comment that says nothing much at all</p></section><aside><p>Side</p></aside>'
        "<footer>&copy; us</footer></body></html>")
TEXT = "Head & line First block Second <x> %s One Two"


def test_pages_by_host(spark):
    visible_to_workers(spark)
    rows = [(k, f"http://Host.example/{k}", PAGE % (k, "w " * k)) for k in range(1, 9)]
    odd = [(20, "http://host.example/x", None), (21, None, ""), (22, "odd", "plain text, no <tags"), (23, "http://b.example/", "<div><p>cut off <b>here"),
           (24, "http://b.example/2", PAGE % (1, "z")), (24, "http://b.example/2", PAGE % (1, "z")), (25, "x", "<" * 2_000), (26, "x", "<p title=\"a>b\">c</p>")]
    pages = spark.createDataFrame([(*r, "x") for r in rows + odd], "page_id long, url string, html string, host string").repartition(3)
    for limit in (10, 0):
        got = defaultdict(list)
        for r in host_paths.extract(pages, limit).collect():
            assert r.n_chars == len(r.text)
            got[r.page_id].append(r.text)
        for k in range(1, 9):
            assert got[k] == [TEXT % " ".join(["w"] * k)]
        assert got[20] == got[21] == [""] and got[23] == ["cut off here"] and got[24] == [TEXT % "z"] * 2 and got[26] == ["c"]
    assert host_paths.extract(pages.limit(0)).collect() == []


LONG = " ".join(["some words of the story"] * 20)
PARTS = {
    "lead": f'<body><div class="story"><div class="lead">The lead.</div><div class="text"><p>{LONG}</p></div></div></body>',
    "heading": f'<body><div class="content"><h1>Heading</h1><div class="text"><p>{LONG}</p></div></div></body>',
    "article": f'<body><article><h1>Heading</h1><div class="entry"><div class="content"><p>{LONG}</p></div></div></article></body>',
    "bare": f'<body><h1>Heading</h1><div class="text"><p>{LONG}</p></div></body>',
    "frame": f'<body><div>A small claim</div><article><p>{LONG}</p></article><div>{LONG} by readers</div></body>',
}


@pytest.mark.parametrize("kind", sorted(PARTS))
def test_pages_keep_all_parts(spark, kind):
    visible_to_workers(spark)
    other = f'<body><section class="post"><p>{LONG} otherwise</p></section><div class="story content"><p>Bit</p></div></body>'
    rows = [(k, "http://a.example/", PARTS[kind]) for k in range(3)] + [(9, "http://a.example/", other)]
    rows.append((10, "http://a.example/", other.replace("story content", kind if kind == "lead" else "text")))
    got = {r.page_id: r.text for r in host_paths.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    first = {"lead": "The lead. ", "frame": ""}.get(kind, "Heading ")
    assert {got[k] for k in range(3)} == {first + LONG}
    assert LONG + " otherwise" in got[9] and LONG + " otherwise" in got[10]


# ---- 8: secrets


def _base(text):
    found = []
    for m in re.finditer(r"""((?:(?i:password|passwd|secret|token|api_?key)))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text or "", re.A):
        if len(m[2]) >= 6:
            found.append(("assign", *m.span()))
    found += [("access", *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", text or "") if m.end() - m.start() >= 20]
    found += [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", text or "") if m.end() - m.start() >= 24]
    order = ["assign", "access", "hex"]
    return sorted(found, key=lambda x: (x[1], order.index(x[0])))


SECRETS = [(40, 'é Password = "hunter2x" and token:abc'), (41, "AKIA" + "A" * 16 + " " + "AKIASHORT"), (42, "x" + "0a" * 20 + "g" + "f" * 23),
           (43, "api_key: " + "0123456789abcdef" * 2), (43, "api_key: " + "0123456789abcdef" * 2), (44, "APIKEY==secret=abcdefgh toKen = 'zzzzzz'"), (45, "ghp_" + "Ab1" * 13)]


def test_secrets_and_ledger(spark, tmp_path):
    rows = ODD + SECRETS
    ledger = blob_ledger.Ledger(str(tmp_path / "ledger"))
    docs = documents(spark, rows)
    want = Counter()
    for k, t in rows:
        base = _base(t)
        numbers = Counter(kind for kind, *_ in base)
        joined = ",".join(f"{a}:{b}:{c}" for a, b, c in base)
        want[k, numbers["assign"], numbers["access"], numbers["hex"], hashlib.sha256(joined.encode()).hexdigest()] += 1
    for _ in range(2):  # the second scan finds everything in the ledger
        got = blob_ledger.digest(blob_ledger.scan_documents(docs, ledger)).collect()
        assert Counter((r.doc_id, r.n_assign, r.n_access, r.n_hex, r.base_sha256) for r in got) == want
        blobs = ledger.read(spark).count()
        assert blobs == len({t or "" for _, t in rows})
    assert {r.doc_id: r.spans for r in got}[45].startswith("hub_token:0:")
    blob_ledger.scan_documents(documents(spark, rows + [(99, "new text")]), ledger).count()
    assert ledger.read(spark).count() == blobs + 1
    ledger.scan(docs, rules="next")
    assert ledger.read(spark).where("rules = 'next'").count() == blobs


def test_redaction(spark, tmp_path):
    docs = documents(spark, ODD + SECRETS)
    got = blob_ledger.redact(docs, blob_ledger.Ledger(str(tmp_path / "ledger")))
    assert got.columns == docs.columns
    texts = {r.doc_id: r.text for r in got.collect()}
    assert texts[40] == "é [SECRET]\" and token:abc" and texts[43] == "[SECRET]" and texts[1] is None and texts[4] == dict(ODD)[4]
    assert got.count() == len(ODD + SECRETS)


# ---- 9: similar documents


def _shingles(text, words):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", lower)
    return frozenset(tuple(w[k : k + words]) for k in range(len(w) - words + 1)) if len(w) >= words else frozenset([tuple(w)] if w else [])


def _similar(rows, words, num, den):
    sets = [(k, _shingles(t, words)) for k, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, (_, s) in enumerate(sets):
        for b, (_, r) in enumerate(sets[:a]):
            if s and r and den * len(s & r) >= num * len(s | r):
                parent[find(a)] = find(b)
    groups = defaultdict(list)
    for a, (k, s) in enumerate(sets):
        groups[find(a)].append(k)
    return Counter((k, len(s), min((x for x in groups[find(a)] if x is not None), default=None)) for a, (k, s) in enumerate(sets))


def _copies():
    rng, rows = np.random.default_rng(9), []
    shared = prose(rng, 60)
    for base in range(40):
        words = rng.choice(WORDS, int(rng.integers(1, 300))).tolist()
        for copy in range(int(rng.integers(1, 7))):
            own = list(words)
            for at in rng.integers(0, len(own), int(rng.integers(0, 1 + len(own) // 25))):
                own[at] = str(rng.choice(WORDS)) + "x"
            rows.append((1_000 - len(rows), " ".join(own)))
        rows.append((1_000 - len(rows), shared + " " + prose(rng, 30)))
    return rows + [(2_000, "a b"), (2_001, "A  b"), (2_002, "a"), (2_003, "a"), (2_004, "b a")]


@pytest.mark.parametrize("words,threshold,unit", [(4, (85, 100), 3_000_000), (5, (80, 100), 3_000_000), (2, (50, 100), 400), (3, (60, 100), 2_000)])
def test_similar_equals_all_pairs(spark, words, threshold, unit):
    rows = [r for r in ODD if r[0]] + _copies()
    got = signature_trees.similar(documents(spark, rows), words, threshold, unit).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == _similar(rows, words, *threshold)


@pytest.mark.parametrize("words,threshold,unit", [(4, (85, 100), 3_000_000), (2, (50, 100), 400), (3, (60, 100), 2_000)])
def test_links_equal_all_pairs(spark, words, threshold, unit):
    rows = [r for r in ODD if r[0]] + _copies() + [(3_000 + k, " ".join([*WORDS[:k], "odd", *WORDS])) for k in range(9)] * 2
    sets, (num, den) = [_shingles(t, words) for _, t in rows], threshold
    near = [sum(a != b and den * len(s & r) >= num * len(s | r) for b, r in enumerate(sets) if s and r) for a, s in enumerate(sets)]
    assert max(near) > 5
    got = signature_trees.similar(documents(spark, rows), words, threshold, unit).collect()
    assert Counter((r.doc_id, r.n_links) for r in got) == Counter((k, n) for (k, _), n in zip(rows, near, strict=True))


def test_trees_count_every_close_pair():
    rng = np.random.default_rng(13)
    base = rng.integers(0, 1 << 64, 80, dtype=np.uint64)
    sets = [np.unique(np.concatenate([base[rng.random(80) > 0.06], rng.integers(0, 1 << 64, 2, dtype=np.uint64)])) for _ in range(120)]
    weights = rng.integers(1, 5, 120).tolist()
    want = [sum(w for b, (r, w) in enumerate(zip(sets, weights)) if a != b and signature_trees.close(s, r, 85, 100)) for a, s in enumerate(sets)]
    assert signature_trees.Tree(sets, 85, 100).count_links(weights).tolist() == want and sum(want) > 1_000


def test_keep_one(spark):
    rows = [r for r in ODD if r[0]] + _copies()
    docs = documents(spark, rows)
    kept = signature_trees.keep_one(docs, 4, (85, 100))
    assert kept.columns == docs.columns
    want = [k for (k, size, least), n in _similar(rows, 4, 85, 100).items() for _ in range(1 if size else n) if k == least]
    assert Counter(r.doc_id for r in kept.collect()) == Counter(want)
    assert signature_trees.keep_one(documents(spark, [])).collect() == []
    equal = " ".join(WORDS)
    odd = documents(spark, [(1, equal), (1, equal), (2, equal), (None, equal), (None, prose(np.random.default_rng(3), 30)), (3, "x " * 9), (3, prose(np.random.default_rng(4), 30))])
    odd = odd.unionByName(odd.where("doc_id is null"))
    assert sorted(str(r.doc_id) for r in signature_trees.keep_one(odd).collect()) == ["1", "3", "3", "None"]
    assert signature_trees.similar(documents(spark, [])).collect() == []
    assert [r.component_id for r in signature_trees.similar(documents(spark, [(None, "a b")])).collect()] == [None]


def test_segments_lose_no_pair():
    rng = np.random.default_rng(10)
    for num, den in ((85, 100), (80, 100), (1, 2)):
        segments = signature_trees.Segments(num, den)
        for _ in range(300):
            a = int(rng.integers(1, 400))
            whole = rng.integers(0, 1 << 64, 2 * a, dtype=np.uint64)
            left = np.unique(whole[:a])
            gone = int(rng.integers(0, 1 + a * (den - num) // den))
            right = np.unique(np.concatenate([left[gone:], whole[a : a + int(rng.integers(0, 1 + a * (den - num) // num))]]))
            if len(right) and signature_trees.close(left, right, num, den):
                assert np.intersect1d(np.concatenate(segments.signatures(left)), np.concatenate(segments.signatures(right))).size


def test_sets_that_share_a_passage_are_not_tied():
    rng = np.random.default_rng(14)
    for num, den in ((85, 100), (80, 100)):
        segments, passage = signature_trees.Segments(num, den), rng.integers(0, 1 << 64, 25, dtype=np.uint64)
        sets = [np.unique(np.concatenate([passage, rng.integers(0, 1 << 64, int(rng.integers(180, 460)), dtype=np.uint64)])) for _ in range(400)]
        holders = defaultdict(set)
        for k, s in enumerate(sets):
            for keys in segments.signatures(s):
                for key in keys.tolist():
                    holders[key].add(k)
        tied = [h for h in holders.values() if len(h) > 1]
        assert len(set().union(*tied)) < 100


def test_segments_lose_no_pair_at_the_threshold():
    """Sets as far apart as close ones can be, one of them at the border of a level or beyond it."""
    rng, met = np.random.default_rng(15), 0
    for num, den in ((85, 100), (80, 100), (1, 2)):
        segments = signature_trees.Segments(num, den)
        for size in [1, 2, 7, *(int(t) + d for t in segments.tops[:11] for d in (-1, 0, 1))]:
            for gone in range(0, size * (den - num) // den + 1, 1 + size // 40):
                both = size - gone
                more = max(both * den // num - size, 0)
                new = rng.integers(0, 1 << 64, size + more, dtype=np.uint64)
                left, right = np.unique(new[:size]), np.unique(new[gone:])
                if not signature_trees.close(left, right, num, den):
                    continue
                met += 1
                level = max(segments.levels(size)[0], segments.levels(len(right))[0])
                keys = [segments.signatures(s)[level - segments.levels(len(s))[0]] for s in (left, right)]
                assert np.intersect1d(*keys).size
    assert met > 500


def test_links_are_counted_once_however_keys_collide(spark, monkeypatch):
    """With keys of three bits everything is one cluster, a class with its nodes of all levels."""
    made = signature_trees.Cut.__init__

    def short(cut, rows, span):
        made(cut, rows, span)
        cut.key_bits = 3

    monkeypatch.setattr(signature_trees.Cut, "__init__", short)
    rows = [(k, t) for k, t in _copies() if len(t) < 400]
    sets = [_shingles(t, 3) for _, t in rows]
    near = [sum(a != b and 100 * len(s & r) >= 80 * len(s | r) for b, r in enumerate(sets) if s and r) for a, s in enumerate(sets)]
    got = signature_trees.similar(documents(spark, rows), 3, (80, 100)).collect()
    assert {r.doc_id: r.n_links for r in got} == {k: n for (k, _), n in zip(rows, near, strict=True)} and sum(near) > 20


def test_components(spark):
    links = [(k, k + 1) for k in range(0, 60) if k % 10 != 9] + [(500, 100), (500, 100), (100, 500), (7, 7)] + [(900, k) for k in range(700, 780)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert all(got[k] == k // 10 * 10 for k in range(0, 60)) and got[500] == got[100] == 100 and got[900] == got[779] == 700
    assert components(spark.createDataFrame([], "u long, v long")).collect() == []


# ---- 10: surrogates


def _luhn(number):
    digits = [int(c) for c in reversed(number)]
    return sum(d if k % 2 == 0 else d * 2 - 9 * (d > 4) for k, d in enumerate(digits)) % 10 == 0


def test_surrogates(spark):
    rows = ODD + [
        (50, "Write to Ann.Lee@Mail.example.com or ann.lee@mail.example.com, not bob@mail.example.com."),
        (51, "Call +1 (988) 555-2485 or 988-555-2485 today; IP 42.144.35.254. Card 4041894974608795 and 4041 8949 7460 8795!"),
        (52, "Ms Ann Lee met Mr Tom Lee. Mr. Lee left. Frau MÜLLER blieb. Госпожа Анна Иванова пришла."),
        (53, "SSN 123-45-6789, version 2.0.1, year 2024"), (53, "SSN 123-45-6789, version 2.0.1, year 2024"), (54, "bob@mail.example.com"), (54, "v1.2.3.4.5 and 1234567")]
    docs = documents(spark, rows)
    got = surrogates.replace_entities(docs, "k")
    assert got.columns == [*docs.columns, "n_entities"]
    table = defaultdict(list)
    for r in got.collect():
        table[r.doc_id].append(r.text)
    assert Counter(t for k, ts in table.items() if k is None or k < 50 for t in ts) == Counter(t for _, t in ODD)
    a, b, c = re.findall(r"[\w.]+@[\w.]+\w", table[50][0])
    assert a.lower() == b and a != b and c != b and a.lower() != "ann.lee@mail.example.com" and len(b) == len("ann.lee@mail.example.com")
    assert b.split("@")[1] == c.split("@")[1] and c == table[54][0] if "@" in table[54][0] else c == table[54][1]
    m = re.fullmatch(r"Call \+1 \((\d{3})\) (\d{3})-(\d{4}) or (\d{3})-(\d{3})-(\d{4}) today; IP (\d+(?:\.\d+){3})\. Card (\d{16}) and ((?:\d{4} ){3}\d{4})!", table[51][0])
    assert m and m.groups()[:3] == m.groups()[3:6] and "988" != m[1] and m[7] != "42.144.35.254"
    assert m[8] == m[9].replace(" ", "") != "4041894974608795" and m[8][0] == "4" and _luhn(m[8])
    n = re.fullmatch(r"Ms (\w+) (\w+) met Mr (\w+) (\w+)\. Mr\. (\w+) left\. Frau (\w+) blieb\. Госпожа (\w+) (\w+) пришла\.", table[52][0])
    assert n and n[2] == n[4] == n[5] and n[1].endswith("a") and not n[3].endswith("a") and n[6].isupper()
    assert re.fullmatch("[А-Я][а-я]+", n[7]) and n[7].endswith("а") and n[8].endswith("ова") and not {"Ann", "Tom", "Lee", "MÜLLER", "Анна", "Иванова"} & set(n.groups())
    assert table[53][0] == table[53][1] and re.fullmatch(r"SSN \d{3}-\d{2}-\d{4}, version 2\.0\.1, year 2024", table[53][0]) and "123-45" not in table[53][0]
    assert surrogates.replace_entities(documents(spark, []), "k").collect() == []
    other = surrogates.replace_entities(docs.where("doc_id = 51"), "another key").first().text
    assert other != table[51][0]


def test_surrogates_stay_distinct(spark):
    """More than half of a small format's room is taken, so many first draws collide."""
    visible_to_workers(spark)
    entities = spark.createDataFrame([("card", f"4{k:03d}") for k in range(60)] + [("card", f"5{k:03d}") for k in range(60)], "kind string, canon string")
    got = surrogates.distinct_surrogates(entities, "k").collect()
    new = [r.surrogate for r in got]
    assert len(set(new)) == len(new) == 120 and not set(new) & {r.canon for r in got}


def test_surrogate_addresses_stay_distinct_where_their_format_is_full(spark):
    visible_to_workers(spark)
    letters = "abcdefghijklmnopqrstuvwxyz"
    addresses = [f"{c}@m.example.com" for c in letters] + [f"ann@{c}.{top}" for c in letters[:16] for top in ("de", "org")] + ["ann@m.example.com"]
    got = {r.canon: r.surrogate for r in surrogates.distinct_surrogates(
        spark.createDataFrame([("email", a) for a in addresses] + [("ssn", "123456789")], "kind string, canon string"), "k").collect()}
    new = [got[a] for a in addresses]
    assert len(set(new)) == len(addresses) == len(got) - 1 and not set(new) & set(addresses)
    hosts = {(a.split("@")[1], got[a].split("@")[1]) for a in addresses}
    assert len(hosts) == len({h for h, _ in hosts}) == len({h for _, h in hosts}) and not {h for h, _ in hosts} & {h for _, h in hosts}
    assert all(a.rpartition(".")[2] == got[a].rpartition(".")[2] for a in addresses)


def test_surrogates_use_no_python(spark):
    plan = surrogates.replace_entities(documents(spark, ODD), "k")._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_trees_connect_what_close_pairs_connect():
    rng = np.random.default_rng(11)

    def connected(n, links):
        root = list(range(n))
        for a, b in links:
            low, high = sorted((root[a], root[b]))
            root = [low if r == high else r for r in root]
        return root

    for _ in range(10):
        sets = []
        for _ in range(20):
            base = rng.integers(0, 1 << 64, int(rng.integers(1, 60)), dtype=np.uint64)
            for _ in range(int(rng.integers(1, 12))):
                extra = rng.integers(0, 1 << 64, int(rng.integers(0, 6)), dtype=np.uint64)
                sets.append(np.unique(np.concatenate([base[rng.random(len(base)) > rng.random() * 0.2], extra])))
        sets = [s for s in sets if len(s)]
        pairs = [(a, b) for a in range(len(sets)) for b in range(a) if signature_trees.close(sets[a], sets[b], 80, 100)]
        assert connected(len(sets), signature_trees.Tree(sets, 80, 100).find_links()) == connected(len(sets), pairs)


def test_components_of_few_links_take_few_tasks(spark, monkeypatch):
    """However many partitions shuffles have, few links are joined by as many tasks as there are cores; stars need no round."""
    from wavecount.llm import components

    written, real = [], components.materialise

    def noted(df, label="table", keep=False):
        table = real(df, label, keep)
        written.append((label, len(table.inputFiles())))
        return table

    monkeypatch.setattr(components, "materialise", noted)
    chain, star = [(k + 1, k) for k in range(300)], [(k, 1_000) for k in range(1_001, 1_301)]
    settings = {"spark.sql.shuffle.partitions": "60", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        for links, root in ((chain, 0), (star, 1_000)):
            written.clear()
            found = components.components(spark.createDataFrame(links, "u long, v long").repartition(4)).collect()
            assert {(r.node, r.root) for r in found} == {(n, root) for link in links for n in link} and len(found) == 301
            assert max(files for label, files in written[1:-1]) <= spark.sparkContext.defaultParallelism
            assert ("least" in dict(written)) == (links is chain)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert components.components(spark.createDataFrame([], "u long, v long")).collect() == []
