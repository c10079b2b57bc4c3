"""The queries of the training-data operators over the test tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from wavecount.llm import (
    active_lloyd, bitplanes, blob_ledger, decontamination, golomb_dedup, host_paths, learned_partitions, line_crf, ordinal_toxicity, piece_transducer,
    signature_trees, surrogates, word_runs)
from wavecount.llm.common import read_table, visible_to_workers

Query = Callable[[SparkSession, str], DataFrame]


def _bit_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bitplanes.round_trip(spark, read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def _quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_crf.quality(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def _neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return learned_partitions.search(read_table(spark, sf_dir, "embeddings"))


def _toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ordinal_toxicity.toxicity(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def _pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = piece_transducer.model_bytes(public_tokenizers.path("piece_bpe_32k.model"))
    return piece_transducer.digest(read_table(spark, sf_dir, "documents"), model)


def _host_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return host_paths.extract(read_table(spark, sf_dir, "pages"))


def _secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return blob_ledger.digest(blob_ledger.scan_documents(docs, blob_ledger.new_ledger(spark)))


def _similar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return signature_trees.similar(read_table(spark, sf_dir, "documents"), words=4, threshold=(85, 100))


def _surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    replaced = surrogates.replace_entities(read_table(spark, sf_dir, "documents"), key="a key for the test tables")
    return replaced.select("doc_id", "text", "n_entities")


def _decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    scanned = decontamination.scan(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return decontamination.digest(scanned).drop("spans")


def _codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return active_lloyd.codes(read_table(spark, sf_dir, "embeddings"))


def _copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return golomb_dedup.groups(read_table(spark, sf_dir, "documents"))


def _runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return word_runs.digest(word_runs.runs(read_table(spark, sf_dir, "documents"), word_runs.repeated_tail))


def _shipped(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        visible_to_workers(spark)
        return query(spark, sf_dir)

    return run


def queries() -> dict[str, Query]:
    return {name: _shipped(query) for name, query in _QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {"op6_benchmark_automaton": _DECONTAMINATION, "op11_active_lloyd": _LLOYD, "op12_golomb_exchange": _COPIES}


_QUERIES: dict[str, Query] = {
    "op1_bit_planes": _bit_planes,
    "op2_line_crf": _quality,
    "op3_learned_partitions": _neighbours,
    "op4_ordinal_toxicity": _toxicity,
    "op5_piece_transducer": _pieces,
    "op6_benchmark_automaton": _decontamination,
    "op7_host_paths": _host_paths,
    "op8_blob_ledger": _secrets,
    "op9_signature_trees": _similar,
    "op10_surrogates": _surrogates,
    "op11_active_lloyd": _codes,
    "op12_golomb_exchange": _copies,
    "op13_word_runs": _runs,
    "pipeline": corpus_pipeline.run,
}

_DECONTAMINATION = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (SELECT DISTINCT item, least(len(w), 10) AS k, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS win
  FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS i FROM b WHERE len(w) > 0)),
dw AS (SELECT doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS win
  FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, (SELECT DISTINCT k FROM bw) WHERE len(w) >= k)),
hits AS (SELECT doc_id, dw.i, dw.k, bw.item FROM dw JOIN bw USING (k, win)),
n AS (SELECT doc_id, count(*) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(i, i + k)) AS p FROM hits) GROUP BY doc_id),
it AS (SELECT doc_id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM hits GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN it USING (doc_id)
"""

_COPIES = r"""
WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS n, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm FROM documents)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
  row_number() OVER w = 1 AS kept, sha256(norm) AS text_sha256
FROM d WINDOW w AS (PARTITION BY norm ORDER BY n DESC, doc_id NULLS LAST)
"""


def _lloyd_sql(rounds: int = 2) -> str:
    """Plain rounds that compare everything; each is a pair of tables, of nearest entries and of moved ones."""
    tables = ["""
v AS MATERIALIZED (SELECT row_number() OVER (ORDER BY vec_id) AS r, vec_id, label,
    list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS MATERIALIZED (SELECT r, k, x[k * len(x) // 16 + 1:(k + 1) * len(x) // 16] AS x FROM v, (SELECT unnest(range(16)) AS k)),
b0 AS MATERIALIZED (SELECT k, r - 1 AS e, x FROM p WHERE r <= 64)"""]
    for n in range(rounds + 1):
        tables.append(f"""
a{n} AS MATERIALIZED (SELECT r, k, any_value(p.x) AS x, min((d, e)) AS best
  FROM (SELECT p.r, p.k, p.x, b.e, list_sum(list_transform(list_zip(p.x, b.x), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d
    FROM p JOIN b{n} AS b USING (k)) AS p GROUP BY r, k)""")
        tables.append(f"""
b{n + 1} AS MATERIALIZED (SELECT b.k, b.e, coalesce(m.x, b.x) AS x FROM b{n} AS b LEFT JOIN (
    SELECT k, e, list(CAST(floor(s / n) AS BIGINT) ORDER BY i) AS x FROM (
      SELECT k, best[2] AS e, i, sum(x[i]) AS s, count(*) AS n FROM (SELECT k, best, x, unnest(range(1, len(x) + 1)) AS i FROM a{n}) GROUP BY ALL)
    GROUP BY k, e) AS m USING (k, e))""")
    return f"""
WITH {",".join(tables[:-1])},
c AS (SELECT r, string_agg(printf('%02x', best[2]), '' ORDER BY k) AS code, CAST(sum(best[1]) AS BIGINT) AS error FROM a{rounds} GROUP BY r)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
  (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY k, e)) FROM b{rounds}) AS codebooks_sha256
FROM v JOIN c USING (r)
"""


_LLOYD = _lloyd_sql()
