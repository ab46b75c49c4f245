"""The operators as queries over the benchmark tables, with SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    decontamination,
    encoding,
    hilbert_ann,
    html_text,
    jaccard_join,
    mixing,
    periodic_runs,
    quality,
    substring_dedup,
    token_counts,
    token_shards,
    toxicity,
    whitening,
)

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_pages(_table(spark, sf_dir, "pages"))


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mixed_rows(_table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(
        _table(spark, sf_dir, "documents"),
        public_tokenizers.path("piece_bpe_32k.model"),
        with_cut=True,
    )


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    )


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = jaccard_join.jaccard_join(_table(spark, sf_dir, "documents"))
    return joined.select("doc_id", "class_id", "n_links", "n_shingles")


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.repeated_passages(_table(spark, sf_dir, "documents"))


def op7_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_shards.materialised(
        _table(spark, sf_dir, "documents"),
        public_tokenizers.path("byte_bpe_50k.tiktoken"),
        public_tokenizers.PATTERN,
    )


def op8_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hilbert_ann.nearest(
        _table(spark, sf_dir, "embeddings"), is_query=F.col("vec_id") % 20 == 0
    )


def op9_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoding.encoded(
        _table(spark, sf_dir, "documents"),
        public_tokenizers.path("word_bpe_49k.json"),
        with_ids=False,
    )


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    measured = _table(spark, sf_dir, "documents").select(
        "doc_id", quality.quality_measures(F.col("text")).alias("found")
    )
    return measured.select("doc_id", "found.*")


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.periodic_runs(
        _table(spark, sf_dir, "documents"),
        prepare=periodic_runs.with_repeated_tail,
        key=F.crc32(F.col("doc_id").cast("string").cast("binary")),
        with_texts=False,
    )


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(_table(spark, sf_dir, "embeddings"))


def op13_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contamination(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    )


QUERIES: dict[str, Query] = {
    "op1_main_text": op1_main_text,
    "op2_mix_sources": op2_mix_sources,
    "op3_token_counts": op3_token_counts,
    "op4_toxicity": op4_toxicity,
    "op5_jaccard_join": op5_jaccard_join,
    "op6_substring_dedup": op6_substring_dedup,
    "op7_token_shards": op7_token_shards,
    "op8_nearest_vectors": op8_nearest_vectors,
    "op9_bpe_round_trip": op9_bpe_round_trip,
    "op10_quality_rules": op10_quality_rules,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_whitening": op12_whitening,
    "op13_decontamination": op13_decontamination,
}

# The rows taken are those whose running total in hash order stays within the
# target; targets are filled round by round.
_MIX_SQL = r"""
WITH RECURSIVE docs AS (
  SELECT doc_id, source, text,
    coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
    substr(md5(concat_ws(':', 'mix-1', doc_id::VARCHAR, text)), 1, 15) AS h
  FROM documents
), sources AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM docs GROUP BY source
), weighed AS (
  SELECT source, source_size,
    CASE (row_number() OVER (ORDER BY source IS NULL, hex(encode(source))) - 1) % 3
      WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END::DOUBLE AS weight
  FROM sources
), filled AS (
  SELECT 0 AS round, 0.0::DOUBLE AS level
  UNION ALL
  SELECT f.round + 1, n.level
  FROM filled f, LATERAL (
    SELECT ((SELECT sum(source_size) FROM weighed) * 1.5
        - coalesce(sum(CASE WHEN f.round > 0 AND f.level * weight > 2.0 * source_size
                            THEN 2.0 * source_size END), 0.0))
      / nullif(sum(CASE WHEN f.round > 0 AND f.level * weight > 2.0 * source_size
                        THEN 0.0 ELSE weight END), 0.0) AS level
    FROM weighed) n
  WHERE n.level IS NOT NULL AND (f.round = 0 OR n.level <> f.level)
), last AS (
  SELECT arg_max(level, round) AS level FROM filled
), targets AS (
  SELECT source, source_size,
    least(level * weight, 2.0 * source_size) AS target
  FROM weighed, last
), placed AS (
  SELECT d.doc_id, d.size, t.source_size, t.target,
    floor(t.target / greatest(t.source_size, 1)) AS passes,
    t.target - floor(t.target / greatest(t.source_size, 1)) * t.source_size AS budget,
    sum(d.size) OVER (PARTITION BY t.source ORDER BY d.h) AS upto,
    sum(d.size) OVER (PARTITION BY t.source, d.h) AS tied
  FROM docs d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
  (size * least(2, passes + CASE
    WHEN upto <= budget OR (upto - tied <= budget AND upto - budget < budget - (upto - tied))
    THEN 1 ELSE 0 END))::BIGINT AS taken
FROM placed
"""

# Every window of every document against the windows of all items.
_LEAK_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), items AS (
  SELECT item_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark WHERE item_id IS NOT NULL
), item_places AS (
  SELECT item_id, w, least(len(w), 10) AS k, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i
  FROM items WHERE len(w) > 0
), windows AS (
  SELECT DISTINCT item_id, k, array_to_string(w[i:i + k - 1], ' ') AS s FROM item_places
), doc_places AS (
  SELECT r, w, k, unnest(range(1, len(w) - k + 2)) AS i
  FROM docs, (SELECT DISTINCT k FROM windows) WHERE len(w) >= k
), met AS (
  SELECT r, i, k, s FROM (SELECT r, i, k, array_to_string(w[i:i + k - 1], ' ') AS s FROM doc_places)
  WHERE (k, s) IN (SELECT k, s FROM windows)
), hit AS (
  SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + k)) AS p FROM met) GROUP BY r
), found AS (
  SELECT r, list_sort(list(DISTINCT item_id::VARCHAR)) AS ids FROM met JOIN windows USING (k, s) GROUP BY r
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_hit,
  coalesce(len(ids), 0)::BIGINT AS n_items,
  sha256(coalesce(array_to_string(ids, ','), '')) AS items_sha256, n IS NOT NULL AS contaminated
FROM docs LEFT JOIN hit USING (r) LEFT JOIN found USING (r)
"""

ORACLES: dict[str, str] = {"op2_mix_sources": _MIX_SQL, "op13_decontamination": _LEAK_SQL}
