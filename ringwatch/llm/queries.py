"""Queries over the corpus tables, one per operator, with DuckDB SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ringwatch.llm import (collocations, exact_dedup, interpolated_lm, merge_dropout, packing, periodic_runs, pii, quality, simhash,
                           token_ids, toxicity, unit_dedup, warc)
from ringwatch.llm.common import table

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_ORACLES: dict[str, str] = {}


def _register(name: str, oracle: str | None = None):
    def deco(fn):
        _QUERIES[name] = fn
        if oracle:
            _ORACLES[name] = oracle
        return fn
    return deco


@_register("op1_token_ids")
def op1_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_ids.token_files(table(spark, sf_dir, "documents")).select("doc_id", "start", "n_tokens", "ids_crc32")


@_register("op2_toxicity")
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@_register("op3_simhash")
def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(table(spark, sf_dir, "documents"))


@_register("op4_pii")
def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pii_report(table(spark, sf_dir, "documents"))


@_register("op5_warc_derivatives")
def op5_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.derivatives(table(spark, sf_dir, "pages"))


@_register("op6_exact_dedup", """
WITH d AS (SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256 FROM documents)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, text_sha256
FROM d WINDOW g AS (PARTITION BY text_sha256)""")
def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256")


@_register("op7_packing")
def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), keep_ids=False).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "sequence_tokens", "padded_tokens")


@_register("op8_merge_dropout")
def op8_merge_dropout(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge_dropout.round_trip(table(spark, sf_dir, "documents"))


@_register("op9_quality")
def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(table(spark, sf_dir, "documents"))


@_register("op10_unit_dedup")
def op10_unit_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unit_dedup.repeated_units(table(spark, sf_dir, "documents"))


_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@_register("op11_collocations", f"""
WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({_LOWERED}, '[.,;:!?\n-\r]')) AS piece FROM documents),
cut AS (SELECT lang, row_number() OVER () AS id, list_filter(regexp_split_to_array(piece, '[ \t]+'), lambda x: x <> '') AS w FROM pieces),
words AS (SELECT lang, id, unnest(w) AS w1, generate_subscripts(w, 1) AS i FROM cut),
seq AS (SELECT lang, w1, lead(w1) OVER s AS w2, lead(w1, 2) OVER s AS w3 FROM words WINDOW s AS (PARTITION BY id ORDER BY i)),
sizes AS (SELECT lang, count(*) AS n FROM words GROUP BY lang),
f1 AS (SELECT lang, w1, count(*)::HUGEINT AS a FROM seq GROUP BY ALL),
f2 AS (SELECT lang, w1, w2, count(*)::HUGEINT AS a FROM seq WHERE w2 IS NOT NULL GROUP BY ALL HAVING a >= 10),
f3 AS (SELECT lang, w1, w2, w3, count(*)::HUGEINT AS a FROM seq WHERE w3 IS NOT NULL GROUP BY ALL HAVING a >= 10),
longer AS (SELECT lang, w1, w2, max(a) AS most FROM (SELECT lang, w1, w2, a FROM f3 UNION ALL SELECT lang, w2, w3, a FROM f3) GROUP BY ALL),
cuts AS (
  SELECT c.lang, c.w1 || ' ' || c.w2 AS phrase, c.a, 1 AS k, x.a AS l, y.a AS r
  FROM f2 c JOIN f1 x ON x.lang = c.lang AND x.w1 = c.w1 JOIN f1 y ON y.lang = c.lang AND y.w1 = c.w2
    LEFT JOIN longer o ON o.lang = c.lang AND o.w1 = c.w1 AND o.w2 = c.w2 WHERE o.most IS NULL OR 100 * o.most < 50 * c.a
  UNION ALL SELECT c.lang, c.w1 || ' ' || c.w2 || ' ' || c.w3, c.a, 1, x.a, y.a
  FROM f3 c JOIN f1 x ON x.lang = c.lang AND x.w1 = c.w1 JOIN f2 y ON y.lang = c.lang AND y.w1 = c.w2 AND y.w2 = c.w3
  UNION ALL SELECT c.lang, c.w1 || ' ' || c.w2 || ' ' || c.w3, c.a, 2, x.a, y.a
  FROM f3 c JOIN f2 x ON x.lang = c.lang AND x.w1 = c.w1 AND x.w2 = c.w2 JOIN f1 y ON y.lang = c.lang AND y.w1 = c.w3),
scored AS (SELECT *, 1000000 * a * a // (l * r) AS score FROM cuts),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM best)
SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n, score::BIGINT AS score
FROM ranked JOIN sizes USING (lang) WHERE rank <= 2000""")
def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


@_register("op12_periodic_runs")
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.run_report(table(spark, sf_dir, "documents"))


@_register("op13_lm_scores")
def op13_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interpolated_lm.scores(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_ORACLES)
