"""Queries of the llm operators, and their SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from oreweave.llm.canonical import map_values, unmatched_report, written_values
from oreweave.llm.entity_match import match_entities
from oreweave.llm.packing import container_fill, pack_items
from oreweave.llm.sentences import sentence_units
from oreweave.llm.splitting import report_sections, split_texts
from oreweave.llm.survivorship import claim_order, discover_truth, field_claims, surviving_records, surviving_statements
from oreweave.llm.tokens import count_tokens, decode_corpus, encode_corpus, token_statistics
from oreweave.session import table

Query = Callable[[SparkSession, str], DataFrame]


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return p2_matches(spark, d).select("dep_id", "record_id")


def p2_matches(spark: SparkSession, d: str) -> DataFrame:
    return match_entities(table(spark, d, "report_deposits"), table(spark, d, "mrds_registry"), table(spark, d, "canon_terms"))


def _written(spark: SparkSession, d: str) -> DataFrame:
    canon = table(spark, d, "canon_terms")
    return map_values(written_values(table(spark, d, "geology_observations"), table(spark, d, "report_deposits"), canon), canon)


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return _written(spark, d).select("record_key", "field", "pos", "term_id")


def p3_unmatched(spark: SparkSession, d: str) -> DataFrame:
    return unmatched_report(_written(spark, d))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return report_sections(table(spark, d, "report_texts"))


def p5_pieces(spark: SparkSession, d: str) -> DataFrame:
    return split_texts(table(spark, d, "report_texts"))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return surviving_statements(table(spark, d, "deposit_statements"), table(spark, d, "source_list"))


def p6_records(spark: SparkSession, d: str) -> DataFrame:
    return surviving_records(table(spark, d, "deposit_statements"), table(spark, d, "source_list"))


def p6_reliability(spark: SparkSession, d: str) -> DataFrame:
    statements, sources = table(spark, d, "deposit_statements"), table(spark, d, "source_list")
    claims = field_claims(statements, sources).join(claim_order(statements, sources).select("statement_id", "source_key"), "statement_id")
    return discover_truth(claims)[1]


def p8_ids(spark: SparkSession, d: str) -> DataFrame:
    return encode_corpus(table(spark, d, "documents"))


def p8_decoded(spark: SparkSession, d: str) -> DataFrame:
    return decode_corpus(p8_ids(spark, d))


def p8_token_counts(spark: SparkSession, d: str) -> DataFrame:
    return token_statistics(p8_ids(spark, d))


def p9_containers(spark: SparkSession, d: str) -> DataFrame:
    return pack_items(count_tokens(table(spark, d, "documents")))


def p9_fill(spark: SparkSession, d: str) -> DataFrame:
    return container_fill(p9_containers(spark, d))


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return sentence_units(table(spark, d, "documents")).select("doc_id", "start_char")


def p10_counts(spark: SparkSession, d: str) -> DataFrame:
    return sentence_units(table(spark, d, "documents")).groupBy("doc_id").agg(F.count("*").alias("n_units"))


def queries() -> dict[str, Query]:
    return {
        f.__name__: f
        for f in (
            p2_found, p2_matches, p3_found, p3_unmatched, p5_found, p5_pieces, p6_found, p6_records, p6_reliability,
            p8_ids, p8_decoded, p8_token_counts, p9_containers, p9_fill, p10_found, p10_counts,
        )
    }


def oracle_sql() -> dict[str, str]:
    from oreweave.sql_units import STATED

    return {
        "p6_found": f"""
WITH {STATED},
claims AS (
  SELECT rid, field, statement_id FROM stated
  UNION ALL SELECT trim(record_id, ' '), 'latitude', statement_id FROM deposit_statements WHERE latitude IS NOT NULL AND NOT isnan(latitude) AND record_id IS NOT NULL
  UNION ALL SELECT trim(record_id, ' '), 'longitude', statement_id FROM deposit_statements WHERE longitude IS NOT NULL AND NOT isnan(longitude) AND record_id IS NOT NULL),
ranked AS (
  SELECT c.rid, c.field, c.statement_id, row_number() OVER (
    PARTITION BY c.rid, c.field ORDER BY coalesce(s.trust_rank, 2147483647),
      CASE WHEN d.confidence_score BETWEEN 0 AND 1 THEN -d.confidence_score ELSE 1 END,
      d.reported_at DESC NULLS LAST, c.statement_id) AS place
  FROM claims c JOIN deposit_statements d ON d.statement_id = c.statement_id
  LEFT JOIN source_list s ON lower(trim(s.source, ' ')) = lower(trim(d.source, ' ')))
SELECT rid AS record_id, field, statement_id FROM ranked
WHERE place = 1 AND rid IN (SELECT trim(record_id, ' ') FROM deposit_statements GROUP BY 1 HAVING count(*) >= 2)""",
        "p8_decoded": "SELECT doc_id, coalesce(text, '') AS text FROM documents",
    }
