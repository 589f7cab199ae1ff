"""Samples of exact size over customers and documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from marginalia.operators.bottom_k import exact_sample, exact_sample_by
from marginalia.sources.tables import read_table

ROWS, ROWS_BY, SEED = 100, 25, 7


def sample_exact(spark: SparkSession, folder: str) -> DataFrame:
    return exact_sample(read_table(spark, folder, "customer", "c_custkey", "c_mktsegment"), "c_custkey", ROWS, SEED)


def sample_exact_by(spark: SparkSession, folder: str) -> DataFrame:
    return exact_sample_by(read_table(spark, folder, "documents", "doc_id", "lang"), "doc_id", ROWS_BY, "lang", SEED)


QUERIES = {"sample_exact": sample_exact, "sample_exact_by": sample_exact_by}


def _order_sql(key: str) -> str:
    text = f"coalesce(CAST({key} AS VARCHAR), '')"
    return f"md5('{SEED}:' || {text}), {text}"


ORACLES = {
    "sample_exact": f"SELECT c_custkey, c_mktsegment FROM customer ORDER BY {_order_sql('c_custkey')} LIMIT {ROWS}",
    "sample_exact_by": f"""SELECT doc_id, lang FROM documents
      QUALIFY row_number() OVER (PARTITION BY lang ORDER BY {_order_sql('doc_id')}) <= {ROWS_BY}""",
}
