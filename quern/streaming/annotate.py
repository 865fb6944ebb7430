"""Annotation of query streams. Queries carry no event time and the operators no state, so they run on streams unchanged."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.functions.text import canonicalize, log_normalize, n_words, script_flags
from quern.operators.measure import measurements


def normalize_stream(queries: DataFrame, column: str) -> DataFrame:
    """Normalized and canonical text, lengths, flags and measurements of a streaming (or static) table."""
    text = log_normalize(F.col(column))
    rows = queries.withColumn("query_normalized", text)
    normal = F.col("query_normalized")
    return rows.withColumns({"query_canonical": canonicalize(normal), "query_length_words": n_words(normal)} | script_flags(normal) | {"measurements": measurements(F.coalesce(F.col(column), F.lit("")))})
