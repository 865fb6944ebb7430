"""Corpus preprocessing end to end: stages, lemmas, stop words, measurements and colors of each distinct query, in one pass over the texts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.functions.lemma import lemmatize
from quern.functions.lookup import per_text
from quern.functions.text import model_text, stages
from quern.operators.annotate import INTENTS, stopwords
from quern.operators.measure import measurements


def preprocess(queries: DataFrame, text: str, lemmas: DataFrame | None = None, brands: DataFrame | None = None, hint: str | None = None) -> DataFrame:
    """Adds the stages nfkc … spaces and lemma, search_text, removed, one flag an intent, query_model and measurements.

    ``lemmas`` (token, lemma) is met by distinct token, brands (token) are kept. A null text counts as empty.
    """
    def make(rows: DataFrame) -> DataFrame:
        base = F.coalesce(F.col(text), F.lit(""))
        named = stages(base)
        for name in ("nfkc", "yo_equal_e", "lower", "separators", "spaces"):
            rows = rows.withColumn(name, named[name])
        rows = lemmatize(rows, "spaces", lemmas, brands)
        stopped = stopwords(F.col("lemma"))
        rows = rows.withColumns({"search_text": stopped["search_text"], "removed": stopped["removed"]} | {f"{n}_intent": stopped[f"{n}_intent"] for n in INTENTS})
        return rows.withColumn("query_model", model_text(base)).withColumn("measurements", measurements(F.col("query_model"), F.coalesce(F.col(hint), F.lit("")) if hint else None))

    return per_text(queries, [text, hint] if hint else [text], make)


def change_counts(rows: DataFrame, text: str) -> DataFrame:
    """(stage, n_unique, n_changed): distinct texts after each stage, and rows that it changed."""
    order = [text, "nfkc", "yo_equal_e", "lower", "separators", "spaces", "lemma"]
    before = dict(zip(order[1:], order, strict=False))
    each = F.explode(F.array(*[F.struct(F.lit(c).alias("stage"), F.col(c).alias("value"), (F.col(c) != F.col(before[c])).alias("changed") if c in before else F.lit(False).alias("changed")) for c in order])).alias("x")
    counted = rows.select(each).select("x.*").groupBy("stage", "value").agg(F.count_if("changed").alias("changed"))
    return counted.groupBy("stage").agg(F.count(F.lit(1)).alias("n_unique"), F.sum("changed").alias("n_changed"))
