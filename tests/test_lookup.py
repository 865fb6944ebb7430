from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from quern.functions import lemma, lookup
from quern.operators import annotate, match, preprocess

ENTRY = "pattern string, entity_type string, entity_id string, canonical string, count long, source string"
ENTRIES = [("samsung", "brand", "b", "samsung", 9, "catalog"), ("телевизор", "category", "c", "телевизор", 5, "catalog"), ("телевизор", "category", "d", "тв", 5, "catalog"), ("пылесос", "category", "e", "пылесос", 7, "curated_x"), ("синий", "color", "blue", "синий", 3, "catalog")]
TEXTS = [(1, "Телевизоры Samsung синий"), (2, "пылесосы, пылесос"), (3, None), (4, ""), (5, "ничего"), (6, "пылесосы, пылесос")]


@pytest.fixture
def given(spark):
    return spark.createDataFrame(TEXTS, "id int, text string"), spark.createDataFrame(ENTRIES, ENTRY), spark.createDataFrame([("телевизоры", "телевизор"), ("пылесосы", "пылесос")], "token string, lemma string")


def results(texts, entries, lemmas):
    made = [match.dictionary_matches(texts, "id", "text", entries, 2, lemmas), lemma.lemmatize(texts.filter("text IS NOT NULL"), "text", lemmas).select("id", "text", "lemma"), annotate.annotate(texts, "id", "text", entries, 2, lemmas=lemmas).select("id", "entities", "warnings", "rejected")]
    return [sorted(map(str, m.collect())) for m in made]


def test_held_tables_give_what_joins_give(given, monkeypatch):
    inside = results(*given)
    monkeypatch.setattr(lookup, "MOST_ROWS", -1)
    assert results(*given) == inside and all(inside)


def test_generated_texts_are_never_broadcast(given, spark):
    """Fifty texts for each row of a small table look as small as the table to the optimizer."""
    texts, entries, lemmas = given
    many = texts.select(F.explode(F.sequence(F.lit(0), F.lit(49))).alias("id"), "text")
    for made in (preprocess.preprocess(many, "text", lemmas), match.dictionary_matches(many, "id", "text", entries, 2, lemmas), annotate.annotate(many, "id", "text", entries, 2, lemmas=lemmas)):
        assert "Broadcast" not in made._jdf.queryExecution().executedPlan().toString()
