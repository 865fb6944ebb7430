"""Lemmatization by a table over distinct tokens, with the rules that protect models, brands and short words.

No morphology is invented: the default table is empty and every token is its own lemma. A table comes from the caller, or from
``analyzer_table`` where a morphological analyzer can be imported.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions.lookup import held

KEPT_WORDS = ("мини", "макси", "ультра")


def protected(token: Column) -> Column:
    """Tokens that are never changed: with digits or Latin letters, not purely Cyrillic, of one or two letters, or listed."""
    return token.rlike(r"(?U)\d") | token.rlike("[a-zA-Z]") | ~token.rlike("^[а-яё]+$") | (F.length(token) <= 2) | token.isin(*KEPT_WORDS)


def lemmatize(texts: DataFrame, column: str, table: DataFrame | None = None, brands: DataFrame | None = None, out: str = "lemma") -> DataFrame:
    """Adds ``out``. ``table`` has token, lemma; ``brands`` has token for single-word Cyrillic brands, which are kept too.

    A small table is looked up inside each row. With a larger one work is done once per distinct text and token, by joins that never
    broadcast the texts: estimates of exploded texts are too low for that choice to be left open. A null text has a null lemma.
    """
    if table is None:
        return texts.withColumn(out, F.col(column))
    known = table if brands is None else table.join(brands, "token", "left_anti")
    known = known.filter(~protected(F.col("token"))).groupBy("token").agg(F.min("lemma").alias("lemma"))
    found = held(known, "token", ["lemma"])
    if found:
        words = F.transform(F.split(column, " "), lambda t: F.coalesce(F.try_element_at(found(t), F.lit(1))["lemma"], t))
        return texts.withColumn(out, F.translate(F.array_join(words, " "), "ё", "е"))
    distinct = texts.select(column).distinct()
    token = distinct.select(column, F.posexplode(F.split(column, " ")).alias("pos", "token"))
    lemma = token.join(known, "token", "left").groupBy(column).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", F.coalesce("lemma", "token").alias("t")))), lambda x: x["t"]), " ").alias(out))
    return texts.join(lemma.withColumn(out, F.translate(out, "ё", "е")).hint("merge"), column, "left")


def analyzer_table(tokens: DataFrame) -> DataFrame:
    """token, lemma by an importable morphological analyzer; a token one of whose normal forms is itself stays."""
    import pymorphy3

    def run(frames):
        import pandas as pd

        morph = pymorphy3.MorphAnalyzer()
        for frame in frames:
            out = []
            for token in frame["token"]:
                parses = morph.parse(token)
                forms = [p.normal_form for p in parses]
                out.append(token if not parses or not parses[0].is_known or token in forms else forms[0])
            yield pd.DataFrame({"token": frame["token"], "lemma": out})

    return tokens.select("token").distinct().mapInPandas(run, "token string, lemma string")


def corpus_audit(queries: DataFrame, column: str, weight: str | None = None, table: DataFrame | None = None) -> DataFrame:
    """Every distinct query with all its stages and which stage changed it."""
    from quern.functions.text import stages

    base = queries.groupBy(F.col(column).alias("original")).agg((F.sum(weight) if weight else F.count(F.lit(1))).alias("n_rows"))
    named = stages(F.col("original"))
    rows = base
    for name in ("nfkc", "yo_equal_e", "lower", "separators", "spaces"):
        rows = rows.withColumn(name, named[name])
    rows = lemmatize(rows, "spaces", table)
    order = ["original", "nfkc", "yo_equal_e", "lower", "separators", "spaces", "lemma"]
    return rows.withColumns({f"changed_{b}": F.col(a) != F.col(b) for a, b in zip(order, order[1:], strict=False)})


def deduplicate(audit: DataFrame) -> DataFrame:
    """One row per lemma: the smallest raw form represents it, with the number of raw forms and rows it stands for."""
    kept = audit.filter("lemma <> ''").groupBy("lemma").agg(F.min_by("original", F.struct((-F.col("n_rows")).alias("a"), "original")).alias("representative"), F.count(F.lit(1)).alias("n_variants"), F.sum("n_rows").alias("n_rows"))
    return kept


def collisions(audit: DataFrame) -> DataFrame:
    """Lemmas that several raw forms meet in."""
    return deduplicate(audit).filter("n_variants > 1")
