"""Dictionary tables: patterns built from catalog records and curated overrides, gazetteers, verification, typo candidates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions.text import words
from quern.operators.labeling import TRANSLITERATED, attribute_name_ok
from quern.operators.match import usable

PATTERN = "pattern string, entity_type string, entity_id string, canonical string, count long, source string"


def token_table(texts: DataFrame, column: str, lemmas: DataFrame | None) -> DataFrame:
    """(column, pattern): each distinct text as its lower-case words, by their lemmas where ``lemmas`` (token, lemma) has them, joined by spaces."""
    plain = texts.select(column).distinct().withColumn("_w", words(F.lower(column)))
    if lemmas is None:
        return plain.select(column, F.array_join("_w", " ").alias("pattern"))
    known = lemmas.groupBy("token").agg(F.min("lemma").alias("lemma"))
    each = plain.select(column, F.posexplode("_w").alias("pos", "token")).join(known, "token", "left").select(column, F.struct("pos", F.coalesce("lemma", "token").alias("t")).alias("x"))
    return each.groupBy(column).agg(F.array_join(F.transform(F.array_sort(F.collect_list("x")), lambda x: x["t"]), " ").alias("pattern"))


def build(records: DataFrame, lemmas: DataFrame | None = None, overrides: DataFrame | None = None) -> DataFrame:
    """The pattern table of ``dictionary_matches`` from records of entity_type, entity_id, canonical, normalized, lemma, aliases, count.

    Surfaces are the canonical, normalized and lemma forms and the aliases; a pattern is a surface's words by lemma. Patterns without a letter or of
    one character go. An override (surface, target_ids, sources) of a pattern leaves, where any is there, only the entries of its targets, and names
    its sources. Of one entry's rows the largest count stands. Null forms and aliases count as absent.
    """
    forms = F.filter(F.array_distinct(F.concat(F.array("canonical", "normalized", "lemma"), F.coalesce("aliases", F.array().cast("array<string>")))), lambda s: s.isNotNull())
    surfaces = records.select("entity_type", F.col("entity_id").cast("string").alias("entity_id"), "canonical", F.col("count").cast("long").alias("count"), F.explode(forms).alias("surface"))
    rows = surfaces.join(token_table(surfaces, "surface", lemmas), "surface")
    rows = usable(rows.groupBy("pattern", "entity_type", "entity_id", "canonical").agg(F.max("count").alias("count")))
    plain = F.concat(F.lit("catalog_"), "entity_type", F.lit("_trie"))
    if overrides is None:
        return rows.withColumn("source", plain).select(*[c.split()[0] for c in PATTERN.split(", ")])
    asked = overrides.join(token_table(overrides, "surface", lemmas), "surface").groupBy("pattern").agg(F.first("target_ids").alias("target_ids"), F.first("sources").alias("sources"))
    met = rows.join(asked, "pattern", "left").withColumn("_in", F.coalesce(F.array_contains("target_ids", F.col("entity_id")), F.lit(False)))
    chosen = met.groupBy("pattern", "entity_type").agg(F.max("_in").alias("_some"))
    kept = met.join(chosen, ["pattern", "entity_type"]).filter("_in OR NOT _some")
    names = F.array_join("sources", "+")
    curated = F.concat(F.lit("curated_category_alias:"), F.when(F.coalesce(names, F.lit("")) == "", "configured").otherwise(names))
    return kept.withColumn("source", F.when(F.col("_some"), curated).otherwise(plain)).select(*[c.split()[0] for c in PATTERN.split(", ")])


def gazetteer(brands: DataFrame, categories: DataFrame, attributes: DataFrame) -> DataFrame:
    """Patterns for gazetteer scans from name and count: brands of three characters or more with their transliterations, words of four or more
    Cyrillic letters of category names, attribute names of four characters or more that can be values."""
    low = F.trim(F.lower("name"))
    named = brands.select(low.alias("canonical"), "count").filter(F.length("canonical") >= 3)
    spelled = F.broadcast(brands.sparkSession.createDataFrame(list(TRANSLITERATED.items()), "pattern string, canonical string"))
    brand = named.select(F.col("canonical").alias("pattern"), "canonical", "count").union(named.join(spelled, "canonical").select("pattern", "canonical", "count"))
    category = categories.select(F.explode(words(low)).alias("pattern"), low.alias("canonical"), "count").filter(F.col("pattern").rlike("^[а-яё]{4,}$"))
    attribute = attributes.filter(attribute_name_ok(F.col("name"))).select(low.alias("pattern"), low.alias("canonical"), "count").filter(F.length("pattern") >= 4)
    rows = [x.select("pattern", F.lit(kind).alias("entity_type"), F.col("canonical").alias("entity_id"), "canonical", F.col("count").cast("long").alias("count"), F.lit(f"gazetteer_{kind}").alias("source")) for kind, x in (("brand", brand), ("category", category), ("attribute", attribute))]
    return rows[0].union(rows[1]).union(rows[2]).groupBy("pattern", "entity_type", "entity_id", "canonical", "source").agg(F.max("count").alias("count")).select(*[c.split()[0] for c in PATTERN.split(", ")])


def verify(dictionary: DataFrame, corpus: DataFrame, column: str) -> DataFrame:
    """(pattern, entity_type, n_entries, n_canonical, n_queries, status) of each pattern against the texts that are exactly it or hold all its words in a row.

    Status: ambiguous with several canonical values, unused without a text, else ok. Texts meet patterns by their runs of words.
    """
    entries = dictionary.groupBy("pattern", "entity_type").agg(F.count(F.lit(1)).alias("n_entries"), F.count_distinct(F.lower("canonical")).alias("n_canonical"), F.max(F.size(F.split("pattern", " "))).alias("_n"))
    longest = entries.agg(F.max("_n")).first()[0] or 1
    w = words(F.lower(column))
    runs = F.flatten(F.transform(F.sequence(F.lit(1), F.lit(longest)), lambda n: F.when(F.size("_w") >= n, F.transform(F.sequence(F.lit(1), F.size("_w") - n + 1), lambda i: F.array_join(F.slice("_w", i, n), " "))).otherwise(F.array().cast("array<string>"))))
    used = corpus.select(w.alias("_w")).filter(F.size("_w") > 0).select(F.explode(F.array_distinct(runs)).alias("pattern")).groupBy("pattern").agg(F.count(F.lit(1)).alias("n"))
    n = F.coalesce("n", F.lit(0))
    status = F.when(F.col("n_canonical") > 1, "ambiguous").when(n == 0, "unused").otherwise("ok")
    return entries.join(used, "pattern", "left").select("pattern", "entity_type", "n_entries", "n_canonical", n.alias("n_queries"), status.alias("status"))


def _shortened(word: Column, edits: int) -> Column:
    """The word and all forms of it without up to ``edits`` characters."""
    out = F.array(word)
    for _ in range(edits):
        less = F.flatten(F.transform(out, lambda x: F.when(F.length(x) > 1, F.transform(F.sequence(F.lit(1), F.length(x)), lambda i: F.concat(F.substring(x, F.lit(1), i - 1), F.substring(x, i + 1, F.length(x))))).otherwise(F.array().cast("array<string>"))))
        out = F.array_distinct(F.concat(out, less))
    return out


def typo_candidates(words_: DataFrame, edits: int = 1, least: int = 4, ratio: float = 10.0) -> DataFrame:
    """(word, candidate, distance): rare words within ``edits`` of words ``ratio`` times as frequent; for review only. ``words_`` has word, count.

    Words within that distance share a form with as many characters left out, so an equi-join of those forms finds them, never a cross join.
    """
    forms = words_.filter(F.length("word") >= least).select("word", "count", F.explode(_shortened(F.col("word"), edits)).alias("form"))
    x, y = forms.alias("x"), forms.alias("y")
    met = x.join(y, (F.col("x.form") == F.col("y.form")) & (F.col("y.count") >= F.col("x.count") * ratio)).select(F.col("x.word").alias("word"), F.col("y.word").alias("candidate")).distinct()
    return met.withColumn("distance", F.levenshtein("word", "candidate")).filter(F.col("distance").between(1, edits))
