"""Unified annotation: texts in, nested facts, entities, BIO tags, warnings out. Stateless, so it also runs on a stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions.lookup import held, per_text
from quern.functions.text import model_text, stages, tokens
from quern.operators import match
from quern.operators.colors import color_confidence
from quern.operators.measure import measurements

MAX_CHARS = 2_000
#: Stop words by group, intents, and words that are never stopped.
STOP_GROUPS = {
    "prepositions": "в во для из изо к ко меж между на над о об обо от ото по под подо перед пред при про ради с со у",
    "transaction_words": "заказать заказывать купить покупать покупка продажа продаваться приобрести приобретать",
    "search_filler": "выбрать выбирать где искать как какой можно найти надо нужен пожалуйста показать посмотреть подсказать посоветовать хотеть что",
    "channel_words": "интернет магазин мвидео онлайн сайт",
}
INTENTS = {
    "price": "дешево дорого недорого сколько стоимость стоить цена",
    "promotion": "акция промокод распродажа скидка",
    "research": "лучший обзор отзыв рейтинг сравнение сравнить топ хороший",
    "availability": "доставка наличие самовывоз",
    "geo": "москва петербург спб",
}
PROTECTED = "без до за около после против через новый оригинал оригинальный официальный".split()
FACT = "type string, value string, surface string, start int, end int, confidence double, source string"


def word_groups() -> dict[str, str]:
    """Word to the first group it belongs to; protected words have none."""
    out: dict[str, str] = {}
    for name, words in [*((f"intent:{k}", v) for k, v in INTENTS.items()), *STOP_GROUPS.items()]:
        for w in words.split():
            out.setdefault(w, name)
    return {w: g for w, g in out.items() if w not in PROTECTED}


def stopwords(lemma: Column) -> dict[str, Column]:
    """search_text, removed (array of token and group) and one ``<intent>_intent`` flag each, of a lemma text."""
    known = F.create_map(*[x for w, g in word_groups().items() for x in (F.lit(w), F.lit(g))])
    words = F.transform(tokens(lemma), lambda t: F.struct(t["text"].alias("token"), F.try_element_at(known, t["text"]).alias("group")))
    removed = F.filter(words, lambda w: w["group"].isNotNull())
    out = {"search_text": F.array_join(F.transform(F.filter(words, lambda w: w["group"].isNull()), lambda w: w["token"]), " "), "removed": removed}

    def flag(name: str) -> Column:
        return F.exists(removed, lambda w: w["group"] == f"intent:{name}")

    return out | {f"{name}_intent": flag(name) for name in INTENTS}


def _facts(measured: Column) -> Column:
    """Facts of measurements that have a number and weren't rejected."""
    good = F.filter(measured, lambda m: m["has_number"] & ~m["rejected"])
    return F.transform(
        good,
        lambda m: F.struct(
            F.coalesce(m["entity_type"], F.lit("measurement")).alias("type"),
            F.array_join(F.concat(m["numbers"], F.array(m["canonical_unit"])), " ").alias("value"),
            m["surface"].alias("surface"), m["start"].alias("start"), m["end"].alias("end"),
            F.when(m["entity_type"].isNull(), 0.88).otherwise(m["confidence"]).alias("confidence"),
            F.lit("measurement_scanner").alias("source"),
        ),
    )


def quarantine(queries: DataFrame, text: str) -> DataFrame:
    """Queries too long to annotate."""
    return queries.filter(F.length(text) > MAX_CHARS)


def annotate(queries: DataFrame, key: str, text: str, dictionary: DataFrame, longest: int = 4, hint: str | None = None, brands: dict[str, int] | None = None, lemma=None, lemmas: DataFrame | None = None) -> DataFrame:
    """One row per query of at most MAX_CHARS characters: query_model, search_text, intents, facts, entities, bio_tags, bio_mask, rejected, warnings.

    ``dictionary`` has pattern, entity_type (brand, category, color), entity_id, canonical, count, source; ``key`` is unique per row. With ``lemmas`` (token, lemma) dictionary spans match by lemma as well.
    """
    short = queries.filter(F.coalesce(F.length(text), F.lit(0)) <= MAX_CHARS)
    return per_text(short, [text, hint] if hint else [text], lambda rows: _annotated(rows, text, dictionary, longest, hint, brands, lemma, lemmas))


def _annotated(texts: DataFrame, text: str, dictionary: DataFrame, longest: int, hint: str | None, brands: dict[str, int] | None, lemma, lemmas: DataFrame | None) -> DataFrame:
    """The annotations of distinct texts, or of distinct texts and hints."""
    base = texts.withColumn("query_model", model_text(F.coalesce(F.col(text), F.lit(""))))
    stopped = stopwords(stages(F.coalesce(F.col(text), F.lit("")), lemma)["lemma"])
    counted = dictionary.filter("entity_type = 'color'").groupBy(F.col("pattern").alias("_p")).agg(F.max("count").alias("_count"))
    spans_of = match.matcher(dictionary, longest, lemmas)
    count_of = held(counted, "_p", ["_count"]) if spans_of else None

    def fact(s, count):
        confidence = F.when((s("type") == "color") & ~s("ambiguous"), color_confidence(F.coalesce(count, F.lit(0)), F.lower(s("surface")))).otherwise(s("confidence"))
        return F.struct(*[s(c).alias(c) for c in ("type", "value", "surface")], s("start").cast("int").alias("start"), s("end").cast("int").alias("end"), confidence.alias("confidence"), s("source").alias("source"), s("ambiguous").alias("ambiguous"), F.coalesce(count, F.lit(0)).cast("long").alias("count"))

    none = F.array().cast("array<struct<type:string,value:string,surface:string,start:int,end:int,confidence:double,source:string,ambiguous:boolean,count:bigint>>")
    if count_of:
        made = F.transform(spans_of(F.col("query_model")), lambda s: fact(s.getField, F.try_element_at(count_of(F.lower(s["surface"])), F.lit(1))["_count"]))
        rows = base.select("*", F.explode(F.array(F.coalesce(F.array_sort(made), none))).alias("_m"))  # a generator, so that the lambdas over it aren't merged with its own
    else:
        met = match.dictionary_matches(base.select(F.col(text).alias("_key"), "query_model").distinct(), "_key", "query_model", dictionary, longest, lemmas).join(counted, F.lower("surface") == F.col("_p"), "left")
        gathered = met.groupBy("_key").agg(F.array_sort(F.collect_list(fact(F.col, F.col("_count")))).alias("_m"))
        rows = base.join(gathered.hint("merge"), F.col(text) == F.col("_key"), "left").withColumn("_m", F.coalesce("_m", none))
    best = [lambda s: s["start"] - s["end"], lambda s: -s["confidence"], lambda s: s["start"]]
    of = lambda kind: F.filter("_m", lambda m: (m["type"] == kind) & ~m["ambiguous"])
    rows = rows.withColumns({"_brand": match.greedy(of("brand"), best)[0], "_category": match.greedy(of("category"), best)[0], "_allbrands": F.filter("_m", lambda m: m["type"] == "brand")})
    rows = rows.withColumn("_color", match.greedy(F.filter(of("color"), lambda m: ~F.exists("_allbrands", lambda b: (b["start"] <= m["start"]) & (b["end"] >= m["end"]))), [lambda s: s["start"] - s["end"], lambda s: -s["count"], lambda s: s["start"]])[0])
    given = F.col(hint) if hint else F.lit(None).cast("string")
    rows = rows.withColumn("category_hint", F.coalesce(given, F.try_element_at("_category", F.lit(1))["value"], F.lit("")))
    rows = rows.withColumn("_measured", measurements(F.col("query_model"), F.col("category_hint"), brands))
    rows = rows.withColumn("_mfacts", _facts(F.col("_measured")))
    slim = lambda a: F.transform(a, lambda m: F.struct(*[m[f.split()[0]].alias(f.split()[0]) for f in FACT.split(", ")]))
    outside = F.filter("_brand", lambda b: ~F.exists("_mfacts", lambda m: (b["start"] >= m["start"]) & (b["end"] <= m["end"])))
    facts = F.array_distinct(F.concat(slim(outside), slim(F.col("_category")), F.col("_mfacts"), slim(F.col("_color"))))
    rows = rows.withColumn("facts", F.array_sort(facts, lambda a, b: F.when(a["start"] != b["start"], a["start"] - b["start"]).when(a["end"] != b["end"], a["end"] - b["end"]).when(a["type"] < b["type"], -1).otherwise(F.when(a["type"] > b["type"], 1).otherwise(0))))
    chosen, lost = match.greedy(F.col("facts"), match.fact_rank())
    rows = rows.withColumns({"entities": chosen, "_lost": lost, "tokens": tokens(F.col("query_model"))})
    tags, mask = match.bio(F.col("tokens"), F.col("entities"))
    why = lambda a, reason: F.transform(a, lambda m: F.struct(m["type"].alias("type"), m["surface"].alias("surface"), m["start"].alias("start"), m["end"].alias("end"), F.lit(reason).alias("reason")))
    rejected = F.concat(
        why(F.filter("_m", lambda m: m["ambiguous"]), "ambiguous_dictionary_surface"),
        F.transform(F.filter("_measured", lambda m: m["rejected"] | ~m["has_number"]), lambda m: F.struct(F.lit("measurement").alias("type"), m["surface"].alias("surface"), m["start"].alias("start"), m["end"].alias("end"), F.when(m["rejected"], m["reason"]).otherwise("unit_without_number").alias("reason"))),
        why(F.filter("_brand", lambda b: F.exists("_mfacts", lambda m: (b["start"] >= m["start"]) & (b["end"] <= m["end"]))), "brand_surface_inside_number_plus_unit"),
        why(F.col("_lost"), "overlap_with_higher_priority_fact"),
    )
    warnings = F.array_compact(F.array(
        F.when(F.trim(F.coalesce(F.col(text), F.lit(""))) == "", "empty_query"),
        F.when(F.exists("_m", lambda m: (m["type"] == "category") & m["ambiguous"]), "ambiguous_explicit_category"),
        F.when(F.exists("_measured", lambda m: m["has_number"] & ~m["rejected"] & m["entity_type"].isNull() & (F.size(m["suggested"]) > 0)), "generic_measurement_requires_model_context"),
    ))
    return rows.withColumns({"bio_tags": tags, "bio_mask": mask, "rejected": rejected, "warnings": warnings} | stopped).select(
        *texts.columns, "query_model", "search_text", "removed", *[f"{n}_intent" for n in INTENTS], "category_hint", "facts", "entities", "tokens", "bio_tags", "bio_mask", "rejected", "warnings"
    )
