"""Colors: a palette of thirty classes, classification of catalog values by anchors, parsing and canonicalization of texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.functions.text import collapse, nfkc, yo
from quern.operators.match import greedy

#: Class | label | English label | words of the class.
PALETTE = """
black|черный|black|угольный оникс noir
white|белый|white|белоснежный
multicolor|разноцветный|multicolor|многоцветный радужный мультиколор multi
transparent|прозрачный|transparent|бесцветный clear
gray|серый|gray|антрацит антрацитовый дымчатый пепельный маренго grey anthracite
silver|серебристый|silver|серебро серебряный стальной никель никелевый титан титановый алюминиевый platinum
chrome|хром|chrome|хромированный
beige|бежевый|beige|кашемировый капучино латте карамельный cashmere
blue|синий|blue|индиго ультрамарин сапфировый кобальтовый navy indigo
green|зеленый|green|салатовый оливковый изумрудный хаки лайм шалфей olive khaki lime sage
red|красный|red|алый рубиновый малиновый scarlet ruby
brown|коричневый|brown|кофейный ореховый каштановый венге махагон walnut mocha mokka coffee
stainless_steel|нержавеющая сталь|stainless steel|нержавеющий inox stainless
light_blue|голубой|light blue|небесный лазурный аквамариновый cyan skyblue aqua
pink|розовый|pink|пудровый фуксия rose
orange|оранжевый|orange|абрикосовый персиковый коралловый терракотовый apricot peach coral terracotta
purple|фиолетовый|purple|лиловый лавандовый аметистовый пурпурный violet lavender
graphite|графитовый|graphite|графит
gold|золотистый|gold|золото золотой латунь шампань golden champagne
yellow|желтый|yellow|лимонный горчичный охра lemon mustard
amber|янтарный|amber|медовый
bronze|бронзовый|bronze|бронза
turquoise|бирюзовый|turquoise|teal
cream|кремовый|cream|молочный ванильный жемчужный ivory pearl
mint|мятный|mint|
sand|песочный|sand|песчаный sandy
chocolate|шоколадный|chocolate|какао cocoa
lilac|сиреневый|lilac|
burgundy|бордовый|burgundy|винный вишневый бургунди maroon
copper|медный|copper|медь
"""
#: Phrases that can't be told word by word.
PHRASES = {"нержавеющая сталь": "stainless_steel", "нержавеющей стали": "stainless_steel", "нерж сталь": "stainless_steel", "нержсталь": "stainless_steel", "stainless steel": "stainless_steel", "розовое золото": "gold", "rose gold": "gold", "слоновая кость": "cream", "ivory white": "cream", "дуб сонома": "brown", "мокрый асфальт": "gray", "оружейная сталь": "gray", "gunmetal": "gray", "space gray": "gray", "space grey": "gray", "серый космос": "gray", "космический серый": "gray", "midnight black": "black", "space black": "black", "черный космос": "black", "темная ночь": "black", "темно синяя полночь": "blue"}
AMBIGUOUS_ENGLISH = ("black", "white", "orange", "red", "gold", "silver", "mint", "cream")
#: Endings of adjectives, by the ending of the dictionary form.
ENDINGS = {"ый": ("ый", "ая", "ое", "ые", "ого", "ой", "ому", "ую", "ым", "ом", "ых", "ыми"), "ой": ("ой", "ая", "ое", "ые", "ого", "ому", "ую", "ым", "ом", "ых", "ыми"), "ий": ("ий", "яя", "ее", "ие", "его", "ей", "ему", "юю", "им", "ем", "их", "ими")}


def normalize_color(c: Column) -> Column:
    """Lower-case runs of letters and digits, ё as е."""
    return collapse(F.regexp_replace(F.lower(yo(nfkc(c))), r"[^\p{L}\p{N}]+", " "))


def forms(word: str) -> tuple[str, ...]:
    return tuple(word[:-2] + e for e in ENDINGS[word[-2:]]) if word[-2:] in ENDINGS and len(word) > 4 else (word,)


def palette() -> list[tuple[str, str, str, list[str]]]:
    return [(i, ru, en, words.split()) for i, ru, en, words in (line.split("|") for line in PALETTE.strip().splitlines())]


def seed_aliases(spark: SparkSession) -> DataFrame:
    """color_id, canonical, normalized: inflected seed words, labels, phrases."""
    label = {i: ru for i, ru, _, _ in palette()}
    rows = {(i, f) for i, ru, en, words in palette() for w in (ru, en, *words) for f in ((w,) if " " in w else forms(w))} | {(i, p) for p, i in PHRASES.items()}
    return spark.createDataFrame(sorted((i, label[i], a) for i, a in rows), "color_id string, canonical string, normalized string")


def classify_values(values: DataFrame, column: str, aliases: DataFrame) -> DataFrame:
    """Adds normalized, color_id, mapping_reason. One color among the words: that; several: multicolor; none: null, for review."""
    named = values.withColumn("normalized", normalize_color(F.col(column)))
    words = named.select("normalized").distinct().select("normalized", F.explode(F.split("normalized", " ")).alias("word"))
    found = words.join(aliases.select(F.col("normalized").alias("word"), F.col("color_id").alias("_color")), "word").groupBy("normalized").agg(F.count_distinct("_color").alias("_colors"), F.min("_color").alias("_only"))
    phrases = aliases.sparkSession.createDataFrame(list(PHRASES.items()), "normalized string, _phrase string")
    joined = named.join(found, "normalized", "left").join(phrases, "normalized", "left")
    empty = F.col("normalized") == ""
    color = F.when(empty, None).when(F.col("_phrase").isNotNull(), F.col("_phrase")).when(F.col("_colors") == 1, F.col("_only")).when(F.col("_colors") > 1, "multicolor")
    reason = F.when(empty, "empty").when(F.col("_phrase").isNotNull(), "phrase_override").when(F.col("_colors") == 1, "color_anchor").when(F.col("_colors") > 1, "multiple_color_anchors").otherwise("no_safe_anchor")
    return joined.withColumns({"color_id": color, "mapping_reason": reason}).drop("_colors", "_only", "_phrase")


def color_dictionary(values: DataFrame, column: str, count: str, aliases: DataFrame) -> DataFrame:
    """Alias table: classified catalog values with their summed counts, and the seeds."""
    mapped = classify_values(values, column, aliases).filter("color_id IS NOT NULL")
    label = aliases.select("color_id", "canonical").distinct()
    counted = mapped.groupBy("normalized", "color_id").agg(F.sum(count).alias("catalog_count")).join(label, "color_id")
    seeds = aliases.join(counted.select("normalized", "color_id"), ["normalized", "color_id"], "left_anti").withColumn("catalog_count", F.lit(0))
    columns = ["color_id", "canonical", "normalized", "catalog_count"]
    return counted.select(columns).unionByName(seeds.select(columns))


def color_spans(matches: Column, brand_spans: Column) -> Column:
    """Non-overlapping colors among alias matches (type, value, start, end, confidence, ambiguous, count, alias), the longest, then commonest, then first; not inside a brand."""
    free = F.filter(matches, lambda m: ~m["ambiguous"] & ~F.exists(brand_spans, lambda b: (b["start"] <= m["start"]) & (b["end"] >= m["end"])))
    return greedy(free, [lambda s: s["start"] - s["end"], lambda s: -s["count"], lambda s: s["start"]])[0]


def color_confidence(count: Column, alias: Column) -> Column:
    return F.round(F.when(count > 0, 0.96).otherwise(0.91) - F.when(alias.isin(*AMBIGUOUS_ENGLISH), 0.08).otherwise(0.0), 3)


def canonical_text(text: Column, spans: Column) -> Column:
    """The text with each span, in order of start, exchanged for its value."""
    folded = F.aggregate(
        spans,
        F.struct(F.lit(0).alias("at"), F.lit("").alias("out")),
        lambda acc, s: F.struct(s["end"].alias("at"), F.concat(acc["out"], F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), s["value"]).alias("out")),
    )
    return F.concat(folded["out"], F.substring(text, folded["at"] + 1, F.length(text)))
