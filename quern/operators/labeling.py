"""Weak labels for entity recognition: clicks, gazetteer, typed attributes, merge rules, synthetic queries, gold samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quern.operators.clicks import purity

#: Brand spellings, unit kinds and features of typed attributes, attribute names that aren't values.
TRANSLITERATED = {"айфон": "iphone", "айфоны": "iphone", "эпл": "apple", "эппл": "apple", "аппл": "apple", "сяоми": "xiaomi", "ксиоми": "xiaomi", "самсунг": "samsung", "хуавей": "huawei", "хонор": "honor", "редми": "redmi", "реалми": "realme", "поко": "poco", "оппо": "oppo", "виво": "vivo", "техно": "tecno", "бош": "bosch", "сони": "sony", "филипс": "philips", "дайсон": "dyson", "хайер": "haier", "элджи": "lg", "асус": "asus", "леново": "lenovo", "эйсер": "acer"}
UNIT_KINDS = {"гб": "memory", "gb": "memory", "тб": "memory", "tb": "memory", "дюйм": "diagonal", "дюйма": "diagonal", "дюймов": "diagonal", "см": "dimension", "мм": "dimension", "гц": "refresh", "hz": "refresh", "герц": "refresh", "мач": "battery", "mah": "battery", "л": "volume", "литр": "volume", "литра": "volume", "литров": "volume", "вт": "power", "квт": "power"}
FEATURES = {"5g": ("network", "5g"), "4g": ("network", "4g"), "lte": ("network", "lte"), "wifi": ("connectivity", "wifi"), "wi-fi": ("connectivity", "wifi"), "nfc": ("connectivity", "nfc"), "bluetooth": ("connectivity", "bluetooth"), "esim": ("sim", "esim"), "nano-sim": ("sim", "nano-sim"), "oled": ("panel", "oled"), "qled": ("panel", "qled"), "amoled": ("panel", "amoled"), "ips": ("panel", "ips"), "mini led": ("panel", "mini led"), "смарт": ("smart", "smart"), "smart": ("smart", "smart"), "инверторный": ("motor", "инверторный"), "инвертор": ("motor", "инверторный"), "с сушкой": ("feature", "с сушкой"), "с паром": ("feature", "с паром"), "сенсорный": ("control_type", "сенсорный")}
ATTR_STOP_FIRST = "для под с из на без от по до в и к".split()
ATTR_STOP_FULL = ("страна", "гарантия", "гарантия предоставляется", "модель", "вес", "ширина", "высота", "глубина", "бренд", "тип", "размер", "габаритные размеры", "цвет", "производитель", "артикул", "серия")
MEMORY_CATEGORIES = ("Смартфоны", "Планшеты", "iPhone")
DIAGONAL_CATEGORIES = ("Телевизоры", "Планшеты", "Ноутбуки")
NUMBER_UNIT = r"(?<![0-9a-zа-яё])(\d+(?:[.,]\d+)?)\s*(гб|gb|тб|tb|дюймов|дюйма|дюйм|см|мм|герц|гц|hz|мач|mah|литров|литра|литр|л|квт|вт)(?![0-9a-zа-яё])"


def click_labels(clicks: DataFrame, query: str, category: str, brand: str, categories: DataFrame, min_rows: int = 5, threshold: float = 0.9) -> DataFrame:
    """Queries with ``min_rows`` rows or more whose category is pure enough and listed in ``categories`` (category_label); the brand only where pure as well, and whether the query holds it."""
    sizes = clicks.groupBy(query).agg(F.count(F.lit(1)).alias("n_clicks")).filter(F.col("n_clicks") >= min_rows)
    c = purity(clicks, query, category, 1).select(query, F.col("top_label").alias("category_label"), F.col("purity").alias("category_purity"))
    b = purity(clicks, query, brand, 1).select(query, F.col("top_label").alias("brand_label"), F.col("purity").alias("brand_purity"))
    joined = sizes.join(c, query).filter(F.col("category_purity") >= threshold).join(categories, "category_label", "left_semi").join(b, query, "left")
    sure = F.col("brand_purity") >= threshold
    return joined.withColumns({"brand_label": F.when(sure, F.col("brand_label")), "brand_purity": F.when(sure, F.col("brand_purity"))}).withColumn("brand_literal_match", F.coalesce(F.contains(F.lower(query), F.lower("brand_label")), F.lit(False)))


def attribute_name_ok(name: Column) -> Column:
    low = F.lower(F.trim(name))
    return ~low.isin(*ATTR_STOP_FULL) & ~F.split(low, " ")[0].isin(*ATTR_STOP_FIRST)


def number_units(text: Column) -> Column:
    """array<struct<text,attr_type,value>> of numbers with a unit; numbers inside model codes don't count."""
    kinds = F.create_map(*[x for k, v in UNIT_KINDS.items() for x in (F.lit(k), F.lit(v))])
    low = F.lower(text)
    whole, number, unit = (F.regexp_extract_all(low, F.lit(NUMBER_UNIT), F.lit(i)) for i in range(3))
    return F.transform(F.arrays_zip(whole.alias("w"), number.alias("n"), unit.alias("u")), lambda x: F.struct(x["w"].alias("text"), F.try_element_at(kinds, x["u"]).alias("attr_type"), F.concat(x["n"], F.lit(" "), x["u"]).alias("value")))


def bare_numbers(queries: DataFrame, query: str, category: str, values: DataFrame) -> DataFrame:
    """Numbers that stand alone and are catalog values of the query's category: memory from 32 up, diagonals. ``values`` has category, attr_type, number."""
    number = F.explode(F.regexp_extract_all(F.lower(query), F.lit(r"(?<![0-9a-zа-яё.,])(\d{1,9})(?![0-9a-zа-яё]|[.,]\d|\s*(?:гб|gb|тб|tb|дюйм|см|мм|гц|hz|герц|мач|mah|л|вт|квт)(?![0-9a-zа-яё]))"), F.lit(1)))
    met = queries.select(query, F.col(category).alias("category"), number.alias("number")).withColumn("number", F.col("number").cast("bigint"))
    hits = met.join(values, ["category", "number"])
    fits = (F.col("attr_type") == "memory") & F.col("category").isin(*MEMORY_CATEGORIES) & (F.col("number") >= 32) | (F.col("attr_type") == "diagonal") & F.col("category").isin(*DIAGONAL_CATEGORIES)
    return hits.filter(fits).distinct()


def merge_brand(rows: DataFrame) -> DataFrame:
    """Adds brand_final, brand_confidence, route. Needs click_brand, click_purity, gazetteer_brands (array of normalized names).

    Agreement (equal, or one within the other) is high; disagreement goes to gold; clicks alone by purity, low to gold; the gazetteer alone
    is medium, with the fewest spaces, Latin first, the longest.
    """
    c, g = F.col("click_brand"), F.coalesce("gazetteer_brands", F.array().cast("array<string>"))
    agree = F.exists(g, lambda x: F.contains(x, c) | F.contains(c, x))
    only = F.array_sort(F.transform(g, lambda x: F.struct((F.length(x) - F.length(F.replace(x, F.lit(" "), F.lit("")))).alias("a"), F.when(x.rlike(r"^[\x00-\x7f]*$"), 0).otherwise(1).alias("b"), (-F.length(x)).alias("c"), x.alias("x"))))
    has_c, has_g = c.isNotNull(), F.size(g) > 0
    sure = F.when(has_c & has_g & agree, "high").when(has_c & ~has_g, F.when(F.col("click_purity") >= 0.9, "high").when(F.col("click_purity") >= 0.7, "medium").otherwise("low")).when(~has_c & has_g, "medium")
    route = F.when(has_c & has_g & ~agree, "golden_conflict").when(sure == "low", "golden_low").otherwise("train")
    final = F.when(route == "train", F.when(has_c, c).otherwise(F.try_element_at(only, F.lit(1))["x"]))
    return rows.withColumns({"brand_confidence": sure, "route": route, "brand_final": final})


def category_by_name(queries: DataFrame, key: str, tokens: str, names: DataFrame) -> DataFrame:
    """Queries that hold all name tokens of exactly one category. ``names`` has category, name_tokens."""
    each = queries.select(key, F.explode(F.array_distinct(tokens)).alias("token"))
    wanted = names.select("category", F.size(F.array_distinct("name_tokens")).alias("need"), F.explode(F.array_distinct("name_tokens")).alias("token"))
    full = each.join(wanted, "token").groupBy(key, "category", "need").agg(F.count(F.lit(1)).alias("n")).filter("n = need")
    return full.groupBy(key).agg(F.count(F.lit(1)).alias("_n"), F.min("category").alias("category_label")).filter("_n = 1").drop("_n")


def synthetic_queries(top_brands: DataFrame, top_attrs: DataFrame, surfaces: DataFrame, cap: int = 1500, seed: int = 17) -> DataFrame:
    """Template queries per category: surface brand, brand surface, surface attr, brand surface attr; distinct, at most ``cap`` in hash order.

    The tables are top-k lists per category, joined on it.
    """
    base = surfaces.join(top_brands, "category")
    none = F.lit(None).cast("string")
    t1 = base.select("category", F.concat_ws(" ", "surface", "brand").alias("query_text"), "brand", none.alias("attr"))
    t2 = base.select("category", F.concat_ws(" ", "brand", "surface").alias("query_text"), "brand", none.alias("attr"))
    t3 = surfaces.join(top_attrs, "category").select("category", F.concat_ws(" ", "surface", "attr").alias("query_text"), none.alias("brand"), "attr")
    t4 = base.join(top_attrs, "category").select("category", F.concat_ws(" ", "brand", "surface", "attr").alias("query_text"), "brand", "attr")
    rows = t1.union(t2).union(t3).union(t4).groupBy("category", "query_text").agg(F.min("brand").alias("brand_label"), F.min("attr").alias("attr_label"))
    order = Window.partitionBy("category").orderBy(F.md5(F.concat("query_text", F.lit(f"|{seed}")).cast("binary")), "query_text")
    return rows.withColumn("_r", F.row_number().over(order)).filter(F.col("_r") <= cap).drop("_r")


def entity_combinations(examples: DataFrame, tags: str) -> DataFrame:
    """How often each set of entity types stands together."""
    kinds = F.array_sort(F.array_distinct(F.transform(F.filter(tags, lambda t: t.startswith("B-")), lambda t: F.substring(t, 3, 1000))))
    return examples.select(F.when(F.size(kinds) == 0, "(none)").otherwise(F.array_join(kinds, "+")).alias("combination")).groupBy("combination").agg(F.count(F.lit(1)).alias("n_examples"))


def features(text: Column) -> Column:
    """array<struct<text,attr_type,value>> of words of the feature lexicon, the longest at each place."""
    known = F.create_map(*[x for k, (kind, value) in FEATURES.items() for x in (F.lit(k), F.struct(F.lit(kind).alias("attr_type"), F.lit(value).alias("value")))])
    names = "|".join(sorted((k.replace("+", r"\+").replace(".", r"\.") for k in FEATURES), key=lambda k: (-len(k), k)))
    found = F.regexp_extract_all(F.lower(text), F.lit(rf"(?<![0-9a-zа-яё])({names})(?![0-9a-zа-яё])"), F.lit(1))
    return F.transform(found, lambda x: F.struct(x.alias("text"), known[x]["attr_type"].alias("attr_type"), known[x]["value"].alias("value")))


def catalog_values(queries: DataFrame, key: str, query: str, category: str, values: DataFrame, longest: int = 3) -> DataFrame:
    """(key, attr_type, value, start, end): spans of a query that are values of an attribute of its category. ``values`` has category, attr_type, value."""
    from quern.operators.match import ngrams

    spans = ngrams(queries, key, query, longest).join(queries.select(key, F.col(category).alias("category")), key)
    known = values.filter(attribute_name_ok(F.col("attr_type"))).select("category", "attr_type", "value", F.lower("value").alias("phrase")).distinct()
    return spans.join(known, ["category", "phrase"]).select(key, "attr_type", "value", "start", "end")


def gold_sample(examples: DataFrame, query: str, weight: str, text: str, spans: str, n: int, seed: int = 42) -> DataFrame:
    """A weighted sample of ``n`` distinct queries with tokens and the tags of their spans by owner, for review."""
    from quern.functions.text import tokens
    from quern.operators.match import owner_tags
    from quern.operators.sampling import weighted_sample

    made = weighted_sample(examples, query, weight, n, seed).withColumn("tokens", tokens(F.col(text)))
    return made.withColumn("tags", owner_tags(F.col("tokens"), F.col(spans)))
