"""Silver annotation: a consistent high-confidence pool, candidates from the best items of each query, resolution, grades, review sample."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quern.operators.clicks import SCORE_DIGITS
from quern.operators.match import greedy
from quern.operators.sampling import hash_key, hash_sample

#: Which kind of entity wins; catalog attributes by kind.
PRIORITY = {"brand": 110, "model": 100, "processor_model": 80, "processor_brand": 75, "memory_ram": 70, "memory_rom": 70, "screen_diagonal": 65, "refresh_rate": 65, "battery_capacity": 65, "power": 60, "display_technology": 55, "os": 55, "os_version": 55, "color": 50, "material": 45}
ATTRIBUTES = {"цвет": "color", "материал": "material", "материал корпуса": "material", "диагональ": "screen_diagonal", "диагональ экрана": "screen_diagonal", "диагональ дисплея": "screen_diagonal", "частота обновления": "refresh_rate", "емкость аккумулятора": "battery_capacity", "емкость аккумулятора а ч": "battery_capacity", "технология экрана": "display_technology", "операционная система": "os", "оперативная память ram": "memory_ram", "встроенная память rom": "memory_rom", "производитель процессора": "processor_brand", "модель процессора": "processor_model", "потребляемая мощность": "power", "максимальная мощность": "power", "мощность": "power"}


def pool(dataset: DataFrame, lemma: str, target: int, seed: int = 42) -> DataFrame:
    """The ``target`` queries first by tier and hash among the lemma groups that agree on one category within their best tier."""
    tier = F.when((F.col("category_confidence") >= 0.90) & (F.col("click_count") >= 5), 0).otherwise(1)
    good = dataset.filter((F.col("category_confidence") >= 0.80) & (F.col("click_count") >= 3) & F.col("dominant_category_id").isNotNull() & F.col("query_length_words").between(1, 20) & (F.col("query_length_chars") <= 200) & (F.col(lemma) != ""))
    good = good.withColumns({"eligibility_tier": tier, "sample_hash": hash_key("query_canonical", seed)})
    agreed = good.groupBy(lemma, "eligibility_tier").agg(F.count_distinct("dominant_category_id").alias("n")).filter("n = 1").groupBy(lemma).agg(F.min("eligibility_tier").alias("eligibility_tier"))
    order = Window.partitionBy(lemma).orderBy(F.col("category_confidence").desc(), F.col("click_count").desc(), "sample_hash")
    unique = good.join(agreed, [lemma, "eligibility_tier"]).withColumn("_rank", F.row_number().over(order)).filter("_rank = 1").drop("_rank")
    return unique.orderBy("eligibility_tier", "sample_hash").limit(target)


def grade() -> Column:
    return F.when((F.col("category_confidence") >= 0.95) & (F.col("click_count") >= 5), "A").when((F.col("category_confidence") >= 0.90) & (F.col("click_count") >= 5), "B").otherwise("C")


def silver_id(key: str) -> Column:
    return F.substring(F.sha2(F.col(key).cast("binary"), 256), 1, 24)


def best_items(pairs: DataFrame, selected: DataFrame, n: int = 10) -> DataFrame:
    """The n items of each selected query with the most evidence, ties to the smaller id."""
    order = Window.partitionBy("query_canonical").orderBy(F.col("evidence_score").desc(), "sku_id")
    return pairs.join(selected.select("query_canonical"), "query_canonical", "left_semi").withColumn("sku_rank", F.row_number().over(order)).filter(F.col("sku_rank") <= n)


def share_candidates(items: DataFrame, group: list[str], value: str, n: int = 10, min_confidence: float | None = None) -> DataFrame:
    """Values of each group with their share of its evidence, the n best."""
    scores = items.filter(F.trim(F.coalesce(value, F.lit(""))) != "").groupBy(*group, value).agg(F.round(F.sum("evidence_score"), SCORE_DIGITS).alias("score"))
    share = F.round(F.col("score") / F.nullif(F.sum("score").over(Window.partitionBy(*group)), F.lit(0.0)), 6)
    ranked = scores.withColumns({"confidence": share, "candidate_rank": F.row_number().over(Window.partitionBy(*group).orderBy(F.col("score").desc(), value))})
    return ranked.filter((F.col("candidate_rank") <= n) & (F.lit(True) if min_confidence is None else F.col("confidence") >= min_confidence))


def attribute_candidates(items: DataFrame, attributes: DataFrame, names: dict[str, str] | None = None) -> DataFrame:
    """Attribute values of the best items by kind, those with a share of 0.80 or more."""
    kinds = F.broadcast(items.sparkSession.createDataFrame(list((names or ATTRIBUTES).items()), "attribute_name string, entity_type string"))
    return share_candidates(items.join(attributes, "sku_id").join(kinds, "attribute_name"), ["query_canonical", "entity_type"], "attribute_value", min_confidence=0.80)


def model_surface_ok(surface: Column, confidence: Column, generic: tuple[str, ...] = ()) -> Column:
    """Models need a digit, or a compact sure Latin name; generic words, single letters and long surfaces are out."""
    words, digit = F.size(F.split(surface, " ")), surface.rlike(r"\d")
    compact = surface.rlike("[a-zA-Z]") & (confidence >= 0.90) & (words <= 3)
    return ~surface.isin(*generic, "") & (digit | (F.length(surface) >= 3)) & (digit | compact) & (words <= 5) & (F.length(surface) <= 60)


def accepted(kind: Column, confidence: Column) -> Column:
    """Gates: brands 0.90, others 0.80."""
    return F.when(kind == "brand", confidence >= 0.90).otherwise(confidence >= 0.80)


def resolve(spans: Column) -> tuple[Column, Column]:
    """Non-overlapping entities by kind, length, confidence, start."""
    priority = F.create_map(*[x for k, v in PRIORITY.items() for x in (F.lit(k), F.lit(v))])
    return greedy(spans, [lambda s: -F.coalesce(F.try_element_at(priority, s["type"]), F.lit(0)), lambda s: s["start"] - s["end"], lambda s: -s["confidence"], lambda s: s["start"]])


def review_sample(rows: DataFrame, key: str, types: str, kinds: list[str], general: int, per_type: int, total: int, seed: int = 42) -> DataFrame:
    """A general hash sample and one of each entity type; rows that several hold keep the first; ``total`` at most."""
    union = hash_sample(rows, key, general, seed).withColumn("review_priority", F.lit(0))
    for i, kind in enumerate(kinds):
        union = union.unionByName(hash_sample(rows.filter(F.array_contains(types, kind)), key, per_type, seed).withColumn("review_priority", F.lit(i + 1)))
    unique = union.withColumn("_rank", F.row_number().over(Window.partitionBy(key).orderBy("review_priority"))).filter("_rank = 1").drop("_rank")
    return unique.orderBy("review_priority", hash_key(key, seed), key).limit(total)


def entity_audit(entities: DataFrame, kind: str, confidence: str, example: str, n: int = 8, seed: int = 42) -> DataFrame:
    """Per entity type: count, least and mean confidence, n examples in hash order."""
    first = entities.select(kind, example).distinct().withColumn("_r", F.row_number().over(Window.partitionBy(kind).orderBy(hash_key(example, seed), example))).filter(F.col("_r") <= n)
    examples = first.groupBy(kind).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_r", F.col(example).cast("string").alias("e")))), lambda x: x["e"]), "|").alias("examples"))
    return entities.groupBy(kind).agg(F.count(F.lit(1)).alias("n_entities"), F.round(F.min(confidence), 6).alias("min_confidence"), F.round(F.avg(confidence), 6).alias("avg_confidence")).join(examples, kind)
