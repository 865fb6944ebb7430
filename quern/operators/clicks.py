"""Click log to query datasets: exact-duplicate collapse, evidence per (query, item), dominant category and brand, quality, rejects.

Plans: duplicates collapse before the catalog join (its columns depend on the item), aggregates are partial and final hash aggregates, arg-max
ranks become WindowGroupLimit, the catalog is joined on its key and left to the optimizer and AQE to broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quern.config import ClickPolicy, QualityThresholds

SCORE_DIGITS = 9  # sums of doubles depend on order; scores are rounded before they rank


def scan_clicks(raw: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Rename and cast the raw log. ``columns`` maps target names to source columns, whose names may need quoting; casts never fail."""
    kinds = {"sku_id": "bigint", "price": "double", "position": "int"}
    return raw.select(*[F.expr(f"try_cast(`{source}` AS {kinds.get(name, 'string')})").alias(name) for name, source in columns.items()])


def is_click(policy: ClickPolicy) -> Column:
    return F.lit(True) if policy.no_click_position is None else F.col("position") > policy.no_click_position


def collapse_exact(clicks: DataFrame) -> DataFrame:
    """One row per distinct row with its multiplicity."""
    return clicks.groupBy(*clicks.columns).agg(F.count(F.lit(1)).alias("exact_row_count"))


def pair_evidence(clicks: DataFrame, mapping: DataFrame, catalog: DataFrame, policy: ClickPolicy = ClickPolicy()) -> DataFrame:
    """Evidence of each (query_canonical, sku_id). The median is over exact groups, not weighted by their counts."""
    log = clicks.filter(is_click(policy)).filter(F.col("sku_id").isNotNull())
    named = log.join(mapping.select("query_original", "query_canonical"), "query_original").filter("query_canonical <> ''")
    exact = collapse_exact(named)
    discounted = F.col("exact_row_count") / F.log2(F.least(F.col("position"), F.lit(policy.position_cap)) + F.lit(2))
    pairs = exact.groupBy("query_canonical", "sku_id").agg(
        F.sum("exact_row_count").alias("click_count"),
        F.count(F.lit(1)).alias("exact_group_count"),
        F.min("position").alias("min_position"),
        F.median("position").alias("median_position"),
        F.avg("position").alias("mean_position"),
        F.round(F.sum(discounted), SCORE_DIGITS).alias("evidence_score"),
        F.min("price").alias("min_price"),
        F.median("price").alias("median_price"),
        F.max("price").alias("max_price"),
    )
    return pairs.join(catalog, "sku_id")


def top_label(pairs: DataFrame, label: str, score_name: str, extra: dict[str, str] | None = None) -> DataFrame:
    """Per query the label with the highest summed evidence, ties to the smaller label; empty labels don't compete."""
    scored = pairs.filter(F.col(label) != "").groupBy("query_canonical", label).agg(F.round(F.sum("evidence_score"), SCORE_DIGITS).alias(score_name), *[F.max(c).alias(n) for n, c in (extra or {}).items()])
    order = Window.partitionBy("query_canonical").orderBy(F.col(score_name).desc(), F.col(label))
    return scored.withColumn("rank", F.row_number().over(order)).filter("rank = 1").drop("rank")


def no_click_queries(clicks: DataFrame, mapping: DataFrame, policy: ClickPolicy = ClickPolicy(), keep_variant_filter: bool = True) -> DataFrame:
    """Queries seen without a click. With ``keep_variant_filter``, raw variants that always got a click are left out before summing."""
    use = clicks.join(mapping.select("query_original", "query_normalized", "query_canonical"), "query_original").filter("query_canonical <> ''")
    variants = use.groupBy("query_canonical", "query_normalized", "query_original").agg(
        F.count_if(~is_click(policy)).alias("no_click_row_count"), F.count_if(is_click(policy)).alias("positive_row_count")
    )
    if keep_variant_filter:
        variants = variants.filter("no_click_row_count > 0")
    out = variants.groupBy("query_canonical").agg(F.sum("no_click_row_count").alias("no_click_row_count"), F.sum("positive_row_count").alias("positive_row_count"))
    out = first_five(variants, "query_original", "query_original_examples").join(first_five(variants, "query_normalized", "query_normalized_variants"), "query_canonical").join(out, "query_canonical")
    return out.filter("no_click_row_count > 0").withColumn("has_positive_click", F.col("positive_row_count") > 0)


def first_five(rows: DataFrame, column: str, name: str, key: str = "query_canonical") -> DataFrame:
    """(key, name): the five smallest distinct values of ``column``; ranks are limited before anything is collected."""
    ranked = rows.select(key, column).distinct().withColumn("_r", F.row_number().over(Window.partitionBy(key).orderBy(F.col(column).asc_nulls_last()))).filter("_r <= 5")
    return ranked.groupBy(key).agg(F.array_sort(F.collect_list(column)).alias(name))


def top_items(pairs: DataFrame, name: str, k: int = 10) -> DataFrame:
    """(query_canonical, name): ids of the k best items by evidence, clicks, id."""
    order = Window.partitionBy("query_canonical").orderBy(F.col("evidence_score").desc(), F.col("click_count").desc(), "sku_id")
    ranked = pairs.select("query_canonical", "sku_id", "evidence_score", "click_count").withColumn("_r", F.row_number().over(order)).filter(F.col("_r") <= k)
    listed = F.array_sort(F.collect_list(F.struct("_r", F.col("sku_id").cast("string").alias("id"))))
    return ranked.groupBy("query_canonical").agg(F.transform(listed, lambda x: x["id"]).alias(name))


def confidence(score: Column, total: Column) -> Column:
    """Share of all evidence within [0, 1]; a missing score gives 0."""
    return F.when(total > 0, F.least(F.lit(1.0), F.greatest(F.lit(0.0), score / total))).otherwise(F.lit(0.0))


def quality(t: QualityThresholds) -> Column:
    return (
        F.when(F.col("dominant_category_id").isNull(), "low_confidence")
        .when((F.col("category_confidence") >= t.high) & (F.col("click_count") >= t.high_min_clicks), "high_confidence")
        .when(F.col("category_confidence") >= t.medium, "medium_confidence")
        .otherwise("low_confidence")
    )


FLAGS = ("has_digits", "has_latin", "has_cyrillic", "is_mixed_language", "has_dictionary_brand", "has_dictionary_product_family")


def query_dataset(pairs: DataFrame, mapping: DataFrame, no_click: DataFrame, thresholds: QualityThresholds = QualityThresholds()) -> DataFrame:
    """One row per query: totals, dominant category and brand with confidence over all evidence, variants, flags, quality, eligibility.

    ``pairs`` is read three times; persist or store it first on large inputs.
    """
    totals = pairs.groupBy("query_canonical").agg(
        F.sum("click_count").alias("click_count"), F.count(F.lit(1)).alias("unique_sku_count"), F.round(F.sum("evidence_score"), SCORE_DIGITS).alias("total_evidence_score")
    ).join(top_items(pairs, "top_skus"), "query_canonical")
    category = top_label(pairs, "category_id", "category_score", {"dominant_category": "category_name", "category_path": "category_path"}).withColumnRenamed("category_id", "dominant_category_id")
    brand = top_label(pairs, "brand", "brand_score").withColumnRenamed("brand", "dominant_brand")
    named = mapping.filter("query_canonical <> ''")
    variants = named.groupBy("query_canonical").agg(*[F.bool_or(c).alias(c) for c in FLAGS])
    variants = variants.join(first_five(named, "query_original", "query_original_examples"), "query_canonical").join(first_five(named, "query_normalized", "query_normalized_variants"), "query_canonical")
    joined = totals.join(variants, "query_canonical").join(category, "query_canonical", "left").join(brand, "query_canonical", "left").join(no_click.select("query_canonical", "no_click_row_count"), "query_canonical", "left")
    text = F.col("query_canonical")
    sized = joined.withColumns({
        "query_length_chars": F.length(text),
        "query_length_words": F.when(text == "", 0).otherwise(F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit(""))) + 1),
        "no_click_count": F.coalesce("no_click_row_count", F.lit(0)),
        "category_confidence": F.round(confidence(F.col("category_score"), F.col("total_evidence_score")), SCORE_DIGITS),
        "brand_confidence": F.round(confidence(F.col("brand_score"), F.col("total_evidence_score")), SCORE_DIGITS),
    }).drop("no_click_row_count")
    eligible = F.col("dominant_category_id").isNotNull() & (F.col("category_confidence") >= thresholds.medium) & F.col("query_length_words").between(1, thresholds.max_words) & (F.col("query_length_chars") <= thresholds.max_chars)
    return sized.withColumn("quality", quality(thresholds)).withColumn("is_training_eligible", eligible)


def rejects(clicks: DataFrame, mapping: DataFrame, catalog: DataFrame, dataset: DataFrame, policy: ClickPolicy = ClickPolicy(), t: QualityThresholds = QualityThresholds()) -> DataFrame:
    """Rows and queries left out, with counts and the reason."""
    named = clicks.join(mapping.select("query_original", "query_canonical"), "query_original")
    missing = named.filter(is_click(policy)).filter("query_canonical <> ''").join(catalog.select("sku_id"), "sku_id", "left_anti").groupBy("query_canonical", "sku_id").agg(F.count(F.lit(1)).alias("row_count")).withColumn("reason", F.lit("sku_not_found"))
    empty = named.filter("query_canonical = ''").agg(F.count(F.lit(1)).alias("row_count")).filter("row_count > 0").select(F.lit("").alias("query_canonical"), F.lit(None).cast("bigint").alias("sku_id"), "row_count", F.lit("empty_after_normalization").alias("reason"))
    reason = F.when((F.col("query_length_words") > t.max_words) | (F.col("query_length_chars") > t.max_chars), "outlier_query_length").when(F.col("dominant_category_id").isNull(), "category_not_found").otherwise("ambiguous_category")
    low = dataset.filter(~F.col("is_training_eligible")).select("query_canonical", F.lit(None).cast("bigint").alias("sku_id"), F.col("click_count").alias("row_count"), reason.alias("reason"))
    columns = ["query_canonical", "sku_id", "row_count", "reason"]
    return missing.select(columns).unionByName(empty.select(columns)).unionByName(low.select(columns))


def purity(labelled: DataFrame, key: str, label: str, min_rows: int = 5) -> DataFrame:
    """Share of the commonest label per key, over rows with a label; ties to the smaller label. Keys below ``min_rows`` are left out."""
    counted = labelled.filter(F.col(label).isNotNull()).groupBy(key, label).agg(F.count(F.lit(1)).alias("n"))
    best = counted.groupBy(key).agg(F.sum("n").alias("n_rows"), F.max("n").alias("top"), F.min(F.struct((-F.col("n")).alias("a"), F.col(label).alias("b")))["b"].alias("top_label"))
    return best.filter(F.col("n_rows") >= min_rows).select(key, "top_label", "n_rows", F.round(F.col("top") / F.col("n_rows"), 6).alias("purity"))
