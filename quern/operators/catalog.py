"""Catalog trees to flat tables: items, attributes, materialized category paths."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions.text import log_normalize

MAX_DEPTH = 20


def category_paths(categories: DataFrame, max_depth: int = MAX_DEPTH) -> DataFrame:
    """id, path (names from the root joined by ' > ', empty ones skipped), depth. ``categories`` has id, parent_id, name.

    A missing or own parent ends the path. Paths double in length each round, so a tree of any practical depth takes a few joins; a longer
    cycle ends after the last of them.
    """
    own = F.when(F.col("parent_id") != F.col("id"), F.col("parent_id"))
    up = categories.select("id", own.alias("above"), F.coalesce("name", F.lit("")).alias("path"), F.lit(1).alias("depth"))
    reach = 1
    while reach < max_depth:
        up = up.persist()  # both sides of the next round
        top = up.select(F.col("id").alias("above"), F.col("above").alias("next"), F.col("path").alias("upper"), F.col("depth").alias("more"))
        up = up.join(top, "above", "left").select("id", F.col("next").alias("above"), F.concat_ws(" > ", F.nullif("upper", F.lit("")), F.nullif("path", F.lit(""))).alias("path"), (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"))
        reach *= 2
    return up.select("id", "path", "depth")


def split_values(c: Column, by: str = "/") -> Column:
    """Parts of a multi-valued attribute, trimmed, without empty ones."""
    return F.filter(F.transform(F.split(c, by), lambda x: F.trim(x)), lambda x: x != "")


def flatten_items(offers: DataFrame, paths: DataFrame, categories: DataFrame) -> DataFrame:
    """One row per offer: its first category with name and path, normalized name and brand. ``offers`` has sku_id, name, brand, model, category_ids (array), available."""
    base = offers.withColumn("category_id", F.coalesce(F.try_element_at("category_ids", F.lit(1)).cast("string"), F.lit("")))
    named = base.join(categories.select(F.col("id").cast("string").alias("category_id"), F.col("name").alias("category_name")), "category_id", "left").join(paths.select(F.col("id").cast("string").alias("category_id"), F.col("path").alias("category_path")), "category_id", "left")
    return named.select("sku_id", F.col("name").alias("catalog_sku_name"), log_normalize(F.col("name")).alias("catalog_sku_name_normalized"), F.col("brand").alias("catalog_brand_original"), log_normalize(F.col("brand")).alias("brand"), "model", "category_id", "category_name", "category_path", "available")


def flatten_attributes(offers: DataFrame, suffix: str = "_search") -> DataFrame:
    """One row per searchable attribute value. ``offers`` has sku_id, params (array<struct<name,value,unit>>)."""
    each = offers.select("sku_id", F.explode("params").alias("p")).filter(F.endswith(F.col("p.name"), F.lit(suffix)))
    name = F.substring(F.col("p.name"), F.lit(1), F.length("p.name") - len(suffix))
    return each.select("sku_id", name.alias("attribute_name_original"), log_normalize(name).alias("attribute_name"), F.explode(split_values(F.col("p.value"))).alias("attribute_value_original"), F.col("p.unit").alias("unit")).withColumn("attribute_value", log_normalize(F.col("attribute_value_original")))
