"""Click-log, catalog and dictionary views over the driver's tables, as DataFrames and as the same SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.operators import clicks as ck


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def clicks(s, d) -> DataFrame:
    return table(s, d, "lineitem").select(F.concat(F.lit("O-"), F.col("l_orderkey").cast("string")).alias("query_original"), F.col("l_partkey").alias("sku_id"), F.col("l_extendedprice").alias("price"), (F.col("l_linenumber") - 1).alias("position"))


def mapping(s, d) -> DataFrame:
    k = F.col("l_orderkey")
    canonical = F.when(k % 97 == 0, "").otherwise(F.concat(F.lit("o "), F.floor(k / 3).cast("string")))
    return table(s, d, "lineitem").select("l_orderkey").distinct().select(
        F.concat(F.lit("O-"), k.cast("string")).alias("query_original"), F.concat(F.lit("o "), k.cast("string")).alias("query_normalized"), canonical.alias("query_canonical"),
        F.lit(True).alias("has_digits"), F.lit(True).alias("has_latin"), F.lit(False).alias("has_cyrillic"), F.lit(False).alias("is_mixed_language"), (k % 5 == 0).alias("has_dictionary_brand"), (k % 7 == 0).alias("has_dictionary_product_family"),
    )


def catalog(s, d) -> DataFrame:
    p = F.col("p_partkey")
    return table(s, d, "part").filter(p % 20 != 0).select(
        p.alias("sku_id"), F.col("p_name").alias("sku_name"), F.when(p % 13 == 0, "").otherwise(F.lower("p_brand")).alias("brand"), F.when(p % 17 == 0, "").otherwise(F.col("p_type")).alias("category_id"), F.col("p_type").alias("category_name"), F.concat(F.lit("root > "), F.col("p_type")).alias("category_path"), F.concat(F.lit("m"), (p % 50).cast("string")).alias("model"),
    )


def pairs(s, d) -> DataFrame:
    return ck.pair_evidence(clicks(s, d), mapping(s, d), catalog(s, d))


def dataset(s, d) -> DataFrame:
    made = pairs(s, d).persist()
    return ck.query_dataset(made, mapping(s, d), ck.no_click_queries(clicks(s, d), mapping(s, d)))


CLICKS = """
clicks AS (SELECT 'O-' || l_orderkey AS query_original, l_partkey AS sku_id, l_extendedprice AS price, l_linenumber - 1 AS position FROM lineitem),
mapping AS (SELECT 'O-' || k AS query_original, 'o ' || k AS query_normalized, CASE WHEN k % 97 = 0 THEN '' ELSE 'o ' || (k // 3) END AS query_canonical, k % 5 = 0 AS has_dictionary_brand, k % 7 = 0 AS has_dictionary_product_family FROM (SELECT DISTINCT l_orderkey AS k FROM lineitem)),
catalog AS (SELECT p_partkey AS sku_id, p_name AS sku_name, CASE WHEN p_partkey % 13 = 0 THEN '' ELSE lower(p_brand) END AS brand, CASE WHEN p_partkey % 17 = 0 THEN '' ELSE p_type END AS category_id, p_type AS category_name, 'root > ' || p_type AS category_path, 'm' || (p_partkey % 50) AS model FROM part WHERE p_partkey % 20 <> 0)"""

PAIRS = CLICKS + """,
exact AS (SELECT query_canonical, query_original, sku_id, price, position, count(*) AS n FROM clicks JOIN mapping USING (query_original) WHERE position > 0 AND query_canonical <> '' GROUP BY ALL),
pairs AS (SELECT query_canonical, sku_id, sum(n)::BIGINT AS click_count, count(*) AS exact_group_count, min(position) AS min_position, median(position) AS median_position, avg(position) AS mean_position,
    round(sum(n / log2(least(position, 100) + 2)), 9) AS evidence_score, min(price) AS min_price, median(price) AS median_price, max(price) AS max_price, any_value(sku_name) AS sku_name, any_value(brand) AS brand, any_value(category_id) AS category_id, any_value(category_name) AS category_name, any_value(category_path) AS category_path, any_value(model) AS model
    FROM exact JOIN catalog USING (sku_id) GROUP BY query_canonical, sku_id)"""

NO_CLICK = """,
variants AS (SELECT query_canonical, query_normalized, query_original, count(*) FILTER (WHERE position = 0) AS no_click_row_count, count(*) FILTER (WHERE position > 0) AS positive_row_count FROM clicks JOIN mapping USING (query_original) WHERE query_canonical <> '' GROUP BY ALL),
no_click AS (SELECT query_canonical, list_slice(list(DISTINCT query_original ORDER BY query_original), 1, 5) AS query_original_examples, list_slice(list(DISTINCT query_normalized ORDER BY query_normalized), 1, 5) AS query_normalized_variants, sum(no_click_row_count)::BIGINT AS no_click_row_count, sum(positive_row_count)::BIGINT AS positive_row_count, sum(positive_row_count) > 0 AS has_positive_click FROM variants WHERE no_click_row_count > 0 GROUP BY query_canonical)"""

DATASET = PAIRS + NO_CLICK + """,
totals AS (SELECT query_canonical, sum(click_count)::BIGINT AS click_count, count(*) AS unique_sku_count, round(sum(evidence_score), 9) AS total_evidence_score, list_slice(list(CAST(sku_id AS VARCHAR) ORDER BY evidence_score DESC, click_count DESC, sku_id), 1, 10) AS top_skus FROM pairs GROUP BY 1),
cat AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_canonical ORDER BY category_score DESC, category_id) AS r FROM (SELECT query_canonical, category_id, round(sum(evidence_score), 9) AS category_score FROM pairs WHERE category_id <> '' GROUP BY ALL)) WHERE r = 1),
br AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_canonical ORDER BY brand_score DESC, brand) AS r FROM (SELECT query_canonical, brand, round(sum(evidence_score), 9) AS brand_score FROM pairs WHERE brand <> '' GROUP BY ALL)) WHERE r = 1),
v AS (SELECT query_canonical, list_slice(list(DISTINCT query_original ORDER BY query_original), 1, 5) AS query_original_examples, bool_or(has_dictionary_brand) AS has_dictionary_brand, bool_or(has_dictionary_product_family) AS has_dictionary_product_family FROM mapping WHERE query_canonical <> '' GROUP BY 1),
combined AS (SELECT t.query_canonical, length(t.query_canonical) AS query_length_chars, length(t.query_canonical) - length(replace(t.query_canonical, ' ', '')) + 1 AS query_length_words, v.query_original_examples, v.has_dictionary_brand, v.has_dictionary_product_family, t.click_count, coalesce(no_click.no_click_row_count, 0) AS no_click_count, t.unique_sku_count, t.top_skus, cat.category_id AS dominant_category_id, cat.category_score,
    round(CASE WHEN t.total_evidence_score > 0 THEN least(1.0, greatest(0.0, cat.category_score / t.total_evidence_score)) ELSE 0 END, 9) AS category_confidence, br.brand AS dominant_brand, br.brand_score,
    round(CASE WHEN t.total_evidence_score > 0 THEN least(1.0, greatest(0.0, br.brand_score / t.total_evidence_score)) ELSE 0 END, 9) AS brand_confidence, t.total_evidence_score
    FROM totals t JOIN v USING (query_canonical) LEFT JOIN cat USING (query_canonical) LEFT JOIN br USING (query_canonical) LEFT JOIN no_click USING (query_canonical)),
dataset AS (SELECT *, CASE WHEN dominant_category_id IS NULL THEN 'low_confidence' WHEN category_confidence >= 0.8 AND click_count >= 3 THEN 'high_confidence' WHEN category_confidence >= 0.6 THEN 'medium_confidence' ELSE 'low_confidence' END AS quality,
    (dominant_category_id IS NOT NULL AND category_confidence >= 0.6 AND query_length_words BETWEEN 1 AND 20 AND query_length_chars <= 200) AS is_training_eligible FROM combined)"""

SPLIT = DATASET + """,
e AS (SELECT *, CASE WHEN click_count <= 2 THEN 'rare' WHEN click_count <= 20 THEN 'medium' ELSE 'popular' END AS fb, CASE WHEN query_length_words <= 2 THEN 'short' WHEN query_length_words <= 5 THEN 'middle' ELSE 'long' END AS lb, CASE WHEN has_dictionary_product_family THEN 'product_family' WHEN dominant_brand IS NOT NULL AND dominant_brand <> '' THEN 'category_and_brand' ELSE 'category_only' END AS eb FROM dataset WHERE is_training_eligible),
c AS (SELECT *, CASE WHEN count(*) OVER (PARTITION BY dominant_category_id) < 5 THEN 'other_rare' ELSE dominant_category_id END AS sc FROM e),
k AS (SELECT *, concat_ws('|', sc, fb, lb, eb, quality) AS k5, concat_ws('|', sc, fb, lb, eb) AS k4, concat_ws('|', sc, fb, lb) AS k3, concat_ws('|', sc, fb) AS k2, sc AS k1 FROM c),
n AS (SELECT *, count(*) OVER (PARTITION BY k5) AS n5, count(*) OVER (PARTITION BY k4) AS n4, count(*) OVER (PARTITION BY k3) AS n3, count(*) OVER (PARTITION BY k2) AS n2, count(*) OVER (PARTITION BY k1) AS n1 FROM k),
st AS (SELECT *, CASE WHEN n5 >= 5 THEN k5 WHEN n4 >= 5 THEN k4 WHEN n3 >= 5 THEN k3 WHEN n2 >= 5 THEN k2 WHEN n1 >= 5 THEN k1 ELSE 'other_rare' END AS stratum FROM n),
rk AS (SELECT *, row_number() OVER (PARTITION BY stratum ORDER BY md5(query_canonical || '|42')) AS r, count(*) OVER (PARTITION BY stratum) AS sz FROM st),
split AS (SELECT query_canonical, stratum, fb AS frequency_bucket, lb AS length_bucket, eb AS entity_bucket, CASE WHEN r <= greatest(1, floor(sz * 0.2)) THEN 'valid' ELSE 'train' END AS split FROM rk)"""


def dictionary(s, d) -> DataFrame:
    """First words of part names as brands, whole names as categories, second words as colors."""
    p = table(s, d, "part").select(F.lower("p_name").alias("name"))
    part = lambda kind, value: p.select(F.lit(kind).alias("entity_type"), value.alias("pattern")).groupBy("entity_type", "pattern").agg(F.count(F.lit(1)).alias("count"))
    rows = part("brand", F.split("name", " ")[0]).union(part("category", F.col("name"))).union(part("color", F.split("name", " ")[1]))
    return rows.select("pattern", "entity_type", F.col("pattern").alias("entity_id"), F.col("pattern").alias("canonical"), "count", F.lit("catalog").alias("source"))


DICTIONARY = """
p AS (SELECT p_partkey, lower(p_name) AS name, string_split(lower(p_name), ' ') AS w FROM part),
dictionary AS (SELECT 'brand' AS type, w[1] AS pattern, count(*) AS n FROM p GROUP BY 2 UNION ALL SELECT 'category', name, count(*) FROM p GROUP BY 2 UNION ALL SELECT 'color', w[2], count(*) FROM p GROUP BY 2),
grams AS (SELECT p_partkey, w[1] AS phrase, 0 AS start, length(w[1]) AS "end", 0 AS ts, 1 AS te FROM p UNION ALL SELECT p_partkey, w[2], length(w[1]) + 1, length(name), 1, 2 FROM p UNION ALL SELECT p_partkey, name, 0, length(name), 0, 2 FROM p),
matches AS (SELECT p_partkey, type, pattern AS value, phrase, start, "end", ts, te, CASE type WHEN 'brand' THEN 0.98 ELSE 0.94 END AS confidence FROM grams JOIN dictionary ON phrase = pattern)"""
