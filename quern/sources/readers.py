"""Sources: Parquet logs, nested catalogs (JSON, XML), JSON and CSV dictionaries, JSONL examples, sharded tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUERY_COLUMNS = ("query_text", "query_original", "query_canonical")
#: Columns of the raw click log.
LOG_COLUMNS = {"sku_id": "sku_id", "log_sku_name": "toValidUTF8(sku_name)", "log_brand": "toValidUTF8(sku_brand_name)", "price": "sku_price", "sku_subject_id": "sku_subject_id", "sku_seo_id": "sku_seo_id", "query_original": "toValidUTF8(query_text)", "position": "sku_position"}
OFFER = "sku_id bigint, name string, brand string, model string, category_ids array<string>, available boolean, params array<struct<name:string,value:string,unit:string>>"
EXAMPLE = "tokens array<string>, tags array<string>"


def missing_sources(spark: SparkSession, paths: list[str]) -> list[str]:
    """The paths that no store holds; all of them at once, before any work begins."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    return [p for p in paths if not (at := jvm.org.apache.hadoop.fs.Path(p)).getFileSystem(conf).exists(at)]


def require(spark: SparkSession, paths: list[str]) -> None:
    if gone := missing_sources(spark, paths):
        raise FileNotFoundError("missing sources: " + ", ".join(gone))


def click_log(spark: SparkSession, path: str, columns: dict[str, str] | None = None) -> DataFrame:
    from quern.operators.clicks import scan_clicks

    return scan_clicks(spark.read.parquet(path), columns or LOG_COLUMNS)


def query_column(df: DataFrame) -> str:
    """The first known query column, else the only column."""
    found = next((c for c in QUERY_COLUMNS if c in df.columns), df.columns[0] if len(df.columns) == 1 else None)
    if found is None:
        raise ValueError(f"no query column among {df.columns}")
    return found


def catalog_json(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(OFFER).json(path)


def catalog_xml(spark: SparkSession, path: str) -> DataFrame:
    """Offers of a catalog file; single elements read as lists of one. Pickled catalogs aren't read: unpickling runs their code."""
    one = T.StructType([T.StructField("_name", T.StringType()), T.StructField("_unit", T.StringType()), T.StructField("_VALUE", T.StringType())])
    schema = T.StructType([T.StructField("_id", T.LongType()), T.StructField("_available", T.BooleanType()), T.StructField("name", T.StringType()), T.StructField("vendor", T.StringType()), T.StructField("model", T.StringType()), T.StructField("categoryId", T.ArrayType(T.StringType())), T.StructField("param", T.ArrayType(one))])
    raw = spark.read.format("xml").option("rowTag", "offer").schema(schema).load(path)
    params = F.transform(F.coalesce("param", F.array().cast("array<struct<_name:string,_unit:string,_VALUE:string>>")), lambda p: F.struct(p["_name"].alias("name"), p["_VALUE"].alias("value"), p["_unit"].alias("unit")))
    return raw.select(F.col("_id").alias("sku_id"), "name", F.col("vendor").alias("brand"), "model", F.col("categoryId").alias("category_ids"), F.col("_available").alias("available"), params.alias("params"))


def json_dictionary(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    reader = spark.read.option("multiLine", True)
    return (reader.schema(schema) if schema else reader).json(path)


def csv_dictionary(spark: SparkSession, path: str, active_only: bool = True) -> DataFrame:
    """A CSV dictionary, with or without byte-order mark; rows marked inactive are left out."""
    df = spark.read.option("header", True).csv(path)
    df = df.toDF(*[c.lstrip("﻿") for c in df.columns])
    return df.filter(F.lower("active").isin("1", "true", "yes")) if active_only and "active" in df.columns else df


def tsv(spark: SparkSession, path: str, null: str = "\\N") -> DataFrame:
    return spark.read.option("header", True).option("sep", "\t").option("nullValue", null).csv(path)


def examples(spark: SparkSession, path: str, limit: int | None = None) -> DataFrame:
    df = spark.read.schema(EXAMPLE).json(path)
    return df.limit(limit) if limit is not None else df


def shards(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(folder)
