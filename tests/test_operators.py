from __future__ import annotations

from pyspark.sql import functions as F

from quern.operators import annotate, colors, evaluation, match, split
from quern.sources import readers, sinks
from quern.streaming.annotate import normalize_stream


def test_greedy_never_overlaps(spark):
    spans = [("brand", 0, 5, 0.9), ("category", 3, 9, 0.95), ("color", 5, 9, 0.9), ("color", 5, 9, 0.9)]
    df = spark.createDataFrame([([(t, s, e, c, "x") for t, s, e, c in spans],)], "s array<struct<type:string,start:int,end:int,confidence:double,source:string>>")
    taken, lost = match.greedy(F.col("s"), match.fact_rank())
    row = df.select(taken.alias("t"), lost.alias("l")).first()
    assert [x["type"] for x in row["t"]] == ["brand", "color"] and len(row["l"]) == 2


def test_spans_of_tags(spark):
    row = spark.createDataFrame([(["B-A", "I-A", "O", "I-B", "B-A", "B-A"],)], "t array<string>").select(evaluation.spans_of(F.col("t")).alias("s")).first()
    assert [tuple(x) for x in row["s"]] == [("A", 0, 2), ("B", 3, 4), ("A", 4, 5), ("A", 5, 6)]


def test_stopwords_protect(spark):
    made = annotate.stopwords(F.col("t"))
    row = spark.createDataFrame([("пылесос без мешка до 30000",)], "t string").select(made["search_text"].alias("s"), F.size(made["removed"]).alias("n")).first()
    assert row["s"] == "пылесос без мешка до 30000" and row["n"] == 0


def test_annotation_invariants(spark):
    words = spark.createDataFrame([("samsung", "brand", "b", "samsung", 9, "catalog"), ("телевизор", "category", "c", "телевизор", 5, "catalog"), ("синий", "color", "blue", "синий", 3, "catalog")], "pattern string, entity_type string, entity_id string, canonical string, count int, source string")
    rows = spark.createDataFrame([(1, 'телевизор Samsung темно-синий 55"'), (2, None), (3, "x" * 2001)], "id int, text string")
    out = {r["id"]: r for r in annotate.annotate(rows, "id", "text", words, 3).collect()}
    assert set(out) == {1, 2} and annotate.quarantine(rows, "text").count() == 1
    r = out[1]
    assert [e["type"] for e in r["entities"]] == ["category", "brand", "color", "screen_diagonal"]
    assert all(r["query_model"][e["start"] : e["end"]] == e["surface"] for e in r["entities"])
    assert len(r["tokens"]) == len(r["bio_tags"]) == len(r["bio_mask"]) and all((t != "O") == m for t, m in zip(r["bio_tags"], r["bio_mask"], strict=True))
    assert out[2]["warnings"] == ["empty_query"] and out[2]["facts"] == []


def test_color_dictionary(spark):
    values = spark.createDataFrame([("Темно-синий", 4), ("темно синий", 2), ("непонятно", 9)], "v string, n int")
    row = colors.color_dictionary(values, "v", "n", colors.seed_aliases(spark)).filter("catalog_count > 0").collect()
    assert [(r["normalized"], r["color_id"], r["catalog_count"]) for r in row] == [("темно синий", "blue", 6)]


def test_shards_are_even(spark):
    n = split.round_robin_shard(spark.range(100).withColumnRenamed("id", "k"), "k", 3).groupBy("shard").count().collect()
    assert sorted(r["count"] for r in n) == [33, 33, 34]


def test_sources_and_sinks(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "surface string, n int")
    sinks.csv(df, str(tmp_path / "c"))
    assert {r["surface"] for r in readers.csv_dictionary(spark, str(tmp_path / "c")).collect()} == {"a", "b"}
    sinks.parquet(df, str(tmp_path / "p"), "n")
    assert readers.shards(spark, str(tmp_path / "p")).count() == 2 and sinks.manifest(str(tmp_path / "p"), spark).count() >= 2
    sinks.json_lines(spark.createDataFrame([(["a"], ["O"])], "tokens array<string>, tags array<string>"), str(tmp_path / "j"))
    assert readers.examples(spark, str(tmp_path / "j"), 1).first()["tags"] == ["O"]
    (tmp_path / "x.xml").write_text('<c><offer id="1" available="true"><name>n</name><vendor>v</vendor><categoryId>7</categoryId><param name="Color_search">red/blue</param></offer></c>')
    row = readers.catalog_xml(spark, str(tmp_path / "x.xml")).first()
    assert row["sku_id"] == 1 and row["category_ids"] == ["7"] and row["params"][0]["value"] == "red/blue"
    assert readers.missing_sources(spark, [str(tmp_path / "p"), str(tmp_path / "none")]) == [str(tmp_path / "none")]
    assert "<td>a</td>" in sinks.html_report("t", {"x": df}) and sinks.metrics(df.agg(F.sum("n").alias("s")))["s"] == 3


def test_stream_equals_batch(spark, tmp_path):
    rows = spark.createDataFrame([("Самсунг S24 55 дюймов",)], "q string")
    rows.write.parquet(str(tmp_path / "in"))
    stream = normalize_stream(spark.readStream.schema("q string").parquet(str(tmp_path / "in")), "q")
    job = stream.writeStream.format("memory").queryName("annotated").trigger(availableNow=True).start()
    job.awaitTermination(60)
    assert spark.table("annotated").collect() == normalize_stream(rows, "q").collect()
