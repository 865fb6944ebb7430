"""Entity-level precision, recall and F1, overall, by type and by slice."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def spans_of(tags: Column) -> Column:
    """array<struct<type,start,end>> of BIO tags; an I- without a B- before it begins a span."""
    empty = F.array().cast("array<struct<type:string,start:int,end:int>>")

    def step(acc: Column, t: Column) -> Column:
        out, kind = acc["out"], F.substring(t, 3, 1000)
        last = F.try_element_at(out, F.lit(-1))
        grows = t.startswith("I-") & (F.size(out) > 0) & (last["end"] == acc["i"]) & (last["type"] == kind)
        longer = F.concat(F.slice(out, 1, F.greatest(F.size(out) - 1, F.lit(0))), F.array(F.struct(last["type"].alias("type"), last["start"].alias("start"), (acc["i"] + 1).alias("end"))))
        new = F.concat(out, F.array(F.struct(kind.alias("type"), acc["i"].alias("start"), (acc["i"] + 1).alias("end"))))
        return F.struct((acc["i"] + 1).alias("i"), F.when(t == "O", out).when(grows, longer).otherwise(new).alias("out"))

    return F.aggregate(tags, F.struct(F.lit(0).alias("i"), empty.alias("out")), step, lambda acc: acc["out"])


def span_scores(gold: DataFrame, predicted: DataFrame, keys: list[str], by: list[str] | None = None) -> DataFrame:
    """tp, n_gold, n_predicted, precision, recall, f1 of two span tables, matched on ``keys``; per ``by`` columns, else overall."""
    by = by or []
    both = gold.select(*keys).distinct().withColumn("_g", F.lit(1)).join(predicted.select(*keys).distinct().withColumn("_p", F.lit(1)), keys, "full_outer")
    sums = both.groupBy(*by).agg(F.count_if(F.col("_g").isNotNull() & F.col("_p").isNotNull()).alias("tp"), F.count("_g").alias("n_gold"), F.count("_p").alias("n_predicted"))
    ratio = lambda a, b: F.when(b == 0, 0.0).otherwise(F.round(a / b, 6))
    return sums.withColumns({"precision": ratio(F.col("tp"), F.col("n_predicted")), "recall": ratio(F.col("tp"), F.col("n_gold")), "f1": ratio(2 * F.col("tp"), F.col("n_gold") + F.col("n_predicted"))})


def tag_scores(gold: DataFrame, predicted: DataFrame, key: str, tokens: str, tags: str, by_type: bool = False) -> DataFrame:
    """Scores of BIO predictions; examples whose tokens differ are left out."""
    both = gold.select(key, F.col(tokens).alias("t"), F.col(tags).alias("g")).join(predicted.select(key, F.col(tokens).alias("u"), F.col(tags).alias("p")), key).filter(F.col("t") == F.col("u"))
    side = lambda c: both.select(key, F.explode(spans_of(F.col(c))).alias("s")).select(key, "s.type", "s.start", "s.end")
    return span_scores(side("g"), side("p"), [key, "type", "start", "end"], ["type"] if by_type else None)


def diagnostics(train: DataFrame, valid: DataFrame, query: str, tags: str) -> DataFrame:
    """(metric, name, value): tag counts, examples by number of entities, repeated queries and those that both parts hold."""
    part = lambda df, name: df.select(F.lit(name).alias("part"), query, tags)
    rows = part(train, "train").union(part(valid, "valid"))
    by_tag = rows.select("part", F.explode(tags).alias("tag")).groupBy("part", "tag").agg(F.count(F.lit(1)).alias("value")).select(F.concat("part", F.lit("_tag")).alias("metric"), F.col("tag").alias("name"), "value")
    n = F.size(F.filter(tags, lambda t: t.startswith("B-")))
    by_size = rows.groupBy("part", n.cast("string").alias("name")).agg(F.count(F.lit(1)).alias("value")).select(F.concat("part", F.lit("_entities")).alias("metric"), "name", "value")
    held = rows.groupBy(query).agg(F.count_if(F.col("part") == "train").alias("t"), F.count_if(F.col("part") == "valid").alias("v"))
    sums = held.agg(F.sum(F.greatest(F.col("t") - 1, F.lit(0))).alias("a"), F.sum(F.greatest(F.col("v") - 1, F.lit(0))).alias("b"), F.count_if((F.col("t") > 0) & (F.col("v") > 0)).alias("c"))
    three = F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.lit("all").alias("name"), F.coalesce(F.col(c), F.lit(0)).cast("long").alias("value")) for m, c in (("train_repeated", "a"), ("valid_repeated", "b"), ("in_both", "c"))])).alias("x")
    return by_tag.union(by_size).union(sums.select(three).select("x.*"))


def predict(queries: DataFrame, tokens: str, model, schema: str) -> DataFrame:
    """Batched inference: ``model()`` is called once a worker and gives a function from a list of token lists to a list of tag lists."""

    def run(frames):
        tag = model()
        for frame in frames:
            yield frame.assign(tags=tag([list(t) for t in frame[tokens]]))

    return queries.mapInPandas(run, schema)


def latencies(f, inputs: list, warm: int = 3) -> dict[str, float]:
    """Milliseconds p50 and p95 of ``f`` on single inputs, after ``warm`` calls that don't count."""
    import time

    for x in inputs[:warm]:
        f(x)
    took = []
    for x in inputs:
        begin = time.perf_counter()
        f(x)
        took.append(1000 * (time.perf_counter() - begin))
    took.sort()
    at = lambda q: took[min(len(took) - 1, int(q * len(took)))] if took else 0.0
    return {"p50": at(0.50), "p95": at(0.95)}
