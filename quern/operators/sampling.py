"""Deterministic samples: hash order, weighted without replacement, quotas with refill, bucket priority, top-k per group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def hash_key(key: str, seed: int) -> Column:
    return F.md5(F.concat(F.col(key).cast("string"), F.lit(f"|{seed}")).cast("binary"))


def hash_sample(rows: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """The n rows first in hash order; TakeOrderedAndProject, no full sort."""
    return rows.orderBy(hash_key(key, seed), key).limit(n)


def unit_uniform(key: str, seed: int) -> Column:
    """A number in (0, 1) from the key's hash."""
    return (F.conv(F.substring(hash_key(key, seed), 1, 12), 16, 10).cast("double") + 0.5) / F.lit(float(16**12))


def weighted_sample(rows: DataFrame, key: str, weight: str, n: int, seed: int = 42) -> DataFrame:
    """n rows without replacement, probability by log1p(weight): the smallest -ln(u) / w."""
    w = F.log1p(F.greatest(F.col(weight).cast("double"), F.lit(0.0)))
    return rows.filter(w > 0).orderBy(-F.log(unit_uniform(key, seed)) / w, key).limit(n)


def top_per_group(rows: DataFrame, group: str, order: list, n: int) -> DataFrame:
    """The first n rows of each group; the rank filter is pushed below the exchange as a window group limit."""
    return rows.withColumn("_rank", F.row_number().over(Window.partitionBy(group).orderBy(*order))).filter(F.col("_rank") <= n).drop("_rank")


def quota_sample(rows: DataFrame, bucket: str, key: str, quotas: dict[str, int], total: int, seed: int = 42) -> DataFrame:
    """Up to a quota of each bucket in hash order, refilled from the rest to ``total``; adds refill."""
    quota = F.create_map(*[x for k, v in quotas.items() for x in (F.lit(k), F.lit(v))])
    ranked = rows.withColumn("_h", hash_key(key, seed)).withColumn("_rank", F.row_number().over(Window.partitionBy(bucket).orderBy("_h", key)))
    held = ranked.withColumn("refill", F.col("_rank") > F.coalesce(F.try_element_at(quota, F.col(bucket)), F.lit(0)))
    return held.orderBy("refill", "_h", key).limit(total).drop("_h", "_rank")


def first_bucket_wins(parts: list[tuple[str, DataFrame]], key: str) -> DataFrame:
    """Union of samples by bucket in priority order; a key that several hold counts for the first."""
    union = None
    for i, (name, part) in enumerate(parts):
        tagged = part.withColumns({"bucket": F.lit(name), "_priority": F.lit(i)})
        union = tagged if union is None else union.unionByName(tagged)
    return top_per_group(union, key, ["_priority"], 1).drop("_priority")
