"""Connected components by alternating large and small stars on an edge table; nothing is gathered on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm.common import cut, forget, shuffles_freed

SMALL = 200_000  # edges up to which a round runs in one task, without shuffles; more are dealt out


def _star(edges: DataFrame, large: bool, few: bool = False) -> DataFrame:
    """One star step. Hubs are met by a map-side partial minimum and a skew-splittable join, never by one group's list. ``few``: in one partition."""
    edge = lambda u, v: F.struct(F.col(u).alias("u"), F.col(v).alias("v"))
    one = lambda df: df.coalesce(1) if few else df  # noqa: E731  # said again after a join, for Spark forgets it there
    edges = one(edges)
    both = edges.select(F.inline(F.array(edge("u", "v"), edge("v", "u")))) if large else edges.select("u", "v")
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
    joined = one(both.join(least, "u"))
    if large:
        out = joined.filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = joined.select(F.inline(F.array(edge("v", "m"), edge("u", "m"))))
    return out.filter(F.col("u") != F.col("v")).select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def components(edges: DataFrame, a: str, b: str, max_rounds: int = 60) -> DataFrame:
    """(id, component) for every id on an edge; component is the smallest id reachable.

    Edges with a null end and loops are ignored; an empty edge table gives an empty result. Rounds grow with the logarithm of the longest path.
    """
    now = edges.filter(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
    now = cut(now.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct())

    def mark(df: DataFrame):
        with shuffles_freed(df.sparkSession):
            return df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

    before = mark(now)
    if before[0]:
        for _ in range(max_rounds):
            few = before[0] <= SMALL
            old, now = now, cut(_star(_star(now, True, few), False, few))
            forget(old)
            after = mark(now)
            if after == before:
                break
            before = after
        else:
            raise RuntimeError("components did not settle")
    return now.select(F.col("u").alias("id"), F.col("v").alias("component")).union(now.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())
