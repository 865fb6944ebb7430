"""Mixing sources to target weights by the cube method.

A source whose target is r times its size takes every document floor(r) times and, with probability r - floor(r), once more. The extra
copies are drawn by the cube method: inclusion probabilities move along the null space of the balancing constraints (words and documents
of the source) until they reach 0 or 1. Sources are dealt into blocks by a hash, each block leaves at most two fractional documents, and
those go through further flights until each source has a small landing problem, which is solved by trying all its outcomes.
"""

from __future__ import annotations

import math
import random

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm.common import cut, table

BLOCK = 4096  # documents in a block of the flight, about
LANDING = 10  # documents of each source kept for the landing, with the two that a flight may leave
MAX_COPIES = 3
NEAR = 1e-9
MAX_SOURCES = 100_000  # rows of the table of sources that go to the driver and to every task
WORD = r"[^\x20\x09-\x0D]+"


def targets(sizes: list[tuple[str | None, int]], weights: tuple[float, ...] = (1, 2, 3), most: int = MAX_COPIES) -> list[float]:
    """Targets of sources given in order: shares of all sizes by weight, none above ``most`` times its size, the excess shared anew."""
    total, weight = float(sum(n for _, n in sizes)), [weights[i % len(weights)] for i in range(len(sizes))]
    out, open_ = [0.0] * len(sizes), list(range(len(sizes)))
    left = total
    while open_:
        share = left / sum(weight[i] for i in open_)
        over = [i for i in open_ if share * weight[i] > most * sizes[i][1]]
        if not over:
            for i in open_:
                out[i] = share * weight[i]
            break
        for i in over:
            out[i] = float(most * sizes[i][1])
            left -= out[i]
        open_ = [i for i in open_ if i not in set(over)]
    return out


def fly(size: list[float], pi: list[float], seed: str) -> list[float]:
    """The flight phase: moves ``pi`` until at most two values are fractional, keeping sum(pi) and sum(pi * size)."""
    r = random.Random(seed)
    pi = [0.0 if p < NEAR else 1.0 if p > 1 - NEAR else p for p in pi]
    waiting = iter([i for i, p in enumerate(pi) if 0 < p < 1])
    active: list[int] = []
    while True:
        active = [i for i in active if 0 < pi[i] < 1]
        while len(active) < 3 and (i := next(waiting, None)) is not None:
            active.append(i)
        if len(active) < 3:
            same = len(active) == 2 and size[active[0]] == size[active[1]]
            if not same:
                return pi
        a, b = active[0], active[1]
        c = active[2] if len(active) == 3 else None
        u = [(a, 1.0), (b, -1.0)] if c is None or size[a] == size[b] else [(a, size[b] - size[c]), (b, size[c] - size[a]), (c, size[a] - size[b])]
        up = min((1 - pi[i]) / d if d > 0 else pi[i] / -d for i, d in u if d)
        down = min(pi[i] / d if d > 0 else (1 - pi[i]) / -d for i, d in u if d)
        step = up if r.random() * (up + down) < down else -down
        for i, d in u:
            p = pi[i] + step * d
            pi[i] = 0.0 if p < NEAR else 1.0 if p > 1 - NEAR else p


def land(size: list[float], pi: list[float]) -> list[float]:
    """Round the last fractional values: of all outcomes, the one nearest in words, then in documents."""
    free = [i for i, p in enumerate(pi) if 0 < p < 1]
    if not free:
        return list(pi)
    outcomes = (np.arange(1 << len(free))[:, None] >> np.arange(len(free))) & 1
    off = outcomes - np.array([pi[i] for i in free])
    best = np.lexsort((np.abs(off.sum(axis=1)).round(6), np.abs(off @ np.array([size[i] for i in free])).round(6)))[0]
    out = list(pi)
    for k, i in enumerate(free):
        out[i] = float(outcomes[best, k])
    return out


def _flight(last: bool):
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["size", "h", "doc_id"], ascending=[False, True, True], kind="stable")
        size, pi = rows["size"].astype(float).tolist(), rows["pi"].tolist()
        if not last:
            return rows.assign(pi=fly(size, pi, f"{key}"))
        # some documents of all sizes wait for the landing
        free = [i for i, p in enumerate(pi) if 0 < p < 1]
        held = set(free[:: max(1, -(-len(free) // LANDING))])
        rest = [i for i in range(len(pi)) if i not in held]
        for i, p in zip(rest, fly([size[i] for i in rest], [pi[i] for i in rest], f"{key}"), strict=True):
            pi[i] = p
        return rows.assign(pi=land(size, pi))

    return run


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[float, ...] = (1, 2, 3), block: int = BLOCK) -> DataFrame:
    """One row per input row: id, source, size, source_size, target, copies, taken.

    size is the number of words (a null or blank text: 0), taken = copies * size. A null source is a source of its own, last in order.
    Null ids and repeated rows are rows like others. A source of blank texts has target 0. Other columns are ignored; an empty table
    gives an empty result. The draw depends on ids, texts and sources alone, so reruns agree. Only (id, source, size) is shuffled; a
    source with a third of all rows is dealt into blocks. One row per source, at most MAX_SOURCES, goes to the driver.
    """
    spark = docs.sparkSession
    words = F.coalesce(F.regexp_count(F.col(text_col).cast("string"), F.lit(WORD)), F.lit(0)).cast("long")
    rows = cut(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"), words.alias("size"), F.xxhash64(F.col(text_col).cast("string")).alias("t")))
    totals = [(r.source, r.n, r.rows) for r in rows.groupBy("source").agg(F.sum("size").alias("n"), F.count(F.lit(1)).alias("rows")).limit(MAX_SOURCES + 1).collect()]
    if len(totals) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources; group them first")
    totals.sort(key=lambda t: (t[0] is None, t[0] or ""))
    goal = targets([(s, n) for s, n, _ in totals], weights)
    plan = []
    for i, ((source, n, count), t) in enumerate(zip(totals, goal, strict=True)):
        ratio = t / n if n else 0.0
        whole = min(MAX_COPIES, math.floor(ratio + NEAR))
        pi = max(0.0, min(1.0, ratio - whole)) if whole < MAX_COPIES else 0.0
        plan.append((i, source, n, t, whole, pi if pi > NEAR else 0.0, max(1, -(-count // block))))
    known = F.broadcast(spark.createDataFrame(plan, "s int, name string, source_size long, target double, whole int, pi double, blocks long"))
    placed = rows.join(known, rows.source.eqNullSafe(known.name)).select("s", "doc_id", "source", "size", "source_size", "target", "whole", "pi", "blocks", F.xxhash64("doc_id", "t").alias("h"))

    schema = "s int, doc_id long, source string, size long, source_size long, target double, whole int, pi double, blocks long, h long"
    # a blank document has nothing to take; a source that is taken whole has nothing to draw
    settled = placed.filter("pi = 0 OR size = 0").withColumn("pi", F.lit(0.0))
    flying, done, rounds = placed.filter("pi > 0 AND size > 0"), [settled], 0
    while True:
        most = max((p[6] for p in plan if p[5]), default=0)
        if not most:
            break
        last = most == 1
        flown = cut(flying.groupBy("s", F.pmod("h", "blocks").alias("at")).applyInPandas(_flight(last), schema))
        if last:
            done.append(flown)
            break
        done.append(flown.filter("pi = 0 OR pi = 1"))
        left = dict(flown.filter("pi > 0 AND pi < 1").groupBy("s").count().collect())  # one row a source at most
        plan = [(*p[:6], max(1, -(-left.get(p[0], 0) // block)) if p[0] in left else 1) for p in plan]
        if not left:
            break
        fewer = F.broadcast(spark.createDataFrame([(p[0], p[6]) for p in plan], "s int, fewer long"))
        rounds += 1
        flying = flown.filter("pi > 0 AND pi < 1").join(fewer, "s").withColumn("blocks", F.col("fewer")).withColumn("h", F.xxhash64("h", F.lit(rounds))).select(*[c.split()[0] for c in schema.split(", ")])
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more.select(out.columns))
    copies = F.col("whole") + F.col("pi").cast("int")
    return out.select("doc_id", "source", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).cast("long").alias("taken"))


def op5_mixing(spark, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"))
