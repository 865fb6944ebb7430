"""Cases of the findings FINDINGS_r02.md on growth and cost."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from quern.llm import line_dedup


def line(r, words: int) -> list[str]:
    return ["".join(r.choice("abcdefghijklmnop") for _ in range(r.randint(3, 7))) for _ in range(words)]


def edited(r, words: list[str], n: int) -> str:
    out = list(words)
    for i in r.sample(range(len(out)), n):
        out[i] = line(r, 1)[0]
    return " ".join(out)


def runs(text: str) -> set[str]:
    return {text[i : i + 5] for i in range(max(len(text) - 4, 1))}


def test_f1_f4_a_large_group_of_near_copies_is_not_met_pair_by_pair(spark, monkeypatch):
    r = random.Random(5)
    base = line(r, 60)
    texts = [edited(r, base, r.choice((1, 2, 2, 3))) for _ in range(300)]
    tried = []
    links = line_dedup._Checker.links

    def counted(self, pairs, *a, **k):
        tried.append(pairs.count())
        return links(self, pairs, *a, **k)

    monkeypatch.setattr(line_dedup._Checker, "links", counted)
    out = line_dedup.dedup_lines(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    group, left = {0}, set(range(1, len(texts)))  # by all pairs
    sets, fresh = [runs(t) for t in texts], [0]
    while fresh:
        a = sets[fresh.pop()]
        near = {b for b in left if 5 * len(a & sets[b]) >= 4 * len(a | sets[b])}
        left, group = left - near, group | near
        fresh += near
    assert out.filter("n_dropped > 0").count() == len(group) - 1 and len(group) > 200
    assert sum(tried) < 10 * len(texts), tried


def test_f1_f4_sketches_of_long_lines_tell_unlike_ones(spark):
    r = random.Random(6)
    base = line(r, 150)
    texts = [" ".join(base), *(edited(r, base, n) for n in (2, 5, 8, 11, 14, 17, 20, 23, 26, 29, 32))]
    made = line_dedup._bitmaps(spark.createDataFrame(list(enumerate(texts)), "id long, line string"))
    x, y = made.alias("x"), made.alias("y")
    got = {(a, b) for a, b in x.join(y, (F.col("x.id") < F.col("y.id")) & line_dedup._possible(80)).select("x.id", "y.id").collect()}
    share = {(a, b): len(runs(texts[a]) & runs(texts[b])) / len(runs(texts[a]) | runs(texts[b])) for a in range(12) for b in range(a + 1, 12)}
    assert {p for p, s in share.items() if s >= 0.8} <= got
    assert all(share[p] > 0.7 for p in got)
