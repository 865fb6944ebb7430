"""Cases of the finding on near deduplication in FINDINGS_r02.md."""

from __future__ import annotations

import random

import numpy as np

from quern.llm import near_dedup


def test_f3_bitmaps_of_full_sets_never_drop_a_link():
    r = np.random.default_rng(4)
    base = r.integers(0, 1 << 63, 400, dtype=np.uint64)
    sets = [np.unique(np.concatenate([base[k:], r.integers(0, 1 << 63, k, dtype=np.uint64)])) for k in range(0, 120, 10)]
    bits = np.unpackbits(near_dedup.fine_sketches(sets).view(np.uint8), axis=1)
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            differing = int((bits[i] != bits[j]).sum())
            assert differing <= len(np.setxor1d(a, b))
            if len(np.intersect1d(a, b)) < 0.7 * len(np.union1d(a, b)):
                assert differing * 180 > (len(a) + len(b)) * 20


def test_f3_full_sets_are_dealt_only_of_texts_that_may_be_linked(spark, monkeypatch):
    r = random.Random(8)
    word = lambda: "".join(r.choice("abcdefghijklmnop") for _ in range(5))
    rows = []
    for _ in range(20):  # at 0.77, near enough for the samples, and a link
        base = [word() for _ in range(200)]
        rows += [base, [word() if i in (1, *range(8, 199, 16)) else w for i, w in enumerate(base)], [word() if i == 50 else w for i, w in enumerate(base)]]
    dealt, with_sets = [], near_dedup._with_sets

    def counted(live, sets):
        dealt.append(live.select("id").distinct().count())
        return with_sets(live, sets)

    monkeypatch.setattr(near_dedup, "_with_sets", counted)
    out = near_dedup.near_duplicates(spark.createDataFrame([(i, " ".join(x)) for i, x in enumerate(rows)], "doc_id long, text string"), shingle=2)
    sets = [{tuple(x[i : i + 2]) for i in range(199)} for x in rows]
    linked = lambda a, b: 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])
    want = sum(linked(i - 1, i) or linked(i - 2, i) for i in range(2, 60, 3)) + sum(linked(i - 1, i) for i in range(1, 60, 3))
    assert out.filter("NOT kept").count() == want == 20
    assert sum(dealt) < 10
