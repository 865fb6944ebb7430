"""Cases of the findings FINDINGS_r02.md on what components leave behind."""

from __future__ import annotations

import random
from pathlib import Path

import pytest

from quern.llm import components


@pytest.mark.parametrize("small", (0, 200_000))
def test_f1_components_leave_only_their_last_round(spark, monkeypatch, small):
    monkeypatch.setattr(components, "SMALL", small)
    r = random.Random(8)
    edges = [(i, i + 1) for i in range(100, 160)] + [(r.randrange(1000, 1400), r.randrange(1000, 1400)) for _ in range(150)]
    root = {x: x for e in edges for x in e if e[0] != e[1]}
    for _ in root:
        for a, b in edges:
            if a != b:
                root[a] = root[b] = min(root[a], root[b])
    shared = Path(spark.conf.get("spark.checkpoint.dir"))
    before = set(shared.rglob("rdd-*"))
    got = {x["id"]: x["component"] for x in components.components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    assert got == root
    assert len([p for p in set(shared.rglob("rdd-*")) - before if p.is_dir()]) == 1
