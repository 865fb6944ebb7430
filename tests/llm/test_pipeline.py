from __future__ import annotations

import os

import pytest

import corpus_pipeline
from quern.llm.registry import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    sizes = [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        made = stage(spark, docs, SF)
        if name != "mixing":
            assert made.columns == docs.columns and [f.dataType for f in made.schema] == [f.dataType for f in docs.schema]
        made.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        sizes.append(docs.count())
    assert sizes == sorted(sizes, reverse=True) and sizes[1] < sizes[0] and sizes[4] < sizes[3]


def test_ten_queries():
    assert sorted(int(q[2:].split("_")[0]) for q in QUERIES if q.startswith("op")) == list(range(1, 11)) and set(ORACLES) <= set(QUERIES)
