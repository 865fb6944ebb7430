"""Cases of the findings FINDINGS_r02.md."""

from __future__ import annotations

import random
from pathlib import Path

from quern.llm import line_dedup, near_dedup
from quern.llm.common import FREED, cut, stored


def left(spark) -> dict[Path, int]:
    """Shuffle files that lie in the folders of this session, beyond those of a few sums."""
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {p: size for folder in folders for p in Path(folder.getPath()).rglob("shuffle_*.data") if (size := p.stat().st_size) > 200}


def texts(spark, rows: int = 60):
    r = random.Random(3)
    line = lambda n: " ".join("".join(r.choice("abcdefgh") for _ in range(r.randint(2, 7))) for _ in range(n))
    lines = [line(12) for _ in range(20)]
    return spark.createDataFrame([(i, "\n".join([r.choice(lines) + r.choice(("", " x", " y")), line(9)])) for i in range(rows)], "doc_id long, text string")


def test_f1_tables_and_shuffle_files_go_when_they_are_done_with(spark):
    shared = Path(spark.conf.get("spark.checkpoint.dir"))
    files, tables = left(spark).keys(), set(shared.iterdir())
    out = line_dedup.dedup_lines(texts(spark))
    assert not left(spark).keys() - files
    assert not {p.name for p in set(shared.iterdir()) - tables if any(p.glob("*.parquet"))}
    assert out.count() == 60 and out.filter("n_dropped > 0").count() > 20
    assert spark.conf.get(FREED, None) in (None, "false")


def test_f1_a_frame_can_be_cut_and_used_again(spark):
    df = texts(spark).groupBy("text").count()
    want = sorted(map(tuple, df.collect()))
    for again in (cut(df), stored(df, "again"), df, cut(df)):
        assert sorted(map(tuple, again.collect())) == want


def test_f3_bound_on_distinct_runs_of_a_line_that_repeats_itself(spark):
    lines = ["of " * 500, "eationnt " * 90, "these words are all there is and none stands here twice"]
    got = line_dedup._bitmaps(spark.createDataFrame(list(enumerate(lines)), "id long, line string")).collect()
    assert {x["id"]: x["runs"] for x in got} == {0: 3, 1: 9, 2: len(lines[2]) - 4}


def test_near_dedup_leaves_no_shuffle_files(spark):
    files = left(spark).keys()
    out = near_dedup.near_duplicates(texts(spark), shingle=2)
    assert not left(spark).keys() - files
    assert out.count() == 60
