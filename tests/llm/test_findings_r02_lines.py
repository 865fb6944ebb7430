"""Cases of the findings FINDINGS_r02.md on the cost of line deduplication."""

from __future__ import annotations

import random

from quern.llm import line_dedup


def words(r, n: int) -> str:
    return " ".join("".join(r.choice("abcdefghijklmnop") for _ in range(r.randint(3, 7))) for _ in range(n))


def test_f2_lines_that_share_a_phrase_only_are_not_tried(spark, monkeypatch):
    r = random.Random(7)
    lines = []
    for _ in range(40):
        phrase = words(r, 9)[:18]
        lines += [f"{words(r, 15)} {phrase} {words(r, 15)}" for _ in range(6)]
    lines.append(lines[0][:-1] + "#")
    tried = []
    links = line_dedup._Checker.links

    def counted(self, pairs, *a, **k):
        tried.append(pairs.count())
        return links(self, pairs, *a, **k)

    monkeypatch.setattr(line_dedup._Checker, "links", counted)
    out = line_dedup.dedup_lines(spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string"))
    assert [x["doc_id"] for x in out.filter("n_dropped > 0").collect()] == [240]
    assert sum(tried) == 1


def test_f2_alike_lines_of_unlike_length_share_a_key(spark):
    """A line that has a part twice is as long as lines with keys of long runs, and like one that had only keys of short ones."""
    r = random.Random(9)
    lines = []
    for n in range(34, 60):
        line = (words(r, 20))[:n].strip()
        lines += [line, line[:-2] + line[3:-2]]
    sets = [{x[i : i + 5] for i in range(len(x) - 4)} for x in lines]
    rows = line_dedup._dealt(spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string"), "doc_id", "text").collect()
    keys = [{x["key"] for x in rows if x["doc_id"] == i} - {None} for i in range(len(lines))]
    alike = [i for i in range(0, len(lines), 2) if 5 * len(sets[i] & sets[i + 1]) >= 4 * len(sets[i] | sets[i + 1])]
    assert len(alike) > 15 and all(keys[i] & keys[i + 1] for i in alike)
