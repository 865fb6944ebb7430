"""Quality rules with suffix-array repetition.

The base rules count words, symbols, repeated lines and repeated five-word windows. The method builds a suffix array over the words
of each text; its longest-common-prefix intervals are the maximal repeated substrings. Their spans are united, and limits are put on
the fraction of characters they cover and on the longest of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm.common import WordHashes, binary, holds, table, windows, word_hashes

WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
LEAST = 3  # words of a repeat; shorter than the base's windows, so phrases that the base can't see count as well
MAX_COVERED = 0.15  # of the characters in words
MAX_LONGEST = 50, 0.10  # words, and fraction of all words; a longest repeat beyond both fails

SCHEMA = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, covered_fraction double, longest_repeat long, n_maximal_repeats long, kept boolean"


def suffix_array(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array of ``ids`` and the common prefix of each suffix with the one before it (0 for the first), by prefix doubling."""
    n = len(ids)
    rank = np.unique(ids, return_inverse=True)[1].astype(np.int64) + 1
    levels, step = [rank], 1
    while rank.max() < n and step < n:
        second = np.zeros(n, dtype=np.int64)
        second[: n - step] = rank[step:]
        rank = np.unique(rank * (n + 1) + second, return_inverse=True)[1].astype(np.int64) + 1
        levels.append(rank)
        step *= 2
    order = np.argsort(rank, kind="stable")
    lcp = np.zeros(n, dtype=np.int64)
    if n > 1:
        i, j, got = order[:-1].copy(), order[1:].copy(), np.zeros(n - 1, dtype=np.int64)
        for k in range(len(levels) - 1, -1, -1):
            inside = np.maximum(i, j) < n
            same = inside.copy()
            same[inside] = levels[k][i[inside]] == levels[k][j[inside]]
            # equal ranks at a level mean 2**k equal words, unless a suffix ends first, which the ranks tell apart
            got[same] += 1 << k
            i[same] += 1 << k
            j[same] += 1 << k
        lcp[1:] = got
    return order, lcp


def lcp_intervals(order: np.ndarray, lcp: np.ndarray, ids: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """(length, first, last) of the intervals of the suffix array that are maximal repeats of ``least`` words or more.

    An interval can't be widened on the right by its construction; on the left it can't if two of its suffixes follow different words.
    """
    mixed, found, stack = -2, [], []
    before = np.where(order > 0, ids[order - 1], -1).tolist()
    for at, value in enumerate([*lcp.tolist()[1:], 0]):
        left, word = at, before[at]
        while stack and stack[-1][0] > value:
            length, left, seen = stack.pop()
            word = word if word == seen else mixed
            if length >= least and word == mixed:
                found.append((length, left, at))
        if stack and stack[-1][0] == value:
            stack[-1][2] = word if word == stack[-1][2] else mixed
        elif value:
            stack.append([value, left, word])
    return found


def repetition(h: np.ndarray, chars: np.ndarray, least: int = LEAST) -> tuple[float, int, int]:
    """Covered fraction of the characters, longest repeat in words, number of maximal repeats."""
    ids = np.unique(h, return_inverse=True)[1]
    order, lcp = suffix_array(ids)
    intervals = lcp_intervals(order, lcp, ids, least)
    if not intervals:
        return 0.0, 0, 0
    # the widest repeat at each start is the larger of its two neighbouring prefixes: their union is that of all intervals
    reach = np.maximum(lcp, np.append(lcp[1:], 0))
    reach[reach < least] = 0
    edge = np.zeros(len(h) + 1, dtype=np.int64)
    np.add.at(edge, order, reach > 0)
    np.add.at(edge, order + reach, -(reach > 0).astype(np.int64))
    covered = np.cumsum(edge[:-1]) > 0
    return float(chars[covered].sum() / max(1, chars.sum())), int(lcp.max()), len(intervals)


def measure(cache: WordHashes, raw: bytes | None) -> tuple:
    """The columns after doc_id for one text."""
    raw = raw or b""
    words = raw.split()
    n = len(words)
    spaces = raw.translate(None, b" \t\n\r\x0b\x0c")
    word_chars = len(spaces.decode("utf-8", "replace"))
    symbols = len(raw) - len(raw.translate(None, b"#*$%&|<>"))
    lines = [x for x in raw.split(b"\n") if x.split(None, 1)] if n else []
    h = word_hashes(cache, words)
    win, repeated = windows(h, WINDOW), 0
    if len(win):
        _, back, count = np.unique(win, return_inverse=True, return_counts=True)
        twice = count[back] > 1
        if twice.any():
            edge = np.zeros(n + 1, dtype=np.int64)
            edge[: len(win)] += twice
            edge[WINDOW : WINDOW + len(win)] -= twice
            repeated = int((np.cumsum(edge[:-1]) > 0).sum())
    failed = n < MIN_WORDS or 100 * repeated > MAX_REPEAT_PERCENT * n
    covered, longest, intervals = 0.0, 0, 0
    if n > LEAST and len(np.unique(windows(h, LEAST))) < n - LEAST + 1:  # without a repeated window no repeat of that many words exists
        chars = np.fromiter((len(w.decode("utf-8", "replace")) for w in words), dtype=np.int64, count=n)
        covered, longest, intervals = repetition(h, chars)
    good = covered <= MAX_COVERED and longest <= max(MAX_LONGEST[0], MAX_LONGEST[1] * n)
    return n, word_chars, symbols, len(lines) - len(set(lines)), repeated, failed, covered, longest, intervals, not failed and good


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row with the base counts, the repetition figures and ``kept``.

    A null or blank text has no words, fails the base rules and is not kept. Repeated rows and null ids keep their rows; other
    columns are ignored; an empty table gives an empty result. Texts are measured whole, one at a time.
    """
    fields = [x.split()[0] for x in SCHEMA.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = WordHashes()
        kinds = [pa.int64()] * 5 + [pa.bool_(), pa.float64(), pa.int64(), pa.int64(), pa.bool_()]
        for batch in batches:
            rows = [measure(cache, t) for t in binary(batch.column(1))]
            columns = list(zip(*rows, strict=True)) or [[]] * len(kinds)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], names=fields)

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, SCHEMA)


def op7_quality_rules(spark, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"))


def drop_rejected(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows that ``quality_rules`` keeps, all columns as they are; nothing is shuffled, and only texts go to Python."""

    def setup():
        cache = WordHashes()
        return lambda text: measure(cache, text)[-1]

    return docs.filter(holds(F.col(text_col).cast("string"), setup))
