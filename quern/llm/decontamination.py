"""Benchmark decontamination by template windows.

Texts are canonicalised: case and punctuation go, numbers, units and names become typed placeholders. Windows of template words are hashed
and joined with those of the benchmark, each in several forms, for capitals at the start of a sentence or line tell no names: as the
sentences stand, with capitalised words as names everywhere, and with names nowhere, or word by word where few words are literal. Around
a match the run grows over all words that agree in any form. Matches on one alignment form runs; a run of ``need`` words, or a whole shorter item, counts if its
slots are consistent: within the run, equal values of the item stand for equal values of the text. Where slots clash, the longest part
without a clash counts as a run. So re-parameterised questions are
caught, and texts that share a template by chance with clashing values are not.

The benchmark side of the join is broadcast while its windows are at most BROADCAST_WINDOWS; a larger one is joined by shuffle.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm.common import CACHE_WORDS, binary, holds, once, table, windows

WINDOW = 8
NEED = 13
LITERALS = 4  # words of a window that must not be placeholders
BROADCAST_WINDOWS = 1_000_000  # about 100 MB in each worker at most

NUMBER = re.compile(r"[+-]?[$€£]?\d[\d.,:/]*%?$")
#: Unit words.
UNITS = frozenset("km m cm mm kg g mg t l ml cl s sec min h hr hrs mph kmh kph ft in yd mi lb lbs oz gal eur usd gbp hours minutes seconds days weeks months years meters metres kilometers kilometres centimeters miles feet inches grams kilograms pounds liters litres dollars euros cents percent degrees".split())
EDGE = re.compile(r"^[^\w$€£+-]+|[^\w%]+$")
SENTENCE_END = re.compile(r"[.!?:;]\W*$")
BREAK = b"\x00"


MARKS, END_MARKS = b".,:;!?", b".:;!?"
INSIDE, FIRST, ENDS, VOID = 1, 2, 4, 8  # literal within a sentence, or at the start of one; ends a sentence; no word: a line break, or punctuation alone


def properties(raw: bytes) -> tuple[str, str, str, int]:
    """The value of a word, its template word inside a sentence and at the start of one, and its flags."""
    body = raw if raw[-1] not in MARKS else raw[:-1]
    if body.isalpha():  # ASCII letters, and one mark at most: no pattern to look for
        core, flags = body.decode(), ENDS if raw[-1] in END_MARKS else 0
        low = core.lower()
        plain = "<unit>" if low in UNITS else low
    else:
        text = raw.decode("utf-8", "replace")
        plainly = text.isalnum()  # no punctuation to look at
        core = text if plainly else EDGE.sub("", text)
        low = core.lower()
        plain = "<unit>" if low in UNITS else low
        if not core.isalpha() and NUMBER.match(core):
            plain = "<num>"
        flags = 0 if plainly else (ENDS if raw == BREAK or SENTENCE_END.search(text) else 0) | (VOID if raw == BREAK or not core else 0)
    inside = plain
    if plain == low and len(core) > 1 and core[0].isupper() and core[1:].islower():
        inside = "<name>"
    return low, inside, plain, flags | (inside[:1] != "<" and INSIDE) | (plain[:1] != "<" and FIRST)


class Vocabulary(dict):
    """Raw word to a row of its properties; starts afresh when full. Rows are written to the arrays by ``settle``, many at once."""

    def __init__(self, rows: int = CACHE_WORDS):
        super().__init__()
        self.rows = rows
        self._reset()

    def _reset(self) -> None:
        self.clear()
        self.words: list[bytes] = []  # without their properties, of which few are asked for: tuples of them would keep the garbage collector busy
        self.new: list[int] = []  # the hashes and flags of the rows to settle
        self.inside = np.zeros(self.rows + 1, dtype=np.uint64)  # hash of its template within a sentence
        self.first = np.zeros(self.rows + 1, dtype=np.uint64)  # and at the start of one
        self.exact = np.zeros(self.rows + 1, dtype=np.uint64)  # of the word itself
        self.flags = np.zeros(self.rows + 1, dtype=np.uint8)

    def __missing__(self, raw: bytes) -> int:
        if len(self.words) > self.rows:
            raise OverflowError
        at = self[raw] = len(self.words)
        self.words.append(raw)
        low, inside, plain, flags = properties(raw)
        first = xxhash.xxh3_64_intdigest(plain)
        self.new += (first if inside is plain else xxhash.xxh3_64_intdigest(inside)), first, first if plain is low else xxhash.xxh3_64_intdigest(low), flags
        return at

    def settle(self) -> None:
        if self.new:
            rows = np.array(self.new, dtype=np.uint64).reshape(-1, 4)
            at = slice(len(self.words) - len(rows), len(self.words))
            self.inside[at], self.first[at], self.exact[at], self.flags[at] = rows.T
            self.new = []


class Template:
    """Template of a text: its words, the hash of each template word, and where literals stand."""

    def __init__(self, vocabulary: Vocabulary | None, text: bytes | None):
        raw = (text or b"").replace(BREAK, b" ").replace(b"\n", b" \x00 ").split()
        if vocabulary is None or len(raw) > CACHE_WORDS:
            vocabulary = Vocabulary(len(raw))
        elif len(vocabulary) + len(raw) > CACHE_WORDS:  # else a text could outgrow the rows that it has begun to use
            vocabulary._reset()
        ids = np.fromiter(map(vocabulary.__getitem__, raw), dtype=np.int64, count=len(raw))
        vocabulary.settle()
        flags = vocabulary.flags[ids]
        start = np.ones(len(ids), dtype=bool)
        start[1:] = flags[:-1] & ENDS != 0
        keep = flags & VOID == 0
        # after dropped tokens, a start mark still reaches the next word
        if len(ids):
            last = np.maximum.accumulate(np.where(start, np.arange(len(ids)), -1))
            prior = np.maximum.accumulate(np.where(keep, np.arange(len(ids)), -1))
            before = np.append([-1], prior[:-1])
            start = last > before
        self.vocabulary, self.ids, self.start = vocabulary, ids[keep], start[keep]

    def __len__(self) -> int:
        return len(self.ids)

    def word(self, i: int) -> tuple[str, str, str, bool]:
        """The value at i, its template word inside a sentence and at the start of one, and whether it stands at a start."""
        return *properties(self.vocabulary.words[self.ids[i]])[:3], self.start[i]

    def hashes(self, width: int, exact: bool = True) -> np.ndarray:
        """Window hashes in four forms: as sentences stand, names everywhere, names nowhere, the words themselves (left out unless ``exact``)."""
        v = self.vocabulary
        inside, first = v.inside[self.ids], v.first[self.ids]
        return windows(np.stack([np.where(self.start, first, inside), inside, first, *([v.exact[self.ids]] if exact else [])]), width)

    def usable(self, width: int) -> np.ndarray:
        """By form, whether a window tells enough; the words themselves stand in for windows with few literals."""
        n = max(len(self) - width + 1, 0)
        flags = self.vocabulary.flags[self.ids]
        inside, first = flags & INSIDE != 0, flags & FIRST != 0
        sums = np.zeros((3, len(self) + 1), dtype=np.int64)
        np.cumsum(np.stack([np.where(self.start, first, inside), inside, first]), axis=1, out=sums[:, 1:])
        enough = sums[:, width : width + n] - sums[:, :n] >= min(LITERALS, width)
        return np.concatenate([enough, ~enough[2:]])


def width_of(n: int) -> int:
    """Window width for an item of n template words; items of fewer than LITERALS words are too short to tell."""
    return min(WINDOW, n) if n >= LITERALS else 0


def item_windows(items: list[tuple[int, bytes | None]]) -> tuple[dict[int, dict[int, list[tuple[int, int]]]], set[int]]:
    """By width: window hash to the (item, position) pairs it stands at; and the widths of windows that go by the words themselves.

    At other widths the words themselves of a text find nothing that its form without names doesn't.
    """
    vocabulary, found, exact = Vocabulary(), defaultdict(lambda: defaultdict(list)), set()
    for item, text in items:
        t = Template(vocabulary, text)
        if width := width_of(len(t)):
            usable = t.usable(width)
            if usable[3].any():
                exact.add(width)
            for at, forms in enumerate(t.hashes(width).T.tolist()):
                for h in {h for h, tells in zip(forms, usable[:, at], strict=True) if tells}:
                    found[width][h].append((item, at))
    return {w: dict(x) for w, x in found.items()}, exact


def agree(here: tuple[str, str, str, bool], asked: tuple[str, str, str, bool]) -> str | None:
    """The kind of slot, or the literal, as which two words agree; None if they don't. Of two words at starts neither tells a name."""
    if here[2] == asked[2] and here[2][:1] == "<":
        return here[2]
    if here[1] == asked[1] == "<name>" and not (here[3] and asked[3]):
        return here[1]
    return here[0] if here[0] == asked[0] else None


def consistent(doc: Template, item: Template, at: int, to: int, n: int) -> tuple[int, int, int]:
    """The longest part of the run without clashing slots, as (words, first word, changed slots); the first of equally long ones."""
    stands: dict[tuple[str, str], tuple[str, int]] = {}
    best, begin, changed = (0, at), 0, []
    for i in range(n):
        here, asked = doc.word(at + i), item.word(to + i)
        value, kind = here[0], agree(here, asked)
        changed.append(value != asked[0])
        if kind is None:
            begin = i + 1
        elif kind[:1] == "<":
            other, last = stands.get((kind, asked[0]), (value, -1))
            if other != value:
                begin = max(begin, last + 1)
            stands[kind, asked[0]] = value, i
        if i + 1 - begin > best[0]:
            best = i + 1 - begin, at + begin
    words, first = best
    return words, first, sum(changed[first - at : first - at + words])


def matches(doc: Template, hits: list[tuple[int, int, int, int]], item_of) -> dict[int, tuple[int, int, int]]:
    """Per item the longest consistent run as (words, first word, changed slots). hits: (item, its position, position here, width)."""
    lines: dict[tuple[int, int], set[tuple[int, int]]] = defaultdict(set)
    for item, to, at, width in hits:
        lines[item, at - to].add((at, width))
    found: dict[int, tuple[int, int, int]] = {}
    for (item, shift), spots in lines.items():
        other, end = item_of(item), -1
        first, last = max(shift, 0), min(len(doc), len(other) + shift)
        for at, width in sorted(spots):
            if at + width <= end:
                continue
            begin, end = at, at + width
            while begin > first and agree(doc.word(begin - 1), other.word(begin - 1 - shift)) is not None:
                begin -= 1
            while end < last and agree(doc.word(end), other.word(end - shift)) is not None:
                end += 1
            least = max(min(NEED, len(other)), found.get(item, (0,))[0] + 1)
            if end - begin >= least:
                part = consistent(doc, other, begin, begin - shift, end - begin)
                if part[0] >= least:
                    found[item] = part
    return found


class Matcher:
    """Finds the items of a broadcast benchmark in a text."""

    def __init__(self, items: list[tuple[int, bytes | None]], vocabulary: Vocabulary | None = None):
        self.vocabulary, self.made = vocabulary or Vocabulary(), {}
        self.names, self.texts = [item for item, _ in items], [text for _, text in items]
        self.index, self.exact = item_windows(list(enumerate(self.texts)))  # by row, for rows may share an item's id
        self.bits = {}
        for width, found in self.index.items():
            size = 1 << min(22, max(10, (64 * len(found)).bit_length()))
            bits = np.zeros(size, dtype=bool)
            bits[np.fromiter(found, dtype=np.uint64, count=len(found)) & np.uint64(size - 1)] = True
            self.bits[width] = bits

    def item(self, row: int) -> Template:
        if row not in self.made:
            self.made[row] = Template(None, self.texts[row])
        return self.made[row]

    def find(self, text: bytes | None) -> dict[int, tuple[int, int, int]]:
        """By item id: the longest run, then the first, then the one with fewest changed slots."""
        doc, hits = Template(self.vocabulary, text), []
        for width, found in self.index.items():
            h, bits = doc.hashes(width, width in self.exact), self.bits[width]
            for form, at in np.argwhere(bits[h & np.uint64(len(bits) - 1)]).tolist():
                hits += [(row, to, at, width) for row, to in found.get(int(h[form, at]), ())]
        best: dict[int, tuple[int, int, int]] = {}
        for row, run in (matches(doc, hits, self.item) if hits else {}).items():
            name = self.names[row]
            if name not in best or (-run[0], *run[1:]) < (-best[name][0], *best[name][1:]):
                best[name] = run
        return best


RESULT = "doc_id long, item_id long, first_word long, n_words long, n_changed long"
NAMES = [x.split()[0] for x in RESULT.split(", ")]


def _rows(out: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*out, strict=True)) or [[]] * 5
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=NAMES)


def _fits(benchmark: DataFrame, text_col: str) -> bool:
    words = benchmark.agg(F.coalesce(F.sum(F.octet_length(F.col(text_col).cast("string"))), F.lit(0))).first()[0] / 2
    return words * 3 <= BROADCAST_WINDOWS  # a window has up to three forms


def _asked(benchmark: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return benchmark.select(F.col(id_col).cast("long").alias("item_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("asked")).filter("item_id IS NOT NULL")


def _matcher(asked: DataFrame):
    """The distinct items as a broadcast, at most BROADCAST_WINDOWS of windows."""
    return asked.sparkSession.sparkContext.broadcast(sorted((r[0], r[1].encode()) for r in asked.distinct().collect()))


def _pairs(docs: DataFrame, asked: DataFrame) -> DataFrame:
    """(key, item_id, asked) of the texts, by their ``key``, and items that share a window: windows meet in a hash join, texts stay behind."""

    def widths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary()
        for batch in batches:
            found = {width_of(len(Template(vocabulary, t))) for t in binary(batch.column(0))} - {0}
            yield pa.RecordBatch.from_arrays([pa.array(sorted(found), pa.int64())], names=["w"])

    present = sorted(r.w for r in asked.select("asked").mapInArrow(widths, "w long").distinct().collect())  # WINDOW values at most

    def cuts(own: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            vocabulary = Vocabulary()
            for batch in batches:
                rows, found = [], []
                for at, text in enumerate(binary(batch.column(1))):
                    t = Template(vocabulary, text)
                    for w in [width_of(len(t))] if own else present:
                        if w:
                            h = np.unique(t.hashes(w)[t.usable(w)])
                            found.append(h.view(np.int64))
                            rows.append(np.full(len(h), at))
                at = pa.array(np.concatenate(rows) if rows else np.empty(0, np.int64), pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column(0).take(at), pa.array(np.concatenate(found) if found else np.empty(0, np.int64), pa.int64())], names=["key", "h"])

        return run

    one = asked.withColumn("row", F.struct("item_id", F.xxhash64("asked").alias("t")))
    theirs = one.select("row", "asked").distinct().mapInArrow(cuts(True), "key struct<item_id:long,t:long>, h long").toDF("row", "h")
    mine = docs.select("key", "text").mapInArrow(cuts(False), "key struct<a:long,b:long>, h long")
    met = mine.join(theirs, "h").select("key", "row").distinct()
    return met.join(one.select("row", "item_id", "asked").distinct(), "row").select("key", "item_id", "asked")


def _by_shuffle(docs: DataFrame, asked: DataFrame) -> DataFrame:
    """The same result for a benchmark too large to broadcast. Equal texts are one text until the end, so rows are told by their text, not their id."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, last = Vocabulary(), (None, None)
        for batch in batches:
            out = []
            for key, text, item, words in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if last[0] != (item, words):
                    last = (item, words), Matcher([(item, words.encode())], vocabulary)
                out += [(*key.values(), k, *run) for k, run in last[1].find(text.encode()).items()]
            columns = list(zip(*out, strict=True)) or [[]] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["a", "b", "item_id", "n_words", "first_word", "n_changed"])

    keyed = docs.withColumn("key", F.struct(F.xxhash64("text").alias("a"), F.xxhash64(F.lit(1), "text").alias("b")))
    pairs = _pairs(keyed, asked)
    texts = keyed.join(pairs.select("key").distinct(), "key", "left_semi").groupBy("key").agg(F.first("text").alias("text"))
    full = pairs.join(texts, "key").select("key", "text", "item_id", "asked").sortWithinPartitions("item_id", "asked")
    runs = full.mapInArrow(check, "a long, b long, item_id long, n_words long, first_word long, n_changed long")
    best = runs.groupBy("a", "b", "item_id").agg(F.min(F.struct((-F.col("n_words")).alias("n"), "first_word", "n_changed")).alias("m"))
    met = keyed.select("doc_id", "key").join(best, (F.col("key.a") == best.a) & (F.col("key.b") == best.b))
    return met.select("doc_id", "item_id", "m.first_word", (-F.col("m.n")).alias("n_words"), "m.n_changed")


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", broadcast: bool | None = None) -> DataFrame:
    """One row per document and benchmark item found in it: doc_id, item_id, first_word, n_words (of the longest consistent run), n_changed (slots whose value differs from the item's).

    Documents without a row are clean. Null or blank texts and items, and items of fewer than four template words, match nothing; items with a
    null id are left out; a null document id keeps its rows. Repeated documents repeat their rows; of items with one id the longest run counts. Other columns are ignored. Either table may be empty.
    """
    lean = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    asked = _asked(benchmark, item_col, item_text_col)
    if not (broadcast if broadcast is not None else _fits(asked, "asked")):
        return _by_shuffle(lean, asked)
    items = _matcher(asked)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = once(items.value, Matcher)
        for batch in batches:
            yield _rows([(doc, item, first, n, changed) for doc, text in zip(batch.column(0).to_pylist(), binary(batch.column(1)), strict=True) for item, (n, first, changed) in matcher.find(text).items()])

    return lean.mapInArrow(run, RESULT)


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", broadcast: bool | None = None) -> DataFrame:
    """The rows in whose text no benchmark item is found, all columns kept; a row's id plays no part. Nulls and repeats as in ``contaminated``.

    With a broadcast benchmark only texts go to Python and nothing is shuffled; with a larger one, texts that are found leave by an anti join.
    """
    asked = _asked(benchmark, "item_id", "text")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    if not (broadcast if broadcast is not None else _fits(asked, "asked")):
        found = _by_shuffle(docs.select(text.alias("text")).distinct().withColumn("doc_id", F.xxhash64("text")), asked).select(F.col("doc_id").alias("__found")).distinct()
        return docs.join(found, F.xxhash64(text) == F.col("__found"), "left_anti")
    items = _matcher(asked)

    def setup():
        matcher = once(items.value, Matcher)
        return lambda t: not matcher.find(t)

    return docs.filter(holds(text, setup))


def op2_decontamination(spark, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
