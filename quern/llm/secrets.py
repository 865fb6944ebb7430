"""Secret scans: base patterns, and formats learned by grammar inference.

Labelled credentials of each format form a prefix tree over character classes. States whose outgoing and final frequencies are
statistically compatible (Hoeffding bound, tested down both subtrees) are merged, which turns the tree into a probabilistic
automaton. Every candidate run of credential characters, and every part of it between separators, is scored by each automaton: the log
likelihood of its format, less that of ordinary text. The best spans above the margin are added to those of the base patterns.
"""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm.common import table

#: The base patterns.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"[0-9a-f]{32,}")
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{16,}")  # LEAST characters
SEPARATOR = re.compile(r"[=/_-]")  # characters of credentials that can also stand beside one
BASE_KINDS = "assign", "access", "hex"

LABELLED_PER_FORMAT = 200  # the documented bound on labelled credentials of each format
ALPHA = 0.05  # confidence of the merge test
LEAST = 16  # characters of a candidate
MARGIN_BITS = 24.0  # a candidate is at least 2**24 times likelier as a credential than as ordinary text

#: Character classes, smallest first. A format's symbols are the smallest class that covers its letters and digits, other characters as
#: they are, and at places where its examples show few characters (prefixes) each character as it is.
DIGITS, LOWER, UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
CLASSES = tuple(map(frozenset, (DIGITS, DIGITS + "abcdef", DIGITS + "ABCDEF", DIGITS + LOWER, DIGITS + UPPER, DIGITS + LOWER + UPPER, DIGITS + LOWER + UPPER + "+/")))
FEW = 3

#: Bits of each character in ordinary text: lower-case letters are common, capitals and digits rare, punctuation rarer.
ORDINARY_BITS = {c: -math.log2(0.88 / 26) for c in LOWER} | {c: -math.log2(0.06 / 26) for c in UPPER} | {c: -math.log2(0.04 / 10) for c in DIGITS} | {c: -math.log2(0.02 / 6) for c in "+/_=-."}


def labelled_credentials(per_format: int = LABELLED_PER_FORMAT, seed: int = 7) -> dict[str, list[str]]:
    """Labelled examples of public credential formats, drawn from their published shapes."""
    r = random.Random(seed)
    hexa = DIGITS + "abcdef"

    def some(alphabet: str, n: int) -> str:
        return "".join(r.choice(alphabet) for _ in range(n))

    base64 = UPPER + LOWER + DIGITS + "+/"
    word = UPPER + LOWER + DIGITS
    shapes = {
        "digest": lambda: some(hexa, r.choice((32, 40, 64))),
        "access_id": lambda: r.choice(("AKIA", "ASIA")) + some(UPPER + "234567", 16),
        "base64_key": lambda: some(base64, r.choice((40, 43))) + r.choice(("", "=")),
        "prefixed": lambda: r.choice(("ghp_", "gho_")) + some(word, 36),
        "service_key": lambda: r.choice(("sk_live_", "sk_test_")) + some(word, 24),
        "upper_digest": lambda: some(hexa.upper(), r.choice((32, 40, 64))),
    }
    return {name: [shape() for _ in range(per_format)] for name, shape in shapes.items()}


class Automaton:
    """Probabilistic deterministic automaton inferred from positive examples."""

    def __init__(self, examples: list[str], alpha: float = ALPHA):
        self.count, self.final, self.next, self.seen = [0], [0], [{}], [{}]
        used = {c for text in examples for c in text if c.isalnum() or c in "+/"}
        self.body = next((c for c in CLASSES if used <= c), CLASSES[-1])
        columns = [{text[i] for text in examples if i < len(text)} for i in range(max(map(len, examples), default=0))]
        self.literal = {i for i, found in enumerate(columns) if len(found) <= FEW}
        for text in examples:
            self._grow(self.symbols(text))
        self._merge_all(math.sqrt(0.5 * math.log(2 / alpha)))

    def symbols(self, text: str) -> list[str]:
        """The class symbol is the empty string."""
        return ["" if c in self.body and i not in self.literal else c for i, c in enumerate(text)]

    def _grow(self, symbols: list[str]) -> None:
        at = 0
        self.count[0] += 1
        for s in symbols:
            if s not in self.next[at]:
                self.next[at][s] = len(self.count)
                self.count.append(0)
                self.final.append(0)
                self.next.append({})
                self.seen.append({})
            self.seen[at][s] = self.seen[at].get(s, 0) + 1
            at = self.next[at][s]
            self.count[at] += 1
        self.final[at] += 1

    def _differ(self, f1: int, n1: int, f2: int, n2: int, width: float) -> bool:
        return bool(n1 and n2) and abs(f1 / n1 - f2 / n2) > width * (1 / math.sqrt(n1) + 1 / math.sqrt(n2))

    def _compatible(self, a: int, b: int, width: float) -> bool:
        todo, met = [(a, b)], set()
        while todo:
            x, y = todo.pop()
            if x == y or (x, y) in met:
                continue
            met.add((x, y))
            if self._differ(self.final[x], self.count[x], self.final[y], self.count[y], width):
                return False
            for s in {*self.seen[x], *self.seen[y]}:
                if self._differ(self.seen[x].get(s, 0), self.count[x], self.seen[y].get(s, 0), self.count[y], width):
                    return False
                if s in self.next[x] and s in self.next[y]:
                    todo.append((self.next[x][s], self.next[y][s]))
        return True

    def _fold(self, a: int, b: int) -> None:
        """Add the subtree at b to the state a, merging further wherever both lead somewhere."""
        todo = [(a, b)]
        while todo:
            x, y = todo.pop()
            self.count[x] += self.count[y]
            self.final[x] += self.final[y]
            for s, to in self.next[y].items():
                self.seen[x][s] = self.seen[x].get(s, 0) + self.seen[y][s]
                if s in self.next[x]:
                    todo.append((self.next[x][s], to))
                else:
                    self.next[x][s] = to

    def _merge_all(self, width: float) -> None:
        kept = [0]
        fringe = [(0, s) for s in sorted(self.next[0])]
        while fringe:
            parent, s = fringe.pop(0)
            state = self.next[parent][s]
            if state in kept:
                continue
            for other in kept:
                # enough evidence on both sides, or a state would merge with whatever comes first
                if self.count[other] >= 10 and self.count[state] >= 10 and self._compatible(other, state, width):
                    self.next[parent][s] = other
                    self._fold(other, state)
                    break
            else:
                kept.append(state)
            fringe = [(q, s) for q in kept for s in sorted(self.next[q]) if self.next[q][s] not in kept]

    def bits(self, text: str) -> float:
        """-log2 of the probability of ``text``; infinite where the automaton has no such path."""
        at, total = 0, 0.0
        each = math.log2(len(self.body))
        for s in self.symbols(text):
            seen = self.seen[at].get(s)
            if not seen:
                return math.inf
            total += math.log2(self.count[at] / seen) + (0 if s else each)
            at = self.next[at][s]
        return total + math.log2(self.count[at] / self.final[at]) if self.final[at] else math.inf

    def ends(self, text: str, start: int, stops: set[int]) -> list[tuple[int, float]]:
        """(end, bits) of the texts from ``start`` to one of ``stops`` for which the automaton has a path."""
        at, total, out = 0, 0.0, []
        each = math.log2(len(self.body))
        for i in range(start, len(text)):
            c = text[i]
            s = "" if c in self.body and i - start not in self.literal else c
            seen = self.seen[at].get(s)
            if not seen:
                break
            total += math.log2(self.count[at] / seen) + (0 if s else each)
            at = self.next[at][s]
            if i + 1 in stops and self.final[at]:
                out.append((i + 1, total + math.log2(self.count[at] / self.final[at])))
        return out


def infer(labelled: dict[str, list[str]]) -> dict[str, Automaton]:
    return {name: Automaton(examples) for name, examples in sorted(labelled.items())}


def likelihood_margin(automata: dict[str, Automaton], candidate: str) -> tuple[float, str]:
    """Bits by which the likeliest format beats ordinary text, and its name."""
    ordinary = sum(ORDINARY_BITS[c] for c in candidate)
    return max(((ordinary - a.bits(candidate), name) for name, a in automata.items()), default=(-math.inf, ""))


def best_parts(automata: dict[str, Automaton], run: str, margin: float, taken: list[tuple[int, int]]) -> list[tuple[int, int, str]]:
    """(start, end, format) of the parts of ``run``, from and to its ends or separators, above the margin: the likeliest first, none overlapping another or ``taken``."""
    ordinary = [0.0]
    for c in run:
        ordinary.append(ordinary[-1] + ORDINARY_BITS[c])
    spots = [m.start() for m in SEPARATOR.finditer(run)]
    edges = {0, len(run), *spots, *(i + 1 for i in spots)}
    scored = [(ordinary[end] - ordinary[start] - bits, start, end, name) for start in edges for name, a in automata.items() for end, bits in a.ends(run, start, edges) if end - start >= LEAST]
    out: list[tuple[int, int, str]] = []
    for _, start, end, name in sorted((x for x in scored if x[0] >= margin), key=lambda x: (-x[0], x[1], -x[2], x[3])):
        if not any(s < end and start < e for s, e in [*taken, *((s, e) for s, e, _ in out)]):
            out.append((start, end, name))
    return out


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, rank of kind, end) of the base patterns, by start, then kind."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def scan(text: str | None, automata: dict[str, Automaton], margin: float = MARGIN_BITS) -> tuple:
    """n_assign, n_access, n_hex, n_format, digest of the base spans, all spans."""
    text = text or ""
    base = base_spans(text)
    joined = ",".join(f"{BASE_KINDS[k]}:{s}:{e}" for s, k, e in base)
    added = []
    for m in CANDIDATE.finditer(text):
        taken = [(s - m.start(), e - m.start()) for s, _, e in base if s < m.end() and m.start() < e]
        added += [(m.start() + s, 3, m.start() + e, f"format_{name}") for s, e, name in best_parts(automata, m[0], margin, taken)]
    spans = ",".join(f"{x[3] if x[1] == 3 else BASE_KINDS[x[1]]}:{x[0]}:{x[2]}" for x in sorted([*base, *added]))
    count = [sum(k == i for _, k, _ in base) for i in range(3)]
    return *count, len(added), hashlib.sha256(joined.encode()).hexdigest(), spans


def secret_scan(docs: DataFrame, labelled: dict[str, list[str]] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, n_assign, n_access, n_hex, n_format, base_sha256, spans.

    ``labelled`` maps a format to labelled credentials; the automata are inferred once on the driver and sent to the workers, their size
    bounded by the labels. Spans are code points, end exclusive, as kind:start:end. A null text counts as empty: no spans, the digest of
    the empty string. Repeated rows and null ids keep their rows; other columns are ignored; an empty table gives an empty result.
    """
    automata = infer(labelled if labelled is not None else labelled_credentials())
    shared = docs.sparkSession.sparkContext.broadcast(automata)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64()] * 4 + [pa.string()] * 2
        for batch in batches:
            rows = [scan(t.as_py(), shared.value) for t in batch.column(1)]
            columns = list(zip(*rows, strict=True)) or [[]] * 6
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], names=["doc_id", "n_assign", "n_access", "n_hex", "n_format", "base_sha256", "spans"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, "doc_id long, n_assign long, n_access long, n_hex long, n_format long, base_sha256 string, spans string")


def op3_secret_scan(spark, sf_dir: str) -> DataFrame:
    return secret_scan(table(spark, sf_dir, "documents"))
