"""Fuzzy line deduplication with DataFrame functions only.

Two lines are alike if the sets of their runs of five characters, at every offset, have a Jaccard similarity of 0.8; a shorter line is its
own only run. Signatures are MinHash samples: of the hashes of a line's runs of twenty-four characters, at every offset, those below a bound
that leaves SAMPLE of them on average, and each is a band key. Long runs tell lines apart that share common words, and lines at
similarity 0.8 still share about half of theirs, so they share no key with a probability of 0.2 %. Lines below SHORT characters,
or that repeat themselves, also have keys of three neighbours among the least hashes of their runs of five.

Each line is tried against the leader of most of its keys first. Where a key still has CROWD lines or more, lines outside the largest component
are tried against a member of it, in some rounds while these find enough, so that large groups join with few comparisons a line. All lines of a key that then
lie in different components meet inside a join. Only pairs leave it whose sketches of runs allow the similarity; that test never drops a
pair that is alike. A sketch is a bitmap in which each distinct run flips one bit, beside the number of distinct runs. Candidates
are id pairs; the lines themselves are fetched once the pairs are distinct, and decided by exact Jaccard similarity. Components come from star contraction, and
the first line of each component in (id, hash of the text, position) order is kept.

Texts are split in one pass that leaves a lean table: a row for each key, with the place of its line. Key rows hold two longs. Copies of
a frequent line are dropped before the keys are dealt, by a broadcast of at most FREQUENT rows whatever the input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.llm.common import bounded, cut, forget, stored, table
from quern.llm.components import components

RUN, LONG = 5, 24  # characters of a run for similarity, and for keys
SHORT, BOTH = 64, 36  # characters below which a line has keys of short runs; and from which of long ones: far apart, for alike lines differ in length
FIRST = 40  # characters whose short runs make these keys
SAMPLE, REPEATING = 14, 48  # keys of a line, on average; of one that repeats itself
AGAIN = 16  # characters that stand twice in a line that repeats itself
NEIGHBOURS = 18  # least hashes of short runs, of which each three neighbours are a key
FREQUENT = 200_000  # rows of the table of frequent lines
WORDS = 1 << 18  # 64-bit words of the bitmap of keys that several lines have; when full it lets more rows through, never fewer
BITMAP = 16  # 64-bit words of the sketch of a line's runs of five
CROWD, ROUNDS = 16, 3  # lines of a key from which new leaders are tried, and how often at most, before lines are tried pair by pair
FRUITFUL = 5  # tries for each line found alike up to which another round follows
BLANK = " \t\r\x0b\x0c"
HALF = 1 << 63


def _trimmed(line: str) -> Column:
    """Without white space at the ends; only ends that need it take the slow way."""
    x = F.trim(line)
    odd = [f(x, F.lit(c)) for c in BLANK[1:] for f in (F.startswith, F.endswith)]
    some = odd[0]
    for o in odd[1:]:
        some = some | o
    return F.when(some, F.trim(line, F.lit(BLANK))).otherwise(x)


def _repeats() -> Column:
    """Whether the start, the middle or the end of a line of ``n`` characters stands in it once more."""
    ends = f"locate(substring(line, 1, {AGAIN}), line, 2) > 0 OR locate(substring(line, n div 2, {AGAIN}), line) < n div 2 OR locate(substring(line, n - {AGAIN - 1}, {AGAIN}), line) < n - {AGAIN - 1}"
    return F.expr(f"n > {AGAIN} AND ({ends})")


def _short_keys(line: str) -> Column:
    """Keys of three neighbours among the least hashes of the first runs of five: of all runs, where the line is short or its period is."""
    found = F.expr(f"transform(sequence(1, greatest(least(length({line}), greatest({FIRST}, if(length({line}) < {SHORT}, {SHORT}, 0))) - {RUN - 1}, 1)), i -> xxhash64(substring({line}, i, {RUN})))")
    low = F.slice(F.array_sort(F.array_distinct(found)), 1, NEIGHBOURS)
    three = lambda s: F.transform(F.sequence(F.lit(1), F.greatest(F.size(s) - 2, F.lit(1))), lambda i: F.xxhash64(*[F.element_at(s, F.least(i + k, F.size(s))) for k in range(3)]).bitwiseOR(F.lit(1)))
    return F.transform(F.array(low), three)[0]


def _dealt(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, h, pos, id, m, head, key): a row for each key of each line with text; ``head`` marks one row of each line. m is negative if it repeats itself."""
    text = F.col(text_col).cast("string")
    split = docs.filter(F.col(id_col).isNotNull()).select(F.col(id_col).try_cast("long").alias("doc_id"), F.xxhash64(text).alias("h"), F.posexplode(F.split(text, "\n")).alias("pos", "line"))
    named = split.filter("doc_id IS NOT NULL").select("doc_id", "h", "pos", F.lower(_trimmed("line")).alias("line")).filter("line <> ''")
    sized = named.select("doc_id", "h", "pos", F.xxhash64("line").alias("id"), F.length("line").alias("n"), "line", F.encode("line", "UTF-16BE").alias("b"))
    known = sized.select("doc_id", "h", "pos", "id", "n", "line", "b", _repeats().alias("rep"))
    runs = F.octet_length("b") / 2 - (LONG - 1)
    wanted = F.when(F.col("rep"), F.lit(float(REPEATING))).otherwise(F.lit(float(SAMPLE))) * F.sqrt(F.greatest(runs, F.lit(1000.0)) / 1000)
    bound = F.when(runs <= 3 * wanted, F.lit(HALF - 1)).otherwise(F.lit(-HALF) + (wanted / runs * float(2 * HALF)).cast("long"))
    some = F.when((F.col("n") < SHORT) | F.col("rep"), _short_keys("line"))
    ready = known.select("doc_id", "h", "pos", "id", F.when(F.col("rep"), -F.col("n")).otherwise(F.col("n")).alias("m"), "b", bound.alias("bound"), some.alias("some"))
    long = F.when(F.abs("m") >= BOTH, F.sequence(F.lit(1), (runs * 2 - 1).cast("int"), F.lit(2))).otherwise(F.array().cast("array<int>"))
    at = F.when(F.col("some").isNull(), long).otherwise(F.concat(F.sequence(-F.size("some"), F.lit(-1)), long))
    each = ready.select("doc_id", "h", "pos", "id", "m", "b", "bound", "some", F.posexplode(at).alias("p", "i"))
    key = F.when(F.col("i") < 0, F.element_at("some", F.col("i"))).otherwise(F.shiftleft(F.shiftright(F.xxhash64(F.substring("b", F.col("i"), F.lit(2 * LONG))), 1), 1))
    hashed = each.select("doc_id", "h", "pos", "id", "m", (F.col("p") == 0).alias("head"), "i", "bound", key.alias("key"))
    kept = (F.col("i") < 0) | (F.col("key") <= F.col("bound"))
    return hashed.filter(kept | F.col("head")).select("doc_id", "h", "pos", "id", "m", "head", F.when(kept, F.col("key")).alias("key"))


def _set(line: Column) -> Column:
    """Distinct hashes of the runs of five characters, or of the shorter line itself."""
    starts = lambda b: F.sequence(F.lit(1), F.greatest(F.octet_length(b) - (4 * RUN - 1), F.lit(1)).cast("int"), F.lit(4))
    return F.array_distinct(F.transform(F.array(F.encode(line, "UTF-32")), lambda b: F.transform(starts(b), lambda i: F.xxhash64(F.substring(b, i, F.lit(4 * RUN)))))[0])


def _texts(docs: DataFrame, id_col: str, text_col: str, places: DataFrame) -> DataFrame:
    """(id, line) of the lines that stand first at ``places`` (id, at)."""
    wanted = places.groupBy("at.doc_id", "at.h").agg(F.collect_list(F.struct("id", "at.pos")).alias("those"))
    text = F.col(text_col).cast("string")
    lean = docs.select(F.col(id_col).try_cast("long").alias("doc_id"), F.xxhash64(text).alias("h"), text.alias("text"))
    met = lean.join(bounded(wanted), ["doc_id", "h"]).select(F.split("text", "\n").alias("lines"), F.explode("those").alias("x"))
    return met.select("x.id", F.lower(_trimmed_col(F.element_at("lines", F.col("x.pos") + 1))).alias("line")).dropDuplicates(["id"])


def _trimmed_col(line: Column) -> Column:
    return F.trim(line, F.lit(BLANK))


class _Checker:
    """Decides candidate pairs by the exact similarity of their lines; lines are fetched once."""

    def __init__(self, docs: DataFrame, id_col: str, text_col: str, spots: DataFrame, percent: int):
        self.source, self.spots, self.percent, self.held = (docs, id_col, text_col), spots, percent, None

    def fetch(self, ids: DataFrame) -> DataFrame:
        """(id, line) of ``ids``, and of those fetched before."""
        new = ids if self.held is None else ids.join(self.held, "id", "left_anti")
        got = stored(_texts(*self.source, self.spots.join(new, "id", "left_semi").select("id", "at")), "lines")
        self.held = got if self.held is None else self.held.union(got)
        return self.held

    def links(self, pairs: DataFrame, held: bool = False) -> DataFrame:
        """The pairs (a, b) that are alike; ``held`` where all their lines have been fetched."""
        ids = pairs.select(F.col("a").alias("id")).union(pairs.select(F.col("b").alias("id"))).distinct()
        lines = self.held.join(bounded(ids), "id", "left_semi") if held else self.fetch(ids)
        both = pairs.join(lines.toDF("a", "x"), "a").join(lines.toDF("b", "y"), "b").select("a", "b", _set(F.col("x")).alias("x"), _set(F.col("y")).alias("y"))
        fit = F.least(F.size("x"), F.size("y")) * 100 >= F.greatest(F.size("x"), F.size("y")) * self.percent
        same = F.size(F.array_intersect("x", "y"))
        return cut(both.filter(fit).filter(same * 100 >= (F.size("x") + F.size("y") - same) * self.percent).select("a", "b"))


def _bitmaps(lines: DataFrame) -> DataFrame:
    """(id, runs, size, b0 …): how many distinct runs of five a line has, and the bitmap in which each flips one bit.

    ``runs`` is a bound on their number, exact for a line that repeats itself.
    """
    runs = F.greatest(F.length("line") - (RUN - 1), F.lit(1))
    sets = lines.select("id", F.length("line").alias("n"), "line", runs.alias("all"), _set(F.col("line")).alias("set"))
    each = sets.select("id", F.when(_repeats(), F.size("set")).otherwise(F.col("all")).alias("runs"), F.explode("set").alias("h"))
    bit = F.expr("shiftleft(1L, cast(shiftright(h, 8) & 63 AS int))")
    words = each.groupBy("id", F.col("h").bitwiseAND(BITMAP - 1).cast("int").alias("w")).agg(F.max("runs").alias("runs"), F.count(F.lit(1)).alias("size"), F.bit_xor(bit).alias("bits"))
    word = lambda j: F.coalesce(F.bit_xor(F.when(F.col("w") == j, F.col("bits"))), F.lit(0).cast("long")).alias(f"b{j}")
    return words.groupBy("id").agg(F.max("runs").alias("runs"), F.sum("size").cast("int").alias("size"), *[word(j) for j in range(BITMAP)])


def _differing() -> Column:
    return sum((F.bit_count(F.col(f"x.b{j}").bitwiseXOR(F.col(f"y.b{j}"))) for j in range(BITMAP)), F.lit(0))


def _possible(percent: int) -> Column:
    """Whether x and y may be alike by their sketches; never false for lines that are, for a bit that differs stands for a run that only one of them has."""
    sizes = (F.col("x.size") * 100 >= F.col("y.size") * percent) & (F.col("y.size") * 100 >= F.col("x.size") * percent)
    return sizes & (_differing() * (100 + percent) <= (F.col("x.size") + F.col("y.size")) * (100 - percent))


def _placed(rows: DataFrame, joined: DataFrame) -> DataFrame:
    """The rows with ``comp``, the component of their id so far."""
    return rows.join(joined, "id", "left").withColumn("comp", F.coalesce("component", "id")).drop("component")


def _merged(joined: DataFrame, links: DataFrame) -> DataFrame:
    """The components of ``joined`` and ``links`` together; those before are stars by now, which settle soon."""
    stars = joined.filter("id <> component").select(F.col("id").alias("a"), F.col("component").alias("b"))
    return cut(components(stars.union(links.select("a", "b")), "a", "b"))


def _tries(crowd: DataFrame, sketches: DataFrame, joined: DataFrame, again: int, percent: int) -> DataFrame:
    """(a, b): each line outside the largest component of a key, with the nearest of the leaders that its keys have there, another member each round."""
    groups = _placed(crowd.select("id", "key"), joined).groupBy("key", "comp").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(F.xxhash64("id", "key", F.lit(again)).alias("h"), "id")).alias("m"))
    top = groups.groupBy("key").agg(F.max(F.struct("n", "comp", F.col("m.id").alias("id"))).alias("t"), F.count(F.lit(1)).alias("comps")).filter("comps > 1").select("key", "t.comp", "t.id")
    y = bounded(top.join(sketches, "id")).alias("y")
    near = (F.col("x.key") == F.col("y.key")) & (F.col("x.comp") != F.col("y.comp")) & _possible(percent)
    met = _placed(crowd, bounded(joined)).alias("x").join(y, near).select(F.col("x.id").alias("a"), F.struct(_differing().alias("d"), F.col("y.id").alias("b")).alias("m"))
    return met.groupBy("a").agg(F.min("m").alias("m")).select("a", F.col("m.b").alias("b"))


def line_components(dealt: DataFrame, spots: DataFrame, checker: _Checker) -> DataFrame:
    """(id, component) of the lines that are like another. ``spots`` has id, the first place ``at``, the number n of each line. ``dealt`` is deleted."""
    total = spots.agg(F.sum("n")).first()[0] or 0
    often = F.broadcast(spots.filter(F.col("n") >= max(2, -(-total // FREQUENT))).select("id", "at"))  # total / FREQUENT copies each: at most FREQUENT rows
    once = dealt.filter("key IS NOT NULL").join(often, "id", "left").filter(F.col("at").isNull() | (F.struct("doc_id", "h", "pos") == F.col("at"))).select("id", "key")
    several = cut(once.groupBy("key").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).filter("lo < hi").select("key", "lo"))
    word, bit = F.shiftright("key", 7).bitwiseAND(WORDS - 1).cast("int").alias("w"), F.expr("shiftleft(1L, cast(key >> 1 & 63 AS int))")
    bitmap = several.select(word, bit.alias("bit")).groupBy("w").agg(F.bit_or("bit").alias("bits"))
    likely = once.select("id", "key", word).join(F.broadcast(bitmap), "w").filter(F.col("bits").bitwiseAND(bit) != 0).select("id", "key")
    met = stored(likely.join(several.hint("shuffle_hash"), "key").select("id", "key", "lo").distinct(), "met")

    # each line with the leader that most of its keys have
    forget(dealt, several)
    led = met.filter("id <> lo").groupBy("id", "lo").agg(F.count(F.lit(1)).alias("n")).groupBy("id").agg(F.max(F.struct("n", "lo")).alias("m"))
    tried = cut(led.select(F.col("id").alias("a"), F.col("m.lo").alias("b")))
    links = checker.links(tried)
    joined = cut(components(links, "a", "b"))

    # what lies apart within a key: where many lines meet, by new leaders first
    placed = _placed(met.select("id", "key"), joined)
    apart = placed.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count(F.lit(1)).alias("lines")).filter("lo < hi").select("key", "lines")
    rest = stored(placed.select("id", "key").join(apart.hint("shuffle_hash"), "key"), "rest")
    forget(met)
    ids = rest.select("id").distinct()
    bitmaps = stored(_bitmaps(checker.fetch(ids).join(ids, "id", "left_semi")).drop("runs"), "bitmaps")
    words = [F.coalesce(c, F.lit(0).cast(t)).alias(c) for c, t in bitmaps.dtypes if c != "id"]  # never null, which keeps the code of the joins short
    sketches = bitmaps.select("id", *words)
    crowd = stored(rest.filter(F.col("lines") >= CROWD).select("id", "key").join(sketches, "id"), "crowd")
    for again in range(ROUNDS):
        pairs = cut(_tries(crowd.select("id", "key", *words), sketches, joined, again, checker.percent))
        more = checker.links(pairs, held=True)
        found, asked = more.count(), pairs.count()
        if found:
            joined = _merged(joined, more)
        if found * FRUITFUL < asked or not asked:
            break
    forget(crowd)

    # then all lines of a key in different components, in a join that only pairs leave whose sketches allow the similarity
    placed = _placed(rest.select("id", "key"), joined)
    apart = placed.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo < hi").select("key")
    live = placed.join(apart.hint("shuffle_hash"), "key").join(sketches, "id")
    x, y = live.alias("x"), live.alias("y")
    near = (F.col("x.key") == F.col("y.key")) & (F.col("x.id") < F.col("y.id")) & (F.col("x.comp") != F.col("y.comp")) & _possible(checker.percent)
    more = x.join(y, near).select(F.col("x.id").alias("a"), F.col("y.id").alias("b")).distinct()
    done = tried.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    more = cut(more.join(done, ["a", "b"], "left_anti"))
    forget(rest, bitmaps)
    if not more.take(1):
        return joined
    last = checker.links(more, held=True)
    return _merged(joined, last) if last.take(1) else joined


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 80) -> DataFrame:
    """The table with later copies of lines removed from ``text_col``, and two more columns: n_lines (lines with text, before), n_dropped.

    Lines are compared in lower case without white space at their ends; a component of lines, linked at a Jaccard similarity of
    ``percent`` / 100 (80 at least), keeps the one first in (id, hash of the text, position) order. Blank lines stay. A null text stays null with 0
    lines; rows whose id is null or no integer are left as they are with n_dropped 0. Rows that repeat an id and a text are one document;
    rows of one id with different texts are different documents. Existing columns n_lines and n_dropped are replaced, others stay whatever
    their names. An empty table gives an empty result.
    """
    dealt = stored(_dealt(docs, id_col, text_col), "dealt")
    heads = stored(dealt.filter("head").select("id", "m", F.struct("doc_id", "h", "pos").alias("place")), "heads")
    spots = stored(heads.groupBy("id").agg(F.min("place").alias("at"), F.count(F.lit(1)).alias("n"), F.min("m").alias("m")), "spots")
    checker = _Checker(docs, id_col, text_col, spots, percent)
    comps = cut(line_components(dealt, spots, checker))
    placed = spots.join(comps, "id", "left").withColumn("comp", F.coalesce("component", "id"))
    keeper = placed.filter("n > 1 OR component IS NOT NULL")
    first = keeper.groupBy("comp").agg(F.min("at").alias("keep"))
    repeated = keeper.select("id", "comp").join(first, "comp").select("id", "keep")
    gone = heads.join(repeated, "id").filter(F.col("place") != F.col("keep")).select("place.*")
    gone = gone.groupBy("doc_id", "h").agg(F.array_sort(F.collect_set("pos")).alias("gone")).select(F.struct("doc_id", "h").alias("doc"), "gone")
    gone = bounded(gone)
    forget(heads, spots, checker.held)
    mine, away = "__row_of_lines", "__lines_away"
    text = F.col(text_col).cast("string")
    rows = docs.drop("n_lines", "n_dropped").withColumn(mine, F.struct(F.col(id_col).try_cast("long").alias("doc_id"), F.xxhash64(text).alias("h")))
    rows = rows.join(gone.toDF("__doc", away), F.col(mine) == F.col("__doc"), "left")
    split = F.split(text, "\n")
    left = F.filter(split, lambda x, i: ~F.array_contains(F.col(away), i))
    out = F.when(F.col(away).isNull(), F.col(text_col)).otherwise(F.array_join(left, "\n"))
    n_lines = F.coalesce(F.regexp_count(text, F.lit(r"\S[^\n]*")), F.lit(0))
    return rows.withColumns({"n_lines": n_lines.cast("long"), "n_dropped": F.when(F.col(away).isNull(), 0).otherwise(F.size(away)).cast("long"), text_col: out}).drop(away, mine, "__doc")


def op10_line_dedup(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_lines(docs).select("doc_id", "n_lines", "n_dropped", "text")
