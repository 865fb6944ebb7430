"""Dictionary matching by token n-grams, span resolution by a fold, BIO tags.

A dictionary is a table (pattern, entity_type, entity_id, canonical, count, source), pattern being space-joined tokens. Texts become
n-grams up to the longest pattern. A small dictionary is looked up inside each row, so texts are neither exploded nor shuffled; a larger
one is met by an equi-join. One row never meets more candidates than its n-grams, so there is no range or cross join.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions.lookup import held, let, per_text
from quern.functions.text import tokens

#: Which fact wins a token.
PRIORITY = {"brand": 110, "category": 105, "screen_diagonal": 100, "refresh_rate": 100, "battery_capacity": 100, "power": 95, "memory_ram": 95, "memory_rom": 95, "color": 80, "measurement": 60}
FAMILY_PRIORITY = 115
SPAN = "struct<type:string,value:string,surface:string,start:int,end:int,confidence:double,source:string>"


def usable(dictionary: DataFrame) -> DataFrame:
    """Patterns with a letter that aren't a single character."""
    return dictionary.filter(F.col("pattern").rlike(r"\p{L}") & ((F.length("pattern") > 1) | F.col("pattern").contains(" ")))


def lemma_tokens(texts: DataFrame, key: str, text: str, lemmas: DataFrame | None) -> DataFrame:
    """(key, t): the tokens of each text with their lemma, from ``lemmas`` (token, lemma), else the token itself."""
    plain = texts.select(key, tokens(F.col(text)).alias("t")).filter(F.size("t") > 0)
    if lemmas is None:
        return plain
    known = lemmas.groupBy("token").agg(F.min("lemma").alias("lemma"))
    each = plain.select(key, F.posexplode("t").alias("pos", "x")).join(known, F.col("x.text") == F.col("token"), "left")
    made = F.struct("pos", F.col("x.text").alias("text"), F.col("x.start").alias("start"), F.col("x.end").alias("end"), F.coalesce("lemma", "x.text").alias("lemma"))
    return each.groupBy(key).agg(F.array_sort(F.collect_list(made)).alias("t"))


def _runs(t: Column, longest: int, lemmas: bool) -> Column:
    """(phrases, start, end, token_start, token_end) of every run of 1..longest tokens of an array that isn't empty."""

    def run(i: Column, n: Column) -> Column:
        first, last, part = F.element_at(t, i), F.element_at(t, i + n - 1), F.slice(t, i, n)
        join = lambda name: F.array_join(F.transform(part, lambda x: x[name]), " ")
        phrases = F.array_distinct(F.array(join("text"), join("lemma"))) if lemmas else F.array(join("text"))
        return F.struct(phrases.alias("phrases"), first["start"].alias("start"), last["end"].alias("end"), (i - 1).alias("token_start"), (i + n - 1).alias("token_end"))

    return F.flatten(F.transform(F.sequence(F.lit(1), F.size(t)), lambda i: F.transform(F.sequence(F.lit(1), F.least(F.lit(longest), F.size(t) - i + 1)), lambda n: run(i, n))))


def ngrams(texts: DataFrame, key: str, text: str, longest: int, lemmas: DataFrame | None = None) -> DataFrame:
    """(key, phrase, start, end, token_start, token_end) of every run of 1..longest tokens, by surface and, where ``lemmas`` are given, by lemma.

    Runs are made inside one array, so only narrow rows are exploded.
    """
    runs = _runs(F.col("t"), longest, lemmas is not None)
    each = lemma_tokens(texts, key, text, lemmas).select(key, F.explode(runs).alias("r")).select(key, F.explode("r.phrases").alias("phrase"), "r.start", "r.end", "r.token_start", "r.token_end")
    return each


def matcher(dictionary: DataFrame, longest: int, lemmas: DataFrame | None = None) -> Callable[[Column], Column] | None:
    """A function of a text that gives its spans as ``dictionary_matches`` describes them, in an array; None where a table is too large to be held.

    With it a row is matched by itself, on a stream as well.
    """
    known = lemmas.groupBy("token").agg(F.min("lemma").alias("lemma")) if lemmas is not None else None
    lemma = held(known, "token", ["lemma"]) if known is not None else None
    find = held(usable(dictionary), "pattern", ["entity_type", "entity_id", "canonical", "count", "source"]) if known is None or lemma else None
    if find is None:
        return None

    def named(text: Column) -> Column:
        if lemma is None:
            return tokens(text)
        return F.transform(tokens(text), lambda x: F.struct(x["text"].alias("text"), x["start"].alias("start"), x["end"].alias("end"), F.coalesce(F.try_element_at(lemma(x["text"]), F.lit(1))["lemma"], x["text"]).alias("lemma")))

    def met(run: Column) -> Column:
        entries = F.flatten(F.filter(F.transform(run["phrases"], find), lambda e: e.isNotNull()))
        return F.struct(entries.alias("entries"), *[run[c].alias(c) for c in ("start", "end", "token_start", "token_end")])

    def span(text: Column, m: Column, kind: Column) -> Column:
        def of(e: Column) -> Column:
            names = F.filter(e, lambda x: x["entity_id"].isNotNull() & x["canonical"].isNotNull())
            n_entries = F.size(F.array_distinct(F.transform(names, lambda x: F.struct(x["entity_id"], x["canonical"]))))
            values = F.transform(F.filter(e, lambda x: x["canonical"].isNotNull()), lambda x: F.translate(F.lower(x["canonical"]), "ё", "е"))
            best = F.array_min(F.transform(e, lambda x: F.struct((-x["count"]).alias("c"), x["canonical"].alias("canonical"), x["entity_id"].alias("entity_id"))))
            curated = F.array_min(F.filter(F.transform(e, lambda x: x["source"]), lambda x: x.startswith("curated_")))
            surface = F.substring(text, m["start"] + 1, m["end"] - m["start"])
            return F.struct(*_verdict(kind, n_entries, F.size(F.array_distinct(values)), best, curated, surface, *[m[c] for c in ("start", "end", "token_start", "token_end")]))

        return let(F.filter(m["entries"], lambda x: x["entity_type"].eqNullSafe(kind)), of)

    def spans(text: Column) -> Column:
        def of(t: Column) -> Column:
            hits = F.filter(F.transform(_runs(t, longest, lemma is not None), met), lambda m: F.size(m["entries"]) > 0)
            return F.flatten(F.transform(hits, lambda m: F.transform(F.array_distinct(F.transform(m["entries"], lambda x: x["entity_type"])), lambda kind: span(text, m, kind))))

        return let(named(text), lambda t: F.when(F.size(t) > 0, of(t)))

    return spans


def _verdict(kind: Column, n_entries: Column, n_values: Column, best: Column, curated: Column, surface: Column, *place: Column) -> list[Column]:
    """The columns of a span by the entries it met."""
    certain = F.when(kind == "brand", 0.98).when(curated.isNotNull(), 0.96).when(n_entries > 1, 0.92).otherwise(0.94)
    ambiguous = n_values > 1
    return [
        kind.alias("type"), best["canonical"].alias("value"), best["entity_id"].alias("entity_id"), surface.alias("surface"), *[p.alias(c) for p, c in zip(place, ("start", "end", "token_start", "token_end"), strict=True)],
        ambiguous.alias("ambiguous"), F.when(ambiguous, 0.0).otherwise(certain).alias("confidence"), F.coalesce(curated, F.concat(F.lit("catalog_"), kind, F.lit("_trie"))).alias("source"),
    ]


def with_surface(spans: DataFrame, texts: DataFrame, key: str, text: str) -> DataFrame:
    """Spans with the part of the text that they cover, fetched for rows with a span only; texts are never broadcast, whatever their estimate."""
    return spans.join(texts.select(key, F.col(text).alias("_text")).hint("merge"), key).withColumn("surface", F.substring(F.col("_text"), F.col("start") + 1, F.col("end") - F.col("start"))).drop("_text")


def dictionary_matches(texts: DataFrame, key: str, text: str, dictionary: DataFrame, longest: int, lemmas: DataFrame | None = None) -> DataFrame:
    """Every span of a dictionary pattern, one row per span and type, with its best entry and whether it is ambiguous.

    With ``lemmas`` (token, lemma) a span matches by its surface tokens or by their lemmas; entries of both count together.

    A span whose entries have several canonical values is ambiguous and has confidence 0. Else confidence is 0.98 for brands, 0.96 for curated aliases,
    0.92 for several entries of one value and 0.94 otherwise; the entry with the highest count, then the smallest canonical, stands.
    """
    spans_of = matcher(dictionary, longest, lemmas)
    if spans_of:
        rows = texts.filter(F.col(key).isNotNull()).select(F.col(key).alias("_key"), F.col(text).alias("_text"))
        found = per_text(rows, ["_text"], lambda d: d.select("_text", spans_of(F.col("_text")).alias("_spans")).filter(F.size("_spans") > 0))
        return found.select(F.col("_key").alias(key), F.explode("_spans").alias("_s")).select(key, "_s.*")
    met = ngrams(texts, key, text, longest, lemmas).join(usable(dictionary), F.col("phrase") == F.col("pattern"))
    spans = met.groupBy(key, "entity_type", "start", "end", "token_start", "token_end").agg(
        F.count_distinct("entity_id", "canonical").alias("n_entries"),
        F.count_distinct(F.translate(F.lower("canonical"), "ё", "е")).alias("n_values"),
        F.min(F.struct((-F.col("count")).alias("c"), "canonical", "entity_id")).alias("best"),
        F.min(F.when(F.col("source").startswith("curated_"), F.col("source"))).alias("curated"),
    )
    columns = _verdict(*map(F.col, ("entity_type", "n_entries", "n_values", "best", "curated", "surface", "start", "end", "token_start", "token_end")))
    return with_surface(spans, texts, key, text).select(key, *columns)


def greedy(spans: Column, rank: list) -> tuple[Column, Column]:
    """(selected, rejected) of an array of spans with start and end: in the order of ``rank`` each is taken unless one taken before overlaps it.

    ``rank`` gives functions of a span; the smallest tuple goes first. Selected spans come in order of their start.
    """
    names = [f"_r{i}" for i in range(len(rank))]
    ordered = F.transform(F.array_sort(F.transform(spans, lambda s: F.struct(*[f(s).alias(n) for f, n in zip(rank, names, strict=True)], s.alias("s")))), lambda x: x["s"])
    none = F.filter(spans, lambda s: F.lit(False))

    def step(acc: Column, s: Column) -> Column:
        clash = F.exists(acc["taken"], lambda t: (t["start"] < s["end"]) & (t["end"] > s["start"]))
        return F.struct(
            F.when(clash, acc["taken"]).otherwise(F.concat(acc["taken"], F.array(s))).alias("taken"),
            F.when(clash, F.concat(acc["lost"], F.array(s))).otherwise(acc["lost"]).alias("lost"),
        )

    folded = F.aggregate(ordered, F.struct(none.alias("taken"), none.alias("lost")), step)
    return F.array_sort(folded["taken"], lambda a, b: F.when(a["start"] < b["start"], -1).when(a["start"] > b["start"], 1).otherwise(0)), folded["lost"]


def fact_rank() -> list:
    """Priority of the type, then the longer, the surer, the earlier."""
    priority = F.create_map(*[x for k, v in PRIORITY.items() for x in (F.lit(k), F.lit(v))])

    def of(s: Column) -> Column:
        return F.when((s["type"] == "category") & s["source"].contains("product_family"), FAMILY_PRIORITY).otherwise(F.coalesce(F.try_element_at(priority, s["type"]), F.lit(0)))

    return [lambda s: -of(s), lambda s: s["start"] - s["end"], lambda s: -s["confidence"], lambda s: s["start"], lambda s: s["end"], lambda s: s["type"]]


def drop_contained(spans: Column) -> Column:
    """Without spans that lie strictly inside another of their type; of identical ones the first stays."""
    inside = lambda s: F.exists(spans, lambda t: (t["type"] == s["type"]) & (t["start"] <= s["start"]) & (t["end"] >= s["end"]) & ((t["end"] - t["start"]) > (s["end"] - s["start"])))
    return F.array_distinct(F.filter(spans, lambda s: ~inside(s)))


def bio(tokened: Column, spans: Column) -> tuple[Column, Column]:
    """(tags, mask): tokens a span overlaps get B- or I- and its type, others O with mask false."""

    def owner(t: Column) -> Column:
        return F.filter(spans, lambda s: (s["start"] < t["end"]) & (s["end"] > t["start"]))

    def tag(t: Column) -> Column:
        held = owner(t)
        first = ~F.exists(tokened, lambda u: (u["end"] <= t["start"]) & (u["end"] > held[0]["start"]))
        return F.when(F.size(held) == 0, "O").otherwise(F.concat(F.when(first, "B-").otherwise("I-"), held[0]["type"]))

    return F.transform(tokened, tag), F.transform(tokened, lambda t: F.size(owner(t)) > 0)


#: Which type owns a token.
OWNERS = {"BRAND": 0, "CATEGORY": 1, "ATTR": 2}


def owner_tags(tokened: Column, spans: Column) -> Column:
    """BIO tags by owner: each token belongs to the span over it whose type comes first in OWNERS, then the longest, then the first; a run of
    tokens of one span begins with B-."""
    rank = F.create_map(*[x for k, v in OWNERS.items() for x in (F.lit(k), F.lit(v))])
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(F.coalesce(F.try_element_at(rank, s["type"]), F.lit(len(OWNERS))).alias("a"), (s["start"] - s["end"]).alias("b"), s["start"].alias("start"), s["end"].alias("end"), s["type"].alias("type"))))
    owners = F.transform(tokened, lambda t: F.try_element_at(F.filter(ordered, lambda s: (s["start"] < t["end"]) & (s["end"] > t["start"])), F.lit(1)))
    return F.transform(F.array(owners), lambda o: F.transform(o, lambda x, i: F.when(x.isNull(), "O").otherwise(F.concat(F.when((i > 0) & F.get(o, i - 1).eqNullSafe(x), "I-").otherwise("B-"), x["type"]))))[0]


def find_run(inside: Column, run: Column) -> Column:
    """Index from 0 of the first place where the array ``run`` stands in ``inside`` as a run of neighbours; -1 if nowhere or if it is empty."""
    last = F.size(inside) - F.size(run)
    places = F.filter(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda i: (last >= 0) & (F.size(run) > 0) & (F.slice(inside, i + 1, F.greatest(F.size(run), F.lit(1))) == run))
    return F.coalesce(F.try_element_at(places, F.lit(1)), F.lit(-1))


def holds_run(inside: Column, run: Column) -> Column:
    return find_run(inside, run) >= 0


def fuzzy_limit(n: Column) -> Column:
    """Edits allowed for a surface of n characters."""
    return F.when(n <= 3, 0).when(n <= 6, 1).otherwise(2)


def fuzzy_align(texts: DataFrame, candidates: DataFrame, key: str, text: str, surface: str, longest: int = 3) -> DataFrame:
    """Best window of each text for each of its candidate surfaces: exact, or within the allowed edits; ties to the earlier window."""
    met = ngrams(texts, key, text, longest).join(candidates.select(key, F.lower(surface).alias("wanted")), key)
    limit = fuzzy_limit(F.length("wanted"))
    scored = met.withColumn("distance", F.levenshtein("phrase", "wanted")).filter(F.col("distance") <= limit)
    return scored.groupBy(key, "wanted").agg(F.min(F.struct("distance", "start", "end", "phrase")).alias("b")).select(key, "wanted", "b.distance", "b.start", "b.end", F.col("b.phrase").alias("found"))
