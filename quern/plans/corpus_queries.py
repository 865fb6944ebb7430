"""Queries over generated search queries: fifty texts for each part, in Cyrillic and Latin, with inflected words, units and stop words."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.functions import text as tx
from quern.operators import annotate as an
from quern.operators import dictionary as dc
from quern.operators import evaluation as ev
from quern.operators import labeling as lb
from quern.operators import match as mt
from quern.operators import preprocess as pp
from quern.plans import fixtures as fx
from quern.plans.fixtures import table
from quern.plans.queries import query

COPIES = 50
TASK_TEXTS = 50_000  # generated texts of a task
NOUNS = (("телевизор", "телевизоры"), ("пылесос", "пылесосы"), ("смартфон", "смартфоны"))

#: The texts by k % 4, with one noun of three in the plural.
GENERATED = f"""g AS (SELECT p_partkey * {COPIES} + k AS id, k % 4 AS kind, split_part(lower(p_name), ' ', 1) AS w1, split_part(lower(p_name), ' ', 2) AS w2, p_size AS size,
        CASE p_partkey % 3 WHEN 0 THEN 'телевизор' WHEN 1 THEN 'пылесос' ELSE 'смартфон' END AS noun FROM part, range({COPIES}) AS t(k)),
    q AS (SELECT *, CASE kind WHEN 0 THEN 'Купить  ' || upper(w1) || ' ' || noun || 'ы ' || size || ' кг' WHEN 1 THEN noun || 'ы-' || w2 || ', ' || size || ' Вт'
        WHEN 2 THEN 'Цена ' || noun || 'ы ' || size || ' мАч' ELSE noun || 'ы ' || size || ' Гц' END AS text FROM g)"""


def generated(s, d) -> DataFrame:
    """The texts, dealt over tasks by their number: the parts are a small file, which alone would be one task."""
    part = table(s, d, "part").select("p_partkey", "p_name", "p_size")
    p = part.repartition(max(1, part.count() * COPIES // TASK_TEXTS), "p_partkey").select("p_partkey", F.split(F.lower("p_name"), " ").alias("w"), F.col("p_size").cast("string").alias("size"), F.explode(F.sequence(F.lit(0), F.lit(COPIES - 1))).alias("k"))
    noun = F.element_at(F.array(*[F.lit(many) for _, many in NOUNS]), (F.col("p_partkey") % 3 + 1).cast("int"))
    kind, w1, w2, size = F.col("k") % 4, F.col("w")[0], F.col("w")[1], F.col("size")
    text = F.when(kind == 0, F.concat(F.lit("Купить  "), F.upper(w1), F.lit(" "), noun, F.lit(" "), size, F.lit(" кг"))).when(kind == 1, F.concat(noun, F.lit("-"), w2, F.lit(", "), size, F.lit(" Вт")))
    text = text.when(kind == 2, F.concat(F.lit("Цена "), noun, F.lit(" "), size, F.lit(" мАч"))).otherwise(F.concat(noun, F.lit(" "), size, F.lit(" Гц")))
    return p.select((F.col("p_partkey") * COPIES + F.col("k")).alias("id"), text.alias("text"))


def lemmas(s) -> DataFrame:
    return s.createDataFrame([(many, one) for one, many in NOUNS], "token string, lemma string")


@query("q_preprocess_corpus", f"""WITH {GENERATED} SELECT id,
    CASE kind WHEN 0 THEN 'купить ' || w1 || ' ' || noun || 'ы ' || size || ' кг' WHEN 1 THEN noun || 'ы ' || w2 || ', ' || size || ' вт' WHEN 2 THEN 'цена ' || noun || 'ы ' || size || ' мач' ELSE noun || 'ы ' || size || ' гц' END AS spaces,
    CASE kind WHEN 0 THEN 'купить ' || w1 || ' ' || noun || ' ' || size || ' кг' WHEN 1 THEN noun || ' ' || w2 || ', ' || size || ' вт' WHEN 2 THEN 'цена ' || noun || ' ' || size || ' мач' ELSE noun || ' ' || size || ' гц' END AS lemma,
    CASE kind WHEN 0 THEN w1 || ' ' || noun || ' ' || size || ' кг' WHEN 1 THEN noun || ' ' || w2 || ' ' || size || ' вт' WHEN 2 THEN noun || ' ' || size || ' мач' ELSE noun || ' ' || size || ' гц' END AS search_text,
    kind = 2 AS price_intent, CASE kind WHEN 0 THEN 'kg' WHEN 1 THEN 'w' WHEN 2 THEN 'mah' ELSE 'hz' END AS unit, size::VARCHAR AS number,
    CASE kind WHEN 1 THEN 'power' WHEN 2 THEN 'battery_capacity' WHEN 3 THEN CASE WHEN noun <> 'пылесос' THEN 'refresh_rate' END END AS entity_type FROM q""")
def preprocess_corpus(s, d):
    rows = pp.preprocess(generated(s, d), "text", lemmas(s))
    first = F.element_at(F.filter("measurements", lambda m: ~m["rejected"]), 1)
    return rows.select("id", "spaces", "lemma", "search_text", "price_intent", first["canonical_unit"].alias("unit"), F.array_join(first["numbers"], ",").alias("number"), first["entity_type"].alias("entity_type"))


@query("q_stage_changes", f"""WITH {GENERATED}, s AS (SELECT text AS a, replace(replace(lower(text), '-', ' '), '  ', ' ') AS f, lower(text) AS l, replace(lower(text), '-', ' ') AS sep FROM q),
    m AS (SELECT *, replace(replace(replace(f, 'телевизоры', 'телевизор'), 'пылесосы', 'пылесос'), 'смартфоны', 'смартфон') AS lemma FROM s)
    SELECT 'text' AS stage, count(DISTINCT a) AS n_unique, 0::BIGINT AS n_changed FROM m UNION ALL SELECT 'nfkc', count(DISTINCT a), 0 FROM m UNION ALL SELECT 'yo_equal_e', count(DISTINCT a), 0 FROM m
    UNION ALL SELECT 'lower', count(DISTINCT l), count(*) FILTER (WHERE l <> a) FROM m UNION ALL SELECT 'separators', count(DISTINCT sep), count(*) FILTER (WHERE sep <> l) FROM m
    UNION ALL SELECT 'spaces', count(DISTINCT f), count(*) FILTER (WHERE f <> sep) FROM m UNION ALL SELECT 'lemma', count(DISTINCT lemma), count(*) FILTER (WHERE lemma <> f) FROM m""")
def stage_changes(s, d):
    return pp.change_counts(pp.preprocess(generated(s, d), "text", lemmas(s)), "text")


@query("q_annotate_corpus", f"""WITH {GENERATED} SELECT id, CASE kind WHEN 0 THEN 'brand:' || w1 || ',category:' || noun || ',measurement:' || size || ' kg' WHEN 1 THEN 'category:' || noun || ',power:' || size || ' w'
    WHEN 2 THEN 'category:' || noun || ',battery_capacity:' || size || ' mah' ELSE 'category:' || noun || CASE WHEN noun <> 'пылесос' THEN ',refresh_rate:' ELSE ',measurement:' END || size || ' hz' END AS entities FROM q""")
def annotate_corpus(s, d):
    brands = fx.dictionary(s, d).filter("entity_type = 'brand'").withColumn("count", F.col("count").cast("long"))
    records = s.createDataFrame([("category", one, one, one, one, [], 5) for one, _ in NOUNS], "entity_type string, entity_id string, canonical string, normalized string, lemma string, aliases array<string>, count long")
    known = brands.select("pattern", "entity_type", "entity_id", "canonical", "count", "source").unionByName(dc.build(records, lemmas(s)))
    out = an.annotate(generated(s, d), "id", "text", known, 1, lemmas=lemmas(s))
    return out.select("id", F.array_join(F.transform("entities", lambda x: F.concat(x["type"], F.lit(":"), x["value"])), ",").alias("entities"))


@query("q_lemma_match", f"WITH {GENERATED} SELECT id, noun AS value, noun || 'ы' AS surface, (CASE kind WHEN 0 THEN length('Купить  ') + length(w1) + 1 WHEN 2 THEN length('Цена ') ELSE 0 END)::INTEGER AS start FROM q")
def lemma_match(s, d):
    records = s.createDataFrame([("category", one, one, one, one, [], 5) for one, _ in NOUNS], "entity_type string, entity_id string, canonical string, normalized string, lemma string, aliases array<string>, count long")
    return mt.dictionary_matches(generated(s, d), "id", "text", dc.build(records), 2, lemmas(s)).select("id", "value", "surface", F.col("start").cast("int").alias("start"))


def _records(s, d) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Names as categories with an inflected alias, a lemma table for it, and overrides of the aliases of long words."""
    names = table(s, d, "part").groupBy(F.lower("p_name").alias("name")).agg(F.count(F.lit(1)).alias("count"))
    w1, w2 = F.split("name", " ")[0], F.split("name", " ")[1]
    none = F.lit(None).cast("string")
    records = names.select(F.lit("category").alias("entity_type"), F.col("name").alias("entity_id"), F.initcap("name").alias("canonical"), F.col("name").alias("normalized"), none.alias("lemma"), F.array(F.concat(w2, F.lit("s "), w1)).alias("aliases"), "count")
    more = names.select(F.lit("category").alias("entity_type"), w2.alias("entity_id"), w2.alias("canonical"), none.alias("normalized"), none.alias("lemma"), F.array(F.concat(w2, F.lit(" "), w1)).alias("aliases"), "count")
    overrides = names.filter(F.length(w1) >= 5).select(F.concat(w2, F.lit("s "), w1).alias("surface"), F.array("name").alias("target_ids"), F.array(F.lit("manual"), F.lit("log")).alias("sources"))
    return records.unionByName(more), names.select(F.concat(w2, F.lit("s")).alias("token"), w2.alias("lemma")).distinct(), overrides


@query("q_dictionary_build", """WITH n AS (SELECT lower(p_name) AS name, split_part(lower(p_name), ' ', 1) AS w1, split_part(lower(p_name), ' ', 2) AS w2, count(*) AS n FROM part GROUP BY ALL),
    e AS (SELECT name AS pattern, name AS entity_id, n FROM n UNION ALL SELECT w2 || ' ' || w1, name, n FROM n UNION ALL SELECT w2, w2, n FROM n UNION ALL SELECT w2 || ' ' || w1, w2, n FROM n),
    o AS (SELECT w2 || ' ' || w1 AS pattern, name FROM n WHERE length(w1) >= 5), m AS (SELECT pattern, entity_id, max(n) AS n FROM e GROUP BY ALL)
    SELECT m.pattern, entity_id, n AS "count", CASE WHEN o.name IS NULL THEN 'catalog_category_trie' ELSE 'curated_category_alias:manual+log' END AS source FROM m LEFT JOIN o USING (pattern) WHERE o.name IS NULL OR o.name = entity_id""")
def dictionary_build(s, d):
    records, lemma, overrides = _records(s, d)
    return dc.build(records, lemma, overrides).select("pattern", "entity_id", "count", "source")


@query("q_dictionary_verify", """WITH n AS (SELECT lower(p_name) AS name, string_split(lower(p_name), ' ') AS w FROM part), p AS (SELECT DISTINCT w[1] AS pattern, 'brand' AS entity_type FROM n UNION SELECT DISTINCT name, 'category' FROM n UNION SELECT DISTINCT w[2], 'color' FROM n),
    t AS (SELECT name, w FROM n WHERE length(w[1]) <> 4) SELECT pattern, entity_type, count(name) AS n_queries, CASE WHEN count(name) = 0 THEN 'unused' ELSE 'ok' END AS status FROM p LEFT JOIN t ON list_contains(w, pattern) OR name = pattern GROUP BY ALL""")
def dictionary_verify(s, d):
    texts = table(s, d, "part").filter(F.length(F.split("p_name", " ")[0]) != 4)
    return dc.verify(fx.dictionary(s, d), texts, "p_name").select("pattern", "entity_type", "n_queries", "status")


@query("q_typo_candidates", """WITH n AS (SELECT unnest(string_split(lower(p_name), ' ')) AS word FROM part), c AS (SELECT word, count(*) * 100 AS n FROM n GROUP BY 1), a AS (SELECT word, max(n) AS n FROM (SELECT * FROM c UNION ALL SELECT substr(word, 2), 1 FROM c UNION ALL SELECT 'q' || substr(word, 2), 1 FROM c) GROUP BY 1)
    SELECT x.word, y.word AS candidate, levenshtein(x.word, y.word)::INTEGER AS distance FROM a x JOIN a y ON y.n >= x.n * 10 AND levenshtein(x.word, y.word) = 1 WHERE length(x.word) >= 4 AND length(y.word) >= 4""")
def typo_candidates(s, d):
    c = table(s, d, "part").select(F.explode(F.split(F.lower("p_name"), " ")).alias("word")).groupBy("word").agg((F.count(F.lit(1)) * 100).alias("count"))
    cut = F.expr("substring(word, 2)")
    rows = c.union(c.select(cut, F.lit(1).cast("long"))).union(c.select(F.concat(F.lit("q"), cut), F.lit(1).cast("long"))).groupBy("word").agg(F.max("count").alias("count"))
    return dc.typo_candidates(rows)


OWNED = "CASE WHEN p_partkey % 3 <> 0 THEN 'B-BRAND' WHEN p_partkey % 2 = 0 THEN 'B-CATEGORY' ELSE 'O' END || ' ' || CASE WHEN p_partkey % 2 = 0 THEN CASE WHEN p_partkey % 3 <> 0 THEN 'B-CATEGORY' ELSE 'I-CATEGORY' END ELSE 'B-ATTR' END"


def _owned(s, d) -> DataFrame:
    span = lambda kind, a, b: F.struct(F.lit(kind).alias("type"), a.cast("int").alias("start"), b.cast("int").alias("end"))
    first, whole = F.length(F.split("p_name", " ")[0]), F.length("p_name")
    spans = F.array(F.when(F.col("p_partkey") % 3 != 0, span("BRAND", F.lit(0), first)), F.when(F.col("p_partkey") % 2 == 0, span("CATEGORY", F.lit(0), whole)), span("ATTR", first + 1, whole))
    return table(s, d, "part").select("p_partkey", "p_name", "p_size", F.array_compact(spans).alias("spans"))


@query("q_owner_tags", f"SELECT p_partkey, {OWNED} AS tags FROM part")
def owner_tags(s, d):
    return _owned(s, d).select("p_partkey", F.array_join(mt.owner_tags(tx.tokens(F.col("p_name")), F.col("spans")), " ").alias("tags"))


@query("q_gold_sample", f"SELECT p_partkey, tags FROM (SELECT p_partkey, {OWNED} AS tags, -ln((('0x' || substr(md5(p_partkey || '|42'), 1, 12))::BIGINT + 0.5) / 281474976710656.0) / ln(1 + p_size) AS r FROM part) ORDER BY r, p_partkey LIMIT 200")
def gold_sample(s, d):
    return lb.gold_sample(_owned(s, d), "p_partkey", "p_size", "p_name", "spans", 200).select("p_partkey", F.array_join("tags", " ").alias("tags"))


@query("q_dataset_diagnostics", f"""WITH r AS (SELECT lower(p_name) AS name, CASE WHEN p_partkey % 5 = 0 THEN 'valid' ELSE 'train' END AS part, string_split({OWNED}, ' ') AS tags FROM part), t AS (SELECT part, unnest(tags) AS tag FROM r), h AS (SELECT name, count(*) FILTER (WHERE part = 'train') AS t, count(*) FILTER (WHERE part = 'valid') AS v FROM r GROUP BY 1)
    SELECT part || '_tag' AS metric, tag AS name, count(*) AS value FROM t GROUP BY part, tag UNION ALL SELECT part || '_entities', len(list_filter(tags, lambda x: x[1] = 'B'))::VARCHAR, count(*) FROM r GROUP BY 1, 2
    UNION ALL SELECT 'train_repeated', 'all', sum(greatest(t - 1, 0))::BIGINT FROM h UNION ALL SELECT 'valid_repeated', 'all', sum(greatest(v - 1, 0))::BIGINT FROM h UNION ALL SELECT 'in_both', 'all', count(*) FILTER (WHERE t > 0 AND v > 0) FROM h""")
def dataset_diagnostics(s, d):
    rows = _owned(s, d).select("p_partkey", F.lower("p_name").alias("name"), mt.owner_tags(tx.tokens(F.col("p_name")), F.col("spans")).alias("tags"))
    return ev.diagnostics(rows.filter("p_partkey % 5 <> 0"), rows.filter("p_partkey % 5 = 0"), "name", "tags")


@query("q_find_run", "SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN -1 WHEN w[1] = w[2] THEN 0 ELSE 1 END AS at FROM (SELECT p_partkey, p_size, string_split(lower(p_name), ' ') AS w FROM part)")
def find_run(s, d):
    w = F.split(F.lower("p_name"), " ")
    return table(s, d, "part").select("p_partkey", mt.find_run(F.concat(w, w), F.when(F.col("p_size") % 3 == 0, F.array(w[1], F.lit("zz"))).otherwise(F.array(w[1], w[0]))).alias("at"))


@query("q_catalog_values", "SELECT p_partkey, 'сенсор' AS attr_type, split_part(p_name, ' ', 1) AS value, 0 AS start FROM part WHERE p_size % 2 = 0")
def catalog_values(s, d):
    part = table(s, d, "part").withColumn("category", F.when(F.col("p_size") % 2 == 0, "even").otherwise("odd"))
    values = part.select(F.lit("even").alias("category"), F.lit("сенсор").alias("attr_type"), F.split("p_name", " ")[0].alias("value")).union(part.select(F.lit("even"), F.lit("гарантия"), F.split("p_name", " ")[1])).distinct()
    return lb.catalog_values(part, "p_partkey", "p_name", "category", values, 1).select("p_partkey", "attr_type", "value", F.col("start").cast("int").alias("start"))


@query("q_feature_attrs", "SELECT p_partkey, CASE p_size % 3 WHEN 0 THEN 'connectivity:wifi,sim:nano-sim' WHEN 1 THEN 'network:5g' ELSE '' END AS features FROM part")
def feature_attrs(s, d):
    tail = F.when(F.col("p_size") % 3 == 0, " Wi-Fi nano-sim").when(F.col("p_size") % 3 == 1, " 5G x5gx").otherwise(" xwifi")
    found = lb.features(F.concat("p_name", tail))
    return table(s, d, "part").select("p_partkey", F.array_join(F.transform(found, lambda x: F.concat(x["attr_type"], F.lit(":"), x["value"])), ",").alias("features"))
