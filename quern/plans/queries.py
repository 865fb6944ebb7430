"""The engine's queries over the driver's tables, each with DuckDB SQL for the same rows where SQL can express it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quern.functions import lemma as lm
from quern.functions import text as tx
from quern.functions.units import factors
from quern.operators import annotate as an
from quern.operators import catalog as ct
from quern.operators import clicks as ck
from quern.operators import colors as co
from quern.operators import evaluation as ev
from quern.operators import labeling as lb
from quern.operators import match as mt
from quern.operators import measure as ms
from quern.operators import profile as pf
from quern.operators import sampling as sm
from quern.operators import silver as sv
from quern.operators import split as sp
from quern.plans import fixtures as fx
from quern.plans.fixtures import CLICKS, DATASET, DICTIONARY, NO_CLICK, PAIRS, SPLIT, table

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def keep(f):
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = sql
        return f

    return keep


def joined(c: str):
    return F.array_join(c, ",").alias(c)


# click pipeline


@query("q_scan_clicks", "SELECT CAST(l_partkey AS BIGINT) AS sku_id, l_extendedprice AS price, CAST(l_linenumber - 1 AS INTEGER) AS position, CAST(l_orderkey AS VARCHAR) AS query_original FROM lineitem WHERE l_linenumber > 1")
def scan_clicks(s, d):
    raw = table(s, d, "lineitem").withColumn("toValidUTF8(query_text)", F.col("l_orderkey")).withColumn("pos", F.col("l_linenumber") - 1)
    return ck.scan_clicks(raw, {"sku_id": "l_partkey", "price": "l_extendedprice", "position": "pos", "query_original": "toValidUTF8(query_text)"}).filter("position > 0")


@query("q_exact_dup_collapse", "SELECT l_orderkey, l_linenumber, l_returnflag, count(*) AS exact_row_count FROM lineitem GROUP BY ALL")
def exact_dup_collapse(s, d):
    return ck.collapse_exact(table(s, d, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag"))


@query("q_pair_evidence", f"WITH {PAIRS} SELECT query_canonical, sku_id, click_count, exact_group_count, min_position, median_position, round(mean_position, 6) AS mean_position, round(evidence_score, 6) AS evidence_score, min_price, round(median_price, 6) AS median_price, max_price, brand, category_id FROM pairs")
def pair_evidence(s, d):
    r = lambda c: F.round(c, 6).alias(c)
    return fx.pairs(s, d).select("query_canonical", "sku_id", "click_count", "exact_group_count", "min_position", "median_position", r("mean_position"), r("evidence_score"), "min_price", r("median_price"), "max_price", "brand", "category_id")


for _label, _score in (("category_id", "category_score"), ("brand", "brand_score")):

    @query(f"q_dominant_{_label.removesuffix('_id')}", f"WITH {PAIRS} SELECT query_canonical, {_label}, round({_score}, 6) AS {_score} FROM (SELECT *, row_number() OVER (PARTITION BY query_canonical ORDER BY {_score} DESC, {_label}) AS r FROM (SELECT query_canonical, {_label}, round(sum(evidence_score), 9) AS {_score} FROM pairs WHERE {_label} <> '' GROUP BY ALL)) WHERE r = 1")
    def dominant(s, d, label=_label, score=_score):
        return ck.top_label(fx.pairs(s, d), label, score).select("query_canonical", label, F.round(score, 6).alias(score))


DATASET_COLUMNS = "query_canonical, query_length_chars, query_length_words, click_count, no_click_count, unique_sku_count, dominant_category_id, dominant_brand, quality, is_training_eligible, has_dictionary_brand, has_dictionary_product_family"


@query("q_query_dataset", f"WITH {DATASET} SELECT {DATASET_COLUMNS}, round(category_confidence, 6) AS category_confidence, round(brand_confidence, 6) AS brand_confidence, round(total_evidence_score, 6) AS total_evidence_score, array_to_string(top_skus, ',') AS top_skus, array_to_string(query_original_examples, ',') AS query_original_examples FROM dataset")
def query_dataset(s, d):
    r = lambda c: F.round(c, 6).alias(c)
    return fx.dataset(s, d).select(*DATASET_COLUMNS.split(", "), r("category_confidence"), r("brand_confidence"), r("total_evidence_score"), joined("top_skus"), joined("query_original_examples"))


@query("q_no_click", f"WITH {CLICKS}{NO_CLICK} SELECT query_canonical, array_to_string(query_original_examples, ',') AS query_original_examples, array_to_string(query_normalized_variants, ',') AS query_normalized_variants, no_click_row_count, positive_row_count, has_positive_click FROM no_click")
def no_click(s, d):
    return ck.no_click_queries(fx.clicks(s, d), fx.mapping(s, d)).withColumns({c: F.array_join(c, ",") for c in ("query_original_examples", "query_normalized_variants")})


@query("q_rejects", f"""WITH {DATASET}
    SELECT query_canonical, sku_id, count(*) AS row_count, 'sku_not_found' AS reason FROM clicks JOIN mapping USING (query_original) WHERE position > 0 AND query_canonical <> '' AND sku_id NOT IN (SELECT sku_id FROM catalog) GROUP BY 1, 2
    UNION ALL SELECT '', NULL, count(*), 'empty_after_normalization' FROM clicks JOIN mapping USING (query_original) WHERE query_canonical = '' HAVING count(*) > 0
    UNION ALL SELECT query_canonical, NULL, click_count, CASE WHEN query_length_words > 20 OR query_length_chars > 200 THEN 'outlier_query_length' WHEN dominant_category_id IS NULL THEN 'category_not_found' ELSE 'ambiguous_category' END FROM dataset WHERE NOT is_training_eligible""")
def rejects(s, d):
    return ck.rejects(fx.clicks(s, d), fx.mapping(s, d), fx.catalog(s, d), fx.dataset(s, d))


@query("q_strat_split", f"WITH {SPLIT} SELECT query_canonical, stratum, frequency_bucket, length_bucket, entity_bucket, split FROM split")
def strat_split(s, d):
    return sp.stratified_split(fx.dataset(s, d)).select("query_canonical", "stratum", "frequency_bucket", "length_bucket", "entity_bucket", "split")


@query("q_split_overlap", f"WITH {SPLIT} SELECT count(*) AS split_overlap FROM (SELECT query_canonical FROM split GROUP BY 1 HAVING count(DISTINCT split) > 1)")
def split_overlap(s, d):
    return sp.overlap(sp.stratified_split(fx.dataset(s, d)), "query_canonical")


@query("q_metrics", f"""WITH {DATASET} SELECT (SELECT count(*) FROM clicks) AS n_rows, (SELECT count(*) FROM clicks WHERE position > 0) AS n_positive, (SELECT count(*) FROM clicks WHERE position = 0) AS n_no_click,
    (SELECT count(*) FROM dataset) AS n_queries, (SELECT count(*) FROM dataset WHERE is_training_eligible) AS n_eligible, (SELECT count(*) FROM dataset WHERE quality = 'high_confidence') AS n_high, (SELECT sum(click_count)::BIGINT FROM dataset) AS n_clicks""")
def metrics(s, d):
    position = F.col("position")
    log = fx.clicks(s, d).agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(position > 0).alias("n_positive"), F.count_if(position == 0).alias("n_no_click"))
    made = fx.dataset(s, d).agg(F.count(F.lit(1)).alias("n_queries"), F.count_if("is_training_eligible").alias("n_eligible"), F.count_if(F.col("quality") == "high_confidence").alias("n_high"), F.sum("click_count").alias("n_clicks"))
    return log.withColumn("k", F.lit(0)).join(made.withColumn("k", F.lit(0)), "k").drop("k")


@query("q_purity", """WITH c AS (SELECT l_orderkey, p_type, count(*) AS n FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1, 2), t AS (SELECT l_orderkey, sum(n)::BIGINT AS n_rows, max(n) AS top FROM c GROUP BY 1),
    f AS (SELECT l_orderkey, min(p_type) AS top_label FROM c JOIN t USING (l_orderkey) WHERE n = top GROUP BY 1) SELECT l_orderkey, top_label, n_rows, round(top / n_rows, 6) AS purity FROM t JOIN f USING (l_orderkey) WHERE n_rows >= 5""")
def purity(s, d):
    return ck.purity(table(s, d, "lineitem").join(table(s, d, "part"), F.col("l_partkey") == F.col("p_partkey")).select("l_orderkey", "p_type"), "l_orderkey", "p_type")


@query("q_anti", "SELECT l_orderkey, l_partkey FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size > 10)")
def anti(s, d):
    return table(s, d, "lineitem").select("l_orderkey", "l_partkey").join(table(s, d, "part").filter("p_size > 10").select(F.col("p_partkey").alias("l_partkey")), "l_partkey", "left_anti").select("l_orderkey", "l_partkey")


@query("q_semi", "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')")
def semi(s, d):
    return table(s, d, "orders").select("o_orderkey", "o_orderstatus").join(table(s, d, "lineitem").filter("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey")), "o_orderkey", "left_semi")


# catalog


@query("q_category_path", """WITH RECURSIVE up AS (SELECT p_partkey AS id, nullif(p_partkey // 10, p_partkey) AS parent, p_name AS path, 1 AS depth FROM part UNION ALL SELECT u.id, nullif(c.p_partkey // 10, c.p_partkey), c.p_name || ' > ' || u.path, u.depth + 1 FROM up u JOIN part c ON c.p_partkey = u.parent)
    SELECT id, arg_max(path, depth) AS path, max(depth)::INTEGER AS depth FROM up GROUP BY id""")
def category_path(s, d):
    p = F.col("p_partkey")
    return ct.category_paths(table(s, d, "part").select(p.alias("id"), F.floor(p / 10).alias("parent_id"), F.col("p_name").alias("name")))


@query("q_catalog_flatten", "SELECT p_partkey AS sku_id, trim(regexp_replace(lower(p_name), '[^a-z0-9+./]+', ' ', 'g')) AS catalog_sku_name_normalized, trim(regexp_replace(lower(p_brand), '[^a-z0-9+./]+', ' ', 'g')) AS brand, CASE WHEN p_partkey % 3 = 0 THEN '' ELSE p_type END AS category_id, CASE WHEN p_partkey % 3 <> 0 THEN 'root > ' || p_type END AS category_path FROM part")
def catalog_flatten(s, d):
    part = table(s, d, "part")
    ids = F.when(F.col("p_partkey") % 3 == 0, F.array().cast("array<string>")).otherwise(F.array("p_type", F.lit("other")))
    offers = part.select(F.col("p_partkey").alias("sku_id"), F.col("p_name").alias("name"), F.col("p_brand").alias("brand"), F.lit("m").alias("model"), ids.alias("category_ids"), F.lit(True).alias("available"))
    kinds = part.select(F.col("p_type").alias("id"), F.lit("root").alias("parent_id"), F.col("p_type").alias("name")).distinct().union(s.createDataFrame([("root", None, "root")], "id string, parent_id string, name string"))
    return ct.flatten_items(offers, ct.category_paths(kinds), kinds).select("sku_id", "catalog_sku_name_normalized", "brand", "category_id", "category_path")


@query("q_attr_values", "SELECT sku_id, 'color' AS attribute_name, trim(v) AS attribute_value FROM (SELECT p_partkey AS sku_id, unnest(string_split(lower(replace(p_name, ' ', ' / ')), '/')) AS v FROM part) WHERE trim(v) <> ''")
def attr_values(s, d):
    value = F.replace("p_name", F.lit(" "), F.lit(" / "))
    param = lambda n, v: F.struct(F.lit(n).alias("name"), v.alias("value"), F.lit("").alias("unit"))
    offers = table(s, d, "part").select(F.col("p_partkey").alias("sku_id"), F.array(param("Color_search", value), param("Internal", value)).alias("params"))
    return ct.flatten_attributes(offers).select("sku_id", "attribute_name", "attribute_value")


# text


@query("q_norm_stages", r"""WITH t AS (SELECT doc_id, text AS o, lower(text) AS l FROM documents), p AS (SELECT *, translate(l, '-"''`', '    ') AS sep FROM t)
    SELECT doc_id, o <> l AS changed_lower, l <> sep AS changed_separators, md5(trim(regexp_replace(sep, '\s+', ' ', 'g'))) AS spaces_md5 FROM p""")
def norm_stages(s, d):
    docs = table(s, d, "documents")
    st = tx.stages(F.col("text"))
    return docs.select("doc_id", (F.col("text") != st["lower"]).alias("changed_lower"), (st["lower"] != st["separators"]).alias("changed_separators"), F.md5(st["spaces"].cast("binary")).alias("spaces_md5"))


@query("q_norm_nfkc", r"SELECT doc_id, md5(trim(regexp_replace(replace(lower(text), 'ё', 'е'), '[^\p{L}\p{N}+./]+', ' ', 'g'))) AS normalized_md5 FROM documents")
def norm_nfkc(s, d):
    return table(s, d, "documents").select("doc_id", F.md5(tx.log_normalize(F.col("text")).cast("binary")).alias("normalized_md5"))


@query("q_text_stats", r"SELECT doc_id, length(t) AS n_chars_text, (CASE WHEN t = '' THEN 0 ELSE length(t) - length(replace(t, ' ', '')) + 1 END)::BIGINT AS n_words FROM (SELECT doc_id, trim(regexp_replace(text, '\s+', ' ', 'g')) AS t FROM documents)")
def text_stats(s, d):
    t = tx.collapse(F.col("text"))
    return table(s, d, "documents").select("doc_id", F.length(t).cast("long").alias("n_chars_text"), tx.n_words(t).cast("long").alias("n_words"))


@query("q_script_flags", r"SELECT doc_id, regexp_matches(text, '[0-9]') AS has_digits, regexp_matches(text, '[a-zA-Z]') AS has_latin, regexp_matches(text, '[а-яА-ЯёЁ]') AS has_cyrillic, regexp_matches(text, '[a-zA-Z]') AND regexp_matches(text, '[а-яА-ЯёЁ]') AS is_mixed_language FROM documents")
def script_flags(s, d):
    return table(s, d, "documents").select("doc_id", *[f.alias(n) for n, f in tx.script_flags(F.col("text")).items()])


MAPPING_ROWS = [("Айфон-15  Pro", "айфон 15 pro", "iphone 15 pro", 3, True, True, True, False, True), ("Самсунг S24", "самсунг s24", "samsung s24", 2, True, True, True, True, False), ("эпл вотч", "эпл вотч", "apple watch", 2, False, False, True, True, True), ("Ёлка +5/10", "елка +5/10", "елка +5/10", 2, True, False, True, False, False), ("ﬁ² жсамсунг", "fi2 жсамсунг", "fi2 жсамсунг", 2, True, True, True, False, False)]


def values(rows: list[tuple], columns: str) -> str:
    def lit(v) -> str:
        return "NULL" if v is None else str(v).lower() if isinstance(v, bool) else "'" + v.replace("'", "''") + "'" if isinstance(v, str) else str(v)

    return f"SELECT * FROM (VALUES {', '.join('(' + ', '.join(map(lit, r)) + ')' for r in rows)}) AS t({columns})"


@query("q_query_mapping", values(MAPPING_ROWS, "query_original, query_normalized, query_canonical, query_length_words, has_digits, has_latin, has_cyrillic, has_dictionary_brand, has_dictionary_product_family"))
def query_mapping(s, d):
    made = tx.query_mapping(s.createDataFrame([(r[0],) for r in MAPPING_ROWS] * 2, "query_original string"))
    return made.select("query_original", "query_normalized", "query_canonical", F.col("query_length_words").cast("int").alias("query_length_words"), "has_digits", "has_latin", "has_cyrillic", "has_dictionary_brand", "has_dictionary_product_family")


@query("q_lemma_dedup", """WITH w AS (SELECT p_name, lower(p_name) AS l FROM part), r AS (SELECT p_name, regexp_replace(l, 's( |$)', '\\1', 'g') AS lemma, count(*) AS n FROM w GROUP BY 1, 2)
    SELECT lemma, arg_min(p_name, (-n, p_name)) AS representative, count(*) AS n_variants, sum(n)::BIGINT AS n_rows FROM r GROUP BY lemma""".replace("\\\\1", "\\1"))
def lemma_dedup(s, d):
    part = table(s, d, "part")
    words = part.select(F.explode(F.split(F.lower("p_name"), " ")).alias("token")).distinct()
    known = words.select("token", F.regexp_replace("token", "s$", "").alias("lemma"))
    # the rules protect Latin words, so the table is applied here through a plain map of tokens
    base = part.groupBy(F.col("p_name").alias("original")).agg(F.count(F.lit(1)).alias("n_rows"))
    token = base.select("original", "n_rows", F.posexplode(F.split(F.lower("original"), " ")).alias("pos", "token")).join(known, "token")
    audit = token.groupBy("original", "n_rows").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "lemma"))), lambda x: x["lemma"]), " ").alias("lemma"))
    return lm.deduplicate(audit)


@query("q_corpus_audit", "SELECT lower(p_name) AS lemma, count(DISTINCT p_name) AS n_variants, count(*) AS n_rows FROM part GROUP BY 1")
def corpus_audit(s, d):
    return lm.deduplicate(lm.corpus_audit(table(s, d, "part"), "p_name")).select("lemma", "n_variants", "n_rows")


@query("q_alias_canon", r"SELECT p_partkey, regexp_replace(regexp_replace(lower(p_name), '\bred\b', 'crimson', 'g'), '\bsmall\b', 'tiny', 'g') AS canonical FROM part")
def alias_canon(s, d):
    return table(s, d, "part").select("p_partkey", tx.canonicalize(F.lower("p_name"), {"red": "crimson", "small": "tiny"}).alias("canonical"))


# matching


@query("q_ngram_match", f'WITH {DICTIONARY} SELECT p_partkey, type, value, start, "end", round(confidence, 2) AS confidence FROM matches')
def ngram_match(s, d):
    return mt.dictionary_matches(table(s, d, "part"), "p_partkey", "p_name", fx.dictionary(s, d), 3).select("p_partkey", "type", "value", "start", "end", F.round("confidence", 2).alias("confidence"))


@query("q_ambiguous_surface", "WITH n AS (SELECT split_part(lower(p_name), ' ', 1) AS surface, count(DISTINCT lower(p_brand)) AS n_values FROM part GROUP BY 1) SELECT p_partkey, surface, n_values > 1 AS ambiguous, CASE WHEN n_values > 1 THEN 0.0 ELSE 0.98 END AS confidence FROM part JOIN n ON split_part(lower(p_name), ' ', 1) = surface")
def ambiguous_surface(s, d):
    part = table(s, d, "part")
    entries = part.groupBy(F.split(F.lower("p_name"), " ")[0].alias("pattern"), F.col("p_brand").alias("canonical")).agg(F.count(F.lit(1)).alias("count")).select("pattern", F.lit("brand").alias("entity_type"), F.col("canonical").alias("entity_id"), "canonical", "count", F.lit("catalog").alias("source"))
    return mt.dictionary_matches(part, "p_partkey", "p_name", entries, 2).select("p_partkey", F.lower("surface").alias("surface"), "ambiguous", "confidence")


def _spans(s, d) -> DataFrame:
    found = mt.dictionary_matches(table(s, d, "part"), "p_partkey", "p_name", fx.dictionary(s, d), 3)
    row = F.struct("type", "value", "surface", "start", "end", "confidence", "source")
    return found.groupBy("p_partkey").agg(F.array_sort(F.collect_list(row)).alias("spans")).withColumns(dict(zip(("taken", "lost"), mt.greedy(F.col("spans"), mt.fact_rank()), strict=True)))


@query("q_greedy_spans", "SELECT p_partkey, 'brand:' || w[1] || ',color:' || w[2] AS taken, 1 AS n_lost FROM (SELECT p_partkey, string_split(lower(p_name), ' ') AS w FROM part)")
def greedy_spans(s, d):
    return _spans(s, d).select("p_partkey", F.array_join(F.transform("taken", lambda x: F.concat(x["type"], F.lit(":"), x["value"])), ",").alias("taken"), F.size("lost").alias("n_lost"))


@query("q_bio_tags", "SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN 'B-category I-category' ELSE 'B-brand B-color' END AS tags, true AS all_supervised FROM part")
def bio_tags(s, d):
    spans = _spans(s, d).withColumn("use", F.when(F.col("p_partkey") % 2 == 0, F.filter("spans", lambda x: x["type"] == "category")).otherwise(F.col("taken")))
    rows = spans.join(table(s, d, "part").select("p_partkey", tx.tokens(F.col("p_name")).alias("tokens")), "p_partkey")
    tags, mask = mt.bio(F.col("tokens"), F.col("use"))
    return rows.select("p_partkey", F.array_join(tags, " ").alias("tags"), F.forall(mask, lambda m: m).alias("all_supervised"))


@query("q_gazetteer_scan", f'WITH {DICTIONARY}, b AS (SELECT * FROM matches WHERE type IN (\'brand\', \'category\')) SELECT p_partkey, count(*) AS n_spans, count(DISTINCT type) AS n_types FROM b GROUP BY 1')
def gazetteer_scan(s, d):
    spans = _spans(s, d).select("p_partkey", F.explode(mt.drop_contained(F.filter("spans", lambda x: x["type"].isin("brand", "category")))).alias("x"))
    return spans.groupBy("p_partkey").agg(F.count(F.lit(1)).alias("n_spans"), F.count_distinct("x.type").alias("n_types"))


@query("q_fuzzy_align", """WITH g AS (SELECT p_partkey, string_split(lower(p_name), ' ') AS w, substr(split_part(lower(p_name), ' ', 2), 2) AS wanted FROM part),
    c AS (SELECT p_partkey, wanted, unnest([{'p': w[1], 's': 0}, {'p': w[2], 's': length(w[1]) + 1}, {'p': w[1] || ' ' || w[2], 's': 0}]) AS x FROM g),
    m AS (SELECT p_partkey, wanted, levenshtein(x.p, wanted) AS distance, x.s AS start, x.s + length(x.p) AS e, x.p AS found FROM c WHERE levenshtein(x.p, wanted) <= CASE WHEN length(wanted) <= 3 THEN 0 WHEN length(wanted) <= 6 THEN 1 ELSE 2 END)
    SELECT p_partkey, wanted, distance, start, e AS "end", found FROM (SELECT *, row_number() OVER (PARTITION BY p_partkey, wanted ORDER BY distance, start, e) AS r FROM m) WHERE r = 1""")
def fuzzy_align(s, d):
    part = table(s, d, "part")
    return mt.fuzzy_align(part, part.select("p_partkey", F.substring(F.split("p_name", " ")[1], 2, 100).alias("surface")), "p_partkey", "p_name", "surface", 2)


STOP_ROWS = [("хотеть купить телевизор samsung со скидка", "телевизор samsung", True, False), ("пылесос без мешок до 30000", "пылесос без мешок до 30000", False, False), ("цена смартфон интернет магазин", "смартфон", False, True)]


@query("q_stopwords", values(STOP_ROWS, "lemma, search_text, promotion_intent, price_intent"))
def stopwords(s, d):
    made = an.stopwords(F.col("lemma"))
    return s.createDataFrame([(r[0],) for r in STOP_ROWS], "lemma string").select("lemma", *[made[c].alias(c) for c in ("search_text", "promotion_intent", "price_intent")])


# measurements and colors

MEASURES = [
    (1, 'телевизор Samsung 55"', "телевизоры", '55"', "55", "inch", "screen_diagonal", True, False), (2, "powerbank 5000 мАч", "", "5000 мАч", "5000", "mah", "battery_capacity", True, False),
    (3, "нагреватель 1,5 кВт", "", "1,5 кВт", "1.5", "kw", "power", True, False), (4, "монитор 1920x1080/100 Гц", "", "100 Гц", "100", "hz", "refresh_rate", True, False),
    (5, "утюг RI-C284, 2200 Вт", "", "2200 Вт", "2200", "w", "power", True, False), (6, "генератор 50 Гц", "", "50 Гц", "50", "hz", None, False, False), (7, "ноутбук 16 ГБ", "", "16 ГБ", "16", "gb", None, False, False),
    (8, "оперативная память 16 ГБ", "", "16 ГБ", "16", "gb", "memory_ram", True, False), (9, "встроенная память 256 ГБ", "", "256 ГБ", "256", "gb", "memory_rom", True, False), (10, "Samsung S24", "", "S", "", "s", None, False, True),
    (11, "iPhone 5S", "", "5S", "5", "s", None, False, True), (12, "стол 120x60 см", "", "120x60 см", "120,60", "cm", None, False, False), (13, "вес кг", "", "кг", "", "kg", None, False, False),
]


@query("q_measure_scan", values([(r[0], *r[3:]) for r in MEASURES], "id, surface, numbers, canonical_unit, entity_type, bio_eligible, rejected"))
def measure_scan(s, d):
    rows = s.createDataFrame([r[:3] for r in MEASURES], "id int, text string, hint string")
    found = rows.select("id", F.explode(ms.measurements(F.col("text"), F.col("hint"))).alias("m"))
    return found.select("id", "m.surface", F.array_join("m.numbers", ",").alias("numbers"), "m.canonical_unit", "m.entity_type", "m.bio_eligible", "m.rejected")


@query("q_unit_convert", "SELECT p_partkey, u AS canonical_unit, round(p_size * f, 9) AS base_value, b AS base_unit FROM part, (VALUES ('cm', 0.01, 'm'), ('kg', 1.0, 'kg'), ('inch', 0.0254, 'm'), ('kw', 1000.0, 'w')) AS t(u, f, b) WHERE (p_partkey % 4 = 0 AND u = 'cm') OR (p_partkey % 4 = 1 AND u = 'kg') OR (p_partkey % 4 = 2 AND u = 'inch') OR (p_partkey % 4 = 3 AND u = 'kw')")
def unit_convert(s, d):
    unit = F.element_at(F.array(*[F.lit(u) for u in ("cm", "kg", "inch", "kw")]), (F.col("p_partkey") % 4 + 1).cast("int"))
    return table(s, d, "part").withColumn("canonical_unit", unit).join(F.broadcast(factors(s)), "canonical_unit").select("p_partkey", "canonical_unit", F.round(F.col("p_size") * F.col("factor"), 9).alias("base_value"), "base_unit")


@query("q_unit_usage", """WITH f AS (SELECT p_partkey, p_type AS unit, p_size AS weight, p_size % 2 = 0 AS num, p_brand FROM part), e AS (SELECT p_brand, unit, max(weight) AS w, bool_or(num) AS num, bool_or(NOT num) AS plain FROM f GROUP BY 1, 2)
    SELECT unit, count(*) AS n_queries, sum(w)::BIGINT AS n_rows, count(*) FILTER (WHERE num AND NOT plain) AS only_num, count(*) FILTER (WHERE NOT num) AS only_plain, count(*) FILTER (WHERE num AND plain) AS both FROM e GROUP BY 1""")
def unit_usage(s, d):
    found = table(s, d, "part").select("p_brand", F.col("p_type").alias("unit"), F.col("p_size").alias("weight"), (F.col("p_size") % 2 == 0).alias("num"))
    return pf.unit_usage(found, "p_brand", "unit", "weight", "num")


@query("q_top_examples", "SELECT p_type, p_name, w AS p_size FROM (SELECT *, row_number() OVER (PARTITION BY p_type ORDER BY w DESC, p_name DESC) AS r FROM (SELECT p_type, p_name, max(p_size) AS w FROM part GROUP BY 1, 2)) WHERE r <= 12")
def top_examples(s, d):
    return pf.top_examples(table(s, d, "part"), "p_type", "p_name", "p_size")


COLOR_ROWS = [("Темно-синий", "blue", "color_anchor"), ("черный/белый", "multicolor", "multiple_color_anchors"), ("розовое золото", "gold", "phrase_override"), ("Зелёная", "green", "color_anchor"), ("дерево", None, "no_safe_anchor"), ("--", None, "empty")]


@query("q_color_classify", values(COLOR_ROWS, "value, color_id, mapping_reason"))
def color_classify(s, d):
    rows = s.createDataFrame([(r[0],) for r in COLOR_ROWS], "value string")
    return co.classify_values(rows, "value", co.seed_aliases(s)).select("value", "color_id", "mapping_reason")


@query("q_color_canon", f'WITH {DICTIONARY} SELECT p_partkey, w[1] || \' <\' || w[2] || \'>\' AS canonical FROM p')
def color_canon(s, d):
    spans = _spans(s, d).withColumn("use", F.transform(F.filter("taken", lambda x: x["type"] == "color"), lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), F.concat(F.lit("<"), x["value"], F.lit(">")).alias("value"))))
    return spans.join(table(s, d, "part").select("p_partkey", F.lower("p_name").alias("t")), "p_partkey").select("p_partkey", co.canonical_text(F.col("t"), F.col("use")).alias("canonical"))


ANNOTATED = [
    ("хочу купить телевизор Samsung темно-синий 55 дюймов 120 Гц", "category:телевизор,brand:samsung,color:синий,screen_diagonal:55 inch,refresh_rate:120 hz", ""),
    ("купить стол 120x60 см коричневый", "measurement:120 60 cm,color:коричневый", ""),
    ("дрель black decker 500 вт", "brand:black+decker,power:500 w", ""),
    ("ноутбук HP 16 ГБ серый", "brand:hp,measurement:16 gb,color:серый", "generic_measurement_requires_model_context"),
    ("   ", "", "empty_query"),
]


@query("q_annotate", values([(i, *r[1:]) for i, r in enumerate(ANNOTATED)], "id, entities, warnings"))
def annotate(s, d):
    entries = [("samsung", "brand", "b1", "samsung", 900, "catalog"), ("hp", "brand", "b2", "hp", 400, "catalog"), ("black decker", "brand", "b3", "black+decker", 90, "catalog"), ("см", "brand", "b4", "см", 10, "catalog"), ("телевизор", "category", "c1", "телевизор", 50, "catalog")]
    colors = co.seed_aliases(s).select(F.col("normalized").alias("pattern"), F.lit("color").alias("entity_type"), F.col("color_id").alias("entity_id"), "canonical", F.lit(0).alias("count"), F.lit("manual").alias("source"))
    words = s.createDataFrame(entries, "pattern string, entity_type string, entity_id string, canonical string, count int, source string").unionByName(colors)
    rows = s.createDataFrame([(i, r[0]) for i, r in enumerate(ANNOTATED)], "id int, text string")
    out = an.annotate(rows, "id", "text", words, 3, brands={"hp": 400})
    return out.select("id", F.array_join(F.transform("entities", lambda x: F.concat(x["type"], F.lit(":"), x["value"])), ",").alias("entities"), F.array_join("warnings", ",").alias("warnings"))


# labeling


@query("q_typed_attrs", values([("iphone 256 гб f2v9гц", "256 гб", "memory", "256 гб"), ("телевизор 55 дюймов 120гц", "55 дюймов", "diagonal", "55 дюймов"), ("телевизор 55 дюймов 120гц", "120гц", "refresh", "120 гц")], "query, text, attr_type, value"))
def typed_attrs(s, d):
    rows = s.createDataFrame([("iphone 256 гб f2v9гц",), ("телевизор 55 дюймов 120гц",), ("пылесос 12",)], "query string")
    return rows.select("query", F.explode(lb.number_units(F.col("query"))).alias("m")).select("query", "m.text", "m.attr_type", "m.value")


@query("q_bare_numbers", values([("iphone 256", "iPhone", "memory", 256), ("телевизор 55", "Телевизоры", "diagonal", 55)], "query, category, attr_type, number"))
def bare_numbers(s, d):
    rows = s.createDataFrame([("iphone 256", "iPhone"), ("iphone 16", "iPhone"), ("телевизор 55", "Телевизоры"), ("s256b", "iPhone"), ("iphone 256 гб", "iPhone")], "query string, category string")
    known = s.createDataFrame([("iPhone", "memory", 256), ("iPhone", "memory", 16), ("Телевизоры", "diagonal", 55)], "category string, attr_type string, number long")
    return lb.bare_numbers(rows, "query", "category", known).select("query", "category", "attr_type", F.col("number").cast("int").alias("number"))


@query("q_click_labels", """WITH r AS (SELECT l_orderkey AS q, p_type, p_brand FROM lineitem JOIN part ON p_partkey = l_partkey), z AS (SELECT q, count(*) AS n_clicks FROM r GROUP BY 1 HAVING count(*) >= 3),
    c AS (SELECT q, p_type, count(*) AS n FROM r GROUP BY 1, 2), ct AS (SELECT q, sum(n) AS t, max(n) AS m FROM c GROUP BY 1), cl AS (SELECT q, min(p_type) AS label, max(m) / max(t) AS p FROM c JOIN ct USING (q) WHERE n = m GROUP BY 1),
    b AS (SELECT q, p_brand, count(*) AS n FROM r GROUP BY 1, 2), bt AS (SELECT q, sum(n) AS t, max(n) AS m FROM b GROUP BY 1), bl AS (SELECT q, min(p_brand) AS label, max(m) / max(t) AS p FROM b JOIN bt USING (q) WHERE n = m GROUP BY 1)
    SELECT z.q, n_clicks, cl.label AS category_label, round(cl.p, 6) AS category_purity, CASE WHEN bl.p >= 0.6 THEN bl.label END AS brand_label, CASE WHEN bl.p >= 0.6 THEN round(bl.p, 6) END AS brand_purity FROM z JOIN cl USING (q) JOIN bl USING (q) WHERE round(cl.p, 6) >= 0.6""")
def click_labels(s, d):
    rows = table(s, d, "lineitem").join(table(s, d, "part"), F.col("l_partkey") == F.col("p_partkey")).select(F.col("l_orderkey").alias("q"), "p_type", "p_brand")
    kinds = table(s, d, "part").select(F.col("p_type").alias("category_label")).distinct()
    return lb.click_labels(rows.withColumn("q", F.col("q").cast("string")), "q", "p_type", "p_brand", kinds, 3, 0.6).select(F.col("q").cast("long").alias("q"), "n_clicks", "category_label", "category_purity", "brand_label", "brand_purity")


@query("q_merge_brand_rules", """WITH r AS (SELECT p_partkey AS id, CASE WHEN p_partkey % 3 <> 0 THEN lower(p_brand) END AS c, CASE WHEN p_partkey % 3 <> 0 THEN p_size / 50.0 END AS p, CASE p_partkey % 4 WHEN 0 THEN [lower(p_brand)] WHEN 1 THEN ['zz', 'a b'] ELSE [] END AS g FROM part),
    a AS (SELECT *, c IS NOT NULL AND len(g) > 0 AND len(list_filter(g, lambda x: contains(x, c) OR contains(c, x))) > 0 AS agree FROM r),
    b AS (SELECT *, CASE WHEN agree THEN 'high' WHEN c IS NOT NULL AND len(g) = 0 THEN CASE WHEN p >= 0.9 THEN 'high' WHEN p >= 0.7 THEN 'medium' ELSE 'low' END WHEN c IS NULL AND len(g) > 0 THEN 'medium' END AS brand_confidence FROM a),
    t AS (SELECT *, CASE WHEN c IS NOT NULL AND len(g) > 0 AND NOT agree THEN 'golden_conflict' WHEN brand_confidence = 'low' THEN 'golden_low' ELSE 'train' END AS route FROM b)
    SELECT id, brand_confidence, route, CASE WHEN route = 'train' THEN CASE WHEN c IS NOT NULL THEN c ELSE g[1] END END AS brand_final FROM t""")
def merge_brand_rules(s, d):
    p = F.col("p_partkey")
    none = F.array().cast("array<string>")
    rows = table(s, d, "part").select(p.alias("id"), F.when(p % 3 != 0, F.lower("p_brand")).alias("click_brand"), F.when(p % 3 != 0, F.col("p_size") / 50.0).alias("click_purity"), F.when(p % 4 == 0, F.array(F.lower("p_brand"))).when(p % 4 == 1, F.array(F.lit("zz"), F.lit("a b"))).otherwise(none).alias("gazetteer_brands"))
    return lb.merge_brand(rows).select("id", "brand_confidence", "route", "brand_final")


@query("q_category_by_name", "WITH n AS (SELECT p_partkey, count(DISTINCT c) AS k, min(c) AS c FROM part JOIN (SELECT DISTINCT split_part(lower(p_name), ' ', 1) AS c FROM part) ON list_contains(string_split(lower(p_name), ' '), c) GROUP BY 1) SELECT p_partkey, c AS category_label FROM n WHERE k = 1")
def category_by_name(s, d):
    part = table(s, d, "part")
    words = F.split(F.lower("p_name"), " ")
    names = part.select(words[0].alias("category"), F.array(words[0]).alias("name_tokens")).distinct()
    return lb.category_by_name(part.select("p_partkey", words.alias("tokens")), "p_partkey", "tokens", names)


SYNTHETIC = """WITH b AS (SELECT p_type AS category, p_brand AS brand FROM (SELECT p_type, p_brand, row_number() OVER (PARTITION BY p_type ORDER BY count(*) DESC, p_brand) AS r FROM part GROUP BY 1, 2) WHERE r <= 5),
    a AS (SELECT p_type AS category, attr FROM (SELECT p_type, split_part(p_name, ' ', 2) AS attr, row_number() OVER (PARTITION BY p_type ORDER BY count(*) DESC, split_part(p_name, ' ', 2)) AS r FROM part GROUP BY 1, 2) WHERE r <= 3), s AS (SELECT DISTINCT p_type AS category, lower(p_type) AS surface FROM part),
    q AS (SELECT category, surface || ' ' || brand AS query_text, brand, NULL AS attr FROM s JOIN b USING (category) UNION ALL SELECT category, brand || ' ' || surface, brand, NULL FROM s JOIN b USING (category) UNION ALL SELECT category, surface || ' ' || attr, NULL, attr FROM s JOIN a USING (category) UNION ALL SELECT category, brand || ' ' || surface || ' ' || attr, brand, attr FROM s JOIN b USING (category) JOIN a USING (category)),
    u AS (SELECT category, query_text, min(brand) AS brand_label, min(attr) AS attr_label FROM q GROUP BY 1, 2)
    SELECT category, query_text, brand_label, attr_label FROM (SELECT *, row_number() OVER (PARTITION BY category ORDER BY md5(query_text || '|17'), query_text) AS r FROM u) WHERE r <= 20"""


@query("q_synthetic_queries", SYNTHETIC)
def synthetic_queries(s, d):
    part = table(s, d, "part")

    def top(column, name: str, k: int) -> DataFrame:
        n = part.groupBy(F.col("p_type").alias("category"), column.alias(name)).agg(F.count(F.lit(1)).alias("n"))
        return sm.top_per_group(n, "category", [F.col("n").desc(), F.col(name)], k).select("category", name)

    surfaces = part.select(F.col("p_type").alias("category"), F.lower("p_type").alias("surface")).distinct()
    return lb.synthetic_queries(top(F.col("p_brand"), "brand", 5), top(F.split("p_name", " ")[1], "attr", 3), surfaces, 20)


@query("q_entity_combos", "SELECT CASE WHEN quality = 1 AND toxic = 1 THEN 'quality+toxic' WHEN quality = 1 THEN 'quality' WHEN toxic = 1 THEN 'toxic' ELSE '(none)' END AS combination, count(*) AS n_examples FROM labels GROUP BY 1")
def entity_combos(s, d):
    tags = F.array(F.when(F.col("quality") == 1, "B-quality").otherwise("O"), F.when(F.col("toxic") == 1, "B-toxic").otherwise("O"))
    return lb.entity_combinations(table(s, d, "labels").withColumn("tags", tags), "tags")


@query("q_ner_f1", """WITH g AS (SELECT DISTINCT l_orderkey, l_returnflag AS type, l_linenumber AS start FROM lineitem WHERE l_quantity > 10), p AS (SELECT DISTINCT l_orderkey, l_returnflag AS type, l_linenumber AS start FROM lineitem WHERE l_quantity < 40),
    j AS (SELECT coalesce(g.type, p.type) AS type, g.type IS NOT NULL AS hg, p.type IS NOT NULL AS hp FROM g FULL JOIN p ON g.l_orderkey = p.l_orderkey AND g.type = p.type AND g.start = p.start)
    SELECT type, count(*) FILTER (WHERE hg AND hp) AS tp, count(*) FILTER (WHERE hg) AS n_gold, count(*) FILTER (WHERE hp) AS n_predicted, round(count(*) FILTER (WHERE hg AND hp) / count(*) FILTER (WHERE hp), 6) AS precision, round(count(*) FILTER (WHERE hg AND hp) / count(*) FILTER (WHERE hg), 6) AS recall,
    round(2 * count(*) FILTER (WHERE hg AND hp) / (count(*) FILTER (WHERE hg) + count(*) FILTER (WHERE hp)), 6) AS f1 FROM j GROUP BY type""")
def ner_f1(s, d):
    spans = table(s, d, "lineitem").select("l_orderkey", F.col("l_returnflag").alias("type"), F.col("l_linenumber").alias("start"), "l_quantity")
    return ev.span_scores(spans.filter("l_quantity > 10"), spans.filter("l_quantity < 40"), ["l_orderkey", "type", "start"], ["type"])


# silver

POOL = DATASET + """, g AS (SELECT *, CASE WHEN category_confidence >= 0.9 AND click_count >= 5 THEN 0 ELSE 1 END AS eligibility_tier, md5(query_canonical || '|42') AS sample_hash, substr(query_canonical, 1, 4) AS lemma FROM dataset WHERE category_confidence >= 0.8 AND click_count >= 3 AND dominant_category_id IS NOT NULL),
    a AS (SELECT lemma, min(eligibility_tier) AS eligibility_tier FROM (SELECT lemma, eligibility_tier FROM g GROUP BY 1, 2 HAVING count(DISTINCT dominant_category_id) = 1) GROUP BY 1),
    u AS (SELECT *, row_number() OVER (PARTITION BY lemma ORDER BY category_confidence DESC, click_count DESC, sample_hash) AS r FROM g JOIN a USING (lemma, eligibility_tier)), pool AS (SELECT * FROM u WHERE r = 1 ORDER BY eligibility_tier, sample_hash LIMIT 50)"""
POOL = POOL.replace("substr(query_canonical, 1, 4)", "query_canonical")


def _pool(s, d) -> DataFrame:
    return sv.pool(fx.dataset(s, d).withColumn("lemma", F.col("query_canonical")), "lemma", 50)


@query("q_silver_pool", f"WITH {POOL} SELECT query_canonical, dominant_category_id, eligibility_tier, sample_hash, substr(sha256(query_canonical), 1, 24) AS silver_id FROM pool")
def silver_pool(s, d):
    return _pool(s, d).select("query_canonical", "dominant_category_id", "eligibility_tier", "sample_hash", sv.silver_id("query_canonical").alias("silver_id"))


@query("q_silver_grade", f"WITH {DATASET} SELECT query_canonical, CASE WHEN category_confidence >= 0.95 AND click_count >= 5 THEN 'A' WHEN category_confidence >= 0.9 AND click_count >= 5 THEN 'B' ELSE 'C' END AS grade FROM dataset WHERE category_confidence >= 0.8 AND click_count >= 3")
def silver_grade(s, d):
    return fx.dataset(s, d).filter("category_confidence >= 0.8 AND click_count >= 3").select("query_canonical", sv.grade().alias("grade"))


@query("q_silver_candidates", f"""WITH {PAIRS}, sr AS (SELECT *, row_number() OVER (PARTITION BY query_canonical ORDER BY evidence_score DESC, sku_id) AS k FROM pairs), sc AS (SELECT query_canonical, model, round(sum(evidence_score), 9) AS score FROM sr WHERE k <= 10 AND trim(model) <> '' GROUP BY 1, 2),
    rk AS (SELECT *, round(score / nullif(sum(score) OVER (PARTITION BY query_canonical), 0), 6) AS confidence, row_number() OVER (PARTITION BY query_canonical ORDER BY score DESC, model) AS candidate_rank FROM sc) SELECT query_canonical, model, round(score, 6) AS score, confidence, candidate_rank FROM rk WHERE candidate_rank <= 10""")
def silver_candidates(s, d):
    pairs = fx.pairs(s, d)
    return sv.share_candidates(sv.best_items(pairs, pairs.select("query_canonical").distinct()), ["query_canonical"], "model").select("query_canonical", "model", F.round("score", 6).alias("score"), "confidence", "candidate_rank")


@query("q_attribute_candidates", f"""WITH {PAIRS}, sr AS (SELECT *, row_number() OVER (PARTITION BY query_canonical ORDER BY evidence_score DESC, sku_id) AS k FROM pairs),
    av AS (SELECT p_partkey AS sku_id, CASE WHEN p_partkey % 2 = 0 THEN 'color' ELSE 'material' END AS entity_type, split_part(p_name, ' ', 1) AS attribute_value FROM part),
    sc AS (SELECT query_canonical, entity_type, attribute_value, round(sum(evidence_score), 9) AS score FROM sr JOIN av USING (sku_id) WHERE k <= 10 GROUP BY ALL),
    rk AS (SELECT *, round(score / nullif(sum(score) OVER (PARTITION BY query_canonical, entity_type), 0), 6) AS confidence, row_number() OVER (PARTITION BY query_canonical, entity_type ORDER BY score DESC, attribute_value) AS candidate_rank FROM sc) SELECT query_canonical, entity_type, attribute_value, confidence FROM rk WHERE candidate_rank <= 10 AND confidence >= 0.8""")
def attribute_candidates(s, d):
    pairs = fx.pairs(s, d)
    attributes = table(s, d, "part").select(F.col("p_partkey").alias("sku_id"), F.when(F.col("p_partkey") % 2 == 0, "цвет").otherwise("материал").alias("attribute_name"), F.split("p_name", " ")[0].alias("attribute_value"))
    return sv.attribute_candidates(sv.best_items(pairs, pairs.select("query_canonical").distinct()), attributes).select("query_canonical", "entity_type", "attribute_value", "confidence")


@query("q_review_sample", """WITH g AS (SELECT p_partkey, 0 AS review_priority FROM part ORDER BY md5(p_partkey || '|42'), p_partkey LIMIT 30), x AS (SELECT p_partkey, 1 AS review_priority FROM part WHERE p_size > 25 ORDER BY md5(p_partkey || '|42'), p_partkey LIMIT 20),
    y AS (SELECT p_partkey, 2 AS review_priority FROM part WHERE p_size <= 25 ORDER BY md5(p_partkey || '|42'), p_partkey LIMIT 20), u AS (SELECT p_partkey, min(review_priority) AS review_priority FROM (SELECT * FROM g UNION ALL SELECT * FROM x UNION ALL SELECT * FROM y) GROUP BY 1)
    SELECT p_partkey, review_priority FROM u ORDER BY review_priority, md5(p_partkey || '|42'), p_partkey LIMIT 50""")
def review_sample(s, d):
    rows = table(s, d, "part").select("p_partkey", F.array(F.when(F.col("p_size") > 25, "large").otherwise("small")).alias("types"))
    return sv.review_sample(rows, "p_partkey", "types", ["large", "small"], 30, 20, 50).select("p_partkey", "review_priority")


@query("q_entity_audit", """WITH e AS (SELECT p_type AS type, p_retailprice AS c, p_partkey AS x FROM part), f AS (SELECT type, x, row_number() OVER (PARTITION BY type ORDER BY md5(x || '|42'), x) AS r FROM (SELECT DISTINCT type, x FROM e)), g AS (SELECT type, string_agg(CAST(x AS VARCHAR), '|' ORDER BY r) AS examples FROM f WHERE r <= 8 GROUP BY 1)
    SELECT type, count(*) AS n_entities, round(min(c), 6) AS min_confidence, round(avg(c), 6) AS avg_confidence, any_value(examples) AS examples FROM e JOIN g USING (type) GROUP BY type""")
def entity_audit(s, d):
    return sv.entity_audit(table(s, d, "part").select(F.col("p_type").alias("type"), "p_retailprice", "p_partkey"), "type", "p_retailprice", "p_partkey")


# sampling and splits


@query("q_hash_sample", "SELECT c_custkey, c_name FROM customer ORDER BY md5(c_custkey || '|42'), c_custkey LIMIT 100")
def hash_sample(s, d):
    return sm.hash_sample(table(s, d, "customer").select("c_custkey", "c_name"), "c_custkey", 100)


@query("q_weighted_sample", "SELECT c_custkey FROM (SELECT c_custkey, ((('0x' || substr(md5(c_custkey || '|42'), 1, 12))::BIGINT)::DOUBLE + 0.5) / 281474976710656.0 AS u, ln(1 + greatest(c_acctbal, 0)) AS w FROM customer) WHERE w > 0 ORDER BY -ln(u) / w, c_custkey LIMIT 100")
def weighted_sample(s, d):
    return sm.weighted_sample(table(s, d, "customer"), "c_custkey", "c_acctbal", 100).select("c_custkey")


@query("q_quota_sample", """WITH r AS (SELECT c_custkey, c_mktsegment, md5(c_custkey || '|42') AS h, row_number() OVER (PARTITION BY c_mktsegment ORDER BY md5(c_custkey || '|42'), c_custkey) AS k FROM customer)
    SELECT c_custkey, c_mktsegment, k > CASE c_mktsegment WHEN 'BUILDING' THEN 25 WHEN 'MACHINERY' THEN 15 ELSE 0 END AS refill FROM r ORDER BY refill, h, c_custkey LIMIT 60""")
def quota_sample(s, d):
    return sm.quota_sample(table(s, d, "customer").select("c_custkey", "c_mktsegment"), "c_mktsegment", "c_custkey", {"BUILDING": 25, "MACHINERY": 15}, 60)


@query("q_bucket_sample", "SELECT c_custkey, CASE WHEN c_acctbal > 5000 THEN 'rich' WHEN c_nationkey < 5 THEN 'near' ELSE 'rest' END AS bucket FROM customer")
def bucket_sample(s, d):
    c = table(s, d, "customer").select("c_custkey", "c_acctbal", "c_nationkey")
    return sm.first_bucket_wins([("rich", c.filter("c_acctbal > 5000")), ("near", c.filter("c_nationkey < 5")), ("rest", c)], "c_custkey").select("c_custkey", "bucket")


@query("q_group_split", "SELECT c_custkey, CASE WHEN ('0x' || substr(md5(c_nationkey || '|42'), 1, 8))::BIGINT % 100 < 15 THEN 'valid' ELSE 'train' END AS split FROM customer")
def group_split(s, d):
    return sp.hash_group_split(table(s, d, "customer"), "c_nationkey").select("c_custkey", "split")


@query("q_shards", "SELECT c_custkey, ((row_number() OVER (ORDER BY c_custkey) - 1) % 5)::INTEGER AS shard FROM customer")
def shards(s, d):
    return sp.round_robin_shard(table(s, d, "customer").select("c_custkey"), "c_custkey", 5)


@query("q_topk_list", "SELECT o_custkey, array_to_string(list_slice(list(CAST(o_orderkey AS VARCHAR) ORDER BY o_totalprice DESC, o_orderkey), 1, 10), ',') AS top_orders FROM orders GROUP BY 1")
def topk_list(s, d):
    rows = table(s, d, "orders").select(F.col("o_custkey").alias("query_canonical"), F.col("o_totalprice").alias("evidence_score"), F.lit(0).alias("click_count"), F.col("o_orderkey").alias("sku_id"))
    return ck.top_items(rows, "top").select(F.col("query_canonical").alias("o_custkey"), F.array_join("top", ",").alias("top_orders"))


@query("q_window_share", "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(l_extendedprice / nullif(sum(l_extendedprice) OVER (PARTITION BY l_orderkey), 0), 6) AS share FROM lineitem")
def window_share(s, d):
    total = F.sum("l_extendedprice").over(Window.partitionBy("l_orderkey"))
    return table(s, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.round(F.col("l_extendedprice") / F.nullif(total, F.lit(0.0)), 6).alias("share"))


# profiles


@query("q_percentiles", "SELECT count(o_totalprice) AS n, round(avg(o_totalprice), 6) AS mean, min(o_totalprice) AS min, round(quantile_cont(o_totalprice, 0.25), 6) AS p25, round(quantile_cont(o_totalprice, 0.5), 6) AS p50, round(quantile_cont(o_totalprice, 0.75), 6) AS p75, round(quantile_cont(o_totalprice, 0.9), 6) AS p90, round(quantile_cont(o_totalprice, 0.99), 6) AS p99, max(o_totalprice) AS max FROM orders")
def percentiles(s, d):
    return pf.percentiles(table(s, d, "orders"), "o_totalprice")


@query("q_describe", " UNION ALL ".join(f"SELECT '{c}' AS \"column\", count(*) AS n_rows, count(*) FILTER (WHERE {c} IS NULL) AS n_null, count(*) FILTER (WHERE trim(CAST({c} AS VARCHAR)) = '') AS n_blank, count(DISTINCT {c}) AS n_distinct FROM documents" for c in ("text", "lang", "source", "n_chars")))
def describe(s, d):
    return pf.completeness(table(s, d, "documents"), ["text", "lang", "source", "n_chars"])


@query("q_histogram", "SELECT CASE WHEN l_quantity >= 40 THEN 3 WHEN l_quantity >= 20 THEN 2 WHEN l_quantity >= 10 THEN 1 WHEN l_quantity >= 5 THEN 0 ELSE -1 END AS bin, count(*) AS n FROM lineitem GROUP BY 1")
def histogram(s, d):
    return pf.histogram(table(s, d, "lineitem"), "l_quantity", [5, 10, 20, 40])


@query("q_dup_stats", "SELECT sum(n)::BIGINT AS n_rows, count(*) AS n_keys, sum(n - 1)::BIGINT AS n_duplicates, count(*) FILTER (WHERE n > 1) AS n_repeated_keys FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)")
def dup_stats(s, d):
    return pf.duplicates(table(s, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("q_pair_repeats", "SELECT sum(n)::BIGINT AS n_rows, count(*) AS n_keys, sum(n - 1)::BIGINT AS n_duplicates, count(*) FILTER (WHERE n > 1) AS n_repeated_keys FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_partkey, l_suppkey)")
def pair_repeats(s, d):
    return pf.duplicates(table(s, d, "lineitem"), ["l_partkey", "l_suppkey"])


@query("q_value_counts", "SELECT p_brand, count(*) AS n FROM part GROUP BY 1 ORDER BY n DESC, p_brand LIMIT 10")
def value_counts(s, d):
    return pf.value_counts(table(s, d, "part"), "p_brand", 10)


@query("q_overlap_stats", "WITH a AS (SELECT DISTINCT l_suppkey AS k FROM lineitem WHERE l_returnflag = 'R'), b AS (SELECT DISTINCT l_suppkey AS k FROM lineitem WHERE l_quantity > 49) SELECT count(a.k) AS n_a, count(b.k) AS n_b, count(*) FILTER (WHERE a.k IS NOT NULL AND b.k IS NOT NULL) AS n_both, count(*) FILTER (WHERE b.k IS NULL) AS n_only_a, count(*) FILTER (WHERE a.k IS NULL) AS n_only_b FROM a FULL JOIN b ON a.k = b.k")
def overlap_stats(s, d):
    rows = table(s, d, "lineitem")
    return pf.overlap_counts(rows.filter("l_returnflag = 'R'"), rows.filter("l_quantity > 49"), "l_suppkey")


@query("q_json_props", "SELECT event_type, sum(CAST(json_extract_string(props, '$.k') AS BIGINT))::BIGINT AS k_sum, count(*) AS n FROM events GROUP BY 1")
def json_props(s, d):
    return table(s, d, "events").select("event_type", F.from_json("props", "k bigint")["k"].alias("k")).groupBy("event_type").agg(F.sum("k").alias("k_sum"), F.count(F.lit(1)).alias("n"))


@query("q_brand_literal", "SELECT l_orderkey, l_partkey, l_linenumber, contains(lower(p_name), lower(split_part(p_name, ' ', 2))) AS brand_literal_match, contains(lower(p_name), lower(p_brand)) AS full_brand_match FROM lineitem JOIN part ON p_partkey = l_partkey")
def brand_literal(s, d):
    name = F.lower("p_name")
    return table(s, d, "lineitem").join(table(s, d, "part"), F.col("l_partkey") == F.col("p_partkey")).select("l_orderkey", "l_partkey", "l_linenumber", F.contains(name, F.lower(F.split("p_name", " ")[1])).alias("brand_literal_match"), F.contains(name, F.lower("p_brand")).alias("full_brand_match"))


def flagship(s, d) -> DataFrame:
    """Click evidence to dominant category, confidence and quality of each query."""
    return query_dataset(s, d)


from quern.plans import corpus_queries  # noqa: E402, F401  registers its queries
