"""Text normalizers, tokenizers and predicates as Column functions.

Two normalizers stay apart: ``log_normalize`` for click logs (keeps ``+ . /``) and ``stages`` for the corpus. Only Unicode NFKC has no Spark
built-in; it runs as an Arrow UDF, and only for texts that are not plain ASCII. Offsets are code points throughout.
"""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Separators that become spaces in the corpus normalizer, dashes of the log normalizer, spaces that Java's (?U)\s leaves out.
HYPHENS_QUOTES = "-­֊־‐‑‒–—―−﹘﹣－\"'`«»‘’‚‛“”„‟‹›"
SPACE = r"(?U)[\s\x1c-\x1f]+"

OPEN, CLOSE = "\x01", "\x02"  # marks that no normalized text contains

#: Aliases of brands and product families.
BRAND_ALIASES = {"самсунг": "samsung", "эпл": "apple", "сяоми": "xiaomi", "ксиаоми": "xiaomi", "хуавей": "huawei", "хонор": "honor", "реалми": "realme", "леново": "lenovo", "асус": "asus", "эйсер": "acer", "бош": "bosch", "филипс": "philips"}
FAMILY_ALIASES = {"айфон": "iphone", "айпад": "ipad", "макбук": "macbook", "аирподс": "airpods", "эпл вотч": "apple watch", "плейстейшен": "playstation", "иксбокс": "xbox"}
FAMILY_TO_BRAND = {"iphone": "apple", "ipad": "apple", "macbook": "apple", "airpods": "apple", "apple watch": "apple", "playstation": "sony", "xbox": "microsoft"}


@F.pandas_udf(T.StringType())
def _nfkc(s: pd.Series) -> pd.Series:
    return s.map(lambda v: None if v is None else unicodedata.normalize("NFKC", v))


def nfkc(c: Column) -> Column:
    """NFKC form. ASCII is its own; the UDF sees it as null, so its cost is that of the other texts."""
    plain = c.rlike(r"^[\x00-\x7f]*$")
    return F.when(plain, c).otherwise(_nfkc(F.when(~plain, c)))


def yo(c: Column) -> Column:
    return F.translate(c, "ёЁ", "еЕ")


def collapse(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, SPACE, " "))


def separators(c: Column) -> Column:
    return F.translate(c, HYPHENS_QUOTES, " " * len(HYPHENS_QUOTES))


def log_normalize(c: Column) -> Column:
    """NFKC, lower case, ё as е, everything but letters, numbers and ``+ . /`` to single spaces. Null gives the empty string."""
    return collapse(F.regexp_replace(yo(F.lower(nfkc(F.coalesce(c, F.lit(""))))), r"[^\p{L}\p{N}+./]+", " "))


def canonicalize(c: Column, aliases: dict[str, str] | None = None) -> Column:
    """Replace whole-word aliases, the longest at each place, in one pass over the text.

    Every alias is marked at its place by one alternation; the marks are then exchanged one by one, so no replacement is matched again.
    """
    known = sorted((aliases or {**BRAND_ALIASES, **FAMILY_ALIASES}).items(), key=lambda kv: (-len(kv[0]), kv[0]))
    out = F.regexp_replace(c, r"(?U)(?<!\w)(" + "|".join(k.replace(".", r"\.").replace("+", r"\+") for k, _ in known) + r")(?!\w)", OPEN + "$1" + CLOSE)
    for alias, target in known:
        out = F.replace(out, F.lit(OPEN + alias + CLOSE), F.lit(target))
    return out


def stages(c: Column, lemma=None) -> dict[str, Column]:
    """The corpus stages by name. ``lemma`` maps the spaces stage to its lemma text; the default keeps tokens as they are."""
    out = {"original": c}
    out["nfkc"] = nfkc(c)
    out["yo_equal_e"] = yo(out["nfkc"])
    out["lower"] = F.lower(out["yo_equal_e"])
    out["separators"] = separators(out["lower"])
    out["spaces"] = collapse(out["separators"])
    out["lemma"] = yo(lemma(out["spaces"])) if lemma else out["spaces"]
    return out


def model_text(c: Column) -> Column:
    """NFKC with control and format characters and spaces collapsed; case and punctuation stay. Spans refer to this text."""
    return F.trim(F.regexp_replace(nfkc(c), r"(?U)[\p{Cc}\p{Cf}\s\x1c-\x1f]+", " "))


def words(c: Column) -> Column:
    """Runs of letters and digits."""
    return F.regexp_extract_all(c, F.lit(r"[\p{L}\p{N}]+"), F.lit(0))


def tokens(c: Column) -> Column:
    """Words with their code-point spans: array<struct<text,start,end>>, in one pass that alternates gaps and words."""
    parts = F.regexp_extract_all(c, F.lit(r"[\p{L}\p{N}]+|[^\p{L}\p{N}]+"), F.lit(0))
    empty = F.array().cast("array<struct<text:string,start:int,end:int>>")
    start = F.struct(F.lit(0).alias("at"), empty.alias("out"))

    def step(acc: Column, part: Column) -> Column:
        end = acc["at"] + F.length(part)
        token = F.struct(F.lower(part).alias("text"), acc["at"].alias("start"), end.alias("end"))
        return F.struct(end.alias("at"), F.when(part.rlike(r"^[\p{L}\p{N}]"), F.concat(acc["out"], F.array(token))).otherwise(acc["out"]).alias("out"))

    return F.aggregate(parts, start, step, lambda acc: acc["out"])


def n_words(c: Column) -> Column:
    """Words of a collapsed text, by its spaces."""
    return F.when(c == "", 0).otherwise(F.length(c) - F.length(F.replace(c, F.lit(" "), F.lit(""))) + 1)


def script_flags(c: Column) -> dict[str, Column]:
    latin, cyrillic = c.rlike("[a-zA-Z]"), c.rlike("[а-яА-ЯёЁ]")
    return {"has_digits": c.rlike(r"(?U)\d"), "has_latin": latin, "has_cyrillic": cyrillic, "is_mixed_language": latin & cyrillic}


def query_mapping(queries, column: str = "query_original"):
    """One row per distinct raw query with its normalized and canonical forms, lengths and flags."""
    distinct = queries.select(F.col(column).alias("query_original")).filter("query_original IS NOT NULL").distinct()
    normal = distinct.withColumn("query_normalized", log_normalize(F.col("query_original")))
    text = F.col("query_normalized")
    brand = r"(?U)(?<!\w)(" + "|".join([*BRAND_ALIASES, *sorted(set(BRAND_ALIASES.values()))]) + r")(?!\w)"
    family = r"(?U)(?<!\w)(" + "|".join([*FAMILY_ALIASES, *sorted(set(FAMILY_ALIASES.values()))]) + r")(?!\w)"
    return normal.withColumn("query_canonical", canonicalize(text)).withColumns(
        {"query_length_chars": F.length(text), "query_length_words": n_words(text).cast("smallint")} | script_flags(text) | {"has_dictionary_brand": text.rlike(brand), "has_dictionary_product_family": text.rlike(family)}
    )
