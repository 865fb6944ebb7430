from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from quern.functions import lemma, text, units
from quern.operators import measure


def one(spark, value, f):
    return spark.createDataFrame([(value,)], "v string").select(f(F.col("v")).alias("x")).first()[0]


@pytest.mark.parametrize(("value", "want"), [("  телевизор\t  samsung\n", "телевизор samsung"), ("a  b", "a b"), ("a\x1cb", "a b")])
def test_spaces(spark, value, want):
    assert one(spark, value, text.collapse) == want


def test_separators(spark):
    assert one(spark, "a—b «c»", text.separators) == "a b  c "


def test_stages_keep_models(spark):
    assert one(spark, "iPhone-15 Pro 43P7K", lambda c: text.stages(c)["spaces"]) == "iphone 15 pro 43p7k"


def test_log_normalizer_and_aliases(spark):
    assert one(spark, "Айфон-15 Pro, ﬁ²", text.log_normalize) == "айфон 15 pro fi2"
    assert one(spark, "эпл вотч жсамсунг самсунг", text.canonicalize) == "apple watch жсамсунг samsung"
    assert one(spark, None, text.log_normalize) == ""


def test_tokens_are_slices(spark):
    value = 'İ телевизор 55" Straße'
    for t in one(spark, value, text.tokens):
        assert value[t["start"] : t["end"]].lower() == t["text"]


def test_model_text(spark):
    assert one(spark, '  Samsung\tQE55-Q80C 55"  ', text.model_text) == 'Samsung QE55-Q80C 55"'


def test_lemma_table_protects(spark):
    rows = spark.createDataFrame([("самсунг телевизоры 43p7k мини",)], "t string")
    table = spark.createDataFrame([("телевизоры", "телевизор"), ("самсунг", "x"), ("мини", "y"), ("43p7k", "z")], "token string, lemma string")
    brands = spark.createDataFrame([("самсунг",)], "token string")
    assert lemma.lemmatize(rows, "t", table, brands).first()["lemma"] == "самсунг телевизор 43p7k мини"


@pytest.mark.parametrize(("value", "want"), [("55", ["55"]), ("1,5", ["1.5"]), ("10x20x30 см", ["10", "20", "30"]), ("8/256 ГБ", ["8", "256"]), ("от -5 до +10 °C", ["-5", "10"]), ("без чисел", [])])
def test_numbers(value, want):
    assert measure.numbers(value) == want


@pytest.mark.parametrize(("alias", "unit"), [("килограммы", "kg"), ("кг", "kg"), ("дюймы", "inch"), ('"', "inch"), ("сантиметры", "cm"), ("миллиметры", "mm"), ("литры", "l"), ("мач", "mah")])
def test_unit_aliases(alias, unit):
    assert units.alias_lookup()[units.normalize_alias(alias)] == unit


def test_every_unit_alias_resolves():
    found, seen = units.alias_lookup(), set()
    assert len(units.definitions()) == 108
    for u in units.definitions():
        for alias in (u.canonical, u.preferred, *u.aliases):
            key = units.normalize_alias(alias)
            assert found[key] == u.canonical or key in seen  # the first definition of an alias stands
            seen.add(key)
    assert found["мb/s".replace("м", "m")] == "mbps" and found["микрон"] == "um" and found["квадратныйметр"] == "m2"


def test_scanner_golden_cases():
    scanner = measure.Scanner(units.definitions(), {"hp": 100})

    def good(t, hint=""):
        return [(c["surface"], c["entity_type"]) for c in scanner.parse(t, hint) if c["has_number"] and not c["rejected"]]

    assert good('İ телевизор 55" Straße') == [('55"', "screen_diagonal")]
    assert good("powerbank 5K Mah 20Вт") == [("20Вт", "power")]
    assert good("RAM 16 ГБ, SSD 512 ГБ") == [("16 ГБ", "memory_ram"), ("512 ГБ", "memory_rom")]
    for rejected in ("Samsung S24", "Samsung A55", "iPhone 5S", "ноутбук HP"):
        found = scanner.parse(rejected)
        assert found and all(c["rejected"] for c in found)
    for text_ in ("монитор 1920x1080/100 Гц", "утюг RI-C284, 2200 Вт", "x" * 50_000 + " 5 кг"):
        for c in scanner.parse(text_):
            assert measure.clean(text_)[c["start"] : c["end"]] == c["surface"]
    assert scanner.parse(None) == [] and scanner.parse("") == []
