from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tessera.functions import domain as D
from tessera.functions import text as X


def one(spark, column, **values):
    df = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} {'string' if v is None or isinstance(v, str) else 'double' if isinstance(v, float) else 'boolean' if isinstance(v, bool) else 'bigint'}" for k, v in values.items()))
    return df.select(column).first()[0]


@pytest.mark.parametrize(("given", "want"), [("1 250 000,50 Kč", 1250000.5), ("2 000 CZK", 2000.0), ("dohodou", None), (None, None), ("", None)])
def test_money(spark, given, want):
    assert one(spark, X.money(F.col("x")), x=given) == want


@pytest.mark.parametrize(("given", "want"), [("601 234 567", "+420601234567"), ("+420601234567", "+420601234567"), ("420601234567", "+420601234567"), ("12345", None), (None, None), ("abc", None)])
def test_phone(spark, given, want):
    assert one(spark, X.phone(F.col("x")), x=given) == want


@pytest.mark.parametrize(
    ("deal", "name", "want"),
    [("Prodej", None, 1), ("sale", None, 1), (None, "Продажа дома", 1), ("Pronájem", None, 2), ("x", "k nájem", 2), (None, "rent flat", 2), ("dražba", None, 3), ("", "aukce domu", 3), ("аукцион", "", 3), (None, None, 0), ("výměna", "byt", 0)],
)
def test_deal_class(spark, deal, name, want):
    assert one(spark, D.deal_class(F.col("d"), F.col("n"))["deal_type_value"], d=deal, n=name) == want


@pytest.mark.parametrize(("given", "want"), [("Praha-5 Smíchov", "Praha 5"), ("Praha", "Praha"), (" Brno ", "Brno"), (None, None)])
def test_capital_label(spark, given, want):
    assert one(spark, X.capital_label(F.col("x")), x=given) == want


@pytest.mark.parametrize(("given", "want"), [("Jihočeský kraj", "Jihočeský kraj"), ("vysočina", "Kraj Vysočina"), ("Hlavní město-Praha", "Hlavní město Praha"), ("Neznámo", "neznamo")])
def test_region(spark, given, want):
    assert one(spark, D.canonical_region(F.col("x")), x=given) == want


def test_contact(spark):
    got = spark.createDataFrame([("Jan Novák, Reality s.r.o., jan@reality.cz +420 601 234 567",), (None,), ("",)], "x string").select(X.contact(F.col("x")).alias("c")).collect()
    assert got[0]["c"].asDict() == {"agent_name": "Jan Novák", "agent_phone": "+420 601 234 567", "agent_email": "jan@reality.cz", "agency": "Reality s.r.o."}
    assert all(v is None for r in got[1:] for v in r["c"].asDict().values())


@pytest.mark.parametrize(("a", "b", "want"), [(100.0, 120.0, True), (100.0, 120.1, False), (0.0, 5.0, True)])
def test_price_check(spark, a, b, want):
    assert one(spark, D.price_check(F.col("a"), F.col("b"))["ok"], a=a, b=b) is want


@pytest.mark.parametrize(("a", "b", "want"), [(50.0, 55.0, True), (50.0, 55.1, False), (200.0, 210.0, True), (200.0, 211.0, False), (0.0, 1.0, False)])
def test_areas_close(spark, a, b, want):
    assert one(spark, D.areas_close(F.col("a"), F.col("b")), a=a, b=b) is want


def test_geo_level(spark):
    rows = [("o", "c", "p", "s", "o", "c", "p", "s"), ("o", "c", "p", None, "o", "c", "p", "s"), ("o", "c", None, None, "o", "c", "p", None), ("o", None, None, None, "O ", "c", None, None), ("o", "c", "p", "s", "o", "c", "p", "t"), (None, None, None, None, None, None, None, None)]
    df = spark.createDataFrame(rows, ", ".join(f"a{k} string" for k in range(4)) + ", " + ", ".join(f"b{k} string" for k in range(4)))
    got = [r[0] for r in df.select(D.geo_level([(F.col(f"a{k}"), F.col(f"b{k}")) for k in range(4)])).collect()]
    assert got == ["lvl1", "lvl2", "lvl3", "lvl4", None, None]


def test_address_parts_and_widest(spark):
    df = spark.createDataFrame([("Ulice 1, Část, Město",), ("Město",), ("",), (None,)], "a string")
    got = df.select(X.address_part(F.col("a"), 0), X.address_part(F.col("a"), 1), X.address_part(F.col("a"), -1), X.address_part_of_widest(F.col("a"), 1, F.lit(3))).collect()
    assert [tuple(r) for r in got] == [("Ulice 1", "Část", "Město", "Město"), ("Město", None, "Město", None), (None, None, None, None), (None, None, None, None)]
