from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tessera.plans import addresses, bi, bronze, runner, silver
from tessera.sources import snapshots

D1, D2 = dt.date(2024, 1, 1), dt.date(2024, 2, 1)


def test_source_listings(spark):
    b = spark.createDataFrame([("9", "byt", "DISP_2_KK", "Byt 1.045 m²", "Hlavní 1, Vinohrady-Praha, Praha", "1 200 000", "prodej_byt", D1, None)], "id string, estate_type string, disposition string, image_alt_text string, address string, price string, query_name string, added_date date, archived_date date")
    r = bronze.bezrealitky_listing(b).first()
    assert (r.source_id, r.rooms, r.area_build, r.street, r.city_part, r.city, r.district, r.deal_type, r.price, r.available) == (2, "2+kk", 1045.0, "Hlavní 1", "Vinohrady-Praha", "Vinohrady", "Praha", "prodej", 1200000.0, True)
    i = spark.createDataFrame([("5", "Prodej bytu 3+kk 70 m²", "Ulice, Část, Město", "apartments", "5 000 000", D1, D2)], "id string, name string, address string, category_name string, price_czk string, added_date date, archived_date date")
    r = bronze.idnes_listing(i).first()
    assert (r.category_value, r.category_name, r.rooms, r.city, r.deal_type, r.available) == (1, "byt", "3+kk", "Město", "prodej", False)


def test_json_records(spark):
    df = spark.createDataFrame([('{"id": "1", "Užitná plocha_numeric": 45, "title": "x"}',), (None,), ("no json",)], "data string")
    r = snapshots.json_records(df).collect()
    assert len(r) == 1 and r[0].id == "1" and r[0].surface == "45" and r[0].name == "x"


def test_image_urls(spark):
    df = spark.createDataFrame([('["a","b","c","d","e","f"]',), ('[{"url":"u"},{"x":1}]',), (None,)], "j string")
    got = [[u["url"] for u in r[0]] if r[0] else None for r in df.select(snapshots.image_urls(F.col("j"))).collect()]
    assert got[0] == ["a", "b", "c", "d", "e"] and got[1] == ["u"]


def test_snapshot_names():
    got = snapshots.sorted_snapshots(["s_02012024", "s_31122023", "s_99992024", "t_01012024", "s_05012024"], "s", as_of=dt.date(2024, 1, 3))
    assert [n for _, n in got] == ["s_31122023", "s_02012024"]


@pytest.fixture(scope="module")
def registry(spark):
    rows = [("Jihočeský kraj", "Písek", "Smrkovice", "Lipová", "Písek", None), ("Jihočeský kraj", "Tábor", "Čelkovice", "Mlýnská", "Tábor", None), ("Hlavní město Praha", "Praha", "Smíchov", "Štefánikova", "Praha", "Praha 5"), ("Středočeský kraj", "Říčany", "Radošovice", "Olivova", "Praha-východ", None)]
    return spark.createDataFrame(rows, "kraj string, nazev_obce string, nazev_casti_obce string, nazev_ulice string, region string, nazev_obvodu_prahy string")


SUBSET = "internal_id bigint, norm_district string, norm_okres string, norm_city string, norm_city_part string, norm_street string, geo_ok boolean, not_true boolean"


def test_region_cascade(spark, registry):
    k = "Jihočeský kraj"
    rows = [(1, k, None, "PÍSEK", None, None, None, None), (2, k, None, "Tabor ", None, None, False, None), (3, k, None, "???", "Čelkovice", None, False, None), (4, k, None, None, None, "Lipova", False, None), (5, k, "o", "Xyzq", "Qwe", "Rtz", False, None), (6, k, None, "Písek", None, None, True, False)]
    got = {r.internal_id: (r.norm_city, r.norm_okres, r.geo_ok) for r in silver.region_cascade(spark.createDataFrame(rows, SUBSET), *snapshots.registry_lists(registry, k), k).collect()}
    assert got == {1: ("Písek", "Písek", True), 2: ("Tábor", "Tábor", True), 3: ("Tábor", "Tábor", True), 4: ("Písek", "Písek", True), 5: ("Xyzq", "o", False)}


def test_capital_cascade(spark, registry):
    p = "Hlavní město Praha"
    rows = [(1, p, None, "praha-5", None, None, None, None), (2, p, None, "Praga", "x", None, None, None), (3, p, None, "??", "Smichov", None, None, None), (4, p, None, "??", None, "Stefanikova", None, None), (5, p, None, "Ricany", None, None, None, None), (6, p, None, "Qqqq", None, None, None, None)]
    out = silver.capital_cascade(spark.createDataFrame(rows, SUBSET), snapshots.registry_lists(registry, p), snapshots.registry_lists(registry, "Středočeský kraj"))
    got = {r.internal_id: (r.phase, r.norm_city, r.norm_city_part, r.norm_district, r.geo_ok) for r in out.collect()}
    assert got == {1: (1, "Praha 5", None, p, True), 2: (1, "Praha", "x", p, True), 3: (2, "Praha 5", "Smichov", p, True), 4: (2, "Praha 5", "Smíchov", p, True), 5: (3, "Říčany", None, "Středočeský kraj", True), 6: (0, "Qqqq", None, p, False)}


def test_clusters(spark):
    geo = spark.createDataFrame([(1, "sr: A", D2), (2, "b", D1), (3, "c", None), (4, "d", D1)], "internal_id bigint, site_id string, added_date date")
    pairs = spark.createDataFrame([("a", "B", 98.0, D1), ("b", "c", 99.0, D2), ("d", "zz", 97.0, D1)], "site_id1 string, site_id2 string, percentage double, date date")
    mapping, cluster = silver.clusters(pairs, geo)
    assert sorted((r.internal_id, r.canonical_internal_id) for r in mapping.collect()) == [(1, 2), (2, 2), (3, 2)]
    c = cluster.first()
    assert (c.canonical_internal_id, c.members_count, c.member_internal_ids, c.site_ids, c.edges_count, c.max_percentage) == (2, 3, [1, 2, 3], ["a", "b", "c"], 2, 99.0)


def test_address_queue(spark, tmp_path):
    queue = spark.createDataFrame([(1, "Praha", False), (2, "none", False)], "internal_id bigint, city string, geo_status boolean")
    asked = addresses.requests(queue, 'city={city} {{"k": {x}}}')
    assert [r.prompt for r in asked.orderBy("internal_id").collect()] == ['city=Praha {{"k": {x}}}', 'city= {{"k": {x}}}']
    (tmp_path / "a.json").write_text('{"internal_id": 1, "answer": "{\\"in_cz\\": \\"true\\", \\"geo_status\\": \\"1\\", \\"norm_city\\": \\"Praha\\"}"}\n{"internal_id": 2, "answer": "bad"}\nnot json\n')
    got = addresses.import_answers(spark, str(tmp_path)).collect()
    assert [(r.internal_id, r.in_cz, r.geo_status, r.norm_city) for r in got] == [(1, True, True, "Praha")]
    assert not addresses.sent_equals_received(asked, spark.createDataFrame([(1,)], "id int")).ok


def test_runner(spark):
    steps = [runner.Step("a", "one", lambda _: {"rows": 3, "deep": {"x": [1, {"n": 7}]}}), runner.Step("a", "two", lambda _: 1 / 0), runner.Step("b", "three", lambda _: None), runner.Step("b", "m", lambda _: None, monthly=True)]
    out = runner.run_steps(None, runner.select_steps(steps, today=dt.date(2024, 1, 2)))
    assert [r.status for r in out] == ["ok", "error", "skipped"]
    assert runner.roll_up(out, {"rows": "sum"}) == {"rows": 3} and runner.find_metric(out[0].metrics, ["n"]) == 7
    assert "1 failed" in runner.report(out) and runner.last_json('x\n{"a": 1}\n') == {"a": 1}
    assert [s.name for s in runner.select_steps(steps, only="m,one")] == ["one", "m"]


def test_empty_event_fact(spark):
    assert bi.price_events(spark).isEmpty() and len(bi.price_events(spark).columns) == 16
