"""Band joins and incremental components against the plain forms, and what they look at."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from tessera.functions import domain as D
from tessera.operators import graph
from tessera.operators.relational import pick_one, within_pairs
from tessera.plans import silver

LISTING = "internal_id long, canonical_internal_id long, category_value long, deal_type string, price double, area_build double, area_land double, norm_okres string, norm_city string, norm_city_part string, norm_street string"


def listings(draw: random.Random, n: int) -> list[tuple]:
    def area():
        return draw.choice([None, 0.0, -3.0, float("inf"), draw.uniform(1, 40), draw.uniform(90, 115), 100.0, draw.uniform(200, 900), 95.0, 105.2631578947])

    return [(k, k % 3, 12 if k % 4 else 11, draw.choice(["sale", "rent", None]), draw.uniform(1, 9), area(), area(), draw.choice(["o", None]), draw.choice(["c", "d", None]), None, None) for k in range(n)]


def test_band_join_finds_what_all_pairs_find(spark):
    rows = spark.createDataFrame(listings(random.Random(1), 500), LISTING)
    area = D.area_check(*[F.col(f"{x}.{c}") for x in "ab" for c in ("category_value", "area_build", "area_land")])
    ids = lambda df: sorted((r[0], r[1]) for r in df.select("a.internal_id", "b.internal_id").collect())
    usable = lambda v: (v < 1e300) | v.isNull()
    want = ids(within_pairs(rows.filter(usable(F.col("area_build")) & usable(F.col("area_land"))), "canonical_internal_id", "internal_id", ("category_value", "deal_type")).filter(area["ok"]))
    got = ids(silver.near_pairs(rows.filter(usable(F.col("area_build")) & usable(F.col("area_land")))).filter(area["ok"]))
    assert got == want and len(got) == len(set(got)) > 500
    assert silver.near_pairs(rows).count() > 0  # infinite areas end no job


def test_close_areas_are_at_most_one_bin_apart(spark):
    draw = random.Random(2)
    values = [draw.uniform(*draw.choice([(0.01, 30), (90, 110), (99.9, 105.3), (100, 5000), (1e6, 1e7)])) for _ in range(1200)]
    df = spark.createDataFrame([(v,) for v in values], "v double").select("v", D.area_bin(F.col("v")).alias("k"))
    a, b = df.select(F.col("v").alias("x"), F.col("k").alias("i")), df.select(F.col("v").alias("y"), F.col("k").alias("j"))
    assert a.join(b, D.areas_close(F.col("x"), F.col("y"))).filter("abs(i - j) > 1").count() == 0


def test_band_join_looks_at_few_pairs(spark):
    rows = spark.range(6000).select(F.col("id").alias("internal_id"), F.lit(1).alias("canonical_internal_id"), F.lit(1).alias("category_value"), F.lit("s").alias("deal_type"), F.lit(1.0).alias("price"), (F.lit(20.0) + F.col("id") * 3).alias("area_build"), F.lit(None).cast("double").alias("area_land"), *[F.lit("x").alias(c) for c in ("norm_okres", "norm_city", "norm_city_part", "norm_street")])
    looked = silver.near_pairs(rows)
    close = looked.filter(D.areas_close(F.col("a.area_build"), F.col("b.area_build"))).count()
    assert close <= looked.count() <= 2 * close + 6000
    assert looked.count() < 0.15 * 6000 * 5999 / 2


def plain_clean_pairs(rows, mapping):
    """All pairs of a class, one picked of each."""
    geo = ("norm_okres", "norm_city", "norm_city_part", "norm_street")
    pairs = within_pairs(rows.drop("canonical_internal_id").join(mapping, "internal_id"), "canonical_internal_id", "internal_id", ("category_value", "deal_type"))
    area = D.area_check(*[F.col(f"{x}.{c}") for x in "ab" for c in ("category_value", "area_build", "area_land")])
    level = D.geo_level([(F.col(f"a.{c}"), F.col(f"b.{c}")) for c in geo])
    price = D.price_check(F.col("a.price"), F.col("b.price"))
    found = pairs.select(F.col("a.internal_id").alias("iid1"), F.col("b.internal_id").alias("iid2"), "canonical_internal_id", level.alias("level"), price.alias("p"), area.alias("area")).filter("level is not null and area.ok")
    found = found.select("iid1", "iid2", "canonical_internal_id", "level", F.col("p.ok").alias("price_ok"), F.col("p.hi").alias("price_hi"), F.col("p.lo").alias("price_lo"), F.col("area.mode").alias("area_mode"), F.col("area.v1").alias("area1"), F.col("area.v2").alias("area2"))
    return pick_one(found, ["iid1", "iid2"], [F.col("level"), F.desc("price_ok"), F.col("area_mode"), F.col("canonical_internal_id")])


def test_only_pairs_with_repeated_ids_are_gathered(spark):
    # Kind 90 is land, whose own area is the land's; every seventh listing is in two clusters.
    made = [(*r[:2], 90 if r[0] % 5 == 0 else r[2], *r[3:7], *((" O " if r[0] % 2 else r[7]), r[8], r[9], r[10])) for r in listings(random.Random(4), 400)]
    made = [r for r in made if float("inf") not in (r[5], r[6])]
    rows = spark.createDataFrame(made, LISTING)
    once = rows.select("internal_id", "canonical_internal_id")
    plan = silver.clean_pairs(rows, once)._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan.split("Join")[0]
    twice = once.unionByName(once.filter("internal_id % 7 = 0").withColumn("canonical_internal_id", (F.col("canonical_internal_id") + 1) % 3))
    for mapping in (once, twice):
        got, want = (sorted(map(repr, df.collect())) for df in (silver.clean_pairs(rows, mapping), plain_clean_pairs(rows, mapping)))
        assert got == want and len(got) > 150


def labels_of(df) -> list[tuple]:
    return sorted((r["id"], r["root"]) for r in df.collect())


def test_components_by_days_equal_a_full_run(spark):
    draw = random.Random(3)
    chain = [(k, k + 1) for k in range(1000, 1120)]
    star = [(5000, 5000 + k) for k in range(1, 150)]
    noise = [(draw.randrange(200), draw.randrange(200)) for _ in range(90)] + [(7, 7), (3, None), (None, None)]
    edges = chain + star + noise
    draw.shuffle(edges)
    days = [spark.createDataFrame(edges[k::6] + edges[k : k + 2], "a long, b long") for k in range(6)]
    labels = spark.createDataFrame([], "id long, root long")
    seen = None
    for day in days:
        before = labels
        changed = graph.component_changes(before, day)
        labels = spark.createDataFrame(labels_of(graph.extend_components(before, day)), "id long, root long")
        old = dict(labels_of(before))
        assert dict(labels_of(changed)) == {i: r for i, r in labels_of(labels) if old.get(i) != r}
        seen = day if seen is None else seen.union(day)
        assert labels_of(labels) == labels_of(graph.connected_components(seen))
    assert labels_of(graph.extend_components(labels, days[0])) == labels_of(labels)
    assert labels_of(graph.extend_components(labels, days[0].limit(0))) == labels_of(labels)


def test_rounds_and_rows_follow_the_new_edges(spark, monkeypatch):
    written = []
    plain = graph.cut_lineage

    def spied(df, name):
        out = plain(df, name)
        written.append(out.count())
        return out

    labels = spark.range(200_000).select("id", (F.col("id") - F.col("id") % 1000).alias("root"))
    monkeypatch.setattr(graph, "cut_lineage", spied)
    new = spark.createDataFrame([(5, 1007), (1500, 3999), (250_000, 3001), (250_001, 250_002)], "a long, b long")
    changed = labels_of(graph.component_changes(labels, new))
    assert max(written) <= 8 and len(written) <= 12
    assert len(changed) == 1000 + 1000 + 3
    assert {changed.index((i, r)) >= 0 for i, r in ((1999, 0), (3999, 0), (250_000, 0), (250_001, 250_001), (250_002, 250_001))} == {True}


def test_digest_audit_joins_what_differs_only(spark):
    from tessera.operators import quality

    source = spark.range(20_000).select("id", (F.col("id") % 3).cast("string").alias("a"), F.when(F.col("id") % 4 > 0, F.col("id") * 2).alias("b"))
    assert tuple(quality.digest_audit(source, source.repartition(7), ["id"], ["a", "b"]).first()) == (0, 0, 0, 0, 0, 0)
    target = source.filter("id <> 17").withColumn("b", F.when(F.col("id") == 4, 1).otherwise(F.col("b"))).withColumn("a", F.when(F.col("id") == 5, None).otherwise(F.col("a")))
    target = target.unionByName(target.filter("id = 9")).unionByName(spark.createDataFrame([(-1, "x", 1), (None, "y", 1)], "id long, a string, b long"))
    got = quality.digest_audit(source, target, ["id"], ["a", "b"]).first()
    keys, columns = quality.audit_keys(source, target, ["id"]).first(), quality.audit_columns(source, target, ["id"], ["a", "b"]).first()
    assert (got["missing"], got["extra"], got["duplicates"], got["a"], got["b"]) == (keys["missing"], keys["extra"], 1, columns["a"], columns["b"]) == (1, 2, 1, 1, 1)
    assert 0 < got["compared"] < 60
    swapped = source.select("id", F.lit(None).cast("string").alias("a"), F.lit("v").alias("b"))
    assert quality.digest_audit(swapped, swapped.select("id", F.col("b").alias("a"), F.col("a").alias("b")), ["id"], ["a", "b"]).first()["a"] == 20_000


def test_key_drift_of_odd_documents(spark):
    from tessera.sources import snapshots

    rows = [("1", '{"a": 1, "b": "x", "c": null}'), ("1", "[1]"), ("1", "{"), ("1", None), ("1", "7"), ("2", '{"a": "1", "c": 5, "d": {"e": 1}}'), ("2", '{"a": null}'), ("3", "{}"), ("4", '{"a": [1], "c": 5}')]
    df = spark.createDataFrame(rows, "day string, doc string")
    assert {tuple(r)[:3] for r in snapshots.key_drift(df, "doc", "day").collect()} == {("2", "b", "lost"), ("2", "a", "retyped"), ("2", "d", "added"), ("4", "a", "retyped"), ("4", "d", "lost")}
    assert snapshots.key_drift(df.limit(0), "doc", "day").collect() == []
