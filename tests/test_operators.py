from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tessera.operators import fuzzy, graph, phash, quality
from tessera.operators import relational as R
from tessera.storage import Database, PublishRejected

STATE = "id string, price double, added_date date, archived_date date, available boolean"
D = [dt.date(2024, 1, d) for d in (1, 2, 3, 4)]


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def snapshot(spark, *pairs):
    return spark.createDataFrame(list(pairs), "id string, price double")


def test_three_days_of_snapshots(spark):
    state = spark.createDataFrame([], STATE)
    days = [snapshot(spark, ("a", 1.0), ("b", 2.0), ("b", 2.0)), snapshot(spark, ("a", 1.0), ("c", 3.0)), snapshot(spark, ("b", 2.5), ("c", 3.0))]
    prev = None
    for day, snap in zip(D, days, strict=False):
        state = spark.createDataFrame(R.sync_snapshot(state, snap, F.lit(day), prev).collect(), STATE)
        prev = snap
    assert rows(state, "id", "available", "archived_date") == [("a", False, D[2]), ("b", True, None), ("c", True, None)]
    again = R.sync_snapshot(state, days[-1], F.lit(D[2]), days[-1])
    assert rows(again, *state.columns) == rows(state, *state.columns)


def test_price_changes_ignore_nulls_and_equal(spark):
    p = spark.createDataFrame([("a", 1.0), ("b", None), ("c", 3.0), ("d", 4.0)], "id string, price double")
    c = spark.createDataFrame([("a", 2.0), ("b", 2.0), ("c", 3.0), ("e", 5.0)], "id string, price double")
    assert rows(R.price_changes(p, c, F.lit(D[0])), "id", "old_price", "new_price") == [("a", 1.0, 2.0)]


def test_upsert_rules(spark):
    t = spark.createDataFrame([(1, 5, 5, 5, None, "x"), (2, 1, 1, 1, "k", "y")], "k int, lo int, hi int, n int, f string, o string")
    r = spark.createDataFrame([(1, 3, 9, 2, "new", "z"), (3, 7, 7, 7, "n", None)], t.schema)
    got = R.upsert(t, r, ["k"], {"lo": "least", "hi": "greatest", "n": "add", "f": "fill", "o": "overwrite"})
    assert rows(got, "k", "lo", "hi", "n", "f", "o") == [(1, 3, 9, 7, "new", "z"), (2, 1, 1, 1, "k", "y"), (3, 7, 7, 7, "n", None)]


def test_guards(spark):
    old = spark.createDataFrame([(1, "a", "p"), (2, "b", "q")], "id int, name string, agent string")
    new = spark.createDataFrame([(1, "a", "x"), (2, "c", "q")], old.schema)
    assert rows(R.guard_whitelist(old, new, ["id"], ["agent"]), "id") == [(2,)]
    assert R.guard_append_only(old, old.union(new)).isEmpty()
    assert not R.guard_append_only(old, new).isEmpty()


def test_move_and_restore(spark):
    geo = spark.createDataFrame([(1, None), (2, "x"), (3, " ")], "internal_id bigint, norm_district string")
    queue = spark.createDataFrame([(3, "old", True)], "internal_id bigint, norm_district string, in_cz boolean")
    left, q = R.move_rows(geo, queue, "internal_id", F.col("norm_district").isNull() | (F.trim("norm_district") == ""))
    assert rows(left, "internal_id") == [(2,)]
    assert sorted((r.internal_id, r.norm_district) for r in q.collect()) == [(1, None), (3, "old")]


def test_allocate_ids_goes_on(spark):
    old = spark.createDataFrame([(7, 800_000_000)], "c bigint, object_id bigint")
    keys = spark.createDataFrame([(9,), (7,), (3,), (9,), (None,)], "c bigint")
    assert rows(R.allocate_ids(old, keys, "c", "object_id", 800_000_000), "c", "object_id") == [(3, 800_000_001), (9, 800_000_002)]
    assert rows(R.allocate_ids(old.limit(0), keys, "c", "object_id", 5), "c", "object_id") == [(3, 5), (7, 6), (9, 7)]


def test_fallback_join(spark):
    dim = spark.createDataFrame([("r", "c", "s", 1), ("r", "c", "", 2), ("r", "", "", 3)], "region string, city string, street string, key int")
    df = spark.createDataFrame([(1, "r", "c", "s"), (2, "r", "c", "t"), (3, "r", "d", "t"), (4, "q", "c", "s")], "_row int, region string, city string, street string")
    got = R.fallback_join(df, dim, ["region", "city", "street"], ["street", "city"], "key").orderBy("_row").collect()
    assert [(r["_row"], r["key"]) for r in got] == [(1, 1), (2, 2), (3, 3), (4, None)]


def test_conform_and_union(spark):
    from pyspark.sql import types as T

    df = spark.createDataFrame([("1", "x")], "a string, z string")
    got = R.conform(df, T.StructType.fromDDL("b date, a int"))
    assert got.columns == ["b", "a"] and got.first().asDict() == {"b": None, "a": 1}
    with pytest.raises(ValueError, match="q"):
        R.require_columns(df, ["a", "q"])


def test_components_equal_union_find(spark):
    draw = random.Random(4)
    edges = [(draw.randrange(120), draw.randrange(120)) for _ in range(90)] + [(k, k + 1) for k in range(200, 240)] + [(5, 5), (None, 3)]
    parent: dict[int, int] = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    got = graph.connected_components(spark.createDataFrame(edges, "a bigint, b bigint"))
    assert rows(got, "id", "root") == sorted((x, find(x)) for x in parent)
    assert graph.connected_components(spark.createDataFrame([], "a bigint, b bigint")).isEmpty()


def test_fuzzy(spark):
    assert fuzzy.weighted_ratio("ricany", "ricany") == 100
    assert fuzzy.weighted_ratio("", "x") == 0
    assert fuzzy.ratio("abcd", "abxd") == pytest.approx(75.0)
    assert fuzzy.weighted_ratio("nova ves", "ves nova") == pytest.approx(95.0)
    q = spark.createDataFrame([("ricany",), ("rycany",), ("xyz",), ("",), (None,)], "q string")
    c = spark.createDataFrame([("ricany",), ("benesov",), (None,)], "c string")
    got = {r["query"]: r["match"] for r in fuzzy.best_match(q, c, "q", "c", 80).collect()}
    assert got == {"ricany": "ricany", "rycany": "ricany"}


def test_blocked_pairs_equal_brute_force(spark):
    draw = random.Random(2)
    base = [draw.getrandbits(256) for _ in range(12)]
    hashes = []
    for k in range(60):
        h = draw.choice(base)
        for _ in range(draw.randrange(9)):
            h ^= 1 << draw.randrange(240)  # the first byte, and so the block, stays within one bit
        hashes.append((k, f"{h:064x}"))
    df = spark.createDataFrame(hashes, "k bigint, h string").select("k", phash.words(F.col("h")).alias("w"), phash.bucket(F.col("h")).alias("b"))
    got = rows(phash.blocked_pairs(df, df.limit(0), "k", "w", "b"), "key1", "key2", "distance")
    want = sorted((a, b, d) for a, x in hashes for b, y in hashes if a < b and (d := (int(x, 16) ^ int(y, 16)).bit_count()) <= 6)
    assert got == want


def test_publish_gate(spark, tmp_path):
    db = Database(spark, str(tmp_path / "db"))
    db.publish({"t": spark.range(3).withColumnRenamed("id", "k"), "u": spark.range(1)})
    assert db.tables() == ["t", "u"] and db.read("t").count() == 3
    bad = lambda frames: [quality.CheckResult("x", frames["t"].count() < 5)]
    with pytest.raises(PublishRejected):
        db.publish({"t": spark.range(9).withColumnRenamed("id", "k"), "u": spark.range(9)}, gate=bad)
    assert db.read("t").count() == 3 and db.read("u").count() == 1
    assert db.append_absent("t", spark.createDataFrame([(2,), (7,), (7,)], "k bigint"), ["k"], db.read("t").schema) == 1
    assert db.read("t").count() == 4


def test_publish_gate_of_the_star(spark):
    facts = "object_id bigint, deal_type string"
    a = spark.createDataFrame([(1, "prodej"), (2, "ostatni")], facts)
    c = spark.createDataFrame([(3, "drazba")], facts)
    objects = spark.createDataFrame([(1,), (2,), (3,)], "object_id bigint")
    checks = {x.name: x for x in quality.publish_gate(objects, a, c, a.limit(1).union(c))}
    assert checks["objects_in_facts"].ok and checks["splits_sum_up"].ok and not checks["no_unknown_deals"].ok
    assert checks["no_unknown_deals"].detail["top_deal_types"]


def test_anti_join_plan_has_no_cartesian(spark):
    t = spark.range(10).withColumnRenamed("id", "k")
    plan = R.insert_absent(t, t, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "LeftAnti" in plan and "CartesianProduct" not in plan


def test_column_facts_count_what_fits(spark):
    df = spark.createDataFrame([("1", 1), ("x", 2), (None, None)], "t string, n int")
    got = rows(R.column_facts(df, {"t": "bigint", "n": "int", "gone": "int"}), "column", "type", "matches", "filled", "fitting", "all_match")
    assert got == [("gone", None, False, 0, 0, False), ("n", "int", True, 2, 2, False), ("t", "string", False, 2, 1, False)]
