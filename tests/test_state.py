"""The bucketed snapshot state against the plain merge, its plan, and what it writes."""

from __future__ import annotations

import datetime as dt
import random
import uuid

import pytest
from pyspark.sql import functions as F

from tessera.operators.relational import sync_snapshot
from tessera.operators.state import BucketedState

STATE = "id long, price double, name string, added_date date, archived_date date, available boolean"


def rows_of(df):
    return sorted((tuple(r) for r in df.select("id", "price", "name", "added_date", "archived_date", "available").collect()), key=str)


def start(spark, n: int = 200):
    day = dt.date(2024, 1, 1)
    rows = [(k, float(k), f"n{k}", day, day if k % 5 == 0 else None, None if k % 37 == 0 else k % 5 != 0) for k in range(n)]
    return spark.createDataFrame(rows, STATE)


@pytest.mark.parametrize("scope", ["active", "previous"])
def test_days_of_merges_equal_the_plain_merge(spark, scope):
    draw, plain = random.Random(4), start(spark)
    state = BucketedState(spark, f"s{uuid.uuid4().hex}", buckets=5, fold_share=0.4)
    state.create(plain.unionByName(plain.filter("id < 3")).unionByName(plain.limit(1).withColumn("id", F.lit(None).cast("long"))))
    before, folds = None, 0
    for day in range(2, 7):
        ids = [k for k in range(0, 260) if draw.random() < 0.8]
        rows = [(k, float(k + day), "x", None) for k in ids] + [(ids[0], -1.0, "again", 1), (None, 0.0, "no key", 1)]
        current = spark.createDataFrame(rows, "id long, price double, other string, available int").repartition(3)
        date = F.lit(dt.date(2024, 1, day))
        previous = before if scope == "previous" and before is not None else None
        keyed = current.filter("id is not null")
        want = sync_snapshot(plain, keyed.drop("available"), date, previous, archive_scope=scope)
        plain = spark.createDataFrame(want.collect(), STATE)
        seen = state.sync(current, date, previous)
        assert rows_of(state.read()) == rows_of(plain)
        assert seen["written"] == state.delta.count() and seen["new"] + seen["reactivated"] + seen["archived"] > 0
        folds += state.fold()
        assert rows_of(state.read()) == rows_of(plain)
        state.drop_old()
        before = keyed
    assert 0 < folds < 5 and rows_of(state.read()) == rows_of(plain)


def test_state_is_not_exchanged_and_little_is_written(spark):
    name = f"s{uuid.uuid4().hex}"
    state = BucketedState(spark, name, buckets=8)
    state.create(start(spark, 20_000))
    current = start(spark, 20_000).filter("available or available is null").filter("id % 100 <> 7").select("id", "price")
    assert state.sync(current, F.lit(dt.date(2024, 1, 2)))["written"] < 0.05 * 20_000  # 1 % gone, and those of unknown availability back
    for previous in (None, current):
        plan = state.changes(current, F.lit(dt.date(2024, 1, 3)), previous)._jdf.queryExecution().executedPlan().toString().split("\n")
        under: list[tuple[int, bool]] = []
        scans = 0
        for line in plan:
            depth = len(line) - len(line.lstrip(" :+-*("))
            under = [u for u in under if u[0] < depth]
            if f"{name}_" in line and "Scan parquet" in line:
                scans += 1
                assert not any(exchange for _, exchange in under)
            under.append((depth, "Exchange" in line))
        assert scans >= 4


def test_empty_states_and_snapshots(spark):
    state = BucketedState(spark, f"s{uuid.uuid4().hex}", buckets=2)
    state.create(start(spark).limit(0))
    date = F.lit(dt.date(2024, 1, 2))
    one = spark.createDataFrame([(1, 2.0)], "id long, price double")
    assert state.sync(one.limit(0), date) == {"new": 0, "reactivated": 0, "archived": 0, "written": 0}
    assert state.sync(one, date)["new"] == 1 and state.sync(one.limit(0), date)["archived"] == 1
    assert state.fold(force=True) and rows_of(state.read()) == [(1, 2.0, None, dt.date(2024, 1, 2), dt.date(2024, 1, 2), False)]
    with pytest.raises(ValueError):
        state.create(one)
