"""Keyed stream state against days in order, and its size."""

from __future__ import annotations

import datetime as dt
import random

from tessera.streaming import keyed

START = dt.date(2024, 1, 1)


def in_order(days: dict[int, set[int]], last: int, keep: int) -> set[tuple]:
    out, active, since = set(), {}, {}
    for d in range(min(days), last + 1):
        for k in set(active) | days.get(d, set()):
            here = k in days.get(d, set())
            if here and active.get(k) is None:
                out.add((k, d, "new"))
                active[k] = True
            elif here and not active[k]:
                out.add((k, d, "reactivated"))
                active[k] = True
            elif not here and active[k]:
                out.add((k, d, "archived"))
                active[k], since[k] = False, d
            elif not here and d >= since[k] + keep:
                del active[k]
    return out


def test_late_and_repeated_days_give_what_days_in_order_give(spark, tmp_path):
    keyed.use_rocksdb(spark)
    draw = random.Random(1)
    days = {d: {k for k in range(25) if draw.random() < (0.75 if k < 20 else 0.9 * (d < 3))} for d in range(12)}
    files = [0, 1, 3, 2, 2, 4, 6, 5, 7, 6, 9, 8, 10, 11]  # two days late at most, some twice
    src = str(tmp_path / "days")
    sizes, got = [], set()
    for n, d in enumerate(files):
        rows = [(k, START + dt.timedelta(days=d)) for k in days[d]] + [(None, START), (3, None)]
        spark.createDataFrame(rows, "k long, d date").coalesce(1).write.parquet(f"{src}/{n:02d}")
    spark.createDataFrame([(999, START + dt.timedelta(days=40))], "k long, d date").coalesce(1).write.parquet(f"{src}/99")
    parts = []

    def keep(batch, _):
        parts.extend((r["id"], (r["day"] - START).days, r["action"]) for r in batch.collect())

    stream = spark.readStream.schema("k long, d date").option("maxFilesPerTrigger", 1).parquet(f"{src}/*")
    found = keyed.presence_changes(stream, "k", "d", late_days=2, keep_days=5)
    q = found.writeStream.foreachBatch(keep).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination()
    got = {p for p in parts if p[0] != 999}
    sizes = [p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress if p["stateOperators"]]
    want = in_order(days, 30, 5)
    assert got == want and len(parts) == len(set(parts)) and {a for *_, a in want} == {"new", "archived", "reactivated"}
    assert max(sizes) > 25 and sizes[-1] < max(sizes) / 4


def test_many_keys_share_a_row_of_state(spark, tmp_path):
    keyed.use_rocksdb(spark)
    src = str(tmp_path / "days")
    for n, (keys, d) in enumerate((((0, 3000), 0), ((1000, 3000), 1), ((5000, 5001), 9))):
        spark.range(*keys).selectExpr("concat('k', id) AS k", f"date_add(DATE '2024-01-01', {d}) AS d").coalesce(1).write.parquet(f"{src}/{n}")
    counts = {}

    def keep(batch, _):
        for r in batch.groupBy("action", "day").count().collect():
            counts[r["action"], (r["day"] - START).days] = r["count"]

    stream = spark.readStream.schema("k string, d date").option("maxFilesPerTrigger", 1).parquet(f"{src}/*")
    q = keyed.presence_changes(stream, "k", "d").writeStream.foreachBatch(keep).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert counts == {("new", 0): 3000, ("archived", 1): 1000, ("archived", 2): 2000}
    assert max(p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress if p["stateOperators"]) < 3000
