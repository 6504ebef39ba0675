from __future__ import annotations

import random
import time

import pytest
from pyspark.sql import functions as F

from tessera.operators import fuzzy, phash
from tessera.operators import relational as R
from tessera.operators.quality import CheckResult
from tessera.plans import runner
from tessera.sources import snapshots
from tessera.storage import Database, PublishRejected, StaleWrite


def rows(spark, *keys):
    return spark.createDataFrame([(k, f"v{k}") for k in keys], "k bigint, v string")


def test_appends_add_parts_and_stale_writes_are_refused(spark, tmp_path):
    db, other = Database(spark, str(tmp_path)), Database(spark, str(tmp_path))
    db.replace("t", rows(spark, 1, 2))
    db.append("t", rows(spark, 3))
    assert len(db.manifest()["t"]) == 2 and db.append_absent("t", rows(spark, 3, 4, 4), ["k"], rows(spark).schema) == 1
    assert sorted(r.k for r in db.read("t").collect()) == [1, 2, 3, 4]
    seen = other.read("t")
    db.append("t", rows(spark, 5))
    with pytest.raises(StaleWrite):
        other.replace("t", seen)
    other.replace("u", rows(spark, 9))  # another table is not concerned
    other.read("t")
    other.append("t", rows(spark, 6))
    db.read("t")
    db.compact("t")
    assert len(db.manifest()["t"]) == 1 and sorted(r.k for r in db.read("t").collect()) == [1, 2, 3, 4, 5, 6] and db.tables() == ["t", "u"]
    gone = db.vacuum(keep=1)
    assert len(gone) >= 5 and db.read("t").count() == 6 and db.read("u").count() == 1


def test_gate_and_dry_run_write_nothing(spark, tmp_path):
    db = Database(spark, str(tmp_path))
    with pytest.raises(PublishRejected):
        db.publish({"t": rows(spark, 1)}, gate=lambda made: [CheckResult("never", False)])
    assert not db.exists("t")
    step = runner.Step("gold", "load", lambda d: d.replace("t", rows(spark, 1, 2)))
    (result,) = runner.run_steps(db, [step], dry_run=True)
    assert result.status == "dry_run" and result.success and result.metrics["planned"] == [{"table": "t", "action": "replace", "rows": 2}] and not db.exists("t")


def test_a_step_that_hangs_is_stopped(spark):
    def slow(_):
        spark.range(8).select(F.expr("java_method('java.lang.Thread', 'sleep', 60000L + id)")).collect()

    began = time.monotonic()
    done = runner.run_steps(None, [runner.Step("a", "slow", slow, timeout_s=2), runner.Step("a", "next", lambda _: {})], fail_fast=True, spark=spark)
    assert [r.status for r in done] == ["error", "skipped"] and "StepTimeout" in done[0].error and time.monotonic() - began < 30


def test_a_late_step_publishes_nothing(spark, tmp_path):
    """A step that was given up while its Python code ran on finds a closed fence; the next step's publications pass."""
    db, late = Database(spark, str(tmp_path)), {}

    def slow(d):
        time.sleep(3)
        try:
            d.replace("t", rows(spark, 1))
        except Exception as e:  # noqa: BLE001
            late["error"] = type(e).__name__

    steps = [runner.Step("a", "slow", slow, timeout_s=1), runner.Step("a", "next", lambda d: d.replace("u", rows(spark, 2)), timeout_s=300)]
    done = runner.run_steps(db, steps, fail_fast=False, spark=spark)
    for _ in range(100):
        if late:
            break
        time.sleep(0.2)
    assert [(r.status, r.error) for r in done][1] == ("ok", None) and "StepTimeout" in done[0].error and late and db.tables() == ["u"]


def test_steps_are_loaded_by_name_and_services_given_up():
    step = runner.load_step("x", "tessera.plans.runner:failures_stop", alias="f")
    assert step.run([True] * 3) == 3
    assert runner.failures_stop([True, *[False] * 7, True, *[False] * 9, True]) == 17


def test_images_are_fetched_with_retries(spark):
    def get(url):
        import collections

        seen = get.__dict__.setdefault("seen", collections.Counter())
        seen[url] += 1
        if url == "down":
            raise OSError("no route")
        if url == "busy":
            return (429, "", b"") if seen[url] < 3 else (200, "image/png", b"x")
        return (200, "image/png", b"y") if url == "good" else (404, "", b"gone")

    df = spark.createDataFrame([("good",), ("busy",), ("down",), ("missing",), (None,), ("good",)], "url string")
    got = {r.url: (r.status, r.tries, r.content) for r in snapshots.fetch_images(df, get, backoff=0.01).collect()}
    assert got["good"][:2] == (200, 1) and got["busy"][:2] == (200, 3) and got["down"] == (0, 4, None) and got["missing"] == (404, 1, None) and len(got) == 4


def test_pieces_find_all_near_hashes(spark):
    draw = random.Random(1)
    base = [draw.getrandbits(256) for _ in range(40)]
    hashes = [b ^ sum(1 << draw.randrange(256) for _ in range(draw.randrange(9))) for b in base for _ in range(4)]
    df = spark.createDataFrame([(k, f"{h:064x}") for k, h in enumerate(hashes)], "k bigint, h string").select("k", phash.words(F.col("h")).alias("w"), phash.bucket(F.col("h")).alias("b"))
    got = {(r.key1, r.key2, r.distance) for r in phash.blocked_pairs(df, df.limit(0), "k", "w", "b").collect()}
    want = {(i, j, (x ^ y).bit_count()) for j, y in enumerate(hashes) for i, x in enumerate(hashes[:j]) if (x ^ y).bit_count() <= 6 and ((x ^ y) >> 248).bit_count() <= 1}
    assert got == want and len(want) > 30


def test_blocked_matches_equal_all_pairs(spark):
    draw = random.Random(3)
    word = lambda n: "".join(draw.choice("abcde") for _ in range(n))
    names = [" ".join(word(draw.randint(3, 7)) for _ in range(draw.randint(1, 3))) for _ in range(60)] + ["a", "ab", "", None]
    asked = [n if draw.random() < 0.3 else (n or "")[: draw.randint(0, 6)] + word(draw.randint(0, 2)) + (n or "")[5:] for n in names] + [None]
    q, c = spark.createDataFrame([(x,) for x in asked], "q string"), spark.createDataFrame([(x,) for x in names], "m string")
    got = {r.query: (r.match, r.score) for r in fuzzy.best_match(q, c, "q", "m", block=7).collect()}
    known = sorted({n for n in names if n})
    want = {}
    for x in {a for a in asked if a}:
        top = min(((-(100.0 if x == n else fuzzy.weighted_ratio(x, n)), n != x, n) for n in known))
        if -top[0] >= fuzzy.CUTOFF:
            want[x] = (top[2], -top[0])
    assert {k: v[1] for k, v in got.items()} == {k: v[1] for k, v in want.items()} and len(want) > 20
    near = {r.query: (r.distance, r.match) for r in fuzzy.levenshtein_best(q, c, "q", "m", 3).collect()}

    def edits(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            old, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                old, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, old + (x != y))
        return row[-1]

    best = {x: min((edits(x, n), n) for n in {n for n in names if n is not None}) for x in {a for a in asked if a is not None}}
    assert near == {x: b for x, b in best.items() if b[0] <= 3}


def test_one_row_of_equal_keys_is_the_same_on_every_run(spark):
    df = spark.createDataFrame([(1, "b", 2.0), (1, "a", None), (1, None, 9.0), (2, "z", 1.0)], "k bigint, v string, x double")
    first = sorted(map(tuple, R.first_of(df, ["k"]).collect()), key=str)
    assert first == sorted(map(tuple, R.first_of(df.repartition(3), ["k"]).collect()), key=str) == [(1, None, 9.0), (2, "z", 1.0)]


def test_database_tables_by_jdbc(spark):
    """Column pruning and batched fetches over JDBC, on the database that comes with Spark."""
    url = "jdbc:derby:memory:tessera;create=true"
    spark.createDataFrame([(1, "a", 2.0), (2, "b", 3.0)], "id bigint, name string, price double").write.format("jdbc").option("url", url).option("dbtable", "listing").option("driver", "org.apache.derby.iapi.jdbc.AutoloadedDriver").save()
    got = snapshots.jdbc_table(spark, url, "listing", ["id", "price"], 1)
    assert got.columns == ["id", "price"] and sorted(map(tuple, got.collect())) == [(1, 2.0), (2, 3.0)]


def test_database_tables_by_jdbc_in_ranges(spark):
    """Several tasks read a table; nulls and ends of the ranges are all there, filters go to the database."""
    url, driver = "jdbc:derby:memory:tessera;create=true", "org.apache.derby.iapi.jdbc.AutoloadedDriver"
    df = spark.range(1000).select(F.when(F.col("id") % 100 > 0, F.col("id")).alias("id"), (F.col("id") * 2).alias("price"))
    for name, rows_ in (("many", df), ("nothing", df.limit(0)), ("nulls", df.filter("id is null"))):
        rows_.coalesce(1).write.format("jdbc").option("url", url).option("dbtable", name).option("driver", driver).save()
    got = snapshots.jdbc_table(spark, url, "many", ["price"], split="id", parts=4)
    assert got.rdd.getNumPartitions() == 4 and sorted(r.price for r in got.collect()) == [2 * k for k in range(1000)]
    few = snapshots.jdbc_table(spark, url, "many", ["price"], split="id", parts=4, where=F.col("price") < 100)
    assert "PushedFilters: [*IsNotNull(price), *LessThan(price,100)]" in few._jdf.queryExecution().toString().replace("PRICE", "price") and few.count() == 50
    assert snapshots.jdbc_table(spark, url, "nothing", ["price"], split="id").count() == 0
    assert snapshots.jdbc_table(spark, url, "nulls", ["price"], split="id").count() == 10


def test_large_star_and_long_chain(spark):
    from tessera.operators.graph import connected_components

    edges = [(0, k) for k in range(1, 2000)] + [(k, k + 1) for k in range(10_000, 10_500)] + [(5, 5), (None, 3), (2**62, 2**62 + 5), (2**62 + 5, 2**62 + 9)]
    got = {r.id: r.root for r in connected_components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert all(got[k] == 0 for k in range(2000)) and all(got[k] == 10_000 for k in range(10_000, 10_501)) and got[2**62 + 9] == 2**62 and len(got) == 2000 + 501 + 3


def test_a_dead_claim_and_two_appenders(spark, tmp_path, monkeypatch):
    from tessera import storage

    rows = lambda k: spark.createDataFrame([(k,)], "k long")
    one, two = storage.Database(spark, f"{tmp_path}/db"), storage.Database(spark, f"{tmp_path}/db")
    one.replace("t", rows(1))
    (tmp_path / "db/_manifests/00000002.claim").touch()
    with pytest.raises(storage.StaleWrite):  # a healthy writer may have it
        one.append("t", rows(9))
    monkeypatch.setattr(storage, "CLAIM_SECONDS", -1.0)
    one.append("t", rows(2))
    assert one.read("t").count() == two.read("t").count() == 2
    two.append("t", rows(3))
    one.append("t", rows(4))  # both had read before the other's append
    assert sorted(r.k for r in two.read("t").collect()) == [1, 2, 3, 4]
    one.read("t")
    two.append("t", rows(5))
    with pytest.raises(storage.StaleWrite):  # a replacement rests on what was read
        one.replace("t", rows(0))


def test_observed_gate_reads_nothing_again(spark, tmp_path):
    from pyspark.sql import functions as F

    from tessera.operators import quality as Q
    from tessera.storage import Database, PublishRejected

    sc, db = spark.sparkContext, Database(spark, f"{tmp_path}/observed")
    df = spark.range(0, 1000, 1, 4).select("id", (F.col("id") % 7).alias("g"))
    checks = [Q.Observed(f"c{k}", F.count_if(F.col("g") == k), lambda n: n > 0) for k in range(7)] + [Q.Observed("rows", F.count(F.lit(1)), lambda n: n == 1000)]
    sc.setJobGroup("gate", "gate")
    results = Q.publish_observed(db, {"t": (df, checks, [])})
    jobs = sc.statusTracker().getJobIdsForGroup("gate")
    sc.setJobGroup("rest", "rest")
    assert len(jobs) == 1 and len(results) == 8 and all(r.ok for r in results) and db.read("t").count() == 1000
    bad = [Q.Observed("again", F.count_if("again"), lambda n: n == 0)]
    with pytest.raises(PublishRejected):
        Q.publish_observed(db, {"t": (df.limit(10), [], []), "u": (Q.with_repeats(df, ["g"], "again"), bad, ["again"])})
    assert db.tables() == ["t"] and db.read("t").count() == 1000


def test_crowded_hashes_are_nodes_and_pairs_of_pieces(spark):
    draw = random.Random(8)
    plain = [0] * 300 + [(1 << 256) - 1] * 200
    near_plain = [sum(1 << draw.randrange(256) for _ in range(draw.randrange(1, 5))) for _ in range(120)]
    half = [draw.getrandbits(128) ^ sum(1 << draw.randrange(256) for _ in range(draw.randrange(0, 3))) for _ in range(15) for _ in range(1)]
    half += [h ^ (1 << draw.randrange(256)) for h in half for _ in range(4)]
    hashes = plain + near_plain + half
    df = spark.createDataFrame([(k, f"{h:064x}") for k, h in enumerate(hashes)], "k bigint, h string").select("k", phash.words(F.col("h")).alias("w"), phash.bucket(F.col("h")).alias("b"))
    old, new = df.filter("k % 3 = 0"), df.filter("k % 3 > 0")
    near = lambda x, y: (x ^ y).bit_count() <= 6 and ((x ^ y) >> 248).bit_count() <= 1
    want = {(i, j, (x ^ y).bit_count()) for j, y in enumerate(hashes) for i, x in enumerate(hashes[:j]) if near(x, y) and (i % 3 or j % 3)}
    for crowd in (3, 1000):
        assert {tuple(r) for r in phash.blocked_pairs(new, old, "k", "w", "b", crowd=crowd).collect()} == want
    pairs, members = phash.node_pairs(new, old, "k", "w", "b", crowd=3)
    assert members.count() == len(hashes) and members.select("node").distinct().count() == len(set(hashes))
    assert pairs.count() == len({tuple(sorted((x, y))) for i, j, d in want if d for x, y in [(hashes[i], hashes[j])]}) < len(want) / 10
