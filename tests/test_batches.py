"""Address batches: offsets, runs that are killed, and what was sent against what came back."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from tessera.sources import batches
from tessera.storage import Database


def _service():
    return lambda asked: [json.dumps({"norm_city": q["prompt"].upper()}) for q in asked]


def _requests(spark, first, last):
    return spark.range(first, last).select(F.col("id").alias("internal_id"), F.concat(F.lit("Zlín "), "id").alias("prompt"))


def _figures(spark, path, db):
    rows = batches.round_trip(spark, path, db.read("answers")).agg(F.sum("sent"), F.sum("received"), F.sum("open"), F.sum("unasked")).first()
    return tuple(rows)


def test_killed_runs_lose_and_double_nothing(spark, tmp_path, monkeypatch):
    path, check, db = str(tmp_path / "queue"), str(tmp_path / "check"), Database(spark, str(tmp_path / "db"))
    batches.send(_requests(spark, 0, 25), path, 10)
    batches.send(_requests(spark, 5, 25), path, 10)  # repeated
    assert sum(b["rows"] for b in batches.Folder(path).sent()) == 25
    n = batches.answer(spark, path, _service())
    assert n == len(batches.Folder(path).sent()) and batches.answer(spark, path, _service()) == 0
    batches.receive(db, path, "answers", check)
    assert _figures(spark, path, db) == (25, 25, 0, 0)

    # The second run dies after its answers are stored and before the stream's checkpoint says so.
    batches.send(_requests(spark, 20, 60), path, 10)
    batches.answer(spark, path, _service())
    stored = Database.append_absent

    def dies(self, *args):
        stored(self, *args)
        raise RuntimeError("killed")

    monkeypatch.setattr(Database, "append_absent", dies)
    with pytest.raises(Exception, match="killed"):
        batches.receive(db, path, "answers", check)
    monkeypatch.undo()
    batches.receive(Database(spark, db.root), path, "answers", check)
    assert _figures(spark, path, Database(spark, db.root)) == (60, 60, 0, 0)
    got = {r.internal_id: r.answer for r in Database(spark, db.root).read("answers").collect()}
    assert got == {i: json.dumps({"norm_city": f"ZLÍN {i}"}) for i in range(60)}


def test_a_write_that_fails_sends_nothing(spark, tmp_path):
    path = str(tmp_path / "queue")
    bad = _requests(spark, 0, 20).select("internal_id", F.when(F.col("internal_id") == 19, F.raise_error(F.lit("lost"))).otherwise(F.col("prompt")).alias("prompt"))
    with pytest.raises(Exception, match="lost"):
        batches.send(bad, path, 3)
    assert batches.Folder(path).sent() == []
    batches.send(_requests(spark, 0, 20), path, 3)
    assert sorted(r.internal_id for r in batches.sent_requests(spark, path).collect()) == list(range(20))


def test_open_batches_hold_the_offset(spark, tmp_path):
    """Answers are read up to the first open batch; unanswered requests and empty tables have their place."""
    path, check, db = str(tmp_path / "queue"), str(tmp_path / "check"), Database(spark, str(tmp_path / "db"))
    batches.send(_requests(spark, 0, 0), path, 2)
    assert batches.Folder(path).sent() == [] and batches.sent_requests(spark, path).count() == 0
    batches.send(_requests(spark, 0, 8).coalesce(1), path, 2)
    folder = batches.Folder(path)
    for number in (1, 3):
        asked = [json.loads(x) for x in folder.read(f"requests/{folder.sent()[number - 1]['file']}").splitlines()]
        folder.write(f"answers/{number:08d}.json", "".join(json.dumps({"internal_id": q["internal_id"], "answer": "a"}) + "\n" for q in asked))
    assert batches.AnswerReader(folder).latestOffset() == {"batch": 1}
    batches.receive(db, path, "answers", check)
    assert {r.batch for r in db.read("answers").collect()} == {1}
    assert batches.answer(spark, path, lambda asked: [None] * len(asked)) == len(folder.sent()) - 2
    batches.receive(db, path, "answers", check)
    found = {r.batch: (r.sent, r.received, r.open) for r in batches.round_trip(spark, path, db.read("answers")).collect()}
    assert found[1] == (2, 2, 0) and found[3] == (2, 2, 0) and found[2][1:] == (0, found[2][0])
    with pytest.raises(Exception, match="requests, "):
        batches.send(_requests(spark, 10, 14), path, 4)
        batches.answer(spark, path, lambda asked: ["x"] * (len(asked) + 1))
