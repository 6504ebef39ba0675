"""The fuzzy join's index against all pairs."""

from __future__ import annotations

import random

import pytest

from tessera.operators import fuzzy


def strings(draw: random.Random, n: int) -> list[str]:
    letters = "aábcdeěiklmnoprstuvz"
    syllable = lambda: draw.choice("bcdfklmnprstvz") + draw.choice("aeiouáéí")
    common = ["nad", "u", "ves", "nova", "hora", "dolni"]
    word = lambda: draw.choice(common) if draw.random() < 0.35 else "".join(syllable() for _ in range(draw.randint(1, 4)))
    out = [" ".join(word() for _ in range(draw.randint(1, 4))) for _ in range(n)]
    return out + ["".join(draw.choice(letters) for _ in range(draw.randint(1, 12))) for _ in range(n // 4)]


def spoiled(draw: random.Random, s: str) -> str:
    for _ in range(draw.randint(0, 4)):
        k = draw.randrange(len(s) + 1)
        s = draw.choice([s[:k] + draw.choice("abcdeklmo ") + s[k:], s[:k] + s[k + 1 :], " ".join(draw.sample(s.split(), len(s.split()))), s[k:], s + " " + s[:k], s])
    return s


def all_pairs(asked: list, known: list, cutoff: float) -> dict:
    known = sorted({k for k in known if k})
    out = {}
    for q in {a for a in asked if a}:
        if q in known:
            out[q] = (q, 100.0)
            continue
        top = min((-fuzzy.weighted_ratio(q, k), k) for k in known)
        if -top[0] >= cutoff:
            out[q] = (top[1], -top[0])
    return out


@pytest.mark.parametrize("cutoff", [87.0, 86.0, 93.0, 97.0])
def test_best_match_equals_all_pairs(spark, cutoff):
    draw = random.Random(int(cutoff))
    known = strings(draw, 160)
    asked = [spoiled(draw, draw.choice(known)) for _ in range(160)] + draw.sample(known, 5) + strings(draw, 20)
    asked += ["a", "b", "ab", "ves", "a b", "b a", "nova nova", "u  hory", "\tves", "ve s", "x" * 90, "nad " * 30, None, ""]
    known += ["a", "ab", "abc", "vesnice pod horou", "u u", " hora", "x" * 70, "x" * 88, "x y " * 25, None, ""]
    q, m = spark.createDataFrame([(x,) for x in asked], "q string"), spark.createDataFrame([(x,) for x in known], "m string")
    got = {r.query: (r.match, r.score) for r in fuzzy.best_match(q, m, "q", "m", cutoff).collect()}
    want = all_pairs(asked, known, cutoff)
    assert got == want and len(want) > 40


def test_index_looks_at_few_pairs(spark):
    draw = random.Random(5)
    known = sorted({s for s in strings(draw, 1600) if len(s) > 5})
    asked = sorted({spoiled(draw, s) for s in draw.sample(known, 150)} - set(known))
    q, m = spark.createDataFrame([(x,) for x in asked], "query string"), spark.createDataFrame([(x,) for x in known], "match string")
    regular = [df.filter(fuzzy._regular(c)) for df, c in ((q, "query"), (m, "match"))]
    pairs = fuzzy.candidate_pairs(*regular)
    assert pairs.count() == pairs.distinct().count() <= 0.02 * regular[0].count() * regular[1].count()


def test_empty_sides(spark):
    some, none = spark.createDataFrame([("ves",)], "q string"), spark.createDataFrame([], "m string")
    assert fuzzy.best_match(some, none, "q", "m").collect() == []
    assert fuzzy.best_match(none, some, "m", "q").collect() == []
