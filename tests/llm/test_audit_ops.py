"""Merkle manifest, source divergence and repeated passages against brute force, on awkward rows and the smallest tables."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest

from tessera.llm import divergence, manifest, repeats
from tessera.llm import queries as Q

DIR = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def sha(s: str) -> str:
    return hashlib.sha256(s.encode()).hexdigest()


def rows_of(df) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("name", ["op11_merkle_manifest", "op12_source_divergence", "op13_substring_dedup"])
def test_contract_queries_equal_sql(spark, name):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{DIR}/documents.parquet'")
    got = Q.QUERIES[name](spark, DIR)
    want = con.execute(Q.ORACLES[name])
    assert sorted(d[0] for d in want.description) == sorted(got.columns)
    order = [d[0] for d in want.description]
    assert rows_of(got.select(*order)) == sorted((tuple(r) for r in want.fetchall()), key=str)


# ---------------------------------------------------------------- Merkle manifest


def tree(leaves: list[str], fanout: int) -> tuple[str, list[list[tuple[str, str]]]]:
    """(root, siblings of each leaf by level)."""
    paths: list[list[tuple[str, str]]] = [[] for _ in leaves]
    nodes, at = list(leaves), list(range(len(leaves)))
    while len(nodes) > 1:
        runs = [nodes[k : k + fanout] for k in range(0, len(nodes), fanout)]
        for x, i in enumerate(at):
            run, p = runs[i // fanout], i % fanout
            paths[x].append(("".join(run[:p]), "".join(run[p + 1 :])))
        nodes, at = [sha("".join(r)) for r in runs], [i // fanout for i in at]
    return nodes[0], paths


def manifest_by_hand(rows: list[tuple], fanout: int = 8) -> list[tuple]:
    enc = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    leaf = lambda r, t: sha("".join(enc(v) for v in (*r[:4], t)))
    groups: dict = {}
    for r in rows:
        groups.setdefault(r[2], []).append(r)
    names = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    made = {}
    for n in names:
        own = sorted(groups[n], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[4])))
        made[n] = own, *tree([leaf(r, r[4]) for r in own], fanout)
    root, upper = tree([made[n][1] for n in names], fanout)
    out = []
    for n, above in zip(names, upper, strict=True):
        for r, own in zip(made[n][0], made[n][2], strict=True):
            path = own + above
            hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0
            text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in r[4]) if hit and r[4] else r[4]
            node = leaf(r, text)
            for before, after in path:
                node = sha(before + node + after)
            out.append((r[0], leaf(r, r[4]), made[n][1], root, sha("".join(b + a for b, a in path)), node, node == root))
    return sorted(out, key=str)


def documents(kind: str) -> list[tuple]:
    if kind == "awkward":
        rows = [(i, f"src{i % 3}", "en", 4, f"Text É {i}") for i in range(75)]
        rows += [(i, None, None, None, None) for i in (3, 9, 12)] + [(None, "s", "en", 1, "NULL id"), (None, "s", None, 1, "")]
        rows += [(5, "s", "én", 7, "Twice")] * 9 + [(6, "s", "fr", 0, "")] + [(7, "s", "", 1, "Lone  group")]
        return rows + [(8, "s", "zz", 2, "LONG " * 200_000), (-4, "s", "en", 5, "Negative Id")]
    return {"empty": [], "one": [(1, "a", "en", 1, "A")], "one group": [(i, "a", "en", 1, "A" * i) for i in range(17)], "groups": [(i, "a", f"l{i:02}", 1, "Ab") for i in range(70)]}[kind]


@pytest.mark.parametrize("kind", ["awkward", "empty", "one", "one group", "groups"])
def test_manifest_equals_trees_by_hand(spark, kind):
    rows = documents(kind)
    got = rows_of(manifest.verify_tampered(spark.createDataFrame(rows, SCHEMA)))
    assert got == (manifest_by_hand(rows) if rows else [])
    if kind == "awkward":
        assert {r[-1] for r in got} == {True, False}


def test_manifest_keeps_clashing_columns_and_proves_each_leaf(spark):
    rows = [(k, f"x{k}", "own", "index", "runs") for k in range(30)]
    df = spark.createDataFrame(rows, "id long, leaf string, group string, root string, _part string")
    out = manifest.manifest(df.select("*", manifest.digest("leaf").alias("h")), "group", ["id"], leaf="h", fanout=3)
    assert {"id", "leaf", "group", "_part", "h", "subroot", "root", "path"} == set(out.columns)
    folded = out.select("id", "leaf", "group", "_part", "root", manifest.fold(out["path"], out["h"]).alias("f")).collect()
    root, _ = tree([sha(f"x{k}") for k in range(30)], 3)
    assert len(folded) == 30 and all(r["f"] == r["root"] == root and r["_part"] == "runs" for r in folded)


# ---------------------------------------------------------------- source divergence


def divergence_by_hand(rows: list[tuple], least: int, top: int) -> list[tuple]:
    docs = [(lang or "", source or "", Counter(re.findall(r"[a-z\x80-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")))) for _, source, lang, _, text in rows]
    out = []
    for lang in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == lang]
        seen = Counter(t for d in own for t in d[2])
        kept = [t for t in seen if seen[t] >= least]
        count = {s: Counter() for s in {d[1] for d in own}}
        for _, s, c in own:
            count[s].update({t: c[t] for t in kept if t in c})
        whole = sum(count.values(), Counter())
        p = lambda c, t: 1 + 10**9 * (c[t] + 2) // (sum(c.values()) + 2 * len(kept))  # noqa: B023, E731
        f = lambda a, b, t: (p(a, t) - p(b, t)) ** 2 // (p(a, t) + p(b, t))
        for s, c in count.items():
            pair = [(o, sum(f(c, d, t) for t in kept)) for o, d in count.items() if o != s]
            term = [(t, f(c, whole, t)) for t in kept if c[t] and p(c, t) > p(whole, t)]
            for part, items, limit in (("pair", pair, None), ("term", term, top)):
                ranked = sorted(items, key=lambda x: (-x[1], x[0].encode()))[:limit]
                out += [(lang, s, part, x, v, k + 1) for k, (x, v) in enumerate(ranked)]
    return sorted(out, key=str)


def test_divergence_equals_all_terms_and_pairs(spark):
    words = ["Alpha", "beta", "GAMMA", "été", "ÉTÉ", "don't", "x1y", "日本", "under_score", "a-b"]
    rows = [(i, f"s{i % 4}", "en", 0, " ".join(words[(i * k) % 10] for k in range(1, 2 + i % 9))) for i in range(60)]
    rows += [(i, "s0", "en", 0, "beta " * 50) for i in range(40)] + [(1, None, None, 0, None), (2, "a", None, 0, "beta"), (None, "only", "en", 0, ""), (3, "", "fr", 0, "12 34"), (4, "z", "fr", 0, None)]
    rows += [(5, "long", "en", 0, "Zeta beta\n" * 150_000)] + [(6, "twice", "en", 0, "Alpha beta")] * 3
    df = spark.createDataFrame(rows, SCHEMA).withColumnsRenamed({"n_chars": "term"})
    for least, top in ((3, 2), (10, 10), (10**6, 10)):
        got = rows_of(divergence.audit(df, least_docs=least, top=top))
        assert got == divergence_by_hand(rows, least, top)
    assert divergence.audit(df.limit(0)).collect() == []


def test_divergence_is_exact_beyond_longs_of_the_product(spark):
    from pyspark.sql import functions as F

    n, total, v = 3 * 10**15, 9 * 10**15, 10**9
    got = spark.range(1).select(divergence.probability(F.lit(n), F.lit(total), F.lit(v))).first()[0]
    assert got == 1 + 10**9 * (n + 2) // (total + 2 * v)


def test_divergence_counts_are_the_same_however_often_tasks_flush(spark, monkeypatch):
    df = spark.createDataFrame([("l", f"s{i % 2}", f"a b{i} c a") for i in range(50)], "lang string, source string, text string").repartition(3)
    want = rows_of(divergence.term_counts(df))
    monkeypatch.setattr(divergence, "COUNTERS", 1)
    monkeypatch.setattr(divergence, "LONG_TEXT", 3)
    assert rows_of(divergence.term_counts(df)) == want and len(want) == 6


# ---------------------------------------------------------------- repeated passages


def repeats_by_hand(rows: list[tuple], depth: int) -> list[tuple]:
    docs = [(i, re.findall(r"[^\x20\x09-\x0D]+", text or "")) for i, text in rows]
    least: dict[tuple, int] = {}
    for i, w in docs:
        for k in range(len(w) - depth + 1) if i is not None else ():
            key = tuple(w[k : k + depth])
            least[key] = min(least.get(key, i), i)
    out = []
    for i, w in docs:
        gone = set()
        for k in range(len(w) - depth + 1) if i is not None else ():
            if least[tuple(w[k : k + depth])] < i:
                gone.update(range(k, k + depth))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), sha(kept), kept))
    return sorted(out, key=str)


def passages() -> list[tuple]:
    rng = np.random.default_rng(5)
    say = lambda n: " ".join(f"w{x}" for x in rng.integers(0, 400, n))
    shared, copy, beyond = say(60), say(120), say(200)
    rows = [(i, f"{say(30)} {shared}\t\n{say(20)}") for i in range(1, 12)]  # one passage, many documents
    rows += [(100 - i, copy.replace(" ", "  " if i % 2 else "\u0020", 3)) for i in range(8)]  # copies, white space differs
    rows += [(200 + i, " ".join([*beyond.split()[:i], "odd", *beyond.split()[i:]])) for i in range(0, 200, 9)]  # near copies
    rows += [(300, "la " * 500), (301, "la " * 300 + "end"), (302, "la " * 49), (303, " ".join(f"w{k % 7}" for k in range(400))), (304, " ".join(f"w{k % 7}" for k in range(3, 200)))]
    rows += [(400, None), (401, ""), (402, " \n\t "), (None, copy), (None, say(80)), (1, f"{say(10)} {copy}"), (1, f"{say(10)} {copy}"), (500, f"x\u00a0y {shared}\u2003{copy}"), (501, "É " + say(100))]
    rows += [(600, f"{say(5)} {shared} {shared[3:]} {copy}"), (601, say(49)), (602, " ".join(shared.split()[:50])), (603, " ".join(shared.split()[:49]))]
    return rows + [(700, say(60_000)), (701, say(30_000) + " " + copy)]


@pytest.mark.parametrize("subtree_words", [repeats.SUBTREE_WORDS, 0, 400])
def test_repeats_equal_all_windows(spark, subtree_words):
    """All anchors in subtrees, all by prefixes of full depth, and both kinds."""
    rows = passages()
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, key int, digest string").repartition(3)
    got = rows_of(repeats.remove_repeats(df, subtree_words=subtree_words))
    assert got == repeats_by_hand(rows, 50)
    assert sum(r[2] > 0 for r in got) > 30
    if not subtree_words:
        assert repeats.remove_repeats(df.limit(0)).collect() == []


def test_repeats_of_other_depths_and_packs(spark, monkeypatch):
    monkeypatch.setattr(repeats, "PACK_WORDS", 1)
    rng = np.random.default_rng(1)
    rows = [(int(i), " ".join("ab"[x] for x in rng.integers(0, 2, int(rng.integers(0, 40))))) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for depth, prefix in ((7, 7), (6, 3), (9, 4)):
        assert rows_of(repeats.remove_repeats(df, depth=depth, prefix=prefix, subtree_words=60)) == repeats_by_hand(rows, depth)


def test_deep_nodes_are_the_classes_of_equal_stretches():
    rng = np.random.default_rng(2)
    codes = rng.integers(0, 2, 300)
    for depth in (1, 2, 3, 5, 8, 11):
        starts = np.sort(rng.choice(300 - depth, 150, replace=False))
        node = repeats.deep_nodes(codes, starts, depth)
        keys = [tuple(codes[s : s + depth]) for s in starts]
        times = Counter(keys)
        assert all((n == -1) == (times[k] == 1) for n, k in zip(node, keys, strict=True))
        assert len({(n, k) for n, k in zip(node.tolist(), keys, strict=True) if n >= 0}) == len({n for n in node.tolist() if n >= 0}) == sum(v > 1 for v in times.values())
