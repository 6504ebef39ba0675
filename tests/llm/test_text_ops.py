"""Operators on documents against brute force on small tables."""

from __future__ import annotations

import hashlib
import random
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import common, decontaminate, licences, minhash, mixing, pii, tokens, toxicity

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def documents(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, None if t is None else len(t)) for i, t, s in rows], DOCS)


def brute_components(rows, width, percent):
    sets: dict[int, list[set]] = {}
    for i, t in rows:
        w = (t or "").encode().lower().split()
        sets.setdefault(i, []).append({tuple(w[j : j + width]) for j in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set()))
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in sets:
        for b in sets:
            if b < a and any(x and y and 100 * len(x & y) >= percent * len(x | y) for x in sets[a] for y in sets[b]):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in sets}


@pytest.mark.parametrize("width", [2, 5])
def test_near_duplicates_equal_brute_force(spark, monkeypatch, width):
    monkeypatch.setattr(minhash, "BLOCK_MEMBERS", 32)
    draw = random.Random(width)
    bases = [[draw.choice("abcdefghijklmnopqrst") + draw.choice("xyz") for _ in range(draw.randint(30, 100))] for _ in range(4)]
    rows = []
    for i in range(220):
        w = list(draw.choice(bases))
        for _ in range(draw.randint(0, 12)):
            w[draw.randrange(len(w))] = f"w{draw.randrange(10**6)}"
        rows.append((i, " ".join(w)))
    rows += [(300, None), (301, ""), (302, " \t\n"), (303, "One"), (304, "one"), (305, "a b"), (306, "A  B\n"), (5, "repeated id text here now and so on"), (5, "repeated id text here now and so on"), (400, "w " * 30000), (401, "w " * 30001)]
    df = spark.createDataFrame([(i, t, i) for i, t in rows], "doc_id bigint, text string, id bigint")
    got = {r.id: r for r in minhash.near_duplicates(df, width=width).collect()}
    want = brute_components(rows, width, 80)
    assert {i: r.component_id for i, r in got.items()} == want
    assert all(r.kept == (r.id == r.component_id) for r in got.values())
    assert got[300].n_shingles == got[301].n_shingles == got[302].n_shingles == 0 and got[303].n_shingles == 1


def test_near_duplicates_with_large_ids_and_outliers(spark, monkeypatch):
    """Ids near 2**62, and one group of near copies large enough for several blocks, with few that a star leaves apart."""
    monkeypatch.setattr(minhash, "BLOCK_MEMBERS", 16)
    draw = random.Random(77)
    base, top = [f"w{k}" for k in range(60)], 2**62
    rows = []
    for i in range(150):
        w = list(base)
        for _ in range(draw.choice([0, 1, 1, 2, 5, 6])):
            w[draw.randrange(60)] = f"v{draw.randrange(10**6)}"
        rows.append((top - 3 * i, " ".join(w)))
    df = spark.createDataFrame([(i, t, "k", t) for i, t in rows], "doc_id bigint, text string, kept string, band string")
    got = {r.id: r.component_id for r in minhash.near_duplicates(df, width=2).collect()}
    assert got == brute_components(rows, 2, 80)


def test_near_duplicates_of_nothing_and_null_ids(spark):
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    assert minhash.near_duplicates(empty).count() == 0
    df = spark.createDataFrame([(None, "x y z"), (None, "x y z"), (1, "x y z")], "doc_id bigint, text string")
    got = sorted(((r.id, r.component_id, r.kept) for r in minhash.near_duplicates(df).collect()), key=str)
    assert got == [(1, 1, True), (None, None, True), (None, None, True)]


def test_word_hashes_split_like_bytes():
    draw = random.Random(1)
    texts = ["".join(draw.choice("aB \t\n\x0b\x0c\r\x1cé\xa0.") for _ in range(draw.randrange(60))) for _ in range(200)]
    raw = [t.encode() for t in texts]
    offsets = np.cumsum([0, *map(len, raw)])
    h, counts = common.word_hashes(np.frombuffer(b"".join(raw), np.uint8), offsets)
    words = [w for r in raw for w in r.lower().split()]
    assert counts.tolist() == [len(r.split()) for r in raw]
    assert len({(w, int(x)) for w, x in zip(words, h, strict=True)}) == len(set(words)) == len(set(h.tolist()))


# ---------------------------------------------------------------- mixing


def test_mix_meets_targets(spark):
    draw = random.Random(3)
    rows = [(i, "w " * draw.randint(1, 40), f"s{i % 7}" if i % 3 else "hot") for i in range(3000)] + [(9000 + k, "x " * 5, None) for k in range(50)] + [(9990, None, "s1"), (9991, "", "s1"), (1, "w w w", "s2"), (1, "w w w", "s2")]
    out = mixing.mix(documents(spark, rows)).collect()
    assert len(out) == len(rows)
    total = sum(r.size for r in out)
    by: dict = {}
    for r in out:
        assert r.taken in (0, r.size, 2 * r.size)
        s = by.setdefault(r.source, [0, r.target, r.source_size])
        s[0] += r.taken
    assert sum(t for _, t, _ in by.values()) == pytest.approx(1.5 * total)
    for taken, target, size in by.values():
        assert target <= 2 * size + 1e-6 and abs(taken - target) <= 90
    assert sum(s[0] for s in by.values()) <= 1.5 * total
    key = lambda rs: sorted((str(r.id), r.size, r.taken) for r in rs)
    assert key(out) == key(mixing.mix(documents(spark, rows).repartition(7)).collect())


def test_mix_of_nothing(spark):
    assert mixing.mix(documents(spark, [])).count() == 0
    got = mixing.mix(documents(spark, [(1, None, None), (2, "", "a")])).collect()
    assert sorted((r.id, r.size, r.taken) for r in got) == [(1, 0, 0), (2, 0, 0)]


# ---------------------------------------------------------------- tokens


@pytest.mark.parametrize("block, chunk, span", [(1, 3, 10), (1, 1024, 128 << 20), (7, 1, 50), (7, 2, 1), (64, 5, 300), (100_000, 1024, 128 << 20)])
def test_separator_scan(spark, monkeypatch, block, chunk, span, tmp_path):
    monkeypatch.setattr(tokens, "CHUNK_BLOCKS", chunk)
    monkeypatch.setattr(tokens, "RANGE_BYTES", span)
    draw = random.Random(block)
    lengths = [draw.choice([0, 0, 1, 2, 5, 40, 200]) for _ in range(120)]
    flat = np.concatenate([np.r_[np.full(n, 3), 9] for n in lengths]).astype("<u2")
    (tmp_path / "a.bin").write_bytes(flat.tobytes())
    (tmp_path / "b.bin").write_bytes(np.array([1, 2, 9, 4, 4], "<u2").tobytes())
    (tmp_path / "c.bin").write_bytes(b"")
    (tmp_path / "d 10%.bin").write_bytes(np.array([3] * 90, "<u2").tobytes())
    got: dict[str, list] = {}
    for r in tokens.separator_scan(tokens.read_token_files(spark, str(tmp_path), 2, block), 9).orderBy("file", "ordinal").collect():
        got.setdefault(r.file[-5:], []).append((r.ordinal, r.n_tokens))
    assert got == {"a.bin": list(enumerate(lengths)), "b.bin": [(0, 2), (1, 2)], "%.bin": [(0, 90)]}


def test_token_files_end_with_a_token(spark, tmp_path):
    (tmp_path / "odd.bin").write_bytes(b"abc")
    with pytest.raises(Exception, match="no multiple of 2"):
        tokens.read_token_files(spark, str(tmp_path)).count()
    (tmp_path / "odd.bin").write_bytes(b"")
    assert tokens.separator_scan(tokens.read_token_files(spark, str(tmp_path))).count() == 0


def test_vocabularies_of_one_size_and_width(spark):
    ranks = {bytes([k]): k for k in range(256)}
    one, other = {**ranks, b"ab": 256}, {**ranks, b"cd": 256}
    assert len(tokens.encode(tokens._encoder(one), "abab")) == 2 and len(tokens.encode(tokens._encoder(other), "abab")) == 4
    df = spark.createDataFrame([(1, "x")], "doc_id bigint, text string")
    with pytest.raises(ValueError):
        tokens.token_blocks(df, "doc_id", "text", one, separator=70_000)
    wide = tokens.token_blocks(df.withColumn("tokens", F.lit(1)), "doc_id", "text", one, separator=70_000, width=4)
    assert [r.n_tokens for r in tokens.separator_scan(wide, 70_000, 4).collect()] == [1]


def test_count_tokens_equals_encoding(spark, monkeypatch):
    monkeypatch.setattr(tokens, "PIECE", 500)
    long = " ".join(f"word{k} und" for k in range(2000))
    rows = [(1, "Hello, world"), (2, None), (3, ""), (4, long), (1, "again <|endoftext|>"), (None, "null id")]
    encoder = tokens._encoder(tokens.load_vocabulary())
    want = sorted((str(i), len(encoder.encode_ordinary(t or ""))) for i, t in rows)
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert sorted((str(r.doc_id), r.n_tokens) for r in tokens.count_tokens(df).collect()) == want
    assert tokens.count_tokens(df.limit(0)).count() == 0


# ---------------------------------------------------------------- decontamination


def plain_distance(item, text):
    row = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        new = [i] + [0] * len(text)
        for j, d in enumerate(text, 1):
            new[j] = min(row[j] + 1, new[j - 1] + 1, row[j - 1] + (c != d))
        row = new
    return min(row)


def test_myers_equals_the_table():
    draw = random.Random(1)
    for _ in range(400):
        item = "".join(draw.choice("ab") for _ in range(draw.randint(1, 80)))
        text = "".join(draw.choice("ab") for _ in range(draw.randint(1, 40)))
        got = decontaminate.distance(item, text, 100)
        assert (got[0] if got else len(item)) == min(plain_distance(item, text), len(item))


def test_matches_equal_brute_force(spark):
    draw = random.Random(5)
    word = lambda: "".join(draw.choice("abcdef") for _ in range(draw.randint(2, 7)))
    items = [(k, " ".join(word() for _ in range(draw.randint(4, 30)))) for k in range(12)] + [(50, None), (51, ""), (52, "!!"), (53, "tiny"), (54, "ab")]
    docs = []
    for i in range(60):
        text = [word() for _ in range(40)]
        if i % 2:
            planted = list(items[i % 12][1])
            for _ in range(draw.randint(0, len(planted) // 14)):
                planted[draw.randrange(len(planted))] = draw.choice("abcdef")
            text.insert(20, "".join(planted).upper() if i % 3 else "".join(planted).replace(" ", ",  "))
        docs.append((i, " ".join(text)))
    docs += [(100, None), (101, ""), (102, "x tiny y"), (103, "destiny tinyest"), (104, "zz ab, x"), (105, "long " * 200_000 + items[2][1]), (1, docs[1][1])]
    norm = lambda t: next(iter(decontaminate.normalised(np.frombuffer(t.encode(), np.uint8), np.array([0, len(t)]))))
    want = set()
    for i, t in docs:
        for k, x in items:
            if i == 105:
                continue
            if t and x and norm(x) and plain_distance(norm(x), norm(t)) <= len(norm(x)) // 20 and (len(norm(x)) >= 20 or f" {norm(x)} " in f" {norm(t)} "):
                want.add((i, k, plain_distance(norm(x), norm(t))))
    d = spark.createDataFrame([(i, t, 1) for i, t in docs], "doc_id bigint, text string, item_id int")
    b = spark.createDataFrame(items, "item_id bigint, text string")
    got = {(r.doc_id, r.item_id, r.edits) for r in decontaminate.matches(d, b).collect()}
    assert (105, 2, 0) in got
    got = {m for m in got if m[0] != 105}
    assert got == want and len({i for i, _, _ in want}) > 20
    kept = {r.doc_id for r in decontaminate.clean(d, b).collect()}
    assert kept == {i for i, _ in docs} - {i for i, _, _ in want} - {105}
    assert decontaminate.matches(d, b.limit(0)).count() == 0 and decontaminate.clean(d.limit(0), b).count() == 0


def test_items_in_several_blocks(spark, monkeypatch):
    b = spark.createDataFrame([(k, f"item number {k} has its own text {k * 7919}") for k in range(9)], "item_id bigint, text string")
    assert len(list(decontaminate.item_blocks(b, "item_id", "text", 100))) > 3


# ---------------------------------------------------------------- licences


def test_licence_scan(spark):
    mit = licences.LICENCES["MIT"][0]
    rows = [(1, mit), (2, "Copyright (c) 2020 Somebody\n\n" + mit.upper().replace(" ", "\n")), (3, "text\nreleased under the MIT license\nmore"), (4, mit + " and more"), (5, None), (6, ""), (7, " \n ")]
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id bigint, text string, licence string")
    got = {r.doc_id: (r.licence, r.n_notices, r.notices) for r in licences.scan(df, licences.known_digests(spark)).collect()}
    assert got[1][0] == got[2][0] == "MIT" and got[4][0] is None
    assert got[3] == (None, 1, "MIT") and got[5] == got[6] == got[7] == (None, 0, "")
    assert licences.scan(df.limit(0), licences.known_digests(spark)).count() == 0
    assert licences.scan(df, licences.known_digests(spark).limit(0)).filter("n_notices > 0").count() == 0


def test_licence_forms_and_joined_lines(spark, monkeypatch):
    """Steps that a text can do without change nothing, and lines joined to known texts give what a literal table gives."""
    marks = ["copyright 2020 x", "(c) 1999", "© me", "All Rights Reserved.", "sub-licence", "sub-license", "the licence", "non-commercial", "non-infringement", "copyright-holder", "organisation", "http://a.b", "a non-sequitur", "plain", "(c) by nobody", ""]
    texts = [f"{x}\nReleased under the MIT License.\n{y}" for x in marks for y in marks]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    plain = F.translate("text", licences._UPPER, licences._LOWER)
    for pattern, to, _ in licences.STEPS:
        plain = F.regexp_replace(plain, pattern, to.replace("{1}", "$1"))
    plain = F.regexp_replace(plain, r"^[ \n]+|[ \n]+$", "")
    assert df.filter(~licences.canonical(F.col("text")).eqNullSafe(plain)).count() == 0
    known = licences.known_digests(spark)
    want = sorted(map(tuple, licences.scan(df, known).collect()))
    assert all(r[3] >= 1 for r in want)
    monkeypatch.setattr(licences, "INLINE", 3)
    assert sorted(map(tuple, licences.scan(df, known).collect())) == want


APACHE_HEADER = """# Licensed under the Apache License, Version 2.0 (the "License");
# you may not use this file except in compliance with the License.
# You may obtain a copy of the License at
#
#     http://www.apache.org/licenses/LICENSE-2.0
#
# Unless required by applicable law or agreed to in writing, software
# distributed under the License is distributed on an "AS IS" BASIS,
# WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
# See the License for the specific language governing permissions and
# limitations under the License.
"""


def test_full_texts_and_headers_are_known(spark):
    want, rows = {0: "Apache-2.0", 1: "MIT"}, [(0, APACHE_HEADER), (1, "The MIT License (MIT)\n\nCopyright (c) 2020 Somebody\n\n" + licences.LICENCES["MIT"][1])]
    names = {"Apache-2.0": "Apache-2.0", "GPL-1": "GPL-1.0", "GPL-2": "GPL-2.0", "GPL-3": "GPL-3.0", "LGPL-2.1": "LGPL-2.1", "LGPL-3": "LGPL-3.0", "MPL-1.1": "MPL-1.1", "MPL-2.0": "MPL-2.0", "CC0-1.0": "CC0-1.0", "GFDL-1.3": "GFDL-1.3"}
    for file, name in names.items():
        path = Path("/usr/share/common-licenses") / file
        if path.exists():  # Debian's copies of the published texts
            want[len(rows)] = name
            rows.append((len(rows), path.read_text()))
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert {r.doc_id: r.licence for r in licences.scan(df, licences.known_digests(spark)).collect()} == want


# ---------------------------------------------------------------- personal data


def test_base_spans():
    text = "a.b@c.de 1.2.3.4 300.1.1.1 4111 1111 1111 1111 +420 601 234 567 1234567890123 01.02.03.004"
    kinds = [(pii.KINDS[k], text[s:e]) for k, s, e in pii.base_spans(text)]
    assert kinds[:3] == [("email", "a.b@c.de"), ("ip", "1.2.3.4"), ("ip", "01.02.03.004")]
    assert [(k, t) for k, t in kinds if k == "card"] == []  # the run of digits and spaces around it is one match, and too long
    assert pii.base_spans("x 4111 1111-1111 1111 y") == [(2, 2, 21)] and pii.base_spans("4111111111111112") == []
    assert pii.base_spans("+1 (017) 555-7713.") == [(3, 0, 17)] and pii.base_spans("+1 23 45") == []


def test_base_spans_equal_the_patterns():
    import re

    draw = random.Random(8)
    email, ip = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
    for _ in range(4000):
        text = "".join(draw.choice("aZ1.@-_ +29") for _ in range(draw.randrange(40)))
        assert pii.emails(text) == [m.span() for m in email.finditer(text)], text
        assert [m.span() for m in pii.IP.finditer(text)] == [m.span() for m in ip.finditer(text)], text
    assert pii.base_spans("x" * 300_000 + "@b.cz " + "1" * 300_000) == [(0, 0, 300_005)]


def plain_base(text):
    """The contract's patterns as they stand, and the tests of their matches."""
    import re

    out = []
    for kind, pattern in enumerate((r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]")):
        for m in re.finditer(pattern, text):
            digits = [int(c) for c in re.sub("[^0-9]", "", m[0])]
            doubled = sum(d if k % 2 == 0 else sum(divmod(2 * d, 10)) for k, d in enumerate(reversed(digits)))
            if kind == 0 or (kind == 1 and all(int(x) <= 255 for x in m[0].split("."))) or (kind == 2 and 13 <= len(digits) <= 19 and doubled % 10 == 0) or (kind == 3 and 9 <= len(digits) <= 15):
                out.append((kind, *m.span()))
    return out


def test_base_spans_of_all_kinds_equal_the_patterns():
    draw = random.Random(18)
    for _ in range(6000):
        text = "".join(draw.choice(["4111 1111 1111 1111", "5500-0000-0000-0004", "+420 601 234 567", "1.2.3.4", "a@b.cz", *"0123456789 -.+()ax@"]) for _ in range(draw.randrange(14)))
        assert pii.base_spans(text) == plain_base(text), text


def test_query_equals_the_patterns_on_the_tables(spark):
    from tessera.llm import queries

    got = {r.doc_id: r for r in queries.op9_pii(spark, "/root/testdata/sf0.001").collect()}
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    assert len(docs) == len(got)
    for d in docs:
        base, r = plain_base(d.text or ""), got[d.doc_id]
        text = ",".join(f"{pii.KINDS[k]}:{s}:{e}" for k, s, e in sorted(base))
        assert r.base_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(b[0] == k for b in base) for k in range(4)]
        assert set(filter(None, text.split(","))) <= set(r.spans.split(","))


@pytest.fixture(scope="module")
def field():
    draw = random.Random(2)
    texts = []
    for _ in range(60):
        texts.append(f"und so.{draw.randrange(99)}@mail{draw.randrange(9)}.example.com der die +1 ({draw.randrange(100, 999)}) 555-{draw.randrange(1000, 9999)} x {draw.randrange(255)}.{draw.randrange(255)}.3.4 y token = \"{draw.getrandbits(160):040x}\" z {draw.randrange(10**15, 10**16)} q")
    return pii.train(texts)


def test_field_on_planted_forms(field):
    """Segments of forms that no base pattern matches: recall and precision over whole spans."""
    draw = random.Random(31)
    word = lambda: "".join(draw.choice("abcdefgh") for _ in range(draw.randint(3, 8)))
    hits = dict.fromkeys((0, 3, 4), 0)
    wanted, found, right = dict(hits), 0, 0
    for _ in range(300):
        forms = [
            (0, draw.choice([" [at] ", " (at) "]).join((f"{word()}.{draw.randrange(99)}", f"mail{draw.randrange(9)}.example.com"))),
            (0, f"{word()} at mail{draw.randrange(9)} dot example dot com"),
            (3, f"({draw.randrange(100, 999)}) 555-{draw.randrange(1000, 9999)}"),
            (3, f"001 ({draw.randrange(100, 999)}) 555-{draw.randrange(1000, 9999)}"),
            (4, f"{draw.getrandbits(160):040x}"),
            (None, f"{draw.getrandbits(160):040x}"),
            (None, f"{draw.randrange(10**15, 10**16)}"),
            (None, f"{draw.randrange(1900, 2030)}-{draw.randrange(10, 13)}-{draw.randrange(10, 29)}"),
        ]
        kind, form = draw.choice(forms)
        left = f"{word()} {word()} " + {4: draw.choice(["token = \"", "password: ", "secret="]), None: draw.choice(["commit ", "sha256:"])}.get(kind, "")
        text = f"{left}{form} {word()} {word()}"
        base = pii.base_spans(text)
        spans = field.extra(text, base)
        span = (kind, len(left), len(left) + len(form))
        found += len(spans)
        if kind is not None and not base:
            wanted[kind] += 1
            hits[kind] += span in spans
            right += span in spans
    assert all(hits[k] >= 0.9 * wanted[k] > 20 for k in hits), (hits, wanted)
    assert right >= 0.9 * found, (right, found)


def test_field_tells_phones_from_other_numbers(field):
    """National phone numbers against dates, times, account, book and order numbers, in places that training has not seen."""
    draw = random.Random(77)
    n = lambda k: "".join(str(draw.randrange(10)) for _ in range(k))
    day = lambda: f"{draw.randrange(1, 29):02d}"
    month, year = (lambda: f"{draw.randrange(1, 13):02d}"), (lambda: str(draw.randrange(1950, 2030)))
    phones = (lambda: f"0{n(2)} {n(7)}", lambda: f"0{n(3)}-{n(7)}", lambda: f"(0{n(2)}) {n(3)} {n(2)} {n(2)}", lambda: f"0{n(1)} {n(2)} {n(2)} {n(2)} {n(2)}", lambda: f"(0{n(2)}) {n(3)}-{n(4)}")
    others = (
        lambda: f"{year()}-{month()}-{day()} {day()}:{n(1)}5:1{n(1)}",
        lambda: f"{day()}.{month()}.{year()} {day()}:2{n(1)}",
        lambda: f"{month()}/{day()}/{year()} 1{n(1)}:30",
        lambda: f"{year()}/{month()}/{day()}",
        lambda: f"ISBN 978-{draw.randrange(10)}-{n(2)}-{n(6)}-{n(1)}",
        lambda: f"DE{n(2)} {n(4)} {n(4)} {n(4)} {n(4)} {n(2)}",
        lambda: f"order 4{n(3)}-{n(4)}-{n(2)}",
        lambda: f"1{n(1)} {n(3)} {n(3)} inhabitants",
    )
    wanted = hits = found = right = 0
    for _ in range(600):
        left = draw.choice(("wir sahen ", "la casa es ", "please see ", "Call ", "fon ")) if draw.random() < 0.5 else "mmh abc "
        form = draw.choice(phones)() if draw.random() < 0.5 else ""
        text = f"{left if form else 'on the '}{form or draw.choice(others)()} and so it goes"
        base = pii.base_spans(text)
        if base:
            continue
        spans = field.extra(text, base)
        span = (3, len(left), len(left) + len(form))
        wanted, hits = wanted + bool(form), hits + bool(form and span in spans)
        found, right = found + len(spans), right + bool(form and span in spans)
    assert hits >= 0.9 * wanted > 200 and right >= 0.9 * found, (wanted, hits, found, right)


def test_field_of_the_tables_leaves_dates_and_numbers(spark):
    field = pii.fit(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    for text in ("2024-02-29 12:34:56", "12/05/2023 10:30", "ISBN 978-3-16-148410-0", "DE89 3704 0044 0532 0130 00", "order 4711-0815-99", "version 10.2.33.4567", "1 234 567 890 people"):
        assert field.extra(text, pii.base_spans(text)) == [], text
    text = "Call 030 1234567 today"
    assert field.extra(text, []) == [(3, 5, 16)]


def test_field_in_linear_time(field):
    import time

    for piece in ("mail a.b@c.de and 192.168.0.1 then +1 (017) 555-7713 or 017 555 7713 ", "1", "a1B2", "ab12+/", "joe at ", "1.2.3.", "+1 (", "1 ", "12 345 6 ", "2024-02-29 12:34:56,"):
        text = piece * (200_000 // len(piece))
        start = time.perf_counter()
        field.extra(text, pii.base_spans(text))
        assert time.perf_counter() - start < 15, piece


def test_field_adds_and_keeps(field):
    text = "write joe [at] mail3.example.com or a@b.cz, call (017) 555-7713"
    base = pii.base_spans(text)
    extra = {(pii.KINDS[k], text[s:e]) for k, s, e in field.extra(text, base)}
    assert ("email", "joe [at] mail3.example.com") in extra and any(k == "phone" and "555-7713" in t for k, t in extra)
    assert all(e <= s2 or e2 <= s for _, s, e in field.extra(text, base) for _, s2, e2 in base)
    assert "a@b.cz" not in pii.redact(text, field) and "[EMAIL]" in pii.redact(text, field)
    assert field.extra("clean words only, nothing at all here", []) == []


def test_stretches_are_cut_at_base_spans(field):
    for text, base, other in (
        ("host 192.168.0.1 017 555-7713 x", "192.168.0.1", "017 555-7713"),
        ("tel 017 555-7713/+49 171 7654321 x", "+49 171 7654321", "017 555-7713"),
        ("call 4111 1111 1111 1111 / (017) 555-7713 x", "4111 1111 1111 1111", "(017) 555-7713"),
    ):
        spans = pii.base_spans(text)
        assert [text[s:e] for _, s, e in spans] == [base]
        assert any(a <= text.index(other) and text.index(other) + len(other) <= b for a, b in pii.free_stretches(text, spans)), text
        assert all(e <= s2 or e2 <= s for s, e in pii.free_stretches(text, spans) for _, s2, e2 in spans)
    text = "host 192.168.0.1 (017) 555-7713"
    assert any(k == 3 and "555-7713" in text[s:e] for k, s, e in field.extra(text, pii.base_spans(text)))


def test_every_stretch_has_a_hint(field):
    draw = random.Random(9)
    parts = ["jane", " at ", " at", "\n", " ", "example", ".", "com", " dot ", "(at)", "[ at ]", "@", "-", "at ", "(dot)"]
    for _ in range(20000):
        text = "".join(draw.choice(parts) for _ in range(draw.randrange(9)))
        assert not pii.STRETCH.search(text) or pii._HINT.search(text), text
    text = "mail jane at example.com please"
    assert [(k, text[s:e]) for k, s, e in field.extra(text, [])] == [(0, "jane at example.com")]


def test_training_reads_distinct_texts(spark, monkeypatch):
    read = []
    monkeypatch.setattr(pii, "train", lambda texts, **kw: read.append((texts, kw)))
    rows = [(i % 3 if i else None, f"mail a{i}@b.cz") for i in range(20)] + [(7, "copy 1")] * 50 + [(8, "clean words"), (9, None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    pii.fit(df)
    pii.fit(df.repartition(5), rows=4, most=9)
    assert sorted(read[0][0]) == sorted({t for _, t in rows[:21]}) and read[1] == (read[0][0][:4], {"most": 9})
    pii.fit(df.limit(0))
    assert read[2][0] == []


def test_decode_is_the_best_segmentation(field):
    """The dynamic program against all segmentations, tried one by one."""
    text = "a [at] b.cz"
    lattice = pii.Lattice(text, 0, len(text))
    scores = field.scores(lattice).max(axis=1) - pii.MARGIN if lattice.segments else []

    def best(at):
        if at == lattice.n:
            return 0.0
        return max([best(at + 1)] + [scores[k] + best(j) for k, (i, j) in enumerate(lattice.segments) if i == at])

    spots = {(lattice.cuts[i], lattice.cuts[j]): scores[k] for k, (i, j) in enumerate(lattice.segments)}
    assert sum(spots[s, e] for _, s, e in field.decode(lattice)) == pytest.approx(best(0))


def test_find_and_redact_rows(spark, field):
    rows = [(1, "mail a@b.cz"), (2, None), (3, ""), (4, "x" * 300_000 + " a@b.cz")]
    df = spark.createDataFrame([(i, t, "e") for i, t in rows], "doc_id bigint, text string, spans string")
    got = {r.doc_id: r for r in pii.find(df, field).collect()}
    assert got[1].spans == "email:5:11" and got[2].spans == got[3].spans == "" and got[4].n_email == 1
    assert [r.text for r in pii.redacted(df, field).orderBy("doc_id").collect()][:3] == ["mail [EMAIL]", None, ""]
    assert pii.find(df.limit(0), field).count() == 0


# ---------------------------------------------------------------- toxicity


def plain_matches(s):
    """What a clause's matches are, said without machines."""
    out = []
    for i, c in enumerate(s):
        target = any(x == 3 and abs(i - j) <= 4 for j, x in enumerate(s))
        if c == 1 or (c == 2 and target):
            out.append((i, 8 * (c == 2) + target + 2 * any(x == 4 for x in s[max(0, i - 3) : i]) + 4 * (5 in s[:i])))
    return out


def test_composed_machine_equals_path_enumeration():
    machine, draw = toxicity.grammar_machine(), random.Random(1)
    parts = [toxicity.lexical(), toxicity.threats(), toxicity.targets(), toxicity.negation(), toxicity.reports()]
    for _ in range(1500):
        s = [draw.choice([0, 0, 0, 1, 2, 3, 4, 5]) for _ in range(draw.randint(1, 8))]
        # Composition: the outputs of one machine are the inputs of the next.
        chain = [(0.0, s)]
        for part in parts:
            chain = [(w + v, out) for w, x in chain for v, out in part.paths(x)]
        assert sorted(chain) == sorted(machine.paths(s))
        top = max(w for w, _ in chain)
        best = machine.best(s)
        assert (top, best) in chain
        assert [(k, y - 8) for k, y in enumerate(best) if y >= 8] == plain_matches(s)


def folded_features(grammar, *texts):
    raw = [t.encode() for t in texts]
    return grammar.features(common.folded(np.frombuffer(b"".join(raw), np.uint8)), np.cumsum([0, *map(len, raw)]))


def test_clause_scores_bear_marks():
    key = toxicity._hash_words(["idiot"])
    g = toxicity.Grammar(key, np.array([3.0]))
    label = lambda t: np.flatnonzero(folded_features(g, t)[0][:16]).tolist()
    assert label("an IDIOT here") == [0] and label("you are such an idiot") == [1] and label("idiot, that is what all of you are") == [0] and label("idiot that you are") == [1]
    assert label("he isn't an idiot") == [3] and label("no idiot") == label("this isn\u2019t an idiot") == label("ce n'est qu'idiot") == [2]
    assert label("they said: an idiot") == [5] and label("somebody said an idiot") == [4]
    assert label("kill the lights") == [] and label("i will kill you") == [9] and label("somebody said kill them") == [13]
    assert label("nothing to see. at all") == [] and label("not good. an idiot") == [0]
    # A clause's score adds up, a text's is of all clauses, whatever is around them; far apart words do not meet.
    one, two, far = folded_features(g, "idiot", "idiot and idiot. An idiot", "you " + "x " * 50 + "idiot")
    assert np.expm1(two[0]) == pytest.approx(3 * np.expm1(one[0])) and np.expm1(two[16]) == pytest.approx(2 * np.expm1(one[16])) and far[0] == one[0]
    both = folded_features(g, "idiot", "", "you idiot")
    assert (both[0] == one).all() and not both[1].any() and both[2][1] > 0


def test_marks_change_predictions():
    """On rows whose labels follow the marks, the weights follow them, and without a mark predictions differ."""
    g = toxicity.Grammar(toxicity._hash_words(["idiot"]), np.array([3.0]))
    cases = {"you idiot": 1, "you are not an idiot": 0, "somebody said you idiot": 0, "idiot things": 0, "i will kill you": 1, "she said i will kill you": 0}
    x = folded_features(g, *cases)
    y = np.array(list(cases.values()), float)
    beta = toxicity._logistic(np.repeat(x, 60, axis=0), np.repeat(y, 60))
    for mark, changed in ((0, False), (toxicity.NEGATED, True), (toxicity.REPORTED, True), (toxicity.TARGETED, True)):
        model = toxicity.Model(toxicity.Grammar(g.keys, g.weights, mark), beta)
        raw = [t.encode() for t in cases]
        p = model.scores(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)])) >= 0.5
        assert ((p != y).any()) == changed, mark


def test_toxicity_of_repeated_and_long_rows(spark):
    rows = [(i, "you stupid fool" if i % 2 else "fine words here", "a") for i in range(60)]
    docs = documents(spark, rows + rows[:20] + [(100, "fine " * 400_000 + "you stupid fool", "a"), (101, "x" * 1_000_000, "b"), (None, "you stupid fool", None)])
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)] * 2 + [(7, 0), (None, 1), (3, None), (8, 9)], "doc_id bigint, toxic int")
    model = toxicity.fit(docs, labels)
    got = toxicity.score(docs.withColumn("score", F.lit("x")), model).collect()
    assert len(got) == 83 and {(r.doc_id, r.score) for r in got if r.doc_id == 5}.__len__() == 1
    by = {r.doc_id: r.score for r in got}
    assert by[1] == by[None] > 0.5 > by[0] and by[100] > by[101]


def test_toxicity_on_held_out_rows(spark):
    d, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.fit(d.select("doc_id", "text"), labels.select("doc_id", "toxic"))
    scored = toxicity.score(d.select("doc_id", "text"), model).join(labels, "doc_id").filter(toxicity.held_out() & F.col("toxic").isNotNull())
    r = scored.agg(F.count_if((F.col("toxic") == 1) & (F.col("score") >= 0.5)).alias("hit"), F.count_if(F.col("toxic") == 1).alias("toxic"), F.count_if((F.col("toxic") == 0) & (F.col("score") >= 0.5)).alias("false"), F.count_if(F.col("toxic") == 0).alias("clean")).first()
    assert r.hit / r.toxic > 0.85 and r.false / r.clean < 0.02


def test_toxicity_edges(spark):
    docs = documents(spark, [(1, None, "a"), (2, "", "a"), (3, "fine words", "a")])
    none = spark.createDataFrame([], "doc_id bigint, toxic int")
    model = toxicity.fit(docs, none)
    scores = {r.score for r in toxicity.score(docs, model).collect()}
    assert len(scores) == 1 and max(scores) < 0.5
    assert toxicity.score(documents(spark, [(1, "i will kill you", "a")]), model).first().score > 0.5
    assert toxicity.score(docs.limit(0), model).count() == 0


def test_octets_of_any_length_end_no_job(spark):
    zeros = "0" * 5000
    assert pii.base_spans(f"{zeros}.1.2.3 {zeros}1.{zeros}.2.255 9999.1.1.1 1.2.3.{'9' * 6000}") == [(1, 0, 5006), (1, 5007, 5007 + 5001 + 1 + 5000 + 6)]
    docs = spark.createDataFrame([(1, f"a {zeros}.1.2.3"), (2, "write to bob@example.org"), (3, None)], "doc_id long, text string")
    found = {r["doc_id"]: r for r in pii.find(docs, pii.fit(docs)).collect()}
    assert (found[1]["n_ip"], found[2]["n_email"], found[3]["n_ip"]) == (1, 1, 0)


def test_long_runs_of_white_space_are_encoded_as_the_whole_text():
    encoder = tokens._encoder(tokens.load_vocabulary())
    for white in (" ", "\t", "\n", " \n", "\u3000", "\xa0 "):
        for before, after in (("", ""), ("a", "b"), ("x.", "?"), ("", "1"), ("z", "")):
            for n in (tokens.WHITE_WORD - 1, tokens.WHITE_WORD, 20_001):
                text = before + (white * n)[:n] + after
                for whole in (text, f"{text} and {text}{text}"):
                    assert tokens.encode(encoder, whole).tolist() == encoder.encode_ordinary(whole)
        text = f"a{white * 2_000_000}b"
        assert encoder.decode(tokens.encode(encoder, text).tolist()) == text
