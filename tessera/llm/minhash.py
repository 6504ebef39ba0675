"""Near-duplicate detection by circulant MinHash, banding and exact Jaccard verification.

Two permutations make the whole signature (C-MinHash): a first one scatters a text's shingles over a circle of CIRCLE
places, a second one gives every place a value, and coordinate k is the least value found k places further along the
circle. As the second permutation lies in memory in order of its places, a shingle's contribution to all coordinates is
one contiguous slice of it.

Equal shingle sets collapse into one class before banding, so that a group of exact copies is one row whatever its size.
A band's bucket is first compared with its smallest member alone (a star), which links a group of near copies with as many
comparisons as it has members. Where a star leaves a bucket's members apart, those outside of its largest component are
compared with all others, in blocks of bounded size.

Recall: a pair of similarity s shares no band with probability (1 - s**ROWS)**BANDS, at 0.8 about 1e-7. A pair that shares
a band is confirmed on its full shingle sets, held as 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.graph import connected_components
from .common import jaccard_counts, keyed_groups, mix64, shingle_sets, stored, text_slices

CIRCLE_BITS = 20
BANDS, ROWS = 30, 4
_SCATTER = np.uint64(0xA24BAED4963EE407)
_TABLE: dict[int, np.ndarray] = {}


def _windows(width: int) -> np.ndarray:
    """Row i: the second permutation's values at places i, i + 1, ... of the circle."""
    if width not in _TABLE:
        size = 1 << CIRCLE_BITS
        order = np.random.Generator(np.random.PCG64(20240229)).permutation(size).astype(np.uint32)
        _TABLE[width] = np.lib.stride_tricks.sliding_window_view(np.concatenate([order, order[:width]]), width)
    return _TABLE[width]


def signature(shingles: np.ndarray, width: int = BANDS * ROWS) -> np.ndarray:
    """All coordinates of a set's circulant MinHash."""
    places = (mix64(shingles * _SCATTER) >> np.uint64(64 - CIRCLE_BITS)).astype(np.int64)
    windows, least = _windows(width), np.full(width, 2**32 - 1, np.uint32)
    for k in range(0, len(places), 2048):
        np.minimum(least, windows[places[k : k + 2048]].min(axis=0), out=least)
    return least


def band_keys(sig: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    parts = sig.reshape(bands, rows).astype(np.uint64)
    key = np.arange(1, bands + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for k in range(rows):
        key = mix64(key ^ parts[:, k] * np.uint64(0xC2B2AE3D27D4EB4F))
    return key.view(np.int64)


def sketch(docs: DataFrame, id_col: str, text_col: str, width: int, bands: int, rows: int) -> DataFrame:
    """(id, n_shingles, d1, d2, bands): the digest (d1, d2) is that of the shingle set; without words bands is null."""
    schema = pa.schema([("id", pa.int64()), ("n_shingles", pa.int64()), ("d1", pa.int64()), ("d2", pa.int64()), ("bands", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            for first, raw, offsets in text_slices(batch.column(1)):
                n, d1, d2, keys = [], [], [], []
                for s in shingle_sets(raw, offsets, width):
                    n.append(len(s))
                    d1.append(int(s.sum(dtype=np.uint64).view(np.int64)) if len(s) else 0)
                    d2.append(int(np.bitwise_xor.reduce(mix64(s + np.uint64(len(s)))).view(np.int64)) if len(s) else 0)
                    keys.append(band_keys(signature(s, bands * rows), bands, rows) if len(s) else None)
                yield pa.RecordBatch.from_arrays([ids.slice(first, len(n)).cast(pa.int64()), *(pa.array(x, pa.int64()) for x in (n, d1, d2)), pa.array(keys, schema.field("bands").type)], schema=schema)

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, "id long, n_shingles long, d1 long, d2 long, bands array<long>")


def _verified(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """The rows (a, b) of pairs whose full shingle sets have 100 * intersection >= percent * union."""
    out = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = batch.column(0), batch.column(1)
            left = {}
            for first, raw, offsets in text_slices(batch.column(2)):
                sets = shingle_sets(raw, offsets, width)
                left.update(zip(range(first, first + len(sets)), sets, strict=True))
            good = []
            for first, raw, offsets in text_slices(batch.column(3)):
                for k, s in enumerate(shingle_sets(raw, offsets, width), first):
                    both, either = jaccard_counts(left.pop(k), s)
                    if both and 100 * both >= percent * either:
                        good.append(k)
            take = pa.array(good, pa.int64())
            yield pa.RecordBatch.from_arrays([a.take(take), b.take(take)], schema=out)

    left = texts.select(F.col("id").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("id").alias("b"), F.col("text").alias("text_b"))
    return pairs.hint("merge").join(left, "a").hint("merge").join(right, "b").select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long")


#: Members and shingles of a block of a bucket; a task compares two blocks at a time.
BLOCK_MEMBERS, BLOCK_SHINGLES = 1024, 1_000_000


def _fingerprints(texts: DataFrame, width: int) -> DataFrame:
    """(id, low): the sorted distinct low halves of a text's shingle hashes, four bytes each."""
    schema = pa.schema([("id", pa.int64()), ("low", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, raw, offsets in text_slices(batch.column(1)):
                low = [np.unique(s.astype(np.uint32)).tobytes() for s in shingle_sets(raw, offsets, width)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(low)), pa.array(low, pa.binary())], schema=schema)

    return texts.select("id", "text").mapInArrow(run, "id long, low binary")


def _common(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(sizes, sizes of all intersections) of a block's sets, by products of 0/1 matrices over the values that repeat."""
    m, size = len(sets), np.array([len(s) for s in sets], np.int64)
    _, at, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    again = times > 1
    column = np.cumsum(again) - 1
    use = again[at]
    row, at = np.repeat(np.arange(m), size)[use], column[at[use]]
    order = np.argsort(at, kind="stable")
    row, at = row[order], at[order]
    both = np.zeros((m, m), np.float32)
    width = int(again.sum())
    step = max(1, (1 << 23) // max(m, 1))
    for c in range(0, width, step):
        lo, hi = np.searchsorted(at, [c, c + step])
        part = np.zeros((m, min(step, width - c)), np.float32)
        part[row[lo:hi], at[lo:hi] - c] = 1
        both += part @ part.T
    both = both.astype(np.int64)
    np.fill_diagonal(both, size)
    return size, both


def _across(members: DataFrame, percent: int) -> DataFrame:
    """(a, b): pairs of a bucket's members in different components that may be links, a spanning forest of them at most.

    members: bucket, i, j (its pair of blocks), block, id, comp, n, bands, low. A pair is looked at in the first bucket
    that its members share. Low halves of hashes may meet by chance: a pair that is above the threshold by more than that
    joins two components here, a pair that may be above it is passed on, and all are confirmed elsewhere on full sets."""
    out = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in keyed_groups(batches, 3):
            key, i, j = (t.column(c)[0].as_py() for c in range(3))
            block, ids, comp, n = (t.column(c).to_numpy() for c in (3, 4, 5, 6))
            bands = np.array(t.column(7).to_pylist(), np.int64)
            size, both = _common([np.frombuffer(x, np.uint32) for x in t.column(8).to_pylist()])
            here = int(np.flatnonzero((bands == key).all(axis=0) if len(bands) else [0])[0])
            parent = {c: c for c in comp.tolist()}

            def root(c: int, parent: dict = parent) -> int:
                while parent[c] != c:
                    parent[c] = c = parent[parent[c]]
                return c

            found: list[tuple[int, int]] = []
            order = np.argsort(n, kind="stable")
            rank_n = n[order]
            for x in range(len(ids)):
                lo, hi = np.searchsorted(rank_n, -(-percent * n[x] // 100), "left"), np.searchsorted(rank_n, n[x], "right")
                ys = order[lo:hi]
                ys = ys[(comp[ys] != comp[x]) & ((n[ys] < n[x]) | (ids[ys] < ids[x]))]
                if i != j:
                    ys = ys[block[ys] != block[x]]
                if not len(ys):
                    continue
                ys = ys[(bands[ys, :here] != bands[x, :here]).all(axis=1)]
                shared, either = both[x, ys], size[x] + size[ys] - both[x, ys]
                doubt = 3 + size[x] * size[ys] // 2**30
                sure = 100 * (shared - doubt) >= percent * (either + doubt)
                for k in np.flatnonzero(100 * (shared + doubt) >= percent * (either - doubt)).tolist():
                    y = ys[k]
                    p, q = root(int(comp[x])), root(int(comp[y]))
                    if p != q:
                        found.append((int(ids[x]), int(ids[y])))
                        if sure[k]:
                            parent[p] = q
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found, strict=True)], schema=out)

    return members.repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j").mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 80, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(id, n_shingles, component_id, kept, class_id), one row per row of docs.

    Texts are lower-cased over A-Z and cut into words at ASCII white space; a text's set holds its distinct width-word
    shingles, or its whole word sequence if it is shorter. Texts with 100 * intersection >= percent * union are linked, and
    component_id is the least id that links reach. class_id is the least id with an equal set.

    Ids are longs or what casts to one; another id is an error. Jobs run while the result is built. A null, empty or blank
    text has n_shingles 0 and stands alone. A null id links nothing, is kept and has a null
    component. Rows that share an id are one node, and all of its rows get the same component. An empty table gives an
    empty result. Other columns of docs are ignored."""
    sketches = stored(sketch(docs, id_col, text_col, width, bands, rows), "sketch")
    linked = sketches.filter("n_shingles > 0 and id is not null")
    classes = stored(linked.groupBy("d1", "d2").agg(F.min("id").alias("rep"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands")), "classes")
    spread = classes.select("rep", "n", F.explode("bands").alias("bucket"))
    buckets = spread.groupBy("bucket").agg(F.min("rep").alias("hub"), F.count(F.lit(1)).alias("size")).filter("size > 1").select("bucket", "hub")
    in_buckets = stored(spread.join(buckets, "bucket"), "buckets")
    pairs = stored(in_buckets.filter("rep <> hub").select(F.col("hub").alias("a"), F.col("rep").alias("b")).distinct(), "pairs")
    involved = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).join(involved.hint("merge"), "id", "left_semi")
    # An id with several texts keeps each: a link of any of them is the node's.
    texts = stored(texts, "texts")
    links = stored(_verified(pairs, texts, width, percent).distinct(), "links")
    # Rows that share an id join their classes.
    same = linked.select("id", "d1", "d2").join(classes.select("d1", "d2", "rep"), ["d1", "d2"]).filter("id <> rep").select(F.col("id").alias("a"), F.col("rep").alias("b"))
    ids_again = linked.groupBy("id").agg(F.count(F.lit(1)).alias("times")).filter("times > 1").select(F.col("id").alias("a"))
    links = stored(links.union(same.join(ids_again, "a", "left_semi")), "links")
    first = connected_components(links)

    comp = in_buckets.select("bucket", "rep", "n").join(first.select(F.col("id").alias("rep"), "root"), "rep", "left").withColumn("comp", F.coalesce("root", "rep")).drop("root")
    comp = stored(comp, "bucket-components")
    # Buckets with members of several components are open. The members of a bucket's largest component are compared with the
    # others alone: they are dealt to blocks once for each block of the others, so that a large group with few others in
    # its buckets costs no more than its size. A bucket that fits into a block is one.
    per = comp.groupBy("bucket", "comp").agg(F.count(F.lit(1)).alias("k"), F.sum("n").alias("m"))
    apart = per.groupBy("bucket").agg(F.count(F.lit(1)).alias("comps"), F.max(F.struct("k", "comp", "m")).alias("most"), F.sum("k").alias("size"), F.sum("m").alias("mass")).filter("comps > 1")
    blocks = lambda k, m: F.ceil(F.greatest(k / BLOCK_MEMBERS, m / BLOCK_SHINGLES)).cast("long")
    apart = apart.select("bucket", F.col("most.comp").alias("major"), blocks(F.col("most.k"), F.col("most.m")).alias("x"), blocks(F.col("size") - F.col("most.k"), F.col("mass") - F.col("most.m")).alias("y"), ((F.col("size") <= BLOCK_MEMBERS) & (F.col("mass") <= BLOCK_SHINGLES)).alias("one"))
    open_rows = comp.select("bucket", "rep", "n", "comp").join(apart, "bucket").withColumn("major", F.col("comp") == F.col("major"))
    open_rows = open_rows.withColumn("block", F.when(F.col("one"), F.lit(0).cast("long")).when(F.col("major"), F.expr("pmod(xxhash64(rep), x)")).otherwise(F.col("x") + F.expr("pmod(xxhash64(rep), y)")))
    open_rows = open_rows.withColumn("other", F.explode(F.when(F.col("one"), F.array(F.lit(0).cast("long"))).when(F.col("major"), F.expr("sequence(x, x + y - 1)")).otherwise(F.expr("sequence(0l, x + y - 1)"))))
    open_rows = open_rows.select("bucket", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", F.col("rep").alias("id"), "comp", "n")
    facts = _fingerprints(texts, width).join(classes.select(F.col("rep").alias("id"), "n", "bands"), "id").select("id", "bands", "low")
    members = open_rows.join(facts, "id").filter(F.array_contains("bands", F.col("bucket"))).select("bucket", "i", "j", "block", "id", "comp", "n", "bands", "low")
    more = stored(_verified(stored(_across(members, percent).distinct(), "across"), texts, width, percent), "more-links")
    root_of = first.select(F.col("id"), "root")
    more = more.join(root_of.select(F.col("id").alias("a"), F.col("root").alias("ra")), "a", "left").join(root_of.select(F.col("id").alias("b"), F.col("root").alias("rb")), "b", "left")
    more = more.select(F.coalesce("ra", "a").alias("a"), F.coalesce("rb", "b").alias("b"))
    second = connected_components(more).select(F.col("id").alias("root"), F.col("root").alias("top"))

    reps = classes.select("d1", "d2", "rep").join(first.select(F.col("id").alias("rep"), "root"), "rep", "left").withColumn("root", F.coalesce("root", "rep"))
    reps = reps.join(second, "root", "left").select("d1", "d2", F.col("rep").alias("class_id"), F.coalesce("top", "root").alias("component_id"))
    labelled = sketches.join(reps, ["d1", "d2"], "left").withColumn("component_id", F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("id")))
    labelled = labelled.withColumn("component_id", F.when(F.col("id").isNotNull(), F.col("component_id")))
    return labelled.select("id", "n_shingles", "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept"), F.when(F.col("id").isNotNull(), F.coalesce("class_id", "id")).alias("class_id"))


#: The contract query (two-word shingles, 80 %) in DuckDB SQL, by comparing all pairs that share a shingle.
ORACLE = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN w IS NULL OR len(w) = 0 THEN [] WHEN len(w) = 1 THEN w ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END AS s FROM w),
u AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM s),
e AS (SELECT a.doc_id AS a, b.doc_id AS b FROM u a JOIN u b ON a.x = b.x AND a.doc_id < b.doc_id AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n) GROUP BY ALL HAVING 100 * count(*) >= 80 * (min(a.n) + min(b.n) - count(*))),
g AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
r AS (SELECT doc_id AS id, doc_id AS reached FROM s UNION SELECT r.id, g.b FROM r JOIN g ON r.reached = g.a),
c AS (SELECT id, min(reached) AS component_id FROM r GROUP BY id)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, c.component_id, s.doc_id = c.component_id AS kept FROM s JOIN c ON c.id = s.doc_id
"""
