"""Passages that repeat across documents, by suffix trees over words, each for one prefix of the suffixes.

A suffix begins at a word and is of interest to the depth of `depth` words: two documents share a passage of that length if
two of their suffixes meet in a node at least that deep. The suffixes of all documents are split by prefixes so that each
part's tree fits into memory:

* A suffix is filed under the least hash of the PREFIX-word stretches within its first `depth` words (its anchor). Equal
  suffixes have equal anchors, and neighbouring suffixes mostly share theirs, so that a run of them travels as one piece of
  text, not once for each. Anchors that stand in one document alone are dropped before any text moves: no suffix filed there
  repeats. What is compared under an anchor are whole suffixes, so nothing is lost where stretches are alike by chance.
* An anchor whose suffixes would make more than SUBTREE_WORDS words is split by longer prefixes, up to the full depth. A
  prefix of full depth is a deep node itself: its tree has nothing left to branch, and its least document is a partial
  aggregate, whatever the number of suffixes.
* A task takes the anchors of its partition in packs of about PACK_WORDS words and builds a pack's trees level by level: the
  nodes of depth 1, 2, 4, ... are the classes of suffixes that agree so far, those of twice the depth are pairs of them. A
  node that is deep enough and has several suffixes is a repeat. Words are compared as they are, not by hashes.

Documents of equal word sequences are one document, that of least id, until the result is made.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import _STEP, keyed_groups, mix64, stored, text_slices, word_hashes

DEPTH, PREFIX = 50, 16
SUBTREE_WORDS, PACK_WORDS = 32_768, 1 << 20
_U = np.uint64
_SECOND = _U(0x9FB21C651E98DF25)


def _rolled(words: np.ndarray, width: int, step: np.uint64) -> np.ndarray:
    """Hash of the width words from each word on; of the last width - 1 places it is void. Doubling: log2(width) passes."""
    n, out, have = len(words), np.zeros(len(words), _U), 0
    power, block, size = step, words.copy(), 1
    while size <= width:
        if width & size:  # out covers `have` words, then come the `size` words of block
            shifted = np.zeros(n, _U)
            shifted[: max(0, n - have)] = block[have:]
            out = out * power + shifted
            have += size
        longer = np.zeros(n, _U)
        longer[: max(0, n - size)] = block[size:]
        block, power, size = block * power + longer, _U(int(power) ** 2 % 2**64), size * 2
    return out


def _anchors(words: np.ndarray, depth: int, prefix: int) -> np.ndarray:
    """The anchor of the suffix at each word; those that reach past the array's end are void."""
    least, span = mix64(_rolled(words, prefix, _STEP) + _U(prefix)), depth - prefix + 1
    size = 1
    while size < span:
        step = min(size, span - size)
        least[: max(0, len(least) - step)] = np.minimum(least[: max(0, len(least) - step)], least[step:])
        size += step
    return least


def _runs(anchors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first, end) of the runs of equal anchors."""
    cuts = np.flatnonzero(anchors[1:] != anchors[:-1]) + 1
    return np.concatenate([[0], cuts]), np.concatenate([cuts, [len(anchors)]])


def document_facts(docs: DataFrame, depth: int, prefix: int) -> DataFrame:
    """(doc_id, v, n_words, digest, anchors, sizes): digest is the sha256 of the words joined by one space; anchors, and the
    words that their suffixes make, are empty for texts of fewer than depth words. docs: doc_id, v, text."""
    longs = pa.list_(pa.int64())
    schema = pa.schema([("doc_id", pa.int64()), ("v", pa.int64()), ("n_words", pa.int64()), ("digest", pa.string()), ("anchors", longs), ("sizes", longs)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, raw, offsets in text_slices(batch.column(2)):
                words, counts = word_hashes(raw, offsets, lower=False)
                anchors = _anchors(words, depth, prefix).view(np.int64)
                data, ends = raw.tobytes(), np.cumsum(counts).tolist()
                digests, keys, sizes = [], [], []
                for k, (n, end) in enumerate(zip(counts.tolist(), ends, strict=True)):
                    digests.append(hashlib.sha256(b" ".join(data[offsets[k] : offsets[k + 1]].split())).hexdigest())
                    if n >= depth:
                        own = anchors[end - n : end - depth + 1]
                        a, b = _runs(own)
                        keys.append(own[a])
                        sizes.append(b - a + (depth - 1))
                    else:
                        keys.append(None)
                        sizes.append(None)
                m = len(digests)
                columns = [batch.column(c).slice(first, m).cast(pa.int64()) for c in (0, 1)]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(counts.astype(np.int64)), pa.array(digests), pa.array(keys, longs), pa.array(sizes, longs)], schema=schema)

    return docs.select("doc_id", "v", "text").mapInArrow(run, "doc_id long, v long, n_words long, digest string, anchors array<long>, sizes array<long>")


def _suffixes(texts: DataFrame, depth: int, prefix: int) -> DataFrame:
    """The suffixes filed under wanted anchors: (key, key2, doc_id, v, at, words).

    Under an anchor of `near`, a run of suffixes is one row: key is the anchor, at the first one's place, words what they
    cover, and key2 null. Under an anchor of `deep` each suffix is a row with its full-depth prefix as (key, key2)."""
    schema = pa.schema([("key", pa.int64()), ("key2", pa.int64()), ("doc_id", pa.int64()), ("v", pa.int64()), ("at", pa.int64()), ("words", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, vs = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for first, raw, offsets in text_slices(batch.column(2)):
                words, counts = word_hashes(raw, offsets, lower=False)
                anchors = _anchors(words, depth, prefix).view(np.int64)
                one, two = _rolled(words, depth, _STEP), _rolled(mix64(words ^ _SECOND), depth, _SECOND)
                data, ends = raw.tobytes(), np.cumsum(counts).tolist()
                out: list[list] = [[], [], [], []]
                for k, (n, end) in enumerate(zip(counts.tolist(), ends, strict=True)):
                    row = first + k
                    if n < depth:
                        continue
                    own = anchors[end - n : end - depth + 1]
                    a, b = _runs(own)
                    near, deep = (np.isin(own[a], batch.column(c)[row].values.to_numpy(zero_copy_only=False)) for c in (3, 4))
                    if near.any():
                        listed = data[offsets[k] : offsets[k + 1]].split()
                        text, size = b" ".join(listed), np.fromiter(map(len, listed), np.int64, n)
                        stop = np.cumsum(size + 1) - 1
                        begin = stop - size
                        a_near, last = a[near], b[near] + depth - 2
                        out[0].append(own[a_near])
                        out[1].append(np.full(len(a_near), row))
                        out[2].append(a_near)
                        out[3] += [text[x:y] for x, y in zip(begin[a_near].tolist(), stop[last].tolist(), strict=True)]
                    if deep.any():
                        at = np.concatenate([np.arange(x, y) for x, y in zip(a[deep].tolist(), b[deep].tolist(), strict=True)])
                        here = end - n + at
                        m = len(at)
                        yield pa.RecordBatch.from_arrays([pa.array(one[here].view(np.int64)), pa.array(mix64(two[here]).view(np.int64)), pa.array(np.full(m, ids[row])), pa.array(np.full(m, vs[row])), pa.array(at), pa.nulls(m, pa.binary())], schema=schema)
                if out[3]:
                    rows = np.concatenate(out[1])
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(out[0])), pa.nulls(len(rows), pa.int64()), pa.array(ids[rows]), pa.array(vs[rows]), pa.array(np.concatenate(out[2])), pa.array(out[3], pa.binary())], schema=schema)

    return texts.select("doc_id", "v", "text", "near", "deep").mapInArrow(run, "key long, key2 long, doc_id long, v long, at long, words binary")


def deep_nodes(codes: np.ndarray, starts: np.ndarray, depth: int) -> np.ndarray:
    """The node of depth `depth` of each suffix that begins at one of `starts`, -1 where it is alone in its node.

    codes: words as numbers. Nodes of one level are numbered anew at the next, and at the last by the prefixes' order."""
    node, size, n = np.unique(codes, return_inverse=True)[1].astype(np.int64), 1, len(codes)
    while size < depth:
        step = min(size, depth - size)
        ahead = np.zeros(n, np.int64)
        ahead[: n - step] = node[step:]
        if size + step < depth:
            node = np.unique(node * n + ahead, return_inverse=True)[1]
        else:
            node = node[starts] * n + ahead[starts]
        size += step
    _, node, times = np.unique(node if depth > 1 else node[starts], return_inverse=True, return_counts=True)
    return np.where(times[node] > 1, node, -1)


def _subtrees(suffixes: DataFrame, depth: int) -> DataFrame:
    """(doc_id, v, first, last): runs of a document's suffixes whose deep node has a document of smaller id."""
    schema = pa.schema([(c, pa.int64()) for c in ("doc_id", "v", "first", "last")])

    def grow(packed: list[pa.Table]) -> pa.RecordBatch:
        t = pa.concat_tables(packed)
        pieces = t.column("words").to_pylist()
        lengths = np.fromiter((p.count(b" ") + 1 for p in pieces), np.int64, len(pieces))
        numbers: dict[bytes, int] = {}
        codes = np.fromiter((numbers.setdefault(w, len(numbers)) for w in b" ".join(pieces).split(b" ")), np.int64, int(lengths.sum()))
        base = np.cumsum(lengths) - lengths
        each = lengths - depth + 1
        piece = np.repeat(np.arange(len(pieces)), each)
        nth = np.arange(len(piece)) - np.repeat(np.cumsum(each) - each, each)
        node = deep_nodes(codes, base[piece] + nth, depth)
        inner = node >= 0
        piece, nth, node = piece[inner], nth[inner], node[inner]
        doc = t.column("doc_id").to_numpy()[piece]
        least = np.full(int(node.max(initial=-1)) + 1, np.iinfo(np.int64).max)
        np.minimum.at(least, node, doc)
        later = doc > least[node]
        piece, nth = piece[later], nth[later]
        cut = np.flatnonzero((piece[1:] != piece[:-1]) | (nth[1:] != nth[:-1] + 1)) + 1
        a = np.concatenate([[0], cut]) if len(piece) else np.zeros(0, np.int64)
        b = np.concatenate([cut, [len(piece)]]) - 1 if len(piece) else a
        a, b = a.astype(np.int64), b.astype(np.int64)
        at = t.column("at").to_numpy()[piece]
        columns = [t.column(c).to_numpy()[piece[a]] for c in ("doc_id", "v")] + [at[a] + nth[a], at[b] + nth[b]]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for t in keyed_groups(batches, 1):
            if t.num_rows < 2:
                continue
            held.append(t)
            size += t.column("words").nbytes // 6
            if size >= PACK_WORDS:
                yield grow(held)
                held, size = [], 0
        if held:
            yield grow(held)

    filed = suffixes.filter("key2 is null").select("key", "doc_id", "v", "at", "words")
    return filed.repartition("key").sortWithinPartitions("key").mapInArrow(run, "doc_id long, v long, first long, last long")


def _cleared(texts: DataFrame, depth: int) -> DataFrame:
    """(doc_id, v, n_removed, kept_sha256, kept): texts (with runs of suffixes) without the words that those cover."""
    schema = pa.schema([("doc_id", pa.int64()), ("v", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string()), ("kept", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            removed, digests, kept = [], [], []
            for text, firsts, lasts in zip(batch.column(2), batch.column(3), batch.column(4), strict=True):
                words = text.as_py().encode().split()
                edge = np.zeros(len(words) + 1, np.int64)
                np.add.at(edge, firsts.values.to_numpy(), 1)
                np.add.at(edge, lasts.values.to_numpy() + depth, -1)
                keep = np.cumsum(edge[:-1]) == 0
                left = b" ".join([w for w, k in zip(words, keep.tolist(), strict=True) if k])
                removed.append(int(len(words) - keep.sum()))
                digests.append(hashlib.sha256(left).hexdigest())
                kept.append(left.decode())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(removed, pa.int64()), pa.array(digests, pa.string()), pa.array(kept, pa.string())], schema=schema)

    return texts.select("doc_id", "v", "text", "firsts", "lasts").mapInArrow(run, "doc_id long, v long, n_removed long, kept_sha256 string, kept string")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", depth: int = DEPTH, prefix: int = PREFIX, subtree_words: int = SUBTREE_WORDS, with_text: bool = True) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256, kept), one row per row of docs; kept is left out unless with_text.

    Words are runs of bytes other than ASCII white space, unchanged. A word is removed if it is covered by `depth` consecutive
    words of its document that also stand, as a sequence, in a document of smaller id; all is judged on the input. Kept words
    are joined by one space. prefix (at most depth) is the length of the stretches that anchors are made of. Null texts have
    no words. Ids are longs or cast to them; rows with a null id lose nothing and take nothing from others. Rows that share
    an id are documents of equal id: they take nothing from each other, and repeated rows get equal results. An empty table
    gives an empty result. Other columns are ignored. Jobs run while the result is built."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.col(text_col).cast("string")).alias("v"), F.col(text_col).cast("string").alias("text"))
    facts = stored(document_facts(rows, depth, prefix), "facts")
    long = facts.filter((F.col("n_words") >= depth) & F.col("doc_id").isNotNull())
    classes = stored(long.groupBy("digest").agg(F.min(F.struct("doc_id", "v")).alias("of"), F.first("anchors").alias("anchors"), F.first("sizes").alias("sizes")).select("digest", "of.*", "anchors", "sizes"), "classes")
    filed = classes.select("doc_id", "v", F.explode(F.arrays_zip("anchors", "sizes")).alias("f")).select("doc_id", "v", F.col("f.anchors").alias("key"), F.col("f.sizes").alias("size"))
    shared = filed.groupBy("key").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b"), F.sum("size").alias("size")).filter("a < b").select("key", (F.col("size") > subtree_words).alias("deep"))
    wanted = filed.select("doc_id", "v", "key").join(shared, "key").groupBy("doc_id", "v").agg(*[F.collect_set(F.when(F.col("deep") == x, F.col("key"))).alias(n) for n, x in (("near", False), ("deep", True))])
    texts = stored(rows.filter("doc_id is not null").join(wanted, ["doc_id", "v"]).dropDuplicates(["doc_id", "v"]), "texts")
    suffixes = stored(_suffixes(texts, depth, prefix), "suffixes")
    single = suffixes.filter("key2 is not null").select("key", "key2", "doc_id", "v", "at")
    nodes = single.groupBy("key", "key2").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most")).filter("least < most")
    hits = single.join(nodes, ["key", "key2"]).filter("doc_id > least").select("doc_id", "v", F.col("at").alias("first"), F.col("at").alias("last"))
    runs = _subtrees(suffixes, depth).unionByName(hits).groupBy("doc_id", "v").agg(F.collect_list(F.struct("first", "last")).alias("r")).select("doc_id", "v", F.col("r.first").alias("firsts"), F.col("r.last").alias("lasts"))
    cleared = _cleared(texts.join(runs, ["doc_id", "v"]), depth)
    if not with_text:
        cleared = cleared.drop("kept")
    outcome = classes.select("digest", F.col("doc_id").alias("of"), "v").join(cleared.withColumnRenamed("doc_id", "of"), ["of", "v"], "left").drop("v")
    found = facts.select("doc_id", "v", "n_words", "digest").join(outcome, "digest", "left")
    copy = F.coalesce(F.col("doc_id") > F.col("of"), F.lit(False))
    hit = F.col("doc_id").isNotNull() & F.col("kept_sha256").isNotNull()
    made = found.select("doc_id", "v", "n_words", F.when(copy, F.col("n_words")).when(hit, F.col("n_removed")).otherwise(F.lit(0).cast("long")).alias("n_removed"), F.when(copy, F.sha2(F.lit(""), 256)).when(hit, F.col("kept_sha256")).otherwise(F.col("digest")).alias("kept_sha256"), *([F.when(copy, F.lit("")).when(hit, F.col("kept")).alias("kept")] if with_text else []))
    if with_text:  # the texts that lose nothing come from the input, by row
        untouched = rows.dropDuplicates(["doc_id", "v"]).select(F.col("doc_id").alias("_i"), F.col("v").alias("_v"), F.array_join(F.array_remove(F.split(F.coalesce("text", F.lit("")), "[\x20\x09-\x0d]+"), ""), " ").alias("whole"))
        made = made.join(untouched, F.col("doc_id").eqNullSafe(F.col("_i")) & (F.col("v") == F.col("_v")), "left").withColumn("kept", F.coalesce("kept", "whole")).drop("_i", "_v", "whole")
    return made.drop("v")


#: The contract query in DuckDB SQL, by comparing all windows of 50 words.
ORACLE = r"""
WITH w AS (SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
p AS (SELECT r, doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM w),
g AS (SELECT r, doc_id, i, sha256(array_to_string(w[i:i + 49], ' ')) AS h FROM p),
m AS (SELECT r, i, min(doc_id) OVER (PARTITION BY h) < doc_id AS hit FROM g),
e AS (SELECT r, doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM w),
c AS (SELECT e.r, e.i, e.word, coalesce(max(m.hit::INTEGER) OVER (PARTITION BY e.r ORDER BY e.i ROWS BETWEEN 49 PRECEDING AND CURRENT ROW), 0) AS gone FROM e LEFT JOIN m ON m.r = e.r AND m.i = e.i),
k AS (SELECT r, count(*) FILTER (WHERE gone = 1) AS n_removed, coalesce(string_agg(word, ' ' ORDER BY i) FILTER (WHERE gone = 0), '') AS kept FROM c GROUP BY r)
SELECT w.doc_id, len(w.w)::BIGINT AS n_words, coalesce(k.n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(k.kept, '')) AS kept_sha256 FROM w LEFT JOIN k ON k.r = w.r
"""
