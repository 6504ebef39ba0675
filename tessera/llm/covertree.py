"""Exact top-k inner-product search with two cover trees.

Queries and data are both indexed by cover trees: a node's points lie within its covering radius of its centre, and each
level halves the radius. For a pair of nodes no product exceeds <c, c'> + R|c'| + R'|c| + RR'; a pair is dropped if that is
below the worst k-th score of the query node's queries. Queries come in blocks of bounded size; every data task builds
trees over all of its rows, chunk by chunk, and keeps each query's best.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

#: Queries that go to the tasks at once, rows of one data tree, points of a leaf, queries scored together.
QUERY_BLOCK, TREE_ROWS, LEAF, BUNDLE = 16_384, 4_096, 24, 256


class CoverTree:
    """A cover tree over the rows of x (float64), built in one batch. Nodes are numbered from the root, 0."""

    def __init__(self, x: np.ndarray, leaf: int = LEAF):
        self.x, self.order = x, np.arange(len(x))
        self.centre: list[int] = []
        self.radius: list[float] = []
        self.span: list[tuple[int, int]] = []
        self.children: list[list[int]] = []
        pending = [(0, len(x), 0, -1)] if len(x) else []
        while pending:
            a, b, first, parent = pending.pop()
            node = len(self.centre)
            if parent >= 0:
                self.children[parent].append(node)
            rows = self.order[a:b]
            c = rows[first]
            d = np.sqrt(((x[rows] - x[c]) ** 2).sum(axis=1))
            self.centre.append(int(c))
            self.radius.append(float(d.max()))
            self.span.append((a, b))
            self.children.append([])
            if b - a <= leaf or d.max() == 0:
                continue
            # The centre covers what lies within half the radius; each point left over becomes a centre in turn.
            half, left, groups = d.max() / 2, np.arange(b - a), []
            near = d <= half
            while True:
                groups.append(rows[left[near]])
                left = left[~near]
                if not len(left):
                    break
                y = x[rows[left]]
                near = ((y - y[0]) ** 2).sum(axis=1) <= half * half
            at = a
            for k, g in enumerate(groups):
                own = int(np.flatnonzero(g == c)[0]) if k == 0 else 0
                self.order[at : at + len(g)] = g
                pending.append((at, at + len(g), own, node))
                at += len(g)
        self.c = x[self.centre] if self.centre else x
        self.r = np.array(self.radius)
        self.norm = np.sqrt((self.c**2).sum(axis=1))
        self.largest = float(self.norm[0] + self.r[0]) if len(x) else 0.0  # no row's norm is above this
        self.starts = np.array([s for s, _ in self.span], np.int64)
        self.ends = np.array([e for _, e in self.span], np.int64)
        self.is_leaf = np.array([not k for k in self.children], bool)


#: Stands for no score, and the least score that there is.
NONE, LEAST = np.iinfo(np.int64).min, np.iinfo(np.int64).min + 1
#: Products of norms from which on 64-bit floats may round a score.
EXACT = 2.0**53


class Best:
    """The k best (score, id) of each query; equal scores go to smaller ids."""

    def __init__(self, n: int, k: int):
        self.k = k
        self.score = np.full((n, k), NONE, np.int64)
        self.id = np.full((n, k), np.iinfo(np.int64).max)
        self.worst = np.full(n, -np.inf)  # the score that a point must reach, as a float

    def offer(self, q: int, score: np.ndarray, ids: np.ndarray) -> None:
        """score: whole numbers, or floats that hold them exactly."""
        worst = self.worst[q] if score.dtype == np.float64 else self.score[q, -1]
        if len(score) > 4 * self.k:
            worst = max(worst, np.partition(score, -self.k)[-self.k])
        use = score >= worst
        s, i = np.concatenate([self.score[q], score[use].astype(np.int64)]), np.concatenate([self.id[q], ids[use]])
        order = np.lexsort((i, ~s))[: self.k]
        self.score[q], self.id[q] = s[order], i[order]
        if self.score[q, -1] != NONE:
            self.worst[q] = self.score[q, -1]


def exact_scores(query: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers held as floats, exact, and at the ends of a long's range beyond it."""
    q = np.array([int(v) for v in query], object)
    return np.array([min(max(int(sum(q * [int(v) for v in p])), LEAST), -LEAST) for p in points], np.int64)


def dual_search(queries: CoverTree, query_ids: np.ndarray, data: CoverTree, ids: np.ndarray, best: Best) -> None:
    """Offers to every query its best data points; a point with the query's own id is not one."""
    if not len(queries.x) or not len(data.x):
        return
    bounds_slack = 1e-9
    wide = queries.largest * data.largest >= EXACT

    def bound(q: int, nodes: np.ndarray) -> np.ndarray:
        b = data.c[nodes] @ queries.c[q] + queries.r[q] * data.norm[nodes] + data.r[nodes] * queries.norm[q] + queries.r[q] * data.r[nodes]
        b += bounds_slack * (np.abs(b) + 1)
        if wide:
            b = np.maximum(b + queries.x.shape[1] * 2.0**-50 * (queries.norm[q] + queries.r[q]) * (data.norm[nodes] + data.r[nodes]), float(LEAST))
        return b

    def expand(q: int, rows: np.ndarray, nodes: np.ndarray) -> np.ndarray:
        """The data leaves under nodes that may hold something for the query node's rows."""
        leaves = []
        while len(nodes):
            nodes = nodes[bound(q, nodes) >= best.worst[rows].min()]
            leaves.append(nodes[data.is_leaf[nodes]])
            inner = nodes[~data.is_leaf[nodes]]
            nodes = np.array([c for n in inner.tolist() for c in data.children[n]], np.int64)
        return np.concatenate(leaves) if leaves else np.zeros(0, np.int64)

    def score(q: int, rows: np.ndarray, leaves: np.ndarray) -> None:
        b = bound(q, leaves)
        order = np.argsort(-b, kind="stable")
        leaves, b = leaves[order], b[order]
        sizes = np.cumsum(data.ends[leaves] - data.starts[leaves])
        k = 0
        while k < len(leaves):
            if b[k] < best.worst[rows].min():
                break
            end = max(k + 1, int(np.searchsorted(sizes, (sizes[k - 1] if k else 0) + 1024, "right")))
            points = np.concatenate([data.order[data.starts[n] : data.ends[n]] for n in leaves[k:end].tolist()])
            product = queries.x[rows] @ data.x[points].T
            product[query_ids[rows][:, None] == ids[points][None, :]] = -np.inf
            if wide:
                offer_wide(rows, points, product)
            else:
                for r in np.flatnonzero((product >= best.worst[rows][:, None]).any(axis=1) & (product > -np.inf).any(axis=1)).tolist():
                    real = product[r] > -np.inf
                    best.offer(int(rows[r]), product[r][real], ids[points][real])
            k = end

    def offer_wide(rows: np.ndarray, points: np.ndarray, product: np.ndarray) -> None:
        """Scores that floats may have rounded: those that may count are made anew from whole numbers."""
        norms = np.sqrt((data.x[points] ** 2).sum(axis=1))
        for r, worst in enumerate(best.worst[rows].tolist()):
            rounding = queries.x.shape[1] * 2.0**-50 * norms * np.sqrt((queries.x[rows[r]] ** 2).sum())
            real = product[r] > -np.inf
            sure = (product[r] - rounding)[real]
            if len(sure) > best.k:
                worst = max(worst, min(np.partition(sure, -best.k)[-best.k], -float(LEAST)))
            use = np.flatnonzero(real & (np.maximum(product[r] + rounding, float(LEAST)) >= worst))
            if len(use):
                best.offer(int(rows[r]), exact_scores(queries.x[rows[r]], data.x[points[use]]), ids[points[use]])

    pending = [(0, np.zeros(1, np.int64))]
    while pending:
        q, nodes = pending.pop()
        rows = queries.order[queries.starts[q] : queries.ends[q]]
        if len(rows) <= BUNDLE or queries.is_leaf[q]:
            leaves = expand(q, rows, nodes)
            for a in range(0, len(rows), BUNDLE):
                score(q, rows[a : a + BUNDLE], leaves)
            continue
        nodes = nodes[bound(q, nodes) >= best.worst[rows].min()]
        small = [c for c in queries.children[q] if queries.ends[c] - queries.starts[c] <= LEAF]
        if len(small) > 4:
            # Many small children: their queries are scored in bundles, within the bounds of this node.
            few = np.concatenate([queries.order[queries.starts[c] : queries.ends[c]] for c in small])
            leaves = expand(q, few, nodes)
            for a in range(0, len(few), BUNDLE):
                score(q, few[a : a + BUNDLE], leaves)
            small = set(small)
        else:
            small = set()
        pending += [(c, nodes) for c in queries.children[q] if c not in small]


def quantised(vectors: DataFrame, id_col: str, vector_col: str, factor: int = 256) -> DataFrame:
    """(vec_id, dim, v): floor(factor * x) of every component as 64-bit floats. Rows with a null id, a null or empty vector
    or a null or non-finite component are left out, and so are those with a component that is no 64-bit whole number: beyond
    2**63 no such number stands for it. Scores beyond that range are given as its ends."""
    schema = pa.schema([("vec_id", pa.int64()), ("dim", pa.int64()), ("v", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, lists = batch.column(0), batch.column(1)
            lengths = np.where(np.asarray(lists.is_valid()), np.nan_to_num(lists.value_lengths().to_numpy(zero_copy_only=False).astype(float)), 0).astype(np.int64)
            flat = lists.flatten()  # null lists have no part in it
            with np.errstate(over="ignore"):
                x = np.floor(factor * np.where(np.asarray(flat.is_valid()), flat.to_numpy(zero_copy_only=False), np.nan).astype(np.float64))
            ends = np.cumsum(lengths)
            bad = np.concatenate([[0], np.cumsum(~(np.abs(x) < 2.0**63))])
            use = np.flatnonzero(np.asarray(ids.is_valid()) & (lengths > 0) & (bad[ends] == bad[ends - lengths]))
            raw = x.tobytes()
            rows = [raw[8 * (ends[k] - lengths[k]) : 8 * ends[k]] for k in use.tolist()]
            yield pa.RecordBatch.from_arrays([ids.take(pa.array(use)).cast(pa.int64()), pa.array(lengths[use]), pa.array(rows, pa.binary())], schema=schema)

    return vectors.select(F.col(id_col).cast("long"), F.col(vector_col)).mapInArrow(run, "vec_id long, dim long, v binary")


def _block_search(data: DataFrame, rows: list, k: int, number: int) -> DataFrame:
    """(query_id, key, vec_id, score): each task's best rows of data for one block of queries, whose trees go to the tasks."""
    trees: dict[int, CoverTree] = {}
    ids_of: dict[int, np.ndarray] = {}
    for dim in sorted({r["dim"] for r in rows}):
        own = [r for r in rows if r["dim"] == dim]
        ids_of[dim] = np.array([r["vec_id"] for r in own], np.int64)
        trees[dim] = CoverTree(np.frombuffer(b"".join(bytes(r["v"]) for r in own), np.float64).reshape(len(own), dim))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = {d: Best(len(t.x), k) for d, t in trees.items()}
        held: dict[int, tuple[list, list, int]] = {}

        def search(dim: int) -> None:
            ids, raw, _ = held.pop(dim)
            x = np.concatenate(raw)
            dual_search(trees[dim], ids_of[dim], CoverTree(x), np.concatenate(ids), best[dim])

        for batch in batches:
            dims, ids = batch.column(1).to_numpy(), batch.column(0).to_numpy()
            for dim in np.unique(dims).tolist():
                if dim not in trees:
                    continue
                use = np.flatnonzero(dims == dim)
                column = batch.column(2).take(pa.array(use))
                start, end = np.frombuffer(column.buffers()[1], np.int32, len(column) + 1, 4 * column.offset)[[0, -1]] if len(column) else (0, 0)
                x = np.frombuffer(column.buffers()[2], np.uint8)[start:end].view(np.float64).reshape(len(use), dim)
                for a in range(0, len(use), TREE_ROWS):
                    own, raw, n = held.setdefault(dim, ([], [], 0))
                    own.append(ids[use[a : a + TREE_ROWS]])
                    raw.append(x[a : a + TREE_ROWS])
                    held[dim] = (own, raw, n + len(own[-1]))
                    if held[dim][2] >= TREE_ROWS:
                        search(dim)
        for dim in list(held):
            search(dim)
        for dim, b in best.items():
            q, place = np.nonzero(b.score != NONE)
            # Queries of one id and different vectors are told apart by block, length and place.
            key = pa.array([f"{number}.{dim}.{x}" for x in q.tolist()], pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(ids_of[dim][q]), key, pa.array(b.id[q, place]), pa.array(b.score[q, place])], names=["query_id", "key", "vec_id", "score"])

    return data.mapInArrow(run, "query_id long, key string, vec_id long, score long")


def top_k(data: DataFrame, queries: DataFrame, k: int = 5, block: int = QUERY_BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k best rows of data by inner product, equal scores by smaller vec_id.

    Both are quantised() tables, and only vectors of one length are compared. A row with the query's id is its own and no
    candidate. Repeated data rows count each; queries with equal id and vector are one. Fewer candidates than k give fewer
    ranks; empty tables give an empty result. The stated queries are met with all rows block by block: the driver holds one
    block's trees at a time, and each block's pass over the data is done and written before the next one's begins."""
    order = Window.partitionBy("query_id", "key").orderBy(F.desc("score"), "vec_id")
    queries = queries.select("vec_id", "dim", "v").distinct()
    blocks = max(1, -(-queries.count() // block))
    if blocks > 1:
        queries = stored(queries.withColumn("b", F.pmod(F.xxhash64("vec_id", "v"), F.lit(blocks))), "queries")
    parts = None
    for number in range(blocks):
        rows = (queries.filter(F.col("b") == number) if blocks > 1 else queries).orderBy("vec_id", "v").collect()
        found = _block_search(data, rows, k, number).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
        found = stored(found, "found") if blocks > 1 else found
        parts = found if parts is None else parts.unionByName(found)
    return parts


def search_all(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", every: int = 50, k: int = 5) -> DataFrame:
    """top_k of the rows whose id is divisible by `every` among all rows."""
    data = stored(quantised(vectors, id_col, vector_col), "vectors")
    return top_k(data, data.filter(F.col("vec_id") % every == 0), k)


ORACLE = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, d.vec_id, list_inner_product(q.e, d.e)::BIGINT AS score FROM v q JOIN v d ON d.vec_id <> q.vec_id WHERE q.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
