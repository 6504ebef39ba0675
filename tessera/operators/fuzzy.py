"""Fuzzy matching of short keys: a weighted ratio of edit and token similarity, and best-candidate joins.

Ratios are normalised indel similarities, 100 * 2 * LCS / (len a + len b). The longest common subsequence is found with
bit-parallel integers, so that a comparison takes one pass over one string.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..lineage import cut_lineage

CUTOFF = 87.0


def lcs_length(a: str, b: str) -> int:
    if not a or not b:
        return 0
    masks: dict[str, int] = {}
    for k, c in enumerate(a):
        masks[c] = masks.get(c, 0) | 1 << k
    full = (1 << len(a)) - 1
    s = full
    for c in b:
        u = s & masks.get(c, 0)
        s = (s + u | s - u) & full
    return (full & ~s).bit_count()


def ratio(a: str, b: str) -> float:
    total = len(a) + len(b)
    return 200.0 * lcs_length(a, b) / total if total else 100.0


def partial_ratio(a: str, b: str) -> float:
    """The best ratio of the shorter string to a stretch of the longer one that is as long, or cut at an end."""
    short, long = (a, b) if len(a) <= len(b) else (b, a)
    if not short:
        return 100.0 if not long else 0.0
    best, n = 0.0, len(short)
    for k in range(1 - n, len(long)):
        part = long[max(0, k) : k + n]
        if 200.0 * len(part) / (n + len(part)) > best:
            best = max(best, ratio(short, part))
    return best


def _tokens(a: str, b: str) -> tuple[str, str, str, str, str]:
    x, y = set(a.split()), set(b.split())
    return " ".join(sorted(x & y)), " ".join(sorted(x - y)), " ".join(sorted(y - x)), " ".join(sorted(a.split())), " ".join(sorted(b.split()))


def token_ratio(a: str, b: str) -> float:
    both, only_a, only_b, sorted_a, sorted_b = _tokens(a, b)
    if both and (not only_a or not only_b):
        return 100.0
    best = ratio(sorted_a, sorted_b)
    whole_a, whole_b = f"{both} {only_a}".strip(), f"{both} {only_b}".strip()
    best = max(best, ratio(whole_a, whole_b))
    return max(best, ratio(both, whole_a), ratio(both, whole_b)) if both else best


def partial_token_ratio(a: str, b: str) -> float:
    both, only_a, only_b, sorted_a, sorted_b = _tokens(a, b)
    if both:
        return 100.0
    return max(partial_ratio(sorted_a, sorted_b), partial_ratio(only_a, only_b))


def weighted_ratio(a: str, b: str) -> float:
    """Whole-string similarity, and token or part similarity at a discount that grows with the difference in length."""
    if not a or not b:
        return 0.0
    lengths = max(len(a), len(b)) / min(len(a), len(b))
    whole = ratio(a, b)
    if lengths < 1.5:
        return max(whole, 0.95 * token_ratio(a, b))
    part = 0.9 if lengths <= 8 else 0.6
    return max(whole, part * partial_ratio(a, b), 0.95 * part * partial_token_ratio(a, b))


#: Queries and candidates of a block; a task compares two blocks at a time.
BLOCK = 2_000


def _bound(a: str, b: str, shared: int) -> float:
    """No ratio of the two strings exceeds this: their characters in common, whatever their order."""
    return 200.0 * shared / (len(a) + len(b))


def _numbered_blocks(df: DataFrame, column: str, blocks: int, others: int, place: str, name: str) -> DataFrame:
    """(place, name, _at): the strings of each block as an array, once for every block of the other side."""
    packed = df.groupBy(F.pmod(F.xxhash64(column), F.lit(blocks)).alias(place)).agg(F.array_sort(F.collect_list(column)).alias(name))
    return packed.withColumn("_at", F.explode(F.sequence(F.lit(0), F.lit(others - 1))))


def _all_pairs(asked: DataFrame, known: DataFrame, cutoff: float, block: int) -> DataFrame:
    """(query, match, score): each query's best match, found by comparing the stated queries with all candidates, block by
    block. Blocks of both sides are joined by number, so that no table is gathered anywhere. For what the index can't take."""
    rows, columns = (max(1, -(-df.count() // block)) for df in (asked, known))
    left = _numbered_blocks(asked, "query", rows, columns, "_row", "queries").select((F.col("_row") * columns + F.col("_at")).alias("_cell"), "queries")
    right = _numbered_blocks(known, "match", columns, rows, "_column", "matches").select((F.col("_at") * columns + F.col("_column")).alias("_cell"), "matches")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for asked_here, names in zip(pdf["queries"], pdf["matches"], strict=True):
                counted = [(name, Counter(name)) for name in names]
                for q in asked_here:
                    best, at, letters = cutoff, None, Counter(q)
                    for name, other in counted:
                        lengths = max(len(q), len(name)) / min(len(q), len(name))
                        if lengths < 1.5 and _bound(q, name, sum(min(k, other[c]) for c, k in letters.items())) < best and not set(q.split()) & set(name.split()):
                            continue
                        s = weighted_ratio(q, name)
                        if s > best or (s == best and at is None):
                            best, at = s, name
                    if at is not None:
                        out.append((q, at, best))
            yield pd.DataFrame(out, columns=["query", "match", "score"])

    return left.join(right, "_cell").select("queries", "matches").mapInPandas(run, "query string, match string, score double")


# ---------------------------------------------------------------- the index

#: Cutoffs above this leave two ways to reach them: strings of like length, and a part of a string up to 8 times as long.
INDEXED = 0.95 * 0.9 * 100
#: Pairs of letters are counted in so many classes, so that their counts are a table of fixed size.
CLASSES = 1 << 14


def _classes(grams: list[str]) -> list[int]:
    """Each gram's class, the k-th gram of a class CLASSES further on: what two multisets share stays countable as sets."""
    seen: Counter = Counter()
    out = []
    for g in grams:
        c = zlib.crc32(g.encode()) % CLASSES
        out.append(c + CLASSES * seen[c])
        seen[c] += 1
    return out


def _word_grams(s: str) -> list[int]:
    """Pairs of neighbouring letters of a string's words, the words' ends included: the order of words does not matter."""
    return _classes([w[k : k + 2] for w in (f"\x00{t}\x01" for t in s.split()) for k in range(len(w) - 1)])


def _plain_grams(s: str) -> list[int]:
    """The string's own pairs of letters, each once; a lone letter is its own."""
    return sorted({zlib.crc32(s[k : k + 2].encode()) % CLASSES for k in range(len(s) - 1)} or {zlib.crc32(s.encode()) % CLASSES})


def _letters(s: str) -> list[int]:
    return sorted({zlib.crc32(c.encode()) % CLASSES for c in s})


def _least_shared(cutoff: float, a: float, b: float) -> int:
    """Word grams that two strings of lengths a and b have in common if they reach the cutoff by one of the ratios of like
    lengths. Of a ratio, each letter left out takes two of a string's grams and each put in takes one; of the token ratio,
    whole words are common, and make up nearly all of the shorter string."""
    whole = 1 + math.ceil((a + b) * (3 * cutoff / 200 - 1) - 1e-9)
    tokens = min(100.0, cutoff / 0.95)
    return max(1, min(whole, 1 + math.floor(min(a, b) * tokens / (200 - tokens) + 1e-9)))


def _least_shared_column(cutoff: float, a: Column, b: Column) -> Column:
    """_least_shared as an expression."""
    whole = F.ceil((a + b) * (3 * cutoff / 200 - 1) - 1e-9) + 1
    tokens = min(100.0, cutoff / 0.95)
    return F.greatest(F.lit(1).cast("long"), F.least(whole, F.floor(F.least(a, b) * (tokens / (200 - tokens)) + 1e-9) + 1))


def _least_of_any(cutoff: float, n: int) -> int:
    """The least of _least_shared over all lengths that a partner of a string of n letters can have."""
    return min(_least_shared(cutoff, n, m) for m in range(int(n / 1.5) + 1, math.ceil(1.5 * n)) or (n,))


def _lost(cutoff: float, n: int) -> int:
    """Pairs of letters of a string of n that its best part-wise partner may lack."""
    t = min(100.0, cutoff / 0.9)
    return max(math.floor(3 * n * (1 - t / 100) + 1e-9), math.floor(2 * n * (1 - t / (200 - t)) + 1e-9))


def _regular(column: str) -> Column:
    """Whether a string is its words joined by one space, each word once."""
    words = F.split(F.col(column), " ")
    return ~F.col(column).rlike(r"^\s|\s$|\s\s|[^\S ]|[\x1c-\x1f\x85\p{Z}&&[^ ]]") & (F.size(F.array_distinct(words)) == F.size(words))


def _indexed(strings: DataFrame, column: str, cutoff: float, common: dict[int, int]) -> DataFrame:
    """(s, n, keys, grams, first, plain, lost) of strings. grams: word grams, the rarest first; keys: the pairs of grams of
    its prefix; first: the rarest plain pairs, of which a longer partner has one; plain: all plain pairs and letters."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rank = lambda g: (common.get(g % CLASSES, 0) >> (2 * (g // CLASSES)), g)
        least: dict[int, int] = {}
        for pdf in batches:
            rows = []
            for s in pdf[column]:
                n = len(s)
                grams = sorted(_word_grams(s), key=rank)
                if n not in least:
                    least[n] = _least_of_any(cutoff, n)
                prefix = grams[: max(0, len(grams) - least[n] + 2)]
                keys = [x * 2**24 + y for k, x in enumerate(prefix) for y in prefix[k + 1 :]]
                own = sorted(_plain_grams(s), key=rank)
                lost = _lost(cutoff, n) if n > 1 else 0
                rows.append((s, n, keys, grams, own[: lost + 1], sorted({*own, *_letters(s)}), own, lost))
            yield pd.DataFrame(rows, columns=["s", "n", "keys", "grams", "first", "plain", "own", "lost"])

    return strings.select(column).mapInPandas(run, "s string, n int, keys array<long>, grams array<int>, first array<int>, plain array<int>, own array<int>, lost int")


def _gram_counts(strings: DataFrame, column: str) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: Counter = Counter()
        for pdf in batches:
            for s in pdf[column]:
                total.update(g % CLASSES for g in _word_grams(s))
        yield pd.DataFrame(list(total.items()), columns=["gram", "n"])

    return strings.select(column).mapInPandas(run, "gram int, n long").groupBy("gram").agg(F.sum("n").alias("n"))


def candidate_pairs(asked: DataFrame, known: DataFrame, cutoff: float = CUTOFF) -> DataFrame:
    """(query, match): all pairs of regular strings that can reach a cutoff above INDEXED, and few others.

    An inverted index with prefix filtering. Strings of like length (below 1.5 times) share a least number of word grams,
    whichever ratio they reach the cutoff by; so the two rarest grams that they share are both among the rarest of each, and
    pairs of these are the index's keys. A pair comes from the key of its two rarest shared grams alone, and only if it
    shares enough. A string and one of 1.5 to 8 times its length reach it only if the longer holds nearly all pairs of
    letters of the shorter, so that it is looked up by one of the shorter's rarest pairs.

    asked: query, known: match; strings that are no words joined by one space, each once, must not be among them. The
    counts that tell rare from frequent are a table of CLASSES numbers at most. Jobs run while the result is built."""
    counted = _gram_counts(asked, "query").unionByName(_gram_counts(known, "match"))
    common = {r["gram"]: r["n"] for r in counted.groupBy("gram").agg(F.sum("n").alias("n")).collect()}  # CLASSES rows at most
    q, m = _indexed(asked, "query", cutoff, common), _indexed(known, "match", cutoff, common)
    side = lambda df, x: df.select(F.explode("keys").alias("key"), F.col("s").alias(x), F.col("n").alias(f"n_{x}"), F.col("grams").alias(f"g_{x}"))
    alike = side(q, "query").join(side(m, "match"), "key").filter((F.greatest("n_query", "n_match") < 1.5 * F.least("n_query", "n_match")))
    alike = alike.withColumn("shared", F.array_intersect("g_query", "g_match")).filter(F.size("shared") >= _least_shared_column(cutoff, F.col("n_query"), F.col("n_match")))
    alike = alike.filter(F.col("key") == F.get("shared", F.lit(0)).cast("long") * 2**24 + F.get("shared", F.lit(1))).select("query", "match")
    if cutoff > 90:
        return alike

    def within(short: DataFrame, long: DataFrame, x: str, y: str) -> DataFrame:
        a = short.select(F.explode("first").alias("key"), F.col("s").alias(x), F.col("n").alias("k"), "first", "own", "lost")
        b = long.filter("n > 1").select(F.explode("plain").alias("key"), F.col("s").alias(y), F.col("n").alias("l"), "plain")
        near = a.join(b, "key").filter((F.col("l") >= 1.5 * F.col("k")) & (F.col("l") <= 8 * F.col("k")))
        near = near.filter((F.col("key") == F.get(F.array_intersect("first", "plain"), F.lit(0))) & (F.size(F.array_except("own", "plain")) <= F.col("lost")))
        return near.select("query", "match")

    return alike.unionByName(within(q, m, "query", "match")).unionByName(within(m, q, "match", "query"))


def _scored(pairs: DataFrame, cutoff: float) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            score = [weighted_ratio(a, b) for a, b in zip(pdf["query"], pdf["match"], strict=True)]
            scored = pdf.assign(score=score)
            yield scored[scored["score"] >= cutoff]

    return pairs.mapInPandas(run, "query string, match string, score double")


def best_match(queries: DataFrame, candidates: DataFrame, query: str, candidate: str, cutoff: float = CUTOFF, block: int = BLOCK) -> DataFrame:
    """(query, match, score): for every distinct query the candidate of highest score at or above cutoff, ties to the first
    in order. Exact matches are found by equi-join, the rest by candidate_pairs(), which loses no pair that reaches the
    cutoff. What the index can't take is compared block by block: strings with repeated words or odd white space with all
    strings of the other side, and everything if the cutoff is INDEXED or less. Null and empty strings match nothing."""
    asked = queries.select(F.col(query).alias("query")).filter("query is not null and query <> ''").distinct()
    known = candidates.select(F.col(candidate).alias("match")).filter("match is not null and match <> ''").distinct()
    exact = asked.join(known, asked["query"] == known["match"]).select("query", "match", F.lit(100.0).alias("score"))
    rest = cut_lineage(asked.join(known, asked["query"] == known["match"], "left_anti").withColumn("ok", _regular("query")), "asked")
    known = cut_lineage(known.withColumn("ok", _regular("match")), "known")
    if cutoff <= INDEXED:
        return exact.unionByName(first_best(_all_pairs(rest, known, cutoff, block)))
    found = _scored(candidate_pairs(rest.filter("ok"), known.filter("ok"), cutoff), cutoff)
    odd = [(rest.filter("not ok"), known), (rest.filter("ok"), known.filter("not ok"))]
    for q, m in odd:
        if not q.isEmpty() and not m.isEmpty():
            found = found.unionByName(_all_pairs(q, m, cutoff, block))
    return exact.unionByName(first_best(found))


def first_best(found: DataFrame) -> DataFrame:
    """Of each query's matches the one of highest score, then the first in order."""
    return found.groupBy("query").agg(F.min(F.struct((-F.col("score")).alias("s"), "match")).alias("m")).select("query", "m.match", (-F.col("m.s")).alias("score"))


def levenshtein_best(queries: DataFrame, candidates: DataFrame, query: str, candidate: str, most: int) -> DataFrame:
    """(query, match, distance): the candidate of least edit distance up to `most`, ties to the first in order, inside the JVM.

    Nothing is lost by blocking: a query is cut into most + 1 pieces, of which one stands unharmed in any candidate within
    `most` edits, shifted by at most `most` places; pieces are joined with the candidates' substrings of their lengths at
    those places. Queries too short for pieces are compared with the candidates of like length."""
    n = most + 1
    q = queries.select(F.col(query).alias("query")).filter("query is not null").distinct().withColumn("len", F.length("query"))
    c = candidates.select(F.col(candidate).alias("match")).filter("match is not null").distinct().withColumn("size", F.length("match"))
    q = cut_lineage(q, "asked")
    long = q.filter(F.col("len") >= n)
    cut = lambda k: F.floor(F.col("len") * k / n).cast("int")
    pieces = F.array(*[F.struct(F.lit(k).alias("piece"), cut(k).alias("at"), F.substring(F.col("query"), cut(k) + 1, cut(k + 1) - cut(k)).alias("text")) for k in range(n)])
    left = long.withColumn("p", F.explode(pieces)).select("query", "len", F.col("p.piece"), F.col("p.text"))
    # The candidates' substrings: for each length of a query within reach, piece and shift.
    spread = c.withColumn("len", F.explode(F.sequence(F.greatest(F.col("size") - most, F.lit(n)), F.greatest(F.col("size") + most, F.lit(n)))))
    spots = F.array(*[F.struct(F.lit(k).alias("piece"), (cut(k) + F.lit(d)).alias("at"), (cut(k + 1) - cut(k)).alias("width")) for k in range(n) for d in range(-most, most + 1)])
    right = spread.withColumn("p", F.explode(spots)).filter("p.at >= 0 and p.at + p.width <= size").select("match", "len", F.col("p.piece"), F.substring(F.col("match"), F.col("p.at") + 1, F.col("p.width")).alias("text"))
    pairs = left.join(right.distinct(), ["len", "piece", "text"]).select("query", "match").distinct()
    short = q.filter(F.col("len") < n).withColumn("size", F.explode(F.sequence(F.greatest(F.col("len") - most, F.lit(0)), F.col("len") + most)))
    pairs = pairs.union(short.join(c, "size").select("query", "match"))
    near = pairs.withColumn("d", F.levenshtein("query", "match", most)).filter("d >= 0")
    return near.groupBy("query").agg(F.min(F.struct("d", "match")).alias("m")).select("query", "m.match", F.col("m.d").alias("distance"))
