"""How far the sources of a class (a language, say) differ in their use of terms, as exact integer divergences.

A pair of sources starts at what it would have if neither used any term: V times f of the two zero-count probabilities.
An inverted index (term -> the sources that use it) then emits corrections, and only those that are not zero:
* of a term that one of the two uses: f(p, zero) - f(zero, zero). They depend on the source and its count alone, so a source's
  terms of equal probability are counted first, and it is these counts that meet the other sources, not the terms;
* of a term that both use: what is left, f(p, q) - f(p, zero) - f(zero, q) + f(zero, zero), from the term's postings.
Sums are integers, so their order does not matter.

Terms are counted in the tasks before anything is shuffled: a task sends a source's term once per flush of its counters,
however often a term occurs and whatever share of the rows a source has.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

#: Over UTF-8: letters of ASCII and all bytes of other characters. bytes.lower() changes A-Z alone.
TERM = re.compile(rb"[a-z\x80-\xff]+")
SCALE = 1_000_000_000
#: Counters that a task holds before it sends them on, and bytes from which a text's terms are not listed at once.
COUNTERS, LONG_TEXT = 200_000, 1 << 20


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences, and rows with the term. docs: lang, source, text, none of them null."""
    schema = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.binary()), ("n", pa.int64()), ("docs", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str], tuple[Counter, Counter]] = {}

        def flush() -> Iterator[pa.RecordBatch]:
            for (lang, source), (n, rows) in held.items():
                terms = list(n)
                columns = pa.array([lang] * len(terms), pa.string()), pa.array([source] * len(terms), pa.string()), pa.array(terms, pa.binary())
                yield pa.RecordBatch.from_arrays([*columns, pa.array(n.values(), pa.int64()), pa.array([rows[t] for t in terms], pa.int64())], schema=schema)
            held.clear()

        size = 0
        for batch in batches:
            for lang, source, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                raw = text.as_py().lower()
                n, rows = held.setdefault((lang, source), (Counter(), Counter()))
                before = len(n)
                if len(raw) < LONG_TEXT:
                    terms = TERM.findall(raw)
                    n.update(terms)
                    rows.update(set(terms))
                else:
                    own = Counter(m.group() for m in TERM.finditer(raw))
                    n.update(own)
                    rows.update(own.keys())
                size += len(n) - before
                if size >= COUNTERS:
                    yield from flush()
                    size = 0
        yield from flush()

    made = docs.select("lang", "source", F.col("text").cast("binary")).mapInArrow(run, "lang string, source string, term binary, n long, docs long")
    return made.groupBy("lang", "source", F.col("term").cast("string").alias("term")).agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def probability(n: Column, total: Column, terms: Column) -> Column:
    """1 + floor(SCALE * (n + 2) / (total + 2 * terms)), exact for all longs; null without terms."""
    wide = lambda c: c.cast("decimal(19,0)")
    share = F.call_function("div", F.lit(SCALE).cast("decimal(10,0)") * wide(n + 2), wide(total + 2 * terms))
    return F.when(terms > 0, F.lit(1) + share)


def distance(p: Column, q: Column) -> Column:
    """floor((p - q)**2 / (p + q)); both are at most SCALE + 1, so that the square fits a long."""
    return F.call_function("div", (p - q) * (p - q), p + q)


#: Sources of a class whose rows meet the class's other sources in one task.
BLOCK = 256


def _pair_sums(groups: DataFrame, postings: DataFrame) -> DataFrame:
    """(lang, a, b, value) of each pair a < b of a class's sources."""
    zero = lambda x, y: distance(F.col(x), F.col(y))
    # A class's sources are dealt to blocks, each of which meets all of its sources.
    blocks = groups.groupBy("lang").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("k"))
    others = groups.join(blocks, "lang").select("lang", F.col("source").alias("b"), F.col("zero").alias("zb"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("k") - 1)).alias("block"))
    own = groups.join(blocks, "lang").select("lang", F.col("source").alias("a"), F.col("zero").alias("za"), "terms", F.expr("pmod(xxhash64(source), k)").alias("block"))
    base = own.join(others, ["lang", "block"]).filter("a < b").select("lang", "a", "b", F.when(F.col("terms") > 0, F.col("terms") * zero("za", "zb")).otherwise(F.lit(0)).alias("d"))
    alike = postings.groupBy("lang", F.col("source").alias("a"), "p").agg(F.count(F.lit(1)).alias("times"))
    single = alike.join(own.select("lang", "a", "za", "block"), ["lang", "a"]).join(others, ["lang", "block"]).filter("a <> b")
    single = single.select("lang", F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), (F.col("times") * (zero("p", "zb") - zero("za", "zb"))).alias("d"))
    side = lambda x, p, z: postings.select("lang", "term", F.col("source").alias(x), F.col("p").alias(p), F.col("zero").alias(z))
    both = side("a", "pa", "za").join(side("b", "pb", "zb"), ["lang", "term"]).filter("a < b")
    both = both.select("lang", "a", "b", (zero("pa", "pb") - zero("pa", "zb") - zero("za", "pb") + zero("za", "zb")).alias("d"))
    sums = lambda df: df.filter("d <> 0").groupBy("lang", "a", "b").agg(F.sum("d").alias("d"))
    return base.unionByName(sums(single)).unionByName(sums(both)).groupBy("lang", "a", "b").agg(F.sum("d").alias("value"))


def audit(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text", least_docs: int = 10, top: int = 10) -> DataFrame:
    """(lang, source, part, item, value, rank) of every (lang, source) that occurs; the arguments name the columns of docs.

    Part `pair`: each other source of the lang, by the sum of distances over all kept terms. Part `term`: the terms that the
    source uses more than its lang does, by distance, ranks up to `top`. A kept term is in at least least_docs rows of its
    lang. Ranks count from 1, value descending, then item ascending by UTF-8 bytes. A null lang, source or text counts as
    empty; rows without terms are rows of their group, and repeated rows count each. A lang without kept terms has pairs of
    value 0 and no terms, a lone source has no pairs, and an empty table gives an empty result. Other columns are ignored.
    Jobs run while the result is built."""
    named = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for n, c in (("lang", lang), ("source", source), ("text", text))]
    rows = docs.select(*named)
    counts = stored(term_counts(rows), "term-counts")
    kept = stored(counts.groupBy("lang", "term").agg(F.sum("docs").alias("rows"), F.sum("n").alias("n_lang")).filter(F.col("rows") >= least_docs), "terms")
    facts = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"), F.sum("n_lang").alias("total_lang"))
    used = stored(counts.join(kept.select("lang", "term", "n_lang"), ["lang", "term"]).select("lang", "source", "term", "n", "n_lang"), "used")
    totals = used.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = rows.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(facts, "lang", "left").na.fill(0, ["total", "terms", "total_lang"])
    groups = stored(groups.withColumn("zero", probability(F.lit(0).cast("long"), F.col("total"), F.col("terms"))), "groups")
    p, q = probability(F.col("n"), F.col("total"), F.col("terms")), probability(F.col("n_lang"), F.col("total_lang"), F.col("terms"))
    postings = stored(used.join(groups, ["lang", "source"]).select("lang", "source", "term", p.alias("p"), q.alias("q"), "zero"), "postings")
    terms = postings.filter("p > q").select("lang", "source", F.col("term").alias("item"), distance(F.col("p"), F.col("q")).alias("value"))
    sums = stored(_pair_sums(groups.select("lang", "source", "terms", "zero"), postings), "pairs")
    pairs = sums.select("lang", F.col("a").alias("source"), F.col("b").alias("item"), "value").union(sums.select("lang", "b", "a", "value"))
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    part = lambda df, name: df.withColumn("rank", rank).select("lang", "source", F.lit(name).alias("part"), "item", "value", "rank")
    return part(pairs, "pair").unionByName(part(terms, "term").filter(F.col("rank") <= top))


#: The contract query in DuckDB SQL, with every term and every pair of sources.
ORACLE = r"""
WITH d AS (SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
e AS (SELECT lang, source, w, row_number() OVER () AS r FROM d),
t AS (SELECT lang, source, r, unnest(w) AS term FROM e),
c AS (SELECT lang, source, term, count(*) AS n FROM t GROUP BY ALL),
k AS (SELECT lang, term, count(*) AS n FROM t GROUP BY ALL HAVING count(DISTINCT r) >= 10),
g AS (SELECT DISTINCT lang, source FROM d),
v AS (SELECT lang, count(*) AS v, sum(n) AS total FROM k GROUP BY lang),
u AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, k.n AS m FROM g JOIN k USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
s AS (SELECT lang, source, sum(n) AS total FROM u GROUP BY ALL),
p AS (SELECT u.lang, u.source, u.term, u.n, 1 + (1000000000::HUGEINT * (u.n + 2)) // (s.total + 2 * v.v) AS p, 1 + (1000000000::HUGEINT * (u.m + 2)) // (v.total + 2 * v.v) AS q FROM u JOIN s ON s.lang = u.lang AND s.source = u.source JOIN v ON v.lang = u.lang),
x AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
y AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(x.value, 0) AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source
      UNION ALL SELECT lang, source, 'term', term, (p - q) * (p - q) // (p + q) FROM p WHERE n > 0 AND p > q),
z AS (SELECT lang, source, part, item, value::BIGINT AS value, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM y)
SELECT * FROM z WHERE part = 'pair' OR rank <= 10
"""
