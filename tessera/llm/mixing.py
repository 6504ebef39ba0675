"""Mixing sources to target weights by weighted fair queueing.

Each source's documents are shuffled by a seeded digest of their id and queued twice, one pass after the other. A copy's
virtual finish time is its source's cumulative tokens over the source's target; the copies with the earliest finish times
fill the budget. Prefix sums run over buckets of the digest, so that no source, however large, passes through one task. The
cut is where a global sort by finish time would reach the budget: the ranges of that sort are the cells of a grid of finish
times, whose sums tell the cell of the cut, and within that cell the copies are sorted one by one. So the copies taken are
those that a range sort and its truncation take, without moving the rest.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

WEIGHTS = (5, 2, 1)
#: Budget and the most that a source may give, as multiples of the sizes.
SHARE, PASSES = 1.5, 2
#: Hexadecimal digits of the shuffle digest that make a bucket, and cells of the finish-time grid from 0 to 1.
PREFIX, GRID = 3, 8192
SEED = "mix-1"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long"), F.lit(0).cast("long"))


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE) -> DataFrame:
    """(source, source_size, target) from (source, source_size): weights repeat over the sources by code point, null last;
    what lies above PASSES times a source's size is shared again by weight among the others."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.row_number().over(by_name) - 1) % len(weights) + 1)
    t = sizes.withColumn("w", w).withColumn("most", F.col("source_size") * float(PASSES))
    level = Window.orderBy(F.col("most") / F.col("w"), F.col("source").asc_nulls_last())
    before = level.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    t = t.withColumn("full", F.coalesce(F.sum("most").over(before), F.lit(0.0))).withColumn("rest", F.sum("w").over(everything) - F.coalesce(F.sum("w").over(before), F.lit(0.0)))
    t = t.withColumn("budget", F.sum("source_size").over(everything) * share)
    # The source is full if, with all that are full sooner, its share would exceed what it has.
    t = t.withColumn("open", (F.col("budget") - F.col("full")) / F.col("rest")).withColumn("is_full", F.col("most") / F.col("w") <= F.col("open"))
    line = F.max(F.when(~F.col("is_full"), F.col("open"))).over(everything)
    return t.select("source", "source_size", F.when(F.col("is_full") | line.isNull(), F.col("most")).otherwise(F.col("w") * line).alias("target"), "budget")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, seed: str = SEED, row_col: str | None = None) -> DataFrame:
    """(id, source, size, source_size, target, taken, copies, first_finish), one row per row of docs; with row_col also row,
    the value of that column (rows with equal ids, sizes and sources are queued by it).

    size counts runs of characters other than \\x20 and \\x09-\\x0D (null text: 0). taken is size times the copies that
    the mix takes, 0 to 2. A null source is a source of its own, last in order. Rows that share an id are queued one after
    the other by size; equal rows are interchangeable, and each is counted. Null ids are shuffled as one id. A document
    without words is never taken. An empty table gives an empty result. Runs agree on equal input."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"), word_count(F.col(text_col)).alias("size"), (F.col(row_col) if row_col else F.lit(0)).alias("row"))
    rows = rows.withColumn("h", F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.col("id").cast("string"), F.lit(""))))).withColumn("p", F.substring("h", 1, PREFIX))
    rows = stored(rows, "mix-sizes")
    sums = stored(rows.groupBy("source", "p").agg(F.sum("size").alias("mass")), "mix-sums")
    goal = targets(sums.groupBy("source").agg(F.sum("mass").alias("source_size")), weights, share)
    before = F.sum("mass").over(Window.partitionBy("source").orderBy("p").rowsBetween(Window.unboundedPreceding, -1))
    base = sums.withColumn("base", F.coalesce(before, F.lit(0))).select(F.col("source").alias("s"), F.col("p").alias("q"), "base")
    base = base.join(goal, F.col("s").eqNullSafe(F.col("source"))).select("s", "q", "base", "source_size", "target", "budget")
    inner = Window.partitionBy("source", "p").orderBy("h", "id", "size", "row").rowsBetween(Window.unboundedPreceding, 0)
    queued = rows.withColumn("upto", F.sum("size").over(inner)).join(base, F.col("source").eqNullSafe(F.col("s")) & (F.col("p") == F.col("q"))).drop("s", "q")
    queued = queued.withColumn("upto", F.col("upto") + F.col("base"))
    for k in range(PASSES):
        queued = queued.withColumn(f"finish{k}", F.when(F.col("target") > 0, (F.col("upto") + k * F.col("source_size")) / F.col("target")))
    queued = stored(queued.drop("base"), "mix-queue")

    copies = queued.select("source", "h", "id", "size", "upto", "budget", F.explode(F.array(*[F.struct(F.lit(k).alias("pass"), F.col(f"finish{k}").alias("finish")) for k in range(PASSES)])).alias("c")).select("source", "h", "id", "size", "upto", "budget", "c.pass", "c.finish")
    copies = copies.filter("size > 0 and finish is not null").withColumn("cell", F.least(F.floor(F.col("finish") * GRID), F.lit(2 * GRID)))
    cells = copies.groupBy("cell").agg(F.sum("size").alias("mass"), F.max("budget").alias("budget"))
    upto = cells.withColumn("sum", F.sum("mass").over(Window.orderBy("cell")))
    # The cell in which the budget runs out; copies in it are ordered one by one.
    edge = upto.filter("sum > budget").agg(F.min(F.struct("cell", (F.col("sum") - F.col("mass")).alias("sum"), "budget")).alias("e")).select(F.col("e.cell").alias("edge"), F.col("e.sum").alias("spent"), F.col("e.budget").alias("limit"))
    edge = stored(edge, "mix-edge")
    at = edge.first()
    if at is None or at["edge"] is None:
        taken = F.when(F.col("size") > 0, F.lit(PASSES)).otherwise(0)
        last = None
    else:
        order = Window.orderBy("finish", F.col("source").asc_nulls_last(), "h", "upto", "pass", "id", "size")
        within = copies.filter(F.col("cell") == F.lit(at["edge"])).withColumn("sum", F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)) + F.lit(at["spent"]))
        last = within.filter(F.col("sum") <= F.lit(at["limit"])).agg(F.max(F.struct("finish", F.coalesce(F.struct(F.col("source").isNull().alias("none"), F.col("source"))).alias("source"), "h", "upto", "pass")).alias("m")).first()["m"]
        taken = F.lit(0)
        for k in range(PASSES):
            cell = F.least(F.floor(F.col(f"finish{k}") * GRID), F.lit(2 * GRID))
            take = cell < F.lit(at["edge"])
            if last is not None:
                here = F.struct(F.col(f"finish{k}").alias("finish"), F.struct(F.col("source").isNull().alias("none"), F.col("source").alias("source")).alias("source"), F.col("h"), F.col("upto"), F.lit(k).alias("pass"))
                there = F.struct(F.lit(last["finish"]).alias("finish"), F.struct(F.lit(last["source"]["none"]).alias("none"), F.lit(last["source"]["source"]).cast("string").alias("source")).alias("source"), F.lit(last["h"]).alias("h"), F.lit(last["upto"]).alias("upto"), F.lit(last["pass"]).alias("pass"))
                take = take | ((cell == F.lit(at["edge"])) & (here <= there))
            taken = taken + F.when((F.col("size") > 0) & F.coalesce(take, F.lit(False)), 1).otherwise(0)
    return queued.withColumn("copies", taken.cast("int")).select("id", "source", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies", F.col("finish0").alias("first_finish"), *(["row"] if row_col else []))


#: The same in DuckDB SQL, over all documents.
ORACLE = r"""
WITH d AS (SELECT doc_id, source, CASE WHEN text IS NULL THEN 0 ELSE len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) END::BIGINT AS size, md5('mix-1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, [5.0, 2.0, 1.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::BIGINT]::DOUBLE AS w, source_size * 2.0::DOUBLE AS most FROM s),
o AS (SELECT *, ((sum(source_size) OVER ())::DOUBLE * 1.5::DOUBLE - coalesce(sum(most) OVER (ORDER BY most / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
  / (sum(w) OVER () - coalesce(sum(w) OVER (ORDER BY most / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS open, (sum(source_size) OVER ())::DOUBLE * 1.5::DOUBLE AS budget FROM w),
l AS (SELECT *, max(CASE WHEN most / w > open THEN open END) OVER () AS line FROM o),
t AS (SELECT source, source_size, budget, CASE WHEN most / w <= open OR line IS NULL THEN most ELSE w * line END AS target FROM l),
q AS (SELECT d.*, t.source_size, t.target, t.budget, sum(size) OVER (PARTITION BY d.source ORDER BY h, doc_id, size ROWS UNBOUNDED PRECEDING) AS upto FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
c AS (SELECT q.*, pass, (upto + pass * source_size)::DOUBLE / target AS finish FROM q, (VALUES (0), (1)) p(pass) WHERE size > 0 AND target > 0),
f AS (SELECT doc_id, size, sum(size) OVER (ORDER BY finish, source NULLS LAST, h, upto, pass ROWS UNBOUNDED PRECEDING) AS spent, budget FROM c),
k AS (SELECT doc_id, sum(size) AS taken FROM f WHERE spent <= budget GROUP BY doc_id)
SELECT q.doc_id, q.size, q.source_size, q.target, coalesce(k.taken, 0)::BIGINT AS taken FROM q LEFT JOIN k USING (doc_id)
"""
