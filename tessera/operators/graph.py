"""Connected components and what is computed on them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..lineage import cut_lineage


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One step of the star algorithm on edges (u, v). Each node's least neighbour comes from a partial aggregate and is
    joined back, so that a node with very many neighbours is never gathered in one task."""
    if large:
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        moved = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        moved = down.join(least, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
    return moved.filter("u <> v").distinct()


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, root): every node of an edge with the least id of its component.

    Rows with a null end and self edges are left out; repeated rows count once; an empty table gives an empty result. Large
    and small star steps alternate, each round is one written table, and chains of n nodes take about log n rounds. It ends
    when a round leaves count and digest of the edges as they were. Jobs run while the result is built."""
    nodes = edges.filter(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    pairs, mark = cut_lineage(nodes, "edges"), None
    while True:
        h = F.xxhash64("u", "v")
        now = pairs.agg(F.count(F.lit(1)), F.sum(F.shiftright(h, 32)), F.sum(h.bitwiseAND(F.lit(0xFFFFFFFF)))).first()
        if now == mark or not now[0]:
            return pairs.select(F.col("u").alias("id"), F.col("v").alias("root")).union(pairs.select("v", "v")).distinct()
        mark = now
        pairs = cut_lineage(_star(_star(pairs, True), False), "edges")


def component_changes(labels: DataFrame, edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, root): the nodes that are new or get another root when edges are added to a graph whose components are labelled.

    labels: id, root, as connected_components() gives them, each id once. Old components are contracted into their roots, so
    that the star steps run over the new edges alone: their rounds and rows follow those, not the graph. A root is the least
    id of its component before and after. Edges within a component, repeated edges, self edges and null ends change nothing.
    Jobs run while the result is built."""
    fresh = cut_lineage(edges.filter(F.col(a) != F.col(b)).select(F.col(a).alias("x"), F.col(b).alias("y")).distinct(), "new-edges")
    ends = fresh.select(F.explode(F.array("x", "y")).alias("id")).distinct()
    known = cut_lineage(ends.join(labels.select("id", "root"), "id", "left").select("id", F.coalesce("root", "id").alias("at"), F.col("root").isNull().alias("new")), "ends")
    side = lambda end, at: known.select(F.col("id").alias(end), F.col("at").alias(at))
    contracted = fresh.join(side("x", "u"), "x").join(side("y", "v"), "y").select("u", "v")
    moved = cut_lineage(connected_components(contracted, "u", "v").select(F.col("id").alias("at"), F.col("root").alias("to")), "moved")
    added = known.filter("new").join(moved, "at", "left").select("id", F.coalesce("to", "at").alias("root"))
    merged = moved.filter(F.col("at") != F.col("to")).select(F.col("at").alias("root"), "to")
    return labels.select("id", "root").join(merged, "root").select("id", F.col("to").alias("root")).unionByName(added)


def extend_components(labels: DataFrame, edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """labels after edges are added: equal to connected_components() of all edges so far."""
    changed = component_changes(labels, edges, a, b).withColumnRenamed("root", "now")
    return labels.select("id", "root").join(changed, "id", "full_outer").select("id", F.coalesce("now", "root").alias("root"))


def canonical_members(members: DataFrame, component: str, key: str, ts: str) -> DataFrame:
    """(id, canonical): of each component the member of earliest time, missing times last, then of least key."""
    order = F.struct(F.col(ts).isNull().alias("none"), F.col(ts).alias("ts"), F.col(key).alias("key"))
    first = members.groupBy(component).agg(F.min_by(key, order).alias("canonical"))
    return members.join(first, component).select(F.col(key).alias("id"), "canonical")


def cluster_stats(edges: DataFrame, members: DataFrame, roots: DataFrame, pct: Column, day: Column) -> DataFrame:
    """(root, first_seen, last_seen, max_pct, edges_count, members_count, member_ids, site_ids) of every component.

    edges: a, b, site_a, site_b and what pct and day read; roots: id, root."""
    e = edges.join(roots.select(F.col("id").alias("a"), "root"), "a")
    facts = e.groupBy("root").agg(F.min(day).alias("first_seen"), F.max(day).alias("last_seen"), F.max(pct).alias("max_pct"), F.count(F.lit(1)).alias("edges_count"), F.array_sort(F.array_union(F.collect_set("site_a"), F.collect_set("site_b"))).alias("site_ids"))
    size = members.join(roots, "id").groupBy("root").agg(F.count_distinct("id").alias("members_count"), F.array_sort(F.collect_set("id")).alias("member_ids"))
    return facts.join(size, "root")


def leader_of(nodes: DataFrame, roots: DataFrame, key: str) -> DataFrame:
    """nodes with canonical: the component's least id, or the node itself if it has no edge."""
    return nodes.join(roots.select(F.col("id").alias(key), F.col("root")), key, "left").withColumn("canonical", F.coalesce("root", key)).drop("root")
