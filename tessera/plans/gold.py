"""Objects, sellers and prices of the gold layer."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import domain as D
from ..operators import graph
from ..operators.relational import allocate_ids, changed_rows, pick_one, update_from


def latest_listings(geo: DataFrame, subset: DataFrame) -> DataFrame:
    """The latest row of every listing with a positive geography verdict in a known region."""
    good = subset.filter("geo_ok and not not_true and norm_district is not null and norm_city is not null").select("internal_id", "norm_district", "norm_okres", "norm_city", "norm_city_part", "norm_street")
    rows = pick_one(geo, ["internal_id"], [F.col("ingested_at").desc_nulls_last(), F.col("added_date").desc_nulls_last(), F.xxhash64(*geo.columns)])
    kept = [c for c in rows.columns if c not in good.columns or c == "internal_id"]
    return rows.select(*kept).join(good, "internal_id").filter(F.col("norm_district").isin(*sorted(set(D.REGIONS.values()))))


def objects(listings: DataFrame, pairs: DataFrame, object_map: DataFrame, totalized: DataFrame, roots: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(new object map rows, new totalized rows). A listing that is there already keeps its object. roots: the components
    of the pairs, if they are known already."""
    ids = listings.select("internal_id")
    edges = pairs.select(F.col("iid1").alias("a"), F.col("iid2").alias("b")).join(ids.select(F.col("internal_id").alias("a")), "a", "left_semi").join(ids.select(F.col("internal_id").alias("b")), "b", "left_semi")
    led = graph.leader_of(listings, graph.connected_components(edges) if roots is None else roots, "internal_id").withColumnRenamed("canonical", "canonical_internal_id")
    new_map = allocate_ids(object_map, led.select("canonical_internal_id"), "canonical_internal_id", "object_id", D.OBJECT_ID_START)
    both = object_map.select("canonical_internal_id", "object_id").unionByName(new_map)
    rows = led.join(both, "canonical_internal_id", "left").withColumn("object_id", F.coalesce("object_id", "internal_id")).drop("canonical_internal_id")
    return new_map, rows.join(totalized.select("internal_id"), "internal_id", "left_anti")


def enrich_sellers(totalized: DataFrame, sellers: DataFrame) -> DataFrame:
    """totalized with the last known agent columns of each listing; updated_at moves only where one changed.

    sellers: internal_id, agent_name, agent_phone, agent_email, seen_at."""
    fields = ["agent_name", "agent_phone", "agent_email"]
    if not sellers.filter("internal_id is null").isEmpty():
        raise ValueError("seller rows without internal_id")
    blank = lambda c: F.nullif(F.trim(F.col(c)), F.lit(""))
    last = sellers.groupBy("internal_id").agg(*[F.max_by(blank(c), F.when(blank(c).isNotNull(), F.struct("seen_at", F.col(c)))).alias(c) for c in fields])
    known = totalized.join(last.select("internal_id", *[F.col(c).alias(f"_n_{c}") for c in fields]), "internal_id")
    known = known.select("internal_id", *[F.coalesce(f"_n_{c}", c).alias(c) for c in fields])
    changed = changed_rows(totalized, known, ["internal_id"], fields).withColumn("updated_at", F.current_timestamp())
    return update_from(totalized, changed, ["internal_id"], [*fields, "updated_at"])


def price_history(prices: DataFrame, totalized: DataFrame, existing: DataFrame) -> DataFrame:
    """New gold price events, keyed by (internal_id, change_date, new_price)."""
    ids = pick_one(totalized.select("source_id", "site_id", "internal_id", "added_date"), ["source_id", "site_id"], [F.col("added_date").desc_nulls_last(), F.desc("internal_id")])
    rows = prices.withColumnRenamed("id", "site_id").join(ids.select("source_id", "site_id", "internal_id"), ["source_id", "site_id"])
    rows = rows.select("internal_id", "change_date", F.col("old_price").try_cast("decimal(12,2)").alias("old_price"), F.col("new_price").try_cast("decimal(12,2)").alias("new_price"), "source_id").filter("new_price is not null")
    key = ["internal_id", "change_date", "new_price"]
    return pick_one(rows, key, [F.col("old_price").asc_nulls_last()]).join(existing.select(*key), key, "left_anti")
