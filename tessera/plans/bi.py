"""Star schema, split facts and the flat mart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import domain as D
from ..functions import text as X
from ..operators.relational import fallback_join, global_rank, pick_one, share_of_group, split_counts, split_views

UNKNOWN_REGION, UNKNOWN_COUNTY = "Neznámý kraj", "Neznámý okres"
LEVELS = {"region": ("norm_district", UNKNOWN_REGION), "district": ("norm_okres", UNKNOWN_COUNTY), "city": ("norm_city", ""), "city_part": ("norm_city_part", ""), "street": ("norm_street", ""), "house_number": ("norm_house_number", "")}
AGENT = ("agent_name", "agent_phone", "agent_email")


def level_keys() -> dict[str, Column]:
    return {f"{k}_norm": X.house_key(F.col(c)) if k == "house_number" else X.geo_key(F.col(c), unknown) for k, (c, unknown) in LEVELS.items()}


def dim_date(totalized: DataFrame, today: Column) -> DataFrame:
    """The calendar from the first added day to the last day seen or today."""
    ends = totalized.agg(F.min("added_date").alias("lo"), F.greatest(F.max("added_date"), F.max("archived_date"), today).alias("hi"))
    days = ends.filter("lo is not null").select(F.explode(F.sequence("lo", "hi", F.expr("interval 1 day"))).alias("date"))
    return days.select(F.date_format("date", "yyyyMMdd").cast("int").alias("date_key"), "date", *X.calendar(F.col("date")))


def dim_geo(totalized: DataFrame) -> DataFrame:
    """One row per normalised address with its least spelling, numbered in key order."""
    named = totalized.select(*[F.coalesce(X.blank_to_null(F.col(c)), F.lit(u)).alias(k) for k, (c, u) in LEVELS.items()], *[c.alias(k) for k, c in level_keys().items()])
    keys = [f"{k}_norm" for k in LEVELS]
    dim = named.groupBy(*keys).agg(*[F.min(k).alias(k) for k in LEVELS]).withColumn("country", F.lit("CZ"))
    return global_rank(dim, [F.col(k) for k in keys], "geo_key")


def dim_seller(totalized: DataFrame) -> DataFrame:
    cols = ["source_id", "site_id", *AGENT]
    return global_rank(totalized.select(*cols).distinct(), [F.col(c).asc_nulls_first() for c in cols], "seller_key")


def dim_object(totalized: DataFrame) -> DataFrame:
    rows = pick_one(totalized, ["object_id"], [F.col("updated_at").desc_nulls_last(), F.col("added_date").desc_nulls_last(), F.col("internal_id")])
    return rows.select("object_id", "category_value", "category_name", "rooms", "area_build", "area_land", "longitude", "latitude", "norm_district")


def fact(totalized: DataFrame, geo: DataFrame, closed: bool) -> DataFrame:
    """One representative listing per object, with the geo key of the finest address level that is known."""
    rows = totalized.filter(F.col("archived_date").isNotNull() if closed else F.col("archived_date").isNull())
    order = ([F.desc("archived_date")] if closed else []) + [F.col("updated_at").desc_nulls_last(), F.col("added_date").desc_nulls_last(), F.col("source_id"), F.col("internal_id")]
    rep = pick_one(rows, ["object_id"], order).withColumns(level_keys())
    rep = fallback_join(rep, geo, [f"{k}_norm" for k in LEVELS], ["house_number_norm", "street_norm", "city_part_norm"], "geo_key")
    return rep.select(
        "object_id", "added_date", *(["archived_date"] if closed else []), F.col("internal_id").alias("internal_id_rep"), F.col("source_id").alias("source_id_rep"), "geo_key", D.deal_norm(F.col("deal_type")).alias("deal_type"),
        "category_name", "price", "available", *[F.col(c).alias(f"{c}_rep") for c in AGENT], "area_build", "area_land", D.category_bucket(F.col("category_name")).alias("bucket"),
    )


SPLITS = {"state": ("active", "closed"), "deal_type": D.DEALS, "bucket": D.BUCKETS}


def both_facts(active: DataFrame, closed: DataFrame) -> DataFrame:
    return active.withColumn("state", F.lit("active")).unionByName(closed.withColumn("state", F.lit("closed")), allowMissingColumns=True)


def splits(active: DataFrame, closed: DataFrame) -> dict[tuple[str, ...], DataFrame]:
    """The 30 split facts: state, deal and bucket, as views."""
    return split_views(both_facts(active, closed), SPLITS)


def split_sizes(active: DataFrame, closed: DataFrame) -> DataFrame:
    """Rows of each split fact, in one pass over the facts."""
    return split_counts(both_facts(active, closed), SPLITS)


def flat_mart(totalized: DataFrame, as_of: Column, days: int = 180) -> DataFrame:
    """Closed flats of the last days with derived columns, market share and typical duration of their class."""
    n = totalized.filter((F.col("category_value") == 1) & F.col("area_build").between(10, 200) & (F.col("price") > 0) & F.col("added_date").isNotNull() & (F.col("archived_date") >= F.date_sub(as_of, days)))
    rooms = F.lower(F.trim(F.col("rooms").cast("string")))
    n = n.select(
        "*", rooms.alias("rooms_raw"), X.first_integer(rooms).alias("rooms_num"), F.datediff(F.col("archived_date"), F.col("added_date")).alias("deal_duration_days"),
        D.price_per_m2(F.col("price"), F.col("area_build")).alias("price_per_m2"), D.price_rounded(F.col("price")).alias("price_rounded"), F.trunc("archived_date", "month").alias("archived_month"),
        F.trunc("archived_date", "week").alias("archived_week"), D.rooms_bucket(F.col("rooms").cast("string")).alias("rooms_bucket"), D.area_bucket(F.col("area_build")).alias("area_bucket"),
        F.round(F.col("area_build").cast("decimal(18,2)"), -1).cast("double").alias("area_build_bin"), F.lower(F.trim("deal_type")).alias("_deal"),
    )
    key = ["_deal", "norm_district", "rooms_bucket"]
    shares = share_of_group(n, ["_deal", "norm_district"], "rooms_bucket").select(*key, F.col("total").alias("total_region_deals"), F.col("share_pct").alias("share_of_market_pct"))
    speed = n.groupBy(*key).agg(F.avg("deal_duration_days").alias("avg_deal_duration_days_bucket"))
    return n.join(shares, key, "left").join(speed, key, "left").drop("_deal")


def price_events(spark: SparkSession, gold: DataFrame | None = None, totalized: DataFrame | None = None) -> DataFrame:
    """The event fact: empty with its schema, or built from gold prices where these are given."""
    from .. import schemas
    from ..operators.relational import conform

    if gold is None or totalized is None:
        return spark.createDataFrame([], schemas.PRICE_EVENTS)
    rows = gold.join(totalized.select("internal_id", "object_id", "deal_type", "category_name", "added_date", "archived_date"), "internal_id")
    order = Window.partitionBy("internal_id").orderBy("change_date", "new_price")
    rows = rows.withColumn("event_id", F.xxhash64("internal_id", "change_date", "new_price")).withColumn("_n", F.row_number().over(order)).withColumn("event_date", F.col("change_date"))
    diff = F.col("new_price") - F.col("old_price")
    rows = rows.withColumn("event_type", F.when(diff > 0, "up").when(diff < 0, "down").otherwise("same")).withColumn("diff_abs", diff).withColumn("diff_pct", F.try_divide(diff * 100, F.col("old_price"))).withColumn("created_at", F.current_timestamp())
    return conform(rows, schemas.PRICE_EVENTS)
