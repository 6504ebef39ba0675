"""Named queries over the test tables, each through the engine's operators, and their SQL equivalents."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import domain as D
from .functions import text as X
from .operators import fuzzy, graph, phash, quality
from .operators import relational as R
from .plans import bi, gold, silver
from .sources import snapshots

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
AS_OF = dt.date(2001, 8, 1)


#: Columns of dates: results show them as text, in both engines alike.
DATES = {
    "flat_mart": ("added_date", "archived_date", "archived_month", "archived_week", "updated_at"),
    "snapshot_sync_state": ("added_date", "archived_date"),
    "price_change_events": ("change_date",),
    "price_log_clean": ("change_date",),
    "upsert_least_greatest": ("first_seen", "last_seen"),
    "fact_open": ("added_date",),
    "fact_closed": ("added_date", "archived_date"),
    "dim_date": ("date",),
    "cluster_stats": ("first_seen", "last_seen"),
    "price_history": ("change_date",),
}


def query(oracle: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        name = f.__name__
        dates = DATES.get(name, ())

        def shown(spark: SparkSession, sf_dir: str) -> DataFrame:
            return f(spark, sf_dir).withColumns({c: F.col(c).cast("string") for c in dates}) if dates else f(spark, sf_dir)

        QUERIES[name] = shown
        if oracle:
            ORACLES[name] = f"SELECT * REPLACE ({', '.join(f'{c}::DATE::VARCHAR AS {c}' for c in dates)}) FROM ({oracle})" if dates else oracle
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ---------------------------------------------------------------- listings made of orders, in both dialects


def _listing_columns(duck: bool) -> dict[str, str]:
    day = "CAST(o_orderdate AS DATE)"
    plus = (lambda d, n: f"({d} + CAST({n} AS INTEGER))") if duck else (lambda d, n: f"date_add({d}, CAST({n} AS INT))")
    text = "VARCHAR" if duck else "STRING"
    return {
        "internal_id": "o_orderkey",
        "object_id": "CAST(floor(o_orderkey / 3) AS BIGINT)",
        "source_id": "CAST(o_orderkey % 3 + 1 AS INT)",
        "site_id": f"CAST(o_orderkey AS {text})",
        "category_value": "o_orderkey % 3",
        "category_name": "CASE o_orderkey % 5 WHEN 0 THEN 'Byt 2kk' WHEN 1 THEN 'dom' WHEN 2 THEN 'pozemek' WHEN 3 THEN 'Komercni' ELSE 'dum' END",
        "deal_type": "CASE o_orderkey % 4 WHEN 0 THEN 'Prodej' WHEN 1 THEN 'rent' WHEN 2 THEN 'aukce' ELSE 'neznámé' END",
        "rooms": f"CASE WHEN o_orderkey % 11 = 0 THEN 'atyp' ELSE concat(' ', CAST(o_orderkey % 7 AS {text}), '+KK') END",
        "price": "o_totalprice",
        "area_build": "CAST(5 + o_orderkey % 200 AS DOUBLE)",
        "area_land": "CASE WHEN o_orderkey % 2 = 0 THEN CAST(o_orderkey % 900 AS DOUBLE) END",
        "added_date": day,
        "archived_date": f"CASE WHEN o_orderkey % 4 <> 3 THEN {plus(day, 'o_orderkey % 120')} END",
        "available": "o_orderkey % 4 = 3",
        "norm_district": "r_name",
        "norm_okres": "n_name",
        "norm_city": "CASE WHEN c_custkey % 6 = 0 THEN concat(' ', c_mktsegment) ELSE c_mktsegment END",
        "norm_city_part": f"CASE WHEN c_custkey % 4 = 0 THEN '' ELSE concat('Part ', CAST(c_custkey % 5 AS {text})) END",
        "norm_street": f"CASE WHEN c_custkey % 3 > 0 THEN concat('Long  Street ', CAST(c_custkey % 7 AS {text})) END",
        "norm_house_number": f"concat(CAST(c_custkey % 9 AS {text}), ' A')",
        "agent_name": "c_name",
        "agent_phone": f"concat('60', CAST(1000000 + c_custkey AS {text}))",
        "agent_email": f"CASE WHEN c_custkey % 5 > 0 THEN concat('a', CAST(c_custkey AS {text}), '@x.cz') END",
        "updated_at": day,
    }


def listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    rows = rows.join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return rows.select(*[F.expr(e).alias(c) for c, e in _listing_columns(False).items()])


LISTINGS = "listings AS (SELECT " + ", ".join(f"{e} AS {c}" for c, e in _listing_columns(True).items()) + " FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"
_FIRST_INT = "TRY_CAST(NULLIF(regexp_extract(lower(trim(rooms)), '([0-9]+)', 1), '') AS INTEGER)"
_ROOMS = f"CASE WHEN {_FIRST_INT} IS NULL THEN 'Atypický' WHEN {_FIRST_INT} <= 1 THEN '1kk' WHEN {_FIRST_INT} = 2 THEN '2kk' WHEN {_FIRST_INT} = 3 THEN '3kk' WHEN {_FIRST_INT} = 4 THEN '4kk' ELSE '5kk+' END"
_AREA = "CASE WHEN area_build BETWEEN 10 AND 200 THEN CASE WHEN area_build < 30 THEN '<30' WHEN area_build < 40 THEN '30-39' WHEN area_build < 50 THEN '40-49' WHEN area_build < 60 THEN '50-59' WHEN area_build < 70 THEN '60-69' WHEN area_build < 90 THEN '70-89' WHEN area_build < 100 THEN '90-99' WHEN area_build < 120 THEN '100-119' WHEN area_build < 150 THEN '120-149' ELSE '150-200' END ELSE 'excluded' END"
_MART = f"""{LISTINGS}, n AS (SELECT *, lower(trim(rooms)) AS rooms_raw, {_FIRST_INT} AS rooms_num, (archived_date - added_date)::INTEGER AS deal_duration_days, {_ROOMS} AS rooms_bucket, {_AREA} AS area_bucket,
  CASE WHEN area_build BETWEEN 10 AND 200 AND price > 0 THEN round(price::DECIMAL(18,2) / area_build::DECIMAL(18,2), 0)::DOUBLE END AS price_per_m2,
  CASE WHEN price < 100000 THEN round(price::DECIMAL(18,2), -3)::DOUBLE ELSE round(price::DECIMAL(18,2), -4)::DOUBLE END AS price_rounded, date_trunc('month', archived_date)::DATE AS archived_month, date_trunc('week', archived_date)::DATE AS archived_week, round(area_build::DECIMAL(18,2), -1)::DOUBLE AS area_build_bin
  FROM listings WHERE category_value = 1 AND area_build BETWEEN 10 AND 200 AND price > 0 AND archived_date >= DATE '2001-08-01' - 180),
s AS (SELECT lower(trim(deal_type)) AS deal, norm_district, rooms_bucket, sum(count(*)) OVER (PARTITION BY lower(trim(deal_type)), norm_district)::BIGINT AS total_region_deals, count(*) AS n,
  round(100.0 * count(*) / sum(count(*)) OVER (PARTITION BY lower(trim(deal_type)), norm_district), 2)::DOUBLE AS share_of_market_pct FROM n GROUP BY 1, 2, 3),
p AS (SELECT lower(trim(deal_type)) AS deal, norm_district, rooms_bucket, avg(deal_duration_days) AS avg_deal_duration_days_bucket FROM n GROUP BY 1, 2, 3)"""


@query(f"WITH {_MART} SELECT n.*, s.total_region_deals, s.share_of_market_pct, p.avg_deal_duration_days_bucket FROM n LEFT JOIN s ON s.deal = lower(trim(n.deal_type)) AND s.norm_district = n.norm_district AND s.rooms_bucket = n.rooms_bucket LEFT JOIN p ON p.deal = lower(trim(n.deal_type)) AND p.norm_district = n.norm_district AND p.rooms_bucket = n.rooms_bucket")
def flat_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bi.flat_mart(listings(spark, sf_dir), F.lit(AS_OF))


@query(f"WITH {_MART} SELECT deal, norm_district, rooms_bucket, n::BIGINT AS n, total_region_deals AS total, share_of_market_pct AS share_pct FROM s")
def market_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    mart = bi.flat_mart(listings(spark, sf_dir), F.lit(AS_OF)).withColumn("deal", F.lower(F.trim("deal_type")))
    return R.share_of_group(mart, ["deal", "norm_district"], "rooms_bucket")


@query(f"WITH {_MART} SELECT deal, norm_district, rooms_bucket, avg_deal_duration_days_bucket AS avg_days FROM p")
def avg_duration(spark: SparkSession, sf_dir: str) -> DataFrame:
    mart = bi.flat_mart(listings(spark, sf_dir), F.lit(AS_OF))
    return mart.groupBy(F.lower(F.trim("deal_type")).alias("deal"), "norm_district", "rooms_bucket").agg(F.avg("deal_duration_days").alias("avg_days"))


# ---------------------------------------------------------------- snapshots and price events


def _snapshots(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    o = table(spark, sf_dir, "orders")
    prev = o.filter("o_orderkey % 10 <> 0").select(F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("price"))
    curr = o.filter("o_orderkey % 7 <> 0").select(F.col("o_orderkey").alias("id"), F.expr("CASE WHEN o_orderkey % 5 = 0 THEN o_totalprice * 1.1D ELSE o_totalprice END").alias("price"))
    state = o.filter("o_orderkey % 3 <> 0").select(F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("price"), F.col("o_orderdate").cast("date").alias("added_date"), F.expr("CASE WHEN o_orderkey % 4 = 0 THEN DATE '2001-01-01' END").alias("archived_date"), F.expr("o_orderkey % 4 <> 0").alias("available"))
    return prev, curr, state


_SNAP = """prev AS (SELECT o_orderkey AS id, o_totalprice AS price FROM orders WHERE o_orderkey % 10 <> 0), curr AS (SELECT o_orderkey AS id, CASE WHEN o_orderkey % 5 = 0 THEN o_totalprice * 1.1::DOUBLE ELSE o_totalprice END AS price FROM orders WHERE o_orderkey % 7 <> 0),
state AS (SELECT o_orderkey AS id, o_totalprice AS price, o_orderdate::DATE AS added_date, CASE WHEN o_orderkey % 4 = 0 THEN DATE '2001-01-01' END AS archived_date, o_orderkey % 4 <> 0 AS available FROM orders WHERE o_orderkey % 3 <> 0)"""


def _action(name: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        prev, curr, state = _snapshots(spark, sf_dir)
        return R.sync_counts(state, curr, prev).filter(F.col("action") == name).select("id")

    run.__name__ = f"snapshot_{name}"
    return run


query(f"WITH {_SNAP} SELECT id FROM curr WHERE id NOT IN (SELECT id FROM state)")(_action("new"))
query(f"WITH {_SNAP} SELECT id FROM state WHERE NOT available AND id IN (SELECT id FROM curr)")(_action("reactivated"))
query(f"WITH {_SNAP} SELECT id FROM state WHERE available AND id IN (SELECT id FROM prev) AND id NOT IN (SELECT id FROM curr)")(_action("archived"))


@query(f"""WITH {_SNAP}, j AS (SELECT coalesce(s.id, c.id) AS id, s.id IS NULL AS is_new, s.*, c.price AS cprice, c.id AS cid, p.id AS pid FROM state s FULL JOIN curr c ON s.id = c.id LEFT JOIN prev p ON p.id = coalesce(s.id, c.id))
SELECT id, CASE WHEN is_new THEN cprice ELSE price END AS price, CASE WHEN is_new THEN DATE '2001-08-01' ELSE added_date END AS added_date,
CASE WHEN is_new THEN NULL WHEN available AND cid IS NULL AND pid IS NOT NULL THEN DATE '2001-08-01' WHEN NOT available AND cid IS NOT NULL THEN NULL ELSE archived_date END AS archived_date,
CASE WHEN is_new OR (NOT available AND cid IS NOT NULL) THEN true WHEN available AND cid IS NULL AND pid IS NOT NULL THEN false ELSE available END AS available FROM (SELECT id, is_new, price, added_date, archived_date, available, cprice, cid, pid FROM j)""")
def snapshot_sync_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    prev, curr, state = _snapshots(spark, sf_dir)
    return R.sync_snapshot(state, curr, F.lit(AS_OF), prev)


@query(f"WITH {_SNAP} SELECT p.id, p.price AS old_price, c.price AS new_price, DATE '2001-08-01' AS change_date FROM prev p JOIN curr c USING (id) WHERE p.price <> c.price")
def price_change_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    prev, curr, _ = _snapshots(spark, sf_dir)
    return R.price_changes(prev, curr, F.lit(AS_OF))


@query("""WITH l AS (SELECT CASE WHEN l_orderkey % 13 = 0 THEN ' ' ELSE ' ' || (l_orderkey % 500)::VARCHAR END AS id, CASE WHEN l_orderkey % 17 = 0 THEN NULL ELSE l_extendedprice END AS old_price, CASE WHEN l_orderkey % 19 = 0 THEN 1e11 ELSE l_extendedprice * 2 END AS new_price, l_shipdate::DATE AS change_date, (l_orderkey % 3)::INTEGER AS source_id FROM lineitem),
c AS (SELECT NULLIF(trim(id), '') AS id, old_price, new_price, change_date, source_id FROM l), f AS (SELECT * FROM c WHERE id IS NOT NULL AND old_price IS NOT NULL AND abs(old_price) < 1e10 AND abs(new_price) < 1e10),
r AS (SELECT *, row_number() OVER (PARTITION BY id, change_date, source_id ORDER BY new_price DESC, old_price DESC) AS n FROM f) SELECT id, old_price, new_price, change_date, source_id FROM r WHERE n = 1 AND NOT (id = '7' AND source_id = 1)""")
def price_log_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select(
        F.expr("CASE WHEN l_orderkey % 13 = 0 THEN ' ' ELSE concat(' ', CAST(l_orderkey % 500 AS STRING)) END").alias("id"), F.expr("CASE WHEN l_orderkey % 17 = 0 THEN NULL ELSE l_extendedprice END").alias("old_price"),
        F.expr("CASE WHEN l_orderkey % 19 = 0 THEN 1e11D ELSE l_extendedprice * 2 END").alias("new_price"), F.col("l_shipdate").cast("date").alias("change_date"), F.expr("CAST(l_orderkey % 3 AS INT)").alias("source_id"),
    )
    old = rows.filter("trim(id) = '7' AND source_id = 1").select(F.trim("id").alias("id"), "change_date", "source_id")
    return silver.price_log(old, rows)


# ---------------------------------------------------------------- union, dedup, merge


@query("""WITH u AS (SELECT 1 AS source_id, c_custkey::VARCHAR AS site_id, c_name AS name, c_acctbal AS price, 0 AS n FROM customer UNION ALL SELECT 2, s_suppkey::VARCHAR, s_name, s_acctbal, 1 FROM supplier UNION ALL SELECT 1, p_partkey::VARCHAR, p_name, NULL, 2 FROM part WHERE p_partkey % 2 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY source_id, site_id ORDER BY n DESC) AS k FROM u) SELECT source_id, site_id, name, price FROM r WHERE k = 1 AND NOT (source_id = 1 AND site_id::BIGINT % 5 = 0)""")
def canonical_union_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select(F.lit(1).alias("source_id"), F.col("c_custkey").cast("string").alias("site_id"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("price"))
    s = table(spark, sf_dir, "supplier").select(F.lit(2).alias("source_id"), F.col("s_suppkey").cast("string").alias("site_id"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("price"))
    p = table(spark, sf_dir, "part").filter("p_partkey % 2 = 0").select(F.lit(1).alias("source_id"), F.col("p_partkey").cast("string").alias("site_id"), F.col("p_name").alias("name"))
    none = F.lit(None).cast("date")
    frames = [f.withColumn("added_date", none).withColumn("archived_date", none) for f in (c, s, p)]
    old = c.unionByName(p, allowMissingColumns=True).filter("CAST(site_id AS BIGINT) % 5 = 0").select("source_id", "site_id").distinct()
    return silver.canonical_union(old, *frames).select("source_id", "site_id", "name", "price")


@query("SELECT user_id, event_id, event_type, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n FROM events) WHERE n = 1")
def latest_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.pick_one(table(spark, sf_dir, "events"), ["user_id"], [F.desc("ts"), F.desc("event_id")]).select("user_id", "event_id", "event_type", "value")


@query("""SELECT l_partkey, l_orderkey, l_linenumber FROM (SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY CASE WHEN l_orderkey % 5 > 0 THEN l_shipdate END DESC NULLS LAST, CASE WHEN l_orderkey % 3 > 0 THEN l_quantity END DESC NULLS LAST, l_orderkey DESC, l_linenumber DESC) AS n FROM lineitem) WHERE n = 1""")
def dedup_rank_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").withColumn("ingested_at", F.expr("CASE WHEN l_orderkey % 5 > 0 THEN l_shipdate END")).withColumn("added_date", F.expr("CASE WHEN l_orderkey % 3 > 0 THEN l_quantity END")).withColumn("_id", F.struct("l_orderkey", "l_linenumber"))
    order = R.latest_order(rows, ["ingested_at", "added_date", "archived_date"], "_id")
    return R.pick_one(rows, ["l_partkey"], order).select("l_partkey", "l_orderkey", "l_linenumber")


@query("""WITH a AS (SELECT o_custkey AS k, min(o_orderdate)::DATE AS first_seen, max(o_orderdate)::DATE AS last_seen, count(*) AS edges FROM orders WHERE o_orderkey % 2 = 0 GROUP BY 1), b AS (SELECT o_custkey AS k, min(o_orderdate)::DATE AS first_seen, max(o_orderdate)::DATE AS last_seen, count(*) AS edges FROM orders WHERE o_orderkey % 2 = 1 AND o_custkey % 3 > 0 GROUP BY 1)
SELECT coalesce(a.k, b.k) AS k, least(a.first_seen, b.first_seen) AS first_seen, greatest(a.last_seen, b.last_seen) AS last_seen, (coalesce(a.edges, 0) + coalesce(b.edges, 0))::BIGINT AS edges FROM a FULL JOIN b ON a.k = b.k""")
def upsert_least_greatest(spark: SparkSession, sf_dir: str) -> DataFrame:
    def side(cond: str) -> DataFrame:
        rows = table(spark, sf_dir, "orders").filter(cond)
        return rows.groupBy(F.col("o_custkey").alias("k")).agg(F.min("o_orderdate").cast("date").alias("first_seen"), F.max("o_orderdate").cast("date").alias("last_seen"), F.count(F.lit(1)).alias("edges"))

    return R.upsert(side("o_orderkey % 2 = 0"), side("o_orderkey % 2 = 1 AND o_custkey % 3 > 0"), ["k"], {"first_seen": "least", "last_seen": "greatest", "edges": "add"})


@query("SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN NULL WHEN c_custkey % 4 = 1 THEN upper(c_mktsegment) || '!' ELSE c_mktsegment END AS c_mktsegment FROM customer WHERE c_custkey % 4 < 2")
def update_if_changed(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    new = c.select("c_custkey", F.expr("CASE WHEN c_custkey % 4 = 0 THEN NULL WHEN c_custkey % 4 = 1 THEN concat(upper(c_mktsegment), '!') ELSE c_mktsegment END").alias("c_mktsegment"))
    return R.changed_rows(c, new, ["c_custkey"], ["c_mktsegment"])


@query("SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN c_name || '*' ELSE c_name END AS c_name FROM customer")
def update_from_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    new = c.select("c_custkey", F.expr("CASE WHEN c_custkey % 3 = 0 THEN concat(c_name, '*') END").alias("c_name")).filter("c_custkey % 2 = 1 OR c_custkey % 3 = 0")
    return R.update_from(c, new, ["c_custkey"], ["c_name"])


_GEO = "geo AS (SELECT c_custkey AS internal_id, CASE WHEN c_custkey % 5 = 0 THEN NULL WHEN c_custkey % 7 = 0 THEN ' ' WHEN c_custkey % 11 = 0 THEN 'not_cz' ELSE c_mktsegment END AS norm_district, CASE WHEN c_custkey % 3 = 0 THEN false WHEN c_custkey % 3 = 1 THEN true END AS geo_status FROM customer), bad AS (SELECT * FROM geo WHERE geo_status = false AND (norm_district IS NULL OR trim(norm_district) = '' OR upper(trim(norm_district)) = 'NOT_CZ'))"


def _geo(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("internal_id"), F.expr("CASE WHEN c_custkey % 5 = 0 THEN NULL WHEN c_custkey % 7 = 0 THEN ' ' WHEN c_custkey % 11 = 0 THEN 'not_cz' ELSE c_mktsegment END").alias("norm_district"), F.expr("CASE WHEN c_custkey % 3 = 0 THEN false WHEN c_custkey % 3 = 1 THEN true END").alias("geo_status"))


@query(f"WITH {_GEO} SELECT internal_id, 'queue' AS place FROM bad UNION SELECT internal_id, 'queue' FROM geo WHERE internal_id % 30 = 0 UNION ALL SELECT internal_id, 'geo' FROM geo WHERE internal_id NOT IN (SELECT internal_id FROM bad)")
def queue_move(spark: SparkSession, sf_dir: str) -> DataFrame:
    geo = _geo(spark, sf_dir)
    left, queue = R.move_rows(geo, geo.filter("internal_id % 30 = 0"), "internal_id", D.bad_geography(F.col("geo_status"), F.col("norm_district")))
    return queue.select("internal_id", F.lit("queue").alias("place")).unionByName(left.select("internal_id", F.lit("geo").alias("place")))


@query("""WITH q AS (SELECT n_nationkey::BIGINT AS internal_id, upper(n_name) AS norm_city FROM nation), g AS (SELECT c_custkey AS internal_id, CASE WHEN c_custkey % 2 = 0 THEN NULL ELSE c_name END AS norm_city FROM customer WHERE c_custkey <= 15 OR c_custkey > 30)
SELECT coalesce(g.internal_id, q.internal_id) AS internal_id, coalesce(g.norm_city, q.norm_city) AS norm_city FROM g FULL JOIN (SELECT * FROM q WHERE internal_id % 3 > 0 AND internal_id IN (SELECT c_custkey FROM customer)) q ON g.internal_id = q.internal_id""")
def queue_restore(spark: SparkSession, sf_dir: str) -> DataFrame:
    queue = table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("bigint").alias("internal_id"), F.upper("n_name").alias("norm_city"))
    c = table(spark, sf_dir, "customer")
    geo = c.filter("c_custkey <= 15 OR c_custkey > 30").select(F.col("c_custkey").alias("internal_id"), F.expr("CASE WHEN c_custkey % 2 = 0 THEN NULL ELSE c_name END").alias("norm_city"))
    _, restored = R.restore_rows(queue, geo, c.select(F.col("c_custkey").alias("internal_id")), "internal_id", F.col("internal_id") % 3 > 0)
    return restored


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 7 = 0)")
def cascade_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select("c_custkey")
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("c_custkey"))
    return R.cascade_delete(c, o, "c_custkey", c.filter("c_custkey % 7 = 0"))[1].select("o_orderkey", F.col("c_custkey").alias("o_custkey"))


@query("SELECT DISTINCT event_type, user_id % 50 AS u, ts::DATE::VARCHAR AS day FROM events")
def full_row_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_type", (F.col("user_id") % 50).alias("u"), F.col("ts").cast("date").cast("string").alias("day")).dropDuplicates()


@query("SELECT event_id FROM events WHERE ts::DATE >= DATE '2024-01-15'")
def retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.drop_older(table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("date")), "ts", F.lit(dt.date(2024, 1, 15))).select("event_id")


# ---------------------------------------------------------------- geography


_DIM = """named AS (SELECT coalesce(NULLIF(trim(norm_district), ''), 'Neznámý kraj') AS region, coalesce(NULLIF(trim(norm_okres), ''), 'Neznámý okres') AS district, coalesce(NULLIF(trim(norm_city), ''), '') AS city, coalesce(NULLIF(trim(norm_city_part), ''), '') AS city_part, coalesce(NULLIF(trim(norm_street), ''), '') AS street, coalesce(NULLIF(trim(norm_house_number), ''), '') AS house_number, * FROM listings),
keyed AS (SELECT *, lower(regexp_replace(region, '\\s+', ' ', 'g')) AS region_norm, lower(regexp_replace(district, '\\s+', ' ', 'g')) AS district_norm, lower(regexp_replace(city, '\\s+', ' ', 'g')) AS city_norm, lower(regexp_replace(city_part, '\\s+', ' ', 'g')) AS city_part_norm, lower(regexp_replace(street, '\\s+', ' ', 'g')) AS street_norm, lower(regexp_replace(house_number, '\\s+', '', 'g')) AS house_number_norm FROM named),
dim AS (SELECT row_number() OVER (ORDER BY region_norm, district_norm, city_norm, city_part_norm, street_norm, house_number_norm)::BIGINT AS geo_key, * FROM (SELECT region_norm, district_norm, city_norm, city_part_norm, street_norm, house_number_norm, min(region) AS region, min(district) AS district, min(city) AS city, min(city_part) AS city_part, min(street) AS street, min(house_number) AS house_number, 'CZ' AS country FROM keyed {where} GROUP BY ALL))"""


@query(f"WITH {LISTINGS}, {_DIM.format(where='')} SELECT * FROM dim")
def dim_geo(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bi.dim_geo(listings(spark, sf_dir))


def _partial_dim(rows: DataFrame) -> DataFrame:
    """A dimension with gaps: some rows' streets, parts and houses are unknown to it."""
    gaps = rows.filter("internal_id % 10 < 3").withColumn("norm_house_number", F.expr("CASE WHEN internal_id % 2 = 0 THEN norm_house_number END"))
    return bi.dim_geo(gaps.unionByName(rows.filter("internal_id % 10 < 3").withColumn("norm_house_number", F.lit(None).cast("string")).withColumn("norm_street", F.lit(None).cast("string"))))


_GAPS = "gaps AS (SELECT * REPLACE (CASE WHEN internal_id % 2 = 0 THEN norm_house_number END AS norm_house_number) FROM listings WHERE internal_id % 10 < 3 UNION ALL SELECT * REPLACE (NULL AS norm_house_number, NULL AS norm_street) FROM listings WHERE internal_id % 10 < 3)"
_GAP_DIM = _DIM.format(where="").replace("named AS", "gnamed AS").replace("keyed AS", "gkeyed AS").replace("FROM listings", "FROM gaps").replace("FROM named", "FROM gnamed").replace("FROM keyed", "FROM gkeyed")
_KEYS = ["region_norm", "district_norm", "city_norm", "city_part_norm", "street_norm", "house_number_norm"]


def _fallback(prefix: str) -> str:
    joins = []
    for n in range(4):
        blank = _KEYS[6 - n :]
        joins.append(f"LEFT JOIN dim g{n} ON " + " AND ".join(f"g{n}.{k} = " + ("''" if k in blank else f"{prefix}.{k}") for k in _KEYS))
    return " ".join(joins)


@query(f"WITH {LISTINGS}, {_GAPS}, {_GAP_DIM}, {_DIM.format(where='').split('dim AS')[0].rstrip().rstrip(',')} SELECT k.internal_id, coalesce(g0.geo_key, g1.geo_key, g2.geo_key, g3.geo_key) AS geo_key FROM keyed k {_fallback('k')}")
def geo_fallback_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = listings(spark, sf_dir)
    keyed = rows.withColumns(bi.level_keys())
    return R.fallback_join(keyed, _partial_dim(rows), _KEYS, _KEYS[5:2:-1], "geo_key").select("internal_id", "geo_key")


def _fact_oracle(closed: bool) -> str:
    order = ("archived_date DESC, " if closed else "") + "updated_at DESC NULLS LAST, added_date DESC NULLS LAST, source_id, internal_id"
    deal = "CASE WHEN lower(deal_type) IN ('prodej', 'sale', 'sell') THEN 'prodej' WHEN lower(deal_type) IN ('pronajem', 'pronájem', 'rent', 'rental', 'lease') THEN 'pronajem' WHEN lower(deal_type) IN ('drazba', 'dražba', 'auction', 'aukce') THEN 'drazba' ELSE 'ostatni' END"
    bucket = "CASE WHEN category_name ILIKE 'byt%' THEN 'byty' WHEN category_name ILIKE 'dom%' THEN 'domy' WHEN category_name ILIKE 'pozem%' THEN 'pozemky' WHEN category_name ILIKE 'komerc%' THEN 'komercni' ELSE 'ostatni' END"
    return f"WITH {LISTINGS}, {_DIM.format(where='')}, rep AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY object_id ORDER BY {order}) AS rn FROM keyed WHERE archived_date IS {'NOT ' if closed else ''}NULL) WHERE rn = 1) SELECT object_id, added_date, {'archived_date, ' if closed else ''}internal_id AS internal_id_rep, source_id AS source_id_rep, coalesce(g0.geo_key, g1.geo_key, g2.geo_key, g3.geo_key) AS geo_key, {deal} AS deal_type, category_name, price, available, agent_name AS agent_name_rep, agent_phone AS agent_phone_rep, agent_email AS agent_email_rep, area_build, area_land, {bucket} AS bucket FROM rep {_fallback('rep')}"


def _fact(closed: bool, name: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = listings(spark, sf_dir)
        return bi.fact(rows, bi.dim_geo(rows), closed)

    run.__name__ = name
    return run


query(_fact_oracle(False))(_fact(False, "fact_open"))
query(_fact_oracle(True))(_fact(True, "fact_closed"))


@query(f"WITH a AS ({_fact_oracle(False)}), c AS ({_fact_oracle(True)}), u AS (SELECT 'active' AS state, deal_type, bucket FROM a UNION ALL SELECT 'closed', deal_type, bucket FROM c) SELECT state, deal_type, bucket, count(*) AS n FROM u WHERE deal_type <> 'ostatni' GROUP BY ALL")
def fact_split_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = listings(spark, sf_dir)
    geo = bi.dim_geo(rows)
    return bi.split_sizes(bi.fact(rows, geo, False), bi.fact(rows, geo, True))


@query(f"WITH {LISTINGS} SELECT strftime(d, '%Y%m%d')::INTEGER AS date_key, d::DATE AS date, year(d)::INTEGER AS year, quarter(d)::INTEGER AS quarter, month(d)::INTEGER AS month, strftime(d, '%b') AS month_name, weekofyear(d)::INTEGER AS week, day(d)::INTEGER AS day, isodow(d)::INTEGER AS dow, isodow(d) >= 6 AS is_weekend FROM (SELECT unnest(generate_series(min(added_date), greatest(max(added_date), max(archived_date), DATE '2001-08-01'), INTERVAL 1 DAY)) AS d FROM listings)")
def dim_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bi.dim_date(listings(spark, sf_dir), F.lit(AS_OF))


@query(f"WITH {LISTINGS} SELECT row_number() OVER (ORDER BY source_id, site_id, agent_name, agent_phone, agent_email NULLS FIRST)::BIGINT AS seller_key, * FROM (SELECT DISTINCT source_id, site_id, agent_name, agent_phone, agent_email FROM listings)")
def dim_seller(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bi.dim_seller(listings(spark, sf_dir))


@query(f"WITH {LISTINGS} SELECT object_id, category_value, category_name, rooms, area_build, area_land, CAST(NULL AS DOUBLE) AS longitude, CAST(NULL AS DOUBLE) AS latitude, norm_district FROM (SELECT *, row_number() OVER (PARTITION BY object_id ORDER BY updated_at DESC NULLS LAST, added_date DESC NULLS LAST, internal_id) AS n FROM listings) WHERE n = 1")
def dim_object(spark: SparkSession, sf_dir: str) -> DataFrame:
    none = F.lit(None).cast("double")
    return bi.dim_object(listings(spark, sf_dir).withColumn("longitude", none).withColumn("latitude", none))


@query("""WITH q AS (SELECT DISTINCT lower(split_part(p_name, ' ', 1)) AS k FROM part), r AS (SELECT lower(split_part(p_name, ' ', 1)) AS k, min(p_brand) AS town FROM part WHERE p_partkey % 3 = 0 GROUP BY 1) SELECT q.k, r.town FROM q JOIN r USING (k)""")
def registry_cascade_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part").withColumn("k", X.norm_key(F.split_part("p_name", F.lit(" "), F.lit(1))))
    towns = p.filter("p_partkey % 3 = 0").groupBy("k").agg(F.min("p_brand").alias("town"))
    return p.select("k").distinct().join(towns, "k")


@query()
def registry_fuzzy_best(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every part's name with its fourth letter left out, looked up among all names."""
    p = table(spark, sf_dir, "part").select(X.norm_key(F.col("p_name")).alias("name"))
    typos = p.select(F.concat(F.expr("substring(name, 1, 3)"), F.expr("substring(name, 5)")).alias("name"))
    return fuzzy.best_match(typos, p, "name", "name").withColumn("score", F.round("score", 6))


@query("""WITH n AS (SELECT DISTINCT lower(p_name) AS m FROM part), q AS (SELECT DISTINCT substr(m, 1, 3) || substr(m, 5) AS q FROM n), d AS (SELECT q, m, levenshtein(q, m) AS distance FROM q JOIN n ON abs(length(q) - length(m)) <= 3)
SELECT q AS query, m AS "match", distance::INTEGER AS distance FROM (SELECT *, row_number() OVER (PARTITION BY q ORDER BY distance, m) AS k FROM d WHERE distance <= 3) WHERE k = 1""")
def registry_levenshtein(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "part").select(F.lower("p_name").alias("name")).distinct()
    typos = n.select(F.concat(F.expr("substring(name, 1, 3)"), F.expr("substring(name, 5)")).alias("name"))
    return fuzzy.levenshtein_best(typos, n, "name", "name", 3)


# ---------------------------------------------------------------- expressions


_DEAL_IN = "CASE p_size % 8 WHEN 0 THEN 'Prodej bytu' WHEN 1 THEN ' Pronájem' WHEN 2 THEN 'sale' WHEN 3 THEN 'Dražba' WHEN 4 THEN 'xx' WHEN 5 THEN 'аренда' WHEN 6 THEN NULL ELSE 'k nájmu' END"
_NAME_IN = "CASE p_size % 6 WHEN 0 THEN 'Byt' WHEN 1 THEN 'k nájem ihned' WHEN 2 THEN 'aukce domu' WHEN 3 THEN 'prodej' ELSE NULL END"
_PLAIN = "translate(lower(trim({})), 'áčďéěíňóřšťúůýž', 'acdeeinorstuuyz')"


@query(f"""WITH s AS (SELECT p_partkey, {_DEAL_IN} AS deal, {_NAME_IN} AS name FROM part), k AS (SELECT *, coalesce({_PLAIN.format('deal')}, '') AS d, coalesce({_PLAIN.format('name')}, '') AS n, coalesce(lower(deal), '') || chr(10) || coalesce(lower(name), '') AS raw FROM s),
c AS (SELECT p_partkey, CASE WHEN d LIKE 'prodej%' OR d IN ('sale', 'prodaja', 'продажа') OR n LIKE 'prodej%' OR n LIKE 'sale%' OR n LIKE 'продажа%' THEN 1 WHEN d LIKE 'pronajem%' OR d IN ('najem', 'najmem', 'аренда', 'arenda', 'rent') OR n LIKE 'najem%' OR n LIKE 'аренда%' OR n LIKE 'rent%' OR n LIKE '%pronajem%' OR n LIKE '%pronajmu%' OR raw LIKE '%nájem%' THEN 2 WHEN d LIKE 'drazb%' OR d IN ('aukce', 'аукцион') OR n LIKE '%drazb%' OR n LIKE '%aukce%' OR n LIKE '%аукцион%' THEN 3 ELSE 0 END AS v FROM k)
SELECT p_partkey, CASE v WHEN 1 THEN 'Prodej' WHEN 2 THEN 'Pronájem' WHEN 3 THEN 'Dražba' ELSE 'Neznámé' END AS deal_type, v AS deal_type_value FROM c""")
def deal_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "part").select("p_partkey", D.deal_class(F.expr(_DEAL_IN), F.expr(_NAME_IN)).alias("d"))
    return rows.select("p_partkey", "d.*")


@query(f"WITH {LISTINGS} SELECT internal_id, {_ROOMS} AS rooms_bucket, {_AREA} AS area_bucket, CASE WHEN category_name ILIKE 'byt%' THEN 'byty' WHEN category_name ILIKE 'dom%' THEN 'domy' WHEN category_name ILIKE 'pozem%' THEN 'pozemky' WHEN category_name ILIKE 'komerc%' THEN 'komercni' ELSE 'ostatni' END AS category_bucket FROM listings")
def buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return listings(spark, sf_dir).select("internal_id", D.rooms_bucket(F.col("rooms")).alias("rooms_bucket"), D.area_bucket(F.col("area_build")).alias("area_bucket"), D.category_bucket(F.col("category_name")).alias("category_bucket"))


_PHONE_IN = "CASE c_custkey % 5 WHEN 0 THEN concat(' 60', CAST(1000000 + c_custkey AS {t})) WHEN 1 THEN concat('+420 60', CAST(1000000 + c_custkey AS {t})) WHEN 2 THEN concat('00420/60', CAST(1000000 + c_custkey AS {t})) WHEN 3 THEN CAST(c_custkey AS {t}) END"


@query(f"WITH r AS (SELECT c_custkey, NULLIF(regexp_replace(trim({_PHONE_IN.format(t='VARCHAR')}), '[^0-9+]+', '', 'g'), '') AS p FROM customer) SELECT c_custkey, CASE WHEN regexp_full_match(p, '[0-9]{{9}}') THEN '+420' || p WHEN regexp_full_match(p, '\\+[0-9]{{9,15}}') THEN p WHEN regexp_full_match(p, '[0-9]{{10,15}}') THEN '+' || p END AS phone FROM r")
def phone_norm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select("c_custkey", X.phone(F.expr(_PHONE_IN.format(t="STRING"))).alias("phone"))


_MONEY_IN = "CASE o_orderkey % 4 WHEN 0 THEN concat('1 2', CAST(o_orderkey AS {t}), ',50 Kč') WHEN 1 THEN concat(CAST(o_orderkey AS {t}), ' CZK') WHEN 2 THEN 'dohodou' ELSE CAST(o_orderkey AS {t}) END"


@query(f"SELECT o_orderkey, TRY_CAST(replace(regexp_replace({_MONEY_IN.format(t='VARCHAR')}, 'Kč|CZK|[  ]', '', 'g'), ',', '.') AS DOUBLE) AS price, TRY_CAST(NULLIF(regexp_replace({_MONEY_IN.format(t='VARCHAR')}, '[^0-9.,]', '', 'g'), '') AS DOUBLE) AS digits FROM orders")
def money_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.expr(_MONEY_IN.format(t="STRING"))
    return table(spark, sf_dir, "orders").select("o_orderkey", X.money(c).alias("price"), X.digits_price(c).alias("digits"))


_ADDRESS_IN = "CASE s_suppkey % 3 WHEN 0 THEN concat(s_name, ', Part, City') WHEN 1 THEN concat(s_name, ',City ') ELSE s_name END"


@query(f"WITH a AS (SELECT s_suppkey, string_split({_ADDRESS_IN}, ',') AS p FROM supplier) SELECT s_suppkey, NULLIF(trim(p[1]), '') AS street, NULLIF(trim(p[2]), '') AS city_part, NULLIF(trim(p[-1]), '') AS city FROM a")
def address_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = F.expr(_ADDRESS_IN)
    return table(spark, sf_dir, "supplier").select("s_suppkey", X.address_part(a, 0).alias("street"), X.address_part(a, 1).alias("city_part"), X.address_part(a, -1).alias("city"))


@query(r"""SELECT doc_id, NULLIF(regexp_extract(substr(text, 1, 2000), '[A-Za-z0-9_.+-]+@[A-Za-z0-9-]+\.[A-Za-z0-9-.]+'), '') AS agent_email, NULLIF(regexp_extract(substr(text, 1, 2000), '\+?\d[\d\s]{7,}'), '') AS agent_phone FROM documents""")
def contact_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The limit of 2,000 characters is the parser's own rule.
    return table(spark, sf_dir, "documents").select("doc_id", X.contact(F.col("text")).alias("c")).select("doc_id", "c.agent_email", "c.agent_phone")


@query("SELECT doc_id, md5(trim(regexp_replace(translate(lower(text), 'áčďéěíňóřšťúůýžäëïöüľĺŕôàè-', 'acdeeinorstuuyzaeioullroae '), '\\s+', ' ', 'g'))) AS key_md5 FROM documents")
def norm_key_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(X.norm_key(F.col("text"))).alias("key_md5"))


@query("SELECT c_custkey, regexp_replace(regexp_replace(lower(trim(CASE c_custkey % 3 WHEN 0 THEN ' SR:  ' || c_name WHEN 1 THEN 'idnes: ' || c_name ELSE c_name END)), '^(sr:|sreality:|idnes:|bez:?|avizo:)\\s*', ''), '\\s+', ' ', 'g') AS site FROM customer")
def site_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.expr("CASE c_custkey % 3 WHEN 0 THEN concat(' SR:  ', c_name) WHEN 1 THEN concat('idnes: ', c_name) ELSE c_name END")
    return table(spark, sf_dir, "customer").select("c_custkey", X.site_key(raw).alias("site"))


@query("SELECT event_id, (props->>'k')::BIGINT AS k, event_type || ':' || (props->>'k') AS label FROM events")
def json_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.try_variant_get(F.try_parse_json("props"), "$.k", "string")
    return table(spark, sf_dir, "events").select("event_id", k.try_cast("bigint").alias("k"), F.concat("event_type", F.lit(":"), k).alias("label"))


@query("SELECT event_id, event_id % 2 = 0 AS has_j FROM events")
def json_key_exists(spark: SparkSession, sf_dir: str) -> DataFrame:
    props = F.expr("CASE WHEN event_id % 2 = 0 THEN '{\"k\": 1, \"j\": null}' ELSE props END")
    return table(spark, sf_dir, "events").select("event_id", snapshots.has_json_key(props, "j").alias("has_j"))


@query("SELECT event_id, pos::INTEGER AS pos, 'http://x/' || event_id::VARCHAR || '/' || pos::VARCHAR AS url FROM events, generate_series(1, 5) g(pos) WHERE pos <= event_id % 8")
def json_array_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    url = lambda i: F.concat(F.lit("http://x/"), F.col("event_id").cast("string"), F.lit("/"), i.cast("string"))
    count = F.col("event_id") % 8
    urls = F.when(count > 0, F.transform(F.sequence(F.lit(1).cast("bigint"), count), url)).otherwise(F.array().cast("array<string>"))
    objects = F.to_json(F.transform(urls, lambda u: F.struct(u.alias("url"))))
    images = F.when(F.col("event_id") % 2 == 0, F.to_json(urls)).otherwise(objects)
    return table(spark, sf_dir, "events").select("event_id", F.explode(snapshots.image_urls(images)).alias("i")).select("event_id", "i.pos", "i.url")


@query("SELECT n_nationkey, CASE n_nationkey % 5 WHEN 0 THEN 'Jihočeský kraj' WHEN 1 THEN 'Kraj Vysočina' WHEN 2 THEN 'Hlavní město Praha' WHEN 3 THEN lower(n_name) END AS region FROM nation")
def region_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.expr("CASE n_nationkey % 5 WHEN 0 THEN ' Jihočeský-KRAJ' WHEN 1 THEN 'Vysočina' WHEN 2 THEN 'hlavni mesto  praha' WHEN 3 THEN n_name END")
    return table(spark, sf_dir, "nation").select("n_nationkey", D.canonical_region(raw).alias("region"))


@query("SELECT o_orderkey, CASE o_orderkey % 6 WHEN 0 THEN true WHEN 1 THEN true WHEN 2 THEN false WHEN 3 THEN false END AS flag FROM orders")
def bool_coerce(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.expr("CASE o_orderkey % 6 WHEN 0 THEN 'Yes' WHEN 1 THEN ' t ' WHEN 2 THEN '0' WHEN 3 THEN '' WHEN 4 THEN 'maybe' END")
    return table(spark, sf_dir, "orders").select("o_orderkey", X.to_bool(raw).alias("flag"))


# ---------------------------------------------------------------- duplicates and objects


def _edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chains of up to six consecutive order keys."""
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("a"))
    return o.filter("a % 9 > 3").withColumn("b", F.col("a") + 1).join(o.select(F.col("a").alias("b")), "b", "left_semi").select("a", "b")


_CHAIN = "e AS (SELECT o_orderkey AS a, o_orderkey + 1 AS b FROM orders WHERE o_orderkey % 9 > 3 AND o_orderkey + 1 IN (SELECT o_orderkey FROM orders)), m AS (SELECT a AS id FROM e UNION SELECT b FROM e), starts AS (SELECT id FROM m WHERE id NOT IN (SELECT b FROM e)), roots AS (SELECT id, (SELECT max(s.id) FROM starts s WHERE s.id <= m.id) AS root FROM m)"


@query(f"WITH {_CHAIN} SELECT id, root FROM roots")
def connected_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.connected_components(_edges(spark, sf_dir))


@query("SELECT doc_id AS id, min(doc_id) OVER (PARTITION BY text) AS root FROM documents WHERE text IN (SELECT text FROM documents GROUP BY text HAVING count(*) > 1)")
def equal_text_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id", F.sha2("text", 256).alias("h"))
    first = d.groupBy("h").agg(F.min("doc_id").alias("a"))
    return graph.connected_components(d.join(first, "h").select("a", F.col("doc_id").alias("b")))


@query(f"WITH {_CHAIN}, l AS (SELECT o_orderkey AS internal_id, coalesce(r.root, o_orderkey) AS c FROM orders LEFT JOIN roots r ON r.id = o_orderkey), old AS (SELECT DISTINCT c FROM l WHERE c % 5 = 0), oldn AS (SELECT c, 799999999 + row_number() OVER (ORDER BY c) AS object_id FROM old), newn AS (SELECT c, (SELECT max(object_id) FROM oldn) + row_number() OVER (ORDER BY c) AS object_id FROM (SELECT DISTINCT c FROM l WHERE c % 5 <> 0)), al AS (SELECT * FROM oldn UNION ALL SELECT * FROM newn) SELECT internal_id, object_id::BIGINT AS object_id FROM l JOIN al USING (c)")
def object_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("internal_id"))
    pairs = _edges(spark, sf_dir).select(F.col("a").alias("iid1"), F.col("b").alias("iid2"))
    roots = graph.connected_components(_edges(spark, sf_dir))
    led = graph.leader_of(rows, roots, "internal_id").select(F.col("canonical").alias("canonical_internal_id")).filter("canonical_internal_id % 5 = 0").distinct()
    none = spark.createDataFrame([], "canonical_internal_id bigint, object_id bigint")
    old = R.allocate_ids(none, led, "canonical_internal_id", "object_id", D.OBJECT_ID_START)
    _, out = gold.objects(rows, pairs, old, rows.limit(0), roots)
    return out.select("internal_id", "object_id")


@query(f"WITH {_CHAIN}, x AS (SELECT e.a, e.b, r.root FROM e JOIN roots r ON r.id = e.a) SELECT root, min(date_add(DATE '2000-01-01', (a % 100)::INTEGER * INTERVAL 1 DAY))::DATE AS first_seen, max(date_add(DATE '2000-01-01', (a % 100)::INTEGER * INTERVAL 1 DAY))::DATE AS last_seen, max((a * 7 % 100)::DOUBLE) AS max_pct, count(*) AS edges_count, (count(*) + 1)::BIGINT AS members_count, (min(a)::VARCHAR || '-' || max(b)::VARCHAR) AS span FROM x GROUP BY root")
def cluster_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _edges(spark, sf_dir).withColumn("site_a", F.col("a").cast("string")).withColumn("site_b", F.col("b").cast("string"))
    roots = graph.connected_components(e)
    stats = graph.cluster_stats(e, roots.select("id"), roots, (F.col("a") * 7 % 100).cast("double"), F.date_add(F.lit(dt.date(2000, 1, 1)), (F.col("a") % 100).cast("int")))
    span = F.concat(F.element_at("member_ids", 1).cast("string"), F.lit("-"), F.element_at("member_ids", -1).cast("string"))
    return stats.select("root", "first_seen", "last_seen", "max_pct", "edges_count", "members_count", span.alias("span"))


@query("""WITH l AS (SELECT p_partkey AS id, p_brand AS g, p_size AS cat, p_type AS deal, p_retailprice AS price, (p_partkey % 50 + 20)::DOUBLE AS ab, CASE WHEN p_partkey % 3 = 0 THEN (p_partkey % 400)::DOUBLE END AS al, CASE WHEN p_partkey % 4 > 0 THEN 'c' || (p_partkey % 3)::VARCHAR END AS city, 'o' || (p_partkey % 2)::VARCHAR AS okres FROM part),
p AS (SELECT a.id AS iid1, b.id AS iid2, a.*, b.price AS price2, b.ab AS ab2, b.al AS al2, b.city AS city2, b.okres AS okres2 FROM l a JOIN l b ON a.g = b.g AND a.id < b.id AND a.cat % 3 = b.cat % 3 AND a.id % 10 = b.id % 10 WHERE a.okres = b.okres AND (a.city IS NULL OR b.city IS NULL OR a.city = b.city)),
x AS (SELECT *, CASE WHEN city = city2 THEN 'lvl3' ELSE 'lvl4' END AS level, greatest(price, price2) / least(price, price2) <= 1.2 AS price_ok, ab > 0 AND ab2 > 0 AND abs(ab - ab2) <= greatest(5.0, 0.05 * greatest(ab, ab2)) AS bok, coalesce(al > 0 AND al2 > 0 AND abs(al - al2) <= greatest(5.0, 0.05 * greatest(al, al2)), false) AS lok, ab IS NOT NULL AND al IS NOT NULL AND al2 IS NOT NULL AS four FROM p)
SELECT iid1, iid2, level, price_ok, CASE WHEN bok OR NOT four THEN 'build' ELSE 'land' END AS area_mode FROM x WHERE bok OR (four AND lok)""")
def pair_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    rows = p.select(
        F.col("p_partkey").alias("internal_id"), F.expr("cast(p_size % 3 + 10 as bigint)").alias("category_value"), F.expr("cast(p_partkey % 10 as string)").alias("deal_type"), F.col("p_retailprice").alias("price"), F.expr("CAST(p_partkey % 50 + 20 AS DOUBLE)").alias("area_build"),
        F.expr("CASE WHEN p_partkey % 3 = 0 THEN CAST(p_partkey % 400 AS DOUBLE) END").alias("area_land"), F.expr("concat('o', p_partkey % 2)").alias("norm_okres"), F.expr("CASE WHEN p_partkey % 4 > 0 THEN concat('c', p_partkey % 3) END").alias("norm_city"), F.lit(None).cast("string").alias("norm_city_part"), F.lit(" ").alias("norm_street"),
    )
    groups = p.select(F.col("p_partkey").alias("internal_id"), F.xxhash64("p_brand").alias("canonical_internal_id"))
    return silver.clean_pairs(rows, groups).select("iid1", "iid2", "level", "price_ok", "area_mode")


_MASK = "CAST(pow(2, vec_id % 9) - 1 AS BIGINT)"


def _words_duck() -> str:
    word = lambda s: " + ".join(f"CASE WHEN embedding[{s + k + 1}] > 0 THEN {1 << k}::BIGINT ELSE 0::BIGINT END" for k in range(32))
    return f"SELECT vec_id, {word(0)} AS w0, {word(32)} AS w1 FROM embeddings"


@query(f"WITH o AS ({_words_duck()}), n AS (SELECT vec_id, w0, xor(w1, (pow(2, vec_id % 9) - 1)::BIGINT) AS w1 FROM o) SELECT DISTINCT n.vec_id AS new_id, o.vec_id AS old_id, (bit_count(xor(n.w0, o.w0)) + bit_count(xor(n.w1, o.w1)))::INTEGER AS distance FROM n JOIN o ON bit_count(xor(n.w0 & 255, o.w0 & 255)) <= 1 WHERE bit_count(xor(n.w0, o.w0)) + bit_count(xor(n.w1, o.w1)) <= 6")
def phash_blocked_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    word = lambda s: sum((F.when(F.get("embedding", F.lit(s + k)) > 0, F.lit(1 << k).cast("bigint")).otherwise(F.lit(0).cast("bigint")) for k in range(1, 32)), F.when(F.get("embedding", F.lit(s)) > 0, F.lit(1).cast("bigint")).otherwise(F.lit(0).cast("bigint")))
    e = table(spark, sf_dir, "embeddings").select("vec_id", word(0).alias("w0"), word(32).alias("w1"))
    block = F.col("w0").bitwiseAND(F.lit(255).cast("bigint")).cast("int")
    old = e.select((F.col("vec_id") * 2).alias("k"), F.array("w0", "w1").alias("w"), block.alias("b"))
    new = e.select((F.col("vec_id") * 2 + 1).alias("k"), F.array("w0", F.col("w1").bitwiseXOR(F.expr(_MASK))).alias("w"), block.alias("b"))
    pairs = phash.blocked_pairs(new, old, "k", "w", "b", with_new=False, n_words=2)
    odd = lambda a, b: F.when(F.col(a) % 2 == 1, F.col(a)).otherwise(F.col(b))
    even = lambda a, b: F.when(F.col(a) % 2 == 0, F.col(a)).otherwise(F.col(b))
    half = lambda c: F.shiftright(c, 1)
    return pairs.select(half(odd("key1", "key2")).alias("new_id"), half(even("key1", "key2")).alias("old_id"), "distance")


# ---------------------------------------------------------------- quality and sets


_COPY = "copy AS (SELECT CASE WHEN o_orderkey % 50 = 0 THEN o_orderkey + 10000000 ELSE o_orderkey END AS o_orderkey, CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE o_orderstatus END AS o_orderstatus, CASE WHEN o_orderkey % 20 = 1 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice FROM orders UNION ALL SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderkey % 100 = 7)"


def _copy(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    c = o.select(F.expr("CASE WHEN o_orderkey % 50 = 0 THEN o_orderkey + 10000000 ELSE o_orderkey END").alias("o_orderkey"), F.expr("CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE o_orderstatus END").alias("o_orderstatus"), F.expr("CASE WHEN o_orderkey % 20 = 1 THEN o_totalprice + 1 ELSE o_totalprice END").alias("o_totalprice"))
    return o, c.unionByName(o.filter("o_orderkey % 100 = 7"))


@query(f"WITH {_COPY} SELECT (SELECT count(DISTINCT o_orderkey) FROM orders)::BIGINT AS source_keys, (SELECT count(DISTINCT o_orderkey) FROM copy)::BIGINT AS target_keys, (SELECT count(*) FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM copy))::BIGINT AS missing, (SELECT count(DISTINCT o_orderkey) FROM copy WHERE o_orderkey NOT IN (SELECT o_orderkey FROM orders))::BIGINT AS extra, (SELECT count(*) - count(DISTINCT o_orderkey) FROM copy)::BIGINT AS duplicates")
def audit_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.audit_keys(*_copy(spark, sf_dir), ["o_orderkey"])


@query(f"WITH {_COPY} SELECT sum((o.o_orderstatus IS DISTINCT FROM c.o_orderstatus)::INT)::BIGINT AS o_orderstatus, sum((o.o_totalprice IS DISTINCT FROM c.o_totalprice)::INT)::BIGINT AS o_totalprice FROM orders o JOIN copy c USING (o_orderkey)")
def audit_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.audit_columns(*_copy(spark, sf_dir), ["o_orderkey"], ["o_orderstatus", "o_totalprice"])


@query(f"WITH {_COPY} SELECT o_orderkey, count(*) AS n FROM copy GROUP BY 1 HAVING count(*) > 1")
def dup_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _copy(spark, sf_dir)[1].groupBy("o_orderkey").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


@query("SELECT o_orderkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 9 > 0)")
def fk_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    parents = table(spark, sf_dir, "customer").filter("c_custkey % 9 > 0").select(F.col("c_custkey").alias("o_custkey"))
    return table(spark, sf_dir, "orders").join(parents, "o_custkey", "left_anti").select("o_orderkey")


@query(f"WITH {_SNAP} SELECT (SELECT count(*) FROM state) AS before, (SELECT count(*) FROM curr WHERE id NOT IN (SELECT id FROM state)) AS inserted, (SELECT count(*) FROM (SELECT id FROM state UNION SELECT id FROM curr)) AS after")
def mass_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    prev, curr, state = _snapshots(spark, sf_dir)
    after = R.sync_snapshot(state, curr, F.lit(AS_OF), prev)
    one = lambda df, name: df.agg(F.count(F.lit(1)).alias(name))
    return one(state, "before").crossJoin(one(R.insert_absent(state, curr, ["id"]), "inserted")).crossJoin(one(after, "after"))


@query("SELECT count(*) AS rows, count(DISTINCT (c_mktsegment, x)) AS tuples, count(*) FILTER (c_acctbal > 0) AS positive, bool_and(c_custkey > 0) AS all_positive FROM (SELECT *, CASE WHEN c_custkey % 2 = 0 THEN c_nationkey END AS x FROM customer)")
def count_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").withColumn("x", F.expr("CASE WHEN c_custkey % 2 = 0 THEN c_nationkey END"))
    return c.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct(F.struct("c_mktsegment", "x")).alias("tuples"), F.count_if(F.col("c_acctbal") > 0).alias("positive"), F.bool_and(F.col("c_custkey") > 0).alias("all_positive"))


@query("SELECT user_id, count(*) AS cnt FROM events GROUP BY 1 ORDER BY cnt DESC, user_id LIMIT 10")
def top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.top_counts(table(spark, sf_dir, "events"), "user_id", 10)


@query("SELECT o_custkey AS k FROM orders WHERE o_orderstatus = 'F' UNION SELECT o_custkey FROM orders WHERE o_orderstatus = 'O'")
def union_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.filter("o_orderstatus = 'F'").select(F.col("o_custkey").alias("k")).union(o.filter("o_orderstatus = 'O'").select("o_custkey")).distinct()


@query("SELECT o_custkey AS k FROM orders WHERE o_orderstatus = 'F' INTERSECT SELECT o_custkey FROM orders WHERE o_orderstatus = 'O'")
def intersect_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.filter("o_orderstatus = 'F'").select(F.col("o_custkey").alias("k")).intersect(o.filter("o_orderstatus = 'O'").select("o_custkey"))


@query("SELECT c_custkey AS k FROM customer EXCEPT SELECT o_custkey FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 300000")
def set_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k")).subtract(table(spark, sf_dir, "orders").filter("o_orderstatus = 'F' and o_totalprice > 300000").select("o_custkey"))


@query("SELECT l_returnflag, l_linestatus, sum(l_quantity) AS sum_qty, sum(l_extendedprice * (1 - l_discount)) AS revenue, avg(l_discount) AS avg_disc, count(*) AS n FROM lineitem WHERE l_shipdate::DATE <= DATE '1998-09-02' GROUP BY 1, 2")
def grouped_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").filter(F.col("l_shipdate").cast("date") <= F.lit(dt.date(1998, 9, 2)))
    return rows.groupBy("l_returnflag", "l_linestatus").agg(F.sum("l_quantity").alias("sum_qty"), F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("revenue"), F.avg("l_discount").alias("avg_disc"), F.count(F.lit(1)).alias("n"))


@query(f"WITH {LISTINGS}, s AS (SELECT internal_id, CASE WHEN internal_id % 3 = 0 THEN ' ' ELSE 'N' || (internal_id % 4)::VARCHAR END AS agent_name, CASE WHEN internal_id % 4 = 0 THEN NULL ELSE agent_phone END AS agent_phone, agent_email FROM listings WHERE internal_id % 2 = 0) SELECT l.internal_id, coalesce(NULLIF(trim(s.agent_name), ''), l.agent_name) AS agent_name, l.agent_phone, l.agent_email FROM listings l LEFT JOIN s USING (internal_id)")
def seller_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = listings(spark, sf_dir).withColumn("updated_at", F.current_timestamp())
    s = rows.filter("internal_id % 2 = 0").select("internal_id", F.expr("CASE WHEN internal_id % 3 = 0 THEN ' ' ELSE concat('N', internal_id % 4) END").alias("agent_name"), F.expr("CASE WHEN internal_id % 4 = 0 THEN NULL ELSE agent_phone END").alias("agent_phone"), "agent_email", F.lit(1).alias("seen_at"))
    return gold.enrich_sellers(rows, s).select("internal_id", "agent_name", "agent_phone", "agent_email")


@query(f"WITH {LISTINGS} SELECT internal_id, change_date, min(old_price) AS old_price, new_price FROM (SELECT o_orderkey AS internal_id, o_orderdate::DATE AS change_date, round(o_totalprice, 2)::DECIMAL(12,2)::DOUBLE AS old_price, round(o_totalprice * 2, 2)::DECIMAL(12,2)::DOUBLE AS new_price FROM orders WHERE o_orderkey % 3 <> 0) GROUP BY ALL")
def price_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = listings(spark, sf_dir)
    prices = table(spark, sf_dir, "orders").filter("o_orderkey % 3 <> 0").select(F.col("o_orderkey").cast("string").alias("id"), F.expr("CAST(o_orderkey % 3 + 1 AS INT)").alias("source_id"), F.round("o_totalprice", 2).alias("old_price"), F.round(F.col("o_totalprice") * 2, 2).alias("new_price"), F.col("o_orderdate").cast("date").alias("change_date"))
    none = spark.createDataFrame([], "internal_id bigint, change_date date, new_price decimal(12,2)")
    return gold.price_history(prices, rows, none).select("internal_id", "change_date", F.col("old_price").cast("double").alias("old_price"), F.col("new_price").cast("double").alias("new_price"))


