"""More named queries: sources, bronze to gold steps, address cascades, gates, storage, runner and streams, with their SQL."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import schemas
from .functions import domain as D
from .functions import text as X
from .lineage import checkpoint_root, cut_lineage
from .operators import graph, quality
from .operators import relational as R
from .operators.state import BucketedState
from .plans import addresses, bi, bronze, gold, runner, silver
from .queries import _CHAIN, _COPY, _SNAP, AS_OF, LISTINGS, ORACLES, QUERIES, _copy, _edges, _snapshots, listings, query, table
from .sources import batches, snapshots
from .storage import Database
from .streaming import keyed
from .streaming import snapshots as streams

__all__ = ["ORACLES", "QUERIES"]


def _folder(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _text(*names: str) -> list[Column]:
    return [F.col(n).cast("string").alias(n) for n in names]


# ---------------------------------------------------------------- sources


@query("""WITH n AS (SELECT 'sreality_' || strftime(o_orderdate, '%d%m%Y') AS name FROM orders WHERE o_orderkey % 5 = 0 UNION SELECT 'idnes_' || strftime(o_orderdate, '%d%m%Y') FROM orders WHERE o_orderkey % 5 = 1 UNION SELECT 'sreality_' || (o_orderkey % 90 + 10)::VARCHAR || '139999' FROM orders UNION SELECT 'sreality_backup'),
d AS (SELECT name, try_strptime(right(name, 8), '%d%m%Y')::DATE AS d FROM n WHERE regexp_full_match(name, 'sreality_[0-9]{8}')) SELECT name, d::VARCHAR AS snapshot_date, dense_rank() OVER (ORDER BY d DESC)::INTEGER AS age FROM d WHERE d IS NOT NULL AND d <= DATE '2001-07-01'""")
def snapshot_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    o, day = table(spark, sf_dir, "orders"), F.date_format("o_orderdate", "ddMMyyyy")
    names = o.filter("o_orderkey % 5 = 0").select(F.concat(F.lit("sreality_"), day).alias("name")).union(o.filter("o_orderkey % 5 = 1").select(F.concat(F.lit("idnes_"), day)))
    bad = o.select(F.concat(F.lit("sreality_"), (F.col("o_orderkey") % 90 + 10).cast("string"), F.lit("139999"))).union(spark.range(1).select(F.lit("sreality_backup")))
    return snapshots.ranked_names(names.union(bad).distinct(), "sreality", dt.date(2001, 7, 1)).withColumn("snapshot_date", F.col("snapshot_date").cast("string"))


@query("""WITH e AS (SELECT ts::DATE AS d, count(*) AS n FROM events GROUP BY 1), r AS (SELECT *, row_number() OVER (ORDER BY d DESC) AS k FROM e), w AS (SELECT * FROM (VALUES ('latest', 1), ('current', 1), ('previous', 2), ('today', 1), ('yesterday', 2)) v(part, k)) SELECT part, d::VARCHAR AS day, n FROM w JOIN r USING (k)""")
def snapshot_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").withColumn("snapshot_date", F.col("ts").cast("date"))
    previous, current = snapshots.latest_two(e)
    today = e.agg(F.max("snapshot_date")).first()[0]
    yesterday, now = snapshots.calendar_exact(e, today)
    parts = {"latest": snapshots.latest(e), "current": current, "previous": previous, "today": now, "yesterday": yesterday}
    return R.union_by_name(*[p.select(F.lit(k).alias("part"), F.col("snapshot_date").cast("string").alias("day")) for k, p in parts.items()]).groupBy("part", "day").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT event_id::VARCHAR AS id, event_type || ' 2+kk' AS name, 'Street ' || (user_id % 9)::VARCHAR || ', City' AS address, 'houses' AS category_name, value AS price, NULL::VARCHAR AS floor FROM events WHERE event_id % 10 > 1")
def json_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = F.to_json(F.struct(F.col("event_id").alias("id"), F.concat("event_type", F.lit(" 2+kk")).alias("title"), F.concat(F.lit("Street "), (F.col("user_id") % 9).cast("string"), F.lit(", City")).alias("address"), F.lit("houses").alias("type"), F.col("value").alias("Cena_numeric"), F.lit("x").alias("other")))
    docs = table(spark, sf_dir, "events").select(F.when(F.col("event_id") % 10 == 0, "no json").when(F.col("event_id") % 10 > 1, made).alias("data"))
    return snapshots.json_records(docs).select("id", "name", "address", "category_name", F.col("price_czk").cast("double").alias("price"), "floor")


_REG = """registry AS (SELECT CASE WHEN n_nationkey % 2 = 0 THEN '{even}' ELSE '{odd}' END AS kraj, n_nationkey AS n, substr(md5(n_name || 't'), 1, 12) AS town, substr(md5(n_name || 'p'), 1, 12) AS part, substr(md5(n_name || 's'), 1, 12) AS street, r_name AS county FROM nation JOIN region ON n_regionkey = r_regionkey)"""


def _registry(spark: SparkSession, sf_dir: str, even: str, odd: str) -> DataFrame:
    rows = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return rows.select(
        F.when(F.col("n_nationkey") % 2 == 0, even).otherwise(odd).alias("kraj"), *[F.substring(F.md5(F.concat("n_name", F.lit(k))), 1, 12).alias(c) for k, c in (("t", "nazev_obce"), ("p", "nazev_casti_obce"), ("s", "nazev_ulice"))],
        F.col("r_name").alias("region"), F.concat(F.lit("Praha "), (F.col("n_nationkey") % 10 + 1).cast("string")).alias("nazev_obvodu_prahy"), F.col("n_nationkey"),
    )


def _open_rows(spark: SparkSession, sf_dir: str, registry: DataFrame, district: Column, city: str, part: str, street: str) -> DataFrame:
    rows = table(spark, sf_dir, "customer").join(registry, F.col("c_nationkey") == F.col("n_nationkey"))
    town = {"norm_city": city, "norm_city_part": part, "norm_street": street}
    return rows.select(F.col("c_custkey").alias("internal_id"), district.alias("norm_district"), F.lit(None).cast("string").alias("norm_okres"), *[F.expr(e).alias(c) for c, e in town.items()], (F.col("c_custkey") % 11 == 0).alias("geo_ok"), F.lit(False).alias("not_true"))


@query(f"""WITH {_REG.format(even='Zlínský kraj', odd='Ústecký kraj')}, s AS (SELECT c_custkey AS internal_id, c_custkey % 5 AS k, r.* FROM customer JOIN registry r ON c_nationkey = n WHERE c_custkey % 11 <> 0 AND kraj = 'Zlínský kraj')
SELECT internal_id, kraj AS norm_district, CASE WHEN k < 4 THEN county END AS norm_okres, CASE WHEN k < 4 THEN town END AS norm_city, CASE WHEN k = 2 THEN part END AS norm_city_part, CASE WHEN k = 3 THEN street END AS norm_street, k < 4 AS geo_ok, k = 4 AS not_true FROM s""")
def region_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Towns are found as they are or with a letter too many, else by part or street of the region's registry."""
    reg = _registry(spark, sf_dir, "Zlínský kraj", "Ústecký kraj")
    case = "CASE WHEN c_custkey % 5 = {} THEN {} END"
    rows = _open_rows(spark, sf_dir, reg, F.col("kraj"), "CASE c_custkey % 5 WHEN 0 THEN upper(nazev_obce) WHEN 1 THEN concat(nazev_obce, 'x') END", case.format(2, "nazev_casti_obce"), case.format(3, "nazev_ulice"))
    return silver.region_cascade(rows, *snapshots.registry_lists(reg, "Zlínský kraj"), "Zlínský kraj")


@query(f"""WITH {_REG.format(even=D.CAPITAL, odd=D.NEIGHBOUR)}, s AS (SELECT c_custkey AS internal_id, c_custkey % 6 AS k, n % 2 AS odd, r.* FROM customer JOIN registry r ON c_nationkey = n WHERE c_custkey % 11 <> 0),
p AS (SELECT *, CASE WHEN k < 2 THEN 1 WHEN k IN (2, 4) AND odd = 0 THEN 2 WHEN k IN (2, 3, 4) AND odd = 1 THEN 3 ELSE 0 END AS phase FROM s)
SELECT internal_id, phase, CASE WHEN phase = 3 THEN '{D.NEIGHBOUR}' ELSE '{D.CAPITAL}' END AS norm_district, CASE WHEN phase = 3 THEN county END AS norm_okres,
CASE WHEN k = 0 THEN 'Praha 5' WHEN k = 1 THEN 'Praha' WHEN phase = 2 THEN 'Praha ' || (n % 10 + 1)::VARCHAR WHEN phase = 3 OR k = 3 THEN town END AS norm_city, CASE WHEN k = 2 OR (phase = 2 AND k = 4) THEN part END AS norm_city_part, CASE WHEN k = 4 THEN street END AS norm_street, phase > 0 AS geo_ok, phase = 0 AS not_true FROM p""")
def capital_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    reg = _registry(spark, sf_dir, D.CAPITAL, D.NEIGHBOUR)
    rows = _open_rows(spark, sf_dir, reg, F.lit(D.CAPITAL), "CASE c_custkey % 6 WHEN 0 THEN 'praha-5 Smíchov' WHEN 1 THEN ' Praha' WHEN 3 THEN nazev_obce END", "CASE WHEN c_custkey % 6 = 2 THEN nazev_casti_obce END", "CASE WHEN c_custkey % 6 = 4 THEN nazev_ulice END")
    return silver.capital_cascade(rows, snapshots.registry_lists(reg, D.CAPITAL), snapshots.registry_lists(reg, D.NEIGHBOUR))


# ---------------------------------------------------------------- bronze and silver


_STATE = "o_orderkey AS id, o_orderdate::DATE::VARCHAR AS added_date, CASE WHEN o_orderkey % 2 = 0 THEN '2001-01-01' END AS archived_date, o_orderkey % 2 <> 0 AS available"


@query(f"""WITH o AS (SELECT {_STATE}, o_orderkey % 4 AS k FROM orders)
SELECT 1 AS source_id, id::VARCHAR AS site_id, added_date, archived_date, available, NULL::BIGINT AS category_value, 'byt' AS category_name, CASE k WHEN 0 THEN 'prodej' WHEN 1 THEN 'pronájem' END AS deal_type, NULL AS rooms, id::DOUBLE AS price, NULL::DOUBLE AS area_build, NULL::DOUBLE AS area_land, NULL AS street, NULL AS city_part, 'Brno' AS city, NULL AS district FROM o WHERE id % 3 = 0
UNION ALL SELECT 3, id::VARCHAR, added_date, archived_date, available, CASE k WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 2 THEN 3 ELSE 5 END, CASE k WHEN 0 THEN 'byt' WHEN 1 THEN 'dum' WHEN 2 THEN 'pozemek' ELSE 'ostatni' END, 'prodej', '2+kk', id + 0.5, NULL, NULL, 'Dlouhá', CASE k WHEN 0 THEN 'Part' WHEN 1 THEN 'City' END, CASE k WHEN 0 THEN 'City' WHEN 1 THEN 'City' WHEN 2 THEN 'Dlouhá' END, CASE k WHEN 0 THEN 'Dlouhá, Part , City' WHEN 1 THEN 'Dlouhá,City' WHEN 2 THEN 'Dlouhá' ELSE 'Dlouhá, ,' END FROM o WHERE id % 3 = 1
UNION ALL SELECT 2, id::VARCHAR, added_date, archived_date, available, CASE k WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 2 THEN 3 END, CASE k WHEN 0 THEN 'Byt' WHEN 1 THEN 'dum' WHEN 2 THEN 'pozemek' ELSE 'garaz' END, 'pronajem', CASE WHEN k = 0 THEN '2+kk' END, CASE WHEN k < 3 THEN id::DOUBLE END, CASE WHEN k < 2 THEN 45.0 END, CASE k WHEN 1 THEN 1045.0 WHEN 2 THEN 45.0 END, 'Krátká', 'Praha-5', 'Praha', 'Kraj' FROM o WHERE id % 3 = 2""")
def canonical_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three sources' states as canonical listings."""
    k = F.col("o_orderkey") % 4
    pick = lambda *values: F.element_at(F.array(*[F.lit(v).cast("string") for v in values]), (k + 1).cast("int"))
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderdate").cast("date").alias("added_date"), F.when(F.col("o_orderkey") % 2 == 0, "2001-01-01").alias("archived_date"), k.alias("k"), "o_orderkey")
    a = o.filter("id % 3 = 0").withColumns({"name": pick("Prodej bytu", " Pronájem domu", "", None), "price_summary_czk": F.concat(F.col("id").cast("string"), F.lit(" Kč")), "category_name": F.lit("byt"), "city": F.lit("Brno")})
    c = o.filter("id % 3 = 1").withColumns({"name": F.lit("Prodej 2+kk 45 m"), "category_name": pick("Apartments", "houses", "land", "other"), "price_czk": F.concat(F.col("id").cast("string"), F.lit(",5 CZK")), "address": pick("Dlouhá, Part , City", "Dlouhá,City", "Dlouhá", "Dlouhá, ,")})
    b = o.filter("id % 3 = 2").withColumns({"estate_type": pick("Byt", "dum", "pozemek", "garaz"), "image_alt_text": F.lit("Dům 45 m² a 1.045 m²"), "address": F.lit("Krátká, Praha-5, Kraj"), "query_name": F.lit("Pronajem_x_y"), "disposition": F.when(F.col("k") == 0, "DISP_2_KK"), "price": F.when(F.col("k") < 3, F.col("id").cast("string")).otherwise("dohodou")})
    rows = R.union_by_name(bronze.sreality_listing(a), bronze.idnes_listing(c), bronze.bezrealitky_listing(b))
    return rows.drop("name", "house_number", "longitude", "latitude").withColumns({d: F.col(d).cast("string") for d in ("added_date", "archived_date")})


@query("SELECT o_orderkey AS id, o_orderkey + 0.5 AS old_price, o_orderkey + 7.5 AS new_price, '2001-08-01' AS change_date FROM orders WHERE o_orderkey % 4 = 1")
def price_text_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"))
    text = lambda x: F.concat(x.cast("string"), F.lit(".5 Kč"))
    previous = o.withColumn("price", text(F.col("id")))
    current = o.withColumn("price", F.when(F.col("id") % 4 == 1, text(F.col("id") + 7)).when(F.col("id") % 4 == 2, "dohodou").otherwise(text(F.col("id"))))
    return bronze.price_events(previous, current, F.lit(AS_OF)).withColumn("change_date", F.col("change_date").cast("string"))


@query(r"""WITH a AS (SELECT c_custkey::VARCHAR AS id, CASE WHEN c_custkey % 3 > 0 THEN c_name END AS agent_name, CASE WHEN c_custkey % 4 = 0 THEN '+42060' || (1000000 + c_custkey)::VARCHAR END AS agent_phone, CASE WHEN c_custkey % 5 = 0 THEN 'c' || c_custkey::VARCHAR || '@x.cz' END AS agent_email FROM customer),
b AS (SELECT s_suppkey::VARCHAR AS id, s_name AS agent_name, regexp_extract(s_name, '\+?\d[\d\s]{7,}') AS agent_phone, CASE WHEN s_suppkey % 2 = 0 THEN 's' || s_suppkey::VARCHAR || '@y.cz' END AS agent_email FROM supplier),
u AS (SELECT * FROM a WHERE agent_phone IS NOT NULL OR agent_email IS NOT NULL UNION ALL SELECT * FROM b), r AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY agent_email IS NULL, agent_phone IS NULL, agent_email, agent_phone, agent_name) AS n FROM u) SELECT id, agent_name, agent_phone, agent_email FROM r WHERE n = 1 AND id::BIGINT % 7 <> 0""")
def seller_sync(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sellers of a snapshot's columns and of parsed texts; contacts with e-mail come before others."""
    snap = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.expr("CASE WHEN c_custkey % 3 > 0 THEN concat(c_name, ' ') ELSE ' ' END").alias("agent_name"), F.expr("CASE WHEN c_custkey % 4 = 0 THEN concat('60 ', 1000000 + c_custkey) END").alias("agent_phone"), F.expr("CASE WHEN c_custkey % 5 = 0 THEN concat('C', c_custkey, '@X.cz') END").alias("agent_email")
    )
    records = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), F.expr("concat(s_name, ', Agency', CASE WHEN s_suppkey % 2 = 0 THEN concat(', s', s_suppkey, '@y.cz') ELSE '' END)").alias("seller_info"))
    known = spark.createDataFrame([], schemas.SELLER).unionByName(snap.filter("id % 7 = 0").select(F.col("id").cast("string").alias("id"), *[F.lit(None).cast("string").alias(c) for c in ("agent_name", "agent_phone", "agent_email")]))
    known = known.unionByName(records.filter("id % 7 = 0").select(F.col("id").cast("string").alias("id"), *[F.lit(None).cast("string").alias(c) for c in ("agent_name", "agent_phone", "agent_email")])).distinct()
    return silver.sellers(known, bronze.sreality_sellers(snap), bronze.parsed_sellers(records))


@query(f"WITH {LISTINGS} SELECT internal_id, CASE internal_id % 4 WHEN 0 THEN 'Prodej' WHEN 1 THEN 'Pronájem' WHEN 2 THEN 'Dražba' ELSE 'Neznámé' END AS deal_type, CASE WHEN internal_id % 4 = 3 THEN 0 ELSE internal_id % 4 + 1 END::INTEGER AS deal_type_value, false AS geo_status FROM listings WHERE internal_id % 3 > 0 AND internal_id % 5 > 0 AND internal_id % 13 > 0 AND internal_id % 17 > 0 AND price > 1000 AND price < 1e10")
def geo_inflow(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = listings(spark, sf_dir).withColumn("name", F.col("category_name")).withColumn("price", F.expr("CASE WHEN internal_id % 13 = 0 THEN 1000D WHEN internal_id % 17 > 0 THEN price END"))
    return silver.to_geo(rows, rows.filter("internal_id % 3 = 0"), rows.filter("internal_id % 5 = 0")).select("internal_id", "deal_type", "deal_type_value", "geo_status")


@query(f"WITH {LISTINGS}, g AS (SELECT internal_id, CASE WHEN internal_id % 10 = 0 THEN NULL ELSE archived_date END AS a, CASE WHEN internal_id % 15 = 1 THEN NULL ELSE available END AS b FROM listings WHERE internal_id % 4 <> 2) SELECT internal_id, archived_date::VARCHAR AS archived_date, available FROM listings JOIN g USING (internal_id) WHERE archived_date IS DISTINCT FROM a OR available IS DISTINCT FROM b")
def archive_sync(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = listings(spark, sf_dir)
    geo = rows.filter("internal_id % 4 <> 2").select("internal_id", F.expr("CASE WHEN internal_id % 10 > 0 THEN archived_date END").alias("archived_date"), F.expr("CASE WHEN internal_id % 15 <> 1 THEN available END").alias("available"))
    return silver.archive_updates(rows, geo).withColumn("archived_date", F.col("archived_date").cast("string"))


@query(f"WITH {LISTINGS} SELECT internal_id FROM listings WHERE (archived_date IS NULL) IS DISTINCT FROM (CASE WHEN internal_id % 6 = 0 THEN NULL WHEN internal_id % 7 = 0 THEN NOT available ELSE available END)")
def geo_contradictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    flag = F.expr("CASE WHEN internal_id % 6 = 0 THEN NULL WHEN internal_id % 7 = 0 THEN NOT available ELSE available END")
    return listings(spark, sf_dir).filter(D.contradiction(F.col("archived_date"), flag)).select("internal_id")


@query("SELECT c_custkey::VARCHAR AS id, '[\"u' || c_custkey::VARCHAR || '\"]' AS images FROM customer WHERE c_custkey % 3 = 0")
def photo_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    snap = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.expr("CASE c_custkey % 3 WHEN 0 THEN concat('[\"u', c_custkey, '\"]') WHEN 1 THEN '[broken' END").alias("images"))
    return bronze.photos(snap.union(snap))


@query(f"WITH {LISTINGS}, k AS (SELECT source_id, site_id FROM listings WHERE internal_id % 4 > 0), n AS (SELECT *, row_number() OVER (ORDER BY source_id, site_id) AS r FROM k) SELECT source_id, site_id, (r + (SELECT max(internal_id) FROM listings WHERE internal_id % 4 = 0))::BIGINT AS internal_id FROM n")
def internal_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = listings(spark, sf_dir)
    return silver.with_internal_ids(rows.filter("internal_id % 4 = 0"), rows.filter("internal_id % 4 > 0").select("source_id", "site_id")).select("source_id", "site_id", "internal_id")


# ---------------------------------------------------------------- addresses


_QUEUE = "SELECT c_custkey AS internal_id, CASE c_custkey % 4 WHEN 0 THEN 'neuvedeno' WHEN 1 THEN ' Brno ' WHEN 2 THEN NULL ELSE 'None' END AS city, c_name AS name, c_custkey % 5 = 0 AS geo_status FROM customer"


@query(f"SELECT internal_id, 'City: ' || CASE WHEN internal_id % 4 = 1 THEN 'Brno' ELSE '' END || ', {{\"id\": {{x}}}} ' || name AS prompt FROM ({_QUEUE}) WHERE NOT geo_status ORDER BY internal_id LIMIT 90")
def address_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The limit is the batch's."""
    queue = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("internal_id"), F.expr("CASE c_custkey % 4 WHEN 0 THEN 'neuvedeno' WHEN 1 THEN ' Brno ' WHEN 2 THEN NULL ELSE 'None' END").alias("city"), F.col("c_name").alias("name"), (F.col("c_custkey") % 5 == 0).alias("geo_status"))
    return addresses.requests(queue, 'City: {city}, {"id": {x}} {name}', 90)


@query("SELECT c_custkey AS internal_id, CASE c_custkey % 4 WHEN 0 THEN true WHEN 1 THEN false END AS in_cz, CASE WHEN c_custkey % 4 < 2 THEN c_custkey % 4 = 0 ELSE false END AS geo_status, CASE c_custkey % 4 WHEN 0 THEN 'Zlínský kraj' WHEN 1 THEN 'NOT_CZ' ELSE 'old' END AS norm_district, CASE WHEN c_custkey % 4 = 0 THEN 'City ' || c_custkey::VARCHAR ELSE 'old' END AS norm_city FROM customer")
def address_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers written in files of bounded size, read back without the broken ones, and laid over the queue."""
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("internal_id"))
    empty = {f: F.lit(None).cast("string").alias(f) for f in addresses.FIELDS}
    queue = c.select("internal_id", F.lit(None).cast("boolean").alias("in_cz"), F.lit(False).alias("geo_status"), F.lit("old").alias("norm_district"), empty["norm_okres"], F.lit("old").alias("norm_city"), empty["norm_city_part"], empty["norm_street"], empty["norm_house_number"])
    good = F.to_json(F.struct(F.lit("yes").alias("in_cz"), F.lit(True).alias("geo_status"), F.lit("Zlínský kraj").alias("norm_district"), F.concat(F.lit("City "), F.col("internal_id").cast("string")).alias("norm_city")))
    answer = F.when(F.col("internal_id") % 4 == 0, good).when(F.col("internal_id") % 4 == 1, '{"in_cz": "no", "geo_status": 0, "norm_district": "NOT_CZ"}').when(F.col("internal_id") % 4 == 2, "{broken").otherwise("{}")
    folder = _folder(spark, "answers")
    addresses.export_requests(c.select("internal_id", answer.alias("answer")), folder, 50)
    return addresses.apply_answers(queue, addresses.import_answers(spark, folder)).select("internal_id", "in_cz", "geo_status", "norm_district", "norm_city")


@query("SELECT c_custkey AS internal_id, CASE WHEN c_custkey % 6 = 0 THEN 'known' ELSE c_mktsegment END AS norm_city, c_custkey % 6 = 0 AS geo_ok FROM customer WHERE c_custkey % 6 = 0 OR c_custkey % 2 = 0")
def subset_inflow(spark: SparkSession, sf_dir: str) -> DataFrame:
    none = lambda c: F.lit(None).cast("string").alias(c)
    c = table(spark, sf_dir, "customer")
    rest = [none(x) for x in ("norm_district", "norm_okres", "norm_city_part", "norm_street")]
    geo = c.select(F.col("c_custkey").alias("internal_id"), F.expr("CASE WHEN c_custkey % 2 = 0 THEN true WHEN c_custkey % 3 = 0 THEN false END").alias("geo_status"), F.col("c_mktsegment").alias("norm_city"), *rest)
    subset = c.filter("c_custkey % 6 = 0").select(F.col("c_custkey").alias("internal_id"), F.lit("known").alias("norm_city"), *rest, F.lit(True).alias("geo_ok"), F.lit(False).alias("not_true"))
    return addresses.to_subset(geo, subset).select("internal_id", "norm_city", "geo_ok")


# ---------------------------------------------------------------- duplicates and gold


@query("""WITH a AS (SELECT c_custkey AS k, c_custkey % 3 = 0 AS flip FROM customer) SELECT n.k - 1 AS site_id1, n.k AS site_id2, CASE WHEN n.flip <> o.flip THEN 1 ELSE 0 END AS distance, CASE WHEN n.flip <> o.flip THEN 99.61 ELSE 100.0 END::DOUBLE AS percentage FROM a n JOIN a o ON o.k = n.k - 1 AND n.k % 2 = 1""")
def image_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listings 2 j and 2 j + 1 have the same picture, those divisible by 3 with one bit changed."""
    half = F.floor(F.col("c_custkey") / 2).cast("string")
    hexes = F.concat(F.md5(half), F.substring(F.md5(F.concat(half, F.lit("b"))), 1, 31), F.when(F.col("c_custkey") % 3 == 0, "1").otherwise("0"))
    rows = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("site_id"), hexes.alias("phash"))
    return silver.image_pairs(rows.filter("site_id % 2 = 1"), rows.filter("site_id % 2 = 0"), with_new=False)


_DAY = "(CASE WHEN {0} % 4 = 0 THEN NULL ELSE DATE '2000-01-01' + ({0} % 50)::INTEGER END)"


@query(f"WITH {_CHAIN}, m2 AS (SELECT id, root, {_DAY.format('id')} AS d FROM roots), c AS (SELECT root, first(id ORDER BY d NULLS LAST, id) AS canonical, count(*) AS members_count FROM m2 GROUP BY root) SELECT m2.id AS internal_id, canonical AS canonical_internal_id, d::VARCHAR AS iid_added_min, members_count, (members_count - 1)::BIGINT AS edges_count FROM m2 JOIN c USING (root)")
def duplicate_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chains of listings whose pictures match; the earliest is the cluster's name."""
    pairs = _edges(spark, sf_dir).select(F.col("a").alias("site_id1"), F.concat(F.lit("sr: "), F.col("b").cast("string")).alias("site_id2"), F.lit(99.0).alias("percentage"), F.lit(AS_OF).alias("date"))
    geo = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("internal_id"), F.col("o_orderkey").cast("string").alias("site_id"), F.expr("CASE WHEN o_orderkey % 4 > 0 THEN date_add(DATE '2000-01-01', CAST(o_orderkey % 50 AS INT)) END").alias("added_date"))
    mapping, cluster = silver.clusters(pairs, geo)
    return mapping.join(cluster, "canonical_internal_id").select("internal_id", "canonical_internal_id", F.col("iid_added_min").cast("string").alias("iid_added_min"), "members_count", "edges_count")


@query(f"WITH {LISTINGS} SELECT internal_id, CASE internal_id % 4 WHEN 0 THEN 'Zlínský kraj' ELSE 'Ústecký kraj' END AS norm_district, norm_city, price + 1 AS price FROM listings WHERE internal_id % 4 IN (0, 2) AND internal_id % 5 > 0 AND internal_id % 7 > 0")
def gold_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of two loads of each listing the later, if its verdict is good and its region one of the fourteen."""
    rows = listings(spark, sf_dir)
    geo = rows.withColumn("ingested_at", F.lit(dt.date(2001, 1, 1))).unionByName(rows.withColumn("price", F.col("price") + 1).withColumn("ingested_at", F.lit(dt.date(2001, 1, 2))))
    subset = rows.select("internal_id", F.expr("CASE internal_id % 4 WHEN 0 THEN 'Zlínský kraj' WHEN 1 THEN 'Praha' WHEN 2 THEN 'Ústecký kraj' END").alias("norm_district"), "norm_okres", "norm_city", "norm_city_part", "norm_street", F.expr("internal_id % 5 > 0").alias("geo_ok"), F.expr("internal_id % 7 = 0").alias("not_true"))
    return gold.latest_listings(geo, subset).select("internal_id", "norm_district", "norm_city", "price")


@query(f"WITH {LISTINGS} SELECT internal_id, object_id, added_date::VARCHAR AS event_date, 'up' AS event_type, 10.0::DOUBLE AS diff_abs, 10.0::DOUBLE AS diff_pct, category_name FROM listings WHERE internal_id % 2 = 0")
def price_event_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = listings(spark, sf_dir)
    prices = rows.filter("internal_id % 2 = 0").select("internal_id", F.col("added_date").alias("change_date"), F.lit(100).cast("decimal(12,2)").alias("old_price"), F.lit(110).cast("decimal(12,2)").alias("new_price"), "source_id")
    return bi.price_events(spark, prices, rows).select("internal_id", "object_id", *_text("event_date"), "event_type", "diff_abs", "diff_pct", "category_name")


# ---------------------------------------------------------------- gates, guards, changes


@query("""WITH n AS (SELECT (SELECT count(*) FROM orders) AS o, (SELECT count(*) FROM customer) AS c, (SELECT count(*) FROM lineitem) AS l, (SELECT count(DISTINCT l_orderkey) FROM lineitem) AS dl,
 (SELECT count(*) FILTER (WHERE o_orderdate < TIMESTAMP '1995-01-01') FROM orders) AS old, (SELECT count(*) FILTER (WHERE o_orderdate >= TIMESTAMP '1995-01-01') FROM orders) AS young, (SELECT sum(k) FROM (SELECT count(*) AS k FROM orders WHERE o_orderstatus IN ('F', 'O') GROUP BY o_orderstatus)) AS two,
 (SELECT max(o_orderdate) FROM orders WHERE o_orderkey % 2 = 0)::DATE AS even, (SELECT max(o_orderdate) FROM orders WHERE o_orderkey % 2 = 1)::DATE AS odd, (SELECT max(o_orderdate) FROM orders)::DATE AS last, (SELECT min(o_orderdate) FROM orders)::DATE AS first,
 (SELECT count(*) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)) AS fk, (SELECT count(*) FROM orders WHERE o_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'O') AND o_orderstatus = 'F') AS both_in, (SELECT count(*) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 9 > 0)) AS fk9,
 (SELECT count(*) FROM orders WHERE o_orderkey IS NULL OR o_custkey IS NULL) AS nulls, (SELECT count(*) FROM orders WHERE o_orderstatus = 'F' OR o_orderstatus IS NULL) AS nulls_f, (SELECT count(*) = count(DISTINCT o_orderkey) FROM orders) AS uo)
SELECT unnest(['dates agree', 'dates differ', 'customers not more than orders', 'orders not more than customers', 'drift of 100', 'drift of orders with lines', 'sum over statuses', 'lines are orders', 'mass balance', 'order key', 'line key', 'customers known', 'most customers known', 'status exclusive', 'no nulls', 'nulls']) AS label,
 unnest([even = last AND odd = last, first = last, c <= o, o <= c, abs(o - c) <= 100, abs(o - dl) <= 50, two = o, l = o, old + young = o, uo, l = dl, fk = 0, fk9 = 0, both_in = 0, nulls = 0, nulls_f = 0]) AS ok FROM n""")
def quality_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = {n: table(spark, sf_dir, n) for n in ("orders", "customer", "lineitem")}
    n = {k: df.count() for k, df in t.items()}
    o = t["orders"]
    known = t["customer"].select(F.col("c_custkey").alias("o_custkey"))
    day, young = F.col("o_orderdate").cast("date"), F.col("o_orderdate") >= F.lit("1995-01-01").cast("timestamp_ntz")
    f = o.agg(F.max(day).alias("last"), F.min(day).alias("first"), F.max(F.when(F.col("o_orderkey") % 2 == 0, day)).alias("even"), F.max(F.when(F.col("o_orderkey") % 2 == 1, day)).alias("odd"), F.count_if(young).alias("young"), F.count_if(~young).alias("old"), F.count_if(F.col("o_orderstatus") == "F").alias("f"), F.count_if(F.col("o_orderstatus") == "O").alias("o")).first()
    with_lines = t["lineitem"].select("l_orderkey").distinct().count()
    checks = {
        "dates agree": quality.same_snapshot_date({"even": f["even"], "odd": f["odd"], "none": None}, f["last"]), "dates differ": quality.same_snapshot_date({"first": f["first"], "last": f["last"]}, f["last"]),
        "customers not more than orders": quality.not_more("rows", n["customer"], n["orders"]), "orders not more than customers": quality.not_more("rows", n["orders"], n["customer"]),
        "drift of 100": quality.drift("rows", n["orders"], n["customer"], 100), "drift of orders with lines": quality.drift("rows", n["orders"], with_lines, 50),
        "sum over statuses": quality.equal_counts("rows", f["f"] + f["o"], n["orders"]), "lines are orders": quality.equal_counts("rows", n["lineitem"], n["orders"]), "mass balance": quality.mass_balance(f["old"], f["young"], n["orders"]),
        "order key": quality.unique_key(o, ["o_orderkey"]), "line key": quality.unique_key(t["lineitem"], ["l_orderkey"]), "customers known": quality.covered(o, known, ["o_custkey"]), "most customers known": quality.covered(o, known.filter("o_custkey % 9 > 0"), ["o_custkey"]),
        "status exclusive": quality.exclusive(o.filter("o_orderstatus = 'F'"), o.filter("o_orderstatus = 'O'"), ["o_custkey"]), "no nulls": quality.no_nulls(o, ["o_orderkey", "o_custkey"]), "nulls": quality.no_nulls(o.select(F.nullif("o_orderstatus", F.lit("F")).alias("s")), ["s"]),
    }
    return spark.createDataFrame([(k, c.ok) for k, c in checks.items()], "label string, ok boolean")


@query("""WITH c AS (SELECT o_orderkey, o_custkey, o_totalprice, row_number() OVER (PARTITION BY o_custkey) > 1 AS again, o_custkey IN (SELECT c_custkey FROM customer WHERE c_custkey % 9 > 0) AS known FROM orders), l AS (SELECT count(*) AS n, sum(l_quantity) AS q, count(*) FILTER (WHERE l_shipdate IS NULL) AS nulls FROM lineitem),
f AS (SELECT count(*) AS n, count(*) FILTER (WHERE again) AS again, count(*) FILTER (WHERE NOT known) AS unknown, count(*) FILTER (WHERE o_totalprice <= 0) AS free, count(*) FILTER (WHERE o_orderkey IS NULL) AS nulls FROM c)
SELECT unnest(['orders.rows', 'orders.again', 'orders.unknown', 'orders.free', 'orders.nulls', 'lines.rows', 'lines.nulls', 'lines per order']) AS name, unnest([f.n > 0, f.again = 0, f.unknown = 0, f.free = 0, f.nulls = 0, l.n > 0, l.nulls = 0, l.n <= 7 * f.n]) AS ok,
 unnest([f.n, f.again, f.unknown, f.free, f.nulls, l.n, l.nulls, l.n // f.n])::BIGINT AS figure FROM f, l""")
def observed_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders and lines written with their checks, whose figures come out of the writes themselves."""
    o = quality.with_repeats(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice"), ["o_custkey"], "again")
    o = quality.with_parent(o, table(spark, sf_dir, "customer").filter("c_custkey % 9 > 0").select(F.col("c_custkey").alias("o_custkey")), ["o_custkey"], "known")
    none, some, warn = (lambda n: n == 0), (lambda n: n > 0), "warn"
    rows = quality.Observed("rows", F.count(F.lit(1)), some)
    orders = [rows, quality.Observed("again", F.count_if("again"), none, warn), quality.Observed("unknown", F.count_if(~F.col("known")), none, warn), quality.Observed("free", F.count_if(F.col("o_totalprice") <= 0), none, warn), quality.Observed("nulls", quality.null_keys("o_orderkey"), none)]
    lines = [rows, quality.Observed("nulls", quality.null_keys("l_shipdate"), none, warn)]

    def across(f: dict) -> list[quality.CheckResult]:
        return [quality.CheckResult("lines per order", f["lines"]["rows"] <= 7 * f["orders"]["rows"], "warn", {"figure": f["lines"]["rows"] // f["orders"]["rows"]})]

    db = Database(spark, _folder(spark, "observed"))
    found = quality.publish_observed(db, {"orders": (o, orders, ["again", "known"]), "lines": (table(spark, sf_dir, "lineitem"), lines, [])}, across)
    return spark.createDataFrame([(c.name, c.ok, c.detail["figure"]) for c in found], "name string, ok boolean, figure long")


@query(f"""WITH {LISTINGS}, x AS (SELECT internal_id, lower(trim(deal_type)) IN ('prodej', 'rent', 'aukce') AS known FROM listings)
SELECT 'objects_in_facts' AS name, (SELECT count(DISTINCT internal_id) FROM listings) = (SELECT count(DISTINCT internal_id) FROM x) AS ok UNION ALL SELECT 'no_unknown_deals', (SELECT count(*) FROM x WHERE NOT known) = 0 UNION ALL SELECT 'splits_sum_up', (SELECT count(*) FROM x WHERE known) = (SELECT count(*) FROM listings) - (SELECT count(*) FROM x WHERE NOT known)""")
def publish_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = listings(spark, sf_dir).withColumn("object_id", F.col("internal_id"))
    geo = bi.dim_geo(rows)
    active, closed = bi.fact(rows, geo, False), bi.fact(rows, geo, True)
    splits = bi.both_facts(active, closed).filter(F.col("deal_type").isin(*D.DEALS))
    return spark.createDataFrame([(c.name, c.ok) for c in quality.publish_gate(bi.dim_object(rows.withColumns({c: F.lit(None).cast("double") for c in ("longitude", "latitude")})), active, closed, splits)], "name string, ok boolean")


@query("SELECT c_custkey, 'column' AS guard FROM customer WHERE c_custkey % 10 = 0 UNION ALL SELECT c_custkey, 'append' FROM customer WHERE c_custkey % 10 = 0 OR c_custkey % 10 = 3")
def guard_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes of a column outside the allowed ones, and rows that an append-only table lost."""
    old = table(spark, sf_dir, "customer").select("c_custkey", "c_name", F.col("c_mktsegment").alias("agent_name"))
    new = old.select("c_custkey", F.expr("CASE WHEN c_custkey % 10 = 0 THEN 'x' ELSE c_name END").alias("c_name"), F.expr("CASE WHEN c_custkey % 10 = 3 THEN 'y' ELSE agent_name END").alias("agent_name"))
    wrong = R.guard_whitelist(old, new, ["c_custkey"], ["agent_name"]).select("c_custkey", F.lit("column").alias("guard"))
    return wrong.unionByName(R.guard_append_only(old, new).select("c_custkey", F.lit("append").alias("guard")))


@query("WITH o AS (SELECT *, (row_number() OVER (ORDER BY ts, event_id) - 1) // 300 AS chunk FROM events WHERE ts < TIMESTAMP '2024-01-10') SELECT chunk::BIGINT AS chunk, count(*) AS rows, min(ts)::VARCHAR AS first_ts, max(ts)::VARCHAR AS last_ts FROM o GROUP BY chunk")
def delete_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = R.delete_plan(table(spark, sf_dir, "events"), "ts", F.lit(dt.datetime(2024, 1, 10)).cast("timestamp_ntz"), [F.col("event_id")], 300)
    return plan.select("chunk", "rows", *_text("first_ts", "last_ts"))


@query("WITH b AS (SELECT CASE n_nationkey % 5 WHEN 0 THEN 'jihocesky kraj' WHEN 1 THEN 'Vysočina' WHEN 2 THEN n_name END AS v, CASE n_nationkey % 5 WHEN 0 THEN 'Jihočeský kraj' WHEN 1 THEN 'Kraj Vysočina' WHEN 2 THEN lower(n_name) END AS w FROM nation), x AS (SELECT v AS value, count(*) AS before, 0 AS after FROM b GROUP BY 1 UNION ALL SELECT w, 0, count(*) FROM b GROUP BY 1) SELECT value, sum(before)::BIGINT AS before, sum(after)::BIGINT AS after FROM x GROUP BY value")
def region_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often each region's name stands before and after it is made canonical: nothing is changed."""
    before = table(spark, sf_dir, "nation").select(F.expr("CASE n_nationkey % 5 WHEN 0 THEN 'jihocesky kraj' WHEN 1 THEN 'Vysočina' WHEN 2 THEN n_name END").alias("region"))
    return R.value_preview(before, before.select(D.canonical_region(F.col("region")).alias("region")), "region")


@query("""SELECT v.*, CASE "column" WHEN 'o_orderkey' THEN k WHEN 'o_totalprice' THEN p WHEN 'o_orderstatus' THEN s ELSE 0 END AS filled, CASE "column" WHEN 'o_orderkey' THEN k WHEN 'o_totalprice' THEN p WHEN 'o_orderstatus' THEN n ELSE 0 END AS fitting FROM (VALUES ('o_orderkey', 'bigint', 'bigint', true, true, false), ('o_totalprice', 'double', 'double', true, true, false), ('o_orderstatus', 'string', 'bigint', true, false, false), ('missing', NULL, 'string', false, false, false)) v("column", type, expected, present, matches, all_match),
(SELECT count(o_orderkey) AS k, count(o_totalprice) AS p, count(o_orderstatus) AS s, count(TRY_CAST(o_orderstatus AS BIGINT)) AS n FROM orders)""")
def column_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.column_facts(R.require_columns(table(spark, sf_dir, "orders"), ["o_orderkey"]), {"o_orderkey": "bigint", "o_totalprice": "double", "o_orderstatus": "bigint", "missing": "string"})


@query("SELECT c_custkey::VARCHAR AS k, c_name AS v, NULL::DOUBLE AS missing FROM customer UNION ALL SELECT s_suppkey::VARCHAR, s_name, NULL FROM supplier")
def conformed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two tables as text columns, then in a given schema: what both lack is null, what the schema lacks goes."""
    a = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("v"), F.lit(1).alias("x"), F.lit(1).alias("only_a"))
    b = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("k"), F.col("s_name").alias("v"), F.lit("b").alias("x"))
    rows = R.union_as_text(R.common_columns(a, b), a, b)
    return R.conform(rows, T.StructType([T.StructField("k", T.StringType()), T.StructField("v", T.StringType()), T.StructField("missing", T.DoubleType())]))


@query(r"""WITH s AS (SELECT c_custkey AS k, c_custkey % 5 AS j FROM customer) SELECT k, CASE j WHEN 0 THEN 'Zluty kun' WHEN 1 THEN 'Nguyen e' ELSE 'o' END AS plain, CASE j WHEN 0 THEN 'Praha 5' WHEN 1 THEN 'Praha 10' ELSE 'Brno' END AS label, 'http://x/' || k::VARCHAR AS url, CASE j WHEN 0 THEN '.png' WHEN 1 THEN '.webp' ELSE '.jpg' END AS ext,
CASE j WHEN 0 THEN 'ab' END AS key, CASE j WHEN 1 THEN '2024-02-29' END AS day, CASE j WHEN 0 THEN 4 ELSE 1 END::INTEGER AS words, '2001-07-01' AS month_start, CASE j WHEN 0 THEN 'last' END AS widest FROM s""")
def text_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    j = F.col("c_custkey") % 5
    case = lambda a, b, c: F.when(j == 0, a).when(j == 1, b).otherwise(c)
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("k"), X.strip_marks(case("Žlutý kůň", "Nguyễn ė", "ö")).alias("plain"), X.capital_label(case("praha-5 Smíchov", "PRAHA 10", " Brno ")).alias("label"), X.url_without_query(F.concat(F.lit("http://x/"), F.col("c_custkey").cast("string"), case("?a=b", "#c?d", ""))).alias("url"),
        X.image_extension(case("image/png", "image/webp; q", "text")).alias("ext"), X.text_key(case(" AB ", " ", F.lit(None))).alias("key"), X.to_date(case("2024-02-30", "2024-02-29", "x")).cast("string").alias("day"), X.word_count(case(" a b  c d ", "a", "b")).cast("int").alias("words"),
        X.previous_month_start(F.lit(AS_OF)).cast("string").alias("month_start"), X.address_part_of_widest(case("a, b, last", "a", "a,b"), 1, F.lit(3)).alias("widest"),
    )


# ---------------------------------------------------------------- images


@query("""SELECT c_custkey AS site_id, 'sr' AS source, CASE WHEN c_custkey % 3 = 1 THEN '["http://i/a.PNG?x=1"]' ELSE '["http://i/a.PNG?x=1","http://i/b"]' END AS urls, CASE WHEN c_custkey % 3 = 1 THEN '["sr_' || c_custkey::VARCHAR || '_1.png"]' ELSE '["sr_' || c_custkey::VARCHAR || '_1.png","sr_' || c_custkey::VARCHAR || '_2.jpg"]' END AS filenames FROM customer WHERE c_custkey % 3 > 0 AND c_custkey % 7 > 0""")
def download_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a download of the listings without a log entry would log."""
    rows = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("site_id"), F.lit("sr").alias("source"), F.expr("""CASE c_custkey % 3 WHEN 0 THEN '[]' WHEN 1 THEN '["http://i/a.PNG?x=1"]' ELSE '[{"url": "http://i/a.PNG?x=1"}, {"url": "http://i/b"}]' END""").alias("images"))
    return snapshots.download_log(snapshots.lacking_downloads(rows, rows.filter("site_id % 7 = 0")))


@query("SELECT '/img/a/' || c_custkey::VARCHAR || '.jpg' AS path FROM customer WHERE c_custkey % 4 = 0 AND c_custkey % 3 > 0")
def deletable_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hashed files inside the image folder; paths out of it are never deleted."""
    path = F.expr("CASE c_custkey % 4 WHEN 0 THEN concat('/img/a/', c_custkey, '.jpg') WHEN 1 THEN concat('/img/../etc/', c_custkey) WHEN 2 THEN concat('/imgs/', c_custkey) ELSE concat('/img/b/..', '/../', c_custkey) END")
    rows = table(spark, sf_dir, "customer").select("c_custkey", path.alias("path"))
    return snapshots.deletable(rows.union(rows), rows.filter("c_custkey % 3 > 0"), "/img")


# ---------------------------------------------------------------- storage, runner, streams


_ROW = T.StructType([T.StructField("k", T.LongType()), T.StructField("load", T.StringType())])


@query("SELECT o_orderkey AS k, CASE WHEN o_orderkey % 3 = 0 THEN 'first' WHEN o_orderkey % 3 = 1 THEN 'appended' ELSE 'absent' END AS load FROM orders")
def stored_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table made by a gated publication, an append, an append of what is absent, and a dry run that writes nothing."""
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"))
    load = lambda df, name: df.withColumn("load", F.lit(name))
    db = Database(spark, _folder(spark, "db"))
    db.publish({"t": load(rows.filter("k % 3 = 0"), "first")}, gate=lambda made: [quality.unique_key(made["t"], ["k"])])
    db.append("t", load(rows.filter("k % 3 = 1"), "appended"))
    db.append_absent("t", load(rows, "absent"), ["k"], _ROW)
    db.dry_run = True
    db.replace("t", load(rows.limit(0), "never"))
    return db.read("t").select("k", "load")


@query("""WITH o AS (SELECT count(*) AS n, count(DISTINCT o_custkey) AS c FROM orders) SELECT 'bronze' AS layer, 'load' AS step, 'ok' AS status, true AS success, n AS rows_in FROM o UNION ALL SELECT 'bronze', 'broken', 'error', false, NULL UNION ALL SELECT 'silver', 'next', 'ok', true, c FROM o
UNION ALL SELECT 'total', 'max', 'roll-up', true, greatest(n, c) FROM o UNION ALL SELECT 'total', 'sum', 'roll-up', true, n + c FROM o UNION ALL SELECT 'total', 'last json', 'roll-up', true, n FROM o""")
def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Steps over orders, of which one fails, their log, and metrics across them."""
    db = Database(spark, _folder(spark, "log"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")

    def load(_: object) -> dict:
        db.replace("bronze", orders)
        return {"rows_in": db.read("bronze").count()}

    def broken(_: object) -> dict:
        return {"rows_in": R.require_columns(db.read("bronze"), ["missing"]).count()}

    def following() -> dict:
        most = db.read("bronze").filter("o_custkey IS NOT NULL").groupBy("o_custkey").agg(F.max("o_totalprice").alias("most"))
        db.replace("silver", most)
        return {"rows_in": db.read("silver").count()}

    steps = [runner.Step("bronze", "load", load, timeout_s=3600), runner.Step("bronze", "broken", broken), runner.Step("silver", "next", lambda _: runner.retry(2, 0.0, following), alias="n"), runner.Step("silver", "monthly", lambda _: {}, monthly=True), runner.Step("silver", "off", lambda _: {}, enabled=False)]
    done = runner.run_steps(None, runner.select_steps(steps, today=dt.date(2024, 1, 2)), fail_fast=False, spark=spark)
    runner.log_run(spark, db, done)
    rolled = [("total", how, "roll-up", True, runner.roll_up(done, {"rows_in": how})["rows_in"]) for how in ("max", "sum")]
    found = runner.find_metric(runner.last_json(f"noise\n{done[0].to_json()}\nmore"), ["rows_in"])
    extra = spark.createDataFrame([*rolled, ("total", "last json", "roll-up", True, found)], "layer string, step string, status string, success boolean, rows_in bigint")
    return db.read("ops_daily_job").select("layer", "step", "status", "success", "rows_in").unionByName(extra)


def _event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events")
    return spark.readStream.schema(rows.schema).parquet(f"{sf_dir}/events.parquet*").select("event_id", "user_id", "event_type", F.col("ts").cast("timestamp").alias("ts"), (F.col("event_id") % 500).alias("k"))


@query("SELECT user_id % 40 AS k, event_type, count(DISTINCT (user_id % 40, event_type)) AS n FROM events GROUP BY 1, 2")
def stream_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event key once, as a stream with a watermark."""
    stream = _event_stream(spark, sf_dir).withColumn("k", F.col("user_id") % 40)
    return streams.drained(streams.distinct_events(stream, ["k", "event_type"], "ts", "400 days").select("k", "event_type")).groupBy("k", "event_type").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT strftime(date_trunc('day', ts), '%Y-%m-%d') AS day, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def stream_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = streams.drained(streams.windowed_counts(_event_stream(spark, sf_dir), "ts", "1 day", ["event_type"]), "update", ["window", "event_type"])
    return rows.select(F.date_format("window.start", "yyyy-MM-dd").alias("day"), "event_type", "n")


@query("SELECT k, min(event_id) AS event_id, 1::BIGINT AS n FROM (SELECT *, event_id % 500 AS k FROM events) GROUP BY k")
def stream_unprocessed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New keys against a history, twice: the second run of the same batch finds its work done."""
    db, schema = Database(spark, _folder(spark, "stream")), T.StructType([T.StructField("event_id", T.LongType()), T.StructField("k", T.LongType())])
    for _ in range(2):
        work = lambda new, old: new.join(old.select("k"), "k", "left_anti").select("k", "event_id")
        streams.unprocessed_stream(_event_stream(spark, sf_dir).select("event_id", "k"), db, "history", schema, ["k"], work, "found", _folder(spark, "checkpoint")).awaitTermination()
    return db.read("found").groupBy("k").agg(F.min("event_id").alias("event_id"), F.count(F.lit(1)).alias("n"))


@query("WITH o AS (SELECT o_orderkey AS id, o_totalprice AS price FROM orders) SELECT id, price, CASE WHEN id % 10 = 0 AND id % 7 > 0 THEN '2024-01-02' ELSE '2024-01-01' END AS added_date, CASE WHEN id % 7 = 0 AND id % 10 > 0 THEN '2024-01-02' END AS archived_date, id % 7 > 0 AS available FROM o WHERE NOT (id % 10 = 0 AND id % 7 = 0)")
def stream_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two days' snapshots as a stream into the state table."""
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("price"))
    days = [o.filter("id % 10 > 0").withColumn("snapshot_date", F.lit(dt.date(2024, 1, 1))), o.filter("id % 7 > 0").withColumn("snapshot_date", F.lit(dt.date(2024, 1, 2)))]
    folder, db = _folder(spark, "days"), Database(spark, _folder(spark, "state"))
    for n, day in enumerate(days):
        day.write.parquet(f"{folder}/{n}")
    state = T.StructType([T.StructField("id", T.LongType()), T.StructField("price", T.DoubleType()), T.StructField("added_date", T.DateType()), T.StructField("archived_date", T.DateType()), T.StructField("available", T.BooleanType())])
    streams.sync_stream(streams.snapshot_stream(spark, f"{folder}/*", days[0].schema, 1000), db, "state", state, _folder(spark, "checkpoint")).awaitTermination()
    return db.read("state").select("id", "price", *_text("added_date", "archived_date"), "available")


# ---------------------------------------------------------------- state and components that follow what is new


def _synced(state: str, curr: str, prev: str, day: str) -> str:
    """SQL of a state after a snapshot."""
    return f"""SELECT coalesce(s.id, c.id) AS id, CASE WHEN s.id IS NULL THEN c.price ELSE s.price END AS price, CASE WHEN s.id IS NULL THEN DATE '{day}' ELSE s.added_date END AS added_date,
CASE WHEN s.id IS NULL OR (NOT s.available AND c.id IS NOT NULL) THEN NULL WHEN s.available AND c.id IS NULL AND p.id IS NOT NULL THEN DATE '{day}' ELSE s.archived_date END AS archived_date,
CASE WHEN s.id IS NULL OR (NOT s.available AND c.id IS NOT NULL) THEN true WHEN s.available AND c.id IS NULL AND p.id IS NOT NULL THEN false ELSE s.available END AS available
FROM {state} s FULL JOIN {curr} c ON s.id = c.id LEFT JOIN {prev} p ON p.id = coalesce(s.id, c.id)"""


@query(f"""WITH {_SNAP}, third AS (SELECT o_orderkey AS id, o_totalprice AS price FROM orders WHERE o_orderkey % 11 <> 0), one AS ({_synced("state", "curr", "prev", "2001-08-01")}), two AS ({_synced("one", "third", "curr", "2001-08-02")})
SELECT id, price, added_date::VARCHAR AS added_date, archived_date::VARCHAR AS archived_date, available FROM two""")
def bucketed_sync_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two days of snapshots merged into a bucketed state, of which no row is shuffled; the base is folded in between."""
    prev, curr, state = _snapshots(spark, sf_dir)
    third = table(spark, sf_dir, "orders").filter("o_orderkey % 11 <> 0").select(F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("price"))
    kept = BucketedState(spark, f"state_{uuid.uuid4().hex}")
    kept.create(state)
    kept.sync(curr, F.lit(AS_OF), prev)
    kept.fold()
    kept.sync(third, F.lit(AS_OF + dt.timedelta(days=1)), curr)
    return kept.read().select("id", "price", *_text("added_date", "archived_date"), "available")


@query(f"WITH {_CHAIN} SELECT id, root FROM roots")
def components_by_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of edges that come in on four days, each day's joined to the labels of the days before."""
    edges = _edges(spark, sf_dir)
    labels = graph.connected_components(edges.filter("a % 4 = 0"))
    for day in (1, 2, 3):
        labels = cut_lineage(graph.extend_components(labels, edges.filter(f"a % 4 = {day}")), "labels")
    return labels


@query("SELECT c_custkey AS internal_id, CASE WHEN c_custkey % 10 > 0 THEN upper(c_name) END AS answer, c_custkey % 10 > 0 AS received FROM customer")
def address_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests sent in batches, half of them twice; a service answers batch by batch in two rounds and leaves some requests
    open; the answers come in by a stream of offsets and are held against what was sent."""
    rows = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("internal_id"), F.col("c_name").alias("prompt"))
    folder, db = _folder(spark, "addresses"), Database(spark, _folder(spark, "answers"))
    for part in (rows.filter("internal_id % 2 = 0"), rows):
        batches.send(part, folder, 100)
        batches.answer(spark, folder, lambda asked: [q["prompt"].upper() if q["internal_id"] % 10 else None for q in asked])
        batches.receive(db, folder, "answers", f"{db.root}/checkpoint")
    found = db.read("answers", T.StructType.fromDDL(batches.ANSWERS))
    both = batches.sent_requests(spark, folder).join(found.withColumn("received", F.lit(True)), ["batch", "internal_id"], "full_outer")
    return both.select("internal_id", "answer", F.coalesce("received", F.lit(False)).alias("received"))


# ---------------------------------------------------------------- audits by digests, drift of documents


@query(f"""WITH {_COPY}, s AS (SELECT DISTINCT o_orderkey FROM orders), t AS (SELECT DISTINCT o_orderkey FROM copy), j AS (SELECT o.*, c.o_orderstatus AS st, c.o_totalprice AS pr FROM orders o JOIN copy c USING (o_orderkey))
SELECT (SELECT count(*) FROM s WHERE o_orderkey NOT IN (SELECT o_orderkey FROM t)) AS missing, (SELECT count(*) FROM t WHERE o_orderkey NOT IN (SELECT o_orderkey FROM s)) AS extra, sum((o_orderstatus IS DISTINCT FROM st)::INT)::BIGINT AS o_orderstatus, sum((o_totalprice IS DISTINCT FROM pr)::INT)::BIGINT AS o_totalprice FROM j""")
def digest_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.digest_audit(*_copy(spark, sf_dir), ["o_orderkey"], ["o_orderstatus", "o_totalprice"]).select("missing", "extra", "o_orderstatus", "o_totalprice")


_DOC = "CASE WHEN day(ts) % 5 = 0 THEN '{\"k\": \"' || event_type || '\", \"e\": null}' WHEN day(ts) % 3 = 0 THEN '{\"k\": 1, \"j\": ' || event_id || ', \"e\": true}' WHEN event_id % 7 = 0 THEN '{\"k\": ' WHEN event_id % 11 = 0 THEN '[1]' ELSE props END"


@query(f"""WITH d AS (SELECT ts::DATE::VARCHAR AS day, {_DOC.replace("|| event_id ||", "|| event_id::VARCHAR ||")} AS doc FROM events), v AS (SELECT day, doc::JSON AS doc FROM d WHERE json_valid(doc)), o AS (SELECT * FROM v WHERE json_type(doc) = 'OBJECT'),
k AS (SELECT day, unnest(json_keys(doc)) AS key, doc FROM o), e AS (SELECT day, key, CASE json_type(doc -> key) WHEN 'NULL' THEN NULL WHEN 'VARCHAR' THEN 'text' WHEN 'BOOLEAN' THEN 'bool' ELSE 'number' END AS kind FROM k),
t AS (SELECT day, key, string_agg(DISTINCT kind, ',' ORDER BY kind) AS types FROM e GROUP BY day, key), p AS (SELECT day, lag(day) OVER (ORDER BY day) AS previous FROM (SELECT DISTINCT day FROM t)),
n AS (SELECT p.day, t.key, t.types FROM p JOIN t ON t.day = p.day WHERE p.previous IS NOT NULL), b AS (SELECT p.day, t.key, t.types FROM p JOIN t ON t.day = p.previous)
SELECT coalesce(n.day, b.day) AS day, coalesce(n.key, b.key) AS key, CASE WHEN b.key IS NULL THEN 'added' WHEN n.key IS NULL THEN 'lost' ELSE 'retyped' END AS change FROM n FULL JOIN b ON n.day = b.day AND n.key = b.key WHERE b.key IS NULL OR n.key IS NULL OR n.types <> b.types""")
def json_key_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys that come, go or change their type from one day of documents to the next."""
    events = table(spark, sf_dir, "events").select(F.date_format("ts", "yyyy-MM-dd").alias("day"), F.expr(_DOC).alias("doc"))
    return snapshots.key_drift(events, "doc", "day").select("day", "key", "change")


@query("""WITH d AS (SELECT c_custkey AS id, k AS k, c_custkey % (k + 2) <> 0 AS here FROM customer, generate_series(1, 4) g(k)),
w AS (SELECT *, lag(here) OVER o AS before, coalesce(bool_or(here) OVER (PARTITION BY id ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS known FROM d WINDOW o AS (PARTITION BY id ORDER BY k))
SELECT id, '2024-01-0' || k::VARCHAR AS day, CASE WHEN here AND NOT known THEN 'new' WHEN here THEN 'reactivated' ELSE 'archived' END AS action FROM w WHERE (here AND NOT coalesce(before, false)) OR (NOT here AND before)""")
def stream_keyed_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four days of customers as a stream, the second day after the third and the first twice, judged key by key."""
    c, folder = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id")), _folder(spark, "presence")
    day = lambda k: c.filter(F.col("id") % (k + 2) != 0).withColumn("day", F.lit(dt.date(2024, 1, k)))
    last = spark.range(1).select(F.lit(-1).cast("long").alias("id"), F.lit(dt.date(2024, 1, 7)).alias("day"))  # its day tells that the others are over
    files = spark.sparkContext.defaultParallelism  # of a day, all in one batch
    for n, rows in enumerate((day(1), day(3), day(2), day(1), day(4), last)):
        rows.repartition(files).write.parquet(f"{folder}/{n}")
    # A stream keeps the number of its state's partitions, each of which starts a task and a store in every batch.
    provider, partitions = "spark.sql.streaming.stateStore.providerClass", "spark.sql.shuffle.partitions"
    before = {name: spark.conf.get(name) for name in (provider, partitions)}
    keyed.use_rocksdb(spark)
    spark.conf.set(partitions, str(min(int(before[partitions]), files)))
    try:
        stream = spark.readStream.schema(last.schema).option("maxFilesPerTrigger", files).parquet(f"{folder}/*")
        found = streams.drained(keyed.presence_changes(stream, "id", "day"))
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    return found.filter("id >= 0 and day <= DATE '2024-01-04'").select("id", *_text("day"), "action")
