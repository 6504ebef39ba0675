"""Fixed schemas of the pipeline's tables."""

from __future__ import annotations

from pyspark.sql import types as T


_TYPES = {"int": T.IntegerType(), "bigint": T.LongType(), "string": T.StringType(), "double": T.DoubleType(), "boolean": T.BooleanType(), "date": T.DateType(), "timestamp": T.TimestampType()}


def _type(name: str) -> T.DataType:
    if name.startswith("array<"):
        return T.ArrayType(_type(name[6:-1]))
    if name.startswith("decimal("):
        return T.DecimalType(*map(int, name[8:-1].split(",")))
    return _TYPES[name]


def _schema(text: str) -> T.StructType:
    """name type, name type, …: without a session, unlike the engine's own parser."""
    return T.StructType([T.StructField(*(n, _type(t))) for n, t in (f.split(" ") for f in text.split(", "))])


LISTING = _schema(
    "source_id int, site_id string, added_date date, archived_date date, available boolean, category_value bigint, category_name string, name string, deal_type string, rooms string, "
    "price double, area_build double, area_land double, district string, city string, city_part string, street string, house_number string, longitude double, latitude double"
)
PRICE_LOG = _schema("id string, old_price double, new_price double, change_date date")
SILVER_PRICE_LOG = _schema("id string, old_price decimal(38,10), new_price decimal(38,10), change_date date, source_id int, ingested_at timestamp")
SELLER = _schema("id string, agent_name string, agent_phone string, agent_email string")
REGISTRY = _schema("kraj string, nazev_obce string, nazev_casti_obce string, nazev_ulice string, region string, nazev_obvodu_prahy string")
SUBSET = _schema("internal_id bigint, norm_district string, norm_okres string, norm_city string, norm_city_part string, norm_street string, geo_ok boolean, not_true boolean")
OBJECT_MAP = _schema("canonical_internal_id bigint, object_id bigint")
GOLD_PRICE = _schema("internal_id bigint, change_date date, old_price decimal(12,2), new_price decimal(12,2), source_id int")
CLUSTER = _schema("canonical_internal_id bigint, members_count int, member_internal_ids array<bigint>, site_ids array<string>, first_seen timestamp, last_seen timestamp, max_percentage decimal(5,2), edges_count int")
PRICE_EVENTS = _schema(
    "event_id bigint, object_id bigint, internal_id bigint, source_id int, event_date date, event_type string, old_price double, new_price double, diff_abs double, diff_pct double, "
    "geo_key bigint, deal_type string, category_name string, added_date date, archived_date date, created_at timestamp"
)
RUN_LOG = _schema("run_id string, run_date date, layer string, source string, step string, success boolean, status string, elapsed_s double, rows_in bigint, rows_out bigint, error string, details string, created_at timestamp")
