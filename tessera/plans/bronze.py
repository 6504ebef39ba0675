"""Sources to canonical listings, price events, photos and sellers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..functions import text as X
from ..functions.domain import map_or
from ..operators.relational import conform, price_changes

# Source ids, and categories of the sources.
SREALITY, BEZREALITKY, IDNES = 1, 2, 3
IDNES_CATEGORY = {"apartments": 1, "houses": 2, "land": 3}
IDNES_NAME = {"apartments": "byt", "houses": "dum", "land": "pozemek"}
BEZ_CATEGORY = {"byt": 1, "dum": 2, "pozemek": 3}


def _listing(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    return conform(df.select(*[c.alias(k) for k, c in columns.items()]), schemas.LISTING)


def _common(source: int) -> dict[str, Column]:
    archived = X.to_date(F.col("archived_date"))
    return {"source_id": F.lit(source), "site_id": F.col("id").cast("string"), "added_date": X.to_date(F.col("added_date")), "archived_date": archived, "available": archived.isNull()}


def sreality_listing(state: DataFrame) -> DataFrame:
    same = {c: F.col(c) for c in ("category_value", "category_name", "name", "district", "city", "city_part", "street", "house_number", "longitude", "latitude") if c in state.columns}
    return _listing(state, _common(SREALITY) | same | {"deal_type": X.first_word(F.col("name")), "price": X.money(F.col("price_summary_czk").cast("string"))})


def idnes_listing(state: DataFrame) -> DataFrame:
    kind, name, address = F.lower("category_name"), F.col("name"), F.col("address")
    return _listing(state, _common(IDNES) | {
        "category_value": map_or(kind, IDNES_CATEGORY, 5), "category_name": map_or(kind, IDNES_NAME, "ostatni"), "name": name, "deal_type": X.first_word(name), "rooms": X.first_group(name, r"\b(\d+\+\w+)\b"),
        "price": X.money(F.col("price_czk").cast("string")), "street": X.address_part(address, 0), "city_part": X.address_part(address, 1), "city": X.address_part(address, -1), "district": X.blank_to_null(address),
    })


def bezrealitky_listing(state: DataFrame) -> DataFrame:
    alt, address = F.col("image_alt_text"), F.col("address")
    category = map_or(F.lower("estate_type"), BEZ_CATEGORY)
    square = r"([\d\.]+)\s*m²"
    part = X.address_part(address, -2)
    return _listing(state, _common(BEZREALITKY) | {
        "category_value": category, "category_name": F.col("estate_type"), "name": alt, "deal_type": F.lower(X.before(F.col("query_name"), "_")), "price": X.money(F.col("price").cast("string")),
        "rooms": X.disposition(F.col("disposition")), "area_build": F.when(category.isin(1, 2), X.area(X.nth_group(alt, square, 0))),
        "area_land": F.when(category == 2, X.area(X.nth_group(alt, square, 1))).when(category == 3, X.area(X.nth_group(alt, square, 0))),
        "street": X.address_part(address, 0), "city_part": part, "district": X.address_part(address, -1), "city": X.blank_to_null(X.before(part, "-")),
    })


def price_events(previous: DataFrame, current: DataFrame, day: Column, key: str = "id", value: str = "price") -> DataFrame:
    """Changes of cleaned prices between two snapshots, one row per event."""
    clean = lambda df: df.select(key, X.digits_price(F.col(value).cast("string")).alias(value))
    return price_changes(clean(previous), clean(current), day, key, value)


def sreality_sellers(snapshot: DataFrame) -> DataFrame:
    """Contacts with at least one known value."""
    s = snapshot.select(F.col("id").cast("string").alias("id"), X.blank_to_null(F.col("agent_name")).alias("agent_name"), X.phone(F.col("agent_phone")).alias("agent_phone"), F.lower(X.blank_to_null(F.col("agent_email"))).alias("agent_email"))
    return s.filter(F.coalesce("agent_name", "agent_phone", "agent_email").isNotNull()).dropDuplicates(["id"])


def parsed_sellers(records: DataFrame, info: str = "seller_info") -> DataFrame:
    return records.select(F.col("id").cast("string").alias("id"), X.contact(F.col(info)).alias("c")).select("id", "c.agent_name", "c.agent_phone", "c.agent_email")


def photos(snapshot: DataFrame) -> DataFrame:
    """(id, images): valid JSON lists only."""
    return snapshot.select(F.col("id").cast("string").alias("id"), F.col("images").cast("string").alias("images")).filter(F.try_parse_json("images").isNotNull()).dropDuplicates(["id"])
