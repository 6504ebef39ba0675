"""Expressions with the listing domain's rules."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import first_integer, plain_lower, text_key

# Deal names and codes, the 14 regions, and keys that stand for them.
DEALS = ("prodej", "pronajem", "drazba")
BUCKETS = ("byty", "domy", "pozemky", "komercni", "ostatni")
REGIONS = {
    "hlavni mesto praha": "Hlavní město Praha",
    "jihocesky kraj": "Jihočeský kraj",
    "jihomoravsky kraj": "Jihomoravský kraj",
    "karlovarsky kraj": "Karlovarský kraj",
    "kralovehradecky kraj": "Královéhradecký kraj",
    "liberecky kraj": "Liberecký kraj",
    "moravskoslezsky kraj": "Moravskoslezský kraj",
    "olomoucky kraj": "Olomoucký kraj",
    "pardubicky kraj": "Pardubický kraj",
    "plzensky kraj": "Plzeňský kraj",
    "stredocesky kraj": "Středočeský kraj",
    "ustecky kraj": "Ústecký kraj",
    "zlinsky kraj": "Zlínský kraj",
    "vysocina": "Kraj Vysočina",
    "kraj vysocina": "Kraj Vysočina",
}
CAPITAL, NEIGHBOUR = "Hlavní město Praha", "Středočeský kraj"
LAND_CATEGORIES = (3, 5, 90, 99)
PRICE_RATIO, AREA_SHARE, AREA_LEAST = 1.20, 0.05, 5.0
OBJECT_ID_START = 800_000_000
PRICE_LOW, PRICE_HIGH = 1000.0, 1e10


def literal_map(values: dict) -> Column:
    return F.create_map(*[F.lit(x) for kv in values.items() for x in kv])


def map_or(c: Column, values: dict, default=None) -> Column:
    """Constant lookup with a default for what is not listed."""
    found = F.try_element_at(literal_map(values), c)
    return found if default is None else F.coalesce(found, F.lit(default))


def deal_class(deal: Column, name: Column) -> Column:
    """struct(deal_type, deal_type_value): sale 1, rent 2, auction 3, unknown 0; the first rule that holds decides."""
    d, n = F.coalesce(plain_lower(deal), F.lit("")), F.coalesce(plain_lower(name), F.lit(""))
    raw = F.concat_ws("\n", F.lower(deal), F.lower(name))
    sale = d.startswith("prodej") | d.isin("sale", "prodaja", "продажа") | n.rlike("^(prodej|sale|продажа)")
    rent = d.startswith("pronajem") | d.isin("najem", "najmem", "аренда", "arenda", "rent") | n.rlike("^(najem|аренда|rent)") | n.rlike("pronajem|pronajmu") | raw.contains("nájem")
    auction = d.startswith("drazb") | d.isin("aukce", "аукцион") | n.rlike("drazb|aukce|аукцион")

    def made(label: str, code: int) -> Column:
        return F.struct(F.lit(label).alias("deal_type"), F.lit(code).alias("deal_type_value"))

    return F.when(sale, made("Prodej", 1)).when(rent, made("Pronájem", 2)).when(auction, made("Dražba", 3)).otherwise(made("Neznámé", 0))


def deal_norm(c: Column) -> Column:
    x = F.lower(c)
    return F.when(x.isin("prodej", "sale", "sell"), "prodej").when(x.isin("pronajem", "pronájem", "rent", "rental", "lease"), "pronajem").when(x.isin("drazba", "dražba", "auction", "aukce"), "drazba").otherwise("ostatni")


def category_bucket(c: Column) -> Column:
    return F.when(c.ilike("byt%"), "byty").when(c.ilike("dom%"), "domy").when(c.ilike("pozem%"), "pozemky").when(c.ilike("komerc%"), "komercni").otherwise("ostatni")


def rooms_bucket(rooms: Column) -> Column:
    n = first_integer(F.lower(F.trim(rooms)))
    return F.when(n.isNull(), "Atypický").when(n <= 1, "1kk").when(n == 2, "2kk").when(n == 3, "3kk").when(n == 4, "4kk").otherwise("5kk+")


def area_bucket(a: Column) -> Column:
    edges = (30, "<30"), (40, "30-39"), (50, "40-49"), (60, "50-59"), (70, "60-69"), (90, "70-89"), (100, "90-99"), (120, "100-119"), (150, "120-149")
    out = F.when(~F.coalesce(a.between(10, 200), F.lit(False)), "excluded")
    for edge, label in edges:
        out = out.when(a < edge, label)
    return out.otherwise("150-200")


def canonical_region(c: Column) -> Column:
    """The region's name for any spelling of it; an unknown one stays in base form."""
    key = F.regexp_replace(plain_lower(F.replace(c, F.lit("-"), F.lit(" "))), r"\s+", " ")
    return F.coalesce(F.try_element_at(literal_map(REGIONS), key), key)


def price_check(a: Column, b: Column, ratio: float = PRICE_RATIO) -> Column:
    """struct(ok, hi, lo): prices that are missing or not positive pass without figures."""
    usable = F.coalesce((a > 0) & (b > 0), F.lit(False))
    hi, lo = F.when(usable, F.greatest(a, b)), F.when(usable, F.least(a, b))
    return F.struct((~usable | (hi / lo <= ratio)).alias("ok"), hi.alias("hi"), lo.alias("lo"))


def areas_close(a: Column, b: Column) -> Column:
    near = F.abs(a - b) <= F.greatest(F.lit(AREA_LEAST), F.greatest(a, b) * AREA_SHARE)
    return F.coalesce((a > 0) & (b > 0) & near, F.lit(False))


def area_bin(area: Column) -> Column:
    """A bin number such that areas_close() areas are in the same or in neighbouring bins; null for areas that are close to
    nothing. Up to the size at which the tolerance turns from an amount into a share, bins are of equal width, beyond it of
    equal ratio; a fiftieth of slack covers the turn."""
    area, turn = area.cast("double"), AREA_LEAST / AREA_SHARE
    ratio = -math.log1p(-AREA_SHARE)
    place = F.when(area <= turn, area / AREA_LEAST).otherwise(turn / AREA_LEAST + F.log(area / turn) / ratio)
    return F.when((area > 0) & ~F.isnan(area) & (area < 1e300), F.floor(place / 1.02).cast("long"))


def own_area(category: Column, build: Column, land: Column) -> Column:
    """The area that stands for a listing whose two areas are not both compared: land of land, else the built one."""
    return F.coalesce(F.when(F.coalesce(category.isin(*LAND_CATEGORIES), F.lit(False)), land).otherwise(build), land, build)


def own_mode(category: Column, build: Column, land: Column) -> Column:
    """Which of its areas own_area() is: build or land, null without any."""
    is_land = F.coalesce(category.isin(*LAND_CATEGORIES), F.lit(False))
    return F.when(land.isNotNull() & (is_land | build.isNull()), "land").when(build.isNotNull(), "build")


def area_check(cat1: Column, build1: Column, land1: Column, cat2: Column, build2: Column, land2: Column) -> Column:
    """struct(ok, mode, v1, v2): built areas first if all four are known, then land; else each listing's own kind."""
    none = F.lit(None).cast("double")

    def made(ok: Column, mode: Column, v1: Column, v2: Column) -> Column:
        return F.struct(ok.alias("ok"), mode.alias("mode"), v1.alias("v1"), v2.alias("v2"))

    def own(cat: Column, build: Column, land: Column) -> tuple[Column, Column]:
        is_land = F.coalesce(cat.isin(*LAND_CATEGORIES), F.lit(False))
        first, second = F.when(is_land, land).otherwise(build), F.when(is_land, build).otherwise(land)
        main, other = F.when(is_land, "land").otherwise("build"), F.when(is_land, "build").otherwise("land")
        return F.coalesce(first, second), F.when(first.isNotNull(), main).when(second.isNotNull(), other).otherwise("none")

    (v1, m1), (v2, m2) = own(cat1, build1, land1), own(cat2, build2, land2)
    all_known = build1.isNotNull() & land1.isNotNull() & build2.isNotNull() & land2.isNotNull()
    whole = F.when(areas_close(build1, build2), made(F.lit(True), F.lit("build"), build1, build2)).when(areas_close(land1, land2), made(F.lit(True), F.lit("land"), land1, land2)).otherwise(made(F.lit(False), F.lit("mixed"), none, none))
    some = F.when(v1.isNull() | v2.isNull(), made(F.lit(False), F.lit("none"), none, none)).otherwise(made(areas_close(v1, v2), F.when(m1 != m2, "mixed").otherwise(m1), v1, v2))
    return F.when(all_known, whole).otherwise(some)


def geo_level(pairs: list[tuple[Column, Column]]) -> Column:
    """lvl1 to lvl4 for equal street, part, city, county; null if any level is known on both sides and differs.

    pairs: (county, city, part, street), each of both listings."""
    return key_level([(text_key(a), text_key(b)) for a, b in pairs])


def key_level(keys: list[tuple[Column, Column]]) -> Column:
    """geo_level of columns that are text_key() already, so that pairs of rows compare what was made once a row."""
    differs = F.lit(False)
    for a, b in keys:
        differs = differs | F.coalesce(a != b, F.lit(False))
    out = F.when(differs, F.lit(None).cast("string"))
    for n, (a, b) in enumerate(reversed(keys), 1):
        out = out.when(a == b, f"lvl{n}")
    return out


def bad_geography(status: Column, district: Column) -> Column:
    """Known to be unresolved: the status is false and the district missing, blank or foreign."""
    return F.coalesce(~status, F.lit(False)) & (district.isNull() | (F.trim(district) == "") | (F.upper(F.trim(district)) == "NOT_CZ"))


def contradiction(archived: Column, available: Column) -> Column:
    return ~available.eqNullSafe(archived.isNull())


def price_per_m2(price: Column, area: Column) -> Column:
    return F.when(area.between(10, 200) & (price > 0), F.round(price.cast("decimal(18,2)") / F.nullif(area.cast("decimal(18,2)"), F.lit(0).cast("decimal(18,2)")), 0).cast("double"))


def price_rounded(price: Column) -> Column:
    d = price.cast("decimal(18,2)")
    return F.when(price < 100000, F.round(d, -3).cast("double")).otherwise(F.round(d, -4).cast("double"))
