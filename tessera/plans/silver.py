"""Union of the sources, geography, price log, sellers, duplicates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import domain as D
from ..functions import text as X
from ..lineage import cut_lineage
from ..operators import fuzzy, graph, phash
from ..operators.relational import allocate_ids, band_pairs, pick_one, union_by_name


def canonical_union(existing: DataFrame, *sources: DataFrame) -> DataFrame:
    """New canonical rows of all sources: one per (source_id, site_id), the last given, without those that exist."""
    rows = union_by_name(*[s.withColumn("_n", F.lit(n)) for n, s in enumerate(sources)])
    rows = pick_one(rows, ["source_id", "site_id"], [F.desc("_n"), F.col("added_date").desc_nulls_last(), F.xxhash64(*[c for c in rows.columns if c != "_n"])]).drop("_n")
    rows = rows.withColumn("available", F.col("archived_date").isNull())
    return rows.join(existing.select("source_id", "site_id"), ["source_id", "site_id"], "left_anti").withColumn("ingested_at", F.current_timestamp())


def with_internal_ids(existing: DataFrame, new: DataFrame) -> DataFrame:
    """New rows with internal_id numbered on from the existing ones, by source and site id."""
    key = F.struct("source_id", "site_id")
    ids = allocate_ids(existing.select(key.alias("k"), "internal_id"), new.select(key.alias("k")), "k", "internal_id", 1)
    return new.join(ids.select("k.source_id", "k.site_id", "internal_id"), ["source_id", "site_id"])


def to_geo(summarized: DataFrame, geo: DataFrame, queue: DataFrame) -> DataFrame:
    """Rows for the geography table: neither there nor queued, with a price in range, their deal classified."""
    new = summarized.join(geo.select("internal_id"), "internal_id", "left_anti").join(queue.select("internal_id"), "internal_id", "left_anti")
    new = new.filter((F.col("price") > D.PRICE_LOW) & (F.col("price") < D.PRICE_HIGH))
    deal = D.deal_class(F.col("deal_type"), F.col("name"))
    return new.withColumn("_d", deal).withColumn("deal_type", F.col("_d.deal_type")).withColumn("deal_type_value", F.col("_d.deal_type_value")).withColumn("geo_status", F.lit(False)).drop("_d")


def archive_updates(summarized: DataFrame, geo: DataFrame) -> DataFrame:
    """(internal_id, archived_date, available) of rows whose archive state differs in geo."""
    s = summarized.select("internal_id", "archived_date", "available")
    g = geo.select("internal_id", F.col("archived_date").alias("a"), F.col("available").alias("b"))
    return s.join(g, "internal_id").filter(~F.col("archived_date").eqNullSafe(F.col("a")) | ~F.col("available").eqNullSafe(F.col("b"))).drop("a", "b")


def price_log(existing: DataFrame, *sources: DataFrame) -> DataFrame:
    """Clean new price events: trimmed ids, no nulls, no outliers, one per (id, change_date, source_id), the last given."""
    rows = union_by_name(*[s.withColumn("_n", F.lit(n)) for n, s in enumerate(sources)])
    old, new = F.col("old_price").try_cast("double"), F.col("new_price").try_cast("double")
    rows = rows.select(X.blank_to_null(F.col("id").cast("string")).alias("id"), old.alias("old_price"), new.alias("new_price"), X.to_date(F.col("change_date")).alias("change_date"), "source_id", "_n")
    rows = rows.dropna(subset=["id", "old_price", "new_price", "change_date"]).filter((F.abs("old_price") < D.PRICE_HIGH) & (F.abs("new_price") < D.PRICE_HIGH))
    rows = pick_one(rows, ["id", "change_date", "source_id"], [F.desc("_n"), F.desc("new_price"), F.desc("old_price")]).drop("_n")
    return rows.join(existing.select("id", "change_date", "source_id"), ["id", "change_date", "source_id"], "left_anti").select("id", "old_price", "new_price", "change_date", "source_id")


def sellers(existing: DataFrame, *sources: DataFrame) -> DataFrame:
    """New sellers with an e-mail or phone, one per id: with e-mail before without, then with phone."""
    rows = union_by_name(*sources).filter(F.col("agent_email").isNotNull() | F.col("agent_phone").isNotNull())
    rows = pick_one(rows, ["id"], [F.col("agent_email").isNull(), F.col("agent_phone").isNull(), F.col("agent_email"), F.col("agent_phone"), F.col("agent_name")])
    return rows.join(existing.select("id"), "id", "left_anti")


# ---------------------------------------------------------------- geography


def _keys(rows: DataFrame) -> DataFrame:
    return rows.withColumn("city_key", X.norm_key(F.col("norm_city"))).withColumn("part_key", X.norm_key(F.col("norm_city_part"))).withColumn("street_key", X.norm_key(F.col("norm_street")))


def _look_up(rows: DataFrame, base: DataFrame, on: str, entries: DataFrame, entry_key: str, prefix: str) -> DataFrame:
    """rows with <prefix>_town, _county, _district and _part of the entry that matches column `on`, exactly or fuzzily.

    base: a written table with the column, so that what is looked up does not depend on the look-ups before it."""
    e = entries.select(F.col(entry_key).alias("_m"), F.col("town").alias(f"{prefix}_town"), F.col("county").alias(f"{prefix}_county"), F.col("city_district").alias(f"{prefix}_district"), F.col("part").alias(f"{prefix}_part"))
    found = fuzzy.best_match(base, entries, on, entry_key).select(F.col("query").alias("_q"), F.col("match").alias("_m")).join(e, "_m").drop("_m")
    return rows.join(found, rows[on] == found["_q"], "left").drop("_q")


def _verdict(rows: DataFrame, city: Column, part: Column, county: Column, region: Column, ok: Column, *more: str) -> DataFrame:
    """Only what is known changes: a null fix keeps the old value, and a row without a match keeps all."""
    return rows.select(
        "internal_id", F.coalesce(F.when(ok, region), F.col("norm_district")).alias("norm_district"), F.coalesce(F.when(ok, county), F.col("norm_okres")).alias("norm_okres"),
        F.coalesce(F.when(ok, city), F.col("norm_city")).alias("norm_city"), F.coalesce(F.when(ok, part), F.col("norm_city_part")).alias("norm_city_part"), "norm_street",
        ok.alias("geo_ok"), (~ok).alias("not_true"), *more,
    )


def region_cascade(subset: DataFrame, towns: DataFrame, parts: DataFrame, streets: DataFrame, region: str) -> DataFrame:
    """Verdicts for a region's open rows: town by exact or fuzzy city, else by part, else by street, else rejected."""
    rows = base = cut_lineage(_keys(subset.filter((F.col("norm_district") == region) & ~F.coalesce("geo_ok", F.lit(False)))), "open")
    for on, entries, prefix in (("city_key", towns, "c"), ("part_key", parts, "p"), ("street_key", streets, "s")):
        rows = _look_up(rows, base, on, entries, on.replace("city", "town"), prefix)
    town, county = F.coalesce("c_town", "p_town", "s_town"), F.when(F.col("c_town").isNotNull(), F.col("c_county")).when(F.col("p_town").isNotNull(), F.col("p_county")).otherwise(F.col("s_county"))
    return _verdict(rows, town, F.col("norm_city_part"), county, F.lit(region), town.isNotNull())


def capital_cascade(subset: DataFrame, capital: tuple[DataFrame, DataFrame, DataFrame], neighbour: tuple[DataFrame, DataFrame, DataFrame]) -> DataFrame:
    """Verdicts for the capital's open rows, with the phase that decided: 1 by its label, 2 by part or street of its
    registry, 3 by a town, part or street of the neighbouring region, 0 rejected."""
    rows = base = cut_lineage(_keys(subset.filter((F.col("norm_district") == D.CAPITAL) & ~F.coalesce("geo_ok", F.lit(False)))), "open")
    numbered, plain = X.is_numbered_capital(F.col("city_key")), F.coalesce(F.col("city_key").isin("praha", "praga"), F.lit(False))
    _, parts, streets = capital
    towns2, parts2, streets2 = neighbour
    for on, entries, prefix in (("part_key", parts, "p"), ("street_key", streets, "s"), ("city_key", towns2, "nc"), ("part_key", parts2, "np"), ("street_key", streets2, "ns")):
        rows = _look_up(rows, base, on, entries, on.replace("city", "town"), prefix)
    guessed = F.coalesce("p_district", "s_district")
    town = F.coalesce("nc_town", "np_town", "ns_town")
    county = F.when(F.col("nc_town").isNotNull(), F.col("nc_county")).when(F.col("np_town").isNotNull(), F.col("np_county")).otherwise(F.col("ns_county"))
    phase = F.when(numbered | plain, 1).when(guessed.isNotNull(), 2).when(town.isNotNull(), 3).otherwise(0)
    rows = rows.withColumn("phase", phase)
    city = F.when(numbered, X.capital_label(F.col("norm_city"))).when(plain, "Praha").when(F.col("phase") == 2, X.capital_label(guessed)).otherwise(town)
    part = F.when(F.col("phase") == 2, F.coalesce("norm_city_part", F.when(F.col("p_district").isNull(), F.col("s_part"))))
    return _verdict(rows, city, part, F.when(F.col("phase") == 3, county), F.when(F.col("phase") == 3, D.NEIGHBOUR).otherwise(D.CAPITAL), F.col("phase") > 0, "phase")


# ---------------------------------------------------------------- duplicates


def image_pairs(new: DataFrame, old: DataFrame, with_new: bool = True) -> DataFrame:
    """(site_id1, site_id2, distance, percentage) of listings with near images. new, old: site_id, phash."""
    made = lambda df: df.select("site_id", phash.words(F.col("phash")).alias("w"), phash.bucket(F.col("phash")).alias("b"))
    pairs = phash.blocked_pairs(made(new), made(old), "site_id", "w", "b", with_new=with_new)
    return pairs.groupBy(F.col("key1").alias("site_id1"), F.col("key2").alias("site_id2")).agg(F.min("distance").alias("distance")).withColumn("percentage", phash.percent(F.col("distance")))


def clusters(pairs: DataFrame, geo: DataFrame, known: DataFrame | None = None, fresh: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """(map, cluster) tables of duplicate listings. pairs: site_id1, site_id2, percentage, date; geo: internal_id, site_id, added_date.

    known: (id, root) of the pairs that are not fresh; then only fresh pairs, of which `fresh` tells, are searched for
    components."""
    sites = geo.select(X.site_key(F.col("site_id")).alias("site"), "internal_id", "added_date")
    sites = pick_one(sites, ["site"], [F.col("added_date").asc_nulls_last(), F.col("internal_id")])
    edge = pairs.select(X.site_key(F.col("site_id1").cast("string")).alias("site_a"), X.site_key(F.col("site_id2").cast("string")).alias("site_b"), "percentage", "date", (F.lit(True) if fresh is None else F.coalesce(fresh, F.lit(False))).alias("fresh"))
    edge = edge.join(sites.select(F.col("site").alias("site_a"), F.col("internal_id").alias("a")), "site_a").join(sites.select(F.col("site").alias("site_b"), F.col("internal_id").alias("b")), "site_b")
    roots = graph.connected_components(edge) if known is None else cut_lineage(graph.extend_components(known, edge.filter("fresh")), "roots")
    members = roots.join(sites.select(F.col("internal_id").alias("id"), "added_date"), "id")
    canon = graph.canonical_members(members, "root", "id", "added_date")
    mapping = canon.join(members.select("id", "added_date"), "id").select(F.col("id").alias("internal_id"), F.col("canonical").alias("canonical_internal_id"), F.col("added_date").alias("iid_added_min"))
    leader = canon.join(roots, "id").select("root", "canonical").distinct()
    stats = graph.cluster_stats(edge, members.select("id"), roots, F.col("percentage"), F.col("date")).join(leader, "root")
    cluster = stats.select(F.col("canonical").alias("canonical_internal_id"), "members_count", F.col("member_ids").alias("member_internal_ids"), "site_ids", "first_seen", "last_seen", F.col("max_pct").alias("max_percentage"), "edges_count")
    return mapping, cluster


CLUSTER_MERGE = {"members_count": "overwrite", "member_internal_ids": "overwrite", "site_ids": "overwrite", "first_seen": "least", "last_seen": "greatest", "max_percentage": "greatest", "edges_count": "overwrite"}


def near_pairs(rows: DataFrame, others: DataFrame | None = None) -> DataFrame:
    """(canonical_internal_id, a, b): pairs of one cluster, kind and deal whose areas pass the check, b of `others` if given,
    each pair of rows once. Listings that both know both areas are near by either, others by the area that stands for them.

    a.area and b.area are the areas that are near, a.mode and b.mode what they are."""
    build, land, category = F.col("area_build"), F.col("area_land"), F.col("category_value")

    def placed(df: DataFrame) -> DataFrame:
        place = lambda band, area, mode, before=None: F.struct(F.lit(band).alias("band"), area.alias("area"), mode.alias("mode"), (F.lit(None) if before is None else before).cast("double").alias("_before"))
        whole = build.isNotNull() & land.isNotNull()
        own = place("own", D.own_area(category, build, land), D.own_mode(category, build, land))
        places = F.when(whole, F.array(place("build", build, F.lit("build")), place("land", land, F.lit("land"), build), own)).otherwise(F.array(own))
        out = df.withColumn("whole", whole).withColumn("_place", F.explode(places)).select("*", "_place.*").drop("_place")
        return out.withColumn("_bin", D.area_bin(F.col("area"))).withColumn("_apart", F.col("whole") & (F.col("band") == "own"))

    pairs = band_pairs(placed(rows), placed(rows if others is None else others), "canonical_internal_id", "internal_id", ("category_value", "deal_type", "band"), "_bin")
    close = lambda c: D.areas_close(F.col(f"a.{c}"), F.col(f"b.{c}"))
    # Two that know both areas are apart in the band own, and near by land only if not by built areas before.
    return pairs.filter(close("area") & ~(F.col("a._apart") & F.col("b._apart")) & ~close("_before"))


def clean_pairs(listings: DataFrame, mapping: DataFrame) -> DataFrame:
    """(iid1, iid2, level, price_ok, …) of listings in one cluster that agree on place, kind, deal and area.

    A listing whose areas are missing, not positive, no numbers or infinite is near nothing. Pairs are as many as there are
    near listings, so they are not shuffled: only an id that stands in more than one row (of listings or clusters) can give a
    pair twice, and only pairs with such an id are gathered to pick one."""
    geo = ("norm_okres", "norm_city", "norm_city_part", "norm_street")
    seen = listings.select("internal_id", "category_value", "deal_type", "price", "area_build", "area_land", *[X.text_key(F.col(c)).alias(c) for c in geo])
    rows = seen.join(mapping.select("internal_id", "canonical_internal_id"), "internal_id")
    rows = rows.withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy("internal_id")))
    once, repeated = rows.filter("_n = 1").drop("_n"), rows.filter("_n > 1").drop("_n")

    def found(pairs: DataFrame) -> DataFrame:
        both = lambda c: (F.col(f"a.{c}"), F.col(f"b.{c}"))
        level, price = D.key_level([both(c) for c in geo]), D.price_check(*both("price"))
        made = pairs.select(F.col("a.internal_id").alias("iid1"), F.col("b.internal_id").alias("iid2"), "canonical_internal_id", level.alias("level"), price.alias("price"), F.when(F.col("a.mode") == F.col("b.mode"), F.col("a.mode")).otherwise("mixed").alias("area_mode"), F.col("a.area").alias("area1"), F.col("b.area").alias("area2"))
        return made.filter("level is not null").select("iid1", "iid2", "canonical_internal_id", "level", F.col("price.ok").alias("price_ok"), F.col("price.hi").alias("price_hi"), F.col("price.lo").alias("price_lo"), "area_mode", "area1", "area2")

    several = found(near_pairs(repeated, rows.drop("_n"))).unionByName(found(near_pairs(once, repeated)))
    several = pick_one(several, ["iid1", "iid2"], [F.col("level"), F.desc("price_ok"), F.col("area_mode"), F.col("canonical_internal_id")])
    return found(near_pairs(once)).unionByName(several)
