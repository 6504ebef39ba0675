"""Dated snapshots, JSON documents, registries and other inputs of the pipeline."""

from __future__ import annotations

import datetime as dt
import json
import re
from collections.abc import Callable, Iterable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import norm_key, url_without_query, ymd

_NAME = re.compile(r"^(?P<prefix>.+)_(?P<d>\d{2})(?P<m>\d{2})(?P<y>\d{4})$")


def snapshot_date(name: str) -> dt.date | None:
    """The date of <prefix>_DDMMYYYY; None for other names and impossible dates."""
    m = _NAME.match(name)
    try:
        return dt.date(int(m["y"]), int(m["m"]), int(m["d"])) if m else None
    except ValueError:
        return None


def sorted_snapshots(names: Iterable[str], prefix: str, as_of: dt.date | None = None) -> list[tuple[dt.date, str]]:
    """(date, name) of a family's snapshots in order of date, none after as_of."""
    found = []
    for n in names:
        d, m = snapshot_date(n), _NAME.match(n)
        if d and m["prefix"] == prefix and (as_of is None or d <= as_of):
            found.append((d, n))
    return sorted(found)


def catalog_snapshots(spark: SparkSession, prefix: str, database: str | None = None, as_of: dt.date | None = None) -> list[tuple[dt.date, str]]:
    return sorted_snapshots([t.name for t in spark.catalog.listTables(database)], prefix, as_of)


def latest(df: DataFrame, column: str = "snapshot_date") -> DataFrame:
    """The rows of the last snapshot of a table that is partitioned by date."""
    last = df.agg(F.max(column).alias("_last"))
    return df.join(F.broadcast(last), F.col(column) == F.col("_last")).drop("_last")


def latest_two(df: DataFrame, column: str = "snapshot_date") -> tuple[DataFrame, DataFrame]:
    """(previous, current)."""
    dates = [r[0] for r in df.select(column).distinct().orderBy(F.desc(column)).limit(2).collect()]
    if len(dates) < 2:
        raise ValueError("two snapshots are needed")
    return df.filter(F.col(column) == F.lit(dates[1])), df.filter(F.col(column) == F.lit(dates[0]))


def calendar_exact(df: DataFrame, today: dt.date, column: str = "snapshot_date") -> tuple[DataFrame, DataFrame]:
    """(yesterday's, today's); an error if either is missing."""
    out = []
    for day in (today - dt.timedelta(days=1), today):
        part = df.filter(F.col(column) == F.lit(day))
        if part.isEmpty():
            raise ValueError(f"no snapshot of {day}")
        out.append(part)
    return out[0], out[1]


def today_in(zone: str = "Europe/Prague") -> dt.date:
    from zoneinfo import ZoneInfo

    return dt.datetime.now(ZoneInfo(zone)).date()


#: Keys of the JSON records and the columns they become.
RECORD_KEYS = {
    "id": "id", "name": "title", "address": "address", "category_name": "type", "price_czk": "Cena_numeric", "surface": "Užitná plocha_numeric", "scraped_at": "scraped_at", "floor": "floor",
    "ownership": "ownership", "building_condition": "building_condition", "equipment": "equipment", "energy_label": "energy_label", "parking": "parking", "constructed_area": "Zastavěná plocha_numeric",
    "building_type": "building_type", "seller_info": "seller_info",
}


def json_records(df: DataFrame, column: str = "data") -> DataFrame:
    """Typed columns of JSON documents and the document itself; null and invalid documents are left out."""
    v = df.filter(F.col(column).isNotNull()).select(F.col(column).alias("raw_json"), F.try_parse_json(column).alias("_v")).filter("_v is not null")
    return v.select(*[F.try_variant_get("_v", f"$['{k}']", "string").alias(c) for c, k in RECORD_KEYS.items()], "raw_json")


def key_types(df: DataFrame, column: str, day: str) -> DataFrame:
    """(day, key, n, types): the top-level keys of each day's JSON documents, how many have them, and the sorted types of
    their values but null. Invalid documents and those that are no objects have none."""
    docs = df.select(F.col(day).alias("day"), F.try_parse_json(column).alias("doc")).filter("doc is not null and schema_of_variant(doc) like 'OBJECT%'")
    entries = docs.lateralJoin(df.sparkSession.tvf.variant_explode(F.col("doc").outer()))
    kind = F.regexp_extract(F.schema_of_variant("value"), "^[A-Z]+", 0)
    kind = F.when(~F.is_variant_null("value"), kind)
    return entries.groupBy("day", "key").agg(F.count(F.lit(1)).alias("n"), F.array_sort(F.collect_set(kind)).alias("types"))


def key_drift(df: DataFrame, column: str, day: str) -> DataFrame:
    """(day, key, change, before, now): keys that a snapshot day has added, lost or retyped against the day before it that
    has any documents with keys. A key whose values are all null keeps its type."""
    types = key_types(df, column, day)
    days = types.select("day").distinct().withColumn("previous", F.lag("day").over(Window.orderBy("day")))  # a row a day
    pairs = days.filter("previous is not null")
    now = pairs.join(types, "day").select("day", "key", F.col("types").alias("now"))
    before = pairs.join(types.select(F.col("day").alias("previous"), "key", F.col("types").alias("before")), "previous").select("day", "key", "before")
    both = now.join(before, ["day", "key"], "full_outer")
    retyped = (F.size("before") > 0) & (F.size("now") > 0) & (F.col("before") != F.col("now"))
    change = F.when(F.col("before").isNull(), "added").when(F.col("now").isNull(), "lost").when(retyped, "retyped")
    return both.select("day", "key", change.alias("change"), "before", "now").filter("change is not null")


def has_json_key(c: Column, key: str) -> Column:
    """Whether a JSON object has the key, whatever its value."""
    return F.coalesce(F.array_contains(F.json_object_keys(c), key), F.lit(False))


def image_urls(c: Column, most: int = 5) -> Column:
    """array<struct<pos, url>> of the first images of a list of strings or of objects with a url."""
    plain = F.filter(F.from_json(c, "array<string>"), lambda x: ~F.startswith(F.ltrim(x), F.lit("{")))
    objects = F.filter(F.transform(F.from_json(c, "array<struct<url:string>>"), lambda x: x["url"]), lambda x: x.isNotNull())
    urls = F.slice(F.when(F.size(plain) > 0, plain).otherwise(objects), 1, most)
    return F.transform(urls, lambda u, i: F.struct((i + 1).alias("pos"), u.alias("url")))


def local_images(spark: SparkSession, path: str, hashed: DataFrame, key: str = "path") -> DataFrame:
    """Image files that are not hashed yet; what is missing from disk does not appear."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.join(hashed.select(key), key, "left_anti")


def registry_lists(registry: DataFrame, region: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(towns, parts, streets) of a region with their keys; of rows with one key, each column's first known value in order."""
    r = registry.filter(F.col("kraj") == region).select(
        norm_key(F.col("nazev_obce")).alias("town_key"), norm_key(F.col("nazev_casti_obce")).alias("part_key"), norm_key(F.col("nazev_ulice")).alias("street_key"),
        F.col("nazev_obce").alias("town"), F.col("nazev_casti_obce").alias("part"), F.col("region").alias("county"), F.col("nazev_obvodu_prahy").alias("city_district"),
    )

    def first_known(key: str) -> DataFrame:
        rest = ["town", "part", "county", "city_district"]
        return r.filter(F.col(key).isNotNull() & (F.col(key) != "")).groupBy(key).agg(*[F.min_by(c, F.when(F.col(c).isNotNull(), F.struct("town", "part", "county", "city_district"))).alias(c) for c in rest])

    return first_known("town_key"), first_known("part_key"), first_known("street_key")


def date_series(spark: SparkSession, first: Column | dt.date, last: Column | dt.date, column: str = "date") -> DataFrame:
    lo, hi = (F.lit(x) if isinstance(x, dt.date) else x for x in (first, last))
    return spark.range(1).select(F.explode(F.sequence(lo, hi, F.expr("interval 1 day"))).alias(column))


def load_settings(path: str, defaults: dict | None = None) -> dict:
    """A JSON file's settings; names in upper case stand for the lower-case ones."""
    raw = json.loads(Path(path).read_text(encoding="utf-8"))
    return (defaults or {}) | {k.lower(): v for k, v in raw.items()}


def setting(settings: dict, *path: str, default=None):
    for key in path:
        if not isinstance(settings, dict) or key not in settings:
            return default
        settings = settings[key]
    return settings


def empty(spark: SparkSession, schema) -> DataFrame:
    return spark.createDataFrame([], schema)


def jdbc_table(spark: SparkSession, url: str, table: str, columns: list[str], fetch: int = 10_000, split: str | None = None, parts: int = 8, where: Column | None = None) -> DataFrame:
    """A database table with only the named columns, fetched in batches. With `split` (a number, date or timestamp column) it
    is read by `parts` tasks, each a range between the column's least and greatest value of now; rows beyond these and nulls
    go to the outer ranges, so that none is lost. An empty table, or one without any value in `split`, is read by one task.
    `where` and the columns are pushed into the database's query where it can take them."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table).option("fetchsize", fetch)
    if split is not None:
        low, high = reader.load().agg(F.min(split), F.max(split)).first()
        if low is not None:
            reader = reader.option("partitionColumn", split).option("lowerBound", str(low)).option("upperBound", str(high)).option("numPartitions", parts)
    rows = reader.load()
    return (rows if where is None else rows.filter(where)).select(*columns)


def ranked_names(names: DataFrame, prefix: str, as_of: dt.date | None = None, column: str = "name") -> DataFrame:
    """(name, snapshot_date, age) of the family's snapshot tables, the latest of age 1; other names and bad dates are left out."""
    rows = names.filter(F.col(column).rlike(f"^{re.escape(prefix)}_[0-9]{{8}}$")).select(F.col(column).alias("name"), ymd(F.col(column)).alias("snapshot_date")).filter("snapshot_date is not null")
    if as_of is not None:
        rows = rows.filter(F.col("snapshot_date") <= F.lit(as_of))
    return rows.withColumn("age", F.dense_rank().over(Window.orderBy(F.desc("snapshot_date"))))


def download_log(listings: DataFrame, images: str = "images", key: str = "site_id", source: str = "source") -> DataFrame:
    """(site_id, source, urls, filenames): what a download of each listing's first images would log. File names are made of
    source, id and place; the extension is the url's, else .jpg. Listings without an image are left out."""
    urls = image_urls(F.col(images))
    ext = lambda u: F.coalesce(F.nullif(F.regexp_extract(F.lower(url_without_query(u)), r"\.(png|webp|jpe?g)$", 0), F.lit("")), F.lit(".jpg"))
    named = F.transform(urls, lambda x: F.concat(F.col(source), F.lit("_"), F.col(key).cast("string"), F.lit("_"), x["pos"].cast("string"), ext(x["url"])))
    rows = listings.select(F.col(key), F.col(source), F.transform(urls, lambda x: x["url"]).alias("urls"), named.alias("filenames")).filter(F.size("urls") > 0)
    return rows.select(key, source, F.to_json("urls").alias("urls"), F.to_json("filenames").alias("filenames"))


def deletable(files: DataFrame, hashed: DataFrame, prefix: str, column: str = "path") -> DataFrame:
    """Paths of files that may be deleted: hashed ones inside the image folder, without any step out of it."""
    root = prefix.rstrip("/") + "/"
    inside = F.col(column).startswith(root) & ~F.col(column).rlike(r"(^|/)\.\.(/|$)")
    return files.select(column).filter(inside).join(hashed.select(column), column, "left_semi").distinct()


def fetch_images(urls: DataFrame, get: Callable[[str], tuple[int, str, bytes]], url: str = "url", tries: int = 4, backoff: float = 0.4) -> DataFrame:
    """(url, status, content_type, content, tries) of every url, fetched once each in the tasks by get(url) -> (status, type,
    content). Statuses 429 and 5xx and errors are tried again after backoff * 2**n seconds; what still fails has no content."""

    def run(batches):
        import time

        import pandas as pd

        for pdf in batches:
            out = []
            for u in pdf[url]:
                status, kind, content, n = 0, None, None, 0
                while n < tries:
                    if n:
                        time.sleep(backoff * 2 ** (n - 1))
                    n += 1
                    try:
                        status, kind, content = get(u)
                    except OSError:
                        status, kind, content = 0, None, None
                    if status and status != 429 and status < 500:
                        break
                out.append((u, status, kind, content if status == 200 else None, n))
            yield pd.DataFrame(out, columns=["url", "status", "content_type", "content", "tries"])

    return urls.select(url).filter(F.col(url).isNotNull()).distinct().mapInPandas(run, "url string, status int, content_type string, content binary, tries int")


def lacking_downloads(listings: DataFrame, log: DataFrame, key: str = "site_id") -> DataFrame:
    return listings.join(log.select(key).distinct(), key, "left_anti")
