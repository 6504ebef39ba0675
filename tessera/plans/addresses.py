"""The address normalisation queue: export, pluggable normaliser, import, restore."""

from __future__ import annotations

from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions.domain import bad_geography
from ..operators.quality import CheckResult
from ..operators.relational import move_rows, restore_rows, update_from

FIELDS = ["in_cz", "geo_status", "norm_district", "norm_okres", "norm_city", "norm_city_part", "norm_street", "norm_house_number"]


class AddressNormaliser(Protocol):
    """Anything that turns queue rows into (internal_id, FIELDS): a batch service, a model, a table."""

    def __call__(self, rows: DataFrame) -> DataFrame: ...


def queue_bad(geo: DataFrame, queue: DataFrame) -> tuple[DataFrame, DataFrame]:
    return move_rows(geo, queue, "internal_id", bad_geography(F.col("geo_status"), F.col("norm_district")))


def requests(queue: DataFrame, template: str, limit: int | None = None) -> DataFrame:
    """(internal_id, prompt) of open rows, oldest ids first."""
    cols = {c: X.null_words(F.col(c).cast("string")) for c in ("district", "city", "city_part", "street", "house_number", "name") if c in queue.columns}
    rows = queue.filter(~F.coalesce("geo_status", F.lit(False))).select("internal_id", X.render_prompt(template, cols).alias("prompt"))
    return rows.orderBy("internal_id").limit(limit) if limit else rows


def export_requests(rows: DataFrame, path: str, per_file: int = 500) -> None:
    rows.write.option("maxRecordsPerFile", per_file).mode("overwrite").json(path)


def import_answers(spark: SparkSession, path: str) -> DataFrame:
    """Answers as (internal_id, FIELDS); lines that are no valid answer are left out."""
    shape = "internal_id bigint, answer string"
    inner = "in_cz string, geo_status string, norm_district string, norm_okres string, norm_city string, norm_city_part string, norm_street string, norm_house_number string"
    raw = spark.read.schema(shape).json(path).withColumn("a", F.from_json("answer", inner, {"mode": "PERMISSIVE"})).filter("internal_id is not null and a is not null and coalesce(a.in_cz, a.geo_status, a.norm_district) is not null")
    return raw.select("internal_id", *[(X.to_bool(F.col(f"a.{c}"), None) if c in ("in_cz", "geo_status") else X.blank_to_null(F.col(f"a.{c}"))).alias(c) for c in FIELDS])


def apply_answers(queue: DataFrame, answers: DataFrame) -> DataFrame:
    return update_from(queue, answers, ["internal_id"], FIELDS)


def sent_equals_received(sent: DataFrame, received: DataFrame) -> CheckResult:
    a, b = sent.count(), received.count()
    return CheckResult("answers", a == b, "error", {"sent": a, "received": b})


def restore(queue: DataFrame, geo: DataFrame, summarized: DataFrame) -> tuple[DataFrame, DataFrame]:
    return restore_rows(queue, geo, summarized, "internal_id", F.coalesce("in_cz", F.lit(False)) & F.coalesce("geo_status", F.lit(False)))


def to_subset(geo: DataFrame, subset: DataFrame) -> DataFrame:
    """subset with the resolved rows of geo that it lacks, their verdict still open."""
    rows = geo.filter(F.coalesce("geo_status", F.lit(False))).join(subset.select("internal_id"), "internal_id", "left_anti")
    return subset.unionByName(rows.select("internal_id", "norm_district", "norm_okres", "norm_city", "norm_city_part", "norm_street", F.lit(False).alias("geo_ok"), F.lit(False).alias("not_true")), allowMissingColumns=True)
