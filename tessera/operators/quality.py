"""Data-quality checks: each returns a CheckResult; a gate is a list of them."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import asdict, dataclass, field
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from ..storage import Database, PublishRejected


@dataclass
class CheckResult:
    name: str
    ok: bool
    severity: str = "error"
    detail: dict[str, Any] = field(default_factory=dict)

    def to_dict(self) -> dict:
        return asdict(self)


def same_snapshot_date(dates: dict[str, Any], today: Any, severity: str = "error") -> CheckResult:
    known = {d for d in dates.values() if d is not None}
    return CheckResult("snapshot_date", known <= {today} and len(known) <= 1, severity, {"dates": dates, "today": today})


def not_more(name: str, smaller: int, larger: int, severity: str = "error") -> CheckResult:
    return CheckResult(name, smaller <= larger, severity, {"smaller": smaller, "larger": larger})


def drift(name: str, a: int, b: int, most: int, severity: str = "warn") -> CheckResult:
    return CheckResult(name, abs(a - b) <= most, severity, {"a": a, "b": b, "most": most})


def equal_counts(name: str, a: int, b: int, severity: str = "error") -> CheckResult:
    detail: dict[str, Any] = {"a": a, "b": b}
    if a != b:
        detail["reason"] = "duplicates suspected" if a > b else "missing rows"
    return CheckResult(name, a == b, severity, detail)


def mass_balance(before: int, inserted: int, after: int) -> CheckResult:
    return CheckResult("mass_balance", after == before + inserted, "error", {"before": before, "inserted": inserted, "after": after})


def unique_key(df: DataFrame, keys: Sequence[str]) -> CheckResult:
    r = df.agg(F.count(F.lit(1)).alias("n"), F.count_distinct(F.struct(*keys)).alias("d")).first()
    return CheckResult(f"unique({','.join(keys)})", r["n"] == r["d"], "error", {"rows": r["n"], "distinct": r["d"]})


def covered(child: DataFrame, parent: DataFrame, keys: Sequence[str]) -> CheckResult:
    missing = child.join(parent.select(*keys), list(keys), "left_anti").count()
    return CheckResult("foreign_key", missing == 0, "error", {"missing": missing})


def exclusive(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> CheckResult:
    shared = a.join(b.select(*keys), list(keys), "left_semi").count()
    return CheckResult("exclusive", shared == 0, "error", {"shared": shared})


def no_nulls(df: DataFrame, keys: Sequence[str]) -> CheckResult:
    bad = df.filter(" or ".join(f"`{k}` is null" for k in keys)).count()
    return CheckResult("no_nulls", bad == 0, "error", {"rows": bad})


@dataclass
class Observed:
    """A figure of a frame that is being written, an aggregate without DISTINCT, and what must hold of it (any if None)."""

    name: str
    figure: Column
    holds: Callable[[Any], bool] | None = None
    severity: str = "error"


def observed(df: DataFrame, checks: Sequence[Observed]) -> tuple[DataFrame, Callable[[], dict[str, Any]]]:
    """df with the checks' figures gathered on the way, and a function that gives them after the one action on it."""
    seen = Observation()
    figures = [c.figure.alias(c.name) for c in checks] or [F.count(F.lit(1)).alias("rows")]
    return df.observe(seen, *figures), lambda: dict(seen.get)


def null_keys(*keys: str) -> Column:
    return F.count_if(F.lit(False) if not keys else reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys]))


def with_parent(df: DataFrame, parent: DataFrame, keys: Sequence[str], flag: str) -> DataFrame:
    """df with a column that tells whether the parent has the row's key; a join that the write does anyway on its way."""
    return df.join(parent.select(*keys).distinct().withColumn(flag, F.lit(True)), list(keys), "left").withColumn(flag, F.coalesce(flag, F.lit(False)))


def with_repeats(df: DataFrame, keys: Sequence[str], flag: str) -> DataFrame:
    """df with a column that tells the second and later rows of a key; keys with nulls count as keys."""
    return df.withColumn(flag, F.row_number().over(Window.partitionBy(*keys).orderBy(F.lit(0))) > 1)


def publish_observed(db: Database, frames: dict[str, tuple[DataFrame, Sequence[Observed], Sequence[str]]], across: Callable[[dict[str, dict[str, Any]]], Sequence[CheckResult]] | None = None) -> list[CheckResult]:
    """Writes frames and publishes all of them if the checks hold, else none; nothing is read again to find out.

    frames: by table the rows, the checks, and helper columns that are checked but not stored. Each frame is one write whose
    own pass gathers its figures. across: checks that need the figures of several tables."""
    figures, results, parts = {}, [], {}
    for name, (df, checks, helpers) in frames.items():
        seen, get = observed(df, checks)
        parts[name] = db.stage(name, seen.drop(*helpers))
        figures[name] = get()
        results += [CheckResult(f"{name}.{c.name}", bool(c.holds(figures[name][c.name])), c.severity, {"figure": figures[name][c.name]}) for c in checks if c.holds]
    results += across(figures) if across else []
    failures = [r for r in results if not r.ok and r.severity == "error"]
    if failures:
        raise PublishRejected(failures)
    db.commit(parts, base={})
    return results


def audit_columns(source: DataFrame, target: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """One row: of every column how many rows of equal key differ, null-safe, all in one pass."""
    t = target.select(*keys, *[F.col(c).alias(f"_t_{c}") for c in columns])
    both = source.select(*keys, *columns).join(t, list(keys))
    return both.agg(*[F.coalesce(F.sum((~F.col(c).eqNullSafe(F.col(f"_t_{c}"))).cast("bigint")), F.lit(0).cast("bigint")).alias(c) for c in columns])


def audit_keys(source: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: source_keys, target_keys, missing (in target), extra (in target) and duplicates (of target)."""
    s, t = source.select(*keys).distinct(), target.select(*keys)
    d = t.distinct()
    counts = [
        s.agg(F.count(F.lit(1)).alias("source_keys")),
        d.agg(F.count(F.lit(1)).alias("target_keys")),
        s.join(d, list(keys), "left_anti").agg(F.count(F.lit(1)).alias("missing")),
        d.join(s, list(keys), "left_anti").agg(F.count(F.lit(1)).alias("extra")),
        t.groupBy(*keys).count().agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).alias("duplicates")),
    ]
    out = counts[0]
    for c in counts[1:]:
        out = out.crossJoin(c)  # one row each
    return out


def _told_apart(*columns: str) -> Column:
    """A hash of values in which nulls count by their place."""
    return F.xxhash64(*[F.col(c) for c in columns], *[F.col(c).isNull() for c in columns])


def _unequal(source: DataFrame, target: DataFrame, bucket: Column, columns: Sequence[str]) -> DataFrame:
    """The buckets whose rows are not the same on both sides, by count and the sums of a hash's halves: no row is joined."""
    h = _told_apart(*columns)
    sums = lambda df, n: df.groupBy(bucket.alias("bucket")).agg(F.struct(F.count(F.lit(1)), F.sum(F.shiftright(h, 32)), F.sum(h.bitwiseAND(F.lit(0xFFFFFFFF)))).alias(n))
    both = sums(source, "_s").join(sums(target, "_t"), "bucket", "full_outer")
    return both.filter(~F.col("_s").eqNullSafe(F.col("_t"))).select("bucket")


def digest_audit(source: DataFrame, target: DataFrame, keys: Sequence[str], columns: Sequence[str], fan: int = 256) -> DataFrame:
    """One row: compared (source rows that were joined), missing and extra keys of the target, duplicates (of the target,
    among what was joined), and of every column how many rows of equal key differ, null-safe.

    A tree of digests: fan buckets of keys, then fan parts of each unequal bucket; only the rows of unequal parts are joined.
    So equal tables are read once each and joined nowhere, and a few changes cost the rows around them. Keys with nulls are
    in no join, as in audit_keys(). Jobs run while the result is built."""
    rows = [df.select(*keys, *columns).withColumn("_part", F.pmod(_told_apart(*keys), F.lit(fan * fan))) for df in (source, target)]
    top = _unequal(*rows, F.expr(f"_part div {fan}"), [*keys, *columns])
    unequal = [r["bucket"] for r in top.collect()]  # at most fan
    under = [df.filter(F.expr(f"_part div {fan}").isin(unequal)) if unequal else df.limit(0) for df in rows]
    parts = F.broadcast(_unequal(*under, F.col("_part"), [*keys, *columns]).withColumnRenamed("bucket", "_part"))  # at most fan * fan rows
    s, t = (df.join(parts, "_part", "left_semi").drop("_part") for df in under)
    found = audit_keys(s, t, keys).select("missing", "extra", "duplicates")
    return s.agg(F.count(F.lit(1)).alias("compared")).crossJoin(found).crossJoin(audit_columns(s, t, keys, columns))  # one row each


def publish_gate(objects: DataFrame, active: DataFrame, closed: DataFrame, splits: DataFrame, unknown: str = "ostatni", severity: str = "error") -> list[CheckResult]:
    """What must hold before the star schema is published."""
    in_facts = active.select("object_id").union(closed.select("object_id")).distinct().count()
    n = objects.select("object_id").distinct().count()
    facts = active.select("deal_type").union(closed.select("deal_type"))
    odd = facts.filter((F.col("deal_type") == unknown) | F.col("deal_type").isNull())
    count_odd = odd.count()
    top = [tuple(r) for r in facts.groupBy("deal_type").count().orderBy(F.desc("count"), "deal_type").limit(10).collect()] if count_odd else []
    split_total, fact_total = splits.count(), facts.count() - count_odd
    return [
        CheckResult("objects_in_facts", n == in_facts, severity, {"objects": n, "facts": in_facts}),
        CheckResult("no_unknown_deals", count_odd == 0, severity, {"unknown": count_odd, "top_deal_types": top}),
        CheckResult("splits_sum_up", split_total == fact_total, severity, {"splits": split_total, "facts": fact_total}),
    ]
