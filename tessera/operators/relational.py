"""Generic operators on DataFrames: the state changes of the pipeline as pure functions, old table in, new table out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..lineage import cut_lineage


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The schema's columns in its order; what df lacks is a typed null, other columns go, bad values become null."""
    have = set(df.columns)
    return df.select(*[(F.col(f.name) if f.name in have else F.lit(None)).try_cast(f.dataType).alias(f.name) for f in schema])


def require_columns(df: DataFrame, needed: Sequence[str]) -> DataFrame:
    missing = [c for c in needed if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def common_columns(*frames: DataFrame) -> list[str]:
    """Columns that all frames have, in the first one's order."""
    shared = set.intersection(*(set(f.columns) for f in frames))
    return [c for c in frames[0].columns if c in shared]


def union_by_name(*frames: DataFrame) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def union_as_text(columns: Sequence[str], *frames: DataFrame) -> DataFrame:
    return union_by_name(*[f.select(*[F.col(c).cast("string").alias(c) for c in columns]) for f in frames])


def pick_one(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key, the first in order. The order should end in a unique column, else ties are arbitrary."""
    rn = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rn", rn).filter("_rn = 1").drop("_rn")


def latest_order(df: DataFrame, wanted: Sequence[str], last: str) -> list[Column]:
    """Descending order, nulls last, over those of the wanted columns that df has, then by `last`."""
    return [F.col(c).desc_nulls_last() for c in wanted if c in df.columns] + [F.col(last).desc()]


def insert_absent(target: DataFrame, rows: DataFrame, keys: Sequence[str], dedup: bool = True) -> DataFrame:
    """The rows whose key the target lacks; with dedup one row per key among them (conflict ignored), the one that sorts
    first, to be appended."""
    new = rows.join(target.select(*keys), list(keys), "left_anti").select(*rows.columns)
    return first_of(new, keys) if dedup else new


def first_of(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key, the one whose other columns sort first: reruns agree. A partial aggregate, not a sort of all rows."""
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    orderable = [c for c in rest if not isinstance(df.schema[c].dataType, T.MapType | T.VariantType)]
    least = df.groupBy(*keys).agg(F.min(F.struct(*orderable)).alias("_least")) if len(orderable) == len(rest) else None
    if least is None:
        return pick_one(df, keys, [F.col(c).asc_nulls_first() for c in orderable])
    return least.select(*[F.col(c) if c in keys else F.col(f"_least.{c}").alias(c) for c in df.columns])


def upsert(target: DataFrame, rows: DataFrame, keys: Sequence[str], merge: dict[str, str]) -> DataFrame:
    """Full-outer merge. merge names, per column, overwrite, least, greatest, add, keep or fill (new value only for null)."""
    t = target.select(*keys, *[F.col(c).alias(f"_t_{c}") for c in merge], F.lit(True).alias("_t"))
    r = rows.select(*keys, *[F.col(c).alias(f"_r_{c}") for c in merge], F.lit(True).alias("_r"))
    both = t.join(r, list(keys), "full_outer")

    def made(c: str, how: str) -> Column:
        old, new = F.col(f"_t_{c}"), F.col(f"_r_{c}")
        if how == "overwrite":
            return F.when(F.col("_r"), new).otherwise(old)
        if how == "keep":
            return F.when(F.col("_t"), old).otherwise(new)
        if how == "fill":
            return F.coalesce(old, new)
        if how == "add":
            return F.when(F.col("_t") & F.col("_r"), F.coalesce(old, F.lit(0)) + F.coalesce(new, F.lit(0))).otherwise(F.coalesce(old, new))
        return {"least": F.least, "greatest": F.greatest}[how](old, new)

    return both.select(*keys, *[made(c, how).alias(c) for c, how in merge.items()])


def update_from(target: DataFrame, rows: DataFrame, keys: Sequence[str], columns: Sequence[str], overwrite_with_null: bool = False) -> DataFrame:
    """target with columns set from the row of equal key; null values keep the old ones unless told otherwise."""
    r = rows.select(*keys, *[F.col(c).alias(f"_r_{c}") for c in columns], F.lit(True).alias("_hit"))
    out = target.join(r, list(keys), "left")
    for c in columns:
        new = F.col(f"_r_{c}") if overwrite_with_null else F.coalesce(F.col(f"_r_{c}"), F.col(c))
        out = out.withColumn(c, F.when(F.col("_hit"), new).otherwise(F.col(c)))
    return out.select(*target.columns)


def changed_rows(target: DataFrame, rows: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Rows whose key the target has with another value in any of the columns, compared null-safe."""
    t = target.select(*keys, *[F.col(c).alias(f"_t_{c}") for c in columns])
    differs = F.lit(False)
    for c in columns:
        differs = differs | ~F.col(c).eqNullSafe(F.col(f"_t_{c}"))
    return rows.join(t, list(keys)).filter(differs).select(*rows.columns)


def guard_whitelist(old: DataFrame, new: DataFrame, keys: Sequence[str], allowed: Sequence[str]) -> DataFrame:
    """Keys at which a column outside `allowed` changed: empty if the guard holds."""
    return changed_rows(old, new, keys, [c for c in old.columns if c not in keys and c not in allowed]).select(*keys)


def guard_append_only(old: DataFrame, new: DataFrame) -> DataFrame:
    """Rows of old that new lacks: empty if the guard holds."""
    return old.exceptAll(new.select(*old.columns))


def sync_snapshot(state: DataFrame, current: DataFrame, snapshot_date: Column, previous: DataFrame | None = None, key: str = "id", available: str = "available", archive_scope: str = "previous") -> DataFrame:
    """The state after a snapshot: new rows come in, archived ones that return are active again, active ones that vanish
    are archived. archive_scope 'previous' archives only what the previous snapshot had, 'active' all that is missing.

    One full-outer join; ids are made unique per snapshot first. Columns of current that the state lacks are dropped."""
    fields = [c for c in state.columns if c not in (key, "added_date", "archived_date", available)]
    curr = first_of(current, [key])
    curr = curr.select(key, *[(F.col(c) if c in curr.columns else F.lit(None).cast(state.schema[c].dataType)).alias(f"_n_{c}") for c in fields], F.lit(True).alias("_curr"))
    both = state.withColumn("_state", F.lit(True)).join(curr, key, "full_outer")
    if previous is not None and archive_scope == "previous":
        both = both.join(previous.select(key).distinct().withColumn("_prev", F.lit(True)), key, "left")
    else:
        both = both.withColumn("_prev", F.lit(True))
    is_new, here = F.col("_state").isNull(), F.col("_curr").isNotNull()
    active = F.coalesce(F.col(available), F.lit(False))
    gone = ~is_new & active & ~here & F.col("_prev").isNotNull()
    returns = ~is_new & ~active & here
    return both.select(
        key,
        *[F.when(is_new, F.col(f"_n_{c}")).otherwise(F.col(c)).alias(c) for c in fields],
        F.when(is_new, snapshot_date).otherwise(F.col("added_date")).cast(state.schema["added_date"].dataType).alias("added_date"),
        F.when(gone, snapshot_date).when(returns, F.lit(None)).otherwise(F.col("archived_date")).cast(state.schema["archived_date"].dataType).alias("archived_date"),
        F.when(is_new | returns, True).when(gone, False).otherwise(F.col(available)).alias(available),
    ).select(*state.columns)


def sync_counts(state: DataFrame, current: DataFrame, previous: DataFrame | None = None, key: str = "id", available: str = "available") -> DataFrame:
    """(id, action): new, reactivated or archived, for the rows that sync_snapshot changes."""
    curr = current.select(key).distinct()
    active = F.coalesce(F.col(available), F.lit(False))
    new = curr.join(state, key, "left_anti").withColumn("action", F.lit("new"))
    back = state.filter(~active).join(curr, key, "left_semi").select(key).withColumn("action", F.lit("reactivated"))
    gone = state.filter(active).join(curr, key, "left_anti")
    if previous is not None:
        gone = gone.join(previous.select(key).distinct(), key, "left_semi")
    return new.unionByName(back).unionByName(gone.select(key).withColumn("action", F.lit("archived")))


def price_changes(previous: DataFrame, current: DataFrame, change_date: Column, key: str = "id", value: str = "price") -> DataFrame:
    """(id, old_price, new_price, change_date) of keys on both sides with different non-null values."""
    p, c = previous.select(key, F.col(value).alias("old_price")).distinct(), current.select(key, F.col(value).alias("new_price")).distinct()
    return p.join(c, key).filter(F.col("old_price") != F.col("new_price")).withColumn("change_date", change_date)


def move_rows(source: DataFrame, target: DataFrame, key: str, moves: Column) -> tuple[DataFrame, DataFrame]:
    """(source, target) after rows with `moves` went over; rows that the target has already only leave. The columns that
    both have are moved."""
    shared = common_columns(target, source)
    moved = source.filter(F.coalesce(moves, F.lit(False)))
    arriving = moved.select(*shared).join(target.select(key), key, "left_anti").select(*shared)
    left = source.join(moved.select(key), key, "left_anti").select(*source.columns)
    return left, target.unionByName(arriving, allowMissingColumns=True)


def restore_rows(queue: DataFrame, target: DataFrame, parent: DataFrame, key: str, ready: Column) -> tuple[DataFrame, DataFrame]:
    """(queue, target) after ready rows with a parent went back: missing ones are inserted, of present ones nulls are filled."""
    rows = queue.filter(F.coalesce(ready, F.lit(False))).join(parent.select(key), key, "left_semi")
    shared = [c for c in common_columns(target, queue) if c != key]
    merged = upsert(target, rows.select(key, *shared), [key], {c: "fill" if c in shared else "keep" for c in target.columns if c != key} if set(target.columns) == {key, *shared} else {c: "fill" for c in shared})
    rest = [c for c in target.columns if c not in (key, *shared)]
    if rest:
        merged = merged.join(target.select(key, *rest), key, "left")
    return queue.join(rows.select(key), key, "left_anti").select(*queue.columns), merged.select(*target.columns)


def cascade_delete(parent: DataFrame, child: DataFrame, key: str, bad: DataFrame) -> tuple[DataFrame, DataFrame]:
    ids = bad.select(key).distinct()
    return parent.join(ids, key, "left_anti"), child.join(ids, key, "left_anti")


def fallback_join(rows: DataFrame, dimension: DataFrame, levels: Sequence[str], drop_order: Sequence[str], key: str, unknown: str = "") -> DataFrame:
    """rows with the dimension's key of the finest level that hits: all levels first, then drop_order's are blanked in turn.

    Rows are looked up by their distinct addresses: these are exploded into candidates, which carry one digest instead of
    all levels through the shuffle, and the levels themselves confirm a hit. The best candidate is the one of least level."""
    addresses = rows.select(*levels).distinct()
    blanked: list[str] = []
    candidates = []
    for n in range(len(drop_order) + 1):
        at = [F.lit(unknown) if c in blanked else F.col(c) for c in levels]
        candidates.append(F.struct(F.lit(n).alias("_level"), F.xxhash64(*at).alias("_h")))
        if n < len(drop_order):
            blanked.append(drop_order[n])
    known = dimension.select(F.xxhash64(*levels).alias("_h"), F.struct(*levels).alias("_known"), key)
    probe = addresses.withColumn("_c", F.explode(F.array(*candidates))).select(*levels, "_c._level", "_c._h")
    same = F.lit(True)
    for c in levels:
        cut = len(drop_order) if c not in drop_order else drop_order.index(c)
        same = same & (F.col(f"_known.{c}") == F.when(F.col("_level") > cut, F.lit(unknown)).otherwise(F.col(c)))
    hits = probe.join(known, "_h").filter(same).groupBy(*levels).agg(F.min_by(key, "_level").alias(key))
    return rows.join(hits, list(levels), "left")


def share_of_group(df: DataFrame, group: Sequence[str], part: str) -> DataFrame:
    """(group, part, n, total, share_pct): counts per part and their share of the group's."""
    counts = df.groupBy(*group, part).agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(Window.partitionBy(*group))
    return counts.withColumn("total", total).withColumn("share_pct", F.round(F.lit(100).cast("decimal(10,0)") * F.col("n").cast("decimal(18,0)") / F.col("total").cast("decimal(18,0)"), 2).cast("double"))


def allocate_ids(existing: DataFrame, keys: DataFrame, key: str, id_col: str, start: int) -> DataFrame:
    """New (key, id) rows for keys without one: ids go on after the largest, or begin at start, in key order.

    Ranks come from a range partitioning with per-partition offsets, so that no single task numbers all keys."""
    fresh = keys.select(key).filter(F.col(key).isNotNull()).distinct().join(existing.select(key), key, "left_anti")
    last = existing.agg(F.coalesce(F.max(id_col), F.lit(start - 1)).alias("_last"))
    ranked = global_rank(fresh, [F.col(key)], "_rank")
    return ranked.crossJoin(F.broadcast(last)).select(key, (F.col("_last") + F.col("_rank")).alias(id_col))


def global_rank(df: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """Consecutive numbers from 1 in the given order (unique): a range sort, then each partition's rows count on from the
    rows of the partitions before it. No task sees more than its range."""
    placed = cut_lineage(df.orderBy(*order).withColumn("_m", F.monotonically_increasing_id()), "rank")
    placed = placed.withColumn("_p", F.shiftright("_m", 33)).withColumn("_i", F.col("_m").bitwiseAND(F.lit((1 << 33) - 1)))
    counts = placed.groupBy("_p").agg(F.count(F.lit(1)).alias("_n"))
    base = counts.withColumn("_base", F.coalesce(F.sum("_n").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).select("_p", "_base")
    return placed.join(base, "_p").withColumn(name, F.col("_base") + F.col("_i") + 1).select(*df.columns, name)


def within_pairs(df: DataFrame, group: str, key: str, equal: Sequence[str] = ()) -> DataFrame:
    """(a, b) rows of each group with a.key < b.key and equal values in the columns of `equal`, as structs.

    The columns of `equal` are part of the join's key, so that a large group is cut into its classes before any pair is
    made; adaptive execution splits a class that is still large. Nulls in them equal nothing."""
    whole = F.struct(*df.columns)
    on = [f"_g{k}" for k in range(1 + len(equal))]
    keys = [F.col(c).alias(o) for o, c in zip(on, (group, *equal), strict=True)]
    left, right = df.select(*keys, whole.alias("a")), df.select(*keys, whole.alias("b"))
    return left.join(right, on).filter(F.col(f"a.{key}") < F.col(f"b.{key}")).select(F.col("_g0").alias(group), "a", "b")


def band_pairs(left: DataFrame, right: DataFrame, group: str, key: str, equal: Sequence[str], bin_: str) -> DataFrame:
    """(group, a, b) rows of left and right as structs with a.key < b.key, of one group, with equal values in `equal`, that lie
    in the same or in neighbouring bins.

    bin_: a column of bin numbers, longs; a row whose bin is null pairs with nothing. Values that are near must not be more than
    one bin apart. Bins are part of the join's key, so that what is looked at grows with the pairs that are near, not with the
    square of a group. Nulls in group or `equal` equal nothing."""
    on = [f"_g{k}" for k in range(1 + len(equal))]
    keys = [F.col(c).alias(o) for o, c in zip(on, (group, *equal), strict=True)]
    bins = F.sequence(F.col(bin_) - 1, F.col(bin_) + 1)
    # Structs are made after the join: it then compares plain columns, which costs far less a pair.
    plain = lambda df, side: [F.col(c).alias(f"_{side}_{c}") for c in df.columns]
    whole = lambda df, side: F.struct(*[F.col(f"_{side}_{c}").alias(c) for c in df.columns]).alias(side)
    a = left.select(*keys, F.explode(bins).alias("_bin"), *plain(left, "a"))
    b = right.select(*keys, F.col(bin_).alias("_bin"), *plain(right, "b"))
    met = a.join(b, [*on, "_bin"]).filter(F.col(f"_a_{key}") < F.col(f"_b_{key}"))
    return met.select(F.col("_g0").alias(group), whole(left, "a"), whole(right, "b"))


def split_views(df: DataFrame, by: dict[str, Sequence[str]]) -> dict[tuple[str, ...], DataFrame]:
    """One lazily filtered view for each combination of values. To count or write all of them use split_counts or a write
    partitioned by the columns: both are one pass."""
    out: dict[tuple[str, ...], Column] = {(): F.lit(True)}
    for column, values in by.items():
        out = {(*k, v): cond & (F.col(column) == v) for k, cond in out.items() for v in values}
    return {k: df.filter(cond) for k, cond in out.items()}


def split_counts(df: DataFrame, by: dict[str, Sequence[str]]) -> DataFrame:
    """Rows of every combination of the listed values that has any, in one pass."""
    kept = F.lit(True)
    for column, values in by.items():
        kept = kept & F.col(column).isin(*values)
    return df.filter(kept).groupBy(*by).agg(F.count(F.lit(1)).alias("n"))


def drop_older(df: DataFrame, ts: str, cutoff: Column) -> DataFrame:
    return df.filter(F.coalesce(F.col(ts) >= cutoff, F.lit(True)))


def top_counts(df: DataFrame, column: str, n: int) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("cnt")).orderBy(F.desc("cnt"), column).limit(n)


def chunks(df: DataFrame, order: Sequence[Column], size: int, column: str = "chunk") -> DataFrame:
    """df with the number of its chunk of `size` rows in the given order (unique), from 0."""
    return global_rank(df, order, "_rank").withColumn(column, F.floor((F.col("_rank") - 1) / size).cast("long")).drop("_rank")


def delete_plan(df: DataFrame, ts: str, cutoff: Column, order: Sequence[Column], size: int) -> DataFrame:
    """(chunk, rows, first_ts, last_ts): what a delete of the rows before the cutoff would remove, in chunks of `size`."""
    old = chunks(df.filter(F.col(ts) < cutoff), [F.col(ts), *order], size)
    return old.groupBy("chunk").agg(F.count(F.lit(1)).alias("rows"), F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts"))


def value_preview(before: DataFrame, after: DataFrame, column: str) -> DataFrame:
    """(value, before, after): how often each value of a column stands in a table before and after a change."""
    count = lambda df, name: df.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias(name))
    b, a = count(before, "before"), count(after, "after").withColumnRenamed("value", "_v")
    return b.join(a, b["value"].eqNullSafe(a["_v"]), "full_outer").select(F.coalesce("value", "_v").alias("value"), F.coalesce("before", F.lit(0)).alias("before"), F.coalesce("after", F.lit(0)).alias("after"))


def column_facts(df: DataFrame, facts: dict[str, str]) -> DataFrame:
    """(column, type, expected, present, matches, filled, fitting) of the expected columns, and bool_and of matches over them as
    all_match. filled counts the values that are there, fitting those that can be read as the expected type."""
    have = {f.name: f.dataType.simpleString() for f in df.schema}

    def read(c: str, t: str) -> Column:
        value = df[c].try_cast(t)
        whole = have[c] == "string" and t in ("tinyint", "smallint", "int", "bigint")
        return F.when(df[c].rlike("[0-9]"), value) if whole else value  # a cast that fails is slow

    def fact(c: str, t: str) -> Column:
        known = [F.lit(c).alias("column"), F.lit(have.get(c)).cast("string").alias("type"), F.lit(t).alias("expected"), F.lit(c in have).alias("present"), F.lit(have.get(c) == t).alias("matches")]
        counts = [F.count(df[c]), F.count(read(c, t))] if c in have else [F.lit(0).cast("bigint")] * 2
        return F.struct(*known, counts[0].alias("filled"), counts[1].alias("fitting"))

    rows = df.agg(F.array(*[fact(c, t) for c, t in facts.items()]).alias("_f")).select(F.explode("_f").alias("_f")).select("_f.*")
    return rows.withColumn("all_match", F.bool_and("matches").over(Window.partitionBy()))
