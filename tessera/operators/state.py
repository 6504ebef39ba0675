"""Snapshot state in Spark's own bucketed tables: a day's merge shuffles the snapshot alone and writes what changed.

The state is two tables with equal buckets, sorted by key within them: a base of full rows, and a delta with one row for each
key whose dates or availability differ from the base, or that the base lacks. Their joins need no exchange. A day's merge
reads of the base only the key, the dates and the availability, and writes a new delta; the base is rewritten only when the
delta has outgrown a share of it. So a day's writing follows the changes since the last fold, not the state.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..lineage import checkpoint_root
from .relational import first_of

DATES = ("added_date", "archived_date")


class BucketedState:
    """The state of one listing source under a table name.

    Rows have the key, added_date, archived_date, the availability column, and fields that a row keeps as it came in. Each
    key is one row, null keys are left out. A generation's tables join the catalog after their files are complete, and a
    merge that dies before that leaves the last generation as it was. Merges of one state come one after the other."""

    def __init__(self, spark: SparkSession, name: str, key: str = "id", available: str = "available", buckets: int | None = None, fold_share: float = 0.2, root: str | None = None) -> None:
        self.spark, self.name, self.key, self.available = spark, name, key, available
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.fold_share, self.root = fold_share, root or checkpoint_root(spark)

    def _generation(self, kind: str) -> int:
        """The newest generation of base or delta, 0 if there is none."""
        prefix = f"{self.name}_{kind}_"
        found = [t.name for t in self.spark.catalog.listTables(pattern=f"{prefix}*")]
        return max((int(t.removeprefix(prefix)) for t in found if t.removeprefix(prefix).isdigit()), default=0)

    def _table(self, kind: str, generation: int) -> DataFrame:
        return self.spark.table(f"{self.name}_{kind}_{generation:08d}")

    def _write(self, df: DataFrame, kind: str, generation: int) -> None:
        """Tasks that hold a bucket each, as the joins leave them, write one file each; nothing is dealt anew."""
        path = f"{self.root.rstrip('/')}/{self.name}-{kind}-{generation:08d}-{uuid.uuid4().hex}"
        df.write.bucketBy(self.buckets, self.key).sortBy(self.key).option("path", path).saveAsTable(f"{self.name}_{kind}_{generation:08d}")

    def create(self, state: DataFrame) -> None:
        """The first base: state's rows, of a repeated key the one that sorts first."""
        if self._generation("base"):
            raise ValueError(f"state {self.name} exists")
        self._write(first_of(state.filter(F.col(self.key).isNotNull()), [self.key]).repartition(self.buckets, self.key), "base", 1)

    @property
    def base(self) -> DataFrame:
        return self._table("base", self._generation("base"))

    @property
    def delta(self) -> DataFrame | None:
        """The delta of the newest base; an older one belongs to a base that is folded."""
        base, delta = self._generation("base"), self._generation("delta")
        return self._table("delta", delta) if delta > base else None

    def _fields(self) -> list[str]:
        return [c for c in self.base.columns if c not in (self.key, *DATES, self.available)]

    def read(self) -> DataFrame:
        """The whole state, in the base's columns."""
        base, delta = self.base, self.delta
        if delta is None:
            return base
        moved = (*DATES, self.available)
        d = delta.filter("not is_new").select(self.key, *[F.col(c).alias(f"_d_{c}") for c in moved], F.lit(True).alias("_d"))
        now = {c: F.when(F.col("_d"), F.col(f"_d_{c}")).otherwise(F.col(c)).alias(c) for c in moved}
        old = base.join(d.hint("merge"), self.key, "left").select(*[now.get(c, F.col(c)) for c in base.columns])
        return old.unionByName(delta.filter("is_new").select(*base.columns))

    def changes(self, current: DataFrame, snapshot_date: Column, previous: DataFrame | None = None) -> DataFrame:
        """The next delta: the rows of the present one as they are or become, and those that the snapshot changes.

        New keys come in, archived ones that return are active again, active ones that vanish are archived; with previous,
        only those that the previous snapshot had. `action` says what the snapshot did, null for rows of older changes.

        Three joins keep the state's buckets and deal the snapshot to them: the base's rows that change or have changed, the
        delta's own rows, and the snapshot's keys that neither has."""
        base, delta, key, moved = self.base, self.delta, self.key, (*DATES, self.available)
        types = {c: base.schema[c].dataType for c in base.columns}
        fields = self._fields()
        curr = first_of(current.filter(F.col(key).isNotNull()).select(*[(F.col(c) if c in current.columns else F.lit(None)).cast(types[c]).alias(c) for c in (key, *fields)]), [key])
        if delta is None:
            delta = base.limit(0).select(*base.columns, F.lit(None).cast("boolean").alias("is_new"))
        own = delta.filter("is_new").select(key, *moved, *fields)
        d = delta.filter("not is_new").select(key, *[F.col(c).alias(f"_d_{c}") for c in moved], F.lit(True).alias("_d"))
        known = base.select(key, *moved).join(d.hint("merge"), key, "left")
        known = known.select(key, *[F.when(F.col("_d"), F.col(f"_d_{c}")).otherwise(F.col(c)).alias(c) for c in moved], F.col("_d").isNotNull().alias("_old"))

        def merged(rows: DataFrame, is_new: bool) -> DataFrame:
            rows = rows.join(curr.select(key, F.lit(True).alias("_curr")).hint("merge"), key, "left")
            seen = F.lit(True)
            if previous is not None:
                rows = rows.join(previous.select(key).filter(F.col(key).isNotNull()).distinct().withColumn("_prev", F.lit(True)).hint("merge"), key, "left")
                seen = F.col("_prev").isNotNull()
            active, here = F.coalesce(F.col(self.available), F.lit(False)), F.col("_curr").isNotNull()
            rows = rows.withColumn("action", F.when(~active & here, "reactivated").when(active & ~here & seen, "archived")).filter(F.col("action").isNotNull() | F.col("_old"))
            return rows.select(
                key,
                *[(F.col(c) if is_new else F.lit(None).cast(types[c])).alias(c) for c in fields],
                "added_date",
                F.when(F.col("action") == "archived", snapshot_date.cast(types["archived_date"])).when(F.col("action") == "reactivated", F.lit(None)).otherwise(F.col("archived_date")).alias("archived_date"),
                F.when(F.col("action").isNotNull(), F.col("action") == "reactivated").otherwise(F.col(self.available)).alias(self.available),
                F.lit(is_new).alias("is_new"),
                "action",
            )

        fresh = curr.join(base.select(key).hint("merge"), key, "left_anti").join(own.select(key).hint("merge"), key, "left_anti")
        fresh = fresh.select(key, *fields, snapshot_date.cast(types["added_date"]).alias("added_date"), F.lit(None).cast(types["archived_date"]).alias("archived_date"), F.lit(True).alias(self.available), F.lit(True).alias("is_new"), F.lit("new").alias("action"))
        return merged(known, False).unionByName(merged(own.withColumn("_old", F.lit(True)), True)).unionByName(fresh)

    def sync(self, current: DataFrame, snapshot_date: Column, previous: DataFrame | None = None) -> dict[str, int]:
        """Merges a snapshot and returns how many rows are new, reactivated and archived, and how many were written. The
        counts are observed while the delta is written, so that a merge is one pass."""
        from pyspark.sql import Observation

        seen = Observation()
        count = lambda x: F.count_if(F.col("action") == x).alias(x)
        made = self.changes(current, snapshot_date, previous).observe(seen, count("new"), count("reactivated"), count("archived"), F.count(F.lit(1)).alias("written"))
        generation = max(self._generation("base"), self._generation("delta")) + 1
        self._write(made, "delta", generation)
        return dict(seen.get)

    def fold(self, force: bool = False) -> bool:
        """Makes base and delta a new base if the delta has more than fold_share of the base's rows. Both are counted from
        file footers; the rewriting deals nothing anew."""
        delta = self.delta
        if delta is None or not (force or delta.count() > self.fold_share * self.base.count()):
            return False
        self._write(self.read(), "base", self._generation("delta") + 1)
        return True

    def drop_old(self) -> list[str]:
        """Drops the tables that the present generation has replaced; readers of those must be done. Returns their names."""
        base, delta = self._generation("base"), self._generation("delta")
        out = []
        for kind, newest in (("base", base), ("delta", delta if delta > base else None)):
            prefix = f"{self.name}_{kind}_"
            for t in self.spark.catalog.listTables(pattern=f"{prefix}*"):
                if t.name.removeprefix(prefix).isdigit() and int(t.name.removeprefix(prefix)) != newest:
                    self.spark.sql(f"DROP TABLE `{t.name}`")
                    out.append(t.name)
        return out
