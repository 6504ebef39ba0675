"""The daily snapshot pipeline as streams: a file source, micro-batches that merge into versioned tables, event dedup."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..lineage import checkpoint_root, cut_lineage
from ..operators.relational import insert_absent, pick_one, sync_snapshot, union_by_name
from ..storage import Database


def snapshot_stream(spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int = 1) -> DataFrame:
    """Snapshot files as they arrive; a batch is a day."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def sync_stream(stream: DataFrame, db: Database, table: str, state_schema: T.StructType, checkpoint: str, key: str = "id", date: str = "snapshot_date") -> StreamingQuery:
    """Merges every batch's days, in order, into the state table. A batch that runs again finds its work done."""

    def merge(batch: DataFrame, _: int) -> None:
        for (day,) in batch.select(date).distinct().orderBy(date).collect():
            state = db.read(table, state_schema)
            db.replace(table, sync_snapshot(state, batch.filter(F.col(date) == F.lit(day)), F.lit(day), key=key, archive_scope="active"))

    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def unprocessed_stream(stream: DataFrame, db: Database, processed: str, schema: T.StructType, keys: list[str], work: Callable[[DataFrame, DataFrame], DataFrame], out: str, checkpoint: str) -> StreamingQuery:
    """New rows against history: work(new, old) is appended to `out`, and the new rows join the history."""

    def step(batch: DataFrame, _: int) -> None:
        old = db.read(processed, schema)
        new = cut_lineage(insert_absent(old, batch.select(*schema.names), keys), "new")
        found = work(new, old)
        # Both appends are one publication: a batch that runs again finds its rows in the history and adds nothing.
        db.publish({out: found, processed: new}, append=True)

    return stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def drained(stream: DataFrame, mode: str = "append", keys: list[str] | None = None) -> DataFrame:
    """What a stream gives for all that is there now, as a table: each batch is written to the shared folder. mode "update":
    a later batch's row replaces the earlier one of its keys."""
    parts: list[DataFrame] = []
    checkpoint = f"{checkpoint_root(stream.sparkSession).rstrip('/')}/stream-{uuid.uuid4().hex}"
    keep = lambda batch, n: parts.append(cut_lineage(batch.withColumn("_batch", F.lit(n)), "batch"))
    stream.writeStream.foreachBatch(keep).outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    rows = union_by_name(*parts) if parts else stream.sparkSession.createDataFrame([], stream.schema).withColumn("_batch", F.lit(0))
    return (pick_one(rows, keys, [F.desc("_batch")]) if keys else rows).drop("_batch")


def distinct_events(stream: DataFrame, keys: list[str], ts: str, late: str = "2 days") -> DataFrame:
    """Each event once, as long as its repeats come within the watermark."""
    return stream.withWatermark(ts, late).dropDuplicatesWithinWatermark(keys)


def windowed_counts(stream: DataFrame, ts: str, width: str, by: list[str], late: str = "1 day") -> DataFrame:
    return stream.withWatermark(ts, late).groupBy(F.window(ts, width), *by).agg(F.count(F.lit(1)).alias("n"))
