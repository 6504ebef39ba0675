"""Listings as keyed state of a stream: what is new, archived and back is decided key by key when the watermark passes a day.

Days may come late, repeated or out of order up to the watermark's delay: a day is judged once no row of it can come any
more, by a timer of event time, so that the result is that of days in order. State lives in RocksDB, many keys to a state
row, as a daily snapshot names most keys: a call of the state store costs far more than a key. A batch or a timer reads and
writes the buckets of the keys that it names, and a key goes when it has been archived for long enough.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator
from typing import Any

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_EPOCH, _DAY_MS = dt.date(1970, 1, 1), 86_400_000


class Presence(StatefulProcessor):
    """The status of a bucket's keys, and their days that are not judged yet, as Arrow tables. Days are counted from 1970.

    A day that a key was seen on is judged when the watermark is past it, and the day after it too: if the key was not
    seen then, it is archived as of that day. keep_days after that its state is dropped; if it returns later it is new."""

    def __init__(self, keep_days: int) -> None:
        self.keep_days = keep_days

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.status = handle.getValueState("status", "keys binary")
        self.waiting = handle.getValueState("waiting", "keys binary")

    @staticmethod
    def read(state: Any) -> pd.DataFrame | None:
        if not state.exists():
            return None
        return pa.ipc.open_stream(bytes(state.get()[0])).read_pandas()

    @staticmethod
    def write(state: Any, rows: pd.DataFrame) -> None:
        if len(rows):
            table, sink = pa.Table.from_pandas(rows, preserve_index=False), pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, table.schema) as out:
                out.write_table(table)
            state.update((sink.getvalue().to_pybytes(),))
        elif state.exists():
            state.clear()

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        before, parts = self.read(self.waiting), []
        for pdf in rows:
            day = (pdf["day"].dt.normalize() - pd.Timestamp(_EPOCH)).dt.days.astype("int32")
            parts.append(pd.DataFrame({"id": pdf["id"], "day": day}).drop_duplicates())
        known = set() if before is None else set(before["day"].unique())
        now = pd.concat(parts if before is None else [before, *parts], ignore_index=True).drop_duplicates()
        self.write(self.waiting, now)
        for t in {int(t) for day in set(now["day"].unique()) - known for t in (day, day + 1)}:
            self.handle.registerTimer(t * _DAY_MS + 1)
        yield from ()

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        day = int(expiredTimerInfo.getExpiryTimeInMs()) // _DAY_MS
        status, waiting = self.read(self.status), self.read(self.waiting)
        here = pd.DataFrame({"id": []}) if waiting is None else waiting.loc[waiting["day"] == day, ["id"]]
        if len(here):
            self.write(self.waiting, waiting[waiting["day"] != day])
        found = []
        if status is None:
            first, changed = here["id"], False
        else:
            active, last, seen = status["active"], status["last"], status["id"].isin(here["id"])
            gone, over = ~seen & active & (last == day - 1), ~seen & ~active & (last + self.keep_days <= day)
            # A key that should have been dropped on an earlier day is new, whether or not a timer has come by.
            back, again = seen & ~active & (last + self.keep_days >= day), seen & ~active & (last + self.keep_days < day)
            found = [(status.loc[rows, "id"], action) for rows, action in ((gone, "archived"), (back, "reactivated"), (again, "new"))]
            first = here.loc[~here["id"].isin(status["id"]), "id"]
            ends = (day + self.keep_days) * _DAY_MS + 1
            if ends <= timerValues.getCurrentWatermarkInMs():  # the time to keep is past already: only days that wait can need it
                over |= gone & (True if waiting is None else ~status["id"].isin(waiting.loc[waiting["day"] > day, "id"]))
            if (gone & ~over).any():
                self.handle.registerTimer(ends)
            changed = (seen | gone | over).any()
            status = status.assign(active=(active | seen) & ~gone, last=last.mask(seen | gone, day).astype("int32"))[~over]
        if len(first):
            fresh = pd.DataFrame({"id": first, "active": True, "last": pd.Series(day, index=first.index, dtype="int32")})
            status, changed = (fresh if status is None else pd.concat([status, fresh], ignore_index=True)), True
            found.append((first, "new"))
        if status is not None and changed:
            self.write(self.status, status)
        for ids, action in found:
            if len(ids):
                yield pd.DataFrame({"id": ids.to_numpy(), "day": _EPOCH + dt.timedelta(days=day), "action": action})

    def close(self) -> None:
        pass


def presence_changes(stream: DataFrame, key: str, day: str, late_days: int = 2, keep_days: int = 90, buckets: int = 256) -> DataFrame:
    """(id, day, action) of a stream of snapshot rows: new, reactivated or archived, each once, in append mode.

    day is a date; snapshots come daily, so that a key is archived as of the day after the last one that had it. The last
    late_days days of a stream are not judged yet. Rows with a null key or day are left out. Keys are dealt by hash to
    `buckets`, of which each is one group with one row of state: more of them for many millions of keys; a stream that goes on
    from a checkpoint keeps its number. Needs PROVIDER as spark.sql.streaming.stateStore.providerClass (see use_rocksdb)."""
    kind = stream.schema[key].dataType.simpleString()
    rows = stream.filter(F.col(key).isNotNull() & F.col(day).isNotNull()).select(F.col(key).alias("id"), F.col(day).cast("timestamp").alias("day"), F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int").alias("bucket"))
    rows = rows.withWatermark("day", f"{late_days} days")
    return rows.groupBy("bucket").transformWithStateInPandas(Presence(keep_days), f"id {kind}, day date, action string", "append", "eventtime")


def use_rocksdb(spark: SparkSession) -> None:
    """Keyed state needs RocksDB as the store of streams that start from now on."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)
