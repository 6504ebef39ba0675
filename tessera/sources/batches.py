"""Address requests and answers as a data source with offsets.

A folder that the driver, the tasks and the service share holds numbered batches of requests and their answers:

    requests/<file>       one JSON object a line
    log/<number>.json     what one write published: its batches' numbers, files and rows
    answers/<batch>.json  the answers to a batch, put in place when they are complete

Writing is `rows.write.format("address_batches")`: each task stages its files, and the commit publishes all of them by one
renamed log entry, so that a write that dies has sent nothing. Reading is `readStream`: an offset is the number of the last
batch up to which all are answered, a partition is a batch. With the stream's checkpoint a run that was killed goes on at the
offset it had committed, and `round_trip` compares what was sent with what came back, batch by batch.

Files are opened through pyarrow's file systems (local, HDFS, S3, GCS). One writer at a time. A batch that the service cannot
answer at all gets an empty answer file, so that later ones are read; its requests then show as open.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, DataSourceWriter, InputPartition, WriterCommitMessage

from ..storage import Database

NAME = "address_batches"
ANSWERS = "batch bigint, internal_id bigint, answer string"


class Folder:
    """Files under a root, on whatever file system its name tells; a file appears whole or not at all."""

    def __init__(self, root: str):
        self.root = root

    def _open(self, name: str):
        from pyarrow import fs

        root = self.root
        if root.startswith("file:"):
            root = "/" + root[5:].lstrip("/")
        found, path = fs.FileSystem.from_uri(root)
        return found, f"{path.rstrip('/')}/{name}"

    def names(self, folder: str) -> list[str]:
        from pyarrow import fs

        system, path = self._open(folder)
        return sorted(i.base_name for i in system.get_file_info(fs.FileSelector(path, allow_not_found=True)) if i.is_file and not i.base_name.startswith("."))

    def read(self, name: str) -> str:
        system, path = self._open(name)
        with system.open_input_stream(path) as f:
            return f.read().decode()

    def write(self, name: str, text: str) -> None:
        folder, _, last = name.rpartition("/")
        system, path = self._open(folder)
        system.create_dir(path, recursive=True)
        draft = f"{path}/.{last}-{uuid.uuid4().hex}"
        with system.open_output_stream(draft) as f:
            f.write(text.encode())
        system.move(draft, f"{path}/{last}")

    def delete(self, name: str) -> None:
        system, path = self._open(name)
        system.delete_file(path)

    def sent(self) -> list[dict]:
        """(batch, file, rows) of all published batches in order."""
        return [b for n in self.names("log") for b in json.loads(self.read(f"log/{n}"))]

    def answered(self) -> set[int]:
        return {int(n.split(".")[0]) for n in self.names("answers")}


@dataclass
class Staged(WriterCommitMessage):
    files: list[tuple[str, int]]


class RequestWriter(DataSourceWriter):
    def __init__(self, folder: Folder, per_batch: int, columns: list[str]):
        self.folder, self.per_batch, self.columns = folder, per_batch, columns

    def write(self, iterator: Iterator) -> Staged:
        files: list[tuple[str, int]] = []
        lines: list[str] = []

        def stage() -> None:
            name = f"{uuid.uuid4().hex}.json"
            self.folder.write(f"requests/{name}", "".join(lines))
            files.append((name, len(lines)))
            lines.clear()

        for row in iterator:
            lines.append(json.dumps(dict(zip(self.columns, row, strict=True)), ensure_ascii=False, default=str) + "\n")
            if len(lines) == self.per_batch:
                stage()
        if lines:
            stage()
        return Staged(files)

    def commit(self, messages: list[Staged | None]) -> None:
        entries, done = self.folder.names("log"), self.folder.sent()
        first = done[-1]["batch"] + 1 if done else 1
        new = [x for m in messages if m for x in m.files]
        if new:
            self.folder.write(f"log/{len(entries) + 1:08d}.json", json.dumps([{"batch": first + k, "file": f, "rows": n} for k, (f, n) in enumerate(new)]))

    def abort(self, messages: list[Staged | None]) -> None:
        for f, _ in (x for m in messages if m for x in m.files):
            self.folder.delete(f"requests/{f}")


class Batch(InputPartition):
    def __init__(self, number: int):
        super().__init__(number)


class AnswerReader(DataSourceStreamReader):
    def __init__(self, folder: Folder):
        self.folder = folder

    def initialOffset(self) -> dict:
        return {"batch": 0}

    def latestOffset(self, *_) -> dict:
        answered, last = self.folder.answered(), 0
        while last + 1 in answered:
            last += 1
        return {"batch": last}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        return [Batch(n) for n in range(start["batch"] + 1, end["batch"] + 1)]

    def read(self, partition: Batch) -> Iterator[tuple]:
        for line in self.folder.read(f"answers/{partition.value:08d}.json").splitlines():
            row = json.loads(line)
            yield partition.value, row["internal_id"], row["answer"]


class AddressBatches(DataSource):
    """Options: path, and for writing perBatch (requests a batch)."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return ANSWERS

    def writer(self, schema, overwrite: bool) -> RequestWriter:
        return RequestWriter(Folder(self.options["path"]), int(self.options.get("perBatch", "500")), schema.fieldNames())

    def streamReader(self, schema) -> AnswerReader:
        return AnswerReader(Folder(self.options["path"]))


def register(spark: SparkSession) -> None:
    spark.dataSource.register(AddressBatches)


def sent_requests(spark: SparkSession, path: str) -> DataFrame:
    """(batch, internal_id) of all published requests; files that no log entry names are not among them."""
    batches = Folder(path).sent()
    if not batches:
        return spark.createDataFrame([], "batch bigint, internal_id bigint")
    root = path.rstrip("/")
    log = spark.read.schema("batch bigint, file string, rows bigint").json(f"{root}/log").select("batch", "file")
    rows = spark.read.schema("internal_id bigint").json([f"{root}/requests/{b['file']}" for b in batches])
    return rows.withColumn("file", F.element_at(F.split(F.input_file_name(), "/"), -1)).join(log, "file").select("batch", "internal_id")


def send(rows: DataFrame, path: str, per_batch: int = 500) -> None:
    """Sends the requests (internal_id, prompt) whose id was not sent before, each id once; a run that is repeated sends
    nothing twice. Rows without an id are left out."""
    spark = rows.sparkSession
    register(spark)
    new = rows.filter("internal_id is not null").dropDuplicates(["internal_id"]).join(sent_requests(spark, path).select("internal_id"), "internal_id", "left_anti")
    new.select("internal_id", "prompt").write.format(NAME).option("path", path).option("perBatch", per_batch).mode("append").save()


def answer(spark: SparkSession, path: str, service: Callable[[list[dict]], list[str | None]]) -> int:
    """Lets the service answer every open batch, a task each: service(requests) gives an answer or None for each request.
    A batch's answers are put in place as a whole, so a task that is repeated or lost does no harm. The number of batches."""
    folder = Folder(path)
    done = folder.answered()
    todo = [(b["batch"], b["file"]) for b in folder.sent() if b["batch"] not in done]
    if not todo:
        return 0

    def run(batches):
        import pyarrow as pa

        for part in batches:
            for number, name in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                asked = [json.loads(line) for line in folder.read(f"requests/{name}").splitlines()]
                given = service(asked)
                if len(given) != len(asked):
                    raise ValueError(f"batch {number}: {len(asked)} requests, {len(given)} answers")
                lines = [json.dumps({"internal_id": q["internal_id"], "answer": a}, ensure_ascii=False) + "\n" for q, a in zip(asked, given, strict=True) if a is not None]
                folder.write(f"answers/{number:08d}.json", "".join(lines))
            yield pa.RecordBatch.from_arrays([part.column(0)], names=["batch"])

    return spark.createDataFrame(todo, "batch bigint, file string").repartition(len(todo), "batch").mapInArrow(run, "batch bigint").count()


def receive(db: Database, path: str, table: str, checkpoint: str) -> None:
    """Appends the answers that have come since the checkpoint to a table (batch, internal_id, answer). A batch that was
    stored, but not yet checkpointed when a run was killed, is read again and adds nothing."""
    spark = db.spark
    register(spark)
    stream = spark.readStream.format(NAME).option("path", path).load()
    schema = stream.schema
    store = lambda rows, _: db.append_absent(table, rows, ["batch", "internal_id"], schema)
    stream.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def round_trip(spark: SparkSession, path: str, received: DataFrame) -> DataFrame:
    """(batch, sent, received, open, unasked) of each batch: how many requests went out, answers came back, requests have no
    answer and answers no request. All is well where open and unasked are 0 and received is not more than sent."""
    asked = sent_requests(spark, path).groupBy("batch", "internal_id").agg(F.count(F.lit(1)).alias("sent"))
    back = received.groupBy("batch", "internal_id").agg(F.count(F.lit(1)).alias("received"))
    both = asked.join(back, ["batch", "internal_id"], "full_outer").na.fill(0, ["sent", "received"])
    return both.groupBy("batch").agg(F.sum("sent").alias("sent"), F.sum("received").alias("received"), F.count_if(F.col("received") == 0).alias("open"), F.count_if(F.col("sent") == 0).alias("unasked"))
