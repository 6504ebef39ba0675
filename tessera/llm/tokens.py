"""Token counts by separator scan over flat token files without an index.

A token file is nothing but token ids of fixed width, document after document, each ended by a separator. It is read in
blocks that ignore documents. A vectorised search finds the separators of a block; a block's summary is its separator count,
the lengths between its separators, and what stands before the first and after the last. A prefix scan over the summaries
stitches the documents that cross blocks and numbers them.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Callable, Iterator
from typing import BinaryIO
from urllib.parse import quote

import numpy as np
import pyarrow as pa
import pyarrow.fs
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import stored

#: A public byte-level vocabulary as ranks, the pattern that splits text before merging, and its free id.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SEPARATOR = 50256

BLOCK_TOKENS = 1 << 16
#: Bytes of a token file that one task reads, and blocks whose summaries one task of the prefix scan combines.
RANGE_BYTES, CHUNK_BLOCKS = 128 << 20, 1024
_BLOCK_SCHEMA = pa.schema([("file", pa.string()), ("block", pa.int64()), ("tokens", pa.binary())])
#: Characters that are encoded at once; a longer text is encoded in pieces that end before a space after a letter or digit.
PIECE = 1 << 18
#: Runs of white space (as Unicode has it) that the pattern's engine, which tries all of their ends, is spared.
WHITE_WORD = 1 << 12
WHITE_RUN = re.compile(rf"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{{{WHITE_WORD},}}")
_ENCODERS: dict[int, tiktoken.Encoding] = {}  # by the vocabulary's content


def load_vocabulary(path: str = VOCABULARY) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}


def _encoder(ranks: dict[bytes, int]) -> tiktoken.Encoding:
    key = hash(frozenset(ranks.items()))
    if key not in _ENCODERS:
        _ENCODERS[key] = tiktoken.Encoding("vocabulary", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _ENCODERS[key]


def encode(encoder: tiktoken.Encoding, text: str) -> np.ndarray:
    """All ids of a text. A long text is cut where the pattern splits anyway: before a space between two letters, and around
    long runs of white space. Of a run, the pattern takes all but the last character as one word, and all at a text's end;
    the rest goes on with what follows."""
    parts: list[int] = []
    at = 0
    for run in WHITE_RUN.finditer(text) if len(text) > WHITE_WORD else ():
        parts += _pieces(encoder, text, at, run.start())
        at = run.end() if run.end() == len(text) else run.end() - 1
        parts += encoder._encode_single_piece(text[run.start() : at])
    parts += _pieces(encoder, text, at, len(text))
    return np.asarray(parts, np.uint32)


def _pieces(encoder: tiktoken.Encoding, text: str, at: int, stop: int) -> list[int]:
    parts = []
    while at < stop:
        end = min(stop, at + PIECE)
        while end < stop and not (text[end] == " " and text[end - 1].isalpha() and text[end + 1 : end + 2].isalpha()):
            end += 1
        parts += encoder.encode_ordinary(text[at:end])
        at = end
    return parts


def token_blocks(docs: DataFrame, id_col: str, text_col: str, ranks: dict[bytes, int], separator: int = SEPARATOR, block_tokens: int = BLOCK_TOKENS, width: int = 2) -> DataFrame:
    """(file, block, tokens, ids): each partition's documents as one flat token stream, cut into blocks.

    ids names the documents whose separators stand in the block, in order; the scan does not look at it."""
    dtype = {2: "<u2", 4: "<u4"}[width]
    largest = max([separator, *ranks.values()])
    if largest >> (8 * width):
        raise ValueError(f"ids up to {largest} do not fit into {width} bytes")
    kind = docs.schema[id_col].dataType.simpleString()
    names = ["file", "block", "tokens", "ids"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, file = _encoder(ranks), str(TaskContext.get().partitionId())
        held: list[np.ndarray] = []
        pending: list[tuple[int, object]] = []  # places of separators in the stream, and the documents they end
        size = start = block = 0

        def cut(last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal held, size, start, block, pending
            flat = np.concatenate(held) if held else np.zeros(0, np.uint32)
            while len(flat) >= block_tokens or (last and len(flat)):
                piece, flat = flat[:block_tokens], flat[block_tokens:]
                start += len(piece)
                ended = [d for p, d in pending if p < start]
                pending = pending[len(ended) :]
                yield pa.RecordBatch.from_arrays([pa.array([file]), pa.array([block], pa.int64()), pa.array([piece.astype(dtype).tobytes()], pa.binary()), pa.array([ended], pa.list_(id_type))], names=names)
                block += 1
            held, size = ([flat] if len(flat) else []), len(flat)

        for batch in batches:
            id_type = batch.column(0).type
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = encode(encoder, text.as_py() or "")
                held += [ids, np.array([separator], np.uint32)]
                size += len(ids) + 1
                pending.append((start + size - 1, key))
                if size >= 4 * block_tokens:
                    yield from cut(False)
        yield from cut(True)

    return docs.select(F.col(id_col), F.col(text_col).cast("string")).mapInArrow(run, f"file string, block long, tokens binary, ids array<{kind}>")


def open_file(path: str) -> BinaryIO:
    """A file of a path as Spark names it, on any file system that pyarrow knows (local, HDFS, S3, GCS)."""
    scheme, colon, rest = path.partition(":")
    system, name = pyarrow.fs.FileSystem.from_uri(f"{scheme}:{quote(rest, safe='/:@')}" if colon else path)
    return system.open_input_file(name)


def read_token_files(spark: SparkSession, path: str, width: int = 2, block_tokens: int = BLOCK_TOKENS, opened: Callable[[str], BinaryIO] = open_file) -> DataFrame:
    """(file, block, tokens) of flat token files of any size, in blocks. Spark lists the files; tasks read ranges of
    RANGE_BYTES of them through `opened`, block by block, so a large file is shared by many tasks and none holds more than a
    block. A rest shorter than a token at a file's end is an error. A job runs to count the ranges."""
    step = block_tokens * width
    span = max(1, RANGE_BYTES // step) * step

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, length, first in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if length % width:
                    raise ValueError(f"{name} has {length} bytes, no multiple of {width}")
                with opened(name) as f:
                    f.seek(first)
                    for k in range(first, min(length, first + span), step):
                        part = f.read(min(step, length - k))
                        if len(part) < min(step, length - k):
                            raise OSError(f"{name} ends before its {length} bytes")
                        yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([k // step], pa.int64()), pa.array([part], pa.binary())], schema=_BLOCK_SCHEMA)

    files = spark.read.format("binaryFile").load(path).select("path", "length").filter("length > 0")
    count = files.agg(F.sum(F.ceil(F.col("length") / F.lit(span)))).first()[0] or 1
    ranges = files.select("path", "length", F.explode(F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(span).cast("long"))).alias("first"))
    return ranges.repartition(int(count)).mapInArrow(run, "file string, block long, tokens binary")


def _scanned(parts: DataFrame, keys: list[str], order: str) -> DataFrame:
    """parts (n, size, tail) with what stands before each among those of its keys: first (separators), any (whether there is
    one), carry (tokens since the last one, or all), and rest, the tokens since the last separator at its own end."""
    order_by = Window.partitionBy(*keys).orderBy(order)
    before = order_by.rowsBetween(Window.unboundedPreceding, -1)
    # Sizes of parts without separator add up after the tail of the last part that has one.
    parts = parts.withColumn("first", F.coalesce(F.sum("n").over(before), F.lit(0))).withColumn("left", F.coalesce(F.last(F.when(F.col("n") > 0, F.col("tail")), True).over(before), F.lit(0)))
    within = Window.partitionBy(*keys, "first").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("carry", F.col("left") + F.coalesce(F.sum(F.when(F.col("n") == 0, F.col("size"))).over(within), F.lit(0)))
    rest = F.when(F.col("n") > 0, F.col("tail")).otherwise(F.col("size") + F.col("carry"))
    return parts.withColumn("any", F.col("first") > 0).withColumn("rest", rest).drop("left")


def separator_scan(blocks: DataFrame, separator: int = SEPARATOR, width: int = 2) -> DataFrame:
    """(file, ordinal, n_tokens, block, place): every document of the files, numbered from 0, with its tokens without the
    separator; block and place tell which separator ends it. What stands after a file's last separator is a document
    without one (place -1); if nothing stands there, none is made.

    blocks: file, block, tokens; a file's blocks are numbered without gaps, and empty ones may be among them. Blocks with
    null tokens count as empty. An empty table gives an empty result; other columns are ignored.

    The prefix scan has two levels: within chunks of CHUNK_BLOCKS blocks, then over one row a chunk. So of a file, however
    large, one task sees only the chunks' sums. The summaries are written, so jobs run while the result is built."""
    dtype = {2: "<u2", 4: "<u4"}[width]
    names = ["file", "block", "n", "size", "head", "tail", "inner"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, size, head, tail, inner = [], [], [], [], []
            for raw in batch.column(2):
                ids = np.frombuffer(raw.as_buffer(), dtype) if raw.is_valid else np.zeros(0, dtype)
                at = np.flatnonzero(ids == separator)
                n.append(len(at))
                size.append(len(ids))
                head.append(int(at[0]) if len(at) else len(ids))
                tail.append(len(ids) - 1 - int(at[-1]) if len(at) else len(ids))
                inner.append(np.diff(at) - 1)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(pa.array(c, pa.int64()) for c in (n, size, head, tail)), pa.array(inner, pa.list_(pa.int64()))], names=names)

    summary = blocks.select("file", "block", "tokens").mapInArrow(run, "file string, block long, n long, size long, head long, tail long, inner array<long>")
    summary = stored(summary.withColumn("chunk", F.floor(F.col("block") / F.lit(CHUNK_BLOCKS))), "token-summaries")
    slim = _scanned(summary.drop("head", "inner"), ["file", "chunk"], "block")
    chunks = slim.groupBy("file", "chunk").agg(F.sum("n").alias("n"), F.max_by("rest", "block").alias("rest"), F.max("block").alias("last"))
    # A chunk is like a block: without separators its size is its rest, with some its tail is.
    chunks = _scanned(chunks.withColumn("size", F.col("rest")).withColumn("tail", F.col("rest")).drop("rest"), ["file"], "chunk")
    before = chunks.select("file", "chunk", F.col("first").alias("chunk_first"), F.col("carry").alias("chunk_carry"))
    at = slim.select("file", "chunk", "block", F.col("first"), F.col("carry"), F.col("any")).join(before, ["file", "chunk"])
    at = at.select("file", "block", (F.col("first") + F.col("chunk_first")).alias("first"), (F.col("carry") + F.when(F.col("any"), 0).otherwise(F.col("chunk_carry"))).alias("carry"))
    with_any = summary.filter("n > 0").select("file", "block", "head", "inner").join(at, ["file", "block"])
    lengths = F.concat(F.array(F.col("head") + F.col("carry")), F.col("inner"))
    found = with_any.select("file", "block", "first", F.posexplode(lengths).alias("place", "n_tokens")).select("file", (F.col("first") + F.col("place")).alias("ordinal"), "n_tokens", "block", F.col("place").cast("long").alias("place"))
    end = chunks.groupBy("file").agg(F.max_by(F.struct("first", "n", "rest", "last"), "chunk").alias("e")).select("file", "e.*")
    open_end = end.select("file", (F.col("first") + F.col("n")).alias("ordinal"), F.col("rest").alias("n_tokens"), F.col("last").alias("block"), F.lit(-1).cast("long").alias("place")).filter("n_tokens > 0")
    return found.unionByName(open_end)


def count_tokens(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """(doc_id, n_tokens), one row per row of docs: the texts as token blocks, then the separator scan over these.

    A null or empty text has 0 tokens. Repeated rows and ids are counted one by one, long texts whole, and an empty table
    gives an empty result; other columns are ignored."""
    streams = token_blocks(docs, id_col, text_col, load_vocabulary(vocabulary))
    kept = stored(streams, "token-blocks")
    ends = kept.select("file", "block", F.posexplode("ids").alias("place", "doc_id"))
    return separator_scan(kept).join(ends.withColumn("place", F.col("place").cast("long")), ["file", "block", "place"]).select("doc_id", "n_tokens")
