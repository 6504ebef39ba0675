"""Benchmark decontamination by pigeonhole edit matching.

A test item may stand in a document with up to an error budget of edits. Cut into one piece more than that, at least one
piece stands unharmed: exact hits of pieces, found by one automaton over all of them, give the places, and Myers'
bit-parallel distance verifies each. An item too short for any edit has to stand there as whole words.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ALNUM, folded, text_slices

#: One edit is allowed for so many bytes of an item; so an item's pieces are about as long.
BYTES_PER_EDIT = 20
#: Bytes of item texts whose automaton a task holds; more items are looked for in further passes over the documents.
BLOCK_BYTES = 4 << 20


def normalised(raw: np.ndarray, offsets: np.ndarray) -> list[str]:
    """Each text in lower case with every run of other characters than letters and digits as one space, one character a byte."""
    raw = folded(raw)
    word = ALNUM[raw]
    keep = word.copy()
    keep[1:] |= word[:-1]  # the first other byte after a word stays, as a space
    keep[offsets[:-1][offsets[:-1] < len(raw)]] = word[offsets[:-1][offsets[:-1] < len(raw)]]
    at = np.concatenate([[0], np.cumsum(keep)])[offsets]
    flat = np.where(word, raw, 0x20)[keep].astype(np.uint8).tobytes().decode("latin-1")
    return [flat[a:b].rstrip() for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]


def distance(item: str, text: str, most: int) -> tuple[int, int] | None:
    """(edits, end) of the best match of item inside text if it has at most `most` edits: Myers' bit-parallel recurrence
    with a free start; ties go to the first end."""
    n = len(item)
    masks: dict[str, int] = {}
    for k, c in enumerate(item):
        masks[c] = masks.get(c, 0) | 1 << k
    full, top = (1 << n) - 1, 1 << (n - 1)
    pv, mv, score, best = full, 0, n, None
    for end, c in enumerate(text, 1):
        eq = masks.get(c, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph, mh = mv | ~(xh | pv) & full, pv & xh
        score += bool(ph & top) - bool(mh & top)
        ph, mh = ph << 1 & full, mh << 1 & full
        pv, mv = mh | ~(xv | ph) & full, ph & xv
        if score <= most and (best is None or score < best[0]):
            best = (score, end)
    return best


class Items:
    """Normalised test items, their pieces and the automaton of these."""

    def __init__(self, items: list[tuple[int, str]], bytes_per_edit: int = BYTES_PER_EDIT):
        self.items, pieces = {}, {}
        for key, text in items:
            text = next(iter(normalised(np.frombuffer(text.encode(), np.uint8), np.array([0, len(text.encode())]))), "")
            if not text:
                continue
            budget = len(text) // bytes_per_edit
            self.items[key] = (text, budget)
            cuts = [len(text) * k // (budget + 1) for k in range(budget + 2)]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                pieces.setdefault(text[a:b], []).append((key, a))
        self.pieces = pieces
        self.automaton = None

    def search(self, text: str) -> dict[int, tuple[int, int, int]]:
        """{item: (edits, start of the searched stretch, end)} of the items that text holds."""
        if self.automaton is None:
            self.automaton = ahocorasick.Automaton()
            for piece, where in self.pieces.items():
                self.automaton.add_word(piece, (len(piece), where))
            self.automaton.make_automaton()
        found: dict[int, tuple[int, int, int]] = {}
        if not self.pieces:
            return found
        tried: dict[int, set[int]] = {}
        for last, (length, where) in self.automaton.iter(text):
            for key, offset in where:
                if found.get(key, (1,))[0] == 0:
                    continue
                item, budget = self.items[key]
                begin = last + 1 - length - offset
                done = tried.setdefault(key, set())
                if begin in done:
                    continue
                done.add(begin)
                whole = (begin <= 0 or text[begin - 1] == " ") and text[begin + len(item) : begin + len(item) + 1] in ("", " ")
                if not budget and not whole:
                    continue
                if text.startswith(item, max(begin, 0)) and begin >= 0:
                    found[key] = (0, begin, begin + len(item))
                    continue
                a = max(0, begin - budget)
                match = distance(item, text[a : begin + len(item) + budget], budget)
                if match and (key not in found or match[0] < found[key][0]):
                    found[key] = (match[0], a, a + match[1])
        return found

    def __getstate__(self):
        return {"items": self.items, "pieces": self.pieces, "automaton": None}


def item_blocks(benchmark: DataFrame, id_col: str, text_col: str, limit: int = BLOCK_BYTES) -> Iterator[list[tuple[int, str]]]:
    """The items in blocks of bounded size, read as a stream of partitions: the driver holds one block at a time."""
    rows = benchmark.select(F.col(id_col), F.col(text_col).cast("string")).filter(F.col(id_col).isNotNull() & F.col(text_col).isNotNull()).distinct().orderBy(id_col, text_col)
    block, size = [], 0
    for key, text in rows.toLocalIterator():
        if block and size + len(text) > limit:
            yield block
            block, size = [], 0
        block.append((key, text))
        size += len(text.encode())
    if block:
        yield block


def matches(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", bytes_per_edit: int = BYTES_PER_EDIT) -> DataFrame:
    """(doc_id, item_id, edits): every item that a document holds within its budget of edits, with the fewest edits.

    Texts are compared in lower case, with every run of other characters than letters and digits as one space. An item of
    fewer than bytes_per_edit bytes matches whole words only ("cat" is not in "concatenate"). Null, empty
    and wordless items match nothing, null and empty documents hold nothing. Items with equal texts match alike; of items
    that share an id, any may match. Rows of docs are searched one by one, so repeated rows repeat in the result. Long texts
    are searched whole. Empty tables give an empty result; other columns are ignored."""
    source = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("text"))
    kind, item_kind = docs.schema[id_col].dataType.simpleString(), benchmark.schema[item_col].dataType.simpleString()
    schema = f"doc_id {kind}, item_id {item_kind}, edits int"

    def pass_over(block: list[tuple[int, str]]) -> DataFrame:
        # Items that share an id are searched under places of their own.
        items, owner = Items([(k, t) for k, (_, t) in enumerate(block)], bytes_per_edit), [key for key, _ in block]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows, keys, edits = [], [], []
                for first, raw, offsets in text_slices(batch.column(1)):
                    for k, text in enumerate(normalised(raw, offsets), first):
                        best: dict = {}
                        for place, (e, _, _) in items.search(text).items():
                            best[owner[place]] = min(e, best.get(owner[place], e))
                        for key, e in sorted(best.items()):
                            rows.append(k)
                            keys.append(key)
                            edits.append(e)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows, pa.int64())), pa.array(keys), pa.array(edits, pa.int32())] if rows else [batch.column(0).slice(0, 0), pa.array([], pa.int64()), pa.array([], pa.int32())], names=["doc_id", "item_id", "edits"])

        return source.mapInArrow(run, schema)

    out = None
    for block in item_blocks(benchmark, item_col, item_text_col):
        part = pass_over(block)
        out = part if out is None else out.unionByName(part)
    if out is None:
        return docs.sparkSession.createDataFrame([], schema)
    return out.groupBy("doc_id", "item_id").agg(F.min("edits").alias("edits"))


def clean(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs, all columns, that hold no item; rows with a null id are searched like others and kept or dropped
    on their own text."""
    names, at = docs.columns, docs.columns.index(text_col)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    out = docs
    for block in item_blocks(benchmark, "item_id", "text"):
        items = Items([(k, t) for k, (_, t) in enumerate(block)])

        def run(batches: Iterator[pa.RecordBatch], items: Items = items) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                keep: list[bool] = []
                for _, raw, offsets in text_slices(batch.column(at)):
                    keep += [not items.search(text) for text in normalised(raw, offsets)]
                kept = batch.filter(pa.array(keep, pa.bool_()))
                yield pa.RecordBatch.from_arrays(kept.columns, names=names)

        out = out.mapInArrow(run, schema)
    return out
