"""Shared plumbing of the operators: shared-folder tables and vectorised word hashing."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from tessera.lineage import cut_lineage

#: Writes a table into the shared folder and reads it back.
stored = cut_lineage


# ---------------------------------------------------------------- Arrow text buffers

#: Bytes of text that are hashed at once; a longer text is hashed alone and whole.
SLICE_BYTES = 1 << 22


def text_slices(column: pa.Array, limit: int = SLICE_BYTES):
    """Yields (first row, bytes, offsets) over a string column without decoding it; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if len(column) == 0:
        return
    column = column.cast(pa.large_binary()) if not pa.types.is_large_binary(column.type) else column
    if column.null_count:
        column = column.fill_null(b"")
    _, offs, data = column.buffers()
    offsets = np.frombuffer(offs, np.int64, len(column) + 1, column.offset * 8)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    row = 0
    while row < len(column):
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1)
        yield row, raw[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end


# ---------------------------------------------------------------- hashing

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_U = np.uint64


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser."""
    x = x ^ (x >> _U(32))
    x = x * _U(0xD6E8FEB86659FD93)
    x ^= x >> _U(32)
    x *= _U(0xD6E8FEB86659FD93)
    x ^= x >> _U(32)
    return x


_BYTE = mix64(np.arange(1, 257, dtype=_U) * _U(0x9E3779B97F4A7C15))
_BYTE_LOWER = _BYTE[_LOWER]
_BASE = 0x9E3779B97F4A7C15 | 1
_POW = np.ones(1, _U)
_INV = np.ones(1, _U)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _POW, _INV
    if len(_POW) < n:
        n = max(n, SLICE_BYTES + 1)

        def run(base: int) -> np.ndarray:
            out = np.empty(n, _U)
            out[0] = 1
            done = 1
            step = base  # base ** done
            while done < n:
                k = min(done, n - done)
                out[done : done + k] = out[:k] * _U(step)
                step = step * step % 2**64
                done += k
            return out

        _POW, _INV = run(_BASE), run(pow(_BASE, -1, 2**64))
    return _POW, _INV


def word_spans(raw: np.ndarray, offsets: np.ndarray, word_byte: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, words per text) of the runs of bytes other than \\x20 and \\x09-\\x0D; a text's end ends a word.

    word_byte: another table of the bytes that words are made of."""
    n = len(raw)
    if n == 0:
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(offsets) - 1, np.int64)
    word = ~_SPACE[raw] if word_byte is None else word_byte[raw]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = word[:-1]
    starts = np.flatnonzero(word & (~before | edge[:n]))
    after = np.zeros(n, bool)
    after[:-1] = word[1:]
    ends = np.flatnonzero(word & (~after | edge[1:])) + 1
    return starts, ends, np.diff(np.searchsorted(starts, offsets))


def word_hashes(raw: np.ndarray, offsets: np.ndarray, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash of every word, and words per text. A-Z count as a-z if lower."""
    starts, ends, counts = word_spans(raw, offsets)
    if not len(starts):
        return np.zeros(0, _U), counts
    power, inverse = _powers(len(raw) + 1)
    total = np.zeros(len(raw) + 1, _U)
    np.cumsum((_BYTE_LOWER if lower else _BYTE)[raw] * power[: len(raw)], out=total[1:])
    return mix64((total[ends] - total[starts]) * inverse[starts] + (ends - starts).astype(_U)), counts


#: Bytes of words without punctuation: ASCII letters and digits, and all bytes of other characters.
ALNUM = np.zeros(256, bool)
ALNUM[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def folded(raw: np.ndarray) -> np.ndarray:
    """The bytes with A-Z and the capitals of Latin-1 (two bytes in UTF-8) in lower case."""
    out = _LOWER[raw]
    second = np.flatnonzero(out[:-1] == 0xC3) + 1 if len(out) > 1 else np.zeros(0, np.int64)
    second = second[(out[second] >= 0x80) & (out[second] <= 0x9E) & (out[second] != 0x97)]
    out[second] += 0x20
    return out


def span_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, total: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of byte spans, and the prefix sums that further spans of the same bytes can reuse."""
    power, inverse = _powers(len(raw) + 1)
    if total is None:
        total = np.zeros(len(raw) + 1, _U)
        np.cumsum(_BYTE[raw] * power[: len(raw)], out=total[1:])
    return mix64((total[ends] - total[starts]) * inverse[starts] + (ends - starts).astype(_U)), total


_STEP = _U(0xC2B2AE3D27D4EB4F)


def shingle_sets(raw: np.ndarray, offsets: np.ndarray, width: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of each text's width-word shingles; shorter texts: the whole sequence as one; no words: none."""
    words, counts = word_hashes(raw, offsets)
    ends = np.cumsum(counts)
    n = len(words)
    rolled = words.copy()
    for k in range(1, min(width, n)):
        rolled[: n - k] = rolled[: n - k] * _STEP + words[k:]
    rolled = mix64(rolled + _U(width))
    out = []
    for count, end in zip(counts.tolist(), ends.tolist(), strict=True):
        if count >= width:
            out.append(np.unique(rolled[end - count : end - width + 1]))
        elif count:
            h = _U(0)
            with np.errstate(over="ignore"):
                for w in words[end - count : end]:
                    h = h * _STEP + w
                out.append(mix64(np.array([h + _U(count)], _U)))
        else:
            out.append(np.zeros(0, _U))
    return out


def jaccard_counts(a: np.ndarray, b: np.ndarray) -> tuple[int, int]:
    """(intersection, union) of two sorted distinct arrays."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return 0, len(b)
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    both = int((b[at] == a).sum())
    return both, len(a) + len(b) - both


def keyed_groups(batches, n_keys: int):
    """Splits a stream of record batches, sorted by its first n_keys columns, into one table per key."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = [np.asarray(batch.column(i).to_numpy(zero_copy_only=False)) for i in range(n_keys)]
        change = np.zeros(batch.num_rows, bool)
        for k in keys:
            change[1:] |= k[1:] != k[:-1]
        cuts = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            key = tuple(k[a] for k in keys)
            if held and key != last:
                yield pa.Table.from_batches(held)
                held = []
            last = key
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)
