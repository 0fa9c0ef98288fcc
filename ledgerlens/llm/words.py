"""Words and word windows of Arrow text columns, as numpy arrays.

The words of a whole batch are found and hashed at once on its UTF-8 bytes; every separator used
here is an ASCII byte, so that bytes and code points give the same words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 3 << 20  # text handled at once; a longer document is a slice of its own
PIECE = 1 << 18        # bytes hashed at once
ODD = np.uint64(0x9E3779B97F4A7C15)


def mix(h: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: spreads every input bit over all 64."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.empty(n, np.uint64)
    out[0], size = 1, 1
    while size < n:
        step = np.uint64(pow(base, size, 1 << 64))
        take = min(size, n - size)
        out[size:size + take] = out[:take] * step
        size += take
    return out


_BASE = 0xD1342543DE82EF95
_LETTER = mix(np.arange(1, 257, dtype=np.uint64) * ODD)  # one random number for each byte
_TABLES: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2 ** 64, at least n of each."""
    if len(_TABLES.get("up", ())) < n:
        _TABLES["up"] = _powers(_BASE, n)
        _TABLES["down"] = _powers(pow(_BASE, -1, 1 << 64), n)
    return _TABLES["up"], _TABLES["down"]


def byte_set(*ranges: tuple[int, int]) -> np.ndarray:
    out = np.zeros(256, bool)
    for low, high in ranges:
        out[low:high + 1] = True
    return out


#: Bytes between words: space and \t \n \v \f \r; texts keep their letters.
SPACES = byte_set((0x20, 0x20), (0x09, 0x0D))
#: Bytes between words of letters and digits; everything beyond ASCII belongs to words.
MARKS = byte_set((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F))
SAME = np.arange(256, dtype=np.uint8)
#: A-Z to a-z.
FOLDED = np.where((SAME >= 65) & (SAME <= 90), SAME + 32, SAME).astype(np.uint8)


@dataclass
class Words:
    """Words of the texts of a slice, one after the other."""

    doc: np.ndarray    # row of the slice
    start: np.ndarray  # byte in `data`
    end: np.ndarray
    hash: np.ndarray   # uint64
    first: np.ndarray  # for each row, its first word; one entry more than rows
    data: np.ndarray


def find(data: np.ndarray, bounds: np.ndarray, separators: np.ndarray, fold: np.ndarray) -> Words:
    data = fold[data] if fold is not SAME else data
    n = len(data)
    inside = ~separators[data]
    before = np.empty(n + 1, bool)
    before[0], before[1:] = False, inside
    after = np.empty(n + 1, bool)
    after[:n], after[n] = inside, False
    before[bounds] = False  # a text begins or ends here: no word crosses it
    start = np.flatnonzero(inside & ~before[:n])
    after[bounds] = False
    end = np.flatnonzero(inside & ~after[1:]) + 1
    del inside, before, after
    first = np.searchsorted(start, bounds)
    doc = np.repeat(np.arange(len(bounds) - 1), np.diff(first))
    return Words(doc, start, end, span_hashes(data, start, end), first, data)


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of spans of bytes, none empty, none before the one it follows."""
    out = np.empty(len(start), np.uint64)
    at = 0
    while at < len(start):
        low = int(start[at])
        to = max(at + 1, int(np.searchsorted(end, low + PIECE, side="right")))
        out[at:to] = _hash(data[low:int(end[to - 1])], start[at:to] - low, end[at:to] - low)
        at = to
    return out


def stems(found: Words, letters: int) -> tuple[np.ndarray, np.ndarray]:
    """Words of more than `letters` characters, and the hash of each one's first `letters`."""
    leads = np.flatnonzero((found.data & 0xC0) != 0x80)
    after = np.searchsorted(leads, found.start) + letters
    known = after < len(leads)
    stop = np.where(known, leads[np.minimum(after, max(len(leads) - 1, 0))], 0) if len(
        leads) else after
    longer = np.flatnonzero(known & (stop < found.end))
    return longer, span_hashes(found.data, found.start[longer], stop[longer])


def _hash(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    up, down = powers(max(len(data), PIECE))
    value = _LETTER[data]
    value *= up[:len(data)]
    total = np.cumsum(value, dtype=np.uint64)
    out = total[end - 1] - total[start] + value[start]
    out *= down[start]
    return mix(out)


def windows(hashes: np.ndarray, k: int, seed: int = 1) -> np.ndarray:
    """A hash of every k consecutive entries, also of those that cross two texts."""
    m = len(hashes) - k + 1
    if m <= 0:
        return np.empty(0, np.uint64)
    base = hashes if seed == 1 else mix(hashes + np.uint64(seed * int(ODD) % (1 << 64)))
    factor = np.uint64((_BASE + 2 * seed) % (1 << 64))
    out = base[:m].copy()
    for j in range(1, k):
        out *= factor
        out += base[j:j + m]
    return mix(out + np.uint64(k))


def within(first: np.ndarray, k: int, n: int) -> np.ndarray:
    """Which windows of k entries lie in one text; first: where texts begin, n: entries."""
    m = n - k + 1
    if m <= 0:
        return np.empty(0, bool)
    ok = np.ones(m, bool)
    for step in range(1, k):
        cut = first[1:-1] - step
        ok[cut[(cut >= 0) & (cut < m)]] = False
    return ok


def winnowed(grams: np.ndarray, valid: np.ndarray, width: int) -> np.ndarray:
    """Position of the rightmost minimum of every `width` consecutive grams, as one array of
    positions (one for each window start; windows that hold an invalid gram get -1)."""
    m = len(grams) - width + 1
    if m <= 0:
        return np.empty(0, np.int64)
    best = grams[:m].copy()
    at = np.zeros(m, np.int16)
    good = valid[:m].copy()
    for j in range(1, width):
        other = grams[j:j + m]
        less = other <= best
        np.copyto(best, other, where=less)
        at[less] = j
        good &= valid[j:j + m]
    return np.where(good, np.arange(m) + at, -1)


def texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and bounds of a text column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_binary()) if not pa.types.is_large_binary(column.type) else column
    n = len(column)
    if not n:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64, n + 1, column.offset * 8)
    whole = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return whole[bounds[0]:bounds[-1]], bounds - bounds[0]


def slices(batches: Iterator[pa.RecordBatch], column: str = "text",
           limit: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Batches cut so that each holds about `limit` bytes of text, with bytes and bounds."""
    for batch in batches:
        if not batch.num_rows:
            continue
        data, bounds = texts(batch.column(batch.schema.get_field_index(column)))
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(bounds, bounds[at] + limit, side="right")) - 1)
            to = min(to, batch.num_rows)
            yield (batch.slice(at, to - at), data[bounds[at]:bounds[to]],
                   bounds[at:to + 1] - bounds[at])
            at = to


def signed(values: np.ndarray) -> np.ndarray:
    """The same 64 bits as a long."""
    return values.view(np.int64)


def order_of(ids: pa.Array, th: np.ndarray) -> np.ndarray:
    """Rank of each row by (id, th), null ids first; equal rows have equal ranks."""
    rows = pa.table({"id": ids, "th": th})
    order = pc.sort_indices(rows, sort_keys=[("id", "ascending"), ("th", "ascending")],
                            null_placement="at_start").to_numpy()
    key = pc.fill_null(ids.dictionary_encode().indices, -1).to_numpy(zero_copy_only=False)
    new = np.ones(len(th), bool)
    new[1:] = (key[order][1:] != key[order][:-1]) | (th[order][1:] != th[order][:-1])
    out = np.empty(len(th), np.int64)
    out[order] = np.cumsum(new)
    return out


def ragged(values: np.ndarray, lengths: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    offsets = np.zeros(len(lengths) + 1, np.int32)
    np.cumsum(lengths, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))
