"""Substring dedup by relative Lempel-Ziv parsing.

Every document is parsed greedily into factors against all text that stands earlier. The index of
the reference has an entry at each anchor: the smallest hash of the GRAM-word grams in every
`window` consecutive words, so that two equal windows have equal anchors at the same place. A
factor grows along an anchor's whole stretch (all windows with that anchor) when the stretch has
occurred earlier, with one lookup by its 64-bit hash. Where a factor ends inside a stretch, which
happens at the edges of copies only, the boundary is checked window by window by a 128-bit hash.
What has an earlier source is removed; adjoining factors are one span.

The index is a table of stretches, grouped by anchor in a sorted (spilling) window. Stretches that
repeat within one slice of text are settled there and never shuffled, so that a passage that many
documents share reaches its group once for each slice only.

Defined cases: null and empty texts have no words; a text shorter than a window keeps all of its
words. Earlier means the smaller doc_id (null first), among rows of one doc_id the smaller hash of
the text, then the earlier start. Rows equal in id and text are one document; each gets its
result. Texts are used whole; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.llm import words as W
from ledgerlens.llm.tables import text_rows
from ledgerlens.sources.staging import staged

WINDOW = 20
GRAM = 6


def _anchors(found: W.Words, window: int, gram: int):
    """(anchor hash, stretch hash, word of its first window, of its last) in order of the text."""
    h, first = found.hash, found.first
    grams = W.windows(h, gram)
    at = W.winnowed(grams, W.within(first, gram, len(h)), window - gram + 1)
    if not len(at):
        empty = np.empty(0, np.int64)
        return grams[:0], grams[:0], empty, empty
    starts = np.flatnonzero((at >= 0) & np.concatenate([[True], at[1:] != at[:-1]]))
    ends = np.flatnonzero((at >= 0) & np.concatenate([at[1:] != at[:-1], [True]]))
    # words starts .. ends + window - 1: hashed by prefix sums, with the anchor's place in them
    n = len(h)
    up, down = W.powers(n)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(W.mix(h) * up[:n], dtype=np.uint64)])
    stretch = (total[ends + window] - total[starts]) * down[starts]
    size = ((ends - starts) * 4096 + (at[starts] - starts)).astype(np.uint64)
    return grams[at[starts]], W.mix(stretch + W.mix(size + W.ODD)), starts, ends


def _first_of(keys: list[np.ndarray], rank: np.ndarray, low: np.ndarray):
    """Rows of a slice: which repeat an earlier one with the same keys, and which are its twins
    (equal in key, document and place)."""
    order = np.lexsort((low, rank, *keys))
    n = len(order)
    same, twin = np.zeros(n, bool), np.zeros(n, bool)
    same[1:] = np.logical_and.reduce([k[order][1:] == k[order][:-1] for k in keys])
    twin[1:] = (same[1:] & (rank[order][1:] == rank[order][:-1])
                & (low[order][1:] == low[order][:-1]))
    again, twins = np.empty(n, bool), np.empty(n, bool)
    # the twin of a first row is dropped with it, so it does not matter that it counts as later
    again[order], twins[order] = same, twin
    return again, twins


def stretches(docs: DataFrame, window: int, gram: int) -> DataFrame:
    """Stretches of all documents; those that repeat within a slice of text are settled there."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, bounds in W.slices(batches):
            found = W.find(data, bounds, W.SPACES, W.SAME)
            anchor, stretch, low, high = _anchors(found, window, gram)
            if not len(low):
                continue
            doc = found.doc[low]
            start = found.first[doc]
            th = batch.column(1).to_numpy()
            again, twin = _first_of([stretch, anchor], W.order_of(batch.column(0), th)[doc],
                                    low - start)
            keep = np.flatnonzero(~twin)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(doc[keep])), pa.array(th[doc[keep]]),
                 pa.array(again[keep]),
                 pa.array(W.signed(anchor[keep])), pa.array(W.signed(stretch[keep])),
                 pa.array((low - start)[keep].astype(np.int32)),
                 pa.array((high - start)[keep].astype(np.int32))],
                names=["doc_id", "th", "settled", "anchor", "stretch", "low", "high"])

    return docs.mapInArrow(run, f"doc_id {kind}, th long, settled boolean, anchor long, "
                                "stretch long, low int, high int")


def _same_as_before(order: Window, *names: str) -> Column:
    """Whether the row before (in the window's order) has the same values, nulls included."""
    out = F.lit(True)
    for name in names:
        out = out & F.col(name).eqNullSafe(F.lag(name).over(order))
    return (F.row_number().over(order) > 1) & out


def parsed(rows: DataFrame) -> DataFrame:
    """Stretches as factors. Settled: an equal stretch is earlier. Open: another stretch has the
    same anchor, so single windows may still be equal. The rest is new text and goes."""
    order = Window.partitionBy("anchor").orderBy("stretch", "doc_id", "th", "low")
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    shared = F.first("stretch").over(whole) != F.last("stretch").over(whole)
    return (
        rows.where(~F.col("settled"))
        .withColumn("again", _same_as_before(order, "stretch"))
        .withColumn("twin", _same_as_before(order, "stretch", "doc_id", "th", "low"))
        .withColumn("shared", shared)
        .where(~F.col("twin") & (F.col("again") | F.col("shared")))
        .select("doc_id", "th", F.col("again").alias("settled"), "low", "high"))


def boundary_windows(docs: DataFrame, open_rows: DataFrame, window: int) -> DataFrame:
    """(doc_id, th, h1, h2, low): the windows of open stretches, by hash."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    runs = open_rows.groupBy("doc_id", "th").agg(
        F.collect_list("low").alias("lows"), F.collect_list("high").alias("highs"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, bounds in W.slices(batches):
            found = W.find(data, bounds, W.SPACES, W.SAME)
            lows, highs = batch.column(3), batch.column(4)
            doc = np.repeat(np.arange(batch.num_rows), lows.value_lengths().to_numpy())
            low = lows.flatten().to_numpy().astype(np.int64) + found.first[doc]
            size = highs.flatten().to_numpy() + found.first[doc] - low + 1
            at = np.repeat(low, size) + np.arange(size.sum()) - np.repeat(
                np.cumsum(size) - size, size)
            h1, h2 = W.windows(found.hash, window, 1)[at], W.windows(found.hash, window, 2)[at]
            doc = np.repeat(doc, size)
            place = at - found.first[doc]
            th = batch.column(1).to_numpy()
            again, twin = _first_of([h2, h1], W.order_of(batch.column(0), th)[doc], place)
            keep = np.flatnonzero(~twin)
            doc = doc[keep]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(doc)), pa.array(th[doc]), pa.array(again[keep]),
                 pa.array(W.signed(h1[keep])), pa.array(W.signed(h2[keep])),
                 pa.array(place[keep].astype(np.int32))],
                names=["doc_id", "th", "settled", "h1", "h2", "low"])

    joined = docs.alias("d").join(
        runs.alias("r"),
        F.col("d.doc_id").eqNullSafe(F.col("r.doc_id")) & (F.col("d.th") == F.col("r.th")))
    return joined.select("d.doc_id", "d.th", "text", "lows", "highs").mapInArrow(
        run, f"doc_id {kind}, th long, settled boolean, h1 long, h2 long, low int")


def repeated(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW,
             gram: int = GRAM) -> DataFrame:
    """(doc_id, th, low, high): the first and last start of windows that have an earlier equal."""
    rows = text_rows(docs, key, text)
    index = staged(stretches(rows, window, gram), "stretches")
    factors = staged(parsed(index), "factors")
    checked = staged(boundary_windows(rows, factors.where(~F.col("settled")), window), "windows")
    order = Window.partitionBy("h1", "h2").orderBy("doc_id", "th", "low")
    at_boundaries = (
        checked.where(~F.col("settled"))
        .withColumn("again", F.row_number().over(order) > 1)
        .withColumn("twin", _same_as_before(order, "doc_id", "th", "low"))
        .where(F.col("again") & ~F.col("twin")))
    span = ["doc_id", "th", "low", "high"]
    single = ["doc_id", "th", "low", F.col("low").alias("high")]
    return (
        index.where("settled").select(span)
        .unionByName(factors.where("settled").select(span))
        .unionByName(checked.where("settled").select(single))
        .unionByName(at_boundaries.select(single)))


def deduplicate(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW,
                gram: int = GRAM, keep_text: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256, spans (first word removed, word after the last)
    and, on request, the kept words joined by one space."""
    rows = text_rows(docs, key, text)
    kind = rows.schema["doc_id"].dataType.simpleString()
    spans = repeated(docs, key, text, window, gram).groupBy("doc_id", "th").agg(
        F.collect_list("low").alias("lows"), F.collect_list("high").alias("highs"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, bounds in W.slices(batches):
            found = W.find(data, bounds, W.SPACES, W.SAME)
            total = len(found.start)
            lows, highs = batch.column(2), batch.column(3)
            doc = np.repeat(np.arange(batch.num_rows),
                            lows.value_lengths().fill_null(0).to_numpy())
            edge = np.zeros(total + 1, np.int64)
            np.add.at(edge, lows.flatten().to_numpy() + found.first[doc], 1)
            np.add.at(edge, highs.flatten().to_numpy() + found.first[doc] + window, -1)
            gone = np.cumsum(edge[:total]) > 0
            # where runs of removed words begin and end, texts apart
            begins, ends = np.empty(total, bool), np.empty(total, bool)
            begins[1:], ends[:-1] = gone[1:] & ~gone[:-1], gone[:-1] & ~gone[1:]
            if total:
                begins[0], ends[-1] = gone[0], gone[-1]
            head = found.first[:-1][np.diff(found.first) > 0]
            begins[head] = gone[head]
            tail = found.first[1:][np.diff(found.first) > 0] - 1
            ends[tail] = gone[tail]
            begins, ends = np.flatnonzero(begins), np.flatnonzero(ends) + 1
            runs = np.bincount(found.doc[begins], minlength=batch.num_rows)
            offset = found.first[found.doc[begins]]
            kept = ~gone
            sums, texts = [], []
            raw = data.tobytes()
            for r in range(batch.num_rows):
                own = np.flatnonzero(kept[found.first[r]:found.first[r + 1]]) + found.first[r]
                whole = b" ".join([raw[a:b] for a, b in zip(
                    found.start[own].tolist(), found.end[own].tolist(), strict=True)])
                sums.append(hashlib.sha256(whole).hexdigest())
                texts.append(whole.decode() if keep_text else None)
            words = np.diff(found.first)
            removed = np.bincount(found.doc[gone], minlength=batch.num_rows)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(words), pa.array(removed), pa.array(sums),
                 W.ragged(begins - offset, runs, pa.int64()),
                 W.ragged(ends - offset, runs, pa.int64()), pa.array(texts, pa.string())],
                names=["doc_id", "n_words", "n_removed", "kept_sha256", "starts", "ends", "kept"])

    out = rows.alias("d").join(
        spans.alias("s"),
        F.col("d.doc_id").eqNullSafe(F.col("s.doc_id")) & (F.col("d.th") == F.col("s.th")), "left")
    out = out.select("d.doc_id", "text", "lows", "highs").mapInArrow(
        run, f"doc_id {kind}, n_words long, n_removed long, kept_sha256 string, "
             "starts array<long>, ends array<long>, kept string")
    columns = ["doc_id", "n_words", "n_removed", "kept_sha256",
               F.arrays_zip(F.col("starts").alias("start"), F.col("ends").alias("end"))
               .alias("spans")]
    return out.select(*columns, *(["kept"] if keep_text else []))
