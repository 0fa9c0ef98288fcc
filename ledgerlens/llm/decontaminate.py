"""Benchmark decontamination by winnowing.

Of every window of `window` consecutive words, the smallest hash of its k-word grams is kept, on
both sides, so that a shared window always has a shared fingerprint. Document fingerprints are
first held against a bitmap of the benchmark's (of fixed size, so it can travel with the tasks),
then joined with them; at the fingerprints that remain, the hits are extended to whole windows
and joined with the benchmark's windows by a 128-bit hash. Items shorter than a window are one
window of their own length, found by the hash of all their words.

Defined cases: a null or empty text, or one without words, has no words, no hits and is not
contaminated; such an item has no window. Items with equal texts, and repeated item ids, all
count, an id once. A null item id is left out of the ids. Documents equal in id and text get the
same result each. Texts are used whole; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm import words as W
from ledgerlens.llm.tables import text_of, text_rows
from ledgerlens.sources.staging import staged

WINDOW = 13
GRAM = 5
#: Bits of the bitmap of benchmark fingerprints, 512 kB: its size does not depend on the data.
BITMAP_BITS = 22


def _bit(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(64 - BITMAP_BITS)).astype(np.int64)


def _pair(hashes: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    return W.signed(W.windows(hashes, k, 1)), W.signed(W.windows(hashes, k, 2))


def benchmark_windows(items: DataFrame, key: str = "item_id", text: str = "text",
                      window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """(item_id, len, h1, h2, fp): every window, with its fingerprint."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, bounds in W.slices(batches):
            found = W.find(data, bounds, W.MARKS, W.FOLDED)
            h, first = found.hash, found.first
            at, fp = _fingerprints(h, first, window, gram)
            start = np.flatnonzero(at >= 0)
            h1, h2 = _pair(h, window)
            rows = [(found.doc[start], np.full(len(start), window), h1[start], h2[start],
                     W.signed(fp[at[start]]))]
            for doc in np.flatnonzero((np.diff(first) > 0) & (np.diff(first) < window)):
                n = int(first[doc + 1] - first[doc])
                a, b = _pair(h[first[doc]:first[doc + 1]], n)
                rows.append((np.array([doc]), np.array([n]), a, b, a))
            doc, n, h1, h2, fp = (np.concatenate(x) for x in zip(*rows, strict=True))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(doc)), pa.array(n, pa.int32()), pa.array(h1),
                 pa.array(h2), pa.array(fp)], names=["item_id", "len", "h1", "h2", "fp"])

    return items.select(F.col(key).cast("string").alias("item_id"),
                        text_of(text).alias("text")).mapInArrow(
        run, "item_id string, len int, h1 long, h2 long, fp long")


def _fingerprints(h: np.ndarray, first: np.ndarray, window: int, gram: int):
    """For every window start, the place of its fingerprint (-1 across texts); all gram hashes."""
    grams = W.windows(h, gram)
    return W.winnowed(grams, W.within(first, gram, len(h)), window - gram + 1), grams


def bitmap(prints: DataFrame) -> np.ndarray:
    """Bitmap of the fingerprints. At most 2 ** BITMAP_BITS / 64 numbers come to the driver."""
    place = F.shiftrightunsigned("fp", 64 - BITMAP_BITS)
    words = (prints.select(F.shiftright(place, 6).cast("int").alias("word"),
                           F.expr(f"shiftleft(1L, cast(shiftrightunsigned(fp, "
                                  f"{64 - BITMAP_BITS}) & 63 as int))").alias("bit"))
             .groupBy("word").agg(F.bit_or("bit").alias("bits")).collect())
    out = np.zeros(1 << (BITMAP_BITS - 6), np.int64)
    for word, bits in words:
        out[word] = bits
    return np.unpackbits(out.view(np.uint8), bitorder="little").astype(bool)


def candidates(docs: DataFrame, seen: np.ndarray, lengths: list[int], window: int = WINDOW,
               gram: int = GRAM) -> DataFrame:
    """(doc_id, th, n_words, hits): for each document, its fingerprints whose bit is set, with
    the windows that have them."""
    packed = np.packbits(seen, bitorder="little").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = np.unpackbits(np.frombuffer(packed, np.uint8), bitorder="little").astype(bool)
        for batch, data, bounds in W.slices(batches):
            found = W.find(data, bounds, W.MARKS, W.FOLDED)
            h, first = found.hash, found.first
            rows = []
            at, fp = _fingerprints(h, first, window, gram)
            start = np.flatnonzero((at >= 0) & known[_bit(fp[at])]) if len(at) else at
            rows.append((start, np.full(len(start), window), fp[at[start]]))
            for n in lengths:
                whole = W.windows(h, n)
                start = np.flatnonzero(W.within(first, n, len(h)) & known[_bit(whole)])
                rows.append((start, np.full(len(start), n), whole[start]))
            start, size, fp = (np.concatenate(x) for x in zip(*rows, strict=True))
            h1, h2 = np.empty(len(start), np.int64), np.empty(len(start), np.int64)
            for n in {int(x) for x in np.unique(size)}:
                here = size == n
                a, b = _pair(h, n)
                h1[here], h2[here] = a[start[here]], b[start[here]]
            doc = found.doc[start] if len(start) else start
            order = np.argsort(doc, kind="stable")
            n = np.bincount(doc, minlength=batch.num_rows)
            offsets = pa.array(np.concatenate([[0], np.cumsum(n)]).astype(np.int32))
            struct = pa.StructArray.from_arrays(
                [pa.array((start - first[doc])[order].astype(np.int32)),
                 pa.array(size[order].astype(np.int32)), pa.array(W.signed(fp)[order]),
                 pa.array(h1[order]), pa.array(h2[order])],
                names=["start", "len", "fp", "h1", "h2"])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(np.diff(first)),
                 pa.ListArray.from_arrays(offsets, struct)],
                names=["doc_id", "th", "n_words", "hits"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(
        run, f"doc_id {kind}, th long, n_words long, "
             "hits array<struct<start:int,len:int,fp:long,h1:long,h2:long>>")


def contamination(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text",
                  item_key: str = "item_id", item_text: str = "text", window: int = WINDOW,
                  gram: int = GRAM, share: int = 20) -> DataFrame:
    """doc_id, th, n_words, n_hit, n_items, items_sha256, contaminated and the merged spans
    (first word, word after the last) of each document."""
    tests = staged(benchmark_windows(items, item_key, item_text, window, gram), "benchmark")
    prints = tests.select("len", "fp").distinct()
    lengths = sorted(r[0] for r in tests.where(F.col("len") < window).select("len").distinct()
                     .collect())  # fewer than `window` numbers
    found = staged(candidates(text_rows(docs, key, text), bitmap(prints), lengths, window, gram),
                   "candidates")
    # of rows equal in id and text one is enough
    some = found.where(F.size("hits") > 0).dropDuplicates(["doc_id", "th"])
    rows = (some.select("doc_id", "th", F.explode("hits").alias("hit"))
            .select("doc_id", "th", "hit.*"))
    joined = rows.join(prints, ["len", "fp"], "left_semi")
    known = tests.groupBy("len", "h1", "h2").agg(F.collect_set("item_id").alias("items"))
    hits = joined.join(known, ["len", "h1", "h2"]).select("doc_id", "th", "start", "len", "items")
    covered = F.flatten(F.transform(
        "hits", lambda s: F.sequence(s["start"], s["start"] + s["len"] - 1)))
    per_doc = staged(
        hits.groupBy("doc_id", "th")
        .agg(F.collect_set(F.struct("start", "len")).alias("hits"),
             F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("ids"))
        .select("doc_id", "th", F.array_sort(F.array_distinct(covered)).alias("words"), "ids"),
        "hits")
    out = found.select("doc_id", "th", "n_words").alias("d").join(
        per_doc.alias("h"),
        F.col("d.doc_id").eqNullSafe(F.col("h.doc_id")) & (F.col("d.th") == F.col("h.th")), "left")
    none = F.array().cast("array<string>")
    words, ids = F.coalesce("words", F.array().cast("array<int>")), F.coalesce("ids", none)
    n_hit = F.size(words).cast("long")
    return out.select(
        "d.doc_id", "d.th", "n_words", n_hit.alias("n_hit"),
        F.size(ids).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", ids).cast("binary"), 256).alias("items_sha256"),
        ((n_hit > 0) & (F.lit(share) * n_hit >= F.col("n_words"))).alias("contaminated"),
        _spans(words).alias("spans"))


def _spans(words: Column) -> Column:
    """Runs of consecutive numbers in a sorted array, as (first, after the last)."""
    begins = F.transform(words, lambda w, i: F.when(
        (i == 0) | (w != F.get(words, i - 1) + 1), w))
    ends = F.transform(words, lambda w, i: F.when(
        (i == F.size(words) - 1) | (F.get(words, i + 1) != w + 1), w + 1))
    present = lambda x: x.isNotNull()
    return F.arrays_zip(F.filter(begins, present).alias("start"),
                        F.filter(ends, present).alias("end"))
