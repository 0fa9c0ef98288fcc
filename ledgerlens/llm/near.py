"""Near-duplicate texts by Order MinHash.

The five-word grams of a text are labelled with their occurrence. Each of SKETCHES hash functions
picks the TUPLE labelled grams with the smallest values and lists them in the order of the text;
texts that share such a list in some sketch meet in a bucket. Unlike plain MinHash, the order makes
the lists sensitive to edit similarity. Candidates are verified on their words: two texts are
linked when their edit distance, by an alignment in a band of that width, is at most
(1 - `similarity`) of the longer one. Classes are the connected components of the links.

Texts with equal words are one node. In a bucket, members are verified against a leader, not with
one another. A member leaves a bucket when it has been a leader, or when it is linked to one and by
the triangle inequality can be linked to no member of another component; a bucket is done when its
members lie in one component. So a family of n copies costs n comparisons.

What a first leader leaves open, such as many texts that only share a passage, is split exactly and
all at once: open texts meet by grams of one to three words, those in the fewest open texts first
(`surviving`). A text takes so many of them that no number of edits allowed by the link rule destroys
all; so of two linked texts, the one that stops first keeps a gram that both have taken. A text
whose own grams, in no other open text, are enough is linked to none and meets none. Passages come
last and meet only where the rest of a text is too little. Later rounds take more leaders each time and
compare members of other components only. Buckets of equal members are one, and sketches meet within
ranges of length. No candidate link between different classes is lost.

Defined cases: null and empty texts, and texts without words, are equal to one another. A text of
fewer than five words is one gram. The class is named by its smallest doc_id; a null id counts as
smallest. Rows equal in id and text have the same class, and both represent it if it is theirs.
Texts are used whole; other columns are ignored. Pairs whose shorter text has fewer than SHORT words
also meet by their rarest words, so none of them that the link rule allows is missed. For longer ones
it is a matter of probability, 1 - (1 - J^TUPLE)^SKETCHES at a share J of common grams. Measured on
1,000 pairs of 50 to 250 distinct words, with so many percent of the words changed at random places:
1.000 at 5 and 10, 0.960 at 15 and 0.773 at 20, the edge of the link rule.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm import words as W
from ledgerlens.llm.components import components
from ledgerlens.llm.tables import text_rows
from ledgerlens.sources.staging import dropped_shuffles, staged

GRAM = 5
SKETCHES = 40
TUPLE = 2
SIMILARITY = 0.8
#: Pairs of texts of which the shorter one has fewer words meet by their rarest words, too.
SHORT = 50
#: Slots of the table of word frequencies: 2 MB, whatever the corpus.
SLOTS = 1 << 18
#: Slots of the table of gram levels, a byte each, and of the part of it that one task writes.
GRAM_SLOTS, BLOCK = 1 << 23, 1 << 16
LONGEST = 3


def _labelled(grams: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Hash of each gram with the number of its earlier occurrences in the text."""
    key = grams + W.mix((doc + 1).astype(np.uint64) * W.ODD)
    ordered = np.sort(key)
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    label = np.zeros(len(key), np.uint64)
    if len(twice):
        at = np.flatnonzero(np.isin(key, twice))
        order = at[np.argsort(key[at], kind="stable")]
        value = key[order]
        first = np.concatenate([[True], value[1:] != value[:-1]])
        begin = np.maximum.accumulate(np.where(first, np.arange(len(order)), 0))
        label[order] = np.arange(len(order)) - begin
    return W.mix(grams + label * W.ODD)


def _smallest(values: np.ndarray, first: np.ndarray, size: np.ndarray, row: np.ndarray):
    """Position of the smallest value of each row."""
    least = np.minimum.reduceat(values, first)
    at = np.flatnonzero(values == np.repeat(least, size))
    keep = np.concatenate([[True], row[at][1:] != row[at][:-1]])
    return at[keep]


def sketches(hashes: np.ndarray, first: np.ndarray, gram: int, count: int, width: int):
    """`count` order-preserving sketches of each text (0 for texts without words)."""
    n_docs = len(first) - 1
    out = np.zeros((n_docs, count), np.uint64)
    n = np.diff(first)
    grams = W.windows(hashes, gram)
    inside = W.within(first, gram, len(hashes))
    doc = np.repeat(np.arange(n_docs), n)
    at = np.flatnonzero(inside)
    values, row = grams[at], doc[at]
    small = np.flatnonzero((n > 0) & (n < gram))
    if len(small):
        whole = np.array([W.windows(hashes[first[d]:first[d + 1]], int(n[d]))[0] for d in small],
                         np.uint64)
        values, row = np.concatenate([values, whole]), np.concatenate([row, small])
        order = np.argsort(row, kind="stable")
        values, row = values[order], row[order]
    if not len(values):
        return out
    labelled = _labelled(values, row)
    begin = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
    size = np.diff(np.append(begin, len(row)))
    docs = row[begin]
    for i in range(count):
        factor = int(W.mix(np.array([2 * i + 1], np.uint64) * W.ODD)[0]) | 1
        order = labelled * np.uint64(factor)
        order ^= order >> np.uint64(32)
        chosen = []
        for _ in range(width):
            place = _smallest(order, begin, size, row)
            chosen.append(place)
            order[place] = np.uint64(0xFFFFFFFFFFFFFFFF)
        places = np.sort(np.stack(chosen), axis=0)
        # a text with fewer grams than the sketch holds names its last ones twice
        key = np.full(len(docs), np.uint64(i + 1))
        for p in places:
            key = W.mix(key * np.uint64(0xD1342543DE82EF95) + values[p])
        out[docs, i] = key
    return out


def sketched(rows: DataFrame, gram: int, count: int, width: int) -> DataFrame:
    """(doc_id, th, n_words, tid, keys): tid names the sequence of words."""
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, bounds in W.slices(batches):
            found = W.find(data, bounds, W.SPACES, W.SAME)
            first, n = found.first, np.diff(found.first)
            keys = W.signed(sketches(found.hash, first, gram, count, width))
            up, down = W.powers(len(found.hash) + 1)
            pair = []
            for seed in (1, 2):
                value = W.mix(found.hash + np.uint64(seed)) * up[:len(found.hash)]
                total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(value, dtype=np.uint64)])
                sums = (total[first[1:]] - total[first[:-1]]) * down[first[:-1]]
                pair.append(W.mix(sums + n.astype(np.uint64)))
            names = np.ascontiguousarray(np.stack(pair, axis=1)).tobytes()
            tid = pa.array([names[16 * i:16 * i + 16] for i in range(batch.num_rows)], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(n.astype(np.int64)), tid,
                 W.ragged(keys.ravel(), np.where(n > 0, count, 0), pa.int64())
                 if (n > 0).all() else
                 W.ragged(keys[n > 0].ravel(), np.where(n > 0, count, 0), pa.int64())],
                names=["doc_id", "th", "n_words", "tid", "keys"])

    return rows.mapInArrow(
        run, f"doc_id {kind}, th long, n_words long, tid binary, keys array<long>")


def banded(a: np.ndarray, b: np.ndarray, band: int) -> int:
    """Edit distance of two sequences if it is at most `band`, else band + 1."""
    n, m = len(a), len(b)
    if abs(n - m) > band:
        return band + 1
    width = 2 * band + 1
    step = np.arange(width)
    far = n + m + width
    cells = np.full(width + 1, far)
    cells[band:width] = step[:band + 1]  # row 0: j = column - band
    padded = np.zeros(m + 2 * width, b.dtype)
    padded[width:width + m] = b
    inside = np.zeros(m + 2 * width, bool)
    inside[width:width + m] = True
    for i in range(1, n + 1):
        low = i - band - 1 + width  # place of b's word for column 0
        differs = (padded[low:low + width] != a[i - 1]) | ~inside[low:low + width]
        here = np.minimum(cells[:width] + differs, cells[1:] + 1)
        if i <= band:
            here[band - i] = min(here[band - i], i)
            here[:band - i] = far
        beyond = m - i + band + 1  # columns whose j > m
        if beyond < width:
            here[max(beyond, 0):] = far
        here = np.minimum.accumulate(here - step) + step
        if beyond < width:
            here[max(beyond, 0):] = far
        cells[:width] = here
        if here.min() > band:
            return band + 1
    return int(min(cells[m - n + band], band + 1))


def _chained(a: np.ndarray, b: np.ndarray, k: int = 3) -> int:
    """An upper bound of the edit distance: what lies between shared grams in the same order."""
    ga, gb = W.windows(a, k), W.windows(b, k)
    ua, ia, ca = np.unique(ga, return_index=True, return_counts=True)
    ub, ib, cb = np.unique(gb, return_index=True, return_counts=True)
    _, xa, xb = np.intersect1d(ua[ca == 1], ub[cb == 1], assume_unique=True, return_indices=True)
    pa_, pb = ia[ca == 1][xa], ib[cb == 1][xb]
    order = np.argsort(pa_)
    pa_, pb = pa_[order], pb[order]
    # those that keep the order of every earlier one
    keep = pb >= np.maximum.accumulate(pb) if len(pb) else np.empty(0, bool)
    pa_, pb = pa_[keep], pb[keep]
    if not len(pa_):
        return max(len(a), len(b))
    cost = max(pa_[0], pb[0]) + max(len(a) - pa_[-1], len(b) - pb[-1])
    da, db = np.diff(pa_), np.diff(pb)
    # between two anchors: grams that follow each other on one diagonal cost nothing
    return int(cost + np.where((da == db) & (da <= k), 0, np.maximum(da, db)).sum())


def verdict(a: np.ndarray, b: np.ndarray, similarity: float = SIMILARITY) -> tuple[bool, float]:
    """Whether two sequences are linked, and a share of the longer one: their distance is at most
    that if they are, at least that if not. Bounds first, the banded alignment where they leave
    doubt."""
    longer, shorter = max(len(a), len(b)), min(len(a), len(b))
    band = int((1 - similarity) * longer + 1e-9)
    gap = longer - shorter
    same = a[:shorter] == b[:shorter]
    head = shorter if same.all() else int(same.argmin())
    a, b = a[head:], b[head:]
    shorter -= head
    if not shorter:
        return gap <= band, gap / max(longer, 1)
    same = a[::-1][:shorter] == b[::-1][:shorter]
    tail = shorter if same.all() else int(same.argmin())
    a, b = a[:len(a) - tail], b[:len(b) - tail]
    most = max(len(a), len(b))
    if len(a) == len(b):
        most = int((a != b).sum())
    if most <= band:
        return True, most / longer
    _, code = np.unique(np.concatenate([a, b]), return_inverse=True)
    top = int(code.max()) + 1
    shared = np.minimum(np.bincount(code[:len(a)], minlength=top),
                        np.bincount(code[len(a):], minlength=top)).sum()
    least = max(len(a), len(b)) - int(shared)
    if least > band:
        return False, least / longer
    most = _chained(a, b)
    if most <= band:
        return True, most / longer
    exact = banded(a, b, band)
    return exact <= band, exact / longer


def verified(pairs: DataFrame, similarity: float) -> DataFrame:
    """(tid, leader, text, other) -> (tid, leader, linked, share)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, bounds in W.slices(batches, limit=1 << 20):
            one = W.find(data, bounds, W.SPACES, W.SAME)
            two = W.find(*W.texts(batch.column(3)), W.SPACES, W.SAME)
            found = [verdict(one.hash[one.first[i]:one.first[i + 1]],
                             two.hash[two.first[i]:two.first[i + 1]], similarity)
                     for i in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([bool(f[0]) for f in found]),
                 pa.array([float(f[1]) for f in found])],
                names=["tid", "leader", "linked", "share"])

    return pairs.select("tid", "leader", "text", "other").mapInArrow(
        run, "tid binary, leader binary, linked boolean, share double")


def bags(texts: DataFrame) -> DataFrame:
    """(tid, bag): the sorted words of a text, as 32 bits each, and then how often each occurs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, bounds in W.slices(batches):
            found = W.find(data, bounds, W.SPACES, W.SAME)
            counted = [np.unique(found.hash[found.first[i]:found.first[i + 1]].astype(np.uint32),
                                 return_counts=True) for i in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("tid"), pa.array([word.tobytes() + n.astype(np.uint32).tobytes()
                                                for word, n in counted], pa.binary())],
                names=["tid", "bag"])

    return texts.select("tid", "text").mapInArrow(run, "tid binary, bag binary")


def bounded(pairs: DataFrame, similarity: float) -> DataFrame:
    """(tid, leader, bag, other) -> (tid, leader, linked, share) as `verdict` has it where the texts
    share too few words to be linked; linked is null for the rest."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for pair in zip(batch.column(2), batch.column(3)):
                (a, n_a), (b, n_b) = (np.frombuffer(bag.as_buffer(), np.uint32).reshape(2, -1)
                                      for bag in pair)
                at = np.minimum(np.searchsorted(b, a), len(b) - 1)
                shared = np.minimum(n_a, n_b[at])[b[at] == a].sum(dtype=np.int64)
                longer = max(n_a.sum(dtype=np.int64), n_b.sum(dtype=np.int64))
                least = int(longer - shared)
                found.append((False if least > int((1 - similarity) * longer + 1e-9) else None,
                              float(least / longer)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([f[0] for f in found], pa.bool_()),
                 pa.array([f[1] for f in found], pa.float64())],
                names=["tid", "leader", "linked", "share"])

    return pairs.select("tid", "leader", "bag", "other").mapInArrow(
        run, "tid binary, leader binary, linked boolean, share double")


def frequencies(rows: DataFrame) -> np.ndarray:
    """How often labelled words occur in all texts, by SLOTS slots of their hash."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SLOTS, np.int64)
        for _, data, bounds in W.slices(batches):
            found = W.find(data, bounds, W.SPACES, W.SAME)
            total += np.bincount(_slot(_words(found.hash, found.first)), minlength=SLOTS)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(some.astype(np.int32)), pa.array(total[some])], names=["slot", "n"])

    sums = (rows.select("text").mapInArrow(run, "slot int, n long")
            .groupBy("slot").agg(F.sum("n").alias("n")).toArrow())
    out = np.zeros(SLOTS, np.int64)
    out[sums["slot"].to_numpy()] = sums["n"].to_numpy()
    return out


def _words(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Occurrence-labelled words of texts, one text after the other."""
    return _labelled(hashes, np.repeat(np.arange(len(first) - 1), np.diff(first)))


def _slot(labelled: np.ndarray) -> np.ndarray:
    return (labelled % np.uint64(SLOTS)).astype(np.int64)


def rarest(labelled: np.ndarray, frequency: np.ndarray, similarity: float,
           reference: np.ndarray | None = None) -> np.ndarray:
    """The words of a text of which any two linked texts have one in common.

    Linked texts share all but (1 - similarity) of the longer one's labelled words. So under any one
    order of words, one more than that share from the start of each must meet. Here words of the
    reference come last, and rare words before frequent ones; words of no other text are left out.
    """
    count = frequency[_slot(labelled)]
    late = np.zeros(len(labelled), bool) if reference is None else np.isin(labelled, reference)
    some = np.lexsort((labelled, count, late))[:int((1 - similarity) * len(labelled) + 1e-9) + 1]
    return labelled[some[count[some] > 1]]


def with_words(texts: DataFrame, frequency: np.ndarray, similarity: float) -> DataFrame:
    """(tid, part_of, text) -> (key, tid, part_of), a row for each of the rarest words of a text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, bounds in W.slices(batches, limit=1 << 20):
            one = W.find(data, bounds, W.SPACES, W.SAME)
            mine = _words(one.hash, one.first)
            yield _chosen(batch, [rarest(mine[one.first[i]:one.first[i + 1]], frequency, similarity)
                                  for i in range(batch.num_rows)])

    return _keyed(texts.mapInArrow(run, CHOSEN))


CHOSEN = "tid binary, part_of binary, words array<long>"


def _chosen(batch: pa.RecordBatch, words: list[np.ndarray], *sizes: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [batch.column("tid"), batch.column("part_of"),
         W.ragged(W.signed(np.concatenate(words)), np.array([len(c) for c in words]), pa.int64()),
         *[pa.array(n.astype(np.int64)) for n in sizes]],
        names=["tid", "part_of", "words", "n_words"][:3 + len(sizes)])


def _keyed(chosen: DataFrame) -> DataFrame:
    return chosen.select("tid", "part_of", F.explode("words").alias("word")).select(
        F.xxhash64("word").alias("key"), "tid", "part_of")


def _grams(words: np.ndarray) -> list[np.ndarray]:
    """Hashes of the grams of one, two and more words of a text, by their first word."""
    return [W.windows(words, k) for k in range(1, LONGEST + 1)]


def gram_levels(texts: DataFrame) -> np.ndarray:
    """In how many texts grams occur, by GRAM_SLOTS slots of their hash: 0 for none, 1 for one and
    8 more each time the number doubles."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(GRAM_SLOTS, np.uint32)
        for batch, data, bounds in W.slices(batches):
            found = W.find(data, bounds, W.SPACES, W.SAME)
            for i in range(batch.num_rows):
                grams = np.concatenate(_grams(found.hash[found.first[i]:found.first[i + 1]]))
                total[np.unique(grams % np.uint64(GRAM_SLOTS))] += np.uint32(1)
        some = np.flatnonzero(total)
        for at in range(0, len(some), BLOCK):
            slot = some[at:at + BLOCK]
            yield pa.RecordBatch.from_arrays(
                [pa.array(slot.astype(np.int32)), pa.array(total[slot].astype(np.int64))],
                names=["slot", "n"])

    def block(rows: pa.Table) -> pa.Table:
        slot, n = rows["slot"].to_numpy(), rows["n"].to_numpy()
        level = np.zeros(BLOCK, np.uint8)
        level[slot % BLOCK] = np.minimum(1 + (8 * np.log2(n)).astype(np.int64), 255)
        return pa.table({"block": pa.array([int(slot[0]) // BLOCK], pa.int32()),
                         "levels": pa.array([level.tobytes()], pa.binary())})

    sums = (texts.select("text").mapInArrow(count, "slot int, n long")
            .groupBy("slot").agg(F.sum("n").alias("n"))
            .groupBy(F.floor(F.col("slot") / BLOCK)).applyInArrow(
                block, "block int, levels binary"))
    out = np.zeros((GRAM_SLOTS // BLOCK, BLOCK), np.uint8)
    for row in sums.collect():
        out[row["block"]] = np.frombuffer(row["levels"], np.uint8)
    return out.ravel()


def _withstands(end: np.ndarray, edits: int) -> bool:
    """Whether so many edits leave one of the grams: from each word, the last word of the shortest
    gram that begins there, len(end) for none. An edit at the end of the gram that ends first
    destroys most."""
    first = np.minimum.accumulate(end[::-1])[::-1].tolist()
    at, n = 0, len(first)
    while at < n and first[at] < n:
        if not edits:
            return True
        edits -= 1
        at = first[at] + 1
    return False


def surviving(words: np.ndarray, levels: np.ndarray, similarity: float) -> np.ndarray:
    """The grams of a text of which any two linked texts have one in common, the last one first.

    The longer of two linked texts has at most 1 / similarity times the words of the other, so that
    (1 / similarity - 1) of a text's words bound the edits between it and any linked one. Under one
    order of grams, a text takes the first ones that so many edits cannot all destroy. Of two linked
    texts, the one that ends earlier in that order keeps one of its grams, which the other has taken
    too. Grams in few texts come first; grams of no other text count, but need not be met.
    """
    n, edits = len(words), int((1 / similarity - 1) * len(words) + 1e-8)
    by_size = _grams(words)
    grams = np.concatenate(by_size)
    level = levels[(grams % np.uint64(GRAM_SLOTS)).astype(np.int64)]
    order = np.lexsort((grams, level))
    rank = np.empty(len(grams), np.int64)
    rank[order] = np.arange(len(grams))
    ranks = np.split(rank, np.cumsum([len(g) for g in by_size])[:-1])

    def enough(taken: int) -> bool:
        end = np.full(n, n)
        for k in range(len(ranks) - 1, -1, -1):
            some = np.flatnonzero(ranks[k] < taken)
            end[some] = some + k
        return _withstands(end, edits)

    low, high = int((level <= 1).sum()), len(grams)
    if enough(low):
        return np.empty(0, np.uint64)
    while low + 1 < high:
        middle = (low + high) // 2
        low, high = (low, middle) if enough(middle) else (middle, high)
    last = order[high - 1]
    taken = (level < level[last]) | ((level == level[last]) & (grams <= grams[last]))
    return np.concatenate([grams[last:last + 1],
                           np.unique(grams[taken & (level > 1) & (grams != grams[last])])])


def with_grams(texts: DataFrame, levels: np.ndarray, similarity: float) -> DataFrame:
    """(tid, part_of, text) -> (key, tid, part_of, last), a row for each of the `surviving` grams
    and each of two ranges of lengths; last is the key of a text's last gram."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, bounds in W.slices(batches, limit=1 << 20):
            one = W.find(data, bounds, W.SPACES, W.SAME)
            yield _chosen(batch, [
                surviving(one.hash[one.first[i]:one.first[i + 1]], levels, similarity)
                for i in range(batch.num_rows)], np.diff(one.first))

    span = _span(F.col("n_words"), similarity)
    found = texts.mapInArrow(run, CHOSEN + ", n_words long").where(F.size("words") > 0)
    return found.select("tid", "part_of", "words",
                        F.explode(F.array(span, span + 1)).alias("span")).select(
        "tid", "part_of", "span", F.xxhash64(F.col("words")[0], "span").alias("last"),
        F.explode("words").alias("word")).select(
        F.xxhash64("word", "span").alias("key"), "tid", "part_of", "last")


def _span(n_words: Column, similarity: float) -> Column:
    """Linked texts lie in one range of lengths or in two adjacent ones: a bucket for each two."""
    return F.floor(F.log(n_words) / (math.log(1 / similarity) + 1e-9))


def _divided(members: DataFrame) -> DataFrame:
    """Members of buckets that hold texts of at least two components, each set of texts once; nor
    are buckets needed whose members all have one other as their `last`."""
    kept = F.col("low") != F.col("high")
    ends = []
    if "last" in members.columns:
        ends = [F.min("last").alias("first"), F.max("last").alias("last")]
        kept &= (F.col("first") != F.col("last")) | (F.col("last") == F.col("key"))
    several = (members.groupBy("key")
               .agg(F.min("part_of").alias("low"), F.max("part_of").alias("high"),
                    F.count("*").alias("n"), F.bit_xor(F.xxhash64("tid")).alias("one"),
                    F.bit_xor(F.xxhash64("tid", F.lit(1))).alias("two"), *ends)
               .where(kept)
               .groupBy("n", "one", "two").agg(F.min("key").alias("key")).select("key"))
    return members.select("key", "tid", "part_of").join(several, "key", "left_semi")


def _buckets(nodes: DataFrame, similarity: float) -> DataFrame:
    """(key, tid, part_of): nodes by the sketches that they share with another node."""
    entries = nodes.select("tid", "n_words", F.explode(F.array_distinct("keys")).alias("sketch"))
    shared = entries.groupBy("sketch").agg(F.count("*").alias("n")).where("n > 1").select("sketch")
    span = _span(F.col("n_words"), similarity)
    return _divided(
        entries.join(shared, "sketch", "left_semi")
        .select("tid", "sketch", F.explode(F.array(span, span + 1)).alias("span"))
        .select(F.xxhash64("sketch", "span").alias("key"), "tid", F.col("tid").alias("part_of")))


def near_links(rows: DataFrame, nodes: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """Verified links (tid, leader) between nodes (tid, doc_id, th, n_words, keys)."""
    frequency = frequencies(rows)

    def bodies_of(some: DataFrame) -> DataFrame:
        return rows.alias("d").join(
            some.alias("w"),
            F.col("d.doc_id").eqNullSafe(F.col("w.doc_id")) & (F.col("d.th") == F.col("w.th"))
        ).select("tid", "text").dropDuplicates(["tid"])

    short = bodies_of(nodes.where((F.col("n_words") > 0)
                                  & (F.col("n_words") * similarity < SHORT)))
    members = staged(
        _buckets(nodes, similarity).unionByName(_divided(staged(with_words(
            short.select("tid", F.col("tid").alias("part_of"), "text"),
            frequency, similarity), "short"))), "members")
    bodies = staged(bodies_of(
        nodes.select("tid", "doc_id", "th")
        .join(members.select("tid").distinct(), "tid", "left_semi")), "bodies")
    texts = bodies.withColumnRenamed("text", "other").withColumnRenamed("tid", "leader")
    bagged = staged(bags(bodies), "bags")
    others_bags = bagged.withColumnRenamed("bag", "other").withColumnRenamed("tid", "leader")
    # Lengths of linked texts differ by at most 1 / similarity. So a text at a share u of a leader
    # can be linked to one at a share s only if s <= (1 - similarity + u) / similarity.
    reach = ((1 - similarity) + F.col("share")) / similarity + 1e-9
    links, judged, leaders_each, split = [], None, 1, False
    while not members.isEmpty():
        part = F.pmod(F.xxhash64("tid", F.lit(leaders_each)), F.lit(leaders_each))
        leaders = staged(
            members.groupBy("key", part.alias("part"))
            .agg(F.min(F.struct("tid", "part_of")).alias("own"))
            .select("key", F.col("own.tid").alias("leader"),
                    F.col("own.part_of").alias("leads")), "leaders")
        met = staged(
            members.join(leaders, (members["key"] == leaders["key"])
                         & (members["part_of"] != leaders["leads"]))
            .select(members["key"], "leader", "leads", F.col("tid").alias("member"), "part_of",
                    F.least("tid", "leader").alias("tid"),
                    F.greatest("tid", "leader").alias("other")), "met")
        pairs = met.select("tid", F.col("other").alias("leader")).distinct()
        if judged is not None:
            pairs = pairs.join(judged, ["tid", "leader"], "left_anti")
        # most pairs are settled by their words alone; the others need the texts
        bound = staged(bounded(
            pairs.join(bagged, "tid").join(others_bags, "leader"), similarity), "bounds")
        found = staged(verified(
            bound.where("linked is null").select("tid", "leader")
            .join(bodies, "tid").join(texts, "leader"), similarity), "verdicts").unionByName(
            bound.where("not linked"))
        linked = found.where("linked").select("tid", "leader")
        links.append(linked)
        judged = found if judged is None else judged.unionByName(found)
        merged = components(
            met.join(linked.withColumnRenamed("leader", "other"), ["tid", "other"], "left_semi")
            .select(F.col("leads").alias("a"), F.col("part_of").alias("b")))

        def renamed(table: DataFrame, name: str) -> DataFrame:
            """The table with the components of this round."""
            return table.withColumnRenamed(name, "id").join(merged, "id", "left").withColumn(
                name, F.coalesce("label", "id")).drop("id", "label")

        # a leader has met every member that lies in another component, other leaders included
        led = leaders.select("key", F.col("leader").alias("tid"))
        seen = met.join(judged.withColumnRenamed("leader", "other"), ["tid", "other"]).select(
            "key", "leader", "leads", F.col("member").alias("tid"), "part_of", "linked", "share")
        near = staged(seen.where("linked").select("key", "leader", "tid", "share"), "near")
        # only leaders with linked members have some that may be done
        others = (seen.where("not linked")
                  .join(near.select("key", "leader").distinct(), ["key", "leader"], "left_semi")
                  .join(led, ["key", "tid"], "left_anti")
                  .groupBy("key", "leader", "leads", "part_of").agg(F.min("share").alias("share")))
        apart = (renamed(renamed(others, "leads"), "part_of")
                 .where(F.col("leads") != F.col("part_of"))
                 .groupBy("key", "leader").agg(F.min("share").alias("least")))
        # done: near enough to a leader that nothing outside the component can be linked to it
        done = (near.join(apart, ["key", "leader"], "left")
                .where(F.col("least").isNull() | (F.col("least") > reach))
                .select("key", "tid"))
        left = staged(renamed(
            members.join(led.unionByName(done).distinct(), ["key", "tid"], "left_anti"),
            "part_of"), "left")
        leaders_each *= 16
        if split:
            members = staged(_divided(left), "members")
        else:
            # what the leaders did not settle meets again, all texts by their rarest grams
            again = staged(
                left.select("tid", "part_of").distinct().join(bodies, "tid"), "open")
            members = staged(_divided(staged(
                with_grams(again, gram_levels(again), similarity), "grams")), "members")
            split = True
    if not links:
        return nodes.select("tid", F.col("tid").alias("leader")).where(F.lit(False))
    out = links[0]
    for more in links[1:]:
        out = out.unionByName(more)
    return out


def near_classes(docs: DataFrame, key: str = "doc_id", text: str = "text",
                 similarity: float = SIMILARITY, gram: int = GRAM, count: int = SKETCHES,
                 width: int = TUPLE) -> DataFrame:
    """One row per document: doc_id, th, class_id (its smallest doc_id), class_th, n_links (links
    of its text that were verified) and representative (whether the row names its class)."""
    rows = text_rows(docs, key, text)
    found = staged(sketched(rows, gram, count, width), "sketches")
    nodes = staged(
        found.groupBy("tid").agg(
            F.min(F.struct("doc_id", "th")).alias("own"), F.first("n_words").alias("n_words"),
            F.first("keys").alias("keys"))
        .select("tid", "own.doc_id", "own.th", "n_words", "keys"), "nodes")
    with dropped_shuffles(docs.sparkSession):
        links = staged(near_links(rows, nodes, similarity), "links")
    groups = components(links.select(F.col("tid").alias("a"), F.col("leader").alias("b")))
    degree = (links.select("tid").unionAll(links.select("leader"))
              .groupBy("tid").agg(F.count("*").alias("n_links")))
    labelled = staged(
        nodes.drop("keys", "n_words").join(groups.withColumnRenamed("id", "tid"), "tid", "left")
        .join(degree, "tid", "left")
        .select("tid", "doc_id", "th", F.coalesce("label", "tid").alias("label"),
                F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links")), "labelled")
    heads = labelled.groupBy("label").agg(F.min(F.struct("doc_id", "th")).alias("head"))
    named = labelled.join(heads, "label").select("tid", "head", "n_links")
    return found.select("doc_id", "th", "n_words", "tid").join(named, "tid").select(
        "doc_id", "th", "n_words", F.col("head.doc_id").alias("class_id"),
        F.col("head.th").alias("class_th"), "n_links",
        (F.col("doc_id").eqNullSafe(F.col("head.doc_id")) & (F.col("th") == F.col("head.th")))
        .alias("representative"))
