"""Toxic passages as maximum-scoring segments.

Every word has a score: its log-odds between toxic and clean documents under an informative
Dirichlet prior (the words of all documents), shrunk towards 0 by SURE standard errors (what is
then below LEAST counts as 0), minus a small drift, so that neutral text scores below 0. A word
without evidence of its own has the score of its longest beginning that has some. A linear scan
finds all maximal segments of a text, those that no longer segment holds and improves. Their
significance follows the extreme-value law: a segment of score S in n words has
E = K n exp(-lambda S) equals by chance, where lambda solves sum p(s) exp(lambda s) = 1 over the
words of clean documents that were not learned from, and K is counted on them. A document's
statistic is the sum statistic of that law, the sum of lambda S - log(K n) over the segments that
add to it (the best alone if none does). It is turned into a probability on a fold of the labelled
rows that the words were not learned from, by the non-decreasing share of toxic documents that
fits best (pooled neighbours).

Words and beginnings are hashed to 2 ** BITS places, so the table of scores has the same size for
any corpus; two of one place share a score. At most about MAX_LABELLED labelled rows, chosen by a
hash of their id, are learned from; the prior counts every document.

Defined cases: null and empty texts have no words and get the score of documents without a toxic
segment. Without toxic or without clean labelled rows every score is the smoothed share of toxic
ones. Labels other than 0 and 1, null ids and null labels are not learned from; if an id has
several labels, the largest counts. Repeated documents each get their result. Texts are used whole;
other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm import words as W
from ledgerlens.llm.tables import text_of
from ledgerlens.sources.staging import checked_broadcast, staged

BITS = 21
#: Lengths of the beginnings that stand for words without evidence, the longest first.
STEMS = (7, 6, 5, 4)
#: Bound of the labelled rows that are learned from (expected number; a hash decides).
MAX_LABELLED = 500_000
PRIOR = 0.1     # strength of the prior, as a share of the labelled words
SURE = 4.0      # standard errors taken off each log-odds
LEAST = 1.0     # smaller shrunk log-odds count as 0
DRIFT = 0.1     # taken off every word
SIGNIFICANT = 0.01  # largest E of a reported passage
#: Every fourth labelled row calibrates.
FOLDS = 4
_STEP, _GRID = 0.5, 0.05
_BINS = np.concatenate([[-np.inf], np.arange(-20.0, 100.0, _STEP), [np.inf]])


def places(found: W.Words) -> list[tuple[np.ndarray | slice, np.ndarray]]:
    """For words, then for each length of beginnings: which words, and their places."""
    out = [(slice(None), found.hash)]
    for letters in STEMS:
        longer, stem = W.stems(found, letters)
        out.append((longer, W.mix(stem + np.uint64(letters))))
    return [(at, (h >> np.uint64(64 - BITS)).astype(np.int64)) for at, h in out]


def word_scores(found: W.Words, table: np.ndarray) -> np.ndarray:
    (_, own), *stems = places(found)
    out = table[own]
    for longer, place in stems:
        value = out[longer]
        out[longer] = np.where(value == 0, table[place], value)
    return out


def labelled(docs: DataFrame, labels: DataFrame, learnable: Column, key: str = "doc_id",
             label: str = "toxic", most: int = MAX_LABELLED) -> DataFrame:
    """docs plus `toxic` (null where not learned from) and `fold`. The labels join as a broadcast
    of a bounded number of rows (or shuffled, if their measured size says otherwise)."""
    rows = (labels.where(F.col(key).isNotNull() & F.col(label).isin(0, 1) & learnable)
            .groupBy(F.col(key).alias("_id")).agg(F.max(label).cast("int").alias("toxic")))
    rows = rows.withColumn("_h", F.xxhash64(F.col("_id").cast("string"), F.lit("toxicity")))
    total = rows.count()
    share = min(1.0, most / max(total, 1))
    if share < 1:
        rows = rows.where(F.pmod("_h", F.lit(1 << 20)) < int(share * (1 << 20)))
    rows = staged(rows.select("_id", "toxic", F.pmod(F.shiftright("_h", 24), F.lit(FOLDS))
                              .cast("int").alias("fold")), "labels")
    return docs.join(checked_broadcast(rows), F.col(key) == F.col("_id"), "left").drop("_id")


def word_counts(rows: DataFrame) -> DataFrame:
    """(place, n, toxic, clean) of (text, toxic, fold): occurrences in all rows, and in the
    labelled ones outside the calibration fold. Each task adds up before the shuffle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((3, 1 << BITS), np.int32)
        for batch, data, bounds in W.slices(batches):
            found = W.find(data, bounds, W.MARKS, W.FOLDED)
            toxic = batch.column(1).fill_null(-1).to_numpy()
            fold = batch.column(2).fill_null(0).to_numpy()
            learns = (toxic >= 0) & (fold != 0)
            kind = np.where(learns & (toxic == 1), 1, np.where(learns, 2, 0))[found.doc]
            for at, place in places(found):
                np.add.at(total[0], place, 1)
                for k in (1, 2):
                    np.add.at(total[k], place[kind[at] == k], 1)
        at = np.flatnonzero(total[0])
        if len(at):
            yield pa.RecordBatch.from_arrays(
                [pa.array(at.astype(np.int32)), *(pa.array(t[at].astype(np.int64)) for t in total)],
                names=["place", "n", "toxic", "clean"])

    parts = rows.select("text", "toxic", "fold").mapInArrow(
        run, "place int, n long, toxic long, clean long")
    return parts.groupBy("place").agg(
        F.sum("n").alias("n"), F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def log_odds(counts: DataFrame) -> DataFrame:
    """(place, score): the shrunk log-odds of the places where they differ from 0. A word
    and its beginnings count as so many tokens, alike in both classes."""
    sums = counts.agg(F.sum("n").alias("n"), F.sum("toxic").alias("t"),
                      F.sum("clean").alias("c")).first()
    n, toxic, clean = (float(x or 0) for x in sums)
    if not toxic or not clean:
        return counts.select("place", F.lit(0.0).alias("score")).where(F.lit(False))
    strength = PRIOR * (toxic + clean)
    prior = F.col("n") * (strength / n)

    def odds(column: str, total: float) -> Column:
        own = F.col(column) + prior
        return F.log(own / (total + strength - own))

    delta = odds("toxic", toxic) - odds("clean", clean)
    error = F.sqrt(1 / (F.col("toxic") + prior) + 1 / (F.col("clean") + prior))
    sure = F.greatest(F.abs(delta) - SURE * error, F.lit(0.0))
    return counts.select("place", (F.signum(delta) * sure).alias("score")).where(
        F.abs("score") >= LEAST)


@dataclass
class Model:
    places: np.ndarray
    scores: np.ndarray
    scale: float      # lambda
    chance: float     # K
    knots: np.ndarray   # statistics, and the share of toxic documents there
    shares: np.ndarray
    none: float       # share among documents without a segment

    def table(self) -> np.ndarray:
        out = np.zeros(1 << BITS, np.float32)
        out[self.places] = self.scores
        return out


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal segments (first, after the last, score) of a sequence of scores."""
    total = np.concatenate([[0.0], np.cumsum(scores, dtype=np.float64)])
    found: list[list] = []  # [first, after, sum before, sum after, nearest earlier with less before]
    for at in np.flatnonzero(scores > 0).tolist():
        new = [at, at + 1, total[at], total[at + 1], None]
        j = len(found) - 1
        while True:
            while j >= 0 and found[j][2] >= new[2]:
                j = found[j][4]
            if j < 0 or found[j][3] >= new[3]:
                new[4] = j
                found.append(new)
                break
            new[0], new[2] = found[j][0], found[j][2]
            before = found[j][4]
            del found[j:]
            j = before
    return [(f, a, float(high - low)) for f, a, low, high, _ in found]


def _document(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """Segments of a text; long neutral stretches are one step each."""
    at = np.flatnonzero(scores)
    if not len(at) or not (scores[at] > DRIFT).any():
        return []
    # words with a score, each preceded by the drift of the words before it
    gap = np.diff(at, prepend=-1) - 1
    steps = np.empty(2 * len(at))
    steps[0::2] = -DRIFT * gap
    steps[1::2] = scores[at] - DRIFT
    return [(int(at[f // 2]), int(at[(a - 1) // 2]) + 1, s) for f, a, s in segments(steps)]


def _scale(scores: np.ndarray, share: np.ndarray) -> float:
    """The positive root of sum share * exp(x * score) = 1."""
    def value(x: float) -> float:
        return float((share * np.exp(np.minimum(x * scores, 700))).sum()) - 1

    high = 1e-3
    while value(high) <= 0 and high < 1e4:
        high *= 2
    low = 0.0
    for _ in range(100):
        middle = (low + high) / 2
        low, high = (middle, high) if value(middle) <= 0 else (low, middle)
    return high


def _pooled(x: np.ndarray, toxic: np.ndarray, clean: np.ndarray, base: float):
    """Knots and non-decreasing shares; each bin has half a document at the base rate as prior."""
    some = toxic + clean > 0
    blocks: list[list[float]] = []  # [toxic, all, sum of x]
    for at, t, c in zip(x[some], toxic[some], clean[some], strict=True):
        blocks.append([t, t + c, at * (t + c)])
        while len(blocks) > 1 and (blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]):
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last, strict=True)]
    if not blocks:
        return np.array([0.0]), np.array([base])
    t, n, total = np.array(blocks).T
    return total / n, np.maximum.accumulate((t + 0.5 * base) / (n + 0.5))


def learn(rows: DataFrame) -> Model:
    """Model from (text, toxic, fold). What comes to the driver is bounded by 2 ** BITS places
    and the bins of one histogram."""
    counts = staged(word_counts(rows), "words")
    odds = log_odds(counts).toArrow().to_pydict()
    place, score = np.array(odds["place"], np.int64), np.array(odds["score"], np.float32)
    held = rows.where(F.col("toxic").isNotNull() & (F.col("fold") == 0))
    model = Model(place, score, 1.0, 1.0, np.zeros(1), np.zeros(1), 0.0)
    # lambda, from clean documents that the scores were not learned from
    seen = _clean_scores(held, model).groupBy("bin").agg(F.sum("n")).collect()
    if any(bin_ * _GRID > DRIFT for bin_, _ in seen):
        bins, n = (np.array(x, float) for x in zip(*seen, strict=True))
        model.scale = _scale(bins * _GRID - DRIFT, n / n.sum())
    _, words, found = _histogram(held, model)
    # K, from the segments of at least 1 / lambda
    model.chance = (found[0].sum() + 1) / (words[0].sum() + 100) * math.e
    docs, _, _ = _histogram(held, model)
    base = float((docs[1].sum() + 0.5) / (docs.sum() + 1))
    model.knots, model.shares = _pooled(
        np.append(_BINS[1], _BINS[1:-1] + _STEP / 2), docs[1, 1:], docs[0, 1:], base)
    model.none = float((docs[1, 0] + base) / (docs[:, 0].sum() + 1))
    return model


def _histogram(rows: DataFrame, model: Model) -> np.ndarray:
    """Documents, words and notable segments by label and bin."""
    out = np.zeros((3, 2, len(_BINS)))
    for bin_, toxic, *sums in _measured(rows, model).groupBy("bin", "toxic").agg(
            F.sum("docs"), F.sum("words"), F.sum("found")).collect():
        out[:, toxic, bin_] = sums
    return out


def _statistic(found: list[tuple[int, int, float]], words: int, model: Model) -> float:
    values = model.scale * np.array([s for _, _, s in found]) - math.log(model.chance * words)
    return float(values[values > 0].sum()) if (values > 0).any() else float(values.max())


def probability(model: Model, statistic: np.ndarray) -> np.ndarray:
    """The pooled share, with a hundredth for the order within a block."""
    share = np.interp(statistic, model.knots, model.shares)
    order = 1 / (1 + np.exp(-np.clip(statistic / 20, -30, 30)))
    return np.where(np.isnan(statistic), min(model.none, model.shares[0]), 0.99 * share + 0.01 * order)


def _clean_scores(rows: DataFrame, model: Model) -> DataFrame:
    """(bin, n): a histogram of the scores of the words of clean documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = model.table()
        for batch, data, bounds in W.slices(batches):
            found = W.find(data, bounds, W.MARKS, W.FOLDED)
            bins, n = np.unique(np.round(word_scores(found, table) / _GRID).astype(np.int32),
                                return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(bins), pa.array(n)], names=["bin", "n"])

    return rows.where(F.col("toxic") == 0).select(text_of().alias("text")).mapInArrow(
        run, "bin int, n long")


def _measured(rows: DataFrame, model: Model) -> DataFrame:
    """(bin, toxic, docs, words, found): a histogram of the statistic; bin 0: no segment."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = model.table()
        sums = np.zeros((2, len(_BINS), 3), np.int64)
        for batch, data, bounds in W.slices(batches):
            found = W.find(data, bounds, W.MARKS, W.FOLDED)
            score, toxic = word_scores(found, table), batch.column(1).to_numpy()
            for r in range(batch.num_rows):
                low, high = found.first[r], found.first[r + 1]
                own = _document(score[low:high])
                bin_ = int(np.searchsorted(
                    _BINS, _statistic(own, high - low, model), side="right")) if own else 0
                sums[toxic[r], bin_] += (1, high - low,
                                         sum(s * model.scale >= 1 for _, _, s in own))
        label, bin_ = np.nonzero(sums[:, :, 0])
        yield pa.RecordBatch.from_arrays(
            [pa.array(bin_.astype(np.int32)), pa.array(label.astype(np.int32)),
             *(pa.array(sums[label, bin_, k]) for k in range(3))],
            names=["bin", "toxic", "docs", "words", "found"])

    return rows.select(text_of().alias("text"), "toxic").mapInArrow(
        run, "bin int, toxic int, docs long, words long, found long")


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """All columns of docs but the text, plus score, predicted and the significant passages
    (first word, word after the last, score in bits of evidence, E)."""
    keep = [c for c in docs.columns if c != text]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = model.table()
        for batch, data, bounds in W.slices(batches):
            found = W.find(data, bounds, W.MARKS, W.FOLDED)
            weight = word_scores(found, table)
            # texts without a word that could start a passage need no scan
            some = np.zeros(batch.num_rows, bool)
            some[found.doc[weight > DRIFT]] = True
            value = np.full(batch.num_rows, np.nan)
            passages: list[list] = [[]] * batch.num_rows
            for r in np.flatnonzero(some).tolist():
                low, high = int(found.first[r]), int(found.first[r + 1])
                own = _document(weight[low:high])
                if own:
                    value[r] = _statistic(own, high - low, model)
                    passages[r] = [
                        {"start": f, "end": a, "score": s, "e": e} for f, a, s in own
                        if (e := model.chance * (high - low) * math.exp(-model.scale * s))
                        <= SIGNIFICANT]
            chance = probability(model, value)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(len(keep))), pa.array(chance),
                 pa.array((chance >= 0.5).astype(np.int32)),
                 pa.array(passages, pa.list_(pa.struct(
                     [("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64()),
                      ("e", pa.float64())])))],
                names=[*keep, "score", "predicted", "passages"])

    fields = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    return docs.select(*keep, text_of(text).alias("text")).mapInArrow(
        run, f"{fields + ', ' if keep else ''}score double, predicted int, passages "
             "array<struct<start:int,end:int,score:double,e:double>>")
