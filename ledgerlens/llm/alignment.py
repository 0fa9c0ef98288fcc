"""Alignment of two tokenizers' ids by the byte offsets where both end a token.

A text is cut into units before a space or line break that follows another character: neither
tokenizer joins anything over such a place, so a unit's tokens are the text's tokens there, and a
unit that came before needs no second encoding. (Whether the second vocabulary allows this is read
from its pieces; if not, a text is one unit.)

Long documents are cut into byte ranges wherever the range ends. What a task makes of its range is
a fragment: an open head (text before the first place to cut), closed groups, an open tail. Two
neighbouring fragments compose: the left one's tail and the right one's head are joined, what has
become whole is closed, and the outer ends stay open. This is associative, and the empty text is
neutral, so fragments are reduced by a tree over Spark tasks, ``FAN`` neighbours at a time, until
one is left for each document and its two ends close. Closed groups are written where they arise
and never travel up the tree.

Links between ids are counted over documents, then looked up again for every document: in a sorted
table if its size is small as counted, else by a join that spreads frequent links.

Defined cases: texts that are null or empty, or whose bytes one of the tokenizers does not keep,
have no tokens: all numbers 0 and groups ''. They add nothing to the counts. Rows are documents of
their own, also if they repeat or have no id. Other columns are ignored. An empty table gives no
rows. Texts are used whole.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.operators.lookup import lookup
from ledgerlens.sources.staging import staged

RANGE = 1 << 16        # bytes of a text that one task aligns at a time
FAN = 16               # fragments that are composed at once
AT_ONCE = 1 << 21      # characters encoded at a time
REMEMBERED = 300_000   # units a task keeps; beyond it starts anew, a matter of speed only
KNOWN_LINKS = 2_000_000  # link counts that are sent to all tasks (24 bytes each)

MARK = "▁"
_CUT = re.compile(r"(?<=\S)(?=[ \n])")
_RUN = re.compile(r"\s[ \n]")


def byte_alphabet() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary: printable ones for
    themselves, the others for characters from 256 on, in order."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + n): b for n, b in enumerate(rest)}


class Units(dict):
    """Numbers of units; unknown ones are noted for the next round of encoding."""

    def __init__(self):
        super().__init__()
        self.fresh: list[str] = []

    def __missing__(self, unit: str) -> int:
        number = self[unit] = len(self)
        self.fresh.append(unit)
        return number


class Aligner:
    """Tokens, groups and links of units, in arrays by unit number."""

    def __init__(self, first: str, second: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.first = Tokenizer.from_file(first)
        self.first.encode_special_tokens = True
        self.second = SentencePieceProcessor(model_file=second)
        alphabet = byte_alphabet()
        names = [self.first.id_to_token(i) or "" for i in range(self.first.get_vocab_size())]
        self.first_bytes = [bytes(alphabet[c] for c in name) if all(c in alphabet for c in name)
                            else name.encode() for name in names]
        ids = range(self.second.get_piece_size())
        pieces = [self.second.id_to_piece(i) for i in ids]
        self.second_bytes = [
            bytes([int(p[3:5], 16)]) if self.second.is_byte(i)
            else p.replace(MARK, " ").encode() for i, p in zip(ids, pieces, strict=True)]
        self.mark = self.second.piece_to_id(MARK)
        joins = re.compile(f"[^{MARK}]{MARK}|\n")
        self.cuts = self.mark != self.second.unk_id() and not any(map(joins.search, pieces))
        self.lengths = [np.array([len(b) for b in x], np.int64)
                        for x in (self.first_bytes, self.second_bytes)]
        self.names = [list(map(str, range(len(x)))) for x in (self.first_bytes, self.second_bytes)]
        self.width = len(pieces)
        self.forget()

    def forget(self) -> None:
        self.known = Units()
        self.groups: list[str] = []
        self.ok = np.empty(0, bool)
        self.sums = np.empty((4, 0), np.int64)  # first tokens, second tokens, groups, links
        self.at = np.zeros(1, np.int64)
        self.pairs = np.empty(0, np.int64)

    def split(self, text: str) -> list[str]:
        if not self.cuts:
            return [text]
        if "\x00" in text or _RUN.search(text):
            return _CUT.split(text)
        # the same for texts without runs of white space; the first character is white space
        return (text[0] + text[1:].replace(" ", "\x00 ").replace("\n", "\x00\n")).split("\x00")

    def numbers(self, units: list[str]) -> np.ndarray:
        out = np.fromiter(map(self.known.__getitem__, units), np.int64, len(units))
        if self.known.fresh:
            self._learn(self.known.fresh)
            self.known.fresh = []
        return out

    def _encoded(self, units: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        first = [e.ids for e in self.first.encode_batch_fast(units, add_special_tokens=False)]
        # The second tokenizer adds a space of its own, though not to the empty text: the unit's, or
        # one that is dropped again.
        second = self.second.encode([u[1:] if u[:1] == " " else u for u in units], num_threads=1)
        return first, [[self.mark] if u == " " else ids if u[:1] == " " else
                       ids[1:] if ids[:1] == [self.mark] else []
                       for u, ids in zip(units, second, strict=True)]

    def _keeps(self, unit: str, first: list[int], second: list[int]) -> bool:
        raw = unit.encode()
        return (b"".join(self.first_bytes[i] for i in first) == raw
                and b"".join(self.second_bytes[i] for i in second) == raw)

    def _learn(self, units: list[str]) -> None:
        ids = self._encoded(units)
        raw = "".join(units).encode()
        whole = [b"".join([kept[i] for i in chain.from_iterable(x)]) == raw for x, kept in
                 zip(ids, (self.first_bytes, self.second_bytes), strict=True)]
        size = np.array([len(u.encode()) for u in units], np.int64)
        ok = np.ones(len(units), bool)
        per_unit = [np.array([sum(map(n.__getitem__, x)) for x in side], np.int64)
                    for side, n in zip(ids, [n.tolist() for n in self.lengths], strict=True)]
        if not all(whole) or any((n != size).any() for n in per_unit):
            ok = np.array([self._keeps(u, a, b) for u, a, b in zip(units, *ids, strict=True)])
            ids = [[x if k else [] for x, k in zip(side, ok, strict=True)] for side in ids]
        counts = [np.array([len(x) for x in side], np.int64) for side in ids]
        flat = [np.fromiter(chain.from_iterable(side), np.int64, int(n.sum()))
                for side, n in zip(ids, counts, strict=True)]
        ends = [np.cumsum(n[x]) for n, x in zip(self.lengths, flat, strict=True)]
        # Every stretch between two token ends of either side is one link.
        stops = np.unique(np.concatenate(ends))
        held = [np.searchsorted(e, stops) for e in ends]
        owner = np.searchsorted(np.cumsum(size * ok), stops)
        closed = np.ones(len(stops), bool)
        for e, h in zip(ends, held, strict=True):
            closed &= e[h] == stops
        links = np.bincount(owner, minlength=len(units))
        groups = np.bincount(owner[closed], minlength=len(units))
        names = []
        for x, h, named in zip(flat, held, self.names, strict=True):
            texts, upto = list(map(named.__getitem__, x.tolist())), [0, *(h[closed] + 1).tolist()]
            names.append([",".join(texts[a:b]) for a, b in zip(upto, upto[1:], strict=False)])
        joined = [f"{a}|{b}" for a, b in zip(*names, strict=True)]
        upto = [0, *np.cumsum(groups).tolist()]
        self.groups += [";".join(joined[a:b]) for a, b in zip(upto, upto[1:], strict=False)]
        self.ok = np.append(self.ok, ok)
        self.sums = np.append(self.sums, np.stack([*counts, groups, links]), axis=1)
        self.at = np.append(self.at, self.at[-1] + np.cumsum(links))
        self.pairs = np.append(self.pairs, flat[0][held[0]] * self.width + flat[1][held[1]])

    def runs(self, texts: list[list[str]], digests: bool) -> list[pa.Array]:
        """ok, four sums, groups or their digest, links, times; one value for each list of units.

        An empty list has no tokens and is not ok.
        """
        if len(self.known) > REMEMBERED:
            self.forget()
        size = np.array([len(x) for x in texts], np.int64)
        number = self.numbers(list(chain.from_iterable(texts)))
        doc = np.repeat(np.arange(len(texts)), size)
        ok = (size > 0) & (np.bincount(doc, ~self.ok[number], len(texts)) == 0)
        number, doc, size = number[ok[doc]], doc[ok[doc]], size * ok
        # as doubles, exact below 2 ** 53
        sums = [np.bincount(doc, s[number], len(texts)).astype(np.int64) for s in self.sums]
        upto = [0, *np.cumsum(size).tolist()]
        named = list(map(self.groups.__getitem__, number.tolist()))
        groups = [";".join(named[a:b]) for a, b in zip(upto, upto[1:], strict=False)]
        if digests:
            groups = [hashlib.sha256(g.encode()).hexdigest() if g else "" for g in groups]
        # distinct units of each text, then their links
        wide = max(1, len(self.known))
        unit, times = np.unique(doc * wide + number, return_counts=True)
        doc, unit = unit // wide, unit % wide
        links = self.sums[3][unit]
        place = np.arange(int(links.sum())) - np.repeat(np.cumsum(links) - links, links)
        pair = self.pairs[np.repeat(self.at[unit], links) + place]
        scale = self.width * len(self.first_bytes)
        key = np.repeat(doc, links) * scale + pair
        order = np.argsort(key, kind="stable")
        key, times = key[order], np.repeat(times, links)[order]
        start = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else key
        times = np.add.reduceat(times, start) if len(start) else times
        offsets = np.searchsorted(key[start] // scale, np.arange(len(texts) + 1))
        listed = pa.array(offsets, pa.int32())
        return [pa.array(ok), *map(pa.array, sums), pa.array(groups, pa.string()),
                pa.ListArray.from_arrays(listed, pa.array(key[start] % scale)),
                pa.ListArray.from_arrays(listed, pa.array(times, pa.int32()))]


SUMS = ["n_a", "n_b", "n_groups", "n_links"]
RUN = "ok boolean, n_a long, n_b long, n_groups long, n_links long, groups string, " \
      "links array<long>, times array<int>"
RUN_NAMES = ["ok", *SUMS, "groups", "links", "times"]

_ALIGNERS: dict[tuple[str, str], Aligner] = {}  # of this worker


def aligner_of(paths: tuple[str, str]) -> Aligner:
    if paths not in _ALIGNERS:
        _ALIGNERS[paths] = Aligner(*paths)
    return _ALIGNERS[paths]


def slices(lengths: list[int], limit: int = AT_ONCE) -> Iterator[tuple[int, int]]:
    low = 0
    while low < len(lengths):
        high, size = low, 0
        while high < len(lengths) and size < limit:
            size += lengths[high]
            high += 1
        yield low, high
        low = high


def short_runs(rows: DataFrame, paths: tuple[str, str], digests: bool) -> DataFrame:
    """(rid, doc_id, run) of texts that one task aligns whole."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = aligner_of(paths)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for low, high in slices([len(t or "") for t in texts]):
                found = aligner.runs(
                    [aligner.split(" " + t) if t else [] for t in texts[low:high]], digests)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(c).slice(low, high - low) for c in ("rid", "doc_id")] + found,
                    names=["rid", "doc_id", *RUN_NAMES])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"rid long, doc_id {kind}, {RUN}")


def byte_ranges(rows: DataFrame, size: int) -> DataFrame:
    """(rid, seq, at, text): the space and the text, cut every ``size`` bytes or up to three bytes
    later, where a character ends."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rid, text in zip(batch.column("rid").to_pylist(),
                                 batch.column("text").to_pylist(), strict=True):
                raw = b" " + text.encode()
                edges = [0]
                while edges[-1] < len(raw):
                    edge = min(edges[-1] + size, len(raw))
                    while edge < len(raw) and raw[edge] & 0xC0 == 0x80:
                        edge += 1
                    edges.append(edge)
                for low, high in slices([size] * (len(edges) - 1)):
                    parts = [raw[edges[i]:edges[i + 1]].decode() for i in range(low, high)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([rid] * len(parts)), pa.array(range(low, high), pa.int64()),
                         pa.array(edges[low:high], pa.int64()), pa.array(parts)],
                        names=["rid", "seq", "at", "text"])

    return rows.mapInArrow(run, "rid long, seq long, at long, text string")


class Fragment:
    """Open ends of a byte range: the text before its first and after its last place to cut. If
    there is no such place, ``tail`` is None and ``head`` all of it."""

    def __init__(self, at: int, head: str, tail: str | None = None, tail_at: int = 0):
        self.at, self.head, self.tail, self.tail_at = at, head, tail, tail_at

    @classmethod
    def of(cls, aligner: Aligner, at: int, text: str) -> tuple[Fragment, list]:
        """A range's fragment and its closed units, as [(at, units)]."""
        units = _CUT.split(text) if aligner.cuts else [text]
        if len(units) == 1:
            return cls(at, text), []
        inner = at + len(units[0].encode())
        tail_at = at + len(text.encode()) - len(units[-1].encode())
        return (cls(at, units[0], units[-1], tail_at),
                [(inner, units[1:-1])] if len(units) > 2 else [])

    def then(self, aligner: Aligner, right: Fragment) -> tuple[Fragment, list]:
        """The fragment of both ranges, and the units that close between them."""
        if not right.head and right.tail is None:
            return self, []
        if not self.head and self.tail is None:
            return right, []
        open_at = self.at if self.tail is None else self.tail_at
        left = self.head if self.tail is None else self.tail
        joined = left + right.head
        units = _CUT.split(joined) if aligner.cuts else [joined]
        # Two units: the ranges met at a place to cut, which is where the right one begins.
        places = [open_at, right.at][:len(units)]
        pieces = list(zip(places, units, strict=True))
        head_at, head = (self.at, self.head) if self.tail is not None else pieces.pop(0)
        if right.tail is not None:
            tail_at, tail = right.tail_at, right.tail
        else:
            tail_at, tail = pieces.pop() if pieces else (0, None)
        return Fragment(head_at, head, tail, tail_at), [(at, [u]) for at, u in pieces]

    def ends(self) -> list:
        """The units that close when nothing comes before or after."""
        out = [(self.at, [self.head])] if self.head else []
        return out + ([(self.tail_at, [self.tail])] if self.tail else [])


FRAGMENT = "rid long, seq long, at long, head string, tail string, tail_at long"
FRAGMENT_NAMES = ["rid", "seq", "at", "head", "tail", "tail_at"]
STEP = f"{FRAGMENT}, {RUN}"


def step_rows(aligner: Aligner, fragments: list, closed: list) -> Iterator[pa.RecordBatch]:
    """Rows of a step: fragments [(rid, seq, Fragment)], and runs of [(rid, at, units)]."""
    schema = pa.schema([
        ("rid", pa.int64()), ("seq", pa.int64()), ("at", pa.int64()), ("head", pa.string()),
        ("tail", pa.string()), ("tail_at", pa.int64()), ("ok", pa.bool_()),
        *[(name, pa.int64()) for name in SUMS], ("groups", pa.string()),
        ("links", pa.list_(pa.int64())), ("times", pa.list_(pa.int32()))])
    if fragments:
        yield pa.RecordBatch.from_pylist(
            [{"rid": rid, "seq": seq, **vars(f)} for rid, seq, f in fragments], schema)
    for low, high in slices([sum(map(len, units)) for _, _, units in closed]):
        part = closed[low:high]
        found = dict(zip(RUN_NAMES, aligner.runs([u for _, _, u in part], False), strict=True))
        found |= {"rid": pa.array([c[0] for c in part]), "at": pa.array([c[1] for c in part])}
        yield pa.RecordBatch.from_arrays(
            [found[f.name].cast(f.type) if f.name in found else pa.nulls(len(part), f.type)
             for f in schema], schema=schema)


def opened(ranges: DataFrame, paths: tuple[str, str]) -> DataFrame:
    """Fragments and closed runs of byte ranges."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = aligner_of(paths)
        for batch in batches:
            rows = batch.to_pylist()
            for low, high in slices([len(r["text"]) for r in rows]):
                fragments, closed = [], []
                for r in rows[low:high]:
                    fragment, units = Fragment.of(aligner, r["at"], r["text"])
                    fragments.append((r["rid"], r["seq"], fragment))
                    closed += [(r["rid"], *x) for x in units]
                yield from step_rows(aligner, fragments, closed)

    return ranges.mapInArrow(run, STEP)


def composed(fragments: DataFrame, paths: tuple[str, str], fan: int) -> DataFrame:
    """One level of the tree: ``fan`` neighbours become one fragment, with the runs they close."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = aligner_of(paths)
        group, held = None, None
        for batch in batches:
            done, closed = [], []
            for r in batch.to_pylist():
                fragment = Fragment(r["at"], r["head"], r["tail"], r["tail_at"])
                if (r["rid"], r["seq"] // fan) != group:
                    if held:
                        done.append((*group, held))
                    group, held = (r["rid"], r["seq"] // fan), fragment
                else:
                    held, units = held.then(aligner, fragment)
                    closed += [(r["rid"], *x) for x in units]
            yield from step_rows(aligner, done, closed)
        if held:
            yield from step_rows(aligner, [(*group, held)], [])

    parent = F.expr(f"seq div {fan}")
    dealt = fragments.repartition("rid", parent).sortWithinPartitions("rid", "seq")
    return dealt.mapInArrow(run, STEP)


def closed_ends(roots: DataFrame, paths: tuple[str, str]) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = aligner_of(paths)
        for batch in batches:
            yield from step_rows(aligner, [], [
                (r["rid"], *x) for r in batch.to_pylist()
                for x in Fragment(r["at"], r["head"], r["tail"], r["tail_at"]).ends()])

    return roots.mapInArrow(run, STEP)


def long_runs(rows: DataFrame, paths: tuple[str, str], size: int, fan: int) -> DataFrame:
    """(rid, at, run): closed runs of long texts, whose order is that of their places."""
    ranges = staged(byte_ranges(rows.select("rid", "text"), size), "ranges")
    step = staged(opened(ranges.repartition("rid", "seq"), paths), "opened")
    runs = None

    def keep(step: DataFrame) -> DataFrame:
        closed = step.where(F.col("seq").isNull()).select("rid", "at", *RUN_NAMES)
        return closed if runs is None else runs.unionByName(closed)

    while True:
        runs = keep(step)
        fragments = step.where(F.col("seq").isNotNull()).select(*FRAGMENT_NAMES)
        if not (fragments.agg(F.max("seq")).first()[0] or 0):
            break
        step = staged(composed(fragments, paths, fan), "composed")
    step = staged(closed_ends(fragments, paths), "ends")
    return keep(step)


def link_counts(short: DataFrame, long: DataFrame, width: int) -> DataFrame:
    """(link, n, best): how many documents hold a link, and whether no link of the same first id
    has more. A document's runs are merged before its links count."""
    once = short.where("ok").select(F.explode("links").alias("link")).groupBy("link").agg(
        F.count("*").alias("n"))
    again = long.select("rid", F.explode("links").alias("link")).distinct().groupBy("link").agg(
        F.count("*").alias("n"))
    counts = staged(once.unionByName(again).groupBy("link").agg(F.sum("n").alias("n")), "links")
    first = F.floor(F.col("link") / width)
    top = staged(counts.groupBy(first.alias("first")).agg(F.max("n").alias("top")), "top")
    return staged(counts.withColumn("first", first).join(F.broadcast(top), "first").select(
        "link", "n", (F.col("n") == F.col("top")).alias("best")), "counts")


def looked_up(runs: DataFrame, counts: DataFrame, limit: int) -> DataFrame:
    """``runs`` without their links, with n_best and count_sum."""
    kept = [c for c in runs.columns if c not in ("links", "times")]
    if counts.count() > limit:
        runs = runs.withColumn("_run", F.monotonically_increasing_id())
        runs = staged(runs, "numbered")
        cells = runs.select("_run", F.inline(F.arrays_zip("links", "times"))).select(
            "_run", F.col("links").cast("string").alias("link"), "times")
        found = lookup(cells, staged(counts.withColumn("link", F.col("link").cast("string")),
                                     "texts"), "link", "_run")
        sums = found.groupBy("_run").agg(
            F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
            F.sum(F.col("times") * F.col("n")).alias("count_sum"))
        zero = F.lit(0).cast("long")
        return runs.join(sums, "_run", "left").select(
            *kept, *[F.coalesce(c, zero).alias(c) for c in ("n_best", "count_sum")])
    table = counts.orderBy("link").toArrow()  # at most ``limit`` rows
    known = runs.sparkSession.sparkContext.broadcast(
        tuple(table.column(c).to_numpy() for c in ("link", "n", "best")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        link, n, best = known.value
        for batch in batches:
            lists, times = batch.column("links"), batch.column("times").flatten().to_numpy()
            at = np.searchsorted(link, lists.flatten().to_numpy())
            row = np.repeat(np.arange(batch.num_rows), lists.value_lengths().to_numpy())
            # as doubles, exact below 2 ** 53
            sums = [np.bincount(row, x, batch.num_rows).astype(np.int64)
                    for x in (times * best[at], times * n[at])]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in kept] + list(map(pa.array, sums)),
                names=[*kept, "n_best", "count_sum"])

    schema = T.StructType([runs.schema[c] for c in kept] + [
        T.StructField(c, T.LongType()) for c in ("n_best", "count_sum")])
    return runs.mapInArrow(run, schema)


def align(docs: DataFrame, first: str, second: str, key: str = "doc_id", text: str = "text",
          digests: bool = False, size: int = RANGE, fan: int = FAN,
          limit: int = KNOWN_LINKS) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, and the groups as text `ids|ids;...`
    or, on request, their digest (groups_sha256).

    ``first`` is a byte-level vocabulary, ``second`` one of pieces with bytes to fall back on; both
    encode the text behind one space.
    """
    paths = (first, second)
    aligner = aligner_of(paths)
    rows = docs.select((2 * F.monotonically_increasing_id()).alias("rid"),
                       F.col(key).alias("doc_id"), F.col(text).alias("text"))
    is_long = F.coalesce(F.octet_length("text") > size, F.lit(False))
    short = staged(short_runs(rows.where(~is_long), paths, digests), "short")
    # numbered apart from the short ones
    extended = staged(rows.where(is_long).withColumn("rid", F.col("rid") + 1), "long")
    runs = staged(long_runs(extended, paths, size, fan), "runs")
    kept = staged(runs.groupBy("rid").agg(F.min("ok").alias("ok")).where("ok").select("rid"),
                  "kept")
    runs = runs.join(kept, "rid", "left_semi")
    counts = link_counts(short, runs, aligner.width)
    whole = looked_up(short.drop("rid", "ok"), counts, limit)
    sums = [*SUMS, "n_best", "count_sum"]
    ordered = F.array_join(F.transform(F.array_sort(F.collect_list(
        F.struct("at", "groups"))), lambda r: r["groups"]), ";")
    parts = looked_up(runs.drop("ok"), counts, limit).groupBy("rid").agg(
        *[F.sum(c).alias(c) for c in sums], ordered.alias("groups"))
    shown = F.sha2(F.col("groups").cast("binary"), 256) if digests else F.col("groups")
    long = extended.select("rid", "doc_id").join(
        parts.withColumn("groups", shown), "rid", "left").select(
        "doc_id", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in sums],
        F.coalesce("groups", F.lit("")).alias("groups"))
    out = whole.select("doc_id", *sums, "groups").unionByName(long)
    return out.withColumnRenamed("groups", "groups_sha256") if digests else out
