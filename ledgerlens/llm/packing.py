"""Concatenate and cut: documents become one run of tokens, cut into sequences of equal length.

First pass: every partition tokenizes its documents and writes them with their start in the
partition. Second pass: prefix sums over the partitions' totals (one number each) give the global
start of every document, and so the sequences and offsets of its pieces; the records at a
partition's or sequence's boundary are cut there. Only the last sequence can have padding.

Defined cases: a null or empty text is its end token alone. Repeated rows, and rows with equal or
null ids, are documents of their own. Other columns are ignored. Texts are used whole. An empty
table gives no pieces.
"""

from __future__ import annotations

import os
import re
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.sources.staging import staged

LENGTH = 2048
END = 1
#: Words whose ids a task keeps; beyond it starts anew. Only a matter of speed.
REMEMBERED = 500_000

#: Below this code point texts are their own NFC form and every letter keeps its length, class and
#: place when lower-cased (but for the dotted capital I), so such texts are cut into words here.
PLAIN = 0x180
#: (The four separators x1c to x1f are white space for Python only.)
_NOT_PLAIN = re.compile(f"[^\\x00-{chr(PLAIN - 1)}]|[\\x1c-\\x1f\u0130]|<\\|")
_NOT_PLAIN_ASCII = ("<|", "\x1c", "\x1d", "\x1e", "\x1f")
_SPACE = str.maketrans("\t\n\v\f\r", "     ")


def _plain_words() -> re.Pattern:
    """The pre-tokenizer's words for texts below PLAIN: contractions, letters, single digits,
    runs of other marks."""
    kinds = [unicodedata.category(chr(c))[0] for c in range(PLAIN)]
    letters = "".join(re.escape(chr(c)) for c, k in enumerate(kinds) if k == "L")
    digits = "".join(chr(c) for c, k in enumerate(kinds) if k == "N")
    return re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{letters}]+|[{digits}]|[^\\s{letters}{digits}]+")


class _Memory(dict):
    """Ids of what was encoded before."""

    def __init__(self, make):
        super().__init__()
        self.make = make

    def __missing__(self, word: str) -> bytes:
        if len(self) >= REMEMBERED:
            self.clear()
        ids = self[word] = self.make(word)
        return ids


class WordEncoder:
    """Ids of texts by a `tokenizers` file with the pre-tokenizer of `word_bpe`.

    Words are encoded alone there, so the ids of a text are those of its words, and a word that
    came before needs no second encoding. Texts beyond the plain letters are cut at ASCII spaces
    only, which the pre-tokenizer drops, and each part goes through the whole tokenizer.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.kind = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.words, self.runs, self.parts = (
            _Memory(make) for make in (self._word, self._run, self._part))
        self.cut = _plain_words()
        self.bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)

    def _word(self, word: str) -> bytes:
        if not word.isascii():
            word = self.bytes.pre_tokenize_str(word)[0][0]
        return np.array([t.id for t in self.model.tokenize(word)], self.kind).tobytes()

    def _run(self, run: str) -> bytes:
        return b"".join(map(self.words.__getitem__, self.cut.findall(run)))

    def _part(self, part: str) -> bytes:
        ids = self.tokenizer.encode(part, add_special_tokens=False).ids
        return np.array(ids, self.kind).tobytes()

    def encode(self, text: str) -> bytes:
        """Little-endian ids of a text."""
        odd = (any(x in text for x in _NOT_PLAIN_ASCII) if text.isascii()
               else _NOT_PLAIN.search(text))
        if odd:
            return b"".join(map(self.parts.__getitem__, text.translate(_SPACE).split(" ")))
        return b"".join(map(self.runs.__getitem__, text.lower().split()))


_ENCODERS: dict[str, WordEncoder] = {}  # of this worker


def encoder_of(path: str) -> WordEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def tokenized(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text",
              end: int = END, limit: int = 1 << 19) -> DataFrame:
    """(part, start, doc_id, ids): ids with the end token as bytes, and their place in the part."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(path)
        tail = np.array([end], encoder.kind).tobytes()
        size, at = encoder.kind.itemsize, 0
        for batch in batches:
            whole = batch.column(2).to_pylist()
            low = 0
            while low < len(whole):
                high, chars = low, 0
                while high < len(whole) and (chars < limit):
                    chars += len(whole[high] or "")
                    high += 1
                ids = [encoder.encode(t or "") + tail for t in whole[low:high]]
                lengths = np.array([len(x) // size for x in ids], np.int64)
                starts = at + np.cumsum(lengths) - lengths
                at += int(lengths.sum())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(low, high - low), pa.array(starts),
                     batch.column(1).slice(low, high - low), pa.array(ids, pa.binary()),
                     pa.array(lengths)], names=["part", "start", "doc_id", "ids", "n"])
                low = high

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(F.spark_partition_id().alias("part"), key, text).mapInArrow(
        run, f"part int, start long, doc_id {kind}, ids binary, n long")


def pack(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text",
         length: int = LENGTH, end: int = END, ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset,
    sequence_tokens (ids in the sequence, padding not counted) and, on request, the ids."""
    tokens = staged(tokenized(docs, path, key, text, end), "tokens")
    # one row for each partition of the first pass, never one for each document
    totals = sorted((r[0], r[1]) for r in tokens.groupBy("part").agg(F.sum("n")).collect())
    offsets, total = {}, 0
    for part, n in totals:
        offsets[part] = total
        total += n

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = batch.column(0).to_numpy()
            lengths = batch.column(4).to_numpy()
            begin = batch.column(1).to_numpy() + np.array([offsets[p] for p in size], np.int64)
            pieces = (begin + lengths - 1) // length - begin // length + 1
            row = np.repeat(np.arange(len(begin)), pieces)
            nth = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            sequence = begin[row] // length + nth
            low = np.maximum(begin[row], sequence * length)
            high = np.minimum(begin[row] + lengths[row], (sequence + 1) * length)
            stored, sums, own = batch.column(3), [], []
            last = -1
            for r, a, b in zip(row.tolist(), (low - begin[row]).tolist(),
                               (high - begin[row]).tolist(), strict=True):
                if r != last:
                    raw, last = stored[r].as_py(), r
                    values = np.frombuffer(raw, f"<u{len(raw) // int(lengths[r])}").astype("<u4")
                piece = values[a:b].tobytes()
                sums.append(zlib.crc32(piece))
                own.append(piece if ids else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(2).take(pa.array(row)), pa.array(low - begin[row]),
                 pa.array(high - low), pa.array(sums, pa.int64()), pa.array(lengths[row]),
                 pa.array(sequence), pa.array(low - sequence * length),
                 pa.array(np.minimum(length, total - sequence * length)),
                 pa.array(own, pa.binary())],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id",
                       "offset", "sequence_tokens", "ids"])

    kind = docs.schema[key].dataType.simpleString()
    out = tokens.mapInArrow(
        cut, f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, "
             "sequence_id long, offset long, sequence_tokens long, ids binary")
    return out if ids else out.drop("ids")
