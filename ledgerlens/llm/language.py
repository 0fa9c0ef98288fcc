"""Language identification by rank-order profiles.

A profile lists the most frequent character n-grams (one to three letters, with blanks at word
ends) in order of frequency. A text gets the language whose profile is nearest to its own by the
out-of-place distance: the sum over the text's n-grams of how far their ranks differ, a missing
n-gram counting `profile`.

Defined cases: null text, or one without a letter: `und`, score 0. No learned language: every
text is `und`. Ties between n-grams go to the smaller code points, ties between languages to the
first in order. Rows with a null language or a null text are not learned from. Repeated rows each
get their result. Every other column is ignored. Texts are used whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.sources.staging import staged

PROFILE = 300
#: Profiles travel with the tasks, so their number must have a bound. More languages are an error.
MAX_LANGUAGES = 500
SLICE_CHARS = 1 << 18
SLICE_ROWS = 2048
NONE, BLANK = 0, 1  # codes of a gram's places; letters have their code point plus two
UNDETERMINED = "und"

_LETTERS: list[np.ndarray] = []


def _letters() -> np.ndarray:
    if not _LETTERS:
        _LETTERS.append(np.array([chr(c).isalpha() for c in range(0x110000)]))
    return _LETTERS[0]


def _slices(texts: list[str | None]) -> Iterator[tuple[int, list[str]]]:
    at, chars, out = 0, 0, []
    for i, text in enumerate(texts):
        if out and (chars + len(text or "") > SLICE_CHARS or len(out) >= SLICE_ROWS):
            yield at, out
            at, chars, out = i, 0, []
        out.append((text or "").lower())
        chars += len(text or "")
    if out:
        yield at, out


def _codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Letters as code point + 2 and one blank between words, before and after; and their texts."""
    lengths = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    points = np.frombuffer("".join(t + " " for t in texts).encode("utf-32-le", "surrogatepass"),
                           np.uint32).astype(np.int64)
    letter = _letters()[points]
    doc = np.repeat(np.arange(len(texts)), lengths)
    before = np.empty(len(points), bool)
    before[0], before[1:] = True, letter[:-1]
    keep = letter | before
    codes = np.where(letter, points + 2, BLANK)[keep]
    return codes, doc[keep]


def grams(texts: list[str], group: np.ndarray | None = None):
    """(text, n-gram, count), ordered by text and n-gram; an n-gram is three codes of 21 bits.
    With `group` (a number for each text) the counts are those of the groups."""
    codes, doc = _codes(texts)
    used = np.zeros(0x110002, bool)
    used[codes] = True
    alphabet = np.flatnonzero(used)
    place = np.zeros(0x110002, np.int64)
    place[alphabet] = np.arange(1, len(alphabet) + 1)  # 0: no letter here
    dense, blank = place[codes], place[BLANK]
    bits = len(alphabet).bit_length()
    # every letter with what stands before and after it; a text begins and ends with a blank
    at = np.flatnonzero(codes != BLANK)
    if not len(at):
        empty = np.empty(0, np.int64)
        return empty, empty, empty
    before = np.where((at > 0) & (doc[at] == doc[at - 1]), dense[at - 1], blank)
    owner = doc[at] if group is None else group[doc[at]]
    key = (((owner << bits | before) << bits | dense[at]) << bits) | dense[at + 1]
    key, count = _summed(np.sort(key), None)
    # shorter n-grams follow from the counts of the three-letter ones
    mask = (1 << bits) - 1
    text, middle, last = key >> (3 * bits), (key >> bits) & mask, key & mask
    ends = last == blank
    short = np.concatenate([
        key & ~mask,
        (((text << bits | middle) << bits | last) << bits)[ends],
        (text << bits | middle) << (2 * bits)])
    times = np.concatenate([count, count[ends], count])
    order = np.argsort(short)
    short, times = _summed(short[order], times[order])
    key, count = np.concatenate([key, short]), np.concatenate([count, times])
    order = np.argsort(key)
    key, count = key[order], count[order]
    real = np.concatenate([[NONE], alphabet])
    packed = ((real[(key >> (2 * bits)) & mask] << 42) | (real[(key >> bits) & mask] << 21)
              | real[key & mask])
    return key >> (3 * bits), packed, count


def _summed(key: np.ndarray, count: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    if count is None:
        return key[first], np.diff(np.append(first, len(key)))
    return key[first], np.add.reduceat(count, first)


def ranked(text: np.ndarray, gram: np.ndarray, count: np.ndarray, n: int, profile: int):
    """The `profile` most frequent n-grams of each text with their ranks from 0."""
    most = int(count.max()) if len(count) else 0
    order = np.argsort(text * np.int64(most + 1) + (most - count), kind="stable")
    text, gram = text[order], gram[order]
    first = np.searchsorted(text, np.arange(n))
    rank = np.arange(len(text)) - first[text] if len(text) else text
    keep = rank < profile
    return text[keep], gram[keep], rank[keep]


def _merge(parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]):
    lang = np.concatenate([p[0] for p in parts])
    gram = np.concatenate([p[1] for p in parts])
    count = np.concatenate([p[2] for p in parts])
    order = np.lexsort((gram, lang))
    lang, gram, count = lang[order], gram[order], count[order]
    first = np.flatnonzero(np.concatenate(
        [[True], (lang[1:] != lang[:-1]) | (gram[1:] != gram[:-1])])) if len(lang) else order
    return lang[first], gram[first], np.add.reduceat(count, first) if len(first) else count


def gram_counts(docs: DataFrame, lang: str = "lang", text: str = "text") -> DataFrame:
    """(lang, gram, n) over all rows that have both; summed within each task first."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names: dict[str, int] = {}
        parts, size = [], 0

        def flush():
            code, gram, n = _merge(parts)
            known = pa.array(list(names))
            return pa.RecordBatch.from_arrays(
                [known.take(pa.array(code)), pa.array(gram, pa.int64()), pa.array(n, pa.int64())],
                names=["lang", "gram", "n"])

        for batch in batches:
            langs = batch.column(0).to_pylist()
            for at, part in _slices(batch.column(1).to_pylist()):
                own = np.array([names.setdefault(x, len(names))
                                for x in langs[at:at + len(part)]], np.int64)
                parts.append(grams(part, own))
                gram = parts[-1][1]
                size += len(gram)
                if size > 1_000_000:
                    merged = _merge(parts)
                    parts, size = [merged], len(merged[0])
                    if size > 500_000:
                        yield flush()
                        parts, size = [], 0
        if parts:
            yield flush()

    rows = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(lang, text)
    return (rows.mapInArrow(count, "lang string, gram long, n long")
            .groupBy("lang", "gram").agg(F.sum("n").alias("n")))


def learn(docs: DataFrame, lang: str = "lang", text: str = "text",
          profile: int = PROFILE) -> dict[str, np.ndarray]:
    """Language -> its n-grams in order of rank. At most `profile` rows for each of at most
    MAX_LANGUAGES languages come to the driver."""
    counts = staged(gram_counts(docs, lang, text), "grams")
    names = [r[0] for r in counts.select("lang").distinct().limit(MAX_LANGUAGES + 1).collect()]
    if len(names) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    out = {}
    for name in sorted(names):
        top = (counts.where(F.col("lang") == name).orderBy(F.desc("n"), "gram").limit(profile)
               .select("gram").collect())
        out[name] = np.array([r[0] for r in top], np.int64)
    return out


def distances(texts: list[str], profiles: dict[str, np.ndarray], profile: int):
    """Out-of-place distance of each text to each language, and each text's number of n-grams."""
    text, gram, rank = ranked(*grams(texts), len(texts), profile)
    size = np.bincount(text, minlength=len(texts))
    out = np.empty((len(texts), len(profiles)))
    for k, known in enumerate(profiles.values()):
        order = np.argsort(known)
        place = np.searchsorted(known[order], gram)
        place[place == len(known)] = 0
        hit = known[order][place] == gram if len(known) else np.zeros(len(gram), bool)
        apart = np.where(hit, np.abs(order[place] - rank), profile) if len(known) else np.full(
            len(gram), profile)
        out[:, k] = np.bincount(text, weights=np.minimum(apart, profile), minlength=len(texts))
    return out, size


def identify(docs: DataFrame, profiles: dict[str, np.ndarray], text: str = "text",
             profile: int = PROFILE) -> DataFrame:
    """All columns of docs plus lang_pred, score (how far the best language lies ahead of the
    second, 0 to 1) and fit (1: the profile itself, 0: nothing in common)."""
    names = list(profiles)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text)).to_pylist()
            lang, score, fit = [], [], []
            for _, part in _slices(texts):
                far, size = distances(part, profiles, profile)
                for row, n in zip(far, size, strict=True):
                    if not n or not names:
                        lang.append(UNDETERMINED)
                        score.append(0.0)
                        fit.append(0.0)
                        continue
                    best = int(row.argmin())
                    rest = np.delete(row, best)
                    second = rest.min() if len(rest) else float(n * profile)
                    lang.append(names[best])
                    score.append(float(1 - row[best] / second) if second > 0 else 0.0)
                    fit.append(float(1 - row[best] / (n * profile)))
            columns = [batch.column(i) for i in range(batch.num_columns)]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(lang, pa.string()), pa.array(score, pa.float64()),
                 pa.array(fit, pa.float64())],
                names=[*batch.schema.names, "lang_pred", "score", "fit"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return docs.mapInArrow(predict, f"{fields}, lang_pred string, score double, fit double")


def held_out(remainder: Column, fold: int) -> Column:
    return remainder == fold
