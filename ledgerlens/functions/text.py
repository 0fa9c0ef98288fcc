"""Text cleaning as Column expressions.

Everything is built from Spark's own string and array functions, so a clean text never leaves
the JVM and cleaning adds no shuffle to a plan.
"""

from __future__ import annotations

import string
import unicodedata

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from ledgerlens.functions.stemming import let, stem

# Domain words dropped besides the Portuguese stopwords.
EXTRA_STOPWORDS = ["pdf", "total", "mes", "goias", "go"]

# Characters whose ASCII spelling is not a plain base letter.
SPELLED_OUT = {
    "ß": "ss", "æ": "ae", "œ": "oe", "þ": "th", "ﬁ": "fi", "ﬂ": "fl", "ĳ": "ij",
    "§": "ss", "°": "deg", "№": "no", "©": "(c)", "®": "(r)", "™": "tm",
    "…": "...", "«": "<<", "»": ">>",
}
SINGLE_SPELLED = {
    "ø": "o", "ł": "l", "đ": "d", "ð": "d", "ħ": "h", "ŧ": "t", "ı": "i", "×": "x", "÷": "/",
    "ª": "a", "º": "o", "¿": "?", "¡": "!", "·": "*", "•": "*", "\u00a0": " ",
    "‐": "-", "‑": "-", "‒": "-", "–": "-", "—": "-", "―": "-",
    "‘": "'", "’": "'", "‚": "'", "´": "'", "“": '"', "”": '"', "„": '"',
}


def _accent_pairs() -> dict[str, str]:
    """Lower-case Latin letters whose canonical decomposition starts with an ASCII letter."""
    pairs = {}
    for point in (*range(0x00E0, 0x0250), *range(0x1E00, 0x1F00)):
        letter = chr(point)
        base = unicodedata.normalize("NFD", letter)[0]
        if letter.islower() and base != letter and base.isascii():
            pairs[letter] = base
    return pairs


FOLDED = {**_accent_pairs(), **SINGLE_SPELLED}
PUNCTUATION = {mark: " " for mark in string.punctuation}

# Fixed value: the one currency mark of two letters. The others are single marks that no rule
# below keeps.
ZLOTY = "zł"

DROPPED = "$" + string.digits

# Whatever is still outside ASCII, and control characters.
NOT_ASCII = r"[^\t-\r -~]+"


def punctuation_to_space(text: Column) -> Column:
    return F.translate(text, string.punctuation, " " * len(string.punctuation))


def _normalise(text: Column, table: dict[str, str]) -> Column:
    dropped = "".join(mark for mark in DROPPED if mark not in table)
    plain = F.replace(F.lower(text), F.lit(ZLOTY), F.lit(""))
    plain = F.translate(plain, "".join(table) + dropped, "".join(table.values()))
    for mark, spelling in SPELLED_OUT.items():
        plain = F.replace(plain, F.lit(mark), F.lit(spelling))
    plain = F.regexp_replace(plain, NOT_ASCII, "")
    plain = F.regexp_replace(plain, r"\s+", " ")
    return F.trim(plain)


def normalise_text(text: Column) -> Column:
    """Lower-case ASCII words and marks: no digits, currency or emoji, single spaces."""
    return _normalise(text, FOLDED)


def clean_text(text: Column) -> Column:
    """Punctuation to spaces, then normalised. A null text counts as empty.

    Both steps look at single characters, so one pass over the text does them together.
    """
    return _normalise(F.coalesce(text, F.lit("")), {**PUNCTUATION, **FOLDED})


def stopwords(spark: SparkSession, fold: bool = False) -> list[str]:
    """Portuguese stopwords plus the domain words.

    Cleaned text is ASCII, so accented entries can only match with ``fold``.
    """
    from pyspark.ml.feature import StopWordsRemover

    from ledgerlens.functions.names import fold_accents

    assert spark is not None  # the list is read from the running JVM
    words = [*StopWordsRemover.loadDefaultStopWords("portuguese"), *EXTRA_STOPWORDS]
    return sorted({fold_accents(word) for word in words}) if fold else words


def words(cleaned: Column) -> Column:
    return F.filter(F.split(cleaned, " "), lambda word: word != "")


def drop_stopwords(cleaned: Column, stoplist: list[str]) -> Column:
    """Words of a cleaned text that are longer than one character and not listed."""
    return F.filter(
        F.split(cleaned, " "), lambda word: (F.length(word) > 1) & ~word.isin(stoplist)
    )


def stemmed_words(text: Column, stoplist: list[str]) -> Column:
    return F.transform(drop_stopwords(clean_text(text), stoplist), stem)


def index_terms(tokens: Column) -> Column:
    """Runs of two or more letters: the terms a bag of words counts. Tokens of letters alone, the
    common case, are runs already."""
    def runs(tokens: Column) -> Column:
        joined = F.array_join(tokens, " ")
        return F.when(
            joined.rlike("[^a-z ]"), F.regexp_extract_all(joined, F.lit("([a-z]{2,})"), F.lit(1))
        ).otherwise(F.filter(tokens, lambda token: F.length(token) > 1))

    return let(F.col(tokens) if isinstance(tokens, str) else tokens, runs)


def bag_terms(text: Column, stoplist: list[str]) -> Column:
    """Terms of a text after cleaning, stopword removal and stemming."""
    return index_terms(stemmed_words(text, stoplist))
