"""Column-name normalisation (metadata only, no rows are touched)."""

from __future__ import annotations

import unicodedata
from collections import Counter

from pyspark.sql import DataFrame

# Pieces that are cut out of a header, after lower-casing and accent folding.
CUT_PIECES = ["(eof)", "(", ")", "_codigo/nome", "_cod/nome", "_dia/mes/ano"]


def fold_accents(text: str) -> str:
    return unicodedata.normalize("NFKD", text).encode("ascii", "ignore").decode("ascii")


def normalise_name(header: str) -> str:
    name = fold_accents(header.lower().replace(" ", "_").replace(".", ""))
    for piece in CUT_PIECES:
        name = name.replace(piece, "")
    return name


def normalise_columns(df: DataFrame) -> DataFrame:
    names = [normalise_name(column) for column in df.columns]
    clashes = sorted(name for name, times in Counter(names).items() if times > 1)
    if clashes:
        raise ValueError(f"headers collide after normalisation: {clashes}")
    return df.toDF(*names)
