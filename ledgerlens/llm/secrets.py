"""Secrets by multipart credential linking, in DataFrame functions only.

Base kinds, found from left to right without overlap within a kind:

    assign  a keyword (password, passwd, secret, token, api_key) set to a value of 6 or more
    access  AKIA and capitals or digits, 20 or more characters
    hex     24 or more hexadecimal digits

Weak parts prove nothing alone: a 40-character random-looking string (`key`), a user or client
name being set (`user`), the address of a service (`endpoint`). They are reported where the
complementary parts stand within `scope` characters: a key or an endpoint needs an identifier
(access or user) and, for the endpoint, a secret (assign, hex or key) too; a user needs a secret
and an endpoint. The join of parts is an interval join over cells of `scope` characters: each cell
keeps, for each role, the last start of the cell before it, whether it has one, and the first
start of the cell behind it, so that no pairs are made however many parts a text has.

Defined cases: null and empty texts have no spans. Repeated rows each get their result. Positions
are code points, ends exclusive. Texts are used whole; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.tables import text_of, text_rows
from ledgerlens.sources.staging import staged

SCOPE = 400
IDENTIFIER, SECRET, ENDPOINT = "identifier", "secret", "endpoint"
#: kind, pattern, group whose length is checked, least length, role, whether it stands alone
BASE = (
    ("assign",
     r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
     1, 6, SECRET),
    ("access", r"AKIA[A-Z0-9]{16,}", 0, 20, IDENTIFIER),
    ("hex", r"[0-9a-f]{24,}", 0, 24, SECRET),
)
WEAK = (
    ("key", r"(?<![A-Za-z0-9+/=_-])(?=[A-Za-z0-9+/]*[0-9])(?=[A-Za-z0-9+/]*[A-Z])"
            r"(?=[A-Za-z0-9+/]*[a-z])[A-Za-z0-9+/]{40}(?![A-Za-z0-9+/=_-])", 0, 40, SECRET),
    ("user", r"""(?i:user(?:_?name)?|login|client_?id|account_?id)["']?\x20*[:=]\x20*["']?"""
             r"([A-Za-z0-9._@-]+)", 1, 3, IDENTIFIER),
    ("endpoint", r"""(?i:https?|ftp|s3|jdbc:[a-z]{2,20}|postgres(?:ql)?|mysql|mongodb|redis|amqp)"""
                 r"""://[^\s"'<>]+""", 0, 8, ENDPOINT),
)
ORDER = {kind: i for i, (kind, *_) in enumerate(BASE + WEAK)}
#: What a weak kind needs within its scope.
NEEDS = {"key": (IDENTIFIER,), "user": (SECRET, ENDPOINT), "endpoint": (IDENTIFIER, SECRET)}
_PART = "array<struct<start:int,rank:int,end:int,kind:string,role:string>>"


def _spans(text: Column, kind: str, pattern: str, group: int, least: int, role: str) -> Column:
    """Spans of a pattern: the text between matches, and the matches, give their places."""
    between = F.transform(F.split(text, pattern, -1), F.length)
    found = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.length)
    checked = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(group)), F.length)
    parts = F.zip_with(F.arrays_zip(between.alias("gap"), found.alias("size")), checked,
                       lambda a, b: F.struct(a["gap"].alias("gap"), a["size"].alias("size"),
                                             b.alias("checked")))
    start = F.struct(F.lit(0).alias("at"), F.array().cast(_PART).alias("spans"))

    def step(state: Column, part: Column) -> Column:
        low = state["at"] + part["gap"]
        high = low + part["size"]
        span = F.struct(low.alias("start"), F.lit(ORDER[kind]).alias("rank"), high.alias("end"),
                        F.lit(kind).alias("kind"), F.lit(role).alias("role"))
        # the last gap has no match behind it
        return F.struct(
            F.coalesce(high, state["at"]).alias("at"),
            F.when(part["checked"] >= least, F.concat(state["spans"], F.array(span)))
            .otherwise(state["spans"]).alias("spans"))

    spans = F.aggregate(parts, start, step)["spans"]
    return F.when(text.rlike(pattern), spans).otherwise(F.array().cast(_PART))


def _joined(spans: Column) -> Column:
    return F.concat_ws(",", F.transform(F.array_sort(spans), lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


def with_parts(rows: DataFrame, text: Column) -> DataFrame:
    """rows plus rid (names the row once the table is written), base and weak parts."""
    lists = rows.select("*", *[_spans(text, *p).alias(f"_{p[0]}") for p in BASE + WEAK])
    return lists.select(
        F.monotonically_increasing_id().alias("rid"), *rows.columns,
        F.concat(*[F.col(f"_{p[0]}") for p in BASE]).alias("base"),
        F.concat(*[F.col(f"_{p[0]}") for p in WEAK]).alias("weak"))


def found_parts(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, th, rid, base and weak parts."""
    return with_parts(text_rows(docs, key, text), F.col("text")).drop("text")


def linked(parts: DataFrame, scope: int = SCOPE) -> DataFrame:
    """(rid, linked): the weak parts of (rid, base, weak) that their complements stand near."""
    cell = F.floor(F.col("part.start") / scope).cast("long")
    some = parts.where(F.size("weak") > 0)
    every = some.select("rid", F.explode(F.concat("base", "weak")).alias("part"))
    # a part speaks in its own cell and in both neighbours: from = -1 for the cell before it ...
    spoken = every.select(
        "rid", F.col("part.role").alias("role"), F.col("part.start").alias("start"),
        F.explode(F.array(*[F.struct(F.lit(-d).alias("from"), (cell + d).alias("cell"))
                            for d in (-1, 0, 1)])).alias("at"))
    heard = spoken.groupBy("rid", "at.cell").agg(*[
        x for role in (IDENTIFIER, SECRET, ENDPOINT) for x in (
            F.max(F.when((F.col("role") == role) & (F.col("at.from") == -1), F.col("start")))
            .alias(f"{role}_before"),
            F.max((F.col("role") == role) & (F.col("at.from") == 0)).alias(f"{role}_here"),
            F.min(F.when((F.col("role") == role) & (F.col("at.from") == 1), F.col("start")))
            .alias(f"{role}_behind"))])
    weak = some.select("rid", F.explode("weak").alias("part")).withColumn("cell", cell)

    def near(role: str) -> Column:
        start = F.col("part.start")
        return (F.col(f"{role}_here")
                | F.coalesce(F.col(f"{role}_before") >= start - scope, F.lit(False))
                | F.coalesce(F.col(f"{role}_behind") <= start + scope, F.lit(False)))

    wanted = F.lit(False)
    for kind, roles in NEEDS.items():
        met = F.col("part.kind") == kind
        for role in roles:
            met = met & near(role)
        wanted = wanted | met
    return (weak.join(heard, ["rid", "cell"]).where(wanted)
            .groupBy("rid").agg(F.collect_list("part").alias("linked")))


def credential_parts(docs: DataFrame, key: str = "doc_id", text: str = "text",
                     scope: int = SCOPE) -> DataFrame:
    """doc_id, th, base spans and linked weak ones, as arrays of (start, rank, end, kind, role)."""
    parts = staged(found_parts(docs, key, text), "parts")
    more = staged(linked(parts, scope), "linked")
    return parts.join(more, "rid", "left").select(
        "doc_id", "th", "base",
        F.coalesce("linked", F.array().cast(_PART)).alias("linked"))


def redacted_rows(rows: DataFrame, text: str, scope: int = SCOPE) -> DataFrame:
    """rows with the secrets of the column `text` replaced, and `spans`, what was found in each.

    Only texts with weak parts are shuffled, to meet what was linked; the others stay where they
    are. Column names of rows must not be rid, base, weak, linked or spans.
    """
    parts = staged(with_parts(rows, text_of(text)), "parts")
    more = staged(linked(parts, scope), "linked")
    none = F.array().cast(_PART)
    met = parts.where(F.size("weak") > 0).join(more, "rid", "left").withColumn(
        "spans", F.concat("base", F.coalesce("linked", none)))
    alone = parts.where(F.size("weak") == 0).withColumn("spans", F.col("base"))
    names = [*rows.columns, "spans"]
    return met.select(*names).unionByName(alone.select(*names)).withColumn(
        text, F.when(F.size("spans") > 0, redacted(F.col(text), F.col("spans")))
        .otherwise(F.col(text)))


def secrets(docs: DataFrame, key: str = "doc_id", text: str = "text",
            scope: int = SCOPE) -> DataFrame:
    """One row per document: doc_id, n_assign, n_access, n_hex, base_sha256 (of the base spans by
    start), spans (all, kind:start:end by start) and n_linked (weak parts reported)."""
    count = lambda kind: F.size(
        F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return credential_parts(docs, key, text, scope).select(
        "doc_id", *[count(kind).alias(f"n_{kind}") for kind, *_ in BASE],
        F.sha2(_joined(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        _joined(F.concat("base", "linked")).alias("spans"),
        F.size("linked").cast("long").alias("n_linked"))


def redacted(text: Column, spans: Column, mark: str = "[secret]") -> Column:
    """The text with every span, overlapping ones as one, replaced by the mark."""
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(state: Column, span: Column) -> Column:
        fresh = F.concat(state["out"], F.substring(text, state["at"] + 1,
                                                   span["start"] - state["at"]), F.lit(mark))
        return F.struct(
            F.greatest(state["at"], span["end"]).alias("at"),
            F.when(span["start"] >= state["at"], fresh).otherwise(state["out"]).alias("out"))

    done = F.aggregate(F.array_sort(spans), start, step)
    return F.concat(done["out"], F.substring(text, done["at"] + 1, F.length(text)))
