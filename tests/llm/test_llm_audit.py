"""Filter interaction audit against plain counting over every order."""

import random
from collections import Counter
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlens.llm import audit


def marks():
    return {"good": F.col("quality") == 1, "toxic": F.col("toxic") == 1}


NAMES = "ABCDE"


def plain(docs, labels):
    """{(doc_id, text, lang)}, {(doc_id, quality, toxic)} -> the audit's rows."""
    marked = {name: {i for i, *v in labels if i is not None and v[at] == 1}
             for at, name in enumerate(("good", "toxic"))}
    firsts = {}
    for i, text, _ in docs:
        if i is not None:
            firsts[text or ""] = min(i, firsts.get(text or "", i))
    seen = []
    for i, text, lang in docs:
        text = text or ""
        words = [w for w in text.translate({c: " " for c in range(9, 14)}).split(" ") if w]
        fails = {
            "A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * sum("A" <= c <= "Z" for c in text) > 3 * len(text),
            "D": any(c in text for c in "#$%&*|"),
            "E": i is not None and i > firsts[text]}
        seen.append((lang or "", i, {f for f in NAMES if fails[f]}))
    out = []
    for part in {p for p, _, _ in seen}:
        rows, shares = [], Counter()
        for order in permutations(NAMES):
            for step, name in enumerate(order, 1):
                before = set(order[:step - 1])
                mine = [(i, f) for p, i, f in seen if p == part]
                gone = [i for i, f in mine if name in f and not f & before]
                shares[name] += len(gone)
                rows.append(("".join(order), step, name, (
                    sum(not f & (before | {name}) for _, f in mine), len(gone),
                    sum(name in f and bool(f & before) for _, f in mine),
                    sum(f == {name} for _, f in mine),
                    sum(i in marked["good"] for i in gone),
                    sum(i in marked["toxic"] for i in gone))))
        out += [(part, o, s, *v, shares[n]) for o, s, n, v in rows]
    return sorted(out)


COLUMNS = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails",
           "good_lost", "toxic_lost", "shapley"]


def found(spark, docs, labels):
    frame = spark.createDataFrame(
        [(*d, 7, "x", 0) for d in docs],
        "doc_id long, text string, lang string, fails int, part string, row long")
    known = spark.createDataFrame([(*x, 1) for x in labels],
                                  "doc_id long, quality int, toxic int, marks int")
    return sorted(tuple(r) for r in audit.audit(frame, known, marks()).select(*COLUMNS).collect())


def test_audit_equals_plain_counting(spark):
    dice = random.Random(11)
    texts = ["", None, "few WORDS", "few words # here", " ".join(f"w{i}" for i in range(230)),
             " ".join("ab" for _ in range(300)), "LOUD " * 250, "\t aé\n|\r b ",
             " ".join(f"W{i}%" for i in range(210))]
    docs = [(dice.choice([None, *range(40)]), dice.choice(texts), dice.choice(["en", "de", None, ""]))
            for _ in range(300)]
    docs += docs[:20]  # repeated rows
    labels = [(dice.choice([None, *range(40)]), dice.choice([0, 1, None]), dice.choice([0, 1, None]))
              for _ in range(60)]
    assert found(spark, docs, labels) == plain(docs, labels)


def test_hot_parts_copies_and_ids_are_split(spark, monkeypatch):
    """One part, one text and no id for most rows; ranges of seven documents."""
    monkeypatch.setattr(audit.posting_lists, "__defaults__", (7,))
    docs = [(i if i % 3 else None, "same text &" if i % 2 else f"text {i}", "en")
            for i in range(200)]
    assert found(spark, docs, []) == plain(docs, [])


def test_lists_hold_the_failing_ids(spark):
    docs = spark.createDataFrame(
        [(i, " ".join(["w"] * i), "en") for i in range(50, 300, 10)],
        "doc_id long, text string, lang string")
    rows = audit.with_marks(audit.flagged(docs, audit.text_filters(F.col("text"))).drop("digest"),
                            spark.createDataFrame([], "doc_id long"), {})
    lists = audit.posting_lists(rows, 4, 0, most=5)
    ids = audit.failing_ids(lists, list("ABCD"), "B", after=["A"])
    assert sorted(r["id"] for r in ids.collect()) == list(range(200, 300, 10))
    assert all(len(r["ids"]) <= 5 for r in lists.collect())


def test_empty_tables(spark):
    assert found(spark, [], []) == []
    one = found(spark, [(None, None, None)], [])
    assert len(one) == 600 and {r[0] for r in one} == {""}


def test_very_long_text(spark):
    text = " ".join(f"w{i}" for i in range(300_000))
    docs = [(1, text, "en"), (2, text, "en")]
    assert found(spark, docs, [(2, 1, 0)]) == plain(docs, [(2, 1, 0)])


@pytest.mark.parametrize("seed", range(5))
def test_merges(seed):
    dice = np.random.default_rng(seed)
    lists = [np.unique(dice.integers(0, 60, dice.integers(0, 50))).astype(np.int32)
             for _ in range(4)]
    sets = [set(x.tolist()) for x in lists]
    for at, joined in enumerate(audit.unions(lists)):
        wanted = set().union(*[s for i, s in enumerate(sets) if at >> i & 1])
        assert joined.tolist() == sorted(wanted)
    assert audit.difference(lists[0], lists[1]).tolist() == sorted(sets[0] - sets[1])
