"""Operators that compare rows with one another, and the pipeline."""

import os
import random
import sys
from collections import Counter
from functools import cache

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, os.path.join(os.path.dirname(os.path.abspath(__file__)), "..", "..", "tools"))

import brute  # noqa: E402
import corpus_pipeline  # noqa: E402
from compare import TABLES, canonical  # noqa: E402
from ledgerlens.llm import (  # noqa: E402
    components,
    decontaminate,
    licenses,
    near,
    queries,
    stages,
    substrings,
    topk,
)
from ledgerlens.llm.oracles import ORACLES  # noqa: E402

LONG = " ".join(f"w{i}" for i in range(40))
#: Null and empty texts, repeated rows, null ids, and columns with names that operators use.
EDGE = [
    (1, LONG, "x", 1, "a"), (1, LONG, "x", 1, "a"), (1, LONG + " more", "x", 1, "b"),
    (2, None, "x", 2, None), (3, "", None, 3, "c"), (None, "lead " + LONG, "y", None, "d"),
    (None, None, None, None, None), (4, " \t\n", "z", 4, "e"), (5, "one", "z", 5, "f"),
    (6, "tail " + LONG[40:], "z", 6, "g")]
SCHEMA = "doc_id long, text string, key string, th long, label string"


@pytest.fixture(scope="module")
def edge(spark):
    return spark.createDataFrame(EDGE, SCHEMA)


@pytest.fixture(scope="module")
def nothing(edge):
    return edge.where("false")


@pytest.fixture(scope="module")
def corpus(spark, sf_dir):
    return [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet")
            .select("doc_id", "text").collect()]


@pytest.fixture(scope="module")
def database(sf_dir):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, sf_dir, database, name):
    found = canonical(queries.QUERIES[name](spark, sf_dir).toPandas())
    wanted = canonical(database.execute(ORACLES[name]).df())
    assert list(found.columns) == list(wanted.columns) and found.equals(wanted)


def test_every_operator_is_registered_once():
    numbers = [int(n[2:].split("_")[0]) for n in queries.QUERIES if n.startswith("op")]
    assert sorted(numbers) == list(range(1, 1 + len(numbers))) and len(numbers) >= 11


# -- substrings -------------------------------------------------------------------------------

def substring_rows(out):
    return sorted((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"])
                  for r in out.collect())


def copies(seed, documents=60):
    """Random texts of few words that copy from one another, with edits."""
    random.seed(seed)
    texts = []
    for _ in range(documents):
        words = [f"v{random.randint(0, 30)}" for _ in range(random.randint(0, 90))]
        for _ in range(random.randint(0, 3)):
            if texts and (source := random.choice(texts)):
                at = random.randint(0, len(source))
                words[random.randint(0, len(words)):0] = source[at:at + random.randint(5, 70)]
        texts.append(words)
    return [(i, " ".join(w)) for i, w in enumerate(texts)]


@pytest.mark.parametrize("seed", [1, 2])
def test_substrings_equal_brute_force(spark, seed, monkeypatch):
    rows = copies(seed)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert substring_rows(substrings.deduplicate(docs)) == sorted(brute.substrings(rows))
    small = substrings.deduplicate(docs, window=7, gram=3)
    assert substring_rows(small) == sorted(brute.substrings(rows, 7))


def test_substring_spans_and_text(spark):
    rows = [(1, LONG), (2, "new start " + LONG + " new end"), (3, LONG + " x " + LONG)]
    out = {r["doc_id"]: r for r in substrings.deduplicate(
        spark.createDataFrame(rows, "doc_id long, text string"), keep_text=True).collect()}
    assert out[1]["spans"] == [] and out[1]["kept"] == LONG
    assert [tuple(s) for s in out[2]["spans"]] == [(2, 42)]
    assert out[2]["kept"] == "new start new end" and out[3]["kept"] == "x"


def test_substring_edge_cases(edge, nothing):
    out = substring_rows(substrings.deduplicate(edge.withColumn(
        "doc_id", F.coalesce("doc_id", F.lit(-1)))))
    assert substrings.deduplicate(nothing).collect() == []
    plain = substrings.deduplicate(edge).collect()
    assert len(out) == len(plain) == len(EDGE)
    # the null id comes first, so every other copy of the passage goes, in both twins alike
    gone = Counter((r["doc_id"], r["n_words"], r["n_removed"]) for r in plain)
    assert gone[(1, 40, 40)] == 2 and gone[(1, 41, 40)] == 1 and gone[(None, 41, 0)] == 1


# -- decontamination --------------------------------------------------------------------------

def contamination_rows(out):
    return sorted((r["doc_id"], r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"],
                   r["contaminated"]) for r in out.collect())


@pytest.mark.parametrize("seed", [3, 4])
def test_contamination_equals_brute_force(spark, seed):
    rows = copies(seed)
    random.seed(seed)
    items = [(i, " ".join(random.choice(rows)[1].split()[k:k + random.randint(0, 25)]))
             for i, k in enumerate(random.choices(range(40), k=50))]
    items += [(7, "v1 v2"), (8, "V3"), (9, None), (9, ""), (10, "- ."), (None, rows[5][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    tests = spark.createDataFrame(items, "item_id long, text string")
    out = decontaminate.contamination(docs, tests)
    assert contamination_rows(out) == sorted(brute.contamination(rows, items))
    for r in out.collect():
        assert sum(s["end"] - s["start"] for s in r["spans"]) == r["n_hit"]


def test_contamination_edge_cases(spark, edge, nothing):
    items = spark.createDataFrame([(1, LONG)], "item_id long, text string")
    out = decontaminate.contamination(edge, items).collect()
    assert len(out) == len(EDGE) and sum(r["contaminated"] for r in out) == 5
    none = decontaminate.contamination(edge, items.where("false")).collect()
    assert len(none) == len(EDGE) and not any(r["contaminated"] for r in none)
    assert decontaminate.contamination(nothing, items).collect() == []


def test_hits_survive_a_full_bitmap(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "bitmap", lambda prints: np.ones(
        1 << decontaminate.BITMAP_BITS, bool))
    rows = copies(5, 30)
    items = [(i, t) for i, t in copies(6, 5)] + [(99, rows[3][1])]
    out = decontaminate.contamination(
        spark.createDataFrame(rows, "doc_id long, text string"),
        spark.createDataFrame(items, "item_id long, text string"))
    assert contamination_rows(out) == sorted(brute.contamination(rows, items))


# -- top-k ------------------------------------------------------------------------------------

def plain_top_k(rows, k, every):
    """rows (vec_id, vector or None), usable ones only."""
    good = [(i, np.floor(64 * np.array(v, float))) for i, v in rows
            if i is not None and v is not None and all(
                x is not None and np.isfinite(x) for x in v)]
    out = []
    for n, (q, x) in enumerate(good):
        if q % every:
            continue
        scores = sorted(
            (-int(sum(a * b for a, b in zip(x, y, strict=False))), c)
            for m, (c, y) in enumerate(good) if m != n)
        out += [(q, r + 1, c, -s) for r, (s, c) in enumerate(scores[:k])]
    return sorted(out)


@pytest.mark.parametrize("sparse", [0.0, 2.0])
def test_top_k_equals_brute_force(spark, monkeypatch, sparse):
    monkeypatch.setattr(topk, "SPARSE", sparse)
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(5, 40))
    rows = [(i, (centres[i % 5] + 0.2 * rng.normal(size=40)).tolist()) for i in range(300)]
    rows += [(300, None), (301, [1.0, None]), (302, [float("nan")] * 40), (303, []),
             (304, [float("inf")] * 40), (305, [1.0] * 3), (None, [1.0] * 40),
             (20, rows[20][1]), (306, rows[7][1]), (307, rows[7][1])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    out = topk.top_k(table, F.col("vec_id") % 10 == 0, k=9, candidates=64, queries=16)
    got = sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in out.collect())
    assert got == plain_top_k(rows, 9, 10)


def test_top_k_with_few_or_no_rows(spark):
    schema = "vec_id long, embedding array<float>"
    empty = spark.createDataFrame([], schema)
    assert topk.top_k(empty, F.col("vec_id") % 20 == 0).collect() == []
    one = spark.createDataFrame([(20, [1.0, 2.0])], schema)
    assert topk.top_k(one, F.col("vec_id") % 20 == 0).collect() == []
    three = spark.createDataFrame([(20, [1.0]), (1, [1.0]), (2, [3.0])], schema)
    got = [tuple(r) for r in topk.top_k(three, F.col("vec_id") % 20 == 0).collect()]
    assert sorted(got) == [(20, 1, 2, 64 * 192), (20, 2, 1, 64 * 64)]


# -- near-duplicates --------------------------------------------------------------------------

def test_components(spark):
    links = [(1, 2), (2, 3), (5, 4), (7, 8), (8, 9), (9, 10), (10, 11), (11, 12), (6, 6),
             (None, 3), (20, 19), (19, 18), (18, 20)]
    got = {r["id"]: r["label"] for r in components.components(
        spark.createDataFrame(links, "a long, b long")).collect()}
    wanted = {1: 1, 2: 1, 3: 1, 4: 4, 5: 4, 18: 18, 19: 18, 20: 18} | dict.fromkeys(range(7, 13), 7)
    assert {k: v for k, v in got.items() if k != 6} == wanted
    assert components.components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_near_classes_equal_all_pairs(spark, sf_dir, corpus):
    rows = [(d, t) for d, t in corpus if len(brute.spaced(t)) <= 1500]
    out = near.near_classes(spark.createDataFrame(rows, "doc_id long, text string"))
    got = {r["doc_id"]: r["class_id"] for r in out.collect()}
    wanted = dict(brute.near_classes(rows))
    pairs = lambda x: {
        (a, b) for a in x for b in x if a < b and x[a] == x[b]}
    assert pairs(got) <= pairs(wanted)
    assert len(pairs(got)) >= 0.98 * len(pairs(wanted)) and pairs(wanted)


def family(size, seed, edits=3, words=120):
    random.seed(seed)
    base = [f"f{seed}x{random.randint(0, 400)}" for _ in range(words)]
    out = []
    for _ in range(size):
        copy = list(base)
        for _ in range(edits):
            copy[random.randrange(words)] = f"e{random.randint(0, 10 ** 9)}"
        out.append(" ".join(copy))
    return out


def test_families_with_a_shared_passage(spark):
    """Large families, and texts that only share a passage, in the same buckets."""
    texts = family(60, 1) + family(60, 2)
    passage = family(1, 3, 0, 60)[0]
    random.seed(4)
    texts += [passage + " " + " ".join(f"o{random.randint(0, 10 ** 9)}" for _ in range(40))
              for _ in range(60)]
    texts += [texts[0]] * 5
    random.shuffle(texts)
    rows = list(enumerate(texts))
    out = near.near_classes(spark.createDataFrame(rows, "doc_id long, text string"))
    got = {r["doc_id"]: r["class_id"] for r in out.collect()}
    assert got == dict(brute.near_classes(rows))


def test_bridges_between_closed_members(spark):
    """Chains L1-m-m'-L2 in one bucket each, with names that let any of them lead first."""
    random.seed(7)
    rows, nodes = [], []
    for chain in range(60):
        words = [f"c{chain}x{i}" for i in range(100)]
        for link in range(4):
            if link:
                words[15 * link:15 * link + 15] = [f"d{chain}x{link}x{i}" for i in range(15)]
            doc = 4 * chain + link
            rows.append((doc, doc, " ".join(words)))
            nodes.append((random.randbytes(16), doc, doc, 100, [chain]))
    links = near.near_links(
        spark.createDataFrame(rows, "doc_id long, th long, text string"),
        spark.createDataFrame(
            nodes, "tid binary, doc_id long, th long, n_words long, keys array<long>"))
    found = components.components(links.toDF("a", "b")).collect()
    assert len(found) == len(rows) and len({bytes(r["label"]) for r in found}) == 60


def test_sketches_meet_scattered_edits():
    """Of texts with 15 in 100 words changed, at least as many share a sketch as with two grams in
    16 sketches, the first version."""
    random.seed(8)
    met = 0
    for text in range(200):
        one = [random.getrandbits(62) for _ in range(100)]
        two = list(one)
        for at in random.sample(range(100), 15):
            two[at] = random.getrandbits(62)
        keys = near.sketches(np.array(one + two, np.uint64), np.array([0, 100, 200]), near.GRAM,
                             near.SKETCHES, near.TUPLE)
        met += bool(set(keys[0]) & set(keys[1]))
    assert met >= 0.74 * 200


def test_short_texts_always_meet(spark):
    """One word of n changed at any place, and texts of 49 words at the edge of the link rule."""
    random.seed(9)
    rows, wanted = [], {}
    for n in [*range(5, 21), *[49] * 20]:
        one = [f"s{len(rows)}x{i}" for i in range(n)]
        two = list(one)
        for at in random.sample(range(n), 9 if n == 49 else 1):
            two[at] = f"t{len(rows)}x{at}"
        for words in (one, two):
            wanted[len(rows)] = len(rows) // 2 * 2
            rows.append((len(rows), " ".join(words)))
    out = near.near_classes(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r["doc_id"]: r["class_id"] for r in out.collect()} == wanted


def test_linked_texts_share_a_rarest_word():
    """For any frequencies and reference, and words that repeat."""
    random.seed(10)
    frequency = np.array([random.randint(2, 9) for _ in range(near.SLOTS)])
    for _ in range(300):
        n = random.randint(1, 60)
        one = [random.randint(1, 40) for _ in range(n)]
        two = list(one)
        for at in random.sample(range(n), int(0.2 * n)):
            two[at] = random.randint(1, 40)
        if random.random() < 0.3:
            two = two[:max(1, n - int(0.2 * n))] if two[:1] == one[:1] else two
        a, b = np.array(one, np.uint64), np.array(two, np.uint64)
        ours, theirs, other = (near._words(near.W.mix(x), np.array([0, len(x)])) for x in (
            a, b, np.array([random.randint(1, 40) for _ in range(30)], np.uint64)))
        linked, _ = near.verdict(a, b)
        if linked:
            assert set(near.rarest(ours, frequency, 0.8, other)) & set(
                near.rarest(theirs, frequency, 0.8, other))


def test_linked_texts_share_a_surviving_gram():
    """For any order of grams that none of the two has for itself, and words that repeat."""
    random.seed(11)
    met = 0
    for _ in range(400):
        levels = np.array(random.choices(range(2, 6), k=64), np.uint8).repeat(
            near.GRAM_SLOTS // 64)
        n, few = random.randint(1, 60), random.choice([8, 40, 1000])
        one = [random.randint(1, few) for _ in range(n)]
        two = list(one)
        for _ in range(int(0.2 * n)):
            at = random.randrange(len(two))
            two[at:at + 1] = random.choice([[], [random.randint(1, few)],
                                            [two[at], random.randint(1, few)]]) or two[at:at + 1]
        a, b = np.array(one, np.uint64), np.array(two, np.uint64)
        if near.verdict(a, b)[0]:
            met += 1
            assert set(near.surviving(near.W.mix(a), levels, 0.8)) & set(
                near.surviving(near.W.mix(b), levels, 0.8))
    assert met > 200


def test_gram_levels(spark):
    rows = [(i, "a b c d" if i < 8 else f"x{i} a b") for i in range(11)]
    levels = near.gram_levels(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    data, bounds = near.W.texts(pa.array(["a b c d"]))
    grams = near._grams(near.W.find(data, bounds, near.W.SPACES, near.W.SAME).hash)
    got = [[int(levels[int(x) % near.GRAM_SLOTS]) for x in some] for some in grams]
    eight, eleven = 1 + 8 * 3, 1 + int(8 * np.log2(11))
    assert got == [[eleven, eleven, eight, eight], [eleven, eight, eight], [eight, eight]]


def test_word_bounds_equal_verdicts(spark):
    """Pairs settled by their words alone have the verdict and share of the whole texts."""
    random.seed(12)
    texts = {i.to_bytes(2, "big"): " ".join(random.choices("abcdefghij", k=random.randint(1, 40)))
             for i in range(60)}
    bodies = spark.createDataFrame(list(texts.items()), "tid binary, text string")
    bags = near.bags(bodies)
    pairs = bags.crossJoin(bags.toDF("leader", "other"))
    settled = 0
    for r in near.bounded(pairs, 0.8).collect():
        a, b = (np.array([ord(x) for x in texts[bytes(r[k])].split()]) for k in ("tid", "leader"))
        if r["linked"] is False:
            settled += 1
            assert not near.verdict(a, b)[0] and r["share"] <= near.verdict(a, b)[1]
    assert settled > 1000


def test_texts_of_one_passage_do_not_meet_by_its_words(spark, monkeypatch):
    """Texts of one vocabulary that share a passage: the grams of each are enough to stay apart."""
    random.seed(13)
    passage = [f"p{i}" for i in range(40)]
    rows = [(i, " ".join([*passage, *(f"v{random.randint(0, 400)}" for _ in range(60))]))
            for i in range(150)]
    staged, seen = near.staged, []

    def counted(table, label):
        out = staged(table, label)
        if label == "members":
            seen.append(out.count())
        return out

    monkeypatch.setattr(near, "staged", counted)
    out = near.near_classes(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r["doc_id"]: r["class_id"] for r in out.collect()} == dict(brute.near_classes(rows))
    assert seen[0] > 500 and sum(seen[1:]) < 150, seen


def test_near_edge_cases(edge, nothing):
    out = near.near_classes(edge).collect()
    assert len(out) == len(EDGE)
    empty = [r for r in out if not r["n_words"]]
    assert len(empty) == 4 and {r["class_id"] for r in empty} == {None}
    assert {r["class_id"] for r in out if r["n_words"] >= 40} == {None}
    assert [r["class_id"] for r in out if r["doc_id"] == 5] == [5]
    assert near.near_classes(nothing).collect() == []


# -- licences ---------------------------------------------------------------------------------

def plain_headers(text):
    """Lines, paragraphs, and runs of comment or other lines, without comment marks."""
    import re
    out, blocks = set(), [[], []]
    last = None
    for line in [*re.split("\r\n|\r|\n", text), ""]:
        bare = line[re.match(r"(?:[ \t]|<!--|-->|/\*+|\*+/?|//+|#+|--+|;+|%+)*", line).end():]
        marked = line.lstrip(" \t").startswith(("<!--", "/*", "*", "//", "#", "--", ";", "%"))
        out.add(bare)
        for block, ends in zip(blocks, (not bare, not bare or marked != last), strict=True):
            if ends:
                out.add("\n".join(block))
                block.clear()
            if bare:
                block.append(bare)
        last = marked
    return [x for x in out if re.search(licenses.CUE, x)]


@cache
def plain_match(header):
    idf, rare, _ = licenses.vectors(licenses.TEMPLATES)
    words = licenses._words(header)
    return min((-round(brute.cosine(words, licenses._words(template), idf, rare), 9), name)
               for name, template in licenses.TEMPLATES)


def plain_licence(text, path):
    import re
    headers = plain_headers(text or "")
    if re.search(licenses.LICENCE_FILE, path or ""):
        headers.append(text or "")
    best = min(map(plain_match, headers), default=(0, None))
    return (-best[0], best[1]) if -best[0] >= licenses.LEAST else (0, None)


def plain_licences(files):
    """(key, path, text) -> {key: (licence, origin, from_dir)}."""
    own = {k: plain_licence(t, p) for k, p, t in files}
    directories = {}
    for k, path, _ in files:
        import re
        if path is not None and re.search(licenses.LICENCE_FILE, path) and own[k][1]:
            at = path.rpartition("/")[0]
            directories.setdefault(at, []).append((-round(own[k][0], 9), own[k][1]))
    out = {}
    for k, path, _ in files:
        if own[k][1]:
            out[k] = (own[k][1], "own", None)
            continue
        at = None if path is None else path.rpartition("/")[0]
        while at is not None and at not in directories:
            at = None if not at else at.rpartition("/")[0]
        out[k] = (None, "none", None) if at is None else (min(directories[at])[1], "inherited", at)
    return out


def licence_rows(out, key):
    return {r[key]: (r["licence"], r["origin"], r["from_dir"]) for r in out.collect()}


def test_licences_of_a_tree(spark):
    mit, gpl = "Released under the MIT License.", "licensed under the GNU General Public License, version 3"
    files = [
        (1, "a/LICENSE", mit), (2, "a/x.py", "print"), (3, "a/b/c/y.py", ""), (4, "a/b/COPYING", gpl),
        (5, "a/b/z.py", "text\nThis work is licensed under the GNU General Public License, version 2."),
        (6, "q/r.py", None), (7, None, "nothing"), (8, "top.py", "x"), (9, None, mit),
        (10, "a/b/d/LICENSE.txt", "no words of law"), (11, "a/b/d/u.py", "hello"),
        (12, "h/notice", "all rights reserved"), (13, "h/licence.md", mit), (14, "h/i.py", "")]
    table = spark.createDataFrame(files, "key long, path string, text string")
    got = licence_rows(licenses.licences(table, "key"), "key")
    assert got == plain_licences(files)
    assert got[3] == ("GPL-3.0", "inherited", "a/b") and got[2] == ("MIT", "inherited", "a")
    assert got[11][2] == "a/b" and got[5][0] == "GPL-2.0" and got[6][1] == "none"


GPL_HEADER = """%s
%s This program is free software: you can redistribute it and/or modify
%s it under the terms of the GNU General Public License as published by
%s the Free Software Foundation, either version 3 of the License, or
%s (at your option) any later version.
%s
%s This program is distributed in the hope that it will be useful,
%s but WITHOUT ANY WARRANTY; without even the implied warranty of
%s MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."""
MIT_TEXT = """MIT License

Copyright (c) 2020 Jane Doe

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software."""
BSD_TEXT = """Copyright (c) 2011, The Project Authors. All rights reserved.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

  * Redistributions of source code must retain the above copyright notice.
  * Neither the name of the copyright holder nor the names of its contributors
    may be used to endorse or promote products derived from this software
    without specific prior written permission."""


@pytest.mark.parametrize(("licence", "path", "text"), [
    ("MIT", "a.c", "// SPDX-License-Identifier: MIT\nint x;"),
    ("Apache-2.0", "a.py", "#!/bin/x\n# SPDX-License-Identifier: Apache-2.0\nimport os"),
    ("GPL-2.0", "a.c", "/* SPDX-License-Identifier: GPL-2.0-or-later */"),
    (None, "a.c", "// SPDX-License-Identifier: Foo-Bar"),
    ("GPL-3.0", "a.py", GPL_HEADER.replace("%s", "#") + "\nimport os\n\nx = 1"),
    ("GPL-3.0", "a.c", "/*" + GPL_HEADER.replace("%s", " *") + "\n */\nint main() {}"),
    ("GPL-3.0", "a.h", "/*" + GPL_HEADER.replace("%s", "") + "\n*/\r\nint x;"),
    ("GPL-3.0", "a.sql", GPL_HEADER.replace("%s ", "-- ").replace("%s", "--") + "\rselect 1"),
    ("LGPL-3.0", "a.f", GPL_HEADER.replace("%s", ";").replace("GNU General", "GNU Lesser General")),
    ("GPL-2.0", "a.f", GPL_HEADER.replace("%s", "%").replace("version 3", "version 2")),
    ("BSD-3-Clause", "a.go", "// Copyright 2009 The Go Authors. All rights reserved.\n// Use of this "
     "source code is governed by a BSD-style\n// license that can be found in the LICENSE file.\n"
     "package main"),
    ("Proprietary", "a.js", "// Copyright (c) 2020 Jane Doe. All rights reserved."),
    ("MIT", "LICENSE", MIT_TEXT), ("BSD-3-Clause", "LICENSE", BSD_TEXT),
    ("Apache-2.0", "LICENSE", "   Apache License\n   Version 2.0, January 2004\n   "
     "http://www.apache.org/licenses/\n\n   TERMS AND CONDITIONS FOR USE\n\n" + "1. More. " * 900),
    ("GPL-3.0", "COPYING", "     GNU GENERAL PUBLIC LICENSE\n     Version 3, 29 June 2007\n\n"
     "The GNU General Public License is a free, copyleft license.\n\n" + "Terms. " * 5000),
    (None, "a.md", "The licence of this fine park is older than all rights of way in it."),
])
def test_licences_of_usual_headers(licence, path, text):
    assert plain_licence(text, path)[1] == licence


def test_headers_equal_plain_ones(spark):
    """Marks, wrapped lines, line ends of all kinds, and long lines of marks and blanks."""
    random.seed(4)
    bits = ["# ", "//", " * ", "/*", "*/", "<!-- ", "-->", "licence", "copyright x", "word", "\n", "\r\n",
            "\r", "\n\n", " ", "\t", "; ", "%%", "--"]
    texts = ["".join(random.choice(bits) for _ in range(random.randint(0, 40))) for _ in range(500)]
    texts += ["#" * 200_000 + " licence", " " * 200_000 + "licence\n" + "\n" * 200_000]
    rows = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    got = {r["id"]: r["h"] for r in rows.select(
        "id", licenses.headers(F.col("text")).alias("h")).collect()}
    for i, text in enumerate(texts):
        assert sorted(got[i]) == sorted(plain_headers(text)), repr(text[:200])


def test_licence_query_equals_brute_force(spark, sf_dir):
    folder = sf_dir.replace("sf0.001", "sf0.1")
    tree = queries.file_tree(spark.read.parquet(f"{folder}/documents.parquet"))
    files = [(r["doc_id"], r["path"], r["text"]) for r in tree.collect()]
    got = licence_rows(queries.op2_licences(spark, folder), "doc_id")
    assert got == plain_licences(files) and {o for _, o, _ in got.values()} == {
        "own", "inherited", "none"}


def test_licence_edge_cases(edge, nothing):
    files = edge.withColumn("path", F.lit(None).cast("string"))
    assert {r["origin"] for r in licenses.licences(files, "doc_id").collect()} == {"none"}
    assert licenses.licences(nothing.withColumn("path", F.lit("a")), "doc_id").collect() == []


# -- pipeline ---------------------------------------------------------------------------------

def test_stages_are_the_dealt_ones():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "language", "near_duplicates", "decontamination", "secrets", "packing"]


def test_pipeline_equals_plain_stages(spark, sf_dir, corpus):
    from test_llm_text import check_packing

    rows = sorted(corpus)
    rows = [r for r in rows if any(c.isalpha() for c in r[1])]
    classes = dict(brute.near_classes([r for r in rows if len(brute.spaced(r[1])) <= 3000]))
    rows = [r for r in rows if classes.get(r[0], r[0]) == r[0]]
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet")
             .select("item_id", "text").collect()]
    bad = {r[0] for r in brute.contamination(rows, items) if r[-1]}
    rows = [r for r in rows if r[0] not in bad]

    def redact(text):
        out, at = "", 0
        for start, _, _, end in brute.secret_spans(text):
            if start >= at:
                out += text[at:start] + "[secret]"
            at = max(at, end)
        return out + text[at:]

    rows = [(d, redact(t)) for d, t in rows]
    pieces = corpus_pipeline.run(spark, sf_dir).collect()
    check_packing(rows, pieces)


def test_stages_keep_columns_and_take_effect(spark, sf_dir):
    docs = spark.createDataFrame(
        [(1, "the cat and the dog are in the house", "en", "s", 36, 0.5),
         (1, "the cat and the dog are in the house", "en", "s", 36, 0.5),
         (2, "12345 --- 678", "en", "s", 13, 0.5), (3, None, "en", "s", None, None),
         (None, "the dog says token = \"abcdefgh\" in the house", "en", None, 43, 0.1)],
        "doc_id long, text string, lang string, source string, n_chars long, score double")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf_dir)
        assert out.columns == docs.columns, name
        assert stage(spark, docs.where("false"), sf_dir).collect() == [], name
        rows = out.collect()
        if name == "language":
            assert sorted(str(r["doc_id"]) for r in rows) == ["1", "1", "None"]
        if name == "near_duplicates":
            assert sorted(str(r["doc_id"]) for r in rows) == ["1", "2", "3", "None"]
        if name == "secrets":
            text = next(r for r in rows if r["doc_id"] is None)
            assert text["text"] == "the dog says [secret]\" in the house"
            assert text["n_chars"] == len(text["text"]) and len(rows) == 5
    assert stages.packed(spark, docs.where("false"), sf_dir).collect() == []
