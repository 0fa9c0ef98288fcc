"""Alignment of two tokenizers against whole texts encoded at once."""

import hashlib
import random
from collections import Counter, defaultdict
from functools import reduce

import pytest
from pyspark.sql import functions as F

from ledgerlens.llm import alignment
from ledgerlens.llm.queries import op13_alignment, tokenizer_path

PATHS = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")
COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]


@pytest.fixture(scope="module")
def aligner():
    return alignment.aligner_of(PATHS)


def tokens(aligner, text):
    """[(id, bytes)] of both tokenizers, or None."""
    if not text:
        return None
    a = aligner.first.encode(" " + text, add_special_tokens=False).ids
    b = aligner.second.encode(text, num_threads=1)
    sides = ([(i, aligner.first_bytes[i]) for i in a], [(i, aligner.second_bytes[i]) for i in b])
    whole = (" " + text).encode()
    return sides if all(b"".join(x for _, x in s) == whole for s in sides) else None


def plain(aligner, docs):
    """[(doc_id, text)] -> sorted rows with the groups as text."""
    found, holds = [], Counter()
    for doc_id, text in docs:
        sides = tokens(aligner, text)
        if sides is None:
            found.append((doc_id, None))
            continue
        spans = []
        for side in sides:
            end, out = 0, []
            for i, raw in side:
                out.append((i, end, end := end + len(raw)))
            spans.append(out)
        both = {e for _, _, e in spans[0]} & {e for _, _, e in spans[1]}
        cuts = [0, *sorted(both)]
        groups = [[[i for i, _, e in side if low < e <= high] for side in spans]
                  for low, high in zip(cuts, cuts[1:], strict=False)] if len(cuts) < 2000 else None
        links = [(i, j) for i, s, e in spans[0] for j, t, f in spans[1] if s < f and t < e]
        holds.update(set(links))
        text = ";".join("|".join(",".join(map(str, x)) for x in g) for g in groups)
        found.append((doc_id, (len(spans[0]), len(spans[1]), len(groups), links, text)))
    best = defaultdict(int)
    for (i, _), n in holds.items():
        best[i] = max(best[i], n)
    return sorted(
        ((d, 0, 0, 0, 0, 0, 0, "") if x is None else
         (d, *x[:3], len(x[3]), sum(holds[p] == best[p[0]] for p in x[3]),
          sum(holds[p] for p in x[3]), x[4]) for d, x in found), key=repr)


def rows(frame, groups="groups"):
    return sorted((tuple(r) for r in frame.select("doc_id", *COLUMNS, groups).collect()), key=repr)


ODD = ["", None, " ", "\n", "  two  spaces \n\n and\tlines ", "ab▁cd", "▁", "a\x00b c\x1c d",
       "<|endoftext|> <s> </s> <0x41> <unk>", "naïve ﬁ é é 日本語 текст 😀 x", "don't 'll I'm 3.14",
       "nbsp  x y z\u0085 w", "x" * 300, "a\r\nb \n c", "one", "one", "end \n"]


def noise(dice, n):
    return "".join(dice.choice("ab  \n\té日'1.😀z ") for _ in range(n))


@pytest.fixture(scope="module")
def docs():
    dice = random.Random(13)
    texts = ODD + [noise(dice, dice.randrange(1, 400)) for _ in range(60)]
    return [(i if i % 7 else None, t) for i, t in enumerate(texts)]


@pytest.mark.parametrize(("size", "fan", "limit"), [
    (1 << 16, 16, 10 ** 6), (16, 2, 10 ** 6), (5, 3, 10 ** 6), (40, 2, 0)])
def test_alignment_equals_whole_texts(spark, aligner, docs, size, fan, limit):
    """Texts aligned whole, and as trees of ranges of a few bytes; counts from both look-ups."""
    frame = spark.createDataFrame(
        [(*d, 1, "x", 3) for d in docs], "doc_id long, text string, rid long, groups string, n int")
    found = alignment.align(frame, *PATHS, size=size, fan=fan, limit=limit)
    assert rows(found) == plain(aligner, docs)


def test_digests(spark, aligner, docs):
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    for size in (1 << 16, 20):
        found = alignment.align(frame, *PATHS, digests=True, size=size)
        wanted = [(*r[:-1], hashlib.sha256(r[-1].encode()).hexdigest() if r[1] else "")
                  for r in plain(aligner, docs)]
        assert rows(found, "groups_sha256") == sorted(wanted, key=repr)


def test_query_equals_whole_texts(spark, sf_dir, aligner):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet")
            .where(F.length("text") < 1500).select("doc_id", "text").collect()]
    found = {r["doc_id"]: r for r in op13_alignment(spark, sf_dir).collect()}
    for doc_id, n_a, n_b, n_groups, n_links, _, _, groups in plain(aligner, docs):
        row = found[doc_id]
        assert (row["n_a"], row["n_b"], row["n_groups"], row["n_links"]) == (
            n_a, n_b, n_groups, n_links)
        assert row["groups_sha256"] == (
            hashlib.sha256(groups.encode()).hexdigest() if groups else "")


def test_empty_table_and_very_long_text(spark, aligner):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert alignment.align(empty, *PATHS).collect() == []
    long = " ".join(f"word{i % 90}\n" if i % 11 == 0 else f"w{i % 70}" for i in range(200_000))
    frame = spark.createDataFrame([(1, long), (2, "w1 w2")], "doc_id long, text string")
    tree = rows(alignment.align(frame, *PATHS, digests=True, size=4096, fan=4), "groups_sha256")
    whole = rows(alignment.align(frame, *PATHS, digests=True, size=1 << 30), "groups_sha256")
    assert tree == whole
    sides = tokens(aligner, long)
    assert tree[0][1:3] == (len(sides[0]), len(sides[1]))


@pytest.mark.parametrize("seed", range(20))
def test_fragments_compose_in_any_order(aligner, seed):
    dice = random.Random(seed)
    text = " " + noise(dice, dice.randrange(1, 60))
    edges = sorted({0, len(text), *(dice.randrange(len(text)) for _ in range(8))})
    closed, parts = [], []
    for low, high in zip(edges, edges[1:], strict=False):
        fragment, units = alignment.Fragment.of(
            aligner, len(text[:low].encode()), text[low:high])
        parts.append(fragment)
        closed += units
    for empty in (0, len(parts)):
        parts.insert(empty, alignment.Fragment(0, ""))
    trees = []
    for _ in range(3):
        left, seen = list(parts), list(closed)
        while len(left) > 1:
            at = dice.randrange(len(left) - 1)
            joined, units = left[at].then(aligner, left[at + 1])
            left[at:at + 2] = [joined]
            seen += units
        seen += left[0].ends()
        trees.append([u for _, units in sorted(seen) for u in units])
    assert trees[0] == trees[1] == trees[2] == alignment._CUT.split(text)


def test_link_counts_of_equal_documents(spark):
    frame = spark.createDataFrame([(i, "same words here") for i in range(50)],
                                  "doc_id long, text string")
    found = rows(alignment.align(frame, *PATHS))
    assert all(r[4] == r[5] and r[6] == 50 * r[4] for r in found)
    assert reduce(lambda a, b: a and b[1:] == found[0][1:], found, True)
