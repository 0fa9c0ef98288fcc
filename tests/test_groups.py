"""Sampling, ranks, lookups, encodings and reports against brute force."""

import hashlib
import math
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from ledgerlens import schema as S
from ledgerlens.operators import encode, report, sampling
from ledgerlens.operators.lookup import lookup
from ledgerlens.operators.ranking import ordered_index
from ledgerlens.sources.staging import checked_broadcast, staged


def skewed(spark, n=3000):
    """One label owns a third of the rows."""
    label = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(
        F.concat(F.lit("c"), F.pmod(F.xxhash64("id"), F.lit(40)).cast("string")))
    return staged(spark.range(n).select(F.col("id").cast("string").alias(S.ID),
                                        label.alias(S.CODE)), "skewed")


def order_of(identifier, seed=15):
    return hashlib.md5(f"{identifier}:{seed}".encode()).hexdigest(), identifier


def members(df):
    groups = defaultdict(list)
    for row in df.collect():
        groups[row[S.CODE]].append(row[S.ID])
    return {label: sorted(ids, key=order_of) for label, ids in groups.items()}


@pytest.fixture(params=["sorted at once", "narrowed first"])
def narrowing(request, monkeypatch):
    if request.param == "narrowed first":
        monkeypatch.setattr("ledgerlens.operators.ranking.SORTABLE", 0)
        monkeypatch.setattr("ledgerlens.operators.ranking.FINE_DIGITS", 1)


@pytest.mark.parametrize("n", [0, 1, 700, 2999, 3000, 5000])
def test_sample_is_the_smallest_hashes(spark, narrowing, n):
    rows = skewed(spark)
    found = sorted(r[S.ID] for r in sampling.sample_rows(rows, n, S.ID).collect())
    wanted = sorted(sorted((str(i) for i in range(3000)), key=order_of)[:n])
    assert found == wanted


@pytest.mark.parametrize("percent", [20, 30])
def test_split_quota_and_members(spark, narrowing, percent):
    rows = skewed(spark)
    found = sampling.stratified_split(rows, S.CODE, S.ID, percent)
    groups = members(rows)
    total = sum(map(len, groups.values()))
    wanted = -(-total * percent // 100)
    shares = {k: divmod(len(v) * wanted, total) for k, v in groups.items()}
    missing = wanted - sum(whole for whole, _ in shares.values())
    extra = sorted(shares, key=lambda k: (-shares[k][1], k))[:missing]
    test = {i for k, v in groups.items() for i in v[:shares[k][0] + (k in extra)]}
    assert {r[S.ID] for r in found.where("is_test").collect()} == test
    assert found.count() == total and len(test) == wanted


@pytest.mark.parametrize("folds", [2, 3, 5])
def test_folds(spark, narrowing, folds):
    rows = skewed(spark, 1000)
    found = {r[S.ID]: r.fold for r in
             sampling.stratified_folds(rows, S.CODE, S.ID, folds).collect()}
    start, wanted = 0, {}
    for label, ids in sorted(members(rows).items()):
        sizes = Counter((start + i) % folds for i in range(len(ids)))
        start += len(ids)
        dealt = [fold for fold in range(folds) for _ in range(sizes[fold])]
        wanted.update(zip(ids, dealt))
    assert found == wanted
    sizes = Counter(found.values())
    assert max(sizes.values()) - min(sizes.values()) <= 1


def test_folds_of_tiny_classes(spark):
    rows = spark.createDataFrame(
        [(str(i), label) for i, label in enumerate("aabcd")], f"{S.ID} string, {S.CODE} string")
    found = sampling.stratified_folds(rows, S.CODE, S.ID, 3).collect()
    assert len(found) == 5 and sorted(Counter(r.fold for r in found).values()) == [1, 2, 2]


def test_repeated_and_null_identifiers(spark, narrowing):
    """Exact totals though one identifier has many copies, or none is known."""
    identifier = F.when(F.col("id") % 100 < 97, (F.col("id") % 100).cast("string"))
    rows = staged(spark.range(3000).select(
        identifier.alias(S.ID), F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias(S.CODE),
        "id").repartition(3), "repeated")
    sample = sampling.sample_rows(rows, 100, S.ID)
    assert sample.count() == 100 == sample.select("id").distinct().count()
    split = sampling.stratified_split(rows, S.CODE, S.ID, 30).where("is_test")
    assert {r[S.CODE]: r["count"] for r in split.groupBy(S.CODE).count().collect()} == {
        "a": 300, "b": 600}
    folds = sampling.stratified_folds(rows, S.CODE, S.ID, 7)
    sizes = [r["count"] for r in folds.groupBy("fold").count().collect()]
    assert sum(sizes) == 3000 == folds.select("id").distinct().count() and max(sizes) - min(sizes) <= 1
    # whole identifiers but for the ones at the cuts
    sides = split.groupBy(S.CODE, S.ID).count().collect()
    sizes = {(r[S.CODE], r[S.ID]): r["count"] for r in rows.groupBy(S.CODE, S.ID).count().collect()}
    assert sum(r["count"] < sizes[r[S.CODE], r[S.ID]] for r in sides) <= 2


def test_one_identifier_for_all_rows(spark):
    rows = staged(spark.range(500).select(F.lit(None).cast("string").alias(S.ID), "id")
                  .repartition(4), "nameless")
    assert sampling.sample_rows(rows, 20, S.ID).select("id").distinct().count() == 20


def test_label_codes(spark):
    rows = spark.createDataFrame([("1", "b"), ("2", "a"), ("3", "b"), ("4", None)],
                                 f"{S.ID} string, {S.CODE} string")
    assert {r[S.CODE]: r.code for r in sampling.label_codes(rows, S.CODE).collect()} == {
        "a": 0, "b": 1}


def test_lookup_gives_the_same_rows_broadcast_or_spread(spark):
    rows = skewed(spark).withColumn("k", F.when(F.col(S.ID) == "7", None).otherwise(F.col(S.CODE)))
    table = staged(
        rows.where("k is not null and k <> 'c3'").groupBy("k").agg(
            F.count("*").alias("n"), F.max(S.ID).alias("top")), "table")
    plain = lookup(rows, table, "k", S.ID)
    spread = lookup(rows, table, "k", S.ID, limit=0)
    assert sorted(plain.columns) == sorted(spread.columns)
    columns = sorted(plain.columns)
    assert (sorted(map(str, plain.select(columns).collect()))
            == sorted(map(str, spread.select(columns).collect())))
    assert spread.count() == rows.count()


@pytest.mark.parametrize("known", [True, False])
def test_spread_lookup_splits_the_hot_key(spark, known):
    """The rows of a key that owns a third of the rows end up in many shuffle partitions, also if
    the table lacks the key."""
    rows = skewed(spark, 30000)
    table = staged(rows.where(F.lit(known) | (F.col(S.CODE) != "hot"))
                   .groupBy(S.CODE).agg(F.count("*").alias("n")), "table")
    saved = {k: spark.conf.get(k) for k in (
        "spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled",
        "spark.sql.autoBroadcastJoinThreshold")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "16")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        joined = lookup(rows, table, S.CODE, S.ID, limit=0)
        sizes = [r.n for r in joined.groupBy(F.spark_partition_id()).agg(
            F.count("*").alias("n")).collect()]
    finally:
        for key, value in saved.items():
            spark.conf.set(key, value)
    assert sum(sizes) == 30000 and max(sizes) < 30000 / 5


def test_large_tables_are_not_broadcast(spark):
    table = staged(spark.range(1000).select(F.col("id").cast("string").alias("k")), "wide")
    assert "broadcast" in checked_broadcast(table)._jdf.queryExecution().toString().lower()
    plan = checked_broadcast(table, limit=1000)._jdf.queryExecution().logical().toString().lower()
    assert "broadcast" not in plan


def test_process_counts_default_to_zero(spark):
    train = spark.createDataFrame([("1", "p"), ("2", "p"), ("3", "q"), ("4", None)],
                                  f"{S.ID} string, {S.PROCESS} string")
    new = spark.createDataFrame([("5", "p"), ("6", "new"), ("7", None)], train.schema)
    counts = encode.fit_process_counts(train)
    found = {r[S.ID]: r[encode.PROCESS_COUNT]
             for r in encode.apply_process_counts(new, counts).collect()}
    assert found == {"5": 2.0, "6": 0.0, "7": 0.0}


def test_min_max_of_a_constant_column_and_nan(spark):
    train = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0), (float("nan"), 5.0)], "a double, b double")
    ranges = encode.fit_ranges(train, ["a", "b"])
    assert {r["column"]: (r.low, r.high) for r in ranges.collect()} == {
        "a": (1.0, 3.0), "b": (5.0, 5.0)}
    new = spark.createDataFrame([(5.0, 7.0)], "a double, b double")
    columns = encode.scaled(ranges, ["a", "b"])
    assert tuple(new.select(columns["a"], columns["b"]).first()) == (2.0, 2.0)


def test_one_hot_leaves_out_unknown_values(spark):
    train = spark.createDataFrame([("1", "b"), ("2", "a"), ("3", None)], f"{S.ID} string, c string")
    vocabulary = encode.fit_vocabulary(train, ["c"])
    new = spark.createDataFrame([("4", "a"), ("5", "zzz"), ("6", None)], train.schema)
    found = encode.one_hot_positions(new, vocabulary, ["c"]).collect()
    assert {(r[S.ID], r["index"]) for r in found} == {("4", 0), ("6", 2)}


def test_term_counts(spark):
    rows = spark.createDataFrame([(["b", "a", "b", "c", "b"],), ([],), (["x"],)], "t array<string>")
    found = [r.c for r in rows.select(encode.term_counts(F.col("t")).alias("c")).collect()]
    assert [[tuple(x) for x in c] for c in found] == [[("a", 1), ("b", 3), ("c", 1)], [], [("x", 1)]]


TEXTS = [("d1", ["a", "b", "b"]), ("d2", ["a", "c"]), ("d3", ["a"]), ("d4", [])]


def brute_tfidf(texts):
    df = Counter(t for _, terms in texts for t in set(terms))
    out = {}
    for name, terms in texts:
        raw = {t: n * (math.log((1 + len(texts)) / (1 + df[t])) + 1)
               for t, n in Counter(terms).items()}
        norm = math.sqrt(sum(v * v for v in raw.values()))
        out.update({(name, t): round(v / norm, 9) for t, v in raw.items()})
    return out


@pytest.mark.parametrize("limit", [None, 0])
def test_tfidf_against_brute_force(spark, monkeypatch, limit):
    if limit is not None:
        monkeypatch.setattr("ledgerlens.operators.lookup.fits_broadcast", lambda *_: False)
    rows = spark.createDataFrame(TEXTS, "id string, terms array<string>")
    counted = staged(encode.text_terms(rows, "id", F.col("terms")), "counted")
    found = encode.term_weights(counted, encode.document_frequencies(counted), len(TEXTS), "id")
    assert {(r.id, r.term): round(r.weight, 9) for r in found.collect()} == brute_tfidf(TEXTS)


PAIRS = [("a", "a")] * 5 + [("a", "b")] * 2 + [("b", "b")] * 3 + [("c", "a")] + [("b", "d")]


def brute_report(pairs):
    labels = sorted({x for pair in pairs for x in pair})
    rows = {}
    for label in labels:
        hits = sum(t == p == label for t, p in pairs)
        told = sum(p == label for _, p in pairs)
        support = sum(t == label for t, _ in pairs)
        precision = hits / told if told else 0
        recall = hits / support if support else 0
        f1 = 2 * precision * recall / (precision + recall) if precision + recall else 0
        rows[label] = (precision, recall, f1, support)
    n = len(pairs)
    accuracy = sum(t == p for t, p in pairs) / n
    macro = [sum(r[i] for r in rows.values()) / len(rows) for i in range(3)]
    weighted = [sum(r[i] * r[3] for r in rows.values()) / n for i in range(3)]
    rows |= {"accuracy": (accuracy,) * 4, "macro avg": (*macro, n), "weighted avg": (*weighted, n)}
    return {k: tuple(round(float(x), 9) for x in v) for k, v in rows.items()}


def test_class_report(spark):
    pairs = spark.createDataFrame(PAIRS, "t string, p string")
    found = {r.label: tuple(round(x, 9) for x in r[1:])
             for r in report.class_report(pairs, "t", "p").collect()}
    assert found == brute_report(PAIRS)


def test_grouped_report_keeps_slices_apart(spark):
    rows = [("x", *p) for p in PAIRS] + [("y", "a", "a")]
    frame = spark.createDataFrame(rows, "g string, t string, p string")
    found = defaultdict(dict)
    for r in report.class_report(frame, "t", "p", ["g"]).collect():
        found[r.g][r.label] = tuple(round(x, 9) for x in r[2:])
    assert found["x"] == brute_report(PAIRS) and found["y"] == brute_report([("a", "a")])


def test_special_report_columns(spark):
    data = spark.createDataFrame([(x,) for x in "aaaabbcd"], f"{S.CODE} string")
    pairs = spark.createDataFrame(PAIRS, "t string, p string")
    rows = {r.label: r for r in report.special_report(pairs, "t", "p", data).collect()}
    assert (rows["a"]["n docs"], rows["a"]["percent of total"]) == (4.0, 0.5)
    assert (rows["macro avg"]["n docs"], rows["macro avg"]["percent of total"]) == (8.0, 1.0)
    assert rows["accuracy"]["n docs"] == rows["accuracy"]["precision"]


def test_best_candidate_prefers_the_first_of_equals(spark):
    table = spark.createDataFrame(
        [("e1", 0, 0.5), ("e2", 1, 0.9), ("e3", 2, 0.9), ("e4", 3, 0.1)],
        "candidate string, ord int, accuracy double")
    assert report.best_candidate(table).first()["candidate"] == "e2"


def test_ordered_index_over_several_files(spark):
    rows = [(g, f"v{i:04d}") for g in "abc" for i in range(200)]
    values = spark.createDataFrame(rows, "g string, v string").repartition(7)
    saved = spark.conf.get("spark.sql.adaptive.enabled")
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        found = ordered_index(values, "g", "v").collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", saved)
    assert len(found) == 600 and all(r["index"] == int(r.v[1:]) for r in found)


def test_decoding_undoes_encoding(spark):
    rows = skewed(spark, 300)
    codes = staged(sampling.label_codes(rows, S.CODE), "codes")
    numbers = sampling.encode_labels(rows, S.CODE, codes).select(S.ID, "code")
    back = sampling.decode_labels(numbers, "code", codes)
    assert {(r[S.ID], r.code) for r in back.collect()} == {
        (r[S.ID], r[S.CODE]) for r in rows.collect()}


def test_scope_and_one_hot_do_not_depend_on_the_broadcast(spark, monkeypatch):
    from ledgerlens.operators import scope
    rows = skewed(spark, 600).withColumn(S.BALANCE, F.lit(1.0)).withColumn(
        S.CODE, F.when(F.col(S.ID) == "5", None).otherwise(F.col(S.CODE)))
    expired = spark.createDataFrame([("c1",)], "nat_despesa string")
    profile = scope.code_profile(rows, expired, floor=50)
    vocabulary = encode.fit_vocabulary(rows.where(f"{S.CODE} <> 'c2'"), [S.CODE])

    def results():
        noted = scope.with_scope(rows, scope.scope_map(profile).where("natureza <> 'c3'"))
        return [sorted(map(str, df.select(sorted(df.columns)).collect())) for df in (
            scope.cleaned_rows(rows, profile), noted,
            encode.one_hot_positions(rows, vocabulary, [S.CODE]))]

    plain = results()
    monkeypatch.setattr("ledgerlens.operators.lookup.fits_broadcast", lambda *_: False)
    assert results() == plain and len(plain[1]) == 600
