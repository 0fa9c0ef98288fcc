"""Whole jobs on the smallest test tables, with small models."""

import datetime as dt

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ledgerlens import schema as S
from ledgerlens.operators.encode import document_frequencies, term_weights, text_terms
from ledgerlens.operators.sampling import stratified_folds
from ledgerlens.plans import catalog, jobs, models, standin
from ledgerlens.plans.features import (
    FEATURES, ROW, TERMS, TEXT_FEATURES, TextEncoder, TextOptions, fit_encoder, prepare, projected,
    vectors,
)
from ledgerlens.sources.scan import EmptyInput
from ledgerlens.sources.staging import staged
from ledgerlens.sources.state import StateStore

AS_OF = dt.date(2001, 1, 1)
TINY = models.ModelOptions(
    trees=8, correctness_trees=8, depth=5, svm_grid=(1.0, 10.0), svm_iterations=5,
    parallelism=4, linear_grid=(0.0, 0.1), linear_iterations=5,
    text=TextOptions(projection=256, vector_size=16))


@pytest.fixture(scope="module")
def tables(spark, sf_dir):
    rows = staged(standin.commitments(spark, sf_dir), "rows")
    expired = staged(standin.expired_codes(spark, sf_dir), "expired")
    return rows, expired, staged(standin.validated(spark, sf_dir), "validated")


@pytest.fixture(scope="module")
def trained(spark, tables, tmp_path_factory):
    store = StateStore(spark, str(tmp_path_factory.mktemp("store")))
    reports = jobs.training_job(*tables, store, algorithm="rf", floor=20, options=TINY)
    return store, reports


def accuracy(report):
    return report.where("label = 'accuracy'").first()["precision"]


def test_training_reports(trained, tables, spark):
    store, reports = trained
    assert set(reports) == {"funnel", "above", "below", "correctness"}
    above = reports["above"]
    labels = above.where("label not like '%avg' and label <> 'accuracy'")
    largest = labels.agg(F.max("support") / F.sum("support")).first()[0]
    assert accuracy(above) > largest
    assert spark.read.csv(f"{store.root}/reports/above", header=True).count() == above.count()
    assert store.load_scope().count() == tables[0].select(S.CODE).distinct().count()


def test_inference_job(trained, tables, spark, tmp_path):
    store, _ = trained
    results, distribution = jobs.inference_job(
        tables[0], store, str(tmp_path), AS_OF, algorithm="rf")
    rows = {r["Identificador"]: r for r in results.collect()}
    assert len(rows) == results.count() == tables[0].count()
    assert sum(r.n for r in distribution.collect()) == len(rows)
    assert all(r["Resultado"] is not None and r["Data Predicao"] == "01/01/2001"
               for r in rows.values())
    zero = tables[0].where(f"{S.BALANCE} = 0 and {S.CODE} not like '%.92.%'").first()
    assert rows[zero[S.ID]]["Resultado"] in ("SNULO", "CCVE")


def test_evaluation_job(trained, tables, tmp_path):
    store, _ = trained
    reports = jobs.evaluation_job(tables[2], store, str(tmp_path), algorithm="rf")
    averages = reports["all"].where("label = 'macro avg'").collect()
    assert {r.analise for r in averages} == set(S.VERDICTS)
    assert sum(r.support for r in averages) == tables[2].count()
    held_out = reports["holdout_correctness"].where("label = 'macro avg'").first()
    assert held_out.support == -(-tables[2].count() * 20 // 100)


def test_reloaded_models_score_equally(trained, tables):
    store, _ = trained
    one, two = [models.Classifier.load(store, "above", S.CODE_CATEGORIES) for _ in "ab"]
    rows = prepare(tables[0].limit(50), S.CODE_CATEGORIES, [S.ID, S.CODE], "tfidf")
    first, second = [m.score(rows, "m").orderBy(S.ID).collect() for m in (one, two)]
    assert first == second and len(first) == 50
    assert all(abs(sum(r.m_probability) - 1) < 1e-6 for r in first)


def test_unseen_category_and_process_give_zeros(spark, tables):
    rows = prepare(tables[0], S.CODE_CATEGORIES, [S.ID, S.CODE], "tfidf")
    encoder = fit_encoder(rows, S.CODE_CATEGORIES, "tfidf", TINY.text)
    odd = rows.limit(1).withColumn("funcao", F.lit("never seen")).withColumn(S.PROCESS, F.lit("?"))
    known = rows.where(F.col(S.ID) == odd.first()[S.ID])
    assert "funcao" in encoder.categories
    zeros = [encoder.apply(x).select(F.size(F.filter(
        vector_to_array(FEATURES), lambda v: v != 0)).alias("n")).first().n for x in (known, odd)]
    assert zeros[1] == zeros[0] - 1 or zeros[1] == zeros[0] - 2


def test_text_vectors_equal_the_term_table(spark, sf_dir):
    """Exact positions and projected ones are sums of the same weights, in vectors as in cells."""
    rows = staged(catalog.documents(spark, sf_dir).limit(40).select(
        F.col("doc_id").alias(ROW),
        F.split(F.lower("text"), "[^a-z]+").alias(TERMS)), "bags")
    counted = staged(text_terms(rows, ROW, F.col(TERMS)), "counted")
    table = staged(term_weights(
        counted, document_frequencies(counted), rows.count(), ROW), "weights")
    exact = TextEncoder.fit(rows, TERMS, None)
    words = {r["index"]: r.term for r in exact.frequencies.collect()}
    found = {}
    for row in vectors(rows, exact.cells(rows), exact.size, TEXT_FEATURES).collect():
        vector = row[TEXT_FEATURES]
        assert vector.size == len(words)
        for at, weight in zip(vector.indices, vector.values):
            found[row[ROW], words[at]] = round(float(weight), 9)
    assert {(r[ROW], r.term): round(r.weight, 9) for r in table.collect()} == found

    position, sign = projected(F.col("term"), 16)
    wanted = {(r[ROW], r.position): round(r.value, 9) for r in table.groupBy(
        ROW, position.alias("position")).agg(F.sum(sign * F.col("weight")).alias("value")).collect()}
    short = TextEncoder.fit(rows, TERMS, 16)
    got = {(r[ROW], int(at)): round(float(x), 9) for r in vectors(
        rows, short.cells(rows), 16, TEXT_FEATURES).collect()
        for at, x in zip(r[TEXT_FEATURES].indices, r[TEXT_FEATURES].values)}
    assert got == wanted and {at for _, at in got} <= set(range(16))


def test_jobs_filter_and_refuse_empty_input(trained, tables, tmp_path):
    store, _ = trained
    days = {"daterange": (dt.date(1999, 1, 1), dt.date(1999, 3, 31))}
    results, _ = jobs.inference_job(
        tables[0], store, str(tmp_path / "a"), AS_OF, algorithm="rf", **days)
    wanted = tables[0].where("periodo between '1999/01/01' and '1999/03/31'")
    assert results.count() == wanted.count() > 0
    path = str(tmp_path / "input")
    wanted.write.parquet(path)
    stored, _ = jobs.inference_job(
        {"path": path}, store, str(tmp_path / "b"), AS_OF, algorithm="rf")
    assert stored.count() == wanted.count()
    with pytest.raises(EmptyInput):
        jobs.inference_job(tables[0], store, str(tmp_path / "c"), AS_OF, algorithm="rf",
                           dates=[dt.date(2050, 1, 1)])


def test_the_last_row_of_an_identifier_wins(spark):
    schema = f"{S.ID} string, {S.CODE} string, {S.BALANCE} double, predicted string, verdict string"
    rows = [("1", "A", 1.0, "A", "OK"), ("1", "B", 1.0, "A", "INCORRETO")]
    scope = spark.createDataFrame([("A", "Em escopo"), ("B", "Em escopo")],
                                  "natureza string, status string")
    for order in (rows, rows[::-1]):
        source = spark.createDataFrame(order, schema).coalesce(1)
        found = jobs.infer(source, scope, lambda df, kept: df, AS_OF).collect()
        _, code, _, predicted, verdict = order[-1]
        assert [(r["Natureza Real"], r["Natureza Predita"], r["Corretude"]) for r in found] == [
            (code, predicted, verdict)]


@pytest.fixture(scope="module")
def three_classes(spark, tables):
    """A small learnable problem: three expense codes that differ by function."""
    rows = tables[0].withColumn(S.CODE, F.concat(F.lit("c"), F.col("tipo_poder_nome")))
    return prepare(rows, S.CODE_CATEGORIES, [S.ID, S.CODE], "dense+tfidf")


@pytest.mark.parametrize("algorithm", ["svm", "dense_rf"])
def test_other_algorithms_learn(three_classes, algorithm):
    trained = jobs.train_code_classifier(three_classes, algorithm, TINY)
    largest = three_classes.groupBy(S.CODE).count().agg(
        F.max("count") / F.sum("count")).first()[0]
    assert accuracy(trained.report) > largest
    if algorithm == "svm":
        scored = trained.classifier.score(three_classes.limit(5), "m").collect()
        assert all(len(r.m_probability) == 3 and max(r.m_probability) <= 1 for r in scored)


def test_dense_linear_keeps_the_best_candidate(three_classes):
    split = jobs.stratified_split(three_classes, S.CODE, S.ID, 30)
    model, pairs, history = models.fit_dense_linear(
        split.where("not is_test"), split.where("is_test"), S.CODE, TINY)
    rows = history.orderBy("ord").collect()
    assert [r.ord for r in rows] == [0, 1] and {"train_loss", "val_loss", "val_macro"} <= set(
        history.columns)
    right = pairs.agg(F.avg((F.col(S.CODE) == F.col("predicted")).cast("int"))).first()[0]
    assert abs(right - max(r.accuracy for r in rows)) < 1e-9


def test_folds_reach_the_penalty_search(three_classes):
    rows = stratified_folds(three_classes, S.CODE, S.ID, 3)
    assert {r.fold for r in rows.select("fold").distinct().collect()} == {0, 1, 2}


def test_sampled_training_input(tables, spark, tmp_path):
    from ledgerlens.operators.sampling import sample_rows
    assert sample_rows(tables[0], 100, S.ID).count() == 100


def test_a_failed_training_leaves_the_last_version(spark, tables, trained, monkeypatch):
    store, _ = trained
    before = store.current().version

    def fails(*_):
        raise RuntimeError("stopped")

    monkeypatch.setattr(jobs, "train_code_classifier", fails)
    with pytest.raises(RuntimeError, match="stopped"):
        jobs.training_job(*tables, store, algorithm="rf", floor=20, options=TINY)
    assert before is not None and store.current().version == before
    assert jobs.Models.load(store, "rf").codes


def test_prepared_bags_are_counted_once(spark, sf_dir):
    from ledgerlens.plans.features import WORDS, counted_terms
    from ledgerlens.plans.standin import commitments
    rows = commitments(spark, sf_dir).limit(20)
    prepared = prepare(rows, S.CODE_CATEGORIES, [S.ID], "hashed+dense")
    assert prepared.schema[TERMS].dataType.elementType.fieldNames() == ["term", "tf"]
    assert prepared.schema[WORDS].dataType.elementType.simpleString() == "string"
    for name in (TERMS, WORDS):
        counted = counted_terms(prepared, name)
        # read from the prepared rows themselves, not written out again
        assert set(counted.inputFiles()) == set(prepared.inputFiles())
        assert counted.groupBy(ROW, "term").count().where("count > 1").isEmpty()
