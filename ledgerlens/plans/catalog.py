"""Registered queries: every operator over the whole test tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens import schema as S
from ledgerlens.functions import derive, text
from ledgerlens.functions.names import normalise_columns
from ledgerlens.functions.stemming import stem
from ledgerlens.functions.verdict import result_code
from ledgerlens.operators import encode, filters, merge, report, sampling, scope
from ledgerlens.operators.wordvectors import WordVectors, association_sums
from ledgerlens.plans import jobs, standin
from ledgerlens.plans.features import (
    ROW, TextOptions, fit_encoder, prepare, text_encoder,
)
from ledgerlens.plans.jobs import (
    evaluate, infer, train_code_classifier, train_correctness,
)
from ledgerlens.plans.models import ModelOptions, fit_dense_linear
from ledgerlens.plans.standin import commitments, given_predictions, read, validated
from ledgerlens.sources import scan, sinks
from ledgerlens.sources.staging import staged, staging_path
from ledgerlens.sources.state import StateStore

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

AS_OF = dt.date(2000, 3, 2)
FLOOR = 200
SAMPLE = 1000

# The models of rf_code, svm_code, dense_rf and dense_linear are whole ones.
FULL = ModelOptions()
# Small models, for rf_correctness, training_job and word_vectors: few trees and short vectors.
SMALL_TEXT = TextOptions(vector_size=32)
SMALL = ModelOptions(
    trees=20, correctness_trees=20, depth=6, svm_grid=(1.0,), svm_iterations=2,
    parallelism=8, linear_grid=(0.0, 0.01), linear_iterations=20, text=SMALL_TEXT)


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def profile_of(rows: DataFrame, spark: SparkSession, sf_dir: str, floor: int = FLOOR) -> DataFrame:
    expired = staged(standin.expired_codes(spark, sf_dir), "expired")
    return scope.code_profile(rows, expired, floor)


def coded(spark: SparkSession, sf_dir: str, *more: str) -> DataFrame:
    return commitments(spark, sf_dir, S.ID, S.CODE, S.BALANCE, *more)


# --- projections and filters ---------------------------------------------------------------


@query
def regularized_projection(spark, sf_dir):
    source = commitments(spark, sf_dir).toDF(*S.SOURCE_HEADERS)
    return normalise_columns(source)


@query
def projection_code(spark, sf_dir):
    return filters.project(commitments(spark, sf_dir), "code")


@query
def projection_correctness(spark, sf_dir):
    return filters.project(commitments(spark, sf_dir), "correctness")


@query
def projection_anomaly(spark, sf_dir):
    return filters.project(commitments(spark, sf_dir), "anomaly")


@query
def projection_text(spark, sf_dir):
    return filters.project(commitments(spark, sf_dir, S.HISTORY, S.CODE), "text")


@query
def filter_year(spark, sf_dir):
    return commitments(spark, sf_dir, S.ID, S.YEAR).where(filters.from_year(1998))


@query
def filter_dates(spark, sf_dir):
    days = [dt.date(1998, 1, 5), dt.date(1999, 7, 20), dt.date(2000, 2, 29)]
    return commitments(spark, sf_dir, S.ID, S.PERIOD).where(filters.on_dates(days))


@query
def filter_daterange(spark, sf_dir):
    rows = commitments(spark, sf_dir, S.ID, S.PERIOD)
    return rows.where(filters.in_date_range(dt.date(1999, 3, 31), dt.date(1999, 1, 1)))


@query
def filter_previous_day(spark, sf_dir):
    return commitments(spark, sf_dir, S.ID, S.PERIOD).where(filters.on_previous_day(AS_OF))


@query
def filter_orgaos(spark, sf_dir):
    rows = commitments(spark, sf_dir, S.ID, S.PERIOD, S.ORGAN)
    return rows.where(filters.slice_condition(
        AS_OF, daterange=(dt.date(1999, 1, 1), dt.date(1999, 12, 31)),
        orgaos=["NATION_3", "NATION_7"]))


@query
def split_zero_balance(spark, sf_dir):
    kept, dropped = filters.split_by(coded(spark, sf_dir), filters.positive_balance())
    return kept.withColumn("side", F.lit("kept")).unionByName(
        dropped.withColumn("side", F.lit("dropped")))


@query
def drop_class92(spark, sf_dir):
    return coded(spark, sf_dir).where(~filters.element_92())


@query
def drop_expired(spark, sf_dir):
    expired = staged(standin.expired_codes(spark, sf_dir), "expired")
    return filters.without_codes(coded(spark, sf_dir), expired, "nat_despesa")


@query
def class_floor(spark, sf_dir):
    return filters.frequent_codes(coded(spark, sf_dir), FLOOR)


@query
def singleton_floor(spark, sf_dir):
    return filters.frequent_codes(coded(spark, sf_dir), 2)


@query
def sample_n(spark, sf_dir):
    return sampling.sample_rows(coded(spark, sf_dir), SAMPLE, S.ID)


# --- scope and cleaning --------------------------------------------------------------------


@query
def scope_map(spark, sf_dir):
    return scope.scope_map(profile_of(coded(spark, sf_dir), spark, sf_dir))


@query
def cleaning_sections(spark, sf_dir):
    rows = coded(spark, sf_dir)
    return scope.cleaned_rows(rows, profile_of(rows, spark, sf_dir)).select(
        S.ID, S.CODE, S.BALANCE, "section")


@query
def cleaning_funnel(spark, sf_dir):
    return scope.cleaning_funnel(profile_of(coded(spark, sf_dir), spark, sf_dir))


@query
def class_frequencies(spark, sf_dir):
    return scope.class_frequencies(commitments(spark, sf_dir, S.CODE))


@query
def class_count(spark, sf_dir):
    return scope.class_count(commitments(spark, sf_dir, S.CODE))


def inference_input(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Commitments from 2000 on, and the scope map that the earlier ones give."""
    rows = coded(spark, sf_dir, S.PERIOD, S.YEAR, "order_key", "customer_key")
    earlier = rows.where(F.col(S.YEAR) < 2000)
    return rows.where(F.col(S.YEAR) >= 2000), scope.scope_map(profile_of(earlier, spark, sf_dir))


@query
def in_scope_rows(spark, sf_dir):
    rows, known = inference_input(spark, sf_dir)
    return scope.in_scope(rows.select(S.ID, S.CODE, S.BALANCE), known)


@query
def out_of_scope_verdicts(spark, sf_dir):
    rows, known = inference_input(spark, sf_dir)
    note = F.col("scope_note")
    return scope.out_of_scope(rows, known).select(
        S.ID, S.CODE, note.alias("verdict"), merge.scope_result(note).alias("result"))


# --- verdicts ------------------------------------------------------------------------------


@query
def result_codes(spark, sf_dir):
    rows = given_predictions(commitments(spark, sf_dir, S.ID, S.CODE, "order_key", "customer_key"))
    return rows.select(
        S.ID, result_code(F.col(S.CODE), F.col("predicted"), F.col("verdict")).alias("resultado"))


@query
def keyed_merge(spark, sf_dir):
    """Line items as repeated rows of one identifier, put in order by date, number and price."""
    rows = read(spark, sf_dir, "lineitem").selectExpr(
        f"cast(l_orderkey as string) as {S.ID}",
        f"'c' || cast(l_partkey % 5 as string) as {S.CODE}",
        "case when l_suppkey % 3 = 0 then 'Classe 92' when l_suppkey % 7 = 0 then 'Saldo zerado' "
        "end as scope_note",
        "case when l_suppkey % 3 = 0 or l_suppkey % 7 = 0 then null "
        "else 'c' || cast((l_partkey + l_linenumber % 2) % 5 as string) end as predicted",
        "case when l_suppkey % 3 = 0 or l_suppkey % 7 = 0 then null "
        "when l_linenumber % 3 = 0 then 'OK' when l_linenumber % 3 = 1 then 'INCORRETO' "
        "else 'INCONCLUSIVO' end as verdict",
        "l_shipdate", "l_linenumber", "l_extendedprice",
    )
    return merge.keyed_merge(rows, ["l_shipdate", "l_linenumber", "l_extendedprice"], AS_OF)


def given_inference(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, known = inference_input(spark, sf_dir)
    return infer(rows, known, lambda scored, kept: given_predictions(scored), AS_OF)


@query
def inference_job(spark, sf_dir):
    return given_inference(spark, sf_dir)


@query
def result_distribution(spark, sf_dir):
    return merge.result_distribution(given_inference(spark, sf_dir))


@query
def ensemble_pick(spark, sf_dir):
    rows = commitments(spark, sf_dir, S.ID, S.CODE, "order_key", "customer_key")
    above = F.array(*[F.expr(f"cast((customer_key * {k}) % 97 as double) / 97") for k in (1, 3, 5)])
    below = F.array(*[F.expr(f"cast((order_key * {k}) % 89 as double) / 89") for k in (1, 7)])
    return rows.select(S.ID, merge.ensemble_pick(
        F.col(S.CODE), F.expr(standin.PREDICTED_SQL), above, below).alias("picked"))


# --- derived features and encodings --------------------------------------------------------


@query
def month_feature(spark, sf_dir):
    rows = commitments(spark, sf_dir, S.ID, S.PERIOD)
    return rows.select(S.ID, derive.month_of(F.col(S.PERIOD)).alias("mes"))


@query
def month_from_serial(spark, sf_dir):
    rows = commitments(spark, sf_dir, S.ID, "order_date")
    serial = F.datediff("order_date", F.to_date(F.lit(derive.SERIAL_EPOCH)))
    return rows.select(S.ID, derive.month_of(serial.cast("string")).alias("mes"))


@query
def flags(spark, sf_dir):
    rows = commitments(spark, sf_dir, S.ID, S.CPF, S.ORGAN, S.SUCCESSOR)
    return rows.select(
        S.ID, derive.legal_person(F.col(S.CPF)).cast("int").alias("pessoa_juridica"),
        derive.succeeded_organ(F.col(S.ORGAN), F.col(S.SUCCESSOR)).cast("int")
        .alias("orgao_sucedido"))


@query
def action_program(spark, sf_dir):
    rows = commitments(spark, sf_dir, S.ID, "acao", "programa")
    return rows.select(
        S.ID, derive.action_program(F.col("acao"), F.col("programa")).alias("acao_programa"))


@query
def prepared_features(spark, sf_dir):
    rows = commitments(spark, sf_dir)
    derived = derive.derive_features(rows, S.CODE_CATEGORIES, [S.ID])
    return derived.withColumns({
        name: F.col(name).cast("int") for name in ("pessoa_juridica", "orgao_sucedido")})


def split_rows(spark: SparkSession, sf_dir: str, *more: str) -> DataFrame:
    rows = commitments(spark, sf_dir, S.ID, S.CODE, *more)
    return sampling.stratified_split(rows, S.CODE, S.ID, 30)


@query
def process_count_fit(spark, sf_dir):
    return encode.fit_process_counts(split_rows(spark, sf_dir, S.PROCESS).where("not is_test"))


@query
def process_count_apply(spark, sf_dir):
    rows = split_rows(spark, sf_dir, S.PROCESS)
    counts = encode.fit_process_counts(rows.where("not is_test"))
    return encode.apply_process_counts(rows.where("is_test"), counts).select(
        S.ID, S.PROCESS, encode.PROCESS_COUNT)


@query
def minmax_fit(spark, sf_dir):
    return encode.fit_ranges(commitments(spark, sf_dir, *S.AMOUNTS), S.AMOUNTS)


@query
def minmax_apply(spark, sf_dir):
    rows = commitments(spark, sf_dir, S.ID, S.YEAR, *S.AMOUNTS)
    ranges = encode.fit_ranges(rows.where(F.col(S.YEAR) < 2000), S.AMOUNTS)
    return rows.select(S.ID, *[
        F.round(value, 6).alias(name) for name, value in encode.scaled(ranges, S.AMOUNTS).items()])


def category_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    needed = [c for c in S.CODE_CATEGORIES if c != S.PROCESS]
    return derive.derive_features(
        commitments(spark, sf_dir, S.ID, S.YEAR, *needed, S.HISTORY, *S.AMOUNTS),
        needed, [S.ID, S.YEAR])


CATEGORIES = derive.derived_categories(S.CODE_CATEGORIES)


@query
def category_vocab(spark, sf_dir):
    return encode.fit_vocabulary(category_rows(spark, sf_dir), CATEGORIES)


@query
def onehot_long(spark, sf_dir):
    rows = category_rows(spark, sf_dir)
    vocabulary = encode.fit_vocabulary(rows.where(F.col(S.YEAR) < 1997), CATEGORIES)
    return encode.one_hot_positions(rows, vocabulary, CATEGORIES)


# --- text ----------------------------------------------------------------------------------


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan.spread(read(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id")


@query
def punctuation(spark, sf_dir):
    return documents(spark, sf_dir).select(
        "doc_id", text.punctuation_to_space(F.col("text")).alias("plain"))


@query
def clean_text(spark, sf_dir):
    return documents(spark, sf_dir).select(
        "doc_id", text.clean_text(F.col("text")).alias("clean"))


def kept_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents(spark, sf_dir).select("doc_id", text.drop_stopwords(
        text.clean_text(F.col("text")), text.stopwords(spark)).alias("kept"))


@query
def stopword_filter(spark, sf_dir):
    return kept_words(spark, sf_dir).select("doc_id", F.array_join("kept", " ").alias("kept"))


@query
def stem_dictionary(spark, sf_dir):
    """Stem of every distinct word: distinct first, so each word is stemmed once."""
    found = kept_words(spark, sf_dir).select(F.explode(F.array_distinct("kept")).alias("word"))
    return found.distinct().select("word", stem(F.col("word")).alias("stem"))


def counted_terms(spark: SparkSession, sf_dir: str, stems: bool) -> DataFrame:
    if stems:
        rows = documents(spark, sf_dir).select(
            "doc_id", text.bag_terms(F.col("text"), text.stopwords(spark)).alias("terms"))
    else:
        rows = kept_words(spark, sf_dir).select("doc_id", text.index_terms("kept").alias("terms"))
    return staged(encode.text_terms(rows, "doc_id", F.col("terms")), "terms")


@query
def document_frequency(spark, sf_dir):
    return encode.document_frequencies(counted_terms(spark, sf_dir, stems=False))


def weights(spark: SparkSession, sf_dir: str, stems: bool) -> DataFrame:
    counted = counted_terms(spark, sf_dir, stems)
    total = read(spark, sf_dir, "documents").count()
    found = encode.term_weights(counted, encode.document_frequencies(counted), total, "doc_id")
    return found.select("doc_id", "term", F.round("weight", 6).alias("weight"))


@query
def tfidf_long(spark, sf_dir):
    return weights(spark, sf_dir, stems=False)


@query
def tfidf_stemmed(spark, sf_dir):
    return weights(spark, sf_dir, stems=True)


# --- splits and labels ---------------------------------------------------------------------


@query
def stratified_quota(spark, sf_dir):
    sizes = scope.class_frequencies(commitments(spark, sf_dir, S.CODE))
    return sampling.quotas(sizes, S.CODE, 30)


@query
def stratified_split(spark, sf_dir):
    return split_rows(spark, sf_dir)


@query
def stratified_folds(spark, sf_dir):
    return sampling.stratified_folds(commitments(spark, sf_dir, S.ID, S.CODE), S.CODE, S.ID, 3)


@query
def label_encode(spark, sf_dir):
    rows = commitments(spark, sf_dir, S.ID, S.CODE)
    codes = staged(sampling.label_codes(rows, S.CODE), "label-codes")
    return sampling.encode_labels(rows, S.CODE, codes).select(S.ID, S.CODE, "code")


@query
def label_decode(spark, sf_dir):
    """Codes of a prediction turned back into labels."""
    rows = predictions(spark, sf_dir)
    codes = staged(sampling.label_codes(rows, "predicted"), "label-codes")
    numbers = sampling.encode_labels(rows, "predicted", codes).select(S.ID, "code")
    return sampling.decode_labels(numbers, "code", codes).select(
        S.ID, F.col("code").alias("label"))


# --- reports -------------------------------------------------------------------------------


def predictions(spark: SparkSession, sf_dir: str, *more: str) -> DataFrame:
    return given_predictions(
        commitments(spark, sf_dir, S.ID, S.CODE, "order_key", "customer_key", *more))


def judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staged(
        given_predictions(validated(spark, sf_dir, S.ID, S.CODE, "order_key", "customer_key")),
        "judged")


def rounded(df: DataFrame) -> DataFrame:
    return df.select(*[
        F.round(F.col(f"`{f.name}`"), 6).alias(f.name) if f.dataType.typeName() == "double"
        else F.col(f"`{f.name}`") for f in df.schema.fields])


@query
def class_report(spark, sf_dir):
    return rounded(report.class_report(predictions(spark, sf_dir), S.CODE, "predicted"))


@query
def special_report(spark, sf_dir):
    rows = staged(predictions(spark, sf_dir), "predictions")
    held_out = sampling.stratified_split(rows, S.CODE, S.ID, 30).where("is_test")
    return rounded(report.special_report(held_out, S.CODE, "predicted", rows))


@query
def report_by_verdict(spark, sf_dir):
    return rounded(evaluate(judged(spark, sf_dir)))


@query
def evaluation_job(spark, sf_dir):
    rows = sampling.stratified_split(judged(spark, sf_dir), S.VERDICT, S.ID, 20).where("is_test")
    codes = evaluate(rows).withColumnRenamed(S.VERDICT, "slice")
    verdicts = report.class_report(rows, S.VERDICT, "verdict").withColumn(
        "slice", F.lit("correctness"))
    return rounded(codes.unionByName(verdicts))


@query
def macro_micro_f1(spark, sf_dir):
    return rounded(report.scores(predictions(spark, sf_dir), S.CODE, "predicted"))


@query
def best_candidate(spark, sf_dir):
    """Priority classes play the candidates of an organ's model search."""
    rows = predictions(spark, sf_dir, S.ORGAN, "formalidade_nome").withColumn(
        "hit", (F.col(S.CODE) == F.col("predicted")).cast("int"))
    table = rows.groupBy(S.ORGAN, F.col("formalidade_nome").alias("candidate")).agg(
        F.round(F.avg("hit"), 2).alias("accuracy"),
    ).withColumn("ord", F.left("candidate", F.lit(1)).cast("int"))
    return report.best_candidate(table, [S.ORGAN])


# --- sources and sinks ---------------------------------------------------------------------


@query
def csv_scan(spark, sf_dir):
    """Display names in another order, and a column the schema does not have."""
    rows = commitments(spark, sf_dir).toDF(*S.SOURCE_HEADERS)
    shuffled = rows.select(F.lit("x").alias("Outra"), *[
        F.col(f"`{name}`") for name in reversed(S.SOURCE_HEADERS)])
    path = sinks.write_csv(shuffled, staging_path(spark, "csv"), compression="gzip")
    return scan.read_csv(spark, path)


@query
def side_table_scan(spark, sf_dir):
    path = staging_path(spark, "side")
    standin.expired_codes(spark, sf_dir).toDF("Nat Despesa").write.parquet(path)
    return scan.read_table(spark, path)


@query
def scope_store(spark, sf_dir):
    store = StateStore(spark, staging_path(spark, "store"))
    store.save_scope(scope.scope_map(profile_of(coded(spark, sf_dir), spark, sf_dir)))
    return store.load_scope()


@query
def report_sink(spark, sf_dir):
    path = sinks.write_csv(
        rounded(report.class_report(predictions(spark, sf_dir), S.CODE, "predicted")),
        staging_path(spark, "report"))
    columns = "label string, precision double, recall double, `f1-score` double, support double"
    return spark.read.schema(columns).csv(path, header=True, escape='"')


@query
def results_sink(spark, sf_dir):
    return sinks.write_results(
        given_inference(spark, sf_dir), staging_path(spark, "output"), sinks.run_name(AS_OF), AS_OF)


@query
def json_sink(spark, sf_dir):
    path = sinks.write_json(coded(spark, sf_dir), staging_path(spark, "json"))
    return spark.read.schema(f"{S.ID} string, {S.CODE} string, {S.BALANCE} double").json(path)


# --- models --------------------------------------------------------------------------------


def section_rows(spark: SparkSession, sf_dir: str, section: str, algorithm_text: str) -> DataFrame:
    rows = commitments(spark, sf_dir)
    cleaned = scope.cleaned_rows(rows, profile_of(coded(spark, sf_dir), spark, sf_dir))
    return prepare(cleaned.where(F.col("section") == section), S.CODE_CATEGORIES,
                   [S.ID, S.CODE], algorithm_text)


def cell_sums(rows: DataFrame, cells: DataFrame, *by: str) -> DataFrame:
    """Cells of each row and block: how many, the sum of their values, and of value * position."""
    sums = cells.groupBy(ROW, *by).agg(
        F.count("*").alias("n"), F.sum("value").alias("total"),
        F.sum(F.col("value") * F.col("position")).alias("weighted"))
    return rounded(rows.select(ROW, S.ID).join(sums, ROW).drop(ROW))


def encoded(spark: SparkSession, sf_dir: str, categories: list[str]) -> DataFrame:
    """What the classifiers' own encoder makes of all commitments."""
    rows = prepare(commitments(spark, sf_dir), categories, [S.ID], "hashed")
    return cell_sums(rows, fit_encoder(rows, categories, "hashed").cells(rows), "block")


@query
def encoded_code(spark, sf_dir):
    return encoded(spark, sf_dir, S.CODE_CATEGORIES)


@query
def anomaly_features(spark, sf_dir):
    return encoded(spark, sf_dir, S.ANOMALY_CATEGORIES)


@query
def dense_text(spark, sf_dir):
    rows = prepare(commitments(spark, sf_dir), S.CODE_CATEGORIES, [S.ID], "dense")
    return cell_sums(rows, text_encoder(rows, "dense", TextOptions()).cells(rows))


def all_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents(spark, sf_dir).select(
        "doc_id", text.words(text.clean_text(F.col("text"))).alias("words"))


@query
def word_association(spark, sf_dir):
    """Of every word: with how many others it stands together more often than by chance, how often,
    and the sum of their positive pointwise mutual information."""
    found = association_sums(all_words(spark, sf_dir), "words", TextOptions().window)
    return found.select("word", "partners", "n", F.round("association", 4).alias("association"))


@query
def word_vectors(spark, sf_dir):
    """The length of every word's vector, and what the vectors explain of the association table."""
    model = WordVectors.fit(all_words(spark, sf_dir), "words", SMALL_TEXT.vector_size)
    share = model.values.agg(F.max("share")).first()[0]
    return model.vectors().select("term", F.sqrt(F.aggregate(
        "vector", F.lit(0.0), lambda a, x: a + x * x)).alias("length"), F.lit(share).alias("share"))


@query
def rf_code(spark, sf_dir):
    return train_code_classifier(section_rows(spark, sf_dir, "above", "tfidf"), "rf", FULL).report


@query
def svm_code(spark, sf_dir):
    return train_code_classifier(section_rows(spark, sf_dir, "above", "tfidf"), "svm", FULL).report


@query
def dense_rf(spark, sf_dir):
    rows = section_rows(spark, sf_dir, "above", "vectors")
    return train_code_classifier(rows, "dense_rf", FULL).report


@query
def dense_linear(spark, sf_dir):
    rows = sampling.stratified_split(
        section_rows(spark, sf_dir, "above", "vectors"), S.CODE, S.ID, 30)
    _, pairs, _ = fit_dense_linear(
        rows.where("not is_test"), rows.where("is_test"), S.CODE, FULL)
    return report.class_report(pairs, S.CODE, "predicted")


@query
def rf_correctness(spark, sf_dir):
    rows = prepare(validated(spark, sf_dir), S.VERDICT_CATEGORIES, [S.ID, S.VERDICT], "tfidf")
    return train_correctness(rows, SMALL).report


@query
def training_job(spark, sf_dir):
    """One training run, from cleaning to stored models; the reports of its classifiers."""
    store = StateStore(spark, staging_path(spark, "trained"))
    expired = staged(standin.expired_codes(spark, sf_dir), "expired")
    reports = jobs.training_job(
        commitments(spark, sf_dir), expired, validated(spark, sf_dir), store,
        algorithm="rf", floor=FLOOR, options=SMALL)
    return reduce(DataFrame.unionByName, [
        reports[name].select(F.lit(name).alias("model"), "label",
                             *[F.col(f"`{metric}`") for metric in report.METRICS])
        for name in ("above", "below", "correctness") if name in reports])
