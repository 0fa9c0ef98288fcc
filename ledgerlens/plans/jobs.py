"""The three jobs: training, inference and evaluation."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens import schema as S
from ledgerlens.operators.merge import ensemble_pick, keyed_merge, result_distribution
from ledgerlens.operators.report import class_report, special_report
from ledgerlens.operators.sampling import sample_rows, stratified_split
from ledgerlens.operators.scope import (
    POPULATION_FLOOR, cleaned_rows, cleaning_funnel, code_profile, scope_map, with_scope,
)
from ledgerlens.plans.features import prepare
from ledgerlens.plans.models import (
    ALGORITHMS, Classifier, ModelOptions, fit_classifier, fit_dense_linear,
)
from ledgerlens.operators.filters import slice_condition
from ledgerlens.sources.scan import arrival, load_commitments, require_rows
from ledgerlens.sources.sinks import run_name, write_csv, write_results
from ledgerlens.sources.staging import staged
from ledgerlens.sources.state import StateStore

CODE_HOLDOUT = 30
VERDICT_HOLDOUT = 20
SECTIONS = ("above", "below")
SCORING_CATEGORIES = [*S.CODE_CATEGORIES, "grupo_despesa", S.CODE]

#: Commitments, or where to read them: the arguments ``path`` or ``jdbc`` of load_commitments.
Source = DataFrame | Mapping

# Takes commitments and the names of columns to keep, gives them with ``predicted``, ``verdict``.
Scorer = Callable[[DataFrame, list[str]], DataFrame]


@dataclass
class Trained:
    classifier: Classifier
    pairs: DataFrame
    report: DataFrame


def train_code_classifier(
    prepared: DataFrame, algorithm: str, options: ModelOptions = ModelOptions()
) -> Trained:
    """Fit on 70 % of a section's prepared rows; the special report covers the other 30 %."""
    rows = stratified_split(prepared, S.CODE, S.ID, CODE_HOLDOUT, options.seed)
    model = fit_classifier(rows.where("not is_test"), S.CODE, S.CODE_CATEGORIES, algorithm, options)
    pairs = staged(model.score(rows.where("is_test"), "m").select(
        S.ID, S.CODE, F.col("m_label").alias("predicted")), "pairs")
    return Trained(model, pairs, special_report(pairs, S.CODE, "predicted", prepared))


def train_correctness(
    prepared: DataFrame, options: ModelOptions = ModelOptions()
) -> Trained:
    rows = stratified_split(prepared, S.VERDICT, S.ID, VERDICT_HOLDOUT, options.seed)
    model = fit_classifier(rows.where("not is_test"), S.VERDICT, S.VERDICT_CATEGORIES, "rf",
                           options, trees=options.correctness_trees)
    pairs = staged(model.score(rows.where("is_test"), "m").select(
        S.ID, S.VERDICT, F.col("m_label").alias("predicted")), "pairs")
    return Trained(model, pairs, class_report(pairs, S.VERDICT, "predicted"))


def read_source(
    source: Source, store: StateStore, as_of: dt.date | None, training: bool, filters: dict,
) -> DataFrame:
    """Input rows of a job. Given rows are filtered as named and else taken whole; a path or a
    database goes through load_commitments. No rows are an error."""
    if not isinstance(source, DataFrame):
        return require_rows(load_commitments(
            store.spark, training=training, as_of=as_of, **source, **filters))
    if any(filters.values()):
        source = source.where(slice_condition(as_of or dt.date.today(), **filters))
    return require_rows(source)


def training_job(
    source: Source, expired: DataFrame, validated: DataFrame, store: StateStore,
    algorithm: str = "dense_rf", floor: int = POPULATION_FLOOR, sample: int | None = None,
    options: ModelOptions = ModelOptions(), as_of: dt.date | None = None, **filters,
) -> dict[str, DataFrame]:
    """Read and clean commitments, fit both code classifiers and the correctness classifier, store
    state and reports. With dense texts, a linear head on the text alone is fitted, reported and
    stored first, with the history of its candidates. The state is a version of the store that is
    published when all of it is written; a run that fails leaves the last one in place."""
    store = store.begin()
    commitments = read_source(source, store, as_of, True, filters)
    rows = sample_rows(commitments, sample, S.ID, options.seed) if sample else commitments
    profile = code_profile(rows, expired, floor)
    store.save_scope(scope_map(profile))
    cleaned = cleaned_rows(rows, profile)
    prepared = prepare(cleaned, S.CODE_CATEGORIES, [S.ID, S.CODE, "section"],
                       ALGORITHMS[algorithm])
    reports = {"funnel": cleaning_funnel(profile)}
    for section in SECTIONS:
        part = prepared.where(F.col("section") == section)
        if part.isEmpty():
            continue
        if ALGORITHMS[algorithm] == "vectors":
            sides = stratified_split(part, S.CODE, S.ID, CODE_HOLDOUT, options.seed)
            head, pairs, history = fit_dense_linear(
                sides.where("not is_test"), sides.where("is_test"), S.CODE, options)
            head.save(store, f"{section}_text")
            reports[f"{section}_text"] = special_report(pairs, S.CODE, "predicted", part)
            reports[f"{section}_text_history"] = history
        trained = train_code_classifier(part, algorithm, options)
        trained.classifier.save(store, section)
        reports[section] = trained.report
    store.save_table(store.spark.createDataFrame(
        [(s,) for s in SECTIONS if s in reports], "section string"), "all", "sections")
    judged = prepare(validated, S.VERDICT_CATEGORIES, [S.ID, S.VERDICT], ALGORITHMS["rf"])
    trained = train_correctness(judged, options)
    trained.classifier.save(store, "correctness")
    reports["correctness"] = trained.report
    store.publish()
    for name, report in reports.items():
        write_csv(report, f"{store.root}/reports/{name}")
    return reports


@dataclass
class Models:
    """Stored classifiers of a training run."""

    codes: dict[str, Classifier]  # by section; a section without classes has none
    correctness: Classifier
    algorithm: str

    @classmethod
    def load(cls, store: StateStore, algorithm: str) -> Models:
        store = store.current()
        stored = {r["section"] for r in store.load_table("all", "sections").collect()}
        codes = {section: Classifier.load(store, section, S.CODE_CATEGORIES)
                 for section in SECTIONS if section in stored}
        return cls(codes, Classifier.load(store, "correctness", S.VERDICT_CATEGORIES), algorithm)

    def score(self, rows: DataFrame, extra: list[str]) -> DataFrame:
        """``rows`` (commitments) with ``predicted`` code and ``verdict``, and ``extra`` columns."""
        texts = "+".join(sorted({ALGORITHMS[self.algorithm], ALGORITHMS["rf"]}))
        scored = prepare(rows, SCORING_CATEGORIES, list(dict.fromkeys([S.ID, *extra])), texts)
        for section, classifier in self.codes.items():
            scored = classifier.score(scored, section)
        scored = self.correctness.score(scored, "verdict")
        if len(self.codes) == 2:
            predicted = ensemble_pick(
                F.col("above_label"), F.col("below_label"),
                F.col("above_probability"), F.col("below_probability"))
        else:
            predicted = F.col(f"{next(iter(self.codes))}_label")
        return scored.select(
            S.ID, S.CODE, *[c for c in extra if c not in (S.ID, S.CODE)],
            predicted.alias("predicted"), F.col("verdict_label").alias("verdict"))


def infer(
    commitments: DataFrame, scope: DataFrame, score: Scorer, as_of: dt.date,
    order: list[str] | None = None,
) -> DataFrame:
    """Result per identifier. Rows out of scope are not scored.

    The last row of an identifier wins, in order of arrival: files by name, then the place in the
    file, however the scan is split. ``order`` names columns that come before it. The noted rows are written out, so that both branches
    see one order, and a source is read once.
    """
    # Under names of their own, since scoring derives other columns from the period.
    place = {f"_place{at}": F.col(name) for at, name in enumerate(order or [])}
    place["_arrival"] = arrival(commitments)
    noted = staged(with_scope(commitments.withColumns(place), scope), "noted")
    kept = [S.ID, S.CODE, *place]
    notes = noted.where(F.col("scope_note").isNotNull()).select(*kept, "scope_note")
    in_scope = noted.where(F.col("scope_note").isNull()).drop("scope_note")
    scored = score(in_scope, list(place)).select(*kept, "predicted", "verdict")
    return keyed_merge(
        notes.unionByName(scored, allowMissingColumns=True), list(place), as_of)


def inference_job(
    source: Source, store: StateStore, output: str, as_of: dt.date,
    algorithm: str = "dense_rf", order: list[str] | None = None, **filters,
) -> tuple[DataFrame, DataFrame]:
    """Read and score commitments, write the results and return them with their distribution."""
    store = store.current()
    commitments = read_source(source, store, as_of, False, filters)
    models = Models.load(store, algorithm)
    results = infer(commitments, store.load_scope(), models.score, as_of, order)
    name = run_name(as_of, **filters)
    written = write_results(results, output, name, as_of)
    distribution = result_distribution(written)
    write_csv(distribution, f"{output}/distribution/{name}")
    return written, distribution


def evaluate(scored: DataFrame) -> DataFrame:
    """Code report per expert verdict, from rows scored once."""
    judged = scored.where(F.col(S.VERDICT).isin(S.VERDICTS))
    return class_report(judged, S.CODE, "predicted", [S.VERDICT])


def evaluation_job(
    validated: DataFrame, store: StateStore, output: str, algorithm: str = "dense_rf",
    seed: int = ModelOptions.seed,
) -> dict[str, DataFrame]:
    """Reports over all validated rows, and over the part the correctness model did not see."""
    models = Models.load(store.current(), algorithm)
    scored = staged(models.score(validated, [S.VERDICT]), "scored")
    held_out = stratified_split(
        scored, S.VERDICT, S.ID, VERDICT_HOLDOUT, seed).where("is_test")
    reports = {
        "all": evaluate(scored),
        "holdout": evaluate(held_out),
        "holdout_correctness": class_report(held_out, S.VERDICT, "verdict"),
    }
    for name, report in reports.items():
        write_csv(report, f"{output}/evaluation/{name}")
    return reports
