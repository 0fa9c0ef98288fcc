import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerlens import schema as S
from ledgerlens.operators import filters
from ledgerlens.sources import scan, sinks, staging
from ledgerlens.sources.state import StateStore

DAY = dt.date(2020, 3, 1)


def commitment(spark, **values):
    schema = S.commitment_schema()
    row = [values.get(field.name) for field in schema.fields]
    return spark.createDataFrame([row], schema)


def test_schema_has_the_source_columns():
    fields = S.commitment_schema().fields
    assert len(fields) == 44 and len({f.name for f in fields}) == 44
    assert sum(f.dataType.typeName() == "double" for f in fields) == 18
    for columns in S.COLUMN_SETS.values():
        assert set(columns) <= {f.name for f in fields}
    assert [len(c) for c in (S.CODE_CATEGORIES, S.VERDICT_CATEGORIES, S.ANOMALY_CATEGORIES,
                             S.AMOUNTS)] == [15, 16, 20, 16]


def test_csv_keeps_quotes_and_line_breaks(spark, tmp_path):
    text = 'linha 1\nlinha "2", fim \\ ok'
    rows = commitment(spark, **{S.ID: "1", S.HISTORY: text, S.BALANCE: 1.5, S.YEAR: 2020})
    path = sinks.write_csv(rows, str(tmp_path / "c.csv"))
    back = scan.load_commitments(spark, path=path).first()
    assert (back[S.ID], back[S.HISTORY], back[S.BALANCE], back[S.YEAR]) == ("1", text, 1.5, 2020)


def test_csv_columns_are_found_by_name(spark, tmp_path):
    rows = commitment(spark, **{S.ORGAN: "o", S.CODE: "3.1.90.30.01", S.YEAR: 2020, S.ID: "7"})
    shown = rows.toDF(*S.SOURCE_HEADERS).select(
        "`Natureza Despesa (Cod)`", *[f"`{h}`" for h in reversed(S.SOURCE_HEADERS)
                                      if h != "Natureza Despesa (Cod)"])
    shown = shown.withColumn("Nova", F.lit("x"))
    back = scan.read_csv(spark, sinks.write_csv(shown, str(tmp_path / "a.csv")))
    assert back.columns == rows.columns and back.collect() == rows.collect()
    with pytest.raises(scan.MissingColumns):
        scan.read_csv(spark, sinks.write_csv(rows.drop(S.ORGAN), str(tmp_path / "b.csv")))


def test_parquet_input_gets_normalised_names(spark, tmp_path):
    path = str(tmp_path / "p")
    spark.createDataFrame([("x", "1")], "`Órgão (Código/Nome)` string, `Valor Empenhado` string"
                          ).write.parquet(path)
    assert scan.load_commitments(spark, path=path).columns == ["orgao", "valor_empenhado"]


def test_side_table_from_csv(spark, tmp_path):
    path = tmp_path / "expired.csv"
    path.write_text("Nat Despesa,Obs\n3.1.90.30.01,x\n", encoding="utf-8")
    assert scan.read_table(spark, str(path)).first().nat_despesa == "3.1.90.30.01"


def test_empty_input_is_an_error(spark):
    with pytest.raises(scan.EmptyInput):
        scan.require_rows(spark.range(0))
    with pytest.raises(ValueError):
        scan.load_commitments(spark)


def test_jdbc_options_split_the_scan_by_year():
    options = scan.jdbc_options("jdbc:x", "spending", user="u", years=(2015, 2024), partitions=10)
    assert options["partitionColumn"] == '"Exercício do orçamento (Ano)"'
    assert (options["lowerBound"], options["upperBound"], options["numPartitions"]) == (
        "2015", "2025", "10")
    assert "password" not in options and options["dbtable"] == "spending"


@pytest.mark.parametrize("training, filters_given, kept", [
    (True, {}, ["b", "c"]), (False, {}, ["c"]), (True, {"orgaos": ["X"]}, []),
    (False, {"daterange": (dt.date(2020, 2, 29), dt.date(2014, 1, 1))}, ["a", "c"]),
])
def test_source_choice(spark, monkeypatch, training, filters_given, kept):
    rows = spark.createDataFrame(
        [("a", 2014, "2014/01/01", "X"), ("b", 2015, "2020/03/05", "X"),
         ("c", 2020, "2020/02/29", "Y")],
        f"{S.ID} string, {S.YEAR} int, periodo string, orgao string")
    monkeypatch.setattr(scan, "read_jdbc", lambda *_: rows)

    def load():
        return scan.load_commitments(spark, jdbc={}, training=training, as_of=DAY, **filters_given)

    if kept:
        assert sorted(r[S.ID] for r in load().collect()) == kept
    else:
        with pytest.raises(scan.EmptyInput):
            load()


def test_run_names():
    assert sinks.run_name(DAY) == "inference01-03-2020"
    assert sinks.run_name(DAY, daterange=(DAY, DAY)) == "inference01-03-2020_DR01-03-2020-01-03-2020"
    assert sinks.run_name(DAY, dates=[DAY], orgaos=["A/B", "C"]) == (
        "inference01-03-2020_D01-03-2020_OAB-C")


def test_results_are_written_twice_and_read_back(spark, tmp_path):
    rows = spark.createDataFrame([("1", "a", "b", "OK", "01/03/2020", "INCV_M1")],
                                 [*S.RESULT_COLUMNS])
    written = sinks.write_results(rows, str(tmp_path), "run", DAY)
    assert written.columns == S.RESULT_COLUMNS and written.collect() == rows.collect()
    as_csv = spark.read.csv(str(tmp_path / "results-csv/run"), header=True)
    assert as_csv.columns == S.RESULT_COLUMNS and as_csv.count() == 1
    assert (tmp_path / "results/run/run_date=2020-03-01").exists()


def test_a_failed_sink_raises(spark, tmp_path):
    rows = spark.createDataFrame([("1",)], "x string")
    (tmp_path / "file").write_text("in the way")
    with pytest.raises(Exception):
        sinks.write_csv(rows, str(tmp_path / "file" / "below"))


def test_json_sink(spark, tmp_path):
    path = sinks.write_json(spark.range(3), str(tmp_path / "j"))
    assert spark.read.json(path).count() == 3


def test_sections_do_not_share_state(spark, tmp_path):
    store = StateStore(spark, str(tmp_path))
    store.save_table(spark.range(1), "above", "process_counts")
    store.save_table(spark.range(2), "below", "process_counts")
    assert store.load_table("above", "process_counts").count() == 1


def test_staging_uses_the_configured_folder(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    table = staging.staged(spark.range(5), "unit")
    assert table.count() == 5
    root = configured or spark.sparkContext.getCheckpointDir()
    assert table.inputFiles()[0].removeprefix("file://").startswith(root.removeprefix("file:"))


def test_csv_filters_are_pushed_to_parquet(spark, tmp_path):
    path = str(tmp_path / "p")
    commitment(spark, **{S.ID: "1", S.PERIOD: "2020/02/29"}).write.parquet(path)
    rows = scan.load_commitments(spark, path=path).where(
        filters.on_previous_day(DAY)).select(S.ID)
    plan = rows._jdf.queryExecution().toString()
    assert "EqualTo(periodo,2020/02/29)" in plan
    assert f"ReadSchema: struct<periodo:string,{S.ID}:string>" in plan
    assert rows.count() == 1


def test_readers_see_whole_versions_only(spark, tmp_path):
    store = StateStore(spark, str(tmp_path))
    one = store.begin()
    one.save_table(spark.range(1), "above", "ranges")
    one.publish()
    reader = store.current()
    two = store.begin()
    two.save_table(spark.range(2), "above", "ranges")  # stopped here, or still at work
    assert store.load_table("above", "ranges").count() == 1
    two.save_table(spark.range(3), "above", "vocabulary")
    two.publish()
    assert store.load_table("above", "ranges").count() == 2
    assert reader.load_table("above", "ranges").count() == 1  # a job keeps what it began with
    with pytest.raises(ValueError, match="begin"):
        store.save_table(spark.range(1), "above", "ranges")
    with pytest.raises(ValueError, match="begun"):
        store.publish()


def test_commitments_meet_their_texts_last(spark, sf_dir):
    from ledgerlens.plans.standin import commitments
    plan = commitments(spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join" in line]
    # the uppermost join is that with the documents: none above it shuffles a text for each row
    assert len(joins) > 3 and "doc_id" in joins[0]
    assert not any("doc_id" in line for line in joins[1:])


def test_csv_scan_writes_compressed_files(spark, sf_dir):
    from ledgerlens.plans.catalog import QUERIES
    found = QUERIES["csv_scan"](spark, sf_dir)
    files = found.inputFiles()
    assert files and all(name.endswith(".csv.gz") for name in files)
    assert found.count() == spark.read.parquet(f"{sf_dir}/orders.parquet").count()
