"""Order of arrival: the last row wins however files are split and packed."""

import datetime as dt

import pytest

from ledgerlens import schema as S
from ledgerlens.plans import jobs
from ledgerlens.sources import scan

AS_OF = dt.date(2001, 1, 1)
ROW = f"{S.ID} string, {S.CODE} string, {S.BALANCE} double, predicted string, verdict string, n long"


def write(spark, folder, kind, sizes):
    """One file for each size, in name order; every file repeats identifiers 0 to 9, and the last
    row of an identifier is in the last file that has it."""
    last, n = {}, 0
    for at, size in enumerate(sizes):
        rows = []
        for i in range(size):
            n += 1
            code = "AB"[(n * 7 // 3) % 2]
            rows.append((str(i % 10), code, 1.0, code, ("OK", "INCORRETO")[n % 2], n))
            last[str(i % 10)] = rows[-1]
        part = spark.createDataFrame(rows, ROW).coalesce(1)
        if kind == "csv":
            (folder / f"{at}.csv").write_text("\n".join(
                [",".join(part.columns), *(",".join(map(str, r)) for r in rows)]) + "\n")
        else:
            part.write.parquet(str(folder / f"{kind}-{at}"))
            written = next((folder / f"{kind}-{at}").glob("part-*"))
            written.rename(folder / f"{at}.parquet")
    return last


def read(spark, folder, kind):
    pattern = str(folder / f"*.{kind}")
    if kind == "csv":
        return spark.read.schema(ROW).csv(pattern, header=True)
    return spark.read.schema(ROW).parquet(pattern)


@pytest.mark.parametrize("kind", ["parquet", "csv"])
@pytest.mark.parametrize("split", ["128m", "4k", "512"])
@pytest.mark.parametrize("sizes", [(20, 4000), (4000, 20), (10, 900, 30, 2500, 12)])
def test_last_row_wins(spark, tmp_path, kind, split, sizes):
    last = write(spark, tmp_path, kind, sizes)
    scope = spark.createDataFrame([("A", "Em escopo"), ("B", "Em escopo")],
                                  "natureza string, status string")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", "16")
    try:
        found = jobs.infer(read(spark, tmp_path, kind).where("n > 0"), scope,
                           lambda df, kept: df, AS_OF).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert {r["Identificador"]: (r["Natureza Real"], r["Natureza Predita"], r["Corretude"])
            for r in found} == {i: (r[1], r[3], r[4]) for i, r in last.items()}


def test_rows_of_no_file_are_in_the_order_of_their_tasks(spark):
    rows = spark.createDataFrame([(i,) for i in range(30)], "n long").repartition(1).sortWithinPartitions("n")
    found = rows.select("n", scan.arrival(rows).alias("a")).orderBy("a").collect()
    assert [r.n for r in found] == list(range(30))


@pytest.mark.parametrize("name", ["c.csv", "c.parquet"])
def test_named_dates_select_rows_of_a_file(spark, tmp_path, name):
    schema = S.commitment_schema()
    rows = spark.createDataFrame([
        tuple(day if f.name == S.PERIOD else None for f in schema.fields)
        for day in ("2001/01/01", "2001/01/02", "2001/01/02", "2001/02/01")], schema).coalesce(1)
    path = str(tmp_path / name)
    getattr(rows.write, name.split(".")[1])(path, **({"header": True} if "csv" in name else {}))
    whole = scan.load_commitments(spark, path=path)
    assert whole.count() == 4
    some = scan.load_commitments(spark, path=path, dates=[dt.date(2001, 1, 2)])
    assert [r[0] for r in some.select(S.PERIOD).collect()] == ["2001/01/02"] * 2
