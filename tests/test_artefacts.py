import pytest
from pyspark.sql import functions as F

from blockrisk.plans import risk
from blockrisk.sources import artefacts as A
from tests.conftest import rows


@pytest.fixture
def place(tmp_path):
    return str(tmp_path / "inputs with blanks"), str(tmp_path / "table")


def add(spark, folder, data):
    spark.createDataFrame(data, "yr int, v long").coalesce(1).write.mode("append").parquet(folder)


def refreshed(spark, folder, path, loads, files=None):
    def load(names):
        loads.append(len(names))
        return spark.read.parquet(*names)

    names = [f.replace("%20", " ") for f in spark.read.parquet(folder).inputFiles()] if files is None else files
    return A.refresh(spark, path, names, load, lambda df: df.groupBy("yr").agg(F.sum("v").alias("v")), "yr")


def test_only_touched_years_are_rebuilt(spark, place):
    folder, path = place
    loads = []
    add(spark, folder, [(2000, 1), (2001, 2), (None, 9)])
    assert rows(refreshed(spark, folder, path, loads), "yr", "v") == [(2000, 1), (2001, 2)]
    before = {r["name"]: r["folder"] for r in A._latest(spark, path)[1] if r["kind"] == "part"}
    first = [f.replace("%20", " ") for f in spark.read.parquet(folder).inputFiles()]
    seen = len(loads)
    refreshed(spark, folder, path, loads)
    assert len(loads) == seen and A._latest(spark, path)[0] == 0  # nothing changed, nothing read
    add(spark, folder, [(2001, 10), (2002, 3)])
    assert rows(refreshed(spark, folder, path, loads), "yr", "v") == [(2000, 1), (2001, 12), (2002, 3)]
    after = {r["name"]: r["folder"] for r in A._latest(spark, path)[1] if r["kind"] == "part"}
    assert after["2000"] == before["2000"] and after["2001"] != before["2001"]
    # a file that went takes its rows along, and a year that nothing is left of
    assert rows(refreshed(spark, folder, path, loads, first), "yr", "v") == [(2000, 1), (2001, 2)]
    assert rows(A.read(spark, path), "yr", "v") == [(2000, 1), (2001, 2)]


def test_second_builder_takes_what_the_first_published(spark, place):
    folder, path = place
    add(spark, folder, [(2000, 1)])
    raced = []

    def load(names):
        if not raced:  # another builder publishes while this one is at work
            raced.append(True)
            refreshed(spark, folder, path, [])
        return spark.read.parquet(*names)

    names = [f.replace("%20", " ") for f in spark.read.parquet(folder).inputFiles()]
    table = A.refresh(spark, path, names, load, lambda df: df.groupBy("yr").agg(F.sum("v").alias("v")), "yr")
    assert rows(table, "yr", "v") == [(2000, 1)] and A._latest(spark, path)[0] == 0


def test_requests_without_rows(spark):
    requests = spark.createDataFrame([], "fire_type string, year int, lon double, lat double")
    blocks = spark.createDataFrame([], "GISJOIN string, rings array<array<struct<x:double,y:double>>>")
    assert risk.risk_of_requests(requests, risk.ModelRegistry("/nowhere"), blocks).count() == 0
    with pytest.raises(ValueError):
        risk.ModelRegistry("/nowhere").risk(spark, "forest", 2018)
