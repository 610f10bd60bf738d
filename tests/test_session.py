from types import SimpleNamespace

import pytest

from blockrisk.operators.spatial import PolygonCover
from blockrisk.session import shared_folder, spread


def session(master, **conf):
    return SimpleNamespace(sparkContext=SimpleNamespace(master=master), conf=SimpleNamespace(get=lambda key, default=None: conf.get(key.split(".")[1], default)))


def test_scratch_folder_is_shared():
    assert shared_folder(session("spark://a:1", checkpoint="hdfs://x/c", sql="file:/w")) == "hdfs://x/c"
    assert shared_folder(session("local[4]", sql="file:/w/")) == "file:/w/_scratch"
    assert shared_folder(session("yarn", sql="hdfs://x/w")) == "hdfs://x/w/_scratch"
    for warehouse in ("file:/w", "/w"):
        with pytest.raises(ValueError):
            shared_folder(session("yarn", sql=warehouse))


def test_rows_of_one_task_are_spread(spark):
    sizes = spread(spark.range(2_000_000, numPartitions=1), "id").rdd.glom().map(len).collect()
    assert sum(sizes) == 2_000_000 and max(sizes) < 2_000_000


def test_covers_of_one_file_are_cut_by_many_tasks(spark):
    ring = "array(array(struct(double(id) AS x, 0D AS y), struct(id + 1D AS x, 0D AS y), struct(id + 1D AS x, 1D AS y)))"
    shapes = spark.range(100_000, numPartitions=1).selectExpr("string(id) AS GISJOIN", f"{ring} AS rings")
    cover = PolygonCover.build(shapes).rows
    assert cover.rdd.getNumPartitions() > 1 and cover.select("GISJOIN").distinct().count() == 100_000
