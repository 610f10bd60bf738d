from pyspark.sql import functions as F

from blockrisk.functions import geometry as G
from blockrisk.sources import files
from tests.conftest import rows
from tests.test_spatial import SHAPES, polygons


def test_csv_quotes_order_and_missing_columns(spark, tmp_path):
    path = tmp_path / "fires.csv"
    path.write_text('Extra,Location,Incident Date,Primary Situation\n1,"(37.7, -122.4)",2007-01-01,"111 ""big"", fire"\n2,,2007-01-02,\n')
    df = files.read_csv(spark, str(path), files.FIRE_SCHEMA)
    assert rows(df) == [("2007-01-01", "(37.7, -122.4)", '111 "big", fire'), ("2007-01-02", None, None)]
    try:
        files.read_csv(spark, str(path), files.CRIME_SCHEMA)
        raise AssertionError("columns are missing")
    except ValueError as error:
        assert "Category" in str(error)


def test_csv_latin_1(spark, tmp_path):
    path = tmp_path / "tracts.csv"
    path.write_bytes("GISJOIN,NAME,V\nt1,Cañada,1.5\nt2,x,bad\n".encode("latin-1"))
    df = files.read_csv(spark, str(path), "GISJOIN string, NAME string, V double", encoding="ISO-8859-1")
    assert rows(df) == [("t1", "Cañada", 1.5), ("t2", "x", None)]


def test_multi_line_csv(spark, tmp_path):
    path = tmp_path / "notes.csv"
    path.write_text('a,b\n"one\ntwo",1\n')
    assert rows(files.read_csv(spark, str(path), "a string, b int", multi_line=True)) == [("one\ntwo", 1)]


def test_polygon_forms_round_trip(spark, tmp_path):
    shapes = polygons(spark, SHAPES)
    files.write_geojson(shapes, str(tmp_path / "layer"), ["GISJOIN"])
    assert rows(files.read_geojson(spark, str(tmp_path / "layer"), "GISJOIN string")) == rows(shapes)
    files.write_csv(shapes.select("GISJOIN", G.text_from_rings(F.col("rings")).alias("geometry")), str(tmp_path / "text"))
    assert rows(files.read_polygon_text(spark, str(tmp_path / "text"))) == rows(shapes)
    files.write_polygons(shapes, str(tmp_path / "parquet"))
    assert rows(files.read_polygons(spark, str(tmp_path / "parquet"))) == rows(shapes)


def test_multipolygons(spark, tmp_path):
    text = "MULTIPOLYGON (((0 0, 1 0, 1 1, 0 0)), ((5 5, 6 5, 6 6, 5 5)))"
    df = spark.createDataFrame([(text,)], "t string").select(F.size(G.rings_from_text(F.col("t"))))
    assert df.first()[0] == 2
    path = tmp_path / "multi.json"
    path.write_text('{"type":"Feature","properties":{"k":"a"},"geometry":{"type":"MultiPolygon","coordinates":[[[[0,0],[1,0],[1,1],[0,0]]],[[[5,5],[6,5],[6,6],[5,5]]]]}}\n')
    assert files.read_geojson(spark, str(path), "k string").select(F.size("rings")).first()[0] == 2


def test_read_or_build_builds_once(spark, tmp_path):
    calls = []

    def build():
        calls.append(1)
        return spark.range(3)

    for _ in range(2):
        assert files.read_or_build(spark, str(tmp_path / "made"), build).count() == 3
    assert len(calls) == 1


def test_scoring_set_prunes_by_year(spark, tmp_path):
    df = spark.createDataFrame([("a", 2018), ("b", 2019)], "k string, target_year int")
    files.write_scoring_set(df, str(tmp_path / "scores"))
    one = files.read_scoring_set(spark, str(tmp_path / "scores"), 2019)
    assert rows(one, "k") == [("b",)]
    assert "PartitionFilters: [isnotnull(target_year" in one._jdf.queryExecution().toString()


def test_csv_with_line_breaks_is_split_within_a_file(spark, tmp_path):
    import random

    rng = random.Random(4)
    texts = ["plain", 'say "hi"', "two\nlines", '"\n"', "a,b\n\n,", "", None, "tail\n", '""', "é" * 30]
    data = [(k, rng.choice(texts), rng.choice(texts)) for k in range(400)]
    given = spark.createDataFrame(data, "k int, a string, b string")
    path = str(tmp_path / "broken")
    files.write_csv(given.coalesce(1), path)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    try:
        assert spark.read.text(path).rdd.getNumPartitions() > 3
        got = files.read_split_csv(spark, path, "b string, k int, a string")
        whole = files.read_csv(spark, path, "b string, k int, a string")
        assert rows(got) == rows(whole) and got.count() == 400
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    crlf = tmp_path / "crlf.csv"
    crlf.write_bytes(b'a,b\r\n"x\ny",1\r\n\r\nz,2')
    assert rows(files.read_split_csv(spark, str(crlf), "a string, b int")) == [("x\ny", 1), ("z", 2)]


def test_polygon_store_skips_what_a_box_does_not_meet(spark, tmp_path):
    import pyarrow.parquet as pq

    squares = {f"s{x}_{y}": [[(x, y), (x + 0.5, y), (x + 0.5, y + 0.5), (x, y + 0.5), (x, y)]] for x in range(32) for y in range(32)}
    path = str(tmp_path / "store")
    files.write_polygon_store(polygons(spark, squares | {"none": []}), path, files=32)
    box = (3.0, 6.0, 20.0, 23.4)
    met = files.read_polygon_store(spark, path, box)
    assert met.columns == ["GISJOIN", "rings"] and {r.GISJOIN for r in met.collect()} == {f"s{x}_{y}" for x in range(3, 7) for y in range(20, 24)}
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    plan = files.read_polygon_store(spark, path, box)._jdf.queryExecution().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert all(f"({c},{v})" in plan for c, v in (("_xmin", "6.0"), ("_xmax", "3.0"), ("_ymin", "23.4"), ("_ymax", "20.0")))
    groups = hit = 0
    for file in (tmp_path / "store").glob("*.parquet"):
        meta = pq.ParquetFile(file).metadata
        places = {meta.schema.column(i).path: i for i in range(meta.num_columns)}
        for g in range(meta.num_row_groups):
            stat = lambda c: meta.row_group(g).column(places[c]).statistics
            groups += 1
            hit += stat("_xmin").has_min_max and stat("_xmin").min <= 6 and stat("_xmax").max >= 3 and stat("_ymin").min <= 23.4 and stat("_ymax").max >= 20
    assert groups >= 30 and hit <= groups / 4
    assert files.read_polygon_store(spark, path).count() == 32 * 32 + 1
    files.write_polygon_store(polygons(spark, {}), str(tmp_path / "empty"))
    assert files.read_polygon_store(spark, str(tmp_path / "empty"), box).count() == 0
