from pyspark.sql import functions as F

from blockrisk.functions import fields as C
from tests.conftest import rows


def one(spark, values, expression, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(expression).collect()]


def test_parse_point_takes_latitude_first(spark):
    lon, lat = C.parse_point("v")
    df = spark.createDataFrame([("(37.76, -122.42)",), ("junk",), (None,)], "v string")
    assert rows(df.select(lon.alias("x"), lat.alias("y"))) == [
        (None, None), (None, None), (-122.42, 37.76)
    ]


def test_timestamps_in_all_forms(spark):
    texts = ["2007-03-01", "03/01/2007", "03/01/2007 01:00:00 PM", "2007-03-01T00:00:00.000", "never"]
    got = one(spark, texts, F.year(C.parse_timestamp("v")))
    assert got == [2007, 2007, 2007, 2007, None]


def test_keys(spark):
    assert one(spark, ["G0602008"], C.shift_block_year_key("v")) == ["G0602007"]
    assert one(spark, ["G0602008"], C.block_of_key("v")) == ["G060"]
    assert one(spark, ["G060"], C.block_year_key("v", F.lit(2010.0))) == ["G0602010"]


def test_date_bounds_differ_on_the_day(spark):
    days = ["2006-12-31", "2007-01-01", "2007-01-02"]
    stamp = F.to_timestamp("v")
    assert one(spark, days, C.since(stamp, "2007-01-01")) == [False, True, True]
    assert one(spark, days, C.since(stamp, "2007-01-01", inclusive=False)) == [False, False, True]


def test_codes_match_anywhere_unless_anchored(spark):
    texts = ["111 - building", "9111 x", "130 and 111", "200"]
    assert one(spark, texts, C.matches_any("v", ["111", "112"])) == [True, True, True, False]
    assert one(spark, texts, C.matches_any("v", ["111"], anchored=True)) == [True, False, False, False]


def test_a_row_may_carry_two_classes(spark):
    flags = C.class_flags("v", C.FIRE_CLASSES)
    df = spark.createDataFrame([("130 and 111",)], "v string").select(*[f.alias(n) for n, f in flags.items()])
    assert df.first().asDict() == {"Structure_fire": 1, "Vehicle_fire": 1, "External_fire": 0}


def test_flags_treat_null_as_different(spark):
    assert one(spark, ["ARSON", "THEFT", None], C.equals_flag("v", "ARSON")) == [1, 0, 0]
    assert one(spark, ["ARSON", "THEFT", None], C.differs_flag("v", "ARSON")) == [0, 1, 1]


def test_city_box_is_open_and_forgives_text(spark):
    got = one(spark, ["-122.53", "-122.5", "x", None], C.in_city_box("v", F.lit("37.75")))
    assert got == [0, 1, 0, 0]


def test_numbers(spark):
    values = [0.0, 0.5, 1.0, None]
    assert one(spark, values, C.at_least_one("v"), "double") == [0, 0, 1, 0]
    assert one(spark, values, C.above_zero("v"), "double") == [0, 1, 1, 0]
    assert one(spark, [2019.0, 2020.0], C.keep_up_to("v", 2019), "double") == [2019.0, None]
    assert one(spark, values, C.zero_sum_flag(["v", F.lit(None).cast("double")]), "double") == [1, 0, 0, 1]


def test_one_hot_drops_the_first_value(spark):
    assert list(C.one_hot("v", ["U", "R"])) == ["U"]


def test_address_check_is_case_sensitive(spark):
    got = one(spark, ["1 A St", "1 A St San Francisco", "1 A St san francisco"], C.normalise_address("v"))
    assert got == ["1 A St San Francisco", "1 A St San Francisco", "1 A St san francisco San Francisco"]
