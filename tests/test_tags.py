import pytest
from pyspark.sql import functions as F

from voltmesh.functions import geometry as G
from voltmesh.functions import ids, tags
from voltmesh.plans import mapview


def values(spark, f, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r.v for r in df.select("i", f(F.col("t")).alias("v")).orderBy("i").collect()]


@pytest.mark.parametrize(
    ("f", "cases"),
    [
        (tags.clean_voltage, {"220 kV": "220000", "400/220/110/20_kV": "400000;220000;110000;20000", "380000>220000": "380000;220000", "medium": "33000", "Max Amperes 100": "100", "11.5kV": "115000", "110-220": "110220", None: "", "220": "220"}),
        (tags.clean_circuits, {"1,5": "3", "1/3": "1", "partial 2": "2", None: ""}),
        (tags.clean_cables, {"3x2;2": "3", "6": "6"}),
        (tags.clean_wires, {"quad": "4", "double": "2", "Yes": "3", "?": ""}),
        (tags.clean_frequency, {"16,7 Hz": "16.7", "50 Hz": "50", "16.67": "16.7"}),
    ],
)
def test_cleaners(spark, f, cases):
    assert values(spark, f, list(cases)) == list(cases.values())


def test_exact_steps_match_whole_values_only(spark):
    steps = [("exact", "m", "33000"), ("exact", "medium", "99000")]
    assert values(spark, lambda c: tags.corrected(c, steps), ["m", "amperes", "medium"]) == ["33000", "amperes", "99000"]


def test_dates(spark):
    good = {"2020": "2020-01-01", "2020-": "2020-01-01", "2020-05": "2020-05-01", "05-2020": "2020-05-01", "20200517": "2020-05-17", "17-05-2020": "2020-05-17", "2020-5-7": "2020-05-07", "1890": "1890-01-01", "circa 1975-03": "1975-03-01"}
    bad = ["1998-2001", "--", "199", "12", "202005", "2020-13", "0000", "unknown", None, "2020-02-30"]
    got = values(spark, tags.clean_date, [*good, *bad])
    assert [str(x) for x in got[: len(good)]] == list(good.values()) and got[len(good) :] == [None] * len(bad)


def test_voltage_filter_drops_numbers_that_are_too_long_or_have_leading_zeros(spark):
    got = values(spark, lambda c: tags.voltage_at_least(c, 220000), ["230000", "9" * 15, "0220000", "110000;220000", "", ";"])
    assert got == [True, False, False, True, False, False]


def test_identifiers(spark):
    df = spark.createDataFrame([("virtual_way/123:0-220",)], "x string")
    row = df.select(ids.base(F.col("x")), ids.osm_id(F.col("x")), ids.number(F.col("x")), ids.without_kv(F.col("x")), ids.kv_of(F.col("x"))).first()
    assert tuple(row) == ("virtual_way/123:0", "way/123", 123, "virtual_way/123:0", "220")
    n = spark.range(60).select("id", ids.letters(F.col("id").cast("int")).alias("l")).orderBy("id").collect()
    assert [n[i].l for i in (0, 25, 26, 27, 51, 52)] == ["a", "z", "aa", "ab", "az", "ba"]


def test_projection_and_back(spark):
    df = spark.createDataFrame([(5.0, 50.0), (10.0, 52.0), (-8.0, 37.0), (25.5, 66.0)], "lon double, lat double")
    x, y = G.metric(F.col("lon"), F.col("lat"))
    out = df.withColumn("x", x).withColumn("y", y)
    lon, lat = G.geographic(F.col("x"), F.col("y"))
    rows = out.select("lon", "lat", "x", "y", lon.alias("lon2"), lat.alias("lat2")).collect()
    assert (round(rows[0].x, 2), round(rows[0].y, 2)) == (3962799.45, 2999718.85)
    assert all(abs(r.lon - r.lon2) < 1e-8 and abs(r.lat - r.lat2) < 1e-8 for r in rows), rows


def test_half_even_rounding(spark):
    df = spark.createDataFrame([(0, 0.125), (1, 2.675), (2, 1.005), (3, 0.135)], "i int, v double")
    assert [r.x for r in df.select("i", G.rint(F.col("v"), 2).alias("x")).orderBy("i").collect()] == [0.12, 2.68, 1.0, 0.14]


def test_palette_raises_between_bands(spark):
    df = spark.createDataFrame([(220.0,), (380.0,), (500.0,)], "kv double")
    assert [r.c for r in df.select(mapview.line_color(F.col("kv")).alias("c")).collect()] == ["#00fa00", "#ff2800", "#ff00ff"]
    with pytest.raises(Exception, match="no colour"):
        spark.createDataFrame([(150.5,)], "kv double").select(mapview.line_color(F.col("kv"))).collect()


def test_tags_cleaned_by_value_are_those_cleaned_by_row(spark):
    from voltmesh.operators import lines

    rows = [(i, v, c, k, f) for i, (v, c, k, f) in enumerate([("220 kV", "1,5", None, "50 Hz"), ("220 kV", "1,5", None, "50 Hz"), (None, None, "3x2;2", "16,7"), ("medium", "2", "6", None), ("110000;20 kV", "", "", "0")])]
    df = spark.createDataFrame(rows, "id int, voltage string, circuits string, cables string, frequency string")
    once, each = (sorted(lines.cleaned_tags(df, most=n).collect()) for n in (100, 2))
    assert once == each and [r.voltage for r in once] == ["220000", "220000", "", "33000", "110000;20000"]
    assert lines.cleaned_tags(df).columns == df.columns and lines.cleaned_tags(df.limit(0)).count() == 0
