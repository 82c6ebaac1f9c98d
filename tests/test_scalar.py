"""Hand-written rows for the scalar semantics (FIXTURES.md section 3)."""

from decimal import Decimal

from pyspark.sql import functions as F

from tremorlake.functions import scalar as S


def one_col(spark, values, fn, dtype="double"):
    df = spark.createDataFrame([(v,) for v in values], f"v {dtype}")
    return [r[0] for r in df.select(fn(F.col("v"))).collect()]


def test_mag_class_edges(spark):
    got = one_col(spark, [1.99, 2.0, 3.99, 4.0, 5.99, 6.0], S.mag_class)
    assert got == ["Micro", "Leve", "Leve", "Fuerte", "Fuerte", "Severo"]


def test_mag_class_binned_and_display(spark):
    assert one_col(spark, [2.0, 4.0, 6.0], lambda c: S.mag_class(c, closed="right")) == ["Micro", "Leve", "Fuerte"]
    assert one_col(spark, [None, 11.0], lambda c: S.mag_class(c, closed="right")) == ["nan", "nan"]
    assert one_col(spark, [None], lambda c: S.mag_class(c, null_as_zero=True)) == ["Micro"]


def test_depth_class_edges(spark):
    got = one_col(spark, [69.99, 70.0, 299.99, 300.0, None], S.depth_class)
    assert got == ["Superficial", "Intermedia", "Intermedia", "Profunda", "Profunda"]


def test_region(spark):
    vals = [None, "  ", "A, B, C", "5 km S of X", "Ridge", "abc,", "a\nb, Chile"]
    got = one_col(spark, vals, S.region, "string")
    assert got == ["Sin ubicación", "Sin ubicación", "C", "X", "Ridge", "", "Chile"]


def test_region_keep_tail(spark):
    vals = [None, "abc,", "  5 km S of X  ", "Ridge"]
    got = one_col(spark, vals, lambda c: S.region(c, keep_tail=True), "string")
    assert got == ["Sin ubicación", "abc,", "X", "Ridge"]


def test_avg_rounded_half_away(spark):
    df = spark.createDataFrame([(Decimal("2.34"), Decimal("-2.34")), (Decimal("2.35"), Decimal("-2.35"))],
                               "a decimal(6,2), b decimal(6,2)")
    # averages 2.345 and -2.345 -> 2.35 / -2.35
    r = df.agg(S.avg_rounded("a").alias("a"), S.avg_rounded("b").alias("b")).first()
    assert (r.a, r.b) == (2.35, -2.35)


def test_avg_rounded_empty(spark):
    df = spark.createDataFrame([(None,)], "a decimal(6,2)")
    assert df.agg(S.avg_rounded("a")).first()[0] is None


def test_longitude_wrap(spark):
    assert one_col(spark, [280.0, 180.0, -180.0], S.wrap_longitude) == [-80.0, -180.0, -180.0]


def test_normalize_point(spark):
    df = spark.createDataFrame([(10.0, 280.0), (95.0, 0.0), (float("nan"), 1.0)], "lat double, lon double")
    got = [r[0] for r in df.select(S.normalize_point("lat", "lon")).collect()]
    assert got[0].lon == -80.0 and got[1] is None and got[2] is None


def test_radius_from_area(spark):
    got = one_col(spark, [0.0, None, 75417.0, 17098242.0], S.radius_from_area)
    assert got == [700, 700, 250, 2500]


def test_name_key(spark):
    df = spark.createDataFrame([("Panamá",), (" PANAMA ",)], "n string")
    assert df.select(S.name_key("n").alias("k")).distinct().count() == 1


def test_labels_and_text(spark):
    assert one_col(spark, ["green", " none ", None, "weird"], S.alert_label, "string") == \
        ["Verde", "Sin alerta", "Sin alerta", "weird"]
    assert one_col(spark, ["reviewed", "NULL"], S.status_label, "string") == ["Revisado", "Sin dato"]
    assert one_col(spark, [1234.0, 1234.5, None], S.number_text) == ["1,234", "1,234.50", "--"]


def test_to_number(spark):
    assert one_col(spark, ["1.5", "abc", "NaN", "inf", None], S.to_number, "string") == [1.5, None, None, None, None]


def test_round_float_half_even(spark):
    assert one_col(spark, [31.125, -2.5], lambda c: S.round_float(c, 2)) == [31.12, -2.5]


def test_finite_and_time_text(spark):
    assert one_col(spark, ["2.5", "x", "-inf"], lambda c: S.finite(c, 0.0), "string") == [2.5, 0.0, 0.0]
    assert one_col(spark, ["2024-01-02 03:04:05", "junk", None], S.time_text, "string") == \
        ["2024-01-02 03:04 UTC", "--", "--"]


def test_analysis_frame(spark):
    from tremorlake.operators.clean import analysis_frame

    df = spark.createDataFrame([("2.0", "1", "2024-01-02 00:00:00", "a, Chile"), (None, "2", "2024-01-02", "x"),
                                ("6.5", None, "2024-01-03 10:00:00", None)],
                               "mag string, depth string, time string, place string")
    rows = analysis_frame(df).orderBy("mag").collect()
    assert [(r.category, r.region, r.day) for r in rows] == [("Micro", "Chile", "2024-01-02"),
                                                             ("Severo", "Sin ubicación", "2024-01-03")]


def test_insight(spark):
    from tremorlake.operators.analysis import dominant_category

    def run(counts):
        df = spark.createDataFrame(list(counts.items()), "category string, events int")
        return dominant_category(df).first()

    r = run({"Micro": 3, "Leve": 3, "Fuerte": 1, "Severo": 0})
    assert r.dominant_category == "Micro" and r.insight == S.INSIGHT_TEXT["strong"]
    r = run({"Micro": 0, "Leve": 0, "Fuerte": 0, "Severo": 0})
    assert r.dominant_category == "--" and r.insight == S.INSIGHT_TEXT["none"]


def test_oracle_texts_agree_on_edge_places(spark):
    """The DuckDB texts behind analysis_frame state P15 and P18 independently;
    they must agree with the Spark expressions on edge rows too."""
    import duckdb

    from tremorlake.plans.catalog import _P15_CLASS, _P18_REGION

    places = [None, "", "  ", "abc,", "  5 km S of X  ", "Ridge", "a, b ,  c ", "x of y of z", " of ", "a,  "]
    got = one_col(spark, places, lambda c: S.region(c, keep_tail=True), "string")
    want = [duckdb.execute(f"SELECT {_P18_REGION} FROM (SELECT CAST(? AS VARCHAR) AS place)", [p]).fetchone()[0]
            for p in places]
    assert got == want
    mags = [-10.5, -10.0, 2.0, 2.01, 4.0, 6.0, 6.01, 10.0, 10.01]
    got = one_col(spark, mags, lambda c: S.mag_class(c, closed="right"))
    want = [duckdb.execute(f"SELECT {_P15_CLASS} FROM (SELECT CAST(? AS DOUBLE) AS mag)", [m]).fetchone()[0]
            for m in mags]
    assert got == want
