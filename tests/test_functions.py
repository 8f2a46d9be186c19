import unicodedata

import pytest
from pyspark.sql import functions as F

from panelcast.functions import casts
from panelcast.functions.features import opponent_strength, reached, total_of
from panelcast.functions.paths import path_part, period_from_name
from panelcast.functions.text import comparison_key, contains_ignoring_case, safe_tag
from panelcast.operators import conform as cf
from panelcast.sources.tree import PERIOD_PATH


def column(spark, values, kind="string"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")


def results(df, expression):
    return [r["x"] for r in df.select("i", expression.alias("x")).orderBy("i").collect()]


def test_lenient_numbers(spark):
    texts = ["12.3", "1d", "nan", "", " 2 ", "1,000", None, "-.5", "+4.", "1e3", "1E-2", "inf", "0x10", "12.3%", "1 2"]
    wanted = [12.3, None, None, None, 2.0, None, None, -0.5, 4.0, 1000.0, 0.01, None, None, None, None]
    assert results(column(spark, texts), casts.text_to_number(F.col("v"))) == wanted


def test_percent_numbers(spark):
    df = column(spark, ["12.3%", "%5%", "7", "x%", None, "nan"])
    assert results(df, casts.percent_to_number(F.col("v"))) == [12.3, 5.0, 7.0, None, None, None]


def test_nan_becomes_null(spark):
    df = cf.lenient(column(spark, [1.5, float("nan"), None], "double"), {"v": "double"})
    assert results(df, F.col("v")) == [1.5, None, None]


def test_strict_int(spark):
    assert results(cf.strict_int(column(spark, ["3", " 4 ", "5.0"]), ["v"]), F.col("v")) == [3, 4, 5]
    for bad in ("x", None, "nan", ""):
        with pytest.raises(Exception, match="not an integer"):
            cf.strict_int(column(spark, ["3", bad]), ["v"]).collect()


def test_missing_tokens(spark):
    df = column(spark, ["NA", "nan", "null", "Nan", "n/a", "", "none", "None", "ok"])
    assert results(df, casts.missing_to_null(F.col("v"))) == [None, None, None, "Nan", None, None, "none", None, "ok"]


NAMES = [
    "Šeško", " sesko ", "Gyökeres", "Ekitiké", "Ødegaard", "odegaard", "ß", "ﬁn", "x²", "İstanbul", "ΟΔΟΣ", None, "",
    " Ekitike ", "Á", "한글", "ệ", "plain", "😀 é",
]


def test_comparison_key_is_nfkd_without_marks(spark):
    def wanted(text):
        if text is None:
            return None
        decomposed = unicodedata.normalize("NFKD", text.strip().lower())
        return "".join(c for c in decomposed if unicodedata.combining(c) == 0)

    got = results(column(spark, NAMES), comparison_key(F.col("v")))
    assert got == [wanted(n) for n in NAMES]
    assert got[0] == got[1] and got[4] != got[5]


def test_safe_tag(spark):
    df = column(spark, ["Man Utd", "Atlético", "--a.b_c--", "___", "", None, "A/B\\C", "é"])
    assert results(df, safe_tag(F.col("v"))) == ["Man_Utd", "Atletico", "--a.b_c--", "UNK", "UNK", "UNK", "A_B_C", "e"]


def test_contains_ignoring_case(spark):
    df = column(spark, ["Premier League", "PREM", "cup", None])
    assert results(df, contains_ignoring_case(F.col("v"), "prem")) == [True, True, False, False]


def test_path_columns(spark):
    paths = [
        "file:/d/2024-2025/By%20Gameweek/GW12/a.csv", "file:/d/2024-2025/By Gameweek/GW3/a.csv",
        "file:/d/s/By%20Gameweek/GWx/a.csv", "file:/d/s/Other/GW1/a.csv",
    ]
    df = column(spark, paths)
    assert results(df, path_part(F.col("v"), PERIOD_PATH, 1)) == ["2024-2025", "2024-2025", None, None]
    assert results(df, path_part(F.col("v"), PERIOD_PATH, 2, "int")) == [12, 3, None, None]


def test_period_from_name(spark):
    df = column(spark, ["gw7_predictions.csv", "GW12_Predictions.CSV", "my_gw3_predictions.csv", "gw_predictions.csv", "gw1_predictionsXcsv"])
    assert results(df, period_from_name(F.col("v"))) == [7, 12, 3, None, None]
    df = column(spark, ["gw10-points.csv", "old-gw10-points.csv"])
    assert results(df, period_from_name(F.col("v"), after="-points.csv", whole=True)) == [10, None]


def test_row_features(spark):
    df = spark.createDataFrame([(0, 59.0, 1), (1, 60.0, 0), (2, None, None)], "i int, m double, h int")
    assert results(df, reached(F.col("m"), 60)) == [0.0, 1.0, 0.0]
    assert results(df, opponent_strength(F.col("h"), F.lit(5.0), F.lit(9.0))) == [9.0, 5.0, None]
    assert results(df, total_of(F.col("m"), F.lit(None).cast("double"))) == [59.0, 60.0, 0.0]


def test_column_policies(spark):
    df = spark.createDataFrame([("1", "x")], "element string, name string")
    with pytest.raises(cf.MissingColumns):
        cf.require(df, ["id"])
    with pytest.raises(cf.MissingColumns):
        cf.first_present(df, ["id", "playerId"])
    renamed = cf.resolve_alias(df, "id", ["player_id", "element"])
    assert renamed.columns == ["id", "name"]
    assert cf.resolve_alias(renamed, "id", ["name"]).columns == ["id", "name"]
    with pytest.raises(cf.MissingColumns):
        cf.conform(renamed, {"id": "long", "form": "double"})
    assert cf.conform(renamed, {"id": "long", "form": "double"}, "null").dtypes == [
        ("id", "bigint"), ("name", "string"), ("form", "double")]
    assert cf.conform(renamed, {"id": "long", "form": "double"}, "drop").columns == ["id", "name"]
    assert cf.keep_existing(renamed, ["form", "name", "id"]).columns == ["name", "id"]
