import pytest
from pyspark.sql import functions as F

from conftest import SF001
from skyledger.functions.codes import to_snake_case
from skyledger.operators import profile as P
from skyledger.operators.models import FEATURE_NAMES, check_no_leakage
from skyledger.plans.fixture import validated_table
from skyledger.sources.csv import normalise_headers
from skyledger.sources.tables import require_columns, select_existing


def test_snake_case_headers(spark):
    assert to_snake_case("Tax & Surcharge (BDT)") == "tax_and_surcharge_bdt"
    assert to_snake_case("Departure Date & Time") == "departure_date_and_time"
    df = spark.createDataFrame([(1, 2, 3)], ["Airline", "Class", "Days Before Departure"])
    assert normalise_headers(df).columns == ["airline", "booking_class", "days_before_departure"]


def test_column_guards(spark):
    df = spark.createDataFrame([(1, 2)], ["a", "b"])
    assert select_existing(df, ["b", "zz", "a"]).columns == ["b", "a"]
    with pytest.raises(KeyError):
        require_columns(df, ["a", "departure_datetime"])


def test_leakage_guard():
    check_no_leakage(FEATURE_NAMES)
    with pytest.raises(ValueError):
        check_no_leakage([*FEATURE_NAMES, "base_fare"])


def test_dtype_summary_and_preview(spark):
    v = validated_table(spark, SF001)
    kinds = {d["column_name"]: d for d in P.dtype_summary(v)}
    assert kinds["airline"]["kind"] == "categorical" and kinds["total_fare"]["kind"] == "numerical"
    text = spark.createDataFrame([("2024-01-01",)], ["travel_date_text"])
    assert P.dtype_summary(text)[0]["needs_datetime_parsing"]
    head = P.preview(v, ["raw_id"]).collect()
    assert [r["raw_id"] for r in head] == [0, 1, 2, 3, 4]


def test_profile_bundle(spark):
    v = validated_table(spark, SF001)
    tables = P.profile(v)
    assert set(tables) >= {"missing_report", "describe_numeric", "fare_histogram", "corr_matrix"}
    hist = tables["fare_histogram"].where(F.col("scale") == "linear").agg(F.sum("count")).first()[0]
    assert hist == v.where(F.col("total_fare").isNotNull()).count()
    # shared quartile pass gives the same tables as the standalone operators
    assert tables["iqr_outliers"].exceptAll(P.iqr_outliers(v)).count() == 0
    assert tables["describe_numeric"].exceptAll(P.describe_numeric(v)).count() == 0
