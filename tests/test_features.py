from datetime import datetime
from decimal import Decimal as D

from frames import raw_df, raw_row
from skyledger.operators import features as FE
from skyledger.operators import quality as Q


def test_engineer_edges(spark):
    rows = [
        raw_row(0, dep=datetime(2024, 1, 1, 6), arr=datetime(2024, 1, 1, 9, 30), duration=3.5, days=7),
        raw_row(1, dep=datetime(2024, 1, 6, 23), arr=datetime(2024, 1, 7, 8), duration=9.0, stops="2 Stops", days=30),
        raw_row(2, duration=None, days=8),
    ]
    f = {r["raw_id"]: r for r in FE.engineer(Q.validate(raw_df(spark, rows))).collect()}
    assert f[0]["departure_weekday"] == 0 and f[0]["is_weekend"] == 0        # Monday = 0
    assert f[0]["is_international"] == 0                                    # exactly 3.5 is domestic
    assert f[0]["last_minute_booking"] == 1 and f[0]["early_booking"] == 0
    assert f[1]["departure_weekday"] == 5 and f[1]["is_weekend"] == 1
    assert f[1]["is_international"] == 1 and f[1]["trip_complexity"] == 2 + 1 + 1
    assert f[1]["arrival_hour"] == 8 and f[1]["early_booking"] == 1
    assert f[2]["is_international"] == 0 and f[2]["stopover_intensity"] is None
    assert f[0]["route"] == "Dhaka_Sylhet"


def test_label_vocabulary_sorted_with_nan(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("B",)], "airline string")
    vocab = {r["value"]: r["code"] for r in FE.label_vocabulary(df, ["airline"]).collect()}
    assert vocab == {"B": 0, "a": 1, "b": 2, "nan": 3}


def test_split_is_stable_and_disjoint(spark):
    df = spark.range(1000).withColumnRenamed("id", "raw_id")
    s = FE.split_assign(df)
    counts = {r["split"]: r["count"] for r in s.groupBy("split").count().collect()}
    assert counts == {"train": 800, "test": 200}
    assert s.where("split = 'test' AND fold IS NOT NULL").count() == 0
    again = FE.split_assign(df.repartition(7))
    assert s.exceptAll(again).count() == 0


def test_scaler_uses_train_moments(spark):
    df = spark.createDataFrame([(0, 1.0, "train"), (1, 3.0, "train"), (2, 5.0, "test")], "raw_id long, x double, split string")
    m = FE.fit_scaler(df.where("split = 'train'"), ["x"])
    z = {r["raw_id"]: r["x"] for r in FE.apply_scaler(df, m, ["x"]).collect()}
    assert z == {0: -1.0, 1: 1.0, 2: 3.0}


def test_rejects_for_unknown_and_missing(spark):
    from skyledger.schemas import AIRLINES
    vocab = FE.fixed_vocabulary(spark, {"airline": AIRLINES})
    df = spark.createDataFrame([("Emirates",), ("Nope Air",), (None,)], "airline string")
    ok, bad = FE.encode_with_rejects(df, vocab, ["airline"])
    assert [r["airline_code"] for r in ok.collect()] == [sorted(AIRLINES).index("Emirates")]
    reasons = sorted(r["reject_reason"] for r in bad.collect())
    assert reasons == ["missing field: airline", "unknown airline"]


def test_lookups(spark):
    df = spark.createDataFrame([(1, "Economy", "DAC", "XXX")], "raw_id long, booking_class string, source string, destination string")
    r = FE.dim_lookup(df).collect()[0]
    assert (r["class_tier"], r["source_city"], r["destination_city"]) == ("lowest tier", "Dhaka", None)


def test_format_bdt(spark):
    df = spark.createDataFrame([(D("12345.6"),)], "predicted_fare decimal(12,2)")
    assert FE.format_prediction(df).collect()[0]["predicted_fare_formatted"] == "৳12,345.60"
