from datetime import datetime
from decimal import Decimal as D

from pyspark.sql import functions as F

from frames import raw_df, raw_row
from skyledger.operators import marts as M
from skyledger.operators import quality as Q

PEAK = datetime(2024, 4, 20, 9)     # Eid al-Fitr
OFF = datetime(2024, 3, 1, 9)       # Regular


def kpi_edge(spark):
    rows = [
        # airline A: peak and off-peak
        raw_row(0, "A", dep=PEAK, base=D("200.00"), tax=D("0.00")),
        raw_row(1, "A", dep=OFF, base=D("100.00"), tax=D("0.00")),
        # airline B: only off-peak, zero fares
        raw_row(2, "B", dep=OFF, base=D("0.00"), tax=D("0.00")),
        raw_row(3, "B", dep=PEAK, base=D("50.00"), tax=D("0.00")),
        # airline C: only peak rows
        raw_row(4, "C", dep=PEAK, base=D("80.00"), tax=D("0.00")),
        # null fare, null airline
        raw_row(5, "A", dep=OFF, base=None),
        raw_row(6, None, dep=OFF, base=D("10.00")),
        # tie for dominant airline on route Dhaka->Chittagong: D and E one row each
        raw_row(7, "E", destination="Chittagong", dep=OFF),
        raw_row(8, "D", destination="Chittagong", dep=OFF),
    ]
    return Q.validate(raw_df(spark, rows))


def test_premium_baselines(spark):
    v = kpi_edge(spark)
    out = {(r["airline"], r["season_label"]): r for r in M.kpi_seasonal_premium(v, "r1").collect()}
    assert out[("A", "Eid al-Fitr")]["fare_premium_pct"] == 100.0      # 200 vs 100
    assert out[("A", "Regular")]["fare_premium_pct"] == 0.0
    assert out[("B", "Eid al-Fitr")]["fare_premium_pct"] is None       # zero baseline
    assert out[("C", "Eid al-Fitr")]["fare_premium_pct"] is None       # no off-peak rows
    assert out[("A", "Regular")]["booking_count"] == 1                 # null fare not counted


def test_booking_counts(spark):
    v = kpi_edge(spark)
    out = {r["airline"]: r for r in M.kpi_booking_count(v, "r1").collect()}
    assert None not in out
    a = out["A"]
    assert (a["total_bookings"], a["peak_bookings"], a["offpeak_bookings"]) == (2, 1, 1)
    # denominator is every row of the run (9), including null airline / fare rows
    assert a["market_share_pct"] == round(2 / 9 * 100, 4)
    for r in out.values():
        assert r["peak_bookings"] + r["offpeak_bookings"] == r["total_bookings"]


def test_routes_and_dominant_airline(spark):
    v = kpi_edge(spark)
    dom = {(r["source"], r["destination"]): r["top_airline"] for r in M.dominant_airline(v).collect()}
    assert dom[("Dhaka", "Chittagong")] == "D"          # tie -> alphabetical
    assert dom[("Dhaka", "Sylhet")] == "A"              # 3 rows (incl. null fare)
    shares = M.kpi_route_airline(v).groupBy("source", "destination").agg(F.sum("route_share_pct").alias("s"))
    for r in shares.collect():
        assert abs(r["s"] - 100.0) < 0.01
    top = M.kpi_popular_routes_topn(v, "r1", top_n=1).collect()
    assert len(top) == 1 and top[0]["rank"] == 1 and top[0]["route"] == "Dhaka → Sylhet"


def test_sql_marts_keep_null_keys(spark):
    v = kpi_edge(spark)
    stg = M.stg_bookings(v)
    airlines = {r["airline"] for r in M.kpi_avg_fare(stg).collect()}
    assert None in airlines
    seasons = {r["season"] for r in M.kpi_seasonal_variation(stg).collect()}
    assert seasons == {"Peak", "Off-Peak"}


def test_run_summary(spark):
    v = kpi_edge(spark)
    s = M.kpi_run_summary(v, "r1").collect()[0]
    assert s["total_rows"] == 9 and s["airlines"] == 5 and s["routes"] == 2
    assert s["kpi_popular_routes_rows"] == 2
