from datetime import datetime
from decimal import Decimal as D

from pyspark.sql import functions as F

from frames import raw_df, raw_edge, raw_row
from skyledger.operators import quality as Q


def by_id(df, key="raw_id"):
    return {r[key]: r for r in df.collect()}


def test_validate_rules(spark):
    v = by_id(Q.validate(raw_edge(spark)))
    assert v[0]["validation_status"] == "valid" and v[0]["validation_notes"] is None
    assert v[1]["base_fare"] == D("200.00") and v[1]["total_fare"] == D("210.00")
    assert v[1]["validation_status"] == "corrected"
    assert "negative base_fare made positive" in v[1]["validation_notes"]
    assert v[2]["validation_status"] == "flagged" and v[2]["total_fare"] is None
    assert v[3]["tax_and_surcharge"] == D("0.00") and v[3]["total_fare"] == D("100.00")
    assert v[3]["validation_status"] == "corrected"
    assert v[4]["validation_status"] == "flagged" and "missing airline" in v[4]["validation_notes"]
    assert v[6]["total_fare"] == D("110.00") and "total_fare recomputed" in v[6]["validation_notes"]
    assert v[8]["travel_date"] is None and v[8]["season_label"] == "Regular" and v[8]["is_peak_season"] == 0


def test_no_row_dropped_and_totals(spark):
    raw = raw_edge(spark)
    v = Q.validate(raw)
    assert v.count() == raw.count()
    bad = v.where(F.col("total_fare") != F.col("base_fare") + F.col("tax_and_surcharge")).count()
    assert bad == 0
    assert v.where(F.col("base_fare") < 0).count() == 0


def test_dedup_and_cities_and_mismatch(spark):
    raw = raw_edge(spark)
    assert Q.clean_dedup(raw).count() == raw.count() - 1
    bad_cities = {r["id"] for r in Q.invalid_city_rows(raw).collect()}
    assert bad_cities == {5}
    mism = {r["raw_id"] for r in Q.fare_mismatch(raw).collect()}
    assert mism == {1, 6}


def test_audit_and_run_log_and_rejects(spark):
    raw = raw_edge(spark)
    v = Q.validate(raw)
    audit = {r["check_name"]: r for r in Q.validation_audit(raw, v).collect()}
    assert audit["row_count_preserved"]["check_result"] == "PASS"
    assert audit["negative_base_fare"]["check_result"] == "WARN"
    assert audit["negative_base_fare"]["records_failed"] == 1
    assert audit["required_airline"]["check_result"] == "FAIL"
    assert audit["total_equals_base_plus_tax"]["check_result"] == "PASS"
    log = Q.run_log(raw, v).collect()[0]
    assert (log["rows_ingested"], log["rows_validated"], log["rows_rejected"]) == (11, 11, 2)
    rejected = {r["id"] for r in Q.rejected_rows(raw, v).collect()}
    assert rejected == {2, 4}
    dq = {r["column_name"]: r["null_count"] for r in Q.dq_required(raw).collect()}
    assert dq["airline"] == 1 and dq["tax_and_surcharge"] == 1 and dq["total_fare"] == 2


def test_apply_defaults(spark):
    df = raw_df(spark, [raw_row(0, tax=None)]).select("id", "tax_and_surcharge")
    out = Q.apply_defaults(df).collect()[0]
    assert out["tax_and_surcharge"] == D("0.00") and out["stops"] == 0
    assert out["validation_status"] == "valid" and out["load_timestamp"] is not None


SEASON_CASES = [
    ((4, 8), "Eid al-Fitr"), ((4, 12), "Eid al-Fitr"), ((4, 15), "Eid al-Fitr"),
    ((4, 16), "Pohela Boishakh"), ((4, 17), "Regular"), ((6, 26), "Eid al-Adha"),
    ((7, 3), "Eid al-Adha"), ((7, 4), "Regular"), ((12, 31), "Winter Holidays"),
    ((1, 1), "Winter Holidays"), ((1, 6), "Regular"), ((4, 19), "Eid al-Fitr"), ((6, 14), "Regular"),
]


def test_season_windows(spark):
    rows = [raw_row(i, dep=datetime(2024, m, d, 9)) for i, ((m, d), _) in enumerate(SEASON_CASES)]
    rows.append(raw_row(99, dep=None))
    out = by_id(Q.season_classify(raw_df(spark, rows)), "id")
    for i, (_, label) in enumerate(SEASON_CASES):
        assert out[i]["season_label"] == label, SEASON_CASES[i]
        assert out[i]["is_peak_season"] == (0 if label == "Regular" else 1)
    assert out[99]["season_label"] == "Regular" and out[99]["is_peak_season"] == 0
