"""Booking features, encodings, split, scaling and regression metrics.

All row-level work is column expressions (one projection, inside codegen);
fitted state (label vocabularies, scaler moments) is a small DataFrame
joined back by broadcast, never a driver-side dict built from the data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.functions.dates import hours_between, lenient_double, weekday_mon0
from skyledger.functions.fares import format_bdt
from skyledger.operators.ranking import join_small, range_rank
from skyledger.schemas import (
    AIRPORT_CITIES, CAT_FEATURES, EARLY_BOOKING_DAYS, INTERNATIONAL_HOURS, LAST_MINUTE_DAYS,
    LONG_HAUL_HOURS, NUM_FEATURES, SEASON_MULTIPLIERS,
)

# Booking class -> tier wording shown next to a prediction (fixed values).
CLASS_TIERS = {"Economy": "lowest tier", "Business": "mid tier", "First Class": "premium tier"}

LABEL = "label"  # log1p(total fare)


def _flag(cond: Column) -> Column:
    """Boolean -> 0/1 with null -> 0 (a pandas comparison with NaN is False)."""
    return F.coalesce(cond.cast("int"), F.lit(0))


def engineer(df: DataFrame) -> DataFrame:
    """Model features from validated bookings (one ``select``).

    Accepts the validated table (``departure_time``, ``booking_class``,
    ``stops`` ordinal, ``duration`` hours) and the season label under either
    name; derives duration from the timestamps only when it is absent.
    """
    dep, arr = F.col("departure_time"), F.col("arrival_time")
    if "duration" in df.columns:
        dur = lenient_double("duration")
    else:
        dur = hours_between(dep, arr)
    season = (F.coalesce(F.col("seasonality"), F.col("season_label"))
              if {"seasonality", "season_label"} <= set(df.columns)
              else F.col("seasonality") if "seasonality" in df.columns else F.col("season_label"))
    base = df.select(
        *[c for c in ("raw_id", "pipeline_run_id") if c in df.columns],
        "airline", "source", "destination",
        F.col("booking_class").alias("class"), "booking_source", season.alias("seasonality"),
        dur.alias("duration_hrs"),
        F.col("days_before_departure"),
        F.col("stops").cast("int").alias("stopovers"),
        F.hour(dep).alias("departure_hour"), F.dayofmonth(dep).alias("departure_day"),
        F.month(dep).alias("departure_month"), weekday_mon0(dep).alias("departure_weekday"),
        F.hour(arr).alias("arrival_hour"),
        *[c for c in ("total_fare",) if c in df.columns])
    d = F.col("duration_hrs")
    intl = _flag(d > INTERNATIONAL_HOURS)
    return base.select(
        "*",
        intl.alias("is_international"),
        F.concat(F.col("source"), F.lit("_"), F.col("destination")).alias("route"),
        _flag(F.col("departure_weekday").isin(5, 6)).alias("is_weekend"),
        _flag(F.col("days_before_departure") <= LAST_MINUTE_DAYS).alias("last_minute_booking"),
        _flag(F.col("days_before_departure") >= EARLY_BOOKING_DAYS).alias("early_booking"),
        (F.col("stopovers") / (d + F.lit(1e-6))).alias("stopover_intensity"),
        (F.col("stopovers") + intl + _flag(d > LONG_HAUL_HOURS)).alias("trip_complexity"))


def intl_counts(features: DataFrame) -> DataFrame:
    return features.agg(
        F.count_if(F.col("is_international") == 0).alias("domestic"),
        F.count_if(F.col("is_international") == 1).alias("international"))


def log_target(df: DataFrame, col: str = "total_fare", out: str = LABEL) -> DataFrame:
    """log1p of the fare (the model target); invert with ``expm1``."""
    return df.withColumn(out, F.log1p(F.col(col).cast("double")))


# --- label encoding -----------------------------------------------------------

def label_vocabulary(df: DataFrame, cols: Sequence[str] = CAT_FEATURES) -> DataFrame:
    """(column_name, value, code): each column's distinct values in sorted
    (byte) order numbered from 0; a null value is its own class, 'nan'.

    The vocabulary is numbered with the range-partitioned ranking, so a
    high-cardinality column is not sorted in one task.
    """
    present = [c for c in cols if c in df.columns]
    long = (df.select(*[F.coalesce(F.col(c).cast("string"), F.lit("nan")).alias(c) for c in present])
            .unpivot([], present, "column_name", "value").distinct())
    ranked, _ = range_rank(long, ["value"], ["column_name"], "code")
    return ranked.select("column_name", "value", F.col("code").cast("int").alias("code"))


def apply_labels(df: DataFrame, vocab: DataFrame, cols: Sequence[str] = CAT_FEATURES,
                 suffix: str = "_code") -> DataFrame:
    """Adds ``<col>_code`` for each column by joining its vocabulary slice.

    A vocabulary has one row per distinct label; it is broadcast only after
    its row count is checked (``join_small``). Unknown values get a null code.
    """
    out = df
    for c in cols:
        if c not in df.columns:
            continue
        v = vocab.where(F.col("column_name") == c).select(
            F.col("value").alias(f"_{c}_v"), F.col("code").alias(f"{c}{suffix}"))
        out = join_small(out.withColumn(f"_{c}_v", F.coalesce(F.col(c).cast("string"), F.lit("nan"))),
                         v, f"_{c}_v", "left").drop(f"_{c}_v")
    return out


def encode_with_rejects(df: DataFrame, vocab: DataFrame, cols: Sequence[str],
                        numbers: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """(encoded rows, rejected rows with a reason) for fixed scoring vocabularies.

    A row is rejected when a categorical or one of ``numbers`` is missing, or a
    label is not in the vocabulary (the scoring service's 4xx cases); nothing
    raises.
    """
    enc = apply_labels(df, vocab, cols)
    missing = [F.when(F.col(c).isNull(), F.lit(f"missing field: {c}")) for c in [*cols, *numbers]]
    unknown = [F.when(F.col(c).isNotNull() & F.col(f"{c}_code").isNull(), F.lit(f"unknown {c}")) for c in cols]
    reason = F.nullif(F.concat_ws("; ", *missing, *unknown), F.lit(""))
    tagged = enc.withColumn("reject_reason", reason)
    return (tagged.where(F.col("reject_reason").isNull()).drop("reject_reason"),
            tagged.where(F.col("reject_reason").isNotNull()))


def scoring_rejects(df: DataFrame, vocab: DataFrame, cols: Sequence[str], numbers: Sequence[str] = ()) -> DataFrame:
    """The rejected rows of ``encode_with_rejects``, without codes."""
    return encode_with_rejects(df, vocab, cols, numbers)[1].drop(*[f"{c}_code" for c in cols])


def fixed_vocabulary(spark, mapping: dict[str, Sequence[str]]) -> DataFrame:
    """Vocabulary table from fixed label lists (sorted, position = code)."""
    rows = [(col, v, i) for col, values in mapping.items() for i, v in enumerate(sorted(values))]
    return spark.createDataFrame(rows, "column_name string, value string, code int")


# --- split and scaling --------------------------------------------------------

def split_assign(df: DataFrame, key: str = "raw_id", test_tenths: int = 2, folds: int = 5) -> DataFrame:
    """Deterministic 80/20 split and CV fold from a stable row key.

    ``split`` is 'test' for ``key mod 10 >= 10 - test_tenths``; training rows
    get ``fold = (key div 10) mod folds``. Unlike ``randomSplit`` the result
    does not depend on partitioning, so re-runs and retries agree.
    """
    k = F.col(key)
    is_test = F.pmod(k, F.lit(10)) >= (10 - test_tenths)
    return df.withColumns({
        "split": F.when(is_test, F.lit("test")).otherwise(F.lit("train")),
        "fold": F.when(is_test, F.lit(None).cast("int"))
                 .otherwise(F.pmod(F.floor(k / 10), F.lit(folds)).cast("int")),
    })


def fit_scaler(train: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One-row table of per-column mean and population std from the train rows."""
    return train.agg(*[e for c in cols for e in (
        F.avg(F.col(c).cast("double")).alias(f"{c}__mean"),
        F.stddev_pop(F.col(c).cast("double")).alias(f"{c}__std"))])


def apply_scaler(df: DataFrame, moments: DataFrame, cols: Sequence[str], digits: int | None = None) -> DataFrame:
    """(x - mean) / std per column (std 0 -> 0, as sklearn leaves it unscaled)."""
    j = df.crossJoin(F.broadcast(moments))  # moments: exactly one row
    out = {}
    for c in cols:
        z = F.when(F.col(f"{c}__std") == 0, F.col(c).cast("double") - F.col(f"{c}__mean")).otherwise(
            (F.col(c).cast("double") - F.col(f"{c}__mean")) / F.col(f"{c}__std"))
        out[c] = z if digits is None else F.round(z, digits)
    return j.withColumns(out).drop(*moments.columns)


# --- metrics ------------------------------------------------------------------

def regression_metrics(pred: DataFrame, y: str = LABEL, yhat: str = "prediction", rounded: bool = True) -> DataFrame:
    """R² in log space, MAE and RMSE in fare units (after expm1), one pass."""
    e = F.col(y) - F.col(yhat)
    fare_err = F.expm1(F.col(y)) - F.expm1(F.col(yhat))
    s = pred.agg(F.sum(e * e).alias("_sse"), (F.var_pop(F.col(y)) * F.count(F.col(y))).alias("_sst"),
                 F.count(F.col(y)).alias("n"),
                 F.avg(F.abs(fare_err)).alias("_mae"), F.avg(fare_err * fare_err).alias("_mse"))
    values = {"r2": (1 - F.try_divide(F.col("_sse"), F.col("_sst")), 4), "mae": (F.col("_mae"), 2), "rmse": (F.sqrt("_mse"), 2)}
    return s.select(*[(F.round(v, digits) if rounded else v).alias(name) for name, (v, digits) in values.items()], "n")


def residual_summary(pred: DataFrame, y: str = LABEL, yhat: str = "prediction") -> DataFrame:
    r = F.col(y) - F.col(yhat)
    return pred.agg(F.round(F.avg(r), 4).alias("mean_error"), F.round(F.stddev_samp(r), 4).alias("std_error"),
                    F.round(F.min(r), 4).alias("min_error"), F.round(F.max(r), 4).alias("max_error"))


def baseline_predictions(features: DataFrame, x: str = "duration_hrs") -> DataFrame:
    """Least-squares line label ~ x fitted on the train split, applied to test.

    ``regr_slope`` / ``regr_intercept`` are plain aggregates (one row), so
    this reference model is exact and engine-independent.
    """
    df = log_target(features)
    fit = df.where(F.col("split") == "train").agg(
        F.regr_slope(LABEL, x).alias("_b"), F.regr_intercept(LABEL, x).alias("_a"))
    test = df.where(F.col("split") == "test")
    return (test.crossJoin(F.broadcast(fit))
            .withColumn("prediction", F.col("_a") + F.col("_b") * F.col(x).cast("double"))
            .drop("_a", "_b"))


# --- lookups --------------------------------------------------------------------

def map_lookup(col: Column | str, mapping: dict) -> Column:
    """Dictionary lookup as a literal map (unknown -> null); no join needed."""
    c = F.col(col) if isinstance(col, str) else col
    kv = [F.lit(x) for k, v in mapping.items() for x in (k, v)]
    return F.try_element_at(F.create_map(*kv), c)


def dim_lookup(df: DataFrame) -> DataFrame:
    """Class tier and airport city names (codes not in the lists -> null)."""
    return df.select(
        "raw_id", "booking_class", map_lookup("booking_class", CLASS_TIERS).alias("class_tier"),
        "source", map_lookup("source", AIRPORT_CITIES).alias("source_city"),
        "destination", map_lookup("destination", AIRPORT_CITIES).alias("destination_city"))


def season_multiplier(features: DataFrame) -> DataFrame:
    """Typical fare multiplier for the booking's season and the implied premium %."""
    m = map_lookup("seasonality", SEASON_MULTIPLIERS)
    return features.select("raw_id", "seasonality", m.alias("multiplier"),
                           F.round((m - 1) * 100, 0).alias("premium_pct"))


def impute_nulls(df: DataFrame, numeric: Sequence[str], text: Sequence[str],
                 text_fill: str = "Unknown") -> DataFrame:
    """Numeric nulls -> column median (exact), text nulls -> 'Unknown'."""
    from skyledger.operators.ranking import exact_quantiles
    out = df
    for c in numeric:
        med = exact_quantiles(df, c, [0.5], [f"_{c}_med"], digits=6)
        out = out.crossJoin(F.broadcast(med)).withColumn(
            c, F.coalesce(F.col(c).cast("double"), F.col(f"_{c}_med"))).drop(f"_{c}_med")
    return out.fillna({c: text_fill for c in text})


def format_prediction(df: DataFrame, col: str = "predicted_fare") -> DataFrame:
    return df.withColumn(f"{col}_formatted", format_bdt(col))

