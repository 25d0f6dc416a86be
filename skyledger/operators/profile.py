"""Column profiling: the tables behind the EDA plots.

Wide-to-long first: ``unpivot`` turns N columns into (column_name, value)
rows inside the scan's codegen stage, so per-column statistics (quantiles,
counts, outliers, value counts) are one grouped job for all columns rather
than one job per column. Exact quantiles use the range-partitioned ranking
in :mod:`skyledger.operators.ranking`, so a large column (or group) is
split across tasks instead of sorted in one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyledger.functions.fares import decimal_avg_rounded
from skyledger.operators.ranking import exact_quantiles
from skyledger.schemas import HISTOGRAM_BINS, IQR_FENCE

Q_DIGITS = 6  # quantiles of 2-decimal fares are exact at 4 decimals; 6 drops float noise

ID_COLUMNS = ("id", "raw_id")


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ID_COLUMNS) -> list[str]:
    """Numeric columns by schema (ids excluded)."""
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.NumericType) and f.name not in exclude]


def string_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.StringType) and f.name not in exclude]


def dtype_summary(df: DataFrame) -> list[dict]:
    """Column kind from the schema; flags text columns that look like dates."""
    out = []
    for f in df.schema.fields:
        kind = "categorical" if isinstance(f.dataType, T.StringType) else "numerical"
        needs = isinstance(f.dataType, T.StringType) and ("date" in f.name or "time" in f.name)
        out.append({"column_name": f.name, "dtype": f.dataType.simpleString(),
                    "kind": kind, "needs_datetime_parsing": needs})
    return out


def preview(df: DataFrame, order_cols: Sequence[str], n: int = 5) -> DataFrame:
    """First ``n`` rows by an explicit order (a ``head()`` that is reproducible)."""
    return df.orderBy(*order_cols).limit(n)


def to_long(df: DataFrame, cols: Sequence[str], value_type: str = "double") -> DataFrame:
    """(column_name, value) rows for the listed columns; null values dropped."""
    typed = df.select(*[F.col(c).cast(value_type).alias(c) for c in cols])
    return (typed.unpivot([], list(cols), "column_name", "value")
            .where(F.col("value").isNotNull()))


def profile_nonnull(df: DataFrame) -> DataFrame:
    """Non-null count per column (``.info()``), one aggregate pass."""
    agg = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count(c).alias(f"_c{i}") for i, c in enumerate(df.columns)])
    return agg.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"_c{i}").alias("non_null"), F.col("_rows").alias("rows"))
        for i, c in enumerate(df.columns)])))


def missing_report(df: DataFrame) -> DataFrame:
    """Missing count and % per column, only columns with missing values."""
    agg = df.agg(F.count(F.lit(1)).alias("_rows"),
                 *[F.count_if(F.col(c).isNull()).alias(f"_m{i}") for i, c in enumerate(df.columns)])
    rows = agg.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"_m{i}").alias("missing_count"), F.col("_rows").alias("_rows"))
        for i, c in enumerate(df.columns)])))
    return (rows.where(F.col("missing_count") > 0)
            .select("column_name", "missing_count",
                    F.round(F.try_divide(F.col("missing_count").cast("double"), F.col("_rows")) * 100, 2).alias("missing_pct"))
            .orderBy(F.desc("missing_pct"), "column_name"))


def column_quartiles(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Exact q25 / q50 / q75 per numeric column in one range-sorted pass."""
    cols = numeric_columns(df) if cols is None else list(cols)
    return exact_quantiles(to_long(df, cols), "value", [0.25, 0.5, 0.75], ["q25", "q50", "q75"],
                           ["column_name"], digits=Q_DIGITS)


def describe_numeric(df: DataFrame, cols: Sequence[str] | None = None,
                     quartiles: DataFrame | None = None) -> DataFrame:
    """count, mean, std (sample), min, 25/50/75% (exact, linear), max per column."""
    cols = numeric_columns(df) if cols is None else list(cols)
    long = to_long(df, cols)
    moments = long.groupBy("column_name").agg(
        F.count("value").alias("count"),
        F.round(F.avg("value"), 4).alias("mean"),
        F.round(F.stddev_samp("value"), 4).alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"))
    q = column_quartiles(df, cols) if quartiles is None else quartiles
    return moments.join(q, "column_name").select(
        "column_name", "count", "mean", "std", "min", "q25", "q50", "q75", "max")


def describe_categorical(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """count, unique, top (ties -> smallest value), freq per text column."""
    cols = string_columns(df) if cols is None else list(cols)
    counts = to_long(df, cols, "string").groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy("column_name").agg(
        F.sum("n").alias("count"), F.count(F.lit(1)).alias("unique"),
        F.min_by("value", F.struct((-F.col("n")).alias("k"), F.col("value").alias("v"))).alias("top"),
        F.max("n").alias("freq"))


def value_counts(df: DataFrame, cols: Sequence[str] | None = None, max_unique: int = 25) -> DataFrame:
    """Value counts of low-cardinality text columns (date/time/name columns skipped)."""
    if cols is None:
        cols = [c for c in string_columns(df)
                if not any(k in c for k in ("date", "time", "name"))]
    counts = to_long(df, cols, "string").groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("count"))
    # cardinality per column: one row per profiled column, so the broadcast is bounded
    card = counts.groupBy("column_name").agg(F.count(F.lit(1)).alias("_u"))
    keep = card.where(F.col("_u") <= max_unique).select("column_name")
    return counts.join(F.broadcast(keep), "column_name", "left_semi")


def fare_distribution(df: DataFrame, col: str = "total_fare") -> DataFrame:
    q = exact_quantiles(df, col, [0.25, 0.75], ["q1", "q3"], digits=Q_DIGITS)
    return q.select("q1", "q3", (F.col("q3") - F.col("q1")).alias("iqr"))


def iqr_outliers(df: DataFrame, cols: Sequence[str] | None = None, fence: float = IQR_FENCE,
                 quartiles: DataFrame | None = None) -> DataFrame:
    """Per numeric column: quartiles, fences and rows outside ``q1 - k*iqr, q3 + k*iqr``.

    The fences are one row per column (bounded by the column count), joined
    back to the long table by broadcast.
    """
    cols = numeric_columns(df) if cols is None else list(cols)
    long = to_long(df, cols)
    if quartiles is None:
        q = exact_quantiles(long, "value", [0.25, 0.75], ["q1", "q3"], ["column_name"], digits=Q_DIGITS)
    else:
        q = quartiles.select("column_name", F.col("q25").alias("q1"), F.col("q75").alias("q3"))
    q = q.select("column_name", "q1", "q3", (F.col("q3") - F.col("q1")).alias("iqr"))
    q = q.select("*", (F.col("q1") - fence * F.col("iqr")).alias("lower_fence"),
                 (F.col("q3") + fence * F.col("iqr")).alias("upper_fence"))
    flagged = long.join(F.broadcast(q), "column_name").groupBy("column_name").agg(
        F.count_if((F.col("value") < F.col("lower_fence")) | (F.col("value") > F.col("upper_fence"))).alias("outliers"))
    return q.join(flagged, "column_name")


def corr_target(df: DataFrame, target: str = "total_fare", cols: Sequence[str] | None = None) -> DataFrame:
    """Pearson correlation of every numeric column with the target (one pass)."""
    cols = [c for c in (numeric_columns(df) if cols is None else cols)]
    agg = df.agg(*[F.corr(F.col(c).cast("double"), F.col(target).cast("double")).alias(f"_r{i}")
                   for i, c in enumerate(cols)])
    return (agg.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.round(F.col(f"_r{i}"), 4).alias("corr"))
        for i, c in enumerate(cols)]))).orderBy(F.desc_nulls_last("corr"), "column_name"))


def corr_matrix(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Lower triangle (a, b, r) of the correlation matrix, all pairs in one aggregate."""
    cols = numeric_columns(df) if cols is None else list(cols)
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[:i]]
    agg = df.agg(*[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"_p{k}")
                   for k, (a, b) in enumerate(pairs)])
    return agg.select(F.inline(F.array(*[
        F.struct(F.lit(a).alias("col_a"), F.lit(b).alias("col_b"), F.round(F.col(f"_p{k}"), 4).alias("corr"))
        for k, (a, b) in enumerate(pairs)])))


def histogram(df: DataFrame, col: str = "total_fare", bins: int = HISTOGRAM_BINS) -> DataFrame:
    """Equal-width bins on the linear and on the log10 scale (positive values).

    bin = least(floor((x - lo) * bins / (hi - lo)), bins - 1); the (lo, hi)
    row is a one-row aggregate cross-joined in by broadcast.
    """
    x = F.col(col).cast("double")
    lin = df.select(F.lit("linear").alias("scale"), x.alias("x")).where(F.col("x").isNotNull())
    log = (df.where(x > 0).select(F.lit("log10").alias("scale"), F.log10(x).alias("x")))
    both = lin.unionByName(log)
    rng = both.groupBy("scale").agg(F.min("x").alias("lo"), F.max("x").alias("hi"))
    width = F.col("hi") - F.col("lo")
    b = F.when(width == 0, F.lit(0)).otherwise(
        F.least(F.floor((F.col("x") - F.col("lo")) * bins / width), F.lit(bins - 1))).cast("int")
    binned = both.join(F.broadcast(rng), "scale").select("scale", "lo", "hi", b.alias("bin"))
    return binned.groupBy("scale", "bin").agg(
        F.count(F.lit(1)).alias("count"),
        F.first("lo").alias("_lo"), F.first("hi").alias("_hi")).select(
        "scale", "bin",
        F.round(F.col("_lo") + F.col("bin") * (F.col("_hi") - F.col("_lo")) / bins, 6).alias("bin_start"),
        F.round(F.col("_lo") + (F.col("bin") + 1) * (F.col("_hi") - F.col("_lo")) / bins, 6).alias("bin_end"),
        "count")


def fare_skew(df: DataFrame, col: str = "total_fare") -> DataFrame:
    """Bias-adjusted sample skewness (what pandas ``skew`` reports)."""
    n = F.count(col).cast("double")
    g1 = F.skewness(F.col(col).cast("double"))
    return df.agg(F.round(g1 * F.sqrt(n * (n - 1)) / (n - 2), 4).alias("skew"), F.count(col).alias("n"))


def fare_summary(df: DataFrame, col: str = "total_fare") -> DataFrame:
    """Rows, mean, median and sample std of the fare."""
    stats = df.agg(F.count(F.lit(1)).alias("rows"), decimal_avg_rounded(col, 2).alias("mean_fare"),
                   F.round(F.stddev_samp(F.col(col).cast("double")), 2).alias("std_fare"))
    med = exact_quantiles(df, col, [0.5], ["median_fare"], digits=Q_DIGITS)
    return stats.crossJoin(med)  # one row x one row


def grouped_fare_stats(df: DataFrame, group: str, col: str = "total_fare", digits: int = 0) -> DataFrame:
    """mean / median / std of the fare per group, rounded (airline pricing table)."""
    g = df.where(F.col(group).isNotNull())
    stats = g.groupBy(group).agg(decimal_avg_rounded(col, digits).alias("mean_fare"),
                                 F.round(F.stddev_samp(F.col(col).cast("double")), digits).alias("std_fare"))
    med = exact_quantiles(g, col, [0.5], ["_median"], [group], digits=Q_DIGITS)
    return stats.join(med, group, "left").select(
        group, "mean_fare", F.round("_median", digits).alias("median_fare"), "std_fare")


def median_by_dims(df: DataFrame, dims: Sequence[str] = ("season_label", "airline"),
                   col: str = "total_fare") -> DataFrame:
    """Median fare per value of each dimension, stacked (dimension, value, median)."""
    long = (df.select(col, *dims)
            .unpivot([col], list(dims), "dimension", "value")
            .where(F.col("value").isNotNull()))
    med = exact_quantiles(long, col, [0.5], ["median_fare"], ["dimension", "value"], digits=Q_DIGITS)
    return med.orderBy("dimension", F.desc("median_fare"), "value")


def box_stats(df: DataFrame, dims: Sequence[str] = ("season_label", "airline"),
              col: str = "total_fare", fence: float = IQR_FENCE) -> DataFrame:
    """Box-plot numbers per group: quartiles, whiskers (most extreme values
    inside the fences) and the outlier count."""
    long = (df.select(F.col(col).cast("double").alias("x"), *dims)
            .unpivot(["x"], list(dims), "dimension", "value")
            .where(F.col("value").isNotNull() & F.col("x").isNotNull()))
    q = exact_quantiles(long, "x", [0.25, 0.5, 0.75], ["q1", "median", "q3"], ["dimension", "value"],
                        digits=Q_DIGITS)
    q = q.select("*", (F.col("q3") - F.col("q1")).alias("iqr"))
    lo = F.col("q1") - fence * F.col("iqr")
    hi = F.col("q3") + fence * F.col("iqr")
    j = long.join(F.broadcast(q), ["dimension", "value"])
    inside = (F.col("x") >= lo) & (F.col("x") <= hi)
    return j.groupBy("dimension", "value", "q1", "median", "q3", "iqr").agg(
        F.count(F.lit(1)).alias("n"), F.min("x").alias("min"), F.max("x").alias("max"),
        F.min(F.when(inside, F.col("x"))).alias("lower_whisker"),
        F.max(F.when(inside, F.col("x"))).alias("upper_whisker"),
        F.count_if(~inside).alias("outliers"))


def profile(df: DataFrame, target: str = "total_fare") -> dict[str, DataFrame]:
    """All profile tables for one frame. Quantiles checkpoint their counts, so
    building the tables runs jobs; no rows are collected.

    Describe and outlier tables share one quartile pass.
    """
    quart = column_quartiles(df)
    return {
        "profile_nonnull": profile_nonnull(df),
        "missing_report": missing_report(df),
        "describe_numeric": describe_numeric(df, quartiles=quart),
        "describe_categorical": describe_categorical(df),
        "value_counts": value_counts(df),
        "fare_distribution": fare_distribution(df, target),
        "iqr_outliers": iqr_outliers(df, quartiles=quart),
        "corr_target": corr_target(df, target),
        "corr_matrix": corr_matrix(df),
        "fare_histogram": histogram(df, target),
        "fare_skew": fare_skew(df, target),
        "fare_summary": fare_summary(df, target),
    }
