"""KPI marts: the three SQL marts, the five run-scoped KPIs and report queries.

Scale notes
-----------
* Every KPI starts from a hash aggregate (partial aggregate in the map task,
  then final), so only one row per key per task crosses the shuffle, however
  hot a key is. Windows run on aggregated rows (routes x airlines at most),
  never on bookings.
* The route KPIs roll up from one route x airline aggregate
  (:func:`route_airline_agg`) instead of rescanning the fact.
* Top-N uses ``orderBy().limit()`` (TakeOrderedAndProject: a bounded heap
  per task); first-per-group uses ``min_by`` inside the aggregate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skyledger.functions.dates import peak_month_label
from skyledger.functions.fares import decimal_avg, decimal_avg_rounded, mean_rounded, route_label, safe_div
from skyledger.schemas import TOP_N_ROUTES

STG_COLUMNS = [
    "airline", "source", "destination", "departure_time", "arrival_time",
    "duration", "stops", "base_fare", "tax_and_surcharge", "total_fare",
    "booking_class", "pipeline_run_id", "load_timestamp",
]


def _run_col(run_id):
    return [F.lit(run_id).alias("pipeline_run_id")] if run_id is not None else []


def _avg(c):
    return decimal_avg(c)


def stg_bookings(validated: DataFrame, with_clock: bool = True) -> DataFrame:
    """Staging projection the SQL marts read (columns that exist, fixed order)."""
    cols = [c for c in STG_COLUMNS if c in validated.columns
            and (with_clock or c != "load_timestamp")]
    return validated.select(*cols)


# --- the three SQL marts (all runs; NULL keys form their own group) ---------

def kpi_avg_fare(stg: DataFrame) -> DataFrame:
    return stg.groupBy("airline").agg(_avg("total_fare").alias("avg_fare"),
                                      F.count(F.lit(1)).alias("bookings"))


def kpi_popular_routes(stg: DataFrame) -> DataFrame:
    return (stg.groupBy("source", "destination")
            .agg(F.count(F.lit(1)).alias("bookings"), _avg("total_fare").alias("avg_fare"))
            .orderBy(F.desc("bookings"), "source", "destination"))


def kpi_seasonal_variation(stg: DataFrame) -> DataFrame:
    return (stg.withColumn("season", peak_month_label("departure_time"))
            .groupBy("airline", "season").agg(_avg("total_fare").alias("avg_fare")))


# --- run-scoped KPIs (NULL keys dropped, like a pandas groupby) -------------

def kpi_avg_fare_by_airline(v: DataFrame, run_id: str | None = None) -> DataFrame:
    return (v.where(F.col("airline").isNotNull()).groupBy("airline").agg(
        decimal_avg_rounded("base_fare", 2).alias("avg_base_fare"),
        decimal_avg_rounded("tax_and_surcharge", 2).alias("avg_tax"),
        decimal_avg_rounded("total_fare", 2).alias("avg_total_fare"),
        F.min("total_fare").alias("min_fare"),
        F.max("total_fare").alias("max_fare"),
        F.count("total_fare").alias("booking_count"))
        .select("*", *_run_col(run_id)))


def kpi_seasonal_premium(v: DataFrame, run_id: str | None = None) -> DataFrame:
    """Average fare per (airline, season, peak flag) and its premium over the
    airline's off-peak average (from unrounded averages; zero baseline -> null).

    The off-peak baseline pools every off-peak row of the airline, so an
    airline with several off-peak labels still gets one baseline.
    """
    g = (v.where(F.col("airline").isNotNull() & F.col("season_label").isNotNull()
                 & F.col("is_peak_season").isNotNull())
         .groupBy("airline", "season_label", "is_peak_season")
         .agg(F.sum("total_fare").alias("_sum"), F.count("total_fare").alias("booking_count")))
    w = Window.partitionBy("airline")
    off = F.col("is_peak_season") == 0
    base = safe_div(F.sum(F.when(off, F.col("_sum"))).over(w),
                    F.sum(F.when(off, F.col("booking_count"))).over(w))
    avg = safe_div(F.col("_sum"), F.col("booking_count"))
    return g.select(
        "airline", "season_label", F.col("is_peak_season").alias("is_peak"),
        mean_rounded("_sum", "booking_count", 2).alias("avg_total_fare"), "booking_count",
        F.round(F.try_divide(avg - base, base) * F.lit(100.0), 2).alias("fare_premium_pct"),
        *_run_col(run_id))


def kpi_booking_count(v: DataFrame, run_id: str | None = None) -> DataFrame:
    """Bookings per airline, peak / off-peak split and market share.

    The share's denominator is every row of the run (also rows with a null
    airline or fare): a one-row total over the per-airline aggregate, joined
    back by broadcast. The plan scans the run twice.
    """
    g = v.groupBy("airline").agg(
        F.count(F.lit(1)).alias("_rows"),
        F.count("total_fare").alias("total_bookings"),
        F.count_if((F.col("is_peak_season") == 1) & F.col("total_fare").isNotNull()).alias("peak_bookings"))
    total = F.broadcast(g.agg(F.sum("_rows").alias("_all")))  # exactly one row
    return (g.crossJoin(total).where(F.col("airline").isNotNull())
            .select("airline", "total_bookings", "peak_bookings",
                    (F.col("total_bookings") - F.col("peak_bookings")).alias("offpeak_bookings"),
                    F.round(safe_div("total_bookings", "_all") * F.lit(100.0), 4).alias("market_share_pct"),
                    *_run_col(run_id)))


def route_airline_agg(v: DataFrame) -> DataFrame:
    """(source, destination, airline) aggregate the route KPIs roll up from.

    Rows with a null airline stay (they count toward route totals); rows with
    a null source or destination are dropped.
    """
    return (v.where(F.col("source").isNotNull() & F.col("destination").isNotNull())
            .groupBy("source", "destination", "airline")
            .agg(F.count(F.lit(1)).alias("n_rows"), F.count("total_fare").alias("n_fare"),
                 F.sum("total_fare").alias("sum_fare"), F.min("total_fare").alias("min_fare"),
                 F.max("total_fare").alias("max_fare")))


def kpi_route_airline(v: DataFrame, run_id: str | None = None, ra: DataFrame | None = None) -> DataFrame:
    ra = route_airline_agg(v) if ra is None else ra
    route_total = F.sum("n_fare").over(Window.partitionBy("source", "destination"))
    return (ra.where(F.col("airline").isNotNull())
            .withColumn("_route_total", route_total)
            .select("source", "destination", "airline",
                    F.col("n_fare").alias("booking_count"),
                    mean_rounded("sum_fare", "n_fare", 2).alias("avg_total_fare"),
                    F.round(safe_div("n_fare", "_route_total") * F.lit(100.0), 4).alias("route_share_pct"),
                    *_run_col(run_id)))


def _route_rollup(ra: DataFrame) -> DataFrame:
    # dominant airline: most rows on the route, ties -> alphabetically first
    known = F.col("airline").isNotNull()
    return ra.groupBy("source", "destination").agg(
        F.sum("n_fare").alias("booking_count"),
        F.sum("sum_fare").alias("_sum"),
        F.min("min_fare").alias("min_fare"),
        F.max("max_fare").alias("max_fare"),
        F.min_by(F.when(known, F.col("airline")),
                 F.when(known, F.struct((-F.col("n_rows")).alias("k"), F.col("airline").alias("a")))
                 ).alias("top_airline"))


def dominant_airline(v: DataFrame, ra: DataFrame | None = None) -> DataFrame:
    """Most-booked airline per route (ties broken by airline name)."""
    ra = route_airline_agg(v) if ra is None else ra
    return _route_rollup(ra).select("source", "destination", "top_airline")


def kpi_popular_routes_topn(v: DataFrame, run_id: str | None = None, top_n: int = TOP_N_ROUTES,
                            ra: DataFrame | None = None) -> DataFrame:
    """Top-N routes by bookings with fare stats, dominant airline, rank, label."""
    ra = route_airline_agg(v) if ra is None else ra
    routes = _route_rollup(ra)
    order = [F.desc("booking_count"), F.asc("source"), F.asc("destination")]
    top = routes.orderBy(*order).limit(top_n)
    rank = F.row_number().over(Window.orderBy(*order))  # over <= top_n rows
    return top.select(
        "source", "destination", "booking_count",
        mean_rounded("_sum", "booking_count", 2).alias("avg_total_fare"),
        "min_fare", "max_fare", "top_airline",
        rank.cast("bigint").alias("rank"), route_label().alias("route"), *_run_col(run_id))


def kpi_run_summary(v: DataFrame, run_id: str | None = None, top_n: int = TOP_N_ROUTES) -> DataFrame:
    """Run summary: rows, distinct airlines and routes, peak rows, rows per KPI.

    One aggregate at the finest KPI grain, then distinct counts over that
    small result (distinct counts skip keys with a null part).
    """
    fine = v.groupBy("source", "destination", "airline", "season_label", "is_peak_season").agg(
        F.count(F.lit(1)).alias("_rows"))
    s = fine.agg(
        F.sum("_rows").alias("total_rows"),
        F.count_distinct("airline").alias("airlines"),
        F.count_distinct("source", "destination").alias("routes"),
        F.sum(F.when(F.col("is_peak_season") == 1, F.col("_rows")).otherwise(0)).alias("peak_rows"),
        F.count_distinct("airline", "season_label", "is_peak_season").alias("kpi_seasonal_rows"),
        F.count_distinct("source", "destination", "airline").alias("kpi_route_airline_rows"),
    )
    return s.select(
        *_run_col(run_id),
        F.coalesce(F.col("total_rows"), F.lit(0)).cast("bigint").alias("total_rows"),
        "airlines", "routes",
        F.coalesce(F.col("peak_rows"), F.lit(0)).cast("bigint").alias("peak_rows"),
        F.col("airlines").alias("kpi_avg_fare_rows"),
        "kpi_seasonal_rows",
        F.col("airlines").alias("kpi_booking_count_rows"),
        F.least(F.col("routes"), F.lit(top_n).cast("bigint")).alias("kpi_popular_routes_rows"),
        "kpi_route_airline_rows")


def distinct_routes(v: DataFrame) -> DataFrame:
    return v.select("source", "destination").distinct()


# --- exploratory summaries ---------------------------------------------------

def airline_avg_fare(v: DataFrame) -> DataFrame:
    return (v.where(F.col("airline").isNotNull()).groupBy("airline")
            .agg(decimal_avg_rounded("total_fare", 2).alias("avg_fare"))
            .orderBy(F.desc("avg_fare"), "airline"))


def season_avg_fare(v: DataFrame, season_col: str = "season_label") -> DataFrame:
    return (v.where(F.col(season_col).isNotNull()).groupBy(F.col(season_col).alias("season"))
            .agg(decimal_avg_rounded("total_fare", 2).alias("avg_fare"),
                 F.count("total_fare").alias("bookings")))


def top_route(v: DataFrame) -> DataFrame:
    """Most frequent 'src → dst' route (ties -> alphabetically first)."""
    return (v.select(route_label().alias("route")).where(F.col("route").isNotNull())
            .groupBy("route").agg(F.count(F.lit(1)).alias("bookings"))
            .orderBy(F.desc("bookings"), "route").limit(1))


def expensive_routes(v: DataFrame, top_n: int = 5) -> DataFrame:
    """Routes with the highest mean fare (top 5 in the EDA, top 10 in the report)."""
    return (v.select(route_label().alias("route"), "total_fare").where(F.col("route").isNotNull())
            .groupBy("route").agg(decimal_avg_rounded("total_fare", 2).alias("avg_fare"))
            .orderBy(F.desc("avg_fare"), "route").limit(top_n))


def airline_fare_spread(v: DataFrame) -> DataFrame:
    """Spread of airline mean fares (means rounded to whole taka, as reported)."""
    means = (v.where(F.col("airline").isNotNull()).groupBy("airline")
             .agg(decimal_avg_rounded("total_fare", 0).alias("m")))
    return means.agg(
        F.max("m").alias("max_mean_fare"), F.min("m").alias("min_mean_fare"),
        (F.max("m") - F.min("m")).alias("spread"),
        F.round((safe_div(F.max("m"), F.min("m")) - 1) * 100, 1).alias("spread_pct"),
        F.max_by("airline", F.struct("m", F.col("airline"))).alias("highest_airline"),
        F.min_by("airline", F.struct("m", F.col("airline"))).alias("lowest_airline"))


def season_premium(v: DataFrame, season_col: str = "season_label", baseline: str = "Regular") -> DataFrame:
    """Mean fare per season and its % premium over the baseline season.

    The baseline is the 'Regular' season when present, else the cheapest
    season: a one-row aggregate over the per-season rows, broadcast back.
    """
    g = (v.where(F.col(season_col).isNotNull()).groupBy(F.col(season_col).alias("season"))
         .agg(_avg("total_fare").alias("_m"), decimal_avg_rounded("total_fare", 2).alias("avg_fare")))
    base = F.broadcast(g.agg(F.coalesce(F.max(F.when(F.col("season") == baseline, F.col("_m"))),
                                        F.min("_m")).alias("_base")))  # exactly one row
    return g.crossJoin(base).select(
        "season", "avg_fare", F.round((safe_div(F.col("_m"), F.col("_base")) - 1) * 100, 1).alias("premium_pct"))


def intl_counts(features: DataFrame) -> DataFrame:
    return features.agg(
        F.count_if(F.col("is_international") == 0).alias("domestic"),
        F.count_if(F.col("is_international") == 1).alias("international"))


# --- report queries over the marts (round half away from zero, fixed order) --

def report_top_routes(popular_routes: DataFrame, n: int = 10) -> DataFrame:
    return (popular_routes.select("source", "destination", "bookings",
                                  F.round("avg_fare", 2).alias("avg_fare"))
            .orderBy(F.desc("bookings"), "source", "destination").limit(n))


def report_avg_fare(avg_fare: DataFrame) -> DataFrame:
    return (avg_fare.select("airline", F.round("avg_fare", 2).alias("avg_fare"), "bookings")
            .orderBy(F.desc("avg_fare"), "airline"))


def report_seasonal(seasonal: DataFrame) -> DataFrame:
    return (seasonal.select("airline", "season", F.round("avg_fare", 2).alias("avg_fare"))
            .orderBy("airline", "season"))
