"""Bookings feed derived from the driver's TPC-H-style tables.

The source project reads one CSV of flight bookings. The test harness ships
TPC-H-style parquet instead, so this module maps those tables onto the raw
bookings columns (a fixed recipe shared with the DuckDB oracle). Work grows
with ``lineitem``: one booking per line item.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.operators.ranking import join_small, partitions_for
from skyledger.schemas import FARE


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def booking_count(spark: SparkSession, sf_dir: str) -> int:
    """Line items, counted from the files' footers; as many bookings where every key is met once."""
    return read_table(spark, sf_dir, "lineitem").count()


def booking_partitions(spark: SparkSession, sf_dir: str) -> int:
    """Tasks for a shuffle of all bookings."""
    return partitions_for(spark, booking_count(spark, sf_dir))


def tpch_bookings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw bookings (RAW_COLUMNS + booking_key), one row per line item.

    Join plan: ``orders`` meets ``customer`` first (both keyed by customer),
    then the line items join on order key, part and supplier attributes on
    their keys. ``nation`` is the only explicit broadcast: TPC-H fixes it at
    25 rows. Every other strategy is left to AQE, which broadcasts a side only
    after measuring it below the threshold and otherwise sort-merge joins.
    Where the session's number of shuffle tasks is too small for the line items,
    both sides of the large joins are dealt to more, and the suppliers, if their
    count allows, are broadcast to spare a shuffle of all line items.
    """
    n = booking_partitions(spark, sf_dir)
    grown = n > int(spark.conf.get("spark.sql.shuffle.partitions"))

    def dealt(df: DataFrame, key: str) -> DataFrame:
        return df.repartition(n, key) if grown else df

    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_tax", "l_returnflag", "l_shipdate")
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    cust = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type")
    supp = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    src_nation = F.broadcast(nation.select(F.col("n_nationkey").alias("s_nationkey"),
                                           F.col("n_name").alias("source")))
    dst_nation = F.broadcast(nation.select(F.col("n_nationkey").alias("c_nationkey"),
                                           F.col("n_name").alias("destination")))

    order_side = (orders.join(cust, orders.o_custkey == cust.c_custkey)
                  .join(dst_nation, "c_nationkey")
                  .select("o_orderkey", "o_orderstatus", "destination"))
    supp_side = supp.join(src_nation, "s_nationkey").select("s_suppkey", "source")

    j = dealt(li, "l_orderkey").join(dealt(order_side, "o_orderkey"), F.col("l_orderkey") == F.col("o_orderkey"))
    j = dealt(j, "l_partkey").join(dealt(part, "p_partkey"), F.col("l_partkey") == F.col("p_partkey"))
    with_supplier = F.col("l_suppkey") == F.col("s_suppkey")
    j = join_small(j, supp_side, with_supplier) if grown else j.join(supp_side, with_supplier)

    dep = F.col("l_shipdate") + F.make_dt_interval(hours=(F.col("l_partkey") % 24).cast("int"))
    arr = dep + F.make_dt_interval(mins=(F.col("l_quantity") * 20).cast("int"))
    price = F.col("l_extendedprice").cast("decimal(12,2)")
    sign = F.when(F.col("l_returnflag") == "R", F.lit(-1)).otherwise(F.lit(1))
    base = (sign * price).cast(FARE)
    tax = F.when(F.col("l_tax") == 0, F.lit(None).cast(FARE)).otherwise(
        (price * F.col("l_tax").cast("decimal(4,2)")).cast(FARE))
    stops = (F.when(F.col("l_linenumber") % 3 == 0, "Direct")
             .when(F.col("l_linenumber") % 3 == 1, "1 Stop").otherwise("2 Stops"))
    klass = (F.when(F.col("o_orderstatus") == "F", "Economy")
             .when(F.col("o_orderstatus") == "O", "Business").otherwise("First Class"))
    channel = (F.when(F.col("l_returnflag") == "A", "Direct Booking")
               .when(F.col("l_returnflag") == "N", "Online Website").otherwise("Travel Agency"))

    return j.select(
        F.col("p_brand").alias("airline"),
        "source",
        "destination",
        dep.alias("departure_time"),
        arr.alias("arrival_time"),
        (F.col("l_quantity") / F.lit(3.0)).alias("duration"),
        stops.alias("stops"),
        F.col("p_type").alias("aircraft_type"),
        klass.alias("booking_class"),
        channel.alias("booking_source"),
        ((F.col("l_partkey") * 7 + F.col("l_orderkey")) % 90 + 1).cast("bigint").alias("days_before_departure"),
        F.lit(None).cast("string").alias("seasonality"),
        base.alias("base_fare"),
        tax.alias("tax_and_surcharge"),
        (base + tax).cast(FARE).alias("total_fare"),
        F.col("l_orderkey").alias("booking_key"),
    )
