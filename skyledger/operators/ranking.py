"""Order statistics without a single-task sort.

``row_number() over (order by ...)`` without a partition, or a per-group
window, pulls a whole table (or a whole hot group) into one task. These
operators range-partition on (group, order) keys instead, so one group can
span many tasks, and rebuild positions from per-task counts (a few rows
per task):

1. range-partition and sort on (group, order); tag each row with its task
   and position in the task; checkpoint, so the tags stay fixed if work is
   re-run (range bounds come from sampling and would move on a re-run);
2. count rows per (task, group): a running sum gives each group's offset in
   each task;
3. row index = offset + position - first position of the group in the task.

Quantiles are taken from counts per (group, value), so equal values can't
overload a task, and from the few task slices that hold a wanted position.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skyledger.session import scan_tasks, setting

_LOCAL_BITS = 33  # monotonically_increasing_id = task index << 33 | row position
BROADCAST_MAX_ROWS = 2_000_000
ROWS_PER_TASK = 500_000  # wide rows a task may sort: some 600 bytes each in memory


def partitions_for(spark: SparkSession, rows: int) -> int:
    """Tasks for a shuffle of ``rows`` wide rows: the session's number, or more
    where a task would get over ``ROWS_PER_TASK``, so that no sort outgrows memory."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // ROWS_PER_TASK))


def join_small(big: DataFrame, small: DataFrame, on, how: str = "inner",
               max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Join with ``small`` broadcast only after checking its row count.

    Above ``max_rows`` it falls back to a shuffle join (AQE may still
    broadcast from measured sizes). ``small`` should be cached or cheap:
    it is counted once.
    """
    n = small.count()
    side = F.broadcast(small) if n <= max_rows else small
    return big.join(side, on, how)


def _partitions(df: DataFrame, num_partitions: int | None) -> int:
    if num_partitions:
        return num_partitions
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _null_safe(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]]) -> Column:
    cond = None
    for lc, rc in pairs:
        e = left[lc].eqNullSafe(right[rc])
        cond = e if cond is None else cond & e
    return cond


def _tag_and_count(df: DataFrame, order_cols: Sequence[str], group_cols: Sequence[str],
                   num_partitions: int | None) -> tuple[DataFrame, DataFrame]:
    """(tagged rows with ``_pid``/``_loc``, per (task, group) stats with
    ``_cnt``, ``_first`` and ``_before``). Stats are cached: they are small
    (tasks + groups rows) and recomputable from the checkpoint."""
    keys = [F.col(c).asc_nulls_first() for c in [*group_cols, *order_cols]]
    tagged = (df.repartitionByRange(_partitions(df, num_partitions), *keys)
              .sortWithinPartitions(*keys)
              .withColumn("_mid", F.monotonically_increasing_id())
              .checkpoint(eager=True))
    tagged = tagged.select(
        *[c for c in tagged.columns if c != "_mid"],
        F.shiftright("_mid", _LOCAL_BITS).alias("_pid"),
        F.col("_mid").bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1)).alias("_loc"))
    stats = tagged.groupBy("_pid", *group_cols).agg(
        F.count(F.lit(1)).alias("_cnt"), F.min("_loc").alias("_first"))
    before = (Window.partitionBy(*group_cols).orderBy("_pid")
              .rowsBetween(Window.unboundedPreceding, -1))
    stats = stats.withColumn("_before", F.coalesce(F.sum("_cnt").over(before), F.lit(0))).cache()
    return tagged, stats


def range_rank(df: DataFrame, order_cols: Sequence[str], group_cols: Sequence[str] = (),
               rank_col: str = "_rank", num_partitions: int | None = None
               ) -> tuple[DataFrame, DataFrame]:
    """0-based position of every row within its group, in ``order_cols`` order
    (nulls first). Returns ``(ranked, sizes)``; ``sizes`` has ``_n`` per group."""
    tagged, stats = _tag_and_count(df, order_cols, group_cols, num_partitions)
    sizes = stats.groupBy(*group_cols).agg(F.sum("_cnt").alias("_n"))
    s = stats.select(*[F.col(c).alias(f"_s_{c}") for c in ["_pid", *group_cols]], "_before", "_first")
    n = s.count()  # tasks x groups present in them
    side = F.broadcast(s) if n <= BROADCAST_MAX_ROWS else s
    cond = tagged["_pid"] == side["_s__pid"]
    if group_cols:
        cond = cond & _null_safe(tagged, side, [(c, f"_s_{c}") for c in group_cols])
    ranked = (tagged.join(side, cond)
              .withColumn(rank_col, F.col("_before") + F.col("_loc") - F.col("_first"))
              .drop("_pid", "_loc", "_before", "_first", *[f"_s_{c}" for c in ["_pid", *group_cols]]))
    return ranked, sizes


def sequence_index(df: DataFrame, order_cols: Sequence[str], name: str = "row_index",
                   num_partitions: int | None = None) -> DataFrame:
    """Dense 0-based row index by a total order (a distributed zipWithIndex).

    Equal to ``row_number() over (order by order_cols nulls first) - 1``;
    rows equal on every order column are interchangeable, so ordering by all
    columns makes the assignment reproducible. The offsets table has one
    row per task, so it is always broadcast.
    """
    ranked, _ = range_rank(df, order_cols, (), rank_col=name, num_partitions=num_partitions)
    return ranked


def exact_quantiles(df: DataFrame, value_col: str, probs: Sequence[float],
                    names: Sequence[str], group_cols: Sequence[str] = (),
                    num_partitions: int | None = None, digits: int | None = None) -> DataFrame:
    """Exact linearly interpolated quantiles (pandas ``quantile`` semantics).

    One row per group (one row overall without groups), a double column per
    probability. Position ``h = (n - 1) * p`` is interpolated as
    ``v[floor h] + (h - floor h) * (v[ceil h] - v[floor h])``; nulls and NaN
    are skipped. ``digits`` rounds the results (removes last-ulp noise).

    Rows are first counted per (group, value), map-side: equal values, however
    many, are one row. Scan and counts take tasks by the number of rows, so that
    no task's counts grow with the table. Only those counts are dealt out by range and kept; their
    sums per task tell which task holds each position, and only those tasks'
    slices of a group are summed up value by value.
    """
    g, spark = list(group_cols), df.sparkSession
    data = (df.select(*g, F.col(value_col).cast("double").alias("_v"))
            .where(F.col("_v").isNotNull() & ~F.isnan("_v"))  # NaN is missing, as in pandas
            .groupBy(*g, "_v").agg(F.count(F.lit(1)).alias("_w")))
    keys = [F.col(c).asc_nulls_first() for c in [*g, "_v"]]
    n = num_partitions or partitions_for(spark, df.count())
    with scan_tasks(spark, n), setting(spark, "spark.sql.shuffle.partitions", str(n)):
        counts = (data.repartitionByRange(n, *keys)
                  .withColumn("_pid", F.spark_partition_id())
                  .checkpoint(eager=True))  # range bounds are sampled and would move on a re-run

    group = Window.partitionBy(*g)
    before = group.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    stats = (counts.groupBy("_pid", *g).agg(F.sum("_w").alias("_cnt"))  # one row per task and group in it
             .withColumn("_before", F.coalesce(F.sum("_cnt").over(before), F.lit(0)))
             .withColumn("_n", F.sum("_cnt").over(group)))
    spec = F.array(*[F.struct(F.lit(i).alias("q"), F.lit(float(p)).alias("p")) for i, p in enumerate(probs)])
    h = (F.col("_n") - 1) * F.col("_t.p")
    asks = (stats.select("*", F.explode(spec).alias("_t"))
            .select("_pid", *g, "_before", "_cnt", F.explode(F.array(*[
                F.struct(F.col("_t.q").alias("q"), h.alias("h"), F.lit(upper).alias("upper"), edge(h).alias("pos"))
                for upper, edge in ((False, F.floor), (True, F.ceil))])).alias("_a"))
            .where((F.col("_a.pos") >= F.col("_before")) & (F.col("_a.pos") < F.col("_before") + F.col("_cnt")))
            .groupBy("_pid", *g, "_before").agg(F.collect_list("_a").alias("_asks")))  # at most 2 x len(probs) each
    asks = asks.select(F.col("_pid").alias("_a_pid"), *[F.col(c).alias(f"_a_{c}") for c in g], "_before", "_asks")

    cond = counts["_pid"] == asks["_a_pid"]
    if g:
        cond = cond & _null_safe(counts, asks, [(c, f"_a_{c}") for c in g])
    upto = Window.partitionBy("_pid", *g).orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    met = (counts.join(asks, cond)
           .withColumn("_end", F.col("_before") + F.sum("_w").over(upto))
           .select(*g, "_v", "_w", "_end", F.explode("_asks").alias("_a"))
           .where((F.col("_a.pos") < F.col("_end")) & (F.col("_a.pos") >= F.col("_end") - F.col("_w"))))

    def value(i: int) -> Column:
        mine = F.col("_a.q") == i
        lo = F.max(F.when(mine & ~F.col("_a.upper"), F.col("_v")))
        hi = F.max(F.when(mine & F.col("_a.upper"), F.col("_v")))
        at = F.max(F.when(mine, F.col("_a.h")))
        val = lo + (at - F.floor(at)) * (hi - lo)
        return val if digits is None else F.round(val, digits)

    return met.groupBy(*g).agg(*[value(i).alias(name) for i, name in enumerate(names)])
