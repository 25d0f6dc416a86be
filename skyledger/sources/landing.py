"""Landing table whose row ids come from a single sorted write.

A run's rows are range-partitioned and sorted by the raw columns, tagged
with ``_pos`` = (task index << 33 | position in task) and written once; the
write is the durable copy, so positions cannot move if work is re-run.
A tiny side table (one row per task) holds each task's offset in the run,
and readers derive ``id = offset + position`` with a count-checked
broadcast join. Both tables carry the id of the write they belong to; a row
whose write has no offsets (a run that broke off between the two writes) ends
the read with an error instead of being left out. Compared with numbering first (checkpoint) and writing the
landing table afterwards, this saves one full write and read of the run.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from skyledger.operators.ranking import join_small
from skyledger.sources.csv import ID_ORDER, typed_raw
from skyledger.sources.tables import RUN_COL, append_run, scan_run

POS, WRITE = "_pos", "_write"
_BITS = 33


def offsets_path(path: str) -> str:
    return path.rstrip("/") + "_offsets"


def land_run(df: DataFrame, run_id: str, path: str, with_clock: bool = True,
             extra_cols: tuple[str, ...] = (), num_partitions: int | None = None) -> dict:
    """Type, sort, tag and append one run; then store its per-task offsets.

    Returns ``{"run_id", "rows"}`` (the count is observed during the write).
    """
    spark = df.sparkSession
    raw = typed_raw(df, extra_cols)
    keys = [F.col(c).asc_nulls_first() for c in ID_ORDER if c in raw.columns]
    write = uuid.uuid4().hex
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    tagged = (raw.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
              .withColumn(POS, F.monotonically_increasing_id())
              .withColumn(WRITE, F.lit(write)).withColumn(RUN_COL, F.lit(run_id)))
    if with_clock:
        tagged = tagged.withColumn("load_timestamp", F.current_timestamp())
    obs = Observation("landed")
    append_run(tagged.observe(obs, F.count(F.lit(1)).alias("rows")), path)

    # per-task counts from the stored positions of this run (one bigint column)
    tasks = (scan_run(spark, path, run_id).select(F.shiftright(POS, _BITS).alias("_task"))
             .groupBy("_task").agg(F.count(F.lit(1)).alias("_cnt")))
    before = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)  # <= tasks rows
    offs = tasks.select("_task", F.coalesce(F.sum("_cnt").over(before), F.lit(0)).alias("_before"),
                        F.lit(write).alias(WRITE), F.lit(run_id).alias(RUN_COL))
    append_run(offs, offsets_path(path))
    return {"run_id": run_id, "rows": int(obs.get["rows"])}


def scan_landing(spark: SparkSession, path: str, run_id: str | None = None) -> DataFrame:
    """Landing rows of one run (or all runs) with their ``id``."""
    raw = scan_run(spark, path, run_id).withColumn("_task", F.shiftright(POS, _BITS))
    offs = scan_run(spark, offsets_path(path), run_id)  # tasks x runs rows
    j = join_small(raw, offs, [RUN_COL, WRITE, "_task"], "left")
    lost = F.raise_error(F.concat(F.lit("no offsets for landing run "), RUN_COL, F.lit(": land it again")))
    ident = F.when(F.col("_before").isNull(), lost.cast("bigint")).otherwise(F.col("_before")) + F.col(POS).bitwiseAND(F.lit((1 << _BITS) - 1))
    cols = [c for c in raw.columns if c not in (POS, WRITE, "_task")]
    return j.select(ident.alias("id"), *cols)
