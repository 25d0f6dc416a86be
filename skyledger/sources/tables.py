"""Run-partitioned parquet tables: append, scan, replace, transfer."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from skyledger.session import setting

RUN_COL = "pipeline_run_id"


@dataclass(frozen=True)
class RunTable:
    """A parquet table partitioned by ``pipeline_run_id`` at ``path``."""

    path: str

    def scan(self, spark: SparkSession, run_id: str | None = None) -> DataFrame:
        return scan_run(spark, self.path, run_id)


def append_run(df: DataFrame, path: str) -> None:
    """Append the rows of one or more runs.

    Dynamic partition overwrite replaces only the runs present in ``df``, so
    re-running a failed or repeated run replaces its rows instead of
    duplicating them (the append is idempotent per run). A task keeps a few runs'
    files open, so its rows needn't be sorted by run first; beyond that Spark
    sorts the rest.
    """
    with setting(df.sparkSession, "spark.sql.maxConcurrentOutputFileWriters", "4"):
        (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(RUN_COL).parquet(path))


def scan_run(spark: SparkSession, path: str, run_id: str | None = None) -> DataFrame:
    """Rows of one run (partition pruning), or of all runs when ``run_id`` is None."""
    df = spark.read.parquet(path)
    return df if run_id is None else df.where(F.col(RUN_COL) == F.lit(run_id))


def replace_table(df: DataFrame, path: str, partition_cols: list[str] | None = None) -> None:
    """Replace a whole table (KPI marts are rebuilt, not appended)."""
    w = df.write.mode("overwrite")
    if partition_cols:
        w = w.partitionBy(*partition_cols)
    w.parquet(path)


def transfer_run(spark: SparkSession, src: str, dst: str, run_id: str,
                 columns: list[str] | None = None) -> dict:
    """Copy one run from ``src`` to ``dst``, keeping the listed columns that exist.

    Returns ``{"rows_transferred": n}``; the count is observed during the
    write instead of a second pass over the data.
    """
    df = select_existing(scan_run(spark, src, run_id), columns)
    if RUN_COL not in df.columns:
        df = df.withColumn(RUN_COL, F.lit(run_id))
    obs = Observation("transfer")
    append_run(df.observe(obs, F.count(F.lit(1)).alias("rows")), dst)
    return {"rows_transferred": int(obs.get["rows"])}


def select_existing(df: DataFrame, columns: list[str] | None) -> DataFrame:
    """Tolerant projection: keep the wanted columns that exist, in wanted order."""
    if not columns:
        return df
    return df.select(*[c for c in columns if c in df.columns])


def require_columns(df: DataFrame, columns: list[str]) -> None:
    """Raise ``KeyError`` naming the missing columns."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise KeyError(f"missing columns {missing}; available: {df.columns}")
