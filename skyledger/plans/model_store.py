"""Fitted models and their scores, kept under a digest of what they were fitted to.

The digest covers the feature rows (count and an order-free hash of all
columns), the model's presets and the split, so equal work is done once, by
whichever job comes first, and never reused for other rows. A model is usable
only once its score file is there, which is written last.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.session import checkpoint_dir

#: Session setting that names a lasting shared folder; without it models live as long as the checkpoint folder.
STORE_SETTING = "spark.skyledger.model.store"


def fingerprint(rows: DataFrame) -> str:
    """Count and order-free hash of the rows, in one pass."""
    r = rows.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64(*sorted(rows.columns))).alias("x"),
                 F.sum(F.xxhash64(*sorted(rows.columns)).cast("decimal(38,0)")).alias("s")).first()
    return f"{r.n}:{r.x}:{r.s}"


def digest(*parts) -> str:
    return hashlib.sha256(json.dumps(parts, sort_keys=True, default=str).encode()).hexdigest()[:32]


def _folder(spark: SparkSession) -> str:
    return (spark.conf.get(STORE_SETTING, None) or f"{checkpoint_dir(spark).rstrip('/')}/models").rstrip("/")


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def model(spark: SparkSession, key: str, fit: Callable[[], PipelineModel]) -> PipelineModel:
    """The model stored under ``key``; fitted and stored if it isn't there."""
    path = f"{_folder(spark)}/{key}/model"
    done = f"{_folder(spark)}/{key}/fitted"
    if not _exists(spark, f"{done}/_SUCCESS"):
        fit().write().overwrite().save(path)
        spark.createDataFrame([(key,)], "key string").coalesce(1).write.mode("overwrite").json(done)
    return PipelineModel.load(path)


def scores(spark: SparkSession, key: str, name: str, compute: Callable[[], dict]) -> dict:
    """The scores ``name`` stored under ``key``; computed and stored if they aren't there."""
    path = f"{_folder(spark)}/{key}/{name}"
    if not _exists(spark, f"{path}/_SUCCESS"):
        spark.createDataFrame([(json.dumps(compute()),)], "value string").coalesce(1).write.mode("overwrite").json(path)
    return json.loads(spark.read.schema("value string").json(path).first().value)
