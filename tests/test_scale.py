"""Shuffles grow with their rows: no task's share outgrows memory on larger tables."""

import glob
import os

from conftest import SF001
from skyledger.operators import ranking
from skyledger.sources import bookings
from skyledger.sources.landing import land_run, scan_landing
from skyledger.sources.tables import append_run


def test_bookings_meet_in_as_many_tasks_as_their_rows_need(spark, monkeypatch):
    few = bookings.tpch_bookings(spark, SF001)
    rows = few.count()
    monkeypatch.setattr(ranking, "ROWS_PER_TASK", rows // 20)
    n = bookings.booking_partitions(spark, SF001)
    assert n >= 20
    many = bookings.tpch_bookings(spark, SF001)
    p = many._jdf.queryExecution().executedPlan().toString()
    assert f"hashpartitioning(l_orderkey" in p and p.count(f", {n})") >= 4
    assert many.exceptAll(few).count() == 0 and many.count() == rows


def test_a_run_is_landed_in_the_tasks_asked_for(spark, tmpdir_path, monkeypatch):
    b, path = bookings.tpch_bookings(spark, SF001), os.path.join(tmpdir_path, "land")
    monkeypatch.setattr(ranking, "ROWS_PER_TASK", b.count() // 20)
    land_run(b, "r", path, num_partitions=bookings.booking_partitions(spark, SF001))
    assert len(glob.glob(f"{path}/*/*.parquet")) >= 20
    assert scan_landing(spark, path, "r").select("id").distinct().count() == b.count()


def test_runs_are_not_sorted_for_their_write(spark, tmpdir_path):
    plans = []
    old = spark.conf.get("spark.sql.maxConcurrentOutputFileWriters", None)
    df = spark.range(10, numPartitions=1).selectExpr("id", "concat('r', id) pipeline_run_id")
    write = type(df).write.fget

    def noted(self):
        plans.append(self.sparkSession.conf.get("spark.sql.maxConcurrentOutputFileWriters", "0"))
        return write(self)

    type(df).write = property(noted)
    try:
        append_run(df, os.path.join(tmpdir_path, "runs"))
    finally:
        type(df).write = property(write)
    assert int(plans[0]) > 0  # Spark then adds no sort by run
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters", None) == old
    back = spark.read.parquet(os.path.join(tmpdir_path, "runs"))
    assert back.count() == 10 and back.select("pipeline_run_id").distinct().count() == 10  # more runs than open files


def test_scoring_needs_no_join_of_the_bookings_with_their_rejects(spark):
    from skyledger.plans import fare_model as FM
    scored = FM.batch_score(spark, SF001)
    p = scored._jdf.queryExecution().executedPlan().toString()
    assert "LeftAnti" not in p and "SortMergeJoin" not in p
    kept = FM.features_table(spark, SF001).join(FM.batch_rejects(spark, SF001), "raw_id", "left_anti").select("raw_id")
    assert scored.select("raw_id").exceptAll(kept).count() == 0 and scored.count() == kept.count()


def test_fits_run_one_by_one_where_rows_are_many(spark, monkeypatch):
    from skyledger.plans import fare_model as FM
    assert FM._fits_at_once(spark, SF001) == FM.CV_FOLDS
    monkeypatch.setattr(FM, "booking_count", lambda *_: 10 ** 9)
    assert FM._fits_at_once(spark, SF001) == 1


def test_scans_for_tree_fits_get_tasks_by_rows(spark, tmpdir_path):
    from skyledger.session import scan_tasks
    path = os.path.join(tmpdir_path, "t")
    spark.range(400).repartition(40).write.parquet(path)
    assert spark.read.parquet(path).rdd.getNumPartitions() < 40
    with scan_tasks(spark, 40):
        assert spark.read.parquet(path).rdd.getNumPartitions() == 40


def test_lower_levels_grown_by_rows_equal_one_deep_fit(spark):
    from pyspark.sql import functions as F
    from skyledger.operators import models as ML, staged
    from test_models import nonlinear_target
    f = nonlinear_target(spark)
    prep = ML.fit_prep(f)
    vec = prep.transform(f).withColumn("held", F.col("fold") == 1).where("split = 'train'").cache()
    est = ML._estimator(ML.ModelSpec("t", "tree", {"minInstancesPerNode": 20}), prepared=True, bins=ML.max_bins(prep))
    deep = staged.Nodes(spark, est.copy({est.maxDepth: 9}).fit(vec.where("not held")))
    want = {(r.held, r.depth): r.r2 for r in staged.depth_errors(vec, deep, 9).collect()}
    for upper in (1, 4):
        got = {(r.held, r.depth): r.r2 for r in staged.deep_errors(vec, est, 9, upper).collect()}
        assert got.keys() == want.keys()
        for k in want:
            assert abs(got[k] - want[k]) < 1e-6, (upper, k, got[k], want[k])


def test_small_nodes_gain_as_much_as_in_one_deep_fit(spark):
    from pyspark.sql import functions as F
    from skyledger.operators import models as ML, staged
    from test_models import nonlinear_target
    f = nonlinear_target(spark)
    prep = ML.fit_prep(f)
    vec = prep.transform(f).withColumn("held", F.col("fold") == 1).where("split = 'train'").cache()
    est = ML._estimator(ML.ModelSpec("t", "tree"), prepared=True, bins=ML.max_bins(prep))
    deep = staged.Nodes(spark, est.copy({est.maxDepth: 9}).fit(vec.where("not held")))
    want = {r.depth: r.r2 for r in staged.depth_errors(vec, deep, 9).where("not held").collect()}
    got = {r.depth: r.r2 for r in staged.deep_errors(vec, est, 9, 2).where("not held").collect()}
    assert got.keys() == want.keys()
    for k in want:  # held rows may go another way where several features split alike
        assert abs(got[k] - want[k]) < 1e-3, (k, got[k], want[k])


def test_dedup_deals_rows_to_as_many_tasks_as_they_need(spark):
    from skyledger.operators.quality import clean_dedup
    df = spark.range(600).selectExpr("id % 200 a", "if(id % 3 = 0, null, 'x') b", "cast(id % 7 as decimal(12,2)) c")
    many = clean_dedup(df, num_partitions=20)
    assert ", 20)" in many._jdf.queryExecution().executedPlan().toString()
    assert many.exceptAll(df.distinct()).count() == 0 and many.count() == df.distinct().count()
    assert clean_dedup(df, ["a"], num_partitions=20).count() == 200
    assert ", 2)" not in clean_dedup(df, num_partitions=2)._jdf.queryExecution().executedPlan().toString()


def test_quantiles_count_values_in_as_many_tasks_as_their_rows_need(spark, monkeypatch):
    df = spark.range(3000).selectExpr("id % 2 g", "if(id % 10 = 0, null, cast(pmod(id * 7919, 3001) as double)) x")
    few = {r.g: r.m for r in ranking.exact_quantiles(df, "x", [0.5], ["m"], ["g"]).collect()}
    tasks, old = [], spark.conf.get("spark.sql.shuffle.partitions")
    checkpoint = type(df).checkpoint

    def noted(self, *a, **b):
        tasks.append((self.rdd.getNumPartitions(), spark.conf.get("spark.sql.shuffle.partitions")))
        return checkpoint(self, *a, **b)

    monkeypatch.setattr(type(df), "checkpoint", noted)
    monkeypatch.setattr(ranking, "ROWS_PER_TASK", 100)
    many = {r.g: r.m for r in ranking.exact_quantiles(df, "x", [0.5], ["m"], ["g"]).collect()}
    assert tasks == [(30, "30")] and spark.conf.get("spark.sql.shuffle.partitions") == old
    assert many == few and len(many) == 2


def test_dedup_shuffles_only_rows_whose_hash_comes_again(spark):
    from pyspark.sql import functions as F
    from skyledger.operators import quality as Q
    df = spark.range(3000).selectExpr("if(id < 2700, id, id % 50) a", "if(id % 3 = 0, null, concat('x', id % 5)) b", "cast(id % 7 as decimal(12,2)) c",
                                      "if(id % 2 = 0, -0.0d, 0.0d) * if(id % 11 = 0, cast('NaN' as double), 1) d", "timestamp_ntz'2024-01-01 00:00:00' e")
    df = df.union(df.where("a < 40")).union(df.where("a is null"))
    once, again = Q._by_repeats(df, df.columns, 20)
    assert once.count() + again.count() == df.count() and again.count() < 600 and once.count() > 2000
    got = Q.clean_dedup(df, num_partitions=20)
    assert got.schema == df.schema and got.count() == df.distinct().count()
    assert got.exceptAll(df.distinct()).count() == 0
    assert Q.clean_dedup(df, ["b", "d"], num_partitions=20).count() == df.dropDuplicates(["b", "d"]).count()
    arrays = df.select(F.array("a").alias("a"))
    assert Q.clean_dedup(arrays, num_partitions=20).count() == arrays.distinct().count()
    nothing = Q.clean_dedup(df.where("a < 0"), num_partitions=20)
    assert nothing.count() == 0 and nothing.schema == df.schema


def test_raw_rows_need_no_validated_table(spark):
    from skyledger.plans import fixture
    key = fixture._key(spark, "/root/testdata/sf0.001/.")
    kept = {t: dict(t_) for t, t_ in (("raw", fixture._RAW), ("both", fixture._TABLES))}
    fixture._RAW.pop(key, None), fixture._TABLES.pop(key, None)
    try:
        assert fixture.raw_table(spark, SF001).count() > 0
        assert key in fixture._RAW and key not in fixture._TABLES
    finally:
        fixture._RAW.update(kept["raw"]), fixture._TABLES.update(kept["both"])


def test_a_landed_run_leaves_no_shuffle_files(spark, tmpdir_path):
    from skyledger.session import released_shuffles
    left = lambda: spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles().size()
    df = spark.range(1000).repartitionByRange(7, "id")
    was = left()
    with released_shuffles(spark):
        df.write.parquet(os.path.join(tmpdir_path, "t"))
    assert left() <= was


def _fitted_case(spark):
    from skyledger.operators import models as ML
    from test_models import nonlinear_target
    f = nonlinear_target(spark).selectExpr("* except (label)", "label + pmod(xxhash64(raw_id), 1000) / 1e4 label")  # no node of equal labels
    prep = ML.fit_prep(f)
    vec = prep.transform(f).where("split = 'train'").cache()
    return ML, vec, ML._estimator(ML.ModelSpec("t", "tree", {"maxDepth": 7, "minInstancesPerNode": 20}), prepared=True, bins=ML.max_bins(prep))


def test_trees_of_all_folds_grown_in_the_same_passes_equal_single_fits(spark, monkeypatch):
    from pyspark.sql import functions as F
    from skyledger.operators import trees
    ML, vec, est = _fitted_case(spark)
    monkeypatch.setattr(trees, "ROWS_PER_END", 300)
    monkeypatch.setattr(trees, "CELLS", 20_000)  # several passes a level
    monkeypatch.setattr(type(est), "_fit", lambda *a: 1 / 0)
    cv = ML.cross_validate(est, vec, 5, packed=trees.Packed(vec, est, [0, 1, 2, 3, 4]), with_train_r2=True)
    monkeypatch.undo()
    want = ML.cross_validate(est, vec, 5, with_train_r2=True)
    assert all(abs(a - b) < 1e-9 for a, b in zip(cv["fold_r2"], want["fold_r2"])) and cv["train_r2"] == want["train_r2"]


def test_a_grown_tree_is_the_model_of_a_fit(spark, monkeypatch, tmpdir_path):
    from pyspark.ml.regression import DecisionTreeRegressionModel
    from pyspark.sql import functions as F
    from skyledger.operators import trees
    ML, vec, est = _fitted_case(spark)
    want = est.fit(vec)
    for rows in (300, 10 ** 6):
        monkeypatch.setattr(trees, "ROWS_PER_END", rows)
        got = trees.model(spark, est, trees.grow(est, trees.Packed(vec, est, [-1]), [-1], nodes_of=0), 0)
        got.write().overwrite().save(os.path.join(tmpdir_path, "m"))
        got = DecisionTreeRegressionModel.load(os.path.join(tmpdir_path, "m"))
        assert (got.numNodes, got.depth, got.numFeatures) == (want.numNodes, want.depth, want.numFeatures)
        assert max(abs(got.featureImportances.toArray() - want.featureImportances.toArray())) < 1e-9
        both = got.transform(vec).select("raw_id", F.col("prediction").alias("p")).join(want.transform(vec).select("raw_id", "prediction"), "raw_id")
        assert both.where("abs(p - prediction) > 1e-9").count() == 0


def test_thresholds_are_those_of_the_fits_own_sample(spark):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import DecisionTreeRegressor
    from pyspark.sql import functions as F
    from skyledger.operators import staged, trees
    rows = spark.range(40_000, numPartitions=3).selectExpr("id raw_id", "cast(id % 5 as int) fold", "pmod(xxhash64(id), 100000) / 7.0 a", "cast(id % 3 as double) b",
                                                           "sin(pmod(xxhash64(id), 100000) / 9e3) + id % 3 label")
    vec = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(rows).cache()
    est = DecisionTreeRegressor(seed=7, maxBins=16, maxDepth=4)
    want, got = est.fit(vec), trees.model(spark, est, trees.grow(est, trees.Packed(vec, est, [0, -1]), [-1], nodes_of=0), 0)
    lines = [[x.strip()[:25] for x in m.toDebugString.split("\n")[1:] if "If" in x] for m in (got, want)]
    assert lines[0] == lines[1] and staged.Bins(vec, est).thresholds[0].size == 15


def test_rows_without_a_label_end_a_fit(spark):
    import pytest
    from pyspark.sql import functions as F
    from skyledger.operators import trees
    _, vec, est = _fitted_case(spark)
    with pytest.raises(Exception, match="null or NaN"):
        trees.Packed(vec.withColumn("label", F.when(F.col("raw_id") != 11, F.col("label"))), est, [-1])
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import DecisionTreeRegressor
    odd = VectorAssembler(inputCols=["a"], outputCol="features", handleInvalid="keep").transform(
        spark.range(50).selectExpr("if(id = 7, null, id / 2) a", "cast(id % 5 as int) fold", "id * 1.0D label"))
    with pytest.raises(Exception, match="NaN or infinite"):
        trees.Packed(odd, DecisionTreeRegressor(), [-1])
