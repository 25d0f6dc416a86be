from pyspark.sql import functions as F

from conftest import SF001
from skyledger.operators import features as FE
from skyledger.operators import models as ML
from skyledger.plans.fixture import features_table


def nonlinear_target(spark):
    """Fixture fares carry no signal, so derive a non-linear target from the
    features themselves (step in duration x class, plus a destination effect)."""
    f = features_table(spark, SF001)
    y = (F.when(F.col("duration_hrs") > 8, 3.0).otherwise(1.0)
         * F.when(F.col("class") == "First Class", 2.0).otherwise(1.0)
         + F.when(F.col("destination") < "NATION_5", 0.5).otherwise(0.0))
    return f.withColumn(FE.LABEL, F.log1p(y * 10000))


def test_tree_beats_linear_on_nonlinear_target(spark):
    f = nonlinear_target(spark)
    train, test = f.where("split = 'train'"), f.where("split = 'test'")
    lin = ML.pipeline(ML.ModelSpec("lin", "linear", {"regParam": 0.0, "solver": "normal"}, True)).fit(train)
    tree = ML.pipeline(ML.ModelSpec("tree", "tree", {"maxDepth": 6, "minInstancesPerNode": 5})).fit(train)
    r_lin = ML.metrics_row(lin, test)["r2"]
    r_tree = ML.metrics_row(tree, test)["r2"]
    assert r_tree > 0.95 and r_tree > r_lin


def test_cv_and_grid(spark):
    f = nonlinear_target(spark)
    est = ML.pipeline(ML.ModelSpec("tree", "tree", {"maxDepth": 6}))
    cv = ML.cross_validate(est, f.where("split = 'train'"), folds=3)
    assert len(cv["fold_r2"]) == 3 and cv["cv_r2"] > 0.9
    grid = ML.sample_grid(20)
    assert len({tuple(sorted(g.items())) for g in grid}) == len(grid) == 20 and all(g["maxIter"] in (100, 200, 300) for g in grid)
    assert ML.sample_grid(20) == grid  # seeded


def test_batch_score_rejects_unknown(spark):
    f = nonlinear_target(spark)
    model = ML.pipeline(ML.ModelSpec("tree", "tree", {"maxDepth": 3})).fit(f.where("split = 'train'"))
    test = f.where("split = 'test'")
    odd = test.limit(2).withColumn("airline", F.lit("Unknown Air"))
    scored, rejects = ML.batch_score(spark, model, test.unionByName(odd))
    assert rejects.count() == 2
    assert scored.count() == test.count()
    assert scored.where(F.col("predicted_fare") <= 0).count() == 0


def test_model_job_end_to_end(spark, tmpdir_path):
    import os
    from pyspark.ml import PipelineModel
    from skyledger.plans.fixture import validated_table
    from skyledger.plans.model_job import run_fare_model
    small = {"Random Forest": {"numTrees": 3, "maxDepth": 4}, "Gradient Boosting": {"maxIter": 2}, "XGBoost": {"maxIter": 2},
             "LightGBM": {"maxIter": 2}}
    specs = [ML.ModelSpec(s.name, s.kind, {**s.params, **small.get(s.name, {})}, s.scaled) for s in ML.registry(100, 1.0)]
    grid = [{**p, "maxIter": 2, "maxDepth": 2} for p in ML.sample_grid(2)]
    out = run_fare_model(spark, validated_table(spark, SF001), os.path.join(tmpdir_path, "model"),
                         specs=specs, grid=grid, with_profile=False)
    assert out["models"] == 9
    board = spark.read.option("header", True).csv(os.path.join(tmpdir_path, "model", "model_comparison"))
    assert board.count() == 9
    model = PipelineModel.load(os.path.join(tmpdir_path, "model", "best_model"))
    f = features_table(spark, SF001)
    assert model.transform(f).where(F.col("prediction").isNull()).count() == 0


def test_presets_are_whole():
    params = {s.name: s.params for s in ML.registry(100, 1.0)}
    assert params["Random Forest"]["numTrees"] == 300 and params["Gradient Boosting"]["maxIter"] == 300
    assert params["XGBoost"]["maxIter"] == params["LightGBM"]["maxIter"] == 400


def test_every_booking_is_scored_or_rejected(spark):
    from skyledger.plans import fare_model as FM
    scored, rejects = FM.batch_score(spark, SF001), FM.batch_rejects(spark, SF001)
    assert scored.count() + rejects.count() == features_table(spark, SF001).count()
    assert scored.where("predicted_fare is null").count() == 0


def test_rejects_name_every_reason(spark):
    f = features_table(spark, SF001)
    vocab = FE.label_vocabulary(f)
    odd = f.limit(3).withColumn("n", F.monotonically_increasing_id())
    odd = odd.withColumn("airline", F.when(F.col("n") == 0, "Nobody Air").otherwise(F.col("airline"))) \
        .withColumn("class", F.when(F.col("n") == 1, F.lit(None)).otherwise(F.col("class"))) \
        .withColumn("stopovers", F.when(F.col("n") == 1, F.lit(None)).otherwise(F.col("stopovers")))
    got = FE.scoring_rejects(odd, vocab, FE.CAT_FEATURES, FE.NUM_FEATURES)
    assert sorted(r.reject_reason for r in got.collect()) == ["missing field: class; missing field: stopovers", "unknown airline"]


def design(rows, codes, means):
    import numpy as np
    x = [[*[codes[c]["nan" if r[c] is None else r[c]] for c in FE.CAT_FEATURES],
          *[means[c] if r[c] is None else float(r[c]) for c in FE.NUM_FEATURES]] for r in rows]
    return np.array(x, float), np.array([r[FE.LABEL] for r in rows])


def test_gram_models_equal_direct_fits(spark):
    """Least squares and ridge against numpy on the rows; lasso by its optimality conditions."""
    import numpy as np
    from skyledger.operators import linear as L
    f = nonlinear_target(spark).withColumn("stopovers", F.when(F.col("raw_id") % 7 == 0, F.lit(None)).otherwise(F.col("stopovers")))
    fits = L.fit(f)
    rows = f.where("split = 'train'").collect()
    x, y = design(rows, fits.codes, fits.means)
    fold = np.array([r.fold for r in rows])
    std = x.std(0)
    z = (x - x.mean(0)) / np.where(std > 0, std, 1)
    for name, l2 in (("Linear Regression", 0.0), ("Ridge Regression", 1.0)):
        for k in (None, 2):
            keep = fold != (k if k is not None else -1)
            a, b = z[keep] - z[keep].mean(0), y[keep] - y[keep].mean()
            want = np.linalg.lstsq(a.T @ a + l2 * np.eye(15), a.T @ b, rcond=1e-12)[0]
            g = sum(g for i, g in enumerate(fits.folds) if i != k)
            s = L.solve(g, *L.moments(sum(fits.folds)), L.Linear(name, l2=l2))
            assert np.allclose(s.standard, np.where(std > 0, want, 0), atol=1e-8)
            p = y[keep].mean() + a @ want
            assert abs(L.r2(g, s) - (1 - ((y[keep] - p) ** 2).sum() / (b ** 2).sum())) < 1e-8
    b = fits.solved["Lasso Regression"].standard
    slope = z.T @ (y - y.mean() - z @ b) / len(y)  # |slope| <= penalty, equal to it with b's sign where b isn't 0
    assert np.all(np.abs(slope) <= 0.001 + 1e-9) and np.allclose(slope[b != 0], 0.001 * np.sign(b[b != 0]), atol=1e-9)
    predicted = f.where("split = 'train'").withColumn("prediction", L.prediction(fits, "Linear Regression")).select("raw_id", "prediction").collect()
    at = {r.raw_id: r.prediction for r in predicted}
    full = np.linalg.lstsq(np.c_[np.ones(len(z)), z], y, rcond=1e-10)[0]
    assert np.allclose([at[r.raw_id] for r in rows], np.c_[np.ones(len(z)), z] @ full, atol=1e-7)


def test_a_deep_tree_cut_equals_separate_fits(spark):
    from skyledger.operators import staged
    f = nonlinear_target(spark)
    prep = ML.fit_prep(f)
    vec = prep.transform(f).withColumn("held", F.col("fold") == 1).where("split = 'train'")
    est = ML._estimator(ML.ModelSpec("t", "tree"), prepared=True, bins=ML.max_bins(prep))
    fit_on = vec.where("not held")
    deep = staged.Nodes(spark, est.copy({est.maxDepth: 9}).fit(fit_on))
    got = {(r.held, r.depth): r.r2 for r in staged.depth_errors(vec, deep, 9).collect()}
    for depth in (1, 3, 6, 9):
        alone = est.copy({est.maxDepth: depth}).fit(fit_on)
        for held in (False, True):
            want = ML._r2(alone, vec.where(F.col("held") == held))
            assert abs(got[held, depth] - want) < 1e-9


def test_the_store_fits_equal_work_once(spark, tmpdir_path):
    from skyledger.plans import model_store as store
    f = nonlinear_target(spark)
    est = ML.pipeline(ML.ModelSpec("tree", "tree", {"maxDepth": 2}))
    fits = []
    spark.conf.set(store.STORE_SETTING, tmpdir_path)
    try:
        def fit():
            fits.append(1)
            return est.fit(f)
        key = store.digest(store.fingerprint(f), "tree", {"maxDepth": 2})
        a, b = store.model(spark, key, fit), store.model(spark, key, fit)
        assert len(fits) == 1 and a.transform(f).exceptAll(b.transform(f).drop()).count() == 0
        assert store.scores(spark, key, "s", lambda: {"r2": 0.5}) == store.scores(spark, key, "s", lambda: {"r2": 0.9}) == {"r2": 0.5}
        other = store.digest(store.fingerprint(f.where("raw_id > 5")), "tree", {"maxDepth": 2})
        assert other != key and store.digest(store.fingerprint(f.repartition(3)), "tree", {"maxDepth": 2}) == key
    finally:
        spark.conf.unset(store.STORE_SETTING)
