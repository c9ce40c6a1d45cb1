import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from riskloom.operators.train import cross_validate, logistic_l2, permutation_importance


def test_cv_and_permutation_importance(spark):
    rng = np.random.default_rng(7)
    n = 400
    x1 = rng.normal(size=n)
    noise = rng.normal(size=n)
    y = (x1 + 0.3 * rng.normal(size=n) > 0).astype(float)
    pdf = pd.DataFrame({"SK_ID_CURR": range(n), "TARGET": y, "x1": x1, "noise": noise, "fold": np.arange(n) % 4})
    df = spark.createDataFrame(pdf)
    r = cross_validate(df, ["x1", "noise"], logistic_l2(C=1.0))
    assert r.oof.count() == n and r.oof_auc > 0.9 and len(r.fold_auc) == 4
    imp = permutation_importance(df, ["x1", "noise"], logistic_l2(C=1.0), repeats=2).toPandas().set_index("feature")
    assert imp.loc["x1", "importance"] > 0.2
    assert abs(imp.loc["noise", "importance"]) < 0.05


def test_feature_version_validation_on_sf0001(spark):
    from riskloom.operators.train import logistic_l2
    from riskloom.plans.validation import feature_version_validation
    from riskloom.sources.fixtures import application
    app = application(spark, "/root/testdata/sf0.001")
    r = feature_version_validation(app, logistic_l2(C=1.0, max_iter=20), versions=[0, 7]).toPandas()
    assert set(r["version"]) == {0, 7} and set(r["part"]) == {"train", "valid"}
    assert (r["fold"] == -1).sum() == 4 and len(r) == 2 * (2 * 5 + 2)


def test_other_learners_and_fold_weights(spark):
    from riskloom.operators.train import elastic_logistic, mlp
    rng = np.random.default_rng(8)
    n = 300
    x1 = rng.normal(size=n)
    y = (x1 + 0.5 * rng.normal(size=n) > 0.8).astype(float)
    pdf = pd.DataFrame({"SK_ID_CURR": range(n), "TARGET": y, "x1": x1, "x2": rng.normal(size=n),
                        "fold": np.arange(n) % 3})
    df = spark.createDataFrame(pdf)
    r = cross_validate(df, ["x1", "x2"], elastic_logistic(reg=0.01, l1_ratio=0.5))
    assert r.oof_auc > 0.85
    r = cross_validate(df, ["x1", "x2"], mlp(hidden=(4,), n_features=2, max_iter=50))
    assert r.oof.count() == n and r.oof_auc > 0.7
    weights = {x["feature"]: x["importance"] for x in r.importance.collect()}
    assert set(weights) == {"x1", "x2"} and weights["x1"] > weights["x2"] > 0
    r = cross_validate(df, ["x1", "x2"], logistic_l2(C=1.0),
                       fold_weight=lambda k: F.when(F.col("TARGET") == 1, F.lit(3.0)).otherwise(F.lit(1.0)))
    assert r.oof_auc > 0.85


def test_calibrated_ridge_inner_cv(spark):
    from riskloom.operators.train import calibrated_cross_validate, ridge_classifier
    rng = np.random.default_rng(12)
    n = 240
    x1 = rng.normal(size=n)
    y = (x1 + 0.5 * rng.normal(size=n) > 0.5).astype(float)
    pdf = pd.DataFrame({"SK_ID_CURR": range(n), "TARGET": y, "x1": x1, "fold": np.arange(n) % 3})
    out = calibrated_cross_validate(spark.createDataFrame(pdf), ["x1"], ridge_classifier(1.0), inner_k=3).toPandas()
    assert len(out) == n and out["oof_pred"].between(0, 1).all()
    from riskloom.operators.stats import auc_by_group
    a = auc_by_group(spark.createDataFrame(out), "oof_pred", "TARGET").first()["auc"]
    assert a > 0.8


def test_penalty_follows_the_training_rows(spark):
    """Every row twice at half C is the same problem."""
    from riskloom.operators.train import assemble, logistic_l2
    rng = np.random.default_rng(5)
    pdf = pd.DataFrame({"SK_ID_CURR": range(300), "x1": rng.normal(size=300)})
    pdf["TARGET"] = (pdf["x1"] + rng.normal(size=300) > 0).astype(float)
    df = assemble(spark.createDataFrame(pdf), ["x1"])
    a = logistic_l2(C=0.1)("features", "TARGET", None).fit(df)
    b = logistic_l2(C=0.05)("features", "TARGET", None).fit(df.union(df))
    w = logistic_l2(C=0.05)("features", "TARGET", "w").fit(df.withColumn("w", F.lit(2.0)))
    assert abs(a.coefficients[0] - b.coefficients[0]) < 1e-6 and abs(a.coefficients[0] - w.coefficients[0]) < 1e-6


def test_grid_returns_its_winner_and_early_stopping_runs(spark):
    from riskloom.operators.train import boosted_trees, cross_validate, grid_search, logistic_l2
    rng = np.random.default_rng(9)
    n = 300
    pdf = pd.DataFrame({"SK_ID_CURR": range(n), "x1": rng.normal(size=n), "x2": rng.normal(size=n), "fold": np.arange(n) % 2})
    pdf["TARGET"] = (pdf["x1"] + 0.3 * rng.normal(size=n) > 0).astype(int)
    df = spark.createDataFrame(pdf)
    table, best = grid_search(df, ["x1", "x2"], [{"C": 0.001}, {"C": 1.0}], logistic_l2)
    top = table.first()
    assert top["oof_auc"] == best.oof_auc and best.oof.count() == n
    stopped = cross_validate(df, ["x1", "x2"], boosted_trees(max_depth=2, max_iter=15, min_instances=5), early_stop=True)
    assert stopped.oof_auc > 0.8 and stopped.oof.count() == n


def _imbalanced(n, seed=21, k=3):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 2))
    y = (x[:, 0] + 0.8 * rng.normal(size=n) > 1.4).astype(int)
    return pd.DataFrame({"SK_ID_CURR": range(n), "TARGET": y, "x1": x[:, 0], "x2": x[:, 1], "fold": rng.integers(0, k, n)})


def _newton_logistic(x, y, w, reg):
    """Weighted L2 logistic regression, mean loss + reg / 2 |coef|^2, intercept free."""
    x = np.column_stack([x, np.ones(len(x))])
    beta, w, penalty = np.zeros(x.shape[1]), w / w.sum(), np.diag([reg] * (x.shape[1] - 1) + [0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-x @ beta))
        beta -= np.linalg.solve((x * (w * p * (1 - p))[:, None]).T @ x + penalty, x.T @ (w * (p - y)) + penalty @ beta)
    return beta


def _average_precision(score, y):
    order = np.argsort(-score, kind="stable")
    y, score = y[order], score[order]
    ends = np.flatnonzero(np.append(score[1:] != score[:-1], True))
    tp = np.cumsum(y)[ends]
    return float((np.diff(np.append(0, tp)) / y.sum() * tp / (ends + 1)).sum())


def test_imbalance_changes_the_training_part_alone(spark):
    import hashlib

    from riskloom.operators.train import imbalance_experiment, imbalance_runs
    pdf = _imbalanced(900)
    df = spark.createDataFrame(pdf)
    runs = imbalance_runs(df, ["x1", "x2"], logistic_l2(C=1.0))
    table = {r["strategy"]: r for r in imbalance_experiment(df, ["x1", "x2"], logistic_l2(C=1.0)).collect()}
    x, y, fold = pdf[["x1", "x2"]].values, pdf.TARGET.values, pdf.fold.values
    place = np.array([int(hashlib.md5(f"42:{i}".encode()).hexdigest()[:15], 16) for i in pdf.SK_ID_CURR])
    for name, run in runs.items():
        score = np.zeros(len(pdf))
        for k in range(3):
            own = fold != k
            pos, neg = y[own].sum(), (1 - y[own]).sum()
            w = np.ones(own.sum())
            if name == "auto_weight":
                w[y[own] == 1] = min(neg / pos, 50)
            elif name == "scale_pos_weight":
                w[y[own] == 1] = 5
            elif name == "balanced":
                w = np.where(y[own] == 1, own.sum() / (2 * pos), own.sum() / (2 * neg))
            elif name == "undersample":
                first = np.argsort(np.where(y[own] == 0, place[own], np.iinfo(np.int64).max))[:int(3 * pos)]
                w = (y[own] == 1).astype(float)
                w[first] = 1
            beta = _newton_logistic(x[own], y[own], w, 1 / w.sum())
            score[fold == k] = 1 / (1 + np.exp(-(x[fold == k] @ beta[:2] + beta[2])))
        got = run.oof.toPandas().sort_values("SK_ID_CURR")
        assert len(got) == len(pdf) == table[name]["rows"]
        np.testing.assert_allclose(got.oof_pred.values, score, atol=2e-4)
        assert abs(table[name]["average_precision"] - _average_precision(got.oof_pred.values, y)) < 1e-9
        assert abs(table[name]["average_precision"] - _average_precision(score, y)) < 0.01


def test_prefixes_of_boosted_trees_are_models_of_that_length(spark):
    from riskloom.operators.boosting import boosted_cross_validate, refit_at_average, stopping_round
    from riskloom.operators.stats import auc_by_group
    from riskloom.operators.train import boosted_trees
    df = spark.createDataFrame(_imbalanced(400, k=2))
    factory = lambda n: boosted_trees(max_depth=2, max_iter=n, min_instances=5)
    r = boosted_cross_validate(df, ["x1", "x2"], factory(6), test=df.limit(10), patience=2)
    stages = {(s["fold"], s["round"]): s["auc"] for s in r.stages.collect()}
    assert len(stages) == 12 and r.cv.test.count() == 10 and r.cv.oof.count() == 400
    for n in (1, 3, 6):
        plain = cross_validate(df, ["x1", "x2"], factory(n))
        for k, a in enumerate(plain.fold_auc):
            assert abs(stages[k, n] - a) < 1e-9
    for k in (0, 1):
        aucs = [stages[k, n] for n in range(1, 7)]
        assert r.rounds[k] == stopping_round(aucs, 2)
        own = cross_validate(df, ["x1", "x2"], factory(r.rounds[k])).oof.where(F.col("fold") == k).orderBy("SK_ID_CURR").toPandas()
        got = r.cv.oof.where(F.col("fold") == k).orderBy("SK_ID_CURR").toPandas()
        np.testing.assert_allclose(own.oof_pred, got.oof_pred, atol=1e-9)
    assert [stopping_round(x, 2) for x in ([.5, .6, .6, .6, .9], [.5, .4, .6, .5], [None, .3], [.7])] == [2, 3, 2, 1]
    model, n, importance = refit_at_average(df, ["x1", "x2"], factory, r, least=2)
    assert n == max(2, int((r.rounds[0] + r.rounds[1]) / 2)) == len(model.trees)
    assert importance.toPandas().set_index("feature").importance["x1"] > 0.5
    assert auc_by_group(r.cv.oof, "oof_pred", "TARGET").first()["auc"] == r.cv.oof_auc


def test_permutation_importance_equals_a_plain_loop(spark):
    pdf = _imbalanced(300)
    df = spark.createDataFrame(pdf)
    imp = {r["feature"]: r for r in permutation_importance(df, ["x1", "x2"], logistic_l2(C=1.0), repeats=2, seed=7).collect()}
    hashes = spark.range(300).select("id", *[F.xxhash64(F.lit(7), F.lit(r), F.col("id")).alias(f"h{r}") for r in range(2)]).toPandas()
    x, y, fold = pdf[["x1", "x2"]].values, pdf.TARGET.values, pdf.fold.values

    def auc(s, t):
        r = pd.Series(s).rank()
        p = t.sum()
        return (r[t == 1].sum() - p * (p + 1) / 2) / (p * (len(t) - p))

    base, perm = [], {0: [], 1: []}
    for k in range(3):
        own = fold != k
        beta = _newton_logistic(x[own], y[own], np.ones(own.sum()), 1 / own.sum())
        v, t = x[~own], y[~own]
        base.append(auc(v @ beta[:2], t))
        for r in range(2):
            order = np.argsort(hashes[f"h{r}"].values[~own])
            for j in range(2):
                moved = v.copy()
                moved[:, j] = v[order, j]
                perm[j].append(auc(moved @ beta[:2], t))
    for j, c in enumerate(("x1", "x2")):
        assert abs(imp[c]["base_auc"] - np.mean(base)) < 2e-3 and abs(imp[c]["perm_auc"] - np.mean(perm[j])) < 2e-3


def test_two_level_search(spark):
    from riskloom.operators.train import two_level_search
    pdf = _imbalanced(300, k=5)
    pdf["fold3"] = np.arange(300) % 3
    df = spark.createDataFrame(pdf)
    grid = [{"C": 1e-4}, {"C": 1.0}, {"C": 1.0}]
    r = two_level_search(df, df.limit(7), ["x1", "x2"], grid, logistic_l2)
    table = r.table.collect()
    best = max(t["mean_auc"] for t in table)
    assert len(table) == 3 and r.params == next(g for g in grid if any(t["params"] == str(g) and t["mean_auc"] == best for t in table))
    assert len(r.final.fold_auc) == 5 and r.final.oof.count() == 300 and r.final.test.count() == 7
    plain = cross_validate(df.withColumn("fold", F.col("fold3")), ["x1", "x2"], logistic_l2(**r.params))
    assert abs(best - np.mean(plain.fold_auc)) < 1e-9


def test_first_layer_weights_belong_to_their_inputs(spark):
    """The table's weights, put into a plain forward pass, give the model's own probabilities."""
    from riskloom.operators.train import _importance, assemble, mlp
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame(rng.normal(size=(120, 3)), columns=["a", "b", "c"])
    pdf["y"] = (pdf["a"] - 2 * pdf["b"] > 0).astype(float)
    data = assemble(spark.createDataFrame(pdf), ["a", "b", "c"])
    model = mlp(hidden=(4,), n_features=3, max_iter=30)("features", "y", None).fit(data)
    w = model.weights.toArray()
    first, bias, second, last = w[:12].reshape(3, 4), w[12:16], w[16:24].reshape(4, 2), w[24:26]
    x = np.array([r["features"].toArray() for r in data.select("features").collect()])
    out = 1 / (1 + np.exp(-(x @ first + bias))) @ second + last
    want = np.exp(out) / np.exp(out).sum(axis=1, keepdims=True)
    got = np.array([r["probability"].toArray() for r in model.transform(data).select("probability").collect()])
    np.testing.assert_allclose(got, want, atol=1e-9)
    assert _importance(model, ["a", "b", "c"]) == [(f, v) for f, v in zip("abc", np.abs(first).sum(axis=1))]


def test_logistic_models_score_after_an_observation(spark):
    """A session that has used an Observation cannot be sent to tasks; fitted models must not hold it."""
    from pyspark.sql import Observation
    from riskloom.operators.train import platt_calibrate
    df = spark.createDataFrame(_imbalanced(200, k=2))
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("n")).write.format("noop").mode("overwrite").save()
    assert seen.get == {"n": 200}
    oof = cross_validate(df, ["x1", "x2"], logistic_l2(C=1.0, max_iter=5)).oof
    assert oof.count() == 200 and platt_calibrate(oof)[1].where("prob is not null").count() == 200


def test_fits_at_once_keep_to_the_memory_for_cached_rows(spark, monkeypatch):
    """Each fit caches its rows: strategies times folds must not all run where the executors cannot hold so many copies."""
    import threading
    import time

    from riskloom import session
    from riskloom.operators.train import imbalance_runs
    lock, now, seen = threading.Lock(), [0], []

    def counted(fc, lc, wc):
        est = logistic_l2(C=1.0, max_iter=2)(fc, lc, wc)

        class Counted:
            def fit(self, rows):
                with lock:
                    now[0] += 1
                    seen.append(now[0])
                try:
                    time.sleep(0.2)
                    return est.fit(rows)
                finally:
                    with lock:
                        now[0] -= 1
        return Counted()

    pdf = _imbalanced(600)
    df = spark.createDataFrame(pdf.assign(fold=pdf.SK_ID_CURR % 3))
    one = 400 * (16 + 2 * 8)  # label, weight and two features of the rows outside a fold
    assert session.cache_bytes(spark) > 100 * one  # local mode: the driver's own
    for room, most in ((0, 1), (2 * one, 2), (1000 * one, None)):
        seen.clear()
        monkeypatch.setattr(session, "cache_bytes", lambda spark, room=room: 2 * room)
        runs = imbalance_runs(df, ["x1", "x2"], counted, strategies=("none", "balanced"))
        assert len(seen) == 6 and all(r.oof.count() == 600 for r in runs.values())
        assert max(seen) == most if most else max(seen) > 2


def test_vector_bytes_of_dense_and_sparse_rows(spark):
    from pyspark.ml.linalg import Vectors
    from riskloom.operators.train import vector_bytes
    rows = [(Vectors.dense([1.0, 2.0, 3.0]),), (Vectors.sparse(1000, [5], [1.0]),), (None,)]
    assert vector_bytes(spark.createDataFrame(rows, ["features"])) == 16 + (24 + 12) / 2
    assert vector_bytes(spark.createDataFrame(rows[:1], ["features"]).where("false")) == 16


def test_rows_of_both_classes_come_from_one_reading(spark):
    """Statistics of a frame read twice differ in their last digits; one class from each reading would tell the label."""
    import time

    from riskloom.operators.train import imbalance_runs
    start = time.time()
    clock = F.udf(lambda: time.time() - start, "double").asNondeterministic()
    pdf = _imbalanced(300).assign(TARGET=(np.random.default_rng(5).random(300) < 0.3).astype(int))
    df = spark.createDataFrame(pdf).withColumn("x1", clock())
    assert imbalance_runs(df, ["x1"], logistic_l2(C=1e6, max_iter=20), strategies=("none",))["none"].oof_auc < 0.8
