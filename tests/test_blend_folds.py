import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from riskloom.operators.blend import blend
from riskloom.operators.folds import stratified_folds


def _long(spark, wide):
    rows = [(i, m, float(v)) for i, r in wide.iterrows() for m, v in r.items() if not pd.isna(v)]
    return spark.createDataFrame(rows, "id long, model string, pred double")


def test_blends_match_numpy(spark):
    rng = np.random.default_rng(3)
    w = pd.DataFrame(rng.random((50, 4)), columns=["a", "b", "c", "d"])
    w.iloc[0, 1] = np.nan  # incomplete row is dropped
    long = _long(spark, w)
    full = w.dropna()
    X = full.values
    got = blend(long, list(w.columns), "mean").toPandas().set_index("id").sort_index()
    np.testing.assert_allclose(got["pred"].values, np.clip(X.mean(axis=1), 1e-6, 1 - 1e-6))
    got = blend(long, list(w.columns), "trimmed_mean", trim_frac=0.25).toPandas().set_index("id").sort_index()
    np.testing.assert_allclose(got["pred"].values, np.sort(X, axis=1)[:, 1:3].mean(axis=1))
    got = blend(long, list(w.columns), "rank_mean").toPandas().set_index("id").sort_index()
    R = full.rank(pct=True).values
    np.testing.assert_allclose(got["pred"].values, np.clip(R.mean(axis=1), 1e-6, 1 - 1e-6))
    wts = {"a": 1.0, "b": 2.0, "c": 0.0, "d": 1.0}
    got = blend(long, list(w.columns), "weighted_mean", weights=wts).toPandas().set_index("id").sort_index()
    ww = np.array([1.0, 2.0, 0.0, 1.0]) / 4.0
    np.testing.assert_allclose(got["pred"].values, X @ ww)


def test_stratified_folds_balanced(spark):
    pdf = pd.DataFrame({"SK_ID_CURR": range(103), "TARGET": [1 if i % 7 == 0 else 0 for i in range(103)]})
    f = stratified_folds(spark.createDataFrame(pdf), k=5).toPandas()
    counts = f.groupby(["TARGET", "fold"]).size().unstack()
    assert (counts.max(axis=1) - counts.min(axis=1)).max() <= 1
    assert len(f) == 103


def test_weighted_run_against_pandas(spark):
    import numpy as np
    import pandas as pd
    from riskloom.plans.blending import auc_weights, model_weights, weighted_run
    rng = np.random.RandomState(5)
    wide = pd.DataFrame({m: np.round(rng.rand(60) * 1.2 - 0.1, 2) for m in "abc"}, index=range(60))
    y = pd.Series((rng.rand(60) < wide["a"]).astype(int), index=wide.index)
    rows = [(i, m, float(wide.at[i, m])) for i in wide.index for m in "abc"] + [(99, "a", 0.5), (99, "b", None), (5, "other", 0.5)]
    long = spark.createDataFrame(rows, "id long, model string, pred double")
    labels = spark.createDataFrame([(i, int(t)) for i, t in y.items() if i % 3] + [(3, None)], "id long, TARGET int")
    some = [i for i in y.index if i % 3]
    auc = {}
    for m in "abc":
        r = wide.loc[some, m].rank()
        pos = y[some] == 1
        auc[m] = (r[pos].sum() - pos.sum() * (pos.sum() + 1) / 2) / (pos.sum() * (~pos).sum())
    share = {m: auc[m] / sum(auc.values()) for m in auc}
    weights = model_weights(spark, "abc", auc_weights(long, labels, "abc"))
    assert {r["model"]: round(r["weight"], 9) for r in weights.collect()} == {m: round(w, 9) for m, w in share.items()}
    run = weighted_run(long, "abc", weights)
    got = run.scores.toPandas().set_index("id").sort_index()
    np.testing.assert_allclose(got["probability"], sum(wide[m].clip(0, 1) * w for m, w in share.items()), atol=1e-9)
    np.testing.assert_allclose(got["rank"], sum(wide[m].rank(pct=True) * w for m, w in share.items()), atol=1e-9)
    report = run.report.toPandas().set_index("model")
    corr = wide.corr("spearman")
    for m in "abc":
        assert abs(report.at[m, "weight"] - share[m]) < 1e-9 and abs(report.at[m, "std"] - wide[m].std()) < 1e-9
        assert abs(report.at[m, "avg_spearman"] - corr.loc[m].drop(m).mean()) < 1e-9
    hand = {r["model"]: r["weight"] for r in model_weights(spark, "abc", manual={"a": 2, "b": 1}).collect()}
    assert hand == {"a": 0.5, "b": 0.25, "c": 0.25}
    assert {r["weight"] for r in model_weights(spark, "abcd").collect()} == {0.25}
