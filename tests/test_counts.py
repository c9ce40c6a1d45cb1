"""The shared count table against pandas, and the plans that read it."""
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from riskloom.operators import counts as C
from riskloom.operators import encode as E
from riskloom.operators.stats import column_audit
from riskloom.plans import screen
from riskloom.sources import fixtures as FX

SF = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().toString()


def _frame(n, seed):
    rng = np.random.default_rng(seed)
    pdf = pd.DataFrame({"SK_ID_CURR": np.arange(n), "hot": np.where(rng.random(n) < 0.4, 1.0, rng.integers(0, 9, n)),
                        "real": rng.normal(size=n), "gaps": rng.integers(0, 4, n).astype(float), "c": rng.choice(["a", "b", "c", "dd"], n)})
    pdf.loc[rng.random(n) < 0.3, "gaps"] = np.nan
    pdf.loc[rng.random(n) < 0.2, "c"] = None
    pdf.loc[0, "real"] = -0.0
    pdf["fold"] = np.arange(n) % 3
    pdf["TARGET"] = (rng.random(n) < 0.3).astype(int)
    return pdf


def _spark(spark, pdf):
    rows = [tuple(None if pd.isna(x) else x.item() if hasattr(x, "item") else x for x in r) for r in pdf.itertuples(index=False)]
    return spark.createDataFrame(rows, "SK_ID_CURR long, hot double, real double, gaps double, c string, fold int, TARGET int")


@pytest.mark.parametrize("n", [7, 60, 301])
def test_single_feature_auc_and_spearman_match_pandas(spark, n):
    pdf = _frame(n, n)
    df = _spark(spark, pdf)
    feats = ["hot", "real", "gaps", "c"]
    counts = screen.screen_counts(df.drop("fold"), feats, screen.ScreenConfig(n_splits=3), df.select("SK_ID_CURR", "fold"))
    got = {r["feature"]: r["auc_single"] for r in screen.single_feature_auc(counts).collect()}
    y = pdf.TARGET.values
    for c in feats:
        score = np.full(n, np.nan)
        for f in range(3):
            own, rest = pdf.fold == f, pdf.fold != f
            if c == "c":
                share = pdf.loc[rest, c].fillna("__MISSING__").value_counts() / max(1, rest.sum())
                score[own] = pdf.loc[own, c].fillna("__MISSING__").map(share).fillna(0.0)
            else:
                v = pdf.loc[own, c].fillna(pdf.loc[rest, c].median())
                score[own] = v.rank() / v.notna().sum()
        ok = ~np.isnan(score)
        r = pd.Series(score[ok]).rank()
        p, m = y[ok].sum(), (1 - y[ok]).sum()
        auc = (r[y[ok] == 1].sum() - p * (p + 1) / 2) / (p * m) if p and m else None
        assert got[c] is None if auc is None else abs(got[c] - max(auc, 1 - auc)) < 1e-12, c
    rho = {r["feature"]: r["spearman_abs"] for r in C.spearman_of_counts(counts.values).collect()}
    for c in ("hot", "real", "gaps"):
        both = pdf[[c, "TARGET"]].dropna()
        want = abs(both[c].rank().corr(both.TARGET.rank()))
        assert (rho[c] is None) if np.isnan(want) else abs(rho[c] - want) < 1e-9


def test_screening_metrics_read_the_counts_only(spark):
    app = FX.application(spark, SF).drop("split")
    plan = _plan(screen.stage1_metrics(app, [c for c in app.columns if c not in ("SK_ID_CURR", "TARGET")]))
    assert "FileScan" not in plan and "Expand" not in plan  # every metric reads the checkpointed counts
    melted = C.melt_values(app, ["AMT_CREDIT", "EXT_SOURCE_1"], ["NAME_TYPE_SUITE"], [F.col("TARGET")])
    physical = melted._jdf.queryExecution().executedPlan().toString()
    assert physical.count("FileScan") == 3 and "Expand" not in physical  # customer, nation, region once each


def test_column_audit_has_no_expand(spark):
    audit = column_audit(FX.application(spark, SF))
    plan = _plan(audit)
    assert "Expand" not in plan and "SinglePartition" not in plan
    pdf = _frame(50, 1)
    got = {r["feature"]: r for r in column_audit(_spark(spark, pdf)).collect()}
    for c in pdf.columns:
        assert got[c]["nunique"] == pdf[c].nunique() and abs(got[c]["missing_rate"] - pdf[c].isna().mean()) < 1e-12
    assert column_audit(_spark(spark, pdf).limit(0)).where("nunique = 0 and near_constant").count() == len(pdf.columns)


def test_codes_of_many_categories_are_numbered_in_ranges(spark):
    n = 100_000
    df = spark.range(n).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("c"), F.lit("one").alias("d"))
    codes = C.sorted_codes(df, ["c", "d"])
    assert "_rk_p" in _plan(codes)  # windows run within a range of a column, not over a whole column
    got = codes.where("feature = 'c'").toPandas().sort_values("code")
    assert got["code"].tolist() == list(range(n)) and got["v"].tolist() == sorted(f"k{i}" for i in range(n))
    assert codes.where("feature = 'd'").collect()[0]["code"] == 0


def test_sparse_slots(spark):
    from pyspark.ml.functions import vector_to_array
    fit = spark.createDataFrame([(1, "b", "x", 0.5), (2, None, "y", 1.5), (3, "a", "x", None)], "id int, c string, d string, v double")
    encoder, out = E.onehot_sparse(fit, ["c", "d"], ["v"])
    assert encoder.width == 6  # v, then __MISSING__ a b, then x y
    got = {r["id"]: r["x"] for r in out.select("id", vector_to_array("features").alias("x")).collect()}
    assert got[1] == [0.5, 0, 0, 1, 1, 0] and got[2] == [1.5, 1, 0, 0, 0, 1]
    assert np.isnan(got[3][0]) and got[3][1:] == [0, 1, 0, 1, 0]
    new = spark.createDataFrame([(9, "zz", "y", 2.0)], fit.schema)
    assert encoder.transform(new).select(vector_to_array("features").alias("x")).first()["x"] == [2.0, 0, 0, 0, 0, 1]


def test_woe_of_all_columns_is_a_projection(spark):
    pdf = _frame(400, 3)
    pdf["fold"] = 0
    df = _spark(spark, pdf)
    test = df.limit(20).withColumn("TARGET", F.lit(None).cast("int")).withColumn("c", F.lit("new"))
    model = E.fit_woe(df.union(test), ["hot", "real", "gaps"], ["c"], min_bin=30)
    out = E.woe_transform(df, model)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan
    table = {(r["feature"], r["bin"]): r for r in model.table.collect()}
    labels = E.safe_qcut(df, ["hot", "real", "gaps"], edges=model.edges).toPandas()
    got = out.toPandas()
    for c in ("hot", "real", "gaps"):
        for b, woe in zip(labels[f"{c}_BIN"], got[f"{c}_BIN_WOE"]):
            assert abs(table[f"{c}_BIN", b]["woe"] - woe) < 1e-12
    p, n = pdf.TARGET.sum(), (1 - pdf.TARGET).sum()
    for b, g in pdf.fillna({"c": "__CAT_NA__"}).groupby("c"):
        want = np.log(((len(g) - g.TARGET.sum() + 0.5) / (g.TARGET.sum() + 0.5)) / ((n + 0.5) / (p + 0.5)))
        assert abs(table["c_BIN", b]["woe"] - want) < 1e-12 and table["c_BIN", b]["cnt"] == len(g)
    assert {r[0] for r in E.woe_transform(test, model).select("c_BIN_WOE").collect()} == {0.0}


def test_woe_of_a_large_category_column_is_joined(spark, monkeypatch):
    df = _spark(spark, _frame(200, 5))
    small = E.woe_transform(df, E.fit_woe(df, ["real"], ["c"])).orderBy("SK_ID_CURR").toPandas()
    monkeypatch.setattr(E, "MOST_LITERALS", 3)
    large = E.woe_transform(df, E.fit_woe(df, [], ["c"])).orderBy("SK_ID_CURR").toPandas()
    assert np.allclose(small["c_BIN_WOE"], large["c_BIN_WOE"])


def test_dense_dummies_have_a_bound(spark, monkeypatch):
    monkeypatch.setattr(E, "MOST_DUMMIES", 2)
    df = spark.createDataFrame([("a",), ("b",), ("c",)], "c string")
    with pytest.raises(ValueError, match="onehot_sparse"):
        E.onehot_categories(df, ["c"], None)


def test_woe_of_many_columns_is_looked_up_in_short_methods(spark):
    import re

    from riskloom.operators.encode import WoeModel
    rng = np.random.default_rng(5)
    cols = [f"c{i}" for i in range(30)]
    edges = {c: sorted(rng.normal(size=11).tolist()) for c in cols}
    edges["c1"] = None
    cells = [(f"{c}_BIN", b, float(rng.normal())) for c in cols for b in ("NA", "ALL", *[f"b{i}" for i in range(10) if i != 4])]
    model = WoeModel(tuple(cols), (), edges, spark.createDataFrame(cells, "feature string, bin string, woe double"))
    values = [None, float("nan"), -0.0, 0.0, -9.0, 9.0, *edges["c0"], *rng.normal(size=20).tolist()]
    df = spark.createDataFrame([(i, *[v] * len(cols)) for i, v in enumerate(values)], ", ".join(["SK_ID_CURR long", *[f"{c} double" for c in cols]])).repartition(2)
    out = E.woe_transform(df, model)
    told = {(f, b): w for f, b, w in cells}

    def bin_of(c, x):
        if x is None:
            return "NA"
        if edges[c] is None:
            return "ALL"
        return f"b{next((i for i, top in enumerate(edges[c][1:-1]) if x <= top), 9)}"

    for r in out.collect():
        for c in cols:
            assert r[f"{c}_BIN_WOE"] == told.get((f"{c}_BIN", bin_of(c, values[r["SK_ID_CURR"]])), 0.0)
    # a method of more than 8,000 bytes is not compiled by the JVM
    text = spark._jvm.PythonSQLUtils.explainString(out._jdf.queryExecution(), "codegen")
    assert max(int(x) for x in re.findall(r"maxMethodCodeSize:(\d+)", text)) < 8_000
