import pandas as pd
from pyspark.sql import functions as F

from riskloom.operators.aggspec import Window, aggregate


def test_multi_window_semantics(spark):
    # customer 3 has rows only outside the window; customer 2 has an all-NULL group
    rows = [(1, -1, 5.0), (1, -30, 7.0), (2, -2, None), (2, -3, None), (3, -100, 1.0)]
    df = spark.createDataFrame(rows, "id long, m int, x double")
    spec = {"x": ["sum", "mean", "min", "count"], "id": ["count"]}
    out = aggregate(df, "id", spec, "A_", [Window("R_", F.col("m") > -24)]).orderBy("id").toPandas()
    r1, r2, r3 = out.to_dict("records")
    assert r1["A_X_SUM"] == 12.0 and r1["R_X_SUM"] == 5.0 and r1["R_ID_COUNT"] == 1
    assert r2["A_X_SUM"] == 0.0 and pd.isna(r2["A_X_MEAN"]) and r2["A_X_COUNT"] == 0
    assert r2["R_X_SUM"] == 0.0 and r2["R_ID_COUNT"] == 2
    assert pd.isna(r3["R_X_SUM"]) and pd.isna(r3["R_ID_COUNT"]) and r3["A_ID_COUNT"] == 1


def test_two_level_distinct_matches_pandas(spark):
    rows = [(1, 1.0, 0.0, -10), (1, 1.0, 2.0, -400), (1, 2.0, None, -1), (2, None, 1.0, -5), (2, 3.0, 4.0, -500)]
    df = spark.createDataFrame(rows, "id long, v double, a double, d int")
    spec = {"v": ["nunique"], "a": ["mean", "sum", "max"], "id": ["count"]}
    got = aggregate(df, "id", spec, "I_", [Window("W", "d >= -365")]).orderBy("id").toPandas()
    pdf = pd.DataFrame(rows, columns=["id", "v", "a", "d"])
    g = pdf.groupby("id")
    assert got["I_V_NUNIQUE"].tolist() == g["v"].nunique().tolist()
    assert got["I_A_SUM"].tolist() == g["a"].sum().tolist()
    w = pdf[pdf.d >= -365].groupby("id")
    assert got["WV_NUNIQUE"].tolist() == w["v"].nunique().tolist()
    assert got["WA_MEAN"].tolist() == w["a"].mean().tolist()


def test_hot_key_block_matches_pandas(spark):
    # one customer holds a third of all rows
    import numpy as np
    rng = np.random.default_rng(13)
    n = 900
    ids = np.where(np.arange(n) < n // 3, 7, rng.integers(0, 100, n))
    pdf = pd.DataFrame({"SK_ID_CURR": ids.astype("int64"), "MONTHS_BALANCE": rng.integers(-40, 0, n).astype("int32"),
                        "SK_DPD": rng.integers(0, 200, n).astype("int32"),
                        "CNT_INSTALMENT": rng.normal(10, 3, n), "CNT_INSTALMENT_FUTURE": rng.normal(5, 2, n)})
    from riskloom.plans.blocks import pos_block
    got = pos_block(spark.createDataFrame(pdf)).toPandas().set_index("SK_ID_CURR").sort_index()
    g = pdf.groupby("SK_ID_CURR")
    assert got.loc[7, "POS_SK_ID_CURR_COUNT"] == (ids == 7).sum()
    np.testing.assert_allclose(got["POS_CNT_INSTALMENT_SUM"].values, g["CNT_INSTALMENT"].sum().values)
    np.testing.assert_allclose(got["POS_SK_DPD_MEAN"].values, g["SK_DPD"].mean().values)
    recent = pdf[pdf.MONTHS_BALANCE > -24].groupby("SK_ID_CURR")["SK_DPD"].max()
    np.testing.assert_allclose(got.loc[recent.index, "POS_M24SK_DPD_MAX"].values, recent.values)


def test_block_rows_travel_and_not_their_aggregate_states(spark):
    """One exchange of narrow rows by the key, none between the aggregation's two halves."""
    from riskloom.plans import blocks as B
    from riskloom.sources import fixtures as FX
    d = "/root/testdata/sf0.001"
    for block in (B.prev_block(FX.previous_application(spark, d)), B.pos_block(FX.pos_cash(spark, d)), B.card_block(FX.credit_card(spark, d))):
        plan = block._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning(SK_ID_CURR") == 1
        assert plan.index("Exchange hashpartitioning(SK_ID_CURR") > plan.rindex("HashAggregate(keys=[SK_ID_CURR")
