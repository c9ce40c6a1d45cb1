import math

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from riskloom.functions import exprs as X


def test_ieee_div_and_sentinel(spark):
    df = spark.createDataFrame([(1.0, 0.0), (-1.0, 0.0), (0.0, 0.0), (6.0, 3.0), (None, 2.0)], "a double, b double")
    r = df.select(X.ieee_div("a", "b", "inf").alias("i"), X.ieee_div("a", "b").alias("n")).collect()
    assert r[0]["i"] == math.inf and r[1]["i"] == -math.inf and r[2]["i"] is None and r[3]["i"] == 2.0
    assert r[0]["n"] is None and r[3]["n"] == 2.0 and r[4]["n"] is None
    s = spark.createDataFrame([(365243,), (-5,), (None,)], "d int")
    out = s.select(X.sentinel_to_null("d").alias("v"), X.sentinel_flag("d").alias("f")).collect()
    assert [o["v"] for o in out] == [None, -5, None]
    assert [o["f"] for o in out] == [1, 0, 0]


def test_row_stats_match_pandas(spark):
    rows = [(0.1, None, 0.5), (None, None, None), (0.2, 0.4, 0.9), (0.3, None, None)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    cols = ["a", "b", "c"]
    got = df.select(X.row_mean(cols).alias("m"), X.row_std(cols).alias("s"), X.row_min(cols).alias("lo"),
                    X.row_max(cols).alias("hi"), X.row_null_count(cols).alias("k")).toPandas()
    pdf = pd.DataFrame(rows, columns=cols, dtype=float)
    np.testing.assert_allclose(got["m"].astype(float), pdf.mean(axis=1), equal_nan=True)
    np.testing.assert_allclose(got["s"].astype(float), pdf.std(axis=1), equal_nan=True)
    np.testing.assert_allclose(got["lo"].astype(float), pdf.min(axis=1), equal_nan=True)
    assert got["k"].tolist() == pdf.isna().sum(axis=1).tolist()


def test_annuity_rate_recovers_rate(spark):
    cases = [(12, 0.01), (36, 0.005), (60, 0.02), (24, -0.003)]
    rows = []
    for n, r in cases:
        pv = 1000.0
        pmt = pv * r / (1 - (1 + r) ** -n)
        rows.append((float(n), pmt, pv, r))
    rows.append((12.0, 100.0, 1200.0, 0.0))      # pmt * n == pv
    rows.append((0.0, 100.0, 1200.0, None))      # n <= 0
    rows.append((12.0, None, 1200.0, None))      # missing
    df = spark.createDataFrame(rows, "n double, pmt double, pv double, r double")
    got = df.select("r", X.annuity_rate("n", "pmt", "pv").alias("est")).collect()
    for g in got:
        if g["r"] is None:
            assert g["est"] is None
        else:
            assert abs(g["est"] - g["r"]) < 1e-10


def test_bround_int_half_even(spark):
    df = spark.createDataFrame([(2.5,), (3.5,), (None,), (float("inf"),)], "x double")
    assert [r[0] for r in df.select(X.bround_int("x")).collect()] == [2, 4, 0, 0]
