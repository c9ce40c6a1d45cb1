import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from riskloom.functions.ranks import exact_quantiles, with_average_rank, with_row_number
from riskloom.operators.stats import auc_by_group, average_precision_by_group, spearman_with_label


def _brute_auc(s, y):
    pos = [a for a, b in zip(s, y) if b == 1]
    neg = [a for a, b in zip(s, y) if b == 0]
    tot = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
    return tot / (len(pos) * len(neg))


def test_rank_matches_pandas_with_ties(spark):
    rng = np.random.default_rng(0)
    vals = rng.integers(0, 20, 500).astype(float)
    pdf = pd.DataFrame({"id": range(500), "g": rng.integers(0, 3, 500), "v": vals})
    df = spark.createDataFrame(pdf)
    got = with_average_rank(df, "v", ["g"], out="r", buckets=4).toPandas().sort_values("id")
    exp = pdf.groupby("g")["v"].rank(method="average")
    np.testing.assert_allclose(got["r"].values, exp.values)
    rn = with_row_number(df, "v", ["id"], out="rn", buckets=4).toPandas().sort_values("id")
    np.testing.assert_allclose(rn["rn"].values, pdf["v"].rank(method="first").values)


def test_quantiles_match_pandas(spark):
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame({"v": rng.normal(size=301)})
    q = exact_quantiles(spark.createDataFrame(pdf), "v", [0.1, 0.5, 0.9], buckets=5).toPandas().sort_values("p")
    np.testing.assert_allclose(q["q"].values, pdf["v"].quantile([0.1, 0.5, 0.9]).values)


def test_auc_ap_spearman_bruteforce(spark):
    rng = np.random.default_rng(2)
    s = rng.integers(0, 10, 200).astype(float)
    y = (rng.random(200) < 0.3).astype(int)
    df = spark.createDataFrame(pd.DataFrame({"s": s, "y": y}))
    a = auc_by_group(df, "s", "y").first()["auc"]
    assert abs(a - _brute_auc(s, y)) < 1e-12
    # average precision: sum over distinct thresholds (descending) of dTP/P * precision
    order = sorted(set(s), reverse=True)
    P = y.sum()
    ap, tp, cum = 0.0, 0, 0
    for t in order:
        m = s == t
        tp += y[m].sum()
        cum += m.sum()
        ap += y[m].sum() / P * tp / cum
    got = average_precision_by_group(df, "s", "y").first()["average_precision"]
    assert abs(got - ap) < 1e-12
    rho = spearman_with_label(df, "s", "y").first()["spearman_abs"]
    exp = abs(pd.Series(s).rank().corr(pd.Series(y).rank()))
    assert abs(rho - exp) < 1e-12


def test_row_number_keeps_every_row(spark):
    """A third of the rows share one value; ids repeat and some are NULL."""
    rng = np.random.default_rng(11)
    n = 600
    v = np.where(rng.random(n) < 0.4, 3.0, rng.integers(0, 50, n).astype(float))
    ids = [None if i % 37 == 0 else int(x) for i, x in enumerate(rng.integers(0, 300, n))]
    rows = [(i, ids[i], int(rng.integers(0, 2)), float(v[i])) for i in range(n)]
    df = spark.createDataFrame(rows, "row int, id int, g int, v double")
    for buckets in (1, 4, 64):
        got = with_row_number(df, "v", ["id"], ["g"], out="rn", buckets=buckets).collect()
        assert sorted(r["row"] for r in got) == list(range(n))
        for g in (0, 1):
            part = sorted((r for r in got if r["g"] == g), key=lambda r: r["rn"])
            assert [r["rn"] for r in part] == list(range(1, len(part) + 1)) and {r["n"] for r in part} == {len(part)}
            order = [(r["v"], r["id"] is not None, r["id"] or 0) for r in part]
            assert order == sorted(order)
