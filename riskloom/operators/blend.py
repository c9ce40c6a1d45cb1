"""Blending model predictions held as a long table (id, model, pred).

The wide prediction matrix of the reference is never materialised on one
machine: rows are grouped by id into a per-id array of model scores (bounded by
the number of models), and every blend is an array expression.  Rank blends
first replace each model's score by its tie-averaged percentile rank, computed
with the bucketed cumulative-count plan per model.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import clip, logit, sigmoid
from ..functions.ranks import with_average_rank

PROB_METHODS = ("mean", "median", "trimmed_mean", "weighted_mean", "power_mean", "logit_mean")
RANK_METHODS = ("rank_mean", "rank_median", "rank_weighted_mean", "rank_power_mean")


def complete_rows(long: DataFrame, models: Sequence[str], id_col: str = "id") -> DataFrame:
    """Keep ids that have a prediction from every model (outer join, then drop incomplete)."""
    ok = (long.where(F.col("model").isin(*models) & F.col("pred").isNotNull())
              .groupBy(id_col).agg(F.countDistinct("model").alias("_m"))
              .where(F.col("_m") == len(models)).select(id_col))
    return long.where(F.col("model").isin(*models)).join(ok, id_col, "left_semi")


def dropped_count(long: DataFrame, models: Sequence[str], id_col: str = "id") -> DataFrame:
    """E5 report: number of ids dropped because some model lacks a prediction."""
    per = long.where(F.col("model").isin(*models)).groupBy(id_col) \
        .agg(F.countDistinct(F.when(F.col("pred").isNotNull(), F.col("model"))).alias("_m"))
    return per.agg(F.sum((F.col("_m") < len(models)).cast("long")).alias("dropped"),
                   F.count(F.lit(1)).alias("ids"))


def wide(long: DataFrame, models: Sequence[str], id_col: str = "id", value: str = "pred") -> DataFrame:
    """Pivot the long table to one column per model (explicit pivot values)."""
    return long.groupBy(id_col).pivot("model", list(models)).agg(F.first(value))


def _norm_weights(models: Sequence[str], weights: Mapping[str, float] | None) -> list[float]:
    if weights is None:
        raise ValueError("blend: this method needs weights")
    w = [float(weights.get(m, 1.0)) for m in models]
    if any(x < 0 for x in w):
        raise ValueError("blend: a weight is below zero")
    if not any(x > 0 for x in w):
        raise ValueError("blend: all weights are zero")
    s = sum(w)
    return [x / s for x in w]


def _gen_mean(arr: Column, power: float) -> Column:
    if power == 0:
        logs = F.transform(arr, lambda x: F.log(F.greatest(x, F.lit(1e-12))))
        return F.exp(F.aggregate(logs, F.lit(0.0), lambda a, x: a + x) / F.size(arr))
    powered = F.transform(arr, lambda x: F.pow(x, F.lit(float(power))))
    return F.pow(F.aggregate(powered, F.lit(0.0), lambda a, x: a + x) / F.size(arr), F.lit(1.0 / power))


def _mean(arr: Column) -> Column:
    return F.aggregate(arr, F.lit(0.0), lambda a, x: a + x) / F.size(arr)


def _median(arr: Column) -> Column:
    s = F.array_sort(arr)
    n = F.size(s)
    lo = F.element_at(s, ((n - 1) / 2).cast("int") + 1)
    hi = F.element_at(s, (n / 2).cast("int") + 1)
    return (lo + hi) / 2.0


def blend(long: DataFrame, models: Sequence[str], method: str = "mean",
          weights: Mapping[str, float] | None = None, power: float = 1.0, trim_frac: float = 0.1,
          eps: float = 1e-6, clip_prob: bool = True, clip_input: bool = False, id_col: str = "id",
          out: str = "pred") -> DataFrame:
    """Blend the predictions of ``models`` per id; returns (id, pred).

    ``clip_input`` (N13) first clips every prediction to [0, 1].
    """
    models = list(models)
    m = len(models)
    if method not in PROB_METHODS + RANK_METHODS:
        raise ValueError(f"blend: no method {method!r}; one of {PROB_METHODS + RANK_METHODS}")
    if method == "trimmed_mean" and not (0.0 <= trim_frac < 0.5):
        raise ValueError(f"blend: trim_frac is {trim_frac}, not from 0 up to 0.5")
    d = complete_rows(long, models, id_col)
    if clip_input:
        d = d.withColumn("pred", clip("pred", 0.0, 1.0))
    val = "pred"
    if method in RANK_METHODS:
        d = with_average_rank(d, "pred", ["model"], out="_r", pct=True)
        val = "_r"
    # model scores in a fixed model order: sort (model, value) structs, keep values
    agg = d.groupBy(id_col).agg(F.array_sort(F.collect_list(F.struct("model", val))).alias("_s"))
    arr = F.transform(F.col("_s"), lambda s: s[val].cast("double"))
    order = sorted(models)
    base = method.replace("rank_", "")
    if method == "power_mean":
        res = F.when(F.exists(arr, lambda x: x < 0), F.raise_error(
            F.lit("blend: power_mean met a negative prediction"))).otherwise(_gen_mean(arr, power))
    elif base == "power_mean":
        res = _gen_mean(arr, power)
    elif base == "mean":
        res = _mean(arr)
    elif base == "median":
        res = _median(arr)
    elif base == "trimmed_mean":
        k = int(trim_frac * m)
        res = _mean(arr) if k == 0 else _mean(F.slice(F.array_sort(arr), k + 1, m - 2 * k))
    elif base == "weighted_mean":
        w = _norm_weights(order, weights)
        wa = F.array(*[F.lit(x) for x in w])
        res = F.aggregate(F.arrays_zip(arr.alias("v"), wa.alias("w")), F.lit(0.0),
                          lambda a, z: a + z["v"] * z["w"])
    elif base == "logit_mean":
        z = F.transform(arr, lambda x: logit(x, eps))
        res = sigmoid(_mean(z))
    else:  # pragma: no cover
        raise ValueError(method)
    if clip_prob:
        res = clip(res, eps, 1.0 - eps)
    return agg.select(id_col, res.alias(out))


def normalized_weights(weights: DataFrame, models: Sequence[str], key: str = "model",
                       value_cols: Sequence[str] = ("weight", "local_auc", "public_lb")) -> DataFrame:
    """Weight table -> (model, weight) normalised to sum 1.

    Column precedence weight > local_auc > public_lb; models missing from the
    table get 1.0.  The model list is a literal (bounded by the schema).
    """
    present = [c for c in value_cols if c in weights.columns]
    if not present:
        raise ValueError(f"weights table needs one of {value_cols}")
    col = present[0]
    w = weights.select(F.lower(F.col(key)).alias("_k"), F.col(col).cast("double").alias("_w"))
    mdf = weights.sparkSession.createDataFrame([(x, x.lower()) for x in models], "model string, _k string")
    j = mdf.join(w, "_k", "left").select("model", F.coalesce(F.col("_w"), F.lit(1.0)).alias("weight"))
    tot = j.agg(F.sum("weight").alias("_t")).withColumn("_j", F.lit(0))
    return (j.withColumn("_j", F.lit(0)).join(F.broadcast(tot), "_j")
             .select("model", (F.col("weight") / F.col("_t")).alias("weight")))


def blend_report(long: DataFrame, models: Sequence[str], weights: Mapping[str, float] | None = None,
                 id_col: str = "id") -> DataFrame:
    """Per model weight, mean, std and average Spearman with the other models."""
    from ..operators.stats import spearman_matrix
    d = complete_rows(long, models, id_col)
    st = d.groupBy("model").agg(F.avg("pred").alias("mean"), F.stddev_samp("pred").alias("std"))
    sm = spearman_matrix(wide(d, models, id_col), list(models), id_col)
    avg_corr = (sm.where(F.col("col_a") != F.col("col_b")).groupBy("col_a")
                  .agg(F.avg("corr").alias("avg_spearman")).withColumnRenamed("col_a", "model"))
    w = _norm_weights(sorted(models), weights) if weights is not None else [1.0 / len(models)] * len(models)
    wdf = long.sparkSession.createDataFrame(list(zip(sorted(models), w)), "model string, weight double")
    return wdf.join(st, "model").join(avg_corr, "model", "left")


def alpha_blend(a: DataFrame, b: DataFrame, alpha: float = 0.5, id_col: str = "id") -> DataFrame:
    """Alpha * a + (1 - alpha) * b joined on id (suffixes disambiguate, E6)."""
    j = a.select(id_col, F.col("pred").alias("pred_a")).join(
        b.select(id_col, F.col("pred").alias("pred_b")), id_col, "inner")
    return j.select(id_col, (F.lit(alpha) * F.col("pred_a") + F.lit(1 - alpha) * F.col("pred_b")).alias("pred"))
