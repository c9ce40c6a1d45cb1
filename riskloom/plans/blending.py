"""Q16: the AUC-weighted blend runner - weights, both blends and the report of one set of predictions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.exprs import clip
from ..functions.ranks import with_average_rank
from ..operators.blend import _norm_weights, blend_report, complete_rows, normalized_weights
from ..operators.stats import auc_by_group


class BlendRun(NamedTuple):
    scores: DataFrame  #: (id, probability, rank)
    report: DataFrame  #: a row per model


def model_weights(spark: SparkSession, models: Sequence[str], table: DataFrame | None = None,
                  manual: Mapping[str, float] | None = None) -> DataFrame:
    """(model, weight) of sum 1 from a table, else from scores given by hand, else equal; a model without one counts 1."""
    if table is None:
        table = spark.createDataFrame([(m, float(w)) for m, w in (manual or {}).items()], "model string, weight double")
    return normalized_weights(table, models)


def auc_weights(long: DataFrame, labels: DataFrame, models: Sequence[str], id_col: str = "id", target: str = "TARGET") -> DataFrame:
    """Each model's AUC on the labelled ids as a table for ``model_weights``."""
    known = long.where(F.col("model").isin(*models)).join(labels.where(F.col(target).isNotNull()), id_col)
    return auc_by_group(known, "pred", target, ["model"]).select("model", F.col("auc").alias("local_auc"))


def weighted_run(long: DataFrame, models: Sequence[str], weights: DataFrame, id_col: str = "id") -> BlendRun:
    """N13, N14 and N15 with one ranking and one shuffle by id: weighted predictions clipped to [0, 1], weighted ranks, report.

    ``long`` has one row per id and model; ids that lack a model's prediction are left out.
    """
    models = list(models)
    given = {r["model"]: r["weight"] for r in weights.where(F.col("model").isin(*models)).collect()}  # a row per model
    share = dict(zip(models, _norm_weights(models, given)))
    weight = F.create_map(*[F.lit(x) for pair in share.items() for x in pair])[F.col("model")]
    ranked = with_average_rank(complete_rows(long, models, id_col), "pred", ["model"], out="_rank", pct=True)
    scores = ranked.groupBy(id_col).agg(F.sum(weight * clip("pred", 0.0, 1.0)).alias("probability"),
                                        F.sum(weight * F.col("_rank")).alias("rank"))
    return BlendRun(scores, blend_report(long, models, share, id_col))
