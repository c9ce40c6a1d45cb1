"""Feature-set validation — the same learner on each Q7 feature version.

All versions are column choices of one wide frame, which is filled, given plain seeded folds (K2) and checkpointed
once.  Each fold's model is scored on its own training part and on its held-out part.  Output:
(version, fold, part, auc) plus an overall row (fold -1) per version and part, the mean over folds.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.folds import kfold
from ..operators.stats import fill_medians
from ..operators.train import at_once, train_fold_auc
from ..session import cut_lineage
from .application import wide_features


def version_profile(app: DataFrame) -> DataFrame:
    """(version, feature, present, total): non-missing values and their sum for every column of every feature set."""
    wide, versions = wide_features(app)
    columns = sorted({c for cols in versions.values() for c in cols})
    cells = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"`{c}`").cast("double").alias("x")) for c in columns])
    sums = (wide.select(F.explode(cells).alias("s")).select("s.*").groupBy("feature")
            .agg(F.count("x").alias("present"), F.sum("x").alias("total")))
    masks = app.sparkSession.createDataFrame([(v, c) for v, cols in versions.items() for c in cols], "version int, feature string")
    return masks.join(F.broadcast(sums), "feature").select("version", "feature", "present", "total")  # one row per column


def feature_version_validation(app: DataFrame, make_estimator: Callable, versions: Sequence[int] = range(8),
                               k: int = 5, seed: int = 50, parallelism: int = 4) -> DataFrame:
    wide, masks = wide_features(app)
    train = wide.where(F.col("split") == "train").drop("split")
    columns = sorted({c for v in versions for c in masks[v]})
    folds = kfold(train.select("SK_ID_CURR"), k=k, seed=seed)
    filled = cut_lineage(fill_medians(train.select("SK_ID_CURR", "TARGET", *[F.col(f"`{c}`") for c in columns]), columns)
                         .join(folds.select("SK_ID_CURR", "fold"), "SK_ID_CURR"))
    jobs = [lambda v=v: train_fold_auc(filled, masks[v], make_estimator).withColumn("version", F.lit(int(v))) for v in versions]
    out = None
    for r in at_once(app.sparkSession, jobs, parallelism):
        out = r if out is None else out.unionByName(r)
    overall = out.groupBy("version", "part").agg(F.avg("auc").alias("auc")).withColumn("fold", F.lit(-1))
    return out.unionByName(overall.select(*out.columns))
