"""Boosted trees that stop at the best number of rounds by validation AUC.

A boosted model of n rounds contains the models of all smaller numbers of rounds: the margin after r rounds is
the running sum of the first r weighted trees.  So each fold is fitted once with all rounds, one pass
scores every prefix of its trees on the held-out rows, one grouped job gives the exact AUC of each (fold, rounds),
and the best prefix is read off as early stopping would have.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage, fit_frame
from .stats import auc_by_group
from .train import CVResult, assemble, at_once


def staged_margins(model, frame: DataFrame, keep: Sequence[str], out: str = "margins") -> DataFrame:
    """Columns ``keep`` of ``frame`` (with ``features``) plus the array of margins after 1, 2, ... rounds, in one pass."""
    scored = frame
    for i, tree in enumerate(model.trees):
        tree.setFeaturesCol("features").setPredictionCol(f"_tree{i}")
        scored = tree.transform(scored)
    steps = F.array(*[F.col(f"_tree{i}") * F.lit(float(w)) for i, w in enumerate(model.treeWeights)])
    scored = scored.select(*keep, steps.alias(out))
    return scored.mapInArrow(_running_sums, scored.schema)


def _running_sums(batches):
    """Arrow map: the last column, arrays of one length, becomes its running sums."""
    for batch in batches:
        steps = batch.column(batch.num_columns - 1)
        sums = np.cumsum(steps.flatten().to_numpy().reshape(batch.num_rows, -1), axis=1)
        ends = pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * sums.shape[1])
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.ListArray.from_arrays(ends, pa.array(sums.ravel()))], names=batch.schema.names)


def probability(margin):
    """P(class 1) of a boosted classifier's margin."""
    return F.lit(1.0) / (F.lit(1.0) + F.exp(F.lit(-2.0) * margin))


def stopping_round(aucs: Sequence[float | None], patience: int) -> int:
    """Rounds (from 1) that early stopping keeps: the best until ``patience`` rounds have passed without a better one."""
    best, top = 1, None
    for r, a in enumerate(aucs, 1):
        if a is not None and (top is None or a > top):
            best, top = r, a
        elif r - best >= patience:
            break
    return best


@dataclass
class BoostedResult:
    cv: CVResult
    rounds: dict        # fold -> chosen number of rounds
    stages: DataFrame   # (fold, round, auc) of every prefix on the held-out rows

    def average_rounds(self, least: int = 50) -> int:
        """Number of rounds for a model on all rows: the mean over the folds, ``least`` at least."""
        return max(least, int(sum(self.rounds.values()) / len(self.rounds)))


def boosted_cross_validate(train: DataFrame, features: Sequence[str], make_estimator: Callable, id_col: str = "SK_ID_CURR",
                           label: str = "TARGET", fold: str = "fold", test: DataFrame | None = None,
                           patience: int = 200, parallelism: int = 4) -> BoostedResult:
    """Out-of-fold and fold-averaged test scores at each fold's best number of rounds.

    ``make_estimator`` gives a boosted-tree classifier whose maxIter is the most rounds tried.  Importances are those
    of the trees that a fold keeps.
    """
    spark = train.sparkSession
    data = fit_frame(assemble(train.select(id_col, label, fold, *features), features)
                       .select(id_col, label, fold, "features").withColumn(label, F.col(label).cast("double")))
    tst = cut_lineage(assemble(test.select(id_col, *features), features).select(id_col, "features")) if test is not None else None
    folds = sorted(r[0] for r in data.select(fold).distinct().collect())
    fits = at_once(spark, [lambda k=k: make_estimator("features", label, None).fit(data.where(F.col(fold) != k)) for k in folds], parallelism)
    models, held = dict(zip(folds, fits)), None
    for k in folds:
        part = staged_margins(models[k], data.where(F.col(fold) == k), [id_col, label, fold])
        held = part if held is None else held.unionByName(part)
    held = cut_lineage(held)
    each = held.select(fold, label, F.posexplode("margins").alias("_at", "_margin"))
    stages = cut_lineage(auc_by_group(each, "_margin", label, [fold, "_at"]).select(fold, (F.col("_at") + 1).alias("round"), "auc"))
    found = {k: {} for k in folds}
    for r in stages.collect():  # folds x rounds
        found[r[fold]][r["round"]] = r["auc"]
    rounds = {k: stopping_round([found[k].get(i) for i in range(1, len(models[k].trees) + 1)], patience) for k in folds}
    chosen = F.create_map(*[F.lit(x) for k in folds for x in (k, rounds[k])])[F.col(fold)]
    oof = cut_lineage(held.select(id_col, fold, label, probability(F.element_at("margins", chosen)).alias("oof_pred")))
    test_avg, gains = None, []
    for k in folds:
        if tst is not None:
            p = staged_margins(models[k], tst, [id_col]).select(id_col, probability(F.element_at("margins", F.lit(rounds[k]))).alias("pred"))
            test_avg = p if test_avg is None else test_avg.unionByName(p)
        for tree in models[k].trees[:rounds[k]]:
            gains += [(features[int(i)], float(v) / rounds[k] / len(folds)) for i, v in zip(tree.featureImportances.indices, tree.featureImportances.values)]
    if test_avg is not None:
        test_avg = test_avg.groupBy(id_col).agg(F.avg("pred").alias("pred"))
    importance = dict.fromkeys(features, 0.0)
    for name, v in gains:
        importance[name] += v
    table = spark.createDataFrame(sorted(importance.items()), "feature string, importance double")
    total = auc_by_group(oof, "oof_pred", label).first()
    cv = CVResult(oof, test_avg, [found[k].get(rounds[k]) for k in folds], None if total is None else total["auc"], table)
    return BoostedResult(cv, rounds, stages)


def refit_at_average(train: DataFrame, features: Sequence[str], factory: Callable, result: BoostedResult,
                     label: str = "TARGET", least: int = 50):
    """One model on all train rows with the folds' average number of rounds -> (model, rounds, importance).

    ``factory(rounds)`` returns the ``make_estimator`` of that many rounds.
    """
    from .train import refit_full
    n = result.average_rounds(least)
    model, importance = refit_full(train, features, factory(n), label)
    return model, n, importance
