"""Out-of-fold training with Spark ML.

All of the reference's learners share one shape: preprocess -> k folds -> fit
on k-1 folds -> score the held-out fold and the test rows -> OOF AUC ->
importance.  Here the fold loop runs on the driver (k small), every ``fit`` is
a distributed Spark ML job, and predictions stay a long table
``(id, fold, y, oof_pred)`` plus fold-averaged test scores.  The prepared
training frame is checkpointed once per run so each fold reads it instead of
recomputing the feature plan.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage, fit_frame, fit_room
from .stats import auc_by_group


@dataclass
class CVResult:
    oof: DataFrame            # (id, fold, label, oof_pred)
    test: DataFrame | None    # (id, pred) averaged over folds
    fold_auc: list[float]
    oof_auc: float | None
    importance: DataFrame | None  # (feature, importance) averaged over folds


def assemble(df: DataFrame, features: Sequence[str], out: str = "features") -> DataFrame:
    from pyspark.ml.feature import VectorAssembler
    return VectorAssembler(inputCols=list(features), outputCol=out, handleInvalid="keep").transform(df)


def _p1(col: str = "probability"):
    from pyspark.ml.functions import vector_to_array
    return vector_to_array(F.col(col))[1]


def _importance(model, features: Sequence[str]) -> list[tuple[str, float]] | None:
    imp = getattr(model, "featureImportances", None)
    if imp is not None:
        return [(f, float(v)) for f, v in zip(features, imp.toArray())]
    coef = getattr(model, "coefficients", None)
    if coef is not None:
        return [(f, abs(float(v))) for f, v in zip(features, coef.toArray())]
    if hasattr(model, "getLayers"):
        # a perceptron: sum of the absolute weights of an input in the first layer, whose weights come first, input by input
        inputs, units = model.getLayers()[:2]
        first = abs(model.weights.toArray()[:inputs * units]).reshape(inputs, units)
        return [(f, float(v)) for f, v in zip(features, first.sum(axis=1))]
    return None


def fitted(estimator, rows: DataFrame):
    """The model fitted on ``rows``, without its training summary.

    A model goes to the tasks that score with it, whole.  The summary of a binary logistic model holds the session,
    which cannot be sent any more once an ``Observation`` has been used in it, by whatever job.
    """
    model = estimator.fit(rows)
    if getattr(model, "hasSummary", False):
        model._java_obj.setSummary(rows.sparkSession._jvm.scala.Option.empty())
    return model


def at_once(spark, jobs: Sequence[Callable], parallelism: int) -> list:
    """Results of driver-side jobs that run side by side, in their order; each submits its own Spark jobs."""
    from concurrent.futures import ThreadPoolExecutor

    from pyspark import inheritable_thread_target
    with ThreadPoolExecutor(max(1, parallelism)) as pool:
        return [f.result() for f in [pool.submit(inheritable_thread_target(spark)(job)) for job in jobs]]


def vector_bytes(rows: DataFrame, col: str = "features") -> float:
    """Bytes that a fit caches for a row, as far as the first rows tell: its vector, label and weight."""
    seen = [r[0] for r in rows.select(col).take(100)]
    held = [12 * len(v.indices) if hasattr(v, "indices") else 8 * len(v) for v in seen if v is not None]
    return 16 + sum(held) / max(1, len(held))


def cross_validate(train: DataFrame, features: Sequence[str] | str, make_estimator: Callable,
                   id_col: str = "SK_ID_CURR", label: str = "TARGET", fold: str = "fold",
                   test: DataFrame | None = None, weight_col: str | None = None,
                   score: Callable | None = None,
                   fold_weight: Callable[[int], Column] | None = None, early_stop: bool = False,
                   prepared: bool = False, fold_filter: Callable[[int], Column] | None = None,
                   parallelism: int = 4) -> CVResult:
    """L1: OOF cross-validation with any Spark ML probabilistic classifier.

    ``make_estimator(features_col, label_col, weight_col)`` returns an unfitted
    estimator; ``score(model, frame)`` returns the frame with ``pred`` (default: P(class 1)).
    ``features`` is a list of numeric columns, or the name of an already
    assembled (possibly sparse) vector column.
    ``fold_weight(k)`` (optional) gives the instance-weight expression used
    while fitting fold k's model, for weights that depend on that fold's
    training part (K4/K5).
    ``fold_filter(k)`` (optional) says which rows fold k's model learns from; every row is
    scored all the same.
    ``parallelism`` folds are fitted side by side, each by its own Spark jobs, as far as ``fit_room`` has
    memory for the rows that each fit caches; several runs at a time share that room.
    ``early_stop`` hands the held-out fold to the estimator as its validation
    part (L8; the estimator must have a ``validationIndicatorCol``).
    ``prepared``: ``train`` is already assembled and checkpointed, with the vector
    column ``features``, so that several runs share it.
    """
    if fold_weight is not None:
        weight_col = "_fold_w"
    wsel = [weight_col] if weight_col and fold_weight is None else []
    if prepared:
        data, tst, features = train, test, []
    elif isinstance(features, str):
        # an already assembled (possibly sparse) vector column
        vec = features
        features = []
        data = fit_frame(train.select(id_col, label, fold, *wsel, F.col(vec).alias("features"))
                           .withColumn(label, F.col(label).cast("double")))
        tst = cut_lineage(test.select(id_col, F.col(vec).alias("features"))) if test is not None else None
    else:
        cols = [id_col, label, fold, *features] + wsel
        data = fit_frame(assemble(train.select(*cols), features).withColumn(label, F.col(label).cast("double")))
        tst = cut_lineage(assemble(test.select(id_col, *features), features)) if test is not None else None
    held = {r[0]: r[1] for r in data.groupBy(fold).agg(F.count(F.lit(1))).collect()}  # a row per fold
    folds, row = sorted(held), vector_bytes(data)
    score = score or (lambda m, d: m.transform(d).withColumn("pred", _p1()))
    oof_parts, test_parts, aucs, imps = [], [], [], []

    def fit(k):
        est = make_estimator("features", label, weight_col)
        fit_part = data.where(F.col(fold) != k)
        if early_stop:
            est = est.setValidationIndicatorCol("_held")
            fit_part = data.withColumn("_held", F.col(fold) == k)
        if fold_filter is not None:
            fit_part = fit_part.where(fold_filter(k) if not early_stop else fold_filter(k) | F.col("_held"))
        if fold_weight is not None:
            fit_part = fit_part.withColumn(weight_col, fold_weight(k).cast("double"))
        with fit_room(train.sparkSession, row * (sum(held.values()) - (0 if early_stop else held[k]))):
            return fitted(est, fit_part)

    models = at_once(train.sparkSession, [lambda k=k: fit(k) for k in folds], parallelism)
    for k, model in zip(folds, models):
        pv = score(model, data.where(F.col(fold) == k))
        oof_parts.append(pv.select(id_col, fold, label, F.col("pred").alias("oof_pred")))
        if tst is not None:
            test_parts.append(score(model, tst).select(id_col, "pred"))
        im = _importance(model, features) if features else None
        if im is not None:
            imps += [(f, v, int(k)) for f, v in im]
    oof = oof_parts[0]
    for p in oof_parts[1:]:
        oof = oof.unionByName(p)
    # held-out predictions written once; fold AUCs and the OOF AUC read them
    oof = cut_lineage(oof)
    per_fold = {r[fold]: r["auc"] for r in auc_by_group(oof, "oof_pred", label, [fold]).collect()}
    aucs = [per_fold.get(k) for k in folds]
    oof_auc_row = auc_by_group(oof, "oof_pred", label).first()
    test_avg = None
    if test_parts:
        t = test_parts[0]
        for p in test_parts[1:]:
            t = t.unionByName(p)
        test_avg = t.groupBy(id_col).agg(F.avg("pred").alias("pred"))  # F23
    imp_df = None
    if imps:  # F24 / L14: importance averaged over folds, long table
        imp_df = (train.sparkSession.createDataFrame(imps, "feature string, importance double, fold int")
                  .groupBy("feature").agg(F.avg("importance").alias("importance")))
    return CVResult(oof, test_avg, aucs, None if oof_auc_row is None else oof_auc_row["auc"], imp_df)


# ------------------------------------------------------------------ learners
def _size(d: DataFrame, weight_col: str | None) -> float:
    """Rows of a training part, or their total weight."""
    n = d.agg(F.count(F.lit(1)) if weight_col is None else F.sum(F.col(weight_col).cast("double"))).first()[0]
    return float(n or 1.0)


class _SizedFit:
    """An estimator whose penalty is made from the size of what it is fitted on."""

    def __init__(self, weight_col: str | None, make: Callable[[float], object]):
        self.weight_col, self.make = weight_col, make

    def fit(self, d: DataFrame):
        return self.make(_size(d, self.weight_col)).fit(d)


def logistic_l2(C: float = 1.0, max_iter: int = 100):
    """L2 logistic regression; regParam = 1 / (C * n), n = rows (or weight) of the part it is fitted on."""
    from pyspark.ml.classification import LogisticRegression

    def make(fc, lc, wc):
        kw = dict(featuresCol=fc, labelCol=lc, elasticNetParam=0.0, standardization=False, maxIter=max_iter)
        if wc:
            kw["weightCol"] = wc
        return _SizedFit(wc, lambda n: LogisticRegression(regParam=1.0 / (C * n), **kw))
    return make


def elastic_logistic(reg: float = 0.01, l1_ratio: float = 0.5, max_iter: int = 100):
    """Linear boosted model with L1/L2 penalties -> elastic-net logistic regression.

    ``reg`` is a penalty per row, as the linear booster normalises its penalties by the rows.
    """
    from pyspark.ml.classification import LogisticRegression

    def make(fc, lc, wc):
        kw = dict(featuresCol=fc, labelCol=lc, regParam=reg, elasticNetParam=l1_ratio, maxIter=max_iter)
        if wc:
            kw["weightCol"] = wc
        return LogisticRegression(**kw)
    return make


def boosted_trees(max_depth: int = 5, step: float = 0.1, max_iter: int = 50, subsample: float = 0.8,
                  min_instances: int = 20, seed: int = 42):
    """Gradient-boosted trees (the role of the four boosting libraries)."""
    from pyspark.ml.classification import GBTClassifier

    def make(fc, lc, wc):
        kw = dict(featuresCol=fc, labelCol=lc, maxDepth=max_depth, stepSize=step, maxIter=max_iter,
                  subsamplingRate=subsample, minInstancesPerNode=min_instances, seed=seed)
        if wc:
            kw["weightCol"] = wc
        return GBTClassifier(**kw)
    return make


def random_forest(impurity: str = "gini", num_trees: int = 100, max_depth: int = 10, min_instances: int = 1,
                  seed: int = 42):
    """Random forest, gini / entropy, sqrt feature subsets."""
    from pyspark.ml.classification import RandomForestClassifier

    def make(fc, lc, wc):
        kw = dict(featuresCol=fc, labelCol=lc, impurity=impurity, numTrees=num_trees, maxDepth=max_depth,
                  minInstancesPerNode=min_instances, featureSubsetStrategy="sqrt", seed=seed)
        if wc:
            kw["weightCol"] = wc
        return RandomForestClassifier(**kw)
    return make


def mlp(hidden: Sequence[int] = (32, 16), n_features: int = 1, max_iter: int = 100, seed: int = 42):
    """Multilayer perceptron (weights unsupported: use undersampling K3 for imbalance)."""
    from pyspark.ml.classification import MultilayerPerceptronClassifier

    def make(fc, lc, wc):
        return MultilayerPerceptronClassifier(featuresCol=fc, labelCol=lc, layers=[n_features, *hidden, 2],
                                              maxIter=max_iter, seed=seed)
    return make


def ridge_classifier(alpha: float = 1.0):
    """Least squares on +-1 targets (ridge), scored by the linear decision value.

    Calibration to probabilities is a 1-feature logistic fit on OOF decision
    values (``platt``); AUC only needs the ranking, which is unchanged.
    """
    from pyspark.ml.regression import LinearRegression

    class _Ridge:
        def __init__(self, fc, lc, wc):
            self.fc, self.lc, self.wc = fc, lc, wc

        def fit(self, d):
            kw = dict(featuresCol=self.fc, labelCol="_pm1", regParam=alpha / _size(d, self.wc),
                      elasticNetParam=0.0, standardization=False)
            if self.wc:
                kw["weightCol"] = self.wc
            return LinearRegression(**kw).fit(d.withColumn("_pm1", F.col(self.lc) * 2 - 1))

    return lambda fc, lc, wc: _Ridge(fc, lc, wc)


def ridge_score():
    return lambda m, d: m.transform(d).withColumn("pred", F.col("prediction"))


def grid_search(train: DataFrame, features: Sequence[str], grid: Sequence[dict], factory: Callable,
                id_col: str = "SK_ID_CURR", label: str = "TARGET", fold: str = "fold",
                by: str = "oof_auc", parallelism: int = 4, **cv_kw) -> tuple[DataFrame, CVResult]:
    """L2: one CV per parameter set over one prepared frame, ``parallelism`` sets side by side.

    Returns the table (params, mean fold AUC, std, OOF AUC), best first, and the
    CV result of the set that is best ``by`` "oof_auc" or "mean_auc".
    """
    data = fit_frame(assemble(train.select(id_col, label, fold, *features), features)
                       .withColumn(label, F.col(label).cast("double")))
    rows, results = _grid(data, grid, factory, id_col, label, fold, parallelism, **cv_kw)
    df = train.sparkSession.createDataFrame(rows, "params string, mean_auc double, std_auc double, oof_auc double")
    return df.orderBy(F.desc(by)), results[_best_row(rows, 3 if by == "oof_auc" else 1)]


def _grid(data: DataFrame, grid: Sequence[dict], factory: Callable, id_col: str, label: str, fold: str, parallelism: int, **cv_kw):
    import statistics
    jobs = [lambda p=p: cross_validate(data, "features", factory(**p), id_col, label, fold, prepared=True, **cv_kw) for p in grid]
    results, rows = at_once(data.sparkSession, jobs, parallelism), []
    for params, r in zip(grid, results):
        fa = [a for a in r.fold_auc if a is not None]
        rows.append((str(params), statistics.fmean(fa) if fa else None,
                     statistics.pstdev(fa) if len(fa) > 1 else None, r.oof_auc))
    return rows, results


def _best_row(rows: Sequence[tuple], place: int) -> int:
    """The first row with the largest value."""
    return max(range(len(rows)), key=lambda i: (-1.0 if rows[i][place] is None else rows[i][place], -i))


@dataclass
class SearchResult:
    table: DataFrame   # (params, mean_auc, std_auc, oof_auc) of the search, best first
    params: dict       # the winner
    final: CVResult    # its cross-validation on the final folds, with test scores


def two_level_search(train: DataFrame, test: DataFrame | None, features: Sequence[str], grid: Sequence[dict], factory: Callable,
                     id_col: str = "SK_ID_CURR", label: str = "TARGET", search_fold: str = "fold3", final_fold: str = "fold",
                     parallelism: int = 4) -> SearchResult:
    """L3: rank the grid by mean fold AUC on the search folds (ties to the earlier set), then cross-validate the
    winner on the final folds with test scores averaged over them.

    Both levels read one checkpointed frame that carries both fold columns.
    """
    data = fit_frame(assemble(train.select(id_col, label, search_fold, final_fold, *features), features)
                       .withColumn(label, F.col(label).cast("double")))
    rows, _ = _grid(data, grid, factory, id_col, label, search_fold, parallelism)
    best = _best_row(rows, 1)
    scored = cut_lineage(assemble(test.select(id_col, *features), features)) if test is not None else None
    final = cross_validate(data, "features", factory(**grid[best]), id_col, label, final_fold, test=scored, prepared=True)
    table = train.sparkSession.createDataFrame(rows, "params string, mean_auc double, std_auc double, oof_auc double")
    return SearchResult(table.orderBy(F.desc("mean_auc")), grid[best], final)


# ------------------------------------------------------------------ J10
def permutation_importance(train: DataFrame, features: Sequence[str], make_estimator: Callable, id_col: str = "SK_ID_CURR",
                           label: str = "TARGET", fold: str = "fold", repeats: int = 3, seed: int = 42) -> DataFrame:
    """J10 of a linear model, on every held-out fold: (feature, base_auc, perm_auc, perm_auc_std, importance).

    Each fold's model is fitted once.  A permuted feature moves a row's margin by ``coefficient * (new - old)`` and
    nothing else, so no row is copied with a swapped column: a row meets its partner of each (fold, repeat) once,
    for all features together, and sends one narrow (feature, margin) record per feature.  AUCs are grouped by
    (feature, fold, repeat); their mean over folds and repeats is compared with the mean fold AUC.
    """
    from pyspark.ml.functions import vector_to_array

    from ..functions.ranks import with_row_number
    data = fit_frame(assemble(train.select(id_col, label, fold, *features), features)
                       .select(id_col, label, fold, "features").withColumn(label, F.col(label).cast("double")))
    folds = sorted(r[0] for r in data.select(fold).distinct().collect())
    models = at_once(train.sparkSession, [lambda k=k: fitted(make_estimator("features", label, None), data.where(F.col(fold) != k)) for k in folds], 4)
    coefficients = {k: [float(x) for x in m.coefficients.toArray()] for k, m in zip(folds, models)}
    told = train.sparkSession.createDataFrame([(k, coefficients[k]) for k in folds], f"{fold} int, _coef array<double>")  # a row per fold
    rows = data.withColumn(fold, F.col(fold).cast("int")).join(F.broadcast(told), fold).select(
        id_col, label, fold, F.zip_with(vector_to_array("features"), "_coef", lambda x, c: x * c).alias("_part"))
    rows = rows.withColumn("_margin", F.aggregate("_part", F.lit(0.0), lambda a, x: a + x))
    placed = with_row_number(rows, id_col, [id_col], [fold], out="_at").drop("n")
    tagged = cut_lineage(placed.withColumn("_r", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1)))))
    mixed = tagged.withColumn("_h", F.xxhash64(F.lit(seed), F.col("_r"), F.col(id_col)))
    source = with_row_number(mixed.select(fold, "_r", "_h", id_col, F.col("_part").alias("_new")), "_h", [id_col], [fold, "_r"], out="_at")
    moved = F.zip_with("_new", "_part", lambda a, b: a - b)
    pairs = tagged.join(source.select(fold, "_r", "_at", "_new"), [fold, "_r", "_at"]).select(
        label, fold, "_r", F.posexplode(F.transform(moved, lambda d: F.col("_margin") + d)).alias("_f", "_score"))
    per = auc_by_group(pairs, "_score", label, ["_f", fold, "_r"])
    base = auc_by_group(rows, "_margin", label, [fold]).agg(F.avg("auc").alias("base_auc"))
    names = F.array(*[F.lit(c) for c in features])
    out = per.groupBy("_f").agg(F.avg("auc").alias("perm_auc"), F.stddev_samp("auc").alias("perm_auc_std")).crossJoin(base)  # one row
    return out.select(F.element_at(names, F.col("_f") + 1).alias("feature"), "base_auc", "perm_auc", "perm_auc_std",
                      (F.col("base_auc") - F.col("perm_auc")).alias("importance"))


# ------------------------------------------------------------------ L6 calibration
def platt_calibrate(oof: DataFrame, label: str = "TARGET", score_col: str = "oof_pred"):
    """One-feature logistic fit on decision values -> calibrated probability column ``prob``."""
    from pyspark.ml.classification import LogisticRegression
    d = assemble(oof.withColumn(label, F.col(label).cast("double")), [score_col], "_cf")
    m = fitted(LogisticRegression(featuresCol="_cf", labelCol=label, regParam=0.0), d)
    return m, m.transform(d).select(*oof.columns, _p1().alias("prob"))


def isotonic_calibrate(oof: DataFrame, label: str = "TARGET", score_col: str = "oof_pred"):
    """Isotonic regression of the label on decision values -> ``prob``."""
    from pyspark.ml.regression import IsotonicRegression
    d = assemble(oof.withColumn(label, F.col(label).cast("double")), [score_col], "_cf")
    m = IsotonicRegression(featuresCol="_cf", labelCol=label).fit(d)
    return m, m.transform(d).select(*oof.columns, F.col("prediction").alias("prob"))


# ------------------------------------------------------------------ L16
def imbalance_experiment(train: DataFrame, features: Sequence[str], factory: Callable,
                         id_col: str = "SK_ID_CURR", label: str = "TARGET", fold: str = "fold",
                         strategies: Sequence[str] = ("none", "auto_weight", "balanced", "undersample",
                                                      "scale_pos_weight"),
                         cap: float = 50.0, fixed_spw: float = 5.0, ratio: float = 3.0) -> DataFrame:
    """The same learner under several imbalance strategies -> (strategy, rows, oof_auc, average_precision)."""
    from .stats import average_precision_by_group
    out = None
    for s, r in imbalance_runs(train, features, factory, id_col, label, fold, strategies, cap, fixed_spw, ratio).items():
        told = average_precision_by_group(r.oof, "oof_pred", label).crossJoin(r.oof.agg(F.count(F.lit(1)).alias("rows")))  # one row each
        row = told.select(F.lit(s).alias("strategy"), "rows", F.lit(r.oof_auc).cast("double").alias("oof_auc"), "average_precision")
        out = row if out is None else out.union(row)
    return out


def imbalance_runs(train: DataFrame, features: Sequence[str], factory: Callable, id_col: str = "SK_ID_CURR",
                   label: str = "TARGET", fold: str = "fold",
                   strategies: Sequence[str] = ("none", "auto_weight", "balanced", "undersample", "scale_pos_weight"),
                   cap: float = 50.0, fixed_spw: float = 5.0, ratio: float = 3.0) -> dict[str, CVResult]:
    """Each strategy's cross-validation, over one prepared frame.

    All strategies change the fold's training part alone and every row is scored: auto_weight weighs
    positives min(N/P, cap) (K4), scale_pos_weight by a fixed number (K5), balanced both classes n / (2 n_class)
    (K6), undersample learns from all positives and ratio x P negatives (K3).  N, P and n are counted on
    each fold's own training part, by one grouped count (a row per fold).  Strategies and their folds are fitted
    side by side as far as ``fit_room`` has memory for the rows that each fit caches.
    """
    from .folds import fold_class_counts, fold_undersample
    rows = cut_lineage(train.select(id_col, label, fold, *features))  # read for the counts, for the places and for the rows to keep
    rows = fold_undersample(rows, id_col, label, fold, ratio, out="_keep_for")
    data = fit_frame(assemble(rows, features).select(id_col, label, fold, "_keep_for", "features")
                       .withColumn(label, F.col(label).cast("double")))
    part = {r[fold]: (float(r["neg"]), float(r["pos"])) for r in fold_class_counts(data, label, fold).collect()}

    def weights(by):
        def of(k):
            low, high = by(*part[k])
            return F.when(F.col(label) == 1, F.lit(float(high))).otherwise(F.lit(float(low)))
        return of

    ways = {
        "none": {},
        "auto_weight": {"fold_weight": weights(lambda n, p: (1.0, min(n / p, cap) if p else 1.0))},
        "scale_pos_weight": {"fold_weight": weights(lambda n, p: (1.0, fixed_spw))},
        "balanced": {"fold_weight": weights(lambda n, p: ((n + p) / (2 * n) if n else 1.0, (n + p) / (2 * p) if p else 1.0))},
        "undersample": {"fold_filter": lambda k: F.array_contains("_keep_for", int(k))},
    }
    runs = at_once(train.sparkSession, [lambda s=s: cross_validate(data, "features", factory, id_col, label, fold, prepared=True, **ways[s])
                                        for s in strategies], 4)
    return dict(zip(strategies, runs))


# ------------------------------------------------------------------ L15
def refit_full(train: DataFrame, features: Sequence[str], make_estimator: Callable, label: str = "TARGET",
               weight_col: str | None = None):
    """One fit on every training row (e.g. at the fold-average best iteration),
    returning (model, importance DataFrame or None)."""
    data = assemble(train, features).withColumn(label, F.col(label).cast("double"))
    model = fitted(make_estimator("features", label, weight_col), data)
    im = _importance(model, features)
    imp = None if im is None else train.sparkSession.createDataFrame(im, "feature string, importance double")
    return model, imp


def train_fold_auc(train: DataFrame, features: Sequence[str], make_estimator: Callable,
                   id_col: str = "SK_ID_CURR", label: str = "TARGET", fold: str = "fold") -> DataFrame:
    """Per fold: AUC on the fold's own training part and on its held-out part, in one
    scoring job per fold and one grouped AUC job -> (fold, part, auc)."""
    data = fit_frame(assemble(train.select(id_col, label, fold, *features), features)
                       .withColumn(label, F.col(label).cast("double")))
    folds = sorted(r[0] for r in data.select(fold).distinct().collect())
    parts = []
    for k in folds:
        model = fitted(make_estimator("features", label, None), data.where(F.col(fold) != k))
        sc = model.transform(data).select(
            F.lit(k).alias("_k"), F.when(F.col(fold) == k, "valid").otherwise("train").alias("part"),
            label, _p1().alias("pred"))
        parts.append(sc)
    allp = parts[0]
    for p in parts[1:]:
        allp = allp.unionByName(p)
    return auc_by_group(allp, "pred", label, ["_k", "part"]).withColumnRenamed("_k", fold)


def calibrated_cross_validate(train: DataFrame, features: Sequence[str], make_estimator: Callable,
                              id_col: str = "SK_ID_CURR", label: str = "TARGET", fold: str = "fold",
                              inner_k: int = 5, method: str = "sigmoid", seed: int = 42,
                              score: Callable | None = None) -> DataFrame:
    """L6 with inner calibration: for each outer fold, ``inner_k`` inner folds of its
    training part each fit a model on the inner-train rows and a calibrator
    (Platt ``sigmoid`` or ``isotonic``) on the inner-held-out decision values;
    the outer held-out probability is the mean of the ``inner_k`` calibrated
    models.  Returns (id, fold, label, oof_pred).
    """
    from .folds import kfold
    score = score or ridge_score()
    data = fit_frame(assemble(train.select(id_col, label, fold, *features), features)
                       .withColumn(label, F.col(label).cast("double")))
    outer = sorted(r[0] for r in data.select(fold).distinct().collect())
    parts = []
    for k in outer:
        tr = data.where(F.col(fold) != k)
        va = data.where(F.col(fold) == k)
        inner = kfold(tr.select(id_col), k=inner_k, seed=seed + int(k), out="_if")
        tri = cut_lineage(tr.join(inner, id_col))
        probs = None
        for i in range(inner_k):
            model = fitted(make_estimator("features", label, None), tri.where(F.col("_if") != i))
            held = score(model, tri.where(F.col("_if") == i)).select(id_col, label, F.col("pred").alias("oof_pred"))
            cal = (platt_calibrate if method == "sigmoid" else isotonic_calibrate)(held, label)[0]
            sv = score(model, va).select(id_col, F.col("pred").alias("oof_pred"), F.lit(0.0).alias(label))
            d = assemble(sv, ["oof_pred"], "_cf")
            p = cal.transform(d)
            pcol = _p1().alias("p") if method == "sigmoid" else F.col("prediction").alias("p")
            p = p.select(id_col, pcol)
            probs = p if probs is None else probs.unionByName(p)
        avg = probs.groupBy(id_col).agg(F.avg("p").alias("oof_pred"))
        parts.append(avg.join(va.select(id_col, fold, label), id_col))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select(id_col, fold, label, "oof_pred")
