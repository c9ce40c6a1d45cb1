"""

``entry(spark)`` runs the flagship query (Q1, previous-application block) on
sf0.001.  ``queries()`` binds every implemented operator to the given tables;
``oracle_sql()`` gives the equivalent DuckDB SQL.  Results pass through
``canon`` (integral -> bigint, fractional -> double rounded to 6 places) on both
sides so float summation order cannot break the value hash.  A fixed offset
of 3.7e-8 is added before rounding (same on both sides): values built from cents
divided by small counts often sit exactly on a 7th-decimal tie, where one ulp of
summation noise would flip the rounded digit.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

_HERE = os.path.dirname(os.path.abspath(__file__))
if _HERE not in sys.path:
    sys.path.insert(0, _HERE)

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from riskloom.plans import blocks as B  # noqa: E402
from riskloom.sources import fixtures as FX  # noqa: E402

try:  # the optional subpackage; everything else works without it
    from riskloom.llm import queries as _llm  # noqa: E402
except ModuleNotFoundError as e:
    if not (e.name or "").startswith("riskloom.llm"):
        raise
    _llm = None
try:  # the optional pipeline over that subpackage
    import corpus_pipeline as _pipeline  # noqa: E402
except ModuleNotFoundError as e:
    if e.name != "corpus_pipeline" and not (e.name or "").startswith("riskloom.llm"):
        raise
    _pipeline = None

SF0001 = "/root/testdata/sf0.001"
ROUND_OFFSET = 3.7e-8


def canon(df: DataFrame) -> DataFrame:
    out = []
    for f in df.schema.fields:
        t = f.dataType.typeName()
        c = F.col(f"`{f.name}`")
        if t in ("byte", "short", "integer", "long"):
            out.append(c.cast("long").alias(f.name))
        elif t in ("float", "double") or t.startswith("decimal"):
            out.append(F.round(c.cast("double") + F.lit(ROUND_OFFSET), 6).alias(f.name))
        elif t == "boolean":
            out.append(c.cast("long").alias(f.name))
        else:
            out.append(c)
    return df.select(*out)


# ------------------------------------------------------------------ queries
def q_prev(spark, d):
    return B.prev_block(FX.previous_application(spark, d))


def q_bureau(spark, d):
    return B.bureau_block(FX.bureau(spark, d), FX.bureau_balance(spark, d))


def q_pos(spark, d):
    return B.pos_block(FX.pos_cash(spark, d))


def q_ins(spark, d):
    return B.installments_block(FX.installments(spark, d))


def q_card(spark, d):
    return B.card_block(FX.credit_card(spark, d))


def q_assembly(spark, d):
    app = FX.application(spark, d)
    base = app.select("SK_ID_CURR", "split", "TARGET")
    blocks = B.all_blocks(FX.previous_application(spark, d), FX.bureau(spark, d),
                          FX.bureau_balance(spark, d), FX.pos_cash(spark, d),
                          FX.installments(spark, d), FX.credit_card(spark, d))
    return B.assemble(base, blocks)


def q_app_v7(spark, d):
    from riskloom.plans.application import feature_set
    return feature_set(FX.application(spark, d), version=7)


APP_LABELS = ["NAME_EDUCATION_TYPE", "NAME_HOUSING_TYPE", "NAME_INCOME_TYPE", "NAME_TYPE_SUITE"]


def _app_long(spark, d, train_only=True):
    from riskloom.operators.stats import long_numeric, numeric_columns
    app = FX.application(spark, d)
    if train_only:
        app = app.where(F.col("split") == "train")
    cols = numeric_columns(app, exclude=("SK_ID_CURR", "TARGET", "split"))
    return long_numeric(app, ["SK_ID_CURR", "TARGET"], cols)


def q_auc(spark, d):
    from riskloom.operators.stats import auc_by_group
    return auc_by_group(_app_long(spark, d), "value", "TARGET", ["feature"])


def q_ap(spark, d):
    from riskloom.operators.stats import average_precision_by_group
    return average_precision_by_group(_app_long(spark, d), "value", "TARGET", ["feature"])


def q_spearman(spark, d):
    from riskloom.operators.stats import spearman_with_label
    return spearman_with_label(_app_long(spark, d), "value", "TARGET", ["feature"])


def q_mi(spark, d):
    from riskloom.operators.encode import melt
    from riskloom.operators.stats import mutual_information
    app = FX.application(spark, d).where(F.col("split") == "train")
    long = melt(app.select("SK_ID_CURR", "TARGET", *APP_LABELS), ["SK_ID_CURR", "TARGET"], APP_LABELS)
    return mutual_information(long.where(F.col("value").isNotNull()), "value", "TARGET", ["feature"])


def q_quantiles(spark, d):
    from riskloom.operators.stats import numeric_columns, quantiles_long
    app = FX.application(spark, d)
    cols = numeric_columns(app, exclude=("SK_ID_CURR", "TARGET", "split"))
    return quantiles_long(app, cols, [0.1, 0.5, 0.9])


def q_missing(spark, d):
    from riskloom.operators.stats import missing_table
    t = q_assembly(spark, d)
    return missing_table(t, [c for c in t.columns if c not in ("SK_ID_CURR", "split")])


def q_audit(spark, d):
    from riskloom.operators.stats import column_audit
    return column_audit(FX.application(spark, d), exclude=("SK_ID_CURR",))


def q_pearson(spark, d):
    from riskloom.operators.stats import numeric_columns, pearson_matrix
    app = FX.application(spark, d)
    return pearson_matrix(app, numeric_columns(app, exclude=("SK_ID_CURR", "TARGET")))


def q_category_rate(spark, d):
    from riskloom.operators.stats import category_target_rate
    return category_target_rate(FX.application(spark, d).where(F.col("split") == "train"), "NAME_INCOME_TYPE")


def q_label_balance(spark, d):
    from riskloom.operators.stats import label_balance
    return label_balance(FX.application(spark, d).where(F.col("split") == "train"))


def q_duplicates(spark, d):
    from riskloom.operators.stats import duplicate_columns
    t = q_assembly(spark, d)
    return duplicate_columns(t, [c for c in t.columns if c not in ("SK_ID_CURR", "split", "TARGET")], "SK_ID_CURR")


BLEND_MODELS = ["m1", "m2", "m3", "m4"]
BLEND_WEIGHTS = {"m1": 0.79, "m2": 0.77, "m3": 0.78, "m4": 0.5}
BLENDS = {
    "q23_blend_mean": ("mean", {}),
    "q24_blend_median": ("median", {}),
    "q25_blend_trimmed_mean": ("trimmed_mean", {"trim_frac": 0.25}),
    "q26_blend_weighted_mean": ("weighted_mean", {}),
    "q27_blend_power_mean": ("power_mean", {"power": 2.0}),
    "q28_blend_geometric_mean": ("power_mean", {"power": 0.0}),
    "q29_blend_logit_mean": ("logit_mean", {}),
    "q30_blend_rank_mean": ("rank_mean", {}),
    "q31_blend_rank_median": ("rank_median", {}),
    "q32_blend_rank_weighted_mean": ("rank_weighted_mean", {}),
    "q33_blend_rank_power_mean": ("rank_power_mean", {"power": 0.5}),
}


def _train_app(spark, d):
    return FX.application(spark, d).where(F.col("split") == "train").select("SK_ID_CURR", "TARGET")


def q_folds(spark, d):
    from riskloom.operators.folds import stratified_folds
    return stratified_folds(_train_app(spark, d), k=5, seed=42)


def q_pos_weights(spark, d):
    from riskloom.operators.folds import positive_weights, stratified_folds
    return positive_weights(stratified_folds(_train_app(spark, d)), cap=50.0)


def q_undersample(spark, d):
    from riskloom.operators.folds import undersample
    return undersample(_train_app(spark, d), ratio=3.0, seed=42)


def q_balanced(spark, d):
    from riskloom.operators.folds import balanced_weight
    return balanced_weight(_train_app(spark, d))


def _blend_query(method, kw):
    def run(spark, d):
        from riskloom.operators.blend import blend
        w = BLEND_WEIGHTS if "weighted" in method else None
        return blend(FX.predictions(spark, d), BLEND_MODELS, method, weights=w, **kw)
    return run


def q_alpha(spark, d):
    from riskloom.operators.blend import alpha_blend, blend
    p = FX.predictions(spark, d)
    return alpha_blend(blend(p, BLEND_MODELS, "rank_mean"),
                       blend(p, BLEND_MODELS, "weighted_mean", weights=BLEND_WEIGHTS), 0.5)


def q_pct_rank(spark, d):
    from riskloom.functions.ranks import with_average_rank
    return with_average_rank(FX.predictions(spark, d), "pred", ["model"], out="rank", pct=True).drop("pred")


def _app_split(spark, d):
    app = FX.application(spark, d)
    train = app.where(F.col("split") == "train").drop("split")
    test = app.where(F.col("split") == "test").drop("split", "TARGET")
    return train, test


def q_oof_auc(spark, d):
    from riskloom.operators.stats import numeric_columns
    from riskloom.plans.screen import oof_single_feature_auc
    train, _ = _app_split(spark, d)
    return oof_single_feature_auc(train, numeric_columns(train, exclude=("SK_ID_CURR", "TARGET")))


def q_stage1(spark, d):
    from riskloom.plans.screen import stage1_metrics
    app = FX.application(spark, d).drop("split")  # test rows have no target
    return stage1_metrics(app, [c for c in app.columns if c not in ("SK_ID_CURR", "TARGET")])


def q_screening(spark, d):
    """Q13: both stages in a row; the metrics of the features that the reduced tables keep."""
    from riskloom.plans.screen import run
    train, test = _app_split(spark, d)
    _, metrics, _, reduced = run(train, test)
    return metrics.where(F.col("feature").isin(*[c for c in reduced.columns if c != "SK_ID_CURR"]))


def q_stage0(spark, d):
    from riskloom.plans.screen import stage0
    train, test = _app_split(spark, d)
    audit, _ = stage0(train, test)
    return audit


def q_financial(spark, d):
    from riskloom.plans.financial import financial_block
    return financial_block(FX.application(spark, d))


def q_rank_qbin(spark, d):
    from riskloom.operators.encode import rank_quantile_bin
    app = FX.application(spark, d).select("SK_ID_CURR", "EXT_SOURCE_2")
    return rank_quantile_bin(app, "EXT_SOURCE_2", 64).drop("EXT_SOURCE_2")


def q_equal_width(spark, d):
    from riskloom.operators.encode import equal_width_bin
    app = FX.application(spark, d).select("SK_ID_CURR", "AMT_INCOME_TOTAL")
    return equal_width_bin(app, "AMT_INCOME_TOTAL", 10).drop("AMT_INCOME_TOTAL")


def _woe_model(spark, d):
    """C9 + C11 over every column of the application table."""
    from riskloom.operators.encode import fit_woe
    from riskloom.operators.stats import numeric_columns
    app = FX.application(spark, d)
    return app, fit_woe(app, numeric_columns(app, exclude=("SK_ID_CURR", "TARGET")), APP_LABELS)


def q_woe(spark, d):
    return _woe_model(spark, d)[1].table


def q_rebuilt_term(spark, d):
    from riskloom.plans.financial import rebuilt_term_block
    return rebuilt_term_block(FX.previous_application(spark, d), FX.application(spark, d))


def _model_frame(spark, d, test=False):
    """Train rows of the application v7 features (categories are coded by then), median-filled with train
    medians, with stratified folds; with ``test`` also the test rows, filled alike."""
    from riskloom.operators.folds import stratified_folds
    from riskloom.operators.stats import fill_medians, numeric_columns
    from riskloom.plans.application import feature_set
    from riskloom.session import cut_lineage
    v7 = cut_lineage(feature_set(FX.application(spark, d), version=7))  # read for the medians and for every row set
    train = v7.where(F.col("split") == "train").drop("split")
    feats = numeric_columns(train, exclude=("SK_ID_CURR", "TARGET"))
    folds = stratified_folds(_train_app(spark, d))
    df = fill_medians(train, feats).join(folds.select("SK_ID_CURR", "fold"), "SK_ID_CURR")
    if not test:
        return df, feats
    return df, feats, fill_medians(v7.where(F.col("split") == "test").drop("split"), feats, fit_df=train)


def q_oof_logistic(spark, d):
    from riskloom.operators.stats import standardize
    from riskloom.operators.train import cross_validate, logistic_l2
    df, feats = _model_frame(spark, d)
    df = standardize(df, feats)
    return cross_validate(df, feats, logistic_l2(C=1.0)).oof


def _boosted(spark, d, rounds, depth=3):
    from riskloom.operators.boosting import boosted_cross_validate
    from riskloom.operators.train import boosted_trees
    df, feats, test = _model_frame(spark, d, test=True)
    return df, feats, boosted_cross_validate(df, feats, boosted_trees(max_depth=depth, max_iter=rounds), test=test, patience=10)


def q_oof_gbt(spark, d):
    """Boosted trees, each fold stopped at its best number of rounds by validation AUC; out-of-fold and test scores."""
    return _oof_and_test(_boosted(spark, d, 40)[2].cv)


def q_oof_rf(spark, d):
    from riskloom.operators.train import cross_validate, random_forest
    df, feats = _model_frame(spark, d)
    return cross_validate(df, feats, random_forest(num_trees=30, max_depth=6)).oof


def q_meta_logistic(spark, d):
    """Logistic meta-learner over the clipped prediction matrix of the four base scores: out-of-fold and test scores."""
    from riskloom.operators.train import logistic_l2
    return _oof_and_test(_meta_linear(spark, d, logistic_l2(C=1.0)))


def _meta_linear(spark, d, estimator, **options):
    from riskloom.functions.exprs import clip
    from riskloom.operators.blend import complete_rows, wide
    from riskloom.operators.folds import stratified_folds
    from riskloom.operators.train import cross_validate
    p = complete_rows(FX.predictions(spark, d), BLEND_MODELS)
    w = wide(p.withColumn("pred", clip("pred", 1e-4, 0.9999)), BLEND_MODELS).withColumnRenamed("id", "SK_ID_CURR")
    tr = _train_app(spark, d)
    df = w.join(tr, "SK_ID_CURR").join(stratified_folds(tr).select("SK_ID_CURR", "fold"), "SK_ID_CURR")
    test = w.join(FX.application(spark, d).where(F.col("split") == "test").select("SK_ID_CURR"), "SK_ID_CURR", "left_semi")
    return cross_validate(df, BLEND_MODELS, estimator, test=test, **options)


def q_meta_ridge(spark, d):
    """L17, linear form: ridge regression of the label on the clipped predictions: out-of-fold and test scores in [0, 1]."""
    from riskloom.operators.train import ridge_classifier
    def value(model, rows):  # of the label itself: the decision value lies on the +-1 scale
        return model.transform(rows).withColumn("pred", F.least(F.greatest((F.col("prediction") + 1) / 2, F.lit(0.0)), F.lit(1.0)))

    return _oof_and_test(_meta_linear(spark, d, ridge_classifier(alpha=1.0), score=value))


def q_two_level_search(spark, d):
    """L3: depth and step of boosted trees ranked on three folds, the winner cross-validated on five; out-of-fold and
    test scores, and the winning parameters on every row."""
    from riskloom.operators.folds import stratified_folds
    from riskloom.operators.train import boosted_trees, two_level_search
    df, feats, test = _model_frame(spark, d, test=True)
    three = stratified_folds(_train_app(spark, d), k=3, out="fold3").select("SK_ID_CURR", "fold3")
    grid = [{"max_depth": depth, "step": step, "max_iter": 10} for depth in (2, 4) for step in (0.1, 0.3)]
    r = two_level_search(df.join(three, "SK_ID_CURR"), test, feats, grid, boosted_trees)
    return _oof_and_test(r.final).withColumn("params", F.lit(str(r.params)))


def q_auc_weighted_blend(spark, d):
    """Q16 (N12-N14): per-model AUC on the labelled ids as blend weights, rank-weighted blend."""
    from riskloom.operators.blend import blend
    from riskloom.operators.stats import auc_by_group
    p = FX.predictions(spark, d)
    lab = p.join(_train_app(spark, d).withColumnRenamed("SK_ID_CURR", "id"), "id")
    aucs = {r["model"]: r["auc"] for r in auc_by_group(lab, "pred", "TARGET", ["model"]).collect()}
    return blend(p, BLEND_MODELS, "rank_weighted_mean", weights=aucs, clip_prob=False)


def q_auc_weighted_prob(spark, d):
    """Predictions clipped to [0, 1], weighted by per-model AUC."""
    from riskloom.operators.blend import blend
    from riskloom.operators.stats import auc_by_group
    p = FX.predictions(spark, d)
    lab = p.join(_train_app(spark, d).withColumnRenamed("SK_ID_CURR", "id"), "id")
    aucs = {r["model"]: r["auc"] for r in auc_by_group(lab, "pred", "TARGET", ["model"]).collect()}
    return blend(p, BLEND_MODELS, "weighted_mean", weights=aucs, clip_prob=False, clip_input=True)


def q_grid_logistic(spark, d):
    """L2: the grid over C for the L2 logistic model, ranked by OOF AUC."""
    from riskloom.operators.stats import standardize
    from riskloom.operators.train import grid_search, logistic_l2
    df, feats = _model_frame(spark, d)
    df = standardize(df, feats)
    return grid_search(df, feats, [{"C": c} for c in (0.2, 0.5, 1.0, 2.0, 5.0)], logistic_l2)[0]


def _mlp_frame(spark, d):
    """Inputs from -1 to 1: three standard deviations either way; far outliers end the perceptron's line search early."""
    from riskloom.functions.exprs import clip
    from riskloom.operators.stats import standardize
    df, feats = _model_frame(spark, d)
    df = standardize(df, feats)
    return df.select("SK_ID_CURR", "TARGET", "fold", *[(clip(c, -3.0, 3.0) / 3).alias(c) for c in feats]), feats


def q_mlp_grid(spark, d):
    """The widths and depths of a perceptron, ranked by OOF AUC."""
    from riskloom.operators.train import grid_search, mlp
    df, feats = _mlp_frame(spark, d)
    grid = [{"hidden": (8,)}, {"hidden": (16,)}, {"hidden": (16, 8)}]
    return grid_search(df, feats, grid, lambda hidden: mlp(hidden, n_features=len(feats), max_iter=30))[0]


def q_mlp_first_layer(spark, d):
    """Sum of the absolute first-layer weights of each input, averaged over the folds."""
    from riskloom.operators.train import cross_validate, mlp
    df, feats = _mlp_frame(spark, d)
    return cross_validate(df, feats, mlp((8,), n_features=len(feats), max_iter=30)).importance


def q_onehot_sparse(spark, d):
    """Sparse one-hot of the categorical application columns behind the numeric ones: the vector's width, the
    slots that are set and the sum of its numbers."""
    from pyspark.ml.functions import vector_to_array
    from riskloom.operators.encode import onehot_sparse
    from riskloom.operators.stats import fill_medians, numeric_columns
    app = FX.application(spark, d).drop("TARGET", "split")
    nums = numeric_columns(app, exclude=("SK_ID_CURR",))
    _, out = onehot_sparse(fill_medians(app, nums), APP_LABELS, nums)
    x = vector_to_array("features")
    hot = F.filter(F.sequence(F.lit(len(nums)), F.size("x") - 1), lambda i: F.col("x")[i] != 0)
    numbers = F.aggregate(F.slice("x", 1, len(nums)), F.lit(0.0), lambda a, v: a + v)
    return out.select("SK_ID_CURR", x.alias("x")).select(
        "SK_ID_CURR", F.size("x").alias("width"), F.array_join(hot.cast("array<string>"), ",").alias("slots"), numbers.alias("total"))


def q_label_sorted(spark, d):
    """Sorted-category codes over train+test, missing as '__MISSING__'."""
    from riskloom.operators.encode import label_encode
    app = FX.application(spark, d).select("SK_ID_CURR", *APP_LABELS)
    return label_encode(app, APP_LABELS)


def q_label_train_map(spark, d):
    """Dictionary from train rows only, unseen -> -1, applied to train and test."""
    from riskloom.operators.encode import label_encode
    app = FX.application(spark, d).select("SK_ID_CURR", "split", *APP_LABELS)
    return label_encode(app, APP_LABELS, fit_df=app.where(F.col("split") == "train"), unseen=-1)


def q_oof_frequency(spark, d):
    """Out-of-fold frequency encoding of NAME_INCOME_TYPE over the stratified folds."""
    from riskloom.operators.encode import oof_frequency
    from riskloom.operators.folds import stratified_folds
    app = FX.application(spark, d).where(F.col("split") == "train").select("SK_ID_CURR", "TARGET",
                                                                          "NAME_TYPE_SUITE")
    f = stratified_folds(app.select("SK_ID_CURR", "TARGET"))
    return oof_frequency(app.join(f.select("SK_ID_CURR", "fold"), "SK_ID_CURR"), "NAME_TYPE_SUITE")


def q_mean_std(spark, d):
    from riskloom.operators.stats import mean_std, numeric_columns
    app = FX.application(spark, d)
    return mean_std(app, numeric_columns(app, exclude=("SK_ID_CURR", "TARGET", "split")))


def q_top_k(spark, d):
    """H5/H6: the 10 customers with the largest prior credit sum (ties by id)."""
    from riskloom.operators.stats import top_k
    p = q_prev(spark, d).select("SK_ID_CURR", "PREV_AMT_CREDIT_SUM")
    return top_k(p, [F.desc("PREV_AMT_CREDIT_SUM"), "SK_ID_CURR"], 10)


def q_binned_rate(spark, d):
    """F16 with C10: count and default rate per equal-width income bin."""
    from riskloom.operators.encode import equal_width_bin
    from riskloom.operators.stats import binned_target_rate
    tr = FX.application(spark, d).where(F.col("split") == "train").select("SK_ID_CURR", "TARGET",
                                                                         "AMT_INCOME_TOTAL")
    return binned_target_rate(equal_width_bin(tr, "AMT_INCOME_TOTAL", 10), "AMT_INCOME_TOTAL_WBIN")


def q_blend_report(spark, d):
    """Per-model weight, mean, std and average Spearman with the other models."""
    from riskloom.operators.blend import blend_report
    return blend_report(FX.predictions(spark, d), BLEND_MODELS, BLEND_WEIGHTS)


def q_integration(spark, d):
    """Q10: application v7 + block features + financial block on the customer key."""
    from riskloom.plans.application import feature_set
    from riskloom.plans.financial import financial_block
    from riskloom.plans.integrate import integrate
    app = FX.application(spark, d)
    v7 = feature_set(app, version=7)
    blocks = q_assembly(spark, d)
    return integrate(v7, [blocks, financial_block(app)], ["add", "fin"])


def q_onehot_long(spark, d):
    """Dummies of the four categorical columns (categories seen in both splits), long form."""
    from riskloom.operators.encode import melt, onehot, onehot_categories
    app = FX.application(spark, d).select("SK_ID_CURR", "split", *APP_LABELS)
    cats = onehot_categories(app, APP_LABELS, "split")
    oh = onehot(app, APP_LABELS, cats)
    dummies = [c for c in oh.columns if c not in ("SK_ID_CURR", "split")]
    return melt(oh.select("SK_ID_CURR", *dummies), ["SK_ID_CURR"], dummies, "feature", "value")


def q_kde(spark, d):
    """J9 (Q14 profile data): class-conditional density curves of every numeric column on a 200-point grid."""
    from riskloom.operators.stats import kde_curves, numeric_columns
    tr = FX.application(spark, d).where(F.col("split") == "train")
    return kde_curves(tr, numeric_columns(tr, exclude=("SK_ID_CURR", "TARGET")), "TARGET", points=200)


def q_profile(spark, d):
    """Q14: counts and default rates by value or equal-width bin, every column of the train rows."""
    from riskloom.operators.stats import feature_profile, numeric_columns
    tr = FX.application(spark, d).where(F.col("split") == "train")
    return feature_profile(tr, numeric_columns(tr, exclude=("SK_ID_CURR", "TARGET")), APP_LABELS)


def q_versions(spark, d):
    """Q7: the feature sets v0 to v7 as column choices of one wide frame."""
    from riskloom.plans.validation import version_profile
    return version_profile(FX.application(spark, d))


def q_version_validation(spark, d):
    """Training and held-out AUC of boosted trees on each feature set."""
    from riskloom.operators.train import boosted_trees
    from riskloom.plans.validation import feature_version_validation
    return feature_version_validation(FX.application(spark, d), boosted_trees(max_depth=3, max_iter=5))


def q_term_features(spark, d):
    """Ratios of credit, goods price and annuity."""
    from riskloom.plans.financial import term_features
    app = FX.application(spark, d).select("SK_ID_CURR", "AMT_CREDIT", "AMT_ANNUITY", "AMT_GOODS_PRICE")
    return term_features(app)


TERMS = [6, 12, 18, 24, 30]


def q_implied_rates(spark, d):
    """B41, B42, B27 over class probabilities that follow from the id: best term, certainty, implied rates."""
    from riskloom.plans.financial import implied_rates
    app = FX.application(spark, d)
    weight = [((F.col("SK_ID_CURR") * (3 + 2 * i)) % 7 + 1).cast("double") for i in range(len(TERMS))]
    total = sum(weight[1:], weight[0])
    return implied_rates(app.withColumn("_p", F.array(*[w / total for w in weight])), TERMS)


def q_permutation_importance(spark, d):
    """Permutation importance (3 repeats) of a logistic model on every held-out fold."""
    from riskloom.operators.stats import standardize
    from riskloom.operators.train import logistic_l2, permutation_importance
    df, feats = _model_frame(spark, d)
    return permutation_importance(standardize(df, feats), feats, logistic_l2(C=1.0))


def q_ridge_calibrated(spark, d):
    """Ridge classifier OOF decision values, Platt-calibrated."""
    from riskloom.operators.stats import standardize
    from riskloom.operators.train import cross_validate, platt_calibrate, ridge_classifier, ridge_score
    df, feats = _model_frame(spark, d)
    df = standardize(df, feats)
    r = cross_validate(df, feats, ridge_classifier(alpha=1.0), score=ridge_score())
    return platt_calibrate(r.oof)[1]


def q_imbalance(spark, d):
    """Logistic model under five imbalance strategies."""
    from riskloom.operators.stats import standardize
    from riskloom.operators.train import imbalance_experiment, logistic_l2
    df, feats = _model_frame(spark, d)
    df = standardize(df, feats)
    return imbalance_experiment(df, feats, logistic_l2(C=1.0, max_iter=50))


def _meta_boosted(spark, d):
    from riskloom.functions.exprs import clip, logit
    from riskloom.operators.blend import complete_rows, wide
    from riskloom.operators.folds import stratified_folds
    from riskloom.operators.train import boosted_trees, cross_validate
    p = complete_rows(FX.predictions(spark, d), BLEND_MODELS)
    w = wide(p.withColumn("pred", clip("pred", 1e-4, 0.9999)), BLEND_MODELS).withColumnRenamed("id", "SK_ID_CURR")
    w = w.select("*", *[logit(m, 1e-4).alias(f"logit_{m}") for m in BLEND_MODELS])
    tr = _train_app(spark, d)
    df = w.join(tr, "SK_ID_CURR").join(stratified_folds(tr).select("SK_ID_CURR", "fold"), "SK_ID_CURR")
    feats = BLEND_MODELS + [f"logit_{m}" for m in BLEND_MODELS]
    test = w.join(FX.application(spark, d).where(F.col("split") == "test").select("SK_ID_CURR"), "SK_ID_CURR", "left_semi")
    return cross_validate(df, feats, boosted_trees(max_depth=3, max_iter=20), test=test)


def _oof_and_test(r):
    """Out-of-fold scores of the train customers, then the test customers' (no fold, no target)."""
    none = F.lit(None)
    return r.oof.select("SK_ID_CURR", "fold", "TARGET", F.col("oof_pred").alias("pred")).union(
        r.test.select("SK_ID_CURR", none.cast("int"), none.cast("double"), "pred"))


def q_meta_boosted(spark, d):
    """Boosted-tree meta-learner on clipped predictions plus their logits: out-of-fold scores of
    the train customers and fold-averaged scores (F23) of the test customers."""
    return _oof_and_test(_meta_boosted(spark, d))


def q_meta_gain(spark, d):
    """Importance table of the boosted meta-learner, averaged over folds."""
    return _meta_boosted(spark, d).importance


def q_prediction_files(spark, d):
    """A9 + A5 + A1: write one CSV prediction file set per model into the shared
    checkpoint folder, read them all back with ONE wildcard scan, model name from the path."""
    import uuid
    from riskloom.session import checkpoint_dir
    from riskloom.sources.tables import read_predictions, write_table
    base = f"{checkpoint_dir(spark).rstrip('/')}/predictions-{uuid.uuid4().hex}"
    p = FX.predictions(spark, d)
    for m in BLEND_MODELS:
        write_table(p.where(F.col("model") == m).select(F.col("id").alias("SK_ID_CURR"), F.col("pred").alias("TARGET")),
                    f"{base}/submission_{m}.csv", fmt="csv")
    return read_predictions(spark, f"{base}/submission_*.csv/*.csv", model_regex=r"submission_([^/]+)\.csv/")


def q_woe_transform(spark, d):
    """WOE values of all columns for train and test rows (unseen bins -> 0)."""
    from riskloom.operators.encode import woe_transform
    app, model = _woe_model(spark, d)
    out = woe_transform(app, model)
    return out.select("SK_ID_CURR", "split", *[c for c in out.columns if c.endswith("_BIN_WOE")])


def q_logistic_woe(spark, d):
    """L2 logistic regression on the standardised WOE of all columns: out-of-fold scores, and fold-averaged
    scores of the test customers."""
    from riskloom.operators.encode import woe_transform
    from riskloom.operators.folds import stratified_folds
    from riskloom.operators.stats import standardize
    from riskloom.operators.train import cross_validate, logistic_l2
    from riskloom.session import cut_lineage
    app, model = _woe_model(spark, d)
    w = woe_transform(app, model)
    feats = [c for c in w.columns if c.endswith("_BIN_WOE")]
    w = cut_lineage(w.select("SK_ID_CURR", "split", "TARGET", *feats))  # read for the statistics and for both row sets
    w = standardize(w, feats)
    tr = w.where(F.col("split") == "train").join(
        stratified_folds(_train_app(spark, d)).select("SK_ID_CURR", "fold"), "SK_ID_CURR")
    r = cross_validate(tr, feats, logistic_l2(C=1.0), test=w.where(F.col("split") == "test"), parallelism=5)  # no fold waits for another
    return _oof_and_test(r)


def q_rf_importance(spark, d):
    """Random-forest impurity importance averaged over folds (long table)."""
    from riskloom.operators.train import cross_validate, random_forest
    df, feats = _model_frame(spark, d)
    return cross_validate(df, feats, random_forest(num_trees=30, max_depth=6)).importance


def q_spearman_matrix(spark, d):
    """Spearman correlation matrix of the model predictions (complete ids)."""
    from riskloom.operators.blend import complete_rows, wide
    from riskloom.operators.stats import spearman_matrix
    p = complete_rows(FX.predictions(spark, d), BLEND_MODELS)
    return spearman_matrix(wide(p, BLEND_MODELS), BLEND_MODELS, "id")


def q_blend_runner(spark, d):
    """Q15: prediction files -> one wildcard scan -> rank-average blend."""
    from riskloom.operators.blend import blend
    return blend(q_prediction_files(spark, d), BLEND_MODELS, "rank_mean")


def q_final_blend(spark, d):
    """Q17: 0.5 x rank-average blend + 0.5 x boosted meta-learner, test customers."""
    from riskloom.operators.blend import alpha_blend, blend
    test = FX.application(spark, d).where(F.col("split") == "test").select(F.col("SK_ID_CURR").alias("id"))
    ra = blend(FX.predictions(spark, d).join(test, "id", "left_semi"), BLEND_MODELS, "rank_mean")
    meta = _meta_boosted(spark, d).test.select(F.col("SK_ID_CURR").alias("id"), "pred")
    return alpha_blend(ra, meta, 0.5)


def _numeric_app(spark, d):
    from riskloom.operators.stats import numeric_columns
    app = FX.application(spark, d)
    cols = numeric_columns(app, exclude=("SK_ID_CURR", "TARGET", "split"))
    return app.select("SK_ID_CURR", "split", *cols), cols


def _fit_rows(df):
    return df.where(F.col("split") == "train")


def q_median_all(spark, d):
    """Every numeric column filled with its exact median over all rows."""
    from riskloom.operators.stats import fill_medians
    return fill_medians(*_numeric_app(spark, d))


def q_median_train(spark, d):
    """Medians of the train rows, applied to train and test."""
    from riskloom.operators.stats import fill_medians
    df, cols = _numeric_app(spark, d)
    return fill_medians(df, cols, fit_df=_fit_rows(df))


def q_standardize_all(spark, d):
    """(x - mean) / population sd over all rows."""
    from riskloom.operators.stats import standardize
    return standardize(*_numeric_app(spark, d))


def q_standardize_train(spark, d):
    """Mean and sd of the train rows, applied to train and test."""
    from riskloom.operators.stats import standardize
    df, cols = _numeric_app(spark, d)
    return standardize(df, cols, fit_df=_fit_rows(df))


def q_kfold(spark, d):
    """K2: plain five folds of the train customers, seed 50."""
    from riskloom.operators.folds import kfold
    return kfold(_train_app(spark, d)).select("SK_ID_CURR", "fold")


def q_auto_weights(spark, d):
    """K5 "auto": N/P of each fold's training part, without a cap."""
    from riskloom.operators.folds import positive_weights, stratified_folds
    return positive_weights(stratified_folds(_train_app(spark, d)), cap=None)


def q_id_base(spark, d):
    """Distinct customers of the instalment rows."""
    from riskloom.sources.tables import id_base
    return id_base(FX.installments(spark, d))


def q_minimal_base(spark, d):
    """Id, split and target."""
    from riskloom.sources.tables import minimal_base
    return minimal_base(FX.application(spark, d))


def q_binary_codes(spark, d):
    """String columns with at most two values, found and coded."""
    from riskloom.operators.encode import binary_columns, label_encode
    app = FX.application(spark, d).select("SK_ID_CURR", "split", *APP_LABELS)
    cols = binary_columns(app, ["split", *APP_LABELS])
    return label_encode(app.select("SK_ID_CURR", *cols), cols)


def q_dropped_ids(spark, d):
    """E5: ids dropped because a model lacks a prediction."""
    from riskloom.operators.blend import dropped_count
    return dropped_count(FX.predictions(spark, d), BLEND_MODELS)


def q_model_weights(spark, d):
    """Weights from a table with one model absent (1.0), normalised."""
    from riskloom.operators.blend import normalized_weights
    p = FX.predictions(spark, d)
    table = p.where(F.col("model") != "m4").groupBy("model").agg(F.avg("pred").alias("local_auc"))
    return normalized_weights(table, BLEND_MODELS)


def _weighted_run(spark, d):
    from riskloom.plans.blending import auc_weights, model_weights, weighted_run
    p = FX.predictions(spark, d)
    labels = _train_app(spark, d).withColumnRenamed("SK_ID_CURR", "id")
    return weighted_run(p, BLEND_MODELS, model_weights(spark, BLEND_MODELS, auc_weights(p, labels, BLEND_MODELS)))


def q_weighted_run(spark, d):
    """Q16: blends of clipped predictions and of ranks by AUC weights, in one run."""
    return _weighted_run(spark, d).scores


def q_weighted_run_report(spark, d):
    """The report of that run."""
    return _weighted_run(spark, d).report


def q_weight_sources(spark, d):
    """Weights by hand (one model without) and equal ones, each as the weighted mean of its model's predictions."""
    from riskloom.plans.blending import model_weights
    p = FX.predictions(spark, d).groupBy("model").agg(F.avg("pred").alias("mean"))
    by_hand = model_weights(spark, BLEND_MODELS, manual={m: w for m, w in BLEND_WEIGHTS.items() if m != "m4"})
    both = by_hand.withColumn("given", F.lit("hand")).unionByName(model_weights(spark, BLEND_MODELS).withColumn("given", F.lit("equal")))
    return both.join(p, "model").select("given", "model", "weight", (F.col("weight") * F.col("mean")).alias("part"))


def q_csv_scan(spark, d):
    """A9 + A1: the order table written as CSV into the shared folder and scanned with its schema."""
    import uuid
    from riskloom.session import checkpoint_dir
    from riskloom.sources.tables import read_csv, read_table, write_table
    path = f"{checkpoint_dir(spark).rstrip('/')}/orders-{uuid.uuid4().hex}.csv"
    t = read_table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    write_table(t, path, fmt="csv")
    return read_csv(spark, path, schema=t.schema)


def q_missing_over(spark, d):
    """number of assembled features with over 20 % and over 50 % missing."""
    from riskloom.operators.stats import missing_over
    df = q_assembly(spark, d)
    return missing_over(df, [c for c in df.columns if c not in ("SK_ID_CURR", "split")])


def q_planted_duplicates(spark, d):
    """copies of typed columns, planted behind the originals."""
    from riskloom.operators.stats import duplicate_columns
    app = FX.application(spark, d)
    df = app.select("SK_ID_CURR", "AMT_CREDIT", "DAYS_BIRTH", "NAME_TYPE_SUITE", "EXT_SOURCE_1",
                    F.col("AMT_CREDIT").alias("CREDIT_COPY"), F.col("DAYS_BIRTH").alias("BIRTH_COPY"),
                    F.col("NAME_TYPE_SUITE").alias("SUITE_COPY"), F.col("AMT_CREDIT").alias("CREDIT_COPY_2"),
                    F.coalesce("EXT_SOURCE_1", F.lit(0.5)).alias("EXT_FILLED"))
    return duplicate_columns(df, [c for c in df.columns if c != "SK_ID_CURR"], "SK_ID_CURR")


def q_elastic(spark, d):
    """Elastic-net logistic regression, out-of-fold."""
    from riskloom.operators.stats import standardize
    from riskloom.operators.train import cross_validate, elastic_logistic
    df, feats = _model_frame(spark, d)
    return cross_validate(standardize(df, feats), feats, elastic_logistic()).oof


def q_forest_balanced(spark, d):
    """Random forest by entropy, with balanced class weights (K6)."""
    from riskloom.operators.folds import balanced_weight
    from riskloom.operators.train import cross_validate, random_forest
    df, feats = _model_frame(spark, d)
    df = balanced_weight(df, "TARGET", "_w")
    return cross_validate(df, feats, random_forest("entropy", num_trees=30, max_depth=6), weight_col="_w").oof


def q_calibrated(spark, d):
    """Ridge classifier with inner five-fold Platt calibration, out-of-fold probabilities."""
    from riskloom.operators.stats import standardize
    from riskloom.operators.train import calibrated_cross_validate, ridge_classifier
    df, feats = _model_frame(spark, d)
    return calibrated_cross_validate(standardize(df, feats), feats, ridge_classifier(alpha=1.0))


def q_refit(spark, d):
    """Importance of one boosted model on every train row, with the folds' average best number of rounds."""
    from riskloom.operators.boosting import refit_at_average
    from riskloom.operators.train import boosted_trees
    df, feats, result = _boosted(spark, d, 20)
    _, rounds, importance = refit_at_average(df, feats, lambda n: boosted_trees(max_depth=3, max_iter=n), result, least=5)
    return importance.withColumn("rounds", F.lit(rounds))


def q_region(spark, d):
    """B9, B10, B15 (feature set v4 block): rating difference, address mismatches, age in years."""
    from riskloom.functions.exprs import days_to_years
    from riskloom.plans.application import region_features
    r = region_features(FX.application(spark, d))
    return r.select("SK_ID_CURR", "REGION_RATING_DIFF", "ADDR_MISMATCH_SUM",
                    days_to_years("DAYS_BIRTH").alias("YEARS_BIRTH"))


def q_logistic_sparse(spark, d):
    """L4 pipeline: sparse one-hot of the categorical columns + numerics, scaled without
    centring (B34), L2 logistic regression out-of-fold."""
    from riskloom.operators.encode import onehot_sparse, scale_sparse
    from riskloom.operators.folds import stratified_folds
    from riskloom.operators.stats import fill_medians, numeric_columns
    from riskloom.operators.train import cross_validate, logistic_l2
    train, _ = _app_split(spark, d)
    nums = numeric_columns(train, exclude=("SK_ID_CURR", "TARGET"))
    filled = fill_medians(train, nums)
    _, enc = onehot_sparse(filled, APP_LABELS, nums, out="raw")
    _, sc = scale_sparse(enc, "raw", "scaled")
    df = sc.join(stratified_folds(_train_app(spark, d)).select("SK_ID_CURR", "fold"), "SK_ID_CURR")
    return cross_validate(df, "scaled", logistic_l2(C=1.0)).oof


def q_gbt_on_bins(spark, d):
    """Boosted trees on 64-bin rank-quantile codes of the numeric application columns."""
    from riskloom.operators.encode import rank_quantile_bins
    from riskloom.operators.train import boosted_trees, cross_validate
    df, feats = _model_frame(spark, d)
    binned = rank_quantile_bins(df.select("SK_ID_CURR", "TARGET", "fold", *feats), feats, 64)
    bins = [f"{c}_QBIN" for c in feats]
    return cross_validate(binned, bins, boosted_trees(max_depth=3, max_iter=10)).oof


def q_value_counts(spark, d):
    """value counts of a categorical column, missing kept as its own value."""
    from riskloom.operators.stats import value_counts
    return value_counts(FX.application(spark, d), "NAME_TYPE_SUITE")


_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "q01_prev_block": q_prev,
    "q02_bureau_block": q_bureau,
    "q03_pos_block": q_pos,
    "q04_installments_block": q_ins,
    "q05_card_block": q_card,
    "q06_feature_assembly": q_assembly,
    "q07_application_v7": q_app_v7,
    "q08_auc_single_feature": q_auc,
    "q09_average_precision": q_ap,
    "q10_spearman_abs": q_spearman,
    "q11_mutual_info_categorical": q_mi,
    "q12_exact_quantiles": q_quantiles,
    "q13_missing_table": q_missing,
    "q14_column_audit": q_audit,
    "q15_pearson_matrix": q_pearson,
    "q16_category_target_rate": q_category_rate,
    "q17_label_balance": q_label_balance,
    "q18_duplicate_columns": q_duplicates,
    "q19_stratified_folds": q_folds,
    "q20_fold_positive_weights": q_pos_weights,
    "q21_undersample": q_undersample,
    "q22_balanced_weight": q_balanced,
    **{k: _blend_query(m, kw) for k, (m, kw) in BLENDS.items()},
    "q34_alpha_blend": q_alpha,
    "q35_percent_rank": q_pct_rank,
    "q36_oof_single_feature_auc": q_oof_auc,
    "q37_screen_stage1": q_stage1,
    "q38_screen_stage0_audit": q_stage0,
    "q39_financial_rate": q_financial,
    "q40_rank_quantile_bin": q_rank_qbin,
    "q41_equal_width_bin": q_equal_width,
    "q42_safe_qcut_woe": q_woe,
    "q43_rebuilt_term_rates": q_rebuilt_term,
    "q44_oof_logistic_l2": q_oof_logistic,
    "q45_oof_boosted_trees": q_oof_gbt,
    "q46_oof_random_forest": q_oof_rf,
    "q47_meta_logistic": q_meta_logistic,
    "q48_auc_weighted_rank_blend": q_auc_weighted_blend,
    "q49_grid_search_logistic": q_grid_logistic,
    "q50_onehot_sparse": q_onehot_sparse,
    "q51_label_encode_sorted": q_label_sorted,
    "q52_label_map_train_only": q_label_train_map,
    "q53_oof_frequency": q_oof_frequency,
    "q54_mean_std": q_mean_std,
    "q55_top_k": q_top_k,
    "q56_binned_target_rate": q_binned_rate,
    "q57_blend_report": q_blend_report,
    "q58_table_integration": q_integration,
    "q59_onehot_long": q_onehot_long,
    "q60_kde_curves": q_kde,
    "q61_permutation_importance": q_permutation_importance,
    "q62_ridge_platt": q_ridge_calibrated,
    "q63_imbalance_experiment": q_imbalance,
    "q64_meta_boosted_trees": q_meta_boosted,
    "q65_prediction_files_roundtrip": q_prediction_files,
    "q66_woe_transform": q_woe_transform,
    "q67_logistic_on_woe": q_logistic_woe,
    "q68_rf_importance": q_rf_importance,
    "q69_spearman_matrix": q_spearman_matrix,
    "q70_blend_runner": q_blend_runner,
    "q71_final_alpha_blend": q_final_blend,
    "q72_region_features": q_region,
    "q73_logistic_sparse_onehot": q_logistic_sparse,
    "q74_boosted_trees_on_bins": q_gbt_on_bins,
    "q75_value_counts": q_value_counts,
    "q76_median_fill_all": q_median_all,
    "q77_median_fill_train": q_median_train,
    "q78_standardize_all": q_standardize_all,
    "q79_standardize_train": q_standardize_train,
    "q80_kfold": q_kfold,
    "q81_auto_positive_weights": q_auto_weights,
    "q82_id_base": q_id_base,
    "q83_minimal_base": q_minimal_base,
    "q84_binary_codes": q_binary_codes,
    "q85_dropped_ids": q_dropped_ids,
    "q86_model_weights": q_model_weights,
    "q87_missing_over": q_missing_over,
    "q88_planted_duplicates": q_planted_duplicates,
    "q89_auc_weighted_probability_blend": q_auc_weighted_prob,
    "q90_meta_importance": q_meta_gain,
    "q91_elastic_net": q_elastic,
    "q92_full_refit_importance": q_refit,
    "q93_screening_run": q_screening,
    "q94_forest_entropy_balanced": q_forest_balanced,
    "q95_ridge_inner_calibration": q_calibrated,
    "q96_two_level_search": q_two_level_search,
    "q97_meta_ridge": q_meta_ridge,
    "q98_feature_profile": q_profile,
    "q99_feature_versions": q_versions,
    "q100_version_validation": q_version_validation,
    "q101_term_features": q_term_features,
    "q102_implied_rates": q_implied_rates,
    "q103_weighted_run": q_weighted_run,
    "q104_weighted_run_report": q_weighted_run_report,
    "q105_weight_sources": q_weight_sources,
    "q106_csv_scan": q_csv_scan,
    "q107_mlp_grid": q_mlp_grid,
    "q108_mlp_first_layer": q_mlp_first_layer,
}


def _wrap(fn):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return canon(fn(spark, sf_dir))
    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


def entry(spark: SparkSession) -> DataFrame:
    return canon(q_prev(spark, SF0001))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = {k: _wrap(v) for k, v in _QUERIES.items()}
    if _llm is not None:
        found |= _llm.queries()
    if _pipeline is not None:
        found["pipeline"] = _pipeline.run
    return found


def oracle_sql() -> dict[str, str]:
    found = _own_oracle_sql()
    if _llm is not None:
        found |= _llm.oracle_sql()
    if _pipeline is not None and _pipeline.ORACLE_SQL:
        found["pipeline"] = _pipeline.ORACLE_SQL
    return found


def _own_oracle_sql() -> dict[str, str]:
    from sqlcheck.blocks_sql import (assembly_sql, bureau_block_sql, canon_block, card_block_sql,
                                     ins_block_sql, pos_block_sql, prev_block_sql)
    from sqlcheck import blend_sql as BL
    from sqlcheck import encode_sql as EN
    from sqlcheck import extra_sql as X2
    from sqlcheck import prep_sql as PR
    from sqlcheck import stats_sql as S
    from sqlcheck.application_sql import v7_sql
    from sqlcheck.blocks_sql import assembly_columns
    return {
        "q01_prev_block": canon_block(prev_block_sql),
        "q02_bureau_block": canon_block(bureau_block_sql),
        "q03_pos_block": canon_block(pos_block_sql),
        "q04_installments_block": canon_block(ins_block_sql),
        "q05_card_block": canon_block(card_block_sql),
        "q06_feature_assembly": assembly_sql(),
        "q07_application_v7": v7_sql(),
        "q08_auc_single_feature": S.auc_sql(),
        "q09_average_precision": S.ap_sql(),
        "q10_spearman_abs": S.spearman_sql(),
        "q11_mutual_info_categorical": S.mi_sql(),
        "q12_exact_quantiles": S.medians_sql(),
        "q13_missing_table": S.missing_table_sql(assembly_sql(), [c for c in assembly_columns()
                                                                  if c not in ("SK_ID_CURR", "split")]),
        "q14_column_audit": S.audit_sql(),
        "q15_pearson_matrix": S.pearson_sql(S.NUM_COLS),
        "q16_category_target_rate": S.category_rate_sql(),
        "q17_label_balance": S.label_balance_sql(),
        "q19_stratified_folds": BL.folds_canon(),
        "q20_fold_positive_weights": BL.pos_weight_sql(),
        "q21_undersample": BL.undersample_sql(),
        "q22_balanced_weight": BL.balanced_sql(),
        **{k: BL.blend_sql(m, **kw) for k, (m, kw) in BLENDS.items()},
        "q34_alpha_blend": BL.alpha_blend_sql(),
        "q35_percent_rank": BL.pct_rank_sql(),
        "q36_oof_single_feature_auc": S.oof_auc_sql(),
        "q39_financial_rate": EN.financial_sql(),
        "q40_rank_quantile_bin": EN.rank_qbin_sql(),
        "q41_equal_width_bin": EN.equal_width_sql(),
        "q42_safe_qcut_woe": EN.safe_qcut_woe_sql(S.NUM_COLS, APP_LABELS),
        "q48_auc_weighted_rank_blend": BL.auc_weighted_blend_sql(),
        "q51_label_encode_sorted": X2.label_sorted_sql(),
        "q52_label_map_train_only": X2.label_train_sql(),
        "q53_oof_frequency": X2.oof_frequency_sql(),
        "q54_mean_std": X2.mean_std_sql(),
        "q55_top_k": X2.top_k_sql(),
        "q56_binned_target_rate": X2.binned_rate_sql(),
        "q57_blend_report": X2.blend_report_sql(),
        "q58_table_integration": X2.integration_sql(),
        "q59_onehot_long": X2.onehot_long_sql(),
        "q60_kde_curves": X2.kde_sql(),
        "q98_feature_profile": X2.profile_sql(),
        "q99_feature_versions": X2.versions_sql(),
        "q101_term_features": EN.term_features_sql(),
        "q102_implied_rates": EN.implied_rates_sql(TERMS),
        "q103_weighted_run": BL.auc_weighted_run_sql(),
        "q104_weighted_run_report": X2.blend_report_sql(BL.auc_shares_sql()),
        "q105_weight_sources": BL.weight_sources_sql(),
        "q106_csv_scan": X2.csv_scan_sql(),
        "q65_prediction_files_roundtrip": X2.prediction_files_sql(),
        "q38_screen_stage0_audit": X2.stage0_sql(),
        "q93_screening_run": X2.screening_run_sql(),
        "q37_screen_stage1": X2.stage1_sql(),
        "q50_onehot_sparse": X2.onehot_sparse_sql(),
        "q72_region_features": X2.region_sql(),
        "q75_value_counts": X2.value_counts_sql(),
        "q66_woe_transform": EN.woe_transform_sql(S.NUM_COLS, APP_LABELS),
        "q69_spearman_matrix": X2.spearman_matrix_sql(),
        "q70_blend_runner": BL.blend_sql("rank_mean"),
        "q76_median_fill_all": PR.median_sql("TRUE"),
        "q77_median_fill_train": PR.median_sql("split = 'train'"),
        "q78_standardize_all": PR.standardize_sql("TRUE"),
        "q79_standardize_train": PR.standardize_sql("split = 'train'"),
        "q80_kfold": PR.kfold_sql(),
        "q81_auto_positive_weights": BL.pos_weight_sql(cap=1e300),
        "q82_id_base": PR.id_base_sql(),
        "q83_minimal_base": PR.minimal_base_sql(),
        "q84_binary_codes": PR.binary_codes_sql(),
        "q85_dropped_ids": PR.dropped_sql(),
        "q86_model_weights": PR.weights_sql(),
        "q87_missing_over": PR.missing_over_sql(assembly_sql(), [c for c in assembly_columns() if c not in ("SK_ID_CURR", "split")]),
        "q88_planted_duplicates": PR.duplicates_sql(),
        "q89_auc_weighted_probability_blend": BL.auc_weighted_blend_sql(rank=False),
    }
