"""Q11-Q13: feature screening.

Stage 0 (audit & hygiene): column audit over train+test, duplicate columns,
drop near-constant / high-missing / duplicate columns.
Stage 1 (univariate filters): out-of-fold single-feature AUC, mutual
information and |Spearman| for every feature at once, then the pass rule.

The reference loops over features (one model-free fit per column); here the
frame is read once into a count table per (feature, value) and fold
(``operators.counts``), and medians, ranks, AUC, mutual information and
Spearman are grouped sums over its distinct values.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import counts as C
from ..operators.folds import stratified_folds
from ..operators.stats import column_audit, duplicate_columns, pass_rule
from ..session import cut_lineage


@dataclass(frozen=True)
class ScreenConfig:
    # Fixed values that must equal the reference's for right results.
    seed: int = 42
    n_splits: int = 5
    id_col: str = "SK_ID_CURR"
    target_col: str = "TARGET"
    high_missing_thr: float = 0.98
    near_constant_unique_ratio: float = 1e-8
    auc_thr: float = 0.51
    mi_quantile: float = 0.60
    rho_thr: float = 0.05
    mi_bins: int = 10


# ------------------------------------------------------------------ stage 0
def stage0(train: DataFrame, test: DataFrame, cfg: ScreenConfig = ScreenConfig()):
    """Q11: returns (audit DataFrame with a ``duplicate`` flag, kept column list)."""
    both = train.drop(cfg.target_col).unionByName(test, allowMissingColumns=True)
    audit = column_audit(both, exclude=(), high_missing=cfg.high_missing_thr,
                         near_constant_ratio=cfg.near_constant_unique_ratio)
    flagged = {r["feature"] for r in audit.where(F.col("near_constant") | F.col("high_missing"))
               .select("feature").collect()}
    cand = [c for c in both.columns if c != cfg.id_col and c not in flagged]
    dups = duplicate_columns(both, cand, cfg.id_col)
    dup_cols = {r["column"] for r in dups.collect()}
    audit = audit.withColumn("duplicate", F.col("feature").isin(*dup_cols) if dup_cols else F.lit(False))
    drop = (flagged | dup_cols) - {cfg.id_col}
    kept = [c for c in both.columns if c not in drop]
    return audit, kept


# ------------------------------------------------------------------ stage 1
def _types(df: DataFrame, features: Sequence[str]) -> dict[str, str]:
    t = {f.name: f.dataType.typeName() for f in df.schema.fields}
    return {c: ("cat" if t[c] == "string" else "num") for c in features}


@dataclass(frozen=True)
class Counts:
    """The shared counts of stage 1: ``values`` by rank and ``gaps`` (one row per feature)."""
    values: DataFrame
    gaps: DataFrame
    types: dict[str, str]
    k: int


def screen_counts(rows: DataFrame, features: Sequence[str], cfg: ScreenConfig = ScreenConfig(),
                  folds: DataFrame | None = None) -> Counts:
    """One scan of ``rows`` (train and test; test rows have no target) into the count table of all features.

    The folds of the train rows come from ``folds`` or are dealt here, from id and target alone.
    """
    fo = folds if folds is not None else stratified_folds(
        rows.where(F.col(cfg.target_col).isNotNull()).select(cfg.id_col, cfg.target_col),
        cfg.id_col, cfg.target_col, cfg.n_splits, cfg.seed)
    types = _types(rows, features)
    base = rows.join(fo.select(cfg.id_col, F.col("fold").alias("_fold")), cfg.id_col, "left")
    table = C.count_table(base, [c for c in features if types[c] == "num"], [c for c in features if types[c] == "cat"],
                          cfg.target_col, "_fold", cfg.n_splits)
    return Counts(C.ranked(table, cfg.n_splits), cut_lineage(C.missing_counts(table, cfg.n_splits)), types, cfg.n_splits)


def single_feature_auc(counts: Counts) -> DataFrame:
    """(feature, auc_single), direction-robust max(auc, 1 - auc)."""
    kinds, parts = set(counts.types.values()), []
    if "num" in kinds:
        parts.append(C.oof_rank_scores(counts.values.where(F.col("num").isNotNull()), counts.gaps, counts.k))
    if "cat" in kinds:
        parts.append(C.oof_frequency_scores(counts.values.where(F.col("cat").isNotNull()), counts.k))
    a = C.auc_of_counts(parts[0] if len(parts) == 1 else parts[0].union(parts[1]))
    return a.select("feature", F.greatest(F.col("auc"), F.lit(1.0) - F.col("auc")).alias("auc_single"))


def oof_single_feature_auc(train: DataFrame, features: Sequence[str], cfg: ScreenConfig = ScreenConfig(),
                           folds: DataFrame | None = None) -> DataFrame:
    """J3 of the train rows."""
    return single_feature_auc(screen_counts(train, features, cfg, folds))


def stage1_metrics(rows: DataFrame, features: Sequence[str], cfg: ScreenConfig = ScreenConfig()) -> DataFrame:
    """Q12 over train and test rows in one frame: a metrics row per feature + pass_stage1, all from one count table."""
    counts = screen_counts(rows, features, cfg)
    tdf = rows.sparkSession.createDataFrame([(c, counts.types[c]) for c in features], "feature string, type string")
    # every frame below has one row per feature
    m = (tdf.join(counts.gaps.select("feature", "missing_rate"), "feature", "left")
            .join(single_feature_auc(counts), "feature", "left")
            .join(C.binned_information(counts.values, counts.gaps, cfg.mi_bins), "feature", "left")
            .join(C.spearman_of_counts(counts.values), "feature", "left"))
    return pass_rule(m, cfg.auc_thr, cfg.mi_quantile, cfg.rho_thr)


def stage1(train: DataFrame, test: DataFrame, cfg: ScreenConfig = ScreenConfig()) -> DataFrame:
    """Q12 of separate train and test frames."""
    features = [c for c in train.columns if c not in (cfg.target_col, cfg.id_col, "split")]
    return stage1_metrics(train.unionByName(test, allowMissingColumns=True), features, cfg)


def run(train: DataFrame, test: DataFrame, cfg: ScreenConfig = ScreenConfig()):
    """Q13: stage 0 -> stage 1 -> reduced train/test with the passing features."""
    audit, kept = stage0(train, test, cfg)
    keep0 = [c for c in kept if c in train.columns]
    tr0 = train.select(cfg.target_col, *keep0)
    te0 = test.select(*[c for c in kept if c in test.columns])
    metrics = stage1(tr0, te0, cfg)
    passing = [r["feature"] for r in metrics.where(F.col("pass_stage1") == 1).select("feature").collect()]
    cols = [cfg.id_col] + [c for c in keep0 if c in passing]
    return audit, metrics, tr0.select(cfg.target_col, *cols), te0.select(*cols)
