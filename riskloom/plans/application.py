"""Q7: main-table feature sets v0..v7 (train and test in one frame with ``split``).

v0 anomalies + missing flags + one-hot; v1 += target-order label encoding;
v2 += domain ratios; v3 += age features; v4 += region features;
v5 += EXT_SOURCE row statistics; v6 += document / contact counts;
v7 = all of them except the region block.  Decisions that depend on the data
(which columns get a missing flag, which categories get a dummy) come from
one aggregation each over the train rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import (DAYS_SENTINEL, clip, ieee_div, nullif, row_max, row_mean, row_min,
                               row_null_count, row_null_ratio, row_std, row_sum)
from ..operators.encode import onehot, target_order_encode

ID, TARGET, SPLIT = "SK_ID_CURR", "TARGET", "split"
KEYS = (ID, TARGET, SPLIT)

# Fixed values that must equal the reference's for right results.
MISSING_FLAG_RATE = 0.5
LABEL_COLUMNS = ["NAME_EDUCATION_TYPE", "NAME_HOUSING_TYPE", "NAME_INCOME_TYPE", "NAME_TYPE_SUITE"]
ADDRESS_COLUMNS = ["REG_REGION_NOT_LIVE_REGION", "REG_REGION_NOT_WORK_REGION", "LIVE_REGION_NOT_WORK_REGION",
                   "REG_CITY_NOT_LIVE_CITY", "REG_CITY_NOT_WORK_CITY", "LIVE_CITY_NOT_WORK_CITY"]
EXT_COLUMNS = ["EXT_SOURCE_1", "EXT_SOURCE_2", "EXT_SOURCE_3"]
CONTACT_COLUMNS = ["FLAG_MOBIL", "FLAG_EMP_PHONE", "FLAG_WORK_PHONE", "FLAG_CONT_MOBILE", "FLAG_PHONE",
                   "FLAG_EMAIL"]
DOCUMENT_PREFIX = "FLAG_DOCUMENT_"
TERM_CLIP = (1, 1200)


def _numeric(df: DataFrame) -> list[str]:
    num = ("byte", "short", "integer", "long", "float", "double", "boolean") + ("decimal",)
    return [f.name for f in df.schema.fields
            if f.name not in KEYS and f.dataType.typeName().split("(")[0] in num]


def _strings(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if f.name not in KEYS and f.dataType.typeName() == "string"]


def deal_anomalies(df: DataFrame, rate: float = MISSING_FLAG_RATE) -> DataFrame:
    """B1, B2, B3, B4."""
    d = df.withColumn("DAYS_EMPLOYED_ANOM", (F.col("DAYS_EMPLOYED") == DAYS_SENTINEL).cast("int")) \
          .withColumn("DAYS_EMPLOYED", nullif("DAYS_EMPLOYED", DAYS_SENTINEL))
    num = _numeric(d)
    train = d.where(F.col(SPLIT) == "train")
    rates = train.agg(*[F.avg(F.col(c).isNull().cast("double")).alias(c) for c in num]).first()
    flagged = [c for c in num if rates[c] is not None and rates[c] >= rate]
    d = d.select("*", *[F.col(c).isNull().cast("int").alias(f"MISS__{c}") for c in flagged])
    feats = [c for c in d.columns if c not in KEYS]
    return d.withColumn("ROW_MISSING_RATIO", row_null_ratio(feats))


def domain_features(df: DataFrame, zero: str = "null") -> DataFrame:
    """B5, B6, B7."""
    return df.select(
        "*",
        ieee_div("AMT_CREDIT", "AMT_INCOME_TOTAL", zero).alias("CREDIT_TO_INCOME"),
        ieee_div("AMT_ANNUITY", "AMT_INCOME_TOTAL", zero).alias("ANNUITY_TO_INCOME"),
        ieee_div("AMT_GOODS_PRICE", "AMT_INCOME_TOTAL", zero).alias("GOODS_TO_INCOME"),
        ieee_div("AMT_ANNUITY", "AMT_CREDIT", zero).alias("ANNUITY_TO_CREDIT"),
        clip(ieee_div("AMT_CREDIT", "AMT_ANNUITY", zero), *TERM_CLIP).alias("TERM_MONTHS_EST"),
        ieee_div("AMT_CREDIT", "AMT_GOODS_PRICE", zero).alias("CREDIT_TO_GOODS"),
        ieee_div("AMT_INCOME_TOTAL", nullif("CNT_FAM_MEMBERS", 0), zero).alias("INCOME_PER_PERSON"),
    )


def age_features(df: DataFrame, zero: str = "null") -> DataFrame:
    """B8."""
    years = F.col("DAYS_BIRTH") / F.lit(365.0)
    return df.select(
        "*",
        ieee_div("DAYS_EMPLOYED", "DAYS_BIRTH", zero).alias("EMPLOY_TO_AGE"),
        ieee_div(-F.col("OWN_CAR_AGE"), years, zero).alias("OWN_CAR_AGE_NORM"),
        ieee_div(-F.col("CNT_CHILDREN"), (F.col("DAYS_BIRTH") / F.lit(10.0)) / F.lit(365.0), zero)
        .alias("CHILDREN_PER_10Y"),
    )


def region_features(df: DataFrame) -> DataFrame:
    """B9, B10."""
    present = [c for c in ADDRESS_COLUMNS if c in df.columns]
    return df.select("*",
                     (F.col("REGION_RATING_CLIENT") - F.col("REGION_RATING_CLIENT_W_CITY")).alias("REGION_RATING_DIFF"),
                     row_sum(present).alias("ADDR_MISMATCH_SUM"))


def ext_source_features(df: DataFrame) -> DataFrame:
    """B11, B12, B13 (interactions use each row's own age and income)."""
    ext = [c for c in EXT_COLUMNS if c in df.columns]
    d = df.select("*", row_mean(ext).alias("EXT_MEAN"), row_std(ext).alias("EXT_STD"),
                  row_min(ext).alias("EXT_MIN"), row_max(ext).alias("EXT_MAX"))
    return d.select("*",
                    (F.col("EXT_MEAN") * (-F.col("DAYS_BIRTH") / F.lit(365.0))).alias("EXT_MEAN_X_AGE"),
                    (F.col("EXT_MEAN") * F.log1p(F.col("AMT_INCOME_TOTAL"))).alias("EXT_MEAN_X_LOG_INCOME"),
                    row_null_count(ext).alias("EXT_MISSING_CNT"))


def document_contact_features(df: DataFrame) -> DataFrame:
    """B10, B14."""
    docs = [c for c in df.columns if c.startswith(DOCUMENT_PREFIX)]
    phones = [c for c in CONTACT_COLUMNS if c in df.columns]
    d = df.withColumn("DOCS_SUBMITTED_CNT", row_sum(docs))
    return d.select("*", (F.col("DOCS_SUBMITTED_CNT") > 0).cast("int").alias("DOCS_ANY"),
                    row_sum(phones).alias("CONTACT_FLAGS_SUM"))


def feature_set(app: DataFrame, version: int = 7, onehot_columns: Sequence[str] | None = None,
                zero: str = "null") -> DataFrame:
    """Q7: build feature set v{version} from an application frame with ``split`` and ``TARGET``."""
    d = deal_anomalies(app)
    if version in (1, 7):
        d = target_order_encode(d, LABEL_COLUMNS, TARGET, SPLIT)
    if version in (2, 7):
        d = domain_features(d, zero)
    if version in (3, 7):
        d = age_features(d, zero)
    if version == 4:
        d = region_features(d)
    if version in (5, 7):
        d = ext_source_features(d)
    if version in (6, 7):
        d = document_contact_features(d)
    cats = _strings(d) if onehot_columns is None else list(onehot_columns)
    return onehot(d, cats, split_col=SPLIT)


CODE = "__CODE"  #: suffix of a category column's target-order code in the wide frame


def wide_features(app: DataFrame, zero: str = "null") -> tuple[DataFrame, dict[int, list[str]]]:
    """Q7 for all versions at once: one frame, and the columns of each version v0..v7.

    Every block is computed once.  A category column appears as its target-order code (v1, v7) and as dummies
    (the other versions), so a version is a choice of columns and no frame is built, joined or scanned twice.
    """
    base = deal_anomalies(app)
    plain = [c for c in base.columns if c not in KEYS and c not in LABEL_COLUMNS]
    with_codes = base.select("*", *[F.col(c).alias(f"{c}{CODE}") for c in LABEL_COLUMNS])
    coded = target_order_encode(with_codes, [f"{c}{CODE}" for c in LABEL_COLUMNS], TARGET, SPLIT)
    blocks: dict[str, list[str]] = {}
    for name, build in (("domain", lambda d: domain_features(d, zero)), ("age", lambda d: age_features(d, zero)), ("region", region_features),
                        ("ext", ext_source_features), ("document", document_contact_features)):
        before = set(coded.columns)
        coded = build(coded)
        blocks[name] = [c for c in coded.columns if c not in before]
    others = [c for c in _strings(base) if c not in LABEL_COLUMNS]
    seen = set(coded.columns)
    wide = onehot(coded, [*LABEL_COLUMNS, *others], split_col=SPLIT)
    dummies = [c for c in wide.columns if c not in seen]
    other_dummies = [c for c in dummies if any(c.startswith(f"{o}_") for o in others)]
    codes = [f"{c}{CODE}" for c in LABEL_COLUMNS]
    plain = [c for c in plain if c not in others]
    versions = {0: plain + dummies, 1: plain + codes + other_dummies, 2: plain + dummies + blocks["domain"],
                3: plain + dummies + blocks["age"], 4: plain + dummies + blocks["region"], 5: plain + dummies + blocks["ext"],
                6: plain + dummies + blocks["document"],
                7: plain + codes + other_dummies + blocks["domain"] + blocks["age"] + blocks["ext"] + blocks["document"]}
    return wide, versions
