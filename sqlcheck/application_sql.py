"""Oracle SQL for Q7 v7 (main-table features) and its encoders."""

from __future__ import annotations

from .fixtures_sql import with_fixtures
from .specsql import canon

APP_COLS = ["AMT_INCOME_TOTAL", "AMT_CREDIT", "AMT_ANNUITY", "AMT_GOODS_PRICE", "CNT_FAM_MEMBERS",
            "CNT_CHILDREN", "OWN_CAR_AGE", "EXT_SOURCE_1", "EXT_SOURCE_2", "EXT_SOURCE_3", "DAYS_BIRTH",
            "DAYS_EMPLOYED", "REGION_RATING_CLIENT", "REGION_RATING_CLIENT_W_CITY",
            "REG_REGION_NOT_LIVE_REGION", "REG_REGION_NOT_WORK_REGION", "LIVE_REGION_NOT_WORK_REGION",
            "REG_CITY_NOT_LIVE_CITY", "REG_CITY_NOT_WORK_CITY", "LIVE_CITY_NOT_WORK_CITY",
            "FLAG_DOCUMENT_2", "FLAG_DOCUMENT_3", "FLAG_DOCUMENT_4", "FLAG_MOBIL", "FLAG_EMP_PHONE",
            "FLAG_WORK_PHONE", "FLAG_CONT_MOBILE", "FLAG_PHONE", "FLAG_EMAIL", "NAME_EDUCATION_TYPE",
            "NAME_HOUSING_TYPE", "NAME_INCOME_TYPE", "NAME_TYPE_SUITE"]
LABELS = ["NAME_EDUCATION_TYPE", "NAME_HOUSING_TYPE", "NAME_INCOME_TYPE", "NAME_TYPE_SUITE"]
INT_APP = {"CNT_CHILDREN", "DAYS_BIRTH", "DAYS_EMPLOYED", "REGION_RATING_CLIENT", "REGION_RATING_CLIENT_W_CITY",
           "REG_REGION_NOT_LIVE_REGION", "REG_REGION_NOT_WORK_REGION", "LIVE_REGION_NOT_WORK_REGION",
           "REG_CITY_NOT_LIVE_CITY", "REG_CITY_NOT_WORK_CITY", "LIVE_CITY_NOT_WORK_CITY",
           "FLAG_DOCUMENT_2", "FLAG_DOCUMENT_3", "FLAG_DOCUMENT_4", "FLAG_MOBIL", "FLAG_EMP_PHONE",
           "FLAG_WORK_PHONE", "FLAG_CONT_MOBILE", "FLAG_PHONE", "FLAG_EMAIL"}


def _div(a: str, b: str) -> str:
    return f"CASE WHEN ({b}) <> 0 THEN CAST({a} AS DOUBLE) / ({b}) END"


def anomalies_sql() -> tuple[str, list[str]]:
    # The fixture makes OWN_CAR_AGE missing on 2 of 3 customers by construction,
    # the only numeric column at or above the 0.5 train missing rate.
    feats = [c for c in APP_COLS] + ["DAYS_EMPLOYED_ANOM", "MISS__OWN_CAR_AGE"]
    nulls = " + ".join(f"({c} IS NULL)::INTEGER" for c in feats)
    a1 = ("SELECT * REPLACE (CASE WHEN DAYS_EMPLOYED <> 365243 THEN DAYS_EMPLOYED END AS DAYS_EMPLOYED), "
          "(DAYS_EMPLOYED = 365243)::INTEGER AS DAYS_EMPLOYED_ANOM, "
          "(OWN_CAR_AGE IS NULL)::INTEGER AS MISS__OWN_CAR_AGE FROM app")
    a2 = f"SELECT *, ({nulls})::DOUBLE / {len(feats)} AS ROW_MISSING_RATIO FROM a1"
    return a1, a2


def label_ctes() -> dict[str, str]:
    ctes = {}
    prev = "a2"
    for i, c in enumerate(LABELS):
        mode = (f"SELECT {c} AS m FROM (SELECT {c}, count(*) AS n FROM {prev} WHERE split = 'train' "
                f"AND {c} IS NOT NULL GROUP BY {c}) ORDER BY n DESC, {c} LIMIT 1")
        filled = f"SELECT * REPLACE (coalesce({c}, (SELECT m FROM ({mode}))) AS {c}) FROM {prev}"
        ctes[f"f{i}"] = filled
        dic = (f"SELECT {c} AS cat, (row_number() OVER (ORDER BY avg(TARGET), {c}) - 1)::INTEGER AS code "
               f"FROM f{i} WHERE split = 'train' AND {c} IS NOT NULL GROUP BY {c}")
        ctes[f"d{i}"] = dic
        ctes[f"e{i}"] = (f"SELECT f{i}.* REPLACE (d{i}.code AS {c}) FROM f{i} "
                         f"LEFT JOIN d{i} ON f{i}.{c} = d{i}.cat")
        prev = f"e{i}"
    return ctes


def v7_body() -> str:
    a1, a2 = anomalies_sql()
    ctes = {"a1": a1, "a2": a2}
    ctes.update(label_ctes())
    ext = "[EXT_SOURCE_1, EXT_SOURCE_2, EXT_SOURCE_3]"
    present = f"list_filter({ext}, lambda x: x IS NOT NULL)"
    dom = f"""SELECT *,
      {_div('AMT_CREDIT', 'AMT_INCOME_TOTAL')} AS CREDIT_TO_INCOME,
      {_div('AMT_ANNUITY', 'AMT_INCOME_TOTAL')} AS ANNUITY_TO_INCOME,
      {_div('AMT_GOODS_PRICE', 'AMT_INCOME_TOTAL')} AS GOODS_TO_INCOME,
      {_div('AMT_ANNUITY', 'AMT_CREDIT')} AS ANNUITY_TO_CREDIT,
      CASE WHEN AMT_ANNUITY <> 0 THEN least(greatest(AMT_CREDIT / AMT_ANNUITY, 1), 1200) END AS TERM_MONTHS_EST,
      {_div('AMT_CREDIT', 'AMT_GOODS_PRICE')} AS CREDIT_TO_GOODS,
      {_div('AMT_INCOME_TOTAL', 'CASE WHEN CNT_FAM_MEMBERS <> 0 THEN CNT_FAM_MEMBERS END')} AS INCOME_PER_PERSON,
      {_div('DAYS_EMPLOYED', 'DAYS_BIRTH')} AS EMPLOY_TO_AGE,
      {_div('-OWN_CAR_AGE', 'DAYS_BIRTH / 365.0')} AS OWN_CAR_AGE_NORM,
      {_div('-CNT_CHILDREN', '(DAYS_BIRTH / 10.0) / 365.0')} AS CHILDREN_PER_10Y,
      CASE WHEN len({present}) > 0 THEN list_avg({present}) END AS EXT_MEAN,
      CASE WHEN len({present}) > 1 THEN list_stddev_samp({present}) END AS EXT_STD,
      list_min({present}) AS EXT_MIN,
      list_max({present}) AS EXT_MAX,
      (EXT_SOURCE_1 IS NULL)::INTEGER + (EXT_SOURCE_2 IS NULL)::INTEGER + (EXT_SOURCE_3 IS NULL)::INTEGER AS EXT_MISSING_CNT,
      coalesce(FLAG_DOCUMENT_2, 0) + coalesce(FLAG_DOCUMENT_3, 0) + coalesce(FLAG_DOCUMENT_4, 0) AS DOCS_SUBMITTED_CNT,
      coalesce(FLAG_MOBIL, 0) + coalesce(FLAG_EMP_PHONE, 0) + coalesce(FLAG_WORK_PHONE, 0)
        + coalesce(FLAG_CONT_MOBILE, 0) + coalesce(FLAG_PHONE, 0) + coalesce(FLAG_EMAIL, 0) AS CONTACT_FLAGS_SUM
    FROM e3"""
    ctes["g"] = dom
    fin = ("SELECT *, EXT_MEAN * (-DAYS_BIRTH / 365.0) AS EXT_MEAN_X_AGE, "
           "EXT_MEAN * CASE WHEN AMT_INCOME_TOTAL > -1 THEN ln(1 + AMT_INCOME_TOTAL) END AS EXT_MEAN_X_LOG_INCOME, "
           "(DOCS_SUBMITTED_CNT > 0)::INTEGER AS DOCS_ANY FROM g")
    return with_fixtures("app", extra=ctes) + fin


def v7_sql() -> str:
    cols = (["SK_ID_CURR", "split", "TARGET"] + APP_COLS + ["DAYS_EMPLOYED_ANOM", "MISS__OWN_CAR_AGE",
            "ROW_MISSING_RATIO", "CREDIT_TO_INCOME", "ANNUITY_TO_INCOME", "GOODS_TO_INCOME",
            "ANNUITY_TO_CREDIT", "TERM_MONTHS_EST", "CREDIT_TO_GOODS", "INCOME_PER_PERSON", "EMPLOY_TO_AGE",
            "OWN_CAR_AGE_NORM", "CHILDREN_PER_10Y", "EXT_MEAN", "EXT_STD", "EXT_MIN", "EXT_MAX",
            "EXT_MEAN_X_AGE", "EXT_MEAN_X_LOG_INCOME", "EXT_MISSING_CNT", "DOCS_SUBMITTED_CNT", "DOCS_ANY",
            "CONTACT_FLAGS_SUM"])
    ints = INT_APP | set(LABELS) | {"SK_ID_CURR", "TARGET", "DAYS_EMPLOYED_ANOM", "MISS__OWN_CAR_AGE",
                                    "EXT_MISSING_CNT", "DOCS_SUBMITTED_CNT", "DOCS_ANY", "CONTACT_FLAGS_SUM"}
    return canon(v7_body(), cols, ints, strings={"split"})
