"""Oracle SQL for imputation, scaling, plain folds, id bases, weights and reports."""

from __future__ import annotations

from .blend_sql import MODELS, _h
from .fixtures_sql import with_fixtures
from .specsql import canon
from .stats_sql import NUM_COLS

ID = {"SK_ID_CURR"}


def median_sql(fit: str) -> str:
    cols = ", ".join(f"coalesce({c}::DOUBLE, (SELECT quantile_cont({c}::DOUBLE, 0.5) FROM app WHERE {fit})) AS {c}" for c in NUM_COLS)
    body = with_fixtures("app") + f"SELECT SK_ID_CURR, split, {cols} FROM app"
    return canon(body, ["SK_ID_CURR", "split", *NUM_COLS], ID, strings={"split"})


def standardize_sql(fit: str) -> str:
    stat = ", ".join(f"avg({c}::DOUBLE) AS mu_{c}, coalesce(nullif(stddev_pop({c}::DOUBLE), 0), 1) AS sd_{c}" for c in NUM_COLS)
    cols = ", ".join(f"({c} - mu_{c}) / sd_{c} AS {c}" for c in NUM_COLS)
    body = with_fixtures("app", extra={"st": f"SELECT {stat} FROM app WHERE {fit}"}) + f"SELECT SK_ID_CURR, split, {cols} FROM app, st"
    return canon(body, ["SK_ID_CURR", "split", *NUM_COLS], ID, strings={"split"})


def kfold_sql(k: int = 5, seed: int = 50) -> str:
    body = with_fixtures("app") + (f"SELECT SK_ID_CURR, (row_number() OVER (ORDER BY {_h(seed, 'SK_ID_CURR')}, SK_ID_CURR) - 1) % {k} "
                                   "AS fold FROM app WHERE split = 'train'")
    return canon(body, ["SK_ID_CURR", "fold"], {"SK_ID_CURR", "fold"})


def id_base_sql() -> str:
    return canon(with_fixtures("ins") + "SELECT DISTINCT SK_ID_CURR FROM ins", ["SK_ID_CURR"], ID)


def minimal_base_sql() -> str:
    return canon(with_fixtures("app") + "SELECT SK_ID_CURR, split, TARGET FROM app", ["SK_ID_CURR", "split", "TARGET"],
                 {"SK_ID_CURR", "TARGET"}, strings={"split"})


def binary_codes_sql() -> str:
    """The label columns of the fixture have more than two values each; the split has two."""
    body = with_fixtures("app") + "SELECT SK_ID_CURR, dense_rank() OVER (ORDER BY split) - 1 AS split FROM app"
    return canon(body, ["SK_ID_CURR", "split"], {"SK_ID_CURR", "split"})


def dropped_sql() -> str:
    body = with_fixtures("preds") + (
        f"SELECT sum((m < {len(MODELS)})::INTEGER) AS dropped, count(*) AS ids FROM "
        "(SELECT id, count(DISTINCT model) AS m FROM preds WHERE pred IS NOT NULL GROUP BY id)")
    return canon(body, ["dropped", "ids"], {"dropped", "ids"})


def weights_sql() -> str:
    body = with_fixtures("preds", extra={
        "w": "SELECT model, CASE WHEN model = 'm4' THEN 1.0 ELSE avg(pred) END AS w FROM preds GROUP BY model"}) + (
        "SELECT model, w / (SELECT sum(w) FROM w) AS weight FROM w")
    return canon(body, ["model", "weight"], set(), strings={"model"})


def missing_over_sql(inner: str, cols: list[str]) -> str:
    shares = ", ".join(f"100 * avg(({c} IS NULL)::INTEGER)" for c in cols)
    body = (f"WITH t AS MATERIALIZED ({inner}), s AS (SELECT unnest([{shares}]) AS share FROM t) "
            'SELECT lim AS "limit", (SELECT count(*) FROM s WHERE share > lim) AS "columns" FROM (VALUES (20.0), (50.0)) v(lim)')
    return canon(body, ['"limit"', '"columns"'], {'"columns"'})


def duplicates_sql() -> str:
    pairs = [("CREDIT_COPY", "AMT_CREDIT", "AMT_CREDIT"), ("BIRTH_COPY", "DAYS_BIRTH", "DAYS_BIRTH"),
             ("SUITE_COPY", "NAME_TYPE_SUITE", "NAME_TYPE_SUITE"), ("CREDIT_COPY_2", "AMT_CREDIT", "AMT_CREDIT"),
             ("EXT_FILLED", "EXT_SOURCE_1", "coalesce(EXT_SOURCE_1, 0.5)")]
    parts = [f"SELECT '{a}' AS \"column\", '{b}' AS duplicate_of WHERE (SELECT count(*) FROM app WHERE {b} IS DISTINCT FROM {x}) = 0"
             for a, b, x in pairs]
    return with_fixtures("app") + " UNION ALL ".join(parts)
