"""Oracle SQL for statistics / evaluation operators over the application fixture."""

from __future__ import annotations

from .application_sql import APP_COLS, LABELS
from .fixtures_sql import with_fixtures
from .specsql import canon

NUM_COLS = [c for c in APP_COLS if c not in LABELS]


def _long(where: str = "split = 'train'") -> str:
    cols = ", ".join(f"{c}::DOUBLE AS {c}" for c in NUM_COLS)
    return (f"SELECT * FROM (UNPIVOT (SELECT SK_ID_CURR, TARGET, {cols} FROM app WHERE {where}) "
            f"ON {', '.join(NUM_COLS)} INTO NAME feature VALUE value)")


def auc_sql() -> str:
    body = with_fixtures("app", extra={"l": _long(), "r": """
      SELECT feature, TARGET, value,
        rank() OVER (PARTITION BY feature ORDER BY value) + (count(*) OVER (PARTITION BY feature, value) - 1) / 2.0 AS ar
      FROM l"""}) + """
    SELECT feature,
      CASE WHEN sum(TARGET) > 0 AND count(*) - sum(TARGET) > 0 THEN
        (sum(CASE WHEN TARGET = 1 THEN ar ELSE 0 END) - sum(TARGET) * (sum(TARGET) + 1) / 2.0)
        / (sum(TARGET)::DOUBLE * (count(*) - sum(TARGET))) END AS auc
    FROM r GROUP BY feature"""
    return canon(body, ["feature", "auc"], set(), strings={"feature"})


def ap_sql() -> str:
    body = with_fixtures("app", extra={"l": _long(), "t": """
      SELECT feature, value, count(*) AS c, sum(TARGET) AS pos FROM l GROUP BY feature, value""", "r": """
      SELECT feature, pos,
        sum(c) OVER (PARTITION BY feature ORDER BY value DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum,
        sum(pos) OVER (PARTITION BY feature ORDER BY value DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS tp,
        sum(pos) OVER (PARTITION BY feature) AS P
      FROM t"""}) + """
    SELECT feature, sum(CASE WHEN pos > 0 THEN (pos::DOUBLE / P) * (tp::DOUBLE / cum) END) AS average_precision
    FROM r GROUP BY feature"""
    return canon(body, ["feature", "average_precision"], set(), strings={"feature"})


def spearman_sql() -> str:
    body = with_fixtures("app", extra={"l": _long(), "r": """
      SELECT feature,
        rank() OVER (PARTITION BY feature ORDER BY value) + (count(*) OVER (PARTITION BY feature, value) - 1) / 2.0 AS rx,
        rank() OVER (PARTITION BY feature ORDER BY TARGET) + (count(*) OVER (PARTITION BY feature, TARGET) - 1) / 2.0 AS ry
      FROM l"""}) + """
    SELECT feature, abs(CASE WHEN var_pop(rx) > 0 AND var_pop(ry) > 0 THEN corr(rx, ry) END) AS spearman_abs
    FROM r GROUP BY feature"""
    return canon(body, ["feature", "spearman_abs"], set(), strings={"feature"})


def mi_sql() -> str:
    cols = ", ".join(LABELS)
    body = with_fixtures("app", extra={
        "l": f"SELECT * FROM (UNPIVOT (SELECT SK_ID_CURR, TARGET, {cols} FROM app WHERE split = 'train') "
             f"ON {cols} INTO NAME feature VALUE value)",
        "j": "SELECT feature, value, TARGET, count(*) AS nxy FROM l GROUP BY ALL",
        "k": """SELECT *, sum(nxy) OVER (PARTITION BY feature, value) AS nx,
                   sum(nxy) OVER (PARTITION BY feature, TARGET) AS ny,
                   sum(nxy) OVER (PARTITION BY feature) AS n FROM j"""}) + """
    SELECT feature, sum((nxy::DOUBLE / n) * ln(nxy::DOUBLE * n / (nx::DOUBLE * ny))) AS mi FROM k GROUP BY feature"""
    return canon(body, ["feature", "mi"], set(), strings={"feature"})


def medians_sql() -> str:
    body = with_fixtures("app", extra={"l": _long("TRUE")}) + \
        "SELECT feature, quantile_cont(value, [0.1, 0.5, 0.9]) AS qs FROM l GROUP BY feature"
    body = f"SELECT feature, unnest([0.1, 0.5, 0.9]) AS p, unnest(qs) AS q FROM ({body})"
    return canon(body, ["feature", "p", "q"], set(), strings={"feature"})


def missing_table_sql(inner: str, cols: list[str]) -> str:
    counts = ", ".join(f"count(*) FILTER (WHERE {c} IS NULL) AS {c}" for c in cols)
    body = (f"WITH t AS MATERIALIZED ({inner}), c AS (SELECT count(*) AS n, {counts} FROM t) "
            f"SELECT feature, missing_count, round(missing_count * 100.0 / n, 1) AS missing_pct FROM "
            f"(UNPIVOT c ON {', '.join(cols)} INTO NAME feature VALUE missing_count) WHERE missing_count > 0")
    return canon(body, ["feature", "missing_count", "missing_pct"], {"missing_count"}, strings={"feature"})


def dtype(c: str) -> str:
    """The engine's name of a column's type."""
    from .application_sql import INT_APP
    return "string" if c in LABELS or c == "split" else "bigint" if c == "SK_ID_CURR" else "int" if c in INT_APP or c == "TARGET" else "double"


def audit_sql() -> str:
    cols = ["split", "TARGET"] + APP_COLS
    parts = []
    for c in cols:
        parts.append(f"SELECT '{c}' AS feature, '{dtype(c)}' AS dtype, avg(({c} IS NULL)::INTEGER) AS missing_rate, "
                     f"count(DISTINCT {c}) AS nunique, count(*) AS n FROM app")
    body = with_fixtures("app") + " UNION ALL ".join(parts)
    body = (f"SELECT feature, dtype, missing_rate, nunique, (nunique::DOUBLE / greatest(n, 1) <= 1e-8 OR nunique <= 1) "
            f"AS near_constant, (missing_rate > 0.98) AS high_missing FROM ({body})")
    return canon(body, ["feature", "dtype", "missing_rate", "nunique", "near_constant", "high_missing"],
                 {"nunique", "near_constant", "high_missing"}, strings={"feature", "dtype"})


def pearson_sql(cols: list[str]) -> str:
    parts = []
    for a in cols:
        for b in cols:
            parts.append(f"corr({a}::DOUBLE, {b}::DOUBLE)")
    # one pass; NaN where one side has a single value
    pairs = ", ".join(f"('{a}', '{b}')" for a in cols for b in cols)
    body = with_fixtures("app", extra={"c": f"SELECT unnest([{', '.join(parts)}]) AS corr, unnest(range({len(parts)})) AS i FROM app",
                                       "p": f"SELECT *, row_number() OVER () - 1 AS i FROM (VALUES {pairs}) t(col_a, col_b)"}) + \
        "SELECT col_a, col_b, CASE WHEN NOT isnan(corr) THEN corr END AS corr FROM p JOIN c USING (i)"
    return canon(body, ["col_a", "col_b", "corr"], set(), strings={"col_a", "col_b"})


def category_rate_sql() -> str:
    body = with_fixtures("app") + ("SELECT NAME_INCOME_TYPE, count(*) AS count, avg(TARGET) AS default_rate "
                                   "FROM app WHERE split = 'train' GROUP BY NAME_INCOME_TYPE")
    return canon(body, ["NAME_INCOME_TYPE", "count", "default_rate"], {"count"}, strings={"NAME_INCOME_TYPE"})


def label_balance_sql() -> str:
    body = with_fixtures("app") + ("SELECT sum((TARGET = 0)::INTEGER) AS neg, sum((TARGET = 1)::INTEGER) AS pos, "
                                   "sum((TARGET = 0)::INTEGER)::DOUBLE / sum((TARGET = 1)::INTEGER) AS ratio "
                                   "FROM app WHERE split = 'train'")
    return canon(body, ["neg", "pos", "ratio"], {"neg", "pos"})


def oof_auc_sql() -> str:
    """J3 numeric path over the application fixture's numeric columns."""
    from .blend_sql import folds_sql
    cols = ", ".join(f"{c}::DOUBLE AS {c}" for c in NUM_COLS)
    f = folds_sql()
    body = (f"WITH f AS ({f}), app AS ({__import__('sqlcheck.fixtures_sql', fromlist=['APPLICATION']).APPLICATION}), "
            f"w AS (SELECT a.SK_ID_CURR, a.TARGET, f.fold, {cols} FROM app a JOIN f USING (SK_ID_CURR)), "
            f"l AS (SELECT * FROM w UNPIVOT INCLUDE NULLS (value FOR feature IN ({', '.join(NUM_COLS)}))), "
            f"med AS (SELECT l.feature, k.fold, quantile_cont(l.value, 0.5) AS m FROM l "
            f"  JOIN (SELECT DISTINCT fold FROM f) k ON l.fold <> k.fold GROUP BY l.feature, k.fold), "
            f"fl AS (SELECT l.feature, l.fold, l.TARGET, coalesce(l.value, med.m) AS v FROM l "
            f"  LEFT JOIN med ON l.feature = med.feature AND l.fold = med.fold), "
            f"sc AS (SELECT feature, TARGET, (rank() OVER (PARTITION BY feature, fold ORDER BY v) + "
            f"  (count(*) OVER (PARTITION BY feature, fold, v) - 1) / 2.0) / count(*) OVER (PARTITION BY feature, fold) AS s "
            f"  FROM fl WHERE v IS NOT NULL), "
            f"r AS (SELECT feature, TARGET, rank() OVER (PARTITION BY feature ORDER BY s) + "
            f"  (count(*) OVER (PARTITION BY feature, s) - 1) / 2.0 AS ar FROM sc), "
            f"a AS (SELECT feature, (sum(CASE WHEN TARGET = 1 THEN ar ELSE 0 END) - sum(TARGET) * (sum(TARGET) + 1) / 2.0)"
            f"  / (sum(TARGET)::DOUBLE * (count(*) - sum(TARGET))) AS auc FROM r GROUP BY feature) "
            f"SELECT feature, greatest(auc, 1 - auc) AS auc_single FROM a")
    return canon(body, ["feature", "auc_single"], set(), strings={"feature"})
