"""Oracle SQL for rates and binning over the application fixture."""

from __future__ import annotations

from .fixtures_sql import with_fixtures
from .specsql import canon


def _rate(n: str, pmt: str, pv: str) -> str:
    steps = "list_transform(range(1, 56), lambda k: 0.375 / pow(2, k - 1))"
    h = f"({pmt} * (1 - pow(1 + r, -{n})) / r - {pv})"
    root = f"list_reduce(list_prepend(0.25, {steps}), lambda r, w: r + sign{h} * w)"
    return (f"CASE WHEN {n} IS NULL OR {pmt} IS NULL OR {pv} IS NULL OR {n} <= 0 OR {pmt} <= 0 OR {pv} <= 0 "
            f"THEN NULL WHEN {pmt} * {n} = {pv} THEN 0.0 ELSE {root} END")


def financial_sql() -> str:
    t = ("SELECT SK_ID_CURR, AMT_CREDIT, AMT_ANNUITY, CASE WHEN AMT_ANNUITY <> 0 AND AMT_ANNUITY IS NOT NULL "
         "THEN round_even(AMT_CREDIT / AMT_ANNUITY, 0)::BIGINT ELSE 0 END AS TERM FROM app")
    body = with_fixtures("app", extra={"t": t}) + \
        f"SELECT SK_ID_CURR, TERM, {_rate('TERM::DOUBLE', 'AMT_ANNUITY', 'AMT_CREDIT')} AS INTEREST_RATE FROM t"
    return canon(body, ["SK_ID_CURR", "TERM", "INTEREST_RATE"], {"SK_ID_CURR", "TERM"})


def term_features_sql() -> str:
    def div(a, b):
        return f"CASE WHEN {b} <> 0 THEN ({a})::DOUBLE / {b} END"

    c, g, n = "AMT_CREDIT", "AMT_GOODS_PRICE", "AMT_ANNUITY"
    names = {"screwratio1": div(f"{c} - {g}", g), "screwratio2": div(f"{c} - {g}", c), "saint_CNT": div(c, n), "angel_CNT": div(g, n),
             "simple_diff": f"{c} - {g}"}
    body = with_fixtures("app") + f"SELECT SK_ID_CURR, {c}, {n}, {g}, {', '.join(f'{x} AS {k}' for k, x in names.items())} FROM app"
    return canon(body, ["SK_ID_CURR", c, n, g, *names], {"SK_ID_CURR"})


def implied_rates_sql(terms: list[int]) -> str:
    """Likeliest term (ties to the smallest), certainty and implied rates, from weights that follow from the id."""
    weights = ", ".join(f"((SK_ID_CURR * {3 + 2 * i}) % 7 + 1)::DOUBLE" for i in range(len(terms)))
    body = with_fixtures("app", extra={
        "w": f"SELECT *, [{weights}] AS w FROM app",
        "p": "SELECT *, list_transform(w, lambda x: x / list_sum(w)) AS p FROM w",
        "b": f"SELECT *, ({terms})[list_position(p, list_max(p))] AS t, list_sum(list_transform(p, lambda x: x * x)) AS certainty FROM p",
    }) + (f"SELECT SK_ID_CURR, t AS REBUILT_CNT, certainty AS CERTAINTY, {_rate('t::DOUBLE', 'AMT_ANNUITY', 'AMT_CREDIT')} AS RATE_CREDIT, "
          f"{_rate('t::DOUBLE', 'AMT_ANNUITY', 'AMT_GOODS_PRICE')} AS RATE_GOODS FROM b")
    return canon(body, ["SK_ID_CURR", "REBUILT_CNT", "CERTAINTY", "RATE_CREDIT", "RATE_GOODS"], {"SK_ID_CURR", "REBUILT_CNT"})


def rank_qbin_sql(col: str = "EXT_SOURCE_2", q: int = 64) -> str:
    r = (f"SELECT SK_ID_CURR, row_number() OVER (ORDER BY {col}, SK_ID_CURR) AS r, count(*) OVER () AS n "
         f"FROM app WHERE {col} IS NOT NULL")
    body = with_fixtures("app", extra={"r": r}) + (
        f"SELECT a.SK_ID_CURR, CASE WHEN r.n <= 1 THEN 0 ELSE greatest(floor(((r.r - 1) * {q} + r.n - 2) / (r.n - 1)) - 1, 0) "
        f"END::INTEGER AS {col}_QBIN FROM app a LEFT JOIN r USING (SK_ID_CURR)")
    return canon(body, ["SK_ID_CURR", f"{col}_QBIN"], {"SK_ID_CURR", f"{col}_QBIN"})


def equal_width_sql(col: str = "AMT_INCOME_TOTAL", bins: int = 10) -> str:
    mm = f"SELECT min({col})::DOUBLE AS lo, max({col})::DOUBLE AS hi FROM app"
    x = f"{col}::DOUBLE"
    b = (f"CASE WHEN {x} IS NULL THEN NULL WHEN hi = lo THEN 0 WHEN {x} = lo THEN 0 "
         f"ELSE least(greatest(ceil(({x} - lo) / ((hi - lo) / {bins})) - 1, 0), {bins - 1}) END")
    body = with_fixtures("app", extra={"mm": mm}) + f"SELECT SK_ID_CURR, ({b})::INTEGER AS {col}_WBIN FROM app, mm"
    return canon(body, ["SK_ID_CURR", f"{col}_WBIN"], {"SK_ID_CURR", f"{col}_WBIN"})


def _woe_ctes(cols: list[str], cats: list[str], min_bin: int, q_max: int, q_min: int) -> dict:
    """Bins of every row by edges over all rows, categories as bins, and WOE over the train rows."""
    casts = ", ".join(f"{c}::DOUBLE AS {c}" for c in cols)
    e_parts = []
    for q in range(q_max, q_min - 1, -1):
        probs = ", ".join(f"{i}::DOUBLE / {q}" for i in range(q + 1))
        e_parts.append(f"SELECT feature, {q} AS q, list_sort(list_distinct(quantile_cont(value, [{probs}]))) AS edges "
                       f"FROM l WHERE value IS NOT NULL GROUP BY feature")
    bin_expr = ("least(len(list_filter(e.edges[2:], lambda x: x < l.value)), len(e.edges) - 2)")
    return {
        "l": f"SELECT * FROM (SELECT SK_ID_CURR, split, TARGET, {casts} FROM app) "
             f"UNPIVOT INCLUDE NULLS (value FOR feature IN ({', '.join(cols)}))",
        "lc": f"SELECT * FROM (SELECT SK_ID_CURR, split, TARGET, {', '.join(cats)} FROM app) "
              f"UNPIVOT INCLUDE NULLS (value FOR feature IN ({', '.join(cats)}))",
        "e": " UNION ALL ".join(e_parts),
        "bins": "SELECT l.feature, e.q, len(list_filter(e.edges[2:], lambda x: x < l.value)) AS b, count(*) AS c "
                "FROM l JOIN e ON l.feature = e.feature WHERE l.value IS NOT NULL "
                "AND len(e.edges) >= 2 GROUP BY l.feature, e.q, b",
        "stat": "SELECT feature, q, min(c) AS mn, count(*) AS nb FROM bins GROUP BY feature, q",
        "cand": f"SELECT s.feature, s.q FROM stat s JOIN e ON s.feature = e.feature AND s.q = e.q "
                f"WHERE (s.mn >= {min_bin} AND s.nb = len(e.edges) - 1) OR s.q = {q_min}",
        "choice": "SELECT feature, max(q) AS q FROM cand GROUP BY feature",
        "lab": f"SELECT l.SK_ID_CURR, l.split, l.TARGET, l.feature || '_BIN' AS feature, CASE WHEN l.value IS NULL THEN 'NA' "
               f"WHEN ch.q IS NULL THEN 'ALL' ELSE 'b' || {bin_expr} END AS bin "
               "FROM l LEFT JOIN choice ch ON l.feature = ch.feature LEFT JOIN e ON e.feature = l.feature AND e.q = ch.q "
               "UNION ALL SELECT SK_ID_CURR, split, TARGET, feature || '_BIN', coalesce(value, '__CAT_NA__') FROM lc",
        "per": "SELECT feature, bin, sum(TARGET) AS pos, count(*) AS cnt FROM lab WHERE split = 'train' GROUP BY feature, bin",
        "tot": "SELECT feature, sum(TARGET) AS P, count(*) AS T FROM lab WHERE split = 'train' GROUP BY feature",
        "woe": "SELECT per.feature, per.bin, per.pos, per.cnt, "
               "ln(((per.cnt - per.pos + 0.5) / (per.pos + 0.5)) / ((tot.T - tot.P + 0.5) / (tot.P + 0.5))) AS woe "
               "FROM per JOIN tot USING (feature)",
    }


def woe_transform_sql(cols: list[str], cats: list[str], min_bin: int = 200, q_max: int = 10, q_min: int = 2) -> str:
    """WOE of every train and test row (unseen bins -> 0)."""
    names = [*cols, *cats]
    body = with_fixtures("app", extra=_woe_ctes(cols, cats, min_bin, q_max, q_min)) + (
        "SELECT SK_ID_CURR, split, " + ", ".join(
            f"max(CASE WHEN lab.feature = '{c}_BIN' THEN coalesce(woe.woe, 0.0) END) AS {c}_BIN_WOE" for c in names)
        + " FROM lab LEFT JOIN woe ON lab.feature = woe.feature AND lab.bin = woe.bin GROUP BY SK_ID_CURR, split")
    return canon(body, ["SK_ID_CURR", "split", *[f"{c}_BIN_WOE" for c in names]], {"SK_ID_CURR"}, strings={"split"})


def safe_qcut_woe_sql(cols: list[str], cats: list[str], min_bin: int = 200, q_max: int = 10, q_min: int = 2) -> str:
    body = with_fixtures("app", extra=_woe_ctes(cols, cats, min_bin, q_max, q_min)) + \
        "SELECT feature, bin, pos, cnt, woe FROM woe"
    return canon(body, ["feature", "bin", "pos", "cnt", "woe"], {"pos", "cnt"}, strings={"feature", "bin"})
