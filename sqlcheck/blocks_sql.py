"""Oracle SQL for the feature blocks (Q1-Q6), written against the fixture CTEs."""

from __future__ import annotations

from riskloom.plans import specs as S

from .fixtures_sql import with_fixtures
from .specsql import canon, names_of, spec_sql


def _div(a: str, b: str) -> str:
    return f"CASE WHEN ({b}) <> 0 THEN CAST({a} AS DOUBLE) / ({b}) END"


PREV_ROWS = f"""
SELECT * REPLACE (
    CASE WHEN DAYS_FIRST_DRAWING <> 365243 THEN DAYS_FIRST_DRAWING END AS DAYS_FIRST_DRAWING,
    CASE WHEN DAYS_FIRST_DUE <> 365243 THEN DAYS_FIRST_DUE END AS DAYS_FIRST_DUE,
    CASE WHEN DAYS_LAST_DUE_1ST_VERSION <> 365243 THEN DAYS_LAST_DUE_1ST_VERSION END AS DAYS_LAST_DUE_1ST_VERSION,
    CASE WHEN DAYS_LAST_DUE <> 365243 THEN DAYS_LAST_DUE END AS DAYS_LAST_DUE,
    CASE WHEN DAYS_TERMINATION <> 365243 THEN DAYS_TERMINATION END AS DAYS_TERMINATION)
FROM prev
"""

PREV_PROC = f"""
SELECT *,
  AMT_APPLICATION - AMT_CREDIT AS PREV_CREDIT_DIFF,
  AMT_APPLICATION - AMT_GOODS_PRICE AS PREV_GOODS_DIFF,
  {_div('AMT_CREDIT', 'AMT_APPLICATION')} AS PREV_CREDIT_APPL_RATIO,
  {_div('AMT_GOODS_PRICE', 'AMT_APPLICATION')} AS PREV_GOODS_APPL_RATIO,
  DAYS_LAST_DUE_1ST_VERSION - DAYS_LAST_DUE AS PREV_DAYS_LAST_DUE_DIFF,
  {_div(_div('AMT_ANNUITY * CNT_PAYMENT', 'AMT_CREDIT') + ' - 1.0', 'CNT_PAYMENT')} AS PREV_INTERESTS_RATE
FROM prev_clean
"""


def prev_block_sql() -> tuple[str, list[str], set[str]]:
    items, ints = spec_sql(S.PREV_SPEC, S.PREV_PREFIX)
    i2, n2 = spec_sql(S.PREV_SPEC, S.PREV_RECENT_PREFIX, f"DAYS_DECISION > {S.PREV_RECENT_DAYS}")
    items += i2
    ints |= n2
    n_ar = "count(CASE WHEN NAME_CONTRACT_STATUS IN ('Approved','Refused') THEN 1 END)"
    for name, v in (("PREV_REFUSED_RATIO", "Refused"), ("PREV_APPROVED_RATIO", "Approved")):
        items.append(f"CASE WHEN {n_ar} > 0 THEN count(CASE WHEN NAME_CONTRACT_STATUS = '{v}' THEN 1 END)::DOUBLE"
                     f" / count(SK_ID_CURR) END AS {name}")
    body = (with_fixtures("prev", extra={"prev_clean": PREV_ROWS, "p": PREV_PROC})
            + f"SELECT SK_ID_CURR, {', '.join(items)} FROM p GROUP BY SK_ID_CURR")
    return body, ["SK_ID_CURR"] + names_of(items), ints | {"SK_ID_CURR"}


BUREAU_PROC = f"""
SELECT *,
  DAYS_CREDIT_ENDDATE - DAYS_ENDDATE_FACT AS BUREAU_ENDDATE_FACT_DIFF,
  DAYS_CREDIT - DAYS_ENDDATE_FACT AS BUREAU_CREDIT_FACT_DIFF,
  DAYS_CREDIT - DAYS_CREDIT_ENDDATE AS BUREAU_CREDIT_ENDDATE_DIFF,
  {_div('AMT_CREDIT_SUM_DEBT', 'AMT_CREDIT_SUM')} AS BUREAU_CREDIT_DEBT_RATIO,
  AMT_CREDIT_SUM_DEBT - AMT_CREDIT_SUM AS BUREAU_CREDIT_DEBT_DIFF,
  (CASE WHEN CREDIT_DAY_OVERDUE > 0 THEN 1 ELSE 0 END)::INTEGER AS BUREAU_IS_DPD,
  (CASE WHEN CREDIT_DAY_OVERDUE > 120 THEN 1 ELSE 0 END)::INTEGER AS BUREAU_IS_DPD_OVER120
FROM bureau
"""

BB_CUST = """
SELECT b.SK_ID_CURR, bb.MONTHS_BALANCE,
  (CASE WHEN bb.STATUS IN ('1','2','3','4','5') THEN 1 ELSE 0 END)::INTEGER AS BUREAU_BAL_IS_DPD,
  (CASE WHEN bb.STATUS = '5' THEN 1 ELSE 0 END)::INTEGER AS BUREAU_BAL_IS_DPD_OVER120
FROM bureau_bal bb JOIN bureau b ON bb.SK_ID_BUREAU = b.SK_ID_BUREAU
"""

BUREAU_INT = {"DAYS_CREDIT", "CREDIT_DAY_OVERDUE", "BUREAU_IS_DPD", "BUREAU_IS_DPD_OVER120"}


def bureau_block_sql() -> tuple[str, list[str], set[str]]:
    items, ints = spec_sql(S.BUREAU_SPEC, S.BUREAU_PREFIX, int_cols=BUREAU_INT)
    for pre, cond in ((S.BUREAU_ACTIVE_PREFIX, "CREDIT_ACTIVE = 'Active'"),
                      (S.BUREAU_RECENT_PREFIX, f"DAYS_CREDIT > {S.BUREAU_RECENT_DAYS}")):
        i2, n2 = spec_sql(S.BUREAU_SPEC, pre, cond, BUREAU_INT)
        items += i2
        ints |= n2
    act = "CREDIT_ACTIVE = 'Active'"
    for name, fl in (("BUREAU_ACT_IS_DPD_RATIO", "BUREAU_IS_DPD"),
                     ("BUREAU_ACT_IS_DPD_OVER120_RATIO", "BUREAU_IS_DPD_OVER120")):
        items.append(f"CASE WHEN count(CASE WHEN {act} THEN 1 END) > 0 THEN "
                     f"sum(CASE WHEN {act} THEN {fl} END)::DOUBLE / count(SK_ID_BUREAU) END AS {name}")
    bi, bn = spec_sql(S.BUREAU_BAL_SPEC, S.BUREAU_BAL_PREFIX,
                      int_cols={"MONTHS_BALANCE", "BUREAU_BAL_IS_DPD", "BUREAU_BAL_IS_DPD_OVER120"})
    # pandas sums an empty-free group; the all-NULL case cannot occur after the inner join
    bal = (f"SELECT SK_ID_CURR, {', '.join(bi)} FROM bbc GROUP BY SK_ID_CURR")
    body = (with_fixtures("bureau", "bureau_bal",
                          extra={"b": BUREAU_PROC, "bbc": BB_CUST,
                                 "agg": f"SELECT SK_ID_CURR, {', '.join(items)} FROM b GROUP BY SK_ID_CURR",
                                 "bal": bal})
            + "SELECT agg.*, bal.* EXCLUDE (SK_ID_CURR) FROM agg LEFT JOIN bal USING (SK_ID_CURR)")
    return body, ["SK_ID_CURR"] + names_of(items) + names_of(bi), ints | bn | {"SK_ID_CURR"}


def _tiers(col: str, name: str) -> str:
    return (f"(CASE WHEN {col} > 0 THEN 1 ELSE 0 END)::INTEGER AS {name}_IS_DPD, "
            f"(CASE WHEN {col} > 0 AND {col} < 120 THEN 1 ELSE 0 END)::INTEGER AS {name}_IS_DPD_UNDER_120, "
            f"(CASE WHEN {col} >= 120 THEN 1 ELSE 0 END)::INTEGER AS {name}_IS_DPD_OVER_120")


def _two_window(fixture: str, proc: str, spec: dict, prefix: str, rprefix: str, cond: str,
                int_cols: set[str]) -> tuple[str, list[str], set[str]]:
    items, ints = spec_sql(spec, prefix, int_cols=int_cols)
    i2, n2 = spec_sql(spec, rprefix, cond, int_cols)
    items += i2
    ints |= n2
    body = (with_fixtures(fixture, extra={"r": proc})
            + f"SELECT SK_ID_CURR, {', '.join(items)} FROM r GROUP BY SK_ID_CURR")
    return body, ["SK_ID_CURR"] + names_of(items), ints | {"SK_ID_CURR"}


def pos_block_sql():
    proc = f"SELECT *, {_tiers('SK_DPD', 'POS')} FROM pos"
    ints = {"MONTHS_BALANCE", "SK_DPD", "POS_IS_DPD", "POS_IS_DPD_UNDER_120", "POS_IS_DPD_OVER_120"}
    return _two_window("pos", proc, S.POS_SPEC, S.POS_PREFIX, S.POS_RECENT_PREFIX,
                       f"MONTHS_BALANCE > {S.POS_RECENT_MONTHS}", ints)


def ins_block_sql():
    proc = ("SELECT *, AMT_INSTALMENT - AMT_PAYMENT AS AMT_DIFF, "
            "(AMT_PAYMENT + 1) / (AMT_INSTALMENT + 1) AS AMT_RATIO, "
            "DAYS_ENTRY_PAYMENT - DAYS_INSTALMENT AS SK_DPD FROM ins")
    proc = f"SELECT *, {_tiers('SK_DPD', 'INS')} FROM ({proc}) x"
    ints = {"INS_IS_DPD", "INS_IS_DPD_UNDER_120", "INS_IS_DPD_OVER_120"}
    return _two_window("ins", proc, S.INS_SPEC, S.INS_PREFIX, S.INS_RECENT_PREFIX,
                       f"DAYS_ENTRY_PAYMENT >= {S.INS_RECENT_DAYS}", ints)


def card_block_sql():
    proc = (f"SELECT *, {_div('AMT_BALANCE', 'AMT_CREDIT_LIMIT_ACTUAL')} AS BALANCE_LIMIT_RATIO, "
            f"{_div('AMT_DRAWINGS_CURRENT', 'AMT_CREDIT_LIMIT_ACTUAL')} AS DRAWING_LIMIT_RATIO, "
            f"{_tiers('SK_DPD', 'CARD')} FROM card")
    ints = {"MONTHS_BALANCE", "SK_DPD", "CARD_IS_DPD", "CARD_IS_DPD_UNDER_120", "CARD_IS_DPD_OVER_120"}
    return _two_window("card", proc, S.CARD_SPEC, S.CARD_PREFIX, S.CARD_RECENT_PREFIX,
                       f"MONTHS_BALANCE >= {S.CARD_RECENT_MONTHS}", ints)


def canon_block(fn) -> str:
    body, cols, ints = fn()
    return canon(body, cols, ints)


def assembly_columns() -> list[str]:
    cols = ["SK_ID_CURR", "split", "TARGET"]
    for fn in (bureau_block_sql, prev_block_sql, pos_block_sql, ins_block_sql, card_block_sql):
        cols += [x for x in fn()[1] if x != "SK_ID_CURR"]
    return cols


def assembly_sql() -> str:
    """Q6: base (id, split, TARGET) left-joined with the five blocks."""
    parts, cols, ints = [], ["SK_ID_CURR", "split", "TARGET"], {"SK_ID_CURR", "TARGET"}
    ctes = []
    for i, fn in enumerate((bureau_block_sql, prev_block_sql, pos_block_sql, ins_block_sql, card_block_sql)):
        body, c, n = fn()
        ctes.append((f"blk{i}", body))
        cols += [x for x in c if x != "SK_ID_CURR"]
        ints |= n
    # Each block body starts with its own WITH; wrap as subqueries.
    joins = " ".join(f"LEFT JOIN ({b}) blk{i} USING (SK_ID_CURR)" for i, (_, b) in enumerate(ctes))
    inner = (with_fixtures("app") + f"SELECT * FROM (SELECT SK_ID_CURR, split, TARGET FROM app) base {joins}")
    return canon(inner, cols, ints, strings={"split"})
