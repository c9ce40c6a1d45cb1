"""DuckDB views that bind the given tables to the credit schemas.

Same mapping as ``riskloom.sources.fixtures``, written independently in SQL.
Each constant is a CTE body; ``with_fixtures(names)`` builds a WITH clause.
"""

APPLICATION = """
SELECT c.c_custkey AS SK_ID_CURR,
  CASE WHEN c.c_custkey % 5 = 0 THEN 'test' ELSE 'train' END AS split,
  CASE WHEN c.c_custkey % 5 = 0 THEN NULL
       WHEN (c.c_acctbal < 1000 AND c.c_custkey % 3 = 0) OR c.c_custkey % 23 = 0 THEN 1 ELSE 0 END::INTEGER AS TARGET,
  c.c_acctbal AS AMT_INCOME_TOTAL,
  abs(c.c_acctbal) * 3 + 5000.0::DOUBLE + (c.c_custkey % 13)::DOUBLE * 250.0::DOUBLE AS AMT_CREDIT,
  CASE WHEN c.c_custkey % 41 <> 0 THEN (abs(c.c_acctbal) * 3 + 5000.0::DOUBLE + (c.c_custkey % 13)::DOUBLE * 250.0::DOUBLE)
        / (12.0::DOUBLE + (c.c_custkey % 48)::DOUBLE) * 1.1::DOUBLE END AS AMT_ANNUITY,
  CASE WHEN c.c_mktsegment <> 'BUILDING' THEN (abs(c.c_acctbal) * 3 + 5000.0::DOUBLE + (c.c_custkey % 13)::DOUBLE * 250.0::DOUBLE) * 0.9::DOUBLE END AS AMT_GOODS_PRICE,
  (c.c_custkey % 5)::DOUBLE AS CNT_FAM_MEMBERS,
  (c.c_custkey % 4)::INTEGER AS CNT_CHILDREN,
  CASE WHEN c.c_custkey % 3 = 0 THEN (c.c_custkey % 20)::DOUBLE END AS OWN_CAR_AGE,
  CASE WHEN c.c_custkey % 3 <> 0 THEN (c.c_acctbal + 1000.0::DOUBLE) / 11000.0::DOUBLE END AS EXT_SOURCE_1,
  ((c.c_custkey * 7919) % 1000)::DOUBLE / 1000.0::DOUBLE AS EXT_SOURCE_2,
  CASE WHEN c.c_nationkey % 4 <> 0 THEN (c.c_nationkey + 1)::DOUBLE / 26.0::DOUBLE END AS EXT_SOURCE_3,
  (-(7000 + (c.c_custkey * 37) % 18000))::INTEGER AS DAYS_BIRTH,
  (CASE WHEN c.c_custkey % 17 = 0 THEN 365243 ELSE -((c.c_custkey * 13) % 5000) END)::INTEGER AS DAYS_EMPLOYED,
  ((n.n_regionkey % 3) + 1)::INTEGER AS REGION_RATING_CLIENT,
  ((c.c_nationkey % 3) + 1)::INTEGER AS REGION_RATING_CLIENT_W_CITY,
  (c.c_custkey % 7 = 0)::INTEGER AS REG_REGION_NOT_LIVE_REGION,
  (c.c_custkey % 11 = 0)::INTEGER AS REG_REGION_NOT_WORK_REGION,
  (c.c_custkey % 13 = 0)::INTEGER AS LIVE_REGION_NOT_WORK_REGION,
  (c.c_custkey % 5 = 1)::INTEGER AS REG_CITY_NOT_LIVE_CITY,
  (c.c_custkey % 3 = 1)::INTEGER AS REG_CITY_NOT_WORK_CITY,
  (c.c_custkey % 9 = 2)::INTEGER AS LIVE_CITY_NOT_WORK_CITY,
  (c.c_custkey % 6 = 0)::INTEGER AS FLAG_DOCUMENT_2,
  (c.c_custkey % 6 = 1)::INTEGER AS FLAG_DOCUMENT_3,
  (c.c_custkey % 10 = 3)::INTEGER AS FLAG_DOCUMENT_4,
  1::INTEGER AS FLAG_MOBIL,
  (c.c_custkey % 4 <> 0)::INTEGER AS FLAG_EMP_PHONE,
  (c.c_custkey % 5 = 2)::INTEGER AS FLAG_WORK_PHONE,
  (c.c_custkey % 19 <> 0)::INTEGER AS FLAG_CONT_MOBILE,
  (c.c_custkey % 3 = 2)::INTEGER AS FLAG_PHONE,
  (c.c_custkey % 8 = 0)::INTEGER AS FLAG_EMAIL,
  c.c_mktsegment AS NAME_EDUCATION_TYPE,
  r.r_name AS NAME_HOUSING_TYPE,
  CASE WHEN c.c_acctbal < 0 THEN 'Unemployed' WHEN c.c_acctbal < 3000 THEN 'Working' ELSE 'Pensioner' END AS NAME_INCOME_TYPE,
  CASE WHEN c.c_custkey % 9 = 0 THEN NULL WHEN c.c_custkey % 2 = 0 THEN 'Family' ELSE 'Unaccompanied' END AS NAME_TYPE_SUITE
FROM customer c
LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
"""

PREV = """
SELECT o_orderkey AS SK_ID_PREV, o_custkey AS SK_ID_CURR,
  o_totalprice * (1.0::DOUBLE + (o_custkey % 3)::DOUBLE * 0.1::DOUBLE) AS AMT_APPLICATION,
  o_totalprice AS AMT_CREDIT,
  o_totalprice * (1.0::DOUBLE + (o_orderkey % 4)::DOUBLE * 0.05::DOUBLE) / ((o_orderkey % 5) * 6 + 6)::DOUBLE AS AMT_ANNUITY,
  CASE WHEN o_orderpriority <> '5-LOW' THEN o_totalprice * 0.9::DOUBLE END AS AMT_GOODS_PRICE,
  o_totalprice * (1.0::DOUBLE + (o_custkey % 3)::DOUBLE * 0.1::DOUBLE) - o_totalprice AS AMT_DOWN_PAYMENT,
  (o_totalprice * (1.0::DOUBLE + (o_custkey % 3)::DOUBLE * 0.1::DOUBLE) - o_totalprice)
     / (o_totalprice * (1.0::DOUBLE + (o_custkey % 3)::DOUBLE * 0.1::DOUBLE)) AS RATE_DOWN_PAYMENT,
  ((o_orderkey % 5) * 6 + 6)::DOUBLE AS CNT_PAYMENT,
  (CAST(o_orderdate AS DATE) - DATE '2001-08-02')::DOUBLE AS DAYS_DECISION,
  CASE WHEN o_orderstatus = 'O' THEN 365243.0::DOUBLE ELSE (CAST(o_orderdate AS DATE) - DATE '2001-08-02' + 10)::DOUBLE END AS DAYS_FIRST_DRAWING,
  CASE WHEN o_orderpriority = '1-URGENT' THEN 365243.0::DOUBLE ELSE (CAST(o_orderdate AS DATE) - DATE '2001-08-02' + 30)::DOUBLE END AS DAYS_FIRST_DUE,
  (CAST(o_orderdate AS DATE) - DATE '2001-08-02')::DOUBLE + ((o_orderkey % 5) * 6 + 6)::DOUBLE * 30 AS DAYS_LAST_DUE_1ST_VERSION,
  CASE WHEN o_orderstatus = 'F' THEN (CAST(o_orderdate AS DATE) - DATE '2001-08-02')::DOUBLE + ((o_orderkey % 5) * 6 + 6)::DOUBLE * 30 - (o_orderkey % 11)::DOUBLE * 10
       ELSE 365243.0::DOUBLE END AS DAYS_LAST_DUE,
  CASE WHEN o_orderstatus = 'F' THEN (CAST(o_orderdate AS DATE) - DATE '2001-08-02')::DOUBLE + ((o_orderkey % 5) * 6 + 6)::DOUBLE * 30 - (o_orderkey % 11)::DOUBLE * 10 + 5
       ELSE 365243.0::DOUBLE END AS DAYS_TERMINATION,
  CASE o_orderstatus WHEN 'P' THEN 'Approved' WHEN 'F' THEN 'Refused' ELSE 'Canceled' END AS NAME_CONTRACT_STATUS
FROM orders
"""

BUREAU = """
SELECT o_orderkey AS SK_ID_BUREAU, o_custkey AS SK_ID_CURR,
  (CAST(o_orderdate AS DATE) - DATE '2001-08-02')::INTEGER AS DAYS_CREDIT,
  (CASE WHEN o_orderstatus = 'F' THEN o_orderkey % 181 ELSE 0 END)::INTEGER AS CREDIT_DAY_OVERDUE,
  (CAST(o_orderdate AS DATE) - DATE '2001-08-02' + 365)::DOUBLE AS DAYS_CREDIT_ENDDATE,
  CASE WHEN o_orderstatus <> 'O' THEN (CAST(o_orderdate AS DATE) - DATE '2001-08-02' + 300 + o_orderkey % 100)::DOUBLE END AS DAYS_ENDDATE_FACT,
  CASE WHEN o_orderstatus = 'F' AND o_orderkey % 181 > 0 THEN o_totalprice * 0.1::DOUBLE END AS AMT_CREDIT_MAX_OVERDUE,
  o_totalprice AS AMT_CREDIT_SUM,
  o_totalprice * (o_orderkey % 10)::DOUBLE / 10.0::DOUBLE AS AMT_CREDIT_SUM_DEBT,
  CASE WHEN o_orderstatus = 'F' AND o_orderkey % 181 > 0 THEN o_totalprice * 0.05::DOUBLE ELSE 0.0::DOUBLE END AS AMT_CREDIT_SUM_OVERDUE,
  CASE WHEN o_orderpriority <> '2-HIGH' THEN o_totalprice / 12.0::DOUBLE END AS AMT_ANNUITY,
  CASE WHEN o_orderstatus = 'O' THEN 'Active' ELSE 'Closed' END AS CREDIT_ACTIVE
FROM orders
"""

BUREAU_BAL = """
SELECT l_orderkey AS SK_ID_BUREAU,
  floor((CAST(l_shipdate AS DATE) - DATE '2001-08-02') / 30)::INTEGER AS MONTHS_BALANCE,
  CASE WHEN l_returnflag = 'R' THEN CAST(l_linenumber % 6 AS VARCHAR)
       WHEN l_returnflag = 'A' THEN 'C' ELSE 'X' END AS STATUS
FROM lineitem
"""

INSTALLMENTS = """
SELECT l.l_orderkey AS SK_ID_PREV, o.o_custkey AS SK_ID_CURR,
  l.l_linenumber::DOUBLE AS NUM_INSTALMENT_VERSION,
  (CAST(o.o_orderdate AS DATE) - DATE '2001-08-02')::DOUBLE AS DAYS_INSTALMENT,
  (CAST(l.l_shipdate AS DATE) - DATE '2001-08-02')::DOUBLE AS DAYS_ENTRY_PAYMENT,
  l.l_extendedprice AS AMT_INSTALMENT,
  l.l_extendedprice * (1.0::DOUBLE - l.l_discount) AS AMT_PAYMENT
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
"""

POS = """
SELECT event_id AS SK_ID_PREV, user_id AS SK_ID_CURR,
  (CAST(ts AS DATE) - DATE '2024-01-31')::INTEGER AS MONTHS_BALANCE,
  (CASE WHEN event_type = 'error' THEN floor(value) ELSE 0 END)::INTEGER AS SK_DPD,
  CASE WHEN event_type <> 'view' THEN floor(value / 10.0::DOUBLE) END::DOUBLE AS CNT_INSTALMENT,
  floor(value / 20.0::DOUBLE)::DOUBLE AS CNT_INSTALMENT_FUTURE
FROM events
"""

CARD = """
SELECT event_id AS SK_ID_PREV, user_id AS SK_ID_CURR,
  floor((CAST(ts AS DATE) - DATE '2024-01-31') / 7)::INTEGER AS MONTHS_BALANCE,
  (CASE WHEN event_type = 'error' THEN floor(value) ELSE 0 END)::INTEGER AS SK_DPD,
  value AS AMT_BALANCE,
  CASE WHEN event_type = 'signup' THEN 0.0::DOUBLE ELSE ((user_id % 5) + 1)::DOUBLE * 100.0::DOUBLE END AS AMT_CREDIT_LIMIT_ACTUAL,
  CASE WHEN event_type = 'click' THEN value ELSE 0.0::DOUBLE END AS AMT_DRAWINGS_ATM_CURRENT,
  CASE WHEN event_type IN ('click', 'purchase') THEN value ELSE 0.0::DOUBLE END AS AMT_DRAWINGS_CURRENT,
  CASE WHEN event_type = 'purchase' THEN value ELSE 0.0::DOUBLE END AS AMT_DRAWINGS_POS_CURRENT,
  CASE WHEN event_type <> 'view' THEN value * 0.1::DOUBLE END AS AMT_INST_MIN_REGULARITY,
  CASE WHEN event_type = 'purchase' THEN value END AS AMT_PAYMENT_TOTAL_CURRENT,
  value * 2.0::DOUBLE AS AMT_TOTAL_RECEIVABLE,
  (event_type = 'click')::DOUBLE AS CNT_DRAWINGS_ATM_CURRENT,
  (event_type IN ('click', 'purchase'))::DOUBLE AS CNT_DRAWINGS_CURRENT,
  (event_type = 'purchase')::DOUBLE AS CNT_DRAWINGS_POS_CURRENT
FROM events
"""

FIXTURES = {
    "app": APPLICATION, "prev": PREV, "bureau": BUREAU, "bureau_bal": BUREAU_BAL,
    "ins": INSTALLMENTS, "pos": POS, "card": CARD,
}


def with_fixtures(*names: str, extra: dict[str, str] | None = None) -> str:
    parts = [f"{n} AS ({FIXTURES[n]})" for n in names]
    for k, v in (extra or {}).items():
        parts.append(f"{k} AS ({v})")
    return "WITH " + ",\n".join(parts) + "\n"

PREDS = """
SELECT c_custkey AS id, 'm1' AS model, (c_acctbal + 1000.0::DOUBLE) / 11000.0::DOUBLE AS pred FROM customer
UNION ALL SELECT c_custkey, 'm2', ((c_custkey * 7919) % 1000)::DOUBLE / 1000.0::DOUBLE FROM customer WHERE c_custkey % 50 <> 0
UNION ALL SELECT c_custkey, 'm3', (c_nationkey + 1)::DOUBLE / 26.0::DOUBLE FROM customer
UNION ALL SELECT c_custkey, 'm4', 1.0::DOUBLE - (c_acctbal + 1000.0::DOUBLE) / 11000.0::DOUBLE FROM customer
"""
FIXTURES["preds"] = PREDS
