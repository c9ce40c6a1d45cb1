"""Bindings of the given parquet tables to the reference's credit schemas.

The reference reads seven credit CSVs that are not available here.  These
functions derive frames with the same column names and types from the given
TPC-H-like tables, by deterministic projections (and one join), so every
feature operator runs on data that grows with the inputs.  Only this module and
the entry file know the fixture table names.

Mapping:
  application           <- customer (+ nation, region)      1 row / customer
  previous_application  <- orders                           N / customer
  bureau                <- orders                           N / customer
  bureau_balance        <- lineitem (keyed by its order)    N / bureau loan
  installments_payments <- lineitem JOIN orders             N / customer
  POS_CASH_balance      <- events (user_id as customer)     N / customer
  credit_card_balance   <- events                           N / customer
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import spread
from .tables import read_table

# Reference "application day": relative day counts are datediff(date, ref) < 0.
ORDERS_REF_DATE = "2001-08-02"
EVENTS_REF_DATE = "2024-01-31"


def _days(ts_col: str, ref: str):
    return F.datediff(F.col(ts_col).cast("date"), F.lit(ref).cast("date"))


def application(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer -> application_train/test (split column, TARGET on train rows only)."""
    # few bytes a customer, but many features and model fits: not a task per file split, but work for every core
    cu = spread(read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment"), "c_custkey")
    na = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    rg = read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    # nation (25 rows) and region (5 rows) are fixed-size dimensions: broadcast is bounded.
    df = (cu.join(F.broadcast(na), cu.c_nationkey == na.n_nationkey, "left")
            .join(F.broadcast(rg), F.col("n_regionkey") == rg.r_regionkey, "left"))
    k = F.col("c_custkey")
    bal = F.col("c_acctbal")
    credit = F.abs(bal) * 3 + F.lit(5000.0) + (k % 13).cast("double") * 250.0
    is_test = (k % 5) == 0
    target = F.when(((bal < 1000) & ((k % 3) == 0)) | ((k % 23) == 0), 1).otherwise(0)
    return df.select(
        k.alias("SK_ID_CURR"),
        F.when(is_test, F.lit("test")).otherwise(F.lit("train")).alias("split"),
        F.when(~is_test, target).cast("int").alias("TARGET"),
        bal.alias("AMT_INCOME_TOTAL"),
        credit.alias("AMT_CREDIT"),
        F.when((k % 41) != 0, credit / (F.lit(12.0) + (k % 48).cast("double")) * 1.1).alias("AMT_ANNUITY"),
        F.when(F.col("c_mktsegment") != "BUILDING", credit * 0.9).alias("AMT_GOODS_PRICE"),
        (k % 5).cast("double").alias("CNT_FAM_MEMBERS"),
        (k % 4).cast("int").alias("CNT_CHILDREN"),
        F.when((k % 3) == 0, (k % 20).cast("double")).alias("OWN_CAR_AGE"),
        F.when((k % 3) != 0, (bal + 1000.0) / 11000.0).alias("EXT_SOURCE_1"),
        ((k * 7919) % 1000 / 1000.0).alias("EXT_SOURCE_2"),
        F.when((F.col("c_nationkey") % 4) != 0, (F.col("c_nationkey") + 1) / 26.0).alias("EXT_SOURCE_3"),
        (-(F.lit(7000) + (k * 37) % 18000)).cast("int").alias("DAYS_BIRTH"),
        F.when((k % 17) == 0, F.lit(365243)).otherwise(-((k * 13) % 5000)).cast("int").alias("DAYS_EMPLOYED"),
        ((F.col("n_regionkey") % 3) + 1).cast("int").alias("REGION_RATING_CLIENT"),
        ((F.col("c_nationkey") % 3) + 1).cast("int").alias("REGION_RATING_CLIENT_W_CITY"),
        ((k % 7) == 0).cast("int").alias("REG_REGION_NOT_LIVE_REGION"),
        ((k % 11) == 0).cast("int").alias("REG_REGION_NOT_WORK_REGION"),
        ((k % 13) == 0).cast("int").alias("LIVE_REGION_NOT_WORK_REGION"),
        ((k % 5) == 1).cast("int").alias("REG_CITY_NOT_LIVE_CITY"),
        ((k % 3) == 1).cast("int").alias("REG_CITY_NOT_WORK_CITY"),
        ((k % 9) == 2).cast("int").alias("LIVE_CITY_NOT_WORK_CITY"),
        ((k % 6) == 0).cast("int").alias("FLAG_DOCUMENT_2"),
        ((k % 6) == 1).cast("int").alias("FLAG_DOCUMENT_3"),
        ((k % 10) == 3).cast("int").alias("FLAG_DOCUMENT_4"),
        F.lit(1).alias("FLAG_MOBIL"),
        ((k % 4) != 0).cast("int").alias("FLAG_EMP_PHONE"),
        ((k % 5) == 2).cast("int").alias("FLAG_WORK_PHONE"),
        ((k % 19) != 0).cast("int").alias("FLAG_CONT_MOBILE"),
        ((k % 3) == 2).cast("int").alias("FLAG_PHONE"),
        ((k % 8) == 0).cast("int").alias("FLAG_EMAIL"),
        F.col("c_mktsegment").alias("NAME_EDUCATION_TYPE"),
        F.col("r_name").alias("NAME_HOUSING_TYPE"),
        F.when(bal < 0, "Unemployed").when(bal < 3000, "Working").otherwise("Pensioner")
        .alias("NAME_INCOME_TYPE"),
        F.when((k % 9) == 0, F.lit(None).cast("string")).when((k % 2) == 0, "Family")
        .otherwise("Unaccompanied").alias("NAME_TYPE_SUITE"),
    )


def previous_application(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders")
    ok = F.col("o_orderkey")
    price = F.col("o_totalprice")
    dd = _days("o_orderdate", ORDERS_REF_DATE)
    cnt = ((ok % 5) * 6 + 6).cast("double")
    appl = price * (F.lit(1.0) + (F.col("o_custkey") % 3).cast("double") * 0.1)
    status = F.col("o_orderstatus")
    return o.select(
        ok.alias("SK_ID_PREV"),
        F.col("o_custkey").alias("SK_ID_CURR"),
        appl.alias("AMT_APPLICATION"),
        price.alias("AMT_CREDIT"),
        (price * (F.lit(1.0) + (ok % 4).cast("double") * 0.05) / cnt).alias("AMT_ANNUITY"),
        F.when(F.col("o_orderpriority") != "5-LOW", price * 0.9).alias("AMT_GOODS_PRICE"),
        (appl - price).alias("AMT_DOWN_PAYMENT"),
        ((appl - price) / appl).alias("RATE_DOWN_PAYMENT"),
        cnt.alias("CNT_PAYMENT"),
        dd.cast("double").alias("DAYS_DECISION"),
        F.when(status == "O", F.lit(365243.0)).otherwise((dd + 10).cast("double")).alias("DAYS_FIRST_DRAWING"),
        F.when(F.col("o_orderpriority") == "1-URGENT", F.lit(365243.0))
        .otherwise((dd + 30).cast("double")).alias("DAYS_FIRST_DUE"),
        (dd + cnt * 30).alias("DAYS_LAST_DUE_1ST_VERSION"),
        F.when(status == "F", dd + cnt * 30 - (ok % 11).cast("double") * 10).otherwise(F.lit(365243.0))
        .alias("DAYS_LAST_DUE"),
        F.when(status == "F", dd + cnt * 30 - (ok % 11).cast("double") * 10 + 5).otherwise(F.lit(365243.0))
        .alias("DAYS_TERMINATION"),
        F.when(status == "P", "Approved").when(status == "F", "Refused").otherwise("Canceled")
        .alias("NAME_CONTRACT_STATUS"),
    )


def bureau(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders")
    ok = F.col("o_orderkey")
    price = F.col("o_totalprice")
    dc = _days("o_orderdate", ORDERS_REF_DATE)
    status = F.col("o_orderstatus")
    overdue = F.when(status == "F", (ok % 181)).otherwise(0).cast("int")
    return o.select(
        ok.alias("SK_ID_BUREAU"),
        F.col("o_custkey").alias("SK_ID_CURR"),
        dc.cast("int").alias("DAYS_CREDIT"),
        overdue.alias("CREDIT_DAY_OVERDUE"),
        (dc + 365).cast("double").alias("DAYS_CREDIT_ENDDATE"),
        F.when(status != "O", (dc + 300 + (ok % 100)).cast("double")).alias("DAYS_ENDDATE_FACT"),
        F.when(overdue > 0, price * 0.1).alias("AMT_CREDIT_MAX_OVERDUE"),
        price.alias("AMT_CREDIT_SUM"),
        (price * (ok % 10).cast("double") / 10.0).alias("AMT_CREDIT_SUM_DEBT"),
        F.when(overdue > 0, price * 0.05).otherwise(F.lit(0.0)).alias("AMT_CREDIT_SUM_OVERDUE"),
        F.when(F.col("o_orderpriority") != "2-HIGH", price / 12.0).alias("AMT_ANNUITY"),
        F.when(status == "O", "Active").otherwise("Closed").alias("CREDIT_ACTIVE"),
    )


def bureau_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem")
    flag = F.col("l_returnflag")
    return li.select(
        F.col("l_orderkey").alias("SK_ID_BUREAU"),
        F.floor(_days("l_shipdate", ORDERS_REF_DATE) / 30).cast("int").alias("MONTHS_BALANCE"),
        F.when(flag == "R", (F.col("l_linenumber") % 6).cast("string"))
        .when(flag == "A", F.lit("C")).otherwise(F.lit("X")).alias("STATUS"),
    )


def installments(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem")
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    # Both sides grow with the data: a shuffle (sort-merge) join on the order key.
    j = li.join(o, li.l_orderkey == o.o_orderkey, "inner")
    return j.select(
        F.col("l_orderkey").alias("SK_ID_PREV"),
        F.col("o_custkey").alias("SK_ID_CURR"),
        F.col("l_linenumber").cast("double").alias("NUM_INSTALMENT_VERSION"),
        _days("o_orderdate", ORDERS_REF_DATE).cast("double").alias("DAYS_INSTALMENT"),
        _days("l_shipdate", ORDERS_REF_DATE).cast("double").alias("DAYS_ENTRY_PAYMENT"),
        F.col("l_extendedprice").alias("AMT_INSTALMENT"),
        (F.col("l_extendedprice") * (F.lit(1.0) - F.col("l_discount"))).alias("AMT_PAYMENT"),
    )


def pos_cash(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_table(spark, sf_dir, "events")
    v = F.col("value")
    return ev.select(
        F.col("event_id").alias("SK_ID_PREV"),
        F.col("user_id").alias("SK_ID_CURR"),
        _days("ts", EVENTS_REF_DATE).cast("int").alias("MONTHS_BALANCE"),
        F.when(F.col("event_type") == "error", F.floor(v).cast("int")).otherwise(0).alias("SK_DPD"),
        F.when(F.col("event_type") != "view", F.floor(v / 10.0)).cast("double").alias("CNT_INSTALMENT"),
        F.floor(v / 20.0).cast("double").alias("CNT_INSTALMENT_FUTURE"),
    )


def credit_card(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_table(spark, sf_dir, "events")
    v = F.col("value")
    et = F.col("event_type")
    u = F.col("user_id")
    return ev.select(
        F.col("event_id").alias("SK_ID_PREV"),
        u.alias("SK_ID_CURR"),
        F.floor(_days("ts", EVENTS_REF_DATE) / 7).cast("int").alias("MONTHS_BALANCE"),
        F.when(et == "error", F.floor(v).cast("int")).otherwise(0).alias("SK_DPD"),
        v.alias("AMT_BALANCE"),
        F.when(et == "signup", F.lit(0.0)).otherwise(((u % 5) + 1).cast("double") * 100.0)
        .alias("AMT_CREDIT_LIMIT_ACTUAL"),
        F.when(et == "click", v).otherwise(F.lit(0.0)).alias("AMT_DRAWINGS_ATM_CURRENT"),
        F.when(et.isin("click", "purchase"), v).otherwise(F.lit(0.0)).alias("AMT_DRAWINGS_CURRENT"),
        F.when(et == "purchase", v).otherwise(F.lit(0.0)).alias("AMT_DRAWINGS_POS_CURRENT"),
        F.when(et != "view", v * 0.1).alias("AMT_INST_MIN_REGULARITY"),
        F.when(et == "purchase", v).alias("AMT_PAYMENT_TOTAL_CURRENT"),
        (v * 2.0).alias("AMT_TOTAL_RECEIVABLE"),
        (et == "click").cast("double").alias("CNT_DRAWINGS_ATM_CURRENT"),
        et.isin("click", "purchase").cast("double").alias("CNT_DRAWINGS_CURRENT"),
        (et == "purchase").cast("double").alias("CNT_DRAWINGS_POS_CURRENT"),
    )


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long prediction table (id, model, pred): four closed-form scores of customer columns.

    m2 is missing for ids divisible by 50, which exercises the outer-join-then-drop path.
    One scan of customer, exploded to one row per model.
    """
    cu = read_table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    m1 = (F.col("c_acctbal") + 1000.0) / 11000.0
    preds = F.array(
        F.struct(F.lit("m1").alias("model"), m1.alias("pred")),
        F.struct(F.lit("m2").alias("model"),
                 F.when((k % 50) != 0, ((k * 7919) % 1000) / 1000.0).alias("pred")),
        F.struct(F.lit("m3").alias("model"), ((F.col("c_nationkey") + 1) / 26.0).alias("pred")),
        F.struct(F.lit("m4").alias("model"), (F.lit(1.0) - m1).alias("pred")),
    )
    return (cu.select(k.alias("id"), F.explode(preds).alias("p"))
              .select("id", "p.model", "p.pred").where(F.col("pred").isNotNull()))
