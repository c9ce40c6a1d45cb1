"""Q1-Q6: customer-level feature blocks over the 1:N credit tables.

Every block is "derive row features -> ONE groupBy(customer).agg() with all
windows as conditional aggregates".  Blocks are keyed by the same column, so the
final left-join chain reuses their hash partitioning (no extra exchange per
block).  Each function takes DataFrames in the reference schema and returns
one row per customer present in the child table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import flag, ieee_div, sentinel_to_null
from ..operators.aggspec import Window, aggregate, by_key, spec_columns
from . import specs as S

ID = "SK_ID_CURR"


# ---------------------------------------------------------------- Q1
def prev_processed(prev: DataFrame, zero: str = "null") -> DataFrame:
    """Row features of previous applications."""
    c = F.col
    df = prev.select(
        *[c(x) for x in prev.columns if x not in S.PREV_SENTINEL_COLS],
        *[sentinel_to_null(x).alias(x) for x in S.PREV_SENTINEL_COLS if x in prev.columns],
    )
    all_pay = c("AMT_ANNUITY") * c("CNT_PAYMENT")
    return df.select(
        "*",
        (c("AMT_APPLICATION") - c("AMT_CREDIT")).alias("PREV_CREDIT_DIFF"),
        (c("AMT_APPLICATION") - c("AMT_GOODS_PRICE")).alias("PREV_GOODS_DIFF"),
        ieee_div("AMT_CREDIT", "AMT_APPLICATION", zero).alias("PREV_CREDIT_APPL_RATIO"),
        ieee_div("AMT_GOODS_PRICE", "AMT_APPLICATION", zero).alias("PREV_GOODS_APPL_RATIO"),
        (c("DAYS_LAST_DUE_1ST_VERSION") - c("DAYS_LAST_DUE")).alias("PREV_DAYS_LAST_DUE_DIFF"),
        ieee_div(ieee_div(all_pay, "AMT_CREDIT", zero) - F.lit(1.0), "CNT_PAYMENT", zero)
        .alias("PREV_INTERESTS_RATE"),
    )


def prev_block(prev: DataFrame, zero: str = "null") -> DataFrame:
    """Q1 (F2-F5): 39 all-history + 39 last-365-day aggregates + refused/approved ratios."""
    df = prev_processed(by_key(prev, ID), zero)
    status = F.col("NAME_CONTRACT_STATUS")
    recent = Window(S.PREV_RECENT_PREFIX, f"DAYS_DECISION > {S.PREV_RECENT_DAYS}")
    cols = spec_columns(df, S.PREV_SPEC, S.PREV_PREFIX)
    cols += spec_columns(df, S.PREV_SPEC, recent.prefix, recent.cond)
    # status counts pivoted to columns via conditional counts (explicit values,
    # so an absent status is a 0 column, never a failure).
    n_status = F.count(F.when(status.isin(S.PREV_APPROVED, S.PREV_REFUSED), F.lit(1)))
    n_all = F.count(F.col(ID))
    for name, value in (("PREV_REFUSED_RATIO", S.PREV_REFUSED),
                        ("PREV_APPROVED_RATIO", S.PREV_APPROVED)):
        k = F.count(F.when(status == value, F.lit(1)))
        cols.append(F.when(n_status > 0, k / n_all).alias(name))
    return df.groupBy(ID).agg(*cols)


# ---------------------------------------------------------------- Q2
def bureau_processed(bureau: DataFrame, zero: str = "null") -> DataFrame:
    """Bureau row features."""
    c = F.col
    return bureau.select(
        "*",
        (c("DAYS_CREDIT_ENDDATE") - c("DAYS_ENDDATE_FACT")).alias("BUREAU_ENDDATE_FACT_DIFF"),
        (c("DAYS_CREDIT") - c("DAYS_ENDDATE_FACT")).alias("BUREAU_CREDIT_FACT_DIFF"),
        (c("DAYS_CREDIT") - c("DAYS_CREDIT_ENDDATE")).alias("BUREAU_CREDIT_ENDDATE_DIFF"),
        ieee_div("AMT_CREDIT_SUM_DEBT", "AMT_CREDIT_SUM", zero).alias("BUREAU_CREDIT_DEBT_RATIO"),
        (c("AMT_CREDIT_SUM_DEBT") - c("AMT_CREDIT_SUM")).alias("BUREAU_CREDIT_DEBT_DIFF"),
        flag(c("CREDIT_DAY_OVERDUE") > 0).alias("BUREAU_IS_DPD"),
        flag(c("CREDIT_DAY_OVERDUE") > S.BUREAU_DPD_SEVERE).alias("BUREAU_IS_DPD_OVER120"),
    )


def bureau_balance_partials(bureau_bal: DataFrame) -> DataFrame:
    """B20 + map-side pre-aggregation of the monthly table per bureau loan.

    The monthly table is the largest input; reducing it to one row per loan
    before the two-hop join means the join and the customer aggregation see
    loans, not months.
    """
    st = F.col("STATUS")
    m = F.col("MONTHS_BALANCE")
    return bureau_bal.groupBy("SK_ID_BUREAU").agg(
        F.count(F.lit(1)).alias("_bb_rows"),
        F.count(m).alias("_bb_m_n"),
        F.sum(m).alias("_bb_m_sum"),
        F.min(m).alias("_bb_m_min"),
        F.max(m).alias("_bb_m_max"),
        F.sum(flag(st.isin(*S.BUREAU_BAL_DPD_STATUSES))).alias("_bb_dpd"),
        F.sum(flag(st == S.BUREAU_BAL_SEVERE_STATUS)).alias("_bb_dpd120"),
    )


def bureau_block(bureau: DataFrame, bureau_bal: DataFrame, zero: str = "null") -> DataFrame:
    """Q2 (F6-F10, E3): 46 x 3 window aggregates + 8 monthly + 2 active-DPD ratios.

    One join (loan partials onto loans, E3) and ONE customer aggregation that
    computes all-history, active-only and last-750-day windows plus the monthly
    features.  Loans without monthly rows contribute NULL partials, and
    monthly rows whose loan is unknown are dropped by the join, as the
    reference's groupby drops missing keys.
    """
    bb = bureau_balance_partials(bureau_bal)
    j = bureau_processed(by_key(bureau.join(bb, "SK_ID_BUREAU", "left"), ID), zero)
    active = F.col("CREDIT_ACTIVE") == S.BUREAU_ACTIVE
    active_sql = f"CREDIT_ACTIVE = '{S.BUREAU_ACTIVE}'"
    recent_sql = f"DAYS_CREDIT > {S.BUREAU_RECENT_DAYS}"
    cols = spec_columns(j, S.BUREAU_SPEC, S.BUREAU_PREFIX)
    cols += spec_columns(j, S.BUREAU_SPEC, S.BUREAU_ACTIVE_PREFIX, active_sql)
    cols += spec_columns(j, S.BUREAU_SPEC, S.BUREAU_RECENT_PREFIX, recent_sql)
    # active DPD counts over the all-history loan count (NULL without active loans).
    n_loans = F.count(F.col("SK_ID_BUREAU"))
    any_active = F.count(F.when(active, F.lit(1))) > 0
    for name, fl in (("BUREAU_ACT_IS_DPD_RATIO", "BUREAU_IS_DPD"),
                     ("BUREAU_ACT_IS_DPD_OVER120_RATIO", "BUREAU_IS_DPD_OVER120")):
        cols.append(F.when(any_active, F.sum(F.when(active, F.col(fl))) / n_loans).alias(name))
    # monthly features re-aggregated from the loan partials.
    rows = F.sum("_bb_rows")
    p = S.BUREAU_BAL_PREFIX
    cols += [
        rows.alias(f"{p}SK_ID_CURR_COUNT"),
        F.min("_bb_m_min").alias(f"{p}MONTHS_BALANCE_MIN"),
        F.max("_bb_m_max").alias(f"{p}MONTHS_BALANCE_MAX"),
        (F.sum("_bb_m_sum") / F.sum("_bb_m_n")).alias(f"{p}MONTHS_BALANCE_MEAN"),
        (F.sum("_bb_dpd") / rows).alias(f"{p}BUREAU_BAL_IS_DPD_MEAN"),
        F.sum("_bb_dpd").alias(f"{p}BUREAU_BAL_IS_DPD_SUM"),
        (F.sum("_bb_dpd120") / rows).alias(f"{p}BUREAU_BAL_IS_DPD_OVER120_MEAN"),
        F.sum("_bb_dpd120").alias(f"{p}BUREAU_BAL_IS_DPD_OVER120_SUM"),
    ]
    return j.groupBy(ID).agg(*cols)


# ---------------------------------------------------------------- Q3-Q5
def _dpd_tiers(dpd, name: str) -> list:
    return [
        flag(dpd > 0).alias(f"{name}_IS_DPD"),
        flag((dpd > 0) & (dpd < S.DPD_SEVERE)).alias(f"{name}_IS_DPD_UNDER_120"),
        flag(dpd >= S.DPD_SEVERE).alias(f"{name}_IS_DPD_OVER_120"),
    ]


def pos_block(pos: DataFrame) -> DataFrame:
    """Q3 (F11): 22 all-history + 22 last-24-month aggregates."""
    df = by_key(pos, ID).select("*", *_dpd_tiers(F.col("SK_DPD"), "POS"))
    w = Window(S.POS_RECENT_PREFIX, f"MONTHS_BALANCE > {S.POS_RECENT_MONTHS}")
    return aggregate(df, ID, S.POS_SPEC, S.POS_PREFIX, [w])


def installments_block(ins: DataFrame) -> DataFrame:
    """Q4 (F12): 29 all-history + 29 last-365-day aggregates (incl. nunique)."""
    c = F.col
    df = by_key(ins, ID, "NUM_INSTALMENT_VERSION").select(
        "*",
        (c("AMT_INSTALMENT") - c("AMT_PAYMENT")).alias("AMT_DIFF"),
        ((c("AMT_PAYMENT") + 1) / (c("AMT_INSTALMENT") + 1)).alias("AMT_RATIO"),
        (c("DAYS_ENTRY_PAYMENT") - c("DAYS_INSTALMENT")).alias("SK_DPD"),
    )
    df = df.select("*", *_dpd_tiers(F.col("SK_DPD"), "INS"))
    w = Window(S.INS_RECENT_PREFIX, f"DAYS_ENTRY_PAYMENT >= {S.INS_RECENT_DAYS}")
    return aggregate(df, ID, S.INS_SPEC, S.INS_PREFIX, [w])


def card_block(card: DataFrame, zero: str = "null") -> DataFrame:
    """Q5 (F13): 34 all-history + 34 last-3-month aggregates."""
    df = by_key(card, ID).select(
        "*",
        ieee_div("AMT_BALANCE", "AMT_CREDIT_LIMIT_ACTUAL", zero).alias("BALANCE_LIMIT_RATIO"),
        ieee_div("AMT_DRAWINGS_CURRENT", "AMT_CREDIT_LIMIT_ACTUAL", zero).alias("DRAWING_LIMIT_RATIO"),
    )
    df = df.select("*", *_dpd_tiers(F.col("SK_DPD"), "CARD"))
    w = Window(S.CARD_RECENT_PREFIX, f"MONTHS_BALANCE >= {S.CARD_RECENT_MONTHS}")
    return aggregate(df, ID, S.CARD_SPEC, S.CARD_PREFIX, [w])


# ---------------------------------------------------------------- Q6
def prune_by_prefix(df: DataFrame, prefixes: Sequence[str] = S.BLOCK_PREFIXES,
                    keep: Sequence[str] = (ID, "TARGET", "split")) -> DataFrame:
    """Keep key/label columns and columns starting with one of the prefixes."""
    cols = [c for c in df.columns if c in keep or any(c.startswith(p) for p in prefixes)]
    return df.select(*cols)


def assemble(base: DataFrame, blocks: Sequence[DataFrame]) -> DataFrame:
    """Q6 (E1, E2): minimal base (id, split, TARGET) left-joined with every block.

    Train and test travel together with a ``split`` column, so the chain is
    built once.  All blocks are grouped by the same key; with equal shuffle
    partition counts the joins reuse that hash partitioning.
    """
    out = base
    for b in blocks:
        out = out.join(b, ID, "left")
    return prune_by_prefix(out)


def all_blocks(prev, bureau, bureau_bal, pos, ins, card, zero: str = "null") -> list[DataFrame]:
    return [bureau_block(bureau, bureau_bal, zero), prev_block(prev, zero), pos_block(pos),
            installments_block(ins), card_block(card, zero)]
