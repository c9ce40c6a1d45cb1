"""Feature specs of the credit blocks.

Fixed values that must equal the reference's for right results: the column ->
aggregate lists and the literal name prefixes below are the feature contract
(398 block features).  They are stated as data, in the reference's order.
"""

# --- Fixed values: previous applications (all history and last 365 days) ---
PREV_SPEC = {
    "SK_ID_CURR": ["count"],
    "AMT_CREDIT": ["mean", "max", "sum"],
    "AMT_ANNUITY": ["mean", "max", "sum"],
    "AMT_APPLICATION": ["mean", "max", "sum"],
    "AMT_DOWN_PAYMENT": ["mean", "max", "sum"],
    "AMT_GOODS_PRICE": ["mean", "max", "sum"],
    "RATE_DOWN_PAYMENT": ["min", "max", "mean"],
    "DAYS_DECISION": ["min", "max", "mean"],
    "CNT_PAYMENT": ["mean", "sum"],
    "PREV_CREDIT_DIFF": ["mean", "max", "sum"],
    "PREV_CREDIT_APPL_RATIO": ["mean", "max"],
    "PREV_GOODS_DIFF": ["mean", "max", "sum"],
    "PREV_GOODS_APPL_RATIO": ["mean", "max"],
    "PREV_DAYS_LAST_DUE_DIFF": ["mean", "max", "sum"],
    "PREV_INTERESTS_RATE": ["mean", "max"],
}
PREV_PREFIX = "PREV_"
PREV_RECENT_PREFIX = "PREV_D365_"
PREV_RECENT_DAYS = -365          # DAYS_DECISION > -365 (strict)
PREV_SENTINEL_COLS = ["DAYS_FIRST_DRAWING", "DAYS_FIRST_DUE", "DAYS_LAST_DUE_1ST_VERSION",
                      "DAYS_LAST_DUE", "DAYS_TERMINATION"]
PREV_APPROVED = "Approved"
PREV_REFUSED = "Refused"

# --- Fixed values: bureau (all history, active only, last 750 days) ---
BUREAU_SPEC = {
    "SK_ID_BUREAU": ["count"],
    "DAYS_CREDIT": ["min", "max", "mean"],
    "CREDIT_DAY_OVERDUE": ["min", "max", "mean"],
    "DAYS_CREDIT_ENDDATE": ["min", "max", "mean"],
    "DAYS_ENDDATE_FACT": ["min", "max", "mean"],
    "AMT_CREDIT_MAX_OVERDUE": ["max", "mean"],
    "AMT_CREDIT_SUM": ["max", "mean", "sum"],
    "AMT_CREDIT_SUM_DEBT": ["max", "mean", "sum"],
    "AMT_CREDIT_SUM_OVERDUE": ["max", "mean", "sum"],
    "AMT_ANNUITY": ["max", "mean", "sum"],
    "BUREAU_ENDDATE_FACT_DIFF": ["min", "max", "mean"],
    "BUREAU_CREDIT_FACT_DIFF": ["min", "max", "mean"],
    "BUREAU_CREDIT_ENDDATE_DIFF": ["min", "max", "mean"],
    "BUREAU_CREDIT_DEBT_RATIO": ["min", "max", "mean"],
    "BUREAU_CREDIT_DEBT_DIFF": ["min", "max", "mean"],
    "BUREAU_IS_DPD": ["mean", "sum"],
    "BUREAU_IS_DPD_OVER120": ["mean", "sum"],
}
BUREAU_PREFIX = "BUREAU_"
BUREAU_ACTIVE_PREFIX = "BUREAU_ACT_"
BUREAU_RECENT_PREFIX = "BUREAU_D750_"
BUREAU_ACTIVE = "Active"
BUREAU_RECENT_DAYS = -750        # DAYS_CREDIT > -750
BUREAU_DPD_SEVERE = 120          # CREDIT_DAY_OVERDUE > 120 (strict for bureau)

# --- Fixed values: bureau monthly balances ---
BUREAU_BAL_SPEC = {
    "SK_ID_CURR": ["count"],
    "MONTHS_BALANCE": ["min", "max", "mean"],
    "BUREAU_BAL_IS_DPD": ["mean", "sum"],
    "BUREAU_BAL_IS_DPD_OVER120": ["mean", "sum"],
}
BUREAU_BAL_PREFIX = "BUREAU_BAL_"
BUREAU_BAL_DPD_STATUSES = ["1", "2", "3", "4", "5"]
BUREAU_BAL_SEVERE_STATUS = "5"

# --- Fixed values: POS / cash balances (all history and last 24 months) ---
POS_SPEC = {
    "SK_ID_CURR": ["count"],
    "MONTHS_BALANCE": ["min", "mean", "max"],
    "SK_DPD": ["min", "max", "mean", "sum"],
    "CNT_INSTALMENT": ["min", "max", "mean", "sum"],
    "CNT_INSTALMENT_FUTURE": ["min", "max", "mean", "sum"],
    "POS_IS_DPD": ["mean", "sum"],
    "POS_IS_DPD_UNDER_120": ["mean", "sum"],
    "POS_IS_DPD_OVER_120": ["mean", "sum"],
}
POS_PREFIX = "POS_"
POS_RECENT_PREFIX = "POS_M24"
POS_RECENT_MONTHS = -24          # MONTHS_BALANCE > -24

# --- Fixed values: instalment payments (all history and last 365 days) ---
INS_SPEC = {
    "SK_ID_CURR": ["count"],
    "NUM_INSTALMENT_VERSION": ["nunique"],
    "DAYS_ENTRY_PAYMENT": ["mean", "max", "sum"],
    "DAYS_INSTALMENT": ["mean", "max", "sum"],
    "AMT_INSTALMENT": ["mean", "max", "sum"],
    "AMT_PAYMENT": ["mean", "max", "sum"],
    "AMT_DIFF": ["mean", "min", "max", "sum"],
    "AMT_RATIO": ["mean", "max"],
    "SK_DPD": ["mean", "min", "max"],
    "INS_IS_DPD": ["mean", "sum"],
    "INS_IS_DPD_UNDER_120": ["mean", "sum"],
    "INS_IS_DPD_OVER_120": ["mean", "sum"],
}
INS_PREFIX = "INS_"
INS_RECENT_PREFIX = "INS_D365"
INS_RECENT_DAYS = -365           # DAYS_ENTRY_PAYMENT >= -365 (inclusive)

# --- Fixed values: credit-card balances (all history and last 3 months) ---
CARD_SPEC = {
    "SK_ID_CURR": ["count"],
    "AMT_BALANCE": ["max"],
    "AMT_CREDIT_LIMIT_ACTUAL": ["max"],
    "AMT_DRAWINGS_ATM_CURRENT": ["max", "sum"],
    "AMT_DRAWINGS_CURRENT": ["max", "sum"],
    "AMT_DRAWINGS_POS_CURRENT": ["max", "sum"],
    "AMT_INST_MIN_REGULARITY": ["max", "mean"],
    "AMT_PAYMENT_TOTAL_CURRENT": ["max", "sum"],
    "AMT_TOTAL_RECEIVABLE": ["max", "mean"],
    "CNT_DRAWINGS_ATM_CURRENT": ["max", "sum"],
    "CNT_DRAWINGS_CURRENT": ["max", "mean", "sum"],
    "CNT_DRAWINGS_POS_CURRENT": ["mean"],
    "SK_DPD": ["mean", "max", "sum"],
    "BALANCE_LIMIT_RATIO": ["min", "max"],
    "DRAWING_LIMIT_RATIO": ["min", "max"],
    "CARD_IS_DPD": ["mean", "sum"],
    "CARD_IS_DPD_UNDER_120": ["mean", "sum"],
    "CARD_IS_DPD_OVER_120": ["mean", "sum"],
}
CARD_PREFIX = "CARD_"
CARD_RECENT_PREFIX = "CARD_M3"
CARD_RECENT_MONTHS = -3          # MONTHS_BALANCE >= -3 (inclusive)

# DPD tiers for POS / instalments / cards: > 0, (0, 120), >= 120
DPD_SEVERE = 120

# --- Fixed values: final assembly prune rule ---
BLOCK_PREFIXES = ["BUREAU", "PREV", "POS", "INS", "CARD"]
