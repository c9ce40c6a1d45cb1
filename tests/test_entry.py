import __spark_entry__ as E


def test_entry_runs_on_sf0001(spark):
    df = E.entry(spark)
    assert "SK_ID_CURR" in df.columns and "PREV_SK_ID_CURR_COUNT" in df.columns
    assert df.count() > 0


def test_oracle_keys_are_queries():
    assert set(E.oracle_sql()) <= set(E.queries())


def test_feature_contract_counts(spark):
    from riskloom.plans import specs as S
    from riskloom.operators.aggspec import feature_names
    n = (2 * len(feature_names(S.PREV_SPEC, "")) + 2 + 3 * len(feature_names(S.BUREAU_SPEC, ""))
         + len(feature_names(S.BUREAU_BAL_SPEC, "")) + 2 + 2 * len(feature_names(S.POS_SPEC, ""))
         + 2 * len(feature_names(S.INS_SPEC, "")) + 2 * len(feature_names(S.CARD_SPEC, "")))
    assert n == 398
