"""Plan-shape checks for the scale properties the design relies on."""
import re

from riskloom.plans import blocks as B
from riskloom.sources import fixtures as FX

SF = "/root/testdata/sf0.001"


def _plan(spark, df):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        return df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_block_is_one_partial_aggregate_and_one_shuffle(spark):
    plan = _plan(spark, B.prev_block(FX.previous_application(spark, SF)))
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 1
    assert "partial_" in plan          # map-side combine before the shuffle: hot keys ship one row per task


def test_distinct_count_block_has_no_expand(spark):
    plan = _plan(spark, B.installments_block(FX.installments(spark, SF)))
    assert "Expand" not in plan


def test_assembly_joins_add_no_exchange(spark):
    app = FX.application(spark, SF).select("SK_ID_CURR", "split", "TARGET")
    blocks = B.all_blocks(FX.previous_application(spark, SF), FX.bureau(spark, SF), FX.bureau_balance(spark, SF),
                          FX.pos_cash(spark, SF), FX.installments(spark, SF), FX.credit_card(spark, SF))
    plan = _plan(spark, B.assemble(app, blocks))
    # base + bureau (3) + prev (1) + pos (1) + instalments (2 fixture join + 2 two-level) + card (1)
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 11


def test_scan_is_pruned(spark):
    df = B.pos_block(FX.pos_cash(spark, SF))
    plan = df._jdf.queryExecution().executedPlan().toString()
    m = re.search(r"ReadSchema: struct<([^>]*)>", plan)
    assert m and "props" not in m.group(1)   # unused event column never read


def test_grouped_rank_plan_has_no_single_partition(spark):
    from riskloom.functions.ranks import with_average_rank
    p = FX.predictions(spark, SF)
    plan = _plan(spark, with_average_rank(p, "pred", ["model"], pct=True))
    assert "SinglePartition" not in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
