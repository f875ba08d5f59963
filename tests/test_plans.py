"""Plan properties behind the scale claims, checked on the final adaptive plans."""

from __future__ import annotations

import re

from eventmart.operators import quality
from eventmart.plans import registry, standins

SF = "/root/testdata/sf0.001"


def final_plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def test_enriched_is_map_only_with_bounded_dimensions(spark):
    plan = final_plan(registry.q_events_enriched(spark, SF))
    assert plan.count("BroadcastHashJoin") == 2
    assert "Exchange hashpartitioning" not in plan
    assert "SortMergeJoin" not in plan


def test_gate_metrics_need_one_shuffle(spark):
    plan = final_plan(quality.stage_metrics(standins.stage_batch(spark, SF)))
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 1


def test_city_mart_scan_reads_only_needed_columns(spark):
    plan = final_plan(registry.q_agg_events_by_city(spark, SF))
    lineitem = [line for line in plan.splitlines() if "lineitem.parquet" in line]
    assert lineitem
    scanned = re.search(r"FileScan parquet \[([^\]]*)\]", lineitem[0]).group(1)
    read = {c.split("#")[0] for c in scanned.split(",")}
    assert "l_tax" not in read and "l_partkey" not in read      # pruned at the scan
    assert {"l_orderkey", "l_suppkey", "l_quantity"} <= read


def test_salted_plan_joins_on_key_and_salt(spark):
    plan = final_plan(registry.q_events_enriched_hot_keys(spark, SF))
    plan = re.sub(r"#\d+L?", "", plan)
    # Both dimension joins are keyed on (key, salt); AQE may still pick the
    # physical strategy at run time once it sees the real sizes.
    assert "Join [group_id, __fsalt], [g__group_id, __dsalt]" in plan
    assert "Join [venue_id, __fsalt], [v__venue_id, __dsalt]" in plan


def test_small_delta_merge_never_shuffles_the_target(spark):
    plan = final_plan(registry.q_merge_events(spark, SF))
    assert "SortMergeJoin" not in plan
    assert "BroadcastHashJoin" in plan
