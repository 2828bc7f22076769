"""The plans we want: pruned scans, no nested-loop joins, no needless shuffles."""

import os

import pytest
from pyspark.sql import functions as F

from tallywire.operators import explore, learn
from tallywire.operators.features import event_features
from tallywire.plans import experiments
from tallywire.plans.registry import all_queries
from tallywire.sources.sinks import save_bucketed

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the given tables")


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_flagship_reads_only_its_columns(spark):
    plan = _plan(all_queries()["feat_ab"](spark, SF))
    assert "ReadSchema: struct<l_orderkey:bigint,l_suppkey:bigint,l_quantity:double,l_extendedprice:double>" in plan
    assert "o_orderdate" not in plan.split("ReadSchema")[1]
    assert plan.count("Exchange hashpartitioning") <= 2


@pytest.mark.parametrize("name", ["join_phase_range", "join_bucket_overlap", "agg_lookup_zero", "win_counter_rate",
                                  "fit_apply_splits", "agg_class_mix_splits", "str_summary", "str_window_traffic",
                                  "agg_hist_linear", "join_semi", "agg_profile", "win_rolling5"])
def test_no_nested_loops(spark, name):
    plan = _plan(all_queries()[name](spark, SF))
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan


def test_the_skew_switch_is_worked_out_once(spark, tmp_path, monkeypatch):
    spark.range(200).selectExpr(
        "id AS o_orderkey", "id AS o_custkey", "'O' AS o_orderstatus", "CAST(id * id * id AS DOUBLE) AS o_totalprice",
        "TIMESTAMP_NTZ '2024-01-01 00:00:00' AS o_orderdate", "'1' AS o_orderpriority").write.parquet(str(tmp_path / "orders.parquet"))
    calls, table = [], explore.quantile_table
    monkeypatch.setattr(explore, "quantile_table", lambda *a: calls.append(1) or table(*a))
    found = {r["name"]: r["use_log"] for r in all_queries()["agg_log_if_skewed"](spark, str(tmp_path)).collect()}
    assert len(calls) == 1 and len(found) == 5 and not found["packet_speed"] and not found["avg_packet_len"]


def test_top_n_is_cut_before_the_shuffle(spark):
    assert "WindowGroupLimit" in _plan(all_queries()["agg_top_n_per_class"](spark, SF))
    assert "TakeOrderedAndProject" in _plan(all_queries()["win_sample_n"](spark, SF))


def test_bucketed_tables_join_without_a_shuffle(spark):
    ev = spark.range(300).selectExpr(
        "id AS attack_id", "80 AS port", "'Normal traffic' AS type", "id AS packet_speed", "1 AS avg_packet_len", "1 AS avg_source_ip_count")
    co = spark.range(900).selectExpr("id % 300 AS attack_id", "id AS packet_speed", "1 AS avg_packet_len", "1 AS source_ip_count")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        save_bucketed(ev, "ev_bucketed", 4)
        save_bucketed(co, "co_bucketed", 4)
        plan = _plan(event_features(spark.table("ev_bucketed"), spark.table("co_bucketed")))
        assert "Exchange" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP TABLE IF EXISTS ev_bucketed")
        spark.sql("DROP TABLE IF EXISTS co_bucketed")


def test_ablation_over_mixture_columns(spark):
    from tallywire.plans.learn_q import stored_features

    table, members = experiments.with_mixture_columns(stored_features(spark, SF), ["pps_mean", "pps_std", "src_ip_mean"])
    fast = learn.Settings(forest_trees=3, forest_depth=4, gbt_rounds=2, lr_iterations=20)
    chosen = [c for c in experiments.configurations(members) if c.name in ("abc", "ab_extras_ood")]
    rows = experiments.ablation(table, chosen, ["Decision Tree", "Random Forest"], fast).collect()
    assert len(rows) == 2 * 2 * 2 * 4
    assert {r["config"] for r in rows} == {"abc", "ab_extras_ood"}
    assert table.filter(F.abs(sum((F.col(m) for m in members), F.lit(0.0)) - 3) > 1e-6).isEmpty()
