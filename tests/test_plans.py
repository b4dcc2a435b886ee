"""Physical plan shape: the properties the operators are designed for."""

import pytest

from conftest import SF_SMALL
from rivulet.plans import catalog as C


def plan(df) -> str:
    import io
    from contextlib import redirect_stdout

    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_topk_limits_each_map_task_before_the_shuffle(spark):
    p = plan(C.q_topk_rows(spark, SF_SMALL))
    assert "row_number(), 5, Partial" in p and "row_number(), 5, Final" in p
    # the partial limit sits below the exchange on industry
    assert p.index("WindowGroupLimit (") < p.index("Exchange (")


def test_latest_per_key_reduces_map_side(spark):
    p = plan(C.q_table_latest(spark, SF_SMALL))
    assert "partial_max_by" in p


def test_no_job_runs_while_a_dimension_join_is_planned(spark):
    from rivulet.operators.joins import join_dimension

    facts, dim = spark.range(100), spark.range(10).selectExpr("id", "id * 2 as twice")
    spark.sparkContext.setJobGroup("dimension-plan", "")
    p = plan(join_dimension(facts, dim, "id"))
    assert list(spark.sparkContext.statusTracker().getJobIdsForGroup("dimension-plan")) == []
    assert "Join" in p


def test_sessions_reduce_to_slots_before_the_first_shuffle(spark):
    p = plan(C.q_session_count(spark, SF_SMALL))
    assert p.index("HashAggregate (") < p.index("Exchange (") and "partial_count" in p


def test_interval_join_equi_joins_on_key_and_time_bucket(spark):
    p = plan(C.correlate_purchases(spark, SF_SMALL, "inner"))
    assert "Left keys [2]" in p


def test_scans_read_only_needed_columns(spark):
    p = plan(C.q_map_upper(spark, SF_SMALL))
    assert "ReadSchema: struct<p_partkey:bigint,p_name:string>" in p
    p = plan(C.q_reduce_share_volume(spark, SF_SMALL))
    assert "ReadSchema: struct<l_partkey:bigint,l_quantity:double>" in p


@pytest.mark.parametrize("name", sorted(C.BATCH_QUERIES))
def test_no_python_in_batch_plans(spark, name):
    p = plan(C.BATCH_QUERIES[name](spark, SF_SMALL))
    assert "EvalPython" not in p and "FlatMapGroupsInPandas" not in p


def test_share_volume_is_reduced_before_the_part_join(spark):
    import re

    p = plan(C.q_reduce_share_volume(spark, SF_SMALL))
    # node details are numbered from the leaves up: the partial aggregate on
    # l_partkey must come below (before) the join to part
    blocks = re.split(r"\n(?=\(\d+\) )", p)
    number = lambda b: int(re.match(r"\((\d+)\)", b).group(1))
    nodes = [b for b in blocks if re.match(r"\(\d+\) ", b)]
    partial = [number(b) for b in nodes if "partial_sum" in b and "l_partkey" in b]
    joins = [number(b) for b in nodes if re.match(r"\(\d+\) \w*HashJoin|\(\d+\) SortMergeJoin", b)]
    assert partial and joins and max(partial) < min(joins)


def test_full_interval_join_reads_each_side_once(spark):
    p = plan(C.correlate_purchases(spark, SF_SMALL, "full"))
    assert len([line for line in p.splitlines() if line.startswith("Location")]) == 2
    assert "FullOuter" in p


def test_full_interval_join_of_streams_keeps_keys_and_times_only_in_its_second_join(spark):
    from rivulet.operators.joins import interval_join_full_union

    sides = [spark.createDataFrame([], f"{s}_user long, {s}_ts timestamp, {s}_text string") for s in "lr"]
    df = interval_join_full_union(*sides, ("l_user", "r_user"), ("l_ts", "r_ts"), 0, 60)
    p = df._jdf.queryExecution().optimizedPlan().toString()
    second = p[p.index("Join RightOuter"):]
    assert "l_user" in second and "l_text" not in second[:second.index("LogicalRDD")]
