"""The programs end to end: batch fan-out and a stream with several sinks."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from rivulet.plans import apps
from rivulet.plans.catalog import q_purchase_pattern, q_purchase_reward, q_route_sales
from rivulet.schemas import PURCHASE
from rivulet.session import scratch_dir
from rivulet.sources import fixtures as V
from rivulet.sources.sinks import fan_out_writer, write_branches, write_outputs
from rivulet.streaming.harness import file_stream, run_to_end, stage_chunks


def _rows(df, cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_purchase_flow_batch_fan_out(spark):
    base = scratch_dir(spark, "app-purchases")
    paths = write_outputs(V.v_purchase(spark, SF_SMALL), apps.purchase_flow, base)
    assert set(paths) == {"purchases", "patterns", "rewards"}
    pat = spark.read.parquet(paths["patterns"])
    assert _rows(pat, pat.columns) == _rows(q_purchase_pattern(spark, SF_SMALL), pat.columns)
    rew = spark.read.parquet(paths["rewards"])
    assert _rows(rew, rew.columns) == _rows(q_purchase_reward(spark, SF_SMALL), rew.columns)


def test_advanced_flow_as_one_stream_with_many_sinks(spark):
    pur = V.v_purchase(spark, SF_SMALL)
    path = stage_chunks(spark, pur, F.unix_date(F.to_date("purchase_date")), "app-adv", 3)
    base, ckpt = scratch_dir(spark, "app-adv-out"), scratch_dir(spark, "app-adv-ckpt")
    q = (file_stream(spark, path, PURCHASE).writeStream
         .foreachBatch(fan_out_writer(apps.purchase_flow_advanced, base))
         .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
    run_to_end(q)
    batch = apps.purchase_flow_advanced(pur)
    for name in ["purchases", "departments", "employee_alerts", "rewards"]:
        got = spark.read.parquet(f"{base}/{name}/batch=*").drop("batch_id")
        assert _rows(got, got.columns) == _rows(batch[name], got.columns), name


def test_branch_outputs_by_folder(spark):
    base = scratch_dir(spark, "app-branches")
    deps = apps.purchase_flow_advanced(V.v_purchase(spark, SF_SMALL))["departments"]
    write_branches(deps, base)
    back = spark.read.parquet(base)
    assert {r.branch for r in back.select("branch").distinct().collect()} == {"coffee", "electronics"}
    assert back.count() == deps.count()


def test_beer_sales_route_every_sale_once(spark):
    out = apps.beer_sales_routes(V.v_beer(spark, SF_SMALL))
    routed = q_route_sales(spark, SF_SMALL)
    assert out["domestic"].count() + out["international"].count() == routed.count()
    assert out["domestic"].where("currency <> 'DOLLARS'").count() == 0


def test_metrics_flow_observes_each_output(spark):
    outs = apps.purchase_flow_advanced(V.v_purchase(spark, SF_SMALL), with_metrics=True)
    df = outs["employee_alerts"]
    n = df.count()
    assert n > 0


def test_purchase_flow_one_purchase_three_outputs(spark):
    """One purchase in; masked purchase, reward and pattern out."""
    import datetime as dt

    when = dt.datetime(2024, 3, 1, 12, 30)
    row = ("Ann", "Smith", "c-1", "1234-5678-9012-3456", "coffee beans", "Coffee", "000123",
           3, 4.25, when, "10001", "s-9")
    purchases = spark.createDataFrame([row], PURCHASE)
    out = apps.purchase_flow(purchases)
    masked = out["purchases"].first()
    assert masked.credit_card_number == "xxxx-xxxx-xxxx-3456"
    assert (masked.first_name, masked.item_purchased, masked.quantity, masked.price) == ("Ann", "coffee beans", 3, 4.25)
    reward = out["rewards"].first()
    assert (reward.customer_id, reward.purchase_total, reward.current_reward_points,
            reward.total_reward_points, reward.days_from_last_purchase) == ("Smith,Ann", 12.75, 12, 12, 0)
    pattern = out["patterns"].first()
    assert (pattern.zip_code, pattern.item, pattern.date, pattern.amount) == ("10001", "coffee beans", when, 12.75)


def test_fan_out_on_a_processing_time_trigger(spark):
    from rivulet.sources.sinks import start_fan_out

    pur = V.v_purchase(spark, SF_SMALL)
    path = stage_chunks(spark, pur, F.unix_date(F.to_date("purchase_date")), "app-cadence", 2)
    base, ckpt = scratch_dir(spark, "app-cadence-out"), scratch_dir(spark, "app-cadence-ckpt")
    q = start_fan_out(file_stream(spark, path, PURCHASE), apps.purchase_flow, base, ckpt, every="1 second")
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    got = spark.read.parquet(f"{base}/rewards/batch=*")
    assert got.count() == pur.count()


def test_reduce_before_join_equals_reduce_over_trades(spark):
    from rivulet.operators.aggregates import reduce_share_volume

    cols = ["symbol", "industry", "shares"]
    assert _rows(V.v_share_volume(spark, SF_SMALL), cols) == _rows(reduce_share_volume(V.v_trade(spark, SF_SMALL)), cols)


def test_traded_industries_equal_distinct_over_trades(spark):
    from rivulet.operators.aggregates import distinct_values

    assert (_rows(V.v_traded_industries(spark, SF_SMALL), ["industry"])
            == _rows(distinct_values(V.v_trade(spark, SF_SMALL), "industry"), ["industry"]))
