"""The reference's programs as compositions of rivulet operators.

Each program is a function from its input DataFrames to its named outputs
(``dict[name, DataFrame]``).  The same function serves a batch run
(``write_outputs``) and a stream (``fan_out_writer`` in ``foreachBatch``, or
a direct ``writeStream`` where the plan is streaming-capable).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.operators import aggregates as A
from rivulet.operators import records as R
from rivulet.operators.cogroup import cogroup
from rivulet.operators.joins import join_dimension
from rivulet.operators.monitoring import observed
from rivulet.operators.sessions import sessionize
from rivulet.operators.tables import latest_per_key
from rivulet.operators.topk import render_ranked, top_k_by_volume

Outputs = dict[str, DataFrame]


def upper_case_text(text: DataFrame) -> Outputs:
    """Upper-case every text record."""
    return {"out": R.map_upper(text)}


def purchase_flow(purchases: DataFrame) -> Outputs:
    """Mask cards once; store masked purchases, patterns and rewards."""
    masked = R.mask_purchases(purchases)
    return {"purchases": masked, "patterns": R.purchase_patterns(masked),
            "rewards": R.purchase_rewards(masked)}


def purchase_flow_advanced(purchases: DataFrame, with_metrics: bool = False) -> Outputs:
    """The purchase flow plus: price filter and time re-key, department
    branches, and the watched-employee alerts (the foreach side effect is
    an alerts output)."""
    masked = R.mask_purchases(purchases)
    out = {"patterns": R.purchase_patterns(masked), "rewards": R.purchase_rewards(masked),
           "purchases": R.filter_and_rekey_by_time(masked),
           "departments": R.branch_by_department(masked),
           "employee_alerts": R.watch_employee(masked)}
    if with_metrics:
        out = {k: observed(v, k) for k, v in out.items()}
    return out


def stream_vs_table(ticker: DataFrame) -> Outputs:
    """The same records as an append log and as a latest-per-key table."""
    return {"stream": ticker, "table": latest_per_key(ticker, "symbol", "seq", ["price"])}


def share_volume_top(trades: DataFrame, k: int = 5) -> Outputs:
    volume = A.reduce_share_volume(trades)
    top = top_k_by_volume(volume, k)
    return {"share_volume": volume, "top_by_industry": render_ranked(top)}


def sessions_enriched(txn: DataFrame, companies: DataFrame, clients: DataFrame,
                      gap_seconds: int) -> Outputs:
    s = sessionize(txn, ["customer_id", "symbol", "industry"], "ts", gap_seconds)
    s = join_dimension(s, companies.withColumnRenamed("name", "company_name"), "symbol")
    s = join_dimension(s, clients.withColumnRenamed("name", "customer_name"), "customer_id")
    return {"resolved_summaries": s.withColumn("key", F.col("industry"))}


def beer_sales_routes(sales: DataFrame) -> Outputs:
    routed = R.route_sales(sales)
    return {"domestic": routed.where(F.col("route") == "domestic").drop("route"),
            "international": routed.where(F.col("route") == "international").drop("route")}


def cogrouping(clicks: DataFrame, trades: DataFrame, key: str, ts: str, rid: str) -> Outputs:
    return {"cogrouped": cogroup(clicks, trades, key, ts, rid)}
