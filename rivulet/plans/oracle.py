"""DuckDB oracle SQL for every batch query (views of FIXTURES.md inlined as CTEs)."""

V_PURCHASE = """select split_part(c_name,'#',1) last_name, split_part(c_name,'#',2) first_name,
  cast(o_custkey as varchar) customer_id,
  case when o_orderkey % 17 = 0 then concat('4', cast(o_orderkey as varchar))
       when o_orderkey % 19 = 0 then '1-2-3-'
       else concat(lpad(cast(o_custkey % 10000 as varchar),4,'0'),'-',
                   lpad(cast(l_partkey % 10000 as varchar),4,'0'),'-',
                   lpad(cast(l_suppkey % 10000 as varchar),4,'0'),'-',
                   lpad(cast(o_orderkey % 10000 as varchar),4,'0')) end credit_card_number,
  p_name item_purchased,
  case p_type when 'ECONOMY' then 'Coffee' when 'PROMO' then 'ELECTRONICS' else lower(p_type) end department,
  case when l_suppkey % 20 = 0 then '000000' else lpad(cast(l_suppkey as varchar),6,'0') end employee_id,
  cast(l_quantity as int) quantity, l_discount * 100 price, o_orderdate purchase_date,
  lpad(cast(c_nationkey as varchar),5,'0') zip_code, cast(l_suppkey as varchar) store_id
from lineitem join orders on l_orderkey = o_orderkey
  join customer on o_custkey = c_custkey join part on l_partkey = p_partkey"""

V_TRADE = """select concat('P',cast(l_partkey as varchar)) symbol, p_type industry,
  cast(l_quantity as int) shares, l_shipdate ts
from lineitem join part on l_partkey = p_partkey"""

V_TXN = """select event_id, cast(user_id as varchar) customer_id,
  concat('R',cast(cast(json_extract_string(props,'$.k') as int) % 6 as varchar)) symbol,
  event_type industry, ts from events"""

V_COMPANY = "select concat('R',cast(r_regionkey as varchar)) symbol, r_name name from region"

V_CLIENT = """select cast(c_custkey as varchar) customer_id,
  concat(split_part(c_name,'#',1),', ',split_part(c_name,'#',2)) name
from customer"""

V_TICKER = """select cast(user_id as varchar) symbol,
  case when event_type='error' then null else value end price, event_id seq from events"""

V_BEER = """select case o_custkey % 3 when 0 then 'DOLLARS' when 1 then 'EURO' else 'POUNDS' end currency,
  o_totalprice total_sale, cast(o_orderkey % 50 as int) number_cases, o_orderpriority beer_type from orders"""

PURCHASE_COLS = ("first_name, last_name, customer_id, credit_card_number, item_purchased, department, "
                 "employee_id, quantity, price, purchase_date, zip_code, store_id")

MASK = """case when credit_card_number is null then null
  when len(string_split(regexp_replace(credit_card_number, '-+$', ''), '-')) < 4 then 'xxxx'
  else 'xxxx-xxxx-xxxx-' || string_split(regexp_replace(credit_card_number, '-+$', ''), '-')[4] end"""

JAVA_INT = """case when {x} is null then null when isnan({x}) then 0
  when {x} >= 2147483647 then 2147483647 when {x} <= -2147483648 then -2147483648
  else cast(trunc({x}) as int) end"""

AMOUNT = "price * cast(quantity as double)"


def _with(*views: tuple[str, str]) -> str:
    return "with " + ",\n".join(f"{n} as ({q})" for n, q in views) + "\n"


def _sessions(gap: str) -> str:
    return _with(("t", V_TXN)) + f""",
s as (select *, case when lag(ts) over w is null or ts - lag(ts) over w > interval '{gap}' then 1 else 0 end new_s
      from t window w as (partition by customer_id, symbol, industry order by ts)),
g as (select *, sum(new_s) over (partition by customer_id, symbol, industry order by ts
      rows between unbounded preceding and current row) gid from s)
select customer_id, symbol, industry, min(ts) session_start, max(ts) session_end, count(*) n
from g group by customer_id, symbol, industry, gid"""


def _correlate(join_type: str) -> str:
    return f"""with l as (select event_id l_id, ts l_ts, user_id l_user, value l_value, props l_item
             from events where event_type = 'view'),
r as (select event_id r_id, ts r_ts, user_id r_user, value r_value, props r_item
      from events where event_type = 'purchase')
select cast(coalesce(l_user, r_user) as varchar) customer_id,
  concat_ws('|', l_item, r_item) items_purchased,
  coalesce(l_value, 0) + coalesce(r_value, 0) total_amount,
  l_ts first_purchase_time, r_ts second_purchase_time
from l {join_type} join r on l_user = r_user and r_ts >= l_ts and r_ts <= l_ts + interval 6 hour"""


TOPK_ROWS = _with(("v", V_TRADE)) + """,
r as (select symbol, industry, cast(sum(shares) as bigint) shares from v group by symbol, industry),
k as (select industry, cast(row_number() over (partition by industry order by shares desc, symbol) as int) rank,
      symbol, shares from r)
select industry, rank, symbol, shares from k where rank <= 5"""

SESSION_GAP = "2 days"

SQL = {
    "source_append": "select event_id, ts, user_id, event_type, value, props from events",
    "map_upper": "select p_partkey as key, upper(p_name) as value from part",
    "mask_card": _with(("v", V_PURCHASE)) + f"""select first_name, last_name, customer_id,
  {MASK} as credit_card_number, item_purchased, department, employee_id, quantity, price,
  purchase_date, zip_code, store_id from v""",
    "purchase_pattern": _with(("v", V_PURCHASE)) +
        f"select zip_code, item_purchased as item, purchase_date as date, {AMOUNT} as amount from v",
    "purchase_reward": _with(("v", V_PURCHASE)) + f"""select
  coalesce(last_name,'null') || ',' || coalesce(first_name,'null') as customer_id,
  {AMOUNT} as purchase_total, {JAVA_INT.format(x=AMOUNT)} as total_reward_points,
  {JAVA_INT.format(x=AMOUNT)} as current_reward_points, cast(0 as int) as days_from_last_purchase from v""",
    "purchase_fanout": _with(("v", V_PURCHASE)) + f""",
a as (select count(*) n, sum(case when {MASK} = 'xxxx' then 1 else 0 end) short_masks,
      cast(sum(cast({AMOUNT} as decimal(38,4))) as double) amount_total,
      sum(cast({JAVA_INT.format(x=AMOUNT)} as bigint)) points from v)
select 'purchases' as sink, n as n_records, cast(short_masks as double) as checksum from a
union all select 'patterns', n, amount_total from a
union all select 'rewards', n, cast(points as double) from a""",
    "filter_rekey": _with(("v", V_PURCHASE)) + """select epoch_us(purchase_date) // 1000 as key, customer_id,
  item_purchased, price, quantity, purchase_date from v where price > 5.0""",
    "employee_watch": _with(("v", V_PURCHASE)) + """select employee_id, customer_id, item_purchased,
  price, quantity, purchase_date, store_id from v where employee_id = '000000'""",
    "branch_department": _with(("v", V_PURCHASE)) + """select * from (select
  case when lower(department) = 'coffee' then 'coffee' when lower(department) = 'electronics'
       then 'electronics' end as branch, customer_id, department, item_purchased, price, quantity from v)
  where branch is not null""",
    "to_dollars": _with(("b", V_BEER)) + """select currency, total_sale, number_cases, beer_type,
  total_sale / case currency when 'EURO' then 1.09::double when 'POUNDS' then 1.2929::double
                             when 'DOLLARS' then 1.0::double end as dollars from b""",
    "route_sales": _with(("b", V_BEER)) + """select
  case when currency = 'DOLLARS' then 'domestic' else 'international' end as route,
  currency, total_sale, number_cases, beer_type,
  total_sale / case currency when 'EURO' then 1.09::double when 'POUNDS' then 1.2929::double
                             when 'DOLLARS' then 1.0::double end as dollars from b""",
    "json_encode": _with(("v", V_PURCHASE)) + f"""select customer_id as key,
  case when quantity % 7 = 0 then '{PURCHASE_COLS.replace(", department", "").replace(", ", ",")}'
       else '{PURCHASE_COLS.replace(", ", ",")}' end as fields,
  last_name, first_name, credit_card_number, case when quantity % 7 <> 0 then department end as department,
  zip_code, quantity, price from v""",
    "json_decode": """select event_id, user_id,
  case when event_id % 11 <> 0 then cast(json_extract_string(props, '$.k') as int) end as k,
  event_id % 11 = 0 as malformed from events""",
    "record_audit_line": """select event_id as "offset", cast(user_id % 4 as int) as "partition",
  printf('Consumed: key = %s value = %s with offset = %d partition = %d',
         cast(user_id as varchar), event_type, event_id, cast(user_id % 4 as int)) as line from events""",
    "partition_by_customer": _with(("v", V_PURCHASE)) + """select cast(partition as int) as "partition",
  count(*) as n_records, count(distinct customer_id) as n_customers
from (select case when cast(store_id as bigint) % 10 = 0 then cast(store_id as bigint) % 16
                  else cast(customer_id as bigint) % 16 end as partition,
             case when cast(store_id as bigint) % 10 <> 0 then customer_id end as customer_id from v)
group by partition""",
    "key_by_function": _with(("v", V_TRADE)) + """select symbol as key, count(*) as n,
  cast(sum(shares) as bigint) as shares from v group by symbol""",
    "composite_key_count": _with(("v", V_PURCHASE)) + """select customer_id,
  purchase_date as transaction_date, count(*) as n from v group by customer_id, purchase_date""",
    "table_latest": _with(("t", V_TICKER)) + """select symbol, price, seq from (select *,
  row_number() over (partition by symbol order by seq desc) rn from t) where rn = 1 and price is not null""",
    "changelog_stream": _with(("t", V_TICKER)) + """select symbol, price, seq from (select *,
  row_number() over (partition by symbol order by seq desc) rn from t) where rn = 1""",
    "dim_clients": V_CLIENT,
    "dim_companies": """select concat('P', cast(p_partkey as varchar)) as symbol, p_name as name,
  p_type as industry from part""",
    "distinct_industries": _with(("v", V_TRADE)) + "select distinct industry from v",
    "headline_per_industry": _with(("v", V_TRADE)) + """,
i as (select industry, row_number() over (order by industry) n from (select distinct industry from v)),
d as (select doc_id, text, row_number() over (order by doc_id) n from documents)
select industry, doc_id, text as headline from i left join d using (n)""",
    "reduce_share_volume": _with(("v", V_TRADE)) + """select symbol, industry,
  cast(sum(shares) as bigint) as shares from v group by symbol, industry""",
    "topk_rows": TOPK_ROWS,
    "topk_by_industry": "with k as (" + TOPK_ROWS + """)
select industry, string_agg(cast(rank as varchar) || ')' || symbol || ':' || format('{:,}', shares) || ' ', ''
  order by rank) as ranking from k group by industry""",
    "topk_stream": TOPK_ROWS,
    "session_count": _sessions(SESSION_GAP),
    "session_by_industry": "select industry as key, customer_id, symbol, n, session_start, session_end from ("
        + _sessions(SESSION_GAP) + ")",
    "session_stream": _sessions(SESSION_GAP),
    "session_enriched": "with sc as (" + _sessions(SESSION_GAP) + "), " + f"""
co as ({V_COMPANY}), cl as ({V_CLIENT})
select sc.*, co.name as company_name, cl.name as customer_name
from sc left join co on sc.symbol = co.symbol left join cl on sc.customer_id = cl.customer_id""",
    "event_time": """select event_id,
  case when k is null then 'wall_clock' when trade_ts is not null then 'trade' else 'record' end as time_source,
  case when k is null then timestamp '2030-01-01' else coalesce(trade_ts, record_ts) end as event_time
from (select event_id, case when event_id % 5 <> 0 then cast(json_extract_string(props,'$.k') as int) end k,
  case when event_id % 7 = 0 then null else ts end trade_ts, date_trunc('minute', ts) record_ts from events)""",
    "event_time_repair": """select event_id, "partition", "offset", ts_ms, case when ts_ms >= 0 then ts_ms
  else max(case when ts_ms >= 0 then ts_ms end) over (partition by "partition" order by "offset"
       rows between unbounded preceding and current row) end as event_ms, ts_ms < 0 as repaired
from (select event_id, cast(user_id % 4 as int) "partition", event_id "offset",
  case when event_id % 7 = 0 then -1 else epoch_us(ts) // 1000 end ts_ms from events)""",
    "correlate_purchases_inner": _correlate("inner"),
    "correlate_purchases_left": _correlate("left"),
    "correlate_purchases_full": _correlate("full"),
    "correlate_purchases_stream": _correlate("left"),
    "cogroup_events": """with t as (
  select user_id key, ts, event_id rid, case event_type when 'click' then 'a' else 'b' end side
  from events where event_type in ('click', 'purchase')),
c as (select *, date_trunc('day', ts) window_start,
  cast(floor((row_number() over (partition by key, date_trunc('day', ts), side order by ts, rid) - 1) / 1000) as int) chunk
  from t)
select key, window_start, chunk, count(*) filter (where side = 'a') as n_clicks,
  count(*) filter (where side = 'b') as n_purchases,
  coalesce(string_agg(cast(rid as varchar), ',' order by rid) filter (where side = 'a'), '') as click_ids,
  coalesce(string_agg(cast(rid as varchar), ',' order by rid) filter (where side = 'b'), '') as purchase_ids
from c group by key, window_start, chunk""",
    "reward_running_total": _with(("v", V_PURCHASE)) + f""",
d as (select customer_id, purchase_date, count(*) n_purchases,
      cast(sum({JAVA_INT.format(x=AMOUNT)}) as bigint) day_points from v group by customer_id, purchase_date)
select customer_id, purchase_date, n_purchases, day_points,
  cast(sum(day_points) over (partition by customer_id order by purchase_date
       rows between unbounded preceding and current row) as bigint) as total_reward_points,
  cast(coalesce(date_diff('day', lag(purchase_date) over (partition by customer_id order by purchase_date),
       purchase_date), 0) as int) as days_from_last_purchase
from d""",
    "reward_stream": _with(("v", V_PURCHASE)) + f"""select customer_id,
  cast(sum({JAVA_INT.format(x=AMOUNT)}) as bigint) as total_reward_points, count(*) as n_purchases
from v group by customer_id""",
    "reward_days_stream": _with(("v", V_PURCHASE)) + f""",
d as (select customer_id, purchase_date, count(*) n, sum({JAVA_INT.format(x=AMOUNT)}) points,
      row_number() over (partition by customer_id order by purchase_date desc) place,
      lead(purchase_date) over (partition by customer_id order by purchase_date desc) before
      from v group by customer_id, purchase_date)
select customer_id, cast(sum(points) as bigint) as total_reward_points, cast(sum(n) as bigint) as n_purchases,
  cast(max(purchase_date) as date) as last_purchase,
  cast(coalesce(max(date_diff('day', before, purchase_date)) filter (where place = 1), 0) as int)
    as days_from_last_purchase from d group by customer_id""",
    "progress_percent": """with p as (select cast(user_id % 4 as int) "partition", cast(ts as date) batch,
  count(*) batch_completed from events group by 1, 2),
r as (select *, cast(sum(batch_completed) over (partition by "partition" order by batch
  rows between unbounded preceding and current row) as bigint) restored_so_far,
  cast(sum(batch_completed) over (partition by "partition") as bigint) total_to_restore from p)
select *, round_even(100.0::double * restored_so_far / total_to_restore, 2) as percent_complete from r""",
}

SQL["cogroup_stream"] = SQL["cogroup_events"]
SQL["employee_alerts_stream"] = SQL["employee_watch"]
SQL["purchase_days_stream"] = _with(("v", V_PURCHASE)) + """select date_trunc('day', purchase_date)::timestamp
  as window_start, count(*) as n, sum(quantity)::bigint as quantity from v group by 1"""
SQL["event_time_repair_stream"] = SQL["event_time_repair"]
SQL["purchase_fanout_stream"] = SQL["purchase_fanout"]
SQL["session_enriched_stream"] = SQL["session_enriched"]
SQL["correlate_purchases_full_stream"] = SQL["correlate_purchases_full"]

V_TRADE_CHANGES = """select concat('P',cast(l_partkey as varchar)) symbol, p_type industry, x.shares, x.n, x.year - x.year % 2 period
from lineitem join part on l_partkey = p_partkey, lateral (
  select cast(l_quantity as bigint) shares, 1 n, year(l_shipdate) as year
  union all select -cast(l_quantity as bigint), -1, year(l_shipdate) + 1 where l_returnflag = 'R') x"""

SQL["topk_changes_stream"] = _with(("c", V_TRADE_CHANGES)) + """,
y as (select industry, symbol, period, sum(shares) shares, sum(n) n from c group by all),
touched as (select distinct industry, period from c),
t as (select touched.industry, touched.period, symbol, sum(shares) shares from touched join y
      on y.industry = touched.industry and y.period <= touched.period group by all having sum(n) > 0),
k as (select *, row_number() over (partition by industry, period order by shares desc, symbol) as rank from t)
select cast(touched.period as bigint) as period, touched.industry, coalesce(string_agg(cast(rank as varchar) || ')' || symbol || ':'
  || format('{:,}', cast(shares as bigint)) || ' ', '' order by rank), '') as ranking
from touched left join k on k.industry = touched.industry and k.period = touched.period and rank <= 5
group by touched.period, touched.industry"""

SQL["retained_pairs_stream"] = """select cast(a.user_id as varchar) as key, a.event_id as click_id,
  b.event_id as purchase_id, epoch_us(b.ts) // 1000 - epoch_us(a.ts) // 1000 as after_ms
from events a join events b on a.user_id = b.user_id and abs(epoch_us(b.ts) // 1000 - epoch_us(a.ts) // 1000) <= 7200000
where a.event_type = 'click' and b.event_type = 'purchase'"""


def _name_at(name: str, number: str) -> str:
    return (f"case when {number} % 5 = 1 and step >= 1 then {name} || ' I' when {number} % 5 = 2 and step >= 2 "
            f"then {name} || ' II' when {number} % 5 = 3 and step >= 1 then null else {name} end")


SQL["moving_lookup_stream"] = _with(("t", V_TXN), ("co", V_COMPANY), ("cl", V_CLIENT)) + f""",
s as (select *, least((day(ts) - 1) // 10, 2) step from t)
select event_id, s.symbol, s.customer_id, {_name_at("co.name", "cast(substr(s.symbol, 2) as bigint)")} as company_name,
  {_name_at("cl.name", "cast(s.customer_id as bigint)")} as client_name
from s left join co on s.symbol = co.symbol left join cl on s.customer_id = cl.customer_id"""
