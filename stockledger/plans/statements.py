"""The registered queries as DuckDB statements over the same tables.

Written from the definition of each result and not from the Spark code: the
floored balance is a recursion, the open balance an interval join, the ids a
plain row number.
"""

from __future__ import annotations

import math

# --- the test tables in business shapes -------------------------------------

SHAPES = {
    "purchase_orders": """
        select concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) as po_line_id,
               l_orderkey as po_number, l_linenumber::bigint as line_number,
               l_suppkey as supplier_id, l_partkey as component_id, l_suppkey % 25 as hub_id,
               o_orderdate::date as order_date, o_orderdate::date + 30 as promised_date,
               case when l_linestatus = 'F'
                    then o_orderdate::date + l_quantity::int end as received_date,
               l_quantity::bigint as qty_ordered,
               case when l_linestatus <> 'F' then 0
                    when l_returnflag = 'R' then floor(l_quantity * 8 / 10)::bigint
                    else l_quantity::bigint end as qty_received,
               round(l_extendedprice / l_quantity, 2) as unit_cost_usd,
               if(l_linestatus = 'F', 'Closed', 'Open') as status
        from lineitem join orders on o_orderkey = l_orderkey""",
    "suppliers": """
        select s_suppkey as supplier_id, s_name as supplier_name,
               'GROUP-' || s_nationkey as supplier_category,
               [30, 45, 60][s_nationkey % 3 + 1]::bigint as payment_terms_days,
               s_acctbal >= 0 as strategic_flag
        from supplier""",
    "racks": """
        select rack_id, region_code, region_code::bigint as hub_id, sku_id, sku_family,
               requested_date,
               case when shipped <= date '2001-06-30' then shipped end as shipped_date,
               case when installed <= date '2001-06-30' then installed end as installed_date,
               case when live <= date '2001-06-30' then live end as live_date,
               capex_usd, life as useful_life_months
        from (
            select o_orderkey as rack_id, c_nationkey as region_code,
                   ['ECONOMY', 'LARGE', 'MEDIUM', 'PROMO', 'SMALL', 'STANDARD']
                       [o_orderkey % 6 + 1] as sku_id,
                   o_orderpriority as sku_family, o_orderdate::date as requested_date,
                   requested_date + (o_orderkey % 30)::int as shipped,
                   shipped + (o_orderkey % 11 + 3)::int as installed,
                   installed + (o_orderkey % 7 + 1)::int as live,
                   o_totalprice as capex_usd,
                   if(o_orderpriority = '1-URGENT', 48, 72)::bigint as life
            from orders join customer on c_custkey = o_custkey)""",
    "skus": """
        select distinct p_type as sku_id, left(p_type, 1) as sku_family,
               case p_type when 'ECONOMY' then 20 when 'LARGE' then 8 when 'MEDIUM' then 10
                           when 'PROMO' then 16 when 'SMALL' then 40 else 12 end as units
        from part""",
    "bom": """
        select p_type as sku_id, p_brand as component_id, max(p_size) as qty
        from part group by all""",
    "brands": """
        select p_brand as component_id, min(p_name) as component_name,
               min(p_type) as component_category, max(p_retailprice) as standard_cost
        from part group by all""",
    # whole-rack quantities; infrastructure replaces what the bill of material says
    "rack_bom": """
        select sku_id, component_id,
               coalesce(any_value(case when component_id = 'Brand#3' and sku_family = 'E'
                                       then 1 end),
                        any_value(fixed), any_value(bom_qty))::bigint as qty_per_rack
        from (
            select sku_id, sku_family, component_id, qty * units as bom_qty,
                   null::int as fixed
            from bom join skus using (sku_id)
            union all
            select sku_id, sku_family, col0, null, col1
            from skus, (values ('Brand#1', 1), ('Brand#2', 64), ('FRAME', 2))
            union all
            select sku_id, sku_family, 'Brand#3', null, 1 from skus where sku_family = 'E')
        group by sku_id, component_id""",
    "journal": """
        select concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey,
                         l_shipdate::date) as journal_id,
               l_shipdate::date as posting_date,
               case l_returnflag when 'A' then '5100' when 'N' then '5200' else '1400' end
                   as account_id,
               l_suppkey as cost_center_id, l_extendedprice * (1 - l_discount) as amount_usd,
               if(l_returnflag = 'R', 'Adjustment', 'Accrual') as source,
               l_orderkey as reference, 'line ' || l_linenumber as memo
        from lineitem""",
    "chart": """
        select ['1400', '5100', '5200', '5300', '5400'][r_regionkey + 1] as account_id,
               r_name as account_name, if(r_regionkey = 0, 'Asset', 'Opex') as account_type
        from region""",
    "centers": """
        select s_suppkey as cost_center_id, s_name as cost_center_name,
               if(s_acctbal >= 0, 'Operations', 'Finance') as org, s_nationkey as region_code
        from supplier""",
    "months": """
        select unnest(generate_series(date '1995-01-01', date '2001-06-01',
                                      interval 1 month))::date as month,
               (date_part('year', month) - 1995) * 12 + date_part('month', month) - 1 as step""",
    "schedule": """
        select rack_id, region_code, sku_family,
               last_day(date_trunc('month', installed_date)::date + to_months(n::int))
                   as posting_date,
               capex_usd / useful_life_months as depreciation_usd
        from racks, range(1, 200) as r(n)
        where installed_date is not null and n <= useful_life_months
          and date_trunc('month', installed_date) + to_months(n::int) <= date '2001-06-01'""",
    "receipts": """
        select po_line_id, received_date, component_id,
               qty_received * p_retailprice as standard, qty_received * unit_cost_usd as paid
        from purchase_orders join part on p_partkey = component_id
        where status = 'Closed' and qty_received <> 0""",
    "receipt_lines": """
        select received_date as posting_date, po_line_id as reference, 'PO Receipt' as source,
               1 as line, '1400' as account_id, 'CC-1100' as cost_center_id,
               round(standard, 2) + 0.0 as amount_usd, 'Receipt ' || component_id as memo
        from receipts
        union all
        select received_date, po_line_id, 'PO Receipt', 2, '5600', 'CC-1300',
               round(paid - standard, 2) + 0.0, 'PPV vs standard'
        from receipts
        union all
        select received_date, po_line_id, 'PO Receipt', 3, '2100', 'CC-1100',
               round(-paid, 2) + 0.0, 'AP accrual'
        from receipts""",
    "scorecard": """
        select date_trunc('month', promised_date)::date as promised_month, supplier_id,
               supplier_name, supplier_category, strategic_flag,
               count(*) as po_lines, sum(qty_ordered)::bigint as qty_ordered,
               sum(qty_received)::bigint as qty_received,
               round(100.0 * avg((received_date <= promised_date)::int), 1) as on_time_pct,
               round(100.0 * avg((qty_received >= qty_ordered)::int), 1) as in_full_pct,
               round(100.0 * avg((received_date <= promised_date
                                  and qty_received >= qty_ordered)::int), 1) as otif_pct,
               round(avg(received_date - promised_date)
                     filter (where received_date > promised_date), 1) as avg_days_late_when_late,
               round(round(sum((qty_received * unit_cost_usd)::decimal(28, 12)), 8), 2)::double
                   as received_value_usd
        from purchase_orders join suppliers using (supplier_id)
        where status = 'Closed'
        group by all""",
    "capex": """
        select date_trunc('month', installed_date)::date as in_service_month, region_code,
               n_name as region_name, sku_family, count(*) as racks_in_service,
               round(round(sum(capex_usd::decimal(28, 12)), 8), 2)::double as capex_usd,
               round(round(sum((capex_usd / useful_life_months)::decimal(28, 12)), 8), 2)::double
                   as added_monthly_depreciation_usd,
               round(avg(live_date - requested_date), 1) as avg_request_to_live_days
        from racks join nation on n_nationkey = region_code
        where installed_date is not null
        group by all""",
    "opex": """
        select date_trunc('month', posting_date)::date as fiscal_month, cost_center_id,
               account_id, round(round(sum(amount_usd::decimal(28, 12)), 8), 2)::double as amount_usd
        from journal where account_id like '5%' group by all""",
    "new_orders": """
        select o_orderkey, o_orderstatus,
               if(o_orderstatus = 'P', o_totalprice + 1, o_totalprice) as o_totalprice
        from orders where not (o_orderstatus = 'F' and o_orderpriority = '5-LOW')
        union all
        select o_orderkey + 1000000000000, o_orderstatus, o_totalprice
        from orders where o_orderstatus = 'O'""",
}

# shapes that a shape is built from
NEEDS = {
    "bom": [],
    "rack_bom": ["bom", "skus"],
    "schedule": ["racks"],
    "receipts": ["purchase_orders"],
    "receipt_lines": ["receipts"],
    "scorecard": ["purchase_orders", "suppliers"],
    "capex": ["racks"],
    "opex": ["journal"],
}

STATEMENTS: dict[str, str] = {}


def _define(key: str, shapes: str, body: str) -> None:
    """Register a statement with the shapes it reads in front of it."""
    order: list[str] = []

    def add(name: str) -> None:
        for needed in NEEDS.get(name, []):
            add(needed)
        if name not in order:
            order.append(name)

    for name in shapes.split():
        add(name)
    parts = [f"{name} as ({SHAPES[name]})" for name in order]
    if not parts:
        STATEMENTS[key] = body.strip()
    elif body.lstrip().startswith("with recursive"):
        rest = body.lstrip().removeprefix("with recursive")
        STATEMENTS[key] = f"with recursive {', '.join(parts)}, {rest}"
    elif body.lstrip().startswith("with "):
        STATEMENTS[key] = f"with {', '.join(parts)}, {body.lstrip().removeprefix('with ')}"
    else:
        STATEMENTS[key] = f"with {', '.join(parts)} {body}"


# --- facts ------------------------------------------------------------------

_define("supplier_scorecard", "scorecard", "select * from scorecard")

_define(
    "price_variance",
    "purchase_orders",
    """
    with valued as (
        select date_trunc('month', received_date)::date as received_month,
               p_type as component_category, component_id, p_name as component_name,
               sum(qty_received)::bigint as qty_received,
               sum((qty_received * p_retailprice)::decimal(18, 6)) as standard,
               sum((qty_received * unit_cost_usd)::decimal(18, 6)) as paid
        from purchase_orders join part on p_partkey = component_id
        where status = 'Closed' and qty_received > 0
        group by all)
    select received_month, component_category, component_id, component_name, qty_received,
           round(standard, 2)::double as standard_value_usd,
           round(paid, 2)::double as actual_value_usd,
           round(paid - standard, 2)::double as ppv_usd,
           round(100.0::double * (paid - standard)::double / nullif(standard::double, 0), 2)
               + 0.0 as ppv_pct
    from valued""",
)

_define(
    "plan_vs_actual",
    "racks",
    """
    with planned as (
        select date_trunc('month', o_orderdate)::date as forecast_month,
               c_nationkey as region_code, o_orderpriority as sku_family,
               nullif(count(*) filter (where o_orderstatus = 'O'), 0) as plan_6m_racks,
               nullif(count(*) filter (where o_orderstatus = 'P'), 0) as commit_1m_racks
        from orders join customer on c_custkey = o_custkey
        group by all),
    requested as (
        select date_trunc('month', requested_date)::date as forecast_month, region_code,
               sku_family, count(*) as n
        from racks group by all)
    select p.*, coalesce(n, 0) as actual_racks,
           coalesce(n, 0) - plan_6m_racks as variance_vs_plan,
           coalesce(n, 0) - commit_1m_racks as variance_vs_commit,
           round(100.0::double * abs(variance_vs_plan) / plan_6m_racks, 1)
               as plan_abs_pct_error,
           round(100.0::double * abs(variance_vs_commit) / commit_1m_racks, 1)
               as commit_abs_pct_error
    from planned p left join requested using (forecast_month, region_code, sku_family)""",
)

_define(
    "days_of_supply",
    "racks bom skus brands",
    """
    with used as (
        select date_trunc('month', requested_date)::date as month, hub_id, component_id,
               sum(qty * units)::bigint as qty_consumed
        from racks join bom using (sku_id) join skus using (sku_id)
        group by all),
    stock as (
        select date_trunc('month', l_shipdate)::date as month, l_suppkey % 25 as hub_id,
               p_brand as component_id,
               (coalesce(sum(l_quantity) filter (where l_returnflag = 'N'), 0))::bigint as on_hand,
               (coalesce(sum(l_quantity) filter (where l_returnflag = 'A'), 0))::bigint as on_order,
               max(p_size)::bigint * 5 as age
        from lineitem join part on p_partkey = l_partkey
        group by all),
    numbered as (
        select s.*, coalesce(qty_consumed, 0) as used_qty,
               row_number() over (partition by hub_id, component_id order by month) as n
        from stock s left join used using (month, hub_id, component_id)),
    rolled as (
        select a.month, a.hub_id, a.component_id, a.on_hand, a.on_order, a.age, a.used_qty,
               avg(b.used_qty) as mean
        from numbered a join numbered b
          on b.hub_id = a.hub_id and b.component_id = a.component_id
         and b.n between a.n - 2 and a.n
        group by all)
    select last_day(month) as snapshot_date, hub_id, component_id, component_name,
           component_category, on_hand as on_hand_qty, on_order as on_order_qty,
           used_qty as qty_consumed, round(mean, 1) as avg_monthly_consumption_3m,
           round(on_hand / nullif(mean / 30.0, 0), 0) as days_of_supply,
           age as avg_age_days, round(on_hand * standard_cost, 2) as on_hand_value_usd,
           age > 180 as is_eo_risk
    from rolled join brands using (component_id)""",
)

_define("capex_by_region", "capex", "select * from capex")

_define(
    "budget_vs_actual",
    "journal chart centers",
    """
    with cells as (
        select date_trunc('month', posting_date)::date as fiscal_month, cost_center_id,
               account_id, amount_usd::decimal(18, 6) as booked, null::decimal(18, 6) as planned
        from journal where account_id <> '1400'
        union all
        select date_trunc('month', l_shipdate)::date, l_suppkey,
               if(l_linenumber % 2 = 0, '5100', '5200'), null,
               round(round(sum((l_extendedprice * l_tax * 10.0)::decimal(28, 12)), 8), 2)
        from lineitem where l_linestatus = 'F' group by 1, 2, 3),
    summed as (
        select fiscal_month, cost_center_id, account_id,
               coalesce(sum(booked), 0) as booked, sum(planned) as planned
        from cells group by all)
    select fiscal_month, cost_center_id, cost_center_name, org, region_code, account_id,
           account_name, round(booked, 2)::double as actual_usd,
           round(coalesce(planned, 0), 2)::double as budget_usd,
           round(booked - coalesce(planned, 0), 2)::double as variance_usd,
           round(100.0::double * (booked - coalesce(planned, 0))::double
                 / nullif(planned::double, 0), 1) + 0.0 as variance_pct
    from summed join centers using (cost_center_id) join chart using (account_id)""",
)

_define(
    "ap_aging",
    "",
    """
    with as_of as (select max(o_orderdate)::date as day from orders),
    unpaid as (
        select o_custkey as supplier_id, o_totalprice::decimal(18, 6) as amount,
               (select day from as_of) - (o_orderdate::date
                   + case o_orderpriority when '1-URGENT' then 30 when '2-HIGH' then 45
                                          else 60 end) as late
        from orders where o_orderstatus = 'O')
    select (select day from as_of) as as_of_date, supplier_id, c_name as supplier_name,
           case c_mktsegment when 'BUILDING' then 30 when 'MACHINERY' then 45 else 60 end::bigint
               as payment_terms_days,
           count(*) as open_invoices, round(sum(amount), 2)::double as open_usd,
           coalesce(round(sum(amount) filter (where late < 1), 2), 0)::double as current_usd,
           coalesce(round(sum(amount) filter (where late > 0 and late < 31), 2), 0)::double
               as past_due_1_30_usd,
           coalesce(round(sum(amount) filter (where late > 30 and late < 61), 2), 0)::double
               as past_due_31_60_usd,
           coalesce(round(sum(amount) filter (where late > 60 and late < 91), 2), 0)::double
               as past_due_61_90_usd,
           coalesce(round(sum(amount) filter (where late > 90), 2), 0)::double
               as past_due_over_90_usd
    from unpaid join customer on c_custkey = supplier_id
    group by all""",
)

# --- cleaned and joined rows ------------------------------------------------

_define(
    "enrich_po_lines",
    "purchase_orders suppliers",
    """
    select po.* exclude (line_number), supplier_name, supplier_category, strategic_flag,
           p_name as component_name, p_type as component_category,
           p_retailprice as standard_cost_usd,
           date_trunc('month', promised_date)::date as promised_month,
           coalesce(received_date <= promised_date, false) as is_on_time,
           qty_received >= qty_ordered as is_in_full,
           is_on_time and is_in_full as is_otif,
           received_date - promised_date as days_late,
           qty_received * unit_cost_usd as received_value_usd,
           qty_received * (unit_cost_usd - p_retailprice) as ppv_usd
    from purchase_orders po join suppliers using (supplier_id)
    join part on p_partkey = component_id""",
)

_define(
    "enrich_journal",
    "journal chart centers",
    """
    select journal.*, date_trunc('month', posting_date)::date as fiscal_month,
           account_name, account_type, cost_center_name, org, region_code
    from journal join chart using (account_id) join centers using (cost_center_id)""",
)

_define(
    "enrich_racks",
    "racks",
    """
    select racks.*, n_name as region_name,
           date_trunc('month', requested_date)::date as requested_month,
           date_trunc('month', live_date)::date as live_month,
           live_date - requested_date as request_to_live_days,
           installed_date - shipped_date as ship_to_install_days,
           capex_usd / useful_life_months as monthly_depreciation_usd
    from racks join nation on n_nationkey = region_code""",
)

# --- sources, sinks, loading ------------------------------------------------

_define("scan_table", "", "select l_orderkey, l_linenumber, l_partkey, l_quantity from lineitem")
_define("gold_roundtrip", "capex", "select * from capex")
_define("csv_roundtrip", "", "select * replace (o_orderdate::date as o_orderdate) from orders")

_COUNT = "select '{0}' as table_name, count(*) as row_count from {0}"
_LANDED = "region nation customer supplier part orders lineitem".split()
_OTHERS = "events documents embeddings pages benchmark labels conversations".split()
_define("land_bronze", "", " union all ".join(_COUNT.format(n) for n in _LANDED))
_define("row_counts", "", " union all ".join(_COUNT.format(n) for n in _LANDED + _OTHERS))

_define(
    "load_by_name",
    "",
    """
    select * replace (o_orderdate::date as o_orderdate,
                      if(o_orderstatus = 'O', o_orderpriority, null) as o_orderpriority)
    from orders""",
)
_define("load_mixed_files", "", STATEMENTS["load_by_name"])
_define("read_limit", "", "select least(count(*), 100) as row_count from orders")
_define("drop_private", "", "select * exclude (c_acctbal) from customer")
_define(
    "land_files",
    "",
    "select * from orders where o_orderstatus <> 'F' or o_orderpriority = '5-LOW'",
)
_define(
    "limit_rows",
    "",
    """
    select o_orderkey, o_totalprice, o_orderpriority from orders
    order by o_totalprice desc, o_orderkey limit 100""",
)
_define(
    "adhoc_sql",
    "scorecard",
    """
    select supplier_name, count(*) as months,
           round(sum(otif_pct::decimal(9, 1))::double / count(*), 1) as otif_pct
    from scorecard group by all""",
)

# --- data checks ------------------------------------------------------------

_define(
    "dq_not_null",
    "purchase_orders",
    """
    select po_line_id, status, received_date from purchase_orders
    where received_date is null""",
)
_define(
    "dq_unique",
    "",
    "select l_orderkey, count(*) as n from lineitem group by 1 having count(*) > 1",
)
_define(
    "dq_range",
    "",
    """
    select l_orderkey, l_linenumber, l_quantity from lineitem
    where l_quantity not between 5 and 45""",
)
_define(
    "dq_unique_combination",
    "",
    """
    select l_orderkey, l_linenumber, count(*) as n from lineitem
    group by 1, 2 having count(*) > 1""",
)
_define(
    "dq_report",
    "purchase_orders scorecard",
    """
    select 'lines' as table_name, 'not_null(po_line_id)' as check_name,
           (select count(*) from purchase_orders where po_line_id is null) as failures
    union all select 'lines', 'not_null(received_date)',
           (select count(*) from purchase_orders where received_date is null)
    union all select 'lines', 'range(qty_received)',
           (select count(*) from purchase_orders where qty_received < 0)
    union all select 'lines', 'range(qty_ordered)',
           (select count(*) from purchase_orders where qty_ordered < 5 or qty_ordered > 45)
    union all select 'lines', 'unique(po_number, line_number)',
           (select count(*) from (select 1 from purchase_orders
                                  group by po_number, line_number having count(*) > 1))
    union all select 'orders', 'not_null(o_custkey)',
           (select count(*) from orders where o_custkey is null)
    union all select 'orders', 'unique(o_orderkey)',
           (select count(*) from (select 1 from orders group by o_orderkey having count(*) > 1))
    union all select 'orders', 'unique(o_custkey)',
           (select count(*) from (select 1 from orders group by o_custkey having count(*) > 1))
    union all select 'scorecard', 'not_null(avg_days_late_when_late)',
           (select count(*) from scorecard where avg_days_late_when_late is null)
    union all select 'scorecard', 'range(otif_pct)',
           (select count(*) from scorecard where otif_pct not between 0 and 100)
    union all select 'scorecard', 'unique(promised_month, supplier_id)',
           (select count(*) from (select 1 from scorecard
                                  group by promised_month, supplier_id having count(*) > 1))""",
)

# --- months, bills of material, prices, balances ----------------------------

_define(
    "month_spine",
    "months",
    """
    select o_custkey, launched as launched_date, month, step::bigint as month_index
    from (select o_custkey, min(o_orderdate)::date as launched from orders group by all)
    join months on launched <= last_day(month)""",
)
_define(
    "censor_dates",
    "purchase_orders",
    """
    select po_line_id,
           if(promised_date <= date '1999-12-31', promised_date, null) as promised_date,
           if(received_date <= date '1999-12-31', received_date, null) as received_date,
           if(received_date <= date '1999-12-31', qty_received, 0) as qty_received,
           if(received_date <= date '1999-12-31', 'Closed', 'Open') as status
    from purchase_orders""",
)
_define("bom_explode", "rack_bom", "select * from rack_bom")
_define(
    "component_demand",
    "racks rack_bom",
    """
    select date_trunc('month', requested_date)::date as month, hub_id, component_id,
           sum(qty_per_rack)::bigint as qty_consumed
    from racks join rack_bom using (sku_id) group by all""",
)

_CURVE = """
    greatest(0.6::double, least(1.6::double, case {category}
        when 'ECONOMY' then 1.0::double + 0.012::double * step
             + 0.03::double * sin(step / 3.0::double)
        when 'SMALL' then 1.0::double - 0.015::double * step
             + 0.08::double * sin(step / 4.0::double + 1)
        else {other} end))"""

_define(
    "price_index",
    "months",
    f"""
    with moves as (
        select l_partkey as component_id, date_trunc('month', l_shipdate)::date as month,
               (sum(round(l_discount * 100) - 5) / 250.0::double)::decimal(18, 6) as drift
        from lineitem group by all),
    walked as (
        select p_partkey as component_id, p_type as category, month, step,
               (select coalesce(sum(drift), 0) from moves m
                where m.component_id = p_partkey and m.month >= date '1995-01-01'
                  and m.month <= months.month)::double as moved
        from part, months)
    select component_id, month,
           round({_CURVE.format(category="category", other="1.0::double + moved")}, 6)
               as price_index
    from walked""",
)
_define(
    "cost_rollup",
    "rack_bom brands months",
    f"""
    select sku_id, month,
           round(round(sum((standard_cost * {_CURVE.format(category="component_category", other="1")}
                      * qty_per_rack)::decimal(28, 12)), 8), 2)::double as rack_cost_usd
    from rack_bom join brands using (component_id), months
    group by all""",
)
_define(
    "expected_demand",
    "months",
    """
    select s_suppkey as cost_center_id, month, family as sku_family,
           round(140.0::double * (s_acctbal / 1000.0) * share
                 * (1.0::double + step * ((1.55::double - 1.0::double) / 77))
                 * if(family = 'GPU Accelerated', 0.7::double + step * ((1.6::double - 0.7::double) / 77), 1), 6)
               + 0.0 as expected_racks
    from supplier, months,
         (values ('General Compute', 0.42::double), ('High-Memory', 0.12::double),
                 ('GPU Accelerated', 0.31::double), ('Storage Dense', 0.15::double))
             as mix(family, share)""",
)
_define(
    "clamped_balance",
    "purchase_orders",
    """
    with recursive moves as (
        select supplier_id, date_trunc('month', day)::date as month, sum(qty)::bigint as delta
        from (select supplier_id, received_date as day, qty_received as qty
              from purchase_orders where received_date is not null
              union all
              select supplier_id, promised_date, -qty_ordered from purchase_orders)
        group by all),
    steps as (
        select *, row_number() over (partition by supplier_id order by month) as n from moves),
    walk as (
        select supplier_id, month, delta, n, greatest(500 + delta, 0) as balance
        from steps where n = 1
        union all
        select s.supplier_id, s.month, s.delta, s.n, greatest(w.balance + s.delta, 0)
        from walk w join steps s on s.supplier_id = w.supplier_id and s.n = w.n + 1)
    select supplier_id, month, delta, balance::bigint as balance from walk""",
)
_define(
    "open_balance",
    "purchase_orders months",
    """
    select supplier_id, month,
           coalesce(sum(qty_ordered) filter (
               where date_trunc('month', order_date) <= month
                 and (received_date is null or date_trunc('month', received_date) > month)),
               0)::bigint as open_qty
    from purchase_orders, months
    where month >= date '1996-04-01'
    group by all""",
)
_define(
    "open_balance_edges",
    "purchase_orders months",
    """
    with items as (
        select supplier_id, qty_ordered,
               date_trunc('month', case when line_number <> 3 then order_date end) as opened,
               date_trunc('month', case when line_number = 2 then order_date - 40
                                        else received_date end) as closed
        from purchase_orders)
    select supplier_id, month,
           coalesce(sum(qty_ordered) filter (
               where opened <= month and (closed is null or greatest(opened, closed) > month)),
               0)::bigint as open_qty
    from items, months
    where month >= date '1996-04-01'
    group by all""",
)
_define(
    "balance_grid",
    "purchase_orders suppliers months",
    """
    with moves as (
        select supplier_id, date_trunc('month', day)::date as month, sum(qty)::bigint as delta
        from (select supplier_id, received_date as day, qty_received as qty
              from purchase_orders where received_date is not null
              union all
              select supplier_id, promised_date, -qty_ordered from purchase_orders)
        group by all),
    owners as (
        select supplier_id, payment_terms_days from suppliers
        union all
        select c_custkey + 1000000000000,
               case c_mktsegment when 'BUILDING' then 30 when 'MACHINERY' then 45 else 60 end
        from customer),
    grid as (
        select supplier_id, month, coalesce(delta, 0)::bigint as delta,
               payment_terms_days * 10 + sum(coalesce(delta, 0)) over so_far as total
        from owners join months on month between date '1996-01-01' and date '1997-12-01'
             left join moves using (supplier_id, month)
        window so_far as (partition by supplier_id order by month))
    select supplier_id, month, delta,
           (total - least(0, min(total) over (partition by supplier_id order by month)))::bigint
               as balance
    from grid""",
)
_define(
    "bom_repeated",
    "bom skus",
    """
    with parts as (
        select sku_id, component_id, sum(2 * qty * units)::bigint as qty_per_rack
        from bom join skus using (sku_id) group by all),
    fixed as (
        select sku_id, component_id, qty
        from skus, (values ('Brand#1', 1), ('Brand#2', 64), ('FRAME', 2)) as f(component_id, qty)
        union all
        select sku_id, 'Brand#3', 1 from skus where sku_family = 'E')
    select sku_id, component_id, coalesce(f.qty, p.qty_per_rack)::bigint as qty_per_rack
    from parts p full join fixed f using (sku_id, component_id)""",
)
_define(
    "sequence_id",
    "",
    """
    select o_orderdate::date as order_date, o_orderkey, o_totalprice,
           'RCK-' || lpad((row_number() over (order by o_orderdate, o_orderkey))::varchar, 6, '0')
               as rack_id
    from orders""",
)
_define(
    "map_override",
    "",
    """
    select c_nationkey, c_custkey,
           case c_nationkey when 24 then 0 when 7 then 3 else n_regionkey end as hub_id
    from customer left join nation on n_nationkey = c_nationkey""",
)

# --- ledger -----------------------------------------------------------------

_define(
    "depreciation_schedule",
    "schedule",
    "select rack_id, posting_date, depreciation_usd from schedule",
)
_define(
    "depreciation_totals",
    "schedule",
    """
    select region_code, sku_family, posting_date, count(*) as assets,
           round(round(sum(depreciation_usd::decimal(28, 12)), 8), 2)::double as depreciation_usd
    from schedule group by all""",
)
_define(
    "schedule_to_window",
    "racks months",
    """
    select rack_id, last_day(month) as posting_date,
           capex_usd / useful_life_months as depreciation_usd
    from racks join months on month > date_trunc('month', installed_date)""",
)
_define(
    "depreciation_to_window",
    "racks months",
    """
    select region_code, sku_family, last_day(month) as posting_date, count(*) as assets,
           round(round(sum((capex_usd / useful_life_months)::decimal(28, 12)), 8), 2)::double
               as depreciation_usd
    from racks join months on month > date_trunc('month', installed_date)
    group by all""",
)
_define(
    "invoice_ids",
    "purchase_orders suppliers",
    """
    with closed as (
        select *, row_number() over (partition by po_number
                                     order by line_number, po_line_id) as n
        from purchase_orders where status = 'Closed'),
    billed as (
        select po_number, max(supplier_id) filter (where n = 1) as supplier_id,
               round(round(sum((qty_received * unit_cost_usd)::decimal(28, 12)), 8), 2)::double as amount_usd,
               row_number() over (order by po_number) - 1 as number
        from closed group by po_number)
    select 'INV-' || right(supplier_id::varchar, 3) || '-' || lpad(number::varchar, 6, '0')
               as invoice_id, po_number, supplier_id, amount_usd
    from billed join suppliers using (supplier_id)
    where amount_usd > 0""",
)
_define(
    "invoice_rollup",
    "purchase_orders suppliers",
    """
    with closed as (
        select *, row_number() over (partition by po_number
                                     order by line_number, po_line_id) as n
        from purchase_orders where status = 'Closed'),
    billed as (
        select po_number, max(received_date) + 3 as invoice_date,
               max(supplier_id) filter (where n = 1) as supplier_id,
               round(round(sum((qty_received * unit_cost_usd)::decimal(28, 12)), 8), 2)::double as amount_usd
        from closed group by all)
    select po_number, supplier_id, invoice_date,
           invoice_date + payment_terms_days::int as due_date, amount_usd, 'USD' as currency
    from billed join suppliers using (supplier_id)
    where amount_usd > 0""",
)
_define("post_receipts", "receipt_lines", "select * from receipt_lines")
_define(
    "post_capitalization",
    "racks",
    """
    select installed_date as posting_date, rack_id as reference, 'Capitalization' as source,
           line, if(line = 1, '1500', '1400') as account_id,
           if(line = 1, 'CC-' || lpad(region_code::varchar, 2, '0'), 'CC-1100') as cost_center_id,
           if(line = 1, 1, -1) * round(capex_usd, 2) as amount_usd,
           if(line = 1, 'Rack in service ' || sku_id, 'Inventory relief') as memo
    from racks, (select unnest([1, 2]) as line)
    where installed_date is not null""",
)
_define(
    "post_depreciation",
    "schedule",
    """
    select posting_date, account_id, 'CC-' || lpad(region_code::varchar, 2, '0') as cost_center_id,
           'Depreciation' as source, count(*) as lines,
           round(round(sum((side * round(depreciation_usd, 2))::decimal(28, 12)), 8), 2)::double
               as amount_usd
    from schedule, (values ('5100', 1), ('1590', -1)) as sides(account_id, side)
    group by all""",
)
_define(
    "post_depreciation_lines",
    "schedule",
    """
    select posting_date, rack_id as reference, 'Depreciation' as source, line,
           if(line = 1, '5100', '1590') as account_id,
           'CC-' || lpad(region_code::varchar, 2, '0') as cost_center_id,
           if(line = 1, 1, -1) * round(depreciation_usd, 2) as amount_usd,
           'Straight-line' as memo
    from schedule, (select unnest([1, 2]) as line)""",
)
_define(
    "assemble_journal",
    "receipt_lines racks",
    """
    with loss as (
        select date_trunc('month', l_shipdate)::date as month,
               round(round(sum((l_extendedprice * l_discount)::decimal(28, 12)), 8), 2)::double as amount
        from lineitem where l_returnflag = 'R' group by all),
    lines as (
        select posting_date, account_id, cost_center_id, amount_usd, source,
               reference::varchar as reference, memo, line
        from receipt_lines
        union all
        select installed_date, if(line = 1, '1500', '1400'),
               if(line = 1, 'CC-' || lpad(region_code::varchar, 2, '0'), 'CC-1100'),
               if(line = 1, 1, -1) * round(capex_usd, 2), 'Capitalization', rack_id::varchar,
               if(line = 1, 'Rack in service ' || sku_id, 'Inventory relief'), line
        from racks, (select unnest([1, 2]) as line) where installed_date is not null
        union all
        select last_day(month), if(line = 1, '5700', '1400'), 'CC-1100',
               if(line = 1, amount, -amount), 'Adjustment', 'EO-' || strftime(month, '%Y-%m'),
               'Excess & obsolete reserve', line
        from loss, (select unnest([1, 2]) as line) where date_part('month', month) % 3 = 0)
    select 'JE-' || lpad((row_number() over (order by posting_date, source, reference, line,
                              account_id, cost_center_id))::varchar, 8, '0') as journal_id,
           * exclude (line)
    from lines""",
)
_define(
    "post_writedowns",
    "",
    """
    with loss as (
        select date_trunc('month', l_shipdate)::date as month,
               round(round(sum((l_extendedprice * l_discount)::decimal(28, 12)), 8), 2)::double as amount
        from lineitem where l_returnflag = 'R' group by all)
    select last_day(month) as posting_date, 'EO-' || strftime(month, '%Y-%m') as reference,
           'Adjustment' as source, line, if(line = 1, '5700', '1400') as account_id,
           'CC-1100' as cost_center_id, if(line = 1, amount, -amount) as amount_usd,
           'Excess & obsolete reserve' as memo
    from loss, (select unnest([1, 2]) as line)
    where date_part('month', month) % 3 = 0""",
)
_define(
    "recurring_accruals",
    "months",
    f"""
    select last_day(month) as posting_date, account_id, s_suppkey as cost_center_id,
           round(base * (s_acctbal / 1000.0) * (1.0::double + step * ((1.55::double - 1.0::double) / 77))
                 * if(account_id = '5200',
                      1 + 0.12::double * sin((date_part('month', month) - 1) / 12.0::double
                                             * {2 * math.pi!r}::double - 1.2::double), 1),
                 2) + 0.0 as amount_usd,
           'Accrual' as source, s_suppkey || '-' || strftime(month, '%Y-%m') as reference,
           account_id || ' monthly accrual' as memo
    from supplier, months,
         (values ('5200', 7500000.0::double), ('5300', 3800000.0::double),
                 ('5400', 1600000.0::double), ('5500', 900000.0::double),
                 ('5800', 180000.0::double)) as rates(account_id, base)""",
)
_define(
    "global_accruals",
    "months",
    """
    select last_day(month) as posting_date, account_id, s_suppkey as cost_center_id,
           base as amount_usd, source, s_suppkey || '-' || strftime(month, '%Y-%m') as reference, memo
    from supplier, months,
         (values ('5400', 420000.0::double, 'Payroll', 'Salaries & benefits'),
                 ('5800', 35000.0::double, 'Accrual', 'Consulting / services'))
             as rates(account_id, base, source, memo)""",
)
_define("opex_by_month", "opex", "select * from opex")
_define(
    "derive_budget",
    "opex",
    """
    select strftime(fiscal_month, '%Y-%m-%d') as fiscal_month, cost_center_id, account_id,
           round(amount_usd * if(account_id = '5100', 0.94::double, 1.02::double), 2) + 0.0
               as budget_usd
    from opex""",
)
_define(
    "tie_out",
    "purchase_orders receipt_lines",
    """
    with owed as (
        select po_line_id as reference,
               sum((-qty_received * unit_cost_usd)::decimal(18, 6)) as expected
        from purchase_orders where status = 'Closed' group by all),
    posted as (
        select reference, sum(amount_usd::decimal(18, 6)) as posted
        from receipt_lines where account_id = '2100' group by all)
    select reference, round(coalesce(expected, 0), 2)::double as expected_usd,
           round(coalesce(posted, 0), 2)::double as posted_usd,
           round(coalesce(expected, 0) - coalesce(posted, 0), 2)::double as difference_usd
    from owed full join posted using (reference)""",
)

_define(
    "tie_out_breaks",
    "purchase_orders receipt_lines",
    """
    with owed as (
        select po_line_id as reference,
               sum((-qty_received * unit_cost_usd)::decimal(18, 6)) as expected
        from purchase_orders where status = 'Closed' group by all),
    posted as (
        select reference,
               sum(((split_part(reference, '-', 1)::bigint % 7 <> 0)::int
                    + (split_part(reference, '-', 1)::bigint % 11 = 0)::int)
                   * amount_usd::decimal(18, 6)) as posted
        from receipt_lines where account_id = '2100' group by all),
    ties as (
        select reference, round(coalesce(expected, 0), 2)::double as expected_usd,
               round(coalesce(posted, 0), 2)::double as posted_usd,
               round(coalesce(expected, 0) - coalesce(posted, 0), 2)::double as difference_usd
        from owed full join posted using (reference))
    select * from ties where abs(difference_usd) > 0.005""",
)

# --- incremental loads, history, change sets --------------------------------

_GAPPY = """
    with gappy as (
        select journal_id, if(memo = 'line 5', null, posting_date) as posting_date, amount_usd, memo
        from journal),
    loaded as (
        select * from gappy where posting_date <= date '1999-12-31' and memo <> 'line 7')
    select * from gappy
    where journal_id not in (select journal_id from loaded) and """
_define(
    "append_undated",
    "journal",
    _GAPPY + "(posting_date is null or posting_date >= (select max(posting_date) from loaded))",
)
_define(
    "append_skipped", "journal", _GAPPY + "posting_date < (select max(posting_date) from loaded)"
)
_define(
    "backfill_emptied",
    "capex",
    "select * from capex where in_service_month <> date '1998-11-01'",
)

_define(
    "incremental_append",
    "journal",
    """
    with loaded as (
        select journal_id, posting_date from journal
        where posting_date <= date '1999-12-31' and memo <> 'line 7')
    select journal_id, posting_date, account_id, amount_usd, memo from journal
    where posting_date >= (select max(posting_date) - 31 from loaded)
      and journal_id not in (select journal_id from loaded)""",
)
_define(
    "date_dim",
    "",
    """
    with span as (
        select unnest(generate_series(min(o_orderdate)::date, max(o_orderdate)::date,
                                      interval 1 day))::date as date
        from orders)
    select date, strftime(date, '%Y%m%d')::bigint as date_key, year(date) as year,
           quarter(date) as quarter, month(date) as month, day(date) as day_of_month,
           dayofyear(date) as day_of_year, isodow(date) as day_of_week, week(date) as iso_week,
           date_trunc('month', date)::date as month_start, last_day(date) as month_end,
           isodow(date) > 5 as is_weekend, date = last_day(date) as is_month_end
    from span""",
)
_define(
    "scd2_merge",
    "",
    """
    with snapshot as (
        select c_custkey, if(c_acctbal < 0, 'WATCHED', c_mktsegment) as segment,
               if(c_acctbal < 0, null, c_acctbal) as balance
        from customer where c_mktsegment <> 'FURNITURE'
        union all
        select c_custkey + 1000000000000, c_mktsegment, c_acctbal
        from customer where c_mktsegment = 'BUILDING')
    select c_custkey, 'PROSPECT' as c_mktsegment, null::double as c_acctbal,
           date '1994-01-01' as valid_from, date '1995-01-01' as valid_to, false as is_current
    from customer where c_acctbal > 5000
    union all
    select c_custkey, c_mktsegment, c_acctbal, date '1995-01-01',
           if(c_acctbal >= 0 and c_mktsegment <> 'FURNITURE', null, date '1997-07-01'),
           c_acctbal >= 0 and c_mktsegment <> 'FURNITURE'
    from customer
    union all
    select s.c_custkey, segment, balance, date '1997-07-01', null, true
    from snapshot s left join customer c on c.c_custkey = s.c_custkey
    where (c.c_mktsegment, c.c_acctbal) is distinct from (s.segment, s.balance)""",
)
_define(
    "table_diff",
    "new_orders",
    """
    select o_orderkey, o_orderstatus, o_totalprice, 'insert' as change from new_orders
    where o_orderkey not in (select o_orderkey from orders)
    union all
    select o_orderkey, o_orderstatus, o_totalprice, 'delete' from orders
    where o_orderkey not in (select o_orderkey from new_orders)
    union all
    select n.o_orderkey, n.o_orderstatus, n.o_totalprice, 'update'
    from new_orders n join orders o using (o_orderkey)
    where n.o_totalprice <> o.o_totalprice or n.o_orderstatus <> o.o_orderstatus""",
)
_define("apply_changes", "new_orders", "select * from new_orders")
_define(
    "partition_backfill",
    "capex",
    """
    select * replace (
        if(in_service_month in (date '1996-03-01', date '1998-11-01', date '2001-02-01'),
           0, capex_usd) as capex_usd)
    from capex""",
)
_define("checksum_diff", "", STATEMENTS["table_diff"])
_define("scorecard_rollup", "scorecard", "select * from scorecard")
_define("capex_rollup", "capex", "select * from capex")
_define(
    "replace_months",
    "capex",
    """
    select * replace (
        if(in_service_month in (date '1996-03-01', date '2001-02-01'), 0, capex_usd) as capex_usd)
    from capex where in_service_month <> date '1998-11-01'""",
)
_define(
    "bucketed_lines",
    "purchase_orders suppliers",
    """
    select supplier_id, supplier_category, count(*) as po_lines, sum(qty_received)::bigint as qty_received
    from purchase_orders join suppliers using (supplier_id) where status = 'Closed' group by all""",
)
_define("append_batches", "journal", "select journal_id, posting_date, amount_usd, memo from journal")
_SNAPSHOTS = """
    with days as (
        select unnest([date '1993-07-01', date '1995-01-01', date '1996-06-01', date '1998-01-01']) as as_of),
    numbered as (select as_of, row_number() over (order by as_of) as k, lead(as_of) over (order by as_of) as until
                 from days),
    seen as (
        select o_custkey, as_of, k, until, o_orderpriority as priority,
               count(*) over (partition by o_custkey, as_of) as orders,
               row_number() over (partition by o_custkey, as_of order by o_orderdate desc, o_orderkey desc) as place
        from orders join numbered on o_orderdate::date <= as_of and o_orderdate::date > as_of - 730),
    states as (select * from seen where place = 1)"""
_define(
    "scd2_late",
    "",
    _SNAPSHOTS
    + """,
    islands as (
        select *, k - row_number() over (partition by o_custkey, priority order by k) as island from states)
    select o_custkey, priority, min(as_of) as valid_from,
           nullif(max(coalesce(until, date '9999-12-31')), date '9999-12-31') as valid_to, max(k) = 4 as is_current
    from islands group by o_custkey, priority, island""",
)
_define(
    "orders_as_of",
    "",
    _SNAPSHOTS
    + """
    select o.o_orderkey, o.o_custkey, o.o_orderdate::date as order_date, o.o_totalprice,
           s.priority as known_priority, s.orders as known_orders
    from orders o left join states s
      on s.o_custkey = o.o_custkey and o.o_orderdate::date >= s.as_of
         and o.o_orderdate::date < coalesce(s.until, date '9999-12-31')""",
)
_define(
    "ingest_drift",
    "",
    """
    select o_orderkey, o_custkey, if(o_custkey % 3 = 1, o_totalprice, null) as o_totalprice,
           if(o_custkey % 3 = 2, o_orderstatus, null) as o_orderstatus
    from orders""",
)
_define("ingest_stream", "", "select * from events")
