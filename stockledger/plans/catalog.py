"""Every registered query: an operator over the test tables, in full."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockledger import settings
from stockledger.functions import exact_sum, month_of, round_half_away, to_cents
from stockledger.operators import gold, history, incremental, ledger, quality, silver, supply
from stockledger import fixed_values as fixed
from stockledger.plans import rollups
from stockledger.sources import published
from stockledger.sources import tables as lake
from stockledger.sources.trial import LAYOUT, MONTHS, TABLES, WINDOW_END, WINDOW_START, Trial
from stockledger.streaming import drift, ingest

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

INFRA = {"Brand#1": 1, "Brand#2": 64, "FRAME": 2}
FAMILY_INFRA = {"E": {"Brand#3": 1}}
PRICE_PATHS = {"ECONOMY": (0.012, 0.03, 3, 0), "SMALL": (-0.015, 0.08, 4, 1)}
# added to the ids of owners that have stock and no moves
STILL = 1_000_000_000_000
BACKFILL_MONTHS = ["1996-03-01", "1998-11-01", "2001-02-01"]


def query(build: Callable[[Trial], DataFrame]) -> Callable[[Trial], DataFrame]:
    """Register a query under the name of its function."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        return build(Trial(settings.tune(spark, folder), folder))

    QUERIES[build.__name__] = run
    return build


# --- facts ------------------------------------------------------------------


@query
def supplier_scorecard(t: Trial) -> DataFrame:
    lines = silver.flag_po_lines(t.purchase_orders())
    return gold.supplier_scorecard(lines, t.suppliers(), t.components())


@query
def price_variance(t: Trial) -> DataFrame:
    return gold.price_variance(t.purchase_orders(), t.components(), t.suppliers())


@query
def plan_vs_actual(t: Trial) -> DataFrame:
    return gold.plan_vs_actual(t.forecast(), t.racks())


@query
def days_of_supply(t: Trial) -> DataFrame:
    used = supply.component_demand(t.racks(), supply.explode_bom(t.bom(), t.skus()))
    return gold.days_of_supply(t.snapshots(), used, t.brands())


@query
def capex_by_region(t: Trial) -> DataFrame:
    return gold.capex_by_region(silver.measure_racks(t.racks()), t.regions())


@query
def budget_vs_actual(t: Trial) -> DataFrame:
    return gold.budget_vs_actual(t.journal(), t.budget(), t.accounts(), t.cost_centers())


@query
def ap_aging(t: Trial) -> DataFrame:
    return gold.aging(t.invoices(), t.customers_as_payees())


# --- cleaned and joined rows ------------------------------------------------


@query
def enrich_po_lines(t: Trial) -> DataFrame:
    return silver.enrich_po_lines(t.purchase_orders(), t.suppliers(), t.components())


@query
def enrich_journal(t: Trial) -> DataFrame:
    return silver.enrich_journal(t.journal(), t.accounts(), t.cost_centers())


@query
def enrich_racks(t: Trial) -> DataFrame:
    return silver.enrich_racks(t.racks(), t.regions())


# --- sources, sinks, loading ------------------------------------------------


@query
def scan_table(t: Trial) -> DataFrame:
    lines = lake.read_table(t.spark, t.folder, "lineitem", layout=LAYOUT)
    return lines.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")


@query
def gold_roundtrip(t: Trial) -> DataFrame:
    root = settings.scratch(t.spark, "gold")
    lake.write_table(capex_by_region(t), root, "gold", "fct_capex_by_region")
    return lake.read_table(t.spark, root, "fct_capex_by_region", "gold")


@query
def csv_roundtrip(t: Trial) -> DataFrame:
    orders = t.table("orders").withColumn("o_orderdate", F.col("o_orderdate").cast("date"))
    paths = lake.export_table(orders, settings.scratch(t.spark, "extract"), "orders")
    return lake.read_csv(t.spark, paths["csv"], orders.schema)


@query
def land_bronze(t: Trial) -> DataFrame:
    sources = {name: f"{t.folder}/{name}.parquet" for name in TABLES}
    wanted = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]
    root = settings.scratch(t.spark, "bronze")
    return lake.row_counts(lake.land_bronze(t.spark, sources, root, wanted))


@query
def load_by_name(t: Trial) -> DataFrame:
    orders = t.table("orders").withColumn("o_orderdate", F.col("o_orderdate").cast("date"))
    is_open = F.col("o_orderstatus") == "O"
    shouted = [F.col(name).alias(name.upper()) for name in reversed(orders.columns)]
    root = settings.scratch(t.spark, "extracts")
    orders.filter(is_open).select(*shouted).write.parquet(f"{root}/open")
    orders.filter(~is_open).drop("o_orderpriority").write.parquet(f"{root}/rest")
    return lake.load_by_name(t.spark, [f"{root}/open", f"{root}/rest"], orders.schema)


@query
def row_counts(t: Trial) -> DataFrame:
    return lake.row_counts({name: t.table(name) for name in TABLES})


@query
def limit_rows(t: Trial) -> DataFrame:
    return t.table("orders").select("o_orderkey", "o_totalprice", "o_orderpriority").orderBy(
        F.desc("o_totalprice"), "o_orderkey"
    ).limit(100)


@query
def read_limit(t: Trial) -> DataFrame:
    """How many rows a read with a cap of a hundred gives."""
    capped = lake.read_table(t.spark, t.folder, "orders", layout=LAYOUT, limit=100)
    return capped.agg(F.count("*").alias("row_count"))


@query
def drop_private(t: Trial) -> DataFrame:
    marked = t.table("customer").withColumns({"_loaded": F.lit(1), "_file": F.lit("a")})
    return lake.drop_private(marked, ["c_acctbal"])


@query
def load_mixed_files(t: Trial) -> DataFrame:
    """Files of one folder that differ in their columns, whichever of them comes first."""
    orders = t.table("orders").withColumn("o_orderdate", F.col("o_orderdate").cast("date"))
    is_open = F.col("o_orderstatus") == "O"
    root = settings.scratch(t.spark, "mixed")
    orders.filter(is_open).write.parquet(root)
    orders.filter(~is_open).drop("o_orderpriority").write.mode("append").parquet(root)
    return lake.load_by_name(t.spark, [root], orders.schema)


@query
def land_files(t: Trial) -> DataFrame:
    """Orders by status in three files, of which one is landed again."""
    root = settings.scratch(t.spark, "landed")
    orders = t.table("orders")
    status = F.col("o_orderstatus")
    for key in ("F", "O", "P"):
        orders.filter(status == key).write.parquet(f"{root}/raw/{key}")
    lake.land_files(t.spark, {key: f"{root}/raw/{key}" for key in ("F", "O", "P")}, root, "orders")
    orders.filter((status == "F") & (F.col("o_orderpriority") == "5-LOW")).write.parquet(f"{root}/again")
    return lake.drop_private(lake.land_files(t.spark, {"F": f"{root}/again"}, root, "orders"))


@query
def adhoc_sql(t: Trial) -> DataFrame:
    # a name of its own: the session may have a view of the fact
    lake.register_views({"_adhoc_supplier_otif": supplier_scorecard(t)})
    return t.spark.sql(
        """
        select supplier_name,
               count(*) as months,
               floor(cast(sum(cast(otif_pct as decimal(9, 1))) as double) / count(*) * 10 + 0.5)
                   / 10 as otif_pct
        from _adhoc_supplier_otif
        group by supplier_name
        order by otif_pct
        """
    )


# --- data checks ------------------------------------------------------------


@query
def dq_not_null(t: Trial) -> DataFrame:
    lines = t.purchase_orders().select("po_line_id", "status", "received_date")
    return quality.check_not_null(lines, "received_date")


@query
def dq_unique(t: Trial) -> DataFrame:
    return quality.check_unique(t.table("lineitem"), "l_orderkey")


@query
def dq_range(t: Trial) -> DataFrame:
    lines = t.table("lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return quality.check_range(lines, "l_quantity", min_value=5, max_value=45)


@query
def dq_unique_combination(t: Trial) -> DataFrame:
    return quality.check_unique_combination(t.table("lineitem"), ["l_orderkey", "l_linenumber"])


@query
def dq_report(t: Trial) -> DataFrame:
    tables = {
        "lines": t.purchase_orders(),
        "orders": t.table("orders"),
        "scorecard": supplier_scorecard(t),
    }
    spec = {
        "lines": quality.Checks(
            not_null=["po_line_id", "received_date"],
            ranges={"qty_received": (0, None), "qty_ordered": (5, 45)},
            unique_combinations=[["po_number", "line_number"]],
        ),
        "orders": quality.Checks(not_null=["o_custkey"], unique=["o_orderkey", "o_custkey"]),
        "scorecard": quality.Checks(
            not_null=["avg_days_late_when_late"],
            ranges={"otif_pct": (0, 100)},
            unique_combinations=[["promised_month", "supplier_id"]],
        ),
    }
    return quality.run_checks(tables, spec)


# --- months, bills of material, prices, balances ----------------------------


@query
def month_spine(t: Trial) -> DataFrame:
    first_order = t.table("orders").groupBy("o_custkey").agg(
        F.min(F.col("o_orderdate").cast("date")).alias("launched_date")
    )
    return supply.month_spine(first_order, WINDOW_START, WINDOW_END, "launched_date")


@query
def censor_dates(t: Trial) -> DataFrame:
    lines = t.purchase_orders().select(
        "po_line_id", "promised_date", "received_date", "qty_received"
    )
    closed = supply.derive_status(lines, "received_date", "qty_received", "1999-12-31")
    return supply.censor_after(closed, ["promised_date"], "1999-12-31")


def _rack_bom(t: Trial) -> DataFrame:
    return supply.explode_bom(t.bom(), t.skus(), INFRA, FAMILY_INFRA)


@query
def bom_explode(t: Trial) -> DataFrame:
    return _rack_bom(t)


@query
def component_demand(t: Trial) -> DataFrame:
    return supply.component_demand(t.racks(), _rack_bom(t))


@query
def price_index(t: Trial) -> DataFrame:
    index = supply.price_index(
        t.components(), WINDOW_START, WINDOW_END, PRICE_PATHS, t.monthly_drift()
    )
    return index.withColumn("price_index", round_half_away("price_index", 6))


@query
def cost_rollup(t: Trial) -> DataFrame:
    brands = t.brands()
    prices = supply.price_index(brands, WINDOW_START, WINDOW_END, PRICE_PATHS)
    return supply.rack_cost(_rack_bom(t), brands, prices)


@query
def expected_demand(t: Trial) -> DataFrame:
    spine = supply.month_spine(t.weighted_centers(), WINDOW_START, WINDOW_END)
    demand = supply.expected_demand(
        spine, fixed.FAMILY_MIX, fixed.BASE_RACKS, MONTHS, fixed.GROWTH, fixed.FAMILY_RAMPS
    )
    return demand.select(
        "cost_center_id",
        "month",
        "sku_family",
        round_half_away("expected_racks", 6).alias("expected_racks"),
    )


@query
def clamped_balance(t: Trial) -> DataFrame:
    """Stock per supplier: receipts in, orders out in their promised month."""
    moves = F.array(
        F.struct(month_of("received_date").alias("month"), F.col("qty_received").alias("delta")),
        F.struct(month_of("promised_date").alias("month"), (-F.col("qty_ordered")).alias("delta")),
    )
    delta = t.purchase_orders().select("supplier_id", F.inline(moves))
    return supply.clamped_balance(
        delta.filter(F.col("month").isNotNull()), ["supplier_id"], "month", "delta", 500
    )


@query
def open_balance(t: Trial) -> DataFrame:
    return supply.open_balance(
        t.purchase_orders(),
        ["supplier_id"],
        "order_date",
        "received_date",
        "qty_ordered",
        "1996-04-01",
        WINDOW_END,
    )


@query
def open_balance_edges(t: Trial) -> DataFrame:
    """Items that were never opened, and items that were closed before they were opened."""
    number = F.col("line_number")
    items = t.purchase_orders().withColumns(
        {
            "opened": F.when(number != 3, F.col("order_date")),
            "closed": F.when(number == 2, F.date_sub("order_date", 40)).otherwise(F.col("received_date")),
        }
    )
    return supply.open_balance(
        items, ["supplier_id"], "opened", "closed", "qty_ordered", "1996-04-01", WINDOW_END
    )


@query
def balance_grid(t: Trial) -> DataFrame:
    """Every month of every supplier, and of payees whose stock never moves."""
    moves = F.array(
        F.struct(month_of("received_date").alias("month"), F.col("qty_received").alias("delta")),
        F.struct(month_of("promised_date").alias("month"), (-F.col("qty_ordered")).alias("delta")),
    )
    delta = t.purchase_orders().select("supplier_id", F.inline(moves)).filter(F.col("month").isNotNull())
    still = t.customers_as_payees().withColumn("supplier_id", F.col("supplier_id") + STILL)
    owners = t.suppliers().select("supplier_id", "payment_terms_days").unionByName(
        still.select("supplier_id", "payment_terms_days")
    )
    stock = owners.select("supplier_id", (F.col("payment_terms_days") * 10).alias("opening"))
    return supply.clamped_balance(
        delta, ["supplier_id"], "month", "delta", months=("1996-01-01", "1997-12-31"), stock=stock
    )


@query
def bom_repeated(t: Trial) -> DataFrame:
    """Bills of material that name each part in two rows."""
    twice = t.bom().unionByName(t.bom())
    return supply.explode_bom(twice, t.skus(), INFRA, FAMILY_INFRA)


@query
def sequence_id(t: Trial) -> DataFrame:
    orders = t.table("orders").select(
        F.col("o_orderdate").cast("date").alias("order_date"), "o_orderkey", "o_totalprice"
    )
    return supply.sequence_id(orders, ["order_date", "o_orderkey"], fixed.RACK_ID, "rack_id")


@query
def map_override(t: Trial) -> DataFrame:
    customers = t.table("customer").select("c_custkey", "c_nationkey")
    hubs = t.table("nation").select(
        F.col("n_nationkey").alias("c_nationkey"), F.col("n_regionkey").alias("hub_id")
    )
    return supply.map_with_override(customers, hubs, "c_nationkey", "hub_id", {24: 0, 7: 3})


# --- ledger -----------------------------------------------------------------


@query
def depreciation_schedule(t: Trial) -> DataFrame:
    return ledger.depreciation_schedule(t.racks(), WINDOW_END, cap_at_life=True).select(
        "rack_id", "posting_date", "depreciation_usd"
    )


@query
def depreciation_totals(t: Trial) -> DataFrame:
    return ledger.depreciation_totals(
        t.racks(), ["region_code", "sku_family"], WINDOW_END, cap_at_life=True
    )


@query
def depreciation_to_window(t: Trial) -> DataFrame:
    """Depreciation up to the window's end, whatever an asset's life."""
    return ledger.depreciation_totals(t.racks(), ["region_code", "sku_family"], WINDOW_END)


@query
def schedule_to_window(t: Trial) -> DataFrame:
    return ledger.depreciation_schedule(t.racks(), WINDOW_END).select(
        "rack_id", "posting_date", "depreciation_usd"
    )


@query
def invoice_ids(t: Trial) -> DataFrame:
    invoices = ledger.invoice_rollup(
        t.purchase_orders(), t.suppliers(), ["line_number", "po_line_id"], 3, fixed.INVOICE_ID
    )
    return invoices.select("invoice_id", "po_number", "supplier_id", "amount_usd")


@query
def invoice_rollup(t: Trial) -> DataFrame:
    return ledger.invoice_rollup(
        t.purchase_orders(), t.suppliers(), ["line_number", "po_line_id"], lag_days=3
    )


@query
def post_receipts(t: Trial) -> DataFrame:
    return ledger.post_receipts(t.purchase_orders(), t.components())


@query
def post_capitalization(t: Trial) -> DataFrame:
    return ledger.post_capitalization(t.racks(), t.region_centers())


@query
def post_depreciation(t: Trial) -> DataFrame:
    """Depreciation postings, summed to what a trial balance shows."""
    schedule = ledger.depreciation_schedule(t.racks(), WINDOW_END, cap_at_life=True)
    postings = ledger.post_depreciation(schedule, t.region_centers())
    return postings.groupBy("posting_date", "account_id", "cost_center_id", "source").agg(
        F.count("*").alias("lines"), to_cents(exact_sum("amount_usd")).alias("amount_usd")
    )


@query
def post_depreciation_lines(t: Trial) -> DataFrame:
    """All postings, line by line."""
    schedule = ledger.depreciation_schedule(t.racks(), WINDOW_END, cap_at_life=True)
    return ledger.post_depreciation(schedule, t.region_centers())


@query
def assemble_journal(t: Trial) -> DataFrame:
    """Receipts, capitalised racks and write-downs as one numbered journal."""
    return ledger.assemble_journal([post_receipts(t), post_capitalization(t), post_writedowns(t)])


@query
def post_writedowns(t: Trial) -> DataFrame:
    returned = t.table("lineitem").filter(F.col("l_returnflag") == "R")
    loss = F.col("l_extendedprice") * F.col("l_discount")
    monthly = returned.groupBy(month_of(F.col("l_shipdate").cast("date")).alias("month")).agg(
        to_cents(exact_sum(loss)).alias("amount_usd")
    )
    return ledger.post_writedowns(monthly)


@query
def recurring_accruals(t: Trial) -> DataFrame:
    spine = supply.month_spine(t.weighted_centers(), WINDOW_START, WINDOW_END)
    return ledger.recurring_accruals(
        spine, fixed.REGION_RUN_RATE, MONTHS, fixed.GROWTH, fixed.SEASONS, "demand_weight"
    )


@query
def global_accruals(t: Trial) -> DataFrame:
    """Flat run rates of every centre, without growth, season or weight."""
    spine = supply.month_spine(t.weighted_centers(), WINDOW_START, WINDOW_END)
    return ledger.recurring_accruals(spine, fixed.GLOBAL_RUN_RATE)


@query
def opex_by_month(t: Trial) -> DataFrame:
    return ledger.opex_by_month(t.journal())


@query
def derive_budget(t: Trial) -> DataFrame:
    actuals = ledger.opex_by_month(t.journal())
    return ledger.derive_budget(actuals, {"5100": 0.94}, fixed.DEFAULT_BUDGET_FACTOR)


@query
def tie_out(t: Trial) -> DataFrame:
    lines = t.purchase_orders()
    journal = ledger.post_receipts(lines, t.components())
    owed = lines.filter(F.col("status") == "Closed").select(
        "po_line_id", (-F.col("qty_received") * F.col("unit_cost_usd")).alias("owed_usd")
    )
    return ledger.tie_out(owed, journal, "po_line_id", "owed_usd", "2100")


@query
def tie_out_breaks(t: Trial) -> DataFrame:
    """A journal that lacks some lines' payables and has others' twice."""
    lines = t.purchase_orders()
    posted = ledger.post_receipts(lines, t.components())
    order = F.split_part(F.col("reference"), F.lit("-"), F.lit(1)).cast("long")
    journal = posted.filter(order % 7 != 0).unionByName(posted.filter(order % 11 == 0))
    owed = lines.filter(F.col("status") == "Closed").select(
        "po_line_id", (-F.col("qty_received") * F.col("unit_cost_usd")).alias("owed_usd")
    )
    return ledger.tie_out(owed, journal, "po_line_id", "owed_usd", "2100").filter(
        F.abs("difference_usd") > 0.005
    )


# --- incremental loads, history, change sets --------------------------------


def _gappy_journal(t: Trial) -> tuple[DataFrame, DataFrame]:
    """A journal whose fifth lines have no date, and what is loaded of it."""
    journal = t.journal().select("journal_id", "posting_date", "amount_usd", "memo")
    undated = F.col("memo") == "line 5"
    journal = journal.withColumn("posting_date", F.when(~undated, F.col("posting_date")))
    loaded = journal.filter(
        (F.col("posting_date") <= F.lit("1999-12-31").cast("date")) & (F.col("memo") != "line 7")
    )
    return loaded, journal


@query
def append_undated(t: Trial) -> DataFrame:
    """Rows without a date are loaded once, whatever the bound."""
    loaded, journal = _gappy_journal(t)
    return incremental.incremental_append(loaded, journal, "journal_id", "posting_date")


@query
def append_skipped(t: Trial) -> DataFrame:
    """What the bound leaves behind."""
    loaded, journal = _gappy_journal(t)
    return incremental.skipped_rows(loaded, journal, "journal_id", "posting_date")


@query
def backfill_emptied(t: Trial) -> DataFrame:
    """Three months of the capex fact again, of which one has no rows any more."""
    facts = capex_by_region(t)
    path = settings.scratch(t.spark, "partitions")
    incremental.backfill(facts, path, "in_service_month", None)
    left = facts.filter(F.col("in_service_month") != F.lit(BACKFILL_MONTHS[1]).cast("date"))
    incremental.backfill(left, path, "in_service_month", BACKFILL_MONTHS)
    return t.spark.read.parquet(path).select(facts.columns)


@query
def incremental_append(t: Trial) -> DataFrame:
    """Journal up to the end of 1999 is loaded, but for the seventh lines."""
    journal = t.journal().select("journal_id", "posting_date", "account_id", "amount_usd", "memo")
    loaded = journal.filter(
        (F.col("posting_date") <= F.lit("1999-12-31").cast("date")) & (F.col("memo") != "line 7")
    )
    return incremental.incremental_append(
        loaded, journal, "journal_id", "posting_date", lookback_days=31
    )


@query
def date_dim(t: Trial) -> DataFrame:
    day = F.col("o_orderdate").cast("date")
    span = t.table("orders").agg(F.min(day).alias("first"), F.max(day).alias("last"))
    return incremental.date_dim(span, "first", "last")


@query
def scd2_merge(t: Trial) -> DataFrame:
    customers = t.table("customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    opened = F.lit("1995-01-01").cast("date")
    closed = F.lit("1997-07-01").cast("date")
    current = customers.select(
        "*",
        opened.alias("valid_from"),
        F.lit(None).cast("date").alias("valid_to"),
        F.lit(True).alias("is_current"),
    )
    earlier = customers.filter(F.col("c_acctbal") > 5000).select(
        "c_custkey",
        F.lit("PROSPECT").alias("c_mktsegment"),
        F.lit(None).cast("double").alias("c_acctbal"),
        F.lit("1994-01-01").cast("date").alias("valid_from"),
        opened.alias("valid_to"),
        F.lit(False).alias("is_current"),
    )
    negative = F.col("c_acctbal") < 0
    snapshot = customers.filter(F.col("c_mktsegment") != "FURNITURE").select(
        "c_custkey",
        F.when(negative, "WATCHED").otherwise(F.col("c_mktsegment")).alias("c_mktsegment"),
        F.when(~negative, F.col("c_acctbal")).alias("c_acctbal"),
    )
    added = customers.filter(F.col("c_mktsegment") == "BUILDING").select(
        (F.col("c_custkey") + 1_000_000_000_000).alias("c_custkey"), "c_mktsegment", "c_acctbal"
    )
    return incremental.scd2_merge(
        earlier.unionByName(current),
        snapshot.unionByName(added),
        "c_custkey",
        ["c_mktsegment", "c_acctbal"],
        closed,
    )


def _two_states(t: Trial) -> tuple[DataFrame, DataFrame]:
    """Orders before and after a round of changes."""
    old = t.table("orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    partial = F.col("o_orderstatus") == "P"
    kept = t.table("orders").filter(
        (F.col("o_orderstatus") != "F") | (F.col("o_orderpriority") != "5-LOW")
    )
    kept = kept.select(
        "o_orderkey",
        "o_orderstatus",
        F.when(partial, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")).alias(
            "o_totalprice"
        ),
    )
    added = old.filter(F.col("o_orderstatus") == "O").withColumn(
        "o_orderkey", F.col("o_orderkey") + 1_000_000_000_000
    )
    return old, kept.unionByName(added)


@query
def table_diff(t: Trial) -> DataFrame:
    old, new = _two_states(t)
    return incremental.table_diff(old, new, "o_orderkey")


@query
def apply_changes(t: Trial) -> DataFrame:
    old, new = _two_states(t)
    changes = incremental.table_diff(old, new, "o_orderkey")
    return incremental.apply_changes(old, changes, "o_orderkey")


@query
def partition_backfill(t: Trial) -> DataFrame:
    """The capex fact by month; then three months again, with corrected cost."""
    facts = capex_by_region(t)
    path = settings.scratch(t.spark, "partitions")
    incremental.backfill(facts, path, "in_service_month", None)
    corrected = facts.withColumn("capex_usd", F.lit(0.0))
    incremental.backfill(corrected, path, "in_service_month", BACKFILL_MONTHS)
    return t.spark.read.parquet(path).select(facts.columns)


@query
def checksum_diff(t: Trial) -> DataFrame:
    old, new = _two_states(t)
    return incremental.checksum_diff(old, new, "o_orderkey")


@query
def bucketed_lines(t: Trial) -> DataFrame:
    """Closed lines by category of their supplier, from two tables in buckets of the supplier."""
    name = f"lines_{uuid.uuid4().hex}"
    lines = t.purchase_orders().select("supplier_id", "status", "qty_received")
    kept = [
        lake.save_bucketed(df, f"{name}_{k}", ["supplier_id"], 8, settings.scratch(t.spark, "buckets"))
        for k, df in enumerate((lines, t.suppliers()))
    ]
    closed = kept[0].filter(F.col("status") == "Closed")
    return closed.join(kept[1], "supplier_id").groupBy("supplier_id", F.col("category").alias("supplier_category")).agg(
        F.count("*").alias("po_lines"), F.sum("qty_received").alias("qty_received")
    )


@query
def replace_months(t: Trial) -> DataFrame:
    """The capex fact in versions: three months are replaced in one step, one of them by nothing."""
    facts = capex_by_region(t)
    path = settings.scratch(t.spark, "versions")
    published.replace_table(facts.hint("rebalance", F.col("in_service_month")), path, "in_service_month")
    left = facts.filter(F.col("in_service_month") != F.lit(BACKFILL_MONTHS[1]).cast("date"))
    corrected = left.withColumn("capex_usd", F.lit(0.0))
    published.replace_days(corrected, path, "in_service_month", BACKFILL_MONTHS)
    return published.read(t.spark, path)


@query
def append_batches(t: Trial) -> DataFrame:
    """The journal in three batches, of which one is sent again; then gathered."""
    journal = t.journal().select("journal_id", "posting_date", "amount_usd", "memo")
    path = settings.scratch(t.spark, "batches")
    first, last = (F.lit(day).cast("date") for day in ("1994-12-31", "1996-12-31"))
    posted = F.col("posting_date")
    batches = {
        "old": posted <= first,
        "middle": (posted > first) & (posted <= last),
        "new": (posted > last) | posted.isNull(),
    }
    for batch in ("old", "middle", "old", "new", "middle"):
        published.append(journal.filter(batches[batch]), path, batch=batch)
    published.compact(t.spark, path)
    return published.read(t.spark, path)


@query
def scorecard_rollup(t: Trial) -> DataFrame:
    """The scorecard from parts that were added in three batches; one batch is corrected, one sent again."""
    lines = silver.flag_po_lines(t.purchase_orders())
    path, cell = settings.scratch(t.spark, "parts"), ["promised_month", "supplier_id", "component_id"]
    third = F.col("line_number") % 3
    wrong = lines.filter(third == 1).withColumn("qty_received", F.col("qty_received") + 1)
    parts = [gold.scorecard_parts(some, ["component_id"]) for some in (lines.filter(third == 0), wrong)]
    for batch, part in (("a", parts[0]), ("b", parts[1]), ("a", parts[0])):
        rollups.add(part, path, batch)
    right = gold.scorecard_parts(lines.filter(third == 1), ["component_id"])
    rollups.change(parts[1], right, path, cell, "b corrected")
    rollups.settle(t.spark, path, cell, "po_lines")
    rollups.add(gold.scorecard_parts(lines.filter(third == 2), ["component_id"]), path, "c")
    summed = rollups.current(t.spark, path, cell, "po_lines")
    return gold.scorecard_of(summed, t.suppliers(), t.components())


@query
def capex_rollup(t: Trial) -> DataFrame:
    """The capex fact from parts of racks that were added by the month of their request."""
    racks = silver.measure_racks(t.racks())
    path, cell = settings.scratch(t.spark, "parts"), ["in_service_month", "region_code", "sku_family"]
    for batch, months in (("spring", range(1, 7)), ("autumn", range(7, 13)), ("spring", range(1, 7))):
        some = racks.filter(F.month("requested_date").isin(*months))
        rollups.add(gold.capex_parts(some), path, batch)
    return gold.capex_of(rollups.current(t.spark, path, cell, "racks_in_service"), t.regions())


SNAPSHOT_DAYS = ("1993-07-01", "1995-01-01", "1996-06-01", "1998-01-01")


def _customer_snapshots(t: Trial) -> DataFrame:
    """Customers with an order in the two years before each day: the priority of the latest, and how many."""
    ordered = F.col("o_orderdate").cast("date")
    days = F.filter(
        F.array(*[F.lit(day).cast("date") for day in SNAPSHOT_DAYS]),
        lambda day: (ordered <= day) & (ordered > F.date_sub(day, 730)),
    )
    seen = t.table("orders").select("o_custkey", "o_orderpriority", "o_orderdate", "o_orderkey", F.explode(days).alias("as_of"))
    states = seen.groupBy("o_custkey", "as_of").agg(
        F.max_by("o_orderpriority", F.struct("o_orderdate", "o_orderkey")).alias("priority"),
        F.count("*").alias("orders"),
    )
    path = settings.scratch(t.spark, "snapshots")
    states.write.parquet(path)
    return t.spark.read.schema(states.schema).parquet(path)


@query
def scd2_late(t: Trial) -> DataFrame:
    """Customers' history from four snapshots that arrive out of order."""
    snapshots = _customer_snapshots(t)
    tracked = ["priority"]
    held = history.history_of(snapshots.filter(F.col("as_of") == SNAPSHOT_DAYS[3]), "o_custkey", tracked)
    seen = [SNAPSHOT_DAYS[3]]
    for day in (SNAPSHOT_DAYS[0], SNAPSHOT_DAYS[2], SNAPSHOT_DAYS[1]):
        applied = t.spark.createDataFrame([(d,) for d in seen], "as_of string")
        some = snapshots.filter(F.col("as_of") == F.lit(day).cast("date"))
        held = history.apply_snapshot(held, some, "o_custkey", tracked, day, applied)
        seen.append(day)
    return held


@query
def orders_as_of(t: Trial) -> DataFrame:
    """Orders with what was known of their customer on the day."""
    versions = history.history_of(_customer_snapshots(t), "o_custkey", ["priority", "orders"])
    orders = t.table("orders").select(
        "o_orderkey", "o_custkey", F.col("o_orderdate").cast("date").alias("order_date"), "o_totalprice"
    )
    return history.as_of(orders, versions, "o_custkey", "order_date", ["priority", "orders"], "known_")


@query
def ingest_drift(t: Trial) -> DataFrame:
    """Orders in one folder with three layouts; the next run finds a fourth that does not fit."""
    orders, root = t.table("orders"), settings.scratch(t.spark, "drift")
    part = F.pmod("o_custkey", F.lit(3))
    layouts = [
        orders.filter(part == 0).select("o_orderkey", "o_custkey"),
        orders.filter(part == 1).select(F.col("o_custkey").alias("O_CustKey"), "o_totalprice", "o_orderkey"),
        orders.filter(part == 2).select("o_orderkey", "o_orderstatus", "o_custkey"),
    ]
    misfit = orders.select(F.col("o_orderkey").cast("string").alias("o_orderkey"), "o_orderstatus")
    for k, drop in enumerate([*layouts, misfit]):
        drop.write.parquet(f"{root}/in/{k}")
        if k > 1:
            drift.start_drift_ingest(t.spark, f"{root}/in", f"{root}/out", f"{root}/progress").awaitTermination()
    return published.read(t.spark, f"{root}/out")


@query
def ingest_stream(t: Trial) -> DataFrame:
    """Events arrive in two drops; each run takes only the files it has not seen."""
    events = t.table("events").withColumn("day", F.col("ts").cast("date"))
    root = settings.scratch(t.spark, "stream")
    schema = t.table("events").schema
    turn = F.lit("2024-01-16").cast("date")
    for drop in (events.filter(F.col("day") < turn), events.filter(F.col("day") >= turn)):
        drop.drop("day").write.mode("append").parquet(f"{root}/in")
        ingest.ingest_stream(t.spark, f"{root}/in", f"{root}/out", f"{root}/progress", schema)
    return t.spark.read.schema(schema).parquet(f"{root}/out")
