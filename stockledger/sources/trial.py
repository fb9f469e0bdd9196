"""The test tables in the shapes the operators expect.

One function per raw table. Each maps the columns of an order-and-lineitem
star schema onto the business shape; nothing is sampled or capped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from stockledger.functions import exact_sum, month_end, month_of, round_half_away, to_cents
from stockledger.operators import supply
from stockledger.sources.tables import read_table, table_path

LAYOUT = "{root}/{name}.parquet"
TABLES = [
    "region",
    "nation",
    "customer",
    "supplier",
    "part",
    "orders",
    "lineitem",
    "events",
    "documents",
    "embeddings",
    "pages",
    "benchmark",
    "labels",
    "conversations",
]
WINDOW_START = "1995-01-01"
WINDOW_END = "2001-06-30"
MONTHS = 78

# racks carry one of these, in the order of the part types
SKUS = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
UNITS_PER_RACK = {"ECONOMY": 20, "LARGE": 8, "MEDIUM": 10, "PROMO": 16, "SMALL": 40}
DEFAULT_UNITS = 12
LIFE = {"1-URGENT": 48}
DEFAULT_LIFE = 72

# schemas by path, so that a footer is read once and not for every query
_SCHEMAS: dict[str, StructType] = {}

LINE_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


class Trial:
    """Reference-shaped tables over one folder of test tables."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def table(self, name: str) -> DataFrame:
        path = table_path(self.folder, "bronze", name, LAYOUT)
        if path not in _SCHEMAS:
            _SCHEMAS[path] = read_table(self.spark, self.folder, name, layout=LAYOUT).schema
        return read_table(
            self.spark, self.folder, name, schema=_SCHEMAS[path], layout=LAYOUT
        )

    # --- dimensions ---------------------------------------------------------

    def suppliers(self) -> DataFrame:
        turn = F.col("s_nationkey") % 3
        return self.table("supplier").select(
            F.col("s_suppkey").alias("supplier_id"),
            F.col("s_name").alias("supplier_name"),
            F.concat(F.lit("GROUP-"), F.col("s_nationkey").cast("string")).alias("category"),
            F.when(turn == 0, 30).when(turn == 1, 45).otherwise(60).cast("long").alias(
                "payment_terms_days"
            ),
            (F.col("s_acctbal") >= 0).alias("strategic_flag"),
        )

    def customers_as_payees(self) -> DataFrame:
        segment = F.col("c_mktsegment")
        return self.table("customer").select(
            F.col("c_custkey").alias("supplier_id"),
            F.col("c_name").alias("supplier_name"),
            F.when(segment == "BUILDING", 30)
            .when(segment == "MACHINERY", 45)
            .otherwise(60)
            .cast("long")
            .alias("payment_terms_days"),
        )

    def components(self) -> DataFrame:
        return self.table("part").select(
            F.col("p_partkey").alias("component_id"),
            F.col("p_name").alias("component_name"),
            F.col("p_type").alias("category"),
            F.col("p_retailprice").alias("standard_cost_usd"),
        )

    def brands(self) -> DataFrame:
        """Part brands as the components that racks are built from."""
        return (
            self.table("part")
            .groupBy(F.col("p_brand").alias("component_id"))
            .agg(
                F.min("p_name").alias("component_name"),
                F.min("p_type").alias("category"),
                F.max("p_retailprice").alias("standard_cost_usd"),
            )
        )

    def skus(self) -> DataFrame:
        units = F.lit(DEFAULT_UNITS)
        for sku, count in UNITS_PER_RACK.items():
            units = F.when(F.col("sku_id") == sku, count).otherwise(units)
        return (
            self.table("part")
            .groupBy(F.col("p_type").alias("sku_id"))
            .agg(F.max(F.substring("p_type", 1, 1)).alias("sku_family"))
            .withColumn("units_per_rack", units.cast("long"))
        )

    def bom(self) -> DataFrame:
        return (
            self.table("part")
            .groupBy(F.col("p_type").alias("sku_id"), F.col("p_brand").alias("component_id"))
            .agg(F.max("p_size").cast("long").alias("qty_per_unit"))
        )

    def regions(self) -> DataFrame:
        return self.table("nation").select(
            F.col("n_nationkey").alias("region_code"), F.col("n_name").alias("region_name")
        )

    def accounts(self) -> DataFrame:
        """The chart of accounts, one account per region row."""
        number = F.col("r_regionkey")
        return self.table("region").select(
            F.when(number == 0, "1400")
            .otherwise(F.format_string("5%d00", number))
            .alias("account_id"),
            F.col("r_name").alias("account_name"),
            F.when(number == 0, "Asset").otherwise("Opex").alias("account_type"),
        )

    def cost_centers(self) -> DataFrame:
        return self.table("supplier").select(
            F.col("s_suppkey").alias("cost_center_id"),
            F.col("s_name").alias("cost_center_name"),
            F.when(F.col("s_acctbal") >= 0, "Operations").otherwise("Finance").alias("org"),
            F.col("s_nationkey").alias("region_code"),
        )

    def region_centers(self) -> DataFrame:
        """The cost centre that holds each region's assets."""
        return self.table("nation").select(
            F.col("n_nationkey").alias("region_code"),
            F.format_string("CC-%02d", F.col("n_nationkey")).alias("cost_center_id"),
        )

    def weighted_centers(self) -> DataFrame:
        """Cost centres with a demand weight."""
        return self.table("supplier").select(
            F.col("s_suppkey").alias("cost_center_id"),
            (F.col("s_acctbal") / 1000.0).alias("demand_weight"),
        )

    # --- facts --------------------------------------------------------------

    def purchase_orders(self) -> DataFrame:
        lines = self.table("lineitem")
        orders = self.table("orders").select("o_orderkey", "o_orderdate")
        quantity = F.col("l_quantity")
        arrived = F.col("l_linestatus") == "F"
        short = F.floor(quantity * 8 / 10)
        return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
            F.concat_ws("-", *[F.col(name).cast("string") for name in LINE_KEY]).alias(
                "po_line_id"
            ),
            F.col("l_orderkey").alias("po_number"),
            F.col("l_suppkey").alias("supplier_id"),
            F.col("l_partkey").alias("component_id"),
            (F.col("l_suppkey") % 25).alias("hub_id"),
            F.col("o_orderdate").cast("date").alias("order_date"),
            F.date_add(F.col("o_orderdate").cast("date"), 30).alias("promised_date"),
            F.when(
                arrived, F.date_add(F.col("o_orderdate").cast("date"), quantity.cast("int"))
            ).alias("received_date"),
            quantity.cast("long").alias("qty_ordered"),
            F.when(~arrived, 0)
            .when(F.col("l_returnflag") == "R", short)
            .otherwise(quantity.cast("long"))
            .alias("qty_received"),
            round_half_away(F.col("l_extendedprice") / quantity, 2).alias("unit_cost_usd"),
            F.when(arrived, "Closed").otherwise("Open").alias("status"),
            F.col("l_linenumber").cast("long").alias("line_number"),
        )

    def racks(self) -> DataFrame:
        """Orders as racks, dates after the window still in flight."""
        orders = self.table("orders")
        customers = self.table("customer").select("c_custkey", "c_nationkey")
        key = F.col("o_orderkey")
        rack = orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).select(
            key.alias("rack_id"),
            F.col("c_nationkey").alias("region_code"),
            F.col("c_nationkey").cast("long").alias("hub_id"),
            F.element_at(F.lit(SKUS), (key % len(SKUS) + 1).cast("int")).alias("sku_id"),
            F.col("o_orderpriority").alias("sku_family"),
            F.col("o_orderdate").cast("date").alias("requested_date"),
            F.col("o_totalprice").alias("capex_usd"),
            supply.useful_life("o_orderpriority", LIFE, DEFAULT_LIFE).alias("useful_life_months"),
        )
        key = F.col("rack_id")
        dated = (
            rack.withColumn("shipped_date", F.date_add("requested_date", (key % 30).cast("int")))
            .withColumn("installed_date", F.date_add("shipped_date", (key % 11 + 3).cast("int")))
            .withColumn("live_date", F.date_add("installed_date", (key % 7 + 1).cast("int")))
        )
        return supply.censor_after(
            dated, ["shipped_date", "installed_date", "live_date"], WINDOW_END
        )

    def forecast(self) -> DataFrame:
        orders = self.table("orders")
        customers = self.table("customer").select("c_custkey", "c_nationkey")
        status = F.col("o_orderstatus")
        return (
            orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
            .groupBy(
                _month_text("o_orderdate").alias("forecast_month"),
                F.col("c_nationkey").alias("region_code"),
                F.col("o_orderpriority").alias("sku_family"),
                F.when(status == "O", "P6M")
                .when(status == "P", "P1M")
                .otherwise("P3M")
                .alias("forecast_version"),
            )
            .agg(F.count("*").alias("forecast_racks"))
        )

    def snapshots(self) -> DataFrame:
        """Month-end stock per hub and brand, summed from the lines."""
        lines = self.table("lineitem")
        parts = self.table("part").select("p_partkey", "p_brand", "p_size")
        quantity, flag = F.col("l_quantity").cast("long"), F.col("l_returnflag")
        return (
            lines.join(parts, F.col("l_partkey") == F.col("p_partkey"))
            .groupBy(
                month_end(F.col("l_shipdate").cast("date")).alias("snapshot_date"),
                (F.col("l_suppkey") % 25).alias("hub_id"),
                F.col("p_brand").alias("component_id"),
            )
            .agg(
                F.sum(F.when(flag == "N", quantity).otherwise(0)).alias("on_hand_qty"),
                F.sum(F.when(flag == "A", quantity).otherwise(0)).alias("on_order_qty"),
                (F.max("p_size") * 5).cast("long").alias("avg_age_days"),
            )
        )

    def invoices(self) -> DataFrame:
        """Orders as invoices of their customers; open orders are unpaid."""
        dated = F.col("o_orderdate").cast("date")
        priority = F.col("o_orderpriority")
        terms = F.when(priority == "1-URGENT", 30).when(priority == "2-HIGH", 45).otherwise(60)
        return self.table("orders").select(
            F.col("o_orderkey").alias("invoice_id"),
            F.col("o_custkey").alias("supplier_id"),
            dated.alias("invoice_date"),
            F.date_add(dated, terms).alias("due_date"),
            F.when(F.col("o_orderstatus") != "O", F.date_add(dated, 20)).alias("paid_date"),
            F.col("o_totalprice").alias("amount_usd"),
        )

    def journal(self) -> DataFrame:
        flag = F.col("l_returnflag")
        return self.table("lineitem").select(
            F.concat_ws(
                "-",
                *[F.col(name).cast("string") for name in LINE_KEY],
                F.col("l_shipdate").cast("date").cast("string"),
            ).alias("journal_id"),
            F.col("l_shipdate").cast("date").alias("posting_date"),
            _account(flag).alias("account_id"),
            F.col("l_suppkey").alias("cost_center_id"),
            (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("amount_usd"),
            F.when(flag == "R", "Adjustment").otherwise("Accrual").alias("source"),
            F.col("l_orderkey").alias("reference"),
            F.concat(F.lit("line "), F.col("l_linenumber").cast("string")).alias("memo"),
        )

    def budget(self) -> DataFrame:
        """Budgets from the taxes on lines; untaxed cells have a budget of zero."""
        even = F.col("l_linenumber") % 2 == 0
        return (
            self.table("lineitem")
            .filter(F.col("l_linestatus") == "F")
            .groupBy(
                _month_text("l_shipdate").alias("fiscal_month"),
                F.col("l_suppkey").alias("cost_center_id"),
                F.when(even, "5100").otherwise("5200").alias("account_id"),
            )
            .agg(
                to_cents(exact_sum(F.col("l_extendedprice") * F.col("l_tax") * 10.0)).alias(
                    "budget_usd"
                )
            )
        )

    def monthly_drift(self) -> DataFrame:
        """A small price move per part and month, from the discounts given."""
        points = F.rint(F.col("l_discount") * 100).cast("long") - 5
        return (
            self.table("lineitem")
            .groupBy(
                F.col("l_partkey").alias("component_id"),
                month_of(F.col("l_shipdate").cast("date")).alias("month"),
            )
            .agg((F.sum(points) / 250.0).alias("drift"))
        )


def _account(flag: Column) -> Column:
    return F.when(flag == "A", "5100").when(flag == "N", "5200").otherwise("1400")


def _month_text(timestamp: str) -> Column:
    return month_of(F.col(timestamp).cast("date")).cast("string")
