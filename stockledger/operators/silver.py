"""Cleaned and joined rows.

Dimension joins carry no broadcast hint. Spark broadcasts a dimension when its
measured size is under the session's threshold and sorts, merges and splits
skewed keys otherwise, so nothing here assumes a dimension stays small.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockledger.functions import days_between, month_of


def flag_po_lines(purchase_orders: DataFrame) -> DataFrame:
    """Delivery flags of a purchase-order line, before any join.

    An open line has no receipt: it is not on time, and its lateness is null.
    """
    received = F.col("received_date")
    on_time = received.isNotNull() & (received <= F.col("promised_date"))
    in_full = F.col("qty_received") >= F.col("qty_ordered")
    return purchase_orders.withColumns(
        {
            "promised_month": month_of("promised_date"),
            "is_on_time": on_time,
            "is_in_full": in_full,
            "is_otif": on_time & in_full,
            "days_late": days_between("promised_date", "received_date"),
            "received_value_usd": F.col("qty_received") * F.col("unit_cost_usd"),
        }
    )


def enrich_po_lines(
    purchase_orders: DataFrame, suppliers: DataFrame, components: DataFrame
) -> DataFrame:
    """Purchase-order lines with supplier and component attributes and flags.

    A line whose supplier or component is unknown is dropped.
    """
    supplier = suppliers.select(
        "supplier_id",
        "supplier_name",
        F.col("category").alias("supplier_category"),
        "strategic_flag",
    )
    component = components.select(
        "component_id",
        "component_name",
        F.col("category").alias("component_category"),
        "standard_cost_usd",
    )
    joined = (
        flag_po_lines(purchase_orders)
        .join(supplier, "supplier_id")
        .join(component, "component_id")
    )
    price_gap = F.col("unit_cost_usd") - F.col("standard_cost_usd")
    return joined.select(
        "po_line_id",
        "po_number",
        "supplier_id",
        "supplier_name",
        "supplier_category",
        "strategic_flag",
        "component_id",
        "component_name",
        "component_category",
        "hub_id",
        "order_date",
        "promised_date",
        "received_date",
        "qty_ordered",
        "qty_received",
        "unit_cost_usd",
        "standard_cost_usd",
        "status",
        "promised_month",
        "is_on_time",
        "is_in_full",
        "is_otif",
        "days_late",
        "received_value_usd",
        (F.col("qty_received") * price_gap).alias("ppv_usd"),
    )


def enrich_journal(
    journal: DataFrame, accounts: DataFrame, cost_centers: DataFrame
) -> DataFrame:
    """Journal lines with account and cost-centre attributes and fiscal month."""
    account = accounts.select("account_id", "account_name", "account_type")
    center = cost_centers.select("cost_center_id", "cost_center_name", "org", "region_code")
    return (
        journal.join(account, "account_id")
        .join(center, "cost_center_id")
        .select(
            "journal_id",
            "posting_date",
            month_of("posting_date").alias("fiscal_month"),
            "account_id",
            "account_name",
            "account_type",
            "cost_center_id",
            "cost_center_name",
            "org",
            "region_code",
            "amount_usd",
            "source",
            "reference",
            "memo",
        )
    )


def measure_racks(racks: DataFrame) -> DataFrame:
    """Cycle times, months and monthly depreciation of a rack, before any join."""
    return racks.withColumns(
        {
            "requested_month": month_of("requested_date"),
            "live_month": month_of("live_date"),
            "request_to_live_days": days_between("requested_date", "live_date"),
            "ship_to_install_days": days_between("shipped_date", "installed_date"),
            "monthly_depreciation_usd": F.col("capex_usd")
            / F.nullifzero(F.col("useful_life_months")),
        }
    )


def enrich_racks(racks: DataFrame, regions: DataFrame) -> DataFrame:
    """Racks with region name and cycle-time measures."""
    region = regions.select("region_code", "region_name")
    return (
        measure_racks(racks)
        .join(region, "region_code")
        .select(
            "rack_id",
            "region_code",
            "region_name",
            "hub_id",
            "sku_id",
            "sku_family",
            "requested_date",
            "shipped_date",
            "installed_date",
            "live_date",
            "requested_month",
            "live_month",
            "request_to_live_days",
            "ship_to_install_days",
            "capex_usd",
            "useful_life_months",
            "monthly_depreciation_usd",
        )
    )
