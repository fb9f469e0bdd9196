"""Business facts.

Every fact is reduced on its own keys first and meets its dimensions after
that. The shuffle then carries one partial row per group and task, whatever
share of the rows a single key holds, and the dimension join sees groups
instead of rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stockledger import fixed_values as fixed
from stockledger.functions import (
    days_between,
    exact_sum,
    month_of,
    percent,
    round_half_away,
    to_cents,
)


def _share(flag: str) -> Column:
    """Percentage of rows for which a flag holds, to one decimal."""
    share = F.col(flag).cast("double") / F.nullifzero(f"{flag}_known")
    return round_half_away(F.lit(100.0) * share, 1)


def known(facts: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Facts whose key the dimension holds."""
    return facts.join(dimension.select(key), key, "left_semi")


def scorecard_parts(lines: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """What the scorecard needs of closed lines, summed per supplier, promised month and ``by``.

    Parts of different lines add up, so a fact can be kept by adding those of new lines (``plans.rollups``).
    """
    late = ~F.col("is_on_time")
    sums = {
        "po_lines": F.count("*"),
        "qty_ordered": F.sum("qty_ordered"),
        "qty_received": F.sum("qty_received"),
        **{name: F.sum(F.col(f"is_{name}").cast("long")) for name in ("on_time", "in_full", "otif")},
        **{f"{name}_known": F.count(f"is_{name}") for name in ("on_time", "in_full", "otif")},
        "days_late": F.sum(F.when(late, F.col("days_late"))),
        "late_lines": F.count(F.when(late, F.col("days_late"))),
        "received_value_usd": exact_sum("received_value_usd"),
    }
    closed = lines.filter(F.col("status") == "Closed")
    return closed.groupBy("promised_month", "supplier_id", *by).agg(
        *[value.alias(name) for name, value in sums.items()]
    )


def added_up(parts: DataFrame, cell: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Parts per ``cell``; ``keys`` are further columns that are no sums."""
    sums = [name for name in parts.columns if name not in (*cell, *keys)]
    return parts.groupBy(*cell).agg(*[F.sum(name).alias(name) for name in sums])


def supplier_scorecard(
    lines: DataFrame, suppliers: DataFrame, components: DataFrame | None = None
) -> DataFrame:
    """On-time, in-full and combined delivery of closed lines.

    ``lines`` are flagged purchase-order lines; one result row per supplier and
    promised month. Lateness is averaged over late lines only. Give
    ``components`` when lines of unknown components may still be present: the
    lines are summed per component before they meet, so the join sees sums.
    """
    if components is None:
        return _scorecard(scorecard_parts(lines), suppliers)
    return scorecard_of(scorecard_parts(lines, ["component_id"]), suppliers, components)


def scorecard_of(parts: DataFrame, suppliers: DataFrame, components: DataFrame) -> DataFrame:
    """The scorecard from parts per component."""
    kept = known(parts, components, "component_id")
    cell = ["promised_month", "supplier_id"]
    summed = added_up(kept, cell, ["component_id"])
    # lines that were taken back leave cells without lines
    return _scorecard(summed.filter(F.col("po_lines") > 0), suppliers)


def _scorecard(summed: DataFrame, suppliers: DataFrame) -> DataFrame:
    cell = ["promised_month", "supplier_id"]
    scores = summed.select(
        *cell,
        "po_lines",
        "qty_ordered",
        "qty_received",
        *[_share(name).alias(f"{name}_pct") for name in ("on_time", "in_full", "otif")],
        round_half_away(F.col("days_late") / F.nullifzero("late_lines"), 1).alias(
            "avg_days_late_when_late"
        ),
        to_cents("received_value_usd").alias("received_value_usd"),
    )
    supplier = suppliers.select(
        "supplier_id",
        "supplier_name",
        F.col("category").alias("supplier_category"),
        "strategic_flag",
    )
    return scores.join(supplier, "supplier_id").select(
        "promised_month",
        "supplier_id",
        "supplier_name",
        "supplier_category",
        "strategic_flag",
        "po_lines",
        "qty_ordered",
        "qty_received",
        "on_time_pct",
        "in_full_pct",
        "otif_pct",
        "avg_days_late_when_late",
        "received_value_usd",
    )


def price_variance(
    lines: DataFrame, components: DataFrame, suppliers: DataFrame | None = None
) -> DataFrame:
    """Paid against standard cost, per component and received month.

    Standard cost belongs to the component, so the standard value needs only
    the summed quantity and the component joins after the grouping. With
    ``suppliers``, lines are summed per supplier before unknown ones go.
    """
    if suppliers is None:
        return _variance(variance_parts(lines), components)
    return variance_of(variance_parts(lines, ["supplier_id"]), components, suppliers)


def variance_parts(lines: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """What the price variance needs of received lines; parts of different lines add up."""
    received = lines.filter((F.col("status") == "Closed") & (F.col("qty_received") > 0))
    return received.groupBy(month_of("received_date").alias("received_month"), "component_id", *by).agg(
        F.count("*").alias("lines"),
        F.sum("qty_received").alias("qty_received"),
        exact_sum(F.col("qty_received") * F.col("unit_cost_usd")).alias("actual"),
    )


def variance_of(parts: DataFrame, components: DataFrame, suppliers: DataFrame) -> DataFrame:
    """The price variance from parts per supplier."""
    kept = known(parts, suppliers, "supplier_id")
    bought = added_up(kept, ["received_month", "component_id"], ["supplier_id"])
    return _variance(bought.filter(F.col("lines") > 0), components)


def _variance(bought: DataFrame, components: DataFrame) -> DataFrame:
    component = components.select(
        "component_id",
        "component_name",
        F.col("category").alias("component_category"),
        # the printed digits of a cost, all of them
        F.col("standard_cost_usd").cast("decimal(26,12)").alias("standard_cost"),
    )
    valued = bought.join(component, "component_id").withColumn(
        "standard", F.col("qty_received").cast("decimal(12,0)") * F.col("standard_cost")
    )
    variance = F.col("actual") - F.col("standard")
    return valued.select(
        "received_month",
        "component_category",
        "component_id",
        "component_name",
        "qty_received",
        to_cents("standard").alias("standard_value_usd"),
        to_cents("actual").alias("actual_value_usd"),
        to_cents(variance).alias("ppv_usd"),
        percent(variance, F.col("standard"), 2).alias("ppv_pct"),
    )


def plan_vs_actual(
    forecast: DataFrame,
    racks: DataFrame,
    versions: Sequence[tuple[str, str, str]] = fixed.FORECAST_VERSIONS,
) -> DataFrame:
    """Forecast racks by version against racks requested, see ``plan_of``."""
    return plan_of(requested_parts(racks), forecast, versions)


def requested_parts(racks: DataFrame) -> DataFrame:
    """Racks by the month of their request; parts of different racks add up."""
    return racks.groupBy(
        month_of("requested_date").alias("forecast_month"), "region_code", "sku_family"
    ).agg(F.count("*").alias("actual_racks"))


def plan_of(
    requested: DataFrame,
    forecast: DataFrame,
    versions: Sequence[tuple[str, str, str]] = fixed.FORECAST_VERSIONS,
) -> DataFrame:
    """Forecast racks by version against counted requests.

    ``versions`` gives each forecast version with the prefixes of its value
    and its error columns. Cells without a forecast do not appear; cells
    without racks count zero.
    """
    cell = ["forecast_month", "region_code", "sku_family"]
    planned = forecast.groupBy(
        F.col("forecast_month").cast("date").alias("forecast_month"),
        "region_code",
        "sku_family",
    ).agg(
        *[
            F.max(F.when(F.col("forecast_version") == version, F.col("forecast_racks"))).alias(
                f"{value}_racks"
            )
            for version, value, _ in versions
        ]
    )
    actual = F.coalesce(F.col("actual_racks"), F.lit(0))
    values = [F.col(f"{value}_racks") for _, value, _ in versions]
    return planned.join(requested, cell, "left").select(
        *cell,
        *values,
        actual.alias("actual_racks"),
        *[
            (actual - planned_racks).alias(f"variance_vs_{error}")
            for planned_racks, (_, _, error) in zip(values, versions)
        ],
        *[
            percent(F.abs(actual - planned_racks), planned_racks, 1).alias(
                f"{error}_abs_pct_error"
            )
            for planned_racks, (_, _, error) in zip(values, versions)
        ],
    )


def days_of_supply(
    snapshots: DataFrame,
    consumption: DataFrame,
    components: DataFrame,
    months: int = fixed.TRAILING_MONTHS,
    aged_after: int = fixed.AGED_AFTER_DAYS,
) -> DataFrame:
    """Month-end stock against its trailing consumption.

    ``consumption`` has one row per month, hub and component. The trailing mean
    counts snapshot rows, not calendar months, and is shorter at the start. A
    window holds one row per month of one hub and component, so it stays small.
    Several snapshots of a month follow each other by date, then by quantity.
    """
    cell = ["snapshot_month", "hub_id", "component_id"]
    used = consumption.select(
        F.col("month").alias("snapshot_month"), "hub_id", "component_id", "qty_consumed"
    )
    stocked = (
        snapshots.withColumn("snapshot_month", month_of("snapshot_date"))
        .join(used, cell, "left")
        .withColumn("qty_consumed", F.coalesce(F.col("qty_consumed"), F.lit(0)))
    )
    trailing = (
        W.partitionBy("hub_id", "component_id")
        .orderBy("snapshot_date", "on_hand_qty", "on_order_qty", "avg_age_days")
        .rowsBetween(1 - months, W.currentRow)
    )
    mean = F.col("trailing_mean")
    return (
        stocked.withColumn("trailing_mean", F.avg("qty_consumed").over(trailing))
        .join(
            components.select(
                "component_id",
                "component_name",
                F.col("category").alias("component_category"),
                "standard_cost_usd",
            ),
            "component_id",
        )
        .select(
            "snapshot_date",
            "hub_id",
            "component_id",
            "component_name",
            "component_category",
            "on_hand_qty",
            "on_order_qty",
            "qty_consumed",
            round_half_away(mean, 1).alias("avg_monthly_consumption_3m"),
            round_half_away(
                F.col("on_hand_qty") / F.nullifzero(mean / F.lit(30.0)), 0
            ).alias("days_of_supply"),
            "avg_age_days",
            round_half_away(F.col("on_hand_qty") * F.col("standard_cost_usd"), 2).alias(
                "on_hand_value_usd"
            ),
            (F.col("avg_age_days") > aged_after).alias("is_eo_risk"),
        )
    )


def capex_by_region(racks: DataFrame, regions: DataFrame) -> DataFrame:
    """Racks placed in service with their cost, per month, region and family."""
    return capex_of(capex_parts(racks), regions)


def capex_parts(racks: DataFrame) -> DataFrame:
    """What the capex fact needs of installed racks; parts of different racks add up."""
    return (
        racks.filter(F.col("installed_date").isNotNull())
        .groupBy(
            month_of("installed_date").alias("in_service_month"), "region_code", "sku_family"
        )
        .agg(
            F.count("*").alias("racks_in_service"),
            exact_sum("capex_usd").alias("capex_usd"),
            exact_sum("monthly_depreciation_usd").alias("added_monthly_depreciation_usd"),
            F.sum("request_to_live_days").alias("days"),
            F.count("request_to_live_days").alias("live"),
        )
    )


def capex_of(parts: DataFrame, regions: DataFrame) -> DataFrame:
    """The capex fact from parts that are summed per month, region and family."""
    placed = parts.select(
        "in_service_month",
        "region_code",
        "sku_family",
        "racks_in_service",
        *[to_cents(name).alias(name) for name in ("capex_usd", "added_monthly_depreciation_usd")],
        round_half_away(F.col("days") / F.nullifzero("live"), 1).alias("avg_request_to_live_days"),
    )
    return placed.join(regions.select("region_code", "region_name"), "region_code").select(
        "in_service_month",
        "region_code",
        "region_name",
        "sku_family",
        "racks_in_service",
        "capex_usd",
        "added_monthly_depreciation_usd",
        "avg_request_to_live_days",
    )


def budget_vs_actual(
    journal: DataFrame,
    budget: DataFrame,
    accounts: DataFrame,
    cost_centers: DataFrame,
    account_type: str = fixed.SPENDING_TYPE,
) -> DataFrame:
    """Booked against budgeted spend per month, cost centre and account.

    Both sides are summed to the cell before they meet; a cell present on one
    side only counts zero on the other. The account is part of the cell, so
    accounts of other types go after the lines are summed.
    """
    return budget_of(booked_parts(journal), budget, accounts, cost_centers, account_type)


def booked_parts(journal: DataFrame) -> DataFrame:
    """Journal lines summed by month, cost centre and account; parts of different lines add up."""
    return journal.groupBy(
        month_of("posting_date").alias("fiscal_month"), "cost_center_id", "account_id"
    ).agg(F.count("*").alias("lines"), exact_sum("amount_usd").alias("actual"))


def budget_of(
    parts: DataFrame,
    budget: DataFrame,
    accounts: DataFrame,
    cost_centers: DataFrame,
    account_type: str = fixed.SPENDING_TYPE,
) -> DataFrame:
    """Budget against parts that are summed per month, cost centre and account."""
    cell = ["fiscal_month", "cost_center_id", "account_id"]
    spending = accounts.filter(F.col("account_type") == account_type)
    booked = known(parts.drop("lines"), spending, "account_id")
    planned = budget.groupBy(
        F.col("fiscal_month").cast("date").alias("fiscal_month"), "cost_center_id", "account_id"
    ).agg(exact_sum("budget_usd").alias("planned"))
    actual = F.coalesce(F.col("actual"), F.lit(0))
    gap = actual - F.coalesce(F.col("planned"), F.lit(0))
    return (
        booked.join(planned, cell, "full")
        .join(
            cost_centers.select("cost_center_id", "cost_center_name", "org", "region_code"),
            "cost_center_id",
        )
        .join(accounts.select("account_id", "account_name"), "account_id")
        .select(
            "fiscal_month",
            "cost_center_id",
            "cost_center_name",
            "org",
            "region_code",
            "account_id",
            "account_name",
            to_cents(actual).alias("actual_usd"),
            to_cents(F.coalesce(F.col("planned"), F.lit(0))).alias("budget_usd"),
            to_cents(gap).alias("variance_usd"),
            percent(gap, F.col("planned"), 1).alias("variance_pct"),
        )
    )


def aging(
    invoices: DataFrame, suppliers: DataFrame, bounds: Sequence[int] = fixed.AGING_BOUNDS
) -> DataFrame:
    """Unpaid invoices per supplier by days past due.

    The as-of date is the latest invoice date, paid invoices included. It is a
    scalar subquery, so no row of the invoices takes part in a join for it.
    """
    as_of = invoices.agg(F.max("invoice_date")).scalar()
    late = F.col("days_past_due")
    edges = [0, *bounds]
    buckets = [late <= 0]
    buckets += [late.between(low + 1, high) for low, high in zip(edges, edges[1:])]
    buckets += [late > edges[-1]]
    names = ["current_usd"]
    names += [f"past_due_{low + 1}_{high}_usd" for low, high in zip(edges, edges[1:])]
    names += [f"past_due_over_{edges[-1]}_usd"]
    bucket = F.coalesce(*[F.when(inside, k) for k, inside in enumerate(buckets)])
    # one sum for each supplier and bucket; the buckets become columns of the few groups
    by_bucket = (
        invoices.filter(F.col("paid_date").isNull())
        .withColumn("days_past_due", days_between(F.col("due_date"), as_of))
        .groupBy("supplier_id", bucket.alias("bucket"))
        .agg(F.count("*").alias("open_invoices"), exact_sum("amount_usd").alias("amount"))
    )
    amounts = [F.when(F.col("bucket") == k, F.col("amount")).otherwise(0) for k in range(len(names))]
    owed = by_bucket.groupBy("supplier_id").agg(
        F.sum("open_invoices").alias("open_invoices"),
        to_cents(F.sum("amount")).alias("open_usd"),
        *[to_cents(F.sum(amount)).alias(name) for amount, name in zip(amounts, names)],
    )
    supplier = suppliers.select("supplier_id", "supplier_name", "payment_terms_days")
    return owed.join(supplier, "supplier_id").select(
        as_of.alias("as_of_date"),
        "supplier_id",
        "supplier_name",
        "payment_terms_days",
        "open_invoices",
        "open_usd",
        *names,
    )
