"""Months, bills of material, demand, prices and balances."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stockledger import settings
from stockledger.functions import exact_sum, month_of, months_from, ramp, to_cents
from stockledger.functions.money import as_column

MONTHLY = "interval 1 month"


def _date(value: Column | str) -> Column:
    """A date column, or a literal written YYYY-MM-DD."""
    return F.lit(value).cast("date") if isinstance(value, str) else value


def _lookup(rules: Mapping[Any, Any], key: Column) -> Column:
    """Value of a small fixed mapping; null for other keys."""
    found = F.lit(None)
    for match, value in reversed(list(rules.items())):
        found = F.when(key == match, F.lit(value)).otherwise(found)
    return found


# --- months and dates -------------------------------------------------------


def month_spine(
    entities: DataFrame, start: Column | str, end: Column | str, launched: str | None = None
) -> DataFrame:
    """One row per entity and month from start to end, both included.

    With ``launched`` an entity begins in the month of that date. The months
    come out of each entity's own row, so there is no join.
    """
    first = month_of(_date(start))
    last = month_of(_date(end))
    begins = first
    if launched is not None:
        begins = F.greatest(first, month_of(F.col(launched).cast("date")))
        entities = entities.filter(begins <= last)
    months = F.sequence(begins, last, F.expr(MONTHLY))
    return entities.withColumn("month", F.explode(months)).withColumn(
        "month_index", months_from(first, "month").cast("long")
    )


def censor_after(df: DataFrame, columns: Sequence[str], end: Column | str) -> DataFrame:
    """Dates after the end of the window become null."""
    end = _date(end)
    return df.withColumns({name: F.when(F.col(name) <= end, F.col(name)) for name in columns})


def derive_status(
    df: DataFrame, received: str, quantity: str, end: Column | str, status: str = "status"
) -> DataFrame:
    """Close what was received inside the window; open lines received nothing."""
    arrived = F.coalesce(F.col(received) <= _date(end), F.lit(False))
    return df.withColumns(
        {
            received: F.when(arrived, F.col(received)),
            quantity: F.when(arrived, F.col(quantity)).otherwise(F.lit(0)),
            status: F.when(arrived, F.lit("Closed")).otherwise(F.lit("Open")),
        }
    )


# --- bills of material and demand -------------------------------------------


def explode_bom(
    bom: DataFrame,
    skus: DataFrame,
    infra: Mapping[Any, int] | None = None,
    family_infra: Mapping[str, Mapping[Any, int]] | None = None,
) -> DataFrame:
    """Component quantities of a whole rack.

    Per-unit quantities times units per rack, plus the parts every rack has
    and those only racks of some family have. A part that a rack gets as
    infrastructure takes that quantity instead of the one in ``bom``, where rows
    of one part are added up first.
    """
    per_rack = (F.col("qty_per_unit") * F.col("units_per_rack")).cast("long")
    parts = (
        bom.join(skus.select("sku_id", "units_per_rack"), "sku_id")
        .groupBy("sku_id", "component_id")
        .agg(F.sum(per_rack).alias("qty_per_rack"))
    )
    # (family or any, component, quantity, precedence)
    fixed = [(None, part, qty, 1) for part, qty in (infra or {}).items()]
    for family, added in (family_infra or {}).items():
        fixed += [(family, part, qty, 2) for part, qty in added.items()]
    if not fixed:
        return parts
    id_type = bom.schema["component_id"].dataType
    entries = F.array(
        *[
            F.struct(
                F.lit(family).cast("string").alias("family"),
                F.lit(part).cast(id_type).alias("component_id"),
                F.lit(qty).cast("long").alias("qty_per_rack"),
                F.lit(precedence).alias("precedence"),
            )
            for family, part, qty, precedence in fixed
        ]
    )
    every_rack = F.col("family").isNull() | (F.col("family") == F.col("sku_family"))
    extra = (
        skus.select("sku_id", "sku_family", F.inline(entries))
        .filter(every_rack)
        .drop("family", "sku_family")
    )
    return (
        parts.withColumn("precedence", F.lit(0))
        .unionByName(extra)
        .groupBy("sku_id", "component_id")
        .agg(F.max(F.struct("precedence", "qty_per_rack")).alias("chosen"))
        .select("sku_id", "component_id", "chosen.qty_per_rack")
    )


def component_demand(racks: DataFrame, bom_rack: DataFrame) -> DataFrame:
    """Components used per month of request, hub and component.

    Racks are counted per SKU before the bill of material multiplies them, so
    the join grows with SKUs and months and not with racks.
    """
    built = racks.groupBy(
        month_of("requested_date").alias("month"), "hub_id", "sku_id"
    ).agg(F.count("*").alias("racks"))
    return (
        built.join(bom_rack, "sku_id")
        .groupBy("month", "hub_id", "component_id")
        .agg(F.sum(F.col("racks") * F.col("qty_per_rack")).alias("qty_consumed"))
    )


# --- prices and costs -------------------------------------------------------


def price_index(
    components: DataFrame,
    start: Column | str,
    end: Column | str,
    paths: Mapping[str, tuple[float, float, float, float]],
    drift: DataFrame | None = None,
    bounds: tuple[float, float] = (0.6, 1.6),
) -> DataFrame:
    """Multiplier on standard cost per component and month.

    ``paths`` gives (trend per month, swing, period, phase) for the categories
    that follow a curve. Others follow the running total of their monthly
    ``drift`` (component_id, month, drift), or stay at 1 without one.
    """
    low, high = bounds

    def bounded(value: Column) -> Column:
        return F.least(F.greatest(value, F.lit(low)), F.lit(high)).alias("price_index")

    on_curve = F.coalesce(F.col("category").isin(*paths), F.lit(False))
    curved = components.filter(on_curve) if drift is not None else components
    step = F.col("month_index").cast("double")
    curve = F.lit(1.0)
    for category, (trend, swing, period, phase) in paths.items():
        wave = F.sin(step / F.lit(float(period)) + F.lit(float(phase)))
        curve = F.when(
            F.col("category") == category, 1.0 + step * trend + wave * swing
        ).otherwise(curve)
    index = month_spine(curved.select("component_id", "category"), start, end).select(
        "component_id", "month", bounded(curve)
    )
    if drift is None:
        return index
    walked = _walk(components.filter(~on_curve), drift, start, end)
    return index.unionByName(
        walked.select("component_id", "month", bounded(F.lit(1.0) + F.col("moved")))
    )


def _walk(
    components: DataFrame, drift: DataFrame, start: Column | str, end: Column | str
) -> DataFrame:
    """Running drift of every component and month, from the months that have any.

    A total holds until the next month with a drift, so the grid is filled in
    from those rows and never joined. ``known`` marks the row that opens a
    component; drift of anything else is dropped.
    """
    first, last = month_of(_date(start)), month_of(_date(end))
    opening = components.select(
        "component_id", first.alias("month"), F.lit(0.0).alias("drift"), F.lit(1).alias("known")
    )
    moves = drift.filter(F.col("month").between(first, last)).select(
        "component_id", "month", "drift", F.lit(0).alias("known")
    )
    steps = (
        opening.unionByName(moves)
        .groupBy("component_id", "month")
        .agg(exact_sum("drift").alias("drift"), F.max("known").alias("known"))
    )
    component = W.partitionBy("component_id")
    by_month = component.orderBy("month")
    so_far = by_month.rowsBetween(W.unboundedPreceding, W.currentRow)
    until = F.coalesce(F.add_months(F.lead("month").over(by_month), -1), last)
    return (
        steps.select(
            "component_id",
            "month",
            until.alias("until"),
            F.sum("drift").over(so_far).cast("double").alias("moved"),
            F.max("known").over(component).alias("known"),
        )
        .filter(F.col("known") == 1)
        .select(
            "component_id",
            "moved",
            F.explode(F.sequence("month", "until", F.expr(MONTHLY))).alias("month"),
        )
    )


def rack_cost(bom_rack: DataFrame, components: DataFrame, prices: DataFrame) -> DataFrame:
    """Cost of one rack per SKU and month at that month's component prices."""
    priced = bom_rack.join(
        components.select("component_id", "standard_cost_usd"), "component_id"
    ).join(prices, "component_id")
    cost = F.col("standard_cost_usd") * F.col("price_index") * F.col("qty_per_rack")
    return priced.groupBy("sku_id", "month").agg(
        to_cents(exact_sum(cost)).alias("rack_cost_usd")
    )


def useful_life(family: Column | str, rules: Mapping[str, int], default: int) -> Column:
    """Months over which a family of assets is depreciated."""
    return F.coalesce(_lookup(rules, as_column(family)), F.lit(default)).cast("long")


def expected_demand(
    spine: DataFrame,
    mix: Mapping[str, float],
    base: float,
    steps: int,
    growth: tuple[float, float],
    family_ramps: Mapping[str, tuple[float, float]],
    weight: str = "demand_weight",
) -> DataFrame:
    """Expected racks per entity, family and month.

    ``spine`` comes from ``month_spine`` and carries a weight per entity. The
    families come out of a literal array, so there is no join.
    """
    families = F.array(
        *[
            F.struct(F.lit(family).alias("sku_family"), F.lit(share).alias("share"))
            for family, share in mix.items()
        ]
    )
    step = F.col("month_index")
    special = F.lit(1.0)
    for family, (low, high) in family_ramps.items():
        special = F.when(
            F.col("family.sku_family") == family, ramp(step, steps, low, high)
        ).otherwise(special)
    expected = (
        F.lit(float(base))
        * F.col(weight)
        * F.col("family.share")
        * ramp(step, steps, *growth)
        * special
    )
    return (
        spine.withColumn("family", F.explode(families))
        .withColumn("expected_racks", expected)
        .withColumn("sku_family", F.col("family.sku_family"))
        .drop("family")
    )


# --- balances ---------------------------------------------------------------


def clamped_balance(
    moves: DataFrame,
    keys: Sequence[str],
    order: str,
    delta: str,
    opening: Column | float = 0,
    months: tuple[Column | str, Column | str] | None = None,
    stock: DataFrame | None = None,
) -> DataFrame:
    """Running balance that never falls below zero at any step.

    With running total S (opening included), the floored balance is
    S - min(0, lowest S so far). Moves are summed per key and step first, so a
    window holds one row per step and a busy key is already small there.

    With ``months`` (first and last), ``order`` is a month and every key gets
    all of them; moves outside are left out. ``stock`` gives keys with their
    own ``opening``; keys of it that never move are in the result too.
    """
    opening = opening if isinstance(opening, Column) else F.lit(opening)
    steps = moves.select(*keys, order, F.col(delta).alias("delta"), opening.alias("opening"))
    if months is not None:
        first, last = (month_of(_date(month)) for month in months)
        steps = steps.filter(F.col(order).between(first, last))
        begin = steps.select(*keys, first.alias(order), F.lit(0).alias("delta"), "opening")
        steps = steps.unionByName(begin.groupBy(*keys, order, "delta").agg(F.max("opening").alias("opening")))
        if stock is not None:
            held = stock.select(*keys, first.alias(order), F.lit(0).alias("delta"), "opening")
            steps = steps.withColumn("opening", F.lit(None)).unionByName(held)
    elif stock is not None:
        raise ValueError("opening stock needs the months to show it in")
    steps = steps.groupBy(*keys, order).agg(
        F.sum("delta").alias("delta"), F.coalesce(F.max("opening"), F.lit(0)).alias("opening")
    )
    so_far = W.partitionBy(*keys).orderBy(order).rowsBetween(W.unboundedPreceding, W.currentRow)
    total = F.first("opening").over(so_far) + F.sum("delta").over(so_far)
    balances = steps.withColumn("total", total).withColumn(
        "balance", F.col("total") - F.least(F.lit(0), F.min("total").over(so_far))
    )
    if months is None:
        return balances.select(*keys, order, "delta", "balance")
    # a balance holds until the month before the next move
    next_move = F.lead(order).over(W.partitionBy(*keys).orderBy(order))
    until = F.coalesce(F.add_months(next_move, -1), month_of(_date(months[1])))
    return (
        balances.withColumn("until", until)
        .select(
            *keys,
            F.posexplode(F.sequence(order, "until", F.expr(MONTHLY))).alias("later", order),
            "delta",
            "balance",
        )
        .select(*keys, order, F.when(F.col("later") == 0, F.col("delta")).otherwise(0).alias("delta"), "balance")
    )


def open_balance(
    items: DataFrame,
    keys: Sequence[str],
    opened: str,
    closed: str,
    quantity: str,
    start: Column | str,
    end: Column | str,
) -> DataFrame:
    """Quantity opened in or before each month and closed later or never.

    An item that was never opened does not count, nor does one that was closed
    in the month it was opened or before. Each item adds its quantity in the month it opens and takes it back in the
    month it closes; the balance is the running total. What happened before
    the first month is folded into it. Every key gets every month.
    """
    first, last = month_of(_date(start)), month_of(_date(end))
    # greatest skips nulls, so an item never opened or never closed is kept out by hand
    opens = F.when(F.col(opened).isNotNull(), F.greatest(first, month_of(opened)))
    closes = F.when(F.col(closed).isNotNull() & opens.isNotNull(), F.greatest(opens, month_of(closed)))
    change = F.array(
        F.struct(first.alias("month"), F.lit(0).cast("long").alias("change")),
        F.struct(opens.alias("month"), F.col(quantity).cast("long").alias("change")),
        F.struct(closes.alias("month"), (-F.col(quantity)).cast("long").alias("change")),
    )
    changes = (
        items.select(*keys, F.explode(change).alias("entry"))
        .select(*keys, "entry.month", "entry.change")
        .filter(F.col("month") <= last)
        .groupBy(*keys, "month")
        .agg(F.sum("change").alias("change"))
    )
    by_month = W.partitionBy(*keys).orderBy("month")
    until = F.coalesce(F.add_months(F.lead("month").over(by_month), -1), last)
    return (
        changes.select(
            *keys,
            "month",
            until.alias("until"),
            F.sum("change")
            .over(by_month.rowsBetween(W.unboundedPreceding, W.currentRow))
            .alias("open_qty"),
        )
        .withColumn("month", F.explode(F.sequence("month", "until", F.expr(MONTHLY))))
        .drop("until")
    )


# --- keys -------------------------------------------------------------------


def sequence_id(
    df: DataFrame, order_by: Sequence[str], fmt: str, name: str, first: int = 1
) -> DataFrame:
    """Consecutive formatted ids in a given order, without a one-task sort.

    Rows are range-partitioned on the order, which must be unique, and counted
    within their partition. The checkpoint pins that layout; without it a lost
    executor could recompute a partition with other bounds. The offsets hold
    one row per partition, so their window and their broadcast are bounded by
    the partition count and not by the data.
    """
    settings.ensure_checkpoints(df.sparkSession)
    position = F.monotonically_increasing_id()
    placed = (
        df.repartitionByRange(*order_by)
        .sortWithinPartitions(*order_by)
        .withColumn("_position", position)
        .checkpoint()
    )
    # the function's documented layout: partition above bit 33, row below it
    part = F.shiftright("_position", 33)
    row = F.col("_position").bitwiseAND(F.lit((1 << 33) - 1))
    placed = placed.withColumns({"_part": part, "_row": row})
    earlier = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_part")
        .agg(F.count("*").alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_offset"))
    )
    number = F.col("_offset") + F.col("_row") + F.lit(first)
    return (
        placed.join(F.broadcast(offsets), "_part")
        .withColumn(name, F.format_string(fmt, number))
        .drop("_position", "_part", "_row", "_offset")
    )


def map_with_override(
    df: DataFrame,
    mapping: DataFrame,
    key: str,
    value: str,
    overrides: Mapping[Any, Any] | None = None,
) -> DataFrame:
    """Attach ``value`` from a mapping on ``key``; overrides win over the mapping."""
    mapped = df.join(mapping.select(key, value), key, "left")
    if not overrides:
        return mapped
    kind = mapping.schema[value].dataType
    chosen = F.coalesce(_lookup(overrides, F.col(key)).cast(kind), F.col(value))
    return mapped.withColumn(value, chosen)
