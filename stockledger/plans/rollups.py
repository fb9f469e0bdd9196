"""Facts that are kept by adding the parts of new rows, without reading the old ones.

Parts are the sums that a fact is made of, per cell (``gold.scorecard_parts`` and the like); amounts are exact
decimals, so parts give the same cents in whatever order and grouping they are added. They lie in a published
table: a batch of rows adds a run of parts, once, and the fact adds up all runs.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockledger.operators import gold, silver
from stockledger.plans import lakehouse
from stockledger.sources import published
from stockledger.sources import tables as lake


def add(parts: DataFrame, path: str, batch: str) -> published.Version:
    """Add the parts of a batch of new rows; a batch that was added before changes nothing."""
    return published.append(parts, path, batch=batch)


def taken_back(parts: DataFrame, cell: Sequence[str]) -> DataFrame:
    """The parts that undo ``parts``: for rows that are corrected, added together with those of the new state."""
    return parts.select(
        *[
            F.col(field.name) if field.name in cell else (-F.col(field.name)).cast(field.dataType).alias(field.name)
            for field in parts.schema.fields
        ]
    )


def change(old: DataFrame, new: DataFrame, path: str, cell: Sequence[str], batch: str) -> published.Version:
    """Put the parts of corrected rows in the place of those that they had, as one batch."""
    return add(taken_back(old, cell).unionByName(new), path, batch)


def current(spark: SparkSession, path: str, cell: Sequence[str], rows: str) -> DataFrame:
    """All parts so far, one row per cell; cells without ``rows`` are gone."""
    return gold.added_up(published.read(spark, path), cell).filter(F.col(rows) > 0)


def settle(spark: SparkSession, path: str, cell: Sequence[str], rows: str) -> published.Version:
    """Replace the runs of many batches by their sums; which batches were added stays known."""
    before = published.latest(spark, path)
    kinds = {field.name: field.dataType for field in published.read(spark, path).schema.fields}
    sums = current(spark, path, cell, rows).select(*[F.col(name).cast(kind).alias(name) for name, kind in kinds.items()])
    entries = published.stage(sums, path, published.new_run())
    others = [entry for entry in before.entries if entry.area != published.DATA]
    return published.publish(spark, before, path, [*others, *entries])


@dataclass(frozen=True)
class Kept:
    """A fact that is kept by parts of new rows of one raw table."""

    parts: Callable[[DataFrame], DataFrame]
    cell: Sequence[str]
    # the part that counts rows
    rows: str
    # the small raw tables that finish the fact, and how
    reads: Sequence[str]
    finish: Callable[[DataFrame, Mapping[str, DataFrame]], DataFrame]


KEPT = {
    "fct_supplier_otif": Kept(
        lambda lines: gold.scorecard_parts(silver.flag_po_lines(lines), ["component_id"]),
        ("promised_month", "supplier_id", "component_id"),
        "po_lines",
        ("suppliers", "components"),
        lambda parts, raw: gold.scorecard_of(parts, raw["suppliers"], raw["components"]),
    ),
    "fct_purchase_price_variance": Kept(
        lambda lines: gold.variance_parts(lines, ["supplier_id"]),
        ("received_month", "component_id", "supplier_id"),
        "lines",
        ("components", "suppliers"),
        lambda parts, raw: gold.variance_of(parts, raw["components"], raw["suppliers"]),
    ),
    "fct_capacity_plan_vs_actual": Kept(
        gold.requested_parts,
        ("forecast_month", "region_code", "sku_family"),
        "actual_racks",
        ("capacity_forecast", "regions"),
        lambda parts, raw: gold.plan_of(gold.known(parts, raw["regions"], "region_code"), raw["capacity_forecast"]),
    ),
    "fct_capex_by_region": Kept(
        lambda racks: gold.capex_parts(silver.measure_racks(racks)),
        ("in_service_month", "region_code", "sku_family"),
        "racks_in_service",
        ("regions",),
        lambda parts, raw: gold.capex_of(parts, raw["regions"]),
    ),
    "fct_budget_vs_actual": Kept(
        gold.booked_parts,
        ("fiscal_month", "cost_center_id", "account_id"),
        "lines",
        ("budget", "gl_accounts", "cost_centers"),
        lambda parts, raw: gold.budget_of(parts, raw["budget"], raw["gl_accounts"], raw["cost_centers"]),
    ),
}


def refresh(
    spark: SparkSession, root: str, name: str, new: DataFrame, batch: str, old: DataFrame | None = None
) -> published.Version:
    """Bring a fact up to date with new rows of its large raw table, and publish it.

    ``old`` holds corrected rows as they were when they were added. Reads the rows given, the parts so far and the
    small tables; a batch that was added before only publishes the fact again. The stock fact needs its trailing
    months and the aging its as-of day, so they are built whole.
    """
    if name not in KEPT:
        raise ValueError(f"{name} is not kept by parts")
    kept = KEPT[name]
    path = lake.table_path(root, "gold", f"{name}_parts")
    if old is None:
        add(kept.parts(new), path, batch)
    else:
        change(kept.parts(old), kept.parts(new), path, kept.cell, batch)
    summed = current(spark, path, kept.cell, kept.rows)
    raw = lakehouse.bronze_tables(spark, root, kept.reads)
    return published.replace_table(kept.finish(summed, raw), lake.table_path(root, "gold", name))
