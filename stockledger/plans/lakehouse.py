"""From raw tables to facts and checks.

Facts that need only their own keys read the raw table with its flags added;
the joined silver rows are written for their readers and are no detour on the
way to gold.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockledger import settings
from stockledger.fixed_values import BRONZE, GOLD, GOLD_DATES, SILVER
from stockledger.operators import gold, incremental, silver, supply
from stockledger.operators.quality import Checks, Watch, report_of
from stockledger.sources import published
from stockledger.sources import tables as lake

# The checks that come with the tables.
CHECKS = {
    "stg_purchase_orders": Checks(
        not_null=["po_line_id", "supplier_id", "qty_received"],
        unique=["po_line_id"],
        ranges={"qty_received": (0, None)},
    ),
    "stg_gl_journal": Checks(not_null=["journal_id", "amount_usd"], unique=["journal_id"]),
    "stg_rack_deployments": Checks(not_null=["rack_id", "capex_usd"], unique=["rack_id"]),
    "fct_supplier_otif": Checks(
        ranges={"otif_pct": (0, 100)},
        unique_combinations=[["promised_month", "supplier_id"]],
    ),
    "fct_purchase_price_variance": Checks(not_null=["ppv_usd"]),
    "fct_capacity_plan_vs_actual": Checks(
        unique_combinations=[["forecast_month", "region_code", "sku_family"]]
    ),
    "fct_inventory_days_of_supply": Checks(
        unique_combinations=[["snapshot_date", "hub_id", "component_id"]]
    ),
    "fct_budget_vs_actual": Checks(
        unique_combinations=[["fiscal_month", "cost_center_id", "account_id"]]
    ),
    "fct_ap_aging": Checks(not_null=["supplier_id"], unique=["supplier_id"]),
    "fct_capex_by_region": Checks(not_null=["capex_usd"]),
}


def bronze_tables(
    spark: SparkSession, root: str, names: Sequence[str] = tuple(BRONZE)
) -> dict[str, DataFrame]:
    return {name: lake.read_table(spark, root, name) for name in names}


def table(spark: SparkSession, root: str, name: str, limit: int | None = None) -> DataFrame:
    """Any table of the lake by its name, whatever its layer."""
    layers = {"bronze": BRONZE, "silver": SILVER, "gold": GOLD}
    found = [layer for layer, names in layers.items() if name in names]
    if not found:
        raise ValueError(f"unknown table {name!r}")
    return lake.read_table(spark, root, name, found[0], limit)


@dataclass(frozen=True)
class Model:
    """A table built from raw tables, given in the order of its arguments."""

    reads: tuple[str, ...]
    build: Callable[..., DataFrame]
    # raw tables with the date column that places their rows in a fact's months,
    # and how many months before those the fact looks back
    dated: tuple[tuple[str, str, int], ...] = ()

    def within(self, raw: Mapping[str, DataFrame], dates: Sequence[str]) -> dict[str, DataFrame]:
        """The raw tables without rows that no fact of these dates needs.

        The range is on the raw column, so it reaches the files.
        """
        first, last = F.lit(min(dates)).cast("date"), F.last_day(F.lit(max(dates)).cast("date"))
        kept = dict(raw)
        for name, column, back in self.dated:
            begin = F.add_months(F.trunc(first, "month"), -back)
            begin, end = begin.cast(kept[name].schema[column].dataType), last.cast(kept[name].schema[column].dataType)
            kept[name] = kept[name].filter(F.col(column).between(begin, end))
        return kept

    def over(self, raw: Mapping[str, DataFrame]) -> DataFrame:
        return self.build(*[raw[name] for name in self.reads])


def _scorecard(lines: DataFrame, suppliers: DataFrame, components: DataFrame) -> DataFrame:
    return gold.supplier_scorecard(silver.flag_po_lines(lines), suppliers, components)


def _plan(forecast: DataFrame, racks: DataFrame, regions: DataFrame) -> DataFrame:
    return gold.plan_vs_actual(forecast, gold.known(racks, regions, "region_code"))


def _supply(
    snapshots: DataFrame,
    components: DataFrame,
    racks: DataFrame,
    regions: DataFrame,
    bom: DataFrame,
    skus: DataFrame,
) -> DataFrame:
    built = gold.known(racks, regions, "region_code")
    used = supply.component_demand(built, supply.explode_bom(bom, skus))
    return gold.days_of_supply(snapshots, used, components)


def _capex(racks: DataFrame, regions: DataFrame) -> DataFrame:
    return gold.capex_by_region(silver.measure_racks(racks), regions)


SILVER_MODELS = {
    "stg_purchase_orders": Model(
        ("purchase_orders", "suppliers", "components"), silver.enrich_po_lines
    ),
    "stg_gl_journal": Model(
        ("gl_journal", "gl_accounts", "cost_centers"), silver.enrich_journal
    ),
    "stg_rack_deployments": Model(("rack_deployments", "regions"), silver.enrich_racks),
}
GOLD_MODELS = {
    "fct_supplier_otif": Model(
        ("purchase_orders", "suppliers", "components"),
        _scorecard,
        (("purchase_orders", "promised_date", 0),),
    ),
    "fct_purchase_price_variance": Model(
        ("purchase_orders", "components", "suppliers"),
        gold.price_variance,
        (("purchase_orders", "received_date", 0),),
    ),
    "fct_capacity_plan_vs_actual": Model(
        ("capacity_forecast", "rack_deployments", "regions"),
        _plan,
        (("capacity_forecast", "forecast_month", 0), ("rack_deployments", "requested_date", 0)),
    ),
    "fct_inventory_days_of_supply": Model(
        (
            "inventory_snapshots",
            "components",
            "rack_deployments",
            "regions",
            "bom",
            "server_skus",
        ),
        _supply,
    ),
    "fct_capex_by_region": Model(
        ("rack_deployments", "regions"), _capex, (("rack_deployments", "installed_date", 0),)
    ),
    "fct_budget_vs_actual": Model(
        ("gl_journal", "budget", "gl_accounts", "cost_centers"),
        gold.budget_vs_actual,
        (("gl_journal", "posting_date", 0), ("budget", "fiscal_month", 0)),
    ),
    "fct_ap_aging": Model(("supplier_invoices", "suppliers"), gold.aging),
}


def build(spark: SparkSession, root: str) -> DataFrame:
    """Write silver and gold from bronze and report the checks on what was written.

    Each table is written aside and then switched to, so a run that fails leaves every table whole, old or new.
    Row-wise checks are counted in the writing; only keys are read again.
    """
    settings.tune(spark, f"{root.rstrip('/')}/bronze")
    raw = bronze_tables(spark, root)
    layers = {"silver": SILVER_MODELS, "gold": GOLD_MODELS}
    watched: list[tuple[str, str, int]] = []
    for layer, models in layers.items():
        for name, model in models.items():
            watch = Watch(model.over(raw), name, CHECKS[name])
            published.replace_table(watch.rows, lake.table_path(root, layer, name))
            watched += watch.report()
    written = {name: table(spark, root, name) for name in CHECKS}
    return report_of(spark, watched, written, CHECKS)


#: The areas of journal rows whose account or cost centre is unknown so far, and of those that came too late.
WAITING, LATE = "waiting", "late"


def append_journal(
    spark: SparkSession, root: str, lookback_days: int = 0, batch: str | None = None
) -> published.Version | None:
    """Add to the silver journal what the raw journal holds beyond it.

    The first run takes everything. Rows posted up to ``lookback_days`` before
    the newest loaded date still count as new when their id is unknown. Rows
    whose account or cost centre is unknown so far wait in an area of their
    own and are tried again each time.

    Loaded and waiting rows change in one step, so a run that is killed has
    changed neither and can be started again. With a ``batch`` its name is part
    of that step, and a batch that was applied before changes nothing.
    """
    settings.tune(spark, f"{root.rstrip('/')}/bronze/gl_journal")
    return _append(spark, root, lake.read_table(spark, root, "gl_journal"), lookback_days, batch, False)


def append_rows(
    spark: SparkSession, root: str, rows: DataFrame, lookback_days: int, batch: str
) -> published.Version | None:
    """``append_journal`` for lines that have just arrived, which may repeat among themselves.

    Lines that are too old to be taken go to an area of their own, once for each id.
    """
    return _append(spark, root, rows.dropDuplicates(["journal_id"]), lookback_days, batch, True)


def _append(
    spark: SparkSession, root: str, rows: DataFrame, lookback_days: int, batch: str | None, keep_late: bool
) -> published.Version | None:
    model = SILVER_MODELS["stg_gl_journal"]
    path = lake.table_path(root, "silver", "stg_gl_journal")
    before = published.latest(spark, path)
    if before is None:
        before = _adopt(spark, path)
    if before and batch is not None and published.applied(spark, path, batch):
        return before
    raw = bronze_tables(spark, root, [name for name in model.reads if name != "gl_journal"])
    loaded = before.in_area() if before else []
    waiting = before.in_area(WAITING) if before else []
    late = before.in_area(LATE) if before else []
    fresh, old = rows, None
    if loaded:
        journal = published.frame(spark, path, loaded)
        fresh = incremental.incremental_append(journal, rows, "journal_id", "posting_date", lookback_days)
        if keep_late:
            old = incremental.skipped_rows(journal, rows, "journal_id", "posting_date", lookback_days)
    if waiting:
        held = published.frame(spark, path, waiting)
        if loaded:
            held = held.join(journal.select("journal_id"), "journal_id", "left_anti")
        if old is not None:
            old = old.join(held.select("journal_id"), "journal_id", "left_anti")
        fresh = fresh.join(held, "journal_id", "left_anti")
        fresh = fresh.select(rows.columns).unionByName(held.select(rows.columns))
    # all results come from one copy of the new rows
    copy = settings.scratch(spark, "journal")
    fresh.select(rows.columns).write.parquet(copy)
    raw["gl_journal"] = spark.read.schema(fresh.select(rows.columns).schema).parquet(copy)
    joined = model.over(raw)
    rest = raw["gl_journal"].join(joined, "journal_id", "left_anti").select(rows.columns)
    run = published.new_run()
    entries = [*published.stage(joined, path, run), *published.stage(rest, path, run, area=WAITING)]
    if old is not None:
        if late:
            old = old.join(published.frame(spark, path, late).select("journal_id"), "journal_id", "left_anti")
        entries += published.stage(old.select(rows.columns), path, run, area=LATE)
    return published.publish(spark, before, path, [*[e for e in loaded if e.run], *late, *entries], batch)


def _adopt(spark: SparkSession, path: str, column: str | None = None) -> published.Version | None:
    """Publish what a plain folder holds, if there is one, as a table's first version."""
    try:
        plain = spark.read.parquet(path)
    except AnalysisException as problem:
        if problem.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None
    return published.replace_table(plain, path, column)


def backfill_gold(
    spark: SparkSession, root: str, name: str, dates: Sequence[str] | None = None
) -> published.Version:
    """Write a fact partitioned by its date, or replace some of its dates.

    The rows are written aside and all dates change in one step; a run that
    fails leaves the fact as it was. Raw tables are read in the range of the
    dates. The stock fact averages a key's last snapshot rows, however old they
    are, so it reads all of them. The aging is a snapshot of one day and has no
    dates.
    """
    if name not in GOLD_DATES:
        raise ValueError(f"{name} is a snapshot: build it whole")
    model, column = GOLD_MODELS[name], GOLD_DATES[name]
    settings.tune(spark, *[lake.table_path(root, "bronze", raw) for raw in model.reads])
    raw = bronze_tables(spark, root, model.reads)
    path = lake.table_path(root, "gold", name)
    if not dates:
        facts = model.over(raw)
        return published.replace_table(facts.hint("rebalance", F.col(column)), path, column)
    before = published.latest(spark, path)
    if before is None:
        _adopt(spark, path, column)
    elif any(not entry.slot and entry.run for entry in before.in_area()):
        # the fact was built whole: its days get folders of their own first
        published.replace_table(published.read(spark, path), path, column)
    facts = model.over(model.within(raw, dates)).hint("rebalance", F.col(column))
    return published.replace_days(facts, path, column, dates)


#: The key that repeated joins on a silver table use.
SILVER_KEYS = {
    "stg_purchase_orders": ["supplier_id"],
    "stg_gl_journal": ["account_id"],
    "stg_rack_deployments": ["region_code"],
}


def save_silver(
    spark: SparkSession, root: str, schema: str, buckets: int, keys: dict[str, list[str]] | None = None
) -> dict[str, DataFrame]:
    """The silver layer as bucketed tables of a schema, for joins on the same keys that run often.

    ``buckets`` is for the size at hand: a bucket is read by one task. A key that holds a large share of the rows
    makes one bucket as large, so give ``keys`` that spread.
    """
    return {
        name: lake.save_bucketed(table(spark, root, name), f"{schema}.{name}", (keys or SILVER_KEYS)[name], buckets)
        for name in SILVER_MODELS
    }


def open_views(spark: SparkSession, root: str) -> None:
    """Views over the raw tables and the facts, for ad-hoc SQL."""
    lake.register_views({name: table(spark, root, name) for name in [*BRONZE, *GOLD]})
