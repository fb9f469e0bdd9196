"""What keeps the plans safe on large and uneven data."""

import re
from contextlib import contextmanager
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import SMOKE
from stockledger import settings
from stockledger.operators import gold, ledger, silver
from stockledger.plans import lakehouse
from stockledger.plans.catalog import QUERIES
from stockledger.sources.trial import Trial

ROOT = Path(__file__).resolve().parents[1]


@contextmanager
def conf(spark, **values):
    keys = {k.replace("__", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def final_plan(df):
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def uneven(spark, tmp_path_factory):
    """Half of the lines belong to one supplier and one component."""
    folder = str(tmp_path_factory.mktemp("uneven"))
    n = 120_000
    hot = F.col("id") % 2 == 0
    spread = (F.col("id") * 7919) % 500
    spark.range(0, n, 1, 12).select(
        F.concat(F.lit("POL-"), F.col("id").cast("string")).alias("po_line_id"),
        (F.col("id") / 2).cast("long").alias("po_number"),
        F.when(hot, 7).otherwise(spread).cast("long").alias("supplier_id"),
        F.when(hot, 9).otherwise(spread).cast("long").alias("component_id"),
        (F.col("id") % 5).alias("hub_id"),
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 700).cast("int")).alias("order_date"),
        F.date_add(F.lit("2024-02-01").cast("date"), (F.col("id") % 700).cast("int")).alias("promised_date"),
        F.date_add(F.lit("2024-01-25").cast("date"), (F.col("id") % 713).cast("int")).alias("received_date"),
        F.lit(10).cast("long").alias("qty_ordered"),
        (F.col("id") % 11).alias("qty_received"),
        (F.lit(5.0) + F.col("id") % 100 / 100.0).alias("unit_cost_usd"),
        F.lit("Closed").alias("status"),
    ).write.parquet(f"{folder}/po")
    spark.range(500).select(
        F.col("id").alias("supplier_id"),
        F.concat(F.lit("S"), F.col("id").cast("string")).alias("supplier_name"),
        F.lit("c").alias("category"),
        F.lit(30).cast("long").alias("payment_terms_days"),
        F.lit(True).alias("strategic_flag"),
    ).write.parquet(f"{folder}/suppliers")
    spark.range(500).select(
        F.col("id").alias("component_id"),
        F.lit("n").alias("component_name"),
        F.lit("c").alias("category"),
        F.lit(5.0).alias("standard_cost_usd"),
    ).write.parquet(f"{folder}/components")
    return {name: spark.read.parquet(f"{folder}/{name}") for name in ("po", "suppliers", "components")}


# every dimension is too large to broadcast, and partitions count as skewed early
LARGE = {
    "spark__sql__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "20k",
    "spark__sql__adaptive__skewJoin__skewedPartitionFactor": "2",
    "spark__sql__adaptive__advisoryPartitionSizeInBytes": "40k",
    "spark__sql__adaptive__coalescePartitions__parallelismFirst": "false",
}


def test_hot_keys_are_split_when_dimensions_are_large(spark, uneven):
    settings.tune(spark)
    with conf(spark, **LARGE):
        plan = final_plan(
            silver.enrich_po_lines(uneven["po"], uneven["suppliers"], uneven["components"])
        )
        rows = silver.enrich_po_lines(
            uneven["po"], uneven["suppliers"], uneven["components"]
        ).count()
    assert "SortMergeJoin(skew=true)" in plan
    assert "BroadcastHashJoin" not in plan
    assert rows == 120_000


def test_results_do_not_depend_on_the_join_strategy(spark, uneven):
    settings.tune(spark)
    lines = silver.flag_po_lines(uneven["po"])

    def results():
        scores = gold.supplier_scorecard(lines, uneven["suppliers"], uneven["components"])
        prices = gold.price_variance(uneven["po"], uneven["components"], uneven["suppliers"])
        journal = ledger.post_receipts(uneven["po"], uneven["components"])
        owed = uneven["po"].select(
            "po_line_id", (-F.col("qty_received") * F.col("unit_cost_usd")).alias("usd")
        )
        ties = ledger.tie_out(owed, journal, "po_line_id", "usd", "2100")
        assert ties.filter("difference_usd <> 0").count() == 0
        return sorted(map(str, scores.collect())), sorted(map(str, prices.collect()))

    small = results()
    with conf(spark, **LARGE):
        assert results() == small


def test_facts_are_reduced_before_the_dimension_join(spark, uneven):
    lines = silver.flag_po_lines(uneven["po"])
    for df in (
        gold.supplier_scorecard(lines, uneven["suppliers"], uneven["components"]),
        gold.price_variance(uneven["po"], uneven["components"], uneven["suppliers"]),
    ):
        with conf(spark, **LARGE):
            plan = df.select("*")._jdf.queryExecution().executedPlan().toString()
        # plans print parents first: the last sums above the lines' scan have no exchange below them
        above, scan = plan.rindex("partial_sum"), plan.index("status")
        assert plan.count("Join") == 2
        assert "Exchange" not in plan[above : plan.index("FileScan", above)] and scan


def test_a_backfill_reads_its_dates(spark, tmp_path):
    dated = {"purchase_orders": "promised_date", "gl_journal": "posting_date"}
    for name, column in dated.items():
        day = F.lit("2025-01-15").cast("date")
        rows = spark.range(5).select(day.alias("promised_date"), day.alias("received_date"),
                                     day.alias("posting_date"), F.lit("2025-01-01").alias("fiscal_month"))
        rows.write.parquet(f"{tmp_path}/{name}")
        model = {"purchase_orders": "fct_supplier_otif", "gl_journal": "fct_budget_vs_actual"}[name]
        raw = {t: spark.read.parquet(f"{tmp_path}/{name}") for t, _, _ in lakehouse.GOLD_MODELS[model].dated}
        kept = lakehouse.GOLD_MODELS[model].within(raw, ["2025-01-01", "2025-03-01"])
        with conf(spark, spark__sql__maxMetadataStringLength="2000"):
            plan = kept[name]._jdf.queryExecution().executedPlan().toString()
        assert f"GreaterThanOrEqual({column},2025-01-01)" in plan
        assert f"LessThanOrEqual({column},2025-03-31)" in plan
    assert {n for n, m in lakehouse.GOLD_MODELS.items() if not m.dated} == {
        "fct_ap_aging", "fct_inventory_days_of_supply",
    }


def test_only_needed_columns_and_closed_lines_are_read(spark, uneven):
    with conf(spark, spark__sql__maxMetadataStringLength="2000"):
        plan = gold.price_variance(uneven["po"], uneven["components"])._jdf.queryExecution()
        text = plan.executedPlan().toString()
    assert "EqualTo(status,Closed)" in text and "GreaterThan(qty_received,0)" in text
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", text)
    (schema,) = [found for found in schemas if "status" in found]
    assert {c.split(":")[0] for c in schema.split(",")} == {
        "component_id", "received_date", "qty_received", "unit_cost_usd", "status",
    }


def test_no_query_multiplies_tables_or_runs_python_rows(spark):
    writes_files = {"gold_roundtrip", "csv_roundtrip", "land_bronze", "load_by_name",
                    "partition_backfill", "ingest_stream", "sequence_id", "load_mixed_files",
                    "land_files", "backfill_emptied", "invoice_ids", "assemble_journal"}
    for name, build in QUERIES.items():
        if name in writes_files:
            continue
        plan = build(spark, SMOKE)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan, name
        assert "Python" not in plan, name


def test_windows_see_aggregated_rows_only(spark):
    """Each window partition is bounded by months, whatever a key's share of rows."""
    t = Trial(spark, SMOKE)
    from stockledger.plans import catalog

    names = "clamped_balance balance_grid open_balance days_of_supply depreciation_totals"
    for name in names.split():
        plan = getattr(catalog, name)(t)._jdf.queryExecution().executedPlan().toString()
        below = plan[plan.index("Window ["):]
        assert "partial_" in below, name


def test_hints_and_collects_stay_out_of_the_library():
    for path in (ROOT / "stockledger").rglob("*.py"):
        if path.parent.name == "llm":
            continue
        text = path.read_text()
        assert "localCheckpoint" not in text and "crossJoin" not in text, path
        # names of folders and of at most files_per_batch files, never rows of a table
        names_only = path.name in ("published.py", "drift.py")
        assert (names_only or ".collect()" not in text) and "toPandas" not in text, path
        assert not re.search(r"\budf\b", text), path
        # offsets of generated ids: one row per partition; heavy months: one row for each `heavy` facts at most;
        # buckets that differ: `buckets` rows at most
        allowed = 1 if path.name in ("supply.py", "history.py", "incremental.py") else 0
        assert text.count("broadcast(") == allowed, path


def test_shuffles_are_cut_for_the_input(spark, uneven, tmp_path, monkeypatch):
    spark.conf.unset(settings.PARTITIONS_KEY)
    spark.range(10).write.parquet(f"{tmp_path}/small")
    settings.tune(spark, f"{tmp_path}/small")
    small = int(spark.conf.get(settings.PARTITIONS_KEY))
    assert small == settings.WAVES * spark.sparkContext.defaultParallelism
    for size, width in ((10 * 1024**4, 122_880), (100 * 1024**3, 1200)):
        monkeypatch.setattr(settings, "input_bytes", lambda *_, size=size: size)
        settings.tune(spark, f"{tmp_path}/small")
        assert int(spark.conf.get(settings.PARTITIONS_KEY)) == width
    monkeypatch.undo()
    before = settings.input_bytes(spark, f"{tmp_path}/small")
    spark.range(10_000).write.mode("append").parquet(f"{tmp_path}/small")
    assert settings.input_bytes(spark, f"{tmp_path}/small") > before
    settings.tune(spark)


def test_many_rows_in_small_files_are_not_gathered_on_the_driver(spark, tmp_path):
    rows, folder = spark.range(0, 1_000_000, 1, 4), str(tmp_path)
    price, day = F.rand(3).alias("price"), F.date_add(F.lit("1995-01-01").cast("date"), (F.col("id") % 700).cast("int"))
    orders = rows.select(F.col("id").alias("o_orderkey"), day.alias("o_orderdate"), price.alias("o_totalprice"))
    orders.write.parquet(f"{folder}/orders.parquet")
    rows.select(
        *[F.col("id").alias(name) for name in ("l_orderkey", "l_partkey", "l_suppkey")],
        (F.col("id") % 7).cast("int").alias("l_linenumber"),
        F.lit(8.0).alias("l_quantity"),
        price.alias("l_extendedprice"),
        F.lit("N").alias("l_returnflag"),
        F.lit("F").alias("l_linestatus"),
    ).write.parquet(f"{folder}/lineitem.parquet")
    lines = Trial(settings.tune(spark, folder), folder).purchase_orders()
    assert "Broadcast" not in lines._jdf.queryExecution().executedPlan().toString()
    assert settings.input_bytes(spark, f"{folder}/orders.parquet") < 32 * 1024**2


def test_what_the_user_sets_stays(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    with conf(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        settings.tune(spark)
        assert spark.conf.get(key) == "-1"
