"""Raw tables to facts and checks, in one run over a small lake."""

import pytest
from pyspark.sql import functions as F

from stockledger import fixed_values as fixed
from stockledger.plans import lakehouse
from stockledger.sources import tables as lake
from tests.rows import PO, by, components, day, frame, po, suppliers


@pytest.fixture(scope="module")
def root(spark, tmp_path_factory):
    return small_lake(spark, str(tmp_path_factory.mktemp("lake")))


def small_lake(spark, folder):
    """The raw tables of a small lake, written under a folder."""
    rack = (
        "rack_id string, region_code string, hub_id string, sku_id string, sku_family string, "
        "requested_date date, shipped_date date, installed_date date, live_date date, "
        "capex_usd double, useful_life_months long"
    )
    d = day
    raw = {
        "regions": frame(
            spark, "region_code string, region_name string, country string, launched_date string",
            [("r1", "North", "US", "2019-03-01"), ("r2", "South", "JP", "2025-02-01")],
        ),
        "hubs": frame(spark, "hub_id string, hub_name string, region_code string", [("H1", "Hub", "r1")]),
        "suppliers": suppliers(spark),
        "components": components(spark).withColumn("supplier_id", F.lit("S1")),
        "server_skus": frame(
            spark, "sku_id string, sku_name string, sku_family string, units_per_rack long",
            [("s", "Server", "General Compute", 10)],
        ),
        "bom": frame(spark, "sku_id string, component_id string, qty_per_unit long", [("s", "C1", 3)]),
        "purchase_orders": frame(spark, PO, [
            po("POL-1", received="2025-03-10", got=10),
            po("POL-2", received="2025-03-12", got=9, component="C2"),
            po("POL-3"),
        ]),
        "inventory_snapshots": frame(
            spark,
            "snapshot_date date, hub_id string, component_id string, on_hand_qty long, "
            "on_order_qty long, avg_age_days long",
            [(d("2025-01-31"), "H1", "C1", 60, 0, 10), (d("2025-01-31"), "H1", "C2", 60, 0, 200)],
        ),
        "capacity_forecast": frame(
            spark,
            "forecast_month string, region_code string, sku_family string, "
            "forecast_version string, forecast_racks long",
            [("2025-01-01", "r1", "General Compute", "P6M", 2)],
        ),
        "rack_deployments": frame(spark, rack, [
            ("RCK-1", "r1", "H1", "s", "General Compute", d("2025-01-02"), d("2025-01-09"),
             d("2025-01-15"), d("2025-01-20"), 7200.0, 72),
            ("RCK-2", "r1", "H1", "s", "General Compute", d("2025-01-03"), None, None, None,
             7200.0, 72),
            ("RCK-3", "nowhere", "H1", "s", "General Compute", d("2025-01-03"), None, None, None,
             7200.0, 72),
        ]),
        "supplier_invoices": frame(
            spark,
            "invoice_id string, supplier_id string, po_number string, invoice_date date, "
            "due_date date, paid_date date, amount_usd double, currency string",
            [("INV-1", "S1", "PO-1", d("2025-03-13"), d("2025-04-12"), None, 95.0, "USD"),
             ("INV-2", "S2", "PO-2", d("2025-03-01"), d("2025-04-15"), d("2025-04-01"), 1.0, "USD")],
        ),
        "cost_centers": frame(
            spark,
            "cost_center_id string, cost_center_name string, org string, region_code string",
            [("CC-1", "Center", "Finance", "global")],
        ),
        "gl_accounts": frame(
            spark, "account_id string, account_name string, account_type string",
            [("5100", "Depreciation Expense", "Opex"), ("1400", "Inventory", "Asset")],
        ),
        "gl_journal": frame(
            spark,
            "journal_id string, posting_date date, account_id string, cost_center_id string, "
            "amount_usd double, source string, reference string, memo string",
            [("JE-1", d("2025-02-28"), "5100", "CC-1", 100.0, "Depreciation", "RCK-1", "x"),
             ("JE-2", d("2025-02-28"), "1400", "CC-1", 7.0, "PO Receipt", "POL-1", "x")],
        ),
        "budget": frame(
            spark,
            "fiscal_month string, cost_center_id string, account_id string, budget_usd double",
            [("2025-02-01", "CC-1", "5100", 80.0)],
        ),
    }
    assert list(raw) == fixed.BRONZE
    for name, df in raw.items():
        lake.write_table(df, folder, "bronze", name)
    return folder


@pytest.fixture(scope="module")
def report(spark, root):
    return by(lakehouse.build(spark, root), "table_name", "check_name")


def test_twenty_checks_pass(report):
    assert len(report) == 20
    assert {v["failures"] for v in report.values()} == {0}
    assert {table for table, _ in report} == {*fixed.SILVER, *fixed.GOLD}


def test_facts_are_on_disk(spark, root, report):
    def one(name, **where):
        df = lake.read_table(spark, root, name, "gold")
        for column, value in where.items():
            df = df.filter(F.col(column) == value)
        return df.first()

    otif = one("fct_supplier_otif")
    assert (otif.po_lines, otif.on_time_pct, otif.otif_pct) == (2, 50.0, 50.0)
    assert one("fct_purchase_price_variance", component_id="C1").ppv_usd == 10.0
    plan = one("fct_capacity_plan_vs_actual")
    assert (plan.actual_racks, plan.variance_vs_plan) == (2, 0)
    stock = one("fct_inventory_days_of_supply", component_id="C1")
    assert (stock.qty_consumed, stock.days_of_supply) == (60, 30.0)
    assert one("fct_inventory_days_of_supply", component_id="C2").is_eo_risk
    assert one("fct_capex_by_region").added_monthly_depreciation_usd == 100.0
    assert one("fct_budget_vs_actual").variance_pct == 25.0
    assert one("fct_ap_aging").current_usd == 95.0


def test_ad_hoc_sql_sees_raw_tables_and_facts(spark, root, report):
    lakehouse.open_views(spark, root)
    row = spark.sql(
        """
        select s.country is null as unknown, f.supplier_name, round(avg(f.otif_pct), 1) as otif
        from fct_supplier_otif f
        join (select supplier_id, cast(null as string) as country from suppliers) s
          using (supplier_id)
        group by 1, 2 order by 2
        """
    ).first()
    assert (row.supplier_name, row.otif) == ("One", 50.0)


def test_files_written_by_pandas_read_the_same(spark, root, tmp_path):
    for name in fixed.BRONZE:
        table = lakehouse.table(spark, root, name)
        folder = tmp_path / "bronze" / name
        folder.mkdir(parents=True)
        table.toPandas().to_parquet(folder / f"{name}.parquet", index=False)
        again = lakehouse.table(spark, str(tmp_path), name)
        assert again.schema.simpleString() == table.schema.simpleString()
        assert sorted(map(str, again.collect())) == sorted(map(str, table.collect()))


def test_journal_is_appended_once(spark, root, tmp_path):
    lakehouse_root = str(tmp_path)
    raw = lakehouse.bronze_tables(spark, root, ["gl_accounts", "cost_centers", "gl_journal"])
    for name in ("gl_accounts", "cost_centers"):
        lake.write_table(raw[name], lakehouse_root, "bronze", name)
    base = raw["gl_journal"]

    def post(journal_id, date):
        return base.filter("journal_id = 'JE-1'").withColumns(
            {"journal_id": F.lit(journal_id), "posting_date": F.lit(date).cast("date")}
        )

    first = base
    second = base.unionByName(post("JE-3", "2025-03-31")).unionByName(post("JE-4", "2025-02-27"))
    for journal, lookback, expected in ((first, 0, 2), (first, 0, 2), (second, 0, 3), (second, 60, 4)):
        lake.write_table(journal, lakehouse_root, "bronze", "gl_journal")
        lakehouse.append_journal(spark, lakehouse_root, lookback)
        loaded = lakehouse.table(spark, lakehouse_root, "stg_gl_journal")
        assert (loaded.count(), loaded.select("journal_id").distinct().count()) == (expected,) * 2


def test_rows_of_unknown_accounts_wait(spark, root, tmp_path):
    there = str(tmp_path)
    raw = lakehouse.bronze_tables(spark, root, ["gl_accounts", "cost_centers", "gl_journal"])
    account = raw["gl_journal"].orderBy("journal_id").first().account_id
    lake.write_table(raw["cost_centers"], there, "bronze", "cost_centers")
    lake.write_table(raw["gl_journal"], there, "bronze", "gl_journal")
    known = raw["gl_accounts"].filter(F.col("account_id") != account)
    counts = []
    for accounts in (known, known, raw["gl_accounts"], raw["gl_accounts"]):
        lake.write_table(accounts, there, "bronze", "gl_accounts")
        lakehouse.append_journal(spark, there)
        loaded = lakehouse.table(spark, there, "stg_gl_journal")
        counts.append((loaded.count(), loaded.select("journal_id").distinct().count()))
    whole = raw["gl_journal"].count()
    assert counts[0] == counts[1] and counts[0][0] < whole and counts[2] == counts[3] == (whole, whole)


def test_backfill_of_chosen_months(spark, root, tmp_path):
    copy = str(tmp_path)
    for name, df in lakehouse.bronze_tables(spark, root).items():
        lake.write_table(df, copy, "bronze", name)
    assert set(lakehouse.GOLD_MODELS) == {*fixed.GOLD_DATES, "fct_ap_aging"} == set(fixed.GOLD)
    with pytest.raises(ValueError, match="snapshot"):
        lakehouse.backfill_gold(spark, copy, "fct_ap_aging", ["2025-01-01"])
    for name, column in fixed.GOLD_DATES.items():
        whole = lake.read_table(spark, root, name, "gold")
        for dates in (None, [str(whole.first()[column])], ["1999-01-01"]):
            lakehouse.backfill_gold(spark, copy, name, dates)
            written = lakehouse.table(spark, copy, name).select(whole.columns)
            assert sorted(map(str, written.collect())) == sorted(map(str, whole.collect())), name


def test_backfill_filter_sinks_below_the_grouping(spark, root):
    raw = lakehouse.bronze_tables(spark, root, ["rack_deployments", "regions"])
    facts = lakehouse.GOLD_MODELS["fct_capex_by_region"].over(raw)
    month = facts.filter(F.col("in_service_month") == F.lit("2025-01-01").cast("date"))
    plan = month._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Aggregate") < plan.index("trunc(installed_date")


def test_command_line(spark, root, tmp_path, monkeypatch, capfd):
    from stockledger import __main__ as command

    def run(*words):
        monkeypatch.setattr("sys.argv", ["stockledger", *words])
        command.main()
        return capfd.readouterr().out

    assert "gl_journal" in run("land", f"{root}/bronze", str(tmp_path))
    assert run("build", str(tmp_path)).count("unique(") == 8
    assert "One" in run("sql", str(tmp_path), "select supplier_name from fct_ap_aging")
    assert run("sql", str(tmp_path), "select id from range(250)").split() == ["id", *map(str, range(250))]
    assert len(run("sql", str(tmp_path), "select id from range(250)", "--limit", "7").split()) == 8
    run("sql", str(tmp_path), "select id from range(250)", "--out", f"{tmp_path}/result")
    assert spark.read.parquet(f"{tmp_path}/result").count() == 250
    assert lakehouse.table(spark, str(tmp_path), "suppliers", limit=2).count() == 2
