from pyspark.sql import functions as F

from stockledger.operators import ledger, supply
from stockledger import fixed_values as fixed
from tests.rows import PO, by, components, day, frame, po, suppliers

RACK = (
    "rack_id string, region_code string, sku_id string, sku_family string, "
    "installed_date date, capex_usd double, useful_life_months long"
)


def racks(spark):
    return frame(spark, RACK, [
        ("a", "r1", "s", "A", day("2025-01-31"), 4800.0, 48),
        ("short", "r1", "s", "A", day("2025-02-03"), 100.0, 2),
        ("last month", "r1", "s", "A", day("2025-06-10"), 4800.0, 48),
        ("in flight", "r1", "s", "A", None, 4800.0, 48),
    ])


def centers(spark):
    return frame(spark, "region_code string, cost_center_id string", [("r1", "CC-2100")])


def test_receipts_post_three_balanced_lines(spark):
    lines = frame(spark, PO, [
        po("a", received="2025-03-10", got=10, cost=5.333),
        po("none came", received="2025-03-10", got=0),
        po("open"),
    ])
    rows = by(ledger.post_receipts(lines, components(spark)), "reference", "line")
    assert {k: (v["account_id"], v["cost_center_id"], v["amount_usd"], v["memo"])
            for k, v in rows.items()} == {
        ("a", 1): ("1400", "CC-1100", 40.0, "Receipt C1"),
        ("a", 2): ("5600", "CC-1300", 13.33, "PPV vs standard"),
        ("a", 3): ("2100", "CC-1100", -53.33, "AP accrual"),
    }
    assert {r["source"] for r in rows.values()} == {"PO Receipt"}


def test_capitalization_mirrors_the_asset(spark):
    rows = by(ledger.post_capitalization(racks(spark), centers(spark)), "reference", "line")
    assert len(rows) == 6
    assert rows["a", 1]["account_id"] == "1500" and rows["a", 1]["cost_center_id"] == "CC-2100"
    assert rows["a", 2]["account_id"] == "1400" and rows["a", 2]["cost_center_id"] == "CC-1100"
    assert rows["a", 1]["amount_usd"] == -rows["a", 2]["amount_usd"] == 4800.0
    assert rows["a", 1]["memo"] == "Rack in service s"


def test_schedule_starts_next_month_and_stops_at_life(spark):
    schedule = ledger.depreciation_schedule(racks(spark), "2025-06-30", cap_at_life=True)
    months = {}
    for r in schedule.collect():
        months.setdefault(r.rack_id, []).append((str(r.posting_date), r.depreciation_usd))
    assert sorted(months["a"]) == [
        (e, 100.0) for e in
        ("2025-02-28", "2025-03-31", "2025-04-30", "2025-05-31", "2025-06-30")
    ]
    assert sorted(months["short"]) == [("2025-03-31", 50.0), ("2025-04-30", 50.0)]
    assert set(months) == {"a", "short"}
    uncapped = ledger.depreciation_schedule(racks(spark), "2025-06-30")
    assert uncapped.filter("rack_id = 'short'").count() == 4


def test_totals_agree_with_the_schedule(spark):
    for cap in (True, False):
        totals = by(
            ledger.depreciation_totals(racks(spark), ["region_code"], "2025-06-30", cap),
            "posting_date",
        )
        schedule = ledger.depreciation_schedule(racks(spark), "2025-06-30", cap)
        expected = by(
            schedule.groupBy("posting_date").agg(
                F.sum("depreciation_usd").alias("usd"), F.count("*").alias("n")
            ),
            "posting_date",
        )
        assert {k: (v["depreciation_usd"], v["assets"]) for k, v in totals.items()} == {
            k: (v["usd"], v["n"]) for k, v in expected.items()
        }


def test_depreciation_and_writedown_postings_balance(spark):
    schedule = ledger.depreciation_schedule(racks(spark), "2025-06-30")
    posted = ledger.post_depreciation(schedule, centers(spark))
    assert posted.count() == 2 * schedule.count()
    assert posted.agg(F.sum("amount_usd")).first()[0] == 0.0
    assert {r.account_id for r in posted.select("account_id").distinct().collect()} == {"5100", "1590"}
    loss = frame(
        spark, "month date, amount_usd double",
        [(day("2025-03-01"), 10.5), (day("2025-04-01"), 99.0), (day("2025-12-01"), 2.0)],
    )
    rows = by(ledger.post_writedowns(loss), "reference", "line")
    assert set(rows) == {("EO-2025-03", 1), ("EO-2025-03", 2), ("EO-2025-12", 1), ("EO-2025-12", 2)}
    assert rows["EO-2025-03", 1]["posting_date"] == day("2025-03-31")
    assert (rows["EO-2025-03", 1]["account_id"], rows["EO-2025-03", 2]["amount_usd"]) == ("5700", -10.5)


def test_recurring_accruals(spark):
    cost_centers = frame(
        spark, "cost_center_id string, demand_weight double, launched string",
        [("CC-2100", 1.0, "2019-01-01"), ("CC-2600", 0.3, "2025-04-01")],
    )
    spine = supply.month_spine(cost_centers, "2024-10-01", "2026-09-01", "launched")
    posted = ledger.recurring_accruals(
        spine, fixed.REGION_RUN_RATE, 24, fixed.GROWTH, fixed.SEASONS, "demand_weight"
    )
    rows = by(posted, "cost_center_id", "account_id", "posting_date")
    assert len(rows) == 5 * (24 + 18)
    first = rows["CC-2100", "5300", day("2024-10-31")]
    assert (first["amount_usd"], first["reference"]) == (3_800_000.0, "CC-2100-2024-10")
    assert first["memo"] == "5300 monthly accrual"
    assert rows["CC-2600", "5800", day("2026-09-30")]["amount_usd"] == 83_700.0
    assert rows["CC-2100", "5200", day("2024-10-31")]["amount_usd"] != 7_500_000.0


def test_global_accruals_are_flat(spark):
    spine = supply.month_spine(
        frame(spark, "cost_center_id string", [("CC-3100",)]), "2024-10-01", "2024-11-01"
    )
    posted = ledger.recurring_accruals(spine, fixed.GLOBAL_RUN_RATE)
    assert {(str(r.posting_date), r.account_id, r.amount_usd, r.source, r.memo)
            for r in posted.collect()} == {
        (end, account, amount, source, memo)
        for end in ("2024-10-31", "2024-11-30")
        for account, amount, source, memo in (
            ("5400", 420000.0, "Payroll", "Salaries & benefits"),
            ("5800", 35000.0, "Accrual", "Consulting / services"),
        )
    }


def test_opex_and_budget(spark):
    journal = frame(
        spark, "posting_date date, cost_center_id string, account_id string, amount_usd double",
        [(day("2025-01-31"), "CC", "5100", 100.0), (day("2025-01-02"), "CC", "5100", 50.0),
         (day("2025-01-02"), "CC", "5400", 10.0), (day("2025-01-02"), "CC", "1500", 7.0)],
    )
    actuals = ledger.opex_by_month(journal)
    budget = by(
        ledger.derive_budget(actuals, fixed.BUDGET_FACTORS, fixed.DEFAULT_BUDGET_FACTOR),
        "account_id",
    )
    assert set(budget) == {"5100", "5400"}
    assert budget["5100"]["budget_usd"] == 141.0 and budget["5400"]["budget_usd"] == 10.2
    assert budget["5100"]["fiscal_month"] == "2025-01-01"


def test_invoice_takes_the_first_lines_supplier(spark):
    lines = frame(spark, PO, [
        po("2", supplier="S1", received="2025-03-20", got=2, cost=1.5),
        po("1", supplier="S2", received="2025-03-10", got=1, cost=2.0),
        po("3", supplier="S3"),
        po("4", number="PO-2", received="2025-03-10", got=0),
    ])
    (row,) = ledger.invoice_rollup(lines, suppliers(spark), lag_days=1).collect()
    assert (row.po_number, row.supplier_id, row.amount_usd) == ("PO-1", "S2", 5.0)
    assert (row.invoice_date, row.due_date) == (day("2025-03-21"), day("2025-05-05"))


def test_tie_out_shows_what_is_missing(spark):
    lines = frame(spark, "ref string, usd double", [("both", -5.0), ("source only", -2.0)])
    journal = frame(
        spark, "reference string, account_id string, amount_usd double",
        [("both", "2100", -2.0), ("both", "2100", -3.0), ("both", "1400", 9.0),
         ("journal only", "2100", -1.0)],
    )
    rows = by(ledger.tie_out(lines, journal, "ref", "usd", "2100"), "reference")
    assert {k: v["difference_usd"] for k, v in rows.items()} == {
        "both": 0.0, "source only": -2.0, "journal only": 1.0,
    }
