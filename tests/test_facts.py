from datetime import timedelta

from stockledger.operators import gold, silver
from tests.rows import PO, by, components, day, frame, po, suppliers


def lines(spark, *rows):
    return silver.flag_po_lines(frame(spark, PO, list(rows)))


def test_flags_of_open_and_closed_lines(spark):
    flagged = by(
        lines(
            spark,
            po("on the day", received="2025-03-10", got=10),
            po("a day late", received="2025-03-11", got=10),
            po("one short", received="2025-03-09", got=9),
            po("open"),
        ),
        "po_line_id",
    )
    flags = {k: (v["is_on_time"], v["is_in_full"], v["is_otif"], v["days_late"])
             for k, v in flagged.items()}
    assert flags == {
        "on the day": (True, True, True, 0),
        "a day late": (False, True, False, 1),
        "one short": (True, False, False, -1),
        "open": (False, False, False, None),
    }


def test_enrich_drops_unknown_dimensions_and_keeps_both_categories(spark):
    po_lines = frame(spark, PO, [
        po("known", received="2025-03-10", got=10),
        po("no supplier", supplier="S9"),
        po("no component", component="C9"),
    ])
    rows = by(silver.enrich_po_lines(po_lines, suppliers(spark), components(spark)), "po_line_id")
    assert list(rows) == ["known"]
    assert rows["known"]["supplier_category"] == "Memory"
    assert rows["known"]["component_category"] == "CPU"
    assert rows["known"]["ppv_usd"] == 10.0
    assert rows["known"]["received_value_usd"] == 50.0


def test_scorecard_by_hand(spark):
    flagged = lines(
        spark,
        po("a", received="2025-03-10", got=10),
        po("b", received="2025-03-14", got=10),
        po("c", received="2025-03-20", got=7),
        po("open counts nowhere"),
        po("d", supplier="S2", promised="2025-04-30", received="2025-04-29", got=10),
        po("e", supplier="S3"),
        po("unknown part", component="C9", received="2025-03-10", got=10),
    )
    scores = by(
        gold.supplier_scorecard(flagged, suppliers(spark), components(spark)),
        "supplier_id", "promised_month",
    )
    assert set(scores) == {("S1", day("2025-03-01")), ("S2", day("2025-04-01"))}
    one = scores["S1", day("2025-03-01")]
    assert (one["po_lines"], one["qty_ordered"], one["qty_received"]) == (3, 30, 27)
    assert (one["on_time_pct"], one["in_full_pct"], one["otif_pct"]) == (33.3, 66.7, 33.3)
    assert one["avg_days_late_when_late"] == 7.0
    assert one["received_value_usd"] == 135.0
    assert scores["S2", day("2025-04-01")]["avg_days_late_when_late"] is None


def test_price_variance_with_zero_standard(spark):
    flagged = frame(spark, PO, [
        po("a", received="2025-03-10", got=10, cost=5.0),
        po("b", received="2025-03-31", got=10, cost=3.5),
        po("c", component="C2", received="2025-03-10", got=4, cost=1.25),
        po("nothing came", received="2025-03-10", got=0),
    ])
    rows = by(gold.price_variance(flagged, components(spark), suppliers(spark)), "component_id")
    assert rows["C1"]["received_month"] == day("2025-03-01")
    assert rows["C1"]["standard_value_usd"] == 80.0
    assert rows["C1"]["actual_value_usd"] == 85.0
    assert (rows["C1"]["ppv_usd"], rows["C1"]["ppv_pct"]) == (5.0, 6.25)
    assert (rows["C2"]["ppv_usd"], rows["C2"]["ppv_pct"]) == (5.0, None)


def test_plan_vs_actual_keeps_every_forecast_and_no_other_cell(spark):
    forecast = frame(
        spark,
        "forecast_month string, region_code string, sku_family string, "
        "forecast_version string, forecast_racks long",
        [
            ("2025-01-01", "r1", "A", "P6M", 10),
            ("2025-01-01", "r1", "A", "P1M", 8),
            ("2025-02-01", "r1", "A", "P6M", 0),
            ("2025-03-01", "r1", "A", "other", 4),
        ],
    )
    racks = frame(
        spark, "requested_date date, region_code string, sku_family string",
        [(day("2025-01-05"), "r1", "A")] * 9 + [(day("2025-04-01"), "r1", "A")],
    )
    rows = by(gold.plan_vs_actual(forecast, racks), "forecast_month")
    assert set(rows) == {day(f"2025-0{m}-01") for m in (1, 2, 3)}
    january = rows[day("2025-01-01")]
    assert (january["variance_vs_plan"], january["variance_vs_commit"]) == (-1, 1)
    assert (january["plan_abs_pct_error"], january["commit_abs_pct_error"]) == (10.0, 12.5)
    february = rows[day("2025-02-01")]
    assert (february["actual_racks"], february["variance_vs_plan"]) == (0, 0)
    assert (february["plan_abs_pct_error"], february["commit_1m_racks"]) == (None, None)


def test_days_of_supply_trails_rows_and_not_months(spark):
    ends = ["2025-01-31", "2025-02-28", "2025-05-31", "2025-06-30"]
    snapshots = frame(
        spark,
        "snapshot_date date, hub_id string, component_id string, on_hand_qty long, "
        "on_order_qty long, avg_age_days long",
        [(day(e), "H", "C1", 90, 0, age) for e, age in zip(ends, (179, 180, 181, 10))]
        + [(day("2025-01-31"), "H", "C2", 5, 0, 1)],
    )
    used = frame(
        spark, "month date, hub_id string, component_id string, qty_consumed long",
        [(day("2025-01-01"), "H", "C1", 30), (day("2025-05-01"), "H", "C1", 60),
         (day("2025-04-01"), "H", "C1", 999)],
    )
    rows = by(gold.days_of_supply(snapshots, used, components(spark)), "component_id", "snapshot_date")
    c1 = [rows["C1", day(e)] for e in ends]
    assert [r["qty_consumed"] for r in c1] == [30, 0, 60, 0]
    assert [r["avg_monthly_consumption_3m"] for r in c1] == [30.0, 15.0, 30.0, 20.0]
    assert [r["days_of_supply"] for r in c1] == [90.0, 180.0, 90.0, 135.0]
    assert [r["is_eo_risk"] for r in c1] == [False, False, True, False]
    assert rows["C2", day("2025-01-31")]["days_of_supply"] is None
    assert c1[0]["on_hand_value_usd"] == 360.0


def test_capex_skips_what_is_not_installed(spark):
    racks = silver.measure_racks(frame(
        spark,
        "rack_id string, region_code string, sku_family string, requested_date date, "
        "shipped_date date, installed_date date, live_date date, capex_usd double, "
        "useful_life_months long",
        [
            ("a", "r1", "A", day("2025-01-01"), day("2025-01-05"), day("2025-01-31"),
             day("2025-02-01"), 4800.0, 48),
            ("b", "r1", "A", day("2025-01-02"), day("2025-01-05"), day("2025-01-31"), None,
             4800.0, 48),
            ("c", "r1", "A", day("2025-01-02"), None, None, None, 1.0, 48),
        ],
    ))
    regions = frame(spark, "region_code string, region_name string", [("r1", "North")])
    (row,) = gold.capex_by_region(racks, regions).collect()
    assert (row.racks_in_service, row.capex_usd) == (2, 9600.0)
    assert row.added_monthly_depreciation_usd == 200.0
    assert row.avg_request_to_live_days == 31.0


def test_budget_vs_actual_fills_both_sides(spark):
    journal = frame(
        spark, "posting_date date, account_id string, cost_center_id string, amount_usd double",
        [
            (day("2025-01-05"), "5100", "CC", 100.0), (day("2025-01-31"), "5100", "CC", 20.5),
            (day("2025-02-05"), "5100", "CC", 7.0), (day("2025-01-05"), "1400", "CC", 999.0),
            (day("2025-04-01"), "5100", "CC", 3.0),
        ],
    )
    budget = frame(
        spark, "fiscal_month string, cost_center_id string, account_id string, budget_usd double",
        [("2025-01-01", "CC", "5100", 100.0), ("2025-03-01", "CC", "5100", 50.0),
         ("2025-04-01", "CC", "5100", 0.0)],
    )
    accounts = frame(
        spark, "account_id string, account_name string, account_type string",
        [("5100", "Depreciation", "Opex"), ("1400", "Inventory", "Asset")],
    )
    centers = frame(
        spark, "cost_center_id string, cost_center_name string, org string, region_code string",
        [("CC", "Center", "Org", "global")],
    )
    rows = by(gold.budget_vs_actual(journal, budget, accounts, centers), "fiscal_month")
    got = {
        str(k): (v["actual_usd"], v["budget_usd"], v["variance_usd"], v["variance_pct"])
        for k, v in rows.items()
    }
    assert got == {
        "2025-01-01": (120.5, 100.0, 20.5, 20.5),
        "2025-02-01": (7.0, 0.0, 7.0, None),
        "2025-03-01": (0.0, 50.0, -50.0, -100.0),
        "2025-04-01": (3.0, 0.0, 3.0, None),
    }
    assert rows[day("2025-03-01")]["account_name"] == "Depreciation"


def test_aging_bucket_edges(spark):
    # the latest invoice is paid and still sets the as-of date
    rows = [("newest", "S2", day("2025-06-30"), day("2025-07-30"), day("2025-06-30"), 1.0)]
    late = {"a": 0, "b": 1, "c": 30, "d": 31, "e": 60, "f": 61, "g": 90, "h": 91, "i": -5}
    for n, (name, days) in enumerate(late.items()):
        due = day("2025-06-30") - timedelta(days=days)
        rows.append((name, "S1", day("2025-01-01"), due, None, float(2**n)))
    invoices = frame(
        spark,
        "invoice_id string, supplier_id string, invoice_date date, due_date date, "
        "paid_date date, amount_usd double",
        rows,
    )
    (row,) = gold.aging(invoices, suppliers(spark)).collect()
    assert row.as_of_date == day("2025-06-30")
    assert (row.supplier_id, row.open_invoices, row.open_usd) == ("S1", 9, 511.0)
    assert row.current_usd == 1.0 + 256.0
    assert row.past_due_1_30_usd == 2.0 + 4.0
    assert row.past_due_31_60_usd == 8.0 + 16.0
    assert row.past_due_61_90_usd == 32.0 + 64.0
    assert row.past_due_over_90_usd == 128.0
