import random

from pyspark.sql import functions as F

from stockledger.operators import supply
from stockledger import fixed_values as fixed
from tests.rows import by, day, frame


def test_month_spine_starts_with_the_launch_month(spark):
    entities = frame(
        spark, "id string, launched string",
        [("old", "2019-03-01"), ("mid month", "2025-02-15"), ("later", "2026-01-01")],
    )
    spine = supply.month_spine(entities, "2025-01-01", "2025-03-31", "launched")
    got = {(r.id, str(r.month), r.month_index) for r in spine.collect()}
    assert got == {
        ("old", "2025-01-01", 0), ("old", "2025-02-01", 1), ("old", "2025-03-01", 2),
        ("mid month", "2025-02-01", 1), ("mid month", "2025-03-01", 2),
    }


def test_censoring_and_status(spark):
    df = frame(
        spark, "id string, received date, qty long",
        [("in", day("2025-01-31"), 5), ("after", day("2025-02-01"), 5), ("never", None, 5)],
    )
    rows = by(supply.derive_status(df, "received", "qty", "2025-01-31"), "id")
    assert [(r["received"], r["qty"], r["status"]) for r in rows.values()] == [
        (day("2025-01-31"), 5, "Closed"), (None, 0, "Open"), (None, 0, "Open"),
    ]
    assert supply.censor_after(df, ["received"], "2025-01-31").filter("received is null").count() == 2


def rack_parts(spark):
    skus = frame(
        spark, "sku_id string, sku_family string, units_per_rack long",
        [("gpu", "GPU Accelerated", 8), ("gc", "General Compute", 20)],
    )
    bom = frame(
        spark, "sku_id string, component_id string, qty_per_unit long",
        [("gpu", "CMP-GPU-01", 8), ("gc", "CMP-CPU-01", 2), ("gc", "CMP-OPT-01", 1)],
    )
    return bom, skus


def test_explode_bom_adds_infrastructure(spark):
    bom, skus = rack_parts(spark)
    parts = supply.explode_bom(bom, skus, fixed.RACK_INFRA, fixed.FAMILY_INFRA)
    got = {(r.sku_id, r.component_id): r.qty_per_rack for r in parts.collect()}
    shared = {"CMP-RCK-01": 1, "CMP-SW-01": 2, "CMP-PDU-01": 2, "CMP-OPT-01": 64}
    expected = {(sku, part): qty for sku in ("gpu", "gc") for part, qty in shared.items()}
    expected |= {("gpu", "CMP-GPU-01"): 64, ("gpu", "CMP-CDU-01"): 1, ("gc", "CMP-CPU-01"): 40}
    assert got == expected


def test_demand_without_infrastructure_adds_repeated_bom_rows(spark):
    bom, skus = rack_parts(spark)
    racks = frame(
        spark, "requested_date date, hub_id string, sku_id string",
        [(day("2025-01-03"), "H", "gc"), (day("2025-01-30"), "H", "gc"), (day("2025-02-01"), "H", "gpu")],
    )
    parts = supply.explode_bom(bom.unionByName(bom.filter("component_id = 'CMP-CPU-01'")), skus)
    got = {
        (str(r.month), r.component_id): r.qty_consumed
        for r in supply.component_demand(racks, parts).collect()
    }
    assert got == {
        ("2025-01-01", "CMP-CPU-01"): 160, ("2025-01-01", "CMP-OPT-01"): 40,
        ("2025-02-01", "CMP-GPU-01"): 64,
    }


def test_price_index_curves_drift_and_bounds(spark):
    parts = frame(
        spark, "component_id string, category string",
        [("g", "GPU"), ("m", "Memory"), ("o", "Power"), ("wild", "Power")],
    )
    drift = frame(
        spark, "component_id string, month date, drift double",
        [("o", day("2025-02-01"), 0.01), ("o", day("2025-03-01"), -0.03)]
        + [("wild", day("2025-01-01"), -0.9), ("g", day("2025-01-01"), 0.5)]
        + [("o", day("2024-12-01"), 0.2), ("nobody", day("2025-01-01"), 0.2)],
    )
    index = supply.price_index(
        parts, "2025-01-01", "2025-03-01", fixed.PRICE_PATHS, drift, fixed.PRICE_BOUNDS
    )
    got = {(r.component_id, r.month.month): round(r.price_index, 6) for r in index.collect()}
    assert [got["o", m] for m in (1, 2, 3)] == [1.0, 1.01, 0.98]
    assert [got["wild", m] for m in (1, 2, 3)] == [0.6, 0.6, 0.6]
    assert [got["g", m] for m in (1, 2)] == [1.0, 1.021816]
    assert [got["m", m] for m in (1, 2)] == [1.067318, 1.060919]
    assert len(got) == 12
    flat = supply.price_index(parts, "2025-01-01", "2025-03-01", fixed.PRICE_PATHS)
    assert flat.filter("component_id = 'o' and price_index = 1.0").count() == 3
    assert flat.count() == 12


def test_rack_cost(spark):
    parts = frame(
        spark, "sku_id string, component_id string, qty_per_rack long", [("s", "a", 2), ("s", "b", 3)]
    )
    costs = frame(spark, "component_id string, standard_cost_usd double", [("a", 10.0), ("b", 0.5)])
    prices = frame(
        spark, "component_id string, month date, price_index double",
        [("a", day("2025-01-01"), 1.1), ("b", day("2025-01-01"), 1.0), ("a", day("2025-02-01"), 0.6)],
    )
    got = by(supply.rack_cost(parts, costs, prices), "month")
    assert {str(k): v["rack_cost_usd"] for k, v in got.items()} == {
        "2025-01-01": 23.5, "2025-02-01": 12.0,
    }


def test_useful_life_and_expected_demand(spark):
    regions = frame(spark, "region_code string, demand_weight double", [("r", 1.35)])
    spine = supply.month_spine(regions, "2024-10-01", "2026-09-01")
    demand = supply.expected_demand(
        spine, fixed.FAMILY_MIX, fixed.BASE_RACKS, 24, fixed.GROWTH, fixed.FAMILY_RAMPS
    ).withColumn(
        "life", supply.useful_life("sku_family", fixed.USEFUL_LIFE, fixed.DEFAULT_LIFE)
    )
    rows = by(demand, "sku_family", "month_index")
    assert len(rows) == 96
    assert round(rows["General Compute", 0]["expected_racks"], 6) == round(140 * 1.35 * 0.42, 6)
    last = rows["GPU Accelerated", 23]
    assert round(last["expected_racks"], 6) == round(140 * 1.35 * 0.31 * 1.55 * 1.6, 6)
    assert (last["life"], rows["High-Memory", 0]["life"]) == (48, 72)


def test_clamped_balance_against_a_loop(spark):
    rng = random.Random(5)
    moves, expected = [], {}
    for key in range(40):
        balance = 30
        for step in range(1, 25):
            parts = [rng.randint(-40, 35) for _ in range(rng.randint(1, 3))]
            moves += [(key, step, part) for part in parts]
            balance = max(balance + sum(parts), 0)
            expected[key, step] = balance
    df = frame(spark, "key long, step long, delta long", moves)
    got = by(supply.clamped_balance(df, ["key"], "step", "delta", 30), "key", "step")
    assert {k: v["balance"] for k, v in got.items()} == expected
    assert 0 in expected.values()


def test_open_balance_against_its_definition(spark):
    rng = random.Random(6)
    items = []
    for _ in range(400):
        opened = rng.randint(0, 30)
        closed = opened + rng.randint(0, 9) if rng.random() < 0.8 else None
        items.append((rng.choice("abc"), opened, closed, rng.randint(1, 50)))
    items.append(("before only", 0, 1, 7))
    month = lambda n: None if n is None else day(f"{2023 + n // 12}-{n % 12 + 1:02d}-17")
    df = frame(
        spark, "key string, opened date, closed date, qty long",
        [(k, month(o), month(c), q) for k, o, c, q in items],
    )
    rows = supply.open_balance(df, ["key"], "opened", "closed", "qty", "2023-07-01", "2025-05-01")
    got = {(r.key, (r.month.year - 2023) * 12 + r.month.month - 1): r.open_qty for r in rows.collect()}
    expected = {
        (key, m): sum(q for k, o, c, q in items if k == key and o <= m and (c is None or c > m))
        for key in ("a", "b", "c", "before only") for m in range(6, 29)
    }
    assert got == expected


def test_sequence_id_is_dense_and_in_order(spark):
    df = spark.range(0, 5000, 1, 7).select(
        (F.col("id") * 7919 % 5000).alias("key"), F.lit("same").alias("hot")
    )
    numbered = supply.sequence_id(df, ["hot", "key"], fixed.PO_LINE_ID, "id")
    rows = numbered.orderBy("id").collect()
    assert [r.id for r in rows] == [f"POL-{n:07d}" for n in range(1, 5001)]
    assert [r.key for r in rows] == list(range(5000))


def test_map_override(spark):
    racks = frame(spark, "region_code string", [("sea-2",), ("apj-2",), ("none",)])
    hubs = frame(spark, "region_code string, hub_id string", [("sea-2", "HUB-IAD")])
    got = supply.map_with_override(racks, hubs, "region_code", "hub_id", fixed.HUB_OVERRIDES)
    assert {r.region_code: r.hub_id for r in got.collect()} == {
        "sea-2": "HUB-IAD", "apj-2": "HUB-SIN", "none": None,
    }
