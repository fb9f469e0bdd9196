"""Facts that are kept by adding parts, diffs by checksums, tables in buckets."""

import random

from pyspark.sql import functions as F

from stockledger.operators import gold, incremental, silver
from stockledger.plans import lakehouse, rollups
from stockledger.sources import published
from stockledger.sources import tables as lake
from tests.rows import PO, by, components, day, frame, po, suppliers
from tests.test_lakehouse import small_lake

CELL = ["promised_month", "supplier_id", "component_id"]


def some_lines(seed, n):
    r = random.Random(seed)
    return [
        po(
            f"POL-{k}", received=None if r.random() < 0.2 else f"2025-0{r.randrange(1, 6)}-1{r.randrange(10)}",
            got=r.randrange(1, 12), component=r.choice(["C1", "C2", "unknown"]),
        )
        for k in range(n)
    ]


def same(one, other):
    return sorted(map(str, one.collect())) == sorted(map(str, other.select(one.columns).collect()))


def test_added_parts_are_a_whole_rebuild(spark, tmp_path):
    path = f"{tmp_path}/parts"
    rows = some_lines(1, 60)
    held = []
    for k in range(3):
        batch = rows[20 * k : 20 * k + 20]
        held += batch
        new = silver.flag_po_lines(frame(spark, PO, batch))
        for _ in range(2):
            rollups.add(gold.scorecard_parts(new, ["component_id"]), path, f"batch {k}")
        fact = gold.scorecard_of(rollups.current(spark, path, CELL, "po_lines"), suppliers(spark), components(spark))
        whole = gold.supplier_scorecard(silver.flag_po_lines(frame(spark, PO, held)), suppliers(spark), components(spark))
        assert same(fact, whole) and whole.count()
        if k == 1:
            rollups.settle(spark, path, CELL, "po_lines")
            assert len(published.latest(spark, path).entries) == 1


def test_corrected_and_withdrawn_lines(spark, tmp_path):
    path = f"{tmp_path}/parts"
    rows = some_lines(2, 30)
    parts = lambda some: gold.scorecard_parts(silver.flag_po_lines(frame(spark, PO, some)), ["component_id"])
    rollups.add(parts(rows), path, "all")
    rollups.change(parts(rows[:10]), parts([]), path, CELL, "ten withdrawn")
    left = gold.supplier_scorecard(silver.flag_po_lines(frame(spark, PO, rows[10:])), suppliers(spark), components(spark))
    assert same(gold.scorecard_of(rollups.current(spark, path, CELL, "po_lines"), suppliers(spark), components(spark)), left)
    rollups.change(parts(rows[10:]), parts([]), path, CELL, "all withdrawn")
    assert rollups.current(spark, path, CELL, "po_lines").collect() == []


def test_parts_of_the_price_variance(spark, tmp_path):
    path = f"{tmp_path}/parts"
    rows = some_lines(3, 40)
    for k, some in enumerate((rows[:15], rows[15:])):
        rollups.add(gold.variance_parts(frame(spark, PO, some), ["supplier_id"]), path, str(k))
    cell = ["received_month", "component_id", "supplier_id"]
    fact = gold.variance_of(rollups.current(spark, path, cell, "lines"), components(spark), suppliers(spark))
    assert same(fact, gold.price_variance(frame(spark, PO, rows), components(spark), suppliers(spark)))


def test_checksum_diff_is_the_diff(spark):
    schema = "id long, a string, b string, c double"
    r = random.Random(4)
    old = [(k, r.choice(["x", None]), r.choice(["x", None]), r.choice([0.0, 1.5, None])) for k in range(300)]
    new = [row for row in old if row[0] % 50]
    new = [(k, b, a, c) if k % 40 == 1 else (k, a, b, c) for k, a, b, c in new] + [(1000, "n", None, 1.0)]
    before, after = frame(spark, schema, old), frame(spark, schema, new)
    wanted = incremental.table_diff(before, after, "id")
    assert wanted.count() > 6
    for buckets in (1, 7, 4096):
        assert same(wanted, incremental.checksum_diff(before, after, "id", buckets))
    assert incremental.checksum_diff(before, before, "id").collect() == []
    assert incremental.checksum_diff(before.limit(0), after.limit(0), "id").collect() == []


def test_only_differing_buckets_are_joined(spark, tmp_path):
    rows = spark.range(20_000).select("id", (F.col("id") * 2).alias("v"))
    rows.write.parquet(f"{tmp_path}/old")
    rows.withColumn("v", F.when(F.col("id") == 77, -1).otherwise(F.col("v"))).write.parquet(f"{tmp_path}/new")
    old, new = (spark.read.parquet(f"{tmp_path}/{name}") for name in ("old", "new"))
    found = incremental.checksum_diff(old, new, "id", 512)
    assert [tuple(row) for row in found.collect()] == [(77, -1, "update")]
    plan = found._jdf.queryExecution().executedPlan().toString()
    # the rows meet the list of buckets before they are moved
    assert plan.count("LeftSemi") >= 2 and "BroadcastHashJoin" in plan


def test_tables_in_buckets_join_without_an_exchange(spark, tmp_path):
    keys = spark.range(2000).select((F.col("id") % 97).alias("k"), "id")
    one = lake.save_bucketed(keys, "bucket_test.one", ["k"], 4, f"{tmp_path}/one")
    two = lake.save_bucketed(keys.select("k").distinct(), "bucket_test.two", ["k"], 4, f"{tmp_path}/two")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = one.join(two, "k").groupBy("k").count()
        assert joined.count() == 97
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.sql("drop schema bucket_test cascade")


def test_silver_as_tables_of_a_schema(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    for name in lakehouse.SILVER_MODELS:
        keys = lakehouse.SILVER_KEYS[name]
        published.replace_table(spark.range(10).select(*[F.col("id").alias(k) for k in keys]), lake.table_path(root, "silver", name))
    real = lake.save_bucketed
    monkeypatch.setattr(lake, "save_bucketed", lambda df, table, keys, n: real(df, table, keys, n, f"{tmp_path}/{table}"))
    try:
        saved = lakehouse.save_silver(spark, root, "silver_test", 2)
        assert {name: df.count() for name, df in saved.items()} == dict.fromkeys(lakehouse.SILVER_MODELS, 10)
        assert by(spark.sql("show tables in silver_test"), "tableName").keys() == set(lakehouse.SILVER_MODELS)
    finally:
        spark.sql("drop schema silver_test cascade")


def test_days_follow_the_snapshots_of_a_month(spark):
    snapshots = frame(
        spark, "snapshot_date date, hub_id string, component_id string, on_hand_qty long, on_order_qty long, avg_age_days long",
        [(day(d), "H", "C1", q, 0, 1) for d, q in (("2025-01-10", 5), ("2025-01-31", 6), ("2025-02-28", 7))],
    )
    used = frame(spark, "month date, hub_id string, component_id string, qty_consumed long", [(day("2025-01-01"), "H", "C1", 30)])
    found = by(gold.days_of_supply(snapshots, used, components(spark), months=2), "snapshot_date")
    assert [found[day(d)]["avg_monthly_consumption_3m"] for d in ("2025-01-10", "2025-01-31", "2025-02-28")] == [30.0, 30.0, 15.0]


def test_facts_are_refreshed_from_new_rows(spark, tmp_path):
    root = small_lake(spark, str(tmp_path))
    raw = lakehouse.bronze_tables(spark, root)
    large = {
        "fct_supplier_otif": ("purchase_orders", "po_line_id"),
        "fct_purchase_price_variance": ("purchase_orders", "po_line_id"),
        "fct_capacity_plan_vs_actual": ("rack_deployments", "rack_id"),
        "fct_capex_by_region": ("rack_deployments", "rack_id"),
        "fct_budget_vs_actual": ("gl_journal", "journal_id"),
    }
    assert set(large) == set(rollups.KEPT)
    for name, (table, key) in large.items():
        first = raw[table].agg(F.min(key)).first()[0]
        early, late = raw[table].filter(F.col(key) == first), raw[table].filter(F.col(key) != first)
        for batch, rows in (("early", early), ("late", late), ("late", late)):
            rollups.refresh(spark, root, name, rows, batch)
        rollups.refresh(spark, root, name, early, "corrected", early)
        whole = lakehouse.GOLD_MODELS[name].over(raw)
        assert same(whole, lakehouse.table(spark, root, name)), name
