from stockledger.operators import quality
from tests.rows import by, frame


def table(spark):
    return frame(
        spark, "id string, part string, qty double",
        [("a", "x", 0.0), ("a", "x", 100.0), ("b", "x", -1.0), (None, "y", 101.0),
         (None, "y", None)],
    )


def test_not_null(spark):
    assert quality.check_not_null(table(spark), "id").count() == 2
    assert quality.check_not_null(table(spark), "part").count() == 0


def test_unique_ignores_nulls(spark):
    assert [(r.id, r.n) for r in quality.check_unique(table(spark), "id").collect()] == [("a", 2)]


def test_range_is_inclusive_and_half_open_bounds_work(spark):
    t = table(spark)
    assert quality.check_range(t, "qty", 0, 100).count() == 2
    assert quality.check_range(t, "qty", min_value=0).count() == 1
    assert quality.check_range(t, "qty", max_value=100).count() == 1
    assert quality.check_range(t, "qty").count() == 0


def test_unique_combination_counts_nulls_as_values(spark):
    rows = quality.check_unique_combination(table(spark), ["id", "part"]).collect()
    assert {(r.id, r.part, r.n) for r in rows} == {("a", "x", 2), (None, "y", 2)}


def test_report(spark):
    spec = {
        "t": quality.Checks(
            not_null=["id", "part"], unique=["id"], ranges={"qty": (0, 100)},
            unique_combinations=[["id", "part"], ["id", "part", "qty"]],
        )
    }
    rows = by(quality.run_checks({"t": table(spark)}, spec), "check_name")
    assert {k: v["failures"] for k, v in rows.items()} == {
        "not_null(id)": 2, "not_null(part)": 0, "unique(id)": 1, "range(qty)": 2,
        "unique(id, part)": 2, "unique(id, part, qty)": 0,
    }
