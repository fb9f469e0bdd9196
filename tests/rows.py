"""Small frames and readable results for the tests."""

from datetime import date


def day(text):
    return None if text is None else date.fromisoformat(text)


def frame(spark, schema, rows):
    return spark.createDataFrame(rows, schema)


def by(df, *keys):
    """Rows as dicts under their key."""
    found = {}
    for row in df.collect():
        key = tuple(row[k] for k in keys)
        found[key if len(keys) > 1 else key[0]] = row.asDict()
    return found


PO = (
    "po_line_id string, po_number string, supplier_id string, component_id string, "
    "hub_id string, order_date date, promised_date date, received_date date, "
    "qty_ordered long, qty_received long, unit_cost_usd double, status string"
)
SUPPLIER = (
    "supplier_id string, supplier_name string, category string, "
    "payment_terms_days long, strategic_flag boolean"
)
COMPONENT = "component_id string, component_name string, category string, standard_cost_usd double"


def po(line, number="PO-1", supplier="S1", component="C1", promised="2025-03-10", received=None,
       ordered=10, got=0, cost=5.0, placed="2025-02-01", hub="H1"):
    return (
        line, number, supplier, component, hub, day(placed), day(promised), day(received),
        ordered, got, cost, "Closed" if received else "Open",
    )


def suppliers(spark):
    return frame(spark, SUPPLIER, [
        ("S1", "One", "Memory", 30, True),
        ("S2", "Two", "Power", 45, False),
        ("S3", "Three", "Power", 60, False),
    ])


def components(spark):
    return frame(spark, COMPONENT, [
        ("C1", "Chip", "CPU", 4.0),
        ("C2", "Disk", "Storage", 0.0),
    ])
