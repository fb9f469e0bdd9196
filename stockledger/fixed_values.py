"""Names and numbers that users' data and results depend on."""

# The raw tables, the cleaned tables and the facts.
BRONZE = [
    "regions",
    "hubs",
    "suppliers",
    "components",
    "server_skus",
    "bom",
    "purchase_orders",
    "inventory_snapshots",
    "capacity_forecast",
    "rack_deployments",
    "supplier_invoices",
    "cost_centers",
    "gl_accounts",
    "gl_journal",
    "budget",
]
SILVER = ["stg_purchase_orders", "stg_gl_journal", "stg_rack_deployments"]
GOLD = [
    "fct_supplier_otif",
    "fct_purchase_price_variance",
    "fct_capacity_plan_vs_actual",
    "fct_inventory_days_of_supply",
    "fct_capex_by_region",
    "fct_budget_vs_actual",
    "fct_ap_aging",
]

# The date column that places a fact's rows in time.
GOLD_DATES = {
    "fct_supplier_otif": "promised_month",
    "fct_purchase_price_variance": "received_month",
    "fct_capacity_plan_vs_actual": "forecast_month",
    "fct_inventory_days_of_supply": "snapshot_date",
    "fct_capex_by_region": "in_service_month",
    "fct_budget_vs_actual": "fiscal_month",
}

# Forecast versions with the prefixes of their value and error columns.
FORECAST_VERSIONS = (("P6M", "plan_6m", "plan"), ("P1M", "commit_1m", "commit"))

# Days past due that end a bucket, months and days of the stock fact.
AGING_BOUNDS = (30, 60, 90)
TRAILING_MONTHS = 3
AGED_AFTER_DAYS = 180

# Parts every rack has, and those only racks of a family have.
RACK_INFRA = {"CMP-RCK-01": 1, "CMP-SW-01": 2, "CMP-PDU-01": 2, "CMP-OPT-01": 64}
FAMILY_INFRA = {"GPU Accelerated": {"CMP-CDU-01": 1}}

# Months of useful life.
USEFUL_LIFE = {"GPU Accelerated": 48}
DEFAULT_LIFE = 72

# Price curves as (trend per month, swing, period, phase).
PRICE_PATHS = {"GPU": (0.012, 0.03, 3, 0), "Memory": (-0.015, 0.08, 4, 1)}
PRICE_BOUNDS = (0.6, 1.6)

# Demand by family, growth over the window, and the ramp of one family.
FAMILY_MIX = {
    "General Compute": 0.42,
    "High-Memory": 0.12,
    "GPU Accelerated": 0.31,
    "Storage Dense": 0.15,
}
BASE_RACKS = 140
GROWTH = (1.0, 1.55)
FAMILY_RAMPS = {"GPU Accelerated": (0.7, 1.6)}

# Accounts, with the cost centre where it is always the same.
INVENTORY = ("1400", "CC-1100")
PRICE_VARIANCE = ("5600", "CC-1300")
PAYABLE = ("2100", "CC-1100")
WRITE_DOWN = ("5700", "CC-1100")
FIXED_ASSETS = "1500"
DEPRECIATION = "5100"
ACCUMULATED_DEPRECIATION = "1590"
SPENDING_PREFIX = "5"
SPENDING_TYPE = "Opex"

# Sources and memos of journal lines.
PO_RECEIPT = "PO Receipt"
CAPITALIZATION = "Capitalization"
DEPRECIATION_RUN = "Depreciation"
ACCRUAL = "Accrual"
PAYROLL = "Payroll"
ADJUSTMENT = "Adjustment"
RECEIPT_MEMO = "Receipt %s"
VARIANCE_MEMO = "PPV vs standard"
PAYABLE_MEMO = "AP accrual"
ASSET_MEMO = "Rack in service %s"
RELIEF_MEMO = "Inventory relief"
DEPRECIATION_MEMO = "Straight-line"
WRITE_DOWN_MEMO = "Excess & obsolete reserve"
WRITE_DOWN_REFERENCE = "EO-%s"

# Monthly run rate of a region's cost centre, as (account, base,
# source, memo); the second table is that of every global cost centre.
REGION_RUN_RATE = [
    ("5200", 7_500_000, ACCRUAL, "5200 monthly accrual"),
    ("5300", 3_800_000, ACCRUAL, "5300 monthly accrual"),
    ("5400", 1_600_000, ACCRUAL, "5400 monthly accrual"),
    ("5500", 900_000, ACCRUAL, "5500 monthly accrual"),
    ("5800", 180_000, ACCRUAL, "5800 monthly accrual"),
]
GLOBAL_RUN_RATE = [
    ("5400", 420_000, PAYROLL, "Salaries & benefits"),
    ("5800", 35_000, ACCRUAL, "Consulting / services"),
]

# Accounts that follow the season, as (swing, phase).
SEASONS = {"5200": (0.12, -1.2)}

# Months that close a quarter.
QUARTER_ENDS = (3, 6, 9, 12)

# Budget as a share of actuals.
BUDGET_FACTORS = {"5100": 0.94, "5200": 0.94}
DEFAULT_BUDGET_FACTOR = 1.02

# A region served by another region's hub.
HUB_OVERRIDES = {"apj-2": "HUB-SIN"}

# Formats of generated ids.
RACK_ID = "RCK-%06d"
PO_LINE_ID = "POL-%07d"
JOURNAL_ID = "JE-%08d"
INVOICE_ID = "INV-%s-%06d"
