"""Invoices, postings, depreciation, accruals and budgets."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stockledger import fixed_values as fixed
from stockledger.functions import (
    exact_sum,
    month_of,
    ramp,
    round_half_away,
    seasonal,
    to_cents,
)
from stockledger.operators.supply import MONTHLY, _date, sequence_id


@dataclass(frozen=True)
class Posting:
    """One journal line made from a business row.

    Every field is a column over that row; amounts are positive for a debit
    and negative for a credit.
    """

    account: Column
    cost_center: Column
    amount: Column
    memo: Column


def post_lines(
    df: DataFrame, date: str, reference: str, source: str, postings: Sequence[Posting]
) -> DataFrame:
    """Journal lines of business rows, one per posting, in one pass over them.

    ``line`` numbers the postings of a row, so (reference, date, line) orders
    the journal. Amounts are rounded to cents.
    """
    lines = F.array(
        *[
            F.struct(
                F.lit(number).alias("line"),
                posting.account.alias("account_id"),
                posting.cost_center.alias("cost_center_id"),
                round_half_away(posting.amount, 2).alias("amount_usd"),
                posting.memo.alias("memo"),
            )
            for number, posting in enumerate(postings, start=1)
        ]
    )
    return df.select(
        F.col(date).alias("posting_date"),
        F.col(reference).alias("reference"),
        F.lit(source).alias("source"),
        F.inline(lines),
    )


def post_receipts(
    lines: DataFrame,
    components: DataFrame,
    inventory: tuple[str, str] = fixed.INVENTORY,
    variance: tuple[str, str] = fixed.PRICE_VARIANCE,
    payable: tuple[str, str] = fixed.PAYABLE,
) -> DataFrame:
    """Receipts to inventory at standard, the price variance, and the payable."""
    received = lines.filter((F.col("status") == "Closed") & (F.col("qty_received") != 0)).join(
        components.select("component_id", "standard_cost_usd"), "component_id"
    )
    standard = F.col("qty_received") * F.col("standard_cost_usd")
    paid = F.col("qty_received") * F.col("unit_cost_usd")
    receipt = F.format_string(fixed.RECEIPT_MEMO, F.col("component_id").cast("string"))
    return post_lines(
        received,
        "received_date",
        "po_line_id",
        fixed.PO_RECEIPT,
        [
            Posting(*map(F.lit, inventory), standard, receipt),
            Posting(*map(F.lit, variance), paid - standard, F.lit(fixed.VARIANCE_MEMO)),
            Posting(*map(F.lit, payable), -paid, F.lit(fixed.PAYABLE_MEMO)),
        ],
    )


def post_capitalization(
    racks: DataFrame,
    centers: DataFrame,
    asset: str = fixed.FIXED_ASSETS,
    inventory: tuple[str, str] = fixed.INVENTORY,
) -> DataFrame:
    """Installed racks to fixed assets, against inventory.

    ``centers`` maps region_code to the cost_center_id that holds the asset.
    """
    installed = racks.filter(F.col("installed_date").isNotNull()).join(
        centers.select("region_code", "cost_center_id"), "region_code"
    )
    cost, center = F.col("capex_usd"), F.col("cost_center_id")
    placed = F.format_string(fixed.ASSET_MEMO, F.col("sku_id").cast("string"))
    return post_lines(
        installed,
        "installed_date",
        "rack_id",
        fixed.CAPITALIZATION,
        [
            Posting(F.lit(asset), center, cost, placed),
            Posting(*map(F.lit, inventory), -cost, F.lit(fixed.RELIEF_MEMO)),
        ],
    )


def depreciation_schedule(
    assets: DataFrame,
    window_end: Column | str,
    cap_at_life: bool = False,
    asset: str = "rack_id",
    installed: str = "installed_date",
    cost: str = "capex_usd",
    life: str = "useful_life_months",
) -> DataFrame:
    """One row per asset and month from the month after installation.

    Runs to the end of the window, or to the end of the asset's life when that
    comes first and ``cap_at_life`` holds. Each asset expands by itself.
    """
    first = F.add_months(month_of(installed), 1)
    last = month_of(_date(window_end))
    if cap_at_life:
        last = F.least(last, F.add_months(month_of(installed), F.col(life).cast("int")))
    due = F.sequence(first, last, F.expr(MONTHLY))
    running = assets.filter(F.col(installed).isNotNull() & (first <= last))
    return (
        running.withColumn("month", F.explode(due))
        .withColumn("posting_date", F.last_day("month"))
        .withColumn("depreciation_usd", F.col(cost) / F.nullifzero(F.col(life)))
        .drop("month")
    )


def depreciation_totals(
    assets: DataFrame,
    by: Sequence[str],
    window_end: Column | str,
    cap_at_life: bool = False,
    installed: str = "installed_date",
    cost: str = "capex_usd",
    life: str = "useful_life_months",
) -> DataFrame:
    """Depreciation per month and group, without a row per asset and month.

    An asset adds its monthly amount when it starts and takes it back after
    its last month, as ``open_balance`` does; groups are summed before their
    months are filled in.
    """
    start = F.add_months(month_of(installed), 1)
    window_last = month_of(_date(window_end))
    monthly = F.col(cost) / F.nullifzero(F.col(life))
    entries = [F.struct(start.alias("month"), monthly.alias("change"), F.lit(1).alias("assets"))]
    if cap_at_life:
        stop = F.add_months(month_of(installed), F.col(life).cast("int") + 1)
        entries.append(
            F.struct(stop.alias("month"), (-monthly).alias("change"), F.lit(-1).alias("assets"))
        )
    changes = (
        assets.filter(F.col(installed).isNotNull())
        .select(*by, F.inline(F.array(*entries)))
        .filter(F.col("month") <= window_last)
        .groupBy(*by, "month")
        .agg(exact_sum("change").alias("change"), F.sum("assets").alias("assets"))
    )
    ordered = W.partitionBy(*by).orderBy("month")
    so_far = ordered.rowsBetween(W.unboundedPreceding, W.currentRow)
    until = F.coalesce(F.add_months(F.lead("month").over(ordered), -1), window_last)
    return (
        changes.select(
            *by,
            "month",
            until.alias("until"),
            to_cents(F.sum("change").over(so_far)).alias("depreciation_usd"),
            F.sum("assets").over(so_far).alias("assets"),
        )
        .filter(F.col("assets") > 0)
        .withColumn("month", F.explode(F.sequence("month", "until", F.expr(MONTHLY))))
        .select(*by, F.last_day("month").alias("posting_date"), "assets", "depreciation_usd")
    )


def post_depreciation(
    schedule: DataFrame,
    centers: DataFrame,
    expense: str = fixed.DEPRECIATION,
    contra: str = fixed.ACCUMULATED_DEPRECIATION,
) -> DataFrame:
    """Depreciation rows to expense, against accumulated depreciation."""
    placed = schedule.join(centers.select("region_code", "cost_center_id"), "region_code")
    amount = F.col("depreciation_usd")
    center, memo = F.col("cost_center_id"), F.lit(fixed.DEPRECIATION_MEMO)
    return post_lines(
        placed,
        "posting_date",
        "rack_id",
        fixed.DEPRECIATION_RUN,
        [
            Posting(F.lit(expense), center, amount, memo),
            Posting(F.lit(contra), center, -amount, memo),
        ],
    )


def post_writedowns(
    writedowns: DataFrame,
    expense: tuple[str, str] = fixed.WRITE_DOWN,
    inventory: tuple[str, str] = fixed.INVENTORY,
) -> DataFrame:
    """Quarter-end write-downs (month, amount_usd) to expense, against inventory."""
    period = F.date_format("month", "yyyy-MM")
    quarter_end = writedowns.filter(F.month("month").isin(*fixed.QUARTER_ENDS)).withColumns(
        {
            "posting_date": F.last_day("month"),
            "reference": F.format_string(fixed.WRITE_DOWN_REFERENCE, period),
        }
    )
    amount, memo = F.col("amount_usd"), F.lit(fixed.WRITE_DOWN_MEMO)
    return post_lines(
        quarter_end,
        "posting_date",
        "reference",
        fixed.ADJUSTMENT,
        [
            Posting(*map(F.lit, expense), amount, memo),
            Posting(*map(F.lit, inventory), -amount, memo),
        ],
    )


def recurring_accruals(
    spine: DataFrame,
    rates: Sequence[tuple[str, float, str, str]],
    steps: int = 1,
    growth: tuple[float, float] = (1.0, 1.0),
    seasons: Mapping[str, tuple[float, float]] | None = None,
    weight: str | None = None,
) -> DataFrame:
    """Month-end run-rate postings per cost centre and account.

    ``spine`` comes from ``month_spine`` over cost centres; ``rates`` lists
    (account, base, source, memo). A base is scaled by the centre's weight and
    by growth and, for accounts in ``seasons`` (swing, phase), by the time of
    year. The accounts come out of a literal array, so there is no join.
    """
    entries = F.array(
        *[
            F.struct(
                F.lit(account).alias("account_id"),
                F.lit(float(base)).alias("base"),
                F.lit(source).alias("source"),
                F.lit(memo).alias("memo"),
            )
            for account, base, source, memo in rates
        ]
    )
    season = F.lit(1.0)
    for account, (swing, phase) in (seasons or {}).items():
        season = F.when(
            F.col("account_id") == account, seasonal("month", swing, phase)
        ).otherwise(season)
    size = F.lit(1.0) if weight is None else F.col(weight)
    amount = F.col("base") * size * ramp("month_index", steps, *growth) * season
    return spine.select("*", F.inline(entries)).select(
        F.last_day("month").alias("posting_date"),
        "account_id",
        "cost_center_id",
        round_half_away(amount, 2).alias("amount_usd"),
        "source",
        F.concat_ws(
            "-", F.col("cost_center_id").cast("string"), F.date_format("month", "yyyy-MM")
        ).alias("reference"),
        "memo",
    )


def opex_by_month(journal: DataFrame, prefix: str = fixed.SPENDING_PREFIX) -> DataFrame:
    """Booked amounts per month, cost centre and account of one account class."""
    return (
        journal.filter(F.col("account_id").startswith(prefix))
        .groupBy(month_of("posting_date").alias("fiscal_month"), "cost_center_id", "account_id")
        .agg(to_cents(exact_sum("amount_usd")).alias("amount_usd"))
    )


def derive_budget(
    actuals: DataFrame,
    factors: Mapping[str, float] = fixed.BUDGET_FACTORS,
    default: float = fixed.DEFAULT_BUDGET_FACTOR,
) -> DataFrame:
    """Budget lines from monthly actuals, scaled by an account's factor."""
    factor = F.lit(float(default))
    for account, value in factors.items():
        factor = F.when(F.col("account_id") == account, F.lit(float(value))).otherwise(factor)
    return actuals.select(
        F.date_format("fiscal_month", "yyyy-MM-dd").alias("fiscal_month"),
        "cost_center_id",
        "account_id",
        round_half_away(F.col("amount_usd") * factor, 2).alias("budget_usd"),
    )


def invoice_rollup(
    lines: DataFrame,
    suppliers: DataFrame,
    line_order: Sequence[str] = ("po_line_id",),
    lag_days: int = 0,
    id_format: str | None = None,
) -> DataFrame:
    """One invoice per purchase order from its closed lines.

    Dated ``lag_days`` after the last receipt, billed by the supplier of the
    first line, due after that supplier's terms; orders worth nothing are not
    invoiced. The lines of an order may come from several suppliers.
    With ``id_format`` an invoice gets an ``invoice_id`` from the end of its
    supplier's id and the number, from 0, of its order among all with closed
    lines; orders that are not invoiced leave gaps.
    """
    first_line = F.min(F.struct(*line_order, F.col("supplier_id").alias("_supplier")))
    billed = (
        lines.filter(F.col("status") == "Closed")
        .groupBy("po_number")
        .agg(
            first_line.getField("_supplier").alias("supplier_id"),
            F.date_add(F.max("received_date"), lag_days).alias("invoice_date"),
            to_cents(exact_sum(F.col("qty_received") * F.col("unit_cost_usd"))).alias(
                "amount_usd"
            ),
        )
    )
    named = []
    if id_format is not None:
        billed = sequence_id(billed, ["po_number"], "%d", "_number", first=0)
        supplier = F.substring(F.col("supplier_id").cast("string"), -3, 3)
        number = F.col("_number").cast("long")
        named = [F.format_string(id_format, supplier, number).alias("invoice_id")]
    billed = billed.filter(F.col("amount_usd") > 0)
    terms = suppliers.select("supplier_id", "payment_terms_days")
    return billed.join(terms, "supplier_id").select(
        *named,
        "po_number",
        "supplier_id",
        "invoice_date",
        F.date_add("invoice_date", F.col("payment_terms_days").cast("int")).alias("due_date"),
        "amount_usd",
        F.lit("USD").alias("currency"),
    )


def assemble_journal(
    postings: Sequence[DataFrame], order: Sequence[str] = ("posting_date", "source", "reference", "line")
) -> DataFrame:
    """All postings as one journal with consecutive ids.

    ``postings`` come from the ``post_*`` functions and ``recurring_accruals``;
    one without line numbers has one line for each reference, date and account.
    """
    columns = ["posting_date", "account_id", "cost_center_id", "amount_usd", "source", "reference", "memo"]
    lines = [
        (part if "line" in part.columns else part.withColumn("line", F.lit(1))).select(
            *[F.col(name).cast("string").alias(name) if name == "reference" else name for name in columns], "line"
        )
        for part in postings
    ]
    journal = reduce(DataFrame.unionByName, lines)
    ids = sequence_id(journal, [*order, "account_id", "cost_center_id"], fixed.JOURNAL_ID, "journal_id")
    return ids.select("journal_id", *columns)


def tie_out(
    source: DataFrame, journal: DataFrame, reference: str, amount: str, account: str
) -> DataFrame:
    """Business amounts against what one account holds for the same reference.

    Both sides are summed per reference first. ``difference_usd`` is zero where
    the numbers tie out; a reference found on one side only shows in full.
    """
    expected = source.groupBy(F.col(reference).alias("reference")).agg(
        exact_sum(amount).alias("expected")
    )
    posted = (
        journal.filter(F.col("account_id") == account)
        .groupBy("reference")
        .agg(exact_sum("amount_usd").alias("posted"))
    )
    left = F.coalesce(F.col("expected"), F.lit(0))
    right = F.coalesce(F.col("posted"), F.lit(0))
    return expected.join(posted, "reference", "full").select(
        "reference",
        to_cents(left).alias("expected_usd"),
        to_cents(right).alias("posted_usd"),
        to_cents(left - right).alias("difference_usd"),
    )
