"""Sales report over an uploaded table whose columns are found by name.

Every section is a function of its own, and :func:`csv_report` gives all of them in the long format
of :mod:`tallyhouse.plans.reports`. Reading and parsing the text dominates the cost of a large file,
so the report makes two passes: one with a grouping set per distribution and one for the top
products, where a function per section would make nine.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyhouse.functions.scalars import money_text, number, percent_text, quoted, ratio
from tallyhouse.operators.ranking import ranked
from tallyhouse.plans.reports import FIGURES, HEADING, REMARK, figures, joined, remarks
from tallyhouse.sources.uploads import DAMAGED, find_roles, is_damaged

# Assumed cost of a unit, and number of products in the ranking.
UNIT_COST = 50
TOP_PRODUCTS = 5

# Titles of the report and of its sections, in order.
TITLE = "Sales Analysis Report"
SECTIONS = (
    "Sales Overview",
    "Time-based Analysis",
    "Product Performance",
    "Order Fulfillment",
    "Courier and Order Status",
    "Customer Insights",
    "Quantity Analysis",
    "Financial Metrics",
    "Currency Analysis",
    "General Summary",
    "KPIs Summary",
)
_NUMBER = {title: place for place, title in enumerate(SECTIONS, start=1)}

# Columns each section cannot do without.
_NEEDS = {
    "Sales Overview": ("amount",),
    "Time-based Analysis": ("date", "amount"),
    "Product Performance": ("quantity", "product", "amount"),
    "Order Fulfillment": ("fulfillment",),
    "Courier and Order Status": ("courier_status", "order_status"),
    "Quantity Analysis": ("quantity",),
    "Financial Metrics": ("amount", "quantity"),
    "Currency Analysis": ("currency", "amount"),
}


class MissingColumn(ValueError):
    """The table has no column for a role that a section needs."""


def with_roles(df: DataFrame, *needed: str) -> DataFrame:
    """The columns that have a role, under the names of the roles; amounts ready to be summed.

    Dates become text, since an inferred date and a date kept as text must group alike.
    """
    found = find_roles(df.columns)
    missing = [role for role in needed if role not in found]
    if missing:
        raise MissingColumn(f"no column for {', '.join(missing)} among {df.columns}")
    wanted = needed or tuple(found)
    return df.select(*[_role(df, role, found[role]).alias(role) for role in wanted])


# Roles whose columns are read as numbers.
_NUMBERS = ("amount", "quantity")


def _role(df: DataFrame, role: str, column: str) -> Column:
    if role in _NUMBERS:
        return number(df, column)
    return quoted(column).cast("string")


def csv_sales_overview(df: DataFrame) -> DataFrame:
    """Total sales, and their average over all rows, those without an amount included."""
    total = F.sum("amount").cast("double")
    return with_roles(df, "amount").agg(
        total.alias("total_sales"),
        ratio(total, F.count(F.lit(1))).alias("average_order_value"),
    )


def csv_daily_sales(df: DataFrame) -> DataFrame:
    """Sales per date as written in the table."""
    return _sum_by(df, "date", "amount", "total_sales")


def csv_currency(df: DataFrame) -> DataFrame:
    """Sales per currency."""
    return _sum_by(df, "currency", "amount", "total_sales")


def _sum_by(df: DataFrame, key: str, measure: str, name: str) -> DataFrame:
    rows = with_roles(df, key, measure)
    return rows.groupBy(key).agg(F.sum(measure).cast("double").alias(name))


def csv_top_skus(df: DataFrame, limit: int = TOP_PRODUCTS) -> DataFrame:
    """The products with the largest quantity, and their sales."""
    per_product = (
        with_roles(df, "product", "quantity", "amount")
        .groupBy(F.col("product").alias("sku"))
        .agg(
            F.sum("quantity").cast("double").alias("total_quantity"),
            F.sum("amount").cast("double").alias("total_sales"),
        )
    )
    return ranked(per_product, "total_quantity", "sku", limit=limit)


def _count_by(df: DataFrame, key: str) -> DataFrame:
    return with_roles(df, key).groupBy(key).agg(F.count(F.lit(1)).alias("count"))


def csv_fulfillment(df: DataFrame) -> DataFrame:
    """Rows per fulfiller; a missing one is a group too."""
    return _count_by(df, "fulfillment")


def csv_courier_status(df: DataFrame) -> DataFrame:
    """Rows per courier status, given that the table has an order status too."""
    with_roles(df, *_NEEDS["Courier and Order Status"])
    return _count_by(df, "courier_status")


def csv_order_status(df: DataFrame) -> DataFrame:
    """Rows per order status, given that the table has a courier status too."""
    with_roles(df, *_NEEDS["Courier and Order Status"])
    return _count_by(df, "order_status")


def csv_quantity(df: DataFrame) -> DataFrame:
    """Total quantity, and its average over all rows."""
    total = F.sum("quantity").cast("double")
    return with_roles(df, "quantity").agg(
        total.alias("total_quantity"),
        ratio(total, F.count(F.lit(1))).alias("average_quantity"),
    )


def csv_financials(df: DataFrame, unit_cost: float = UNIT_COST) -> DataFrame:
    """Gross revenue, cost at a fixed price per unit, and margin in percent of the revenue."""
    gross, cost, margin = _financials(F.sum("amount"), F.sum("quantity"), unit_cost)
    return with_roles(df, "amount", "quantity").agg(
        gross.alias("gross_revenue"),
        cost.alias("estimated_cost"),
        (margin * 100).alias("profit_margin_percent"),
    )


def _financials(
    amount: Column, quantity: Column, unit_cost: float
) -> tuple[Column, Column, Column]:
    gross, cost = amount.cast("double"), quantity.cast("double") * unit_cost
    return gross, cost, ratio(gross - cost, gross)


def _skipped(found: Iterable[str]) -> dict[str, str]:
    """The sections that must be left out, with the reason."""
    found = set(found)
    reasons = {}
    for title, needed in _NEEDS.items():
        missing = [role.replace("_", " ") for role in needed if role not in found]
        if missing:
            names = " and ".join(missing).capitalize()
            reasons[title] = f"{names} column not found, skipping {title} calculation"
    return reasons


def _grouped(df: DataFrame, distributions: list[str]) -> DataFrame:
    """Sums and row count per value of each distribution and over everything, in one pass.

    ``role`` names the distribution of a row, null for the total. A marker row that counts as no
    row makes sure that a table without rows has a total.
    """
    found = find_roles(df.columns)
    roles = [role for role in found if role in distributions or role in _NUMBERS]
    unread = {
        f"{role}_unread": quoted(found[role]).isNotNull() & number(df, found[role]).isNull()
        for role in _NUMBERS
        if role in found
    }
    rows = df.select(
        *[_role(df, role, found[role]).alias(role) for role in roles],
        *[flag.cast("int").alias(name) for name, flag in unread.items()],
        is_damaged(df).cast("int").alias("damaged"),
    )
    for role in _NUMBERS:
        if role not in found:
            rows = rows.withColumn(role, F.lit(None).cast("double"))
            rows = rows.withColumn(f"{role}_unread", F.lit(0))
    counted = [*[f"{r}_unread" for r in _NUMBERS], "damaged"]
    rows = rows.select(*distributions, *_NUMBERS, *counted, F.lit(1).alias("n"))
    empty = df.sparkSession.range(1).select(
        *[F.lit(None).cast(rows.schema[name].dataType).alias(name) for name in rows.columns[:-1]],
        F.lit(0).alias("n"),
    )
    measures = (
        F.sum("amount").cast("double").alias("amount"),
        F.sum("quantity").cast("double").alias("quantity"),
        F.sum("n").alias("rows"),
        *[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in counted],
    )
    both = rows.unionByName(empty)
    if not distributions:
        return both.agg(*measures).select(
            F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("key"), "*"
        )
    sets = both.groupingSets([[role] for role in distributions] + [[]], *distributions)
    # grouping() is 0 on the one column that a row is grouped by.
    marks = [F.grouping(role).alias(f"{role}_mark") for role in distributions]
    grouped = sets.agg(*measures, *marks)
    role = F.coalesce(
        *[F.when(F.col(f"{role}_mark") == 0, F.lit(role)) for role in distributions]
    )
    return grouped.select(
        role.alias("role"),
        F.coalesce(*distributions).alias("key"),
        "amount",
        "quantity",
        "rows",
        *counted,
    ).where("role IS NULL OR rows > 0")


def _entry(section: str, seq: int, metric: str, value: Column, text: Column) -> Column:
    return F.struct(
        F.lit(_NUMBER[section]).alias("section"),
        F.lit(seq).alias("seq"),
        F.lit(metric).alias("metric"),
        value.cast("double").alias("value"),
        text.cast("string").alias("text"),
    )


# The wording of the lines in this and the next function.
def _total_entries(skipped: Iterable[str], unit_cost: float, damaged: bool) -> list[Column]:
    amount, quantity, rows = F.col("amount"), F.col("quantity"), F.col("rows")
    gross, cost, margin = _financials(amount, quantity, unit_cost)
    average, per_row = ratio(amount, rows), ratio(quantity, rows)
    entries = {
        "Sales Overview": [
            ("total_sales", amount, F.concat(F.lit("Total Sales: "), money_text(amount))),
            (
                "average_order_value",
                average,
                F.concat(F.lit("Average Order Value: "), money_text(average)),
            ),
            (
                "unreadable_amounts",
                F.col("amount_unread"),
                F.concat(F.lit("Amounts that are no number: "), F.col("amount_unread").cast("string")),
            ),
        ],
        "Quantity Analysis": [
            (
                "total_quantity",
                quantity,
                F.concat(F.lit("Total Quantity Sold: "), quantity.cast("string")),
            ),
            (
                "average_quantity",
                per_row,
                F.concat(F.lit("Average Quantity Per Order: "), per_row.cast("string")),
            ),
            (
                "unreadable_quantities",
                F.col("quantity_unread"),
                F.concat(F.lit("Quantities that are no number: "), F.col("quantity_unread").cast("string")),
            ),
        ],
        "Financial Metrics": [
            ("gross_revenue", gross, F.concat(F.lit("Gross Revenue: "), money_text(gross))),
            ("estimated_cost", cost, F.concat(F.lit("Estimated Cost: "), money_text(cost))),
            (
                "profit_margin_percent",
                margin * 100,
                F.concat(F.lit("Profit Margin: "), percent_text(margin)),
            ),
        ],
    }
    if damaged:
        text = F.concat(F.lit("Rows that do not fit the header: "), F.col("damaged").cast("string"))
        # Behind the line that lists the sections
        entries["General Summary"] = [None, ("damaged_rows", F.col("damaged"), text)]
    return [
        _entry(
            section,
            FIGURES + place,
            metric,
            value,
            F.coalesce(text, F.lit(f"No values, skipping {section} calculation")),
        )
        for section, lines in entries.items()
        if section not in skipped
        for place, line in enumerate(lines)
        if line is not None
        for metric, value, text in [line]
    ]


def _distribution_entries() -> dict[str, tuple[str, Column]]:
    """Section and entry of a row of each distribution."""
    key = F.coalesce(F.col("key"), F.lit("None"))

    def sales(section: str) -> Column:
        amount = F.col("amount")
        text = F.concat(key, F.lit(": "), F.coalesce(money_text(amount), F.lit("None")))
        return _entry(section, FIGURES, "total_sales", amount, text)

    def count(section: str, metric: str, seq: int = FIGURES) -> Column:
        text = F.concat(key, F.lit(": "), F.col("rows").cast("string"))
        return _entry(section, seq, metric, F.col("rows"), text)

    status = "Courier and Order Status"
    return {
        "date": ("Time-based Analysis", sales("Time-based Analysis")),
        "fulfillment": ("Order Fulfillment", count("Order Fulfillment", "fulfillment_rows")),
        "courier_status": (status, count(status, "courier_status_rows")),
        "order_status": (status, count(status, "order_status_rows", FIGURES + 1)),
        "currency": ("Currency Analysis", sales("Currency Analysis")),
    }


def _top_products(df: DataFrame) -> DataFrame:
    # The window runs over the few rows of the ranking only.
    place = F.row_number().over(Window.orderBy(F.col("total_quantity").desc(), "sku"))
    text = F.concat(
        F.coalesce(F.col("sku"), F.lit("None")),
        F.lit(": "),
        F.coalesce(F.col("total_quantity").cast("string"), F.lit("None")),
        F.lit(" units, "),
        F.coalesce(money_text(F.col("total_sales")), F.lit("None")),
    )
    measures = [
        ("total_quantity", F.col("total_quantity")),
        ("total_sales", F.col("total_sales")),
    ]
    placed = csv_top_skus(df).withColumn("place", place)
    return figures(
        placed,
        _NUMBER["Product Performance"],
        F.col("sku"),
        measures,
        text,
        seq=F.lit(FIGURES) + 2 * (F.col("place") - 1),
    )


def csv_report(
    df: DataFrame, unit_cost: float = UNIT_COST, products: DataFrame | None = None
) -> DataFrame:
    """All sections in the long format. A section whose columns the table lacks is a remark.

    ``products`` is the frame for the ranking of products, where df is cheaper without that column.
    """
    ranking = df if products is None else products
    found = find_roles([*df.columns, *(c for c in ranking.columns if c not in df.columns)])
    skipped = _skipped(found)
    lines = [(0, HEADING, TITLE)]
    lines += [(number, HEADING, title) for title, number in _NUMBER.items()]
    lines += [(_NUMBER[title], REMARK, reason) for title, reason in skipped.items()]
    shown = ", ".join(title for title in _NEEDS if title not in skipped) or "no section"
    lines.append((_NUMBER["General Summary"], FIGURES, f"Of this table: {shown}"))
    figures_shown = ", ".join(f"{role}: {column}" for role, column in found.items()) or "none"
    lines.append((_NUMBER["KPIs Summary"], FIGURES, f"Columns read: {figures_shown}"))
    parts = [remarks(df.sparkSession, lines)]

    distributions = {
        role: entry
        for role, (section, entry) in _distribution_entries().items()
        if section not in skipped
    }
    totals = _total_entries(skipped, unit_cost, DAMAGED in df.columns)
    if totals or distributions:
        grouped = _grouped(df, list(distributions))
        empty = "array<struct<section:int,seq:int,metric:string,value:double,text:string>>"
        per_row = F.when(
            F.col("role").isNull(), F.array(*totals) if totals else F.lit(None).cast(empty)
        )
        for role, entry in distributions.items():
            per_row = per_row.when(F.col("role") == role, F.array(entry))
        parts.append(
            grouped.select("key", F.inline(per_row)).select(
                "section", "seq", "metric", "key", "value", "text"
            )
        )
    if "Product Performance" not in skipped:
        parts.append(_top_products(ranking))
    return joined(parts)

