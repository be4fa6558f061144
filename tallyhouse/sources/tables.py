"""Sales events as a view over a star schema: line items, orders, customers, parts, suppliers.

The view is built for the columns a query asks for. With ``foreign_keys="trusted"`` (every key of a
line item finds exactly one row in the table it points to, the contract of the tables) a table is
joined only if a column is taken from it, so a metric by product reads no orders at all. With
``"enforced"`` all six tables are inner-joined and lines with a dangling key drop out.

:func:`key_violations` tells whether given tables keep that contract.

No join carries a broadcast hint: Spark broadcasts a side when its measured size is below
``spark.sql.autoBroadcastJoinThreshold`` and otherwise shuffles both, and adaptive execution splits
a skewed key's partition. Orders meet customers and nations before they meet the line items, so the
large table is shuffled once per foreign key and never for a column of a column.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.functions.scalars import epoch_of, utc_text
from tallyhouse.operators.catalogue import Metric
from tallyhouse.operators.combining import EVENT_ROWS, combine, counter, distinct_counter

TRUSTED = "trusted"
ENFORCED = "enforced"

# The product has four digits after the point, so the outer cast rounds nothing; it keeps the
# amount within 18 digits, which Spark holds in a long.
_PART_OF_PRICE = (
    "cast(cast(l_extendedprice AS decimal(18,2)) * cast({rate} AS decimal(4,2)) AS decimal(18,4))"
)
_FEATURE = """CASE l_linenumber WHEN 1 THEN 'Home' WHEN 2 THEN 'Product Page' WHEN 3 THEN 'Cart'
              WHEN 4 THEN 'Checkout' WHEN 5 THEN 'Profile' END"""

# Columns of a line item itself.
_LINE = {
    "sales_id": "concat(l_orderkey, '-', l_linenumber)",
    "product_id": "l_partkey",
    "quantity_sold": "cast(l_quantity AS bigint)",
    "total_sales_amount": "cast(l_extendedprice AS decimal(18,2))",
    "discount_amount": _PART_OF_PRICE.format(rate="l_discount"),
    "tax_amount": _PART_OF_PRICE.format(rate="l_tax"),
    "promo_code": "CASE WHEN l_discount = 0 THEN NULL ELSE 'DISCOUNT' END",
    "payment_status": "l_linestatus",
    "transaction_type": "CASE WHEN l_returnflag = 'R' THEN 'return' ELSE 'purchase' END",
    "refund_return_status": "l_returnflag",
    "feature_accessed": _FEATURE,
    "session_duration": "cast(300 + (l_orderkey * 7 + l_linenumber * 13) % 1501 AS string)",
    "micro_batch_id": "cast(l_linenumber AS bigint)",
}

# Columns that the key of the order determines, so no order is read for them.
_ORDER_KEY = {
    "order_id": "cast(l_orderkey AS string)",
    "shipping_fee": "cast(5 + l_orderkey % 16 AS decimal(18,2))",
    "payment_confirmation_number": "concat('PAY-', l_orderkey)",
    "session_id": "l_orderkey % 100 + 1",
}

_ORDER = {
    "order_total": "cast(o_totalprice AS decimal(18,2))",
    "customer_id": "o_custkey",
    "age": "CASE WHEN o_custkey % 50 = 0 THEN NULL ELSE cast(15 + o_custkey % 60 AS int) END",
    "gender": "CASE WHEN o_custkey % 2 = 0 THEN 'male' ELSE 'female' END",
    "payment_method": "o_orderpriority",
    "transaction_status": "o_orderstatus",
    "transaction_date": None,
    "transaction_date_readable": None,
}
_PLACE = {"location_store": "n_name"}
_PART = {"product_name": "p_name", "unit_price": "cast(p_retailprice AS decimal(18,2))"}
_SUPPLIER = {"sales_representative": "s_name"}

SALES_COLUMNS = (*_LINE, *_ORDER_KEY, *_ORDER, *_PLACE, *_PART, *_SUPPLIER)


def _table(spark: SparkSession, path: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{path}/{name}.parquet")


def _expressions(source: dict[str, str | None], wanted: Iterable[str]) -> list[Column]:
    return [_expression(source, name).alias(name) for name in wanted if name in source]


def _expression(source: dict[str, str | None], name: str) -> Column:
    if name == "transaction_date":
        return epoch_of(F.col("o_orderdate"))
    if name == "transaction_date_readable":
        return utc_text(epoch_of(F.col("o_orderdate")))
    return F.expr(source[name])


def _orders(spark: SparkSession, path: str, wanted: list[str], enforced: bool) -> DataFrame:
    orders = _table(spark, path, "orders")
    if enforced or any(name in _PLACE for name in wanted):
        nation = _table(spark, path, "nation").select("n_nationkey", "n_name")
        customer = _table(spark, path, "customer").select("c_custkey", "c_nationkey")
        placed = customer.join(nation, customer["c_nationkey"] == nation["n_nationkey"])
        orders = orders.join(placed, orders["o_custkey"] == placed["c_custkey"])
    return orders.select(
        F.col("o_orderkey").alias("l_orderkey"), *_expressions({**_ORDER, **_PLACE}, wanted)
    )


def _dimensions(
    spark: SparkSession, path: str, wanted: list[str], enforced: bool
) -> dict[str, DataFrame]:
    """The tables to join, by the line item's key, each with that key and the wanted columns."""
    found: dict[str, DataFrame] = {}
    if enforced or any(name in _ORDER or name in _PLACE for name in wanted):
        found["l_orderkey"] = _orders(spark, path, wanted, enforced)
    if enforced or any(name in _PART for name in wanted):
        found["l_partkey"] = _table(spark, path, "part").select(
            F.col("p_partkey").alias("l_partkey"), *_expressions(_PART, wanted)
        )
    if enforced or any(name in _SUPPLIER for name in wanted):
        found["l_suppkey"] = _table(spark, path, "supplier").select(
            F.col("s_suppkey").alias("l_suppkey"), *_expressions(_SUPPLIER, wanted)
        )
    return found


def sales_view(
    spark: SparkSession,
    path: str,
    columns: Iterable[str] = SALES_COLUMNS,
    foreign_keys: str = TRUSTED,
) -> DataFrame:
    """The events with the asked columns, one row per line item."""
    wanted = list(columns)
    dimensions = _dimensions(spark, path, wanted, foreign_keys == ENFORCED)
    lines = _table(spark, path, "lineitem").select(
        *dimensions, *_expressions({**_LINE, **_ORDER_KEY}, wanted)
    )
    for key, dimension in dimensions.items():
        lines = lines.join(dimension, key)
    return lines.select(*wanted)


def combined_sales(
    spark: SparkSession, path: str, metric: Metric, foreign_keys: str = TRUSTED
) -> DataFrame:
    """The events a metric reads, combined per foreign key before they are joined.

    When the metric takes columns from one other table only, its measures are summed per key of
    that table first. The join then needs no second shuffle of the lines, and a key that holds a
    large part of all lines reaches it as a single row. A metric by product and moment of sale meets
    the orders line by line, is summed per part and moment, and then meets the parts. In all other
    cases, or where keys are enforced, this is the plain view.
    """
    wanted = list(metric.columns)
    dimensions = _dimensions(spark, path, wanted, foreign_keys == ENFORCED)
    if foreign_keys != ENFORCED and _by_product_and_moment(metric):
        return _sales_by_product_and_moment(spark, path, metric)
    if foreign_keys == ENFORCED or len(dimensions) != 1:
        return sales_view(spark, path, wanted, foreign_keys)

    ((key, dimension),) = dimensions.items()
    by_key = _ORDER_KEY if key == "l_orderkey" else {}
    on_line = {name: sql for name, sql in {**_LINE, **_ORDER_KEY}.items() if name in wanted}
    grouping = [
        name for name in metric.keys + metric.distincts if name in on_line and name not in by_key
    ]
    sums = [name for name in metric.sums if name in on_line]
    counts = [name for name in metric.counts if name in on_line]
    if set(metric.sums) - set(sums) or any(name in on_line for name in metric.maxes):
        return sales_view(spark, path, wanted, foreign_keys)

    measured = dict.fromkeys([*grouping, *sums, *counts])
    lines = _table(spark, path, "lineitem").select(key, *_expressions(on_line, measured))
    combined = combine(lines, [key, *grouping], sums=sums, counts=counts)
    joined = combined.join(dimension, key)

    derived = [name for name in metric.keys + metric.distincts if name in by_key]
    ones = []
    if "order_id" in metric.distincts and "order_id" in derived and not grouping:
        # A row is an order, so that counting orders is adding ones
        derived.remove("order_id")
        ones = [F.lit(1).cast("bigint").alias(distinct_counter("order_id"))]
    kept = [name for name in wanted if name in dimension.columns or name in grouping + sums]
    counters = [
        F.col(counter(name))
        if name in counts
        else F.when(F.col(name).isNotNull(), F.col(EVENT_ROWS)).alias(counter(name))
        for name in metric.counts
    ]
    return joined.select(*kept, *_expressions(by_key, derived), *ones, *counters, EVENT_ROWS)


def _by_product_and_moment(metric: Metric) -> bool:
    dimensions = {"product_name", "transaction_date_readable"}
    measures_of_lines = set(metric.sums) <= _LINE.keys() and not metric.counts + metric.maxes
    return measures_of_lines and set(metric.keys + metric.distincts) == dimensions


def _sales_by_product_and_moment(spark: SparkSession, path: str, metric: Metric) -> DataFrame:
    """The moment stays a number until the lines are summed per part and moment, so that what is
    shuffled to the parts is small, and a product with many lines is one row per moment and task."""
    orders = _table(spark, path, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), epoch_of(F.col("o_orderdate")).alias("moment")
    )
    lines = _table(spark, path, "lineitem").select(
        "l_orderkey", "l_partkey", *_expressions(_LINE, metric.sums)
    )
    combined = combine(lines.join(orders, "l_orderkey"), ["l_partkey", "moment"], sums=metric.sums)
    parts = _table(spark, path, "part").select(
        F.col("p_partkey").alias("l_partkey"), F.col("p_name").alias("product_name")
    )
    return combined.join(parts, "l_partkey").select(
        "product_name",
        utc_text(F.col("moment")).alias("transaction_date_readable"),
        *metric.sums,
        EVENT_ROWS,
    )


# Child table, its foreign key, the table it points to, and the key there.
_FOREIGN_KEYS = (
    ("lineitem", "l_orderkey", "orders", "o_orderkey"),
    ("lineitem", "l_partkey", "part", "p_partkey"),
    ("lineitem", "l_suppkey", "supplier", "s_suppkey"),
    ("orders", "o_custkey", "customer", "c_custkey"),
    ("customer", "c_nationkey", "nation", "n_nationkey"),
)


def key_violations(spark: SparkSession, path: str) -> DataFrame:
    """Per foreign key, the rows that point nowhere and the keys that are not unique.

    All zero means that trusted and enforced keys give the same view.
    """
    counts = []
    for child, foreign, parent, key in _FOREIGN_KEYS:
        pointing = _table(spark, path, child).groupBy(F.col(foreign).alias("k")).count()
        owned = _table(spark, path, parent).groupBy(F.col(key).alias("k")).count()
        dangling = pointing.join(owned, "k", "left_anti").agg(F.sum("count").alias("n"))
        repeated = owned.where("count > 1").agg(F.count(F.lit(1)).alias("n"))
        for problem, found in (("dangling", dangling), ("repeated", repeated)):
            counts.append(
                found.select(
                    F.lit(f"{child}.{foreign}").alias("foreign_key"),
                    F.lit(problem).alias("problem"),
                    F.coalesce("n", F.lit(0)).alias("rows"),
                )
            )
    return reduce(DataFrame.unionByName, counts)
