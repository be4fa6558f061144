"""The sales event: field names, types and money precision."""

from __future__ import annotations

from pyspark.sql import types as T

# Wire name, column name and type of each field of a sales event, in wire order.
EVENT_FIELDS = (
    ("Sales ID", "sales_id", T.StringType()),
    ("Order ID", "order_id", T.StringType()),
    ("Age", "age", T.IntegerType()),
    ("Order Total", "order_total", T.DoubleType()),
    ("Promo Code or Discount", "promo_code", T.StringType()),
    ("Product ID", "product_id", T.IntegerType()),
    ("Product Name", "product_name", T.StringType()),
    ("Quantity Sold", "quantity_sold", T.IntegerType()),
    ("Unit Price", "unit_price", T.DoubleType()),
    ("Total Sales Amount", "total_sales_amount", T.DoubleType()),
    ("Discount Amount", "discount_amount", T.DoubleType()),
    ("Tax Amount", "tax_amount", T.DoubleType()),
    ("Shipping Fee", "shipping_fee", T.DoubleType()),
    ("Transaction Date", "transaction_date", T.LongType()),
    ("Transaction Date Readable", "transaction_date_readable", T.StringType()),
    ("Customer ID", "customer_id", T.IntegerType()),
    ("Gender", "gender", T.StringType()),
    ("Payment Method", "payment_method", T.StringType()),
    ("Payment Status", "payment_status", T.StringType()),
    ("Transaction Status", "transaction_status", T.StringType()),
    ("Transaction Type", "transaction_type", T.StringType()),
    ("Location/Store", "location_store", T.StringType()),
    ("Sales Representative", "sales_representative", T.StringType()),
    ("Refund/Return Status", "refund_return_status", T.StringType()),
    ("Payment Confirmation Number", "payment_confirmation_number", T.StringType()),
    ("Session ID", "session_id", T.IntegerType()),
    ("Feature Accessed", "feature_accessed", T.StringType()),
    ("Session Duration", "session_duration", T.StringType()),
)

SALES_EVENT = T.StructType([T.StructField(wire, kind) for wire, _, kind in EVENT_FIELDS])
SNAKE_NAMES = {wire: name for wire, name, _ in EVENT_FIELDS}
WIRE_NAMES = {name: wire for wire, name, _ in EVENT_FIELDS}

# Amounts are summed as decimals, so that a total does not depend on the order in which Spark
# meets the rows, and are stored as decimals; they become doubles only where a reader asks for them.
# 22 digits before the point and 6 behind it; `partly_unreadable` reports the events with an amount
# that this does not hold exactly.
MONEY = T.DecimalType(28, 6)
MONEY_COLUMNS = (
    "order_total",
    "unit_price",
    "total_sales_amount",
    "discount_amount",
    "tax_amount",
    "shipping_fee",
)

# Name of the partition column that every stored metric carries.
BATCH_COLUMN = "micro_batch_id"
