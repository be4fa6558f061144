"""DuckDB SQL with the result that each query must have on the same tables.

Every text joins all six tables, whichever columns it needs, so it also checks that the queries may
leave joins out. Ratios are rounded on both sides.
"""

from __future__ import annotations

_SALES = """
sales AS (
  SELECT
    concat(l_orderkey, '-', l_linenumber) AS sales_id,
    cast(o_orderkey AS varchar) AS order_id,
    CASE WHEN c_custkey % 50 = 0 THEN NULL ELSE 15 + c_custkey % 60 END AS age,
    cast(o_totalprice AS decimal(18,2)) AS order_total,
    CASE WHEN l_discount = 0 THEN NULL ELSE 'DISCOUNT' END AS promo_code,
    p_partkey AS product_id,
    p_name AS product_name,
    cast(l_quantity AS bigint) AS quantity_sold,
    cast(p_retailprice AS decimal(18,2)) AS unit_price,
    cast(l_extendedprice AS decimal(18,2)) AS total_sales_amount,
    cast(l_extendedprice AS decimal(18,2)) * cast(l_discount AS decimal(4,2)) AS discount_amount,
    cast(l_extendedprice AS decimal(18,2)) * cast(l_tax AS decimal(4,2)) AS tax_amount,
    cast(5 + o_orderkey % 16 AS decimal(18,2)) AS shipping_fee,
    cast(epoch(o_orderdate) AS bigint) AS transaction_date,
    strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS transaction_date_readable,
    o_custkey AS customer_id,
    CASE WHEN c_custkey % 2 = 0 THEN 'male' ELSE 'female' END AS gender,
    o_orderpriority AS payment_method,
    l_linestatus AS payment_status,
    o_orderstatus AS transaction_status,
    CASE WHEN l_returnflag = 'R' THEN 'return' ELSE 'purchase' END AS transaction_type,
    n_name AS location_store,
    s_name AS sales_representative,
    l_returnflag AS refund_return_status,
    concat('PAY-', o_orderkey) AS payment_confirmation_number,
    o_orderkey % 100 + 1 AS session_id,
    CASE l_linenumber WHEN 1 THEN 'Home' WHEN 2 THEN 'Product Page' WHEN 3 THEN 'Cart'
                      WHEN 4 THEN 'Checkout' WHEN 5 THEN 'Profile' END AS feature_accessed,
    cast(300 + (l_orderkey * 7 + l_linenumber * 13) % 1501 AS varchar) AS session_duration,
    cast(l_linenumber AS bigint) AS micro_batch_id
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
  JOIN part ON l_partkey = p_partkey
  JOIN supplier ON l_suppkey = s_suppkey
)"""

AS_OF = 1_000_000_000


def _over_sales(select: str, *more: str) -> str:
    return "WITH " + ",\n".join([_SALES, *more]) + "\n" + select


_AGE_GROUP = """CASE WHEN age BETWEEN 18 AND 35 THEN 'Young Age'
                     WHEN age BETWEEN 36 AND 60 THEN 'Middle Age'
                     WHEN age > 60 THEN 'Old Age' ELSE 'Unknown' END"""

_PROFIT = """cast(sum(total_sales_amount) AS double) AS total_sales_amount,
       cast(sum(discount_amount) AS double) AS total_discount_amount,
       cast(sum(tax_amount) AS double) AS total_tax_amount,
       cast(sum(shipping_fee) AS double) AS total_shipping_fee,
       cast(sum(quantity_sold) AS bigint) AS total_quantity_sold,
       cast(sum(total_sales_amount) - sum(discount_amount) - sum(tax_amount) - sum(shipping_fee)
            AS double) AS profit"""

_SALES_AND_QUANTITY = """cast(sum(total_sales_amount) AS double) AS total_sales_amount,
       cast(sum(quantity_sold) AS bigint) AS total_quantity_sold"""

_METRICS = {
    "kpi_summary": """
SELECT cast(sum(total_sales_amount) AS double) AS total_sales,
       cast(sum(total_sales_amount) - sum(discount_amount) AS double) AS revenue,
       round(cast(sum(total_sales_amount) AS double) / count(order_id), 6) AS avg_sales,
       cast(sum(quantity_sold) AS bigint) AS total_inventory_value
FROM sales""",
    "customer_lifetime_value": """
SELECT customer_id, cast(sum(total_sales_amount) AS double) AS customer_lifetime_value
FROM sales GROUP BY customer_id""",
    "website_traffic_exact": """
SELECT count(DISTINCT customer_id) AS website_traffic FROM sales""",
    "transaction_status_share": """
SELECT transaction_status, count(order_id) AS orders_count,
       round(cast(count(order_id) AS double) / (SELECT count(*) FROM sales) * 100, 6) AS bounce_rate
FROM sales GROUP BY transaction_status""",
    "stock_sold": """
SELECT product_name, cast(sum(quantity_sold) AS bigint) AS stock_sold
FROM sales GROUP BY product_name""",
    "inventory_turnover": """
SELECT product_name,
       round(cast(sum(quantity_sold) AS double) / count(DISTINCT transaction_date_readable), 6)
         AS inventory_turnover
FROM sales GROUP BY product_name""",
    "gender_counts": """
SELECT gender, count(customer_id) AS customer_count FROM sales GROUP BY gender""",
    "age_groups": f"""
SELECT {_AGE_GROUP} AS age_group, count(customer_id) AS customer_count FROM sales GROUP BY 1""",
    "payment_method_counts": """
SELECT payment_method, count(customer_id) AS customer_count FROM sales GROUP BY payment_method""",
    "top_selling_products": """
SELECT product_name, cast(sum(quantity_sold) AS bigint) AS total_quantity_sold
FROM sales GROUP BY product_name ORDER BY total_quantity_sold DESC, product_name""",
    "product_performance": """
SELECT product_name, transaction_date_readable,
       cast(sum(quantity_sold) AS bigint) AS quantity_sold,
       cast(sum(total_sales_amount) AS double) AS total_sales_amount
FROM sales GROUP BY product_name, transaction_date_readable""",
    "product_profitability": f"""
SELECT product_name, {_PROFIT}
FROM sales GROUP BY product_name ORDER BY profit DESC, product_name""",
    "sales_rep_performance": f"""
SELECT sales_representative, {_SALES_AND_QUANTITY}
FROM sales GROUP BY sales_representative ORDER BY total_sales_amount DESC, sales_representative""",
    "location_performance": f"""
SELECT location_store, {_SALES_AND_QUANTITY}
FROM sales GROUP BY location_store ORDER BY total_sales_amount DESC, location_store""",
    "avg_order_value": """
SELECT location_store,
       round(cast(sum(total_sales_amount) AS double) / count(DISTINCT order_id), 6)
         AS average_order_value
FROM sales GROUP BY location_store ORDER BY average_order_value DESC, location_store""",
    "rfm": f"""
SELECT customer_id, count(DISTINCT order_id) AS frequency,
       cast(sum(total_sales_amount) AS double) AS monetary,
       round(cast({AS_OF} - max(transaction_date) AS double) / 86400, 6) AS recency
FROM sales GROUP BY customer_id""",
    "app_usage": """
SELECT customer_id, count(DISTINCT session_id) AS total_sessions,
       sum(cast(session_duration AS double)) AS total_session_duration,
       count(feature_accessed) AS total_features_accessed
FROM sales GROUP BY customer_id""",
    "avg_session_duration": """
SELECT customer_id,
       round(sum(cast(session_duration AS double)) / count(DISTINCT session_id), 6)
         AS avg_session_duration
FROM sales GROUP BY customer_id""",
}



def _batched(sums: str, key: str) -> str:
    """Rows of an appended metric: per batch first."""
    return f"batches AS (SELECT micro_batch_id, {key}, {sums} FROM sales GROUP BY ALL)"


_EXACT = "decimal(38,4)"
_BATCH_PROFIT = _batched(_PROFIT, "product_name")


def _total(column: str) -> str:
    return f"cast(sum(cast({column} AS {_EXACT})) AS double) AS {column}"


def _count(column: str) -> str:
    return f"cast(sum({column}) AS bigint) AS {column}"


_CUMULATIVE = {
    "cumulative_stock_sold": (
        _batched("sum(quantity_sold) AS stock_sold", "product_name"),
        f"SELECT product_name, {_count('stock_sold')} FROM batches GROUP BY product_name",
    ),
    "cumulative_age_groups": (
        _batched("count(customer_id) AS customer_count", f"{_AGE_GROUP} AS age_group"),
        f"SELECT age_group, {_count('customer_count')} FROM batches GROUP BY age_group",
    ),
    "cumulative_top_selling_products": (
        _batched("sum(quantity_sold) AS total_quantity_sold", "product_name"),
        f"SELECT product_name, {_count('total_quantity_sold')} FROM batches GROUP BY product_name",
    ),
    "cumulative_product_profitability": (
        _BATCH_PROFIT,
        f"""SELECT product_name, {_total('total_sales_amount')}, {_total('total_discount_amount')},
                   {_total('total_tax_amount')}, {_total('total_shipping_fee')},
                   {_count('total_quantity_sold')}, {_total('profit')}
            FROM batches GROUP BY product_name""",
    ),
    "cumulative_sales_rep_performance": (
        _batched(_SALES_AND_QUANTITY, "sales_representative"),
        f"""SELECT sales_representative, {_total('total_sales_amount')},
                   {_count('total_quantity_sold')}
            FROM batches GROUP BY sales_representative""",
    ),
    "cumulative_location_performance": (
        _batched(_SALES_AND_QUANTITY, "location_store"),
        f"""SELECT location_store, {_total('total_sales_amount')}, {_count('total_quantity_sold')}
            FROM batches GROUP BY location_store""",
    ),
    "gender_totals": (
        _batched("count(customer_id) AS customer_count", "gender"),
        """SELECT cast(coalesce(sum(customer_count) FILTER (lower(gender) = 'male'), 0) AS bigint)
                    AS male_count,
                  cast(coalesce(sum(customer_count) FILTER (lower(gender) = 'female'), 0) AS bigint)
                    AS female_count
           FROM batches""",
    ),
    "profitability_points": (
        _BATCH_PROFIT,
        f"""SELECT total_sales_amount, total_discount_amount FROM (
              SELECT product_name, {_total('total_sales_amount')}, {_total('total_discount_amount')}
              FROM batches GROUP BY product_name ORDER BY product_name LIMIT 15)""",
    ),
    "payment_method_table": (
        _batched("count(customer_id) AS customer_count", "payment_method"),
        f"SELECT payment_method, {_count('customer_count')} FROM batches GROUP BY payment_method",
    ),
    "profitability_trend": (
        _BATCH_PROFIT,
        f"""SELECT round(regr_slope(total_discount_amount, total_sales_amount), 6) AS slope,
                   round(regr_intercept(total_discount_amount, total_sales_amount), 1) AS intercept,
                   round(regr_r2(total_discount_amount, total_sales_amount), 6) AS r2,
                   cast(regr_count(total_discount_amount, total_sales_amount) AS bigint) AS points
            FROM (SELECT product_name, {_total('total_sales_amount')},
                         {_total('total_discount_amount')}
                  FROM batches GROUP BY product_name)""",
    ),
}

_SERVING = {
    "product_performance_series": f"""
SELECT transaction_date_readable, quantity_sold, total_sales_amount
FROM ({_METRICS['product_performance']}) ORDER BY transaction_date_readable, product_name LIMIT 15""",
    "location_table": _METRICS["location_performance"],
    "monetary_values": f"SELECT monetary FROM ({_METRICS['rfm']})",
    "latest_kpis": _METRICS["kpi_summary"],
    "inventory_table": f"""
SELECT * FROM ({_METRICS['inventory_turnover']}) ORDER BY product_name LIMIT 12""",
    "monetary_histogram": f"""
SELECT cast(floor(monetary / 50) * 50 AS double) AS bucket, count(*) AS customers
FROM ({_METRICS['rfm']}) GROUP BY 1""",
    "sample_locations": f"""
SELECT * FROM ({_METRICS['location_performance']})
ORDER BY md5(concat('0:', location_store)), location_store LIMIT 5""",
}


def _lines(
    section: int, source: str, key: str, *measures: str, seq: int = 2, text: str | None = None
) -> list[str]:
    """Figures of a report; with a text, the first measure carries it."""
    texts = [f", {text if place == 0 else 'NULL'} AS text" if text else "" for place in range(len(measures))]
    return [
        f"""SELECT {section} AS section, {seq + place} AS seq, '{name}' AS metric, {key} AS key,
                   round(cast({name} AS double), 6) AS value{texts[place]}
            FROM ({source})"""
        for place, name in enumerate(measures)
    ]


def _money(amount: str) -> str:
    return f"'$' || format('{{:,.2f}}', cast({amount} AS double))"


_POINTS = f"SELECT * FROM ({_METRICS['product_profitability']}) ORDER BY product_name LIMIT 15"
_KPI_NAMES = ("total_sales", "revenue", "avg_sales", "total_inventory_value")

_INSIGHTS = " UNION ALL ".join(
    [
        *_lines(
            1,
            _METRICS["payment_method_counts"],
            "payment_method",
            "customer_count",
            text="payment_method || ': ' || customer_count || ' customers'",
        ),
        *_lines(
            2,
            _SERVING["product_performance_series"],
            "transaction_date_readable",
            "total_sales_amount",
            "quantity_sold",
            text="transaction_date_readable || ': Quantity Sold - ' || quantity_sold "
            f"|| ', Total Sales - ' || {_money('total_sales_amount')}",
        ),
        *[
            line
            for place, word in enumerate(("Male", "Female"))
            for line in _lines(
                3,
                f"{_METRICS['gender_counts']} HAVING gender = '{word.lower()}'",
                "gender",
                "customer_count",
                seq=2 + place,
                text=f"'{word} Count - ' || customer_count || ' customers'",
            )
        ],
        *_lines(
            4, _METRICS["rfm"], "NULL", "monetary", text=f"'Monetary - ' || {_money('monetary')}"
        ),
        *_lines(
            5,
            _POINTS,
            "NULL",
            "total_sales_amount",
            "total_discount_amount",
            text=f"'Total Sales - ' || {_money('total_sales_amount')} || ', Total Discount - ' "
            f"|| {_money('total_discount_amount')}",
        ),
        *_lines(
            6,
            _METRICS["location_performance"],
            "location_store",
            "total_sales_amount",
            "total_quantity_sold",
            text=f"'Location - ' || location_store || ', Total Sales - ' || {_money('total_sales_amount')} "
            "|| ', Total Quantity Sold - ' || total_quantity_sold || ' units'",
        ),
        *[
            line
            for place, (name, label) in enumerate(
                zip(
                    _KPI_NAMES,
                    ("Total Sales", "Revenue", "Average Sales", "Total Inventory Value"),
                )
            )
            for line in _lines(
                7, _METRICS["kpi_summary"], "NULL", name, seq=2 + place, text=f"'{label}: ' || {_money(name)}"
            )
        ],
        *_lines(
            8, _SERVING["inventory_table"], "product_name", "inventory_turnover", text="NULL"
        ),
    ]
)

_TOTAL_SALES = "cast(sum(total_sales_amount) AS double)"
_TOTAL_QUANTITY = "cast(sum(quantity_sold) AS double)"


def _counted(column: str, name: str) -> str:
    return f"SELECT {column} AS {name}, count(*) AS count FROM sales GROUP BY {column}"


def _summed(column: str, name: str) -> str:
    return f"SELECT {column} AS {name}, {_TOTAL_SALES} AS total_sales FROM sales GROUP BY {column}"


_CSV = {
    "csv_sales_overview": f"""
SELECT {_TOTAL_SALES} AS total_sales,
       round({_TOTAL_SALES} / count(*), 6) AS average_order_value FROM sales""",
    "csv_daily_sales": _summed("transaction_date_readable", "date"),
    "csv_top_skus": f"""
SELECT product_name AS sku, {_TOTAL_QUANTITY} AS total_quantity, {_TOTAL_SALES} AS total_sales
FROM sales GROUP BY product_name ORDER BY total_quantity DESC, sku LIMIT 5""",
    "csv_fulfillment": _counted("gender", "fulfillment"),
    "csv_courier_status": _counted("feature_accessed", "courier_status"),
    "csv_order_status": _counted("transaction_status", "order_status"),
    "csv_quantity": f"""
SELECT {_TOTAL_QUANTITY} AS total_quantity,
       round({_TOTAL_QUANTITY} / count(*), 6) AS average_quantity FROM sales""",
    "csv_financials": f"""
SELECT {_TOTAL_SALES} AS gross_revenue, {_TOTAL_QUANTITY} * 50 AS estimated_cost,
       round(({_TOTAL_SALES} - {_TOTAL_QUANTITY} * 50) / {_TOTAL_SALES} * 100, 6)
         AS profit_margin_percent
FROM sales""",
    "csv_currency": _summed("payment_method", "currency"),
}


def _ranked_lines() -> list[str]:
    ranked = f"""SELECT *, row_number() OVER (ORDER BY total_quantity DESC, sku) AS place
                 FROM ({_CSV['csv_top_skus']})"""
    return [
        f"""SELECT 3 AS section, cast(2 * place + {more} AS integer) AS seq, '{name}' AS metric, sku AS key,
                   round({name}, 6) AS value FROM ({ranked})"""
        for more, name in enumerate(("total_quantity", "total_sales"))
    ]


def _renamed(query: str, metric: str) -> str:
    return f"SELECT * RENAME (count AS {metric}) FROM ({query})"


_SHOWN_KEY = "coalesce({}, 'None') || ': ' || {}"


def _csv_lines(section: int, query: str, key: str, metric: str, label: str, value: str, seq: int = 2) -> list[str]:
    return _lines(section, query, key, metric, seq=seq, text=f"'{label}' || {value}")


_CSV_REPORT = " UNION ALL ".join(
    [
        *_csv_lines(
            1, _CSV["csv_sales_overview"], "NULL", "total_sales", "Total Sales: ", _money("total_sales")
        ),
        *_csv_lines(
            1,
            _CSV["csv_sales_overview"],
            "NULL",
            "average_order_value",
            "Average Order Value: ",
            _money("average_order_value"),
            seq=3,
        ),
        *_csv_lines(
            1,
            "SELECT 0 AS unreadable_amounts",
            "NULL",
            "unreadable_amounts",
            "Amounts that are no number: ",
            "unreadable_amounts",
            seq=4,
        ),
        *_lines(
            2,
            _CSV["csv_daily_sales"],
            "date",
            "total_sales",
            text=_SHOWN_KEY.format("date", _money("total_sales")),
        ),
        *[line.replace(" AS value", " AS value, NULL AS text") for line in _ranked_lines()],
        *[
            line
            for section, seq, name in ((4, 2, "fulfillment"), (5, 2, "courier_status"), (5, 3, "order_status"))
            for line in _lines(
                section,
                _renamed(_CSV[f"csv_{name}"], f"{name}_rows"),
                name,
                f"{name}_rows",
                seq=seq,
                text=_SHOWN_KEY.format(name, f"{name}_rows"),
            )
        ],
        *_lines(7, _CSV["csv_quantity"], "NULL", "total_quantity", "average_quantity", text="NULL"),
        *_lines(
            7, "SELECT 0 AS unreadable_quantities", "NULL", "unreadable_quantities", seq=4,
            text="'Quantities that are no number: ' || unreadable_quantities",
        ),
        *_csv_lines(
            8, _CSV["csv_financials"], "NULL", "gross_revenue", "Gross Revenue: ", _money("gross_revenue")
        ),
        *_csv_lines(
            8,
            _CSV["csv_financials"],
            "NULL",
            "estimated_cost",
            "Estimated Cost: ",
            _money("estimated_cost"),
            seq=3,
        ),
        *_csv_lines(
            8,
            _CSV["csv_financials"],
            "NULL",
            "profit_margin_percent",
            "Profit Margin: ",
            "format('{:.2f}', cast(profit_margin_percent AS double)) || '%'",
            seq=4,
        ),
        *_lines(
            9,
            _CSV["csv_currency"],
            "currency",
            "total_sales",
            text=_SHOWN_KEY.format("currency", _money("total_sales")),
        ),
    ]
)

_READABLE = "strftime(make_timestamp(({epoch}) * 1000000), '%Y-%m-%d %H:%M:%S')"
_EVENT_COLUMNS = (
    "sales_id order_id age promo_code product_id product_name quantity_sold transaction_date "
    "transaction_date_readable customer_id gender payment_method payment_status "
    "transaction_status transaction_type location_store sales_representative "
    "refund_return_status payment_confirmation_number session_id feature_accessed session_duration"
).split()
_EVENT_MONEY = (
    "order_total unit_price total_sales_amount discount_amount tax_amount shipping_fee"
).split()

_INGEST = {
    "enriched_events": f"""
SELECT sales_id, session_duration,
       cast(round(quantity_sold * unit_price, 2) AS double) AS total_sales_amount,
       {_READABLE.format(epoch='transaction_date')} AS transaction_date_readable,
       {_READABLE.format(epoch='transaction_date + cast(session_duration AS bigint)')}
         AS session_end
FROM sales""",
    "ingested_events": f"""
SELECT transaction_type, payment_method,
       {', '.join(f'count({name}) AS {name}_rows' for name in _EVENT_COLUMNS)},
       {', '.join(f'cast(sum({name}) AS double) AS {name}' for name in _EVENT_MONEY)},
       cast(sum(age) AS bigint) AS age,
       cast(sum(transaction_date) AS bigint) AS transaction_date,
       max(transaction_date_readable) AS newest,
       min(sales_id) AS first_sales_id
FROM sales GROUP BY transaction_type, payment_method""",
}


_STATES = {
    **{
        f"cumulative_{name}": _METRICS[name]
        for name in ("avg_order_value", "rfm", "inventory_turnover", "app_usage", "avg_session_duration")
    },
    "stored_gender_totals": """
SELECT count(customer_id) FILTER (lower(gender) = 'male') AS male_count,
       count(customer_id) FILTER (lower(gender) = 'female') AS female_count FROM sales""",
    "stored_latest_kpis": _METRICS["kpi_summary"],
    "stored_avg_order_value": _METRICS["avg_order_value"],
    "cumulative_website_traffic_check": """
SELECT count(DISTINCT customer_id) AS exact, true AS is_near FROM sales""",
    "monetary_quantiles_check": """
SELECT count(DISTINCT customer_id) AS customers, unnest(CAST([0, 0.1, 0.25, 0.5, 0.75, 0.9, 0.99, 1] AS DOUBLE[])) AS share,
       true AS is_near FROM sales""",
    "monetary_histogram_check": """
SELECT count(DISTINCT customer_id) AS customers, true AS is_near FROM sales""",
}

_CHECKS = {
    "website_traffic_check": """
SELECT count(DISTINCT customer_id) AS exact, true AS is_near FROM sales""",
    "predict_sales_check": """
SELECT count(*) AS n_rows, round(cast(sum(total_sales_amount) AS double), 2) AS total_sales_amount,
       true AS in_range FROM sales""",
    "regression_mse_check": "SELECT count(*) AS n_rows, true AS error_is_small FROM sales",
}

_FOREIGN_KEYS = (
    ("lineitem", "l_orderkey", "orders", "o_orderkey"),
    ("lineitem", "l_partkey", "part", "p_partkey"),
    ("lineitem", "l_suppkey", "supplier", "s_suppkey"),
    ("orders", "o_custkey", "customer", "c_custkey"),
    ("customer", "c_nationkey", "nation", "n_nationkey"),
)
_KEY_VIOLATIONS = " UNION ALL ".join(
    f"""
SELECT '{child}.{foreign}' AS foreign_key, 'dangling' AS problem, count(*) AS rows
FROM {child} WHERE {foreign} IS NULL OR {foreign} NOT IN (SELECT {key} FROM {parent})
UNION ALL
SELECT '{child}.{foreign}', 'repeated', count(*) FROM (SELECT {key} FROM {parent} GROUP BY {key} HAVING count(*) > 1)"""
    for child, foreign, parent, key in _FOREIGN_KEYS
)


def oracle_sql() -> dict[str, str]:
    texts = {**_METRICS, **_SERVING, **_CSV, **_INGEST, **_STATES, **_CHECKS}
    texts["insights_report"] = _INSIGHTS
    texts["csv_report"] = _CSV_REPORT
    over_sales = {name: _over_sales(select) for name, select in texts.items()}
    over_batches = {
        name: _over_sales(select, batches) for name, (batches, select) in _CUMULATIVE.items()
    }
    return {**over_sales, **over_batches, "key_violations": _KEY_VIOLATIONS}
