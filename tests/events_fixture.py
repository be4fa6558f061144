"""Hand-made events: null keys, edge ages, an order over two sessions, a location without orders."""

SCHEMA = """order_id string, age int, product_name string, quantity_sold int,
            total_sales_amount decimal(18,4), discount_amount decimal(18,4),
            tax_amount decimal(18,4), shipping_fee decimal(18,4), transaction_date bigint,
            transaction_date_readable string, customer_id int, gender string,
            payment_method string, transaction_status string, location_store string,
            sales_representative string, session_id int, feature_accessed string,
            session_duration string"""

_DAY = 86400


def _event(order, age, product, quantity, total, day, customer, gender, place, session, **more):
    from decimal import Decimal

    return (
        order,
        age,
        product,
        quantity,
        Decimal(total),
        Decimal(more.get("discount", "1")),
        Decimal(more.get("tax", "0.5")),
        Decimal("5"),
        day * _DAY,
        f"1970-01-{day + 1:02d} 00:00:00",
        customer,
        gender,
        more.get("method", "Gift Card"),
        more.get("status", "Successful"),
        place,
        more.get("rep", "Diya"),
        session,
        more.get("feature", "Cart"),
        more.get("duration", "300"),
    )


EVENTS = [
    _event("o1", 17, "ring", 1, "10.10", 1, 1, "male", "Goa", 1),
    _event("o1", 18, "ring", 2, "20.20", 1, 1, "male", "Goa", 2, feature=None),
    _event("o2", 35, "bolt", 3, "30.30", 2, 1, "Male", "Goa", 2, status="Abandoned"),
    _event("o3", 36, "bolt", 4, "40.40", 2, 2, "female", "Delhi", 3, method="credit card"),
    _event("o4", 60, "bolt", 5, "50.50", 3, 2, "female", "Delhi", 3, duration="aa"),
    _event("o5", 61, None, 6, "60.60", 3, 3, None, "Delhi", 4, rep="Rohan"),
    _event(None, None, "nut", 7, "70.70", 4, None, "female", "Assam", 5, status=None),
]
