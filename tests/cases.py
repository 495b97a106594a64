"""Small frames whose answers are obvious."""

from orderlake.schemas import RAW_CUSTOMERS, RAW_ORDERS, RAW_PRODUCTS

GOOD = "2026-08-11 09:15:00"


def orders(spark, *rows):
    return spark.createDataFrame(list(rows), RAW_ORDERS)


def order(order_id="A1", customer="K1", product="W1", quantity="2", date=GOOD, status="SHIPPED"):
    return (order_id, customer, product, quantity, date, status)


def customers(spark, *extra):
    rows = [
        ("K1", "Ada", "ada@example.com", "NO", "2024-02-01"),
        ("K2", "Bo", "bo@example.com", "PE", "2024-03-01"),
        *extra,
    ]
    return spark.createDataFrame(rows, RAW_CUSTOMERS)


def products(spark, *extra):
    rows = [
        ("W1", "Lamp", "Home", 12.5),
        ("W2", "Rope", "Sport", 3.0),
        ("W3", "Refund", "Odd", -4.0),
        ("W4", "Gift", "Odd", 0.0),
        ("W5", "Unpriced", "Odd", None),
        *extra,
    ]
    return spark.createDataFrame(rows, RAW_PRODUCTS)
