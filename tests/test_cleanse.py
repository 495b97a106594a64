import random
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from cases import GOOD, customers, order, orders, products
from conftest import final_plan_of, plan_of
from orderlake.operators import cleanse
from orderlake.operators.keys import key_violations
from orderlake.schemas import CURATED, QUARANTINE


def judged(spark, *rows, **kwargs):
    return cleanse.judge_orders(orders(spark, *rows), customers(spark), products(spark), **kwargs)


def reasons(frame):
    return {row.order_id: row.rejection_reason for row in frame.collect()}


def test_latest_version_wins_and_keeps_its_own_values(spark):
    frame = orders(
        spark,
        order(quantity="1", date="2026-08-10 09:00:00"),
        order(quantity="7", date="2026-08-12 09:00:00"),
        order("B2"),
    )
    kept = {row.order_id: row.quantity for row in cleanse.deduplicate(frame).collect()}
    assert kept == {"A1": "7", "B2": "2"}


def test_missing_date_loses_and_status_breaks_a_tie(spark):
    rows = [order(date=None), *[order(status=s) for s in ("SHIPPED", "PENDING", None)]]
    frame = orders(spark, *rows)
    assert [row.status for row in cleanse.deduplicate(frame).collect()] == ["PENDING"]


@pytest.mark.parametrize("partitions", [1, 3, 8])
def test_full_tie_is_stable_under_any_partitioning(spark, partitions):
    rows = [order(quantity=str(n)) for n in (5, 3, 9)]
    random.Random(partitions).shuffle(rows)
    kept = cleanse.deduplicate(orders(spark, *rows).repartition(partitions)).collect()
    assert [row.quantity for row in kept] == ["3"]


def test_deduplicate_agrees_with_brute_force(spark):
    rng = random.Random(11)
    rows = [
        order(
            rng.choice(["A", "B", "C", None, "D"]) if rng.random() < 0.6 else f"X{n}",
            quantity=str(rng.randint(1, 3)),
            date=rng.choice([None, GOOD, "2026-08-12 00:00:00", "zzz"]),
            status=rng.choice([None, "SHIPPED", "PENDING"]),
        )
        for n in range(400)
    ]
    best, nameless = {}, [row for row in rows if row[0] is None]
    for row in (row for row in rows if row[0] is not None):
        inverted = tuple(-ord(c) for c in row[4]) + (1,) if row[4] is not None else (2,)
        rank = (row[4] is None, inverted, row[5] is None, row[5] or "", int(row[3]))
        if row[0] not in best or rank < best[row[0]][0]:
            best[row[0]] = (rank, row)
    found = cleanse.deduplicate(orders(spark, *rows).repartition(7)).collect()
    wanted = [*(r for _, r in best.values()), *nameless]
    assert sorted(map(tuple, found), key=str) == sorted(wanted, key=str)


def test_hot_key_is_limited_before_the_shuffle(spark):
    plan = plan_of(cleanse.deduplicate(orders(spark, order())))
    exchange = plan.index("Exchange hashpartitioning(_order")
    assert "Final" in plan[:exchange] and "Partial" in plan[exchange:]


def test_clean_normalises_and_drops_nothing(spark):
    dirty = orders(
        spark,
        order("  ", " K1 ", "W1", " 4 ", "2026-02-30 10:00:00", " shipped "),
        order("B", "", "W1", "four", " 2026-08-11 09:15:00 ", ""),
        order("C", "K1", "W1", "99999999999", "2026-8-1 9:00:00", "Pending"),
    )
    rows = cleanse.clean(dirty).collect()
    assert [tuple(row) for row in rows] == [
        (None, "K1", "W1", 4, None, "SHIPPED"),
        ("B", None, "W1", None, datetime(2026, 8, 11, 9, 15), None),
        ("C", "K1", "W1", None, None, "PENDING"),
    ]


def test_one_reason_each(spark):
    frame = judged(
        spark,
        order("ok"),
        order(None),
        order("customer", ""),
        order("date", date="11/08/2026"),
        order("text", quantity="abc"),
        order("negative", quantity="-1"),
        order("zero", quantity="0"),
        order("status", status="LOST"),
        order("nostatus", status=None),
        order("who", "K9"),
        order("what", product="W9"),
        order("refund", product="W3"),
        order("gift", product="W4"),
        order("unpriced", product="W5"),
        order("huge", quantity="2000000000"),
    )
    assert reasons(frame) == {
        "ok": None,
        None: "null_order_id",
        "customer": "null_customer_id",
        "date": "malformed_order_date",
        "text": "non_numeric_quantity",
        "negative": "non_positive_quantity",
        "zero": "non_positive_quantity",
        "status": "invalid_order_status",
        "nostatus": "invalid_order_status",
        "who": "orphan_customer_id",
        "what": "orphan_product_id",
        "refund": "non_positive_price",
        "gift": "non_positive_price",
        "unpriced": "non_numeric_price",
        "huge": "order_total_out_of_range",
    }


def test_first_broken_rule_is_the_reason(spark):
    everything_wrong = order("A1", None, "W9", "abc", "never", "LOST")
    assert reasons(judged(spark, everything_wrong)) == {"A1": "null_customer_id"}
    two_wrong = order("A1", "K9", "W3", "1")
    assert reasons(judged(spark, two_wrong)) == {"A1": "orphan_customer_id"}


def test_statuses_come_from_the_contract(spark):
    frame = judged(spark, order(status="PARKED"), statuses=("PARKED",))
    assert reasons(frame) == {"A1": None}


def test_validate_splits_without_losing_a_row(spark):
    rows = [order("A"), order("B", product="W9"), order("C", quantity="x"), order("D", "K2", "W2")]
    valid, bad = cleanse.validate(
        cleanse.clean(orders(spark, *rows)), customers(spark), products(spark)
    )
    assert {r.order_id for r in valid.collect()} == {"A", "D"}
    assert reasons(bad) == {"B": "orphan_product_id", "C": "non_numeric_quantity"}
    assert valid.columns == list(cleanse.CLEAN_COLUMNS)


def test_quarantine_keeps_the_original_text(spark):
    bad = cleanse.rejected(judged(spark, order(date="soon", quantity="many")))
    row = bad.first()
    assert (row.order_date, row.raw_order_date) == (None, "soon")
    assert (row.quantity, row.raw_quantity) == (None, "many")
    assert bad.columns == QUARANTINE.fieldNames()


def test_exact_dimension_copies_do_not_multiply_orders(spark):
    twice = customers(spark).unionByName(customers(spark))
    frame = cleanse.judge_orders(orders(spark, order()), twice, products(spark))
    assert frame.count() == 1


def test_conflicting_dimension_rows_are_reported(spark):
    clash = customers(spark, ("K1", "Ada", "ada@example.com", "SE", "2024-02-01"))
    found = key_violations(
        {"customers": (clash, "customer_id"), "products": (products(spark), "product_id")}
    ).collect()
    assert [tuple(row) for row in found] == [("customers", "K1", 2)]


def test_sales_fact_layout_money_and_padded_partitions(spark):
    sales = cleanse.curated_sales(
        orders(spark, order(quantity="3", date="2026-01-05 23:59:59")),
        customers(spark),
        products(spark),
    )
    assert [(f.name, f.dataType) for f in sales.schema] == [
        (f.name, f.dataType) for f in CURATED
    ]
    row = sales.first()
    assert (row.year, row.month, row.day) == ("2026", "01", "05")
    assert row.order_total == Decimal("37.50")


def test_enrich_joins_both_dimensions(spark):
    valid = cleanse.clean(orders(spark, order()))
    row = cleanse.enrich(valid, customers(spark), products(spark)).first()
    assert (row.country, row.created_date, row.product_name, row.category, row.price) == (
        "NO",
        "2024-02-01",
        "Lamp",
        "Home",
        12.5,
    )


def test_hot_customer_is_split_when_dimensions_are_too_large_to_broadcast(spark, conf):
    """A third of all orders on one customer: AQE splits that partition, the result is whole."""
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="64KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="64KB",
    )
    n = 60000
    number = F.col("id")
    facts = spark.range(n).repartition(8).select(
        F.concat(F.lit("A"), number).alias("order_id"),
        F.when(number % 3 == 0, "K0")
        .otherwise(F.concat(F.lit("K"), number % 5000))
        .alias("customer_id"),
        F.lit("W1").alias("product_id"),
        F.lit(2).alias("quantity"),
        F.to_timestamp(F.lit(GOOD)).alias("order_date"),
        F.lit("SHIPPED").alias("status"),
    )
    people = spark.range(5000).select(
        F.concat(F.lit("K"), "id").alias("customer_id"),
        F.lit("NO").alias("country"),
        F.lit("2024-01-01").alias("created_date"),
    )
    frame = cleanse.annotate(facts, people, products(spark))
    assert "skew=true" in final_plan_of(frame)
    assert frame.where("rejection_reason IS NULL").count() == n


def test_whole_rows_are_judged_like_any_others(spark):
    odd = [
        order("A"), order("B\x1f"), order("\x1bn", customer="C9"), order("D", quantity=None),
        order(None), order("E", status=""), order("F", date="2026-13-01 00:00:00"),
        order("G", product="\x1fP"), order("H", quantity="x\x1by", customer=None),
    ]
    rows, sides = orders(spark, *odd), (customers(spark), products(spark))
    plain = cleanse.judge_orders(rows, *sides)
    whole = cleanse.judge_orders(rows, *sides, whole_rows=True)
    assert whole.schema == plain.schema and plain.count() == len(odd)
    assert sorted(map(str, whole.collect())) == sorted(map(str, plain.collect()))
