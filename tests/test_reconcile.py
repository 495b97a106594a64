from cases import customers, order, orders, products
from orderlake.operators import audit, cleanse, reconcile
from orderlake.plans.job import zero_record


def counts(spark, source, deduplicated, valid, rejected, curated):
    names = ["source", "deduplicated", "valid", "rejected", "curated"]
    values = [source, deduplicated, valid, rejected, curated]
    frame = spark.createDataFrame([values], [f"{n}_rows" for n in names])
    return reconcile.balance(frame).first()


def test_balanced_lossy_unwritten(spark):
    good = counts(spark, 10, 8, 6, 2, 6)
    assert good.balanced and good.duplicates_removed == 2 and good.every_source_row_explained
    lossy = counts(spark, 10, 8, 5, 2, 5)
    assert not lossy.accounted_for and not lossy.balanced
    unwritten = counts(spark, 10, 8, 6, 2, 5)
    assert unwritten.accounted_for and not unwritten.curated_matches_valid
    assert not unwritten.balanced


def test_a_run_without_rows_balances(spark):
    record = zero_record(spark).first()
    assert record.balanced and record.source_rows == 0


def test_dirty_feed_end_to_end(spark):
    feed = orders(
        spark,
        order("A"),
        order("B", None),
        order("C", quantity="1", date="2026-08-10 00:00:00", status="LOST"),
        order("C", quantity="-5"),
        order("D", product="W3"),
    )
    judged = cleanse.judge_orders(feed, customers(spark), products(spark))
    sales = cleanse.transform(cleanse.accepted(judged))
    record = reconcile.reconcile(feed, judged, sales).first()
    assert record.asDict() == {
        "source_rows": 5,
        "duplicates_removed": 1,
        "deduplicated_rows": 4,
        "valid_rows": 1,
        "rejected_rows": 3,
        "curated_rows": 1,
        "accounted_for": True,
        "curated_matches_valid": True,
        "every_source_row_explained": True,
        "balanced": True,
    }


def test_every_missing_id_counts_and_blanks_around_ids_do_not(spark):
    feed = orders(spark, order(None), order(None, quantity="9"), order(" "), order("A"), order("A "))
    found = reconcile.source_counts(feed).first()
    assert (found.source_rows, found.deduplicated_rows) == (5, 4)


def test_a_repeated_dimension_key_breaks_the_balance(spark):
    clash = customers(spark, ("K1", "Ada", "ada@example.com", "SE", "2024-02-01"))
    feed = orders(spark, order())
    judged = cleanse.judge_orders(feed, clash, products(spark))
    record = reconcile.reconcile(feed, judged, cleanse.transform(cleanse.accepted(judged)))
    assert not record.first().balanced


def test_ground_truth_shows_missing_and_unexpected(spark):
    truth = spark.createDataFrame([("x", "1"), ("x", "2"), ("y", "3")], ["defect", "order_id"])
    rejects = spark.createDataFrame(
        [("1", "x"), ("9", "x"), ("3", "y"), ("4", "unplanned")], ["order_id", "rejection_reason"]
    )
    found = {r.defect: tuple(r)[1:] for r in audit.ground_truth_diff(truth, rejects).collect()}
    assert found == {"x": (2, 2, 1, 1), "y": (1, 1, 0, 0)}


def test_orphan_policies(spark):
    feed = orders(spark, order("A", quantity="2"), order("B", product="W9"))
    found = {r.policy: r for r in audit.orphan_policy_compare(feed, products(spark)).collect()}
    assert (found["inner_join"].rows_kept, found["inner_join"].rows_set_aside) == (1, 0)
    assert (found["left_join"].rows_kept, found["left_join"].rows_without_product) == (2, 1)
    assert (found["split"].rows_kept, found["split"].rows_set_aside) == (1, 1)
    assert {r.revenue for r in found.values()} == {25.0}
