import pytest

from conftest import plan_of
from orderlake.operators import quality, schema_checks
from orderlake.operators.governance import governed_view
from orderlake.operators.keys import key_skew
from orderlake.schemas import RAW_PRODUCTS, RAW_PRODUCTS_TEXT
from pyspark.sql import functions as F


def test_rules_score_and_findings(spark):
    frame = spark.createDataFrame(
        [("1", "a", "5"), ("2", None, "0"), ("2", "b", "abc"), ("3", "c", None)],
        "order_id string, customer_id string, quantity string",
    )
    results = quality.dq_results({"orders": (frame, quality.ORDERS_RULES)})
    found = {row.rule: (row.passed, row.observed) for row in results.collect()}
    assert found == {
        'IsComplete "customer_id"': (False, 0.75),
        'Uniqueness "order_id" = 1.0': (False, 0.5),
        'ColumnValues "quantity" > 0': (False, 1.0),
    }
    score = quality.dq_score(results).first()
    assert (score.rules, score.rules_passed, score.score) == (3, 0, 0.0)


def test_all_rules_pass_on_clean_rows(spark):
    frame = spark.createDataFrame(
        [("1", "a", 5), ("2", "b", 1)], "order_id string, customer_id string, quantity int"
    )
    score = quality.dq_score(quality.dq_results({"orders": (frame, quality.ORDERS_RULES)})).first()
    assert score.score == 1.0


def test_two_of_three_rules(spark):
    frame = spark.createDataFrame(
        [("1", "a", 5), ("1", "b", 1)], "order_id string, customer_id string, quantity int"
    )
    score = quality.dq_score(quality.dq_results({"orders": (frame, quality.ORDERS_RULES)})).first()
    assert score.score == 0.67


def test_published_uniqueness_figure(spark):
    """8,339 values once and 3,761 twice are 15,861 rows and give the published share."""
    once = spark.range(8339).select(F.col("id").alias("v"))
    twice = spark.range(3761).select((F.col("id") + 10000).alias("v"))
    row = quality.uniqueness(once.union(twice).union(twice), "v").first()
    assert row.rows == 15861 and row.uniqueness == pytest.approx(0.525754996532375, abs=1e-15)


def text_products(spark):
    return spark.createDataFrame(
        [
            ("1", "a", "x", "7", "d1"),
            ("2", "b", "x", "7.5", "d2"),
            ("3", "c", "x", "UNKNOWN", "d3"),
            ("4", "d", "x", None, "d3"),
            ("5", "e", "x", "3000000000", "d4"),
            ("6", "f", "x", None, "d5"),
        ],
        "product_id string, product_name string, category string, price string, d string",
    )


def test_inference_per_delivery(spark):
    found = schema_checks.infer_schema(
        text_products(spark), F.col("d"), RAW_PRODUCTS_TEXT.fieldNames()
    ).where("column_name = 'price'")
    assert {r.delivery: r.inferred_type for r in found.collect()} == {
        "d1": "int",
        "d2": "double",
        "d3": "string",
        "d4": "bigint",
        "d5": "string",
    }


def test_inference_agrees_with_sparks_own(spark, tmp_path):
    frame = text_products(spark).where("d IN ('d1', 'd2', 'd3')")
    own = schema_checks.infer_schema(frame, F.col("d"), ["price"])
    for row in own.collect():
        path = str(tmp_path / row.delivery)
        part = frame.where(F.col("d") == row.delivery).select("price")
        part.write.option("header", True).csv(path)
        builtin = spark.read.option("header", True).option("inferSchema", True).csv(path)
        assert builtin.schema["price"].dataType.simpleString() == row.inferred_type


def test_drift_bad_tokens_and_impact(spark):
    frame = text_products(spark)
    drift = schema_checks.schema_drift(frame, RAW_PRODUCTS, F.col("d"))
    assert {r.delivery: (r.values_seen, r.misfits) for r in drift.collect()} == {
        "d1": (1, 0),
        "d2": (1, 0),
        "d3": (1, 1),
        "d4": (1, 0),
        "d5": (0, 0),
    }
    bad = schema_checks.uncastable_values(frame, RAW_PRODUCTS).collect()
    assert [(r.product_id, r.column_name, r.raw_value) for r in bad] == [("3", "price", "UNKNOWN")]
    impact = schema_checks.drift_impact(frame, "price").first()
    assert (impact.total, impact.lost_values, impact.null_values) == (3000000014.5, 1, 2)


def test_format_equality_counts_uneven_rows(spark):
    a = spark.createDataFrame([(1,), (1,), (2,)], "v int")
    b = spark.createDataFrame([(1,), (2,), (3,)], "v int")
    rows = schema_checks.format_equality({"a": a, "b": b}).collect()
    found = {r.encoding: tuple(r)[1:] for r in rows}
    assert found == {"a": (3, 2), "b": (3, 2)}
    same = schema_checks.format_equality({"a": a, "b": a.repartition(3)}).collect()
    assert all(r.rows_not_everywhere == 0 for r in same)


def test_misfiled_rows(spark):
    dates = ("2026-08-11 00:00:00", "2026-08-12 00:00:00", None)
    rows = [(date, "2026", "08", "11") for date in dates]
    frame = spark.createDataFrame(rows, "ts string, year string, month string, day string")
    row = schema_checks.partition_mismatch(frame, F.to_timestamp("ts")).first()
    assert tuple(row) == (3, 1, 1)


def test_governed_view_hides_new_columns_and_refuses_unknown_grants(spark):
    frame = spark.createDataFrame([("K1", "NO", "a@b")], ["customer_id", "country", "email"])
    governed_view(frame, ["customer_id", "country"], "v_marketing")
    governed_view(frame.withColumn("phone", F.lit("1")), ["customer_id", "country"], "v_marketing")
    assert spark.sql("SELECT * FROM v_marketing").columns == ["customer_id", "country"]
    with pytest.raises(ValueError):
        governed_view(frame, ["ssn"])


def test_key_skew(spark):
    even = key_skew(spark.range(64000).select(F.col("id").cast("string").alias("k")), "k").first()
    assert even.slices == 16 and even.skew < 1.2


def test_format_equality_tells_texts_apart_and_groups_by_their_digest(spark):
    rows = [("ab", "c", 1), ("a", "bc", 1), (None, "", 1), ("", None, 1), ("2:ab", "-", None)]
    a = spark.createDataFrame(rows, "x string, y string, n int")
    moved = [("abc", "", 1), ("", "abc", 1), ("", "", 1), (None, None, 1), ("2:ab", "-", 0)]
    b = spark.createDataFrame(moved, "x string, y string, n int")
    result = schema_checks.format_equality({"a": a, "b": b})
    assert [tuple(r)[1:] for r in result.collect()] == [(5, 5), (5, 5)]
    same = schema_checks.format_equality({"a": a, "b": a.repartition(2)}).collect()
    assert [tuple(r)[1:] for r in same] == [(5, 0), (5, 0)]
    assert "keys=[n#" in plan_of(result) and "_texts" in plan_of(result)
