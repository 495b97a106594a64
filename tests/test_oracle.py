"""Every registered query against its DuckDB twin."""

import pytest

import __spark_entry__ as entry_point
from conftest import SF_DIR, plan_of
from tools.check_oracle import compare, duck

ORACLE = entry_point.oracle_sql()
# The library's own queries; those of the text operators have tests of their own.
NAMES = list(entry_point._REGISTRY)


@pytest.fixture(scope="module")
def connection():
    return duck(SF_DIR)


def test_every_statement_belongs_to_a_query():
    assert set(ORACLE) <= set(entry_point.queries())
    assert set(NAMES) <= set(ORACLE)


# Type names of both engines for the result columns.
TYPE_NAMES = {
    "BIGINT": "bigint",
    "INTEGER": "int",
    "SMALLINT": "smallint",
    "VARCHAR": "string",
    "DOUBLE": "double",
    "BOOLEAN": "boolean",
}


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_its_twin(spark, connection, name):
    frame = entry_point.queries()[name](spark, SF_DIR)
    if name in ORACLE:
        assert compare(frame, connection, ORACLE[name]) == "ok"
        described = connection.execute(f"DESCRIBE ({ORACLE[name]})").fetchall()
        wanted = {row[0]: TYPE_NAMES[row[1]] for row in described}
        assert {f.name: f.dataType.simpleString() for f in frame.schema} == wanted
    else:
        assert frame.count() > 0


JOINING = (
    "curated_sales",
    "enrich",
    "ground_truth_diff",
    "join_curated_to_raw_customers",
    "orphan_profile",
    "raw_revenue_by_country",
    "revenue_by_country",
    "star_join_all_dimensions",
)


@pytest.mark.parametrize("name", JOINING)
def test_joins_are_right_when_no_side_may_be_broadcast(spark, connection, conf, name):
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
    )
    frame = entry_point.queries()[name](spark, SF_DIR)
    assert "BroadcastHashJoin" not in plan_of(frame)
    assert compare(frame, connection, ORACLE[name]) == "ok"


@pytest.mark.parametrize("name", ["clean", "curated_sales", "drift_impact", "infer_schema"])
def test_tolerant_reading_does_not_depend_on_ansi_mode(spark, connection, conf, name):
    conf(spark__sql__ansi__enabled="false")
    frame = entry_point.queries()[name](spark, SF_DIR)
    assert compare(frame, connection, ORACLE[name]) == "ok"


def test_flagship(spark):
    frame = entry_point.entry(spark)
    assert frame.columns == ["category", "orders", "revenue", "avg_order"]
    assert frame.count() > 0
