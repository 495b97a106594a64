import datetime as dt
from pathlib import Path

import __spark_entry__ as entry_point
from conftest import SF_DIR, plan_of
from orderlake.plans.job import run_curated_sales
from orderlake.plans.lake import Lake
from orderlake.sinks import layout, writers
from orderlake.sources.feed import feed_orders
from orderlake.sources.readers import scan_partitioned


def written(spark, monkeypatch, names):
    """The formats and raw tables that queries write on a lake of their own."""
    found = []
    real_tree, real_flat = writers.write_partitioned, writers.write_flat

    def tree(frame, path, **options):
        found.append(options.get("fmt", "parquet"))
        real_tree(frame, path, **options)

    def flat(frame, path, **options):
        found.append(("flat", options.get("fmt", "parquet"), Path(path).name))
        real_flat(frame, path, **options)

    monkeypatch.setattr(writers, "write_partitioned", tree)
    monkeypatch.setattr(writers, "write_flat", flat)
    monkeypatch.setattr("orderlake.plans.lake.write_flat", flat)
    lake = Lake(spark, SF_DIR)
    for name in names:
        entry_point._REGISTRY[name](lake).count()
    return found


def test_a_query_writes_only_the_encoding_it_reads(spark, monkeypatch):
    assert written(spark, monkeypatch, ["dq_results", "dq_score"]) == ["csv"]
    assert written(spark, monkeypatch, ["status_totals_one_day", "units_total"]) == ["parquet"]
    assert written(spark, monkeypatch, ["scan_parquet"]) == [("flat", "parquet", "orders")]


def test_extract_writes_each_of_its_tables_once(spark, monkeypatch):
    assert written(spark, monkeypatch, ["extract"]) == [
        ("flat", "csv", "customers"), ("flat", "csv", "products"), "csv",
    ]


def test_all_encodings_come_from_one_flat_copy(spark, monkeypatch):
    found = written(spark, monkeypatch, ["write_formats", "scan_json"])
    assert found == [("flat", "parquet", "orders"), "csv", "json", "parquet"]


def test_json_is_compressed(spark):
    lake = Lake(spark, SF_DIR)
    files = [p.name for p in Path(lake.one_format("json")).rglob("part-*")]
    assert files and all(name.endswith(".json.gz") for name in files)


def test_the_feed_shuffles_only_what_it_needs(spark):
    lines = plan_of(feed_orders(spark, SF_DIR)).splitlines()
    below_join = [line for line in lines if "Project [l_orderkey#" in line]
    assert below_join and all(" AS late#" in line for line in below_join)


def test_reconcile_goes_through_the_feed_once(spark):
    lake = Lake(spark, SF_DIR)
    assert "l_orderkey" not in plan_of(entry_point._REGISTRY["reconcile"](lake))
    assert lake.landed_orders.exceptAll(lake.feed.orders).isEmpty()
    assert lake.landed_orders.count() == lake.feed.orders.count()
    assert all(".zstd." in name for name in lake.landed_orders.inputFiles())


def test_all_that_is_stored_comes_from_one_run_of_the_feed(spark, monkeypatch):
    """Of the raw orders' encodings and layouts, only the day tree shuffles whole rows."""
    found = {}

    def noted(real):
        def write(frame, path, **options):
            kind = Path(path).name
            found[Path(path).parent.name if kind == "orders" else kind] = (
                "l_orderkey" in plan_of(frame), options.get("arranged", False)
            )
            real(frame, path, **options)

        return write

    monkeypatch.setattr(writers, "write_flat", noted(writers.write_flat))
    for module in (writers, layout):
        monkeypatch.setattr(module, "write_partitioned", noted(module.write_partitioned))
    lake = Lake(spark, SF_DIR)
    real_run, sources = run_curated_sales, []

    def run(orders, *others, **options):
        sources.append(("l_orderkey" in plan_of(orders), options.get("landed", False)))
        return real_run(orders, *others, **options)

    monkeypatch.setattr("orderlake.plans.lake.run_curated_sales", run)
    rows = {r.dataset: r for r in entry_point._REGISTRY["layout_stats"](lake).collect()}
    from_tree = dict.fromkeys(("hourly", "csv", "json", "parquet"), (False, True))
    fact = found.pop("sales")
    assert found == {"parquet_flat": (True, False), "daily": (False, False), **from_tree}
    assert fact == (False, False) and sources == [(False, True)]
    raw = lake.raw_orders
    for name in ("csv", "json", "parquet"):
        back = scan_partitioned(spark, lake.formats[name], name)
        assert back.exceptAll(raw).isEmpty() and raw.exceptAll(back).isEmpty()
        assert rows[name].rows == raw.count() and rows[name].partitions == 42
    assert rows["hourly"].rows == raw.count() and rows["daily"].partitions == 42
    assert all(p.name.endswith(".csv.gz") for p in Path(lake.formats["csv"]).rglob("part-*"))


def test_formats_written_one_by_one_are_not_written_again(spark, monkeypatch):
    found = written(spark, monkeypatch, ["scan_json", "write_formats"])
    assert [name for name in found if isinstance(name, str)] == ["json", "csv", "parquet"]
    assert written(spark, monkeypatch, ["write_formats", "layout_daily_hourly"])[-3:] == [
        "csv", "json", "parquet",
    ]


def test_a_line_without_day_or_marks_is_a_line_of_the_feed(spark, tmp_path):
    lines = [
        (11, 1, 1, 1, 5.0, "R", "O", "1998-01-02"), (11, 1, 1, 2, None, None, "F", "1998-01-03"),
        (12, 1, 1, 1, 5.0, "R", "F", None), (12, 1, 10, 2, 5.0, "N", None, "1969-12-31"),
    ]
    names = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double,"
    shape = f"{names} l_returnflag string, l_linestatus string, l_shipdate string"
    spark.createDataFrame(lines, shape).write.parquet(f"{tmp_path}/lineitem.parquet")
    heads = spark.createDataFrame(
        [(11, 7, "O"), (12, 8, None)], "o_orderkey long, o_custkey long, o_orderstatus string"
    )
    heads.write.parquet(f"{tmp_path}/orders.parquet")
    days = [dt.date(2026, 7, 9) + dt.timedelta((dt.date(*d) - dt.date(1970, 1, 1)).days % 42) for d in ((1998, 1, 2), (1998, 1, 3), (1969, 12, 31))]
    found = feed_orders(spark, str(tmp_path)).orderBy("order_id").collect()
    assert [r.status for r in found] == ["RETURNED", "DELIVERED", "RETURNED", "SHIPPED"]
    assert [r.quantity for r in found] == ["5", None, "5", "5"]
    assert [(r.year, r.month, r.day) for r in found] == [
        *[tuple(f"{day:%Y-%m-%d}".split("-")) for day in days[:2]], (None, None, None), tuple(f"{days[2]:%Y-%m-%d}".split("-")),
    ]
    assert found[2].delivery == 2 and found[3].delivery == 3
