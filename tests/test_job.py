"""The wiring of the jobs: batch run, incremental run, replay, refusal."""

import os
import shutil

import pytest
from pyspark.sql import functions as F

from cases import customers, order, orders, products
from orderlake import schemas
from orderlake.contract import Contract
from orderlake.plans import job
from orderlake.plans.job import LakePaths, ReconciliationError, run_curated_sales
from orderlake.session import path_exists, scratch
from orderlake.sinks.writers import write_flat
from orderlake.sources.readers import read_curated
from orderlake.streaming.incremental import run_incremental


@pytest.fixture()
def paths(spark, tmp_path):
    return LakePaths.below(spark, str(tmp_path / "lake"))


def run(spark, paths, run_id, *rows, merge=True, **kwargs):
    feed = orders(spark, *rows)
    dims = customers(spark), products(spark)
    return run_curated_sales(feed, *dims, paths, run_id, merge=merge, **kwargs)


def quantities(spark, paths):
    rows = read_curated(spark, paths.curated).collect()
    assert len({row.order_id for row in rows}) == len(rows)
    return {row.order_id: (row.day, row.quantity) for row in rows}


def rejects(spark, paths):
    frame = spark.read.schema(schemas.QUARANTINE_RUNS).parquet(paths.quarantine)
    return sorted((row.run_id, row.order_id) for row in frame.collect())


def test_batch_run_publishes_and_records(spark, paths):
    report = run(spark, paths, "r1", order("A"), order("B", quantity="x"), merge=False)
    assert report["balanced"] and report["valid_rows"] == 1 and report["rejected_rows"] == 1
    assert quantities(spark, paths) == {"A": ("11", 2)}
    assert rejects(spark, paths) == [("r1", "B")]
    ledger = spark.read.parquet(paths.ledger).first()
    assert ledger.run_id == "r1" and ledger.source_rows == 2
    assert not path_exists(spark, f"{paths.work}/r1")


def test_full_run_leaves_nothing_of_an_earlier_one(spark, paths):
    run(spark, paths, "r1", order("A"), order("B", date="2026-08-12 01:00:00"), merge=False)
    moved = order("A", date="2026-08-12 01:00:00")
    report = run(spark, paths, "r2", moved, order("C", date="2026-08-12 02:00:00"), merge=False)
    rows = read_curated(spark, paths.curated).select("order_id", "day").collect()
    assert sorted(map(tuple, rows)) == [("A", "12"), ("C", "12")] and report["curated_rows"] == 2
    run(spark, paths, "r3", merge=False)
    assert read_curated(spark, paths.curated).count() == 0


def test_rows_without_id_all_go_to_quarantine(spark, paths):
    rows = [order(None), order(None), order("  "), order(None, quantity="9"), order("")]
    for merge in (False, True):
        report = run(spark, paths, f"r{merge}", *rows, order("A"), merge=merge)
        assert (report["duplicates_removed"], report["rejected_rows"]) == (0, 5)
        kept = spark.read.parquet(paths.quarantine).where(f"run_id = 'r{merge}'")
        assert [r.rejection_reason for r in kept.collect()] == ["null_order_id"] * 5


@pytest.mark.parametrize("merge", [False, True])
def test_one_order_in_two_spellings_is_one_sale(spark, paths, merge):
    rows = [order("A", quantity="1"), order(" A ", quantity="2", date="2026-08-12 00:00:00")]
    run(spark, paths, "r0", order("B"), merge=merge)
    report = run(spark, paths, "r1", *rows, order("B"), merge=merge)
    assert quantities(spark, paths)["A"] == ("12", 2) and report["duplicates_removed"] == 1
    assert read_curated(spark, paths.curated).count() == 2 == report["curated_rows"]


@pytest.mark.parametrize("merge", [False, True])
def test_a_lost_row_is_noticed_after_publishing(spark, paths, monkeypatch, merge):
    run(spark, paths, "r0", order("A"), merge=merge)
    write = job.write_curated
    monkeypatch.setattr(
        job, "write_curated", lambda sales, *args, **kw: write(sales.where("order_id <> 'C'"), *args, **kw)
    )
    with pytest.raises(ReconciliationError, match="does not hold"):
        run(spark, paths, "r1", order("B"), order("C"), merge=merge)
    record = spark.read.parquet(paths.ledger).where("run_id = 'r1'").first()
    assert not record.curated_matches_valid and record.valid_rows == 2 and record.curated_rows == 1


def test_a_replay_without_rejects_clears_the_earlier_ones(spark, paths):
    run(spark, paths, "r1", order("A", "K9"))
    assert spark.read.parquet(paths.quarantine).where("run_id = 'r1'").count() == 1
    known = customers(spark, ("K9", "Ida", "ida@example.com", "FI", "2024-02-01"))
    run_curated_sales(orders(spark, order("A", "K9")), known, products(spark), paths, "r1")
    assert set(quantities(spark, paths)) == {"A"}
    assert not path_exists(spark, f"{paths.quarantine}/run_id=r1")


def test_similar_lake_names_do_not_share_a_work_folder(spark):
    below = [LakePaths.below(spark, root).work for root in ("s3a://lake/a-b", "s3a://lake-a/b")]
    assert below[0] != below[1]


def test_the_source_is_scanned_once(spark, paths, tmp_path):
    orders(spark, order("A"), order("B")).write.option("header", True).csv(f"{tmp_path}/raw")
    source = spark.read.schema(schemas.RAW_ORDERS).option("header", True).csv(f"{tmp_path}/raw")
    run_curated_sales(source, customers(spark), products(spark), paths, "r1")
    shutil.rmtree(f"{tmp_path}/raw")  # everything after the landing works without it
    judged = job.judge_orders
    seen = []

    def spy(frame, *args, **kw):
        seen.extend(frame.inputFiles())
        return judged(frame, *args, **kw)

    orders(spark, order("A")).write.option("header", True).csv(f"{tmp_path}/raw2")
    source = spark.read.schema(schemas.RAW_ORDERS).option("header", True).csv(f"{tmp_path}/raw2")
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(job, "judge_orders", spy)
        run_curated_sales(source, customers(spark), products(spark), paths, "r2")
    assert seen and not any("/raw2/" in name for name in seen)


def test_a_frame_without_columns_is_a_successful_run(spark, paths):
    empty = spark.createDataFrame([], schemas.T.StructType([]))
    report = run_curated_sales(empty, customers(spark), products(spark), paths, "r0")
    assert report["balanced"] and report["source_rows"] == 0
    assert not path_exists(spark, paths.curated)
    assert spark.read.parquet(paths.ledger).count() == 1


def test_no_rows_and_no_rejects_write_nothing(spark, paths):
    report = run(spark, paths, "r0")
    assert report["balanced"]
    assert not path_exists(spark, paths.curated) and not path_exists(spark, paths.quarantine)


def test_an_unbalanced_run_is_refused_before_publishing_and_can_be_repaired(spark, paths):
    clash = customers(spark, ("K1", "Ada", "ada@example.com", "SE", "2024-02-01"))
    with pytest.raises(ReconciliationError):
        run_curated_sales(orders(spark, order()), clash, products(spark), paths, "r1")
    assert not path_exists(spark, paths.curated) and not path_exists(spark, paths.ledger)
    run(spark, paths, "r1", order())
    assert set(quantities(spark, paths)) == {"A1"}


def test_late_rows_join_their_day_instead_of_replacing_it(spark, paths):
    run(spark, paths, "r1", order("A"), order("B"))
    run(spark, paths, "r2", order("C"))
    assert set(quantities(spark, paths)) == {"A", "B", "C"}


def test_a_newer_version_moves_its_order_to_another_day(spark, paths):
    run(spark, paths, "r1", order("A"), order("B"))
    run(spark, paths, "r2", order("A", quantity="5", date="2026-08-20 00:00:00"))
    assert quantities(spark, paths) == {"A": ("20", 5), "B": ("11", 2)}


def test_an_older_version_changes_nothing(spark, paths):
    run(spark, paths, "r1", order("A"))
    run(spark, paths, "r2", order("A", quantity="5", date="2026-08-01 00:00:00"))
    assert quantities(spark, paths) == {"A": ("11", 2)}


def test_a_day_whose_last_order_moved_away_disappears(spark, paths):
    run(spark, paths, "r1", order("A"))
    run(spark, paths, "r2", order("A", date="2026-08-20 00:00:00"))
    assert quantities(spark, paths) == {"A": ("20", 2)}
    assert not path_exists(spark, f"{paths.curated}/year=2026/month=08/day=11")


def test_quarantine_keeps_earlier_runs_and_replay_adds_nothing(spark, paths):
    run(spark, paths, "r1", order("A"), order("X", quantity="x"))
    for _ in range(2):
        run(spark, paths, "r2", order("B"), order("Y", quantity="y"))
    assert rejects(spark, paths) == [("r1", "X"), ("r2", "Y")]
    assert set(quantities(spark, paths)) == {"A", "B"}
    assert spark.read.parquet(paths.ledger).count() == 2


def test_replay_after_a_crash_while_publishing_restores_the_replaced_day(spark, paths, monkeypatch):
    """The publishing step dies after deleting a day; the redo copy brings all of it back."""
    run(spark, paths, "r1", order("A"), order("B"))
    publish = job.write_curated

    def die(frame, path, **kwargs):
        job.discard(spark, f"{path}/year=2026/month=08/day=11")
        raise OSError("executor storage went away")

    monkeypatch.setattr(job, "write_curated", die)
    with pytest.raises(OSError):
        run(spark, paths, "r2", order("C"))
    monkeypatch.setattr(job, "write_curated", publish)
    assert path_exists(spark, f"{paths.redo}/r2/merged/_SUCCESS")
    run(spark, paths, "r2", order("C"))
    assert set(quantities(spark, paths)) == {"A", "B", "C"}
    assert not path_exists(spark, f"{paths.redo}/r2")


def test_intermediate_tables_go_where_the_cluster_says(spark, monkeypatch):
    for module in ("orderlake.session", "orderlake.plans.job"):
        monkeypatch.setattr(f"{module}.shared_folder", lambda _: "hdfs:///shared")
    assert LakePaths.below(spark, "s3a://lake").work.startswith("hdfs:///shared/orderlake/")
    assert scratch(spark, "x").startswith("hdfs:///shared/orderlake/x-")


def test_contract_rules_reach_the_run(spark, paths):
    report = run(
        spark, paths, "r1", order(status="PARKED"), contract=Contract(valid_statuses=("PARKED",))
    )
    assert report["valid_rows"] == 1


def test_another_partitioning_of_the_contract(spark, paths):
    monthly = Contract(partition_by=("year", "month"))
    run(spark, paths, "r1", order("A"), order("B"), contract=monthly)
    run(spark, paths, "r2", order("A", quantity="5", date="2026-09-01 00:00:00"), contract=monthly)
    rows = read_curated(spark, paths.curated, monthly.partition_by).collect()
    assert {(r.order_id, r.month, r.quantity) for r in rows} == {("A", "09", 5), ("B", "08", 2)}


def test_incremental_reads_each_file_once_and_dimensions_in_full(spark, paths, tmp_path):
    source, checkpoint = str(tmp_path / "in"), str(tmp_path / "checkpoint")

    def arrive(name, *rows):
        write_flat(orders(spark, *rows), f"{source}/{name}", fmt="csv")

    def go():
        return run_incremental(spark, source, customers, products, paths, checkpoint)

    arrive("one", order("A"), order("B", quantity="x"))
    spark.createDataFrame([("ignored",)], ["value"]).write.text(f"{source}/notes")
    assert go() == 2
    arrive("two", order("A", quantity="8", date="2026-08-12 00:00:00"))
    assert go() == 1
    assert go() == 0
    assert quantities(spark, paths) == {"A": ("12", 8)}
    assert [order_id for _, order_id in rejects(spark, paths)] == ["B"]
    ledger = spark.read.parquet(paths.ledger).agg(F.sum("source_rows"), F.count("*")).first()
    assert tuple(ledger) == (3, 2)


def test_a_second_stream_replaces_nothing_of_the_first(spark, paths, tmp_path):
    for number, key in ((1, "K8"), (2, "K9")):
        source = str(tmp_path / f"in{number}")
        write_flat(orders(spark, order(f"A{number}", key)), f"{source}/x", fmt="csv")
        checkpoint = str(tmp_path / f"checkpoint{number}")
        assert run_incremental(spark, source, customers, products, paths, checkpoint) == 1
    assert sorted(key for _, key in rejects(spark, paths)) == ["A1", "A2"]
    assert spark.read.parquet(paths.ledger).select("run_id").distinct().count() == 2


def test_handled_files_move_to_the_archive(spark, paths, tmp_path):
    source, archive = tmp_path / "in", tmp_path / "archive"
    for name in ("x", "y", "z"):
        write_flat(orders(spark, order(name)), str(source / name), fmt="csv")
        run_incremental(
            spark, str(source), customers, products, paths, str(tmp_path / "checkpoint"),
            archive=str(archive),
        )
    assert set(quantities(spark, paths)) == {"x", "y", "z"}
    assert list(archive.rglob("*.csv"))


def test_a_file_with_an_old_timestamp_is_not_skipped(spark, paths, tmp_path):
    source, checkpoint = tmp_path / "in", str(tmp_path / "checkpoint")

    def go():
        return run_incremental(spark, str(source), customers, products, paths, checkpoint)

    write_flat(orders(spark, order("A")), str(source / "new"), fmt="csv")
    assert go() == 1
    write_flat(orders(spark, order("B")), str(source / "old"), fmt="csv")
    for file in (source / "old").glob("*.csv"):
        os.utime(file, (0, 0))
    assert go() == 1
    assert set(quantities(spark, paths)) == {"A", "B"}


def test_schemaless_orders_fail_outside_the_guard(spark):
    from orderlake.operators.cleanse import deduplicate

    with pytest.raises(Exception):
        deduplicate(spark.createDataFrame([], schemas.T.StructType([]))).collect()


def raw_lake(spark, root):
    from orderlake.sinks.writers import write_flat

    write_flat(customers(spark), f"{root}/raw/customers", fmt="csv")
    write_flat(products(spark), f"{root}/raw/products", fmt="csv")
    feed = orders(spark, order("A"), order("B", product="W9"))
    write_flat(feed, f"{root}/raw/orders/d1", fmt="csv")


def test_command_line_full_run_from_the_catalog(spark, tmp_path):
    from orderlake.jobs.curated_sales import RAW_SCHEMAS, main
    from orderlake.sources.catalog import register_raw_csv

    root = str(tmp_path)
    raw_lake(spark, root)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS cli_raw LOCATION '{root}/db'")
    for name, schema in RAW_SCHEMAS.items():
        folder = "orders/d1" if name == "orders" else name
        register_raw_csv(spark, f"cli_raw.{name}_raw", f"{root}/raw/{folder}", schema)
    (tmp_path / "contract.json").write_text('{"curated": {"sales": {"prefix": "gold/sales"}}}')
    options = ["--lake", root, "--database", "cli_raw", "--run-id", "x"]
    report = main([*options, "--contract", f"{root}/contract.json"], spark)
    assert (report["valid_rows"], report["rejected_rows"]) == (1, 1)
    assert read_curated(spark, f"{root}/gold/sales").count() == 1


def test_command_line_incremental_run(spark, tmp_path):
    from orderlake.jobs.curated_sales import main

    root = str(tmp_path)
    raw_lake(spark, root)
    report = main(["--lake", root], spark)
    assert (report["source_rows"], report["valid_rows"]) == (2, 1)
    assert main(["--lake", root, "--incremental"], spark) == 2
    assert main(["--lake", root, "--incremental"], spark) == 0
    assert read_curated(spark, f"{root}/curated/sales").count() == 1


def staged_files(path):
    return sorted(
        name for _, _, files in os.walk(path) for name in files if name.endswith(".parquet")
    )


def test_staged_tables_are_small_and_keep_rejected_text(spark, paths, monkeypatch):
    monkeypatch.setattr(job, "discard", lambda *_: None)
    rows = [
        order("A"),
        order("B", quantity=" 3", customer="K9"),
        order("C", quantity="3", customer="K9"),
        order("D", date="11/08/2026", quantity=None),
        order("E", date=None, quantity="x"),
    ]
    assert run(spark, paths, "r1", *rows, merge=False)["balanced"]
    found = staged_files(f"{paths.work}/r1")
    assert found and all(".zstd." in name for name in found)
    kept = spark.read.schema(schemas.QUARANTINE_RUNS).parquet(paths.quarantine).collect()
    assert {r.order_id: (r.raw_order_date, r.raw_quantity) for r in kept} == {
        "B": ("2026-08-11 09:15:00", " 3"),
        "C": ("2026-08-11 09:15:00", "3"),
        "D": ("11/08/2026", None),
        "E": (None, "x"),
    }


def test_a_delivery_is_landed_once(spark, paths, tmp_path, monkeypatch):
    monkeypatch.setattr(job, "discard", lambda *_: None)
    write_flat(orders(spark, order("A"), order("B")), str(tmp_path / "raw"), fmt="csv")
    args = str(tmp_path / "raw"), customers, products, paths, str(tmp_path / "checkpoint")
    assert run_incremental(spark, *args) == 2
    (run_id,) = os.listdir(paths.work)
    assert sorted(os.listdir(f"{paths.work}/{run_id}")) == ["judged", "landed"]
    assert quantities(spark, paths) == {"A": ("11", 2), "B": ("11", 2)}
