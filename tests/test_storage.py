"""Sources, sinks and layout jobs on real files."""

import itertools

import pytest
from pyspark.sql import functions as F

from cases import order, orders
from conftest import plan_of
from orderlake import schemas
from orderlake.operators.schema_checks import header_leak
from orderlake.sinks import layout, tables, writers
from orderlake.sources import admission, readers


def files(path, suffix):
    return sorted(p for p in path.rglob(f"*{suffix}") if not p.name.startswith((".", "_")))


def dated(spark, n, day="05"):
    number = F.col("id")
    return spark.range(n).select(
        F.concat(F.lit("A"), number).alias("order_id"),
        F.sha2(number.cast("string"), 512).alias("note"),
        F.lit("2026").alias("year"),
        F.lit("01").alias("month"),
        F.when(number % 3 == 0, day)
        .otherwise(F.lpad((number % 20 + 1).cast("string"), 2, "0"))
        .alias("day"),
    )


def test_header_is_no_data_unless_it_is_read_as_such(spark, tmp_path):
    path = str(tmp_path / "orders")
    writers.write_flat(orders(spark, order("A"), order("B")).coalesce(1), path, fmt="csv")
    good = readers.scan_csv(spark, path, schemas.RAW_ORDERS)
    assert header_leak(good, "order_id").first().header_rows == 0
    leaky = readers.scan_csv(spark, path, schemas.RAW_ORDERS, header=False)
    assert header_leak(leaky, "order_id").first().asDict() == {
        "total_rows": 3,
        "distinct_ids": 3,
        "header_rows": 1,
    }


def test_partition_values_stay_padded_text(spark, tmp_path):
    writers.write_partitioned(dated(spark, 30), str(tmp_path))
    schema = dated(spark, 1).schema
    back = readers.scan_partitioned(spark, str(tmp_path), schema=schema)
    assert {r.month for r in back.collect()} == {"01"}
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, dated(spark, 30).collect()))


def test_a_hot_day_is_written_by_several_tasks(spark, tmp_path, conf):
    """A third of the rows on one day: rebalancing spreads it over tasks by its size."""
    conf(spark__sql__adaptive__advisoryPartitionSizeInBytes="256KB")
    frame = dated(spark, 60000).repartition(8)
    writers.write_partitioned(frame, str(tmp_path))
    hot = files(tmp_path / "year=2026/month=01/day=05", ".parquet")
    other = files(tmp_path / "year=2026/month=01/day=09", ".parquet")
    assert len(hot) > 1 and len(hot) > len(other)
    assert spark.read.parquet(str(tmp_path)).count() == 60000


def test_small_partitions_become_one_file_each(spark, tmp_path):
    writers.write_partitioned(dated(spark, 3000).repartition(8), str(tmp_path))
    assert len(files(tmp_path, ".parquet")) == 20


def test_stage_refuses_files_of_another_type(spark, tmp_path):
    wrong = spark.createDataFrame([], schemas.CURATED_FILE).withColumn(
        "price", F.col("price").cast("decimal(12,2)")
    )
    wrong.write.parquet(str(tmp_path / "wrong"))
    with pytest.raises(TypeError, match="price"):
        readers.stage_sales(spark, str(tmp_path / "wrong"))


def test_only_admissible_files(spark, tmp_path):
    root = str(tmp_path)
    good = orders(spark, order("A"))
    for folder in ("raw/orders/d1", "curated/orders/d1"):
        writers.write_flat(good, f"{root}/{folder}", fmt="csv")
    good.write.json(f"{root}/raw/orders/d2")
    (tmp_path / "raw/orders/d3").mkdir(parents=True)
    (tmp_path / "raw/orders/d3/empty.csv").touch()
    listed = admission.arrivals(spark, root, "raw/orders/").where("admitted")
    # Spark writes one file per non-empty partition, and possibly header-only ones.
    assert all("/raw/orders/d1/" in r.path and r.path.endswith(".csv") for r in listed.collect())
    assert listed.count() >= 1
    rows = admission.read_admitted(spark, root, schemas.RAW_ORDERS, "raw/orders/")
    assert [r.order_id for r in rows.collect()] == ["A"]


def test_file_counts_compaction_and_statistics(spark, tmp_path):
    frame = dated(spark, 2000)
    paths = layout.write_file_counts(frame, str(tmp_path / "counts"), files=40)
    many = files(tmp_path / "counts/many_files", ".parquet")
    few = files(tmp_path / "counts/one_file", ".parquet")
    assert len(many) == 40 and len(few) == 1
    for n in range(3):
        frame.where(F.crc32("order_id") % 3 == n).write.mode("append").partitionBy(
            "year", "month", "day"
        ).parquet(str(tmp_path / "small"))
    before = files(tmp_path / "small", ".parquet")
    back = layout.compact(spark, str(tmp_path / "small"), str(tmp_path / "big"), frame.schema)
    assert len(files(tmp_path / "big", ".parquet")) == 20 < len(before)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, frame.collect()))
    stats = {
        r.dataset: r
        for r in layout.layout_stats(
            {
                "many": (spark.read.parquet(paths["many_files"]), paths["many_files"]),
                "big": (back, str(tmp_path / "big")),
            }
        ).collect()
    }
    assert (stats["many"].files, stats["many"].rows, stats["many"].partitions) == (40, 2000, 1)
    assert stats["many"].bytes == sum(p.stat().st_size for p in many)
    assert (stats["big"].files, stats["big"].partitions) == (20, 20)


def test_publish_table_recovers_partitions_and_statistics(spark, tmp_path):
    frame = dated(spark, 500)
    writers.write_partitioned(frame, str(tmp_path))
    table = tables.publish_table(
        spark, "t_published", str(tmp_path), frame.schema, partition_by=("year", "month", "day")
    )
    assert table.count() == 500
    assert spark.sql("SHOW PARTITIONS t_published").count() == 20
    detail = {r.col_name: r.data_type for r in spark.sql("DESCRIBE EXTENDED t_published").collect()}
    assert "500 rows" in detail["Statistics"]
    column = spark.sql("DESCRIBE EXTENDED t_published order_id").collect()
    assert ("distinct_count", "NULL") not in [(r.info_name, r.info_value) for r in column]


def test_materialise_replaces_an_older_summary(spark, tmp_path):
    path = str(tmp_path / "summary")
    tables.materialise(spark.range(3), "t_summary", path)
    assert tables.materialise(spark.range(5), "t_summary", path).count() == 5


def test_the_prefix_counts_from_the_root_and_may_hold_a_space(spark, tmp_path):
    root = str(tmp_path)
    for folder, name in (("raw/my orders", "A"), ("curated/raw/my orders", "B"), ("raw/my orders2", "C")):
        writers.write_flat(orders(spark, order(name)), f"{root}/{folder}/x+1", fmt="csv")
    rows = admission.read_admitted(spark, root, schemas.RAW_ORDERS, "raw/my orders")
    assert [r.order_id for r in rows.collect()] == ["A"]
    listed = admission.arrivals(spark, root, "raw/my orders").where("admitted").collect()
    assert listed and all("/raw/my orders/" in r.path for r in listed)
    assert not [r for r in listed if "/curated/" in r.path]


def test_a_file_without_rows_is_a_file(spark, tmp_path):
    path = f"{tmp_path}/csv"
    frame = spark.range(1).repartition(1)
    frame.write.option("header", True).csv(path)
    frame.where("false").write.mode("append").option("header", True).csv(path)
    rows = spark.read.option("header", True).csv(path)
    found = layout.layout_stats({"csv": (rows, path)}).first()
    assert (found["files"], found["rows"]) == (2, 1)


def shuffle_files(spark):
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    found = blocks.getAllFiles()
    return {found.apply(k).getName() for k in range(found.size())}


def test_a_write_leaves_no_shuffle_files_and_no_settings(spark, tmp_path):
    names = (*writers.WRITE_SETTINGS, *writers.TREE_SETTINGS)
    before, files_before = [spark.conf.get(name) for name in names], shuffle_files(spark)
    writers.write_partitioned(dated(spark, 3000).repartition(8), f"{tmp_path}/days")
    with pytest.raises(Exception, match="broken"):
        broken = dated(spark, 9).withColumn("note", F.raise_error(F.lit("broken")).cast("string"))
        writers.write_partitioned(broken, f"{tmp_path}/broken", arranged=True)
    assert [spark.conf.get(name) for name in names] == before
    left = shuffle_files(spark) - files_before
    assert not [name for name in left if name.startswith("shuffle_") and name.endswith(".data")]


def test_hours_come_from_the_day_tree_without_a_shuffle(spark, tmp_path):
    """More hours in one task than writers may be open, and rows without a day."""
    frame = dated(spark, 4000).withColumn("day", F.when(F.col("order_id") != "A7", F.col("day")))
    hour = F.lpad((F.crc32("order_id") % 24).cast("string"), 2, "0")
    paths = layout.write_daily_and_hourly(frame, str(tmp_path), hour, sort_by=["order_id"])
    assert len(files(tmp_path / "daily", ".parquet")) == 21
    hours = frame.withColumn("hour", hour)
    assert len(files(tmp_path / "hourly", ".parquet")) == hours.select("day", "hour").distinct().count() > 400
    back = spark.read.schema(hours.schema).parquet(paths["hourly"])
    assert sorted(map(str, back.collect())) == sorted(map(str, hours.collect()))
    assert ".zstd." in files(tmp_path / "daily", ".parquet")[0].name


def test_gathered_rows_are_the_same_rows(spark):
    """Texts with the marks of the packing, without value, empty, and cut within a letter."""
    texts = [None, "", " ", "a\x1fb", "\x1b", "\x1bn", "\x1bc3", "é\x1f", "\x1f\x1f", "x"]
    rows = [(a, b, k % 3, c, "k") for k, (a, b, c) in enumerate(itertools.product(texts, repeat=3))]
    frame = spark.createDataFrame(rows, "`a.b` string, b string, n int, `c``d` string, k string")
    back = writers.gathered(frame, "k", "n")
    assert back.schema == frame.schema
    assert back.exceptAll(frame).isEmpty() and frame.exceptAll(back).isEmpty()
    cut = spark.sql("SELECT cast(unhex('61c3') AS string) AS x, cast(unhex('1fff') AS string) AS y")
    as_bytes = [F.hex("x"), F.hex("y")]
    assert writers.gathered(cut).select(*as_bytes).collect() == cut.select(*as_bytes).collect()
    assert "_texts" in plan_of(back)
