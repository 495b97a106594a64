"""A lake over one data directory: the feed, and the tables published from it.

Published tables are written once per session below the scratch folder and read
from there, as analytics on a lake do. Every one of them is derived from the
whole supplied tables.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlake import schemas
from orderlake.contract import ORDER_DATE_FORMAT
from orderlake.functions.scalars import blank_to_null, parse_timestamp
from orderlake.operators.cleanse import CLEAN_COLUMNS, curated_sales
from orderlake.plans.job import STAGE_COMPRESSION, LakePaths, run_curated_sales
from orderlake.plans.star import Star, read_star, write_star
from orderlake.session import configure, scratch
from orderlake.sinks.layout import write_daily_and_hourly
from orderlake.sinks.writers import FORMATS, write_flat, write_formats
from orderlake.sources import feed, readers
from orderlake.sources.feed import Feed
from orderlake.streaming.incremental import run_incremental

PARTITIONED = schemas.RAW_ORDERS_PARTITIONED.fieldNames()
# Neighbouring ids share most of their text: files sorted by them are smaller.
RAW_SORT = ("order_id",)


class Lake:
    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark = configure(spark)
        self.root = root
        self.feed = Feed.of(spark, root)
        self._single_formats: dict[str, str] = {}
        self._raw_files: dict[str, str] = {}

    @property
    def raw_orders(self) -> DataFrame:
        """Orders as landed, without the delivery number."""
        return self.feed.orders.select(*PARTITIONED)

    @property
    def sales_plan(self) -> DataFrame:
        """The sales fact as one lazy plan from the supplied tables."""
        return curated_sales(self.feed.orders, self.feed.customers, self.feed.products)

    @cached_property
    def landed_orders(self) -> DataFrame:
        """The feed's orders written once, for a query that goes through them more than once."""
        path = scratch(self.spark, "orders")
        self.feed.orders.write.option("compression", STAGE_COMPRESSION).parquet(path)
        return self.spark.read.schema(self.feed.orders.schema).parquet(path)

    def _encoding(self, name: str) -> str | None:
        """Where the raw orders are written in this encoding, if they are."""
        return self.__dict__.get("formats", self._single_formats).get(name)

    @property
    def _flat_orders(self) -> DataFrame | None:
        """The raw orders as written without a tree, if they are."""
        path = self._encoding("parquet_flat")
        return path and readers.scan_parquet(self.spark, path, schemas.RAW_ORDERS_PARTITIONED)

    @property
    def _orders_by_day(self) -> DataFrame | None:
        """The raw orders as written in day directories, if they are."""
        path = self.__dict__.get("layouts", {}).get("daily") or self._encoding("parquet")
        return path and readers.scan_partitioned(self.spark, path)

    @cached_property
    def published(self) -> LakePaths:
        """A full run of the job: curated, quarantine and reconciliation on storage."""
        paths = LakePaths.below(self.spark, scratch(self.spark, "lake"))
        written = self.__dict__.get("landed_orders") or self._flat_orders
        run_curated_sales(
            (written or self.feed.orders).select(*CLEAN_COLUMNS),
            self.feed.customers,
            self.feed.products,
            paths,
            "full-load",
            landed=written is not None,
        )
        return paths

    @cached_property
    def sales(self) -> DataFrame:
        return readers.read_curated(self.spark, self.published.curated)

    @cached_property
    def quarantine(self) -> DataFrame:
        return self.spark.read.schema(schemas.QUARANTINE_RUNS).parquet(self.published.quarantine)

    @cached_property
    def star(self) -> Star:
        root = scratch(self.spark, "star")
        write_star(readers.stage_sales(self.spark, self.published.curated), root)
        self.star_root = root
        return read_star(self.spark, root)

    @cached_property
    def formats(self) -> dict[str, str]:
        """The raw orders as CSV, JSON Lines and Parquet trees and as flat Parquet."""
        root = scratch(self.spark, "formats")
        missing = [name for name in FORMATS if name not in self._single_formats]
        if by_day := self._orders_by_day:
            written = write_formats(by_day, root, missing, arranged=True)
        else:
            orders = self._flat_orders or self.raw_orders
            written = write_formats(orders, root, missing, sort_by=RAW_SORT)
        return {name: (self._single_formats | written)[name] for name in FORMATS}

    def one_format(self, name: str) -> str:
        """The raw orders in one of these encodings, the others left unwritten."""
        if "formats" in self.__dict__:
            return self.formats[name]
        if name not in self._single_formats:
            root = scratch(self.spark, "format")
            self._single_formats |= write_formats(
                self.raw_orders, root, [name], sort_by=RAW_SORT
            )
        return self._single_formats[name]

    @cached_property
    def layouts(self) -> dict[str, str]:
        """Raw orders in day and in hour directories; an unreadable date is filed under hour 00."""
        written = parse_timestamp(blank_to_null(F.col("order_date")), ORDER_DATE_FORMAT)
        hour = F.coalesce(F.date_format(written, "HH"), F.lit("00"))
        root = scratch(self.spark, "layout")
        if by_day := self._orders_by_day:
            return write_daily_and_hourly(by_day, root, hour, arranged=True)
        orders = self._flat_orders or self.raw_orders
        return write_daily_and_hourly(orders, root, hour, sort_by=RAW_SORT)

    @property
    def stored(self) -> dict[str, str]:
        """Every encoding and layout of the raw orders, and the fact.

        The feed runs once, for the flat copy. One shuffle brings its rows together by day; all
        other trees are written from that one, and the fact from the flat copy.
        """
        self.one_format("parquet_flat")
        layouts = self.layouts
        return {**self.formats, **layouts, "curated": self.published.curated}

    def raw_file(self, name: str) -> str:
        """The flat raw CSV files of one table, as a source system delivers them."""
        if name not in self._raw_files:
            tables = {
                "orders": self.feed.orders.select(*CLEAN_COLUMNS),
                "customers": self.feed.customers,
                "products": self.feed.products,
            }
            path = f"{scratch(self.spark, 'raw')}/{name}"
            write_flat(tables[name], path, fmt="csv")
            self._raw_files[name] = path
        return self._raw_files[name]

    @cached_property
    def product_deliveries(self) -> str:
        """Product files per delivery, price as text; the third delivery drifted."""
        path = scratch(self.spark, "products")
        products = feed.feed_products_text(self.spark, self.root)
        products.write.partitionBy("delivery").option("header", True).csv(path)
        return path

    def read_product_deliveries(self) -> DataFrame:
        return (
            self.spark.read.schema(schemas.RAW_PRODUCTS_TEXT)
            .option("header", True)
            .option("recursiveFileLookup", True)
            .csv(self.product_deliveries)
        )

    @cached_property
    def order_deliveries(self) -> list[str]:
        """The orders as three CSV deliveries; the last one is late for almost every day."""
        root = scratch(self.spark, "deliveries")
        paths = []
        for number in (1, 2, 3):
            path = f"{root}/delivery={number}"
            delivered = self.feed.orders.where(f"delivery = {number}").select(*CLEAN_COLUMNS)
            write_flat(delivered, path, fmt="csv")
            paths.append(path)
        return paths

    def run_deliveries(self) -> tuple[LakePaths, list[int]]:
        """Let the deliveries arrive one by one, then look once more; rows read per run."""
        root = scratch(self.spark, "incremental")
        paths = LakePaths.below(self.spark, root)
        arrived = f"{root}/raw/orders"
        handled = []
        for number in (1, 2, 3, None):
            if number:
                delivered = self.feed.orders.where(f"delivery = {number}").select(*CLEAN_COLUMNS)
                write_flat(delivered, f"{arrived}/delivery={number}", fmt="csv")
            handled.append(
                run_incremental(
                    self.spark,
                    arrived,
                    lambda session: feed.feed_customers(session, self.root),
                    lambda session: feed.feed_products(session, self.root),
                    paths,
                    f"{root}/checkpoint",
                )
            )
        return paths, handled


_LAKES: dict[tuple[str, str], Lake] = {}


def lake(spark: SparkSession, root: str) -> Lake:
    """The lake of a data directory, kept for the lifetime of the Spark application."""
    key = (spark.sparkContext.applicationId, root)
    if key not in _LAKES:
        _LAKES[key] = Lake(spark, root)
    return _LAKES[key]
