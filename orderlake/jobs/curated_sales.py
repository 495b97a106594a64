"""spark-submit entry point of the curated-sales job.

    spark-submit -m orderlake.jobs.curated_sales --lake s3a://lake --database sales_raw
    spark-submit -m orderlake.jobs.curated_sales --lake /lake --incremental

Tables are read by catalog name with ``--database``, otherwise as raw CSV below the
lake root. ``--incremental`` handles only order files that arrived since the last
run; dimensions are read in full every time.
"""

from __future__ import annotations

import argparse
import json
import uuid

from pyspark.sql import DataFrame, SparkSession

from orderlake import schemas
from orderlake.contract import Contract
from orderlake.operators.cleanse import rejections_by_reason
from orderlake.plans.job import LakePaths, run_curated_sales
from orderlake.session import build_session, configure, path_exists
from orderlake.sources.catalog import extract
from orderlake.sources.readers import scan_csv
from orderlake.streaming.incremental import run_incremental

RAW_SCHEMAS = {
    "customers": schemas.RAW_CUSTOMERS,
    "products": schemas.RAW_PRODUCTS,
    "orders": schemas.RAW_ORDERS,
}


def _arguments(argv: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="curated_sales", description=__doc__)
    parser.add_argument("--lake", required=True, help="root of the lake, on shared storage")
    parser.add_argument("--database", help="catalog database of the raw tables")
    parser.add_argument("--contract", help="JSON data contract, on any storage Spark reads")
    parser.add_argument("--run-id", default=uuid.uuid4().hex, help="same id, same run on replay")
    parser.add_argument("--incremental", action="store_true")
    return parser.parse_args(argv)


def load_contract(spark: SparkSession, path: str | None) -> Contract:
    if not path:
        return Contract()
    return Contract.from_json(spark.read.text(path, wholetext=True).first().value)


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> dict | int:
    options = _arguments(argv)
    session = configure(spark or build_session("curated-sales"))
    contract = load_contract(session, options.contract)
    paths = LakePaths.below(session, options.lake, contract)

    def read(name: str, within: SparkSession = session) -> DataFrame:
        if options.database:
            return extract(within, options.database, {name: contract.tables[name]})[name]
        return scan_csv(within, f"{options.lake}/raw/{name}", RAW_SCHEMAS[name], recursive=True)

    if options.incremental:
        handled = run_incremental(
            session,
            f"{options.lake}/raw/orders",
            lambda within: read("customers", within),
            lambda within: read("products", within),
            paths,
            f"{options.lake}/_checkpoints/curated_sales",
            contract=contract,
        )
        print(json.dumps({"new_rows": handled}))
        return handled

    report = run_curated_sales(
        read("orders"),
        read("customers"),
        read("products"),
        paths,
        options.run_id,
        contract=contract,
    )
    print(json.dumps(report))
    if path_exists(session, paths.quarantine):
        rejects = session.read.schema(schemas.QUARANTINE_RUNS).parquet(paths.quarantine)
        rejections_by_reason(rejects.where(rejects.run_id == options.run_id)).show(truncate=False)
    return report


if __name__ == "__main__":
    main()
