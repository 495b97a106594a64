"""The data contract: names, keys, layout and rules the jobs agree on."""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass, field

# The statuses an order may have, the timestamp text of the raw layer and
# the layer prefixes every consumer of the lake relies on.
VALID_STATUSES = ("DELIVERED", "SHIPPED", "PENDING", "CANCELLED", "RETURNED")
ORDER_DATE_FORMAT = "yyyy-MM-dd HH:mm:ss"
PARTITION_COLUMNS = ("year", "month", "day")
PARQUET_CODECS = ("snappy", "zstd", "gzip", "lz4", "uncompressed")


def _default_tables() -> dict[str, str]:
    return {name: f"{name}_raw" for name in ("customers", "products", "orders")}


@dataclass(frozen=True)
class Contract:
    """Everything a job may be told from outside; the defaults are the standard lake."""

    valid_statuses: tuple[str, ...] = VALID_STATUSES
    order_date_format: str = ORDER_DATE_FORMAT
    partition_by: tuple[str, ...] = PARTITION_COLUMNS
    compression: str = "snappy"
    curated_prefix: str = "curated/sales"
    quarantine_prefix: str = "quarantine/sales"
    tables: Mapping[str, str] = field(default_factory=_default_tables)

    def __post_init__(self) -> None:
        if self.compression not in PARQUET_CODECS:
            raise ValueError(f"{self.compression!r} is no Parquet codec: {PARQUET_CODECS}")
        if not self.valid_statuses:
            raise ValueError("a contract without valid statuses would reject every order")

    @classmethod
    def from_mapping(cls, document: Mapping) -> Contract:
        """Read the JSON contract; what it leaves out keeps its default."""
        given: dict = {}
        sales = document.get("curated", {}).get("sales", {})
        if sales.get("format", "parquet") != "parquet":
            raise ValueError("the curated layer is Parquet; the contract asks for another format")
        for source, target in (("prefix", "curated_prefix"), ("compression", "compression")):
            if source in sales:
                given[target] = sales[source]
        if sales.get("partition_by"):
            given["partition_by"] = tuple(sales["partition_by"])
        quality = document.get("quality", {})
        if quality.get("quarantine_prefix"):
            given["quarantine_prefix"] = quality["quarantine_prefix"]
        if quality.get("valid_statuses"):
            given["valid_statuses"] = tuple(quality["valid_statuses"])
        tables = {
            name: spec["catalog_table"]
            for name, spec in document.get("datasets", {}).items()
            if "catalog_table" in spec
        }
        if tables:
            given["tables"] = {**_default_tables(), **tables}
        return cls(**given)

    @classmethod
    def from_json(cls, text: str) -> Contract:
        return cls.from_mapping(json.loads(text))
