import json

import pytest

from orderlake.contract import Contract


def test_defaults():
    contract = Contract.from_mapping({})
    assert contract == Contract()
    assert contract.partition_by == ("year", "month", "day")
    assert contract.tables["orders"] == "orders_raw"
    assert contract.quarantine_prefix == "quarantine/sales"


def test_given_values_win():
    text = json.dumps(
        {
            "datasets": {"orders": {"catalog_table": "orders_v2"}},
            "curated": {
                "sales": {"prefix": "gold/sales", "compression": "zstd", "partition_by": ["year"]}
            },
            "quality": {"quarantine_prefix": "bad", "valid_statuses": ["OPEN"]},
        }
    )
    contract = Contract.from_json(text)
    assert contract.tables == {
        "customers": "customers_raw",
        "products": "products_raw",
        "orders": "orders_v2",
    }
    assert (contract.curated_prefix, contract.compression) == ("gold/sales", "zstd")
    assert contract.partition_by == ("year",) and contract.valid_statuses == ("OPEN",)
    assert contract.quarantine_prefix == "bad"


def test_unknown_codec_and_format_are_refused():
    with pytest.raises(ValueError):
        Contract(compression="rar")
    with pytest.raises(ValueError):
        Contract.from_mapping({"curated": {"sales": {"format": "csv"}}})
    with pytest.raises(ValueError):
        Contract(valid_statuses=())
