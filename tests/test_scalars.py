import time

import pytest
from pyspark.sql import functions as F

from orderlake.functions.scalars import does_not_fit

TYPES = ("int", "bigint", "double", "boolean", "date", "timestamp")
TEXTS = [
    "", " ", "0", "-0", "+7", " 12 ", "\t12\n", "\x7f12\x00", "12 ", "2147483647", "2147483648",
    "9223372036854775807", "9223372036854775808", "1.", ".5", "3.7", ".", "-", "1e5", "1E+5", "1e", "1f",
    "2D", "1L", "0x1.8p1", "0x1p-3F", "0x10", "NaN", "nan", "inf", "-Infinity", "+iNf", "infinit", "1_0",
    "1 2", "１２", "true", " FALSE ", "t", "Y", "no", "y e s", "truе", "2026", "0000", "299999", "294247",
    "300000", "-300000", "999999", "+999999", " 300000 ", "1000000", "300000-01-01", "2026-07-09",
    "2026-7-9", "2026-02-30", "2026-07-09 10:30:00", "2026-07-09T10:30:00Z", "10:30", "T10:30:00",
    "09/07/2026", "C000000123", "O000000000001-1", "UNKNOWN", "abc", "€5", None,
]


@pytest.mark.parametrize("kind", TYPES)
def test_a_value_fits_if_and_only_if_its_cast_does(spark, kind):
    rows = spark.createDataFrame([(t,) for t in TEXTS], "t string").repartition(1)
    cast = F.col("t").isNotNull() & F.col("t").try_cast(kind).isNull()
    found = rows.select("t", does_not_fit(F.col("t"), kind).alias("new"), cast.alias("old")).collect()
    assert [r.t for r in found if r.new != r.old] == []


@pytest.mark.parametrize("kind", ["int", "boolean"])
def test_typed_columns_are_judged_by_their_cast(spark, kind):
    row = spark.createDataFrame([(12345678901.5,), (2.0,)], "t double")
    cast = F.col("t").isNotNull() & F.col("t").try_cast(kind).isNull()
    found = row.select(does_not_fit(F.col("t"), kind).alias("new"), cast.alias("old")).collect()
    assert all(r.new == r.old for r in found)


@pytest.mark.parametrize("kind", ["int", "bigint", "boolean"])
def test_text_that_cannot_fit_is_not_cast(spark, kind):
    """A cast that fails raises inside Spark; telling such text by its letters takes a fraction."""
    ids = spark.range(0, 200_000, 1, 1).select(F.concat(F.lit("C"), F.col("id").cast("string")).alias("t"))

    def seconds(misfit):
        began = time.perf_counter()
        assert ids.agg(F.count_if(misfit)).first()[0] == 200_000
        return time.perf_counter() - began

    plain = F.col("t").isNotNull() & F.col("t").try_cast(kind).isNull()
    best = lambda misfit: min(seconds(misfit) for _ in range(2))
    assert best(does_not_fit(F.col("t"), kind)) < best(plain) / 2
