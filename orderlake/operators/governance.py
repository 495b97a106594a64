"""Column-restricted views."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def governed_view(frame: DataFrame, granted: Sequence[str], view: str | None = None) -> DataFrame:
    """Only the granted columns. A column added later stays hidden until it is granted.

    With ``view`` the result is also registered, so ``SELECT *`` resolves to the
    granted columns; the scan below reads no others.
    """
    unknown = [name for name in granted if name not in frame.columns]
    if unknown:
        raise ValueError(f"granted columns do not exist: {unknown}")
    allowed = frame.select(*granted)
    if view:
        allowed.createOrReplaceTempView(view)
        return frame.sparkSession.table(view)
    return allowed
