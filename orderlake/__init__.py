"""orderlake: an order lakehouse expressed as Spark DataFrame functions.

Raw order, customer and product deliveries go in; a deduplicated, validated,
enriched sales fact comes out, next to a quarantine table and a reconciliation
that proves no row was lost on the way.
"""

from orderlake.contract import Contract
from orderlake.session import build_session, configure

__all__ = ["Contract", "build_session", "configure"]
