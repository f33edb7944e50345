"""Every operator as a query on the test tables, with the same question in SQL."""

from shelfcurve.catalog.registry import ORACLES, QUERIES  # noqa: F401
from shelfcurve.catalog import basic, grouping, joining, ordered, pricing, storage  # noqa: F401
