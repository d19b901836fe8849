"""Every operator as a query over the given tables, with equivalent SQL where SQL can say it."""

from strata.queries import history, inputs, loads, mapping, quality, star, stats, sources, streams  # noqa: F401
from strata.queries.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
