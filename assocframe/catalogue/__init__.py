"""Named queries over the test tables, each with the SQL that checks it."""

from assocframe.catalogue import associations, loci, quality, statistics, tables  # noqa: F401
from assocframe.catalogue.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
