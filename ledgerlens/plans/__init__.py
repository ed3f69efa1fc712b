"""The registered queries and the SQL that checks them."""

from ledgerlens.plans.catalog import QUERIES
from ledgerlens.plans.oracle import ORACLE_SQL

__all__ = ["QUERIES", "ORACLE_SQL"]
