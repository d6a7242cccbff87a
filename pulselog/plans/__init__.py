"""Named queries over the supplied tables and the SQL that checks them."""

from pulselog.plans.oracles import ORACLES
from pulselog.plans.queries import QUERIES

__all__ = ["ORACLES", "QUERIES"]
