"""Every operator run on the test tables, with the SQL that must give the same rows.

The test tables hold no racing data, so each query derives result-shaped rows from a whole table
(an order stands for a race, a line item for a row of it) and runs the library on them. The
derivation is one SQL text that both engines read; the rule under test is written twice, once as a
library call and once as SQL.
"""

from catalogue import bronze, changes, clean, functions, incremental, reports, stored, weekend  # noqa: F401
from catalogue.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
