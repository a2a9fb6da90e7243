"""Independent DuckDB formulations of every registered query.

Each SQL is a direct reading of the original macro (distinct-count windows,
global windows and the daily calendar are kept), over the same derived views
as the Spark side.  Conventions:

* ascending orders say ``NULLS FIRST`` (the original warehouse's default);
* ties are broken by the business key, as on the Spark side;
* ``round`` of a double goes through ``decimal(38,12)`` so that a value
  printed as ``x.xx5`` rounds half up, as decimal arithmetic does;
* money is reported as double.
"""

from oracle.sql import ORACLE  # noqa: F401
