"""caseload: customer-month prioritization as Spark DataFrame jobs.

Subpackages
-----------
sources    table scans, column contracts, sinks
functions  column-expression helpers (pure ``Column -> Column``)
operators  DataFrame -> DataFrame operators (cleaning, cadence, S2, queues, ...)
plans      composed workflows, stage materialization, query registry, oracle SQL
"""

__version__ = "0.1.0"
