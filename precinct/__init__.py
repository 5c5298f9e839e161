"""Incident analytics as composable PySpark DataFrame operators.

Layout: ``sources`` (CSV ingestion, test-table adapters), ``functions``
(column expressions), ``operators`` (filters, joins, ranking, nearest
station), ``plans`` (the reports and the query catalog), ``streaming``
(see its docstring).
"""

__version__ = "0.1.0"
