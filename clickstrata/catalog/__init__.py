"""The registered queries: every operator run over the given tables, beside the SQL that checks it.

The given tables are not advertising logs, so each module first reads them as
such (for example one ``events`` row as one bidding event) with plain column
expressions, written once for Spark and once as a SQL common table expression.
All rows of a table are used.
"""

from .registry import oracle_sql, queries

__all__ = ["oracle_sql", "queries"]
