"""DuckDB oracle SQL for every registered query (see ``__spark_entry__``).

The oracle is written independently of the Spark code: it keeps the plain
relational form of each model (OR-pair joins, range joins with row_number,
UNION ALL unpivots) so that the Spark rewrites are checked against it.
"""

from courtline.oracle.sql import oracle_queries  # noqa: F401
