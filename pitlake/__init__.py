"""pitlake: point-in-time training panels on Spark.

Raw sources -> silver (normalised) -> gold (dense ticker x trading-day panel,
equi / as-of joins, forward-return labels) -> exports and audit reports.
Every stage is a ``DataFrame -> DataFrame`` function built from Spark SQL
built-ins, so Catalyst plans the whole chain as one query.
"""

from pitlake.session import get_session

__all__ = ["get_session"]
