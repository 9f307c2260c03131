"""verlog: versioned tables as append-only change logs on stock Spark.

Main entry points: ``VersionedTable`` (create, insert/update/delete/merge,
as_of, changes, history, restore, clone, snapshot/optimize, detail,
purge_plan) and ``register`` (temp views of versions, feed and history for
``spark.sql``). Operators on plain DataFrames live in ``verlog.operators``.
"""

from verlog.sources.versioned import VersionedTable
from verlog.sources.views import register

__all__ = ["VersionedTable", "register"]
