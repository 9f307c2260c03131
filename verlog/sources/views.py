"""Expose a versioned table to Spark SQL as temporary views.

The reference writes ``t@v1``, ``t VERSION AS OF 1``, ``table_changes('t', 1)``
and ``DESCRIBE HISTORY t`` inside ordinary SQL. Here each of those relations is
a temp view, so the same statements run in ``spark.sql`` with the view names
in their place (``t_v1``, ``t_changes``, ``t_history``) -- no parser involved.
"""

from __future__ import annotations

from collections.abc import Iterable

from verlog.sources.versioned import VersionedTable


def register(t: VersionedTable, name: str, versions: Iterable[int] = (), changes_from: int | None = None,
             history: bool = True) -> list[str]:
    """Create ``name`` (current), ``name_v<n>`` per version, ``name_changes``
    (feed from ``changes_from``) and ``name_history``. Returns the view names."""
    made = [name]
    t.current().createOrReplaceTempView(name)
    for v in versions:
        t.as_of(int(v)).createOrReplaceTempView(f"{name}_v{int(v)}")
        made.append(f"{name}_v{int(v)}")
    if changes_from is not None:
        t.changes(int(changes_from)).createOrReplaceTempView(f"{name}_changes")
        made.append(f"{name}_changes")
    if history:
        t.history().createOrReplaceTempView(f"{name}_history")
        made.append(f"{name}_history")
    return made
