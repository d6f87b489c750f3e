"""Names and literals for generated SQL expressions."""

from __future__ import annotations

from collections.abc import Iterable


def quoted(name: str) -> str:
    """A column name that means just this column, whatever characters it has."""
    return "`" + name.replace("`", "``") + "`"


def unused(name: str, *columns: Iterable[str]) -> str:
    """``name``, made longer until none of the columns is called so; Spark's names ignore case."""
    taken = {c.lower() for names in columns for c in names}
    while name.lower() in taken:
        name += "_"
    return name


def text(value: str | None) -> str:
    """A string literal; NULL for None."""
    if value is None:
        return "NULL"
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
