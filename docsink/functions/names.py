"""Names and texts inside SQL expressions."""

from __future__ import annotations


def quote(name: str) -> str:
    """Column or field name, whatever characters it has."""
    return "`" + name.replace("`", "``") + "`"


def literal(text: str) -> str:
    """String literal."""
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"
