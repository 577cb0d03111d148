"""Identifier and literal quoting for the SQL text handed to Spark."""

from __future__ import annotations


def quoted(name: str) -> str:
    """One identifier in backticks."""
    return "`" + name.replace("`", "``") + "`"


def qualified(*parts: str | None) -> str:
    """A dotted name with every given part in backticks; absent parts are skipped."""
    return ".".join(quoted(part) for part in parts if part)


def text_literal(value: str) -> str:
    """A SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
