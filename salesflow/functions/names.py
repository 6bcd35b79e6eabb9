"""Names and texts in SQL statements."""

from __future__ import annotations


def quoted(name: str) -> str:
    """A catalog name in backticks, unless it is quoted or qualified already."""
    return name if "`" in name or "." in name else f"`{name}`"


def quoted_text(text: str) -> str:
    """A SQL string literal, whatever the text holds."""
    inside = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{inside}'"
