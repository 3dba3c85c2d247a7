"""Names and literals inside SQL text."""

from __future__ import annotations


def quote_part(part: str) -> str:
    return "`" + part.replace("`", "``") + "`"


def quote_name(name: str) -> str:
    """``a.b.c`` with every part in backticks."""
    return ".".join(quote_part(p) for p in name.split("."))


def quote_text(value: str) -> str:
    """A SQL string literal; backslashes and apostrophes are escaped."""
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"
