"""Names and texts inside SQL."""

from __future__ import annotations


def quoted(*parts: str) -> str:
    """A possibly multi-part identifier."""
    return ".".join("`" + p.replace("`", "``") + "`" for p in parts)


def literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"
