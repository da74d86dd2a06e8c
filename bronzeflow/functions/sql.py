"""SQL text helpers."""

from __future__ import annotations


def text(value: str) -> str:
    """SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
