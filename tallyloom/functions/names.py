"""Quoting of column names, most of which carry spaces or start with a digit."""

from __future__ import annotations

from collections.abc import Iterable


def quoted(name: str) -> str:
    return f"`{name}`"


def all_quoted(names: Iterable[str]) -> list[str]:
    return [quoted(name) for name in names]
