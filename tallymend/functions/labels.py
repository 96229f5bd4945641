"""Texts that name a calendar partition, as SQL expressions."""

from __future__ import annotations


def month_text(month: str) -> str:
    """Month as text, zero-padded to two places; longer text stays whole."""
    text = f"cast({month} AS string)"
    return f"CASE WHEN length({text}) < 2 THEN lpad({text}, 2, '0') ELSE {text} END"


def partition_label(year: str = "year", month: str = "month", week: str = "week") -> str:
    """``2024-05-W3``; absent parts are left out, ``all`` when none is set."""
    text = f"concat_ws('-', {year}, {month}, concat('W', {week}))"
    return f"coalesce(nullif({text}, ''), 'all')"


def update_label(year: str = "year", month: str = "month", week: str = "week") -> str:
    """``2024-05-3`` for update counts; an absent year or month reads ``ALL``."""
    return f"concat_ws('-', coalesce({year}, 'ALL'), coalesce({month}, 'ALL'), {week})"
