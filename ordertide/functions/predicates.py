"""Named row predicates whose exact boolean shape matters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column


def reason_code_filter(reason_ok: Column, date_from_ok: Column, event_from_ok: Column,
                       is_deviation: Column, is_recovery: Column, recovered_ok: Column) -> Column:
    """The deviation / auto-recovery filter *as the warehouse evaluates it*.

    The source text reads ``reasons AND dates AND type = 'Deviation' OR
    (type = 'Auto-recovery' AND recovered IS NOT NULL)``; AND binds tighter
    than OR, so auto-recovery rows are kept regardless of reason and dates.
    The parentheses below spell that binding out.
    """
    return (reason_ok & date_from_ok & event_from_ok & is_deviation) | (is_recovery & recovered_ok)


def not_in(c: Column, values: Sequence) -> Column:
    """SQL ``NOT IN``: NULL input yields NULL (row rejected), like ``IN``."""
    return ~c.isin(list(values))
