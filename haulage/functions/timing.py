"""Elapsed time between timestamps, as SQL text shared by queries and views.

Differences are taken between the timestamps themselves, so those without a zone never
pass through the session time zone, and microseconds stay exact.
"""

from __future__ import annotations

_EPOCH = "timestamp_ntz '1970-01-01 00:00:00'"


def _elapsed(start: str, end: str) -> str:
    """Seconds between two timestamps, with microseconds."""
    return f"cast(cast({end} - {start} as interval second) as decimal(20,6))"


def _boundaries(start: str, end: str, per_second: int) -> str:
    """Boundaries of seconds, or of parts of a second, crossed between two timestamps."""
    passed = (f"cast(floor({_elapsed(_EPOCH, ts)} * {per_second}) as bigint)" for ts in (end, start))
    return "(" + " - ".join(passed) + ")"


def second_boundaries(start: str, end: str) -> str:
    """Number of second boundaries crossed between two timestamps."""
    return _boundaries(start, end, 1)


def duration_text(start: str, end: str) -> str:
    """Elapsed time as ``HH:MM:SS``, modulo 24 hours: the clock after so long from midnight."""
    seconds = f"floor({_boundaries(start, end, 1000)} / 1000)"
    return f"substring(cast({_EPOCH} + make_dt_interval(0, 0, 0, {seconds}) as string), 12, 8)"


def throughput(rows: str, start: str, end: str) -> str:
    """Whole rows per second of elapsed time; NULL when no time has passed."""
    micros = f"cast({_elapsed(start, end)} * 1000000 as bigint)"
    return f"({rows} * 1000000L div nullif({micros}, 0L))"
