"""Days, attempts and paths: small functions of the driver."""

from __future__ import annotations

import re
from datetime import UTC, date, datetime, timedelta

BRONZE, MANIFESTS = "api-metrics", "_state/days"


def is_valid_dt(dt: str | None) -> bool:
    """YYYY-MM-DD, and a day of the calendar."""
    if dt is None or not re.fullmatch(r"[0-9]{4}-[0-9]{2}-[0-9]{2}", dt):
        return False
    try:
        return date.fromisoformat(dt).isoformat() == dt
    except ValueError:
        return False


def check_dt(dt: str | None) -> str:
    if not is_valid_dt(dt):
        raise ValueError(f"not a day: {dt!r}")
    return dt


def is_valid_attempt(attempt: str | None) -> bool:
    return attempt is None or re.fullmatch(r"[1-9][0-9]*", attempt) is not None


def is_valid_force(force: str | None) -> bool:
    return force is None or force in ("1", "true")


def parse_force(force: str | None) -> bool:
    return force is not None and is_valid_force(force)


def is_valid_run_id(run_id: object) -> bool:
    return isinstance(run_id, str) and bool(run_id)


def run_id(dt: str, attempt: str | None = None) -> str:
    return f"day-{dt}-r{attempt}" if attempt else f"day-{dt}"


def day_offset(base: datetime, days: int) -> str:
    """The UTC day so many days from base's."""
    return (base.astimezone(UTC).date() + timedelta(days=days)).isoformat()


def yesterday(now: datetime | None = None) -> str:
    return day_offset(now or datetime.now(UTC), -1)


def day_range(start: str, end: str) -> list[str]:
    """All days from start to end, both included."""
    first, last = date.fromisoformat(check_dt(start)), date.fromisoformat(check_dt(end))
    if first > last:
        raise ValueError("the first day must not be after the last")
    return [(first + timedelta(days=i)).isoformat() for i in range((last - first).days + 1)]


def day_prefix(dt: str) -> str:
    return f"{BRONZE}/{dt}/"


def manifest_key(dt: str) -> str:
    return f"{MANIFESTS}/dt={dt}.json"


def quarantine_key(dt: str, source: str) -> str:
    """Where the refused lines of one source are exported to."""
    return f"quarantine/{BRONZE}/dt={dt}/{source}.jsonl"
