"""Rules for request arguments (plain values, not columns)."""

from __future__ import annotations

from datetime import date, datetime, timedelta, timezone

from candlehouse.schemas import ASSET_TYPE_ID

DEFAULT_HOURS_BACK = 2
MAX_HOURS_BACK = 168
MAX_HISTORY_DAYS = 365
MAX_INDEX_DAYS = 5000


def naive_utc(moment: datetime) -> datetime:
    """Moments are UTC throughout: a naive one is taken as it is, one with a zone is converted."""
    return moment.astimezone(timezone.utc).replace(tzinfo=None) if moment.tzinfo else moment


def parse_asset_types(text: str | None) -> list[str] | None:
    """Comma list to codes: trimmed, upper case, empty parts dropped. None stays None (all)."""
    if text is None:
        return None
    return [part.strip().upper() for part in text.split(",") if part.strip()]


def select_asset_types(requested: list[str] | None) -> list[str]:
    """None or empty means all; unknown codes are dropped, so only unknown codes select nothing."""
    if not requested:
        return list(ASSET_TYPE_ID)
    return [code for code in ASSET_TYPE_ID if code in requested]


def positive(name: str, value: int) -> int:
    """Operators take any number from 1 on."""
    if value < 1:
        raise ValueError(f"{name} must be at least 1")
    return value


# Request checks: what a caller may ask for, apart from what operators can do. Each returns the value to use and a warning.


def check_hours_back(hours: int) -> tuple[int, str | None]:
    """Look-back of an incremental load: less than 1 means 2 hours, more than 168 means 168."""
    used = DEFAULT_HOURS_BACK if hours < 1 else min(hours, MAX_HOURS_BACK)
    return used, None if used == hours else f"hoursBack was adjusted from {hours} to {used}."


def check_days(days: int, upper: int = MAX_HISTORY_DAYS) -> tuple[int, str | None]:
    """Days of a history. The two message texts."""
    used = max(1, min(days, upper))
    if days < 1:
        return used, f"Parameter 'days' must be at least 1. Adjusted from {days} to {used}."
    if days > upper:
        return used, f"Parameter 'days' cannot exceed {upper}. Adjusted from {days} to {used}."
    return used, None


def range_bounds(start: date | str, end: date | str) -> tuple[datetime, datetime]:
    """Inclusive dates to a half-open timestamp range [start, end + 1 day)."""
    first = date.fromisoformat(start) if isinstance(start, str) else start
    last = date.fromisoformat(end) if isinstance(end, str) else end
    midnight = datetime.min.time()
    return datetime.combine(first, midnight), datetime.combine(last, midnight) + timedelta(days=1)
