"""Times of the tests' rows."""

from datetime import datetime, timezone

START = datetime(2024, 1, 1, tzinfo=timezone.utc)


def seconds(value) -> float:
    """Seconds after the start of a collected timestamp."""
    if value.tzinfo is None:
        value = value.astimezone(timezone.utc)
    return (value - START).total_seconds()
