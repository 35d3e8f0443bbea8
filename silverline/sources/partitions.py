"""Which partitions to read: an explicit list or an inclusive range of days."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime, timedelta

from silverline.functions.columns import split_names

ISO_DAY = "%Y-%m-%d"


def day_range(start: str | date, end: str | date, fmt: str = ISO_DAY) -> list[str]:
    """Every day from `start` to `end`, both included, written with `fmt`."""
    first, last = (_as_day(x, fmt) for x in (start, end))
    if last < first:
        raise ValueError(f"range ends before it starts: {first} .. {last}")
    days = (first + timedelta(days=n) for n in range((last - first).days + 1))
    # a coarse format such as %Y-%m writes many days alike
    return list(dict.fromkeys(d.strftime(fmt) for d in days))


def resolve_partitions(
    values: str | Sequence[str] | None = None,
    between: str | Sequence[str | date] | None = None,
    fmt: str = ISO_DAY,
) -> list[str]:
    """Partition values from a list or from a `(start, end)` range; exactly one is needed."""
    if (values is None) == (between is None):
        raise ValueError("give either partition values or a partition range")
    if values is not None:
        chosen = split_names(values)
        if not chosen:
            raise ValueError("the list of partition values is empty")
        return chosen
    bounds = split_names(between) if isinstance(between, str) else list(between)
    if len(bounds) != 2:
        raise ValueError(f"a partition range needs a start and an end, got {bounds}")
    return day_range(bounds[0], bounds[1], fmt)


def _as_day(value: str | date, fmt: str) -> date:
    if isinstance(value, datetime):
        return value.date()
    return value if isinstance(value, date) else datetime.strptime(value, fmt).date()
