"""Argument checks, made before any job starts."""

from __future__ import annotations

import re

# Highest rise that leaves a safe place: in one low country, and on the whole earth.
MAX_RISE_COUNTRY = 95
MAX_RISE_PLANET = 8848


def _whole_number(value, what: str) -> int:
    if isinstance(value, bool):
        raise ValueError(f"{what} must be a whole number, not {value!r}")
    if isinstance(value, int):
        return value
    if not re.fullmatch("-?[0-9]+", str(value)):
        raise ValueError(f"{what} must be a whole number, not {value!r}")
    return int(value)


def check_rise(value, maximum: int = MAX_RISE_PLANET) -> int:
    """The sea level rise in metres, 0 to ``maximum``."""
    rise = _whole_number(value, "rise")
    if not 0 <= rise <= maximum:
        raise ValueError(f"rise must be between 0 and {maximum}, not {rise}")
    return rise


def check_window(value) -> int:
    """The length of the trailing window in seconds, above 0."""
    seconds = _whole_number(value, "window")
    if seconds <= 0:
        raise ValueError(f"window must be above 0 seconds, not {seconds}")
    return seconds
