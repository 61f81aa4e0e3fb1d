"""Duration strings such as 15d, 10s or 500ms."""

from __future__ import annotations

import re

# Unit suffixes and their milliseconds.
UNITS_MS = {"us": 0.001, "ms": 1, "s": 1000, "m": 60_000, "min": 60_000, "h": 3_600_000, "d": 86_400_000}


def duration_ms(text: str) -> int:
    """Milliseconds of a duration; a number without a unit is milliseconds already."""
    found = re.fullmatch(r"\s*(-?\d+)\s*([a-z]*)\s*", text.lower())
    if not found or (found[2] or "ms") not in UNITS_MS:
        raise ValueError(f"not a duration: {text!r}")
    return int(int(found[1]) * UNITS_MS[found[2] or "ms"])
