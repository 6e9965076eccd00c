"""Turning data values into column names."""

from __future__ import annotations

import re
from collections.abc import Iterable


def clean_name(value: object) -> str:
    """Lower-case ``value`` and join its alphanumeric runs with ``_``."""
    words = re.findall(r"[a-z0-9]+", str(value).lower())
    return "_".join(words) or "empty"


def value_columns(prefix: str, values: Iterable[str], taken: set[str]) -> dict[str, str]:
    """Give each value its own ``prefix_value`` column name.

    Values are visited in sorted order and two values that clean to the same
    name get ``_2``, ``_3``, ... so no column silently replaces another.
    ``taken`` holds names already in use and is extended.
    """
    names: dict[str, str] = {}
    for value in sorted(values):
        base = f"{prefix}_{clean_name(value)}"
        name, n = base, 1
        while name in taken:
            n += 1
            name = f"{base}_{n}"
        taken.add(name)
        names[value] = name
    return names


# The business role of a column is the first entry of this list
# with a pattern that matches the lower-cased column name.
ROLE_PATTERNS: list[tuple[str, str]] = [
    (r"^target$", "target"),
    (r"ext_source", "external score"),
    (r"income", "income"),
    (r"^(?!.*bureau).*credit", "credit"),
    (r"annuity", "annuity"),
    (r"payment|dpd|late_|underpaid", "payment behaviour"),
    (r"bureau", "bureau"),
    (r"social", "social circle"),
    (r"days_|years|age", "time"),
    (r"region|city|address", "geography"),
    (r"document", "documents"),
    (r"name_|_idx$", "categorical"),
]


def business_role(column: str) -> str:
    for pattern, role in ROLE_PATTERNS:
        if re.search(pattern, column.lower()):
            return role
    return "other"
