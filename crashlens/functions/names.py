"""Feature-name sanitizing.

Column lists are short (tens of names), so this runs on the driver over the
name list; the value-level form is a ``regexp_replace`` column.
"""

from __future__ import annotations

import re
from itertools import count

from pyspark.sql import Column
from pyspark.sql import functions as F

_BAD = r"[^A-Za-z0-9_]"


def sanitize(name: str) -> str:
    return re.sub(_BAD, "_", name)


def sanitize_col(col) -> Column:
    return F.regexp_replace(F.col(col) if isinstance(col, str) else col, _BAD, "_")


def dedupe(names: list[str]) -> list[str]:
    """Unique names: a repeat gets the lowest number that makes a name which
    occurs nowhere else, neither in the input nor among those given before."""
    taken, out = set(names), dict[str, None]()
    for name in names:
        numbered = (f"{name}_{k}" for k in count(1))
        free = name if name not in out else next(x for x in numbered if x not in taken)
        taken.add(free)
        out[free] = None
    return list(out)


def clean_names(names: list[str]) -> list[str]:
    return dedupe([sanitize(n) for n in names])
