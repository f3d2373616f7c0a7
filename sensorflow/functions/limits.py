"""Fixed values per sensor type, and the CASE expressions that look them up."""

from __future__ import annotations

import sys
from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F


class RollingLimit(NamedTuple):
    low: float
    high: float
    percent: float
    variance: float


class Bounds(NamedTuple):
    low: float
    high: float


class CleanRule(NamedTuple):
    low: float | None
    high: float | None
    scale: float


# Rolling detector, by lower-cased exact type.
ROLLING_LIMITS = {
    "temperature": RollingLimit(-40.0, 85.0, 50.0, 0.1),
    "humidity": RollingLimit(0.0, 100.0, 30.0, 0.1),
    "pressure": RollingLimit(300.0, 1100.0, 20.0, 0.1),
}
ROLLING_DEFAULT = RollingLimit(-sys.float_info.max, sys.float_info.max, 100.0, 0.001)

# Bounds of the static threshold detector, by lower-cased exact type.
STATIC_BOUNDS = {
    "temperature": Bounds(-40.0, 80.0),
    "humidity": Bounds(0.0, 100.0),
    "pressure": Bounds(800.0, 1200.0),
    "voltage": Bounds(0.0, 12.0),
    "current": Bounds(0.0, 10.0),
    "ph": Bounds(0.0, 14.0),
    "co2": Bounds(350.0, 5000.0),
}

# Clamping range and scale (10 to the number of decimals); the first type text contained in
# the lower-cased type wins.
CLEAN_RULES = (
    ("temperature", CleanRule(-100.0, 150.0, 100.0)),
    ("humidity", CleanRule(0.0, 100.0, 10.0)),
    ("pressure", CleanRule(0.0, 2000.0, 10.0)),
    ("ph", CleanRule(0.0, 14.0, 100.0)),
    ("voltage", CleanRule(-50.0, 50.0, 1000.0)),
    ("current", CleanRule(-100.0, 100.0, 1000.0)),
)
CLEAN_DEFAULT = CleanRule(None, None, 100.0)

# Range a plausible value lies in, same matching.
EXPECTED_RANGES = (
    ("temperature", Bounds(-50.0, 100.0)),
    ("humidity", Bounds(0.0, 100.0)),
    ("pressure", Bounds(800.0, 1200.0)),
    ("ph", Bounds(0.0, 14.0)),
)

# Which detector a type is sent to, same matching; everything else goes to "statistical".
ROUTES = (
    ("temperature", "timeseries"),
    ("humidity", "timeseries"),
    ("pressure", "timeseries"),
    ("switch", "threshold"),
    ("motion", "threshold"),
    ("door", "threshold"),
)
TIMESERIES_TYPES = ("temperature", "humidity", "pressure", "flow", "voltage", "current")


def by_exact_type(kind: Column, values: Mapping[str, object], default: object = None) -> Column:
    """Look a value up by lower-cased type; a named tuple comes back as a struct of its fields.

    Callers put the result into a column of its own, so that it is evaluated once per row however often
    its fields are read.
    """
    return _cases([(kind == F.lit(name), value) for name, value in values.items()], default)


def by_contained_type(kind: Column, pairs: Sequence[tuple[str, object]], default: object = None) -> Column:
    """Value of the first pair whose text occurs in the lower-cased type."""
    return _cases([(kind.contains(text), value) for text, value in pairs], default)


def _cases(branches: Sequence[tuple[Column, object]], default: object) -> Column:
    if not branches:
        return _value(default)
    result = F
    for condition, value in branches:
        result = result.when(condition, _value(value))
    return result if default is None else result.otherwise(_value(default))


def _value(value: object) -> Column:
    if hasattr(value, "_asdict"):
        return F.struct(*[F.lit(v).cast("double").alias(name) for name, v in value._asdict().items()])
    return F.lit(value)
