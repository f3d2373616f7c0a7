"""Rolling detector: each reading against the recent history of its device and sensor type."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from sensorflow.functions.limits import ROLLING_DEFAULT, ROLLING_LIMITS, RollingLimit, by_exact_type
from sensorflow.functions.numeric import capped, is_finite, ratio
from sensorflow.functions.text import describe_rolling
from sensorflow.operators.series import HOT_ROWS, over_series
from sensorflow.schemas import FINDING

SERIES = ("device_id", "sensor_type")
ORDER = ("ts", "reading_id")
FLAT_ROWS = 10
METHOD = "Rolling"
NOTHING, RANGE, CHANGE, FLAT = range(4)


def history_columns(window: WindowSpec, history_size: int = 100) -> dict[str, Column]:
    """Previous value, number of earlier rows (up to ten) and their population variance."""
    before = window.rowsBetween(-min(FLAT_ROWS, history_size), -1)
    return {
        "prev_value": F.lag("value").over(window),
        "earlier": F.count(F.lit(1)).over(before),
        "variance10": F.var_pop("value").over(before),
    }


def with_verdict(
    rows: DataFrame,
    limits: Mapping[str, RollingLimit] = ROLLING_LIMITS,
    default: RollingLimit = ROLLING_DEFAULT,
) -> DataFrame:
    """Apply the rules in order to rows that carry the history columns.

    ``rule`` is the number of the rule that hit, 0 for none, which leaves ``type`` null.
    """
    low, high, percent, variance = (F.col("_limit")[name] for name in RollingLimit._fields)
    value, prev, change = F.col("value"), F.col("prev_value"), F.col("pct_change")

    # A later filter on ``rule`` is evaluated with everything it refers to, so each limit is read once here.
    out_of_range = ~F.isnan(value) & ((value < low) | (value > high))
    from_zero = (prev == 0) & (value != 0) & ~F.isnan(value)
    sudden = from_zero | (~F.isnan(change) & (change > percent))
    flat = (F.col("earlier") >= FLAT_ROWS) & (F.col("variance10") < variance)
    rule = (
        F.when(F.col("earlier") < 2, F.lit(NOTHING))
        .when(out_of_range, F.lit(RANGE))
        .when(sudden, F.lit(CHANGE))
        .when(flat, F.lit(FLAT))
        .otherwise(NOTHING)
    )
    beyond = F.when(value < low, low - value).otherwise(value - high)
    range_severity = F.when(is_finite(value), capped(beyond / (high - low))).otherwise(1.0)
    change_severity = F.when(from_zero, F.lit(1.0)).otherwise(capped(change / 100))
    return (
        rows.withColumns(
            {
                "_limit": by_exact_type(F.lower("sensor_type"), limits, default),
                "pct_change": F.abs(ratio(value - prev, prev) * 100),
            }
        )
        .withColumn("rule", rule)
        .withColumns(
            {
                "type": F.when(F.col("rule") == RANGE, F.lit("OutOfRange"))
                .when((F.col("rule") == CHANGE) & (value > prev), F.lit("SuddenSpike"))
                .when(F.col("rule") == CHANGE, F.lit("SuddenDrop"))
                .when(F.col("rule") == FLAT, F.lit("FlatLine")),
                "severity": F.when(F.col("rule") == RANGE, range_severity)
                .when(F.col("rule") == CHANGE, change_severity)
                .when(F.col("rule") == FLAT, F.lit(0.5)),
                "is_anomaly": F.col("rule") != NOTHING,
                "method": F.lit(METHOD),
            }
        )
        .withColumn("description", describe_rolling(value, F.col("type"), low, high, change))
        .drop("_limit")
    )


def scorable(rows: DataFrame) -> DataFrame:
    return rows.select("reading_id", "device_id", "sensor_type", "ts", "value").filter(F.col("value").isNotNull())


def rolling_scores(
    rows: DataFrame,
    history_size: int = 100,
    limits: Mapping[str, RollingLimit] = ROLLING_LIMITS,
    default: RollingLimit = ROLLING_DEFAULT,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Every reading with a value, scored; one exchange on (device, sensor type)."""
    seen = over_series(
        scorable(rows), SERIES, ORDER, FLAT_ROWS, lambda w: history_columns(w, history_size), hot_rows
    )
    return with_verdict(seen, limits, default)


def reports(scores: DataFrame) -> DataFrame:
    """Verdicts and the numbers behind them; the variance only where it decided."""
    variance = F.when(F.col("type") == "FlatLine", F.col("variance10")).alias("variance10")
    return scores.select(*FINDING, "prev_value", "pct_change", variance, "description")


def findings(scores: DataFrame) -> DataFrame:
    """Rows with a finding."""
    return reports(scores.filter(F.col("rule") != NOTHING))


def rolling_anomalies(rows: DataFrame, **options) -> DataFrame:
    return findings(rolling_scores(rows, **options))
