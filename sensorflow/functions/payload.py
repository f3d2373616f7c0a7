"""Topic and payload parsing as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sensorflow.schemas import PAYLOAD

# The two subscriptions (`+` = exactly one level) and the plain-number text form.
SUBSCRIPTIONS = ("sensors/+/data", "iot/+/telemetry")
NUMBER = r"^([+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?|[+-]?(?i:infinity)|(?i:nan))$"
BLANKS = " \t\r\n\f\x0b"


def topic_matches(topic: Column, patterns: tuple[str, ...] = SUBSCRIPTIONS) -> Column:
    regex = "|".join("^" + p.replace("+", "[^/]+") + "$" for p in patterns)
    return topic.rlike(regex)


def topic_device(topic: Column) -> Column:
    """Second level of the topic, or ``unknown``."""
    return F.coalesce(F.get(F.split(topic, "/"), F.lit(1)), F.lit("unknown"))


def is_json(payload: Column) -> Column:
    return payload.rlike(r"^\s*\{")


def parse_json(payload: Column) -> Column:
    """Struct of the JSON body; ``_broken`` holds the text when it does not fit."""
    return F.from_json(payload, PAYLOAD, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_broken"})


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(BLANKS))


def parse_number(text: Column) -> Column:
    """The number a text holds, 0.0 when it holds none."""
    return F.coalesce(F.when(strip(text).rlike(NUMBER), strip(text).try_cast("double")), F.lit(0.0))


def parse_pairs(payload: Column) -> Column:
    """``t:25.5,h:60.2`` -> struct(sensor_type, value, unit, metadata).

    The first pair is the measurement, later two-part pairs are metadata (last one per key wins).
    """
    parts = F.split(payload, ",")
    first = F.split(parts[0], ":")
    is_pair = F.size(first) == 2
    return F.struct(
        F.when(is_pair, strip(first[0])).otherwise("unknown").alias("sensor_type"),
        F.when(is_pair, parse_number(F.get(first, F.lit(1)))).otherwise(0.0).alias("value"),
        F.when(is_pair, F.lit("unit")).otherwise("unknown").alias("unit"),
        F.when(is_pair & (F.size(parts) > 1), F.map_from_entries(_last_per_key(parts)))
        .otherwise(no_metadata())
        .alias("metadata"),
    )


def _last_per_key(parts: Column) -> Column:
    """(key, value) of all pairs but the first, the last one of each key, in the order of the text.

    Sorted by key and place, a pair is its key's last if the next one has another key: no pair is compared with all.
    """

    def pair(part: Column, at: Column) -> Column:
        both = F.split(part, ":")
        return F.when(
            (at > 0) & (F.size(both) == 2),
            F.struct(strip(both[0]).alias("key"), at.alias("at"), strip(F.get(both, F.lit(1))).alias("value")),
        )

    def last_ones(pairs: Column) -> Column:
        def is_last(pair: Column, at: Column) -> Column:
            following = F.get(pairs, at + 1)
            return following.isNull() | (following["key"] != pair["key"])

        return F.filter(pairs, is_last)

    pairs = F.array_sort(F.array_compact(F.transform(parts, pair)))
    # bound to a variable, so that the sorted pairs are computed once and not for each of them
    kept = F.transform(F.array(pairs), last_ones)[0]
    in_order = F.array_sort(F.transform(kept, lambda p: F.struct(p["at"], p["key"], p["value"])))
    return F.transform(in_order, lambda p: F.struct(p["key"].alias("key"), p["value"].alias("value")))


def no_metadata() -> Column:
    return F.create_map().cast("map<string,string>")


def enum_name(value: Column, codes: dict[str, int], default: str) -> Column:
    """Name of an enumeration value given as name or as code."""
    names = {name: name for name in codes} | {str(code): name for name, code in codes.items()}
    return F.coalesce(F.try_element_at(_literal_map(names), value), F.lit(default))


def enum_code(value: Column, codes: dict[str, int]) -> Column:
    return F.coalesce(F.try_element_at(_literal_map(codes), value), F.lit(0))


def _literal_map(entries: dict) -> Column:
    return F.create_map(*[F.lit(x) for pair in entries.items() for x in pair])
