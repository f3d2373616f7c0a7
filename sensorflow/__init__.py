"""Sensor analytics on Spark: readings in, validated, cleaned, enriched, scored and routed."""
