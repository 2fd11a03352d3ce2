"""Telemetry feature engineering and data processing on PySpark."""
