"""Telemetry analytics and corpus preparation as PySpark DataFrame functions."""
