"""Trajectory and telemetry analytics as ordinary PySpark DataFrame transformations."""
