"""Ride-trip analytics as plain PySpark: batch jobs, star schema, reports and streams."""
