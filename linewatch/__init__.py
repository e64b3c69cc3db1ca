"""Linewatch: ordered machine-sensor analytics as Spark DataFrame jobs."""
