"""Sensor-and-diary analytics as Spark jobs."""
