"""Workforce analytics as composable Spark DataFrame transformations."""
