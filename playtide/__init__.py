"""Listening-event analytics as composable PySpark DataFrame functions."""
