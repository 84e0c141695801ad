"""Spark jobs for layered tables, trip and flight analytics, note
de-identification, transcript keywords and hourly forecasts.

Every public function takes DataFrames or Columns and returns them; the work
stays in Catalyst expressions, so Spark partitions, shuffles and spills it.
"""
