"""Lacuna: undersampled-acquisition analytics as Spark jobs.

Every public function takes DataFrames (or Columns) and returns DataFrames (or
Columns).  Grid positions are 0-based and column-major: ``pos = y + ny * z``.
"""
