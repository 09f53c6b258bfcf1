"""Advertising-funnel and device-behaviour analytics as plain Spark jobs.

Every public function takes DataFrames or Columns and returns a DataFrame or a
Column; nothing reads global state and nothing runs an action unless its
docstring says so.
"""
