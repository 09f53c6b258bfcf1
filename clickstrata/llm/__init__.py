"""Operators of a training-data pipeline; ``queries`` holds their registered queries.  Nothing else in the library imports this package."""
