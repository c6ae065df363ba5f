"""Operators of a training-data pipeline. Nothing else in the library imports this package.

One module per operator; ``queries`` holds the registered queries and their SQL.
"""
