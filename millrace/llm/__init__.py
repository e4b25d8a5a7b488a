"""Operators for preparing training data at corpus scale, and their queries.

Nothing else in the library imports this package.
"""
