"""Operators a training-data pipeline needs, each a function DataFrame -> DataFrame.

Nothing outside this subpackage imports it; ``__spark_entry__`` adds its
queries only when the subpackage is present.
"""
