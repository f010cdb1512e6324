"""Column expressions: text cleanup and typing (``cleaning``), rounding and
the oracle gate's comparison grid (``numeric``)."""
