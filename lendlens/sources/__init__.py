"""Inputs: the raw text loan file (``raw``) and the loan-shaped view over the
driver's tables used by tests, the gate and the benchmark (``fixture``)."""
