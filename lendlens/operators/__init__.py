"""Reusable physical building blocks.

* ``ordering``  exact NTILE / PERCENT_RANK / ROW_NUMBER without a single task
* ``quantile``  exact interpolated quantiles by bracketing
* ``sweep``     cumulative sums below a list of thresholds in one scan
* ``metrics``   exact AUC, Gini, Brier
* ``joins``     size-checked broadcast lookups and grouping-set pinning
"""
