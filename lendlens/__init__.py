"""lendlens: consumer-loan book analytics on Spark.

Every public function maps a DataFrame to a DataFrame.  Layout:

* ``sources``   raw landing (text CSV), the driver-table fixture view, sinks
* ``functions`` column expressions (text cleanup, calendar months, rounding)
* ``operators`` reusable physical building blocks (distributed exact ranks,
                 threshold sweep, guarded small-side joins, exact quantiles)
* ``plans``     the composite jobs: staging, features, segments, vintage,
                 loss, policy, modelling, cutoff economics, reports, exports

The names below are the public API.
"""

from importlib import import_module

__version__ = "0.1.0"

# module -> public names; loaded on first use, so that a Python worker that imports one module does not load them all
_PUBLIC = {
    "operators.ordering": ("RankSpec", "add_ranks"),
    "operators.quantile": ("exact_quantiles",),
    "operators.sweep": ("sweep_below",),
    "plans.cutoff": ("book_baseline", "cutoff_marginal", "cutoff_table"),
    "plans.export": ("export_star",),
    "plans.features": ("loan_features",),
    "plans.loss": ("grade_loss", "segment_expected_loss"),
    "plans.model": ("train_and_score",),
    "plans.policy": ("oot_split", "policy_summary"),
    "plans.segments": ("segment_risk", "top_segments"),
    "plans.staging": ("stage_loans", "staging_rejects", "staging_sanity"),
    "plans.vintage": ("vintage_curves",),
    "session": ("get_spark",),
    "sources.raw": ("read_raw_csv",),
}

__all__ = [name for names in _PUBLIC.values() for name in names]


def __getattr__(name: str):
    for module, names in _PUBLIC.items():
        if name in names:
            return getattr(import_module(f"lendlens.{module}"), name)
    raise AttributeError(f"module 'lendlens' has no attribute {name!r}")
