"""The composite jobs, each a function from DataFrame to DataFrame.

staging -> features -> {segments, vintage, loss, risk_layer} -> export;
features -> policy -> prep -> model -> cutoff; reports read the finished
tables; ``book`` memoises the written layers of one source per session.
"""
