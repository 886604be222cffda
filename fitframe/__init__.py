"""fitframe: fit/transform feature preparation, profiling, drift and scoring
on Spark DataFrames.

Every step is a ``fit`` that runs a few wide aggregations and returns a small
state, and a ``transform`` that is a lazy column expression, so a chain of
steps compiles to one Spark plan.
"""

__version__ = "0.1.0"
