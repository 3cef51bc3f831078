"""tally: retail and business analytics operators as lazy Spark DataFrame functions.

Every public operator takes DataFrames (plus typed arguments) and returns a DataFrame.
Nothing is collected to the driver; global scalars (quantiles, maxima, totals) travel
as scalar subqueries or one-row broadcast frames whose size is fixed by construction.
"""

__version__ = "0.1.0"
